"""Licence scan with a positional rare-token index (operator 9).

The templates are an index of postings (word, template, position).  One pass
counts in how many documents each template word occurs; the words with the
highest inverse document frequency become its look-up
words: two more than the template may lose, so every copy that is close enough
keeps two of them.  A second pass takes, from every document, the places of look-up words
with the words around them.  A place and a posting give a start in the
document; starts on which enough different look-up words of a template agree
are kept (the intersection of its postings by relative position).  There the
whole template is compared: every word of its key phrase must stand at its
place, and at least ``SHARE`` of all words.

The base phrases are counted in the same pass.  Only documents that hold a
look-up word or a base phrase's last word are split into word arrays.  What is
collected is one count per template word, a fixed number.

Only DataFrame functions are used.

Defined results: null text counts as empty and has no words, no places and
score 0; rows that repeat an id are separate documents; overlapping places all
count; an empty table gives an empty result; other columns are not read.
Score: 1 with a base place, else the best template's share of matched words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankforge.llm.shared import cut_lineage, text_of

# ---- fixed values: phrases and public licence wordings ---------------------
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
#: (label, wording, key phrase that must match in full)
TEMPLATES = (
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
     "redistribution and use in source and binary forms"),
    ("cc-by", "licensed under cc by 4 0", "cc by 4 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc 4 0"),
    ("gpl-3.0", "licensed under the gnu general public license version 3", "general public license version 3"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee",
     "permission to use copy modify"),
    ("mit", "released under the mit license", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy",
     "permission is hereby granted free of charge"),
    ("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", "mozilla public license v 2 0"),
    ("public-domain", "this is free and unencumbered software released into the public domain",
     "free and unencumbered software"),
)
AGREE = 2
SHARE = 0.8
#: After lower-casing A-Z a word is a run of other characters than these.
GAP = r"\x00-\x2F\x3A-\x60\x7B-\x7F"
#: The same words before lower-casing.
WORD_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
# ---------------------------------------------------------------------------


def lower_az(text: Column) -> Column:
    """Lower case for comparisons with ASCII words.  The two characters whose
    lower case is an ASCII letter are replaced by other letters first."""
    return F.lower(F.replace(F.replace(text, F.lit("K"), F.lit("ĸ")), F.lit("İ"), F.lit("ı")))


def template_rows(templates) -> list[tuple]:
    """(template, label, words, key places) of each template."""
    out = []
    for i, (label, wording, key) in enumerate(templates):
        words, k = wording.split(), key.split()
        at = next(a for a in range(len(words)) if words[a:a + len(k)] == k)
        out.append((i, label, words, list(range(at, at + len(k)))))
    return out


def lookups(words: list[str], share: float = SHARE, agree: int = AGREE) -> tuple[int, int]:
    """(look-up words, how many of them must agree on a start): with at most
    ``lost`` words missing, that many always do."""
    lost = max(j for j in range(len(words) + 1) if (len(words) - j) / len(words) >= share)
    distinct = len(set(words))
    rare = min(distinct, lost + agree)
    return rare, max(1, min(agree, rare - lost))


def rare_words(docs: DataFrame, text_col: str, templates=TEMPLATES, share: float = SHARE) -> list[list[str]]:
    """Per template its words of highest inverse document frequency; the
    frequencies count all documents."""
    vocab = sorted({w for _, wording, _ in templates for w in wording.split()})
    words = F.split(lower_az(text_of(text_col)), f"[{GAP}]+")
    seen = docs.select(F.explode(F.array_intersect(words, F.array(*[F.lit(w) for w in vocab]))).alias("w"))
    df = {r.w: r.n for r in seen.groupBy("w").agg(F.count("*").alias("n")).collect()}     # at most one per word
    return [sorted(set(wording.split()), key=lambda w: (df.get(w, 0), w))[:lookups(wording.split(), share)[0]]
            for _, wording, _ in templates]


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES, base=BASE,
                 share: float = SHARE) -> tuple[DataFrame, DataFrame]:
    """(documents, finds): documents with their base places, and the template
    finds as (row, label, start, score)."""
    spark = docs.sparkSession
    rows = template_rows(templates)
    chosen = rare_words(docs, text_col, templates, share)
    longest = max(len(t[2]) for t in rows)
    postings = spark.createDataFrame(
        [(t, label, words, key, lookups(words, share)[1], w, at) for t, label, words, key in rows
         for at, w in enumerate(words) if w in chosen[t]],
        "template int, label string, words array<string>, key array<int>, need int, word string, at int")

    wanted = sorted({w for c in chosen for w in c})
    ends = sorted({p.split()[-1] for p, _ in base})
    text = text_of(text_col)
    low = lower_az(text)
    scan = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"),
        F.regexp_count(text, F.lit(WORD_ANY_CASE)).cast("long").alias("n_words"),
        F.when(low.rlike("|".join(sorted({*wanted, *ends}))), F.regexp_extract_all(low, F.lit(f"[^{GAP}]+"), F.lit(0)))
        .otherwise(F.array().cast("array<string>")).alias("words"))
    at = F.transform("words", lambda w, i: F.struct(i.alias("i"), w.alias("w")))
    scan = scan.withColumn("hits", F.filter(at, lambda x: x.w.isin(sorted({*wanted, *ends}))))
    word = lambda i: F.get("words", i)

    def places(phrase: str) -> Column:
        p = phrase.split()
        ok = lambda x: F.lit(True) if len(p) == 1 else _all([word(x.i - (len(p) - 1 - j)) == p[j]
                                                             for j in range(len(p) - 1)])
        hit = F.filter("hits", lambda x: (x.w == p[-1]) & (x.i >= len(p) - 1) & ok(x))
        return F.transform(hit, lambda x: (x.i - (len(p) - 1)).cast("long"))

    begin = lambda x: F.greatest(F.lit(0), x.i - (longest - 1))
    around = F.transform(F.filter("hits", lambda x: x.w.isin(wanted)), lambda x: F.struct(
        x.i.alias("i"), x.w.alias("w"), begin(x).alias("from"),
        F.slice("words", begin(x) + 1, x.i - begin(x) + longest).alias("near")))
    scan = cut_lineage(scan.select("row", "id", "n_words", around.alias("around"),
                                   *[places(p).alias(f"p{j}") for j, (p, _) in enumerate(base)]))

    found = scan.select("row", F.explode("around").alias("x")).select("row", "x.*") \
        .join(F.broadcast(postings), F.col("w") == F.col("word")) \
        .withColumn("start", F.col("i") - F.col("at")).where("start >= 0")
    found = found.groupBy("row", "template", "start").agg(
        F.count_distinct("word").alias("agree"), F.min(F.struct("from", "near")).alias("x"),
        F.first("words").alias("words"), F.first("key").alias("key"), F.first("label").alias("label"),
        F.first("need").alias("need")).where("agree >= need")
    same = F.zip_with(F.slice("x.near", F.col("start") - F.col("x.from") + 1, F.size("words")), "words",
                      lambda a, b: a.eqNullSafe(b))
    found = found.withColumn("same", same)
    score = F.size(F.filter("same", lambda s: s)) / F.size("words").cast("double")
    found = found.where(F.forall("key", lambda j: F.get("same", j))).select("row", "label", "start", score.alias("score")) \
        .where(F.col("score") >= share)
    return scan, found


def _all(conds: list[Column]) -> Column:
    out = conds[0]
    for c in conds[1:]:
        out = out & c
    return out


def license_labels(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", base=BASE, **options) -> DataFrame:
    """One row per document: id, n_words, n_base, first_word, last_word,
    base_labels, labels, score."""
    scan, found = license_scan(docs, id_col, text_col, base=base, **options)
    best = found.groupBy("row").agg(F.collect_set("label").alias("own"), F.max("score").alias("best"))
    every = F.concat(*[F.col(f"p{j}") for j in range(len(base))])
    labels = F.array_compact(F.array(*[F.when(F.size(f"p{j}") > 0, F.lit(x)) for j, (_, x) in enumerate(base)]))
    out = scan.join(best, "row", "left").withColumn("every", every).withColumn("based", labels)
    tidy = lambda a: F.array_join(F.array_sort(F.array_distinct(a)), ",")
    return out.select(
        F.col("id").alias(id_col), "n_words", F.size("every").cast("long").alias("n_base"),
        F.array_min("every").alias("first_word"), F.array_max("every").alias("last_word"),
        tidy(F.col("based")).alias("base_labels"),
        tidy(F.concat("based", F.coalesce("own", F.array().cast("array<string>")))).alias("labels"),
        F.when(F.size("every") > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"))


def op9_license_scan(spark, sf_dir: str) -> DataFrame:
    return license_labels(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _sql() -> str:
    """The same result from all words with their positions."""
    t = ", ".join(f"({i}, '{label}', {j}, '{w}', {str(j in key).lower()}, {lookups(words)[0]}, {lookups(words)[1]})"
                  for i, label, words, key in template_rows(TEMPLATES) for j, w in enumerate(words))
    b = " UNION ALL ".join(
        "SELECT w0.doc_id, w0.i, '" + label + "' AS label FROM w w0 "
        + " ".join(f"JOIN w w{j} ON w{j}.doc_id = w0.doc_id AND w{j}.i = w0.i + {j} AND w{j}.w = '{x}'"
                   for j, x in enumerate(p.split()) if j)
        + f" WHERE w0.w = '{p.split()[0]}'" for p, label in BASE)
    return rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS a FROM documents),
w AS (SELECT doc_id, unnest(a) AS w, generate_subscripts(a, 1)::BIGINT - 1 AS i FROM d),
t(template, label, j, word, is_key, rare, need) AS (VALUES {t}),
f AS (SELECT w AS word, count(DISTINCT doc_id) AS n FROM w GROUP BY w),
rare AS (SELECT DISTINCT template, word FROM
           (SELECT template, rare, t.word, dense_rank() OVER (PARTITION BY template ORDER BY coalesce(n, 0), t.word) AS r
            FROM t LEFT JOIN f ON f.word = t.word) WHERE r <= rare),
c AS (SELECT w.doc_id, t.template, i - j AS start FROM w JOIN t ON w.w = t.word
      JOIN rare ON rare.template = t.template AND rare.word = t.word
      WHERE i >= j GROUP BY w.doc_id, t.template, i - j HAVING count(DISTINCT w.w) >= any_value(need)),
m AS (SELECT c.doc_id, c.template, any_value(t.label) AS label, start,
             count(w.w)::DOUBLE / count(*) AS score, bool_and(NOT is_key OR w.w IS NOT NULL) AS whole_key
      FROM c JOIN t ON t.template = c.template
      LEFT JOIN w ON w.doc_id = c.doc_id AND w.i = c.start + t.j AND w.w = t.word
      GROUP BY c.doc_id, c.template, start),
own AS (SELECT doc_id, label, score FROM m WHERE whole_key AND score >= {SHARE}),
b AS ({b}),
bd AS (SELECT doc_id, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word,
              string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM b GROUP BY doc_id),
l AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM
        (SELECT doc_id, label FROM b UNION ALL SELECT doc_id, label FROM own) GROUP BY doc_id),
s AS (SELECT doc_id, max(score) AS best FROM own GROUP BY doc_id)
SELECT d.doc_id, len(a)::BIGINT AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0.0::DOUBLE) END AS score
FROM d LEFT JOIN bd USING (doc_id) LEFT JOIN l USING (doc_id) LEFT JOIN s USING (doc_id)
"""


SQL = _sql()
