"""Mixing sources to target weights (operator 1).

Efraimidis-Spirakis sampling: a document's key is an exponential variate
divided by its quality weight, -ln(u) / w, with u drawn from the SHA-256 of
the seed, its id and its text, so reruns agree and rows that share an id, or
have none, draw apart.  A source's target is a number of whole
epochs plus a fraction; every document is taken once per whole epoch, and the
fraction takes the documents with the smallest keys while the prefix sum of
their sizes stays nearest to what is left of the target.

The prefix sum runs over (source, key bucket) groups: each bucket sums its own
rows, and the bucket totals give the offsets, so a source with a third of all
rows is never sorted in one task.  The result is one cut per source; a
document joins it by comparing its key, so texts are never shuffled.  Only the
summary with one row per source is ordered in a single task.

Targets: sources in code point order, null last, get the weights 5, 2, 1,
repeating, and share the total size in proportion; no target exceeds ``cap``
times its source's size, and the excess goes to the others by weight (water
filling).  Key buckets are cut by a distribution that is the average of
those of weights 0.1, 0.25, 0.5 and 1, so each holds a few times the average
share of a source at most, whatever its weights.

Defined results: null and empty texts have size 0, target nothing and are
taken with 0 words; a null source is a source of its own; rows
of equal id and text draw alike, and their place in the table decides which
of them is taken; a null id draws like the text ``null``; an empty table gives
an empty mix; other columns are kept as they are, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankforge.llm.shared import cut_lineage, partitions, small, text_of, unused, with_row_key

#: Fixed values of the mix.
SOURCE_WEIGHTS = (5, 2, 1)
CAP = 3
SEED = "mix-1"
WORD = r"[^\x20\x09-\x0D]+"
#: ASCII punctuation and digits: a high share of them marks a poor text.
MARKS = r"[\x21-\x40\x5B-\x60\x7B-\x7E]"


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def quality_weight(text: Column) -> Column:
    """Between 0.1 and 1; falls with the share of punctuation and digits."""
    chars = F.char_length(text).cast("double")
    marks = F.regexp_count(text, F.lit(MARKS)).cast("double")
    return F.when(chars > 0, F.greatest(F.lit(0.1).cast("double"), F.lit(1).cast("double") - F.lit(4) * marks / chars)) \
        .otherwise(F.lit(0.1).cast("double"))


def sample_key(id_col: str, text: Column, weight: Column, seed: str = SEED) -> Column:
    """Exponential variate over the weight; the smallest keys are drawn first."""
    name = F.concat(F.lit(seed + ":"), F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.lit(":"), F.sha2(text, 256))
    u = (F.conv(F.substring(F.sha2(name, 256), 1, 13), 16, 10).cast("long").cast("double") + 0.5) / float(1 << 52)
    return -F.log(u) / weight


def targets(sizes: DataFrame, weights=SOURCE_WEIGHTS, cap: int = CAP) -> DataFrame:
    """(source, source_size) -> plus target; one row per source."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(x).cast("long") for x in weights]),
                     (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    s = sizes.withColumn("w", w).withColumn("ratio", F.col("source_size").cast("double") / F.col("w"))
    order = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    rest = order.rowsBetween(0, Window.unboundedFollowing)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    s = (s.withColumn("left", F.sum("source_size").over(Window.partitionBy())
                      - F.coalesce(F.sum(cap * F.col("source_size")).over(before), F.lit(0)))
         .withColumn("w_left", F.sum("w").over(rest)))
    s = s.withColumn("free", cap * F.col("source_size") * F.col("w_left") > F.col("w") * F.col("left"))
    s = s.withColumn("level", F.first(F.when(F.col("free"), F.col("left").cast("double") / F.col("w_left")),
                                      ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    target = F.when(F.col("level").isNull(), (cap * F.col("source_size")).cast("double")) \
        .otherwise(F.least(F.col("w") * F.col("level"), (cap * F.col("source_size")).cast("double")))
    return s.select("source", "source_size", target.alias("target"))


def _bucket(key: Column, n: int) -> Column:
    """Key buckets 0 to n - 1, in the order of the keys."""
    spread = sum((F.lit(1.0) - F.exp(-key * w) for w in (0.1, 0.25, 0.5, 1.0)), F.lit(0.0)) / 4
    return F.least(F.floor(spread * n), F.lit(n - 1)).cast("int")


def _plan(docs: DataFrame, row_col: str, id_col: str, text_col: str, source_col: str,
          weight: Column | None = None, seed: str = SEED, weights=SOURCE_WEIGHTS, cap: int = CAP):
    """(rows, plan): the slim rows (row, id, source, size, key) and one plan row
    per source: source_size, target, epochs and the cut (key, id, row) of the
    fraction.  ``row_col`` names each row."""
    spark = docs.sparkSession
    text = text_of(text_col)
    rows = cut_lineage(docs.select(
        F.col(row_col).alias("row"), F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"),
        n_words(text).alias("size"), sample_key(id_col, text, quality_weight(text) if weight is None else weight, seed).alias("key")))
    plan = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, cap)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    plan = cut_lineage(plan.withColumn("epochs", epochs.cast("long"))
                       .withColumn("left", F.col("target") - (F.col("epochs") * F.col("source_size")).cast("double")))

    n = 16 * partitions(spark)
    split = rows.withColumn("bucket", _bucket(F.col("key"), n))
    totals = split.groupBy("source", "bucket").agg(F.sum("size").alias("in_bucket"))
    offset = totals.select("source", "bucket", (F.sum("in_bucket").over(
        Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))
        - F.col("in_bucket")).alias("offset"))
    inside = Window.partitionBy("source", "bucket").orderBy("key", F.col("id").asc_nulls_last(), "row") \
        .rowsBetween(Window.unboundedPreceding, 0)
    pos = split.withColumn("upto", F.sum("size").over(inside)).alias("r").join(
        offset.alias("o"), F.col("r.source").eqNullSafe(F.col("o.source")) & (F.col("r.bucket") == F.col("o.bucket")))
    pos = pos.select("r.source", "r.row", "r.id", "r.key",
                     (F.col("offset") + F.col("upto") - F.col("size") / F.lit(2.0)).alias("middle"))
    chosen = pos.join(small(plan.select(F.col("source").alias("s"), "left")), F.col("source").eqNullSafe(F.col("s"))) \
        .where((F.col("left") > 0) & (F.col("middle") <= F.col("left")))
    cut = chosen.groupBy("source").agg(F.max(_draw("key", "id", "row")).alias("cut"))
    plan = plan.alias("p").join(cut.alias("c"), F.col("p.source").eqNullSafe(F.col("c.source")), "left") \
        .select("p.source", "source_size", "target", "epochs", "cut")
    return rows, cut_lineage(plan)


def _draw(key: str, id_col: str, row: str) -> Column:
    return F.struct(F.col(key).alias("key"), F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"), F.col(row).alias("row"))


def _copies(draw: Column, cut: str = "cut", epochs: str = "epochs") -> Column:
    inside = F.col(cut).isNotNull() & (draw <= F.col(cut))
    return F.col(epochs) + F.when(inside, F.lit(1)).otherwise(F.lit(0)).cast("long")


def mix_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
               **options) -> DataFrame:
    """Per document: id, size, source_size, target, taken, copies."""
    row = unused(docs, "__row")
    rows, plan = _plan(with_row_key(docs, row), row, id_col, text_col, source_col, **options)
    out = rows.alias("r").join(small(plan).alias("p"), F.col("r.source").eqNullSafe(F.col("p.source")))
    copies = _copies(_draw("key", "id", "row"))
    return out.select(F.col("id").alias(id_col), "size", "source_size", "target",
                      (F.col("size") * copies).alias("taken"), copies.alias("copies"))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weight: Column | None = None, seed: str = SEED, **options) -> DataFrame:
    """The mix itself: the documents' rows with all columns, each as often as
    it is taken."""
    row, key, own, epochs, cut, n, copy = (unused(docs, f"__{x}") for x in ("row", "key", "source", "epochs", "cut", "n", "copy"))
    named = with_row_key(docs, row)
    _, plan = _plan(named, row, id_col, text_col, source_col, weight, seed, **options)
    text = text_of(text_col)
    # documents of size 0 have no words to take; they stay out of the mix
    keyed = named.withColumn(key, sample_key(id_col, text, quality_weight(text) if weight is None else weight, seed)) \
        .where(text.rlike(WORD))
    plan = plan.select(F.col("source").alias(own), F.col("epochs").alias(epochs), F.col("cut").alias(cut))
    out = keyed.join(small(plan), F.col(source_col).cast("string").eqNullSafe(F.col(own)))
    return out.withColumn(n, _copies(_draw(key, id_col, row), cut, epochs)).where(F.col(n) > 0) \
        .withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), F.col(n)))).select(*[F.col(f"`{c}`") for c in docs.columns])


def op1_mix_sources(spark, sf_dir: str) -> DataFrame:
    return mix_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = r"""
WITH t AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
d AS (
  SELECT doc_id, source, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         CASE WHEN length(text) > 0 THEN greatest(0.1::DOUBLE, 1::DOUBLE - 4 *
              len(regexp_extract_all(text, '[\x21-\x40\x5B-\x60\x7B-\x7E]'))::DOUBLE / length(text)::DOUBLE)
              ELSE 0.1::DOUBLE END AS quality,
         (('0x' || substr(sha256('mix-1:' || coalesce(doc_id::VARCHAR, 'null') || ':' || sha256(text)), 1, 13))::BIGINT::DOUBLE + 0.5)
           / 4503599627370496::DOUBLE AS u
  FROM t),
k AS (SELECT *, -ln(u) / quality AS key FROM d),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size FROM k GROUP BY source),
s1 AS (SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3 + 1]::BIGINT AS w FROM s0),
s2 AS (SELECT *, (sum(source_size) OVER ())::BIGINT
              - coalesce(sum(3 * source_size) OVER (ORDER BY source_size::DOUBLE / w, source NULLS LAST
                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS rest,
              (sum(w) OVER (ORDER BY source_size::DOUBLE / w, source NULLS LAST
                         ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS w_rest FROM s1),
s3 AS (SELECT *, first_value(CASE WHEN 3 * source_size * w_rest > w * rest THEN rest::DOUBLE / w_rest END IGNORE NULLS)
              OVER (ORDER BY source_size::DOUBLE / w, source NULLS LAST
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS level FROM s2),
s4 AS (SELECT source, source_size,
              CASE WHEN level IS NULL THEN (3 * source_size)::DOUBLE
                   ELSE least(w * level, (3 * source_size)::DOUBLE) END AS target FROM s3),
s5 AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs FROM s4),
p AS (SELECT k.*, s5.source_size, s5.target, s5.epochs,
             target - (epochs * source_size)::DOUBLE AS rest,
             (sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::DOUBLE - size / 2.0::DOUBLE AS middle
      FROM k JOIN s5 ON k.source IS NOT DISTINCT FROM s5.source)
SELECT doc_id, size, source_size, target,
       epochs + CASE WHEN rest > 0 AND middle <= rest THEN 1 ELSE 0 END AS copies,
       size * (epochs + CASE WHEN rest > 0 AND middle <= rest THEN 1 ELSE 0 END) AS taken
FROM p
"""
