"""Substring dedup on a compacted de Bruijn graph of word k-mers (operator 4).

Edges are windows of ``k`` words, nodes the ``k - 1`` words that neighbouring
windows share.  What is shuffled first is not single edges but chains of
consecutive edges (see ``repeats``).  A chain that occurs again is one path of
the graph walked twice; anchors with differing chains are taken apart into
single edges, which are matched by a second, much smaller shuffle.

``repeated_paths`` then compacts: two repeated edges (or chains) that follow
each other in a document and whose sources follow each other too lie on one
unbranched path, and all such neighbours are joined along (document, source,
diagonal) into maximal spans.  A span keeps the coordinates of an earlier
occurrence; equal lengths on one diagonal verify that the whole span, not just
its edges, occurs there.

Defined results: null and empty texts have no words and remove nothing; texts
of fewer than ``k`` words neither; the order is by id, null last; rows that
repeat an id, or have none, are documents of their own, in the order of the
table; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankforge.llm import repeats
from rankforge.llm.repeats import CHECK, DUP, NULL_ID
from rankforge.llm.shared import byte_codes, cut_lineage, mix, span_hash, utf8, window_hash, word_bounds

K = 20
GRAM = 4
_CODES = byte_codes(1)


def word_units(raw: np.ndarray, off: np.ndarray):
    start, end, doc = word_bounds(raw, off)
    return span_hash(_CODES[raw], start, end), np.searchsorted(doc, np.arange(len(off)))


def _edges(k: int):
    """Single edges of the chains to be checked."""
    other = np.uint64(0x5BD1E9955BD1E995)

    def work(ids, texts, rows):
        out = []
        lo, hi = repeats.rows_of(ids, rows["doc"])
        for i, text in enumerate(texts):
            if lo[i] == hi[i]:
                continue
            raw, off = utf8(pa.array([text], pa.binary()))
            codes, _ = word_units(raw, off)
            if len(codes) < k:
                continue
            n, start = rows["n"][lo[i]:hi[i]].astype(np.int64), rows["start"][lo[i]:hi[i]].astype(np.int64)
            end = np.cumsum(n)
            at = np.unique(np.repeat(start - (end - n), n) + np.arange(end[-1]))
            at = at[at <= len(codes) - k]
            out.append((window_hash(codes, k)[at], span_hash(mix(codes ^ other), at, at + k),
                        np.full(len(at), ids[i]), at))
        if not out:
            return pa.table({c: pa.array([], t) for c, t in zip(
                ("h", "key", "doc", "start", "n", "sdoc", "sstart"),
                (pa.int64(),) * 3 + (pa.int32(),) * 2 + (pa.int64(), pa.int32()))})
        h, key, doc, at = (np.concatenate(x) for x in zip(*out))
        return pa.Table.from_batches(repeats._local(h.view(np.int64), key.view(np.int64), doc, at,
                                                    np.ones(len(at), dtype=np.int64)))
    return work


def repeated_edges(docs: DataFrame, blocks: int, k: int = K, gram: int = GRAM) -> DataFrame:
    """doc, start, n, sdoc, sstart: ``n`` windows from ``start`` also occur
    earlier, at ``sstart`` of ``sdoc``."""
    found = repeats.find_repeats(docs, word_units, k, gram)
    check = found.where(F.col("kind") == CHECK).select("doc", "start", "n")
    edges = repeats.with_texts(docs, check, blocks, _edges(k), repeats._CHAIN)
    single = repeats.resolve(edges, check=False)
    columns = ["doc", "start", "n", "sdoc", "sstart"]
    return found.where(F.col("kind") == DUP).select(*columns).union(single.select(*columns))


def compact(edges: DataFrame, k: int = K) -> DataFrame:
    """Join neighbouring edges of one diagonal into maximal spans:
    doc, start, end (words), sdoc, sstart."""
    e = edges.withColumn("diagonal", F.col("start") - F.col("sstart"))
    path = Window.partitionBy("doc", "sdoc", "diagonal").orderBy("start")
    reach = F.max(F.col("start") + F.col("n")).over(path.rowsBetween(Window.unboundedPreceding, -1))
    e = e.withColumn("breaks", F.when(F.col("start") <= reach, 0).otherwise(1))
    e = e.withColumn("path", F.sum("breaks").over(path.rowsBetween(Window.unboundedPreceding, 0)))
    return e.groupBy("doc", "sdoc", "diagonal", "path").agg(
        F.min("start").alias("start"), F.max(F.col("start") + F.col("n") + (k - 1)).alias("end"),
        F.min("sstart").alias("sstart")).select("doc", "start", "end", "sdoc", "sstart")


def repeated_paths(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K,
                   gram: int = GRAM) -> DataFrame:
    """Maximal repeated spans with the coordinates of an earlier occurrence:
    id, start, end (words), source_id, source_start."""
    own, ids = repeats.in_order(docs, id_col, text_col)
    spans = compact(repeated_edges(own, repeats.n_blocks(own), k, gram), k)
    if ids is not None:
        spans = spans.join(ids, "doc").drop("doc").withColumnRenamed("id", "doc") \
            .join(ids.select(F.col("doc").alias("sdoc"), "id"), "sdoc").drop("sdoc").withColumnRenamed("id", "sdoc")
    back = lambda c: F.when(F.col(c) != NULL_ID, F.col(c))
    return spans.select(back("doc").alias(id_col), "start", "end", back("sdoc").alias("source_id"),
                        F.col("sstart").alias("source_start"))


def _remove(texts_too: bool):
    def work(ids, texts, rows):
        lo, hi = repeats.rows_of(ids, rows["doc"])
        n_words, n_removed, sha, kept = [], [], [], []
        for i, text in enumerate(texts):
            words = text.split()              # bytes: splits at 0x20 and 0x09-0x0D
            n_words.append(len(words))
            if lo[i] < hi[i]:
                gone = repeats.covered(len(words), rows["start"][lo[i]:hi[i]], rows["end"][lo[i]:hi[i]])
                words = [w for w, g in zip(words, gone.tolist()) if not g]
            n_removed.append(n_words[-1] - len(words))
            left = b" ".join(words)
            sha.append(hashlib.sha256(left).hexdigest())
            kept.append(left if texts_too else None)
        out = {"doc": pa.array(ids, pa.int64()), "n_words": pa.array(n_words, pa.int64()),
               "n_removed": pa.array(n_removed, pa.int64()), "kept_sha256": pa.array(sha, pa.string())}
        if texts_too:
            out["kept_text"] = pa.array(kept, pa.binary()).cast(pa.string())
        return pa.table(out)
    return work


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, gram: int = GRAM,
                   with_text: bool = False) -> DataFrame:
    """One row per document: id, n_words, n_removed, kept_sha256 and, on
    demand, kept_text (the kept words joined by one space)."""
    own, ids = repeats.in_order(docs, id_col, text_col)
    blocks = repeats.n_blocks(own)
    spans = cut_lineage(compact(repeated_edges(own, blocks, k, gram), k)).select("doc", "start", "end")
    schema = "doc long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text
    out = repeats.with_texts(own, spans, blocks, _remove(with_text), schema)
    return repeats.with_ids(out, ids, id_col)


def op4_substring_dedup(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20),
k AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 19], ' ')) AS m FROM p),
r AS (SELECT doc_id, i FROM k QUALIFY row_number() OVER (PARTITION BY m ORDER BY doc_id, i) > 1),
g AS (SELECT DISTINCT doc_id, i + o AS i FROM r, (SELECT unnest(range(20)) AS o)),
l AS (SELECT doc_id, list(i) AS gone FROM g GROUP BY doc_id),
x AS (SELECT d.doc_id, d.w, coalesce(l.gone, []) AS gone FROM d LEFT JOIN l USING (doc_id)),
y AS (SELECT doc_id, len(w)::BIGINT AS n_words, len(gone)::BIGINT AS n_removed,
             CASE WHEN len(gone) = 0 THEN w ELSE NULL END AS whole, w, gone FROM x),
u AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM y WHERE n_removed > 0),
s AS (SELECT u.doc_id, string_agg(word, ' ' ORDER BY u.i) AS t FROM u ANTI JOIN g ON u.doc_id = g.doc_id AND u.i = g.i
      GROUP BY u.doc_id)
SELECT y.doc_id, n_words, n_removed,
       sha256(CASE WHEN whole IS NOT NULL THEN coalesce(array_to_string(whole, ' '), '') ELSE coalesce(s.t, '') END)
         AS kept_sha256
FROM y LEFT JOIN s USING (doc_id)
"""
