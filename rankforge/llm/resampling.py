"""Importance resampling to a target distribution over hashed n-grams
(operator 13).

A document's features are its runs of ``1`` to ``max_n`` consecutive words,
hashed into buckets by CRC-32.  The words are joined by one separator and the
joined document is scanned once: the running CRC is stored at every word's
start and end.  The CRC of any run of words then follows from two stored
values, as CRC is linear over GF(2): appending ``k`` bytes to a prefix
multiplies its part of the CRC by x^(8k), so

    crc(run) = crc(prefix up to the run's end) xor shift(crc(prefix up to its start), k)

and no n-gram is ever built or hashed as a string.

Two count passes give every bucket's share in the corpus and in the target
texts; each task adds its own buckets, so at most ``buckets`` rows leave it.
A bucket's gain is the floored thousandfold log ratio of both smoothed shares,
and a document's weight the floored mean of its features' gains.  Adding
Gumbel noise, drawn from the SHA-256 of seed and id, to the weight makes
"the highest scores" a sample without replacement in proportion to
exp(weight / 1000) (Gumbel top-k).

The sample is cut by a histogram of the scores, whose number of values is
bounded by the largest gain and the range of 32-bit noise; only the rows at or
above the cut are sorted, by range, and a row's rank is its place in its
partition plus the rows of the partitions before.  No task sees more than its
share of rows, whatever scores or ids repeat.

Defined results: null and empty texts have no features and weight 0; a null id
draws like the text ``null`` and sorts last; rows that repeat an id are
separate rows, and rows alike in all values take neighbouring ranks; texts of
any length are scanned in pieces cut between words; an empty corpus gives an
empty result and an empty target a gain for absence only; other columns are
not read.
"""

from __future__ import annotations

import math
import re
from itertools import accumulate
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankforge.llm.shared import cut_lineage, frugal, slices, utf8

BUCKETS = 10_000
MAX_N = 1
LEAST_WORDS = 20
PERCENT = 10
SEED = "2024"

#: Bytes of one document scanned at once; longer ones are cut between words.
PIECE = 1 << 19
#: ASCII letters in lower case and digits stay, other ASCII separates words,
#: bytes of all other characters belong to words.
_WORDS = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x61 <= c <= 0x7A or 0x30 <= c <= 0x39 else 0x20
               for c in range(256))
_TOKEN = re.compile(rb" ?[^ ]+")
_POLY = 0xEDB88320                                             # CRC-32, reflected
_FULL = np.uint32(0xFFFFFFFF)


def _byte_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & np.uint32(1), (t >> np.uint32(1)) ^ np.uint32(_POLY), t >> np.uint32(1))
    return t


_STEP = _byte_table()


class Shift:
    """Multiplication of CRCs by x^(8k) modulo the CRC polynomial, for arrays
    of CRCs and byte counts k: one table look-up per byte of the CRC for each
    binary digit of k."""

    def __init__(self) -> None:
        one = np.uint32(1) << np.arange(32, dtype=np.uint32)
        self._columns = [_STEP[one & np.uint32(255)] ^ (one >> np.uint32(8))]      # k = 1
        self._tables = [self._table(self._columns[0])]

    @staticmethod
    def _table(columns: np.ndarray) -> np.ndarray:
        out = np.zeros((4, 256), dtype=np.uint32)
        byte = np.arange(256)
        for bit in range(8):
            out[:, byte >> bit & 1 == 1] ^= columns.reshape(4, 8)[:, bit][:, None]
        return out

    @staticmethod
    def _apply(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
        parts = crc.astype("<u4").view(np.uint8).reshape(-1, 4)
        return table[0][parts[:, 0]] ^ table[1][parts[:, 1]] ^ table[2][parts[:, 2]] ^ table[3][parts[:, 3]]

    def __call__(self, crc: np.ndarray, k: np.ndarray) -> np.ndarray:
        out, most = crc.copy(), int(k.max()) if len(k) else 0
        for digit in range(most.bit_length()):
            if digit == len(self._tables):                     # twice the shift: the operator applied to itself
                self._columns.append(self._apply(self._tables[-1], self._columns[-1]))
                self._tables.append(self._table(self._columns[-1]))
            on = np.flatnonzero(k >> digit & 1)
            out[on] = self._apply(self._tables[digit], out[on])
        return out


_shift = Shift()


def _after_space(crc: np.ndarray) -> np.ndarray:
    """Running CRC one separator further on."""
    raw = crc ^ _FULL
    return (_STEP[(raw ^ np.uint32(0x20)) & np.uint32(255)] ^ (raw >> np.uint32(8))) ^ _FULL


def _pieces(text: bytes):
    """The text cut into pieces of about ``PIECE`` bytes, between words."""
    at = 0
    while at < len(text):
        end = at + PIECE
        if end < len(text):
            end = text.find(b" ", end)
            end = len(text) if end < 0 else end
        yield text[at:end]
        at = end


def prefix_scan(texts: list[bytes], max_n: int = MAX_N):
    """Yield (document, crc) arrays of all features, and the number of words
    by document: ``(doc, crc, n_words)``, the last one per document of the
    yielded piece.  Every text is scanned once from left to right."""
    group, room = [], 0
    for i, text in enumerate(texts):
        mapped = text.translate(_WORDS)
        if len(mapped) > PIECE:
            yield from _scan_long(i, mapped, max_n)
            continue
        group.append((i, mapped))
        room += len(mapped)
        if room > PIECE:
            yield _scan(group, max_n)
            group, room = [], 0
    if group:
        yield _scan(group, max_n)


def _running(words: list[bytes], before: int) -> list[int]:
    """The running CRC behind each word; every word but a document's first
    carries its separator in front."""
    return list(accumulate(words, lambda crc, word: crc32(word, crc), initial=before))[1:]


def _tokens(mapped: bytes, first: bool) -> list[bytes]:
    words = _TOKEN.findall(mapped)
    if words and words[0][:1] == b" " and first:
        words[0] = words[0][1:]
    elif words and words[0][:1] != b" " and not first:
        words[0] = b" " + words[0]
    return words


def _grams(doc, start_crc, end_crc, start, end, max_n: int, new: int = 0):
    """Features of runs of words; only those that end at word ``new`` or later."""
    docs, crcs = [], []
    for n in range(1, max_n + 1):
        i = np.arange(max(0, new - n + 1), len(doc) - n + 1)
        i = i[doc[i] == doc[i + n - 1]] if len(i) else i
        j = i + n - 1
        docs.append(doc[i])
        crcs.append(end_crc[j] ^ _shift(start_crc[i], end[j] - start[i]))
    return np.concatenate(docs), np.concatenate(crcs)


def _scan(group, max_n: int):
    ends, lengths, counts = [], [], []
    for _, mapped in group:
        words = _tokens(mapped, True)
        ends += _running(words, 0)
        lengths += map(len, words)
        counts.append(len(words))
    doc = np.repeat(np.array([i for i, _ in group], dtype=np.int64), counts)
    end_crc = np.array(ends, dtype=np.uint32)
    end = np.cumsum(np.array(lengths, dtype=np.int64)) if lengths else np.zeros(0, dtype=np.int64)
    head = np.ones(len(doc), dtype=bool)
    head[1:] = doc[1:] != doc[:-1]
    start_crc = np.zeros(len(doc), dtype=np.uint32)
    start_crc[1:] = _after_space(end_crc[:-1])
    start_crc[head] = 0
    start = end - np.array(lengths, dtype=np.int64) + ~head
    docs, crcs = _grams(doc, start_crc, end_crc, start, end, max_n)
    return docs, crcs, dict(zip((i for i, _ in group), counts))


def _scan_long(i: int, mapped: bytes, max_n: int):
    """A long document piece by piece: the running CRC goes on, and the last
    ``max_n - 1`` words are kept for runs across pieces."""
    crc, at = 0, 0
    kept = tuple(np.zeros(0, dtype=t) for t in (np.uint32, np.uint32, np.int64, np.int64))
    for piece in _pieces(mapped):
        words = _tokens(piece, at == 0)
        if not words:
            continue
        end_crc = np.array(_running(words, crc), dtype=np.uint32)
        length = np.array([len(w) for w in words], dtype=np.int64)
        end = at + np.cumsum(length)
        gap = np.ones(len(words), dtype=np.int64)
        gap[0] = at > 0
        start_crc = np.concatenate([np.array([crc], dtype=np.uint32), end_crc[:-1]])
        start_crc = np.where(gap == 1, _after_space(start_crc), np.uint32(0))
        now = (start_crc, end_crc, end - length + gap, end)
        crc, at = int(end_crc[-1]), int(end[-1])
        both = tuple(np.concatenate(x) for x in zip(kept, now))
        docs, crcs = _grams(np.full(len(both[0]), i), *both, max_n, new=len(kept[0]))
        yield docs, crcs, {i: len(words)}
        kept = tuple(x[len(x) - min(len(x), max_n - 1):] for x in both)


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    data, off = utf8(batch.column(batch.schema.get_field_index("text")))
    raw = data.tobytes()
    return [raw[a:b] for a, b in zip(off[:-1].tolist(), off[1:].tolist())]


def _text(df: DataFrame, text_col: str):
    return F.col(text_col).cast("string").alias("text")


def bucket_counts(df: DataFrame, text_col: str = "text", max_n: int = MAX_N, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): how many features fall into each bucket that has any."""
    def count(batches):
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for part in slices(batch):
                for _, crc, _ in prefix_scan(_texts(part), max_n):
                    total += np.bincount(crc % np.uint32(buckets), minlength=buckets)
        has = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(has, pa.int64()), pa.array(total[has], pa.int64())], ["bucket", "n"])

    return df.select(_text(df, text_col)).mapInArrow(frugal(count), "bucket long, n long") \
        .groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, text_col: str = "text", target_col: str = "text",
          max_n: int = MAX_N, buckets: int = BUCKETS) -> np.ndarray:
    """The gain of every bucket; both count tables have ``buckets`` rows at most."""
    def of(df: DataFrame, col: str) -> list[int]:
        n = [0] * buckets
        for r in bucket_counts(df, col, max_n, buckets).collect():
            n[r.bucket] = r.n
        return n

    s, t = of(docs, text_col), of(target, target_col)
    all_s, all_t = sum(s), sum(t)
    return np.array([math.floor(1000 * math.log(float((b + 1) * (all_s + buckets)) / float((a + 1) * (all_t + buckets))))
                     for a, b in zip(s, t)], dtype=np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text", max_n: int = MAX_N) -> DataFrame:
    """(id, n_words, n_features, weight) of every document."""
    buckets = len(gain)

    def work(batches):
        for batch in batches:
            for part in slices(batch):
                rows = part.num_rows
                words, n, total = (np.zeros(rows, dtype=np.int64) for _ in range(3))
                for doc, crc, counts in prefix_scan(_texts(part), max_n):
                    for i, c in counts.items():
                        words[i] += c
                    n += np.bincount(doc, minlength=rows)
                    np.add.at(total, doc, gain[crc % np.uint32(buckets)])
                yield pa.RecordBatch.from_arrays(
                    [part.column(part.schema.get_field_index("id")), pa.array(words), pa.array(n),
                     pa.array(np.where(n > 0, total // np.maximum(n, 1), 0))], ["id", "n_words", "n_features", "weight"])

    kind = docs.select(id_col).schema[0].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), _text(docs, text_col)).mapInArrow(
        frugal(work), f"id {kind}, n_words long, n_features long, weight long")


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
             max_n: int = MAX_N, buckets: int = BUCKETS, least_words: int = LEAST_WORDS, percent: int = PERCENT,
             seed: str = SEED) -> DataFrame:
    """One row per document: id, n_features, weight, score, rank (null: not drawn)."""
    spark = docs.sparkSession
    gain = gains(docs, target, text_col, target_col, max_n, buckets)
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("long").cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")
    rows = cut_lineage(weigh(docs, gain, id_col, text_col, max_n).withColumn("score", F.col("weight") + noise))

    values = ["id", "n_features", "weight", "score"]
    fit = F.col("n_words") >= least_words
    histogram = rows.where(fit).groupBy("score").count().orderBy(F.desc("score")).collect()
    draw, cut, seen = sum(r["count"] for r in histogram) * percent // 100, None, 0
    for r in histogram:
        if seen >= draw:
            break
        cut, seen = r["score"], seen + r["count"]
    if cut is None:
        return rows.select(F.col("id").alias(id_col), *values[1:], F.lit(None).cast("long").alias("rank"))

    ahead = fit & (F.col("score") >= cut)
    order = [F.desc("score"), F.col("id").asc_nulls_last(), "n_features", "weight"]
    best = cut_lineage(rows.where(ahead).select(*values).orderBy(*order))
    placed = best.withColumn("__at", F.monotonically_increasing_id()).withColumn("part", F.shiftright("__at", 33))
    per_part = placed.groupBy("part").agg(F.count("*").alias("n"))                 # one row per partition
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = per_part.select("part", F.coalesce(before, F.lit(0)).alias("before"))
    rank = F.col("before") + F.col("__at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    ranked = placed.join(F.broadcast(offsets), "part").select(
        *values, F.when(rank <= draw, rank).cast("long").alias("rank"))
    rest = rows.where(~ahead).select(*values, F.lit(None).cast("long").alias("rank"))
    return ranked.unionByName(rest).select(F.col("id").alias(id_col), *values[1:], "rank")


def op13_importance_resampling(spark, sf_dir: str) -> DataFrame:
    return resample(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


SQL = r"""
WITH RECURSIVE t0(v, c, r) AS (
  SELECT i::BIGINT, i::BIGINT, 0 FROM range(256) AS q(i)
  UNION ALL
  SELECT v, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384::BIGINT) ELSE c // 2 END, r + 1 FROM t0 WHERE r < 8),
tab AS MATERIALIZED (SELECT list(c ORDER BY v) AS tab FROM t0 WHERE r = 8),
d AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS MATERIALIZED (
  SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM benchmark),
f AS MATERIALIZED (SELECT rid, unnest(w) AS word FROM d),
v AS MATERIALIZED (SELECT DISTINCT word, hex(encode(word)) AS h FROM (SELECT word FROM f UNION ALL SELECT word FROM b)),
k AS MATERIALIZED (
  SELECT word, xor(list_reduce(
           list_prepend(4294967295::BIGINT,
                        list_transform(range(length(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT)),
           lambda c, x: xor(tab[xor(c % 256, x) + 1], c // 256)), 4294967295::BIGINT) % 10000 AS bucket
  FROM v, tab),
s AS (SELECT bucket, count(*) AS n FROM f JOIN k USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM b JOIN k USING (word) GROUP BY bucket),
g AS MATERIALIZED (
  SELECT q.bucket, floor(1000 * ln(
           ((coalesce(t.n, 0) + 1) * ((SELECT coalesce(sum(n), 0) FROM s) + 10000))::DOUBLE
           / ((coalesce(s.n, 0) + 1) * ((SELECT coalesce(sum(n), 0) FROM t) + 10000))::DOUBLE))::BIGINT AS gain
  FROM (SELECT unnest(range(10000)) AS bucket) q LEFT JOIN s ON s.bucket = q.bucket LEFT JOIN t ON t.bucket = q.bucket),
wt AS (SELECT f.rid, sum(g.gain) AS total, count(*) AS n FROM f JOIN k USING (word) JOIN g USING (bucket) GROUP BY f.rid),
sc AS (
  SELECT d.rid, d.doc_id, len(d.w)::BIGINT AS n_features,
         CASE WHEN wt.n IS NULL THEN 0 ELSE floor(wt.total::DOUBLE / wt.n)::BIGINT END AS weight,
         ('0x' || substr(sha256('2024:' || coalesce(d.doc_id::VARCHAR, 'null')), 1, 8))::BIGINT AS h
  FROM d LEFT JOIN wt USING (rid)),
z AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM sc),
r AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST, n_features, weight) AS place,
             count(*) OVER (PARTITION BY n_features >= 20) AS n FROM z)
SELECT doc_id, n_features, weight, score,
       CASE WHEN n_features >= 20 AND place <= (10 * n) // 100 THEN place END AS rank
FROM r
"""
