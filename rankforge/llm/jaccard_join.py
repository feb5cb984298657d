"""N-gram Jaccard join with Bayesian candidate pruning (operator 3).

Texts are sets of shingles of ``N`` consecutive words; two texts are linked
when their Jaccard similarity is at least ``THRESHOLD``.

1. A task computes each text's MinHash signature and its band hashes.  Texts
   with equal shingle sets are one class, however many there are; from here on
   classes are compared, and their sizes count.
2. Classes that share a band are candidates.  A band with many members is
   reduced to a star inside each task before the shuffle and merged as a
   stream after it, and the stars' components group what may be compared.
   With 32 bands of 4 values a pair at the threshold is missed with a chance
   of 5e-8, at 0.85 of 1e-10.
3. Only texts of such groups are brought together, by group, and a group of
   more than ``BLOCK`` classes is dealt into pairs of blocks.  MinHash values
   are compared ``STEP`` at a time; after each step a pair whose posterior
   probability of reaching the threshold (uniform prior, so a beta posterior)
   is below ``TOLERANCE`` is dropped.  What is left is verified on the shingle
   sets.
4. A block pair returns link counts and a spanning forest, never the pairs;
   the forests give the components.

Defined results: a text of 1 to N-1 words has one shingle, all of them; null
and empty texts have no shingles, link with nothing and stay; the smallest id
of a component is kept, null ids sort last; rows that repeat an id are
separate rows, and ``drop_near_copies`` keeps one row of each component,
and on demand all without an id; an empty table gives an empty result; other columns are kept by
``drop_near_copies`` and not read otherwise.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankforge.llm import repeats
from rankforge.llm.graph import components, forest
from rankforge.llm.repeats import NULL_ID
from rankforge.llm.shared import byte_codes, cut_lineage, frugal, give_back, mix, slices, span_hash, unused, utf8, window_hash, with_row_key, word_bounds

N = 5
THRESHOLD = 0.8
BANDS, ROWS = 32, 4
STEP = 16
TOLERANCE = 1e-9
BLOCK = 1024
#: Rows of small groups that one task call takes together.
BUNDLE = 2048
_CODES = byte_codes(1)
_MULT = (mix(np.arange(1, 1025, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_PLUS = (mix(np.arange(5001, 6025, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)


def shingles(raw: np.ndarray, off: np.ndarray, n: int = N) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, document) of all shingles, in document order, with repeats."""
    start, end, doc = word_bounds(raw, off)
    words = span_hash(_CODES[raw], start, end)
    size = np.bincount(doc, minlength=len(off) - 1)
    first = np.concatenate([[0], np.cumsum(size)])
    h = window_hash(words, n)
    ok = doc[:len(h)] == doc[n - 1:n - 1 + len(h)]
    few = np.flatnonzero((size > 0) & (size < n))
    h = np.concatenate([h[ok], span_hash(words, first[few], first[few + 1])])
    d = np.concatenate([doc[:len(ok)][ok], few])
    order = np.argsort(d, kind="stable")
    return h[order], d[order]


def signatures(h: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """MinHash values, one row per segment of ``h`` that begins at ``at``."""
    x = (h >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(at), size), dtype=np.uint32)
    for k in range(size):
        out[:, k] = np.minimum.reduceat(x * _MULT[k] + _PLUS[k], at)
    return out


def _sets(h: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles per document, sorted."""
    order = np.lexsort((h, d))
    h, d = h[order], d[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    return h[new], d[new]


def _class_names(h: np.ndarray, at: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each set, and with them its size."""
    a = mix(np.add.reduceat(mix(h), at) + n.astype(np.uint64))
    b = mix(np.add.reduceat(mix(h ^ np.uint64(0x5DEECE66D)), at) + n.astype(np.uint64))
    return a.view(np.int64), b.view(np.int64)


def _describe(n: int, bands: int, rows: int) -> Callable:
    up = np.uint64(0x9E3779B97F4A7C15) ** np.arange(1, rows + 1, dtype=np.uint64)

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                ids = part.column(0).to_numpy()
                raw, off = utf8(part.column(1))
                h, d = _sets(*shingles(raw, off, n))
                count = np.bincount(d, minlength=len(ids))
                own = np.flatnonzero(count)
                a = b = np.zeros(len(ids), dtype=np.int64)
                band = [None] * len(ids)
                if len(own):
                    at = np.concatenate([[0], np.cumsum(count[own])[:-1]])
                    a, b = a.copy(), b.copy()
                    a[own], b[own] = _class_names(h, at, count[own])
                    sig = signatures(h, at, bands * rows).astype(np.uint64).reshape(len(own), bands, rows)
                    key = mix((sig * up).sum(axis=2, dtype=np.uint64) + np.arange(bands, dtype=np.uint64)).view(np.int64)
                    for i, k in zip(own, key):
                        band[i] = k
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids), pa.array(a), pa.array(b), pa.array(count.astype(np.int32)),
                     pa.array(band, pa.list_(pa.int64())), *part.columns[2:]],
                    names=["doc", "k1", "k2", "n", "bands", *part.schema.names[2:]])
    return run


def _stars(batches):
    """Band members to star edges inside a batch; each band's leader goes on."""
    for batch in batches:
        node = batch.column(0).to_numpy()
        band = batch.column(1).flatten().to_numpy()
        width = len(band) // max(1, len(node))
        node = np.repeat(node, width)
        order = np.lexsort((node, band))
        band, node = band[order], node[order]
        new = np.ones(len(band), dtype=bool)
        new[1:] = band[1:] != band[:-1]
        lead = node[np.maximum.accumulate(np.where(new, np.arange(len(band)), 0))]
        edge = node != lead
        keep = new | edge
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.where(new, band, mix(node.view(np.uint64)).view(np.int64))[keep]), pa.array(node[keep]),
             pa.array(lead[keep]), pa.array(edge[keep])], names=["h", "a", "b", "edge"])


def _merge_stars(batches):
    """Rows sorted by h: leaders of equal bands link to the first of them."""
    last = None
    for batch in batches:
        h, a, b = (batch.column(i).to_numpy() for i in range(3))
        edge = batch.column(3).to_numpy(zero_copy_only=False)
        ea, eb = a[edge], b[edge]
        h, a = h[~edge], a[~edge]
        if len(h):
            new = np.ones(len(h), dtype=bool)
            new[1:] = h[1:] != h[:-1]
            if last is not None:
                new[0] = h[0] != last[0]
            at = np.maximum.accumulate(np.where(new, np.arange(len(h)), -1))
            lead = np.where(at < 0, last[1] if last is not None else 0, a[at])
            ea, eb = np.concatenate([ea, a[~new]]), np.concatenate([eb, lead[~new]])
            last = (h[-1], lead[-1])
        yield pa.RecordBatch.from_arrays([pa.array(ea), pa.array(eb)], names=["a", "b"])


def _fetch(n: int):
    """Shingle sets of the wanted classes from their documents' texts."""
    names = ["grp", "node", "size", "set"]

    def work(ids, texts, rows):
        lo, hi = repeats.rows_of(ids, rows["doc"])
        out: dict = {c: [] for c in names}
        done = set()                                          # rows that share an id bring a class once
        for i, text in enumerate(texts):
            if lo[i] == hi[i]:
                continue
            raw, off = utf8(pa.array([text], pa.binary()))
            h, _ = _sets(*shingles(raw, off, n))
            if not len(h):
                continue
            name = _class_names(h, np.zeros(1, dtype=np.int64), np.array([len(h)]))[0][0]
            for r in range(lo[i], hi[i]):
                if rows["node"][r] == name and r not in done:     # rows may share an id but not a text
                    done.add(r)
                    for c, x in zip(names, (rows["grp"][r], name, rows["size"][r], h.tobytes())):
                        out[c].append(x)
        return pa.table({c: pa.array(out[c], t) for c, t in zip(names, (pa.int64(),) * 3 + (pa.binary(),))})
    return work


def min_matches(steps: int, step: int, threshold: float, tolerance: float) -> list[int]:
    """Fewest matches among the first step, 2 step, ... values at which a pair
    still reaches the threshold with a posterior probability of ``tolerance``.
    With a uniform prior the posterior after m of n is Beta(m+1, n-m+1), and
    P(J >= t) = P(Binomial(n+1, t) <= m)."""
    out = []
    for k in range(1, steps + 1):
        n, total, m = k * step + 1, 0.0, 0
        p = (1 - threshold) ** n
        while True:
            total += p
            if total >= tolerance:
                break
            p *= (n - m) / (m + 1) * threshold / (1 - threshold)
            m += 1
        out.append(m)
    return out


def linked_pairs(sets_a: list, sig_a: np.ndarray, sets_b: list, sig_b: np.ndarray, same: bool, threshold: float,
                 tolerance: float, step: int = STEP) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs of two blocks (i < j within one block)."""
    na, nb = np.array([len(s) for s in sets_a]), np.array([len(s) for s in sets_b])
    least = min_matches(sig_a.shape[1] // step, step, threshold, tolerance)
    match = np.zeros((len(na), len(nb)), dtype=np.uint8)
    for k in range(step):
        match += sig_a[:, k, None] == sig_b[None, :, k]
    live = (match >= least[0]) & (np.minimum(na[:, None], nb) >= threshold * np.maximum(na[:, None], nb) - 1e-9)
    if same:
        live &= np.triu(np.ones(live.shape, dtype=bool), 1)
    i, j = np.nonzero(live)
    m = match[i, j].astype(np.int64)
    for k in range(1, len(least)):
        if not len(i):
            break
        cut = slice(k * step, (k + 1) * step)
        for s in range(0, len(i), 1 << 16):
            m[s:s + (1 << 16)] += (sig_a[i[s:s + (1 << 16)], cut] == sig_b[j[s:s + (1 << 16)], cut]).sum(axis=1)
        ok = m >= least[k]
        i, j, m = i[ok], j[ok], m[ok]
    if not len(i):
        return i, j
    # exact check: mark one set, count the marks in each partner
    uniq, inv = np.unique(np.concatenate(sets_a + ([] if same else sets_b)), return_inverse=True)
    cut_at = np.cumsum(np.concatenate([na, [] if same else nb]).astype(np.int64))[:-1]
    flat = np.split(inv, cut_at)
    fa, fb = flat[:len(na)], flat if same else flat[len(na):]
    mark, good = np.zeros(len(uniq), dtype=np.int64), np.zeros(len(i), dtype=bool)
    for s in np.flatnonzero(np.append(True, i[1:] != i[:-1])):
        e = s + np.searchsorted(i[s:], i[s], side="right")
        mark[fa[i[s]]] = 1
        for c in range(s, e, 512):
            js = j[c:min(e, c + 512)]
            at = np.concatenate([[0], np.cumsum(nb[js])[:-1]])
            both = np.add.reduceat(mark[np.concatenate([fb[x] for x in js])], at)
            good[c:c + len(js)] = both >= threshold * (na[i[s]] + nb[js] - both) - 1e-9
        mark[fa[i[s]]] = 0
    return i[good], j[good]


def _compare(size: int, threshold: float, tolerance: float):
    def side(pdf):
        sets = [np.frombuffer(x, dtype=np.uint64) for x in pdf["set"]]
        at = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]]).astype(np.int64)
        return sets, signatures(np.concatenate(sets), at, size), pdf["size"].to_numpy(), pdf["node"].to_numpy()

    def pairs(left, right, same):
        sa, ga, wa, node_a = side(left)
        sb, gb, wb, node_b = (sa, ga, wa, node_a) if same else side(right)
        i, j = linked_pairs(sa, ga, sb, gb, same, threshold, tolerance)
        if not len(i):
            return []
        shift = 0 if same else len(node_a)
        node = node_a if same else np.concatenate([node_a, node_b])
        links = np.bincount(i, weights=wb[j], minlength=len(node)) \
            + np.bincount(j + shift, weights=wa[i], minlength=len(node))
        root = forest(i, j + shift, len(node))
        hit = np.flatnonzero(links > 0)
        return [pd.DataFrame({"node": node[hit], "links": links[hit].astype(np.int64), "top": node[root[hit]]})]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        if pdf["b1"].iloc[0] < 0:                             # a bundle of small groups
            for _, own in pdf.groupby("grp", sort=False):
                out += pairs(own, own, True)
        elif pdf["b1"].iloc[0] == pdf["b2"].iloc[0]:
            out += pairs(pdf, pdf, True)
        else:
            out += pairs(pdf[pdf["block"] == pdf["b1"]], pdf[pdf["block"] == pdf["b2"]], False)
        give_back()
        return pd.concat(out) if out else pd.DataFrame({"node": [], "links": [], "top": []}, dtype="int64")
    return run


def jaccard_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N,
                    threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS,
                    tolerance: float = TOLERANCE, block: int = BLOCK, row_col: str | None = None) -> DataFrame:
    """One row per document: id, n_links, component_id, class_id (the smallest
    id with the same shingles), class_size, kept.  With ``row_col``, a key of
    the rows, that too, and kept holds for one row of a component."""
    more = ["row"] if row_col else []
    own = repeats.slim(docs, id_col, text_col, *[F.col(row_col).alias(c) for c in more])
    facts = cut_lineage(own.mapInArrow(frugal(_describe(n, bands, rows)),
                                       "doc long, k1 long, k2 long, n int, bands array<long>" + ", row string" * len(more)))
    first = [F.min(F.struct("doc", c)).getField(c).alias(c) for c in more]
    classes = cut_lineage(facts.where("n > 0").groupBy("k1", "k2")
                          .agg(F.min("doc").alias("doc"), F.count("*").alias("size"), *first))

    stars = facts.where("n > 0").select("k1", "bands").mapInArrow(frugal(_stars), "h long, a long, b long, edge boolean")
    edges = stars.repartition("h").sortWithinPartitions("h", "a").mapInArrow(frugal(_merge_stars), "a long, b long")
    groups = components(edges).withColumnRenamed("component", "grp")
    wanted = cut_lineage(classes.join(groups, F.col("k1") == F.col("node"))
                         .select("doc", "node", "grp", "size", F.lit(0).alias("start")))

    sets = repeats.with_texts(own, wanted, repeats.n_blocks(own), _fetch(n),
                              "grp long, node long, size long, set binary")
    sets = cut_lineage(sets)
    count = sets.groupBy("grp").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    bundles = 1 + sets.count() // BUNDLE
    dealt = sets.join(count, "grp").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    small = F.col("blocks") == 1
    dealt = dealt.select(
        F.when(small, F.pmod(F.xxhash64("grp"), F.lit(bundles))).otherwise(F.col("grp")).alias("tile"),
        F.when(small, -1).otherwise(F.least("block", "other")).alias("b1"),
        F.when(small, -1).otherwise(F.greatest("block", "other")).alias("b2"), "block", "grp", "node", "size", "set")
    found = cut_lineage(dealt.groupBy("tile", "b1", "b2").applyInPandas(
        _compare(bands * rows, threshold, tolerance), "node long, links long, top long"))

    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    comp = components(found.select(F.col("node").alias("a"), F.col("top").alias("b")))
    result = classes.join(links, F.col("k1") == F.col("node"), "left").drop("node") \
        .join(comp, F.col("k1") == F.col("node"), "left") \
        .select("k1", F.col("doc").alias("class_doc"), "size", F.coalesce("links", F.lit(0)).alias("links"),
                F.coalesce("component", "k1").alias("component"), *[F.col(c).alias("class_row") for c in more])
    first = [F.min(F.struct("class_doc", "class_row")).getField("class_row").alias("least_row") for _ in more]
    least = result.groupBy("component").agg(F.min("class_doc").alias("least"), *first)
    result = result.join(least, "component")
    out = facts.where("n > 0").select("doc", "k1", *more).join(result, "k1").select(
        "doc", (F.col("links") + F.col("size") - 1).cast("long").alias("n_links"), F.col("least").alias("component_id"),
        F.col("class_doc").alias("class_id"), F.col("size").alias("class_size"),
        *more, *[F.col("least_row") for _ in more])
    alone = facts.where("n = 0").select("doc", F.lit(0).cast("long"), "doc", "doc", F.lit(1).cast("long"), *more, *more)
    out = out.union(alone)
    back = lambda c: F.when(F.col(c) != NULL_ID, F.col(c))
    return out.select(back("doc").alias(id_col), "n_links", back("component_id").alias("component_id"),
                      back("class_id").alias("class_id"), "class_size",
                      (F.col("row") == F.col("least_row") if more else F.col("doc") == F.col("component_id")).alias("kept"),
                      *[F.col(c).alias(row_col) for c in more])


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_no_id: bool = True,
                     **options) -> DataFrame:
    """One document of each component, with all columns; rows without an id
    stay too unless ``keep_no_id`` is false."""
    row = unused(docs, "__row")
    own = with_row_key(docs, row)
    gone = jaccard_classes(own, id_col, text_col, row_col=row, **options).where("not kept")
    gone = (gone.where(F.col(id_col).isNotNull()) if keep_no_id else gone).select(row)
    return own.join(gone, row, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def op3_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return jaccard_classes(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS a FROM documents),
g AS (
  SELECT DISTINCT doc_id, CASE WHEN len(a) < 5 THEN array_to_string(a, ' ')
         ELSE array_to_string(a[i:i + 4], ' ') END AS s
  FROM (SELECT doc_id, a, unnest(range(1, greatest(2, len(a) - 3))) AS i FROM w WHERE len(a) > 0)),
n AS (SELECT doc_id, count(*) AS n, md5(string_agg(s, chr(10) ORDER BY s)) AS k FROM g GROUP BY doc_id),
c AS (SELECT k, any_value(n) AS n, min(doc_id) AS class_id, count(*) AS class_size FROM n GROUP BY k),
q AS (SELECT n.k, g.s FROM g JOIN n USING (doc_id) JOIN c ON c.k = n.k AND c.class_id = g.doc_id),
f AS (SELECT *, row_number() OVER (PARTITION BY q.k ORDER BY m, s) AS r FROM
        (SELECT q.*, count(*) OVER (PARTITION BY s) AS m FROM q) q),
p AS (SELECT DISTINCT x.k AS x, y.k AS y FROM f x JOIN f y ON x.s = y.s AND x.k < y.k
      JOIN c cx ON cx.k = x.k JOIN c cy ON cy.k = y.k
      WHERE x.r <= cx.n - ceil(0.8 * cx.n) + 1 AND y.r <= cy.n - ceil(0.8 * cy.n) + 1
        AND least(cx.n, cy.n) >= 0.8 * greatest(cx.n, cy.n)),
v AS (SELECT p.x, p.y, count(*) AS common FROM p JOIN q a ON a.k = p.x JOIN q b ON b.k = p.y AND b.s = a.s GROUP BY p.x, p.y),
l AS MATERIALIZED (
  SELECT x, y FROM (SELECT v.x, v.y FROM v JOIN c a ON a.k = v.x JOIN c b ON b.k = v.y
                    WHERE 5 * common >= 4 * (a.n + b.n - common)) t
  UNION ALL SELECT y, x FROM (SELECT v.x, v.y FROM v JOIN c a ON a.k = v.x JOIN c b ON b.k = v.y
                    WHERE 5 * common >= 4 * (a.n + b.n - common)) t),
r AS (
  WITH RECURSIVE reach(x, y) AS (SELECT k, k FROM c UNION SELECT reach.x, l.y FROM reach JOIN l ON reach.y = l.x)
  SELECT reach.x, min(c.class_id) AS component_id FROM reach JOIN c ON c.k = reach.y GROUP BY reach.x),
s AS (SELECT l.x, sum(c.class_size)::BIGINT AS links FROM l JOIN c ON c.k = l.y GROUP BY l.x)
SELECT n.doc_id, (coalesce(s.links, 0) + c.class_size - 1)::BIGINT AS n_links, r.component_id, c.class_id, c.class_size,
       n.doc_id = r.component_id AS kept
FROM n JOIN c USING (k) JOIN r ON r.x = n.k LEFT JOIN s ON s.x = n.k
UNION ALL SELECT doc_id, 0, doc_id, doc_id, 1, true FROM w WHERE len(a) = 0
"""
