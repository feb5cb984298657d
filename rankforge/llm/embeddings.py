"""Embedding near-dedup by spherical k-means cells (operator 7).

1. Vectors with the same label and identical components are one class; a class
   of copies, however large, is counted and represented by one vector.
2. Labels with many classes are split into cells by spherical k-means.  The
   centroids are trained on a bounded sample, at most ``SAMPLE_PER_CELL``
   vectors for each of at most ``2 * MAX_CELLS`` cells, which also bounds the
   centroid table that tasks get by broadcast.
3. Every vector goes to its own cell and visits each higher-numbered cell in
   which a vector within the threshold could live: if ``u`` lies in cell c and
   is linked with ``v`` of cell a, then ``v`` is at most |u - v| away from the
   bisector between both centroids.  So no link is lost to a cell border, and
   each pair meets in one cell only.
4. A cell is dealt into blocks of about ``BLOCK`` vectors; pairs of blocks are
   compared by one matrix product.  A block pair returns link counts and a
   spanning forest of its links, never the pairs.
5. The forests give the components.

Defined results: null, empty and zero vectors, vectors with null or non-finite
components and vectors without a label link with nothing and stay; vectors of
different length never link; vectors of any finite magnitude compare alike; rows that repeat an id are separate vectors; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankforge.llm.graph import components, forest
from rankforge.llm.shared import cut_lineage

THRESHOLD = 0.93
#: Bounds the centroid table; larger inputs get larger cells of more blocks.
MAX_CELLS = 2048
CELL_SIZE = 1024
SAMPLE_PER_CELL = 32
ROUNDS = 8
BLOCK = 2048
_TILE = 1024


def unit_rows(vectors) -> np.ndarray:
    """Rows of length one.  They are scaled by a power of two first, which is
    exact and keeps squares of very small and very large entries in range."""
    x = np.array([np.asarray(v, dtype=np.float64) for v in vectors])
    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = ROUNDS, seed: int = 7) -> np.ndarray:
    """Unit centroids of unit rows; empty cells keep their last centroid."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), size=min(k, len(x)), replace=False)]
    for _ in range(rounds):
        own = np.concatenate([np.argmax(x[i:i + 4096] @ c.T, axis=1) for i in range(0, len(x), 4096)])
        total = np.zeros_like(c)
        np.add.at(total, own, x)
        norm = np.sqrt((total * total).sum(axis=1))
        c = np.where(norm[:, None] > 1e-12, total / np.maximum(norm, 1e-12)[:, None], c)
    return c


def _train(cells: int, rounds: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        c = spherical_kmeans(unit_rows(pdf.sort_values("row")["vec"]), max(2, math.ceil(pdf["n"].iloc[0] / cells)), rounds)
        return pd.DataFrame({"label": pdf["label"].iloc[0], "dim": pdf["dim"].iloc[0], "cell": range(len(c)),
                             "vec": list(c)})
    return run


def _assign(shared, threshold: float):
    reach = math.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-9

    def run(frames):
        by = shared.value
        for pdf in frames:
            out = []
            for (label, dim), own in pdf.groupby(["label", "dim"], sort=False):
                c = by.get((label, int(dim)))
                own = own[["label", "dim", "row", "n", "vec"]].copy()
                if c is None:
                    out.append(own.assign(cell=0, home=True))
                    continue
                x = unit_rows(own["vec"])
                s = x @ c.T
                a = np.argmax(s, axis=1)
                gap = np.sqrt(np.maximum(2 - 2 * (c @ c.T), 0))[a]
                near = (s[np.arange(len(x)), a][:, None] - s) <= reach * gap
                near &= np.arange(len(c))[None, :] > a[:, None]
                who, cell = np.nonzero(near)
                out.append(own.assign(cell=a, home=True))
                if len(who):
                    out.append(own.iloc[who].assign(cell=cell, home=False))
            if out:
                got = pd.concat(out)
                got["cell"] = got["cell"].astype("int32")
                yield got[["label", "dim", "cell", "home", "row", "n", "vec"]]
    return run


def _compare(threshold: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        one = pdf["b1"].iloc[0] == pdf["b2"].iloc[0]
        left = pdf if one else pdf[pdf["block"] == pdf["b1"]]
        right = pdf if one else pdf[pdf["block"] == pdf["b2"]]
        x, y = unit_rows(left["vec"]), unit_rows(right["vec"])
        hx, hy = left["home"].to_numpy(), right["home"].to_numpy()
        nx, ny = left["n"].to_numpy(), right["n"].to_numpy()
        cx, cy = np.zeros(len(x), dtype=np.int64), np.zeros(len(y), dtype=np.int64)
        root = np.arange(len(x) + len(y))
        for i in range(0, len(x), _TILE):
            for j in range(i if one else 0, len(y), _TILE):
                hit = x[i:i + _TILE] @ y[j:j + _TILE].T >= threshold
                hit &= hx[i:i + _TILE, None] | hy[None, j:j + _TILE]      # two visitors meet elsewhere
                if one and i == j:
                    hit &= np.triu(np.ones(hit.shape, dtype=bool), 1)
                cx[i:i + _TILE] += hit @ ny[j:j + _TILE]
                cy[j:j + _TILE] += nx[i:i + _TILE] @ hit
                a, b = np.nonzero(hit)
                if len(a):
                    a, b = a + i, b + j + (0 if one else len(x))
                    step = forest(root[a], root[b], len(root))
                    root = step[root]
        rows = left["row"].to_numpy() if one else np.concatenate([left["row"], right["row"]])
        count = cx + cy if one else np.concatenate([cx, cy])
        hit = np.flatnonzero(count > 0)
        return pd.DataFrame({"row": rows[hit], "links": count[hit], "top": rows[root[hit]]})
    return run


def near_vectors(table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                 threshold: float = THRESHOLD, cell_size: int = CELL_SIZE, block: int = BLOCK,
                 rounds: int = ROUNDS) -> DataFrame:
    """One row per vector: id, n_links, component_id, kept."""
    spark = table.sparkSession
    v = F.col(vec_col).cast("array<double>")
    good = F.col(label_col).isNotNull() & v.isNotNull() & F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = cut_lineage(table.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"),
        F.col(label_col).cast("string").alias("label"), F.when(F.coalesce(good, F.lit(False)), v).alias("vec")))
    named = F.xxhash64("label", "vec")
    classes = cut_lineage(rows.where("vec is not null").groupBy("label", "vec")
                          .agg(F.min("row").alias("row"), F.count("*").alias("n"))
                          .withColumn("dim", F.size("vec")))

    sizes = classes.groupBy("label", "dim").agg(F.count("*").alias("size"))
    total = sizes.agg(F.sum("size")).first()[0] or 0
    cell_size = max(cell_size, -(-total // MAX_CELLS))
    large = sizes.where(F.col("size") > cell_size)               # at most MAX_CELLS rows
    sample = classes.join(F.broadcast(large), ["label", "dim"]).where(
        F.pmod(F.xxhash64("vec"), F.lit(1 << 30)) <
        F.least(F.lit(1.0), F.lit(2.0 * SAMPLE_PER_CELL / cell_size)) * float(1 << 30))
    trained = sample.select("label", "dim", "row", "vec", F.col("size").alias("n")).groupBy("label", "dim") \
        .applyInPandas(_train(cell_size, rounds), "label string, dim int, cell int, vec array<double>")
    by: dict = {}
    for r in trained.orderBy("label", "dim", "cell").toLocalIterator():
        by.setdefault((r.label, r.dim), []).append(r.vec)
    shared = spark.sparkContext.broadcast({k: np.array(x) for k, x in by.items()})

    placed = cut_lineage(classes.mapInPandas(
        _assign(shared, threshold),
        "label string, dim int, cell int, home boolean, row long, n long, vec array<double>"))
    blocks = placed.groupBy("label", "dim", "cell").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    dealt = placed.join(blocks, ["label", "dim", "cell"]) \
        .withColumn("block", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))) \
        .select("label", "dim", "cell", F.least("block", "other").alias("b1"), F.greatest("block", "other").alias("b2"),
                "block", "home", "row", "n", "vec")
    found = cut_lineage(dealt.groupBy("label", "dim", "cell", "b1", "b2")
                        .applyInPandas(_compare(threshold), "row long, links long, top long"))

    links = found.groupBy("row").agg(F.sum("links").alias("links"))
    comp = components(found.select(F.col("row").alias("a"), F.col("top").alias("b")))
    reps = classes.select("row", "n", named.alias("name"), "label", "vec") \
        .join(links, "row", "left").join(comp.withColumnRenamed("node", "row"), "row", "left") \
        .select("label", "vec", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).cast("long").alias("n_links"),
                F.coalesce("component", "row").alias("component"))
    placed_rows = rows.alias("r").join(
        reps.alias("c"), (F.col("r.label") == F.col("c.label")) & (F.col("r.vec") == F.col("c.vec")), "left") \
        .select("r.id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
                F.coalesce("component", "r.row").alias("component"))
    least = placed_rows.groupBy("component").agg(F.min("id").alias("component_id"))
    return placed_rows.join(least, "component").select(
        F.col("id").alias(id_col), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def op7_embedding_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


SQL = """
WITH v AS (
  SELECT vec_id, label, [x::DOUBLE FOR x IN embedding] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0
    AND len([x FOR x IN embedding IF x <> 0]) > 0),
l AS MATERIALIZED (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  AND list_cosine_similarity(a.e, b.e) >= 0.93),
r AS (
  WITH RECURSIVE reach(x, y) AS (
    SELECT vec_id, vec_id FROM embeddings UNION SELECT reach.x, l.y FROM reach JOIN l ON reach.y = l.x)
  SELECT x, min(y) AS component_id FROM reach GROUP BY x),
n AS (SELECT x, count(*) AS n_links FROM l GROUP BY x)
SELECT e.vec_id, coalesce(n.n_links, 0) AS n_links, r.component_id, e.vec_id = r.component_id AS kept
FROM embeddings e JOIN r ON r.x = e.vec_id LEFT JOIN n ON n.x = e.vec_id
"""
