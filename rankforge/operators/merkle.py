"""Hash tree over the files of a set.

Files are numbered by path; leaf i is the hash of path and content, and node j
of a level hashes the nodes 16 j to 16 j + 15 of the level below.  A level with
one node is the root and goes up unchanged, so the tree of a set doesn't
depend on other, larger sets.  No group is larger than the fan-in, whatever
the set, and a changed file recomputes only the nodes above it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankforge.operators.ordered import numbered
from rankforge.session import materialize

FAN_IN = 16
NODES = "level, idx, hash, files"


def leaf_hash(path: Column, content: Column) -> Column:
    return F.sha2(F.concat(path.cast("string"), F.lit(":"), F.sha2(F.coalesce(content.cast("string"), F.lit("")), 256)), 256)


def leaves(files: DataFrame, set_col: str, path: str = "path", content: str = "content") -> DataFrame:
    """(set, path, idx, hash, files): the leaves, numbered by path within their
    set; ``files`` is the size of the set."""
    slim = files.select(set_col, F.col(path).alias("path"), leaf_hash(F.col(path), F.col(content)).alias("hash"))
    placed = materialize(numbered(slim, set_col, "path", "hash"))
    sets = placed.groupBy(set_col).agg(F.min("place").alias("_first"), F.count(F.lit(1)).alias("files"))
    s, p = sets.alias("s"), placed.alias("p")
    return p.join(s, F.col(f"p.{set_col}").eqNullSafe(F.col(f"s.{set_col}"))).select(
        F.col(f"p.{set_col}").alias(set_col), "path", (F.col("place") - F.col("_first")).alias("idx"), "hash", "files")


def parents(nodes: DataFrame, set_col: str, level: int) -> DataFrame:
    """The nodes of ``level`` above all children in ``nodes`` (set, idx, hash, files)."""
    below = F.ceil(F.col("files") / F.lit(FAN_IN ** (level - 1)))          # nodes of the level below
    up = nodes.groupBy(set_col, F.floor(F.col("idx") / FAN_IN).alias("idx")).agg(
        F.array_sort(F.collect_list(F.struct("idx", "hash"))).alias("_c"), F.max("files").alias("files"))
    joined = F.sha2(F.array_join(F.transform("_c", lambda c: c["hash"]), "\n"), 256)
    return up.select(set_col, "idx", F.when(below == 1, F.col("_c")[0]["hash"]).otherwise(joined).alias("hash"), "files")


def levels_of(leaf: DataFrame) -> int:
    most = leaf.agg(F.max("files")).first()[0] or 1
    level = 0
    while FAN_IN ** level < most:
        level += 1
    return level


def tree(leaf: DataFrame, set_col: str) -> DataFrame:
    """All nodes: set, level (0: leaves), idx, hash, files."""
    own = [set_col, "idx", "hash", "files"]
    now = materialize(leaf.select(*own))
    out = now.withColumn("level", F.lit(0))
    for level in range(1, levels_of(now) + 1):
        now = materialize(parents(now, set_col, level))
        out = out.unionByName(now.withColumn("level", F.lit(level)))
    return out


def roots(nodes: DataFrame, set_col: str) -> DataFrame:
    """(set, fingerprint, files)."""
    top = nodes.groupBy(set_col).agg(F.max_by("hash", "level").alias("fingerprint"), F.max("files").alias("files"))
    return top


def update(nodes: DataFrame, changed: DataFrame, set_col: str) -> DataFrame:
    """The nodes that change when the leaves ``changed`` (set, idx, hash) get
    new hashes: per level only the parents of what changed are hashed again,
    from their stored children."""
    top = nodes.agg(F.max("level")).first()[0] or 0
    sizes = nodes.filter("level = 0").select(set_col, "idx", "files")
    now = materialize(changed.select(set_col, "idx", "hash").join(sizes, [set_col, "idx"]))
    out = now.withColumn("level", F.lit(0))
    for level in range(1, top + 1):
        touched = now.select(set_col, F.floor(F.col("idx") / FAN_IN).alias("_up")).distinct()
        old = nodes.filter(F.col("level") == level - 1).withColumn("_up", F.floor(F.col("idx") / FAN_IN)) \
            .join(touched, [set_col, "_up"], "left_semi").select(set_col, "idx", "hash", "files")
        children = old.join(now.select(set_col, "idx"), [set_col, "idx"], "left_anti").unionByName(now.select(*old.columns))
        now = materialize(parents(children, set_col, level))
        out = out.unionByName(now.withColumn("level", F.lit(level)))
    return out
