"""Per-chunk run summaries of the log and their merge.

What a recompute needs to know about a stretch of a participant's log is

* its last version and whether the whole stretch is one run of it,
* the counts, sums and first block of its last run.

Two neighbouring stretches merge: if the right one is a single run of the
left one's last version, both runs join, else the right one stands.  The merge
is associative, so the log is cut into chunks that follow each other in time,
each (participant, chunk) is summarised on its own, and a participant's
current run is the merge over chunks.

The log is scanned once and its narrow columns are shuffled once, by
(participant, chunk): a participant with a third of all rows is spread over
its chunks.  What is left, one row per participant and chunk, is small, can be
stored, and serves every later recompute; ``refresh`` reads only the newest
stored chunk and what follows it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankforge.config import EPOCH_BLOCKS

_DAY_US = 86_400_000_000


def time_chunk(df: DataFrame, seq: Sequence[str]) -> Column:
    """A column that grows with ``seq``: days of a time, epochs of a block."""
    from rankforge.operators.results import _INTS, _TIME, epoch_micros
    t = dict(df.dtypes)[seq[0]]
    if t in _TIME:
        return F.floor(epoch_micros(seq[0], t) / F.lit(_DAY_US)).cast("bigint")
    if t in _INTS:
        return F.floor(F.col(seq[0]) / F.lit(EPOCH_BLOCKS)).cast("bigint")
    return F.lit(0).cast("bigint")


def chunk_runs(rows: DataFrame, envs: Sequence[str], chunk: Column, key: str = "participant",
               version: Sequence[str] = ("model", "revision"), seq: Sequence[str] = ("ts", "seq_id")) -> DataFrame:
    """One row per (participant, chunk): ``latest`` version, ``single`` (the
    chunk is one run), and ``n``, ``succ`` by env and ``first_block`` of the
    chunk's last run.  ``chunk`` must grow with ``seq``."""
    from rankforge.operators.results import order_key
    own = Window.partitionBy(key, "chunk")
    block = F.col("block") if "block" in rows.columns else F.lit(None).cast("bigint")
    d = rows.select(key, chunk.alias("chunk"), order_key(rows, seq).alias("_seq"),
                    F.struct(*[F.col(v) for v in version]).alias("_v"), block.alias("_block"),
                    "env", "success", "score")
    d = d.withColumn("latest", F.max_by("_v", "_seq").over(own))
    d = d.withColumn("_cut", F.max(F.when(~F.col("_v").eqNullSafe(F.col("latest")), F.col("_seq"))).over(own))
    last = F.col("_cut").isNull() | (F.col("_seq") > F.col("_cut"))
    hits = [F.col("success") & last & (F.col("env") == F.lit(e)) for e in envs]
    return d.groupBy(key, "chunk").agg(
        F.max_by("_v", "_seq").alias("latest"), F.max("_cut").isNull().alias("single"),
        F.array(*[F.count_if(h) for h in hits]).alias("n"),
        F.array(*[F.coalesce(F.sum(F.when(h, F.col("score"))), F.lit(0.0)) for h in hits]).alias("succ"),
        F.min(F.when(last, F.col("_block"))).alias("first_block"))


def merge_runs(chunks: DataFrame, n_envs: int, key: str = "participant") -> DataFrame:
    """One row per participant: ``n``, ``succ``, ``first_block`` and ``latest``
    of the current run, from all its chunk summaries."""
    own = Window.partitionBy(key)                          # a participant's chunks, not its rows
    c = chunks.withColumn("_v", F.max_by("latest", "chunk").over(own))
    same = F.col("latest").eqNullSafe(F.col("_v"))
    c = c.withColumn("_stop", F.max(F.when(~(F.col("single") & same), F.col("chunk"))).over(own))
    part = c.filter(F.col("_stop").isNull() | (F.col("chunk") > F.col("_stop")) | ((F.col("chunk") == F.col("_stop")) & same))
    return part.groupBy(key).agg(
        F.array(*[F.sum(F.col("n")[i]) for i in range(n_envs)]).alias("n"),
        F.array(*[F.sum(F.col("succ")[i]) for i in range(n_envs)]).alias("succ"),
        F.min("first_block").alias("first_block"), F.max_by("latest", "chunk").alias("latest"))


def stored_chunks(spark, path: str) -> DataFrame | None:
    """The stored summaries, None before the first refresh."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def refresh(rows: DataFrame, path: str, envs: Sequence[str], chunk: Column, key: str = "participant",
            since: int | None = None, **options) -> DataFrame:
    """Bring the stored summaries up to date and return them.

    Summaries before the newest stored chunk stay; that chunk and later ones
    are recomputed and replace their own partitions, so a refresh that is
    repeated changes nothing.  ``since`` names an earlier chunk to start from
    when late rows have come in.  ``chunk`` should be a partition column of the
    log (or an expression Spark can prune by), so older files aren't opened."""
    spark = rows.sparkSession
    old = stored_chunks(spark, path)
    if since is None and old is not None:
        since = old.agg(F.max("chunk")).first()[0]
    if since is not None:
        rows = rows.filter(chunk >= F.lit(since))
    new = chunk_runs(rows, envs, chunk, key, **options)
    new.repartition("chunk").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("chunk").parquet(path)
    return spark.read.parquet(path)
