"""The live tail by run summaries, with late rows.

Each micro-batch is written to the log by chunk (a whole number that grows
with the order of the rows, a day or an epoch).  A chunk is closed once a row
``delay`` chunks later has come; closed chunks are summarised
(``operators.rollup``) and only the summaries are merged from then on.  A row
for a closed chunk is late: it is counted in a side table and its chunk is
summarised again, so the result equals the batch result whatever the order of
arrival.  Chunks below the newest one by more than the tail are left out of the
result, and participants without any chunk left expire.

All work of a micro-batch is Spark jobs over its own chunks: no state per key,
no task per participant.  What it writes stands under its number, so a
replayed micro-batch replaces its own rows; the closing mark moves on between
two slots by turns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankforge.operators.rollup import chunk_runs, merge_runs


def _read(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def marks(spark: SparkSession, path: str, batch_id: int) -> tuple[int | None, int | None]:
    """(first open chunk, newest chunk) after the micro-batches before ``batch_id``."""
    got = _read(spark, f"{path}/mark/slot={(batch_id - 1) % 2}") if batch_id > 0 else None
    row = got.first() if got is not None else None
    return (row["open"], row["newest"]) if row else (None, None)


def tail_writer(path: str, envs: Sequence[str], chunk: Column, delay: int, key: str = "participant", **options):
    """foreachBatch body that keeps ``path`` up to date."""
    def write(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        before, newest = marks(spark, path, batch_id)
        late = F.lit(False) if before is None else F.col("_chunk") < F.lit(before)
        folder = f"{path}/log/microbatch={batch_id}"
        df.withColumn("_chunk", chunk).withColumn("late", late).write.mode("overwrite").partitionBy("_chunk").parquet(folder)
        got = _read(spark, folder)                               # None: an empty micro-batch
        top = got.agg(F.max("_chunk")).first()[0] if got is not None else None
        newest = max((x for x in (top, newest) if x is not None), default=None)
        now = before if newest is None else max((x for x in (before, newest - delay) if x is not None))
        todo = [] if got is None else [r[0] for r in got.filter("late").select("_chunk").distinct().collect()]   # chunk numbers
        log = _read(spark, f"{path}/log")
        if log is not None and now is not None:
            due = F.col("_chunk").isin(todo)
            if before is None or now > before:
                due = due | ((F.col("_chunk") < now) & (F.lit(True) if before is None else F.col("_chunk") >= before))
            rows = log.filter((F.col("microbatch") <= batch_id) & due)
            chunk_runs(rows, envs, F.col("_chunk").cast("bigint"), key, **options) \
                .write.mode("overwrite").parquet(f"{path}/runs/microbatch={batch_id}")
        if got is not None:
            got.filter("late").groupBy(key, F.col("_chunk").alias("chunk")).agg(F.count(F.lit(1)).alias("rows")) \
                .write.mode("overwrite").parquet(f"{path}/late/microbatch={batch_id}")
        spark.range(1).select(F.lit(now).cast("bigint").alias("open"), F.lit(newest).cast("bigint").alias("newest"),
                              F.lit(batch_id).alias("batch")).write.mode("overwrite").parquet(f"{path}/mark/slot={batch_id % 2}")
    return write


def newest_marks(spark: SparkSession, path: str) -> tuple[int | None, int | None]:
    got = _read(spark, f"{path}/mark")
    row = got.orderBy(F.desc("batch")).first() if got is not None else None
    return (row["open"], row["newest"]) if row else (None, None)


def tail_summary(spark: SparkSession, path: str, envs: Sequence[str], tail: int | None = None,
                 key: str = "participant", **options) -> DataFrame:
    """One row per live participant: n, succ, first_block and latest of its
    current run within the last ``tail`` chunks (None: all)."""
    first_open, newest = newest_marks(spark, path)
    log = spark.read.parquet(f"{path}/log")
    open_rows = log if first_open is None else log.filter(F.col("_chunk") >= first_open)
    chunks = chunk_runs(open_rows, envs, F.col("_chunk").cast("bigint"), key, **options)
    closed = _read(spark, f"{path}/runs")
    if closed is not None:
        names = [c for c in closed.columns if c not in (key, "chunk", "microbatch")]
        last = closed.groupBy(key, "chunk").agg(F.max_by(F.struct(*names), "microbatch").alias("_l")).select(key, "chunk", "_l.*")
        if first_open is not None:
            last = last.filter(F.col("chunk") < first_open)
        chunks = chunks.unionByName(last)
    if tail is not None and newest is not None:
        chunks = chunks.filter(F.col("chunk") > newest - tail)
    return merge_runs(chunks, len(envs), key)


def expired(spark: SparkSession, path: str, tail: int, key: str = "participant") -> DataFrame:
    """(participant, last chunk) of those whose last row lies below the tail."""
    _, newest = newest_marks(spark, path)
    last = spark.read.parquet(f"{path}/log").groupBy(key).agg(F.max("_chunk").cast("bigint").alias("last_chunk"))
    return last.filter(F.col("last_chunk") <= F.lit(newest) - tail)


def late_rows(spark: SparkSession, path: str, key: str = "participant") -> DataFrame:
    """(participant, rows): how many rows came after their chunk was closed."""
    return spark.read.parquet(f"{path}/late").groupBy(key).agg(F.sum("rows").alias("rows"))
