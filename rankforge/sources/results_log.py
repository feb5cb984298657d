"""Result-log sources and sinks.

At rest the log is Parquet partitioned by ``epoch`` (a day of blocks) and
sorted by ``window`` inside each file, so a tail read prunes directories on
``epoch`` and row groups on ``window`` (20-block windows as directories
would make a flood of tiny files).  Interchange shards (one JSON array of
result objects per file, named ``{window:09d}-{uploader}-{upload_ns}.json``)
are read with each file as one row (a shard is one sink batch, bounded),
the key parsed from the file name, and every element parsed on its own so
one bad result does not drop its shard: bad ones go to a quarantine.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankforge.config import ACTIVE_ENVS, EPOCH_BLOCKS, SINK_BATCH, WINDOW
from rankforge.functions.text import shard_key

# ---- schemas ---------------------------------------------------------------------------
MINER = T.StructType([
    T.StructField("uid", T.IntegerType()), T.StructField("hotkey", T.StringType()),
    T.StructField("model", T.StringType()), T.StructField("revision", T.StringType()),
    T.StructField("block", T.LongType()), T.StructField("chute", T.StringType()),
    T.StructField("slug", T.StringType()), T.StructField("weights_shas", T.ArrayType(T.StringType()))])
CHALLENGE = T.StructType([
    T.StructField("env", T.StringType()), T.StructField("prompt", T.StringType()),
    T.StructField("extra", T.StringType()), T.StructField("challenge_id", T.StringType()),
    T.StructField("timestamp", T.DoubleType())])
RESPONSE = T.StructType([
    T.StructField("response", T.StringType()), T.StructField("latency_seconds", T.DoubleType()),
    T.StructField("attempts", T.IntegerType()), T.StructField("model", T.StringType()),
    T.StructField("error", T.StringType()), T.StructField("success", T.BooleanType()),
    T.StructField("timestamp", T.DoubleType())])
EVALUATION = T.StructType([
    T.StructField("env", T.StringType()), T.StructField("score", T.DoubleType()),
    T.StructField("extra", T.StringType())])
RESULT = T.StructType([
    T.StructField("version", T.StringType()), T.StructField("signature", T.StringType()),
    T.StructField("hotkey", T.StringType()), T.StructField("miner", MINER),
    T.StructField("challenge", CHALLENGE), T.StructField("response", RESPONSE),
    T.StructField("evaluation", EVALUATION)])
SEQ = T.StructType([
    T.StructField("window", T.LongType()), T.StructField("uploader", T.StringType()),
    T.StructField("upload_ns", T.LongType()), T.StructField("pos", T.IntegerType())])
SHARD_NAME = r"^(\d+)-(.+)-(\d+)\.json$"


# ---- A1 / S1 -------------------------------------------------------------------------------
def window_bucket(block, w: int = WINDOW) -> Column:
    """(b // w) * w with floor semantics, integer-exact."""
    b = F.col(block) if isinstance(block, str) else block
    return b - F.pmod(b, F.lit(w))


def needed_windows(spark: SparkSession, cur, tail: int, w: int = WINDOW) -> DataFrame:
    """The windows a tail read covers, from _w(cur - tail) to _w(cur)
    inclusive.  ``cur`` may be a Column (scalar subquery)."""
    c = F.lit(cur) if isinstance(cur, int) else cur
    lo, hi = window_bucket(c - F.lit(tail), w), window_bucket(c, w)
    return spark.range(1).select(F.explode(F.sequence(lo, hi, F.lit(w).cast("bigint"))).alias("window"))


# ---- A2 ------------------------------------------------------------------------------
def read_tail(spark: SparkSession, path: str, cur: int, tail: int, w: int = WINDOW) -> DataFrame:
    """Rows of the Parquet log in the windows of the tail.  The bounds are
    literals: ``epoch`` prunes directories, ``window`` is pushed to the
    Parquet reader.  Rows older than ``cur - tail`` inside the first window
    are kept (bucket granularity, as the shard read does)."""
    lo = (cur - tail) - ((cur - tail) % w)
    hi = cur - (cur % w)
    return (spark.read.parquet(path)
            .filter(F.col("epoch").between(lo // EPOCH_BLOCKS, hi // EPOCH_BLOCKS)
                    & F.col("window").between(lo, hi)))


# ---- A8 ------------------------------------------------------------------------------
def write_results(df: DataFrame, path: str, block_col: str = "block", mode: str = "append") -> None:
    """Append (or, by ``mode``, replace) successful results (a missing flag counts as failure),
    bucketed by window; each write adds new, uniquely named files; an empty
    batch writes nothing."""
    ok = df.filter(F.coalesce(F.col("success"), F.lit(False)))
    (ok.withColumn("window", window_bucket(block_col))
       .withColumn("epoch", F.floor(F.col("window") / EPOCH_BLOCKS).cast("bigint"))
       .sortWithinPartitions("epoch", "window")
       .write.mode(mode).partitionBy("epoch").parquet(path))


def upload_batches(results: DataFrame, uploader: str, order: list[str], chunk, size: int = SINK_BATCH):
    """I2 (size rule): number each uploader's results in order and cut them
    into flush batches of ``size``; ordinals come from the distributed
    ``ordinal_within`` (no window over a whole uploader)."""
    from rankforge.operators.ops import ordinal_within
    o = ordinal_within(results, uploader, order, chunk)
    return o.withColumn("batch", F.floor((F.col("ordinal") - 1) / F.lit(size)).cast("bigint"))


def write_shards(results: DataFrame, path: str, uploader: str = "hotkey", batch: str = "batch",
                 block_col: str = "miner.block", order: str = "seq_key") -> None:
    """Interchange sink: each upload batch of an uploader becomes one JSON
    array of its successful results (in ``order``) in a folder of its own,
    named by its shard key (T25): the window of the batch's last block (the
    block at flush), the uploader and the batch number, which grows with
    every flush of the uploader.  A batch is bounded by the sink size, so
    gathering it into one row is bounded too."""
    ok = results.filter(F.coalesce(F.col("response.success"), F.lit(False)))
    body = [c for c in RESULT.fieldNames() if c in ok.columns]
    g = ok.groupBy(F.col(uploader).alias("uploader"), batch).agg(
        window_bucket(F.max(F.col(block_col))).alias("window"),
        F.array_sort(F.collect_list(F.struct(F.col(order).alias("k"),
                                             F.to_json(F.struct(*body)).alias("j")))).alias("_items"))
    g = g.select(F.concat(shard_key(F.col("window"), F.col("uploader"), F.col(batch)), F.lit(".json")).alias("shard"),
                 F.concat(F.lit("["), F.array_join(F.transform("_items", lambda x: x["j"]), ","), F.lit("]"))
                 .alias("value"))
    g.write.mode("append").partitionBy("shard").text(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint dir (never machine-local on
    a cluster: the cluster names that folder)."""
    from rankforge.session import ensure_checkpoint_dir
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


@contextmanager
def few_listing_tasks(spark: SparkSession):
    """Spark lists folders by a task each, up to 10,000 of them.  A shard's
    folder holds one file, so starting the tasks would be most of the work;
    here a core gets two tasks that list many folders each."""
    before = spark.conf.get(LISTING_TASKS)
    spark.conf.set(LISTING_TASKS, str(min(int(before), 2 * max(1, spark.sparkContext.defaultParallelism))))
    try:
        yield
    finally:
        spark.conf.set(LISTING_TASKS, before)


def shard_names(spark: SparkSession, path: str) -> DataFrame:
    """(key): the shards in a folder as ``write_shards`` lays it out; no content is read."""
    with few_listing_tasks(spark):
        return spark.read.format("binaryFile").load(path).select(F.col("shard").alias("key")).distinct()


# ---- A13 -----------------------------------------------------------------------------
def write_report(report: DataFrame, path: str, order: str = "rank") -> None:
    """Leaderboard sink: the report as CSV with a header, in report order.
    The report has one row per active participant (bounded by the
    registry), so one ordered file is cheap."""
    report.orderBy(order).coalesce(1).write.mode("overwrite").option("header", True).csv(path)


# ---- A3 / A4 / A5 / A6 ------------------------------------------------------------------
def read_shards(spark: SparkSession, path: str, ignore_missing: bool = True,
                envs=ACTIVE_ENVS, windows: tuple[int, int] | None = None) -> tuple[DataFrame, DataFrame]:
    """(results, quarantine) from JSON-array shards under ``path``.

    Files whose name does not start with digits then '-' are ignored, and with
    ``windows`` those outside the tail (A3);
    each element is parsed alone (A4); elements that are not valid results
    (unparsable, missing fields, inactive env) go to the quarantine with a
    reason instead of being dropped silently (A5); files that vanish or are
    corrupt are skipped (A6).  Every row carries the total order
    ``seq = (window, uploader, upload_ns, pos)``."""
    with few_listing_tasks(spark):
        raw = (spark.read.option("ignoreMissingFiles", ignore_missing).option("ignoreCorruptFiles", True)
               .text(path, wholetext=True))
    # the key names the file, or its folder in the layout of write_shards
    file = F.col("shard") if "shard" in raw.columns else F.col("_metadata.file_name")
    raw = raw.select("value", file.alias("file")).filter(F.col("file").rlike(SHARD_NAME))
    raw = raw.withColumn("window", F.regexp_extract("file", SHARD_NAME, 1).cast("bigint"))
    if windows is not None:      # keys are selected before any content is parsed
        raw = raw.filter(F.col("window").between(*windows))
    named = raw.select("window", F.regexp_extract("file", SHARD_NAME, 2).alias("uploader"),
                       F.regexp_extract("file", SHARD_NAME, 3).cast("bigint").alias("upload_ns"),
                       F.from_json("value", "array<string>").alias("items"))
    el = named.select("window", "uploader", "upload_ns",
                      F.posexplode_outer("items").alias("pos", "item"))
    parsed = el.withColumn("r", F.from_json("item", RESULT)).withColumn(
        "seq", F.struct("window", "uploader", "upload_ns", F.col("pos").cast("int").alias("pos")))
    env = F.trim(F.col("r.challenge.env"))
    reason = (F.when(F.col("item").isNull(), "not_an_array")
              .when(F.col("r").isNull(), "unparsable")
              .when(F.col("r.miner.hotkey").isNull(), "missing_miner")
              .when(env.isNull() | ~env.isin(list(envs)), "inactive_env")
              .when(F.col("r.evaluation.score").isNull(), "missing_score"))
    p = parsed.withColumn("reason", reason)
    good = p.filter(F.col("reason").isNull()).select("r.*", "seq")
    bad = p.filter(F.col("reason").isNotNull()).select("window", "uploader", "upload_ns", "pos",
                                                       "item", "reason")
    return good, bad


def read_tail_shards(spark: SparkSession, path: str, index: DataFrame, cur: int, tail: int, w: int = WINDOW,
                     envs=ACTIVE_ENVS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(results, quarantine, faults) of the tail of a shard folder as
    ``write_shards`` lays it out, for the shards that ``index`` (key) names.

    The window bounds prune the folder listing, so shards outside the tail are
    not opened.  A shard that the index names and that isn't there, and one whose
    content is no JSON array, is skipped and reported in ``faults`` (key,
    reason) instead of ending the read (A6)."""
    lo, hi = (cur - tail) - ((cur - tail) % w), cur - (cur % w)
    due = index.select(F.col("key").cast("string").alias("key")).distinct() \
        .filter(F.regexp_extract("key", SHARD_NAME, 1).try_cast("bigint").between(lo, hi))
    there = shard_names(spark, path)
    good, bad = read_shards(spark, path, envs=envs, windows=(lo, hi))
    broken = bad.filter(F.col("reason") == "not_an_array").select(
        F.concat(shard_key(F.col("window"), F.col("uploader"), F.col("upload_ns")), F.lit(".json")).alias("key"),
        F.lit("corrupt").alias("reason"))
    missing = due.join(there, "key", "left_anti").select("key", F.lit("missing").alias("reason"))
    return good, bad, missing.unionByName(broken)


def shard_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The listing of shards under ``path``: key, window, uploader,
    upload_ns, modified (from file metadata; no file content is read)."""
    with few_listing_tasks(spark):
        m = (spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(path)
             .select(F.col("path"), F.col("modificationTime").alias("modified")))
    key = F.regexp_extract("path", r"([^/]+)$", 1)
    return m.select(key.alias("key"), F.regexp_extract(key, SHARD_NAME, 1).cast("bigint").alias("window"),
                    F.regexp_extract(key, SHARD_NAME, 2).alias("uploader"),
                    F.regexp_extract(key, SHARD_NAME, 3).cast("bigint").alias("upload_ns"), "modified")


# ---- A7 ------------------------------------------------------------------------------
def changed_shards(old: DataFrame, new: DataFrame, key: str = "key", modified: str = "modified") -> DataFrame:
    """Full outer join of two listings: new / changed / unchanged / gone."""
    o = old.select(F.col(key).alias("_k"), F.col(modified).alias("_old"))
    n = new.select(F.col(key).alias("_k"), F.col(modified).alias("_new"))
    j = o.join(n, "_k", "full")
    status = (F.when(F.col("_old").isNull(), "new").when(F.col("_new").isNull(), "gone")
              .when(F.col("_old").eqNullSafe(F.col("_new")), "unchanged").otherwise("changed"))
    return j.select(F.col("_k").alias(key), status.alias("status"))


# ---- A9 / S2 ---------------------------------------------------------------------------
def index_add(index: DataFrame, keys: DataFrame, key: str = "key") -> DataFrame:
    """Distinct, sorted union of the index and the new keys."""
    return index.select(key).unionByName(keys.select(key)).distinct().orderBy(key)


# ---- A10 ---------------------------------------------------------------------------------
def retention(manifest: DataFrame, cur: int, tail: int) -> DataFrame:
    """keep / drop per shard: dropped when its window start < cur - tail
    (raw, not bucketed, so the oldest window a tail read touches may be
    pruned already; deletion itself is left to the caller)."""
    return manifest.withColumn("action", F.when(F.col("window") < F.lit(cur - tail), "drop")
                               .otherwise("keep"))


# ---- A11 ---------------------------------------------------------------------------------
def dataset_manifest(rows: DataFrame, file_key: Column, folder: Column | None = None,
                     filename: Column | None = None) -> DataFrame:
    """(file, rows) per source file, the file named by its key or
    folder + filename; callers treat zero rows in total as an error."""
    k = file_key if folder is None else F.coalesce(file_key, F.concat(folder, F.lit("/"), filename))
    return rows.groupBy(k.alias("file")).agg(F.count(F.lit(1)).alias("rows"))


# ---- A12 ---------------------------------------------------------------------------------
def chunk_sample(rows: DataFrame, file_col: str, order_col: str, start_fn, max_batch: int,
                 buffer_size: int, chunk: Column | None = None) -> DataFrame:
    """Contiguous chunk sampling.  Files are visited in key order, round
    robin; each visit takes the whole file, or the contiguous rows
    [start, start + max_batch) of it when it is longer, where ``start`` =
    ``start_fn(file_index, cycle, n)`` (a column in [0, n - max_batch]).
    Whole chunks are appended until the buffer holds ``buffer_size`` rows.

    Rows: cycle, file, row ordinal, position in the buffer, plus the input
    columns.  The number of cycles is computed in-plan.
    Every cycle takes the same rows of each file, so a chunk's place follows
    from its cycle and the sum over the files before its own, which is a
    running sum over range-sorted files: nothing is windowed globally.
    ``chunk``, a column that grows with ``order_col``, splits the row
    numbering of a long file over tasks (``ordinal_within``)."""
    from rankforge.operators.ops import ordinal_within
    from rankforge.operators.ordered import numbered, summed_before
    per_file = rows.groupBy(file_col).agg(F.count(F.lit(1)).alias("_n"))
    per_file = per_file.withColumn("_size", F.least(F.col("_n"), F.lit(max_batch)).cast("bigint"))
    fidx = summed_before(numbered(per_file, file_col, name="_fi"), "_size", "_fi", name="_ahead")
    per_cycle = fidx.agg(F.sum("_size")).scalar()
    cycles = F.greatest(F.lit(1), F.ceil(F.lit(float(buffer_size)) / per_cycle).cast("int"))
    chunks = fidx.select(file_col, "_fi", "_n", "_size", "_ahead", F.explode(F.sequence(F.lit(0), cycles - 1)).alias("cycle"))
    chunks = chunks.withColumn("_before", F.col("cycle") * per_cycle + F.col("_ahead")).drop("_ahead").withColumn(
        "_start", F.when(F.col("_n") > max_batch, start_fn(F.col("_fi"), F.col("cycle"), F.col("_n")))
        .otherwise(F.lit(0)))
    chunks = chunks.filter(F.col("_before") < buffer_size)
    r = ordinal_within(rows, file_col, [order_col], F.lit(0) if chunk is None else chunk)
    r = r.withColumn("_rn", F.col("ordinal") - 1).drop("ordinal")
    j = r.join(chunks, file_col).filter((F.col("_rn") >= F.col("_start"))
                                        & (F.col("_rn") < F.col("_start") + F.col("_size")))
    return j.withColumn("buffer_pos", F.col("_before") + F.col("_rn") - F.col("_start")).drop(
        "_n", "_size", "_start", "_before", "_fi").withColumnRenamed("_rn", "row_in_file")
