"""Structured Streaming counterparts.

* I1  sink: micro-batches written with ``foreachBatch``; each batch lands
      in its own ``microbatch=<id>`` folder written with overwrite, so a batch
      replayed from the checkpoint after a failure replaces itself instead
      of duplicating rows (at-least-once delivery, idempotent result).
* I3  tumbling panes with a watermark; sliding windows are sums of panes.
* I4  current-version run per participant with ``applyInPandasWithState``
      (state = version, first block, last seq, per-env counts); I7 expires
      a participant's state once the watermark passes its last result plus
      the tail.
* I5  stall alarms: per-process state keeps the last heartbeat and a timer.
* I6  tempo gate: a durable last-acted block, moved on once a micro-batch.
* I8  registry refresh: the static registry is re-read in every batch.

Per-key work inside the stateful functions is bounded by one micro-batch
(``maxFilesPerTrigger``), never by the whole history.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from rankforge.config import TEMPO
from rankforge.sources.results_log import scratch_path, write_results


# ---- plumbing ------------------------------------------------------------------------------
def _tasks(df: DataFrame) -> int:
    """Partitions of a shuffle that the engine should not join into fewer, larger ones."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def stage_files(df: DataFrame, part_col: str, path: str, slots: int) -> list[str]:
    """Fixture staging: up to ``slots`` folders that follow each other in
    ``part_col`` (a day number), cut at equal parts of its range; returns
    their paths in order.  Rows are dealt to all tasks first, since a task sorts
    what it writes, however few files the table has; only the range is collected."""
    lo, hi = df.agg(F.min(part_col), F.max(part_col)).first()
    if lo is None:
        return []
    step = max(1, -(-(hi - lo + 1) // slots))
    df.withColumn("_slot", F.floor((F.col(part_col) - lo) / step).cast("int")) \
        .repartition(_tasks(df)).write.partitionBy("_slot").parquet(path)
    return [f"{path}/_slot={i}" for i in range(-(-(hi - lo + 1) // step))]


def replay(df: DataFrame, part_col: str, build: Callable[[DataFrame], DataFrame],
           on_batch: Callable[[DataFrame, int], None], name: str, slots: int = 3, mode: str = "append",
           before: Callable[[int], None] | None = None) -> None:
    """Play a table as arrivals: slot after slot lands in an inbox folder, and
    after each the streaming query takes what is there, going on from its
    checkpoint.  So the order of slots is the order of event time, and all
    writes are parallel.  ``before`` is called with each slot's number first."""
    spark = df.sparkSession
    inbox, checkpoint = scratch_path(spark, f"in-{name}"), scratch_path(spark, f"ckpt-{name}")
    for number, path in enumerate(stage_files(df, part_col, scratch_path(spark, f"stage-{name}"), slots)):
        if before:
            before(number)
        spark.read.schema(df.schema).parquet(path).write.mode("append").parquet(inbox)
        run_available_now(build(file_stream(spark, inbox, df.schema)), on_batch, name, mode, checkpoint)


def file_stream(spark: SparkSession, path: str, schema: T.StructType, max_files: int = 1000) -> DataFrame:
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
            .option("recursiveFileLookup", "true").parquet(path))


def event_time(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Watermarks need TIMESTAMP; the log's TIMESTAMP_NTZ wall-clock time is
    taken as UTC, so windows do not depend on the session time zone."""
    from rankforge.operators.results import epoch_micros
    if dict(df.dtypes)[ts] != "timestamp_ntz":
        return df
    return df.withColumn(ts, F.timestamp_micros(epoch_micros(ts, "timestamp_ntz")))


def run_available_now(stream: DataFrame, on_batch: Callable[[DataFrame, int], None], name: str,
                      mode: str = "append", checkpoint: str | None = None) -> None:
    """Run a streaming query over everything available, then stop."""
    spark = stream.sparkSession
    q = (stream.writeStream.outputMode(mode).foreachBatch(on_batch)
         .option("checkpointLocation", checkpoint or scratch_path(spark, f"ckpt-{name}"))
         .trigger(availableNow=True).start())
    q.awaitTermination()


def batch_writer(path: str, fn: Callable[[DataFrame], DataFrame] | None = None):
    """foreachBatch body: write the batch (optionally transformed) to
    ``path/microbatch=<id>`` with overwrite: replays are idempotent."""
    def write(df: DataFrame, batch_id: int) -> None:
        out = fn(df) if fn else df
        out.write.mode("overwrite").parquet(f"{path}/microbatch={batch_id}")
    return write


# ---- I1 ------------------------------------------------------------------------------------
def results_writer(path: str):
    """foreachBatch body: a batch's successful results become its part of the
    window-bucketed Parquet log; a replayed batch replaces its part."""
    def write(df: DataFrame, batch_id: int) -> None:
        write_results(df, f"{path}/microbatch={batch_id}", mode="overwrite")
    return write


def sink_stream(stream: DataFrame, path: str, name: str = "sink") -> None:
    """Results stream -> window-bucketed Parquet log, batch-idempotent."""
    run_available_now(stream, results_writer(path), name)


# ---- I3 ------------------------------------------------------------------------------------
def windowed_grid(df: DataFrame, ts: str, size: str, slide: str, watermark: str,
                  key: str = "participant") -> DataFrame:
    """Sliding (size, slide) per-(participant, env) n and succ; works on a
    stream (with the watermark) and on a static frame (batch twin)."""
    d = event_time(df, ts)
    d = d.withWatermark(ts, watermark) if df.isStreaming else d
    ok = F.col("success")
    return d.groupBy(F.window(ts, size, slide).alias("w"), key, "env").agg(
        F.count_if(ok).alias("n"), F.coalesce(F.sum(F.when(ok, F.col("score"))), F.lit(0.0)).alias("succ"))


def sliding_sums(panes: DataFrame, keys: Sequence[str], pane: str, k: int, sums: Sequence[str]) -> DataFrame:
    """Sums over every run of ``k`` consecutive panes that holds a row of the
    key: (keys, first pane of the run, sums).  ``pane`` is a whole number.

    Panes are cut into blocks of k.  A run of k panes is the end of one block
    and the start of the next, so its sum is a suffix sum plus a prefix sum;
    both are running sums inside one block.  No row is copied per window,
    nothing is subtracted (no cancellation), and no window orders more than
    one block of a key."""
    own = [*keys, "_b"]
    p = panes.select(*keys, F.floor(F.col(pane) / F.lit(k)).cast("bigint").alias("_b"),
                     F.pmod(F.col(pane), F.lit(k)).cast("int").alias("_o"),
                     *[F.col(c) for c in sums], F.lit(1).alias("_here"))
    slots = p.select(*own).distinct().select(*own, F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("_o"))
    empty = slots.select(*own, "_o", *[F.lit(0).cast(dict(p.dtypes)[c]).alias(c) for c in sums], F.lit(0).alias("_here"),
                         F.lit(True).alias("_slot"))
    # two sorts hold a task's rows at once, so there are as many tasks as a shuffle may have
    both = p.withColumn("_slot", F.lit(False)).unionByName(empty).repartition(_tasks(panes), *own)
    upto = Window.partitionBy(*own).orderBy("_o").rangeBetween(Window.unboundedPreceding, 0)
    onward = Window.partitionBy(*own).orderBy(F.desc("_o")).rangeBetween(Window.unboundedPreceding, 0)
    named = [*sums, "_here"]
    r = both.select(*own, "_o", "_slot", F.struct(*[F.sum(c).over(upto).alias(c) for c in named]).alias("_pre"),
                    F.struct(*[F.sum(c).over(onward).alias(c) for c in named]).alias("_suf")).filter("_slot")
    at = F.col("_b") * k + F.col("_o")
    halves = F.array(F.struct(at.alias("pane"), F.col("_suf").alias("s")),
                     F.when(F.col("_o") < k - 1, F.struct((at - (k - 1)).alias("pane"), F.col("_pre").alias("s"))))
    w = r.select(*keys, F.explode(halves).alias("_h")).filter("_h is not null")
    out = w.groupBy(*keys, F.col("_h.pane").alias(pane)).agg(*[F.sum(F.col(f"_h.s.{c}")).alias(c) for c in named])
    return out.filter("_here > 0").drop("_here")


# ---- I4 + I7 --------------------------------------------------------------------------------
RUN_STATE = T.StructType([
    T.StructField("model", T.StringType()), T.StructField("revision", T.StringType()),
    T.StructField("first_block", T.LongType()), T.StructField("last_ts", T.LongType()),
    T.StructField("last_id", T.LongType()), T.StructField("n", T.ArrayType(T.LongType())),
    T.StructField("succ", T.ArrayType(T.DoubleType()))])
RUN_OUT = T.StructType([
    T.StructField("participant", T.LongType()), T.StructField("model", T.StringType()),
    T.StructField("revision", T.StringType()), T.StructField("first_block", T.LongType()),
    T.StructField("n", T.ArrayType(T.LongType())), T.StructField("succ", T.ArrayType(T.DoubleType())),
    T.StructField("expired", T.BooleanType())])


def _us(ts: pd.Series) -> np.ndarray:
    """Microseconds since the epoch of a timestamp column (naive or tz-aware)."""
    if ts.dtype.kind == "M":
        if getattr(ts.dt, "tz", None) is not None:
            ts = ts.dt.tz_convert("UTC").dt.tz_localize(None)
        return ts.to_numpy().astype("datetime64[us]").astype("int64")
    return ts.to_numpy().astype("int64")


_NO_TIME = -(1 << 63)


def _eq(a: pd.Series, b: pd.Series) -> pd.Series:
    return (a == b) | (a.isna() & b.isna())


def run_state_fn(envs: Sequence[str], tail_us: int):
    """applyInPandasWithState body for I4 (+ I7 expiry), vectorised over
    the micro-batch rows of one participant."""
    k = len(envs)
    env_pos = pd.Series(range(k), index=list(envs))

    def fn(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        (participant,) = key
        if state.hasTimedOut:
            st = state.get
            state.remove()
            yield pd.DataFrame([{"participant": participant, "model": st[0], "revision": st[1],
                                 "first_block": st[2], "n": list(st[5]), "succ": list(st[6]),
                                 "expired": True}])
            return
        rows = pd.concat(list(pdfs), ignore_index=True)
        rows["_t"] = _us(rows["ts"])
        rows = rows.sort_values(["_t", "seq_id"], kind="stable").reset_index(drop=True)
        have = state.exists
        if have:
            model, rev, fb, lt, lid, n, succ = state.get
            late = (rows["_t"] < lt) | ((rows["_t"] == lt) & (rows["seq_id"] <= lid))
            rows = rows[~late].reset_index(drop=True)   # the batch recompute corrects late rows
        if len(rows) == 0:
            return
        pm, pr = rows["model"].shift(1), rows["revision"].shift(1)
        if have:
            pm.iloc[0], pr.iloc[0] = model, rev
        chg = ~(_eq(rows["model"], pm) & _eq(rows["revision"], pr))
        if not have:
            chg.iloc[0] = True
        run = chg.cumsum()
        cont = have and run.iloc[-1] == 0          # the state's run goes on
        last = rows[run == run.iloc[-1]]
        n = np.array(n if cont else [0] * k, dtype="int64")
        succ = np.array(succ if cont else [0.0] * k, dtype="float64")
        hit = last[last["success"].astype(bool) & last["env"].isin(env_pos.index)]
        if len(hit):
            g = hit.groupby("env")["score"].agg(["count", "sum"])
            idx = env_pos[g.index].to_numpy()
            np.add.at(n, idx, g["count"].to_numpy())
            np.add.at(succ, idx, g["sum"].to_numpy())
        b = last["block"].dropna()
        fb0 = fb if cont else None
        fb = (int(b.min()) if fb0 is None else min(int(fb0), int(b.min()))) if len(b) else fb0
        tail_row = last.iloc[-1]
        model, rev = tail_row["model"], tail_row["revision"]
        lt, lid = int(tail_row["_t"]), int(tail_row["seq_id"])
        state.update((model, rev, fb, lt, lid, n.tolist(), succ.tolist()))
        state.setTimeoutTimestamp(lt // 1000 + tail_us // 1000)
        yield pd.DataFrame([{"participant": participant, "model": model, "revision": rev,
                             "first_block": fb, "n": n.tolist(), "succ": succ.tolist(), "expired": False}])

    return fn


def live_runs(stream: DataFrame, envs: Sequence[str], tail_seconds: int, watermark: str = "1 day",
              key: str = "participant") -> DataFrame:
    """I4: per participant, the current run's per-env counts, updated every
    micro-batch; I7: state is dropped once the watermark passes the last
    result by ``tail_seconds``."""
    s = event_time(stream).withWatermark("ts", watermark)
    cols = [key, "ts", "seq_id", "model", "revision", "block", "success", "env", "score"]
    return s.select(*cols).groupBy(key).applyInPandasWithState(
        run_state_fn(envs, tail_seconds * 1_000_000), RUN_OUT, RUN_STATE, "update",
        GroupStateTimeout.EventTimeTimeout)


# ---- I5 ------------------------------------------------------------------------------------
def _us_column(df: DataFrame, ts: str = "ts") -> F.Column:
    """Microseconds of the wall-clock time, as the stateful functions sort it; null comes first."""
    from rankforge.operators.results import epoch_micros
    return F.coalesce(epoch_micros(ts, dict(df.dtypes)[ts]), F.lit(_NO_TIME)).alias("_us")


def _in_order(pdfs: Iterator[pd.DataFrame]) -> tuple[np.ndarray, np.ndarray]:
    """(times, event ids) of a key's rows of a micro-batch, by both.  Arrays
    only: a key has few rows, so what a data frame costs would be most of it."""
    parts = [(p["_us"].to_numpy(), p["event_id"].to_numpy()) for p in pdfs]
    us, ids = parts[0] if len(parts) == 1 else (np.concatenate(c) for c in zip(*parts))
    by = np.lexsort((ids, us))
    return us[by], ids[by]


STALL_STATE = T.StructType([T.StructField("last_us", T.LongType())])
STALL_OUT = T.StructType([T.StructField("key", T.LongType()), T.StructField("event_id", T.LongType()),
                          T.StructField("gap", T.DoubleType()), T.StructField("silent_since_us", T.LongType())])


def stall_fn(timeout_s: float):
    wait_ms = int(timeout_s * 1000)

    def fn(key, pdfs, state: GroupState):
        if state.hasTimedOut:               # nothing came: alarm now, keep the state for the gap
            last = state.get[0]
            state.update((last,))
            yield pd.DataFrame({"key": [key[0]], "event_id": pd.array([None], dtype="Int64"), "gap": [np.nan],
                                "silent_since_us": pd.array([last], dtype="Int64")})
            return
        us, ids = _in_order(pdfs)
        prev = state.get[0] if state.exists else None
        before = np.concatenate([[prev if prev is not None else -1], us[:-1]])
        gap = (us - before) / 1e6
        if prev is None:
            gap[0] = np.nan
        hit = gap > timeout_s
        state.update((int(us[-1]),))
        state.setTimeoutTimestamp(max(int(us[-1]) // 1000 + wait_ms, state.getCurrentWatermarkMs() + 1))
        if hit.any():
            yield pd.DataFrame({"key": key[0], "event_id": pd.array(ids[hit], dtype="Int64"),
                                "gap": gap[hit], "silent_since_us": pd.array([None] * int(hit.sum()), dtype="Int64")})
    return fn


def stall_alarms(stream: DataFrame, key: str, timeout_s: float, watermark: str = "0 seconds") -> DataFrame:
    """An alarm when a process falls silent for longer than the timeout
    (``silent_since_us``, by an event-time timer, so also when it never comes
    back), and a row for the heartbeat that ends such a gap."""
    s = event_time(stream).withWatermark("ts", watermark)
    return s.select(F.col(key).cast("bigint").alias(key), "ts", _us_column(s), "event_id").groupBy(key) \
        .applyInPandasWithState(stall_fn(timeout_s), STALL_OUT, STALL_STATE, "append",
                                GroupStateTimeout.EventTimeTimeout)


# ---- I6 ------------------------------------------------------------------------------------
def last_acted(spark: SparkSession, path: str, batch_id: int) -> int | None:
    """The block last acted on before this micro-batch, None at the start."""
    if batch_id <= 0:
        return None
    try:
        return spark.read.parquet(f"{path}/last/slot={(batch_id - 1) % 2}").first()["block"]
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def gate_writer(path: str, block: str = "block", tempo: int = TEMPO):
    """foreachBatch body of the tempo gate: a block fires when it is a multiple
    of ``tempo`` and above the block last acted on; late and repeated blocks
    don't fire.  A micro-batch's blocks go to ``path/fired``, and the value moves
    on once a micro-batch, to one of two slots by turns: a replayed batch still
    finds the value before it and replaces what it wrote."""
    def act(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        before = last_acted(spark, path, batch_id)
        due = df.filter(F.pmod(F.col(block), F.lit(tempo)) == 0).select(F.col(block).cast("bigint").alias("block")).distinct()
        if before is not None:
            due = due.filter(F.col("block") > before)
        folder = f"{path}/fired/microbatch={batch_id}"
        due.write.mode("overwrite").parquet(folder)
        now = spark.read.parquet(folder).agg(F.coalesce(F.max("block"), F.lit(before).cast("bigint")).alias("block"))
        now.write.mode("overwrite").parquet(f"{path}/last/slot={batch_id % 2}")
    return act


# ---- I8 ------------------------------------------------------------------------------------
def refreshed_members(loader: Callable[[SparkSession], DataFrame], path: str, key: str = "participant",
                      reg_key: str = "uid"):
    """foreachBatch body: re-read the registry for every batch (it changes
    between refreshes) and keep the batch's rows of current members."""
    def write(df: DataFrame, batch_id: int) -> None:
        reg = loader(df.sparkSession).select(F.col(reg_key).alias(key)).distinct()
        df.join(reg, key, "left_semi").write.mode("overwrite").parquet(f"{path}/microbatch={batch_id}")
    return write


def latest_per_key(df: DataFrame, keys: Sequence[str], batch: str = "microbatch") -> DataFrame:
    """The last emitted row per key across update-mode batches; a key whose
    last row says that its state expired is gone.  ``max_by`` of a struct sorts
    its input, so rows are dealt by key first: a task that aggregated before the
    shuffle would sort all rows of a file split."""
    cols = [c for c in df.columns if c not in keys and c != batch]
    g = df.repartition(_tasks(df), *keys).groupBy(*keys).agg(F.max_by(F.struct(*cols), F.col(batch)).alias("_l"))
    out = g.select(*keys, "_l.*")
    return out.where("not expired") if "expired" in cols else out


# ---- I2 (size-or-age flush batches) ----------------------------------------------------------
FLUSH_STATE = T.StructType([T.StructField("batch", T.LongType()), T.StructField("start_us", T.LongType()),
                            T.StructField("count", T.LongType())])
FLUSH_OUT = T.StructType([T.StructField("producer", T.LongType()), T.StructField("event_id", T.LongType()),
                          T.StructField("batch", T.LongType())])


def flush_fn(size: int, age_s: float):
    age_us = int(age_s * 1_000_000)

    def fn(key, pdfs, state: GroupState):
        us, ids = _in_order(pdfs)
        batch, start, cnt = state.get if state.exists else (-1, 0, size)   # no open batch yet
        out = np.empty(len(us), dtype=np.int64)
        i = 0
        while i < len(us):                  # one step per flush, not per row
            if cnt >= size or us[i] >= start + age_us:
                batch, start, cnt = batch + 1, int(us[i]), 0
            end = min(i + size - cnt, int(np.searchsorted(us, start + age_us, side="left")))
            out[i:end] = batch
            cnt, i = cnt + end - i, end
        state.update((int(batch), int(start), int(cnt)))
        yield pd.DataFrame({"producer": key[0], "event_id": ids, "batch": out})
    return fn


def flush_batches(stream: DataFrame, producer: str, size: int, age_s: float) -> DataFrame:
    """Each producer's results cut into flush batches: a batch closes at
    ``size`` items or when an item arrives ``age_s`` after the batch's first
    one.  The rule is sequential per producer, so it runs as per-producer
    streaming state, one bounded micro-batch at a time."""
    return stream.select(F.col(producer).cast("bigint").alias(producer), _us_column(stream), "event_id").groupBy(producer) \
        .applyInPandasWithState(flush_fn(size, age_s), FLUSH_OUT, FLUSH_STATE, "append",
                                GroupStateTimeout.NoTimeout)
