"""Result-log operators: flatten, filters, current version run, sample grid.

Scale notes
-----------
* One participant may own a third of the log.  Nothing here partitions the
  raw log by participant: E1 finds the start of the current run with two
  hash aggregations (map-side combined) over a per-version summary, and the
  only join that touches raw rows is against a table with one row per
  participant (AQE broadcasts it; if it ever grows past the threshold the
  skew-join split handles hot keys).
* The grid is built by one aggregation with one conditional count/sum per
  env, so the raw log is shuffled only as partial aggregates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankforge.config import MAX_BLOCK


# ---- B1 ---------------------------------------------------------------------
def flatten_results(results: DataFrame) -> DataFrame:
    """Nested result rows -> flat columns (B1)."""
    return results.select(
        F.col("miner.hotkey").alias("hotkey"),
        F.col("miner.uid").alias("uid"),
        F.trim(F.col("challenge.env")).alias("env"),
        F.col("miner.model").alias("model"),
        F.col("miner.revision").alias("revision"),
        F.col("miner.block").alias("block"),
        F.coalesce(F.col("response.success"), F.lit(False)).alias("success"),
        F.col("evaluation.score").alias("score"),
        F.col("response.latency_seconds").alias("latency"),
        F.col("challenge.challenge_id").alias("challenge_id"),
        F.col("seq"))


# ---- B4 / B17 ---------------------------------------------------------------
def member_filter(df: DataFrame, registry: DataFrame, key: str = "participant",
                  reg_key: str = "uid") -> DataFrame:
    """Keep rows whose participant is in the registry (B4), a semi join (it
    never duplicates rows, so the registry needs no de-duplication)."""
    reg = registry.select(F.col(reg_key).alias("_rk"))
    return df.join(reg, df[key] == reg["_rk"], "left_semi")


# ---- B5 ---------------------------------------------------------------------
def family_name(model) -> "F.Column":
    """Lower-cased text after the first '/', whole text when there is none,
    'none' for a missing model."""
    m = F.coalesce(model, F.lit("None"))
    return F.lower(F.regexp_replace(m, r"^[^/]*/", ""))


def family_filter(df: DataFrame, prefix: str, base=0, key: str = "participant",
                  model: str = "model") -> DataFrame:
    """Keep rows whose model family starts with ``prefix``; the base
    participant is exempt (B5)."""
    return df.filter((F.col(key) == F.lit(base))
                     | F.startswith(family_name(F.col(model)), F.lit(prefix)))


# ---- E1 ---------------------------------------------------------------------
_TIME = ("timestamp", "timestamp_ntz")
_INTS = ("bigint", "int", "smallint", "tinyint")


def order_key(df: DataFrame, seq: Sequence[str]) -> Column:
    """A total-order key for ``seq`` that hash aggregation can carry.

    ``max`` of a struct (or a string) needs a sort-based aggregate, i.e. a
    sort of the whole log; a (time, integer) or single numeric key is packed
    into one DECIMAL(38,0) instead: wall-clock microseconds * 10^20 +
    (id + 2^63), order-preserving and exact.  Other shapes keep the struct."""
    types = dict(df.dtypes)
    t = [types[c] for c in seq]
    if len(seq) == 1 and (t[0] in _INTS or t[0] in _TIME or t[0] == "double"):
        return F.col(seq[0])
    if len(seq) == 2 and t[0] in _TIME + _INTS and t[1] in _INTS:
        hi = epoch_micros(seq[0], t[0]) if t[0] in _TIME else F.col(seq[0])
        return pack_pair(hi, F.col(seq[1]))
    return F.struct(*[F.col(c) for c in seq])


_SHIFT = 10 ** 20
_HALF = 1 << 63


def epoch_micros(col: str, dtype: str) -> Column:
    """Microseconds since the epoch, independent of the session time zone:
    a TIMESTAMP_NTZ is read as wall-clock time (what DuckDB's naive
    TIMESTAMP does), a TIMESTAMP as its instant."""
    if dtype == "timestamp_ntz":
        return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{col}`)")
    return F.unix_micros(F.col(col).cast("timestamp"))


def pack_pair(hi: Column, lo: Column) -> Column:
    """(hi, lo) of two longs -> one DECIMAL(38,0) with the same order, so
    min/max over it stays a hash aggregate.  ``unpack_lo`` reverses lo."""
    return (hi.cast("decimal(20,0)") * F.lit(str(_SHIFT)).cast("decimal(21,0)")
            + (lo.cast("decimal(20,0)") + F.lit(str(_HALF)).cast("decimal(20,0)"))).cast("decimal(38,0)")


def unpack_lo(packed: Column) -> Column:
    return (F.pmod(packed, F.lit(str(_SHIFT)).cast("decimal(21,0)"))
            - F.lit(str(_HALF)).cast("decimal(20,0)")).cast("bigint")


def last_rows(df: DataFrame, keys: Sequence[str], order: str, first: bool = False) -> DataFrame:
    """The row with the largest (smallest when ``first``) ``order`` per key.

    ``max_by`` with a string or struct value needs a sort-based aggregate
    over the whole input; this is a hash aggregate of (key, max order) and
    an equi-join back on (key, order), which AQE broadcasts when the key
    count is small.  ``order`` must be unique within a key."""
    agg = F.min(order) if first else F.max(order)
    best = df.groupBy(*keys).agg(agg.alias("_best"))
    return df.join(best, [*keys], "inner").filter(F.col(order) == F.col("_best")).drop("_best")


def argmax_key(score: Column, fb: Column, pid: Column) -> Column:
    """Orders like (score desc, fb asc, id asc) under ``max``, for any 64-bit
    score, block and id; a null block sorts as +infinity."""
    return F.struct(score.cast("bigint").alias("score"),
                    F.coalesce(F.bitwise_not(fb.cast("bigint")), F.bitwise_not(F.lit(MAX_BLOCK))).alias("fb"),
                    F.bitwise_not(pid.cast("bigint")).alias("id"))       # ~x reverses the order of all longs


def argmax_id(key: Column) -> Column:
    return F.bitwise_not(key["id"])


def version_runs(d: DataFrame, key: str, version: Sequence[str]) -> DataFrame:
    """Per participant, from the small per-version table: ``_cut`` = the
    largest seq of any row whose version differs from the last row's (null
    when there is one version), and ``latest`` = the last row's version."""
    per_version = d.groupBy(key, *version).agg(F.max("_seq").alias("_vmax"))
    newest = Window.partitionBy(key).orderBy(F.desc("_vmax"))         # a participant's versions, not its rows
    top = per_version.withColumn("_rank", F.row_number().over(newest)).filter("_rank <= 2")
    return top.groupBy(key).agg(
        F.max(F.when(F.col("_rank") == 2, F.col("_vmax"))).alias("_cut"),
        F.max_by(F.struct(*[F.col(v) for v in version]), -F.col("_rank")).alias("latest"))


def current_run(df: DataFrame, key: str = "participant",
                version: Sequence[str] = ("model", "revision"),
                seq: Sequence[str] = ("ts", "seq_id")) -> DataFrame:
    """Rows of each participant's last contiguous run of one version.

    Walking rows in ``seq`` order, any change of version starts a new run,
    so an earlier run of the same version does not count.  The run starts
    after ``cut`` = the largest seq of any row whose version differs from
    the last row's version = the second-largest per-version max seq.  All
    aggregation is hash-based (see ``order_key``); the raw rows meet only a
    one-row-per-participant table.
    """
    d = df.withColumn("_seq", order_key(df, seq))
    runs = version_runs(d, key, version).drop("latest")
    return (d.join(runs, key, "left")
            .filter(F.col("_cut").isNull() | (F.col("_seq") > F.col("_cut")))
            .drop("_cut"))


def current_run_islands(df: DataFrame, key: str = "participant",
                        version: Sequence[str] = ("model", "revision"),
                        seq: Sequence[str] = ("ts", "seq_id")) -> DataFrame:
    """Gaps-and-islands form of E1 (ordered window).  Test double only: it
    sorts each participant's rows in one task."""
    w = Window.partitionBy(key).orderBy(*seq)
    changed = F.lit(False)
    for v in version:
        changed = changed | ~F.lag(F.col(v)).over(w).eqNullSafe(F.col(v))
    d = df.withColumn("_chg", F.when(F.lag(F.lit(1)).over(w).isNull(), 1)
                      .when(changed, 1).otherwise(0))
    d = d.withColumn("_run", F.sum("_chg").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    d = d.withColumn("_maxrun", F.max("_run").over(Window.partitionBy(key)))
    return d.filter(F.col("_run") == F.col("_maxrun")).drop("_chg", "_run", "_maxrun")


# ---- D1 + E2 + E3 + D18 -----------------------------------------------------
def participant_summary(run: DataFrame, envs: Sequence[str], key: str = "participant",
                        latest: Sequence[str] = ("model", "revision"),
                        failed_col: str | None = None,
                        exclude_failed: bool = False) -> DataFrame:
    """One row per active participant with per-env arrays.

    ``n[i]``    successful samples in ``envs[i]`` within the current run
    ``succ[i]`` sum of their scores
    ``first_block`` min non-null block of the run (E2)
    ``latest``  struct of the last row's fields (E3)
    Rows whose env is not in ``envs`` are not counted (B2 whitelist).
    With ``failed_col`` set, ``n_failed[i]`` counts rows flagged as failed
    evaluations (D18) and ``n_kept[i]`` the successful others;
    ``exclude_failed`` drops failed ones from ``n``/``succ`` as well.
    """
    ok = F.col("success")
    if failed_col and exclude_failed:
        ok = ok & ~F.coalesce(F.col(failed_col), F.lit(False))
    n_cols, s_cols, f_cols, k_cols = [], [], [], []
    for e in envs:
        hit = ok & (F.col("env") == F.lit(e))
        n_cols.append(F.count_if(hit))
        s_cols.append(F.coalesce(F.sum(F.when(hit, F.col("score"))), F.lit(0.0)))
        if failed_col:
            failed = F.coalesce(F.col(failed_col), F.lit(False))
            f_cols.append(F.count_if((F.col("env") == F.lit(e)) & failed))
            k_cols.append(F.count_if(hit & ~failed))
    aggs = [F.array(*n_cols).alias("n"), F.array(*s_cols).alias("succ")]
    if "block" in run.columns:
        aggs.append(F.min("block").alias("first_block"))
    if latest and "_seq" in run.columns:
        aggs.append(F.max_by(F.struct(*[F.col(c) for c in latest]), F.col("_seq")).alias("latest"))
    if failed_col:
        aggs += [F.array(*f_cols).alias("n_failed"), F.array(*k_cols).alias("n_kept")]
    return run.groupBy(key).agg(*aggs)


def with_accuracy(summary: DataFrame) -> DataFrame:
    """acc[i] = succ[i]/n[i], 0.0 where n[i] = 0 (guarded: ANSI divide)."""
    return summary.withColumn(
        "acc", F.zip_with("succ", "n", lambda s, n: F.when(n > 0, s / n).otherwise(F.lit(0.0))))


def dense_grid(summary: DataFrame, registry: DataFrame, envs: Sequence[str],
               key: str = "participant", reg_key: str = "uid") -> DataFrame:
    """Dense (participant, env) grid over registry x envs.

    No cross join: every registry row carries the env list as a literal
    array and is exploded; participants without results get n = 0,
    acc = 0.0."""
    k = len(envs)
    zeros_i = F.array_repeat(F.lit(0), k)
    zeros_d = F.array_repeat(F.lit(0.0), k)
    s = with_accuracy(summary)
    g = registry.select(F.col(reg_key).alias(key)).join(s, key, "left")
    g = g.select(
        key,
        F.explode(F.arrays_zip(
            F.array(*[F.lit(e) for e in envs]).alias("env"),
            F.coalesce("n", zeros_i).alias("n"),
            F.coalesce("succ", zeros_d).alias("succ"),
            F.coalesce("acc", zeros_d).alias("acc"))).alias("z"),
        *[c for c in ("first_block",) if c in s.columns],
        F.col("n").isNotNull().alias("active"))
    return g.select(key, "z.env", F.col("z.n").cast("bigint").alias("n"), "z.succ", "z.acc",
                    *[c for c in ("first_block",) if c in s.columns], "active")


def sample_grid(results: DataFrame, registry: DataFrame, envs: Sequence[str],
                base=0, family: str | None = None, key: str = "participant",
                version: Sequence[str] = ("model", "revision"),
                seq: Sequence[str] = ("ts", "seq_id"), chunk: Column | None = None) -> DataFrame:
    """Member filter, family filter, current run, per-participant summary.

    Filters run before E1 on purpose: a filtered row does not break a run.
    The log is read once (see ``rollup``); ``chunk`` defaults to days of the
    time or epochs of the block that leads ``seq``.
    """
    from rankforge.operators.rollup import chunk_runs, merge_runs, time_chunk
    r = member_filter(results, registry, key)
    if family is not None:
        r = family_filter(r, family, base, key)
    if not version:      # one version: the run is every row
        return participant_summary(r, envs, key, latest=())
    chunks = chunk_runs(r, envs, time_chunk(r, seq) if chunk is None else chunk, key, version, seq)
    return merge_runs(chunks, len(envs), key)


def fb_infinite(col) -> "F.Column":
    """Missing first block sorts as +infinity."""
    return F.coalesce(col, F.lit(MAX_BLOCK).cast("bigint"))
