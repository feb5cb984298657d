"""Operational operators over the scheduler / service logs: env-name
handling, leases, fan-out planning, status rollups, attempt resolution,
ordinals, stalls, tempo gate, retry schedule, task ids, fingerprints.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankforge.config import (ACTIVE_ENVS, CHALLENGE_MAX_USES, DATA_LEN, ENV_PREFIXES, TEMPO,
                              TERMINAL_STATUS)

DEFAULT_LEASE_TIMEOUT = 300.0


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ---- B2 -----------------------------------------------------------------------------
def parse_env(c, active: Sequence[str] = ACTIVE_ENVS) -> Column:
    """Strip; the name must be an active env; ``prefix:name`` splits on the
    first ':' and the prefix must be known; a bare name is an arena env.
    struct(valid, prefix, name)."""
    s = F.regexp_replace(_c(c), r"^\s+|\s+\z", "")
    has = F.contains(s, F.lit(":"))
    prefix = F.when(has, F.substring_index(s, ":", 1)).otherwise(F.lit("arena"))
    name = F.when(has, F.regexp_replace(s, r"^[^:]*:", "")).otherwise(s)
    valid = s.isin(list(active)) & prefix.isin(list(ENV_PREFIXES))
    return F.struct(valid.alias("valid"), F.when(valid, prefix).alias("prefix"),
                    F.when(valid, name).alias("name"))


# ---- B3 -----------------------------------------------------------------------------
def parse_env_list(spec) -> Column:
    """Comma list -> array<struct<prefix,name>>: blanks dropped, a bare token
    gets the arena prefix, unknown prefixes are skipped.  An empty result
    is an error for the caller (``size == 0``)."""
    toks = F.filter(F.transform(F.split(F.coalesce(_c(spec), F.lit("")), ","),
                                lambda t: F.regexp_replace(t, r"^\s+|\s+\z", "")), lambda t: t != "")
    parsed = F.transform(toks, lambda t: F.struct(
        F.when(F.contains(t, F.lit(":")), F.substring_index(t, ":", 1)).otherwise(F.lit("arena")).alias("prefix"),
        F.when(F.contains(t, F.lit(":")), F.regexp_replace(t, r"^[^:]*:", "")).otherwise(t).alias("name")))
    return F.filter(parsed, lambda p: p["prefix"].isin(list(ENV_PREFIXES)))


# ---- B12 -----------------------------------------------------------------------------
def catalogue_filter(df: DataFrame, min_price: float, max_price: float, min_context: int) -> DataFrame:
    """Models priced within [min, max], context (context_length else
    max_model_len else 0) >= min, 'text' in both modality lists."""
    ctx = F.coalesce(F.col("context_length"), F.col("max_model_len"), F.lit(0))
    empty = F.array().cast("array<string>")
    return df.filter(F.col("price").between(min_price, max_price) & (ctx >= min_context)
                     & F.array_contains(F.coalesce("input_modalities", empty), "text")
                     & F.array_contains(F.coalesce("output_modalities", empty), "text"))


# ---- B14 ----------------------------------------------------------------------------
def split_valid_participants(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, quarantine): a participant needs a model and a slug."""
    ok = F.coalesce(F.col("model") != "", F.lit(False)) & F.coalesce(F.col("slug") != "", F.lit(False))
    return df.filter(ok), df.filter(~ok).withColumn("reason", F.lit("missing model or slug"))


# ---- B15 / B16 ----------------------------------------------------------------------
def stale_leases(leases: DataFrame, now: float) -> DataFrame:
    """Leases to reap: idle (now >= last_active + timeout) or past their
    lifetime (now >= created + max(2*timeout, timeout + 60)).  Missing
    last_active -> created; missing timeout -> 300 s."""
    t = F.coalesce(F.col("timeout_seconds").cast("double"), F.lit(DEFAULT_LEASE_TIMEOUT))
    last = F.coalesce(F.col("last_active_at"), F.col("created_at"))
    idle = F.lit(now) >= last + t
    life = F.lit(now) >= F.col("created_at") + F.greatest(t * 2, t + 60)
    return leases.withColumn("idle", idle).withColumn("expired", life).filter(idle | life)


def orphan_leases(leases: DataFrame, containers: DataFrame) -> DataFrame:
    """Lease rows whose container is gone; rows without a container id are
    kept (anti join on the id, nulls never match)."""
    live = containers.select(F.col("container_id").alias("_cid")).distinct()
    return leases.join(live, leases["container_id"] == live["_cid"], "left_anti")


# ---- C7 / C8 --------------------------------------------------------------------------
_DRAW_HEX, _DRAW_TRIES = 15, 64


def task_id(seed: int, *keys: Column, data_len=None) -> Column:
    """M7: unbiased draw in [0, data_len) from a seeded hash of the keys;
    data_len null or 0 -> the default.

    The k-th number of a draw is the first 60 bits of
    sha256("seed:key:...:k").  Numbers at or above the largest multiple of the
    range are rejected, so every result is equally likely; the first accepted
    one counts.  (The last of 64 tries is taken as it is; all are rejected
    with a chance below 2^-64.)"""
    n = F.coalesce(F.nullif(_c(data_len), F.lit(0)), F.lit(DATA_LEN)) if data_len is not None \
        else F.lit(DATA_LEN)
    n = n.cast("bigint")
    name = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(k.cast("string"), F.lit("null")) for k in keys], F.lit(""))
    full = F.expr(f"{1 << 4 * _DRAW_HEX}L")
    limit = full - F.pmod(full, n)

    def attempt(k: Column) -> Column:
        return F.conv(F.substring(F.sha2(F.concat(name, k.cast("string")), 256), 1, _DRAW_HEX), 16, 10).cast("bigint")

    def step(found: Column, k: Column) -> Column:
        x = attempt(k)
        return F.coalesce(found, F.when((x < limit) | (k == _DRAW_TRIES - 1), F.pmod(x, n)))

    return F.aggregate(F.sequence(F.lit(0), F.lit(_DRAW_TRIES - 1)), F.lit(None).cast("bigint"), step)


def normalise_task_ids(ids, seed: int, *keys: Column) -> Column:
    """M7: explicit ids kept (an int becomes a one-element list); null or
    empty -> one seeded draw."""
    return F.when(F.coalesce(F.size(_c(ids)), F.lit(0)) > 0, _c(ids)) \
        .otherwise(F.array(task_id(seed, *keys)))


def fan_out(participants: DataFrame, envs: Sequence[str], inflight: DataFrame | None,
            round_col: Column, seed: int = 0) -> DataFrame:
    """One task per (env, participant with a model) for every env that
    has no work in flight; all tasks of an env round share one task id.
    The env list is a plan constant, so it is exploded on each participant
    row (a generator, not a join)."""
    p = participants.filter(F.col("model").isNotNull() & (F.col("model") != ""))
    t = p.select("*", F.explode(F.array(*[F.lit(e) for e in envs])).alias("env"))
    if inflight is not None:
        t = t.join(inflight.select("env").distinct(), "env", "left_anti")
    return t.withColumn("task_id", task_id(seed, F.col("env"), round_col))


def challenge_tasks(challenges: DataFrame, participants: DataFrame, key: str = "item_id",
                    bucket_rows: int = 1000) -> DataFrame:
    """Every challenge of a run is posed to every participant with a
    model.  Challenges are dealt into buckets of about ``bucket_rows`` by
    hash; each participant is sent to every bucket and meets each challenge
    once, in the equi-join on the bucket.  Neither side is ever gathered,
    whatever its size."""
    p = participants.filter(F.col("model").isNotNull() & (F.col("model") != "")).select("uid", "model")
    buckets = challenges.agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / F.lit(bucket_rows))).cast("int")).scalar()
    c = challenges.select(key, F.pmod(F.xxhash64(key), buckets).cast("int").alias("_b"))
    return p.select("*", F.explode(F.sequence(F.lit(0), buckets - 1)).alias("_b")).join(c, "_b").select("uid", "model", key)


# ---- D19 ------------------------------------------------------------------------------
def status_rollup(events: DataFrame, ts: str = "ts", every: str = "30 seconds",
                  seconds: int = 30) -> DataFrame:
    """Requests and requests/s per tumbling window."""
    g = events.groupBy(F.window(ts, every).alias("w")).agg(F.count(F.lit(1)).alias("requests"))
    return g.select(F.col("w.start").alias("window_start"), "requests",
                    (F.col("requests") / F.lit(float(seconds))).alias("rps"))


def flow_rollup(requests: DataFrame, started: str = "started", done: str = "done", flushed: str = "flushed",
                seconds: int = 30, chunk_s: int = 86400) -> DataFrame:
    """Per tumbling window the requests started and, at its end, those in
    flight (started, not done) and queued (done, not flushed).  Times are in
    seconds; null: not yet.  Each step changes a count by one; the changes are
    summed per window, and the running sums go over days first and inside a
    day then, so no task orders the whole log."""
    steps = F.array(*[F.struct(F.col(c).cast("double").alias("t"), F.lit(a).alias("r"), F.lit(b).alias("f"), F.lit(q).alias("q"))
                      for c, a, b, q in ((started, 1, 1, 0), (done, 0, -1, 1), (flushed, 0, 0, -1))])
    s = requests.select(F.explode(steps).alias("s")).select("s.*").filter("t is not null")
    w = s.groupBy((F.floor(F.col("t") / seconds) * seconds).cast("bigint").alias("window_start")).agg(
        F.sum("r").alias("requests"), F.sum("f").alias("_f"), F.sum("q").alias("_q"))
    w = w.withColumn("_c", F.floor(F.col("window_start") / chunk_s))
    days = w.groupBy("_c").agg(F.sum("_f").alias("_df"), F.sum("_q").alias("_dq"))
    before = Window.orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)       # one row per day
    days = days.select("_c", *[F.coalesce(F.sum(x).over(before), F.lit(0)).alias(x) for x in ("_df", "_dq")])
    run = Window.partitionBy("_c").orderBy("window_start").rowsBetween(Window.unboundedPreceding, 0)
    return w.join(days, "_c").select(
        "window_start", "requests", (F.col("requests") / F.lit(float(seconds))).alias("rps"),
        (F.col("_df") + F.sum("_f").over(run)).alias("in_flight"), (F.col("_dq") + F.sum("_q").over(run)).alias("queued"))


# ---- D20 / M6 ------------------------------------------------------------------------
def resolve_attempts(attempts: DataFrame, req: str = "request_id") -> DataFrame:
    """The first success ends a request; a terminal status (400/404/410)
    ends it as a failure at once; otherwise the last attempt's failure
    stands.  Rows: request, attempts, success, error.  Hash aggregate of the
    ending attempt number, then an equi-join back for its outcome."""
    ok = F.coalesce(F.col("success"), F.lit(False))
    stop = ok | F.col("status").isin(list(TERMINAL_STATUS))
    g = attempts.groupBy(req).agg(F.min(F.when(stop, F.col("attempt"))).alias("_stop"),
                                  F.max("attempt").alias("_last"))
    end = g.select(req, F.coalesce("_stop", "_last").alias("attempts"))
    a = attempts.select(req, F.col("attempt").alias("attempts"), ok.alias("success"), F.col("error"))
    return end.join(a, [req, "attempts"]).select(
        req, "attempts", "success", F.when(~F.col("success"), F.col("error")).alias("error"))


def retry_delay(attempt, backoff: float) -> Column:
    """M6 expected wait before retry ``attempt`` (jitter averages out)."""
    return F.lit(float(backoff)) * F.pow(F.lit(2.0), _c(attempt) - 1)


# ---- D21 / D22 ------------------------------------------------------------------------
def listing_by_type(df: DataFrame, type_col: str = "type", name_col: str = "name") -> DataFrame:
    """Names grouped by type, sorted and distinct (the registry listing)."""
    return df.groupBy(type_col).agg(F.array_sort(F.collect_set(name_col)).alias("names"))


def glob_regex(pattern: str) -> str:
    """A shell pattern as a regular expression for whole strings: ``*`` any
    text, ``?`` one character, ``[...]`` one of a set, ``[!...]`` none of it."""
    out, i = "", 0
    while i < len(pattern):
        c, i = pattern[i], i + 1
        end = pattern.find("]", i + 1 + (pattern[i:i + 1] == "!")) if c == "[" else -1
        if c == "*":
            out += ".*"
        elif c == "?":
            out += "."
        elif end >= 0:
            body = pattern[i:end]
            neg = body.startswith("!")
            body = body[neg:].replace("\\", "\\\\").replace("[", "\\[").replace("&&", "&\\&").replace("^", "\\^")
            out, i = out + f"[{'^' * neg}{body}]", end + 1
        else:
            out += re.escape(c)
    return f"(?s)^(?:{out})\\z"


def _whole(regex: str):
    return lambda x: x.rlike(regex)


def exclude_paths(files: DataFrame, patterns: Sequence[str], path: str = "path") -> DataFrame:
    """Drop manifest rows whose path, or a folder above it, matches a
    pattern: as a whole, or in any part when the pattern has no ``/``.
    ``!`` patterns, blank ones and comments are skipped, a trailing ``/`` is
    dropped; files named ``.git...`` always go.  A null path stays."""
    parts = F.split(F.col(path), "/", -1)
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, 1, i), "/"))
    drop = F.startswith(F.element_at(parts, -1), F.lit(".git"))
    for p in (x.strip() for x in patterns):
        if not p or p.startswith(("!", "#")):
            continue
        p = p.rstrip("/")
        drop = drop | F.exists(above, _whole(glob_regex(p)))
        if "/" not in p:
            drop = drop | F.exists(parts, _whole(glob_regex(p)))
    return files.filter(~F.coalesce(drop, F.lit(False)))


def content_fingerprint(files: DataFrame, set_col: str, path: str = "path", content: str = "content",
                        params: dict | None = None) -> DataFrame:
    """(set, fingerprint, files): the root of each file set's hash tree
    (``merkle``).  ``params`` (build arguments) are folded in as JSON with
    sorted keys."""
    from rankforge.operators import merkle
    out = merkle.roots(merkle.tree(merkle.leaves(files, set_col, path, content), set_col), set_col)
    if params:
        fold = F.concat(F.col("fingerprint"), F.lit(json.dumps(params, sort_keys=True)))
        out = out.withColumn("fingerprint", F.sha2(fold, 256))
    return out


# ---- ordinals (E9 / E10 / T27) ---------------------------------------------------------------
def ordinal_within(df: DataFrame, key: str, order: Sequence[str], chunk: Column) -> DataFrame:
    """1-based ordinal of each row within ``key`` in ``order``, without a
    window over the whole key: rows are counted per (key, chunk) where
    ``chunk`` is monotone in ``order``; per-chunk offsets are a running sum
    over the small (key, chunk) count table; the final row_number runs
    within one chunk only."""
    d = df.withColumn("_chunk", chunk)
    counts = d.groupBy(key, "_chunk").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(key).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0))).drop("_n")
    rn = F.row_number().over(Window.partitionBy(key, "_chunk").orderBy(*order))
    return d.join(offs, [key, "_chunk"]).withColumn("ordinal", F.col("_off") + rn).drop("_chunk", "_off")


def running_before(df: DataFrame, key: str, order: Sequence[str], value: str, out: str, chunk: Column) -> DataFrame:
    """Adds ``out``: the sum of ``value`` over the rows before each row within
    ``key``, with the same split into chunks as ``ordinal_within``."""
    d = df.withColumn("_chunk", chunk)
    sums = d.groupBy(key, "_chunk").agg(F.sum(value).alias("_s"))
    w = Window.partitionBy(key).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offs = sums.withColumn("_off", F.coalesce(F.sum("_s").over(w), F.lit(0))).drop("_s")
    inside = Window.partitionBy(key, "_chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(value).over(inside), F.lit(0))
    return d.join(offs, [key, "_chunk"]).withColumn(out, F.col("_off") + before).drop("_chunk", "_off")


def challenge_generation(ordinal: Column, max_uses: int = CHALLENGE_MAX_USES) -> Column:
    """A challenge serves ``max_uses`` requests, then a new one."""
    return F.floor((ordinal - 1) / F.lit(max_uses))


def round_counter(rounds_done: Column, data_len=None) -> Column:
    """Env round index modulo the env's data length (null/0 -> 200)."""
    n = F.coalesce(F.nullif(_c(data_len), F.lit(0)), F.lit(DATA_LEN)) if data_len is not None \
        else F.lit(DATA_LEN)
    return F.pmod(rounds_done, n)


# ---- E12 -------------------------------------------------------------------------------
def stalls(beats: DataFrame, key: str, ts: str, timeout_s: float, chunk_s: float = 86400.0,
           tie: str | None = None) -> DataFrame:
    """Gaps between consecutive heartbeats longer than the timeout, with a
    session id that increases after each stall.

    A process may own a large share of the log, so nothing windows a whole
    key: ordered windows run inside (key, day) chunks; each chunk's first
    gap is taken from the previous chunk's last heartbeat, and the session
    offset is a running sum, both over the small (key, chunk) table."""
    from rankforge.operators.results import epoch_micros
    t = epoch_micros(ts, dict(beats.dtypes)[ts]) / 1e6
    d = beats.withColumn("_t", t).withColumn("_c", F.floor(F.col("_t") / chunk_s).cast("bigint"))
    order = ["_t"] + ([tie] if tie else [])
    w = Window.partitionBy(key, "_c").orderBy(*order)
    d = d.withColumn("_prev", F.lag("_t").over(w))
    per_chunk = d.groupBy(key, "_c").agg(F.max("_t").alias("_last"), F.min("_t").alias("_first"))
    cw = Window.partitionBy(key).orderBy("_c")
    per_chunk = per_chunk.withColumn("_carry", F.lag("_last").over(cw))
    # stalls inside a chunk plus the one at its start, then session offsets
    d = d.join(per_chunk.select(key, "_c", "_carry"), [key, "_c"])
    d = d.withColumn("gap", F.col("_t") - F.coalesce(F.col("_prev"), F.col("_carry")))
    d = d.withColumn("stalled", F.coalesce(F.col("gap") > timeout_s, F.lit(False)))
    n_st = d.groupBy(key, "_c").agg(F.count_if("stalled").alias("_ns"))
    offs = n_st.withColumn("_off", F.coalesce(F.sum("_ns").over(
        cw.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_ns")
    d = d.join(offs, [key, "_c"])
    d = d.withColumn("session", F.col("_off") + F.sum(F.col("stalled").cast("int")).over(
        w.rowsBetween(Window.unboundedPreceding, 0)))
    return d.drop("_t", "_c", "_prev", "_carry", "_off")


# ---- I6 (batch form) --------------------------------------------------------------------------
def tempo_gate(blocks: DataFrame, block: str = "block", tempo: int = TEMPO) -> DataFrame:
    """Blocks at which a recompute fires: block % tempo == 0, once each."""
    return blocks.filter(F.pmod(F.col(block), F.lit(tempo)) == 0).select(block).dropDuplicates([block])
