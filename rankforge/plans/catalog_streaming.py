"""Registered streaming queries (I1, I3-I8): each plays FX-EV / events as
arrivals in event-time order under the shared checkpoint dir, runs the stream
with ``availableNow`` through ``foreachBatch``, and returns the written
result as a batch DataFrame.  Oracles are the batch twins in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankforge import fixtures as fx
from rankforge.operators import results as R
from rankforge.plans.catalog import EV_ENVS, EV_FAMILY
from rankforge.plans.oracle import _EV_RUN
from rankforge.sources.results_log import scratch_path
from rankforge.streaming import live as S
from rankforge.streaming import tail as T
from rankforge.streaming import upload as U

Q: dict = {}


def register(name: str, sql: str | None):
    def deco(fn):
        Q[name] = (fn, sql)
        return fn
    return deco


_SLOTS = 3      # arrivals: each one or more micro-batches, so the stateful operators carry state


def _ev(spark, sf):
    return fx.fx_ev(spark, sf).withColumn("part", F.col("epoch_day"))


def _events(spark, sf):
    return fx.table(spark, sf, "events").withColumn("part", F.unix_date(F.to_date("ts")))


# ---- I4 + I7 (+ B4, B5 stream-static) ------------------------------------------------------
@register("live_runs_stream_ev", fx.duck_with("fx_ev") + _EV_RUN + """,
s AS (SELECT participant, env, count(*) FILTER (WHERE success) AS n,
             coalesce(sum(score) FILTER (WHERE success), 0.0) AS succ FROM cur GROUP BY ALL),
p AS (SELECT participant, min(block) AS first_block FROM cur GROUP BY participant)
SELECT p.participant, e.env, CAST(coalesce(s.n, 0) AS BIGINT) AS n, coalesce(s.succ, 0.0) AS succ, p.first_block
FROM p CROSS JOIN envs e LEFT JOIN s ON s.participant = p.participant AND s.env = e.env""")
def live_runs_stream_ev(spark: SparkSession, sf: str) -> DataFrame:
    reg = fx.registry(spark, sf)
    out = scratch_path(spark, "live-runs")

    def build(st):
        return S.live_runs(R.family_filter(R.member_filter(st, reg), EV_FAMILY, 0), EV_ENVS, tail_seconds=40 * 86400)

    S.replay(_ev(spark, sf), "part", build, S.batch_writer(out), "live-runs", _SLOTS, mode="update")
    res = spark.read.parquet(out)
    last = S.latest_per_key(res, ["participant"])
    z = last.select("participant", "first_block", F.posexplode(F.arrays_zip("n", "succ")).alias("i", "z"))
    envs = F.array(*[F.lit(e) for e in EV_ENVS])
    return z.select("participant", F.element_at(envs, F.col("i") + 1).alias("env"),
                    F.col("z.n").cast("bigint").alias("n"), F.col("z.succ").alias("succ"), "first_block")


# ---- I3 ----------------------------------------------------------------------------------
@register("window_grid_stream_ev", fx.duck_with("fx_ev") + """,
w AS (SELECT *, time_bucket(INTERVAL 6 HOUR, ts) - k * INTERVAL 6 HOUR AS ws
      FROM fx_ev CROSS JOIN (SELECT unnest(range(0, 4)) AS k))
SELECT epoch_us(ws) AS window_start_us, participant, env,
       count(*) FILTER (WHERE success) AS n, coalesce(sum(score) FILTER (WHERE success), 0.0) AS succ
FROM w GROUP BY ALL""")
def window_grid_stream_ev(spark: SparkSession, sf: str) -> DataFrame:
    """Windows of four panes; the stream keeps one row per pane."""
    out, pane_us = scratch_path(spark, "window-grid"), 6 * 3600 * 1_000_000

    def build(st):
        g = S.windowed_grid(st, "ts", "6 hours", "6 hours", "1 day")
        pane = F.floor(F.unix_micros(F.col("w.start")) / F.lit(pane_us)).cast("bigint")
        return g.select(pane.alias("pane"), "participant", "env", "n", "succ")

    S.replay(_ev(spark, sf), "part", build, S.batch_writer(out), "window-grid", _SLOTS, mode="update")
    panes = S.latest_per_key(spark.read.parquet(out), ["pane", "participant", "env"])
    return S.sliding_sums(panes, ["participant", "env"], "pane", 4, ["n", "succ"]).select(
        (F.col("pane") * pane_us).alias("window_start_us"), "participant", "env", "n", "succ")


# ---- I5 ----------------------------------------------------------------------------------
@register("stall_alarms_stream_ev", """
WITH g AS (SELECT user_id, event_id, epoch_us(ts) AS us, (epoch_us(ts) - lag(epoch_us(ts)) OVER w) / 1e6 AS gap
           FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
s AS (SELECT user_id, max(us) AS us FROM g GROUP BY user_id)
SELECT user_id AS key, event_id, gap, CAST(NULL AS BIGINT) AS silent_since_us FROM g WHERE gap > 14400
UNION ALL
SELECT user_id, NULL, NULL, us FROM s WHERE us // 1000 + 14400000 < (SELECT max(us) // 1000 FROM s)""")
def stall_alarms_stream_ev(spark: SparkSession, sf: str) -> DataFrame:
    """Ended gaps, and the alarms still open at the end of the stream."""
    ev = _events(spark, sf)
    out = scratch_path(spark, "stalls")
    S.replay(ev, "part", lambda st: S.stall_alarms(st, "user_id", 14400.0), S.batch_writer(out), "stalls", _SLOTS)
    a = spark.read.parquet(out).select("key", "event_id", "gap", "silent_since_us")
    last = ev.groupBy(F.col("user_id").cast("bigint").alias("key")).agg(
        F.max(R.epoch_micros("ts", dict(ev.dtypes)["ts"])).alias("silent_since_us"))
    still = a.where("silent_since_us is not null").join(last, ["key", "silent_since_us"], "left_semi")
    ended = a.where("silent_since_us is null").withColumn("gap", F.nanvl("gap", F.lit(None).cast("double")))
    return ended.unionByName(still.withColumn("gap", F.lit(None).cast("double")))


# ---- I6 ----------------------------------------------------------------------------------
@register("tempo_gate_stream_ev", fx.duck_with("fx_ev") + f""",
a AS (SELECT block, epoch_day + CASE WHEN seq_id % 7 = 0 THEN 6 ELSE 0 END AS part FROM fx_ev),
t AS (SELECT min(part) AS lo, CAST(ceil((max(part) - min(part) + 1) / {_SLOTS}.0) AS INTEGER) AS step FROM a),
g AS (SELECT DISTINCT CAST(floor((part - lo) / step) AS INTEGER) AS slot, block FROM a, t WHERE block % 100 = 0),
m AS (SELECT slot, max(max(block)) OVER (ORDER BY slot ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last
      FROM g GROUP BY slot)
SELECT g.block, CAST(g.slot AS BIGINT) AS arrival FROM g JOIN m USING (slot) WHERE m.last IS NULL OR g.block > m.last""")
def tempo_gate_stream_ev(spark: SparkSession, sf: str) -> DataFrame:
    """One row in seven arrives six days late, so gate blocks come again and
    come after later ones; neither may fire."""
    out = scratch_path(spark, "tempo")
    ev = fx.fx_ev(spark, sf).withColumn("part", F.col("epoch_day") + F.when(F.col("seq_id") % 7 == 0, 6).otherwise(0))
    S.replay(ev, "part", lambda st: st.select("block"), S.gate_writer(out), "tempo", _SLOTS)
    return spark.read.parquet(f"{out}/fired").select("block", F.col("microbatch").cast("bigint").alias("arrival"))


# ---- I1 ----------------------------------------------------------------------------------
@register("sink_stream_ev", fx.duck_with("fx_ev") + """
SELECT participant, count(*) AS rows, sum(score) AS score_sum FROM fx_ev WHERE success GROUP BY participant""")
def sink_stream_ev(spark: SparkSession, sf: str) -> DataFrame:
    out = scratch_path(spark, "sink")
    S.replay(_ev(spark, sf), "part", lambda st: st, S.results_writer(out), "sink", _SLOTS)
    return spark.read.parquet(out).groupBy("participant").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("score").alias("score_sum"))


# ---- I1 (two buffers) ---------------------------------------------------------------------
_UP_SIZE, _UP_AGE, _UP_LEAST = 5, 6 * 3600, 12


@register("upload_stream_ev", f"""
WITH RECURSIVE o AS (SELECT user_id, event_id, epoch_us(ts) AS us,
                            row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events),
r AS (SELECT user_id, rn, event_id, 0 AS batch, us AS bstart, 1 AS cnt FROM o WHERE rn = 1
      UNION ALL
      SELECT o.user_id, o.rn, o.event_id,
             CASE WHEN r.cnt >= {_UP_SIZE} OR o.us >= r.bstart + {_UP_AGE * 1_000_000} THEN r.batch + 1 ELSE r.batch END,
             CASE WHEN r.cnt >= {_UP_SIZE} OR o.us >= r.bstart + {_UP_AGE * 1_000_000} THEN o.us ELSE r.bstart END,
             CASE WHEN r.cnt >= {_UP_SIZE} OR o.us >= r.bstart + {_UP_AGE * 1_000_000} THEN 1 ELSE r.cnt + 1 END
      FROM r JOIN o ON o.user_id = r.user_id AND o.rn = r.rn + 1),
b AS (SELECT user_id, batch, min(bstart) AS bstart, count(*) AS n FROM r GROUP BY user_id, batch),
l AS (SELECT *, max(batch) OVER (PARTITION BY user_id) AS last FROM b),
c AS (SELECT user_id, batch, n FROM l WHERE batch < last OR n >= {_UP_SIZE}
      OR (bstart + {_UP_AGE * 1_000_000}) // 1000 < (SELECT max(epoch_us(ts)) // 1000 FROM events)),
x AS (SELECT user_id, batch, 0 AS upload, n AS buffered FROM c WHERE batch = 0
      UNION ALL
      SELECT c.user_id, c.batch, CASE WHEN x.buffered >= {_UP_LEAST} THEN x.upload + 1 ELSE x.upload END,
             CASE WHEN x.buffered >= {_UP_LEAST} THEN c.n ELSE x.buffered + c.n END
      FROM x JOIN c ON c.user_id = x.user_id AND c.batch = x.batch + 1),
d AS (SELECT user_id, upload FROM x GROUP BY user_id, upload HAVING max(buffered) >= {_UP_LEAST})
SELECT CAST(r.user_id AS BIGINT) AS producer, r.event_id, CAST(r.batch AS BIGINT) AS batch, CAST(x.upload AS BIGINT) AS upload
FROM r JOIN x ON x.user_id = r.user_id AND x.batch = r.batch JOIN d ON d.user_id = x.user_id AND d.upload = x.upload""")
def upload_stream_ev(spark: SparkSession, sf: str) -> DataFrame:
    """The results of complete uploads; open batches and short buffers stay back."""
    out = scratch_path(spark, "upload")
    S.replay(_events(spark, sf), "part", lambda st: U.uploads(st, "user_id", _UP_SIZE, _UP_AGE, _UP_LEAST),
             S.batch_writer(out), "upload", _SLOTS)
    return U.uploaded(spark, out)


# ---- I4 + I7 (late rows, expiry) -------------------------------------------------------------
_LATE_DAYS, _TAIL_DAYS = 5, 12
_ARRIVALS = f"""a AS (SELECT *, epoch_day + CASE WHEN seq_id % 5 = 0 THEN {_LATE_DAYS} ELSE 0 END AS part FROM f),
t AS (SELECT min(part) AS lo, CAST(ceil((max(part) - min(part) + 1) / {_SLOTS}.0) AS INTEGER) AS step FROM a),
s AS (SELECT a.*, CAST(floor((part - lo) / step) AS INTEGER) AS slot FROM a, t),
h AS (SELECT slot, max(max(epoch_day)) OVER (ORDER BY slot ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen
      FROM s GROUP BY slot)"""


def _live_tail(spark: SparkSession, sf: str, name: str) -> str:
    """Play the log with one row in five days late; the folder of the live tail."""
    path, reg = scratch_path(spark, name), fx.registry(spark, sf)
    rows = R.family_filter(R.member_filter(fx.fx_ev(spark, sf), reg), EV_FAMILY, 0)
    rows = rows.withColumn("part", F.col("epoch_day") + F.when(F.col("seq_id") % 5 == 0, _LATE_DAYS).otherwise(0))
    S.replay(rows, "part", lambda st: st, T.tail_writer(path, EV_ENVS, F.col("epoch_day"), 1), name, _SLOTS)
    return path


@register("live_tail_stream_ev", fx.duck_with("fx_ev") + _EV_RUN.replace(
    "FROM f WINDOW", f"FROM (SELECT * FROM f WHERE epoch_day > (SELECT max(epoch_day) - {_TAIL_DAYS} FROM f)) f WINDOW") + """,
s AS (SELECT participant, env, count(*) FILTER (WHERE success) AS n,
             coalesce(sum(score) FILTER (WHERE success), 0.0) AS succ FROM cur GROUP BY ALL),
p AS (SELECT participant, min(block) AS first_block FROM cur GROUP BY participant)
SELECT p.participant, e.env, CAST(coalesce(s.n, 0) AS BIGINT) AS n, coalesce(s.succ, 0.0) AS succ, p.first_block
FROM p CROSS JOIN envs e LEFT JOIN s ON s.participant = p.participant AND s.env = e.env""")
def live_tail_stream_ev(spark: SparkSession, sf: str) -> DataFrame:
    """Rows arrive out of order; the live result is the batch result."""
    got = T.tail_summary(spark, _live_tail(spark, sf, "live-tail"), EV_ENVS, _TAIL_DAYS)
    z = got.select("participant", "first_block", F.posexplode(F.arrays_zip("n", "succ")).alias("i", "z"))
    envs = F.array(*[F.lit(e) for e in EV_ENVS])
    return z.select("participant", F.element_at(envs, F.col("i") + 1).alias("env"),
                    F.col("z.n").cast("bigint").alias("n"), F.col("z.succ").alias("succ"), "first_block")


@register("live_tail_late_ev", fx.duck_with("fx_ev") + _EV_RUN + f""",
{_ARRIVALS}
SELECT participant, 'late' AS kind, CAST(count(*) AS BIGINT) AS value
FROM s JOIN h USING (slot) WHERE epoch_day < h.seen - 1 GROUP BY participant
UNION ALL
SELECT participant, 'expired', CAST(max(epoch_day) AS BIGINT) FROM f GROUP BY participant
HAVING max(epoch_day) <= (SELECT max(epoch_day) FROM f) - 1""")
def live_tail_late_ev(spark: SparkSession, sf: str) -> DataFrame:
    """How many rows came late, and who has no result on the newest day."""
    path = _live_tail(spark, sf, "live-late")
    late = T.late_rows(spark, path).select("participant", F.lit("late").alias("kind"), F.col("rows").alias("value"))
    gone = T.expired(spark, path, 1).select("participant", F.lit("expired").alias("kind"), F.col("last_chunk").alias("value"))
    return late.unionByName(gone)


# ---- I8 ----------------------------------------------------------------------------------
@register("refresh_join_stream_ev", fx.duck_with("fx_ev", "registry") + f""",
t AS (SELECT min(epoch_day) AS lo, CAST(ceil((max(epoch_day) - min(epoch_day) + 1) / {_SLOTS}.0) AS INTEGER) AS step FROM fx_ev),
s AS (SELECT participant, CAST(floor((epoch_day - lo) / step) AS INTEGER) AS slot FROM fx_ev, t)
SELECT participant, count(*) AS rows FROM s WHERE participant IN (SELECT uid FROM registry) AND participant % 3 <> slot
GROUP BY participant""")
def refresh_join_stream_ev(spark: SparkSession, sf: str) -> DataFrame:
    """The registry changes between arrivals: one third of it is away in each."""
    out, folder, now = scratch_path(spark, "refresh"), scratch_path(spark, "registry"), {}

    def refresh(slot: int) -> None:
        now["path"] = f"{folder}/version={slot}"
        fx.registry(spark, sf).filter(F.col("uid") % 3 != slot).write.parquet(now["path"])

    S.replay(_ev(spark, sf), "part", lambda st: st, S.refreshed_members(lambda s: s.read.parquet(now["path"]), out),
             "refresh", _SLOTS, before=refresh)
    return spark.read.parquet(out).groupBy("participant").agg(F.count(F.lit(1)).alias("rows"))


# ---- I2 (size-or-age rule) ------------------------------------------------------------------
_FLUSH_SIZE, _FLUSH_AGE = 5, 6 * 3600


@register("flush_batches_stream_ev", f"""
WITH RECURSIVE o AS (SELECT user_id, event_id, epoch_us(ts) AS us,
                            row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events),
r AS (SELECT user_id, rn, event_id, 0 AS batch, us AS bstart, 1 AS cnt FROM o WHERE rn = 1
      UNION ALL
      SELECT o.user_id, o.rn, o.event_id,
             CASE WHEN r.cnt >= {_FLUSH_SIZE} OR o.us >= r.bstart + {_FLUSH_AGE * 1_000_000} THEN r.batch + 1 ELSE r.batch END,
             CASE WHEN r.cnt >= {_FLUSH_SIZE} OR o.us >= r.bstart + {_FLUSH_AGE * 1_000_000} THEN o.us ELSE r.bstart END,
             CASE WHEN r.cnt >= {_FLUSH_SIZE} OR o.us >= r.bstart + {_FLUSH_AGE * 1_000_000} THEN 1 ELSE r.cnt + 1 END
      FROM r JOIN o ON o.user_id = r.user_id AND o.rn = r.rn + 1)
SELECT CAST(user_id AS BIGINT) AS producer, event_id, CAST(batch AS BIGINT) AS batch FROM r""")
def flush_batches_stream_ev(spark: SparkSession, sf: str) -> DataFrame:
    out = scratch_path(spark, "flush")
    S.replay(_events(spark, sf), "part", lambda st: S.flush_batches(st, "user_id", _FLUSH_SIZE, _FLUSH_AGE),
             S.batch_writer(out), "flush", _SLOTS)
    return spark.read.parquet(out).select("producer", "event_id", "batch")


QUERIES = {k: v[0] for k, v in Q.items()}
ORACLE = {k: v[1] for k, v in Q.items() if v[1] is not None}
