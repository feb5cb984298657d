"""Replays, whole files, total orders, long logs and silent processes."""

import json
import tempfile

import pytest
from pyspark.sql import functions as F

from rankforge.functions.text import shard_key
from rankforge.operators import dominance as D
from rankforge.operators import ops as O
from rankforge.operators import results as R
from rankforge.plans import scoring as P
from rankforge.sources import results_log as L
from rankforge.streaming import live as S


def _row(i, hk="h", env="vector:sat"):
    return {"version": "1", "hotkey": "up", "miner": {"uid": i, "hotkey": hk, "model": "m/x", "revision": "r", "block": 100},
            "challenge": {"env": env, "prompt": "p"}, "response": {"success": True}, "evaluation": {"env": env, "score": 1.0}}


def test_replayed_sink_batch_replaces_itself(spark, tmp_path):
    df = spark.createDataFrame([(i, True, 20 * i) for i in range(10)], "id long, success boolean, block long")
    write = S.results_writer(str(tmp_path / "log"))
    write(df, 0)
    write(df, 0)
    write(df, 1)
    assert spark.read.parquet(str(tmp_path / "log")).count() == 20


def test_pretty_printed_shard(spark):
    d = tempfile.mkdtemp(prefix="rf-pretty-")
    with open(f"{d}/000000100-up-1.json", "w") as f:
        json.dump([_row(1), _row(2)], f, indent=2)
    with open(f"{d}/000000900-up-2.json", "w") as f:
        json.dump([_row(3)], f)
    good, bad = L.read_shards(spark, d)
    assert sorted(r.uid for r in good.select("miner.uid").collect()) == [1, 2, 3] and bad.count() == 0
    tail, _ = L.read_shards(spark, d, windows=(800, 1000))
    assert [r.uid for r in tail.select("miner.uid").collect()] == [3]


def test_batches_of_one_window_have_a_total_order(spark, tmp_path):
    rows = spark.createDataFrame([(json.dumps(_row(i)), i) for i in range(900)], "j string, i int")
    df = rows.select(F.from_json("j", L.RESULT).alias("r"), "i").select("r.*", F.col("i").alias("seq_key"),
                                                                       F.floor(F.col("i") / 300).cast("long").alias("batch"))
    L.write_shards(df, str(tmp_path / "shards"))
    good, _ = L.read_shards(spark, str(tmp_path / "shards"))
    assert good.count() == 900 and good.select("seq").distinct().count() == 900
    order = [r.uid for r in good.orderBy("seq").select("miner.uid").collect()]
    assert order == list(range(900))
    assert spark.range(1).select(shard_key(F.lit(100), F.lit("up"), F.lit(2)).alias("k")).first().k == "000000100-up-2"


def test_ordinals_over_sixty_days(spark):
    e = spark.range(600).selectExpr("id AS seq_id", "timestamp'2024-01-01' + make_interval(0, 0, 0, 0, id * 3) AS ts",
                                    "'e' AS env")
    o = O.ordinal_within(e, "env", ["ts", "seq_id"], F.unix_date(F.to_date("ts")))
    assert all(r.ordinal == r.seq_id + 1 for r in o.collect())


def test_challenges_without_a_cap(spark):
    ch, p = spark.range(2500).selectExpr("id AS item_id"), spark.range(7).selectExpr("id AS uid", "if(id = 3, '', 'm') AS model")
    t = O.challenge_tasks(ch, p, bucket_rows=100)
    assert t.count() == 2500 * 6 and t.distinct().count() == 2500 * 6
    assert O.challenge_tasks(ch.limit(0), p).count() == 0


@pytest.mark.parametrize("ids", [(0, 1, 2), (10 ** 15, 10 ** 16, -5)])
def test_argmax_takes_any_id_and_block(spark, ids):
    df = spark.createDataFrame([(5, None, ids[0]), (5, 10 ** 18, ids[1]), (4, 1, ids[2])], "s long, fb long, id long")
    got = df.agg(R.argmax_id(F.max(R.argmax_key(F.col("s"), F.col("fb"), F.col("id")))).alias("w")).first().w
    assert got == ids[1]
    tie = spark.createDataFrame([(5, 7, ids[1]), (5, 7, ids[0])], "s long, fb long, id long")
    assert tie.agg(R.argmax_id(F.max(R.argmax_key(F.col("s"), F.col("fb"), F.col("id")))).alias("w")).first().w == min(ids[:2])


def test_idle_participants_stand_on_the_second_rung(spark):
    flagged = spark.createDataFrame([(1, False, False, False, 5, [1], [0.5])],
                                    "participant long, queryable boolean, eligible boolean, in_pool boolean, first_block long, "
                                    "n array<int>, acc array<double>")
    dom = spark.createDataFrame([], "participant long, S long, dom long")
    idle = spark.createDataFrame([(8, 50), (9, 40)], "participant long, first_block long")
    best = lambda x: P.report_weights(spark, flagged, dom, 1, x).first().uid
    assert best(None) == 1 and best(idle) == 9


def test_silent_process_raises_an_alarm(spark, tmp_path):
    rows = [(1, 0, 1), (1, 3600, 2), (2, 0, 3), (2, 100, 4), (1, 90000, 5), (3, 90000, 6), (1, 180000, 7), (3, 180000, 8)]
    df = spark.createDataFrame(rows, "user_id long, sec long, event_id long").selectExpr(
        "user_id", "timestamp_seconds(86400000 + sec) AS ts", "event_id", "CAST(sec / 86400 AS INT) AS part")
    out = str(tmp_path / "alarms")
    S.replay(df, "part", lambda st: S.stall_alarms(st, "user_id", 100000.0), S.batch_writer(out), "t-stall", 3)
    got = spark.read.parquet(out).collect()
    assert {(r.key, r.silent_since_us) for r in got if r.silent_since_us is not None} == {(2, 86400100 * 10 ** 6)}
    assert not [r for r in got if r.event_id is not None]


def test_run_state_expires(spark, tmp_path):
    rows = [(1, 0, 1), (2, 0, 2), (2, 86400 * 3, 3), (2, 86400 * 8, 4)]
    df = spark.createDataFrame(rows, "participant long, sec long, seq_id long").selectExpr(
        "participant", "timestamp_seconds(100000000 + sec) AS ts", "seq_id", "'m' AS model", "'r' AS revision", "sec AS block",
        "true AS success", "'e' AS env", "1.0D AS score", "CAST(sec / 86400 AS INT) AS part")
    out = str(tmp_path / "runs")
    S.replay(df, "part", lambda st: S.live_runs(st, ["e"], 86400 * 4, "0 seconds"), S.batch_writer(out), "t-runs", 3, "update")
    got = spark.read.parquet(out)
    assert {r.participant for r in got.where("expired").collect()} >= {1}
    assert {r.participant for r in S.latest_per_key(got, ["participant"]).collect()} == {2}


def test_no_tile_cap(spark):
    n = 700
    pool = spark.range(n).selectExpr("id AS participant", "array(CAST(id % 7 AS DOUBLE) / 7) AS acc", "array(1000) AS n",
                                     "id AS first_block")
    from rankforge.config import ScoringConfig
    cfg = ScoringConfig()
    big = D.dominance_counts(pool, 1, cfg)
    old = D._TILE_ROWS, D._TILE_MOST
    try:
        D._TILE_ROWS, D._TILE_MOST = 10 ** 9, 10 ** 9
        one = D.dominance_counts(pool, 1, cfg)
        assert sorted(map(tuple, big.collect())) == sorted(map(tuple, one.collect()))
    finally:
        D._TILE_ROWS, D._TILE_MOST = old


def test_scans_of_selection_and_grid(spark):
    """X1 plans its sources once, and so do E1 and the grid."""
    import re

    from rankforge.plans import catalog as C
    sf = "/root/testdata/sf0.001"
    count = lambda df: len(re.findall(r"FileScan|Scan parquet|Relation \[", df._jdf.queryExecution().optimizedPlan().toString()))
    assert count(C.participants_world(spark, sf)) == 0                  # all behind the checkpoint
    plan = C.ev_summary(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("event_id") and len(re.findall(r"Relation \[event_id", plan)) == 1
