import json
import os
import tempfile

from pyspark.sql import functions as F

from rankforge.sources import results_log as L


def _result(hk, env, score, uid=1, block=100):
    return {"version": "1", "hotkey": "up", "miner": {"uid": uid, "hotkey": hk, "model": "m/vector-x",
                                                       "revision": "r", "block": block},
            "challenge": {"env": env, "prompt": "p", "challenge_id": "c"},
            "response": {"response": "r", "latency_seconds": 0.1, "success": True},
            "evaluation": {"env": env, "score": score}}


def test_read_reference_shards(spark):
    d = tempfile.mkdtemp(prefix="rf-shards-")
    with open(os.path.join(d, "000000100-upA-5.json"), "w") as f:
        json.dump([_result("h1", "vector:sat", 1.0), {"broken": True}, _result("h2", "nope", 0.0)], f)
    with open(os.path.join(d, "000000120-up-B-7.json"), "w") as f:
        json.dump([_result("h3", " vector:ded ", 0.5)], f)
    with open(os.path.join(d, "index-not-a-shard.json"), "w") as f:
        json.dump([_result("h9", "vector:sat", 1.0)], f)
    good, bad = L.read_shards(spark, d)
    g = sorted((r.miner.hotkey, r.seq.window, r.seq.uploader, r.seq.upload_ns, r.seq.pos) for r in good.collect())
    assert g == [("h1", 100, "upA", 5, 0), ("h3", 120, "up-B", 7, 0)]
    reasons = sorted(r.reason for r in bad.collect())
    assert reasons == ["inactive_env", "missing_miner"]


def test_write_then_tail_prunes(spark):
    d = tempfile.mkdtemp(prefix="rf-log-")
    rows = [(b, True if b % 3 else None, float(b % 2)) for b in range(0, 40000, 37)]
    df = spark.createDataFrame(rows, "block long, success boolean, score double")
    L.write_results(df, d)
    t = L.read_tail(spark, d, cur=39000, tail=5000)
    plan = t._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "epoch" in plan
    lo = (39000 - 5000) - (39000 - 5000) % 20
    want = sum(1 for b, s, _ in rows if s and lo <= b - b % 20 <= 39000 - 39000 % 20)
    assert t.count() == want


def test_changed_and_retention(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "key string, modified long")
    new = spark.createDataFrame([("a", 1), ("b", 5), ("d", 4)], "key string, modified long")
    got = {r.key: r.status for r in L.changed_shards(old, new).collect()}
    assert got == {"a": "unchanged", "b": "changed", "c": "gone", "d": "new"}
    m = spark.createDataFrame([("k1", 100), ("k2", 980)], "key string, window long")
    acts = {r.key: r.action for r in L.retention(m, cur=1000, tail=10).collect()}
    assert acts == {"k1": "drop", "k2": "drop"}
    acts = {r.key: r.action for r in L.retention(m, cur=1000, tail=20).collect()}
    assert acts == {"k1": "drop", "k2": "keep"}


def test_chunk_sample_round_robin(spark):
    rows = [(f"f{i}", j) for i in range(3) for j in range(4 + 3 * i)]
    df = spark.createDataFrame(rows, "file string, r long")
    s = L.chunk_sample(df, "file", "r", lambda fi, cyc, n: F.pmod(fi + cyc, n - 3 + 1), 3, 10)
    got = sorted((r.buffer_pos, r.cycle, r.file, r.r) for r in s.collect())
    # whole chunks of 3 in file order, cycling, until at least 10 rows
    assert [g[0] for g in got] == list(range(12))
    assert [(g[1], g[2]) for g in got[::3]] == [(0, "f0"), (0, "f1"), (0, "f2"), (1, "f0")]


def test_write_report_csv(spark):
    d = tempfile.mkdtemp(prefix="rf-report-")
    rep = spark.createDataFrame([(2, "b", 2), (1, "a", 1)], "uid long, model string, rank int")
    L.write_report(rep, d + "/r")
    back = spark.read.option("header", True).csv(d + "/r").collect()
    assert [r.model for r in back] == ["a", "b"]


def test_micro_batch_replay_is_idempotent(spark):
    from rankforge.streaming.live import batch_writer
    d = tempfile.mkdtemp(prefix="rf-replay-")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    w = batch_writer(d)
    w(df, 7)
    w(df, 7)          # the same micro-batch replayed after a failure
    w(df.limit(1), 8)
    assert spark.read.parquet(d).count() == 3


def test_shards_are_listed_by_few_tasks(spark, tmp_path):
    path = str(tmp_path / "shards")
    spark.range(60).selectExpr("concat(lpad(cast(id AS string), 9, '0'), '-up-0.json') AS shard", "'[]' AS value") \
        .write.partitionBy("shard").text(path)
    before, tracker = spark.conf.get(L.LISTING_TASKS), spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("listing", "")
    try:
        names = L.shard_names(spark, path)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup("listing")]
    assert names.count() == 60 and spark.conf.get(L.LISTING_TASKS) == before
    assert jobs and all(tracker.getStageInfo(s).numTasks <= 2 * spark.sparkContext.defaultParallelism for j in jobs for s in j.stageIds)
