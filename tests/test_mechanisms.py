"""Snapshot index, hash tree, ordered numbering, faulty shards, two-buffer
sink, live tail with late rows, long lines."""

import random

import pytest
from pyspark.sql import functions as F

from rankforge.operators import merkle as MK
from rankforge.operators import rollup as RU
from rankforge.operators.ordered import numbered, summed_before
from rankforge.operators.trajectories import reassemble_lines
from rankforge.sources import index_log as I
from rankforge.sources import results_log as L
from rankforge.streaming import tail as T
from rankforge.streaming import upload as U
from test_rollup import ENVS, LOG, as_dict, log_rows


# ---- ordered ---------------------------------------------------------------------------------
def test_places_and_sums(spark):
    rng = random.Random(2)
    rows = [(rng.randrange(40), i, rng.randrange(9)) for i in range(700)]
    df = spark.createDataFrame(rows, "a int, b int, v long").repartition(7)
    want = {r: i for i, r in enumerate(sorted(rows))}
    assert {(r.a, r.b, r.v): r.place for r in numbered(df, "a", "b").collect()} == want
    before, total = {}, 0
    for r in sorted(rows):
        before[r], total = total, total + r[2]
    assert {(r.a, r.b, r.v): r.before for r in summed_before(df, "v", "a", "b").collect()} == before
    assert numbered(df.limit(0), "a").count() == 0 and summed_before(df.limit(0), "v", "a").count() == 0


# ---- A9 / S2 ---------------------------------------------------------------------------------
def keys(spark, *k):
    return spark.createDataFrame([(f"{w:09d}-u-{n}.json",) for w, n in k] + [("no-window.json",)], "key string")


def test_index_adds_write_deltas_only(spark):
    path = L.scratch_path(spark, "index-test")
    assert I.read_index(spark, path).count() == 0
    assert I.add_keys(spark, path, keys(spark, (20, 1), (40, 2), (40, 2))) == 2
    first = I.snapshot(spark, path)[1]["deltas"]
    assert I.add_keys(spark, path, keys(spark, (40, 2), (60, 3))) == 1
    assert I.add_keys(spark, path, keys(spark, (40, 2), (60, 3))) == 0            # nothing new: no version
    version, manifest = I.snapshot(spark, path)
    assert version == 2 and manifest["deltas"][:1] == first and [d["rows"] for d in manifest["deltas"]] == [2, 1]
    assert sorted(r.window for r in I.read_index(spark, path).collect()) == [20, 40, 60]
    assert [r.window for r in I.read_index(spark, path, lo=50).collect()] == [60]
    I.compact(spark, path)
    assert [d["rows"] for d in I.snapshot(spark, path)[1]["deltas"]] == [3]
    I.prune(spark, path, cur=100, tail=60)
    assert sorted(r.window for r in I.read_index(spark, path).collect()) == [40, 60]
    assert I.add_keys(spark, path, keys(spark, (60, 3), (80, 4))) == 1


def test_two_writers_of_one_version(spark):
    path = L.scratch_path(spark, "index-race")
    I.add_keys(spark, path, keys(spark, (20, 1)))
    assert not I.publish(spark, path, 1, {"floor": None, "deltas": []})           # the number is taken
    assert I.read_index(spark, path).count() == 1
    real, lost = I.publish, []

    def late(spark_, path_, version, manifest):
        if not lost:                                                              # another writer comes first
            lost.append(version)
            name = "other"
            keys(spark, (40, 2)).limit(1).selectExpr("key", "40L AS window").write.parquet(f"{path}/deltas/{name}")
            old = I.snapshot(spark, path)[1]
            real(spark, path, version, old | {"deltas": [*old["deltas"], {"name": name, "rows": 1, "lo": 40, "hi": 40}]})
        return real(spark_, path_, version, manifest)

    I.publish = late
    try:
        assert I.add_keys(spark, path, keys(spark, (40, 2), (60, 3))) == 1        # 40 is there by now
    finally:
        I.publish = real
    assert sorted(r.window for r in I.read_index(spark, path).collect()) == [20, 40, 60]


# ---- D22 -------------------------------------------------------------------------------------
def test_a_changed_file_hashes_one_path_again(spark):
    files = spark.range(5000).selectExpr("if(id < 4800, 'a', 'b') AS s", "concat('p/', id) AS path", "concat('text ', id) AS content")
    leaf = MK.leaves(files, "s")
    nodes = MK.tree(leaf, "s")
    sizes = nodes.groupBy("s", "level", F.floor(F.col("idx") / MK.FAN_IN).alias("up")).count().agg(F.max("count")).first()[0]
    assert sizes == MK.FAN_IN
    change = F.when(F.col("path") == "p/777", F.lit("other")).otherwise(F.col("content"))
    whole = MK.roots(MK.tree(MK.leaves(files.withColumn("content", change), "s"), "s"), "s")
    changed = leaf.filter("path = 'p/777'").select("s", "idx", MK.leaf_hash(F.col("path"), F.lit("other")).alias("hash"))
    fresh = MK.update(nodes, changed, "s")
    assert fresh.groupBy("level").count().filter("count <> 1").count() == 0       # one node by level
    kept = nodes.join(fresh.select("s", "level", "idx"), ["s", "level", "idx"], "left_anti")
    got = MK.roots(kept.unionByName(fresh.select(*kept.columns)), "s")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, whole.collect()))
    old = {r.s: r.fingerprint for r in MK.roots(nodes, "s").collect()}
    new = {r.s: r.fingerprint for r in got.collect()}
    assert old["a"] != new["a"] and old["b"] == new["b"]


def test_a_set_alone_has_the_same_root(spark):
    files = spark.range(400).selectExpr("if(id < 17, 'a', 'b') AS s", "id AS path", "cast(null as string) AS content")
    both = {r.s: r.fingerprint for r in MK.roots(MK.tree(MK.leaves(files, "s"), "s"), "s").collect()}
    alone = MK.roots(MK.tree(MK.leaves(files.filter("s = 'a'"), "s"), "s"), "s").collect()
    assert [(r.s, r.fingerprint, r.files) for r in alone] == [("a", both["a"], 17)]


# ---- A3 / A6 ---------------------------------------------------------------------------------
def test_tail_read_opens_only_its_shards(spark):
    path = L.scratch_path(spark, "shards-test")
    item = '{"miner": {"hotkey": "h"}, "challenge": {"env": "a"}, "evaluation": {"score": 1.0}, "response": {"success": true}}'
    rows = [(f"{w:09d}-u-{w}.json", f"[{item}]" if w != 160 else f"[{item}, {{") for w in range(0, 400, 20)]
    spark.createDataFrame(rows, "shard string, value string").write.partitionBy("shard").text(path)
    index = spark.createDataFrame([(r[0],) for r in rows] + [("000000180-x-7.json",), ("000000020-x-7.json",)], "key string")
    good, bad, faults = L.read_tail_shards(spark, path, index, cur=200, tail=100, envs=("a",))
    assert sorted(r.seq.window for r in good.collect()) == [100, 120, 140, 180, 200]
    assert sorted(map(tuple, faults.collect())) == [("000000160-u-160.json", "corrupt"), ("000000180-x-7.json", "missing")]
    assert bad.count() == 1
    once = good.select("seq")
    once.collect()
    leaf = once._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert leaf.metrics().get("numFiles").get().value() == 6                       # of twenty


# ---- I1 --------------------------------------------------------------------------------------
def upload_rule(times, size, age, least):
    """The rule one item at a time: [(batch, upload)], complete uploads."""
    batch = upload = count = buffered = 0
    start, out, done = 0, [], set()

    def flush():
        nonlocal batch, upload, count, buffered
        buffered, batch, count = buffered + count, batch + 1, 0
        if buffered >= least:
            done.add(upload)
            upload, buffered = upload + 1, 0
    for t in times:
        if count and t >= start + age:
            flush()
        if not count:
            start = t
        out.append((batch, upload))
        count += 1
        if count >= size:
            flush()
    return out, done, (start, count), flush


class State:
    def __init__(self):
        self.value, self.hasTimedOut, self.timeout = None, False, None
    exists = property(lambda self: self.value is not None)
    get = property(lambda self: self.value)

    def update(self, v):
        self.value = v

    def setTimeoutTimestamp(self, t):
        self.timeout = t

    def getCurrentWatermarkMs(self):
        return 0


@pytest.mark.parametrize("seed,size,age,least", [(1, 5, 50, 12), (2, 3, 7, 100), (3, 300, 20, 1), (4, 1, 1, 1), (5, 4, 1000, 6)])
def test_two_buffers_follow_the_rule(seed, size, age, least):
    import pandas as pd
    rng = random.Random(seed)
    times, t = [], 0
    for _ in range(400):
        t += rng.choice([0, 1, 2, 3, 30])
        times.append(t)
    want, done, (start, count), flush = upload_rule(times, size, age, least)
    fn, state, got, marks = U.upload_fn(size, age, least), State(), [], set()
    at = 0
    while at < len(times):                                                        # micro-batches of any size
        end = at + rng.randrange(1, 60)
        pdf = pd.DataFrame({"ts": pd.to_datetime(times[at:end], unit="s"), "event_id": range(at, min(end, len(times)))})
        for f in fn((7,), iter([pdf]), state):
            got += list(zip(f[~f.done].batch, f[~f.done].upload))
            marks |= set(f[f.done].upload)
        at = end
    assert got == want and marks == done
    if count:
        assert state.timeout == (start + age) * 1000
        state.hasTimedOut = True                                                  # nothing comes any more
        for f in fn((7,), iter([]), state):
            marks |= set(f.upload)
        flush()
        assert marks == done and state.value[2] == 0


# ---- I4 / I7 ---------------------------------------------------------------------------------
def test_any_order_of_arrival_gives_the_batch_result(spark):
    rows = log_rows(21)
    chunk = F.floor(F.col("seq_id") / 60).cast("bigint")
    path = L.scratch_path(spark, "tail-test")
    write = T.tail_writer(path, ENVS, chunk, 2, seq=("seq_id",))
    shuffled = rows[:]
    random.Random(5).shuffle(shuffled)
    some = [r for r in shuffled if r[1] < 600 and r[1] % 3]
    parts = [[], some, [r for r in rows if r[1] >= 600 and r[0] != 4], [r for r in shuffled if r[1] < 600 and r[1] % 3 == 0]]
    for i, part in enumerate(parts):
        for _ in range(2 if i == 2 else 1):                                       # one micro-batch comes again
            write(spark.createDataFrame(part, LOG), i)
    there = spark.createDataFrame([r for p in parts for r in p], LOG)
    want = RU.merge_runs(RU.chunk_runs(there, ENVS, chunk, seq=("seq_id",)), len(ENVS))
    assert as_dict(T.tail_summary(spark, path, ENVS, seq=("seq_id",))) == as_dict(want)
    late = {r.participant: r.rows for r in T.late_rows(spark, path).collect()}
    assert sum(late.values()) == len(parts[3])                                    # chunks below 12 were closed
    live = as_dict(T.tail_summary(spark, path, ENVS, tail=5, seq=("seq_id",)))
    assert 4 not in live and {r.participant for r in T.expired(spark, path, 5).collect()} == {4}


# ---- T26 -------------------------------------------------------------------------------------
def test_a_line_without_an_end_comes_in_parts(spark):
    rows = [("s", i, "x" * 1000) for i in range(5000)] + [("s", 5000, "end\nnext"), ("s", 5001, " one\n"), ("t", 1, "a\nb")]
    df = spark.createDataFrame(rows, "stream string, pos long, chunk string")
    got = {(r.stream, r.line_no, r.part): r.n for r in
           reassemble_lines(df, span=700).select("stream", "line_no", "part", F.length("line").alias("n")).collect()}
    assert got[("s", 2, 0)] == 9 and got[("t", 1, 0)] == 2 and got[("t", 2, 0)] == 1
    parts = [got[("s", 1, p)] for p in range(8)]
    assert parts[:7] == [700_000] * 7 and sum(parts) == 5_000_004 and len(got) == 11
