"""One-pass run summaries, sliding panes, the monotone gate and the draw."""

import hashlib
import random
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from rankforge.config import ScoringConfig
from rankforge.operators import dominance as D
from rankforge.operators import ops as O
from rankforge.operators import results as R
from rankforge.operators import rollup as RU
from rankforge.sources.results_log import scratch_path
from rankforge.streaming import live as S

ENVS = ("a", "b", "c")
LOG = "participant long, seq_id long, model string, revision string, env string, success boolean, score double, block long"


def log_rows(seed, n=900):
    rng = random.Random(seed)
    version = {p: ("m0", "r0") for p in range(6)}
    rows = []
    for i in range(n):
        p = 0 if rng.random() < 0.5 else rng.randrange(6)            # one participant has half of all rows
        if rng.random() < (0.3 if p == 1 else 0.03):                 # participant 1 goes back and forth inside chunks
            version[p] = (rng.choice(["m0", "m1", None]), rng.choice(["r0", "r1"]))
        rows.append((p, i, *version[p], rng.choice(["a", "b", "c", "x"]), rng.random() < 0.8, rng.randrange(5) / 4,
                     rng.choice([None, i // 12])))
    return rows


def by_islands(df):
    run = R.current_run_islands(df, seq=("seq_id",))
    got = R.participant_summary(run, ENVS, latest=()).collect()
    last = {}
    for r in df.orderBy("seq_id").collect():
        last[r.participant] = (r.model, r.revision)
    return {r.participant: (r.n, r.succ, r.first_block, last[r.participant]) for r in got}


def as_dict(df):
    return {r.participant: (r.n, r.succ, r.first_block, tuple(r.latest)) for r in df.collect()}


@pytest.mark.parametrize("seed,width", [(1, 40), (2, 7), (3, 1), (4, 10_000)])
def test_merged_summaries_equal_the_walk_over_all_rows(spark, seed, width):
    df = spark.createDataFrame(log_rows(seed), LOG).repartition(5)
    chunk = F.floor(F.col("seq_id") / width).cast("bigint")
    got = RU.merge_runs(RU.chunk_runs(df, ENVS, chunk, seq=("seq_id",)), len(ENVS))
    assert as_dict(got) == by_islands(df)


def test_refresh_reads_only_new_chunks(spark):
    rows = log_rows(9)
    chunk = F.floor(F.col("seq_id") / 100).cast("bigint")
    path, log = scratch_path(spark, "rollup-test"), scratch_path(spark, "rollup-log")
    for lo, hi in ((0, 250), (250, 430), (430, 430), (430, 900)):
        part = spark.createDataFrame([r for r in rows if lo <= r[1] < hi], LOG)
        part.withColumn("chunk", chunk).write.mode("append").partitionBy("chunk").parquet(log)
        stored = RU.refresh(spark.read.parquet(log), path, ENVS, F.col("chunk").cast("bigint"), seq=("seq_id",))
        there = spark.createDataFrame([r for r in rows if r[1] < hi], LOG)
        assert as_dict(RU.merge_runs(stored, len(ENVS))) == by_islands(there)
    assert stored.groupBy("participant", "chunk").count().where("count > 1").count() == 0
    # what a refresh plans to read is the newest stored chunk and later ones
    fresh = spark.read.parquet(log).filter(F.col("chunk").cast("bigint") >= 8)
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(chunk" in plan


def test_grid_scans_the_log_once(spark):
    import re

    from rankforge.plans import catalog as C
    plan = C.ev_summary(spark, "/root/testdata/sf0.001")._jdf.queryExecution()
    assert len(re.findall(r"FileScan parquet \[event_id", plan.executedPlan().toString())) == 1


# ---- C4 / D6 ------------------------------------------------------------------------------
def test_superset_sums():
    h = np.random.default_rng(1).integers(-5, 9, size=(4, 32))
    want = np.array([[sum(row[m] for m in range(32) if m & s == s) for s in range(32)] for row in h])
    assert (D.superset_sums(h) == want).all()


def dominated(a, pool, s, masks):
    nw, bet, tie = masks
    plain = ((nw & s) == s) & ((bet & s) != 0)
    first = ((tie & s) == s) & (pool["fb"][a] < pool["fb"])
    hit = plain | first
    hit[a] = False
    return int(hit.sum())


def random_pool(n, e, seed):
    rng = np.random.default_rng(seed)
    cnt = rng.choice([0, 5, 50, 200, 1500], size=(n, e))
    return {"acc": np.where(cnt > 0, rng.integers(0, 9, size=(n, e)) / 8, 0.0), "n": cnt, "fb": rng.integers(0, 50, size=n),
            "id": np.arange(n)}


@pytest.mark.parametrize("n,e", [(60, 5), (40, 9), (1, 3)])
def test_subset_counts_against_every_subset(n, e):
    from rankforge.functions.scoring import np_masks
    p, cfg = random_pool(n, e, n), ScoringConfig()
    got = D.subset_counts(p["acc"], p["n"], p["fb"], p["id"], p["acc"], p["n"], p["fb"], p["id"], cfg)
    for a in range(n):
        masks = [m[0] for m in np_masks(p["acc"][a:a + 1], p["n"][a:a + 1], p["acc"], p["n"], cfg)]
        assert got[a][1:].tolist() == [dominated(a, p, s, masks) for s in range(1, 1 << e)]


def test_a_pool_of_fifty_thousand(spark):
    """2.5 billion ordered pairs; some participants are held against all others."""
    from rankforge.functions.scoring import np_masks
    n, e, cfg = 50_000, 1, ScoringConfig()
    p = random_pool(n, e, 5)
    import pandas as pd
    pool = spark.createDataFrame(pd.DataFrame({"participant": p["id"], "acc": p["acc"].tolist(), "n": p["n"].tolist(),
                                               "first_block": p["fb"]}))
    dom = {(r.participant, r.S): r.dom for r in D.dominance_counts(pool, e, cfg).where("participant % 4099 = 1").collect()}
    for a in range(1, n, 4099):
        masks = [m[0] for m in np_masks(p["acc"][a:a + 1], p["n"][a:a + 1], p["acc"], p["n"], cfg)]
        for s in range(1, 1 << e):
            assert dom.get((a, s), 0) == dominated(a, p, s, masks)


def test_kernel_memory_does_not_follow_the_subsets():
    import tracemalloc
    peak = {}
    for e in (4, 10):
        p = random_pool(600, e, e)
        tracemalloc.start()
        D.subset_counts(p["acc"][:64], p["n"][:64], p["fb"][:64], p["id"][:64], p["acc"], p["n"], p["fb"], p["id"], ScoringConfig())
        peak[e] = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
    assert peak[10] < peak[4] + 8 * 64 * (1 << 10) * 6           # besides the histogram itself: no pairs x subsets


# ---- I3 -----------------------------------------------------------------------------------
def test_sliding_tail_equals_a_range_window(spark):
    """Tail 20,000 blocks, a recompute every 100."""
    rng = random.Random(4)
    rows = [(rng.randrange(3), rng.randrange(0, 90_000), rng.random()) for _ in range(4000)] + [(7, 50, 1.0)]
    df = spark.createDataFrame(rows, "key long, block long, score double")
    panes = df.groupBy("key", F.floor(F.col("block") / 100).cast("bigint").alias("pane")).agg(
        F.count("*").alias("n"), F.sum("score").alias("succ"))
    got = {(r.key, r.pane + 199): (r.n, r.succ) for r in S.sliding_sums(panes, ["key"], "pane", 200, ["n", "succ"]).collect()}
    import pandas as pd
    t = pd.DataFrame(rows, columns=["key", "block", "score"])  # noqa: F841
    want = duckdb.sql("""
        WITH p AS (SELECT key, block // 100 AS pane, count(*) AS n, sum(score) AS succ FROM t GROUP BY ALL)
        SELECT key, pane, sum(n) OVER w AS n, sum(succ) OVER w AS succ FROM p
        WINDOW w AS (PARTITION BY key ORDER BY pane RANGE BETWEEN 199 PRECEDING AND CURRENT ROW)""").fetchall()
    assert len(want) > 1000
    for key, pane, n, succ in want:
        assert got[(key, pane)][0] == n and abs(got[(key, pane)][1] - succ) < 1e-9
    assert sum(v[0] for v in got.values()) == 200 * len(rows)         # every row is in 200 windows


def test_negative_panes_and_no_rows(spark):
    p = spark.createDataFrame([("a", -5, 1), ("a", -1, 2), ("a", 3, 4)], "k string, pane long, n long")
    got = {r.pane: r.n for r in S.sliding_sums(p, ["k"], "pane", 3, ["n"]).collect()}
    assert got == {-7: 1, -6: 1, -5: 1, -3: 2, -2: 2, -1: 2, 1: 4, 2: 4, 3: 4}
    assert S.sliding_sums(p.limit(0), ["k"], "pane", 3, ["n"]).count() == 0


# ---- I6 -----------------------------------------------------------------------------------
def test_gate_is_monotone_and_replays_replace(spark):
    path = scratch_path(spark, "gate-test")
    act = S.gate_writer(path)
    batch = lambda *b: spark.createDataFrame([(x,) for x in b], "block long")
    act(batch(100, 101, 300, 100), 0)
    act(batch(200, 300, 500, 450), 1)
    act(batch(), 2)
    act(batch(500, 400, 600), 3)
    act(batch(500, 400, 600), 3)                                     # the same micro-batch again
    act(batch(600, 100), 4)
    got = {r.microbatch: sorted(b.block for b in spark.read.parquet(f"{path}/fired/microbatch={r.microbatch}").collect())
           for r in spark.range(5).withColumnRenamed("id", "microbatch").collect()}
    assert got == {0: [100, 300], 1: [500], 2: [], 3: [600], 4: []}
    assert S.last_acted(spark, path, 5) == 600 and S.last_acted(spark, path, 0) is None


# ---- M7 -----------------------------------------------------------------------------------
def test_draws_are_even_and_rejected_where_needed(spark):
    got = spark.range(40_000).select(O.task_id(3, F.col("id"), data_len=F.lit(20)).alias("x")).collect()
    count = Counter(r.x for r in got)
    assert sorted(count) == list(range(20)) and max(abs(c - 2000) for c in count.values()) < 250
    n = (1 << 59) + 1                                                 # nearly every second number is rejected
    rows = spark.range(200).select("id", O.task_id(3, F.col("id"), data_len=F.lit(n)).alias("x")).collect()
    for r in rows:
        k = 0
        while (x := int(hashlib.sha256(f"3:{r.id}:{k}".encode()).hexdigest()[:15], 16)) >= (1 << 60) - (1 << 60) % n:
            k += 1
        assert r.x == x % n
    assert spark.range(1).select(O.task_id(1, F.lit(None), data_len=F.lit(0)).alias("x")).first().x < 200
