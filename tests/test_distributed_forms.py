"""The skew-safe re-formulations equal their plain (single-window) forms."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from rankforge.operators import ops as O
from rankforge.operators import participants as PT
from rankforge.operators.results import last_rows, pack_pair, unpack_lo


def test_ordinal_within_equals_row_number(spark):
    rng = random.Random(1)
    rows = [(rng.choice("ab"), rng.randint(0, 10_000), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, t long, id long")
    o = O.ordinal_within(df, "k", ["t", "id"], F.floor(F.col("t") / 700))
    w = df.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy("t", "id")))
    got = {(r.id, r.ordinal) for r in o.collect()}
    want = {(r.id, r.rn) for r in w.collect()}
    assert got == want


def test_chunked_stalls_equal_plain_lag(spark):
    rng = random.Random(2)
    rows, t = [], 1_700_000_000
    for i in range(2000):
        t += rng.choice([10, 60, 5000, 20000, 90000])
        rows.append((rng.choice([1, 2, 3]), i, t))
    df = spark.createDataFrame(rows, "k long, event_id long, s long").withColumn("ts", F.timestamp_seconds("s"))
    got = {(r.event_id, r.stalled, r.session) for r in O.stalls(df, "k", "ts", 14400.0).collect()}
    w = Window.partitionBy("k").orderBy("s")
    p = (df.withColumn("gap", F.col("s") - F.lag("s").over(w))
         .withColumn("stalled", F.coalesce(F.col("gap") > 14400, F.lit(False)))
         .withColumn("session", F.sum(F.col("stalled").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0))))
    want = {(r.event_id, r.stalled, r.session) for r in p.collect()}
    assert got == want


def test_ttl_lookup_matches_double(spark):
    rng = random.Random(3)
    fetches = [(rng.choice("xy"), float(rng.randint(0, 400_000)), rng.choice(["a", "b", None])) for _ in range(300)]
    reqs = [(rng.choice("xyz"), float(rng.randint(0, 400_000))) for _ in range(300)]
    f = spark.createDataFrame(fetches, "model string, ts double, value string")
    r = spark.createDataFrame(reqs, "model string, now double").distinct()
    got = {(x.model, x.now): (x.value, x.age, x.is_stale) for x in PT.ttl_lookup(r, f, 3600.0, 86400.0).collect()}
    ok = {}
    for m, t, v in fetches:
        if v is not None:
            ok[(m, t)] = max(ok.get((m, t), v), v)
    for m, now in set(reqs):
        cands = [(t, v) for (mm, t), v in ok.items() if mm == m and t <= now]
        if not cands:
            assert got[(m, now)] == (None, None, None)
        else:
            t, v = max(cands)
            assert got[(m, now)] == (v, now - t, now - t >= 3600.0)


def test_pack_pair_orders_like_tuples(spark):
    pairs = [(5, -3), (5, 2), (-1, 9), (0, 0), (10 ** 16, -(2 ** 62)), (7, 2 ** 62)]
    df = spark.createDataFrame(pairs, "a long, b long")
    rows = df.select("a", "b", pack_pair(F.col("a"), F.col("b")).alias("p"),
                     unpack_lo(pack_pair(F.col("a"), F.col("b"))).alias("lo")).collect()
    assert [(r.a, r.b) for r in sorted(rows, key=lambda r: r.p)] == sorted(pairs)
    assert all(r.lo == r.b for r in rows)


def test_last_rows(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("b", 2, "z")], "k string, pos long, v string")
    assert {(r.k, r.v) for r in last_rows(df, ["k"], "pos").collect()} == {("a", "y"), ("b", "z")}
    assert {(r.k, r.v) for r in last_rows(df, ["k"], "pos", first=True).collect()} == {("a", "x"), ("b", "z")}


def test_restamped_lookup_matches_the_walk(spark):
    rng = random.Random(4)
    fetches = [(rng.choice("xy"), float(rng.randint(0, 900) * 400), rng.choice(["a", "b", None, None])) for _ in range(400)]
    reqs = {(rng.choice("xyz"), float(rng.randint(0, 400_000))) for _ in range(300)}
    f = spark.createDataFrame(fetches, "model string, ts double, value string")
    r = spark.createDataFrame(sorted(reqs), "model string, now double")
    res = PT.ttl_lookup(r, f, 3600.0, 86400.0, on_failure="restamp")
    assert res._jdf.queryExecution().executedPlan().toString().count("Scan ExistingRDD") <= 4     # each table twice
    got = {(x.model, x.now): (x.value, x.age, x.is_stale) for x in res.collect()}
    for m, now in reqs:
        upto = [(t, v) for mm, t, v in fetches if mm == m and t <= now]
        good = [(t, v) for t, v in upto if v is not None]
        age = now - max(t for t, _ in upto) if good else None
        assert got[(m, now)] == ((max(good)[1], age, age >= 3600.0) if good else (None, None, None))


def test_restamped_lookup_carries_no_fetch_without_a_time(spark):
    f = spark.createDataFrame([("x", None, "a"), ("x", 5.0, None)], "model string, ts double, value string")
    r = spark.createDataFrame([("x", 9.0), ("x", 200_000.0)], "model string, now double")
    res = PT.ttl_lookup(r, f, 3600.0, 86400.0, on_failure="restamp")
    assert {(x.now, x.value, x.age, x.is_stale) for x in res.collect()} == {(9.0, None, None, None), (200_000.0, None, None, None)}
