import re
from collections import defaultdict

import pytest

from rankforge.llm.mixing import mix_counts, mix_sources, targets

SCHEMA = "doc_id long, text string, source string, epochs string, cut long"


def water(sizes, weights=(5, 2, 1), cap=3):
    names = sorted([s for s in sizes if s is not None]) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        left = total - sum(cap * sizes[s] for s in capped)
        if not free:
            return {s: float(cap * sizes[s]) for s in names}
        level = left / sum(w[s] for s in free)
        over = [s for s in free if w[s] * level > cap * sizes[s]]
        if not over:
            return {s: float(cap * sizes[s]) if s in capped else w[s] * level for s in names}
        capped |= set(over)


@pytest.mark.parametrize("sizes", [
    {"a": 10, "b": 500, "c": 90, "d": 7, None: 1000}, {"a": 0, "b": 0}, {"a": 5}, {"b": 1, "a": 10 ** 6, "c": 2},
    {None: 4}, {"é": 30, "z": 30, "Z": 30, "a": 900}])
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in targets(df).collect()}
    want = water(sizes)
    assert got.keys() == want.keys() and all(abs(got[s] - want[s]) <= 1e-6 * max(1, want[s]) for s in got)


def docs(spark):
    rows = [(i, " ".join(["w%d" % i] * (1 + i * 7 % 40)) + (" !!" if i % 5 == 0 else ""),
             None if i % 9 == 0 else "s%d" % (i % 3 if i % 2 else 0), "x", i) for i in range(600)]
    rows += [(1000, None, "s0", None, None), (1001, "", "s1", "x", 1), (1002, " \n", "s9", "x", 1),
             (1003, "long " * 20000, "s2", "x", 1), (7, rows[7][1], rows[7][2], "x", 7), (None, "a b", "s1", "x", 1)]
    return rows, spark.createDataFrame(rows, SCHEMA)


def test_counts(spark):
    rows, df = docs(spark)
    got = mix_counts(df).collect()
    assert len(got) == len(rows)
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, mix_counts(df.repartition(7)).collect()), key=str)
    size = {r[0]: len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in rows}
    by, total = defaultdict(int), defaultdict(int)
    source = {r[0]: r[2] for r in rows}
    for r in got:
        assert r.size == size[r.doc_id] and r.taken <= 3 * r.size and r.taken == r.size * r.copies
        by[source[r.doc_id]] += r.taken
        total[source[r.doc_id]] += r.size
    want = water(dict(total))
    for r in got:
        s = source[r.doc_id]
        assert r.source_size == total[s] and abs(r.target - want[s]) < 1e-6 * max(1, want[s])
        assert abs(by[s] - r.target) <= (20000 if s == "s2" else 80)


def test_mix_repeats_rows(spark):
    rows, df = docs(spark)
    n = defaultdict(int)
    for r in mix_sources(df).select("doc_id", "cut").collect():
        n[r.doc_id] += 1
    want = defaultdict(int)
    for r in mix_counts(df).collect():
        want[r.doc_id] += r.copies * (r.size > 0)
    assert n == {k: v for k, v in want.items() if v}
    assert mix_sources(df).columns == df.columns
    empty = spark.createDataFrame([], SCHEMA)
    assert mix_counts(empty).count() == 0 and mix_sources(empty).count() == 0


def test_rows_without_id_and_repeated_ids(spark):
    """Each row decides for itself, so a source of such rows meets its target."""
    rows = [(None, f"w{i} " * 10, "a") for i in range(200)] + [(i, "b " * 10, "b") for i in range(140)] \
        + [(5, "same text " * 5, "c")] * 300 + [(6, f"t{i} " * 10, "d") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mix_counts(df).collect()
    by = defaultdict(lambda: [0, 0.0])
    for r in got:
        by[r.source_size, r.target][0] += r.taken
    assert len(got) == len(rows) and all(abs(taken - target) <= 5 for (_, target), (taken, _) in by.items())
    n = defaultdict(int)
    for r in mix_sources(df).collect():
        n[r.source] += 10
    assert sorted(n.values()) == sorted(taken for taken, _ in by.values())


def test_clashing_columns(spark):
    rows = [(i, f"a b {i}", "s%d" % (i % 2), "r%d" % i, i, "k", "e", "c") for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, __row string, __n long, __key string, __epochs string, __source string")
    out = mix_sources(df)
    assert out.columns == df.columns and {tuple(r) for r in out.collect()} <= set(rows) and out.count() > 0


def test_buckets_of_poor_texts():
    """No key bucket holds much of a source, whatever its weight."""
    import numpy as np
    u = (np.arange(100000) + 0.5) / 100000
    for w in (0.1, 0.2, 0.35, 0.6, 1.0):
        key = -np.log(u) / w
        spread = sum(1 - np.exp(-key * x) for x in (0.1, 0.25, 0.5, 1.0)) / 4
        assert np.bincount(np.minimum((spread * 128).astype(int), 127)).max() < 6 * 100000 / 128
