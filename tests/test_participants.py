"""Duplicate-claim removal and per-model selection against Python statements
of the rules."""

import random

from rankforge.operators import participants as PT

INF = 2 ** 63 - 1


def _norm(b):
    return INF if b is None else b


def _earliest_sha_py(rows):
    first = {}
    for uid, block, _, shas in sorted(rows):
        if not shas:
            continue
        for h in shas:
            prev = first.get(h)
            if prev is None or _norm(block) < prev[0]:
                first[h] = (_norm(block), uid)
    if not first:
        return {r[0] for r in rows}
    keep = set()
    for uid, _, _, shas in rows:
        if not shas or all(first[h][1] == uid for h in shas):
            keep.add(uid)
    return keep


def _best_model_py(rows):
    best = {}
    for uid, block, model, _ in sorted(rows):
        if not model:
            continue
        prev = best.get(model)
        if prev is None or _norm(block) < prev[0]:
            best[model] = (_norm(block), uid)
    return {u for _, u in best.values()}


def _rows(seed):
    rng = random.Random(seed)
    rows = []
    for uid in range(40):
        block = rng.choice([None, 5, 10, 10, 20, rng.randint(0, 50)])
        model = rng.choice([None, "", "m1", "m2", "m3"])
        shas = rng.choice([None, [], [rng.choice("abcdef")], [rng.choice("abcdef"), rng.choice("ghij")]])
        rows.append((uid, block, model, sorted(set(shas)) if shas else shas))
    return rows


def test_earliest_claims_and_best_model(spark):
    for seed in range(4):
        rows = _rows(seed)
        df = spark.createDataFrame(rows, "uid long, block long, model string, weights_shas array<string>")
        got = {r.uid for r in PT.earliest_claims(df).collect()}
        assert got == _earliest_sha_py(rows), seed
        got = {r.uid for r in PT.best_per_model(df).collect()}
        assert got == _best_model_py(rows), seed


def test_latest_commitment_and_gate(spark):
    reg = spark.createDataFrame([(0, "h0"), (1, "h1"), (2, "h2")], "uid long, hotkey string")
    commits = spark.createDataFrame([
        ("h0", 1, 100, '{"model": "a/vector-x", "revision": "r1", "chute_id": "c0"}'),
        ("h1", 1, 100, '{"model": "a/vector-y", "revision": "r1", "chute_id": "c1"}'),
        ("h1", 2, 200, '{"model": "a/vector-z", "revision": "r2", "chute_id": "c2"}')],
        "hotkey string, pos long, block long, data string")
    lat = {r.uid: (r.block, r.model, r.chute_id) for r in PT.latest_commitment(reg, commits).collect()}
    assert lat == {0: (0, "a/vector-x", "c0"), 1: (200, "a/vector-z", "c2")}   # uid 0 -> block 0, last wins
    gating = spark.createDataFrame([("a/vector-x", False), ("a/vector-z", None)], "model string, gated boolean")
    kept = {r.uid for r in PT.gate_filter(PT.latest_commitment(reg, commits), gating).collect()}
    assert kept == {0}                                                           # null gate = unknown = out
