import random
import re

import numpy as np
import pytest

from rankforge.llm.jaccard_join import drop_near_copies, jaccard_classes, min_matches

SCHEMA = "doc_id long, text string, grp string, size long"


def brute(rows, t=0.8, n=5):
    def sh(text):
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        return {tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()
    s = [sh(r[1]) for r in rows]
    big = lambda i: float("inf") if rows[i][0] is None else rows[i][0]
    link = [[j for j in range(len(rows)) if j != i and s[i] and s[j] and len(s[i] & s[j]) >= t * len(s[i] | s[j]) - 1e-9]
            for i in range(len(rows))]
    out = []
    for i in range(len(rows)):
        seen, todo = {i}, [i]
        while todo:
            for j in link[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        same = [j for j in range(len(rows)) if s[j] == s[i] and s[i]] or [i]
        comp, cls = min(seen, key=big), min(same, key=big)
        out.append((rows[i][0], len(link[i]), rows[comp][0], rows[cls][0], len(same), rows[comp][0] == rows[i][0]))
    return sorted(out, key=str)


def make(seed):
    rng = random.Random(seed)
    word = lambda: "w%d" % rng.randrange(3000)
    rows, i = [], 0
    for _ in range(14):
        base = [word() for _ in range(rng.randrange(5, 300))]
        for _ in range(rng.randrange(1, 18)):
            w = list(base)
            for _ in range(rng.randrange(0, max(1, len(w) // 40) + 2)):
                w[rng.randrange(len(w))] = word()
            rows.append((i * 17 % 1009, rng.choice([" ", "\n"]).join(w), "x", 1))
            i += 1
    rows += [(2000 + k, rows[5][1], None, 1) for k in range(30)]
    rows += [(3000, None, "x", 1), (3001, "", "x", 1), (3002, " ", "x", 1), (3003, "one two", "x", 1), (3004, "one  two", "x", 1),
             (3005, "a " * 30000, "x", 1), (3006, "a a a a a", "x", 1), (None, rows[5][1], "x", 1), (2000, rows[5][1], "x", 1)]
    return rows


@pytest.mark.parametrize("seed,block", [(1, 1024), (2, 5), (3, 3)])
def test_against_brute_force(spark, seed, block):
    rows = make(seed)
    got = jaccard_classes(spark.createDataFrame(rows, SCHEMA).repartition(3), block=block)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def test_drop_and_empty(spark):
    rows = [r for r in make(4) if r[0] != 2000]
    df = spark.createDataFrame(rows, SCHEMA)
    got = drop_near_copies(df)
    assert got.columns == df.columns
    want = {r[0] for r in brute(rows) if r[5]} | {None}
    assert {r.doc_id for r in got.collect()} == want
    assert jaccard_classes(spark.createDataFrame([], SCHEMA)).count() == 0


def test_posterior_bound():
    """Against the beta integral by quadrature."""
    x = (np.arange(400_000) + 0.5) / 400_000
    for k, m in enumerate(min_matches(4, 16, 0.8, 1e-4), 1):
        n = 16 * k

        def post(m):
            f = x ** m * (1 - x) ** (n - m)
            return f[x >= 0.8].sum() / f.sum()

        assert post(m) >= 1e-4 * 0.99 and post(m - 1) < 1e-4 * 1.01


def test_drop_goes_by_row(spark, tmp_path):
    text = lambda c, w="": " ".join(f"{c}{i}" for i in range(60)) + w
    rows = [(5, text("a")), (5, text("b")), (3, text("b")), (11, text("c")), (11, text("c")), (12, text("c", " x")),
            (None, text("d")), (None, text("d")), (None, text("e")), (13, text("f")), (13, text("f", " y")), (1, ""), (1, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted(map(tuple, jaccard_classes(df).collect()), key=str) == brute(rows)
    df.write.parquet(str(tmp_path / "docs"))
    for docs in (df, spark.read.parquet(str(tmp_path / "docs"))):
        got = [(r.doc_id, r.text[:2]) for r in drop_near_copies(docs, keep_no_id=False).collect()]
        assert sorted(got, key=str) == sorted([(5, "a0"), (3, "b0"), (11, "c0"), (None, "d0"), (None, "e0"), (13, "f0"),
                                               (1, ""), (1, "")], key=str)
