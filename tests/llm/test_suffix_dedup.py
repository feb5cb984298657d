import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rankforge.llm import repeats
from rankforge.llm.suffix_dedup import longest_previous_factor, nearest_smaller, remove_substrings

SCHEMA = "doc_id long, text string, part string, h long"


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 3), max_size=60), st.integers(1, 20))
def test_lpf(values, depth):
    got = longest_previous_factor(np.array(values, dtype=np.uint64), depth)
    want = []
    for i in range(len(values)):
        best = 0
        for j in range(i):
            n = 0
            while n < depth and i + n < len(values) and values[j + n] == values[i + n]:
                n += 1
            best = max(best, n)
        want.append(best)
    assert got.tolist() == want


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 50), max_size=60, unique=True))
def test_nearest_smaller(values):
    want = [max([j for j in range(i) if values[j] < values[i]], default=-1) for i in range(len(values))]
    assert nearest_smaller(np.array(values, dtype=np.int64)).tolist() == want


def brute(rows, k):
    docs = sorted(((r[0] is None, r[0], r[1]) for r in rows), key=lambda r: (r[0], r[1] or 0))
    seen, out = set(), []
    for _, i, text in docs:
        b = (text or "").encode()
        gone = np.zeros(len(b), dtype=bool)
        for p in range(len(b) - k + 1):
            if b[p:p + k] in seen:
                gone[p:p + k] = True
            seen.add(b[p:p + k])
        left = bytes(np.frombuffer(b, dtype=np.uint8)[~gone])
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(left).hexdigest()))
    return sorted(out, key=str)


def make(seed):
    rng = random.Random(seed)
    noise = lambda n: "".join(rng.choice("abcdé \n") for _ in range(n))
    passages = [noise(rng.randrange(70, 400)) for _ in range(8)]
    rows = []
    for i in range(100):
        t = ""
        for _ in range(rng.randrange(6)):
            p = rng.choice(passages)
            cut = rng.randrange(len(p))
            t += noise(rng.randrange(60)) + (p if rng.random() < 0.4 else p[cut:] if rng.random() < 0.5 else p[:cut])
            if rng.random() < 0.3 and t:
                c = rng.randrange(len(t))
                t = t[:c] + "#" + t[c + 1:]
        rows.append((i * 7 % 1000, t, "x", 1))
    rows += [(2000 + i, rows[3][1], None, 1) for i in range(20)]
    rows += [(3000, None, "x", None), (3001, "", "x", 1), (3002, "a" * 99, "x", 1), (3003, "a" * 4000, "x", 1),
             (3004, "ab" * 3000, "x", 1), (3003, "a" * 4000, "x", 1), (None, rows[5][1] + " tail", "x", 1)]
    return rows


@pytest.mark.parametrize("seed,gram", [(1, 16), (2, 4), (3, 100), (4, 1)])
def test_against_brute_force(spark, seed, gram):
    rows = make(seed)
    got = remove_substrings(spark.createDataFrame(rows, SCHEMA).repartition(5), gram=gram).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, 100)


def test_many_parts_of_one_anchor(spark):
    """More chains around one passage than a part holds."""
    rng = random.Random(9)
    p = "".join(rng.choice("abcdefgh") for _ in range(130))
    rows = [(i, "%08d" % rng.randrange(10 ** 8) + p[i % 7:120 + i % 9] + "%08d" % rng.randrange(10 ** 8), "x", 1)
            for i in range(3 * repeats.PART)]
    got = remove_substrings(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, 100)


def test_empty(spark):
    assert remove_substrings(spark.createDataFrame([], SCHEMA)).count() == 0
    assert remove_substrings(spark.createDataFrame([(1, "a b", "x", 1)], SCHEMA), with_text=True).first().kept == b"a b"


@pytest.mark.parametrize("files", [True, False])
def test_rows_that_share_an_id(spark, tmp_path, files):
    rng = random.Random(8)
    text = lambda: "".join(rng.choice("abcdefgh ") for _ in range(260))
    a, b, c = text(), text(), text()
    rows = [(1, a), (5, a), (5, b), (None, c), (None, text() + c), (None, text()), (5, b[:150]), (5, None), (2, a + "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    if files:
        df.write.parquet(str(tmp_path / "docs"))
        df = spark.read.parquet(str(tmp_path / "docs"))
    assert sorted(map(tuple, remove_substrings(df).collect()), key=str) == brute(rows, 100)
