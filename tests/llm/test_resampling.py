import hashlib
import math
import re
from zlib import crc32

import numpy as np
import pytest

from rankforge.llm import resampling
from rankforge.llm.resampling import Shift, prefix_scan, resample

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def grams(text, max_n):
    w = WORD.findall((text or "").translate(LOWER))
    return w, [" ".join(w[i:i + n]) for n in range(1, max_n + 1) for i in range(len(w) - n + 1)]


def brute(rows, target, max_n, buckets, least, percent, seed="2024"):
    key = lambda g: crc32(g.encode()) % buckets
    s, t = [0] * buckets, [0] * buckets
    for _, text in rows:
        for g in grams(text, max_n)[1]:
            s[key(g)] += 1
    for text in target:
        for g in grams(text, max_n)[1]:
            t[key(g)] += 1
    gain = [math.floor(1000 * math.log((t[i] + 1) * (sum(s) + buckets) / ((s[i] + 1) * (sum(t) + buckets))))
            for i in range(buckets)]
    out = []
    for i, text in rows:
        w, g = grams(text, max_n)
        weight = sum(gain[key(x)] for x in g) // len(g) if g else 0
        h = int(hashlib.sha256(f"{seed}:{'null' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(g), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(w)])
    fit = sorted((r for r in out if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    rank = {id(r): k + 1 for k, r in enumerate(fit[:len(fit) * percent // 100])}
    return sorted(((*r[:4], rank.get(id(r))) for r in out), key=repr)


def make(n=300):
    rng = np.random.default_rng(5)
    words = ["The", "of", "né", "ALPHA", "beta9", "x", "日本", "zeta", "Ünder", "z" * 40]
    rows = [(i, " ".join(rng.choice(words, size=rng.integers(1, 60)))) for i in range(n)]
    rows += [(1000, None), (1001, ""), (1002, " ,;- \n"), (None, rows[0][1]), (None, rows[0][1]), (None, "other words " * 15),
             (7, rows[7][1]), (7, "a different text " * 9), (7, rows[7][1]), (1003, "A-b_C" * 20), (1004, "\x7f\x00a\x1fb")]
    rows += [(2000 + i, rows[3][1]) for i in range(120)]
    return rows


@pytest.mark.parametrize("max_n,buckets,least,percent", [(1, 10_000, 20, 10), (1, 64, 20, 35), (3, 500, 1, 100), (2, 97, 30, 0)])
def test_against_brute_force(spark, max_n, buckets, least, percent):
    rows = make()
    target = ["alpha beta9 of", None, "", rows[5][1], "né 日本 quite new"]
    docs = spark.createDataFrame([(i, t, "clash", 1, 2, 3) for i, t in rows],
                                 "doc_id long, text string, id string, score int, bucket int, rank int").repartition(5)
    got = resample(docs, spark.createDataFrame([(t,) for t in target], "text string"), max_n=max_n, buckets=buckets,
                   least_words=least, percent=percent)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows, target, max_n, buckets, least, percent)


@pytest.mark.parametrize("max_n", [1, 2, 4])
def test_pieces_of_long_texts(monkeypatch, max_n):
    rng = np.random.default_rng(max_n)
    texts = [" ".join("w" * int(rng.integers(1, 30)) + str(rng.integers(9)) for _ in range(n)) for n in (0, 1, 3, 200, 900)]
    texts += ["--" + texts[3] + "  ", "é" * 500, " " * 700, " " * 300 + "a b" + "." * 400 + "c"]
    for piece in (1 << 19, 100, 7):
        monkeypatch.setattr(resampling, "PIECE", piece)
        found, words = {}, {}
        for doc, crc, n in prefix_scan([t.encode() for t in texts], max_n):
            for i, c in zip(doc.tolist(), crc.tolist()):
                found.setdefault(i, []).append(c)
            for i, c in n.items():
                words[i] = words.get(i, 0) + c
        for i, t in enumerate(texts):
            w, g = grams(t, max_n)
            assert sorted(found.get(i, [])) == sorted(crc32(x.encode()) for x in g)
            assert words.get(i, 0) == len(w)


def test_a_text_of_fifty_megabytes(spark):
    text = "one two three four five six seven " * 1_500_000
    got = resample(spark.createDataFrame([(1, text), (2, "one two")], "doc_id long, text string"),
                   spark.createDataFrame([("one",)], "text string"), percent=100).collect()
    assert {r.doc_id: (r.n_features, r["rank"]) for r in got} == {1: (10_500_000, 1), 2: (2, None)}


def test_shift_cancels_a_prefix():
    rng = np.random.default_rng(1)
    shift = Shift()
    for n in (0, 1, 7, 255, 256, 70_000):
        a, b = rng.bytes(33), rng.bytes(n)
        whole, part = np.array([crc32(a + b)], dtype=np.uint32), np.array([crc32(a)], dtype=np.uint32)
        assert int((whole ^ shift(part, np.array([n])))[0]) == crc32(b)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "a b c " * 9)], "doc_id long, text string")
    assert resample(none, none).count() == 0
    assert resample(some, none, percent=100).first()["rank"] == 1


def test_ranks_over_many_equal_scores(spark):
    docs = spark.range(20_000).selectExpr("cast(null as long) AS doc_id", "repeat('same words ', 12) AS text")
    got = [r["rank"] for r in resample(docs, docs.limit(1)).where("rank is not null").collect()]
    assert sorted(got) == list(range(1, 2001))
