import math
import random
import re
import zlib
from collections import Counter

import numpy as np

from rankforge.llm.pitman_yor import Block, Cell, discount, held_out, score_texts, seat, tokens

SCHEMA = "doc_id long, text string, kind string, block int"


def make(n=1500):
    rng = random.Random(4)
    syl = ["the", "an", "er", "on", "ti", "é", "ing", "ST"]
    rows = [(i, rng.choice([" ", "\n"]).join("".join(rng.choice(syl) for _ in range(rng.randrange(1, 6)))
                                              for _ in range(rng.randrange(0, 60))), "x", 1) for i in range(n)]
    return rows + [(5000, None, "x", 1), (5001, " \t", None, 1), (5002, "The an on " * 300, "x", 1), (None, "an er", "x", None),
                   (7, rows[7][1], "x", 1), (5003, "日本 zzz", "x", 1)]


def words(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "").encode())


def test_scores(spark):
    rows = make()
    df = spark.createDataFrame(rows, SCHEMA)
    got = score_texts(df.repartition(3), block_bytes=4000).collect()
    assert len(got) == len(rows)
    name = lambda i: "" if i is None else str(i)
    train_tokens = Counter()
    for i, t, *_ in rows:
        if zlib.crc32(name(i).encode()) % 5 != 1:
            train_tokens.update(words(t) + [b"\n"])
    n, v = sum(train_tokens.values()), len(train_tokens)
    text = {r[0]: r[1] for r in rows}
    better = []
    for r in got:
        tok = words(text[r.doc_id]) + [b"\n"]
        base = sum(math.log10((train_tokens[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tok)
        assert r.train_tokens == n and r.n_tokens == len(tok) and r.n_known == sum(w in train_tokens for w in tok)
        assert abs(r.base_score - base) < 1e-6 * max(1, abs(base)) and r.score <= 0
        assert r.held_out == (zlib.crc32(name(r.doc_id).encode()) % 5 == 1)
        if r.held_out and len(tok) > 10:
            better.append(r.score > r.base_score)
    assert np.mean(better) > 0.9
    again = score_texts(df.repartition(5), block_bytes=4000).collect()
    f = lambda rs: sorted((str(r.doc_id), r.score) for r in rs)
    assert all(a[0] == b[0] and abs(a[1] - b[1]) < 1e-5 * max(1, abs(a[1])) for a, b in zip(f(got), f(again)))


def test_predictions_sum_to_one():
    """Over all known words and the unknown one, in seen and unseen contexts."""
    rng = np.random.default_rng(1)
    w, c = rng.zipf(1.4, 4000), rng.integers(0, 6, 4000)
    keep = w < 300
    grid_w, grid_c = np.repeat(np.arange(301), 7), np.tile(np.arange(7), 301)          # word 0 and context 6 are never seen
    n = np.bincount(w[keep] * 7 + c[keep], minlength=301 * 7)
    cell = Cell(grid_w, grid_c, n)
    t = cell.start()
    model = {"d1": 0.7, "d0": 0.6}
    for sweep in range(4):
        wt, wg, ct, cg = cell.shares(t)
        model = {**model, "tables": wt.sum(), "words": (wg > 0).sum()}
        p = cell.predict(model, t, wt, ct, cg)
        new = (wg == 0)[cell.w]
        for x in range(7):
            here = cell.c == x
            assert abs(p[here & ~new].sum() + p[here & new].max() - 1) < 1e-9
        t = cell.reseat(model, wt, ct, rng)
        assert (t <= cell.n).all() and (t[cell.n > 0] >= 1).all() and (t[cell.n == 0] == 0).all()


def one_by_one(texts, sweeps=400, burn=50, seed=3):
    """Log10 scores by seating customers singly, as the process is defined."""
    rng = random.Random(seed)
    seen = [(b"" if i == 0 else t[i - 1], w) for t in texts for i, w in enumerate(t)]
    n = Counter(seen)
    few = lambda c, k: sum(v == k for v in c.values())
    d1 = discount(few(n, 1), few(n, 2))
    first = Counter(w for _, w in n)
    d0, words = discount(few(first, 1), few(first, 2)), len(first)
    seats = {x: [k] for x, k in n.items()}                           # sizes of the tables of each dish
    guests, tables, parent = Counter(), Counter(), Counter()
    for (c, w), k in n.items():
        guests[c] += k
        tables[c] += 1
        parent[w] += 1
    root = lambda w: (parent[w] - d0 if parent[w] else 1 + d0 * len(+parent)) / (1 + sum(parent.values()))
    total, used = Counter(), 0
    ask = [(c, w) for c in [*guests, b"never"] for w in [*first, b"unknown"]]
    for s in range(sweeps):
        for c, w in seen:
            own = seats[c, w]
            i = rng.choices(range(len(own)), own)[0]
            own[i] -= 1
            guests[c] -= 1
            if not own[i]:
                del own[i]
                tables[c] -= 1
                parent[w] -= 1
            fresh = (1 + d1 * tables[c]) * root(w)
            i = rng.choices(range(len(own) + 1), [k - d1 for k in own] + [fresh])[0]
            guests[c] += 1
            if i < len(own):
                own[i] += 1
            else:
                own.append(1)
                tables[c] += 1
                parent[w] += 1
        if s >= burn:
            used += 1
            for c, w in ask:
                own = seats.get((c, w), [])
                total[c, w] += (sum(own) - d1 * len(own) + (1 + d1 * tables[c]) * root(w)) / (1 + guests[c])
    assert words == len(first)
    return {x: math.log10(v / used) for x, v in total.items()}


def test_against_seating_one_by_one(spark):
    rng = random.Random(8)
    vocab = [b"a", b"b", b"c", b"d", b"e"]
    train, ids = [], [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 != 1][:40]
    for _ in ids:
        t = [rng.choice(vocab)]
        while len(t) < 12:
            t.append(vocab[(vocab.index(t[-1]) + rng.choice([1, 1, 1, 0, 2])) % 5])
        train.append(t)
    want = one_by_one([[*t, b"\n"] for t in train])
    asked = [i for i in range(1000, 1400) if zlib.crc32(str(i).encode()) % 5 == 1][:30]
    tests = [[rng.choice([*vocab, b"zz"]) for _ in range(9)] for _ in asked]
    rows = [(i, b" ".join(t).decode(), "x", 1) for i, t in zip([*ids, *asked], [*train, *tests])]
    got = {r.doc_id: r.score for r in score_texts(spark.createDataFrame(rows, SCHEMA), burn_in=3, kept=8).collect()}
    for i, t in zip(asked, tests):
        t = [*t, b"\n"]
        score = 0.0
        for k, w in enumerate(t):
            c = b"" if k == 0 else t[k - 1]
            c = b"never" if c == b"zz" else c
            score += want[c, b"unknown" if w == b"zz" else w]
        assert abs(got[i] - score) < 0.02 * len(t), (t, got[i], score)


def test_seating_distribution():
    """Mean tables against one-by-one seating."""
    rng = np.random.default_rng(0)
    c, b, d = 40, 0.7, 0.6
    got = seat(np.full(20000, float(c)), np.full(20000, b), d, rng)
    want = []
    for _ in range(4000):
        t = 1
        for i in range(1, c):
            t += rng.random() < b / (b + i - d * t)
        want.append(t)
    assert abs(got.mean() - np.mean(want)) < 0.1 and got.min() >= 1 and got.max() <= c
    assert seat(np.array([1.0, 1.0]), np.array([1.0, 5.0]), 0.5, rng).tolist() == [1, 1]


def test_blocks_and_held_out():
    texts = ["Ab  c\n", "", " x", "é Z", "ab c"]
    raw = np.frombuffer("".join(texts).encode(), dtype=np.uint8)
    off = np.cumsum([0] + [len(t.encode()) for t in texts])
    own, word = tokens(raw, off)
    assert own.tolist() == [0, 0, 0, 1, 2, 2, 3, 3, 3, 4, 4, 4] and len(set(word.tolist())) == 6
    for side in (1, 3):
        block = Block([t.encode() for t in texts], side)
        context = np.append(np.uint64(0), word[:-1])              # the end of the text before is the start of the next
        assert (block.keys[block.w][block.pair] == word).all() and (block.keys[block.c][block.pair] == context).all()
        assert len(block.w) == len({*zip(word.tolist(), context.tolist())}) and block.cut[-1] == len(block.w)
        assert block.counts(np.array([False, False, True, False, False])).sum() == len(word) - 2
    assert held_out(5) == (zlib.crc32(b"5") % 5 == 1)


def test_contexts_are_whole_words(spark):
    """Words after 'xan' and 'yan' differ; the last two bytes don't tell."""
    rows = [(i, "xan left " * 20 if i % 2 else "yan right " * 20, "x", 1) for i in range(300)]
    got = {r.doc_id: r.score / r.n_tokens for r in score_texts(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert max(got.values()) < 0 and min(got.values()) > -0.05


def test_rows_without_id(spark):
    rows = [(None, f"w{i} common words", "x", 1) for i in range(300)] + [(None, None, "x", 1)]
    got = score_texts(spark.createDataFrame(rows, SCHEMA), block_bytes=500).collect()
    assert len(got) == 301 and all(r.doc_id is None and r.score < 0 for r in got) and sorted(r.n_tokens for r in got)[:2] == [1, 4]


def test_empty(spark):
    assert score_texts(spark.createDataFrame([], SCHEMA)).count() == 0
    df = spark.createDataFrame([(3, "a", "x", 1)], SCHEMA)
    assert score_texts(df).first().n_tokens == 2
