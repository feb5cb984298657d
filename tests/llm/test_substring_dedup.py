import hashlib
import random
import re

import pytest

from rankforge.llm.substring_dedup import remove_repeats, repeated_paths

SCHEMA = "doc_id long, text string, start string, n long"


def brute(rows, k=20):
    docs = sorted(((r[0] is None, r[0], r[1]) for r in rows), key=lambda r: (r[0], r[1] or 0))
    seen, out = set(), []
    for _, i, text in docs:
        w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
        gone = [False] * len(w)
        for p in range(len(w) - k + 1):
            win = tuple(w[p:p + k])
            if win in seen:
                gone[p:p + k] = [True] * k
            seen.add(win)
        left = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(left).hexdigest()))
    return sorted(out, key=str)


def make(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice(["a", "b", "é", "d\x85d", "e" * 9]) + str(rng.randrange(40))
    passages = [[word() for _ in range(rng.randrange(15, 90))] for _ in range(8)]
    rows = []
    for i in range(120):
        w = []
        for _ in range(rng.randrange(6)):
            w += [word() for _ in range(rng.randrange(30))]
            p = rng.choice(passages)
            cut = rng.randrange(len(p)) if rng.random() < 0.5 else 0
            w += p[cut:] if rng.random() < 0.5 else p[:len(p) - cut]
            if rng.random() < 0.3 and w:
                w[rng.randrange(len(w))] = word()
        rows.append((i * 7 % 1000, rng.choice([" ", "\n", " \t "]).join(w), "x", 1))
    rows += [(2000 + i, rows[3][1], None, 1) for i in range(30)]
    rows += [(3000, None, "x", None), (3001, "", "x", 1), (3002, "one two", "x", 1), (3003, "x " * 3000, "x", 1),
             (3004, "x y " * 2000, "x", 1), (3003, "x " * 3000, "x", 1), (None, rows[5][1] + " tail", "x", 1)]
    return rows


@pytest.mark.parametrize("seed,gram", [(1, 4), (2, 1), (3, 20), (4, 7)])
def test_against_brute_force(spark, seed, gram):
    rows = make(seed)
    got = remove_repeats(spark.createDataFrame(rows, SCHEMA).repartition(5), gram=gram).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_paths_name_an_earlier_occurrence(spark):
    rows = make(5)
    texts = {r[0]: re.findall(rb"[^\x20\x09-\x0D]+", (r[1] or "").encode()) for r in rows}
    got = repeated_paths(spark.createDataFrame(rows, SCHEMA)).collect()
    assert got
    for r in got:
        src = texts[r.source_id][r.source_start:r.source_start + r.end - r.start]
        assert r.end - r.start >= 20 and src == texts[r.doc_id][r.start:r.end]
        big = lambda x: float("inf") if x is None else x
        assert (big(r.source_id), r.source_start) < (big(r.doc_id), r.start) or r.doc_id == 3003   # there twice


def test_small_tables(spark):
    assert remove_repeats(spark.createDataFrame([], SCHEMA)).count() == 0
    df = spark.createDataFrame([(1, "a b", "x", 1)], SCHEMA)
    row = remove_repeats(df, with_text=True).first()
    assert (row.n_removed, row.kept_text) == (0, "a b")


@pytest.mark.parametrize("files", [True, False])
def test_rows_that_share_an_id(spark, tmp_path, files):
    """Spans go by row: neither a text of the same id nor of another null id is cut with it."""
    words = lambda x: " ".join(f"{x}{i}" for i in range(40))
    rows = [(1, words("a")), (5, words("a")), (5, words("b")), (None, words("c")), (None, words("d") + " " + words("c")),
            (None, words("e")), (5, words("b") + " tail"), (5, None), (2, words("a") + " x")]
    rows = [(i, t, "x", 1) for i, t in rows]
    df = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    if files:
        df.write.parquet(str(tmp_path / "docs"))
        df = spark.read.parquet(str(tmp_path / "docs"))
    assert sorted(map(tuple, remove_repeats(df).collect()), key=str) == brute(rows)
    got = {(r.doc_id, r.start, r.end, r.source_id) for r in repeated_paths(df).collect()}
    assert got == {(2, 0, 40, 1), (5, 0, 40, 1), (5, 0, 40, 5), (None, 40, 80, None)}
