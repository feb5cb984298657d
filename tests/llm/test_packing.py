import tracemalloc
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rankforge.llm import packing
from rankforge.llm.packing import END_ID, WordEncoder, best_fit, pack, tokenizer_path

SCHEMA = "doc_id long, text string, shard string, row int"
TEXTS = ["Hello, World! it's 'tis don't you'VE 123abc éÀß×÷ Ünï ÿ", None, "", " \n\t ", "word " * 9000, "a" * 30000,
         "日本語 и русский ẞ İstanbul ΑΣ", "x<|endoftext|>y <|startoftext|>", "é Å   z q", "\x00\x1f\x7f",
         "!!'s ''re 'Sam ªµº", "it''s 5's %%% | \x85 b", "𝒜𝓑 🙂 ﬁ"]


@pytest.fixture(scope="module")
def plain():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


@pytest.fixture(scope="module")
def encoder():
    return WordEncoder(tokenizer_path())


def encode(encoder, texts):
    raw = [t.encode() for t in texts]
    off = np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64)
    ids, n = encoder.encode(np.frombuffer(b"".join(raw), dtype=np.uint8), off)
    return [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=40), st.text("aZé'sß ÷Ù9.!\n", max_size=40)), min_size=1, max_size=6))
def test_ids_equal_the_library(plain, encoder, texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    assert encode(encoder, texts) == [plain.encode(t, add_special_tokens=False).ids for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=80), st.integers(1, 9), st.sampled_from(["norm", "dot"]), st.integers(2500, 6000))
def test_best_fit_keeps_capacities(lengths, max_docs, rule, cost):
    n = np.array(sorted(lengths, reverse=True), dtype=np.int64)
    where, offset = best_fit(n, 50, max_docs, cost, rule=rule)
    by = defaultdict(list)
    for i in range(len(n)):
        by[where[i]].append((offset[i], n[i]))
    for own in by.values():
        own.sort()
        assert sum(x[1] for x in own) <= 50 and len(own) <= max_docs and sum(x[1] ** 2 for x in own) <= cost
        assert [x[0] for x in own] == [sum(y[1] for y in own[:k]) for k in range(len(own))]
    if max_docs == 9 and cost >= 2500 and len(n):
        full = [sum(x[1] for x in own) for own in by.values() if len(own) < 9]
        assert sum(x <= 25 for x in full) <= 1


def test_whole_packing(spark, plain):
    rows = [(i, t, "s", 1) for i, t in enumerate(TEXTS)] + [(0, TEXTS[0], "s", 1), (None, "null id", None, None)]
    got = pack(spark.createDataFrame(rows, SCHEMA), tokenizer_path(), shard_pieces=7).collect()
    want = defaultdict(list)
    for i, t, *_ in rows:
        ids = np.array(plain.encode(t or "", add_special_tokens=False).ids + [END_ID], dtype="<u4")
        want[i] += [(k, s, len(ids[s:s + 4096]), zlib.crc32(ids[s:s + 4096].tobytes()))
                    for k, s in enumerate(range(0, len(ids), 4096))]
    have, seq = defaultdict(list), defaultdict(list)
    for r in got:
        have[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
        seq[r.sequence_id].append((r.offset, r.length))
    assert {k: sorted(v) for k, v in have.items()} == {k: sorted(v) for k, v in want.items()}
    for own in seq.values():
        own.sort()
        assert sum(x[1] for x in own) <= 4096
        assert all(o == sum(x[1] for x in own[:k]) for k, (o, _) in enumerate(own))
    assert pack(spark.createDataFrame([], SCHEMA), tokenizer_path()).count() == 0


def test_a_task_gets_texts_in_small_batches(spark, monkeypatch):
    def sizes(*_):
        def run(batches):
            for b in batches:
                one = [pa.array([0]), pa.array([0]), pa.array([0], pa.int32()), pa.array([b.nbytes]), pa.array([1]), pa.array([b.num_rows])]
                yield pa.RecordBatch.from_arrays(one, names=["id", "row", "piece", "start", "length", "ids_crc32"])
        return run

    monkeypatch.setattr(packing, "_cut", sizes)
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    got = pack(spark.range(6000).selectExpr("id doc_id", "repeat('text', 1000) text").coalesce(1), "none").collect()
    assert sum(r.ids_crc32 for r in got) == 6000 and sum(r.start for r in got) > 24e6
    assert max(r.start for r in got) < 8e6
    assert spark.conf.get(name) == before


def test_memory_of_a_task():
    rng = np.random.default_rng(0)
    words = np.array([f"{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676 % 26)}" for i in range(5000)])
    texts = [" ".join(words[rng.integers(0, 5000, 1000)]) for _ in range(2000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(2000)), pa.array(range(2000)), pa.array(texts)], names=["id", "row", "text"])
    run = packing._cut(tokenizer_path(), 4096, END_ID)
    assert sum(r.num_rows for r in run(iter([batch.slice(0, 10)]))) == 10
    tracemalloc.start()
    try:
        assert sum(r.num_rows for r in run(iter([batch]))) == 2000
        assert tracemalloc.get_traced_memory()[1] < 70e6
    finally:
        tracemalloc.stop()
