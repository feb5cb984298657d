"""Best-fit packing of tokenised documents into sequences (operator 10).

1. Tasks tokenise whole texts and cut each document's ids (the text's ids and
   one end id) into pieces of at most ``max_tokens``.  Only the piece records
   (ids' place, length and checksum) leave the task.
2. The pieces are dealt into shards of about ``shard_pieces`` by hash; the
   number of shards follows the number of pieces, so a shard's memory is
   bounded.
3. Each shard is packed by vector best fit, longest pieces first.  A sequence
   has three capacities: tokens, documents and attention cost (the sum of
   squared lengths).  Among the open sequences that can take a piece under
   every capacity the one with the best score is chosen: the smallest weighted
   norm of what would be left (``norm``) or the largest weighted product of
   demand and residual (``dot``).  A new sequence opens only if none can.

Open sequences are kept by residual tokens, the one opened last first, and the
score compares one sequence per residual; if that one lacks document or
attention capacity, the others of that residual are tried too.

Defined results: null and empty texts are one piece holding the end id;
documents of more than ``max_tokens`` ids are cut, others never are; rows that
repeat an id are separate documents; an empty table packs to nothing; other
columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankforge.llm.shared import cut_lineage, frugal, give_back, keep, mix, powers, slices, utf8

#: Fixed values of the packing.
MAX_TOKENS = 4096
END_ID = 1
TOKENIZER = "word_bpe_49k.json"
SHARD_PIECES = 40_000
#: Bytes of text encoded together; more share more forms.
SLICE_BYTES = 1_000_000
#: Bytes of the Arrow batches that tasks get texts in; a batch is held by the
#: executor and by its worker.
BATCH_BYTES = "4m"
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Most word forms whose ids a worker keeps between batches.
KEPT_FORMS = 400_000

_DIGITS, _LETTERS, _OTHER = 2, 1, 3
_FORMS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\x09-\x0D\x20a-z0-9ß-öø-ÿ]+")


def _byte_class() -> np.ndarray:
    c = np.full(256, _OTHER, dtype=np.uint8)
    c[[0x20, 9, 10, 11, 12, 13]] = 0
    c[ord("a"):ord("z") + 1] = _LETTERS
    c[ord("0"):ord("9") + 1] = _DIGITS
    c[0x80:] = _LETTERS              # only letters of U+00C0-00FF get here
    return c


class WordEncoder:
    """Ids of texts, the same as the tokenizer file gives for each whole text.

    The vocabulary splits text into letter runs, single digits and runs of
    other marks before merging, so a form's ids don't depend on its
    neighbours.  Texts of ASCII and Latin-1 letters are split here, each
    distinct form is encoded once by the library's model and looked up after
    that; any other text (other scripts, control or combining characters, the
    library's special strings) is encoded whole by the library.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.path, self._whole = path, None
        self.forms = Tokenizer.from_file(path)
        self.forms.normalizer = normalizers.Sequence([])
        self.forms.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.codes = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        self.classes = _byte_class()
        self._clear()

    @property
    def whole(self):
        """The tokenizer as it is in the file, loaded for the first text that needs it."""
        if self._whole is None:
            from tokenizers import Tokenizer

            self._whole = Tokenizer.from_file(self.path)
        return self._whole

    def _clear(self) -> None:
        self.index: dict[int, int] = {}                              # forms of texts with an apostrophe
        self.keys, self.rows = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)     # the others', by key
        self.flat, self.start = np.zeros(0, dtype=np.uint32), np.zeros(1, dtype=np.int64)

    def _learn(self, words: list[str]) -> range:
        """The rows of new forms."""
        enc = self.forms.encode(words, is_pretokenized=True, add_special_tokens=False)
        n = np.bincount(np.fromiter(enc.word_ids, np.int64, len(enc.ids)), minlength=len(words))
        rows = range(len(self.start) - 1, len(self.start) - 1 + len(words))
        self.flat = np.concatenate([self.flat, np.array(enc.ids, dtype=np.uint32)])
        self.start = np.concatenate([self.start, self.start[-1] + np.cumsum(n)])
        return rows

    def _find(self, keys: np.ndarray, word: Callable[[int], str]) -> np.ndarray:
        """The rows of distinct forms by rising key; ``word`` gives a form that is new."""
        at = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), dtype=bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == keys[inside]
        rows = np.empty(len(keys), dtype=np.int64)
        rows[known] = self.rows[at[known]]
        new = np.flatnonzero(~known)
        if len(new):
            rows[new] = self._learn([word(i) for i in new])
            self.keys = np.insert(self.keys, at[new], keys[new])
            self.rows = np.insert(self.rows, at[new], rows[new])
        return rows

    def _gather(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each form) for the forms' rows."""
        n = self.start[rows + 1] - self.start[rows]
        end = np.cumsum(n)
        return self.flat[np.repeat(self.start[rows] - (end - n), n) + np.arange(end[-1] if len(end) else 0)], n

    def _simple(self, raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(documents that must be encoded whole, documents with an apostrophe)."""
        nxt = np.append(raw[1:], np.uint8(0))
        prev = np.insert(raw[:-1], 0, np.uint8(0)) if len(raw) else raw
        tail = (raw >= 0x80) & (raw < 0xC0)
        odd = ((raw >= 0xC0) & (raw != 0xC3)) | (tail & ((prev != 0xC3) | (raw == 0x97) | (raw == 0xB7))) \
            | (raw < 9) | ((raw > 13) & (raw < 32)) | (raw == 127) | ((raw == 0x3C) & (nxt == 0x7C))
        mark = lambda hit: np.bincount(np.searchsorted(off, np.flatnonzero(hit), side="right") - 1,
                                       minlength=len(off) - 1).astype(bool)
        return mark(odd), mark(raw == 0x27)

    def encode(self, raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, number of ids of each document) of UTF-8 documents."""
        if len(self.start) > KEPT_FORMS:
            self._clear()
        whole, quote = self._simple(raw, off)
        text = lambda d: bytes(raw[off[d]:off[d + 1]]).decode("utf-8", "replace")
        apart: dict[int, np.ndarray] = {}
        for d in np.flatnonzero(whole):
            apart[d] = np.array(self.whole.encode(text(d), add_special_tokens=False).ids, dtype=np.uint32)
        for d in np.flatnonzero(quote & ~whole):
            forms = _FORMS.findall(text(d).lower())
            keys = [hash(("form", f)) for f in forms]
            new = {k: f for k, f in zip(keys, forms) if k not in self.index}
            if new:
                self.index.update(zip(new, self._learn(list(new.values()))))
            apart[d] = self._gather(np.fromiter(map(self.index.__getitem__, keys), np.int64, len(keys)))[0]

        low = raw + ((raw >= 65) & (raw <= 90)) * np.uint8(32)
        prev = np.insert(raw[:-1], 0, np.uint8(0)) if len(raw) else raw
        low += ((prev == 0xC3) & (raw >= 0x80) & (raw <= 0x9E)) * np.uint8(32)
        kind = self.classes[low]
        edge = np.zeros(len(raw) + 1, dtype=bool)
        edge[off] = True
        kind_prev = np.insert(kind[:-1], 0, 0) if len(raw) else kind
        begin = (kind != 0) & ((kind != kind_prev) | (kind == _DIGITS) | edge[:-1])
        start = np.flatnonzero(begin)
        doc = np.searchsorted(off, start, side="right") - 1
        use = ~(whole | quote)[doc]
        start, doc = start[use], doc[use]
        n = np.zeros(len(off) - 1, dtype=np.int64)
        ids = np.zeros(0, dtype=np.uint32)
        if len(start):
            stop = np.append((kind != kind_prev) | (kind == _DIGITS) | edge[:-1], True)
            stops = np.flatnonzero(stop)
            end = stops[np.searchsorted(stops, start, side="right")]
            del stop, stops
            up, down = powers(len(low) + 1)
            total = np.zeros(len(low) + 1, dtype=np.uint64)
            total[1:] = self.codes[low]
            total[1:] *= up[:len(low)]
            np.cumsum(total[1:], out=total[1:])
            key = mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))
            del total
            uniq, first, inv = np.unique(key, return_index=True, return_inverse=True)
            del key
            rows = self._find(uniq, lambda i: bytes(low[start[first[i]]:end[first[i]]]).decode())
            ids, each = self._gather(rows[inv])
            n = np.bincount(doc, weights=each, minlength=len(off) - 1).astype(np.int64)
        if not apart:
            return ids, n
        at, out = np.concatenate([[0], np.cumsum(n)]), []
        for d in range(len(n)):
            out.append(apart[d] if d in apart else ids[at[d]:at[d + 1]])
        return np.concatenate(out), np.array([len(x) for x in out], dtype=np.int64)


_PIECES = "id long, row long, piece int, start long, length long, ids_crc32 long"


def _cut(path: str, max_tokens: int, end_id: int) -> Callable:
    def run(batches):
        enc = keep(path, lambda: WordEncoder(path))
        for batch in batches:
            for part in slices(batch, limit=SLICE_BYTES):
                raw, off = utf8(part.column(2))
                ids, n = enc.encode(raw, off)
                at = np.concatenate([[0], np.cumsum(n)])
                own, place, first, size, crc = [], [], [], [], []
                for d in range(len(n)):
                    full = np.append(ids[at[d]:at[d + 1]], np.uint32(end_id)).astype("<u4")
                    for k, s in enumerate(range(0, len(full), max_tokens)):
                        x = full[s:s + max_tokens]
                        own.append(d)
                        place.append(k)
                        first.append(s)
                        size.append(len(x))
                        crc.append(zlib.crc32(x.tobytes()))
                own = pa.array(own, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(own), part.column(1).take(own), pa.array(place, pa.int32()),
                     pa.array(first, pa.int64()), pa.array(size, pa.int64()), pa.array(crc, pa.int64())],
                    names=["id", "row", "piece", "start", "length", "ids_crc32"])
            give_back()
    return run


def pieces(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
           max_tokens: int = MAX_TOKENS, end_id: int = END_ID) -> DataFrame:
    """id, row, piece, start, length, ids_crc32 of every piece; ``row`` tells
    rows that repeat an id apart."""
    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.monotonically_increasing_id().alias("row"),
                       F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(frugal(_cut(path, max_tokens, end_id)), _PIECES)


def _in_small_batches(df: DataFrame) -> DataFrame:
    """Checkpoint of ``df``, whose tasks get batches of about ``BATCH_BYTES``."""
    spark = df.sparkSession
    before = spark.conf.get(_BATCH)
    spark.conf.set(_BATCH, BATCH_BYTES)
    try:
        return cut_lineage(df)
    finally:
        spark.conf.set(_BATCH, before)


def best_fit(length: np.ndarray, max_tokens: int, max_docs: int, max_attention: float,
             weights: tuple[float, float, float] = (1.0, 0.01, 0.01), rule: str = "norm"):
    """(bin, offset) of each piece, given longest first."""
    level: list[list[int]] = [[] for _ in range(max_tokens + 1)]     # open bins by residual tokens
    docs_left, cost_left = [], []
    res = np.arange(max_tokens + 1) / max_tokens
    top_docs = np.zeros(max_tokens + 1)
    top_cost = np.full(max_tokens + 1, -1.0)                         # below 0: no bin there
    w0, w1, w2 = weights
    where, offset = np.zeros(len(length), dtype=np.int64), np.zeros(len(length), dtype=np.int64)

    def show(r: int) -> None:
        if level[r]:
            top_docs[r], top_cost[r] = docs_left[level[r][-1]], cost_left[level[r][-1]]
        else:
            top_cost[r] = -1.0

    for i, n in enumerate(length.tolist()):
        cost = float(n) * n
        open_ = np.flatnonzero(top_cost[n:] >= 0) + n
        fit = open_[(top_docs[open_] >= 1) & (top_cost[open_] >= cost)]
        if len(fit):
            if rule == "norm":
                score = w0 * (res[fit] - n / max_tokens) ** 2 + w1 * ((top_docs[fit] - 1) / max_docs) ** 2 \
                    + w2 * ((top_cost[fit] - cost) / max_attention) ** 2
                r = int(fit[np.argmin(score)])
            else:
                score = w0 * res[fit] * n / max_tokens + w1 * top_docs[fit] / max_docs ** 2 \
                    + w2 * top_cost[fit] * cost / max_attention ** 2
                r = int(fit[np.argmax(score)])
            b = level[r].pop()
        else:
            r, b = -1, -1
            for q in open_:                                          # a bin below the top may still fit
                for j, c in enumerate(level[q]):
                    if docs_left[c] >= 1 and cost_left[c] >= cost:
                        r, b = int(q), level[q].pop(j)
                        break
                if b >= 0:
                    break
            if b < 0:
                b, r = len(docs_left), max_tokens
                docs_left.append(max_docs)
                cost_left.append(max_attention)
        docs_left[b] -= 1
        cost_left[b] -= cost
        where[i], offset[i] = b, max_tokens - r
        show(r)
        if r - n > 0:
            level[r - n].append(b)
            show(r - n)
    return where, offset


def pack(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", max_tokens: int = MAX_TOKENS,
         max_docs: int | None = None, max_attention: float | None = None, end_id: int = END_ID,
         weights: tuple[float, float, float] = (1.0, 0.01, 0.01), rule: str = "norm",
         shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset.

    ``max_docs`` and ``max_attention`` default to what a sequence of
    ``max_tokens`` can hold at most, so they never cost a sequence.
    """
    max_docs = max_docs or max_tokens
    max_attention = float(max_attention or max_tokens * max_tokens)
    if max_attention < max_tokens * max_tokens:
        raise ValueError("max_attention must admit a piece of max_tokens")
    got = _in_small_batches(pieces(docs, path, id_col, text_col, max_tokens, end_id))
    shards = max(1, -(-got.count() // shard_pieces))
    split = got.withColumn("shard", F.pmod(F.xxhash64("row", "piece"), F.lit(shards)).cast("int"))

    def place(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "id", "row", "piece"], ascending=[False, True, True, True])
        where, offset = best_fit(pdf["length"].to_numpy(), max_tokens, max_docs, max_attention, weights, rule)
        base = int(pdf["shard"].iloc[0]) << 32
        return pdf.assign(sequence_id=where + base, offset=offset)[list(_PACKED)]

    out = split.groupBy("shard").applyInPandas(place, ", ".join(f"{k} {v}" for k, v in _PACKED.items()))
    return out.select(F.col("id").alias(id_col), *list(_PACKED)[1:])


_PACKED = {"id": "long", "piece": "int", "start": "long", "length": "long", "ids_crc32": "long",
           "sequence_id": "long", "offset": "long"}


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def op10_pack_sequences(spark, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), tokenizer_path())
