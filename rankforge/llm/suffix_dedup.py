"""Suffix-array dedup of byte strings by longest previous factors (operator 2).

The longest previous factor (LPF) of a position is the longest string that
starts there and also starts earlier.  In suffix order it is the longer of the
common prefixes with the nearest suffixes above and below that start earlier,
the previous and next smaller positions.  Every position whose LPF reaches
``k`` bytes is removed together with the ``k - 1`` bytes after it, so the
first copy stays and later ones go.

1. Chains of windows that share an anchor are matched by one shuffle (see
   ``repeats``): equal chains are settled, and only anchors whose chains
   differ need suffixes.
2. The bytes of those chains are brought together by (anchor, part).  A task
   concatenates groups of whole parts to buffers of about ``BUFFER`` bytes in
   order of (document, start), builds the suffix order of each buffer by
   doubling ranks, and takes the LPF from the previous and next smaller
   positions.
3. An anchor of more than one part is settled across its parts by the hashes
   of those windows that no part could match, in one more shuffle that
   combines before it moves.  So no anchor, however frequent, meets in one
   task.

Defined results: null and empty texts have no bytes and remove nothing; texts
below ``k`` bytes neither; matches never cross documents; the order is by id,
null last; rows that repeat an id, or have none, are documents of their own, in
the order of the table; an empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankforge.llm import repeats
from rankforge.llm.repeats import CHECK, DUP, NULL_ID, PART
from rankforge.llm.shared import byte_codes, frugal, mix, span_hash, utf8, window_hash

K = 100
GRAM = 16
BUFFER = 1 << 20
_CODES = byte_codes(3)
_CONTEXT = "h long, part int, doc long, start int, n int, body binary"


def byte_units(raw: np.ndarray, off: np.ndarray):
    return _CODES[raw], off


# ---- suffix order and longest previous factors ---------------------------

def rank_ladder(text: np.ndarray, depth: int) -> list[tuple[int, np.ndarray]]:
    """[(length, rank)]: order of all suffixes by their first 8, 16, 32 ...
    and ``depth`` bytes.  ``text`` holds values from 1 up; past its end
    everything sorts first."""
    n = len(text)
    pad = np.zeros(n + 8, dtype=np.uint64)
    pad[:n] = text
    width = 7
    key = np.zeros(n, dtype=np.uint64)
    for i in range(width):                       # 9 bits each: 256 byte values and the end
        key = (key << np.uint64(9)) | pad[i:i + n]
    size, ladder = min(width, depth), []
    if depth < width:
        key >>= np.uint64(9 * (width - depth))
    rank = np.unique(key, return_inverse=True)[1].astype(np.int64) + 1
    ladder.append((size, rank))
    while size < depth:
        step = min(size, depth - size)
        nxt = np.zeros(n, dtype=np.int64)
        nxt[:max(0, n - step)] = rank[step:]     # overlaps when less than a doubling is left
        rank = np.unique(rank * np.int64(n + 1) + nxt, return_inverse=True)[1].astype(np.int64) + 1
        size += step
        ladder.append((size, rank))
    return ladder


def nearest_smaller(x: np.ndarray) -> np.ndarray:
    """Index of the nearest smaller value before each entry, or -1."""
    at = np.arange(len(x)) - 1
    todo = np.flatnonzero(at >= 0)
    todo = todo[x[at[todo]] > x[todo]]
    known = at.copy()
    while len(todo):
        known[todo] = known[known[todo]]         # what is not smaller than us hides nothing smaller
        todo = todo[known[todo] >= 0]
        todo = todo[x[known[todo]] > x[todo]]
    return known


def common_prefix(ladder: list[tuple[int, np.ndarray]], text: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of the suffixes at a and b, at most the
    ladder's depth."""
    depth = ladder[-1][0]
    n, length = len(text), np.zeros(len(a), dtype=np.int64)
    for size, rank in reversed(ladder):
        while True:
            i, j = a + length, b + length
            ok = (i < n) & (j < n) & (length + size <= depth)
            ok[ok] = rank[i[ok]] == rank[j[ok]]
            if not ok.any():
                break
            length[ok] += size
    for _ in range(ladder[0][0]):
        i, j = a + length, b + length
        ok = (i < n) & (j < n) & (length < depth)
        ok[ok] = text[i[ok]] == text[j[ok]]
        if not ok.any():
            break
        length[ok] += 1
    return length


def longest_previous_factor(text: np.ndarray, depth: int, at: np.ndarray | None = None) -> np.ndarray:
    """LPF, at most ``depth``, of the positions ``at`` (ascending; all by
    default) against the earlier ones among them."""
    ladder = rank_ladder(text, depth)
    at = np.arange(len(text)) if at is None else at
    order = np.argsort(ladder[-1][1][at], kind="stable")         # suffix order; equal prefixes by position
    pos = at[order]
    up = nearest_smaller(pos)
    down = len(pos) - 1 - nearest_smaller(pos[::-1])[::-1]
    best = np.zeros(len(pos), dtype=np.int64)
    for other, has in ((up, up >= 0), (down, down < len(pos))):
        who = np.flatnonzero(has)
        best[who] = np.maximum(best[who], common_prefix(ladder, text, pos[who], pos[other[who]]))
    out = np.zeros(len(pos), dtype=np.int64)
    out[order] = best
    return out


# ---- Spark stages ----------------------------------------------------------

def _windows(off: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(context, position) of every window of ``k`` bytes inside a context."""
    n = np.maximum(np.diff(off) - k + 1, 0)
    own = np.repeat(np.arange(len(n)), n)
    return own, np.arange(n.sum()) + np.repeat(off[:-1] - (np.cumsum(n) - n), n)


def _contexts(k: int):
    def work(ids, texts, rows):
        lo, hi = repeats.rows_of(ids, rows["doc"])
        pick, body = [], []
        for i, text in enumerate(texts):
            for r in range(lo[i], hi[i]):
                s = int(rows["start"][r])
                piece = text[s:s + int(rows["n"][r]) + k - 1]
                if len(piece) >= k:
                    pick.append(r)
                    body.append(piece)
        return pa.table({"h": rows["h"][pick], "part": rows["part"][pick], "doc": rows["doc"][pick],
                         "start": rows["start"][pick], "n": rows["n"][pick], "body": pa.array(body, pa.binary())},
                        schema=pa.schema([("h", pa.int64()), ("part", pa.int32()), ("doc", pa.int64()),
                                          ("start", pa.int32()), ("n", pa.int32()), ("body", pa.binary())]))
    return work


def _match(k: int):
    """Rows sorted by (h, part): settle whole parts by LPF."""
    other = np.uint64(0x5BD1E9955BD1E995)

    def settle(table: pa.Table):
        cols = {c: table.column(c).to_numpy() for c in ("h", "part", "doc", "start")}
        order = np.lexsort((cols["start"], cols["doc"]))         # text order is document order
        h, part, doc, start = (cols[c][order] for c in ("h", "part", "doc", "start"))
        raw, off = utf8(table.column("body").take(pa.array(order)))
        large = _oversized(h, part)
        codes = _CODES[raw]
        whole = window_hash(codes, k)

        own, at = _windows(off, k)
        # a window whose hash is alone in this buffer has no long earlier factor here
        seen = np.sort(whole[at])
        twice = seen[1:][seen[1:] == seen[:-1]]
        hit = np.zeros(len(at), dtype=bool)
        if len(twice):
            hit = twice[np.minimum(np.searchsorted(twice, whole[at]), len(twice) - 1)] == whole[at]
        again = np.zeros(len(at), dtype=bool)
        if hit.any():
            # the parts of the contexts that hold such windows, each followed by a mark
            which, shift = own[hit], at[hit] - off[own[hit]]
            first = np.flatnonzero(np.append(True, which[1:] != which[:-1]))
            lo = off[which[first]] + shift[first]
            hi = off[which[first]] + shift[np.append(first[1:], len(which)) - 1] + k
            size = hi - lo
            base = np.cumsum(size + 1) - (size + 1)
            src = np.arange(size.sum()) + np.repeat(lo - (np.cumsum(size) - size), size)
            text = np.zeros(int((size + 1).sum()), dtype=np.uint64)
            text[np.arange(len(src)) + np.repeat(np.arange(len(size)), size)] = raw[src].astype(np.uint64) + np.uint64(1)
            block = np.searchsorted(first, np.arange(len(which)), side="right") - 1
            again[hit] = longest_previous_factor(text, k, base[block] + at[hit] - lo[block]) >= k
        place = start[own] + at - off[own]
        if again.any():
            # rows that repeat an id bring the same window twice: not a repeat of itself
            key = np.lexsort((place, doc[own]))
            twin = np.zeros(len(at), dtype=bool)
            twin[key[1:]] = (doc[own][key[1:]] == doc[own][key[:-1]]) & (place[key[1:]] == place[key[:-1]])
            again &= ~twin
            got = np.flatnonzero(again)                           # runs of neighbouring windows become one row
            head = np.flatnonzero(np.append(True, (own[got][1:] != own[got][:-1]) | (got[1:] != got[:-1] + 1)))
            n, z = np.diff(np.append(head, len(got))), np.zeros(len(head))
            got = got[head]
            yield repeats._table(repeats._CHAIN, mix((place[got] + h[own[got]]).view(np.uint64)).view(np.int64), z,
                                 doc[own[got]], place[got], n, z, z)
        rest = np.flatnonzero(~again & large[own])
        if len(rest):
            p = at[rest]
            yield from repeats._local(whole[p].view(np.int64), span_hash(mix(codes ^ other), p, p + k).view(np.int64),
                                      doc[own[rest]], place[rest], np.ones(len(rest), dtype=np.int64))

    def _oversized(h, part):
        """Rows of an anchor that may have several parts."""
        _, inv, n = np.unique(np.stack([h, part.astype(np.int64)]), axis=1, return_inverse=True, return_counts=True)
        return (part > 0) | (n[inv.ravel()] >= PART)

    def run(batches):
        kept, size = [], 0
        for batch in batches:
            kept.append(batch)
            size += batch.nbytes
            if size < BUFFER:
                continue
            table = pa.Table.from_batches(kept).combine_chunks()
            h, part = table.column("h").to_numpy(), table.column("part").to_numpy()
            cut = np.flatnonzero((h[1:] != h[:-1]) | (part[1:] != part[:-1])) + 1
            at = 0
            _, off = utf8(table.column("body"))
            for c in cut:
                if off[c] - off[at] >= BUFFER or c == cut[-1]:
                    yield from settle(table.slice(at, c - at))
                    at = c
            rest = table.slice(at).combine_chunks()
            kept, size = rest.to_batches(), int(off[-1] - off[at])
        if kept and sum(b.num_rows for b in kept):
            yield from settle(pa.Table.from_batches(kept).combine_chunks())
    return run


def repeated_windows(docs: DataFrame, blocks: int, k: int = K, gram: int = GRAM) -> DataFrame:
    """doc, start, n: the ``n`` windows from ``start`` also start earlier."""
    found = repeats.find_repeats(docs, byte_units, k, gram)
    check = found.where(F.col("kind") == CHECK).select("h", "part", "doc", "start", "n")
    contexts = repeats.with_texts(docs, check, blocks, _contexts(k), _CONTEXT)
    rows = contexts.repartition("h", "part").sortWithinPartitions("h", "part").mapInArrow(frugal(_match(k)), repeats._CHAIN)
    settled = repeats.resolve(rows, check=False)
    return found.where(F.col("kind") == DUP).select("doc", "start", "n").union(settled.select("doc", "start", "n"))


def _remove(k: int, with_text: bool):
    def work(ids, texts, rows):
        lo, hi = repeats.rows_of(ids, rows["doc"])
        out = {"doc": pa.array(ids, pa.int64())}
        n_bytes, n_removed, n_spans, sha, left = [], [], [], [], []
        for i, text in enumerate(texts):
            gone = 0
            spans = 0
            rest = text
            if lo[i] < hi[i]:
                start = rows["start"][lo[i]:hi[i]].astype(np.int64)
                hit = repeats.covered(len(text), start, start + rows["n"][lo[i]:hi[i]] + k - 1)
                gone = int(hit.sum())
                spans = int(hit[:1].sum() + (hit[1:] & ~hit[:-1]).sum())
                rest = np.frombuffer(text, dtype=np.uint8)[~hit].tobytes()
            n_bytes.append(len(text))
            n_removed.append(gone)
            n_spans.append(spans)
            sha.append(hashlib.sha256(rest).hexdigest())
            left.append(rest if with_text else None)
        out |= {"n_bytes": pa.array(n_bytes, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()),
                "n_spans": pa.array(n_spans, pa.int64()), "kept_sha256": pa.array(sha, pa.string())}
        if with_text:
            out["kept"] = pa.array(left, pa.binary())
        return pa.table(out)
    return work


def remove_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, gram: int = GRAM,
                      with_text: bool = False) -> DataFrame:
    """One row per document: id, n_bytes, n_removed, n_spans, kept_sha256 and,
    on demand, the kept bytes (cuts may fall inside a character)."""
    own, ids = repeats.in_order(docs, id_col, text_col)
    blocks = repeats.n_blocks(own)
    rows = repeated_windows(own, blocks, k, gram)
    schema = "doc long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text
    out = repeats.with_texts(own, rows, blocks, _remove(k, with_text), schema)
    return repeats.with_ids(out, ids, id_col)


def op2_suffix_array_dedup(spark, sf_dir: str) -> DataFrame:
    return remove_substrings(spark.read.parquet(f"{sf_dir}/documents.parquet"))
