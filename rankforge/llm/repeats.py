"""Repeated windows of a corpus: the part that substring dedup (operator 4)
and suffix-array dedup (operator 2) share.

A document is a row of units (words or bytes).  A window is ``k`` consecutive
units.  Each window has an anchor, the leftmost smallest hash among its
``m``-unit grams; consecutive windows with the same anchor form a chain, and
equal windows always have equal anchors at equal places.  So only chains are
shuffled, about 2 / (k - m + 2) of the units, keyed by their anchor:

* chains with equal content are copies; all but the earliest are repeats, and
  each names an earlier occurrence as its source;
* an anchor whose chains differ is looked at window by window: its distinct
  chains are handed on as ``check`` rows, numbered in parts of ``PART`` chains,
  so an anchor of any size is split.

Chain identity is the anchor's 64-bit hash together with a 64-bit hash of the
whole chain under other codes.  Copies inside one slice of a task, whole
documents or chains, name their source at once and never meet others, which
keeps groups of copies from growing with the number of copies.

Order: by document, then by start.  ``in_order`` names every row by a number
that sorts like the ids, null last.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankforge.llm.shared import cut_lineage, frugal, give_back, mix, numbered, partitions, slices, sliding_argmin, span_hash, unused, utf8, window_hash, with_row_key

#: Stands for a null id, which sorts last.
NULL_ID = (1 << 63) - 1
#: Check rows of one anchor that stay together.
PART = 2048
#: Bytes of text that a block of documents holds on average.
BLOCK_BYTES = 12 << 20
DUP, CHECK = 1, 2
FOUND = "kind int, h long, part int, doc long, start int, n int, sdoc long, sstart int"
_CHAIN = "h long, key long, doc long, start int, n int, sdoc long, sstart int"


def slim(docs: DataFrame, id_col: str, text_col: str, *more) -> DataFrame:
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("doc"),
                       F.col(text_col).cast("string").alias("text"), *more)


def in_order(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame | None]:
    """(slim, ids): ``doc`` names one row and sorts like the ids, null last.
    Where ids are unique they are the names.  Otherwise rows are numbered by id
    and then by their place in the table, and ``ids`` gives the id of a ``doc``."""
    ids = docs.select(F.col(id_col).cast("long").alias("id")).groupBy("id").agg(F.count("*").alias("n"))
    if not ids.where((F.col("n") > 1) | (F.col("id") == NULL_ID)).limit(1).count():
        return slim(docs, id_col, text_col), None
    keyed = with_row_key(docs, unused(docs, "__row"))
    keyed = keyed.select(F.col(keyed.columns[-1]).alias("row"), F.col(id_col).cast("long").alias("id"),
                         F.col(text_col).cast("string").alias("text"))
    names = cut_lineage(numbered(keyed.select("row", "id"), F.col("id").asc_nulls_last(), "row", name="doc"))
    return cut_lineage(keyed.join(names.select("row", "doc"), "row").select("doc", "text")), names.select("doc", "id")


def with_ids(out: DataFrame, ids: DataFrame | None, id_col: str) -> DataFrame:
    """``doc`` as the id it stands for, under its name."""
    if ids is None:
        return out.select(F.when(F.col("doc") != NULL_ID, F.col("doc")).alias(id_col), *out.columns[1:])
    return out.join(ids, "doc").select(F.col("id").alias(id_col), *out.columns[1:])


def _table(schema: str, *arrays) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64()}
    names = [c.split() for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(np.asarray(a).astype(np.int64, copy=False)).cast(kinds[t])
                                       for (_, t), a in zip(names, arrays)], names=[n for n, _ in names])


def chains(units: Callable, k: int, m: int):
    """Task function: documents to chains.  ``units(raw, off)`` gives the
    64-bit codes of all units and the unit offsets of the documents."""
    other = np.uint64(0xA5A5F00DD00F5A5A)

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                ids = part.column(0).to_numpy()
                codes, off = units(*utf8(part.column(1)))
                if len(codes) < k:
                    continue
                size = np.diff(off)
                doc = np.repeat(np.arange(len(ids)), size)
                second = mix(codes ^ other)
                # whole documents that repeat an earlier one of this slice
                name = span_hash(second, off[:-1], off[1:])
                order = np.lexsort((ids, name))
                same = np.zeros(len(ids), dtype=bool)
                same[1:] = name[order][1:] == name[order][:-1]
                lead = np.maximum.accumulate(np.where(same, 0, np.arange(len(ids))))
                first = np.empty(len(ids), dtype=np.int64)
                first[order] = order[lead]
                copy = (ids[first] != ids) & (size >= k)
                whole = np.flatnonzero(copy)
                if len(whole):
                    yield _table(_CHAIN, mix(ids[whole].astype(np.uint64)).view(np.int64), np.zeros(len(whole)),
                                 ids[whole], np.zeros(len(whole)), size[whole] - k + 1, ids[first[whole]],
                                 np.zeros(len(whole)))
                gram = window_hash(codes, m)
                anchor = sliding_argmin(gram, k - m + 1)
                good = (doc[:len(anchor)] == doc[k - 1:k - 1 + len(anchor)]) & ~copy[doc[:len(anchor)]]
                at = np.flatnonzero(good)
                if not len(at):
                    continue
                anchor = anchor[at]
                new = np.ones(len(at), dtype=bool)
                new[1:] = (anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1] + 1)
                head = np.flatnonzero(new)
                n = np.diff(np.append(head, len(at)))
                at, h = at[head], gram[anchor[head]]
                key = span_hash(second, at, at + n + k - 1)
                own, start = ids[doc[at]], at - off[doc[at]]
                yield from _local(h.view(np.int64), key.view(np.int64), own, start, n)
    return run


def _local(h, key, doc, start, n):
    """Name the copies among these rows; the earliest of each goes on."""
    order = np.lexsort((start, doc, key, h))
    h, key, doc, start, n = (x[order] for x in (h, key, doc, start, n))
    same = np.zeros(len(h), dtype=bool)
    same[1:] = (h[1:] == h[:-1]) & (key[1:] == key[:-1])
    lead = np.maximum.accumulate(np.where(same, 0, np.arange(len(h))))
    same &= (doc != doc[lead]) | (start != start[lead])
    yield _table(_CHAIN, np.where(same, mix((h + start).view(np.uint64)).view(np.int64), h), key, doc, start, n,
                 np.where(same, doc[lead], -1), np.where(same, start[lead], -1))


def _resolve(check: bool):
    """Stream over rows sorted by (h, key, doc, start): later equal rows are
    repeats of the first; with ``check`` the distinct rows of an anchor that
    has more than one are handed on.  Only the open group's head is kept."""
    def run(batches):
        last = None                       # h, key, doc, start of the newest distinct row
        head = None                       # first row of the open anchor, while it is alone
        count = 0                         # distinct rows of the open anchor
        for batch in batches:
            col = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(7)]
            done = col[5] >= 0
            if done.any():
                d = [x[done] for x in col]
                z = np.zeros(len(d[0]))
                yield _table(FOUND, z + DUP, d[0], z, d[2], d[3], d[4], d[5], d[6])
            h, key, doc, start, n = (x[~done] for x in col[:5])
            if not len(h):
                continue
            new_h, new_key = np.ones(len(h), dtype=bool), np.ones(len(h), dtype=bool)
            new_h[1:] = h[1:] != h[:-1]
            new_key[1:] = new_h[1:] | (key[1:] != key[:-1])
            if last is not None:
                new_h[0] = h[0] != last[0]
                new_key[0] = new_h[0] or key[0] != last[1]
            lead = np.maximum.accumulate(np.where(new_key, np.arange(len(h)), -1))
            sdoc, sstart = doc[lead], start[lead]            # rows before the first head are set below
            if last is not None:
                sdoc, sstart = np.where(lead < 0, last[2], sdoc), np.where(lead < 0, last[3], sstart)
            dup = np.flatnonzero(~new_key & ((doc != sdoc) | (start != sstart)))
            if len(dup):
                z = np.zeros(len(dup))
                yield _table(FOUND, z + DUP, h[dup], z, doc[dup], start[dup], n[dup], sdoc[dup], sstart[dup])
            if check:
                group = np.cumsum(new_h)                      # 0: the anchor that was open
                ordinal = np.cumsum(new_key)
                firsts = np.flatnonzero(new_h)
                base = np.zeros(group[-1] + 1, dtype=np.int64)
                base[0] = -count
                base[group[firsts]] = ordinal[firsts] - 1
                ordinal = ordinal - 1 - base[group]           # 0, 1, 2 ... within the anchor
                many = np.bincount(group, weights=new_key, minlength=group[-1] + 1).astype(np.int64)
                many[0] += count
                out = np.flatnonzero(new_key & (many[group] > 1))
                if head is not None and not new_h[0] and many[0] > 1:
                    yield _table(FOUND, [CHECK], [head[0]], [0], [head[2]], [head[3]], [head[4]], [-1], [-1])
                    head = None
                if len(out):
                    z = np.zeros(len(out))
                    yield _table(FOUND, z + CHECK, h[out], ordinal[out] // PART, doc[out], start[out], n[out],
                                 z - 1, z - 1)
                count = int(many[-1])
                if len(firsts):
                    i = firsts[-1]
                    head = (h[i], key[i], doc[i], start[i], n[i]) if count == 1 else None
            heads = np.flatnonzero(new_key)
            if len(heads):
                i = heads[-1]
                last = (h[i], key[i], doc[i], start[i])
    return run


def resolve(rows: DataFrame, check: bool) -> DataFrame:
    """Chain or window rows to FOUND rows; one shuffle by ``h``."""
    return rows.repartition("h").sortWithinPartitions("h", "key", "doc", "start").mapInArrow(frugal(_resolve(check)), FOUND)


def find_repeats(docs: DataFrame, units: Callable, k: int, m: int) -> DataFrame:
    """FOUND rows of slim documents, as a reliable checkpoint."""
    return cut_lineage(resolve(docs.mapInArrow(frugal(chains(units, k, m)), _CHAIN), check=True))


def n_blocks(docs: DataFrame, block_bytes: int = BLOCK_BYTES, least: int | None = None) -> int:
    """Blocks of about ``block_bytes`` of text, at least one per shuffle partition
    or ``least``."""
    total = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    return max(1 + total // block_bytes, least or partitions(docs.sparkSession))


def block_of(blocks: int, *by: str):
    return F.pmod(F.xxhash64(*by or ["doc"]), F.lit(blocks)).cast("int").alias("block")


def _pack(batches):
    z = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        raw, off = utf8(batch.column(2))
        view = memoryview(raw)
        out = [z.compress(view[off[i]:off[i + 1]]) for i in range(batch.num_rows)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())],
                                         names=["block", "doc", "z"])


def text_blocks(docs: DataFrame, blocks: int, *by: str) -> DataFrame:
    """(block, doc, compressed text): what a shuffle of whole texts carries.
    Blocks are dealt by the columns ``by``, the document's number if none."""
    return docs.select(block_of(blocks, *by), "doc", "text").mapInArrow(frugal(_pack), "block int, doc long, z binary")


def unpack(table: pa.Table) -> list[bytes]:
    d = zstandard.ZstdDecompressor()
    return [d.decompress(x) for x in table.column("z").to_pylist()]


def with_texts(docs: DataFrame, rows: DataFrame, blocks: int, work: Callable, schema: str) -> DataFrame:
    """``work(ids, texts, columns)`` per block of documents, with the block's
    rows as numpy columns sorted by (doc, start); returns an Arrow table."""
    names = [c for c in rows.columns if c != "block"]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        cols = {c: right.column(c).to_numpy() for c in names}
        order = np.lexsort((cols["start"], cols["doc"]))
        try:
            return work(left.column("doc").to_numpy(), unpack(left), {c: x[order] for c, x in cols.items()})
        finally:
            give_back()

    return text_blocks(docs, blocks).groupBy("block").cogroup(
        rows.select(block_of(blocks), *names).groupBy("block")).applyInArrow(run, schema)


def rows_of(ids: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last place of each id in the sorted ``doc``."""
    return np.searchsorted(doc, ids, side="left"), np.searchsorted(doc, ids, side="right")


def covered(size: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Which of ``size`` units lie in any of the spans."""
    diff = np.zeros(size + 1, dtype=np.int64)
    np.add.at(diff, np.minimum(start, size), 1)
    np.add.at(diff, np.minimum(end, size), -1)
    return np.cumsum(diff[:-1]) > 0
