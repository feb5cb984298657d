"""Language-model scoring with a hierarchical Pitman-Yor model (operator 6).

A text is its words, lower-cased (A-Z), and one end token.  A token's context
is the whole word before it, or the end token at the start of a text.  Every
context has a restaurant of its own, as many as the corpus has words, and all
of them share one parent, the restaurant of all words.  The parent's base is
diffuse: what it serves at a new table is a word that training has not seen, so
the parent's new-table mass is the probability of the unknown word (which word
it is isn't scored, as in the base score), and each of its dishes has one
table, which is the only seating such a base allows.  For every context the
probabilities of all known words, the end and the unknown word sum to one.

1. Texts are dealt into blocks.  A block reports its distinct (word, context)
   pairs with their counts in training documents: this is what is gathered from
   the corpus, and it grows with it.
2. Pairs lie on a grid: a cell holds the pairs of a range of words and a range
   of contexts, so neither a hot word nor a hot context meets in one task, and
   a hot pair costs one entry a block.  A cell sums the reports of the blocks.
3. Seating is sampled by Gibbs sweeps.  In a sweep a cell reseats the customers
   of its dishes, given the tables of each context's restaurant and the
   parent's prediction of each word.  Both are sums over a column or a row of
   the grid: every cell sends its shares to the column and to the row, which
   add them up and send the totals back.  No table of all words or contexts
   is held anywhere.
4. Every pair is predicted under the sample of each sweep that counts, and
   these predictive probabilities are averaged over the sweeps.
5. The averages go back to the blocks that reported the pairs, where whole
   texts are scored.

Departures: totals are those of the sweep before while a sweep runs, and
customers of one dish are reseated in steps that grow with the number already
seated (an eighth, one by one up to eight), which keeps a sweep linear in the
number of dishes.  A block holds about ``BLOCK_BYTES`` of text; one longer text
is one block, with some 80 bytes of memory a token.

Defined results: null and empty texts are the end alone; the id's text decides
whether a document is held out, a null id counts as the empty text; without
training documents only the unknown word has a probability, one; rows that
repeat an id are separate documents; an empty table gives an empty result;
other columns are not read.  Draws depend on sorted pairs and the size of the
grid only, so reruns agree.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankforge.llm import repeats
from rankforge.llm.repeats import NULL_ID
from rankforge.llm.shared import byte_codes, cut_lineage, give_back, mix, partitions, span_hash, sweep, utf8, word_bounds

BLOCK_BYTES = 24 << 20
STRENGTH = 1.0
BURN_IN, KEPT_SWEEPS = 1, 2
SEED = 11
_CODES = byte_codes(5)
#: Key of the end token among words; it also is the context of a text's start.
END_KEY = np.uint64(0)
_SLICE = 1 << 20


def held_out(doc: int) -> bool:
    """Whether a document is scored only, by the CRC-32 of its id's text."""
    return zlib.crc32(b"" if doc == NULL_ID else str(doc).encode()) % 5 == 1


# ---- texts -----------------------------------------------------------------

def tokens(raw: np.ndarray, off: np.ndarray):
    """(document, word key) of all tokens in text order, the end of each
    document included."""
    n = len(off) - 1
    raw = raw + np.where((raw >= 65) & (raw <= 90), 32, 0).astype(np.uint8)
    start, end, doc = word_bounds(raw, off)
    word = mix(span_hash(_CODES[raw], start, end)) | np.uint64(1)
    own = np.concatenate([doc, np.arange(n)])
    order = np.argsort(own, kind="stable")
    return own[order].astype(np.int32), np.concatenate([word, np.full(n, END_KEY)])[order]


def _slices(texts: list[bytes]):
    """(first, raw, off) of about a megabyte of documents each."""
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) <= _SLICE):
            size += len(texts[end])
            end += 1
        raw, off = utf8(pa.array(texts[at:end], pa.binary()))
        yield at, raw, off
        at = end


def along(keys: np.ndarray, n: int) -> np.ndarray:
    """Place of sorted or unsorted keys on a side of ``n`` cells, by range."""
    return (((keys >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)).astype(np.int64)


class Block:
    """Tokens of some documents and their distinct pairs, ordered by (cell,
    word, context).  Words and contexts are places in the sorted ``keys``."""

    def __init__(self, texts: list[bytes], side: int):
        parts = [(first, *tokens(raw, off)) for first, raw, off in _slices(texts)]
        self.doc = np.concatenate([doc + first for first, doc, _ in parts])
        self.keys, word = np.unique(np.concatenate([w for *_, w in parts]), return_inverse=True)
        del parts
        self.word = word.astype(np.int32)
        code = word * len(self.keys)
        code[1:] += word[:-1]              # every document ends with the end token, which has place 0
        del word
        pairs, pair = np.unique(code, return_inverse=True)
        w, c = pairs // len(self.keys), pairs % len(self.keys)
        place = along(self.keys, side)
        cell = place[w] * side + place[c]
        order = np.argsort(cell, kind="stable")
        to = np.empty(len(order), dtype=np.int32)
        to[order] = np.arange(len(order))
        self.pair = to[pair]               # of each token
        self.w, self.c, cell = w[order], c[order], cell[order]
        head = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
        self.cells, self.cut = cell[head], np.append(head, len(cell))

    def counts(self, held: np.ndarray) -> np.ndarray:
        return np.bincount(self.pair[~held[self.doc]], minlength=len(self.w))


def _pack(*arrays) -> bytes:
    """Arrays by planes of their bytes, compressed."""
    z = zstandard.ZstdCompressor(level=1)
    parts = [z.compress(np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.itemsize).T.tobytes()) for a in arrays]
    return np.array([len(p) for p in parts], dtype="<i8").tobytes() + b"".join(parts)


def _unpack(body: bytes, *kinds) -> list[np.ndarray]:
    size, at, out = np.frombuffer(body[:8 * len(kinds)], dtype="<i8"), 8 * len(kinds), []
    d = zstandard.ZstdDecompressor()
    for n, kind in zip(size.tolist(), kinds):
        planes = np.frombuffer(d.decompress(body[at:at + n]), dtype=np.uint8).reshape(np.dtype(kind).itemsize, -1)
        out.append(np.ascontiguousarray(planes.T).view(kind).ravel())
        at += n
    return out


def _heads(x: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.append(True, x[1:] != x[:-1]))


def _steps(x: np.ndarray) -> np.ndarray:
    """Differences of sorted keys or places."""
    return np.diff(x, prepend=x.dtype.type(0))


def _climb(steps: np.ndarray) -> np.ndarray:
    return np.cumsum(steps, dtype=np.uint64 if steps.itemsize == 8 else np.int64)


#: What cells, columns and rows of the grid send each other: ``seat`` is the
#: receiver, ``back`` the cell or block that an answer goes to.
_MAIL = "seat int, kind int, back int, body binary, s0 double, s1 double, s2 double, s3 double, s4 double"
PAIRS, STATE, TOTALS, PLACES, LINKS, SHARES, STATS = range(7)
#: Receivers: cells are named by their number, rows and columns of the grid below zero.
_ROW, _COLUMN = 0, 1


def _mail(rows: list[tuple]) -> pa.Table:
    cols = list(zip(*[r + (0.0,) * (9 - len(r)) for r in rows])) or [()] * 9
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), *[pa.float64()] * 5]
    return pa.table([pa.array(c, k) for c, k in zip(cols, kinds)], names=[x.split()[0] for x in _MAIL.split(", ")])


def _report(side: int):
    """A letter to each cell that a block has pairs of."""
    def work(table: pa.Table) -> pa.Table:
        ids = table.column("doc").to_numpy()
        block = Block(repeats.unpack(table), side)
        n = block.counts(np.array([held_out(int(i)) for i in ids], dtype=bool))
        number, rows = table.column("block")[0].as_py(), []
        for cell, a, b in zip(block.cells.tolist(), block.cut[:-1], block.cut[1:]):
            head = _heads(block.w[a:b])
            own, at = np.unique(block.c[a:b], return_inverse=True)
            rows.append((cell, PAIRS, number, _pack(
                _steps(block.keys[block.w[a:b][head]]), np.diff(np.append(head, b - a)).astype("<u4"),
                _steps(block.keys[own]), at.astype("<u4"), n[a:b].astype("<u4"))))
        give_back()
        return _mail(rows)
    return work


# ---- restaurants -----------------------------------------------------------

def seat(customers: np.ndarray, mass: np.ndarray, discount: float, rng) -> np.ndarray:
    """Tables of each dish after reseating its customers with the new-table
    mass ``(strength + discount * tables) * parent``; none without customers."""
    out = (customers > 0).astype(np.float64)
    many = np.flatnonzero(customers > 1)
    many = many[np.argsort(-customers[many], kind="stable")]
    c, b, t = customers[many], mass[many], np.ones(len(many))
    seated, live = 1, len(many)
    while live:
        step = max(1, seated >> 3)
        m = np.minimum(step, c[:live] - seated).astype(np.int64)
        p = b[:live] / (b[:live] + seated - discount * t[:live])
        t[:live] += rng.binomial(m, p)
        seated += step
        live = int(np.searchsorted(-c[:live], -seated, side="left"))
    out[many] = t
    return out


class Cell:
    """Distinct pairs of a range of words and a range of contexts: ``w`` and
    ``c`` are places among the cell's own words and contexts."""

    def __init__(self, w, c, n):
        self.w, self.c, self.n = w, c, n.astype(np.float64)
        self.words, self.contexts = int(w.max()) + 1, int(c.max()) + 1

    def start(self) -> np.ndarray:
        return (self.n > 0).astype(np.float64)

    def shares(self, tables) -> tuple:
        """(tables, customers) of the words, then of the contexts."""
        return tuple(np.bincount(at, weights=x, minlength=size) for at, size in
                     ((self.w, self.words), (self.c, self.contexts)) for x in (tables, self.n))

    def parent(self, model: dict, word_tables) -> np.ndarray:
        """The parent's prediction of each pair's word; the unknown word's
        where training has none of it."""
        known = np.where(word_tables > 0, word_tables - model["d0"], STRENGTH + model["d0"] * model["words"])
        return (known / (STRENGTH + model["tables"]))[self.w]

    def mass(self, model: dict, context_tables, p0) -> np.ndarray:
        return (STRENGTH + model["d1"] * context_tables)[self.c] * p0

    def predict(self, model: dict, tables, word_tables, context_tables, context_guests) -> np.ndarray:
        mass = self.mass(model, context_tables, self.parent(model, word_tables))
        return (self.n - model["d1"] * tables + mass) / (STRENGTH + context_guests)[self.c]

    def reseat(self, model: dict, word_tables, context_tables, rng) -> np.ndarray:
        return seat(self.n, self.mass(model, context_tables, self.parent(model, word_tables)), model["d1"], rng)


def discount(n1: float, n2: float) -> float:
    return min(max(n1 / max(1.0, n1 + 2 * n2), 0.05), 0.95)


def _letters(table: pa.Table) -> dict:
    out: dict = {}
    for kind, back, body in zip(*(table.column(i).to_pylist() for i in (1, 2, 3))):
        out.setdefault(kind, []).append((back, body))
    return {k: sorted(v, key=lambda x: x[0]) for k, v in out.items()}


def _shares(cell_no: int, side: int, cell: Cell, tables) -> list[tuple]:
    got = [x.astype("<f4" if i % 2 == 0 else "<f8") for i, x in enumerate(cell.shares(tables))]
    row, column = -1 - cell_no // side, -1 - side - cell_no % side
    return [(row, SHARES, cell_no, _pack(*got[:2])), (column, SHARES, cell_no, _pack(*got[2:]))]


def _found(side: int):
    """Sum the reports of a cell and seat every dish at one table."""
    def work(table: pa.Table) -> pa.Table:
        number = table.column("seat")[0].as_py()
        blocks, words, sizes, contexts, at, n = [], [], [], [], [], []
        for back, body in _letters(table)[PAIRS]:
            step, size, cstep, c, count = _unpack(body, "<u8", "<u4", "<u8", "<u4", "<u4")
            blocks.append(back)
            words.append(_climb(step))
            contexts.append(_climb(cstep))
            sizes.append(size)
            at.append(c)
            n.append(count)
        every_word, wi = np.unique(np.concatenate(words), return_inverse=True)
        every_ctx, ci = np.unique(np.concatenate(contexts), return_inverse=True)
        w = np.repeat(wi, np.concatenate(sizes))
        first = np.cumsum([0] + [len(x) for x in contexts[:-1]])
        c = ci[np.concatenate([x.astype(np.int64) + f for x, f in zip(at, first)])]
        pairs, place = np.unique(w * len(every_ctx) + c, return_inverse=True)
        total = np.bincount(place, weights=np.concatenate(n))
        cell = Cell(pairs // len(every_ctx), pairs % len(every_ctx), total)
        tables = cell.start()
        size = np.bincount(cell.w, minlength=cell.words)
        rows = [(number, PAIRS, 0, _pack(size.astype("<u4"), cell.c.astype("<u4"), total.astype("<u4")),
                 float((total == 1).sum()), float((total == 2).sum())),
                (number, STATE, 0, _pack(tables.astype("<u4"))),
                (-1 - number // side, LINKS, number, _pack(_steps(every_word))),
                (-1 - side - number % side, LINKS, number, _pack(_steps(every_ctx)))]
        a = b = 0
        for block, size, own in zip(blocks, sizes, words):
            k = int(size.sum())
            rows.append((number, PLACES, block, _pack(_steps(place[a:a + k]).astype("<u4"), _steps(wi[b:b + len(own)]).astype("<u4"))))
            a, b = a + k, b + len(own)
        rows += _shares(number, side, cell, tables)
        give_back()
        return _mail(rows)
    return work


def _linked(table: pa.Table) -> pa.Table:
    """Place of each cell's words or contexts among those of its row or column."""
    line = table.column("seat")[0].as_py()
    cells = [(cell, _climb(_unpack(body, "<u8")[0])) for cell, body in _letters(table)[LINKS]]
    at = np.unique(np.concatenate([k for _, k in cells]), return_inverse=True)[1]
    cut = np.cumsum([len(k) for _, k in cells])[:-1]
    return _mail([(line, LINKS, cell, _pack(_steps(x).astype("<u4"))) for (cell, _), x in zip(cells, np.split(at, cut))])


def _totals(side: int, sample: int):
    """Add up the shares of a row or column; each cell gets its totals."""
    def work(table: pa.Table) -> pa.Table:
        line, got = table.column("seat")[0].as_py(), _letters(table)
        at = [_climb(_unpack(body, "<u4")[0]) for _, body in got[LINKS]]
        shares = [_unpack(body, "<f4", "<f8") for _, body in got[SHARES]]       # in the order of the links
        every = np.concatenate(at)
        tables, guests = (np.bincount(every, weights=np.concatenate([x[i] for x in shares])) for i in (0, 1))
        rows = [(cell, TOTALS, 2 * sample + (_ROW if line >= -side else _COLUMN),
                 _pack(tables[x].astype("<f4"), guests[x].astype("<f8"))) for (cell, _), x in zip(got[LINKS], at)]
        if line >= -side:
            rows.append((0, STATS, 0, None, float(tables.sum()), float((guests > 0).sum()), float(guests.sum()),
                         float((tables == 1).sum()), float((tables == 2).sum())))
        give_back()
        return _mail(rows)
    return work


def _cell(got: dict) -> Cell:
    size, c, n = _unpack(got[PAIRS][0][1], "<u4", "<u4", "<u4")
    return Cell(np.repeat(np.arange(len(size)), size), c.astype(np.int64), n)


def _samples(got: dict) -> list[tuple]:
    """(tables, word tables, word customers, context tables, context
    customers) of each sample, in order; totals come by row and by column."""
    out = []
    for i, (_, body) in enumerate(got[STATE]):
        rows, columns = (_unpack(got[TOTALS][2 * i + line][1], "<f4", "<f8") for line in (_ROW, _COLUMN))
        out.append((_unpack(body, "<u4")[0].astype(np.float64), rows[0].astype(np.float64), rows[1],
                    columns[0].astype(np.float64), columns[1]))
    return out


def _sweep(side: int, model: dict, number: int):
    """One Gibbs sweep over a cell."""
    def work(table: pa.Table) -> pa.Table:
        name, got = table.column("seat")[0].as_py(), _letters(table)
        cell, (_, word_tables, _, context_tables, _) = _cell(got), _samples(got)[0]
        tables = cell.reseat(model, word_tables, context_tables, np.random.default_rng([SEED, number, name]))
        rows = [(name, STATE, number + 1, _pack(tables.astype("<u4"))), *_shares(name, side, cell, tables)]
        give_back()
        return _mail(rows)
    return work


def _answers(models: list[dict]):
    """Predictions averaged over the samples, for each block."""
    def work(table: pa.Table) -> pa.Table:
        name, got = table.column("seat")[0].as_py(), _letters(table)
        cell, total = _cell(got), 0.0
        for model, (tables, word_tables, guests, *contexts) in zip(models, _samples(got)):
            total = total + cell.predict(model, tables, word_tables, *contexts)
        lp = np.log10(total / len(models)).astype("<f4")
        rows = []
        for block, body in got[PLACES]:
            pair, word = (_climb(x) for x in _unpack(body, "<u4", "<u4"))
            rows.append((block, STATE, name, _pack(lp[pair], guests[word].astype("<u8"))))
        give_back()
        return _mail(rows)
    return work


def train(reports: DataFrame, side: int, burn_in: int = BURN_IN, kept: int = KEPT_SWEEPS):
    """(answers, training tokens, distinct training words) for the reports of
    all blocks to a grid of ``side`` times ``side`` cells."""
    spark = reports.sparkSession
    by_seat = lambda letters, work: letters.groupBy("seat").applyInArrow(work, _MAIL)
    of = lambda letters, *kinds: letters.where(F.col("kind").isin(*kinds))
    found = cut_lineage(by_seat(reports, _found(side)))
    links = cut_lineage(by_seat(of(found, LINKS), _linked))
    ones = of(found, PAIRS).agg(F.sum("s0"), F.sum("s1")).first()
    model: dict = {"d1": discount(ones[0] or 0.0, ones[1] or 0.0)}
    state, models, kept_mail = found, [], of(found, PAIRS, PLACES)
    for number in range(burn_in + kept + 1):                  # sample 0 has one table a dish
        totals = cut_lineage(by_seat(links.union(of(state, SHARES)), _totals(side, number)))
        sweep(spark)
        t, words, total, n1, n2 = (x or 0.0 for x in of(totals, STATS).agg(*[F.sum(f"s{i}") for i in range(5)]).first())
        model = {"d0": discount(n1, n2), **model, "tables": t, "words": words}
        mail = of(state, STATE).union(of(totals, TOTALS))
        if number > burn_in:
            models.append(model)
            kept_mail = kept_mail.union(mail)
        if number < burn_in + kept:
            state = cut_lineage(by_seat(of(found, PAIRS).union(mail), _sweep(side, model, number)))
    answers = by_seat(kept_mail, _answers(models))
    return answers.select(F.col("seat").alias("block"), F.col("back").alias("cell"), "body"), int(total), int(words)


# ---- scores ----------------------------------------------------------------

def _score(side: int, total: int, distinct: int):
    names = {"doc": pa.int64(), "held_out": pa.bool_(), "n_tokens": pa.int64(), "n_known": pa.int64(),
             "base_score": pa.float64(), "score": pa.float64()}
    floor = math.log10(total + 0.5 * (distinct + 1))

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        ids = left.column("doc").to_numpy()
        if not len(ids):
            return pa.table([pa.array([], t) for t in names.values()], names=list(names))
        block = Block(repeats.unpack(left), side)                     # the pairs in the order of the report
        lp, count = np.zeros(len(block.w)), np.zeros(len(block.keys))
        bodies = dict(zip(right.column("cell").to_pylist(), right.column("body").to_pylist()))
        for cell, a, b in zip(block.cells.tolist(), block.cut[:-1], block.cut[1:]):
            p, n = _unpack(bodies[cell], "<f4", "<u8")
            lp[a:b] = p
            count[block.w[a:b][_heads(block.w[a:b])]] = n
        c = count[block.word]
        add = lambda x: np.bincount(block.doc, weights=x, minlength=len(ids))
        out = (ids, [held_out(int(i)) for i in ids], np.bincount(block.doc, minlength=len(ids)), add(c > 0).astype(np.int64),
               add(np.log10(c + 0.5) - floor), add(lp[block.pair]))
        give_back()
        return pa.table([pa.array(x, t) for x, t in zip(out, names.values())], names=list(names))
    return work


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES,
                **options) -> DataFrame:
    """One row per document: id, held_out, n_tokens, n_known, train_tokens,
    base_score, score (log10 probabilities)."""
    own = repeats.slim(docs, id_col, text_col)
    blocks = repeats.n_blocks(own, block_bytes, least=1)
    side = math.ceil(math.sqrt(max(blocks, partitions(docs.sparkSession))))
    text = repeats.text_blocks(own, blocks, "doc", "text")         # rows without an id are spread, too
    reports = text.groupBy("block").applyInArrow(_report(side), _MAIL)       # read once, so not written
    answers, total, distinct = train(reports, side, **options)
    out = text.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        _score(side, total, distinct),
        "doc long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return out.select(F.when(F.col("doc") != NULL_ID, F.col("doc")).alias(id_col), "held_out", "n_tokens", "n_known",
                      F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")


def op6_pitman_yor_scores(spark, sf_dir: str) -> DataFrame:
    return score_texts(spark.read.parquet(f"{sf_dir}/documents.parquet"))
