"""Helpers shared by the corpus operators: reliable checkpoints and
vectorised scanning of UTF-8 text columns inside Arrow batches."""

from __future__ import annotations

import ctypes
import gc

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rankforge.session import ensure_checkpoint_dir

#: Bytes of text handled at once inside a task; bounds the numpy temporaries.
SLICE_BYTES = 1 << 19

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)          # odd, so it has an inverse modulo 2^64
_BASE_INV = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def cut_lineage(df: DataFrame, parts: int | None = None) -> DataFrame:
    """Reliable checkpoint in the folder named by ``spark.checkpoint.dir``;
    ``parts`` bounds the number of its partitions for tables of bounded size."""
    ensure_checkpoint_dir(df.sparkSession)
    return (df.coalesce(parts) if parts else df).checkpoint(eager=True)


def sweep(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files and, where it is set to, the
    checkpoints that nothing refers to any more.  It does so when the driver's
    garbage is collected, which small jobs in a row may never cause."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def unused(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have, whatever its case."""
    there = {c.lower() for c in df.columns}
    while name.lower() in there:
        name += "_"
    return name


def with_row_key(docs: DataFrame, name: str = "__row") -> DataFrame:
    """Add a key of the rows, a string, that stays the same whenever the table
    is read again, however its files are split: a row of a file is named by the
    file and its place there.  Anything but a plain scan of Parquet files is
    written first and its rows are named by their place in that."""
    plan = docs._jdf.queryExecution().optimizedPlan()
    if plan.getClass().getSimpleName() == "LogicalRelation" and plan.relation().getClass().getSimpleName() == "HadoopFsRelation" \
            and plan.relation().fileFormat().getClass().getSimpleName() == "ParquetFileFormat":
        place = docs.metadataColumn("_metadata")
        return docs.withColumn(name, F.concat(F.md5(place["file_path"]), F.lit(":"), F.lpad(place["row_index"].cast("string"), 12, "0")))
    return cut_lineage(docs).withColumn(name, F.lpad(F.monotonically_increasing_id().cast("string"), 20, "0"))


def numbered(df: DataFrame, *order, name: str = "number") -> DataFrame:
    """Number the rows from 0 in ``order``: sorted by range, a row's number is
    its place in its partition plus the rows of the partitions before."""
    best = cut_lineage(df.orderBy(*order)).withColumn("__at", F.monotonically_increasing_id()) \
        .withColumn("__part", F.shiftright("__at", 33))
    per_part = best.groupBy("__part").agg(F.count("*").alias("__n"))              # one row per partition
    before = F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = per_part.select("__part", F.coalesce(before, F.lit(0)).alias("__before"))
    return best.join(F.broadcast(offsets), "__part") \
        .withColumn(name, F.col("__before") + F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))).drop("__at", "__part", "__before")


def give_back() -> None:
    """Return freed memory of this worker to the system.  Workers live on
    between stages, and what the allocators keep counts against the
    executor."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass                                   # not glibc: nothing to trim


_kept: dict = {}


def keep(key, build):
    """An object that is costly to build, kept by this worker until another
    one is asked for."""
    if key not in _kept:
        _kept.clear()
        give_back()
        _kept[key] = build()
    return _kept[key]


def let_go() -> None:
    """Give up what ``keep`` holds.  Workers live on between operators, and an
    object that the operator before kept counts against the executor."""
    if _kept:
        _kept.clear()
        give_back()


def frugal_groups(fn):
    """Wrap a task function over two cogrouped tables: nothing kept by another
    operator stays, and memory is given back after every group."""
    def run(left, right):
        let_go()
        try:
            return fn(left, right)
        finally:
            give_back()
    return run


def frugal(fn):
    """Wrap a task function over batches: give memory back when it ends."""
    def run(batches):
        try:
            yield from fn(batches)
        finally:
            give_back()
    return run


def small(df: DataFrame, most: int = 10_000) -> DataFrame:
    """Mark a table for broadcast if it has at most ``most`` rows; a larger
    one is left to be joined by shuffle."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_of(col: str) -> Column:
    """The text column with null read as the empty text."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary Arrow column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    large = pa.large_binary()
    if column.type != large:
        column = column.cast(pa.binary() if pa.types.is_string(column.type) else column.type).cast(large)
    if column.null_count:
        column = column.fill_null(b"")
    _, off, data = column.buffers()
    off = np.frombuffer(off, dtype=np.int64)[column.offset:column.offset + len(column) + 1] if len(column) \
        else np.zeros(1, dtype=np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES):
    """Row slices of a batch holding about ``limit`` bytes of ``column`` each
    (a longer single text forms its own slice)."""
    _, off = utf8(batch.column(batch.schema.get_field_index(column)))
    at, n = 0, batch.num_rows
    while at < n:
        end = int(np.searchsorted(off, off[at] + limit, side="right")) - 1
        end = min(n, max(at + 1, end))
        yield batch.slice(at, end - at)
        at = end


def word_bounds(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, document) of every maximal run of bytes other than
    0x20 and 0x09-0x0D, never crossing a document's end."""
    if not len(data):
        z = np.zeros(0, dtype=np.int64)
        return z, z, z
    word = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[off] = True
    before = np.empty_like(word)
    before[0] = False
    before[1:] = word[:-1]
    start = np.flatnonzero(word & (~before | edge[:-1]))
    after = np.empty_like(word)
    after[-1] = False
    after[:-1] = word[1:]
    end = np.flatnonzero(word & (~after | edge[1:])) + 1
    doc = np.searchsorted(off, start, side="right") - 1
    return start, end, doc


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """(base^i, base^-i) modulo 2^64 for i up to n, kept per worker."""
    size = 1 << max(16, int(n).bit_length())
    if size not in _powers:
        _powers.clear()
        up = np.full(size, _BASE, dtype=_U)
        up[0] = 1
        down = np.full(size, _BASE_INV, dtype=_U)
        down[0] = 1
        _powers[size] = (np.cumprod(up), np.cumprod(down))
    return _powers[size]


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (xor-shift and multiply), bijective; arrays only."""
    x = x ^ (x >> _U(33))
    x *= _U(0xFF51AFD7ED558CCD)
    x ^= x >> _U(33)
    x *= _U(0xC4CEB9FE1A85EC53)
    x ^= x >> _U(33)
    return x


def byte_codes(seed: int) -> np.ndarray:
    return mix(np.arange(1, 257, dtype=_U) * _U(0xD6E8FEB86659FD93) + _U(seed))


def span_hash(codes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of every span ``codes[start:end]`` of 64-bit codes; the position
    of a span doesn't matter, its content and length do."""
    up, down = powers(len(codes) + 1)
    total = np.zeros(len(codes) + 1, dtype=_U)
    np.cumsum(codes * up[:len(codes)], out=total[1:])
    got = (total[end] - total[start]) * down[start]
    return mix(got + (end - start).astype(_U) * _U(0x9FB21C651E98DF25))


def window_hash(codes: np.ndarray, width: int) -> np.ndarray:
    """``span_hash`` of every window of ``width`` consecutive codes."""
    n = len(codes) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=_U)
    up, down = powers(len(codes) + 1)
    total = np.zeros(len(codes) + 1, dtype=_U)
    np.cumsum(codes * up[:len(codes)], out=total[1:])
    got = total[width:] - total[:n]
    got *= down[:n]
    got += _U(width * 0x9FB21C651E98DF25 & (1 << 64) - 1)
    return mix(got)


def sliding_argmin(x: np.ndarray, width: int) -> np.ndarray:
    """Index of the smallest value in every window of ``width``, the leftmost
    of equal ones.  Values count by their high 40 bits; the low bits carry the
    index through the minima."""
    n = len(x) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    low = _U((1 << max(24, int(len(x)).bit_length())) - 1)
    val = (x & ~low) | np.arange(len(x), dtype=_U)
    size = 1
    while size * 2 <= width:
        val = np.minimum(val[:-size], val[size:])
        size *= 2
    rest = width - size
    if rest:
        val = np.minimum(val[:len(val) - rest], val[rest:])
    return (val[:n] & low).astype(np.int64)
