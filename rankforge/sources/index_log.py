"""The shard index as a log of snapshots.

The index is a folder of deltas, each a small sorted Parquet table of new
shard keys, and numbered versions, each a small JSON file that lists the
deltas it consists of with the range of their windows.  An add reads only the
deltas whose range meets that of the new keys, drops the keys that are there,
writes the rest as one delta and publishes the next version by a rename that
fails if another writer was first (then it looks again).  Readers take the
newest version and see an add whole or not at all.

Pruning drops deltas that lie below the floor and notes the floor for the rest:
no file is rewritten.  ``compact`` merges the deltas into one when they are
many.  Files that no version names any more stay for readers of older versions.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Deltas of an index before ``add_keys`` merges them.
MOST_DELTAS = 32
_WINDOW = r"^(\d+)-"


def _files(spark: SparkSession, path: str):
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, jvm.org.apache.hadoop.fs.FileContext.getFileContext(folder.toUri(), conf) \
        if folder.toUri().getScheme() else jvm.org.apache.hadoop.fs.FileContext.getFileContext(conf), folder.getFileSystem(conf)


def snapshot(spark: SparkSession, path: str) -> tuple[int, dict]:
    """(version, manifest) of the newest version; (0, empty) at the start."""
    jvm, _, fs = _files(spark, path)
    folder = jvm.org.apache.hadoop.fs.Path(f"{path}/versions")
    names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
    numbers = [int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0] != "."]
    if not numbers:
        return 0, {"floor": None, "deltas": []}
    last = max(numbers)
    text = spark.read.text(f"{path}/versions/{last:012d}.json", wholetext=True).first()[0]
    return last, json.loads(text)


def publish(spark: SparkSession, path: str, version: int, manifest: dict) -> bool:
    """Make ``manifest`` version number ``version``; False if there is one already."""
    jvm, context, fs = _files(spark, path)
    P = jvm.org.apache.hadoop.fs.Path
    temp, final = P(f"{path}/versions/.{uuid.uuid4().hex}"), P(f"{path}/versions/{version:012d}.json")
    out = fs.create(temp, False)
    out.write(bytearray(json.dumps(manifest).encode()))
    out.close()
    try:
        none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        context.rename(temp, final, none)
        return True
    except Exception as e:  # noqa: BLE001 - py4j wraps the Java exception
        if "FileAlreadyExists" not in str(e) and "already exists" not in str(e):
            raise
        fs.delete(temp, False)
        return False


def _read(spark: SparkSession, path: str, manifest: dict, lo: int | None = None, hi: int | None = None) -> DataFrame:
    meets = [d for d in manifest["deltas"] if (hi is None or d["lo"] <= hi) and (lo is None or d["hi"] >= lo)]
    if not meets:
        return spark.createDataFrame([], "key string, window long")
    rows = spark.read.parquet(*[f"{path}/deltas/{d['name']}" for d in meets])
    return rows if manifest["floor"] is None else rows.filter(F.col("window") >= manifest["floor"])


def read_index(spark: SparkSession, path: str, lo: int | None = None, hi: int | None = None) -> DataFrame:
    """(key, window) of the newest version; with bounds only those windows,
    from the deltas that can hold them."""
    rows = _read(spark, path, snapshot(spark, path)[1], lo, hi)
    if lo is not None:
        rows = rows.filter(F.col("window") >= lo)
    return rows if hi is None else rows.filter(F.col("window") <= hi)


def add_keys(spark: SparkSession, path: str, keys: DataFrame, key: str = "key", most: int = MOST_DELTAS) -> int:
    """Add the keys that aren't there yet; the number of keys added.  Adding the
    same keys again writes nothing."""
    new = keys.select(F.col(key).alias("key"), F.regexp_extract(key, _WINDOW, 1).try_cast("long").alias("window")) \
        .filter("window is not null").distinct()
    while True:
        version, manifest = snapshot(spark, path)
        lo, hi = new.agg(F.min("window"), F.max("window")).first()
        if lo is None:
            return 0
        name = uuid.uuid4().hex
        fresh = new.join(_read(spark, path, manifest, lo, hi).select("key"), "key", "left_anti")
        fresh.sort("key").write.parquet(f"{path}/deltas/{name}")
        n, lo, hi = spark.read.parquet(f"{path}/deltas/{name}").agg(F.count("*"), F.min("window"), F.max("window")).first()
        if not n:
            return 0
        entry = {"name": name, "rows": n, "lo": lo, "hi": hi}
        if publish(spark, path, version + 1, manifest | {"deltas": [*manifest["deltas"], entry]}):
            if len(manifest["deltas"]) + 1 > most:
                compact(spark, path)
            return n


def compact(spark: SparkSession, path: str) -> None:
    """Merge the deltas of the newest version into one sorted delta; gives way
    to another writer."""
    version, manifest = snapshot(spark, path)
    if len(manifest["deltas"]) < 2:
        return
    name = uuid.uuid4().hex
    _read(spark, path, manifest).sort("key").write.parquet(f"{path}/deltas/{name}")
    n, lo, hi = spark.read.parquet(f"{path}/deltas/{name}").agg(F.count("*"), F.min("window"), F.max("window")).first()
    entries = [{"name": name, "rows": n, "lo": lo, "hi": hi}] if n else []
    publish(spark, path, version + 1, manifest | {"deltas": entries})


def prune(spark: SparkSession, path: str, cur: int, tail: int) -> None:
    """Forget the shards whose window starts before ``cur - tail``."""
    while True:
        version, manifest = snapshot(spark, path)
        floor = max(cur - tail, manifest["floor"] if manifest["floor"] is not None else cur - tail)
        kept = [d for d in manifest["deltas"] if d["hi"] >= floor]
        if publish(spark, path, version + 1, {"floor": floor, "deltas": kept}):
            return


