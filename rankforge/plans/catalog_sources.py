"""Registered source/sink queries.

The round-trip queries write the FX-EV log (as nested result rows) to a
fresh folder under the shared checkpoint dir and read it back, so the sink
and the source are checked against the same oracle rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankforge import fixtures as fx
from rankforge.functions.text import shard_key
from rankforge.operators.results import flatten_results
from rankforge.plans.catalog import EV_ENVS
from rankforge.sources import results_log as L

Q: dict = {}


def register(name: str, sql: str | None):
    def deco(fn):
        Q[name] = (fn, sql)
        return fn
    return deco


# ---- fixed values: the chain block the fixture log is read at ----------------------------
CUR_BLOCK = 216_000
TAIL_BLOCKS = 20_000
_LO = (CUR_BLOCK - TAIL_BLOCKS) - ((CUR_BLOCK - TAIL_BLOCKS) % 20)
_HI = CUR_BLOCK - CUR_BLOCK % 20


@register("window_bucket_ev", fx.duck_with("fx_ev") + """
SELECT seq_id, block - (((block % 20) + 20) % 20) AS window FROM fx_ev""")
def window_bucket_ev(spark: SparkSession, sf: str) -> DataFrame:
    return fx.fx_ev(spark, sf).select("seq_id", L.window_bucket("block").alias("window"))


@register("tail_windows_ev", fx.duck_with("fx_ev") + f"""
SELECT block - block % 20 AS window, count(*) AS rows FROM fx_ev
WHERE block - block % 20 BETWEEN {_LO} AND {_HI} GROUP BY 1""")
def tail_windows_ev(spark: SparkSession, sf: str) -> DataFrame:
    e = fx.fx_ev(spark, sf).withColumn("window", L.window_bucket("block"))
    need = L.needed_windows(spark, CUR_BLOCK, TAIL_BLOCKS)
    return e.join(need, "window", "left_semi").groupBy("window").agg(F.count(F.lit(1)).alias("rows"))


def _nested_ev(spark, sf):
    """FX-EV as nested result rows (what the sink receives)."""
    e = fx.fx_ev(spark, sf)
    env = F.when(F.col("seq_id") % 50 == 0, F.lit("bogus")).otherwise(F.col("env"))
    return e.select(
        F.lit("1").alias("version"), F.lit(None).cast("string").alias("signature"),
        F.concat(F.lit("up"), (F.col("participant") % 3).cast("string")).alias("hotkey"),
        F.struct(F.col("participant").cast("int").alias("uid"),
                 F.concat(F.lit("hk-"), F.col("participant").cast("string")).alias("hotkey"),
                 "model", "revision", F.col("block").alias("block")).alias("miner"),
        F.struct(env.alias("env"), F.lit("p").alias("prompt"),
                 F.col("seq_id").cast("string").alias("challenge_id")).alias("challenge"),
        F.struct(F.col("success").alias("success"), F.lit(0.5).alias("latency_seconds")).alias("response"),
        F.struct(env.alias("env"), F.col("score").alias("score")).alias("evaluation"),
        F.struct("ts", "seq_id").alias("seq_key"), "ts", "seq_id", "epoch_day")


@register("shards_roundtrip_ev", fx.duck_with("fx_ev") + """
SELECT seq_id, CASE WHEN seq_id % 50 = 0 THEN 'inactive_env' END AS reason,
       CASE WHEN seq_id % 50 = 0 THEN NULL ELSE participant END AS uid,
       CASE WHEN seq_id % 50 = 0 THEN NULL ELSE score END AS score
FROM fx_ev WHERE success""")
def shards_roundtrip_ev(spark: SparkSession, sf: str) -> DataFrame:
    path = L.scratch_path(spark, "shards")
    n = L.upload_batches(_nested_ev(spark, sf), "hotkey", ["ts", "seq_id"], F.col("epoch_day"))
    L.write_shards(n, path)
    good, bad = L.read_shards(spark, path, envs=EV_ENVS)
    ok = flatten_results(good).select(F.col("challenge_id").cast("bigint").alias("seq_id"),
                                      F.lit(None).cast("string").alias("reason"),
                                      F.col("uid").cast("bigint").alias("uid"), "score")
    b = bad.select(F.get_json_object("item", "$.challenge.challenge_id").cast("bigint").alias("seq_id"),
                   "reason", F.lit(None).cast("bigint").alias("uid"), F.lit(None).cast("double").alias("score"))
    return ok.unionByName(b)


_ORD = fx.duck_with("fx_ev") + """,
o AS (SELECT *, participant % 3 AS up, row_number() OVER (PARTITION BY participant % 3 ORDER BY ts, seq_id) AS ord FROM fx_ev),
s AS (SELECT up, (ord - 1) // 300 AS batch, max(block) AS last, count(*) FILTER (WHERE seq_id % 50 <> 0) AS good
      FROM o WHERE success GROUP BY 1, 2),
k AS (SELECT printf('%09d-up%d-%d.json', last - last % 20, up, batch) AS key, last - last % 20 AS win, batch, good FROM s)
"""


@register("shard_faults_ev", _ORD + f"""
SELECT key, CASE WHEN batch % 5 = 1 THEN 'missing' WHEN batch % 5 = 2 THEN 'corrupt' ELSE 'read' END AS state,
       CASE WHEN batch % 5 IN (1, 2) THEN 0 ELSE good END AS rows
FROM k WHERE win BETWEEN {_LO} AND {_HI}""")
def shard_faults_ev(spark: SparkSession, sf: str) -> DataFrame:
    """A tail read where one shard in five is gone and one in five is cut off."""
    whole, path = L.scratch_path(spark, "shards"), L.scratch_path(spark, "shards-faulty")
    L.write_shards(L.upload_batches(_nested_ev(spark, sf), "hotkey", ["ts", "seq_id"], F.col("epoch_day")), whole)
    with L.few_listing_tasks(spark):
        text = spark.read.text(whole, wholetext=True)
    number = F.regexp_extract("shard", L.SHARD_NAME, 3).cast("bigint") % 5
    text.filter(number != 1).withColumn("value", F.when(number == 2, F.expr("substring(value, 1, length(value) - 9)"))
                                        .otherwise(F.col("value"))).write.partitionBy("shard").text(path)
    index = L.shard_names(spark, whole)
    good, _, faults = L.read_tail_shards(spark, path, index, CUR_BLOCK, TAIL_BLOCKS, envs=EV_ENVS)
    seq = F.col("seq")
    name = F.concat(shard_key(seq["window"], seq["uploader"], seq["upload_ns"]), F.lit(".json"))
    read = good.groupBy(name.alias("key")).agg(F.lit("read").alias("state"), F.count(F.lit(1)).alias("rows"))
    return read.unionByName(faults.select("key", F.col("reason").alias("state"), F.lit(0).cast("bigint").alias("rows")))


@register("index_log_ev", _ORD + f"""
SELECT DISTINCT key, CAST(win AS BIGINT) AS window FROM k WHERE win >= {CUR_BLOCK - TAIL_BLOCKS}""")
def index_log_ev(spark: SparkSession, sf: str) -> DataFrame:
    """The shard index kept by small adds that overlap, then merged and pruned."""
    from rankforge.sources import index_log as I
    n = L.upload_batches(_nested_ev(spark, sf), "hotkey", ["ts", "seq_id"], F.col("epoch_day"))
    ok = n.filter("response.success").groupBy("hotkey", "batch").agg(L.window_bucket(F.max("miner.block")).alias("window"))
    keys = ok.select(F.concat(shard_key(F.col("window"), F.col("hotkey"), F.col("batch")), F.lit(".json")).alias("key"), "batch")
    path = L.scratch_path(spark, "index")
    for part in range(4):
        I.add_keys(spark, path, keys.filter((F.col("batch") % 4 <= part)), most=2)
    I.prune(spark, path, CUR_BLOCK, TAIL_BLOCKS)
    return I.read_index(spark, path).select("key", "window")


@register("log_roundtrip_ev", fx.duck_with("fx_ev") + f"""
SELECT participant, env, count(*) AS rows, sum(score) AS score_sum FROM fx_ev
WHERE success AND block - block % 20 BETWEEN {_LO} AND {_HI} GROUP BY ALL""")
def log_roundtrip_ev(spark: SparkSession, sf: str) -> DataFrame:
    path = L.scratch_path(spark, "log")
    L.write_results(fx.fx_ev(spark, sf), path)
    t = L.read_tail(spark, path, CUR_BLOCK, TAIL_BLOCKS)
    return t.groupBy("participant", "env").agg(F.count(F.lit(1)).alias("rows"),
                                               F.sum("score").alias("score_sum"))


@register("changed_shards_docs", """
WITH o AS (SELECT doc_id AS k, CAST(n_chars % 3 AS BIGINT) AS m FROM documents),
n AS (SELECT doc_id AS k, CAST(quality + toxic AS BIGINT) AS m FROM labels)
SELECT coalesce(o.k, n.k) AS key,
       CASE WHEN o.k IS NULL THEN 'new' WHEN n.k IS NULL THEN 'gone'
            WHEN o.m IS NOT DISTINCT FROM n.m THEN 'unchanged' ELSE 'changed' END AS status
FROM o FULL OUTER JOIN n ON o.k = n.k""")
def changed_shards_docs(spark: SparkSession, sf: str) -> DataFrame:
    old = fx.table(spark, sf, "documents").selectExpr("doc_id AS key", "CAST(n_chars % 3 AS BIGINT) AS modified")
    new = fx.table(spark, sf, "labels").selectExpr("doc_id AS key", "CAST(quality + toxic AS BIGINT) AS modified")
    return L.changed_shards(old, new)


@register("index_add_docs", """
SELECT DISTINCT key FROM (SELECT doc_id AS key FROM documents
                          UNION ALL SELECT doc_id FROM labels)""")
def index_add_docs(spark: SparkSession, sf: str) -> DataFrame:
    idx = fx.table(spark, sf, "documents").selectExpr("doc_id AS key")
    new = fx.table(spark, sf, "labels").selectExpr("doc_id AS key")
    return L.index_add(idx, new)


@register("retention_ev", fx.duck_with("fx_ev") + f"""
SELECT DISTINCT printf('%09d-%s-%d', block - block % 20, env, 0) AS key,
       CASE WHEN block - block % 20 < {CUR_BLOCK - TAIL_BLOCKS} THEN 'drop' ELSE 'keep' END AS action
FROM fx_ev""")
def retention_ev(spark: SparkSession, sf: str) -> DataFrame:
    m = fx.fx_ev(spark, sf).select(L.window_bucket("block").alias("window"), F.col("env").alias("uploader")) \
        .distinct().withColumn("key", shard_key(F.col("window"), F.col("uploader"), F.lit(0)))
    return L.retention(m, CUR_BLOCK, TAIL_BLOCKS).select("key", "action")


@register("dataset_manifest_docs", """
SELECT source AS file, count(*) AS rows FROM documents GROUP BY source""")
def dataset_manifest_docs(spark: SparkSession, sf: str) -> DataFrame:
    d = fx.table(spark, sf, "documents")
    return L.dataset_manifest(d, F.col("source"))


_MB, _BUF, _SEED = 10, 500, 3


def _start(fi, cycle, n):
    return F.pmod(F.lit(_SEED * 31) + fi * 17 + cycle * 7, n - _MB + 1)


@register("chunk_sample_docs", f"""
WITH pf AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
fi AS (SELECT source, n, dense_rank() OVER (ORDER BY source) - 1 AS fi FROM pf),
cyc AS (SELECT greatest(1, CAST(ceil({_BUF} / CAST(sum(least(n, {_MB})) AS DOUBLE)) AS INTEGER)) AS c FROM fi),
ch AS (SELECT fi.source, fi.fi, fi.n, c.cycle, least(fi.n, {_MB}) AS size,
              CASE WHEN fi.n > {_MB} THEN (({_SEED * 31} + fi.fi * 17 + c.cycle * 7) % (fi.n - {_MB} + 1)) ELSE 0 END
              AS start
       FROM fi CROSS JOIN (SELECT unnest(range(0, (SELECT c FROM cyc))) AS cycle) c),
run AS (SELECT *, coalesce(sum(size) OVER (ORDER BY cycle, fi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
              AS before FROM ch),
kept AS (SELECT * FROM run WHERE before < {_BUF}),
r AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS rn FROM documents)
SELECT r.source, r.doc_id, CAST(k.cycle AS INTEGER) AS cycle, CAST(k.before + r.rn - k.start AS BIGINT) AS buffer_pos
FROM r JOIN kept k ON r.source = k.source AND r.rn >= k.start AND r.rn < k.start + k.size""")
def chunk_sample_docs(spark: SparkSession, sf: str) -> DataFrame:
    d = fx.table(spark, sf, "documents").select("doc_id", "source")
    s = L.chunk_sample(d, "source", "doc_id", _start, _MB, _BUF, F.floor(F.col("doc_id") / 1000))
    return s.select("source", "doc_id", "cycle", F.col("buffer_pos").cast("bigint").alias("buffer_pos"))


QUERIES = {k: v[0] for k, v in Q.items()}
ORACLE = {k: v[1] for k, v in Q.items() if v[1] is not None}
