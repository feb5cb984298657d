"""Fixture views over the driver's parquet tables (see FIXTURES.md).

Each ``fx_*`` returns a lazy DataFrame; nothing is collected.  The matching
DuckDB text for the oracle lives next to it in ``DUCK`` so both engines see
the same rows.  Every view reads whole tables: no sampling, no id ranges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# FX-OR: participant = nation of the customer, env = order priority.
def fx_or(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return (o.join(c, o.o_custkey == c.c_custkey)
            .selectExpr(
                "CAST(c_nationkey AS BIGINT) AS participant",
                "o_orderpriority AS env",
                "o_orderdate AS ts",
                "o_orderkey AS seq_id",
                "(o_orderkey % 10 <> 0) AS success",
                "CAST(CASE WHEN (o_orderkey*7919 + o_custkey) % 100 < 30 + 2*c_nationkey "
                "THEN 1 ELSE 0 END AS DOUBLE) AS score"))


# FX-LI: participant = supplier, env = returnflag||linestatus (6 envs).
def fx_li(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_suppkey AS participant",
        "concat(l_returnflag, l_linestatus) AS env",
        "CAST(CASE WHEN l_quantity > 25 - (l_suppkey % 10) THEN 1 ELSE 0 END AS DOUBLE) AS score")


def fx_li_attrs(df: DataFrame) -> DataFrame:
    """Per-participant attributes the FX-LI fixture defines by rule."""
    return df.select("participant").distinct().selectExpr(
        "participant",
        "CAST(1000 + (participant*37) % 500 AS BIGINT) AS first_block",
        "(participant % 7 <> 0) AS queryable")


# FX-EV: versions, families, null commit blocks.
def fx_ev(spark: SparkSession, sf_dir: str) -> DataFrame:
    evt = table(spark, sf_dir, "events").selectExpr(
        "event_id AS seq_id", "ts", "user_id AS participant", "event_type AS env", "value",
        "CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k",
        "timestampdiff(SECOND, TIMESTAMP_NTZ'2024-01-01 00:00:00', ts) AS sec",
        "day(ts) AS d", "unix_date(to_date(ts)) AS epoch_day")
    return evt.selectExpr(
        "seq_id", "ts", "participant", "env",
        "concat('org', CAST(participant % 7 AS STRING), '/', "
        "CASE WHEN participant % 5 = 0 THEN 'Other' ELSE 'Core' END, '-', "
        "CAST(participant % 3 AS STRING)) AS model",
        "concat('r', CAST(((d + participant) div 10) % 2 AS STRING)) AS revision",
        "CASE WHEN participant % 11 = 0 THEN NULL "
        "ELSE (participant*37) % 1000 + 1000*((d + participant) div 10) END AS commit_block",
        "sec div 12 AS block", "(k % 10 <> 0) AS success", "(k % 5) / CAST(4 AS DOUBLE) AS score", "d", "epoch_day")


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Participant registry (uid, hotkey): one row per supplier; uid 0 is the base."""
    return table(spark, sf_dir, "supplier").selectExpr(
        "CAST(s_suppkey AS BIGINT) AS uid", "s_name AS hotkey")


# FX-DOC: claims (uid = doc_id, block = n_chars, null every 13th).
def fx_doc_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").selectExpr(
        "doc_id AS uid",
        "CASE WHEN doc_id % 13 = 0 THEN NULL ELSE n_chars END AS block",
        "concat(lang, '/', source) AS model",
        "array_distinct(transform(split(text, '\\n', -1), x -> sha2(x, 256))) AS hashes")


# FX-CONV: episodes of steps.
def fx_conv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").selectExpr(
        "conv_id AS episode_id", "turn", "role", "text",
        "(length(text) % 5) / 4.0D AS reward",
        "(length(text) % 7 = 0) AS done")


# ---- participant metadata world (derived from TPC-H tables by fixed rules) --
# registry = customer; commitments = orders; repo files = lineitem x orders;
# gating and deployments are derived per model / per order.
_W_MODEL = ("concat('lab', CAST(o_custkey % 4 AS STRING), '/', "
            "CASE WHEN o_orderstatus = 'F' THEN 'Vector-' ELSE 'Other-' END, "
            "substr(o_orderpriority, 1, 1))")
_W_REV = "concat('rev', CAST(o_orderkey % 3 AS STRING))"
_W_CHUTE = "concat('ch', CAST(o_orderkey AS STRING))"


def world_registry(spark, sf):
    return table(spark, sf, "customer").selectExpr("c_custkey AS uid", "c_name AS hotkey")


def world_commits(spark, sf):
    o = table(spark, sf, "orders")
    c = table(spark, sf, "customer").select("c_custkey", "c_name")
    return o.join(c, o.o_custkey == c.c_custkey).selectExpr(
        "c_name AS hotkey", "o_orderkey AS pos",
        "CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST(o_orderkey % 997 AS BIGINT) END AS block",
        f"to_json(named_struct('model', {_W_MODEL}, 'revision', {_W_REV}, 'chute_id', {_W_CHUTE})) AS data")


def world_gating(spark, sf):
    m = table(spark, sf, "orders").selectExpr(f"{_W_MODEL} AS model").distinct()
    return m.selectExpr("model", "CASE WHEN model LIKE '%-5' THEN true WHEN model LIKE '%-4' THEN NULL "
                        "ELSE false END AS gated")


def world_files(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    return li.join(o, li.l_orderkey == o.o_orderkey).selectExpr(
        f"{_W_MODEL} AS model", f"{_W_REV} AS revision",
        "concat('model-', CAST(l_linenumber AS STRING), CASE WHEN l_linenumber % 3 = 0 THEN '.bin' "
        "ELSE '.safetensors' END) AS path",
        "named_struct('sha256', CASE WHEN l_linenumber = 7 THEN NULL "
        "WHEN l_partkey % 1000 = 7 THEN sha2(CAST(l_partkey % 3 AS STRING), 256) "
        f"ELSE sha2(concat({_W_MODEL}, '@', {_W_REV}), 256) END) AS lfs")


def world_deployments(spark, sf):
    return table(spark, sf, "orders").selectExpr(
        f"{_W_CHUTE} AS chute_id", "(o_orderkey % 4 <> 0) AS hot",
        f"CASE WHEN o_orderkey % 9 = 0 THEN 'x/mismatch' ELSE {_W_MODEL} END AS name",
        "CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 7 = 0 THEN 'rev-other' "
        f"ELSE {_W_REV} END AS revision",
        "concat('s', CAST(o_orderkey AS STRING)) AS slug")


# ---- DuckDB text of the same views (oracle side) --------------------------
DUCK = {
    "fx_or": """fx_or AS (
  SELECT CAST(c.c_nationkey AS BIGINT) AS participant, o.o_orderpriority AS env,
         o.o_orderdate AS ts, o.o_orderkey AS seq_id,
         (o.o_orderkey % 10 <> 0) AS success,
         CAST(CASE WHEN (o.o_orderkey*7919 + o.o_custkey) % 100 < 30 + 2*c.c_nationkey
                   THEN 1 ELSE 0 END AS DOUBLE) AS score
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey)""",
    "fx_li": """fx_li AS (
  SELECT l_suppkey AS participant, concat(l_returnflag, l_linestatus) AS env,
         CAST(CASE WHEN l_quantity > 25 - (l_suppkey % 10) THEN 1 ELSE 0 END AS DOUBLE) AS score
  FROM lineitem)""",
    "fx_li_attrs": """fx_li_attrs AS (
  SELECT participant, CAST(1000 + (participant*37) % 500 AS BIGINT) AS first_block,
         (participant % 7 <> 0) AS queryable
  FROM (SELECT DISTINCT participant FROM fx_li))""",
    "fx_ev": """fx_evt AS (
  SELECT event_id AS seq_id, ts, user_id AS participant, event_type AS env, value,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k,
         date_diff('second', TIMESTAMP '2024-01-01 00:00:00', ts) AS sec, day(ts) AS d,
         date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS epoch_day
  FROM events),
fx_ev AS (
  SELECT seq_id, ts, participant, env,
         concat('org', CAST(participant % 7 AS VARCHAR), '/',
                CASE WHEN participant % 5 = 0 THEN 'Other' ELSE 'Core' END,
                '-', CAST(participant % 3 AS VARCHAR)) AS model,
         concat('r', CAST(((d + participant) // 10) % 2 AS VARCHAR)) AS revision,
         CASE WHEN participant % 11 = 0 THEN NULL
              ELSE (participant*37) % 1000 + 1000*((d + participant) // 10) END AS commit_block,
         sec // 12 AS block, (k % 10 <> 0) AS success,
         (k % 5) / CAST(4 AS DOUBLE) AS score, d, epoch_day
  FROM fx_evt)""",
    "registry": """registry AS (
  SELECT CAST(s_suppkey AS BIGINT) AS uid, s_name AS hotkey FROM supplier)""",
    "fx_doc_claims": """fx_doc_claims AS (
  SELECT doc_id AS uid, CASE WHEN doc_id % 13 = 0 THEN NULL ELSE n_chars END AS block,
         concat(lang, '/', source) AS model,
         list_distinct(list_transform(string_split(text, chr(10)), lambda x: sha256(x))) AS hashes
  FROM documents)""",
    "fx_conv": """fx_conv AS (
  SELECT conv_id AS episode_id, turn, role, text,
         (length(text) % 5) / 4.0 AS reward, (length(text) % 7 = 0) AS done
  FROM conversations)""",
}


DUCK.update({
    "world_registry": "world_registry AS (SELECT c_custkey AS uid, c_name AS hotkey FROM customer)",
    "world_commits": f"""world_commits AS (
  SELECT c_name AS hotkey, o_orderkey AS pos,
         CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST(o_orderkey % 997 AS BIGINT) END AS block,
         {_W_MODEL} AS model, {_W_REV} AS revision, {_W_CHUTE} AS chute_id
  FROM orders JOIN customer ON o_custkey = c_custkey)""",
    "world_gating": f"""world_gating AS (
  SELECT model, CASE WHEN model LIKE '%-5' THEN true WHEN model LIKE '%-4' THEN NULL ELSE false END AS gated
  FROM (SELECT DISTINCT {_W_MODEL} AS model FROM orders))""",
    "world_files": f"""world_files AS (
  SELECT {_W_MODEL} AS model, {_W_REV} AS revision,
         concat('model-', CAST(l_linenumber AS STRING),
                CASE WHEN l_linenumber % 3 = 0 THEN '.bin' ELSE '.safetensors' END) AS path,
         CASE WHEN l_linenumber = 7 THEN NULL
              WHEN l_partkey % 1000 = 7 THEN sha256(CAST(l_partkey % 3 AS STRING))
              ELSE sha256(concat({_W_MODEL}, '@', {_W_REV})) END AS sha256
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""",
    "world_deployments": f"""world_deployments AS (
  SELECT {_W_CHUTE} AS chute_id, (o_orderkey % 4 <> 0) AS hot,
         CASE WHEN o_orderkey % 9 = 0 THEN 'x/mismatch' ELSE {_W_MODEL} END AS name,
         CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 7 = 0 THEN 'rev-other'
              ELSE {_W_REV} END AS revision,
         concat('s', CAST(o_orderkey AS STRING)) AS slug
  FROM orders)""",
})


def duck_with(*names: str) -> str:
    """``WITH`` prefix holding the named fixture views, for oracle SQL."""
    return "WITH " + ",\n".join(DUCK[n] for n in names) + "\n"
