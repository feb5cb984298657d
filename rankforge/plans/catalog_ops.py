"""Registered ops and trajectory queries (B2 B3 B12 B14-B16 C7 C8 D19-D22
E6-E10 E12 I6 J11 M6 M7).  Inputs derived by fixed rules from the driver's
tables; whole tables are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankforge import fixtures as fx
from rankforge.config import ACTIVE_ENVS
from rankforge.operators import merkle as MK
from rankforge.operators import ops as O
from rankforge.operators import participants as PT
from rankforge.operators import trajectories as TR
from rankforge.plans.catalog_text import NL, _dhash, _hash
from rankforge.session import materialize

Q: dict = {}


def register(name: str, sql: str | None):
    def deco(fn):
        Q[name] = (fn, sql)
        return fn
    return deco


_ENVS_SQL = ", ".join(f"'{e}'" for e in ACTIVE_ENVS)

# ---- B2 -------------------------------------------------------------------------------
_RAW_ENV = ("CASE event_type WHEN 'click' THEN ' arena:webshop ' WHEN 'view' THEN 'vector:sat' "
            "WHEN 'error' THEN 'foo:bar' WHEN 'signup' THEN 'webshop' ELSE '  vector:ded\\n' END")


@register("env_parse_ev", f"""
WITH d AS (SELECT event_id, regexp_replace(CASE event_type WHEN 'click' THEN ' arena:webshop '
              WHEN 'view' THEN 'vector:sat' WHEN 'error' THEN 'foo:bar' WHEN 'signup' THEN 'webshop'
              ELSE '  vector:ded' || chr(10) END, '^\\s+|\\s+$', '', 'g') AS s FROM events),
v AS (SELECT event_id, s, s IN ({_ENVS_SQL})
             AND (CASE WHEN contains(s, ':') THEN split_part(s, ':', 1) ELSE 'arena' END)
                 IN ('arena', 'vector') AS valid FROM d)
SELECT event_id, valid,
       CASE WHEN valid THEN CASE WHEN contains(s, ':') THEN split_part(s, ':', 1) ELSE 'arena' END END AS prefix,
       CASE WHEN valid THEN CASE WHEN contains(s, ':') THEN regexp_replace(s, '^[^:]*:', '') ELSE s END END AS name
FROM v""")
def env_parse_ev(spark: SparkSession, sf: str) -> DataFrame:
    e = fx.table(spark, sf, "events").selectExpr("event_id", f"{_RAW_ENV} AS raw")
    p = O.parse_env("raw")
    return e.select("event_id", p["valid"].alias("valid"), p["prefix"].alias("prefix"), p["name"].alias("name"))


# ---- B3 -------------------------------------------------------------------------------
_SPEC = ("concat(' ', lower(c_mktsegment), ', vector:sat,,', "
         "CASE WHEN c_custkey % 3 = 0 THEN 'zzz:q' ELSE ' arena:alfworld ' END)")


@register("env_list_customer", f"""
WITH d AS (SELECT c_custkey, concat(' ', lower(c_mktsegment), ', vector:sat,,',
                  CASE WHEN c_custkey % 3 = 0 THEN 'zzz:q' ELSE ' arena:alfworld ' END) AS spec FROM customer),
t AS (SELECT c_custkey, list_filter(list_transform(string_split(spec, ','),
             lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')), lambda x: x <> '') AS toks FROM d),
p AS (SELECT c_custkey, list_filter(list_transform(toks, lambda x: CASE WHEN contains(x, ':')
             THEN split_part(x, ':', 1) || ':' || regexp_replace(x, '^[^:]*:', '') ELSE 'arena:' || x END),
             lambda x: split_part(x, ':', 1) IN ('arena', 'vector')) AS envs FROM t)
SELECT c_custkey, array_to_string(envs, ',') AS envs, CAST(len(envs) AS INTEGER) AS n_envs FROM p""")
def env_list_customer(spark: SparkSession, sf: str) -> DataFrame:
    c = fx.table(spark, sf, "customer").selectExpr("c_custkey", f"{_SPEC} AS spec")
    lst = O.parse_env_list("spec")
    return c.select("c_custkey",
                    F.array_join(F.transform(lst, lambda p: F.concat(p["prefix"], F.lit(":"), p["name"])), ",")
                    .alias("envs"), F.size(lst).alias("n_envs"))


# ---- B12 ------------------------------------------------------------------------------
_CAT = ["p_partkey", "p_retailprice / 1000 AS price",
        "CASE WHEN p_size % 3 = 0 THEN NULL ELSE p_size * 1000 END AS context_length",
        "CASE WHEN p_size % 2 = 0 THEN p_size * 2000 END AS max_model_len",
        "CASE WHEN p_brand LIKE '%1' THEN array('image') ELSE array('text', 'image') END AS input_modalities",
        "CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE array('text') END AS output_modalities"]


@register("catalogue_part", """
WITH c AS (SELECT p_partkey, p_retailprice / 1000 AS price,
                  CASE WHEN p_size % 3 = 0 THEN NULL ELSE p_size * 1000 END AS context_length,
                  CASE WHEN p_size % 2 = 0 THEN p_size * 2000 END AS max_model_len,
                  CASE WHEN p_brand LIKE '%1' THEN ['image'] ELSE ['text', 'image'] END AS input_modalities,
                  CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE ['text'] END AS output_modalities FROM part)
SELECT p_partkey FROM c
WHERE price BETWEEN 0.9 AND 1.5 AND coalesce(context_length, max_model_len, 0) >= 20000
  AND list_contains(coalesce(input_modalities, []), 'text') AND list_contains(coalesce(output_modalities, []), 'text')""")
def catalogue_part(spark: SparkSession, sf: str) -> DataFrame:
    c = fx.table(spark, sf, "part").selectExpr(*_CAT)
    return O.catalogue_filter(c, 0.9, 1.5, 20000).select("p_partkey")


# ---- B14 ------------------------------------------------------------------------------
@register("shape_check_world", fx.duck_with("world_registry", "world_commits", "world_deployments") + """,
latest AS (SELECT r.uid, c.model, c.chute_id FROM world_registry r JOIN (SELECT * FROM world_commits
           QUALIFY row_number() OVER (PARTITION BY hotkey ORDER BY pos DESC) = 1) c USING (hotkey)),
j AS (SELECT l.uid, l.model, CASE WHEN d.hot THEN d.slug END AS slug
      FROM latest l LEFT JOIN world_deployments d USING (chute_id))
SELECT uid, coalesce(model <> '', false) AND coalesce(slug <> '', false) AS valid FROM j""")
def shape_check_world(spark: SparkSession, sf: str) -> DataFrame:
    lat = PT.latest_commitment(fx.world_registry(spark, sf), fx.world_commits(spark, sf))
    d = fx.world_deployments(spark, sf).select("chute_id", F.when(F.col("hot"), F.col("slug")).alias("slug"))
    j = lat.join(d, "chute_id", "left")
    good, bad = O.split_valid_participants(j)
    return good.select("uid", F.lit(True).alias("valid")).unionByName(bad.select("uid", F.lit(False).alias("valid")))


# ---- B15 / B16 -------------------------------------------------------------------------
_LEASES = ["o_orderkey AS id", "CAST(1000000000 + o_orderkey % 5000 AS DOUBLE) AS created_at",
           "CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(1000000000 + o_orderkey % 5000 + o_custkey % 700 AS DOUBLE)"
           " END AS last_active_at",
           "CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_custkey % 500 END AS timeout_seconds",
           "CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE concat('c', CAST(o_custkey AS STRING)) END AS container_id"]
_NOW = 1000000000 + 5000.0


@register("stale_leases_orders", f"""
WITH l AS (SELECT o_orderkey AS id, CAST(1000000000 + o_orderkey % 5000 AS DOUBLE) AS created_at,
                  CASE WHEN o_orderkey % 3 = 0 THEN NULL
                       ELSE CAST(1000000000 + o_orderkey % 5000 + o_custkey % 700 AS DOUBLE) END AS last_active_at,
                  CAST(coalesce(CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_custkey % 500 END, 300) AS DOUBLE) AS t
           FROM orders),
f AS (SELECT id, {_NOW} >= coalesce(last_active_at, created_at) + t AS idle,
             {_NOW} >= created_at + greatest(t * 2, t + 60) AS expired FROM l)
SELECT id, idle, expired FROM f WHERE idle OR expired""")
def stale_leases_orders(spark: SparkSession, sf: str) -> DataFrame:
    leases = fx.table(spark, sf, "orders").selectExpr(*_LEASES)
    return O.stale_leases(leases, _NOW).select("id", "idle", "expired")


@register("orphan_leases_orders", """
SELECT o_orderkey AS id FROM orders
WHERE (CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE concat('c', CAST(o_custkey AS VARCHAR)) END) IS NULL
   OR concat('c', CAST(o_custkey AS VARCHAR)) NOT IN (SELECT concat('c', CAST(c_custkey AS VARCHAR))
                                                       FROM customer WHERE c_acctbal > 0)""")
def orphan_leases_orders(spark: SparkSession, sf: str) -> DataFrame:
    leases = fx.table(spark, sf, "orders").selectExpr(*_LEASES)
    live = fx.table(spark, sf, "customer").filter("c_acctbal > 0").selectExpr(
        "concat('c', CAST(c_custkey AS STRING)) AS container_id")
    return O.orphan_leases(leases, live).select("id")


# ---- C7 / C8 --------------------------------------------------------------------------
_INFLIGHT = ("vector:sat", "arena:babyai")


@register("fan_out_world", fx.duck_with("world_registry", "world_commits") + f""",
latest AS (SELECT r.uid, c.model FROM world_registry r JOIN (SELECT * FROM world_commits
           QUALIFY row_number() OVER (PARTITION BY hotkey ORDER BY pos DESC) = 1) c USING (hotkey)),
envs AS (SELECT unnest([{_ENVS_SQL}]) AS env)
SELECT env, count(*) AS n_tasks, CAST(1 AS BIGINT) AS n_task_ids
FROM latest CROSS JOIN envs
WHERE model IS NOT NULL AND model <> '' AND env NOT IN ({", ".join(f"'{e}'" for e in _INFLIGHT)})
GROUP BY env""")
def fan_out_world(spark: SparkSession, sf: str) -> DataFrame:
    lat = PT.latest_commitment(fx.world_registry(spark, sf), fx.world_commits(spark, sf))
    infl = spark.createDataFrame([(e,) for e in _INFLIGHT], "env string")
    t = O.fan_out(lat, ACTIVE_ENVS, infl, F.lit(0), seed=7)
    return t.groupBy("env").agg(F.count(F.lit(1)).alias("n_tasks"),
                                F.countDistinct("task_id").alias("n_task_ids"))


@register("challenge_tasks_world", fx.duck_with("world_registry", "world_commits") + """,
latest AS (SELECT r.uid, c.model FROM world_registry r JOIN (SELECT * FROM world_commits
           QUALIFY row_number() OVER (PARTITION BY hotkey ORDER BY pos DESC) = 1) c USING (hotkey))
SELECT b.item_id, count(*) AS n_tasks, CAST(sum(l.uid) AS BIGINT) AS uid_sum
FROM benchmark b CROSS JOIN latest l WHERE l.model IS NOT NULL AND l.model <> '' GROUP BY b.item_id""")
def challenge_tasks_world(spark: SparkSession, sf: str) -> DataFrame:
    lat = PT.latest_commitment(fx.world_registry(spark, sf), fx.world_commits(spark, sf))
    ch = fx.table(spark, sf, "benchmark").select("item_id")
    t = O.challenge_tasks(ch, lat)
    return t.groupBy("item_id").agg(F.count(F.lit(1)).alias("n_tasks"), F.sum("uid").alias("uid_sum"))


# ---- D19 ------------------------------------------------------------------------------
@register("status_rollup_ev", """
SELECT CAST(time_bucket(INTERVAL 30 SECOND, ts) AS VARCHAR) AS window_start, count(*) AS requests,
       count(*) / 30.0 AS rps FROM events GROUP BY 1""")
def status_rollup_ev(spark: SparkSession, sf: str) -> DataFrame:
    r = O.status_rollup(fx.table(spark, sf, "events"))
    return r.select(F.col("window_start").cast("string").alias("window_start"), "requests", "rps")


# ---- D20 + M6 --------------------------------------------------------------------------
_ATT = ["user_id AS request_id", "event_id AS attempt",
        "CASE event_type WHEN 'error' THEN 500 WHEN 'click' THEN 200 WHEN 'signup' THEN 404 ELSE 503 END AS status"]


@register("attempts_ev", """
WITH a AS (SELECT user_id AS request_id, event_id AS attempt,
                  CASE event_type WHEN 'error' THEN 500 WHEN 'click' THEN 200 WHEN 'signup' THEN 404 ELSE 503 END
                  AS status FROM events),
b AS (SELECT *, status = 200 AS ok, CASE WHEN status <> 200 THEN concat('E', CAST(status AS VARCHAR)) END AS error
      FROM a),
s AS (SELECT request_id, min(attempt) FILTER (WHERE ok OR status IN (400, 404, 410)) AS stop,
             max(attempt) AS last FROM b GROUP BY request_id),
e AS (SELECT s.request_id, coalesce(stop, last) AS attempts FROM s)
SELECT e.request_id, e.attempts, b.ok AS success, CASE WHEN NOT b.ok THEN b.error END AS error,
       2.0 * pow(2, (SELECT count(*) FROM b b2 WHERE b2.request_id = e.request_id AND b2.attempt <= e.attempts) - 1)
         AS expected_wait
FROM e JOIN b ON b.request_id = e.request_id AND b.attempt = e.attempts""")
def attempts_ev(spark: SparkSession, sf: str) -> DataFrame:
    a = fx.table(spark, sf, "events").selectExpr(*_ATT).withColumn("success", F.col("status") == 200) \
        .withColumn("error", F.when(F.col("status") != 200, F.concat(F.lit("E"), F.col("status").cast("string"))))
    r = O.resolve_attempts(a)
    used = (a.join(r.select("request_id", F.col("attempts").alias("_end")), "request_id")
            .filter(F.col("attempt") <= F.col("_end")).groupBy("request_id")
            .agg(F.count(F.lit(1)).alias("_k")))
    return r.join(used, "request_id").select("request_id", "attempts", "success", "error",
                                             O.retry_delay(F.col("_k"), 2.0).alias("expected_wait"))


# ---- D21 / D22 ------------------------------------------------------------------------
@register("listing_part", """
SELECT split_part(p_type, ' ', 1) AS type, array_to_string(list_sort(list_distinct(list(p_brand))), ',') AS names
FROM part GROUP BY 1""")
def listing_part(spark: SparkSession, sf: str) -> DataFrame:
    p = fx.table(spark, sf, "part").selectExpr("substring_index(p_type, ' ', 1) AS type", "p_brand AS name")
    return O.listing_by_type(p).select("type", F.array_join("names", ",").alias("names"))


def merkle_sql(files: str, levels: int = 5) -> str:
    """CTEs from ``files`` (a CTE with set, path, text) to ``root`` (set, hash, files):
    16 nodes are hashed to one, level by level, up to 16^levels files."""
    out = f"""n0 AS (SELECT s, row_number() OVER (PARTITION BY s ORDER BY path, h) - 1 AS i, h, count(*) OVER (PARTITION BY s) AS files
      FROM (SELECT s, path, sha256(concat(CAST(path AS VARCHAR), ':', sha256(coalesce(text, '')))) AS h FROM {files}))"""
    for k in range(1, levels + 1):
        out += f""",
n{k} AS (SELECT s, i // 16 AS i, CASE WHEN max(files) <= {16 ** (k - 1)} THEN any_value(h)
         ELSE sha256(string_agg(h, chr(10) ORDER BY i)) END AS h, max(files) AS files FROM n{k - 1} GROUP BY s, i // 16)"""
    return out + f""",
root AS (SELECT s, h, files FROM n{levels})"""


@register("fingerprint_docs", f"""
WITH f AS (SELECT source AS s, doc_id AS path, text FROM documents),
{merkle_sql('f')}
SELECT s AS source, h AS fingerprint, files FROM root""")
def fingerprint_docs(spark: SparkSession, sf: str) -> DataFrame:
    d = fx.table(spark, sf, "documents").select("source", F.col("doc_id").alias("path"),
                                                F.col("text").alias("content"))
    return O.content_fingerprint(d, "source")


@register("fingerprint_update_docs", f"""
WITH f AS (SELECT source AS s, doc_id AS path, CASE WHEN doc_id % 997 = 5 THEN text || '!' ELSE text END AS text FROM documents),
{merkle_sql('f')}
SELECT s AS source, h AS fingerprint, files FROM root""")
def fingerprint_update_docs(spark: SparkSession, sf: str) -> DataFrame:
    """Some files change; only the nodes above them are hashed again."""
    d = fx.table(spark, sf, "documents").select("source", F.col("doc_id").alias("path"), F.col("text").alias("content"))
    leaf = materialize(MK.leaves(d, "source"))
    nodes = MK.tree(leaf, "source")
    new = d.filter(F.col("path") % 997 == 5).select(
        "source", "path", MK.leaf_hash(F.col("path"), F.concat("content", F.lit("!"))).alias("hash"))
    changed = leaf.select("source", "path", "idx").join(new, ["source", "path"])
    fresh = MK.update(nodes, changed, "source")
    kept = nodes.join(fresh.select("source", "level", "idx"), ["source", "level", "idx"], "left_anti")
    return MK.roots(kept.unionByName(fresh.select(*kept.columns)), "source")


# ---- E9 / E10 ---------------------------------------------------------------------------
@register("challenge_gen_ev", fx.duck_with("fx_ev") + """,
o AS (SELECT seq_id, env, row_number() OVER (PARTITION BY env ORDER BY ts, seq_id) AS ordinal FROM fx_ev)
SELECT seq_id, ordinal, CAST(floor((ordinal - 1) / 30) AS BIGINT) AS generation,
       ordinal % coalesce(nullif(CASE env WHEN 'click' THEN 0 WHEN 'view' THEN NULL ELSE 7 END, 0), 200) AS round
FROM o""")
def challenge_gen_ev(spark: SparkSession, sf: str) -> DataFrame:
    e = fx.fx_ev(spark, sf)
    o = O.ordinal_within(e, "env", ["ts", "seq_id"], F.col("epoch_day"))
    dl = F.when(F.col("env") == "click", 0).when(F.col("env") == "view", None).otherwise(7)
    return o.select("seq_id", "ordinal", O.challenge_generation(F.col("ordinal")).cast("bigint").alias("generation"),
                    O.round_counter(F.col("ordinal"), dl).alias("round"))


# ---- E12 -------------------------------------------------------------------------------
@register("stalls_ev", """
WITH g AS (SELECT event_id, user_id, epoch_us(ts) / 1e6 - lag(epoch_us(ts) / 1e6) OVER w AS gap
           FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT *, coalesce(gap > 14400, false) AS stalled FROM g)
SELECT event_id, stalled, CAST(sum(CAST(stalled AS INTEGER)) OVER (PARTITION BY user_id ORDER BY event_id
       ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session FROM s""")
def stalls_ev(spark: SparkSession, sf: str) -> DataFrame:
    s = O.stalls(fx.table(spark, sf, "events"), "user_id", "ts", 14400.0)
    return s.select("event_id", "stalled", "session")


# ---- I6 --------------------------------------------------------------------------------
@register("tempo_gate_ev", fx.duck_with("fx_ev") + """
SELECT DISTINCT block FROM fx_ev WHERE block % 100 = 0""")
def tempo_gate_ev(spark: SparkSession, sf: str) -> DataFrame:
    return O.tempo_gate(fx.fx_ev(spark, sf))


# ---- M7 ------------------------------------------------------------------------------------
@register("task_ids_ev", fx.duck_with("fx_ev") + """,
k AS (SELECT *, seq_id % 3 AS kind, 1 + seq_id % 997 AS n FROM fx_ev),
t AS (SELECT *, unnest(range(0, 4)) AS try FROM k WHERE kind < 2),
h AS (SELECT *, ('0x' || substr(sha256(concat('42:', env, ':', seq_id, ':', try)), 1, 15))::BIGINT AS x200,
             ('0x' || substr(sha256(concat('7:', env, ':', seq_id, ':', try)), 1, 15))::BIGINT AS xn FROM t),
d AS (SELECT seq_id, arg_min(x200 % 200, try) FILTER (WHERE x200 < 1152921504606846976 - 1152921504606846976 % 200) AS d200,
             arg_min(xn % n, try) FILTER (WHERE xn < 1152921504606846976 - 1152921504606846976 % n) AS dn FROM h GROUP BY seq_id)
SELECT k.seq_id, 1 AS n_ids, CASE WHEN kind < 2 THEN d200 ELSE k.seq_id END AS first_id, dn AS own_range
FROM k LEFT JOIN d USING (seq_id)""")
def task_ids_ev(spark: SparkSession, sf: str) -> DataFrame:
    e = fx.fx_ev(spark, sf).withColumn("k", F.col("seq_id") % 3)
    ids = F.when(F.col("k") == 0, F.lit(None).cast("array<bigint>")).when(F.col("k") == 1, F.array().cast(
        "array<bigint>")).otherwise(F.array(F.col("seq_id")))
    t = O.normalise_task_ids(ids, 42, F.col("env"), F.col("seq_id"))
    own = O.task_id(7, F.col("env"), F.col("seq_id"), data_len=1 + F.col("seq_id") % 997)
    return e.select("seq_id", F.size(t).alias("n_ids"), t[0].alias("first_id"),
                    F.when(F.col("k") < 2, own).alias("own_range"))


# ---- E6 / E7 / E8 / J11 (FX-CONV) ---------------------------------------------------------
@register("running_reward_conv", fx.duck_with("fx_conv") + """
SELECT episode_id, turn, sum(reward) OVER (PARTITION BY episode_id ORDER BY turn ROWS UNBOUNDED PRECEDING)
       AS running_reward,
       CASE WHEN done THEN reward ELSE 0.0 END AS terminal_reward FROM fx_conv""")
def running_reward_conv(spark: SparkSession, sf: str) -> DataFrame:
    r = TR.running_reward(fx.fx_conv(spark, sf))
    return r.select("episode_id", "turn", "running_reward",
                    TR.terminal_reward(F.col("reward"), F.col("done")).alias("terminal_reward"))


@register("episode_outcome_conv", fx.duck_with("fx_conv") + """,
k AS (SELECT *, row_number() OVER (PARTITION BY episode_id ORDER BY turn) AS k FROM fx_conv),
fd AS (SELECT episode_id, min(k) FILTER (WHERE done) AS fd FROM k GROUP BY episode_id),
p AS (SELECT k.* FROM k JOIN fd USING (episode_id) WHERE k.k <= least(coalesce(fd.fd, 1073741824), 10))
SELECT episode_id, count(*) AS rounds, arg_max(done, k) AS done, arg_max(reward, k) AS final_reward
FROM p GROUP BY episode_id""")
def episode_outcome_conv(spark: SparkSession, sf: str) -> DataFrame:
    return TR.episode_outcome(fx.fx_conv(spark, sf), max_rounds=10)


_SEED = (("user", "You are an agent. Follow the format."), ("assistant", "OK"))


@register("chat_conv", f"""
WITH m AS (SELECT episode_id, string_agg(concat(role, ':', text), {NL} ORDER BY turn) AS body, count(*) AS n
           FROM fx_conv GROUP BY episode_id)
SELECT episode_id, CAST(n + 2 AS INTEGER) AS n_messages,
       {_dhash("concat('user:You are an agent. Follow the format.', chr(10), 'assistant:OK', chr(10), body)", 'chat')}
FROM m""".replace("FROM fx_conv", "FROM (" + fx.DUCK["fx_conv"].split("AS (", 1)[1].rsplit(")", 1)[0] + ")"))
def chat_conv(spark: SparkSession, sf: str) -> DataFrame:
    c = fx.fx_conv(spark, sf).withColumnRenamed("text", "content")
    m = TR.assemble_chat(c, _SEED)
    flat = F.array_join(F.transform("messages", lambda x: F.concat(x["role"], F.lit(":"), x["content"])), "\n")
    return m.select("episode_id", F.size("messages").alias("n_messages"), *_hash(flat, "chat"))


QUERIES = {k: v[0] for k, v in Q.items()}
ORACLE = {k: v[1] for k, v in Q.items() if v[1] is not None}
