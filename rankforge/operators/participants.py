"""Participant selection (X1) and its parts: blacklist, latest commitment,
gating, repo weight hashes, deployment validity, duplicate-claim removal.

Scale notes: every per-key choice ("last commitment", "earliest claimant of
a hash", "earliest participant of a model") is a hash aggregation with
``max_by``/``min(struct)`` (map-side combined), never a window over a
possibly hot key.  The one join back onto exploded claims (E4) is keyed by
hash; AQE's skew-join split covers a hash claimed by a third of all rows.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankforge.config import MAX_BLOCK
from rankforge.operators.results import last_rows
from rankforge.session import materialize

COMMIT_SCHEMA = T.StructType([
    T.StructField("model", T.StringType()),
    T.StructField("revision", T.StringType()),
    T.StructField("chute_id", T.StringType()),
])


# ---- B7 ----------------------------------------------------------------------
def parse_blacklist(text: str | None) -> list[str]:
    """Comma list, entries trimmed, empties dropped (a parameter, not data)."""
    return sorted({h.strip() for h in (text or "").split(",") if h.strip()})


def drop_blacklisted(spark: SparkSession, df: DataFrame, blacklist: Iterable[str],
                     col: str = "hotkey") -> DataFrame:
    """Anti join against the blacklist (a parameter list, so its size is the
    caller's: broadcast)."""
    bl = spark.createDataFrame([(h,) for h in blacklist], f"{col} string")
    return df.join(F.broadcast(bl), col, "left_anti")


def blacklist_from_text(col) -> "F.Column":
    """Column form of the list parse: array of trimmed non-empty entries."""
    parts = F.transform(F.split(col, ","), lambda x: F.regexp_replace(x, r"^\s+|\s+$", ""))
    return F.array_distinct(F.filter(parts, lambda x: x != ""))


# ---- C1 + B10 + J12 ---------------------------------------------------------
def latest_commitment(registry: DataFrame, commits: DataFrame) -> DataFrame:
    """Registry inner join each hotkey's *last* commitment (max pos); JSON
    payload parsed to model / revision / chute_id; uid 0 gets block 0."""
    last = last_rows(commits, ["hotkey"], "pos").select(
        "hotkey", F.struct("block", "data").alias("_c"))
    j = registry.join(last, "hotkey", "inner")
    p = F.from_json(F.col("_c.data"), COMMIT_SCHEMA)
    return j.select("uid", "hotkey",
                    F.when(F.col("uid") == 0, F.lit(0)).otherwise(F.col("_c.block"))
                    .cast("bigint").alias("block"),
                    p["model"].alias("model"), p["revision"].alias("revision"),
                    p["chute_id"].alias("chute_id"))


def commitment_payload(model, revision, chute_id) -> "F.Column":
    """J12 build side: ``{"model":..,"revision":..,"chute_id":..}``."""
    return F.to_json(F.struct(model.alias("model"), revision.alias("revision"),
                              chute_id.alias("chute_id")))


# ---- B8 ----------------------------------------------------------------------
def gate_filter(df: DataFrame, gating: DataFrame) -> DataFrame:
    """Keep rows whose model is known *not* gated; a missing or null gate is
    unknown and excluded."""
    g = gating.select("model", F.col("gated").alias("_gated"))
    return df.join(g, "model", "left").filter(F.col("_gated") == F.lit(False)).drop("_gated")


# ---- J15 ---------------------------------------------------------------------
def weights_shas(files: DataFrame) -> DataFrame:
    """(model, revision, weights_shas): distinct sha256 of the ``.safetensors``
    files that carry one, sorted; repos without any get no row (null)."""
    f = files.filter(F.col("path").endswith(".safetensors") & F.col("lfs.sha256").isNotNull())
    return f.groupBy("model", "revision").agg(
        F.array_sort(F.collect_set(F.col("lfs.sha256").cast("string"))).alias("weights_shas"))


# ---- C2 + B9 + B6 ------------------------------------------------------------
def family_ok(name, prefix: str = "vector") -> "F.Column":
    """Second '/'-part, first 6 characters lower-cased equal to prefix;
    no '/' is invalid."""
    part = F.try_element_at(F.split(name, "/"), F.lit(2))
    return F.coalesce(F.substring(F.lower(part), 1, 6) == F.lit(prefix[:6]), F.lit(False))


def deployment_filter(df: DataFrame, deployments: DataFrame, family: str = "vector") -> DataFrame:
    """Left join the deployment by chute_id (missing -> invalid), then: hot,
    name equals model, family check (uid 0 exempt), revision equal unless
    the deployed revision is null."""
    d = deployments.select("chute_id", F.col("hot").alias("_hot"), F.col("name").alias("_name"),
                           F.col("revision").alias("_rev"), F.col("slug"))
    j = df.join(d, "chute_id", "left")
    ok = (F.coalesce(F.col("_hot"), F.lit(False))
          & (F.col("_name") == F.col("model"))
          & ((F.col("uid") == 0) | family_ok(F.col("_name"), family))
          & (F.col("_rev").isNull() | (F.col("revision") == F.col("_rev"))))
    return j.filter(F.coalesce(ok, F.lit(False))).drop("_hot", "_name", "_rev")


# ---- E4 ----------------------------------------------------------------------
def block_norm(col) -> "F.Column":
    return F.coalesce(col.cast("bigint"), F.lit(MAX_BLOCK).cast("bigint"))


def earliest_claims(df: DataFrame, uid: str = "uid", block: str = "block",
                    hashes: str = "weights_shas") -> DataFrame:
    """Drop a participant if any of its hashes was first claimed (lowest
    (block, uid), null block = +inf) by someone else.  Rows without hashes
    are kept.  The input is read twice: for the claims of each hash and for
    the rows that stay."""
    claims = df.select(F.explode(F.col(hashes)).alias("_h"),
                       F.struct(block_norm(F.col(block)).alias("b"), F.col(uid).alias("u")).alias("_c"))
    # a hash's claimants other than the first lose; a hot hash is aggregated before it moves
    g = claims.groupBy("_h").agg(F.min("_c").alias("_w"), F.max(F.col("_c.u")).alias("_hi"), F.min(F.col("_c.u")).alias("_lo"))
    disputed = g.filter(F.col("_hi") != F.col("_lo")).select("_h", F.col("_w.u").alias("_first"))
    losers = (claims.join(disputed, "_h").filter(F.col("_c.u") != F.col("_first"))
              .select(F.col("_c.u").alias(uid)).distinct())
    return df.join(losers, uid, "left_anti")


# ---- E5 ----------------------------------------------------------------------
def best_per_model(df: DataFrame, uid: str = "uid", block: str = "block",
                   model: str = "model") -> DataFrame:
    """Keep the earliest participant (lowest (block, uid)) of each model;
    rows with a null or empty model are dropped."""
    m = df.filter(F.col(model).isNotNull() & (F.col(model) != ""))
    best = (m.groupBy(model).agg(F.min(F.struct(block_norm(F.col(block)).alias("b"), F.col(uid).alias("u"))).alias("_w"))
            .select(F.col("_w.u").alias(uid)))
    return df.join(best, uid, "left_semi")


# ---- B17 ---------------------------------------------------------------------
def select_uids(df: DataFrame, uids=None, col: str = "uid") -> DataFrame:
    """None = all, int = one, list = those."""
    if uids is None:
        return df
    if isinstance(uids, int):
        uids = [uids]
    return df.filter(F.col(col).isin(list(uids)))


# ---- X1 ----------------------------------------------------------------------
def participants(spark: SparkSession, registry: DataFrame, commits: DataFrame,
                 gating: DataFrame, files: DataFrame, deployments: DataFrame | None = None,
                 blacklist: Iterable[str] = (), uids=None, check_validity: bool = True,
                 family: str = "vector") -> DataFrame:
    """Valid participants: B17 B7 C1 B10 B8 J15 [C2 B9 B6] E4 E5."""
    r = select_uids(registry, uids)
    r = drop_blacklisted(spark, r, blacklist)
    c = latest_commitment(r, commits)
    c = gate_filter(c, gating)
    c = c.join(weights_shas(files), ["model", "revision"], "left")
    if check_validity and deployments is not None:
        c = deployment_filter(c, deployments, family)
    # one row per participant from here on: read the sources once, not once per claim step
    c = materialize(earliest_claims(materialize(c)))
    return best_per_model(c)


# ---- C3 ----------------------------------------------------------------------
def first_block_fallback(summary: DataFrame, commits_latest: DataFrame,
                         key: str = "participant") -> DataFrame:
    """first_block from results where the participant had results; else the
    block of its last commitment (uid 0 -> 0).  ``commits_latest``: (uid, block)."""
    c = commits_latest.select(F.col("uid").alias(key), F.col("block").alias("_cb"))
    s = summary.withColumn("_active", F.lit(True))
    j = c.join(s, key, "full")
    return j.withColumn("first_block",
                        F.when(F.col("_active"), F.col("first_block")).otherwise(F.col("_cb"))
                        ).drop("_cb", "_active")


# ---- C12 ---------------------------------------------------------------------
def latest_matching_deployment(listing: DataFrame, names: DataFrame, name_col: str = "model") -> DataFrame:
    """For each wanted name, the chute_id of the last listing entry (highest
    pos) whose model_name, name or readme equals it.  The three candidate
    columns are unpivoted so the match is an equi-join (an OR of equalities
    would force a nested-loop join)."""
    cand = listing.select("pos", "chute_id", F.explode(F.array_distinct(F.array(
        "model_name", "name", "readme"))).alias("_name")).filter(F.col("_name").isNotNull())
    j = names.select(F.col(name_col).alias("_name")).distinct().join(cand, "_name")
    return last_rows(j, ["_name"], "pos").select(F.col("_name").alias(name_col), "chute_id")


# ---- C10 ---------------------------------------------------------------------
def update_confirmation(attempts: DataFrame, registry_updates: DataFrame) -> DataFrame:
    """attempts (attempt, uid, ref_block) left join registry (uid, last_update):
    confirmed iff last_update >= ref_block; the first confirming attempt ends."""
    j = attempts.join(registry_updates, "uid", "left").withColumn(
        "confirmed", F.coalesce(F.col("last_update") >= F.col("ref_block"), F.lit(False)))
    return j.groupBy("uid").agg(
        F.min(F.when(F.col("confirmed"), F.col("attempt"))).alias("confirmed_at"),
        F.count(F.lit(1)).alias("attempts"))


# ---- C9 ----------------------------------------------------------------------
def ttl_lookup(requests: DataFrame, fetches: DataFrame, ttl: float, chunk_seconds: float = 86400.0,
               key: str = "model", on_failure: str = "ignore") -> DataFrame:
    """As-of lookup with a time-to-live.

    ``on_failure`` says what a failed fetch leaves in the cache: ``ignore``
    nothing, ``restamp`` the value before it with the failure's time (the
    gating look-up), ``null`` a null with that time (the weights look-up).

    ``fetches`` (key, ts, value): the log of look-up attempts; a failed one
    has null ``value`` and is ignored.  For a request (key, now) the answer
    is the latest successful value fetched at or before ``now``; it is
    stale when at least ``ttl`` old (the cached value is reused, as the
    reference does when a refetch fails).  Rows: key, now, value, age,
    is_stale (value null when nothing was ever fetched).

    Distributed as-of join: time is cut in chunks; per (key, chunk) the last
    fetch is one hash aggregate; a running max over the small (key, chunk)
    table carries it forward; the ordered window runs inside one
    (key, chunk) only, so a hot key is split by time."""
    from pyspark.sql import Window
    ch = lambda t: F.floor(t / F.lit(chunk_seconds)).cast("bigint")
    fetched = F.lit(on_failure != "ignore") | F.col("value").isNotNull()
    f = (fetches.filter(fetched)
         .select(key, F.col("ts").cast("double").alias("_t"), F.col("value").cast("string").alias("_v"))
         .groupBy(key, "_t").agg(F.max("_v").alias("_v")))          # one value per (key, instant)
    f = f.withColumn("_c", ch(F.col("_t")))
    if on_failure == "restamp":
        return _restamped(requests, f, ttl, ch, key)
    last_in_chunk = last_rows(f, [key, "_c"], "_t").select(key, "_c", F.struct("_t", "_v").alias("_lf"))
    r = requests.select(key, F.col("now").cast("double").alias("_t")).withColumn("_c", ch(F.col("_t")))
    # carried-in value per (key, chunk): running max over the small chunk table
    chunks = r.select(key, "_c").distinct().join(last_in_chunk, [key, "_c"], "full")
    run = Window.partitionBy(key).orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)
    carry = chunks.withColumn("_in", F.max("_lf").over(run)).select(key, "_c", "_in")
    u = (r.select(key, "_c", "_t", F.lit(1).alias("_r"), F.lit(None).cast("string").alias("_v"))
         .unionByName(f.select(key, "_c", "_t", F.lit(0).alias("_r"), "_v")))
    w = Window.partitionBy(key, "_c").orderBy("_t", "_r").rowsBetween(Window.unboundedPreceding, 0)
    u = u.withColumn("_lf", F.last(F.when(F.col("_r") == 0, F.struct("_t", "_v")), ignorenulls=True).over(w))
    u = u.filter(F.col("_r") == 1).join(carry, [key, "_c"], "left")
    best = F.coalesce(F.col("_lf"), F.col("_in"))
    age = F.col("_t") - best["_t"]
    return u.select(key, F.col("_t").alias("now"), best["_v"].alias("value"), age.alias("age"),
                    F.when(best.isNull(), F.lit(None)).otherwise(age >= F.lit(float(ttl))).alias("is_stale"))


def _restamped(requests: DataFrame, f: DataFrame, ttl: float, ch, key: str) -> DataFrame:
    """``ttl_lookup`` where a failure keeps the value before it under its own
    time, in one pass: a request gets the latest successful value, under the
    time of the latest fetch of any kind."""
    from pyspark.sql import Window
    some = F.when(F.col("_v").isNotNull(), F.struct("_t", "_v"))
    tried = F.struct("_t")
    # a fetch without a time is carried nowhere
    last_in_chunk = f.filter(F.col("_c").isNotNull()).groupBy(key, "_c").agg(F.max(some).alias("_lf"), F.max(tried).alias("_la"))
    r = requests.select(key, F.col("now").cast("double").alias("_t")).withColumn("_c", ch(F.col("_t")))
    chunks = r.select(key, "_c").distinct().join(last_in_chunk, [key, "_c"], "full")
    run = Window.partitionBy(key).orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)
    carry = chunks.select(key, "_c", F.max("_lf").over(run).alias("_in"), F.max("_la").over(run).alias("_ina"))
    u = (r.select(key, "_c", "_t", F.lit(1).alias("_r"), F.lit(None).cast("string").alias("_v"))
         .unionByName(f.select(key, "_c", "_t", F.lit(0).alias("_r"), "_v")))
    w = Window.partitionBy(key, "_c").orderBy("_t", "_r").rowsBetween(Window.unboundedPreceding, 0)
    mine = F.col("_r") == 0
    u = u.withColumn("_lf", F.last(F.when(mine, some), ignorenulls=True).over(w)) \
        .withColumn("_la", F.last(F.when(mine, tried), ignorenulls=True).over(w))
    u = u.filter(F.col("_r") == 1).join(carry, [key, "_c"], "left")
    value = F.coalesce(F.col("_lf"), F.col("_in"))
    at = F.when(value.isNotNull(), F.coalesce(F.col("_la"), F.col("_ina"))["_t"])
    age = F.col("_t") - at
    return u.select(key, F.col("_t").alias("now"), value["_v"].alias("value"), age.alias("age"),
                    F.when(value.isNull(), F.lit(None)).otherwise(age >= F.lit(float(ttl))).alias("is_stale"))
