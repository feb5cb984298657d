"""Composite scoring plans: X3 score, X4 weights, X5 leaderboard.

Steps whose tables are small and read again (one row per participant or env
subset) are checkpointed; the rest stays one lazy plan.  Global facts (is anyone eligible? total
points? who is best?) are scalar subqueries, evaluated once by Spark, never
collected by the driver.  All tables past the grid have one row per
participant (or per env subset), so their size is bounded by the registry.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rankforge.config import ScoringConfig
from rankforge.operators import dominance as D
from rankforge.operators.results import argmax_id, argmax_key, fb_infinite, with_accuracy
from rankforge.functions.text import report_cell
from rankforge.session import materialize


def score(flagged: DataFrame, n_envs: int, cfg: ScoringConfig) -> tuple[DataFrame, DataFrame]:
    """(winners per subset, dominance counts) over the ``in_pool`` rows."""
    pool = with_accuracy(flagged.filter("in_pool"))
    dom = materialize(D.dominance_counts(pool, n_envs, cfg))
    return materialize(D.subset_winners(pool, dom, n_envs, cfg.scale)), dom


def best_participant(flagged: DataFrame, dom: DataFrame, n_envs: int,
                     idle: DataFrame | None = None) -> "F.Column":
    """C6 + F4 as a scalar column: ladder pool -> queryable -> active; within
    the lowest non-empty level, max by (full-set dominance, -first_block),
    ties to the lowest id.  ``idle``: queryable participants without results
    (participant, first_block), who stand on the second rung."""
    full = (1 << n_envs) - 1
    d_full = dom.filter(F.col("S") == full).select("participant", F.col("dom").alias("_df"))
    level = (F.when(F.col("in_pool"), 0).when(F.col("queryable"), 1).otherwise(2))
    c = (flagged.join(d_full, "participant", "left")
         .select("participant", level.alias("lvl"),
                 F.coalesce("_df", F.lit(0)).alias("d"),
                 fb_infinite(F.col("first_block")).alias("fb")))
    if idle is not None:
        c = c.unionByName(idle.select("participant", F.lit(1).alias("lvl"), F.lit(0).cast("bigint").alias("d"),
                                      fb_infinite(F.col("first_block")).alias("fb")))
    # lowest ladder level first: (2 - lvl) leads the packed score
    key = argmax_key((F.lit(2) - F.col("lvl")) * F.lit(10 ** 8) + F.col("d"), F.col("fb"), F.col("participant"))
    return c.agg(argmax_id(F.max(key))).scalar()


def weights(spark: SparkSession, flagged: DataFrame, winners: DataFrame, dom: DataFrame,
            n_envs: int, cfg: ScoringConfig, base: int = 0) -> DataFrame:
    """X4 tail: (uid, weight, ord) - the output vector, best last (F1).

    D11 normalise points over eligible (all-zero -> 1.0 to the top scorer),
    D12 burn, F2 degenerate cases (burn >= 1, nobody eligible -> (base, 1.0))."""
    burn = max(0.0, min(1.0, cfg.burn))
    one = spark.range(1).select(F.lit(base).cast("bigint").alias("uid"),
                                F.lit(1.0).alias("weight"), F.lit(0).alias("ord"))
    if burn >= 1:
        return one
    pts = D.layer_points(winners, n_envs).select("participant", "points")
    el = (flagged.filter("eligible").select("participant")
          .join(pts, "participant", "left")
          .withColumn("points", F.coalesce("points", F.lit(0.0))))
    total = el.agg(F.coalesce(F.sum("points"), F.lit(0.0))).scalar()
    top = el.agg(F.max_by("participant", F.struct("points", -F.col("participant")))).scalar()
    w = el.select("participant", F.when(total > 0, F.col("points") / total)
                  .otherwise(F.when(F.col("participant") == top, 1.0).otherwise(0.0))
                  .alias("weight"))
    if burn > 0:
        # scale, then add the burn to the base (inserted when absent): a
        # union + per-participant sum, not a join on a literal key
        w = w.withColumn("weight", F.col("weight") * F.lit(1.0 - burn))
        base_row = spark.range(1).select(F.lit(base).cast("bigint").alias("participant"),
                                         F.lit(burn).alias("weight"))
        w = w.unionByName(base_row).groupBy("participant").agg(F.sum("weight").alias("weight"))
    best = best_participant(flagged, dom, n_envs)
    best_row = spark.range(1).select(best.cast("bigint").alias("participant"), F.lit(0.0).alias("weight"))
    vec = w.unionByName(best_row).groupBy("participant").agg(F.sum("weight").alias("weight"))
    vec = vec.select(F.col("participant").cast("bigint").alias("uid"), "weight",
                     (F.col("participant") == best).alias("_best"))
    any_elig = flagged.agg(F.coalesce(F.bool_or("eligible"), F.lit(False))).scalar()
    # ord: eligible uids ascending, best moved last.  The vector has one row
    # per eligible participant (bounded by the registry), so one ordered
    # window over it is cheap.
    out = (vec.filter(any_elig)
           .withColumn("ord", (F.row_number().over(Window.orderBy("_best", "uid")) - 1).cast("int"))
           .drop("_best"))
    return out.unionByName(one.filter(~any_elig))


def report_weights(spark: SparkSession, flagged: DataFrame, dom: DataFrame, n_envs: int,
                   idle: DataFrame | None = None) -> DataFrame:
    """Weights shown in the report when nobody is eligible: 1.0 for the
    best candidate, 0.0 for everyone else."""
    best = best_participant(flagged, dom, n_envs, idle)
    return spark.range(1).select(best.cast("bigint").alias("uid"), F.lit(1.0).alias("weight"))


def leaderboard(flagged: DataFrame, winners: DataFrame, weights_df: DataFrame,
                envs: Sequence[str], string_sort: bool = False, model_width: int = 30,
                burn: float = 0.0, base: int = 0) -> DataFrame:
    """One report row per active participant.

    Env cells "{100*acc:.2f}/{n}", starred for the env winner; L1..LE,
    points, eligibility, weight.  Eligible rows first, then by points
    descending (``string_sort`` reproduces the nobody-eligible ordering on
    the formatted points, uid descending).  A burn makes the base eligible,
    as it gets weight."""
    k = len(envs)
    if burn > 0:
        any_elig = flagged.agg(F.coalesce(F.bool_or("eligible"), F.lit(False))).scalar()
        flagged = flagged.withColumn("eligible", F.col("eligible") | (any_elig & (F.col("participant") == base)))
    pts = D.layer_points(winners, k)
    won = (winners.filter(F.col("size") == 1)
           .groupBy(F.col("winner").alias("participant"))
           .agg(F.collect_set(F.log2("S").cast("int")).alias("won")))   # at most E per row
    s = with_accuracy(flagged).join(pts, "participant", "left").join(won, "participant", "left")
    cols = [F.col("participant").alias("uid"),
            F.substring(F.col("latest.model").cast("string"), 1, model_width).alias("model"),
            F.substring(F.coalesce(F.col("latest.revision"), F.lit("None")), 1, 5).alias("rev")]
    for i, e in enumerate(envs):
        won = F.array_contains(F.coalesce("won", F.array().cast("array<int>")), i)
        cols.append(report_cell(F.col("acc")[i], F.col("n")[i], won).alias(e))
    for j in range(1, k + 1):
        cols.append(F.format_string("%.1f", F.bround(F.coalesce(F.col(f"L{j}"), F.lit(0.0)), 1)).alias(f"L{j}"))
    cols += [F.format_string("%.2f", F.bround(F.coalesce("points", F.lit(0.0)), 2)).alias("pts"),
             F.when(F.col("eligible"), "Y").otherwise("N").alias("elig"),
             F.coalesce("points", F.lit(0.0)).alias("_p"), F.col("eligible").alias("_e")]
    rep = s.select(*cols)
    wv = weights_df.select(F.col("uid"), F.col("weight"))
    rep = rep.join(wv, "uid", "left").withColumn(
        "wgt", F.format_string("%.4f", F.bround(F.coalesce("weight", F.lit(0.0)), 4))).drop("weight")
    if string_sort:
        order = [F.desc("pts"), F.desc("uid")]
    else:
        order = [F.desc("_e"), F.desc("_p"), F.asc("uid")]
    rep = rep.withColumn("rank", F.row_number().over(Window.orderBy(*order)).cast("int"))
    return rep.drop("_p", "_e")
