"""Registered queries: one builder per inventory operator, each reading the
driver's tables through the fixture views.  ``(spark, sf_dir) -> DataFrame``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankforge import fixtures as fx
from rankforge.config import ScoringConfig
from rankforge.operators import dominance as D
from rankforge.operators import participants as PT
from rankforge.operators import results as R
from rankforge.plans import scoring as P
from rankforge.session import materialize

# ---- fixed values: the env domains of the fixture views --------------------
OR_ENVS = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
LI_ENVS = ("AF", "AO", "NF", "NO", "RF", "RO")
EV_ENVS = ("click", "error", "purchase", "signup", "view")
LI_MIN_SAMPLES = 85
EV_FAMILY = "core"
# -----------------------------------------------------------------------------

LI_CFG = ScoringConfig(min_samples=LI_MIN_SAMPLES, scale=0.5, burn=0.9)


def _nation_registry(spark, sf):
    return fx.table(spark, sf, "nation").selectExpr("CAST(n_nationkey AS BIGINT) AS uid",
                                                    "n_name AS hotkey")


# ---- X2 on FX-OR: dense grid (B4, D1, D2) -----------------------------------
def grid_or(spark: SparkSession, sf: str) -> DataFrame:
    reg = _nation_registry(spark, sf)
    summ = R.sample_grid(fx.fx_or(spark, sf), reg, OR_ENVS, version=())
    return R.dense_grid(summ, reg, OR_ENVS).select("participant", "env", "n", "succ", "acc")


# ---- X2 on FX-EV: current run, family, first block (B4 B5 E1 E2 E3 D1 D2) ---
def ev_summary(spark, sf):
    return R.sample_grid(fx.fx_ev(spark, sf), fx.registry(spark, sf), EV_ENVS,
                         base=0, family=EV_FAMILY)


def grid_ev(spark: SparkSession, sf: str) -> DataFrame:
    return R.dense_grid(ev_summary(spark, sf), fx.registry(spark, sf), EV_ENVS)


def grid_rollup_ev(spark: SparkSession, sf: str) -> DataFrame:
    """The same grid from stored summaries: the log comes in three parts, and
    each refresh reads the newest stored day and what follows it."""
    from rankforge.operators import rollup as RU
    from rankforge.sources.results_log import scratch_path
    log, path = fx.fx_ev(spark, sf), scratch_path(spark, "rollup")
    reg = fx.registry(spark, sf)
    lo, hi = log.agg(F.min("epoch_day"), F.max("epoch_day")).first()
    for part in (1, 2, 3):
        there = log.filter(F.col("epoch_day") <= lo + (hi - lo) * part // 3)
        rows = R.family_filter(there, EV_FAMILY, 0)
        stored = RU.refresh(rows, path, EV_ENVS, F.col("epoch_day"))
    summ = RU.merge_runs(R.member_filter(stored, reg), len(EV_ENVS))
    return R.dense_grid(summ, reg, EV_ENVS)


def run_rows_ev(spark: SparkSession, sf: str) -> DataFrame:
    """E1 alone: rows in each participant's current run (no filters)."""
    run = R.current_run(fx.fx_ev(spark, sf))
    return run.groupBy("participant").agg(F.count(F.lit(1)).alias("rows"),
                                          F.min("seq_id").alias("first_seq"),
                                          F.min("block").alias("first_block"))


def latest_ev(spark: SparkSession, sf: str) -> DataFrame:
    """Last result per participant after filters."""
    s = ev_summary(spark, sf)
    return s.select("participant", "latest.model", "latest.revision")


# ---- FX-LI summary + eligibility (D3, D4, C5) -------------------------------
def li_summary(spark, sf):
    li = fx.fx_li(spark, sf).withColumn("success", F.lit(True))
    return R.participant_summary(li, LI_ENVS, latest=())


def li_flagged(spark, sf, cfg: ScoringConfig = LI_CFG):
    # the summary (one row per participant) is read three times by the
    # eligibility plan and its scalar subqueries: cut it once, scan the log once
    summ = materialize(li_summary(spark, sf))
    attrs = fx.fx_li_attrs(fx.fx_li(spark, sf))
    summ = summ.join(attrs.select("participant", "first_block"), "participant", "left")
    q = attrs.filter("queryable").select("participant")
    return D.eligibility(summ, q, len(LI_ENVS), cfg)


def eligibility_li(spark: SparkSession, sf: str) -> DataFrame:
    return li_flagged(spark, sf).select("participant", "queryable", "eligible", "in_pool")


def required_li(spark: SparkSession, sf: str) -> DataFrame:
    r = D.required_samples(li_summary(spark, sf), len(LI_ENVS), LI_CFG)
    return r.select(F.posexplode("required").alias("env_idx", "required")).select(
        F.element_at(F.array(*[F.lit(e) for e in LI_ENVS]), F.col("env_idx") + 1).alias("env"),
        F.col("required").cast("int").alias("required"))


# ---- X3 on FX-LI: subset winners and points (C4 D5-D10 M1-M4) ---------------
def _li_scored(spark, sf, cfg=LI_CFG):
    fl = materialize(li_flagged(spark, sf, cfg))
    winners, dom = P.score(fl, len(LI_ENVS), cfg)
    return fl, winners, dom


def winners_li(spark: SparkSession, sf: str) -> DataFrame:
    _, w, _ = _li_scored(spark, sf)
    return w


def dominance_li(spark: SparkSession, sf: str) -> DataFrame:
    """Full-env-set dominance counts (zero rows included for the pool)."""
    fl, _, dom = _li_scored(spark, sf)
    full = (1 << len(LI_ENVS)) - 1
    pool = fl.filter("in_pool").select("participant")
    d = dom.filter(F.col("S") == full).select("participant", "dom")
    return pool.join(d, "participant", "left").select(
        "participant", F.coalesce("dom", F.lit(0)).cast("bigint").alias("dom"))


def points_li(spark: SparkSession, sf: str) -> DataFrame:
    _, w, _ = _li_scored(spark, sf)
    return D.layer_points(w, len(LI_ENVS))


def env_winners_li(spark: SparkSession, sf: str) -> DataFrame:
    _, w, _ = _li_scored(spark, sf)
    return D.env_winners(w, LI_ENVS)


# ---- X4 / X5 on FX-LI ---------------------------------------------------------
def weights_li(spark: SparkSession, sf: str) -> DataFrame:
    fl, w, dom = _li_scored(spark, sf)
    return P.weights(spark, fl, w, dom, len(LI_ENVS), LI_CFG, base=0)


def weights_li_noburn(spark: SparkSession, sf: str) -> DataFrame:
    cfg = ScoringConfig(min_samples=LI_MIN_SAMPLES, scale=1.0, burn=0.0)
    fl, w, dom = _li_scored(spark, sf, cfg)
    return P.weights(spark, fl, w, dom, len(LI_ENVS), cfg, base=0)


def leaderboard_li(spark: SparkSession, sf: str) -> DataFrame:
    fl, w, dom = _li_scored(spark, sf)
    wt = P.weights(spark, fl, w, dom, len(LI_ENVS), LI_CFG, base=0)
    fl = fl.withColumn("latest", F.struct(F.lit("org/model").alias("model"),
                                          F.lit("main").alias("revision")))
    return P.leaderboard(fl, w, wt, LI_ENVS)


# ---- participants (X1 and parts) over the derived metadata world ------------
# fixed value: the blacklist parameter, as the raw comma text an operator sets
BLACKLIST_TEXT = " Customer#000000001, ,Customer#000000007 ,,"


def _world_latest(spark, sf):
    return PT.latest_commitment(fx.world_registry(spark, sf), fx.world_commits(spark, sf))


def commit_latest_world(spark: SparkSession, sf: str) -> DataFrame:
    return _world_latest(spark, sf)


def gate_world(spark: SparkSession, sf: str) -> DataFrame:
    return PT.gate_filter(_world_latest(spark, sf), fx.world_gating(spark, sf)).select("uid", "model")


def weights_shas_world(spark: SparkSession, sf: str) -> DataFrame:
    return PT.weights_shas(fx.world_files(spark, sf))


def deploy_world(spark: SparkSession, sf: str) -> DataFrame:
    d = PT.deployment_filter(_world_latest(spark, sf), fx.world_deployments(spark, sf))
    return d.select("uid", "model", "revision", "slug")


def _participants_world(spark, sf, check):
    p = PT.participants(spark, fx.world_registry(spark, sf), fx.world_commits(spark, sf),
                        fx.world_gating(spark, sf), fx.world_files(spark, sf),
                        fx.world_deployments(spark, sf), PT.parse_blacklist(BLACKLIST_TEXT),
                        check_validity=check)
    return p.select("uid", "hotkey", "block", "model", "revision")


def participants_world(spark: SparkSession, sf: str) -> DataFrame:
    return _participants_world(spark, sf, True)


def participants_world_nocheck(spark: SparkSession, sf: str) -> DataFrame:
    return _participants_world(spark, sf, False)


def claims_doc(spark: SparkSession, sf: str) -> DataFrame:
    return PT.earliest_claims(fx.fx_doc_claims(spark, sf), hashes="hashes").select("uid")


def best_model_doc(spark: SparkSession, sf: str) -> DataFrame:
    return PT.best_per_model(fx.fx_doc_claims(spark, sf)).select("uid", "model")


def participants_doc(spark: SparkSession, sf: str) -> DataFrame:
    c = PT.earliest_claims(fx.fx_doc_claims(spark, sf), hashes="hashes")
    return PT.best_per_model(c).select("uid", "model", "block")


# ---- X3-X5 on FX-EV: the versioned log with the live scale/burn ----------------------
EV_CFG = ScoringConfig(scale=0.5, burn=0.9)


def _ev_scored(spark, sf, cfg: ScoringConfig = EV_CFG):
    summ = materialize(ev_summary(spark, sf))    # one pass over the log, reused below
    queryable = fx.registry(spark, sf).filter("uid % 7 <> 0").select(F.col("uid").alias("participant"))
    fl = materialize(D.eligibility(summ, queryable, len(EV_ENVS), cfg))
    winners, dom = P.score(fl, len(EV_ENVS), cfg)
    return fl, winners, dom


def winners_ev(spark: SparkSession, sf: str) -> DataFrame:
    _, w, _ = _ev_scored(spark, sf)
    return w


def weights_ev(spark: SparkSession, sf: str) -> DataFrame:
    fl, w, dom = _ev_scored(spark, sf)
    return P.weights(spark, fl, w, dom, len(EV_ENVS), EV_CFG, base=0)


def leaderboard_ev(spark: SparkSession, sf: str) -> DataFrame:
    """Nobody is eligible under the default sample rule: the report shows
    1.0 for the best candidate and sorts on the formatted points."""
    fl, w, dom = _ev_scored(spark, sf)
    rw = P.report_weights(spark, fl, dom, len(EV_ENVS))
    return P.leaderboard(fl, w, rw, EV_ENVS, string_sort=True, model_width=50)


QUERIES = {
    "grid_or": grid_or,
    "grid_ev": grid_ev,
    "grid_rollup_ev": grid_rollup_ev,
    "run_rows_ev": run_rows_ev,
    "latest_ev": latest_ev,
    "eligibility_li": eligibility_li,
    "required_li": required_li,
    "winners_li": winners_li,
    "dominance_li": dominance_li,
    "points_li": points_li,
    "env_winners_li": env_winners_li,
    "weights_li": weights_li,
    "weights_li_noburn": weights_li_noburn,
    "winners_ev": winners_ev,
    "weights_ev": weights_ev,
    "leaderboard_ev": leaderboard_ev,
    "commit_latest_world": commit_latest_world,
    "gate_world": gate_world,
    "weights_shas_world": weights_shas_world,
    "deploy_world": deploy_world,
    "participants_world": participants_world,
    "participants_world_nocheck": participants_world_nocheck,
    "claims_doc": claims_doc,
    "best_model_doc": best_model_doc,
    "participants_doc": participants_doc,
}
