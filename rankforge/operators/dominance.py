"""Eligibility and subset epsilon-Pareto dominance.

The pairwise test is all-pairs over the pool by definition (n(n-1) ordered
pairs); the pool is the eligible participants, bounded by the registry, not
by the size of the result log.  No pair row is ever materialised:

* the pool is hashed into T tiles; T grows with the pool up to what keeps all
  tasks busy, and beyond that only to bound a tile's rows (a scalar subquery);
* each pool row is sent to the 2T tile-pair groups it belongs to (as the
  "a" side of (tile, *) and the "b" side of (*, tile)): a 1-bucket theta
  join, replication 2T;
* one vectorised numpy kernel per group computes the env masks of every
  (a, b) of the group once, adds them to one histogram of masks per a and
  turns that into the counts of all subsets by superset sums; only non-zero
  (a, subset) counts leave the task, and Spark adds them across tiles.

Thresholds are computed once per pair, and no pair is ever tested against a
subset.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankforge.config import ScoringConfig
from rankforge.functions.scoring import layer_weight, np_masks
from rankforge.operators.results import argmax_id, argmax_key, fb_infinite

# pairs evaluated per numpy block (bounds kernel memory per task), and opponents among them
_BLOCK_PAIRS, _BLOCK_COLS = 1 << 15, 1 << 12
# pool rows per tile: at least / at most
_TILE_ROWS, _TILE_MOST = 128, 50_000


# ---- D3 / D4 ----------------------------------------------------------------
def required_samples(summary: DataFrame, n_envs: int, cfg: ScoringConfig) -> DataFrame:
    """One row: ``required`` array per env (D3).  max over *active*
    participants (rows of the summary), capped, then the 10% rule."""
    cols = []
    for i in range(n_envs):
        mx = F.coalesce(F.max(F.col("n")[i]), F.lit(0))
        mx = F.least(mx, F.lit(cfg.max_samples_cap))
        cols.append(F.greatest(F.lit(cfg.min_samples),
                               F.lit(cfg.sample_slack) + (F.lit(cfg.elig) * mx).cast("int")))
    return summary.agg(F.array(*cols).alias("required"))


def eligibility(summary: DataFrame, queryable: DataFrame | None, n_envs: int,
                cfg: ScoringConfig, key: str = "participant") -> DataFrame:
    """Adds ``queryable``, ``eligible`` and ``in_pool`` flags.

    ``queryable``: rows of the queryable table (semi join); None = everyone.
    pool = eligible if anyone is eligible, else queryable and active."""
    req = required_samples(summary, n_envs, cfg).select("required").scalar()
    s = summary
    if queryable is None:
        s = s.withColumn("queryable", F.lit(True))
    else:
        q = queryable.select(F.col(key).alias("_qk")).distinct().withColumn("_q", F.lit(True))
        s = (s.join(q, s[key] == q["_qk"], "left")
             .withColumn("queryable", F.coalesce("_q", F.lit(False))).drop("_qk", "_q"))
    s = s.withColumn("required", req)
    enough = F.lit(True)
    for i in range(n_envs):   # env count is a plan constant: no lambda needed
        enough = enough & (F.col("n")[i] >= F.col("required")[i])
    s = s.withColumn("eligible", F.col("queryable") & enough)
    any_elig = s.agg(F.coalesce(F.bool_or("eligible"), F.lit(False))).scalar()
    return s.withColumn("in_pool", F.when(any_elig, F.col("eligible")).otherwise(F.col("queryable")))


# ---- C4 + D5/D6 kernel --------------------------------------------------------
def superset_sums(h: np.ndarray) -> np.ndarray:
    """``out[:, S]`` = sum of ``h[:, M]`` over all masks M that contain S, for
    all S at once: one halving addition per env (zeta transform)."""
    out = h.copy()
    for bit in range(int(out.shape[1]).bit_length() - 1):
        v = out.reshape(len(out), -1, 2, 1 << bit)
        v[:, :, 0] += v[:, :, 1]
    return out


def subset_counts(acc_a, n_a, fb_a, id_a, acc_b, n_b, fb_b, id_b, cfg: ScoringConfig) -> np.ndarray:
    """(rows of a, 2^E): how many rows of b each row of a dominates on every
    env subset.

    With the masks nw (not worse), bet (better) and tie of a pair, a dominates
    b on S when S lies in nw and meets bet, or S lies in tie and a is earlier.
    By inclusion and exclusion that is, as 0/1 indicators of "M contains S",

        [nw] - [nw & ~bet] + earlier * ([tie] - [tie & nw] + [tie & nw & ~bet])

    so one signed histogram of masks per row of a and one zeta transform
    replace the test of every pair against every subset; memory per pair does
    not depend on the number of subsets."""
    k, masks = len(id_a), 1 << acc_a.shape[1]
    hist = np.zeros(k * masks, dtype=np.int64)
    rows = max(1, min(k, _BLOCK_PAIRS // min(len(id_b), _BLOCK_COLS)))
    for lo in range(0, k, rows):
        a = slice(lo, min(k, lo + rows))
        base = (np.arange(a.stop - lo, dtype=np.int64) * masks)[:, None]
        part = hist[lo * masks:a.stop * masks]

        def add(mask, sign, where=None):
            at = base + mask
            part[:] += sign * np.bincount((at if where is None else at[where]).ravel(), minlength=len(part))

        for at in range(0, len(id_b), _BLOCK_COLS):
            b = slice(at, at + _BLOCK_COLS)
            nw, bet, tie = np_masks(acc_a[a], n_a[a], acc_b[b], n_b[b], cfg)
            bet[id_a[a][:, None] == id_b[b][None, :]] = 0        # then a row's terms against itself cancel
            earlier = fb_a[a][:, None] < fb_b[b][None, :]
            plain = nw & ~bet
            add(nw, 1)
            add(plain, -1)
            add(tie & plain, 1, earlier)
            odd = earlier & (tie & ~nw != 0)                     # a tie that rounding calls worse
            if odd.any():
                add(tie, 1, odd)
                add(tie & nw, -1, odd)
    return superset_sums(hist.reshape(k, masks))


def _pair_counts_fn(n_envs: int, cfg: ScoringConfig):
    def side(pdf: pd.DataFrame):
        return (np.stack(pdf["acc"].to_numpy()).astype(np.float64), np.stack(pdf["n"].to_numpy()).astype(np.int64),
                pdf["fb"].to_numpy(dtype=np.int64), pdf["participant"].to_numpy(dtype=np.int64))

    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        a = pdf[pdf["_role"] == 0]
        b = pdf[pdf["_role"] == 1]
        if len(a) == 0 or len(b) == 0:
            return pd.DataFrame({c: pd.Series([], dtype="int64") for c in ("participant", "S", "dom")})
        left, right = side(a), side(b)
        cnt = subset_counts(*left, *right, cfg)
        cnt[:, 0] = 0                                  # the empty subset is none
        ia, js = np.nonzero(cnt)
        return pd.DataFrame({"participant": left[3][ia], "S": js.astype(np.int64), "dom": cnt[ia, js]})

    return fn


def dominance_counts(pool: DataFrame, n_envs: int, cfg: ScoringConfig,
                     key: str = "participant") -> DataFrame:
    """(participant, S, dom): number of pool members ``participant``
    dominates on env subset bitmask S; zero counts are absent.

    ``pool``: participant, acc array, n array, first_block."""
    p = pool.select(F.col(key).cast("bigint").alias("participant"), "acc", "n",
                    fb_infinite(F.col("first_block")).alias("fb"))
    n_pool = pool.agg(F.count(F.lit(1))).scalar()
    # enough tile pairs to keep every task busy; more only where a tile would get too large
    busy = math.ceil(math.sqrt(2 * int(pool.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    tiles = F.greatest(F.lit(1), F.ceil(n_pool / F.lit(_TILE_MOST)),
                       F.least(F.lit(busy), F.ceil(n_pool / F.lit(_TILE_ROWS)))).cast("int")
    p = p.withColumn("_t", F.pmod(F.xxhash64("participant"), tiles).cast("int"))
    others = F.explode(F.sequence(F.lit(0), tiles - 1))
    a_side = p.select("*", others.alias("_u")).select(
        F.col("_t").alias("_ta"), F.col("_u").alias("_tb"), F.lit(0).alias("_role"),
        "participant", "acc", "n", "fb")
    b_side = p.select("*", others.alias("_u")).select(
        F.col("_u").alias("_ta"), F.col("_t").alias("_tb"), F.lit(1).alias("_role"),
        "participant", "acc", "n", "fb")
    partial = (a_side.unionByName(b_side).groupBy("_ta", "_tb")
               .applyInPandas(_pair_counts_fn(n_envs, cfg),
                              "participant long, S long, dom long"))
    return partial.groupBy("participant", "S").agg(F.sum("dom").alias("dom"))


# ---- D7 - D10 ----------------------------------------------------------------
def subset_winners(pool: DataFrame, dom: DataFrame, n_envs: int, scale: float,
                   key: str = "participant") -> DataFrame:
    """(S, size, winner, points): the winner of every non-empty env subset.

    Argmax of (dominance count, -first_block), missing block = +inf, ties to
    the lowest id.  Every pool member is a candidate for every subset (a
    generator, not a join), so a pool of one wins with no pairs and an empty
    pool yields no rows."""
    cand = pool.select(F.col(key).cast("bigint").alias("participant"),
                       fb_infinite(F.col("first_block")).alias("fb"),
                       F.explode(F.sequence(F.lit(1).cast("bigint"),
                                            F.lit((1 << n_envs) - 1).cast("bigint"))).alias("S"))
    c = cand.join(dom, ["participant", "S"], "left").withColumn("dom", F.coalesce("dom", F.lit(0)))
    # argmax of (dom, -first_block, -id) over registry-sized rows
    w = c.groupBy("S").agg(F.max(argmax_key(F.col("dom"), F.col("fb"), F.col("participant"))).alias("_k")) \
        .select("S", argmax_id(F.col("_k")).alias("winner"))
    size = F.bit_count("S")
    return w.select("S", size.alias("size"), "winner",
                    layer_weight(size, scale).alias("points"))


def layer_points(winners: DataFrame, n_envs: int) -> DataFrame:
    """(participant, points, L1..LE): total and per-layer points."""
    agg = [F.sum("points").alias("points")]
    for s in range(1, n_envs + 1):
        agg.append(F.coalesce(F.sum(F.when(F.col("size") == s, F.col("points"))),
                              F.lit(0.0)).alias(f"L{s}"))
    return winners.groupBy(F.col("winner").alias("participant")).agg(*agg)


def env_winners(winners: DataFrame, envs: Sequence[str]) -> DataFrame:
    """(env, winner) from the size-1 subsets."""
    names = F.array(*[F.lit(e) for e in envs])
    idx = (F.log2(F.col("S")).cast("int"))
    return winners.filter(F.col("size") == 1).select(F.element_at(names, idx + 1).alias("env"),
                                                     "winner")
