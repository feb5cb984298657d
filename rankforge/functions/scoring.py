"""Scoring math as Column expressions (M1-M5) and the numpy twin used by the
tiled pair kernel.  Both follow the same operation order so results agree
bit for bit with a plain double evaluation."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from rankforge.config import ScoringConfig

_DEF = ScoringConfig()


def _var(ai, ni, aj, nj, cap):
    ni_e = F.least(ni.cast("bigint"), F.lit(cap))
    nj_e = F.least(nj.cast("bigint"), F.lit(cap))
    pi, pj = clip01(ai), clip01(aj)
    return (pi * (1 - pi)) / F.greatest(ni_e, F.lit(1)) + (pj * (1 - pj)) / F.greatest(nj_e, F.lit(1))


def threshold_not_worse(ai: Column, ni: Column, aj: Column, nj: Column,
                        cfg: ScoringConfig = _DEF) -> Column:
    """M1: tolerance for 'not worse' on one env."""
    if cfg.z_not_worse <= 0:
        return F.lit(cfg.eps_floor)
    v = _var(ai, ni, aj, nj, cfg.sample_count_cap)
    return F.greatest(F.lit(cfg.eps_floor), F.lit(cfg.z_not_worse) * F.sqrt(F.greatest(v, F.lit(0.0))))


def threshold_better(ai: Column, ni: Column, aj: Column, nj: Column, nw: Column,
                     cfg: ScoringConfig = _DEF) -> Column:
    """M2: margin to claim 'better' on one env, never above ``nw``."""
    if cfg.z_win > 0:
        v = _var(ai, ni, aj, nj, cfg.sample_count_cap)
        t = F.greatest(F.lit(cfg.eps_win), F.lit(cfg.z_win) * F.sqrt(F.greatest(v, F.lit(0.0))))
    else:
        t = F.lit(cfg.eps_win)
    return F.least(t, nw)


def env_verdict(ai: Column, ni: Column, aj: Column, nj: Column,
                cfg: ScoringConfig = _DEF) -> Column:
    """M3 on one env: struct(worse, better, tie)."""
    nw = threshold_not_worse(ai, ni, aj, nj, cfg)
    bet = threshold_better(ai, ni, aj, nj, nw, cfg)
    return F.struct((ai < aj - nw).alias("worse"), (ai >= aj + bet).alias("better"),
                    (~(F.abs(ai - aj) > nw)).alias("tie"))


def layer_weight(s: Column, scale: float) -> Column:
    """M4: K_1 = scale, K_s = scale * 2^s for s >= 2."""
    return F.when(s == 1, F.lit(float(scale))).otherwise(F.lit(float(scale)) * F.pow(F.lit(2.0), s))


def clip01(x: Column) -> Column:
    """M5; null counts as 0."""
    return F.least(F.greatest(x, F.lit(0.0)), F.lit(1.0))


# ---- numpy twin (used inside the pair kernel) ------------------------------
def np_masks(acc_a, n_a, acc_b, n_b, cfg: ScoringConfig = _DEF):
    """Bit masks over envs for every (a, b) of two blocks.

    acc_*: float (k, E), n_*: int (k, E).  Returns (ka, kb) integer masks:
    not-worse, better, tie (bit e set when the env e verdict holds)."""
    def spread(acc, n):
        p = np.minimum(np.maximum(acc, 0.0), 1.0)
        return (p * (1 - p)) / np.maximum(np.minimum(n, cfg.sample_count_cap), 1)

    var_a, var_b = spread(acc_a, n_a), spread(acc_b, n_b)
    shape = (len(acc_a), len(acc_b))
    kind = np.uint8 if acc_a.shape[1] <= 8 else np.int64
    nw_m, bet_m, tie_m = (np.zeros(shape, dtype=kind) for _ in range(3))
    for e in range(acc_a.shape[1]):                    # one env at a time: temporaries of pairs, not pairs x envs
        ai, aj = acc_a[:, e][:, None], acc_b[:, e][None, :]
        sd = np.sqrt(np.maximum(var_a[:, e][:, None] + var_b[:, e][None, :], 0.0))
        nw = np.full(shape, cfg.eps_floor) if cfg.z_not_worse <= 0 else np.maximum(cfg.eps_floor, cfg.z_not_worse * sd)
        bet = np.maximum(cfg.eps_win, cfg.z_win * sd) if cfg.z_win > 0 else np.full(shape, cfg.eps_win)
        bet = np.minimum(bet, nw)
        bit = kind(1 << e)
        nw_m += (~(ai < aj - nw)) * bit
        bet_m += (ai >= aj + bet) * bit
        tie_m += (~(np.abs(ai - aj) > nw)) * bit
    return nw_m, bet_m, tie_m
