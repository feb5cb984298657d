"""DuckDB oracle SQL for the registered queries.

Written independently of the Spark plans: E1 uses the ordered
gaps-and-islands form, dominance an explicit pair self-join.  The oracle
is allowed to be slow; it only runs at sf0.01.
"""

from __future__ import annotations

from rankforge.fixtures import DUCK, duck_with
from rankforge.plans.catalog import EV_ENVS, LI_ENVS, LI_MIN_SAMPLES, OR_ENVS


def _envs(envs) -> str:
    rows = ", ".join(f"({i}, '{e}')" for i, e in enumerate(envs))
    return f"envs AS (SELECT * FROM (VALUES {rows}) t(i, env))"


# ---- grids -------------------------------------------------------------------
GRID_OR = duck_with("fx_or") + f""",
{_envs(OR_ENVS)},
reg AS (SELECT CAST(n_nationkey AS BIGINT) AS uid FROM nation),
g AS (SELECT participant, env, count(*) FILTER (WHERE success) AS n,
             coalesce(sum(score) FILTER (WHERE success), 0.0) AS succ
      FROM fx_or WHERE participant IN (SELECT uid FROM reg) GROUP BY ALL)
SELECT r.uid AS participant, e.env, CAST(coalesce(g.n, 0) AS BIGINT) AS n,
       coalesce(g.succ, 0.0) AS succ,
       CASE WHEN coalesce(g.n, 0) > 0 THEN g.succ / g.n ELSE 0.0 END AS acc
FROM reg r CROSS JOIN envs e LEFT JOIN g ON g.participant = r.uid AND g.env = e.env
"""

_EV_RUN = f""",
{DUCK['registry']},
{_envs(EV_ENVS)},
f AS (SELECT * FROM fx_ev
      WHERE participant IN (SELECT uid FROM registry)
        AND (participant = 0 OR starts_with(lower(regexp_replace(coalesce(model, 'None'),
                                                               '^[^/]*/', '')), 'core'))),
m AS (SELECT *, CASE WHEN lag(seq_id) OVER w IS NOT NULL
                      AND lag(model) OVER w IS NOT DISTINCT FROM model
                      AND lag(revision) OVER w IS NOT DISTINCT FROM revision
                     THEN 0 ELSE 1 END AS chg
      FROM f WINDOW w AS (PARTITION BY participant ORDER BY ts, seq_id)),
isl AS (SELECT *, sum(chg) OVER (PARTITION BY participant ORDER BY ts, seq_id
                                 ROWS UNBOUNDED PRECEDING) AS run FROM m),
cur AS (SELECT * FROM isl QUALIFY run = max(run) OVER (PARTITION BY participant))"""

GRID_EV = duck_with("fx_ev") + _EV_RUN + """,
s AS (SELECT participant, env, count(*) FILTER (WHERE success) AS n,
             coalesce(sum(score) FILTER (WHERE success), 0.0) AS succ FROM cur GROUP BY ALL),
p AS (SELECT participant, min(block) AS first_block FROM cur GROUP BY participant)
SELECT r.uid AS participant, e.env, CAST(coalesce(s.n, 0) AS BIGINT) AS n,
       coalesce(s.succ, 0.0) AS succ,
       CASE WHEN coalesce(s.n, 0) > 0 THEN s.succ / s.n ELSE 0.0 END AS acc,
       p.first_block, (p.participant IS NOT NULL) AS active
FROM registry r CROSS JOIN envs e
LEFT JOIN s ON s.participant = r.uid AND s.env = e.env
LEFT JOIN p ON p.participant = r.uid
"""

LATEST_EV = duck_with("fx_ev") + _EV_RUN + """
SELECT participant, model, revision FROM f
QUALIFY row_number() OVER (PARTITION BY participant ORDER BY ts DESC, seq_id DESC) = 1
"""

RUN_ROWS_EV = duck_with("fx_ev") + """,
m AS (SELECT *, CASE WHEN lag(seq_id) OVER w IS NOT NULL
                      AND lag(model) OVER w IS NOT DISTINCT FROM model
                      AND lag(revision) OVER w IS NOT DISTINCT FROM revision
                     THEN 0 ELSE 1 END AS chg
      FROM fx_ev WINDOW w AS (PARTITION BY participant ORDER BY ts, seq_id)),
isl AS (SELECT *, sum(chg) OVER (PARTITION BY participant ORDER BY ts, seq_id
                                 ROWS UNBOUNDED PRECEDING) AS run FROM m),
cur AS (SELECT * FROM isl QUALIFY run = max(run) OVER (PARTITION BY participant))
SELECT participant, count(*) AS rows, min(seq_id) AS first_seq, min(block) AS first_block
FROM cur GROUP BY participant
"""


# ---- FX-LI scoring -------------------------------------------------------------
def _li_core(min_samples: int) -> str:
    return duck_with("fx_li", "fx_li_attrs") + f""",
{_envs(LI_ENVS)},
g AS (SELECT participant, env, count(*) AS n, sum(score) AS succ FROM fx_li GROUP BY ALL),
act AS (SELECT DISTINCT participant FROM fx_li),
dense AS (SELECT a.participant, e.i, e.env, CAST(coalesce(g.n, 0) AS BIGINT) AS n,
                 coalesce(g.succ, 0.0) AS succ,
                 CASE WHEN coalesce(g.n, 0) > 0 THEN g.succ / g.n ELSE 0.0 END AS acc
          FROM act a CROSS JOIN envs e LEFT JOIN g ON g.participant = a.participant AND g.env = e.env),
req AS (SELECT i, any_value(env) AS env,
               greatest({min_samples},
                        10 + CAST(trunc(CAST(0.1 AS DOUBLE) * least(max(n), 2000)) AS INTEGER)) AS required
        FROM dense GROUP BY i),
el AS (SELECT d.participant, bool_and(d.n >= r.required) AS enough
       FROM dense d JOIN req r USING (i) GROUP BY d.participant),
fl0 AS (SELECT el.participant, a.queryable, (a.queryable AND el.enough) AS eligible, a.first_block
        FROM el JOIN fx_li_attrs a USING (participant)),
fl AS (SELECT *, CASE WHEN (SELECT bool_or(eligible) FROM fl0) THEN eligible ELSE queryable END
                 AS in_pool FROM fl0),
""" + _dominance_sql(len(LI_ENVS))


def _dominance_sql(n_envs: int) -> str:
    """Pairwise verdicts, subset dominance and winners over CTEs
    ``dense(participant, i, n, acc)`` and ``fl(participant, in_pool,
    first_block)`` (missing first block = +infinity)."""
    return f"""pool AS (SELECT d.participant, d.i, d.n, d.acc, coalesce(fl.first_block, 9223372036854775807) AS fb
         FROM dense d JOIN fl USING (participant) WHERE fl.in_pool),
pr AS (SELECT x.participant AS pa, y.participant AS pb, x.i, x.acc AS ai, x.n AS ni,
              y.acc AS aj, y.n AS nj, x.fb AS fa, y.fb AS fbb
       FROM pool x JOIN pool y ON x.i = y.i AND x.participant <> y.participant),
v AS (SELECT *, (p_i * (1 - p_i)) / greatest(least(ni, 1000), 1)
               + (p_j * (1 - p_j)) / greatest(least(nj, 1000), 1) AS var
      FROM (SELECT *, least(greatest(ai, 0.0), 1.0) AS p_i, least(greatest(aj, 0.0), 1.0) AS p_j FROM pr)),
t AS (SELECT *, greatest(CAST(0.005 AS DOUBLE), CAST(1.28 AS DOUBLE) * sqrt(greatest(var, 0.0))) AS nw FROM v),
t2 AS (SELECT *, least(greatest(CAST(0.015 AS DOUBLE), CAST(0.5 AS DOUBLE) * sqrt(greatest(var, 0.0))), nw) AS bet FROM t),
mk AS (SELECT pa, pb, any_value(fa) AS fa, any_value(fbb) AS fbb,
              CAST(sum(CASE WHEN NOT (ai < aj - nw) THEN (1 << i) ELSE 0 END) AS BIGINT) AS nw_m,
              CAST(sum(CASE WHEN ai >= aj + bet THEN (1 << i) ELSE 0 END) AS BIGINT) AS bet_m,
              CAST(sum(CASE WHEN NOT (abs(ai - aj) > nw) THEN (1 << i) ELSE 0 END) AS BIGINT) AS tie_m
       FROM t2 GROUP BY pa, pb),
subsets AS (SELECT range AS S FROM range(1, {1 << n_envs})),
dom AS (SELECT mk.pa AS participant, s.S, count(*) AS dom FROM mk, subsets s
        WHERE ((nw_m & S) = S AND (bet_m & S) <> 0) OR ((tie_m & S) = S AND fa < fbb)
        GROUP BY ALL),
cand AS (SELECT p.participant, p.fb, s.S, coalesce(d.dom, 0) AS dom
         FROM (SELECT DISTINCT participant, fb FROM pool) p CROSS JOIN subsets s
         LEFT JOIN dom d ON d.participant = p.participant AND d.S = s.S),
win AS (SELECT S, participant AS winner FROM cand
        QUALIFY row_number() OVER (PARTITION BY S ORDER BY dom DESC, fb ASC, participant ASC) = 1)"""


def _winners(scale: float) -> str:
    return f""",
wins AS (SELECT S, CAST(bit_count(S) AS INTEGER) AS size, winner,
                CASE WHEN bit_count(S) = 1 THEN CAST({scale} AS DOUBLE)
                     ELSE CAST({scale} AS DOUBLE) * pow(2, bit_count(S)) END AS points FROM win)"""


def _weights(scale: float, burn: float, base: int = 0, n_envs: int = len(LI_ENVS)) -> str:
    full = (1 << n_envs) - 1
    layers = ",\n       ".join(
        f"coalesce(sum(points) FILTER (WHERE size = {s}), 0.0) AS L{s}" for s in range(1, n_envs + 1))
    burn_sql = ""
    if burn > 0:
        burn_sql = f""",
wb0 AS (SELECT participant, weight * (CAST(1.0 AS DOUBLE) - CAST({burn} AS DOUBLE)) AS weight FROM w
        UNION ALL SELECT {base}, 0.0 WHERE {base} NOT IN (SELECT participant FROM w)),
wb AS (SELECT participant, CASE WHEN participant = {base} THEN weight + CAST({burn} AS DOUBLE)
                               ELSE weight END AS weight FROM wb0)"""
    else:
        burn_sql = """,
wb AS (SELECT * FROM w)"""
    return _winners(scale) + f""",
pts AS (SELECT winner AS participant, sum(points) AS points,
       {layers}
        FROM wins GROUP BY winner),
elw AS (SELECT fl.participant, coalesce(pts.points, 0.0) AS points
        FROM fl LEFT JOIN pts USING (participant) WHERE fl.eligible),
tot AS (SELECT coalesce(sum(points), 0.0) AS total FROM elw),
top AS (SELECT participant FROM elw ORDER BY points DESC, participant ASC LIMIT 1),
w AS (SELECT participant, CASE WHEN (SELECT total FROM tot) > 0 THEN points / (SELECT total FROM tot)
                               WHEN participant = (SELECT participant FROM top) THEN 1.0 ELSE 0.0 END
                          AS weight FROM elw){burn_sql},
dfull AS (SELECT participant, dom FROM dom WHERE S = {full}),
best AS (SELECT fl.participant FROM fl LEFT JOIN dfull USING (participant)
         ORDER BY CASE WHEN in_pool THEN 0 WHEN queryable THEN 1 ELSE 2 END,
                  coalesce(dfull.dom, 0) DESC, fl.first_block ASC, fl.participant ASC LIMIT 1),
vec AS (SELECT participant, weight FROM wb
        UNION ALL SELECT participant, 0.0 FROM best WHERE participant NOT IN (SELECT participant FROM wb)),
anyel AS (SELECT coalesce(bool_or(eligible), false) AS e FROM fl)"""


def _weights_sql(scale, burn):
    return _li_core(LI_MIN_SAMPLES) + _weights(scale, burn) + """
SELECT CAST(participant AS BIGINT) AS uid, weight,
       CAST(row_number() OVER (ORDER BY participant = (SELECT participant FROM best), participant) - 1
            AS INTEGER) AS ord
FROM vec WHERE (SELECT e FROM anyel)
UNION ALL SELECT CAST(0 AS BIGINT), 1.0, 0 WHERE NOT (SELECT e FROM anyel)
"""


ELIGIBILITY_LI = _li_core(LI_MIN_SAMPLES) + """
SELECT participant, queryable, eligible, in_pool FROM fl
"""

REQUIRED_LI = _li_core(LI_MIN_SAMPLES) + """
SELECT env, CAST(required AS INTEGER) AS required FROM req
"""

WINNERS_LI = _li_core(LI_MIN_SAMPLES) + _winners(0.5) + """
SELECT CAST(S AS BIGINT) AS S, size, CAST(winner AS BIGINT) AS winner, points FROM wins
"""

DOMINANCE_LI = _li_core(LI_MIN_SAMPLES) + f"""
SELECT p.participant, CAST(coalesce(d.dom, 0) AS BIGINT) AS dom
FROM (SELECT DISTINCT participant FROM pool) p
LEFT JOIN dom d ON d.participant = p.participant AND d.S = {(1 << len(LI_ENVS)) - 1}
"""

POINTS_LI = _li_core(LI_MIN_SAMPLES) + _weights(0.5, 0.9) + """
SELECT CAST(participant AS BIGINT) AS participant, points, L1, L2, L3, L4, L5, L6 FROM pts
"""

ENV_WINNERS_LI = _li_core(LI_MIN_SAMPLES) + _winners(0.5) + """
SELECT e.env, CAST(w.winner AS BIGINT) AS winner FROM wins w JOIN envs e ON w.S = (1 << e.i)
WHERE w.size = 1
"""

# ---- participants ----------------------------------------------------------------
_MAXB = 9223372036854775807
_LATEST = duck_with("world_registry", "world_commits", "world_gating", "world_files",
                    "world_deployments") + """,
latest AS (SELECT r.uid, r.hotkey, CASE WHEN r.uid = 0 THEN 0 ELSE c.block END AS block,
                  c.model, c.revision, c.chute_id
           FROM world_registry r JOIN (SELECT * FROM world_commits
                 QUALIFY row_number() OVER (PARTITION BY hotkey ORDER BY pos DESC) = 1) c USING (hotkey)),
gated AS (SELECT l.* FROM latest l JOIN world_gating g USING (model) WHERE g.gated = false),
shas AS (SELECT model, revision, list_sort(list_distinct(list(sha256))) AS weights_shas
         FROM world_files WHERE suffix(path, '.safetensors') AND sha256 IS NOT NULL GROUP BY ALL),
deployed AS (SELECT l.*, d.slug FROM latest l LEFT JOIN world_deployments d USING (chute_id)
             WHERE coalesce(d.hot AND d.name = l.model
                            AND (l.uid = 0 OR left(lower(split_part(d.name, '/', 2)), 6) = 'vector')
                            AND (d.revision IS NULL OR l.revision = d.revision), false))"""


def _x1(check: bool) -> str:
    src = "deployed" if check else "latest"
    return _LATEST + f""",
c0 AS (SELECT * FROM {src} WHERE hotkey NOT IN ('Customer#000000001', 'Customer#000000007')
       AND model IN (SELECT model FROM world_gating WHERE gated = false)),
c3 AS (SELECT c0.*, s.weights_shas FROM c0 LEFT JOIN shas s USING (model, revision)),
claims AS (SELECT DISTINCT uid, coalesce(block, {_MAXB}) AS b, unnest(weights_shas) AS h FROM c3),
firsts AS (SELECT h, uid FROM claims QUALIFY row_number() OVER (PARTITION BY h ORDER BY b, uid) = 1),
losers AS (SELECT DISTINCT c.uid FROM claims c JOIN firsts f USING (h) WHERE f.uid <> c.uid),
c4 AS (SELECT * FROM c3 WHERE uid NOT IN (SELECT uid FROM losers)),
best AS (SELECT uid FROM c4 WHERE model IS NOT NULL AND model <> ''
         QUALIFY row_number() OVER (PARTITION BY model ORDER BY coalesce(block, {_MAXB}), uid) = 1)
SELECT uid, hotkey, block, model, revision FROM c4 WHERE uid IN (SELECT uid FROM best)
"""


_DOC_E4 = duck_with("fx_doc_claims") + f""",
claims AS (SELECT DISTINCT uid, coalesce(block, {_MAXB}) AS b, unnest(hashes) AS h FROM fx_doc_claims),
firsts AS (SELECT h, uid FROM claims QUALIFY row_number() OVER (PARTITION BY h ORDER BY b, uid) = 1),
losers AS (SELECT DISTINCT c.uid FROM claims c JOIN firsts f USING (h) WHERE f.uid <> c.uid),
c4 AS (SELECT * FROM fx_doc_claims WHERE uid NOT IN (SELECT uid FROM losers))"""

# ---- FX-EV: X3-X5 on the versioned log (default eligibility: nobody eligible) ----------------
def _ev_core() -> str:
    return duck_with("fx_ev") + _EV_RUN + f""",
s AS (SELECT participant, env, count(*) FILTER (WHERE success) AS n,
             coalesce(sum(score) FILTER (WHERE success), 0.0) AS succ FROM cur GROUP BY ALL),
p AS (SELECT participant, min(block) AS first_block FROM cur GROUP BY participant),
lat AS (SELECT participant, model, revision FROM f
        QUALIFY row_number() OVER (PARTITION BY participant ORDER BY ts DESC, seq_id DESC) = 1),
act AS (SELECT DISTINCT participant FROM f),
dense AS (SELECT a.participant, e.i, e.env, CAST(coalesce(s.n, 0) AS BIGINT) AS n, coalesce(s.succ, 0.0) AS succ,
                 CASE WHEN coalesce(s.n, 0) > 0 THEN s.succ / s.n ELSE 0.0 END AS acc
          FROM act a CROSS JOIN envs e LEFT JOIN s ON s.participant = a.participant AND s.env = e.env),
req AS (SELECT i, greatest(100, 10 + CAST(trunc(CAST(0.1 AS DOUBLE) * least(max(n), 2000)) AS INTEGER)) AS required
        FROM dense GROUP BY i),
el AS (SELECT d.participant, bool_and(d.n >= r.required) AS enough FROM dense d JOIN req r USING (i)
       GROUP BY d.participant),
fl0 AS (SELECT el.participant, (el.participant % 7 <> 0) AS queryable,
               (el.participant % 7 <> 0) AND el.enough AS eligible, p.first_block
        FROM el JOIN p USING (participant)),
fl AS (SELECT *, CASE WHEN (SELECT bool_or(eligible) FROM fl0) THEN eligible ELSE queryable END AS in_pool
       FROM fl0),
""" + _dominance_sql(len(EV_ENVS)) + _weights(0.5, 0.9, n_envs=len(EV_ENVS))


WINNERS_EV = _ev_core() + """
SELECT CAST(S AS BIGINT) AS S, size, CAST(winner AS BIGINT) AS winner, points FROM wins"""

WEIGHTS_EV = _ev_core() + """
SELECT CAST(participant AS BIGINT) AS uid, weight,
       CAST(row_number() OVER (ORDER BY participant = (SELECT participant FROM best), participant) - 1
            AS INTEGER) AS ord
FROM vec WHERE (SELECT e FROM anyel)
UNION ALL SELECT CAST(0 AS BIGINT), 1.0, 0 WHERE NOT (SELECT e FROM anyel)"""


def _cell(i):
    return (f"CASE WHEN list_contains(won, {i}) THEN '*' ELSE '' END || "
            f"printf('%.2f/%d', acc[{i + 1}] * 100, n[{i + 1}]) || "
            f"CASE WHEN list_contains(won, {i}) THEN '*' ELSE '' END")


LEADERBOARD_EV = _ev_core() + f""",
grid AS (SELECT participant, list(acc ORDER BY i) AS acc, list(n ORDER BY i) AS n FROM dense GROUP BY participant),
wn AS (SELECT winner AS participant, list(CAST(log2(S) AS INTEGER)) AS won FROM wins WHERE size = 1
       GROUP BY winner),
rep AS (SELECT f.participant AS uid, f.eligible, substr(CAST(l.model AS VARCHAR), 1, 50) AS model,
               substr(coalesce(l.revision, 'None'), 1, 5) AS rev, coalesce(wn.won, []) AS won, g.acc, g.n,
               {", ".join(f"pts.L{s}" for s in range(1, len(EV_ENVS) + 1))},
               coalesce(pts.points, 0.0) AS p,
               CASE WHEN f.participant = (SELECT participant FROM best) THEN 1.0 ELSE 0.0 END AS w
        FROM fl f JOIN grid g USING (participant) JOIN lat l USING (participant)
        LEFT JOIN pts USING (participant) LEFT JOIN wn USING (participant)),
out AS (SELECT uid, model, rev, {", ".join(f"{_cell(i)} AS {e}" for i, e in enumerate(EV_ENVS))},
               {", ".join(f"printf('%.1f', coalesce(L{s}, 0.0)) AS L{s}" for s in range(1, len(EV_ENVS) + 1))},
               printf('%.2f', p) AS pts, CASE WHEN eligible THEN 'Y' ELSE 'N' END AS elig,
               printf('%.4f', w) AS wgt FROM rep)
SELECT *, CAST(row_number() OVER (ORDER BY pts DESC, uid DESC) AS INTEGER) AS rank FROM out"""

ORACLE = {
    "grid_or": GRID_OR,
    "grid_ev": GRID_EV,
    "grid_rollup_ev": GRID_EV,
    "run_rows_ev": RUN_ROWS_EV,
    "latest_ev": LATEST_EV,
    "eligibility_li": ELIGIBILITY_LI,
    "required_li": REQUIRED_LI,
    "winners_li": WINNERS_LI,
    "dominance_li": DOMINANCE_LI,
    "points_li": POINTS_LI,
    "env_winners_li": ENV_WINNERS_LI,
    "weights_li": _weights_sql(0.5, 0.9),
    "weights_li_noburn": _weights_sql(1.0, 0.0),
    "winners_ev": WINNERS_EV,
    "weights_ev": WEIGHTS_EV,
    "leaderboard_ev": LEADERBOARD_EV,
    "commit_latest_world": _LATEST + "\nSELECT * FROM latest",
    "gate_world": _LATEST + "\nSELECT uid, model FROM gated",
    "weights_shas_world": _LATEST + "\nSELECT * FROM shas",
    "deploy_world": _LATEST + "\nSELECT uid, model, revision, slug FROM deployed",
    "participants_world": _x1(True),
    "participants_world_nocheck": _x1(False),
    "claims_doc": _DOC_E4 + "\nSELECT uid FROM c4",
    "best_model_doc": duck_with("fx_doc_claims") + f"""
SELECT uid, model FROM fx_doc_claims WHERE model IS NOT NULL AND model <> ''
QUALIFY row_number() OVER (PARTITION BY model ORDER BY coalesce(block, {_MAXB}), uid) = 1""",
    "participants_doc": _DOC_E4 + f"""
SELECT uid, model, block FROM c4 WHERE model IS NOT NULL AND model <> ''
QUALIFY row_number() OVER (PARTITION BY model ORDER BY coalesce(block, {_MAXB}), uid) = 1""",
}
