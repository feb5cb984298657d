"""Operator defaults.

Fixed values that must equal the scoring rules being reproduced, stated
plainly and together.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---- fixed values (scoring rules) ----------------------------------------
WINDOW = 20                 # blocks per result-log window
TAIL = 20_000               # blocks of history read per recompute
ALPHA = 0.9                 # declared by the rules, never used
EPS_FLOOR = 0.005           # floor of the not-worse tolerance
Z_NOT_WORSE = 1.28          # z of the not-worse tolerance
EPS_WIN = 0.015             # floor of the better margin
Z_WIN = 0.5                 # z of the better margin
ELIG = 0.10                 # share of the busiest participant's samples required
SAMPLE_SLACK = 10           # added to that share
MIN_SAMPLES_PER_ENV = 100
MAX_SAMPLES_CAP = 2000
SAMPLE_COUNT_CAP = 1000
LIVE_SCALE = 0.5
LIVE_BURN = 0.9
GATING_TTL = 3600.0         # seconds
WEIGHTS_TTL = 3600.0        # seconds
CHALLENGE_MAX_USES = 30
SINK_BATCH = 300
SINK_MAX_WAIT = 300.0       # seconds
SINK_BUFFER = 100
DATA_LEN = 200
MAX_ROUND = 10
TEMPO = 100                 # blocks between recomputes
EPOCH_BLOCKS = 7200         # one day of 12-second blocks: the at-rest partition
TERMINAL_STATUS = (400, 404, 410)
ENV_PREFIXES = ("arena", "vector")
ACTIVE_ENVS = (
    "arena:webshop",
    "arena:alfworld",
    "arena:babyai",
    "arena:sciworld",
    "arena:textcraft",
    "vector:sat",
    "vector:ded",
    "vector:abd",
)
HEAVY_DEPLOYMENT_FIELDS = ("readme", "cords", "tagline", "instances")
MAX_BLOCK = (1 << 63) - 1   # null block sorts as +infinity
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class ScoringConfig:
    """Knobs of the scoring pipeline (defaults are the fixed values above)."""

    eps_floor: float = EPS_FLOOR
    z_not_worse: float = Z_NOT_WORSE
    eps_win: float = EPS_WIN
    z_win: float = Z_WIN
    elig: float = ELIG
    sample_slack: int = SAMPLE_SLACK
    min_samples: int = MIN_SAMPLES_PER_ENV
    max_samples_cap: int = MAX_SAMPLES_CAP
    sample_count_cap: int = SAMPLE_COUNT_CAP
    scale: float = 1.0
    burn: float = 0.0
    envs: tuple = field(default_factory=tuple)
