"""Fixed values and schemas for pitch tables.

The lists below are FIXED VALUES that must equal the original project's
configuration for results to agree (labels, bounds, feature order, roster).
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES (must match the original configuration exactly)
# ---------------------------------------------------------------------------
STRIKE_DESCRIPTIONS = [
    "called_strike",
    "swinging_strike",
    "swinging_strike_blocked",
    "foul",
    "foul_tip",
    "missed_bunt",
]
BALL_DESCRIPTIONS = [
    "ball",
    "blocked_ball",
    "intent_ball",
    "ball_in_dirt",
    "pitchout",
    "hit_by_pitch",
]
MIN_RELEASE_SPEED = 60.0
MAX_RELEASE_SPEED = 105.0
RANDOM_STATE = 42
DEFAULT_START_DATE = "2023-03-25"
DEFAULT_END_DATE = "2023-10-01"

REQUIRED_COLUMNS = [
    "description",
    "release_speed",
    "plate_x",
    "plate_z",
    "balls",
    "strikes",
    "pitch_type",
    "stand",
    "p_throws",
    "inning_topbot",
    "outs_when_up",
    "on_1b",
    "on_2b",
    "on_3b",
    "sz_top",
    "sz_bot",
    "pfx_x",
    "pfx_z",
]
CRITICAL_COLUMNS = ["plate_x", "plate_z", "balls", "strikes", "is_strike"]

CATEGORICAL_FEATURES = ["pitch_type", "stand", "p_throws", "inning_topbot"]
NUMERIC_CONTEXT = ["balls", "strikes", "outs_when_up", "on_1b", "on_2b", "on_3b"]
NUMERIC_PITCH = ["release_speed", "pfx_x", "pfx_z", "plate_x", "plate_z", "sz_top", "sz_bot"]
ENGINEERED_FEATURES = ["zone_mid", "dist_to_zone_center"]
NUMERIC_FEATURES = NUMERIC_CONTEXT + NUMERIC_PITCH + ENGINEERED_FEATURES

# Rule-book strike zone used by the 3x3 grid (feet).
ZONE_LEFT, ZONE_RIGHT = -0.83, 0.83
ZONE_BOTTOM, ZONE_TOP = 1.5, 3.5

# Default pitcher roster: first, last, throwing hand.
PITCHERS = [
    {"first": "Gerrit", "last": "Cole", "throws": "R"},
    {"first": "Corbin", "last": "Burnes", "throws": "R"},
    {"first": "Logan", "last": "Webb", "throws": "R"},
    {"first": "Spencer", "last": "Strider", "throws": "R"},
    {"first": "Zack", "last": "Wheeler", "throws": "R"},
    {"first": "Luis", "last": "Castillo", "throws": "R"},
    {"first": "Sonny", "last": "Gray", "throws": "R"},
    {"first": "Tyler", "last": "Glasnow", "throws": "R"},
    {"first": "Clayton", "last": "Kershaw", "throws": "L"},
    {"first": "Blake", "last": "Snell", "throws": "L"},
    {"first": "Max", "last": "Fried", "throws": "L"},
    {"first": "Framber", "last": "Valdez", "throws": "L"},
    {"first": "Jordan", "last": "Montgomery", "throws": "L"},
    {"first": "Justin", "last": "Steele", "throws": "L"},
]
# ---------------------------------------------------------------------------

_STR, _DBL, _INT = T.StringType(), T.DoubleType(), T.IntegerType()

RAW_PITCH_SCHEMA = T.StructType(
    [
        T.StructField("game_date", T.DateType(), True),
        T.StructField("description", _STR, True),
        T.StructField("release_speed", _DBL, True),
        T.StructField("plate_x", _DBL, True),
        T.StructField("plate_z", _DBL, True),
        T.StructField("balls", _INT, True),
        T.StructField("strikes", _INT, True),
        T.StructField("pitch_type", _STR, True),
        T.StructField("stand", _STR, True),
        T.StructField("p_throws", _STR, True),
        T.StructField("inning_topbot", _STR, True),
        T.StructField("outs_when_up", _INT, True),
        T.StructField("on_1b", _DBL, True),
        T.StructField("on_2b", _DBL, True),
        T.StructField("on_3b", _DBL, True),
        T.StructField("sz_top", _DBL, True),
        T.StructField("sz_bot", _DBL, True),
        T.StructField("pfx_x", _DBL, True),
        T.StructField("pfx_z", _DBL, True),
    ]
)

METRICS_SCHEMA = T.StructType(
    [
        T.StructField("model", _STR, False),
        T.StructField("accuracy", _DBL, True),
        T.StructField("precision", _DBL, True),
        T.StructField("recall", _DBL, True),
        T.StructField("f1", _DBL, True),
        T.StructField("roc_auc", _DBL, True),
    ]
)


def require_columns(df, columns, what="input"):
    """Raise ValueError listing missing and available columns (no Spark job)."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(
            f"{what} lacks required columns {missing}; it has {list(df.columns)}"
        )
    return df
