"""Table schemas, the event-code dictionary and the one feature list.

Every other module takes its column names and types from here, so the
raw-log contract (T1), the session table (T4), the account feature table
(T5) and the score table (T9) are declared exactly once.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --------------------------------------------------------------------------
# These must equal the source pipeline's for equal results.
# --------------------------------------------------------------------------

# Tracked event codes in dictionary order, as (logid, feature label).
EVENT_CODES: list[tuple[int, str]] = [
    (1012, "delete_pc"),
    (1013, "pc_level_up"),
    (1101, "invite_party"),
    (1103, "refuse_party"),
    (1102, "join_party"),
    (1202, "die"),
    (1404, "duel_end_pc"),
    (1406, "duel_end_team"),
    (1422, "party_battle_end_team"),
    (2112, "expand_warehouse"),
    (2141, "change_item_look"),
    (2301, "put_main_auction"),
    (2405, "use_gathering_item"),
    (5004, "complete_quest"),
    (5011, "complete_challenge_today"),
    (5015, "complete_challenge_week"),
    (6001, "create_guild"),
    (6002, "destroy_guild"),
    (6004, "invite_guild"),
    (6005, "join_guild"),
    (6009, "dismiss_guild"),
]

# Codes tracked only together with a detail code: (logid, log_detail_code).
DETAIL_CODES: list[tuple[int, int]] = [(1012, 1), (1102, 1)]

# The code of the "delete character" event that may arrive without a session.
ORPHAN_CODE = 1012

# Highest character level in the game.
MAX_LEVEL = 55

# Raw time text: Spark datetime pattern and the validation regex.
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS"
TIME_REGEX = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}\.\d{3}$"

# Columns that must not hold nulls, in the order they are reported.
CRITICAL_COLUMNS = ["time", "session", "actor_account_id", "logid"]

# Validation messages.
MSG_EMPTY = "DataFrame is empty"
MSG_MISSING = "Missing required columns: {cols}"
MSG_NULLS = "Null values found in critical columns: {cols}"
MSG_NOT_NUMERIC = "Column '{col}' must be numeric"
MSG_TIME_FORMAT = "Invalid timestamp format: {value}"
MSG_NEG_SESSION = "Column 'session' contains negative values"
MSG_NEG_LEVEL = "Column 'actor_level' contains negative values"
MSG_HIGH_LEVEL = "Column 'actor_level' contains values higher than the maximum in the game (>55)"
MSG_NO_SESSIONS = "No tracked events with a positive session"
# Own messages, for what the file reader itself finds.
MSG_UNREAD = "No rows could be read"
MSG_PARTLY = "Read only {rows} rows"

# Training step.
TEST_SIZE = 0.2
VAL_SIZE = 0.1
SEED = 42
THRESHOLD = 0.5
# Rounds without a lower validation loss after which training stops.
PATIENCE = 10

# Names of the account features that are not event counts.
ENGAGEMENT_FEATURES = [
    "total_sessions",
    "account_lifespan_days",
    "average_sessions_per_day",
    "total_playtime_minutes",
    "avg_session_duration_minutes",
    "std_session_duration_minutes",
    "min_session_duration_minutes",
    "max_session_duration_minutes",
]

# --------------------------------------------------------------------------
# Own defaults (not fixed values): Spark ML's boosted trees
# --------------------------------------------------------------------------

GBT_DEFAULTS = {
    "maxIter": 100,
    "stepSize": 0.05,
    "maxDepth": 5,
    "subsamplingRate": 0.8,
    "featureSubsetStrategy": "0.9",
    "minInstancesPerNode": 20,
}

# --------------------------------------------------------------------------
# Derived names
# --------------------------------------------------------------------------

TRACKED_LOGIDS = [code for code, _ in EVENT_CODES]
SIMPLE_LOGIDS = [code for code in TRACKED_LOGIDS if code not in dict(DETAIL_CODES)]
EVENT_LABELS = [label for _, label in EVENT_CODES]

# Session-level counts are named by label; account-level sums rename level ups.
ACCOUNT_EVENT_NAMES = {"pc_level_up": "level_ups_across_all_characters"}
ACCOUNT_EVENT_LABELS = [ACCOUNT_EVENT_NAMES.get(label, label) for label in EVENT_LABELS]

KEY = "actor_account_id"
EVENT_TIME = "last_session_timestamp"
LABEL = "churn_yn"
LABEL_TIME = "event_timestamp"
FILE = "source_file"

# The one feature list (29 names) used by training, lookup and scoring.
FEATURES = ENGAGEMENT_FEATURES + ACCOUNT_EVENT_LABELS
DOUBLE_FEATURES = {
    "account_lifespan_days",
    "average_sessions_per_day",
    "avg_session_duration_minutes",
    "std_session_duration_minutes",
}

# --------------------------------------------------------------------------
# StructTypes
# --------------------------------------------------------------------------

RAW_LOG = T.StructType(
    [
        T.StructField("time", T.StringType()),
        T.StructField("logid", T.IntegerType()),
        T.StructField("session", T.LongType()),
        T.StructField("log_detail_code", T.IntegerType()),
        T.StructField("actor_account_id", T.StringType()),
        T.StructField("actor_level", T.IntegerType()),
    ]
)
RAW_COLUMNS = [f.name for f in RAW_LOG.fields]

SESSION = T.StructType(
    [
        T.StructField(FILE, T.StringType()),
        T.StructField("session", T.LongType()),
        T.StructField("session_date", T.DateType()),
        T.StructField("first_timestamp", T.TimestampNTZType()),
        T.StructField("last_timestamp", T.TimestampNTZType()),
        T.StructField(KEY, T.StringType()),
        T.StructField("session_duration_minutes", T.LongType()),
        T.StructField("actor_level", T.IntegerType()),
    ]
    + [T.StructField(label, T.LongType()) for label in EVENT_LABELS]
)

ACCOUNT_FEATURES = T.StructType(
    [
        T.StructField(KEY, T.StringType()),
        T.StructField(EVENT_TIME, T.TimestampNTZType()),
    ]
    + [
        T.StructField(name, T.DoubleType() if name in DOUBLE_FEATURES else T.LongType())
        for name in FEATURES
    ]
)

LABELS = T.StructType(
    [
        T.StructField(KEY, T.StringType()),
        T.StructField(LABEL_TIME, T.TimestampNTZType()),
        T.StructField(LABEL, T.IntegerType()),
    ]
)

SCORES = T.StructType(
    [
        T.StructField(KEY, T.StringType()),
        T.StructField("churn_prediction", T.IntegerType()),
        T.StructField("churn_probability", T.DoubleType()),
    ]
)

FILE_STATUS = T.StructType(
    [
        T.StructField(FILE, T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("reason", T.StringType()),
    ]
)
