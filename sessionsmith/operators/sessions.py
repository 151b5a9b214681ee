"""Raw log -> session table (T4), in one scan and one large shuffle.

Plan (all keys carry the file and the account, so a file is processed on
its own like the source pipeline does, and every later aggregate is keyed
by a superset of the account):

1. ``session_grain``: ONE ``groupBy(file, account, session, date, orphan_time)`` over
   every raw row. It holds the validation counters of the rows, the
   session boundary (min/max time of all rows), min/max time of tracked
   rows, the 21 event counts and the latest level. All of it is algebraic,
   so the map side pre-aggregates before the shuffle and a hot account or
   session is cut down to one row per map task.
2. ``session_starts``: first tracked time per (file, account, session),
   taken from the grain, not from the raw rows.
3. ``attach_orphans``: delete-character events without a session get the
   next session start by an as-of join. They come out of the same grain
   aggregate (an extra key ``orphan_time`` that is null for every other
   row), so the raw logs are scanned exactly once.
4. ``session_table``: grain rows with a positive session and the attached
   orphans, combined per key; the boundary wins over tracked min/max.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.expressions import (
    parse_time,
    sql_code_match,
    sql_level_key,
    sql_minutes_between,
    sql_round_even,
    sql_tracked_code,
    tracked_code,
)
from .asof import asof_join

GRAIN_KEYS = [S.FILE, S.KEY, "session", "session_date"]
ORPHAN_TIME = "orphan_time"
# Hourly buckets: an as-of window group is one account's orphans and
# session starts within one hour, however hot the account is.
ORPHAN_BUCKET_SECONDS = 3600


def filter_codes(df: DataFrame) -> DataFrame:
    """Keep rows of tracked event codes (pushed to the Parquet scan)."""
    return df.where(tracked_code())


def parse_times(df: DataFrame, time: str = "time") -> DataFrame:
    """Add ``timestamp`` (TIMESTAMP_NTZ) and ``session_date`` (DATE)."""
    ts = parse_time(time)
    return df.withColumns({"timestamp": ts, "session_date": F.to_date(ts)})


def _event_counts(match: str = "") -> list[str]:
    """One count per tracked code, in dictionary order (SQL text)."""
    return [f"count_if({match}{sql_code_match(code)}) AS {label}" for code, label in S.EVENT_CODES]


def session_grain(logs: DataFrame) -> DataFrame:
    """Per (file, account, session, date): counters, boundaries, counts, level.

    ``logs`` is a raw T1 frame with ``source_file``. Rows with a null,
    zero or negative session form their own groups; they feed the file
    validation and are dropped from the session table. Orphan events are
    grouped by their exact time (``orphan_time``), one grain row per
    distinct time, so the as-of step can read them from the grain.
    The tracked-code predicate is projected once per row (``__tracked``)
    and reused by every aggregate that needs it.
    """
    orphan = f"{sql_code_match(S.ORPHAN_CODE)} AND session = 0"
    lvl_ok = "__tracked AND actor_level IS NOT NULL AND timestamp IS NOT NULL"
    aggs = [
        "count(1) AS n_rows",
        "count_if(time IS NULL) AS n_null_time",
        "count_if(session IS NULL) AS n_null_session",
        f"count_if({S.KEY} IS NULL) AS n_null_account",
        "count_if(logid IS NULL) AS n_null_logid",
        "count_if(time IS NOT NULL AND timestamp IS NULL) AS n_bad_time",
        "count_if(session < 0) AS n_neg_session",
        "count_if(actor_level < 0) AS n_neg_level",
        f"count_if(actor_level > {S.MAX_LEVEL}) AS n_high_level",
        "count_if(__tracked) AS n_tracked",
        "min(timestamp) AS b_first",
        "max(timestamp) AS b_last",
        "min(CASE WHEN __tracked THEN timestamp END) AS f_first",
        "max(CASE WHEN __tracked THEN timestamp END) AS f_last",
        *_event_counts(),
        f"max(CASE WHEN {lvl_ok} THEN {sql_level_key('timestamp', 'actor_level')} END) AS level_key",
    ]
    return (
        parse_times(logs)
        .withColumns(
            {
                "__tracked": F.expr(f"coalesce({sql_tracked_code()}, false)"),
                ORPHAN_TIME: F.expr(f"CASE WHEN {orphan} THEN timestamp END"),
            }
        )
        .groupBy(*GRAIN_KEYS, ORPHAN_TIME)
        .agg(*[F.expr(e) for e in aggs])
    )


def session_boundaries(grain: DataFrame) -> DataFrame:
    """T3: first/last time of ALL rows of each positive session and date."""
    return grain.where(F.col("session") > 0).select(
        *GRAIN_KEYS,
        F.col("b_first").alias("first_ts"),
        F.col("b_last").alias("last_ts"),
        F.col(S.KEY).alias("actor_id"),
    )


def session_starts(grain: DataFrame) -> DataFrame:
    """First tracked time of each (file, account, positive session), over all dates."""
    return (
        grain.where((F.col("session") > 0) & (F.col("n_tracked") > 0))
        .groupBy(S.FILE, S.KEY, "session")
        .agg(F.min("f_first").alias("start_ts"))
    )


def orphan_events(grain: DataFrame) -> DataFrame:
    """Tracked delete-character events that carry no session, one row per
    (file, account, exact time) with their count ``n`` and level key."""
    return grain.where(F.col(ORPHAN_TIME).isNotNull()).select(
        S.FILE,
        S.KEY,
        F.col(ORPHAN_TIME).alias("timestamp"),
        "session_date",
        F.col("n_tracked").alias("n_events"),
        "level_key",
    )


def attach_orphans(orphans: DataFrame, starts: DataFrame) -> DataFrame:
    """Give each orphan the session whose first tracked event is the nearest
    at or after it (ties: the smaller session); orphans without one drop.

    The orphan keeps its own timestamp and date.
    """
    return asof_join(
        orphans,
        starts.withColumnRenamed("session", "matched_session"),
        by=[S.FILE, S.KEY],
        left_time="timestamp",
        right_time="start_ts",
        direction="forward",
        how="inner",
        tie=["matched_session"],
        payload=["matched_session"],
        bucket_seconds=ORPHAN_BUCKET_SECONDS,
    ).withColumnRenamed("matched_session", "session")


def orphan_grain(attached: DataFrame) -> DataFrame:
    """Attached orphans rolled up to the grain keys (same columns as tracked rows)."""
    orphan_label = dict(S.EVENT_CODES)[S.ORPHAN_CODE]
    aggs = [
        "sum(n_events) AS n_tracked",
        "min(timestamp) AS f_first",
        "max(timestamp) AS f_last",
        *[
            ("sum(n_events)" if label == orphan_label else "CAST(0 AS BIGINT)") + f" AS {label}"
            for label in S.EVENT_LABELS
        ],
        "max(level_key) AS level_key",
    ]
    return attached.groupBy(*GRAIN_KEYS).agg(*[F.expr(e) for e in aggs])


def session_table(grain: DataFrame, attached_grain: DataFrame | None) -> DataFrame:
    """T4 session rows: positive sessions with at least one tracked event."""
    parts = grain.where((F.col("session") > 0) & F.col(ORPHAN_TIME).isNull()).select(
        *GRAIN_KEYS, "b_first", "b_last", "n_tracked", "f_first", "f_last", *S.EVENT_LABELS, "level_key"
    )
    if attached_grain is not None:
        parts = parts.unionByName(attached_grain, allowMissingColumns=True)
    aggs = [
        "min(b_first) AS b_first",
        "max(b_last) AS b_last",
        "sum(n_tracked) AS n_tracked",
        "min(f_first) AS f_first",
        "max(f_last) AS f_last",
        *[f"sum({c}) AS {c}" for c in S.EVENT_LABELS],
        "max(level_key) AS level_key",
    ]
    merged = parts.groupBy(*GRAIN_KEYS).agg(*[F.expr(e) for e in aggs]).where(F.col("n_tracked") > 0)
    first, last = "coalesce(b_first, f_first)", "coalesce(b_last, f_last)"
    return merged.selectExpr(
        S.FILE,
        "session",
        "session_date",
        f"{first} AS first_timestamp",
        f"{last} AS last_timestamp",
        S.KEY,
        f"CAST({sql_round_even(sql_minutes_between(first, last))} AS BIGINT) AS session_duration_minutes",
        "CAST(pmod(level_key, 128) AS INT) AS actor_level",
        *[f"CAST({c} AS BIGINT) AS {c}" for c in S.EVENT_LABELS],
    )


def sessions_from_grain(grain: DataFrame) -> DataFrame:
    """Whole session step from the grain (no quarantine)."""
    attached = attach_orphans(orphan_events(grain), session_starts(grain))
    return session_table(grain, orphan_grain(attached))
