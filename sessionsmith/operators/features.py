"""Session table (T4) -> account features (T5), snapshots and online view.

All per-account work is a ``groupBy`` with algebraic aggregates (count,
sum, sum of squares, min, max), so the map side pre-aggregates and a hot
account never arrives whole at one task. Standard deviation comes from
count / sum / sum of squares in exact decimal arithmetic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S
from ..functions.expressions import sql_days_between, sql_round_even, sql_sample_std

DUR = "session_duration_minutes"


def _is_integral(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))


def _partials(df: DataFrame, ts: str = "last_timestamp") -> list[Column]:
    """Algebraic partial aggregates of a session frame.

    Integer durations (the pipeline's) keep sums exact: BIGINT sum and a
    DECIMAL(38,0) sum of squares. Fractional durations use doubles.
    Event columns absent from the input count as 0. Written as SQL
    expression strings: one JVM call per column instead of one per node.
    """
    if _is_integral(df, DUR):
        d = f"CAST({DUR} AS BIGINT)"
        sq = f"CAST({d} AS DECIMAL(38,0)) * CAST({d} AS DECIMAL(38,0))"
    else:
        d = f"CAST({DUR} AS DOUBLE)"
        sq = f"{d} * {d}"
    have = set(df.columns)
    exprs = [
        f"min({ts}) AS __first",
        f"max({ts}) AS __last",
        f"count({ts}) AS __n",
        f"count({d}) AS __nd",
        f"sum({d}) AS __s",
        f"sum({sq}) AS __ss",
        f"min({d}) AS __min",
        f"max({d}) AS __max",
    ] + [
        (f"sum(CAST({c} AS BIGINT))" if c in have else "CAST(0 AS BIGINT)") + f" AS __e_{c}"
        for c in S.EVENT_LABELS
    ]
    return [F.expr(e) for e in exprs]


def _finish_exprs(integral: bool = True) -> list[str]:
    """Partials -> the 31 T5 columns (same rounding order as the source
    pipeline: lifespan rounded first, then divided into the session count)."""
    life = f"{sql_round_even(sql_days_between('__first', '__last'), 2)}"
    if integral:
        std = sql_sample_std("__nd", "__s", "__ss")
    else:
        std = "CASE WHEN __nd > 1 THEN sqrt(greatest((__ss - __s * __s / __nd) / (__nd - 1), 0.0D)) END"
    return [
        S.KEY,
        f"__last AS {S.EVENT_TIME}",
        "__n AS total_sessions",
        f"{life} AS account_lifespan_days",
        f"{sql_round_even(f'__n / CASE WHEN {life} = 0 THEN 1.0D ELSE {life} END', 2)} AS average_sessions_per_day",
        "__s AS total_playtime_minutes",
        f"{sql_round_even('__s / __nd', 2)} AS avg_session_duration_minutes",
        f"{sql_round_even(f'coalesce({std}, 0.0D)', 2)} AS std_session_duration_minutes",
        "__min AS min_session_duration_minutes",
        "__max AS max_session_duration_minutes",
    ] + [
        f"CAST(coalesce(__e_{c}, 0) AS BIGINT) AS {name}"
        for c, name in zip(S.EVENT_LABELS, S.ACCOUNT_EVENT_LABELS)
    ]


def _finish(df: DataFrame, integral: bool = True) -> DataFrame:
    return df.selectExpr(*_finish_exprs(integral))


def player_features(sessions: DataFrame, as_of=None) -> DataFrame:
    """T5: one row per account over all its sessions (ended by ``as_of`` if given).

    ``first_session_timestamp`` -- the earliest session END -- starts the
    lifespan; sessions per day divide by the rounded lifespan (0 -> 1).
    """
    if not isinstance(sessions.schema["last_timestamp"].dataType, T.TimestampNTZType):
        sessions = sessions.withColumn("last_timestamp", F.col("last_timestamp").cast("timestamp_ntz"))
    if as_of is not None:
        sessions = sessions.where(F.col("last_timestamp") <= F.lit(as_of).cast("timestamp_ntz"))
    integral = _is_integral(sessions, DUR)
    return _finish(sessions.groupBy(S.KEY).agg(*_partials(sessions)), integral)


def feature_snapshots(sessions: DataFrame) -> DataFrame:
    """Daily cumulative T5 rows: for each account and each day it ended a
    session, the features over all its sessions ended by that day.

    Sessions are first rolled up per (account, day), then a running window
    per account sums the day rows. The window holds one row per active
    day, so its size is bounded by the time span, not by the row count.
    """
    daily = sessions.groupBy(S.KEY, F.to_date("last_timestamp").alias("__day")).agg(*_partials(sessions))
    w = f"OVER (PARTITION BY {S.KEY} ORDER BY __day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    sums = ["__n", "__nd", "__s", "__ss", *[f"__e_{e}" for e in S.EVENT_LABELS]]
    run = daily.selectExpr(
        S.KEY,
        "__day",
        f"min(__first) {w} AS __first",
        f"max(__last) {w} AS __last",
        *[f"sum({c}) {w} AS {c}" for c in sums],
        f"min(__min) {w} AS __min",
        f"max(__max) {w} AS __max",
    )
    return _finish(run, _is_integral(sessions, DUR))


def feature_time_range(features: DataFrame, ts: str = S.EVENT_TIME) -> DataFrame:
    """Min / max event time, the range widened by one day, and the row count.

    Only the one time column is read.
    """
    t = F.col(ts)
    return features.select(t).agg(
        F.min(t).alias("min_time"),
        F.max(t).alias("max_time"),
        (F.min(t) - F.expr("INTERVAL 1 DAY")).alias("start_time"),
        (F.max(t) + F.expr("INTERVAL 1 DAY")).alias("end_time"),
        F.count(F.lit(1)).alias("total_records"),
    )


def latest_per_key(
    features: DataFrame,
    key: str = S.KEY,
    ts: str = S.EVENT_TIME,
    start=None,
    end=None,
) -> DataFrame:
    """Newest row per key with ``start <= ts <= end`` (the online view, T8).

    A ``groupBy`` with ``max(struct(ts, ...))`` pre-aggregates per map task,
    so a key with many rows is reduced before the shuffle; a window with
    ``row_number`` would sort the whole key in one task.
    """
    df = features
    if start is not None:
        df = df.where(F.col(ts) >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        df = df.where(F.col(ts) <= F.lit(end).cast("timestamp_ntz"))
    rest = [c for c in df.columns if c not in (key, ts)]
    best = df.groupBy(key).agg(F.max(F.struct(ts, *rest)).alias("__best"))
    return best.select(key, *[F.col(f"__best.{c}").alias(c) for c in [ts, *rest]]).select(
        *features.columns
    )


def latest_in_range(features: DataFrame, ts: str = S.EVENT_TIME) -> DataFrame:
    """Materialization: range from ``feature_time_range`` (+-1 day), then the
    newest row per key inside it. Both bounds come from one scalar
    subquery, so no value makes a round trip through the driver."""
    bounds = feature_time_range(features, ts).select(F.struct("start_time", "end_time")).scalar()
    inside = features.where(F.col(ts).between(bounds.getField("start_time"), bounds.getField("end_time")))
    return latest_per_key(inside, ts=ts)


def lookup_features(ids: DataFrame, online: DataFrame, key: str = S.KEY) -> DataFrame:
    """Features for a list of ids; an unknown id gives a row of nulls.

    A semi join first cuts the online table down to the asked ids. Where
    the id list is small, Spark broadcasts it by its measured size and the
    online table streams past it without a shuffle; only the hits are then
    joined back to the ids.
    """
    ids = ids.select(F.col(key).cast("string").alias(key))
    hits = online.join(ids.distinct(), key, "left_semi")
    return ids.join(hits, key, "left").select(key, *[c for c in online.columns if c != key])
