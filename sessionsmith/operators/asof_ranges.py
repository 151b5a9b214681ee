"""As-of join by a prefix scan over range partitions.

``asof_join`` cuts time into fixed buckets, so all rows of a key within one
minute still meet in one task. Here the data set the cuts: both sides
together are dealt out by ``(key, time)`` ranges of about equal size, so a
hot key, or a hot minute of a key, spans as many ranges as its rows need.
Inside a range a running window finds the match. A left row whose match
lies in an earlier range gets it from the carry: the last right row of each
range (one row per range), scanned once along the ranges and joined back.

Costs beside ``asof_join``: the inputs are read once more to sample the
bounds, and the dealt-out rows are written once, because the window and the
carry both read them and must see the same ranges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..context import Workspace, materialize

_K, _T, _SIDE, _R, _L, _P, _M, _C = (f"__scan_{c}" for c in ("k", "t", "side", "r", "l", "p", "m", "c"))
_RIGHT, _LEFT = 1, 0
#: Ranges per shuffle partition: more than one, so that the ranges of a hot key are dealt out evenly to the window's tasks.
RANGES_PER_PARTITION = 4


def asof_join_ranges(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    left_time: str,
    right_time: str,
    direction: str = "forward",
    how: str = "inner",
    tie: Sequence[str] = (),
    payload: Sequence[str] | None = None,
    tolerance_seconds: float | None = None,
    matched_time: str | None = None,
    allow_exact: bool = True,
    ranges: int | None = None,
    work: Workspace | None = None,
) -> DataFrame:
    """The rows of ``asof_join``, whose arguments these are, but for:

    Args:
        ranges: number of ranges (default: four per shuffle partition).
        work: owner of the dealt-out rows, which the result reads (default: the session's).

    Left rows with a null key or time match nothing and are set aside; right
    ones are left out. Left rows that are equal in all columns and come from
    one input partition stay in one range.
    """
    if direction not in ("forward", "backward"):
        raise ValueError("direction must be 'forward' or 'backward'")
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    spark = left.sparkSession
    fwd = direction == "forward"
    by, tie = list(by), list(tie)
    if payload is None:
        payload = [c for c in right.columns if c not in (*by, right_time, *tie)]
    payload = list(payload)
    ranges = ranges or RANGES_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))

    rows = _dealt_out(left, right, by, left_time, right_time, tie, payload, fwd, allow_exact, ranges)
    rows = materialize(rows, work)

    order = [_along(F.col(_T), fwd), _along(F.col(_SIDE), allow_exact), _along(F.col(_R), fwd)]
    seen = F.last(_R, ignorenulls=True).over(_window(order))
    matched = rows.withColumn(_M, seen).where(F.col(_SIDE) == _LEFT).select(_P, _K, _T, _L, _M)
    # One row per range at most, so its size is bounded by the number of ranges.
    carry = F.broadcast(_carry(rows, fwd))
    out = matched.join(carry, [_P, _K], "left").select(_T, _L, F.coalesce(_M, _C).alias(_M))

    if tolerance_seconds:
        ends = (_T, f"{_M}.t") if fwd else (f"{_M}.t", _T)
        near = F.expr(f"timestampdiff(MICROSECOND, {ends[0]}, {ends[1]})") <= int(tolerance_seconds * 1_000_000)
        out = out.withColumn(_M, F.when(near, F.col(_M)))
    if how == "inner":
        out = out.where(F.col(_M).isNotNull())
    columns = [F.col(f"{_L}.c{i}").alias(c) for i, c in enumerate(left.columns)]
    if matched_time:
        columns.append(F.col(f"{_M}.t").alias(matched_time))
    out = out.select(*columns, *[F.col(f"{_M}.p{i}").alias(c) for i, c in enumerate(payload)])
    if how == "left":
        out = out.unionByName(left.where(~_keyed(left, [left_time, *by])), allowMissingColumns=True)
    return out


def _along(column, descending):
    return column.desc() if descending else column.asc()


def _window(order):
    return Window.partitionBy(_P, _K).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _keyed(df: DataFrame, columns: list[str]):
    ok = F.lit(True)
    for c in columns:
        ok = ok & df[c].isNotNull()
    return ok


def _dealt_out(left, right, by, left_time, right_time, tie, payload, fwd, allow_exact, ranges) -> DataFrame:
    """Rows of both sides as (range, key, time, side, right row, left row), ranges numbered in the order of the scan."""
    record = [F.col(right_time).alias("t")]
    record += [F.col(c).alias(f"k{i}") for i, c in enumerate(tie)]
    record += [F.col(c).alias(f"p{i}") for i, c in enumerate(payload)]
    key = F.struct(*[F.col(c).alias(f"b{i}") for i, c in enumerate(by)]).alias(_K)
    rights = right.where(_keyed(right, [right_time, *by])).select(key, F.col(right_time).alias(_T), F.lit(_RIGHT).alias(_SIDE), F.struct(*record).alias(_R))
    # Left rows of one key and time are told apart by a hash, so that ranges can cut between them; it depends on the row and its partition alone.
    hashed = [F.col(f.name) for f in left.schema if isinstance(f.dataType, T.AtomicType)]
    own = F.struct(*[left[c].alias(f"c{i}") for i, c in enumerate(left.columns)])
    lefts = left.where(_keyed(left, [left_time, *by])).select(
        key, F.col(left_time).alias(_T), F.lit(_LEFT).alias(_SIDE), own.alias(_L), F.xxhash64(*hashed, F.spark_partition_id()).alias("__scan_salt")
    )
    both = lefts.unionByName(rights, allowMissingColumns=True)
    order = [F.col(_K), _along(F.col(_T), fwd), _along(F.col(_SIDE), allow_exact), _along(F.col(_R), fwd), F.col("__scan_salt")]
    return both.repartitionByRange(ranges, *order).withColumn(_P, F.spark_partition_id()).drop("__scan_salt")


def _carry(rows: DataFrame, fwd: bool) -> DataFrame:
    """Per range the last right row before it, with its key: (range, key, right row)."""
    rights = rows.where(F.col(_SIDE) == _RIGHT)
    ends = rights.groupBy(_P).agg(F.max(_K).alias(_K))  # the last key of a range: one row per range
    best = (F.min if fwd else F.max)(_R).alias("tail")
    tails = rights.join(F.broadcast(ends), [_P, _K]).groupBy(_P).agg(F.max(_K).alias("of"), best)
    # Every range that holds rows, so that one without right rows passes on what came before it.
    every = rows.select(_P).distinct().join(tails, _P, "left")
    before = f"OVER (ORDER BY {_P} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    last = F.expr(f"last(CASE WHEN tail IS NOT NULL THEN struct(of, tail) END, true) {before}")
    return every.select(_P, last.alias("last")).where("last IS NOT NULL").select(_P, F.col("last.of").alias(_K), F.col("last.tail").alias(_C))
