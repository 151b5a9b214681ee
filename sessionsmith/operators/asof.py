"""As-of (nearest-in-time) joins without a per-key hot task.

For every left row the operator finds, in the same ``by`` group, the right
row whose time is the nearest at or after the left time (``forward``) or
at or before it (``backward``). It is expressed as a union of both sides
and a ``last(..., ignorenulls)`` running window.

Scale: a window partitioned by the key alone would put a hot key (one
account holding a third of all rows) into one task. Time is therefore cut
into coarse buckets (a day) and fine ones (a minute), and the main window is
partitioned by ``(key, fine bucket)``, so even a key that is hot within one
day is spread. A left row whose match lies in another fine bucket gets it
from a "carry" row: the nearest right row outside the bucket, found by a
window over the fine buckets of one coarse bucket (their number is fixed)
and a window over the coarse buckets of a key (bounded by the time span).
Carry rows join the main window as extra right rows, so no join back is
needed. Left rows with a null key or time match nothing; they are set aside
and never meet in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import sql_micros_between

_T, _SIDE, _D, _B, _R, _M = "__asof_t", "__asof_side", "__asof_d", "__asof_b", "__asof_r", "__asof_m"


def _bucket_sql(t: str, bucket_seconds: int) -> str:
    """Time bucket number: whole ``bucket_seconds`` since 1970-01-01."""
    micros = sql_micros_between("TIMESTAMP_NTZ '1970-01-01 00:00:00'", t)
    return f"floor({micros} / {bucket_seconds * 1_000_000})"


def asof_join(
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
    bucket_seconds: int = 86400,
    allow_exact: bool = True,
    fine_seconds: int = 60,
) -> DataFrame:
    """Join each left row to the nearest right row in time.

    Args:
        by: equality keys present on both sides.
        left_time / right_time: TIMESTAMP_NTZ columns compared.
        direction: ``"forward"`` (right time >= left time) or ``"backward"``.
        how: ``"inner"`` drops left rows without a match, ``"left"`` keeps them.
        tie: right columns that order right rows with equal time; forward
            picks the smallest, backward the largest.
        payload: right columns to return (default: all but keys and time).
        tolerance_seconds: a match further away than this counts as none
            (``None`` or 0: no limit).
        matched_time: name for the matched right time in the output.
        bucket_seconds: width of the coarse time buckets that split a key.
        allow_exact: whether equal times match.
        fine_seconds: width of the fine time buckets, at most ``bucket_seconds``.
    """
    if direction not in ("forward", "backward"):
        raise ValueError("direction must be 'forward' or 'backward'")
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    by = list(by)
    tie = list(tie)
    if payload is None:
        payload = [c for c in right.columns if c not in by and c != right_time and c not in tie]
    payload = list(payload)
    fwd = direction == "forward"

    fine = min(fine_seconds, bucket_seconds)

    # Right rows as one orderable struct: (time, tie..., payload...).
    fields = [f"'t', {right_time}"]
    fields += [f"'k{i}', {c}" for i, c in enumerate(tie)]
    fields += [f"'p{i}', {c}" for i, c in enumerate(payload)]
    # SQL equality: a null key or time never matches.
    r_ok = " AND ".join(f"{c} IS NOT NULL" for c in [right_time, *by])
    r = right.where(r_ok).selectExpr(
        *by,
        f"{right_time} AS {_T}",
        f"{_bucket_sql(right_time, bucket_seconds)} AS {_D}",
        f"{_bucket_sql(right_time, fine)} AS {_B}",
        f"named_struct({', '.join(fields)}) AS {_R}",
    )
    left_cols = left.columns
    l_ok = " AND ".join(f"`{c}` IS NOT NULL" for c in [left_time, *by])
    lt = left.where(l_ok).withColumns(
        {
            _T: F.col(left_time),
            _D: F.expr(_bucket_sql(left_time, bucket_seconds)),
            _B: F.expr(_bucket_sql(left_time, fine)),
        }
    )

    # Carry: for each (key, fine bucket) holding left rows, the nearest right
    # row in a strictly later (forward) / earlier (backward) bucket. One
    # aggregate gives, per fine bucket, "has left rows" and the best right row.
    # Then a window over the fine buckets of a coarse one, and a window over
    # the coarse buckets of a key, carry the best ones across.
    pick = "min" if fwd else "max"
    per_bucket = (
        lt.selectExpr(*by, _D, _B, f"1 AS {_SIDE}")
        .unionByName(r.selectExpr(*by, _D, _B, f"0 AS {_SIDE}", _R), allowMissingColumns=True)
        .groupBy(*by, _D, _B)
        .agg(F.expr(f"max({_SIDE}) AS {_SIDE}"), F.expr(f"{pick}({_R}) AS {_R}"))
    )
    keys = ", ".join(by)
    bdir = "DESC" if fwd else "ASC"
    preceding = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    within = per_bucket.selectExpr(
        *by, _D, _B, _SIDE, _R,
        f"last({_R}, true) OVER (PARTITION BY {keys}, {_D} ORDER BY {_B} {bdir} {preceding}) AS __asof_near",
        f"{pick}({_R}) OVER (PARTITION BY {keys}, {_D}) AS __asof_day",
        f"row_number() OVER (PARTITION BY {keys}, {_D} ORDER BY {_B} {bdir}) AS __asof_n",
    )
    # The coarse buckets: one row each, the first of its fine ones.
    across = within.where("__asof_n = 1").selectExpr(
        *[f"{c} AS __asof_k{i}" for i, c in enumerate(by)],
        f"{_D} AS __asof_dd",
        f"last(__asof_day, true) OVER (PARTITION BY {keys} ORDER BY {_D} {bdir} {preceding}) AS __asof_far",
    )
    same = " AND ".join([*(f"{c} = __asof_k{i}" for i, c in enumerate(by)), f"{_D} = __asof_dd"])
    carry = (
        within.where(f"{_SIDE} = 1")
        .join(across.where("__asof_far IS NOT NULL"), F.expr(same), "left")
        .withColumn(_M, F.expr("coalesce(__asof_near, __asof_far)"))
        .where(f"{_M} IS NOT NULL")
        .selectExpr(*by, _D, _B, f"{_M}.t AS {_T}", f"{_M} AS {_R}")
    )

    # Main window per (key, fine bucket): right rows, carry rows and left rows.
    # Without exact matches, right rows of equal time sort after the left row.
    rights = r.unionByName(carry).withColumn(_SIDE, F.lit(1))
    u = lt.withColumn(_SIDE, F.lit(0)).unionByName(rights, allowMissingColumns=True)
    tdir = "DESC" if fwd else "ASC"
    sdir = "DESC" if allow_exact else "ASC"
    window = (
        f"OVER (PARTITION BY {keys}, {_B} ORDER BY {_T} {tdir}, {_SIDE} {sdir}, {_R} {tdir} "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    )
    out = u.withColumn(_M, F.expr(f"last({_R}, true) {window}")).where(F.col(_SIDE) == 0)
    if tolerance_seconds:
        gap = f"timestampdiff(MICROSECOND, {_T}, {_M}.t)" if fwd else f"timestampdiff(MICROSECOND, {_M}.t, {_T})"
        limit = int(tolerance_seconds * 1_000_000)
        out = out.withColumn(_M, F.expr(f"CASE WHEN {gap} <= {limit} THEN {_M} END"))
    if how == "inner":
        out = out.where(F.col(_M).isNotNull())
    sel = [f"`{c}`" for c in left_cols]
    if matched_time:
        sel.append(f"{_M}.t AS `{matched_time}`")
    sel += [f"{_M}.p{i} AS `{c}`" for i, c in enumerate(payload)]
    out = out.selectExpr(*sel)
    if how == "left":
        out = out.unionByName(left.where(f"NOT ({l_ok})"), allowMissingColumns=True)
    return out
