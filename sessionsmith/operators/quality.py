"""File validation, quarantine and the file status table (T11).

The source pipeline checks each raw file with a list of rules (first
failing rule wins) and drops the whole file. Here the row-level rules are
counters of the session grain (one aggregate over all rows, see
``sessions.session_grain``), rolled up per file; the file-level rules
(empty, missing column, wrong type, unreadable) come from the file footers,
read in parallel by the tasks (``footer_facts``).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.expressions import parse_time, sql_text
from ..sources.stores import store_opener

COUNTERS = [
    "n_rows",
    "n_null_time",
    "n_null_session",
    "n_null_account",
    "n_null_logid",
    "n_bad_time",
    "n_neg_session",
    "n_neg_level",
    "n_high_level",
]


def file_rules(grain: DataFrame) -> DataFrame:
    """Per file: row counters summed over the grain and tracked rows with a
    positive session (the "filtered data" check)."""
    return grain.groupBy(S.FILE).agg(
        *[F.sum(c).alias(c) for c in COUNTERS],
        F.sum(F.when(F.col("session") > 0, F.col("n_tracked")).otherwise(0)).alias("n_tracked_pos"),
    )


def bad_time_examples(logs: DataFrame, rules: DataFrame) -> DataFrame:
    """The smallest badly formatted time text of each file that has one.

    Kept out of the grain aggregate on purpose: a string ``min`` buffer
    turns a HashAggregate into a SortAggregate, which would sort every raw
    row. Rows are semi-joined with the files known to hold a bad time. It is
    lazy: only whoever asks for the reasons reads the rows again.
    """
    bad_files = rules.where(F.col("n_bad_time") > 0).select(S.FILE)
    bad = F.col("time").isNotNull() & parse_time("time").isNull()
    rows = logs.select(S.FILE, "time").where(bad).join(bad_files, S.FILE, "left_semi")
    return rows.groupBy(S.FILE).agg(F.min("time").alias("bad_time"))


def validate_logs(
    grain: DataFrame,
    footers: DataFrame | None = None,
    logs: DataFrame | None = None,
    with_reasons: bool = True,
) -> DataFrame:
    """Status per file: ``(source_file, status, reason)``.

    Rules in order: unreadable, empty, missing columns, not all rows read,
    nulls in critical columns, type, time format, negative session, negative
    level, level above the maximum, then "no tracked event with a positive
    session". Every row is checked (the source checks the time format on the
    first row only and fails later rows by an exception). A file that can't
    be read, or not whole, or of which nothing is known is ``failed``;
    other rejections are ``skipped``. ``with_reasons=False`` gives only
    ``(source_file, status)``, enough for quarantine.
    """
    r = file_rules(grain)
    if with_reasons:
        if logs is not None:
            r = r.join(bad_time_examples(logs, r), S.FILE, "left")
        else:
            r = r.withColumn("bad_time", F.expr("concat(CAST(n_bad_time AS STRING), ' rows')"))
    if footers is not None:
        r = footers.join(r, S.FILE, "left")
    else:
        none = F.lit(None).cast("string")
        r = r.withColumns({"read_error": none, "missing": none, "not_numeric": none, "footer_rows": F.col("n_rows")})
    if not with_reasons:
        return r.selectExpr(S.FILE, f"{_STATUS} AS status")
    return r.selectExpr(S.FILE, f"{_STATUS} AS status", f"{_REASON} AS reason")


def _template(template: str, value: str) -> str:
    """``'head' || value || 'tail'`` for a message with one ``{...}`` slot."""
    head, tail = template.split("{", 1)[0], template.split("}", 1)[1]
    return f"concat({sql_text(head)}, {value}, {sql_text(tail)})"


_NULL_COUNTS = {
    "time": "n_null_time",
    "session": "n_null_session",
    "actor_account_id": "n_null_account",
    "logid": "n_null_logid",
}
_NULL_LIST = "concat('[', concat_ws(', ', {}), ']')".format(
    ", ".join(f"CASE WHEN {_NULL_COUNTS[c]} > 0 THEN {sql_text(repr(c))} END" for c in S.CRITICAL_COLUMNS)
)
# The rules in order, as (condition, status, message); the first that holds wins.
_RULES = [
    ("read_error IS NOT NULL", "failed", "read_error"),
    ("footer_rows IS NULL AND n_rows IS NULL", "failed", sql_text(S.MSG_UNREAD)),
    ("coalesce(footer_rows, n_rows) = 0", "skipped", sql_text(S.MSG_EMPTY)),
    ("missing IS NOT NULL", "skipped", _template(S.MSG_MISSING, "missing")),
    ("not_numeric IS NOT NULL", "skipped", _template(S.MSG_NOT_NUMERIC, "not_numeric")),
    ("coalesce(n_rows, 0) <> footer_rows", "failed", _template(S.MSG_PARTLY, "concat(coalesce(n_rows, 0), ' of ', footer_rows)")),
    (
        "n_null_time > 0 OR n_null_session > 0 OR n_null_account > 0 OR n_null_logid > 0",
        "skipped",
        _template(S.MSG_NULLS, _NULL_LIST),
    ),
    ("n_bad_time > 0", "skipped", _template(S.MSG_TIME_FORMAT, "bad_time")),
    ("n_neg_session > 0", "skipped", sql_text(S.MSG_NEG_SESSION)),
    ("n_neg_level > 0", "skipped", sql_text(S.MSG_NEG_LEVEL)),
    ("n_high_level > 0", "skipped", sql_text(S.MSG_HIGH_LEVEL)),
    ("n_tracked_pos = 0", "skipped", sql_text(S.MSG_NO_SESSIONS)),
]
_REASON = "CASE " + " ".join(f"WHEN {cond} THEN {msg}" for cond, _, msg in _RULES) + " ELSE '' END"
# The status needs only the conditions, not the messages, so a plan that
# only quarantines never computes the message parts.
_STATUS = "CASE " + " ".join(f"WHEN {cond} THEN '{status}'" for cond, status, _ in _RULES) + " ELSE 'success' END"


def quarantine(df: DataFrame, status: DataFrame) -> DataFrame:
    """Rows of files whose status is ``success`` (a semi join on the file).

    ``df`` is normally the session table, so the join runs on session rows,
    not on raw events; the status table has one row per file.
    """
    ok = status.where(F.col("status") == "success").select(S.FILE)
    return df.join(ok, S.FILE, "left_semi")


def file_status_counts(status: DataFrame) -> DataFrame:
    """Number of files per status (success / skipped / failed)."""
    return status.groupBy("status").agg(F.count(F.lit(1)).alias("files"))


# --------------------------------------------------------------------------
# Footers: file-level rules, read by the tasks, one file per row
# --------------------------------------------------------------------------

_NUMERIC_ORDER = ["session", "logid", "actor_level"]
_FOOTER_SCHEMA = f"{S.FILE} string, footer_rows long, missing string, not_numeric string, read_error string, signature string, path string"


def _footer_reader(required: list[str], numeric: list[str], file_col: str):
    """Build the per-partition footer reader as a closure over plain values,
    so it is shipped to the Python workers by value and needs no import of
    this package there."""

    opened = store_opener()

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pandas as pd
        import pyarrow.parquet as pq
        import pyarrow.types as pat

        cols = [file_col, "footer_rows", "missing", "not_numeric", "read_error", "signature", "path"]
        def stored_type(t) -> str | None:
            """The Spark type that reads a stored number or text; None for other types."""
            if pat.is_dictionary(t):
                t = t.value_type
            if pat.is_uint64(t):
                return "decimal(20,0)"
            if pat.is_integer(t):
                return "bigint"
            if pat.is_floating(t):
                return "double" if pat.is_float64(t) else "float"
            if pat.is_decimal(t):
                return f"decimal({t.precision},{t.scale})"
            if pat.is_string(t) or pat.is_large_string(t):
                return "string"
            return "int" if pat.is_null(t) else None

        for pdf in batches:
            out = []
            for name, path in zip(pdf[file_col], pdf["path"], strict=True):
                row = dict.fromkeys(cols)
                row[file_col], row["path"] = name, path
                try:
                    filesystem, inner = opened(path)
                except Exception:
                    # a store pyarrow cannot open here: the footer stays unknown
                    out.append(row)
                    continue
                try:
                    with filesystem.open_input_file(inner) as fh:
                        meta = pq.ParquetFile(fh)
                        arrow_schema = meta.schema_arrow
                        row["footer_rows"] = meta.metadata.num_rows
                    names = set(arrow_schema.names)
                    missing = [c for c in required if c not in names]
                    if missing:
                        row["missing"] = "[" + ", ".join(f"'{c}'" for c in missing) + "]"
                    types = {c: stored_type(arrow_schema.field(c).type) if c in names else "int" for c in required}
                    wrong = [c for c in numeric if types[c] in (None, "string")]
                    if wrong:
                        row["not_numeric"] = wrong[0]
                    elif types["time"] not in ("string", "int") and not missing:
                        row["read_error"] = f"TypeError: column 'time' must be text, not {arrow_schema.field('time').type}"
                    elif None not in types.values() and not missing:
                        row["signature"] = ";".join("string" if c == "time" else types[c] for c in required)
                    elif not missing:
                        row["read_error"] = f"TypeError: column '{next(c for c in required if types[c] is None)}' has a type that can't be read"
                except Exception as exc:  # unreadable file: reported, not raised
                    row["read_error"] = f"{type(exc).__name__}: {exc}"[:500]
                out.append(row)
            yield pd.DataFrame(out, columns=cols)

    return read


def footer_facts(listing: DataFrame) -> DataFrame:
    """Per listed file (``source_file``, ``path``): row count, missing columns,
    first non-numeric column, read error, and the stored type of each T1
    column (``signature``), from the Parquet footer only (no data pages);
    and the path, so that the rows can be read by the same list.
    Each task reads the footers of its share of the listing; eight tasks a
    core at most, as a scan of many small files has one for a few of them."""
    reader = _footer_reader(list(S.RAW_COLUMNS), list(_NUMERIC_ORDER), S.FILE)
    tasks = 8 * listing.sparkSession.sparkContext.defaultParallelism
    return listing.select(S.FILE, "path").coalesce(tasks).mapInPandas(reader, schema=_FOOTER_SCHEMA)
