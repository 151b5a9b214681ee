"""Label source (T6) and the run-metrics sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S
from .logs import has_files

CSV_GLOB = "*.csv*"


def read_raw_labels(spark: SparkSession, path: str, kind: str | None = None) -> DataFrame:
    """The three label columns as stored, found by name.

    ``kind`` is ``csv`` or ``parquet``; by default a file or folder with
    names like ``*.csv`` or ``*.csv.gz`` is CSV with a header, anything else
    Parquet. Columns may come in any order, with others between them; a
    missing one raises. Files of one folder must have one header.
    """
    if kind is None:
        kind = "csv" if has_files(spark, path, CSV_GLOB) else "parquet"
    if kind == "csv":
        raw = spark.read.option("header", "true").option("enforceSchema", "false").csv(path)
    else:
        raw = spark.read.parquet(path)
    wanted = [S.KEY, S.LABEL_TIME, S.LABEL]
    missing = [c for c in wanted if c not in raw.columns]
    if missing:
        raise ValueError(f"labels in {path} lack the columns {missing}")
    return raw.select(*wanted)


def typed_labels(raw: DataFrame, *others: str) -> DataFrame:
    """The key as text, the time as TIMESTAMP_NTZ (ISO-like text, with or
    without fraction, without the session time zone), the label as a whole
    number, also from ``1.0``. What does not parse becomes null;
    ``label_issues`` counts it. The columns ``others`` stay beside them."""
    text = raw.schema[S.LABEL_TIME].dataType.simpleString() == "string"
    ts = F.col(S.LABEL_TIME)
    label = F.col(S.LABEL).try_cast("double")
    return raw.select(
        F.col(S.KEY).cast("string").alias(S.KEY),
        (ts.try_cast("timestamp_ntz") if text else ts.cast("timestamp_ntz")).alias(S.LABEL_TIME),
        F.when(label == F.floor(label), label.cast("int")).alias(S.LABEL),
        *others,
    )


def scan_labels(spark: SparkSession, path: str, kind: str | None = None) -> DataFrame:
    """Read labels ``(actor_account_id, event_timestamp, churn_yn)``; see ``read_raw_labels`` and ``typed_labels``."""
    return typed_labels(read_raw_labels(spark, path, kind))


def checked_labels(spark: SparkSession, path: str) -> DataFrame:
    """Every row of CSV labels, typed, with ``reason``, ``record`` and ``source_file``; ``accepted`` and ``rejects`` part them.

    ``reason`` is the first that holds of ``fields`` (more or fewer than the
    header has), ``time`` and ``label`` (there, but not a time, or not a
    whole number), else null. An empty time or label is a null, not an
    error. ``record`` is the row as text. One read finds all of it: Spark's
    parser keeps rows it can't fit in a column of their own.
    """
    reader = spark.read.option("header", "true").option("enforceSchema", "false").option("recursiveFileLookup", "true")
    columns = reader.csv(path).columns
    missing = [c for c in (S.KEY, S.LABEL_TIME, S.LABEL) if c not in columns]
    if missing:
        raise ValueError(f"labels in {path} lack the columns {missing}")
    bad = "__bad_record"
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, bad]])
    # Without pruning, so that the number of fields is checked whichever columns a query asks for.
    raw = reader.option("columnNameOfCorruptRecord", bad).option("columnPruning", "false").schema(schema).csv(path)
    time, label = F.col(S.LABEL_TIME), F.col(S.LABEL)
    number = label.try_cast("double")
    reason = (
        F.when(F.col(bad).isNotNull(), "fields")
        .when(time.isNotNull() & time.try_cast("timestamp_ntz").isNull(), "time")
        .when(label.isNotNull() & ~F.coalesce(number == F.floor(number), F.lit(False)), "label")
    )
    record = F.coalesce(bad, F.to_csv(F.struct(*[F.col(f"`{c}`") for c in columns])))
    facts = raw.withColumns({"reason": reason, "record": record, S.FILE: F.col("_metadata.file_path")})
    return typed_labels(facts, "reason", "record", S.FILE)


def accepted(checked: DataFrame) -> DataFrame:
    """The labels of the rows that have no reason against them, as ``scan_labels`` gives them."""
    return checked.where("reason IS NULL").select(S.KEY, S.LABEL_TIME, S.LABEL)


def rejects(checked: DataFrame) -> DataFrame:
    """The rejects table: file, reason and the row as text."""
    return checked.where("reason IS NOT NULL").select(S.FILE, "reason", "record")


def label_issues(raw: DataFrame) -> DataFrame:
    """One row: rows, and how many have a time or a label that is there but does not parse, and no label at all."""
    text = raw.schema[S.LABEL_TIME].dataType.simpleString() == "string"
    stored, label = F.col(S.LABEL_TIME), F.col(S.LABEL).try_cast("double")
    time = stored.try_cast("timestamp_ntz") if text else stored.cast("timestamp_ntz")
    return raw.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(stored.isNotNull() & time.isNull()).alias("bad_times"),
        F.count_if(F.col(S.LABEL).isNotNull() & ~F.coalesce(label == F.floor(label), F.lit(False))).alias("bad_labels"),
        F.count_if(F.col(S.LABEL).isNull()).alias("null_labels"),
    )


def write_metrics(metrics: DataFrame, path: str) -> None:
    """Write the ``(run_id, metric, value, text)`` rows of runs to the metrics table. A run that is there already is replaced, others stay, so a replayed run is there once."""
    metrics.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(path)
