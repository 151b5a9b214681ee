"""Raw game-log sources.

``scan_logs`` reads a directory of raw log files with the fixed T1 schema
and carries each row's file (``_metadata.file_path``) for lineage and
quarantine. ``log_view`` derives the same T1 table from the driver's
``events`` table, deterministically, so the whole pipeline can be run
and checked against SQL on the given data.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from .. import schema as S
from ..functions.expressions import format_time
from .stores import store_opener


#: Spark lists folders by so many tasks at most: one for each folder by default.
_LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


@contextmanager
def _listing_tasks(spark: SparkSession) -> Iterator[None]:
    """In this block Spark lists folders by eight tasks a core at most, each of which lists its share of them."""
    before = spark.conf.get(_LISTING)
    spark.conf.set(_LISTING, min(int(before), 8 * spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.set(_LISTING, before)


def list_files(spark: SparkSession, path: str, glob: str = "*.parquet") -> DataFrame:
    """Distributed listing ``(source_file, path, length)`` of the input files, in subfolders too; no content is read.

    ``source_file`` is spelled as in ``scan_logs`` (a URI, with special
    characters encoded) and joins with it; ``path`` has the plain
    characters and opens the file.
    """
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
    with _listing_tasks(spark):
        found = reader.load(path)
    return found.select(F.col("_metadata.file_path").alias(S.FILE), "path", "length")


def has_files(spark: SparkSession, path: str, glob: str = "*.parquet") -> bool:
    try:
        return bool(list_files(spark, path, glob).take(1))
    except AnalysisException:
        return False


def _read(spark: SparkSession, path: str, schema, glob: str) -> DataFrame:
    return (
        spark.read.schema(schema)
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .option("ignoreCorruptFiles", "true")
        .parquet(path)
        .withColumn(S.FILE, F.col("_metadata.file_path"))
    )


def scan_logs(
    spark: SparkSession,
    path: str,
    schema=S.RAW_LOG,
    lineage: bool = True,
    glob: str = "*.parquet",
    footers: DataFrame | None = None,
) -> DataFrame | None:
    """Read all ``*.parquet`` files under ``path`` as T1 rows.

    Files store numbers in different types: 64-bit integers, floats where
    a value is missing, account ids as numbers. With ``footers``
    (``quality.footer_facts`` of the folder) each file is opened once, with
    its own types, and cast to T1 (``scan_files``). Without ``footers``
    files must have T1's own types, and filters are pushed to them.

    Only the declared columns are read. Rows that can't be read are missing
    here; validation compares each file's rows with its footer and reports
    the file as failed. Returns ``None`` when the folder is missing or holds
    no matching file; with ``footers``, when they have no row: the folder is
    not listed again.
    """
    if not (has_files(spark, path, glob) if footers is None else footers.take(1)):
        return None
    df = _read(spark, path, schema, glob) if footers is None else scan_files(footers, schema)
    return df if lineage else df.drop(S.FILE)


#: Rows for one task of ``scan_files``, by the footers.
ROWS_EACH = 4_000_000
#: Kinds of stored values that rows carry until they are cast: each column travels as the one that its file stores.
_KINDS = {"i": "bigint", "f": "float", "d": "double", "m": "decimal(38,10)", "s": "string"}


def scan_files(footers: DataFrame, schema=S.RAW_LOG) -> DataFrame:
    """T1 rows of the files that ``footers`` describe, with ``source_file``; files without a ``signature`` (unreadable, columns missing) have none.

    The list of files is dealt out to tasks by file and never reaches the
    driver. A task opens each of its files once and reads the declared
    columns batch by batch as they are stored, so any number of combinations
    of types is one pass. After an error a file is read on once more. Where
    data can't be decoded although the store gives all bytes, the file is
    broken: its rows end there. Where the store fails, the error is raised,
    so that Spark runs the task again.
    """
    known = footers.where("signature IS NOT NULL").select(S.FILE, "path")
    files, rows = known.count(), footers.agg(F.sum("footer_rows")).first()[0] or 0
    tasks = max(1, min(files, footers.sparkSession.sparkContext.defaultParallelism), -(-rows // ROWS_EACH))
    names = [f.name for f in schema.fields]
    stored = ", ".join([f"{S.FILE} string", *(f"`{n}_{k}` {t}" for n in names for k, t in _KINDS.items())])
    read = known.repartition(int(tasks), S.FILE).mapInArrow(_file_reader(names, S.FILE), stored)
    # One of a column's kinds has the values of a file; the others are null.
    cast = [F.coalesce(*[_as(f"{f.name}_{k}", t, f.dataType) for k, t in _KINDS.items()]).alias(f.name) for f in schema.fields]
    return read.select(*cast, S.FILE)


def _file_reader(names: list[str], file_col: str):
    """Build the reader of a partition's files as a closure over plain values, as the footer reader is."""
    opened = store_opener()

    def read(batches):
        import pyarrow as pa
        import pyarrow.parquet as pq
        import pyarrow.types as pat

        kinds = {"i": pa.int64(), "f": pa.float32(), "d": pa.float64(), "m": pa.decimal128(38, 10), "s": pa.string()}

        def spread(column: pa.Array) -> list[pa.Array]:
            """The column as the one kind that holds it, and nulls for the others."""
            t = column.type.value_type if pat.is_dictionary(column.type) else column.type
            if pat.is_null(t) or pat.is_integer(t) and not pat.is_uint64(t):
                own = "i"
            elif pat.is_float64(t):
                own = "d"
            elif pat.is_floating(t):
                own = "f"
            elif pat.is_decimal(t) and t.scale > 0:
                own = "m"
            else:  # text, and whole numbers that a long may not hold: their text is cast
                own = "s"
            if pat.is_dictionary(column.type):
                column = column.dictionary_decode()
            if own == "s" and pat.is_decimal(column.type):
                column = pa.array([None if v is None else str(int(v)) for v in column.to_pylist()], pa.string())
            return [column.cast(kind, safe=False) if k == own else pa.nulls(len(column), kind) for k, kind in kinds.items()]

        def whole(filesystem, inner: str) -> bool:
            """Whether the store gives all bytes of the file; an error of the store is raised."""
            with filesystem.open_input_file(inner) as fh:
                while fh.read(1 << 24):
                    pass
            return True

        def rows_of(filesystem, inner: str):
            """Batches of a file, row group by row group. After an error the file is opened once more and read on from there; if that fails too and the store gives all bytes, the file is broken and ends."""
            fh = filesystem.open_input_file(inner)
            try:
                groups, done, tried = None, (0, 0), False
                while True:
                    try:
                        if groups is None:
                            file = pq.ParquetFile(fh)
                            groups = range(file.num_row_groups)
                        for g in groups[done[0] :]:
                            for k, part in enumerate(file.iter_batches(batch_size=1 << 16, row_groups=[g], columns=names, use_threads=False)):
                                if k >= done[1]:
                                    done = (g, k + 1)
                                    yield part
                            done, tried = (g + 1, 0), False
                        return
                    except (OSError, pa.ArrowException):
                        fh.close()
                        if tried and whole(filesystem, inner):
                            return
                        groups, tried = None, True
                        fh = filesystem.open_input_file(inner)
            finally:
                fh.close()

        for batch in batches:
            for name, path in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for part in rows_of(*opened(path)):
                    columns = [c for n in names for c in spread(part.column(part.schema.get_field_index(n)))]
                    yield pa.record_batch([pa.array([name] * part.num_rows, pa.string()), *columns], names=[file_col, *(f"{n}_{k}" for n in names for k in kinds)])

    return read


def _as(name: str, stored: str, wanted) -> Column:
    """A stored column as its T1 type. Values out of range become null; whole numbers in floats keep their text without a fraction."""
    value = F.col(name)
    if stored == wanted.simpleString():
        return value
    if wanted.simpleString() == "string" and stored in ("float", "double"):
        whole = value.cast("decimal(38,0)")
        return F.when(value == whole.cast("double"), whole.cast("string")).otherwise(value.cast("string")).alias(name)
    return value.try_cast(wanted).alias(name)


# --------------------------------------------------------------------------
# A game-log view over the driver's ``events`` table
# --------------------------------------------------------------------------

# Fixed values of the derived view: the 21 tracked codes in dictionary
# order, then two untracked codes; ``event_id % 23`` indexes this list.
VIEW_CODES = [code for code, _ in S.EVENT_CODES] + [1005, 9999]


def log_view(events: DataFrame) -> DataFrame:
    """T1 raw log (plus ``source_file``) derived from ``events``.

    One file per account. ``session = 0`` marks events without a session
    (every delete-character event and every 11th event); sessions last
    three calendar days. Accounts with ``user_id % 50`` in 1..8 carry one
    kind of bad data each on every 7th event (8: no session at all), so
    validation and quarantine have work to do.
    """
    eid, uid, ts = F.col("event_id"), F.col("user_id"), F.col("ts")
    kind = F.pmod(uid, F.lit(50))
    hit = F.pmod(eid, F.lit(7)) == 0
    logid = F.element_at(
        F.array(*[F.lit(c) for c in VIEW_CODES]), (F.pmod(eid, F.lit(23)) + 1).cast("int")
    )
    clean_session = F.when(
        (logid == S.ORPHAN_CODE) | (F.pmod(eid, F.lit(11)) == 0), F.lit(0)
    ).otherwise(F.lit(1) + F.floor((F.dayofmonth(ts) - 1) / 3))
    time_text = format_time(ts)
    return events.select(
        F.when((kind == 3) & hit, F.lit(None).cast("string"))
        .when((kind == 4) & hit, F.substring(time_text, 1, 19))
        .otherwise(time_text)
        .alias("time"),
        logid.cast("int").alias("logid"),
        F.when(kind == 8, F.lit(0))
        .when((kind == 2) & hit, F.lit(-1))
        .otherwise(clean_session)
        .cast("bigint")
        .alias("session"),
        (F.lit(1) + F.pmod(F.floor(eid / 23), F.lit(2))).cast("int").alias("log_detail_code"),
        F.when((kind == 6) & hit, F.lit(None).cast("string"))
        .otherwise(uid.cast("string"))
        .alias("actor_account_id"),
        F.when((kind == 1) & hit, F.lit(56))
        .when((kind == 5) & hit, F.lit(-3))
        .when((kind == 7) & hit, F.lit(None))
        .otherwise(F.lit(1) + F.pmod(eid * 7919, F.lit(55)))
        .cast("int")
        .alias("actor_level"),
        F.concat(F.lit("account-"), uid.cast("string"), F.lit(".parquet")).alias(S.FILE),
    )


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def read_log_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_view(read_table(spark, sf_dir, "events"))


def label_view(events: DataFrame) -> DataFrame:
    """T6 labels derived from ``events``: each purchase is a labelled moment.

    ``churn_yn = 1`` when the purchase value is below 20.
    """
    return events.where(F.col("event_type") == "purchase").select(
        F.col("user_id").cast("string").alias(S.KEY),
        F.col("ts").cast("timestamp_ntz").alias(S.LABEL_TIME),
        (F.col("value") < 20).cast("int").alias(S.LABEL),
    )


def read_label_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label_view(read_table(spark, sf_dir, "events"))


def footer_listing(spark: SparkSession, path: str, glob: str = "*.parquet") -> DataFrame:
    """Files to inspect by footer: the joining name and the path that opens them."""
    return list_files(spark, path, glob).select(S.FILE, "path")


def write_log_files(logs: DataFrame, path: str) -> None:
    """Write T1 rows as one Parquet file per ``source_file`` value, each in a folder of its own, as log shippers do."""
    logs.withColumn("file", F.col(S.FILE)).drop(S.FILE).repartition("file").write.partitionBy("file").parquet(path)
