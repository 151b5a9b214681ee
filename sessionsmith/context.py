"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import warnings
import weakref

from pyspark.sql import SparkSession

LOCAL_CONF = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def cluster_settings(
    input_bytes: int, shuffle_fraction: float = 0.05, target_partition_bytes: int = 256 << 20
) -> dict[str, str]:
    """Session settings for a cluster run over ``input_bytes`` of raw logs.

    The large shuffle carries the grain after map-side combining, a small
    fraction of the raw input (``shuffle_fraction``; the default 5 % fits
    ~100 raw events per (account, session, day) with grain rows ~5x wider
    than raw rows; read the real ratio off the first run's shuffle-write
    metrics), so shuffle partitions are sized for that: one per ``target_partition_bytes`` of expected
    shuffle data, at least 200. Sizing them by raw input would give every
    map task hundreds of thousands of tiny blocks. AQE coalesces small
    partitions and splits skewed ones; file splits use the target size.
    ``spark.checkpoint.dir`` must still name shared storage.
    """
    shuffle_bytes = int(input_bytes * shuffle_fraction)
    partitions = max(200, -(-shuffle_bytes // target_partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.session.timeZone": "UTC",
    }


def local_session(cores: int | str = "*", app: str = "sessionsmith", **conf: str) -> SparkSession:
    """A local session for tests and the benchmark (UI off, UTC, AQE on)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in {**LOCAL_CONF, **conf}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


#: Set to true where ``file:`` paths are a mount that all executors share; then no probe is made.
SHARED_FILES = "spark.sessionsmith.sharedFileCheckpoint"
#: Applications and their ``file:`` checkpoint folders that a probe found to be shared.
_SHARED: set[tuple[str, str]] = set()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's ``spark.checkpoint.dir``; set a scratch one only if unset.

    On a cluster the setting names a shared folder that survives executor
    loss. A ``file:`` path may be a shared mount there or a disk of each
    machine: it is refused unless ``SHARED_FILES`` says that it is shared or
    a probe shows it (``_require_shared``). Where the setting is missing or
    its folder is refused, a folder in the warehouse is used, which holds
    tables for all machines; it is probed alike, and if it is no better the
    error names the setting. A machine-local folder is only created for local
    test sessions.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    local = sc.master.startswith("local")
    if not current and local:
        path = tempfile.mkdtemp(prefix="sessionsmith-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        sc.setCheckpointDir(path)
        return path
    try:
        if not current:
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        shared = local or sc.getConf().get(SHARED_FILES, "false").lower() == "true"
        if not shared and _scheme(spark, current) == "file":
            _require_shared(spark, current)
        if sc.getCheckpointDir():
            return current
    except RuntimeError as refused:
        try:
            current = f"{_warehouse(spark).rstrip('/')}/sessionsmith-checkpoint"
            if _scheme(spark, current) == "file":
                _require_shared(spark, current)
        except Exception:
            raise refused from refused.__cause__
        warnings.warn(f"{refused}; intermediate tables go to {current}", stacklevel=2)
    sc.setCheckpointDir(current)
    if (sc.applicationId, current) in _SHARED:  # later calls find the folder that Spark has made in it
        _SHARED.add((sc.applicationId, sc.getCheckpointDir()))
    return current


def _warehouse(spark: SparkSession) -> str:
    return spark.conf.get("spark.sql.warehouse.dir")


def _require_shared(spark: SparkSession, path: str) -> None:
    """Raise unless files that tasks write below ``path`` are there for the driver and for other tasks; found out once for each application.

    Each core gets a task that writes a row. On disks of single machines the
    driver finds no file of another machine, so rows are missing when the
    table is read back. A probe that fails shows nothing, so it refuses too.
    """
    refused = RuntimeError(f"spark.checkpoint.dir is the local folder {path}; name a shared one, or set {SHARED_FILES}")
    try:
        place = (spark.sparkContext.applicationId, path)
        if place in _SHARED:
            return
        tasks, probe = spark.sparkContext.defaultParallelism, f"{path.rstrip('/')}/probe-{uuid.uuid4().hex}"
        folder, fs = _filesystem(spark, probe)
        try:
            spark.range(0, tasks, 1, tasks).write.parquet(probe)
            found = spark.read.schema("id bigint").parquet(probe).count()
        finally:
            fs.delete(folder, True)
    except Exception as exc:
        raise refused from exc
    if found != tasks:
        raise refused
    _SHARED.add(place)


def _filesystem(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _scheme(spark: SparkSession, path: str) -> str:
    return _filesystem(spark, path)[1].getScheme()


class Workspace:
    """The intermediate tables of one run. Whoever makes it releases it; other runs of the session keep theirs.

    Use as a context manager, so that a failing run leaves nothing behind::

        with Workspace(spark) as work:
            grain = work.materialize(grain)
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def materialize(self, df):
        """Write ``df`` as a Parquet table under the session's checkpoint folder
        and return a reader over it.

        Used for an intermediate read by several consumers: the upstream scan
        and aggregate run once, lineage is cut (a lost executor costs a re-read,
        not a recomputation from the raw files), and, unlike an RDD checkpoint,
        each consumer reads only the columns it needs from compressed files.
        """
        path = os.path.join(ensure_checkpoint_dir(self.spark), "tables", uuid.uuid4().hex)
        self.paths.append(path)
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def release(self, since: int = 0) -> int:
        """Delete the tables after the first ``since``; returns how many."""
        drop, self.paths = self.paths[since:], self.paths[:since]
        for p in drop:
            path, fs = _filesystem(self.spark, p)
            fs.delete(path, True)
        return len(drop)

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *_) -> None:
        self.release()


#: Of registered queries, whose lazy results read their tables after the call.
_DEFAULT: weakref.WeakKeyDictionary[SparkSession, Workspace] = weakref.WeakKeyDictionary()


def default_workspace(spark: SparkSession) -> Workspace:
    """The session's workspace for results that outlive the call that makes them."""
    return _DEFAULT.setdefault(spark, Workspace(spark))


def materialize(df, work: Workspace | None = None):
    """``Workspace.materialize`` in ``work``, or in the session's default one."""
    return (work or default_workspace(df.sparkSession)).materialize(df)


def materialized_mark(spark: SparkSession) -> int:
    """A mark for ``release_materialized``: tables of the default workspace written after it are released."""
    return len(default_workspace(spark).paths)


def release_materialized(spark: SparkSession, since: int = 0) -> int:
    """Delete the tables of the session's default workspace after the mark ``since``."""
    return default_workspace(spark).release(since)
