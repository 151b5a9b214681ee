"""What the operators of this subpackage share: tables in the shared folder, and bounded Arrow batches.

Words are runs of characters other than space, tab, LF, VT, FF and CR everywhere. On UTF-8 these are exactly the runs that
``bytes.split()`` returns.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from sessionsmith.context import Workspace, default_workspace, ensure_checkpoint_dir

_WORK: ContextVar[Workspace | None] = ContextVar("work", default=None)


def workspace(spark: SparkSession) -> Workspace:
    """What owns the tables written now: that of the enclosing ``scratch``, else the session's, for results that are read later (``release_materialized`` deletes them)."""
    return _WORK.get() or default_workspace(spark)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Workspace]:
    """Tables that operators write inside are deleted at its end, also after an error. A result must be written elsewhere before, as it reads them."""
    with Workspace(spark) as work:
        token = _WORK.set(work)
        try:
            yield work
        finally:
            _WORK.reset(token)


def shared_path(spark: SparkSession, kind: str) -> str:
    """A new path below the shared folder that ``spark.checkpoint.dir`` names. It belongs to the ``workspace``."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{kind}/{uuid.uuid4().hex}"
    workspace(spark).paths.append(path)
    return path


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again: lineage ends there, a lost executor costs a re-read."""
    path = shared_path(df.sparkSession, "llm")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Bytes of one Arrow batch of texts. Spark's default is 64 MB; a task holds a batch several times over, in the JVM and in Python.
BATCH_BYTES = 8 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def in_batches(df: DataFrame, run, schema: str) -> DataFrame:
    """``df.mapInArrow`` with small batches, however long texts are: the session's limit is lowered to ``BATCH_BYTES`` if it is higher. A row that is longer is a batch of its own."""
    conf = df.sparkSession.conf
    limit = re.fullmatch(r"(-?\d+)([kmgtb]?)b?", str(conf.get(_BATCH)).lower())
    size = int(limit[1]) * 1024 ** " kmgt".find(limit[2]) if limit and limit[2] in " kmgt" and limit[2] else int(limit[1]) if limit else -1
    if not 0 < size <= BATCH_BYTES:
        conf.set(_BATCH, str(BATCH_BYTES))
    return df.mapInArrow(run, schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
