from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sessionsmith import schema as S  # noqa: E402
from sessionsmith.context import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session("*")
    yield s


def raw_logs(spark, rows, file="f1.parquet"):
    """T1 raw log frame from (time, logid, session, detail, account, level[, file]) tuples."""
    data = []
    for r in rows:
        r = tuple(r)
        if len(r) == 6:
            r = r + (file,)
        data.append(r)
    from pyspark.sql import types as T

    schema = T.StructType(S.RAW_LOG.fields + [T.StructField(S.FILE, T.StringType())])
    return spark.createDataFrame(data, schema)


def ts(text):
    import datetime as dt

    return dt.datetime.fromisoformat(text)
