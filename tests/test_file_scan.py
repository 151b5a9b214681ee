"""One pass over raw files: each is opened once, with its own types; an error of the store is raised, a broken file ends."""

from __future__ import annotations

import io

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from sessionsmith import schema as S
from sessionsmith.operators import quality as q
from sessionsmith.sources import logs as L


def table(n=3, **columns):
    cols = {"time": pa.array([f"2024-01-15 10:30:{i % 60:02}.000" for i in range(n)]), "logid": pa.array([1013] * n, pa.int32()), "session": pa.array(range(1, n + 1), pa.int64()),
            "log_detail_code": pa.array([0] * n, pa.int32()), "actor_account_id": pa.array(["a"] * n), "actor_level": pa.array([10] * n, pa.int32())}
    return pa.table({**cols, **columns})


SIGNATURES = {
    "own": {},
    "wide": {"logid": pa.array([1013, None, 2**40], pa.int64())},
    "floats": {"actor_level": pa.array([10.0, None, 11.5]), "actor_account_id": pa.array([8.0, 9.25, None])},
    "small floats": {"actor_account_id": pa.array([8.0, 0.1, None], pa.float32())},
    "unsigned": {"session": pa.array([1, 2, 2**64 - 1], pa.uint64()), "actor_account_id": pa.array([1, 2, 2**64 - 1], pa.uint64())},
    "dictionary": {"actor_account_id": pa.array(["x", "y", "x"]).dictionary_encode()},
    "none": {"actor_level": pa.nulls(3)},
    "decimal": {"session": pa.array([1, 2, 3], pa.decimal128(12, 0))},
}
WANT = {
    "wide": {"logid": [1013, None, None]},
    "floats": {"actor_level": [10, None, 11], "actor_account_id": ["8", "9.25", None]},
    "small floats": {"actor_account_id": ["8", "0.1", None]},
    "unsigned": {"session": [1, 2, None], "actor_account_id": ["1", "2", str(2**64 - 1)]},
    "dictionary": {"actor_account_id": ["x", "y", "x"]},
    "none": {"actor_level": [None] * 3},
}


def test_every_signature_in_one_pass(spark, tmp_path):
    for name, columns in SIGNATURES.items():
        pq.write_table(table(**columns), str(tmp_path / f"{name}.parquet"))
    footers = q.footer_facts(L.footer_listing(spark, str(tmp_path)))
    assert footers.select("signature").distinct().count() >= 6
    scan = L.scan_logs(spark, str(tmp_path), footers=footers)
    assert [(f.name, f.dataType) for f in scan.schema][:-1] == [(f.name, f.dataType) for f in S.RAW_LOG]
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Union" not in plan
    got: dict = {}
    for r in sorted(scan.collect(), key=lambda r: r["time"]):
        got.setdefault(r[S.FILE].rsplit("/", 1)[-1].replace("%20", " ").removesuffix(".parquet"), []).append(r)
    own = table().to_pydict()
    for name in SIGNATURES:
        for column, values in {**own, **WANT.get(name, {})}.items():
            assert [r[column] for r in got[name]] == values, (name, column)


def run(paths, names=tuple(S.RAW_COLUMNS)):
    read = L._file_reader(list(names), S.FILE)
    batch = pa.record_batch([pa.array([f"f{i}" for i in range(len(paths))]), pa.array([str(p) for p in paths])], names=[S.FILE, "path"])
    return list(read(iter([batch])))


def test_each_file_is_opened_once_and_only_its_columns_are_read(tmp_path, monkeypatch):
    opened, asked = [], []
    real = pq.ParquetFile

    class Counted(real):
        def __init__(self, source, *a, **k):
            opened.append(source)
            super().__init__(source, *a, **k)

        def iter_batches(self, *a, **k):
            asked.append(k["columns"])
            return super().iter_batches(*a, **k)

    monkeypatch.setattr(pq, "ParquetFile", Counted)
    paths = []
    for i, columns in enumerate(list(SIGNATURES.values())[:3]):
        paths.append(tmp_path / f"{i}.parquet")
        pq.write_table(table(**columns, more=pa.array(["not read"] * 3)), str(paths[-1]))
    out = run(paths)
    assert len(opened) == 3 and sum(b.num_rows for b in out) == 9
    assert asked == [list(S.RAW_COLUMNS)] * 3 and not any("more" in n for n in out[0].schema.names)


@pytest.mark.parametrize("errors", [1, 10**9])
def test_error_of_the_store(tmp_path, monkeypatch, errors):
    """A failing read is not taken for a broken file: one that passes is read over, without loss or repeated rows; one that lasts fails the task."""
    path = tmp_path / "good.parquet"
    pq.write_table(table(4000), str(path), row_group_size=1000)
    data = path.read_bytes()
    left = [errors]

    class Flaky(io.BytesIO):
        def read(self, *a):
            if len(data) // 3 < self.tell() < len(data) * 2 // 3 or a and a[0] == 1 << 24:
                left[0] -= 1
                if left[0] >= 0:
                    raise OSError("connection reset")
            return super().read(*a)

    class Store:
        def open_input_file(self, inner):
            return pa.PythonFile(Flaky(data), mode="r")

    monkeypatch.setattr(L, "store_opener", lambda: lambda path: (Store(), path))
    if errors > 1:
        with pytest.raises(OSError, match="connection reset"):
            run([path])
    else:
        out = run([path])
        assert left[0] < errors
        assert [v for b in out for v in b.column("session_i").to_pylist()] == list(range(1, 4001))


def test_broken_file_ends_where_it_breaks(tmp_path):
    path = tmp_path / "half.parquet"
    pq.write_table(table(4000), str(path), row_group_size=2000, compression="none", use_dictionary=False)
    at = pq.ParquetFile(str(path)).metadata.row_group(1).column(0).data_page_offset
    with open(path, "r+b") as f:
        f.seek(at)
        f.write(b"\xff" * 400)
    good = tmp_path / "good.parquet"
    pq.write_table(table(5), str(good))
    out = run([path, good])
    rows = {name: sum(b.num_rows for b in out if b.column(0)[0].as_py() == name) for name in ("f0", "f1")}
    assert rows == {"f0": 2000, "f1": 5}


def test_no_files_and_files_without_a_signature(spark, tmp_path):
    pq.write_table(pa.table({"time": ["x"]}), str(tmp_path / "lacking.parquet"))
    (tmp_path / "noise.parquet").write_bytes(b"not parquet")
    footers = q.footer_facts(L.footer_listing(spark, str(tmp_path)))
    assert L.scan_logs(spark, str(tmp_path), footers=footers).count() == 0
    assert L.scan_files(footers.where(F.lit(False))).count() == 0
