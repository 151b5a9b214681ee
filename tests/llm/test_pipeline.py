from __future__ import annotations

from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sessionsmith.context import materialized_mark, release_materialized
from sessionsmith.llm.common import stored
from sessionsmith.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "documents pages labels embeddings".split()


def good(rng, n=80):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(n)) + "."


def test_stages(spark, rng):
    """Each stage does its work on planted cases, and leaves clean documents alone."""
    boiler = "subscribe to our letter today"
    rows = [(i, good(rng), "en", f"s{i % 20}") for i in range(400)]
    rows += [(1000 + i, f"{good(rng)}\n{boiler}", "en", f"s{i % 20}") for i in range(40)]
    rows += [(2000 + i, "junk### " * 30 + good(rng, 20), "en", "s1") for i in range(5)]
    rows += [(2100, "too short", "en", "s1"), (2101, None, None, None), (2102, "", "en", "s2")]
    copied = good(rng, 400)
    rows += [(3000 + i, copied, "en", f"s{i}") for i in range(4)] + [(3004, copied.replace(copied.split()[100], "other", 1), "en", "s9"), (3000, copied, "en", "s0")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").withColumn("n_chars", F.length("text").cast("bigint"))
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "line_dedup", "simhash", "mixing", "sentencepiece"]
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF))
        kept[name] = sorted(r.doc_id for r in docs.select("doc_id").collect())
        if name != names[-1]:
            assert docs.columns == corpus_pipeline.COLUMNS
        if name == "line_dedup":
            text = {r.doc_id: (r.text, r.n_chars) for r in docs.collect()}
            assert boiler in text[1000][0] and all(boiler not in text[i][0] for i in range(1001, 1040))
            assert all(n == len(t) for t, n in text.values())
    clean = set(range(400)) | set(range(1000, 1040))
    assert clean <= set(kept["quality_rules"]) and not set(range(2000, 2103)) & set(kept["quality_rules"])
    assert kept["line_dedup"] == kept["quality_rules"]
    assert [i for i in kept["simhash"] if i >= 3000] == [3000] and clean <= set(kept["simhash"])
    assert set(kept["mixing"]) <= set(kept["simhash"])
    assert kept["sentencepiece"] == kept["mixing"]


def test_empty_documents(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF))
        assert docs.count() == 0


def left_behind(spark):
    folder = Path(spark.sparkContext.getCheckpointDir().removeprefix("file:"))
    return {p for kind in ("llm", "tables", "warc") if (folder / kind).is_dir() for p in (folder / kind).iterdir()}


def test_nothing_is_left_behind(spark, monkeypatch):
    """A run keeps the one table that its rows read, until they are used; a failing one keeps none."""
    before, mark = left_behind(spark), materialized_mark(spark)
    result = corpus_pipeline.run(spark, SF)
    assert len(left_behind(spark) - before) == 1 and result.count() > 0
    assert release_materialized(spark, mark) == 1 and left_behind(spark) == before

    def fails(spark, docs, sf_dir):
        stored(docs)
        raise RuntimeError("no")

    monkeypatch.setattr(corpus_pipeline, "STAGES", [*corpus_pipeline.STAGES[:2], ("fails", fails), corpus_pipeline.STAGES[-1]])
    with pytest.raises(RuntimeError):
        corpus_pipeline.run(spark, SF)
    assert left_behind(spark) == before


def test_archives_are_released(spark):
    before, mark = left_behind(spark), materialized_mark(spark)
    assert QUERIES["op1_warc_merge"](spark, SF).count() > 0
    assert len(left_behind(spark) - before) > 1
    release_materialized(spark, mark)
    assert left_behind(spark) == before


def test_run_is_repeatable(spark):
    a, b = (sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) for _ in range(2))
    assert a == b and 0 < len(a) <= spark.read.parquet(f"{SF}/documents.parquet").count()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracles(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.execute(ORACLES[name])
    columns = [c[0] for c in want.description]
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(columns)
    assert sorted((tuple(r) for r in got.select(*columns).collect()), key=str) == sorted(want.fetchall(), key=str)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries_run(spark, name):
    assert QUERIES[name](spark, SF).count() > 0
