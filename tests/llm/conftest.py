from __future__ import annotations

import random

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture
def rng():
    return random.Random(20)


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table; columns that operators make themselves are there too, with other meanings."""

    def make(rows, columns="doc_id bigint, text string, lang string, source string"):
        df = spark.createDataFrame(rows, columns)
        from pyspark.sql import functions as F

        clashing = ["n_words", "kept", "p", "rate", "fp", "component", "sha", "run", "id", "line", "score", "block", "n_chars"]
        return df.withColumns({c: F.lit(f"other {c}") for c in clashing if c not in df.columns})

    return make
