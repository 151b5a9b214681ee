from __future__ import annotations

from collections import defaultdict

import pytest

from sessionsmith.llm.line_dedup import line_dedup, occurrences, spread


def brute(rows, least, keep_first):
    sites, owner = defaultdict(set), {}
    for key, text, _, site in rows:
        for line in set((text or "").split("\n")) if text is not None else ():
            if line.strip(" \t\n\v\f\r"):
                sites[line].add(site)
                if key is not None:
                    owner[line] = min(key, owner.get(line, key))
    out = []
    for key, text, _, site in rows:
        if text is None:
            out.append((key, None, 0))
            continue
        had = text.split("\n")
        left = [x for x in had if len(sites.get(x, ())) < least or keep_first and owner.get(x) == key]
        out.append((key, "\n".join(left), len(had) - len(left)))
    return sorted(out, key=str)


@pytest.mark.parametrize("keep_first", [True, False])
def test_against_brute_force(docs_of, rng, keep_first):
    """Lines on 1 to 14 sites around the limit of 6, repeated within documents, in any order."""
    lines = [(f"line {k}", rng.sample(range(20), k % 14 + 1)) for k in range(40)] + [("", range(20)), (" \t", range(20))]
    rows = []
    for i in range(300):
        site = rng.randrange(20)
        own = [x for x, on in lines if site in on and rng.random() < 0.7]
        rng.shuffle(own)
        rows.append((rng.choice([i, i, i, None, i // 2]), "\n".join(own + own[:1]), "en", None if site == 7 else f"s{site}"))
    rows += [(900, None, "en", "s1"), (901, "", "en", "s1"), (902, "alone " * 100_000 + "\nline 13", "en", "s2")] + rows[:3]
    got = line_dedup(docs_of(rows), least_sites=6, keep_first=keep_first)
    assert sorted(((r.doc_id, r.text, r.n_lines_removed) for r in got.collect()), key=str) == brute(rows, 6, keep_first)
    assert "fp" in got.columns


def test_near_the_limit_is_exact(docs_of):
    rows = [(i, f"nine{x}\nten{x}" if i < 9 else f"ten{x}", "en", f"s{i}") for x in range(30) for i in range(10)]
    rows = [(1000 * k + r[0], *r[1:]) for k, r in enumerate(rows)]
    found = spread(occurrences(docs_of(rows), "doc_id", "source", "text"), 10)
    assert found.count() == 30


def test_empty_table(spark):
    assert line_dedup(spark.createDataFrame([], "doc_id bigint, text string, source string")).collect() == []


def test_clashing_names(spark, rng):
    """Extra columns with the names that the operator uses itself, in either case, dotted ones, and one with the name of its result."""
    rows = [(k, f"shared line\nown {k}", "en", f"site{k % 12}") for k in range(24)]
    plain = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    names = ["_gone", "_key", "_text_id", "key", "text_id", "Line", "id", "owner", "sites", "sketch", "lines", "_lines", "a.b", "n_lines_removed", "x y"]
    from pyspark.sql import functions as F

    clashing = plain.select("*", *[F.lit(f"other {c}").alias(c) for c in names])
    got = line_dedup(clashing)
    assert got.columns == [c for c in clashing.columns if c != "n_lines_removed"] + ["n_lines_removed"]
    assert {r["a.b"] for r in got.collect()} == {"other a.b"} and {r["_gone"] for r in got.collect()} == {"other _gone"}
    pick = ["doc_id", "text", "n_lines_removed"]
    assert sorted(got.select(*pick).collect()) == sorted(line_dedup(plain).select(*pick).collect())
    assert sum(r["n_lines_removed"] for r in got.select("n_lines_removed").collect()) == 23
