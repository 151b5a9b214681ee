from __future__ import annotations

import hashlib

import pytest

from sessionsmith.llm.substring_dedup import substring_dedup


def brute(rows):
    words = [(t or "").encode().split() for _, t in rows]
    first = {}
    for (key, _), w in zip(rows, words, strict=True):
        if key is not None:
            for i in range(len(w) - 49):
                window = tuple(w[i : i + 50])
                first[window] = min(key, first.get(window, key))
    out = []
    for (key, _), w in zip(rows, words, strict=True):
        gone = [False] * len(w)
        for i in range(len(w) - 49) if key is not None else ():
            if first[tuple(w[i : i + 50])] < key:
                gone[i : i + 50] = [True] * 50
        out.append((key, len(w), sum(gone), hashlib.sha256(b" ".join(x for x, g in zip(w, gone, strict=True) if not g)).hexdigest()))
    return sorted(out, key=str)


def of(df):
    return sorted((tuple(r) for r in substring_dedup(df).collect()), key=str)


@pytest.mark.parametrize("vocabulary", [2, 400])
def test_against_brute_force(docs_of, rng, vocabulary):
    """Passages cut at all lengths around the window, pasted with changes, repeated inside documents, copies, repeated ids."""
    voc = [f"w{i}" for i in range(vocabulary)]
    base = [[rng.choice(voc) for _ in range(rng.randint(40, 300))] for _ in range(12)]
    rows = []
    for i in range(150):
        text = []
        for _ in range(rng.randint(1, 4)):
            b = rng.choice(base)
            a = rng.randrange(len(b))
            text += b[a : a + rng.choice([20, 49, 50, 51, 60, 75, 120, 300])] + [rng.choice(voc) for _ in range(rng.choice([0, 0, 1, 3, 30]))]
        rows.append((rng.choice([i, i, i, i // 2, None]), rng.choice([" ", "  ", "\n", "  "]).join(text) if rng.random() < 0.9 else " ".join(rng.choice(base))))
    rows += [(500, None), (501, ""), (502, " \n"), (503, "x " * 60), (504, "x " * 61)] + rows[:6]
    rng.shuffle(rows)
    assert of(docs_of(rows, "doc_id bigint, text string")) == brute(rows)


def test_very_long_text(docs_of, rng):
    long = [f"u{i}" for i in range(300_000)]
    passage = long[123_456:123_520]
    rows = [(1, " ".join(long)), (2, "a b " + " ".join(passage) + " c"), (3, " ".join(passage[:49]))]
    got = {r[0]: r[2] for r in of(docs_of(rows, "doc_id bigint, text string"))}
    assert got == {1: 0, 2: 64, 3: 0}


def test_empty_table(spark):
    assert of(spark.createDataFrame([], "doc_id bigint, text string")) == []
