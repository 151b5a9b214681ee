from __future__ import annotations

import re
import zlib
from collections import Counter

import pytest

from sessionsmith.llm import spelling as S


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) < len(b):
        a, b = b, a
    i = 0
    while i < len(b) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == (b[i + 1 :] if len(a) == len(b) else b[i:])


def brute(counts):
    out = {}
    for w, n in counts.items():
        others = [x for x in counts if near(w, x)]
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        form = best if best is not None and counts[best] >= 2 * n else None
        out[w] = [w, n, len(others), form, counts.get(form)]
    for row in out.values():
        root = row[0]
        while out[root][3]:
            root = out[root][3]
        row.append(root)
    return sorted(map(tuple, out.values()))


def vocabulary(rng, size):
    words = set()
    while len(words) < size:
        tail = "".join(rng.choice("abé") for _ in range(rng.randrange(5, 10)))
        words.add(rng.choice(["", "", "prefixes", "ÿ×"]) + tail)
    return {w: rng.choice([3, 4, 6, 8, 13, 30, 70]) for w in sorted(words)}


@pytest.mark.parametrize("pairs_each", [4096, 30, 1])
def test_against_brute_force(spark, rng, pairs_each):
    """With few letters, so that chunks are hot and words are halved again and again."""
    counts = vocabulary(rng, 350)
    words = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    assert sorted(map(tuple, S.spelling_variants(words, pairs_each).collect())) == brute(counts)


def test_hot_chunk_makes_few_pairs(spark, rng):
    """A third of all words share their first half: pairs are bounded per key, and none is lost."""
    hot = {"commonbegin" + "".join(rng.choice("abcdefghij") for _ in range(9)) for _ in range(700)}
    hot |= {w[:-1] for w in list(hot)[:50]}
    words = sorted(hot | {"".join(rng.choice("abcdefghij") for _ in range(12)) for _ in range(1400)})
    df = spark.createDataFrame([(w, 3) for w in words], "word string, n bigint")
    got = {tuple(sorted((r["a"], r["b"]))) for r in S.near_pairs(df, 200).collect()}
    assert got == {(a, b) for i, a in enumerate(words) for b in words[i + 1 :] if near(a, b)} and len(got) >= 50


def test_long_way_to_the_root(spark):
    words = ["aaaaaaaa", "baaaaaaa", "bbaaaaaa", "bbbaaaaa", "bbbbaaaa", "bbbbbaaa", "bbbbbbaa"]
    df = spark.createDataFrame([(w, 3 * 2**i) for i, w in enumerate(words)], "word string, n bigint")
    assert {r["root"] for r in S.spelling_variants(df).collect()} == {words[-1]}


def test_word_counts(docs_of, rng):
    """Runs of letters up to U+00FF, lower case of A-Z only, a letter lost where the checksum says so, whole texts, repeated rows."""
    some = ["Hello", "hELLO", "Élan", "ÉCOLE", "éCole", "naïve", "x×y÷zzz", "abcd", "Ābcdef", "word_word", "a1bcdefg"]
    rows = [(k, " ".join(rng.choice(some) for _ in range(rng.randrange(60))), "en", "s") for k in range(200)]
    rows += [(None, "Hello " * 5, "en", "s"), (900, None, "en", "s"), (901, "", "en", "s"), (902, "q" * 3000, "en", "s"), (903, "hello-" * 4000, "en", "s")] + [(904, "twice there", "en", "s")] * 3
    want: Counter = Counter()
    for k, t, _, _ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if k is None else k}:{low}".encode())
            if h % 97 == 0:
                low = low[: h % len(low)] + low[h % len(low) + 1 :]
            want[low] += 1
    want = {w: n for w, n in want.items() if len(w) >= 5 and n >= 3}
    assert {r["word"]: r["n"] for r in S.word_counts(docs_of(rows)).collect()} == want
    assert any(w.startswith("É") for w in want)


def test_empty(spark, docs_of):
    assert S.spelling_variants(S.word_counts(docs_of([]))).collect() == []
    one = spark.createDataFrame([("alone", 5)], "word string, n bigint")
    assert list(map(tuple, S.spelling_variants(one).collect())) == [("alone", 5, 0, None, None, "alone")]
