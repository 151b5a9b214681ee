from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np

from sessionsmith.llm import quality_rules as Q

SPACE = r"[^\x20\x09-\x0D]+"


def brute(text):
    words = re.findall(SPACE, text or "")
    seen = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {j for i in range(len(words) - 4) if seen[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if re.search(SPACE, x)]
    return len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def test_counts(rng):
    texts = ["", "  \n", "é b c ü|<#", "\n\n a\na\n a\n"]
    texts += ["".join(rng.choice(["a", "b", "c", " ", " ", "\n", "\t", "é"]) for _ in range(rng.randint(0, 200))) for _ in range(300)]
    got = Q.measured([t.encode() for t in texts])
    for i, t in enumerate(texts):
        assert tuple(int(got[c][i]) for c in Q.COUNTS[:5]) == brute(t), t


def test_sketch_quantiles_and_merge(spark, rng):
    rows = [(f"l{i % 2}", f"s{i % 6}", rng.expovariate(1) if i % 7 else 0.0) for i in range(3000)]
    df = spark.createDataFrame(rows, "lang string, source string, v double")
    for m in Q.MEASURES:
        df = df.withColumn(m, df["v"])
    table = {(r.level, r.lang, r.source): r for r in Q.fences(Q.merged(Q.sketches(df, "lang", "source")), reach=1.0).collect()}
    for (level, lang, source), r in table.items():
        values = [v for a, b, v in rows if (level > 1 or a == lang) and (level > 0 or b == source)]
        assert r.docs == len(values)
        of = lambda v: Q.ZERO_BUCKET if v <= Q.ZERO else math.ceil(math.log(v) / math.log(Q.GROWTH))
        q1, q3 = (of(v) for v in np.quantile(values, [0.25, 0.75], method="inverted_cdf"))
        assert (r.low_symbol_ratio, r.high_symbol_ratio) == (q1 - (q3 - q1), q3 + (q3 - q1))
    assert len(table) == 6 + 2 + 1


def good(rng, n=60):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(n)) + "."


def test_adaptive_verdict(docs_of, rng):
    """What is usual in one source is an outlier in another; small groups take the thresholds of their language."""
    rows = []
    for i in range(300):
        rows.append((i, good(rng), "en", "prose"))
    for i in range(300, 600):
        rows.append((i, good(rng) + " |" * rng.randint(8, 14), "en", "tables"))
    rows.append((1000, good(rng) + " |" * 12, "en", "prose"))
    rows.append((1001, good(rng) + " |" * 12, "en", "tables"))
    rows.append((1002, good(rng), "en", "small"))
    rows.append((1003, good(rng).upper() + " #" * 300, "en", "small"))
    got = {r.doc_id: r for r in Q.quality_rules(docs_of(rows), ["doc_id"]).collect()}
    assert got[1000].kept is False and got[1000].outside == ["symbol_ratio", "repeat_ratio"]  # twelve bars in a row repeat a window too
    assert got[1001].kept is True and got[1002].kept is True and got[1003].kept is False
    assert sum(got[i].kept for i in range(600)) > 590


def test_edges(docs_of, spark, rng):
    rows = [(None, None, None, None), (1, "", "en", None), (1, "", "en", None), (2, "a " * 400_000, None, "s"), (3, good(rng), None, None)]
    got = sorted(Q.quality_rules(docs_of(rows), ["doc_id"]).collect(), key=str)
    assert len(got) == 5
    by = {r.doc_id: r for r in got}
    assert by[None].base_failed and not by[None].kept and by[None].n_words == 0
    assert by[2].n_words == 400_000 and by[2].n_repeat_words == 400_000 and by[2].base_failed
    assert by[3].kept
    empty = spark.createDataFrame([], "doc_id bigint, text string, lang string, source string")
    assert Q.quality_rules(empty, ["doc_id"]).collect() == []


def test_blend_moves_with_size(docs_of, rng):
    """The more documents a source has, the more its own fences count: a value usual only there is kept once it is large."""

    def kept(n):
        rows = [(i, good(rng, rng.randint(40, 120)), "en", "prose") for i in range(400)]
        rows += [(1000 + i, " ".join(w + "|" * (rng.random() < 0.5) for w in good(rng, rng.randint(40, 120)).split()), "en", "tables") for i in range(n)]
        got = Q.quality_rules(docs_of(rows), ["doc_id"]).collect()
        assert sum(r.kept for r in got if r.doc_id < 1000) > 390
        return sum(r.kept for r in got if r.doc_id >= 1000) / n

    assert kept(3) == 0 and kept(300) > 0.95


def test_every_measure_fires(docs_of, rng):
    """Each measure rejects a text that passes the base rules and is unusual in that measure."""
    lines = lambda t, n: "\n".join(" ".join(t.split()[i::n]) for i in range(n))
    rows = [(i, lines(good(rng, rng.randint(150, 300)).capitalize(), 40), "en", "s") for i in range(300)]
    text = good(rng, 200)
    five = " ".join(text.split()[:6])
    odd = {
        "symbol_ratio": lines(" ".join(w + "|" * (i % 3 == 0) for i, w in enumerate(text.split())), 40),
        "mark_ratio": lines(" ".join(w + "!" * (i % 3 == 0) for i, w in enumerate(text.split())), 40),
        "upper_ratio": text[:400].upper() + text[400:],
        "dup_line_ratio": lines(text, 60) + "\n" + "\n".join(["a b"] * 20),
        "repeat_ratio": text + " " + five + " x y z " + five,
        "word_length": " ".join(w * 3 for w in text.split()),
    }
    rows += [(1000 + k, t, "en", "s") for k, t in enumerate(odd.values())]
    got = {r.doc_id: r for r in Q.quality_rules(docs_of(rows), ["doc_id"]).collect()}
    for k, m in enumerate(odd):
        assert not got[1000 + k].base_failed and m in got[1000 + k].outside, (m, got[1000 + k])
    assert sum(got[i].kept for i in range(300)) > 295
