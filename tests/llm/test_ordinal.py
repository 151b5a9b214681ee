from __future__ import annotations

import numpy as np

from sessionsmith.llm import ordinal as O


def corpus(rng, n=900):
    words = [f"w{i}" for i in range(800)]
    rows, grades = [], []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randint(10, 120))]
        g = 2 if i % 3 else rng.randint(0, 1)
        if g < 2:
            text += [rng.choice(["loser", "idiot", "scum"]) for _ in range(2 - g)] + [rng.choice(words) + "%%%" for _ in range(6 * (1 - g))]
        rng.shuffle(text)
        rows.append((i, " ".join(text), "en", "s"))
        grades.append((i, g))
    return rows, grades


def test_gradient_gives_the_likeliest_thresholds():
    """Without telling features the model gives each grade its share."""
    grades = np.array([0] * 20 + [1] * 30 + [2] * 50)
    model = O.fit(grades, np.arange(101), np.zeros(100, np.int64), 3)
    assert np.allclose(model.tails(np.zeros(1))[0], [0.8, 0.5], atol=0.02)
    assert model.thresholds[0] < model.thresholds[1]


def test_held_out_grades(spark, docs_of, rng):
    rows, grades = corpus(rng)
    known = spark.createDataFrame([g for g in grades if g[0] % 4] + [(None, 1), (3, 99), (6, None)], "doc_id bigint, grade int")
    model = O.train(docs_of(rows), known, 3)
    got = {r.doc_id: r for r in O.grade(docs_of(rows), model, ["doc_id"]).collect()}
    held = [(got[i], g) for i, g in grades if i % 4 == 0]
    assert np.mean([O.LEAST_TAIL <= r.tails[1] for r, g in held if g == 2]) > 0.95
    assert np.mean([O.LEAST_TAIL <= r.tails[1] for r, g in held if g < 2]) < 0.15
    expected = [np.mean([r.expected_grade for r, g in held if g == k]) for k in range(3)]
    assert expected[0] < expected[1] < expected[2]
    assert all(1 >= r.tails[0] >= r.tails[1] >= 0 and abs(r.expected_grade - sum(r.tails)) < 1e-12 for r, _ in held)


def test_same_model_however_rows_are_dealt(spark, docs_of, rng):
    rows, grades = corpus(rng, 200)
    known = spark.createDataFrame(grades, "doc_id bigint, grade int")
    a = O.train(docs_of(rows), known, 3)
    rng.shuffle(rows)
    b = O.train(docs_of(rows).repartition(7), known, 3)
    assert np.array_equal(a.weights, b.weights) and np.array_equal(a.thresholds, b.thresholds)


def test_edges(spark, docs_of):
    rows = [(None, None, "en", "s"), (1, "", "en", "s"), (1, "", "en", "s"), (2, "word " * 300_000, "en", "s")]
    none = spark.createDataFrame([], "doc_id bigint, grade int")
    got = O.grade(docs_of(rows), O.train(docs_of(rows), none, 3), ["doc_id"]).collect()
    assert len(got) == 4 and all(r.tails == [0.5, 0.5] for r in got)
    one = O.train(docs_of(rows), spark.createDataFrame([(2, 2)], "doc_id bigint, grade int"), 3)
    assert len(O.grade(docs_of(rows), one, ["doc_id"]).collect()) == 4
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert O.grade(empty, O.train(empty, none, 3), ["doc_id"]).collect() == []


def test_fit_is_the_likeliest():
    """On a small table no small change of a weight or a threshold raises the likelihood that is computed row by row."""
    rng = np.random.default_rng(4)
    rows, grades = [], []
    for _ in range(400):
        g = int(rng.integers(0, 3))
        has = [f for f, p in ((0, 0.2 + 0.3 * g), (1, 0.7 - 0.3 * g), (2, 0.5)) if rng.random() < p] + [3 + int(rng.integers(0, 5))]
        rows.append(np.array(has))
        grades.append(g)
    grades = np.array(grades)
    indptr = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    ridge = 3e-5
    model = O.fit(grades, indptr, np.concatenate(rows), 3, rounds=1500, ridge=ridge)

    def value(weights, cuts):
        total = 0.0
        for r, g in zip(rows, grades, strict=True):
            own = [float(weights[f]) for f in r]
            s = sum(x for x in own if x < 0) + O.SPREAD / len(r) * sum(x for x in own if x > 0)
            at_least = [1.0, *(1 / (1 + np.exp(c - s)) for c in cuts), 0.0]
            total += np.log(at_least[g] - at_least[g + 1])
        return total / len(rows) - ridge / 2 * float((weights**2).sum())

    small = model.weights[:8].astype(float)
    assert small[0] > 0 > small[1] and not small[3:].any()
    best = value(small, model.thresholds)
    for k in range(2):
        for move in (-0.02, 0.02):
            other = small.copy()
            other[k] += move
            assert value(other, model.thresholds) <= best + 1e-4
            cuts = model.thresholds.copy()
            cuts[k] += move
            assert value(small, cuts) <= best + 1e-4


def test_texts_without_evidence_are_not_selected(spark, docs_of):
    """Null, empty and short texts, and marks without words, are not selected by a model that keeps ordinary documents."""
    from sessionsmith.llm.common import table

    sf = "/root/testdata/sf0.01"
    ratings = table(spark, sf, "labels").selectExpr("doc_id", "quality + 1 - toxic AS grade")
    docs = table(spark, sf, "documents")
    model = O.train(docs, ratings, 3)
    rows = [(1, None, "en", "s"), (2, "", "en", "s"), (3, "x", "en", "s"), (4, "the", "en", "s"), (5, "%%% ### &&& *** $$$ " * 20, "en", "s")]
    got = O.grade(docs_of(rows), model, ["doc_id"]).collect()
    assert all(r.tails[1] < O.LEAST_TAIL for r in got)
    assert all(r.expected_grade == 0 for r in got if r.doc_id in (1, 2))
    good = docs.join(ratings.where("grade = 2"), "doc_id").where("size(split(text, ' ')) >= 10")
    kept = [r.tails[1] >= O.LEAST_TAIL for r in O.grade(good, model, ["doc_id"]).collect()]
    assert np.mean(kept) > 0.97
