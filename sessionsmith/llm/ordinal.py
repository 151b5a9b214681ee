"""Ordinal quality grades by cumulative-link regression on hashed text.

A text is a set of hashed features: its distinct words, their first and last characters, and how often words repeat. Each
has one weight of either sign. A weight below zero counts whole: one telling word is enough, however long the text. Weights
above zero count by their mean over the text's features, so that much ordinary text doesn't outweigh a few telling words, and
words that were never seen dilute them. The score s is shared by all grades and cut by ordered thresholds t_1 < t_2 < ...:
P(grade >= j) = 1 / (1 + exp(t_j - s)). The expected grade and a tail probability follow and select documents.

A text of fewer than ``LEAST_WORDS`` words is no evidence for a grade: its tail probabilities are lowered in proportion, to
zero for one without words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import in_batches, stored

LOG_FEATURES = 21
#: The fit uses at most about this many labelled documents, drawn by a hash of their key.
TRAIN_DOCS = 12_000
ROUNDS = 200
#: A document is selected if its tail probability is at least this.
LEAST_TAIL = 0.8
REMEMBERED = 300_000
#: The mean of weights above zero counts so many times.
SPREAD = 10.0
LEAST_WORDS = 5


#: A feature has a weight if its occurrence depends on the grade: least chi-squared statistic, over all cuts of the grades.
LEAST_CHI2 = 12.0


def features_of(word: bytes) -> tuple[int, int, int]:
    mask = (1 << LOG_FEATURES) - 1
    return xxhash.xxh64_intdigest(word, 0) & mask, xxhash.xxh64_intdigest(word[:5], 1) & mask, xxhash.xxh64_intdigest(word[-3:], 2) & mask


def level(words: list[bytes], distinct: int) -> int:
    """The feature of the share of words that are repeats, in tenths."""
    return xxhash.xxh64_intdigest(b"%d" % (10 * (len(words) - distinct) // max(1, len(words))), 3) & ((1 << LOG_FEATURES) - 1)


@dataclass
class Model:
    weights: np.ndarray
    thresholds: np.ndarray
    least_words: int = 0  # of a model that has seen ratings: LEAST_WORDS

    def tails(self, score: np.ndarray, n_words: np.ndarray | None = None) -> np.ndarray:
        """P(grade >= j), j from 1, as columns."""
        tails = 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - score[:, None], -60, 60)))
        return tails if n_words is None or not self.least_words else tails * np.minimum(1, n_words / self.least_words)[:, None]


def dependence(at: np.ndarray, row: np.ndarray, often: np.ndarray, grades: np.ndarray, n_grades: int) -> np.ndarray:
    """Per feature the greatest chi-squared statistic of its occurrence against grade >= j."""
    n, best = len(grades), np.zeros(len(often))
    for j in range(1, n_grades):
        high = grades >= j
        share = high.mean()
        if 0 < share < 1:
            got = np.bincount(at, high[row], minlength=len(often))
            spread = often * share * (1 - share) * (1 - often / n)
            best = np.maximum(best, (got - often * share) ** 2 / np.maximum(spread, 1e-9) * (often < n))
    return best


def fit(grades: np.ndarray, indptr: np.ndarray, index: np.ndarray, n_grades: int, rounds: int = ROUNDS, ridge: float = 3e-5) -> Model:
    """Greatest likelihood with a ridge penalty, by gradient steps with a rate per coordinate. Row i has the distinct features index[indptr[i]:indptr[i + 1]].

    A weight that leaves zero goes down if that raises the likelihood, else up; one that would change its sign stops at zero first.
    """
    n = len(grades)
    share_of = SPREAD / np.maximum(np.diff(indptr), 1)  # what a weight above zero counts in each row
    row = np.repeat(np.arange(n), np.diff(indptr))
    used, at, often = np.unique(index, return_inverse=True, return_counts=True)
    known = dependence(at, row, often, grades, n_grades) >= LEAST_CHI2
    place = np.cumsum(known) - 1
    inside = known[at]
    row, index, used = row[inside], place[at[inside]], used[known]
    share = np.array([(grades >= j).mean() for j in range(1, n_grades)]).clip(0.5 / max(n, 1), 1 - 0.5 / max(n, 1))
    weights = np.zeros(len(used))
    base, gaps = -np.log(share[0] / (1 - share[0])), np.diff(-np.log(share / (1 - share))).clip(1e-2)
    steps = np.log(gaps)
    moment, square = np.zeros(len(weights) + n_grades - 1), np.zeros(len(weights) + n_grades - 1)
    for k in range(1, rounds + 1):
        cuts = base + np.concatenate([[0], np.cumsum(np.exp(steps))])
        of = weights[index]
        score = np.bincount(row, np.where(of < 0, of, of * share_of[row]), minlength=n)
        # with F the logistic function, P(grade = j) = F(t_{j+1} - s) - F(t_j - s)
        upper = np.append(cuts, 1e9)[grades] - score
        lower = np.insert(cuts, 0, -1e9)[grades] - score
        f = lambda x: 1 / (1 + np.exp(-np.clip(x, -60, 60)))
        fu, fl = f(upper), f(lower)
        p = np.maximum(fu - fl, 1e-12)
        du, dl = fu * (1 - fu) / p, fl * (1 - fl) / p
        by_score = (du - dl) / n
        by_cut = np.zeros(n_grades + 1)
        np.add.at(by_cut, grades + 1, -du / n)
        np.add.at(by_cut, grades, dl / n)
        by_cut = by_cut[1:n_grades]
        down = np.bincount(index, by_score[row], minlength=len(weights))
        up = np.bincount(index, (by_score * share_of)[row], minlength=len(weights))
        gradient = np.where((weights < 0) | ((weights == 0) & (down > 0)), down, np.where((weights == 0) & (up > 0), 0, up)) + ridge * weights
        by_step = np.cumsum(by_cut[::-1])[::-1][1:] * np.exp(steps)
        full = np.concatenate([gradient, [by_cut.sum()], by_step])
        moment = 0.9 * moment + 0.1 * full
        square = 0.99 * square + 0.01 * full**2
        move = 0.1 * (moment / (1 - 0.9**k)) / (np.sqrt(square / (1 - 0.99**k)) + 1e-7)
        moved = weights - move[: len(weights)]
        weights = np.where(moved * weights < 0, 0, moved)
        base -= move[len(weights)]
        steps -= move[len(weights) + 1 :]
    full = np.zeros(1 << LOG_FEATURES, np.float32)
    full[used] = weights
    return Model(full, base + np.concatenate([[0], np.cumsum(np.exp(steps))]), LEAST_WORDS)


def features(docs: DataFrame, keep: list[str], text: str) -> DataFrame:
    """``keep`` columns and the distinct features of each row's whole text (null: no words), as ``index``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for raw in batch.column(len(keep)).cast(pa.large_binary()).to_pylist():
                words = (raw or b"").split()
                distinct = set(words)
                rows.append(np.array(sorted({f for w in distinct for f in features_of(w)} | {level(words, len(distinct))}), np.int32))
            yield pa.record_batch([*batch.columns[: len(keep)], pa.array(rows, pa.list_(pa.int32()))], names=[*keep, "index"])

    schema = ", ".join([*(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep), "index array<int>"])
    return in_batches(docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`")), run, schema)


def train(docs: DataFrame, ratings: DataFrame, n_grades: int, key: str = "doc_id", text: str = "text", train_docs: int = TRAIN_DOCS) -> Model:
    """Fit on the documents that have a grade from 0 to ``n_grades`` - 1 in ``ratings`` (``key``, ``grade``).

    With more than ``train_docs`` ratings, a hash of the key draws about that many: one task fits them. Ratings that are null
    or out of range don't count; of several for a key the least does. Without any rating the model grades all alike.
    """
    ratings = ratings.where(F.col("grade").between(0, n_grades - 1) & F.col(key).isNotNull()).groupBy(key).agg(F.min("grade").cast("int").alias("grade"))
    there = ratings.count()
    drawn = F.pmod(F.xxhash64(F.lit("train"), F.col(key)), F.lit(1_000_000)) < int(1_000_000 * min(1.0, train_docs / max(there, 1)))
    some = docs.select(key, text).where(drawn).join(ratings.where(drawn), key).select("grade", text)
    rows = stored(features(some, ["grade"], text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grades, lengths, index = [], [], []
        for b in batches:
            grades.append(b.column(0).to_numpy())
            lengths.append(b.column(1).value_lengths().to_numpy())
            index.append(b.column(1).flatten().to_numpy())
        if not grades:
            return
        indptr = np.concatenate([[0], np.cumsum(np.concatenate(lengths))])
        flat, grades = np.concatenate(index), np.concatenate(grades)
        # rows come in any order, and sums of floats depend on it
        order = sorted(range(len(grades)), key=lambda i: (grades[i], flat[indptr[i] : indptr[i + 1]].tobytes()))
        parts = [flat[indptr[i] : indptr[i + 1]] for i in order]
        model = fit(grades[order], np.concatenate([[0], np.cumsum([len(p) for p in parts])]), np.concatenate(parts), n_grades)
        used = np.flatnonzero(model.weights)
        yield pa.record_batch([pa.array([used.tolist()], pa.list_(pa.int32())), pa.array([model.weights[used].tolist()], pa.list_(pa.float64())), pa.array([model.thresholds.tolist()], pa.list_(pa.float64()))], names=["used", "weights", "thresholds"])

    got = in_batches(rows.repartition(1), run, "used array<int>, weights array<double>, thresholds array<double>").first()
    if got is None:
        return Model(np.zeros(0, np.float32), np.zeros(n_grades - 1))
    weights = np.zeros(1 << LOG_FEATURES, np.float32)
    weights[got.used] = got.weights
    return Model(weights, np.array(got.thresholds), LEAST_WORDS)


def grade(docs: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns, ``score``, ``expected_grade`` and ``tails`` (P(grade >= 1), P(grade >= 2), ...) of every row.

    A null text counts as one without words, and a text with few words has low tails once a model has seen ratings. Repeated rows are graded alike; other columns are not read; an empty table
    gives an empty one.
    """
    weight = {int(i): float(model.weights[i]) for i in np.flatnonzero(model.weights)}
    cut = Model(None, np.array(model.thresholds), model.least_words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, tuple[int, int, int]] = {}

        def hashed(word: bytes) -> tuple[int, int, int]:
            got = known[word] = features_of(word)
            return got

        for batch in batches:
            scores, n_words = [], []
            for raw in batch.column(len(keep)).cast(pa.large_binary()).to_pylist():
                words = (raw or b"").split()
                distinct = set(words)
                if len(known) > REMEMBERED:
                    known.clear()
                found = {f for w in distinct for f in (known.get(w) or hashed(w))}
                found.add(level(words, len(distinct)))
                each = [weight[f] for f in sorted(f for f in found if f in weight)]
                scores.append(sum(x for x in each if x < 0) + SPREAD / len(found) * sum(x for x in each if x > 0))
                n_words.append(len(words))
            scores = np.array(scores, np.float64)
            tails = cut.tails(scores, np.array(n_words, np.int64))
            yield pa.record_batch([*batch.columns[: len(keep)], pa.array(scores), pa.array(tails.sum(axis=1)), pa.array(list(tails), pa.list_(pa.float64()))], names=[*keep, "score", "expected_grade", "tails"])

    schema = ", ".join([*(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep), "score double, expected_grade double, tails array<double>"])
    return in_batches(docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`")), run, schema)


def selected(tail: Column, least: float = LEAST_TAIL) -> Column:
    return tail >= least
