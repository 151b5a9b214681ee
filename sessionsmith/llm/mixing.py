"""Mixing to target weights when documents belong to domains only softly.

A naive Bayes classifier over hashed words, fitted on a labelled table, gives each document a posterior over domains. Its
tokens then count towards each domain by that share. Projected gradient steps on a least-squares objective find a
nonnegative rate for each document such that the expected token totals of the domains match their targets. A step needs the
domains' totals only (one aggregate of as many sums as there are domains); the new rates follow row by row.

All of it is DataFrame operations: no Python runs on executors.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

#: Hashed words. So many that telling words seldom share one with others.
BUCKETS = 1 << 30
#: Rows of a classifier that is broadcast (some 40 bytes each); a larger one is joined by shuffle.
BROADCAST_ROWS = 500_000
#: The classifier is fitted on at most about this many labelled documents, drawn by a hash of their key.
TRAIN_DOCS = 20_000
#: A hashed word counts if its occurrence depends on the domain: least chi-squared statistic, over the domains.
LEAST_CHI2 = 25.0
#: ... and if at least this fraction of a domain's documents have it: a few like documents must not make a domain.
LEAST_SHARE = 0.02
#: ... and if its log odds between a domain and the others are at least this, in absolute value.
LEAST_ODDS = 1.5
#: ... and if at least this many documents bear it out.
LEAST_DOCS = 5
#: Steps of the fit, at most, and the relative error of the totals that ends it.
STEPS = 60
TOLERANCE = 1e-6


def words(text: Column) -> Column:
    """Words of a text; none for a null."""
    return F.coalesce(F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), ""), F.array().cast("array<string>"))


def hashed(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(BUCKETS)).cast("int")


class Classifier(NamedTuple):
    #: (bucket, w_0, w_1, ...): evidence of a word for each domain
    weights: DataFrame
    #: log probability of each domain
    priors: list[float]
    #: [k][j]: probability that a document of domain k has a word that speaks for domain j. So a document without any counts too.
    present: list[list[float]]


def classifier(docs: DataFrame, labels: DataFrame, n_domains: int, key: str = "doc_id", text: str = "text", train_docs: int = TRAIN_DOCS) -> Classifier:
    """Naive Bayes over the distinct hashed words of labelled documents.

    ``labels`` has ``key`` and ``domain`` from 0; nulls and other values don't count, of several for a key the least does.
    Without labels all domains are as likely.
    """
    labels = labels.where(F.col("domain").between(0, n_domains - 1) & F.col(key).isNotNull()).groupBy(key).agg(F.min("domain").alias("domain"))
    there = labels.count()
    drawn = F.pmod(F.xxhash64(F.lit("mix"), F.col(key)), F.lit(1_000_000)) < int(1_000_000 * min(1.0, train_docs / max(there, 1)))
    some = docs.select(key, text).where(drawn).join(labels.where(drawn), key)
    sets = some.select("domain", F.array_sort(F.array_distinct(F.transform(words(F.col(text)), hashed))).alias("buckets"))
    some = stored(sets.dropDuplicates(["domain", "buckets"]))  # copies are no further evidence
    of = {r.domain: (r.docs, r.words) for r in some.groupBy("domain").agg(F.count(F.lit(1)).alias("docs"), F.sum(F.size("buckets")).alias("words")).collect()}
    n = [of.get(k, (0, 0))[0] for k in range(n_domains)]
    size = [float(of.get(k, (0, 0))[1]) for k in range(n_domains)]  # by words: domains of longer documents have more of any word
    total = sum(size)
    has = [F.count_if(F.col("domain") == k).cast("double").alias(f"n_{k}") for k in range(n_domains)]
    seen = some.select("domain", F.explode("buckets").alias("bucket")).groupBy("bucket").agg(*has).withColumn("n", sum(F.col(f"n_{k}") for k in range(n_domains)))

    def chi2(k: int) -> Column:
        share = size[k] / max(total, 1)
        spread = F.col("n") * (share * (1 - share))
        return F.when(spread > 1e-9, F.pow(F.col(f"n_{k}") - F.col("n") * share, F.lit(2.0)) / spread).otherwise(0.0)

    often = F.greatest(F.lit(0.0), *[F.col(f"n_{k}") / max(1, n[k]) for k in range(n_domains)]) >= LEAST_SHARE

    def evidence(k: int) -> Column:
        """Log odds of the word in domain k against all others, where they are telling."""
        odds = F.log((F.col(f"n_{k}") + 0.5) / (size[k] + 1.0)) - F.log((F.col("n") - F.col(f"n_{k}") + 0.5) / (total - size[k] + 1.0))
        enough = F.when(odds > 0, F.col(f"n_{k}")).otherwise(F.col("n") - F.col(f"n_{k}")) >= LEAST_DOCS
        return F.when(enough & (chi2(k) >= LEAST_CHI2) & (F.abs(odds) >= LEAST_ODDS), odds).otherwise(0.0)

    weights = [evidence(k).alias(f"w_{k}") for k in range(n_domains)]
    model = stored(seen.where(often).select("bucket", *weights).where(" or ".join(f"w_{k} <> 0" for k in range(n_domains))))
    told = gathered(some.select(F.monotonically_increasing_id().alias("_row"), "domain", "buckets"), ["domain"], model, n_domains)
    hits = {r.domain: r for r in told.groupBy("domain").agg(*[F.sum(f"z_{j}").alias(f"z_{j}") for j in range(n_domains)]).collect()}
    present = [[((hits[k][f"z_{j}"] if k in hits else 0) + 0.5) / (n[k] + 1.0) for j in range(n_domains)] for k in range(n_domains)]
    return Classifier(model, [math.log((c + 1) / (sum(n) + n_domains)) for c in n], present)


def gathered(rows: DataFrame, keep: list[str], model: DataFrame, n_domains: int) -> DataFrame:
    """Per row (``_row``, ``keep``, ``buckets``): for each domain the evidence s_k of its words, and z_k: 1 if any word speaks for it."""
    words = rows.select("_row", *keep, F.explode_outer("buckets").alias("bucket"))
    small = model.count() <= BROADCAST_ROWS
    joined = words.join(F.broadcast(model) if small else model, "bucket", "left")
    sums = [F.coalesce(F.sum(f"w_{k}"), F.lit(0.0)).alias(f"s_{k}") for k in range(n_domains)]
    return joined.groupBy("_row", *keep).agg(*sums, *[F.max(F.when(F.col(f"w_{k}") > 0, 1).otherwise(0)).alias(f"z_{k}") for k in range(n_domains)])


def memberships(docs: DataFrame, fitted: Classifier, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns, ``n_tokens`` and ``p`` (posterior of each domain) of every row."""
    domains = range(len(fitted.priors))
    names = [f"_k{i}" for i in range(len(keep))]
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), *[F.col(c).alias(k) for c, k in zip(keep, names, strict=True)], words(F.col(text)).alias("_words"))
    rows = rows.select("_row", *names, F.size("_words").cast("bigint").alias("_n"), F.array_distinct(F.transform("_words", hashed)).alias("buckets"))
    sums = gathered(rows, [*names, "_n"], fitted.weights, len(fitted.priors))

    def score(k: int) -> Column:
        patterns = [F.when(F.col(f"z_{j}") == 1, math.log(q)).otherwise(math.log(1 - q)) for j, q in enumerate(fitted.present[k])]
        return sum(patterns, F.col(f"s_{k}") + fitted.priors[k])

    scored = sums.select(*names, "_n", *[score(k).alias(f"t_{k}") for k in domains])
    top = F.greatest(*[F.col(f"t_{k}") for k in domains]) if len(fitted.priors) > 1 else F.col("t_0")
    mass = [F.exp(F.col(f"t_{k}") - top) for k in domains]
    return scored.select(*[F.col(k).alias(c) for c, k in zip(keep, names, strict=True)], F.col("_n").alias("n_tokens"), F.array(*[m / sum(mass) for m in mass]).alias("p"))


def inverse(matrix: list[list[float]], damping: float) -> list[list[float]]:
    """Of a small matrix and a ridge, by elimination. The ridge is a fraction of the trace; a large one leaves a short plain gradient step."""
    n = len(matrix)
    ridge = damping * max(1e-300, sum(matrix[i][i] for i in range(n)))
    rows = [[*(x + ridge * (i == j) for j, x in enumerate(row)), *(float(i == j) for j in range(n))] for i, row in enumerate(matrix)]
    for i in range(n):
        best = max(range(i, n), key=lambda r: abs(rows[r][i]))
        rows[i], rows[best] = rows[best], rows[i]
        rows[i] = [x / rows[i][i] for x in rows[i]]
        for r in range(n):
            if r != i:
                rows[r] = [x - rows[r][i] * y for x, y in zip(rows[r], rows[i], strict=True)]
    return [row[n:] for row in rows]


def fitted_rates(members: DataFrame, weights: Sequence[float], steady: int | None = None, most: float | None = None, steps: int = STEPS, tolerance: float = TOLERANCE) -> tuple[Column, list[float], list[float]]:
    """The rate of a row of ``members`` (a stored table with ``n_tokens`` and ``p``) as a column, the targets, and the totals that the rates give.

    Targets share a total by ``weights``: the tokens there are or, with ``steady``, as many as leave that domain its own.
    Rates are at least 0 and, with ``most``, at most that; they start at 1. With A the domains' expected tokens per unit of each rate, a step goes down the gradient of
    |A r - target|^2, scaled by (A N^-1 A')^-1 over the rates that no bound holds, N the documents' tokens, and is clipped
    at the bounds; a step that would not lower |A r - target| is damped to a shorter, plainer one. The scaling makes few steps
    enough, and a document's length doesn't bend its rate. Targets that no rates reach are approached as far as steps help. A rate is a chain of
    the clipped steps, so no step writes a table.
    """
    domains = range(len(weights))
    n, p = F.col("n_tokens").cast("double"), [F.col("p")[k] for k in range(len(weights))]
    pairs = [(i, j) for i in domains for j in domains if i <= j]

    def sums(rate: Column) -> list[float]:
        return [float(x) for x in members.agg(*[F.coalesce(F.sum(n * p[i] * rate), F.lit(0.0)) for i in domains]).first()]

    def gram(rate: Column, error: list[float]) -> list[list[float]]:
        """A N^-1 A' over the rates that a step down the gradient changes."""
        slope = sum(p[i] * error[i] for i in domains)
        free = (rate > 0) | (slope < 0)
        if most is not None:
            free = free & ((rate < most) | (slope > 0))
        got = members.agg(*[F.coalesce(F.sum(F.when(free, n * p[i] * p[j])), F.lit(0.0)) for i, j in pairs]).first()
        matrix = [[0.0] * len(weights) for _ in domains]
        for (i, j), x in zip(pairs, got, strict=True):
            matrix[i][j] = matrix[j][i] = float(x)
        return matrix

    rate = F.lit(1.0 if most is None else min(1.0, most))
    totals = sums(rate)
    share = [w / sum(weights) for w in weights]
    whole = sum(totals) if steady is None or not share[steady] else totals[steady] / share[steady]
    targets = [s * whole for s in share]
    off = lambda totals: sum((x - t) ** 2 for x, t in zip(totals, targets, strict=True))
    damping, matrix = 1e-9, None
    for _ in range(steps):
        error = [x - t for x, t in zip(totals, targets, strict=True)]
        if max(map(abs, error)) <= tolerance * max(whole, 1.0) or damping > 1e6:
            break
        matrix = matrix or gram(rate, error)
        metric = inverse(matrix, damping)
        move = [sum(metric[i][j] * error[j] for j in domains) for i in domains]
        further = F.greatest(F.lit(0.0), rate - sum(p[i] * move[i] for i in domains))
        further = further if most is None else F.least(F.lit(float(most)), further)
        got = sums(further)
        if off(got) < off(totals):
            gain = 1 - off(got) / off(totals)
            rate, totals, matrix, damping = further, got, None, max(1e-9, damping / 10)
            if gain < 1e-5:
                break
        else:
            damping *= 30
    return rate, targets, totals


def mixed(docs: DataFrame, labels: DataFrame, weights: Sequence[float], keep: list[str], key: str = "doc_id", text: str = "text", steady: int | None = None, most: float | None = None, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """``keep`` columns, ``n_tokens``, ``p`` and ``rate`` of every row.

    A null or empty text has no tokens: it belongs to the domains by their priors, gets a rate like others and adds nothing.
    Rows that repeat each count. Null keys have no label but get a rate. An empty table gives an empty one.
    """
    members = stored(memberships(docs, classifier(docs, labels, len(weights), key, text, train_docs), keep, text))
    rate, _, _ = fitted_rates(members, weights, steady, most)
    return members.withColumn("rate", rate)


def drawn(rate: Column, *keys: str) -> Column:
    """Whether a row is drawn, each at most once: the fraction of its rate as a chance, decided by a hash of ``keys``."""
    return F.pmod(F.xxhash64(F.lit("draw"), *[F.col(k) for k in keys]), F.lit(1 << 40)) < rate * (1 << 40)
