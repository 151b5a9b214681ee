"""Secrets in texts: fixed patterns, and a linear-chain conditional random field that finds what they miss.

A text is a chain of tokens, each tagged as outside, the beginning of a secret, or inside one. A tag's score is a sum of
weights: of the token's own shape and word, of the words and shapes of its neighbours, of features of the whole text, and of the tag
before it. The most likely tags of the chain are found by Viterbi's algorithm.

The model is trained on at most ``TRAIN_DOCS`` texts (expected number; a text is in the sample by its hash) of at most ``PIECES`` pieces each.
Labels are what the patterns find, and secrets and look-alikes of known kinds that are set into the pieces. The likelihood
and its gradient are sums over pieces that tasks make; the driver adds one vector per task and takes the step.

Weights are whole numbers in the end, so that results don't depend on the order in which they are added.
"""

from __future__ import annotations

import random
import re
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_batches, stored

# Fixed patterns of the base rules: kind, pattern, group whose length counts, least length.
RULES = (
    ("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"[0-9a-f]+", 0, 32),
)
KINDS = [kind for kind, *_ in RULES]
#: A text without any of these has no match of the first pattern.
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN = re.compile(RULES[0][1], re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
#: Matches of a run of one class that are too short can't hide longer ones, so the least length is part of these patterns.
HEX = re.compile(r"[0-9a-f]{32,}")

OUT, BEGIN, IN = 0, 1, 2
TOKEN = re.compile(r"\w+|[^\w\s]")
BUCKETS = 1 << 14
#: Training: expected number of texts, pieces of a text, characters of a piece, rounds, tasks, ridge.
TRAIN_DOCS = 2000
PIECES = 2
PIECE_CHARS = 240
ROUNDS = 25
TASKS = 8
RIDGE = 0.5
#: Weights are multiples of one part in so many.
SCALE = 1000
#: A secret that the model finds has at least so many characters, as the patterns ask.
LEAST_CHARS = 8
#: Characters whose tokens are held at a time.
SLICE = 1 << 20


# -- patterns ---------------------------------------------------------------------------------------------------------


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base rules' matches, by start, then kind. A span is the whole match; code points, end exclusive."""
    found = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= RULES[0][3]]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def base_values(text: str) -> list[tuple[int, int]]:
    """(start, end) of the secrets themselves in the base rules' matches, without the word that announces them."""
    spans = [(m.start(2), m.end(2)) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= RULES[0][3]]
    for rule in (ACCESS, HEX):
        spans += [m.span() for m in rule.finditer(text) if not any(a < m.end() and m.start() < b for a, b in spans)]
    return sorted(spans)


# -- features ---------------------------------------------------------------------------------------------------------


DIGIT, UPPER, LOWER, UNDERSCORE, MARK, OTHER = range(6)
CLASSES = np.full(129, MARK, np.uint8)
CLASSES[128] = OTHER  # anything beyond ASCII
for _c in range(128):
    CLASSES[_c] = DIGIT if chr(_c).isdigit() else UPPER if chr(_c).isupper() else LOWER if chr(_c).islower() else UNDERSCORE if _c == 95 else MARK
HEXADECIMAL = np.isin(np.arange(129), [ord(c) for c in string.hexdigits])
VOWELS = np.isin(np.arange(129), [ord(c) for c in "aeiouyAEIOUY"])
SIZES = np.array([2, 3, 4, 5, 8, 12, 16, 20, 24, 32, 40, 64])
#: Tokens before and after that a tag's score looks at.
BEFORE, AFTER = 3, 1
OWN = 10
FILE = 3
#: Features of a token's score: its own, two for each neighbour, those of the text.
EACH = OWN + 2 * (BEFORE + AFTER) + FILE


def buckets(kind: int, *values: np.ndarray | int) -> np.ndarray:
    """Hashed feature numbers of some values."""
    h = np.uint64(kind + 1) * np.uint64(0x9E3779B97F4A7C15 % (1 << 58))
    with np.errstate(over="ignore"):
        for v in values:
            h = (h ^ np.asarray(v).astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
            h = h ^ (h >> np.uint64(31))
    return (h >> np.uint64(20)).astype(np.int64) % BUCKETS


def token_features(tokens: list[str]) -> np.ndarray:
    """A row for each token: features for its own tag, then two each for the tags of the tokens 1, 2 and 3 after it and the one before it.

    They tell what a token looks like (classes of characters, how many, how they change), its first letters, and, where it is short
    and has no digit, the word.
    """
    cps = np.frombuffer("".join(tokens).encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
    starts = np.cumsum(lengths) - lengths
    place = np.arange(len(cps)) - np.repeat(starts, lengths)
    low_cps = np.minimum(cps, 128)
    classes = CLASSES[low_cps]
    count = lambda where: np.add.reduceat(where.astype(np.int64), starts)
    n_of = [count(classes == k) for k in range(6)]
    mix = sum(((n > 0).astype(np.int64) << k) for k, n in enumerate(n_of))
    size = np.searchsorted(SIZES, lengths, side="right")
    share = lambda n: 10 * n // (lengths + 1)
    turns = count((place > 0) & (classes != np.concatenate([classes[:1], classes[:-1]])))
    first = cps[starts].astype(np.int64)
    mark = np.where((lengths == 1) & ((mix >> MARK) & 1 == 1), first, 0)
    spelled = np.where(classes == UPPER, cps + 32, cps).astype(np.uint64)
    with np.errstate(over="ignore"):
        power = np.cumprod(np.full(17, 0x100000001B3, np.uint64))
        said = np.add.reduceat(spelled * power[np.minimum(place, 16)], starts)
        head = np.add.reduceat(np.where(place < 3, cps.astype(np.uint64) * power[np.minimum(place, 16)], np.uint64(0)), starts)
    word = np.where((lengths <= 16) & (n_of[DIGIT] == 0), said, np.uint64(1))
    mixed = (n_of[UPPER] > 0) & (n_of[LOWER] > 0) & ~((n_of[UPPER] == 1) & (classes[starts] == UPPER))
    columns = [
        buckets(0, mix, mark), buckets(1, mix, size), buckets(2, count(~HEXADECIMAL[low_cps]) == 0, size), buckets(3, share(turns), size), buckets(4, share(n_of[DIGIT])),
        buckets(5, share(n_of[UPPER])), buckets(6, share(count(VOWELS[low_cps])), mix), buckets(7, word), buckets(8, head), buckets(9, mixed, size),
    ]
    for k in range(BEFORE + AFTER):
        columns += [buckets(20 + k, word), buckets(30 + k, mix, size, mark)]
    return np.stack(columns, axis=1)


def missing(k: int) -> np.ndarray:
    """What stands for the features of neighbour ``k`` where the chain ends before it."""
    return np.array([int(buckets(40 + k, 0)), int(buckets(50 + k, 0))])


def file_features(text: str) -> np.ndarray:
    """Of the whole text: how much of it is marks as in code and settings, how much digits, how long its lines are."""
    n = max(1, len(text))
    marks = sum(text.count(c) for c in "={}[]();:\"'<>#$&|*")
    digits = sum(text.count(c) for c in string.digits)
    lines = text.count("\n") + 1
    return np.array([int(buckets(60 + k, min(9, x))) for k, x in enumerate((50 * marks // n, 50 * digits // n, 200 * lines // n))])


def chain_features(own: np.ndarray, file: np.ndarray) -> np.ndarray:
    """(tokens, EACH) features of a chain whose tokens have the features ``own``."""
    n = len(own)
    out = np.empty((n, EACH), np.int64)
    out[:, :OWN] = own[:, :OWN]
    for k in range(BEFORE + AFTER):
        at = slice(OWN + 2 * k, OWN + 2 * k + 2)
        out[:, at] = missing(k)
        if k < BEFORE and n > k + 1:
            out[k + 1 :, at] = own[: n - k - 1, at]
        elif k == BEFORE and n > 1:
            out[:-1, at] = own[1:, at]
    out[:, EACH - FILE :] = file
    return out


# -- the chain --------------------------------------------------------------------------------------------------------


def likelihood(scores: np.ndarray, steps: np.ndarray, tags: np.ndarray, lengths: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Log likelihood of ``tags`` of a batch of chains, and its gradient by scores and steps, by messages forward and backward.

    ``scores`` is (chains, places, 3), ``steps`` (4, 3): from a tag to the next, and from the start (row 3).
    """
    n, most, _ = scores.shape
    alpha = np.empty_like(scores)
    beta = np.zeros_like(scores)
    alpha[:, 0] = steps[3] + scores[:, 0]
    for t in range(1, most):
        alpha[:, t] = np.logaddexp.reduce(alpha[:, t - 1, :, None] + steps[None, :3], axis=1) + scores[:, t]
    last = lengths - 1
    for t in range(most - 2, -1, -1):
        message = np.logaddexp.reduce(steps[None, :3] + (scores[:, t + 1] + beta[:, t + 1])[:, None, :], axis=2)
        beta[:, t] = np.where((t < last)[:, None], message, 0.0)
    rows = np.arange(n)
    total = np.logaddexp.reduce(alpha[rows, last], axis=1)
    inside = np.arange(most)[None, :] < lengths[:, None]
    marginal = np.exp(np.where(inside[:, :, None], alpha + beta - total[:, None, None], -np.inf))
    truth = np.eye(3)[tags] * inside[:, :, None]
    by_scores = truth - marginal
    by_steps = np.zeros((4, 3))
    by_steps[3] = (truth[:, 0] - marginal[:, 0]).sum(axis=0)
    value = (scores * truth).sum() + steps[3][tags[:, 0]].sum() - total.sum()
    if most > 1:
        pair = alpha[:, :-1, :, None] + steps[None, None, :3] + (scores + beta)[:, 1:, None, :] - total[:, None, None, None]
        both = inside[:, 1:]
        expected = np.exp(np.where(both[:, :, None, None], pair, -np.inf)).sum(axis=(0, 1))
        seen = np.einsum("nti,ntj->ij", truth[:, :-1], truth[:, 1:])
        by_steps[:3] = seen - expected
        value += (seen * steps[:3]).sum()
    return float(value), by_scores, by_steps


def viterbi(scores: list, steps: list, before: int, after: int | None) -> list[int]:
    """Best tags of a chain that follows tag ``before`` (3: the start) and, unless None, precedes ``after``. Ties: the smaller tag."""
    best = [steps[before][y] + scores[0][y] for y in range(3)]
    ways = []
    for row in scores[1:]:
        way, new = [], []
        for y in range(3):
            x = max(range(3), key=lambda x: best[x] + steps[x][y])
            way.append(x)
            new.append(best[x] + steps[x][y] + row[y])
        ways.append(way)
        best = new
    y = max(range(3), key=lambda y: best[y] + (steps[y][after] if after is not None else 0))
    tags = [y]
    for way in reversed(ways):
        y = way[y]
        tags.append(y)
    return tags[::-1]


def decode(scores: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """Viterbi's tags of a whole chain of whole-number scores.

    A stretch of tags other than outside must gain over being outside there. Its gain is at most a sum over its tokens (the
    better score, and the best step between such tags) less a fixed part for the steps into and out of it. By prefix sums,
    tokens that no stretch of enough gain covers are outside; the chain falls apart there, and what is left is searched.
    """
    n = len(scores)
    tags = np.zeros(n, np.int64)
    if not n:
        return tags
    stay = steps[OUT, OUT]
    inner = steps[1:3, 1:3].max() - stay
    into = max(steps[OUT, 1:].max() - stay, steps[3, 1:].max() - steps[3, OUT])
    out_of = max(steps[1:3, OUT].max() - stay, 0)
    gain = np.concatenate([[0], np.cumsum(scores[:, 1:].max(axis=1) - scores[:, OUT] + inner)])
    most = np.maximum.accumulate(gain[:0:-1])[::-1] - np.minimum.accumulate(gain[:-1])
    open_ = np.flatnonzero(most + into + out_of - inner >= 0)
    if not len(open_):
        return tags
    cuts = np.flatnonzero(np.diff(open_) > 1)
    step = steps.tolist()
    for i, j in zip([0, *(cuts + 1)], [*cuts, len(open_) - 1], strict=True):
        a, b = int(open_[i]), int(open_[j]) + 1
        tags[a:b] = viterbi(scores[a:b].tolist(), step, OUT if a else 3, OUT if b < n else None)
    return tags


class Scorer:
    """Scores of the tokens of texts under a model. What a token contributes is kept, up to ``most`` tokens."""

    def __init__(self, weights: np.ndarray, most: int = 500_000):
        self.weights, self.most = weights, most
        self.ids: dict[str, int] = {}
        self.parts = np.zeros((0, 3 + 3 * (BEFORE + AFTER)), np.int64)
        self.ends = [weights[missing(k)].sum(axis=0) for k in range(BEFORE + AFTER)]

    def chains(self, texts: list[str]) -> list[np.ndarray]:
        """Numbers of the texts' tokens, read in slices that end at white space."""
        if len(self.ids) > self.most:
            self.ids, self.parts = {}, self.parts[:0]
        new: list[str] = []
        out = []
        for text in texts:
            found, at = [], 0
            while at < len(text):
                space = WHITE.search(text, min(len(text), at + SLICE))
                stop = space.start() if space else len(text)
                tokens = TOKEN.findall(text, at, stop)
                for t in set(tokens):
                    if t not in self.ids:
                        self.ids[t] = len(self.ids)
                        new.append(t)
                found.append(np.fromiter(map(self.ids.__getitem__, tokens), np.int32, len(tokens)))
                at = stop + 1 if space else len(text)
            out.append(np.concatenate(found) if found else np.zeros(0, np.int32))
        for i in range(0, len(new), 1 << 16):
            f = token_features(new[i : i + (1 << 16)])
            parts = [self.weights[f[:, :OWN]].sum(axis=1), *(self.weights[f[:, OWN + 2 * k : OWN + 2 * k + 2]].sum(axis=1) for k in range(BEFORE + AFTER))]
            self.parts = np.concatenate([self.parts, np.concatenate(parts, axis=1)])
        return out

    def scores(self, chain: np.ndarray, file: np.ndarray) -> np.ndarray:
        each = self.parts[chain]
        out = each[:, :3] + self.weights[file].sum(axis=0)
        for k in range(BEFORE + AFTER):
            part = each[:, 3 + 3 * k : 6 + 3 * k]
            n = min(k + 1 if k < BEFORE else 1, len(chain))
            if k < BEFORE:
                out[n:] += part[: len(chain) - n]
                out[:n] += self.ends[k]
            else:
                out[:-n] += part[n:]
                out[-n:] += self.ends[k]
        return out


WHITE = re.compile(r"\s")


def found_spans(text: str, tags: np.ndarray) -> list[tuple[int, int]]:
    """(start, end) of the tagged secrets. A token inside without a beginning before it begins one."""
    spans: list[list[int]] = []
    inside = False
    for m, tag in zip(TOKEN.finditer(text), tags.tolist(), strict=True):
        if tag == OUT:
            inside = False
        elif tag == IN and inside:
            spans[-1][1] = m.end()
        else:
            spans.append([m.start(), m.end()])
            inside = True
    return [(a, b) for a, b in spans if b - a >= LEAST_CHARS]


# -- training ---------------------------------------------------------------------------------------------------------

# Fixed settings of secrets that the patterns miss, and of what is none.
ANNOUNCED = ("Authorization: Bearer {}", "pwd = {}", 'pass: "{}"', "password is {}", "the key is {}", "credentials: {}", "export AWS_KEY={}", "curl -u admin:{}", "client_key => '{}'", "private_key: {}", "auth {}",
             "pw: {}", "mongodb://root:{}@host", "passphrase {}", "x-auth: {}", "set key {}", "login admin {}", "bearer {}", "access key {}", "secret key is {}")
HARMLESS = ("see page {}", "call {}", "version {}", "order {}", "isbn {}", "on {}", "id {}", "file {}", "ref {}", "at {}", "price {}", "room {}", "http://{}", "mail {}", "# {}", "total: {}", "name = {}", "width: {}", "{}")


def chars(rng: random.Random, alphabet: str, least: int, most: int) -> str:
    return "".join(rng.choice(alphabet) for _ in range(rng.randint(least, most)))


def made_secret(rng: random.Random) -> str:
    alnum = string.ascii_letters + string.digits
    kind = rng.randrange(8)
    if kind == 0:
        return chars(rng, alnum, 20, 48)
    if kind == 1:
        return chars(rng, "0123456789abcdef", 24, 64)
    if kind == 2:
        return rng.choice(["ghp_", "sk-", "xoxb-", "glpat-", "AIza", "pk_live_", "npm_"]) + chars(rng, alnum, 20, 40)
    if kind == 3:
        return "eyJ" + ".".join(chars(rng, alnum + "_-", 16, 40) for _ in range(3))
    if kind == 4:
        return chars(rng, alnum + "+/", 24, 56) + rng.choice(["", "=", "=="])
    if kind == 5:
        return chars(rng, string.ascii_letters, 4, 7) + chars(rng, string.digits, 2, 4) + rng.choice("!$%_-.") + chars(rng, alnum, 3, 6)
    if kind == 6:
        return "AKIA" + chars(rng, string.ascii_uppercase + string.digits, 12, 16)
    return chars(rng, string.ascii_uppercase + string.digits, 20, 32)


def made_look_alike(rng: random.Random, words: list[str]) -> str:
    kind = rng.randrange(9)
    if kind == 0:
        return chars(rng, string.digits, 1, 18)
    if kind == 1:
        return "-".join(chars(rng, string.digits, 2, 4) for _ in range(rng.randint(2, 4)))
    if kind == 2:
        return f"{rng.choice(words)}.{rng.randint(1, 99)}@mail{rng.randint(1, 9)}.example.com"
    if kind == 3:
        return f"www.{rng.choice(words)}.org/{rng.choice(words)}/{rng.choice(words)}-{rng.randint(1, 2999)}.html"
    if kind == 4:
        return f"{rng.randint(0, 20)}.{rng.randint(0, 20)}.{rng.randint(0, 99)}"
    if kind == 5:
        return "_".join(rng.choice(words) for _ in range(rng.randint(2, 4)))
    if kind == 6:
        return "".join(rng.choice(words).capitalize() for _ in range(rng.randint(2, 4)))
    if kind == 7:
        return f"{rng.randint(1900, 2100)}-{rng.randint(1, 12):02}-{rng.randint(1, 28):02}T{rng.randint(0, 23):02}:{rng.randint(0, 59):02}"
    return rng.choice(words) + rng.choice(words)


def piece(text: str, rng: random.Random) -> tuple[str, list[tuple[int, int]]]:
    """Some characters of a text with their labels: as they are, or with a secret or a look-alike set between two words."""
    marks = [m.start() for m in ASSIGN.finditer(text)][:64]
    at = max(0, rng.choice(marks) - rng.randrange(PIECE_CHARS // 2)) if marks and rng.random() < 0.5 else rng.randrange(max(1, len(text) - PIECE_CHARS))
    part = text[at : at + PIECE_CHARS].strip()
    roll = rng.random()
    if roll < 0.35:
        return part, base_values(part)
    space = [m.start() for m in WHITE.finditer(part)] or [len(part)]
    at = rng.choice(space)
    words = [w for w in re.findall(r"[^\W\d_]+", part) if len(w) > 2] or ["word"]
    secret = roll < 0.7
    value = made_secret(rng) if secret else made_look_alike(rng, words)
    setting = rng.choice(ANNOUNCED if secret else HARMLESS)
    begin = at + 1 + setting.index("{}")
    joined = f"{part[:at]} {setting.format(value)}{part[at:]}"
    spans = base_values(joined)
    if secret:
        end = begin + len(value)
        spans = [(a, b) for a, b in spans if b <= begin or a >= end] + [(begin, end)]
    return joined, sorted(spans)


def labelled(text: str, spans: list[tuple[int, int]]) -> tuple[list[str], list[int]]:
    tokens, tags = [], []
    for m in TOKEN.finditer(text):
        tokens.append(m.group())
        own = [a for a, b in spans if a < m.end() and m.start() < b]
        tags.append(OUT if not own else BEGIN if m.start() <= own[0] or not tags or tags[-1] == OUT else IN)
    return tokens, tags


def training_chains(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(part, of, k, tags, features) of the labelled pieces of about ``TRAIN_DOCS`` texts, a stored table of ``TASKS`` parts."""
    rows = docs.where(F.col(f"`{text}`").isNotNull()).select(F.col(f"`{text}`").alias("text"))
    share = min(1.0, TRAIN_DOCS / max(1, rows.count()))
    of = F.xxhash64("text")
    picked = rows.withColumn("of", of).where(F.pmod("of", F.lit(1 << 30)) < int(share * (1 << 30))).distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for raw, h in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rng, file = random.Random(h), file_features(raw)
                for k in range(PIECES):
                    tokens, tags = labelled(*piece(raw, rng))
                    if tokens:
                        out.append((h % TASKS, h, k, tags, chain_features(token_features(tokens), file).ravel()))
            kinds = (pa.int32(), pa.int64(), pa.int32(), *[pa.list_(pa.int32())] * 2)
            yield pa.record_batch([pa.array([r[j] for r in out], t) for j, t in enumerate(kinds)], names=["part", "of", "k", "tags", "features"])

    chains = in_batches(picked, run, "part int, of bigint, k int, tags array<int>, features array<int>")
    return stored(chains.repartition(TASKS, "part"))


def train(docs: DataFrame, key: str = "doc_id", text: str = "text", rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Whole-number weights (buckets, 3) and steps (4, 3). Each round adds up the gradient that tasks make of their chains; steps follow the gradient's signs (Rprop), so no second look at the likelihood is needed."""
    chains = training_chains(docs, key, text)
    size = BUCKETS * 3 + 12
    w = np.zeros(size)
    pace, last = np.full(size, 0.1), np.zeros(size)
    for _ in range(rounds):
        gradient = gradient_of(chains, w) - RIDGE * w
        turn = np.sign(gradient * last)
        pace = np.clip(np.where(turn > 0, pace * 1.2, np.where(turn < 0, pace * 0.5, pace)), 1e-4, 1.0)
        gradient = np.where(turn < 0, 0.0, gradient)
        w = w + np.sign(gradient) * pace
        last = gradient
    whole = np.rint(w * SCALE).astype(np.int64)
    return whole[:-12].reshape(BUCKETS, 3), whole[-12:].reshape(4, 3)


def gradient_of(chains: DataFrame, w: np.ndarray) -> np.ndarray:
    """Gradient of the log likelihood of all chains: one vector per part, added in order of the parts."""
    packed = w.astype(np.float32).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = np.frombuffer(packed, np.float32).astype(np.float64)
        weights, steps = now[:-12].reshape(-1, 3), now[-12:].reshape(4, 3)
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            part = np.asarray(batch.column(0))
            for p in np.unique(part).tolist():
                some = batch.filter(pa.array(part == p))
                lengths = np.asarray(some.column(3).value_lengths())
                tags, flat = np.asarray(some.column(3).flatten()), np.asarray(some.column(4).flatten()).reshape(-1, EACH)
                spot = np.arange(lengths.max())[None, :] < lengths[:, None]
                padded, truth = np.zeros((*spot.shape, 3)), np.zeros(spot.shape, np.int64)
                padded[spot], truth[spot] = weights[flat].sum(axis=1), tags
                _, by_scores, by_steps = likelihood(padded, steps, truth, lengths)
                each = by_scores[spot]
                by_weights = np.stack([np.bincount(flat.ravel(), np.repeat(each[:, y], EACH), len(weights)) for y in range(3)], axis=1)
                sums[p] = sums.get(p, 0) + np.concatenate([by_weights.ravel(), by_steps.ravel()])
        for p, total in sums.items():
            yield pa.record_batch([pa.array([p], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["part", "total"])

    rows = sorted(chains.mapInArrow(run, "part int, total binary").collect(), key=lambda r: (r["part"], bytes(r["total"])))
    return sum((np.frombuffer(r["total"]) for r in rows), np.zeros(len(w)))


# -- the operator -----------------------------------------------------------------------------------------------------


def secrets(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``spans``: array of (kind, start, end) by start, then kind, of every row's whole text.

    Kinds are the base rules' (whole matches) and ``crf``: secrets that the model finds and that overlap no base span. A null
    text is empty, a text without tokens has none; rows that repeat a key or a whole row keep their own row; other columns are not read.
    """
    weights, steps = model
    packed, step = weights.astype(np.int32).tobytes(), steps.astype(np.int64)
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(np.frombuffer(packed, np.int32).reshape(-1, 3).astype(np.int64))
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            out = []
            for t, chain in zip(texts, scorer.chains(texts), strict=True):
                base = base_spans(t)
                spans = [(a, k, b) for a, k, b in base]
                if len(chain):
                    tags = decode(scorer.scores(chain, file_features(t)), step)
                    if tags.any():
                        spans += [(a, len(KINDS), b) for a, b in found_spans(t, tags) if not any(a < y and x < b for x, _, y in base)]
                out.append([{"kind": [*KINDS, "crf"][k], "start": a, "end": b} for a, k, b in sorted(spans)])
            span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
            yield pa.record_batch([batch.column(0), pa.array(out, pa.list_(span))], names=[key, "spans"])

    schema = f"`{key}` {kind}, spans array<struct<kind:string,start:bigint,end:bigint>>"
    return in_batches(docs.select(F.col(f"`{key}`"), F.col(f"`{text}`")), run, schema)


def span_digests(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per row: how many spans of each base kind, the digest of the base spans, and all spans."""
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    base = F.filter("spans", lambda s: s["kind"] != "crf")
    return found.select(F.col(f"`{key}`"), *[count(k).alias(f"n_{k}") for k in KINDS], F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
