"""A quality classifier learned from weak labels.

Heuristic labellers vote good or bad on a text, or abstain.  Expectation-maximisation over the
counts of vote patterns in all documents estimates how each labeller votes on good and on bad
texts, without any given label.  The posteriors of the patterns are the labels on which a linear
scorer over hashed words and word shapes is trained, from a bounded sample; it scores all texts.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table

ABSTAIN, BAD, GOOD = 0, 1, 2
SPACE = 1 << 18
#: So many bad votes of one labeller make a kind of texts bad.
CLEAR = 2 / 3
#: The sample that trains the scorer: so many texts at most, none longer than so many characters.
SAMPLE_TEXTS, SAMPLE_CHARS = 6_000, 20_000

_SYMBOLS = b"#*$%&|<>{}[]\\^~_=@"
_UPPER, _LOWER = bytes(range(65, 91)), bytes(range(97, 123))
_SHAPE = bytes(bytearray([65 if 65 <= c <= 90 else 97 if 97 <= c <= 122 or c >= 128 else 48 if 48 <= c <= 57 else c for c in range(256)]))


@dataclass
class Stats:
    """What the labellers look at."""

    words: int
    unique: float
    echoes: float
    symbols: float
    upper: float
    shouts: float
    dup_lines: float
    short: float
    marked: float
    lines: int


def stats(raw: bytes, found: list[bytes]) -> Stats:
    n = max(len(found), 1)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    upper, lower = (len(raw) - len(raw.translate(None, x)) for x in (_UPPER, _LOWER))
    return Stats(
        len(found),
        len(set(found)) / n,
        sum(map(bytes.__eq__, found, found[1:])) / n,
        (len(raw) - len(raw.translate(None, _SYMBOLS))) / n,
        upper / max(upper + lower, 1),
        raw.count(b"!") / n,
        1 - len(set(lines)) / max(len(lines), 1),
        sum(len(w) < 5 for w in found) / n,
        sum(w.translate(None, _SYMBOLS) != w for w in found) / n,
        len(lines),
    )


def _between(value: float, good: float, bad: float, enough: bool = True) -> int:
    """Good up to one bound, bad from the other on, else no vote."""
    return ABSTAIN if not enough else GOOD if value <= good else BAD if value >= bad else ABSTAIN


Labeller = Callable[[Stats], int]
LABELLERS: dict[str, Labeller] = {
    "length": lambda s: _between(-s.words, -40, -2),
    "symbols": lambda s: _between(s.symbols, 0.03, 0.3),
    "capitals": lambda s: _between(s.upper, 0.2, 0.6, s.words >= 5),
    "variety": lambda s: _between(-s.unique, -0.35, -0.2, s.words >= 20),
    "echoes": lambda s: _between(s.echoes, 0.03, 0.25, s.words >= 10),
    "shouts": lambda s: _between(s.shouts, 0.1, 0.5, s.words >= 5),
    "lines": lambda s: _between(s.dup_lines, 0.05, 0.4, s.lines >= 3),
    "marked_words": lambda s: _between(s.marked, 0.05, 0.3, s.words >= 3),
    "short_words": lambda s: _between(abs(s.short - 0.5), 0.35, 0.49, s.words >= 20),
}


def votes(text: str | None, labellers: dict[str, Labeller] = LABELLERS) -> str:
    """One figure for each labeller: 0 no vote, 1 bad, 2 good."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    s = stats(raw, raw.split())
    return "".join([str(f(s)) for f in labellers.values()])


@dataclass
class LabelModel:
    """weights of the kinds of texts, rates[labeller, kind, vote], and which kinds are good.

    Inside a kind labellers are independent.
    """

    weights: np.ndarray
    rates: np.ndarray
    good: np.ndarray

    def share(self) -> float:
        """How many of the texts are good."""
        return float(self.weights[self.good].sum())

    def posterior(self, pattern: str) -> float:
        """The probability that a text of this vote pattern is good."""
        v = [int(c) for c in pattern]
        z = np.log(self.weights) + np.log(self.rates[np.arange(len(v)), :, v]).sum(0)
        p = np.exp(z - z.max())
        return float(p[self.good].sum() / p.sum())

    def accuracy(self) -> np.ndarray:
        """For each labeller the probability that a vote is right, given that it votes."""
        right = np.where(self.good, self.rates[:, :, GOOD], self.rates[:, :, BAD]) @ self.weights
        return right / np.maximum(self.rates[:, :, 1:].sum(2) @ self.weights, 1e-12)


def expectation_maximisation(v: np.ndarray, n: np.ndarray, q: np.ndarray, rounds: int, smooth: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """(weights, rates, kinds of the rows, log likelihood) from vote rows v that occur n times, begun at kinds q.

    Nothing is held to a value; `smooth` is a count added to each weight and rate.
    """
    m, k = v.shape[1], q.shape[1]
    hot = np.stack([v == x for x in range(3)], 2).astype(float)
    own, before = np.arange(m), -np.inf
    for _ in range(rounds):
        mass = q * n[:, None]
        weights = (mass.sum(0) + smooth) / (n.sum() + smooth * k)
        rates = np.einsum("pk,pjv->jkv", mass, hot) + smooth
        rates /= rates.sum(2, keepdims=True)
        z = np.log(weights) + np.log(rates[own[None], :, v]).sum(1)
        top = z.max(1, keepdims=True)
        q = np.exp(z - top)
        found = float(n @ (top[:, 0] + np.log(q.sum(1))))
        q /= q.sum(1, keepdims=True)
        if abs(found - before) < 1e-9 * abs(found):
            break
        before = found
    return weights, rates, q, found


def fit_labels(counts: dict[str, int], rounds: int = 2000, smooth: float = 0.5) -> LabelModel:
    """The label model of best fit to vote patterns, by expectation-maximisation.

    Junk comes in kinds that few labellers see each, so that models of two to labellers + 1 kinds
    are fitted: two begun at the majority of votes; most begun at kind j + 1 for the texts that
    labeller j votes bad, and then without the least kind, again and again.  The lesser Bayesian
    information criterion decides.  Shares and rates are all estimated.  What votes cannot tell is
    said: a kind is bad if a labeller votes bad on half of its texts and on CLEAR or more of those that
    it votes on there, or if bad votes are more than good ones.
    """
    patterns = sorted(counts)
    v = np.array([[int(c) for c in p] for p in patterns], np.int64)
    n = np.array([counts[p] for p in patterns], np.float64)
    m = v.shape[1]
    bad = (v == BAD).astype(float)
    outcomes = sum(len(np.unique(v[:, j])) - 1 for j in range(m))
    fits = []

    def fit(q: np.ndarray) -> np.ndarray:
        weights, rates, q, found = expectation_maximisation(v, n, q / q.sum(1, keepdims=True), rounds, smooth)
        free = q.shape[1] * (1 + outcomes) - 1
        fits.append((free * np.log(n.sum()) - 2 * found, weights, rates))
        return q

    two = 1 / (1 + np.exp(bad.sum(1) - (v == GOOD).sum(1)))
    fit(np.stack([two, 1 - two], 1))
    q = np.concatenate([np.where(bad.any(1), 0.05, 0.98)[:, None], bad + 0.02 / m], 1)
    while q.shape[1] > 1:
        q = fit(q)
        q = np.delete(q, (q * n[:, None]).sum(0).argmin(), 1) + 1e-6
    _, weights, rates = min(fits, key=lambda x: x[0])
    ill, well = rates[:, :, BAD], rates[:, :, GOOD]
    clear = ((ill >= 0.5) & (ill >= CLEAR * (ill + well))).any(0)
    return LabelModel(weights, rates, ~clear & (ill.sum(0) <= well.sum(0)))


def hashed(text: str | None, space: int = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """(slot, value) of the words and word shapes of a whole text; the values have length 1."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words, shapes = Counter(raw.lower().split()), Counter(raw.translate(_SHAPE).split())
    crc = zlib.crc32
    slots = [crc(w, 1) for w in words] + [crc(w[:12] + w[-3:], 2) for w in shapes]
    if not slots:
        return np.zeros(0, np.int64), np.zeros(0)
    values = np.log1p(np.fromiter((*words.values(), *shapes.values()), np.float64, len(slots)))
    values[: len(words)] *= 0.3
    return np.array(slots, np.int64) & (space - 1), values / np.sqrt((values**2).sum())


def fit_scorer(rows: list[tuple[np.ndarray, np.ndarray, float]], space: int = SPACE, passes: int = 6, rate: float = 0.5, seed: int = 3) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic scorer, by adaptive steps over (slots, values, target)."""
    w, g2, bias = np.zeros(space), np.full(space, 1e-3), 0.0
    rng = np.random.default_rng(seed)
    for _ in range(passes):
        for i in rng.permutation(len(rows)):
            at, x, y = rows[i]
            p = 1 / (1 + np.exp(-np.clip(w[at] @ x + bias, -30, 30)))
            g = (p - y) * x
            np.add.at(g2, at, g * g)
            np.subtract.at(w, at, rate * g / np.sqrt(g2[at]))
            bias -= 0.02 * (p - y)
    return w.astype(np.float32), float(bias)


def _vote_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([votes(t.as_py()) for t in batch.column(1)], pa.string())], names=["doc_id", "votes"])


def _feature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(0).to_pylist()
        found = [hashed(t) for t in texts]
        cols = [pa.array([votes(t) for t in texts], pa.string()), pa.array([a for a, _ in found], pa.list_(pa.int64())), pa.array([x for _, x in found], pa.list_(pa.float64()))]
        yield pa.RecordBatch.from_arrays([*cols, batch.column(1)], names=["votes", "slots", "values", "h"])


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", texts: int = SAMPLE_TEXTS, chars: int = SAMPLE_CHARS) -> tuple[LabelModel | None, np.ndarray, float]:
    """The label model, from the votes on all texts, and the scorer, from a bounded sample.

    Half of the sample are texts that are more likely good, half more likely bad, each chosen by
    hash of id and text; patterns number 3 ** labellers at most, so their counts fit the driver.
    """
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    patterns = own.mapInArrow(_vote_batches, "doc_id long, votes string").groupBy("votes").agg(F.count("*").alias("n"))
    counts = {r["votes"]: r["n"] for r in patterns.collect()}
    if not counts:
        return None, np.zeros(SPACE, np.float32), 0.0
    model = fit_labels(counts)
    good = sum(n for p, n in counts.items() if model.posterior(p) >= 0.5)
    whole = sum(counts.values())
    # bad texts are fewer: draw enough texts to find texts // 2 of them, then trim the good ones
    share = min(1.0, 1.2 * texts / 2 / max(min(good, whole - good), 1))
    h = F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "text", F.lit(6)), F.lit(1_000_000))
    drawn = own.where((F.length("text") <= chars) & (h < int(share * 1_000_000) + 1)).select("text", h.alias("h"))
    thin = {True: min(1.0, 0.6 * texts / max(good * share, 1)), False: min(1.0, 0.6 * texts / max((whole - good) * share, 1))}
    keep = {p: int(thin[model.posterior(p) >= 0.5] * 1000) + 1 for p in counts}

    def thinned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            take = [zlib.crc32(b"%d" % i) % 1000 < keep.get(votes(t), 1000) for t, i in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            yield from _feature_batches(iter([batch.filter(pa.array(take))]))

    rows = drawn.mapInArrow(thinned, "votes string, slots array<long>, values array<double>, h long")
    rows = rows.orderBy("h", "votes", "slots").limit(3 * texts).collect()  # some 1.2 * texts, were hashes not all alike
    sides = [[r for r in rows if (model.posterior(r["votes"]) >= 0.5) is side][: texts // 2] for side in (True, False)]
    fit = [(np.array(r["slots"], np.int64), np.array(r["values"]), model.posterior(r["votes"])) for r in sides[0] + sides[1]]
    return (model, *fit_scorer(fit))


SCORED = "doc_id long, votes string, posterior double, score double, kept boolean"


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.5, **how) -> DataFrame:
    """(doc_id, votes, posterior, score, kept) for each row of docs.

    posterior is the label model's, score the linear scorer's; kept if their mean is `least` or
    more.  Null and empty texts have no word: they score the bias alone and are not kept.  Texts
    are read whole; ids may be null or repeat; an empty table gives no rows.
    """
    model, w, bias = learn(docs, id_col, text_col, **how)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, float] = {}
        for batch in batches:
            texts = batch.column(1).to_pylist()
            pattern = [votes(t) for t in texts]
            post = np.array([known[p] if p in known else known.setdefault(p, model.posterior(p)) for p in pattern])
            z = np.array([float(w[at] @ x) + bias if len(at) else bias for at, x in map(hashed, texts)])
            score = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            some = np.array([bool(t and t.strip()) for t in texts], bool)
            kept = some & ((post + score) / 2 >= least)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(pattern, pa.string()), pa.array(post, pa.float64()), pa.array(score, pa.float64()), pa.array(kept, pa.bool_())], names=["doc_id", "votes", "posterior", "score", "kept"])

    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return own.mapInArrow(run, SCORED)


def op6_weak_labels(spark, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"))
