"""Language identification with interpolated Kneser-Ney character models.

Each language has one model, learned from a bounded sample of labelled texts: n-grams of up to
five characters inside words, kept as sorted arrays of 64-bit hashes with the interpolated log
probability of each n-gram and the log weight of each context.  A text goes to the language of
the lowest cross-entropy by character.  Part of the sample is held back to calibrate the score
and the bound above which a text is rejected.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import table

ORDER = 5
#: The sample: so many texts a language at most, none longer than so many characters.
SAMPLE_TEXTS, SAMPLE_CHARS = 400, 20_000
#: Texts that a language without a short one is learned from.
LONG_TEXTS = 20
#: Words whose scores a worker remembers; the memory is emptied when full.
REMEMBER = 200_000
UNKNOWN = "und"
LETTERS = re.compile(r"[^\W\d_]+")
BOS, EOS = 2, 3
PRIME = np.uint64(0x9E3779B97F4A7C15)
#: False rejections that calibration allows, and the least deviation that it may reject.
FALSE_REJECTIONS, LEAST_Z = 0.002, 6.0


def letter_runs(token: str) -> list[str]:
    return [r for r in LETTERS.findall(token) if any(map(str.isalpha, r))]


def _windows(runs: list[str]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Hashes by order at each character of the runs (BOS and EOS added), offset in the run, run number."""
    size = np.fromiter(map(len, runs), np.int64, len(runs)) + 2
    ends = np.cumsum(size)
    codes = np.frombuffer("".join(f"\x02{r}\x03" for r in runs).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    run = np.repeat(np.arange(len(runs)), size)
    offset = np.arange(len(codes)) - np.repeat(ends - size, size)
    own = (codes + np.uint64(7)) * PRIME
    own ^= own >> np.uint64(29)
    h = [np.zeros(len(codes), np.uint64), own]
    for _ in range(2, ORDER + 1):
        h.append(np.r_[np.uint64(0), h[-1][:-1]] * np.uint64(0xD1342543DE82EF95) + own)
    for n in range(1, ORDER + 1):
        x = h[n] * PRIME
        h[n] = x ^ (x >> np.uint64(31))
    return h, offset, run


@dataclass
class Grams:
    """Sorted hashes of one order with their log probabilities, and of its contexts with their weights."""

    keys: np.ndarray
    logp: np.ndarray
    contexts: np.ndarray
    weight: np.ndarray


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


@dataclass
class Model:
    orders: list[Grams] = field(default_factory=list)
    unseen: float = 0.0

    @staticmethod
    def learn(words: Counter, alphabet: int) -> Model:
        runs = sorted(words)
        h, offset, run = _windows(runs)
        times = np.array([words[r] for r in runs], np.float64)[run]
        grams = {}
        for n in range(1, ORDER + 1):
            at = np.flatnonzero((offset >= n - 1) & (offset > 0))
            keys, first, inverse = np.unique(h[n][at], return_index=True, return_inverse=True)
            grams[n] = (keys, at[first], np.bincount(inverse, times[at], len(keys)))
        model, below = Model(), None
        for n in range(1, ORDER + 1):
            keys, at, raw = grams[n]
            count = raw
            if n < ORDER:  # how many characters stand before it; raw where none can
                longer = grams[n + 1][1]
                suffix, found = _find(keys, h[n][longer])
                count = np.where(offset[at] == n - 1, raw, np.bincount(suffix[found], minlength=len(keys)))
                count = np.maximum(count, 1)
            once, twice = (count == 1).sum(), (count == 2).sum()
            d = once / (once + 2 * twice) if once else 0.5
            d = min(max(float(d), 0.1), 0.9)
            context = h[n - 1][at - 1] if n > 1 else np.zeros(len(at), np.uint64)
            contexts, inverse = np.unique(context, return_inverse=True)
            total, kinds = np.bincount(inverse, count), np.bincount(inverse)
            weight = d * kinds / total
            if below is None:
                lower = np.full(len(keys), 1 / alphabet)
            else:
                lower = below[_find(grams[n - 1][0], h[n - 1][at])[0]]
            p = (count - d) / total[inverse] + weight[inverse] * lower
            model.orders.append(Grams(keys, np.log(p).astype(np.float32), contexts, np.log(weight).astype(np.float32)))
            below = p
        model.unseen = float(model.orders[0].weight[0] - np.log(alphabet))
        return model

    def score(self, h: list[np.ndarray], offset: np.ndarray) -> np.ndarray:
        """The log probability of each character; 0 for the starts of runs."""
        out = np.zeros(len(offset), np.float32)
        left = np.flatnonzero(offset > 0)
        for n in range(ORDER, 0, -1):
            here = left[offset[left] >= n - 1]
            if not len(here):
                continue
            g = self.orders[n - 1]
            at, found = _find(g.keys, h[n][here])
            out[here[found]] += g.logp[at[found]]
            missed = here[~found]
            if n > 1:
                at, found_context = _find(g.contexts, h[n - 1][missed - 1])
                out[missed[found_context]] += g.weight[at[found_context]]
            else:
                out[missed] += np.float32(self.unseen)
            done = np.zeros(len(offset), bool)
            done[here[found]] = True
            left = left[~done[left]]
        return out


class Scorer:
    """Sums of log probabilities by language, word by word, with a memory."""

    def __init__(self, models: list[Model], remember: int = REMEMBER):
        self.models, self.remember = models, remember
        self.known: dict[str, int] = {}
        self.rows = np.zeros((0, len(models) + 1))

    def learn(self, tokens: list[str]) -> None:
        if len(self.known) + len(tokens) > self.remember:
            self.known, self.rows = {}, self.rows[:0]
        runs, owner = [], []
        for i, t in enumerate(tokens):
            for r in letter_runs(t):
                runs.append(r)
                owner.append(i)
        new = np.zeros((len(tokens), len(self.models) + 1))
        if runs:
            h, offset, run = _windows(runs)
            token = np.array(owner)[run]
            for j, m in enumerate(self.models):
                new[:, j] = np.bincount(token, m.score(h, offset), len(tokens))
            new[:, -1] = np.bincount(token, offset > 0, len(tokens))
        self.known.update(zip(tokens, range(len(self.rows), len(self.rows) + len(tokens))))
        self.rows = np.concatenate([self.rows, new])

    def texts(self, texts: list[str | None]) -> np.ndarray:
        """For each text the sums by language and, last, how many characters were scored."""
        out = np.zeros((len(texts), len(self.models) + 1))
        for lo in range(0, len(texts), 64):
            part = [(t or "").lower().split() for t in texts[lo : lo + 64]]
            fresh = set().union(*part).difference(self.known)
            if len(self.known) + len(fresh) > self.remember:
                self.known, self.rows = {}, self.rows[:0]
                fresh = set().union(*part)
            if fresh:
                self.learn(sorted(fresh))
            known = self.known.__getitem__
            for i, tokens in enumerate(part):
                if tokens:
                    out[lo + i] = self.rows[np.fromiter(map(known, tokens), np.int64, len(tokens))].sum(0)
        return out


@dataclass
class Identifier:
    languages: list[str]
    models: list[Model]
    sharpness: float = 1.0
    mean: np.ndarray | None = None
    spread: tuple[float, float] = (1.0, 0.0)
    z: float = LEAST_Z

    @staticmethod
    def learn(rows: list[tuple[str, str, int]]) -> Identifier:
        """From (language, text, hash); every fifth text by hash calibrates."""
        by: dict[str, list[tuple[int, str]]] = {}
        for lang, text, h in rows:
            if any(map(str.isalpha, text)):
                by.setdefault(lang, []).append((h, text))
        languages, counts, rest = sorted(by), [], []
        for lang in languages:
            texts = [t for _, t in sorted(by[lang])]
            hold = texts[::5] if len(texts) >= 10 else texts
            rest += [(lang, t) for t in hold]
            words: Counter = Counter()
            for t in texts if len(texts) < 10 else [t for i, t in enumerate(texts) if i % 5]:
                words.update(t.lower().split())
            runs: Counter = Counter()
            for token, n in words.items():
                for r in letter_runs(token):
                    runs[r] += n
            counts.append(runs)
        alphabet = len(set("".join("".join(c) for c in counts))) + 2
        found = Identifier(languages, [Model.learn(c, alphabet) for c in counts])
        if languages:
            found._calibrate(rest)
        return found

    def _calibrate(self, rest: list[tuple[str, str]]) -> None:
        sums = Scorer(self.models).texts([t for _, t in rest])
        n = np.maximum(sums[:, -1], 1)
        entropy = -sums[:, :-1] / n[:, None]
        truth = np.array([self.languages.index(lang) for lang, _ in rest])
        loss = {}
        for s in (0.5, 1, 2, 4, 8, 16, 32, 64):
            x = -entropy * s
            x -= x.max(1, keepdims=True)
            loss[s] = float((np.log(np.exp(x).sum(1)) - x[np.arange(len(truth)), truth]).mean())
        self.sharpness = min(loss, key=loss.get)
        best = entropy.argmin(1)
        low = entropy[np.arange(len(best)), best]
        self.mean = np.array([np.median(low[best == j]) if (best == j).any() else np.median(low) for j in range(len(self.languages))])
        off = low - self.mean[best]
        long = n >= np.median(n)
        base = float((off[long] ** 2).mean())
        self.spread = (base + 1e-4, float(np.maximum((off**2 - base) * n, 0).mean()))
        z = off / np.sqrt(self.spread[0] + self.spread[1] / n)
        self.z = max(LEAST_Z, float(np.quantile(z, 1 - FALSE_REJECTIONS)) * 1.5)

    def predict(self, sums: np.ndarray) -> tuple[list[str | None], np.ndarray, np.ndarray, np.ndarray]:
        """Language, score, cross-entropy and whether it is rejected; None where nothing was scored."""
        n = np.maximum(sums[:, -1], 1)
        entropy = -sums[:, :-1] / n[:, None]
        best = entropy.argmin(1)
        low = entropy[np.arange(len(best)), best]
        x = np.exp((low[:, None] - entropy) * self.sharpness)
        z = (low - self.mean[best]) / np.sqrt(self.spread[0] + self.spread[1] / n)
        none = sums[:, -1] == 0
        return [None if no else self.languages[j] for j, no in zip(best, none)], np.where(none, 0.0, 1 / x.sum(1)), np.where(none, np.nan, low), none | (z > self.z)


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text)) if text else False


def learn(docs: DataFrame, id_col: str, text_col: str, lang_col: str, texts: int = SAMPLE_TEXTS, chars: int = SAMPLE_CHARS) -> Identifier:
    """Models from up to `texts` texts a language of at most `chars` characters, by hash of id and text.

    A language that has longer texts alone is learned from LONG_TEXTS of these.  The sample does not
    depend on order or partitions, and is cut down before it is collected.  Rows with null text or
    language give nothing.
    """
    known = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    h = F.pmod(F.xxhash64(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.col(text_col), F.lit(9)), F.lit(1_000_000))
    known = known.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"), h.alias("h"), (F.length(text_col) <= chars).alias("short"))
    sizes = {(r["lang"], r["short"]): (r["n"], r["least"]) for r in known.groupBy("lang", "short").agg(F.count("*").alias("n"), F.min("h").alias("least")).collect()}
    wanted = {k: (texts if k[1] else LONG_TEXTS, *x) for k, x in sizes.items() if k[1] or (k[0], True) not in sizes}
    if not wanted:
        return Identifier([], [])
    share = F.create_map(*[F.lit(x) for (lang, short), (most, n, least) in wanted.items() for x in (f"{int(short)} {lang}", max(least, min(1_000_000, int(1_200_000 * most / n))) + 1)])
    drawn = known.where(F.col("h") < share[F.concat(F.col("short").cast("int").cast("string"), F.lit(" "), F.col("lang"))])
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h", "text"))
    rows = drawn.withColumn("place", place).where(F.col("place") <= F.when(F.col("short"), texts).otherwise(LONG_TEXTS)).collect()
    return Identifier.learn(sorted((r["lang"], r["text"], r["h"]) for r in rows))


PREDICTED = "lang_pred string, score double, entropy double, rejected boolean"


def identify(docs: DataFrame, model: Identifier, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, entropy, rejected) for each row of docs.

    Null texts and texts without a letter are `und` with score 0, rejected, as is every text if
    no language was learned.  Texts are read whole; equal texts get equal results; ids may repeat
    or be null.  Equal cross-entropies go to the language first in order.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model.models)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            if model.languages:
                lang, score, entropy, rejected = model.predict(scorer.texts(texts))
                lang = [(x or model.languages[0]) if has_letter(t) else UNKNOWN for x, t in zip(lang, texts)]
            else:
                lang, score, entropy, rejected = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.full(len(texts), np.nan), np.ones(len(texts), bool)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lang, pa.string()), pa.array(score), pa.array(entropy), pa.array(rejected)], names=["doc_id", "lang_pred", "score", "entropy", "rejected"])

    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return own.mapInArrow(run, f"doc_id long, {PREDICTED}")


def accepted(docs: DataFrame, model: Identifier, text_col: str = "text") -> DataFrame:
    """The rows of docs, all columns, whose text is not rejected.

    Null texts and texts without a letter are rejected; equal texts, repeated rows among them, are
    treated alike; if no language was learned, nothing is accepted.
    """
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model.models)
        for batch in batches:
            texts = batch.column(at).to_pylist()
            if model.languages:
                rejected = model.predict(scorer.texts(texts))[3]
                keep = np.array([has_letter(t) for t in texts], bool) & ~rejected
                yield batch.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def op9_langid(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = learn(docs.where(~held_out(F.col("doc_id"))), "doc_id", "text", "lang")
    found = identify(docs, model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", F.col("entropy").alias("cross_entropy"), "rejected")
