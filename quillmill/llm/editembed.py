"""Document fingerprints by randomised edit embedding.

After Chakraborty, Goldenberg and Koucky (2016): a walk over the text writes its current character
at each step and moves on to the next one if a shared random function of step and character says
so.  Texts at a small edit distance walk in step again soon after each edit, so that their outputs
differ at few steps.  A walk may miss the other's step by chance for long, so that WALKS
independent ones are taken and the one that agrees best counts.  The output is not kept.  Of each
walk's SAMPLES steps are read, each the step of least random rank below the output's length, so
that outputs of nearly equal length are read at the same steps; a fingerprint has four bits of a
hash of each character read.

Near texts are found by bands of sampled bits, and verified by the fingerprints' likeness
(near_texts()).  Each walk has one band more than samples may differ, so that one agrees in full.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .buckets import CHUNK, verified_links
from .common import materialise, table
from .components import connected_components

CLASSES, PERIOD, WALKS, SAMPLES, SEED = 64, 4096, 2, 64, 2016
#: Texts are near if so much of their samples agrees.
NEAR = 0.9
#: Texts above so many characters are walked in pieces of that size.
PIECE = 1 << 16


@lru_cache(WALKS)
def walk_table(no: int) -> list[list[int]]:
    """For each class of characters and step, modulo PERIOD, how many steps walk no stays."""
    bits = np.random.default_rng([SEED, no]).integers(0, 2, (CLASSES, PERIOD))
    bits[:, -1] = 1
    stay = np.empty((CLASSES, PERIOD), np.int64)
    to = np.full(CLASSES, 0)
    for t in range(PERIOD - 1, -1, -1):
        to = np.where(bits[:, t] == 1, 1, to + 1)
        stay[:, t] = to
    return stay.tolist()


@lru_cache(1)
def ranks() -> tuple[np.ndarray, list[int]]:
    """For each sample the steps that have a lesser rank than all steps before, and all of them."""
    rng, rows = np.random.default_rng(SEED + 1), []
    for _ in range(WALKS * SAMPLES):
        at, least, row = 0, rng.random(), [0]
        while at < 1 << 48:
            at += int(rng.geometric(max(least, 1e-15)))
            least *= rng.random()
            row.append(at)
        rows.append(row)
    width = max(map(len, rows))
    return np.array([r + [1 << 60] * (width - len(r)) for r in rows], np.int64), sorted({x for r in rows for x in r})


def _classes(text: str) -> tuple[bytes, np.ndarray]:
    """The class of each character, and its four-bit symbol."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    mixed = points * np.uint32(2654435761)
    return ((mixed >> np.uint32(26)) & np.uint32(CLASSES - 1)).astype(np.uint8).tobytes(), ((mixed >> np.uint32(13)) & np.uint32(15)).astype(np.uint8)


def _times(classes: bytes, j: int, no: int) -> list[int]:
    """The step at which walk no leaves each character, if it comes to the first at step j."""
    stay, mask = walk_table(no), PERIOD - 1
    return [j := j + stay[c][j & mask] for c in classes]


class Walk:
    """One walk over a text, which can go on over other texts."""

    def __init__(self, classes: bytes, symbols: np.ndarray, no: int):
        self.no, self.n = no, len(classes)
        self.classes, self.symbols = classes, symbols
        if self.n <= PIECE:
            self.times = _times(self.classes, 0, no)
            self.length = self.times[-1] if self.times else 0
        else:
            self.times = None
            self.ends, self.length = [], 0
            for i in range(0, self.n, PIECE):
                self.ends.append(self.length)
                self.length = _times(self.classes[i : i + PIECE], self.length, no)[-1]

    def time(self, i: int) -> int:
        """The step at which the walk comes to character i."""
        if self.times is not None:
            return self.times[i - 1] if i else 0
        piece, rest = divmod(i, PIECE)
        if piece == len(self.ends):
            return self.length
        return _times(self.classes[piece * PIECE : piece * PIECE + rest], self.ends[piece], self.no)[-1] if rest else self.ends[piece]

    def read(self, steps: list[int]) -> list[int]:
        """The symbols written at some steps of this walk."""
        if self.times is not None:
            return self.symbols[[bisect_right(self.times, p) for p in steps]].tolist()
        out, pieces = {}, {}
        for p in sorted(steps):
            pieces.setdefault(bisect_right(self.ends, p) - 1, []).append(p)
        for k, own in pieces.items():
            times = _times(self.classes[k * PIECE : (k + 1) * PIECE], self.ends[k], self.no)
            for p in own:
                out[p] = int(self.symbols[k * PIECE + bisect_right(times, p)])
        return [out[p] for p in steps]


class Walks:
    """All walks over a text."""

    def __init__(self, text: str):
        self.text, self.n = text, len(text)
        self.each = [Walk(*_classes(text), no) for no in range(WALKS)]


def _steps(length: int, no: int) -> list[int]:
    rows = ranks()[0][no * SAMPLES : (no + 1) * SAMPLES]
    return rows[np.arange(SAMPLES), (rows < length).sum(1) - 1].tolist()


def fingerprint(text: str | Walks) -> list[int]:
    """SAMPLES numbers of four bits for each walk; all 0 for the empty text."""
    own = text if isinstance(text, Walks) else Walks(text)
    return [x for w in own.each for x in w.read(_steps(w.length, w.no))] if own.n else [0] * (WALKS * SAMPLES)


def edited_fingerprint(own: Walks, keep: int, more: str) -> list[int]:
    """fingerprint(own.text[:keep] + more), without walking over what is kept again."""
    if not more:
        return fingerprint(own) if keep == own.n else fingerprint(own.text[:keep])
    if len(more) > PIECE:
        return fingerprint(own.text[:keep] + more)
    classes, symbols = _classes(more)
    out = []
    for w in own.each:
        start = w.time(keep)
        times = _times(classes, start, w.no)
        steps = _steps(times[-1], w.no)
        first = iter(w.read([p for p in steps if p < start]))
        out += [next(first) if p < start else int(symbols[bisect_right(times, p)]) for p in steps]
    return out


def to_hex(f: list[int]) -> str:
    return "".join(["%x" % x for x in f])


def likeness(a: list[int] | str, b: list[int] | str) -> float:
    """The part of the samples that agree, of the walk of which most do."""
    return max(sum(x == y for x, y in zip(a[i : i + SAMPLES], b[i : i + SAMPLES])) for i in range(0, WALKS * SAMPLES, SAMPLES)) / SAMPLES


def _fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([to_hex(fingerprint(t.as_py())) for t in batch.column(1)], pa.string())], names=["doc_id", "fingerprint"])


def _forest(differ: int):
    """Links that join what differs in so many samples of a walk at most, one fewer than nodes for each component."""

    def run(prints: list[str]) -> Iterator[tuple[int, int]]:
        f = np.frombuffer("".join(prints).encode(), np.uint8).reshape(-1, WALKS, SAMPLES)
        rest = np.arange(len(f))
        while len(rest):
            queue, rest = [int(rest[0])], rest[1:]
            while queue and len(rest):
                q = queue.pop()
                near = ((f[rest] != f[q]).sum(2) <= differ).any(1)
                hit = rest[near].tolist()
                yield from ((q, x) for x in hit)
                queue += hit
                rest = rest[~near]

    return run


def near_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = NEAR, chunk: int = CHUNK) -> DataFrame:
    """(doc_id, fingerprint, component_id) for each row of docs.

    component_id is the least id that can be reached over pairs of a likeness of least or more.
    Every such pair is met: if d samples of a walk may differ, one of its d + 1 bands agrees.  Only
    distinct fingerprints are keyed.  Null texts are empty; a repeated row comes back as often; a
    group of null ids only has a null component_id.
    """
    differ = next(d for d in range(SAMPLES, -1, -1) if (SAMPLES - d) / SAMPLES >= least or d == 0)
    if differ >= SAMPLES:
        raise ValueError("least must be above 0")
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    prints = materialise(own.mapInArrow(_fingerprint_batches, "doc_id long, fingerprint string"))
    distinct = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least"))
    distinct = materialise(distinct.withColumn("node", F.monotonically_increasing_id()))
    edges = np.linspace(0, SAMPLES, differ + 2).round().astype(int).tolist()
    cuts = [(no * SAMPLES + a, b - a) for no in range(WALKS) for a, b in zip(edges, edges[1:])]
    bands = [F.xxhash64(F.lit(i), F.substring("fingerprint", a + 1, n)) for i, (a, n) in enumerate(cuts)]
    keyed = distinct.select(F.explode(F.array_distinct(F.array(*bands))).alias("key"), "node", F.lit(1).alias("weight"), F.col("node").alias("root"))
    contents = lambda nodes: distinct.join(nodes, "node", "left_semi").select("node", F.col("fingerprint").alias("content"))
    roots = connected_components(verified_links(keyed, contents, _forest(differ), chunk))
    rooted = materialise(distinct.join(roots, "node", "left").select("fingerprint", "least", F.coalesce("root", "node").alias("root")))
    named = rooted.join(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("fingerprint", "component_id")
    return prints.join(named, "fingerprint").select("doc_id", "fingerprint", "component_id")


RESULT = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
DONE = f"doc_id long, {RESULT}, part int, first boolean, text string"
KINDS = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int32(), pa.bool_(), pa.string()]
NAMES = [x.split()[0] for x in DONE.split(", ")]


def compare(text: str, w: Walks, f: list[int], following: str, following_f: list[int]) -> tuple:
    """What RESULT names, for a text and the one that follows it."""
    n = len(text)
    keep = n - n // 4
    more = following[: n // 4]
    edited = hashlib.sha256((text[:keep] + more).encode("utf-8", "surrogatepass")).hexdigest()
    g = edited_fingerprint(w, keep, more)
    return n, edited, to_hex(f), to_hex(g), likeness(f, g), likeness(f, following_f)


def _batch(rows: list[tuple], names: list[str], kinds: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def _neighbour_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, before, out = TaskContext.get().partitionId(), None, []
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = text.as_py() or ""
            w = Walks(text)
            f = fingerprint(w)
            if before:
                out.append((before[0], *compare(*before[1:], text, f), None, None, None))
            else:
                out.append((doc_id, *[None] * 6, part, True, text))
            before = doc_id, text, w, f
            if len(out) >= 500:
                yield _batch(out, NAMES, KINDS)
                out = []
    if before:
        out.append((before[0], *[None] * 6, part, False, before[1]))
        yield _batch(out, NAMES, KINDS)


def _pair_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for doc_id, text, following in zip(*(batch.column(i).to_pylist() for i in range(3))):
            w = Walks(text)
            out.append((doc_id, *compare(text, w, fingerprint(w), following, fingerprint(following))))
        if out:
            yield _batch(out, NAMES[:7], KINDS[:7])


def neighbour_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each row of docs, of its edited text, and their likeness.

    The edited text has the last quarter of a text replaced by as much of the start of the next
    document by id, after the last the first.  Texts are dealt by ranges of ids; only the first
    and last document of each range are brought together afterwards.  Null texts are empty; null
    ids come first; rows of one id are ordered by text; a single row follows itself; an empty
    table gives no rows.  Other columns are not looked at.
    """
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    n = max(int(own.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    ordered = own.repartitionByRange(n, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    found = materialise(ordered.mapInArrow(_neighbour_batches, DONE))
    ends = found.where("part is not null").select("doc_id", "part", "first", "text")
    number = ends.where("first").select("part").withColumn("no", F.row_number().over(Window.orderBy("part")) - 1).withColumn("all", F.count("*").over(Window.partitionBy()))
    number = materialise(number)
    last = ends.where("not first").join(number, "part").select("doc_id", F.col("text"), ((F.col("no") + 1) % F.col("all")).alias("no"))
    first = ends.where("first").join(number, "part").select("no", F.col("text").alias("following"))
    pairs = last.join(first, "no").select("doc_id", "text", "following")
    names = NAMES[:7]
    return found.where("part is null").select(*names).unionByName(pairs.mapInArrow(_pair_batches, f"doc_id long, {RESULT}"))


def op8_edit_embedding(spark, sf_dir: str) -> DataFrame:
    return neighbour_likeness(table(spark, sf_dir, "documents"))


def op8_near_texts(spark, sf_dir: str) -> DataFrame:
    return near_texts(table(spark, sf_dir, "documents"))
