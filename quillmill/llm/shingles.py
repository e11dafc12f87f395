"""Near-duplicates by the Jaccard similarity of five-word shingles, all of them.

Shingles are put in one order for all texts, common ones last.  Two texts of a similarity of LIKE
or more share one of the first n - ceil(LIKE * n) + 1 of their n shingles, whatever the order, so
that these are the keys.  Keys are shuffled once; those of one text alone go at once, and so do
those whose texts are known to belong together by other means (SimHash links).  What still shares
a key is verified on all shingles of the texts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .buckets import CHUNK, verified_links
from .common import bounded, materialise

WORDS = 5
#: The least similarity, as a fraction.
LIKE = (4, 5)
#: Common shingles are sought among so many texts, for the order only; so many are told apart.
ORDER_TEXTS, ORDER_LEAST, ORDER_MOST = 4_000, 6, 50_000
#: The fewest cells of a sketch, and the count that stands for itself and all above.
CELLS, FULL = 256, 15
#: The rows of a common shingle are spread over so many tasks.
SALT = 256
#: Bytes of text that count as one row more in a group.
HEAVY = 4096


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of all runs of so many words, in lower case; of all words if fewer."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.zeros(0, np.int64)
    digest, flat = xxhash.xxh64_digest, b" ".join(found)
    if len(found) <= words:
        raw = digest(flat, 42)
    else:
        size = np.fromiter(map(len, found), np.int64, len(found))
        ends = np.cumsum(size + 1) - 1
        raw = b"".join([digest(flat[a:b], 42) for a, b in zip((ends - size).tolist(), ends[words - 1 :].tolist())])
    return np.unique(np.frombuffer(raw, np.int64))


def alike(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both > 0 and both * LIKE[1] >= LIKE[0] * (len(a) + len(b) - both)


def prefix(own: np.ndarray, common: np.ndarray) -> np.ndarray:
    """The shingles that are keys; common is sorted."""
    n = len(own)
    take = n - -(-LIKE[0] * n // LIKE[1]) + 1 if n else 0
    if len(common):
        late = common[np.minimum(np.searchsorted(common, own), len(common) - 1)] == own
        own = np.concatenate([own[~late], own[late]])
    return own[:take]


def forest(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Links that join what is alike, one fewer than nodes for each component."""
    sets = [shingles(t) for t in texts]
    size = np.array([len(x) for x in sets])
    rest = np.arange(len(sets))
    while len(rest):
        queue, rest = [int(rest[0])], rest[1:]
        while queue and len(rest):
            q = queue.pop()
            flat = np.concatenate([sets[i] for i in rest])
            at = np.minimum(np.searchsorted(sets[q], flat), size[q] - 1)
            both = np.bincount(np.repeat(np.arange(len(rest)), size[rest]), sets[q][at] == flat, len(rest)).astype(np.int64)
            near = both * LIKE[1] >= LIKE[0] * (size[q] + size[rest] - both)
            hit = rest[near].tolist()
            yield from ((q, x) for x in hit)
            queue += hit
            rest = rest[~near]


def sketch(own: np.ndarray) -> bytes:
    """How many shingles fall to each cell, by hash, in four bits up to 15; then how many there are.

    The number of cells is a power of two that grows with the text, one or two shingles to a cell,
    so that long texts are told apart as well as short ones.
    """
    cells = max(CELLS, 1 << max(len(own).bit_length() - 1, 0))
    counts = np.minimum(np.bincount(own & (cells - 1), minlength=cells), FULL).astype(np.uint8)
    return (counts[::2] | counts[1::2] << 4).tobytes() + len(own).to_bytes(4, "little")


def rough(sketches: list[bytes]) -> Callable[[int, np.ndarray], np.ndarray]:
    """Which of some others may be alike to one: no two sets share more than the lesser counts of all cells.

    Of two sketches the one with more cells is folded to the cells of the other.
    """
    size = np.array([int.from_bytes(s[-4:], "little") for s in sketches], np.int64)
    width = np.array([2 * (len(s) - 4) for s in sketches], np.int64)
    place, full, cells = np.zeros(len(sketches), np.int64), np.zeros(len(sketches), bool), {}
    for w in np.unique(width).tolist():
        at = np.flatnonzero(width == w)
        packed = np.frombuffer(b"".join([sketches[i][:-4] for i in at.tolist()]), np.uint8).reshape(len(at), -1)
        cells[w] = np.stack([packed & 15, packed >> 4], 2).reshape(len(at), w)
        place[at], full[at] = np.arange(len(at)), (cells[w] == FULL).any(1)

    def near(q: int, others: np.ndarray) -> np.ndarray:
        least = np.minimum(size[others], size[q])
        vague = full[others] | full[q]
        both = np.where(vague, least, 0)
        can = np.flatnonzero(~vague & (least * LIKE[1] >= LIKE[0] * np.maximum(size[others], size[q])))
        wide = width[others[can]]
        for w in np.unique(wide).tolist():
            at, m = can[wide == w], min(w, int(width[q]))
            one = cells[int(width[q])][place[q]].reshape(-1, m).sum(0, dtype=np.uint16)
            rest = cells[w][place[others[at]]].reshape(len(at), -1, m).sum(1, dtype=np.uint16)
            both[at] = np.minimum(one, rest).sum(1, dtype=np.int64)
        return both * LIKE[1] >= LIKE[0] * (size[q] + size[others] - both)

    return near


def _sketch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([sketch(shingles(t.as_py())) for t in batch.column(1)], pa.binary())], names=["node", "sketch"])


KEYED = "key long, salt int, node long, weight int"


def _key_batches(common: np.ndarray, whole: bool = False):
    """The keys of each text; those that are common have a salt above 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = batch.column(0).to_numpy(zero_copy_only=False)
            for lo in range(0, batch.num_rows, 256):
                texts = batch.column(1).slice(lo, 256).to_pylist()
                found = [shingles(t) if whole else prefix(shingles(t), common) for t in texts]
                size = [len(x) for x in found]
                keys = np.concatenate(found)
                node = np.repeat(nodes[lo : lo + 256], size)
                weight = np.repeat([1 + len(t) // HEAVY for t in texts], size)
                salt = np.zeros(len(keys), np.int64)
                if len(common) and len(keys):
                    late = common[np.minimum(np.searchsorted(common, keys), len(common) - 1)] == keys
                    salt = np.where(late, 1 + node % SALT, 0)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(salt, pa.int32()), pa.array(node), pa.array(weight, pa.int32())], names=["key", "salt", "node", "weight"])

    return run


def text_node(text: Column) -> Column:
    """Equal texts are one node; null is the empty text."""
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def shingle_links(docs: DataFrame, text_col: str = "text", known: DataFrame | None = None, chunk: int = CHUNK) -> DataFrame:
    """Links (u, v) of text_node() that join all texts of a similarity of LIKE or more.

    known has (node, root) of nodes that belong together already: with those as links, too, all
    such texts are joined.  Null texts are empty; texts without a word have no shingle and no
    link; equal texts are one node; other columns are not looked at.
    """
    own = docs.select(text_node(F.col(text_col)).alias("node"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    step = max(docs.count() // ORDER_TEXTS, 1)
    sample = own.where(F.pmod(F.col("node"), F.lit(step)) == 0).mapInArrow(_key_batches(np.zeros(0, np.int64), True), KEYED)
    seen = sample.groupBy("key").count().where(F.col("count") >= ORDER_LEAST)
    common = np.sort(np.array([r.key for r in seen.orderBy(F.desc("count"), "key").limit(ORDER_MOST).collect()], np.int64))
    run = Window.partitionBy("key", "salt")
    rows = own.mapInArrow(_key_batches(common), KEYED).withColumn("before", F.lag("node").over(run.orderBy("node"))).withColumn("last", F.max("node").over(run))
    # the first row of each node, where the key has another; common ones are left to the groups
    shared = rows.where("(before is null or before <> node) and (before is not null or last <> node or salt > 0)").select("key", "node", "weight")
    if known is not None:
        at = known.select(F.col("node").alias("its_node"), "root")
        shared = shared.join(at, F.col("node") == F.col("its_node"), "left").select("key", "node", "weight", F.coalesce("root", "node").alias("root"))
    else:
        shared = shared.withColumn("root", F.col("node"))
    keyed = materialise(shared)
    contents = lambda nodes: own.join(bounded(nodes, 200_000), "node", "left_semi").dropDuplicates(["node"]).select("node", F.col("text").alias("content"))
    sketches = own.mapInArrow(_sketch_batches, "node long, sketch binary").groupBy("node").agg(F.min("sketch").alias("sketch"))
    return verified_links(keyed, contents, forest, chunk, sketches, rough)
