"""Verified links among what shares a key, however much shares it."""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded, materialise
from .components import connected_components

#: Weight of a group above which it is cut into parts that are compared pair by pair.
CHUNK = 1024


Forest = Callable[[list], Iterator[tuple[int, int]]]


def _rows(batches: Iterator[pa.RecordBatch], plain: int) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(i).to_pylist() for i in range(plain)), batch.column(plain))


def _block_batches(forest: Forest):
    """Links inside each block, over rows (key, block, node, content) sorted by key and block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        u, v = [], []
        for _, group in itertools.groupby(_rows(batches, 3), key=lambda r: r[:2]):
            own = list(group)
            for i, j in forest([r[3].as_py() for r in own]):
                u.append(own[i][2])
                v.append(own[j][2])
            if len(u) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])
                u, v = [], []
        if u:
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    return run


Rough = Callable[[list], Callable[[int, np.ndarray], np.ndarray]]
ROUGH = pa.schema([("key", pa.int64()), ("block", pa.int64()), ("node", pa.int64()), ("parent", pa.int64())])
#: Blocks up to SMALL nodes with up to SPARSE pairs a node that sketches allow are left as pairs.
SMALL, SPARSE = 512, 32
FIRST, LATER = 0, 1


def _allowed(n: int, near: Callable[[int, np.ndarray], np.ndarray], roots: np.ndarray) -> list[tuple[int, int]] | None:
    """All pairs of different roots that sketches allow; None if there are more than SPARSE * n."""
    pairs: list[tuple[int, int]] = []
    for i in range(n - 1):
        others = i + 1 + np.flatnonzero(roots[i + 1 :] != roots[i])
        if len(others):
            pairs += [(i, j) for j in others[near(i, others)].tolist()]
            if len(pairs) > SPARSE * n:
                return None
    return pairs


def _trees(n: int, near: Callable[[int, np.ndarray], np.ndarray]) -> tuple[list[int], list[int]]:
    """For each place the first of its tree and the place that it hangs on, -1 for the first."""
    top, parent, rest = list(range(n)), [-1] * n, np.arange(n)
    while len(rest):
        queue, rest = [int(rest[0])], rest[1:]
        while queue and len(rest):
            q = queue.pop()
            hit = near(q, rest)
            for j in rest[hit].tolist():
                top[j], parent[j] = top[q], q
                queue.append(j)
            rest = rest[~hit]
    return top, parent


def _spanning(pairs: list[tuple[int, int]], roots: np.ndarray) -> Iterator[bool]:
    """For each pair whether it joins what the roots and the pairs before it leave apart."""
    top: dict[int, int] = {}

    def find(x: int) -> int:
        while top.get(x, x) != x:
            top[x] = top.get(top[x], top[x])
            x = top[x]
        return x

    for i, j in pairs:
        a, b = find(int(roots[i])), find(int(roots[j]))
        yield a != b
        top[b] = a


def _rough_batches(rough: Rough):
    """Over rows (key, block, node, root, sketch): (key, block, node, parent) of what sketches allow.

    Of a block with few allowed pairs, these, without key; block is FIRST for those that span its
    nodes and LATER for the others.  Of another the trees that allowed pairs
    make, each a block named by its least node; parent is the node that a node hangs on, if that
    has another root.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for (key, _), group in itertools.groupby(_rows(batches, 4), key=lambda r: r[:2]):
            own = list(group)
            near, n, roots = rough([r[4].as_py() for r in own]), len(own), np.array([r[3] for r in own])
            pairs = _allowed(n, near, roots) if n <= SMALL else None
            if pairs is not None:
                out += [(None, FIRST if new else LATER, own[j][2], own[i][2]) for (i, j), new in zip(pairs, _spanning(pairs, roots))]
            else:
                top, parent = _trees(n, near)
                trees: dict[int, list[int]] = {}
                for i, t in enumerate(top):
                    trees.setdefault(t, []).append(i)
                for same in trees.values():
                    if len(set(roots[same].tolist())) > 1:
                        block = min(own[i][2] for i in same)
                        out += [(key, block, own[i][2], own[parent[i]][2] if parent[i] >= 0 and roots[parent[i]] != roots[i] else None) for i in same]
            if len(out) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], schema=ROUGH)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], schema=ROUGH)

    return run


def _star_batches(forest: Forest):
    """The links of each hub, over rows (hub, part, node, content) sorted by hub and part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (hub, _), group in itertools.groupby(_rows(batches, 3), key=lambda r: r[:2]):
            own = [(r[2], r[3].as_py()) for r in group]
            centre = next(c for node, c in own if node == hub)
            v = [node for node, c in own if node != hub and any(True for _ in forest([centre, c]))]
            if v:
                yield pa.RecordBatch.from_arrays([pa.array([hub] * len(v), pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    return run


def _star_links(edges: DataFrame, contents: Callable[[DataFrame], DataFrame], forest: Forest, chunk: int) -> DataFrame:
    """Those of the distinct edges (u, v) whose ends are alike; a hub's edges are dealt into parts of some chunk."""
    parts = edges.groupBy("u").agg(F.ceil(F.count("*") / chunk).cast("int").alias("parts"))
    dealt = edges.join(parts, "u").withColumn("part", F.pmod(F.xxhash64("v"), F.col("parts")).cast("int"))
    rows = dealt.select("u", "part", F.col("v").alias("node")).unionByName(dealt.select("u", "part", F.col("u").alias("node")).distinct())
    rows = rows.join(contents(rows.select("node").distinct()), "node").select("u", "part", "node", "content")
    return rows.repartition("u", "part").sortWithinPartitions("u", "part").mapInArrow(_star_batches(forest), "u long, v long")


def verified_links(keyed: DataFrame, contents: Callable[[DataFrame], DataFrame], forest: Forest, chunk: int = CHUNK, sketches: DataFrame | None = None, rough: Rough | None = None) -> DataFrame:
    """Links (u, v) that join what is alike among the nodes of each key.

    keyed has distinct (key long, node long) with a weight and a root: nodes of one root are known
    to belong together, so that a group of one root is not looked at.  contents gives
    (node, content), a row for each of the nodes it is handed; forest gives the places of links
    among a list of contents, each tree from its first node on.  Groups of the same nodes are
    looked at once.  The nodes of a group above chunk are dealt by hash into parts, and every two
    parts are compared in a block of their own; nothing is capped.  If there are sketches (node,
    sketch), rough, which must allow all pairs that forest joins, takes blocks apart by these.  Of
    blocks with few allowed pairs those that span the block are verified, each once, and of the
    others those whose ends these leave apart; of other blocks the edges of trees, and only those with an edge that fails are compared in full, so that contents are fetched for few
    rows.
    """
    h = F.xxhash64("node")
    groups = keyed.groupBy("key").agg(F.count("*").alias("n"), F.sum("weight").alias("w"), F.bit_xor(h).alias("x"), F.sum(F.shiftrightunsigned(h, 34)).alias("s"), F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi")
    once = materialise(groups.groupBy("n", "w", "x", "s").agg(F.min("key").alias("its_key")).select("its_key", F.ceil(F.col("w") / chunk).cast("int").alias("parts")))
    members = keyed.join(bounded(once), F.col("key") == F.col("its_key")).select("key", "node", "root", "parts", F.pmod(h, F.col("parts")).cast("int").alias("part"))
    others = F.filter(F.sequence(F.lit(0), F.col("parts") - 1), lambda t: (t != F.col("part")) | (F.col("parts") == 1))
    members = members.select("key", "node", "root", "part", "parts", F.explode(others).alias("other"))
    block = F.least("part", "other").cast("long") * F.col("parts") + F.greatest("part", "other")
    members = members.select("key", block.alias("block"), "node", "root")
    dealt = lambda m: m.repartition("key", "block").sortWithinPartitions("key", "block", "node")
    if sketches is None:
        return _block_links(materialise(members.select("key", "block", "node")), contents, forest)
    sketched = members.join(sketches, "node").select("key", "block", "node", "root", "sketch")
    trees = materialise(dealt(sketched).mapInArrow(_rough_batches(rough), "key long, block long, node long, parent long"))
    edge = [F.col("parent").alias("u"), F.col("node").alias("v")]
    first = materialise(_star_links(trees.where(f"parent is not null and (key is not null or block = {FIRST})").select(*edge).distinct(), contents, forest, chunk))
    known = keyed.where("node <> root").select(F.col("node").alias("u"), F.col("root").alias("v")).distinct()
    top = materialise(connected_components(first.unionByName(known)))
    later = trees.where(f"key is null and block = {LATER}").select(*edge).distinct()
    for end in "uv":
        later = later.join(top.select(F.col("node").alias(end), F.col("root").alias(f"{end}_root")), end, "left")
    apart = materialise(later.where("coalesce(u_root, u) <> coalesce(v_root, v)").select("u", "v"))
    good = materialise(first.unionByName(_star_links(apart, contents, forest, chunk)))
    failed = trees.where("parent is not null and key is not null").join(good, (F.col("parent") == F.col("u")) & (F.col("node") == F.col("v")), "left_anti").select("key", "block").distinct()
    rest = materialise(trees.join(failed, ["key", "block"], "left_semi").select("key", "block", "node"))
    sets = rest.groupBy("key", "block").agg(F.count("*").alias("n"), F.bit_xor(h).alias("x"), F.sum(F.shiftrightunsigned(h, 34)).alias("s"))
    only = sets.groupBy("n", "x", "s").agg(F.min(F.struct("key", "block")).alias("k")).select("k.*")
    rest = materialise(rest.join(only, ["key", "block"]).select("key", "block", "node"))
    return good.unionByName(_block_links(rest, contents, forest))


def _block_links(members: DataFrame, contents: Callable[[DataFrame], DataFrame], forest: Forest) -> DataFrame:
    rows = members.join(contents(members.select("node").distinct()), "node").select("key", "block", "node", "content")
    return rows.repartition("key", "block").sortWithinPartitions("key", "block").mapInArrow(_block_batches(forest), "u long, v long").distinct()
