"""Vectors: embedding, exact and approximate search, centroids and retrieval quality."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .blocks import BLOCK, blocks, united

Embedder = Callable[[list[str]], np.ndarray]


#: Trigrams whose hashes a worker keeps, and code points that it takes in one go.
HASHES, POINTS = 1_000_000, 4_000_000


def hash_embedder(dim: int = 64) -> Embedder:
    """A deterministic stand-in for a model: signed hashes of character trigrams, unit length.

    Each distinct trigram is hashed once, as long as no more than HASHES are known; texts are counted
    by number.
    """
    known: dict[int, int] = {}

    def place(code: int) -> int:
        """2 * bucket + 1 if the sign is plus, of a trigram of 21 bits a code point, each one more than it is."""
        t = "".join(chr(c - 1) for c in (code >> 42, code >> 21 & 0x1FFFFF, code & 0x1FFFFF) if c)
        h = int.from_bytes(hashlib.blake2b(t.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big")
        return 2 * (h % dim) + (h >> 63)

    def places(codes: np.ndarray) -> np.ndarray:
        if len(known) > HASHES:
            known.clear()
        out = []
        for code in codes.tolist():
            at = known.get(code)
            if at is None:
                at = known[code] = place(code)
            out.append(at)
        return np.array(out, np.int64)

    def codes(t: str) -> np.ndarray:
        c = np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64) + 1
        c = np.concatenate([c, np.zeros(max(0, 3 - len(c)), np.int64)])
        return c[:-2] << 42 | c[1:-1] << 21 | c[2:]

    def add(out: np.ndarray, rows: list[int], parts: list[np.ndarray]) -> None:
        distinct, inverse = np.unique(np.concatenate(parts), return_inverse=True)
        at = places(distinct)[inverse] + 2 * dim * np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        counts = np.bincount(at, minlength=2 * dim * len(parts)).reshape(len(parts), dim, 2)
        np.add.at(out, rows, (counts[:, :, 1] - counts[:, :, 0]).astype(np.float64))

    def embed(texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), dim))
        rows, parts, held = [], [], 0
        for i, t in enumerate(texts):
            for lo in range(0, max(len(t) - 2, 1), POINTS):
                rows.append(i)
                parts.append(codes(t[lo : lo + POINTS + 2]))
                held += len(parts[-1])
                if held >= POINTS:
                    add(out, rows, parts)
                    rows, parts, held = [], [], 0
        if parts:
            add(out, rows, parts)
        out = out.astype(np.float32)
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)

    return embed


def embed(rows: DataFrame, text_col: str, embedder: Embedder, out: str = "embedding", batch: int = 64) -> DataFrame:
    """rows with the vector of a text; the model is loaded once for each worker."""

    @F.pandas_udf("array<float>")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            texts = part.fillna("").tolist()
            vectors = [v for i in range(0, len(texts), batch) for v in embedder(texts[i : i + batch])]
            yield pd.Series(vectors, index=part.index, dtype=object)

    return rows.withColumn(out, run(F.col(text_col)))


def inner_product(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(v: Column) -> Column:
    return F.sqrt(inner_product(v, v))


#: Vectors in a pack, numbers in a pack unless one vector has more, and queries that are broadcast in one go: 64 packs, 32 MB.
PACK, NUMBERS, QUERIES = 1024, 65_536, 65_536


def _packs(rows: DataFrame, ids: str, vector: str, cells: Column) -> DataFrame:
    """(key, ids, m, n, cells): vectors of one length and one choice of cells, at most PACK in a row, as a matrix of doubles.

    Vectors that are null or hold a null are in no pack.
    """
    whole = F.col(vector).isNotNull() & ~F.exists(vector, lambda x: x.isNull())
    own = rows.where(whole & F.col(ids).isNotNull()).select(F.col(ids).alias("id"), F.transform(vector, lambda x: x.cast("double")).alias("v"), cells.cast("array<int>").alias("cells"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, chosen = b.column(1).value_lengths().to_pylist(), b.column(2).to_pylist()
            groups: dict[tuple, list[int]] = {}
            for i, kind in enumerate(zip(sizes, map(tuple, chosen))):
                groups.setdefault(kind, []).append(i)
            for (length, cells_), at in groups.items():
                size = min(PACK, max(1, NUMBERS // max(length, 1)))
                for lo in range(0, len(at), size):
                    part = b.take(pa.array(at[lo : lo + size]))
                    n, m = part.num_rows, part.column(1).flatten().to_numpy(zero_copy_only=False).tobytes()
                    key = hashlib.blake2b(m + repr(part.column(0).to_pylist()).encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()
                    yield pa.RecordBatch.from_arrays([pa.array([key]), pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), part.column(0)), pa.array([m], pa.binary()), pa.array([n], pa.int32()), pa.array([cells_], pa.list_(pa.int32()))], names=["key", "ids", "m", "n", "cells"])

    kind = T.StructType([T.StructField("key", T.StringType()), T.StructField("ids", T.ArrayType(own.schema["id"].dataType)), T.StructField("m", T.BinaryType()), T.StructField("n", T.IntegerType()), T.StructField("cells", T.ArrayType(T.IntegerType()))])
    return own.mapInArrow(run, kind)


class _Best:
    """The k best of each query so far; ties go to the lesser id."""

    def __init__(self, n: int, k: int):
        self.n, self.k, self.least = n, k, np.full(n, -np.inf)
        self.q, self.s, self.v = np.zeros(0, np.int64), np.zeros(0), None

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        """scores has a row for each query and a column for each id."""
        least = self.least
        if scores.shape[1] > self.k:
            least = np.maximum(least, np.partition(scores, -self.k, axis=1)[:, -self.k])
        q, i = np.nonzero(scores >= least[:, None])
        v = ids[i] if self.v is None else np.concatenate([self.v, ids[i]])
        q, s = np.concatenate([self.q, q]), np.concatenate([self.s, scores[q, i]])
        order = np.lexsort((np.unique(v, return_inverse=True)[1], -s, q))
        order = order[np.arange(len(q)) - np.searchsorted(q[order], q[order]) < self.k]
        self.q, self.s, self.v = q[order], s[order], v[order]
        counts = np.bincount(self.q, minlength=self.n)
        full = counts == self.k
        self.least[full] = self.s[np.cumsum(counts)[full] - 1]


def _best_pairs(vectors: DataFrame, queries: DataFrame, k: int, digits: int, block: int) -> DataFrame:
    """(query_id, vec_id, score, rank) of packed sides; a query is held against the vectors of cells that it names.

    A task multiplies matrices and hands on k rows a query, whatever its vectors are.
    """
    kinds = [T.StructField(n, d.schema["ids"].dataType.elementType) for n, d in (("query_id", queries), ("vec_id", vectors))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[str, _Best] = {}
        names: dict[str, pa.Array] = {}
        vec_type = None
        for b in batches:
            vec_type = b.column("v_ids").type.value_type
            for r in range(b.num_rows):
                of = lambda c, r=r: b.column(c)[r]
                nq, nv, key = of("n").as_py(), of("v_n").as_py(), of("key").as_py()
                q, v = (np.frombuffer(of(c).as_py(), np.float64).reshape(n, -1) for c, n in (("m", nq), ("v_m", nv)))
                if q.shape[1] != v.shape[1]:
                    continue
                if key not in best:
                    best[key], names[key] = _Best(nq, k), of("ids").values
                best[key].add(np.round(q @ v.T, digits) + 0.0, of("v_ids").values.to_numpy(zero_copy_only=False))
        for key, found in best.items():
            if len(found.q):
                yield pa.RecordBatch.from_arrays([names[key].take(pa.array(found.q)), pa.array(found.v, vec_type), pa.array(found.s)], names=["query_id", "vec_id", "score"])

    v = vectors.select(*[F.col(c).alias(f"v_{c}") for c in ("ids", "m", "n", "cells")])
    shared = (F.size("cells") == 0) | F.arrays_overlap("cells", "v_cells")
    out = [v.crossJoin(F.broadcast(q)).where(shared).mapInArrow(run, T.StructType([*kinds, T.StructField("score", T.DoubleType())])) for q in blocks(queries, "key", max(1, block // PACK))]
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return united([o.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k) for o in out])


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 8, where: Column | None = None, digits: int = 6, block: int = QUERIES) -> DataFrame:
    """(query_id, vec_id, score, rank): the k vectors of the greatest inner product.

    vectors (vec_id, embedding, …) may be filtered first; queries are (query_id, query).  Both are
    packed into matrices; queries go out in blocks of `block`, each task keeps its own best k a
    query, and ties go to the lesser id.  What is null, holds a null or NaN, or differs in length
    is not found; an empty side gives no rows.
    """
    v = vectors.where(where) if where is not None else vectors
    none = F.array().cast("array<int>")
    return _best_pairs(_packs(v, "vec_id", "embedding", none), _packs(queries, "query_id", "query", none), k, digits, block)


def centroids(rows: DataFrame, label: str = "label", vector: str = "embedding") -> DataFrame:
    """(label, centroid): the mean vector of each label, of unit length unless it is zero."""
    means = rows.select(label, F.posexplode(vector).alias("i", "x")).groupBy(label, "i").agg(F.avg(F.col("x").cast("double")).alias("x"))
    packed = means.groupBy(label).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda s: s["x"]).alias("c"))
    n = norm(F.col("c"))
    return packed.select(label, F.when(n > 0, F.transform("c", lambda x: x / n)).otherwise(F.col("c")).alias("centroid"))


def nearest_centroid(rows: DataFrame, cents: DataFrame, threshold: float, label: str = "label", id_col: str = "vec_id", vector: str = "embedding", digits: int = 6, block: int = BLOCK) -> DataFrame:
    """(id, vector_label, vector_score): the nearest centroid, `uncertain` below the threshold.

    Centroids go out in blocks of bounded size; each task keeps its best, and ties go to the lesser label.
    """
    c = cents.select(F.col(label).alias("vector_label"), "centroid")
    w = Window.partitionBy(id_col).orderBy(F.desc("vector_score"), "vector_label")
    score = F.round(inner_product(F.col(vector), F.col("centroid")), digits)
    parts = [rows.select(id_col, vector).crossJoin(F.broadcast(b)).select(id_col, "vector_label", score.alias("vector_score")) for b in blocks(c, "vector_label", block)]
    best = united(parts).withColumn("_no", F.row_number().over(w)).where("_no = 1")
    return best.select(id_col, F.when(F.col("vector_score") >= threshold, F.col("vector_label").cast("string")).otherwise("uncertain").alias("vector_label"), "vector_score")


def hit_at_k(hits: DataFrame, expected: DataFrame) -> DataFrame:
    """(hit_rate, queries): the share of queries one of whose hits matches its pattern."""
    per = hits.join(expected, "query_id").groupBy("query_id").agg(F.max(F.regexp_like("said", F.col("must_match")).cast("int")).alias("hit"))
    return per.agg(F.avg("hit").alias("hit_rate"), F.count("*").alias("queries"))


class Inverted:
    """Approximate search: vectors in the cells of their nearest centres, some cells a query.

    Centres are fitted on a sample of `sample` vectors at most; all vectors are indexed.
    """

    def __init__(self, cells: int = 32, sample: int = 20_000, rounds: int = 8, seed: int = 1):
        self.cells, self.sample, self.rounds, self.seed = cells, sample, rounds, seed

    def fit(self, vectors: DataFrame) -> Inverted:
        n = vectors.count()
        drawn = vectors if n <= self.sample else vectors.where(F.pmod(F.xxhash64("vec_id"), F.lit(1_000_000)) < int(900_000 * self.sample / n))
        x = np.array([r[0] for r in drawn.select("embedding").limit(self.sample).collect()], np.float64)
        rng = np.random.default_rng(self.seed)
        c = x[rng.permutation(len(x))[: self.cells]]
        for _ in range(self.rounds):
            at = (x @ c.T).argmax(1)
            c = np.stack([x[at == j].mean(0) if (at == j).any() else c[j] for j in range(len(c))])
            c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
        self.centres = c
        return self

    def _ranked(self, v: Column) -> Column:
        """Cells by descending nearness."""
        scores = F.array(*[F.struct((-inner_product(v, F.array(*[F.lit(float(x)) for x in c]))).alias("s"), F.lit(j).alias("c")) for j, c in enumerate(self.centres)])
        return F.transform(F.array_sort(scores), lambda s: s["c"])

    def index(self, vectors: DataFrame) -> DataFrame:
        return vectors.withColumn("cell", F.get(self._ranked(F.col("embedding")), F.lit(0)))

    def search(self, indexed: DataFrame, queries: DataFrame, k: int = 8, probes: int = 22, digits: int = 6, block: int = QUERIES) -> DataFrame:
        """top_k() among the vectors of the `probes` nearest cells of a query; no cell is shuffled to one task."""
        q = queries.select("query_id", "query", F.explode(F.slice(self._ranked(F.col("query")), 1, probes)).alias("cell"))
        sides = (_packs(d, i, v, F.array("cell")) for d, i, v in ((indexed, "vec_id", "embedding"), (q, "query_id", "query")))
        return _best_pairs(*sides, k, digits, block)
