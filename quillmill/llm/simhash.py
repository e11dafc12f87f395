"""Near-duplicates by SimHash, found through Golay codewords.

Fingerprints of 64 bits link at up to four differing bits.  They are cut into five blocks; four
errors leave one block untouched, which is matched as it stands.  Of the bits outside that block
two segments of 23 bits are taken; one of the two has two errors at most.  The binary Golay code
of length 23 is perfect: each word lies within three bits of one codeword.  A segment gets the
index of that codeword, and if it is three bits off also those of the five codewords four bits
off.  Any two segments with two errors or fewer then share an index, so that every link is met
under some key of (block, segment, block's bits, codeword index).  What shares a key is
verified by counting bits.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded, materialise, table
from .components import connected_components

BITS, BLOCKS, SEGMENT = 64, 5, 23
MAX_BITS = 4
#: Fingerprints of one key that are compared at once; those of a key with more are dealt into parts.
CHUNK = 16384
SHORT = 48


def simhash(text: str | None, shingle: int = 4) -> int:
    """The fingerprint of a whole text, as an unsigned number; 0 for no word."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return 0
    flat = b" ".join(found)
    if len(found) <= shingle:
        return xxhash.xxh64_intdigest(flat, 42)
    size = np.fromiter(map(len, found), np.int64, len(found))
    ends = np.cumsum(size + 1) - 1
    digest = xxhash.xxh64_digest
    raw = b"".join([digest(flat[a:b], 42) for a, b in zip((ends - size).tolist(), ends[shingle - 1 :].tolist())])
    n = len(raw) // 8
    ones = np.zeros(64, np.int64)
    step = 1 << 15
    h = np.frombuffer(raw, np.uint8).reshape(n, 8)
    for i in range(0, n, step):
        ones += np.unpackbits(h[i : i + step], axis=1).sum(0, dtype=np.int32)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


def _fingerprint_batches(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [simhash(t.as_py(), shingle) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(fps, np.uint64).view(np.int64))], names=["doc_id", "fp"])

    return run


@lru_cache(1)
def golay() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of the upper twelve bits; for each syndrome the errors to try, and how many."""
    poly = 0b101011100011

    def rest(v: int) -> int:
        for i in range(22, 10, -1):
            if v >> i & 1:
                v ^= poly << (i - 11)
        return v

    upper = np.array([rest(m << 11) for m in range(4096)], np.uint32)
    errors, count = np.zeros((2048, 6), np.uint32), np.zeros(2048, np.int64)
    light = np.zeros(2048, bool)
    for w in range(5):
        for at in itertools.combinations(range(23), w):
            e = sum(1 << i for i in at)
            s = int(upper[e >> 11]) ^ (e & 2047)
            if w < 4 or not light[s]:
                errors[s, count[s]] = e
                count[s] += 1
            light[s] |= w < 3
    return upper, errors, count


def codewords(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For 23-bit words: up to six codeword indices each, and how many of the six are meant."""
    upper, errors, count = golay()
    v = v.astype(np.uint32)
    s = upper[v >> 11] ^ (v & 2047)
    return (v[:, None] ^ errors[s]) >> 11, count[s]


def keys(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, row) for all keys of the fingerprints."""
    fp = fp.astype(np.uint64)
    edges = np.linspace(0, BITS, BLOCKS + 1).round().astype(int)
    out_k, out_r = [], []
    rows = np.arange(len(fp))
    for b, (lo, hi) in enumerate(itertools.pairwise(edges.tolist())):
        width = hi - lo
        own = (fp >> np.uint64(lo)) & np.uint64((1 << width) - 1)
        low = fp & np.uint64((1 << lo) - 1)
        high = (fp >> np.uint64(hi)) if hi < 64 else np.zeros_like(fp)
        rest = low | (high << np.uint64(lo))
        for s in range(2):
            index, n = codewords((rest >> np.uint64(SEGMENT * s)) & np.uint64((1 << SEGMENT) - 1))
            for j in range(6):
                take = n > j
                out_k.append(((b * 2 + s) << 28) | (own[take].astype(np.int64) << 12) | index[take, j].astype(np.int64))
                out_r.append(rows[take])
    return np.concatenate(out_k), np.concatenate(out_r)


def _key_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fp = batch.column(0).to_numpy(zero_copy_only=False)
        for i in range(0, len(fp), 4096):
            part = fp[i : i + 4096]
            k, r = keys(part.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(part[r])], names=["key", "fp"])


def _forest(f: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what belongs together among f, one fewer than nodes for each component."""
    out_a, out_b = [], []
    rest = f
    while len(rest):
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            q = queue.pop()
            near = np.bitwise_count(rest ^ q) <= bits
            if near.any():
                hit = rest[near]
                out_a.append(np.full(len(hit), q))
                out_b.append(hit)
                queue.extend(hit)
                rest = rest[~near]
    empty = np.zeros(0, np.uint64)
    return (np.concatenate(out_a), np.concatenate(out_b)) if out_a else (empty, empty)


def _runs(k: np.ndarray, f: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links among rows of the same key; k is sorted."""
    starts = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
    size = np.diff(np.r_[starts, len(k)])
    out_a, out_b = [], []
    for s, n in zip(starts[size > SHORT].tolist(), size[size > SHORT].tolist()):
        a, b = _forest(f[s : s + n], bits)
        out_a.append(a)
        out_b.append(b)
    left = np.repeat(starts + size - 1, size) - np.arange(len(k))  # rows that follow in the run
    left[np.repeat(size > SHORT, size)] = 0
    active, d = np.flatnonzero(left > 0), 1
    while len(active):
        near = np.bitwise_count(f[active] ^ f[active + d]) <= bits
        out_a.append(f[active[near]])
        out_b.append(f[active[near] + d])
        d += 1
        active = active[left[active] >= d]
    empty = np.zeros(0, np.uint64)
    return (np.concatenate(out_a), np.concatenate(out_b)) if out_a else (empty, empty)


def _scan_batches(bits: int):
    """Links inside each run, over rows (key, block, fp) sorted by key and block."""

    def links(k: np.ndarray, f: np.ndarray) -> pa.RecordBatch:
        a, b = _runs(k, f, bits)
        lo, hi = np.minimum(a, b).view(np.int64), np.maximum(a, b).view(np.int64)
        pair = np.unique(np.stack([lo, hi]), axis=1) if len(lo) else np.zeros((2, 0), np.int64)
        return pa.RecordBatch.from_arrays([pa.array(pair[0]), pa.array(pair[1])], names=["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ks, fs, held = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], 0
        last, at = None, 0
        for batch in itertools.chain(batches, [None]):
            if batch is not None and batch.num_rows:
                key, block = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
                new = np.r_[(key[0], block[0]) != last, (key[1:] != key[:-1]) | (block[1:] != block[:-1])]
                ks.append(at + np.cumsum(new))  # runs are numbered as they come
                at, last = int(ks[-1][-1]), (key[-1], block[-1])
                fs.append(batch.column(2).to_numpy(zero_copy_only=False).view(np.uint64))
                held += batch.num_rows
            if batch is not None and held < 65536:
                continue
            k, f = np.concatenate(ks), np.concatenate(fs)
            cut = len(k) if batch is None else int(np.searchsorted(k, k[-1]))
            if cut:
                yield links(k[:cut], f[:cut])
            ks, fs, held = [k[cut:]], [f[cut:]], len(k) - cut

    return run


def fingerprint_links(fps: DataFrame, max_bits: int = MAX_BITS, chunk: int = CHUNK) -> DataFrame:
    """Links (u, v) that join what lies within max_bits among distinct fingerprints (fp long).

    Keys are counted first.  The fingerprints of a key above `chunk` are dealt by hash into parts,
    and every two parts are compared in a block of their own, so that no task gets a whole hot key
    and a block has some 2 * chunk fingerprints.
    """
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError("the keys hold for up to four bits")
    keyed = fps.select("fp").mapInArrow(_key_batches, "key long, fp long")
    counts = keyed.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > chunk)
    hot = materialise(counts.select(F.col("key").alias("its_key"), F.ceil(F.col("n") / chunk).cast("int").alias("parts")))
    dealt = keyed.join(bounded(hot), F.col("key") == F.col("its_key"), "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
    others = F.filter(F.sequence(F.lit(0), F.col("parts") - 1), lambda t: (t != F.col("part")) | (F.col("parts") == 1))
    block = F.least("part", "other") * F.col("parts").cast("long") + F.greatest("part", "other")
    dealt = dealt.withColumn("other", F.explode(others)).select("key", block.alias("block"), "fp")
    return dealt.repartition("key", "block").sortWithinPartitions("key", "block").mapInArrow(_scan_batches(max_bits), "u long, v long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, max_bits: int = MAX_BITS, chunk: int = CHUNK) -> DataFrame:
    """(doc_id, fp long, component_id) for each row of docs.

    component_id is the least id that can be reached over links of up to max_bits differing
    bits.  Null and empty texts have fingerprint 0 and link like any other.  Each row counts: a
    repeated row comes back as often.  Null ids are kept; a group of null ids only has a null
    component_id.  Columns other than the two named are ignored, whatever their names.
    """
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    prints = materialise(own.mapInArrow(_fingerprint_batches(shingle), "doc_id long, fp long"))
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = connected_components(fingerprint_links(distinct, max_bits, chunk)).withColumnRenamed("node", "fp")
    rooted = distinct.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    rooted = materialise(rooted)
    named = rooted.join(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("fp", "component_id")
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def fingerprint_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def op1_simhash_golay(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", fingerprint_hex(F.col("fp")).alias("fingerprint"), "component_id")
