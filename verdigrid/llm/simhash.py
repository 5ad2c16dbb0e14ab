"""SimHash near-duplicate detection with bit-sliced comparison."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verdigrid.llm.common import components, in_arrow, stored

SHINGLE = 3
RADIUS = 2
HASH_SEED = 42
#: Fingerprints are cut into so many parts; two within the radius agree on all but RADIUS of them.
PARTS = RADIUS + 2
#: Buckets above this size are cut again by the bits that their key leaves free.
BUCKET = 4096


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash: a bit is set where over half of the shingle hashes, repeats included, have it set."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    n, size = max(1, len(words) - shingle + 1), len
    line = b" ".join(words)
    starts, at = [], 0
    for w in words:
        starts.append(at)
        at += size(w) + 1
    ends = [*starts[shingle:], len(line) + 1] if len(words) >= shingle else [len(line) + 1]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(line[a : b - 1], HASH_SEED) for a, b in zip(starts, ends)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for block in range(0, n, 1 << 16):
        bits = np.unpackbits(hashes[block : block + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", fp: str = "fp", shingle: int = SHINGLE) -> DataFrame:
    """``docs`` without its text but with ``fp``, the fingerprint as a signed 64-bit integer; null counts as empty (0)."""
    docs = docs.drop(*[c for c in docs.columns if c.lower() == fp.lower()])
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(at)], np.uint64).view(np.int64)
            rest = [i for i in range(batch.num_columns) if i != at]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in rest), pa.array(prints, pa.int64())],
                names=[*(batch.schema.names[i] for i in rest), fp],
            )

    fields = [f for f in docs.schema.fields if f.name != text]
    return in_arrow(docs, run, T.StructType([*fields, T.StructField(fp, T.LongType())]))


class _Planes:
    """Bit planes of a row of fingerprints: word ``i`` of plane ``b`` holds bit ``b`` of 64 neighbours."""

    def __init__(self, prints: np.ndarray):
        self.words = -(-len(prints) // 64)
        padded = np.zeros(64 * self.words, np.uint64)
        padded[: len(prints)] = prints
        bits = np.unpackbits(padded.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        self.planes = np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").copy().view("<u8")
        varying = (self.planes != 0).any(axis=1) & (self.planes != np.uint64(2**64 - 1)).any(axis=1)
        self.order = np.flatnonzero(varying | (self.planes != self.planes[:, :1]).any(axis=1))

    def shifted(self, plane: np.ndarray, words: np.ndarray, by: int) -> np.ndarray:
        """For the chosen words, the plane as its neighbours ``by`` places further see it."""
        skip, bits = divmod(by, 64)
        low = words + skip
        value = np.where(low < self.words, plane[np.minimum(low, self.words - 1)], np.uint64(0)) >> np.uint64(bits)
        if bits:
            high = np.where(low + 1 < self.words, plane[np.minimum(low + 1, self.words - 1)], np.uint64(0))
            value |= high << np.uint64(64 - bits)
        return value


def near_pairs(keys: np.ndarray, prints: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of one bucket within ``radius``, for rows sorted by ``keys``; arrays for one distance in the row at a time.

    All rows meet their neighbour ``by`` places further at once. For every plane a carry-save step adds the differing bits to
    vertical two-bit counters; a block of 64 leaves the comparison as soon as all its lanes exceed the radius.
    """
    n = len(keys)
    edges = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1], True])
    left = np.repeat(edges[1:], np.diff(edges)) - np.arange(n)  # rows of the bucket from here on, this one included
    sliced = _Planes(prints)
    most = int(left.max(initial=1))
    for by in range(1, most):
        lanes = np.zeros(64 * sliced.words, bool)
        lanes[:n] = left > by
        alive = np.packbits(lanes, bitorder="little").view("<u8")
        words = np.flatnonzero(alive)
        alive = alive[words]
        ones, twos = np.zeros_like(alive), np.zeros_like(alive)
        for b in sliced.order:
            plane = sliced.planes[b]
            differ = plane[words] ^ sliced.shifted(plane, words, by)
            carry = ones & differ
            ones ^= differ
            over = twos & carry
            twos ^= carry
            # two-bit counters hold up to 3; the radius is at most 2
            alive &= ~over
            if radius < 3:
                alive &= ~(twos & ones) if radius == 2 else ~twos if radius == 1 else ~(ones | twos)
            keep = alive != 0
            if not keep.all():
                words, alive, ones, twos = words[keep], alive[keep], ones[keep], twos[keep]
                if not len(words):
                    break
        if len(words):
            hit = np.unpackbits(alive.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            word, lane = np.nonzero(hit)
            first = words[word] * 64 + lane
            yield first, first + by


def forest(keys: np.ndarray, prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join the same rows as all near pairs do: each row with the first of its component."""
    root = np.arange(len(keys))
    for a, b in near_pairs(keys, prints, radius):
        while len(a):
            a, b = root[a], root[b]
            apart = a != b
            a, b = np.minimum(a, b)[apart], np.maximum(a, b)[apart]
            np.minimum.at(root, b, a)
            while (root != (up := root[root])).any():
                root = up
    linked = np.flatnonzero(root != np.arange(len(keys)))
    return prints[root[linked]], prints[linked]


def _parts(bits: list[int], parts: int) -> list[list[int]]:
    return [list(map(int, p)) for p in np.array_split(bits, parts)]


def _mask(bits: list[int]) -> int:
    value = sum(1 << b for b in bits)
    return value - (1 << 64) if value >> 63 else value


def _keys(bits: list[int], parts: int, radius: int) -> list[list[int]]:
    """Bit sets so that any two fingerprints within the radius agree on at least one of them."""
    cut = _parts(bits, parts)
    return [sorted(b for i in chosen for b in cut[i]) for chosen in combinations(range(parts), parts - radius)]


def links(prints: DataFrame, radius: int = RADIUS, parts: int = PARTS, bucket: int = BUCKET) -> DataFrame:
    """Links ``(a, b)`` among different fingerprints ``fp`` with at most ``radius`` differing bits, enough to connect all that are linked.

    Fingerprints meet in buckets of equal key bits (pigeonhole: none is missed). A bucket above ``bucket`` rows is dealt again by keys from
    its free bits; with 64 bits in four parts this leaves at most 16 free bits, so no bucket can hold more than 65,536 fingerprints,
    however large the input. Inside a bucket only a spanning forest is emitted, never all pairs.
    """
    if radius >= parts or radius > 2:
        raise ValueError("the radius is at most 2 and below the number of parts")
    every = list(range(64))
    first = _keys(every, parts, radius)

    def key(band: int, bits: list[int]) -> F.Column:
        return F.struct(F.lit(band).alias("band"), F.col("fp").bitwiseAND(F.lit(_mask(bits)).cast("long")).alias("bits"))

    rows = prints.select("fp", F.explode(F.array(*[key(i, b) for i, b in enumerate(first)])).alias("k")).select("fp", "k.band", "k.bits")
    sizes = rows.groupBy("band", "bits").agg(F.count("*").alias("n")).where("n > 1")
    rows = rows.join(sizes, ["band", "bits"])
    again, number = None, len(first)
    for i, fixed in enumerate(first):
        free = [b for b in every if b not in set(fixed)]
        keys = []
        for more in _keys(free, parts, radius):
            keys.append(key(number, sorted(fixed + more)))
            number += 1
        again = F.when(F.col("band") == i, F.array(*keys)) if again is None else again.when(F.col("band") == i, F.array(*keys))
    same = F.array(F.struct("band", "bits"))
    dealt = rows.select("fp", F.explode(F.when(F.col("n") <= bucket, same).otherwise(again)).alias("k"))
    dealt = dealt.select("fp", F.col("k.band").alias("band"), F.col("k.bits").alias("bits"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted rows of whole buckets; a bucket that a batch cuts waits for the next one."""
        held = None

        def emit(band, bits, fp):
            order = np.r_[True, (band[1:] != band[:-1]) | (bits[1:] != bits[:-1])].cumsum()
            a, b = forest(order, fp.view(np.uint64), radius)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        for batch in batches:
            now = [batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1, 2)]
            if held is not None:
                now = [np.concatenate(x) for x in zip(held, now)]
            band, bits, _ = now
            if not len(band):
                continue
            cut = len(band) - int(np.argmax(((band != band[-1]) | (bits != bits[-1]))[::-1])) if ((band != band[-1]) | (bits != bits[-1])).any() else 0
            if cut:
                yield emit(*[x[:cut] for x in now])
            held = [x[cut:] for x in now]
        if held is not None and len(held[0]):
            yield emit(*held)

    sorted_buckets = dealt.repartition("band", "bits").sortWithinPartitions("band", "bits").select("band", "bits", "fp")
    return in_arrow(sorted_buckets, run, "a long, b long")


def near_dedup(
    docs: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = SHINGLE, radius: int = RADIUS,
) -> DataFrame:
    """All columns of ``docs`` but the text, plus ``fp`` and ``component_id`` (own columns of these names are replaced).

    Documents link when their fingerprints differ in at most ``radius`` bits; a component's id is its smallest key.
    A null or wordless text has fingerprint 0 and links like any other. Equal fingerprints are one node, so copies cost nothing;
    repeated rows share one component. A null key never names a component unless it has no other. An empty table gives an empty result.
    """
    docs = docs.drop(*[c for c in docs.columns if c.lower() == "component_id"])
    prints = stored(fingerprints(docs, text, "fp", shingle), "fingerprints")
    nodes = stored(prints.groupBy("fp").agg(F.min(key).alias("least")), "fingerprint-nodes")
    roots = components(links(nodes, radius)).withColumnRenamed("node", "fp")
    rooted = nodes.join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "least")
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    ids = rooted.select("fp", "root").join(named, "root").select("fp", "component_id")
    return prints.join(ids, "fp").select(*prints.columns, "component_id")
