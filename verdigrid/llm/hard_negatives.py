"""Hard negatives for anchors of an embedding table, by exact whole-number scores.

Anchors and candidates are cut into groups of bounded size, and a grid of cells pairs each group of one kind with each of the other. A cell
scores by table lookups: for eight dimensions of an anchor all 256 partial sums are computed once; a candidate's components are cut into bit
planes, eight dimensions to a byte, and a byte of a plane picks the sum of the dimensions whose bit is set. Planes are added by shifting.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from verdigrid.llm.common import ship, stored

SCALE = 256
POSITIVES = 5
NEGATIVES = 10
#: Bounds in percent of the positive's score.
BOUNDS = (30, 90)
#: Most rows of a cell's sides, and the fewest candidates for which a further group is made to keep all cores busy.
MOST_ANCHORS, MOST_CANDIDATES, FEW = 8_192, 131_072, 2_048
#: Candidates and anchors that are scored at a time.
CHUNK, BLOCK = 2_048, 32


def whole_numbers(vectors: pa.Array, scale: int) -> np.ndarray:
    """Rows of ``floor(scale * x)``, shorter vectors filled up with zeros to a multiple of eight."""
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    sizes = np.diff(vectors.offsets.to_numpy())
    width = -(-max(1, int(sizes.max(initial=0))) // 8) * 8
    out = np.zeros((len(sizes), width))
    out[np.arange(width) < sizes[:, None]] = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.floor(out * scale)
    if np.abs(out).max(initial=0) >= 2.0**62:
        raise OverflowError("a component is too large for whole-number scores")
    return out.astype(np.int64)


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """``[group, byte, anchor]``: the sums of the components of eight dimensions that a byte's bits select, the first dimension lowest."""
    n, width = anchors.shape
    parts = anchors.T.reshape(width // 8, 8, n)
    sums = np.zeros((width // 8, 1, n), anchors.dtype)
    for i in range(8):
        sums = np.concatenate([sums, sums + parts[:, i : i + 1]], axis=1)
    return sums


def bit_planes(candidates: np.ndarray) -> np.ndarray:
    """``[plane, group, candidate]``: bytes of two's complement bits, the sign plane last."""
    size = int(max(candidates.max(initial=0), -1 - candidates.min(initial=0)))
    planes = [np.packbits((candidates >> k & 1).astype(np.uint8), axis=1, bitorder="little").T for k in range(size.bit_length() + 1)]
    return np.stack(planes)


def scores(sums: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """``[candidate, anchor]``: exact inner products, from the highest plane down; the sign plane counts negatively."""
    total = np.zeros((planes.shape[2], sums.shape[2]), sums.dtype)
    for k in range(planes.shape[0] - 1, -1, -1):
        total <<= 1
        for g in range(planes.shape[1]):
            if k == planes.shape[0] - 1:
                total -= sums[g].take(planes[k, g], axis=0)
            else:
                total += sums[g].take(planes[k, g], axis=0)
    return total


def first_of(found: np.ndarray, k: int) -> np.ndarray:
    """Indexes of the ``k`` largest, earlier ones first on ties."""
    if len(found) > k:
        least = np.partition(found, len(found) - k)[len(found) - k]
        above = np.flatnonzero(found > least)
        pick = np.concatenate([above, np.flatnonzero(found == least)[: k - len(above)]])
    else:
        pick = np.arange(len(found))
    return pick[np.lexsort((pick, -found[pick]))]


class _Candidates:
    """The different candidates of a cell in order of label and id."""

    def __init__(self, table: pa.Table, scale: int):
        table = table.sort_by([("label", "ascending"), ("id", "ascending"), ("mark", "ascending")])
        label, self.id, self.mark = (table[c].to_numpy() for c in ("label", "id", "mark"))
        new = np.r_[True, (self.id[1:] != self.id[:-1]) | (self.mark[1:] != self.mark[:-1]) | (label[1:] != label[:-1])]
        vectors = whole_numbers(table["vector"], scale)[new]
        self.id, self.mark, self.label = self.id[new], self.mark[new], label[new]
        self.most = int(np.abs(vectors).max(initial=0))
        self.width = vectors.shape[1]
        self.planes = bit_planes(vectors)

    def places(self, label, same: bool) -> np.ndarray:
        low, high = np.searchsorted(self.label, [label, label + 1])
        return np.arange(low, high) if same else np.r_[0:low, high : len(self.label)]

    def scored(self, anchors: np.ndarray, places: np.ndarray) -> Iterator[np.ndarray]:
        """Score rows of the anchors, one after the other, over the candidates at ``places``."""
        width = max(self.width, anchors.shape[1])
        most = width * max(self.most, 1) * max(int(np.abs(anchors).max(initial=0)), 1)
        if most * 2 >= 2**63:
            raise OverflowError("scores do not fit 64 bits")
        kind = np.int32 if most * 2 < 2**31 else np.int64
        padded = np.zeros((len(anchors), self.width), kind)
        padded[:, : min(width, anchors.shape[1], self.width)] = anchors[:, : self.width]
        for at in range(0, len(anchors), BLOCK):
            sums = subset_sums(padded[at : at + BLOCK])
            rows = np.empty((len(places), sums.shape[2]), kind)
            for c in range(0, len(places), CHUNK):
                rows[c : c + CHUNK] = scores(sums, self.planes[:, :, places[c : c + CHUNK]])
            yield from np.ascontiguousarray(rows.T).astype(np.int64)


def _by_label(anchors: pa.Table) -> Iterator[tuple[object, np.ndarray]]:
    labels = anchors["label"].to_numpy()
    for label in np.unique(labels):
        yield label, np.flatnonzero(labels == label)


def _table(out: dict[str, list]) -> pa.Table:
    return pa.table({c: np.concatenate(v).astype(np.int64) if v else np.zeros(0, np.int64) for c, v in out.items()})


def _positives(anchors: pa.Table, candidates: pa.Table, scale: int, count: int) -> pa.Table:
    out = {c: [] for c in ("id", "mark", "other", "other_mark", "score")}
    if not (anchors.num_rows and candidates.num_rows):
        return _table(out)
    cell = _Candidates(candidates, scale)
    vectors, ids, marks = whole_numbers(anchors["vector"], scale), anchors["id"].to_numpy(), anchors["mark"].to_numpy()
    for label, mine in _by_label(anchors):
        places = cell.places(label, True)
        for i, row in zip(mine, cell.scored(vectors[mine], places)):
            other = cell.id[places] != ids[i]
            best = np.flatnonzero(other)[first_of(row[other], count)]
            for name, values in zip(out, (ids[i], marks[i], cell.id[places[best]], cell.mark[places[best]], row[best])):
                out[name].append(np.broadcast_to(values, len(best)))
    return _table(out)


def _negatives(anchors: pa.Table, candidates: pa.Table, scale: int, count: int, bounds: tuple[int, int]) -> pa.Table:
    out = {c: [] for c in ("id", "mark", "bar", "other", "other_mark", "score")}
    if not (anchors.num_rows and candidates.num_rows):
        return _table(out)
    cell = _Candidates(candidates, scale)
    vectors, ids, marks, bars = whole_numbers(anchors["vector"], scale), anchors["id"].to_numpy(), anchors["mark"].to_numpy(), anchors["bars"].to_pylist()
    for label, mine in _by_label(anchors):
        places = cell.places(label, False)
        for i, row in zip(mine, cell.scored(vectors[mine], places)):
            for bar in bars[i]:
                inside = np.flatnonzero((row >= -(-bounds[0] * bar // 100)) & (row <= bounds[1] * bar // 100) & (cell.id[places] != ids[i]))
                if len(inside) > count:  # candidates stand by label first, so ties need their ids in order
                    least = np.partition(row[inside], len(inside) - count)[len(inside) - count]
                    inside = inside[row[inside] >= least]
                best = inside[np.lexsort((cell.mark[places[inside]], cell.id[places[inside]], -row[inside]))][:count]
                for name, values in zip(out, (ids[i], marks[i], bar, cell.id[places[best]], cell.mark[places[best]], row[best])):
                    out[name].append(np.broadcast_to(values, len(best)))
    return _table(out)


def _usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True))


def _cells(anchors: DataFrame, candidates: DataFrame, n_anchors: int, n_candidates: int):
    """Anchors and candidates grouped by the cells of the grid, each cell bounded on both sides."""
    cores = candidates.sparkSession.sparkContext.defaultParallelism
    down = -(-n_anchors // MOST_ANCHORS) or 1
    across = max(-(-n_candidates // MOST_CANDIDATES), min(2 * cores, n_candidates // FEW), 1)
    group = lambda n: F.pmod(F.xxhash64("id", F.lit("cell")), F.lit(n)).cast("int")
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = anchors.withColumn("a", group(down)).withColumn("c", spread(across))
    right = candidates.withColumn("c", group(across)).withColumn("a", spread(down))
    return left.groupBy("a", "c").cogroup(right.groupBy("a", "c"))


def _best(rows: DataFrame, within: list[str], count: int) -> DataFrame:
    """The first ``count`` rows of each group by score, then id; a limit per group holds before the exchange already."""
    order = W.partitionBy(*within).orderBy(F.desc("score"), "other", "other_mark")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)


def hard_negatives(
    rows: DataFrame, is_anchor: Column, key: str = "vec_id", vector: str = "embedding", label: str = "label", scale: int = SCALE,
    positives: int = POSITIVES, negatives: int = NEGATIVES, bounds: tuple[int, int] = BOUNDS,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    A score is the inner product of two vectors of ``floor(scale * x)``, in whole numbers. For each row of ``is_anchor`` the first ``positives``
    other rows of its label are its positives; for each of them the first ``negatives`` rows of other labels whose score lies within
    ``bounds`` percent of the positive's are returned. Higher scores come first, ties by smaller ``key``. Every pair is scored once: pairs of one label
    in the first pass, the others in the second.

    Rows with a null key, label or vector, or with a null or non-finite component, take no part. Equal rows count once; rows that share a key but
    differ are rows of their own that are never each other's positive or negative. A shorter vector counts as filled up with zeros. Scores that do not fit
    64 bits raise ``OverflowError``. An anchor without positives or negatives has no row. Other columns play no part; an empty table gives an empty result.
    """
    spark = rows.sparkSession
    ship(spark)
    part = rows.select(F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).alias("vector"), is_anchor.alias("anchor"))
    part = part.where(F.col("id").isNotNull() & F.col("label").isNotNull() & _usable(F.col("vector")))
    part = stored(part.withColumn("mark", F.xxhash64("vector")), "vectors")
    columns = ["id", "label", "mark", "vector"]
    anchors = stored(part.where("anchor").select(*columns).dropDuplicates(["id", "label", "mark"]), "anchors")
    candidates = part.select(*columns)
    n_anchors, n_candidates = anchors.count(), candidates.count()

    def same(left: pa.Table, right: pa.Table) -> pa.Table:
        return _positives(left, right, scale, positives)

    found = _cells(anchors, candidates, n_anchors, n_candidates).applyInArrow(same, "id long, mark long, other long, other_mark long, score long")
    best = stored(_best(found, ["id", "mark"], positives).drop("rank"), "positives")
    bars = best.groupBy(F.col("id").alias("of"), F.col("mark").alias("of_mark")).agg(F.collect_set("score").alias("bars"))
    barred = anchors.join(bars, (F.col("id") == F.col("of")) & (F.col("mark") == F.col("of_mark"))).drop("of", "of_mark")

    def different(left: pa.Table, right: pa.Table) -> pa.Table:
        return _negatives(left, right, scale, negatives, bounds)

    met = _cells(barred, candidates, n_anchors, n_candidates).applyInArrow(
        different, "id long, mark long, bar long, other long, other_mark long, score long"
    )
    last = _best(met, ["id", "mark", "bar"], negatives).select(
        F.col("id").alias("of"), F.col("mark").alias("of_mark"), "bar", "rank", F.col("other").alias("negative_id"), F.col("score").alias("negative_score")
    )
    on = (F.col("id") == F.col("of")) & (F.col("mark") == F.col("of_mark")) & (F.col("score") == F.col("bar"))
    return best.join(last, on).select(
        F.col("id").alias("anchor_id"), F.col("other").alias("positive_id"), F.col("rank").cast("int").alias("rank"), "negative_id",
        F.col("score").alias("positive_score"), "negative_score",
    )
