"""Interpolated modified Kneser-Ney models over character n-grams: counted, discounted and joined by Spark.

Texts become symbols of seven bits: the start mark 0, white space and control characters 1, line ends 2, characters beyond
ASCII 3 to 32 by code point, and each printable ASCII character its own. An n-gram is the symbols of ``ORDER`` neighbours in
one 64-bit number, the latest lowest, so its suffix is a mask and its context a shift. A text starts after ``ORDER - 1`` marks.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdigrid.llm.common import in_arrow, stored

ORDER = 5
BITS = 7
SYMBOLS = 1 << BITS
#: Entries of a model that one task holds at a time; a larger model is cut into more shards.
SHARD = 2_000_000
#: Characters that are hashed and sorted at a time.
CHUNK = 1 << 19
#: Different n-grams that a task adds up before it hands them on.
HELD = 1 << 18
#: Bits of an n-gram below the number of the table it belongs to.
_TABLE = 40


def symbol_table() -> np.ndarray:
    """Symbol of each code point below 128."""
    table = np.ones(SYMBOLS, np.uint8)
    table[ord("\n")] = 2
    table[32:127] = np.arange(33, 128)
    return table


_ASCII = symbol_table()


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram that ends at each character of the texts in a row, and the number of characters of each text."""
    marks = "\0" * (ORDER - 1)
    joined = marks + marks.join(texts)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    symbols = np.where(points < SYMBOLS, _ASCII[np.minimum(points, SYMBOLS - 1)], 3 + points % 30).astype(np.int64)
    starts = np.r_[0, np.cumsum(lengths + ORDER - 1)[:-1]]
    inside = np.ones(len(symbols), bool)
    for i in range(ORDER - 1):
        symbols[starts + i] = 0
        inside[starts + i] = False
    codes = symbols.copy()
    for back in range(1, ORDER):
        codes[back:] |= symbols[:-back] << (BITS * back)
    return codes[inside] & ((1 << BITS * ORDER) - 1), lengths


def pieces(texts: Iterable[str | None]) -> Iterator[list[str]]:
    """Consecutive texts of about ``CHUNK`` characters together; a longer text is a piece of its own."""
    held, size = [], 0
    for text in texts:
        held.append(text or "")
        size += len(held[-1])
        if size >= CHUNK:
            yield held
            held, size = [], 0
    if held:
        yield held


def added(one: tuple[np.ndarray, np.ndarray], two: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Two tables of sorted keys and counts as one."""
    keys, n = np.concatenate([one[0], two[0]]), np.concatenate([one[1], two[1]])
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[starts], np.add.reduceat(n, starts).astype(np.int64) if len(keys) else n


def counted(docs: DataFrame, text: str = "text") -> DataFrame:
    """``gram, n`` over all whole texts: counts per chunk first, added up within a task while they fit, then summed by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for piece in pieces(t.as_py() for batch in batches for t in batch.column(0)):
            held = added(held, np.unique(grams(piece)[0], return_counts=True))
            if len(held[0]) > HELD:
                yield pa.RecordBatch.from_arrays([pa.array(held[0]), pa.array(held[1])], names=["gram", "n"])
                held = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if len(held[0]):
            yield pa.RecordBatch.from_arrays([pa.array(held[0]), pa.array(held[1])], names=["gram", "n"])

    return in_arrow(docs.select(text), run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def discounts(counts: DataFrame) -> tuple[float, float, float]:
    """The three discounts from the numbers of n-grams that occur once to four times; the usual fixed ones where these are too few."""
    one, two, three, four = counts.agg(*[F.count_if(F.col("n") == i) for i in (1, 2, 3, 4)]).first()
    if min(one, two, three, four) == 0:
        return 0.5, 1.0, 1.5
    y = one / (one + 2 * two)
    found = 1 - 2 * y * two / one, 2 - 3 * y * three / two, 3 - 4 * y * four / three
    return found if all(0 < d <= i + 1 for i, d in enumerate(found)) else (0.5, 1.0, 1.5)


def train(docs: DataFrame, text: str = "text") -> DataFrame:
    """The model ``key, value``: log probability of each n-gram and log weight of each context, for all orders.

    The highest order has counts, the lower ones numbers of different left neighbours. Each order is joined with the sums of its
    contexts and with the next lower order; every table is keyed by n-gram, so all of it is spread over the cluster.
    """
    counts = {ORDER: stored(counted(docs, text), "gram-counts")}
    for k in range(ORDER - 1, 0, -1):
        suffix = F.col("gram").bitwiseAND(F.lit((1 << BITS * k) - 1))
        counts[k] = stored(counts[k + 1].groupBy(suffix.alias("gram")).agg(F.count("*").alias("n")), "gram-counts")
    tables, lower = [], None
    for k in range(1, ORDER + 1):
        one, two, more = discounts(counts[k])
        n = F.col("n")
        cut = F.when(n == 1, one).when(n == 2, two).otherwise(more)
        rows = counts[k].select("gram", F.shiftright("gram", BITS).alias("context"), "n", cut.alias("cut"))
        sums = rows.groupBy("context").agg(F.sum("n").alias("total"), F.count_if(n == 1).alias("a"), F.count_if(n == 2).alias("b"), F.count_if(n > 2).alias("c"))
        sums = sums.select("context", "total", ((F.col("a") * one + F.col("b") * two + F.col("c") * more) / F.col("total")).alias("weight"))
        rows = rows.join(sums, "context")
        own = (F.col("n") - F.col("cut")) / F.col("total")
        if lower is None:
            order = rows.select("gram", (own + F.col("weight") / SYMBOLS).alias("p"))
        else:
            rows = rows.withColumn("suffix", F.col("gram").bitwiseAND(F.lit((1 << BITS * (k - 1)) - 1)))
            order = rows.join(lower.select(F.col("gram").alias("suffix"), F.col("p").alias("q")), "suffix")
            order = order.select("gram", (own + F.col("weight") * F.col("q")).alias("p"))
        lower = stored(order, "gram-order")
        tables.append(lower.select((F.col("gram") + F.lit(2 * k << _TABLE)).alias("key"), F.log("p").alias("value")))
        tables.append(sums.select((F.col("context") + F.lit(2 * k + 1 << _TABLE)).alias("key"), F.log("weight").alias("value")))
    model = tables[0]
    for part in tables[1:]:
        model = model.union(part)
    return stored(model, "model")


def _shard_of(pair, n: int):
    return (pair * 40503 >> 4) % n


def shards(model: DataFrame, rows: int = SHARD) -> Iterator[tuple[int, int, Broadcast]]:
    """The model as sorted arrays of at most about ``rows`` entries, one after the other: number, how many, arrays.

    An entry of three symbols or more belongs to the shard of the two symbols before its last (of the last two of a context), so an
    n-gram finds all its shorter forms in its own shard; the entries of one and two symbols are few and are in every shard.
    """
    spark, n = model.sparkSession, -(-max(1, model.count()) // rows)
    table = F.shiftright("key", _TABLE)
    short = table < 6
    gram = F.col("key").bitwiseAND(F.lit((1 << _TABLE) - 1))
    pair = F.when(table % 2 == 0, F.shiftright(gram, BITS)).otherwise(gram).bitwiseAND(F.lit((1 << 2 * BITS) - 1))
    for i in range(n):
        part = model.where(short | (F.shiftright(pair * 40503, 4) % n == i)).toArrow()
        keys, values = part["key"].to_numpy(), part["value"].to_numpy().astype(np.float32)
        order = np.argsort(keys)
        yield i, n, spark.sparkContext.broadcast((keys[order], values[order]))


def log_probability(codes: np.ndarray, keys: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Log probability of the last symbol of each n-gram: the longest known form, times the weights of the contexts above it."""
    out, todo = np.zeros(len(codes)), np.arange(len(codes))

    def find(wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return at, keys[at] == wanted

    for k in range(ORDER, 0, -1):
        if not len(todo) or not len(keys):
            break
        gram = codes[todo] & ((1 << BITS * k) - 1)
        at, known = find(gram + (2 * k << _TABLE))
        out[todo[known]] += values[at[known]]
        todo, gram = todo[~known], gram[~known]
        at, known = find((gram >> BITS) + (2 * k + 1 << _TABLE))
        out[todo[known]] += values[at[known]]
    out[todo] -= np.log(SYMBOLS)
    return out


def score_texts(texts: list[str], keys: np.ndarray, values: np.ndarray, shard: int = 0, n_shards: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """For each text the log probability of its characters in this shard, and their number."""
    codes, lengths = grams(texts)
    different, place = np.unique(codes, return_inverse=True)
    mine = _shard_of((different >> BITS) & ((1 << 2 * BITS) - 1), n_shards) == shard
    logp = np.zeros(len(different))
    logp[mine] = log_probability(different[mine], keys, values)
    ends = np.r_[0, np.cumsum(lengths)]
    total = np.r_[0.0, np.cumsum(logp[place])]
    number = np.r_[0, np.cumsum(mine[place])]
    return total[ends[1:]] - total[ends[:-1]], number[ends[1:]] - number[ends[:-1]]


def perplexities(docs: DataFrame, model: DataFrame, key: str = "doc_id", text: str = "text", rows: int = SHARD) -> DataFrame:
    """``id, text_hash, mean_loss, n_scored``: the mean negative log probability per character of every whole text.

    One pass for each shard of the model; the partial sums of a document (told apart by key and text hash, so a repeated row changes
    nothing) are added afterwards. Texts without characters have no mean (null).
    """
    parts = None
    rest = docs.select(F.col(key).alias("id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text"))
    for i, n, arrays in shards(model, rows):

        def run(batches: Iterator[pa.RecordBatch], i=i, n=n, arrays=arrays) -> Iterator[pa.RecordBatch]:
            keys, values = arrays.value
            for batch in batches:
                sums = [score_texts(p, keys, values, i, n) for p in pieces(t.as_py() for t in batch.column(2))]
                logp = np.concatenate([s[0] for s in sums]) if sums else np.zeros(0)
                number = np.concatenate([s[1] for s in sums]) if sums else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(logp), pa.array(number.astype(np.int64))], names=["id", "text_hash", "logp", "n"]
                )

        kind = rest.schema["id"].dataType.simpleString()
        part = in_arrow(rest, run, f"id {kind}, text_hash long, logp double, n long")
        parts = part if parts is None else parts.union(part)
    sums = parts.groupBy("id", "text_hash").agg(F.sum("logp").alias("logp"), F.sum("n").alias("n_scored"))
    mean = F.when(F.col("n_scored") > 0, -F.col("logp") / F.col("n_scored"))
    return sums.select("id", "text_hash", mean.alias("mean_loss"), "n_scored")
