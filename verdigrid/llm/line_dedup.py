"""Removal of lines that an earlier document holds, as bitmaps over each document's lines (DataFrame operations only).

The keys of all lines are dealt by ranges of their hash and sorted by hash, document and position within a range. One pass over that order
meets the first occurrence of each key first; everything of a later document goes. Only hashes and positions move, never text, and what
comes back is one bitmap per document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from verdigrid.llm.common import stored
from verdigrid.session import broadcast_within

WHITE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_LENGTH = 10
#: Documents, for each range, in the sample that shows which keys are too frequent for one range. The sample decides how lines are dealt, never a result.
SAMPLED = 64
#: A key is spread over all ranges when it holds more than one in so many parts of a range's even share; at most this many keys per range can.
SPREAD = 8


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased and nothing else. Plain ASCII text takes the fast built-in."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def line_key(line: Column) -> Column:
    """What makes two lines equal: the line without white space at both ends, in ASCII lower case."""
    return ascii_lower(F.btrim(line, F.lit(WHITE)))


def lines_of(text: Column) -> Column:
    """The lines of a whole text; a null or empty text is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def hashed_lines(docs: DataFrame, text: str, key: str, least_length: int) -> DataFrame:
    """``id, mark, pos, h1, h2`` of each line whose key is long enough: 128 bits of hash, the document's key, a hash of its text and the line's place."""
    rows = docs.select(F.col(key).alias("id"), F.xxhash64(text).alias("mark"), F.posexplode(lines_of(F.col(text))).alias("pos", "line"))
    rows = rows.select("id", "mark", "pos", line_key(F.col("line")).alias("k")).where(F.char_length("k") >= least_length)
    return rows.select("id", "mark", "pos", F.xxhash64("k").alias("h1"), F.xxhash64(F.lit("second"), "k").alias("h2"))


def frequent_keys(docs: DataFrame, text: str, key: str, least_length: int, ranges: int) -> DataFrame:
    """``h1, h2`` of the keys that would crowd a range, at most ``SPREAD * ranges`` of them, from a sample of whole documents."""
    share = min(1.0, SAMPLED * ranges / max(1, docs.count()))
    drawn = F.pmod(F.xxhash64(F.lit("sample"), F.col(key).cast("string"), F.xxhash64(text)), F.lit(1 << 20)) < int(share * (1 << 20)) + 1
    counts = stored(hashed_lines(docs.where(drawn), text, key, least_length).groupBy("h1", "h2").agg(F.count("*").alias("n")), "line-sample")
    total = counts.agg(F.sum("n")).first()[0] or 0
    return counts.where((F.col("n") > 1) & (F.col("n") * SPREAD * ranges > total)).select("h1", "h2")


def dropped_lines(docs: DataFrame, text: str = "text", key: str = "doc_id", least_length: int = LEAST_LENGTH, ranges: int | None = None) -> DataFrame:
    """``id, mark, pos`` of the lines that go.

    One exchange: by range of the hash, and for the few keys that hold a large share of all lines by document and place, so that no task holds
    more than its part of them. In each task the rows of a key stream by in order of document and place, behind the first. Of a spread key the
    firsts of its parts, at most one document each, are compared once more.
    """
    spark = docs.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    often = frequent_keys(docs, text, key, least_length, ranges).withColumn("spread", F.lit(True))
    lines = hashed_lines(docs, text, key, least_length).join(F.broadcast(often), ["h1", "h2"], "left")
    of_hash = F.shiftright(F.shiftrightunsigned("h1", 33) * F.lit(ranges).cast("long"), 31)
    of_place = F.pmod(F.xxhash64("id", "mark", "pos"), F.lit(ranges).cast("long"))
    part = F.when(F.col("spread"), of_place).otherwise(of_hash).cast("int")
    dealt = lines.select("id", "mark", "pos", "h1", "h2", F.coalesce("spread", F.lit(False)).alias("spread"), part.alias("part"))
    dealt = dealt.repartitionById(ranges, F.col("part"))
    passing = W.partitionBy("part", "h1", "h2").orderBy(F.col("id").asc_nulls_last(), "mark", "pos").rowsBetween(W.unboundedPreceding, W.currentRow)
    seen = dealt.withColumn("later", ~F.col("id").eqNullSafe(F.first("id").over(passing))).where("later OR spread")
    seen = stored(seen.drop("part"), "line-verdicts")
    firsts = seen.where("spread AND NOT later")
    least = firsts.groupBy("h1", "h2").agg(F.min("id").alias("least"))
    again = firsts.join(F.broadcast(least), ["h1", "h2"]).where(~F.col("id").eqNullSafe(F.col("least")))
    return seen.where("later").select("id", "mark", "pos").unionByName(again.select("id", "mark", "pos"))


def line_bitmaps(docs: DataFrame, text: str = "text", key: str = "doc_id", **options) -> DataFrame:
    """``id, mark, n_dropped, words``: for each document that loses lines the 64-bit words of its bitmap in which a bit is set.

    ``words`` lists ``(word, bits)`` in order; bit ``i`` of word ``w`` set means that line ``64 * w + i`` goes. Words without such a line
    are left out, and documents that keep all lines have no row.
    """
    gone = dropped_lines(docs, text, key, **options)
    word = F.shiftright("pos", 6)
    bits = gone.groupBy("id", "mark", word.alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, pos % 64)")).alias("bits"))
    return stored(
        bits.groupBy("id", "mark").agg(
            F.sum(F.bit_count("bits")).cast("long").alias("n_dropped"), F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("words")
        ),
        "line-bitmaps",
    )


def flat_bitmap(words: Column) -> Column:
    """The bitmap as one array of words up to the last one listed."""

    def run(e: Column, i: Column) -> Column:
        before = F.when(i > 0, F.get(words, i - 1)["word"]).otherwise(F.lit(-1))
        return F.concat(F.array_repeat(F.lit(0).cast("long"), e["word"] - before - 1), F.array(e["bits"]))

    return F.flatten(F.transform(words, run))


def dedup_lines(
    docs: DataFrame, text: str = "text", key: str = "doc_id", least_length: int = LEAST_LENGTH, ranges: int | None = None,
) -> DataFrame:
    """Each row of ``docs`` as struct ``row``, with ``n_lines, n_dropped, kept_text``.

    A line is told by its key (``line_key``). Keys of at least ``least_length`` code points that several documents hold stay only in the
    document with the smallest ``key``, there with all their lines. Other lines stay as they are, and the rest is joined again.

    A null or empty text is one empty line. A ``key`` names a document: rows that repeat it are one document, and a null key is one document
    that comes last. A text that loses all lines becomes empty. Columns of any name ride along in ``row``. An empty table gives an empty result.
    """
    bitmaps = line_bitmaps(docs, text, key, least_length=least_length, ranges=ranges)
    flat = bitmaps.select(F.col("id").alias("of"), F.col("mark").alias("of_mark"), "n_dropped", flat_bitmap(F.col("words")).alias("gone"))
    rows = docs.select(F.struct("*").alias("row"), F.col(key).alias("id"), F.xxhash64(text).alias("mark"), F.col(text).alias("whole"))
    both = rows.join(broadcast_within(flat), F.col("id").eqNullSafe(F.col("of")) & (F.col("mark") == F.col("of_mark")), "left")
    stays = lambda line, i: F.getbit(F.coalesce(F.get("gone", F.shiftright(i, 6)), F.lit(0).cast("long")), i % 64) == 0
    rest = F.array_join(F.filter(lines_of(F.col("whole")), stays), "\n")
    n_lines = F.char_length("whole") - F.char_length(F.replace("whole", F.lit("\n"), F.lit(""))) + 1
    return both.select(
        "row", F.coalesce(n_lines, F.lit(1)).cast("long").alias("n_lines"), F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("gone").isNull(), F.coalesce("whole", F.lit(""))).otherwise(rest).alias("kept_text"),
    )
