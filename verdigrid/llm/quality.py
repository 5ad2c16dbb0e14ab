"""Quality rules: counts of each text and language-specific perplexity bands."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from verdigrid.llm.common import in_arrow, solid_key, stored
from verdigrid.llm.exact_dedup import normal_form, sha256
from verdigrid.llm.ngrams import SHARD, perplexities, train

SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED = 30
#: Half-width of a band: so many median deviations of the language, and room for the noise of a text of n characters, LENGTH_NOISE / sqrt(n).
DEVIATIONS = 4.0
LENGTH_NOISE = 2.0
#: Losses are placed on a grid of this many steps per nat; medians are exact on it.
GRID = 1024
#: A band is never narrower than so many nats for each deviation, also where most losses of a language agree.
LEAST_SPREAD = 1 / 64
#: Digests of repeated texts are broadcast up to this number (32 bytes each), beyond it they are joined by shuffle.
BROADCAST_DIGESTS = 1_000_000
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)


def repeated_words(words: list) -> int:
    """Words inside a window of eight that the text holds twice or more; windows with equal hashes are compared word by word."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    number: dict = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.uint64, len(words))
    ids = (ids + np.uint64(1)) * _MIX[0]
    ids ^= ids >> np.uint64(29)
    hashes = np.zeros(n, np.uint64)
    for i in range(WINDOW):
        hashes += ids[i : i + n] * _MIX[i]
    order = np.argsort(hashes, kind="stable")
    ordered = hashes[order]
    same = ordered[1:] == ordered[:-1]
    if not same.any():
        return 0
    suspects = np.sort(order[np.r_[False, same] | np.r_[same, False]])
    windows = [tuple(words[i : i + WINDOW]) for i in suspects]
    often = Counter(windows)
    change = np.zeros(len(words) + 1, np.int64)
    for at, window in zip(suspects, windows):
        if often[window] > 1:
            change[at] += 1
            change[at + WINDOW] -= 1
    return int((np.cumsum(change) > 0).sum())


def text_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` of a whole text."""
    if not text:
        return 0, 0, 0, 0, 0
    words = text.encode("utf-8", "surrogatepass").split()
    lines = [line for line in text.split("\n") if line.strip(SPACE)]
    return (
        len(words),
        len(text) - sum(map(text.count, SPACE)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without its text, with the five counts; null counts as no words."""
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([text_counts(t.as_py()) for t in batch.column(at)], np.int64).reshape(-1, 5)
            rest = [i for i in range(batch.num_columns) if i != at]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in rest), *(pa.array(found[:, i]) for i in range(5))],
                names=[*(batch.schema.names[i] for i in rest), *COUNTS],
            )

    schema = docs.drop(text).schema
    for name in COUNTS:
        schema = schema.add(name, "long")
    return in_arrow(docs, run, schema)


def middle(steps: DataFrame, of: str) -> DataFrame:
    """Weighted lower median of the grid steps of each language: ``lang_key, of``."""
    upto = F.sum("n").over(W.partitionBy("lang_key").orderBy("step"))
    total = F.sum("n").over(W.partitionBy("lang_key"))
    half = steps.select("lang_key", "step", upto.alias("upto"), total.alias("total")).where("2 * upto >= total")
    return half.groupBy("lang_key").agg(F.min("step").alias(of))


def bands(losses: DataFrame) -> DataFrame:
    """``lang_key, centre, spread`` in nats: median of the losses and median distance from it, over all rows of a language.

    Rows meet as counts on a fixed grid, so a language with most of the rows is no hot spot and reruns agree.
    """
    steps = stored(losses.groupBy("lang_key", F.floor(F.col("loss") * GRID).alias("step")).agg(F.count("*").alias("n")), "loss-grid")
    centre = middle(steps, "centre")
    away = steps.join(centre, "lang_key").groupBy("lang_key", F.abs(F.col("step") - F.col("centre")).alias("step")).agg(F.sum("n").alias("n"))
    both = centre.join(middle(away, "spread"), "lang_key")
    return stored(both.select("lang_key", ((F.col("centre") + 0.5) / GRID).alias("centre"), F.greatest(F.col("spread") / GRID, F.lit(LEAST_SPREAD)).alias("spread")), "bands")


def different_texts(docs: DataFrame) -> DataFrame:
    """One ``text`` for each different normal form in ``docs (text, digest)``, told by its digest of 256 bits. Only texts of a repeated digest move."""
    often = stored(docs.groupBy("digest").agg(F.count("*").alias("n")).where("n > 1").select("digest"), "repeated-digests")
    if often.count() <= BROADCAST_DIGESTS:
        often = F.broadcast(often)
    single = docs.join(often, "digest", "left_anti").select("text")
    copies = docs.join(often, "digest", "left_semi").groupBy("digest").agg(F.min("text").alias("text"))
    return single.unionByName(copies.select("text"))


def judge(
    docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", rows: int = SHARD, each_text_once: bool = False,
) -> DataFrame:
    """``id``, the five counts, ``base_failed, mean_loss, low, high, kept`` for each row of ``docs``.

    The model is counted over all whole texts of ``docs``. A row is kept if it passes the base rules (enough words, few repeated
    windows) and its mean loss lies in the band of its language. A null text has no words and fails; a null language is a
    language of its own; repeated rows get the same verdict. Other columns play no part. An empty table gives an empty result.

    With ``each_text_once`` texts of one normal form (see ``exact_dedup``) count once in the model and once per language in its band, so
    a group of copies neither memorises itself nor moves the band; all its rows are still judged.
    """
    plain = docs.select(F.col(key).alias("id"), F.col(text).alias("text"), solid_key(F.col(lang)).alias("lang_key"), F.xxhash64(text).alias("text_hash"))
    if each_text_once:
        plain = plain.withColumn("digest", sha256(normal_form(F.col("text"))))
    model = train(different_texts(plain.select("text", "digest")) if each_text_once else plain)
    losses = perplexities(plain, model, "id", "text", rows)
    losses = losses.select(F.col("id").alias("of"), F.col("text_hash").alias("of_hash"), "mean_loss", "n_scored")
    found = counts(plain)
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    found = found.join(losses, found["id"].eqNullSafe(losses["of"]) & (F.col("text_hash") == F.col("of_hash")))
    found = stored(found.withColumn("base_failed", failed).drop("of", "of_hash"), "quality")
    usable = found.where("NOT base_failed AND mean_loss IS NOT NULL").withColumn("loss", F.col("mean_loss"))
    if each_text_once:
        usable = usable.groupBy("lang_key", "digest").agg(F.min("loss").alias("loss"))
    band = bands(usable.select("lang_key", "loss"))
    room = F.col("spread") * DEVIATIONS + F.lit(LENGTH_NOISE) / F.sqrt(F.greatest("n_scored", F.lit(1)))
    low, high = F.col("centre") - room, F.col("centre") + room
    good = ~F.col("base_failed") & F.col("mean_loss").between(F.col("low"), F.col("high"))
    return (
        found.join(band, "lang_key", "left").withColumn("low", low).withColumn("high", high)
        .select("id", *COUNTS, "base_failed", "mean_loss", "low", "high", F.coalesce(good, F.lit(False)).alias("kept"))
    )
