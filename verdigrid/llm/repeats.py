"""Removal of long byte strings that occur more than once in a collection.

A document's windows of ``LENGTH`` bytes are dealt out by an anchor: the least hash among the ``ANCHOR``-byte strings inside the window, the
leftmost if several are equal. Equal windows have equal anchors at equal places. Neighbouring windows with one anchor travel together as
a segment. Equal segments repeat as a whole and are settled by counting. Different segments around equal anchors form small collections, and
these are ordered column by column: every round inserts one symbol of every segment, renews the ranks of all of them and lets go those
that share their prefix with no other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdigrid.llm.common import in_arrow, stored

LENGTH = 400
ANCHOR = 128
#: Anchor starts in a window.
PLACES = LENGTH - ANCHOR + 1
#: Bytes that are hashed together; longer documents go through in blocks that overlap by a window.
PIECE = 1 << 22
#: Segments that one task orders together. A larger collection is settled by counting digests of its windows instead.
COLLECTION = 8192
_POSITION = 24
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3], np.uint64)

SEGMENT = "id {id}, mark int, anchor long, content long, first long, n_windows int, before int, times int"


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def anchor_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the ``ANCHOR`` bytes from each place on, by doubling."""
    h = _mixed((data.astype(np.uint64) + np.uint64(1)) * _ODD[0])
    size = 1
    for odd in _ODD:
        h = _mixed(h[:-size] * odd + h[size:])
        size *= 2
    return h


def least_of(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of ``width`` neighbours from each place on."""
    size = 1
    while 2 * size <= width:
        keys = np.minimum(keys[:-size], keys[size:])
        size *= 2
    return np.minimum(keys[: len(keys) - (width - size)], keys[width - size :]) if width > size else keys


def segments(texts: list[bytes]) -> dict[str, np.ndarray]:
    """The segments of a few texts in a row: which text, first window, number of windows, bytes before the anchor, anchor and content hash.

    A content that a text holds several times comes once, with its number; all its windows then also come as ``settled`` rows (number 0).
    """
    data = b"".join(texts)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(lengths)
    names = ("text", "first", "n_windows", "before", "anchor", "content", "times")
    if not (lengths >= LENGTH).any():
        return {n: np.zeros(0, np.int64) for n in names}
    hashes = anchor_hashes(np.frombuffer(data, np.uint8))
    keys = (hashes >> np.uint64(_POSITION) << np.uint64(_POSITION)) | np.arange(len(hashes), dtype=np.uint64)
    least = least_of(keys, PLACES)
    of = np.repeat(np.arange(len(texts)), lengths)[: len(least)]
    inside = np.arange(len(least)) + LENGTH <= ends[of]
    new = inside & np.r_[True, (least[1:] != least[:-1]) | (of[1:] != of[:-1]) | ~inside[:-1]]
    starts = np.flatnonzero(new)
    stops = np.flatnonzero(inside & np.r_[new[1:] | ~inside[1:], True]) + 1
    n_windows = stops - starts
    place = (least[starts] & np.uint64((1 << _POSITION) - 1)).astype(np.int64)
    view, digest = memoryview(data), xxhash.xxh3_64_intdigest
    content = np.fromiter((digest(view[a:b]) for a, b in zip(starts, stops + LENGTH - 1)), np.uint64, len(starts)).view(np.int64)
    text = of[starts]
    rows = {
        "text": text, "first": starts - (ends - lengths)[text], "n_windows": n_windows, "before": place - starts,
        "anchor": hashes[place].view(np.int64), "content": content,
    }
    order = np.lexsort((starts, content, text))
    head = np.r_[True, (content[order][1:] != content[order][:-1]) | (text[order][1:] != text[order][:-1])]
    group = np.cumsum(head) - 1
    times = np.bincount(group)
    out = {k: v[order[head]] for k, v in rows.items()} | {"times": times}
    again = np.sort(order[times[group] > 1])
    if len(again):
        joint = (text[again][1:] == text[again][:-1]) & (starts[again][1:] == stops[again][:-1])
        heads, tails = np.r_[True, ~joint], np.r_[~joint, True]
        settled = {k: v[again[heads]] for k, v in rows.items()} | {"times": np.zeros(int(heads.sum()), np.int64)}
        settled["n_windows"] = stops[again[tails]] - starts[again[heads]]
        out = {k: np.r_[out[k], settled[k]] for k in out}
    return out


def blocks(texts: Iterator[bytes]) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """Texts in lists of about ``PIECE`` bytes: number of the text, offset in it, bytes. A long text is cut so that each window lies in one block."""
    numbers, offsets, held, size = [], [], [], 0
    for i, text in enumerate(texts):
        for at in range(0, max(1, len(text) - LENGTH + 1), PIECE):
            block = text[at : at + PIECE + LENGTH - 1]
            numbers.append(i)
            offsets.append(at)
            held.append(block)
            size += len(block)
            if size >= PIECE:
                yield numbers, offsets, held
                numbers, offsets, held, size = [], [], [], 0
    if held:
        yield numbers, offsets, held


def all_segments(docs: DataFrame) -> DataFrame:
    """Segments of ``docs (id, mark, text)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = ((t.as_py() or "").encode() for t in batch.column(2))
            for numbers, offsets, held in blocks(texts):
                found = segments(held)
                row = pa.array(np.array(numbers)[found["text"]])
                first = found["first"] + np.array(offsets, np.int64)[found["text"]]
                columns = [batch.column(0).take(row), batch.column(1).take(row), pa.array(found["anchor"]), pa.array(found["content"]), pa.array(first)]
                columns += [pa.array(found[k].astype(np.int32)) for k in ("n_windows", "before", "times")]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "mark", "anchor", "content", "first", "n_windows", "before", "times"])

    return in_arrow(docs, run, SEGMENT.format(id=docs.schema["id"].dataType.simpleString()))


def _classes(ranks: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One round: ranks of the prefixes that one more symbol makes longer, and which of them are shared."""
    _, renewed, times = np.unique(ranks.astype(np.int64) << 8 | symbols, return_inverse=True, return_counts=True)
    return renewed, times[renewed] > 1


def shared_windows(collection: np.ndarray, texts: list[bytes], before: np.ndarray, n_windows: np.ndarray) -> np.ndarray:
    """For each segment, which of its windows another segment of its collection holds at the same anchor.

    Column-wise: the symbols right of the anchor's start go in one per round, then those left of it. A window reaching ``d`` bytes left is shared
    if the rank of its left part after ``d`` rounds and that of its right part after ``LENGTH - d`` rounds occur together again.
    """
    n, width = len(texts), LENGTH + PLACES - 1
    right = np.zeros((LENGTH, n), np.uint8)
    left = np.zeros((PLACES, n), np.uint8)
    for i, (text, b) in enumerate(zip(texts, before)):
        row = np.frombuffer(text, np.uint8)
        after = row[b : b + LENGTH]
        right[: len(after), i] = after
        left[:b, i] = row[:b][::-1]
    assert all(len(t) <= width for t in texts)
    ranks = np.full((PLACES, n), -1, np.int32)  # of right parts of LENGTH - d symbols
    active, rank = np.arange(n), np.unique(collection, return_inverse=True)[1]
    for m in range(1, LENGTH + 1):
        rank, shared = _classes(rank, right[m - 1, active])
        active, rank = active[shared], rank[shared]
        if not len(active):
            break
        if LENGTH - m < PLACES:
            ranks[LENGTH - m, active] = rank
    hits = np.zeros((n, PLACES), bool)
    active, rank = np.arange(n), np.unique(collection, return_inverse=True)[1]
    for d in range(PLACES):
        if d:
            rank, shared = _classes(rank, left[d - 1, active])
            active, rank = active[shared], rank[shared]
            if not len(active):
                break
        window = before[active] - d
        here = (window >= 0) & (window < n_windows[active]) & (ranks[d, active] >= 0)
        if here.sum() > 1:
            who = active[here]
            pair = rank[here].astype(np.int64) << 32 | ranks[d, who]
            _, again, times = np.unique(pair, return_inverse=True, return_counts=True)
            who = who[times[again] > 1]
            hits[who, before[who] - d] = True
    return hits


def _runs(hits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first and one past the last of each run of true values."""
    padded = np.zeros((hits.shape[0], hits.shape[1] + 2), np.int8)
    padded[:, 1:-1] = hits
    step = np.diff(padded, axis=1)
    row, first = np.nonzero(step == 1)
    return row, first, np.nonzero(step == -1)[1]


def _ordered(rows: DataFrame) -> DataFrame:
    """Spans of the shared windows of ``rows (anchor, id, mark, first, n_windows, before, text)``, whole collections in each task."""
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def settle(table: pa.Table) -> Iterator[pa.RecordBatch]:
            first = table["first"].to_numpy()
            hits = shared_windows(
                table["anchor"].to_numpy(), table["text"].to_pylist(), table["before"].to_numpy().astype(np.int64), table["n_windows"].to_numpy()
            )
            row, a, b = _runs(hits)
            if len(row):
                taken = table.select(["id", "mark"]).take(pa.array(row)).combine_chunks()
                yield from taken.append_column("start", pa.array(first[row] + a)).append_column("stop", pa.array(first[row] + b + LENGTH - 1)).to_batches()

        held = None
        for batch in batches:
            now = pa.Table.from_batches([batch])
            held = now if held is None else pa.concat_tables([held, now])
            while held.num_rows > COLLECTION:
                anchor = held["anchor"].to_numpy()
                change = np.flatnonzero(anchor[1:] != anchor[:-1]) + 1
                fit = change[change <= COLLECTION]
                cut = int(fit[-1]) if len(fit) else int(change[0]) if len(change) else 0
                if not cut:
                    break
                yield from settle(held.slice(0, cut))
                held = held.slice(cut)
        if held is not None and held.num_rows:
            yield from settle(held)

    dealt = rows.repartition("anchor").sortWithinPartitions("anchor")
    return in_arrow(dealt, run, f"id {kind}, mark int, start long, stop long")


def _counted(rows: DataFrame) -> DataFrame:
    """The same spans for collections too large for one task: windows meet by 128-bit digest, one row each."""
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                rows_of, places, digests = [], [], []
                for i, (text, n, first) in enumerate(zip(part["text"].to_pylist(), part["n_windows"].to_pylist(), part["first"].to_pylist())):
                    view = memoryview(text)
                    digests += [digest(view[j : j + LENGTH]) for j in range(n)]
                    places += range(first, first + n)
                    rows_of += [i] * n
                take = pa.array(rows_of, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part["id"].take(take), part["mark"].take(take), pa.array(places, pa.int64()), pa.array(digests, pa.binary())],
                    names=["id", "mark", "start", "digest"],
                )

    windows = in_arrow(rows.select("id", "mark", "first", "n_windows", "text"), run, f"id {kind}, mark int, start long, digest binary")
    twice = windows.groupBy("digest").agg(F.count("*").alias("n")).where("n > 1").select("digest")
    return windows.join(twice, "digest").select("id", "mark", "start", (F.col("start") + LENGTH).alias("stop"))


def _packed(docs: DataFrame) -> DataFrame:
    """``id, mark, packed``: the texts as compressed UTF-8, for the way through a shuffle."""
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([pack((t.as_py() or "").encode()) for t in batch.column(2)], pa.binary())],
                names=["id", "mark", "packed"],
            )

    return in_arrow(docs, run, f"id {kind}, mark int, packed binary")


def _same_row(a: DataFrame, b: DataFrame):
    return a["id"].eqNullSafe(b["id"]) & (a["mark"] == b["mark"])


def _with_text(wanted: DataFrame, docs: DataFrame) -> DataFrame:
    """``wanted (id, mark, first, n_windows, ...)`` with the bytes of each segment."""
    lists = wanted.groupBy("id", "mark").agg(F.collect_list(F.struct("anchor", "first", "n_windows", "before", "crowded")).alias("parts"))
    docs = _packed(docs)
    joined = docs.join(lists.withColumnsRenamed({"id": "of", "mark": "of_mark"}), docs["id"].eqNullSafe(F.col("of")) & (docs["mark"] == F.col("of_mark")))
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            out: dict[str, list] = {k: [] for k in ("row", "anchor", "first", "n_windows", "before", "crowded", "text")}
            for i, (packed, parts) in enumerate(zip(batch["packed"], batch["parts"])):
                text = unpack(packed.as_py())
                for part in parts.as_py():
                    out["row"].append(i)
                    for k in ("anchor", "first", "n_windows", "before", "crowded"):
                        out[k].append(part[k])
                    out["text"].append(text[part["first"] : part["first"] + part["n_windows"] + LENGTH - 1])
            row = pa.array(out["row"], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch["id"].take(row), batch["mark"].take(row), pa.array(out["anchor"], pa.int64()), pa.array(out["first"], pa.int64()),
                    pa.array(out["n_windows"], pa.int32()), pa.array(out["before"], pa.int32()), pa.array(out["crowded"], pa.bool_()),
                    pa.array(out["text"], pa.binary()),
                ],
                names=["id", "mark", "anchor", "first", "n_windows", "before", "crowded", "text"],
            )

    return in_arrow(
        joined.select("id", "mark", "packed", "parts"), run,
        f"id {kind}, mark int, anchor long, first long, n_windows int, before int, crowded boolean, text binary",
    )


def repeated_spans(docs: DataFrame, collection: int = COLLECTION) -> DataFrame:
    """``id, mark, start, stop`` covering every byte of ``docs (id, mark, text)`` that lies in a repeated string; spans may overlap."""
    found = stored(all_segments(docs), "segments")
    settled = found.where("times = 0")
    found = found.where("times > 0")
    common = found.groupBy("anchor").agg(F.sum("times").alias("n")).where("n > 1").select("anchor")
    met = stored(found.join(common, "anchor", "left_semi"), "met-segments")
    contents = stored(
        met.groupBy("anchor", "content").agg(
            F.sum("times").alias("n"), F.min(F.struct("id", "mark", "first", "n_windows", "before")).alias("one")
        ),
        "contents",
    )
    whole = met.join(contents.where("n > 1").select("anchor", "content"), ["anchor", "content"])
    sizes = contents.groupBy("anchor").agg(F.count("*").alias("size")).where("size > 1")
    differing = contents.join(sizes, "anchor").select("anchor", "one.*", (F.col("size") > collection).alias("crowded"))
    parts = stored(_with_text(differing, docs), "segment-texts")
    spans = whole.union(settled.select(whole.columns)).select("id", "mark", F.col("first").alias("start"), (F.col("first") + F.col("n_windows") + LENGTH - 1).alias("stop"))
    return spans.union(_ordered(parts.where("NOT crowded").drop("crowded"))).union(_counted(parts.where("crowded")))


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", collection: int = COLLECTION) -> DataFrame:
    """``id, n_bytes, n_removed, n_spans, kept`` (remaining bytes) for each row of ``docs``.

    Every byte goes that is covered by a string of ``LENGTH`` bytes which also starts anywhere else, in the same text or another; overlaps
    count, and all strings are judged on the input. A null text is empty. Rows are told apart by key and text, so a repeated row
    repeats (and loses) its whole text, if that is long enough, and a null key does no harm. Other columns play no part.
    An empty table gives an empty result.
    """
    docs = docs.select(F.col(key).alias("id"), F.hash(F.col(text)).alias("mark"), F.col(text).alias("text"))
    spans = repeated_spans(docs, collection)
    lists = spans.groupBy("id", "mark").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    packed = _packed(docs)
    lists = lists.withColumnsRenamed({"id": "of", "mark": "of_mark"})
    joined = packed.join(lists, packed["id"].eqNullSafe(lists["of"]) & (packed["mark"] == lists["of_mark"]), "left")
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            out = []
            for content, parts in zip(batch.column(1), batch.column(2)):
                data, at, runs = unpack(content.as_py()), 0, 0
                kept, reach = [], -1
                for part in sorted((p["start"], p["stop"]) for p in parts.as_py() or ()):
                    if part[0] > reach:
                        kept.append(data[max(reach, 0) : part[0]])
                        runs += 1
                    reach = max(reach, part[1])
                kept.append(data[max(reach, 0) :])
                left = b"".join(kept)
                out.append((len(data), len(data) - len(left), runs, left))
            columns = list(zip(*out)) if out else [(), (), (), ()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.binary())],
                names=["id", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    return in_arrow(joined.select("id", "packed", "spans"), run, f"id {kind}, n_bytes long, n_removed long, n_spans long, kept binary")
