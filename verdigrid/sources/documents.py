"""Arrays inside single JSON documents, read by many tasks."""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verdigrid.session import ship

RANGE_BYTES = 16 << 20
TASKS_PER_CORE = 16
#: Bytes read at once before or after a range.
STEP = 1 << 16
SUMMARY = "path string, start long, stop long, odd boolean, closes array<int>, opens array<string>"
QUOTE, BACKSLASH, OPEN, CLOSE = b'"'[0], b"\\"[0], b"{[", b"}]"
BLANK = b" \t\r\n"


class _File:
    """Byte ranges of one file."""

    def __init__(self, path: str):
        local = path.removeprefix("file:") if path.startswith("file:") else path
        system, name = fs.FileSystem.from_uri(path) if "://" in local else (fs.LocalFileSystem(), "/" + local.lstrip("/"))
        self.file = system.open_input_file(name)

    def __enter__(self) -> _File:
        return self

    def __exit__(self, *_) -> None:
        self.file.close()

    def read(self, start: int, stop: int) -> bytes:
        return self.file.read_at(stop - start, start)

    def backwards(self, position: int) -> Iterator[bytes]:
        """The single bytes before a position, nearest first."""
        while position > 0:
            block = self.read(max(position - STEP, 0), position)
            position -= len(block)
            yield from (block[i : i + 1] for i in range(len(block) - 1, -1, -1))

    def escaped(self, position: int) -> bool:
        """Whether an odd run of backslashes ends before the position."""
        run = 0
        for byte in self.backwards(position):
            if byte != b"\\":
                break
            run += 1
        return run % 2 == 1

    def follows(self, member: bytes, position: int) -> bool:
        """Whether the value at the position belongs to the member of this name (given in quotes)."""
        left, colon = member[::-1], False
        for byte in self.backwards(position):
            if byte in BLANK and left == member[::-1]:
                continue
            if not colon:
                if byte != b":":
                    return False
                colon = True
            elif left:
                if byte != left[:1]:
                    return False
                left = left[1:]
            else:
                return byte != b"\\"
        return False


class _Marks:
    """Brackets of a piece of JSON outside its strings: place, nesting change, and the nesting reached after each."""

    def __init__(self, data: bytes, escaped: bool, in_string: bool):
        raw = np.frombuffer(data, np.uint8)
        quotes = np.flatnonzero(raw == QUOTE)
        slashes = np.flatnonzero(raw == BACKSLASH)
        if len(slashes) or escaped:
            # a quote counts unless an odd run of backslashes ends before it
            breaks = np.flatnonzero(np.diff(slashes) > 1)
            firsts, lasts = slashes[np.r_[0, breaks + 1]] if len(slashes) else slashes, slashes[np.r_[breaks, -1]] if len(slashes) else slashes
            lengths = lasts - firsts + 1 + ((firsts == 0) & escaped)
            taken = lasts[lengths % 2 == 1] + 1
            if escaped and not (len(firsts) and firsts[0] == 0):
                taken = np.r_[0, taken]
            quotes = np.setdiff1d(quotes, taken, assume_unique=True)
        self.odd = len(quotes) % 2 == 1
        opening, closing = np.isin(raw, np.frombuffer(OPEN, np.uint8)), np.isin(raw, np.frombuffer(CLOSE, np.uint8))
        at = np.flatnonzero(opening | closing)
        outside = (np.searchsorted(quotes, at) + in_string) % 2 == 0
        self.at = at[outside]
        self.opens = opening[self.at]
        self.depth = np.cumsum(np.where(self.opens, 1, -1))
        self.data = data


def _summary(file: _File, path: str, start: int, stop: int, member: bytes) -> dict:
    """What a range does to the nesting, for a start outside (0) and inside (1) a string: levels closed, and what stays open.

    An array that is the value of the wanted member is ``m``, any other bracket is itself.
    """
    data, escaped = file.read(start, stop), file.escaped(start)
    closes, opens = [], []
    for in_string in (False, True):
        marks = _Marks(data, escaped, in_string)
        later = np.minimum.accumulate(marks.depth[::-1])[::-1]
        left = marks.at[marks.opens & (later >= marks.depth)]
        closes.append(int(max(-marks.depth.min(), 0)) if len(marks.depth) else 0)
        opens.append("".join(_opener(file, data, start, int(i), member) for i in left))
    return {"path": path, "start": start, "stop": stop, "odd": marks.odd, "closes": closes, "opens": opens}


def _opener(file: _File, data: bytes, start: int, place: int, member: bytes) -> str:
    mark = chr(data[place])
    return "m" if mark == "[" and file.follows(member, start + place) else mark


def _states(ranges: pd.DataFrame) -> pd.DataFrame:
    """Each range of a file with what is open at its start; a row per range, never the text."""
    ranges = ranges.sort_values("start")
    inside, stack, rows = False, "", []
    for r in ranges.itertuples():
        rows.append((r.path, r.start, r.stop, inside, stack))
        stack = stack[: max(len(stack) - r.closes[int(inside)], 0)] + r.opens[int(inside)]
        inside = inside != bool(r.odd)
    return pd.DataFrame(rows, columns=["path", "start", "stop", "inside", "stack"])


def _elements(file: _File, path: str, start: int, stop: int, inside: bool, stack: str, member: bytes) -> Iterator[str]:
    """The objects of the member's array that begin in the range, as text."""
    data = file.read(start, stop)
    marks = _Marks(data, file.escaped(start), inside)
    depth = marks.depth + len(stack)
    arrays = np.flatnonzero(marks.opens & (depth == 2))
    wanted = [_opener(file, data, start, int(marks.at[i]), member) == "m" for i in arrays]
    before = stack[:2] == "{m"
    closers = np.flatnonzero(~marks.opens & (depth == 2))
    for i in np.flatnonzero(marks.opens & (depth == 3)):
        place = int(marks.at[i])
        array = np.searchsorted(arrays, i) - 1
        if data[place] != OPEN[0] or not (wanted[array] if array >= 0 else before):
            continue
        end = np.searchsorted(closers, i)
        if end < len(closers):
            yield data[place : marks.at[closers[end]] + 1].decode()
        else:
            yield (data[place:] + _rest(file, path, data[place:], stop)).decode()


def _rest(file: _File, path: str, begun: bytes, stop: int) -> bytes:
    """What follows the range up to the end of an object that begins in it."""
    marks = _Marks(begun, False, False)
    open_, inside, parts = int(marks.depth[-1]), marks.odd, []
    while True:
        block = file.read(stop, stop + STEP)
        if not block:
            raise ValueError(f"{path} ends inside an object")
        marks = _Marks(block, file.escaped(stop), inside)
        closed = np.flatnonzero(marks.depth + open_ == 0)
        if len(closed):
            return b"".join([*parts, block[: marks.at[closed[0]] + 1]])
        open_ += int(marks.depth[-1]) if len(marks.depth) else 0
        inside ^= marks.odd
        parts.append(block)
        stop += len(block)


def scan_array(spark: SparkSession, path: str, member: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The objects of one array of each JSON document below ``path``, a row ``value`` of JSON text each.

    A document is one UTF-8 object, and ``member`` names an array of its top level, such as the ``features`` of a feature collection. Documents
    are cut into byte ranges, each read by its own task. A first pass finds, for a start outside and inside a string, what a range closes and
    leaves open; one row per range is carried through each file; the second pass gives every object to the range in which it begins. Nested
    arrays of the same name, brackets in strings and escapes are told apart exactly. Elements that are no objects, and documents without the
    member, give no row; a document that ends inside an object raises. Files are opened through Arrow.
    """
    if range_bytes < 1:
        raise ValueError("ranges hold at least one byte")
    ship(spark)
    name = json.dumps(member, ensure_ascii=False).encode()
    files = spark.read.format("binaryFile").load(path).where("length > 0").select("path", "length")
    cut = files.select("path", "length", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(range_bytes).cast("long"))).alias("start"))
    listed = cut.select("path", "start", F.least(F.col("start") + range_bytes, F.col("length")).alias("stop"))
    # a fixed number of tasks, as rows this short would all be put into one
    tasks = max(min(listed.count(), TASKS_PER_CORE * spark.sparkContext.defaultParallelism), 1)

    def summaries(batches):
        for batch in batches:
            for r in batch.to_pylist():
                with _File(r["path"]) as file:
                    yield pa.RecordBatch.from_pylist([_summary(file, member=name, **r)], SUMMARY_ARROW)

    def elements(batches):
        for batch in batches:
            for r in batch.to_pylist():
                with _File(r["path"]) as file:
                    yield from _batches(_elements(file, member=name, **r))

    states = listed.repartition(tasks).mapInArrow(summaries, SUMMARY).groupBy("path").applyInPandas(
        lambda part: _states(part), "path string, start long, stop long, inside boolean, stack string"
    )
    return states.repartition(tasks).mapInArrow(elements, "value string")


SUMMARY_ARROW = pa.schema(
    [("path", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("odd", pa.bool_()), ("closes", pa.list_(pa.int32())), ("opens", pa.list_(pa.string()))]
)


def _batches(texts: Iterator[str], size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Batches of about ``size`` characters."""
    held, length = [], 0
    for text in texts:
        held.append(text)
        length += len(text)
        if length >= size:
            yield pa.RecordBatch.from_pydict({"value": pa.array(held, pa.string())})
            held, length = [], 0
    if held:
        yield pa.RecordBatch.from_pydict({"value": pa.array(held, pa.string())})
