"""Byte-pair encoding and decoding with a public vocabulary file."""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verdigrid.llm.common import in_arrow

#: Words of at most so many parts keep their ranks in one array; longer ones use a heap. Same result.
SHORT = 96
#: Words that a worker remembers, and the length up to which it does.
REMEMBERED, REMEMBERED_LENGTH = 200_000, 48
#: Texts are cut at white space into pieces of about so many characters.
PIECE = 1 << 20
_NONE = 1 << 60


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself if printable, else the next one from 256 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    free = iter(range(256, 512))
    return [chr(b if b in shown else next(free)) for b in range(256)]


# Where the tables of the tokenizers library differ from those of this Python and its ``regex``, found by trying every code point.
#: Code points that ``regex`` takes for letters or numbers and the library does not.
NO_LETTERS = (
    (0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC), (0x208F, 0x208F), (0x209D, 0x209F),
    (0xA7CE, 0xA7CF), (0xA7DD, 0xA7DD), (0xA7E2, 0xA7E2), (0xA7F1, 0xA7F1), (0xAB6C, 0xAB6D), (0x107BB, 0x107BF), (0x10940, 0x10959),
    (0x10EC5, 0x10EC7), (0x10ED9, 0x10EEE), (0x11B0A, 0x11B0A), (0x11DB0, 0x11DDB), (0x11DF1, 0x11DF1), (0x16EA0, 0x16EB8), (0x16EBB, 0x16ED3),
    (0x16FF2, 0x16FF3), (0x187F8, 0x187FF), (0x18CD6, 0x18CDA), (0x18D09, 0x18D20), (0x18D80, 0x18DF2), (0x18E00, 0x19191), (0x191A0, 0x191D2),
    (0x1B123, 0x1B128), (0x1B168, 0x1B168), (0x1D6A6, 0x1D6A6), (0x1DF1F, 0x1DF24), (0x1DF2B, 0x1DF81), (0x1DF90, 0x1DF96), (0x1DFCD, 0x1DFFF),
    (0x1E6C0, 0x1E6DE), (0x1E6E0, 0x1E6E2), (0x1E6E4, 0x1E6E5), (0x1E6E7, 0x1E6ED), (0x1E6F0, 0x1E6F4), (0x1E6FE, 0x1E6FF), (0x2B73A, 0x2B73F),
    (0x2B81E, 0x2B81E), (0x2CEA2, 0x2CEAD), (0x323B0, 0x33479), (0x3D000, 0x3FC3F),
)
#: Upper-case letters that the library lower-cases and Python does not yet, with their lower case; the last two are runs of letters at one distance.
LOWER_CASE = {0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B}
LOWER_CASE |= {c: c + 0x20 for c in range(0x10D50, 0x10D66)} | {c: c + 0x1B for c in range(0x16EA0, 0x16EB9)}


def one_of(ranges) -> regex.Pattern:
    return regex.compile("[" + "".join(rf"\U{a:08X}-\U{b:08X}" for a, b in ranges) + "]")


class WordBpe:
    """Encoder of a vocabulary whose words end in a suffix: lower case, white space dropped."""

    def __init__(self, data: bytes):
        spec = json.loads(data)
        model = spec["model"]
        vocab, suffix = dict(model["vocab"]), model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.rank = {(vocab[a], vocab[b]): i for i, (a, b) in enumerate(pairs)}
        self.merged = [vocab[a + b] for a, b in pairs]
        symbols = byte_symbols()
        self.inner = [vocab[s] for s in symbols]
        self.last = [vocab[s + suffix] for s in symbols]
        splitter = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.split = regex.compile(splitter)
        self.no_letter, self.odd = one_of(NO_LETTERS), one_of([*NO_LETTERS, *((c, c) for c in LOWER_CASE)])
        self.marks = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self.high = regex.compile(rf"[\U{NO_LETTERS[0][0]:08X}-\U0010FFFF]").search
        self.known: dict[str, bytes] = {}

    def words(self, text: str) -> list[str]:
        """The words of a lower-cased text, by the letters and numbers that the library knows."""
        if not self.high(text) or not self.odd.search(text):
            return self.split.findall(text)
        text = text.translate(LOWER_CASE)
        return [text[m.start() : m.end()] for m in self.split.finditer(self.no_letter.sub("\uffff", text))]

    def encode_word(self, word: str) -> list[int]:
        raw = word.encode()
        parts = [self.inner[b] for b in raw[:-1]]
        parts.append(self.last[raw[-1]])
        return self._scan(parts) if len(parts) <= SHORT else self._heap(parts)

    def _scan(self, parts: list[int]) -> list[int]:
        """Merge within one contiguous array: find the least rank, delete its boundary, renew the two neighbours."""
        rank = self.rank.get
        ranks = [rank(pair, _NONE) for pair in zip(parts, parts[1:])]
        while ranks:
            least = min(ranks)
            if least == _NONE:
                break
            at = ranks.index(least)
            parts[at] = self.merged[least]
            del parts[at + 1], ranks[at]
            if at:
                ranks[at - 1] = rank((parts[at - 1], parts[at]), _NONE)
            if at < len(ranks):
                ranks[at] = rank((parts[at], parts[at + 1]), _NONE)
        return parts

    def _heap(self, parts: list[int]) -> list[int]:
        """The same merges for long words, in time n log n."""
        n, rank = len(parts), self.rank.get
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1) if (r := rank((parts[i], parts[i + 1]))) is not None]
        heapq.heapify(heap)

        def offer(i: int, j: int) -> None:
            if i >= 0 and j < n and (r := rank((parts[i], parts[j]))) is not None:
                heapq.heappush(heap, (r, i, parts[i], parts[j]))

        while heap:
            r, i, left, right = heapq.heappop(heap)
            j = after[i]
            if parts[i] != left or j >= n or parts[j] != right:
                continue
            parts[i], parts[j], after[i] = self.merged[r], -1, after[j]
            if after[j] < n:
                before[after[j]] = i
            offer(before[i], i)
            offer(i, after[i])
        return [p for p in parts if p >= 0]

    def _packed(self, word: str) -> bytes:
        ids = self.encode_word(word)
        packed = b"".join([i.to_bytes(4, "little") for i in ids])
        if len(word) <= REMEMBERED_LENGTH:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            self.known[word] = packed
        return packed

    def encode(self, text: str | None) -> bytes:
        """Token ids of the whole text as little-endian unsigned 32-bit integers."""
        out: list[bytes] = []
        known, get = self.known, self.known.get
        for part in self.marks.split(text or ""):
            if part in self.special:
                out.append(self.special[part].to_bytes(4, "little"))
                continue
            for piece in pieces(part):
                # lower case of each character by itself, so no final sigma
                plain = unicodedata.normalize("NFC", piece).replace("Σ", "σ").lower()
                out += [get(w) or self._packed(w) for w in self.words(plain)]
        return b"".join(out)


class WordTokens:
    """Decoder: the bytes of each token."""

    def __init__(self, data: bytes):
        spec = json.loads(data)
        numbered = [*spec["model"]["vocab"].items(), *((t["content"], t["id"]) for t in spec["added_tokens"])]
        self.tokens = [b""] * (max(number for _, number in numbered) + 1)
        for token, number in numbered:
            self.tokens[number] = token.encode()

    def decode(self, packed: bytes) -> str:
        """The tokens of the ids, joined by spaces: the file names no decoder."""
        tokens, out = self.tokens, []
        for at in range(0, len(packed), 4 * PIECE):
            ids = memoryview(packed[at : at + 4 * PIECE]).cast("I")
            out.append(b" ".join([tokens[i] for i in ids]))
        return b" ".join(out).decode()


def pieces(text: str) -> Iterator[str]:
    """Cut at ASCII spaces or line ends; no word crosses them."""
    at, n = 0, len(text)
    while n - at > PIECE:
        cut = text.find(" ", at + PIECE)
        line = text.find("\n", at + PIECE, cut if cut >= 0 else n)
        cut = line if line >= 0 else cut
        if cut < 0:
            break
        yield text[at:cut]
        at = cut
    yield text[at:]


_LOADED: dict[type, tuple[bytes, WordBpe | WordTokens]] = {}


def loaded(kind: type, data: bytes) -> WordBpe | WordTokens:
    """The encoder or decoder, built once in each Python worker; of each kind a worker keeps only the last one."""
    digest = hashlib.sha256(data).digest()
    if kind not in _LOADED or _LOADED[kind][0] != digest:
        _LOADED[kind] = digest, kind(data)
    return _LOADED[kind][1]


def _file(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids", count: str = "n_tokens") -> DataFrame:
    """``docs`` with ``ids`` (binary: little-endian unsigned 32-bit integers) and their number.

    Every whole text is encoded; a null text counts as empty and gives no ids. The strings of special tokens become
    those tokens, as in the tokenizers library. Columns of ``docs`` named like the new ones are replaced. The
    vocabulary file is read by the driver and broadcast; its size is fixed. No shuffle.
    """
    docs = docs.drop(*[c for c in docs.columns if c.lower() in (ids.lower(), count.lower())])
    data = docs.sparkSession.sparkContext.broadcast(_file(path))
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = loaded(WordBpe, data.value)
        for batch in batches:
            packed = [model.encode(t.as_py()) for t in batch.column(at)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(packed, pa.binary()), pa.array([len(p) // 4 for p in packed], pa.int64())],
                names=[*batch.schema.names, ids, count],
            )

    schema = T.StructType([*docs.schema.fields, T.StructField(ids, T.BinaryType()), T.StructField(count, T.LongType())])
    return in_arrow(docs, run, schema)


def decode(encoded: DataFrame, path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``encoded`` with the text of its ids; null ids count as none. A column named ``decoded`` is replaced."""
    encoded = encoded.drop(*[c for c in encoded.columns if c.lower() == decoded.lower()])
    data = encoded.sparkSession.sparkContext.broadcast(_file(path))
    at = encoded.columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = loaded(WordTokens, data.value)
        for batch in batches:
            texts = [model.decode(p.as_py() or b"") for p in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, decoded])

    return in_arrow(encoded, run, T.StructType([*encoded.schema.fields, T.StructField(decoded, T.StringType())]))


def digests(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every document."""
    done = decode(encode(docs.select("doc_id", "text"), path).drop("text"), path)
    return done.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
