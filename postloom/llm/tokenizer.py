"""Encoding with a public byte-level BPE vocabulary, without regular expressions.

Pre-tokenisation: every code point gets a class from one array look-up; the classes drive a small automaton.
The automaton runs as an associative scan: the transition functions of equal blocks of text are composed side
by side in numpy, the block summaries give each block its entry state, and a second pass marks the positions
at which a token begins. The slices between them go through cached pair merging. The places of the slices are
kept beside the ids where asked for, and ids are decoded back to texts.

The vocabulary is read once where the query is planned and travels to the workers with it (a table of fixed
size, about a megabyte); executors need no file.

Defined results: NULL and empty texts have no ids (an empty list); every other text, blank ones included,
round-trips: the bytes of its ids are the bytes of the text. Long texts are encoded whole. NULL ids decode to NULL,
an empty list to the empty text; an id that is not in the vocabulary is an error; bytes that are no text (a list
cut inside a character) become U+FFFD.
"""

from __future__ import annotations

import base64
import heapq
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postloom.runtime import spread

#: Default place of the vocabulary; a parameter of every operator here.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Tokens a worker remembers with their ids.
CACHE = 500_000

# Classes: letter, digit, other, apostrophe with a one- or two-letter ending behind it, blank directly before a
# token, other white space directly before a token, other white space, end of a text.
L, N, O, A1, A2, BLANK, SPACE, MORE, END = range(9)
# States: nothing open, in letters, in digits, in others, after a blank, ending of one letter, of two, in white space.
NONE, IN_L, IN_N, IN_O, PREFIX, TAKE1, TAKE2, IN_SPACE = range(8)


def _automaton() -> tuple[np.ndarray, np.ndarray]:
    """next[class, state] and begins[class, state]."""
    step, begins = np.zeros((9, 8), np.int8), np.ones((9, 8), bool)
    for cls, inside in ((L, IN_L), (N, IN_N), (O, IN_O)):
        step[cls, :] = inside
        begins[cls, [inside, PREFIX]] = False
    for cls, take in ((A1, TAKE1), (A2, TAKE2)):
        step[cls, :] = take
        step[cls, [IN_O, PREFIX]] = IN_O
        begins[cls, [IN_O, PREFIX]] = False
    step[BLANK, :], step[SPACE, :], step[MORE, :], step[END, :] = PREFIX, NONE, IN_SPACE, NONE
    begins[MORE, IN_SPACE] = False
    for cls in (L,):  # the letters of an ending belong to its apostrophe
        step[cls, TAKE2], step[cls, TAKE1] = TAKE1, NONE
        begins[cls, [TAKE1, TAKE2]] = False
    return step, begins


STEP, BEGINS = _automaton()


@lru_cache(1)
def codepoint_classes() -> np.ndarray:
    """L, N, O or MORE (white space) of every code point."""
    out = np.full(0x110000, O, np.int8)
    for i in range(0x110000):
        kind = unicodedata.category(chr(i))[0]
        if kind == "L":
            out[i] = L
        elif kind == "N":
            out[i] = N
    out[[9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]] = MORE
    return out


def _classes(points: np.ndarray, ends: np.ndarray) -> np.ndarray:
    cls = codepoint_classes()[points]
    cls[ends] = END
    space = cls == MORE
    before_token = space & np.append(~space[1:] & (cls[1:] != END), False)
    cls[before_token] = SPACE
    cls[before_token & (points == 32)] = BLANK
    at = np.flatnonzero(points[:-2] == 39) if len(points) > 2 else np.empty(0, np.int64)
    if len(at):
        one, two = points[at + 1], points[at + 2]
        cls[at[np.isin(one, [ord(c) for c in "stmd"])]] = A1
        pair = ((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
        cls[at[pair]] = A2
    return cls


def scan_begins(cls: np.ndarray, blocks: int = 1024) -> np.ndarray:
    """Where tokens begin, by composing the transition functions of equal blocks."""
    n = len(cls)
    if not n:
        return np.zeros(0, bool)
    blocks = min(blocks, n)
    width = -(-n // blocks)
    padded = np.full(blocks * width, END, np.int8)
    padded[:n] = cls
    columns = np.ascontiguousarray(padded.reshape(blocks, width).T)
    function = np.tile(np.arange(8, dtype=np.int8), (blocks, 1))
    for column in columns:
        function = STEP[column[:, None], function]
    entry, state = np.empty(blocks, np.int8), NONE
    for b in range(blocks):
        entry[b], state = state, function[b, state]
    out = np.empty((width, blocks), bool)
    for j, column in enumerate(columns):
        out[j] = BEGINS[column, entry]
        entry = STEP[column, entry]
    return out.T.reshape(-1)[:n]


def boundaries(texts: list[str]) -> list[list[int]]:
    """For each text the positions at which its tokens begin, and its length."""
    lengths = np.array([len(t) for t in texts], np.int64)
    points = np.frombuffer("\0".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum(lengths + 1) - 1
    begins = scan_begins(_classes(points, ends))
    begins[ends] = True
    at = np.flatnonzero(begins)
    cuts = np.searchsorted(at, ends)
    starts, out, low = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else [], [], 0
    for start, high in zip(starts, cuts):
        out.append((at[low : high + 1] - start).tolist())
        low = high + 1
    return out


class Encoder:
    """Cached pair merging over the slices of the pre-tokeniser."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks, self.cache = ranks, {}
        self.bytes_of = {i: b for b, i in ranks.items()}

    @classmethod
    def load(cls, path: str) -> Encoder:
        with open(path, "rb") as f:
            return cls({base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())})

    def merge(self, piece: bytes) -> tuple[int, ...]:
        """Ids of one slice: the pair of least rank is merged first, the leftmost of equals; n log n in its length."""
        ranks = self.ranks
        if piece in ranks:
            return (ranks[piece],)
        n = len(piece)
        end = list(range(1, n + 1))  # part i is piece[i:end[i]]; -1 once merged into its left neighbour
        left = list(range(-1, n - 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            if end[i] < 0 or end[i] >= n or end[end[i]] != stop:
                continue
            j = end[i]
            end[i], end[j] = stop, -1
            if stop < n:
                left[stop] = i
                if (r := ranks.get(piece[i : end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            if (k := left[i]) >= 0 and (r := ranks.get(piece[k:stop])) is not None:
                heapq.heappush(heap, (r, k, stop))
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i : end[i]]])
            i = end[i]
        return tuple(out)

    def encode_batch(self, texts: list[str], places: list[list[int]] | None = None) -> list[list[int]]:
        """Ids of each text; ``places`` gets, for each text, the position (from 1) of the slice each id lies in."""
        cache, out = self.cache, []
        for text, at in zip(texts, boundaries(texts)):
            ids: list[int] = []
            starts: list[int] = []
            for a, b in zip(at, at[1:]):
                piece = text[a:b]
                known = cache.get(piece)
                if known is None:
                    known = self.merge(piece.encode("utf-8", "surrogatepass"))
                    if len(cache) >= CACHE:
                        cache.clear()
                    cache[piece] = known
                ids += known
                if places is not None:
                    starts += [a + 1] * len(known)
            out.append(ids)
            if places is not None:
                places.append(starts)
        return out

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(self.bytes_of[i] for i in ids)


@lru_cache(4)
def encoder(path: str) -> Encoder:
    return Encoder.load(path)


#: Characters that go through the scan together.
BATCH_CHARS = 2_000_000


def _batched(texts: list[str | None]) -> Iterator[list[str]]:
    part, held = [], 0
    for t in texts:
        part.append(t or "")
        held += len(part[-1])
        if held > BATCH_CHARS:
            yield part
            part, held = [], 0
    yield part


_SENT: dict[tuple[str, str], Broadcast] = {}
_ENCODERS: dict[int, Encoder] = {}


def _sent(spark: SparkSession, path: str) -> Broadcast:
    """The table of ranks as a broadcast of this session; its size is that of the vocabulary, whatever the data."""
    at = (spark.sparkContext.applicationId, path)
    if at not in _SENT:
        _SENT[at] = spark.sparkContext.broadcast(encoder(path).ranks)
    return _SENT[at]


def _received(ranks: Broadcast) -> Encoder:
    """The encoder of a worker, made once."""
    key = hash((id(ranks.value), len(ranks.value)))
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(ranks.value)
    return _ENCODERS[key]


def _encode(ranks: Broadcast, what: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _received(ranks)
        for batch in batches:
            low = 0
            for part in _batched(batch.column(1).to_pylist()):
                places: list[list[int]] | None = [] if what == "places" else None
                ids = enc.encode_batch(part, places)
                keys = batch.column(0).slice(low, len(part))
                low += len(part)
                if what == "counts":
                    yield pa.RecordBatch.from_arrays([keys, pa.array([len(x) for x in ids], pa.int64())], ["_key", "_value"])
                    continue
                columns = [pa.array(x, pa.list_(pa.int32())) for x in ([ids] if places is None else [ids, places])]
                yield pa.RecordBatch.from_arrays([keys, *columns], ["_key", "_value", "_places"][: 1 + len(columns)])

    return run


def _coded(df: DataFrame, key: str, text: str, vocabulary: str, what: str, schema: str) -> DataFrame:
    kind = df.schema[key].dataType.simpleString()
    return spread(df.select(F.col(key), F.col(text))).mapInArrow(_encode(_sent(df.sparkSession, vocabulary), what), f"_key {kind}, {schema}")


def encode_texts(df: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """(key, ids) of every row of df; one narrow pass, no shuffle."""
    return _coded(df, key, text, vocabulary, "ids", "_value array<int>").select(F.col("_key").alias(key), F.col("_value").alias("ids"))


def encode_with_places(df: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """(key, ids, places): as ``encode_texts``, with the position (from 1) of the slice of the text in which each id lies."""
    out = _coded(df, key, text, vocabulary, "places", "_value array<int>, _places array<int>")
    return out.select(F.col("_key").alias(key), F.col("_value").alias("ids"), F.col("_places").alias("places"))


def count_tokens(df: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """(key, n_tokens) of every row of df."""
    return _coded(df, key, text, vocabulary, "counts", "_value bigint").select(F.col("_key").alias(key), F.col("_value").alias("n_tokens"))


def _decode(ranks: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _received(ranks)
        for batch in batches:
            texts = [None if ids is None else enc.decode(ids).decode("utf-8", "replace") for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["_key", "_value"])

    return run


def decode_ids(df: DataFrame, key: str = "doc_id", ids: str = "ids", vocabulary: str = VOCABULARY) -> DataFrame:
    """(key, text) of every row of df: the texts its ids stand for."""
    kind = df.schema[key].dataType.simpleString()
    out = df.select(F.col(key), F.col(ids)).mapInArrow(_decode(_sent(df.sparkSession, vocabulary)), f"_key {kind}, _value string")
    return out.select(F.col("_key").alias(key), F.col("_value").alias("text"))
