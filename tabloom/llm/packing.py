"""Cost-balanced packing of tokenised documents into sequences.

A piece of n tokens costs ``n + quadratic * n * n`` (linear layers, attention
within the document). Each task tokenises its documents as a stream and packs
them window by window: documents give whole sequences while they are longer
than one; the rests, in descending cost, go to the cheapest open sequence that
has room, and are cut only when none has. What is left of a window is cut into
power-of-two sequences, which need no padding, so nothing is shuffled and
padding doesn't grow with the number of tasks.

Defined cases: a null or empty text is the end token alone; repeated rows are
packed like any others; documents longer than a window are packed whole; extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import json
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tabloom.llm.common import map_texts, own_columns

LENGTH = 2048
END = 1
WINDOW_TOKENS = 1 << 21
SMALLEST = 64  # rests are cut down to powers of two of this many tokens, and padded below it
QUADRATIC = 1 / LENGTH
CACHE_ENTRIES = 200_000

PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
                    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])
PIECES_DDL = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
              "sequence_id long, offset long")

# a token always starts at a single space between solid characters
_CUT = re.compile(r"(?<=\S) (?=\S)")


class Pieces(dict):
    """Token ids, as little-endian bytes, of text between safe cuts; a worker keeps those it met first."""

    def __init__(self, vocabulary: str, added: tuple[tuple[str, int], ...] = ()) -> None:
        super().__init__()
        self.added = {name: struct.pack("<I", number) for name, number in added}
        names = sorted(self.added, key=len, reverse=True)  # the longest that fits
        self.at_added = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None
        with open(vocabulary, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.bpe = tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def __missing__(self, text: str) -> bytes:
        found = self.bpe.encode_ordinary(text)
        ids = struct.pack(f"<{len(found)}I", *found)
        if len(text) < 64 and len(self) < CACHE_ENTRIES:
            self[text] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Added tokens are found first and never merge with what stands beside them."""
        if self.at_added is None:
            return self.plain(text)
        parts = self.at_added.split(text)
        return b"".join(self.added[p] if k % 2 else self.plain(p) for k, p in enumerate(parts))

    def plain(self, text: str) -> bytes:
        if not text:
            return b""
        if "\0" not in text and " ".join(text.split()) == text.replace("\n", " "):
            # only single spaces and newlines, all between solid characters: cuts are safe at each
            parts = text.replace("\n", "\0\n\0").replace(" ", "\0 ").split("\0")
        else:
            first, *rest = _CUT.split(text)
            parts = [first, *(" " + p for p in rest)]
        return b"".join(map(self.__getitem__, parts))


_loaded: dict[tuple, Pieces] = {}


def pieces_of(vocabulary: str, added: tuple[tuple[str, int], ...] = ()) -> Pieces:
    if (vocabulary, added) not in _loaded:
        _loaded[vocabulary, added] = Pieces(vocabulary, added)
    return _loaded[vocabulary, added]


def added_tokens(tokenizer: str) -> tuple[tuple[str, int], ...]:
    """(text, id) of the tokens that a tokenizer's JSON form finds before any other."""
    with open(tokenizer, encoding="utf-8") as f:
        return tuple((t["content"], t["id"]) for t in json.load(f)["added_tokens"])


def assign(sizes: list[int], length: int, quadratic: float) -> list[tuple[int, int, int, int]]:
    """(document, start, tokens, sequence) of one window; sequences are filled in the order returned.

    Documents are taken by descending cost; each goes to the cheapest sequence
    with room, and is cut over the emptiest ones when none has.
    """
    out: list[tuple[int, int, int, int]] = []
    rests, sequence = [], 0
    for doc, size in enumerate(sizes):
        whole = size // length
        for k in range(whole):
            out.append((doc, k * length, length, sequence + k))
        sequence += whole
        if size % length:
            rests.append((size % length, doc, whole * length))
    if not rests:
        return out
    rests.sort(key=lambda r: (-r[0], r[1]))
    # the last, partial sequences are powers of two: the sizes add up to the tokens left
    left = sum(r[0] for r in rests)
    rooms = [length] * (left // length)
    tail = left % length
    size = length // 2
    while tail >= SMALLEST and size >= SMALLEST:
        if tail >= size:
            rooms.append(size)
            tail -= size
        size //= 2
    if tail:
        rooms.append(tail)
    room = np.array(rooms, np.int64)
    cost = np.where(room == length, 0.0, length * (1 + quadratic * length) * (1 - room / length))  # the short ones fill last
    for tokens, doc, start in rests:
        while tokens:
            fits = room >= tokens
            if fits.any():
                at = int(np.argmin(np.where(fits, cost, np.inf)))
                take = tokens
            else:
                at = int(np.argmax(room))
                take = int(room[at])
            out.append((doc, start, take, sequence + at))
            room[at] -= take
            cost[at] += take + quadratic * take * take
            start, tokens = start + take, tokens - take
    return out


def _pack(vocabulary: str, added: tuple[tuple[str, int], ...], length: int, quadratic: float, window: int, end: int):
    tail = np.array([end], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = pieces_of(vocabulary, added).encode
        serial = TaskContext.get().partitionId() << 33
        names: list[int | None] = []
        bodies: list[bytes] = []
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal serial, held
            sizes = [len(b) // 4 for b in bodies]
            filled: dict[int, int] = {}
            rows = []
            for doc, start, tokens, sequence in assign(sizes, length, quadratic):
                at = filled.get(sequence, 0)
                filled[sequence] = at + tokens
                crc = zlib.crc32(memoryview(bodies[doc])[4 * start: 4 * (start + tokens)])
                rows.append((names[doc], start, tokens, crc, sizes[doc], serial + sequence, at))
            serial += len(filled)
            names.clear()
            bodies.clear()
            held = 0
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], schema=PIECES)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                body = encode(text.as_py() or "") + tail
                names.append(doc_id)
                bodies.append(body)
                held += len(body) // 4
                if held >= window:
                    yield flush()
        if bodies:
            yield flush()

    return run


def pack(docs: DataFrame, vocabulary: str | None = None, tokenizer: str | None = None, length: int = LENGTH,
         quadratic: float = QUADRATIC, window: int = WINDOW_TOKENS, end: int = END) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``vocabulary`` holds byte-pair ranks, ``tokenizer`` is the JSON form of the same vocabulary, which also
    names added tokens: ids are those that it gives without its special tokens around a text.
    """
    vocabulary = vocabulary or public_tokenizers.path("byte_bpe_50k.tiktoken")
    added = added_tokens(tokenizer or public_tokenizers.path("byte_bpe_50k.json"))
    rows = own_columns(docs, {"doc_id": "doc_id", "text": "text"})
    return map_texts(rows, _pack(vocabulary, added, length, quadratic, window, end), PIECES_DDL)
