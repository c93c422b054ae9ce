"""SentencePiece encoding and decoding on a byte automaton.

The pieces of a model form an Aho-Corasick automaton over UTF-8 bytes. A single
pass over a text follows it byte by byte; the output links of each state are the
pieces that end there, and each relaxes the best score of the position. The pass
runs over many stretches of text at once, one byte of each at a time. Stretches
are cut only where no piece of the vocabulary crosses, and a worker remembers
the ones it has met.

The segmentation is the one of the highest sum of the model's piece scores; of
equal sums the one whose last piece is longer, at each position. A character
that no piece covers becomes its bytes (as the model's byte pieces), at the
model's lowest score less 10. Decoding an encoded text gives the same text back.

Defined cases: a null or empty text has no ids; the word mark U+2581 inside a
text is spelled in bytes, so it survives decoding; repeated rows are encoded
alike; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from tabloom.llm.common import own_columns

MARK = "▁"
UNKNOWN_PENALTY = 10.0
CACHE_ENTRIES = 700_000
CACHED_CHARS = 64  # longer stretches are not kept, so the cache is bounded in bytes
LONG_STRETCH = 256  # bytes from which a stretch isn't stepped through with others
BATCH_TEXTS = 2000  # texts whose new stretches are segmented together

_STRETCH = re.compile(r" *[^ \n]+|\n| +")


class Automaton:
    """Goto, depth and output links of the pieces; state 0 is the root."""

    def __init__(self, pieces: dict[bytes, tuple[int, float]]) -> None:
        children: list[dict[int, int]] = [{}]
        depth, ends = [0], {}
        for piece, named in pieces.items():
            state = 0
            for byte in piece:
                step = children[state].get(byte)
                if step is None:
                    step = children[state][byte] = len(children)
                    children.append({})
                    depth.append(depth[state] + 1)
                state = step
            ends[state] = named
        n = len(children)
        self.depth = np.array(depth, np.int64)
        self.piece = np.full(n, -1, np.int32)
        self.score = np.full(n, -np.inf)
        for state, (number, score) in ends.items():
            self.piece[state], self.score[state] = number, score
        self.goto = np.zeros((n, 256), np.int32)
        self.link = np.zeros(n, np.int32)  # the longest piece that is a proper suffix, or 0
        fail = np.zeros(n, np.int32)
        level = [0]
        while level:
            below = []
            for state in level:
                if state:
                    self.goto[state] = self.goto[fail[state]]
                for byte, child in children[state].items():
                    fail[child] = self.goto[fail[state], byte] if state else 0
                    f = fail[child]
                    self.link[child] = f if self.piece[f] >= 0 else self.link[f]
                    below.append(child)
                for byte, child in children[state].items():
                    self.goto[state, byte] = child
            level = below
        # the first output of each state: itself or its link
        self.first = np.where(self.piece >= 0, np.arange(n), self.link).astype(np.int32)
        self._plain: tuple | None = None

    def plain(self) -> tuple:
        """(goto, first, link, depth, piece, score) as flat sequences that a loop reads quickly."""
        if self._plain is None:
            self._plain = (self.goto.reshape(-1).data, *(x.tolist() for x in (self.first, self.link, self.depth, self.piece, self.score)))
        return self._plain


class Codec:
    """Encodes and decodes with one model."""

    def __init__(self, model: str) -> None:
        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        count = sp.get_piece_size()
        names = [sp.id_to_piece(i) for i in range(count)]
        normal = [i for i in range(count) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) or sp.is_byte(i))]
        for i in normal:  # what makes the stretches safe to cut apart
            if MARK in names[i].lstrip(MARK) or "\n" in names[i] or " " in names[i]:
                raise ValueError(f"piece {i} crosses a word mark or line end")
        self.bytes_at = np.zeros(256, np.int32)
        for i in range(count):
            if sp.is_byte(i):
                self.bytes_at[int(names[i][3:5], 16)] = i
        self.automaton = Automaton({names[i].encode(): (i, sp.get_score(i)) for i in normal})
        self.unknown = min(sp.get_score(i) for i in normal) - UNKNOWN_PENALTY
        self.texts = [b""] * count
        for i in normal:
            self.texts[i] = names[i].replace(MARK, " ").encode()
        for value, i in enumerate(self.bytes_at.tolist()):
            self.texts[i] = bytes([value])
        self.known: dict[str, bytes] = {}

    def segment(self, stretches: list[bytes]) -> list[np.ndarray]:
        """Ids of each stretch of bytes: short ones step together, a long one in a loop of its own."""
        short = [i for i, s in enumerate(stretches) if len(s) <= LONG_STRETCH]
        out = [np.zeros(0, np.int32)] * len(stretches)
        for i, ids in zip(short, self.together([stretches[i] for i in short])):
            out[i] = ids
        for i, s in enumerate(stretches):
            if len(s) > LONG_STRETCH:
                out[i] = self.alone(s)
        return out

    def alone(self, stretch: bytes) -> np.ndarray:
        """The ids of one stretch; a few plain steps a byte, whatever its length."""
        goto, first, link, depth, piece, gain = self.automaton.plain()
        spell, unknown, lost = self.bytes_at.tolist(), self.unknown, -np.inf
        best, back, made = [0.0], [0], [0]
        state = begin = 0
        end = len(stretch) - 1
        for t, byte in enumerate(stretch):
            if byte & 0xC0 != 0x80:
                begin = t
            state = goto[state << 8 | byte]
            size = t + 1 - begin  # of the character so far
            score, step, name, own = lost, 1, spell[byte], False
            node = first[state]
            while node:
                n = depth[node]
                found = best[t + 1 - n] + gain[node]
                own = own or n == size
                if found > score:
                    score, step, name = found, n, piece[node]
                node = link[node]
            # the character in bytes, unless a piece is that very character
            if not own and (t == end or stretch[t + 1] & 0xC0 != 0x80) and best[begin] + unknown > score:
                score, step, name = best[begin] + unknown, 1, spell[byte]
            best.append(score)
            back.append(step)
            made.append(name)
        ids, t = [], end + 1
        while t:
            ids.append(made[t])
            t -= back[t]
        return np.array(ids[::-1], np.int32)

    def together(self, stretches: list[bytes]) -> list[np.ndarray]:
        """Ids of each stretch of bytes, all stepped through together."""
        sizes = np.array([len(s) for s in stretches], np.int64)
        order = np.argsort(-sizes, kind="stable")
        sizes = sizes[order]
        body = np.frombuffer(b"".join([stretches[i] for i in order]), np.uint8)
        begins = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
        slots = begins + np.arange(len(sizes))  # a stretch of n bytes has n + 1 positions
        total = len(body) + len(sizes)
        best = np.full(total, -np.inf)
        best[slots] = 0
        back = np.ones(total, np.int32)  # bytes to step back, and the id there
        made = np.zeros(total, np.int32)
        leads = (body & 0xC0) != 0x80
        at = np.arange(len(body))
        char = np.maximum.accumulate(np.where(leads, at, 0))  # where each byte's character begins
        closes = np.ones(len(body), bool)
        closes[:-1] = leads[1:]
        a, state = self.automaton, np.zeros(len(sizes), np.int32)
        live = len(sizes)
        for t in range(int(sizes[0]) if len(sizes) else 0):
            while live and sizes[live - 1] <= t:
                live -= 1
            here, slot = begins[:live] + t, slots[:live] + t + 1
            state = a.goto[state[:live], body[here]]
            made[slot] = self.bytes_at[body[here]]
            whole = closes[here]
            alone = here - char[here] + 1
            # the character in bytes, unless a piece is that very character
            top = np.where(whole, best[slot - alone] + self.unknown, -np.inf)
            step = np.ones(live, np.int32)
            named = made[slot]
            node = a.first[state]
            rows = np.flatnonzero(node)
            single = np.zeros(live, bool)
            score = np.full(live, -np.inf)
            while len(rows):
                n = node[rows]
                length = a.depth[n]
                found = best[slot[rows] - length] + a.score[n]
                single[rows] |= length == alone[rows]
                better = found > score[rows]
                hit = rows[better]
                score[hit], step[hit], named[hit] = found[better], length[better], a.piece[n[better]]
                node[rows] = a.link[n]
                rows = rows[node[rows] > 0]
            spelled = whole & ~single & (top > score)
            best[slot] = np.where(spelled, top, score)
            taken = ~spelled & (score > -np.inf)
            back[slot[taken]], made[slot[taken]] = step[taken], named[taken]
        return self._trace(order, sizes, slots, back, made)

    @staticmethod
    def _trace(order, sizes, slots, back, made) -> list[np.ndarray]:
        rows = np.arange(len(sizes))
        left = sizes.copy()
        who, ids = [], []
        while len(rows):
            slot = slots[rows] + left[rows]
            who.append(rows)
            ids.append(made[slot])
            left[rows] -= back[slot]
            rows = rows[left[rows] > 0]
        out: list[np.ndarray] = [np.zeros(0, np.int32)] * len(sizes)
        if not who:
            return out
        who, ids = np.concatenate(who[::-1]), np.concatenate(ids[::-1])
        by = np.argsort(who, kind="stable")
        cuts = np.searchsorted(who[by], np.arange(len(sizes) + 1))
        ids = ids[by]
        for k, i in enumerate(order.tolist()):
            out[i] = ids[cuts[k]: cuts[k + 1]]
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        split = [_STRETCH.findall(" " + t) if t else [] for t in texts]
        known, passing = self.known, {}
        fresh = list(set().union(*split) - known.keys()) if split else []
        if fresh:
            # a mark in the text itself is no word mark: it is passed as a byte that no text or piece holds
            mark = MARK.encode()
            bodies = [s.encode().replace(mark, b"\xff").replace(b" ", mark) for s in fresh]
            room = len(known) + len(fresh) <= CACHE_ENTRIES
            for s, ids in zip(fresh, self.segment(bodies)):
                keep = known if room and len(s) <= CACHED_CHARS else passing
                keep[s] = self._marks(ids).tobytes() if MARK in s else ids.astype("<i4", copy=False).tobytes()
        if not passing:
            return [b"".join([known[s] for s in stretches]) for stretches in split]
        return [b"".join([known.get(s) or passing[s] for s in stretches]) for stretches in split]

    def _marks(self, ids: np.ndarray) -> np.ndarray:
        """Stand-ins for U+2581 become its bytes."""
        stands = ids == self.bytes_at[0xFF]
        spelled = np.where(stands[:, None], self.bytes_at[list(MARK.encode())], ids[:, None])
        used = np.ones_like(spelled, bool)
        used[~stands, 1:] = False
        return spelled[used].astype("<i4")

    def decode(self, ids: bytes) -> str:
        texts = self.texts
        whole = b"".join([texts[i] for i in np.frombuffer(ids, "<i4").tolist()])
        return whole[1:].decode() if whole else ""


_loaded: dict[str, Codec] = {}


def codec_of(model: str) -> Codec:
    if model not in _loaded:
        _loaded[model] = Codec(model)
    return _loaded[model]


ENCODED = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32())),
                     ("ids_crc32", pa.int64()), ("round_trip", pa.bool_())])
ENCODED_DDL = "doc_id long, n_tokens long, ids array<int>, ids_crc32 long, round_trip boolean"


def _encode(model: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(model)
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH_TEXTS):
                batch = whole.slice(at, BATCH_TEXTS)
                texts = [t or "" for t in batch.column(1).to_pylist()]
                found = codec.encode(texts)
                sizes = np.array([len(b) // 4 for b in found], np.int64)
                cuts = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
                ids = pa.ListArray.from_arrays(cuts, pa.array(np.frombuffer(b"".join(found), "<i4")))
                same = [codec.decode(b) == t for b, t in zip(found, texts)]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes), ids,
                                                  pa.array([zlib.crc32(b) for b in found], pa.int64()), pa.array(same)],
                                                 schema=ENCODED)

    return run


def encode(docs: DataFrame, model: str | None = None) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids, their CRC-32, and whether they decode to the same text."""
    model = model or public_tokenizers.path("piece_bpe_32k.model")
    return own_columns(docs, {"doc_id": "doc_id", "text": "text"}).mapInArrow(_encode(model), ENCODED_DDL)


def decode(encoded: DataFrame, model: str | None = None) -> DataFrame:
    """doc_id and text of rows with ``ids``."""
    model = model or public_tokenizers.path("piece_bpe_32k.model")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(model)
        for batch in batches:
            texts = [codec.decode(np.array(ids or [], "<i4").tobytes()) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
