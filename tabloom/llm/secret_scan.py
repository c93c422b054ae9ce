"""Secret scans: keyword automaton, anchored expressions near its hits, embedded checksums.

Each whole text passes once through an Aho-Corasick automaton over keywords (A-Z
folded) and once through one over character classes, where a long run of hex
digits is a keyword of its own. Only at a hit is a regular expression tried, tied
to the hit's place, so a text without hits costs two linear passes and nothing
more. Kinds that carry a checksum of their own count only where it is right:

``assign``, ``access``, ``hex``  a named value, an access key id, a long hex run
``github``, ``npm``  30 characters and their CRC-32 in six base-62 digits
``age``, ``nsec``    Bech32 with its six-character checksum
``xprv``             Base58 with four bytes of a double SHA-256
``pem``              a private key whose DER length field fits its body

Matches of a kind are leftmost and don't overlap; those of different kinds may.
Texts are read in pieces of SLICE characters that overlap by a keyword, so a very
long text needs little more memory than itself.

Defined cases: a null or empty text has no spans; repeated rows are scanned each;
spans that start together come in the order of KINDS; null ids stay null; extra
columns are ignored (``redact`` keeps them); an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import re
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import map_texts, own_columns

BASE = ("assign", "access", "hex")
KINDS = (*BASE, "github", "npm", "age", "nsec", "xprv", "pem")
ORDER = {kind: i for i, kind in enumerate(KINDS)}

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
CRC_TAILED = re.compile(r"(?:gh[pousr]|npm)_([0-9A-Za-z]{30})([0-9A-Za-z]{6})")
AGE = re.compile(r"(AGE-SECRET-KEY-)1([02-9AC-HJ-NP-Z]{58})")
NSEC = re.compile(r"(nsec)1([02-9ac-hj-np-z]{58})")
XPRV = re.compile(r"xprv[1-9A-HJ-NP-Za-km-z]{107}")
PEM = re.compile(r"-----BEGIN ((?:[A-Z0-9]{1,20} ){0,3})PRIVATE KEY-----([A-Za-z0-9+/=\s]+)-----END \1PRIVATE KEY-----")
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 6, 20, 24

# fixed values of the formats
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
BASE58 = "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"
BECH32 = "qpzry9x8gf2tvdw0s3jn54khce6mua7l"
BECH32_GENERATOR = (0x3B6A57B2, 0x26508E6D, 0x1EA119FA, 0x3D4233DD, 0x2A1462B3)

KEYWORDS = {
    "assign": ("password", "passwd", "secret", "token", "api_key", "apikey"), "access": ("akia",),
    "github": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), "npm": ("npm_",), "age": ("age-secret-key-1",),
    "nsec": ("nsec1",), "xprv": ("xprv",), "pem": ("-----begin ",),
}
SLICE = 1 << 20  # characters that one pass of an automaton gets
OVERLAP = 32  # no keyword is longer

# one byte a code point: continuation bytes go, letters are folded or turned into their class
CONTINUATION = bytes(range(0x80, 0xC0))
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c < 0x80 else 0 for c in range(256))
CLASS = bytes(ord("h") if chr(c) in "0123456789abcdef" else 0 for c in range(256))


def crc_fits(body: str, tail: str) -> bool:
    value, digits = zlib.crc32(body.encode()), ""
    for _ in range(6):
        value, rest = divmod(value, 62)
        digits = BASE62[rest] + digits
    return digits == tail


def bech32_fits(prefix: str, data: str) -> bool:
    """The Bech32 checksum: a remainder of a code over 32 symbols is 1."""
    prefix, data = prefix.lower(), data.lower()
    symbols = [ord(c) >> 5 for c in prefix] + [0] + [ord(c) & 31 for c in prefix] + [BECH32.index(c) for c in data]
    rest = 1
    for s in symbols:
        top, rest = rest >> 25, (rest & 0x1FFFFFF) << 5 ^ s
        for i, g in enumerate(BECH32_GENERATOR):
            if top >> i & 1:
                rest ^= g
    return rest == 1


def base58_fits(spelled: str) -> bool:
    number = 0
    for c in spelled:
        number = number * 58 + BASE58.index(c)
    raw = number.to_bytes(max(82, (number.bit_length() + 7) // 8), "big")
    return raw[-4:] == hashlib.sha256(hashlib.sha256(raw[:-4]).digest()).digest()[:4]


def der_fits(body: str) -> bool:
    """The outer sequence's own length field names what follows it."""
    try:
        raw = base64.b64decode("".join(body.split()), validate=True)
    except (binascii.Error, ValueError):
        return False
    if len(raw) < 2 or raw[0] != 0x30:
        return False
    if raw[1] < 0x80:
        return len(raw) == 2 + raw[1]
    wide = raw[1] & 0x7F
    return wide > 0 and len(raw) == 2 + wide + int.from_bytes(raw[2:2 + wide], "big")


# kind -> (expression, whether a match counts, whether a match that doesn't count still takes its place)
RULES: dict[str, tuple[re.Pattern, Callable[[re.Match], bool], bool]] = {
    "assign": (ASSIGN, lambda m: m.end(2) - m.start(2) >= LEAST_VALUE, True),
    "access": (ACCESS, lambda m: m.end() - m.start() >= LEAST_ACCESS, True),
    "hex": (HEX, lambda m: m.end() - m.start() >= LEAST_HEX, True),
    "github": (CRC_TAILED, lambda m: crc_fits(m[1], m[2]), False),
    "npm": (CRC_TAILED, lambda m: crc_fits(m[1], m[2]), False),
    "age": (AGE, lambda m: bech32_fits(m[1], m[2]), False),
    "nsec": (NSEC, lambda m: bech32_fits(m[1], m[2]), False),
    "xprv": (XPRV, lambda m: base58_fits(m[0]), False),
    "pem": (PEM, lambda m: der_fits(m[2]), False),
}


@lru_cache(1)
def automata() -> tuple[ahocorasick.Automaton, ahocorasick.Automaton]:
    """(keywords, classes), built once in each Python worker."""
    words, runs = ahocorasick.Automaton(), ahocorasick.Automaton()
    for kind, names in KEYWORDS.items():
        for name in names:
            words.add_word(name, (kind, len(name)))
    runs.add_word("h" * LEAST_HEX, ("hex", LEAST_HEX))
    words.make_automaton()
    runs.make_automaton()
    return words, runs


def hits(text: str) -> Iterator[tuple[str, int]]:
    """(kind, start) of all keyword hits; those of a kind in order of their start."""
    words, runs = automata()
    body = text.encode()
    for table, find in ((FOLD, words.iter), (CLASS, runs.iter_long)):
        plain = body.translate(table, CONTINUATION).decode("ascii")
        for first in range(0, len(plain), SLICE):
            for end, (kind, length) in find(plain[first: first + SLICE + OVERLAP]):
                if end + 1 - length < SLICE:
                    yield kind, first + end + 1 - length


def find_secrets(text: str | None) -> list[tuple[int, int, str]]:
    """(start, end, kind) in code points, by start, then by the order of KINDS."""
    found, taken = [], dict.fromkeys(KINDS, 0)
    if not text:
        return found
    for kind, start in hits(text):
        if start < taken[kind]:
            continue
        expression, counts, holds = RULES[kind]
        m = expression.match(text, start)
        if m is None:
            continue
        right = counts(m)
        if right or holds:
            taken[kind] = m.end()
        if right:
            found.append((start, m.end(), kind))
    return sorted(found, key=lambda s: (s[0], ORDER[s[2]]))


def blank_out(text: str, spans: list[tuple[int, int, str]]) -> str:
    """``text`` with each stretch of spans replaced by the kind that begins it."""
    parts, at = [], 0
    for start, end, kind in spans:
        if start >= at:
            parts += [text[at:start], f"<{kind}>"]
        at = max(at, end)
    return "".join([*parts, text[at:]])


SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
SPANS_DDL = "array<struct<kind:string,start:bigint,end:bigint>>"


def _span_column(found: list[list[tuple[int, int, str]]]) -> pa.Array:
    offsets, flat = [0], []
    for spans in found:
        flat += spans
        offsets.append(len(flat))
    parts = [pa.array([s[2] for s in flat], pa.string()), pa.array([s[0] for s in flat], pa.int64()),
             pa.array([s[1] for s in flat], pa.int64())]
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(parts, fields=list(SPAN)))


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, spans) of every row; ``spans`` holds (kind, start, end) in order, ends exclusive."""
    rows = own_columns(docs, {"doc_id": "doc_id", "text": "text"})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [find_secrets(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), _span_column(found)], ["doc_id", "spans"])

    return map_texts(rows, run, f"doc_id {dict(rows.dtypes)['doc_id']}, spans {SPANS_DDL}")


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by its kind, as ``<kind>``; null stays null."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_py() for t in batch.column(at)]
            clean = [t and blank_out(t, find_secrets(t)) for t in texts]
            yield batch.set_column(at, batch.schema.field(at), pa.array(clean, batch.schema.field(at).type))

    return map_texts(docs, run, docs.schema)


def spelled(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(found: DataFrame) -> DataFrame:
    """Counts and digests of a scan's rows."""
    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    return found.select("doc_id", *[count(k) for k in BASE], F.sha2(spelled(base), 256).alias("base_sha256"),
                        spelled(F.col("spans")).alias("spans"))
