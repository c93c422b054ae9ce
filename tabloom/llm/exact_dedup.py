"""Exact duplicates by Grace hash partitioning.

Texts are equal when the same bytes remain after ASCII white space is deleted.
Each task first folds its own copies (so a text that fills a third of the corpus
leaves a task once), then contents are dealt by hash into buckets, and each
bucket is read as a stream into an open-addressing table that compares complete
contents. A bucket that outgrows its table passes what didn't fit, copies and
all, to the next level, which deals by another hash into more buckets.

Defined cases: a null text is the empty text; all empty and white-space texts
are one group; repeated rows (same id and text) are copies like any other, and
of full ties one row stays; null ids lose ties; extra columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import IS_BLANK, keyed, own_columns, salted_join, stored, text_slices

TARGET_BYTES = 32 << 20  # of texts dealt to a bucket
TABLE_BYTES = 128 << 20  # of distinct contents that a bucket's table may hold
FOLD_BYTES = 24 << 20  # of distinct contents folded in a task before they are sent

CONTENTS = pa.schema([("hash", pa.int64()), ("content", pa.binary()), ("copies", pa.int64()),
                      ("chars", pa.int64()), ("row_key", pa.int64())])
CONTENTS_DDL = "hash long, content binary, copies long, chars long, row_key long"
GROUPS = pa.schema([("sha", pa.binary()), *CONTENTS])
GROUPS_DDL = f"sha binary, {CONTENTS_DDL}"
ROWS = pa.schema([("row_key", pa.int64()), ("sha", pa.binary())])


class ContentTable:
    """Open addressing with linear probing; equal means equal bytes, not equal hashes."""

    def __init__(self, limit: int) -> None:
        self.limit, self.held = limit, 0
        self.slots = [-1] * 1024
        self.hashes: list[int] = []
        self.contents: list[bytes] = []
        self.copies: list[int] = []
        self.best: list[tuple[int, int]] = []  # most characters, then smallest key (negated)

    def _grow(self) -> None:
        mask = 2 * len(self.slots) - 1
        self.slots = [-1] * (mask + 1)
        for entry, h in enumerate(self.hashes):
            at = h & mask
            while self.slots[at] >= 0:
                at = (at + 1) & mask
            self.slots[at] = entry

    def add(self, h: int, content: bytes, copies: int, chars: int, row_key: int) -> bool:
        """False if the content is new and the table is full."""
        mask = len(self.slots) - 1
        at = h & mask
        while (entry := self.slots[at]) >= 0:
            if self.hashes[entry] == h and self.contents[entry] == content:
                self.copies[entry] += copies
                self.best[entry] = max(self.best[entry], (chars, -row_key))
                return True
            at = (at + 1) & mask
        if self.contents and self.held + len(content) > self.limit:
            return False
        self.slots[at] = len(self.contents)
        self.hashes.append(h)
        self.contents.append(content)
        self.copies.append(copies)
        self.best.append((chars, -row_key))
        self.held += len(content) + 64
        if 2 * len(self.contents) > len(self.slots):
            self._grow()
        return True

    def arrays(self, first: int, last: int) -> list[pa.Array]:
        best = self.best[first:last]
        return [pa.array(np.array(self.hashes[first:last], np.uint64).view(np.int64)),
                pa.array(self.contents[first:last], pa.binary()), pa.array(self.copies[first:last], pa.int64()),
                pa.array([c for c, _ in best], pa.int64()), pa.array([-k for _, k in best], pa.int64())]


def _contents(batch: pa.RecordBatch) -> Iterator[tuple[int, bytes, int]]:
    """(row, text without white space, characters of the whole text) of a batch."""
    for first, data, offsets in text_slices(batch):
        solid = ~IS_BLANK[data]
        ends = np.zeros(len(data) + 1, np.int64)
        np.cumsum(solid, out=ends[1:])
        points = np.zeros(len(data) + 1, np.int64)
        np.cumsum((data & 0xC0) != 0x80, out=points[1:])
        body, cuts, chars = data[solid].tobytes(), ends[offsets], np.diff(points[offsets])
        for i in range(len(offsets) - 1):
            yield first + i, body[cuts[i]: cuts[i + 1]], int(chars[i])


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct contents of a task, each once for FOLD_BYTES of them."""
    seen = ContentTable(FOLD_BYTES)

    def flush():
        for at in range(0, len(seen.contents), 2000):
            yield pa.RecordBatch.from_arrays(seen.arrays(at, at + 2000), schema=CONTENTS)

    for batch in batches:
        keys = batch.column(0).to_pylist()
        for row, content, chars in _contents(batch):
            h = xxhash.xxh3_64_intdigest(content)
            if not seen.add(h, content, 1, chars, keys[row]):
                yield from flush()
                seen = ContentTable(FOLD_BYTES)
                seen.add(h, content, 1, chars, keys[row])
    yield from flush()


def _compare(limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A bucket: its groups without contents, then what its table had no room for."""
        seen = ContentTable(limit)
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            columns[0] = batch.column(0).to_numpy().view(np.uint64).tolist()
            over = [i for i, record in enumerate(zip(*columns)) if not seen.add(*record)]
            if over:
                rest = batch.take(pa.array(over))
                yield pa.RecordBatch.from_arrays([pa.nulls(len(over), pa.binary()), *rest.columns], schema=GROUPS)
        for at in range(0, len(seen.contents), 10_000):
            found = seen.arrays(at, at + 10_000)
            shas = pa.array([hashlib.sha256(c).digest() for c in seen.contents[at: at + 10_000]], pa.binary())
            found[1] = pa.nulls(len(shas), pa.binary())
            yield pa.RecordBatch.from_arrays([shas, *found], schema=GROUPS)

    return run


def _names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        shas = [hashlib.sha256(content).digest() for _, content, _ in _contents(batch)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shas, pa.binary())], schema=ROWS)


def content_groups(rows: DataFrame, target_bytes: int = TARGET_BYTES, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """(sha, copies, row_key) of each distinct content of ``rows`` (row_key, text); row_key is the row that stays."""
    size = rows.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    buckets, level, done = max(1, -(-size // target_bytes)), 0, []
    rest = rows.select("row_key", "text").mapInArrow(_fold, CONTENTS_DDL)
    while rest is not None:
        dealt = rest.repartition(buckets, F.xxhash64("hash", F.lit(level)))
        out = stored(dealt.mapInArrow(_compare(table_bytes), GROUPS_DDL), "groups")
        done.append(out.filter("sha is not null").select("sha", "copies", "row_key"))
        over = out.filter("sha is null").drop("sha")
        size = over.agg(F.sum(F.octet_length("content"))).head()[0]
        rest = over if size is not None else None
        level, buckets = level + 1, max(2, -(-(size or 0) // target_bytes))
    groups = done[0]
    for more in done[1:]:
        groups = groups.unionByName(more)
    return groups


def exact_dedup(docs: DataFrame, target_bytes: int = TARGET_BYTES, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the most code points stays, then the smallest id.
    """
    rows = keyed(own_columns(docs, {"doc_id": "doc_id", "text": "text"}))
    groups = content_groups(rows, target_bytes, table_bytes)
    names = rows.select("row_key", "text").mapInArrow(_names, "row_key long, sha binary")
    groups = stored(groups.withColumnRenamed("row_key", "keep"), "kept")
    return _answer(rows, salted_join(names, groups, ["sha"], "copies", "row_key"))


def _answer(rows: DataFrame, met: DataFrame) -> DataFrame:
    if _renumbered(rows):
        ids = rows.select("row_key", "doc_id")
        kept = rows.select(F.col("row_key").alias("keep"), F.col("doc_id").alias("keep_id"))
        met = met.join(ids, "row_key").join(kept, "keep")
    else:
        met = met.withColumns({"doc_id": F.col("row_key"), "keep_id": F.col("keep")})
    return met.select("doc_id", "keep_id", F.col("copies").alias("group_size"),
                      (F.col("row_key") == F.col("keep")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))


def _renumbered(rows: DataFrame) -> bool:
    """Whether keys are not the ids themselves."""
    return bool(rows.filter(~F.col("row_key").eqNullSafe(F.col("doc_id"))).limit(1).take(1))
