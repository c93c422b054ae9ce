"""Row keys, stored intermediates and Arrow text buffers shared by the operators."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.session import scratch_path

# ASCII white space, as in ``[\x20\x09-\x0D]``
BLANKS = " \t\n\x0b\x0c\r"
IS_BLANK = np.zeros(256, dtype=bool)
IS_BLANK[[ord(c) for c in BLANKS]] = True

# text bytes that one vectorised step works on; its temporary arrays take about 30 times as much
SLICE_BYTES = 1 << 18
# rows of texts that pass between Spark and Python at a time, unless the session asks for fewer
BATCH_ROWS = 1000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write to the shared folder once and read it back, so that
    a lost executor costs one task, not the whole chain."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def map_texts(df: DataFrame, run, shape) -> DataFrame:
    """``df.mapInArrow`` in batches small enough that whole texts take little memory on both sides.

    The session's limit on records in a batch is lowered where it is higher.
    """
    limit = "spark.sql.execution.arrow.maxRecordsPerBatch"
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(limit)) <= BATCH_ROWS:
        conf.set(limit, str(BATCH_ROWS))
    return df.mapInArrow(run, shape)


def keyed(docs: DataFrame, key: str = "doc_id", text: str = "text", out: str = "row_key") -> DataFrame:
    """``docs`` with a unique long ``out`` in the order of ``key``.

    Where ids are unique and not null they are the key themselves. Otherwise
    (repeated or null ids) the rows are sorted by id and text, numbered, and
    stored once, so that every later pass sees the same numbers.
    """
    numbers = dict(docs.dtypes)[key] in ("bigint", "int", "smallint", "tinyint")
    clash = docs.groupBy(key).count().filter(F.col(key).isNull() | (F.col("count") > 1)).limit(1)
    if numbers and not clash.take(1):
        return docs.withColumn(out, F.col(key).cast("long"))
    ordered = docs.orderBy(F.col(key).asc_nulls_last(), F.col(text).asc_nulls_first())
    return stored(ordered.withColumn(out, F.monotonically_increasing_id()), "keyed")


LEAST_HOT = 10_000  # rows of a key that one task joins


def salted_join(rows: DataFrame, groups: DataFrame, on: list[str], weight: str, spread: str, how: str = "inner") -> DataFrame:
    """``rows`` with the columns of stored ``groups``, of which there is one for each key of ``on``.

    ``weight`` counts a key's rows. Keys with over a thousandth of all rows are a
    thousand at most: they are sent to the rows, and both sides of them are dealt
    over salts (rows by ``spread``), so no task gets more of a key than LEAST_HOT rows
    or a thousandth of a per cent of all.
    """
    total = groups.agg(F.sum(weight)).head()[0] or 0
    bound = max(LEAST_HOT, total // 1000)
    salts = F.ceil(F.col(weight) / max(LEAST_HOT, total // 100_000)).cast("int")
    dealt = groups.withColumn("_salt", F.explode(F.when(
        F.col(weight) > bound, F.sequence(F.lit(0), salts - 1)).otherwise(F.array(F.lit(0)))))
    if total <= bound:
        return rows.join(groups, on, how)
    hot = groups.filter(F.col(weight) > bound).select(*on, salts.alias("_salts"))
    marked = rows.join(F.broadcast(hot), on, "left").withColumn(
        "_salt", F.coalesce(F.pmod(F.xxhash64(spread), F.col("_salts")), F.lit(0)).cast("int")).drop("_salts")
    return marked.join(dealt, [*on, "_salt"], how).drop("_salt")


def own_columns(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Select ``names`` (theirs -> ours), so that extra columns of any name can't clash."""
    return df.select(*[F.col(f"`{a}`").alias(b) for a, b in names.items()])


def text_slices(batch: pa.RecordBatch, column: str = "text",
                limit: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, UTF-8 bytes, offsets) of runs of whole texts of about ``limit`` bytes; null is empty."""
    array = batch.column(batch.schema.get_field_index(column))
    if array.null_count:
        array = array.fill_null("")
    if not len(array):
        return
    wide = pa.types.is_large_string(array.type)
    bounds = np.frombuffer(array.buffers()[1], np.int64 if wide else np.int32)
    bounds = bounds[array.offset: array.offset + len(array) + 1].astype(np.int64)
    body = array.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(array):
        last = int(np.searchsorted(bounds, bounds[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), len(array))
        yield first, data[bounds[first]: bounds[last]], bounds[first: last + 1] - bounds[first]
        first = last


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and text numbers of the words (runs without ASCII white space) of a slice."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    solid = ~IS_BLANK[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.empty(len(data), bool)
    before[0], before[1:] = False, solid[:-1]
    starts = np.flatnonzero(solid & (~before | edge[:-1]))
    after = np.empty(len(data), bool)
    after[-1], after[:-1] = False, solid[1:]
    ends = np.flatnonzero(solid & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def _power_table(name: str, base: np.uint64, n: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        size = 1 << max(16, (n - 1).bit_length())
        have = np.full(size, base, np.uint64)
        have[0] = 1
        have = _powers[name] = np.multiply.accumulate(have)
    return have[:n]


def letter_codes(fold_case: bool) -> np.ndarray:
    """A random 64-bit number for each byte value; with ``fold_case`` A-Z share those of a-z."""
    codes = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
    if fold_case:
        codes[65:91] = codes[97:123]
    return codes


# sums of powers modulo 2^64 collide for words of regular structure from 1,024 bytes on; words this long are hashed apart
LONG_WORD = 128


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte ranges, from one running sum over the slice; of long ranges by BLAKE2."""
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(codes[data] * _power_table("up", _BASE, max(n, 1)), out=sums[1:])
    own = (sums[ends] - sums[starts]) * _power_table("down", _INVERSE, max(n, 1))[starts]
    hashes = mix(own + (ends - starts).astype(np.uint64))
    for i in np.flatnonzero(ends - starts >= LONG_WORD):
        letters = codes[data[starts[i]: ends[i]]].tobytes()
        hashes[i] = int.from_bytes(hashlib.blake2b(letters, digest_size=8).digest(), "little")
    return hashes
