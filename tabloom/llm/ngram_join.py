"""Exact Jaccard self-join of documents by their word shingles, with set relations.

A document's set holds its distinct five-word shingles; two documents link when
100 * intersection >= 75 * union. Every link counts, none is looked for twice:

* Equal sets are one class.
* Highly similar sets: classes that share a pair of minimal hashes are compared
  with the first of them. Those that link follow it; their overlap with it is kept.
* Index: each set lists its rarest shingles (shingles that many documents share
  come last, all others in hash order), as many as any partner must share one of.
  Lists are cut down to sets that lead (followers stand behind their leader, with
  the best position and size range of them all), ordered by size; blocks of sizes
  too far apart and positions too far back are skipped.
* Answers: two leaders' overlap bounds that of their followers, which differ from
  them by known shingles. Only follower pairs that these leave open are compared.

Links give components by stars; a group of thousands of near copies costs one
comparison a member, not one a pair.

Shingles are told apart by 64-bit hashes. Defined cases: a null text, or one
without words, has an empty set and links with nothing; texts of fewer than five
words have one shingle; repeated rows are equal sets; extra columns are ignored;
an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import (keyed, letter_codes, map_texts, mix, own_columns, salted_join, stored, text_slices,
                                word_bounds, word_hashes)
from tabloom.llm.components import connected

WORDS = 5
SHARE, OF = 3, 4  # links at intersection / union >= SHARE / OF
KEYS = 4  # pairs of minimal hashes by which highly similar sets meet
HEAVY = 8  # a shingle of so many documents is common, at least
HEAVY_LIST = 1 << 22  # common shingles at most: more would fill the bitmap that is sent to the tasks
MAP_BITS = 26  # a bitmap that is sent to the tasks has 2^26 bits at most, that is 8 MB
BLOCK_BITS = 1 << 15  # bits of a bitmap's block, as bitmap_construct_agg makes them
FEW_ROWS = 1_000_000  # gone rows (one long each) up to this number are sent to the documents, more are joined with them
SENT_ROWS = 200_000  # rows of pairs up to this number are sent to the texts, of more only a bitmap of their keys
PART_ENTRIES = 400_000  # index entries that a task sorts
STAR = 2048  # partners of one set that a task compares
COUNTED = 1_000_000  # shingles that a task counts at once
LISTED = 500_000  # index entries that a task packs at once

_CODES = letter_codes(fold_case=True)
_TURN = np.array([0x8CB92BA72F3D8DD7, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x9E3779B185EBCA87, 0xD6E8FEB86659FD93],
                 np.uint64)
_SEEDS = np.random.default_rng(5).integers(1, 1 << 63, 2 * KEYS + 2, dtype=np.uint64)


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Each text's distinct shingle hashes, ascending."""
    starts, ends, texts = word_bounds(data, offsets)
    words = word_hashes(data, starts, ends, _CODES)
    cuts = np.searchsorted(texts, np.arange(len(offsets)))
    n = max(0, len(words) - WORDS + 1)
    hashes = np.zeros(n, np.uint64)
    for k in range(WORDS):
        hashes += words[k: k + n] * _TURN[k]
    hashes = mix(hashes)
    out = []
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        if b - a >= WORDS:
            s = np.sort(hashes[a: b - WORDS + 1])
            fresh = np.ones(len(s), bool)
            np.not_equal(s[1:], s[:-1], out=fresh[1:])
            out.append(s if fresh.all() else s[fresh])
        elif b > a:
            out.append(mix((words[a:b] * _TURN[: b - a]).sum(keepdims=True, dtype=np.uint64) + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _sets(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    for first, data, offsets in text_slices(batch):
        for i, s in enumerate(shingle_sets(data, offsets)):
            yield first + i, s


def prefix_size(n: int) -> int:
    """How many of a set's first shingles any partner must share one of."""
    return n - -(-SHARE * n // OF) + 1


# -- signatures ---------------------------------------------------------------

SIGNATURE_DDL = "row_key long, n long, d1 long, d2 long, " + ", ".join(f"k{j} long" for j in range(KEYS))


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size, 128-bit digest and similarity keys of each set."""
    for batch in batches:
        out = np.zeros((batch.num_rows, KEYS + 3), np.uint64)
        for first, data, offsets in text_slices(batch):
            sets = shingle_sets(data, offsets)
            sizes = np.array([len(s) for s in sets])
            full = np.flatnonzero(sizes)
            if not len(full):
                continue
            joined = np.concatenate([sets[i] for i in full])
            begins = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
            rows = first + full
            out[rows, 0] = sizes[full]
            for j in range(2):
                out[rows, 1 + j] = np.add.reduceat(mix(joined ^ _SEEDS[j]), begins)
            for j in range(KEYS):
                one, two = (np.minimum.reduceat(mix(joined ^ _SEEDS[2 + 2 * j + i]), begins) for i in range(2))
                out[rows, 3 + j] = mix(one * _TURN[0] + two)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *[pa.array(out[:, j].view(np.int64)) for j in range(KEYS + 3)]],
            names=["row_key", "n", "d1", "d2", *[f"k{j}" for j in range(KEYS)]])


# -- common shingles ----------------------------------------------------------

def _count_buckets(bits: int, parts: int, listed: np.ndarray | None = None):
    """Counts of shingle buckets in the rows of the key map ``listed``, by range: small numbers of small steps, which compress."""
    low = bits - (parts.bit_length() - 1)

    def pack(tokens: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        buckets, counts = np.unique(np.concatenate(tokens) >> np.uint64(64 - bits), return_counts=True)
        cuts = np.searchsorted(buckets, np.arange(parts + 1, dtype=np.uint64) << np.uint64(low))
        rows = [(part, np.diff(buckets[a:b], prepend=np.uint64(part << low)).astype(np.uint32).tobytes(),
                 counts[a:b].astype(np.uint32).tobytes()) for part, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if b > a]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["part", "steps", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for _, s in _sets(batch if listed is None else _may_be(batch, listed)):
                held.append(s)
                size += len(s)
                if size > COUNTED:
                    yield from pack(held)
                    held, size = [], 0
        if size:
            yield from pack(held)

    return run


def common_shingles(texts: DataFrame, total: int, listed: np.ndarray) -> tuple[np.ndarray, int]:
    """(bitmap, bits): which prefixes of so many bits of a hash so many documents share that they come last in the index order.

    Every shingle is counted. The order is the same for all sets whatever falls
    into a bucket; buckets only decide which shingles are dear to list. Of more
    than HEAVY_LIST such buckets those of the highest counts are taken. The bitmap
    is made by tasks; the driver gets its bytes alone, never the list.
    """
    bits = min(40, max(16, max(total, 1).bit_length()))
    parts = 1 << max(0, min(bits - 8, bits - 19))
    low = bits - (parts.bit_length() - 1)

    def heavy(frame: pd.DataFrame) -> pd.DataFrame:
        counts = np.zeros(1 << low, np.int64)
        part = int(frame["part"].iloc[0])
        for steps, n in zip(frame["steps"], frame["counts"]):
            at = np.cumsum(np.frombuffer(steps, np.uint32).astype(np.int64))
            counts[at] += np.frombuffer(n, np.uint32)
        many = np.flatnonzero(counts >= HEAVY)
        return pd.DataFrame({"bucket": many + (part << low), "docs": counts[many]})

    counted = map_texts(texts, _count_buckets(bits, parts, listed), "part long, steps binary, counts binary")
    found = stored(counted.groupBy("part").applyInPandas(heavy, "bucket long, docs long"), "common")
    # the lowest count that leaves HEAVY_LIST buckets at most; powers of two keep its table short
    sizes = found.groupBy(F.floor(F.log2("docs")).alias("power")).agg(F.count("*").alias("n")).orderBy(F.desc("power")).collect()
    taken, least = 0, None
    for r in sizes:
        taken += r["n"]
        if taken > HEAVY_LIST:
            break
        least = 1 << r["power"]
    mapped = min(bits, MAP_BITS)
    if least is None:
        return np.zeros(0, np.uint8), mapped
    return _bitmap(found.filter(F.col("docs") >= least), F.shiftright("bucket", bits - mapped), mapped), mapped


# -- bitmaps ------------------------------------------------------------------

def _bitmap(rows: DataFrame, place: Column, bits: int) -> np.ndarray:
    """2^bits bits, in bytes, of which those are set that ``place`` names; 2^bits / 8 bytes reach the driver, whatever the rows."""
    out = np.zeros(max(1 << bits, BLOCK_BITS) // 8, np.uint8)
    at = rows.select(F.floor(place / BLOCK_BITS).cast("int").alias("block"), (place % BLOCK_BITS).cast("long").alias("bit"))
    # dealt first: a task has whole blocks, not a part of each
    for r in at.repartition("block").groupBy("block").agg(F.bitmap_construct_agg("bit").alias("body")).collect():
        body = np.frombuffer(r["body"], np.uint8)
        out[r["block"] * (BLOCK_BITS // 8):][: len(body)] = body
    return out


def _is_set(bitmap: np.ndarray, places: np.ndarray) -> np.ndarray:
    at = places.astype(np.int64)
    return (bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0


def _key_map(rows: DataFrame, key: str) -> np.ndarray:
    """A bitmap by which tasks leave out nearly all rows of other keys, and none of these."""
    k = F.col(key)
    folded = k.bitwiseXOR(F.shiftrightunsigned(k, MAP_BITS)).bitwiseXOR(F.shiftrightunsigned(k, 2 * MAP_BITS))
    return _bitmap(rows, folded.bitwiseAND(F.lit((1 << MAP_BITS) - 1)), MAP_BITS)


def _may_be(batch: pa.RecordBatch, keys: np.ndarray) -> pa.RecordBatch:
    """The rows of ``batch`` (row_key, ..) whose key may be one of a key map's."""
    k, bits = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64), (8 * len(keys)).bit_length() - 1
    folded = (k ^ (k >> np.uint64(bits)) ^ (k >> np.uint64(2 * bits))) & np.uint64(8 * len(keys) - 1)
    return batch.filter(pa.array(_is_set(keys, folded)))


# -- index --------------------------------------------------------------------

def _list_entries(common: np.ndarray, bits: int, parts: int, listed: np.ndarray):
    """Blocks of index entries (shingle, row, set size, shingles after it) by shingle range, of rows in the key map ``listed``."""
    width = 1 << max(1, 64 - (parts - 1).bit_length()) if parts > 1 else 0

    def pack(tokens, keys, sizes, rests) -> Iterator[pa.RecordBatch]:
        lengths = np.array([len(t) for t in tokens])
        token = np.concatenate(tokens)
        key, size = np.repeat(np.array(keys, np.int64), lengths), np.repeat(np.array(sizes, np.uint32), lengths)
        rest = np.concatenate(rests).astype(np.uint32)
        part = (token // np.uint64(width)).astype(np.int64) if width else np.zeros(len(token), np.int64)
        order = np.argsort(part, kind="stable")
        cuts = np.searchsorted(part[order], np.arange(parts + 1))
        rows = []
        for p, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
            if b > a:
                o = order[a:b]
                rows.append((p, token[o].tobytes(), key[o].tobytes(), size[o].tobytes(), rest[o].tobytes()))
        for at in range(0, len(rows), 64):
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows[at: at + 64])],
                                             names=["part", "token", "row_key", "n", "rest"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[list, list, list, list] = ([], [], [], [])
        total = 0
        for batch in batches:
            batch = _may_be(batch, listed)
            row_keys = batch.column(0).to_pylist()
            for row, s in _sets(batch):
                n = len(s)
                if not n:
                    continue
                p = prefix_size(n)
                if len(common):
                    often = _is_set(common, s >> np.uint64(64 - bits))
                    if often.any():
                        s = np.concatenate([s[~often], s[often]])
                for column, value in zip(held, (s[:p], row_keys[row], n, np.arange(n - 1, n - 1 - p, -1))):
                    column.append(value)
                total += p
                if total > LISTED:
                    yield from pack(*held)
                    held, total = ([], [], [], []), 0
        if total:
            yield from pack(*held)

    return run


def _shared(frame: pd.DataFrame) -> pd.DataFrame:
    """The entries of shingles that more than one row lists."""
    token, key, n, rest = (np.concatenate([np.frombuffer(b, t) for b in frame[c]]) for c, t in (
        ("token", np.uint64), ("row_key", np.int64), ("n", np.uint32), ("rest", np.uint32)))
    order = np.argsort(token, kind="stable")
    token = token[order]
    same = token[1:] == token[:-1]
    many = np.zeros(len(token), bool)
    many[1:] |= same
    many[:-1] |= same
    o = order[many]
    return pd.DataFrame({"token": token[many].view(np.int64), "row_key": key[o], "n": n[o].astype(np.int64),
                         "rest": rest[o].astype(np.int64)})


def _pairs_of_lists(frame: pd.DataFrame) -> pd.DataFrame:
    """Pairs of leaders of different groups whose sizes and positions in a list allow a link between followers."""
    frame = frame.sort_values(["token", "low", "lead"], kind="stable")
    token, lead, group, low, high, rest = (frame[c].to_numpy() for c in ("token", "lead", "grp", "low", "high", "rest"))
    cuts = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1], [True]]))
    found: set[tuple[int, int]] = set()
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        if (group[a:b] == group[a]).all():
            continue
        for i in range(a, b - 1):
            # ordered by smallest size: the block ends where even the largest member here is too small
            stop = a + int(np.searchsorted(low[a:b], OF * high[i] // SHARE, side="right"))
            j = np.arange(i + 1, stop)
            if not len(j):
                continue
            need = low[i] + low[j]
            ok = (group[j] != group[i]) & ((SHARE + OF) * (1 + np.minimum(rest[i], rest[j])) >= SHARE * need)
            for other in lead[j[ok]].tolist():
                found.add((min(lead[i], other), max(lead[i], other)))
    return pd.DataFrame(list(found), columns=["a", "b"], dtype="int64")


# -- comparisons --------------------------------------------------------------

OVERLAP_DDL = "a long, b long, na long, nb long, overlap long"


def _as_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        held: list[tuple[int, bytes]] = []
        for row, s in _sets(batch):
            held.append((row, s.tobytes()))
            if len(held) >= 500:
                yield _packed(batch, held)
                held = []
        if held:
            yield _packed(batch, held)


def _packed(batch: pa.RecordBatch, held: list[tuple[int, bytes]]) -> pa.RecordBatch:
    rows = batch.take(pa.array([r for r, _ in held]))
    return pa.RecordBatch.from_arrays([*rows.columns[:4], pa.array([s for _, s in held], pa.binary())],
                                      names=["center", "salt", "is_member", "row_key", "hashes"])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Overlaps of members with their center, which comes first."""
    center, middle = None, np.zeros(0, np.uint64)
    for batch in batches:
        out = []
        for key, member, row, body in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3, 4))):
            s = np.frombuffer(body, np.uint64)
            if not member:
                center, middle = key, s
                continue
            assert key == center
            at = np.minimum(np.searchsorted(middle, s), len(middle) - 1)
            out.append((key, row, len(middle), len(s), int((middle[at] == s).sum())))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)],
                                             names=["a", "b", "na", "nb", "overlap"])


def _spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The shingles of members, and which of them their center, which comes first, doesn't hold."""
    middle = np.zeros(0, np.uint64)
    for batch in batches:
        for key, member, row, body in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3, 4))):
            s = np.frombuffer(body, np.uint64)
            if not member:
                middle = s
                continue
            at = np.minimum(np.searchsorted(middle, s), len(middle) - 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(s), key)), pa.array(np.full(len(s), row)), pa.array(s.view(np.int64)),
                 pa.array(middle[at] != s)], names=["lead", "row_key", "token", "fresh"])


def sets_met(rows: DataFrame, pairs: DataFrame, run, shape: str) -> DataFrame:
    """What ``run`` makes of stored ``pairs`` (a, b) of row keys: the set of ``a``, then those of its partners.

    Sets come from whole texts. One that has many partners is copied for each STAR of them.
    """
    fans = stored(pairs.groupBy("a").agg(F.count("*").alias("fan")), "fans")
    members = salted_join(pairs, fans, ["a"], "fan", "b").select(
        F.col("a").alias("center"), F.pmod(F.xxhash64("b"), F.ceil(F.col("fan") / STAR)).cast("int").alias("salt"),
        F.lit(True).alias("is_member"), F.col("b").alias("row_key"))
    centers = fans.select(F.col("a").alias("center"), F.explode(F.sequence(
        F.lit(0), F.ceil(F.col("fan") / STAR).cast("int") - 1)).alias("salt"), F.lit(False).alias("is_member"),
        F.col("a").alias("row_key"))
    wanted = stored(members.union(centers), "wanted")
    texts, asked = rows.select("row_key", "text"), F.broadcast(wanted)
    if wanted.count() > SENT_ROWS:
        keys, asked = _key_map(wanted, "row_key"), wanted
        texts = map_texts(texts, lambda batches: (_may_be(batch, keys) for batch in batches), texts.schema)
    texts = texts.join(asked, "row_key").select("center", "salt", "is_member", "row_key", "text")
    sets = map_texts(texts, _as_sets, "center long, salt int, is_member boolean, row_key long, hashes binary")
    dealt = sets.repartition("center", "salt").sortWithinPartitions("center", "salt", "is_member")
    return stored(map_texts(dealt, run, shape), "met")


def overlaps(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """(a, b, na, nb, overlap) of stored ``pairs``."""
    return sets_met(rows, pairs, _compare, OVERLAP_DDL)


LINKED = f"overlap * {SHARE + OF} >= {SHARE} * (na + nb)"


# -- the join -----------------------------------------------------------------

def _index_pairs(texts: DataFrame, total: int, leads: DataFrame) -> DataFrame:
    """Candidate pairs of leaders (a, b) from the index over one row of each class (``leads`` has one of each)."""
    listed = _key_map(leads, "row_key")
    common, bits = common_shingles(texts, total, listed)
    parts = 1 << max(0, (total // OF // PART_ENTRIES).bit_length())
    blocks = map_texts(texts, _list_entries(common, bits, parts, listed), "part long, token binary, row_key binary, n binary, rest binary")
    shared = blocks.groupBy("part").applyInPandas(_shared, "token long, row_key long, n long, rest long")
    entries = shared.join(leads, "row_key").groupBy("token", "lead").agg(
        F.min("grp").alias("grp"), F.min("n").alias("low"), F.max("n").alias("high"), F.max("rest").alias("rest"))
    dealt = entries.groupBy(F.pmod(F.xxhash64("token"), F.lit(parts)).alias("part"))
    return stored(dealt.applyInPandas(_pairs_of_lists, "a long, b long").distinct(), "candidates")


def linked_classes(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(signatures, classes, roots) of ``rows`` (row_key, text); roots (node, root) of the classes that link."""
    texts = rows.select("row_key", "text")
    signatures = stored(map_texts(texts, _sign, SIGNATURE_DDL), "signatures")
    keys = [f"k{j}" for j in range(KEYS)]
    classes = stored(signatures.filter("n > 0").groupBy("n", "d1", "d2").agg(
        F.min("row_key").alias("rep"), F.count("*").alias("copies"), *[F.min(k).alias(k) for k in keys]), "classes")

    # highly similar sets follow the first set that they share a key with and link to
    keyed_reps = stored(classes.select("rep", F.posexplode(F.array(*keys)).alias("j", "key")), "keys")
    meets = stored(keyed_reps.groupBy("j", "key").agg(F.min("rep").alias("a"), F.count("*").alias("size"))
                   .filter("size > 1"), "meets")
    stars = salted_join(keyed_reps, meets, ["j", "key"], "size", "rep").filter("rep > a").select("a", F.col("rep").alias("b"))
    near = overlaps(texts, stored(stars.distinct(), "stars")).filter(LINKED)
    roots = near.select("b").distinct()
    direct = near.join(roots.withColumnRenamed("b", "a"), "a", "left_anti")  # leaders follow nobody
    follows = stored(direct.groupBy("b").agg(F.min(F.struct("a", "overlap")).alias("f")).select(
        F.col("b").alias("row_key"), "f.a", "f.overlap"), "follows")
    groups = connected(near.select("a", "b")).select(F.col("node").alias("row_key"), F.col("root").alias("grp"))
    leads = stored(classes.select(F.col("rep").alias("row_key"), "n").join(follows, "row_key", "left")
                   .join(groups, "row_key", "left").select(
        "row_key", "n", F.coalesce("a", "row_key").alias("lead"), F.coalesce("grp", "row_key").alias("grp"),
        F.coalesce("overlap", "n").alias("with_lead")), "leads")

    # only the first of equal sets is listed (leads hold no others), so copies bring no entries into a list's task
    total = classes.agg(F.sum("n")).head()[0] or 0
    pairs = _index_pairs(texts, total, leads.select("row_key", "lead", "grp"))
    compared = overlaps(texts, pairs)
    found = near.select("a", "b").union(compared.filter(LINKED).select("a", "b"))

    roots = stored(connected(found), "roots")
    open_pairs = _open_pairs(texts, leads, compared.filter(f"not ({LINKED})"), roots)
    if not open_pairs.isEmpty():
        more = overlaps(texts, open_pairs).filter(LINKED).select("a", "b")
        roots = connected(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(more))
    return signatures, classes, roots


def _open_pairs(texts: DataFrame, leads: DataFrame, apart: DataFrame, roots: DataFrame) -> DataFrame:
    """(a, b): the followers x, y of leaders a, b that don't link whose own link the leaders' overlap leaves open.

    x and y share at most overlap(a, b) + |x - a| + |y - b|, which rules most leaders out with all
    that follow them; leaders that other links have joined need no more either. For the rest the
    answer follows from the differences: x and y share no more than the leaders do, but for the
    shingles of x - a that y holds and those of y - b that x holds. Few sets hold such shingles,
    so these are matched by shingle, not pair by pair.
    """
    slack = (SHARE + OF) * (F.col("n") - F.col("with_lead")) - SHARE * F.col("n")
    ends = leads.groupBy("lead").agg(F.max(slack).alias("most")).join(
        roots.withColumnRenamed("node", "lead"), "lead", "left").withColumn("root", F.coalesce("root", "lead"))
    end = lambda side: ends.select(F.col("lead").alias(side), F.col("most").alias(f"most_{side}"),
                                   F.col("root").alias(f"root_{side}"))
    rest = stored(apart.join(end("a"), "a").join(end("b"), "b").filter(
        (F.col("root_a") != F.col("root_b"))
        & ((SHARE + OF) * F.col("overlap") + F.col("most_a") + F.col("most_b") >= 0)).select("a", "b", "overlap"), "rest")
    named = rest.select(F.col("a").alias("lead")).union(rest.select("b")).distinct()
    members = stored(leads.join(named, "lead").select("lead", "row_key", "n"), "members")
    spelled = sets_met(texts, members.select(F.col("lead").alias("a"), F.col("row_key").alias("b")), _spell,
                       "lead long, row_key long, token long, fresh boolean")
    fresh = spelled.filter("fresh").select("token", F.col("lead").alias("lead_x"), F.col("row_key").alias("x"))
    held = spelled.select("token", F.col("lead").alias("lead_y"), F.col("row_key").alias("y"))
    # groups meet by shingle before their members do, and only where their leaders leave something open
    most = leads.groupBy("lead").agg(F.max(slack).alias("most")).withColumnRenamed("lead", "lead_y")
    ways = rest.select(F.col("a").alias("lead_x"), F.col("b").alias("lead_y"), "overlap").union(
        rest.select("b", "a", "overlap")).join(most, "lead_y")
    both = fresh.select("lead_x", "token").distinct().join(held.select("lead_y", "token").distinct(), "token").filter(
        "lead_x != lead_y").join(ways, ["lead_x", "lead_y"])
    near = stored(both.join(fresh, ["lead_x", "token"]), "near")
    # a member whose shingles in the whole other group, with all that any of that group adds, can't do links with none there
    able = near.groupBy("lead_x", "lead_y", "x", "overlap", "most").agg(F.count("*").alias("met")).join(
        members.select(F.col("row_key").alias("x"), "n"), "x").filter(
        (SHARE + OF) * (F.col("overlap") + F.col("met")) - SHARE * F.col("n") + F.col("most") >= 0)
    meets = near.select("lead_x", "lead_y", "x", "token").join(
        able.select("lead_x", "lead_y", "x"), ["lead_x", "lead_y", "x"]).join(held, ["lead_y", "token"])
    turned = F.col("lead_x") > F.col("lead_y")
    shared = meets.select(
        F.least("lead_x", "lead_y").alias("a"), F.greatest("lead_x", "lead_y").alias("b"),
        F.when(turned, F.col("y")).otherwise(F.col("x")).alias("x"), F.when(turned, F.col("x")).otherwise(F.col("y")).alias("y"),
    ).groupBy("a", "b", "x", "y").agg(F.count("*").alias("extra"))
    size = lambda row: members.select(F.col("row_key").alias(row), F.col("n").alias(f"n{row}"))
    reaches = lambda extra: (SHARE + OF) * (F.col("overlap") + extra) >= SHARE * (F.col("nx") + F.col("ny"))
    told = rest.join(shared, ["a", "b"]).join(size("x"), "x").join(size("y"), "y").filter(reaches(F.col("extra")))
    # no shingle more than the leaders share can do only for sets smaller than they are
    side = lambda lead, row: members.select(F.col("lead").alias(lead), F.col("row_key").alias(row),
                                            F.col("n").alias(f"n{row}"))
    least = members.groupBy("lead").agg(F.min("n").alias("least")).select(F.col("lead").alias("b"), "least")
    small = rest.join(least, "b").join(side("a", "x"), "a").filter(
        (SHARE + OF) * F.col("overlap") >= SHARE * (F.col("nx") + F.col("least"))).join(side("b", "y"), "b").filter(reaches(F.lit(0)))
    fits = OF * F.least("nx", "ny") >= SHARE * F.greatest("nx", "ny")
    both = told.filter(fits).select("x", "y").union(small.filter(fits).select("x", "y"))
    return stored(both.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "open")


def components(rows: DataFrame) -> DataFrame:
    """(row_key, n, root): each row's set size and the first row it reaches by links."""
    signatures, classes, roots = linked_classes(rows)
    roots = roots.withColumnRenamed("node", "rep")
    classes = stored(classes.join(roots, "rep", "left").select(
        "n", "d1", "d2", "copies", F.coalesce("root", "rep").alias("root")), "class-roots")
    met = salted_join(signatures.select("row_key", "n", "d1", "d2"), classes, ["n", "d1", "d2"], "copies", "row_key", how="left")
    return met.select("row_key", "n", F.coalesce("root", "row_key").alias("root"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the smallest id that its links reach)."""
    rows = keyed(own_columns(docs, {"doc_id": "doc_id", "text": "text"}))
    met = components(rows)
    ids = rows.select("row_key", "doc_id")
    named = met.join(ids, "row_key").join(ids.select(F.col("row_key").alias("root"), F.col("doc_id").alias("component_id")), "root")
    return named.select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """The first document of each component, with all its columns."""
    rows = keyed(docs)
    gone = stored(components(rows).filter("root != row_key").select("row_key"), "gone")
    few = gone if gone.count() > FEW_ROWS else F.broadcast(gone)
    return rows.join(few, "row_key", "left_anti").select(*docs.columns)
