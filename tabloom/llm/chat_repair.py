"""Conversation structure repair by divide and conquer over four-state cost vectors.

A conversation should read ``(s?(ua)+)?`` by the initials of its roles. Rows are
kept (0), given the role that fits (3), deleted (4, the only choice for blank and
repeated rows) or preceded by an inserted empty message (3); a truncated row that
stays costs 3 more. Among the cheapest edits the ASCII-least string of initials
(D, I, K, R) is wanted.

After any row the conversation is in one of four states (nothing yet, a system, a
user or an assistant message last). Forward vectors hold, for each state, the least
cost and the order of its least edit string among the states'; backward vectors
hold the cost to the end. Hirschberg's recursion lets both meet in the middle,
takes the audit-least of the optimal crossings, and repairs the halves on their own,
so no table of all rows is kept. Strings that end at different states right after
the same row are never one another's prefix, which is why orders of states suffice.
Vectors differ by few small numbers, so their steps are remembered.

On Spark a conversation is cut into blocks of at most BLOCK rows. A block's cost
from each state to each state, with the orders, is found without its neighbours;
backward and forward vectors then pass over these rows (one per block) and name
each block's crossing states, and blocks are repaired apart. So one conversation
with a third of all rows is worked on by many tasks; only its rows per block and
its final digest, both streamed, pass through a single one.

Defined cases: a null role or text is one space; rows come by turn (nulls first),
then role, then the MD5 of the text; repeated rows are rows of their own; a null
conversation is one conversation; a role counts by its first character, any other
than s, u, a must be changed or deleted; very long texts are never held together;
extra columns are ignored; an empty table gives empty results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import BLANKS, own_columns, stored

NOTHING, SYSTEM, USER, ASSISTANT = range(4)  # states: what the repaired conversation ends with so far
EXPECTED = (USER, USER, ASSISTANT, USER)  # what may be inserted, or a row be changed to, in each state
ROLE = {USER: "user", ASSISTANT: "assistant"}
AT_END = {NOTHING: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}  # inserts that complete the last state
FINE, TRUNCATED, BLANK, DUPLICATE = range(4)  # faults; a row's code is 4 * fault + the place of its initial in INITIALS
INITIALS = "sua"  # 3: any other
RIGHT_PAIRS = {(0, 1), (1, 2), (2, 1)}
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 3, 4, 3, 3
BLOCK_BITS = 12
NEVER = 1 << 60
# a state so much dearer than another is on no cheapest way: two inserts and a deletion lead anywhere it could
HOPELESS = 64

Vector = tuple[tuple[int, int] | None, ...]  # state -> (cost, order of the least string)


@lru_cache(None)
def moves(code: int) -> tuple[tuple[int, int, int, str], ...]:
    """(state, next state, cost, edits): the cheapest inserts and edit that take in a row, ASCII-least among equals."""
    fault, initial = divmod(code, 4)
    best: dict[tuple[int, int], tuple[int, str]] = {}
    for before in range(4):
        state = before
        for inserts in range(4):
            head, cost = "I" * inserts, inserts * INSERT_COST
            options = [(DELETE_COST, "D", state)]
            if fault < BLANK:
                more = TRUNCATED_COST if fault == TRUNCATED else 0
                options.append((REROLE_COST + more, "R", EXPECTED[state]))
                if initial + 1 == EXPECTED[state] or (state == NOTHING and initial + 1 == SYSTEM):
                    options.append((more, "K", initial + 1))
            for c, letter, after in options:
                known = best.get((before, after))
                if known is None or (cost + c, head + letter) < known:
                    best[before, after] = (cost + c, head + letter)
            state = EXPECTED[state]
    return tuple((s, t, cost, text) for (s, t), (cost, text) in sorted(best.items()))


@lru_cache(None)
def forward(vector: Vector, code: int) -> tuple[int, Vector]:
    """One row further: (cost that all states share, what is left for each state)."""
    ways: list[tuple | None] = [None] * 4
    for s, t, cost, text in moves(code):
        if vector[s] is not None:
            way = (vector[s][0] + cost, vector[s][1], text)
            if ways[t] is None or way < ways[t]:
                ways[t] = way
    least = min(w[0] for w in ways if w)
    order = sorted(w[1:] for w in ways if w)
    return least, tuple(w and (min(w[0] - least, HOPELESS), order.index(w[1:])) for w in ways)


@lru_cache(None)
def backward(costs: tuple[int, ...], code: int) -> tuple[int, tuple[int, ...]]:
    """One row back: costs to the end of what follows, as ``forward`` gives them."""
    out = [NEVER] * 4
    for s, t, cost, _ in moves(code):
        out[s] = min(out[s], cost + costs[t])
    least = min(out)
    return least, tuple(NEVER if c >= NEVER else c - least for c in out)


def at_state(s: int) -> Vector:
    return tuple((0, 0) if t == s else None for t in range(4))


def only(s: int) -> tuple[int, ...]:
    return tuple(0 if t == s else NEVER for t in range(4))


def crossing(vector: Vector, costs: Sequence[int]) -> int:
    """The state at which the audit-least of the cheapest ways passes from a forward to a backward vector."""
    return min((v[0] + costs[t], v[1], t) for t, v in enumerate(vector) if v)[2]


def edits(codes: bytes, start: int, end: int) -> str:
    """The least edit string that takes rows ``codes`` from one state to the other."""
    parts: list[str] = []
    waiting = [(0, len(codes), start, end)]
    while waiting:
        lo, hi, s, t = waiting.pop()
        if hi - lo == 1:
            parts.append(next(m[3] for m in moves(codes[lo]) if m[:2] == (s, t)))
            continue
        middle = (lo + hi) // 2
        vector, costs = at_state(s), only(t)
        for code in codes[lo:middle]:
            vector = forward(vector, code)[1]
        for code in reversed(codes[middle:hi]):
            costs = backward(costs, code)[1]
        at = crossing(vector, costs)
        waiting += [(middle, hi, at, t), (lo, middle, s, at)]
    return "".join(parts)


def crossings(codes: bytes) -> tuple[list[int], list[int]]:
    """Of a block: cost and order for each pair of states (4 * start + end), -1 where there is no way."""
    costs, orders = [-1] * 16, [-1] * 16
    for s in range(4):
        vector, total = at_state(s), 0
        for code in codes:
            least, vector = forward(vector, code)
            total += least
        for t, v in enumerate(vector):
            if v:
                costs[4 * s + t], orders[4 * s + t] = total + v[0], v[1]
    return costs, orders


def wrong_pairs(codes: bytes) -> int:
    return sum((a & 3, b & 3) not in RIGHT_PAIRS for a, b in zip(codes, codes[1:]))


# -- Spark --------------------------------------------------------------------

LONGS = pa.list_(pa.int64())
BLOCKS = pa.schema([("conv_id", pa.null()), ("first", pa.int64()), ("codes", pa.binary()), ("costs", LONGS), ("orders", LONGS)])
BLOCKS_DDL = "first long, codes binary, costs array<long>, orders array<long>"
ENDS = pa.schema([("conv_id", pa.null()), ("first", pa.int64()), ("costs", LONGS), ("orders", LONGS), ("head", pa.int32()),
                  ("last", pa.int32()), ("inner", pa.int64())])
ENDS_DDL = "first long, costs array<long>, orders array<long>, head int, last int, inner long"
CHOSEN = pa.schema([("conv_id", pa.null()), ("first", pa.int64()), ("start", pa.int32()), ("end", pa.int32()),
                    ("tail", pa.string()), ("cost", pa.int64()), ("illegal", pa.int64())])
CHOSEN_DDL = "first long, start int, end int, tail string, cost long, illegal long"
AUDITS = pa.schema([("conv_id", pa.null()), ("first", pa.int64()), ("cost", pa.int64()), ("illegal", pa.int64()),
                    ("truncated", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()), ("audit", pa.string()),
                    ("states", pa.binary())])
AUDITS_DDL = ("first long, cost long, illegal long, truncated long, blank long, duplicate long, audit string, "
              "states binary")
EDITS = pa.schema([("conv_id", pa.null()), ("pos", pa.int64()), ("seq", pa.int32()), ("new_role", pa.string()), ("own", pa.bool_())])
EDITS_DDL = "pos long, seq int, new_role string, own boolean"
DIGESTS = pa.schema([("conv_id", pa.null()), ("repaired_sha256", pa.string())])
DIGESTS_DDL = "repaired_sha256 string"


def _typed(schema: pa.Schema, conv: pa.DataType) -> pa.Schema:
    return schema.set(0, pa.field("conv_id", conv))


def _rows(batches: Iterator[pa.RecordBatch], seen: list) -> Iterator[tuple]:
    """Rows of all batches; ``seen`` gets the type of the first column."""
    for batch in batches:
        if not seen:
            seen.append(batch.column(0).type)
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _batched(rows: Iterator[tuple], schema: pa.Schema, seen: list, limit: int = 1000) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []

    def batch() -> pa.RecordBatch:
        typed = _typed(schema, seen[0])
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), typed)], schema=typed)

    for row in rows:
        held.append(row)
        if len(held) >= limit:
            yield batch()
            held = []
    if held:
        yield batch()


def _map(df: DataFrame, run, schema: pa.Schema, ddl: str) -> DataFrame:
    """``mapInArrow`` of a generator of rows; the first column is conv_id, of whatever type."""
    def stream(batches):
        seen: list = []
        return _batched(run(_rows(batches, seen)), schema, seen)

    return df.mapInArrow(stream, f"conv_id {dict(df.dtypes)['conv_id']}, {ddl}")


def number_rows(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and ``pos``, a number in the order of rows; stored, so that it holds."""
    t = own_columns(turns, {c: c for c in ("conv_id", "turn", "role", "text")}).select(
        "conv_id", "turn", *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")])
    t = t.withColumns({"tie": F.md5("text"), "arrival": F.monotonically_increasing_id()})
    order = ["conv_id", "turn", "role", "tie", "arrival"]  # arrival only deals equal rows over tasks
    dealt = t.repartitionByRange(*order).sortWithinPartitions(*order)
    return stored(dealt.select("conv_id", "turn", "role", "text", F.monotonically_increasing_id().alias("pos")), "turns")


def code_rows(numbered: DataFrame) -> DataFrame:
    """conv_id, pos, fault and ``code`` of each row."""
    bare = F.btrim("text", F.lit(BLANKS))
    last = F.substring(bare, -1, 1)
    initial = F.position(F.substring("role", 1, 1), F.lit(INITIALS)) - 1
    initial = F.when((F.col("role") == "") | (initial < 0), F.lit(3)).otherwise(initial)
    earliest = numbered.groupBy("conv_id", "role", F.md5("text").alias("same")).agg(F.min("pos").alias("pos"))
    rows = numbered.select("conv_id", "pos", initial.alias("initial"), (bare == "").alias("blank"),
                           (~last.isin(".", "!", "?")).alias("truncated"))
    rows = rows.join(earliest.select("pos", F.lit(True).alias("earliest")), "pos", "left")
    fault = F.when(F.col("blank"), BLANK).when(F.col("earliest").isNull(), DUPLICATE).when(
        F.col("truncated"), TRUNCATED).otherwise(FINE)
    return rows.withColumn("fault", fault).select("conv_id", "pos", "fault", (4 * F.col("fault") + F.col("initial")).alias("code"))


def block_rows(codes: DataFrame) -> DataFrame:
    """One row per block: its codes, and cost and order between all states."""
    def run(rows):
        key, codes = None, bytearray()
        for conv, block, pos, code in rows:
            if key is None or (conv, block) != key[:2]:
                if key:
                    yield key[0], key[2], bytes(codes), *crossings(bytes(codes))
                key, codes = (conv, block, pos), bytearray()
            codes.append(code)
        if key:
            yield key[0], key[2], bytes(codes), *crossings(bytes(codes))

    dealt = codes.select("conv_id", F.shiftright("pos", BLOCK_BITS).alias("block"), "pos", "code")
    dealt = dealt.repartition("block").sortWithinPartitions("pos")
    return stored(_map(dealt, run, BLOCKS, BLOCKS_DDL), "blocks")


def choose(blocks: DataFrame) -> DataFrame:
    """Start and end state of each block on its conversation's way, its cost and wrong pairs of roles."""
    def ends(rows):
        for conv_id, first, codes, costs, orders in rows:
            yield conv_id, first, costs, orders, codes[0] & 3, codes[-1] & 3, wrong_pairs(codes)

    def back(rows):
        conv, after = (), None
        for row in rows:
            if row[:1] != conv:
                conv, after = row[:1], [INSERT_COST * len(AT_END[t]) for t in range(4)]
            yield *row, after
            costs = row[2]
            after = [min(costs[4 * s + t] + after[t] for t in range(4) if costs[4 * s + t] >= 0) for s in range(4)]

    def last(held):
        tail = AT_END[held[3]]
        return *held[:4], tail, held[4] + INSERT_COST * len(tail), held[5]

    def onwards(rows):
        conv, state, before, held = (), NOTHING, None, None
        for conv_id, first, costs, orders, head, tail, inner, after in rows:
            same = (conv_id,) == conv
            if held:
                yield (*held[:4], "", *held[4:]) if same else last(held)
            if not same:
                conv, state, before = (conv_id,), NOTHING, None
            ways = tuple((costs[4 * state + t], orders[4 * state + t]) if costs[4 * state + t] >= 0 else None for t in range(4))
            end = crossing(ways, after)
            wrong = inner + (before is not None and (before, head) not in RIGHT_PAIRS)
            held = (conv_id, first, state, end, costs[4 * state + end], wrong)
            state, before = end, tail
        if held:
            yield last(held)

    # one row per block streams backwards, then forwards, through the task of its conversation
    turned = _map(blocks, ends, ENDS, ENDS_DDL).repartition("conv_id").sortWithinPartitions("conv_id", F.desc("first"))
    behind = _map(turned, back, ENDS.append(pa.field("after", LONGS)), f"{ENDS_DDL}, after array<long>")
    return _map(behind.sortWithinPartitions("conv_id", "first"), onwards, CHOSEN, CHOSEN_DDL)


def follow(codes: bytes, start: int, audit: str) -> bytes:
    """The state after each edit."""
    state, at, out = start, 0, bytearray()
    for letter in audit:
        if letter == "K":
            state = (codes[at] & 3) + 1
        elif letter != "D":
            state = EXPECTED[state]
        at += letter != "I"
        out.append(state)
    return bytes(out)


def audit_rows(blocks: DataFrame) -> DataFrame:
    """Each block's edit string, by the recursion between its states, with its counts; stored."""
    def run(rows):
        for conv_id, first, start, end, tail, cost, illegal, codes in rows:
            audit, faults = edits(codes, start, end) + tail, [c >> 2 for c in codes]
            yield (conv_id, first, cost, illegal, *[faults.count(f) for f in (TRUNCATED, BLANK, DUPLICATE)], audit,
                   follow(codes, start, audit))

    both = choose(blocks).join(blocks.select("first", "codes"), "first")
    return stored(_map(both.select("conv_id", "first", "start", "end", "tail", "cost", "illegal", "codes"), run, AUDITS, AUDITS_DDL),
                  "audits")


def apply_edits(numbered: DataFrame, audits: DataFrame) -> DataFrame:
    """The repaired turns: conv_id, pos, seq, role, text; they read in order of pos, then seq."""
    def run(rows):
        for conv_id, first, audit, states in rows:
            pos, seq = first, 0
            for letter, state in zip(audit, states):
                if letter != "D":
                    yield conv_id, pos, seq, None if letter == "K" else ROLE[state], letter != "I"
                pos, seq = (pos, seq + 1) if letter == "I" else (pos + 1, 0)

    plan = _map(audits.select("conv_id", "first", "audit", "states"), run, EDITS, EDITS_DDL)
    # an insert after a conversation's last row may share the place of another conversation's first
    own = numbered.select("pos", F.col("role").alias("old_role"), "text", F.lit(True).alias("own"))
    return plan.join(own, ["pos", "own"], "left").select(
        "conv_id", "pos", "seq", F.coalesce("new_role", "old_role").alias("role"), F.coalesce("text", F.lit("")).alias("text"))


def repair(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(summary, repaired) of ``turns`` (conv_id, turn, role, text).

    ``summary`` has a row per conversation: conv_id, gaps, blank, duplicate, truncated,
    illegal, cost, audit. ``repaired`` has the turns of the repaired conversations.
    """
    numbered = number_rows(turns)
    audits = audit_rows(block_rows(code_rows(numbered)))
    sums = [F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")]
    in_order = F.transform(F.sort_array(F.collect_list(F.struct("first", "audit"))), lambda a: a["audit"])
    found = audits.groupBy("conv_id").agg(*sums, F.array_join(in_order, "").alias("audit"))
    spread = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    gaps = numbered.groupBy("conv_id").agg(F.coalesce(spread, F.lit(0)).cast("long").alias("gaps"))
    return with_same(found, gaps), apply_edits(numbered, audits)


def with_same(left: DataFrame, right: DataFrame) -> DataFrame:
    """``left`` with the other columns of ``right``'s row of the same conversation, also of the null one."""
    other = right.withColumnRenamed("conv_id", "_conv")
    return left.join(other, left["conv_id"].eqNullSafe(other["_conv"]), "left").drop("_conv")


def digest(repaired: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256): of ``role:text`` of all turns, joined by newlines, streamed in order."""
    def run(rows):
        conv, state = (), None
        for conv_id, role, text in rows:
            if (conv_id,) != conv:
                if state:
                    yield *conv, state.hexdigest()
                conv, state = (conv_id,), hashlib.sha256()
            else:
                state.update(b"\n")
            state.update(f"{role}:{text}".encode())
        if state:
            yield *conv, state.hexdigest()

    dealt = repaired.repartition("conv_id").sortWithinPartitions("conv_id", "pos", "seq")
    return _map(dealt.select("conv_id", "role", "text"), run, DIGESTS, DIGESTS_DDL)


EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()
COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def report(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """The summary and digest of every conv_id of ``conversations``; those without a turn have zeros."""
    summary, repaired = repair(turns)
    out = with_same(with_same(conversations.select("conv_id").distinct(), summary), digest(repaired))
    return out.select("conv_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in COLUMNS],
                      F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.lit(EMPTY_SHA256)).alias("repaired_sha256"))


def damage(conversations: DataFrame) -> DataFrame:
    """Rows dropped, emptied, shorn of sentence ends, repeated or given to the user, by a hash of conversation and turn."""
    t = own_columns(conversations, {c: c for c in ("conv_id", "turn", "role", "text")})
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind, text = F.crc32(name) % 20, F.coalesce("text", F.lit(" "))
    hurt = t.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
                    F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
                    F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("times"))
    again = hurt.filter("times > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times"))))
    return again.select("conv_id", "turn", "role", "text")
