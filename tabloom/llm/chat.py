"""Chat formatting from event logs.

A log row has a conversation, its place in the conversation's sequence, the message it
speaks of, and what happened: ``start`` (with the role), a streamed ``delta``, an ``edit``
that replaces the text so far, or ``regenerate``, which discards it together with every
message that was started after it until then. Events may come late, between those of
other messages: a message's events count in the order of ``seq``, messages in the order
of their first start. Logs are partitioned by conversation, sorted, and folded as a
stream: one message is held at a time, so a conversation with a third of all events
needs no more memory than a short one.

The template writes each turn as ``<s>role[INST]text</s>``. Control strings that
occur inside a role or text are split by a backslash (and backslashes doubled),
so that the output parses back to the same turns.

Defined cases: a null text or payload is empty, a null role is the empty role; rows of
one turn number are ordered by role, then the MD5 of their text; repeated rows are turns
of their own; a null conversation or message is one of its own; a second start begins
its message anew; events of a message without a start, before it, or of an unknown kind
change nothing (``faulty_events`` names them); extra columns are ignored; an empty table
formats to nothing.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabloom.llm.common import own_columns

OPEN, BODY, CLOSE = "<s>", "[INST]", "</s>"
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]")
TRAINED = "assistant"
DELTA_CHARS = 400

_escape = re.compile(r"\\|" + "|".join(re.escape(c) for c in CONTROLS))
_unescape = re.compile(r"\\(\\?)")

RENDERED = pa.schema([("conv_id", pa.int64()), ("turn_index", pa.int64()), ("offset", pa.int64()), ("piece", pa.string()),
                      ("loss_start", pa.int64()), ("loss_length", pa.int64())])
RENDERED_DDL = "conv_id long, turn_index long, offset long, piece string, loss_start long, loss_length long"
DIGESTS = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                     ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
DIGESTS_DDL = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
               "formatted_chars long")


def escape(text: str) -> str:
    return _escape.sub(lambda m: "\\\\" if m[0] == "\\" else m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return _unescape.sub(r"\1", text) if "\\" in text else text


def parse(piece: str) -> tuple[str, str]:
    """(role, text) of one written turn."""
    body = piece.index(BODY)
    if not piece.startswith(OPEN) or piece.find(CLOSE) != len(piece) - len(CLOSE):
        raise ValueError("not a turn of this template")
    return unescape(piece[len(OPEN):body]), unescape(piece[body + len(BODY): -len(CLOSE)])


KINDS = ("start", "delta", "edit", "regenerate")
_STEP_BITS = 21  # places in the sequence that a message's own events have


def event_log(turns: DataFrame, delta_chars: int = DELTA_CHARS) -> DataFrame:
    """The events (conv_id, seq, message, kind, payload) that lead to ``turns`` (conv_id, turn, role, text).

    As a chat server would log them: texts are streamed in parts; some messages are generated twice,
    the first time followed by one that the second generation drops; some are edited at their end, some
    only while the next message is being written.
    """
    t = own_columns(turns, {c: c for c in ("conv_id", "turn", "role", "text")}).select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    # rows of a conversation are numbered where they meet, and stay there
    place = F.row_number().over(W.partitionBy("conv_id").orderBy("turn", "role", F.md5("text")))
    t = t.withColumn("n", place.cast("long")).select("conv_id", "role", "text", "n")
    t = t.withColumns({"mark": F.pmod(F.xxhash64("text"), F.lit(8)), "parts": F.ceil(F.length("text") / delta_chars).cast("int")})
    own, ghost = 2 * F.col("n"), 2 * F.col("n") + 1

    def event(kind: str, payload: Column, message: Column = own, late: bool = False) -> Column:
        return F.struct(message.alias("message"), F.lit(kind).alias("kind"), payload.cast("string").alias("payload"), F.lit(late).alias("late"))

    nothing, whole = F.lit(None), F.col("text")
    none = F.array().cast("array<struct<message:bigint,kind:string,payload:string,late:boolean>>")
    deltas = F.when(F.col("parts") > 0, F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1),
        lambda k: event("delta", whole.substr(k * delta_chars + 1, F.lit(delta_chars))))).otherwise(none)
    twice = F.array(event("delta", F.lit("draft")), event("start", F.lit("user"), ghost), event("delta", F.lit("an answer to it"), ghost),
                    event("regenerate", nothing))
    edited = F.array(event("delta", F.lit(" (typo)")), event("edit", whole))
    late = F.array(event("delta", F.lit(" (typo)")), event("edit", whole, late=True))
    mark = F.col("mark")
    events = F.concat(F.array(event("start", F.col("role"))), F.when(mark == 1, twice).otherwise(none), deltas,
                      F.when(mark == 2, edited).when(mark == 3, late).otherwise(none))
    long = t.select("conv_id", "n", F.posexplode(events).alias("step", "e"))
    # a late event comes after all of the next message's own
    seq = F.shiftleft(F.col("n") + F.col("e.late").cast("long"), _STEP_BITS) + F.col("step") + F.when(
        F.col("e.late"), 1 << (_STEP_BITS - 1)).otherwise(0)
    return long.select("conv_id", seq.alias("seq"), "e.message", "e.kind", "e.payload")


def _with_start(events: DataFrame) -> DataFrame:
    """``events`` with ``start``: the place of their message's first start, null if it has none."""
    e = own_columns(events, {c: c for c in ("conv_id", "seq", "message", "kind", "payload")})
    first = F.min(F.when(F.col("kind") == "start", F.col("seq")))
    return e.withColumn("start", first.over(W.partitionBy("conv_id", "message")))


def faulty_events(events: DataFrame) -> DataFrame:
    """The events that change nothing: of unknown kind, of a message without a start, or before it."""
    fine = F.col("kind").isin(*KINDS) & (F.col("seq") >= F.col("start"))
    return _with_start(events).filter(~F.coalesce(fine, F.lit(False))).drop("start")


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _batched(rows: Iterator[tuple], schema: pa.Schema, limit: int = 2000) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= limit:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _standing(events: Iterator[tuple]) -> Iterator[tuple[int | None, str, str | None]]:
    """(conversation, kind, payload) of the events of messages that no regeneration dropped.

    ``events``: conv_id, start, message, seq, kind, payload, sorted by the first four.
    A message's first event is its ``start``, another one in it is a ``restart``.
    """
    conv, message, dropped_until, stands = (), None, -1, False
    for conv_id, start, number, seq, kind, payload in events:
        fresh = (conv_id,) != conv or (start, number) != message
        if fresh:
            if (conv_id,) != conv:
                conv, dropped_until = (conv_id,), -1
            message, stands = (start, number), start > dropped_until
        if not stands:
            continue
        if kind == "start":
            kind = "start" if fresh else "restart"
        elif fresh:
            yield conv_id, "start", None
        if kind == "regenerate":
            dropped_until = max(dropped_until, seq)
        yield conv_id, kind, payload


def _messages(events: Iterator[tuple]) -> Iterator[tuple[int | None, str, str]]:
    """(conversation, role, text) of each message, in order; ``events``: conversation, kind, payload."""
    conv, role, parts = None, None, []
    for conv_id, kind, payload in events:
        if kind == "delta":
            parts.append(payload or "")
        elif kind == "start":
            if role is not None:
                yield conv, role, "".join(parts)
            conv, role, parts = conv_id, payload or "", []
        elif kind == "restart":
            role, parts = payload or "", []
        elif kind == "edit":
            parts = [payload or ""]
        else:  # regenerate
            parts = []
    if role is not None:
        yield conv, role, "".join(parts)


def _render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        before, index, offset = object(), 0, 0
        for conv, role, text in _messages(_standing(_rows(batches))):
            if conv != before:
                before, index, offset = conv, 0, 0
            head, body = OPEN + escape(role) + BODY, escape(text)
            piece = head + body + CLOSE
            yield conv, index, offset, piece, offset + len(head), len(body) if role == TRAINED else 0
            index, offset = index + 1, offset + len(piece)

    return _batched(rows(), RENDERED)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        conv, state = None, None
        for conv_id, index, offset, piece, loss_start, loss_length in _rows(batches):
            if index == 0:
                if state:
                    yield conv, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]
                conv, state = conv_id, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            role, text = parse(piece)
            state[0] += 1
            state[1].update(f"{role}\n{text}\n".encode())
            if loss_length:
                masked = unescape(piece[loss_start - offset: loss_start - offset + loss_length])
                state[2] += len(masked)
                state[3].update(masked.encode())
            state[4] += len(piece)
        if state:
            yield conv, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]

    return _batched(rows(), DIGESTS)


def render(events: DataFrame, together: bool = False) -> DataFrame:
    """One row per turn, in order within its partition: the written ``piece``, its place in the
    conversation's output, and the range under the loss mask (empty but for trained turns).

    A conversation's formatted text is its pieces one after another. ``together`` says that
    the rows of a conversation are in one partition already, as ``event_log`` leaves them.
    """
    dealt = _with_start(events if together else events.repartition("conv_id"))  # messages lie within conversations
    fine = dealt.filter(F.col("kind").isin(*KINDS) & (F.col("seq") >= F.col("start")))
    ordered = fine.sortWithinPartitions("conv_id", "start", "message", "seq")
    return ordered.select("conv_id", "start", "message", "seq", "kind", "payload").mapInArrow(_render, RENDERED_DDL)


def read_back(rendered: DataFrame, together: bool = False) -> DataFrame:
    """Per conversation, what its formatted text parses back to; ``rendered`` in any order, from a stored table as
    well, or ``together`` as ``render`` leaves it."""
    rows = rendered.select(*[f.name for f in RENDERED])
    dealt = rows if together else rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn_index")
    return dealt.mapInArrow(_digest, DIGESTS_DDL)
