"""Format conversations with a template, proven by reading them back.

A turn becomes one segment; a conversation's text is its segments in order.

    user       [INST] text [/INST]
    assistant  <s> text </s>
    system     <<SYS>> text <</SYS>>
    any other  [ROLE] role [/ROLE] text [/TURN]

Inside texts, a control string stands behind one more backslash than in the source;
the parser takes one away.  A segment is first rendered as it is and parsed; only if
the parser does not give the same turn back is its content escaped, and the result is
parsed and compared again.

Conversations of any length are streamed: rows are partitioned by conversation and
sorted by turn, and only running digests are held.

Defined cases: a NULL text or role is empty; a NULL turn comes last; rows with one
turn number follow in order of role and text; rows without a conversation id form one
conversation; an empty table gives an empty result.  Only the named columns are read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The template's control strings.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]", "[/TURN]")
BRACKETS = {"user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>"), "system": ("<<SYS>>", "<</SYS>>")}

OPENERS = {opener: (role, closer) for role, (opener, closer) in BRACKETS.items()}
CONTROL = re.compile(r"(\\*)(" + "|".join(re.escape(c) for c in CONTROLS) + ")")
LEVELS = 2


class TemplateError(ValueError):
    """Text that the grammar does not derive, or a turn that cannot be recovered."""


def escape(text: str) -> str:
    return CONTROL.sub(lambda m: "\\" + m.group(), text)


def unescape(text: str) -> str:
    return CONTROL.sub(lambda m: m.group()[1:] if m.group(1) else m.group(), text)


def render(role: str, text: str, level: int) -> tuple[str, int, int]:
    """A turn's segment and where its text begins and ends in it."""
    body = escape(text) if level else text
    if role in BRACKETS:
        opener, closer = BRACKETS[role]
        head = f"{opener} "
    else:
        head, closer = f"[ROLE] {escape(role)} [/ROLE] ", "[/TURN]"
    return f"{head}{body} {closer}", len(head), len(head) + len(body)


def parse(formatted: str) -> Iterator[tuple[str, str]]:
    """The turns of a formatted text; deterministic, one token ahead at most."""
    marks = [(m.start(2), m.group(2)) for m in CONTROL.finditer(formatted) if not m.group(1)]
    at, place = 0, 0

    def take(expected: str | None) -> tuple[int, str]:
        nonlocal place
        if place == len(marks) or expected not in (None, marks[place][1]):
            raise TemplateError(f"{expected or 'a control string'} is missing")
        place += 1
        return marks[place - 1]

    def body(closer: str) -> str:
        nonlocal at
        end, _ = take(closer)
        inner = formatted[at:end]
        if len(inner) < 2 or inner[0] != " " or inner[-1] != " ":
            raise TemplateError("a text is not set off by blanks")
        at = end + len(closer)
        return unescape(inner[1:-1])

    while at < len(formatted):
        start, opener = take(None)
        if start != at:
            raise TemplateError("text outside of a turn")
        at = start + len(opener)
        if opener in OPENERS:
            role, closer = OPENERS[opener]
            yield role, body(closer)
        elif opener == "[ROLE]":
            role = body("[/ROLE]")
            yield role, body("[/TURN]")
        else:
            raise TemplateError(f"{opener} opens no turn")


def parses_to(formatted: str, role: str, text: str) -> bool:
    try:
        return list(parse(formatted)) == [(role, text)]
    except TemplateError:
        return False


def format_turn(role: str, text: str) -> tuple[str, int, int, int]:
    """The least escaped segment that reads back as the turn, its text's bounds, the level."""
    for level in range(LEVELS):
        segment, start, end = render(role, text, level)
        if parses_to(segment, role, text):
            return segment, start, end, level
    raise TemplateError(f"no rendering of {text[:80]!r} reads back")


SEGMENTS = "conv_id long, position long, segment string, text_start long, text_end long, loss boolean, level int"


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    current, position = None, 0
    for batch in batches:
        rows = batch.to_pydict()
        out: dict[str, list] = {k: [] for k in ("conv_id", "position", "segment", "text_start", "text_end", "loss", "level")}
        for conv, role, text in zip(rows["conv_id"], rows["role"], rows["text"], strict=True):
            if position == 0 or conv != current:
                current, position = conv, 0
            segment, start, end, level = format_turn(role, text)
            for name, value in zip(out, (conv, position, segment, start, end, role == "assistant", level), strict=True):
                out[name].append(value)
            position += 1
        types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.int32())
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), types, strict=True)], list(out))


def format_conversations(
    turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row for each turn: its segment, its text's bounds in it, and whether it is learnt.

    Rows of a conversation stay together and in order within a partition.
    """
    rows = turns.select(
        turns[f"`{conv_id}`"].cast("long").alias("conv_id"),
        turns[f"`{turn}`"].alias("turn"),
        F.coalesce(turns[f"`{role}`"], F.lit("")).alias("role"),
        F.coalesce(turns[f"`{text}`"], F.lit("")).alias("text"),
    )
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_last(), "role", "text")
    return ordered.mapInArrow(_segments, SEGMENTS)


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, escaped long"


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    done: list[tuple] = []
    state: dict | None = None

    def close() -> None:
        if state is not None:
            done.append((state["conv"], state["turns"], state["all"].hexdigest(), state["chars"], state["loss"].hexdigest(), state["formatted"], state["escaped"]))

    def packed() -> pa.RecordBatch:
        types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
        names = [part.split()[0] for part in DIGESTS.split(", ")]
        columns = list(zip(*done, strict=True)) if done else [[] for _ in names]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    for batch in batches:
        rows = batch.to_pydict()
        for conv, position, segment, start, end, loss, level in zip(*rows.values(), strict=True):
            if state is None or position == 0:
                close()
                state = {"conv": conv, "turns": 0, "all": hashlib.sha256(), "chars": 0, "loss": hashlib.sha256(), "formatted": 0, "escaped": 0}
            for role, text in parse(segment):
                state["turns"] += 1
                state["all"].update(f"{role}\n{text}\n".encode())
            if loss:
                learnt = unescape(segment[start:end])
                state["chars"] += len(learnt)
                state["loss"].update(learnt.encode())
            state["formatted"] += len(segment)
            state["escaped"] += bool(level)
        if done:
            yield packed()
            done.clear()
    close()
    if done:
        yield packed()


def read_back(segments: DataFrame) -> DataFrame:
    """Digests of each conversation as the parser recovers it from its segments.

    Expects the rows as :func:`format_conversations` lays them out.
    """
    return segments.mapInArrow(_digests, DIGESTS)
