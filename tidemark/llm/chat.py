r"""Chat formatting with a grammar round trip (operator 12).

A formatted conversation is a run of turns, each ``<|im_start|>role``, a line feed, the text, ``<|im_end|>`` and a line feed.
The parser of this grammar is deterministic and needs no look-ahead past a turn: a role ends at its line feed, a text
at the first end mark, and any other mark is an error. One backslash more than in the source, after the ``<`` of a
mark, makes it text (``<\|im_end|>``, and ``<\\|im_end|>`` for a source that already says ``<\|im_end|>``).

Nothing is escaped beforehand. The turns are rendered as they are, the output is parsed again and compared with the
source; the turns that do not come back alone are escaped, and the whole is parsed again until it is identical.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The marks of the template, and the role whose texts are learnt.
START, END = "<|im_start|>", "<|im_end|>"
LEARNT = "assistant"
#: A part of a conversation ends with the turn that fills so many code points: what a task holds at once.
PART_POINTS = 1 << 20
ORDER = ("turn", "role", "text")

Turn = tuple[str, str]
_MARK = re.compile(r"<(\\*\|im_(?:start|end)\|>)")
_ESCAPED_MARK = re.compile(r"<\\(\\*\|im_(?:start|end)\|>)")
_ROLE_ESCAPE = re.compile(r"\\([\\n])")


def escaped_text(text: str) -> str:
    return _MARK.sub(r"<\\\1", text)


def plain_text(written: str) -> str:
    return _ESCAPED_MARK.sub(r"<\1", written) if "|im_" in written else written


def escaped_role(role: str) -> str:
    """A role stands on one line, so its line feeds and backslashes are escaped as well."""
    return escaped_text(role.replace("\\", "\\\\").replace("\n", "\\n"))


def plain_role(written: str) -> str:
    return _ROLE_ESCAPE.sub(lambda m: "\n" if m[1] == "n" else "\\", plain_text(written))


def render(turns: Iterable[Turn]) -> str:
    return "".join(f"{START}{role}\n{text}{END}\n" for role, text in turns)


def parse(formatted: str) -> list[tuple[str, str, int, int]] | None:
    """``role, text, start, end`` of each turn, unescaped, with the place of its written text; ``None`` if it is no output."""
    turns, at = [], 0
    while at < len(formatted):
        line = formatted.find("\n", at)
        stop = formatted.find(END, line + 1)
        if not formatted.startswith(START, at) or line < 0 or stop < 0 or not formatted.startswith("\n", stop + len(END)):
            return None
        role, text = formatted[at + len(START) : line], formatted[line + 1 : stop]
        if START in text or START in role or END in role:
            return None
        turns.append((plain_role(role), plain_text(text), line + 1, stop))
        at = stop + len(END) + 1
    return turns


def comes_back(written: list[Turn], source: list[Turn]) -> list[tuple[str, str, int, int]] | None:
    """The recovered turns if they are those of the source."""
    found = parse(render(written))
    return found if found is not None and [(role, text) for role, text, _, _ in found] == source else None


def formatted_turns(source: list[Turn]) -> tuple[str, list[tuple[int, int]]]:
    """The text from which the parser recovers ``source``, and the spans of the texts to learn."""
    written = source
    found = comes_back(written, source)
    if found is None:
        written = [t if comes_back([t], [t]) else (escaped_role(t[0]), t[1]) for t in source]
        written = [w if comes_back([w], [t]) else (w[0], escaped_text(t[1])) for w, t in zip(written, source)]
        found = comes_back(written, source)
        if found is None:
            raise ValueError("a formatted conversation does not come back as its source")
    return render(written), [(start, end) for role, _, start, end in found if role == LEARNT]


SPANS = "array<struct<start: bigint, end: bigint>>"


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):  # few rows at a time become Python objects
            yield from zip(*(column.to_pylist() for column in batch.slice(at, 256).columns))


def _parts(rows: Iterator[tuple], points: int) -> Iterator[tuple]:
    """Ordered turns to parts: conversation, part, is it the last, code points before it, turns, text, spans."""
    conv, part, before, turns, size = None, 0, 0, [], 0

    def cut(last: bool) -> tuple:
        text, spans = formatted_turns(turns)
        return (conv, part, last, before, len(turns), text, [{"start": a, "end": b} for a, b in spans])

    for this, role, text in rows:
        if turns and (this != conv or size >= points):
            done = cut(this != conv)
            yield done
            part, before = (part + 1, before + len(done[5])) if this == conv else (0, 0)
            turns, size = [], 0
        conv = this
        turns.append((role or "", text or ""))
        size += len(turns[-1][0]) + len(turns[-1][1])
    if turns:
        yield cut(True)


def _batches(rows: Iterable[tuple], schema: pa.Schema, held: int, points: int = PART_POINTS) -> Iterator[pa.RecordBatch]:
    """Rows as batches; ``held`` is the column whose texts bound a batch."""
    ready, size = [], 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*ready), schema)], schema=schema)

    for row in rows:
        ready.append(row)
        size += len(row[held] or "")
        if size >= points or len(ready) >= 1000:
            yield batch()
            ready, size = [], 0
    if ready:
        yield batch()


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def format_chats(conversations: DataFrame, part_points: int = PART_POINTS) -> DataFrame:
    """The conversations in the template, with the spans to learn.

    Needs ``conv_id, turn, role, text``; other columns are not read. Returns ``conv_id, part, last, before, turns, formatted,
    loss``: the parts of a conversation, joined in order, are its text; nearly all have one part, and a longer one is cut
    after whole turns, so that no task holds more than a part. ``loss`` lists the code-point spans of the part's
    assistant texts, end exclusive, escapes included; ``before`` counts the code points of earlier parts.

    Rows are ordered by ``turn`` (null first), then role and text. A null role or text is empty; rows with a null
    ``conv_id`` are one conversation; repeated rows are repeated turns. An empty table gives no rows.

    The turns of one conversation stream through one task in order, in bounded memory.
    """
    key = conversations.schema["conv_id"]
    schema = T.StructType().add("conv_id", key.dataType).add("part", "long").add("last", "boolean").add("before", "long")
    schema = schema.add("turns", "long").add("formatted", "string").add("loss", T.DataType.fromDDL(SPANS))
    arrow = _arrow(schema)

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(_parts(_rows(batches), part_points), arrow, held=5)

    ordered = conversations.select("conv_id", *ORDER).repartition("conv_id").sortWithinPartitions("conv_id", *ORDER)
    return ordered.select("conv_id", "role", "text").mapInArrow(assemble, schema)


def _digests(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Digests of conversations from their parts in order."""
    conv, open_ = None, False
    for this, part, last, formatted, loss in rows:
        if part == 0:
            if open_:
                raise ValueError("a conversation lacks its last part")
            conv, open_ = this, True
            turns, learnt, counts = hashlib.sha256(), hashlib.sha256(), [0, 0, 0]
        elif this != conv or not open_:
            raise ValueError("a conversation lacks a part")
        found = parse(formatted)
        if found is None:
            raise ValueError("not in the template")
        for role, text, _, _ in found:
            turns.update(f"{role}\n{text}\n".encode())
        for span in loss or ():
            text = plain_text(formatted[span["start"] : span["end"]])
            learnt.update(text.encode())
            counts[1] += len(text)
        counts[0] += len(found)
        counts[2] += len(formatted)
        if last:
            yield (this, counts[0], turns.hexdigest(), counts[1], learnt.hexdigest(), counts[2])
            open_ = False
    if open_:
        raise ValueError("a conversation lacks its last part")


def read_back(chats: DataFrame) -> DataFrame:
    """What the output of :func:`format_chats` says, parsed again: one row per conversation.

    Returns ``conv_id, n_turns, turns_sha256`` (of role, line feed, text, line feed per turn), ``loss_chars, loss_sha256`` (of
    the texts under the loss spans, unescaped and joined) and ``formatted_chars``. Conversations of one part are read where they
    lie; only the parts of others are brought together. A text that is no output of the template raises.
    """
    schema = T.StructType().add("conv_id", chats.schema["conv_id"].dataType).add("n_turns", "long").add("turns_sha256", "string")
    schema = schema.add("loss_chars", "long").add("loss_sha256", "string").add("formatted_chars", "long")
    arrow = _arrow(schema)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(_digests(_rows(batches)), arrow, held=2)

    parts = chats.select("conv_id", "part", "last", "formatted", "loss")
    whole = (F.col("part") == 0) & F.col("last")
    longer = parts.where(~whole).repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return parts.where(whole).mapInArrow(digest, schema).unionByName(longer.mapInArrow(digest, schema))
