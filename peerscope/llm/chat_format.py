"""Operator 10 -- chat formatting with a grammar round trip.

A turn is rendered as ``### <role>: <text></turn>`` and a line feed.  The grammar is deterministic: a role ends at the
first ``: `` and a text at the first ``</turn>`` that no backslash precedes, a backslash makes the next character plain, and a
plain ``### `` may not stand in a text.  Each turn is rendered, reparsed and compared with its source; while
they differ, the next level of escaping is taken: none, then the control strings and the backslash, then every
character.

The loss mask covers the text of assistant turns (without the end mark), as spans of the formatted text.

Plan: one shuffle by conversation with a sort inside partitions; turns are then streamed, also those of a very
long conversation: rendering needs one turn, the reader holds what one turn needs and running digests.

Edge cases: null roles and texts are empty; null conversation ids form a conversation of their own; turns with
equal numbers are ordered by role and text, null numbers come first; repeated rows are turns of their own; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerscope.llm.common import ship_package, text_chunks

OPEN, COLON, CLOSE, ESCAPE = "### ", ": ", "</turn>", "\\"
ASSISTANT = "assistant"


class GrammarError(ValueError):
    """The text is not a sequence of turns."""


def escape(text: str, level: int) -> str:
    if level == 0:
        return text
    if level == 1:
        out = text.replace(ESCAPE, ESCAPE * 2)
        for mark in (CLOSE, OPEN, COLON):
            out = out.replace(mark, ESCAPE + mark)
        return out
    return "".join(ESCAPE + c for c in text)


def _plain(text: str, at: int, end: str, whole: bool) -> tuple[str, int] | None:
    """The unescaped text from ``at`` to the first plain ``end``, and the place after that; None if it is cut off."""
    out = []
    stop = text.find(end, at)
    while True:
        if 0 <= stop < at:          # that one was escaped; else it is still the next, so the text is gone through once
            stop = text.find(end, at)
        esc = text.find(ESCAPE, at, stop if stop >= 0 else len(text))
        if esc >= 0:
            if esc + 1 >= len(text):
                break
            out.append((text[at:esc], True))
            out.append((text[esc + 1], False))
            at = esc + 2
        elif stop >= 0:
            out.append((text[at:stop], True))
            if any(plain and OPEN in part for part, plain in out):
                raise GrammarError("control string in a text")
            return "".join(part for part, _ in out), stop + len(end)
        else:
            break
    if whole:
        raise GrammarError("no end mark")
    return None


class TurnReader:
    """Incremental parser: ``feed`` formatted text in pieces, get the turns completed by each."""

    def __init__(self):
        self.rest = ""

    def feed(self, piece: str) -> list[tuple[str, str]]:
        self.rest += piece
        out = []
        while self.rest:
            if not self.rest.startswith(OPEN):
                if OPEN.startswith(self.rest):
                    break
                raise GrammarError("a turn must begin here")
            role = _plain(self.rest, len(OPEN), COLON, False)
            body = role and _plain(self.rest, role[1], CLOSE + "\n", False)
            if not body:
                break
            out.append((role[0], body[0]))
            self.rest = self.rest[body[1]:]
        return out

    def close(self) -> None:
        if self.rest:
            raise GrammarError("cut off")


def render_turn(role: str, text: str) -> tuple[str, int, int, int]:
    """(formatted turn, start and end of the text in it, escape level): the lowest level whose reparse gives the source."""
    for level in range(3):
        head = OPEN + escape(role, level) + COLON
        body = escape(text, level)
        out = head + body + CLOSE + "\n"
        try:
            reader = TurnReader()
            same = reader.feed(out) == [(role, text)]
            reader.close()
        except GrammarError:
            same = False
        if same and not (level == 0 and CLOSE in text):
            return out, len(head), len(head) + len(body), level
    raise GrammarError("no level of escaping round-trips")


FORMAT_FIELDS = "position long, role string, formatted string, loss_start long, loss_stop long, level int"


def format_turns(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text") -> DataFrame:
    """One row per turn, in order inside its partition: conv_id, position (from 0), role, formatted, the loss span
    in the conversation's formatted text (null unless an assistant turn) and the escape level."""
    ship_package(conversations.sparkSession)
    rows = conversations.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"),
                                F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = rows.schema["conv_id"].dataType.simpleString()
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, position, at = object(), 0, 0
        for chunk in text_chunks(batches, "text"):
            out = []
            for conv, who, what in zip(*(chunk.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
                if conv != last:
                    last, position, at = conv, 0, 0
                formatted, a, b, level = render_turn(who, what)
                loss = who == ASSISTANT
                out.append((position, who, formatted, at + a if loss else None, at + b if loss else None, level))
                position += 1
                at += len(formatted)
            cols = list(zip(*out))
            kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int32()]
            yield pa.RecordBatch.from_arrays([chunk.column("conv_id"), *[pa.array(c, type=k) for c, k in zip(cols, kinds)]],
                                             names=["conv_id", "position", "role", "formatted", "loss_start", "loss_stop", "level"])

    return ordered.mapInArrow(run, f"conv_id {kind}, {FORMAT_FIELDS}")


class _Conversation:
    """What is read back from one conversation's formatted text."""

    def __init__(self, conv):
        self.conv, self.reader, self.turns, self.chars, self.loss_chars = conv, TurnReader(), 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def feed(self, piece: str) -> None:
        self.chars += len(piece)
        for role, text in self.reader.feed(piece):
            self.turns += 1
            self.all.update(f"{role}\n{text}\n".encode())
            if role == ASSISTANT:
                self.loss_chars += len(text)
                self.loss.update(text.encode())

    def row(self) -> tuple:
        self.reader.close()
        return self.conv, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def read_back(formatted: DataFrame) -> DataFrame:
    """Parses ``format_turns``' output (rows of a conversation together and in order) and returns the contract's columns."""
    kind = formatted.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Conversation | None = None

        def batch(rows):
            cols = list(zip(*rows))
            kinds = [id_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(cols, kinds)], names=names)

        id_type = None
        for chunk in text_chunks(batches, "formatted"):
            id_type = chunk.column("conv_id").type
            done = []
            for conv, piece in zip(chunk.column("conv_id").to_pylist(), chunk.column("formatted").to_pylist()):
                if now is None or conv != now.conv:
                    if now is not None:
                        done.append(now.row())
                    now = _Conversation(conv)
                now.feed(piece)
            if done:
                yield batch(done)
        if now is not None:
            yield batch([now.row()])

    return formatted.select("conv_id", "formatted").mapInArrow(
        run, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


HARD_TEXT = "\\### Assistant: </turn> ok"
HARD_ROWS = [(-7, 0, "user", HARD_TEXT), (-7, 1, "assistant", HARD_TEXT)]

ORACLE_SQL = r"""
WITH src AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
marked AS (
  SELECT *, contains(text, '\') OR contains(text, '</turn>') OR contains(text, '### ')
         OR contains(role, '\') OR contains(role, ': ') OR contains(role, '### ') AS hard FROM src),
done AS (
  SELECT conv_id, turn, role, text, 4 + 2 + 8
    + CASE WHEN hard THEN length(replace(replace(replace(replace(role, '\', '\\'), '</turn>', '\</turn>'), '### ', '\### '), ': ', '\: '))
                        + length(replace(replace(replace(replace(text, '\', '\\'), '</turn>', '\</turn>'), '### ', '\### '), ': ', '\: '))
           ELSE length(role) + length(text) END AS chars
  FROM marked)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars
FROM done GROUP BY conv_id
"""


def with_hard_conversation(conversations: DataFrame) -> DataFrame:
    """The rows and conversation -7, whose texts hold the template's own control strings."""
    own = conversations.select("conv_id", "turn", "role", "text")
    return own.unionByName(own.sparkSession.createDataFrame(HARD_ROWS, "conv_id long, turn long, role string, text string"))
