"""Chat formatting with a grammar round trip.

Template, one piece a turn (a conversation is its pieces in a row)::

    system     <<SYS>>\\n TEXT \\n<</SYS>>\\n\\n
    user       <s>[INST] TEXT [/INST]          (a space on either side of TEXT)
    assistant  " " TEXT " </s>"
    other      <|ROLE|> TEXT <|end|>           (no spaces)

A backslash in front of a character makes it plain text. Text must not hold a bare control string, so the first
bare control string after an opening ends the turn, and the parser needs no look-ahead.

Each turn is rendered plain, reparsed and compared with its source; if the result differs or doesn't parse, the
control strings and backslashes in it are escaped, and if that still differs, every character that can begin a
control string. The loss mask covers the text of assistant turns.

Rows are dealt by conversation and sorted on disk by turn; they stream past, so a conversation of any length
takes the memory of one batch plus one turn.

Defined cases: null text is empty, a null role is the empty role; turns with equal numbers are ordered by role,
then text, null first, and repeated rows stay; a null conv_id is a conversation of its own and stays null; other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaystone.llm.families import bounded_batches, id_of, key_of, rows_of

#: role -> (opening, closing)
TURNS = {
    "system": ("<<SYS>>\n", "\n<</SYS>>\n\n"),
    "user": ("<s>[INST] ", " [/INST]"),
    "assistant": (" ", " </s>"),
}
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|", "|>")
OTHER_OPEN, OTHER_MARK, OTHER_CLOSE = "<|", "|>", "<|end|>"
LOSS_ROLE = "assistant"

_control = "|".join(re.escape(c) for c in CONTROL)
_BARE = re.compile(rf"\\(?s:.)|({_control})")
_ESCAPE = re.compile(rf"\\|{_control}")
_BEGIN = re.compile(r"[\\<\[|]")
_PLAIN = re.compile(r"\\((?s:.))")
#: Most characters that the parser needs to tell how a turn begins.
_LOOK = max(len(o) for o, _ in TURNS.values())


class Incomplete(Exception):
    """The text ends inside a turn."""


def escape(text: str, level: int) -> str:
    if level == 0:
        return text
    return (_ESCAPE if level == 1 else _BEGIN).sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _PLAIN.sub(r"\1", text)


def _until(text: str, at: int, closing: str) -> tuple[int, int]:
    """(end of the body, end of the closing) for a body that begins at ``at``."""
    for m in _BARE.finditer(text, at):
        if m[1] is None:
            continue
        mark = next(c for c in CONTROL if c in closing)
        end = m.start() - closing.index(mark)
        if m[1] != mark or end < at or not closing.startswith(text[end:end + len(closing)]):
            raise ValueError(f"bare control string {m[1]!r}")
        if len(text) < end + len(closing):
            raise Incomplete
        return end, end + len(closing)
    raise Incomplete


def parse_turn(text: str, at: int) -> tuple[str, int, int, int]:
    """(role, start of the body, its end, end of the turn) of the turn that begins at ``at``."""
    for role, (opening, closing) in TURNS.items():
        if text.startswith(opening, at):
            begin = at + len(opening)
            return role, begin, *_until(text, begin, closing)
    if text.startswith(OTHER_OPEN, at):
        name_end, begin = _until(text, at + len(OTHER_OPEN), OTHER_MARK)
        return unescape(text[at + len(OTHER_OPEN):name_end]), begin, *_until(text, begin, OTHER_CLOSE)
    if len(text) - at < _LOOK:
        raise Incomplete
    raise ValueError("no turn begins here")


class Parser:
    """Turns of a conversation that comes in pieces; holds the unfinished turn only."""

    def __init__(self):
        self.rest = ""

    def feed(self, piece: str) -> Iterator[tuple[str, str]]:
        self.rest += piece
        at = 0
        try:
            while at < len(self.rest):
                role, begin, end, after = parse_turn(self.rest, at)
                yield role, unescape(self.rest[begin:end])
                at = after
        except Incomplete:
            pass
        self.rest = self.rest[at:]


def _marks(role: str, level: int) -> tuple[str, str]:
    return TURNS.get(role) or (OTHER_OPEN + escape(role, level) + OTHER_MARK, OTHER_CLOSE)


def render_turn(role: str, text: str) -> tuple[str, int, int, int]:
    """(piece, start of the text in it, its end, escaping used); the piece parses back to role and text."""
    for level in (0, 1, 2):
        opening, closing = _marks(role, level)
        body = escape(text, level)
        piece = opening + body + closing
        try:
            back, begin, end, after = parse_turn(piece, 0)
        except (Incomplete, ValueError):
            continue
        if (back, unescape(piece[begin:end]), after) == (role, text, len(piece)):
            return piece, begin, end, level
    raise AssertionError(f"no escaping keeps {role!r} {text!r}")


def chat_format(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn_no, formatted, text_start, text_end, in_loss, escaping): one row a turn in the
    conversation's order, from 0; text_start and text_end are code points of the conversation's whole text.
    Rows of a conversation lie in one partition in order."""
    bounded_batches(conversations.sparkSession)
    rows = conversations.select(key_of("conv_id").alias("conv"), F.col("turn").cast("long").alias("turn"),
                                F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    rows = rows.repartition("conv").sortWithinPartitions("conv", "turn", "role", "text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, number, chars = None, 0, 0
        for batch in batches:
            out = {k: [] for k in ("no", "formatted", "start", "end", "loss", "escaping")}
            for now, role, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(),
                                       batch.column(3).to_pylist()):
                if now != conv:
                    conv, number, chars = now, 0, 0
                piece, begin, end, level = render_turn(role or "", text or "")
                for k, v in zip(out, (number, piece, chars + begin, chars + end, role == LOSS_ROLE, level)):
                    out[k].append(v)
                number += 1
                chars += len(piece)
            yield rows_of(conv=batch.column(0), turn_no=pa.array(out["no"], pa.int64()),
                          formatted=pa.array(out["formatted"], pa.string()),
                          text_start=pa.array(out["start"], pa.int64()), text_end=pa.array(out["end"], pa.int64()),
                          in_loss=pa.array(out["loss"], pa.bool_()), escaping=pa.array(out["escaping"], pa.int32()))

    out = rows.mapInArrow(work, "conv long, turn_no long, formatted string, text_start long, text_end long, "
                                "in_loss boolean, escaping int")
    return out.select(id_of("conv").alias("conv_id"), *out.columns[1:])


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of the rows of :func:`chat_format`, as they lie in its partitions: turns from the parser, the text
    under the loss mask from the mask's places."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None

        def row() -> pa.RecordBatch:
            conv, parser, turns, n, loss, n_loss, chars = state
            if parser.rest:
                raise ValueError(f"conversation {conv} ends inside a turn")
            return rows_of(conv_id=pa.array([conv], pa.int64()), n_turns=pa.array([n], pa.int64()),
                           turns_sha256=pa.array([turns.hexdigest()]), loss_chars=pa.array([n_loss], pa.int64()),
                           loss_sha256=pa.array([loss.hexdigest()]), formatted_chars=pa.array([chars], pa.int64()))

        for batch in batches:
            out = []
            for conv, piece, start, end, masked, number in zip(*(
                    batch.column(c).to_pylist() for c in ("conv_id", "formatted", "text_start", "text_end", "in_loss",
                                                          "turn_no"))):
                if number == 0:
                    if state is not None:
                        out.append(row())
                    state = [conv, Parser(), hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                for role, text in state[1].feed(piece):
                    state[2].update(f"{role}\n{text}\n".encode())
                    state[3] += 1
                if masked:
                    text = unescape(piece[start - state[6]:end - state[6]])
                    state[4].update(text.encode())
                    state[5] += len(text)
                state[6] += len(piece)
            if out:
                yield pa.Table.from_batches(out).combine_chunks().to_batches()[0]
        if state is not None:
            yield row()

    return formatted.mapInArrow(work, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                      "loss_sha256 string, formatted_chars long")
