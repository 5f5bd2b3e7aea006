"""Chat formatting with a grammar round trip: what is rendered is parsed again and escaped until the parse gives the source.

    conversation = turn*      turn = "### " role ":\\n" text "</turn>\\n"

Inside role and text a backslash makes the next character ordinary. A turn is first rendered as it is; where the parser gives back
something else (control strings, backslashes, colons or line ends in roles), the conflicting characters are escaped, then all of them,
until role and text come back identical. The text of assistants is under the loss mask.

Turns are rendered row by row. Reading back streams each conversation's turns in order (turn, role, text; nulls first) through a task,
in constant memory, however long the conversation is.

Defined results: null text and null role are empty, a null conv_id is a conversation of its own, repeated rows are repeated turns, other
columns are ignored, an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tabulens.llm.common import batches_of

OPEN, CLOSE, LEARNED = "### ", "</turn>\n", "assistant"
#: What can end a role and a text, or make the next character ordinary.
ROLE_ENDS, TEXT_ENDS = re.compile(r"[\\:\n]"), re.compile(r"\\|</turn>\n")
ESCAPED = re.compile(r"\\(.)", re.S)
#: What is escaped in (role, text), from nothing to everything that can conflict.
LEVELS = ((None, None), (re.compile(r"[\\:\n]"), re.compile(r"\\|<(?=/turn>)|(?<=#)#(?=# )")), (re.compile(r"[\\:\n#<]"), re.compile(r"[\\<#]")))


def parse(formatted: str) -> list[tuple[str, str, int, int]]:
    """(role, text, begin and end of the escaped text) of every turn; a ValueError if the string is no conversation."""
    turns, at = [], 0
    while at < len(formatted):
        if not formatted.startswith(OPEN, at):
            raise ValueError(f"no turn at character {at}")
        begin = at + len(OPEN)
        middle = _end(formatted, begin, ROLE_ENDS)
        if not formatted.startswith(":\n", middle):
            raise ValueError(f"no role at character {begin}")
        end = _end(formatted, middle + 2, TEXT_ENDS)
        turns.append((_plain(formatted[begin:middle]), _plain(formatted[middle + 2 : end]), middle + 2, end))
        at = end + len(CLOSE)
    return turns


def _end(formatted: str, at: int, ends: re.Pattern) -> int:
    """Where the part that begins at `at` ends: at the first match of `ends` that isn't escaped."""
    found = ends.search(formatted, at)
    while found and found.group() == "\\":
        found = ends.search(formatted, found.end() + 1)
    if not found:
        raise ValueError(f"no end of what begins at character {at}")
    return found.start()


def _plain(escaped: str) -> str:
    return ESCAPED.sub(r"\1", escaped) if "\\" in escaped else escaped


def render(role: str, text: str) -> str:
    """One turn, with as little escaped as needed."""
    for in_role, in_text in LEVELS:
        r = in_role.sub(r"\\\g<0>", role) if in_role else role
        t = in_text.sub(r"\\\g<0>", text) if in_text else text
        if in_text is None and "### " in text:
            continue  # a reader that looks for turn marks must find none inside a text
        formatted = f"{OPEN}{r}:\n{t}{CLOSE}"
        try:
            if [x[:2] for x in parse(formatted)] == [(role, text)]:
                return formatted
        except ValueError:
            pass
    raise ValueError("a turn can't be rendered")


def format_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, formatted): each turn's rendering; a conversation is the concatenation in that order."""

    def run(batches):
        for batch in batches_of(batches):
            out = [render(r, t) for r, t in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string())], [*batch.schema.names, "formatted"])

    source = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), *(F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text")))
    return source.mapInArrow(run, "conv_id long, turn long, role string, text string, formatted string")


class _Reader:
    """Digests of one conversation, read back turn by turn."""

    def __init__(self, conv_id):
        self.conv_id, self.n, self.chars, self.loss = conv_id, 0, 0, 0
        self.turns, self.learned = hashlib.sha256(), hashlib.sha256()

    def read(self, formatted: str) -> None:
        self.chars += len(formatted)
        for role, text, _, _ in parse(formatted):
            self.n += 1
            self.turns.update(f"{role}\n{text}\n".encode())
            if role == LEARNED:
                self.loss += len(text)
                self.learned.update(text.encode())

    def row(self) -> tuple:
        return self.conv_id, self.n, self.turns.hexdigest(), self.loss, self.learned.hexdigest(), self.chars


def read_back(turns: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) from the formatted turns alone."""
    types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches):
        reader, done = None, []
        for batch in batches_of(batches):
            for conv_id, formatted in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if reader is None or conv_id != reader.conv_id:
                    if reader:
                        done.append(reader.row())
                    reader = _Reader(conv_id)
                reader.read(formatted)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*done)) or [()] * 6, types)], names)
            done = []
        if reader:
            yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(reader.row(), types)], names)

    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "formatted")
    return ordered.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
