"""Chat formatting with a grammar round trip: what is rendered is parsed again, and escaped until it reads back right.

Template: a turn is ``<|turn|>``, the role, a line feed, the text, ``<|end|>`` and a line feed; a conversation is its
turns one after another. Control strings inside roles and texts are escaped reversibly by one marker character that is
put behind the ``<`` they begin with; markers themselves are escaped by doubling where text is escaped at all.

* **Grammar.** ``parse`` is a deterministic reader of that template: it knows only the control strings, finds turns, and
  takes the escapes back. It is used on the output, not on what went in.
* **Round trip.** A turn is first rendered as it is. If parsing it does not give exactly its role and text back, its
  content is escaped one level more and rendered again. Levels go up to two: conflicting control strings, then everything
  that the reader could take for a control string or an escape. The last one is right for any text, by construction and
  by test; a turn that still differed would be an error, never silent.
* **Loss mask.** The spans (start, end) of assistant texts in the formatted conversation, in code points.

A conversation's turns come in order of turn, role and text, from a sort inside partitions, so a conversation of any
length is read as a stream; no task holds one. Each turn is one output row, whose ``formatted`` is its stretch of the
conversation; the summary reads those stretches as a stream again, with running digests.

Defined cases: null texts and roles are empty. Rows with a null conv_id form one conversation with that id. Null turns
come first; repeated rows are repeated turns. Empty tables give empty results. Extra columns are not carried.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed values of the template.
OPEN, CLOSE = "<|turn|>", "<|end|>"
MARK = "⁠"
TRAINED = "assistant"
#: Control strings of widespread templates, also kept out of texts in escaped form so that no tokenizer sees them.
FOREIGN = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>")

CONTROL = re.compile("|".join(re.escape(x) for x in (OPEN, CLOSE, *FOREIGN)))
ESCAPED = re.compile(f"[<\\[]{MARK}|{MARK}{MARK}")
TURN = re.compile(f"{re.escape(OPEN)}([^\n]*)\n(.*?){re.escape(CLOSE)}\n", re.S)
FORMATTED = "conv_id bigint, turn bigint, place bigint, formatted string, loss_start bigint, loss_end bigint"
SUMMARY = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"


def escape(text: str, level: int) -> str:
    """Level 0: as it is. Level 1: control strings marked. Level 2: marks doubled as well, and line feeds of roles."""
    if level == 0:
        return text
    if level == 2:
        text = text.replace(MARK, MARK + MARK)
    return CONTROL.sub(lambda m: m[0][0] + MARK + m[0][1:], text)


def unescape(text: str) -> str:
    return ESCAPED.sub(lambda m: m[0][0], text)


def render(role: str, text: str, level: int = 0) -> str:
    head = escape(role, level)
    if level == 2:
        head = head.replace("\n", f"[{MARK}n]")
    return f"{OPEN}{head}\n{escape(text, level)}{CLOSE}\n"


def parse(formatted: str) -> Iterator[tuple[str, str, int, int]]:
    """Turns of a formatted stretch: role, text, and where the escaped text stands. Anything else is an error."""
    place = 0
    while place < len(formatted):
        found = TURN.match(formatted, place)
        if not found or CONTROL.search(found[1]) or CONTROL.search(found[2]):
            raise ValueError(f"no turn at {place}")
        yield unescape(found[1].replace(f"[{MARK}n]", "\n")), unescape(found[2]), found.start(2), found.end(2)
        place = found.end()


def round_trip(role: str, text: str) -> tuple[str, int, int]:
    """A turn in the least escaped form that reads back as it was; where its text stands."""
    for level in range(3):
        formatted = render(role, text, level)
        try:
            turns = list(parse(formatted))
        except ValueError:
            continue
        if len(turns) == 1 and turns[0][:2] == (role, text):
            return formatted, turns[0][2], turns[0][3]
    raise ValueError("a turn does not survive formatting")


def _formatted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    current, length, place = object(), 0, 0
    for batch in batches:
        rows = []
        for conv, turn, role, text in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            if conv != current:
                current, length, place = conv, 0, 0
            formatted, start, end = round_trip(role, text)
            trained = role == TRAINED
            rows.append((conv, turn, place, formatted, length + start if trained else None, length + end if trained else None))
            length, place = length + len(formatted), place + 1
        if rows:
            columns = [pa.array(c, pa.string() if i == 3 else pa.int64()) for i, c in enumerate(zip(*rows, strict=True))]
            yield pa.RecordBatch.from_arrays(columns, ["conv_id", "turn", "place", "formatted", "loss_start", "loss_end"])


def format_turns(turns: DataFrame) -> DataFrame:
    """One row per turn: conv_id, turn, place in its conversation, its stretch of the formatted text, and its loss span.

    Rows of a conversation are contiguous and in order within their partition.
    """
    filled = turns.select(
        F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    ordered = filled.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.mapInArrow(_formatted, FORMATTED)


class _Reading:
    """Running digests of one conversation, as read back from its formatted stretches."""

    def __init__(self, conv: int | None):
        self.conv, self.turns, self.chars, self.loss = conv, 0, 0, 0
        self.all, self.trained = hashlib.sha256(), hashlib.sha256()

    def add(self, formatted: str, start: int | None, end: int | None) -> None:
        for role, text, _, _ in parse(formatted):
            self.turns += 1
            self.all.update(f"{role}\n{text}\n".encode("utf-8", "replace"))
        if start is not None:
            text = unescape(formatted[start - self.chars:end - self.chars])
            self.loss += len(text)
            self.trained.update(text.encode("utf-8", "replace"))
        self.chars += len(formatted)

    def row(self) -> tuple:
        return self.conv, self.turns, self.all.hexdigest(), self.loss, self.trained.hexdigest(), self.chars


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def out(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    reading = None
    for batch in batches:
        done = []
        for conv, formatted, start, end in zip(*(batch.column(i).to_pylist() for i in (0, 3, 4, 5)), strict=True):
            if reading is None or conv != reading.conv:
                if reading is not None:
                    done.append(reading.row())
                reading = _Reading(conv)
            reading.add(formatted, start, end)
        if done:
            yield out(done)
    if reading is not None:
        yield out([reading.row()])


def summarize(formatted: DataFrame) -> DataFrame:
    """One row per conversation, from the output of ``format_turns`` alone; rows must be in its order."""
    return formatted.mapInArrow(_summaries, SUMMARY)
