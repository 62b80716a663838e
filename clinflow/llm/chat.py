"""Conversations as training windows of bounded length, with a loss mask.

A window holds whole turns: the conversation's system turn, some of the turns before (both repeated,
and masked), and a span of new ones. Running sums of the turns' tokens say where a span ends. Texts
are escaped so that no marker of the template occurs in them; reading a window undoes that.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import groupby
from typing import TypeVar

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinflow.llm.common import slices
from clinflow.llm.token_files import Encoder, Encoding

T = TypeVar("T")

OPEN, MIDDLE, CLOSE = "<s>[INST] ", " [/INST] ", "</s>"
CONTROL = re.compile(r"\\|</?s>|\[/?INST\]")
TURN = re.compile(re.escape(OPEN) + "(.*?)" + re.escape(MIDDLE) + "(.*?)" + re.escape(CLOSE), re.DOTALL)
CODES = {"\\": "\\", "<": "l", "[": "b"}
LETTERS = {code: letter for letter, code in CODES.items()}
NO_ROLE = "\\0"

WINDOWS = (
    "conv_id long, window int, formatted string, mask array<struct<start:int,end:int>>, "
    "n_repeated int, n_tokens int"
)


def word_counts(parts: list[str]) -> list[int]:
    return [len(p.split()) for p in parts]


class BpeCounts:
    """Tokens of a public tokenizer, given by the path of its file on every machine."""

    def __init__(self, path: str) -> None:
        self.path = path
        self._encoder = None

    def __getstate__(self) -> dict:
        return {"path": self.path, "_encoder": None}

    def __call__(self, parts: list[str]) -> list[int]:
        if self._encoder is None:
            self._encoder = Encoder(Encoding(self.path))
        sizes = [n for _, n in self._encoder.encode(pa.array(parts, pa.string()))]
        return (np.concatenate(sizes) - 1).tolist() if sizes else []


@dataclass(frozen=True)
class Budget:
    """``tokens`` in a window, as ``measure`` counts them in its turns with their markers; of these
    ``history`` at most for the turns before, of which there are ``turns`` at most. A turn that is
    longer than a window gets one of its own, uncut."""

    tokens: int = 512
    history: int = 128
    turns: int = 2
    measure: Callable[[list[str]], list[int]] = word_counts


def escaped(text: str) -> str:
    return CONTROL.sub(lambda m: "\\" + CODES[m[0][0]] + m[0][1:], text)


def unescaped(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: LETTERS[m[1]], text)


@dataclass
class Turn:
    """A turn of the template: its opening, its escaped text, and what the whole of it costs."""

    role: str | None
    head: str
    body: str
    cost: int = 0


def turn_of(role: str | None, text: str | None) -> Turn:
    return Turn(role, OPEN + (NO_ROLE if role is None else escaped(role)) + MIDDLE, escaped(text or ""))


def window(conv_id: int | None, number: int, repeated: list[Turn], fresh: list[Turn]) -> dict:
    parts, mask, at = [], [], 0
    for i, turn in enumerate([*repeated, *fresh]):
        if i >= len(repeated) and turn.role == "assistant":
            mask.append({"start": at + len(turn.head), "end": at + len(turn.head) + len(turn.body)})
        parts += [turn.head, turn.body, CLOSE]
        at += len(turn.head) + len(turn.body) + len(CLOSE)
    return {
        "conv_id": conv_id,
        "window": number,
        "formatted": "".join(parts),
        "mask": mask,
        "n_repeated": len(repeated),
        "n_tokens": sum(t.cost for t in (*repeated, *fresh)),
    }


def windows(conv_id: int | None, turns: Iterator[Turn], budget: Budget) -> Iterator[dict]:
    """The windows of one conversation, whose turns are seen once; only a window's are held."""
    system: list[Turn] = []
    history: list[Turn] = []
    fresh: list[Turn] = []
    number = total = start = 0  # running sums of tokens: so far, and before the span
    for i, turn in enumerate(turns):
        room = budget.tokens - sum(t.cost for t in (*system, *history))
        if fresh and total + turn.cost - start > room:
            yield window(conv_id, number, [*system, *history], fresh)
            number, start = number + 1, total
            if not system and number == 1 and first.role == "system":
                system = [first]
            past = [t for t in (*history, *fresh) if not any(t is s for s in system)]
            past = past[-budget.turns :] if budget.turns else []
            while sum(t.cost for t in past) > budget.history:
                past.pop(0)
            history, fresh = past, []
        if i == 0:
            first = turn
        while not fresh and history and sum(t.cost for t in (*system, *history, turn)) > budget.tokens:
            history.pop(0)
        fresh.append(turn)
        total += turn.cost
    if fresh:
        yield window(conv_id, number, [*system, *history], fresh)


def packed(rows: Iterator[T], size: Callable[[T], int], most: int = 1_000_000) -> Iterator[list[T]]:
    """Rows, as many at a time as are together about ``most`` large."""
    held: list[T] = []
    total = 0
    for row in rows:
        held.append(row)
        total += 100 + size(row)
        if total >= most:
            yield held
            held, total = [], 0
    if held:
        yield held


def format_windows(conversations: DataFrame, budget: Budget = Budget()) -> DataFrame:
    """Windows of all conversations: the columns of :data:`WINDOWS`.

    Rows are taken by turn, those of one turn by role and text, nulls first; repeated rows are turns
    of their own. A null text is empty, a null role stays one, rows without a conversation's id are
    one conversation. A conversation is a sequence and is gone through by one task, which holds no
    more of it than a window. Other columns are not read.
    """

    def turns_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, Turn]]:
        for batch in slices(batches):
            turns = [turn_of(*r) for r in zip(*(batch.column(c).to_pylist() for c in ("role", "text")))]
            costs = budget.measure([t.head + t.body + CLOSE for t in turns])
            for turn, cost in zip(turns, costs):
                turn.cost = cost
            yield from zip(batch.column("conv_id").to_pylist(), turns)

    def form(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grouped = groupby(turns_of(batches), key=lambda r: r[0])
        found = (w for conv_id, rows in grouped for w in windows(conv_id, (t for _, t in rows), budget))
        for some in packed(found, lambda w: len(w["formatted"])):
            yield pa.RecordBatch.from_pylist(some, schema=kinds)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    kinds = to_arrow_schema(StructType.fromDDL(WINDOWS))
    turns = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text")
    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.mapInArrow(form, WINDOWS)


def read_window(formatted: str, mask: list[dict], n_repeated: int) -> tuple[list[tuple[str | None, str]], list[str]]:
    """The new turns of a window, and the texts under its mask."""
    turns = [
        (None if role == NO_ROLE else unescaped(role), unescaped(text))
        for role, text in TURN.findall(formatted)[n_repeated:]
    ]
    return turns, [unescaped(formatted[s["start"] : s["end"]]) for s in mask]


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation, from its windows: turns, loss and their digests. Windows are streamed."""
    import hashlib

    columns = ("conv_id", "formatted", "mask", "n_repeated")
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_windows"]

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(batch.column(c).to_pylist() for c in columns))

    def summed(conv_id: int | None, rows: Iterator[tuple]) -> tuple:
        n_turns = loss_chars = chars = n = 0
        turn_digest, loss_digest = hashlib.sha256(), hashlib.sha256()
        for _, text, mask, n_repeated in rows:
            turns, losses = read_window(text, mask, n_repeated)
            for role, body in turns:
                turn_digest.update(f"{role or ''}\n{body}\n".encode())
            for body in losses:
                loss_digest.update(body.encode())
                loss_chars += len(body)
            n_turns, chars, n = n_turns + len(turns), chars + len(text), n + 1
        return conv_id, n_turns, turn_digest.hexdigest(), loss_chars, loss_digest.hexdigest(), chars, n

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = (summed(*group) for group in groupby(rows_of(batches), key=lambda r: r[0]))
        kinds = [pa.string() if k.endswith("sha256") else pa.int64() for k in names]
        for some in packed(found, lambda r: 200):
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*some), kinds)], names=names)

    ordered = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "window")
    return ordered.mapInArrow(
        read,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long, n_windows long",
    )
