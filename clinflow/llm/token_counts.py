"""Numbers of word pieces in texts, by greedy longest match, without building the pieces."""

from __future__ import annotations

import base64
import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinflow.llm.automata import LongestMatch
from clinflow.llm.common import received, sent, slices, whole_row

#: Words whose counts a task remembers at most; then it forgets them all.
REMEMBERED = 1_000_000
#: Largest vocabulary, in pieces, that is sent to every executor.
MAX_PIECES = 1_000_000
COUNTS = "n_words long, n_tokens long, n_unknown long"


def byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write for bytes: printable ones stand for
    themselves, the others follow from code point 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def read_pieces(path: str) -> list[bytes]:
    """The pieces of a vocabulary file as bytes: a byte-level ``.json`` of the tokenizers library, or
    a ``.tiktoken`` file of ranks. A leading space marks a piece that begins a word."""
    if path.endswith(".tiktoken"):
        with open(path, "rb") as file:
            return [base64.b64decode(line.split()[0]) for line in file if line.strip()]
    with open(path, encoding="utf-8") as file:
        data = json.load(file)
    special = {t["content"] for t in data.get("added_tokens", ())}
    letters = byte_letters()
    return [bytes(letters[c] for c in piece) for piece in data["model"]["vocab"] if piece not in special]


class Counts(dict):
    """Word to its number of pieces, or -1; words begin with the mark."""

    def __init__(self, automaton: LongestMatch, mark: bytes) -> None:
        super().__init__()
        self.automaton, self.mark = automaton, mark

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = n = self.automaton.count(self.mark + word)
        return n


def count_tokens(docs: DataFrame, pieces: list[bytes], mark: bytes = b" ", keep: list[str] | None = None) -> DataFrame:  # noqa: E501
    """Every row as struct ``row`` (the columns in ``keep``, or all), with ``n_words`` (runs without
    the white space x20, x09 to x0D), ``n_tokens`` and ``n_unknown``.

    A word, with ``mark`` before it, is split greedily into the longest pieces of the vocabulary. A
    word that can't be split so is unknown, and one token. A null or empty text has no words;
    words of any length take time in proportion to it. Repeated rows are counted each; an empty
    table gives an empty one.
    """
    if len(pieces) > MAX_PIECES:
        raise ValueError(f"a vocabulary of {len(pieces)} pieces is over {MAX_PIECES}")
    shared = sent(docs, LongestMatch(pieces))
    rows = docs.select(whole_row(docs, keep), "text")
    schema = T.StructType([rows.schema["row"], *T.StructType.fromDDL(COUNTS).fields])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Counts(received(shared), mark)
        for batch in slices(batches):
            words, tokens, unknown = [], [], []
            for text in batch.column("text").to_pylist():
                split = (text or "").encode().split()
                each = list(map(known.__getitem__, split))
                odd = each.count(-1)
                words.append(len(split))
                tokens.append(sum(each) + 2 * odd)
                unknown.append(odd)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), *[pa.array(x, pa.int64()) for x in (words, tokens, unknown)]],
                names=schema.names,
            )

    return rows.mapInArrow(count, schema)
