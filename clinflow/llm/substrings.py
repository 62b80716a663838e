"""Remove passages that occur more than once, in one document or several.

Whatever is repeated has repeated anchors: runs of a few words whose hash is the smallest in some
window, which depends on the window's words alone. The words around an anchor, as far as windows
with it reach, are its context. Equal contexts need no further look. Where one anchor has different
contexts, these are a shard of reference text: a suffix automaton is built from them, and each is
streamed through it; a match of a window's length whose state was seen more than once is a repeat.

Sending each shard's automaton to all documents would take shards times corpus steps. Here a shard
goes to the one task where its anchor's contexts meet.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinflow.llm.automata import SuffixAutomaton
from clinflow.llm.common import scratch, settled, slices, small_join, whole_row
from clinflow.llm.shingles import mixed, word_hashes

ANCHORS = "doc long, text_hash long, start int, size int, anchor long, context long"
#: Words hashed at once.
CHUNK = 400_000
#: Different contexts of one anchor that are put into one automaton; of more, windows are counted.
SHARD = 4096


@dataclass(frozen=True)
class Passage:
    """``window``: a passage of so many words counts as repeated; at most 35, so that a context's
    words fit the bits of a long. ``gram``: the words of an anchor."""

    window: int = 35
    gram: int = 8

    @property
    def reach(self) -> int:
        """How many windows may hold an anchor; a context reaches so many words less one to each side."""
        return self.window - self.gram + 1


def slide(x: np.ndarray, size: int, pick) -> np.ndarray:
    """The least or largest (``pick``) of each ``size`` neighbours, from where each begins."""
    have = 1
    while have < size:
        step = min(have, size - have)
        x = pick(x[:-step], x[step:])
        have += step
    return x


def anchors_of(h: np.ndarray, lengths: np.ndarray, passage: Passage):
    """Anchors of texts whose words' hashes are joined in ``h``: text, start and size of the context
    in the text, hash of the anchor, hash of the context."""
    n, reach, gram = len(h), passage.reach, passage.gram
    ends = np.cumsum(lengths)
    text = np.repeat(np.arange(len(lengths)), lengths)
    first, last = (ends - lengths)[text], ends[text]
    at = np.arange(n)
    if n < passage.window:
        return (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),) * 2
    odd = np.uint64(0x9E3779B97F4A7C15)
    value = np.zeros(n, np.uint64)
    for i in range(gram):
        value[: n - gram + 1] = value[: n - gram + 1] * odd + h[i : n - gram + 1 + i]
    value = mixed(value) | np.uint64(1)
    top = np.uint64(np.iinfo(np.uint64).max)
    value[at + gram > last] = top
    least = np.zeros(n, np.uint64)
    low = slide(value, reach, np.minimum)
    least[: len(low)] = low
    least[at + passage.window > last] = 0
    high = slide(np.concatenate((np.zeros(reach - 1, np.uint64), least)), reach, np.maximum)
    place = np.flatnonzero(value == high)
    # A window with two anchors of one hash belongs to the first: contexts do not reach back to it.
    order = np.lexsort((place, value[place], text[place]))
    sorted_place, v = place[order], value[place[order]]
    near = np.concatenate(([False], (v[1:] == v[:-1]) & (text[sorted_place[1:]] == text[sorted_place[:-1]])))
    before = np.where(near, np.concatenate(([0], sorted_place[:-1])) + 1, 0)
    start = np.maximum.reduce((sorted_place - reach + 1, before, first[sorted_place]))
    end = np.minimum(sorted_place + passage.window, last[sorted_place])
    enough = end - start >= passage.window
    sorted_place, start, end, v = sorted_place[enough], start[enough], end[enough], v[enough]
    powers = np.cumprod(np.full(n + 1, odd), dtype=np.uint64)
    back = np.cumprod(np.full(n + 1, np.uint64(pow(int(odd), -1, 1 << 64))), dtype=np.uint64)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(h * powers[:n], dtype=np.uint64)))
    inside = mixed((sums[end] - sums[start]) * back[start])
    sides = ((sorted_place - start) * 64 + (end - sorted_place)).astype(np.uint64)
    whole = text[sorted_place]
    return whole, start - first[sorted_place], end - start, v, mixed(inside + sides)


def keyed(docs: DataFrame, *more: str) -> DataFrame:
    """``doc`` and ``text_hash`` name a text: rows that share both are treated alike."""
    return docs.select(
        *more,
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-1).cast("long")).alias("doc"),
        F.xxhash64("text").alias("text_hash"),
        "text",
    )


KEY = ["doc", "text_hash"]


def find_anchors(docs: DataFrame, passage: Passage) -> DataFrame:
    """The anchors of all texts, by :data:`ANCHORS`."""

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list, list, list]]:
        keys, hashes, words, size = [], [], [], 0
        for batch in slices(batches):
            for doc, key, text in zip(*(batch.column(c).to_pylist() for c in ("doc", "text_hash", "text"))):
                split = (text or "").encode().split()
                if len(split) >= passage.window:
                    keys.append(doc)
                    hashes.append(key)
                    words.append(word_hashes(split))
                    size += len(split)
                if size >= CHUNK:
                    yield keys, hashes, words
                    keys, hashes, words, size = [], [], [], 0
        if words:
            yield keys, hashes, words

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, hashes, words in chunks(batches):
            lengths = np.array(list(map(len, words)))
            text, start, size, anchor, context = anchors_of(np.concatenate(words), lengths, passage)
            columns = [np.array(keys)[text], np.array(hashes)[text], start.astype("i4"), size.astype("i4")]
            columns += [anchor.view("i8"), context.view("i8")]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=schema.names)

    schema = T.StructType.fromDDL(ANCHORS)
    return keyed(docs).mapInArrow(find, schema)


def with_lists(docs: DataFrame, lists: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of ``keyed`` documents that have a list, with it, and those that have none.

    Only the texts of the former are moved, as far as their names are few enough to be broadcast.
    """
    names = scratch(lists.select(*KEY), "names")
    some = small_join(docs, names, KEY, "left_semi").join(lists, KEY)
    return some, small_join(docs, names, KEY, "left_anti")


def fetch_contexts(docs: DataFrame, contexts: DataFrame) -> DataFrame:
    """The words of contexts, each from one text that has it."""
    lists = contexts.groupBy("at.doc", "at.text_hash").agg(
        F.collect_list(F.struct("anchor", "context", "times", "many", "at.start", "size")).alias("wanted")
    )
    names = "anchor long, context long, times long, many boolean, words string"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for text, wanted in zip(batch.column("text").to_pylist(), batch.column("wanted").to_pylist()):
                split = text.encode().split()
                for w in wanted:
                    words = b" ".join(split[w["start"] : w["start"] + w["size"]]).decode()
                    rows.append((w["anchor"], w["context"], w["times"], w["many"], words))
            columns = list(zip(*rows)) or [()] * 5
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=["anchor", "context", "times", "many", "words"],
            )

    found, _ = with_lists(keyed(docs), scratch(lists, "wanted"))
    return found.select("text", "wanted").mapInArrow(cut, names)


def cover(size: int, at: int) -> int:
    return ((1 << size) - 1) << at


def repeats_by_automaton(contexts: DataFrame, passage: Passage) -> DataFrame:
    """``anchor``, ``context``, ``mask``: bit i is set if word i of the context is in a repeat."""
    names = ("anchor", "context", "times", "words")

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(batch.column(c).to_pylist() for c in names))

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, int, int]] = []
        for anchor, group in groupby(rows_of(batches), key=lambda r: r[0]):
            ids: dict[str, int] = {}
            shard = [(c, t, [ids.setdefault(w, len(ids)) for w in words.split(" ")]) for _, c, t, words in group]
            automaton = SuffixAutomaton()
            for _, times, words in shard:
                automaton.add(words, times)
            automaton.count()
            for context, _, words in shard:
                mask = 0
                for at, (state, size) in enumerate(automaton.matches(words), 1):
                    if size >= passage.window and automaton.seen[automaton.suffix(state, passage.window)] > 1:
                        mask |= cover(passage.window, at - passage.window)
                if mask:
                    out.append((anchor, context, mask))
            if len(out) >= 10_000:
                yield batch_of(out)
                out = []
        if out:
            yield batch_of(out)

    def batch_of(rows: list[tuple[int, int, int]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in zip(*rows)], names=["anchor", "context", "mask"]
        )

    ordered = contexts.repartition("anchor").sortWithinPartitions("anchor")
    return ordered.select(*names).mapInArrow(stream, "anchor long, context long, mask long")


def repeats_by_counts(contexts: DataFrame, passage: Passage) -> DataFrame:
    """The same, for anchors with so many contexts that they don't fit one task: each window of each
    context is a row, and equal ones are counted."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            columns = (batch.column(c).to_pylist() for c in ("anchor", "context", "times", "words"))
            for anchor, context, times, words in zip(*columns):
                split = words.split(" ")
                for at in range(len(split) - passage.window + 1):
                    key = xxhash.xxh3_128_digest(" ".join(split[at : at + passage.window]))
                    rows.append((anchor, context, times, key, cover(passage.window, at)))
            parts = list(zip(*rows)) or [()] * 5
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(parts, kinds)],
                names=["anchor", "context", "times", "window", "mask"],
            )

    each = contexts.mapInArrow(windows, "anchor long, context long, times long, window binary, mask long")
    each = scratch(each, "windows")
    counts = each.groupBy("anchor", "window").agg(F.sum("times").alias("n")).filter("n > 1")
    hits = each.join(counts.select("anchor", "window"), ["anchor", "window"])
    return hits.groupBy("anchor", "context").agg(F.bit_or("mask").alias("mask"))


def repeated_words(docs: DataFrame, passage: Passage) -> DataFrame:
    """Per text with repeats: ``hits``, a list of starts and masks of words to remove."""
    anchors = scratch(find_anchors(docs, passage), "anchors")
    groups = anchors.groupBy("anchor").agg(
        F.count("*").alias("n"), F.min("context").alias("lo"), F.max("context").alias("hi")
    )
    groups = scratch(groups.filter("n > 1").select("anchor", (F.col("lo") < F.col("hi")).alias("differ")), "groups")
    repeated = scratch(anchors.join(groups, "anchor"), "repeated")
    contexts = (
        repeated.filter("differ")
        .groupBy("anchor", "context", "size")
        .agg(F.count("*").alias("times"), F.min(F.struct("doc", "text_hash", "start")).alias("at"))
    )
    contexts = scratch(contexts, "contexts")
    many = contexts.groupBy("anchor").agg((F.count("*") > SHARD).alias("many")).filter("many")
    contexts = contexts.join(scratch(many, "many"), "anchor", "left").withColumn(
        "many", F.coalesce("many", F.lit(False))
    )
    texts = scratch(fetch_contexts(docs, contexts), "contexts")
    masks = repeats_by_automaton(texts.filter("NOT many"), passage).unionByName(
        repeats_by_counts(texts.filter("many"), passage)
    )
    whole = repeated.filter("NOT differ").withColumn("mask", F.expr("shiftleft(1L, size) - 1"))
    parts = repeated.filter("differ").join(scratch(masks, "masks"), ["anchor", "context"])
    hits = whole.select(*KEY, "start", "mask").union(parts.select(*KEY, "start", "mask"))
    return hits.groupBy(*KEY).agg(F.collect_set(F.struct("start", "mask")).alias("hits"))


def without_repeats(docs: DataFrame, passage: Passage = Passage(), keep: list[str] | None = None) -> DataFrame:
    """Every row as struct ``row`` (the columns in ``keep``, or all), with ``n_words``,
    ``n_removed`` and ``kept``, the words left, joined by single spaces.

    Every word is removed that lies in a window whose words also begin at any other place; both
    places lose theirs, and rows that are repeated lose all windows. Windows are judged on the
    input. A null or empty text, or one of fewer words than a window, loses nothing. An empty table
    gives an empty one.
    """
    if not 1 <= passage.gram <= passage.window <= 35 or passage.window + passage.reach > 63:
        raise ValueError("a context has 62 words at most")
    lists = settled(docs.sparkSession, lambda: repeated_words(docs, passage), "hits")
    rows = keyed(docs, whole_row(docs, keep))
    some, others = with_lists(rows, lists)
    none = others.withColumn("hits", F.array().cast(lists.schema["hits"].dataType))
    schema = T.StructType([rows.schema["row"], *T.StructType.fromDDL("n_words long, n_removed long, kept string")])

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            counts, removed, kept = [], [], []
            for text, hits in zip(batch.column("text").to_pylist(), batch.column("hits").to_pylist()):
                words = (text or "").encode().split()
                counts.append(len(words))
                if hits:
                    gone = bytearray(len(words))
                    for hit in hits:
                        bits = bin(hit["mask"])[:1:-1]
                        for i, bit in enumerate(bits, hit["start"]):
                            if bit == "1":
                                gone[i] = 1
                    words = [w for w, g in zip(words, gone) if not g]
                removed.append(counts[-1] - len(words))
                kept.append(b" ".join(words).decode())
            new = [pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column("row"), *new], names=schema.names)

    columns = ["row", "text", "hits"]
    return some.select(*columns).unionByName(none.select(*columns)).mapInArrow(remove, schema)
