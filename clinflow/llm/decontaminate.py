"""Find and remove passages of benchmark items in documents.

The items' words go into a generalised suffix automaton, sent to every executor; documents are
streamed through it, one transition per word, and the length of the longest match that ends at each
word tells where windows of items occur.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinflow.llm.automata import SuffixAutomaton
from clinflow.llm.common import received, scratch, sent, slices, whole_row

#: Capital letters to small ones, everything but letters, digits and non-ASCII bytes to a space.
FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
#: Bytes of the automata that are sent to every executor at a time, or those of one.
PASS_BYTES = 64 * 1024 * 1024
SPAN = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))


@dataclass(frozen=True)
class Limits:
    """``window``: so many consecutive words of an item are a hit; a shorter item is a hit as a
    whole. ``max_percent``: a document with that share of hit words or more is contaminated.
    ``shard_words``: an automaton holds about so many words of items at most."""

    window: int = 13
    max_percent: int = 5
    shard_words: int = 100_000


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(FOLD).split()


class ItemAutomaton:
    """A shard of items, ready to be scanned with."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int) -> None:
        self.ids: dict[bytes, int] = {}
        self.window = window
        self.automaton = auto = SuffixAutomaton()
        coded = [(name, [self.ids.setdefault(w, len(self.ids)) for w in words]) for name, words in items]
        for _, words in coded:
            auto.add(words)
        self.shortest = min((min(len(words), window) for _, words in coded), default=window)
        self.items: dict[int, set[str]] = {}  # of the state of a window
        short: dict[int, list[tuple[int, str]]] = {}  # whole items, by the state they end in
        for name, words in coded:
            for at, (state, size) in enumerate(auto.matches(words)):
                if size >= window:
                    self.items.setdefault(auto.suffix(state, window), set()).add(name)
            if len(words) < window:
                short.setdefault(auto.suffix(state, len(words)), []).append((len(words), name))
        self.short: dict[int, list[tuple[int, str]]] = {}
        for state in auto.by_length()[1:]:
            if found := short.get(state, []) + self.short.get(auto.link[state], []):
                self.short[state] = found

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Spans of hit words, and the items whose windows occur."""
        known = np.fromiter(map(self.ids.get, words, [-1] * len(words)), np.int64, len(words))
        spans: list[tuple[int, int]] = []
        items: set[str] = set()
        # A match lies within a run of words that occur in items.
        edge = np.flatnonzero(np.diff(np.concatenate(([0], known >= 0, [0]))))
        starts, ends = edge[::2], edge[1::2]
        long = ends - starts >= self.shortest
        for start, end in zip(starts[long].tolist(), ends[long].tolist()):
            for at, (state, size) in enumerate(self.automaton.matches(known[start:end].tolist()), start + 1):
                if size >= self.window:
                    spans.append((at - self.window, at))
                    items |= self.items[self.automaton.suffix(state, self.window)]
                for length, name in self.short.get(state, ()):
                    if length <= size:
                        spans.append((at - length, at))
                        items.add(name)
        return spans, items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


def pieces(items: DataFrame, limits: Limits) -> DataFrame:
    """``item``, ``words`` (joined by spaces) and their number ``size``: items, long ones cut into
    pieces that overlap by a window less one word, so that each of its windows is in one piece."""
    longest = max(limits.shard_words // 8, 2 * limits.window)
    step = longest - limits.window + 1

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = []
            for name, text in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist()):
                words = words_of(text)
                for at in range(0, max(len(words) - limits.window + 1, 1) if words else 0, step):
                    some = words[at : at + longest]
                    out.append((name or "", b" ".join(some).decode(), len(some)))
            columns = zip(*out) if out else ((), (), ())
            kinds = (pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=["item", "words", "size"]
            )

    named = items.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("string").alias("text"))
    return named.mapInArrow(cut, "item string, words string, size long")


def automata(items: DataFrame, limits: Limits) -> DataFrame:
    """``shard`` and ``automaton``: the items dealt into shards of about ``limits.shard_words`` words
    at most, each an automaton that the task which holds the shard has built."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(*(b.column(c).to_pylist() for c in ("shard", "item", "words"))))
        for shard, held in groupby(rows, key=lambda r: r[0]):
            whole = ItemAutomaton([(name, words.encode().split(b" ")) for _, name, words in held], limits.window)
            yield pa.RecordBatch.from_pydict(
                {"shard": pa.array([shard], pa.int64()), "automaton": pa.array([cloudpickle.dumps(whole)], pa.binary())}
            )

    cut = scratch(pieces(items, limits), "pieces")
    total = cut.agg(F.sum("size")).first()[0] or 0
    n = max(1, -(-2 * total // limits.shard_words))
    dealt = cut.withColumn("shard", F.pmod(F.xxhash64("item", "words"), F.lit(n)).cast("long"))
    ordered = dealt.repartition("shard").sortWithinPartitions("shard", "item", "words")
    return scratch(ordered.select("shard", "item", "words").mapInArrow(build, "shard long, automaton binary"), "automata")


def passes(shards: DataFrame) -> Iterator[list[int]]:
    """The shards whose automata fit a broadcast together, in turn."""
    held, size = [], 0
    for r in shards.select("shard", F.octet_length("automaton").alias("size")).orderBy("shard").collect():
        if held and size + r.size > PASS_BYTES:
            yield held
            held, size = [], 0
        held.append(r.shard)
        size += r.size
    if held:
        yield held


def scanned(df: DataFrame, found: list[bytes]) -> DataFrame:
    """Columns ``n_words``, ``spans`` and ``items`` with what some more automata find."""
    shared = sent(df, found)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards = [cloudpickle.loads(a) for a in received(shared)]
        for batch in slices(batches):
            counts, spans, items = [], [], []
            before = zip(batch.column("spans").to_pylist(), batch.column("items").to_pylist())
            for text, (old_spans, old_items) in zip(batch.column("text").to_pylist(), before):
                words = words_of(text)
                new, names = [], set(old_items)
                for shard in shards:
                    hits, named = shard.scan(words)
                    new += hits
                    names |= named
                old = [(s["start"], s["end"]) for s in old_spans]
                counts.append(len(words))
                spans.append(merged(new + old) if new else old)
                items.append(sorted(names))
            kind = batch.schema.field("spans").type
            new = {
                "n_words": pa.array(counts, pa.int64()),
                "spans": pa.array([[{"start": a, "end": b} for a, b in s] for s in spans], kind),
                "items": pa.array(items, batch.schema.field("items").type),
            }
            yield pa.RecordBatch.from_arrays(
                [new.get(n, batch.column(n)) for n in batch.schema.names], names=batch.schema.names
            )

    return df.mapInArrow(scan, df.schema)


def find_items(docs: DataFrame, items: DataFrame, limits: Limits = Limits(), keep: list[str] | None = None) -> DataFrame:  # noqa: E501
    """Every row with the passages of items in its text.

    Returns struct ``row`` (the columns in ``keep``, or all), ``text``, ``n_words``, ``spans`` (of
    words, merged, end exclusive), ``items`` (ids as text, each once, sorted), ``n_hit`` and
    ``contaminated``. A null or empty text has no words and no hits; items without words, or a
    table without items, hit nothing. An item without an id is listed as empty text. Items with one
    id, and repeated ones, count as one. Items of any number and length are cut and dealt into shards,
    whose automata tasks build; as many as fit a broadcast are scanned with in one pass over the
    documents, and the results of four passes are written before the next. Repeated documents are
    scanned each, texts of any length whole.
    """
    df = docs.select(
        whole_row(docs, keep),
        "text",
        F.lit(0).cast("long").alias("n_words"),
        F.lit(None).cast(SPAN).alias("spans"),
        F.lit(None).cast("array<string>").alias("items"),
    )
    df = df.withColumns({n: F.coalesce(n, F.array().cast(df.schema[n].dataType)) for n in ("spans", "items")})
    shards = automata(items, limits)
    chosen = list(passes(shards)) or [[]]
    for n, some in enumerate(chosen, 1):
        held = shards.filter(F.col("shard").isin(some)).orderBy("shard").collect()
        df = scanned(df, [bytes(r.automaton) for r in held])
        if n % 4 == 0 and n < len(chosen):
            df = scratch(df, "spans")
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    hit = F.col("n_hit")
    return df.withColumn("n_hit", n_hit).withColumn(
        "contaminated", (hit > 0) & (100 * hit >= limits.max_percent * F.col("n_words"))
    )


@F.pandas_udf(T.StringType())
def without_spans(text: pd.Series, spans: pd.Series) -> pd.Series:
    """The text less the characters from a span's first word to its last, for each span."""
    out = []
    for body, found in zip(text, spans):
        if body is not None and len(found):
            places = [m.span() for m in WORD.finditer(body)]
            at, parts = 0, []
            for s in found:
                parts.append(body[at : places[s["start"]][0]])
                at = places[s["end"] - 1][1]
            body = "".join([*parts, body[at:]])
        out.append(body)
    return pd.Series(out, dtype=object)


def clean_rows(docs: DataFrame, items: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The rows that are not contaminated, unchanged."""
    return find_items(docs, items, limits).filter("NOT contaminated").select("row.*")


def cut_rows(docs: DataFrame, items: DataFrame, min_span: int = 13, limits: Limits = Limits()) -> DataFrame:
    """Contaminated rows go; of the others' texts, spans of ``min_span`` words or more are removed."""
    found = find_items(docs, items, limits).filter("NOT contaminated")
    spans = F.filter("spans", lambda s: s["end"] - s["start"] >= min_span)
    return found.withColumn("row", F.col("row").withField("text", without_spans("text", spans))).select("row.*")
