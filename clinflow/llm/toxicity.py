"""Toxicity by a factorization machine over hashed terms.

A text's terms are its distinct words without marks around them, capital letters made small, and the
first letters of longer words; terms fall into buckets by hash. Buckets that say something about the
label, over all labelled texts, are the machine's inputs. Its pairwise part learns what only terms
together show, as an insult next to the mention of a group.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinflow.llm.common import received, scratch, sent, slices, small_join, whole_row

#: Buckets of terms.
BUCKETS = 1 << 20
#: Lengths of word beginnings that are terms of their own.
STARTS = (4, 5, 6)
#: Marks that don't belong to a word they stand beside.
MARKS = "".join(map(chr, range(33, 48))) + ":;<=>?@[\\]^_`{|}~…“”‘’«»¿¡"


@dataclass(frozen=True)
class Settings:
    """``inputs``: buckets the machine sees at most; ``least``: how far a bucket's counts must differ
    between labels to be one (likelihood ratio). ``sample``: labelled texts it is fitted on at most,
    chosen by hash; counts of terms cover all. The others are those of the machine and its training."""

    inputs: int = 4096
    least: float = 20.0
    sample: int = 20_000
    factors: int = 4
    rounds: int = 20
    rate: float = 0.1
    decay: float = 1e-4
    seed: int = 13


def hashes(terms: pa.Array, mark: str = "") -> np.ndarray:
    """The bucket of each term; ``mark`` tells beginnings from whole words."""
    coded = terms.dictionary_encode()
    each = (xxhash.xxh64_intdigest(t + mark) % BUCKETS for t in coded.dictionary.to_pylist())
    found = np.fromiter(each, np.int64, len(coded.dictionary))
    return found[coded.indices.to_numpy(zero_copy_only=False)]


def buckets_of(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of each word's terms in a row, and how many it has; small words have fewer."""
    core = pc.utf8_trim(words, characters=MARKS)
    length = pc.utf8_length(core).to_numpy(zero_copy_only=False)
    found = np.full((len(words), 1 + len(STARTS)), -1, np.int64)
    found[:, 0] = np.where(length > 0, hashes(core), -1)
    for i, n in enumerate(STARTS, 1):
        found[:, i] = np.where(length > n, hashes(pc.utf8_slice_codeunits(core, 0, n), "…"), -1)
    return found[found >= 0], (found >= 0).sum(1)


def ragged(lists: list[tuple[int, ...]]) -> tuple[np.ndarray, np.ndarray]:
    """All numbers in a row, and how many each list has."""
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.int64, int(sizes.sum())), sizes


def taken(flat: np.ndarray, sizes: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of some of the lists in a row, and from which of them each comes."""
    n = sizes[which]
    starts = (np.cumsum(sizes) - sizes)[which]
    row = np.repeat(np.arange(len(which)), n)
    return flat[np.arange(n.sum()) + np.repeat(starts - np.cumsum(n) + n, n)], row


def terms_of(texts: pa.Array, known: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Text and bucket of each different bucket of each text, by text, then bucket; with ``known``,
    of those in it only, as places in it. Each different word of the texts is looked up once."""
    lower = pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
    split = pc.ascii_split_whitespace(lower)
    doc = np.repeat(np.arange(len(texts)), np.diff(np.asarray(split.offsets)[: len(texts) + 1]))
    coded = split.flatten().dictionary_encode()
    word = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    flat, sizes = buckets_of(coded.dictionary)
    if known is not None:
        at = np.searchsorted(known, flat)
        hit = (known[np.minimum(at, len(known) - 1)] == flat) if len(known) else np.zeros(len(flat), bool)
        owner = np.repeat(np.arange(len(sizes)), sizes)
        flat, sizes = at[hit], np.bincount(owner[hit], minlength=len(sizes))
        some = sizes[word] > 0
        doc, word = doc[some], word[some]
    wide = max(len(sizes), 1)
    pairs = np.unique(doc * wide + word)
    doc, word = pairs // wide, pairs % wide
    found, row = taken(flat, sizes, word)
    both = np.unique(doc[row] * BUCKETS + found)
    return both // BUCKETS, both % BUCKETS


def labelled(docs: DataFrame, labels: DataFrame, train: Column) -> DataFrame:
    """``text`` and ``toxic`` of the rows to learn from: each row of ``docs`` that ``train`` holds for
    and whose id has a label; of several labels of an id the largest counts."""
    once = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    once = scratch(once.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic")), "labels")
    ids = docs.schema["doc_id"].dataType
    rows = docs.filter(train).select("doc_id", F.col("text").cast("string").alias("text"))
    return small_join(rows, once.withColumn("doc_id", F.col("doc_id").cast(ids)), ["doc_id"], "inner")


def counted(texts: DataFrame) -> DataFrame:
    """Per bucket, in how many texts of each label it occurs; bucket -1 is in every text."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((BUCKETS + 1, 2), np.int64)
        for batch in slices(batches):
            toxic = (batch.column("toxic").to_numpy() > 0).astype(np.int64)
            doc, bucket = terms_of(batch.column("text"))
            seen[:BUCKETS] += np.bincount(2 * bucket + toxic[doc], minlength=2 * BUCKETS).reshape(-1, 2)
            seen[BUCKETS] += np.bincount(toxic, minlength=2)
        used = np.flatnonzero(seen.sum(1))
        if len(used):
            bucket = np.where(used == BUCKETS, -1, used)
            columns = [pa.array(c) for c in (bucket, seen[used, 0], seen[used, 1])]
            yield pa.RecordBatch.from_arrays(columns, names=["bucket", "clean", "toxic"])

    parts = texts.select("text", "toxic").mapInArrow(count, "bucket long, clean long, toxic long")
    return parts.groupBy("bucket").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))


def telling(counts: DataFrame, clean: int, toxic: int, settings: Settings) -> list[int]:
    """The buckets whose occurrence and label depend on each other most, by likelihood ratio."""
    part = lambda n, expected: F.when(n > 0, n * F.ln(n / expected)).otherwise(0.0)
    k, c, n = F.col("toxic"), F.col("clean"), clean + toxic
    seen = k + c
    ratio = 2 * (
        part(k, seen * toxic / n)
        + part(c, seen * clean / n)
        + part(toxic - k, (n - seen) * toxic / n)
        + part(clean - c, (n - seen) * clean / n)
    )
    scored = counts.filter("bucket >= 0").select("bucket", ratio.alias("ratio"))
    best = scored.filter(F.col("ratio") >= settings.least).orderBy(F.desc("ratio"), "bucket").limit(settings.inputs)
    return sorted(r.bucket for r in best.collect())


@dataclass
class Machine:
    """score = sigmoid(bias + sum of weights + half of (sum of factors)^2 - sum of squared factors),
    over the inputs that a text has; ``place`` has the input buckets in order, one per row."""

    place: np.ndarray
    bias: float
    weight: np.ndarray
    factor: np.ndarray

    def inputs(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The inputs of all texts in a row, and how many each has."""
        doc, place = terms_of(texts, self.place)
        return place, np.bincount(doc, minlength=len(texts))

    def raw(self, flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Scores before the sigmoid, of texts whose inputs stand in a row."""
        row = np.repeat(np.arange(len(sizes)), sizes)
        out = np.full(len(sizes), self.bias)
        np.add.at(out, row, self.weight[flat])
        for f in range(self.factor.shape[1]):
            v = self.factor[flat, f]
            out += (np.bincount(row, v, len(sizes)) ** 2 - np.bincount(row, v * v, len(sizes))) / 2
        return out

    def score(self, flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        return sigmoid(self.raw(flat, sizes))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(machine: Machine, inputs: list[list[int]], toxic: np.ndarray, settings: Settings) -> Machine:
    """Gradient steps with a rate of its own for every number (AdaGrad) on the logarithmic loss, in
    batches of 64 texts in a fixed shuffle."""
    rng = np.random.default_rng(settings.seed)
    n, k = machine.factor.shape
    machine.factor = rng.normal(0, 0.05, (n, k))
    share = float(np.clip(toxic.mean(), 1e-4, 1 - 1e-4)) if len(toxic) else 0.5
    machine.bias = float(np.log(share / (1 - share)))
    steps_w, steps_v, step_b = np.full(n, 1e-2), np.full((n, k), 1e-2), 1e-2
    all_flat, sizes = ragged(inputs)
    for _ in range(settings.rounds if len(toxic) else 0):
        order = rng.permutation(len(toxic))
        for at in range(0, len(order), 64):
            some = order[at : at + 64]
            flat, row = taken(all_flat, sizes, some)
            wrong = sigmoid(machine.raw(flat, sizes[some])) - toxic[some]
            step_b += wrong.sum() ** 2
            machine.bias -= settings.rate * wrong.sum() / np.sqrt(step_b)
            if not len(flat):
                continue
            v = machine.factor[flat]
            sums = np.zeros((len(some), k))
            np.add.at(sums, row, v)
            used, where = np.unique(flat, return_inverse=True)
            gw = np.bincount(where, wrong[row], len(used)) + settings.decay * machine.weight[used]
            gv = np.zeros((len(used), k))
            np.add.at(gv, where, wrong[row, None] * (sums[row] - v))
            gv += settings.decay * machine.factor[used]
            steps_w[used] += gw * gw
            steps_v[used] += gv * gv
            machine.weight[used] -= settings.rate * gw / np.sqrt(steps_w[used])
            machine.factor[used] -= settings.rate * gv / np.sqrt(steps_v[used])
    return machine


def learn(docs: DataFrame, labels: DataFrame, train: Column, settings: Settings = Settings()) -> Machine:
    """A machine fitted on the rows of ``docs`` that ``train`` holds for.

    ``docs`` has ``doc_id`` and ``text``, ``labels`` has ``doc_id`` and ``toxic``; nothing else of
    them is read. Rows without an id or a label teach nothing, null and empty texts only how frequent
    the labels are. Without labels of both kinds the machine has no inputs and scores all texts alike;
    so does one for empty tables. Reruns choose the same sample.
    """
    texts = labelled(docs, labels, train)
    counts = scratch(counted(texts), "terms")
    total = counts.filter("bucket = -1").first()
    clean, toxic = (total["clean"], total["toxic"]) if total else (0, 0)
    best = telling(counts, clean, toxic, settings) if clean and toxic else []
    machine = Machine(np.array(best, np.int64), 0.0, np.zeros(len(best)), np.zeros((len(best), settings.factors)))
    blank = sent(docs, machine)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        eyes = received(blank)
        for batch in slices(batches):
            flat, sizes = eyes.inputs(batch.column("text"))
            ends = pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32())
            inputs = pa.ListArray.from_arrays(ends, pa.array(flat, pa.int32()))
            columns = [batch.column("place"), batch.column("toxic"), inputs]
            yield pa.RecordBatch.from_arrays(columns, names=["place", "toxic", "inputs"])

    def train_one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches([b for b in batches if b.num_rows] or [pa.RecordBatch.from_pylist([], look_schema)])
        done = fit(received(blank), rows.column("inputs").to_pylist(), rows.column("toxic").to_numpy() > 0, settings)
        numbers = [[done.bias], *([w, *f] for w, f in zip(done.weight.tolist(), done.factor.tolist()))]
        yield pa.RecordBatch.from_pydict(
            {
                "place": pa.array(range(-1, len(numbers) - 1), pa.int32()),
                "numbers": pa.array(numbers, pa.list_(pa.float64())),
            }
        )

    look_schema = pa.schema({"place": pa.int64(), "toxic": pa.int32(), "inputs": pa.list_(pa.int32())})
    placed = texts.select(F.xxhash64(F.lit(settings.seed), "doc_id", "text").alias("place"), "text", "toxic")
    seen = placed.mapInArrow(look, "place long, toxic int, inputs array<int>")
    chosen = seen.orderBy("place", "toxic", "inputs").limit(settings.sample).repartition(1)
    ordered = chosen.sortWithinPartitions("place", "toxic", "inputs")
    for r in scratch(ordered.mapInArrow(train_one, "place int, numbers array<double>"), "machine").collect():
        if r.place < 0:
            machine.bias = r.numbers[0]
        else:
            machine.weight[r.place], machine.factor[r.place] = r.numbers[0], r.numbers[1:]
    return machine


def score_texts(docs: DataFrame, machine: Machine, keep: list[str] | None = None) -> DataFrame:
    """Each row as struct ``row`` with its ``score``, from 0 to 1.

    Whole texts are read, whatever their length. Null and empty texts have no terms and get the
    score of a text of which nothing is known. Repeated rows and ids are scored one by one; an empty
    table gives an empty one. Only ``text`` and ``keep`` are read.
    """
    broadcast = sent(docs, machine)
    rows = docs.select(whole_row(docs, keep), F.col("text").cast("string").alias("text"))
    schema = T.StructType([rows.schema["row"], *T.StructType.fromDDL("score double").fields])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = received(broadcast)
        for batch in slices(batches):
            scores = model.score(*model.inputs(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(scores)], names=schema.names)

    return rows.mapInArrow(score, schema)
