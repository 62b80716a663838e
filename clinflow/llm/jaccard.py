"""Similarity join of documents on the Jaccard similarity of their word shingles, by PartEnum.

Sets that share a signature meet. Whatever is similar enough shares one, so that the pairs that meet
hold all links; what else they hold is dropped by a bound from sketches and, at last, by comparing
the sets themselves. Only the classes that links form are asked for. So every set is compared with
the first one of its signatures; then the members of groups that are not one class yet are compared
with each other, inside the tasks that hold the groups, which hand on links that join classes only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clinflow.llm.common import scratch, settled, slices, small_join, whole_row
from clinflow.llm.components import components
from clinflow.llm.shingles import PartEnum, set_key, shingle_set, sketch, sketches

SETS = "node long, doc_id long, n_shingles long, set_key binary, sketch binary, signatures array<long>"
#: Sets a task remembers, to give signatures once only to copies that it meets.
REMEMBERED = 200_000
#: Members of a group, and members of their sets, that a task compares with others at a time, about.
BLOCK, BLOCK_SHINGLES = 1024, 4_000_000
#: Members whose distances to all others of a cell are worked out at a time.
STRIP = 32


def described(docs: DataFrame, method: PartEnum) -> DataFrame:
    """Each document's set: size, key, sketch, and its signatures unless the task has met it before.

    A row is a ``node``, numbered when the table is written, so repeated ids are no trouble. Rows without an id have no links, so no signatures either, and leave theirs to the next copy.
    """

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[bytes] = set()
        for batch in slices(batches):
            sizes, keys, counts, signatures = [], [], [], []
            for doc, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text"))):
                s = shingle_set(text)
                key = set_key(s)
                sizes.append(len(s))
                keys.append(key)
                counts.append(sketch(s))
                if doc is None:
                    signatures.append(None)
                    continue
                signatures.append(None if key in met or not len(s) else method.signatures(s))
                if len(met) >= REMEMBERED:
                    met.clear()
                met.add(key)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("node"),
                    batch.column("doc_id"),
                    pa.array(sizes, pa.int64()),
                    pa.array(keys, pa.binary()),
                    pa.array(counts, pa.binary()),
                    pa.array(signatures, pa.list_(pa.int64())),
                ],
                names=["node", "doc_id", "n_shingles", "set_key", "sketch", "signatures"],
            )

    rows = docs.select(F.monotonically_increasing_id().alias("node"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(describe, SETS)


def signed(live: DataFrame) -> DataFrame:
    """``node``, ``sig``: the signatures of each different set, from one of its nodes."""
    carriers = live.filter("signatures IS NOT NULL")
    several = carriers.groupBy("set_key").agg(F.min("node").alias("first"), F.count("*").alias("n")).filter("n > 1")
    again = small_join(carriers.select("set_key", "node"), scratch(several, "several"), ["set_key"], "inner")
    others = scratch(again.filter("node <> first").select("node"), "again")
    once = small_join(carriers.select("node", "signatures"), others, ["node"], "left_anti")
    return once.select("node", F.explode("signatures").alias("sig"))


def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by signature and node: every node but the first of a signature, with that
    first one, the centre."""
    last_sig, last_centre, last_node = None, 0, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        sig, node = batch.column("sig").to_numpy(), batch.column("node").to_numpy()
        new = np.concatenate(([sig[0] != last_sig], sig[1:] != sig[:-1]))
        start = np.maximum.accumulate(np.where(new, np.arange(len(sig)), -1))
        centre = np.where(start < 0, last_centre, node[np.maximum(start, 0)])
        before = np.concatenate(([last_node], node[:-1]))
        keep = ~new & (node != before)
        last_sig, last_centre, last_node = sig[-1], centre[-1], node[-1]
        yield pa.RecordBatch.from_arrays(
            [pa.array(x[keep]) for x in (sig, centre, node)], names=["sig", "centre", "node"]
        )


def same(live: DataFrame, key: str) -> DataFrame:
    """Links ``a``, ``b`` from the first node with a key to the others with it."""
    first = live.groupBy(key).agg(F.min("node").alias("a"), F.count("*").alias("n")).filter("n > 1")
    found = small_join(live.select(key, F.col("node").alias("b")), scratch(first, "first"), [key], "inner")
    return found.filter("a <> b").select("a", "b")


def possible(pairs: DataFrame, sets: DataFrame, method: PartEnum) -> DataFrame:
    """Pairs ``a``, ``b`` that sizes and sketches don't rule out."""

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            n_a, n_b = (batch.column(c).to_numpy() for c in ("n_a", "n_b"))
            apart = np.abs(sketches(batch.column("sketch_a")) - sketches(batch.column("sketch_b"))).sum(1)
            fits = apart <= method.most_apart(n_a, n_b)
            fits &= 100 * np.minimum(n_a, n_b) >= method.percent * np.maximum(n_a, n_b)
            yield batch.select(["a", "b"]).filter(pa.array(fits))

    about = lambda side: sets.select(
        F.col("node").alias(side), F.col("n_shingles").alias(f"n_{side}"), F.col("sketch").alias(f"sketch_{side}")
    )
    joined = pairs.join(about("b"), "b").join(about("a"), "a")
    return joined.select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b").mapInArrow(bound, "a long, b long")


def whole_sets(docs: DataFrame, live: DataFrame, wanted: DataFrame) -> DataFrame:
    """``node`` and ``members``, the set itself, for the nodes in ``wanted``, which have different sets."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [shingle_set(t) for t in batch.column("text").to_pylist()]
            columns = [[set_key(s) for s in found], [s.tobytes() for s in found]]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in columns], names=["set_key", "members"])

    about = small_join(live.select("node", "doc_id", "set_key"), scratch(wanted.select("node").distinct(), "wanted"), ["node"], "left_semi")
    about = scratch(about, "about")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    some = small_join(texts, scratch(about.select("doc_id").distinct(), "ids"), ["doc_id"], "left_semi")
    each = some.select("text").mapInArrow(sets, "set_key binary, members binary")
    named = small_join(each, about.select("set_key", "node"), ["set_key"], "inner")
    return scratch(named.select("node", "members").dropDuplicates(["node"]), "members")


def members_of(value: bytes) -> np.ndarray:
    return np.frombuffer(value, np.uint64)


def linked(pairs: DataFrame, members: DataFrame, method: PartEnum) -> DataFrame:
    """Those of the pairs whose sets are similar enough, found by comparing them in full."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            keep = []
            for x, y in zip(*(map(members_of, batch.column(c).to_pylist()) for c in ("members_a", "members_b"))):
                keep.append(method.alike(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y)))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    side = lambda s: members.select(F.col("node").alias(s), F.col("members").alias(f"members_{s}"))
    both = pairs.select("a", "b").join(side("b"), "b").join(side("a"), "a")
    return both.select("a", "members_a", "b", "members_b").mapInArrow(compare, "a long, b long")


def groups_of(meetings: DataFrame) -> DataFrame:
    """``sig``, ``node``, ``centre``, ``n``: groups of three and more, each set of members once.

    A group of two is its centre and one other, which are compared anyway.
    """
    members = meetings.select("sig", "node", "centre").union(meetings.select("sig", "centre", "centre").distinct())
    digest = [F.bit_xor(F.xxhash64(F.lit(seed), "node")).alias(f"x{seed}") for seed in (0, 1)]
    groups = members.groupBy("sig").agg(F.count("*").alias("n"), *digest).filter("n > 2")
    chosen = groups.groupBy("n", "x0", "x1").agg(F.min("sig").alias("sig"))
    return members.join(chosen.select("sig", "n"), "sig")


CELL = ["sig", "i", "j"]


def open_cells(groups: DataFrame, labels: DataFrame, sets: DataFrame) -> DataFrame:
    """Members of the groups that hold several classes, dealt into cells: a group is cut into blocks,
    and every two blocks of it are a cell. ``mine`` has the open groups that a node is in."""
    named = groups.join(labels.select("node", "component"), "node", "left")
    named = named.withColumn("component", F.coalesce("component", "node"))
    sized = named.join(sets.select("node", "n_shingles", "sketch"), "node")
    classes = sized.groupBy("sig").agg(
        F.min("component").alias("lo"), F.max("component").alias("hi"), F.sum("n_shingles").alias("total")
    )
    blocks = F.ceil(F.greatest(F.col("n") / BLOCK, F.col("total") / BLOCK_SHINGLES)).cast("int")
    rows = scratch(sized.join(classes.filter("lo < hi").select("sig", "total"), "sig").withColumn("blocks", blocks), "open")
    mine = rows.groupBy("node").agg(F.sort_array(F.collect_set("sig")).alias("mine"))
    return (
        rows.join(mine, "node")
        .withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "sig",
            F.least("block", "other").alias("i"),
            F.greatest("block", "other").alias("j"),
            "block",
            "node",
            (F.col("node") == F.col("centre")).alias("central"),
            "component",
            "n_shingles",
            "sketch",
            "mine",
        )
    )


def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by cell, a cell at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy() for c in CELL])
        cuts = (np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1).tolist()
        at = 0
        if held and [c[0].as_py() for c in (held[0].column(k) for k in CELL)] != keys[:, 0].tolist():
            cuts.insert(0, 0)
        for cut in cuts:
            held.append(batch.slice(at, cut - at))
            yield pa.Table.from_batches(held).combine_chunks()
            held, at = [], cut
        held.append(batch.slice(at))
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def near_pairs(cell: pa.Table, method: PartEnum) -> tuple[np.ndarray, ...]:
    """Pairs of a cell that are to be compared here: of different classes, not ruled out by sizes and
    sketches, not compared with the centre before, and met in no group before this one. In order of
    the distance of their sketches. Sums of counters bound it first, at an eighth of the work."""
    label, size, block = (cell.column(c).to_numpy() for c in ("component", "n_shingles", "block"))
    central = cell.column("central").to_numpy(zero_copy_only=False)
    counts = sketches(cell.column("sketch"))
    across = cell.column("i")[0].as_py() != cell.column("j")[0].as_py()
    coarse = counts.reshape(len(counts), 8, -1).sum(2)
    none = np.empty(0, np.int64)
    found = [(none, none, none)]
    for at in range(0, len(size), STRIP):
        some = slice(at, at + STRIP)
        fits = np.abs(coarse[some, None] - coarse).sum(2) <= method.most_apart(size[some, None], size)
        fits &= (label[some, None] != label) & ~(central[some, None] | central)
        if across:
            fits &= block[some, None] != block
        x, y = np.nonzero(np.triu(fits, at + 1))
        x += at
        apart = np.abs(counts[x] - counts[y]).sum(1)
        fits = apart <= method.most_apart(size[x], size[y])
        fits &= 100 * np.minimum(size[x], size[y]) >= method.percent * np.maximum(size[x], size[y])
        found.append((x[fits], y[fits], apart[fits]))
    x, y, apart = (np.concatenate(c) for c in zip(*found))
    if len(x):
        sig, mine = cell.column("sig")[0].as_py(), cell.column("mine")
        before = {k: {s for s in mine[k].as_py() if s < sig} for k in np.union1d(x, y).tolist()}
        own = np.array([before[i].isdisjoint(before[j]) for i, j in zip(x.tolist(), y.tolist())])
        x, y, apart = x[own], y[own], apart[own]
    order = np.argsort(apart, kind="stable")
    return x[order], y[order]


def with_near(rows: DataFrame, method: PartEnum) -> DataFrame:
    """The rows of cells that have a pair to be compared there."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for cell in cells(batches):
            x, y = near_pairs(cell, method)
            if len(x):
                held.append(cell.take(np.union1d(x, y)))
            if sum(t.num_rows for t in held) > 2000:
                yield from pa.concat_tables(held).combine_chunks().to_batches()
                held = []
        if held:
            yield from pa.concat_tables(held).combine_chunks().to_batches()

    return rows.repartition(*CELL).sortWithinPartitions(*CELL).mapInArrow(keep, rows.schema)


def joining_links(rows: DataFrame, members: DataFrame, method: PartEnum) -> DataFrame:
    """Links ``a``, ``b`` of each cell that join its classes: of n classes, n - 1 at most. Nearest
    pairs first; pairs whose classes a link of the cell has joined are not compared any more."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in cells(batches):
            found = forest(cell)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names=["a", "b"])

    def forest(cell: pa.Table) -> list[tuple[int, int]]:
        label, node, sets = cell.column("component").to_pylist(), cell.column("node").to_pylist(), cell.column("members")
        above = {c: c for c in label}

        def root(c: int) -> int:
            while above[c] != c:
                above[c] = c = above[above[c]]
            return c

        found = []
        for x, y in zip(*(side.tolist() for side in near_pairs(cell, method))):
            a, b = root(label[x]), root(label[y])
            if a == b:
                continue
            s, t = members_of(sets[x].as_py()), members_of(sets[y].as_py())
            if method.alike(len(np.intersect1d(s, t, assume_unique=True)), len(s), len(t)):
                above[max(a, b)] = min(a, b)
                found.append((node[x], node[y]))
        return found

    both = rows.join(members, "node")
    return both.repartition(*CELL).sortWithinPartitions(*CELL).mapInArrow(compare, "a long, b long")


def similar_documents(docs: DataFrame, percent: int = 90) -> DataFrame:
    """Per row: ``doc_id``, ``n_shingles``, and ``component_id``, the smallest id it is linked with
    over any number of links, its own included.

    Texts without words, null ones too, have no shingles and no links. Rows with one id are linked:
    what one is linked with, all are. Rows without an id have no links and no component. Copies are
    one set. An empty table gives an empty one, texts may be of any length, and other columns are
    not read.
    """
    method = PartEnum(percent)
    return settled(docs.sparkSession, lambda: classes(docs, method), "classes")


def classes(docs: DataFrame, method: PartEnum) -> DataFrame:
    sets = scratch(described(docs, method), "sets")
    live = sets.filter("doc_id IS NOT NULL AND n_shingles > 0")
    order = signed(live).repartition("sig").sortWithinPartitions("sig", "node")
    meetings = scratch(order.mapInArrow(meet, "sig long, centre long, node long"), "meetings")
    links = scratch(same(live, "set_key").union(same(live, "doc_id")), "links")

    pairs = meetings.select(F.col("centre").alias("a"), F.col("node").alias("b")).distinct()
    near = scratch(possible(pairs, live, method), "near")
    members = whole_sets(docs, live, near.select(F.explode(F.array("a", "b")).alias("node")))
    links = scratch(links.union(linked(near, members, method)), "links")
    labels = scratch(components(links), "labels")

    rows = scratch(with_near(open_cells(groups_of(meetings), labels, live), method), "cells")
    found = scratch(joining_links(rows, whole_sets(docs, live, rows), method), "found")
    if not found.isEmpty():
        labels = scratch(components(links.union(found)), "labels")

    ids = live.select("node", "doc_id").join(labels, "node")
    least = scratch(ids.groupBy("component").agg(F.min("doc_id").alias("component_id")), "least")
    named = scratch(small_join(labels, least, ["component"], "inner").select("node", "component_id"), "named")
    rows = small_join(sets.select("node", "doc_id", "n_shingles"), named, ["node"])
    return rows.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def representatives(docs: DataFrame, percent: int = 90) -> DataFrame:
    """One row of each group of similar documents, that with the smallest id, unchanged.

    Of rows with one id the one with the smallest text stays; rows without an id all stay.
    """
    classes = similar_documents(docs, percent).filter("doc_id IS NOT NULL")
    once = classes.groupBy("doc_id").agg(F.count("*").alias("n"), F.first("component_id").alias("c"))
    ids = scratch(once.filter("n > 1 OR doc_id <> c").select("doc_id", "n", "c"), "redundant")
    id_type = docs.schema["doc_id"].dataType
    listed = lambda df: df.select(F.col("doc_id").cast(id_type).alias("doc_id"))
    single = small_join(docs, listed(ids), ["doc_id"], "left_anti")
    several = ids.filter("n > 1 AND doc_id = c")
    if several.isEmpty():
        return single
    rows = small_join(docs, listed(several), ["doc_id"], "left_semi")
    first = Window.partitionBy("doc_id").orderBy("text", F.xxhash64(whole_row(docs)))
    numbered = rows.select(whole_row(docs), F.row_number().over(first).alias("place"))
    return single.unionByName(numbered.filter("place = 1").select("row.*"))
