"""Periodic runs of words, found in a grammar of each text.

Re-Pair replaces pairs of neighbouring symbols that occur more than once by new symbols, rule by
rule, and a balanced tree joins what is left. A run lies across the boundary of exactly one node of
the tree that holds it whole, and nodes with one symbol have one text, so that the runs across each
symbol's boundary are looked for once, at its first place, and carried to all its other places. Runs
that a node cuts off are parts of longer ones there and merge with them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinflow.llm.common import slices, whole_row

COLUMNS = "n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
#: Words whose texts are worked on together, unless one text alone has more.
TOGETHER = 200_000
#: Pairs of places that are compared at a time.
COMPARED = 1_000_000
BASE = np.uint64(0x9E3779B97F4A7C15)


class Nodes:
    """Nodes of the grammars: where each symbol's text first stands, and all places it stands at."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.places: list[tuple[np.ndarray, np.ndarray]] = []
        self.count = 0

    def add(self, rule: np.ndarray, first: np.ndarray, at: np.ndarray, mid: np.ndarray, end: np.ndarray) -> None:
        """Places ``at`` to ``end`` joined at ``mid``; ``rule`` numbers their symbols from 0, ``first``
        is the first place of each."""
        self.parts.append((at[first], mid[first], end[first]))
        self.places.append((rule + self.count, at))
        self.count += len(first)

    def table(self) -> tuple[np.ndarray, ...]:
        if not self.parts:
            return tuple(np.empty(0, np.int64) for _ in range(5))
        start, mid, end = (np.concatenate(x) for x in zip(*self.parts))
        rule, at = (np.concatenate(x) for x in zip(*self.places))
        return start, mid, end, rule, at


def group_numbers(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The number of each key in ascending order, where each first stands, and how often it does."""
    order = np.argsort(key, kind="stable")
    new = np.concatenate(([True], key[order[1:]] != key[order[:-1]]))
    number = np.empty(len(key), np.int64)
    number[order] = np.cumsum(new) - 1
    starts = np.flatnonzero(new)
    return number, order[starts], np.diff(np.append(starts, len(key)))


def re_pair(symbols: np.ndarray, doc: np.ndarray) -> Nodes:
    """Grammars of all texts at once; ``symbols`` of different texts differ.

    A round replaces, in each text, the pairs that occur at least half as often as its most frequent
    one; where chosen pairs overlap, the more frequent goes first, and of equal ones the left.
    """
    nodes, fresh = Nodes(), int(symbols.max(initial=0)) + 1
    at = np.arange(len(symbols))
    end = at + 1
    done: list[tuple[np.ndarray, ...]] = []
    while len(symbols) > 1:
        same = doc[1:] == doc[:-1]
        key = np.where(same, (symbols[:-1] << 32) | symbols[1:], -1)
        number, first, often = group_numbers(key)
        often = np.where(key[first] < 0, 0, often)
        most = np.zeros(int(doc[-1]) + 1, np.int64)
        np.maximum.at(most, doc[first], often)
        wanted = (often >= 2) & (2 * often >= most[doc[first]])
        if not wanted.any():
            break
        # A rank per pair, by frequency; pairs that are not wanted have none.
        rank = np.full(len(first), -1)
        chosen = np.flatnonzero(wanted)
        rank[chosen[np.lexsort((first[chosen], -often[chosen]))[::-1]]] = np.arange(len(chosen))
        rank = rank[number]
        cuts = np.flatnonzero(np.concatenate(([True], rank[1:] != rank[:-1])))
        level = rank[cuts]
        before, after = np.append(-1, level[:-1]), np.append(level[1:], -1)
        top = (level >= 0) & (level > before) & (level > after)
        length = np.diff(np.append(cuts, len(rank)))
        offset = np.arange(len(rank)) - np.repeat(cuts, length)
        left = np.flatnonzero(np.repeat(top, length) & (offset % 2 == 0))
        rule, where, _ = group_numbers(number[left])
        nodes.add(rule, where, at[left], at[left + 1], end[left + 1])
        symbols = symbols.copy()
        end = end.copy()
        symbols[left], end[left] = fresh + rule, end[left + 1]
        fresh += len(where)
        stay = np.ones(len(symbols), bool)
        stay[left + 1] = False
        # Texts without a repeated pair are done.
        repeats = most[doc] >= 2
        out = stay & ~repeats
        done.append((doc[out], at[out], end[out]))
        stay &= repeats
        symbols, doc, at, end = symbols[stay], doc[stay], at[stay], end[stay]
    done.append((doc, at, end))
    doc, at, end = (np.concatenate(x) for x in zip(*done))
    order = np.argsort(at, kind="stable")
    join_rest(nodes, doc[order], at[order], end[order])
    return nodes


def join_rest(nodes: Nodes, doc: np.ndarray, at: np.ndarray, end: np.ndarray) -> None:
    """A balanced tree over the symbols that are left of each text."""
    while len(doc) > 1:
        starts = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
        offset = np.arange(len(doc)) - np.repeat(starts, np.diff(np.append(starts, len(doc))))
        left = np.flatnonzero((offset[:-1] % 2 == 0) & (doc[1:] == doc[:-1]))
        if not len(left):
            break
        nodes.add(np.arange(len(left)), np.arange(len(left)), at[left], at[left + 1], end[left + 1])
        end = end.copy()
        end[left] = end[left + 1]
        stay = np.ones(len(doc), bool)
        stay[left + 1] = False
        doc, at, end = doc[stay], at[stay], end[stay]


class Equal:
    """Compares parts of a sequence by sums of powers; different parts may seem equal, hardly ever,
    equal ones never different."""

    def __init__(self, ids: np.ndarray) -> None:
        x = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(29)
        self.power = np.concatenate(([np.uint64(1)], np.cumprod(np.full(len(ids), BASE))))
        self.sums = np.concatenate(([np.uint64(0)], np.cumsum(x * self.power[:-1])))

    def parts(self, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Is the part of a length from ``a`` on that from ``b`` > ``a`` on?"""
        s = self.sums
        return (s[a + length] - s[a]) * self.power[b - a] == s[b + length] - s[b]

    def forward(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How far the parts from ``a`` and from ``b`` on agree, up to ``most``."""
        low, high = np.zeros_like(most), most.copy()
        while (low < high).any():
            mid = (low + high + 1) // 2
            fits = self.parts(a, b, mid)
            low, high = np.where(fits, mid, low), np.where(fits, high, mid - 1)
        return low

    def backward(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How far the parts before ``a`` and before ``b`` agree, up to ``most``."""
        low, high = np.zeros_like(most), most.copy()
        while (low < high).any():
            mid = (low + high + 1) // 2
            fits = self.parts(a - mid, b - mid, mid)
            low, high = np.where(fits, mid, low), np.where(fits, high, mid - 1)
        return low


Found = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def across(ids: np.ndarray, symbols: np.ndarray, doc: np.ndarray, nodes: tuple[np.ndarray, ...], least: int, times: int) -> Found:
    """Runs across the boundaries of nodes, cut off at the nodes' ends: node, start, end, period.

    A run of four periods and more holds the pair of words at the boundary three times at distances
    of its period, and two periods on one side of the boundary at least. So the next places of that
    pair give the periods to try, and comparing one period with the next rules nearly all out.
    """
    start, mid, end = nodes
    node = np.flatnonzero(end - start >= max(least, times))
    number, _, often = group_numbers(np.where(doc[1:] == doc[:-1], (symbols[:-1] << 32) | symbols[1:], -1))
    node = node[often[number[mid[node] - 1]] >= 3]
    if not len(node):
        return tuple(np.empty(0, np.int64) for _ in range(4))
    span = len(ids) + 1
    listed = np.sort(number * span + np.arange(len(number)))
    s, m, e = start[node], mid[node], end[node]
    p = m - 1
    widest = (e - s) // times
    here = number[p] * span
    low = np.searchsorted(listed, here + np.maximum(s, p - widest))
    high = np.searchsorted(listed, here + np.minimum(e - 2, p + widest), "right")
    equal = Equal(ids)
    found = []
    steps = np.cumsum(high - low) // COMPARED
    for some in np.split(np.arange(len(node)), np.flatnonzero(np.diff(steps)) + 1):
        n = (high - low)[some]
        which = np.repeat(some, n)
        other = listed[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low[some], n)] % span
        q = np.abs(other - p[which])
        # The pair on the left: two periods before the boundary; on the right: two after it.
        a = np.where(other < p[which], m[which] - 2 * q, p[which])
        fits = (q > 0) & (a >= s[which]) & (a + 2 * q + (other < p[which]) <= e[which])
        which, q, a, other = which[fits], q[fits], a[fits], other[fits]
        fits = equal.parts(a, a + q, q + (other < p[which]))
        which, q, other = which[fits], q[fits], other[fits]
        if not len(which):
            continue
        left = np.minimum(other, p[which])
        begin = left - equal.backward(left, left + q, left - s[which])
        stop = left + q + equal.forward(left, left + q, e[which] - left - q)
        fits = stop - begin >= np.maximum(least, times * q)
        found.append((node[which[fits]], begin[fits], stop[fits], q[fits]))
    if not found:
        return tuple(np.empty(0, np.int64) for _ in range(4))
    n, a, b, q = (np.concatenate(x) for x in zip(*found))
    return shortest((n, a, b), q)


def shortest(keys: tuple[np.ndarray, ...], q: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of what agrees in all keys, the row with the least ``q``."""
    order = np.lexsort((q, *keys[::-1]))
    keys, q = tuple(k[order] for k in keys), q[order]
    new = np.concatenate(([True], np.logical_or.reduce([k[1:] != k[:-1] for k in keys])))[: len(q)]
    return (*(k[new] for k in keys), q[new])


def stretches(x: np.ndarray, q: int, least: int, times: int) -> list[tuple[int, int]]:
    """All runs with period ``q``, smallest or not, by comparing every word with the one ``q`` on."""
    same = np.concatenate(([0], (x[:-q] == x[q:]).astype(np.int8), [0]))
    turns = np.flatnonzero(np.diff(same))
    found = ((int(a), int(b) + q) for a, b in zip(turns[::2], turns[1::2]))
    return [(a, b) for a, b in found if b - a >= max(least, times * q)]


def runs_of(ids: np.ndarray, sizes: np.ndarray, least: int = 6, times: int = 4) -> list[list[tuple[int, int, int]]]:
    """The runs of each text as (start, length, period), in order; ``ids`` are the words of all texts
    in a row and ``sizes`` how many each has."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in sizes]
    if len(ids) < least:
        return out
    doc = np.repeat(np.arange(len(sizes)), sizes)
    first = np.cumsum(sizes) - sizes
    symbols = own_symbols(doc, ids)
    start, mid, end, rule, place = re_pair(symbols, doc).table()
    node, a, b, q = across(ids, symbols, doc, (start, mid, end), least, times)
    if not len(node):
        return out
    # To all places of the node's symbol.
    order = np.argsort(rule, kind="stable")
    low, high = np.searchsorted(rule[order], node), np.searchsorted(rule[order], node, "right")
    n = high - low
    each = np.repeat(np.arange(len(node)), n)
    at = place[order[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)]]
    shift = at - start[node[each]]
    a, b, q = a[each] + shift, b[each] + shift, q[each]
    d, a, b, q = merged(doc[a], a, b, q)
    broken = set()
    for i, s, e, p in zip(d.tolist(), a.tolist(), b.tolist(), q.tolist()):
        if np.array_equal(ids[s : e - p], ids[s + p : e]):
            out[i].append((s - int(first[i]), e - s, p))
        else:
            broken.add((i, p))
    for i, p in broken:
        x = ids[first[i] : first[i] + sizes[i]]
        out[i] = [r for r in out[i] if r[2] != p] + [(s, e - s, p) for s, e in stretches(x, p, least, times)]
    for i in {i for i, _ in broken}:
        best: dict[tuple[int, int], int] = {}
        for s, length, p in out[i]:
            best[s, length] = min(p, best.get((s, length), p))
        out[i] = [(s, length, p) for (s, length), p in best.items()]
    return [sorted(r, key=lambda x: (x[0], x[2])) for r in out]


def own_symbols(doc: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Words as numbers under 2^31 that differ from text to text."""
    wide = int(ids.max()) + 1
    if wide * (int(doc[-1]) + 1) < 1 << 30:
        return doc * wide + ids
    return group_numbers(doc * wide + ids)[0]


def merged(d: np.ndarray, a: np.ndarray, b: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, ...]:
    """Intervals of one text and period that share a whole period are one; of equal ones that with
    the smallest period stays."""
    order = np.lexsort((b, a, q, d))
    d, a, b, q = d[order], a[order], b[order], q[order]
    group = np.cumsum(np.concatenate(([True], (d[1:] != d[:-1]) | (q[1:] != q[:-1])))) - 1
    far = int(b.max()) + 1
    reach = np.maximum.accumulate(b + group * far) - group * far
    new = np.concatenate(([True], (group[1:] != group[:-1]) | (a[1:] > reach[:-1] - q[1:])))
    starts = np.flatnonzero(new)
    d, a, b, q = d[starts], a[starts], np.maximum.reduceat(b, starts), q[starts]
    return shortest((d, a, b), q)


def find_runs(docs: DataFrame, keep: list[str] | None = None, least: int = 6, times: int = 4) -> DataFrame:
    """Each row as struct ``row`` with ``n_words``, its ``runs`` and the ``collapsed`` text.

    A run is a stretch of words with a smallest period q that no neighbouring word extends, at least
    ``least`` words and ``times`` (four or more) periods long; ``runs`` has start, length and period,
    in words from 0, by start, then period. The collapsed text has of every run its first period
    only: kept words joined by single spaces.

    A null or empty text has no words, no runs and an empty collapsed text; a text of any length is
    one grammar in one task. Rows are told apart by place, so repeated rows and ids are as many rows
    again; an empty table gives an empty one. Of the input only ``text`` and ``keep`` are read.
    """
    if times < 4 or least < 1:
        raise ValueError("runs are looked for from four periods on")
    rows = docs.select(whole_row(docs, keep), F.col("text").cast("string").alias("text"))
    schema = T.StructType([rows.schema["row"], *T.StructType.fromDDL(COLUMNS).fields])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2000):
            split = [(t or "").encode().split() for t in batch.column("text").to_pylist()]
            at = 0
            while at < len(split):
                upto, total = at, 0
                while upto < len(split) and (upto == at or total + len(split[upto]) <= TOGETHER):
                    total += len(split[upto])
                    upto += 1
                yield described(batch.slice(at, upto - at), split[at:upto])
                at = upto

    def described(batch: pa.RecordBatch, split: list[list[bytes]]) -> pa.RecordBatch:
        sizes = np.array([len(w) for w in split], np.int64)
        words = pa.array([w for ws in split for w in ws], pa.large_binary())
        ids = words.dictionary_encode().indices.to_numpy().astype(np.int64)
        runs = runs_of(ids, sizes, least, times)
        kept = []
        for ws, found in zip(split, runs):
            if found:
                stay = np.ones(len(ws), bool)
                for start, length, period in found:
                    stay[start + period : start + length] = False
                ws = [ws[i] for i in np.flatnonzero(stay).tolist()]
            kept.append(b" ".join(ws).decode())
        named = [[{"start": s, "length": n, "period": p} for s, n, p in found] for found in runs]
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        return pa.RecordBatch.from_arrays(
            [batch.column("row"), pa.array(sizes), pa.array(named, kind), pa.array(kept, pa.string())],
            names=schema.names,
        )

    return rows.mapInArrow(find, schema)
