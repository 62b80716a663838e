"""Personal data: fixed formats, and identifiers of other formats found by the words around them.

What the fixed formats find are the seeds. The words before and around a seed are a pattern; a
pattern is trusted as far as its slots in the corpus are filled by identifiers. Trusted patterns find
strings of a similar shape in their slots; these count for other patterns in turn, for a few rounds.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinflow.llm.common import received, scratch, sent, slices, whole_row
from clinflow.llm.shingles import ODD, mixed, word_hashes

#: Characters beside a slot that its words are looked for in.
NEAR = 200
#: The two sorts of patterns: two words before a slot, or one on each side.
SIDES = ("before", "around")
#: Bits of the filter of patterns.
FILTER_BITS = 1 << 24

KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match that could begin inside a run of digits begins where the run does.
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
#: Strings that may be identifiers in some other format, and what kinds of.
MAYBE_MAIL = re.compile(r"[^\s@<>,;]+@[^\s@<>,;]+")
MAYBE_NUMBER = re.compile(r"(?<![0-9A-Za-z.])[(]?[0-9][0-9(). -]{5,}[0-9](?![0-9A-Za-z])")
MAYBE_IP = re.compile(r"[0-9]+(?:\.[0-9]+){2,}")
DIGIT = re.compile("[0-9]")

SPANS = "array<struct<kind:int,start:int,end:int>>"
MENTIONS = "array<struct<start:int,end:int,seed:boolean,wide:boolean,kinds:array<int>,instance:bigint,patterns:array<string>>>"


@dataclass(frozen=True)
class Trust:
    """A pattern is trusted if so many different identifiers fill its slots, and these fill at least
    the share ``confidence`` of all its slots."""

    support: int = 5
    confidence: float = 0.5
    rounds: int = 3


def digits(s: str) -> str:
    return "".join(c for c in s if c in "0123456789")


def luhn(number: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(number)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """A local part reaches back from its @ as far as it can, but not into the match before."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (domain := DOMAIN.match(text, at + 1)):
            done = domain.end()
            out.append((start, done))
        at = text.find("@", max(at + 1, done))
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """Kind, start and end of what the fixed formats find, by start, then kind."""
    out = [(0, *s) for s in emails(text)] if "@" in text else []
    if DIGIT.search(text):
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) < 256 for p in m[0].split(".")):
                out.append((1, *m.span()))
        for m in CARD.finditer(text):
            if 14 <= len(d := digits(m[0])) <= 19 and luhn(d):
                out.append((2, *m.span()))
        for m in PHONE.finditer(text) if "+" in text else ():
            if 10 <= len(digits(m[0])) <= 15:
                out.append((3, *m.span()))
    return sorted(out, key=lambda s: (s[1], s[0], s[2]))


def maybe_spans(text: str) -> list[tuple[int, int, list[int]]]:
    """Start, end and possible kinds of strings that have the look of an identifier."""
    out = [(*m.span(), [0]) for m in MAYBE_MAIL.finditer(text)] if "@" in text else []
    for m in MAYBE_NUMBER.finditer(text):
        n = len(digits(m[0]))
        kinds = [1] * bool(MAYBE_IP.fullmatch(m[0])) + [2] * (12 <= n <= 19) + [3] * (7 <= n <= 15)
        if kinds:
            out.append((*m.span(), kinds))
    return out


def patterns_at(text: str, start: int, end: int) -> list[str]:
    """The two words before a slot; the word before and the one after it. Only whole words in the
    same text that are close by count, so that a pattern is found again wherever it stands."""
    before = text[max(0, start - NEAR) : start].lower()
    left = before.split()[-3:] if before[-1:].isspace() else []
    if start > NEAR and not before[0].isspace() and len(left) < 3:
        left = left[1:]  # the first may be cut
    left = left[-2:]
    after = text[end : end + NEAR].lower()
    right = after.split(None, 1) if after[:1].isspace() else []
    if len(right) == 1 and end + NEAR < len(text) and not after[-1].isspace():
        right = []
    found = ["before " + " ".join(left)] if len(left) == 2 else []
    if left and right:
        found.append(f"around {left[-1]} {right[0]}")
    return found


def mentions(text: str, base: list[tuple[int, int, int]]) -> list[dict]:
    """What stands in a slot of some pattern; ``wide`` if it has several words, once for each place."""
    out, wide = [], set()
    spans = [(s, e, [k], True) for k, s, e in base]
    if "@" in text or DIGIT.search(text):
        taken = bytearray(len(text))
        for _, s, e in base:
            taken[s:e] = b"\1" * (e - s)
        spans += [(s, e, kinds, False) for s, e, kinds in maybe_spans(text) if not any(taken[s:e])]
    for s, e, kinds, seed in spans:
        if found := patterns_at(text, s, e):
            name = xxhash.xxh64_intdigest(text[s:e].lower().encode()) - (1 << 63)
            new = " " in text[s:e] and (s, e) not in wide
            wide |= {(s, e)} if new else set()
            out.append(
                {"start": s, "end": e, "seed": seed, "wide": new, "kinds": kinds, "instance": name, "patterns": found}
            )
    return out


def described(docs: DataFrame, keep: list[str] | None) -> DataFrame:
    """Every row with ``base`` spans and ``mentions``, and ``key``, equal for equal texts only."""
    rows = docs.select(
        whole_row(docs, keep),
        F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256).alias("key"),
        "text",
    )
    added = T.StructType.fromDDL(f"base {SPANS}, mentions {MENTIONS}")
    schema = T.StructType([*rows.schema.fields[:2], *added.fields])

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        kinds = [to_arrow_type(f.dataType) for f in added.fields]
        for batch in slices(batches):
            bases, found = [], []
            for text in batch.column("text").to_pylist():
                base = base_spans(text or "")
                bases.append([dict(zip(("kind", "start", "end"), s)) for s in base])
                found.append(mentions(text or "", base))
            columns = [batch.column("row"), batch.column("key"), pa.array(bases, kinds[0]), pa.array(found, kinds[1])]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(describe, schema)


def pair_bits(first: np.ndarray, second: np.ndarray, kind: int) -> np.ndarray:
    """Where the filter has the bit of a pattern's two words, given by their hashes."""
    return mixed(first * ODD[0] + second * ODD[1] + np.uint64(kind)) % np.uint64(FILTER_BITS)


def pattern_filter(patterns: DataFrame) -> np.ndarray:
    """A bit per pattern, in an array of fixed size whatever their number."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            split = [p.split(" ") for p in batch.column("pattern").to_pylist()]
            found = []
            for kind, name in enumerate(SIDES):
                pairs = [p[1:] for p in split if p[0] == name]
                first, second = (word_hashes([p[i] for p in pairs]) for i in (0, 1))
                found.append(pair_bits(first, second, kind))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).astype(np.int64))], names=["bit"])

    bits = patterns.select("pattern").mapInArrow(places, "bit long")
    words = bits.groupBy(F.expr("bit div 64").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(bit % 64 AS INT))")).alias("bits"))
    out = np.zeros(FILTER_BITS // 64, np.int64)
    for r in words.collect():
        out[r.word] = r.bits
    return np.unpackbits(out.astype("<i8").view(np.uint8), bitorder="little").astype(bool)


def slots(docs: DataFrame, patterns: DataFrame) -> DataFrame:
    """How many slots each pattern has in all texts, whatever fills them; around a slot, one word only.

    Word pairs that are no pattern are dropped where they stand, by a filter of fixed size; the others
    are added up per task and joined with the patterns, which drops what the filter let through.
    """
    shared = sent(docs, np.packbits(pattern_filter(patterns)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.unpackbits(received(shared)).astype(bool)
        for batch in slices(batches):
            split = [(t or "").lower().split() for t in batch.column("text").to_pylist()]
            words = [w for ws in split for w in ws]
            h = word_hashes(words)
            doc = np.repeat(np.arange(len(split)), [len(ws) for ws in split])
            inside = doc[2:] == doc[:-2]
            found: Counter = Counter()
            for kind, (name, step) in enumerate(zip(SIDES, (1, 2))):
                second = h[step : len(h) - 2 + step]
                for i in np.flatnonzero(inside & wanted[pair_bits(h[:-2], second, kind)]).tolist():
                    found[f"{name} {words[i]} {words[i + step]}"] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], names=["pattern", "slots"]
            )

    counted = docs.select("text").mapInArrow(count, "pattern string, slots long")
    total = counted.groupBy("pattern").agg(F.sum("slots").alias("slots"))
    return scratch(total.join(patterns.select("pattern"), "pattern"), "slots")


def trusted_patterns(found: DataFrame, docs: DataFrame, trust: Trust) -> DataFrame | None:
    """``pattern``, ``kind`` and ``confidence``; None if there are none.

    Pattern and instance are scored in turn: a pattern by the scores of the instances in its slots,
    over all of its slots; an instance that is no seed by the best pattern it occurs in.
    """
    each = found.select(F.explode("mentions").alias("m")).select("m.*")
    edges = scratch(
        each.select("seed", "instance", "patterns", F.explode("kinds").alias("kind"))
        .select("seed", "instance", "kind", F.explode("patterns").alias("pattern"))
        .groupBy("pattern", "kind", "instance")
        .agg(F.max("seed").alias("seed"), F.count("*").alias("n")),
        "edges",
    )
    counted = edges.groupBy("pattern").agg(F.count("*").alias("c")).filter(F.col("c") >= trust.support)
    patterns = scratch(counted, "patterns")
    if patterns.isEmpty():
        return None
    totals = slots(docs, patterns)
    wide = each.filter("wide").select(F.explode("patterns").alias("pattern")).filter("pattern LIKE 'around %'")
    wide = wide.groupBy("pattern").agg(F.count("*").alias("slots")).join(patterns, "pattern", "left_semi")
    totals = scratch(totals.unionByName(wide).groupBy("pattern").agg(F.sum("slots").alias("slots")), "totals")
    seeds = edges.filter("seed").select("kind", "instance").distinct().withColumn("score", F.lit(1.0))
    scores = scratch(seeds, "scores")
    for _ in range(trust.rounds):
        scored = edges.join(scores, ["kind", "instance"]).groupBy("pattern", "kind")
        hits = scored.agg(F.sum(F.col("n") * F.col("score")).alias("hits"), F.count("*").alias("support"))
        share = F.least(F.lit(1.0), F.col("hits") / F.col("slots"))
        trusted = scratch(
            hits.join(totals, "pattern")
            .select("pattern", "kind", "support", share.alias("confidence"))
            .filter((F.col("support") >= trust.support) & (F.col("confidence") >= trust.confidence)),
            "trusted",
        )
        new = edges.filter("NOT seed").join(trusted, ["pattern", "kind"])
        new = new.join(seeds.select("kind", "instance"), ["kind", "instance"], "left_anti")
        learnt = new.groupBy("kind", "instance").agg(F.max("confidence").alias("score"))
        before, scores = scores, scratch(seeds.unionByName(learnt), "scores")
        if scores.count() == before.count():
            break
    return trusted


def find_pii(docs: DataFrame, trust: Trust = Trust(), keep: list[str] | None = None) -> DataFrame:
    """Every row with ``base`` and ``spans``, arrays of kind, start and end in code points.

    ``base`` is what the fixed formats find; ``spans`` holds that and what trusted patterns add, by
    start, then kind. A null or empty text has none; texts of any length are read whole. Equal texts
    get equal spans, so repeated rows do too. An empty table gives an empty one; columns are kept
    inside struct ``row``.
    """
    found = scratch(described(docs, keep), "mentions")
    trusted = trusted_patterns(found, docs, trust)
    if trusted is None:
        return found.select("row", "base", F.col("base").alias("spans"))
    each = found.select("key", F.explode(F.filter("mentions", lambda m: ~m["seed"])).alias("m"))
    slots_of = each.select(
        "key", "m.start", "m.end", "m.patterns", F.explode("m.kinds").alias("kind")
    ).select("key", "start", "end", "kind", F.explode("patterns").alias("pattern")).distinct()
    best = F.max_by("kind", F.struct("confidence", -F.col("kind")))
    added = slots_of.join(trusted, ["pattern", "kind"]).groupBy("key", "start", "end").agg(best.alias("kind"))
    lists = added.groupBy("key").agg(F.collect_list(F.struct("kind", "start", "end")).alias("added"))
    spans = F.concat("base", F.coalesce("added", F.array().cast(SPANS)))
    order = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], s["kind"], s["end"])))
    back = F.transform(order, lambda s: F.struct(s["kind"], s["start"], s["end"]))
    return found.join(scratch(lists, "added"), "key", "left").select("row", "base", back.alias("spans"))


def masked_rows(docs: DataFrame, trust: Trust = Trust()) -> DataFrame:
    """The rows with each span of their texts replaced by its kind, as in ``[email]``."""
    found = find_pii(docs, trust)
    names = F.array(*[F.lit(k) for k in KINDS])
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    text = F.col("row.text")

    def step(acc, s):  # a span that begins inside the one before is part of it
        gap = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        apart = s["start"] >= acc["at"]
        mark = F.concat(F.lit("["), F.get(names, s["kind"]), F.lit("]"))
        return F.struct(
            F.when(apart, F.concat(acc["out"], gap, mark)).otherwise(acc["out"]).alias("out"),
            F.greatest(acc["at"], s["end"]).alias("at"),
        )

    ended = F.aggregate("spans", start, step)
    rest = F.concat(ended["out"], F.substring(text, ended["at"] + 1, F.char_length(text)))
    body = F.when(F.size("spans") > 0, rest).otherwise(text)
    return found.select(F.col("row").withField("text", body).alias("row")).select("row.*")
