"""A filter of fixed size that says which keys can't be in a table, made by an aggregation.

A large table that is joined with many keys is cut down before its shuffle: rows whose key can't be
among them need not be moved. Whatever the keys, the filter is as large as it was asked to be; the
more keys there are, the more rows pass that have no partner, which the join itself then drops.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a filter; it is sent to every executor. With 2 hashes, 1.6 million keys let 4 % pass.
FILTER_BITS = 1 << 24
HASHES = 2
_WORD, _BITS = "_word", "_bits"


def _place(on: list[str], hash_no: int, bits: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(hash_no), *on), F.lit(bits))


def key_filter(keys: DataFrame, on: list[str], bits: int = FILTER_BITS) -> DataFrame:
    """The filter: words of 64 bits, each with the bits of the keys that fall into it.

    Combined where the keys are, so that a task hands on no more words than the filter has. Keys with
    a missing part match nothing and are left out.
    """
    if bits < 64 or bits & (bits - 1):
        raise ValueError("a filter has a power of two bits, 64 at least")
    places = F.array(*[_place(on, i, bits) for i in range(HASHES)])
    placed = keys.select(*on).dropna().select(F.explode(places).alias("_p"))
    bit = F.expr("shiftleft(1L, CAST(_p & 63 AS INT))")
    return placed.groupBy(F.expr("shiftright(_p, 6)").alias(_WORD)).agg(F.bit_or(bit).alias(_BITS))


def with_possible(df: DataFrame, words: DataFrame, on: list[str], name: str, bits: int = FILTER_BITS) -> DataFrame:
    """Add whether a row's key may be among those of a written ``key_filter`` of that many bits. The
    filter is broadcast, which its size allows; the rows stay where they are."""
    found = df
    for i in range(HASHES):
        word, set_bits, place = f"{_WORD}{i}", f"{_BITS}{i}", f"_p{i}"
        part = F.broadcast(words.select(F.col(_WORD).alias(word), F.col(_BITS).alias(set_bits)))
        found = found.withColumn(place, _place(on, i, bits))
        found = found.join(part, F.expr(f"shiftright({place}, 6)") == F.col(word), "left")
    hit = [F.coalesce(F.expr(f"getbit(_bits{i}, CAST(_p{i} & 63 AS INT)) = 1"), F.lit(False)) for i in range(HASHES)]
    possible = hit[0]
    for h in hit[1:]:
        possible = possible & h
    helpers = [f"{c}{i}" for i in range(HASHES) for c in (_WORD, _BITS, "_p")]
    return found.withColumn(name, possible).drop(*helpers)
