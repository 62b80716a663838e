"""Quality rules for documents, and verdicts on the hosts they come from.

Every document is judged by rules on its words. The failures are counted by host, the failure rate
of each host is shrunk towards that of all hosts with a beta prior fitted to them, and documents of
hosts whose shrunk rate is over the limit are rejected as well. Only built-in functions are used.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinflow.llm.common import scratch, small_join, whole_row, words_of

SYMBOLS = "#*$%&|<>"
WHITE = " \t\n\x0b\x0c\r"
#: Low bits that hold the place of a window, beside the high bits of its hash. A text of 2^28 words
#: can't come: as an array they would take twice the 2 GB that a row has room for.
PLACE_BITS = 28
FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rules:
    """``min_words``, ``max_repeat_percent``: a document fails below, or above. ``max_host_rate``: a
    host is rejected if its shrunk failure rate is higher. ``max_prior``: the prior counts as so
    many documents at most, ``min_prior`` at least."""

    min_words: int = 50
    max_repeat_percent: int = 50
    max_host_rate: float = 0.75
    min_prior: float = 2.0
    max_prior: float = 1000.0


def without(text: Column, letters: str) -> Column:
    return F.translate(text, letters, "")


def repeated_places(df: DataFrame) -> DataFrame:
    """Add ``places``: where in ``words`` three-word windows begin that occur more than once.

    Window hashes are sorted together with their places, in one array of integers; neighbours with
    equal hash bits are candidates, and the words of those few are compared themselves.
    """
    window = lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2))
    n = F.size("words")
    starts = F.when(n >= 3, F.sequence(F.lit(0), n - 3)).otherwise(F.array().cast("array<int>"))
    mask = F.lit((1 << PLACE_BITS) - 1).cast("long")
    df = df.withColumn(
        "keys",
        F.sort_array(
            F.transform(starts, lambda i: F.shiftleft(window(i), PLACE_BITS).bitwiseOR(i.cast("long")))
        ),
    )
    high = lambda x: F.shiftright(x, PLACE_BITS)
    like = lambda x, other: F.coalesce(high(x) == high(other), F.lit(False))
    near = F.filter(
        "keys", lambda x, i: like(x, F.get("keys", i - 1)) | like(x, F.get("keys", i + 1))
    )
    df = df.withColumn("near", F.transform(near, lambda x: x.bitwiseAND(mask).cast("int")))
    df = df.withColumn(
        "same",
        F.sort_array(
            F.transform(
                "near",
                lambda i: F.struct(
                    F.array(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2)).alias("w"),
                    i.alias("i"),
                ),
            )
        ),
    )
    equal = lambda x, other: F.coalesce(x["w"] == other["w"], F.lit(False))
    hits = F.filter(
        "same", lambda x, i: equal(x, F.get("same", i - 1)) | equal(x, F.get("same", i + 1))
    )
    return df.withColumn("places", F.sort_array(F.transform(hits, lambda x: x["i"])))


def rule_features(df: DataFrame) -> DataFrame:
    """Add the counts of :data:`FEATURES` for column ``text`` (null: empty)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    df = repeated_places(df.withColumn("words", words_of(F.col("text"))))
    lines = F.filter(F.split(text, "\n"), lambda line: without(line, WHITE) != "")
    covered = F.transform(
        "places", lambda p, i: F.least(F.lit(3), F.coalesce(F.get("places", i + 1) - p, F.lit(3)))
    )
    length = lambda c: F.char_length(c).cast("long")
    return (
        df.withColumn("lines", lines)
        .withColumn("n_words", F.size("words").cast("long"))
        .withColumn("word_chars", length(without(text, WHITE)))
        .withColumn("n_symbols", length(text) - length(without(text, SYMBOLS)))
        .withColumn("n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"))
        .withColumn(
            "n_repeat_words", F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x)
        )
        .drop("words", "keys", "near", "same", "places", "lines")
    )


def fails(rules: Rules) -> Column:
    return (F.col("n_words") < rules.min_words) | (
        100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words")
    )


def host_verdicts(judged: DataFrame, rules: Rules) -> DataFrame:
    """Per host: documents, failures, shrunk rate, verdict. ``judged`` has ``host``, ``base_failed``.

    The prior Beta(m s, (1 - m) s) has the mean m of the hosts' rates; its weight s follows from
    their variance v as m (1 - m) / v - 1, within the bounds of ``rules``. Hosts without spread take
    the largest weight. Documents without a host are a host of their own.
    """
    hosts = scratch(
        judged.groupBy("host").agg(
            F.count("*").alias("host_docs"),
            F.sum(F.col("base_failed").cast("long")).alias("host_failed"),
        ),
        "hosts",
    )
    rate = F.col("host_failed") / F.col("host_docs")
    mean, spread = hosts.agg(F.avg(rate), F.var_pop(rate)).first()
    mean, spread = mean or 0.0, spread or 0.0
    weight = mean * (1 - mean) / spread - 1 if spread > 0 else rules.max_prior
    weight = min(max(weight, rules.min_prior), rules.max_prior)
    shrunk = (F.col("host_failed") + mean * weight) / (F.col("host_docs") + weight)
    return hosts.withColumn("host_rate", shrunk).withColumn(
        "host_rejected", shrunk > rules.max_host_rate
    )


def host_rules(docs: DataFrame, host: Column | str = "source", rules: Rules = Rules(), keep: list[str] | None = None) -> DataFrame:  # noqa: E501
    """Judge every row: struct ``row`` of the input's columns (or those in ``keep``), the counts,
    ``base_failed``, the host's figures and ``kept``.

    The judged rows are written once, for the hosts are counted from them and joined back. A text
    that is null or empty has no words and fails; one of any length is read whole. Repeated rows are judged and counted each; an
    empty table gives an empty one; input columns of any name are safe inside ``row``.
    """
    host = F.col(host) if isinstance(host, str) else host
    rows = docs.select(
        whole_row(docs, keep), host.cast("string").alias("host"), F.col("text")
    )
    judged = rule_features(rows).withColumn("base_failed", fails(rules)).drop("text")
    judged = scratch(judged, "judged")
    verdicts = scratch(host_verdicts(judged.select("host", "base_failed"), rules), "verdicts")
    key = F.struct(F.coalesce("host", F.lit("")).alias("name"), F.col("host").isNull().alias("none"))
    joined = small_join(
        judged.withColumn("key", key), verdicts.withColumn("key", key).drop("host"), ["key"]
    ).drop("key")
    return joined.withColumn("kept", ~F.col("base_failed") & ~F.col("host_rejected"))


def kept_rows(docs: DataFrame, host: Column | str = "source", rules: Rules = Rules()) -> DataFrame:
    """The rows that pass, with the columns of the input and nothing else."""
    return host_rules(docs, host, rules).filter("kept").select("row.*")
