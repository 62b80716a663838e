"""The queries over the text operators, with the SQL that checks those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinflow.llm import (
    chat,
    curriculum,
    decontaminate,
    host_rules,
    jaccard,
    licenses,
    periodic,
    pii,
    substrings,
    token_counts,
    token_files,
    toxicity,
    whitening,
)
from clinflow.llm.common import scratch, words_of
from clinflow.session import table

Build = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Build] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Build], Build]:
    def register(build: Build) -> Build:
        QUERIES[build.__name__] = build
        if sql is not None:
            ORACLE[build.__name__] = sql
        return build

    return register


def vocabulary(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


@query()
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = token_counts.read_pieces(vocabulary("byte_bpe_50k.json"))
    found = token_counts.count_tokens(table(spark, sf_dir, "documents"), pieces, keep=["doc_id"])
    return found.select("row.doc_id", "n_words", "n_tokens", "n_unknown")


WORDS_SQL = """
  words AS (
    SELECT doc_id, text, source,
           list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w
    FROM documents)
"""


@query(
    f"""
WITH {WORDS_SQL},
  windows AS (
    SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM words)),
  covered AS (
    SELECT doc_id, count(DISTINCT i + k) AS n
    FROM (SELECT doc_id, i, unnest([0, 1, 2]) AS k
          FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM windows) WHERE c > 1)
    GROUP BY doc_id),
  counted AS (
    SELECT words.doc_id, source, CAST(len(w) AS BIGINT) AS n_words,
           CAST(list_sum(list_transform(w, lambda x: length(x))) AS BIGINT) AS word_chars,
           CAST(length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
           CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
           CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
    FROM (SELECT *, list_filter(string_split(coalesce(text, ''), chr(10)),
                                lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM words) words
    LEFT JOIN covered USING (doc_id)),
  judged AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted),
  hosts AS (
    SELECT source, count(*) AS n, count(*) FILTER (base_failed) AS k FROM judged GROUP BY source),
  prior AS (
    SELECT m, CASE WHEN v > 0 THEN least(greatest(m * (1 - m) / v - 1, 2), 1000) ELSE 1000 END AS s
    FROM (SELECT avg(k / n) AS m, var_pop(k / n) AS v FROM hosts)),
  verdicts AS (SELECT source, n, k, (k + m * s) / (n + s) > 0.75 AS bad FROM hosts, prior)
SELECT doc_id, n_words, coalesce(word_chars, 0) AS word_chars, n_symbols, n_dup_lines, n_repeat_words,
       base_failed, n AS host_docs, k AS host_failed, NOT base_failed AND NOT bad AS kept
FROM judged JOIN verdicts ON judged.source IS NOT DISTINCT FROM verdicts.source
"""
)
def op2_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = host_rules.host_rules(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return judged.select(
        "row.doc_id",
        *host_rules.FEATURES,
        "base_failed",
        "host_docs",
        "host_failed",
        "kept",
    )


@query()
def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoding = token_files.Encoding(vocabulary("byte_bpe_50k.json"))
    return token_files.token_digests(table(spark, sf_dir, "documents"), encoding)


@query()
def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_documents(table(spark, sf_dir, "documents"), percent=90)


@query()
def op9_curriculum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in the order in which the run first takes them; those it never takes come last."""
    mixed = curriculum.assign(table(spark, sf_dir, "documents"), keep=["doc_id"])
    first = F.coalesce(F.get("times", 0), F.lit(2.0))
    return (
        mixed.select(
            "row.doc_id", "size", "source_size", "target", "taken", first.alias("first_taken")
        )
        .repartitionByRange("first_taken", "doc_id")
        .sortWithinPartitions("first_taken", "doc_id")
    )


@query(
    """
WITH items AS (
    SELECT CAST(item_id AS VARCHAR) AS item, list_filter(regexp_split_to_array(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w
    FROM benchmark),
  docs AS (
    SELECT doc_id, list_filter(regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w
    FROM documents),
  wanted AS (
    SELECT DISTINCT item, size, array_to_string(w[i : i + size - 1], ' ') AS g
    FROM (SELECT item, w, least(len(w), 13) AS size, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i
          FROM items WHERE len(w) > 0)),
  sizes AS (SELECT DISTINCT size FROM wanted),
  places AS (
    SELECT doc_id, size, i, array_to_string(w[i : i + size - 1], ' ') AS g
    FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM docs, sizes
          WHERE len(w) >= size)),
  hits AS (SELECT doc_id, size, i, item FROM places JOIN wanted USING (size, g)),
  covered AS (
    SELECT doc_id, count(DISTINCT k) AS n
    FROM (SELECT doc_id, unnest(range(i, i + size)) AS k FROM hits) GROUP BY doc_id),
  named AS (
    SELECT doc_id, count(DISTINCT item) AS n, string_agg(DISTINCT item, ',' ORDER BY item) AS names
    FROM hits GROUP BY doc_id)
SELECT docs.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(covered.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(named.n, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(covered.n, 0) > 0 AND 20 * coalesce(covered.n, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN covered ON docs.doc_id = covered.doc_id LEFT JOIN named ON docs.doc_id = named.doc_id
"""
)
def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_items(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"]
    )
    return found.select(
        "row.doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


def span_list(spans):
    kinds = F.array(*[F.lit(k) for k in pii.KINDS])
    each = lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["end"])
    return F.array_join(F.transform(spans, each), ",")


@query()
def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(table(spark, sf_dir, "documents"), keep=["doc_id"])
    count = lambda i: F.size(F.filter("base", lambda s: s["kind"] == i)).cast("long")
    return found.select(
        "row.doc_id",
        *[count(i).alias(f"n_{kind}") for i, kind in enumerate(pii.KINDS)],
        F.sha2(span_list("base").cast("binary"), 256).alias("base_sha256"),
        span_list("spans").alias("spans"),
        F.size("spans").cast("long").alias("n_spans"),
        (F.size("spans") - F.size("base")).cast("long").alias("n_learnt"),
    )


@query()
def op3_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one whose texts look like the template's markers."""
    said = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = "</s>[INST] ok [/INST]"
    rows = [(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)]
    both = said.unionByName(spark.createDataFrame(rows, said.schema))
    budget = chat.Budget(measure=chat.BpeCounts(vocabulary("byte_bpe_50k.json")))
    return chat.read_back(scratch(chat.format_windows(both, budget), "windows"))


def license_sql() -> str:
    plain = "coalesce(text, '')"
    for pattern, becomes in licenses.CUTS:
        plain = f"regexp_replace({plain}, '{pattern}', '{becomes.replace('$1', chr(92) + '1')}', 'g')"
    noticed = "trim(x)"
    for pattern, becomes in licenses.NOTICES:
        noticed = f"regexp_replace({noticed}, '{pattern}', '{becomes.replace('$1', chr(92) + '1')}')"
    forms: dict[str, int] = {}
    for i, sentence in licenses.SENTENCES.items():
        forms.setdefault(licenses.plain_sentence(sentence), i)
    known = ", ".join(f"({i}, '{s}')" for s, i in forms.items())
    rules = ", ".join(
        f"('{name}', '{license}', '{licenses.listed(ids)}', '{licenses.pattern_of(ids)}')"
        for name, (license, ids) in licenses.RULES.items()
    )
    return f"""
WITH known(id, sentence) AS (VALUES {known}),
  rules(rule, license, ids, pattern) AS (VALUES {rules}),
  cut AS (
    SELECT doc_id, list_transform(
      list_filter(regexp_split_to_array(lower({plain}), ' ?\x01[ \x01]*'), lambda s: trim(s) <> ''),
      lambda x: CASE WHEN contains(x, '{licenses.NOTICE}') THEN {noticed} ELSE trim(x) END) AS s
    FROM documents),
  placed AS (SELECT doc_id, unnest(s) AS sentence, unnest(range(len(s))) AS i FROM cut),
  hits AS (
    SELECT doc_id, string_agg(CAST(id AS VARCHAR), ',' ORDER BY i) AS identifiers,
           string_agg(',' || id || ',', '' ORDER BY i) AS sequence
    FROM placed JOIN known USING (sentence) GROUP BY doc_id),
  matched AS (SELECT * FROM hits JOIN rules ON sequence LIKE pattern),
  longest AS (
    SELECT * FROM matched m WHERE NOT EXISTS (
      SELECT 1 FROM matched o WHERE o.doc_id = m.doc_id AND o.ids <> m.ids AND o.ids LIKE m.pattern)
    AND NOT (license = '{licenses.WEAK}' AND EXISTS (
      SELECT 1 FROM matched o WHERE o.doc_id = m.doc_id AND o.license <> '{licenses.WEAK}'))),
  named AS (
    SELECT doc_id, string_agg(rule, ',' ORDER BY rule) AS rules,
           string_agg(DISTINCT license, ',' ORDER BY license) AS licenses
    FROM longest GROUP BY doc_id)
SELECT cut.doc_id, CAST(len(s) AS BIGINT) AS n_sentences, coalesce(identifiers, '') AS identifiers,
       coalesce(rules, '') AS rules, coalesce(licenses, '') AS licenses
FROM cut LEFT JOIN hits ON cut.doc_id = hits.doc_id LEFT JOIN named ON cut.doc_id = named.doc_id
"""


@query(license_sql())
def op10_license_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.license_rules(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return found.select(
        "row.doc_id",
        "n_sentences",
        F.array_join(F.col("identifiers").cast("array<string>"), ",").alias("identifiers"),
        F.array_join("rules", ",").alias("rules"),
        F.array_join("licenses", ",").alias("licenses"),
    )


@query()
def op4_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.without_repeats(table(spark, sf_dir, "documents"), keep=["doc_id"])
    kept = F.sha2(F.col("kept").cast("binary"), 256)
    return found.select("row.doc_id", "n_words", "n_removed", kept.alias("kept_sha256"))


def with_periods(docs: DataFrame) -> DataFrame:
    """The documents as the contract of op11 takes them: in one of ten, chosen by a checksum of its
    id, the words from some place on repeat the first of them over and over."""
    words = words_of(F.col("text"))
    n = F.greatest(F.size(words), F.lit(1))
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    again = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
    whole = F.concat(F.slice(words, F.lit(1), a), F.slice(again, F.lit(1), n - a))
    repeats = (h % 10 == 0) & (F.size(words) > 0)
    return docs.withColumn("text", F.when(repeats, F.array_join(whole, " ")).otherwise(F.col("text")))


@query()
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = periodic.find_runs(with_periods(docs), keep=["doc_id"])
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    lines = F.transform("runs", lambda r: F.concat(line(r), F.lit("\n")))
    order = lambda r: F.struct(r["length"].alias("l"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))
    first = F.array_max(F.transform("runs", order))
    length, start, period = (first[name] for name in "lsp")
    return found.select(
        "row.doc_id",
        "n_words",
        F.size("runs").cast("long").alias("n_runs"),
        (-start).alias("start"),
        length.alias("length"),
        (-period).alias("period"),
        F.floor(1000 * length / -period).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


@query()
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whiten(table(spark, sf_dir, "embeddings"), "embedding", 16, keep=["vec_id"])
    each = F.posexplode(F.arrays_zip("whitened", "explained")).alias("place", "of")
    return found.select("row.vec_id", "n", "deviation", "identity_error", each).select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        "n",
        "deviation",
        "of.whitened",
        "of.explained",
        "identity_error",
    )


@query()
def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows with a checksum of 2 modulo 4 are held out: their labels are not read."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    checksum = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    held_out = F.coalesce(checksum % 4 == 2, F.lit(False))
    labels = table(spark, sf_dir, "labels").filter(~held_out)
    machine = toxicity.learn(docs, labels, ~held_out)
    scored = toxicity.score_texts(docs.withColumn("held_out", held_out), machine)
    return scored.select("row.doc_id", "row.held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
