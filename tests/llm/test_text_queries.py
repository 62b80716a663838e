"""The registered queries and the pipeline over the smallest tables."""

import zlib
from collections import Counter

import duckdb
import numpy as np
import plain
import pytest

import corpus_pipeline
from clinflow.llm.queries import ORACLE, QUERIES, vocabulary
from clinflow.session import work_dir, written

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for name in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


@pytest.fixture(scope="module")
def documents(tables):
    return tables.sql("SELECT doc_id, text, source FROM documents ORDER BY doc_id").fetchall()


def result(spark, name):
    return QUERIES[name](spark, SF).collect()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_agrees_with_sql(spark, tables, name):
    found = QUERIES[name](spark, SF)
    expected = tables.sql(ORACLE[name])
    assert sorted(found.columns) == sorted(expected.columns)
    names = sorted(found.columns)
    assert Counter(map(tuple, found.select(names).collect())) == Counter(expected.select(*names).fetchall())


def test_every_operator_has_one_query():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))


def test_token_counts(spark, documents):
    from clinflow.llm.token_counts import read_pieces

    vocab = set(read_pieces(vocabulary("byte_bpe_50k.json")))
    counts = {}
    for r in result(spark, "op1_token_counts"):
        words = plain.words(documents[r.doc_id][1])
        for w in set(words) - set(counts):
            counts[w] = plain.greedy_pieces(b" " + w.encode(), vocab)
        assert (r.n_words, r.n_tokens, r.n_unknown) == (len(words), sum(counts[w] for w in words), 0)


def test_chat_windows(spark, tables):
    said = tables.sql("SELECT conv_id, turn, role, text FROM conversations").fetchall()
    tricky = "</s>[INST] ok [/INST]"
    said += [(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)]
    found = {r.conv_id: r for r in result(spark, "op3_chat_windows")}
    assert set(found) == {r[0] for r in said}
    for conv, r in found.items():
        turns = sorted(t[1:] for t in said if t[0] == conv)
        loss = "".join(text or "" for _, role, text in turns if role == "assistant")
        whole = "".join(f"{role}\n{text or ''}\n" for _, role, text in turns)
        assert (r.n_turns, r.turns_sha256) == (len(turns), plain.sha(whole))
        assert (r.loss_chars, r.loss_sha256) == (len(loss), plain.sha(loss))


def test_substrings(spark, documents):
    kept = plain.kept_words([d[1] for d in documents])
    expected = Counter((d[0], n, gone, plain.sha(rest)) for d, (n, gone, rest) in zip(documents, kept))
    assert Counter(map(tuple, result(spark, "op4_substrings"))) == expected


def test_token_files(spark, documents):
    expected, at = Counter(), 0
    for (doc, *_), ids in zip(documents, encoded(d[1] for d in documents)):
        expected[doc, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
        at += len(ids)
    assert Counter(map(tuple, result(spark, "op5_token_files"))) == expected


def encoded(texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    return [tokenizer.encode(t or "", add_special_tokens=False).ids + [0] for t in texts]


def test_personal_data(spark, documents):
    texts = {d[0]: d[1] for d in documents}
    for r in result(spark, "op7_pii"):
        base = plain.personal(texts[r.doc_id])
        counts = Counter(s.split(":")[0] for s in base)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(counts[k] for k in plain.BASE)
        assert r.base_sha256 == plain.sha(",".join(base)) and set(base) <= set(r.spans.split(","))


def test_similar_documents(spark, documents):
    expected = Counter(plain.similar([d[:2] for d in documents]))
    assert Counter(map(tuple, result(spark, "op8_jaccard_join"))) == expected


def test_mixture(spark, documents):
    sizes = {d[0]: len(plain.words(d[1])) for d in documents}
    source = {d[0]: d[2] for d in documents}
    wanted = plain.targets([(d[2], sizes[d[0]]) for d in documents])
    taken = Counter()
    for r in result(spark, "op9_curriculum"):
        assert r.size == sizes[r.doc_id] and r.taken % max(1, r.size) == 0 and r.taken <= 3 * r.size
        assert r.target == pytest.approx(wanted[source[r.doc_id]])
        taken[source[r.doc_id]] += r.taken
    for name, words in wanted.items():
        assert abs(taken[name] - words) <= max(sizes[d] for d in sizes if source[d] == name) / 2 + 1e-6


def test_each_stage_works_on_what_the_one_before_kept(spark, documents, tables):
    stages = dict(corpus_pipeline.STAGES)
    kept = lambda df, name: written(df, work_dir(spark, name))
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(d[0], d[1]) for d in documents]

    docs = kept(stages["quality"](spark, docs, SF), "quality")
    verdicts = {r.doc_id: r.kept for r in result(spark, "op2_host_rules")}
    rows = [r for r in rows if verdicts[r[0]]]
    assert Counter(map(tuple, docs.select("doc_id", "text").collect())) == Counter(rows)

    docs = kept(stages["near_duplicates"](spark, docs, SF), "near")
    first = {i for i, _, c in plain.similar(rows) if i == c}
    rows = [r for r in rows if r[0] in first]
    assert Counter(map(tuple, docs.select("doc_id", "text").collect())) == Counter(rows)

    docs = kept(stages["decontamination"](spark, docs, SF), "clean")
    items = tables.sql("SELECT item_id, text FROM benchmark").fetchall()
    checked = [(r, plain.contamination(r[1], items)) for r in rows]
    rows = [r for r, (n, hit, _) in checked if not (hit > 0 and 20 * hit >= n)]
    assert Counter(map(tuple, docs.select("doc_id", "text").collect())) == Counter(rows)
    assert docs.columns == spark.read.parquet(f"{SF}/documents.parquet").columns

    mixed = kept(stages["mixing"](spark, docs, SF), "mixed")
    assert mixed.columns == docs.columns
    source = {d[0]: d[2] for d in documents}
    size = {r[0]: len(plain.words(r[1])) for r in rows}
    wanted = plain.targets([(source[i], n) for i, n in size.items()])
    copies = Counter(r.doc_id for r in mixed.select("doc_id").collect())
    assert max(copies.values()) <= 3 and set(copies) <= set(size)
    for name, words in wanted.items():
        taken = sum(n * size[i] for i, n in copies.items() if source[i] == name)
        assert abs(taken - words) <= max(n for i, n in size.items() if source[i] == name) / 2 + 1e-6

    texts = dict(rows)
    expected, at = Counter(), 0
    order = [i for i in sorted(copies) for _ in range(copies[i])]
    for i, ids in zip(order, encoded(texts[i] for i in order)):
        expected[i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
        at += len(ids)
    found = stages["token_output"](spark, mixed, SF)
    assert Counter(map(tuple, found.collect())) == expected


def test_pipeline_runs_whole(spark):
    found = corpus_pipeline.run(spark, SF).collect()
    assert found and min(r.start for r in found) == 0
    assert max(r.start + r.n_tokens for r in found) == sum(r.n_tokens for r in found)
