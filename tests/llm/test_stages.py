"""The pipeline's stages on odd rows, one after the other without being written, and side by side."""

import threading
from collections import Counter

import plain
import pytest

import corpus_pipeline
from clinflow.llm import jaccard, substrings
from clinflow.llm.common import own_tables, scratch, settled
from clinflow.session import work_dir, written
from clinflow.sinks.files import list_files

SF = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)


def rows(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("name", list(STAGES)[:-1])
def test_a_stage_keeps_odd_rows_as_they_are(spark, clashing, no_docs, name):
    """Null ids and texts, repeated rows, long texts and columns of any name."""
    docs = written(clashing, work_dir(spark, "odd"))
    kept = STAGES[name](spark, docs, SF)
    assert kept.columns == docs.columns
    given, found = rows(docs), rows(kept)
    assert set(found) <= set(given)
    if name != "mixing":  # which takes a document several times
        assert all(n <= given[r] for r, n in found.items())
    assert STAGES[name](spark, no_docs, SF).collect() == []


def test_token_output_of_odd_rows(spark, clashing, no_docs):
    docs = written(clashing, work_dir(spark, "odd"))
    found = STAGES["token_output"](spark, docs, SF).collect()
    assert Counter(r.doc_id for r in found) == Counter(r.doc_id for r in docs.collect())
    assert STAGES["token_output"](spark, no_docs, SF).collect() == []


def test_one_document_of_each_class_stays(spark, clashing):
    docs = written(clashing, work_dir(spark, "odd"))
    kept = STAGES["near_duplicates"](spark, docs, SF).collect()
    given = [(r.doc_id, r.text) for r in docs.collect()]
    classes = {i: c for i, _, c in plain.similar([g for g in given if g[0] is not None])}
    wanted = Counter(c for i, c in classes.items() if i == c) + Counter(None for i, _ in given if i is None)
    assert Counter(r.doc_id for r in kept) == wanted


def test_stages_need_not_be_written_in_between(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    chained, apart = docs, docs
    for name in ("quality", "near_duplicates", "decontamination", "mixing"):
        chained = STAGES[name](spark, chained, SF)
    found = rows(chained)
    for name in ("quality", "near_duplicates", "decontamination", "mixing"):
        apart = written(STAGES[name](spark, apart, SF), work_dir(spark, name))
    assert found == rows(apart)


def test_working_tables_go_with_the_call_that_made_them(spark):
    with own_tables() as outer:
        kept = scratch(spark.range(3), "kept")
        result = settled(spark, lambda: scratch(spark.range(5), "inner").filter("id > 1"), "result")
        assert len(outer) == 2 and all(list_files(spark, p) for p in outer)
    assert result.count() == 3 and kept.count() == 3
    assert settled(spark, lambda: spark.range(2), "alone").count() == 2


def test_operators_in_two_threads(spark, odd_docs, odd_rows):
    found, wrong = {}, []

    def run(name, build):
        try:
            found[name] = build()
        except Exception as e:  # noqa: BLE001
            wrong.append(e)

    docs = odd_docs.filter("doc_id IS NOT NULL")
    jobs = {
        "join": lambda: rows(jaccard.similar_documents(docs).select("doc_id", "n_shingles", "component_id")),
        "cut": lambda: rows(substrings.without_repeats(docs, keep=["doc_id"]).select("row.doc_id", "n_words", "n_removed")),
    }
    threads = [threading.Thread(target=run, args=j) for j in jobs.items()]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not wrong
    given = [(r[0], r[1]) for r in odd_rows if r[0] is not None]
    assert found["join"] == Counter(plain.similar(given))
    cut = plain.kept_words([t for _, t in given])
    assert found["cut"] == Counter((i, n, gone) for (i, _), (n, gone, _) in zip(given, cut))


def test_one_repeated_id_costs_no_bounds(spark, monkeypatch):
    """Pairs that are compared in full: as many with a repeated id as without."""
    base = [f"w{k}" for k in range(150)]
    texts = {i: " ".join(w if (k * 7 + i) % 40 else f"x{i}.{k}" for k, w in enumerate(base)) for i in range(30)}
    counted = []
    linked = jaccard.linked
    monkeypatch.setattr(jaccard, "linked", lambda pairs, *more: (counted.append(pairs.count()), linked(pairs, *more))[1])
    plain_rows = [(i, t) for i, t in texts.items()] + [(100, "something else altogether here")]
    for more in ([], [(100, "and this is the second text of one id")]):
        docs = spark.createDataFrame(plain_rows + more, "doc_id long, text string")
        found = rows(jaccard.similar_documents(docs).select("doc_id", "n_shingles", "component_id"))
        assert found == Counter(plain.similar(plain_rows + more))
    assert counted[0] == counted[1]
