"""Periodic runs, whitening and toxicity against plain versions, on odd rows and on the smallest tables."""

import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import plain
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from clinflow.llm import periodic, toxicity, whitening
from clinflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"

# -- periodic runs -----------------------------------------------------------------------------------


def flat(texts):
    ids = {w: i for i, w in enumerate(sorted({w for t in texts for w in t}, key=str))}
    return np.array([ids[w] for t in texts for w in t], np.int64), np.array([len(t) for t in texts], np.int64)


def test_runs_of_random_sequences():
    rng = random.Random(3)
    for _ in range(300):
        texts = []
        for _ in range(rng.randint(1, 5)):
            letters = rng.choice((1, 2, 3, 40))
            text = [rng.randrange(letters) for _ in range(rng.choice((0, 1, 5, 6, 30, 120)))]
            for _ in range(rng.randint(0, 3)):
                period = [rng.randrange(letters) for _ in range(rng.randint(1, 6))]
                at = rng.randint(0, len(text))
                text[at:at] = (period * 10)[: rng.randint(1, 50)]
            texts.append(text)
        assert periodic.runs_of(*flat(texts)) == [plain.runs(t) for t in texts]


def test_runs_of_sequences_that_fool_sums_of_powers():
    thue_morse = [0]
    while len(thue_morse) < 4096:
        thue_morse += [1 - x for x in thue_morse]
    other = [1 - x for x in thue_morse]
    text = thue_morse + other + thue_morse + other
    found = periodic.runs_of(*flat([text, thue_morse * 4]))
    assert found == [[], [(0, 4 * 4096, 4096)]]


def test_long_runs_take_no_square_of_their_length():
    text = ["a"] * 200_000 + ["b", "c"] * 100_000
    assert periodic.runs_of(*flat([text])) == [[(0, 200_000, 1), (200_000, 200_000, 2)]]


def test_find_runs(odd_docs, odd_rows, no_docs, clashing):
    def expected(text):
        words = plain.words(text)
        if len(words) > 3000:
            return len(words), (), " ".join(words)
        found = plain.runs(words)
        return len(words), tuple(found), " ".join(plain.collapsed(words, found))

    def got(df):
        rows = df.select("row.doc_id", "n_words", "runs", "collapsed").collect()
        return Counter((r[0], r[1], tuple(map(tuple, r[2])), r[3]) for r in rows)

    wanted = Counter((r[0], *expected(r[1])) for r in odd_rows)
    assert got(periodic.find_runs(odd_docs)) == wanted
    assert got(periodic.find_runs(clashing, keep=["doc_id"])) == wanted
    assert periodic.find_runs(no_docs).count() == 0
    with pytest.raises(ValueError):
        periodic.find_runs(odd_docs, times=3)


def test_runs_query(spark):
    documents = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    found = {r.doc_id: r for r in QUERIES["op11_periodic_runs"](spark, SF).collect()}
    assert len(found) == len(documents)
    for doc, text in documents:
        words = plain.words(text)
        h, n = zlib.crc32(str(doc).encode()), len(words)
        if n > 1500:
            continue
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = plain.runs(words)
        best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
        r = found[doc]
        assert (r.n_words, r.n_runs) == (n, len(runs))
        assert (r.start, r.length, r.period) == (best or (None,) * 3)
        assert r.exponent_milli == (1000 * best[1] // best[2] if best else None)
        assert r.runs_sha256 == plain.sha("".join("%d,%d,%d\n" % x for x in runs))
        assert r.collapsed_sha256 == plain.sha(" ".join(plain.collapsed(words, runs)))


# -- whitening ---------------------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, row string, x string, copies int, part string"


def whitened(rows, weighted=False):
    """Plain: x vectors by row, the fit list's number, sums and eigenvalues."""
    x = np.floor(64 * np.array(rows, float)).astype(np.int64) + 1_000_000
    fit = x if weighted else np.unique(x, axis=0)
    n, s = len(fit), fit.sum(0)
    y = fit - s / n
    return x, n, s, y.T @ y / n


def check_whitened(found, ids, rows, weighted=False):
    x, n, s, v = whitened(rows, weighted)
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1], vectors[:, ::-1]
    z = np.zeros((len(rows), len(found[0].whitened)))
    place = {i: k for k, i in enumerate(ids)}
    for r in found:
        k = place[r.row.vec_id]
        z[k] = r.whitened
        assert r.n == n and r.deviation == sum((n * int(a) - int(b)) ** 2 for a, b in zip(x[k], s))
        assert r.identity_error <= 1e-4
        assert np.allclose(r.explained, values[: z.shape[1]] / np.trace(v), rtol=1e-6)
    plain_z = (x - s / n) @ vectors[:, : z.shape[1]] / np.sqrt(values[: z.shape[1]])
    signs = np.sign((z * plain_z).sum(0))
    assert np.allclose(z, plain_z * signs, atol=1e-6)


@pytest.mark.parametrize("weighted", [False, True])
def test_whitening(spark, weighted):
    rng = np.random.default_rng(5)
    some = rng.normal(0, 1, (60, 5)) * [5, 3, 2, 1, 0.5]
    rows = [some[i % 7 if i > 40 else i].tolist() for i in range(60)]
    data = [(i, r, "row", "x", 1, "part") for i, r in enumerate(rows)]
    odd = [
        (100, None, "a", "b", 2, "c"),
        (101, [float("nan")] + [1.0] * 4, "a", "b", 2, "c"),
        (102, [None] + [1.0] * 4, "a", "b", 2, "c"),
        (103, [float("inf")] + [1.0] * 4, "a", "b", 2, "c"),
        (104, [1.0, 2.0], "a", "b", 2, "c"),
        (105, [], "a", "b", 2, "c"),
    ]
    vectors = spark.createDataFrame(data + odd, VECTORS).repartition(3)
    found = whitening.whiten(vectors, components=5, weighted=weighted).collect()
    assert sorted(r.row.vec_id for r in found) == list(range(60))
    single = np.array(rows, np.float32)
    check_whitened(found, range(60), single, weighted)
    assert found[0].row.part == "part"


def test_whitening_of_little_or_nothing(spark):
    schema = "vec_id long, embedding array<double>"
    assert whitening.whiten(spark.createDataFrame([], schema)).collect() == []
    none = spark.createDataFrame([(1, None), (2, []), (3, [None])], schema)
    assert whitening.whiten(none).collect() == []
    same = spark.createDataFrame([(None, [1.0, 2.0]), (4, [1.0, 2.0]), (4, [1.0, 2.0])], schema)
    found = whitening.whiten(same).collect()
    assert [(r.n, r.deviation, r.whitened, r.identity_error) for r in found] == [(1, 0, [None, None], 0.0)] * 3
    far = spark.createDataFrame([(1, [2.0**39]), (2, [0.0]), (3, [1.0])], schema)
    assert {r.row.vec_id: r.deviation for r in whitening.whiten(far).collect()}[1] is None


def test_a_hot_vector_is_dealt_to_several_tasks(spark):
    hot = spark.range(2500).select(F.col("id").alias("vec_id"), F.array(F.lit(1.0), F.lit(2.0)).alias("embedding"))
    rare = spark.range(3).select(
        (F.col("id") + 5000).alias("vec_id"), F.array(F.col("id") * 1.0, F.col("id") * F.col("id") * -1.0).alias("embedding")
    )
    found = whitening.whiten(hot.union(rare)).collect()
    assert sorted(r.row.vec_id for r in found) == [*range(2500), 5000, 5001, 5002]
    assert len({tuple(r.whitened) for r in found}) == 4 and {r.n for r in found} == {4}


def test_whitening_query(spark):
    rows = duckdb.sql(f"SELECT vec_id, embedding FROM '{SF}/embeddings.parquet'").fetchall()
    found = QUERIES["op12_whitening"](spark, SF).collect()
    assert Counter((r.vec_id, r.component) for r in found) == Counter((i, k) for i, _ in rows for k in range(1, 17))
    x, n, s, v = whitened([e for _, e in rows])
    values = np.linalg.eigvalsh(v)[::-1]
    place = {i: k for k, (i, _) in enumerate(rows)}
    z = np.zeros((len(rows), 16))
    for r in found:
        z[place[r.vec_id], r.component - 1] = r.whitened
        assert r.n == n and r.identity_error <= 1e-4
        assert r.explained == pytest.approx(values[r.component - 1] / np.trace(v), rel=1e-4)
        assert r.deviation == int(((n * x[place[r.vec_id]] - s) ** 2).sum())
    # Scaled back, each component is an eigenvector: V times it is its eigenvalue times it.
    _, first = np.unique(x, axis=0, return_index=True)
    fit, y = z[first], x[first] - s / n
    loads = y.T @ fit / n / np.sqrt(values[:16])
    assert np.allclose(v @ loads, loads * values[:16], atol=1e-6 * values[0])
    assert np.allclose(fit.T @ fit / n, np.eye(16), atol=1e-6)


# -- toxicity ----------------------------------------------------------------------------------------


def test_pairs_teach_what_single_terms_do_not():
    """Inputs 0 and 1 are bad together only; 2 to 9 are noise."""
    rng = random.Random(2)
    inputs, toxic = [], []
    for _ in range(3000):
        x = [i for i in (0, 1) if rng.random() < 0.5]
        toxic.append(len(x) == 2)
        inputs.append(x + [i for i in range(2, 10) if rng.random() < 0.3])
    machine = toxicity.Machine(np.arange(10), 0.0, np.zeros(10), np.zeros((10, 4)))
    toxicity.fit(machine, inputs[:2000], np.array(toxic[:2000]), toxicity.Settings())
    scores = machine.score(*toxicity.ragged(inputs[2000:]))
    assert ((scores >= 0.5) == np.array(toxic[2000:])).mean() > 0.99
    both, one, other = (float(machine.score(*toxicity.ragged([x]))[0]) for x in ([0, 1], [0], [1]))
    assert both > 0.9 and one < 0.1 and other < 0.1


def test_terms_of_texts():
    def buckets(word):
        core = word.strip(toxicity.MARKS)
        terms = [core, *(core[:n] + "…" for n in toxicity.STARTS if len(core) > n)] if core else []
        return {xxhash.xxh64_intdigest(t) % toxicity.BUCKETS for t in terms}

    texts = ["Word, word!! (longer) LONGEST", None, "", " ... ", "longer\tword" * 2, "x" * 200, "Élan, éèêîô"]
    doc, bucket = toxicity.terms_of(pa.array(texts))
    for i, text in enumerate(texts):
        expected = {b for w in (text or "").lower().split() for b in buckets(w)}
        assert bucket[doc == i].tolist() == sorted(expected)
    known = np.array(sorted(buckets("word") | buckets("never")))
    doc, place = toxicity.terms_of(pa.array(texts), known)
    found = {(i, int(known[p])) for i, p in zip(doc.tolist(), place.tolist())}
    assert {(0, b) for b in buckets("word")} <= found and {i for i, _ in found} <= {0, 4}
    assert not len(toxicity.terms_of(pa.array(texts), np.empty(0, np.int64))[0])
    assert not len(toxicity.terms_of(pa.array([], pa.string()))[0])


def toxic_rows(rng, n):
    words = [f"w{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.choice((5, 50, 400)))]
        toxic = i % 5 == 0
        if toxic:
            text.insert(rng.randint(0, len(text)), rng.choice(("Gnarf!", "(gnarf)", "zorgel,", "ZORGLE...")))
        rows.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    return rows, labels


def test_toxicity_of_rows_without_labels(spark, clashing, odd_rows, no_docs):
    rows, labels = toxic_rows(random.Random(4), 800)
    docs = spark.createDataFrame(rows + [(None, "gnarf"), (900, None), (0, rows[0][1])], "doc_id long, text string")
    marks = spark.createDataFrame(
        labels[:500] + [(0, 0), (None, 1), (900, 0), (901, None)], "doc_id long, toxic int"
    )
    machine = toxicity.learn(docs, marks, F.col("doc_id") < 500)
    found = toxicity.score_texts(docs, machine).select("row.doc_id", "score").collect()
    assert len(found) == len(rows) + 3
    truth = dict(labels)
    later = [(r.score, truth[r.doc_id]) for r in found if r.doc_id is not None and 500 <= r.doc_id < 800]
    assert all((s >= 0.3) == bool(t) for s, t in later)
    empty = next(r.score for r in found if r.doc_id == 900)
    assert 0 < empty < 0.3 and next(r.score for r in found if r.doc_id is None) > 0.3
    again = toxicity.learn(docs.repartition(3), marks, F.col("doc_id") < 500)
    assert (again.place == machine.place).all() and np.allclose(again.weight, machine.weight)
    assert toxicity.score_texts(clashing, machine).count() == len(odd_rows)
    assert toxicity.score_texts(no_docs, machine).count() == 0


def test_toxicity_without_labels(spark, odd_docs, no_docs, odd_rows):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    for docs in (odd_docs, no_docs):
        machine = toxicity.learn(docs, none, F.lit(True))
        found = toxicity.score_texts(docs, machine, keep=["doc_id"]).collect()
        assert len(found) == docs.count() and all(0 <= r.score <= 1 for r in found)


def test_held_out_toxicity(spark):
    """On a larger table the rows whose labels were not read are told apart."""
    sf = "/root/testdata/sf0.1"
    truth = dict(duckdb.sql(f"SELECT doc_id, toxic FROM '{sf}/labels.parquet'").fetchall())
    found = QUERIES["op13_toxicity"](spark, sf).collect()
    assert len(found) == 10_000
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in found)
    assert all(r.predicted == int(r.score >= 0.3) for r in found)
    held = [(r.predicted, truth[r.doc_id]) for r in found if r.held_out and r.doc_id in truth]
    hits = sum(p and t for p, t in held)
    assert hits >= 0.85 * sum(t for _, t in held) and hits >= 0.9 * sum(p for p, _ in held)
