"""Each operator against its plain version, on rows of every awkward kind."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import plain
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from clinflow.llm import (
    chat,
    curriculum,
    decontaminate,
    host_rules,
    jaccard,
    licenses,
    pii,
    substrings,
    token_counts,
    token_files,
)
from clinflow.llm.components import components
from clinflow.llm.queries import vocabulary


def got(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


def one_of_each(odd_rows):
    """Rows without repeated or missing ids."""
    return list({r[0]: r for r in odd_rows if r[0] is not None}.values())


# -- token counts ----------------------------------------------------------------------------------


def test_token_counts(odd_docs, odd_rows, no_docs, clashing):
    pieces = [b" a", b" ", b"a", b"b", b"ab", b" the", b"in", b"g", b" x", b"x", b"xx"] + [bytes([c]) for c in b"eorthndsly"]
    vocab = set(pieces)
    counts = {}

    def count(text):
        w = plain.words(text)
        for x in w:
            if len(x) < 1000 and x not in counts:
                counts[x] = plain.greedy_pieces(b" " + x.encode(), vocab)
            elif x not in counts:
                counts[x] = 1 + (len(x) - 1) // 2 + (len(x) - 1) % 2  # a long run of x
        return len(w), sum(1 if counts[x] is None else counts[x] for x in w), sum(counts[x] is None for x in w)

    expected = Counter((r[0], *count(r[1])) for r in odd_rows)
    columns = ("row.doc_id", "n_words", "n_tokens", "n_unknown")
    assert got(token_counts.count_tokens(odd_docs, pieces), *columns) == expected
    assert got(token_counts.count_tokens(clashing, pieces), *columns) == expected
    assert token_counts.count_tokens(no_docs, pieces).count() == 0


def test_vocabulary_files_agree():
    letters = set(token_counts.read_pieces(vocabulary("byte_bpe_50k.json")))
    ranks = set(token_counts.read_pieces(vocabulary("byte_bpe_50k.tiktoken")))
    assert letters == ranks and {bytes([b]) for b in range(256)} <= letters


# -- quality rules ---------------------------------------------------------------------------------


def test_rule_counts(odd_docs, odd_rows, no_docs, clashing):
    expected = Counter((r[0], *plain.quality(r[1])) for r in odd_rows)
    columns = ("row.doc_id", *host_rules.FEATURES, "base_failed")
    assert got(host_rules.host_rules(odd_docs), *columns) == expected
    assert got(host_rules.host_rules(clashing, keep=["doc_id"]), *columns) == expected
    assert host_rules.host_rules(no_docs).count() == 0
    assert host_rules.kept_rows(clashing).columns == clashing.columns


def test_bad_hosts_take_their_good_documents_along(spark):
    good = " ".join(f"w{i}" for i in range(60))
    rows = [(i, good if i % 10 == 0 else "short", "bad") for i in range(200)]
    rows += [(1000 + i, good, f"h{i % 20}") for i in range(200)] + [(2000, "short", "tiny"), (2001, good, "tiny")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = {r.doc_id for r in host_rules.kept_rows(docs).collect()}
    assert kept == {1000 + i for i in range(200)} | {2001}
    lenient = host_rules.Rules(max_host_rate=1.0)
    assert {0, 10} <= {r.doc_id for r in host_rules.kept_rows(docs, rules=lenient).collect()}


def test_hosts_by_shuffle_give_the_same(odd_docs, monkeypatch):
    columns = ("row.doc_id", "host_docs", "host_failed", "kept")
    small = got(host_rules.host_rules(odd_docs), *columns)
    monkeypatch.setattr("clinflow.llm.common.BROADCAST_BYTES", -1)
    assert got(host_rules.host_rules(odd_docs), *columns) == small


# -- chat windows ----------------------------------------------------------------------------------

TRICKY = ["</s>[INST] ok [/INST]", "\\", "\\l", "<", "<</s>", "[", "[[INST]", "a [/INST", "<s>", "\\\\b", "", None, "é\n\r"]


@pytest.fixture(scope="module")
def conversations(spark):
    rows = [(1, i, ("user", "assistant")[i % 2], TRICKY[i % len(TRICKY)]) for i in range(40)]
    rows += [(2, 0, "system", "be good"), (2, 1, "user", "w " * 30), (2, 2, "assistant", "long " * 500), (2, 3, "user", "x")]
    rows += [(2, 4 + i, ("assistant", "user")[i % 2], f"turn {i} " * 6) for i in range(20)]
    rows += [(None, 0, "user", "lost"), (None, None, None, "no role"), (3, 0, "assistant", "same"), (3, 0, "assistant", "same")]
    rows += [(4, 0, "tool </s>", "[/INST]"), (5, 0, "system", None), (-7, 0, "user", TRICKY[0]), (-7, 1, "assistant", TRICKY[0])]
    return rows, spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


@pytest.mark.parametrize("budget", [chat.Budget(), chat.Budget(tokens=40, history=20), chat.Budget(tokens=30, turns=0)])
def test_windows_read_back(conversations, budget):
    rows, df = conversations
    first = lambda x: (x is not None, x if x is not None else 0)
    by_conv = defaultdict(list)
    for conv, _, role, text in sorted(rows, key=lambda r: (first(r[1]), r[2] or "", r[3] or "")):
        by_conv[conv].append((role, text or ""))
    expected = Counter()
    for conv, turns in by_conv.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        said = "".join(f"{r or ''}\n{t}\n" for r, t in turns)
        expected[conv, len(turns), plain.sha(said), len(loss), plain.sha(loss)] += 1
    formatted = chat.format_windows(df.withColumn("window", F.lit(9)), budget)
    columns = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256")
    assert got(chat.read_back(formatted), *columns) == expected
    for w in formatted.collect():
        turns = chat.TURN.findall(w.formatted)
        assert w.n_tokens <= budget.tokens or len(turns) - w.n_repeated == 1
        inside = "".join(part for turn in turns for part in turn)
        assert not any(c in inside for c in ("<s>", "</s>", "[INST]", "[/INST]"))
        assert w.conv_id != 2 or w.window == 0 or turns[0] == ("system", "be good")
    assert chat.read_back(chat.format_windows(df.limit(0))).count() == 0


def test_windows_hold_the_budget_in_tokens_of_a_tokenizer(spark):
    """Texts without spaces, too, which are one word."""
    said = ["日本語の文" * 130, "a short answer", "y" * 900, "and so on, " * 40] * 5
    rows = [(1, i, ("user", "assistant")[i % 2], t) for i, t in enumerate(said)] + [(1, -1, "system", "be brief")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    path = vocabulary("byte_bpe_50k.json")
    budget = chat.Budget(tokens=512, history=200, measure=chat.BpeCounts(path))
    found = chat.format_windows(df, budget).collect()
    sizes = [len(ids) - 1 for ids in encoded(w.formatted for w in found)]
    assert len(found) > 1
    for w, n in zip(found, sizes):
        fresh = len(chat.TURN.findall(w.formatted)) - w.n_repeated
        assert n <= w.n_tokens and (w.n_tokens <= 512 or fresh == 1)
    assert any(w.n_tokens > 512 for w in found) and any(fresh <= 512 for fresh in sizes)


def test_escaping_is_reversible():
    for text in filter(None, TRICKY):
        assert chat.unescaped(chat.escaped(text)) == text
    assert chat.unescaped(chat.escaped("".join(filter(None, TRICKY)))) == "".join(filter(None, TRICKY))


# -- substrings ------------------------------------------------------------------------------------


def test_repeated_passages(odd_docs, odd_rows, no_docs, clashing):
    expected = Counter((r[0], *k) for r, k in zip(odd_rows, plain.kept_words([r[1] for r in odd_rows])))
    columns = ("row.doc_id", "n_words", "n_removed", "kept")
    assert got(substrings.without_repeats(odd_docs), *columns) == expected
    assert got(substrings.without_repeats(clashing, keep=["doc_id"]), *columns) == expected
    assert substrings.without_repeats(no_docs).count() == 0


def test_counting_windows_of_many_contexts_gives_the_same(odd_docs, odd_rows, monkeypatch):
    monkeypatch.setattr(substrings, "SHARD", 1)
    expected = Counter((r[0], *k) for r, k in zip(odd_rows, plain.kept_words([r[1] for r in odd_rows])))
    assert got(substrings.without_repeats(odd_docs), "row.doc_id", "n_words", "n_removed", "kept") == expected


@pytest.mark.parametrize("window,gram", [(10, 3), (20, 8), (4, 4)])
def test_windows_of_other_lengths(spark, window, gram):
    rng = np.random.default_rng(window)
    texts = [" ".join(rng.choice(list("abc"), 60)) for _ in range(30)] + ["a b " * 30]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    expected = Counter((i, *k) for i, k in enumerate(plain.kept_words(texts, window)))
    found = substrings.without_repeats(docs, substrings.Passage(window, gram))
    assert got(found, "row.doc_id", "n_words", "n_removed", "kept") == expected


# -- token files -----------------------------------------------------------------------------------


def encoded(texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    return [tokenizer.encode(t or "", add_special_tokens=False).ids + [0] for t in texts]


def test_token_files_round_trip(odd_docs, odd_rows, no_docs, clashing, tmp_path):
    rows = sorted(odd_rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    ids = encoded([r[1] for r in rows])
    starts = np.concatenate(([0], np.cumsum([len(x) for x in ids])))
    expected = Counter(
        (r[0], int(s), len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for r, s, x in zip(rows, starts, ids)
    )
    encoding = token_files.Encoding(vocabulary("byte_bpe_50k.json"))
    columns = ("doc_id", "start", "n_tokens", "ids_crc32")
    folder = f"file://{tmp_path}/tokens"
    manifest = token_files.write_token_files(odd_docs, encoding, folder, parts=5)
    assert got(token_files.read_token_files(manifest, folder), *columns) == expected
    flat = []
    for part in manifest.orderBy("part").collect():
        name, dtype = part.file.split(":")
        flat += np.fromfile(tmp_path / "tokens" / f"{name}.bin", dtype).tolist()
    assert flat == [i for x in ids for i in x]
    assert got(token_files.token_digests(clashing, encoding), *columns) == expected
    assert token_files.token_digests(no_docs, encoding).count() == 0


def test_cut_texts_encode_like_whole_ones():
    texts = [
        "a  b", " a", "a ", "  ", "\n", "a\n\n b", "it's we'll a.b, c... d", "x\x1c y", "x  y", " a  ", "1,2. 3.",
        "é à. ü,", "a\t b", "don 't", "a <|endoftext|> b", "😀 😀.", "A..,. b", "　a", "a\x85 b", "ﬁ. x",
    ]
    texts += ["", None, "x" * 3000, "日本語 テキスト です", *texts]
    encoder = token_files.Encoder(token_files.Encoding(vocabulary("byte_bpe_50k.json")))
    for some in (texts, texts[:1], [None], [], ["a b"] * 2500):
        parts = list(encoder.encode(pa.array(some, pa.string())))
        ids = [i for part, _ in parts for i in part.tolist()]
        ends = np.cumsum([n for _, sizes in parts for n in sizes.tolist()])
        assert [ids[a:b] for a, b in zip([0, *ends[:-1]], ends)] == encoded(some)


# -- decontamination -------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def items(odd_rows, spark):
    texts = {r[0]: r[1] for r in odd_rows}
    rows = [(1, " ".join(texts[13].split()[3:40])), (2, "Two WORDS!"), (3, "mail me"), (4, None), (5, "..."), (None, "ünï")]
    rows += [(6, " ".join(texts[23].split()[:13])), (6, "la la la"), (7, "never seen words here at all in any of the texts of this table")]
    return rows, spark.createDataFrame(rows, "item_id long, text string")


def test_contamination(odd_docs, odd_rows, items, no_docs, clashing, monkeypatch):
    rows, df = items
    expected = Counter()
    for r in odd_rows:
        n, hit, found = plain.contamination(r[1], rows)
        expected[r[0], n, hit, tuple(found), hit > 0 and 20 * hit >= n] += 1
    pick = lambda df: Counter((r[0], r[1], r[2], tuple(r[3]), r[4]) for r in df.collect())
    columns = ("row.doc_id", "n_words", "n_hit", "items", "contaminated")
    assert pick(decontaminate.find_items(odd_docs, df).select(*columns)) == expected
    shards = decontaminate.Limits(shard_words=10)
    assert pick(decontaminate.find_items(clashing, df, shards, keep=["doc_id"]).select(*columns)) == expected
    monkeypatch.setattr(decontaminate, "PASS_BYTES", 1)
    assert pick(decontaminate.find_items(odd_docs, df, shards).select(*columns)) == expected
    assert decontaminate.find_items(no_docs, df).count() == 0
    assert decontaminate.find_items(odd_docs, df.limit(0)).filter("n_hit > 0").count() == 0
    assert decontaminate.clean_rows(clashing, df).columns == clashing.columns


def test_spans_are_cut_from_texts(spark):
    item = " ".join(f"i{k}" for k in range(20))
    rest = " ".join(f"w{k}" for k in range(600))
    docs = spark.createDataFrame([(1, f"{rest} {item.upper()}, end"), (2, item), (3, rest), (4, None)], "doc_id long, text string")
    found = decontaminate.cut_rows(docs, spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert got(found, "doc_id", "text") == Counter([(1, f"{rest} , end"), (3, rest), (4, None)])


# -- personal data ---------------------------------------------------------------------------------


def test_base_formats(odd_docs, odd_rows, no_docs, clashing):
    extra = "4111-1111-1111-1111 4111111111111112 +49 (30) 1234-5678 x@y x@y.z@q.r 1.2.3.4 " + "9" * 5000 + " a" * 10 + "@b.c"
    assert [f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in pii.base_spans(extra)] == plain.personal(extra)
    expected = Counter((r[0], ",".join(plain.personal(r[1]))) for r in odd_rows)
    names = lambda rows: Counter(
        (r[0], ",".join(f"{pii.KINDS[s.kind]}:{s.start}:{s.end}" for s in r[1])) for r in rows.collect()
    )
    assert names(pii.find_pii(odd_docs).select("row.doc_id", "base")) == expected
    assert names(pii.find_pii(clashing, keep=["doc_id"]).select("row.doc_id", "base")) == expected
    assert pii.find_pii(no_docs).count() == 0


def test_contexts_find_unseen_identifiers(spark):
    rows = [(i, f"please call: my phone +1 (499) 555-{1000 + i} today, bye {i}") for i in range(20)]
    rows += [(100 + i, f"please call: my phone 499-555-{2000 + i} today and so on") for i in range(5)]
    rows += [(200 + i, f"the invoice 499-555-{3000 + i} was paid") for i in range(5)]
    rows += [(300 + i, "nothing here at all") for i in range(20)] + [(400, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: (r.base, r.spans) for r in pii.find_pii(docs).select("row.doc_id", "base", "spans").collect()}
    for i, text in rows:
        base, spans = found[i]
        assert len(base) == (i < 20)
        assert [text[s.start : s.end] for s in spans] == (
            [f"+1 (499) 555-{1000 + i}"] if i < 20 else [f"499-555-{2000 + i - 100}"] if 100 <= i < 105 else []
        )
    masked = {r.doc_id: r.text for r in pii.masked_rows(docs).collect()}
    assert masked[0] == "please call: my phone [phone] today, bye 0"
    assert masked[101] == "please call: my phone [phone] today and so on" and masked[400] is None


def test_identifiers_of_several_words_fill_slots_too(spark):
    """No two rows share the words before; 20 of 25 slots are seeds, and 5 of 15."""
    rows = [(i, f"a{i} phone +1 (499) 555-{1000 + i} today") for i in range(20)]
    rows += [(100 + i, f"b{i} phone 499 555 {2000 + i} today") for i in range(5)]
    rows += [(200 + i, f"c{i} code +1 (499) 555-{3000 + i} here") for i in range(5)]
    rows += [(300 + i, f"d{i} code word{i} here") for i in range(9)] + [(400, "e code 499 555 4000 here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: (r.base, r.spans) for r in pii.find_pii(docs).select("row.doc_id", "base", "spans").collect()}
    for i, text in rows:
        base, spans = found[i]
        assert len(base) == (i < 20 or 200 <= i < 205)
        learnt = [text[s.start : s.end] for s in spans if s not in base]
        assert learnt == ([f"499 555 {2000 + i - 100}"] if 100 <= i < 105 else [])


@pytest.mark.parametrize("bits", [64, 1 << 24])
def test_slots_are_counted_exactly_whatever_the_filter_lets_through(spark, monkeypatch, bits):
    monkeypatch.setattr(pii, "FILTER_BITS", bits)
    rows = [(i, "a b c a b d", "x") for i in range(5)] + [(9, "a b", "x"), (10, None, "x"), (11, "A  B\nc", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, pattern string").repartition(3)
    names = ["before a b", "around a c", "around b a", "before never seen"]
    patterns = spark.createDataFrame([(n,) for n in names], "pattern string")
    found = {r.pattern: r.slots for r in pii.slots(docs, patterns).collect()}
    assert found == {"before a b": 11, "around a c": 6, "around b a": 5}


def test_words_near_a_slot_are_whole_or_no_pattern():
    long = "w" * 300
    assert pii.patterns_at(f"one two 5 {long} x", 8, 9) == ["before one two"]
    assert pii.patterns_at(f"one {long} 5 six", 305, 306) == []
    assert pii.patterns_at(f"one {long} two 5 six", 309, 310) == ["around two six"]
    assert pii.patterns_at("one two 5", 8, 9) == ["before one two"] and pii.patterns_at("5 x", 0, 1) == []


def test_held_out_identifiers_in_several_forms_of_sentences(spark):
    """Half of the identifiers have a fixed format, the others one that only their context tells."""
    rng = np.random.default_rng(11)
    n = lambda low, high: int(rng.integers(low, high))
    seeds = {
        0: lambda: f"p{n(0, 10**6)}@mail{n(0, 99)}.org",
        1: lambda: ".".join(str(n(1, 255)) for _ in range(4)),
        3: lambda: f"+{n(1, 99)} ({n(100, 999)}) {n(100, 999)}-{n(1000, 9999)}",
    }
    hidden = {
        0: lambda: f"p{n(0, 10**6)}@intranet",
        1: lambda: ".".join(str(n(1, 255)) for _ in range(3)) + f".{n(300, 999)}",
        3: lambda: f"({n(100, 999)}) {n(100, 999)}-{n(1000, 9999)}",
    }
    forms = {
        0: ("you can write to {} at any time", "her mail address is {} and mine too", "reply to: {} please"),
        1: ("the server at {} did not answer", "blocked requests from host {} since noon"),
        3: ("please call me on {} before six", "my number is {} as you know", "phone (office) {} or come by"),
    }
    decoys = ("order {} was shipped", "see section {} of the manual", "the part {} is missing", "invoice {} of last year")
    filler = [f"word{i}" for i in range(200)]
    pad = lambda: " ".join(rng.choice(filler, 12))
    rows, held = [], {}
    for i in range(1200):
        kind = (0, 1, 3)[i % 3]
        form = forms[kind][n(0, len(forms[kind]))]
        if i % 4 == 3:
            text = f"{pad()} {decoys[i // 4 % 4].format(hidden[(1, 3)[i % 2]]())} {pad()}"
            held[i] = None
        else:
            value = (hidden if i % 2 else seeds)[kind]()
            text = f"{pad()} {form.format(value)} {pad()}"
            held[i] = value if i % 2 else None
        rows.append((i, text))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = {r.doc_id: (r.base, r.spans) for r in pii.find_pii(docs).select("row.doc_id", "base", "spans").collect()}
    right = wrong = 0
    for i, text in rows:
        learnt = [text[s.start : s.end] for s in found[i][1] if s not in found[i][0]]
        right += held[i] in learnt
        wrong += sum(x != held[i] for x in learnt)
    wanted = sum(v is not None for v in held.values())
    assert right >= 0.9 * wanted and right >= 0.9 * (right + wrong)


# -- similarity join -------------------------------------------------------------------------------


@pytest.mark.parametrize("percent", [80, 90])
def test_similar_documents(odd_docs, odd_rows, percent):
    rows = [(r[0], r[1]) for r in odd_rows if r[0] is not None]
    expected = Counter(plain.similar(rows, percent))
    found = jaccard.similar_documents(odd_docs.filter("doc_id IS NOT NULL"), percent)
    assert got(found, "doc_id", "n_shingles", "component_id") == expected


def test_missing_ids_and_empty_tables(odd_docs, no_docs, clashing):
    lost = jaccard.similar_documents(clashing).filter("doc_id IS NULL").collect()
    assert [(r.n_shingles > 0, r.component_id) for r in lost] == [(True, None)]
    assert jaccard.similar_documents(no_docs).count() == 0
    assert jaccard.representatives(no_docs).count() == 0


def test_rows_without_ids_take_no_links_from_their_copies(spark):
    text = " ".join(f"w{k}" for k in range(200))
    near = text.replace("w50 ", "x50 ").replace("w100 ", "x100 ").replace("w150 ", "x150 ")
    rows = [(None, text), (8, text), (10, near)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    found = jaccard.similar_documents(docs)
    assert got(found, "doc_id", "n_shingles", "component_id") == Counter([(None, 198, None), (8, 198, 8), (10, 198, 8)])
    assert got(jaccard.representatives(docs), "doc_id") == Counter([(None,), (8,)])


def test_one_of_each_group_stays(odd_docs, odd_rows, clashing):
    classes = {(i, c) for i, _, c in plain.similar([(r[0], r[1]) for r in odd_rows if r[0] is not None])}
    kept = jaccard.representatives(clashing)
    assert kept.columns == clashing.columns
    assert got(kept, "doc_id") == Counter([(None,), *((i,) for i, c in classes if i == c)])


def test_far_members_of_a_signature_group_are_compared(spark, monkeypatch):
    """Chains of near copies, whose ends are not similar, in blocks smaller than the groups."""
    monkeypatch.setattr(jaccard, "BLOCK", 4)
    rng = np.random.default_rng(5)
    rows, words = [], [f"w{k}" for k in range(120)]
    for i in range(40):
        rows.append((100 - i, " ".join(words)))
        for k in rng.choice(120, 2 + 2 * (i % 10 == 9), replace=False):
            words[k] = f"v{i}.{k}"
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    expected = Counter(plain.similar(rows))
    assert got(jaccard.similar_documents(docs), "doc_id", "n_shingles", "component_id") == expected


def test_components(spark):
    rng = np.random.default_rng(2)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, (300, 2))] + [(i, i + 1) for i in range(1000, 1100)] + [(5, 5)]
    parent = {x: x for e in edges for x in e if e[0] != e[1]}

    def root(x):
        return x if parent[x] == x else root(parent[x])

    for a, b in edges:
        if a != b:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    found = components(spark.createDataFrame(edges, "a long, b long"))
    assert got(found, "node", "component") == Counter((x, root(x)) for x in parent)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# -- mixing ----------------------------------------------------------------------------------------


def test_targets_and_copies(odd_docs, odd_rows, no_docs, clashing):
    sizes = [(r[3], len(plain.words(r[1]))) for r in odd_rows]
    wanted = plain.targets(sizes)
    mixed = curriculum.assign(odd_docs).collect()
    assert Counter((r.row.doc_id, r.size) for r in mixed) == Counter((r[0], len(plain.words(r[1]))) for r in odd_rows)
    taken, total = Counter(), Counter()
    for r in mixed:
        assert r.target == pytest.approx(wanted[r.row.source]) and r.taken == r.copies * r.size <= 3 * r.size
        assert len(r.times) == r.copies and all(0 <= t < 1 for t in r.times) and sorted(r.times) == r.times
        taken[r.row.source] += r.taken
        total[r.row.source] += r.size
    largest = Counter()
    for source, size in sizes:
        largest[source] = max(largest[source], size)
    for source, words in wanted.items():
        assert abs(taken[source] - words) <= largest[source] / 2 + 1e-6
    again = curriculum.assign(clashing.repartition(7), keep=["doc_id"]).collect()
    plainly = lambda rows: sorted((str(r.row.doc_id), r.taken, r.times) for r in rows)
    assert plainly(again) == plainly(mixed)
    assert curriculum.assign(no_docs).count() == 0
    order = curriculum.training_order(curriculum.assign(clashing))
    assert order.columns == clashing.columns and order.count() == sum(r.copies for r in mixed)


def test_many_sources_share_the_excess(spark):
    rng = np.random.default_rng(1)
    rows = [(i, "w " * int(rng.integers(1, 40)), f"s{int(rng.integers(0, 30)) ** 2 // 30}") for i in range(600)]
    rows += [(i, None, "zz") for i in range(600, 605)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    wanted = plain.targets([(s, len(plain.words(t))) for _, t, s in rows])
    found = {r.source: r.target for r in curriculum.assign(docs).select("source", "target").distinct().collect()}
    assert found == pytest.approx(wanted)


def test_places_follow_the_schedule(spark):
    """Of a source whose weight falls from 1.5 to 0.5, the first half of the run takes 62.5 %."""
    docs = spark.createDataFrame([(i, "w " * 10, "s") for i in range(2000)], "doc_id long, text string, source string")
    times = [t for r in curriculum.assign(docs).collect() for t in r.times]
    assert len(times) == 2000 and np.mean(np.array(times) < 0.5) == pytest.approx(0.625, abs=0.01)
    knots = curriculum.Mix(shapes=(((0, 1), (0.25, 3), (0.5, 1), (1, 1)),))
    times = np.array([t for r in curriculum.assign(docs, knots).collect() for t in r.times])
    assert np.mean(times < 0.25) == pytest.approx(1 / 3, abs=0.01) and np.mean(times < 0.5) == pytest.approx(2 / 3, abs=0.01)


# -- licences --------------------------------------------------------------------------------------


def quoted(number, width=60):
    """A known sentence as it stands in files: capital letters, commas, wrapped."""
    words = licenses.SENTENCES[number].split()
    lines, line = [], words[0].capitalize()
    for w in words[1:]:
        if len(line) > width:
            lines.append(line + ",")
            line = w
        else:
            line += " " + w
    return "\n".join([*lines, line + "."])


MENTION = {name: f"mention_{i}" for i, name in enumerate(licenses.NAMES, licenses.FIRST_NAME)}
TAG = {name: f"tag_{i}" for i, name in enumerate(licenses.TAGS, licenses.FIRST_TAG)}


def test_licence_rules(spark, no_docs, clashing):
    mit = "\n\n".join(quoted(i) for i in (4, 5, 6, 7))
    apache, gpl3 = MENTION["apache license version 2 0"], MENTION["gnu general public license version 3"]
    bsd = quoted(28)[:-1] + ":\n1. " + quoted(29) + "\n2. " + quoted(30) + "\n3. " + quoted(31)
    texts = {
        1: (mit, "mit_text", "MIT"),
        2: ("Some words here.\nLicensed under the Apache License, Version 2.0.\nOther words.", apache, "Apache-2.0"),
        3: (quoted(9) + " " + quoted(10) + "\nUnknown words between.\n" + quoted(13) + "\n" + quoted(14), "apache_header", "Apache-2.0"),
        4: (quoted(13) + "\n" + quoted(9), "apache_header_start", "Apache-2.0"),
        5: ("// SPDX-License-Identifier: MIT\ncode\n# SPDX-License-Identifier: BSD-3-Clause", f"{TAG['MIT']},{TAG['BSD-3-Clause']}", "BSD-3-Clause,MIT"),
        6: ("  ".join(quoted(i) for i in (28, 29, 30, 31)), "bsd3_text", "BSD-3-Clause"),
        7: ("\n".join(quoted(i) for i in (28, 29, 30)) + " Released under the MIT license.", f"bsd2_text,{MENTION['mit license']}", "BSD-2-Clause,MIT"),
        8: ("released under the mit license of words", "", ""),
        9: (None, "", ""),
        10: ("", "", ""),
        11: ("This work is licensed under the GNU General Public License, version 3.", gpl3, "GPL-3.0"),
        12: ("This project is licensed under the MIT License.", MENTION["mit license"], "MIT"),
        13: ("Code released under the MIT license, see LICENSE for details.", MENTION["mit license"], "MIT"),
        14: ("x\n/* SPDX-License-Identifier: GPL-2.0-or-later */\ny", TAG["GPL-2.0-or-later"], "GPL-2.0"),
        15: ("# SPDX-License-Identifier: AGPL-3.0-only", TAG["AGPL-3.0-only"], "AGPL-3.0"),
        16: ("Licensed under the Mozilla Public License 2.0.", MENTION["mozilla public license 2 0"], "MPL-2.0"),
        17: ("Copyright 2020 A. Author. All rights reserved.\n\n" + bsd, "bsd3_text", "BSD-3-Clause"),
        18: ("All rights reserved.", "reserved", "All-rights-reserved"),
        19: ("\n\n".join(quoted(i) for i in (4, 33, 5, 6, 20, 7)), "mit_text", "MIT"),
        20: ("\n".join(quoted(i) for i in (28, 29, 30)) + " no end " * 20_000, "bsd2_text", "BSD-2-Clause"),
        21: (quoted(51), "isc_text", "ISC"),
        22: (quoted(55) + "\n" + quoted(57), "agpl3_header_start,lgpl21_header_start", "AGPL-3.0,LGPL-2.1"),
    }
    docs = spark.createDataFrame([(i, t) for i, (t, _, _) in texts.items()], "doc_id long, text string")
    found = licenses.license_rules(docs)
    for r in found.collect():
        assert (",".join(r.rules), ",".join(r.licenses)) == texts[r.row.doc_id][1:], r
    refused = {11, 14, 15, 16, 18, 22}
    assert {r.doc_id for r in licenses.permitted_rows(docs).collect()} == set(texts) - refused
    assert licenses.license_rules(no_docs).count() == 0
    twice = docs.union(docs)
    assert licenses.license_rules(twice).count() == 2 * len(texts)
    kept = licenses.permitted_rows(clashing)
    assert kept.columns == clashing.columns and kept.count() == clashing.count()
