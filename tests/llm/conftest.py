import random

import pytest

SYLLABLES = "the of and ing er on re ti es an in ha st nd th ou ea ly ed sh".split()


def prose(rng, n):
    out = []
    for i in range(n):
        word = "".join(rng.choice(SYLLABLES) for _ in range(rng.choice((1, 1, 2, 3))))
        out.append(word.capitalize() + "." if i % 17 == 16 else word)
    return " ".join(out)


def changed(rng, text, n):
    words = text.split(" ")
    for i in rng.sample(range(len(words)), n):
        words[i] = "x" + words[i]
    return " ".join(words)


@pytest.fixture(scope="session")
def odd_rows():
    """Documents of every awkward kind: (doc_id, text, lang, source)."""
    rng = random.Random(7)
    base, passage = prose(rng, 200), prose(rng, 60)
    rows = [
        (1, None, "en", "a"),
        (2, "", "en", "a"),
        (3, " \n\t\x0b ", None, None),
        (4, "one", "en", "b"),
        (5, "One", "en", "b"),
        (6, "two words", "en", "b"),
        (None, base, "en", "b"),
        (8, base, "en", "a"),
        (8, base, "en", "a"),
        (9, base.upper(), "en", "a"),
        (10, changed(rng, base, 3), "en", "c"),
        (11, changed(rng, base, 30), "en", None),
        (12, prose(rng, 30) + " " + passage + " " + prose(rng, 30), "en", "a"),
        (13, passage + "\n" + prose(rng, 90), "en", "é"),
        (14, prose(rng, 40) + " " + passage, "en", "a"),
        (15, "la " * 400, "fr", "a"),
        (16, "x" * 50_000, "en", "a"),
        (17, prose(rng, 20_000), "en", "a"),
        (18, "a b c d " * 40 + "end", "en", "b"),
        (19, "líne ünï 😀 é\n" * 30, "es", "b"),
        (20, "mail me: a.b@c.de, +1 (499) 555-6503 or 10.0.0.255 4111 1111 1111 1111", "en", "a"),
        (21, "a@b.c%d@e.f 1.2.3.4.5 300.1.1.1 +1+12345678901 12 12", "en", "a"),
        (22, "Released under the MIT License.\nSPDX-License-Identifier: Apache-2.0\nAll rights reserved.", "en", "c"),
    ]
    for i in range(23, 60):
        rows.append((i, prose(rng, rng.choice((10, 60, 80, 300))), "en", "abc"[i % 3]))
    for i in range(60, 72):
        rows.append((i, changed(rng, base, rng.randint(0, 12)), "de", "a"))
    return rows


SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def clashing(odd_docs):
    """The same rows with columns of names that operators use themselves."""
    from pyspark.sql import functions as F

    names = (
        "row key size doc host kept words n_words spans items position times text_hash signatures sig a b node "
        "component at n row.text base mentions anchor start matched rule place doc_id2"
    )
    return odd_docs.withColumns({n: F.lit(n) for n in names.split()})
