import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from clinflow.functions import text, times
from clinflow.functions.webpath import with_web_path
from clinflow.sources.notifications import attributes, payload_text

GOLDEN = (
    "projects/foo/location/earth/datasets/bar/dicomStores/fee/dicomWeb/"
    "studies/abc/series/xyz/instances/123"
)


def test_web_path_golden(rows):
    r = with_web_path(rows([GOLDEN], "path string")).first()
    assert (r.project, r.location, r.dataset, r.store_id) == ("foo", "earth", "bar", "fee")
    assert (r.study_id, r.series_id, r.instance_id) == ("abc", "xyz", "123")
    assert r.dicom_store_path == "projects/foo/location/earth/datasets/bar/dicomStores/fee"


@pytest.mark.parametrize(
    ("path", "study"),
    [
        ("/p/l/x/d/y/s/z/dicomWeb/studies/1/series/2/instances/3/", "1"),
        ("a/b/c/d/e/f/g/h/dicomWeb/studies/1/series/2/instances/3/more/4", "1"),
        ("a/b/c/d/e/f/g/h/dicomWeb/studies/1/series/2/instances/3/dicomWeb/", "1"),
        ("a/b/c/d/e/f/g/h/dicomWeb/dicomWeb/studies/1/series/2/x", "studies"),
        ("foo", None),
        ("", None),
        (None, None),
        ("a/b/c/d/e/f/g/dicomWeb/studies/1/series/2/instances/3", None),
        ("a/b/c/d/e/f/g//dicomWeb/studies/1/series/2/instances/3", None),
        ("a/b/c/d/e/f/g/h/dicomWeb/studies/1/series/2/instances", None),
        ("a/b/c/d/e/f/g/h/dicomWeb/studies/1/series/2/instances//", None),
        ("a/b/c/d/e/f/g/h/dicomWeb/s/1/s/2/i/3/dicomWeb/s", None),
        ("a/b/c/d/e/f/g/h/dicomWeb/", None),
        ("/dicomWeb/a/b/c/d/e/f", None),
    ],
)
def test_web_path_rules(rows, path, study):
    r = with_web_path(rows([path], "path string")).first()
    assert r.study_id == study
    assert (r.dicom_store_path is None) == (study is None)


def test_payload_is_decoded(rows):
    df = rows([(bytearray(GOLDEN.encode()), None)], "value binary, attributes map<string,string>")
    assert payload_text(df).first().value == GOLDEN


def test_bytes_that_are_no_text_are_replaced(rows):
    df = rows([bytearray(b"a\xffb")], "value binary")
    assert payload_text(df).first().value == "a�b"


def test_times(rows):
    df = rows([("2021-01-02T03:04:05.678Z", "3/7/2021", "")], "i string, d string, e string")
    r = df.select(
        times.iso_text(times.instant(F.col("i"))).alias("iso"),
        times.us_date_to_iso(F.col("d")).alias("fixed"),
        times.us_date_to_iso(F.col("i")).alias("broken"),
        times.earliest_default(F.col("e")).alias("low"),
        (times.latest_default(F.col("e")) == F.current_timestamp()).alias("high"),
        times.millis_between(times.instant(F.col("i")), times.earliest_default(F.col("e"))).alias(
            "ms"
        ),
    ).first()
    assert r.iso == "2021-01-02T03:04:05.678Z"
    assert (r.fixed, r.broken) == ("2021-03-07", None)
    assert r.low == dt.datetime(1970, 1, 1)
    assert r.high is True
    assert r.ms == 1609556645678


def test_text(rows):
    r = (
        rows([("a/b//", "é" * 100)], "p string, s string")
        .select(
            text.folder_glob(F.col("p")).alias("g"),
            text.base64_text(F.col("s")).alias("b"),
        )
        .first()
    )
    assert r.g == "a/b/*"
    assert r.b == "w6nDqcOp" * 33 + "w6k="


def test_headers_become_attributes(rows):
    pairs = [("a", bytearray(b"1")), ("b", bytearray(b"2")), ("a", bytearray(b"3"))]
    df = rows([(pairs,), (None,)], "headers array<struct<key:string,value:binary>>")
    got = [r.m for r in df.select(attributes(F.col("headers")).alias("m")).collect()]
    assert got == [{"a": "3", "b": "2"}, {}]


def split_dropping_empty_ends(text, separator):
    pieces = text.split(separator)
    while len(pieces) > 1 and pieces[-1] == "":
        pieces.pop()
    return pieces


def web_path_by_hand(path):
    halves = split_dropping_empty_ends(path, "/dicomWeb/")
    if len(halves) != 2:
        return None
    store, search = (split_dropping_empty_ends(h, "/") for h in halves)
    if len(store) < 8 or len(search) < 6:
        return None
    return (*store[1:8:2], halves[0], *search[1:6:2])


def test_web_paths_equal_those_split_by_hand(rows):
    """Random paths, many of them nearly valid: too short, with empty pieces, more separators."""
    rng = random.Random(7)

    def pieces(n):
        return "/".join(rng.choice(["", "a", "b", "dicomWeb", "c" * 3]) if rng.random() < 0.3
                        else f"x{rng.randrange(9)}" for _ in range(n))

    paths = {"/dicomWeb/".join(pieces(rng.randrange(4, 11)) for _ in range(rng.choice([1, 2, 2, 3])))
             + rng.choice(["", "", "", "/", "//", "/dicomWeb/", "/dicomWeb"]) for _ in range(3000)}
    got = {tuple(r)[0]: tuple(r)[1:] for r in with_web_path(rows(sorted(paths), "path string")).collect()}
    for path in paths:
        assert got[path] == (web_path_by_hand(path) or (None,) * 8), path
    assert sum(v[0] is not None for v in got.values()) > 100
