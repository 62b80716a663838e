import json

import pytest
from pyspark.sql import functions as F

from clinflow.functions import jsonx

WHOLE = ['{"a":1}', " [1, 2] ", "5", '"x"', "null", "{}", '{"a":{"b":[1,{"c":null}]}}']
BROKEN = ["{", '{"a":1} x', '{"a":1}{"b":2}', "{}],[", "{}],[{}", "1,2", "", "random", "{'a':1}", None]


@pytest.mark.parametrize(("texts", "expected"), [(WHOLE, True), (BROKEN, False)])
def test_only_one_whole_value_is_json(rows, texts, expected):
    df = jsonx.with_document(rows(texts, "s string"), "s")
    found = {r.s: r.ok for r in df.select("s", jsonx.is_json(F.col("doc")).alias("ok")).collect()}
    assert found == {t: expected for t in texts}


def test_forged_array_end_is_rejected(rows):
    text = '{"a":1},123],[7'
    df = jsonx.with_document(rows([text], "s string"), "s")
    assert df.filter("doc IS NULL").count() == 1


def test_object_and_array_gates(rows):
    texts = ['{"a":1}', " [1]", "5", "[", None]
    df = jsonx.with_document(rows(texts, "s string"), "s").select(
        jsonx.is_object(F.col("s"), F.col("doc")).alias("o"),
        jsonx.is_array(F.col("s"), F.col("doc")).alias("a"),
    )
    assert [(r.o, r.a) for r in df.collect()] == [
        (True, False),
        (False, True),
        (False, False),
        (False, False),
        (False, False),
    ]


def test_duplicate_keys_follow_the_session(spark, rows):
    df = rows(['{"a":1,"a":2}'], "s string")
    assert jsonx.with_document(df, "s").filter("doc IS NULL").count() == 1
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    try:
        value = jsonx.with_document(df, "s").select(F.col("doc").cast("string")).first()[0]
        assert json.loads(value) == {"a": 2}
    finally:
        spark.conf.unset("spark.sql.variant.allowDuplicateKeys")


def test_compact_keeps_order_numbers_and_strings(rows):
    text = ' { "z" : 1.50 ,\n "a b" : "x \\" y  z\\\\" , "n" : [ 1 , 2 ] } '
    df = rows([text], "s string").select(jsonx.compact(F.col("s")).alias("c"))
    assert df.first().c == '{"z":1.50,"a b":"x \\" y  z\\\\","n":[1,2]}'


def test_compact_of_a_very_long_string(rows):
    text = '{ "a": "' + 'x \\n\\" ' * 100_000 + '" }'
    got = rows([text], "s string").select(jsonx.compact(F.col("s")).alias("c")).first().c
    assert json.loads(got) == json.loads(text)
    assert got.startswith('{"a":"x ')


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ('{"type":"a"}', "a"),
        ('{"type":5}', "5"),
        ('{"type":true}', "true"),
        ('{"type":["a"]}', "a"),
        ('{"type":["a","b"]}', None),
        ('{"type":[]}', None),
        ('{"type":{"x":1}}', None),
        ('{"type":null}', None),
        ("{}", None),
    ],
)
def test_scalar_text(rows, text, expected):
    df = jsonx.with_document(rows([text], "s string"), "s")
    assert df.select(jsonx.scalar_text(F.col("doc"), "$.type")).first()[0] == expected


@pytest.mark.parametrize(
    ("text", "value", "expected"),
    [
        ('{"b":1,"a":2}', "t", '{"b":1,"a":2,"k":"t"}'),
        (" {} ", "t", '{"k":"t"}'),
        ('{"b":1}', None, '{"b":1,"k":null}'),
        ('{"b":1}', 'q"\n', '{"b":1,"k":"q\\"\\n"}'),
        ('{"k":[1],"b":1}', "t", '{"b":1,"k":"t"}'),
        ('{"k":1}', "t", '{"k":"t"}'),
    ],
)
def test_set_field(rows, text, value, expected):
    df = jsonx.with_document(rows([(text, value)], "s string, v string"), "s")
    got = df.select(jsonx.set_field(F.col("s"), F.col("doc"), "k", F.col("v"))).first()[0]
    assert got == expected


def test_array_size_and_more_than_one(rows):
    texts = ['{"u":[1,2,3]}', '{"u":[1]}', '{"u":null}', '{"u":"x"}', "{}"]
    df = jsonx.with_document(rows(texts, "s string"), "s").select(
        jsonx.array_size(F.col("doc"), "$.u").alias("n"),
        jsonx.has_more_than_one(F.col("doc"), "$.u").alias("many"),
        jsonx.field_is_array(F.col("doc"), "$.u").alias("is_array"),
    )
    assert [tuple(r) for r in df.collect()] == [
        (3, True, True),
        (1, False, True),
        (None, False, False),
        (None, False, False),
        (None, False, False),
    ]


def test_a_filter_on_the_outcome_does_not_parse_again(rows):
    df = jsonx.with_document(rows(WHOLE, "s string"), "s").filter("doc IS NOT NULL")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1


def test_study_wrap_golden(rows):
    first = '{"00080005":{"vr":"CS","Value":["ISO_IR 100"]},"00080050":{"vr":"SH"}}'
    second = '{"0020000D":{"vr":"UI","Value":["1.2.276.0.7"]}}'
    df = rows([f"[{first},{second}]\n"], "s string")
    got = df.select(jsonx.array_wrap(F.col("s"), "study")).first()[0]
    assert got == f'{{"study":[{first},{second}]}}'


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ('{"a":null}', "{}"),
        ('{"a":null,"b":null,"c":1}', '{"c":1}'),
        ('{"c":1,"a":null,"b":null}', '{"c":1}'),
        ('{"a":null,"c":{"x":null,"y":[null,{"z":null}]},"b":null}', '{"c":{"y":[null,{}]}}'),
        ('{"a,":":null,","b":null}', '{"a,":":null,"}'),
        ('{"a":"{\\"b\\":null}","c":"x\\\\"}', '{"a":"{\\"b\\":null}","c":"x\\\\"}'),
        ('[null,{"k\\":null":null}]', "[null,{}]"),
        ('{"a":"null","b":nullx}', '{"a":"null","b":nullx}'),
    ],
)
def test_without_nulls(rows, text, expected):
    got = rows([text], "s string").select(jsonx.without_nulls(F.col("s"))).first()[0]
    assert got == expected
