import json
import time

import pytest
from pyspark.sql import functions as F

from clinflow.operators.mapping import (
    Mapping,
    MappingError,
    Rule,
    batch_bundle,
    bundle_entries,
    bundle_stage,
    const,
    copy,
    map_stage,
    nest,
    root,
)
from clinflow.operators.outcomes import split_ok
from clinflow.schemas import MAPPING_RULE
from clinflow.sources.rules import load_mapping

FOO = Mapping([nest("", "Output", "test", is_array=True), copy("test", "foo", "$.bar")])


def mapped(rows, mapping, *texts):
    df = rows([("id", t) for t in texts], "id string, data string")
    good, bad = split_ok(map_stage(df, mapping))
    return [r.output for r in good.collect()], bad.collect()


def test_goldens_keep_the_type(rows):
    out, bad = mapped(rows, FOO, '{"bar":"test"}', '{"bar":2}')
    assert out == ['{"Output":[{"foo":"test"}]}', '{"Output":[{"foo":2}]}']
    assert bad == []


def test_invalid_input_is_one_error_with_its_id(rows):
    out, bad = mapped(rows, FOO, "{")
    assert out == []
    assert [r.error.sources for r in bad] == [["id"]]
    assert bad[0].error.step == "MapMessages"


@pytest.mark.parametrize(
    "text",
    [
        "random string",
        "[]",
        "{}",
        '{"rules": []}',
        '{"rules": [{"output": "", "target_path": "a", "kind": "magic"}]}',
        '{"rules": [{"output": "", "target_path": "a", "kind": "copy", "source_path": "b"}]}',
        '{"rules": [{"output": "", "target_path": "a", "kind": "const"}]}',
        '{"rules": [{"output": "", "target_path": "a", "kind": "nest", "source_path": "$",'
        ' "const_value": "nowhere"}]}',
        '{"rules": [{"output": "", "target_path": "a", "kind": "root"}], "post": "dance"}',
        '{"rules": [{"output": "", "target_path": "a", "kind": "root"}], "post": "transaction"}',
    ],
)
def test_bad_definitions_fail_before_any_row(text):
    with pytest.raises(MappingError):
        Mapping.from_text(text)


def test_cycles_and_doubles_are_rejected():
    with pytest.raises(MappingError, match="contains itself"):
        Mapping([nest("", "a", "x"), nest("x", "b", "y"), nest("y", "c", "x")])
    with pytest.raises(MappingError, match="twice"):
        Mapping([root("", "a"), const("", "a", "1")])


@pytest.mark.parametrize("keys", [(1, 2), (3, 4), (5, 6)])
def test_identity_goldens(rows, keys):
    message = {f"key{k}": f"value{k}" for k in keys}
    out, _ = mapped(rows, Mapping([root("", "testOutput", is_array=True)]), json.dumps(message))
    assert json.loads(out[0]) == {"testOutput": [message]}


def test_missing_fields_are_left_out_and_nulls_kept(rows):
    mapping = Mapping(
        [
            copy("", "gone", "$.gone"),
            copy("", "list", "$.gone", is_array=True),
            copy("", "none", "$.none"),
            nest("", "sub", "s", "$.sub"),
            const("s", "c", "x"),
        ]
    )
    out, _ = mapped(rows, mapping, '{"none":null}', '{"none":1,"sub":{}}')
    assert out == ['{"none":null}', '{"none":1,"sub":{"c":"x"}}']


def test_transaction(rows):
    mapping = Mapping(
        [
            nest("", "Resources", "p", is_array=True),
            nest("", "Others", "o", "$.o", is_array=True),
            const("p", "resourceType", "Patient"),
            copy("p", "id", "$.id"),
            const("o", "resourceType", "Basic"),
        ],
        post="transaction",
    )
    out, _ = mapped(rows, mapping, '{"id":7}', '{"id":"x","o":1}')
    one, two = [json.loads(o) for o in out]
    assert one["type"] == "transaction"
    assert [e["request"]["url"] for e in one["entry"]] == ["Patient/7"]
    assert [e["request"]["url"] for e in two["entry"]] == ["Patient/x", "Basic"]
    assert two["entry"][0]["resource"] == {"resourceType": "Patient", "id": "x"}


def test_bundle_golden(rows):
    df = rows(['{"resourceType": "ImagingStudy"}'], "r string")
    assert df.select(batch_bundle(F.col("r"), "ImagingStudy")).first()[0] == (
        '{"resourceType":"Bundle","type":"batch","entry":[{"resource":{"resourceType":'
        '"ImagingStudy"},"request":{"method":"PUT","url":"ImagingStudy"}}]}'
    )


def test_only_objects_become_bundles(rows):
    good, bad = split_ok(bundle_stage(rows(["{}", "[]", "{", "7"], "r string"), "r", "X"))
    assert good.count() == 1
    assert sorted(r.error.error_resource for r in bad.collect()) == ["7", "[]", "{"]


def test_entries_are_the_inverse(rows):
    df = rows([(1, '{"resourceType":"A","id":"x","n":1}')], "k int, r string")
    bundles = df.select("k", batch_bundle(F.col("r"), "A").alias("b"))
    r = bundle_entries(bundles, "b", ["k"]).first()
    assert (r.k, r.position, r.method, r.url, r.resource_type, r.id) == (1, 0, "PUT", "A", "A", "x")
    assert json.loads(r.body) == {"resourceType": "A", "id": "x", "n": 1}


def test_definitions_from_text_path_and_table(spark, tmp_path):
    path = str(tmp_path / "mapping.json")
    (tmp_path / "mapping.json").write_text(FOO.to_text())
    assert load_mapping(spark, path).rules == FOO.rules
    other = Mapping([root("", "x")])
    assert load_mapping(spark, path, text=other.to_text()).rules == other.rules
    (tmp_path / "mapping.json").write_text(other.to_text())
    assert load_mapping(spark, path).rules == FOO.rules
    assert load_mapping(spark, path, force=True).rules == other.rules
    table = spark.createDataFrame([vars(r) for r in FOO.rules], MAPPING_RULE)
    assert set(Mapping.from_table(table).rules) == set(FOO.rules)
    with pytest.raises(MappingError):
        load_mapping(spark)
    assert Rule("", "a", "root") in Mapping([root("", "a")]).rules


def test_source_time_goes_along(rows):
    df = rows([("i", "{}", None)], "id string, data string, t timestamp")
    out = map_stage(df, Mapping([const("", "a", "b")]), source_time="t")
    assert out.first().source_time is None
    assert out.first().ok is True


def test_deep_mappings_stay_small(rows):
    depth = 14
    rules = [nest("", "n", "o0", "$.n", is_array=True)]
    for i in range(depth):
        rules += [nest(f"o{i}", "n", f"o{i + 1}", "$.n", is_array=True), copy(f"o{i}", "v", "$.v")]
    rules.append(copy(f"o{depth}", "v", "$.v"))
    doc, expected = {"v": depth}, {"v": depth}
    for i in range(depth)[::-1]:
        doc, expected = {"v": i, "n": doc}, {"n": [expected], "v": i}
    text = json.dumps({"n": doc})
    start = time.monotonic()
    out = map_stage(rows([("i", text)], "id string, data string"), Mapping(rules)).first().output
    assert json.loads(out) == {"n": [expected]}
    assert time.monotonic() - start < 10
