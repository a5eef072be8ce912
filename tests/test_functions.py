from __future__ import annotations

import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clinweave.functions import columns as C
from clinweave.functions.document import Opt, Rendered, arr, obj, render
from clinweave.functions.json_docs import entered_in_error, has_path, json_merge_patch, tag_source
from clinweave.settings import Settings
from tests.conftest import at


def one(spark, column, **values):
    row = [tuple(values.values())] if values else [(1,)]
    return spark.createDataFrame(row, list(values) or ["x"]).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    ("value", "expected"),
    [
        ("test-73106-encounter_openmrs-1014", "test-73106-encounter-openmrs-1014"),
        ("73106", "id-73106"),
        ("fe5cae86-52a1-4713-b39d-4c05a9da3abf", "fe5cae86-52a1-4713-b39d-4c05a9da3abf"),
        ("é/ x", "---x"),
    ],
)
def test_fhir_id(spark, value, expected):
    assert one(spark, C.fhir_id("u"), u=value) == expected
    assert one(spark, C.fhir_id(C.fhir_id("u")), u=value) == expected


def test_fhir_id_of_null(spark):
    assert one(spark, C.fhir_id(F.lit(None).cast("string"))) is None


def test_synthetic_ids_are_the_known_ones(spark):
    medication = C.synthetic_id("medreq-", *[F.lit(x) for x in ("11106", 1, 1, 1234)])
    assert one(spark, medication) == "medreq-058f3c800a7a533a5d278ff278903082"
    parts = [F.lit(x) for x in ("11106", 1, 1, 6042, 6042, 117399)]
    condition = C.synthetic_id("cond-", *parts, C.ntz(at("2026-01-02 09:00:00")))
    assert one(spark, condition) == "cond-632ba2aceb0bafea83557e65cc3a7c3f"


def test_synthetic_id_leaves_null_parts_out(spark):
    none = F.lit(None).cast("int")
    a = C.synthetic_id("x-", F.lit("s"), none, F.lit(5))
    b = C.synthetic_id("x-", F.lit("s"), F.lit(5), none)
    assert one(spark, a) == one(spark, b)


def test_concept_code(spark):
    none = F.lit(None).cast("string")
    assert one(spark, C.concept_code(none, F.lit(5089))) == "5089" + "A" * 32
    assert one(spark, C.concept_code(F.lit("u"), F.lit(5089))) == "u"


def test_change_version_takes_what_is_there(spark):
    df = spark.createDataFrame([(at("2026-01-01"), None)], "date_created timestamp_ntz, updated_at timestamp_ntz")
    assert df.select(C.change_version(df).alias("v")).first()["v"] == at("2026-01-01")
    assert C.change_version(df.select(F.lit(1).alias("x"))) is None


def test_row_hash_tells_null_from_empty(spark):
    df = spark.createDataFrame([("a", None), ("a", ""), ("a", "b")], "x string, y string")
    assert df.select(C.row_hash(df)).distinct().count() == 3


def test_url_encode(spark):
    assert one(spark, C.url_encode("u"), u="http://x/y|a b") == "http%3A%2F%2Fx%2Fy%7Ca%20b"


def test_document_modes(spark):
    df = spark.createDataFrame([(None, 'Jac"mel', None, ["q"])], "a string, b string, c string, l array<string>")
    doc = obj(
        {
            "kind": "X",
            "a": F.col("a"),
            "b": F.col("b"),
            "c": Opt(F.col("c")),
            "d": Opt(F.col("c"), F.lit(True)),
            "empty": obj({"a": F.col("a")}),
            "list": arr(obj({"u": "1", "v": F.col("a")}, needs="v"), obj({"u": "2", "v": F.col("b")}, needs="v")),
            "kids": Rendered(F.transform("l", lambda x: F.struct(x.alias("x")))),
        }
    )
    omitted = json.loads(df.select(F.to_json(render(doc, "omit"))).first()[0])
    assert omitted == {"kind": "X", "b": 'Jac"mel', "list": [{"u": "2", "v": 'Jac"mel'}], "kids": [{"x": "q"}]}
    text = obj({**doc.members, "kids": Rendered(F.transform("l", lambda x: F.concat(F.lit('{"x":"'), x, F.lit('"}'))))})
    kept = json.loads(df.select(render(text, "reference")).first()[0])
    assert kept == {
        "kind": "X", "a": None, "b": 'Jac"mel', "d": None, "empty": {"a": None},
        "list": [{"u": "1", "v": None}, {"u": "2", "v": 'Jac"mel'}], "kids": [{"x": "q"}],
    }


def merge(target, patch):
    """The merge patch of the standard, on Python values."""
    if not isinstance(patch, dict):
        return patch
    out = dict(target) if isinstance(target, dict) else {}
    for name, value in patch.items():
        if value is None:
            out.pop(name, None)
        else:
            out[name] = merge(out.get(name), value)
    return out


leaf = st.none() | st.booleans() | st.integers(-99, 99) | st.text("ab", max_size=2) | st.lists(st.integers(0, 3), max_size=2)
name = st.sampled_from(["a", "b", "c"])
nested = st.dictionaries(name, st.recursive(leaf, lambda inner: st.dictionaries(name, inner, max_size=3), max_leaves=12))


@settings(max_examples=1, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(nested, nested), min_size=150, max_size=200))
def test_merge_patch_against_the_standard(spark, pairs):
    rows = [(i, json.dumps(a), json.dumps(b)) for i, (a, b) in enumerate(pairs)]
    df = spark.createDataFrame(rows, "i int, a string, b string").select("i", json_merge_patch("a", "b").alias("m"))
    for row in df.collect():
        a, b = pairs[row["i"]]
        assert json.loads(row["m"]) == merge(a, b), (a, b)


def test_merge_patch_has_no_depth_limit(spark):
    left, right = {"x": 1, "keep": 2}, {"x": None, "new": 3}
    for _ in range(60):
        left, right = {"d": left, "l": 0}, {"d": right}
    df = spark.createDataFrame([(json.dumps(left), json.dumps(right)), (None, "{}")], "a string, b string")
    got = [r["m"] for r in df.select(json_merge_patch("a", "b").alias("m")).collect()]
    assert json.loads(got[0]) == merge(left, right) and got[1] is None


DOCS = [
    {"resourceType": "X", "id": "1"},
    {"resourceType": "X", "id": "1", "meta": {"versionId": "3"}},
    {"resourceType": "X", "id": "1", "meta": {"tag": []}},
    {"resourceType": "X", "id": "1", "meta": {"tag": [{"system": "s", "code": "k", "other": None}], "versionId": "2"}},
    {"resourceType": "X", "id": "1", "meta": {"tag": [{"system": "s", "code": 'q"é\\'}]}, "n": [1, None, 2.5]},
    {"contained": [{"meta": {"tag": [{"system": "s"}]}}], "id": "1", "meta": {"tag": [{"system": "s"}]}},
    {"text": '"meta":{"tag":[', "id": "1", "meta": {"tag": [{"system": "s"}]}},
]


@pytest.mark.parametrize("separators", [(",", ":"), (", ", ": ")])
def test_tag_is_added_once_and_nothing_else_changes(spark, separators):
    rows = [(i, json.dumps(d, separators=separators)) for i, d in enumerate(DOCS)]
    df = spark.createDataFrame(rows, "i int, r string")
    once = tag_source(F.col("r"), "sys", "me")
    for row in df.select("i", once.alias("a")).select("i", "a", tag_source(F.col("a"), "sys", "me").alias("b")).collect():
        got, want = json.loads(row["a"]), json.loads(json.dumps(DOCS[row["i"]]))
        want.setdefault("meta", {}).setdefault("tag", []).append({"system": "sys", "code": "me"})
        assert got == want
        assert row["b"] == row["a"]


def test_path_null_or_missing(spark):
    df = spark.createDataFrame([('{"a":null}',), ('{"b":1}',), ('{"a":{"c":0}}',)], ["r"])
    assert [r[0] for r in df.select(has_path("r", "$.a")).collect()] == [False, False, True]
    assert [r[0] for r in df.select(has_path("r", "$.a", null_is_missing=False)).collect()] == [True, False, True]


def test_entered_in_error(spark):
    rows = ['{"resourceType":"Encounter","status":"finished","x":null}', '{"resourceType":"Condition","id":"1"}',
            '{"resourceType":"Encounter","status":"entered-in-error"}']
    df = spark.createDataFrame([(r,) for r in rows], ["r"])
    plain = [r[0] for r in df.select(entered_in_error("r")).collect()]
    assert json.loads(plain[0]) == {"resourceType": "Encounter", "status": "entered-in-error", "x": None}
    assert json.loads(plain[1])["status"] == "entered-in-error"
    assert plain[2] is None
    aware = df.select(entered_in_error("r", type_aware=True).alias("r"))
    second = json.loads(aware.collect()[1][0])
    assert "status" not in second
    assert second["verificationStatus"]["coding"][0]["code"] == "entered-in-error"
    assert aware.select(entered_in_error("r", type_aware=True)).collect()[1][0] is None


def test_code_comparison_setting(spark):
    loose, exact = Settings(), Settings(case_sensitive_codes=True)
    assert one(spark, C.code_in("g", ["M", "Male"], loose), g="m") is True
    assert one(spark, C.code_in("g", ["M", "Male"], exact), g="m") is False
