"""What is moved, read and kept: plans and counts that once grew faster than the tables."""

from __future__ import annotations

import json
import tempfile

from pyspark.sql import functions as F

from clinweave.checks import queries as K
from clinweave.operators import delivery as D
from clinweave.operators import reconcile as R
from clinweave.operators.joins import lookup
from clinweave.operators.upsert import dedup
from clinweave.operators.validate import split_valid
from clinweave.plans import mirror as M
from clinweave.plans import push as P
from clinweave.plans.materialize import one_per_key
from clinweave.plans.models import MODELS, to_table
from clinweave.settings import Settings
from clinweave.sources.changes import envelope_keys
from clinweave.sources.contracts import CONTRACTS, struct_of
from tests.conftest import at
from tests.test_push import bundles_of, clinical, patients, urls

S = Settings()
T1 = at("2026-01-01")


def plan_of(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_ids_of_a_resource_table_need_no_documents(clinic):
    """rc1: with the ids alone asked for, no document is rendered, ranked or moved, and no label is looked up."""
    t = clinic()
    for name in ("observation", "encounter", "allergy_intolerance"):
        ids = one_per_key(to_table(MODELS[name].build(t, S)), MODELS[name].grain).select("fhir_id")
        plan = plan_of(ids)
        assert "resourceType" not in plan and "LeftOuter" not in plan, name


def test_a_ranked_document_is_moved_once(spark):
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 2, "w"), (None, 3, "v"), (None, 3, "u")], "fhir_id string, n int, resource string")
    out = dedup(rows, ["fhir_id"], [-F.col("n"), "resource"])
    assert sorted((tuple(r) for r in out.collect()), key=str) == [("a", 2, "w"), (None, 3, "u")]
    assert out.columns == rows.columns
    group = next(line for line in plan_of(out).splitlines() if "Aggregate" in line)
    assert group.count("resource#") == 1
    unordered = rows.withColumn("m", F.create_map(F.lit("k"), "resource"))
    assert {r["fhir_id"]: r["m"] for r in dedup(unordered, ["fhir_id"], ["n"]).collect()}["a"] == {"k": "x"}


def test_null_keys_of_a_lookup_are_dealt_out(spark):
    """r4, q3: the number that spreads null keys is a join key of the plan, not a condition beside it."""
    fact = spark.range(4000).select("id", F.when(F.col("id") % 10 == 0, F.col("id")).alias("k"))
    side = spark.range(4000).select(F.col("id").alias("s"), (F.col("id") * 2).alias("twice"))
    out = lookup(fact, side.hint("merge"), {"k": "s"}, ["id"])
    assert "_salt_l" in next(line for line in out._jdf.queryExecution().sparkPlan().toString().splitlines() if "SortMergeJoin" in line).partition("LeftOuter")[0]
    assert {r["id"]: r["twice"] for r in out.collect()} == {i: 2 * i if i % 10 == 0 else None for i in range(4000)}


def test_groups_are_built_without_settling_documents(spark, monkeypatch):
    """dl3, dl6, dl8: one pass over the rows; patients with and without rows, and rows without a patient."""
    monkeypatch.setattr(D, "settle", lambda df: (_ for _ in ()).throw(AssertionError("settled")))
    rows = clinical(spark, [("obs", "o2", "p1", T1), ("obs", "o1", "p1", T1), ("obs", "o9", "gone", T1), ("obs", "o8", None, T1)])
    groups = D.clinical_groups(rows, patients(spark, "p1", "p2"), S)
    assert {k: urls(b) for k, b in bundles_of(D.clinical_bundles(groups)).items()} == {"clinical-p1": ["Patient/p1", "Obs/o1", "Obs/o2"]}
    both = [D.skipped(groups), D.skipped_rows(rows, patients(spark, "p1", "p2"))]
    kept = [sorted(map(tuple, df.select("resource_type", "fhir_id", "changed_at", "content_hash").collect())) for df in both]
    assert kept[0] == kept[1] and [r[1] for r in kept[0]] == ["o8", "o9"]
    views = {"patient": patients(spark, "p1", "p2", "p3"), "encounter": rows.drop("view")}
    keys = spark.createDataFrame([("p1",), ("p2",), ("no",)], "fhir_id string")
    full = bundles_of(D.full_bundles(keys, views, S))
    assert {k: len(b["entry"]) for k, b in full.items()} == {"full-p1": 3, "full-p2": 1}


def test_orphans_are_compared_before_copies_are_dropped(spark):
    """rc4, rc3, o3: the documents of expected resources take no part in an aggregate."""
    held = spark.createDataFrame([("Encounter", k, d) for k, d in (("a", "1"), ("a", "1"), ("b", "2"), ("b", "2"))], "resource_type string, fhir_id string, resource string")
    out = R.orphans(held.filter("fhir_id = 'a'").select("resource_type", "fhir_id"), held)
    assert [tuple(r) for r in out.collect()] == [("Encounter", "b", "2")]
    plan = plan_of(out)
    assert plan.index("Aggregate") < plan.index("LeftAnti")


def test_a_shelf_reads_a_group_not_a_bucket(spark, monkeypatch):
    """rc5: what a request reads does not grow with the shelf."""
    monkeypatch.setattr(K.Shelf, "BUCKETS", 1)
    monkeypatch.setattr(K.Shelf, "GROUP", 1 << 12)
    body = F.to_json(F.struct(F.lit("Visit").alias("resourceType"), F.col("fhir_id").alias("id"), F.sha2("fhir_id", 512).alias("x"), F.lit("a\nb").alias("y")))
    docs = spark.range(3000).select(F.lit("Visit").alias("resource_type"), F.concat(F.lit("v/"), "id").alias("fhir_id")).withColumn("resource", body)
    shelf = K.Shelf.write(docs, f"{tempfile.mkdtemp(prefix='run-')}/shelf")
    assert shelf("x/Visit/v%2F1234")["id"] == "v/1234" and shelf("x/Visit/v%2F1234")["y"] == "a\nb"
    assert shelf("x/Visit/v%2F3000") == K.GONE and shelf("x/Other/v%2F1") == K.GONE
    (file,) = K._shelf(shelf.folder, "Visit", 0)
    assert file.num_row_groups > 5
    seen = []
    monkeypatch.setattr(K.pc, "index", lambda column, key, known=K.pc.index: seen.append(len(column)) or known(column, key))
    assert shelf("x/Visit/v%2F77")["id"] == "v/77"
    assert len(seen) == 1 and seen[0] < 1000


def test_rejects_of_a_typed_source_need_its_keys_alone(spark, store):
    """c6, st1, st6: the second pass over a source reads the columns that can be bad."""
    folder = tempfile.mkdtemp(prefix="run-")
    site, kinds = CONTRACTS["site"], "mspp_code string, name string"
    spark.createDataFrame([("11100", "n"), (None, "x"), ("11101", None)], kinds).write.mode("overwrite").parquet(folder)
    typed = spark.read.parquet(folder)
    _, rejects = split_valid(typed, site.schema, site.key, site.optional)
    assert "ReadSchema: struct<mspp_code:string>" in rejects._jdf.queryExecution().sparkPlan().toString()
    assert M.sync_table(store, typed, site, S) == M.SyncResult("site", "baseline", 2, 1)
    assert [tuple(r) for r in store.read("site_rejects").collect()] == [("mspp_code=NULL", "mspp_code is null")]
    text = spark.createDataFrame([("1", "a"), ("x", "b")], "id string, name string")
    _, rejects = split_valid(text, struct_of("id bigint, name string"), ["id"])
    assert [tuple(r) for r in rejects.collect()] == [("id=x", "id is not bigint")]


def test_a_push_settles_no_documents(spark, store, monkeypatch):
    """rc2, rc5, st1: what is kept between the steps of a push are marks."""
    settled = []
    monkeypatch.setattr(P, "settle", lambda df, known=P.settle: settled.append(df.columns) or known(df))
    views = {"patient": patients(spark, "p1").drop("view"), "encounter": clinical(spark, [("encounter", "e1", "p1", T1), ("encounter", "e2", "no", T1)]).drop("view")}
    s = Settings(clinical_views=("encounter",), global_views=())
    assert P.push(store, views, s) == {"identity_ok": 1, "identity_fail": 0, "clinical_ok": 1, "clinical_fail": 0, "skipped": 1}
    assert settled == [["resource_type", "fhir_id", "changed_at", "content_hash"]]
    assert sorted(r["fhir_id"] for r in P.state_of(store).collect()) == ["e1", "e2", "p1"]
    assert P.push(store, views, s)["clinical_ok"] == 0


def test_change_keys_take_each_member_once(spark):
    """st4: one branch per patient column, however many tables there are."""
    rows = [("person_openmrs", None, {"mspp_code": "1", "person_id": 7}), ("obs_openmrs", {"mspp_code": "2", "person_id": 8}, None),
            ("visit_openmrs", None, {"mspp_code": "3", "patient_id": 9, "person_id": 1}), ("concept", None, {"patient_id": 1}), (None, None, {"patient_id": 1})]
    events = spark.createDataFrame([(t, *(None if d is None else json.dumps(d) for d in (b, a))) for t, b, a in rows], "tbl string, before string, after string")
    keys = envelope_keys(events)
    assert sorted(map(tuple, keys.collect())) == [("1", 7), ("2", 8), ("3", 9)]
    filtered = next(line for line in plan_of(keys).splitlines() if "Filter" in line)
    assert filtered.count("get_json_object") <= 4
