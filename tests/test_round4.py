"""Queries over all of their views, and what a delivery moves, writes and reads."""

from __future__ import annotations

from pathlib import Path

from clinweave.checks import queries as K
from clinweave.checks.oracle import ORACLE
from clinweave.operators import delivery as D
from clinweave.plans.materialize import one_per_key
from clinweave.plans.models import MODELS, to_table
from clinweave.plans.push import push
from clinweave.settings import CLINICAL_VIEWS, VIEW_KINDS, Settings
from tests.conftest import at
from tests.test_push import clinical, patients
from tests.test_round3 import plan_of

S = Settings()
JAN = at("2026-01-02 09:00:00")


def over(monkeypatch, tables) -> None:
    """The queries read these tables."""
    monkeypatch.setattr(K, "clinical_tables", lambda spark, root: tables)


def of_each_view(patient: int, site: str = "11106") -> dict[str, list[dict]]:
    """A row of every clinical view of one patient."""
    own = {"mspp_code": site, "patient_id": patient}
    return {
        "visit_openmrs": [{**own, "visit_id": 9, "date_started": JAN, "uuid": "v-9", "date_created": JAN}],
        "encounter_openmrs": [{**own, "encounter_id": 1, "encounter_datetime": JAN, "uuid": "e-1", "date_created": JAN}],
        "obs_openmrs": [{"mspp_code": site, "obs_id": 10, "person_id": patient, "concept_id": 5, "uuid": "o-10", "date_created": JAN}],
        "allergy_openmrs": [{**own, "allergy_id": 3, "uuid": "a-3", "date_created": JAN}],
        "patient_diagnosis": [{**own, "encounter_id": 1, "concept_id": 5, "encounter_date": JAN, "voided": 0}],
        "patient_prescription": [{**own, "encounter_id": 1, "location_id": 1, "drug_id": 12, "visit_date": JAN, "voided": 0}],
    }


def test_skipped_rows_of_all_views(spark, clinic, monkeypatch):
    """dl6: a patient that is not there has rows in each of the six views."""
    over(monkeypatch, clinic(**of_each_view(12)))
    assert sorted(r["resource_type"] for r in K.dl6_skip(spark, "").collect()) == sorted(CLINICAL_VIEWS)
    assert all(f"'{view}' as view" in ORACLE["dl6_skip"] for view in CLINICAL_VIEWS)


def test_full_push_of_all_views(spark, clinic, monkeypatch):
    """dl8: everything of a patient with a fingerprint is sent, whatever view it is in."""
    print_of = [{"id": 1, "mspp_code": "11106", "patient_id": 11, "created_at": JAN}]
    over(monkeypatch, clinic(**of_each_view(11), national_fingerprint_mapping=print_of))
    sent = K.dl8_full_push(spark, "").collect()
    assert {r["lead_url"] for r in sent} == {"Patient/p-a"} and len(sent) == 1 + len(CLINICAL_VIEWS)
    assert all(f"'{view}' as view" in ORACLE["dl8_full_push"] for view in CLINICAL_VIEWS)


def test_inventory_of_all_views(spark, clinic, monkeypatch):
    """rc2: what was delivered holds a resource of every type that has rows."""
    over(monkeypatch, clinic(**of_each_view(11)))
    held = K.rc2_delivered(spark, "").collect()
    assert {r["resource_type"] for r in held} == set(VIEW_KINDS.values())
    assert {(r["resource_type"], r["fhir_id"]) for r in held} >= {("Observation", "o-10"), ("Encounter", "v-9"), ("Encounter", "e-1")}
    assert all(f"'{view}' as view" in ORACLE["rc2_delivered"] for view in CLINICAL_VIEWS)


def test_documents_are_dealt_out_once_for_their_bundles(spark):
    """dl3, dl8, rc2, st6: rows and patients meet in one exchange of documents, without a join and without their entries."""
    rows = clinical(spark, [("obs", "o2", "p1", JAN), ("obs", "o1", "p1", JAN), ("obs", "o9", "gone", JAN), ("obs", "o8", None, JAN)])
    for how in ("left", "right"):
        plan = plan_of(D._whole_groups(rows, patients(spark, "p1", "p2"), how, S))
        assert "Join" not in plan and plan.count("RebalancePartitions") == 1
        assert "entry" not in plan.partition("RebalancePartitions")[2]
    left, right = (D._whole_groups(rows, patients(spark, "p1", "p2", None), how, S) for how in ("left", "right"))
    got = [sorted((r["patient_fhir_id"] or "", len(r["rows"]), r["patient"] is not None) for r in df.collect()) for df in (left, right)]
    assert got == [[("", 1, False), ("gone", 1, False), ("p1", 2, True)], [("", 0, True), ("p1", 2, True), ("p2", 0, True)]]


def test_skipped_rows_need_no_documents(spark, clinic):
    """dl6: who is skipped, and since when, is told without building, ranking or grouping a document."""
    t = clinic()
    views = {name: one_per_key(to_table(MODELS[name].build(t, S)), MODELS[name].grain) for name in ("patient", *CLINICAL_VIEWS)}
    absent = D.skipped(D.clinical_groups(D.pending_clinical(views, D.empty_state(spark), S), views["patient"], S))
    plan = plan_of(absent.select("resource_type", "fhir_id", "changed_at"))
    assert "collect_list(struct(view" not in plan and "resourceType" not in plan
    assert {r["fhir_id"] for r in absent.collect()} == {"v-10"}


def test_a_row_is_chosen_with_its_document(spark):
    """The part of the order that stands by itself agrees with the rest of the row, ties and unknown times included."""
    rows = [("x", JAN, 1, "p", "b"), ("x", JAN, 1, "p", "a"), ("x", None, 0, "p", "0"), ("y", None, 2, None, "c"), ("y", None, 1, "q", "d"), (None, JAN, 1, "p", "e")]
    df = spark.createDataFrame(rows, "fhir_id string, changed_at timestamp_ntz, obs_id int, patient_fhir_id string, resource string")
    got = sorted(map(tuple, one_per_key(df, ["obs_id"]).collect()), key=str)
    assert got == sorted([("x", JAN, 1, "p", "a"), ("y", None, 1, "q", "d"), (None, JAN, 1, "p", "e")], key=str)


def test_accepted_bundles_are_not_moved(spark):
    """rc2, rc5, st1, st6: nothing meets the bundles where all were accepted, and the ids of the refused where few were not."""
    bundles = spark.createDataFrame([("a", "x"), ("b", "y"), (None, "z")], "bundle_id string, bundle string")
    status = lambda *rows: spark.createDataFrame(list(rows), "bundle_id string, status string")
    every = D.accepted(bundles, status(("a", "200"), ("b", "201"), (None, "200")))
    assert "Join" not in plan_of(every) and sorted(r["bundle_id"] for r in every.collect()) == ["a", "b"]
    some = D.accepted(bundles, status(("a", "200"), ("b", "ERR 422"), (None, "200")))
    assert "strategy=broadcast" in plan_of(some) and [r["bundle_id"] for r in some.collect()] == ["a"]
    assert D.accepted(bundles, status(("a", "DRY_RUN"), ("b", None), (None, "DRY_RUN"))).isEmpty()


def test_marks_of_skipped_rows_are_made_before_they_meet_patients(spark):
    """rc2, st1: the join that tells who has no patient moves digests, not documents."""
    rows = clinical(spark, [("obs", "o1", "p1", JAN), ("obs", "o2", "gone", JAN), ("obs", "o3", None, JAN)])
    absent = D.skipped_rows(rows, patients(spark, "p1"))
    assert "md5" in plan_of(absent).partition("Join LeftAnti")[2] and sorted(r["fhir_id"] for r in absent.collect()) == ["o2", "o3"]


def test_tables_and_log_are_written_in_little_room(spark, store):
    """rc2, rc5: documents repeat themselves."""
    views = {"patient": patients(spark, "p1").drop("view"), "encounter": clinical(spark, [("encounter", "e1", "p1", JAN)]).drop("view")}
    push(store, views, Settings(clinical_views=("encounter",), global_views=()))
    files = [f.name for f in Path(store.root).rglob("part-*.parquet")]
    assert files and all(".zstd." in name for name in files)
