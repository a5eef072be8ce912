from __future__ import annotations

import json
from dataclasses import replace
from datetime import datetime, timedelta
from urllib.parse import quote

import pytest
from pyspark.sql import functions as F

from clinweave.operators import delivery as D
from clinweave.operators import reconcile as R
from clinweave.plans.cycle import run_cycle
from clinweave.plans.materialize import transform, views_of
from clinweave.plans.models import MODELS, to_table
from clinweave.plans.push import Outbox, advance, markers, push, push_patients, reconcile, retract, state_of
from clinweave.settings import Settings
from clinweave.sources.inventory import Listing, SearchReader, delivered_ids, read_delivered, search_source
from tests.conftest import at

# The size check of child arrays has its own tests; without it the plans are half as long.
S = Settings(max_children=None)
T1, T2 = at("2026-01-01"), at("2026-02-01")
ROW = "view string, fhir_id string, patient_fhir_id string, resource string, changed_at timestamp_ntz"


def doc(kind, key, **more):
    return json.dumps({"resourceType": kind, "id": key, **more}, separators=(",", ":"))


def clinical(spark, rows):
    data = [(view, key, patient, doc(view.title(), key), when) for view, key, patient, when in rows]
    return spark.createDataFrame(data, ROW)


def patients(spark, *keys):
    return spark.createDataFrame([("patient", k, doc("Patient", k), T1) for k in keys],
                                 "view string, fhir_id string, resource string, changed_at timestamp_ntz")


def bundles_of(df):
    return {r["bundle_id"]: json.loads(r["bundle"]) for r in df.collect()}


def urls(bundle):
    return [e["request"]["url"] for e in bundle["entry"]]


def test_pending_is_strictly_newer(spark):
    rows = clinical(spark, [("obs", "new", "p", T1), ("obs", "same", "p", T1), ("obs", "edit", "p", T2), ("obs", "older", "p", T1),
                            ("enc", "same", "p", T1)])
    state = spark.createDataFrame(
        [("obs", "same", T1, None), ("obs", "edit", T1, None), ("obs", "older", T2, None), ("obs", "zz", T2, None)], D.STATE_SCHEMA
    )
    got = sorted((r["view"], r["fhir_id"]) for r in D.pending(rows, state, S).collect())
    assert got == [("enc", "same"), ("obs", "edit"), ("obs", "new")]


def test_pending_by_content(spark):
    rows = clinical(spark, [("obs", "a", "p", T1), ("obs", "b", "p", T1)])
    state = rows.select(F.col("view").alias("resource_type"), "fhir_id", "changed_at",
                        F.when(F.col("fhir_id") == "a", F.md5("resource")).otherwise("x").alias("content_hash"))
    assert [r["fhir_id"] for r in D.pending(rows, state, Settings(use_content_hash=True)).collect()] == ["b"]


def test_pages_against_a_plain_sort(spark):
    df = spark.range(1037).select(F.md5(F.col("id").cast("string")).alias("k")).repartition(7)
    got = {r["k"]: r["page"] for r in D.paginate(df, ["k"], 100).collect()}
    assert got == {k: i // 100 for i, k in enumerate(sorted(got))}
    assert len(got) == 1037
    assert D.paginate(df.limit(0), ["k"], 100).count() == 0


def test_identity_bundles(spark):
    s = Settings(identity_page=2)
    got = bundles_of(D.identity_bundles(patients(spark, "c", "a", "b"), s))
    assert [urls(got[k]) for k in sorted(got)] == [["Patient/a", "Patient/b"], ["Patient/c"]]
    first = got["identity-0"]
    assert first["type"] == "transaction"
    assert first["entry"][0]["request"] == {"method": "PUT", "url": "Patient/a"}
    assert first["entry"][0]["resource"]["meta"]["tag"] == [{"system": s.source_tag_system, "code": s.source_tag_code}]


def test_clinical_bundles_lead_with_the_patient(spark):
    rows = clinical(spark, [("obs", "o2", "p1", T1), ("enc", "e1", "p1", T1), ("obs", "o1", "p2", T1), ("obs", "o9", "gone", T2)])
    groups = D.clinical_groups(rows, patients(spark, "p1", "p2", "p3"), S)
    got = bundles_of(D.clinical_bundles(groups))
    assert {k: urls(b) for k, b in got.items()} == {
        "clinical-p1": ["Patient/p1", "Enc/e1", "Obs/o2"], "clinical-p2": ["Patient/p2", "Obs/o1"],
    }
    assert [(r["resource_type"], r["fhir_id"], r["changed_at"]) for r in D.skipped(groups).collect()] == [("obs", "o9", T2)]


@pytest.mark.parametrize(("broadcast_rows", "huge_parts"), [(1_000_000, 1000), (0, 1000), (0, 3)])
def test_a_large_patient_is_split_and_nothing_is_lost(spark, monkeypatch, broadcast_rows, huge_parts):
    monkeypatch.setattr(D, "BROADCAST_ROWS", broadcast_rows)
    monkeypatch.setattr(D, "HUGE_PARTS", huge_parts)
    rows = clinical(spark, [("obs", f"o{i}", "big", T1) for i in range(95)] + [("obs", "x", "small", T1)])
    s = Settings(bundle_entries=10)
    groups = D.clinical_groups(rows, patients(spark, "big", "small"), s)
    got = bundles_of(D.clinical_bundles(groups))
    big = [b for k, b in got.items() if k.startswith("clinical-big")]
    assert len(big) > 5
    assert max(len(b["entry"]) for b in big) < 40
    assert all(urls(b)[0] == "Patient/big" for b in big)
    assert sorted(u for b in big for u in urls(b)[1:]) == sorted(f"Obs/o{i}" for i in range(95))
    assert urls(got["clinical-small"]) == ["Patient/small", "Obs/x"]


class Scripted:
    def __init__(self, *answers):
        self.answers, self.calls = list(answers), 0

    def __call__(self, body):
        answer = self.answers[min(self.calls, len(self.answers) - 1)]
        self.calls += 1
        if isinstance(answer, Exception):
            raise answer
        return answer


@pytest.mark.parametrize(
    ("answers", "status", "calls", "waits"),
    [
        ([200], "200", 1, []),
        ([201], "201", 1, []),
        ([503, 503, 201], "201", 3, [1, 2]),
        ([503], "ERR 503", 3, [1, 2]),
        ([422], "ERR 422", 1, []),
        ([OSError("down"), 200], "200", 2, [1]),
        ([OSError("down")], "EXC down", 3, [1, 2]),
    ],
)
def test_send(answers, status, calls, waits):
    transport, slept = Scripted(*answers), []
    assert D.send("{}", transport, 3, slept.append) == status
    assert (transport.calls, slept) == (calls, waits)


def answering(refused=None, code=500):
    """A receiver that refuses bundles with the text. A closure, so that the workers need not import this file."""
    return lambda body: code if refused is None or refused in body else 200


def test_the_text_of_a_refusal_is_kept():
    assert D.send("{}", lambda body: (422, "no such code" + "x" * 500), 3) == "ERR 422: no such code" + "x" * 148
    assert D.send("{}", lambda body: (201, "fine"), 3) == "201" and D.send("{}", lambda body: (400, ""), 3) == "ERR 400"


def test_deliver_and_marks(spark):
    s = Settings(identity_page=1)
    bundles = D.identity_bundles(patients(spark, "a", "b", "c"), s)
    refuse_b = answering('"Patient/b"')
    status = D.deliver(bundles, refuse_b, pause=lambda seconds: None)
    assert {r["bundle_id"]: r["status"] for r in status.collect()} == {"identity-0": "200", "identity-1": "ERR 500", "identity-2": "200"}
    assert sorted(r["fhir_id"] for r in D.marks_on_success(bundles, status).collect()) == ["a", "c"]
    dry = D.deliver(bundles, refuse_b, dry_run=True)
    assert {r["status"] for r in dry.collect()} == {"DRY_RUN"}
    assert D.marks_on_success(bundles, dry).isEmpty()
    empty = bundles.withColumn("size", F.lit(0))
    assert {r["status"] for r in D.deliver(empty, refuse_b).collect()} == {"200"}


def test_full_bundles(spark):
    rows = clinical(spark, [("encounter", "e1", "a", T1), ("visit", "v1", "a", T1), ("visit", "v2", "z", T1)])
    views = {"patient": patients(spark, "a", "b", "c").drop("view"), **{
        v: rows.filter(F.col("view") == v).drop("view") for v in ("encounter", "visit")}}
    keys = spark.createDataFrame([("a",), ("a",), ("b",), ("missing",)], ["fhir_id"])
    got = {k: urls(b) for k, b in bundles_of(D.full_bundles(keys, views, S)).items()}
    assert got == {"full-a": ["Patient/a", "Encounter/e1", "Visit/v1"], "full-b": ["Patient/b"]}
    only = bundles_of(D.full_bundles(keys, {"patient": views["patient"]}, S))
    assert sorted(only) == ["full-a", "full-b"]


def test_second_push_sends_only_the_globals(clinic, store):
    t = clinic()
    transform(t, store, S)
    first = push(store, views_of(store), S)
    assert first == {"identity_ok": 1, "identity_fail": 0, "clinical_ok": 2, "clinical_fail": 0, "skipped": 1, "global_ok": 1, "global_fail": 0}
    second = push(store, views_of(store), S)
    assert second == {"identity_ok": 0, "identity_fail": 0, "clinical_ok": 0, "clinical_fail": 0, "skipped": 0, "global_ok": 1, "global_fail": 0}
    views = views_of(store)
    sent = {(r["resource_type"], r["fhir_id"]) for r in state_of(store).collect()}
    assert sent == {(v, r["fhir_id"]) for v in ("patient", *S.clinical_views) for r in views[v].collect()}
    assert sorted(r["fhir_id"] for r in delivered_ids(store, "Observation").collect()) == ["o-10", "o-11", "o-12"]
    assert push_patients(store, views["patient"], views, S)["full_ok"] == 2


def test_a_failed_push_is_tried_again(clinic, store):
    transform(clinic(), store, S)
    down = replace(S, send_retries=1)
    totals = push(store, views_of(store), down, answering())
    assert totals["identity_fail"] == 1
    assert {r["resource_type"] for r in state_of(store).collect()} == {"visit"}, "only the skipped row is remembered"
    assert push(store, views_of(store), S)["clinical_ok"] == 2


def test_dry_run_remembers_nothing(clinic, store):
    transform(clinic(), store, S)
    totals = push(store, views_of(store), replace(S, dry_run=True), answering())
    assert totals["identity_ok"] == 1
    assert state_of(store).isEmpty()


def test_orphans(spark):
    pair = "resource_type string, fhir_id string"
    expected = spark.createDataFrame([("Encounter", "a"), ("Encounter", "b")], pair)
    held = spark.createDataFrame([("Encounter", "a"), ("Encounter", "b"), ("Encounter", "c"), ("Patient", "x")], pair)
    assert [tuple(r) for r in R.orphans(expected, held).collect()] == [("Encounter", "c")]


def test_types_with_a_missing_view_are_left_alone(clinic):
    t = clinic()
    views = {n: to_table(MODELS[n].build(t, S)) for n in ("encounter", "condition")}
    assert R.complete_types(views, S) == ["Condition"]
    assert {r["resource_type"] for r in R.expected_ids(views, S).collect()} == {"Condition"}
    assert R.managed(Settings(clinical_views=("visit", "unheard_of"))) == {"visit": "Encounter"}


def test_retract_and_return(clinic, store):
    alive, gone = clinic(), clinic(visit_openmrs=[])
    transform(alive, store, S)
    push(store, views_of(store), S)
    transform(gone, store, S)
    # The other visit belongs to a voided patient and was never sent.
    assert retract(store, views_of(store), S) == 1
    assert retract(store, views_of(store), S) == 0
    held = {r["fhir_id"]: json.loads(r["resource"]) for r in read_delivered(Outbox(store).log(), S).collect()}
    assert held["v-9"]["status"] == "entered-in-error"
    assert held["o-10"]["status"] == "final"
    assert "v-9" not in {r["fhir_id"] for r in state_of(store).collect()}
    transform(alive, store, S)
    assert push(store, views_of(store), S)["clinical_ok"] == 1, "the visit is back and sent again"


def test_due(spark, store):
    now = datetime(2026, 1, 1, 12)
    ask = lambda every, when: R.due(markers(store), every, when).first()["due"]
    assert (ask(0, now), ask(60, now)) == (False, True)
    advance(store, R.MARKER, now)
    assert [ask(60, now + timedelta(seconds=s)) for s in (59, 60)] == [False, True]
    assert ask(0, now + timedelta(days=9)) is False


def test_reconcile_keeps_its_own_pace(clinic, store):
    s = replace(S, retract_every=3600)
    transform(clinic(), store, s)
    push(store, views_of(store), s)
    assert reconcile(store, views_of(store), s, T1) == 0
    assert reconcile(store, views_of(store), s, T1 + timedelta(minutes=1)) is None
    assert reconcile(store, views_of(store), s, T1 + timedelta(hours=1)) == 0


def test_cycle(clinic, tables, store, spark):
    from clinweave.sources.snapshots import Store

    mirror = Store(spark, f"{store.root}/mirror")
    s = replace(S, retract_every=1, clinical_views=("encounter", "visit"))
    first = run_cycle(clinic(), mirror, store, s, T1)
    assert first.failed == []
    assert first.totals["clinical_ok"] == 1
    idle = run_cycle(clinic(), mirror, store, replace(s, retract_every=0), T1)
    assert idle.stages["transform"] == idle.stages["push"] == "skipped", "nothing changed, keyless tables included"
    last = run_cycle(clinic(visit_openmrs=[]), mirror, store, s, T2)
    assert last.failed == []
    assert last.totals["retracted"] == 1


def test_cycle_reports_a_failed_stage_and_goes_on(clinic, store, monkeypatch):
    import clinweave.plans.cycle as cycle

    monkeypatch.setattr(cycle, "transform", lambda *a: 1 / 0)
    report = run_cycle(clinic(), store, store, Settings(use_mirror=False), T1)
    assert report.failed == ["transform"] or report.failed == ["transform", "push"]
    assert report.stages["reconcile"] == "skipped"
