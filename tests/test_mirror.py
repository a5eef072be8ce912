from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from clinweave.operators.diff import diff_mode
from clinweave.operators.validate import split_valid
from clinweave.plans.mirror import mirror_tables, run_totals, sync_all, sync_table
from clinweave.settings import Settings
from clinweave.sources.contracts import CONTRACTS, conform, struct_of
from clinweave.sources.tables import Tables, drifted, load_seed, read_source
from tests.conftest import at

S = Settings()
KV = "k int, v string"


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_store_lays_changes_over_the_base(spark, store):
    store.overwrite("t", spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], KV))
    store.upsert("t", spark.createDataFrame([(2, "B"), (4, "d")], KV), ["k"])
    store.delete("t", spark.createDataFrame([(1,)], "k int"), ["k"])
    assert rows_of(store.read("t", ["k"])) == [(2, "B"), (3, "c"), (4, "d")]
    store.upsert("t", spark.createDataFrame([(1, "again")], KV), ["k"])
    assert rows_of(store.read("t", ["k"])) == [(1, "again"), (2, "B"), (3, "c"), (4, "d")]


def test_store_compacts_and_keeps_history(spark, store):
    for i in range(6):
        store.upsert("t", spark.createDataFrame([(i, str(i)), (0, f"v{i}")][1 - bool(i):], KV), ["k"])
    assert rows_of(store.read("t", ["k"])) == [(0, "v5"), *[(i, str(i)) for i in range(1, 6)]]
    assert rows_of(store.read("t", ["k"], before=3)) == [(0, "v1"), (1, "1")]
    names = {p.name for p in Path(store.root, "t").iterdir()}
    assert "base-000000004" in names


def test_store_ignores_a_folder_without_commit(spark, store):
    store.overwrite("t", spark.createDataFrame([(1, "a")], KV))
    number = store.upsert("t", spark.createDataFrame([(1, "lost")], KV), ["k"])
    Path(store.root, "t", f"change-{number:09d}", "_SUCCESS").unlink()
    assert rows_of(store.read("t", ["k"])) == [(1, "a")]
    store.upsert("t", spark.createDataFrame([(1, "b")], KV), ["k"])
    assert rows_of(store.read("t", ["k"])) == [(1, "b")]


def test_store_replaces_a_commit_that_runs_again(spark, store):
    for value in ("first", "second"):
        store.upsert("t", spark.createDataFrame([(1, value)], KV), ["k"], number=1)
    assert rows_of(store.read("t", ["k"])) == [(1, "second")]


def test_store_vacuum(spark, store):
    for i in range(4):
        store.overwrite("t", spark.createDataFrame([(1, str(i))], KV))
    assert store.vacuum("t", keep=2) == 2
    assert rows_of(store.read("t")) == [(1, "3")]
    with pytest.raises(KeyError):
        store.read("nothing")


def test_contract(spark, tables):
    assert len(CONTRACTS) == 23
    with pytest.raises(ValueError, match="class_id"):
        conform(spark.createDataFrame([(1, "u")], "concept_id int, uuid string"), "concept")
    df = conform(spark.createDataFrame([("1", "u   ", 5, "x")], "concept_id string, uuid string, class_id int, more string"), "concept")
    assert df.first().asDict() == {"concept_id": 1, "uuid": "u", "class_id": 5, "more": "x"}


def test_seed(spark, tmp_path):
    packaged = rows_of(load_seed(spark))
    assert [r[0] for r in packaged] == [3, 4, 5, 9]
    other = tmp_path / "seed.csv"
    other.write_text("identifier_type,system,label\n7,http://x,X\n")
    assert rows_of(load_seed(spark, str(other))) == [(7, "http://x", "X")]


def test_read_source(spark, store, clinic):
    clinic()["locations"].write.parquet(f"{store.root}/src/locations")
    assert read_source(spark, f"{store.root}/src", "locations").first()["name"] == "Clinic"


def test_drift_ignores_order(spark):
    a = spark.createDataFrame([(1, "a")], KV)
    assert not drifted(a, a.select("v", "k"))
    assert drifted(a, a.select("k"))


def test_split_valid(spark):
    df = spark.createDataFrame([("1", "5", "n"), ("2", "x", "n"), (None, "1", "n"), ("4", None, "n")], "id string, n string, more string")
    good, bad = split_valid(df, struct_of("id bigint, n int"), ["id"])
    assert sorted((r["id"], r["n"], r["more"]) for r in good.na.fill(0).collect()) == [(1, 5, "n"), (4, 0, "n")]
    assert rows_of(bad) == [("id=2", "n is not int"), ("id=NULL", "id is null")]


def encounter(k, created="2026-01-01", updated=None, uuid="u"):
    return {"mspp_code": "1", "encounter_id": k, "patient_id": k, "uuid": f"{uuid}{k}", "date_created": at(created),
            "date_updated": updated and at(updated)}


def sync(store, t, name, s=S, **kw):
    r = sync_table(store, t[name], CONTRACTS[name], s, **kw)
    return r.mode, r.upserted, r.skipped, r.deleted


def same(a, b):
    return a.select(sorted(a.columns)).exceptAll(b.select(sorted(a.columns))).isEmpty() and a.count() == b.count()


def test_sync_by_version(store, tables):
    name = "encounter_openmrs"
    first = tables(encounter_openmrs=[encounter(1), encounter(2), encounter(3)])
    assert sync(store, first, name) == ("baseline", 3, 0, 0)
    assert sync(store, first, name) == ("per-entry", 0, 0, 0)
    later = tables(encounter_openmrs=[encounter(1, updated="2026-02-01"), encounter(2, uuid="edit"), encounter(4)])
    # Row 2 was edited without a newer version: not seen.
    assert sync(store, later, name) == ("per-entry", 2, 0, 1)
    got = {r["encounter_id"]: r["uuid"] for r in store.read(name, CONTRACTS[name].key).collect()}
    assert got == {1: "u1", 2: "u2", 4: "u4"}
    # An older source version does not overwrite.
    assert sync(store, tables(encounter_openmrs=[encounter(1), encounter(2), encounter(4)]), name)[1] == 0
    assert sync(store, later, name, force_hash=True) == ("content-hash", 1, 0, 0)
    assert same(later[name], store.read(name, CONTRACTS[name].key))


def test_sync_by_content(store, tables):
    place = lambda k, n: {"location_id": k, "name": n}
    assert sync(store, tables(locations=[place(1, "a"), place(2, None), place(3, "c")]), "locations")[0] == "baseline"
    later = tables(locations=[place(1, "A"), place(2, ""), place(4, "d")])
    assert sync(store, later, "locations") == ("content-hash", 3, 0, 1)
    assert same(later["locations"], store.read("locations", ["location_id"]))


def test_sync_without_key_copies_all(store, tables):
    t = tables(patient_diagnosis=[{"mspp_code": "1", "patient_id": 1}] * 2)
    for _ in range(2):
        assert sync(store, t, "patient_diagnosis") == ("full (no key)", 2, 0, 0)
    assert store.read("patient_diagnosis").count() == 2


def test_mode(spark):
    df = spark.createDataFrame([(1, "a")], KV)
    assert [diff_mode(df, [], True), diff_mode(df, ["k"], False), diff_mode(df, ["k"], True)] == [
        "full (no key)", "baseline", "content-hash",
    ]


def test_drifted_copy_is_pulled_again(store, tables):
    t = tables(locations=[{"location_id": 1, "name": "a"}])
    store.overwrite("locations", t["locations"].drop("active"))
    assert sync(store, t, "locations") == ("baseline", 1, 0, 0)
    assert "active" in store.read("locations").columns


def test_delete_guard(store, tables):
    t = tables(encounter_openmrs=[encounter(k) for k in range(4)])
    sync(store, t, "encounter_openmrs")
    with pytest.raises(ValueError, match="would be deleted"):
        sync(store, tables(), "encounter_openmrs", Settings(max_delete_fraction=0.5))
    assert sync(store, tables(), "encounter_openmrs") == ("per-entry", 0, 0, 4)


def test_bad_rows_are_set_aside(store, tables):
    t = tables(encounter_openmrs=[encounter(1), encounter(2)])
    raw = t["encounter_openmrs"].withColumn("encounter_id", F.when(F.col("encounter_id") == 2, "two").otherwise("1"))
    swapped = Tables(lambda n: raw, ["encounter_openmrs"])
    assert sync(store, swapped, "encounter_openmrs") == ("baseline", 1, 1, 0)
    assert rows_of(store.read("encounter_openmrs_rejects")) == [("mspp_code=1, encounter_id=two", "encounter_id is not bigint")]


def test_one_bad_table_does_not_stop_the_others(spark, store, tables):
    t = tables(locations=[{"location_id": 1}])

    def load(name):
        if name == "site":
            raise RuntimeError("no such table")
        return t[name]

    names = ["locations", "site", "concept"]
    results, changed = sync_all(Tables(load, names), store, S, names)
    assert [bool(r.error) for r in results] == [False, True, False]
    assert changed
    assert rows_of(run_totals(spark, results)) == [("locations", "upserted", 1), ("site", "failed", 1)]
    results, changed = sync_all(t, store, S, ["locations", "concept"])
    assert not changed
    assert mirror_tables(store)["locations"].count() == 1


def test_source_tables_from_parquet(spark, clinic, tmp_path):
    """Tables as Parquet under a root, typed by their contracts; a table that lacks a column is refused."""
    from clinweave.sources.tables import source_tables

    visits = clinic()["visit_openmrs"]
    visits.withColumn("visit_id", F.col("visit_id").cast("int")).withColumn("uuid", F.rpad("uuid", 38, " ")).write.parquet(f"{tmp_path}/visit_openmrs")
    visits.drop("uuid").write.parquet(f"{tmp_path}/encounter_openmrs")
    t = source_tables(spark, str(tmp_path))
    assert sorted((r["visit_id"], r["uuid"]) for r in t["visit_openmrs"].collect()) == [(9, "v-9"), (10, "v-10")]
    assert dict(t["visit_openmrs"].dtypes)["visit_id"] == "bigint"
    with pytest.raises(ValueError, match="missing columns"):
        t["encounter_openmrs"]
