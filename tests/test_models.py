from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from clinweave.plans.materialize import audits, one_per_key
from clinweave.plans.models import MODELS, to_table
from clinweave.settings import Settings
from clinweave.sources.tables import Tables
from tests.conftest import at, day

REFERENCE = Settings(nulls="reference")


def documents(t, name, s=Settings()):
    rows = to_table(MODELS[name].build(t, s)).collect()
    return {r["fhir_id"]: (r, json.loads(r["resource"])) for r in rows}


def identity(tables, **extra):
    return tables(
        patient_openmrs=[{"mspp_code": "11106", "patient_id": 11, "voided": 0}],
        person_openmrs=[{"mspp_code": "11106", "person_id": 11, "gender": "M", "birthdate": day("1990-01-01"), "dead": 0,
                         "uuid": "fe5cae86-52a1-4713-b39d-4c05a9da3abf", "voided": 0}],
        person_name_openmrs=[{"person_name_id": 1, "person_id": 11, "mspp_code": "11106", "given_name": "Jean",
                              "family_name": "Baptiste", "preferred": 1, "voided": 0}],
        person_address_openmrs=[{"person_address_id": 1, "person_id": 11, "mspp_code": "11106", "address1": "Anba Canal",
                                 "city_village": "Dessalines", "country": "Haiti", "preferred": 1, "voided": 0}],
        patient_identifier_openmrs=[
            {"patient_identifier_id": 1, "patient_id": 11, "mspp_code": "11106", "identifier": "ST00160",
             "identifier_type": 3, "preferred": 1, "voided": 0},
            {"patient_identifier_id": 2, "patient_id": 11, "mspp_code": "11106", "identifier": "local",
             "identifier_type": 6, "preferred": 1, "voided": 0}],
        person_attribute_openmrs=[{"person_attribute_id": 1, "person_id": 11, "mspp_code": "11106",
                                   "value": "+509 3000 0000", "person_attribute_type_id": 8, "voided": 0}],
        person_attribute_type=[{"person_attribute_type_id": 8, "mspp_code": "11106", "name": "Telephone Number"}],
        patient_isanteplus=[{"patient_id": 11, "mspp_code": "11106", "mother_name": "Therese Baptiste"}],
        **extra,
    )


def mapping(state, **extra):
    return [{"id": 1, "mspp_code": "11106", "patient_id": 11, "national_id": "HT-00001830", "statut": state,
             "created_at": at("2026-01-01"), "updated_at": at("2026-03-01"), **extra}]


def test_patient_with_national_id(tables):
    t = identity(tables, national_fingerprint_mapping=mapping("UNIQUE"))
    row, doc = documents(t, "patient")["fe5cae86-52a1-4713-b39d-4c05a9da3abf"]
    assert [i["value"] for i in doc["identifier"]] == ["ST00160", "HT-00001830", "11106-11"]
    assert doc["name"] == [{"use": "official", "text": "Jean Baptiste", "family": "Baptiste", "given": ["Jean"]}]
    assert doc["telecom"] == [{"system": "phone", "value": "+509 3000 0000", "use": "mobile"}]
    assert doc["extension"][0]["valueString"] == "Therese Baptiste"
    assert doc["contact"][0]["name"]["text"] == "Therese Baptiste"
    assert (doc["gender"], doc["birthDate"], doc["active"], doc["deceasedBoolean"]) == ("male", "1990-01-01", True, False)
    assert row["changed_at"] == at("2026-03-01")


def test_patient_under_review_has_no_national_id_but_is_sent_again(tables):
    row, doc = documents(identity(tables, national_fingerprint_mapping=mapping("A_REVOIR")), "patient").popitem()[1]
    assert [i["value"] for i in doc["identifier"]] == ["ST00160", "11106-11"]
    assert row["changed_at"] == at("2026-03-01")


def test_patient_with_null_members_kept(tables):
    _, doc = documents(identity(tables), "patient", REFERENCE).popitem()[1]
    assert doc["name"][0]["id"] is None
    assert "prefix" not in doc["name"][0]
    assert doc["address"][0]["state"] is None
    assert "district" not in doc["address"][0]
    lines = doc["address"][0]["extension"][0]["extension"]
    assert [e["valueString"] for e in lines] == ["Anba Canal", None, None]
    assert "id" in doc["identifier"][0]
    assert "id" not in doc["identifier"][-1]


def test_patient_without_children(tables):
    t = tables(
        patient_openmrs=[{"mspp_code": "1", "patient_id": 1}, {"mspp_code": "1", "patient_id": 2, "voided": 1}],
        person_openmrs=[
            {"mspp_code": "1", "person_id": 1, "uuid": "5", "birthdate": day("1980-05-01"), "birthdate_estimated": 1,
             "dead": 1, "death_date": at("2020-01-02 03:04:05"), "voided": 1},
            {"mspp_code": "1", "person_id": 2, "uuid": "6"},
        ],
    )
    docs = documents(t, "patient")
    assert list(docs) == ["id-5"]
    row, doc = docs["id-5"]
    assert row["changed_at"] == at("1970-01-01")
    assert doc["birthDate"] == "1980"
    assert doc["deceasedDateTime"] == "2020-01-02T03:04:05"
    assert "deceasedBoolean" not in doc
    assert doc["active"] is False
    assert [i["value"] for i in doc["identifier"]] == ["1-1"]
    _, kept = documents(t, "patient", REFERENCE)["id-5"]
    assert kept["name"] is None
    assert kept["address"] is None


@pytest.mark.parametrize("junk", ["00000000", "000", "N/A", " - ", "", None])
def test_junk_phone_is_dropped(tables, junk):
    t = identity(tables)
    rows = t["person_attribute_openmrs"].withColumn("value", F.lit(junk).cast("string"))
    swapped = Tables(lambda n: rows if n == "person_attribute_openmrs" else t[n], list(t))
    assert "telecom" not in documents(swapped, "patient").popitem()[1][1]


def test_encounter(clinic):
    row, doc = documents(clinic(), "encounter")["test-73106-encounter-openmrs-1014"]
    assert row["patient_fhir_id"] == "p-a"
    assert doc["location"][0]["location"] == {"reference": "Location/id-73106", "type": "Location", "display": "Clinic"}
    assert doc["partOf"] == {"reference": "Encounter/v-9", "type": "Encounter"}
    assert doc["type"] == [{"coding": [{"code": "et-5", "display": "Consult"}], "text": "Consult"}]
    assert [t["code"] for t in doc["meta"]["tag"]] == ["encounter", "11106"]
    assert doc["period"] == {"start": "2026-01-02T09:00:00"}


def test_encounter_without_links(clinic):
    _, doc = documents(clinic(visit_openmrs=[], locations=[], encounter_type=[]), "encounter").popitem()[1]
    assert not {"location", "partOf", "type"} & set(doc)


def test_visit(clinic):
    docs = documents(clinic(), "visit")
    assert docs["v-9"][1]["status"] == "in-progress"
    assert "end" not in docs["v-9"][1]["period"]
    assert docs["v-10"][1]["status"] == "finished"
    assert docs["v-10"][1]["period"]["end"] == "2026-02-01T00:00:00"


def test_observation_group(clinic):
    docs = documents(clinic(), "observation")
    assert sorted(docs) == ["o-10", "o-11", "o-12"]
    parent = docs["o-10"]
    assert [m["reference"] for m in parent[1]["hasMember"]] == ["Observation/o-11", "Observation/o-12"]
    assert parent[0]["changed_at"] == at("2026-02-01")
    assert docs["o-11"][1]["valueQuantity"] == {"value": 72.5, "comparator": ">"}
    assert docs["o-11"][1]["category"][0]["coding"][0]["code"] == "exam"
    assert docs["o-12"][1]["category"][0]["coding"][0]["code"] == "laboratory"
    assert docs["o-12"][1]["valueQuantity"] == {"value": 168.0}
    assert "encounter" not in docs["o-12"][1]


@pytest.mark.parametrize(
    ("value", "member", "expected"),
    [
        ({"value_numeric": 1.0, "value_coded": 88}, "valueQuantity", {"value": 1.0}),
        ({"value_coded": 88, "value_text": "x"}, "valueCodeableConcept",
         {"coding": [{"code": "88" + "A" * 34, "display": "Penicillin"}]}),
        ({"value_datetime": at("2026-01-01 01:02:03"), "value_drug": 4}, "valueDateTime", "2026-01-01T01:02:03"),
        ({"value_text": "x", "value_drug": 4}, "valueString", "x"),
        ({"value_drug": 4}, "valueCodeableConcept",
         {"coding": [{"system": "http://isanteplus.org/openmrs/drug", "code": "4"}]}),
    ],
)
def test_observation_value_priority(clinic, value, member, expected):
    row = {"mspp_code": "11106", "obs_id": 1, "person_id": 11, "concept_id": 5090, "uuid": "o-1", **value}
    for s in (Settings(), REFERENCE):
        _, doc = documents(clinic(obs_openmrs=[row]), "observation", s)["o-1"]
        assert doc[member] == expected
        assert [m for m in doc if m.startswith("value")] == [member]


def test_allergy(clinic):
    _, doc = documents(clinic(), "allergy_intolerance")["a-3"]
    assert doc["code"] == {"coding": [{"code": "88" + "A" * 34, "display": "Penicillin"}], "text": "Penicillin"}
    assert doc["category"] == ["medication"]
    assert doc["note"] == [{"text": "Patient reports rash"}]
    assert doc["reaction"] == [{"manifestation": [{"coding": [{"code": "512" + "A" * 33}], "text": "Anaphylaxis"}]}]
    assert doc["patient"] == {"reference": "Patient/p-c", "type": "Patient"}


def test_condition(clinic):
    row, doc = documents(clinic(), "condition").popitem()[1]
    assert doc["code"] == {"coding": [{"code": "6" + "A" * 35}]}
    assert row["patient_fhir_id"] == "p-a"
    assert "encounter" not in doc
    assert doc["recordedDate"] == "2026-01-02T09:00:00"


def test_medication_request(clinic):
    _, doc = documents(clinic(), "medication_request")["medreq-058f3c800a7a533a5d278ff278903082"]
    assert doc["encounter"] == {"reference": "Encounter/test-73106-encounter-openmrs-1014"}
    bounds = doc["dosageInstruction"][0]["timing"]["repeat"]["boundsDuration"]
    assert bounds == {"value": 30.0, "unit": "d", "system": "http://unitsofmeasure.org", "code": "d"}


def test_location(clinic):
    t = clinic(locations=[{"location_id": 1, "value_reference": "73106", "name": "L", "active": 0}, {"location_id": 2}])
    docs = documents(t, "location")
    assert list(docs) == ["id-73106"]
    assert docs["id-73106"][1] == {"resourceType": "Location", "id": "id-73106", "name": "L", "status": "inactive"}


@pytest.mark.parametrize("nulls", ["omit", "reference"])
def test_pages_hold_every_child(tables, nulls):
    """A group above the limit goes on in further resources; together they hold what one resource would."""
    n = 25
    obs = [{"mspp_code": "1", "obs_id": 1, "person_id": 1, "concept_id": 1, "uuid": "parent"}]
    obs += [{"mspp_code": "1", "obs_id": 100 + i, "person_id": 1, "concept_id": 1, "obs_group_id": 1, "uuid": f"c-{i}"}
            for i in range(n)]
    names = [{"mspp_code": "1", "person_name_id": i, "person_id": 1, "given_name": f"G{i}", "uuid": f"n-{i}"}
             for i in range(n)]
    t = tables(
        obs_openmrs=obs,
        person_openmrs=[{"mspp_code": "1", "person_id": 1, "uuid": "p"}],
        patient_openmrs=[{"mspp_code": "1", "patient_id": 1}],
        person_name_openmrs=names,
    )
    s = Settings(max_children=4, nulls=nulls)
    docs = {k: d for k, (_, d) in documents(t, "observation", s).items()}
    pages = [k for k in docs if k == "parent" or k.startswith("parent-more-")]
    assert len(pages) > 2
    listed = [m["reference"].split("/")[1] for k in pages for m in docs[k]["hasMember"]]
    assert sorted(x for x in listed if x.startswith("c-")) == sorted(f"c-{i}" for i in range(n))
    leads = {m["reference"].split("/")[1] for m in docs["parent"]["hasMember"]} - {f"c-{i}" for i in range(n)}
    assert set(pages) - {"parent"} <= leads
    people = {k: d for k, (_, d) in documents(t, "patient", s).items()}
    assert sorted(x["id"] for d in people.values() for x in d.get("name") or []) == sorted(f"n-{i}" for i in range(n))
    assert {link["other"]["reference"] for link in people["p"]["link"]} >= {f"Patient/{k}" for k in people if k != "p"}
    whole = documents(t, "observation", Settings(max_children=None, nulls=nulls))
    assert len(whole["parent"][1]["hasMember"]) == n
    assert len(whole) == n + 1


def test_null_modes_agree_once_nulls_are_dropped(clinic):
    def strip(x):
        if isinstance(x, dict):
            return {k: v for k, v in ((k, strip(v)) for k, v in x.items()) if v not in (None, {}, [])}
        return [strip(v) for v in x] if isinstance(x, list) else x

    t = clinic()
    for name in MODELS:
        plain, kept = documents(t, name), documents(t, name, REFERENCE)
        assert plain.keys() == kept.keys()
        for k in plain:
            if name not in ("patient", "location"):
                assert strip(plain[k][1]) == strip(kept[k][1])


def test_one_row_per_id(spark):
    rows = [("1", 1, "x", at("2026-01-01"), "a"), ("2", 1, "x", at("2026-02-01"), "b"), ("0", 1, "x", at("2026-02-01"), "c"),
            ("1", 2, "y", None, "d")]
    df = spark.createDataFrame(rows, "mspp_code string, patient_id bigint, fhir_id string, changed_at timestamp_ntz, resource string")
    kept = {r["fhir_id"]: r["resource"] for r in one_per_key(df, ["mspp_code", "patient_id"]).collect()}
    assert kept == {"x": "c", "y": "d"}


def test_audits_are_clean_on_good_tables(clinic):
    t = clinic()
    views = {name: to_table(m.build(t, Settings())) for name, m in MODELS.items()}
    assert {k: v.count() for k, v in audits(views, Settings()).items() if not v.isEmpty()} == {}
