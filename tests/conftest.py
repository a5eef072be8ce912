from __future__ import annotations

import sys
import tempfile
from datetime import date, datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from clinweave import session
from clinweave.sources.contracts import CONTRACTS, conform
from clinweave.sources.snapshots import Store
from clinweave.sources.tables import Tables, load_seed


@pytest.fixture(scope="session")
def spark():
    spark = session("local[4]", "tests", spark__sql__shuffle__partitions="4", spark__driver__memory="4g")
    yield spark
    spark.stop()


@pytest.fixture
def store(spark):
    return Store(spark, tempfile.mkdtemp(prefix="run-"), compact_after=4)


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


def day(text: str) -> date:
    return date.fromisoformat(text)


def make_tables(spark, **rows: list[dict]) -> Tables:
    """Contract tables from dicts; missing columns are null, missing tables empty."""

    def load(name: str):
        if name == "identifier_systems":
            return load_seed(spark)
        schema = CONTRACTS[name].schema
        data = [tuple(r.get(c) for c in schema.fieldNames()) for r in rows.get(name, [])]
        return conform(spark.createDataFrame(data, schema), name)

    return Tables(load, [*CONTRACTS, "identifier_systems"])


@pytest.fixture
def tables(spark):
    return lambda **rows: make_tables(spark, **rows)


@pytest.fixture
def clinic(tables):
    """Two sites, three patients, with something of every resource type."""
    jan, feb = at("2026-01-02 09:00:00"), at("2026-02-01 00:00:00")
    return lambda **extra: tables(
        **{
            "patient_openmrs": [
                {"mspp_code": "11106", "patient_id": 11, "voided": 0, "date_created": jan},
                {"mspp_code": "11106", "patient_id": 12, "voided": 1, "date_created": jan},
                {"mspp_code": "11202", "patient_id": 11, "voided": 0, "date_created": jan},
            ],
            "person_openmrs": [
                {"mspp_code": "11106", "person_id": 11, "uuid": "p-a", "gender": "M", "birthdate": day("1990-01-01")},
                {"mspp_code": "11106", "person_id": 12, "uuid": "p-b", "gender": "F"},
                {"mspp_code": "11202", "person_id": 11, "uuid": "p-c", "gender": "x", "voided": 1, "dead": 1},
            ],
            "visit_openmrs": [
                {"mspp_code": "11106", "visit_id": 9, "patient_id": 11, "date_started": jan, "uuid": "v-9",
                 "date_created": jan},
                {"mspp_code": "11106", "visit_id": 10, "patient_id": 12, "date_started": jan, "date_stopped": feb,
                 "uuid": "v-10", "date_created": jan},
            ],
            "encounter_openmrs": [
                {"mspp_code": "11106", "encounter_id": 1, "encounter_type": 5, "patient_id": 11, "location_id": 7,
                 "visit_id": 9, "encounter_datetime": jan, "uuid": "test-73106-encounter_openmrs-1014",
                 "date_created": jan},
            ],
            "encounter_type": [{"mspp_code": "11106", "encounter_type_id": 5, "uuid": "et-5", "name": "Consult"}],
            "locations": [{"location_id": 7, "value_reference": "73106", "name": "Clinic"}],
            "allergy_openmrs": [
                {"mspp_code": "11202", "allergy_id": 3, "patient_id": 11, "coded_allergen": 88, "allergen_type": "DRUG",
                 "comment": "Patient reports rash", "uuid": "a-3", "date_created": jan},
            ],
            "allergy_reaction_openmrs": [
                {"mspp_code": "11202", "allergy_reaction_id": 1, "allergy_id": 3, "reaction_concept_id": 512,
                 "reaction_non_coded": "Anaphylaxis"},
            ],
            "concept_name": [
                {"concept_name_id": 1, "concept_id": 88, "name": "Penicillin", "locale": "en", "locale_preferred": 1},
                {"concept_name_id": 2, "concept_id": 88, "name": "Pénicilline", "locale": "fr", "locale_preferred": 1},
            ],
            "obs_openmrs": [
                {"mspp_code": "11106", "obs_id": 10, "person_id": 11, "concept_id": 5085, "encounter_id": 1,
                 "obs_datetime": jan, "uuid": "o-10", "date_created": jan},
                {"mspp_code": "11106", "obs_id": 11, "person_id": 11, "concept_id": 5089, "encounter_id": 1,
                 "obs_datetime": jan, "value_numeric": 72.5, "value_modifier": ">", "obs_group_id": 10, "uuid": "o-11",
                 "date_created": feb},
                {"mspp_code": "11106", "obs_id": 12, "person_id": 11, "concept_id": 5090, "obs_datetime": jan,
                 "value_numeric": 168.0, "obs_group_id": 10, "uuid": "o-12", "date_created": jan},
                {"mspp_code": "11106", "obs_id": 13, "person_id": 11, "concept_id": 5090, "obs_datetime": jan,
                 "obs_group_id": 10, "uuid": "o-13", "voided": 1, "date_created": jan},
            ],
            "concept": [
                {"concept_id": 5085, "uuid": "c-5085", "class_id": 10},
                {"concept_id": 5089, "uuid": "c-5089", "class_id": 5},
                {"concept_id": 5090, "uuid": "c-5090", "class_id": 1},
            ],
            "patient_diagnosis": [
                {"mspp_code": "11106", "patient_id": 11, "encounter_id": 1, "location_id": 7, "concept_group": 0,
                 "concept_id": 5, "answer_concept_id": 6, "encounter_date": jan, "voided": 0},
            ],
            "patient_prescription": [
                {"mspp_code": "11106", "patient_id": 11, "encounter_id": 1, "location_id": 1, "drug_id": 1234,
                 "visit_date": jan, "posology": "1 tab BID", "number_day": 30.0, "voided": 0},
            ],
            **extra,
        }
    )
