"""patient_diagnosis -> Condition. The id is a digest of the natural key (M3)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinweave.functions.columns import concept_code, fhir_datetime, latest_of, not_voided, site_meta, synthetic_id
from clinweave.functions.document import arr, obj, render
from clinweave.operators.joins import lookup, with_person
from clinweave.operators.terminology import concept_labels, labels_as
from clinweave.plans.models.parts import codeable, person_ids, subject
from clinweave.settings import Settings

# Code systems of a Condition, and the parts of its id in order.
CLINICAL_SYSTEM = "http://terminology.hl7.org/CodeSystem/condition-clinical"
VERIFICATION_SYSTEM = "http://terminology.hl7.org/CodeSystem/condition-ver-status"
CATEGORY_SYSTEM = "http://terminology.hl7.org/CodeSystem/condition-category"
ID_PARTS = (
    "mspp_code",
    "encounter_id",
    "location_id",
    "concept_group",
    "concept_id",
    "answer_concept_id",
    "encounter_date",
)


def build_condition(t: Mapping[str, DataFrame], s: Settings) -> DataFrame:
    fact = t["patient_diagnosis"].filter(not_voided())
    fact = with_person(fact, person_ids(t), "patient_id")
    fact = fact.withColumn("fhir_id", synthetic_id("cond-", *ID_PARTS))
    # The answer decides, else the question.
    fact = fact.withColumn("coded_id", F.coalesce("answer_concept_id", "concept_id"))
    fact = lookup(fact, labels_as(concept_labels(t, s), "d", "uuid", "name"), {"coded_id": "d_concept"}, ["fhir_id"])
    document = obj(
        {
            "resourceType": "Condition",
            "id": F.col("fhir_id"),
            "meta": site_meta("mspp_code", s),
            "clinicalStatus": codeable(CLINICAL_SYSTEM, "active", "Active", "Active"),
            "verificationStatus": codeable(VERIFICATION_SYSTEM, "confirmed", "Confirmed", "Confirmed"),
            "category": arr(codeable(CATEGORY_SYSTEM, "encounter-diagnosis", "Encounter Diagnosis")),
            "code": obj(
                {
                    "coding": arr(obj({"code": concept_code("d_uuid", "coded_id"), "display": F.col("d_name")})),
                    "text": F.col("d_name"),
                }
            ),
            "subject": subject(),
            "recordedDate": fhir_datetime("encounter_date"),
        }
    )
    return fact.select(
        "mspp_code",
        "patient_id",
        "fhir_id",
        "patient_fhir_id",
        latest_of("date_updated", "last_updated_date").alias("changed_at"),
        render(document, s.nulls).alias("resource"),
    )
