"""patient_prescription -> MedicationRequest. The id is a digest of the natural key (M3)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinweave.functions.columns import fhir_datetime, latest_of, not_voided, site_meta, synthetic_id
from clinweave.functions.document import arr, obj, render
from clinweave.operators.joins import with_person
from clinweave.plans.models.parts import codeable, encounter_member, person_ids, subject, with_encounter_id
from clinweave.settings import Settings

# The unit of a supply, and the parts of the id in order.
UNITS = "http://unitsofmeasure.org"
ID_PARTS = ("mspp_code", "encounter_id", "location_id", "drug_id")


def build_medication_request(t: Mapping[str, DataFrame], s: Settings) -> DataFrame:
    fact = t["patient_prescription"].filter(not_voided())
    fact = with_person(fact, person_ids(t), "patient_id")
    fact = fact.withColumn("fhir_id", synthetic_id("medreq-", *ID_PARTS))
    fact = with_encounter_id(fact, t, ["fhir_id"])
    # A date stands for its midnight.
    written = F.coalesce("visit_date", F.col("dispensation_date").cast("timestamp_ntz"))
    bounds = obj({"value": F.col("number_day"), "unit": "d", "system": UNITS, "code": "d"})
    document = obj(
        {
            "resourceType": "MedicationRequest",
            "id": F.col("fhir_id"),
            "meta": site_meta("mspp_code", s),
            "status": "active",
            "intent": "order",
            "priority": "routine",
            "subject": subject(),
            "authoredOn": fhir_datetime(written),
            "medicationCodeableConcept": codeable(s.drug_system, F.col("drug_id").cast("string")),
            "dosageInstruction": arr(
                obj({"text": F.col("posology"), "timing": obj({"repeat": obj({"boundsDuration": bounds})})})
            ),
            "encounter": encounter_member(),
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
