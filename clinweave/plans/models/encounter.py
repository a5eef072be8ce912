"""R2: encounter_openmrs -> Encounter, linked up to its visit by partOf."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinweave.functions.columns import fhir_datetime, fhir_id, latest_of, not_voided, optional, reference, site_meta
from clinweave.functions.document import arr, obj, render
from clinweave.operators.joins import lookup, with_person
from clinweave.plans.models.parts import ACT_CODE, ENCOUNTER_TAG, location_member, person_ids, subject, with_location
from clinweave.settings import Settings


def build_encounter(t: Mapping[str, DataFrame], s: Settings) -> DataFrame:
    fact = t["encounter_openmrs"].filter(not_voided())
    fact = with_person(fact, person_ids(t), "patient_id").withColumn("fhir_id", fhir_id("uuid"))
    kinds = t["encounter_type"].select(
        F.col("mspp_code").alias("_tsite"),
        F.col("encounter_type_id").alias("_type"),
        F.col("uuid").alias("type_code"),
        F.col("name").alias("type_name"),
    )
    visits = t["visit_openmrs"].select(
        F.col("mspp_code").alias("_vsite"), F.col("visit_id").alias("_visit"), fhir_id("uuid").alias("visit_fhir_id")
    )
    rows = ["mspp_code", "encounter_id"]
    fact = lookup(fact, kinds, {"mspp_code": "_tsite", "encounter_type": "_type"}, rows)
    fact = with_location(fact, t, rows)
    fact = lookup(fact, visits, {"mspp_code": "_vsite", "visit_id": "_visit"}, rows)
    kind = obj(
        {
            "coding": arr(obj({"code": F.col("type_code"), "display": F.col("type_name")})),
            "text": F.col("type_name"),
        }
    )
    document = obj(
        {
            "resourceType": "Encounter",
            "id": F.col("fhir_id"),
            "meta": site_meta(
                "mspp_code", s, obj({"system": ENCOUNTER_TAG, "code": "encounter", "display": "Encounter"})
            ),
            "status": "finished",
            "class": obj({"system": ACT_CODE, "code": "AMB"}),
            "subject": subject(),
            "period": obj({"start": fhir_datetime("encounter_datetime")}),
            "type": optional(F.col("type_code").isNotNull(), arr(kind)),
            "location": location_member(),
            "partOf": optional(F.col("visit_fhir_id").isNotNull(), reference("Encounter", "visit_fhir_id", typed=True)),
        }
    )
    return fact.select(
        "mspp_code",
        "encounter_id",
        "fhir_id",
        "patient_fhir_id",
        latest_of("date_updated", "date_created").alias("changed_at"),
        render(document, s.nulls).alias("resource"),
    )
