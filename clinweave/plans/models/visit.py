"""visit_openmrs -> Encounter with the tag `visit`."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinweave.functions.columns import fhir_datetime, fhir_id, latest_of, not_voided, optional, site_meta
from clinweave.functions.document import obj, render
from clinweave.operators.joins import with_person
from clinweave.plans.models.parts import ACT_CODE, ENCOUNTER_TAG, location_member, person_ids, subject, with_location
from clinweave.settings import Settings


def build_visit(t: Mapping[str, DataFrame], s: Settings) -> DataFrame:
    fact = t["visit_openmrs"].filter(not_voided())
    fact = with_person(fact, person_ids(t), "patient_id").withColumn("fhir_id", fhir_id("uuid"))
    fact = with_location(fact, t, ["mspp_code", "visit_id"])
    stopped = F.col("date_stopped").isNotNull()
    document = obj(
        {
            "resourceType": "Encounter",
            "id": F.col("fhir_id"),
            "meta": site_meta("mspp_code", s, obj({"system": ENCOUNTER_TAG, "code": "visit", "display": "Visit"})),
            "status": F.when(stopped, "finished").otherwise("in-progress"),
            "class": obj({"system": ACT_CODE, "code": "AMB"}),
            "subject": subject(),
            "period": obj(
                {"start": fhir_datetime("date_started"), "end": optional(stopped, fhir_datetime("date_stopped"))}
            ),
            "location": location_member(),
        }
    )
    return fact.select(
        "mspp_code",
        "visit_id",
        "fhir_id",
        "patient_fhir_id",
        latest_of("date_updated", "date_changed", "date_created").alias("changed_at"),
        render(document, s.nulls).alias("resource"),
    )
