"""allergy_openmrs -> AllergyIntolerance with its reactions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinweave.functions.columns import (
    concept_code,
    fhir_datetime,
    fhir_id,
    latest_of,
    not_voided,
    optional,
    reference,
    site_meta,
)
from clinweave.functions.document import Rendered, arr, obj, render
from clinweave.operators.children import collect_children, paged_id
from clinweave.operators.joins import lookup, with_person
from clinweave.operators.terminology import concept_labels, labels_as
from clinweave.plans.models.parts import codeable, person_ids
from clinweave.settings import Settings

# Code systems and the category of each allergen type.
CLINICAL_SYSTEM = "http://terminology.hl7.org/CodeSystem/allergyintolerance-clinical"
VERIFICATION_SYSTEM = "http://terminology.hl7.org/CodeSystem/allergyintolerance-verification"
CATEGORIES = {"DRUG": "medication", "FOOD": "food", "ENVIRONMENT": "environment"}
OTHER_CATEGORY = "medication"


def reactions(t: Mapping[str, DataFrame], s: Settings) -> DataFrame:
    """Reactions per allergy: site, allergy, page, pages, arr, chg."""
    concepts = t["concept"].select(F.col("concept_id").alias("_rc"), F.col("uuid").alias("r_uuid"))
    rows = t["allergy_reaction_openmrs"].drop("uuid")
    rows = lookup(rows, concepts, {"reaction_concept_id": "_rc"}, ["mspp_code", "allergy_reaction_id"])
    what = obj(
        {
            "coding": arr(obj({"code": concept_code("r_uuid", "reaction_concept_id")})),
            "text": F.col("reaction_non_coded"),
        }
    )
    return collect_children(
        rows,
        ["mspp_code", "allergy_id"],
        render(obj({"manifestation": arr(what)}), s.nulls),
        [F.col("allergy_reaction_id")],
        latest_of("date_updated"),
        s.max_children,
    )


def category(s: Settings) -> Column:
    kind = F.col("allergen_type") if s.case_sensitive_codes else F.upper("allergen_type")
    out = F.lit(OTHER_CATEGORY)
    for name, value in CATEGORIES.items():
        out = F.when(kind == name, value).otherwise(out)
    return out


def build_allergy(t: Mapping[str, DataFrame], s: Settings) -> DataFrame:
    fact = t["allergy_openmrs"].filter(not_voided())
    fact = with_person(fact, person_ids(t), "patient_id").withColumn("fhir_id", fhir_id("uuid"))
    rows = ["mspp_code", "allergy_id"]
    fact = lookup(fact, labels_as(concept_labels(t, s), "c", "uuid", "name"), {"coded_allergen": "c_concept"}, rows)
    child = reactions(t, s).select(
        F.col("mspp_code").alias("_rsite"),
        F.col("allergy_id").alias("_allergy"),
        F.col("page").alias("reaction_page"),
        F.col("arr").alias("reaction_arr"),
        F.col("chg").alias("reaction_chg"),
    )
    fact = lookup(fact, child, {"mspp_code": "_rsite", "allergy_id": "_allergy"})
    if s.max_children is not None:
        fact = fact.withColumn("fhir_id", paged_id(F.col("fhir_id"), F.coalesce("reaction_page", F.lit(0))))
    coded = F.col("coded_allergen").isNotNull()
    named = F.col("non_coded_allergen")
    document = obj(
        {
            "resourceType": "AllergyIntolerance",
            "id": F.col("fhir_id"),
            "meta": site_meta("mspp_code", s),
            "type": "allergy",
            "clinicalStatus": codeable(CLINICAL_SYSTEM, "active", "Active", "Active"),
            "verificationStatus": codeable(VERIFICATION_SYSTEM, "confirmed", "Confirmed", "Confirmed"),
            "category": arr(category(s)),
            "patient": reference("Patient", "patient_fhir_id", typed=True),
            "recordedDate": fhir_datetime("date_created"),
            "code": obj(
                {
                    "coding": optional(
                        coded, arr(obj({"code": concept_code("c_uuid", "coded_allergen"), "display": F.col("c_name")}))
                    ),
                    "text": F.when(coded, F.coalesce(F.col("c_name"), named)).otherwise(named),
                }
            ),
            "reaction": optional(F.col("reaction_arr").isNotNull(), Rendered(F.col("reaction_arr"))),
            "note": optional(F.col("comment").isNotNull(), arr(obj({"text": F.col("comment")}))),
        }
    )
    return fact.select(
        "mspp_code",
        "allergy_id",
        "fhir_id",
        "patient_fhir_id",
        F.greatest(latest_of("date_updated", "date_created"), latest_of("reaction_chg")).alias("changed_at"),
        render(document, s.nulls).alias("resource"),
    )
