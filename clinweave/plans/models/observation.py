"""obs_openmrs -> Observation; a group parent lists its children in hasMember."""

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
from clinweave.functions.document import Opt, Rendered, arr, obj, render
from clinweave.operators.children import collect_children, paged_id
from clinweave.operators.joins import lookup, with_person
from clinweave.operators.terminology import concept_labels, labels_as
from clinweave.plans.models.parts import codeable, encounter_member, person_ids, subject, with_encounter_id
from clinweave.settings import Settings

# Concept classes with a category of their own; any other class is a survey answer.
CATEGORY_SYSTEM = "http://terminology.hl7.org/CodeSystem/observation-category"
CATEGORY_CLASSES = {"laboratory": (1, 8), "procedure": (2,), "exam": (5, 12, 13)}
OTHER_CATEGORY = "survey"


def members(t: Mapping[str, DataFrame], s: Settings) -> DataFrame:
    """Live children per group parent: site, parent, page, pages, arr, chg."""
    child = t["obs_openmrs"].filter(F.col("obs_group_id").isNotNull() & not_voided())
    link = reference("Observation", fhir_id("uuid"), typed=True)
    return collect_children(
        child,
        ["mspp_code", "obs_group_id"],
        render(link, s.nulls),
        [F.col("obs_id")],
        latest_of("date_updated", "date_changed", "date_created"),
        s.max_children,
    )


def category() -> Column:
    code = F.lit(OTHER_CATEGORY)
    for name, classes in CATEGORY_CLASSES.items():
        code = F.when(F.col("q_class_id").isin(*classes), name).otherwise(code)
    return code


def value_members(s: Settings) -> dict[str, Opt]:
    """value[x]: the first that is set of number, code, date-time, text, drug."""
    names = ["value_numeric", "value_coded", "value_datetime", "value_text", "value_drug"]
    earlier = F.lit(True)
    chosen = {}
    for name in names:
        chosen[name] = earlier & F.col(name).isNotNull()
        earlier = earlier & F.col(name).isNull()
    coded, drug = chosen["value_coded"], chosen["value_drug"]
    coding = obj(
        {
            "system": optional(drug, F.lit(s.drug_system)),
            "code": F.when(coded, concept_code("a_uuid", "value_coded")).otherwise(F.col("value_drug").cast("string")),
            "display": optional(coded, F.col("a_name")),
        }
    )
    quantity = obj({"value": F.col("value_numeric"), "comparator": Opt(F.col("value_modifier"))})
    return {
        "valueQuantity": optional(chosen["value_numeric"], quantity),
        "valueCodeableConcept": optional(coded | drug, obj({"coding": arr(coding)})),
        "valueDateTime": optional(chosen["value_datetime"], fhir_datetime("value_datetime")),
        "valueString": optional(chosen["value_text"], F.col("value_text")),
    }


def _all_members(s: Settings) -> Column:
    """The page's members; the first page also points to the further pages of an oversized group."""
    if s.max_children is None:
        return F.col("member_arr")
    link = lambda n: render(
        reference("Observation", paged_id(F.col("fhir_id"), n), typed=True), s.nulls
    )
    more = F.transform(F.sequence(F.lit(1), F.col("member_pages") - 1), link)
    leads = (F.col("member_page") == 0) & (F.col("member_pages") > 1)
    return F.when(leads, F.concat("member_arr", more)).otherwise(F.col("member_arr"))


def build_observation(t: Mapping[str, DataFrame], s: Settings) -> DataFrame:
    fact = t["obs_openmrs"].filter(not_voided())
    fact = with_person(fact, person_ids(t), "person_id").withColumn("fhir_id", fhir_id("uuid"))
    rows = ["mspp_code", "obs_id"]
    child = members(t, s).select(
        F.col("mspp_code").alias("_msite"),
        F.col("obs_group_id").alias("_parent"),
        F.col("page").alias("member_page"),
        F.col("pages").alias("member_pages"),
        F.col("arr").alias("member_arr"),
        F.col("chg").alias("member_chg"),
    )
    # Every join moves what the ones before it added: wide labels come last, and what tells when a row changed comes first,
    # so that it is told without the others.
    fact = lookup(fact, child, {"mspp_code": "_msite", "obs_id": "_parent"})
    fact = with_encounter_id(fact, t, rows)
    labels = concept_labels(t, s)
    fact = lookup(fact, labels_as(labels, "a", "uuid", "name"), {"value_coded": "a_concept"}, rows)
    fact = lookup(fact, labels_as(labels, "q", "uuid", "class_id", "name"), {"concept_id": "q_concept"}, rows)
    fact = fact.withColumn("member_all", _all_members(s))
    if s.max_children is not None:
        fact = fact.withColumn("fhir_id", paged_id(F.col("fhir_id"), F.coalesce("member_page", F.lit(0))))
    document = obj(
        {
            "resourceType": "Observation",
            "id": F.col("fhir_id"),
            "meta": site_meta("mspp_code", s),
            "status": "final",
            "category": arr(codeable(CATEGORY_SYSTEM, category())),
            "code": obj(
                {
                    "coding": arr(obj({"code": concept_code("q_uuid", "concept_id"), "display": F.col("q_name")})),
                    "text": F.col("q_name"),
                }
            ),
            "subject": subject(),
            "effectiveDateTime": fhir_datetime("obs_datetime"),
            "issued": fhir_datetime("date_created"),
            **value_members(s),
            "encounter": encounter_member(),
            "hasMember": optional(F.col("member_all").isNotNull(), Rendered(F.col("member_all"))),
        }
    )
    return fact.select(
        "mspp_code",
        "obs_id",
        "fhir_id",
        "patient_fhir_id",
        F.greatest(latest_of("date_updated", "date_created"), latest_of("member_chg")).alias("changed_at"),
        render(document, s.nulls).alias("resource"),
    )
