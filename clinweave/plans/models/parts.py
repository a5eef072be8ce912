"""Pieces several models share."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinweave.functions.columns import fhir_id, optional, reference
from clinweave.functions.document import Arr, Obj, Opt, arr, obj
from clinweave.operators.joins import lookup

# FHIR and OpenMRS URIs used by more than one model.
ADDRESS_EXT = "http://fhir.openmrs.org/ext/address"
ENCOUNTER_TAG = "http://fhir.openmrs.org/ext/encounter-tag"
ACT_CODE = "http://terminology.hl7.org/CodeSystem/v3-ActCode"


def person_ids(t: Mapping[str, DataFrame]) -> DataFrame:
    """The side of J1 the clinical models need: the patient's resource id."""
    return t["person_openmrs"].select("mspp_code", "person_id", fhir_id("uuid").alias("patient_fhir_id"))


def with_location(fact: DataFrame, t: Mapping[str, DataFrame], spread: list[str]) -> DataFrame:
    """Adds place_id (sanitised) and place_name; locations have no site."""
    place = t["locations"].select(
        F.col("location_id").alias("_place"),
        fhir_id("value_reference").alias("place_id"),
        F.col("name").alias("place_name"),
    )
    return lookup(fact, place, {"location_id": "_place"}, spread)


def with_encounter_id(fact: DataFrame, t: Mapping[str, DataFrame], spread: list[str]) -> DataFrame:
    """Adds encounter_fhir_id of the encounter at the same site, voided or not."""
    enc = t["encounter_openmrs"].select(
        F.col("mspp_code").alias("_esite"), F.col("encounter_id").alias("_enc"), fhir_id("uuid").alias("encounter_fhir_id")
    )
    return lookup(fact, enc, {"mspp_code": "_esite", "encounter_id": "_enc"}, spread)


def location_member() -> Opt:
    place = reference("Location", "place_id", typed=True, display=F.col("place_name"))
    return optional(F.col("place_id").isNotNull(), arr(obj({"location": place})))


def encounter_member() -> Opt:
    return optional(F.col("encounter_fhir_id").isNotNull(), reference("Encounter", "encounter_fhir_id"))


def subject() -> Obj:
    return reference("Patient", "patient_fhir_id", typed=True)


def codeable(system: str, code: str | Column, display: str | None = None, text: str | None = None) -> Obj:
    coding: dict = {"system": system, "code": code}
    if display is not None:
        coding["display"] = display
    concept: dict = {"coding": arr(obj(coding))}
    if text is not None:
        concept["text"] = text
    return obj(concept)


def address_extension(**lines: Column) -> Arr:
    """ext/address with one nested extension per line."""
    parts = [
        obj({"url": f"{ADDRESS_EXT}#{name}", "valueString": value}, needs="valueString")
        for name, value in lines.items()
    ]
    return arr(obj({"url": ADDRESS_EXT, "extension": arr(*parts)}, needs="extension"))
