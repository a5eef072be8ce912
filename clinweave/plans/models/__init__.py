"""Resource models by view name (R1-R8). Each takes (tables, settings) and returns scalars + `resource`."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from clinweave.functions.document import as_json
from clinweave.plans.models.allergy import build_allergy
from clinweave.plans.models.condition import build_condition
from clinweave.plans.models.encounter import build_encounter
from clinweave.plans.models.location import build_location
from clinweave.plans.models.medication import build_medication_request
from clinweave.plans.models.observation import build_observation
from clinweave.plans.models.patient import build_patient
from clinweave.plans.models.visit import build_visit
from clinweave.settings import Settings


@dataclass(frozen=True)
class Model:
    build: Callable[[Mapping[str, DataFrame], Settings], DataFrame]
    kind: str
    grain: tuple[str, ...]
    not_null: tuple[str, ...]


MODELS = {
    "location": Model(build_location, "full", ("fhir_id",), ("fhir_id",)),
    "patient": Model(build_patient, "key", ("mspp_code", "patient_id"), ("mspp_code", "patient_id", "fhir_id")),
    "encounter": Model(
        build_encounter, "key", ("mspp_code", "encounter_id"), ("mspp_code", "encounter_id", "fhir_id")
    ),
    "visit": Model(build_visit, "key", ("mspp_code", "visit_id"), ("mspp_code", "visit_id", "fhir_id")),
    "observation": Model(build_observation, "key", ("mspp_code", "obs_id"), ()),
    "condition": Model(build_condition, "key", ("fhir_id",), ("mspp_code", "fhir_id")),
    "allergy_intolerance": Model(
        build_allergy, "key", ("mspp_code", "allergy_id"), ("mspp_code", "allergy_id", "fhir_id")
    ),
    "medication_request": Model(build_medication_request, "key", ("fhir_id",), ("mspp_code", "fhir_id")),
}


def to_table(df: DataFrame) -> DataFrame:
    """K5: the model with its document as JSON text, as it is stored and sent."""
    is_text = isinstance(df.schema["resource"].dataType, T.StringType)
    return df.withColumn("resource", as_json("resource", is_text))


__all__ = ["MODELS", "Model", "to_table"]
