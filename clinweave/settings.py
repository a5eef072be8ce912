"""Named settings with defaults (M2, P8, DL10)."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

# Code-system URIs, labels and codes that appear in the output documents.
NATIONAL_ID_SYSTEM = "http://isanteplus.org/openmrs/fhir2/6-biometrics-national-reference-code"
SOURCE_KEY_SYSTEM = "http://sedish-haiti.org/fhir/source-key"
SITE_SYSTEM = "http://sedish-haiti.org/fhir/mspp-site"
DRUG_SYSTEM = "http://isanteplus.org/openmrs/drug"
SOURCE_TAG_SYSTEM = "http://sedish-haiti.org/fhir/source"
SOURCE_TAG_CODE = "consolidated-pipeline"
PHONE_ATTRIBUTE_NAME = "Telephone Number"
NATIONAL_ID_LABEL = "National FP ID"
SOURCE_KEY_LABEL = "SEDISH Source Key"
CLINICAL_VIEWS = (
    "encounter",
    "visit",
    "observation",
    "allergy_intolerance",
    "condition",
    "medication_request",
)
GLOBAL_VIEWS = ("location",)

# Resource type of each view.
VIEW_KINDS = {
    "patient": "Patient",
    "location": "Location",
    "encounter": "Encounter",
    "visit": "Encounter",
    "observation": "Observation",
    "allergy_intolerance": "AllergyIntolerance",
    "condition": "Condition",
    "medication_request": "MedicationRequest",
}

EPOCH = datetime(1970, 1, 1)


@dataclass(frozen=True)
class Settings:
    national_id_system: str = NATIONAL_ID_SYSTEM
    source_key_system: str = SOURCE_KEY_SYSTEM
    mspp_site_system: str = SITE_SYSTEM
    drug_system: str = DRUG_SYSTEM
    phone_attribute_name: str = PHONE_ATTRIBUTE_NAME
    source_tag_system: str = SOURCE_TAG_SYSTEM
    source_tag_code: str = SOURCE_TAG_CODE
    clinical_views: tuple[str, ...] = CLINICAL_VIEWS
    global_views: tuple[str, ...] = GLOBAL_VIEWS

    # "omit" leaves null members out (valid FHIR); "reference" keeps them where the source model does.
    nulls: str = "omit"
    # Byte-exact comparison of small code sets (gender, locale, allergen type, status, attribute name).
    case_sensitive_codes: bool = False

    # Patients per identity bundle.
    identity_page: int = 100
    # Clinical entries per bundle, for receivers that limit them: a patient with more is then sent in several bundles,
    # patient first in each. None: one bundle per patient and one for the shared resources, whatever their size.
    bundle_entries: int | None = None
    # Elements in one child array, for stores that limit them: a larger group then continues in further resources
    # linked to the first. None: one resource per parent, whatever its size.
    max_children: int | None = None

    # Read a mirror of the source (True) or the source itself on every cycle (False).
    use_mirror: bool = True
    # Refuse a mirror run that would delete more than this share of a table; None means no guard.
    max_delete_fraction: float | None = None
    # "snapshot" drops rows a model no longer yields; "upsert" only inserts and updates.
    materialize_mode: str = "snapshot"
    # Build again only the resources of patients whose rows a sync changed, where that can be told. Needs the mirror and
    # resource tables kept as snapshots.
    incremental: bool = False
    # Also treat a changed document as pending when changed_at has not moved.
    use_content_hash: bool = False

    # Tables or models worked on at the same time.
    parallel: int = 4

    # Delivery.
    send_retries: int = 3
    dry_run: bool = False

    # Retraction: seconds between runs, 0 = off.
    retract_every: int = 0
    # Set verificationStatus instead of status on the types that have no status.
    retract_type_aware: bool = False
