"""Source contract (S2): the tables, the columns the models need, and their keys.

Ids are bigint: the sources declare 32-bit ids, which a consolidated store outgrows. A table may carry
more columns than listed; they are mirrored as they are.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import types as T

AUDIT = "voided int, date_created timestamp_ntz, date_updated timestamp_ntz"
EDITED = f"{AUDIT}, date_changed timestamp_ntz"


@dataclass(frozen=True)
class Contract:
    name: str
    key: tuple[str, ...]
    schema: T.StructType
    # Fixed-width text that arrives padded.
    padded: tuple[str, ...] = field(default=("uuid",))
    # Key columns that may be null.
    optional: tuple[str, ...] = ()

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()


TYPES = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def struct_of(ddl: str) -> T.StructType:
    """Schema of a flat `name type, ...` list; needs no session, so contracts load with the package."""
    fields = [part.split() for part in ddl.split(",")]
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in fields])


def _contract(name: str, key: str, ddl: str, site: bool = True, optional: str = "") -> Contract:
    ddl = f"mspp_code string, {ddl}" if site else ddl
    return Contract(name, tuple(key.split()), struct_of(ddl), optional=tuple(optional.split()))


CONTRACTS: dict[str, Contract] = {
    c.name: c
    for c in (
        _contract("patient_openmrs", "mspp_code patient_id", f"patient_id bigint, {EDITED}"),
        _contract(
            "person_openmrs",
            "mspp_code person_id",
            "person_id bigint, gender string, birthdate date, birthdate_estimated int, dead int, "
            f"death_date timestamp_ntz, uuid string, {EDITED}",
        ),
        _contract(
            "person_name_openmrs",
            "mspp_code person_name_id",
            "person_name_id bigint, person_id bigint, preferred int, prefix string, given_name string, "
            f"middle_name string, family_name string, uuid string, {AUDIT}",
        ),
        _contract(
            "person_address_openmrs",
            "mspp_code person_address_id",
            "person_address_id bigint, person_id bigint, preferred int, address1 string, address2 string, "
            "address3 string, city_village string, county_district string, state_province string, "
            f"postal_code string, country string, uuid string, {AUDIT}",
        ),
        _contract(
            "person_attribute_openmrs",
            "mspp_code person_attribute_id",
            "person_attribute_id bigint, person_id bigint, value string, person_attribute_type_id bigint, "
            "voided int, uuid string",
        ),
        _contract(
            "person_attribute_type",
            "mspp_code person_attribute_type_id",
            "person_attribute_type_id bigint, name string, format string, uuid string",
        ),
        _contract(
            "patient_identifier_openmrs",
            "mspp_code patient_identifier_id",
            "patient_identifier_id bigint, patient_id bigint, identifier string, identifier_type bigint, "
            f"location_id bigint, preferred int, uuid string, {AUDIT}",
        ),
        _contract(
            "patient_identifier_type",
            "mspp_code patient_identifier_type_id",
            "patient_identifier_type_id bigint, name string",
        ),
        _contract("site", "mspp_code", "name string"),
        _contract(
            "visit_openmrs",
            "mspp_code visit_id",
            "visit_id bigint, patient_id bigint, date_started timestamp_ntz, date_stopped timestamp_ntz, "
            f"location_id bigint, uuid string, {EDITED}",
        ),
        _contract(
            "encounter_openmrs",
            "mspp_code encounter_id",
            "encounter_id bigint, encounter_type bigint, patient_id bigint, location_id bigint, "
            f"visit_id bigint, encounter_datetime timestamp_ntz, uuid string, {AUDIT}",
        ),
        _contract(
            "encounter_provider_openmrs",
            "mspp_code encounter_provider_id",
            f"encounter_provider_id bigint, encounter_id bigint, provider_id bigint, uuid string, {EDITED}",
        ),
        _contract(
            "encounter_type",
            "mspp_code encounter_type_id",
            "encounter_type_id bigint, name string, uuid string, date_changed timestamp_ntz",
        ),
        _contract(
            "obs_openmrs",
            "mspp_code obs_id",
            "obs_id bigint, person_id bigint, concept_id bigint, encounter_id bigint, "
            "obs_datetime timestamp_ntz, obs_group_id bigint, value_coded bigint, value_drug bigint, "
            "value_datetime timestamp_ntz, value_numeric double, value_modifier string, value_text string, "
            f"uuid string, {EDITED}",
        ),
        _contract("concept", "concept_id", "concept_id bigint, uuid string, class_id int", site=False),
        _contract(
            "concept_name",
            "concept_name_id",
            "concept_name_id bigint, concept_id bigint, name string, locale string, locale_preferred int, "
            "voided int, date_created timestamp_ntz",
            site=False,
        ),
        _contract(
            "allergy_openmrs",
            "mspp_code allergy_id",
            "allergy_id bigint, patient_id bigint, coded_allergen bigint, non_coded_allergen string, "
            f"allergen_type string, comment string, uuid string, {AUDIT}",
        ),
        _contract(
            "allergy_reaction_openmrs",
            "mspp_code allergy_reaction_id",
            "allergy_reaction_id bigint, allergy_id bigint, reaction_concept_id bigint, "
            "reaction_non_coded string, date_updated timestamp_ntz",
        ),
        _contract(
            "patient_prescription",
            "mspp_code patient_id encounter_id location_id drug_id",
            "patient_id bigint, encounter_id bigint, location_id bigint, drug_id bigint, "
            "visit_date timestamp_ntz, dispensation_date date, posology string, number_day double, "
            "voided int, last_updated_date timestamp_ntz, date_updated timestamp_ntz",
            optional="encounter_id",
        ),
        _contract(
            "locations",
            "location_id",
            "location_id bigint, name string, value_reference string, address3 string, "
            "city_village string, state_province string, active int",
            site=False,
        ),
        _contract(
            "patient_diagnosis",
            "",
            "patient_id bigint, encounter_id bigint, location_id bigint, encounter_date timestamp_ntz, "
            "concept_group bigint, concept_id bigint, answer_concept_id bigint, voided int, "
            "last_updated_date timestamp_ntz, date_updated timestamp_ntz",
        ),
        _contract(
            "patient_isanteplus",
            "mspp_code patient_id date_created",
            "patient_id bigint, mother_name string, voided int, date_created date",
        ),
        _contract(
            "national_fingerprint_mapping",
            "id",
            "id bigint, patient_id bigint, national_id string, statut string, "
            "created_at timestamp_ntz, updated_at timestamp_ntz",
        ),
    )
}

# The states a fingerprint mapping can have, and those that yield a national id.
FINGERPRINT_STATES = ("UNIQUE", "DOUBLON", "A_REVOIR", "ERREUR", "ERREUR_REGISTER", "ERREUR_TEMPLATE")
FINGERPRINT_ACCEPTED = ("UNIQUE", "DOUBLON")


def contract(table: str) -> Contract:
    return CONTRACTS[table]


def missing_columns(df: DataFrame, c: Contract) -> list[str]:
    return [name for name in c.columns if name not in df.columns]


def _typed(c: Contract, field: T.StructField, found: T.DataType) -> str:
    name, kind = f"`{field.name}`", field.dataType.simpleString()
    value = f"rtrim({name})" if field.name in c.padded else name
    return name if value == name and found == field.dataType else f"cast({value} as {kind}) as {name}"


def conform(df: DataFrame, table: str) -> DataFrame:
    """Cast to the contract and refuse a table that lacks one of its columns. Other columns stay."""
    c = contract(table)
    missing = missing_columns(df, c)
    if missing:
        raise ValueError(f"{table}: missing columns {missing}")
    found = {f.name: f.dataType for f in df.schema}
    extra = [f"`{name}`" for name in found if name not in c.columns]
    return df.selectExpr(*[_typed(c, f, found[f.name]) for f in c.schema], *extra)
