"""Patient + person and six children -> Patient."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinweave.functions.columns import (
    code_in,
    epoch,
    fhir_datetime,
    fhir_id,
    latest_of,
    non_empty,
    not_junk,
    not_matching,
    not_voided,
    optional,
    reference,
    site_meta,
)
from clinweave.functions.document import Opt, Rendered, arr, obj, render
from clinweave.operators.children import collect_children, latest, paged_id, pick_one
from clinweave.operators.joins import lookup, with_child, with_person
from clinweave.plans.models.parts import address_extension, codeable
from clinweave.settings import NATIONAL_ID_LABEL, SOURCE_KEY_LABEL, Settings
from clinweave.sources.contracts import FINGERPRINT_ACCEPTED
from clinweave.sources.tables import load_seed

# Gender codes, values that stand for "not known", and URIs of a Patient.
GENDERS = {"male": ("M", "Male"), "female": ("F", "Female"), "other": ("O", "Other")}
OTHER_GENDER = "unknown"
PHONE_JUNK = ("?", "00000000", "0000000000", "N/A", "n/a", "-")
PHONE_JUNK_PATTERN = "^0+$"
MOTHER_JUNK = ("unknown", "inconnu", "inconnue", "n/a", "na", "none", "-", "?")
IDENTIFIER_LOCATION_EXT = "http://fhir.openmrs.org/ext/patient/identifier#location"
MOTHER_EXT = "http://hl7.org/fhir/StructureDefinition/patient-mothersMaidenName"
ROLE_SYSTEM = "http://terminology.hl7.org/CodeSystem/v3-RoleCode"

KEYS = ["mspp_code", "patient_id"]


def _preferred_first() -> Column:
    return F.when(F.col("preferred") == 1, F.lit(0)).otherwise(F.lit(1))


def patient_names(t: Mapping[str, DataFrame], s: Settings) -> DataFrame:
    """R8a"""
    middle = F.col("middle_name")
    prefix = F.nullif(F.col("prefix"), F.lit(""))
    name = obj(
        {
            "id": F.col("uuid"),
            "use": F.when(F.col("preferred") == 1, "official").otherwise("usual"),
            "text": F.concat_ws(" ", prefix, "given_name", F.nullif(middle, F.lit("")), "family_name"),
            "family": F.col("family_name"),
            "given": arr(F.col("given_name"), Opt(middle, non_empty(middle))),
            "prefix": Opt(arr(F.col("prefix")), non_empty("prefix")),
        }
    )
    rows = t["person_name_openmrs"].filter(not_voided()).withColumnRenamed("person_id", "patient_id")
    order = [_preferred_first(), F.col("person_name_id")]
    changed = F.coalesce("date_updated", "date_created")
    return collect_children(rows, KEYS, render(name, s.nulls), order, changed, s.max_children)


def patient_addresses(t: Mapping[str, DataFrame], s: Settings) -> DataFrame:
    """R8b"""
    lines = address_extension(address1=F.col("address1"), address2=F.col("address2"), address3=F.col("address3"))
    address = obj(
        {
            "id": F.col("uuid"),
            "extension": lines,
            "use": F.when(F.col("preferred") == 1, "home").otherwise("old"),
            "city": F.col("city_village"),
            "state": F.col("state_province"),
            "country": F.col("country"),
            "district": Opt(F.col("county_district")),
            "postalCode": Opt(F.col("postal_code")),
        }
    )
    rows = t["person_address_openmrs"].filter(not_voided()).withColumnRenamed("person_id", "patient_id")
    order = [_preferred_first(), F.col("person_address_id")]
    changed = F.coalesce("date_updated", "date_created")
    return collect_children(rows, KEYS, render(address, s.nulls), order, changed, s.max_children)


IDENTIFIER_COLUMNS = [
    *KEYS, "kind", "row_id", "uuid", "use", "label", "system", "value", "place_id", "place_name", "chg",
]


def all_identifiers(t: Mapping[str, DataFrame], s: Settings) -> DataFrame:
    """Mapped local identifiers, the national id, and the source key every live patient carries."""
    local = t["patient_identifier_openmrs"]
    seed = t["identifier_systems"] if "identifier_systems" in t else load_seed(local.sparkSession)
    places = t["locations"].select(
        F.col("location_id").alias("_place"),
        fhir_id("value_reference").alias("place_id"),
        F.col("name").alias("place_name"),
    )
    # An identifier whose type the seed does not map is dropped. The seed is a packaged file.
    mapped = local.filter(not_voided()).join(F.broadcast(seed), "identifier_type", "inner")
    mapped = lookup(mapped, places, {"location_id": "_place"}, ["mspp_code", "patient_identifier_id"])
    mapped = mapped.select(
        *KEYS,
        F.lit(0).alias("kind"),
        F.col("patient_identifier_id").alias("row_id"),
        "uuid",
        F.when(F.col("preferred") == 1, "official").otherwise("usual").alias("use"),
        "label",
        "system",
        F.col("identifier").alias("value"),
        "place_id",
        "place_name",
        F.coalesce("date_updated", "date_created").alias("chg"),
    )
    none = F.lit(None).cast("string")

    def official(rows: DataFrame, kind: int, row_id: str, label: str, system: str, value: Column, chg: Column):
        return rows.select(
            *KEYS,
            F.lit(kind).alias("kind"),
            F.col(row_id).alias("row_id"),
            none.alias("uuid"),
            F.lit("official").alias("use"),
            F.lit(label).alias("label"),
            F.lit(system).alias("system"),
            value.alias("value"),
            none.alias("place_id"),
            none.alias("place_name"),
            chg.alias("chg"),
        )

    prints = t["national_fingerprint_mapping"].filter(
        F.col("national_id").isNotNull() & code_in("statut", FINGERPRINT_ACCEPTED, s)
    )
    national = official(
        prints, 1, "id", NATIONAL_ID_LABEL, s.national_id_system, F.col("national_id"),
        F.coalesce("updated_at", "created_at"),
    )
    source_key = F.concat("mspp_code", F.lit("-"), F.col("patient_id").cast("string"))
    patients = t["patient_openmrs"].filter(not_voided())
    keyed = official(patients, 2, "patient_id", SOURCE_KEY_LABEL, s.source_key_system, source_key, epoch())
    return mapped.unionByName(national).unionByName(keyed).select(*IDENTIFIER_COLUMNS)


def patient_identifiers(t: Mapping[str, DataFrame], s: Settings) -> DataFrame:
    """R8c"""
    place = reference("Location", "place_id", typed=True, display=F.col("place_name"))
    where = obj({"url": IDENTIFIER_LOCATION_EXT, "valueReference": place})
    identifier = obj(
        {
            # Only a local identifier row has an id of its own.
            "id": Opt(F.col("uuid"), F.col("kind") == 0),
            "use": F.col("use"),
            "type": obj({"text": F.col("label")}),
            "system": F.col("system"),
            "value": F.col("value"),
            "extension": Opt(arr(where), F.col("place_id").isNotNull()),
        }
    )
    order = [F.col("kind"), F.col("row_id")]
    return collect_children(
        all_identifiers(t, s), KEYS, render(identifier, s.nulls), order, F.col("chg"), s.max_children
    )


def fingerprint_change(t: Mapping[str, DataFrame]) -> DataFrame:
    """R8d: latest change over mappings of any status, so that a downgrade is sent too."""
    return latest(
        t["national_fingerprint_mapping"], KEYS, F.coalesce("updated_at", "created_at"), "print_chg"
    )


def patient_phone(t: Mapping[str, DataFrame], s: Settings) -> DataFrame:
    """R8e: the named attribute without junk, smallest value."""
    kinds = t["person_attribute_type"].filter(code_in("name", [s.phone_attribute_name], s))
    kinds = kinds.select("mspp_code", "person_attribute_type_id")
    rows = t["person_attribute_openmrs"].filter(
        not_voided() & non_empty("value") & not_junk("value", PHONE_JUNK) & not_matching("value", PHONE_JUNK_PATTERN)
    )
    rows = rows.join(kinds, ["mspp_code", "person_attribute_type_id"], "inner")
    return pick_one(rows.withColumnRenamed("person_id", "patient_id"), KEYS, F.col("value"), "min", "phone")


def mother_name(t: Mapping[str, DataFrame]) -> DataFrame:
    """R8f: trimmed, without junk, largest value."""
    name = F.trim("mother_name")
    rows = t["patient_isanteplus"].filter(
        F.col("mother_name").isNotNull() & (name != "") & not_junk("mother_name", MOTHER_JUNK, lower=True) & not_voided()
    )
    return pick_one(rows, KEYS, name, "max", "mother")


def _children(t: Mapping[str, DataFrame], s: Settings) -> DataFrame:
    """The three child arrays side by side, one row per patient and page."""
    parts = {"name": patient_names(t, s), "address": patient_addresses(t, s), "identifier": patient_identifiers(t, s)}
    on = KEYS if s.max_children is None else [*KEYS, "page"]
    out = None
    for name, part in parts.items():
        part = part.select(
            *on,
            F.col("pages").alias(f"{name}_pages"),
            F.col("arr").alias(f"{name}_arr"),
            F.col("chg").alias(f"{name}_chg"),
        )
        out = part if out is None else out.join(part, on, "full")
    pages = F.greatest(*[F.coalesce(f"{name}_pages", F.lit(1)) for name in parts])
    page = F.lit(0) if s.max_children is None else F.col("page")
    return out.select(
        *KEYS, page.alias("page"), pages.alias("pages"), *[f"{n}_{c}" for n in parts for c in ("arr", "chg")]
    )


def gender(s: Settings) -> Column:
    out = F.lit(OTHER_GENDER)
    for name, codes in GENDERS.items():
        out = F.when(code_in("gender", codes, s), name).otherwise(out)
    return out


def build_patient(t: Mapping[str, DataFrame], s: Settings) -> DataFrame:
    person = t["person_openmrs"].select(
        "mspp_code",
        "person_id",
        fhir_id("uuid").alias("fhir_id"),
        "gender",
        "birthdate",
        "birthdate_estimated",
        "dead",
        "death_date",
        F.col("voided").alias("person_voided"),
        latest_of("date_updated", "date_created").alias("person_chg"),
    )
    live = t["patient_openmrs"].filter(not_voided()).select(*KEYS, latest_of("date_updated", "date_created").alias("own_chg"))
    fact = with_person(live, person, "patient_id")
    for child in (fingerprint_change(t), patient_phone(t, s), mother_name(t), _children(t, s)):
        fact = with_child(fact, child, KEYS)
    page, pages = F.coalesce("page", F.lit(0)), F.coalesce("pages", F.lit(1))
    base_id = F.col("fhir_id")
    fact = fact.withColumn("base_id", base_id).withColumn("fhir_id", paged_id(base_id, page))
    changed = F.greatest(
        "person_chg", "own_chg", *[latest_of(f"{c}_chg") for c in ("name", "address", "identifier", "print")]
    )
    dead = F.coalesce("dead", F.lit(0)) == 1
    dated = dead & F.col("death_date").isNotNull()
    born = F.when(
        F.coalesce("birthdate_estimated", F.lit(0)) == 1, F.year("birthdate").cast("string")
    ).otherwise(F.col("birthdate").cast("string"))
    phone = obj({"system": "phone", "value": F.col("phone"), "use": "mobile"})
    has_mother = F.col("mother").isNotNull()
    contact = obj({"relationship": arr(codeable(ROLE_SYSTEM, "MTH")), "name": obj({"text": F.col("mother")})})
    document = {
        "resourceType": "Patient",
        "id": F.col("fhir_id"),
        "meta": site_meta("mspp_code", s),
        "active": F.coalesce("person_voided", F.lit(0)) == 0,
        "gender": gender(s),
        "birthDate": born,
        "name": Rendered(F.col("name_arr")),
        "address": Rendered(F.col("address_arr")),
        "identifier": Rendered(F.col("identifier_arr")),
        "deceasedDateTime": optional(dated, fhir_datetime("death_date")),
        "deceasedBoolean": optional(~dated, dead),
        "telecom": optional(F.col("phone").isNotNull(), arr(phone)),
        "extension": optional(has_mother, arr(obj({"url": MOTHER_EXT, "valueString": F.col("mother")}))),
        "contact": optional(has_mother, arr(contact)),
    }
    if s.max_children is not None:
        # Records of the same person that carry the further pages of an oversized child array.
        def link(target: Column) -> Column:
            return render(obj({"other": reference("Patient", target), "type": "seealso"}), s.nulls)

        further = F.transform(F.sequence(F.lit(1), pages - 1), lambda n: link(paged_id(F.col("base_id"), n)))
        links = F.when(page == 0, further).otherwise(F.array(link(F.col("base_id"))))
        document["link"] = optional(pages > 1, Rendered(F.when(pages > 1, links)))
    return fact.select(*KEYS, "fhir_id", changed.alias("changed_at"), render(obj(document), s.nulls).alias("resource"))
