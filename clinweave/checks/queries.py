"""One query per operator, over whole tables: name -> (spark, folder) -> DataFrame.

Documents are compared through columns taken out of them; arrays are joined to text in their order.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable
from datetime import datetime
from functools import lru_cache
from urllib.parse import unquote

import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow.fs import FileSelector, FileSystem, LocalFileSystem
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clinweave.checks.clinical_view import base_table, clinical_tables
from clinweave.functions import columns as C
from clinweave.functions.json_docs import json_merge_patch, tag_source
from clinweave.operators import delivery as D
from clinweave.operators import diff as X
from clinweave.operators import quality as Q
from clinweave.operators import reconcile as R
from clinweave.operators.terminology import preferred_concept_name
from clinweave.operators.upsert import dedup
from clinweave.operators.validate import split_valid
from clinweave.plans.materialize import one_per_key, transform, views_of
from clinweave.plans.mirror import run_totals, sync_all
from clinweave.plans.models import MODELS, to_table
from clinweave.plans.models import patient as P
from clinweave.plans.push import Outbox, push, retract, state_of
from clinweave.session import scratch
from clinweave.settings import Settings
from clinweave.sources.access import clustered_store
from clinweave.sources.changes import envelope_keys, member, parse_envelope, read_changes
from clinweave.sources.contracts import struct_of
from clinweave.sources.inventory import Server, inventory, read_delivered
from clinweave.sources.ordered import Ordered
from clinweave.sources.snapshots import Store
from clinweave.sources.tables import Tables, load_seed
from clinweave.streaming import jobs as J

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
S = Settings()


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def big(c: Column) -> Column:
    return c.cast("bigint")


def when_changed() -> Column:
    return C.fhir_datetime("changed_at").alias("changed_at")


def listed(array: str, item: Callable[[Column], Column]) -> Column:
    return F.array_join(F.transform(array, item), ";")


def built(t, name: str, s: Settings = S) -> DataFrame:
    return MODELS[name].build(t, s)


def table(t, name: str, s: Settings = S) -> DataFrame:
    """A resource table as it is stored: JSON text, one row per id."""
    rows = to_table(built(t, name, s))
    return rows if MODELS[name].kind == "full" else one_per_key(rows, MODELS[name].grain)


def resource_tables(t, s: Settings = S) -> Tables:
    return Tables(lambda name: table(t, name, s), list(MODELS))


# -- seed, macros, scalar functions


@query
def s5_seed(spark: SparkSession, root: str) -> DataFrame:
    """S5, MT1, J2: identifiers per mapped type."""
    rows = clinical_tables(spark, root)["patient_identifier_openmrs"]
    return (
        rows.join(F.broadcast(load_seed(spark)), "identifier_type", "inner")
        .groupBy("identifier_type", "system", "label")
        .agg(F.count("*").alias("identifiers"))
    )


@query
def m1_fhir_id(spark: SparkSession, root: str) -> DataFrame:
    person = clinical_tables(spark, root)["person_openmrs"]
    once = C.fhir_id("uuid")
    return person.select("mspp_code", "person_id", once.alias("fhir_id"), C.fhir_id(once).alias("again"))


@query
def m3_synthetic_id(spark: SparkSession, root: str) -> DataFrame:
    t = clinical_tables(spark, root)
    return t["patient_diagnosis"].select(
        "encounter_id",
        C.synthetic_id(
            "cond-", "mspp_code", "encounter_id", "location_id", "concept_group", "concept_id",
            "answer_concept_id", "encounter_date",
        ).alias("fhir_id"),
    )


@query
def m4_concept_code(spark: SparkSession, root: str) -> DataFrame:
    t = clinical_tables(spark, root)
    return t["concept"].select("concept_id", C.concept_code("uuid", "concept_id").alias("code"))


@query
def m6_fhir_datetime(spark: SparkSession, root: str) -> DataFrame:
    t = clinical_tables(spark, root)
    return t["visit_openmrs"].select(
        "visit_id", C.fhir_datetime("date_started").alias("started"), C.fhir_datetime("date_stopped").alias("stopped")
    )


@query
def f19_merge_patch(spark: SparkSession, root: str) -> DataFrame:
    """The event's own properties patched with nested, null and array members."""
    events = base_table(spark, root, "events")
    nothing = F.lit(None).cast("string")
    left = F.concat(
        F.lit('{"k":0,"keep":null,"a":{"x":1,"y":{"z":"old","w":2,"d":{"e":{"f":1,"g":2},"h":0}}},"list":[1,2],"kind":'),
        F.to_json(F.array("event_type")), F.lit("}"),
    )
    right = F.concat(
        F.lit('{"kind":null,"a":{"x":null,"n":'), F.col("event_id").cast("string"),
        F.lit(',"y":{"z":"new","v":null,"d":{"e":{"f":null,"i":{"j":'),
        F.col("event_id").cast("string"), F.lit('}}}}},"list":[null,'), F.col("user_id").cast("string"),
        F.lit('],"fresh":{"p":1,"q":null}}'),
    )
    both = json_merge_patch(json_merge_patch(left, F.col("props")), right)
    paths = {
        "k": "$.k", "kind": "$.kind", "a_x": "$.a.x", "a_n": "$.a.n", "a_y_z": "$.a.y.z", "a_y_w": "$.a.y.w",
        "item": "$.list[1]", "fresh_p": "$.fresh.p", "deep_f": "$.a.y.d.e.f", "deep_g": "$.a.y.d.e.g", "deep_h": "$.a.y.d.h",
        "deep_j": "$.a.y.d.e.i.j",
    }
    out = events.select("event_id", both.alias("doc"))
    return out.select(
        "event_id",
        *[F.coalesce(F.get_json_object("doc", p), nothing).alias(n) for n, p in paths.items()],
        (F.instr("doc", '"keep":null') > 0).alias("keeps_null"),
        (F.instr("doc", '"q"') > 0).alias("has_q"),
    )


@query
def m9_change_version(spark: SparkSession, root: str) -> DataFrame:
    t = clinical_tables(spark, root)["visit_openmrs"]
    return t.select("visit_id", C.fhir_datetime(C.change_version(t)).alias("version"))


@query
def m10_row_hash(spark: SparkSession, root: str) -> DataFrame:
    t = clinical_tables(spark, root)["person_attribute_openmrs"]
    names = ["person_attribute_id", "mspp_code", "value", "person_attribute_type_id", "voided", "uuid"]
    return t.select("person_attribute_id", C.row_hash(t, names).alias("digest"))


@query
def tm1_preferred_name(spark: SparkSession, root: str) -> DataFrame:
    return preferred_concept_name(clinical_tables(spark, root), S)


# -- resource models


@query
def r1_location(spark: SparkSession, root: str) -> DataFrame:
    r = F.col("resource")
    return built(clinical_tables(spark, root), "location").select(
        "fhir_id",
        r["id"].alias("id"),
        r["name"].alias("name"),
        r["status"].alias("status"),
        r["address"]["extension"][0]["extension"][0]["valueString"].alias("address3"),
        r["address"]["city"].alias("city"),
        r["address"]["state"].alias("state"),
    )


@query
def r2_encounter(spark: SparkSession, root: str) -> DataFrame:
    r = F.col("resource")
    return built(clinical_tables(spark, root), "encounter").select(
        "mspp_code",
        "encounter_id",
        "fhir_id",
        "patient_fhir_id",
        when_changed(),
        r["meta"]["tag"][0]["code"].alias("kind_tag"),
        r["meta"]["tag"][1]["code"].alias("site_tag"),
        r["status"].alias("status"),
        r["class"]["code"].alias("class_code"),
        r["subject"]["reference"].alias("subject"),
        r["period"]["start"].alias("started"),
        r["type"][0]["coding"][0]["code"].alias("type_code"),
        r["type"][0]["text"].alias("type_text"),
        r["location"][0]["location"]["reference"].alias("location"),
        r["location"][0]["location"]["display"].alias("location_name"),
        r["partOf"]["reference"].alias("part_of"),
    )


@query
def r3_visit(spark: SparkSession, root: str) -> DataFrame:
    r = F.col("resource")
    return built(clinical_tables(spark, root), "visit").select(
        "mspp_code",
        "visit_id",
        "fhir_id",
        "patient_fhir_id",
        when_changed(),
        r["meta"]["tag"][0]["display"].alias("kind_tag"),
        r["status"].alias("status"),
        r["subject"]["reference"].alias("subject"),
        r["period"]["start"].alias("started"),
        r["period"]["end"].alias("stopped"),
        r["location"][0]["location"]["reference"].alias("location"),
    )


@query
def r4_observation(spark: SparkSession, root: str) -> DataFrame:
    r = F.col("resource")
    value = r["valueCodeableConcept"]["coding"][0]
    return built(clinical_tables(spark, root), "observation").select(
        "mspp_code",
        "obs_id",
        "fhir_id",
        "patient_fhir_id",
        when_changed(),
        r["category"][0]["coding"][0]["code"].alias("category"),
        r["code"]["coding"][0]["code"].alias("code"),
        r["code"]["text"].alias("code_text"),
        r["effectiveDateTime"].alias("effective"),
        r["issued"].alias("issued"),
        r["valueQuantity"]["value"].alias("quantity"),
        r["valueQuantity"]["comparator"].alias("comparator"),
        value["system"].alias("value_system"),
        value["code"].alias("value_code"),
        value["display"].alias("value_display"),
        r["valueDateTime"].alias("value_datetime"),
        r["valueString"].alias("value_string"),
        r["encounter"]["reference"].alias("encounter"),
        listed("resource.hasMember", lambda m: m["reference"]).alias("members"),
    )


@query
def r5_condition(spark: SparkSession, root: str) -> DataFrame:
    r = F.col("resource")
    return built(clinical_tables(spark, root), "condition").select(
        "mspp_code",
        "patient_id",
        "fhir_id",
        "patient_fhir_id",
        when_changed(),
        r["clinicalStatus"]["coding"][0]["code"].alias("clinical"),
        r["verificationStatus"]["text"].alias("verification"),
        r["category"][0]["coding"][0]["code"].alias("category"),
        r["code"]["coding"][0]["code"].alias("code"),
        r["code"]["text"].alias("code_text"),
        r["subject"]["reference"].alias("subject"),
        r["recordedDate"].alias("recorded"),
    )


@query
def r6_allergy(spark: SparkSession, root: str) -> DataFrame:
    r = F.col("resource")

    def reaction(x: Column) -> Column:
        what = x["manifestation"][0]
        return F.concat_ws("|", what["coding"][0]["code"], what["text"])

    return built(clinical_tables(spark, root), "allergy_intolerance").select(
        "mspp_code",
        "allergy_id",
        "fhir_id",
        "patient_fhir_id",
        when_changed(),
        r["category"][0].alias("category"),
        r["code"]["coding"][0]["code"].alias("code"),
        r["code"]["coding"][0]["display"].alias("display"),
        r["code"]["text"].alias("code_text"),
        r["patient"]["reference"].alias("patient"),
        r["recordedDate"].alias("recorded"),
        listed("resource.reaction", reaction).alias("reactions"),
        r["note"][0]["text"].alias("note"),
    )


@query
def r7_medication_request(spark: SparkSession, root: str) -> DataFrame:
    r = F.col("resource")
    dose = r["dosageInstruction"][0]
    return built(clinical_tables(spark, root), "medication_request").select(
        "mspp_code",
        "patient_id",
        "fhir_id",
        "patient_fhir_id",
        when_changed(),
        r["priority"].alias("priority"),
        r["authoredOn"].alias("authored"),
        r["medicationCodeableConcept"]["coding"][0]["code"].alias("drug"),
        dose["text"].alias("dosage"),
        dose["timing"]["repeat"]["boundsDuration"]["value"].alias("days"),
        r["encounter"]["reference"].alias("encounter"),
    )


def name_text(n: Column) -> Column:
    return F.concat_ws("|", n["id"], n["use"], n["text"], n["family"], F.array_join(n["given"], "+"), n["prefix"][0])


def address_text(a: Column) -> Column:
    lines = F.transform(a["extension"][0]["extension"], lambda e: e["valueString"])
    return F.concat_ws(
        "|", a["id"], a["use"], F.array_join(lines, "+"), a["city"], a["state"], a["country"], a["district"],
        a["postalCode"],
    )


def identifier_text(i: Column) -> Column:
    place = i["extension"][0]["valueReference"]
    return F.concat_ws(
        "|", i["id"], i["use"], i["type"]["text"], i["system"], i["value"], place["reference"], place["display"]
    )


@query
def r8_patient(spark: SparkSession, root: str) -> DataFrame:
    r = F.col("resource")
    return built(clinical_tables(spark, root), "patient").select(
        "mspp_code",
        "patient_id",
        "fhir_id",
        when_changed(),
        r["active"].alias("active"),
        r["gender"].alias("gender"),
        r["birthDate"].alias("birth_date"),
        listed("resource.name", name_text).alias("names"),
        listed("resource.address", address_text).alias("addresses"),
        listed("resource.identifier", identifier_text).alias("identifiers"),
        r["deceasedDateTime"].alias("deceased_at"),
        r["deceasedBoolean"].alias("deceased"),
        r["telecom"][0]["value"].alias("phone"),
        r["extension"][0]["valueString"].alias("mother_extension"),
        r["contact"][0]["name"]["text"].alias("mother_contact"),
        r["contact"][0]["relationship"][0]["coding"][0]["code"].alias("relationship"),
    )


def _child(df: DataFrame, text: Callable[[Column], Column]) -> DataFrame:
    return df.select(
        "mspp_code", "patient_id", listed("arr", text).alias("items"), C.fhir_datetime("chg").alias("changed")
    )


@query
def r8a_names(spark: SparkSession, root: str) -> DataFrame:
    return _child(P.patient_names(clinical_tables(spark, root), S), name_text)


@query
def r8b_addresses(spark: SparkSession, root: str) -> DataFrame:
    return _child(P.patient_addresses(clinical_tables(spark, root), S), address_text)


@query
def r8c_identifiers(spark: SparkSession, root: str) -> DataFrame:
    return _child(P.patient_identifiers(clinical_tables(spark, root), S), identifier_text)


@query
def r8d_fingerprint_change(spark: SparkSession, root: str) -> DataFrame:
    rows = P.fingerprint_change(clinical_tables(spark, root))
    return rows.select("mspp_code", "patient_id", C.fhir_datetime("print_chg").alias("changed"))


@query
def r8e_phone(spark: SparkSession, root: str) -> DataFrame:
    return P.patient_phone(clinical_tables(spark, root), S)


@query
def r8f_mother(spark: SparkSession, root: str) -> DataFrame:
    return P.mother_name(clinical_tables(spark, root))


@query
def r2_encounter_json(spark: SparkSession, root: str) -> DataFrame:
    """The whole document with null members kept, as text."""
    t, s = clinical_tables(spark, root), Settings(nulls="reference")
    return built(t, "encounter", s).select("encounter_id", "resource")


@query
def r3_visit_json(spark: SparkSession, root: str) -> DataFrame:
    t, s = clinical_tables(spark, root), Settings(nulls="reference")
    return built(t, "visit", s).select("visit_id", "resource")


@query
def r5_condition_json(spark: SparkSession, root: str) -> DataFrame:
    t, s = clinical_tables(spark, root), Settings(nulls="reference")
    return built(t, "condition", s).select("fhir_id", "resource")


# -- materialisation

LINE = ["l_orderkey", "l_linenumber"]
LINE_ORDER = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag"]


def _lines(spark: SparkSession, root: str) -> DataFrame:
    return base_table(spark, root, "lineitem").select(*LINE, "l_shipdate", *LINE_ORDER)


def _newest_line() -> list[Column | str]:
    return [-F.datediff(F.col("l_shipdate").cast("date"), F.lit("1970-01-01").cast("date")), *LINE_ORDER]


def _flat_line(df: DataFrame) -> DataFrame:
    return df.select(*LINE, C.fhir_datetime("l_shipdate").alias("shipped"), *LINE_ORDER)


@query
def mt3_dedup(spark: SparkSession, root: str) -> DataFrame:
    """MT3: one line per key, the latest shipped."""
    return _flat_line(dedup(_lines(spark, root), LINE, _newest_line()))


@query
def mt3_upsert(spark: SparkSession, root: str) -> DataFrame:
    """MT3, K1, K2: the first state holds what shipped before 1998; then the rest is upserted, returned lines deleted."""
    store = Store(spark, scratch(spark, "mt3"))
    lines = _lines(spark, root)
    cut = F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    store.overwrite("line", dedup(lines.filter(cut), LINE, _newest_line()))
    store.upsert("line", dedup(lines.filter(~cut), LINE, _newest_line()), LINE)
    gone = store.read("line", LINE).filter(F.col("l_returnflag") == "R")
    store.delete("line", gone, LINE)
    return _flat_line(store.read("line", LINE))


@query
def mt3_snapshot(spark: SparkSession, root: str) -> DataFrame:
    """MT3, D4: a second run replaces the first; rows it no longer yields are gone."""
    store = Store(spark, scratch(spark, "mt3"))
    lines = _lines(spark, root)
    store.overwrite("line", dedup(lines, LINE, _newest_line()))
    store.overwrite("line", dedup(lines.filter(F.col("l_returnflag") != "R"), LINE, _newest_line()))
    return _flat_line(store.read("line", LINE))


@query
def mt3_patient(spark: SparkSession, root: str) -> DataFrame:
    """MT3, T13: two sites share a uuid; one row per resource id is left."""
    return table(clinical_tables(spark, root), "patient").select("fhir_id", "mspp_code", "patient_id", when_changed())


# -- audits


@query
def q1_not_null(spark: SparkSession, root: str) -> DataFrame:
    """Q1 over prescriptions, where an encounter or a posology may be missing."""
    rows = clinical_tables(spark, root)["patient_prescription"]
    return Q.not_null(rows, ["mspp_code", "encounter_id", "posology"]).select("patient_id", "drug_id", "encounter_id", "posology")


@query
def q2_has_identifier(spark: SparkSession, root: str) -> DataFrame:
    """Q2: addresses may be missing where identifiers never are; both paths are audited."""
    rows = to_table(built(clinical_tables(spark, root), "patient"))
    lacking = Q.lacks_path(rows, "$.address").select("fhir_id", "patient_id", F.lit("address").alias("path"))
    return lacking.unionByName(
        Q.lacks_path(rows, "$.identifier").select("fhir_id", "patient_id", F.lit("identifier").alias("path"))
    )


@query
def q3_has_subject(spark: SparkSession, root: str) -> DataFrame:
    """Q3: a concept's name may be missing where the subject never is; both paths are audited."""
    rows = to_table(built(clinical_tables(spark, root), "observation"))
    lacking = Q.lacks_path(rows, "$.code.text").select("fhir_id", F.lit("code text").alias("path"))
    return lacking.unionByName(
        Q.lacks_path(rows, "$.subject.reference").select("fhir_id", F.lit("subject").alias("path"))
    )


@query
def q4_identifier_profile(spark: SparkSession, root: str) -> DataFrame:
    return Q.identifier_profile(clinical_tables(spark, root))


@query
def q5_attribute_profile(spark: SparkSession, root: str) -> DataFrame:
    return Q.attribute_profile(clinical_tables(spark, root))


@query
def q7_valid_fhir_id(spark: SparkSession, root: str) -> DataFrame:
    """Q7 on the raw uuids: the illegal ones."""
    return Q.valid_fhir_id(clinical_tables(spark, root)["person_openmrs"], "uuid").select("person_id", "uuid")


@query
def q8_fanout(spark: SparkSession, root: str) -> DataFrame:
    """Q8: resource ids that more than one prescription yields."""
    rows = built(clinical_tables(spark, root), "medication_request")
    return Q.fanout(rows.select("fhir_id"), ["fhir_id"])


@query
def k4_split_valid(spark: SparkSession, root: str) -> DataFrame:
    """K4: events as text, some with values that do not cast or without a key."""
    raw = base_table(spark, root, "events").select(
        F.when(F.col("event_id") % 97 != 5, F.col("event_id").cast("string")).alias("event_id"),
        F.when(F.col("event_id") % 50 == 3, "n/a").otherwise(F.col("user_id").cast("string")).alias("user_id"),
        F.when(F.col("event_id") % 40 == 7, "today").otherwise(F.col("ts").cast("date").cast("string")).alias("day"),
    )
    good, rejects = split_valid(raw, struct_of("event_id bigint, user_id bigint, day date"), ["event_id"])
    ok = good.select(F.concat(F.lit("event_id="), F.col("event_id").cast("string")).alias("row_key"), F.lit("").alias("reason"))
    return ok.unionByName(rejects)


# -- mirror


def _mirror_pair(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """Orders, and a copy that misses some, holds older or newer versions of others, and has some of its own."""
    k, at = F.col("o_orderkey"), F.col("o_orderdate").cast("timestamp_ntz")
    src = base_table(spark, root, "orders").select(
        "o_orderkey", "o_orderstatus", at.alias("date_created"), F.when(k % 5 == 0, at + F.expr("interval 9 days")).alias("date_updated")
    )
    version = F.when(k % 7 == 0, at - F.expr("interval 1 day")).when(k % 13 == 0, at + F.expr("interval 30 days")).otherwise(at)
    kept = src.filter(k % 11 != 0).select(
        "o_orderkey",
        F.when(k % 9 == 0, "X").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(k % 7 == 0, F.col("date_created") - F.expr("interval 1 day")).otherwise(F.col("date_created")).alias("date_created"),
        F.when(k % 7 == 0, F.lit(None)).when(k % 13 == 0, F.col("date_created") + F.expr("interval 30 days"))
        .otherwise(F.col("date_updated")).alias("date_updated"),
    )
    own = src.filter(k % 17 == 0).withColumn("o_orderkey", -k - 1)
    return src, kept.unionByName(own)


@query
def c2_entry_diff(spark: SparkSession, root: str) -> DataFrame:
    src, dst = _mirror_pair(spark, root)
    return X.diff_by_version(src, dst, ["o_orderkey"])


@query
def c3_hash_diff(spark: SparkSession, root: str) -> DataFrame:
    src, dst = _mirror_pair(spark, root)
    return X.diff_by_hash(src, dst, ["o_orderkey"])


@query
def c4_apply_diff(spark: SparkSession, root: str) -> DataFrame:
    src, dst = _mirror_pair(spark, root)
    after = X.apply_diff(dst, src, X.diff_by_version(src, dst, ["o_orderkey"]), ["o_orderkey"])
    return after.select(
        "o_orderkey", "o_orderstatus", C.fhir_datetime("date_created").alias("created"),
        C.fhir_datetime("date_updated").alias("updated"),
    )


@query
def c6_sync_totals(spark: SparkSession, root: str) -> DataFrame:
    """A copy is brought up to date: of two tables it has gaps and old values, which show by version and by hash;
    one has no key and is copied in full, and so are the tables that were not there."""
    t = clinical_tables(spark, root)
    store = Store(spark, scratch(spark, "mirror"))
    enc, attr = t["encounter_openmrs"], t["person_attribute_openmrs"]
    k = F.col("encounter_id")
    old = enc.filter(k % 11 != 0).withColumn("date_updated", F.when(k % 13 != 0, F.col("date_updated")))
    extra = enc.filter(k % 17 == 0).withColumn("encounter_id", -k - 1)
    store.overwrite("encounter_openmrs", old.unionByName(extra))
    store.overwrite("person_attribute_openmrs", attr.withColumn("value", F.when(F.col("person_id") % 6 != 5, F.col("value"))))
    results, _ = sync_all(t, store, S)
    return run_totals(spark, results)


# -- push


def _encounter_rows(t) -> DataFrame:
    return built(t, "encounter").select(F.lit("encounter").alias("view"), "fhir_id", "encounter_id", "changed_at")


def _encounter_state(rows: DataFrame) -> DataFrame:
    """Some never sent, some sent in an older version, the rest up to date."""
    k = F.col("encounter_id")
    at = F.when(k % 5 == 0, F.col("changed_at") - F.expr("interval 2 days")).otherwise(F.col("changed_at"))
    return rows.filter(k % 3 != 0).select(F.col("view").alias("resource_type"), "fhir_id", at.alias("changed_at"))


@query
def dl1_pending(spark: SparkSession, root: str) -> DataFrame:
    rows = _encounter_rows(clinical_tables(spark, root))
    return D.pending(rows, _encounter_state(rows), S).select("encounter_id", "fhir_id", when_changed())


BUNDLE_SHAPE = "struct<resourceType:string,type:string,entry:array<struct<request:struct<method:string,url:string>>>>"


def _entries(bundles: DataFrame) -> DataFrame:
    doc = F.from_json("bundle", BUNDLE_SHAPE)
    return bundles.select("bundle_id", "size", doc.alias("doc")).select(
        "bundle_id", big(F.col("size")).alias("size"), F.col("doc.type").alias("type"),
        F.col("doc.entry")[0]["request"]["url"].alias("lead_url"), F.posexplode("doc.entry").alias("pos", "e"),
    )


@query
def dl2_pages(spark: SparkSession, root: str) -> DataFrame:
    """DL2, O1, DL5: all patients in pages of 100 by id."""
    rows = table(clinical_tables(spark, root), "patient").withColumn("view", F.lit("patient"))
    bundles = D.identity_bundles(D.pending(rows, D.empty_state(spark), S), S)
    return _entries(bundles).select("bundle_id", "size", big(F.col("pos")).alias("pos"), F.col("e.request.url").alias("url"))


@query
def dl3_clinical_bundles(spark: SparkSession, root: str) -> DataFrame:
    """DL3, A6, J15: every clinical row under its patient; the patient leads each bundle."""
    views = resource_tables(clinical_tables(spark, root))
    rows = D.pending_clinical(views, D.empty_state(spark), S)
    groups = D.clinical_groups(rows, views["patient"], S)
    out = _entries(D.clinical_bundles(groups)).filter(F.col("pos") > 0)
    return out.select("lead_url", F.col("e.request.url").alias("url"), F.col("e.request.method").alias("method"))


@query
def dl4_tag(spark: SparkSession, root: str) -> DataFrame:
    """DL4: the tag is added once, however often it is stamped."""
    rows = to_table(built(clinical_tables(spark, root), "visit"))
    once = tag_source(F.col("resource"), S.source_tag_system, S.source_tag_code)
    rows = rows.select("visit_id", once.alias("once"))
    twice = tag_source(F.col("once"), S.source_tag_system, S.source_tag_code)
    return rows.select(
        "visit_id",
        F.get_json_object("once", "$.meta.tag[1].code").alias("site"),
        F.get_json_object("once", "$.meta.tag[2].system").alias("system"),
        F.get_json_object("once", "$.meta.tag[2].code").alias("code"),
        (twice == F.col("once")).alias("same"),
        F.get_json_object("once", "$.id").alias("id"),
    )


@query
def dl5_bundle(spark: SparkSession, root: str) -> DataFrame:
    """DL5: one bundle per patient with an allergy, entries in id order."""
    t, s = clinical_tables(spark, root), Settings(clinical_views=("allergy_intolerance",))
    views = resource_tables(t, s)
    groups = D.clinical_groups(D.pending_clinical(views, D.empty_state(spark), s), views["patient"], s)
    return _entries(D.clinical_bundles(groups)).select(
        "bundle_id", "size", "type", big(F.col("pos")).alias("pos"), F.col("e.request.method").alias("method"),
        F.col("e.request.url").alias("url"),
    )


@query
def dl6_skip(spark: SparkSession, root: str) -> DataFrame:
    """DL6: clinical rows of patients that are not there."""
    views = resource_tables(clinical_tables(spark, root))
    rows = D.pending_clinical(views, D.empty_state(spark), S)
    return D.skipped(D.clinical_groups(rows, views["patient"], S)).select("resource_type", "fhir_id", when_changed())


@query
def dl7_marks(spark: SparkSession, root: str) -> DataFrame:
    """DL7: only the accepted pages are remembered."""
    rows = table(clinical_tables(spark, root), "patient").withColumn("view", F.lit("patient"))
    bundles = D.identity_bundles(rows, S)
    page = F.substring_index("bundle_id", "-", -1).cast("int")
    status = bundles.select("bundle_id", F.when(page % 3 == 1, "ERR 400").otherwise("201").alias("status"))
    return D.marks_on_success(bundles, status).select("resource_type", "fhir_id", when_changed())


@query
def dl8_full_push(spark: SparkSession, root: str) -> DataFrame:
    """DL8, S6, S7: everything of the patients that have a fingerprint mapping."""
    t = clinical_tables(spark, root)
    prints = t["national_fingerprint_mapping"].select("mspp_code", F.col("patient_id").alias("person_id"))
    keys = t["person_openmrs"].join(prints, ["mspp_code", "person_id"], "left_semi").select(C.fhir_id("uuid").alias("fhir_id"))
    out = _entries(D.full_bundles(keys, resource_tables(t), S))
    return out.select("lead_url", F.col("e.request.url").alias("url"))


@query
def dl9_globals(spark: SparkSession, root: str) -> DataFrame:
    """DL9, S8"""
    bundles = D.global_bundle(resource_tables(clinical_tables(spark, root)), S)
    return _entries(bundles).select("bundle_id", "size", big(F.col("pos")).alias("pos"), F.col("e.request.url").alias("url"))


class Picky:
    """A receiver that refuses some ids and is down for others."""

    def __call__(self, body: str) -> int:
        last = int(body.rpartition('"url":"Encounter/visit-')[2].partition('"')[0]) % 20
        if last == 8:
            return 422
        if last == 12:
            return 503
        if last == 16:
            raise ConnectionError("reset")
        return 201 if last == 4 else 200


def no_pause(seconds: float) -> None:
    return None


@query
def k6_deliver(spark: SparkSession, root: str) -> DataFrame:
    """K6: one bundle per visit through a receiver that answers by id."""
    rows = D.with_entries(to_table(built(clinical_tables(spark, root), "visit")), S)
    bundles = rows.select(
        F.col("visit_id").cast("string").alias("bundle_id"), F.lit(1).alias("size"), D.build_bundle(F.array("entry")).alias("bundle")
    )
    return D.deliver(bundles, Picky(), retries=3, pause=no_pause)


# -- reconcile


def _all_delivered(t, s: Settings) -> DataFrame:
    """Everything ever sent: the models as if no encounter, visit or allergy had been voided."""
    out = None
    for view in ("encounter", "visit", "allergy_intolerance"):
        rows = to_table(built(_alive(t), view, s))
        part = rows.select(F.lit(R.VIEW_TYPES[view]).alias("resource_type"), "fhir_id", "resource")
        out = part if out is None else out.unionByName(part)
    return out


RECONCILED = Settings(clinical_views=("encounter", "visit", "allergy_intolerance"))


@query
def rc1_expected(spark: SparkSession, root: str) -> DataFrame:
    """RC1, A8: encounters and visits count as one type."""
    ids = R.expected_ids(resource_tables(clinical_tables(spark, root)), S)
    return ids.groupBy("resource_type").agg(F.count("*").alias("ids"), F.min("fhir_id").alias("first_id"), F.max("fhir_id").alias("last_id"))


@query
def rc3_orphans(spark: SparkSession, root: str) -> DataFrame:
    """RC3, U2"""
    t = clinical_tables(spark, root)
    expected = R.expected_ids(resource_tables(t, RECONCILED), RECONCILED)
    return R.orphans(expected, _all_delivered(t, RECONCILED)).select("resource_type", "fhir_id")


@query
def o3_ordered(spark: SparkSession, root: str) -> DataFrame:
    """O3: orphans by type and id, then the patients touched by a push, as an ordered table; each row with its place."""
    t = clinical_tables(spark, root)
    views = resource_tables(t, RECONCILED)
    gone = R.orphans(R.expected_ids(views, RECONCILED), _all_delivered(t, RECONCILED)).select(F.lit("orphan").alias("list"), "resource_type", "fhir_id")
    rows = D.pending_clinical(views, D.empty_state(spark), RECONCILED)
    touched = rows.select(F.lit("touched").alias("list"), F.lit("Patient").alias("resource_type"), F.col("patient_fhir_id").alias("fhir_id")).distinct()
    return Ordered.write(gone.unionByName(touched), ["list", "resource_type", "fhir_id"]).read()


@query
def rc4_flagged(spark: SparkSession, root: str) -> DataFrame:
    """RC4, RC5: one bundle per orphan, its document withdrawn; a second pass finds nothing to do."""
    t = clinical_tables(spark, root)
    expected = R.expected_ids(resource_tables(t, RECONCILED), RECONCILED)
    gone = R.orphans(expected, _all_delivered(t, RECONCILED))
    doc = F.col("bundle")
    first = R.retractions(gone, RECONCILED)
    return first.select(
        "bundle_id",
        F.get_json_object(doc, "$.entry[0].resource.status").alias("status"),
        F.get_json_object(doc, "$.entry[0].request.url").alias("url"),
        F.get_json_object(doc, "$.entry[0].resource.id").alias("id"),
    )


def _alive(t) -> Tables:
    """The tables as if no encounter, visit or allergy had been voided."""
    alive = ("encounter_openmrs", "visit_openmrs", "allergy_openmrs")
    return Tables(lambda n: t[n].withColumn("voided", F.lit(0)) if n in alive else t[n], list(t))


@query
def rc2_delivered(spark: SparkSession, root: str) -> DataFrame:
    """S9, RC2: the inventory after a push: every resource with the delivery that carried it last."""
    store = Store(spark, scratch(spark, "delivered"))
    transform(clinical_tables(spark, root), store, S)
    push(store, views_of(store), S)
    return inventory(store).select("resource_type", "fhir_id", "seq", "flagged")


class Shelf:
    """Documents by type and id, from Parquet that Spark wrote by (kind, bucket) in order of id.

    A request reads the row group that may hold its id, whose size does not grow with the shelf.
    """

    BUCKETS, GROUP = 64, 1 << 18

    def __init__(self, folder: str):
        self.folder = folder

    def __call__(self, url: str) -> dict | None:
        kind, key = (unquote(part) for part in url.split("/")[-2:])
        for file in _shelf(self.folder, kind, zlib.crc32(key.encode()) % self.BUCKETS):
            for group in range(file.num_row_groups):
                known = file.metadata.row_group(group).column(0).statistics
                if known is not None and known.has_min_max and not known.min <= key <= known.max:
                    continue
                rows = file.read_row_group(group)
                if (at := pc.index(rows["fhir_id"], key).as_py()) >= 0:
                    return json.loads(rows["resource"][at].as_py())
        return GONE

    @classmethod
    def write(cls, docs: DataFrame, folder: str) -> Shelf:
        bucket = F.pmod(F.crc32(F.col("fhir_id").cast("binary")), F.lit(cls.BUCKETS)).alias("bucket")
        rows = docs.select("fhir_id", "resource", F.col("resource_type").alias("kind"), bucket).repartition("kind", "bucket")
        rows = rows.sortWithinPartitions("kind", "bucket", "fhir_id")
        rows.write.option("parquet.block.size", cls.GROUP).partitionBy("kind", "bucket").parquet(folder)
        return cls(folder)


GONE = {"resourceType": "OperationOutcome"}


@lru_cache(maxsize=256)
def _shelf(folder: str, kind: str, bucket: int) -> list[pq.ParquetFile]:
    """The files of one bucket, of which only the footers are read."""
    files, path = FileSystem.from_uri(folder) if "://" in folder else (LocalFileSystem(), folder.removeprefix("file:"))
    found = files.get_file_info(FileSelector(f"{path}/kind={kind}/bucket={bucket}", allow_not_found=True))
    return [pq.ParquetFile(files.open_input_file(info.path)) for info in found if info.base_name.startswith("part-")]


@query
def rc5_retract(spark: SparkSession, root: str) -> DataFrame:
    """RC1-RC5: what the source no longer yields is withdrawn, from ids alone; its documents are fetched by id.

    Of the documents out there some are gone (ids that end in 3) and some have become of another type (in 7).
    """
    t, store = clinical_tables(spark, root), Store(spark, scratch(spark, "retract"))
    transform(_alive(t), store, RECONCILED)
    push(store, views_of(store), RECONCILED)
    last = F.substring("fhir_id", -1, 1)
    other = F.to_json(F.struct(F.lit("Basic").alias("resourceType"), F.col("fhir_id").alias("id")))
    docs = read_delivered(Outbox(store).log(), RECONCILED).filter(last != "3")
    shelf = Shelf.write(docs.withColumn("resource", F.when(last == "7", other).otherwise(F.col("resource"))), scratch(spark, "shelf"))
    server = Server(shelf, "shelf", lists=False, pause=no_pause)
    retract(store, resource_tables(t, RECONCILED), RECONCILED, server=server)
    return inventory(store).filter("flagged").select("resource_type", "fhir_id")


@query
def rc7_managed(spark: SparkSession, root: str) -> DataFrame:
    """RC7, D10: expected ids of the configured views that have a type, of types with all their views at hand."""
    s = Settings(clinical_views=("visit", "condition", "unheard_of", "allergy_intolerance"))
    views = resource_tables(clinical_tables(spark, root), s)
    some = {name: views[name] for name in ("visit", "allergy_intolerance", "condition")}
    return R.expected_ids(some, s).groupBy("resource_type").agg(F.count("*").alias("ids"))


@query
def rc6_due(spark: SparkSession, root: str) -> DataFrame:
    """RC6: the last order date as the marker of the last run."""
    orders = base_table(spark, root, "orders")
    marker = orders.select(F.lit(R.MARKER).alias("resource_type"), F.col("o_orderdate").cast("timestamp_ntz").alias("last_changed_at"))
    now = datetime(2000, 1, 1)
    out = None
    for every in (0, 3600, 10**9):
        part = R.due(marker, every, now).select(big(F.lit(every)).alias("every"), "due")
        out = part if out is None else out.unionByName(part)
    return out


# -- streams


EVENT_KEY = ["user_id"]


def _shuffled_events(spark: SparkSession, root: str) -> Callable[[int], str]:
    """Events as change files in an order that makes some late: written in two steps, by event_id % 7."""
    events = base_table(spark, root, "events")
    path = scratch(spark, "events")
    k = F.col("event_id")
    op = F.when(k % 10 == 9, "d").when(k % 10 == 0, "c").otherwise("u")
    rows = events.select(
        "user_id", "event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "event_type", "value", op.alias("op")
    )

    def write(step: int) -> str:
        late = F.pmod(k * 3, F.lit(7)) >= 4
        rows.filter(late if step else ~late).write.mode("append").parquet(path)
        return path

    return write


EVENT_SCHEMA = "user_id bigint, event_id bigint, ts timestamp_ntz, event_type string, value double, op string"


def _run_twice(spark: SparkSession, write: Callable[[int], str], on_batch) -> None:
    """Two runs of one stream over the same checkpoint, the second with the files added since."""
    checkpoint = scratch(spark, "stream")
    for step in (0, 1):
        source = spark.readStream.schema(EVENT_SCHEMA).parquet(write(step))
        J.run_stream(source, on_batch, checkpoint).awaitTermination()


@query
def st3_emit_if_newer(spark: SparkSession, root: str) -> DataFrame:
    """ST3: the last version passed on per key."""
    store = Store(spark, scratch(spark, "state"))
    _run_twice(spark, _shuffled_events(spark, root), J.emit_if_newer(store, "seen", EVENT_KEY, "ts"))
    return store.read("seen", EVENT_KEY).select("user_id", "event_id", "event_type", "value")


@query
def st4_cdc_keys(spark: SparkSession, root: str) -> DataFrame:
    """ST4, S10: change envelopes of patients and encounters -> their patients."""
    t = clinical_tables(spark, root)

    def envelope(name: str, columns: list[str], key: str) -> DataFrame:
        row = F.struct(*columns)
        gone = F.col(key) % 10 == 9
        op = F.when(gone, "d").otherwise("u")
        before, after = F.when(gone, row), F.when(~gone, row)
        source = F.struct(F.lit(name).alias("table"))
        doc = F.struct(op.alias("op"), F.lit(1).alias("ts_ms"), source.alias("source"), before.alias("before"), after.alias("after"))
        return t[name].select(F.to_json(doc).alias("value"))

    events = envelope("patient_openmrs", ["mspp_code", "patient_id", "voided"], "patient_id").unionByName(
        envelope("encounter_openmrs", ["mspp_code", "encounter_id", "patient_id"], "encounter_id")
    )
    keys = envelope_keys(parse_envelope(events))
    return keys.groupBy("mspp_code", "patient_id").agg(F.count("*").alias("changes"))


@query
def s10_changes(spark: SparkSession, root: str) -> DataFrame:
    """Change files in no order, raw and unwrapped envelopes among them, read two files at a time; the row after each."""
    events, k = base_table(spark, root, "events"), F.col("event_id")
    row = F.struct(k, "user_id", "event_type")
    gone, op = k % 10 == 9, F.when(k % 10 == 9, "d").otherwise("u")
    source, at = F.struct(F.lit("events").alias("table")), 1000 * F.unix_seconds(F.col("ts").cast("timestamp"))
    raw = F.to_json(F.struct(op.alias("op"), at.alias("ts_ms"), source.alias("source"), F.when(gone, row).alias("before"), F.when(~gone, row).alias("after")))
    flat = F.to_json(
        F.struct(k, "user_id", "event_type", op.alias("__op"), at.alias("__ts_ms"), F.lit("events").alias("__table"), gone.cast("string").alias("__deleted"))
    )
    store, last = Store(spark, scratch(spark, "changes")), None
    for name, text, mine in (("raw", raw, k % 2 == 0), ("flat", flat, k % 2 == 1)):
        folder = scratch(spark, name)
        events.filter(mine).repartition(6, k).select(text.alias("value")).write.text(folder)
        parsed = parse_envelope(read_changes(spark, folder, maxFilesPerTrigger="2"), wrapped=name == "raw")
        rows = parsed.select(member("event_id").cast("bigint").alias("event_id"), "tbl", "op", "ts", member("event_type").alias("event_type"))
        J.run_stream(rows, lambda batch, n, name=name: store.upsert(name, batch, ["event_id"], n + 1) and None, scratch(spark, "stream")).awaitTermination()
        part = store.read(name, ["event_id"])
        last = part if last is None else last.unionByName(part)
    return last


@query
def st5_distinct_keys(spark: SparkSession, root: str) -> DataFrame:
    """ST5"""
    store = Store(spark, scratch(spark, "keys"))
    _run_twice(spark, _shuffled_events(spark, root), J.distinct_batch_keys(store, "keys", EVENT_KEY))
    return store.read("keys", EVENT_KEY).select("user_id")


@query
def st7_cdc_apply(spark: SparkSession, root: str) -> DataFrame:
    """ST7: the mirror after all change events, some late."""
    mirror = Store(spark, scratch(spark, "cdc"))
    _run_twice(spark, _shuffled_events(spark, root), J.apply_cdc(mirror, "rows", EVENT_KEY, ["ts", "event_id"], "ts"))
    return J.live_rows(mirror, "rows", EVENT_KEY).select("user_id", "event_id", "event_type", "value")


@query
def st6_push_changed(spark: SparkSession, root: str) -> DataFrame:
    """ST6, ST4, S10: change events of encounters since July 1998, as a stream of files -> full bundles of their patients.

    The mirror is clustered by patient and indexed, so the batch reads the folders of those patients only.
    """
    t, since = clinical_tables(spark, root), F.lit(datetime(1998, 7, 1))
    mirror, store = clustered_store(spark, scratch(spark, "clustered"), buckets=16), Store(spark, scratch(spark, "changed"))
    results, _ = sync_all(t, mirror, S)
    if failed := [r for r in results if r.error]:
        raise RuntimeError(f"tables not copied: {failed}")
    source = F.struct(F.lit("encounter_openmrs").alias("table"))
    event = F.struct(F.lit("u").alias("op"), F.lit(1).alias("ts_ms"), source.alias("source"), F.struct("mspp_code", "encounter_id", "patient_id").alias("after"))
    folder = scratch(spark, "events")
    t["encounter_openmrs"].filter(F.col("encounter_datetime") >= since).select(F.to_json(event).alias("value")).write.text(folder)
    J.run_stream(parse_envelope(read_changes(spark, folder)), J.push_changed(lambda: mirror, store, S), scratch(spark, "stream")).awaitTermination()
    return _entries(store.read("outbox_bundles")).select("lead_url", F.col("e.request.url").alias("url"))


@query
def st1_cycle(spark: SparkSession, root: str) -> DataFrame:
    """ST1, ST2, ST8, C7, K5, DL1-DL9: two cycles driven by a stream, over the mirror and all views, the source edited in
    between; the push state."""
    t = clinical_tables(spark, root)
    s = Settings(incremental=True)
    visits = t["visit_openmrs"]
    never = F.lit(None).cast("timestamp_ntz")
    early = visits.withColumn("date_changed", never).withColumn("date_updated", never).withColumn("voided", F.lit(0))
    turns = iter([Tables(lambda n: early if n == "visit_openmrs" else t[n], list(t)), t])
    mirror, store = Store(spark, scratch(spark, "mirror")), Store(spark, scratch(spark, "cycle"))
    on_batch = J.cycle_batch(lambda: next(turns), mirror, store, s, lambda: datetime(2026, 1, 1))
    _run_twice(spark, _shuffled_events(spark, root), on_batch)
    return state_of(store).select("resource_type", "fhir_id", when_changed())
