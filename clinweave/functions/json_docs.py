"""Operators on JSON text columns (F19-F21, DL4): merge patch, path tests, tags, status flags."""

from __future__ import annotations

import json
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clinweave.functions.columns import col_of
from clinweave.session import ship_package

VARIANT_MAP = "map<string,variant>"


def _members(text: Column) -> Column:
    return F.from_json(text, VARIANT_MAP)


def _bind(body: Callable[[Column], Column], **values: Column) -> Column:
    """`body` over a struct of the values, each computed once however often `body` uses it."""
    row = F.struct(*[v.alias(name) for name, v in values.items()])
    return F.element_at(F.transform(F.array(row), body), 1)


def merged(target: object, patch: object) -> object:
    """A patch (RFC 7396) laid over a target, both as Python values."""
    if not isinstance(patch, dict):
        return patch
    kept = target if isinstance(target, dict) else {}
    live = {name: merged(kept.get(name), value) for name, value in patch.items() if value is not None}
    return {name: value for name, value in kept.items() if name not in patch} | live


def _merge_texts(left: pd.Series, right: pd.Series) -> pd.Series:
    def one(target: str | None, patch: str | None) -> str | None:
        if target is None or patch is None:
            return None
        return json.dumps(merged(json.loads(target), json.loads(patch)), ensure_ascii=False, separators=(",", ":"))

    return pd.Series([one(a, b) for a, b in zip(left, right, strict=True)], dtype=object)


def json_merge_patch(left: Column | str, right: Column | str) -> Column:
    """merge patch of two JSON documents. Null members of the patch remove; objects merge; else replace.

    Objects merge at every depth, which no fixed nesting of built-in functions can say, so batches of both texts go to
    Python. Null when either text is; text that is no JSON is an error.
    """
    ship_package(SparkSession.active())
    return F.pandas_udf(_merge_texts, "string")(col_of(left), col_of(right))


def has_path(resource: Column | str, path: str, null_is_missing: bool = True) -> Column:
    """Q2, Q3: whether the document has the path; an explicit null counts as missing unless told otherwise."""
    found = F.try_variant_get(F.parse_json(col_of(resource)), path, "variant")
    present = found.isNotNull()
    if null_is_missing:
        present = present & ~F.is_variant_null(found)
    return F.coalesce(present, F.lit(False))


TAGS = "array<struct<system:string,code:string,display:string>>"


def tag_source(resource: Column | str, system: str, code: str) -> Column:
    """DL4: the document with the provenance tag in meta.tag; unchanged when the tag is there already."""
    text = col_of(resource)
    listed = F.get_json_object(text, "$.meta.tag")
    return _tagged(text, listed, _spliced_tag(text, listed, system, code), system, code)


def stamp_rows(df: DataFrame, resource: str, system: str, code: str, name: str) -> DataFrame:
    """DL4 over a table: `tag_source` as column `name`. Each intermediate is a column, so it is computed once."""
    df = df.withColumn("_listed", F.get_json_object(resource, "$.meta.tag"))
    df = df.withColumn("_spliced", _spliced_tag(F.col(resource), F.col("_listed"), system, code))
    out = _tagged(F.col(resource), F.col("_listed"), F.col("_spliced"), system, code)
    return df.withColumn(name, out).drop("_listed", "_spliced")


def _tagged(text: Column, listed: Column, spliced: Column, system: str, code: str) -> Column:
    there = F.exists(F.from_json(listed, TAGS), lambda t: (t["system"] == system) & (t["code"] == code))
    # Only a list that holds both values can hold the tag; that is cheaper to see than to parse.
    maybe = listed.contains(system) & listed.contains(code)
    return (
        F.when(F.coalesce(maybe, F.lit(False)) & F.coalesce(there, F.lit(False)), text)
        .when(spliced.isNotNull(), spliced)
        .otherwise(_rebuilt_tag(text, system, code))
    )


def _spliced_tag(text: Column, listed: Column, system: str, code: str) -> Column:
    """The stamp put at the end of the tag list as text; null where that is not certain to be right.

    An unescaped `"meta":` is always a member name. With exactly one of them in the document it is the
    resource's own, and the tag list is found behind it as it is written.
    """
    stamp = json.dumps({"system": system, "code": code}, separators=(",", ":"))
    start = '"meta":{"tag":'
    once = F.length(F.replace(text, F.lit('"meta":'), F.lit(""))) == F.length(text) - len('"meta":')
    longer = F.concat(F.lit(start), F.substring(listed, F.lit(1), F.length(listed) - 1), F.lit(f",{stamp}]"))
    spliced = F.replace(text, F.concat(F.lit(start), listed), longer)
    return F.when(once & (listed != "[]") & (spliced != text), spliced)


def _rebuilt_tag(text: Column, system: str, code: str) -> Column:
    """The stamp added to the parsed document, whatever its layout."""
    stamp = F.parse_json(F.to_json(F.struct(F.lit(system).alias("system"), F.lit(code).alias("code"))))
    no_meta, no_tags = F.expr(f"cast(map() as {VARIANT_MAP})"), F.expr("cast(array() as array<variant>)")

    def of_doc(d: Column) -> Column:
        meta = F.coalesce(_members(F.to_json(F.try_element_at(d["doc"], F.lit("meta")))), no_meta)
        return with_member(d["doc"], "meta", _bind(of_meta, meta=meta))

    def of_meta(m: Column) -> Column:
        listed = F.from_json(F.to_json(F.try_element_at(m["meta"], F.lit("tag"))), "array<variant>")
        tag = F.parse_json(F.to_json(F.concat(F.coalesce(listed, no_tags), F.array(stamp))))
        return F.parse_json(F.to_json(with_member(m["meta"], "tag", tag)))

    return F.to_json(_bind(of_doc, doc=_members(text)))


def with_member(doc: Column, name: str, value: Column) -> Column:
    """A member map with one member set."""
    return F.map_concat(F.map_filter(doc, lambda k, _: k != name), F.create_map(F.lit(name), value))


# The flag that marks a resource as withdrawn, and the types that carry it elsewhere.
ENTERED_IN_ERROR = "entered-in-error"
VERIFICATION_SYSTEMS = {
    "Condition": "http://terminology.hl7.org/CodeSystem/condition-ver-status",
    "AllergyIntolerance": "http://terminology.hl7.org/CodeSystem/allergyintolerance-verification",
}


def entered_in_error(resource: Column | str, type_aware: bool = False) -> Column:
    """RC4: the document flagged as withdrawn; null when it already is."""
    text = col_of(resource)
    doc = _members(text)
    flag = F.parse_json(F.lit(f'"{ENTERED_IN_ERROR}"'))
    out = F.when(
        ~F.coalesce(F.get_json_object(text, "$.status") == ENTERED_IN_ERROR, F.lit(False)),
        F.to_json(with_member(doc, "status", flag)),
    )
    if not type_aware:
        return out
    kind = F.get_json_object(text, "$.resourceType")
    done = F.get_json_object(text, "$.verificationStatus.coding[0].code") == ENTERED_IN_ERROR
    for name, system in VERIFICATION_SYSTEMS.items():
        status = f'{{"coding":[{{"system":"{system}","code":"{ENTERED_IN_ERROR}"}}]}}'
        flagged = F.to_json(with_member(doc, "verificationStatus", F.parse_json(F.lit(status))))
        out = F.when(kind == name, F.when(~F.coalesce(done, F.lit(False)), flagged)).otherwise(out)
    return out
