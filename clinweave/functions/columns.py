"""Column macros shared by the resource models."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinweave.functions.document import Arr, Obj, Opt, arr, obj
from clinweave.settings import EPOCH, Settings

# Audit columns that mark an insert or an edit, in the order they are looked for.
CHANGE_COLUMNS = ("date_updated", "date_changed", "date_created", "updated_at", "created_at")


def col_of(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ntz(value: datetime) -> Column:
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def epoch() -> Column:
    return ntz(EPOCH)


def fhir_id(c: Column | str) -> Column:
    """M1: a legal resource id; illegal characters become '-', an all-digit id gets the prefix 'id-'."""
    clean = F.regexp_replace(col_of(c).cast("string"), "[^A-Za-z0-9.-]", "-")
    return F.when(clean.rlike("^[0-9]+$"), F.concat(F.lit("id-"), clean)).otherwise(clean)


def synthetic_id(prefix: str, *parts: Column | str) -> Column:
    """M3: prefix + MD5 of the pipe-joined natural key; null parts are left out."""
    return F.concat(F.lit(prefix), F.md5(F.concat_ws("|", *[col_of(p).cast("string") for p in parts])))


def concept_code(uuid: Column | str, concept_id: Column | str) -> Column:
    """M4: the concept uuid, else its number padded with 'A' to 36 characters."""
    return F.coalesce(col_of(uuid), F.rpad(col_of(concept_id).cast("string"), 36, "A"))


def reference(kind: str, target: Column | str, typed: bool = False, display: Column | None = None) -> Obj:
    """M5: a literal reference, optionally with type and display. `target` is a sanitised id."""
    members = {"reference": F.concat(F.lit(f"{kind}/"), col_of(target))}
    if typed:
        members["type"] = kind
    if display is not None:
        members["display"] = display
    return obj(members)


def fhir_datetime(ts: Column | str) -> Column:
    """M6: a date-time as text with 'T' between date and time."""
    return F.date_format(col_of(ts), "yyyy-MM-dd'T'HH:mm:ss")


def site_tag(site: Column | str, s: Settings) -> Obj:
    return obj({"system": s.mspp_site_system, "code": col_of(site)})


def site_meta(site: Column | str, s: Settings, *tags: Obj) -> Obj:
    """M7: resource meta with the originating site as a tag."""
    return obj({"tag": arr(*tags, site_tag(site, s))})


def optional(when: Column, member: Obj | Arr | Column) -> Opt:
    """M8: a member that is present only when its source is."""
    return Opt(member, when)


def not_voided(c: Column | str = "voided") -> Column:
    """P1"""
    return F.coalesce(col_of(c), F.lit(0)) == 0


def code_in(c: Column | str, values: Sequence[str], s: Settings) -> Column:
    """Membership in a small code set."""
    if s.case_sensitive_codes:
        return col_of(c).isin(*values)
    return F.lower(col_of(c)).isin(*sorted({v.lower() for v in values}))


def non_empty(c: Column | str) -> Column:
    """P6"""
    return col_of(c).isNotNull() & (col_of(c) != "")


def not_junk(c: Column | str, blacklist: Sequence[str], lower: bool = False) -> Column:
    """Trimmed value is not on the blacklist."""
    value = F.trim(col_of(c))
    return ~(F.lower(value) if lower else value).isin(*blacklist)


def not_matching(c: Column | str, pattern: str) -> Column:
    """P5"""
    return ~col_of(c).rlike(pattern)


def latest_of(*cs: Column | str) -> Column:
    """First known change time of a row, else the epoch."""
    return F.coalesce(*[col_of(c) for c in cs], epoch())


def greatest_of(*cs: Column) -> Column:
    return cs[0] if len(cs) == 1 else F.greatest(*cs)


def change_version(df: DataFrame, columns: Sequence[str] = CHANGE_COLUMNS) -> Column | None:
    """M9: the most recent of the change columns the table has, or None when it has none."""
    present = [c for c in columns if c in df.columns]
    if not present:
        return None
    return greatest_of(*[F.coalesce(F.col(c).cast("timestamp_ntz"), epoch()) for c in present])


def row_hash(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """MD5 over all columns, null-safe."""
    parts = [F.coalesce(F.col(c).cast("string"), F.char(F.lit(0))) for c in (columns or df.columns)]
    return F.md5(F.concat_ws("\x1f", *parts))


def url_encode(c: Column | str) -> Column:
    """percent-encoding, with %20 for a space."""
    return F.replace(F.url_encode(col_of(c)), F.lit("+"), F.lit("%20"))


def elapsed_seconds(since: Column | str, now: Column) -> Column:
    """F23"""
    return F.timestamp_diff("SECOND", col_of(since), now)


def any_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def all_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)
