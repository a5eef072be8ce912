"""Resource tables (MT1-MT3, K5, Q1-Q3, Q7)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinweave.operators.quality import fanout, not_null, observation_has_subject, patient_has_identifier, valid_fhir_id
from clinweave.operators.upsert import dedup, newest_first
from clinweave.plans.models import MODELS, to_table
from clinweave.session import in_parallel, release
from clinweave.settings import Settings
from clinweave.sources.snapshots import Store

KEY = ("fhir_id",)


def one_per_key(df: DataFrame, grain: Sequence[str]) -> DataFrame:
    """MT3: sites that share a uuid collide on the id (T13); the latest change wins, then the lowest grain."""
    owner = [c for c in ("patient_fhir_id",) if c in df.columns]
    # the time again, as a column: rows and their times are told without their documents
    return dedup(df, KEY, [newest_first(), "changed_at", *grain, *owner, "resource"], heavy="resource")


def materialize(store: Store, name: str, df: DataFrame, s: Settings) -> DataFrame:
    """MT2, MT3: write one model and return what the table holds now."""
    model = MODELS[name]
    rows = to_table(df)
    if model.kind == "full":
        store.overwrite(name, rows)
        return store.read(name)
    rows = one_per_key(rows, model.grain)
    if s.materialize_mode == "upsert" and store.exists(name):
        store.upsert(name, rows, KEY)
    else:
        store.overwrite(name, rows)
    return store.read(name, KEY)


def transform(t: Mapping[str, DataFrame], store: Store, s: Settings) -> dict[str, DataFrame]:
    """The patient model and the configured views. They read only sources and the seed, never each other."""
    names = [n for n in MODELS if n == "patient" or n in (*s.clinical_views, *s.global_views)]
    built = in_parallel(lambda name: materialize(store, name, MODELS[name].build(t, s), s), names, s.parallel)
    release(store.spark)
    return dict(zip(names, built, strict=True))


def views_of(store: Store) -> dict[str, DataFrame]:
    """The resource tables written so far."""
    return {name: store.read(name, KEY) for name in MODELS if store.exists(name)}


def audits(views: Mapping[str, DataFrame], s: Settings) -> dict[str, DataFrame]:
    """The declared audits of every view that is there: audit name -> violations."""
    out = {}
    for name, df in views.items():
        model = MODELS[name]
        if model.not_null:
            out[f"{name}.not_null"] = not_null(df, model.not_null)
        out[f"{name}.valid_fhir_id"] = valid_fhir_id(df)
        if name != "location":
            out[f"{name}.fanout"] = fanout(df, KEY)
    if "patient" in views:
        out["patient.has_identifier"] = patient_has_identifier(views["patient"], s)
    if "observation" in views:
        out["observation.has_subject"] = observation_has_subject(views["observation"], s)
    return out


def content_hash(df: DataFrame) -> DataFrame:
    """A digest of the document, for changes that changed_at does not show."""
    return df.withColumn("content_hash", F.md5("resource"))
