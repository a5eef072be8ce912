"""Concept names and codes (TM1, A4, P7)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinweave.functions.columns import not_voided
from clinweave.settings import Settings


def preferred_only(df: DataFrame) -> DataFrame:
    """P7"""
    return df.filter((F.col("locale_preferred") == 1) & not_voided())


def _best_name(s: Settings, locale: str) -> Column:
    spoken = F.col("locale") if s.case_sensitive_codes else F.lower("locale")
    wanted = locale if s.case_sensitive_codes else locale.lower()
    return F.coalesce(F.max(F.when(spoken == wanted, F.col("name"))), F.max("name"))


def preferred_concept_name(t: Mapping[str, DataFrame], s: Settings, locale: str = "en") -> DataFrame:
    """TM1: one name per concept, in `locale` if there is one, else any preferred name."""
    names = preferred_only(t["concept_name"])
    return names.groupBy("concept_id").agg(_best_name(s, locale).alias("name"))


def concept_labels(t: Mapping[str, DataFrame], s: Settings, locale: str = "en") -> DataFrame:
    """Uuid, class and preferred name per concept in one grouping, so that a fact joins it once per use.

    A concept may have a name and no row in `concept`, or the other way round; both keep what they have.
    """
    known = t["concept"].select(
        "concept_id", "uuid", "class_id", F.lit(None).cast("string").alias("name"),
        F.lit(None).cast("string").alias("locale"),
    )
    named = preferred_only(t["concept_name"]).select(
        "concept_id", F.lit(None).cast("string").alias("uuid"), F.lit(None).cast("int").alias("class_id"),
        "name", "locale",
    )
    return (
        known.unionByName(named)
        .groupBy("concept_id")
        .agg(F.max("uuid").alias("uuid"), F.max("class_id").alias("class_id"), _best_name(s, locale).alias("name"))
    )


def labels_as(labels: DataFrame, prefix: str, *columns: str) -> DataFrame:
    """The label columns under a prefix, keyed by `<prefix>_concept`."""
    return labels.select(
        F.col("concept_id").alias(f"{prefix}_concept"), *[F.col(c).alias(f"{prefix}_{c}") for c in columns]
    )
