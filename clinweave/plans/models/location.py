"""Locations -> Location. Global: no site, no change time."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinweave.functions.columns import fhir_id
from clinweave.functions.document import obj, render
from clinweave.plans.models.parts import address_extension
from clinweave.settings import Settings


def build_location(t: Mapping[str, DataFrame], s: Settings) -> DataFrame:
    places = t["locations"].filter(F.col("value_reference").isNotNull())
    places = places.withColumn("fhir_id", fhir_id("value_reference"))
    document = obj(
        {
            "resourceType": "Location",
            "id": F.col("fhir_id"),
            "name": F.col("name"),
            "status": F.when(F.coalesce("active", F.lit(1)) == 1, "active").otherwise("inactive"),
            "address": obj(
                {
                    "extension": address_extension(address3=F.col("address3")),
                    "city": F.col("city_village"),
                    "state": F.col("state_province"),
                }
            ),
        }
    )
    return places.select("fhir_id", render(document, s.nulls).alias("resource"))
