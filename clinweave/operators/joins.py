"""Join shapes of the resource models.

No size hints here: Catalyst broadcasts a side whose measured size is below the session's threshold, and
AQE does the same at run time and splits skewed partitions of the larger side.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPREAD = 256


def lookup(fact: DataFrame, side: DataFrame, on: Mapping[str, str], spread: Sequence[str] = ()) -> DataFrame:
    """Left join on `fact` column -> `side` column; the side's key columns are dropped.

    `spread` names fact columns that tell rows apart. Rows with a null key match nothing, yet would all
    meet in one partition; a number derived from those columns sends them to many.
    """
    keys = [f"_k{i}" for i in range(len(on))]
    side = side.withColumnsRenamed(dict(zip(on.values(), keys, strict=True)))
    same: list[Column] = [F.col(f) == F.col(k) for f, k in zip(on, keys, strict=True)]
    drop = list(keys)
    if spread:
        unknown = F.coalesce(*[F.when(F.col(f).isNull(), F.lit(True)) for f in on], F.lit(False))
        salt = F.when(unknown, F.pmod(F.xxhash64(*spread), F.lit(SPREAD)).cast("int") + 1).otherwise(F.lit(0))
        fact = fact.withColumn("_salt_l", salt)
        # 0 for every row, yet no literal: the optimiser would put that into the condition and join by the keys alone,
        # with all null keys in one partition again
        side = side.withColumn("_salt_r", F.pmod(F.xxhash64(*keys), F.lit(1)).cast("int"))
        same.append(F.col("_salt_l") == F.col("_salt_r"))
        drop += ["_salt_l", "_salt_r"]
    return fact.join(side, same, "left").drop(*drop)


def with_person(fact: DataFrame, person: DataFrame, key: str) -> DataFrame:
    """Keep facts whose person exists at the same site and add its columns."""
    person = person.withColumnsRenamed({"mspp_code": "_site", "person_id": "_person"})
    same = [F.col("mspp_code") == F.col("_site"), F.col(key) == F.col("_person")]
    return fact.join(person, same, "inner").drop("_site", "_person")


def with_child(fact: DataFrame, child: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add a child that was aggregated to the fact's grain."""
    return fact.join(child, list(keys), "left")
