"""Child rows collected per parent (A1-A3).

An array column lives in one row, so a group must fit in one row. Groups above `limit` are cut into pages
by a hash of their order columns, and the parent continues in one more resource per page; nothing is
dropped. The oversized groups are found by a count that is combined before the shuffle. There are at most
(rows / limit) of them, which bounds the broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def oversized(df: DataFrame, keys: Sequence[str], limit: int, name: str = "pages") -> DataFrame:
    """Groups with more than `limit` rows and the number of pages each needs."""
    counted = df.groupBy(*keys).agg(F.count("*").alias("_rows")).filter(F.col("_rows") > limit)
    return counted.select(*keys, F.ceil(F.col("_rows") / limit).cast("int").alias(name))


def page_of(pages: Column, *spread: Column) -> Column:
    """Page of a row in a group of `pages` pages (null = one page)."""
    return F.when(pages.isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64(*spread), pages).cast("int"))


def collect_children(
    df: DataFrame,
    keys: Sequence[str],
    value: Column,
    order: Sequence[Column],
    changed: Column,
    limit: int | None,
) -> DataFrame:
    """keys, page, pages, arr (ordered by `order`), chg (latest change of the page)."""
    keys = list(keys)
    entry = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], value.alias("v"))
    rows = df.filter(F.col(keys[-1]).isNotNull())
    tail: list[Column] = [F.lit(0).alias("page"), F.lit(1).alias("pages")]
    if limit is not None:
        rows = rows.join(F.broadcast(oversized(rows, keys, limit)), keys, "left")
        tail = [page_of(F.col("pages"), *order).alias("page"), F.coalesce("pages", F.lit(1)).alias("pages")]
    rows = rows.select(*keys, *tail, entry.alias("_e"), changed.alias("_c"))
    grouped = rows.groupBy(*keys, "page").agg(
        F.max("pages").alias("pages"), F.sort_array(F.collect_list("_e")).alias("_l"), F.max("_c").alias("chg")
    )
    return grouped.select(*keys, "page", "pages", F.transform("_l", lambda e: e["v"]).alias("arr"), "chg")


def paged_id(base: Column, page: Column) -> Column:
    """Id of a page of a resource: the resource's own id for the first."""
    return F.when(page > 0, F.concat(base, F.lit("-more-"), page.cast("string"))).otherwise(base)


def pick_one(df: DataFrame, keys: Sequence[str], value: Column, how: str, name: str) -> DataFrame:
    """A3: the smallest or largest value per key."""
    pick = F.min if how == "min" else F.max
    return df.groupBy(*keys).agg(pick(value).alias(name))


def latest(df: DataFrame, keys: Sequence[str], changed: Column, name: str) -> DataFrame:
    """A2"""
    return df.groupBy(*keys).agg(F.max(changed).alias(name))
