"""One row per key as DataFrame operators (MT3, ST3)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinweave.functions.columns import epoch


def newest_first(changed: str = "changed_at") -> Column:
    """Sort value that is smallest for the latest change; an unknown time comes last."""
    age = F.timestamp_diff("MICROSECOND", F.col(changed), epoch())
    return F.coalesce(age, F.lit(2**62))


def dedup(df: DataFrame, key: Sequence[str], order: Sequence[Column | str], heavy: str | None = None) -> DataFrame:
    """MT3: one row per key, the first by `order`.

    An aggregate, not a window: copies of a key are reduced before the shuffle, so a key with many copies
    sends one row per task. Where no column from `heavy` of the order on is asked for, none is built or moved.
    """
    return _one_row(df, key, order, F.min, heavy)


def latest_per_key(df: DataFrame, key: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key, the last by `order`."""
    return _one_row(df, key, order, F.max)


def _one_row(
    df: DataFrame, key: Sequence[str], order: Sequence[Column | str], pick: Callable[[Column], Column], heavy: str | None = None
) -> DataFrame:
    """The row that `pick` chooses by `order`.

    Rank and row are one struct that holds every column once: a document that is part of the order is not moved twice. The
    key is the group's own, so where only keys are asked for the documents are neither built nor moved. The order up to
    `heavy` also stands by itself: whichever row is chosen holds these values, so they do not depend on the rest.
    """
    if any(kind in f.dataType.simpleString() for f in df.schema for kind in ("map<", "variant")):
        # no order of their own: they stand beside the rank
        by = F.min_by if pick is F.min else F.max_by
        grouped = df.groupBy(*[F.col(k).alias(f"_k_{k}") for k in key]).agg(by(F.struct(*df.columns), F.struct(*order)).alias("_row"))
        return grouped.select("_row.*")
    names = {o: f"_o{i}" for i, o in enumerate(order) if isinstance(o, str)}
    ranked = [(F.col(o) if isinstance(o, str) else o).alias(f"_o{i}") for i, o in enumerate(order)]
    rest = [c for c in df.columns if c not in key and c not in names]
    row = F.struct(*ranked, *[F.col(c).alias(f"_r_{c}") for c in rest])
    light = 0 if heavy is None else [o if isinstance(o, str) else None for o in order].index(heavy)
    first = [pick(F.struct(*ranked[:light])).alias("_rank")] if light else []
    grouped = df.groupBy(*[F.col(k).alias(f"_k_{k}") for k in key]).agg(*first, pick(row).alias("_row"))
    by_rank = {f"_o{i}" for i in range(light)}
    from_row = {**{c: F.col("_rank" if n in by_rank else "_row")[n] for c, n in names.items()}, **{c: F.col("_row")[f"_r_{c}"] for c in rest}}
    return grouped.select(*[F.col(f"_k_{c}").alias(c) if c in key else from_row[c].alias(c) for c in df.columns])
