"""Scans and keyed fetches."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinweave.sources.contracts import CONTRACTS, conform, struct_of

SEED_SCHEMA = struct_of("identifier_type bigint, system string, label string")
SEED_PATH = Path(__file__).resolve().parent.parent / "seeds" / "identifier_systems.csv"


class Tables(Mapping):
    """Tables by name, each built on first use."""

    def __init__(self, load: Callable[[str], DataFrame], names: Sequence[str]):
        self._load, self._names, self._seen = load, list(names), {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._names:
            raise KeyError(name)
        if name not in self._seen:
            self._seen[name] = self._load(name)
        return self._seen[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)


def spread(df: DataFrame) -> DataFrame:
    """Deal a table that was read in fewer tasks than there are cores over all of them.

    Building documents is heavy per row, and a file with one row group is one task. A large table has many
    splits and is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def read_source(spark: SparkSession, root: str, table: str) -> DataFrame:
    """One source table as Parquet under `root`, typed by its contract."""
    return conform(spark.read.parquet(f"{root}/{table}"), table)


def read_jdbc(
    spark: SparkSession, url: str, table: str, split: str, bounds: tuple[int, int], parts: int, **options: str
) -> DataFrame:
    """One source table over JDBC, read in `parts` ranges of the numeric column `split`."""
    reader = spark.read.format("jdbc").options(
        url=url, dbtable=table, partitionColumn=split, lowerBound=bounds[0], upperBound=bounds[1], numPartitions=parts
    )
    return conform(reader.options(**options).load(), table)


def source_tables(spark: SparkSession, root: str) -> Tables:
    return Tables(lambda name: read_source(spark, root, name), list(CONTRACTS))


def load_seed(spark: SparkSession, path: str | None = None, schema: T.StructType = SEED_SCHEMA) -> DataFrame:
    """S5, MT1: the identifier-type seed. The packaged file is read here, as executors may not see it."""
    if path is not None:
        return spark.read.schema(schema).option("header", True).csv(path)
    lines = SEED_PATH.read_text().splitlines()[1:]
    rows = [(int(kind), system, label) for kind, system, label in (line.split(",") for line in lines)]
    return spark.createDataFrame(rows, schema)


def key_version(df: DataFrame, key: Sequence[str], version: Column) -> DataFrame:
    """S3: only the key and the version of every row."""
    return df.select(*key, version.alias("version"))


def distinct_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """A10"""
    return df.select(*key).distinct()


def by_keys(df: DataFrame, keys: DataFrame, key: Sequence[str], how: str = "left_semi") -> DataFrame:
    """Rows whose key is among `keys` (left_anti: is not). A null part equals a null part."""
    keys = keys.select(*[F.col(k).alias(f"_k_{k}") for k in key])
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in key]
    return df.join(keys, same, how)


fetch_by_keys = by_keys  # S4


def only_left(a: DataFrame, b: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of `a` whose key is not in `b`."""
    return by_keys(a, b, key, "left_anti")


def fetch_patients(patient: DataFrame, keys: DataFrame) -> DataFrame:
    """S6"""
    return by_keys(patient.select("fhir_id", "resource"), keys, ["fhir_id"])


def union_views(views: Mapping[str, DataFrame], names: Sequence[str], columns: Sequence[str]) -> DataFrame | None:
    """U4: the named views under each other with their name as `view`; a missing view is left out.

    A view that is there but lacks a column is an error.
    """
    out = None
    for name in names:
        if name not in views:
            continue
        part = views[name].select(F.lit(name).alias("view"), *columns)
        out = part if out is None else out.unionByName(part)
    return out


def fetch_clinical(views: Mapping[str, DataFrame], names: Sequence[str], keys: DataFrame) -> DataFrame | None:
    """All clinical rows of the given patients (`keys` holds patient_fhir_id)."""
    rows = union_views(views, names, ["fhir_id", "patient_fhir_id", "resource", "changed_at"])
    return None if rows is None else by_keys(rows, keys, ["patient_fhir_id"])


def read_globals(views: Mapping[str, DataFrame], names: Sequence[str]) -> DataFrame | None:
    """S8"""
    return union_views(views, names, ["fhir_id", "resource"])


def column_exists(df: DataFrame, name: str) -> bool:
    """From the schema, without a query."""
    return name in df.columns


def drifted(src: DataFrame, dst: DataFrame) -> bool:
    """Whether the column sets differ; order does not matter."""
    return set(src.columns) != set(dst.columns)
