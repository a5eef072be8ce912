"""From raw documents to token digests: toxic documents, exact copies, near copies and benchmark leaks go; the rest is
encoded and decoded.

`run(spark, sf_dir)` applies the stages to documents. Each stage's rows are written as Parquet to the shared folder and
read again as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clinweave.llm.byte_bpe import encode_decode
from clinweave.llm.decontaminate import find_items
from clinweave.llm.exact_dedup import drop_exact_duplicates
from clinweave.llm.near_dup import near_duplicates
from clinweave.llm.queries import toxic_model
from clinweave.llm.shared import written
from clinweave.llm.toxicity import toxicity


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model scores below one half; the others go. Learned from labels not held out."""
    return toxicity(docs, toxic_model(spark, sf_dir, docs)).where("predicted = 0").select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of equal texts: the one with the largest doc_id."""
    return drop_exact_duplicates(docs, keep="largest")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies: five-word shingles, similarity 0.8, the smallest doc_id."""
    gone = near_duplicates(docs).where("not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return find_items(docs, benchmark).where("not contaminated").select(*docs.columns)


def code_bytes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of ids and decoded bytes."""
    return encode_decode(docs, digest=True, remember=100_000)  # the workers also hold what earlier stages left


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("decontamination", drop_leaks),
    ("byte bpe", code_bytes),
]

#: A trained model and a tokenizer cannot be told in SQL; tests compare run() with a plain version of all stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
