"""Every registered query has reference SQL; the cheaper ones are compared here, all of them by the driver."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
from clinweave.checks.oracle import ORACLE
from clinweave.checks.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
CHEAP = (
    "s5_seed", "m1_fhir_id", "m3_synthetic_id", "m4_concept_code", "m6_fhir_datetime", "f19_merge_patch",
    "m9_change_version", "m10_row_hash", "tm1_preferred_name", "r1_location", "r2_encounter", "r3_visit", "r5_condition",
    "r7_medication_request", "r8e_phone", "r8f_mother", "r3_visit_json", "mt3_dedup", "q1_not_null",
    "q4_identifier_profile", "k4_split_valid", "c2_entry_diff", "c3_hash_diff", "c4_apply_diff", "dl1_pending", "rc6_due",
)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    return con


def test_names_agree():
    """Corpus queries, where they are present, may be beyond SQL; all others have some."""
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", CHEAP)
def test_query_against_sql(spark, duck, name):
    df = entry.queries()[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
    result = duck.execute(entry.oracle_sql()[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == columns
    want = sorted((tuple(r[names.index(c)] for c in columns) for r in result.fetchall()), key=repr)
    assert got == want
    assert got
