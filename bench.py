"""Time the headline queries; print one JSON line.

Every query is computed in full and its rows are dropped (`noop` sink). Queries that write tables or run a
stream include that work.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from clinweave import session  # noqa: E402
from clinweave.checks.queries import QUERIES  # noqa: E402

HEADLINE = (
    "r1_location", "r2_encounter", "r3_visit", "r4_observation", "r5_condition", "r6_allergy",
    "r7_medication_request", "r8_patient", "tm1_preferred_name", "m1_fhir_id", "f19_merge_patch", "mt3_dedup",
    "mt3_upsert", "mt3_patient", "q4_identifier_profile", "k4_split_valid", "c2_entry_diff", "c3_hash_diff",
    "c4_apply_diff", "dl1_pending", "dl2_pages", "dl3_clinical_bundles", "dl4_tag", "rc3_orphans",
    "st3_emit_if_newer", "st7_cdc_apply",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = session(f"local[{cpus}]", "bench", spark__sql__shuffle__partitions=cpus, spark__driver__memory="16g")
    spark.read.parquet(f"{folder}/nation.parquet").count()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    total = round(sum(seconds.values()), 3)
    scale = Path(folder).name.removeprefix("sf")
    print(json.dumps({"metric": "total_query_time", "value": total, "unit": "sec", "queries": seconds, "sf": scale}))


if __name__ == "__main__":
    main()
