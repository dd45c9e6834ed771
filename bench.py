"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the data, BENCH_CPUS the local cores.
Every query is computed in full into a sink that keeps nothing.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from recordloom.plans import QUERIES  # noqa: E402
from recordloom.session import local_session  # noqa: E402

HEADLINE = [
    "s1_read_records", "s6_write_tables", "n2_normalize_keys", "p2_field_profile", "p2_document_profile", "p2_column_profile",
    "p3_field_profile_capped", "p4_sample_values", "p5_table_profile", "p6_structure_map", "p7_merge_profiles",
    "c1_document_targets", "c1_hysteresis", "r1_route_structured", "r1_route_documents", "r2_decompose_side",
    "r4_resolve_references", "r5_resolve_nested", "d1_shred", "d3_m2m_junction", "d5_verify_foreign_keys", "d6_reconstruct",
    "d6_reconstruct_all_depths", "a1_repeating_groups", "a2_nesting_paths", "a3_functional_dependencies",
    "a3_dependencies_any", "a5_recommend_keys", "a8_embed_or_reference_array", "q1_filter_structured",
    "q2_filter_documents_rows", "q8_count_preview", "j2_read_by_filter", "j3_federated_merge", "w1_insert_records",
    "w2_update_where", "w3_delete_where", "w5_validate_unique", "t1_latency_stats", "t4_active_sessions",
    "t7_pending_ops_to_apply", "t8_advance_op_state", "t11_reconcile_stores", "st1_adaptive_ingest", "st2_stream_profile",
    "st3_stream_sessions",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    # Untimed queries start the workers and warm the JVM.
    for name in ("q7_distinct_values", "p2_field_profile", "d1_shred"):
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
    spent = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        spent[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(spent.values()), 3), "unit": "sec", "queries": spent,
        "sf": Path(sf).name.removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
