"""Headline queries on local cores; prints one JSON line.

``BENCH_SF_DIR`` (default sf0.1) and ``BENCH_CPUS`` (default 8) set input and cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lamella.plans import QUERIES  # noqa: E402
from lamella.session import build_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = (
    "inventory_scd_merge hits_flatten status_by_model status_pivot status_export pending_slides path_resolution matched_slides "
    "manifest_latest manifest_wide batch_sheet sample_sizes collated_batches rotating_batches size_or_time_batches "
    "claim_slides complete_batches retry_reset blacklist_upsert coverage_reset state_export "
    "merge_delete_missing merge_intersection latest_per_key throughput_eta job_rollup failure_classes "
    "shard_by_count shard_by_bytes shard_distribution unique_per_model done_all_models shard_roundtrip "
    "tile_grid tile_mask_join tile_class_shares artifact_fallback subsample_random subsample_equal patch_cap "
    "pool_mean_max class_prototypes zero_shot_label encode_tiles cast_half "
    "roc_auc avg_precision roc_pr_curves class_report bootstrap_ci linear_probe bag_probe benchmark_summary precision_delta "
    "stream_dedupe stream_throughput stream_batches status_sync"
).split()


def run(spark, name: str) -> float:
    """Seconds to build and fully compute a query without moving its rows to the driver."""
    start = time.perf_counter()
    QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = build_session("bench", f"local[{CPUS}]", **{
        "spark.sql.shuffle.partitions": CPUS, "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"), "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    run(spark, "count_by_status")
    times, failed = {}, {}
    for name in names:
        try:
            times[name] = round(run(spark, name), 3)
        except Exception as error:  # the other times still count
            failed[name] = f"{type(error).__name__}: {error}"[:300]
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"), **({"failed": failed} if failed else {})}))
    spark.stop()


if __name__ == "__main__":
    main()
