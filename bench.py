"""Bench: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is forced with the no-op sink (full computation, nothing collected).  Before each
timing the session's caches are cleared and its staged files deleted, so no query profits
from another.  ``end_to_end`` runs the whole flow on the ``lines`` view: publish the source
topic, snapshot it, parse once, publish the three ordered topics.  ``generated_flow`` runs the
flow from generation on, over 10 x |orders| records (outside the headline total).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["parse_valid", "publish_source", "sort_by_id", "sort_by_name", "sort_by_continent",
            "bucket_order", "sort_all_keys", "publish_sorted", "check_sorted", "check_conserved"]


def main() -> None:
    from sortpub.plans import end_to_end, views
    from sortpub.plans.queries import QUERIES
    from sortpub.session import drop_scratch, local_session, scratch_path

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="sortpub-bench")
    spark.sparkContext.setLogLevel("ERROR")
    # warm-up: JVM, file listing, codegen caches
    QUERIES["parse_valid"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    def fresh() -> float:
        spark.catalog.clearCache()
        drop_scratch(spark)
        return time.time()

    times: dict[str, float] = {}
    for name in HEADLINE:
        t0 = fresh()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)

    t0 = fresh()
    res = end_to_end.run(spark, views.lines(spark, sf_dir), scratch_path(spark, "bench_e2e"),
                         order=["o_orderkey"])
    times["end_to_end"] = round(time.time() - t0, 3)
    records = res["publish"]["sent"]

    # The flow from generated records on (generate -> line files with header -> source topic ->
    # three ordered topics), sized from the given orders table, for a records/s figure to set
    n_gen = 10 * views.table(spark, sf_dir, "orders").count()
    t0 = fresh()
    end_to_end.run_generated(spark, n_gen, scratch_path(spark, "bench_gen"))
    gen_secs = time.time() - t0
    print(json.dumps({
        "metric": "headline_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
        "end_to_end_records": records,
        "end_to_end_records_per_sec": round(records / max(times["end_to_end"], 1e-9), 1),
        "generated_flow": {"records": n_gen, "sec": round(gen_secs, 3),
                           "records_per_sec": round(n_gen / max(gen_secs, 1e-9), 1)},
    }))
    drop_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
