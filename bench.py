"""Benchmark: layer builds + headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line: {"metric", "value", "unit", "queries": {name: sec}, "sf", ...}.

The silver and gold layers are built once and cut from their lineage with a
reliable checkpoint (the medallion edges), each timed as its own entry; every
headline query then runs to completion into the ``noop`` sink (all rows
produced, nothing collected to the driver).
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "country_master", "competition_by_country", "gold_market_summary", "gold_country_kpis", "gold_cpv_analysis",
    "spend_pareto_country", "top_pct_concentration", "cumulative_curve", "savings_summary",
    "competition_savings_corr", "dominant_buyer", "buyer_profile", "opportunity_quadrant", "size_tiers",
    "value_brackets", "can_cn_ratio", "daily_counts", "check_summary", "gold_smoke", "award_kpis",
    "qq1_top_award_countries", "tokenize", "vocabulary_idf", "nb_predict", "nb_metrics", "similar_topk",
    "supplier_history", "bid_features", "ranking_metrics", "events_daily", "daily_counts_stream",
    "bronze_notices", "lot_winner",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from pyspark.sql import SparkSession
    builder = (SparkSession.builder.master(f"local[{cpus}]").appName("tenderlake-bench")
               .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.shuffle.partitions", str(max(8, int(re.sub(r"\D", "", cpus) or 8) * 2)))
               .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "16g"))
               .config("tenderlake.materialize", "true"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.sparkContext.getCheckpointDir() and not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tenderlake-bench-"))

    from tenderlake import registry
    from tenderlake.context import Lake

    qs = registry.queries()
    lake = Lake.get(spark, sf_dir, materialize=True)
    timings: dict[str, float] = {}

    t = time.time()
    for name in ["organisations", "notices", "lots", "lot_results", "contracts", "cpv_codes", "tendering_parties",
                 "tenders"]:
        lake.silver(name)
    timings["build_silver"] = round(time.time() - t, 3)
    t = time.time()
    for name in ["gold_notices", "gold_lots", "gold_awards", "gold_opportunities", "gold_notice_awards"]:
        lake.gold(name)
    timings["build_gold"] = round(time.time() - t, 3)

    failed = {}
    for name in HEADLINE:
        if name not in qs:
            continue
        t = time.time()
        try:
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            timings[name] = round(time.time() - t, 3)
        except Exception as e:  # noqa: BLE001 - report and keep benchmarking the rest
            failed[name] = f"{type(e).__name__}: {str(e)[:200]}"
    total = round(sum(timings.values()), 3)
    sf = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_wall_time", "value": total, "unit": "sec", "queries": timings,
                      "sf": float(sf.group(1)) if sf else sf_dir, "cpus": cpus,
                      "n_queries": len(timings), "failed": failed}))


if __name__ == "__main__":
    main()
