"""Time the headline queries: one JSON line on stdout.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.
"""
from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "d1_daily_sales", "d4_sales_summary", "d21_daily_matrix", "d28_summary_view", "c1_coverage_tables", "c15_concept_table",
    "c25_monthly_year_coverage", "e7_stock_out_view", "e12_capital_abc", "e16_days_of_cover", "g2_rfm_segments", "g3_rfm_summary",
    "g5_churn", "g7_retention", "g9_growth_bridge", "g11_concentration", "h4_seasonality", "h6_forecast", "h9_anomalies", "i4_abc_xyz",
    "i7_penetration", "i9_brand_rules", "j2_margin_table", "j5_discount_waterfall", "j6_discount_outliers", "j8_dispersion_ranking",
    "k2_service_level", "k4_rejection_table", "k5_return_rates", "k6_route_table", "m5_split_block", "n2_collapse", "n9_frame_diff",
]


def main() -> None:
    from pyspark.sql import SparkSession

    from retail_analytics.plans import load_all

    cpus = os.environ.get("BENCH_CPUS", "8")
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("retail_analytics_bench")
             .config("spark.sql.shuffle.partitions", cpus).config("spark.ui.enabled", "false").config("spark.driver.memory", "12g")
             .config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    reg = load_all()
    reg["d4_sales_summary"].run(spark, sf_dir).count()          # JVM warm-up
    times: dict[str, float] = {}
    for name in HEADLINE:
        t = time.time()
        reg[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
