"""Time the headline queries. Prints one JSON line.

Each query is planned and run to the end once, on tables read from disk. A first
small query starts the session's Python workers and code generation, so that the
first timed query does not pay for them.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from hearthline.plans import load

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = [
    "s04_kpi_aggregate", "s16_size_gate", "a02_count_distinct", "a04_quantile_cuts", "a16_product_popularity",
    "w01_percent_rank", "d01_category_upc_lists", "d02_segment_reach", "d03_percentile_propensity",
    "d04_volume_propensity", "d07_regex_audiences", "d10_weekly_kpis", "d11_household_vintage",
    "d18_rank_pillars", "d21_lite_segments", "d22_household_segments", "d24_travelers", "d25_roadies",
    "d33_hierarchy_report", "h05_holiday_movers", "h09_recurring_holiday_items", "x02_top_words_per_group",
    "x04_extract_keywords_documents", "x09_condense_keywords", "x13_tag_by_keyword_table",
    "v02_embedding_search", "v04_nearest", "v11_density_clusters", "v14_calinski_harabasz", "v19_cluster_cohesion",
]


def session() -> SparkSession:
    spark = (SparkSession.builder.master(f"local[{CPUS}]").appName("bench")
             .config("spark.sql.shuffle.partitions", CPUS)
             .config("spark.driver.memory", "16g")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(df) -> None:
    """Compute every row without keeping any."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark, queries = session(), load().QUERIES
    run(queries["v02_embedding_search"](spark, FOLDER))
    times = {}
    for name in HEADLINE:
        began = time.time()
        run(queries[name](spark, FOLDER))
        times[name] = round(time.time() - began, 3)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": os.path.basename(FOLDER.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
