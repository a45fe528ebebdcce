"""Times the headline queries: one JSON line. BENCH_SF_DIR, BENCH_CPUS."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cityloom.session import get_session  # noqa: E402
from workload.queries import QUERIES  # noqa: E402

HEADLINE = (
    "src_xml_nodes", "src_csv_roundtrip", "poi_categorised", "incidents_latlon", "listings_clean", "poi_dense_id",
    "dist_haversine", "near_pairs", "near_pairs_unblocked", "near_summary", "near_counts", "contingency_all",
    "chi2_all", "chi2_petty", "knn_neighbourhood", "knn_accuracy", "lloyd_5", "kmeans_ml", "nearest_listing",
    "category_scaled_share", "density_hist", "density_kde",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Start the JVM's and the Python gateway's machinery before the clock does.
    QUERIES["poi_categorised"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
