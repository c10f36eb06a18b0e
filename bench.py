"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8). Each query runs once on
the smallest tables to warm up (where they are) and once timed; results go to the no-op sink,
so nothing is collected.
"""

from __future__ import annotations

import json
import os
import sys
import time

from tallyforge.catalog import QUERIES
from tallyforge.session import build_session

HEADLINE = [
    "click_blank_counts", "cleaned_clicks", "churn_frequency", "session_lengths", "busiest_sessions",
    "user_feature_table", "missing_share_per_column", "choice_counts_of_all_columns",
    "languages_by_degree", "hours_by_satisfaction", "multi_hot_totals", "yearly_change_of_choices",
    "salary_by_gender_and_degree", "cleaned_messages", "tokenized_documents", "lemma_counts", "tf_idf_weights",
    "gain_by_income_and_dimension", "correlations_by_income", "min_max_scaled", "one_hot_columns", "label_report",
    "five_nearest_neighbours", "one_feature_line",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    small = os.path.join(os.path.dirname(folder.rstrip("/")), "sf0.001")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in sys.argv[1:] or HEADLINE:
        for tables in [small, folder] if os.path.isdir(small) else [folder]:
            start = time.perf_counter()
            QUERIES[name].run(spark, tables).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - start, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "headline_total_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": float(scale) if scale.replace(".", "").isdigit() else scale,
    }))


if __name__ == "__main__":
    main()
