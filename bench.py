"""Times the headline queries and prints one JSON line.

Every query runs on its whole tables into Spark's no-op sink, so all its columns are
computed and nothing is collected. One small query runs first to start the session.
"""

import json
import os
import sys
import time

from grovekit.catalog import all_queries
from grovekit.session import local_session

HEADLINE = (
    # filtering and cleaning of samples
    "clean_metrics", "clean_samples", "clean_report", "statistical_filter", "iqr_filter", "describe",
    "exact_dedup", "take_n", "sample_per_file", "sequential_id", "quarter_bucket",
    # statistics
    "file_stats", "language_stats", "grouping_levels", "correlation", "boxplot_stats",
    # node tables and records
    "structure_nodes", "tag_depth", "parse_columns", "read_dump", "reparent", "pruned_tree",
    "universal_record", "convert_samples",
    # distributions
    "type_counts_documents", "type_entropy", "type_cosine", "type_pca", "average_linkage",
    # files and increments
    "write_language", "incremental_convert", "incremental_dedup",
)


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("bench", cores=cores, partitions=int(cores))
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    names = [n for n in HEADLINE if len(sys.argv) < 2 or n in sys.argv[1:]]
    queries["drop_columns"](spark, folder).write.format("noop").mode("overwrite").save()
    rows = spark.read.parquet(f"{folder}/documents.parquet").count()
    seconds = {}
    for name in names:
        started = time.time()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - started, 3)
    print(json.dumps({
        "metric": "headline queries, total wall time", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "documents": rows, "documents_per_sec": {n: round(rows / s) for n, s in seconds.items()},
    }))
    spark.stop()


if __name__ == "__main__":
    main()
