"""File, language and overall statistics."""

from functools import reduce
from itertools import combinations

from pyspark.sql import functions as F

from grovekit.fixed import LINE_BUCKETS
from grovekit.operators.bounded import key_join
from grovekit.operators.quantiles import column_value_counts, describe_counts, value_counts

WEIGHTED_MEANS = (
    "mean_line_count", "mean_ast_nodes", "mean_line_length",
    "mean_node_density", "mean_errors", "zero_error_ratio",
)


def metrics_report(df, by):
    """Rows and means of the two line metrics."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.avg("line_count").alias("avg_line_count"),
        F.avg("avg_line_length").alias("avg_avg_line_length"),
    )


def describe_columns(df, by, columns):
    """Long summary table: one row per key and column, all columns from one scan."""
    return describe_counts(column_value_counts(df, by, columns), [*by, "column"])


def line_bucket_index(column):
    """Position of a line count in the histogram, upper bounds included."""
    return F.least(F.lit(10), F.greatest(F.lit(0), F.ceil(F.col(column) / 100) - 1)).cast("int")


def line_buckets(df, by, column="line_count"):
    """Histogram of line counts per key with empty buckets present."""
    wide = df.groupBy(*by).agg(*[
        F.count_if(line_bucket_index(column) == i).alias(label)
        for i, label in enumerate(LINE_BUCKETS)
    ])
    return wide.unpivot(list(by), list(LINE_BUCKETS), "bucket", "samples")


def boxplot_stats(df, by, column):
    """Five-number summary, bounds and number of outliers per key."""
    counts = value_counts(df, by, column)
    summary = describe_counts(counts, by).drop("mean", "std").withColumns({
        "low": F.col("p25") - 1.5 * (F.col("p75") - F.col("p25")),
        "high": F.col("p75") + 1.5 * (F.col("p75") - F.col("p25")),
    })
    outside = ~F.col("value").between(F.col("low"), F.col("high"))
    outliers = (
        key_join(counts, summary.select(*by, "low", "high"), by)
        .groupBy(*by).agg(F.sum(F.when(outside, F.col("cnt")).otherwise(0)).alias("outliers"))
    )
    return key_join(summary, outliers, by)


def node_density(nodes="ast_node_count", lines="line_count"):
    """Mean of nodes per line; of means where a row has nodes but no lines.

    A row with neither nodes nor lines has no ratio and is left out.
    """
    endless = F.count_if((F.col(lines) == 0) & (F.col(nodes) > 0)) > 0
    return F.when(endless, F.try_divide(F.avg(nodes), F.avg(lines))).otherwise(
        F.avg(F.try_divide(F.col(nodes), F.col(lines)))
    )


def _row_statistics():
    return [
        F.count(F.lit(1)).alias("rows"),
        F.sum("disk_bytes").alias("disk_bytes"),
        F.sum("memory_bytes").alias("memory_bytes"),
        F.avg("line_count").alias("mean_line_count"),
        F.stddev_samp("line_count").alias("std_line_count"),
        F.avg("ast_node_count").alias("mean_ast_nodes"),
        F.stddev_samp("ast_node_count").alias("std_ast_nodes"),
        F.avg("avg_line_length").alias("mean_line_length"),
        node_density().alias("mean_node_density"),
        F.avg("num_errors").alias("mean_errors"),
        (F.avg((F.col("num_errors") == 0).cast("int")) * 100).alias("zero_error_ratio"),
    ]


def logical_bytes(strings, numbers):
    """Bytes of a row in memory: UTF-8 text plus eight per number."""
    return reduce(
        lambda a, b: a + b,
        [F.coalesce(F.octet_length(F.col(c)), F.lit(0)) for c in strings],
        F.lit(8 * len(numbers)),
    ).cast("bigint")


def compression_ratio(memory="memory_bytes", disk="disk_bytes"):
    return F.round(F.try_divide(F.col(memory), F.col(disk)), 2)


def file_stats(df, file="file"):
    """One row per file. ``df`` has one row per sample with ``disk_bytes`` and ``memory_bytes``."""
    return (
        df.groupBy(file)
        .agg(F.min("language").alias("language"), *_row_statistics())
        .withColumn("compression_ratio", compression_ratio())
    )


def _weighted(names, weight):
    return [
        (F.sum(F.col(n) * F.col(weight)) / F.sum(weight)).alias(n) for n in names
    ]


def language_stats(files):
    """Sums and row-weighted means of the file rows per language."""
    return (
        files.groupBy("language")
        .agg(
            F.sum("rows").alias("total_rows"),
            F.sum("disk_bytes").alias("disk_bytes"),
            F.sum("memory_bytes").alias("memory_bytes"),
            *_weighted(WEIGHTED_MEANS, "rows"),
        )
        .withColumn("compression_ratio", compression_ratio())
    )


def overall_stats(files):
    """One row over all files."""
    names = [n for n in WEIGHTED_MEANS if n != "mean_node_density"]
    return (
        files.agg(
            F.count_distinct("language").alias("total_languages"),
            F.count(F.lit(1)).alias("total_files"),
            F.sum("rows").alias("total_rows"),
            F.sum("disk_bytes").alias("disk_bytes"),
            F.sum("memory_bytes").alias("memory_bytes"),
            *_weighted(names, "rows"),
        )
        .withColumn("compression_ratio", compression_ratio())
    )


def grouping_levels(df, file="file"):
    """File, language and overall rows from the samples in one pass; level 0, 1 and 3."""
    return df.rollup("language", file).agg(
        F.grouping_id().cast("int").alias("level"), *_row_statistics()
    )


def split_variation(files, columns=("mean_line_count", "mean_ast_nodes")):
    """Deviation over mean across the files of a language."""
    return files.groupBy("language").agg(*[
        (F.stddev_samp(c) / F.avg(c)).alias(f"cv_{c}") for c in columns
    ])


def correlation(files, columns=("mean_errors", "mean_ast_nodes", "mean_line_count", "zero_error_ratio")):
    """Pearson coefficients of every pair of columns, long form."""
    pairs = list(combinations(columns, 2))
    wide = files.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    long = wide.unpivot([], [f"{a}|{b}" for a, b in pairs], "pair", "corr")
    return long.select(
        F.split_part("pair", F.lit("|"), F.lit(1)).alias("column_a"),
        F.split_part("pair", F.lit("|"), F.lit(2)).alias("column_b"),
        "corr",
    )


def storage_by_language(files):
    return files.groupBy("language").agg(
        F.sum("rows").alias("total_rows"),
        F.sum("disk_bytes").alias("disk_bytes"),
        F.sum("memory_bytes").alias("memory_bytes"),
    )


def language_share(df):
    """Percent of rows per language."""
    counts = df.groupBy("language").agg(F.count(F.lit(1)).alias("rows"))
    total = counts.agg(F.sum("rows").alias("rows"))
    return counts.withColumn(
        "percent", 100 * F.col("rows") / total.scalar()
    )


def conversion_rates(df, by, converted):
    """Successful, failed and total rows with percentages to five digits."""
    total, good = F.col("total"), F.col("successful")
    return (
        df.groupBy(*by)
        .agg(F.count(F.lit(1)).alias("total"), F.count_if(converted).alias("successful"))
        .withColumn("failed", total - good)
        .withColumn("success_rate", F.round(F.coalesce(F.try_divide(100 * good, total), F.lit(0.0)), 5))
        .withColumn(
            "failure_rate",
            F.round(F.coalesce(F.try_divide(100 * (total - good), total), F.lit(0.0)), 5),
        )
    )


def run_summary(status):
    """How many languages ended with each status, and which, from rows (language, succeeded)."""
    return (
        status.groupBy("succeeded")
        .agg(F.count_distinct("language").alias("languages"),
             F.array_join(F.array_sort(F.collect_set("language")), ",").alias("names"))
    )
