"""Row numbers, first-n and seeded samples per key without one task per key.

Rows are spread over (key, bucket) where buckets follow the order, row numbers are
taken inside each pair, and the totals of earlier buckets are added. Any order-keeping
bucket gives the same numbers; buckets only decide how even the tasks are.
"""

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Window, functions as F

from grovekit.operators.bounded import key_join, lookup_join

ROWS_PER_BUCKET = 20_000
_HASH_DIGITS = 3


def seeded_hash(column, seed=42):
    """Reproducible position of a row in a shuffled order, as hexadecimal text."""
    return F.md5(F.encode(F.concat_ws("_", F.col(column).cast("string"), F.lit(str(seed))), "UTF-8"))


def hash_bucket(column):
    """Order-keeping bucket of a hexadecimal hash; buckets are even by construction."""
    return F.substring(column, 1, _HASH_DIGITS)


def with_range_bucket(df, column, rows_per_bucket=ROWS_PER_BUCKET):
    """Add ``_bucket``: order-keeping ranges of a numeric column, about equally full.

    Two passes over one column fetch the row count and as many cut points; the cut
    points are literals, so every later evaluation sees the same buckets. Nulls come
    first and NaN last, as they do when sorted.
    """
    total = df.select(column).count()
    parts = -(-total // rows_per_bucket)
    if parts <= 1:
        return df.withColumn("_bucket", F.lit(0.0))
    steps = [i / parts for i in range(1, parts)]
    cuts = df.agg(
        F.percentile_approx(F.col(column).cast("double"), steps, max(10_000, 10 * parts))
    ).first()[0]
    splits = [float("-inf"), *sorted(c for c in set(cuts or []) if abs(c) < float("inf")), float("inf")]
    key = "_bucket_key"
    bucketed = Bucketizer(splits=splits, inputCol=key, outputCol="_bucket", handleInvalid="keep").transform(
        df.withColumn(key, F.col(column).cast("double"))
    )
    return bucketed.withColumn("_bucket", F.when(F.col(key).isNull(), -1.0).otherwise(F.col("_bucket"))).drop(key)


def _bucket_totals(df, by):
    over_key = Window.partitionBy(*by)
    running = over_key.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    return (
        df.groupBy(*by, "_bucket")
        .agg(F.count(F.lit(1)).alias("_held"))
        .withColumn("_before", F.coalesce(F.sum("_held").over(running), F.lit(0)))
        .withColumn("key_rows", F.sum("_held").over(over_key))
        .drop("_held")
    )


def number_rows(df, by, order, name="row_index"):
    """Zero-based index per key in ``order`` and rows per key, for rows with ``_bucket``."""
    inside = Window.partitionBy(*by, "_bucket").orderBy(*order)
    return (
        key_join(df, _bucket_totals(df, by), [*by, "_bucket"])
        .withColumn(name, F.col("_before") + F.row_number().over(inside) - 1)
        .drop("_bucket", "_before")
    )


def index_by_column(df, by, column, name="row_index", rows_per_bucket=ROWS_PER_BUCKET):
    """Running index per key in the order of a unique numeric column."""
    return number_rows(with_range_bucket(df, column, rows_per_bucket), by, [column], name)


def index_by_hash(df, by, column, seed=42, name="row_index"):
    """Running index per key in seeded random order; ``column`` breaks ties."""
    hashed = df.withColumn("_hash", seeded_hash(column, seed))
    hashed = hashed.withColumn("_bucket", hash_bucket("_hash"))
    return number_rows(hashed, by, ["_hash", column], name).drop("_hash")


def first_rows(df, by, order, n):
    """First rows per key for rows with ``_bucket``; ``n`` is a number or a per-key column.

    Rows beyond the bucket in which the n-th row lies are filtered out before any
    shuffle, so at most one bucket more than the answer is moved, and only inside that
    bucket does the order of single rows matter.
    """
    n = F.lit(n) if isinstance(n, int) else n
    cut = (
        _bucket_totals(df.withColumn("_n", n), [*by, "_n"])
        .where(F.col("_before") < F.col("_n"))
        .groupBy(*by)
        .agg(F.max(F.struct("_bucket", "_before")).alias("_last"))
    )
    inside = Window.partitionBy(*by, "_bucket").orderBy(*order)
    return (
        lookup_join(df, cut, by)
        .where(F.col("_bucket") <= F.col("_last._bucket"))
        .withColumn("_position", F.row_number().over(inside))
        .where(
            (F.col("_bucket") < F.col("_last._bucket"))
            | (F.col("_last._before") + F.col("_position") <= n)
        )
        .drop("_bucket", "_last", "_position")
    )


def first_by_column(df, by, column, n, rows_per_bucket=ROWS_PER_BUCKET):
    """First ``n`` rows per key in the order of a unique numeric column."""
    return first_rows(with_range_bucket(df, column, rows_per_bucket), by, [column], n)


def first_by_hash(df, by, column, n, seed=42):
    """``n`` rows per key in seeded random order: a sample without replacement."""
    hashed = df.withColumn("_hash", seeded_hash(column, seed))
    hashed = hashed.withColumn("_bucket", hash_bucket("_hash"))
    return first_rows(hashed, by, ["_hash", column], n).drop("_hash")


def sample_per_file(df, language, file, column, target, seed=42):
    """Share ``target`` rows per language evenly over its files: max(1, target // files) each."""
    files = (
        df.groupBy(language, file).count()
        .groupBy(language).agg(F.count(F.lit(1)).alias("_files"))
    )
    shared = lookup_join(df, files, [language]).withColumn(
        "_share",
        F.greatest(F.lit(1).cast("bigint"), F.call_function("div", F.lit(target).cast("bigint"), F.col("_files"))),
    )
    return first_by_hash(shared, [language, file], column, F.col("_share"), seed).drop("_files", "_share")
