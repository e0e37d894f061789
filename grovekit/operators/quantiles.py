"""Exact interpolated quantiles of one column per key.

Values are counted first, so copies cost nothing later, and the counts are staged so that
their number is known. Up to ``BUILT_IN_VALUES`` of them go through Spark's own exact
percentile. Beyond that a fixed monotone function puts the counted values into narrow
buckets; running totals over the buckets tell in which bucket each wanted rank lies, and
only those buckets are sorted. No task then holds a whole key, and the answer does not
depend on how the values fall into buckets.
"""

from pyspark.sql import Window, functions as F

from grovekit.operators.bounded import key_join
from grovekit.session import staged

# Distinct values, over all keys, that the built-in aggregate may hold.
BUILT_IN_VALUES = 1_000_000

_BUCKETS_PER_OCTAVE = 1024


def value_counts(df, by, column):
    """``(by, value, cnt)`` with nulls and NaN left out, staged."""
    return _counted(df.select(*by, F.col(column).cast("double").alias("value")), by)


def column_value_counts(df, by, columns):
    """``(by, column, value, cnt)`` of several columns from one scan, staged."""
    listed = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns
    ]))
    return _counted(df.select(*by, listed.alias("_v")).select(*by, "_v.*"), [*by, "column"])


def _counted(values, by):
    counts = (
        values.where(F.col("value").isNotNull() & ~F.isnan("value"))
        .groupBy(*by, "value")
        .agg(F.count(F.lit(1)).alias("cnt"))
    )
    return staged(counts, "value-counts")


def _bucket(column):
    magnitude = F.floor(F.log2(F.abs(column) + 1) * _BUCKETS_PER_OCTAVE)
    return (F.signum(column) * magnitude).cast("bigint")


def quantiles_of_counts(counts, by, probabilities, values=None):
    """One column per entry of ``probabilities`` (name -> probability).

    ``counts`` is a staged table or derived from one; ``values`` is an upper bound on its
    rows where the caller knows one.
    """
    if (counts.count() if values is None else values) <= BUILT_IN_VALUES:
        return _built_in(counts, by, probabilities)
    return bucketed_quantiles(counts, by, probabilities)


def _built_in(counts, keys, probabilities, *others):
    """Further aggregates and all quantiles from one buffer of values per key."""
    wanted = [float(p) for p in probabilities.values()]
    found = counts.groupBy(*keys).agg(
        *others, F.percentile("value", wanted, F.col("cnt")).alias("_quantiles"))
    return found.withColumns({
        name: F.get("_quantiles", F.lit(i)) for i, name in enumerate(probabilities)
    }).drop("_quantiles")


def bucketed_quantiles(counts, by, probabilities):
    """The same for any number of values."""
    by = list(by)
    keys = by or ["_all"]
    if not by:
        counts = counts.withColumn("_all", F.lit(0))
    counts = counts.withColumn("bucket", _bucket(F.col("value")))

    over_key = Window.partitionBy(*keys)
    running = over_key.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = (
        counts.groupBy(*keys, "bucket")
        .agg(F.sum("cnt").alias("held"))
        .withColumn("before", F.coalesce(F.sum("held").over(running), F.lit(0)))
        .withColumn("n", F.sum("held").over(over_key))
    )
    wanted = F.array(*[
        F.struct(
            F.lit(name).alias("name"),
            F.lit(side).alias("side"),
            (F.floor if side == "low" else F.ceil)(F.lit(float(p)) * (F.col("n") - 1))
            .cast("bigint").alias("rank"),
            F.abs(F.lit(float(p)) * (F.col("n") - 1)
                  - (F.ceil if side == "low" else F.floor)(F.lit(float(p)) * (F.col("n") - 1))).alias("weight"),
        )
        for name, p in probabilities.items() for side in ("low", "high")
    ])
    targets = buckets.select(
        *keys, "bucket", "before",
        F.filter(
            wanted,
            lambda t: (t["rank"] >= F.col("before")) & (t["rank"] < F.col("before") + F.col("held")),
        ).alias("targets"),
    ).where(F.size("targets") > 0)

    inside = (
        Window.partitionBy(*keys, "bucket").orderBy("value")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    found = (
        key_join(counts, targets, [*keys, "bucket"])
        .withColumn("first", F.col("before") + F.coalesce(F.sum("cnt").over(inside), F.lit(0)))
        .select(
            *keys, "value",
            F.explode(F.filter(
                "targets",
                lambda t: (t["rank"] >= F.col("first")) & (t["rank"] < F.col("first") + F.col("cnt")),
            )).alias("t"),
        )
    )

    def of(name, side, field):
        return F.max(F.when((F.col("t.name") == name) & (F.col("t.side") == side), F.col(field)))

    def between(name):
        # The built-in percentile's own formula, so that both ways agree to the last digit.
        low, high = of(name, "low", "value"), of(name, "high", "value")
        weighted = of(name, "low", "t.weight") * low + of(name, "high", "t.weight") * high
        return F.when(low == high, low).otherwise(weighted)

    result = found.groupBy(*keys).agg(*[between(name).alias(name) for name in probabilities])
    return result if by else result.drop("_all")


def exact_quantiles(df, by, column, probabilities):
    """Exact linear-interpolation quantiles of ``column`` per key."""
    return quantiles_of_counts(value_counts(df, by, column), by, probabilities)


def describe_counts(counts, by, prefix=""):
    """count, mean, sample deviation, minimum, quartiles and maximum of counted values."""
    by = list(by)
    keys = by or ["_all"]
    if not by:
        counts = counts.withColumn("_all", F.lit(0))
    moments = [
        F.sum("cnt").alias("count"),
        (F.sum(F.col("value") * F.col("cnt")) / F.sum("cnt")).alias("mean"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    ]
    quartiles = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    if counts.count() <= BUILT_IN_VALUES:
        base = _built_in(counts, keys, quartiles, *moments)
    else:
        base = key_join(counts.groupBy(*keys).agg(*moments), bucketed_quantiles(counts, keys, quartiles), keys)
    # Deviations from the known mean: no cancellation, and only counted values are read again.
    spread = (
        key_join(counts, base.select(*keys, "mean"), keys)
        .groupBy(*keys)
        .agg(F.sqrt(F.try_divide(
            F.sum(F.col("cnt") * F.pow(F.col("value") - F.col("mean"), 2)), F.sum("cnt") - 1,
        )).alias("std"))
    )
    return key_join(base, spread, keys).select(
        *by,
        *[F.col(c).alias(prefix + c) for c in ("count", "mean", "std", "min", "p25", "p50", "p75", "max")],
    )


def describe(df, by, column, prefix=""):
    return describe_counts(value_counts(df, by, column), by, prefix)
