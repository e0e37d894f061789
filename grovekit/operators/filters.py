"""Row filters and the cleaning of samples."""

from pyspark.sql import functions as F

from grovekit.fixed import DROP_MARKERS, END_MARKER, LANGUAGES, LINE_MARKERS
from grovekit.functions import text as T
from grovekit.operators.bounded import key_join, lookup_join
from grovekit.operators.quantiles import exact_quantiles, quantiles_of_counts
from grovekit.session import staged

LANGUAGES_PER_PART = 2


def select_languages(df, part=0, languages=LANGUAGES, column="language"):
    """All languages of the list, or the two of one part (counted from 1)."""
    chosen = list(languages)
    if part:
        parts = -(-len(chosen) // LANGUAGES_PER_PART)
        if not 1 <= part <= parts:
            raise ValueError(f"part must be between 1 and {parts}")
        chosen = chosen[(part - 1) * LANGUAGES_PER_PART:part * LANGUAGES_PER_PART]
    return df.where(F.col(column).isin(chosen))


def fences(df, by, column):
    """Outlier bounds per key: quartiles widened by one and a half quartile distances."""
    return fences_of_quartiles(exact_quantiles(df, by, column, {"q1": 0.25, "q3": 0.75}))


def fences_of_quartiles(quartiles):
    return quartiles.withColumns({
        "low": F.col("q1") - 1.5 * (F.col("q3") - F.col("q1")),
        "high": F.col("q3") + 1.5 * (F.col("q3") - F.col("q1")),
    })


def _outside(column):
    """Beyond the bounds ``low`` and ``high``; null and NaN lie beyond none."""
    value = F.col(column).cast("double")
    return F.coalesce(~F.isnan(value) & ((value < F.col("low")) | (value > F.col("high"))), F.lit(False))


def iqr_filter(df, by, column):
    """Rows not outside the outlier bounds of their key; rows without a value stay."""
    bounds = fences(df, by, column).select(*by, "low", "high")
    return lookup_join(df, bounds, by, "left").where(~_outside(column)).drop("low", "high")


def quantile_cap(df, by, column, probability):
    """Rows up to a quantile of their key, bound included."""
    cap = exact_quantiles(df, by, column, {"cap": probability})
    return lookup_join(df, cap, by).where(F.col(column) <= F.col("cap")).drop("cap")


def percentile_cap(df, by, line_count="line_count", line_length="avg_line_length"):
    """Up to the 90th percentile of lines, then up to the 80th of line length of what is left."""
    return quantile_cap(quantile_cap(df, by, line_count, 0.9), by, line_length, 0.8)


def statistical_bounds(df, by, line_count="line_count", line_length="avg_line_length"):
    """All three bounds of the outlier filter and the two caps, one scan of the rows.

    Rows are first counted per (key, line count, line length); each bound is taken from
    that table with the earlier bounds applied. The table is staged because three
    rounds read it.
    """
    pairs = staged(
        df.groupBy(*by, line_count, line_length).agg(F.count(F.lit(1)).alias("cnt")),
        "metric-pairs",
    )

    values = pairs.count()

    def counted(rows, column):
        return (
            rows.groupBy(*by, F.col(column).cast("double").alias("value"))
            .agg(F.sum("cnt").alias("cnt"))
            .where(F.col("value").isNotNull() & ~F.isnan("value"))
        )

    bounds = fences_of_quartiles(
        quantiles_of_counts(counted(pairs, line_length), by, {"q1": 0.25, "q3": 0.75}, values)
    ).select(*by, "low", "high")
    pairs = lookup_join(pairs, bounds, by).where(~_outside(line_length))
    caps = quantiles_of_counts(counted(pairs, line_count), by, {"line_cap": 0.9}, values)
    pairs = lookup_join(pairs, caps, by).where(F.col(line_count) <= F.col("line_cap"))
    last = quantiles_of_counts(counted(pairs, line_length), by, {"length_cap": 0.8}, values)
    return key_join(key_join(bounds, caps, by), last, by)


def statistical_filter(df, by, line_count="line_count", line_length="avg_line_length"):
    """Outlier filter on line length, then both caps; same rows as the three filters in turn."""
    bounds = statistical_bounds(df, by, line_count, line_length)
    return (
        lookup_join(df, bounds, by)
        .where(
            ~_outside(line_length)
            & (F.col(line_count) <= F.col("line_cap"))
            & (F.col(line_length) <= F.col("length_cap"))
        )
        .drop("low", "high", "line_cap", "length_cap")
    )


def contains_any_count(df, column, substrings):
    """One row: how many rows hold one of the substrings. An absent column counts none."""
    if column not in df.columns or not substrings:
        return df.agg(F.count_if(F.lit(False)).alias("matching_rows"))
    return df.agg(F.count_if(T.contains_any(column, substrings)).alias("matching_rows"))


def drop_rows_containing(df, column, substrings):
    """Rows without any of the substrings; null rows stay."""
    if column not in df.columns or not substrings:
        return df
    return df.where(~T.contains_any(column, substrings))


def clean_samples(df, column="code", drop=DROP_MARKERS, line=LINE_MARKERS, end=END_MARKER):
    """Drop marked samples, then marked lines, then the end marker."""
    kept = drop_rows_containing(df, column, drop)
    return kept.withColumn(
        column, T.replace_literal(T.drop_lines_containing(column, line), end)
    )


def clean_report(df, by, column="code", drop=DROP_MARKERS, line=LINE_MARKERS, end=END_MARKER):
    """Counts of every cleaning step per key, in one pass.

    Rows with the end marker are counted after the marked lines are gone, as the steps run.
    """
    dropped = T.contains_any(column, drop)
    trimmed = T.contains_any(column, line)
    ended = T.contains_any(T.drop_lines_containing(column, line), [end])
    return (
        df.groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("rows_before"),
            F.count_if(~dropped).alias("rows_after"),
            F.count_if(dropped).alias("rows_removed"),
            F.count_if(~dropped & trimmed).alias("rows_with_marked_lines"),
            F.count_if(~dropped & ended).alias("rows_with_end_marker"),
        )
        .withColumn("percent_removed", 100 * F.col("rows_removed") / F.col("rows_before"))
    )


def valid_rows(df, languages=LANGUAGES):
    """Usable rows under one spelling per language."""
    return (
        df.where(T.invalid_reason("language", "code", languages).isNull())
        .withColumn("language", T.normalize_language("language"))
    )


def rejected_rows(df, languages=LANGUAGES):
    """The other rows with the reason."""
    return df.withColumn("reason", T.invalid_reason("language", "code", languages)).where(
        F.col("reason").isNotNull()
    )


def whole_row(df):
    """Condition: no column is null or NaN."""
    whole = F.lit(True)
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        whole = whole & column.isNotNull()
        if field.dataType.typeName() in ("float", "double"):
            whole = whole & ~F.isnan(column)
    return whole


def drop_any_null(df):
    """Rows without null or NaN in any column."""
    return df.na.drop("any")


def line_range(df, column="line_count", low=10, high=10_000):
    return df.where(F.col(column).between(low, high))


def license_filter(df, column="code", allowed=T.PERMISSIVE_LICENSES):
    """Samples whose licence phrase is an allowed one."""
    return df.where(T.license_label(column).isin(*allowed))


def exact_dedup(df, column="code", key="id"):
    """The row with the smallest key of every distinct text.

    Hashes are counted down to one key each before anything is shuffled, so a text with
    very many copies costs one row per task; the rows are then matched on the unique key.
    """
    keepers = (
        df.select(T.source_hash(column).alias("_hash"), key)
        .groupBy("_hash").agg(F.min(key).alias(key)).select(key)
    )
    return df.join(keepers, key, "left_semi")
