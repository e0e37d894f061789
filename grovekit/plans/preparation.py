"""Corpus preparation: sample, filter, clean, measure."""

from pyspark.sql import functions as F

from grovekit.fixed import REPOSITORY_COLUMNS
from grovekit.functions import text as T
from grovekit.operators.filters import clean_samples, statistical_filter
from grovekit.operators.ranking import first_by_hash


def drop_repository_columns(df, columns=REPOSITORY_COLUMNS):
    """Without the columns of the list; absent ones are no error."""
    return df.drop(*columns)


def with_raw_metrics(df, code="code"):
    """Add line length and line count of the untouched text."""
    return df.withColumns({
        "avg_line_length": T.avg_line_length_raw(code), "line_count": T.line_count_raw(code),
    })


def with_clean_metrics(df, code="code", mode="reference"):
    """Replace both metrics by those of the cleaned text."""
    metrics = T.clean_metrics(code, mode)
    return df.withColumn("_m", metrics).withColumns({
        "avg_line_length": F.col("_m.avg_line_length"), "line_count": F.col("_m.line_count"),
    }).drop("_m")


def filter_corpus(df, key, seed=42, per_language=None):
    """The outlier filter and the two caps, on all rows or on a seeded sample per language."""
    sampled = df if per_language is None else first_by_hash(df, ["language"], key, per_language, seed)
    return statistical_filter(with_raw_metrics(sampled), ["language"])


def prepare(df, key, seed=42, per_language=None, **markers):
    """From raw samples to cleaned, measured samples."""
    filtered = filter_corpus(df, key, seed, per_language)
    return with_clean_metrics(clean_samples(filtered, **markers))
