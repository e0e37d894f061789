"""Parts of a file path."""

from pyspark.sql import functions as F


def base_name(column):
    return F.element_at(F.split(F.col(column) if isinstance(column, str) else column, "/"), -1)


def stem(column):
    """Base name without its last extension; a leading dot starts no extension."""
    return F.regexp_replace(base_name(column), r"(?<=.)\.[^.]+$", "")


def converted_name(column):
    return F.concat(stem(column), F.lit(".parquet"))
