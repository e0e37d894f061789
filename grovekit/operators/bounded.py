"""Joins against small results whose size is checked before they are broadcast."""

from functools import reduce
from operator import and_

from pyspark.sql import functions as F

# Upper bound on rows brought to the driver for a broadcast.
LOOKUP_ROWS = 10_000


def resolve_small(df, limit=LOOKUP_ROWS):
    """``df`` as a local table, or None when it has more than ``limit`` rows."""
    table = df.limit(limit + 1).toArrow()
    if table.num_rows > limit:
        return None
    return df.sparkSession.createDataFrame(table, schema=df.schema)


def key_join(rows, lookup, on, how="inner"):
    """Join on equal keys, where null equals null; the keys of ``rows`` stay."""
    theirs = {key: f"_their_{key}" for key in on}
    same = reduce(and_, [F.col(key).eqNullSafe(F.col(name)) for key, name in theirs.items()], F.lit(True))
    return rows.join(lookup.withColumnsRenamed(theirs), same, how).drop(*theirs.values())


def lookup_join(rows, lookup, on, how="inner", limit=LOOKUP_ROWS):
    """Join many rows to a per-key result; a null key is a key like others.

    The per-key result is computed once. Within ``limit`` rows it is broadcast, so the
    many rows stay where they are; beyond it both sides are shuffled and adaptive
    execution splits hot keys.
    """
    small = resolve_small(lookup, limit)
    if small is None:
        return key_join(rows, lookup, on, how)
    return key_join(rows, F.broadcast(small), on, how)
