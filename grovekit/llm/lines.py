"""Line dedup across sites: lines that occur on many distinct sites are boilerplate.

Lines are compared by two hashes of the trimmed line. A line that occurs fewer times than
``min_sites`` cannot reach it, so only the others get a HyperLogLog sketch of their sites;
sketches of a line are merged by aggregation, whose partial results are one small sketch
per task and line, however often a line occurs. Where an estimate lies within ``margin``
standard errors (at least two sites) of the threshold, the sites are counted exactly.
Boilerplate stays in the document with the smallest id that holds it and goes from all others.

Defined results: a null site counts as no site; empty lines are never boilerplate; null and
empty texts stay as they are; with only null ids the line goes everywhere; rows that share
an id are treated alike; an empty table gives no rows. All columns are kept, and ``text`` is
replaced; columns named n_lines or n_removed are replaced by ours.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grovekit.llm.names import fresh
from grovekit.session import staged

MIN_SITES = 8
MARGIN = 4
LOG_CELLS = 12


def _key(line):
    return F.struct(F.xxhash64(line).alias("h"), F.hash(line).alias("g"))


def _line_keys(docs, id_column, site_column):
    lines = docs.select(F.col(id_column).alias("id"), F.col(site_column).alias("site"), F.explode(F.split("text", "\n")).alias("line"))
    return lines.withColumn("line", F.trim("line")).where("line <> ''").select("id", "site", _key(F.col("line")).alias("key"))


def site_spread(keys: DataFrame, min_sites=MIN_SITES, margin=MARGIN, log_cells=LOG_CELLS) -> DataFrame:
    """Of lines on at least ``min_sites`` sites: key, first (smallest id that holds it). ``keys``: id, site, key."""
    sketched = staged(
        keys.groupBy("key").agg(F.hll_sketch_agg("site", log_cells).alias("sketch"), F.min("id").alias("first"))
        .select("key", "first", F.hll_sketch_estimate("sketch").alias("estimate")),
        "line-sketches",
    )
    error = max(2.0, margin * 1.04 / 2 ** (log_cells / 2) * min_sites)
    unsure = sketched.where(F.abs(F.col("estimate") - min_sites) <= error)
    exact = (
        keys.where("site is not null").join(unsure.select("key"), "key", "left_semi").select("key", "site").distinct()
        .groupBy("key").agg(F.count("*").alias("sites")).where(F.col("sites") >= min_sites).select("key")
    )
    return (
        sketched.where(F.col("estimate") > min_sites + error).select("key", "first")
        .unionByName(unsure.join(exact, "key", "left_semi").select("key", "first"))
    )


def remove_boilerplate(docs: DataFrame, min_sites=MIN_SITES, id_column="doc_id", site_column="source", **options) -> DataFrame:
    """``docs`` with boilerplate lines taken out of ``text``; adds n_lines and n_removed."""
    keys = _line_keys(docs, id_column, site_column)
    often = keys.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") >= min_sites).select("key")
    keys = staged(keys.join(often, "key", "left_semi"), "line-keys")
    boilerplate = staged(site_spread(keys, min_sites, **options), "line-boilerplate")
    ours, gone, kept, n = (fresh(docs, x) for x in ("_ours", "_gone", "_kept", "_n"))
    # Several lines of a document may go, never more than it has.
    going = (
        keys.join(boilerplate, "key").where(~F.col("id").eqNullSafe(F.col("first")) | F.col("first").isNull())
        .groupBy(F.col("id").alias(ours)).agg(F.collect_set("key").alias(gone))
    )
    lines = F.split("text", "\n")
    left = F.filter(lines, lambda x: ~F.array_contains(gone, _key(F.trim(x))))
    hit = F.col(gone).isNotNull() & F.col("text").isNotNull()
    changed = (
        docs.join(going, F.col(id_column).eqNullSafe(F.col(ours)), "left").withColumn(kept, F.when(hit, left))
        .withColumn(n, F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)))
    )
    return changed.select(
        *[F.when(hit, F.array_join(kept, "\n")).otherwise(F.col("text")).alias("text") if c == "text" else F.col(f"`{c}`")
          for c in docs.columns if c not in ("n_lines", "n_removed")],
        F.col(n).cast("long").alias("n_lines"),
        F.when(hit, F.col(n) - F.size(kept)).otherwise(0).cast("long").alias("n_removed"),
    )
