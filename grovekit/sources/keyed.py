"""Keyed JSON with all samples of a file in one object, read in parallel.

Such a file is one line, so it has no record borders a reader could look for. It is cut at
every closing brace by the text reader, which splits files at any byte. Whether a brace is
structure or text, and how deep it lies, depends on everything before it: on the number of
quotes (odd inside a string) and of open braces. Both are prefix sums and are taken in two
levels. The first pass sums up each split for either state it may begin in; a scan over the
splits, one row each, gives their true beginnings; the second pass numbers the entries inside
each split. An entry that runs over the border of splits is put together at the end.

An escape is a backslash and one more character that is never a brace, so no cut divides
one. Texts are shuffled once, by split. White space between tokens, several objects per file
and nested objects are allowed. A file that ends inside an entry loses that entry; an empty
file has none.
"""

from pyspark.sql import Window, functions as F

from grovekit.operators.bounded import key_join, lookup_join
from grovekit.session import staged
from grovekit.sources.readers import explode_keyed_json

_SPLIT = ["path", "split"]


def _count(text, letter):
    return F.length(text) - F.length(F.replace(text, F.lit(letter), F.lit("")))


def _pieces(spark, path):
    """Text up to each closing brace, in order of ``nth`` within a split of a file.

    ``quotes`` counts those that are not escaped; ``open_out`` and ``open_in`` count the
    structural opening braces of a piece that begins outside or inside a string.
    """
    bare = F.regexp_replace("value", r"(?s)\\.", "")
    outside = F.regexp_replace("_bare", '"[^"]*("|$)', "")
    inside = F.regexp_replace(F.regexp_replace("_bare", '^[^"]*("|$)', ""), '"[^"]*("|$)', "")
    return (
        spark.read.option("lineSep", "}").text(path)
        .select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("split"),
                F.col("_metadata.file_size").alias("size"))
        .withColumn("nth", F.monotonically_increasing_id()).withColumn("_bare", bare)
        .withColumns({"quotes": _count("_bare", '"'), "open_out": _count(outside, "{"), "open_in": _count(inside, "{")})
        .drop("_bare")
    )


def _in_split():
    return Window.partitionBy(*_SPLIT).orderBy("nth")


def _earlier(column, window):
    return F.coalesce(F.sum(column).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def _depth_change(begins_inside, opened="open_out", opened_inside="open_in"):
    """Change of depth by a piece; its closing brace counts unless it lies in a string."""
    ends_inside = (begins_inside.cast("long") + F.col("quotes")) % 2 == 1
    return F.when(begins_inside, F.col(opened_inside)).otherwise(F.col(opened)) - (~ends_inside).cast("long")


def _beginnings(pieces):
    """State at the beginning of each split: inside a string or not, and the depth.

    ``cut`` is the piece of it that ends with the file and not with a brace. That the last
    piece has none shows in the number of bytes.
    """
    before = _earlier("quotes", _in_split())
    light = pieces.withColumn("bytes", F.octet_length("value") + 1).drop("value").withColumn("_odd", before % 2 == 1)
    sums = light.groupBy(*_SPLIT).agg(
        F.sum("quotes").alias("quotes"), F.sum(_depth_change(F.col("_odd"))).alias("change_out"),
        F.sum(_depth_change(~F.col("_odd"))).alias("change_in"), F.sum("bytes").alias("bytes"), F.max("size").alias("size"),
        F.max("nth").alias("last"))
    in_file = Window.partitionBy("path").orderBy("split")
    sums = sums.withColumn("inside", _earlier("quotes", in_file) % 2 == 1)
    change = F.when(F.col("inside"), F.col("change_in")).otherwise(F.col("change_out"))
    ends = (F.lead("split").over(in_file).isNull()) & (_earlier("bytes", in_file) + F.col("bytes") != F.col("size"))
    return sums.withColumn("_change", change).select(
        *_SPLIT, "inside", _earlier("_change", in_file).alias("depth"), F.when(ends, F.col("last")).alias("cut"))


def _entries(pieces, beginnings):
    """Text of each entry of a split; the first may have begun, and the last may end, in another."""
    found = lookup_join(pieces, beginnings, _SPLIT)
    odd = _earlier("quotes", _in_split()) % 2 == 1
    found = found.withColumn("_inside", F.col("inside") != odd)
    found = found.withColumn("_change", _depth_change(F.col("_inside")))
    found = found.withColumn("_after", F.col("depth") + F.sum("_change").over(_in_split()))
    closes = (F.col("_inside").cast("long") + F.col("quotes")) % 2 == 0
    found = found.withColumn("_ends", (closes & (F.col("_after") == 1) & ~F.col("nth").eqNullSafe(F.col("cut"))).cast("long"))
    found = found.withColumn("entry", _earlier("_ends", _in_split()))
    texts = F.transform(F.sort_array(F.collect_list(F.struct("nth", "value"))), lambda x: F.concat(x["value"], F.lit("}")))
    return found.groupBy(*_SPLIT, "entry").agg(F.array_join(texts, "").alias("value"), (F.max("_ends") == 1).alias("ended"))


def _over_borders(parts):
    """Entries put together from the parts that touch the border of a split."""
    order = Window.partitionBy("path").orderBy("split", "entry")
    numbers = parts.select(*_SPLIT, "entry", F.col("ended").cast("long").alias("ended")).withColumn("whole", _earlier("ended", order))
    numbered = key_join(parts, numbers.drop("ended"), [*_SPLIT, "entry"])
    texts = F.sort_array(F.collect_list(F.struct("split", "entry", "value")))
    return numbered.groupBy("path", "whole").agg(
        F.array_join(texts["value"], "").alias("value"), F.max("ended").alias("ended")).where("ended")


def keyed_entries(spark, path):
    """Every entry of the objects in the files of ``path``, each as an object of its own in ``value``."""
    pieces = _pieces(spark, path)
    entries = staged(_entries(pieces, _beginnings(pieces)), "keyed-entries")
    at_border = ((F.col("entry") == 0) & (F.col("split") > 0)) | ~F.col("ended")
    whole = entries.where(~at_border).select("value").unionByName(_over_borders(entries.where(at_border)).select("value"))
    return whole.select(F.concat(F.lit("{"), F.regexp_replace("value", r"^[\s,{}]+", ""), F.lit("}")).alias("value"))


def scan_keyed_object(spark, path):
    """Rows of keyed JSON files of one object each; the language is the key up to its first ``_``."""
    return explode_keyed_json(keyed_entries(spark, path))
