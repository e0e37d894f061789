"""Benchmark decontamination: which words of a document lie inside a passage of a benchmark item.

A window is ``window`` consecutive words of an item, or all of a shorter item. A document
can hold a window only if it holds all its shingles of ``shingle`` words, so the rarest one
of each window (its prefix) is enough to find all candidates:

1. a fixed-size bit table of all item shingles picks the places of documents worth keeping;
   its size does not depend on the benchmark, and a false hit only costs a comparison;
2. shingles in those places are counted over all documents, and each window keeps its rarest;
   a window with a shingle that occurs nowhere is out;
3. places are joined with windows on that shingle, bounded by position and document length,
   and the words are compared one by one.

Every document emits at most its own words, hot shingles are joined by equality and can be
split, and counts are combined before they are shuffled.

Defined results: null and empty texts have no words and are clean; items without words match
nothing; equal items are matched once and all their ids reported; null item ids are not
counted as items; each row of a repeated document is reported; an empty table on either side
gives clean documents or no rows. Further columns are ignored.
"""

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from grovekit.llm.arrow import arrow_schema, slices, to_batch
from grovekit.llm.names import fresh
from grovekit.llm.words import WordHasher, alnum_words, shingle_hashes
from grovekit.session import staged

WINDOW = 13
SHINGLE = 5
#: A document is contaminated when one word in so many is hit.
ONE_WORD_IN = 20
_CELLS = 1 << 18  # of 64 bits: a table of 2 MB, whatever the benchmark
_WINDOW = "class string, window string, size int, offset int, shingle_size int, shingle long"
_PLACED = "row_key long, doc_id long, n_words long, places array<struct<start:int,words:string>>"
_SHINGLE = "row_key long, shingle_size int, shingle long, position int, n_words long, before int, near array<string>"


def _cell(h):
    return (h & np.uint64(_CELLS - 1)).astype(np.int64), np.uint64(1) << (h >> np.uint64(18) & np.uint64(63))


class _Bits:
    """Membership in a set of shingle hashes, with false positives and no false negatives."""

    def __init__(self, cells):
        self.cells = cells

    def __call__(self, h):
        at, bit = _cell(h)
        return self.cells[at] & bit != 0


def _bits(shingles):
    """Bit table of the column ``shingle``; at most ``_CELLS`` rows reach the driver."""
    h = F.col("shingle")
    rows = shingles.groupBy(h.bitwiseAND(_CELLS - 1).alias("at")).agg(
        F.expr("bit_or(shiftleft(1L, cast(shiftrightunsigned(shingle, 18) & 63 as int)))").alias("bits")).toPandas()
    cells = np.zeros(_CELLS, np.uint64)
    cells[rows["at"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64).view(np.uint64)
    return cells


def item_windows(items, window=WINDOW, shingle=SHINGLE):
    """Distinct items by their words (``class``, item_ids), and the shingles of their windows."""
    schema, out = arrow_schema("item_id string, class string, words string"), arrow_schema(_WINDOW)

    def split(batches):
        for batch in slices(batches):
            rows = []
            for item, text in zip(batch.column("item_id").to_pylist(), batch.column("text").to_pylist()):
                if words := b" ".join(alnum_words(text)):
                    rows.append((item, hashlib.sha256(words).hexdigest(), words.decode("utf-8", "surrogatepass")))
            yield to_batch(schema, list(zip(*rows)) or [[]] * 3)

    def cut(batches):
        hasher = WordHasher()
        for batch in slices(batches, 16):
            rows = []
            for name, text in zip(batch.column("class").to_pylist(), batch.column("words").to_pylist()):
                words = text.split(" ")
                hashes = hasher([w.encode("utf-8", "surrogatepass") for w in words])
                size = min(window, len(words))
                k = min(shingle, size)
                found = shingle_hashes(hashes, k).view(np.int64).tolist()
                for i in range(len(words) - size + 1):
                    inside = " ".join(words[i:i + size])
                    rows += [(name, inside, size, j, k, found[i + j]) for j in range(size - k + 1)]
            yield to_batch(out, list(zip(*rows)) or [[]] * 6)

    worded = items.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        split, "item_id string, class string, words string")
    classes = worded.select("class", "item_id").where("item_id is not null").distinct()
    return classes, worded.select("class", "words").dropDuplicates(["class"]).mapInArrow(cut, _WINDOW)


def _regions(hits, reach, n):
    """Merged stretches around the hits, as (start, end) word numbers."""
    starts, ends = np.maximum(hits - reach, 0), np.minimum(hits + reach + SHINGLE, n)
    new = np.flatnonzero(np.r_[True, starts[1:] > ends[:-1]])
    return zip(starts[new].tolist(), ends[np.r_[new[1:] - 1, len(hits) - 1]].tolist())


def _find_places(docs, cells, sizes, window):
    """Every document with the stretches of words around possible shingles of items."""
    schema = arrow_schema(_PLACED)

    def find(batches):
        from pyspark import TaskContext

        hasher, known, key = WordHasher(), _Bits(cells), TaskContext.get().partitionId() << 40
        for batch in slices(batches):
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                words = alnum_words(text)
                hashes = hasher(words)
                hits = np.unique(np.concatenate([np.flatnonzero(known(shingle_hashes(hashes, k))) for k in sizes] or [np.empty(0, np.int64)]))
                places = [
                    {"start": a, "words": b" ".join(words[a:b]).decode("utf-8", "surrogatepass")}
                    for a, b in (_regions(hits, window, len(words)) if len(hits) else ())
                ]
                rows.append((key, doc_id, len(words), places))
                key += 1
            yield to_batch(schema, list(zip(*rows)) or [[]] * 4)

    columns = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return columns.mapInArrow(find, _PLACED)


def _shingles(placed, cells, sizes, reach=None):
    """Shingles of the kept places that the bit table knows; with ``reach``, the words on both sides too."""
    schema = arrow_schema(_SHINGLE)

    def shingle(batches):
        hasher, known = WordHasher(), _Bits(cells)
        for batch in slices(batches, 64):
            columns = [batch.column(c).to_pylist() for c in ("row_key", "n_words", "places")]
            for key, n, places in zip(*columns):
                for place in places:
                    words = place["words"].split(" ")
                    hashes = hasher([w.encode("utf-8", "surrogatepass") for w in words])
                    rows = []
                    for k in sizes:
                        h = shingle_hashes(hashes, k)
                        for i in np.flatnonzero(known(h)).tolist():
                            a = max(0, i - reach) if reach is not None else i
                            near = words[a:i + k + reach] if reach is not None else None
                            rows.append((key, k, int(h[i:i + 1].view(np.int64)[0]), place["start"] + i, n, i - a, near))
                            if len(rows) >= 2048:
                                yield to_batch(schema, list(zip(*rows)))
                                rows = []
                    if rows:
                        yield to_batch(schema, list(zip(*rows)))

    return placed.where(F.size("places") > 0).select("row_key", "n_words", "places").mapInArrow(shingle, _SHINGLE)


def contamination(docs: DataFrame, items: DataFrame, window=WINDOW, shingle=SHINGLE, one_word_in=ONE_WORD_IN) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, item_ids (strings, sorted), spans (word numbers, merged), contaminated."""
    classes, cut = item_windows(items, window, shingle)
    windows = staged(cut, "benchmark-windows")
    sizes = sorted(r[0] for r in windows.select("shingle_size").distinct().collect())  # at most ``shingle`` values
    placed = staged(_find_places(docs, _bits(windows), sizes, window), "benchmark-places")

    every = windows.select("shingle_size", "shingle").distinct()
    counted = (
        _shingles(placed, _bits(windows), sizes).groupBy("shingle_size", "shingle").agg(F.count("*").alias("n"))
        .join(every, ["shingle_size", "shingle"])
    )
    distinct = windows.drop("class").distinct()
    prefixes = staged(
        distinct.join(counted, ["shingle_size", "shingle"], "left")
        .groupBy("window", "size", "shingle_size")
        .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "shingle", "offset")).alias("rarest"))
        .where("rarest.n > 0")
        .select("window", "size", "shingle_size", "rarest.shingle", "rarest.offset"),
        "benchmark-prefixes",
    )
    near = _shingles(placed, _bits(prefixes), sizes, reach=window)
    start = F.col("position") - F.col("offset")
    found = staged(
        near.join(prefixes, ["shingle_size", "shingle"])
        .where((start >= 0) & (start + F.col("size") <= F.col("n_words")) & (F.col("before") >= F.col("offset")))
        .where(F.concat_ws(" ", F.slice("near", F.col("before") - F.col("offset") + 1, F.col("size"))) == F.col("window"))
        .select("row_key", "window", start.alias("start"), (start + F.col("size")).alias("end")),
        "benchmark-occurrences",
    )
    # Words hit: stretches that reach beyond what earlier ones of the document have covered.
    spans = found.groupBy("row_key", "start").agg(F.max("end").alias("end"))
    earlier = F.max("end").over(Window.partitionBy("row_key").orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
    opened = spans.withColumn("earlier", F.coalesce(earlier, F.lit(-1))).withColumn(
        "run", F.sum((F.col("start") > F.col("earlier")).cast("int")).over(Window.partitionBy("row_key").orderBy("start")))
    merged = opened.groupBy("row_key", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    hit = merged.groupBy("row_key").agg(
        F.sum(F.col("end") - F.col("start")).alias("n_hit"), F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))
    held = (
        found.select("row_key", "window").distinct().join(windows.select("window", "class").distinct(), "window")
        .select("row_key", "class").distinct().join(classes, "class").groupBy("row_key")
        .agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"))
    )
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return (
        placed.select("row_key", "doc_id", "n_words").join(hit.join(held, "row_key", "left"), "row_key", "left")
        .select(
            "doc_id", "n_words", n_hit.alias("n_hit"),
            F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
            F.coalesce("spans", F.array().cast("array<struct<start:int,end:int>>")).alias("spans"),
            ((n_hit > 0) & (one_word_in * n_hit >= F.col("n_words"))).alias("contaminated"),
        )
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """Documents that are not contaminated, with all their columns."""
    # The decision depends on the text alone, so it holds for every row with that text.
    key = fresh(docs, "_text")
    texts = docs.select(F.xxhash64("text").alias("doc_id"), "text")
    found = contamination(texts, items, **options).where("contaminated").select(F.col("doc_id").alias(key)).distinct()
    return docs.withColumn(key, F.xxhash64("text")).join(found, key, "left_anti").drop(key)
