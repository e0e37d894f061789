"""Packing of tokenized documents into sequences of bounded length.

Pattern packing: the histogram of piece lengths is fitted by repeat counts of patterns of
two or three lengths that fill a sequence, by non-negative least squares; the counts are
rounded down so that no length is overdrawn, and what is left is packed by best fit on the
histogram. All of this works on at most ``size`` counts, whatever the number of documents.
Pieces then take the places of their length in order of rank; ranks are taken within
(length, bucket) and shifted by the totals of earlier buckets, so that a length that a
third of all pieces share is spread over many tasks.

Defined results: a null or empty text is one piece that holds the end id alone; a document
longer than ``size`` is cut so that its first piece holds the remainder; documents with an
equal or null id are packed each on their own; an empty table has no pieces. Further
columns of the input are ignored.
"""

from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from grovekit.llm.arrow import arrow_schema, slices, to_batch
from grovekit.llm.tokens import default_path, encoder
from grovekit.session import staged

SIZE = 1024
END_ID = 2
_STEPS = 400
_BUCKET_PIECES = 200_000
_PIECE = "piece_key long, doc_id long, piece int, start long, length long, ids binary"


def cut_into_pieces(docs: DataFrame, size=SIZE, end_id=END_ID, tokenizer=None) -> DataFrame:
    """Pieces of at most ``size`` ids (little-endian unsigned 32-bit), one row each, keyed by ``piece_key``."""
    tokenizer = tokenizer or default_path()
    schema = arrow_schema(_PIECE)

    def cut(batches):
        from pyspark import TaskContext

        encode_ids, tail = encoder(tokenizer), np.array([end_id], "<u4").tobytes()
        key = TaskContext.get().partitionId() << 40
        for batch in slices(batches, 256):
            rows = []
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encode_ids(batch.column("text").to_pylist())):
                ids += tail
                n = len(ids) // 4
                stops = range((n - 1) % size + 1, n + 1, size)
                for i, stop in enumerate(stops):
                    start = stops[i - 1] if i else 0
                    rows.append((key, doc_id, i, start, stop - start, ids[4 * start:4 * stop]))
                    key += 1
            yield to_batch(schema, list(zip(*rows)) or [[]] * len(schema))

    columns = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return columns.mapInArrow(cut, _PIECE)


def full_patterns(size):
    """All pairs and triples of lengths, ascending, that add up to ``size``: lengths, and which are triples."""
    pairs = np.array([(a, size - a, 0) for a in range(1, size // 2 + 1)], np.int32).reshape(-1, 3)
    triples = [
        np.stack([np.full(b.size, a, np.int32), b, size - a - b], axis=1)
        for a in range(1, size // 3 + 1)
        for b in [np.arange(a, (size - a) // 2 + 1, dtype=np.int32)]
    ]
    return np.concatenate([pairs, *triples]) if triples else pairs


def fit_counts(histogram, patterns, steps=_STEPS):
    """Non-negative least squares by accelerated projected gradients; residuals of short lengths weigh less.

    ``histogram[n]`` is the number of pieces of n ids. A short piece that is left over still
    fits beside other pieces, a long one opens a sequence of its own.
    """
    size = len(histogram) - 1
    weight = np.linspace(0.1, 1.0, size + 1)
    weight[0] = 0.0
    target = weight * histogram

    def forward(x):
        return weight * sum(np.bincount(patterns[:, k], x, size + 1) for k in range(3))

    def backward(r):
        r = weight * r
        return r[patterns[:, 0]] + r[patterns[:, 1]] + r[patterns[:, 2]]

    v = np.ones(len(patterns))
    for _ in range(20):  # power iteration for the step length
        v = backward(forward(v))
        norm = np.linalg.norm(v)
        v /= norm
    x = y = np.zeros(len(patterns))
    t = 1.0
    for _ in range(steps):
        new = np.maximum(0.0, y - backward(forward(y) - target) / (1.05 * norm))
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    return x


def best_fit(histogram):
    """Best-fit decreasing on counts: list of (lengths, repeats) that uses up the histogram."""
    size = len(histogram) - 1
    open_bins = [Counter() for _ in range(size + 1)]  # by room left: lengths -> repeats
    with_room = np.zeros(size + 1, np.int64)
    for length in range(size, 0, -1):
        todo = int(histogram[length])
        while todo:
            fitting = np.flatnonzero(with_room[length:])
            if not len(fitting):
                # Several in one new sequence at a time keep the number of kinds small.
                fill = size // length
                whole, rest = divmod(todo, fill)
                for lengths, n in (((length,) * fill, whole), ((length,) * rest, 1)):
                    if n and lengths:
                        room = size - sum(lengths)
                        open_bins[room][lengths] += n
                        with_room[room] += n
                break
            room = int(fitting[0]) + length
            lengths, n = next(iter(open_bins[room].items()))
            each = min(room // length, todo)
            take = min(n, todo // each)
            open_bins[room][lengths] -= take
            if not open_bins[room][lengths]:
                del open_bins[room][lengths]
            with_room[room] -= take
            left = room - each * length
            open_bins[left][(*lengths, *(length,) * each)] += take
            with_room[left] += take
            todo -= take * each
    return [(lengths, n) for room in open_bins for lengths, n in room.items()]


def plan(histogram):
    """(lengths, repeats) of all sequences for the histogram, index 0 unused; full pieces stand alone."""
    size = len(histogram) - 1
    left = np.array(histogram, np.int64)
    out = [((size,), int(left[size]))] if left[size] else []
    left[0] = left[size] = 0
    patterns = full_patterns(size)
    if left.any() and len(patterns):
        used = (left[patterns[:, 0]] > 0) & (left[patterns[:, 1]] > 0) & ((left[patterns[:, 2]] > 0) | (patterns[:, 2] == 0))
        patterns = patterns[used]
    if left.any() and len(patterns):
        x = fit_counts(left.astype(float), patterns)
        # Largest counts first; a count takes what is there, rounded to the nearest.
        for i in np.argsort(-x, kind="stable"):
            repeats = int(x[i] + 0.5)
            if not repeats:
                break
            need = Counter(int(n) for n in patterns[i] if n)
            repeats = min(repeats, *(int(left[n]) // m for n, m in need.items()))
            if repeats:
                for n, m in need.items():
                    left[n] -= m * repeats
                out.append((tuple(sorted(need.elements(), reverse=True)), repeats))
    return out + best_fit(left)


def _places(sequences):
    """For each length, runs of ranks: those from ``first`` on go to the sequences from ``sequence`` on, at ``offset``."""
    ranks, rows, sequence = Counter(), [], 0
    for lengths, repeats in sequences:
        offset = 0
        for n in lengths:
            rows.append((n, ranks[n], sequence, offset))
            ranks[n] += repeats
            offset += n
        sequence += repeats
    return rows


def _ranked(pieces, totals):
    """Rank of each piece among those of its length, from 0."""
    buckets = max(1, -(-max(totals, default=0) // _BUCKET_PIECES))
    spread = pieces.select("piece_key", "length").withColumn("bucket", F.pmod(F.xxhash64("piece_key"), F.lit(buckets)))
    within = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("piece_key")) - 1
    counted = spread.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = counted.select(
        "length", "bucket",
        (F.sum("n").over(Window.partitionBy("length").orderBy("bucket")) - F.col("n")).alias("before"))
    return (
        spread.withColumn("within", within).join(before, ["length", "bucket"])
        .select("piece_key", "length", (F.col("within") + F.col("before")).cast("long").alias("rank"))
    )


def pack(docs: DataFrame, size=SIZE, end_id=END_ID, tokenizer=None) -> DataFrame:
    """Pieces with their places: doc_id, piece, start, length, ids, sequence_id, offset."""
    pieces = staged(cut_into_pieces(docs, size, end_id, tokenizer), "pieces")
    histogram = [0] * (size + 1)
    for row in pieces.groupBy("length").count().collect():  # at most ``size`` rows
        histogram[row["length"]] = row["count"]
    by_length = {}
    for length, first, sequence, offset in _places(plan(histogram)):
        by_length.setdefault(length, []).append((first, sequence, offset))
    schema = arrow_schema("piece_key long, sequence_id long, offset long")
    tables = {n: tuple(np.array(c, np.int64) for c in zip(*sorted(v))) for n, v in by_length.items()}

    def place(batches):
        for batch in slices(batches, 65_536):
            keys, length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("piece_key", "length", "rank"))
            sequence, offset = np.empty(len(keys), np.int64), np.empty(len(keys), np.int64)
            for n in np.unique(length):
                at = length == n
                first, base, within = tables[int(n)]
                i = np.searchsorted(first, rank[at], side="right") - 1
                sequence[at] = base[i] + rank[at] - first[i]
                offset[at] = within[i]
            yield to_batch(schema, [keys, sequence, offset])

    placed = _ranked(pieces, histogram).mapInArrow(place, "piece_key long, sequence_id long, offset long")
    return pieces.join(placed, "piece_key").select("doc_id", "piece", "start", "length", "ids", "sequence_id", "offset")


def sequences(packed: DataFrame) -> DataFrame:
    """Whole sequences for training: sequence_id, ids, and the lengths of the pieces in them, in order."""
    held = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "length", "ids"))).alias("p"))
    return held.select("sequence_id", F.concat_ws("", F.transform("p", lambda x: F.hex(x["ids"]))).alias("h"), "p").select(
        "sequence_id", F.unhex("h").alias("ids"), F.col("p.length").alias("lengths"))
