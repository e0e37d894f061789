"""Hard negatives: rows of other labels that score close below an anchor's positives.

Scores are integer inner products of anchors with all rows. They are taken tile by tile by
Strassen's recursion: both tiles are halved, seven products of sums replace eight, odd sides
get a row or column of zeros. All steps are additions and products of 64-bit integers, which
wrap around; wrapping cancels out, so a score that fits 64 bits is exact.

Two passes over the rows, without a shuffle of vectors:

1. each task keeps the best ``positives`` rows of the anchor's label per anchor;
2. with the merged positives each task keeps, per anchor and positive, the best ``negatives``
   rows inside the score window.

What a task keeps merges by taking the best again, so rows may lie in any partition, a label
of any size is spread over all tasks, and a lost task is only run again. Anchors go to the
tasks in groups by hash of at most ``GROUP_BYTES`` of components; further groups are further
passes, so what is broadcast does not grow with the table.

Defined results: rows without id or label, or with a null, NaN or infinite component or no
vector take no part; of rows with the same id the least by label and components takes part; ties go
to the smaller id; shorter vectors count as ended by zeros; a component or score beyond 64 bits
counts as the nearest number of 64 bits; an anchor without a positive, or a positive without a
row in its window, gives no rows; so does an empty table. Further columns are ignored, whatever
their names.
"""

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from grovekit.llm.arrow import arrow_schema, slices, to_batch
from grovekit.session import staged

POSITIVES = 5
NEGATIVES = 10
#: A negative scores at least 30 and at most 90 hundredths of the positive.
WINDOW = (30, 90)
GROUP_BYTES = 16 << 20
_LEAF = 32
_TILE_ANCHORS = 256
_TILE_ROWS = 2048
_NONE = np.iinfo(np.int64).min


def _even(matrix, rows, columns):
    out = np.zeros((rows, columns), matrix.dtype)
    out[:matrix.shape[0], :matrix.shape[1]] = matrix
    return out


def strassen(a, b):
    """Product of two integer matrices; exact modulo 2 ** 64, or altogether for Python's integers."""
    m, k, n = a.shape[0], a.shape[1], b.shape[1]
    if min(m, k, n) <= _LEAF:
        return a @ b
    p, q, r = -(-m // 2), -(-k // 2), -(-n // 2)
    if m % 2 or k % 2:
        a = _even(a, 2 * p, 2 * q)
    if k % 2 or n % 2:
        b = _even(b, 2 * q, 2 * r)
    a11, a12, a21, a22 = a[:p, :q], a[:p, q:], a[p:, :q], a[p:, q:]
    b11, b12, b21, b22 = b[:q, :r], b[:q, r:], b[q:, :r], b[q:, r:]
    m1 = strassen(a11 + a22, b11 + b22)
    m2 = strassen(a21 + a22, b11)
    m3 = strassen(a11, b12 - b22)
    m4 = strassen(a22, b21 - b11)
    m5 = strassen(a11 + a12, b22)
    m6 = strassen(a21 - a11, b11 + b12)
    m7 = strassen(a12 - a22, b21 + b22)
    out = np.empty((2 * p, 2 * r), a.dtype)
    out[:p, :r] = m1 + m4 - m5 + m7
    out[:p, r:] = m3 + m5
    out[p:, :r] = m2 + m4
    out[p:, r:] = m1 - m2 + m3 + m6
    return out[:m, :n]


def products(a, b):
    """Inner products of the rows of ``a`` with the columns of ``b``, cut to 64 bits."""
    reach = np.abs(a.astype(float)).sum(axis=1).max(initial=0) * np.abs(b.astype(float)).max(initial=0)
    if reach < 2.0 ** 62:
        return strassen(a, b)
    return np.clip(strassen(a.astype(object), b.astype(object)), _NONE + 1, -(_NONE + 1)).astype(np.int64)


def _matrix(vectors, width):
    """Rows of a list column as one matrix of ``width`` columns, filled up with zeros."""
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    lengths = np.diff(vectors.offsets.to_numpy())
    out = np.zeros((len(lengths), max(width, lengths.max(initial=0))), np.int64)
    out[np.arange(out.shape[1]) < lengths[:, None]] = values
    return out[:, :width]  # an anchor's components end there, so the others meet zeros


class Best:
    """The best ``size`` (score, id) of every row of a matrix of scores, over any number of matrices.

    Scores are in descending order, ties by ascending id. Two heaps merge by offering one to the other.
    """

    def __init__(self, rows, size):
        self.score = np.full((rows, size), _NONE, np.int64)
        self.id = np.zeros((rows, size), np.int64)

    def offer(self, at, score, ids):
        """Offer scores to the rows ``at``; ``_NONE`` is no offer, ids ascend along a row."""
        size = self.score.shape[1]
        if score.shape[1] > size:
            # Only scores from the size-th best on can enter, and no less than what is held.
            least = np.partition(score, score.shape[1] - size, axis=1)[:, score.shape[1] - size]
            row, column = np.nonzero((score >= np.maximum(least, self.score[at, -1])[:, None]) & (score > _NONE))
        else:
            row, column = np.nonzero(score > _NONE)
        if not len(row):
            return
        held_row, held_column = np.nonzero(self.score[at] > _NONE)
        row_of = np.concatenate([row, held_row])
        score_of = np.concatenate([score[row, column], self.score[at][held_row, held_column]])
        id_of = np.concatenate([np.broadcast_to(ids, score.shape)[row, column], self.id[at][held_row, held_column]])
        order = np.lexsort((id_of, -score_of, row_of))
        row_of = row_of[order]
        place = np.arange(len(order)) - np.searchsorted(row_of, row_of)
        order, row_of, place = order[place < size], row_of[place < size], place[place < size]
        new_score, new_id = np.full((len(at), size), _NONE, np.int64), np.zeros((len(at), size), np.int64)
        new_score[row_of, place], new_id[row_of, place] = score_of[order], id_of[order]
        self.score[at], self.id[at] = new_score, new_id

    def entries(self):
        """(row, score, id) of everything held."""
        row, place = np.nonzero(self.score > _NONE)
        return row, self.score[row, place], self.id[row, place]


class Group:
    """A bounded group of anchors, in order of label."""

    def __init__(self, table):
        vectors = table.column("ints").combine_chunks()
        self.width = int(np.diff(vectors.offsets.to_numpy()).max(initial=0))
        order = np.argsort(table.column("label").to_numpy(), kind="stable")
        self.ids = table.column("vec_id").to_numpy()[order]
        self.labels = table.column("label").to_numpy()[order]
        self.vectors = _matrix(vectors, self.width)[order]
        self.low = self.high = self.anchor = None

    def set_positives(self, anchors, scores, window):
        """Score windows, one per anchor and positive; ``anchors`` are places in this group."""
        low, high = window
        order = np.argsort(anchors, kind="stable")
        self.anchor = np.asarray(anchors, np.int64)[order]
        scores = np.asarray(scores, np.int64)[order]
        # Exact in 64 bits for any score: low * s <= 100 * x <= high * s.
        whole, rest = scores // 100, scores % 100
        self.low, self.high = whole * low - (-(rest * low) // 100), whole * high + rest * high // 100
        return order


def _rows_of(batches, group):
    """(ids, labels, matrix) of tiles of rows, ids ascending."""
    for batch in slices(batches, _TILE_ROWS):
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        order = np.argsort(ids, kind="stable")
        yield ids[order], batch.column(1).to_numpy(zero_copy_only=False)[order], _matrix(batch.column(2), group.width)[order]


def _best_positives(batches, group, size):
    best = Best(len(group.ids), size)
    for ids, labels, matrix in _rows_of(batches, group):
        for label in np.intersect1d(labels, group.labels):
            first, last = np.searchsorted(group.labels, label), np.searchsorted(group.labels, label, "right")
            same = np.nonzero(labels == label)[0]
            columns = np.ascontiguousarray(matrix[same].T)
            for i in range(first, last, _TILE_ANCHORS):
                at = np.arange(i, min(i + _TILE_ANCHORS, last))
                score = products(group.vectors[at], columns)
                score[group.ids[at][:, None] == ids[same]] = _NONE
                best.offer(at, score, ids[same])
    return best


def _best_negatives(batches, group, size):
    best = Best(len(group.anchor), size)
    for ids, labels, matrix in _rows_of(batches, group):
        columns = np.ascontiguousarray(matrix.T)
        for i in range(0, len(group.ids), _TILE_ANCHORS):
            at = np.arange(i, min(i + _TILE_ANCHORS, len(group.ids)))
            pairs = np.arange(np.searchsorted(group.anchor, at[0]), np.searchsorted(group.anchor, at[-1], "right"))
            if not len(pairs):
                continue
            score = products(group.vectors[at], columns)
            score[group.labels[at][:, None] == labels] = _NONE
            score = score[group.anchor[pairs] - at[0]]
            score[(score < group.low[pairs][:, None]) | (score > group.high[pairs][:, None])] = _NONE
            best.offer(pairs, score, ids)
    return best


def _mapped(rows, held, find, size):
    schema = "slot int, score long, id long"
    out = arrow_schema(schema)

    def run(batches):
        group = held.value
        best = find(batches, group, size)
        yield to_batch(out, best.entries())

    return rows.mapInArrow(run, schema)


def prepared(embeddings, scale=256):
    """One row per usable id: ``vec_id``, ``label`` and the components ``ints``, as whole numbers."""
    number = F.transform("embedding", lambda x: x.cast("double"))
    usable = F.forall(number, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform(number, lambda x: F.floor(x * scale))
    return (
        embeddings.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable)
        .select(F.col("vec_id").cast("long"), F.col("label").cast("long"), whole.alias("ints"))
        .groupBy("vec_id").agg(F.min(F.struct("label", "ints")).alias("row")).select("vec_id", "row.label", "row.ints")
    )


def _first(df, by, size, name):
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "id")
    return df.withColumn(name, F.row_number().over(order)).where(F.col(name) <= size)


def mine(rows, is_anchor, positives=POSITIVES, negatives=NEGATIVES, window=WINDOW, group_bytes=GROUP_BYTES):
    """Hard negatives of the ``prepared`` rows for which the column ``is_anchor`` holds.

    Gives anchor_id, positive_id, rank, negative_id, positive_score and negative_score.
    """
    spark = rows.sparkSession
    rows = staged(rows, "negatives-rows")
    anchors = rows.where(is_anchor)
    total, width = anchors.agg(F.count(F.lit(1)), F.max(F.size("ints"))).first()
    groups = -(-total * 8 * max(width or 0, 1) // group_bytes)
    found = []
    for g in range(groups):
        mine_only = anchors.where(F.pmod(F.xxhash64("vec_id"), F.lit(groups)) == g)
        group = Group(mine_only.toArrow())
        if not len(group.ids):
            continue
        near = _first(_mapped(rows, spark.sparkContext.broadcast(group), _best_positives, positives), ["slot"], positives, "_rank")
        near = near.select("slot", "score", "id").toArrow()
        slot, score, other = (near.column(c).to_numpy() for c in ("slot", "score", "id"))
        order = group.set_positives(slot, score, window)
        ids = spark.createDataFrame(
            list(zip(range(len(order)), group.ids[slot[order]].tolist(), other[order].tolist(), score[order].tolist())),
            "slot int, anchor_id long, positive_id long, positive_score long")
        best = _first(_mapped(rows, spark.sparkContext.broadcast(group), _best_negatives, negatives), ["slot"], negatives, "rank")
        found.append(best.join(ids, "slot").select(
            "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
            F.col("score").alias("negative_score")))
    if not found:
        return spark.createDataFrame(
            [], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    out = found[0]
    for df in found[1:]:
        out = out.unionByName(df)
    return out
