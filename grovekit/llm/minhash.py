"""Near-duplicate documents by minima of universal hashes.

A document is the set of its distinct shingles of five words. Copies with the same words
are one class, represented by their smallest id. Of each class ``BANDS`` x ``ROWS`` hash
minima are kept; classes that agree in a band share a bucket. With 26 bands of 5 rows a
pair of similarity 0.85 is missed by all bands with probability 3e-7.

Members of a bucket are compared inside tasks, in blocks of up to ``SMALL``, and no pair
becomes a row unless it may be a link: its signatures must not disagree clearly (five
standard deviations), and its parity sketches must differ in few enough bits. A parity
sketch tells for each of 8 to 16 bins per shingle whether it holds an odd number of them;
two sketches never differ in more bits than the sets differ in shingles, so no link is
lost. Of clear candidates a block gives a spanning forest, of those near the limit all
that join different trees. They are confirmed by intersecting full shingle sets, and
links become components by large-star and small-star.

In the second round only buckets that have several blocks and whose members are not all in
one component yet are looked at again. The members of a bucket's largest component stay in
their block and are not compared with each other; each other member asks in every block. So
a bucket of near copies makes a row for each member, and one more for each block and member that is not
linked to the rest. Should a clear candidate be refused, its buckets go through a further
round without that pair, so no link is given up.

Defined results: null and empty texts have no shingles, link with nothing and are kept; a
null id takes part with its text but never represents a class; rows of one id count as one
document and share its result; an empty table gives no rows. Further columns are
ignored. Shingles are compared by 64-bit hashes.
"""

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from grovekit.llm.arrow import arrow_schema, slices, to_batch
from grovekit.llm.components import connected_components
from grovekit.llm.names import fresh
from grovekit.llm.words import WordHasher, mixed, shingle_set, space_words
from grovekit.session import cut_lineage, staged

SHINGLE = 5
PERCENT = 85
BANDS, ROWS = 26, 5
SMALL = 512
#: Share of the allowed difference below which a candidate counts as clear.
_CLEAR = 0.85
#: Slots of the filter on ids: 4 MB, however many there are; a full one only lets more texts pass.
_SLOTS = 1 << 25
_SEED = 20_240_601
_SKETCH = "doc_id long, class binary, n_shingles long, bands array<long>, signature binary"
_SET = "doc_id long, shingles array<long>, parity binary"


def _family(count, seed=_SEED):
    """Multipliers (odd) and addends of ``count`` multiply-shift hashes."""
    rng = np.random.default_rng(seed)
    return rng.integers(0, 1 << 64, (2, count, 1), np.uint64) | np.array([1, 0], np.uint64)[:, None, None]


def _minima(shingles, a, b):
    low = np.full(len(a), np.iinfo(np.uint64).max)
    for i in range(0, len(shingles), 1024):  # so that long documents stay in cache
        np.minimum(low, (a * shingles[i:i + 1024] + b >> np.uint64(32)).min(axis=1), out=low)
    return low


def sketches(docs: DataFrame, shingle=SHINGLE, bands=BANDS, rows=ROWS) -> DataFrame:
    """doc_id, class of its words, size of its set, band keys, and a signature of one byte per minimum."""
    schema = arrow_schema(_SKETCH)
    a, b = _family(bands * rows)

    def sketch(batches):
        hasher, last = WordHasher(), (None, None)
        for batch in slices(batches, 256):
            out = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                if last[0] != text or last[1] is None:
                    words = space_words(text)
                    found = shingle_set(hasher(words), shingle)
                    if len(found):
                        low = _minima(found, a, b)
                        keys = np.arange(bands, dtype=np.uint64)
                        for column in low.reshape(bands, rows).T:
                            keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + column)
                        value = (hashlib.blake2b(b" ".join(words), digest_size=16).digest(), len(found),
                                 keys.view(np.int64).tolist(), low.astype(np.uint8).tobytes())
                    else:
                        value = (None, 0, None, None)
                    last = text, value
                out.append((doc_id, *last[1]))
            yield to_batch(schema, list(zip(*out)) or [[]] * 5)

    return _columns(docs).mapInArrow(sketch, _SKETCH)


def _columns(docs):
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _parity(shingles):
    """Bits that tell of each bin whether it holds an odd number of shingles."""
    bins = 64
    while bins < 8 * len(shingles):
        bins *= 2
    odd = np.bincount((shingles & np.uint64(bins - 1)).astype(np.int64), minlength=bins) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _slot(column):
    return F.pmod(F.xxhash64(column), F.lit(_SLOTS))


def _sets(docs, nodes, shingle):
    """Full shingle sets and parity sketches of the documents whose ids are in ``nodes`` (node).

    A bitmap of hashed ids keeps most other texts from being split and shuffled.
    """
    schema = arrow_schema(_SET)
    place = _slot("node") + 1
    rows = nodes.groupBy(F.bitmap_bucket_number(place).alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")).collect()
    bitmap = {r.b - 1: bytes(r.bits) for r in rows}

    def sets(batches):
        hasher = WordHasher()
        for batch in slices(batches, 64):
            out = []
            for doc_id, slot, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "slot", "text"))):
                part = bitmap.get(slot >> 15)
                if part and part[(slot & 32767) >> 3] >> (slot & 7) & 1:
                    found = shingle_set(hasher(space_words(text)), shingle)
                    out.append((doc_id, found.view(np.int64), _parity(found)))
            yield to_batch(schema, list(zip(*out)) or [[]] * 3)

    found = _columns(docs).where("doc_id is not null").withColumn("slot", _slot("doc_id")).mapInArrow(sets, _SET)
    return found.join(nodes.select(F.col("node").alias("doc_id")), "doc_id", "left_semi").dropDuplicates(["doc_id"])


class _Forest:
    """Trees of integers."""

    def __init__(self, labels):
        first = {}
        self._up = [first.setdefault(label, i) for i, label in enumerate(labels)]

    def root(self, i):
        up = self._up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(self, i, j):
        i, j = self.root(i), self.root(j)
        self._up[max(i, j)] = min(i, j)
        return i != j


def _differences(parities, i, j):
    """Bits in which the sketches of pairs (i, j) differ; the larger sketch is folded to the size of the smaller."""
    size = np.array([len(p) for p in parities])
    least, out = np.minimum(size[i], size[j]), np.zeros(len(i), np.int64)
    for bins in np.unique(least):
        at = np.flatnonzero(least == bins)
        rows = np.unique(np.concatenate([i[at], j[at]]))
        folded = np.stack([np.bitwise_xor.reduce(np.frombuffer(parities[r], np.uint8).reshape(-1, bins), axis=0) for r in rows])
        step = max(1, (1 << 24) // int(bins))
        for k in range(0, len(at), step):
            part = at[k:k + step]
            differ = folded[np.searchsorted(rows, i[part])] ^ folded[np.searchsorted(rows, j[part])]
            out[part] = np.bitwise_count(differ).sum(axis=1, dtype=np.int64)
    return out


def _candidates(blocks, percent, minima):
    """Pairs (x, y, clear) of each block (key, block) that may be links and join different components."""
    schema = arrow_schema("x long, y long, clear boolean")
    similarity = percent / 100
    least = math.floor(minima * (similarity - 5 * math.sqrt(similarity * (1 - similarity) / minima)))

    def compare(table):
        table = table.combine_chunks()
        node, n, part, label = (table.column(c).to_numpy() for c in ("node", "n", "part", "component"))
        signs = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint8).reshape(len(node), -1)
        refused = {(x, y) for x, ys in zip(node.tolist(), table.column("refused").to_pylist()) for y in ys or ()}
        asks = table.column("asks").to_numpy(zero_copy_only=False)
        block = table.column("block")[0].as_py()
        left, right = [], []
        for i in range(len(node) - 1):
            fit = np.minimum(n[i], n[i + 1:]) * 100 >= percent * np.maximum(n[i], n[i + 1:])
            fit &= label[i + 1:] != label[i]
            if asks[i]:  # two that ask meet in every block and are compared in one
                fit &= ~asks[i + 1:] | (np.maximum(part[i], part[i + 1:]) == block)
            at = i + 1 + np.flatnonzero(fit)
            at = at[(signs[at] == signs[i]).sum(axis=1) >= least]
            left.append(np.full(len(at), i))
            right.append(at)
        i, j = (np.concatenate([np.empty(0, np.int64), *side]).astype(np.int64) for side in (left, right))
        differ = _differences(table.column("parity").to_pylist(), i, j)
        most = (100 - percent) / (100 + percent) * (n[i] + n[j])
        low, high = np.minimum(node[i], node[j]), np.maximum(node[i], node[j])
        order = np.lexsort((high, low, differ))
        order = order[differ[order] <= most[order] + 1e-9]
        trees, out, rest = _Forest(label.tolist()), [], []
        for k in order.tolist():
            pair = (int(low[k]), int(high[k]))
            if pair not in refused:
                if differ[k] > _CLEAR * most[k]:
                    rest.append((k, pair))
                elif trees.join(int(i[k]), int(j[k])):
                    out.append((*pair, True))
        out += [(*pair, False) for k, pair in rest if trees.root(int(i[k])) != trees.root(int(j[k]))]
        return pa.Table.from_batches([to_batch(schema, list(zip(*out)) or [[]] * 3)])

    return (
        blocks.groupBy("key", "block").applyInArrow(compare, "x long, y long, clear boolean")
        .groupBy("x", "y").agg(F.max("clear").alias("clear"))
    )


def _confirmed(pairs, sets, percent):
    """``pairs`` with ``good``: whether the full sets are similar enough."""
    both = F.size(F.array_intersect("a", "b"))
    return (
        pairs.join(sets.select(F.col("doc_id").alias("x"), F.col("shingles").alias("a")), "x")
        .join(sets.select(F.col("doc_id").alias("y"), F.col("shingles").alias("b")), "y")
        .select("x", "y", "clear", (100 * both >= percent * (F.size("a") + F.size("b") - both)).alias("good"))
    )


def _reopened(members, labels, refused):
    """Rows (key, node, part, block, asks, component) of the buckets that may still hold links.

    Those are buckets of several blocks that hold several components, and those with a refused
    pair. Members of a bucket's largest component are linked already and stay in their block; all others ask in
    every block. That is a row for each member and one for each asking member and block.
    """
    again = refused.select("node", F.lit(True).alias("again"))
    hit = members.join(again, "node", "left_semi").select("key").distinct()
    members = members.where("parts > 1").unionByName(members.where("parts = 1").join(hit, "key", "left_semi"))
    # Labels are looked up once for each document, not for each of its buckets.
    known = members.select("node").distinct().join(labels, "node", "left").join(again, "node", "left")
    now = members.join(known.withColumn("component", F.coalesce("component", "node")), "node")
    held = now.groupBy("key", "component").agg(F.count(F.lit(1)).alias("held"), F.max("again").alias("again"))
    open_ = held.groupBy("key").agg(
        F.max_by("component", F.struct("held", -F.col("component"))).alias("largest"), F.count(F.lit(1)).alias("components"),
        F.max("again").alias("again")).where("components > 1")
    found = now.drop("again").join(open_, "key").where(F.coalesce("again", F.lit(False)) | (F.col("parts") > 1))
    blocks = F.when(F.col("component") == F.col("largest"), F.array("part")).otherwise(F.sequence(F.lit(0), F.col("parts") - 1))
    return found.select("key", "node", "part", F.explode(blocks).alias("block"), (F.col("component") != F.col("largest")).alias("asks"), "component")


def _labels(members, members_sketch, sets, percent, minima, small):
    """Components (node, component) of the links between members (key, node, size) of buckets."""
    session = members.sparkSession
    tried = session.createDataFrame([], "x long, y long, clear boolean, good boolean")
    labels = session.createDataFrame([], "node long, component long")
    parts = F.ceil(F.col("size") / small).cast("int")
    # The bucket is part of the hash, so that members of one block are spread in other buckets.
    members = members.withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64("node", "key"), F.col("parts")).cast("int"))
    several, number = None, 1
    while True:
        refused = tried.where("clear and not good").groupBy(F.col("x").alias("node")).agg(F.collect_set("y").alias("refused"))
        if number == 1:
            rows = members.select(
                "key", "node", "part", F.col("part").alias("block"), F.lit(False).alias("asks"), F.col("node").alias("component"))
        else:
            rows = _reopened(members, labels, refused)
        blocks = rows.join(members_sketch.join(refused, "node", "left"), "node")
        pairs = staged(_candidates(blocks, percent, minima), "minhash-candidates")
        new = staged(_confirmed(pairs, sets, percent), "minhash-confirmed")
        tried = tried.unionByName(new)
        labels = connected_components(tried.where("good").select(F.col("x").alias("u"), F.col("y").alias("v")))
        if several is None:
            several = bool(members.where("parts > 1").limit(1).count())
        if not (number == 1 and several) and not new.where("clear and not good").limit(1).count():
            return labels
        number += 1


def near_duplicates(docs: DataFrame, percent=PERCENT, shingle=SHINGLE, bands=BANDS, rows=ROWS, small=SMALL) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest id in reach), kept."""
    every = staged(sketches(docs, shingle, bands, rows), "minhash-sketches")
    classes = every.where("class is not null").groupBy("class").agg(F.min("doc_id").alias("node"))
    # One signature per class: that of its representative, which all its copies share.
    first = every.where("class is not null and doc_id is not null").join(
        classes.select("class", F.col("node").alias("doc_id")), ["class", "doc_id"], "left_semi").dropDuplicates(["doc_id", "class"])
    buckets = first.select(F.col("doc_id").alias("node"), F.explode("bands").alias("key"))
    sizes = buckets.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    members = staged(buckets.join(sizes, "key"), "minhash-buckets")
    nodes = cut_lineage(members.select("node").distinct())
    sets = staged(_sets(docs, nodes, shingle), "minhash-sets")
    sketch = staged(
        first.select(F.col("doc_id").alias("node"), F.col("n_shingles").alias("n"), "signature")
        .join(sets.select(F.col("doc_id").alias("node"), "parity"), "node"), "minhash-members")
    labels = _labels(members, sketch, sets, percent, bands * rows, small)
    component = F.coalesce("component", "node", "doc_id")
    return (
        every.select("doc_id", "class", "n_shingles").join(classes, "class", "left").join(labels, "node", "left")
        .select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))
    )


def keep_one_each(docs: DataFrame, **options) -> DataFrame:
    """Documents of which no smaller near-duplicate exists, with all their columns.

    Of repeated rows one stays. Rows without an id cannot be told apart and all stay.
    """
    ours, row = fresh(docs, "_kept"), fresh(docs, "_row")
    kept = near_duplicates(docs, **options).where("kept").select(F.col("doc_id").alias(ours)).distinct()
    named = docs.join(kept, F.col("doc_id") == F.col(ours), "left_semi")
    once = F.row_number().over(Window.partitionBy("doc_id").orderBy("doc_id"))
    return (
        named.withColumn(row, once).where(F.col(row) == 1).drop(row)
        .unionByName(docs.where("doc_id is null"))
    )
