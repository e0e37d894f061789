"""Near-duplicate vectors by sorted projection passes.

In each pass vectors are ordered by their label and the concatenated signs of random
projections; vectors that point the same way share a long prefix and lie close together.
Every vector is compared with at least the ``window`` ones before it in the order. The order is
numbered and cut into blocks that overlap by a window, so results do not depend on partitions.
Pairs whose cosine reaches the threshold are links, united across passes into components. All links
inside a component are then counted, also those of dense groups far wider than a window: its vectors
lie in cells, and pairs of cells are taken as a whole, left out as a whole, or compared.

A pair of cosine c agrees in a bit with probability 1 - arccos(c) / pi, so the number of passes
follows from the number of vectors of the largest label: so many that a pair at the threshold is
missed by all with a probability under ``miss``. That holds for spread vectors; where very many lie
just below the threshold they fill windows, and a vector with one or two links may lose them. It grows slowly, as a small power of the table.

Equal vectors of a label are one class: their links are counted, not listed. So a window
never fills with copies, and a hot vector is one row.

Defined results: a vector that is null, zero, or holds null or non-finite components, and any
vector with a null label, links with nothing; so do vectors of different lengths. A null id takes part
and is never a component; repeated rows are vectors of their own; an empty table gives no
rows. Further columns are ignored.
"""

import math
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from grovekit.llm.arrow import arrow_schema, slices, to_batch
from grovekit.llm.components import connected_components
from grovekit.session import staged

COSINE = 0.98
WINDOW = 48
MISS = 1e-5
BITS = 62
_BLOCK = 2048  # rows of the order compared in one piece
_CELL = 512  # vectors of components compared in one piece
_FAN = 64  # cells in a cell of the next level
_MARGIN = 1e-6  # angle within which caps decide nothing
_SEED = 97


def passes_for(vectors, cosine=COSINE, window=WINDOW, miss=MISS):
    """Passes needed for a label with so many distinct vectors."""
    if vectors <= window:
        return 1
    bits = math.log2(vectors / window) + 1
    together = (1 - math.acos(cosine) / math.pi) ** bits
    return math.ceil(math.log(miss) / math.log(1 - together))


def _numbered(rows, order):
    """Adds ``number``, the place in the order, which must be total; places of earlier partitions
    come from one row per partition."""
    placed = staged(
        rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()), "vector-order")
    part = F.shiftright("at", 33)
    totals = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    before = totals.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    return placed.withColumn("part", part).join(F.broadcast(before), "part").withColumn(
        "number", F.col("before") + F.col("at").bitwiseAND((1 << 33) - 1)).drop("part", "at", "before")


def _units(column):
    """Matrix of unit vectors in double precision; all rows have the same length."""
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    v = flat.reshape(len(column), -1)
    v = v / np.abs(v).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def _linked(left, right, cosine):
    """Which rows of two matrices (or of two stacks of matrices) reach the threshold."""
    product = left @ np.swapaxes(right, -1, -2)
    linked = product >= cosine
    # The dot product of two rows alone, so that a tie does not depend on the block.
    for *k, i, j in np.argwhere(np.abs(product - cosine) < 1e-9):
        linked[(*k, i, j)] = np.dot(left[(*k, i)], right[(*k, j)]) >= cosine
    return linked


def _segments(table, *keys):
    """(start, end) of the stretches of rows with equal keys."""
    columns = [table.column(k).to_numpy() for k in keys]
    change = np.zeros(len(table), bool)
    for c in columns:
        change[1:] |= c[1:] != c[:-1]
    starts = [0, *np.flatnonzero(change)]
    return zip(starts, [*starts[1:], len(table)])


def _keyed(classes, passes):
    """A row per pass and class, with the signs of the projections of the pass as sort key."""
    ddl = "pass int, label long, size int, signs long, node long"
    schema = arrow_schema(ddl)

    def project(batches):
        planes, weights = {}, 1 << np.arange(BITS - 1, -1, -1, dtype=np.int64)
        for batch in slices(batches, 256):
            table = pa.table({"node": batch.column("node"), "label": batch.column("label"), "embedding": batch.column("embedding"),
                              "size": pc.list_value_length(batch.column("embedding"))}).sort_by("size")
            for a, b in _segments(table, "size"):
                part = table.slice(a, b - a)
                n, units = part.column("size")[0].as_py(), _units(part.column("embedding"))
                if n not in planes:
                    planes[n] = np.random.default_rng(_SEED).standard_normal((passes * BITS, n))
                signs = (units @ planes[n].T > 0).reshape(len(units), passes, BITS) @ weights
                many = len(units)
                yield to_batch(schema, [
                    np.repeat(np.arange(passes), many), np.tile(part.column("label").to_numpy(), passes), np.full(passes * many, n),
                    signs.T.ravel(), np.tile(part.column("node").to_numpy(), passes)])

    return classes.mapInArrow(project, ddl)


def _forest(nodes, x, y):
    """Edges from every row to the least of those it is linked with, directly or not."""
    least = np.arange(len(nodes))
    while True:
        m, old = np.minimum(least[x], least[y]), least.copy()
        np.minimum.at(least, x, m)
        np.minimum.at(least, y, m)
        least = least[least]
        if (least == old).all():
            break
    moved = np.flatnonzero(least != np.arange(len(nodes)))
    return nodes[moved], nodes[least[moved]]


def _links(numbered, one, window, cosine):
    """Verified links of neighbours in the order, one per row, block and pass that joins what is linked.

    A block is a stretch of the order together with the ``window`` rows before it, so borders lose nothing.
    """
    block = _BLOCK * max(1, -(-window // _BLOCK))
    number = F.col("number")
    mine = F.floor(number / block)
    both = F.when(number % block >= block - window, F.array(mine, mine + 1)).otherwise(F.array(mine))
    rows = numbered.select("pass", "label", "size", "node", "number", F.explode(both).alias("block")).join(
        one.select("node", "embedding"), "node")
    ddl = "u long, v long"
    schema = arrow_schema(ddl)

    def compare(table):
        table, out = table.sort_by("number"), [[], []]
        for a, b in _segments(table, "pass", "label", "size"):
            if b - a < 2:
                continue
            part = table.slice(a, b - a)
            units, n = _units(part.column("embedding")), b - a
            chunks = -(-n // window)
            padded = np.zeros(((chunks + 1) * window, units.shape[1]))
            padded[window:window + n] = units
            stack = padded.reshape(chunks + 1, window, -1)
            # Each stretch of window rows meets itself and the one before.
            chunk, i, j = np.nonzero(_linked(stack[1:], np.concatenate([stack[:-1], stack[1:]], axis=1), cosine))
            x, y = chunk * window + i, (chunk - 1) * window + j
            later = (x > y) & (y >= 0) & (x < n)
            u, v = _forest(part.column("node").to_numpy(), x[later], y[later])
            out[0].append(u)
            out[1].append(v)
        return pa.Table.from_batches([to_batch(schema, [np.concatenate(c) if c else [] for c in out])])

    return rows.groupBy("block").applyInArrow(compare, ddl)


def _weights_inside(members, cosine):
    """node, weight: copies of the vectors of its component linked with it, itself included, within its block."""
    ddl = "node long, weight long"
    schema = arrow_schema(ddl)

    def count(table):
        table, out = table.sort_by("number"), []
        for a, b in _segments(table, "component"):
            part = table.slice(a, b - a)
            units = _units(part.column("embedding"))
            linked = _linked(units, units, cosine)
            np.fill_diagonal(linked, True)
            out.append(linked @ part.column("copies").to_numpy())
        return pa.Table.from_batches([to_batch(schema, [table.column("node").to_numpy(), np.concatenate(out)])])

    return members.groupBy("block").applyInArrow(count, ddl)


def _caps(cells, level):
    """Per component and cell: a cap (centre and angle) that holds all its vectors, and its weight.

    A cell of level 0 is a block's share of a component, one of a higher level ``_FAN`` cells of the one below.
    """
    ddl = "component long, cell long, centre array<double>, angle double, weight long"
    schema = arrow_schema(ddl)

    def cap(table):
        units = _units(table.column("embedding" if level == 0 else "centre"))
        inner = 0.0 if level == 0 else table.column("angle").to_numpy()
        middle = units.sum(axis=0)
        size = math.sqrt(middle @ middle)
        middle = middle / size if size > 1e-9 else units[0]
        angle = float((np.arccos(np.clip(units @ middle, -1, 1)) + inner).max())
        weight = int(table.column("copies" if level == 0 else "weight").to_numpy().sum())
        first = [table.column(c)[0].as_py() for c in ("component", "cell")]
        return pa.Table.from_batches([to_batch(schema, [[x] for x in (*first, middle.tolist(), angle, weight)])])

    return cells.groupBy("component", "cell").applyInArrow(cap, ddl)


def _weights_across(members, cosine):
    """node, weight as above, but of vectors in other blocks, for components that span several.

    Caps of cells tell which pairs of cells are linked throughout or not at all, from cells of many blocks
    down to blocks; only pairs of blocks that they leave open are compared.
    """
    spans = members.groupBy("component").agg(F.min("block").alias("first"), F.max("block").alias("last")).where("first < last")
    spans = staged(spans, "vector-spans")
    most = spans.agg(F.max(F.col("last") - F.col("first") + 1)).head()[0]
    if most is None:
        return None
    rows = staged(members.join(spans, "component").withColumn("cell", F.col("block") - F.col("first")), "vector-cells")
    levels = [staged(_caps(rows, 0), "vector-caps")]
    while most > _FAN:
        most = -(-most // _FAN)
        below = levels[-1].withColumn("cell", F.floor(F.col("cell") / _FAN))
        levels.append(staged(_caps(below, len(levels)), "vector-caps"))
    limit, weights, open_pairs = math.acos(cosine), [], None
    for level in range(len(levels) - 1, -1, -1):
        def side(s, level=level):
            return levels[level].select("component", F.floor(F.col("cell") / _FAN).alias("up_" + s), F.col("cell").alias(s), *(
                F.col(c).alias(f"{c}_{s}") for c in ("centre", "angle", "weight")))
        if open_pairs is None:
            pairs = side("a").join(side("b"), "component")
        else:
            up = open_pairs.select("component", F.col("a").alias("up_a"), F.col("b").alias("up_b"))
            pairs = up.join(side("a"), ["component", "up_a"]).join(side("b"), ["component", "up_b"])
        dot = F.aggregate(F.zip_with("centre_a", "centre_b", lambda x, y: x * y), F.lit(0.0), lambda x, y: x + y)
        apart, wide = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), dot))), F.col("angle_a") + F.col("angle_b")
        own = F.col("a") == F.col("b")
        # Pairs of a cell with itself are opened down to the blocks, whose inside is counted elsewhere.
        decided = pairs.where("a <= b" if level else "a < b").withColumn(
            "state", F.when(own, "open").when(apart + wide < limit - _MARGIN, "all").when(apart - wide > limit + _MARGIN, "none").otherwise("open"))
        decided = staged(decided.where("state <> 'none'").select("component", "a", "b", "weight_a", "weight_b", "state"), "vector-pairs")
        full = decided.where("state = 'all'")
        gained = full.select("component", F.col("a").alias("cells"), F.col("weight_b").alias("w")).unionByName(
            full.select("component", F.col("b").alias("cells"), F.col("weight_a").alias("w"))).groupBy("component", "cells").agg(F.sum("w").alias("weight"))
        weights.append(rows.select("component", "node", F.floor(F.col("cell") / _FAN ** level).alias("cells")).join(
            gained, ["component", "cells"]).select("node", "weight"))
        open_pairs = decided.where("state = 'open'").select("component", "a", "b")
    ddl = "node long, weight long"
    schema = arrow_schema(ddl)

    def count(table):
        table = table.sort_by("cell")
        (a, b), (_, c) = _segments(table, "cell")
        units, copies = _units(table.column("embedding")), table.column("copies").to_numpy()
        linked = _linked(units[a:b], units[b:c], cosine)
        weight = np.concatenate([linked @ copies[b:], linked.T @ copies[:b]])
        return pa.Table.from_batches([to_batch(schema, [table.column("node").to_numpy(), weight])])

    sides = open_pairs.select("component", "a", "b", F.explode(F.array("a", "b")).alias("cell"))
    compared = rows.select("component", "cell", "node", "copies", "embedding").join(sides, ["component", "cell"])
    weights.append(compared.groupBy("component", "a", "b").applyInArrow(count, ddl))
    return reduce(DataFrame.unionByName, weights)


def near_duplicates(vectors: DataFrame, cosine=COSINE, window=WINDOW, miss=MISS) -> DataFrame:
    """One row per vector: vec_id, n_links (other vectors linked directly), component_id, kept."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "embedding")
    double = F.transform("embedding", lambda x: x.cast("double"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = F.col("label").isNotNull() & F.col("v").isNotNull() & ~bad & F.exists("v", lambda x: x != 0.0)
    rows = rows.withColumn("v", double).withColumn("usable", F.coalesce(usable, F.lit(False)))
    # Adding zero makes -0.0 equal 0.0.
    zero = F.lit(0.0).cast(rows.schema["embedding"].dataType.elementType)
    every = staged(
        rows.select("vec_id", "label", F.when(F.col("usable"), F.sha2(F.to_json(F.transform("v", lambda x: x + F.lit(0.0))).cast("binary"), 256)).alias("digest"),
                    F.when(F.col("usable"), F.transform("embedding", lambda x: x + zero)).alias("embedding")), "vectors")
    usable = every.where("digest is not null")
    classes = usable.groupBy("label", "digest").agg(
        F.min("vec_id").alias("least"), F.count("*").alias("copies"), F.first("embedding").alias("embedding"))
    # A class gets a number of its own, as a vector without an id has none.
    one = staged(classes.withColumn("node", F.coalesce("least", F.xxhash64("label", "digest"))), "vector-classes")
    largest = one.groupBy("label").agg(F.count("*").alias("n")).agg(F.max("n")).head()[0] or 0
    keyed = _keyed(one.select("node", "label", "embedding"), passes_for(largest, cosine, window, miss))
    numbered = staged(_numbered(keyed, ["pass", "label", "size", "signs", "node"]), "vector-keys")
    labels = staged(connected_components(_links(numbered, one, window, cosine).distinct()), "vector-components")
    first_pass = numbered.where("pass = 0").select("node", "signs")
    members = labels.join(one.select("node", "least", "copies", "embedding"), "node").join(first_pass, "node")
    members = staged(
        _numbered(members, ["component", "signs", "node"]).withColumn("block", F.floor(F.col("number") / _CELL)), "vector-members")
    weights, across = _weights_inside(members, cosine), _weights_across(members, cosine)
    if across is not None:
        weights = weights.unionByName(across)
    weights = weights.groupBy("node").agg(F.sum("weight").alias("weight"))
    smallest = members.groupBy("component").agg(F.min("least").alias("smallest"))
    classes = one.join(labels, "node", "left").join(smallest, "component", "left").join(weights, "node", "left").select(
        "label", "digest", (F.coalesce("weight", "copies") - 1).alias("links"), F.coalesce("smallest", "least").alias("component"))
    component = F.coalesce("component", "vec_id")
    return every.select("vec_id", "label", "digest").join(classes, ["label", "digest"], "left").select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"))
