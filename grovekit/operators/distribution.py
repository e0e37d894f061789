"""Node-type distributions per language: counts, entropy, similarity, axes, clusters."""

from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.sql import Window, functions as F

from grovekit.operators.bounded import LOOKUP_ROWS, resolve_small
from grovekit.session import cut_lineage


def type_counts(nodes, by):
    """Nodes per key and type."""
    return nodes.groupBy(*by, "type").agg(F.count(F.lit(1)).alias("cnt"))


def counter_merge(*counts, by):
    """Sum of several count tables."""
    merged = counts[0]
    for other in counts[1:]:
        merged = merged.unionByName(other)
    return merged.groupBy(*by, "type").agg(F.sum("cnt").alias("cnt"))


def type_union(counts):
    """All types that occur."""
    return counts.select("type").distinct()


def top_types(counts, n=10):
    """Most frequent types per language, ties by name."""
    order = Window.partitionBy("language").orderBy(F.desc("cnt"), "type")
    return counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def language_names(counts):
    """Sorted language names, checked to be few."""
    small = resolve_small(counts.select("language").distinct())
    if small is None:
        raise ValueError(f"more than {LOOKUP_ROWS} languages")
    return sorted(row[0] for row in small.collect())


def matrix_by_type(counts, languages=None, value="cnt"):
    """One row per type, one column per language, zeros filled."""
    languages = list(languages or language_names(counts))
    return (
        counts.groupBy("type").pivot("language", languages).agg(F.sum(value))
        .na.fill(0, subset=languages)
    )


def matrix_align(counts, languages=None):
    """Long count table with every type under every language."""
    languages = list(languages or language_names(counts))
    return matrix_by_type(counts, languages).unpivot(["type"], languages, "language", "cnt")


def type_frequency_matrix(counts):
    """One row per language, one column per type, zeros filled.

    Spark refuses the pivot beyond ``spark.sql.pivotMaxValues`` types; the long tables
    have no such limit.
    """
    return counts.groupBy("language").pivot("type").agg(F.sum("cnt")).na.fill(0)


def type_distribution(counts):
    """Share of each type within its language."""
    total = F.sum("cnt").over(Window.partitionBy("language"))
    return counts.select("language", "type", (F.col("cnt") / total).alias("p"))


def type_entropy(shares):
    """Shannon entropy in bits per language."""
    p = F.col("p")
    return shares.where(p > 0).groupBy("language").agg(
        (-F.sum(p * F.log2(p))).alias("entropy_bits")
    )


def order_entropy(entropies):
    """Ranks from the highest entropy down; one row per language."""
    order = Window.orderBy(F.desc("entropy_bits"), "language")
    return entropies.withColumn("rank", F.row_number().over(order))


def pairwise(weights, weight="p"):
    """Dot product of the type weights of every two languages.

    Only types two languages share meet in the join. A row of weight zero per language
    under one reserved type makes pairs without a common type come out as zero.
    """
    reserved = weights.select("language").distinct().select(
        "language", F.lit("").alias("type"), F.lit(0.0).alias(weight))
    weights = weights.select("language", "type", weight).unionByName(reserved)
    left = weights.select(F.col("language").alias("a"), "type", F.col(weight).alias("wa"))
    right = weights.select(F.col("language").alias("b"), "type", F.col(weight).alias("wb"))
    return (
        left.join(right, "type").groupBy("a", "b")
        .agg(F.sum(F.col("wa") * F.col("wb")).alias("dot"))
    )


def type_cosine(shares):
    """Cosine of the distributions of every two languages."""
    norms = shares.groupBy("language").agg(F.sqrt(F.sum(F.col("p") * F.col("p"))).alias("norm"))
    scaled = shares.join(norms, "language").select(
        "language", "type", (F.col("p") / F.col("norm")).alias("w")
    )
    return pairwise(scaled, "w").withColumnRenamed("dot", "sim")


def distance_pairs(similarity):
    """One minus similarity, averaged over both directions, zero on the diagonal."""
    first, second = F.least("a", "b"), F.greatest("a", "b")
    halves = similarity.groupBy(first.alias("a"), second.alias("b")).agg(
        F.avg(1 - F.col("sim")).alias("_d")
    )
    both = halves.withColumn(
        "_turned", F.explode(F.when(F.col("a") == F.col("b"), F.array(F.lit(False)))
                             .otherwise(F.array(F.lit(False), F.lit(True))))
    )
    turned = F.col("_turned")
    return both.select(
        F.when(turned, F.col("b")).otherwise(F.col("a")).alias("a"),
        F.when(turned, F.col("a")).otherwise(F.col("b")).alias("b"),
        F.when(F.col("a") == F.col("b"), 0.0).otherwise(F.col("_d")).alias("distance"),
    )


def type_pca(shares, k=2, languages=None):
    """Coordinates of the languages on the main axes, and the variance each axis explains.

    The table is held by type, so it may be as long as it likes; its columns are the
    languages. Types are centred across languages. Because every language sums to one
    the columns are centred as well, so the axes of this table, scaled by their spread,
    are the coordinates of the languages. The largest loading of an axis is positive.
    """
    languages = list(languages or language_names(shares))
    wide = matrix_by_type(shares, languages, "p")
    mean = sum(F.col(f"`{c}`") for c in languages) / len(languages)
    centred = wide.select(*[(F.col(f"`{c}`") - mean).alias(c) for c in languages])
    vectors = VectorAssembler(inputCols=languages, outputCol="v").transform(centred).select("v")
    spread = centred.select(
        sum(F.col(f"`{c}`") * F.col(f"`{c}`") for c in languages).alias("s")
    ).agg(F.sum("s")).first()[0]
    k = min(k, len(languages))
    model = PCA(k=k, inputCol="v", outputCol="axes").fit(vectors)
    axes, explained = model.pc.toArray(), model.explainedVariance.toArray()
    rows = []
    for j in range(k):
        axis = axes[:, j]
        sign = 1.0 if axis[abs(axis).argmax()] >= 0 else -1.0
        scale = sign * (max(explained[j], 0.0) * spread) ** 0.5
        rows += [
            (language, j + 1, float(axis[i] * scale), float(explained[j]))
            for i, language in enumerate(languages)
        ]
    return shares.sparkSession.createDataFrame(
        rows, "language string, component int, score double, explained double"
    )


def average_linkage(distances):
    """Merge table of average-linkage clustering: ``step, left, right, distance, size``.

    Clusters are named after their first member. Every round merges all pairs that are
    nearest to each other, which average linkage allows, so rounds grow with the height
    of the tree rather than with the number of members. Lineage is cut per round.
    """
    pairs = cut_lineage(
        distances.where(F.col("a") < F.col("b")).select(
            "a", "b", F.col("distance").alias("d"),
            F.lit(1).cast("bigint").alias("na"), F.lit(1).cast("bigint").alias("nb"),
        )
    )
    merged = None
    while not pairs.isEmpty():
        found = cut_lineage(_mutual_nearest(pairs))
        step = found.select(
            F.col("a").alias("left"), F.col("b").alias("right"),
            F.col("d").alias("distance"), (F.col("na") + F.col("nb")).alias("size"),
        )
        merged = step if merged is None else merged.unionByName(step)
        pairs = cut_lineage(_relabel(pairs, found))
    if merged is None:
        return distances.sparkSession.createDataFrame(
            [], "step int, left string, right string, distance double, size bigint"
        )
    order = Window.orderBy("distance", "left", "right")
    return merged.select(F.row_number().over(order).alias("step"), "left", "right", "distance", "size")


def _both_ways(pairs):
    turned = F.col("_turned")
    return pairs.withColumn("_turned", F.explode(F.array(F.lit(False), F.lit(True)))).select(
        F.when(turned, F.col("b")).otherwise(F.col("a")).alias("a"),
        F.when(turned, F.col("a")).otherwise(F.col("b")).alias("b"),
        "d",
        F.when(turned, F.col("nb")).otherwise(F.col("na")).alias("na"),
        F.when(turned, F.col("na")).otherwise(F.col("nb")).alias("nb"),
    )


def _mutual_nearest(pairs):
    # Ties go to the pair with the smaller names, so the closest pair is always mutual.
    rank = F.struct("d", F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi"))
    nearest = _both_ways(pairs).groupBy("a", "na").agg(
        F.min_by(F.struct("b", "nb", "d"), rank).alias("n")
    )
    back = nearest.select(F.col("a").alias("b"), F.col("n.b").alias("back"))
    return (
        nearest.select("a", "na", "n.b", "n.nb", "n.d")
        .join(back, "b")
        .where((F.col("back") == F.col("a")) & (F.col("a") < F.col("b")))
        .drop("back")
    )


def _relabel(pairs, found):
    """Pairs between the new clusters: mean over all member pairs, by weights."""
    names = found.select(
        F.explode(F.array("a", "b")).alias("_old"), F.col("a").alias("_new"),
        (F.col("na") + F.col("nb")).alias("_size"),
    )
    left = names.toDF("a", "_a", "_na")
    right = names.toDF("b", "_b", "_nb")
    renamed = pairs.join(left, "a", "left").join(right, "b", "left").select(
        F.struct(F.coalesce("_a", "a").alias("name"), F.coalesce("_na", "na").alias("size")).alias("x"),
        F.struct(F.coalesce("_b", "b").alias("name"), F.coalesce("_nb", "nb").alias("size")).alias("y"),
        "d", (F.col("na") * F.col("nb")).alias("w"),
    ).where(F.col("x.name") != F.col("y.name"))
    return (
        renamed.groupBy(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))
        .agg((F.sum(F.col("d") * F.col("w")) / F.sum("w")).alias("d"))
        .select(
            F.col("x.name").alias("a"), F.col("y.name").alias("b"), "d",
            F.col("x.size").alias("na"), F.col("y.size").alias("nb"),
        )
    )
