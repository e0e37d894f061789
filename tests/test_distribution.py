"""Clusters, axes and shares."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from grovekit.operators import distribution as D
from grovekit.plans import analysis as A

NAMES = "c cpp c_sharp go java javascript python ruby scala typescript".split()

# Published similarities above the diagonal, row by row.
SIMILARITY = """
.9491896956 .8714740544 .8138190132 .8838676408 .6472804607 .8576565209 .7339990983 .8947794394 .6612036854
.8225170582 .8249592190 .8417227456 .6280388177 .8176605604 .7149424271 .8616954931 .6346270126
.7411802079 .8879278791 .6406525186 .8906634483 .7590741089 .8695470344 .6386160306
.7689004478 .5584883483 .7402095149 .6496928980 .7727015792 .5689218739
.6288512291 .8800410314 .7607062168 .8925290499 .6464093822
.6598713956 .5687302436 .7044957727 .9649854868
.8799265512 .8681514293 .6535078189
.7302956196 .5655358017
.7181771221
"""
MERGES = [
    (0.035015, {"javascript", "typescript"}), (0.050810, {"c", "cpp"}), (0.107471, {"java", "scala"}),
    (0.109337, {"c_sharp", "python"}), (0.123583, {"java", "c_sharp"}), (0.143578, {"c", "c_sharp"}),
    (0.223038, {"c", "go"}), (0.253052, {"c", "ruby"}), (0.367287, {"c", "javascript"}),
]


def pairs(spark):
    rows = []
    for i, line in enumerate(SIMILARITY.strip().split("\n")):
        for j, s in enumerate(line.split()):
            a, b = NAMES[i], NAMES[i + 1 + j]
            rows += [(a, b, 1 - float(s)), (b, a, 1 - float(s))]
    rows += [(n, n, 0.0) for n in NAMES]
    return spark.createDataFrame(rows, "a string, b string, distance double")


def test_average_linkage(spark):
    found = D.average_linkage(pairs(spark)).orderBy("step").collect()
    assert len(found) == 9 and found[-1].size == 10
    for row, (distance, names) in zip(found, MERGES):
        assert row.distance == pytest.approx(distance, abs=2e-6)
        assert {row.left, row.right} == names or row.distance > 0.12


def test_average_linkage_with_ties(spark):
    rows = [(a, b, 0.5) for a in "abcde" for b in "abcde" if a != b]
    found = D.average_linkage(spark.createDataFrame(rows, "a string, b string, distance double"))
    assert found.count() == 4 and found.agg(F.max("size")).first()[0] == 5
    assert D.average_linkage(spark.createDataFrame([("a", "a", 0.0)], "a string, b string, distance double")).count() == 0


@pytest.fixture(scope="module")
def shares(spark):
    rng = np.random.default_rng(4)
    rows = [(lang, f"t{i}", int(rng.integers(1, 100))) for lang in NAMES[:5] for i in range(30) if rng.random() < 0.8]
    return rows, D.type_distribution(spark.createDataFrame(rows, "language string, type string, cnt bigint")).cache()


def dense(rows):
    names, types = sorted({r[0] for r in rows}), sorted({r[1] for r in rows})
    m = np.zeros((len(names), len(types)))
    for lang, t, n in rows:
        m[names.index(lang), types.index(t)] = n
    return names, m / m.sum(axis=1, keepdims=True)


def test_pca(shares):
    rows, p = shares
    names, m = dense(rows)
    centred = m - m.mean(axis=0)
    u, s, _ = np.linalg.svd(centred, full_matrices=False)
    found = {(r.language, r.component): r for r in D.type_pca(p).collect()}
    for j in (0, 1):
        scores = u[:, j] * s[j]
        scores *= np.sign(scores[abs(scores).argmax()])
        for i, name in enumerate(names):
            assert found[name, j + 1].score == pytest.approx(scores[i], abs=1e-9)
            assert found[name, j + 1].explained == pytest.approx(s[j] ** 2 / (s ** 2).sum())


def test_shares_and_similarity(shares):
    rows, p = shares
    names, m = dense(rows)
    assert all(r.s == pytest.approx(1) for r in p.groupBy("language").agg(F.sum("p").alias("s")).collect())
    sims = {(r.a, r.b): r.sim for r in D.type_cosine(p).collect()}
    assert len(sims) == 25
    for (a, b), s in sims.items():
        x, y = m[names.index(a)], m[names.index(b)]
        assert s == pytest.approx(x @ y / np.linalg.norm(x) / np.linalg.norm(y))
    entropy = {r.language: r.entropy_bits for r in D.type_entropy(p).collect()}
    for name, row in zip(names, m):
        assert entropy[name] == pytest.approx(-(row[row > 0] * np.log2(row[row > 0])).sum())


def test_disjoint_languages(spark):
    counts = spark.createDataFrame([("a", "x", 1), ("b", "y", 2)], "language string, type string, cnt bigint")
    assert {(r.a, r.b): r.sim for r in D.type_cosine(D.type_distribution(counts)).collect()} == {
        ("a", "a"): 1.0, ("a", "b"): 0.0, ("b", "a"): 0.0, ("b", "b"): 1.0}
    assert D.matrix_align(counts).count() == 4


def test_compare_languages(spark):
    counts = spark.createDataFrame(
        [("a", "x", 3), ("a", "y", 1), ("b", "x", 1), ("b", "z", 4), ("c", "z", 2)], "language string, type string, cnt bigint")
    result = A.compare_languages(counts)
    assert result["merges"].count() == 2 and result["axes"].count() == 6 and result["similarity"].count() == 9
