"""Quantiles and ranks on both ways of computing them."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from grovekit.operators import filters as OF, quantiles as Q, ranking as R
from grovekit.operators.bounded import lookup_join, resolve_small


@pytest.fixture(scope="module")
def numbers(spark):
    rng = random.Random(3)
    rows = [("hot" if i % 3 else f"k{i % 7}", rng.choice([rng.gauss(0, 50), float(rng.randint(-3, 3)), rng.random() * 1e6])) for i in range(4000)]
    return rows, spark.createDataFrame(rows, "language string, v double").cache()


def by_key(rows):
    groups = {}
    for k, v in rows:
        groups.setdefault(k, []).append(v)
    return groups


@pytest.mark.parametrize("few", [True, False])
def test_quantiles(numbers, few, monkeypatch):
    rows, df = numbers
    if not few:
        monkeypatch.setattr(Q, "BUILT_IN_VALUES", 0)
    probabilities = {"p0": 0.0, "p25": 0.25, "p80": 0.8, "p90": 0.9, "p100": 1.0}
    found = {r.language: r for r in Q.exact_quantiles(df, ["language"], "v", probabilities).collect()}
    for key, values in by_key(rows).items():
        for name, p in probabilities.items():
            assert found[key][name] == pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-12)
    whole = Q.exact_quantiles(df, [], "v", {"m": 0.5}).first()
    assert whole["m"] == pytest.approx(np.quantile([v for _, v in rows], 0.5))


@pytest.mark.parametrize("few", [True, False])
def test_describe(numbers, few, monkeypatch):
    rows, df = numbers
    if not few:
        monkeypatch.setattr(Q, "BUILT_IN_VALUES", 0)
    found = {r.language: r for r in Q.describe(df, ["language"], "v").collect()}
    for key, values in by_key(rows).items():
        assert found[key]["count"] == len(values)
        assert found[key]["std"] == pytest.approx(np.std(values, ddof=1))
        assert found[key]["p50"] == pytest.approx(np.quantile(values, 0.5), abs=1e-12)


@pytest.mark.parametrize("few", [True, False])
def test_statistical_filter_is_the_three_filters(spark, few, monkeypatch):
    if not few:
        monkeypatch.setattr(Q, "BUILT_IN_VALUES", 0)
    rng = random.Random(5)
    rows = [(i, "ab"[i % 3 // 2], rng.randint(1, 200), rng.randint(1, 4000) / rng.randint(1, 60)) for i in range(2000)]
    df = spark.createDataFrame(rows, "id int, language string, line_count int, avg_line_length double")
    at_once = OF.statistical_filter(df, ["language"])
    in_turn = OF.percentile_cap(OF.iqr_filter(df, ["language"], "avg_line_length"), ["language"])
    assert {r.id for r in at_once.collect()} == {r.id for r in in_turn.collect()}
    assert 0 < at_once.count() < 2000


@pytest.mark.parametrize("per_bucket", [50, 10_000_000])
def test_ranks(spark, per_bucket):
    rng = random.Random(9)
    ids = rng.sample(range(-10**9, 10**9), 3000)
    rows = [(i, "hot" if rng.random() < 0.6 else f"k{i % 5}") for i in ids]
    df = spark.createDataFrame(rows, "id bigint, language string")
    expected = {}
    for key in {k for _, k in rows}:
        for n, i in enumerate(sorted(i for i, k in rows if k == key)):
            expected[i] = n
    indexed = R.index_by_column(df, ["language"], "id", rows_per_bucket=per_bucket)
    assert {r.id: r.row_index for r in indexed.collect()} == expected
    first = R.first_by_column(df, ["language"], "id", 70, rows_per_bucket=per_bucket)
    assert {r.id for r in first.collect()} == {i for i, n in expected.items() if n < 70}


def test_both_ways_give_the_same_quantiles(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(rng.choice(["a", "b", None]), rng.random() * 10 ** rng.randint(0, 6)) for _ in range(1500)]
    df = spark.createDataFrame(rows, "language string, v double")
    probabilities = {f"p{i}": i / 37 for i in range(38)}
    built_in = Q.exact_quantiles(df, ["language"], "v", probabilities).collect()
    described = Q.describe(df, ["language"], "v").select("language", "count", "p25", "p50", "p75").collect()
    monkeypatch.setattr(Q, "BUILT_IN_VALUES", 0)
    bucketed = Q.exact_quantiles(df, ["language"], "v", probabilities).collect()
    assert len(built_in) == len(described) == 3 and set(built_in) == set(bucketed)
    again = Q.describe(df, ["language"], "v").select("language", "count", "p25", "p50", "p75").collect()
    assert set(again) == set(described)


@pytest.mark.parametrize("per_bucket", [1, 2, 1000])
def test_null_keys_and_null_order(spark, per_bucket):
    df = spark.createDataFrame([(5, "a"), (None, "a"), (2, None), (3, None), (9, "a")], "id int, language string")
    indexed = R.index_by_column(df, ["language"], "id", rows_per_bucket=per_bucket).collect()
    assert {(r.id, r.language): r.row_index for r in indexed} == {
        (None, "a"): 0, (5, "a"): 1, (9, "a"): 2, (2, None): 0, (3, None): 1}
    first = R.first_by_column(df, ["language"], "id", 1, rows_per_bucket=per_bucket).collect()
    assert {(r.id, r.language) for r in first} == {(None, "a"), (2, None)}
    assert OF.iqr_filter(df.fillna(4, ["id"]), ["language"], "id").count() == 5


def test_seeded_order(spark):
    df = spark.range(2000).select(F.col("id"), F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("language"))
    order = R.index_by_hash(df, ["language"], "id").collect()
    for key in "ab":
        at = sorted(r.row_index for r in order if r.language == key)
        assert at == list(range(len(at)))
    taken = {r.id for r in R.first_by_hash(df, ["language"], "id", 100).collect()}
    assert taken == {r.id for r in order if r.row_index < 100}
    assert taken != {r.id for r in R.first_by_hash(df, ["language"], "id", 100, seed=1).collect()}
    assert R.first_by_hash(df, ["language"], "id", 10_000).count() == 2000


def test_lookup_join(spark):
    rows = spark.range(100).select(F.col("id"), (F.col("id") % 10).alias("k"))
    lookup = spark.range(10).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    assert resolve_small(lookup, 9) is None
    for limit in (5, 10):
        assert lookup_join(rows, lookup, ["k"], limit=limit).agg(F.sum("v")).first()[0] == 900


def test_dedup_with_a_hot_copy(spark):
    rows = spark.range(5000).select(F.col("id"), F.when(F.col("id") % 3 == 0, "same").otherwise(
        F.concat(F.lit("t"), (F.col("id") % 40).cast("string"))).alias("code"))
    kept = OF.exact_dedup(rows).collect()
    assert len(kept) == 41 and min(r.id for r in kept if r.code == "same") == 0
