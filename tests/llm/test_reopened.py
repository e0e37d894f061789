"""Second round of the near-duplicate search."""

from grovekit.llm.minhash import _reopened

_REFUSED = "node long, refused array<long>"


def test_reopened_buckets(spark):
    # Buckets: 1 in two blocks with two components, 2 in two blocks and linked, 3 in one block, 4 in one with a refused pair.
    rows = [(1, 1, 2, 0), (1, 2, 2, 1), (1, 3, 2, 1), (2, 1, 2, 0), (2, 2, 2, 1), (3, 1, 1, 0), (3, 3, 1, 0), (4, 5, 1, 0), (4, 6, 1, 0)]
    members = spark.createDataFrame(rows, "key long, node long, parts int, part int")
    labels = spark.createDataFrame([(1, 1), (2, 1)], "node long, component long")
    found = _reopened(members, labels, spark.createDataFrame([(5, [6])], _REFUSED))
    assert sorted((r.key, r.node, r.block, r.asks, r.component) for r in found.collect()) == [
        (1, 1, 0, False, 1), (1, 2, 1, False, 1), (1, 3, 0, True, 3), (1, 3, 1, True, 3), (4, 5, 0, False, 5), (4, 6, 0, True, 6)]


def test_labels_are_joined_by_document(spark, tmp_path):
    """No outer join makes a row for every bucket of a document."""
    members = spark.range(26 * 50).selectExpr("id % 26 as key", "id div 26 as node", "2 as parts", "0 as part")
    members.write.parquet(f"{tmp_path}/members")
    spark.range(50).selectExpr("id as node", "0L as component").write.parquet(f"{tmp_path}/labels")
    found = _reopened(
        spark.read.parquet(f"{tmp_path}/members"), spark.read.parquet(f"{tmp_path}/labels"),
        spark.createDataFrame([(5, [6])], _REFUSED))
    plan = found._jdf.queryExecution().optimizedPlan().toString().split("\n")
    below = [after for line, after in zip(plan, plan[1:]) if "Join LeftOuter" in line]
    assert below and all("Aggregate [node" in line or "Join LeftOuter" in line or "Project [node" in line for line in below)
