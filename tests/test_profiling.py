"""Published aggregates and special cases of the statistics."""

import pytest
from pyspark.sql import functions as F

from grovekit.operators import profiling as OP
from grovekit.sources.writers import quarter

# Published language rows: rows, disk and memory in GB, lines, nodes, line length, errors, zero-error share.
LANGUAGE_ROWS = [
    ("c", 700818, 11.217625314, 55.822155748, 61.75941114526168, 404.9507375666721, 28.08196764352514, 9.021864449828628, 42.104797536592955),
    ("c-sharp", 705203, 9.12496075, 50.856152031, 44.258180977675934, 330.9952878816454, 29.525119930005967, 0.6422618735314513, 97.02029061135588),
    ("cpp", 707640, 19.822199002, 102.668325327, 87.87500423944378, 745.1700553953988, 28.164076846984344, 0.7251667514555423, 88.72760160533605),
    ("go", 700331, 15.581983336, 81.438632785, 68.21702166546962, 610.0533661939854, 25.180739678809022, 0.02527519130239844, 99.29019278027104),
    ("java", 711922, 11.368966842, 60.410145071, 54.3968173479679, 424.7358249920637, 30.846528692750045, 0.06722225187590776, 99.34234368371816),
    ("javascript", 687775, 9.30923045, 53.098869889, 44.15429464577805, 376.5608302133692, 27.68791668787031, 0.20391843262694923, 96.95380029806259),
    ("python", 706126, 12.717926637, 64.951949299, 54.70159433302272, 514.4231057913177, 32.67346840365601, 0.06193228970467027, 98.63338837544575),
    ("ruby", 703473, 5.401542496, 28.942134597, 27.410405232325903, 194.79638877398278, 27.350513026086283, 0.03164300548848357, 99.04573452001712),
    ("scala", 702833, 11.125106823, 57.475118096, 44.381725103972066, 398.8084737057025, 35.30197455156488, 0.3135951214584403, 94.75465722298185),
    ("typescript", 695597, 8.225090146, 44.17590772, 36.89176922844693, 321.30140009229484, 29.18430953555003, 2.5080930481298798, 81.13476625114829),
]
# Four published file rows of one language: rows, lines, nodes, line length, density (inf where null), errors, zero-error share.
FILE_ROWS = [
    (177981, 54.40634674487726, 424.76839100802897, 30.844708873419073, 7.946859443208993, 0.05583180227102893, 99.33813159831666),
    (177980, 54.489987639060566, 425.22452522755367, 30.84679705584897, None, 0.06383301494549949, 99.33756601865377),
    (177980, 54.219968535790535, 423.68232947522193, 30.843142712664335, 7.957967596515439, 0.08545342173277896, 99.34824137543544),
    (177981, 54.47096600198898, 425.26805108410446, 30.851466111551233, None, 0.06377085194487052, 99.3454357487597),
]


def file_rows(spark, rows):
    return spark.createDataFrame(rows, (
        "language string, rows bigint, disk_bytes double, memory_bytes double, mean_line_count double, "
        "mean_ast_nodes double, mean_line_length double, mean_errors double, zero_error_ratio double")
    ).withColumn("mean_node_density", F.lit(0.0))


def test_overall_stats(spark):
    row = OP.overall_stats(file_rows(spark, LANGUAGE_ROWS)).first()
    assert row.total_languages == 10 and row.total_rows == 7021718
    assert row.disk_bytes == pytest.approx(113.894631796) and row.memory_bytes == pytest.approx(599.839390563)
    for name, value in (("mean_line_count", 52.4529), ("mean_ast_nodes", 432.5449), ("mean_line_length", 29.4079),
                        ("mean_errors", 1.3566), ("zero_error_ratio", 89.7236)):
        assert row[name] == pytest.approx(value, abs=5e-5)


def test_language_stats(spark):
    rows = [("java", r[0], 1.0, 5.31, r[1], r[2], r[3], r[5], r[6], r[4] or r[2] / r[1]) for r in FILE_ROWS]
    df = spark.createDataFrame(rows, (
        "language string, rows bigint, disk_bytes double, memory_bytes double, mean_line_count double, mean_ast_nodes double, "
        "mean_line_length double, mean_errors double, zero_error_ratio double, mean_node_density double"))
    row = OP.language_stats(df).first()
    assert row.total_rows == 711922 and row.compression_ratio == 5.31
    for name, value in (("mean_line_count", 54.3968173479679), ("mean_ast_nodes", 424.7358249920637), ("mean_node_density", 7.878947054727496),
                        ("mean_line_length", 30.846528692750045), ("mean_errors", 0.06722225187590776), ("zero_error_ratio", 99.34234368371816)):
        assert row[name] == pytest.approx(value, rel=1e-12)


def test_conversion_rates(spark):
    df = spark.range(7021722).select(F.lit("all").alias("file"), "id")
    row = OP.conversion_rates(df, ["file"], F.col("id") >= 4).first()
    assert (row.successful, row.failed, row.success_rate, row.failure_rate) == (7021718, 4, 99.99994, 6e-05)
    assert OP.conversion_rates(df.limit(0), [], F.lit(True)).first().success_rate == 0.0


def test_quarters(spark):
    df = spark.range(700821).select(F.col("id").alias("row_index"), F.lit(700821).alias("key_rows"))
    counts = {r.part: r["count"] for r in df.groupBy(quarter().alias("part")).count().collect()}
    assert counts == {1: 175205, 2: 175205, 3: 175205, 4: 175206}


def test_line_buckets(spark):
    counts = [0, 1, 100, 101, 200, 201, 999, 1000, 1001, 5000]
    df = spark.createDataFrame([("a", c) for c in counts], "language string, line_count int")
    found = {r.bucket: r.samples for r in OP.line_buckets(df, ["language"]).collect()}
    assert found == {"0-100": 3, "101-200": 2, "201-300": 1, "901-1000": 2, "1000+": 2,
                     **{f"{i}01-{i + 1}00": 0 for i in range(3, 9)}}


def test_node_density(spark):
    df = spark.createDataFrame([("a", 4, 2), ("a", 9, 3), ("b", 4, 0), ("b", 6, 5), ("c", 0, 0), ("c", 6, 3)],
                               "k string, ast_node_count int, line_count int")
    found = {r.k: r.d for r in df.groupBy("k").agg(OP.node_density().alias("d")).collect()}
    assert found == {"a": 2.5, "b": 2.0, "c": 2.0}
