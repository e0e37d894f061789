"""Round trips through files, and incremental runs against the batch result."""

import pytest
from pyspark.sql import functions as F

from grovekit.fixed import LANGUAGES
from grovekit.operators import filters as OF
from grovekit.plans import conversion as C, preparation as P
from grovekit.sources import readers as SR, writers as SW
from grovekit.streaming import incremental as SI


@pytest.fixture(scope="module")
def corpus(spark):
    i = F.col("id")
    return spark.range(400).select(
        "id", F.element_at(F.array(*[F.lit(x) for x in LANGUAGES]), (F.when(i % 3 == 0, 0).otherwise(i % 10) + 1).cast("int")).alias("language"),
        F.concat(F.lit("def f"), (i % 50).cast("string"), F.lit("():\n  return "), F.repeat(F.lit("x "), (i % 7).cast("int"))).alias("code"),
    ).cache()


def test_languages(spark, corpus, tmp_path):
    path = str(tmp_path / "stage")
    SW.write_language(corpus, path, records_per_file=10)
    assert SR.scan_language(spark, path, "cpp").count() == corpus.where("language = 'cpp'").count()
    # Only the languages of the new rows are replaced.
    SW.write_language(corpus.where("language = 'go'").limit(1), path)
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    assert SR.scan_language(spark, path, "go").count() == 1
    assert SR.scan_language(spark, path, "cpp").count() == corpus.where("language = 'cpp'").count()
    with pytest.raises(ValueError):
        SR.scan_language(spark, path, "cobol")
    with pytest.raises(ValueError):
        SW.write_language(corpus.limit(0), path)


def test_quarters(spark, corpus, tmp_path):
    SW.write_quarters(corpus, str(tmp_path / "parts"), "id")
    back = spark.read.parquet(str(tmp_path / "parts"))
    assert back.count() == 400
    for row in back.groupBy("language").pivot("part", [1, 2, 3, 4]).count().collect():
        n = sum(row[1:])
        assert list(row[1:]) == [n // 4, n // 2 - n // 4, 3 * n // 4 - n // 2, n - 3 * n // 4]


def test_keyed_json(spark, corpus, tmp_path):
    measured = P.with_raw_metrics(corpus)
    SW.write_keyed_json(measured, str(tmp_path / "keyed"), "id")
    back = SR.scan_keyed_json(spark, str(tmp_path / "keyed"))
    assert back.count() == 400
    # The language of a key ends at its first underscore.
    assert {r[0] for r in back.select("language").distinct().collect()} == {x.split("_")[0] for x in LANGUAGES}
    assert back.agg(F.sum("line_count")).first()[0] == 800


def test_files(spark, corpus, tmp_path):
    for name in ("c_parsed_1", "c_parsed_2", "cpp_parsed_1"):
        corpus.where(F.col("language") == name.split("_")[0]).coalesce(1).write.parquet(str(tmp_path / "raw" / name))
    folder = tmp_path / "flat"
    folder.mkdir()
    for name in ("c_parsed_1", "c_parsed_2", "cpp_parsed_1"):
        part = next((tmp_path / "raw" / name).glob("*.parquet"))
        (folder / f"{name}.parquet").write_bytes(part.read_bytes())
    found = SR.scan_language_files(spark, str(folder), "c")
    assert {r[0] for r in found.select("file").distinct().collect()} == {"c_parsed_1.parquet", "c_parsed_2.parquet"}
    with pytest.raises(FileNotFoundError):
        SR.scan_language_files(spark, str(folder), "ruby")
    sizes = {r.file: r.disk_bytes for r in SR.file_footprint(spark, str(folder)).collect()}
    assert sizes == {p.name: p.stat().st_size for p in folder.glob("*.parquet")}


def test_footprint_of_a_folder(spark, tmp_path):
    table = tmp_path / "in here" / "docs.parquet"
    spark.range(100).selectExpr("id", "string(id) as text").repartition(4).write.parquet(str(table))
    (found,) = SR.file_footprint(spark, str(table.parent), "docs.parquet").collect()
    assert (found.file, found.rows, found.memory_bytes) == ("docs.parquet", 100, 100 * 8 + 190)
    assert found.disk_bytes == sum(p.stat().st_size for p in table.glob("*.parquet"))
    with pytest.raises(FileNotFoundError):
        SR.file_footprint(spark, str(table.parent), "none.parquet")


def test_prepare(spark, corpus):
    ready = P.prepare(corpus, "id", per_language=30)
    assert ready.columns == ["id", "language", "code", "avg_line_length", "line_count"] or set(ready.columns) >= {"id", "code", "line_count"}
    assert 0 < ready.count() <= 300
    assert ready.groupBy("language").count().agg(F.max("count")).first()[0] <= 30


def test_convert(spark, corpus, tmp_path):
    spoiled = P.with_raw_metrics(corpus).withColumns({
        "language": F.when(F.col("id") % 40 == 0, "cobol").otherwise(F.col("language")),
        "file": F.concat(F.lit("f"), (F.col("id") % 4).cast("string")),
    })
    converted = C.convert_samples(spoiled, "id").cache()
    summary = {r.file: (r.total_rows, r.successful_conversions) for r in C.convert_folder_summary(converted).collect()}
    assert summary["TOTAL"] == (400, 390) and summary["f0"] == (100, 90)
    counts = {r.input_file: r.successful_conversions for r in SW.write_converted(converted, str(tmp_path / "out")).collect()}
    assert counts == {k: v[1] for k, v in summary.items() if k != "TOTAL"}
    assert SW.read_converted(spark, str(tmp_path / "out"), converted.schema).count() == 390
    assert spark.read.parquet(str(tmp_path / "out" / "whole=false")).count() == 10
    odd = converted.withColumn("avg_line_length", F.when(F.col("id") % 8 == 1, float("nan")).otherwise(F.col("avg_line_length")))
    counts = {r.input_file: r.successful_conversions for r in SW.write_converted(odd, str(tmp_path / "odd")).collect()}
    assert counts["f1"] == 50 and counts == {
        r.file: r.successful_conversions for r in C.convert_folder_summary(odd).collect() if r.file != "TOTAL"}
    json = converted.where("id = 1").first().universal_schema
    assert '"parent":null' in json and '"success":true' in json


def test_converted_rows_are_neither_shuffled_nor_sorted(spark, tmp_path):
    rows = [(i, f"f{i % 3}" if i % 7 else None, None if i % 5 == 0 else "x" * i) for i in range(60)]
    df = spark.createDataFrame(rows, "id int, file string, universal_schema string").repartition(6)
    key, path = "spark.sql.maxConcurrentOutputFileWriters", str(tmp_path / "out")
    before = spark.conf.get(key)
    counts = {r.input_file: (r.total_rows, r.successful_conversions) for r in SW.write_converted(df, path).collect()}
    assert spark.conf.get(key) == before
    whole = [r for r in rows if r[1] is not None and r[2] is not None]
    assert counts == {f: (sum(r[1] == f for r in rows), sum(r[1] == f for r in whole)) for f in {r[1] for r in rows}}
    assert sorted(tuple(r) for r in SW.read_converted(spark, path, df.schema).select(df.columns).collect()) == whole
    # As many files in a folder as tasks have rows for it; rows shuffled by file would be in one.
    files = [p.name for p in (tmp_path / "out" / "whole=true" / "file=f1").glob("part-*")]
    assert len(files) > 1 and all(name.endswith(".zstd.parquet") for name in files)


def test_incremental(spark, corpus, tmp_path):
    source, out, state = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state")

    def measure(df):
        return P.with_clean_metrics(OF.valid_rows(df.drop("file")))

    batch = {tuple(r) for r in measure(corpus).collect()}
    corpus.where("id < 150").write.parquet(source)
    first = SI.incremental_convert(spark, source, corpus.schema, measure, out, state)
    assert first.count() == 150
    corpus.where("id >= 150").write.mode("append").parquet(source)
    both = SI.incremental_convert(spark, source, corpus.schema, measure, out, state)
    assert {tuple(r) for r in both.collect()} == batch


def test_incremental_dedup(spark, corpus, tmp_path):
    source, out, state = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state")
    corpus.where("id < 150").write.parquet(source)
    SI.incremental_dedup(spark, source, corpus.schema, "id", "code", out, state)
    corpus.where("id >= 150").write.mode("append").parquet(source)
    kept = SI.incremental_dedup(spark, source, corpus.schema, "id", "code", out, state)
    assert {r.id for r in kept.collect()} == {r.id for r in OF.exact_dedup(corpus).collect()}


def test_incremental_without_files_and_with_a_new_checkpoint(spark, corpus, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    (tmp_path / "in").mkdir()
    args = spark, source, corpus.schema, "id", "code", out
    assert SI.incremental_dedup(*args, str(tmp_path / "first")).count() == 0
    corpus.where("id < 100").write.mode("append").parquet(source)
    once = {r.id for r in SI.incremental_dedup(*args, str(tmp_path / "first")).collect()}
    assert once == {r.id for r in OF.exact_dedup(corpus.where("id < 100")).collect()}
    # All files again under another checkpoint: everything is known, and the earlier output stays.
    assert {r.id for r in SI.incremental_dedup(*args, str(tmp_path / "second")).collect()} == once
    convert = spark, source, corpus.schema, lambda df: df.select("id"), str(tmp_path / "ids")
    assert SI.incremental_convert(*convert, str(tmp_path / "a")).count() == 100
    assert SI.incremental_convert(*convert, str(tmp_path / "a")).count() == 100
    assert SI.incremental_convert(*convert, str(tmp_path / "b")).count() == 200


def test_hash_state(spark, tmp_path):
    state = SI.HashState(spark, str(tmp_path / "state"), digits=1, loose=3)

    def table(*values):
        return spark.createDataFrame([(v,) for v in values], "content_hash string")

    everything = table(*[f"{c}zzz" for c in "0123456789abcdef"])
    seen = set()
    for n in range(8):
        known = state.known(everything, (0, n))
        assert {r.content_hash for r in known.collect()} == seen
        state.add(table(f"a{n}", f"{n}b"), 0, n)
        seen |= {f"a{n}", f"{n}b"}
    # A batch that is run again does not see itself; a base that was not finished is not read.
    assert {r.content_hash for r in state.known(everything, (0, 7)).collect()} == seen - {"a7", "7b"}
    bases = SI._numbers(spark, str(tmp_path / "state"), "base")
    assert bases == [3, 6]
    (tmp_path / "state" / "base=6" / "_complete").unlink()
    few = state.known(table("a", "a1"), (0, 9))
    assert {r.content_hash for r in few.collect()} == {f"a{n}" for n in range(8)}
    filters = [x.split("]")[0] for x in few._jdf.queryExecution().toString().split("PartitionFilters: [")[1:]]
    assert len(filters) == 6 and all("prefix" in x and "a" in x for x in filters)  # five loose batches and a base
