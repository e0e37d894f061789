"""Sources, sinks and incremental runs."""

from pyspark.sql import functions as F

from grovekit.catalog.registry import MEASURED, SAMPLES, digest, query, r6, samples, spread_language, table
from grovekit.catalog.profile import FILES, files
from grovekit.operators import profiling as OP
from grovekit.plans import conversion as C, preparation as P
from grovekit.session import stage_path, staged
from grovekit.sources import keyed as SK, readers as SR, writers as SW
from grovekit.streaming import incremental as SI


@query("scan_language", "select doc_id, n_chars from documents where lang = 'fr'")
def _(spark, d):
    return SR.scan_language(spark, f"{d}/documents.parquet", "fr", ("en", "fr", "de", "es"), "lang").select("doc_id", "n_chars")


@query("scan_keyed_json", f"""with {MEASURED} select language, language || '_' || cast(doc_id as varchar) as key, sha256(code) as digest,
    round(avg_line_length, 6) as avg_line_length, line_count from measured""")
def _(spark, d):
    keyed = P.with_raw_metrics(samples(spark, d)).withColumn("key", F.concat_ws("_", "language", F.col("doc_id").cast("string")))
    entries = SR.explode_keyed_json(keyed.select(SW.keyed_json(keyed).alias("value")))
    return entries.select("language", "key", digest("code").alias("digest"), r6("avg_line_length").alias("avg_line_length"), "line_count")


@query("scan_keyed_object", f"""with {MEASURED} select language, language || '_' || cast(row_number() over (
    partition by language order by doc_id) - 1 as varchar) as key, sha256(code) as digest,
    round(avg_line_length, 6) as avg_line_length, line_count from measured""")
def _(spark, d):
    path = stage_path(spark, "keyed-object")
    SW.write_keyed_object(P.with_raw_metrics(samples(spark, d)), path, "doc_id")
    return SK.scan_keyed_object(spark, path).select(
        "language", "key", digest("code").alias("digest"), r6("avg_line_length").alias("avg_line_length"), "line_count")


@query("scan_columns", "select text from documents")
def _(spark, d):
    return SR.scan_columns(spark, f"{d}/documents.parquet", "text")


_PART = "'part=' || lang"


@query("scan_glob", f"""select {_PART} as part, count(*) as rows, cast(sum(length(text)) as bigint) as chars from documents
where lang in ('en', 'es') group by all""")
def _(spark, d):
    """Files of several folders, by a pattern for their names."""
    path = stage_path(spark, "glob")
    docs = table(spark, d, "documents").withColumn("part", F.col("lang"))
    docs.write.partitionBy("part").parquet(path)
    found = SR.scan_glob(spark, f"{path}/part=e*", "part-*.parquet", docs.drop("part").schema)
    folder = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    return found.groupBy(folder.alias("part")).agg(F.count(F.lit(1)).alias("rows"), F.sum(F.length("text")).alias("chars"))


@query("file_footprint", """select 'documents.parquet' as file, count(*) as rows,
    cast(sum(strlen(text) + strlen(lang) + strlen(source) + 16) as bigint) as memory_bytes from documents""")
def _(spark, d):
    return SR.file_footprint(spark, d, "documents.parquet").drop("disk_bytes")


@query("write_language", f"with {SAMPLES} select language, count(*) as rows, cast(sum(length(code)) as bigint) as chars from samples group by language")
def _(spark, d):
    path = stage_path(spark, "write-language")
    SW.write_language(samples(spark, d), path)
    return spark.read.parquet(path).groupBy("language").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.length("code")).alias("chars"))


@query("write_keyed_json", f"""with {MEASURED} select language, language || '_' || cast(row_number() over (
    partition by language order by doc_id) - 1 as varchar) as key, sha256(code) as digest, line_count from measured""")
def _(spark, d):
    path = stage_path(spark, "keyed-json")
    SW.write_keyed_json(P.with_raw_metrics(samples(spark, d)), path, "doc_id")
    return SR.scan_keyed_json(spark, path).select("language", "key", digest("code").alias("digest"), "line_count")


@query("write_summary", f"""with {FILES}, found as (
    select 'file' as level, file as name, cast(rows as bigint) as rows, disk_bytes, memory_bytes, mean_line_count, mean_errors from files
    union all select 'language', language, sum(rows), sum(disk_bytes), sum(memory_bytes), sum(mean_line_count * rows) / sum(rows),
        sum(mean_errors * rows) / sum(rows) from files group by language
    union all select 'overall', '', sum(rows), sum(disk_bytes), sum(memory_bytes), sum(mean_line_count * rows) / sum(rows),
        sum(mean_errors * rows) / sum(rows) from files)
select level, name, cast(rows as bigint) as rows, cast(disk_bytes as bigint) as disk_bytes, cast(memory_bytes as bigint) as memory_bytes,
    round(mean_line_count, 6) as mean_line_count, round(mean_errors, 6) as mean_errors from found""")
def _(spark, d):
    path = stage_path(spark, "summary")
    stats = staged(files(spark, d), "file-stats")
    tables = {"file": stats, "language": OP.language_stats(stats), "overall": OP.overall_stats(stats)}
    SW.write_summary(*tables.values(), path)
    names = {"file": ("file_level", F.col("file"), "rows"), "language": ("language_level", F.col("language"), "total_rows"),
             "overall": ("overall", F.lit(""), "total_rows")}
    read = [spark.read.schema(tables[k].schema).option("header", True).csv(f"{path}/{folder}").select(
        F.lit(k).alias("level"), name.alias("name"), F.col(rows).cast("long").alias("rows"), "disk_bytes", "memory_bytes",
        r6("mean_line_count").alias("mean_line_count"), r6("mean_errors").alias("mean_errors")) for k, (folder, name, rows) in names.items()]
    return read[0].unionByName(read[1]).unionByName(read[2])


# Conversion with a number that is not one in every 23rd sample.
def spoilt_samples(df):
    return df.select("doc_id", F.col("lang").alias("language"), F.col("text").alias("code"), F.col("source").alias("file")).withColumn(
        "language", F.when(F.col("doc_id") % 19 == 0, "pascal").otherwise(spread_language()))


def converted_samples(df):
    measured = P.with_raw_metrics(spoilt_samples(df))
    found = C.convert_samples(measured, "doc_id")
    return found.withColumn("avg_line_length", F.when(F.col("doc_id") % 23 == 0, float("nan")).otherwise(F.col("avg_line_length")))


def read_back(rows, counts):
    """Counts per input file, with what was read back."""
    source = F.get_json_object("universal_schema", "$.metadata.source_hash")
    lines = F.sort_array(F.collect_list(F.struct("doc_id", source.alias("h"))))
    found = rows.groupBy(F.col("file").alias("input_file")).agg(
        F.count(F.lit(1)).alias("rows_read"), F.array_join(lines["h"], ",").alias("_all")).select("input_file", "rows_read", digest("_all").alias("digest"))
    return counts.join(found, "input_file", "left").fillna({"rows_read": 0, "digest": ""})


CONVERTED_SQL = """select source as input_file, count(*) as total_rows, count(*) filter (where fine) as successful_conversions,
    count(*) filter (where fine) as rows_read, coalesce(case when count(*) filter (where fine) > 0
        then sha256(string_agg(sha256(text), ',' order by doc_id) filter (where fine)) end, '') as digest
    from (select *, doc_id % 19 <> 0 and doc_id % 23 <> 0 and text <> '' as fine from documents) group by source"""


@query("write_converted", CONVERTED_SQL)
def _(spark, d):
    path = stage_path(spark, "converted")
    rows = converted_samples(table(spark, d, "documents"))
    counts = SW.write_converted(rows, path)
    return read_back(SW.read_converted(spark, path, rows.schema), counts)


@query("incremental_convert", CONVERTED_SQL)
def _(spark, d):
    """Two runs, with files added between."""
    base = stage_path(spark, "incremental")
    docs = table(spark, d, "documents")
    for i in range(2):
        docs.where(F.col("doc_id") % 2 == i).write.mode("append").parquet(f"{base}/in")
        rows, counts = SI.incremental_conversion(
            spark, f"{base}/in", docs.schema, lambda batch: converted_samples(batch.drop("file")), f"{base}/out", f"{base}/state")
    return read_back(rows, counts)


@query("incremental_dedup", """select doc_id from (select doc_id, row_number() over (partition by sha256(text) order by doc_id % 3, doc_id) as r
    from documents) where r = 1""")
def _(spark, d):
    """Three batches, the rows of each by remainder; earlier batches win."""
    base = stage_path(spark, "dedup")
    docs = table(spark, d, "documents")
    for i in range(3):
        docs.where(F.col("doc_id") % 3 == i).write.mode("append").parquet(f"{base}/in")
        kept = SI.incremental_dedup(spark, f"{base}/in", docs.schema, "doc_id", "text", f"{base}/out", f"{base}/state")
    return kept.select("doc_id")
