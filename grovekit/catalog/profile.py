"""Profiles, ranks, samples and duplicates."""

from pyspark.sql import functions as F

from grovekit.catalog.registry import (
    MEASURED, NODE_COUNT, SAMPLES, digest, query, r6, samples, table,
)
from grovekit.operators import filters as OF, profiling as OP, ranking as R
from grovekit.operators.trees import text_node_count
from grovekit.plans import preparation as P
from grovekit.session import stage_path
from grovekit.sources.writers import with_quarter, with_sequential_key, write_quarters


def _measured(spark, d):
    return P.with_raw_metrics(samples(spark, d))


def rounded(df, *columns):
    return df.withColumns({c: r6(c) for c in columns})


_SUMMARY = ("mean", "std", "min", "p25", "p50", "p75", "max")


def _summary_sql(column, source, by):
    return f"""select {by}, '{column}' as column, count({column}) as count, round(avg({column}), 6) as mean,
    round(stddev_samp({column}), 6) as std, round(cast(min({column}) as double), 6) as min,
    round(quantile_cont({column}, 0.25), 6) as p25, round(quantile_cont({column}, 0.5), 6) as p50,
    round(quantile_cont({column}, 0.75), 6) as p75, round(cast(max({column}) as double), 6) as max
from {source} group by {by}"""


@query("describe", f"with {MEASURED} {_summary_sql('avg_line_length', 'measured', 'language')} union all "
       f"{_summary_sql('line_count', 'measured', 'language')}")
def _(spark, d):
    return rounded(OP.describe_columns(_measured(spark, d), ["language"], ["avg_line_length", "line_count"]), *_SUMMARY)


@query("describe_numbers", _summary_sql("l_extendedprice", "lineitem", "l_returnflag"))
def _(spark, d):
    return rounded(OP.describe_columns(table(spark, d, "lineitem"), ["l_returnflag"], ["l_extendedprice"]), *_SUMMARY)


BUCKET_LABELS = """['0-100', '101-200', '201-300', '301-400', '401-500', '501-600',
    '601-700', '701-800', '801-900', '901-1000', '1000+']"""
BUCKET_SQL = "least(10, greatest(0, cast(ceil({0} / 100) as int) - 1))"


@query("line_buckets", f"""with {MEASURED}, widened as (select language, line_count * 23 as line_count from measured),
labels as (select unnest(range(11)) as i, unnest({BUCKET_LABELS}) as bucket),
held as (select language, {BUCKET_SQL.format('line_count')} as i, count(*) as n from widened group by all),
keys as (select distinct language from widened)
select k.language, l.bucket, coalesce(h.n, 0) as samples
from keys k cross join labels l left join held h on h.language = k.language and h.i = l.i""")
def _(spark, d):
    widened = _measured(spark, d).withColumn("line_count", F.col("line_count") * 23)
    return OP.line_buckets(widened, ["language"])


@query("boxplot_stats", """with q as (select l_returnflag, count(*) as count, min(l_extendedprice) as min, max(l_extendedprice) as max,
    quantile_cont(l_extendedprice, 0.25) as p25, quantile_cont(l_extendedprice, 0.5) as p50,
    quantile_cont(l_extendedprice, 0.75) as p75 from lineitem group by 1),
f as (select *, p25 - 1.5 * (p75 - p25) as low, p75 + 1.5 * (p75 - p25) as high from q)
select l_returnflag, any_value(f.count) as count, round(cast(any_value(min) as double), 6) as min, round(any_value(p25), 6) as p25,
    round(any_value(p50), 6) as p50, round(any_value(p75), 6) as p75, round(cast(any_value(max) as double), 6) as max,
    round(any_value(low), 6) as low, round(any_value(high), 6) as high,
    count(*) filter (where l_extendedprice < low or l_extendedprice > high) as outliers
from lineitem join f using (l_returnflag) group by l_returnflag""")
def _(spark, d):
    return rounded(OP.boxplot_stats(table(spark, d, "lineitem"), ["l_returnflag"], "l_extendedprice"),
                   "min", "p25", "p50", "p75", "max", "low", "high")


# One row per sample as the statistics want it; every 97th sample has no lines.
def parsed(spark, d):
    labels = table(spark, d, "labels").select("doc_id", "toxic")
    measured = _measured(spark, d).withColumns({
        "ast_node_count": text_node_count("code"),
        "disk_bytes": F.octet_length("code").cast("bigint"),
        "memory_bytes": OP.logical_bytes(
            ["language", "code"], ["line_count", "avg_line_length", "ast_node_count", "num_errors"]),
        "line_count": F.when(F.col("doc_id") % 97 == 0, 0).otherwise(F.col("line_count")),
        "file": F.concat("language", F.lit("_parsed_"), "file"),
    }).drop("code")
    return measured.join(labels, "doc_id", "left").withColumn(
        "num_errors", F.coalesce("toxic", F.lit(0))).drop("toxic")


PARSED = MEASURED + f""", parsed as (select doc_id, language, language || '_parsed_' || file as file,
    case when doc_id % 97 = 0 then 0 else line_count end as line_count, avg_line_length, {NODE_COUNT} as ast_node_count,
    coalesce(toxic, 0) as num_errors, strlen(code) as disk_bytes, strlen(code) + strlen(language) + 32 as memory_bytes
    from measured left join labels using (doc_id))"""
_DENSITY = """case when count(*) filter (where line_count = 0 and ast_node_count > 0) > 0
    then avg(ast_node_count) / avg(line_count) else avg(ast_node_count / nullif(line_count, 0)) end"""
_STATS = f"""count(*) as rows, cast(sum(disk_bytes) as bigint) as disk_bytes, cast(sum(memory_bytes) as bigint) as memory_bytes,
    avg(line_count) as mean_line_count, stddev_samp(line_count) as std_line_count, avg(ast_node_count) as mean_ast_nodes,
    stddev_samp(ast_node_count) as std_ast_nodes, avg(avg_line_length) as mean_line_length,
    {_DENSITY} as mean_node_density, avg(num_errors) as mean_errors,
    avg(case when num_errors = 0 then 1 else 0 end) * 100 as zero_error_ratio"""
FILES = PARSED + f", files as (select file, min(language) as language, {_STATS} from parsed group by file)"
_MEANS = ("mean_line_count", "std_line_count", "mean_ast_nodes", "std_ast_nodes", "mean_line_length",
          "mean_node_density", "mean_errors", "zero_error_ratio")
_ROUNDED = ", ".join(f"round({m}, 6) as {m}" for m in _MEANS)
_RATIO = "round(sum(memory_bytes) / sum(disk_bytes), 2)"


def files(spark, d):
    return OP.file_stats(parsed(spark, d))


def finished(df, *means):
    """Deviations of single rows are null in both engines; show them as -1."""
    return df.withColumns({m: F.coalesce(r6(m), F.lit(-1.0)) for m in means})


_FINISHED = ", ".join(f"coalesce(round({m}, 6), -1) as {m}" for m in _MEANS)


@query("file_stats", f"""with {FILES} select file, language, rows, disk_bytes, memory_bytes,
    round(memory_bytes / disk_bytes, 2) as compression_ratio, {_FINISHED} from files""")
def _(spark, d):
    return finished(files(spark, d), *_MEANS)


@query("node_density", f"with {PARSED} select file, coalesce(round({_DENSITY}, 6), -1) as mean_node_density from parsed group by file")
def _(spark, d):
    return parsed(spark, d).groupBy("file").agg(
        F.coalesce(F.round(OP.node_density(), 6), F.lit(-1.0)).alias("mean_node_density"))


@query("zero_error_ratio", f"""with {PARSED} select language,
    round(avg(case when num_errors = 0 then 1 else 0 end) * 100, 6) as zero_error_ratio from parsed group by language""")
def _(spark, d):
    return parsed(spark, d).groupBy("language").agg(
        F.round(F.avg((F.col("num_errors") == 0).cast("int")) * 100, 6).alias("zero_error_ratio"))


@query("compression_ratio", f"with {PARSED} select language, {_RATIO} as compression_ratio from parsed group by language")
def _(spark, d):
    return OP.storage_by_language(files(spark, d)).select(
        "language", OP.compression_ratio().alias("compression_ratio"))


def _weighted_sql(names, weight):
    return ", ".join(f"round(sum({n} * {weight}) / sum({weight}), 6) as {n}" for n in names)


@query("language_stats", f"""with {FILES} select language, cast(sum(rows) as bigint) as total_rows,
    cast(sum(disk_bytes) as bigint) as disk_bytes, cast(sum(memory_bytes) as bigint) as memory_bytes,
    {_RATIO} as compression_ratio, {_weighted_sql(OP.WEIGHTED_MEANS, 'rows')} from files group by language""")
def _(spark, d):
    return rounded(OP.language_stats(files(spark, d)), *OP.WEIGHTED_MEANS)


_OVERALL = [m for m in OP.WEIGHTED_MEANS if m != "mean_node_density"]


@query("overall_stats", f"""with {FILES} select count(distinct language) as total_languages, count(*) as total_files,
    cast(sum(rows) as bigint) as total_rows, cast(sum(disk_bytes) as bigint) as disk_bytes,
    cast(sum(memory_bytes) as bigint) as memory_bytes, {_RATIO} as compression_ratio,
    {_weighted_sql(_OVERALL, 'rows')} from files""")
def _(spark, d):
    return rounded(OP.overall_stats(files(spark, d)), *_OVERALL)


@query("grouping_levels", f"""with {PARSED}, levels as (select coalesce(language, '') as language, coalesce(file, '') as file,
    cast(grouping(language) * 2 + grouping(file) as int) as level, {_STATS} from parsed group by rollup (language, file))
select language, file, level, rows, disk_bytes, memory_bytes, {_FINISHED} from levels""")
def _(spark, d):
    levels = OP.grouping_levels(parsed(spark, d))
    return finished(levels, *_MEANS).na.fill("", ["language", "file"])


@query("split_variation", f"""with {FILES} select language,
    round(stddev_samp(mean_line_count) / avg(mean_line_count), 6) as cv_mean_line_count,
    round(stddev_samp(mean_ast_nodes) / avg(mean_ast_nodes), 6) as cv_mean_ast_nodes from files group by language""")
def _(spark, d):
    return rounded(OP.split_variation(files(spark, d)), "cv_mean_line_count", "cv_mean_ast_nodes")


PAIRS = [("mean_errors", "mean_ast_nodes"), ("mean_errors", "mean_line_count"), ("mean_errors", "zero_error_ratio"),
          ("mean_ast_nodes", "mean_line_count"), ("mean_ast_nodes", "zero_error_ratio"), ("mean_line_count", "zero_error_ratio")]


@query("correlation", f"with {FILES} " + " union all ".join(
    f"select '{a}' as column_a, '{b}' as column_b, round(corr({a}, {b}), 6) as corr from files" for a, b in PAIRS))
def _(spark, d):
    return rounded(OP.correlation(files(spark, d)), "corr")


@query("storage_by_language", f"""with {FILES} select language, cast(sum(rows) as bigint) as total_rows,
    cast(sum(disk_bytes) as bigint) as disk_bytes, cast(sum(memory_bytes) as bigint) as memory_bytes from files group by language""")
def _(spark, d):
    return OP.storage_by_language(files(spark, d))


@query("language_share", f"""with {SAMPLES} select language, count(*) as rows,
    round(100.0 * count(*) / sum(count(*)) over (), 6) as percent from samples group by language""")
def _(spark, d):
    return rounded(OP.language_share(samples(spark, d)), "percent")


@query("conversion_rates", f"""with {SAMPLES} select file, count(*) as total, count(*) filter (where doc_id % 37 <> 0) as successful,
    count(*) filter (where doc_id % 37 = 0) as failed,
    round(100.0 * count(*) filter (where doc_id % 37 <> 0) / count(*), 5) as success_rate,
    round(100.0 * count(*) filter (where doc_id % 37 = 0) / count(*), 5) as failure_rate from samples group by file""")
def _(spark, d):
    return OP.conversion_rates(samples(spark, d), ["file"], F.col("doc_id") % 37 != 0)


@query("run_summary", f"""with {SAMPLES}, status as (select language, count(*) filter (where contains(code, 'License')) * 100 < 4 * count(*)
    as succeeded from samples group by language)
select succeeded, count(*) as languages, string_agg(language, ',' order by language) as names from status group by succeeded""")
def _(spark, d):
    status = samples(spark, d).groupBy("language").agg(
        (F.count_if(F.col("code").contains("License")) * 100 < 4 * F.count(F.lit(1))).alias("succeeded"))
    return OP.run_summary(status)


@query("exact_dedup", f"""with {SAMPLES} select doc_id from (select doc_id, row_number() over (
    partition by sha256(code) order by doc_id) as r from samples) where r = 1""")
def _(spark, d):
    return OF.exact_dedup(samples(spark, d), "code", "doc_id").select("doc_id")


@query("sequential_id", f"""with {SAMPLES} select doc_id, language || '_' || cast(row_number() over (
    partition by language order by doc_id) - 1 as varchar) as key from samples""")
def _(spark, d):
    return with_sequential_key(samples(spark, d).drop("code"), "doc_id").select("doc_id", "key")


_INDEXED = """indexed as (select doc_id, language, row_number() over (partition by language order by doc_id) - 1 as i,
    count(*) over (partition by language) as n from samples),
quartered as (select doc_id, language, 1 + (i >= n // 4)::int + (i >= 2 * n // 4)::int + (i >= 3 * n // 4)::int as part from indexed)"""


@query("quarter_bucket", f"with {SAMPLES}, {_INDEXED} select doc_id, language, part from quartered")
def _(spark, d):
    return with_quarter(samples(spark, d), ["language"], "doc_id").select("doc_id", "language", "part")


@query("write_quarters", f"""with {SAMPLES}, {_INDEXED} select language, part, count(*) as rows,
    sha256(string_agg(doc_id || ':' || sha256(code), ',' order by doc_id)) as digest
from quartered join samples using (doc_id, language) group by language, part""")
def _(spark, d):
    path = stage_path(spark, "quarters")
    write_quarters(samples(spark, d), path, "doc_id")
    lines = F.sort_array(F.collect_list(F.struct("doc_id", F.concat_ws(":", F.col("doc_id").cast("string"), digest("code")).alias("line"))))
    return spark.read.parquet(path).groupBy("language", "part").agg(
        F.count(F.lit(1)).alias("rows"), F.array_join(lines["line"], ",").alias("_all")).select("language", "part", "rows", digest("_all").alias("digest"))


_SHUFFLED = """shuffled as (select doc_id, language, file, row_number() over (partition by language
    order by md5(cast(doc_id as varchar) || '_42'), doc_id) - 1 as position from samples)"""


@query("seeded_shuffle", f"with {SAMPLES}, {_SHUFFLED} select doc_id, language, position from shuffled")
def _(spark, d):
    return R.index_by_hash(samples(spark, d), ["language"], "doc_id", name="position").select(
        "doc_id", "language", "position")


@query("take_n", f"with {SAMPLES}, {_SHUFFLED} select doc_id, language from shuffled where position < 100")
def _(spark, d):
    return R.first_by_hash(samples(spark, d), ["language"], "doc_id", 100).select("doc_id", "language")


@query("sample_per_file", f"""with {SAMPLES}, ranked as (select doc_id, language, file, row_number() over (partition by language, file
    order by md5(cast(doc_id as varchar) || '_42'), doc_id) as r from samples),
shares as (select language, greatest(1, 150 // count(distinct file)) as share from samples group by language)
select doc_id, language, file from ranked join shares using (language) where r <= share""")
def _(spark, d):
    return R.sample_per_file(samples(spark, d), "language", "file", "doc_id", 150).select("doc_id", "language", "file")


@query("scan_slice", f"""with {SAMPLES} select doc_id, file from (select *, row_number() over (partition by file order by doc_id) as r
    from samples) where r <= 20""")
def _(spark, d):
    return R.first_by_column(samples(spark, d), ["file"], "doc_id", 20).select("doc_id", "file")


@query("preview", "select doc_id, lang, n_chars from documents order by doc_id limit 5")
def _(spark, d):
    return table(spark, d, "documents").select("doc_id", "lang", "n_chars").orderBy("doc_id").limit(5)


@query("threshold_join", f"""with {MEASURED}, q as (select language, quantile_cont(avg_line_length, 0.25) as q1,
    quantile_cont(avg_line_length, 0.75) as q3 from measured group by language)
select doc_id, language, avg_line_length > q3 + 1.5 * (q3 - q1) as above, avg_line_length < q1 - 1.5 * (q3 - q1) as below
from measured join q using (language)""")
def _(spark, d):
    measured = _measured(spark, d)
    bounds = OF.fences(measured, ["language"], "avg_line_length")
    return OF.lookup_join(measured, bounds, ["language"]).select(
        "doc_id", "language", (F.col("avg_line_length") > F.col("high")).alias("above"),
        (F.col("avg_line_length") < F.col("low")).alias("below"))
