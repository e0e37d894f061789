"""Node-type distributions per language, on the tags of the pages."""

from functools import reduce

from pyspark.sql import functions as F

from grovekit.catalog.profile import BUCKET_LABELS, BUCKET_SQL, FILES, PAIRS, files, rounded
from grovekit.catalog.registry import SPREAD_LANGUAGE, query, samples, spread_language, table
from grovekit.catalog.tree import DOCS, RECORDS, TAGS, pruned, record_json, tag_nodes, text_nodes
from grovekit.operators import distribution as D, profiling as OP
from grovekit.plans import analysis as A, preparation as P
from grovekit.session import stage_path, staged
from grovekit.sources.writers import write_csv

COUNTS = TAGS + ", counts as (select language, type, count(*) as cnt from page_nodes group by all)"
SHARES = COUNTS + ", shares as (select language, type, cnt / sum(cnt) over (partition by language) as p from counts)"
COSINES = SHARES + """, norms as (select language, sqrt(sum(p * p)) as norm from shares group by 1),
dots as (select x.language as a, y.language as b, sum(x.p * y.p) as dot from shares x join shares y using (type) group by all),
cosines as (select m.language as a, n.language as b, coalesce(dot, 0) / (m.norm * n.norm) as sim
    from norms m cross join norms n left join dots d on d.a = m.language and d.b = n.language)"""


def counts(spark, d):
    return D.type_counts(tag_nodes(spark, d), ["language"])


def shares(spark, d):
    """Shares from counts that are taken once, however often they are read."""
    return D.type_distribution(staged(counts(spark, d), "type-counts"))


@query("type_counts", f"with {COUNTS} select language, type, cnt from counts")
def _(spark, d):
    return counts(spark, d)


@query("type_counts_documents", f"""with {DOCS} select language, type, count(*) as cnt
from nodes join samples using (doc_id) group by all""")
def _(spark, d):
    return D.type_counts(text_nodes(spark, d, ["language"]), ["language"])


# Of five records one is cut short and one is written with single quotes, as another record.
QUOTED = """{'ast': {'nodes': [{'id': 0, 'type': 'quoted'}, {'inner': [{'type': 'deep', 'x': {'type': 'deeper'}}]}]}}"""


def broken_json(spark, d):
    i = F.col("doc_id") % 5
    return record_json(spark, d).withColumn("json", F.when(i == 1, F.expr("substring(json, 1, length(json) - 2)")).when(
        i == 2, QUOTED).otherwise(F.col("json")))


@query("record_type_counts", f"""with {RECORDS} select type, cast(sum(n) as bigint) as cnt from (
    select type, count(*) as n from categorized where doc_id % 5 not in (1, 2) group by type
    union all select unnest(['quoted', 'deep', 'deeper']), (select count(*) from samples where doc_id % 5 = 2)) group by type having sum(n) > 0""")
def _(spark, d):
    return A.record_type_counts(broken_json(spark, d), [], "json")


@query("unparsed_records", f"""with {RECORDS} select {SPREAD_LANGUAGE} as language, count(*) as records,
    count(*) filter (where doc_id % 5 = 1) as unparsed from samples group by 1""")
def _(spark, d):
    return A.unparsed_counts(broken_json(spark, d).withColumn("language", spread_language()), ["language"], "json")


@query("sampled_type_counts", """with ranked as (select event_id, event_type, cast(user_id % 4 as varchar) as language,
    cast(user_id % 8 as varchar) as file from events),
sampled as (select *, row_number() over (partition by language, file order by md5(cast(event_id as varchar) || '_42'), event_id) as r from ranked),
shares as (select language, greatest(1, 200 // count(distinct file)) as share from ranked group by language)
select language, event_type as type, count(*) as cnt from sampled join shares using (language) where r <= share group by all""")
def _(spark, d):
    rows = table(spark, d, "events").select(
        "event_id", (F.col("user_id") % 4).cast("string").alias("language"), (F.col("user_id") % 8).cast("string").alias("file"),
        F.concat(F.lit('{"ast":{"nodes":[{"id":0,"type":"'), "event_type", F.lit('"}]}}')).alias("universal_schema"))
    return A.sampled_type_counts(rows, "event_id", target=200)


@query("counter_merge", f"""with {COUNTS}, doc_counts as (select lang as language, 'document' as type, count(*) as cnt from documents group by 1)
select language, type, cast(sum(cnt) as bigint) as cnt from (select * from counts union all select * from doc_counts) group by all""")
def _(spark, d):
    whole = samples(spark, d).withColumn("type", F.lit("document"))
    return D.counter_merge(counts(spark, d), D.type_counts(whole, ["language"]), by=["language"])


@query("append_files", "select doc_id as id, text from documents union all select item_id, text from benchmark")
def _(spark, d):
    benchmark = table(spark, d, "benchmark").select(F.col("item_id").alias("id"), "text")
    return table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text").unionByName(benchmark)


@query("type_union", f"with {COUNTS} select distinct type from counts")
def _(spark, d):
    return D.type_union(counts(spark, d)).orderBy("type")


@query("top_types", f"""with {COUNTS} select language, type, cnt, rank from (select *, row_number() over (
    partition by language order by cnt desc, type) as rank from counts) where rank <= 10""")
def _(spark, d):
    return D.top_types(counts(spark, d))


@query("matrix_align", f"""with {COUNTS} select l.language, t.type, coalesce(c.cnt, 0) as cnt
from (select distinct language from counts) l cross join (select distinct type from counts) t
left join counts c on c.language = l.language and c.type = t.type""")
def _(spark, d):
    return D.matrix_align(counts(spark, d)).select("language", "type", "cnt")


@query("type_frequency_matrix", f"""with {COUNTS} select l.language, t.type, coalesce(c.cnt, 0) as cnt
from (select distinct language from counts) l cross join (select distinct type from counts) t
left join counts c on c.language = l.language and c.type = t.type""")
def _(spark, d):
    wide = D.type_frequency_matrix(counts(spark, d))
    return wide.unpivot(["language"], [c for c in wide.columns if c != "language"], "type", "cnt")


@query("type_distribution", f"with {SHARES} select language, type, round(p, 6) as p from shares")
def _(spark, d):
    return rounded(shares(spark, d), "p")


@query("type_entropy", f"""with {SHARES} select language, round(-sum(p * log2(p)), 6) as entropy_bits from shares where p > 0 group by language""")
def _(spark, d):
    return rounded(D.type_entropy(shares(spark, d)), "entropy_bits")


@query("order_entropy", f"""with {SHARES}, e as (select language, -sum(p * log2(p)) as h from shares where p > 0 group by language)
select language, round(h, 6) as entropy_bits, row_number() over (order by h desc, language) as rank from e""")
def _(spark, d):
    ranked = D.order_entropy(D.type_entropy(shares(spark, d)))
    return rounded(ranked, "entropy_bits")


@query("type_cosine", f"with {COSINES} select a, b, round(sim, 6) as sim from cosines")
def _(spark, d):
    return rounded(D.type_cosine(shares(spark, d)), "sim")


@query("pairwise", f"""with {COSINES} select m.language as a, n.language as b, round(coalesce(dot, 0), 6) as dot
from norms m cross join norms n left join dots d on d.a = m.language and d.b = n.language""")
def _(spark, d):
    return rounded(D.pairwise(shares(spark, d)), "dot")


@query("distance_pairs", f"""with {COSINES} select a, b, case when a = b then 0.0::double else abs(round(1 - sim, 6)) end as distance from cosines""")
def _(spark, d):
    pairs = D.distance_pairs(D.type_cosine(shares(spark, d)))
    return pairs.withColumn("distance", F.abs(F.round("distance", 6)))


@query("type_pca")
def _(spark, d):
    return D.type_pca(shares(spark, d))


@query("average_linkage")
def _(spark, d):
    return D.average_linkage(D.distance_pairs(D.type_cosine(shares(spark, d))))


# Data behind the plots: histogram, boxes, storage, correlation, share, similarity and entropy.
PLOTS = f"""select 'entropy' as plot, language as x, '' as y, round(-sum(p * log2(p)), 6) as value from shares where p > 0 group by language
union all select 'similarity', a, b, round(sim, 6) from cosines
union all select 'share', lang, '', round(100.0 * count(*) / sum(count(*)) over (), 6) from documents group by lang
union all select 'storage', language, 'disk_bytes', cast(sum(disk_bytes) as double) from files group by language
union all select 'storage', language, 'total_rows', cast(sum(rows) as double) from files group by language
union all select 'buckets', language, b, count(*) filter (where {BUCKET_SQL.format('line_count')} = i) from measured
    cross join (select unnest(range(11)) as i, unnest({BUCKET_LABELS}) as b) group by language, b
union all select 'box', language, 'p25', round(quantile_cont(avg_line_length, 0.25), 6) from measured group by language
union all select 'box', language, 'p50', round(quantile_cont(avg_line_length, 0.5), 6) from measured group by language
union all select 'box', language, 'p75', round(quantile_cont(avg_line_length, 0.75), 6) from measured group by language
union all """ + " union all ".join(f"select 'correlation', '{a}', '{b}', round(corr({a}, {b}), 6) from files" for a, b in PAIRS)


def plot_tables(spark, d):
    s, stats, measured = shares(spark, d), staged(files(spark, d), "file-stats"), P.with_raw_metrics(samples(spark, d))

    def plot(df, name, x, y, value):
        text = [F.lit("") if c is None else F.col(c) for c in (x, y)]
        return df.select(F.lit(name).alias("plot"), text[0].alias("x"), text[1].alias("y"), F.col(value).cast("double").alias("value"))

    def long(df, columns):
        return df.select("language", *[F.col(c).cast("double") for c in columns]).unpivot(["language"], columns, "y", "value")

    return reduce(lambda a, b: a.unionByName(b), [
        plot(D.type_entropy(s), "entropy", "language", None, "entropy_bits"),
        plot(D.type_cosine(s), "similarity", "a", "b", "sim"),
        plot(OP.language_share(samples(spark, d)), "share", "language", None, "percent"),
        plot(long(OP.storage_by_language(stats), ["disk_bytes", "total_rows"]), "storage", "language", "y", "value"),
        plot(OP.line_buckets(measured, ["language"]), "buckets", "language", "bucket", "samples"),
        plot(long(OP.boxplot_stats(measured, ["language"], "avg_line_length"), ["p25", "p50", "p75"]), "box", "language", "y", "value"),
        plot(OP.correlation(stats), "correlation", "column_a", "column_b", "corr"),
    ])


@query("plot_tables", f"with {COSINES}, {FILES} {PLOTS}")
def _(spark, d):
    return rounded(plot_tables(spark, d), "value")


@query("write_csv", f"with {COSINES}, {FILES} {PLOTS}")
def _(spark, d):
    path = stage_path(spark, "csv")
    tables = plot_tables(spark, d)
    write_csv(tables, path)
    return rounded(spark.read.schema(tables.schema).option("header", True).csv(path).fillna("", ["x", "y"]), "value")
