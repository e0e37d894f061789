"""Where queries and their SQL are registered, and the inputs they share.

``samples`` binds the ``documents`` table to the sample columns. ``coded`` spreads the
documents over the ten languages of the corpus. Both sides state the same input, so the
comparison covers the operator alone.
"""

from pyspark.sql import functions as F

from grovekit.fixed import LANGUAGES

QUERIES = {}
ORACLE = {}


def query(name, sql=None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLE[name] = sql
        return function
    return register


def table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def samples(spark, folder):
    return table(spark, folder, "documents").select(
        "doc_id", F.col("lang").alias("language"), F.col("text").alias("code"),
        F.col("source").alias("file"),
    )


SAMPLES = "samples as (select doc_id, lang as language, text as code, source as file from documents)"


def spread_language(key="doc_id"):
    return F.element_at(
        F.array(*[F.lit(x) for x in LANGUAGES]), (F.col(key) % len(LANGUAGES) + 1).cast("int")
    )


SPREAD_LANGUAGE = "list_extract([" + ", ".join(f"'{x}'" for x in LANGUAGES) + "], cast(doc_id % 10 + 1 as int))"


def digest(column):
    return F.sha2(F.encode(F.col(column) if isinstance(column, str) else column, "UTF-8"), 256)


def r6(column):
    return F.round(column, 6)


NL = "chr(10)"


def whole_digest(df, columns, order="id", key="doc_id"):
    """Number of rows and one digest of their columns, in order, per record."""
    line = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in columns])
    lines = F.sort_array(F.collect_list(F.struct(F.col(order).alias("at"), line.alias("line"))))
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("rows"), F.array_join(lines["line"], "\n").alias("_all")).select(
        key, "rows", digest("_all").alias("digest"))


def sql_digest(columns, order="nid"):
    line = ", ".join(f"coalesce(cast({c} as varchar), '-')" for c in columns)
    return f"count(*) as rows, sha256(string_agg(concat_ws(':', {line}), {NL} order by {order})) as digest"


RAW_COUNT = "len(string_split(code, chr(10)))"
RAW_AVG = "((length(code) - (len(string_split(code, chr(10))) - 1)) / len(string_split(code, chr(10))))"
NODE_COUNT = r"(1 + len(string_split(code, chr(10))) + len(regexp_extract_all(code, '[^ \n]+')))"
MEASURED = (
    SAMPLES + ", measured as (select *, " + RAW_AVG + " as avg_line_length, " + RAW_COUNT
    + " as line_count from samples)"
)
