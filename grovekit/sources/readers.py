"""Readers."""

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from grovekit.fixed import LANGUAGES
from grovekit.functions.text import normalize_language

SAMPLE_TYPE = "struct<code:string,avg_line_length:double,line_count:int>"


def scan_language(spark, path, language, languages=LANGUAGES, column="language"):
    """Rows of one language; a partitioned table is pruned to its folder."""
    if language not in languages:
        raise ValueError(f"unsupported language: {language}")
    return spark.read.parquet(path).where(F.col(column) == language)


def scan_columns(spark, path, *columns):
    """Only the named columns."""
    return spark.read.parquet(path).select(*columns)


def scan_glob(spark, path, pattern="*.parquet", schema=None):
    """Files of a folder by name pattern, with the file name of every row."""
    reader = spark.read.option("pathGlobFilter", pattern)
    if schema is not None:
        reader = reader.schema(schema)
    try:
        df = reader.parquet(path)
    except Exception as error:
        if schema is None and "UNABLE_TO_INFER_SCHEMA" in str(error):
            raise FileNotFoundError(f"no files match {pattern} in {path}") from error
        raise
    return df.withColumn("file", F.col("_metadata.file_name"))


def scan_language_files(spark, path, language):
    """Files ``{language}_parsed_*`` of a folder."""
    return scan_glob(spark, path, f"{language}_parsed_*.parquet")


def explode_keyed_json(df, column="value"):
    """Keyed JSON objects to sample rows; the language is the key up to its first ``_``."""
    entries = F.from_json(F.col(column), f"map<string,{SAMPLE_TYPE}>")
    return df.select(F.explode(entries).alias("key", "sample")).select(
        F.split_part("key", F.lit("_"), F.lit(1)).alias("language"),
        "key", "sample.code", "sample.avg_line_length", "sample.line_count",
    )


def scan_keyed_json(spark, path):
    """Keyed JSON, one object with any number of keys per line.

    One record per line keeps the input splittable; that is what the writer produces.
    """
    return explode_keyed_json(spark.read.text(path))


def _scan_tables(spark, path, pattern):
    """Rows of the folders in ``path`` whose own name fits; ``file`` is that name."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    root = root.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).makeQualified(root)
    level = len([x for x in root.toUri().getPath().split("/") if x])
    parts = F.split(F.regexp_replace("_metadata.file_path", "^[^:/]+:(//[^/]*)?/+", ""), "/")
    try:
        df = spark.read.parquet(f"{path.rstrip('/')}/{pattern}")
    except AnalysisException as error:
        raise FileNotFoundError(f"no files match {pattern} in {path}") from error
    return df.withColumn("file", F.get(parts, F.lit(level)))


def file_footprint(spark, path, pattern="*.parquet"):
    """Rows, size on disk and logical size in memory per file.

    Where the pattern names no file but folders, as of tables written by many tasks, each folder
    counts as one.
    """
    try:
        df = scan_glob(spark, path, pattern)
    except FileNotFoundError:
        df = _scan_tables(spark, path, pattern)
    fields = [f for f in df.schema.fields if f.name != "file"]
    size = F.lit(0)
    for f in fields:
        kind = f.dataType.typeName()
        if kind in ("string", "binary"):
            size = size + F.coalesce(F.octet_length(F.col(f.name)), F.lit(0))
        elif kind in ("array", "map", "struct"):
            size = size + F.coalesce(F.octet_length(F.to_json(F.col(f.name))), F.lit(0))
        else:
            size = size + F.lit(8)
    part = df.groupBy("file", F.col("_metadata.file_path").alias("_part")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.max("_metadata.file_size").alias("disk_bytes"),
        F.sum(size.cast("bigint")).alias("memory_bytes"),
    )
    return part.groupBy("file").agg(*[F.sum(c).alias(c) for c in ("rows", "disk_bytes", "memory_bytes")])


def with_language(df, column="language"):
    """One spelling per language, applied at the first scan."""
    return df.withColumn(column, normalize_language(column))
