"""The corpus pipeline: documents to packed training sequences, stage by stage.

Each stage is a function of (spark, docs, sf_dir) and reads only its docs and the side tables
in sf_dir (labels, benchmark). All but the last return the columns of the documents they are
given. Empty tables pass through; null texts are kept until packing, where they are empty.
"""

from pyspark.sql import functions as F

from grovekit.llm import benchmark, lines, minhash, packing, toxicity
from grovekit.llm.names import fresh
from grovekit.session import staged


def _side_table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def reject_toxic(spark, docs, sf_dir):
    """Documents that score below one half."""
    model = toxicity.fit(docs, _side_table(spark, sf_dir, "labels"))
    name = fresh(docs, "_score")
    return toxicity.score(docs, model, name=name).where(F.col(name) < 0.5).drop(name)


def drop_boilerplate(spark, docs, sf_dir):
    """Documents without lines of many sites; those of which nothing is left go."""
    out = lines.remove_boilerplate(docs)
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.col("n_removed") > 0, length).otherwise(F.col("n_chars")))
    emptied = (F.col("n_removed") > 0) & (F.trim("text") == "")
    return out.where(~F.coalesce(emptied, F.lit(False))).select(*docs.columns)


def keep_one_of_each(spark, docs, sf_dir):
    """One document of each group of near-duplicates."""
    return minhash.keep_one_each(docs)


def drop_contaminated(spark, docs, sf_dir):
    """Documents that do not hold passages of the benchmark."""
    return benchmark.drop_contaminated(docs, _side_table(spark, sf_dir, "benchmark"))


def pack_sequences(spark, docs, sf_dir):
    """Pieces of token ids with their places in sequences."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("line_dedup", drop_boilerplate),
    ("near_duplicates", keep_one_of_each),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

#: No SQL expresses learned scores, hash minima or tokens; tests compare the stages with plain computations.
ORACLE_SQL = None


def run(spark, sf_dir):
    """Rows of the last stage for the documents of ``sf_dir``."""
    docs = _side_table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = staged(docs, f"pipeline-{name}")
    return docs
