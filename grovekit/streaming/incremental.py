"""Incremental flows: only files not seen before are processed.

Every batch writes below ``run=r/batch=n`` and replaces what it has written when it is run
again after a failure, so nothing is written twice. A checkpoint that is new begins a new
run, so an output that is already there stays. A run that finds no file leaves an empty
table.
"""

from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, StringType, StructField, StructType

from grovekit.functions.text import source_hash
from grovekit.sources.writers import converted_counts, write_converted

#: Digits of a hash that name its folder: 256 folders.
PREFIX_DIGITS = 2
#: Batches whose hashes are kept apart before they are gathered.
LOOSE_BATCHES = 16


def new_files(spark, path, schema, pattern="*.parquet"):
    """Stream over the files of a folder."""
    return (
        spark.readStream.schema(schema).option("pathGlobFilter", pattern).parquet(path)
        .withColumn("file", F.col("_metadata.file_name"))
    )


def _folder(spark, path):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def _numbers(spark, path, stem):
    """Numbers n of the folders ``stem=n`` in ``path``, ascending."""
    folder, system = _folder(spark, path)
    if not system.exists(folder):
        return []
    names = [x.getPath().getName() for x in system.listStatus(folder)]
    return sorted(int(n[len(stem) + 1:]) for n in names if n.startswith(f"{stem}="))


def _run_number(spark, output, checkpoint):
    """Number of the run a checkpoint belongs to."""
    runs = _numbers(spark, output, "run")
    folder, system = _folder(spark, checkpoint)
    if system.exists(folder):
        return runs[-1] if runs else 0
    return runs[-1] + 1 if runs else 0


def _written(spark, output, schema):
    """Everything below ``output``; empty before the first batch."""
    folder, system = _folder(spark, output)
    stored = StructType([*schema.fields, StructField("run", IntegerType()), StructField("batch", IntegerType())])
    if not system.exists(folder):
        return spark.createDataFrame([], stored)
    return spark.read.option("basePath", output).schema(stored).parquet(output)


def _run(stream, work, checkpoint):
    query = (
        stream.writeStream.foreachBatch(work)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()


def incremental_convert(spark, path, schema, transform, output, checkpoint, pattern="*.parquet"):
    """Apply a batch transformation to the new files of a folder; returns all rows written so far."""
    run = _run_number(spark, output, checkpoint)
    stream = new_files(spark, path, schema, pattern)

    def work(batch, number):
        transform(batch).write.mode("overwrite").parquet(f"{output}/run={run}/batch={number}")

    _run(stream, work, checkpoint)
    shape = transform(spark.createDataFrame([], stream.schema)).schema
    return _written(spark, output, shape).drop("run", "batch")


def incremental_conversion(spark, path, schema, convert, output, checkpoint, file="file", pattern="*.parquet"):
    """Convert the new files of a folder, writing and counting in one pass per batch.

    ``convert`` maps a batch to converted rows with the column ``file``. Returns the rows
    converted so far and, per input file over all batches, the rows read and converted. Both are read
    from what the batches have committed, so they agree after a failure at any point.
    """
    run = _run_number(spark, output, checkpoint)
    stream = new_files(spark, path, schema, pattern)

    def work(batch, number):
        write_converted(convert(batch), f"{output}/run={run}/batch={number}", file)

    _run(stream, work, checkpoint)
    shape = convert(spark.createDataFrame([], stream.schema)).schema
    written = _written(spark, output, StructType([*shape.fields, StructField("whole", BooleanType())]))
    return written.where("whole").drop("whole", "run", "batch"), converted_counts(written, file)


class HashState:
    """Hashes admitted so far, in one folder per prefix.

    A batch adds its hashes as ``run=r/batch=n``. Once there are many, the batches before the
    present one are gathered as ``base=m``, which readers take as soon as it is complete and which
    stands for the first ``m`` folders. A lookup names the prefixes it needs, so only their folders are read.
    """

    _SCHEMA = "content_hash string, prefix string"

    def __init__(self, spark, path, digits=PREFIX_DIGITS, loose=LOOSE_BATCHES):
        self._spark, self._path, self._digits, self._loose = spark, path, digits, loose

    def prefix(self, column="content_hash"):
        return F.substring(column, 1, self._digits)

    def _folders(self, but):
        """Folders to read: the latest complete base, and the batches it does not stand for."""
        parts = [(r, b) for r in _numbers(self._spark, self._path, "run")
                 for b in _numbers(self._spark, f"{self._path}/run={r}", "batch") if (r, b) != but and self._complete(f"run={r}/batch={b}")]
        bases = [n for n in _numbers(self._spark, self._path, "base") if self._complete(f"base={n}")]
        held = bases[-1] if bases else 0
        return ([f"base={held}"] if bases else []) + [f"run={r}/batch={b}" for r, b in parts[held:]], len(parts), held

    def _complete(self, name):
        folder, system = _folder(self._spark, f"{self._path}/{name}/_complete")
        return system.exists(folder)

    def _read(self, names):
        if not names:
            return self._spark.createDataFrame([], self._SCHEMA)
        parts = [self._spark.read.schema(self._SCHEMA).parquet(f"{self._path}/{n}") for n in names]
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out

    def known(self, hashes, but):
        """Hashes of earlier batches with a prefix that occurs in ``hashes``; ``but`` is the present (run, batch)."""
        touched = [r[0] for r in hashes.select(self.prefix().alias("prefix")).distinct().collect()]
        return self._read(self._folders(but)[0]).where(F.col("prefix").isin(touched))

    def add(self, hashes, run, batch):
        self._write(hashes.withColumn("prefix", self.prefix()), f"run={run}/batch={batch}")
        names, parts, held = self._folders((run, batch))
        if parts - held >= self._loose:
            self._write(self._read(names), f"base={parts}")

    def _write(self, rows, name):
        path = f"{self._path}/{name}"
        (
            rows.select("content_hash", "prefix").repartition("prefix").write.partitionBy("prefix")
            .option("partitionOverwriteMode", "static").mode("overwrite").parquet(path)
        )
        marker, system = _folder(self._spark, f"{path}/_complete")
        system.create(marker, True).close()


def incremental_dedup(spark, path, schema, key, text, output, checkpoint, pattern="*.parquet", state=None):
    """Admit texts whose hash has not been admitted by an earlier batch; returns all rows admitted.

    Inside a batch copies are counted down to the smallest key before the hashes are looked up.
    """
    state = state or HashState(spark, output.rstrip("/") + "-hashes")
    run = _run_number(spark, output, checkpoint)
    stream = new_files(spark, path, schema, pattern)

    def admit(batch, number):
        hashed = batch.withColumn("content_hash", source_hash(text)).persist()
        keepers = hashed.groupBy("content_hash").agg(F.min(key).alias(key))
        fresh = keepers.join(state.known(keepers, (run, number)), "content_hash", "left_anti")
        admitted = hashed.join(fresh.select(key), key, "left_semi")
        admitted.write.mode("overwrite").parquet(f"{output}/run={run}/batch={number}")
        state.add(spark.read.parquet(f"{output}/run={run}/batch={number}").select("content_hash").where("content_hash is not null"), run, number)
        hashed.unpersist()

    _run(stream, admit, checkpoint)
    admitted = StructType([*stream.schema.fields, StructField("content_hash", StringType())])
    return _written(spark, output, admitted).drop("run", "batch")
