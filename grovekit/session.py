"""Session settings and the shared folder for cut lineage and stage tables."""

import atexit
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"
_STAGED = []


def local_session(name="grovekit", cores="*", partitions=8, memory="8g"):
    """Session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_folder(spark):
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Without that setting a local master gets a temporary folder. A cluster falls back to
    its warehouse folder if that lies in a shared store, and otherwise raises: each
    executor would write to its own disk and read back a part of the data.
    """
    folder = spark.conf.get(_CHECKPOINT_KEY, None)
    if folder:
        return folder
    if spark.sparkContext.master.split("[")[0] == "local":
        return os.path.join(tempfile.gettempdir(), f"grovekit-{os.getpid()}")
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    if warehouse.startswith(("file:", "/")) or ":" not in warehouse:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return warehouse.rstrip("/") + "/_grovekit"


def cut_lineage(df):
    """Reliable checkpoint of ``df`` in the shared folder."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def stage_path(spark, label):
    """Fresh path for a stage table below the shared folder; removed when the driver ends."""
    path = f"{shared_folder(spark).rstrip('/')}/stages/{label}-{uuid.uuid4().hex}"
    if not _STAGED:
        atexit.register(drop_stages)
    _STAGED.append((spark, path))
    return path


def drop_stages():
    """Remove the stage tables this driver has written; results must have been read."""
    while _STAGED:
        spark, path = _STAGED.pop()
        try:
            jvm = spark._jvm
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(target, True)
        except Exception:  # the session has ended; the folder's own clean-up remains
            continue


def staged(df, label, partition_by=None):
    """Write ``df`` as a stage table and read it back."""
    path = stage_path(df.sparkSession, label)
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
