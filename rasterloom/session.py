"""Session settings, the shared working folder and shipping of this package to executors."""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Arrow batches are bounded by bytes, so a batch of large images cannot outgrow a Python worker.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": "67108864",
    "spark.sql.session.timeZone": "UTC",
    # The state of a stream lies on disk, and a batch writes only what it changes.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.python.worker.reuse": "true",
}


def session(app: str = "rasterloom", master: str | None = None, **conf: str) -> SparkSession:
    """Build a session with the settings the image stages expect; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = DEFAULTS | {k.replace("__", "."): v for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def qualified(spark: SparkSession, path: str) -> str:
    """Absolute URI of ``path`` under the cluster's default file system."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.makeQualified(hadoop_path).toString()


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def is_folder(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(hadoop_path) and fs.getFileStatus(hadoop_path).isDirectory()


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder, visible to all executors, below ``spark.checkpoint.dir``.

    A machine-local temporary folder is used only in local mode with that setting unset.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
        base = os.path.join(tempfile.gettempdir(), "rasterloom")
    return qualified(spark, f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}")


_written: list[str] = []


@contextmanager
def scratch(spark: SparkSession):
    """Removes at its end what ``stored`` has written within it. Nothing lazy may outlive it."""
    mark = len(_written)
    try:
        yield
    finally:
        while len(_written) > mark:
            path = spark._jvm.org.apache.hadoop.fs.Path(_written.pop())
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to the shared folder and continue from there, so it is computed only once."""
    spark = df.sparkSession
    where = shared_dir(spark, purpose)
    _written.append(where)
    df.write.parquet(where)
    return spark.read.schema(df.schema).parquet(where)


def ship(spark: SparkSession) -> None:
    """Make this package importable in Python workers (once per Spark context)."""
    context = spark.sparkContext
    if getattr(context, "_rasterloom_shipped", False):
        return
    from rasterloom.sources import storage

    root = os.path.dirname(os.path.abspath(__file__))
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as out:
        for folder, _, files in os.walk(root):
            for name in sorted(f for f in files if f.endswith(".py")):
                full = os.path.join(folder, name)
                out.write(full, os.path.relpath(full, os.path.dirname(root)))
    where = f"{shared_dir(spark, 'package')}/rasterloom_package.zip"
    stream, finish = storage.open_replacing(where, "driver")
    stream.write(packed.getvalue())
    finish()
    context.addPyFile(where)
    context._rasterloom_shipped = True
