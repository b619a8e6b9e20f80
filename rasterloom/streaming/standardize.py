"""Incremental form of the image job: each arriving file is processed once."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cached_property

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from rasterloom.functions import codec
from rasterloom.functions.names import INGEST_SUFFIXES, basename, has_suffix
from rasterloom.operators.images import image_step, standardize_files
from rasterloom.plans.work import outcomes
from rasterloom.session import path_exists, scratch, ship, stored
from rasterloom.sinks.tables import append_dead_letters
from rasterloom.sources.files import list_files

FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"
_TASK_BYTES = 64 << 20
#: Names whose rows and states a Python worker gathers at once; Spark keeps two small tables for each until then.
STATE_ROWS = 250
_ROWS_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Names in a file of the log of arrivals: the driver sees these files, not the images they name.
LOG_ROWS = 10_000
_LOG_SCHEMA = "name string, path string, bytes long, modified timestamp"
# Of folders below the given one Spark's file source takes those of partitions, and it passes over hidden names.
_TAKEN = r"^([^/]*=[^/]*/)*[^/]+$"
_HIDDEN = r"(^|/)(\.|_(?!metadata|common_metadata)[^/=]*(/|$))"


class FileStream:
    """Names of image files as they arrive in a folder; contents are not read here.

    Spark's file source keeps every file that it lists or has seen on the driver. ``stream_standardize`` takes the
    same names from a log that tasks write into its checkpoint, if ``folder`` stands for folders alone. Used as a
    DataFrame, or with a pattern of files, this is Spark's source.
    """

    def __init__(self, spark: SparkSession, folder: str, max_files: int) -> None:
        self.sparkSession, self.folder, self.max_files = spark, folder, max_files

    @cached_property
    def table(self) -> DataFrame:
        """Lists the folder on the driver as soon as it is made."""
        files = (
            self.sparkSession.readStream.format("binaryFile")
            .schema(FILE_SCHEMA)
            .option("maxFilesPerTrigger", self.max_files)
            .load(self.folder)
        )
        named = files.select("path", basename(F.col("path")).alias("name"), F.col("length").alias("bytes"))
        return named.filter(has_suffix(F.col("name"), INGEST_SUFFIXES))

    def __getattr__(self, name: str):
        if name.startswith("__"):
            raise AttributeError(name)
        return getattr(self.table, name)

    def __getitem__(self, item):
        return self.table[item]


def file_stream(spark: SparkSession, folder: str, max_files: int = 1_000_000) -> FileStream:
    """Names of image files as they arrive in ``folder``, of ``max_files`` files at most in a batch."""
    return FileStream(spark, folder, max_files)


def _folders(spark: SparkSession, pattern: str) -> list[str]:
    """The folders that ``pattern`` stands for; none if it stands for a file too."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    folders = []
    for found in path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []:
        if not found.isDirectory():
            return []
        folders.append(found.getPath().toString())
    return folders


def _logged(spark: SparkSession, folders: list[str], max_files: int, log: str) -> DataFrame:
    """Stream of the names in ``folders``, by way of ``log``, to which those that it does not hold yet are added.

    Tasks list the folders, compare the names with the log and write it; the driver sees the files of the log. The
    names of ``max_files`` images at most come in one batch, the oldest first.
    """
    place = spark._jvm.org.apache.hadoop.fs.Path(log)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(place)
    rows = max(1, min(LOG_ROWS, max_files))
    with scratch(spark):
        listed = list_files(spark, {folder: folder for folder in folders}, recurse=True)
        listed = listed.filter(F.col("name").rlike(_TAKEN) & ~F.col("name").rlike(_HIDDEN))
        named = listed.select(basename(F.col("path")).alias("name"), "path", F.col("size_bytes").alias("bytes"), F.col("mtime").alias("modified"))
        named = named.filter(has_suffix(F.col("name"), INGEST_SUFFIXES))
        # Paths compress so well that a large log would pass for small enough to be broadcast.
        known = spark.read.schema(_LOG_SCHEMA).parquet(log).select("path").hint("merge")
        fresh = stored(named.join(known, "path", "left_anti").select("name", "path", "bytes", "modified"), "fresh")
        count = fresh.count()
        if count:
            before = {part.getPath().getName() for part in files.listStatus(place)}
            age = ["modified", "path"]
            dealt = fresh.repartitionByRange(-(-count // rows), *age).sortWithinPartitions(*age)
            dealt.write.option("maxRecordsPerFile", rows).mode("append").parquet(log)
        if count > max_files:  # Spark takes the files of the log by their time
            written = {part.getPath().getName(): part for part in files.listStatus(place)}
            made = sorted(name for name in written if name.startswith("part-") and name not in before)
            last = max(written[name].getModificationTime() for name in made)
            for at, name in enumerate(made):
                files.setTimes(written[name].getPath(), last + at, -1)
    read = spark.readStream.schema(_LOG_SCHEMA).option("maxFilesPerTrigger", max(1, max_files // rows))
    return read.parquet(log).filter("bytes > 0")  # as Spark, which marks empty files as seen and passes over them


def _remember(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """The first path of a name in this batch, with the earlier batches in which the name came."""
    path, size = None, 0
    for part in parts:
        at = part["path"].idxmin()
        if path is None or part["path"][at] < path:
            path, size = part["path"][at], part["bytes"][at]
    came = state.get[0] if state.exists else ""
    batch = TaskContext.get().getLocalProperty("streaming.sql.batchId")
    state.update((f"{came},{batch}" if came else batch,))
    yield pd.DataFrame({"name": [key[0]], "path": [path], "bytes": [size], "came": [came]})


def _arrived(batch: DataFrame) -> DataFrame:
    """The names of a batch, stored; a worker gathers ``STATE_ROWS`` of them at most."""
    own = batch.sparkSession  # the stream's copy of the session: the caller's is left as it is
    rows = own.conf.get(_ROWS_KEY)
    own.conf.set(_ROWS_KEY, min(int(rows), STATE_ROWS) if int(rows) > 0 else STATE_ROWS)
    try:
        return stored(batch, "arrived")
    finally:
        own.conf.set(_ROWS_KEY, rows)


def stream_standardize(
    source: DataFrame | FileStream,
    output: str,
    checkpoint: str,
    step: Callable | None = None,
    decode: Callable = codec.decode,
    letters: str | None = None,
    counters: str | None = None,
) -> StreamingQuery:
    """Process what has arrived since the last run, then stop; ``output`` is a Parquet image table.

    The checkpoint remembers the files seen (in ``arrivals``, for a ``file_stream``) and, as state by name, the batches in which each name came. A new name
    is read without a look at earlier outputs. A name that came before is looked up in the outputs of just those
    batches, so it is processed again if it failed there or its output was deleted. The work of a batch thus
    follows what arrives, not what was done before. State is kept by Spark's state store (RocksDB in ``session()``);
    of a name that comes from several paths in a batch the first path counts. A batch that is repeated overwrites its own folder, in
    ``output`` as in the tables of dead letters (``letters``) and of counts by status (``counters``), which come with
    the write of the images, without a second read.
    """
    step = step or image_step()
    spark = source.sparkSession
    ship(spark)
    if isinstance(source, FileStream) and (folders := _folders(spark, source.folder)):
        source = _logged(spark, folders, source.max_files, f"{checkpoint}/arrivals")
    named = source.select("name", "path", "bytes").groupBy("name").applyInPandasWithState(
        _remember, "name string, path string, bytes long, came string", "came string", "append", GroupStateTimeout.NoTimeout
    )

    def process(batch: DataFrame, batch_id: int) -> None:
        with scratch(batch.sparkSession):
            settle(batch, batch_id)

    def settle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        fresh = _arrived(batch)
        again = fresh.filter("came <> ''").select(F.explode(F.split("came", ",")).alias("batch")).distinct()
        earlier = sorted(int(r["batch"]) for r in again.collect())  # numbers of batches
        if earlier and path_exists(spark, output):
            fresh = fresh.join(finished(spark, output, earlier), "name", "left_anti")
        total = fresh.agg(F.sum("bytes")).first()[0] or 0
        tasks = max(spark.sparkContext.defaultParallelism, -(-total // _TASK_BYTES))
        results = standardize_files(fresh.drop("bytes", "came").repartition(tasks), step, decode, "path")
        sized = results.withColumn("size_bytes", F.coalesce(F.length("image.data"), F.lit(0)).cast("long"))
        where = f"{output}/batch={batch_id}"
        watch = Observation(f"batch-{batch_id}")
        sized.observe(watch, *outcomes()).write.mode("overwrite").parquet(where)
        done = spark.read.schema("name string, status string, error string").parquet(where)
        if letters:
            lost = done.filter("status <> 'ok'").select(F.col("name").alias("image_name"), F.lit("process").alias("stage"), "error")
            append_dead_letters(lost, f"{letters}/batch={batch_id}", f"batch-{batch_id}", "overwrite")
        if counters:
            held = [(status, n) for status, n in watch.get.items() if n]
            held = spark.createDataFrame(held, "status string, images long")
            held.write.mode("overwrite").parquet(f"{counters}/batch={batch_id}")

    return (
        named.writeStream.foreachBatch(process)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def finished(spark: SparkSession, output: str, batches: list[int]) -> DataFrame:
    """Names with a non-empty output in one of the batches; others are not opened, and image bytes are not read."""
    # With a schema, a first batch that broke off and left no file is no error.
    table = spark.read.schema("name string, size_bytes long, batch long").parquet(output)
    table = table.filter(F.col("batch").isin(batches))
    return table.filter("size_bytes > 0").select("name").distinct()
