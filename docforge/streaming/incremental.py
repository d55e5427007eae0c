"""Batches of new files as a stream: what was processed is the stream's checkpoint."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docforge.plans.batch import Batch, process_files

FILES = "path string, modificationTime timestamp, length long, content binary"


def process_new(spark: SparkSession, path: str, schema: str, checkpoint: str, handle: Callable[[DataFrame, int], None], files_per_batch: int = 1000) -> StreamingQuery:
    """Hand each batch of new Parquet files under ``path`` to ``handle`` once, then stop when none are left.

    A batch may be handed over again after a failure, so ``handle`` should overwrite by batch number.
    """
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)
    return stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(handle).start()


def first_of_each(files: DataFrame) -> DataFrame:
    """A stream of files with file_id, without contents that came before: the ids are the state, kept for good.

    Of equal contents in one micro-batch any one is taken. A content counts as seen even if reading it fails.
    """
    return files.withColumn("file_id", F.sha2("content", 256)).dropDuplicates(["file_id"])


def process_stream(
    spark: SparkSession, folder: str, output: str, load: Callable[[], Callable], checkpoint: str, options: Batch = Batch(), model: Callable[[DataFrame], Column] | None = None, files_per_batch: int = 1000  # noqa: B008
) -> StreamingQuery:
    """``plans.batch.process_batch`` on the files that arrive in a folder: each micro-batch is a run of ``output``'s tables.

    A run is named by the checkpoint and the batch's number, and committed once: a batch that is handed over again after a
    failure is left out if it was committed and made from the start if not. Limits and samples are of no use here and
    refused. The stream stops when no new file is left; with the same checkpoint the next one goes on from there.
    """
    options.check()
    if options.limit or options.sample or options.debug_limit:
        raise ValueError("a stream takes all files: no limit, no sample")

    def handle(files: DataFrame, number: int) -> None:
        with_all = files.select("path", "length", "content", "file_id").persist()  # read once by two joins; recomputed if lost
        try:
            process_files(spark, with_all.select("file_id", "path"), with_all, output, load, options, model, source=f"{checkpoint}:{number}")
        finally:
            with_all.unpersist()

    stream = spark.readStream.format("binaryFile").schema(FILES).option("maxFilesPerTrigger", files_per_batch).option("pathGlobFilter", f"*.{options.suffix}").load(folder)
    return first_of_each(stream).writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(handle).start()
