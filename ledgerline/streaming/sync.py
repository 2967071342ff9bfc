"""The recurring sync as a Structured Streaming query.

A file (or any streaming) source is read with ``readStream``; every
micro-batch is merged into a ``ParquetTarget`` through ``foreachBatch``.
The stream checkpoint replaces the cursor: a file is processed once, and a
re-delivered or late row is not newer than the table's and changes nothing,
so the sink is exactly-once.
``trigger(availableNow=True)`` drains what has landed and stops — the
scheduled-batch form; a processing-time trigger makes it continuous.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ledgerline.operators.targets import ParquetTarget


def file_stream(spark: SparkSession, directory: str, schema: StructType, fmt: str = "parquet",
                glob: str | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).format(fmt)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(directory)


def start_sync(stream: DataFrame, target: ParquetTarget, checkpoint: str,
               tiebreak: list[str] | None = None, available_now: bool = True,
               processing_time: str | None = None) -> StreamingQuery:
    def apply(batch: DataFrame, epoch: int) -> None:
        target.apply(batch, epoch, tiebreak, checkpoint)  # the checkpoint folder is the query's identity

    writer = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime=processing_time or "5 minutes")
    return writer.start()


def sync_available(stream: DataFrame, target: ParquetTarget, checkpoint: str,
                   tiebreak: list[str] | None = None, timeout_s: float = 3600) -> DataFrame | None:
    """Drain everything available now, wait, and return the target table.
    A drain that takes longer than ``timeout_s`` is stopped and raises; what it
    committed stays, and the next call goes on from there."""
    q = start_sync(stream, target, checkpoint, tiebreak)
    if not q.awaitTermination(timeout_s):
        q.stop()
        raise TimeoutError(f"the sync did not drain its source within {timeout_s} s")
    if q.exception():
        raise q.exception()
    return target.read()
