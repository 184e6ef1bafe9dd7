"""Idempotent resume as a stream: new rows of a folder are taken once, whatever restarts happen between and however often they are delivered."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..plans.keyed import KeyedTable


def fresh(stream: DataFrame, keys: list[str], time: str, within: str) -> DataFrame:
    """Rows whose key did not come before. The stream's state remembers a key for so long after its time, restarts included; a row that is later than that is dropped."""
    return stream.withWatermark(time, within).dropDuplicatesWithinWatermark(keys)


def run_available(spark: SparkSession, source: str, schema: str, step: Callable[[DataFrame], DataFrame], sink: KeyedTable, checkpoint: str, name: str = "stream", files: int | None = None) -> int:
    """Every file of source that no earlier run with this checkpoint has read goes through step and is merged into sink; the number of rows merged.

    A batch whose merge was done but not noted by the stream before a failure comes again under its number and changes nothing. files: so many a batch at most.
    """
    before = sink.state()["n_merged"]
    read = spark.readStream.schema(schema)
    stream = (read.option("maxFilesPerTrigger", files) if files else read).parquet(source)
    merge = lambda batch, n: sink.merge(batch, name, n)
    step(stream).writeStream.foreachBatch(lambda batch, n: merge(batch, n) and None).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return sink.state()["n_merged"] - before
