"""Landed pages as a stream: the same columns as the batch reader, and scoring per micro-batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from narrata.functions.text import preprocess
from narrata.sources.pages import COLUMNS, PAGE_SCHEMA, hits_of


def read_pages(spark: SparkSession, path: str, max_files: int | None = None, one_page_per_file: bool = True) -> DataFrame:
    """Canonical records of every page file that lands in ``path``."""
    reader = spark.readStream.schema(PAGE_SCHEMA).option("multiLine", one_page_per_file)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return hits_of(reader.json(path), []).select(*[F.col(f"`{c}`") for c in COLUMNS])


def received(records: DataFrame) -> DataFrame:
    """Add ``received_at``; null where there is no date that can be read."""
    return records.withColumn("received_at", F.try_to_timestamp("date_received"))


def drop_repeats(records: DataFrame, delay: str = "7 days") -> DataFrame:
    """Keep one dated record per id while its received time is within ``delay``; state is dropped after it.

    Records without a date are not kept here, as no watermark would ever drop their state: see ``undated``. A record more
    than ``delay`` behind the latest date of earlier micro-batches is late; it is left out and counted by ``late_rows``.
    """
    return received(records).filter("received_at is not null").withWatermark("received_at", delay).dropDuplicatesWithinWatermark(["complaint_id"])


def undated(records: DataFrame) -> DataFrame:
    """Records without a date that can be read, every copy of them: they have a sink of their own."""
    return received(records).filter("received_at is null")


def write_unique(records: DataFrame, path: str, checkpoint: str, delay: str = "7 days") -> list[StreamingQuery]:
    """Two streams until all files are taken: unique dated records to ``path/unique``, the undated to ``path/undated``."""
    return [write_records(drop_repeats(records, delay), f"{path}/unique", f"{checkpoint}/unique"),
            write_records(undated(records), f"{path}/undated", f"{checkpoint}/undated")]


def late_rows(stream: StreamingQuery) -> int:
    """Records that the watermark has left out in the micro-batches the stream still reports."""
    return sum(s["numRowsDroppedByWatermark"] for p in stream.recentProgress for s in p["stateOperators"])


def write_records(records: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    writer = records.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def score_stream(records: DataFrame, score: Callable[[DataFrame], DataFrame], path: str, checkpoint: str) -> StreamingQuery:
    """Score each micro-batch with a batch function on ``(complaint_id, text)``.

    The batch number names the output folder, so that a batch that is run again replaces itself.
    """

    def one(batch: DataFrame, number: int) -> None:
        rows = batch.select("complaint_id", preprocess("text").alias("text")).filter("text <> ''")
        score(rows).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return records.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
