"""Event feeds: channels with text payloads, appended as files and read as a stream."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

FEED_SCHEMA = "channel string, payload string, sent_at timestamp"


def notify(events: DataFrame, path: str) -> None:
    """Append events (columns ``channel``, ``payload``, optionally ``sent_at``) to a feed."""
    sent = F.col("sent_at").cast("timestamp") if "sent_at" in events.columns else (
        F.current_timestamp())
    events.select("channel", F.col("payload").cast("string").alias("payload"),
                  sent.alias("sent_at")).write.mode("append").parquet(path)


def listen(spark: SparkSession, path: str, channels: Iterable[str],
           payload_schema: str | None = None, max_files: int = 1000) -> DataFrame:
    """Stream of the channels' events; with a schema, payloads are parsed from JSON."""
    feed = spark.readStream.schema(FEED_SCHEMA).option(
        "maxFilesPerTrigger", max_files).parquet(path)
    chosen = feed.filter(F.col("channel").isin(list(channels)))
    if payload_schema is None:
        return chosen
    return chosen.withColumn("payload", F.from_json("payload", payload_schema))


def deliver(stream: DataFrame, each: Callable[[DataFrame, int], None],
            checkpoint: str) -> StreamingQuery:
    """Hand the stream to ``each(batch, batch_id)`` until the present input is used up.

    A batch may come twice after a failure, with the same number.
    """
    return stream.writeStream.foreachBatch(each).option(
        "checkpointLocation", checkpoint).trigger(availableNow=True).start()


def deliver_to(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write each batch to its own folder ``batch_id=n``; a repeated batch replaces itself."""
    def each(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return deliver(stream, each, checkpoint)
