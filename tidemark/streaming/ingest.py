"""Streams of ticks and messages: reading, bars, deduplication, triggers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scalar import midnight_millis
from tidemark.operators.bars import build_bars
from tidemark.schema import POLL_SECONDS, SILVER


def file_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet", files_per_batch: int | None = None) -> DataFrame:
    """A stream over a landing folder. The last letter is globbed so that `path` may also be one file."""
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    path = path.rstrip("/")
    return reader.load(f"{path[:-1]}[{path[-1]}]")


def with_event_time(df: DataFrame, ts: str, delay: str) -> DataFrame:
    """Watermark on `ts`; a zone-less clock is read as session time first."""
    if dict(df.dtypes)[ts] == "timestamp_ntz":
        df = df.withColumn(ts, F.col(ts).cast("timestamp"))
    return df.withWatermark(ts, delay)


def drop_repeats(stream: DataFrame, keys) -> DataFrame:
    """A bar that is polled again within the watermark is dropped; its event time is what counts."""
    return stream.dropDuplicatesWithinWatermark(list(keys))


def stream_bars(
    ticks: DataFrame, series: str, ts: str, price: str, width: str, delay: str, tie: str | None = None, volume: str | None = None
) -> DataFrame:
    """Bars as a stream. Run in update mode into a keyed table: append mode would hold back the
    windows newer than the last watermark. `delay` must cover how late a tick may come."""
    return build_bars(with_event_time(ticks, ts, delay), series, ts, price, width, tie, volume)


def bars_to_silver(bars: DataFrame) -> DataFrame:
    """Intraday bars in the silver schema: the day of the bar and its start in milliseconds."""
    millis = F.unix_millis("ts")
    columns = {"dt": F.to_date("ts"), "timestamp_in_ms": millis}
    return bars.select(*[
        columns.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in SILVER.fields
    ])


def daily_stream_to_silver(bars: DataFrame) -> DataFrame:
    """Bars one day wide in the silver schema, stamped with the midnight of their day."""
    return bars_to_silver(bars).withColumn("timestamp_in_ms", midnight_millis(F.col("dt")))


def start(stream: DataFrame, handle, checkpoint: str, mode: str = "update", once: bool = True, seconds: int = POLL_SECONDS):
    """Run `handle(batch, batch_id)` per micro-batch: over what is there now, or every `seconds`."""
    writer = stream.writeStream.outputMode(mode).foreachBatch(handle).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if once else {"processingTime": f"{seconds} seconds"}
    return writer.trigger(**trigger).start()


def run_once(stream: DataFrame, handle, checkpoint: str, mode: str = "update") -> None:
    start(stream, handle, checkpoint, mode).awaitTermination()
