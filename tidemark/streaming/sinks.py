"""Sinks for `foreachBatch`; each gives the same result when a micro-batch is run again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from tidemark.sinks.log import AppendedTable
from tidemark.sinks.store import KeyedTable
from tidemark.sources.messages import bad_records, decode_messages, good_records

Handler = Callable[[DataFrame, int], None]
COMPACT_EVERY = 100  # micro-batches


def batch_folder(path: str, batch_id: int) -> str:
    return f"{path}/batch_id={batch_id}"


def append_sink(path: str) -> Handler:
    """One folder per micro-batch, replaced when that micro-batch runs again."""
    return lambda batch, batch_id: batch.write.mode("overwrite").parquet(batch_folder(path, batch_id))


def upsert_sink(table: KeyedTable | AppendedTable, compact_every: int = COMPACT_EVERY) -> Handler:
    """Upserts by key; an `AppendedTable` takes the rows as they come and is compacted every so many micro-batches."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        table.take(batch, batch_id)
        if isinstance(table, AppendedTable):
            table.compact(batch.sparkSession, compact_every)

    return handle


def fan_out(*sinks: Handler) -> Handler:
    """The same micro-batch to every consumer, computed once; nothing is done without consumers."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        if not sinks:
            return
        batch = batch.persist()
        try:
            for sink in sinks:
                sink(batch, batch_id)
        finally:
            batch.unpersist()

    return handle


def decode_sink(good: Handler, bad: Handler) -> Handler:
    """Messages decoded; bad ones go to their own sink and the stream goes on."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        decoded = decode_messages(batch).persist()
        try:
            good(good_records(decoded), batch_id)
            bad(bad_records(decoded), batch_id)
        finally:
            decoded.unpersist()

    return handle
