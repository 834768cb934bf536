"""The batch flow: landed payloads to silver to gold, each layer written once and read back."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.gold import affected_gold, gold_features
from tidemark.operators.silver import accepted, rejected, type_bars
from tidemark.session import scratch_scope, stage
from tidemark.sinks.landing import land_payloads
from tidemark.sinks.store import KeyedTable
from tidemark.sources.payload import explode_payloads, newest_landing, read_payloads


@dataclass(frozen=True)
class Lakehouse:
    """Folders of one lakehouse, all series together."""

    root: str

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze"

    @property
    def silver(self) -> KeyedTable:
        return KeyedTable(f"{self.root}/silver")

    @property
    def gold(self) -> KeyedTable:
        return KeyedTable(f"{self.root}/gold")

    @property
    def quarantine(self) -> str:
        return f"{self.root}/quarantine"


def run_lakehouse(
    spark: SparkSession, lake: Lakehouse, payloads: DataFrame | None = None, run_id: str | None = None
) -> DataFrame:
    """Bring silver and gold up to date.

    With `payloads` these are landed, and only they are parsed. Without, both layers follow from
    all that is landed. Of a date in several payloads the newest landing counts. Rejects go to a
    quarantine folder of the run, named by `run_id` (by default, the time); a run with the same
    name replaces its own.
    """
    run_id = run_id or datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S%f")
    with scratch_scope(spark):
        if payloads is not None:
            payloads = stage(payloads.select("series", "dt", "value"), "payloads")
            land_payloads(payloads, lake.bronze)
            entries = newest_landing(explode_payloads(payloads, ["dt"]), "dt")
        else:
            entries = newest_landing(explode_payloads(read_payloads(spark, lake.bronze), ["dt"]), "dt")
        typed = stage(type_bars(entries), "typed")
        bars = accepted(typed)
        rejected(typed).write.mode("overwrite").parquet(f"{lake.quarantine}/run={run_id}")
        lake.silver.upsert(bars, staged=True)
        if payloads is not None and lake.gold.exists(spark):
            lake.gold.upsert(affected_gold(lambda spans: lake.silver.between(spark, spans), bars, unique_days=True))
        else:
            lake.gold.upsert(gold_features(lake.silver.read(spark)))
    return lake.gold.read(spark)
