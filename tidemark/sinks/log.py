"""A keyed table for streams: micro-batches append, readers take the newest row of a key, compaction is a job of its own."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.bars import newest
from tidemark.schema import BAR_KEY
from tidemark.session import delete_folder, file_system, join_on, scratch_scope, small_or_not, stage
from tidemark.sinks.store import KeyedTable

_SEQUENCE, _OF, _PERIOD = "_seq", "_of", "period"


@dataclass(frozen=True)
class AppendedTable:
    """A table with a unique key whose upserts write the new rows and nothing else.

    `log` has one folder per write, numbered in order and named by the write, each cut into the periods of its
    rows; `base` is a `KeyedTable` of what was compacted. A write that runs again (the newest one of its stream) replaces its
    own folder. Of a key in several writes the newest counts, whatever its columns hold. A reader
    resolves keys only in the periods that the log touches; base rows of all others are read as they are.
    """

    path: str
    keys: list[str] = field(default_factory=lambda: list(BAR_KEY))
    period: str = "date_format(dt, 'yyyy')"

    @property
    def base(self) -> KeyedTable:
        return KeyedTable(f"{self.path}/base", self.keys, self.period)

    @property
    def log(self) -> str:
        return f"{self.path}/log"

    def writes(self, spark: SparkSession) -> dict[int, str]:
        """Number and name of the finished writes that are not compacted yet."""
        at, fs = file_system(spark, f"{self.log}/{_SEQUENCE}=*/{_OF}=*/_SUCCESS")
        found = [s.getPath().getParent() for s in fs.globStatus(at) or []]
        return {int(p.getParent().getName().split("=", 1)[1]): p.getName().split("=", 1)[1] for p in found}

    def exists(self, spark: SparkSession) -> bool:
        return self.base.exists(spark) or bool(self.writes(spark))

    def take(self, source: DataFrame, batch_id: int, stream: str = "stream", staged: bool = False) -> None:
        """Upsert the rows of a micro-batch: one write of these rows. Repeated or null keys raise.

        `stream` tells streams into one table apart; a stream that begins anew with another checkpoint
        takes another name.
        """
        spark, name = source.sparkSession, f"{stream}.{batch_id}"
        with scratch_scope(spark):
            source = self.base._with_period(source if staged else stage(source, "append"))
            if not self.base._checked_periods(source):
                if not self.exists(spark):
                    self.base.upsert(source.drop(_PERIOD))
                return
            done = self.writes(spark)
            own = [n for n, of in done.items() if of.rsplit(".", 1)[0] == stream]
            again = own and done[max(own)] == name
            number = max(own) if again else max(done, default=self._compacted(spark)) + 1
            (
                source.hint("rebalance", _PERIOD).sortWithinPartitions(_PERIOD, *self.keys)
                .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(_PERIOD)
                .parquet(f"{self.log}/{_SEQUENCE}={number}/{_OF}={name}")
            )

    def read(self, spark: SparkSession) -> DataFrame:
        return self._newest(spark, lambda period: True)

    def since(self, spark: SparkSession, day) -> DataFrame:
        """Rows with `dt` on or after `day`, or all for None; earlier folders are not looked into."""
        return self.between(spark, None if day is None else [(day, None)])

    def between(self, spark: SparkSession, spans) -> DataFrame:
        """Rows with `dt` in one of the spans (first day, last day or None), or all for None."""
        if spans is None:
            return self.read(spark)
        wanted, inside = self.base.spans(spark, spans)
        return self._newest(spark, wanted, inside)

    def _newest(self, spark: SparkSession, wanted: Callable[[str], bool], inside=None) -> DataFrame:
        at, fs = file_system(spark, f"{self.log}/{_SEQUENCE}=*/{_OF}=*/{_PERIOD}=*")
        done, folders, touched = self.writes(spark), [], set()
        for status in fs.globStatus(at) or []:
            path = status.getPath()
            period, number = path.getName().split("=", 1)[1], path.getParent().getParent().getName().split("=", 1)[1]
            if int(number) in done and wanted(period):
                folders.append(path.toString())
                touched.add(period)
        keep = (lambda df: df.where(inside)) if inside is not None else (lambda df: df)
        based = self.base.exists(spark)
        if not folders:
            return keep(self.base._read_periods(spark, wanted)) if based else self._nothing(spark, done)
        log = spark.read.option("basePath", self.log).parquet(*folders).drop(_OF, _PERIOD)
        if len({f.split(f"{_SEQUENCE}=")[1].split("/")[0] for f in folders}) > 1:
            log = newest(log, self.keys, _SEQUENCE)
        log = keep(log.drop(_SEQUENCE))
        if not based:
            return log
        written = small_or_not(log.select(*self.keys))
        open_ = keep(self.base._read_periods(spark, touched.__contains__))
        open_ = join_on(open_, written, self.keys, "left_anti", null_safe=False)
        closed = keep(self.base._read_periods(spark, lambda period: wanted(period) and period not in touched))
        return closed.unionByName(open_).unionByName(log.select(*closed.columns))

    def _nothing(self, spark: SparkSession, done) -> DataFrame:
        """No rows, with the columns of the table; a missing table raises."""
        one = next(iter(done), None)
        path = self.base.path if one is None else f"{self.log}/{_SEQUENCE}={one}/{_OF}={done[one]}"
        return spark.read.parquet(path).drop(_PERIOD).limit(0)

    def _marker(self) -> str:
        return f"{self.path}/compacted"

    def _compacted(self, spark: SparkSession) -> int:
        """Number of the last compacted write; numbers go on from it, so that order holds."""
        at, fs = file_system(spark, f"{self._marker()}/upto=*")
        return max([int(s.getPath().getName().split("=", 1)[1]) for s in fs.globStatus(at) or []], default=0)

    def compact(self, spark: SparkSession, least: int = 1) -> int:
        """Move what is written so far into the base, when there are at least `least` writes; how many there were.

        Rewrites the periods that the log touches, once for all its writes. Run it between micro-batches. When it
        fails half-way the log still holds the newest rows, and the next run does the same again.
        """
        done = self.writes(spark)
        if len(done) < max(1, least):
            return 0
        with scratch_scope(spark):
            folders = [f"{self.log}/{_SEQUENCE}={n}/{_OF}={of}" for n, of in done.items()]
            log = spark.read.option("basePath", self.log).parquet(*folders).drop(_OF, _PERIOD)
            self.base.upsert(newest(log, self.keys, _SEQUENCE).drop(_SEQUENCE))
        before = self._compacted(spark)
        at, fs = file_system(spark, f"{self._marker()}/upto={max(done)}")
        fs.mkdirs(at)
        if before and before != max(done):
            delete_folder(spark, f"{self._marker()}/upto={before}")
        for n in done:  # one folder per write since the last compaction
            delete_folder(spark, f"{self.log}/{_SEQUENCE}={n}")
        return len(done)
