"""Layer tables as partitioned Parquet with keyed upserts."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schema import BAR_KEY
from tidemark.session import file_system, join_on, named, path_exists, scratch_scope, stage

_PERIOD = "period"
_NO_PERIOD = "none"  # holds a file without rows, for the schema of a table that began empty


def read_layer(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A missing path raises; the session stays up."""
    return spark.read.format(fmt).load(path)


class DuplicateKeys(ValueError):
    """The source of an upsert holds a key twice, or a null in a key."""


@dataclass(frozen=True)
class KeyedTable:
    """A table with a unique key, cut into period folders so that an upsert rewrites only what it touches.

    `period` is a SQL expression whose values make plain folder names (digits, letters, dashes);
    all rows of one key lie in one period.
    """

    path: str
    keys: list[str] = field(default_factory=lambda: list(BAR_KEY))
    period: str = "date_format(dt, 'yyyy')"

    def exists(self, spark: SparkSession) -> bool:
        """Whether a write was committed; what a failed first write left behind does not count."""
        return path_exists(spark, f"{self.path}/_SUCCESS") or path_exists(spark, f"{self._empty}/_SUCCESS")

    @property
    def _empty(self) -> str:
        return f"{self.path}/{_PERIOD}={_NO_PERIOD}"

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path).drop(_PERIOD)

    def _read_periods(self, spark: SparkSession, wanted) -> DataFrame:
        """Rows of the stored periods for which `wanted(period)`; only their folders are listed."""
        at, fs = file_system(spark, self.path)
        prefix = f"{_PERIOD}="
        names = [s.getPath().getName() for s in fs.listStatus(at) if s.isDirectory()]
        folders = [f"{self.path}/{n}" for n in sorted(names) if n.startswith(prefix) and wanted(n[len(prefix):])]
        if not folders:
            return self.read(spark).limit(0)
        return spark.read.option("basePath", self.path).parquet(*folders).drop(_PERIOD)

    def since(self, spark: SparkSession, day) -> DataFrame:
        """Rows with `dt` on or after `day`, or all for None. Earlier folders are not looked into;
        this asks for periods that follow from `dt` and sort as it does."""
        if day is None:
            return self.read(spark)
        first = spark.range(1).select(F.lit(day).cast("date").alias("dt")).select(F.expr(self.period)).first()[0]
        return self._read_periods(spark, lambda period: period >= first).where(F.col("dt") >= F.lit(day).cast("date"))

    def spans(self, spark: SparkSession, spans):
        """(test of a period, condition on rows) for spans (first day or None, last day or None); periods as for `since`."""
        days = [f"({i}, {j}, DATE'{day}')" for i, span in enumerate(spans) for j, day in enumerate(span) if day is not None]
        # a query on literals, which the driver answers without a job
        named_periods = spark.sql(f"SELECT i, j, CAST({self.period} AS STRING) AS period FROM VALUES {', '.join(days)} AS t(i, j, dt)")
        periods = {(r.i, r.j): r.period for r in named_periods.collect()}
        edges = [(periods.get((i, 0)), periods.get((i, 1))) for i in range(len(spans))]
        inside = F.lit(False)
        for first, last in spans:
            after = F.lit(True) if first is None else F.col("dt") >= F.lit(first).cast("date")
            before = F.lit(True) if last is None else F.col("dt") <= F.lit(last).cast("date")
            inside = inside | (after & before)
        return lambda period: any((a is None or period >= a) and (b is None or period <= b) for a, b in edges), inside

    def between(self, spark: SparkSession, spans) -> DataFrame:
        """Rows with `dt` in one of the spans, or all for None; folders outside of them are not looked into."""
        if spans is None:
            return self.read(spark)
        wanted, inside = self.spans(spark, spans)
        return self._read_periods(spark, wanted).where(inside)

    def _write(self, df: DataFrame, mode: str, overwrite: str = "dynamic") -> None:
        # The rebalance hint lets AQE split a period that holds most rows and merge tiny ones.
        (
            df.hint("rebalance", _PERIOD)
            .sortWithinPartitions(_PERIOD, *self.keys)
            .write.mode(mode)
            .option("partitionOverwriteMode", overwrite)
            .partitionBy(_PERIOD)
            .parquet(self.path)
        )

    def _with_period(self, df: DataFrame) -> DataFrame:
        return df.withColumn(_PERIOD, F.expr(self.period).cast("string"))

    def _checked_periods(self, source: DataFrame) -> list[str]:
        """Periods of the source, after its keys are found to be unique and not null. One job."""
        null_key = F.lit(False)
        for k in self.keys:
            null_key = null_key | named(k).isNull()
        row = (
            source.groupBy(*[named(k) for k in self.keys], _PERIOD)
            .agg(F.count(F.lit(1)).alias("n"))
            .agg(F.max("n"), F.bool_or(null_key), F.collect_set(_PERIOD))
            .first()
        )
        if (row[0] or 0) > 1 or row[1]:
            raise DuplicateKeys(f"source keys {self.keys} must be unique and not null")
        return row[2]

    def upsert(self, source: DataFrame, staged: bool = False) -> list[str]:
        """Matched keys are replaced, new keys inserted; the same call again changes nothing. Returns the periods touched.

        Creates the table when, and only when, it is missing. Rewrites the periods of the source:
        the new files go to a staging folder of the write and replace the old ones at commit, so
        the old rows stay readable until then and a lost task is simply run again. The source is
        staged first, unless it is a stored table already, so that it is computed once.
        """
        spark = source.sparkSession
        with scratch_scope(spark):
            source = self._with_period(source if staged else stage(source, "upsert"))
            periods = self._checked_periods(source)
            if not self.exists(spark) and periods:
                self._write(source, "overwrite", "static")
            elif not self.exists(spark):
                source.drop(_PERIOD).limit(0).write.mode("overwrite").parquet(self._empty)
            elif periods:
                touched = self._read_periods(spark, set(periods).__contains__)
                kept = join_on(touched, source.select(*self.keys), self.keys, "left_anti", null_safe=False)
                self._write(self._with_period(kept).unionByName(source), "overwrite")
        return periods

    def take(self, source: DataFrame, batch_id: int, staged: bool = False) -> None:
        """`upsert` of a micro-batch."""
        self.upsert(source, staged)

    def append(self, df: DataFrame) -> None:
        """Plain append; rows double when the same rows are appended twice."""
        self._write(self._with_period(df), "append")


def write_splits(df: DataFrame, path: str, split: str = "split") -> None:
    """One write for all splits; a reader of one split lists only its folder."""
    df.hint("rebalance", split).write.mode("overwrite").partitionBy(split).parquet(path)
