"""Feature preparation: median fill, standard scale, binary codes. Fit on train, apply anywhere."""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil, log2

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.ordering import row_index
from tidemark.operators.quantile import exact_medians
from tidemark.schema import DEFAULT_CATEGORICAL, DEFAULT_NUMERIC
from tidemark.session import join_on, named, scratch_path, small_or_not, stage


def fit_numeric(train: DataFrame, columns, by=()) -> DataFrame:
    """(by..., column, median, mean, std) per numeric column, in long form.

    Mean and population std are those of the filled column. They follow from the moments of the
    non-null values and the number of nulls, so the fill itself is never carried out here.
    """
    keys = [named(k) for k in by]
    moments = train.groupBy(*keys).agg(
        *[F.count(named(c)).alias(f"n_{c}") for c in columns],
        F.count(F.lit(1)).alias("_rows"),
        *[F.avg(named(c).cast("double")).alias(f"avg_{c}") for c in columns],
        *[F.var_pop(named(c).cast("double")).alias(f"var_{c}") for c in columns],
    )
    moments = stage(moments, "moments")
    largest = moments.agg(F.max("_rows")).first()[0] or 0
    medians = exact_medians(train, columns, by, largest=largest).withColumnsRenamed({c: f"med_{c}" for c in columns})
    if by:
        both = join_on(moments, medians, by)
    else:
        row = medians.first()  # one row, one number per column
        both = moments.withColumns({c: F.lit(row[c]).cast("double") for c in medians.columns})

    def entry(c):
        n, avg, var, med = (named(f"{p}_{c}") for p in ("n", "avg", "var", "med"))
        filled = F.col("_rows") - n
        mean = (n * avg + filled * med) / F.col("_rows")
        spread = n * (var + (avg - mean) * (avg - mean)) + filled * (med - mean) * (med - mean)
        std = F.sqrt(spread / F.col("_rows"))
        # A constant column scales by 1; rounding noise far below the values counts as constant.
        std = F.when(std <= F.abs(mean) * 1e-12, 1.0).otherwise(std)
        return F.struct(F.lit(c).alias("column"), med.alias("median"), mean.alias("mean"), std.alias("std"))

    return both.select(*keys, F.inline(F.array(*[entry(c) for c in columns])))


def fit_categories(train: DataFrame, columns, order, by=()) -> DataFrame:
    """(by..., column, category, code): codes 1..k in order of first appearance.

    Rows are reduced to one per category before anything is ordered.
    """
    keys = [named(k) for k in by]
    at = named(order[0]) if len(order) == 1 else F.struct(*[named(o) for o in order])
    seen = train.select(*keys, at.alias("_at"), F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), named(c).cast("string").alias("category")) for c in columns
    ])))
    first = seen.where(F.col("category").isNotNull()).groupBy(*keys, "column", "category").agg(F.min("_at").alias("_first"))
    coded = row_index(stage(first, "categories"), [*by, "column"], ["_first", "category"], "code")
    return coded.withColumn("code", F.col("code") + 1).drop("_first")


@dataclass(frozen=True)
class Preparation:
    """Fitted statistics as two small tables; `bits` is the code width per categorical column."""

    numeric: DataFrame
    codes: DataFrame | None
    numeric_columns: list[str]
    categorical_columns: list[str]
    bits: dict[str, int]
    by: tuple[str, ...] = ()

    @property
    def feature_names(self) -> list[str]:
        coded = [f"{c}_{i}" for c in self.categorical_columns for i in range(self.bits[c])]
        return [*self.numeric_columns, *coded]

    def apply(self, df: DataFrame) -> DataFrame:
        """Numeric block, code bits, then the columns that were not prepared, in that order.

        Unseen and null categories get the all-zero code. A missing input column raises.
        """
        prepared = {*self.numeric_columns, *self.categorical_columns}
        rest = [c for c in df.columns if c not in prepared]
        scaled_df = self._with_statistics(df)
        for c in self.categorical_columns:
            codes = self.codes.where(F.col("column") == c).drop("column").withColumnRenamed("code", f"_code_{c}")
            codes = codes.withColumnRenamed("category", "_category")
            keyed = scaled_df.withColumn("_category", named(c).cast("string"))
            scaled_df = join_on(keyed, small_or_not(codes), [*self.by, "_category"], "left").drop("_category")

        numeric = [
            ((F.coalesce(named(c).cast("double"), self._stat(c, "median")) - self._stat(c, "mean"))
             / self._stat(c, "std")).alias(c)
            for c in self.numeric_columns
        ]
        coded = [
            F.shiftright(F.coalesce(named(f"_code_{c}"), F.lit(0).cast("long")), self.bits[c] - 1 - i)
            .bitwiseAND(F.lit(1)).cast("int").alias(f"{c}_{i}")
            for c in self.categorical_columns for i in range(self.bits[c])
        ]
        return scaled_df.select(*numeric, *coded, *[named(c) for c in rest])

    def _stat(self, c, which):
        return named("_stats")[c][which]

    def _with_statistics(self, df: DataFrame) -> DataFrame:
        """`_stats`: column -> (median, mean, std). Literals for a global fit, a keyed join otherwise."""
        if not self.numeric_columns:
            return df
        entry = F.struct("median", "mean", "std")
        if self.by:
            wide = self.numeric.groupBy(*self.by).pivot("column", self.numeric_columns).agg(F.first(entry))
            packed = wide.select(*[named(k) for k in self.by], F.struct(*[named(c) for c in self.numeric_columns]).alias("_stats"))
            return join_on(df, small_or_not(stage(packed, "stats")), self.by, "left")
        rows = {r["column"]: r for r in self.numeric.collect()}  # one row per feature column
        literal = lambda c: F.struct(*[F.lit(rows[c][s]).cast("double").alias(s) for s in ("median", "mean", "std")]).alias(c)
        return df.withColumn("_stats", F.struct(*[literal(c) for c in self.numeric_columns]))

    def save(self, path: str) -> None:
        self.numeric.write.mode("overwrite").parquet(f"{path}/numeric")
        if self.codes is not None:
            self.codes.write.mode("overwrite").parquet(f"{path}/codes")
        self._save_layout(path)

    def _save_layout(self, path: str) -> None:
        by = F.array(*[F.lit(k) for k in self.by]).cast("array<string>").alias("by")
        layout = F.array(*[
            F.struct(F.lit(i).alias("position"), F.lit(c).alias("column"), F.lit(self.bits.get(c)).cast("int").alias("bits"), by)
            for i, c in enumerate([*self.numeric_columns, *self.categorical_columns])
        ])
        spark = self.numeric.sparkSession
        spark.range(1).coalesce(1).select(F.inline(layout)).write.mode("overwrite").parquet(f"{path}/layout")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "Preparation":
        layout = sorted(spark.read.parquet(f"{path}/layout").collect(), key=lambda r: r.position)
        numeric = [r["column"] for r in layout if r.bits is None]
        categorical = [r["column"] for r in layout if r.bits is not None]
        return cls(
            spark.read.parquet(f"{path}/numeric"),
            spark.read.parquet(f"{path}/codes") if categorical else None,
            numeric, categorical, {r["column"]: r.bits for r in layout if r.bits is not None},
            tuple(layout[0].by) if layout else (),
        )


def fit(
    train: DataFrame, numeric=DEFAULT_NUMERIC, categorical=DEFAULT_CATEGORICAL, order=("dt",), by=(), path: str | None = None
) -> Preparation:
    """Fit on the train rows only and keep the result under `path` (scratch when not given)."""
    spark = train.sparkSession
    path = path or scratch_path(spark, "preparation")
    none = "column string, median double, mean double, std double"
    numbers = stage(fit_numeric(train, numeric, by) if numeric else spark.createDataFrame([], none), path=f"{path}/numeric")
    codes, bits = None, {}
    if categorical:
        codes = stage(fit_categories(train, categorical, order, by), path=f"{path}/codes")
        widest = {r["column"]: r.k for r in codes.groupBy("column").agg(F.max("code").alias("k")).collect()}
        bits = {c: max(1, ceil(log2(widest.get(c, 0) + 1))) for c in categorical}
    fitted = Preparation(numbers, codes, list(numeric), list(categorical), bits, tuple(by))
    fitted._save_layout(path)
    return fitted
