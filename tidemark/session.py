"""What the jobs ask of the session they are handed: scratch space, staging, null-safe joins."""

from __future__ import annotations

import atexit
import shutil
import sys
import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows of one group that a single task may sort and window (they spill to disk, not to memory).
# Above it the operators split the group by row range. A DATE column has 3,652,059 distinct
# values (years 1 to 9999), so a group keyed by (series, dt) is always below it.
TASK_ROWS = 5_000_000
DATE_DOMAIN_ROWS = 3_652_059
BROADCAST_BYTES = 16 << 20


def ship_with_tasks(module: str) -> None:
    """Send the functions of a module to Python workers by value, so executors need no copy of it."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


_local_roots: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: `spark.checkpoint.dir` of the session.

    Only a local session may go without; it gets a folder of its own, deleted when Python ends.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _local_roots:
        _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="tidemark-")
        atexit.register(shutil.rmtree, _local_roots[context.applicationId], True)
    return _local_roots[context.applicationId]


def file_system(spark: SparkSession, path: str):
    """Hadoop path and its file system, for questions that should not list a whole table."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    at, fs = file_system(spark, path)
    return fs.exists(at)


def delete_folder(spark: SparkSession, path: str) -> None:
    at, fs = file_system(spark, path)
    fs.delete(at, True)


_scope: ContextVar[list[str] | None] = ContextVar("scratch_scope", default=None)


def _session_scratch(spark: SparkSession) -> str:
    return f"{scratch_root(spark)}/tidemark-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    path = f"{_session_scratch(spark)}/{label}-{uuid.uuid4().hex}"
    made = _scope.get()
    if made is not None:
        made.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession):
    """Intermediate tables made inside are deleted at the end; nothing that reads them may leave."""
    made: list[str] = []
    token = _scope.set(made)
    try:
        yield
    finally:
        _scope.reset(token)
        for path in made:
            delete_folder(spark, path)


def clear_scratch(spark: SparkSession) -> None:
    """Delete all intermediate tables of this session, once its results are written."""
    delete_folder(spark, _session_scratch(spark))


def stage(df: DataFrame, label: str = "stage", path: str | None = None) -> DataFrame:
    """Write `df` once to the shared folder and read it back.

    Cuts the lineage (a lost executor re-reads files) and gives Catalyst the true size, so a
    later join broadcasts it only when it is under `spark.sql.autoBroadcastJoinThreshold`.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, label)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def named(name: str) -> Column:
    """Column by literal name, which may hold dots or blanks or start with a digit."""
    return F.col(f"`{name}`")


def join_on(left: DataFrame, right: DataFrame, keys, how: str = "inner", null_safe: bool = True) -> DataFrame:
    """Equi-join that keeps the left copy of the keys and, by default, pairs null keys too."""
    tag = uuid.uuid4().hex[:8]
    theirs = {k: f"{k}_{tag}" for k in keys}
    right = right.withColumnsRenamed(theirs)
    condition = None
    for k in keys:
        mine, other = left[f"`{k}`"], right[f"`{theirs[k]}`"]
        part = mine.eqNullSafe(other) if null_safe else mine == other
        condition = part if condition is None else condition & part
    joined = left.join(right, condition, how)
    return joined if how in ("left_anti", "left_semi") else joined.drop(*theirs.values())


def small_or_not(df: DataFrame) -> DataFrame:
    """A staged table, marked for broadcast when its files are at most `BROADCAST_BYTES`.

    For tables of one row per group, range or column, which are far smaller than what they are
    joined to; above the size the join is left to a shuffle, with AQE's skew handling.
    """
    return F.broadcast(df) if estimated_bytes(df) <= BROADCAST_BYTES else df


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of a plan; for a file scan, the size of its files."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def known_empty(df: DataFrame) -> bool:
    """Whether the optimiser already sees that a plan gives no rows, as for a read without folders; no job runs."""
    most = df._jdf.queryExecution().optimizedPlan().maxRows()
    return most.isDefined() and most.get() == 0


def group_sizes(df: DataFrame, keys) -> tuple[int, int]:
    """(rows of the largest group, rows of all): key columns only, counted before the shuffle."""
    counts = df.groupBy(*[named(k) for k in keys]).count()
    largest, total = counts.agg(F.max("count"), F.sum("count")).first()
    return largest or 0, total or 0
