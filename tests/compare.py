"""Compare a Spark result with a DuckDB result: names, row count, and values in any row order."""

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def open_tables(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(r[i] for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((v is not None, str(v)) for v in r))


def _same(a, b):
    return type(a) is type(b) and repr(a) == repr(b)


_TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE"}


def type_differences(spark_df, con, sql: str):
    theirs = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    return [(n, t, theirs[n]) for n, t in spark_df.dtypes if _TYPES.get(t, t) != theirs[n]]


def differences(spark_df, con, sql: str, shown: int = 3):
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(spark_df.columns):
        return [f"columns {sorted(spark_df.columns)} against {sorted(names)}"]
    ours = _rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    theirs = _rows(names, result.fetchall())
    if len(ours) != len(theirs):
        return [f"{len(ours)} rows against {len(theirs)}"]
    return [(a, b) for a, b in zip(ours, theirs) if not all(map(_same, a, b))][:shown]
