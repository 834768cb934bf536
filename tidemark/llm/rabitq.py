"""Nearest neighbours by cosine from randomly rotated one-bit codes, with exact reranking.

Vectors are scaled to length one, shifted by the mean vector of all of them, scaled again and
turned by a random rotation; only the signs are kept, packed to bits, with two scalars: the length
of the shifted vector, and its inner product with the sign vector (the correction). For a
query q and a vector o, <o, q> is estimated from the signs; the error is below
`epsilon * sqrt((1 - c^2) / c^2 / (d - 1))` of the shifted lengths, c the correction, but for a
chance that falls off as a Gaussian tail in `epsilon`. Every code is scored against every query
of the stated set, in blocks. In a block, the k vectors with the largest estimates are reranked
first; then every vector whose upper bound reaches the k-th of their exact scores, as no other can
be among the k nearest. Only the best of a block leave it.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import named, ship_with_tasks, stage

EPSILON = 4.0
CODE_BLOCK, QUERY_BLOCK = 8192, 2048
SEED = 7


def rotation(d: int, seed: int = SEED) -> np.ndarray:
    """A uniformly random rotation (or reflection) of d dimensions."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, d)))
    return q * np.sign(np.diag(r))


def usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(key, x): vectors as doubles, without null, empty and zero ones and those with null or non-finite parts."""
    x = F.col("x")
    whole = ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    rows = df.select(named(key).alias("key"), named(vector).cast("array<double>").alias("x"))
    # `whole` comes first: the others have a value only for vectors without nulls
    return rows.where(x.isNotNull() & (F.size(x) > 0) & F.coalesce(whole, F.lit(False)) & F.exists(x, lambda v: v != 0))


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)  # keeps squares of very large or small parts finite
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def codes(shifted: np.ndarray, turned: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed signs, lengths and corrections of shifted vectors."""
    length = np.linalg.norm(shifted, axis=1)
    out = (shifted @ turned) / np.where(length > 0, length, 1)[:, None]
    signs = out > 0
    correction = np.abs(out).sum(1) / np.sqrt(shifted.shape[1])
    return np.packbits(signs, axis=1), length, correction


def estimates(bits: np.ndarray, correction: np.ndarray, query: np.ndarray, epsilon: float) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products of unit vectors with rotated unit queries (queries x codes), and error bounds per code."""
    d = query.shape[1]
    signs = np.unpackbits(bits, axis=1, count=d).astype(np.float32) * 2 - 1
    c = np.where(correction > 0, correction, 1)
    found = (query.astype(np.float32) @ signs.T) / np.sqrt(d) / c
    bound = epsilon * np.sqrt(np.maximum(1 - c * c, 0) / (c * c) / max(d - 1, 1))
    return found, bound


def nearest(
    vectors: DataFrame, queries: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 5, epsilon: float = EPSILON
) -> DataFrame:
    """(query_id, rank, key, score): the k nearest vectors of each query by cosine, its own key left out.

    Scores are exact, in double precision; ties go to the smaller key. Null, zero and non-finite
    vectors take no part. A query is compared with the vectors of its own dimension; every dimension
    that occurs has a mean, a rotation and codes of its own, and a pass. Fewer
    candidates than k give fewer rows. Keys should be unique; rows that repeat a key are kept
    and told apart by nothing but their vectors.
    """
    base, asked = usable(vectors, key, vector), usable(queries, key, vector)
    dimensions = [r.d for r in asked.select(F.size("x").alias("d")).distinct().orderBy("d").collect()]
    if not dimensions:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, key long, score double").withColumnRenamed("key", key)
    of_size = lambda df, d: df.where(F.size("x") == d)
    found = [_nearest_of(of_size(base, d), of_size(asked, d), key, d, k, epsilon) for d in dimensions]
    return reduce(DataFrame.unionByName, found)


def _nearest_of(base: DataFrame, asked: DataFrame, key: str, d: int, k: int, epsilon: float) -> DataFrame:
    """`nearest` of usable vectors (key, x) that all have `d` dimensions."""
    asked = stage(asked, "queries")
    # of equal vectors, only the k + 1 smallest keys can be among the k nearest of any query
    equal = Window.partitionBy("x").orderBy("key")
    base = base.withColumn("_n", F.row_number().over(equal)).where(F.col("_n") <= k + 1).drop("_n")
    base = stage(base, "vectors")

    def sums(batches):
        total, n = np.zeros(d), 0
        for batch in batches:
            x = unit(batch.column(0).flatten().to_numpy().reshape(-1, d))
            total, n = total + x.sum(0), n + len(x)
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([total.tolist()], pa.list_(pa.float64()))], ["n", "total"])

    parts = base.select("x").mapInArrow(sums, "n long, total array<double>")
    row = parts.agg(F.sum("n"), *[F.sum(F.element_at("total", i + 1)) for i in range(d)]).first()
    mean = np.array(row[1:]) / max(row[0], 1)
    turned = rotation(d)

    def encode(batches):
        for batch in batches:
            x = unit(batch.column(1).flatten().to_numpy().reshape(-1, d))
            bits, length, correction = codes(x - mean, turned)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([b.tobytes() for b in bits], pa.binary()), pa.array(length), pa.array(correction), pa.array((x - mean) @ mean)],
                ["key", "x", "bits", "length", "correction", "shift"],
            )

    coded = stage(base.mapInArrow(encode, "key long, x array<double>, bits binary, length double, correction double, shift double"), "codes")
    n_codes, n_queries = coded.count(), asked.count()
    code_blocks, query_blocks = n_codes // CODE_BLOCK + 1, n_queries // QUERY_BLOCK + 1
    left = coded.withColumn("side", F.lit(0)).withColumn("code_block", F.pmod(F.xxhash64("key"), F.lit(code_blocks)))
    left = left.withColumn("query_block", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    right = asked.withColumn("side", F.lit(1)).withColumn("query_block", F.pmod(F.xxhash64("key"), F.lit(query_blocks)).cast("int"))
    right = right.withColumn("code_block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(code_blocks - 1).cast("long"))))

    def scan(group: pd.DataFrame) -> pd.DataFrame:
        code, query = group[group["side"] == 0], group[group["side"] == 1]
        out = [np.empty((2, 0), np.int64)]
        if len(code) and len(query):
            bits = np.frombuffer(b"".join(code["bits"]), np.uint8).reshape(len(code), -1)
            length, shift, correction = (code[c].to_numpy() for c in ("length", "shift", "correction"))
            ids, vectors = code["key"].to_numpy(), unit(np.stack(code["x"].to_numpy()))
        for first in range(0, len(query) if len(code) else 0, 128):
            some = query.iloc[first:first + 128]
            x, names = unit(np.stack(some["x"].to_numpy())), some["key"].to_numpy()
            away = x - mean
            far = np.linalg.norm(away, axis=1)
            found, bound = estimates(bits, correction, (away @ turned) / np.where(far > 0, far, 1)[:, None], epsilon)
            # <o, q> = <o - m, q - m> + <o - m, m> + <m, q>
            scale = far[:, None] * length[None, :]
            middle = found * scale + shift[None, :] + (x @ mean)[:, None]
            own = names[:, None] == ids[None, :]
            middle[own] = -np.inf
            floor = np.full(len(some), -np.inf)
            if len(ids) > k:
                top = np.argpartition(middle, len(ids) - k - 1, axis=1)[:, len(ids) - k - 1:]
                exact = np.einsum("qkd,qd->qk", vectors[top], x)
                exact[np.take_along_axis(own, top, 1)] = -np.inf
                floor = np.partition(exact, 1, axis=1)[:, 1]  # the k-th of the k + 1 reranked
            at, which = np.nonzero((middle + bound[None, :] * scale + 1e-5 >= floor[:, None]) & ~own)
            score = np.concatenate([np.einsum("ij,ij->i", vectors[which[i:i + 65536]], x[at[i:i + 65536]]) for i in range(0, len(at), 65536)] or [np.empty(0)])
            order = np.lexsort((-score, at))
            at, which, score = at[order], which[order], score[order]
            begins = np.flatnonzero(np.diff(at, prepend=-1))
            sizes = np.diff(np.append(begins, len(at)))
            kth = score[begins + np.minimum(sizes, k) - 1]
            # what rounding may have put out of order stays; the scores are taken again below
            best = score >= np.repeat(kth, sizes) - 1e-12
            out.append(np.stack([names[at[best]], ids[which[best]]]))
        found = np.concatenate(out, 1)
        return pd.DataFrame({"query_id": found[0], "key": found[1]})

    blocks = left.select("side", "code_block", "query_block", "key", "bits", "length", "correction", "shift", "x").unionByName(
        right.select("side", "code_block", "query_block", "key", "x"), allowMissingColumns=True
    )
    close = stage(blocks.groupBy("code_block", "query_block").applyInPandas(scan, "query_id long, key long").distinct(), "close")
    pairs = close.join(base.select("key", "x"), "key").join(asked.select(F.col("key").alias("query_id"), F.col("x").alias("y")), "query_id")

    def dot(a: str, b: str):
        return F.aggregate(F.zip_with(a, b, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)

    scored = pairs.select("query_id", "key", (dot("x", "y") / (F.sqrt(dot("x", "x")) * F.sqrt(dot("y", "y")))).alias("score"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "key")
    ranked = scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("key").alias(key), "score")


ship_with_tasks(__name__)
