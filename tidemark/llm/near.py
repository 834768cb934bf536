"""Documents whose sets of five-word shingles have a Jaccard similarity of a threshold or more.

1. Texts with the same set of shingles become one set with copies.
2. MinHash bands give buckets of sets that may be similar (32 bands of 4 values: a pair at 0.8
   shares no bucket with a chance of 5e-8).
3. Inside buckets, MinHash values are compared 16 at a time. With m of n values equal, the
   posterior of the match rate under a uniform prior is Beta(m + 1, n - m + 1); a pair is dropped
   when its chance of reaching the threshold falls below `TOLERANCE`. A bucket's surviving pairs
   leave the task as a spanning forest, so no bucket emits its pairs.
4. Connected components of these forests are clusters; within each, every pair is verified on
   the shingle sets. Large buckets and clusters are cut into blocks, and each pair of blocks is
   its own group, so no task holds a whole one.
5. Verified links are counted per set and their components are the classes.

Shingles are 64-bit hashes of five consecutive words, unchanged; a text of one to four words has
one shingle, all its words. A text without words (or null) is alone in its class.
"""

from __future__ import annotations

from fractions import Fraction
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.components import components, forest
from tidemark.llm.words import append_columns, find_words, mix, text_chunks, window_starts, windows
from tidemark.session import named, ship_with_tasks, stage

SHINGLE_WORDS = 5
THRESHOLD = 0.8
TOLERANCE = 1e-6
BANDS, BAND_ROWS = 32, 4
HASHES = BANDS * BAND_ROWS
STEP = 16
BLOCK_SETS = 2048  # most sets of one side of a group, in buckets
CLUSTER_SETS, CLUSTER_SHINGLES = 512, 1_000_000  # and in clusters
GROUP_ROWS = 50_000

_random = np.random.default_rng(5)
FLIPS = _random.integers(0, 1 << 63, HASHES, dtype=np.uint64)
FACTORS = _random.integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(words) -> tuple[np.ndarray, np.ndarray]:
    """(text number, shingle) of the distinct shingles of each text, in order."""
    hashes = words.hashes(0)
    starts = window_starts(words, SHINGLE_WORDS)
    found = windows(hashes, SHINGLE_WORDS, 0)[starts] if len(starts) else np.empty(0, np.uint64)
    text = words.text[starts]
    for n in range(1, SHINGLE_WORDS):
        short = np.flatnonzero(words.counts == n)
        if len(short):
            found = np.concatenate([found, mix(windows(hashes, n, 1)[words.firsts[short]] + np.uint64(n))])
            text = np.concatenate([text, short])
    order = np.lexsort((found, text))
    text, found = text[order], found[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (found[1:] != found[:-1])
    return text[new], found[new]


SIGNATURE = T.StructType([
    T.StructField("_k1", T.LongType()), T.StructField("_k2", T.LongType()), T.StructField("_n", T.LongType()),
    T.StructField("_bands", T.ArrayType(T.LongType())), T.StructField("_sig", T.BinaryType()),
])


def signatures(column: pa.Array) -> list[pa.Array]:
    """Digest of the shingle set, its size, band hashes and the low byte of each MinHash; nulls without words."""
    n = len(column)
    digest, size = np.zeros((2, n), np.int64), np.zeros(n, np.int64)
    bands, low = np.zeros((n, BANDS), np.int64), np.zeros((n, HASHES), np.uint8)
    for first, last, data, bounds in text_chunks(column):
        text, shingles = shingle_sets(find_words(data, bounds))
        if not len(text):
            continue
        begins = np.flatnonzero(np.diff(text, prepend=-1))
        rows = text[begins] + first
        size[rows] = np.diff(np.append(begins, len(text)))
        for k in (0, 1):
            digest[k, rows] = np.add.reduceat(mix(shingles ^ FLIPS[k]), begins).view(np.int64)
        least = np.stack([np.minimum.reduceat((shingles ^ flip) * factor, begins) for flip, factor in zip(FLIPS, FACTORS)], 1)
        least = mix(least)
        low[rows] = (least & np.uint64(255)).astype(np.uint8)
        folded = np.zeros((len(rows), BANDS), np.uint64)
        for k in range(BAND_ROWS):
            folded = mix(folded ^ least[:, k::BAND_ROWS]) + np.arange(BANDS, dtype=np.uint64)
        bands[rows] = folded.view(np.int64)
    empty = size == 0
    ends = np.arange(n + 1, dtype=np.int32) * BANDS
    lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(bands.reshape(-1)))
    packed = [None if e else row.tobytes() for e, row in zip(empty, low)]
    return [pa.array(digest[0], mask=empty), pa.array(digest[1], mask=empty), pa.array(size), lists, pa.array(packed, pa.binary())]


def least_matches(threshold: float, tolerance: float) -> list[int]:
    """For 16, 32, ... compared values: the fewest equal ones that keep a pair.

    Values are compared by one byte, so unequal ones agree with a chance of 1/256. The chance that
    Beta(m + 1, n - m + 1) exceeds p is that of at most m successes in n + 1 trials of p.
    """
    p = threshold + (1 - threshold) / 256
    out = []
    for n in range(STEP, HASHES + 1, STEP):
        chance, m = 0.0, -1
        while chance < tolerance:
            m += 1
            chance += comb(n + 1, m) * p**m * (1 - p) ** (n + 1 - m)
        out.append(m)
    return out


def surviving(sig: np.ndarray, left: np.ndarray, right: np.ndarray, least: list[int]) -> np.ndarray:
    """Numbers of the pairs that are never dropped."""
    alive, matches = np.arange(len(left)), np.zeros(len(left), np.int32)
    for k, needed in enumerate(least):
        part = sig[:, k * STEP:(k + 1) * STEP]
        matches += (part[left[alive]] == part[right[alive]]).sum(1, dtype=np.int32)
        stay = matches >= needed
        alive, matches = alive[stay], matches[stay]
        if not len(alive):
            break
    return alive


def bucket_forest(sig: np.ndarray, groups: np.ndarray, halves: np.ndarray, split: np.ndarray, least: list[int]) -> np.ndarray:
    """Label of each row (a row number), equal where surviving pairs of one group connect the rows.

    Rows come sorted by `groups`. In a group of two blocks (`split`), one of which may be empty, only
    pairs across them (`halves` 0 and 1) count. Pairs are taken by distance in the group; those already connected are left out, so a
    group of near copies costs little more than its size.
    """
    n = len(groups)
    label = np.arange(n)
    begins = np.flatnonzero(np.diff(groups, prepend=groups[:1] - 1)) if n else np.empty(0, np.int64)
    sizes = np.diff(np.append(begins, n))
    last = np.repeat(begins + sizes, sizes)
    rows = np.arange(n)
    distance, links = 1, [(rows[:0], rows[:0])]
    while len(rows := rows[rows + distance < last[rows]]):
        far = rows + distance
        pairs = (label[rows] != label[far]) & (~split[rows] | (halves[rows] != halves[far]))
        a, b = rows[pairs], far[pairs]
        kept = surviving(sig, a, b, least)
        if len(kept):
            links.append((a[kept], b[kept]))
            label = forest(n, np.concatenate([x for x, _ in links]), np.concatenate([y for _, y in links]))
            used = np.flatnonzero(label != np.arange(n))
            links = [(used, label[used])]
        distance += 1
    return label


def _candidate_edges(members: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """(a, b) of spanning forests over surviving pairs. `members`: _part, _bucket, _lo, _hi, _half, sid, _sig."""
    least = least_matches(threshold, tolerance)

    def edges(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["_bucket", "_lo", "_hi", "sid"], kind="stable")
        key = group[["_bucket", "_lo", "_hi"]].to_numpy()
        numbers = np.cumsum(np.append(0, (key[1:] != key[:-1]).any(1)))
        sig = np.frombuffer(b"".join(group["_sig"]), np.uint8).reshape(-1, HASHES)
        label = bucket_forest(sig, numbers, group["_half"].to_numpy(), key[:, 1] != key[:, 2], least)
        sid, at = group["sid"].to_numpy(), np.flatnonzero(label != np.arange(len(label)))
        found = np.unique(np.stack([sid[at], sid[label[at]]], 1), axis=0)
        return pd.DataFrame({"a": found[:, 0], "b": found[:, 1]})

    return members.groupBy("_part").applyInPandas(edges, "a long, b long")


def _in_blocks(members: DataFrame, key: str, blocks, parts: int) -> DataFrame:
    """Each member with the groups it joins: (_lo, _hi) pairs of blocks, and its side of them.

    One block: one group. More: a member of block i joins every pair that holds i. Groups of one
    block share parts; a pair of blocks has a part to itself.
    """
    own = F.pmod(F.xxhash64("sid"), F.col("_blocks"))
    pairs = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1),
        lambda j: F.struct(F.least(j, F.col("_own")).alias("lo"), F.greatest(j, F.col("_own")).alias("hi")),
    )
    spread = members.withColumn("_blocks", blocks.cast("long")).withColumn("_own", own).withColumn("_pair", F.explode(pairs))
    shared = F.pmod(F.xxhash64(key), F.lit(parts))
    alone = parts + F.pmod(F.xxhash64(key, "_lo", "_hi"), F.lit(1 << 62))
    return (
        spread.withColumn("_lo", F.col("_pair.lo"))
        .withColumn("_hi", F.col("_pair.hi"))
        .withColumn("_half", (F.col("_own") != F.col("_lo")).cast("int"))
        .withColumn("_part", F.when(F.col("_blocks") == 1, shared).otherwise(alone))
        .drop("_blocks", "_own", "_pair")
    )


LOW_DF = 16
COLUMNS = 4096


def intersections(owner: np.ndarray, shingles: np.ndarray, n: int) -> np.ndarray:
    """Common shingles of each pair of `n` sets; rare ones are paired up, common ones multiplied as matrices."""
    order = np.argsort(shingles, kind="stable")
    owner, shingles = owner[order], shingles[order]
    begins = np.flatnonzero(np.append(True, shingles[1:] != shingles[:-1]))
    df = np.diff(np.append(begins, len(shingles)))
    out = np.zeros((n, n), np.float32)
    rare = np.repeat((df > 1) & (df <= LOW_DF), df)
    ends = np.repeat(begins + df, df)
    at = np.flatnonzero(rare)
    for distance in range(1, LOW_DF):
        at = at[at + distance < ends[at]]
        if not len(at):
            break
        pairs = owner[at].astype(np.int64) * n + owner[at + distance]
        out += np.bincount(pairs, minlength=n * n).reshape(n, n) if n <= 64 else _scattered(pairs, n)
    out += out.T
    common = np.flatnonzero(df > LOW_DF)
    column = np.repeat(np.arange(len(df)), df)
    for first in range(0, len(common), COLUMNS):
        chosen = common[first:first + COLUMNS]
        inside = np.isin(column, chosen)
        dense = np.zeros((n, len(chosen)), np.float32)
        dense[owner[inside], np.searchsorted(chosen, column[inside])] = 1
        out += dense @ dense.T
    return out


def _scattered(pairs: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(n * n, np.float32)
    found, counts = np.unique(pairs, return_counts=True)
    out[found] = counts
    return out.reshape(n, n)


def _verified(members: DataFrame, threshold: float) -> DataFrame:
    """(sid, links, root): verified links of each set within a group, and the smallest set they connect it to."""
    limit = Fraction(str(threshold))

    def verify(group: pd.DataFrame) -> pd.DataFrame:
        out = []
        for (_, lo, hi), unit in group.groupby(["_root", "_lo", "_hi"], sort=False):
            unit = unit.drop_duplicates("sid").sort_values("sid")
            sets = [np.frombuffer(s, np.uint64) for s in unit["_shingles"]]
            n, sizes = len(sets), np.array([len(s) for s in sets], np.int64)
            common = intersections(np.repeat(np.arange(n), sizes), np.concatenate(sets), n).astype(np.int64)
            either = sizes[:, None] + sizes[None, :] - common
            linked = common * limit.denominator >= either * limit.numerator
            if lo != hi:  # pairs inside a block are those of its own group, also where the other block is empty
                half = unit["_half"].to_numpy()
                linked &= half[:, None] != half[None, :]
            np.fill_diagonal(linked, False)
            a, b = np.nonzero(np.triu(linked))
            sid = unit["sid"].to_numpy()
            out.append(pd.DataFrame({"sid": sid, "links": linked.sum(1), "root": sid[forest(n, a, b)]}))
        return pd.concat(out)

    return members.groupBy("_part").applyInPandas(verify, "sid long, links long, root long")


def near_classes(
    df: DataFrame, text: str = "text", threshold: float = THRESHOLD, tolerance: float = TOLERANCE
) -> DataFrame:
    """`df` with `set_id`, `class_no`, `n_links` and `n_copies`.

    `set_id`: equal for texts with the same shingles. `class_no`: equal for documents connected by
    links; the smallest `set_id` of the class. `n_links`: other sets that reach the threshold with
    this one. `n_copies`: documents of the set, this one included. Texts without words have a set
    and a class of their own, no links and one copy. `set_id` is the number of one document of the
    set in `_row`, which is unique per row. Columns named like these are replaced. The result reads
    a table in the shared folder.
    """
    if not len(df.columns):
        raise ValueError("no columns")
    made = ("set_id", "class_no", "n_links", "n_copies", "_row")
    base = df.select(*[named(c) for c in df.columns if c == text or c not in (*made, *SIGNATURE.names)])
    signed = append_columns(base, text, SIGNATURE, lambda: signatures, 8 << 20)
    docs = stage(signed.withColumn("_row", F.monotonically_increasing_id()), "signed")

    sets = docs.where("_n > 0").groupBy("_k1", "_k2").agg(F.min("_row").alias("sid"), F.count(F.lit(1)).alias("n_copies"))
    sets = stage(sets, "sets")
    own = docs.where("_n > 0").join(sets.select("sid"), F.col("_row") == F.col("sid"), "left_semi")
    banded = own.select(F.col("_row").alias("sid"), F.explode("_bands").alias("_bucket"))
    counts = banded.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_size")).where("_size > 1")
    members = stage(banded.join(counts, "_bucket"), "members")
    n_members = members.count()

    sigs = own.select(F.col("_row").alias("sid"), "_sig")
    blocks = F.ceil(F.col("_size") / F.lit(BLOCK_SETS))
    placed = _in_blocks(members, "_bucket", blocks, n_members // GROUP_ROWS + 1).join(sigs, "sid")
    edges = stage(_candidate_edges(placed, threshold, tolerance), "edges")
    clusters = stage(components(edges), "clusters")

    def shingles(batches):
        for batch in batches:
            for first, last, data, bounds in text_chunks(batch.column(0)):
                at, found = shingle_sets(find_words(data, bounds))
                ends = np.searchsorted(at, np.arange(last - first + 1)).tolist()
                packed = [found[a:b].tobytes() for a, b in zip(ends, ends[1:])]
                part = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays([*part.columns[1:], pa.array(packed, pa.binary())], ["sid", "_root", "_n", "_shingles"])

    texts = docs.select(named(text), "_row", "_n").join(clusters.withColumnRenamed("root", "_root"), F.col("_row") == F.col("id"))
    held = texts.select(named(text), F.col("_row").alias("sid"), "_root", "_n").mapInArrow(shingles, "sid long, _root long, _n long, _shingles binary")
    held = stage(held, "shingles")
    sizes = held.groupBy("_root").agg(F.count(F.lit(1)).alias("_sets"), F.sum("_n").alias("_all"))
    total = held.agg(F.sum("_n")).first()[0] or 0
    blocks = F.ceil(F.greatest(F.col("_sets") / F.lit(CLUSTER_SETS), F.col("_all") / F.lit(CLUSTER_SHINGLES)))
    placed = _in_blocks(held.join(sizes, "_root"), "_root", blocks, total // CLUSTER_SHINGLES + 1)
    verified = stage(_verified(placed.drop("_sets", "_all", "_n"), threshold), "verified")

    links = verified.groupBy("sid").agg(F.sum("links").alias("n_links"))
    classes = components(verified.select(F.col("sid").alias("a"), F.col("root").alias("b")))
    known = stage(
        sets.join(links, "sid", "left").join(classes.withColumnRenamed("id", "sid"), "sid", "left")
        .select("_k1", "_k2", "sid", "n_copies", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("root", "sid").alias("class_no")),
        "known",
    )
    joined = docs.join(known, ["_k1", "_k2"], "left")
    return joined.select(
        *[named(c) for c in df.columns if c == text or c not in (*made, *SIGNATURE.names)], "_row",
        F.coalesce("sid", "_row").alias("set_id"), F.coalesce("class_no", "_row").alias("class_no"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("n_copies", F.lit(1)).cast("long").alias("n_copies"),
    )


def keep_one(df: DataFrame, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One document of each class, all columns; texts without words all stay."""
    marked = near_classes(df, text, threshold)
    first = marked.groupBy("class_no").agg(F.min("_row").alias("_first")).select("_first")
    kept = marked.join(first, F.col("_row") == F.col("_first"), "left_semi")
    return kept.select(*[named(c) for c in df.columns])


ship_with_tasks(__name__)
