"""SimHash fingerprints of word shingles, and the classes of those that differ in few bits.

Covering locality-sensitive hashing finds every link: give each bit position a non-zero vector of
radius + 1 bits; every non-zero vector v of so many bits makes a mask of the positions whose vector has
an odd product with v. Two fingerprints that differ in at most `radius` positions agree under some mask, as
so few equations always leave a v with even products at all of them. So both fall into one bucket of
that mask's table, and comparing fingerprints within buckets loses no link.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.components import components, forest
from tidemark.llm.words import append_columns, find_words, spaced, text_bytes, window_starts
from tidemark.session import join_on, named, ship_with_tasks, small_or_not, stage

BITS = 64
SHINGLE_WORDS = 3
RADIUS = 3
SEED = 42
BUCKET_ROWS = 4096  # a bucket above it is dealt out again by masks of its open bits
HASH_ROWS = 1 << 16
PAIR_ROWS = 1 << 20
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += ord("a") - ord("A")


def fingerprints_of(column: pa.Array, shingle: int = SHINGLE_WORDS) -> np.ndarray:
    """64-bit SimHash of each text: a bit is set if it is in more than half of the shingles' hashes."""
    data, bounds = text_bytes(column)
    words = find_words(LOWER[data], bounds)
    raw, starts = spaced(words)
    ends = starts + words.ends - words.starts
    short = np.flatnonzero((words.counts > 0) & (words.counts < shingle))
    first = np.concatenate([window_starts(words, shingle), words.firsts[short]])
    last = np.concatenate([first[:len(first) - len(short)] + shingle - 1, words.firsts[short] + words.counts[short] - 1])
    order = np.argsort(words.text[first], kind="stable")
    first, last = first[order], last[order]
    owner, left, right = words.text[first], starts[first], ends[last]
    votes = np.zeros((len(words.counts), BITS), np.int64)
    raw, hashed = raw.tobytes(), xxhash.xxh64_intdigest
    for at in range(0, len(first), HASH_ROWS):
        part = slice(at, at + HASH_ROWS)
        spans = zip(left[part].tolist(), right[part].tolist())
        hashes = np.array([hashed(raw[a:b], SEED) for a, b in spans], np.uint64)
        texts = owner[part]
        cuts = np.flatnonzero(np.diff(texts, prepend=-1))
        for text, a, b in zip(texts[cuts].tolist(), cuts.tolist(), [*cuts[1:].tolist(), len(texts)]):
            votes[text] += bit_counts(hashes[a:b])
    total = np.bincount(owner, minlength=len(words.counts))
    bits = (2 * votes > total[:, None]).astype(np.uint8)
    return np.packbits(bits, axis=1, bitorder="little").view(np.int64).ravel()


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit, lowest first."""
    return np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


def covering_masks(positions: list[int], radius: int) -> list[int]:
    """Masks of some bit positions such that any `radius` positions lie outside one of them; signed 64-bit."""
    size = radius + 1
    vector = {p: 1 + i % ((1 << size) - 1) for i, p in enumerate(positions)}
    masks = [sum(1 << p for p in positions if (vector[p] & v).bit_count() % 2) for v in range(1, 1 << size)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def finer_masks(mask: int, radius: int) -> list[int]:
    """The mask with a covering family of the positions that it leaves open."""
    open_ = [p for p in range(BITS) if not mask >> p & 1]
    return [m | mask for m in covering_masks(open_, radius)]


def links_in_buckets(buckets: DataFrame, keys: list[str], radius: int) -> DataFrame:
    """(a, b) links of fingerprints `_print` in the same bucket, as a forest for each batch and bucket.

    Each task reads its buckets sorted, as a stream, and compares every fingerprint of a bucket with every
    other, one distance in the order after the other. It holds one batch and one bucket.
    """
    by = [F.col(k) for k in keys]
    dealt = buckets.select(*keys, "_print").repartition(*by).sortWithinPartitions(*by, "_print")

    def run(batches):
        held = None
        for batch in batches:
            rows = np.stack([batch.column(i).to_numpy() for i in range(batch.num_columns)])
            if held is not None:
                rows = np.concatenate([held, rows], axis=1)
            changed = (rows[:-1, 1:] != rows[:-1, :-1]).any(axis=0)
            last = int(np.flatnonzero(changed)[-1]) + 1 if changed.any() else 0
            held = rows[:, last:]
            yield from links(rows[:, :last])
        if held is not None:
            yield from links(held)

    def links(rows):
        n = rows.shape[1]
        if n < 2:
            return
        prints = rows[-1]
        opens = np.flatnonzero(np.append(True, (rows[:-1, 1:] != rows[:-1, :-1]).any(axis=0)))
        sizes = np.diff(np.append(opens, n))
        left_over = np.repeat(sizes, sizes) - (np.arange(n) - np.repeat(opens, sizes))  # rows of the bucket from here on
        at, pairs, found = np.arange(n), [], 0
        for step in range(1, int(sizes.max())):
            at = at[left_over[at] > step]
            apart = (prints[at] ^ prints[at + step]).view(np.uint64)  # bits of a signed number are those of its size
            near = at[np.bitwise_count(apart) <= radius]
            if len(near):
                pairs.append(np.stack([near, near + step]))
                found += len(near)
            if found > PAIR_ROWS:
                pairs, found = [spanning(n, pairs)], 0
        if pairs:
            a, b = spanning(n, pairs)
            yield pa.RecordBatch.from_arrays([pa.array(prints[a]), pa.array(prints[b])], ["a", "b"])

    def spanning(n, pairs):
        label = forest(n, *np.concatenate(pairs, axis=1))
        linked = np.flatnonzero(label != np.arange(n))
        return np.stack([linked, label[linked]])

    return dealt.mapInArrow(run, "a long, b long")


def near_links(prints: DataFrame, radius: int = RADIUS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(a, b): links that connect what fingerprints `_print` (distinct, not null) at most `radius` bits apart connect.

    Buckets are counted first, with partial sums. Those above `bucket_rows` never go to one task: their rows are
    dealt out by a second covering family over the bits that the first mask leaves open, which again
    loses no link and leaves so few open bits (14 to 16 with radius 3) that a bucket has at most 65,536
    fingerprints.
    """
    masks = covering_masks(list(range(BITS)), radius)
    key = [F.col("_print").bitwiseAND(F.lit(m)) for m in masks]
    buckets = prints.select("_print", F.posexplode(F.array(*key)).alias("_table", "_key"))
    counts = buckets.groupBy("_table", "_key").count()
    heavy = stage(counts.where(F.col("count") > bucket_rows).select("_table", "_key"), "heavy")
    if heavy.isEmpty():
        return links_in_buckets(buckets, ["_table", "_key"], radius)
    heavy = small_or_not(heavy)
    light = buckets.join(heavy, ["_table", "_key"], "left_anti")
    finer = F.array(*[F.array(*[F.lit(m) for m in finer_masks(m, radius)]) for m in masks])
    dense = buckets.join(heavy, ["_table", "_key"]).select(
        "_table", "_print", F.posexplode(F.get(finer, F.col("_table"))).alias("_finer", "_mask")
    ).withColumn("_key", F.col("_print").bitwiseAND(F.col("_mask")))
    return links_in_buckets(light, ["_table", "_key"], radius).unionByName(
        links_in_buckets(dense, ["_table", "_finer", "_key"], radius)
    )


def hex_of(print_: Column) -> Column:
    return F.lower(F.lpad(F.hex(print_), 16, "0"))


def near_components(
    df: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS, bucket_rows: int = BUCKET_ROWS
) -> DataFrame:
    """(key, fingerprint, component_id) of every row: its SimHash in hex and the smallest key it is linked to, itself included.

    Shingles are 3 words, lower-cased (A-Z only) and joined by one blank, repeats included; a text of
    fewer words is one shingle, and null or wordless texts have the fingerprint 0, which links like any other. Texts
    link at fingerprints at most `radius` bits apart; components follow links over any number of steps.
    Rows of equal fingerprints are one vertex, so copies make no pairs. Keys may repeat (each row is
    returned) and be null: a null is no smallest key unless all of its component are. No rows give none;
    other columns are left out.
    """
    texts = df.select(named(key).alias("_id"), named(text).alias("_text"))
    made = append_columns(
        texts, "_text", T.StructType([T.StructField("_print", T.LongType())]),
        lambda: lambda column: [pa.array(fingerprints_of(column))],
    )
    rows = stage(made.select("_id", "_print"), "prints")
    prints = stage(rows.groupBy("_print").agg(F.min("_id").alias("_least")), "distinct")
    links = stage(near_links(prints, radius, bucket_rows).distinct(), "links")  # read twice below
    linked = stage(components(links), "linked")
    linked = linked.select(F.col("id").alias("_print"), F.col("root").alias("_root"))
    least = prints.join(linked, "_print").groupBy("_root").agg(F.min("_least").alias("_smallest"))
    members = linked.join(small_or_not(stage(least, "least")), "_root").select("_print", "_smallest")
    labels = prints.join(small_or_not(stage(members, "members")), "_print", "left")
    labels = labels.select("_print", F.when(F.col("_smallest").isNull(), F.col("_least")).otherwise(F.col("_smallest")).alias("_component"))
    out = join_on(rows, small_or_not(stage(labels, "labels")), ["_print"], "left", null_safe=False)
    return out.select(
        F.col("_id").alias(key), hex_of(F.col("_print")).alias("fingerprint"), F.col("_component").alias("component_id")
    )


ship_with_tasks(__name__)
