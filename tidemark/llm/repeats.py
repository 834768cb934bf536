"""Removal of long word sequences that occur again anywhere: a count-min prefilter, then exact groups.

1. Every task counts its windows in two rows of cells, up to 2, and emits only the cells it
   touched, by shard. Shards are merged to one bit per cell: counted at least twice. The least
   count over both rows is never below the true one, so no repeated window is missed.
2. Windows whose cells are both set are grouped exactly, by a 96-bit fingerprint. Each task
   first merges equal windows of its own, so a passage of millions of copies arrives as one row
   per task. The groups tell which windows were estimated repeated but stand alone.
3. Those few are sent back to their texts, and what all other estimated windows cover is removed.

The merged sketch is broadcast, so its size is bounded: `BITS_PER_WINDOW` bits for each window,
`SKETCH_BYTES` at most. A sketch at the bound filters less and sends more windows to step 2; the
result is the same. Texts are matched in steps 2 and 3 by content, so ids may repeat or be null.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.words import covered, find_words, small_batches, text_chunks, window_starts, windows
from tidemark.session import named, ship_with_tasks

WINDOW_WORDS = 35
BITS_PER_WINDOW = 5
SKETCH_BYTES = 128 << 20
SHARD_BITS = 20
SKETCH_WINDOWS = 2_000_000  # windows that a task holds before it emits their cells
FLUSH_WINDOWS = 1_000_000  # and those it merges before it emits them
BLOCK = 256
GROUP_WINDOWS = 500_000
MERGE_BYTES = 64 << 20
MERGE_PARTS = 16


def _cells(window: np.ndarray, cells: int, row: int) -> np.ndarray:
    """Cell of each window in one row of the sketch; the rows use different bits of the hash."""
    spread = (window * np.uint64((0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)[row])) >> np.uint64(32)
    return ((spread * np.uint64(cells)) >> np.uint64(32)).astype(np.int64) + row * cells


def pack_cells(cells: np.ndarray) -> bytes:
    """Sorted cells of one shard: how many lie in each block of 256, then the low byte of each."""
    if not len(cells):
        return b""
    counts = np.bincount(cells // BLOCK, minlength=(1 << SHARD_BITS) // BLOCK).astype("<u2")
    # a count is two bytes, but the upper ones are all zero unless a block is full
    return counts.view(np.uint8).reshape(-1, 2).T.tobytes() + (cells % BLOCK).astype(np.uint8).tobytes()


def unpack_cells(packed: bytes) -> np.ndarray:
    if not packed:
        return np.empty(0, np.int64)
    blocks = (1 << SHARD_BITS) // BLOCK
    low, high = np.frombuffer(packed, np.uint8, 2 * blocks).reshape(2, -1).astype(np.int64)
    counts = low + 256 * high
    return np.repeat(np.arange(blocks) * BLOCK, counts) + np.frombuffer(packed, np.uint8, offset=2 * blocks)


def _shards(window: np.ndarray, cells: int):
    """(shard, cells seen, cells seen twice) of a run of windows."""
    for row in (0, 1):
        found, counts = np.unique(_cells(window, cells, row), return_counts=True)
        shards = found >> SHARD_BITS
        cuts = np.flatnonzero(np.diff(shards, prepend=-1)).tolist() + [len(shards)]
        low = found & ((1 << SHARD_BITS) - 1)
        for a, b in zip(cuts, cuts[1:]):
            yield int(shards[a]), pack_cells(low[a:b]), pack_cells(low[a:b][counts[a:b] > 1])


def _window_hashes(column: pa.Array, width: int, both: bool):
    """(words, starts of windows in one text, their first hash, their second hash) of runs of texts."""
    for first, last, data, bounds in text_chunks(column):
        words = find_words(data, bounds)
        starts = window_starts(words, width)
        one = windows(words.hashes(0), width, 0)[starts] if len(starts) else np.empty(0, np.uint64)
        two = windows(words.hashes(1), width, 1)[starts] if both and len(starts) else np.empty(0, np.uint64)
        yield first, last, words, starts, one, two


def repeated_cells(df: DataFrame, text: str, width: int, cells: int, n_windows: int) -> list[bytes]:
    """Bits of both rows by shard, compressed: set where the merged count is two or more.

    The parts of a shard are merged in rounds of at most `MERGE_BYTES` or `MERGE_PARTS` a group.
    """
    shards = -(-2 * cells >> SHARD_BITS)
    salts = int(4 * n_windows // shards // MERGE_BYTES + 1)

    def sketch(batches):
        held, size, turn = [], 0, TaskContext.get().partitionId()
        for batch in batches:
            for _, _, _, _, one, _ in _window_hashes(batch.column(0), width, False):
                held.append(one)
                size += len(one)
                if size >= SKETCH_WINDOWS:
                    yield emit(held, turn)
                    held, size, turn = [], 0, turn + 1
        if size:
            yield emit(held, turn)

    def emit(held, turn):
        at, seen, twice = zip(*_shards(np.concatenate(held), cells))
        return pa.RecordBatch.from_arrays(
            [pa.array(at, pa.int64()), pa.array([turn % salts] * len(at), pa.int64()), pa.array(seen, pa.binary()), pa.array(twice, pa.binary())],
            ["shard", "salt", "seen", "twice"],
        )

    def counted(group: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        once, more = np.zeros(1 << SHARD_BITS, bool), np.zeros(1 << SHARD_BITS, bool)
        for seen, twice in zip(group["seen"], group["twice"]):
            at = unpack_cells(seen)
            more[at] |= once[at]
            once[at] = True
            more[unpack_cells(twice)] = True
        return once, more

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        once, more = counted(group)
        return pd.DataFrame({
            "shard": group["shard"].iloc[:1], "salt": group["salt"].iloc[:1],
            "seen": [pack_cells(np.flatnonzero(once))], "twice": [pack_cells(np.flatnonzero(more))],
        })

    def finish(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"shard": group["shard"].iloc[:1], "bits": [zlib.compress(np.packbits(counted(group)[1]).tobytes(), 1)]})

    schema = "shard long, salt long, seen binary, twice binary"
    parts = df.select(named(text)).mapInArrow(sketch, schema)
    while salts > 1:
        parts = parts.groupBy("shard", "salt").applyInPandas(merge, schema)
        salts = -(-salts // MERGE_PARTS)
        parts = parts.withColumn("salt", F.col("salt") % salts)
    bits = [b""] * shards
    for row in parts.groupBy("shard").applyInPandas(finish, "shard long, bits binary").collect():  # SKETCH_BYTES at most
        bits[row.shard] = bytes(row.bits)
    return bits


def open_bits(packed: list[bytes]) -> np.ndarray:
    size = 1 << (SHARD_BITS - 3)
    bits = np.zeros(len(packed) * size, np.uint8)
    for shard, part in enumerate(packed):
        if part:
            bits[shard * size:(shard + 1) * size] = np.frombuffer(zlib.decompress(part), np.uint8)
    return bits


def _estimated(bits: np.ndarray, window: np.ndarray, cells: int) -> np.ndarray:
    """Whether each window is estimated to occur twice or more."""
    out = np.ones(len(window), bool)
    for row in (0, 1):
        at = _cells(window, cells, row)
        out &= (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1
    return out


def _text_keys(words) -> np.ndarray:
    raw, bounds = words.data.tobytes(), words.bounds.tolist()
    return np.array([hashlib.md5(raw[a:b]).digest() for a, b in zip(bounds, bounds[1:])], "S16")


ENTRY = np.dtype([("a", "<u8"), ("b", "<u4"), ("text", "<u8"), ("at", "<i4"), ("count", "<i4")])


def _merged(entries: np.ndarray) -> np.ndarray:
    """One entry per fingerprint, with the sum of the counts (kept at 2) and one of the places."""
    entries = entries[np.lexsort((entries["b"], entries["a"]))]
    new = np.ones(len(entries), bool)
    new[1:] = (entries["a"][1:] != entries["a"][:-1]) | (entries["b"][1:] != entries["b"][:-1])
    firsts = np.flatnonzero(new)
    out = entries[firsts]
    out["count"] = np.minimum(np.add.reduceat(entries["count"].astype(np.int64), firsts), 2) if len(firsts) else 0
    return out


def _pack_entries(entries: np.ndarray) -> bytes:
    """Column by column; a place is sent only for an entry that was seen once."""
    single = entries["count"] == 1
    parts = [np.array([len(entries)], "<i8"), entries["a"], entries["b"], single, entries["text"][single], entries["at"][single]]
    return b"".join(np.ascontiguousarray(p).tobytes() for p in parts)


def _unpack_entries(packed: bytes) -> np.ndarray:
    n = int(np.frombuffer(packed, "<i8", 1)[0])
    out = np.zeros(n, ENTRY)
    out["a"] = np.frombuffer(packed, "<u8", n, 8)
    out["b"] = np.frombuffer(packed, "<u4", n, 8 + 8 * n)
    single = np.frombuffer(packed, bool, n, 8 + 12 * n)
    k, at = int(single.sum()), 8 + 13 * n
    out["count"] = np.where(single, 1, 2)
    out["text"][single] = np.frombuffer(packed, "<u8", k, at)
    out["at"][single] = np.frombuffer(packed, "<i4", k, at + 8 * k)
    return out


def lone_windows(df: DataFrame, text: str, width: int, cells: int, bits, groups: int) -> DataFrame:
    """(text_key, at): windows that the sketch estimates repeated though they occur once.

    `text_key` is the first half of the text's MD5 digest and `at` the number of the first word.
    A text that occurs twice has no such window.
    """
    def candidates(batches):
        seen, held, size = open_bits(bits.value), [], 0
        for batch in batches:
            for _, _, words, starts, one, two in _window_hashes(batch.column(0), width, True):
                keep = _estimated(seen, one, cells)
                starts, entries = starts[keep], np.zeros(int(keep.sum()), ENTRY)
                keys = np.frombuffer(_text_keys(words).tobytes(), "<u8").reshape(-1, 2)[:, 0]
                entries["a"], entries["b"], entries["count"] = one[keep], two[keep] >> np.uint64(32), 1
                entries["text"] = keys[words.text[starts]]
                entries["at"] = starts - words.firsts[words.text[starts]]
                held.append(entries)
                size += len(entries)
                if size >= FLUSH_WINDOWS:
                    held = [_merged(np.concatenate(held))]
                    if len(held[0]) > FLUSH_WINDOWS // 2:
                        yield from emit(held[0])
                        held = []
                    size = sum(map(len, held))
        if size:
            yield from emit(_merged(np.concatenate(held)))

    def emit(entries):
        group = (entries["a"] % np.uint64(groups)).astype(np.int64)
        order = np.argsort(group, kind="stable")
        group, entries = group[order], entries[order]
        cuts = np.flatnonzero(np.diff(group, prepend=-1)).tolist() + [len(group)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([int(group[a]) for a in cuts[:-1]], pa.int64()), pa.array([_pack_entries(entries[a:b]) for a, b in zip(cuts, cuts[1:])], pa.binary())],
            ["part", "entries"],
        )

    def alone(group: pd.DataFrame) -> pd.DataFrame:
        merged = _merged(np.concatenate([_unpack_entries(e) for e in group["entries"]]))
        merged = merged[merged["count"] == 1]
        return pd.DataFrame({"text_key": merged["text"].astype(np.int64), "at": merged["at"]})

    packed = df.select(named(text)).mapInArrow(candidates, "part long, entries binary")
    return packed.groupBy("part").applyInPandas(alone, "text_key long, at int")


def drop_repeats(df: DataFrame, text: str = "text", width: int = WINDOW_WORDS, sketch_bytes: int = SKETCH_BYTES) -> DataFrame:
    """`df` with `n_words`, `n_removed` and `kept_text`: the words that no repeated window covers, by one blank.

    A window is `width` consecutive words of one text; it is repeated if its words also start
    anywhere else, in the same text too (overlapping places count). All windows are judged on
    the input. Null and wordless texts have no words and the kept text ''. Columns of these three
    names are replaced; all others stay.
    """
    spark = df.sparkSession
    small_batches(spark)
    n_windows = df.select(F.sum(F.octet_length(named(text)))).first()[0] or 0
    n_windows = n_windows // 6 + 1  # about one window per word of five bytes and a blank
    cells = int(min(sketch_bytes * 8, max(1 << 16, BITS_PER_WINDOW * n_windows)) // 2)
    bits = spark.sparkContext.broadcast(repeated_cells(df, text, width, cells, n_windows))
    groups = int(n_windows // GROUP_WINDOWS + 1)
    lone = lone_windows(df, text, width, cells, bits, groups)
    lone = lone.groupBy(F.col("text_key").alias("_key")).agg(F.array_sort(F.collect_list("at")).alias("_lone"))

    made = ("n_words", "n_removed", "kept_text")
    # the first eight bytes of the digest as a little-endian number, as the tasks read them
    key = F.conv(F.concat(*[F.substring(F.md5(named(text)), 15 - 2 * i, 2) for i in range(8)]), 16, -10).cast("long")
    kept = df.select(*[named(c) for c in df.columns if c not in made or c == text], key.alias("_key"))
    joined = kept.join(lone, "_key", "left").drop("_key")
    fields = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept_text", T.StringType())])
    out = T.StructType([*[f for f in kept.schema if f.name not in ("_key", *made)], *fields])

    def remove(batches):
        seen = open_bits(bits.value)
        for batch in batches:
            names = batch.schema.names
            for first, last, words, starts, one, _ in _window_hashes(batch.column(names.index(text)), width, False):
                part = batch.slice(first, last - first)
                marked = starts[_estimated(seen, one, cells)] if len(starts) else starts
                lists = part.column(names.index("_lone"))
                owner = np.repeat(np.arange(len(lists)), lists.value_lengths().fill_null(0).to_numpy())
                single = words.firsts[owner] + lists.flatten().to_numpy()
                marked = marked[~np.isin(marked, single)]
                gone = covered(len(words.starts), marked, width)
                n_removed = np.bincount(words.text[gone], minlength=len(lists))
                rest = [part.column(i) for i, n in enumerate(names) if n != "_lone" and n not in made]
                yield pa.RecordBatch.from_arrays(
                    [*rest, pa.array(words.counts, pa.int64()), pa.array(n_removed, pa.int64()), _kept_texts(words, gone)], out.names
                )

    return joined.mapInArrow(remove, out)


def _kept_texts(words, gone: np.ndarray) -> pa.Array:
    """The words that stay, of each text, joined by one blank."""
    raw, stay = words.data.tobytes(), ~gone
    starts, ends = words.starts[stay].tolist(), words.ends[stay].tolist()
    cuts = np.concatenate([[0], np.cumsum(np.bincount(words.text[stay], minlength=len(words.counts)))]).tolist()
    kept = [raw[a:b] for a, b in zip(starts, ends)]
    return pa.array([b" ".join(kept[a:b]) for a, b in zip(cuts, cuts[1:])], pa.binary()).cast(pa.string())


ship_with_tasks(__name__)
