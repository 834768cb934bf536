"""Words, spans and their hashes for whole Arrow batches of texts, in numpy.

A word is a run of characters other than blank and U+0009 to U+000D. The six separators are
single bytes in UTF-8, so words are found and hashed on the bytes of all texts of a batch at
once, without a Python object per word. Hashes are sums of (random value of a byte or word) x
(power of an odd base) modulo 2**64, mixed at the end; two independent ones make a 128-bit
fingerprint, which stands for the text itself wherever words or windows are grouped.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tidemark.session import named, ship_with_tasks

CHUNK_BYTES = 1 << 20
BATCH_ROWS = 1000
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
WORD = r"[^\x20\x09-\x0D]+"  # fixed: the definition of a word

_random = np.random.default_rng(20240229)
BYTE_VALUES = _random.integers(1, 1 << 63, (2, 256), dtype=np.uint64)
SPAN_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
WINDOW_BASES = (0xC2B2AE3D27D4EB4F, 0xA0761D6478BD642F)
SEPARATOR = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective finisher: every input bit moves every output bit."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and the n + 1 bounds of the texts in them; a null is empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    if data is None or bounds[-1] == bounds[0]:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[bounds[0]:bounds[-1]], bounds - bounds[0]


def text_chunks(column: pa.Array, chunk_bytes: int = CHUNK_BYTES):
    """(first text, last text + 1, bytes, bounds) of runs of texts of about `chunk_bytes`, whole texts only."""
    data, bounds = text_bytes(column)
    first, n = 0, len(bounds) - 1
    while first < n:
        last = int(np.searchsorted(bounds, bounds[first] + chunk_bytes, "right")) - 1
        last = min(max(last, first + 1), n)
        at = bounds[first:last + 1]
        yield first, last, data[at[0]:at[-1]], at - at[0]
        first = last


def spans_of(solid: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of `solid` bytes; a text's border ends a run."""
    if not len(solid):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    inner = bounds[(bounds > 0) & (bounds < len(solid))]
    opens, closes = solid.copy(), solid.copy()
    opens[1:] &= ~solid[:-1]
    opens[inner] = solid[inner]
    closes[:-1] &= ~solid[1:]
    closes[inner - 1] = solid[inner - 1]
    return np.flatnonzero(opens), np.flatnonzero(closes) + 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    """64-bit hash of each non-empty span of bytes."""
    if not len(starts):
        return np.empty(0, np.uint64)
    lengths = ends - starts
    firsts = np.cumsum(lengths) - lengths
    within = np.arange(int(lengths.sum())) - np.repeat(firsts, lengths)
    at = within + np.repeat(starts, lengths)
    values = BYTE_VALUES[which][data[at]] * powers(SPAN_BASES[which], int(lengths.max()))[within]
    return mix(np.add.reduceat(values, firsts) + lengths.astype(np.uint64))


@dataclass
class Words:
    """Words of a run of texts: byte spans, text number of each, words and first word of each text."""

    data: np.ndarray
    bounds: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    text: np.ndarray
    counts: np.ndarray
    firsts: np.ndarray

    def hashes(self, which: int = 0) -> np.ndarray:
        return span_hashes(self.data, self.starts, self.ends, which)


def find_words(data: np.ndarray, bounds: np.ndarray) -> Words:
    starts, ends = spans_of(~SEPARATOR[data], bounds)
    edges = np.searchsorted(starts, bounds)
    counts = np.diff(edges)
    return Words(data, bounds, starts, ends, np.repeat(np.arange(len(counts)), counts), counts, edges[:-1])


def spaced(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """The words of all texts, each followed by one blank, as bytes, and where each word starts in them."""
    lengths = words.ends - words.starts
    out = np.full(int(lengths.sum()) + len(lengths), 0x20, np.uint8)
    out[np.arange(int(lengths.sum())) + np.repeat(np.arange(len(lengths)), lengths)] = words.data[~SEPARATOR[words.data]]
    return out, np.cumsum(lengths + 1) - (lengths + 1)


def windows(hashes: np.ndarray, width: int, which: int = 0) -> np.ndarray:
    """Hash of each run of `width` consecutive words, over the borders of texts too."""
    n = len(hashes)
    if n < width:
        return np.empty(0, np.uint64)
    base = WINDOW_BASES[which]
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * powers(base, n), out=prefix[1:])
    back = powers(pow(base, -1, 1 << 64), n - width + 1)
    return mix((prefix[width:] - prefix[:-width]) * back)


def window_starts(words: Words, width: int) -> np.ndarray:
    """First words of the windows that lie inside one text."""
    n = len(words.text)
    if n < width:
        return np.empty(0, np.int64)
    return np.flatnonzero(words.text[: n - width + 1] == words.text[width - 1:])


def covered(n_words: int, starts: np.ndarray, width: int) -> np.ndarray:
    """Whether each word lies in one of the windows that begin at `starts`."""
    steps = np.zeros(n_words + 1, np.int32)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + width, -1)
    return np.cumsum(steps[:-1]) > 0


def small_batches(spark: SparkSession) -> None:
    """Let tasks hand texts to Python `BATCH_ROWS` at a time, as they may be long; a session setting.

    Spark's default of 10,000 rows holds tens of megabytes a task, twice over, outside the heap.
    """
    if int(spark.conf.get(_BATCH_SETTING)) > BATCH_ROWS:
        spark.conf.set(_BATCH_SETTING, str(BATCH_ROWS))


def append_columns(df: DataFrame, text: str, fields: StructType, start, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """`df` with columns computed from its texts; older columns of the same names are replaced.

    `start()` is called once per task and gives a function from an Arrow array of texts (about
    `chunk_bytes` of them) to one Arrow array per field. The rows stay in their partitions.
    """
    small_batches(df.sparkSession)
    names = [f.name for f in fields]
    kept = df.select(*[named(c) for c in df.columns if c not in names or c == text])
    out = StructType([f for f in kept.schema if f.name not in names] + list(fields))

    def run(batches):
        work = start()
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            for first, last, _, _ in text_chunks(column, chunk_bytes):
                part = batch.slice(first, last - first)
                rest = [part.column(i) for i, n in enumerate(batch.schema.names) if n not in names]
                yield pa.RecordBatch.from_arrays(rest + work(part.column(batch.schema.get_field_index(text))), out.names)

    return kept.mapInArrow(run, out)


ship_with_tasks(__name__)
