"""Periodic runs of words: stretches in which the words one period apart are the same, four times or more.

Matches of a word with an earlier one lie on the diagonal of their lag, and a run of period q and length
l is a diagonal q of l - q matches in a row. Only diagonals of 3 q matches count, so a word is looked up
with the words before it: for lags from 2**k to 2**(k+1) - 1 by its last 3 * 2**k words, the shortest match that
such a lag must reach. Of the earlier occurrences of these words only the latest can be the period of
a run: were a later one at lag e < d, the words would have the periods e and d, hence their common divisor,
and d would not be smallest. So each word has at most one active lag per scale, the match length of
a lag grows as long as it stays active, and when it ends a sufficient length is a run. Work is
n log n in the words of a text, however often its words repeat.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.words import Words, append_columns, find_words, mix, spaced, text_bytes
from tidemark.session import named, ship_with_tasks

LEAST_WORDS = 6
LEAST_REPEATS = 4
_ODD = np.uint64(0x9E3779B97F4A7C15)
FIELDS = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("n_runs", T.LongType()),
    T.StructField("runs", T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")]))),
    T.StructField("collapsed", T.StringType()),
])


def _pair(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mix(left * _ODD + right)


def active_lags(words: Words):
    """Per scale: (context width, words, their active lag), words in order.

    The hash of a word's context is that of its two halves, so a scale costs one step for the words
    that can still match: those whose halves both occur more than once in their text.
    """
    one = mix(words.hashes() + mix(words.text.astype(np.uint64)))  # a text's words match only its own
    within = np.arange(len(one)) - words.firsts[words.text]
    room = words.counts[words.text]
    width, low = LEAST_REPEATS - 1, 1
    grams = np.zeros_like(one)
    live = np.flatnonzero((within >= width - 1) & (room >= LEAST_WORDS))
    grams[live] = _pair(_pair(one[live - 2], one[live - 1]), one[live])
    while len(live):
        order = np.argsort(grams[live], kind="stable")
        at = live[order]
        same = grams[at[1:]] == grams[at[:-1]]
        lag = at[1:] - at[:-1]
        active = same & (lag >= low) & (lag < 2 * low)
        where = at[1:][active]
        order = np.argsort(where)
        yield width, where[order], lag[active][order]

        again = np.zeros(len(one), bool)
        again[at[1:][same]] = True
        again[at[:-1][same]] = True
        low, before, width = 2 * low, width, 2 * width
        live = live[again[live] & (within[live] >= width - 1) & (room[live] >= LEAST_REPEATS * low)]
        live = live[again[live - before]]
        grams[live] = _pair(grams[live - before], grams[live])


def find_runs(words: Words) -> np.ndarray:
    """(text, first word in the text, length, period) of every run, by text, start and period."""
    found = [np.empty((0, 4), np.int64)]
    for width, at, lag in active_lags(words):
        if not len(at):
            continue
        opens = np.flatnonzero((np.diff(at, prepend=-2) != 1) | (np.diff(lag, prepend=0) != 0))
        closes = np.append(opens[1:], len(at)) - 1
        period = lag[opens]
        length = closes - opens + width + period
        ended = length >= np.maximum(LEAST_WORDS, LEAST_REPEATS * period)
        text = words.text[at[opens[ended]]]
        start = at[opens[ended]] - width + 1 - period[ended] - words.firsts[text]
        found.append(np.stack([text, start, length[ended], period[ended]], axis=1))
    runs = np.concatenate(found)
    return runs[np.lexsort((runs[:, 3], runs[:, 1], runs[:, 0]))]


def kept_texts(words: Words, gone: np.ndarray) -> pa.Array:
    """The words of each text that are not gone, by one blank."""
    data, starts = spaced(words)
    kept = np.flatnonzero(~gone)
    lengths = (words.ends - words.starts)[kept]
    blank = np.append(words.text[kept][1:] == words.text[kept][:-1], False) if len(kept) else np.empty(0, bool)
    solid = np.repeat(~gone, words.ends - words.starts + 1)
    solid[starts[kept[~blank]] + lengths[~blank]] = False
    sizes = np.bincount(words.text[kept], weights=lengths + blank, minlength=len(words.counts)).astype(np.int64)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    buffers = [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data[solid].tobytes())]
    return pa.Array.from_buffers(pa.large_string(), len(sizes), buffers).cast(pa.string())


def _start():
    def work(column: pa.Array) -> list[pa.Array]:
        words = find_words(*text_bytes(column))
        runs = find_runs(words)
        steps = np.zeros(len(words.starts) + 1, np.int64)
        first = words.firsts[runs[:, 0]] + runs[:, 1]
        np.add.at(steps, first + runs[:, 3], 1)
        np.add.at(steps, first + runs[:, 2], -1)
        gone = np.cumsum(steps[:-1]) > 0
        n_runs = np.bincount(runs[:, 0], minlength=len(words.counts))
        offsets = np.concatenate([[0], np.cumsum(n_runs)]).astype(np.int32)
        each = pa.StructArray.from_arrays([pa.array(runs[:, i], pa.int64()) for i in (1, 2, 3)], ["start", "length", "period"])
        listed = pa.ListArray.from_arrays(pa.array(offsets), each)
        return [pa.array(words.counts, pa.int64()), pa.array(n_runs, pa.int64()), listed, kept_texts(words, gone)]

    return work


def collapse_runs(df: DataFrame, text: str = "text") -> DataFrame:
    """`df` with `n_words`, `n_runs`, `runs` and `collapsed`: the words left once every run keeps its first period.

    A run is a longest stretch of words with smallest period q (words q apart are the same) of at least
    6 words and 4 q. `runs` lists (start, length, period) by start, then period, words numbered
    from 0; overlapping runs of different periods are all listed. A word is dropped if any run has it after
    the run's first q words. Null and wordless texts have no words, no runs and ''. Rows are judged
    one by one, so ties and repeated rows do not matter; no rows give none. Columns of these four
    names are replaced (a text column of such a name too); all others stay. A task holds about 1 MB
    of texts, or one text if that is longer, at some 100 bytes a word; words are compared by 64-bit hashes.
    """
    made = FIELDS.fieldNames()
    kept = [c for c in df.columns if c not in made or c == text]
    inner = {c: f"_in{i}" for i, c in enumerate(kept)}  # no name of the table's reaches the operator
    found = append_columns(df.select(*[named(c).alias(n) for c, n in inner.items()]), inner[text], FIELDS, _start)
    return found.select(*[F.col(n).alias(c) for c, n in inner.items() if c not in made], *made)


def strongest(runs: Column) -> Column:
    """The run of greatest length / period, exactly; ties by smallest start, then period. Null without runs."""
    def order(a, b):
        one, other = a["length"] * b["period"], b["length"] * a["period"]
        return (
            F.when(one != other, F.when(one > other, -1).otherwise(1))
            .when(a["start"] != b["start"], F.when(a["start"] < b["start"], -1).otherwise(1))
            .otherwise(F.when(a["period"] < b["period"], -1).when(a["period"] > b["period"], 1).otherwise(0))
        )

    return F.try_element_at(F.array_sort(runs, order), F.lit(1))


ship_with_tasks(__name__)
