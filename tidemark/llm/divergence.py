"""Quality rules: how far a document's character classes and common words lie from its language's.

References are learned from all documents. For each language: the shares of the character
classes, and of the common words, which are those in at least `COMMON_SHARE` of its documents.
They are found exactly in two passes. A task reports words in half that share of its own
documents, so a word that it leaves out has at most that many there; what can still reach the
share after adding these bounds, at most a few thousand words, is then counted exactly. The
shares themselves are those of the half of a language's documents whose character classes are
nearest to those of all its documents, so that junk does not shape what it is compared with.

A document is compared by the Jensen-Shannon distance (base 2, 0 to 1) with its language's
reference, or with the nearest one if its language is null; where a stated language has none, the
base rule decides alone. A distance is only used
from a minimum length on, and short documents get a larger limit, as chance alone moves a
histogram of k bins and n items by about sqrt(k / n).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.words import SEPARATOR, append_columns, covered, find_words, mix, small_batches, span_hashes, spans_of, text_chunks, window_starts, windows
from tidemark.session import named, ship_with_tasks

COMMON_SHARE = 0.05
MIN_DOCUMENTS = 1  # of a language with a reference, whatever its share of all documents
MIN_WORDS = 50
MIN_CHARS = 200
MAX_REPEATED = 0.5
CHAR_LIMIT, WORD_LIMIT = 0.16, 0.6
NOISE = 0.1  # times sqrt(bins / items), added to a limit
FLUSH_BYTES = 64 << 20

SYMBOLS = np.isin(np.arange(256), list(b"#*$%&|<>"))  # fixed: the contract's symbols
# class of a character by the first byte of its UTF-8 form
CLASSES = ["lower", "upper", "digit", "separator", "sentence mark", "bracket or quote", "symbol", "control", "latin-1", "two bytes", "three bytes", "four bytes"]
_CLASS = np.full(256, 6)
_CLASS[ord("a"):ord("z") + 1] = 0
_CLASS[ord("A"):ord("Z") + 1] = 1
_CLASS[ord("0"):ord("9") + 1] = 2
_CLASS[SEPARATOR] = 3
_CLASS[list(b".,;:!?-")] = 4
_CLASS[list(b"()[]{}'\"")] = 5
_CLASS[[b for b in range(32) if not SEPARATOR[b]] + [127]] = 7
_CLASS[0xC2:0xC4] = 8
_CLASS[0xC4:0xE0] = 9
_CLASS[0xE0:0xF0] = 10
_CLASS[0xF0:] = 11
_CLASS[0x80:0xC0] = -1  # the further bytes of a character
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[ord("A"):ord("Z") + 1] += 32


def per_text(mask: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How many bytes of each text are marked."""
    return np.diff(np.concatenate([[0], np.cumsum(mask)])[bounds])


def char_classes(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Characters of each class, by text."""
    kind, n = _CLASS[data], len(bounds) - 1
    text = np.repeat(np.arange(n), np.diff(bounds))
    first = kind >= 0
    return np.bincount(text[first] * len(CLASSES) + kind[first], minlength=n * len(CLASSES)).reshape(n, -1)


def lowered_words(words) -> np.ndarray:
    """Hashes of the words with A to Z in lower case."""
    return span_hashes(LOWERED[words.data], words.starts, words.ends)


def base_counts(words) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of each text."""
    data, bounds, n = words.data, words.bounds, len(words.counts)
    solid = ~SEPARATOR[data]
    starts, ends = spans_of(data != 0x0A, bounds)
    before = np.concatenate([[0], np.cumsum(solid)])
    filled = before[ends] > before[starts]
    starts, ends = starts[filled], ends[filled]
    line_text = np.searchsorted(bounds, starts, "right") - 1
    lines = span_hashes(data, starts, ends, 1)
    order = np.lexsort((lines, line_text))
    same = (line_text[order][1:] == line_text[order][:-1]) & (lines[order][1:] == lines[order][:-1])

    at = window_starts(words, 3)
    repeats = at
    if len(at):
        keys = windows(words.hashes(0), 3, 0)[at] ^ mix(words.text[at].astype(np.uint64) + np.uint64(1))
        by_key = np.argsort(keys, kind="stable")
        sorted_keys = keys[by_key]
        equal = sorted_keys[1:] == sorted_keys[:-1]
        repeats = at[by_key[np.concatenate([equal, [False]]) | np.concatenate([[False], equal])]]
    again = covered(len(words.starts), repeats, 3)
    return {
        "n_words": words.counts,
        "word_chars": per_text(solid & ((data & 0xC0) != 0x80), bounds),
        "n_symbols": per_text(SYMBOLS[data], bounds),
        "n_dup_lines": np.bincount(line_text[order][1:][same], minlength=n),
        "n_repeat_words": np.bincount(words.text[again], minlength=n),
    }


def distances(counts: np.ndarray, reference: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of each row of counts to the reference shares; 1 for an empty row."""
    total = counts.sum(1, keepdims=True)
    p = counts / np.maximum(total, 1)
    m = (p + reference) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        left = np.where(p > 0, p * np.log2(p / m), 0).sum(1)
        right = np.where(reference > 0, reference * np.log2(reference / m), 0).sum(1)
    return np.where(total[:, 0] > 0, np.sqrt(np.clip((left + right) / 2, 0, 1)), 1.0)


@dataclass
class Reference:
    """Shares of the character classes; sorted hashes of the common words and their shares, other words last."""

    classes: np.ndarray
    words: np.ndarray
    shares: np.ndarray


def _lang_texts(df: DataFrame, text: str, lang: str) -> DataFrame:
    return df.select(F.translate(named(lang).cast("string"), "\x01", "").alias("lang"), named(text).alias("text"))


def _by_language(batch):
    """(language, texts) of a batch, nulls left out."""
    langs = batch.column(0)
    for lang in langs.unique().to_pylist():
        if lang is not None:
            yield lang, batch.column(1).filter(pa.compute.equal(langs, lang))


def _reported(batches):
    """A task's character classes, and the words in half the common share of its documents."""
    import pyarrow.compute  # noqa: F401  used as pa.compute

    held: dict[str, list] = {}
    size = 0

    def emit():
        for lang, (n, classes, keys) in held.items():
            keys, docs = np.unique(np.concatenate(keys), return_counts=True)
            often = docs >= COMMON_SHARE / 2 * n
            k, c = int(often.sum()), len(CLASSES)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * (k + c), pa.string()), pa.array([True] * k + [False] * c),
                    pa.array(np.concatenate([keys[often].view(np.int64), np.arange(c)])),
                    pa.array(np.concatenate([docs[often], classes])), pa.array([n] * k + [n if i == 0 else 0 for i in range(c)], pa.int64()),
                ],
                ["lang", "word", "key", "found", "docs"],
            )

    for batch in batches:
        for lang, texts in _by_language(batch):
            for first, last, data, bounds in text_chunks(texts):
                words = find_words(data, bounds)
                hashes = lowered_words(words)
                order = np.lexsort((hashes, words.text))
                new = np.ones(len(order), bool)
                new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (words.text[order][1:] != words.text[order][:-1])
                mine = held.setdefault(lang, [0, np.zeros(len(CLASSES), np.int64), []])
                mine[0] += last - first
                mine[1] += char_classes(data, bounds).sum(0)
                mine[2].append(hashes[order][new])
                size += len(data)
        if size >= FLUSH_BYTES:
            yield from emit()
            held, size = {}, 0
    yield from emit()


def learn_references(df: DataFrame, text: str = "text", lang: str = "lang") -> dict[str, Reference]:
    """Reference of each language that has `MIN_DOCUMENTS` documents or more."""
    spark, rows = df.sparkSession, _lang_texts(df, text, lang)
    small_batches(spark)
    reported = rows.mapInArrow(_reported, "lang string, word boolean, key long, found long, docs long")
    sums = reported.groupBy("lang", "word", "key").agg(F.sum("found").alias("found"), F.sum("docs").alias("docs"))
    sums = sums.persist()
    classes = sums.where("NOT word").toPandas()  # a few rows per language
    sizes = classes[classes["key"] == 0].set_index("lang")["docs"]
    sizes = sizes[sizes >= MIN_DOCUMENTS]
    if not len(sizes):
        sums.unpersist()
        return {}
    known = spark.createDataFrame([(k, int(v)) for k, v in sizes.items()], "lang string, n long")
    # found + half the share of the documents that did not report it must reach the share
    most = F.col("found") + COMMON_SHARE / 2 * (F.col("n") - F.col("docs"))
    candidates = sums.where("word").join(F.broadcast(known), "lang").where(most >= COMMON_SHARE * F.col("n")).select("lang", "key").toPandas()
    sums.unpersist()
    keys = {k: np.empty(0, np.uint64) for k in sizes.index}
    keys |= {k: np.sort(g["key"].to_numpy().view(np.uint64)) for k, g in candidates.groupby("lang")}
    centres = {k: g.sort_values("key")["found"].to_numpy(float) for k, g in classes.groupby("lang")}
    shared = spark.sparkContext.broadcast({k: (keys[k], centres[k] / max(centres[k].sum(), 1)) for k in keys})

    def count(batches):
        import pyarrow.compute  # noqa: F401

        n_bins, c = 100, len(CLASSES)
        sums, size = {}, 0

        def emit():
            for lang, rows in sums.items():
                at, column = np.nonzero(rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array(column, pa.int64()), pa.array(rows[at, column])],
                    ["lang", "near", "at", "total"],
                )

        for batch in batches:
            for lang, texts in _by_language(batch):
                if lang not in shared.value:
                    continue
                common, centre = shared.value[lang]
                if lang not in sums:
                    sums[lang] = np.zeros((n_bins + 1, 2 * len(common) + c + 2), np.int64)
                    size += sums[lang].nbytes
                for _, _, data, bounds in text_chunks(texts):
                    words, kinds = find_words(data, bounds), char_classes(data, bounds)
                    counts = _histogram(words, lowered_words(words), common)
                    near = (distances(kinds, centre) * n_bins).astype(np.int64)
                    row = np.concatenate([counts[:, :-1] > 0, counts, kinds, np.ones((len(near), 1), np.int64)], 1)
                    np.add.at(sums[lang], near, row)
                if size >= FLUSH_BYTES:  # many languages
                    yield from emit()
                    sums.clear()
                    size = 0
        yield from emit()

    counted = rows.mapInArrow(count, "lang string, near long, at long, total long")
    counted = counted.groupBy("lang", "near", "at").agg(F.sum("total").alias("total")).persist()
    place = {k: 2 * len(v) + len(CLASSES) + 1 for k, v in keys.items()}
    places = spark.createDataFrame([(k, v, int(sizes[k])) for k, v in place.items()], "lang string, docs_at int, n long")
    placed = counted.join(F.broadcast(places), "lang")
    spread = placed.where("at = docs_at").toPandas()  # documents by distance: at most 101 rows per language
    cuts = []
    for name, g in spread.sort_values("near").groupby("lang"):
        half = g["total"].cumsum() >= g["total"].sum() / 2
        cuts.append((name, int(g["near"][half].iloc[0])))
    cut = spark.createDataFrame(cuts, "lang string, cut long")
    whole = counted.groupBy("lang", "at").agg(F.sum("total").alias("whole"))
    core = counted.join(F.broadcast(cut), "lang").where("near <= cut").groupBy("lang", "at").agg(F.sum("total").alias("core"))
    sums = whole.join(core, ["lang", "at"], "left").toPandas().fillna(0)
    counted.unpersist()
    out = {}
    for name, n in sizes.items():
        k, mine = len(keys[name]), sums[sums["lang"] == name]
        every, core = np.zeros(place[name] + 1), np.zeros(place[name] + 1)
        every[mine["at"].to_numpy(int)], core[mine["at"].to_numpy(int)] = mine["whole"], mine["core"]
        common, found = every[:k] >= COMMON_SHARE * n, core[k:2 * k + 1]
        shares = np.append(found[:-1][common], found.sum() - found[:-1][common].sum())
        kinds = core[2 * k + 1:-1]
        out[name] = Reference(kinds / max(kinds.sum(), 1), keys[name][common], shares / max(shares.sum(), 1))
    return out


def _histogram(words, hashes: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Counts of the common words in each text, other words last."""
    k, n = len(common), len(words.counts)
    at = np.searchsorted(common, hashes)
    at = np.where((at < k) & (common[np.minimum(at, k - 1)] == hashes), at, k) if k else np.zeros(len(hashes), np.int64)
    return np.bincount(words.text * (k + 1) + at, minlength=n * (k + 1)).reshape(n, k + 1)


RULES = T.StructType([
    *[T.StructField(c, T.LongType()) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
    T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType()),
    T.StructField("char_distance", T.DoubleType()), T.StructField("word_distance", T.DoubleType()),
])


def quality_rules(
    df: DataFrame, text: str = "text", lang: str = "lang", char_limit: float = CHAR_LIMIT, word_limit: float = WORD_LIMIT
) -> DataFrame:
    """`df` with counts, distances and the verdict `kept`; columns of these names are replaced.

    A null or empty text has counts of zero and fails the base rule (fewer than `MIN_WORDS`
    words). Without any reference, distances are null and the base rule decides.
    """
    references = df.sparkSession.sparkContext.broadcast(learn_references(df, text, lang))
    tagged = df.select(*[named(c) for c in df.columns], F.concat_ws("\x01", F.translate(F.coalesce(named(lang).cast("string"), F.lit("")), "\x01", ""), F.coalesce(named(text), F.lit(""))).alias("_tagged"))

    def start():
        def work(column: pa.Array) -> list[pa.Array]:
            pairs = [t.split("\x01", 1) for t in column.to_pylist()]
            return judge(pa.array([t for _, t in pairs], pa.string()), [name for name, _ in pairs], references.value, char_limit, word_limit)

        return work

    return append_columns(tagged, "_tagged", RULES, start).drop("_tagged")


def judge(column: pa.Array, langs: list[str], references: dict[str, Reference], char_limit: float, word_limit: float) -> list[pa.Array]:
    out: dict[str, list] = {f.name: [] for f in RULES}
    for first, last, data, bounds in text_chunks(column):
        words = find_words(data, bounds)
        counts, classes, hashes = base_counts(words), char_classes(data, bounds), lowered_words(words)
        n_chars, n_words = classes.sum(1), words.counts
        own = np.array(langs[first:last], object)
        by_char, by_word = np.full(last - first, np.inf), np.full(last - first, np.inf)
        bins = np.zeros(last - first)
        unstated = (own == "") & ("" not in references)
        for name in references if unstated.any() else sorted(set(own) & references.keys()):
            ref, fits = references[name], (own == name) | unstated
            c = distances(classes[fits], ref.classes)
            w = distances(_histogram(words, hashes, ref.words)[fits], ref.shares)
            at = np.flatnonzero(fits)
            nearer = c + w < by_char[at] + by_word[at]
            by_char[at[nearer]], by_word[at[nearer]], bins[at[nearer]] = c[nearer], w[nearer], len(ref.shares)
        none = np.isinf(by_char)
        base_failed = (n_words < MIN_WORDS) | (100 * counts["n_repeat_words"] > 100 * MAX_REPEATED * n_words)
        far_chars = (n_chars >= MIN_CHARS) & (by_char > char_limit + NOISE * np.sqrt(len(CLASSES) / np.maximum(n_chars, 1)))
        far_words = (n_words >= MIN_WORDS) & (by_word > word_limit + NOISE * np.sqrt(bins / np.maximum(n_words, 1)))
        counts |= {"base_failed": base_failed, "kept": ~base_failed & (none | ~(far_chars | far_words))}
        counts |= {"char_distance": np.where(none, np.nan, by_char), "word_distance": np.where(none, np.nan, by_word)}
        for name, values in counts.items():
            out[name].append(values)
    kinds = {"long": pa.int64(), "bigint": pa.int64(), "boolean": pa.bool_(), "double": pa.float64()}
    return [pa.array(np.concatenate(out[f.name]) if out[f.name] else [], kinds[f.dataType.simpleString()], from_pandas=True) for f in RULES]


ship_with_tasks(__name__)
