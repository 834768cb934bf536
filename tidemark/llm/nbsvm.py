"""Quality classifier: a linear support vector machine on n-gram indicators scaled by naive Bayes ratios.

Indicators, hashed to `FEATURES` places: words, pairs of words, and runs of three word shapes (the
kinds of characters in a word and whether it repeats the one before). Each is scaled by the log
ratio of its shares in both classes, counted over all labelled rows given. The weights are fitted
by dual coordinate descent on the hinge loss, over at most `FIT_ROWS` rows, half of each class
where there are as many, picked by a hash of the id. Rows are scaled to length one, so long and
short texts have margins of one scale. A logistic curve, fitted on margins from two-fold
cross-fitting and weighted to the class shares of all labelled rows, turns margins into scores.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.words import append_columns, find_words, mix, small_batches, span_hashes, text_chunks
from tidemark.session import named, ship_with_tasks, small_or_not

FEATURES = 1 << 18
FIT_ROWS = 8_000
EPOCHS, COST, SMOOTHING, BETA = 15, 1.0, 1.0, 0.25
COUNT_BLOCK = 4096

_LOWERED = np.arange(256, dtype=np.uint8)
_LOWERED[ord("A"):ord("Z") + 1] += 32
_SHAPE = np.full(256, 1, np.int64)  # bits: other letters and marks, lower, upper, digit, symbol, sentence mark
_SHAPE[ord("a"):ord("z") + 1] = 2
_SHAPE[ord("A"):ord("Z") + 1] = 4
_SHAPE[ord("0"):ord("9") + 1] = 8
_SHAPE[list(b"#*$%&|<>@~^=+_/\\")] = 16
_SHAPE[list(b".,;:!?")] = 32
_SHAPE[0x80:] = 2


def features(words) -> tuple[np.ndarray, np.ndarray]:
    """(text number, feature) of the indicators of each text, in order, each once."""
    n = len(words.starts)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    one = span_hashes(_LOWERED[words.data], words.starts, words.ends)
    edges = np.stack([words.starts, words.ends], 1).reshape(-1)
    kinds = np.bitwise_or.reduceat(_SHAPE[words.data], edges[:-1] if edges[-1] == len(words.data) else edges)[::2]
    same_text = words.text[1:] == words.text[:-1]
    repeats = np.concatenate([[False], same_text & (one[1:] == one[:-1])])
    shape = (kinds * 2 + repeats).astype(np.uint64)
    pairs = mix(one[:-1] * np.uint64(3) + one[1:])[same_text]
    three = words.text[2:] == words.text[:-2]
    shapes = mix((shape[:-2] << np.uint64(40)) + (shape[1:-1] << np.uint64(20)) + shape[2:] + np.uint64(1 << 62))[three]
    text = np.concatenate([words.text, words.text[1:][same_text], words.text[2:][three]])
    found = np.concatenate([one, pairs, shapes]) % np.uint64(FEATURES)
    keys = np.sort(text.astype(np.uint64) * np.uint64(FEATURES) + found)
    keys = keys[np.diff(keys, prepend=keys[:1] + np.uint64(1)) != 0]
    return (keys // np.uint64(FEATURES)).astype(np.int64), (keys % np.uint64(FEATURES)).astype(np.int64)


@dataclass
class Classifier:
    """Score of a text: logistic(slope x (weights . x / |x| + bias) + offset), x the scaled indicators."""

    ratios: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def scores(self, words) -> np.ndarray:
        n = len(words.counts)
        text, found = features(words)
        margin = np.bincount(text, (self.ratios * self.weights)[found], n)
        length = np.sqrt(np.bincount(text, self.ratios[found] ** 2, n))
        margin = margin / np.where(length > 0, length, 1) + self.bias
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -500, 500)))


def log_count_ratios(labelled: DataFrame) -> tuple[np.ndarray, int, int]:
    """Naive Bayes ratios over all rows (label, text), and the rows of both classes."""
    def count(batches):
        counts, rows = np.zeros((2, FEATURES), np.int32), [0, 0]
        for batch in batches:
            label = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for first, last, data, bounds in text_chunks(batch.column(1)):
                text, found = features(find_words(data, bounds))
                for k in (0, 1):
                    counts[k] += np.bincount(found[label[first:last][text] == k], minlength=FEATURES).astype(np.int32)
                    rows[k] += int((label[first:last] == k).sum())
        blocks = counts.reshape(2, -1, COUNT_BLOCK)
        keys = [(k, b) for k in (0, 1) for b in range(blocks.shape[1]) if blocks[k, b].any()]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([k for k, _ in keys] + [0, 1], pa.int32()), pa.array([b for _, b in keys] + [-1, -1], pa.int32()),
                pa.array([blocks[k, b].tobytes() for k, b in keys] + [np.array([r], np.int32).tobytes() for r in rows], pa.binary()),
            ],
            ["label", "block", "counts"],
        )

    def add(group: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(c, np.int32 if len(c) <= 4 * COUNT_BLOCK else np.int64).astype(np.int64) for c in group["counts"])
        return pd.DataFrame({"label": group["label"].iloc[:1], "block": group["block"].iloc[:1], "counts": [total.tobytes()]})

    parts = labelled.select("label", "text").mapInArrow(count, "label int, block int, counts binary")
    totals, rows = np.full((2, FEATURES), SMOOTHING), [0, 0]
    for row in parts.groupBy("label", "block").applyInPandas(add, "label int, block int, counts binary").collect():
        counts = np.frombuffer(row.counts, np.int64)
        if row.block < 0:
            rows[row.label] = int(counts[0])
        else:
            totals[row.label, row.block * COUNT_BLOCK:(row.block + 1) * COUNT_BLOCK] += counts
    shares = np.log(totals / totals.sum(1, keepdims=True))
    return shares[1] - shares[0], rows[0], rows[1]


def dual_descent(rows: list[tuple[np.ndarray, np.ndarray]], signs: np.ndarray, epochs: int, cost: float) -> tuple[np.ndarray, float]:
    """Weights and bias of the linear hinge-loss machine over sparse rows (features, values) of length one."""
    weights, bias, alpha = np.zeros(FEATURES), 0.0, np.zeros(len(rows))
    random = np.random.default_rng(11)
    norms = np.array([float(v @ v) + 1.0 for _, v in rows])
    for _ in range(epochs):
        moved = 0.0
        for i in random.permutation(len(rows)):
            at, values = rows[i]
            gradient = signs[i] * (weights[at] @ values + bias) - 1
            new = min(max(alpha[i] - gradient / norms[i], 0.0), cost)
            step = (new - alpha[i]) * signs[i]
            if step:
                weights[at] += step * values
                bias += step
                moved = max(moved, abs(step))
                alpha[i] = new
        if moved < 1e-3:
            break
    flat = np.abs(weights).mean()
    return (1 - BETA) * flat + BETA * weights if BETA < 1 else weights, bias


def logistic(margins: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the weighted logistic fit, by Newton steps with a slight pull to zero."""
    x, theta = np.stack([margins, np.ones_like(margins)], 1), np.zeros(2)
    weights = weights / weights.sum()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        gradient = x.T @ (weights * (p - labels)) + 1e-4 * theta
        hessian = (x * (weights * p * (1 - p))[:, None]).T @ x + 1e-4 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        theta -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(theta[0]), float(theta[1])


def fit(labelled: DataFrame, fit_rows: int = FIT_ROWS) -> Classifier:
    """Fit on rows (id, label 0 or 1, text). With one class or no rows, every score is that class's share, or a half."""
    small_batches(labelled.sparkSession)
    ratios, negatives, positives = log_count_ratios(labelled)
    if not negatives or not positives:
        share = (positives + 1) / (negatives + positives + 2)
        return Classifier(ratios, np.zeros(FEATURES), 0.0, 0.0, float(np.log(share / (1 - share))))

    pick = F.xxhash64(F.lit("fit"), "id", "text")
    picked = None
    for label in (0, 1):
        mine = labelled.where(F.col("label") == label)
        cut = mine.select(pick.alias("pick")).orderBy("pick").limit(fit_rows // 2).agg(F.max("pick")).first()[0]
        part = mine.where(pick <= cut).dropDuplicates(["id", "text"])  # equal rows have one hash and would pass any bound
        picked = part if picked is None else picked.unionByName(part)

    def sparse(batches):
        for batch in batches:
            for first, last, data, bounds in text_chunks(batch.column(2)):
                text, found = features(find_words(data, bounds))
                ends = np.searchsorted(text, np.arange(last - first + 1)).tolist()
                packed = [found[a:b].astype(np.int32).tobytes() for a, b in zip(ends, ends[1:])]
                part = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(packed, pa.binary())], ["pick", "label", "found"])

    rows = picked.select(pick.alias("pick"), F.col("label").cast("int"), "text").mapInArrow(sparse, "pick long, label int, found binary")
    held = sorted(rows.collect(), key=lambda r: (r.pick, r.label))[: 2 * fit_rows]
    vectors = []
    for row in held:
        at = np.frombuffer(row.found, np.int32)
        values = ratios[at]
        length = np.sqrt(values @ values)
        vectors.append((at, values / length if length else values))
    labels = np.array([r.label for r in held])
    signs = labels * 2.0 - 1
    fold = np.arange(len(held)) % 2
    margins = np.zeros(len(held))
    for k in (0, 1):
        inside = np.flatnonzero(fold != k)
        w, b = dual_descent([vectors[i] for i in inside], signs[inside], EPOCHS, COST)
        for i in np.flatnonzero(fold == k):
            margins[i] = w[vectors[i][0]] @ vectors[i][1] + b
    shares = np.where(labels == 1, positives / max((labels == 1).sum(), 1), negatives / max((labels == 0).sum(), 1))
    slope, offset = logistic(margins, labels, shares)
    weights, bias = dual_descent(vectors, signs, EPOCHS, COST)
    return Classifier(ratios, weights, bias, slope, offset)


def held_out(key: Column, folds: int, fold: int) -> Column:
    """Whether the crc32 of a key as text (null: empty) leaves the remainder `fold`."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % folds == fold


def labelled_rows(docs: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """(id, label, text) of the documents with a label; of several labels the most frequent, 1 in a tie."""
    one = labels.where(F.col(label).isin(0, 1)).groupBy(F.col("doc_id").alias("id")).agg((F.avg(label) >= 0.5).cast("int").alias("label"))
    rows = docs.select(F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.join(small_or_not(one), "id").select("id", "label", "text")


def score(df: DataFrame, model: Classifier, text: str = "text", out: str = "score") -> DataFrame:
    """`df` with the score of each text; a null text is scored as an empty one."""
    shared = df.sparkSession.sparkContext.broadcast(model)  # of a fixed size: FEATURES weights and ratios

    def start():
        def work(column: pa.Array) -> list[pa.Array]:
            parts = [shared.value.scores(find_words(data, bounds)) for _, _, data, bounds in text_chunks(column)]
            return [pa.array(np.concatenate(parts) if parts else np.empty(0))]

        return work

    return append_columns(df, text, T.StructType([T.StructField(out, T.DoubleType())]), start)


ship_with_tasks(__name__)
