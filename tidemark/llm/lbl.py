"""Language-model scores from a log-bilinear model trained by noise-contrastive estimation in numpy.

The model predicts a token from the two before it: the vectors of both, each times its own weights
by position, add up to a predicted vector q. Tokens lie in classes, and
P(token) = P(class | q) P(member | class, q), both by products of vectors with q plus a bias.

The vocabulary grows with the training counts. Of V words, the 16 sqrt(V) most frequent have a
member, a context vector and a target vector of their own, and the word of rank r is in class
floor(sqrt(r)), so classes grow as words get rarer. All other words are hashed to `BUCKETS` sqrt(V)
further members, in classes of about as many members as there are such classes; a word has its share
of its member's counts. A normaliser runs over all classes and the members of one: a few times the
fourth root of V products a token, 382 classes of at most 315 members at 2.4 million words.

Every task trains on all of its training texts, from the same start, and each row of the models is
averaged by how often the tasks used it, in `ROUNDS` rounds. Counts are exact over all training
texts. The counts of the `HEAD` most frequent words are broadcast; rarer words are joined with the
table of counts.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.words import BYTE_VALUES, SPAN_BASES, find_words, mix, powers, small_batches, span_hashes, text_chunks
from tidemark.session import named, ship_with_tasks, stage

SHORTLIST = 1000  # the fewest words with vectors of their own, and contexts whose pairs have a table of normalisers
OWN_WORDS = 16  # words with vectors of their own, times the square root of all
BUCKETS = 32  # members for hashed words, times the square root of all
HEAD = 1 << 19
WIDTH = 40
ROUNDS = 2
BATCH, NOISE, RATE = 8192, 64, 0.08
INSIDE = 4  # noise words of a token inside its class
BLOCK = 8  # tokens of a class that share them
LAYERS = 8  # rows of a segment that are added with those of all other segments
TILE = 1024  # tokens whose noise classes are looked at at a time: their scores stay in the cache of a processor
SHORT = 24  # bytes of words that are hashed together
SLICE = 4096  # rows of a model that are averaged at a time
SCORED = 256  # tokens whose classes are normalised at a time: their scores stay in the cache of a processor
FLUSH_WORDS = 4_000_000
FAN_IN = 32
TASKS = 6  # training tasks, times the square root of the input in units of 16 MB: models grow as tasks do
START, END = 0, 1  # the first ids; words follow
END_KEY = (-1, -1)  # of the end token in the table of counts

_LOWERED = np.arange(256, dtype=np.uint8)
_LOWERED[ord("A"):ord("Z") + 1] += 32


# by half of a key and place in a word: what each byte adds
_ADDED = [[values * power for power in powers(base, SHORT)] for values, base in zip(BYTE_VALUES, SPAN_BASES)]


def word_keys(words, halves: int = 2) -> tuple[np.ndarray, ...]:
    """128-bit keys of the words with A to Z in lower case, as two signed numbers, or the first of them.

    They are `span_hashes`. Words of at most `SHORT` bytes are looked at together, their first bytes, then
    the second bytes of those that have any, and so on.
    """
    data, lengths = _LOWERED[words.data], words.ends - words.starts
    order = np.argsort(SHORT - np.minimum(lengths, SHORT + 1).astype(np.int16), kind="stable")  # by falling length
    starts, lengths = np.take(words.starts, order), np.take(lengths, order)
    falling = -lengths
    long, left = (int(n) for n in np.searchsorted(falling, [-SHORT, 0]))
    sums = [lengths.astype(np.uint64) for _ in range(halves)]
    for place in range(SHORT):
        left = long + int(np.searchsorted(falling[long:left], -place))  # have a byte there
        if left == long:
            break
        found = np.take(data, starts[long:left] + place)
        for added, total in zip(_ADDED, sums):
            total[long:left] += np.take(added[place], found)
    out = []
    for which, total in enumerate(sums):
        keys = mix(total)
        keys[:long] = span_hashes(data, starts[:long], starts[:long] + lengths[:long], which)
        unsorted = np.empty_like(keys)
        unsorted[order] = keys
        out.append(unsorted.view(np.int64))
    return tuple(out)


# ---- counts -------------------------------------------------------------------------------------

ENTRY = np.dtype([("a", "<i8"), ("b", "<i8"), ("n", "<i8")])


def _summed(entries: np.ndarray) -> np.ndarray:
    order = np.argsort(np.ascontiguousarray(entries["a"]))
    first, second = entries["a"][order], entries["b"][order]
    if ((first[1:] == first[:-1]) & (second[1:] != second[:-1])).any():  # words whose first halves agree
        order = np.lexsort((entries["b"], entries["a"]))
    entries = entries[order]
    new = np.ones(len(entries), bool)
    new[1:] = (entries["a"][1:] != entries["a"][:-1]) | (entries["b"][1:] != entries["b"][:-1])
    firsts = np.flatnonzero(new)
    out = entries[firsts]
    if len(firsts):
        out["n"] = np.add.reduceat(entries["n"], firsts)
    return out


def _pack(entries: np.ndarray) -> bytes:
    more = entries["n"] > 1
    parts = [np.array([len(entries)], "<i8"), entries["a"], entries["b"], more, entries["n"][more]]
    return b"".join(np.ascontiguousarray(p).tobytes() for p in parts)


def _unpack(packed: bytes) -> np.ndarray:
    n = int(np.frombuffer(packed, "<i8", 1)[0])
    out = np.zeros(n, ENTRY)
    out["a"], out["b"] = np.frombuffer(packed, "<i8", n, 8), np.frombuffer(packed, "<i8", n, 8 + 8 * n)
    more = np.frombuffer(packed, bool, n, 8 + 16 * n)
    out["n"] = 1
    out["n"][more] = np.frombuffer(packed, "<i8", offset=8 + 17 * n)
    return out


def token_counts(texts: DataFrame, groups: int) -> DataFrame:
    """(a, b, n): how often each token occurs in the texts, the end of a text included."""
    def count(batches):
        held, size, ends = [], 0, 0
        for batch in batches:
            ends += batch.num_rows
            for _, _, data, bounds in text_chunks(batch.column(0)):
                a, b = word_keys(find_words(data, bounds))
                part = np.zeros(len(a), ENTRY)
                part["a"], part["b"], part["n"] = a, b, 1
                held.append(part)
                size += len(part)
                if size >= FLUSH_WORDS // 4 and len(held) > 1:
                    held = [_summed(np.concatenate(held))]
                    size = len(held[0])
                    if size >= FLUSH_WORDS // 8:
                        yield emit(held[0])
                        held, size = [], 0
        end = np.zeros(1, ENTRY)
        end["a"], end["b"], end["n"] = *END_KEY, ends
        yield emit(_summed(np.concatenate([*held, end[: 1 if ends else 0]])))

    def emit(entries):
        group = (entries["a"].view(np.uint64) % np.uint64(groups)).astype(np.int64)
        order = np.argsort(group, kind="stable")
        group, entries = group[order], entries[order]
        cuts = np.flatnonzero(np.diff(group, prepend=-1)).tolist() + [len(group)]
        return pa.RecordBatch.from_arrays(
            [pa.array([int(group[i]) for i in cuts[:-1]], pa.int64()), pa.array([_pack(entries[i:j]) for i, j in zip(cuts, cuts[1:])], pa.binary())],
            ["part", "entries"],
        )

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        total = _summed(np.concatenate([_unpack(e) for e in group["entries"]]))
        return pd.DataFrame({"a": total["a"], "b": total["b"], "n": total["n"]})

    packed = texts.select("text").mapInArrow(count, "part long, entries binary")
    return packed.groupBy("part").applyInPandas(merge, "a long, b long, n long")


# ---- model --------------------------------------------------------------------------------------

@dataclass
class Model:
    """Vectors of context words, weights by position (nearest first), vectors and biases of classes and of their members.

    Class c has the members `begins[c]` to `begins[c + 1] - 1`; a member is a token and a context.
    """

    context: np.ndarray
    position: np.ndarray
    target: np.ndarray
    bias: np.ndarray
    member: np.ndarray
    member_bias: np.ndarray
    begins: np.ndarray

    @staticmethod
    def start(counts: np.ndarray, width: int = WIDTH, begins: np.ndarray | None = None) -> Model:
        """Without `begins`, each token is a class."""
        random, n = np.random.default_rng(3), len(counts)
        begins = np.arange(n + 1) if begins is None else begins
        share = (counts + 0.5) / (counts + 0.5).sum()
        of_class = np.add.reduceat(share, begins[:-1])
        bias = np.log(of_class).astype(np.float32)
        bias[START] = -30.0  # never predicted
        inside = np.log(share / np.repeat(of_class, np.diff(begins))).astype(np.float32)
        draw = lambda rows: (random.standard_normal((rows, width)) * 0.1).astype(np.float32)
        return Model(draw(n), np.ones((2, width), np.float32), draw(len(bias)), bias, draw(n), inside, begins)

    def rows(self) -> np.ndarray:
        """All vectors, each with its bias: of positions, classes, contexts, members."""
        pairs = ((self.position, None), (self.target, self.bias), (self.context, None), (self.member, self.member_bias))
        return np.concatenate([np.column_stack([v, np.zeros(len(v), np.float32) if b is None else b]) for v, b in pairs])

    def like(self, rows: np.ndarray) -> Model:
        cuts = np.cumsum([2, len(self.target), len(self.context)])
        position, target, context, member = (np.ascontiguousarray(p, np.float32) for p in np.split(rows, cuts))
        strip = lambda p: np.ascontiguousarray(p[:, :-1])
        return Model(strip(context), strip(position), strip(target), target[:, -1].copy(), strip(member), member[:, -1].copy(), self.begins)


def _places(keys: np.ndarray, a: np.ndarray) -> np.ndarray:
    """np.searchsorted, in the order of `a`: near places are in the processor's cache."""
    order, out = np.argsort(a), np.empty(len(a), np.int64)
    out[order] = np.searchsorted(keys, np.take(a, order))
    return out


@dataclass
class Vocabulary:
    """Sorted first halves of the keys of words with own vectors, their tokens, and the hashed tokens that follow, `BUCKETS` times `classes`."""

    keys: np.ndarray
    ids: np.ndarray
    classes: int

    @property
    def first(self) -> int:
        return len(self.keys) + 2

    @property
    def hashed(self) -> int:
        return self.classes * BUCKETS

    def tokens(self, a: np.ndarray) -> np.ndarray:
        out = self.first + a % self.hashed
        if len(self.keys):
            where = np.minimum(_places(self.keys, a), len(self.keys) - 1)
            out = np.where(self.keys[where] == a, self.ids[where], out)
        return out

    def begins(self) -> np.ndarray:
        own = len(self.keys)
        squares = np.arange(int(np.ceil(np.sqrt(own)))) ** 2
        wide = max(int(np.sqrt(self.hashed)), BUCKETS)  # as many members as there are classes
        return np.concatenate([[START, END], 2 + squares, np.arange(self.first, self.first + self.hashed, wide), [self.first + self.hashed]]).astype(np.int64)


def make_vocabulary(head: pd.DataFrame, distinct: int, shortlist: int) -> Vocabulary:
    """`head`: the most frequent words, by falling counts; `distinct`: how many words there are."""
    own = head["a"].to_numpy()[: max(shortlist, OWN_WORDS * int(np.ceil(np.sqrt(distinct))))]
    order = np.argsort(own)
    return Vocabulary(own[order], order + 2, max(int(np.ceil(np.sqrt(distinct - len(own)))), 1))


def token_ids(words, a: np.ndarray, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token, the one before, the one before that) of all texts in a row, each closed by the end token."""
    n, total = len(words.counts), len(a) + len(words.counts)
    at = np.arange(len(a)) + words.text
    tokens = np.full(total, END)
    tokens[at] = vocabulary.tokens(a)
    firsts = words.firsts + np.arange(n)
    one, two = np.empty(total, np.int64), np.empty(total, np.int64)
    one[1:], two[2:] = tokens[:-1], tokens[:-2]
    if total:
        one[firsts] = START
        two[firsts] = START
        seconds = firsts[words.counts > 0] + 1
        two[seconds] = START
    return tokens, one, two


def _order(at: np.ndarray) -> np.ndarray:
    """Stable order of small non-negative numbers: by their low 16 bits, then by the high ones, as numpy sorts 16 bits by radix."""
    order = np.argsort(at.astype(np.uint16), kind="stable")
    high = at >> 16
    return order if not high.any() else np.take(order, np.argsort(np.take(high, order).astype(np.uint16), kind="stable"))


class Segments:
    """Equal numbers of `at`, as segments that are numbered from the longest to the shortest.

    `places`: the number of each segment; `times`: how often it occurs; `of`: the segment of each of `at`.
    """

    def __init__(self, at: np.ndarray):
        self.order = _order(at)
        ordered = np.take(at, self.order)
        begins = np.flatnonzero(np.diff(ordered, prepend=-1))
        times = np.diff(np.append(begins, len(at)))
        by = _order(len(at) - times)
        self.begins, self.times = np.take(begins, by), np.take(times, by)
        self.places = np.take(ordered, self.begins)
        rank = np.empty_like(by)
        rank[by] = np.arange(len(by))
        self.of = np.empty_like(self.order)
        self.of[self.order] = np.repeat(rank, times)

    def sums(self, rows: np.ndarray, where: np.ndarray | None = None) -> np.ndarray:
        """Sums of the rows of each segment; `where`: the row of each of `at`, if not its own.

        Most segments are short: the first rows of all are added at once, then the second rows of those
        that have any, and so on. What longer ones have beyond `LAYERS` rows is added segment by segment.
        """
        order, falling = self.order if where is None else np.take(where, self.order), -self.times
        out = np.take(rows, np.take(order, self.begins), axis=0)
        for layer in range(1, LAYERS):
            several = int(np.searchsorted(falling, -layer))  # have more than `layer` rows
            if not several:
                return out
            out[:several] += np.take(rows, np.take(order, self.begins[:several] + layer), axis=0)
        long = int(np.searchsorted(falling, -LAYERS))
        if long:
            left = self.times[:long] - LAYERS
            firsts = np.cumsum(left) - left
            at = np.arange(int(left.sum())) + np.repeat(self.begins[:long] + LAYERS - firsts, left)
            rest = np.take(rows, np.take(order, at), axis=0)
            # pairs of numbers are added as one complex number, which is about twice as fast
            paired = rest.dtype == np.float32 and rest.shape[1] % 2 == 0
            out[:long] += np.add.reduceat(rest.view(np.complex64), firsts, axis=0).view(np.float32) if paired else np.add.reduceat(rest, firsts, axis=0)
        return out


def _sigmoid_of_minus(x: np.ndarray) -> np.ndarray:
    """1 / (1 + exp(x)), in place."""
    np.minimum(x, 30, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


class Trainer:
    """Mini-batches of noise-contrastive estimation with AdaGrad steps.

    The noise classes of a batch are shared. Each token has noise members of its own class, drawn evenly;
    up to `BLOCK` tokens of a class in a batch have the same.
    """

    def __init__(self, model: Model, counts: np.ndarray, seed: int, rate: float = RATE):
        self.m, self.rate, self.tokens = model, rate, 0
        self.random = np.random.default_rng(seed)
        self.sizes = np.diff(model.begins)
        self.class_of = np.repeat(np.arange(len(self.sizes)), self.sizes)
        share = np.add.reduceat((counts + 0.5).astype(float), model.begins[:-1])
        share[START] = 0
        self.share = share / share.sum()
        self.upto = np.cumsum(self.share)
        self.upto /= self.upto[-1]
        self.log_noise = np.log(NOISE * np.maximum(self.share, 1e-30)).astype(np.float32)
        self.log_inside = np.log(INSIDE / self.sizes).astype(np.float32)
        self.squares = [np.full(p.shape, 1e-6, np.float32) for p in (model.position, model.target, model.bias)]
        # a rare row has few steps, so its sums are not divided by the batch
        self.row_squares = [np.full(p.shape, 1.0, np.float32) for p in (model.context, model.member)]
        self.bias_squares = np.full(len(model.member), 1.0, np.float32)
        self.slot = np.full(len(model.context), -1)  # free between steps
        self.used = [np.zeros(len(p), np.float32) for p in (model.context, model.member)]

    def _update(self, which: int, vectors: np.ndarray, now: np.ndarray, places: np.ndarray, times: np.ndarray, sums: np.ndarray) -> None:
        """A step of the rows `now` at `places`, along `sums`, which are lost."""
        self.used[which][places] += times
        squares = np.take(self.row_squares[which], places, axis=0)
        squares += sums * sums
        self.row_squares[which][places] = squares
        np.sqrt(squares, out=squares)
        sums *= np.float32(self.rate)
        sums /= squares
        sums += now
        vectors[places] = sums

    def _blocks(self, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first token, tokens) of the runs of up to `BLOCK` tokens of one class; `kind` is sorted."""
        begins = np.flatnonzero(np.diff(kind, prepend=-1))
        lengths = np.diff(np.append(begins, len(kind)))
        blocks = -(-lengths // BLOCK)
        within = np.arange(int(blocks.sum())) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        first = np.repeat(begins, blocks) + BLOCK * within
        return first, np.minimum(np.repeat(lengths, blocks) - BLOCK * within, BLOCK)

    def step(self, token: np.ndarray, one: np.ndarray, two: np.ndarray) -> None:
        m, n, width = self.m, len(token), self.m.context.shape[1]
        order = _order(np.take(self.class_of, token))
        token, one, two = np.take(token, order), np.take(one, order), np.take(two, order)
        kind = np.take(self.class_of, token)
        noise = np.searchsorted(self.upto, self.random.random(NOISE), side="right")

        # the vector of a context is looked up and weighted once for each position
        near, far = Segments(one), Segments(two)
        first, second = np.take(m.context, near.places, axis=0), np.take(m.context, far.places, axis=0)
        predicted = np.take(first * m.position[0], near.of, axis=0)
        predicted += np.take(second * m.position[1], far.of, axis=0)

        wanted = np.take(m.target, kind, axis=0)
        up = np.einsum("ij,ij->i", predicted, wanted)
        up += np.take(m.bias - self.log_noise, kind)
        up = _sigmoid_of_minus(up)
        back = wanted
        back *= up[:, None]
        noise, times = np.unique(noise, return_counts=True)  # a class that is drawn several times is looked at once
        minus, shift = -m.target[noise], (self.log_noise[noise] - m.bias[noise])[:, None]
        pushed = minus * times.astype(np.float32)[:, None]
        away, real = np.zeros_like(minus), np.zeros(len(noise), np.float32)
        tile, ones = np.empty((len(noise), TILE), np.float32), np.ones(TILE, np.float32)
        for i in range(0, n, TILE):
            rows = predicted[i:i + TILE]
            down = np.matmul(minus, rows.T, out=tile[:, :len(rows)])
            down += shift
            down = _sigmoid_of_minus(down)  # the chance, by the model, that each noise class is real
            back[i:i + TILE] += down.T @ pushed
            away += down @ rows
            real += down @ ones[:len(rows)]

        begin, length = self._blocks(kind)
        held = np.arange(BLOCK) < length[:, None]
        at = np.flatnonzero(held)
        q = np.take(predicted, np.minimum(begin[:, None] + np.arange(BLOCK), n - 1), axis=0)
        kinds = np.take(kind, begin)
        sizes = np.take(self.sizes, kinds)
        several = sizes > 1
        # a float just below one may round up to the size
        drawn = (self.random.random((len(begin), INSIDE), dtype=np.float32) * sizes.astype(np.float32)[:, None]).astype(np.int64)
        drawn = np.minimum(drawn, (sizes - 1)[:, None]) + np.take(m.begins, kinds)[:, None]
        # the tokens' members, then the noise members of each block
        members = Segments(np.concatenate([token, drawn.ravel()]))
        vectors, biases = np.take(m.member, members.places, axis=0), np.take(m.member_bias, members.places)
        of_noise = members.of[n:].reshape(drawn.shape)
        noise_vectors = np.take(vectors, of_noise, axis=0)
        pull = np.empty((len(begin), BLOCK, INSIDE + 1), np.float32)  # of the noise members, and of the class
        inside = q @ noise_vectors.transpose(0, 2, 1)
        inside += (np.take(biases, of_noise) - np.take(self.log_inside, kinds)[:, None])[:, None, :]
        np.negative(inside, out=inside)
        np.multiply(_sigmoid_of_minus(inside), -(held & several[:, None]).astype(np.float32)[:, :, None], out=pull[:, :, :INSIDE])
        pull[:, :, INSIDE] = 0
        pull.reshape(-1, INSIDE + 1)[at, INSIDE] = up
        back += np.take((pull[:, :, :INSIDE] @ noise_vectors).reshape(-1, width), at, axis=0)

        alone = np.take(self.sizes, kind) == 1
        wanted = np.take(vectors, members.of[:n], axis=0)
        hit = np.einsum("ij,ij->i", predicted, wanted)
        hit += np.take(biases, members.of[:n]) - np.take(self.log_inside, kind)
        np.negative(hit, out=hit)
        hit = 1 - _sigmoid_of_minus(hit)
        hit[alone] = 0
        wanted *= hit[:, None]
        back += wanted
        # gradients: of the tokens, then of each block's noise members and class
        moves = np.empty((n + len(begin) * (INSIDE + 1), width), np.float32)
        np.multiply(predicted, hit[:, None], out=moves[:n])
        sums = np.matmul(pull.transpose(0, 2, 1), q, out=moves[n:].reshape(len(begin), INSIDE + 1, width))
        target = np.zeros_like(m.target)
        new = np.flatnonzero(np.diff(kinds, prepend=-1))
        target[kinds[new]] = np.add.reduceat(sums[:, INSIDE], new, axis=0)
        target[noise] -= away * times[:, None]
        bias = np.bincount(kind, up, len(m.bias))
        bias[noise] -= real * times

        where = np.concatenate([np.arange(n), (n + np.arange(len(begin))[:, None] * (INSIDE + 1) + np.arange(INSIDE)).ravel()])
        times = np.concatenate([~alone, np.repeat(length * several, INSIDE)])
        times = np.bincount(members.of, times, len(members.places))
        sums = np.bincount(members.of, np.concatenate([hit, pull[:, :, :INSIDE].sum(1).ravel()]), len(members.places))
        self._update(1, m.member, vectors, members.places, times, members.sums(moves, where))
        squares = np.take(self.bias_squares, members.places) + sums * sums
        self.bias_squares[members.places] = squares
        m.member_bias[members.places] = biases + self.rate * sums / np.sqrt(squares)

        moves, more = near.sums(back), far.sums(back)
        position = np.stack([np.einsum("ij,ij->j", moves, first), np.einsum("ij,ij->j", more, second)])
        moves *= m.position[0]
        more *= m.position[1]
        self.slot[near.places] = np.arange(len(near.places))
        at = np.take(self.slot, far.places)  # of a context at both positions
        self.slot[near.places] = -1
        both, alone = np.flatnonzero(at >= 0), np.flatnonzero(at < 0)
        moves[at[both]] += np.take(more, both, axis=0)
        near.times[at[both]] += far.times[both]
        self._update(0, m.context, first, near.places, near.times, moves)
        self._update(0, m.context, np.take(second, alone, axis=0), far.places[alone], far.times[alone], np.take(more, alone, axis=0))
        for p, g, s in zip((m.position, m.target, m.bias), (position, target, bias), self.squares):
            g = (g / n).astype(np.float32)
            s += g * g
            p += self.rate * g / np.sqrt(s)
        self.tokens += n

    def weights(self) -> np.ndarray:
        """How much each row of the model counts in the mean."""
        return np.concatenate([np.full(2 + len(self.m.bias), self.tokens, np.float32), *self.used])


def train_round(texts: DataFrame, model: Model, counts: np.ndarray, vocabulary: Vocabulary, seed: int, rate: float) -> Model:
    """The mean of the models that the tasks train from `model`; each row by how often a task used it."""
    spark = texts.sparkSession
    shared = spark.sparkContext.broadcast((model, counts, vocabulary))  # grows with the square root of the vocabulary
    width = model.context.shape[1] + 1

    def train(batches):
        start, counts, vocabulary = shared.value
        before = start.rows()
        own = start.like(before)
        trainer, held, size = Trainer(own, counts, seed + TaskContext.get().partitionId(), rate), [], 0
        for batch in batches:
            for _, _, data, bounds in text_chunks(batch.column(0)):
                words = find_words(data, bounds)
                held.append(np.stack(token_ids(words, *word_keys(words, 1), vocabulary)))
                size += held[-1].shape[1]
                if size >= BATCH:
                    rows = np.concatenate(held, 1)
                    rows = np.take(rows, trainer.random.permutation(rows.shape[1]), axis=1)
                    whole = rows.shape[1] // BATCH * BATCH
                    for i in range(0, whole, BATCH):
                        trainer.step(*rows[:, i:i + BATCH])
                    held, size = [rows[:, whole:]], rows.shape[1] - whole
        if size:
            trainer.step(*np.concatenate(held, 1))
        if trainer.tokens:
            moved, weights = own.rows() - before, trainer.weights()
            for i in range(0, len(moved), SLICE):
                if weights[i:i + SLICE].any():
                    yield packed(TaskContext.get().partitionId(), i, moved[i:i + SLICE], weights[i:i + SLICE])

    def packed(salt, first, moved, weights):
        return pa.RecordBatch.from_pydict({"salt": pa.array([salt], pa.int64()), "first": pa.array([first], pa.int64()), "moved": pa.array([moved.astype(np.float16).tobytes()], pa.binary()), "weights": pa.array([weights.astype(np.float32).tobytes()], pa.binary())})

    def add(group: pd.DataFrame) -> pd.DataFrame:
        total, weights = 0, 0
        for moved, weight in zip(group["moved"], group["weights"]):
            weight = np.frombuffer(weight, np.float32).astype(float)
            total = total + np.frombuffer(moved, np.float16).reshape(-1, width) * weight[:, None]
            weights = weights + weight
        mean = total / np.maximum(weights, 1)[:, None]
        return packed(int(group["salt"].iloc[0]), int(group["first"].iloc[0]), mean, weights).to_pandas()

    schema = "salt long, first long, moved binary, weights binary"
    parts = texts.select("text").mapInArrow(train, schema)
    tasks = parts.rdd.getNumPartitions()
    while tasks > 1:
        tasks = -(-tasks // FAN_IN)
        parts = parts.withColumn("salt", F.col("salt") % tasks).groupBy("salt", "first").applyInPandas(add, schema)
    rows = model.rows()
    for part in parts.select("first", "moved").toLocalIterator():
        moved = np.frombuffer(part.moved, np.float16).reshape(-1, width)
        rows[part.first:part.first + len(moved)] += moved
    return model.like(rows)


def _log_sums(scores: np.ndarray) -> np.ndarray:
    top = scores.max(1)
    scores -= top[:, None]
    np.exp(scores, out=scores)
    return top + np.log(scores.sum(1))


def _with_one(rows: np.ndarray) -> np.ndarray:
    return np.concatenate([rows, np.ones((len(rows), 1), rows.dtype)], axis=1)


class Normaliser:
    """Logarithms of sums of exponentials of q . vector + bias over some vectors, by matrix products alone.

    Where no score can be large enough for an exponential to overflow, nor all so small that their sum vanishes,
    the greatest need not be taken off first.
    """

    LARGEST = 60.0  # exp of it, times the number of vectors, is a finite 32-bit float

    def __init__(self, vectors: np.ndarray, bias: np.ndarray, others: int = 0):
        """The last `others` vectors are scored, but not added up."""
        self.both = np.ascontiguousarray(np.column_stack([vectors, bias]).T)
        self.counted = len(bias) - others
        self.ones = np.ones(len(bias), np.float32)
        self.ones[self.counted:] = 0
        self.length = float(np.sqrt((vectors.astype(float) ** 2).sum(axis=1).max()))
        self.bias = float(np.abs(bias[:self.counted].max()))  # of the likeliest; the exponentials of others may vanish
        if others:
            self.bias = max(self.bias, float(bias[self.counted:].max()))

    def scores(self, q1: np.ndarray) -> np.ndarray:
        """Scores of rows that end in a one."""
        return q1 @ self.both

    def logs(self, q1: np.ndarray, scores: np.ndarray | None = None, longest: float | None = None) -> np.ndarray:
        """`longest`: a length that no row exceeds, without its one, if known. The scores are lost."""
        scores = self.scores(q1) if scores is None else scores
        if longest is None:
            longest = float(np.sqrt(np.einsum("ij,ij->i", q1[:, :-1], q1[:, :-1]).max(initial=0)))
        if longest * self.length + self.bias > self.LARGEST:
            return _log_sums(scores[:, :self.counted])
        np.exp(scores, out=scores)
        return np.log(scores @ self.ones)


@dataclass
class Tables:
    """The model, and the logarithms of the class normalisers of all pairs of the first contexts."""

    model: Model
    norm: np.ndarray

    @cached_property
    def members(self) -> list[Normaliser]:
        """Of each class, made once in a task's worker; the last score is that of the class."""
        m = self.model
        return [
            Normaliser(np.concatenate([m.member[i:j], m.target[c:c + 1]]), np.append(m.member_bias[i:j], m.bias[c]), 1)
            for c, (i, j) in enumerate(zip(m.begins[:-1], m.begins[1:]))
        ]

    @cached_property
    def classes(self) -> Normaliser:
        return Normaliser(self.model.target, self.model.bias)

    @cached_property
    def class_of(self) -> np.ndarray:
        sizes = np.diff(self.model.begins)
        return np.repeat(np.arange(len(sizes)), sizes)

    @cached_property
    def contexts(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """By position: the weighted vectors, the first with a one each, and their lengths. The sum of two is a q that ends in a one."""
        out = []
        for position, last in zip(self.model.position, (1, 0)):
            rows = np.full((len(self.model.context), self.model.context.shape[1] + 1), last, np.float32)
            np.multiply(self.model.context, position, out=rows[:, :-1])
            out.append((rows, np.sqrt(np.einsum("ij,ij->i", rows[:, :-1], rows[:, :-1]))))
        return out

    def logs(self, token: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Natural logarithms of the probabilities."""
        m, pairs = self.model, len(self.norm)
        order = _order(np.take(self.class_of, token))
        token, one, two = np.take(token, order), np.take(one, order), np.take(two, order)
        (near, lengths), (far, more) = self.contexts
        longest = np.take(lengths, one) + np.take(more, two)
        out = np.empty(len(token), np.float32)
        known = (one < pairs) & (two < pairs)
        out[known] = -self.norm[one[known], two[known]]
        rest = np.flatnonzero(~known)
        # a pair of contexts has one normaliser, however often it occurs here
        contexts, back = np.unique(one[rest] * len(m.context) + two[rest], return_inverse=True)
        norms = np.empty(len(contexts), np.float32)
        first, second = np.divmod(contexts, len(m.context))
        reach = np.take(lengths, first) + np.take(more, second)
        for i in range(0, len(contexts), SCORED):
            q = np.take(near, first[i:i + SCORED], axis=0)
            q += np.take(far, second[i:i + SCORED], axis=0)
            norms[i:i + SCORED] = self.classes.logs(q, longest=float(reach[i:i + SCORED].max()))
        out[rest] = -np.take(norms, back)
        kind = np.take(self.class_of, token)
        within = token - np.take(m.begins, kind)
        begins = np.flatnonzero(np.diff(kind, prepend=-1)).tolist()
        for i, j in zip(begins, [*begins[1:], len(kind)]):
            members = self.members[kind[i]]
            width = members.counted + 1
            for k in range(i, j, SCORED):
                end = min(k + SCORED, j)
                q = np.take(near, one[k:end], axis=0)
                q += np.take(far, two[k:end], axis=0)
                scores = members.scores(q)
                out[k:end] += scores[:, -1]
                if width > 2:
                    out[k:end] += np.take(scores, within[k:end] + np.arange(0, scores.size, width))
                    out[k:end] -= members.logs(q, scores, float(longest[k:end].max()))
        unsorted = np.empty_like(out)
        unsorted[order] = out
        return unsorted


def score_tables(spark, model: Model, contexts: int = SHORTLIST) -> Tables:
    """Class normalisers of all pairs of the first `contexts` contexts, in tasks of one context each."""
    shared, n = spark.sparkContext.broadcast(model), min(contexts, len(model.context))

    def normalise(batches):
        m = shared.value
        for batch in batches:
            for i in batch.column(0).to_pylist():
                norm = _log_sums((m.context[i] * m.position[0] + m.context[:n] * m.position[1]) @ m.target.T + m.bias)
                yield pa.RecordBatch.from_arrays([pa.array([i]), pa.array([norm.astype(np.float32).tobytes()], pa.binary())], ["id", "norm"])

    norm = np.zeros((n, n), np.float32)
    for row in spark.range(n).mapInArrow(normalise, "id long, norm binary").collect():
        norm[row.id] = np.frombuffer(row.norm, np.float32)
    return Tables(model, norm)


def _grouped_sum(values: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(text, values, n) if len(text) else np.zeros(n)


def most_frequent(words: DataFrame, most: int) -> pd.DataFrame:
    """All words above a count that at most `most` words exceed. The counts are looked at in steps of about 1%."""
    step = F.floor(F.log2("n") * 64)
    sizes = sorted(words.groupBy(step.alias("step")).count().collect(), reverse=True)  # 64 rows per doubling
    cut, held = None, 0
    for row in sizes:
        held += row["count"]
        if held > most:
            break
        cut = row["step"]
    return words.where(step >= cut if cut is not None else F.lit(False)).toArrow().to_pandas()


def lm_scores(df: DataFrame, key: str, text: str, training, shortlist: int = SHORTLIST, rounds: int = ROUNDS) -> DataFrame:
    """(key, training, n_tokens, n_known, train_tokens, base_score, score) of every text, by whole texts.

    `training` is a column: true for the texts to learn from. `base_score` is the smoothed unigram
    log10 probability, `score` the model's. A null text is empty and has one token, its end.
    Without training texts every base probability is 1 and the model is the untrained one. Keys
    may repeat or be null. The result reads tables in the shared folder.
    """
    spark = df.sparkSession
    small_batches(spark)
    rows = df.select(named(key).alias("key"), F.coalesce(training, F.lit(False)).alias("training"), F.coalesce(named(text), F.lit("")).alias("text"))
    learned = rows.where("training").select("text")
    size = learned.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    counts = stage(token_counts(learned, int(size // (16 << 20) + 1)), "counts")
    total, distinct, ends = counts.agg(F.sum("n"), F.count("*"), F.sum(F.when((F.col("a") == END_KEY[0]) & (F.col("b") == END_KEY[1]), F.col("n")))).first()
    total, ends = total or 0, ends or 0
    words = counts.where(~((F.col("a") == END_KEY[0]) & (F.col("b") == END_KEY[1])))
    head = most_frequent(words, HEAD).sort_values(["n", "a", "b"], ascending=[False, True, True])
    vocabulary = make_vocabulary(head, distinct - (1 if ends else 0), shortlist)
    own = head.iloc[: len(vocabulary.keys)]
    bucket = F.pmod("a", F.lit(vocabulary.hashed))
    held = words.groupBy(bucket.alias("at")).agg(F.sum("n").alias("n"), F.count("*").alias("words")).toArrow().to_pandas()
    hashed, hashed_words = np.zeros((2, vocabulary.hashed), np.int64)
    hashed[held["at"]], hashed_words[held["at"]] = held["n"], held["words"]
    at = own["a"].to_numpy() % vocabulary.hashed
    np.subtract.at(hashed, at, own["n"].to_numpy())
    np.subtract.at(hashed_words, at, 1)
    unigram = np.concatenate([[0, ends], own["n"].to_numpy(), hashed]).astype(np.int64)

    model = Model.start(unigram, begins=vocabulary.begins())
    tasks = learned.coalesce(int(np.ceil(TASKS * np.sqrt(size / (16 << 20) + 1))))
    for r in range(rounds):
        model = train_round(tasks, model, unigram, vocabulary, 1000 * r, RATE / (r + 1))
    tables = score_tables(spark, model, shortlist)

    by_key = head.sort_values("a")
    bucket_all = np.log10(hashed + 0.5 * (hashed_words + 1))
    shared = spark.sparkContext.broadcast((tables, vocabulary, bucket_all, by_key["a"].to_numpy(), by_key["b"].to_numpy(), by_key["n"].to_numpy()))
    base_all = total + 0.5 * (distinct + 1)

    def score(batches):
        tables, vocabulary, bucket_all, head_a, head_b, head_n = shared.value
        for batch in batches:
            for first, last, data, bounds in text_chunks(batch.column(2)):
                part, n = batch.slice(first, last - first), last - first
                words = find_words(data, bounds)
                a, b = word_keys(words)
                tokens, one, two = token_ids(words, a, vocabulary)
                owner = np.repeat(np.arange(n), words.counts + 1)
                logs = _grouped_sum(tables.logs(tokens, one, two).astype(float), owner, n) / np.log(10)
                at = np.minimum(_places(head_a, a), max(len(head_a) - 1, 0))
                known = (head_a[at] == a) & (head_b[at] == b) if len(head_a) else np.zeros(len(a), bool)
                count = head_n[at] if len(head_a) else np.zeros(len(a), np.int64)
                base = _grouped_sum(np.log10((count[known] + 0.5) / base_all), words.text[known], n) + np.log10((ends + 0.5) / base_all)
                is_word = np.ones(len(tokens), bool)
                is_word[words.firsts + words.counts + np.arange(n)] = False
                rare = tokens[is_word] - vocabulary.first  # below 0: a word with vectors of its own
                logs -= _grouped_sum(bucket_all[rare[rare >= 0]], words.text[rare >= 0], n)
                rare = known & (rare >= 0)
                logs += _grouped_sum(np.log10(count[rare] + 0.5), words.text[rare], n)
                tail = np.flatnonzero(~known)
                order = np.lexsort((b[tail], a[tail], words.text[tail]))
                tail = tail[order]
                new = np.ones(len(tail), bool)
                new[1:] = (words.text[tail][1:] != words.text[tail][:-1]) | (a[tail][1:] != a[tail][:-1]) | (b[tail][1:] != b[tail][:-1])
                firsts = np.flatnonzero(new)
                times = np.diff(np.append(firsts, len(tail)))
                ends_at = np.searchsorted(words.text[tail[firsts]], np.arange(n + 1)).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(ends_at), pa.array(v)) for v in (a[tail[firsts]], b[tail[firsts]], times.astype(np.int64))]
                n_known = np.bincount(words.text[known], minlength=n) + (1 if ends else 0)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(words.counts + 1), pa.array(n_known), pa.array(base), pa.array(logs), *lists],
                    ["key", "training", "n_tokens", "n_known", "base", "logs", "a", "b", "times"],
                )

    kind = rows.schema["key"].dataType.simpleString()
    schema = f"key {kind}, training boolean, n_tokens long, n_known long, base double, logs double, a array<long>, b array<long>, times array<long>"
    scored = stage(rows.mapInArrow(score, schema).withColumn("_row", F.monotonically_increasing_id()), "scored")

    tail = scored.select("_row", F.explode(F.arrays_zip("a", "b", "times")).alias("t")).select("_row", "t.a", "t.b", "t.times")
    c = F.coalesce("n", F.lit(0))
    rest = tail.join(counts, ["a", "b"], "left").groupBy("_row").agg(
        F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("known"),
        F.sum(F.col("times") * F.log10((c + 0.5) / F.lit(float(base_all)))).alias("rare_base"),
        F.sum(F.col("times") * F.log10(c + 0.5)).alias("rare_logs"),
    )
    out = scored.select("_row", "key", "training", "n_tokens", "n_known", "base", "logs").join(rest, "_row", "left")
    zero = F.lit(0.0)
    return out.select(
        F.col("key").alias(key), "training", "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"), (F.col("base") + F.coalesce("rare_base", zero)).alias("base_score"),
        (F.col("logs") + F.coalesce("rare_logs", zero)).alias("score"),
    )


ship_with_tasks(__name__)
