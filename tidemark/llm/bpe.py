"""Byte-level BPE encoding and decoding by replaying the merges over many words at once.

Texts are cut by the vocabulary's split pattern. The distinct new pieces of a chunk are laid out
as one row of symbols, and an inverted index holds, for each merge rank, the positions of the
adjacent pairs that make that token. Ranks are taken in order; a merge changes the symbols at
all its positions and re-indexes only their neighbours. Each distinct piece is encoded once per
task (the memory of a task's finished pieces is bounded by `MEMO_PIECES`, then begun anew).

Null text is encoded as the empty text: no ids. Special tokens in a text are ordinary text.
"""

from __future__ import annotations

import base64
import heapq

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.llm.words import append_columns
from tidemark.session import ship_with_tasks

MEMO_PIECES = 400_000
ENCODE_BYTES = 6 << 20


def read_ranks(path: str) -> list[bytes]:
    """Tokens in rank order from a file of `base64 rank` lines; ranks must be 0, 1, 2, ..."""
    with open(path, "rb") as lines:
        ranked = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, lines)}
    if sorted(ranked) != list(range(len(ranked))):
        raise ValueError("ranks must run from 0 without gaps")
    return [ranked[i] for i in range(len(ranked))]


class Vocabulary:
    """Tokens, and the merge that each adjacent pair of tokens gives, as sorted arrays."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        self.rank = {token: i for i, token in enumerate(tokens)}
        missing = [b for b in range(256) if bytes([b]) not in self.rank]
        if missing:
            raise ValueError(f"bytes without a token: {missing[:5]}")
        self.of_byte = np.array([self.rank[bytes([b])] for b in range(256)], np.int64)
        pairs = [
            (self.rank[t[:i]] << 32 | self.rank[t[i:]], merged)
            for merged, t in enumerate(tokens)
            for i in range(1, len(t))
            if t[:i] in self.rank and t[i:] in self.rank
        ]
        pairs.sort()
        self.pair_keys = np.array([k for k, _ in pairs] or [-1], np.int64)
        self.pair_merges = np.array([m for _, m in pairs] or [-1], np.int64)

    def merges(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the token that left + right make, -1 where there is none."""
        keys = left << 32 | right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_merges[at], -1)


class _Replay:
    """Symbols of all pieces in a row, linked within each piece, and the index of their pairs."""

    def __init__(self, pieces: list[bytes], vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        self.symbols = vocabulary.of_byte[np.frombuffer(b"".join(pieces), np.uint8)]
        n = len(self.symbols)
        self.ends = np.cumsum(lengths)
        self.next = np.arange(1, n + 1)
        self.next[self.ends - 1] = -1
        self.before = np.arange(-1, n - 1)
        self.before[self.ends - lengths] = -1
        self.pair = np.full(n + 1, -1, np.int64)  # rank of the pair that starts here; the last slot is a dummy
        at = np.flatnonzero(self.next >= 0)
        self.pair[at] = vocabulary.merges(self.symbols[at], self.symbols[at + 1])
        self.index: dict[int, list[np.ndarray]] = {}
        self.due: list[int] = []
        self.add(at)

    def add(self, at: np.ndarray) -> None:
        """Index the pairs that start at `at` by their rank."""
        ranks = self.pair[at]
        at, ranks = at[ranks >= 0], ranks[ranks >= 0]
        if not len(at):
            return
        order = np.argsort(ranks, kind="stable")
        at, ranks = at[order], ranks[order]
        cuts = np.flatnonzero(np.diff(ranks, prepend=-1))
        edges = cuts.tolist() + [len(at)]
        for i, rank in enumerate(ranks[cuts].tolist()):
            if rank not in self.index:
                heapq.heappush(self.due, rank)
                self.index[rank] = []
            self.index[rank].append(at[edges[i]:edges[i + 1]])

    def run(self) -> list[bytes]:
        while self.due:
            rank = heapq.heappop(self.due)
            at = np.concatenate(self.index.pop(rank))
            at = np.sort(at[self.pair[at] == rank])
            at = at[np.diff(at, prepend=-1) > 0]
            if len(at) and not self.merge_all(at, rank):
                self.merge_in_turn(at, rank)
        alive = self.symbols >= 0
        counts = np.add.reduceat(alive.astype(np.int64), np.concatenate([[0], self.ends[:-1]]))
        packed, ends = self.symbols[alive].astype("<u4").tobytes(), (4 * np.cumsum(counts)).tolist()
        return [packed[a:b] for a, b in zip([0] + ends, ends)]

    def merge_all(self, at: np.ndarray, rank: int) -> bool:
        """Merge at all positions at once; False, with nothing changed, if a merge would open a lower rank.

        Of pairs that share a symbol, as in a run of one symbol, every other one is merged, from
        the left. Neighbouring merges see each other's new symbol.
        """
        second, number = self.next[at], np.arange(len(at))
        shares = np.concatenate([[False], at[1:] == second[:-1]])
        chain = np.maximum.accumulate(np.where(shares, 0, number))
        taken = (number - chain) % 2 == 0
        at, second = at[taken], second[taken]

        symbol = np.full(len(at), rank)
        left, right = self.before[at], self.next[second]
        follows = np.concatenate([[False], left[1:] == second[:-1]])
        left = np.where(follows, np.concatenate([at[:1], at[:-1]]), left)
        new_left = self.vocabulary.merges(np.where(follows, rank, self.symbols[left]), symbol)
        passing = self.vocabulary.merges(symbol, self.symbols[right])
        if ((left >= 0) & (new_left >= 0) & (new_left < rank)).any() or ((right >= 0) & (passing >= 0) & (passing < rank)).any():
            return False
        self.symbols[at], self.symbols[second], self.pair[second] = rank, -1, -1
        self.next[at] = right
        self.before[right[right >= 0]] = at[right >= 0]
        self.reindex(np.concatenate([at, left[(left >= 0) & ~follows]]))
        return True

    def reindex(self, at: np.ndarray) -> None:
        after = self.next[at]
        self.pair[at] = np.where(after >= 0, self.vocabulary.merges(self.symbols[at], self.symbols[after]), -1)
        self.add(at)

    def merge_in_turn(self, at: np.ndarray, rank: int) -> None:
        """Left to right, one by one; a lower rank that opens goes first, the rest is put back."""
        for i, p in enumerate(at.tolist()):
            if self.pair[p] != rank:
                continue
            second = self.next[p]
            left, right = self.before[p], self.next[second]
            self.symbols[p], self.symbols[second], self.pair[second] = rank, -1, -1
            self.next[p] = right
            if right >= 0:
                self.before[right] = p
            touched = np.array([p] if left < 0 else [left, p])
            self.reindex(touched)
            opened = self.pair[touched]
            if ((opened >= 0) & (opened < rank)).any():
                self.add(at[i + 1:])
                return


def encode_pieces(pieces: list[bytes], vocabulary: Vocabulary) -> list[bytes]:
    """Ids of each non-empty piece as little-endian 32-bit numbers; a piece that is a token stays whole."""
    whole = [vocabulary.rank.get(p) for p in pieces]
    out = [b"" if i is None else i.to_bytes(4, "little") for i in whole]
    rest = [at for at, i in enumerate(whole) if i is None]
    if rest:
        for at, ids in zip(rest, _Replay([pieces[at] for at in rest], vocabulary).run()):
            out[at] = ids
    return out


def encode(df: DataFrame, ranks_path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """`df` with the token ids of each text as array<int>.

    `pattern` must have no groups and no empty match. The file is read by the driver.
    """
    tokens = df.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))  # bounded by the vocabulary

    def start():
        vocabulary, split = Vocabulary(tokens.value), regex.compile(pattern)
        memo: dict[str, bytes] = {}

        def work(column: pa.Array) -> list[pa.Array]:
            pieces = [split.findall(t) for t in column.fill_null("").to_pylist()]
            if len(memo) > MEMO_PIECES:
                memo.clear()
            new = list(set().union(*pieces).difference(memo))
            memo.update(zip(new, encode_pieces([p.encode() for p in new], vocabulary)))
            packed = [b"".join([memo[p] for p in text]) for text in pieces]
            bounds = np.concatenate([[0], np.cumsum([len(p) // 4 for p in packed])]).astype(np.int32)
            values = np.frombuffer(b"".join(packed), "<i4")
            return [pa.ListArray.from_arrays(pa.array(bounds), pa.array(values, pa.int32()))]

        return work

    fields = T.StructType([T.StructField(ids, T.ArrayType(T.IntegerType(), False))])
    return append_columns(df, text, fields, start, ENCODE_BYTES)


def decode_lists(column: pa.ListArray, tokens: np.ndarray, starts: np.ndarray) -> list[bytes]:
    """Bytes of each list of ids; `tokens` are all tokens in a row, `starts` their bounds. A null list has no places and so is empty."""
    bounds = column.offsets.to_numpy()
    ids = column.values.to_numpy(zero_copy_only=False)[bounds[0]:bounds[-1]].astype(np.int64)
    lengths = starts[ids + 1] - starts[ids]
    ends = np.cumsum(lengths)
    at = np.arange(int(lengths.sum())) + np.repeat(starts[ids] - (ends - lengths), lengths)
    data = tokens[at].tobytes()
    cuts = np.concatenate([[0], ends])[bounds - bounds[0]]
    return [data[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]


def decode(df: DataFrame, ranks_path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """`df` with the bytes that each list of ids stands for. An id outside the vocabulary raises."""
    shared = df.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))
    kept = df.drop(out) if out != ids else df
    schema = T.StructType([*kept.schema, T.StructField(out, T.BinaryType())])

    def run(batches):
        tokens = np.frombuffer(b"".join(shared.value), np.uint8)
        starts = np.concatenate([[0], np.cumsum([len(t) for t in shared.value])])
        for batch in batches:
            at, step = batch.schema.get_field_index(ids), 256
            for first in range(0, batch.num_rows, step):
                part = batch.slice(first, step)
                made = pa.array(decode_lists(part.column(at), tokens, starts), pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns, made], schema.names)

    return kept.mapInArrow(run, schema)


ship_with_tasks(__name__)
