import random

import public_tokenizers
import pytest
import tiktoken

from tidemark.llm.bpe import decode, encode, encode_pieces, read_ranks, Vocabulary

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    ranks = {t: i for i, t in enumerate(read_ranks(PATH))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_same_ids_as_the_library_and_back(spark, texts, library):
    rng = random.Random(1)
    odd = ["".join(rng.choice("aabtheinr s='-01é中<|endoftext|>") for _ in range(rng.randint(1, 80))) for _ in range(300)]
    odd += ["a" * 5000, "ab" * 3000, "=" * 2000, " " * 300, "<|endoftext|>"]
    df = spark.createDataFrame([(i, t, [9]) for i, t in enumerate(texts + odd)], "id int, text string, ids array<int>").repartition(3)
    rows = decode(encode(df, PATH, public_tokenizers.PATTERN), PATH).collect()
    for r in rows:
        assert r.ids == library.encode_ordinary(r.text or "") and bytes(r.decoded) == (r.text or "").encode()
    assert len(rows) == len(texts) + len(odd)


def test_merges_that_open_a_lower_rank_go_first():
    # 'ab' + 'c' makes 'abc', which has a lower rank than 'ab' itself; ties between runs go to the left
    tokens = [bytes([b]) for b in range(256)] + [b"bc", b"abc", b"ab", b"aa", b"aaaa"]
    vocabulary = Vocabulary(tokens)

    def naive(piece):
        parts = [bytes([b]) for b in piece]
        while True:
            ranks = [vocabulary.rank.get(a + b, 1 << 30) for a, b in zip(parts, parts[1:])]
            if not ranks or min(ranks) == 1 << 30:
                return [vocabulary.rank[p] for p in parts]
            i = ranks.index(min(ranks))
            parts[i:i + 2] = [parts[i] + parts[i + 1]]

    rng = random.Random(2)
    pieces = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 14))).encode() for _ in range(500)]
    got = encode_pieces(pieces, vocabulary)
    for piece, ids in zip(pieces, got):
        ids = [int.from_bytes(ids[i:i + 4], "little") for i in range(0, len(ids), 4)]
        assert ids == ([vocabulary.rank[piece]] if piece in vocabulary.rank else naive(piece))


def test_empty_table(spark):
    df = spark.createDataFrame([], "id int, text string")
    assert decode(encode(df, PATH, public_tokenizers.PATTERN), PATH).collect() == []
    lists = spark.createDataFrame([(1, None), (2, [72, 105]), (3, []), (4, None), (5, [0])], "id int, ids array<int>").coalesce(1)
    assert [bytes(r.decoded) for r in decode(lists, PATH).orderBy("id").collect()] == [b"", b"".join(read_ranks(PATH)[i] for i in (72, 105)), b"", b"", read_ranks(PATH)[0]]
