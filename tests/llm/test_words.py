import pyarrow as pa
from pyspark.sql import types as T

from brute import words as plain_words
from tidemark.llm.words import append_columns, find_words, text_chunks, window_starts, windows


def test_words_and_windows_are_those_of_the_pattern(texts):
    found, hashes, places = [], {}, {}
    for chunk_bytes in (1, 1 << 20):
        found = []
        for first, last, data, bounds in text_chunks(pa.array(texts), chunk_bytes):
            words = find_words(data, bounds)
            raw = data.tobytes()
            spelled = [raw[a:b].decode() for a, b in zip(words.starts, words.ends)]
            ends = [0, *words.counts.cumsum()]
            found += [spelled[a:b] for a, b in zip(ends, ends[1:])]
            for word, h in zip(spelled, words.hashes().tolist()):
                assert hashes.setdefault(word, h) == h
            for i, h in zip(window_starts(words, 3), windows(words.hashes(), 3)[window_starts(words, 3)].tolist()):
                assert places.setdefault(tuple(spelled[i:i + 3]), h) == h
        assert found == [plain_words(t) for t in texts]
    assert len(set(hashes.values())) == len(hashes) and len(set(places.values())) == len(places)


def test_append_columns_replaces_older_ones_and_takes_empty_tables(spark):
    fields = T.StructType([T.StructField("n", T.LongType())])

    def start():
        return lambda column: [pa.array([len(t or "") for t in column.to_pylist()], pa.int64())]

    df = spark.createDataFrame([("abc", 7, 1.5), (None, 8, None)], "text string, n long, other double")
    made = append_columns(df, "text", fields, start)
    assert [tuple(r) for r in made.collect()] == [("abc", 1.5, 3), (None, None, 0)] and made.columns == ["text", "other", "n"]
    assert append_columns(df.where("false"), "text", fields, start).collect() == []
