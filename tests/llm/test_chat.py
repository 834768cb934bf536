import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tidemark.llm import chat

MARKS = ["<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[/SYS]", "[OUT]", "[ROLE=", "[/ROLE]", "\\", "\\\\", " ", "\n", "é", "[", "]", "<", "ok", "$1", ""]
ROLES = ["user", "assistant", "system", "tool]x", None, "", "User"]


def conversations(seed, n):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for turn in range(rng.randint(1, 9)):
            text = None if rng.random() < 0.1 else "".join(rng.choice(MARKS) for _ in range(rng.randint(0, 12)))
            rows.append((c, turn, rng.choice(ROLES), text))
    return rows


def test_examples_read_back_to_all_turns_and_each_reply_once(spark):
    rows = conversations(1, 120) + [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, formatted string, example int").repartition(3)
    examples = chat.chat_examples(df)
    got = examples.select("*", chat.loss_text().alias("loss"), chat.read_turns(F.col("formatted")).alias("read")).collect()
    for c in {r[0] for r in rows}:
        said = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == c), key=lambda r: r[1])]
        mine = sorted((e for e in got if e.conv_id == c), key=lambda e: e.example)
        replies = [i for i, (role, _) in enumerate(said) if role == "assistant"]
        targets = replies + ([len(said) - 1] if not replies or replies[-1] < len(said) - 1 else [])
        assert [e.turns - 1 for e in mine] == targets and [e.is_last for e in mine] == [False] * (len(mine) - 1) + [True]
        for e, i in zip(mine, targets):
            assert [(t.role, t.text) for t in e.read] == said[:i + 1]
            assert e.loss == (said[i][1] if i in replies else "") and (e.loss_start is None) == (i not in replies)
            assert e.formatted.startswith("<s>")


def test_ties_repeats_and_null_keys(spark):
    rows = [(None, None, "user", "b"), (None, None, "user", "a"), (7, 0, "assistant", "x"), (7, 0, "assistant", "x"), (8, 5, "user", "late"), (8, None, "user", "first")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    read = {r.conv_id: [t.text for t in r.read] for r in chat.chat_examples(df).where("is_last").select("conv_id", chat.read_turns(F.col("formatted")).alias("read")).collect()}
    assert read == {None: ["a", "b"], 7: ["x", "x"], 8: ["first", "late"]}
    assert chat.chat_examples(df.where("false")).collect() == []


def test_long_texts(spark):
    text = "[INST]\\" * 30_000
    df = spark.createDataFrame([(1, 0, "user", text), (1, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
    row = chat.chat_examples(df).select(chat.loss_text().alias("loss"), chat.read_turns(F.col("formatted")).alias("read")).first()
    assert row.loss == text and [t.text for t in row.read] == [text, text]


@pytest.mark.parametrize("name", ["Project", "Generate"])
def test_plan_has_no_python(spark, name):
    df = spark.createDataFrame([(1, 0, "user", "x")], "conv_id long, turn long, role string, text string")
    plan = chat.chat_examples(df).select(chat.loss_text(), chat.read_turns(F.col("formatted")))._jdf.queryExecution().executedPlan().toString()
    assert name in plan and not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_query_digests(spark, tmp_path):
    from tidemark.llm.queries import op2_chat_format

    rows = [r for r in conversations(3, 20) if r[2]]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: r for r in op2_chat_format(spark, str(tmp_path)).collect()}
    for c in {r[0] for r in rows}:
        said = [(r[2], r[3] or "") for r in sorted((r for r in rows if r[0] == c), key=lambda r: r[1])]
        turns = "".join(f"{a}\n{b}\n" for a, b in said)
        loss = "".join(b for a, b in said if a == "assistant")
        assert got[c].n_turns == len(said) and got[c].loss_chars == len(loss)
        assert got[c].turns_sha256 == hashlib.sha256(turns.encode()).hexdigest() and got[c].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()


def test_long_runs_of_backslashes(spark):
    """A run without a mark after it costs one look, at any length; marks after runs are still read back."""
    slashes = "\\" * 1_000_000
    cases = [slashes, slashes + " x", "a" + "\\" * 7 + "</s>", "\\" * 6 + "[INST]" + "\\" * 3 + "x", "\\" * 200 + "<s>" + "\\" * 201 + "</s>\\"]
    rows = [(i, 0, "assistant", t) for i, t in enumerate(cases)]
    made = chat.chat_examples(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = {r.conv_id: r for r in made.select("conv_id", chat.loss_text().alias("loss"), chat.read_turns(F.col("formatted")).alias("read")).collect()}
    assert [got[i].loss for i in range(len(cases))] == cases
    assert [[t.text for t in got[i].read] for i in range(len(cases))] == [[t] for t in cases]
