import hashlib
import random
import re

import brute
import pytest
from pyspark.sql import functions as F

from tidemark.llm import repair
from tidemark.llm.queries import damaged

SCHEMA = "conv_id long, turn long, role string, text string"


def reference(rows):
    """What `summaries` gives, from rows (turn, role, text) of one conversation."""
    rows = sorted(((t, r or " " if r is None else r, " " if x is None else x) for t, r, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    faults, codes, seen = [], "", set()
    for _, role, text in rows:
        bare = text.rstrip(" \t\n\x0b\x0c\r")
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
        seen.add((role, text))
        faults.append(fault)
        letter = role[:1] if role[:1] in ("s", "u", "a") else "o"
        codes += "x" if fault in ("blank", "duplicate") else letter.upper() if fault == "truncated" else letter
    cost, audit = brute.cheapest_repair(codes)
    odd, said, i = len(audit.replace("D", "")) % 2, [], 0
    for edit in audit:
        if edit != "D":
            target = "user" if (len(said) + odd) % 2 == 0 else "assistant"
            said.append(f"{rows[i][1] if edit == 'K' else target}:{'' if edit == 'I' else rows[i][2]}")
        i += edit != "I"
    turns = [t for t, _, _ in rows if t is not None]
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
        sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(said).encode()).hexdigest(),
    )


def conversations(rng, n):
    out = []
    for c in range(n):
        for t in range(rng.randint(1, 14)):
            role = rng.choice(["system"] if t == 0 and rng.random() < 0.4 else ["user", "assistant"][t % 2:][:1] * 5 + ["user", "assistant", "system", "tool", "", None])
            text = rng.choice(["Yes.", "No!", "Well", "What? ", "", " \n", None, f"Text {t}.", f"unfinished {t}\t", f"Line.\nMore {rng.randint(0, 3)}?"])
            turn = rng.choice([t] * 8 + [None, t + 3, t - 1])
            out += [(c, turn, role, text)] * rng.choice([1, 1, 1, 1, 2])
    return out


def by_conversation(rows):
    out = {}
    for c, *row in rows:
        out.setdefault(c, []).append(row)
    return {c: reference(r) for c, r in out.items()}


@pytest.mark.parametrize("block_turns", [512, 5])
def test_same_as_brute_force(spark, block_turns):
    rows = conversations(random.Random(5), 250) + [(None, i, "user" if i % 3 else "assistant", f"Said {i}.") for i in range(40)]
    edits = repair.repair_turns(spark.createDataFrame(rows, SCHEMA).repartition(3), block_turns=block_turns)
    made = {r[0]: tuple(r[1:]) for r in repair.summaries(edits).collect()}
    assert made == by_conversation(rows)


def test_edits_are_rows_in_order(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Hello?"), (1, 2, "tool", "42."), (1, 3, "assistant", " "), (1, 4, "assistant", "Ok.")]
    out = repair.repair_turns(spark.createDataFrame(rows, SCHEMA)).orderBy("block", "step").collect()
    assert [(r.edit, r.pos, r.role, r.target, r.fault) for r in out] == [
        ("I", None, None, "user", None), ("R", 0, "user", "assistant", None), ("K", 1, "user", "user", None), ("D", 2, "tool", None, None),
        ("D", 3, "assistant", None, "blank"), ("K", 4, "assistant", "assistant", None),
    ] or "".join(r.edit for r in out) == brute.cheapest_repair("uuoxa")[1]
    assert re.fullmatch("(s?(ua)+)?", "".join(r.target[0] for r in out if r.target))


def test_long_conversation_in_blocks(spark):
    rng = random.Random(2)
    rows = [(1, t, rng.choice(["user", "assistant", "assistant", "tool"]) if rng.random() < 0.2 else ["user", "assistant"][t % 2],
             rng.choice([f"Text {t}.", f"Text {t}", "Same."])) for t in range(3000)]
    edits = repair.repair_turns(spark.createDataFrame(rows, SCHEMA))
    assert {r[0]: tuple(r[1:]) for r in repair.summaries(edits).collect()} == by_conversation(rows)


def test_ties_between_blocks_compare_whole_audits():
    rng = random.Random(6)
    for _ in range(1500):
        codes = "".join(rng.choice("suaoxSUAO") for _ in range(rng.randint(1, 12)))
        want = brute.cheapest_repair(codes)
        assert repair.Block(codes, True).whole() == want
        for size in (1, 2, 4):
            path = repair.shortest_path([repair.Block(codes[i:i + size], False).options() for i in range(0, len(codes), size)])
            assert "".join(a for _, a in path) == want[1]


def test_empty_tables_and_extra_columns(spark):
    empty = repair.repair_turns(spark.createDataFrame([], SCHEMA))
    assert empty.count() == 0 and repair.summaries(empty).count() == 0
    df = spark.createDataFrame([(1, 0, "user", "Hi.")], SCHEMA).select("*", F.lit(1).alias("_pos"), F.lit(2).alias("fault"), F.lit(3).alias("block"))
    assert [r.edit for r in repair.repair_turns(df).collect()] in (["D"], ["K", "I"], ["I", "K"], list(brute.cheapest_repair("u")[1]))


def test_very_long_texts(spark):
    rows = [(1, 0, "user", "word " * 400_000 + "."), (1, 1, "assistant", " " * 1_000_000), (1, 2, "assistant", "." * 1_000_000)]
    made = repair.summaries(repair.repair_turns(spark.createDataFrame(rows, SCHEMA))).collect()
    assert [tuple(r)[1:] for r in made] == [reference([r[1:] for r in rows])]


def test_damage(spark):
    import zlib

    rows = [(c, t, r, x) for c in (1, 2, None) for t in (*range(40), None) for r, x in (("system", "One. Two! Three?"), (None, None))]
    want = []
    for c, t, r, x in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = r or " ", x or " "
        if kind:
            x = "" if kind == 1 else re.sub("[.!?]", "", x) if kind == 2 else x
            want += [(c, t, "user" if kind == 4 else r, x)] * (2 if kind == 3 else 1)
    assert [tuple(r) for r in damaged(spark.createDataFrame(rows, SCHEMA)).collect()] == want
