"""Chat formatting by prefix-target expansion, with DataFrame functions only.

Every assistant turn of a conversation becomes an example of its own: all turns before it as
context, and only its text under the loss mask. Turns after the last assistant turn (or all, if
there is none) make one more example without a target, so the examples hold every turn.

A turn is written between an opening and a closing mark, with one blank on each side of its text.
Inside texts, a mark that n backslashes precede gets 2n + 1 of them, so a mark without a backslash
before it is always a real one, and `unescape` gives the text back exactly. Roles other than
system, user and assistant are named, URL-encoded, in their opening mark.

Examples repeat their context, so their size grows with the square of a conversation's length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BEGIN = "<s>"
OPEN = {"system": "[SYS]", "user": "[INST]", "assistant": "[OUT]"}
CLOSE = {"system": "[/SYS]", "user": "[/INST]", "assistant": "</s>"}
OPEN_OTHER, CLOSE_OTHER = "[ROLE=", "[/ROLE]"
MARKS = r"</?s>|\[/?INST\]|\[/?SYS\]|\[OUT\]|\[ROLE=|\[/ROLE\]"
_TURN = (
    r"(?s)(?<!\\)\[(INST|SYS|OUT|ROLE=[^\]]*)\] (.*?) (?<!\\)(?:</s>|\[/INST\]|\[/SYS\]|\[/ROLE\])"
)


def escape(text: Column) -> Column:
    """A run of backslashes is looked at once, from its beginning, and given up as a whole when no mark follows it."""
    return F.regexp_replace(text, rf"(?<!\\)(\\*+)({MARKS})", r"$1$1\\$2")


def unescape(text: Column) -> Column:
    """The lookahead finds in one pass whether a run is odd and ends at a mark; only such runs are halved."""
    return F.regexp_replace(text, rf"(?<!\\)(?=(?:\\\\)*+\\(?:{MARKS}))(\\*)\1\\({MARKS})", r"$1$2")


def _by_role(role: Column, marks: dict[str, str], other: Column) -> Column:
    chosen = None
    for name, mark in marks.items():
        chosen = F.when(role == name, mark) if chosen is None else chosen.when(role == name, mark)
    return chosen.otherwise(other)


def format_turn(role: Column, text: Column) -> Column:
    opened = _by_role(role, OPEN, F.concat(F.lit(OPEN_OTHER), F.url_encode(role), F.lit("]")))
    return F.concat(opened, F.lit(" "), escape(text), F.lit(" "), _by_role(role, CLOSE, F.lit(CLOSE_OTHER)))


def chat_examples(
    df: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """(conv_id, example, turns, formatted, loss_start, loss_chars, is_last), an example per row.

    Turns are ordered by number (nulls first), ties by role and text. A null role or text is an
    empty one; rows with a null conversation form one conversation. `loss_start` counts code
    points from 0; without a target it is null and `loss_chars` 0. No rows give no examples.
    """
    turns = df.select(
        F.col(conversation).alias("conv_id"),
        F.struct(
            F.col(turn).alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col(text), F.lit("")).alias("text"),
        ).alias("one"),
    )
    whole = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("one")).alias("all"))
    whole = whole.select(
        "conv_id", F.transform("all", lambda t: t["role"]).alias("roles"),
        F.transform("all", lambda t: format_turn(t["role"], t["text"])).alias("written"),
    )
    size = F.size("roles")
    targets = F.filter(F.sequence(F.lit(1), size), lambda i: (F.element_at("roles", i) == "assistant") | (i == size))
    examples = whole.select("conv_id", "roles", "written", F.posexplode(targets).alias("example", "turns"))
    trained = F.element_at("roles", F.col("turns")) == "assistant"
    before = F.concat(F.lit(BEGIN), F.array_join(F.slice("written", F.lit(1), F.col("turns") - 1), ""))
    last = F.element_at("written", F.col("turns"))
    around = len(OPEN["assistant"]) + 1, len(CLOSE["assistant"]) + 1
    return examples.select(
        "conv_id", "example", "turns", F.concat(before, last).alias("formatted"),
        F.when(trained, F.length(before) + around[0]).alias("loss_start"),
        F.when(trained, F.length(last) - sum(around)).otherwise(0).alias("loss_chars"),
        (F.col("turns") == size).alias("is_last"),
    )


def loss_text(example: str = "formatted", start: str = "loss_start", chars: str = "loss_chars") -> Column:
    """The unescaped text under the loss mask; empty without a target."""
    return F.coalesce(unescape(F.substring(F.col(example), F.col(start) + 1, F.col(chars))), F.lit(""))


def read_turns(formatted: Column) -> Column:
    """array<struct<role, text>> of a formatted example, unescaped."""
    tags = F.regexp_extract_all(formatted, F.lit(_TURN), F.lit(1))
    texts = F.regexp_extract_all(formatted, F.lit(_TURN), F.lit(2))
    names = {mark[1:-1]: role for role, mark in OPEN.items()}

    def one(tag, text):
        named_role = F.url_decode(F.regexp_replace(tag, "^ROLE=", ""))
        return F.struct(_by_role(tag, names, named_role).alias("role"), unescape(text).alias("text"))

    return F.zip_with(tags, texts, one)
