"""Repair of conversation structure: the cheapest edits that make the roles follow `(s?(ua)+)?`.

Turns are aligned (Wagner-Fischer) to each feasible length of the alternating string of role initials.
The targets that end alike are suffixes of one another, so one matrix, indexed by the target letters that
remain, holds the distance to all of them; it is filled only in the Ukkonen band of diagonals that a cheap first
repair (the incumbent) does not rule out. The cheapest lengths are traced back and their audits compared.

A long conversation is cut into blocks of consecutive turns. A block is aligned for every state
of the grammar in which it may begin and end; choosing a state at each border is then a shortest path over blocks.
"""

from __future__ import annotations

import hashlib

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ordering import row_index
from tidemark.session import join_on, named, ship_with_tasks, stage

DELETE, INSERT, REROLE, UNTRUE = 4, 3, 3, 3  # fixed: costs; the last one of keeping a truncated turn
ROLES = {"u": "user", "a": "assistant"}
SPACE = " \t\n\x0b\x0c\r"  # fixed: the characters that no word has
BLOCK_TURNS = 512
_FAR = 1 << 60
# states of the grammar: B nothing yet, S after the system turn, U after a user turn, A after an answer
_NEXT = {"B": "u", "S": "u", "A": "u", "U": "a"}


def turn_faults(text: Column, seen: Column) -> Column:
    """First fault of a turn: 'blank', 'duplicate', 'truncated' or null. `seen`: an earlier turn says the same."""
    bare = F.rtrim(text, F.lit(SPACE))
    ended = F.substring(bare, -1, 1).isin(".", "!", "?")
    return F.when(bare == "", "blank").when(seen, "duplicate").when(~ended, "truncated")


def _turn_code(role: Column, fault: Column) -> Column:
    """One letter per turn: s, u, a or o (other) by role initial, upper case if truncated; x must go."""
    initial = F.substring(role, 1, 1)
    letter = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    return F.when(fault.isin("blank", "duplicate"), "x").otherwise(F.when(fault == "truncated", F.upper(letter)).otherwise(letter))


class Block:
    """Alignments of some turns, given by their codes, to the strings that lead from one state to another."""

    def __init__(self, codes: str, alone: bool):
        self.codes = codes
        self.usable = [i for i, c in enumerate(codes) if c != "x"]
        self.turns = [codes[i].lower() for i in self.usable]
        self.truncated = [codes[i].isupper() for i in self.usable]
        self.fixed = DELETE * (len(codes) - len(self.usable))
        # a conversation of its own must go from B to an end; other states cost three more letters at most
        extra = self._incumbent() + (0 if alone else 3 * INSERT)
        cheap = sum(self.truncated)  # deleting these costs one more than keeping them
        self.most_inserted = extra // INSERT
        self.most_deleted = extra if extra <= cheap else cheap + (extra - cheap) // DELETE
        self.tables: dict[str, tuple[list[int], list[list[int]]]] = {}

    def _incumbent(self) -> int:
        """Cost, beyond what every repair pays, of the cheaper of two repairs in one pass: by inserting or by new roles."""
        best = sum(DELETE - UNTRUE * t for t in self.truncated)  # nothing stays
        for insert in (True, False):
            cost, state = 0, "B"
            for turn in self.turns:
                if turn == "s" and state == "B":
                    state = "S"
                    continue
                if turn == _NEXT[state]:
                    state = "A" if turn == "a" else "U"
                elif insert and turn in ROLES:
                    cost, state = cost + INSERT, "A" if turn == "a" else "U"
                else:
                    cost, state = cost + REROLE, "A" if _NEXT[state] == "a" else "U"
            cost += {"B": 0, "S": 2 * INSERT, "U": INSERT, "A": 0}[state]
            best = min(best, cost)
        return best

    def table(self, tail: str) -> tuple[list[int], list[list[int]]]:
        """Cost of aligning the turns from each one on with the last r letters of a string that ends in `tail`.

        Row i holds r from `lows[i]` on: of the band of diagonals (turns left) - (letters left).
        """
        if tail in self.tables:
            return self.tables[tail]
        m = len(self.turns)
        letters = {1: tail, 0: "u" if tail == "a" else "a"}
        lows = [max(0, m - i - self.most_deleted) for i in range(m + 1)]
        rows: list[list[int]] = [[]] * (m + 1)
        rows[m] = [INSERT * r for r in range(self.most_inserted + 1)]
        for i in range(m - 1, -1, -1):
            low, below, below_low = lows[i], rows[i + 1], lows[i + 1]
            stays = UNTRUE if self.truncated[i] else 0
            turn, row, left = self.turns[i], [], _FAR
            for r in range(low, m - i + self.most_inserted + 1):
                at = r - below_low
                best = below[at] + DELETE if at < len(below) else _FAR
                if r:
                    if at > 0:
                        cost = below[at - 1] + stays + (0 if turn == letters[r & 1] else REROLE)
                        if cost < best:
                            best = cost
                    if left + INSERT < best:
                        best = left + INSERT
                row.append(best)
                left = best
            rows[i] = row
        self.tables[tail] = lows, rows
        return lows, rows

    def cost(self, tail: str, i: int, r: int) -> int:
        lows, rows = self.table(tail)
        at = r - lows[i]
        return rows[i][at] if 0 <= at < len(rows[i]) else _FAR

    def trace(self, tail: str, i: int, r: int, turn: int) -> str:
        """ASCII-least audit of the cheapest alignments of the codes from `turn` on, the i-th usable one or just before it."""
        out, n, letters = [], len(self.codes), {1: tail, 0: "u" if tail == "a" else "a"}
        while turn < n or r:
            if turn < n and self.codes[turn] == "x":
                out.append("D")
                turn += 1
                continue
            now = self.cost(tail, i, r)
            if turn < n and now == DELETE + self.cost(tail, i + 1, r):
                out.append("D")
                turn, i = turn + 1, i + 1
            elif r and now == INSERT + self.cost(tail, i, r - 1):
                out.append("I")
                r -= 1
            else:
                out.append("K" if self.turns[i] == letters[r & 1] else "R")
                turn, i, r = turn + 1, i + 1, r - 1
        return "".join(out)

    def best(self, state: str, tail: str, parity: int, shortest: int) -> tuple[int, str]:
        """Cheapest (cost, audit) over all lengths of the parity, from `shortest` on; from B a system turn may come first."""
        ways = []  # (cost, codes dropped before, kept system turn or not, usable turn, letters left)
        lows, rows = self.table(tail)
        firsts = [(0, None, 0)]
        if state == "B":
            dropped = 0
            for i, turn in enumerate(self.turns):
                if i > self.most_deleted:
                    break
                if turn == "s":
                    firsts.append((dropped + (UNTRUE if self.truncated[i] else 0), self.usable[i], i + 1))
                dropped += DELETE
        for before, system, i in firsts:
            for r in range(lows[i], lows[i] + len(rows[i])):
                if r >= shortest and r % 2 == parity:
                    ways.append((before + self.cost(tail, i, r), system, i, r))
        least = min((w[0] for w in ways), default=_FAR)
        audits = []
        for cost, system, i, r in ways:
            if cost == least and cost < _FAR:
                if system is None:
                    audits.append(self.trace(tail, 0, r, 0))
                else:
                    audits.append("D" * system + "K" + self.trace(tail, i, r, system + 1))
        return (least + self.fixed, min(audits)) if audits else (_FAR, "")

    def nothing(self) -> tuple[int, str]:
        return self.fixed + DELETE * len(self.usable), "D" * len(self.codes)

    def whole(self) -> tuple[int, str]:
        """Cheapest repair of a conversation of its own."""
        return min(self.best("B", "a", 0, 2), self.nothing())

    def options(self) -> dict[tuple[str, str], tuple[int, str]]:
        """Cheapest (cost, audit) from every state to every state."""
        made = {(state, state): self.nothing() for state in "BSUA"}
        made["B", "S"] = self._only_system()
        for state in "BSUA":
            odd = state == "U"  # the first letter is a: an odd number of letters ends in a
            for end, parity in (("A", int(odd)), ("U", int(not odd))):
                got = self.best(state, end.lower(), parity, 1)
                made[state, end] = min(made.get((state, end), (_FAR, "")), got)
        return {pair: got for pair, got in made.items() if got[0] < _FAR}

    def _only_system(self) -> tuple[int, str]:
        ways = [(_FAR, "")]
        whole = self.nothing()
        for i, turn in zip(self.usable, self.turns):
            if turn == "s":
                ways.append((whole[0] - DELETE + (UNTRUE if self.codes[i].isupper() else 0), "D" * i + "K" + whole[1][i + 1:]))
        return min(ways)


def _steps(codes: str, audit: str, state: str) -> tuple[list[int | None], str]:
    """Turn in the block (None: inserted) and target initial ('-': deleted) of each edit."""
    at, targets, turn = [], [], 0
    for edit in audit:
        if edit == "D":
            target = "-"
        else:
            target = codes[turn].lower() if edit == "K" else _NEXT[state]
            state = {"s": "S", "u": "U", "a": "A"}[target]
        at.append(None if edit == "I" else turn)
        targets.append(target)
        turn += edit != "I"
    return at, "".join(targets)


def _before(one, other) -> bool:
    """Whether the chain of texts (text, rest) spells a smaller string than the other; walks only as far as they agree."""
    (x, one), (y, other) = (one or ("", None)), (other or ("", None))
    while True:
        n = min(len(x), len(y))
        if x[:n] != y[:n]:
            return x[:n] < y[:n]
        x, y = x[n:], y[n:]
        if not x:
            if one is None:
                return bool(y) or other is not None
            if one is other and not y:
                return False
            x, one = one
        if not y:
            if other is None:
                return False
            y, other = other


def shortest_path(blocks: list[dict]) -> list[tuple[str, str]]:
    """(state before, audit) of each block on the cheapest way from B to B or A, ASCII-least among ties."""
    best = {"B": (0, None, None), "A": (0, None, None)}  # cost, chain of audits, chain of states
    for options in reversed(blocks):
        now = {}
        for (state, end), (cost, audit) in options.items():
            if end not in best:
                continue
            cost, chain, states = cost + best[end][0], (audit, best[end][1]), (state, best[end][2])
            held = now.get(state)
            if held is None or cost < held[0] or cost == held[0] and _before(chain, held[1]):
                now[state] = cost, chain, states
        best = now
    _, chain, states = best["B"]
    out = []
    while chain is not None:
        out.append((states[0], chain[0]))
        chain, states = chain[1], states[1]
    return out


def number_turns(df: DataFrame, conversation: str, turn: str, role: str, text: str) -> DataFrame:
    """(_conv, _pos, _turn, _role, _text): turns in order, by number (nulls first), role and text; a null role or text is one space."""
    rows = df.select(
        named(conversation).alias("_conv"), named(turn).alias("_turn"),
        F.coalesce(named(role).cast("string"), F.lit(" ")).alias("_role"), F.coalesce(named(text), F.lit(" ")).alias("_text"),
    )
    return row_index(rows, ["_conv"], ["_turn", "_role", "_text"], "_pos")


def repair_turns(
    df: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    block_turns: int = BLOCK_TURNS,
) -> DataFrame:
    """(conv_id, block, step, edit, pos, turn, role, text, fault, target): the edits of every conversation, in order.

    `edit` is K(eep), R(erole), D(elete) or I(nsert); `pos`, `turn`, `role`, `text` and `fault` are of the turn as it
    is, null for an insert; `target` is the role after the edit, null for a delete. Blank and duplicate turns (role
    and text as of an earlier one) are deleted. Costs: rerole to user or assistant 3, delete 4, insert of an empty user or
    assistant turn 3, a truncated turn that stays 3; of the cheapest edits those whose letters are ASCII-least.

    Turns are ordered by number, nulls first, ties by role and text; equal rows are interchangeable. A null
    role or text is one space; rows with a null conversation are one conversation. No rows give no edits. Other
    columns are left out. Blocks are aligned anywhere; only their costs and audits (some 14 bytes a turn) meet in the
    task that joins the blocks of one conversation, texts never do.
    """
    rows = stage(number_turns(df, conversation, turn, role, text), "turns")
    same = rows.select("_conv", "_pos", F.col("_role").alias("_r"), F.sha2("_text", 256).alias("_says"))
    first = same.groupBy("_conv", "_r", "_says").agg(F.min("_pos").alias("_first"))
    firsts = first.select("_conv", F.col("_first").alias("_pos"), F.lit(True).alias("_new"))
    judged = join_on(rows, firsts, ["_conv", "_pos"], "left")
    judged = judged.withColumn("_fault", turn_faults(F.col("_text"), F.col("_new").isNull())).drop("_new")
    judged = stage(judged, "judged")

    codes = judged.select("_conv", (F.expr(f"_pos div {block_turns}")).alias("_block"), "_pos", _turn_code(F.col("_role"), F.col("_fault")).alias("_code"))
    letters = F.sort_array(F.collect_list(F.struct("_pos", "_code")))
    blocks = codes.groupBy("_conv", "_block").agg(F.array_join(F.transform(letters, lambda x: x["_code"]), "").alias("_codes"))

    def align(batches):
        known = {}
        for batch in batches:
            codes, numbers = batch.column(2).to_pylist(), batch.column(1).to_pylist()
            out = []
            for code, number in zip(codes, numbers):
                alone = number == 0 and len(code) < block_turns
                if (code, alone) not in known:
                    if len(known) > 10_000:
                        known.clear()
                    block = Block(code, alone)
                    made = {("B", "A"): block.whole()} if alone else block.options()
                    known[code, alone] = [{"state": s, "end": e, "cost": c, "audit": a} for (s, e), (c, a) in made.items()]
                out.append(known[code, alone])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([number == 0 and len(c) < block_turns for c, number in zip(codes, numbers)]),
                 pa.array(out, pa.list_(pa.struct([("state", pa.string()), ("end", pa.string()), ("cost", pa.int64()), ("audit", pa.string())])))],
                [*batch.schema.names, "_alone", "_options"],
            )

    kind = dict(blocks.dtypes)["_conv"]
    head = f"_conv {kind}, _block long, _codes string"
    aligned = stage(blocks.mapInArrow(align, f"{head}, _alone boolean, _options array<struct<state:string,end:string,cost:bigint,audit:string>>"), "aligned")
    alone = aligned.where("_alone").select("_conv", "_block", "_codes", F.lit("B").alias("_state"), F.col("_options")[0]["audit"].alias("_audit"))

    def join_blocks(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("_block")
        path = shortest_path([{(o["state"], o["end"]): (int(o["cost"]), o["audit"]) for o in options} for options in group["_options"]])
        return pd.DataFrame({
            "_conv": group["_conv"], "_block": group["_block"], "_codes": group["_codes"],
            "_state": [s for s, _ in path], "_audit": [a for _, a in path],
        })

    cut = aligned.where("NOT _alone").drop("_alone")
    joined = cut.groupBy("_conv").applyInPandas(join_blocks, f"{head}, _state string, _audit string")

    def list_steps(batches):
        for batch in batches:
            made = [_steps(*row) for row in zip(*(batch.column(i).to_pylist() for i in (2, 4, 3)))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(4), pa.array([m[0] for m in made], pa.list_(pa.int32())), pa.array([m[1] for m in made], pa.string())],
                ["_conv", "_block", "_audit", "_at", "_targets"],
            )

    edits = alone.unionByName(joined).mapInArrow(list_steps, f"_conv {kind}, _block long, _audit string, _at array<int>, _targets string")
    each = edits.select("_conv", "_block", "_audit", "_targets", F.posexplode("_at").alias("_step", "_at")).select(
        "_conv", "_block", "_step", (F.col("_block") * block_turns + F.col("_at")).alias("_pos"),
        F.expr("substring(_audit, _step + 1, 1)").alias("_edit"), F.expr("substring(_targets, _step + 1, 1)").alias("_target"),
    )
    whole = join_on(each, judged, ["_conv", "_pos"], "left")
    target = F.when(F.col("_edit") == "K", F.col("_role")).when(F.col("_target") == "u", ROLES["u"]).when(F.col("_target") == "a", ROLES["a"])
    return whole.select(
        F.col("_conv").alias("conv_id"), F.col("_block").alias("block"), F.col("_step").alias("step"), F.col("_edit").alias("edit"),
        F.col("_pos").alias("pos"), F.col("_turn").alias("turn"), F.col("_role").alias("role"), F.col("_text").alias("text"),
        F.col("_fault").alias("fault"), target.alias("target"),
    )


def summaries(edits: DataFrame) -> DataFrame:
    """Per conversation: gaps, counts of faults and of illegal neighbours, cost, audit and the repaired text's digest.

    Reads the edits of a conversation in order, one row at a time, and holds only the audit and the running
    digest; SHA-256 is sequential, so one conversation is one task's work.
    """
    kind = dict(edits.dtypes)["conv_id"]
    ordered = edits.repartition("conv_id").sortWithinPartitions("conv_id", "block", "step").select(
        "conv_id", "edit", F.col("turn").cast("long").alias("turn"), "role", "text", "fault", "target"
    )
    schema = (
        f"conv_id {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
    )

    def run(batches):
        out, now = [], None

        def close():
            turns = now["last"] - now["first"] + 1 - now["turns"] if now["turns"] else 0
            out.append([now["conv"], turns, *(now[f] for f in ("blank", "duplicate", "truncated")), now["illegal"], now["cost"], "".join(now["audit"]), now["digest"].hexdigest()])

        def flush():
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(map(list, zip(*out)), types)], names)
            out.clear()
            return batch

        names = [part.split()[0] for part in schema.split(", ")]
        types = None
        for batch in batches:
            types = types or [batch.schema.field(0).type, *[pa.int64()] * 6, pa.string(), pa.string()]
            for conv, edit, turn, role, text, fault, target in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or now["conv"] != conv:
                    if now is not None:
                        close()
                    now = {"conv": conv, "first": None, "last": None, "turns": 0, "blank": 0, "duplicate": 0, "truncated": 0,
                           "illegal": 0, "cost": 0, "audit": [], "digest": hashlib.sha256(), "role": None, "open": False}
                now["audit"].append(edit)
                now["cost"] += {"K": 0, "R": REROLE, "D": DELETE, "I": INSERT}[edit] + (UNTRUE if fault == "truncated" and edit != "D" else 0)
                if edit != "I":
                    if turn is not None and turn != now["last"]:
                        now["first"] = turn if now["first"] is None else now["first"]
                        now["last"], now["turns"] = turn, now["turns"] + 1
                    if fault:
                        now[fault] += 1
                    if now["role"] is not None:
                        now["illegal"] += now["role"] + role[:1] not in ("su", "ua", "au")
                    now["role"] = role[:1]
                if edit != "D":
                    now["digest"].update((("\n" if now["open"] else "") + f"{target}:{text if edit != 'I' else ''}").encode())
                    now["open"] = True
            if len(out) >= 1000:
                yield flush()
        if now is not None:
            close()
        if out:
            yield flush()

    return ordered.mapInArrow(run, schema)


ship_with_tasks(__name__)
