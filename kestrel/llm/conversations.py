"""Repair of conversation structure by a search for the cheapest edits.

A conversation is well formed if its roles are an optional ``s`` and then ``ua`` pairs
(or nothing at all).  Iterative-deepening A*: depth-first search tries the edits of
each row in ASCII order (Delete, Insert, Keep, Rerole) under a cost bound; a table
of failed states keeps the cost each of them is known to need at least, and the
next bound is what the root needs.  The first accepting path has the least cost
and, among those, the least string of edits.

Conversations are cut into blocks of ``BLOCK`` rows.  Usually one block is the whole
conversation and is solved from start to acceptance.  For longer ones every block is
solved between each pair of states it can be entered and left in; a fold over these
small tables (four states a block) picks the states in between, so that the search of a
conversation with a third of all rows is spread over all tasks too.  Edits that
insert stand before the row they precede, so strings of edits of one block never
are beginnings of each other and their order carries over to the whole string."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from kestrel.llm.scratch import stored
from kestrel.session import cut_lineage

BLOCK, BLOCK_CHARS = 64, 4 << 20
WHITE = " \t\n\x0b\x0c\r"

# states: what the repaired conversation ends with so far
START, SYSTEM, USER, ASSISTANT = range(4)
_NEXT_ROLE = {START: "user", SYSTEM: "user", USER: "assistant", ASSISTANT: "user"}
_AFTER = {"u": USER, "a": ASSISTANT}
_TAIL = {START: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}  # inserts that finish a conversation
INFINITE = 1 << 30
OK, BLANK, DUPLICATE, TRUNCATED = "kbdt"
COST = {"D": 2, "I": 5, "K": 0, "R": 1}
LEAVE_TRUNCATED = 5


class Search:
    """Cheapest edits of ``rows`` ((role initial, fault) each) that lead to a state of
    ``goal`` behind the last row; ``tail`` allows inserts there too."""

    def __init__(self, rows: list[tuple[str, str]], goal: set[int], tail: bool):
        self.rows, self.goal, self.tail = rows, goal, tail
        self.needs: dict[tuple[int, int], int] = {}   # failed states: the least they need
        self.sure = [0] * (len(rows) + 1)              # cost of the rows from i on, whatever their neighbours
        for i in range(len(rows) - 1, -1, -1):
            initial, fault = rows[i]
            self.sure[i] = self.sure[i + 1] + (2 if fault != OK else 0 if initial in ("u", "a", "s") else 1)

    def least(self, i: int, state: int) -> int:
        return self.needs.get((i, state), self.sure[i])

    def edits(self, i: int, state: int) -> Iterator[tuple[str, int, int, int]]:
        """(edit, cost, next row, next state) in ASCII order."""
        role = _NEXT_ROLE[state][0]
        inside = i < len(self.rows)
        if inside:
            yield "D", COST["D"], i + 1, state
        if inside or self.tail:
            yield "I", COST["I"], i, _AFTER[role]
        if inside and self.rows[i][1] in (OK, TRUNCATED):
            initial, fault = self.rows[i]
            extra = LEAVE_TRUNCATED if fault == TRUNCATED else 0
            if initial == role:
                yield "K", COST["K"] + extra, i + 1, _AFTER[role]
                return
            if initial == "s" and state == START:
                yield "K", COST["K"] + extra, i + 1, SYSTEM
            yield "R", COST["R"] + extra, i + 1, _AFTER[role]

    def within(self, i: int, state: int, budget: int) -> str | None:
        if self.least(i, state) > budget:
            return None
        if i == len(self.rows) and state in self.goal:
            return ""
        least = INFINITE
        for edit, cost, j, after in self.edits(i, state):
            if cost + self.least(j, after) <= budget:
                rest = self.within(j, after, budget - cost)
                if rest is not None:
                    return edit + rest
            least = min(least, cost + self.least(j, after))
        self.needs[(i, state)] = max(least, budget + 1)
        return None

    def best(self, state: int) -> tuple[int, str]:
        """(cost, edits) from ``state``; the goal must be within reach."""
        bound = self.least(0, state)
        while True:
            found = self.within(0, state, bound)
            if found is not None:
                return bound, found
            bound = self.least(0, state)


def repair_block(rows: list[tuple[str, str]]) -> tuple[int, str]:
    """(cost, edits) of a whole conversation."""
    return Search(rows, {START, ASSISTANT}, True).best(START)


def block_table(rows: list[tuple[str, str]]) -> tuple[list[int], list[str]]:
    """Costs and edits from every state to every state (16 entries, row by row); -1
    where the block cannot lead there."""
    costs, edits = [-1] * 16, [""] * 16
    system = any(initial == "s" and fault in (OK, TRUNCATED) for initial, fault in rows)
    for after in range(4):
        search = Search(rows, {after}, False)
        for before in range(4):
            if before == after or after in (USER, ASSISTANT) or (before, after) == (START, SYSTEM) and system:
                costs[4 * before + after], edits[4 * before + after] = search.best(before)
    return costs, edits


def fold(blocks: list[tuple[list[int], list[str] | list[int]]]) -> tuple[int, list[tuple[int, int]]]:
    """(cost, (state before, state after) of each block) from the blocks' costs and
    edits, or ranks of the edits among those from the same state."""
    reached, steps = {START: (0, 0)}, []
    for costs, order in blocks:
        came, key = {}, {}
        for after in range(4):
            ways = [(c + costs[4 * p + after], r, p) for p, (c, r) in reached.items() if costs[4 * p + after] >= 0]
            if ways:
                came[after] = min(ways)
                key[after] = (came[after][1], order[4 * came[after][2] + after])
        ranked = sorted(key, key=key.get)
        reached = {s: (came[s][0], ranked.index(s)) for s in came}
        steps.append({s: came[s][2] for s in came})
    cost, _, state = min((c + COST["I"] * _TAIL[s], r, s) for s, (c, r) in reached.items())
    path = []
    for step in reversed(steps):
        path.append((step[state], state))
        state = step[state]
    return cost, path[::-1]


def apply_edits(edits: str, state: int, roles: list[str], texts: list[str]) -> tuple[list[str], list[str]]:
    """Roles and texts of the repaired turns."""
    out_roles, out_texts, i = [], [], 0
    for e in edits:
        if e == "D":
            i += 1
            continue
        role = roles[i] if e == "K" else _NEXT_ROLE[state]
        out_roles.append(role)
        out_texts.append("" if e == "I" else texts[i])
        state = SYSTEM if role[:1] == "s" else _AFTER[role[:1]]
        i += e != "I"
    return out_roles, out_texts


def illegal_pairs(initials: list[str]) -> int:
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))


# ---- rows with their faults --------------------------------------------
@contextmanager
def _blocks(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> Iterator[DataFrame]:
    """Solved blocks of all conversations, as a stored table."""
    white = F.lit(WHITE)
    rows = turns.select(F.col(conv).alias("c"), F.col(turn).cast("long").alias("t"), F.coalesce(F.col(role), F.lit(" ")).alias("role"),
                        F.coalesce(F.col(text), F.lit(" ")).alias("text")).withColumn("key", F.unhex(F.sha2("text", 256)))
    rows = rows.groupBy("c", "t", "role", "key").agg(F.count(F.lit(1)).alias("copies"), F.any_value("text").alias("text"))
    with stored(rows) as distinct:
        first = distinct.groupBy("c", "role", "key").agg(F.min(F.struct("t")).alias("first"))
        with stored(first.select(F.col("c").alias("fc"), F.col("role").alias("frole"), F.col("key").alias("fkey"), "first")) as firsts:
            same = F.col("c").eqNullSafe(F.col("fc")) & (F.col("role") == F.col("frole")) & (F.col("key") == F.col("fkey"))
            end = F.rtrim("text", white)
            fault = (F.when(end == "", F.lit(BLANK)).when(~F.col("t").eqNullSafe(F.col("first.t")), F.lit(DUPLICATE))
                     .when(~F.substring(end, -1, 1).isin(".", "!", "?"), F.lit(TRUNCATED)).otherwise(F.lit(OK)))
            order = ["c", "t", "role", "key"]
            ready = (distinct.join(firsts, same).select("c", "t", "role", "key", "copies", "text", fault.alias("fault"))
                     .repartitionByRange(*order).sortWithinPartitions(*order))
            schema = T.StructType([ready.schema["c"], ready.schema["t"], *_BLOCK_FIELDS])
            with stored(ready.mapInArrow(_solve(schema), schema)) as blocks:
                yield blocks


_LONGS, _STRINGS = T.ArrayType(T.LongType()), T.ArrayType(T.StringType())
_BLOCK_FIELDS = [T.StructField(n, k) for n, k in (
    ("whole", T.BooleanType()), ("first_role", T.StringType()), ("first_key", T.BinaryType()), ("seq", T.LongType()),
    ("n_rows", T.LongType()), ("t_last", T.LongType()), ("t_min", T.LongType()), ("n_turns", T.LongType()),
    ("blank", T.LongType()), ("duplicate", T.LongType()), ("truncated", T.LongType()), ("illegal", T.LongType()),
    ("initial", T.StringType()), ("last_initial", T.StringType()), ("costs", _LONGS), ("audits", _STRINGS),
    ("roles", _STRINGS), ("texts", _STRINGS))]


def _solve(schema: T.StructType):
    """Cuts sorted rows into blocks and solves each.  Conversations that touch the edge of a partition
    may go on in the next one, so they count as longer ones."""

    def run(batches):
        open_: list[tuple] = []
        conv, parts, seq, edge, waiting = None, 0, 0, True, None

        def flush(whole):
            nonlocal seq, open_, parts
            seq += 1
            parts += 1
            done, open_ = _block_row(open_, whole, seq), []
            return done

        out = []
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
            for c, t, role, key, copies, text, fault in zip(*columns):
                if (c,) != waiting and open_:
                    out.append(flush(parts == 0 and not edge))
                if (c,) != waiting:
                    edge, waiting, parts = waiting is None, (c,), 0
                for k in range(copies):
                    if len(open_) >= BLOCK or open_ and sum(len(r[4]) for r in open_) + len(text) > BLOCK_CHARS:
                        out.append(flush(False))
                    open_.append((c, t, role, key, text if not k else "", fault if not k or fault == BLANK else DUPLICATE))
                if len(out) >= 256:
                    yield _rows(out, schema)
                    out = []
        if open_:
            out.append(flush(False))
        if out:
            yield _rows(out, schema)

    return run


def _block_row(rows: list[tuple], whole: bool, seq: int) -> tuple:
    turns = [r[1] for r in rows if r[1] is not None]
    roles, faults = [r[2] for r in rows], [r[5] for r in rows]
    initials = [r[:1] for r in roles]
    moves = list(zip(initials, faults))
    texts = [r[4] for r in rows]
    if whole:
        cost, edits = repair_block(moves)
        costs, audits = [cost], [edits]
        out_roles, out_texts = apply_edits(edits, START, roles, texts)
    else:
        costs, audits = block_table(moves)
        out_roles, out_texts = roles, texts
    return (rows[0][0], rows[0][1], whole, rows[0][2], rows[0][3], seq, len(rows), turns[-1] if turns else None,
            turns[0] if turns else None, len(set(turns)), faults.count(BLANK), faults.count(DUPLICATE), faults.count(TRUNCATED),
            illegal_pairs(initials), initials[0], initials[-1], costs, audits, out_roles, out_texts)


def _rows(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    arrow = to_arrow_schema(schema)
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(arrow)], schema=arrow)


def _longer(blocks: DataFrame) -> DataFrame:
    """Blocks of the conversations in several blocks with their final ``audit``, ``roles`` and ``texts``
    and the conversation's numbers; in order within their partition, a conversation in one partition."""
    order = ["c", "t", "first_role", "first_key", "seq"]
    long = blocks.where(~F.col("whole"))
    numbers = long.select(*[f for f in blocks.columns if f not in ("audits", "roles", "texts")],
                          F.expr("transform(audits, (a, i) -> cast(array_position(array_sort(array_distinct(slice(audits, 4 * (i div 4) + 1, 4))), a) as long))").alias("ranks"))
    schema = T.StructType([*(blocks.schema[c] for c in order), *(T.StructField(n, T.LongType()) for n in (
        "before", "after", "n_blocks", "place", "gaps", "blank", "duplicate", "truncated", "illegal", "cost"))])

    def states(batches):
        group: list[dict] = []
        out = []
        for batch in batches:
            for row in batch.to_pylist():
                if group and (group[0]["c"],) != (row["c"],):
                    out.extend(_fold_group(group))
                    group = []
                group.append(row)
            if out:
                yield _rows(out, schema)
                out = []
        out = _fold_group(group) if group else []
        if out:
            yield _rows(out, schema)

    chosen = cut_lineage(numbers.repartition("c").sortWithinPartitions(*order).mapInArrow(states, schema))
    mine = chosen.select(*[F.col(c).alias("_" + c) for c in order], *chosen.columns[len(order):])
    same = F.lit(True)
    for c in order:
        same = same & F.col(c).eqNullSafe(F.col("_" + c))
    return (long.drop("blank", "duplicate", "truncated", "illegal").join(mine, same).drop(*["_" + c for c in order])
            .repartition("c").sortWithinPartitions("c", "place"))


def _fold_group(group: list[dict]) -> list[tuple]:
    cost, path = fold([(g["costs"], g["ranks"]) for g in group])
    met = [g for g in group if g["n_turns"]]
    gaps = 0
    if met:
        distinct = sum(g["n_turns"] for g in met) - sum(a["t_last"] == b["t_min"] for a, b in zip(met, met[1:]))
        gaps = met[-1]["t_last"] - met[0]["t_min"] + 1 - distinct
    illegal = sum(g["illegal"] for g in group) + sum(illegal_pairs([a["last_initial"], b["initial"]]) for a, b in zip(group, group[1:]))
    total = [sum(g[c] for g in group) for c in ("blank", "duplicate", "truncated")]
    return [(g["c"], g["t"], g["first_role"], g["first_key"], g["seq"], before, after, len(group), i, gaps, *total, illegal, cost)
            for i, (g, (before, after)) in enumerate(zip(group, path))]


SUMMARY = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _finished(columns: dict) -> tuple[str, list[str], list[str]]:
    """Edits, roles and texts of a block of a longer conversation."""
    before, after = columns["before"], columns["after"]
    edits = columns["audits"][4 * before + after]
    roles, texts = apply_edits(edits, before, columns["roles"], columns["texts"])
    if columns["place"] == columns["n_blocks"] - 1:
        for _ in range(_TAIL[after]):
            roles.append(_NEXT_ROLE[after])
            texts.append("")
            after = _AFTER[_NEXT_ROLE[after][0]]
            edits += "I"
    return edits, roles, texts


def repair(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256), one row
    per conversation id of ``turns`` that has rows.  Rows are taken by turn, null turns
    first, then by role and SHA-256 of the text; null roles and texts count as one
    space, a null id is a conversation of its own, repeated rows are duplicates.  Empty tables give
    no rows; other columns are not read.  The digest of a conversation is one
    running SHA-256, so its repaired texts pass through one task, block by block; nothing else of it does."""
    with _blocks(turns, conv, turn, role, text) as blocks:
        line = F.expr("array_join(transform(arrays_zip(roles, texts), x -> concat(x.roles, ':', x.texts)), '\n')")
        gaps = F.when(F.col("n_turns") > 0, F.col("t_last") - F.col("t_min") + 1 - F.col("n_turns")).otherwise(0).cast("long")
        whole = blocks.where("whole").select("c", gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal",
                                             F.col("costs")[0].alias("cost"), F.col("audits")[0].alias("audit"),
                                             F.sha2(line, 256).alias("repaired_sha256"))
        schema = whole.schema
        parts = _longer(blocks)

        def digest(batches):
            now, sha, edits, empty = None, None, [], True
            for batch in batches:
                out = []
                for i in range(batch.num_rows):
                    row = {n: batch.column(k)[i].as_py() for k, n in enumerate(batch.schema.names)}
                    if row["place"] == 0:
                        sha, edits, empty = hashlib.sha256(), [], True
                    audit, roles, texts = _finished(row)
                    edits.append(audit)
                    for r, t in zip(roles, texts):
                        sha.update(f"{'' if empty else chr(10)}{r}:{t}".encode())
                        empty = False
                    if row["place"] == row["n_blocks"] - 1:
                        out.append((row["c"], *(row[c] for c in SUMMARY), "".join(edits), sha.hexdigest()))
                if out:
                    yield _rows(out, schema)

        longer = parts.mapInArrow(digest, schema)
        return cut_lineage(whole.unionByName(longer).withColumnRenamed("c", conv))


def repaired_turns(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, pos, role, text): the turns of the repaired conversations, ``pos`` from 0; a
    conversation of which nothing is left has no rows.  Rows count as in ``repair``."""
    with _blocks(turns, conv, turn, role, text) as blocks:
        whole = blocks.where("whole").select("c", F.posexplode(F.arrays_zip("roles", "texts")).alias("pos", "x")) \
            .select("c", F.col("pos").cast("long").alias("pos"), F.col("x.roles").alias("role"), F.col("x.texts").alias("text"))
        schema = whole.schema

        def emit(batches):
            at = 0
            for batch in batches:
                for i in range(batch.num_rows):
                    row = {n: batch.column(k)[i].as_py() for k, n in enumerate(batch.schema.names)}
                    at = 0 if row["place"] == 0 else at
                    _, roles, texts = _finished(row)
                    if roles:
                        yield _rows([(row["c"], at + j, r, t) for j, (r, t) in enumerate(zip(roles, texts))], schema)
                    at += len(roles)

        return cut_lineage(whole.unionByName(_longer(blocks).mapInArrow(emit, schema)).withColumnRenamed("c", conv))


def damage(conversations: DataFrame) -> DataFrame:
    """The contract's faults: by crc32 of ``conv_id:turn`` modulo 20 a row is dropped (0), emptied
    (1), loses its sentence ends (2), is repeated (3) or becomes the user's (4)."""
    space = F.lit(" ")
    kind = F.crc32(F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")))) % 20
    text, role = F.coalesce("text", space), F.coalesce("role", space)
    return (conversations.select("conv_id", "turn", F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"),
                                 F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
                                 kind.alias("kind"))
            .where("kind <> 0")
            .withColumn("again", F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
            .drop("kind", "again"))
