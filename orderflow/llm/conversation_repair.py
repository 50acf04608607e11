"""Repair of conversations whose turns lost their structure, by cheapest edits.

A repaired conversation reads: perhaps a system turn, then user and assistant turns in
alternation, ending with the assistant; or it has no turn at all.  Rows may be kept,
given the role of user or assistant, or deleted, and empty turns may be inserted.

An edit moves between four states: nothing yet, after a system, user or assistant turn.
From the back, each row turns the costs of the four states up to the end into those one
row earlier.  Once their least is taken off, only few such cost vectors exist, so the
step over every block of ``BLOCK`` row symbols is a precomputed lookup (Four Russians).
Blocks are looked up from the end, then expanded from the back into the vector after each
row; the forward walk takes the least letter among the cheapest edits at every row, which
is the least of all cheapest edit texts.

Conversations may be of any length.  Rows are put in order by ranges, so a long
conversation lies in many tasks; each run of up to a batch of rows is a piece that sends
the effect of its symbols as a matrix of four by four costs.  Only these, and then the
state in which each piece is entered, pass along a conversation.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from orderflow.llm.common import long_rows, saved

# States: nothing yet, and after a system, user or assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
# A row's symbol is twice the class of its role's first letter, plus one if its text is cut
# off.  A row that must go has a symbol that changes no state; it costs a deletion.
ROLE_CLASSES = "sua"
OTHER, MUST_GO, SYMBOLS = 3, 8, 9
BLOCK = 4
BIG = 1 << 40
# Classes of two adjacent rows that follow each other rightly.
FOLLOWS = {(0, 1), (1, 2), (2, 1)}

BLANKS = " \t\n\x0b\f\r"
COMPLETE, TRUNCATED, BLANK = range(3)

CONVERSATION = ["has_conv", "conv"]
KEY = [*CONVERSATION, "has_turn", "turn", "role", "one", "two"]
_HEAD = [("has_conv", pa.bool_()), ("conv", pa.int64()), ("place", pa.int64())]
_KEY_TYPES = [pa.bool_(), pa.int64(), pa.bool_(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
# Counts of a piece, and what its neighbours need of it.
_SUMS = ["blank", "duplicate", "truncated", "illegal", "turns", "least_turn", "last_turn"]
_COUNTS = [(name, pa.int64()) for name in _SUMS]
_CLASSES = [("first_class", pa.int32()), ("last_class", pa.int32())]
_ROW = [*zip(KEY[2:], _KEY_TYPES[2:], strict=True), ("n", pa.int64()), ("symbol", pa.int32())]
_WAY = pa.struct([("audit", pa.string()), ("cost", pa.int64()), ("to", pa.int32())])
PIECES = pa.schema(
    [
        *_HEAD,
        *_COUNTS,
        *_CLASSES,
        ("matrix", pa.list_(pa.int64())),
        ("rows", pa.list_(pa.struct(_ROW))),
    ]
)
ENDS = pa.schema([("place", pa.int64()), ("end", pa.int32())])
TRACED = pa.schema([*_HEAD, *_COUNTS, *_CLASSES, ("end", pa.int32()), ("ways", pa.list_(_WAY))])
CHOSEN = pa.schema(
    [
        *_HEAD,
        *_COUNTS,
        ("end", pa.int32()),
        ("state", pa.int32()),
        ("cost", pa.int64()),
        ("audit", pa.string()),
    ]
)
_TOLD = ["edit", "new_role", "before", "after"]
EDITS = pa.schema(
    [*zip(KEY, _KEY_TYPES, strict=True), *((name, pa.string()) for name in _TOLD)]
)
REPAIRED = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("turn", pa.int64()),
        ("edit", pa.string()),
        ("role", pa.string()),
        ("text", pa.string()),
    ]
)
DIGESTS = pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())])


@dataclass(frozen=True)
class Costs:
    """What edits cost; ``truncated`` is added for a cut-off row that stays."""

    rerole: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5

    def __post_init__(self) -> None:
        if min(self.rerole, self.delete, self.truncated) < 0 or self.insert < 1:
            raise ValueError("costs must not be negative, and insertions must cost something")


class BlockTables:
    """Steps of normalised cost vectors over one symbol and over blocks of them."""

    def __init__(self, costs: Costs):
        self.costs = costs
        # The state after a turn of user or assistant, which the state before decides.
        self.alternate = (USER, USER, ASSISTANT, USER)
        end = [BIG] * 4
        end[START] = end[ASSISTANT] = 0
        units = [[0 if q == k else BIG for q in range(4)] for k in range(4)]
        self.vectors: list[tuple[int, ...]] = []
        self.number: dict[tuple[int, ...], int] = {}
        self.end, *self.units = [self.enter(self._relax(v)) for v in (end, *units)]
        steps = []
        for vector in self.vectors:  # grows while it is read
            steps.append([self.enter(self._step(vector, x)) for x in range(SYMBOLS)])
        self.one = [[number for number, _ in row] for row in steps]
        self.one_cost = [[cost for _, cost in row] for row in steps]
        self.choices = [
            [[self._walk(v, x, q) for q in range(4)] for x in range(SYMBOLS)] for v in self.vectors
        ]
        to, cost = np.array(self.one), np.array(self.one_cost)
        for _ in range(2):  # blocks of two, then of four
            cost = (cost[:, :, None] + cost[to]).transpose(0, 2, 1).reshape(len(to), -1)
            to = to[to].transpose(0, 2, 1).reshape(len(to), -1)
        self.block, self.block_cost = to.tolist(), cost.tolist()

    def enter(self, vector: list[int]) -> tuple[int, int]:
        """The number of a vector without its least value, and that value."""
        low = min(vector)
        key = tuple(BIG if v >= BIG // 2 else v - low for v in vector)
        if key not in self.number:
            self.number[key] = len(self.vectors)
            self.vectors.append(key)
        return self.number[key], low

    def _relax(self, vector: list[int]) -> list[int]:
        for _ in range(3):
            vector = [min(v, self.costs.insert + vector[self.alternate[q]]) for q, v in enumerate(vector)]
        return vector

    def _edits(self, x: int, q: int) -> list[tuple[str, int, int]]:
        """Letter, cost and next state of the edits of a row that may stay, but insertions."""
        role, cut = divmod(x, 2)
        extra = self.costs.truncated * cut
        found = [("D", self.costs.delete, q)]
        if role == 0 and q == START:
            found.append(("K", extra, SYSTEM))
        if role < OTHER and role != 0 and role + 1 == self.alternate[q]:
            found.append(("K", extra, self.alternate[q]))
        found.append(("R", extra + self.costs.rerole, self.alternate[q]))
        return found

    def _step(self, after: tuple[int, ...], x: int) -> list[int]:
        if x == MUST_GO:
            return list(after)
        return self._relax(
            [min(cost + after[to] for _, cost, to in self._edits(x, q)) for q in range(4)]
        )

    def _walk(self, after: tuple[int, ...], x: int, q: int) -> tuple[str, int, int] | None:
        """The least letters on a cheapest way over a row, their cost and the next state."""
        if x == MUST_GO:
            return "", 0, q
        letters, spent, here = "", 0, self._step(after, x)
        if here[q] >= BIG // 2:
            return None
        while True:
            ways = [
                *self._edits(x, q),
                ("I", self.costs.insert, self.alternate[q]),
            ]
            good = [
                way
                for way in ways
                if way[1] + (here if way[0] == "I" else after)[way[2]] == here[q]
            ]
            letter, cost, q = min(good)
            letters, spent = letters + letter, spent + cost
            if letter != "I":
                return letters, spent, q

    def tail(self, q: int) -> tuple[str, int]:
        """The insertions that end a conversation, and their cost."""
        letters = ""
        while q not in (START, ASSISTANT):
            letters, q = letters + "I", self.alternate[q]
        return letters, len(letters) * self.costs.insert

    @staticmethod
    def blocks(symbols: list[int]) -> list[int]:
        """The symbols as numbers of blocks; the last is filled up."""
        padded = [*symbols, *[MUST_GO] * (-len(symbols) % BLOCK)]
        codes = []
        for k in range(0, len(padded), BLOCK):
            code = 0
            for x in padded[k : k + BLOCK]:
                code = code * SYMBOLS + x
            codes.append(code)
        return codes

    def pull(self, vector: int, codes: list[int]) -> tuple[int, int]:
        """The vector before these blocks and its least value, from the one after them."""
        total = 0
        for code in reversed(codes):
            total += self.block_cost[vector][code]
            vector = self.block[vector][code]
        return vector, total

    def matrix(self, symbols: list[int]) -> list[int]:
        """Cost from each state before the symbols (row) to each one after them."""
        codes, columns = self.blocks(symbols), []
        for number, low in self.units:
            vector, total = self.pull(number, codes)
            columns.append([min(BIG, v + total + low) for v in self.vectors[vector]])
        return [columns[k][q] for q in range(4) for k in range(4)]

    def trace(self, symbols: list[int], end: int, q: int) -> tuple[list[str], int, int]:
        """Letters by row, their cost and the state after, on the least cheapest way."""
        codes = self.blocks(symbols)
        after = [0] * (BLOCK * len(codes))
        vector = end
        for k in range(len(codes) - 1, -1, -1):
            number = vector
            for row in range(BLOCK * k + BLOCK - 1, BLOCK * k - 1, -1):
                after[row] = number
                if row < len(symbols):
                    number = self.one[number][symbols[row]]
            vector = self.block[vector][codes[k]]
        letters, total = [], 0
        for x, number in zip(symbols, after, strict=False):
            found, cost, q = self.choices[number][x][q]
            letters.append(found)
            total += cost
        return letters, total, q


@functools.lru_cache(maxsize=4)
def tables(costs: Costs) -> BlockTables:
    return BlockTables(costs)


def _rows(conversations: DataFrame) -> DataFrame:
    """Rows with keys that are never null, and how their text ends."""
    role = F.coalesce(F.col("role").cast("string"), F.lit(" "))
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    trimmed = F.rtrim(text, F.lit(BLANKS))
    whole = F.right(trimmed, F.lit(1)).isin(".", "!", "?")
    conv, turn = F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint")
    return conversations.select(
        conv.isNotNull().alias("has_conv"),
        F.coalesce(conv, F.lit(0)).alias("conv"),
        turn.isNotNull().alias("has_turn"),
        F.coalesce(turn, F.lit(0)).alias("turn"),
        role.alias("role"),
        F.xxhash64(F.lit(1), text).alias("one"),
        F.xxhash64(F.lit(2), text).alias("two"),
        F.when(trimmed == "", BLANK).when(whole, COMPLETE).otherwise(TRUNCATED).alias("ending"),
        text.alias("text"),
    )


def _runs(batch: pa.RecordBatch) -> np.ndarray:
    """Where conversations begin in a batch, and its end."""
    has, conv = (batch.column(name).to_numpy(zero_copy_only=False) for name in CONVERSATION)
    change = (has[1:] != has[:-1]) | (conv[1:] != conv[:-1])
    return np.concatenate(([0], np.flatnonzero(change) + 1, [len(conv)]))


def _pieces(costs: Costs):
    """A row for each conversation in a batch of rows in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, place = tables(costs), TaskContext.get().partitionId() << 33
        for batch in batches:
            if not batch.num_rows:
                continue
            col = {
                name: batch.column(name).to_numpy(zero_copy_only=False)
                for name in ("has_turn", "turn", "n", "ending", "seen")
            }
            first = [ROLE_CLASSES.find(role[:1]) if role else -1 for role in batch.column("role").to_pylist()]
            kind = np.array([OTHER if k < 0 else k for k in first], np.int32)
            blank, seen = col["ending"] == BLANK, col["seen"]
            cut = (col["ending"] == TRUNCATED) & ~seen
            symbol = np.where(blank | seen, MUST_GO, 2 * kind + cut).astype(np.int32)
            again = np.where(blank, 0, np.where(seen, col["n"], col["n"] - 1))
            pair = np.array(
                [(a, b) not in FOLLOWS for a, b in zip(kind[:-1].tolist(), kind[1:].tolist(), strict=True)],
                np.int64,
            )
            bounds = _runs(batch)
            rows = pa.StructArray.from_arrays(
                [*(batch.column(name) for name in (*KEY[2:], "n")), pa.array(symbol)],
                fields=[pa.field(*field) for field in _ROW],
            )
            out: list[tuple] = []
            for k, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
                turns = col["turn"][a:b][col["has_turn"][a:b]]
                mine = symbol[a:b]
                out.append(
                    (
                        place + k,
                        int(col["n"][a:b][blank[a:b]].sum()),
                        int(again[a:b].sum()),
                        int((cut & ~blank)[a:b].sum()),
                        int((col["n"][a:b] - 1).sum() + pair[a : b - 1].sum()),
                        int((turns[1:] != turns[:-1]).sum() + 1) if len(turns) else 0,
                        int(turns[0]) if len(turns) else None,
                        int(turns[-1]) if len(turns) else None,
                        int(kind[a]),
                        int(kind[b - 1]),
                        table.matrix(mine[mine != MUST_GO].tolist()),
                    )
                )
            place += len(bounds) - 1
            head = pa.array(bounds[:-1])
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(name).take(head) for name in CONVERSATION),
                    *_arrays(out, PIECES.types[2:-1]),
                    pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), rows),
                ],
                schema=PIECES,
            )

    return run


def _arrays(rows: list[tuple], types: list[pa.DataType]) -> list[pa.Array]:
    columns = zip(*rows, strict=True) if rows else [()] * len(types)
    return [pa.array(column, kind) for column, kind in zip(columns, types, strict=True)]


def _tuples(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(_arrays(rows, schema.types), schema=schema)


def _ends(costs: Costs):
    """From the last piece of a conversation to its first: the cost vector behind each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, last, vector = tables(costs), None, ()
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if (row["has_conv"], row["conv"]) != last:
                    last, vector = (row["has_conv"], row["conv"]), table.vectors[table.end[0]]
                number, _ = table.enter(list(vector))
                out.append((row["place"], number))
                m = row["matrix"]
                vector = [min(m[4 * q + k] + vector[k] for k in range(4)) for q in range(4)]
                low = min(vector)
                vector = tuple(v - low for v in vector)
            yield _tuples(out, ENDS)

    return run


def _letters(rows: list[dict], found: list[str]) -> Iterator[tuple[dict, str]]:
    """Each row with its letters; a row that must go is deleted."""
    letters = iter(found)
    for row in rows:
        yield row, "D" if row["symbol"] == MUST_GO else next(letters)


def _traces(costs: Costs):
    """What a piece does from each state in which it may be entered."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = tables(costs)
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                symbols = [r["symbol"] for r in row["rows"] if r["symbol"] != MUST_GO]
                gone = sum(r["n"] for r in row["rows"]) - len(symbols)
                here, _ = table.pull(row["end"], table.blocks(symbols))
                ways = []
                for q in range(4):
                    if table.vectors[here][q] >= BIG // 2:
                        ways.append(None)
                        continue
                    found, cost, to = table.trace(symbols, row["end"], q)
                    audit = "".join(
                        letters + "D" * (r["n"] - 1) for r, letters in _letters(row["rows"], found)
                    )
                    ways.append({"audit": audit, "cost": cost + gone * costs.delete, "to": to})
                out.append({k: v for k, v in row.items() if k != "rows"} | {"ways": ways})
            yield pa.RecordBatch.from_pylist(out, schema=TRACED)

    return run


def _choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From the first piece of a conversation to its last: the state each is entered in.

    What two pieces share, a turn or a pair of adjacent rows, is counted here.
    """
    last, state, kind, turn = None, START, None, None
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if (row["has_conv"], row["conv"]) != last:
                last, state, kind, turn = (row["has_conv"], row["conv"]), START, None, None
            if kind is not None and (kind, row["first_class"]) not in FOLLOWS:
                row["illegal"] += 1
            if turn is not None and turn == row["least_turn"]:
                row["turns"] -= 1
            kind = row["last_class"]
            turn = row["last_turn"] if row["last_turn"] is not None else turn
            way = row["ways"][state]
            out.append(
                {name: row[name] for name in ("has_conv", "conv", "place", *_SUMS, "end")}
                | {"state": state, "cost": way["cost"], "audit": way["audit"]}
            )
            state = way["to"]
        yield pa.RecordBatch.from_pylist(out, schema=CHOSEN)


def _edits(costs: Costs):
    """The rows that stay, with the edit of each; insertions go with the row they precede."""
    names = ("user", "assistant")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = tables(costs)
        for batch in batches:
            out = []
            for piece in batch.to_pylist():
                symbols = [r["symbol"] for r in piece["rows"] if r["symbol"] != MUST_GO]
                q = piece["state"]
                found, _, _ = table.trace(symbols, piece["end"], q)
                waiting = ""
                for row, letters in _letters(piece["rows"], found):
                    edit, before = letters[-1], waiting
                    for _ in letters[:-1]:
                        q = table.alternate[q]
                        before += "ua"[q - USER]
                    if edit == "D":
                        waiting = before
                        continue
                    waiting, new = "", row["role"]
                    if edit == "K" and row["symbol"] // 2 == 0:
                        q = SYSTEM
                    else:
                        q = table.alternate[q]
                        new = names[q - USER] if edit == "R" else new
                    out.append((*_key(piece, row), edit, new, before, ""))
                if waiting or (piece["last"] and q not in (START, ASSISTANT)):
                    tail = waiting
                    while piece["last"] and q not in (START, ASSISTANT):
                        q = table.alternate[q]
                        tail += "ua"[q - USER]
                    out.append((*_key(piece, piece["rows"][-1]), "I", None, "", tail))
            yield _tuples(out, EDITS)

    return run


def _key(piece: dict, row: dict) -> tuple:
    return *(piece[name] for name in CONVERSATION), *(row[name] for name in KEY[2:])


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edits come before the texts that have their key; one text is taken for each edit.

    The inserted turns that follow a row come after its text.
    """
    key, open_row = None, None
    late: list[tuple] = []

    def inserted(row: tuple, letters: str) -> list[tuple]:
        names = {"u": "user", "a": "assistant"}
        return [(row[1] if row[0] else None, None, "I", names[x], "") for x in letters]

    for batch in batches:
        columns = [batch.column(name).to_pylist() for name in (*KEY, *_TOLD, "text")]
        out: list[tuple] = []
        for row in zip(*columns, strict=True):
            if row[:7] != key:
                out += late
                key, open_row, late = row[:7], None, []
            edit, new_role, before, after, text = row[7:]
            if edit == "I":
                late = inserted(row, after)
            elif edit is not None:
                open_row = (edit, new_role, before)
            elif open_row is not None:
                edit, new_role, before = open_row
                out += inserted(row, before)
                has_conv, conv, has_turn, turn = row[:4]
                out.append(
                    (conv if has_conv else None, turn if has_turn else None, edit, new_role, text)
                )
                open_row = None
        yield _tuples(out, REPAIRED)
    if late:
        yield _tuples(late, REPAIRED)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hash of each conversation's ``role:text`` lines, whose rows come one after another."""
    last, digest = (), None
    for batch in batches:
        out = []
        names = ("conv_id", "role", "text")
        for conv, role, text in zip(*(batch.column(n).to_pylist() for n in names), strict=True):
            if (conv,) != last:
                if digest is not None:
                    out.append((*last, digest.hexdigest()))
                last, digest = (conv,), hashlib.sha256()
            else:
                digest.update(b"\n")
            digest.update(f"{role}:{text}".encode())
        yield _tuples(out, DIGESTS)
    if digest is not None:
        yield _tuples([(*last, digest.hexdigest())], DIGESTS)


def repair(conversations: DataFrame, costs: Costs | None = None) -> tuple[DataFrame, DataFrame]:
    """What was wrong with each conversation, and the rows of the repaired ones.

    Rows are taken by turn, nulls first; rows of one turn by role and a hash of the text.
    A null role or text is one space; an empty role has no legal first letter.  A row's first
    fault counts: ``blank`` (no visible character), ``duplicate`` (role and text seen
    earlier in the conversation, by a hash of 128 bits), ``truncated`` (the last visible
    character does not end a sentence).  Null ids are one conversation.  Other columns are
    ignored; an empty table gives empty ones.

    The first frame has a row for each id: ``conv_id``, ``gaps`` (turn numbers missing
    between the least and the greatest, null beyond 64 bits), the faults, ``illegal``
    (adjacent rows whose roles do not follow each other), ``cost`` and ``audit``, the
    letters of the cheapest edits: Keep, Rerole, Delete, Insert.  The second has
    ``conv_id, turn, edit, role, text``; each of its partitions holds conversations whole,
    one after another and in order.
    """
    costs = costs or Costs()
    long_rows(conversations.sparkSession)
    rows = _rows(conversations)
    counted = rows.groupBy(*KEY, "ending").agg(F.count("*").alias("n"))
    same = [*CONVERSATION, "role", "one", "two"]
    first = counted.groupBy(*same).agg(F.min(F.struct("has_turn", "turn")).alias("first"))
    marked = counted.join(first, same).withColumn(
        "seen", F.struct("has_turn", "turn") != F.col("first")
    )
    ordered = marked.drop("first").repartitionByRange(*KEY).sortWithinPartitions(*KEY)
    pieces = saved(ordered.mapInArrow(_pieces(costs), from_arrow_schema(PIECES)), "pieces")

    back = pieces.select(*CONVERSATION, "place", "matrix").repartition(*CONVERSATION)
    back = back.sortWithinPartitions(*CONVERSATION, F.desc("place"))
    ends = back.mapInArrow(_ends(costs), from_arrow_schema(ENDS))
    traced = pieces.drop("matrix").join(ends, "place").select(
        *CONVERSATION, "place", *_SUMS, "first_class", "last_class", "end", "rows"
    )
    traced = traced.mapInArrow(_traces(costs), from_arrow_schema(TRACED))
    forth = traced.repartition(*CONVERSATION).sortWithinPartitions(*CONVERSATION, "place")
    chosen = saved(forth.mapInArrow(_choose, from_arrow_schema(CHOSEN)), "chosen")

    by_place = F.sort_array(F.collect_list(F.struct("place", "audit")))
    span = F.try_subtract(F.max("last_turn"), F.min("least_turn"))
    found = chosen.groupBy(*CONVERSATION).agg(
        F.coalesce(F.try_add(span, F.lit(1)) - F.sum("turns"), F.when(F.sum("turns") == 0, 0))
        .cast("bigint")
        .alias("gaps"),
        *[F.sum(name).alias(name) for name in ("blank", "duplicate", "truncated", "illegal")],
        F.sum("cost").alias("cost"),
        # One letter for each row of the conversation: the size of the row asked for.
        F.array_join(F.transform(by_place, lambda x: x["audit"]), "").alias("audit"),
    )
    conv_id = F.when(F.col("has_conv"), F.col("conv")).alias("conv_id")
    faults = found.select(conv_id, *found.columns[2:])

    last = chosen.groupBy(*CONVERSATION).agg(F.max("place").alias("place")).select(
        "place", F.lit(True).alias("last")
    )
    kept = chosen.select("place", "end", "state").join(last, "place", "left")
    kept = pieces.join(kept, "place").select(
        *CONVERSATION, "end", "state", F.coalesce("last", F.lit(False)).alias("last"), "rows"
    )
    edits = kept.mapInArrow(_edits(costs), from_arrow_schema(EDITS))
    told = edits.withColumn("text", F.lit(None).cast("string"))
    untold = [F.lit(None).cast("string").alias(name) for name in _TOLD]
    texts = rows.select(*KEY, *untold, "text")
    both = told.unionByName(texts).repartition(*CONVERSATION)
    both = both.sortWithinPartitions(*KEY, F.asc_nulls_last("edit"))
    return faults, both.mapInArrow(_merge, from_arrow_schema(REPAIRED))


def digests(repaired: DataFrame) -> DataFrame:
    """``conv_id`` and the hash of its ``role:text`` lines; a conversation without rows has none.

    Takes the second frame of :func:`repair`.  A hash is made from front to back, so one
    task reads a conversation's texts; it holds one batch of them at a time.
    """
    return repaired.mapInArrow(_digests, from_arrow_schema(DIGESTS))
