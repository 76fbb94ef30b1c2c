"""Cheapest repair of conversations to an optional system turn and pairs of user and assistant.

A row has a symbol: the initial of its role and its fault. What a row costs in each edit is a min-plus
transition between four states (nothing yet, after system, after user, after assistant). Equal symbols
in a row are collapsed; a run of n is advanced by the cached binary powers of its transition, so that
the cost to the end is known at every run from the end backwards. From the front the choices are then
unrolled: of the edits that keep the least cost the one with the least initial, which gives the least
audit, as no audit of the same cost begins with another one.

No conversation is gathered. Equal rows are counted before they are shuffled; rows are range
partitioned in the order of their conversations, so that a long one spans tasks, and are read as a
stream. What lies within one task and one block is solved there. Longer conversations leave in blocks
of at most ``BLOCK`` rows, whose transitions are multiplied: one pass over short rows carries the cost
backwards, every block tells for each state it may be entered in how it is left, one pass carries the
state forwards, and all blocks unroll at once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanwatch.llm.common import remembered, settle

BLOCK = 4_096  # rows of a block
BLOCK_BYTES = 1_000_000  # of text in a block
SHORT = 32  # rows of a conversation whose solution is remembered
SENT_CHARS = 2_000_000  # in one batch of results
PREFIX = 64  # characters of a text that decide about the task of a row

# Blanks, ends of sentences, costs of edits.
BLANKS = " \t\n\x0b\x0c\r"
ENDS = ".!?"
REROLE, DELETE, INSERT, UNFINISHED = 1, 2, 5, 5

# States and what follows a turn of a role in each; -1 where the role may not come.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {
    "s": (SYSTEM, -1, -1, -1),
    "u": (USER, USER, -1, USER),
    "a": (-1, -1, ASSISTANT, -1),
    "x": (-1, -1, -1, -1),
}
# The only turn that may be made in a state, and its role.
MADE = (USER, USER, ASSISTANT, USER)
ROLE = ("user", "user", "assistant", "user")
NEVER = 1 << 60
# Cost to complete a conversation without further rows.
FINISH = (0, 2 * INSERT, INSERT, 0)

# A symbol is the role's initial; raised to upper case the row must go, with a mark it is unfinished.
UNFINISHED_SYMBOL = {"s": "1", "u": "2", "a": "3", "x": "4"}
BASE = {"1": "s", "2": "u", "3": "a", "4": "x"}


def symbol(role: str, fault: str) -> str:
    own = role[:1] if role[:1] in ("s", "u", "a") else "x"
    if fault in ("blank", "duplicate"):
        return own.upper()
    return UNFINISHED_SYMBOL[own] if fault == "truncated" else own


@remembered()
def edits(symbol: str) -> tuple[tuple[tuple[str, int, int], ...], ...]:
    """For each state the edits of a row in order of their initials: initial, cost, next state."""
    out = []
    for state in range(4):
        found = [("D", DELETE, state)]
        if not symbol.isupper():
            own, more = BASE.get(symbol, symbol), UNFINISHED if symbol in BASE else 0
            if NEXT[own][state] >= 0:
                found.append(("K", more, NEXT[own][state]))
            found.append(("R", REROLE + more, MADE[state]))
        out.append(tuple(found))
    return tuple(out)


@remembered()
def transition(symbol: str) -> tuple[tuple[int, ...], ...]:
    """Least cost of getting from state to state over one row, turns put in before it included."""
    row = [[min((c for _, c, n in edits(symbol)[i] if n == j), default=NEVER) for j in range(4)] for i in range(4)]
    out = []
    for state in range(4):
        best, at, cost = list(row[state]), state, 0
        for _ in range(2):
            at, cost = MADE[at], cost + INSERT
            best = [min(b, cost + r) for b, r in zip(best, row[at])]
        out.append(tuple(min(b, NEVER) for b in best))
    return tuple(out)


def times(a, b):
    """Min-plus product of two transitions."""
    return tuple(
        tuple(min(NEVER, *(a[i][k] + b[k][j] for k in range(4))) for j in range(4)) for i in range(4)
    )


@remembered()
def power(symbol: str, exponent: int):
    """The transition of 2 ** ``exponent`` equal rows."""
    if exponent == 0:
        return transition(symbol)
    half = power(symbol, exponent - 1)
    return times(half, half)


def back(matrix, costs: tuple[int, ...]) -> tuple[int, ...]:
    """Costs to the end before a transition, from those behind it."""
    return tuple(min(NEVER, *(matrix[i][j] + costs[j] for j in range(4))) for i in range(4))


def runs(symbols: str) -> list[tuple[str, int]]:
    return [(s, sum(1 for _ in group)) for s, group in groupby(symbols)]


def powers(symbol: str, n: int) -> list:
    """The binary powers that make ``n`` rows; in any order, as they commute."""
    return [power(symbol, k) for k in range(n.bit_length()) if n >> k & 1]


IDENTITY = tuple(tuple(0 if i == j else NEVER for j in range(4)) for i in range(4))


def product(symbols: str):
    """The transition of a whole block."""
    out = IDENTITY
    for own, n in runs(symbols):
        for matrix in powers(own, n):
            out = times(out, matrix)
    return out


@remembered(100_000)
def _stepped(symbol: str, costs: tuple[int, ...]) -> tuple[int, ...]:
    return back(transition(symbol), costs)


def unroll(symbols: str, costs: tuple[int, ...], state: int, last: bool) -> tuple[str, int]:
    """The least audit of the least cost from ``state`` on, and the state it ends in.

    ``costs`` are those behind the block; in the ``last`` one turns may be added at the end.
    """
    parts = runs(symbols)
    behind = [costs]
    for own, n in reversed(parts):
        for matrix in powers(own, n):
            costs = back(matrix, costs)
        behind.append(costs)
    behind.reverse()
    out = []
    for number, (own, n) in enumerate(parts):
        # Costs at each row of the run, counted from their least so that they repeat.
        least = min(behind[number + 1])
        at = [tuple(c - least for c in behind[number + 1])]
        base = [least]
        for _ in range(n):
            before = _stepped(own, at[-1])
            least = min(before)
            at.append(tuple(c - least for c in before))
            base.append(base[-1] + least)
        choices = edits(own)
        for k in range(n, 0, -1):
            shift = base[k - 1] - base[k]
            while True:
                left = at[k][state]
                found = next((e for e in choices[state] if e[1] + at[k - 1][e[2]] + shift == left), None)
                put = INSERT + at[k][MADE[state]] == left
                if put and not (found and found[0] == "D"):
                    out.append("I")
                    state = MADE[state]
                    continue
                out.append(found[0])
                state = found[2]
                break
    if last:
        while FINISH[state]:
            out.append("I")
            state = MADE[state]
    return "".join(out), state


def solved(symbols: str) -> tuple[int, str]:
    """Cost and audit of a whole conversation of few rows."""
    return _short(symbols) if len(symbols) <= SHORT else _solved(symbols)


def _solved(symbols: str) -> tuple[int, str]:
    costs = FINISH
    for own, n in reversed(runs(symbols)):
        for matrix in powers(own, n):
            costs = back(matrix, costs)
    return costs[NOTHING], unroll(symbols, FINISH, NOTHING, True)[0]


_short = remembered(100_000)(_solved)


def lines(audit: str, rows: Iterator[tuple[str, str]], state: int) -> tuple[list[str], list[str]]:
    """Roles and texts that an audit leaves of the rows of a block."""
    roles, texts = [], []
    for edit in audit:
        role, text = (ROLE[state], "") if edit == "I" else next(rows)
        if edit == "D":
            continue
        if edit != "K":
            role, state = ROLE[state], MADE[state]
        else:
            state = NEXT[role[:1]][state]
        roles.append(role)
        texts.append(text)
    return roles, texts


def with_faults(turns: DataFrame) -> DataFrame:
    """Equal rows counted as ``copies``, with the first fault of the first copy.

    ``turns`` has ``conv_id, turn, role, text, copies``. Equal rows are summed before they are shuffled. That a
    role and text came earlier is looked up in a table of those that have several turns.
    """
    keys = ["conv_id", "turn", "role", "text"]
    # Rows that are gone keep their conversation, without their text.
    gone = F.col("copies") == 0
    bare = turns.withColumn("text", F.when(gone, "").otherwise(F.col("text")))
    counted = settle(bare.groupBy(*keys).agg(F.sum("copies").alias("copies")), "turns")
    said = F.rtrim("text", F.lit(BLANKS))
    counted = counted.withColumn("said", F.sha2(F.concat_ws("\0", "role", "text"), 256))
    place = F.struct(F.col("turn").isNotNull().alias("there"), "turn")
    repeated = (
        counted.where((F.col("copies") > 0) & (said != ""))
        .groupBy("conv_id", "said")
        .agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select(F.col("conv_id").alias("of"), "said", "first")
    )
    repeated = settle(repeated, "repeated-turns")
    same = F.col("conv_id").eqNullSafe(F.col("of")) & (counted["said"] == repeated["said"])
    end = F.substring(said, -1, 1)
    fault = (
        F.when(said == "", "blank")
        .when(F.col("first").isNotNull() & (place > F.col("first")), "duplicate")
        .when(~end.isin(*ENDS), "truncated")
        .otherwise("")
    )
    return counted.join(repeated, same, "left").select(*keys, "copies", fault.alias("fault"))


def _block_type(conv: T.DataType) -> T.StructType:
    numbers = ["n_turns", "first_turn", "last_turn", "blank", "duplicate", "truncated", "illegal", "cost"]
    return T.StructType(
        [
            T.StructField("conv_id", conv),
            T.StructField("part", T.LongType()),
            T.StructField("block", T.LongType()),
            T.StructField("open", T.BooleanType()),
            *[T.StructField(n, T.LongType()) for n in numbers],
            T.StructField("first_role", T.StringType()),
            T.StructField("last_role", T.StringType()),
            T.StructField("symbols", T.StringType()),
            T.StructField("audit", T.StringType()),
            T.StructField("roles", T.ArrayType(T.StringType())),
            T.StructField("texts", T.ArrayType(T.StringType())),
            T.StructField("copies", T.ArrayType(T.IntegerType())),
        ]
    )


ILLEGAL_BUT = ("su", "ua", "au")


class _Block:
    """Rows of one conversation that follow each other."""

    def __init__(self):
        self.rows: list[tuple[str, str, int]] = []
        self.symbols: list[str] = []
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.n = self.bytes = self.illegal = self.n_turns = 0
        self.first_turn = self.last_turn = self.first_role = self.last_role = None

    def add(self, turn, role: str, text: str, copies: int, fault: str, seen: bool) -> None:
        """``copies`` equal rows; the first is a duplicate too if one was ``seen`` already."""
        initial = role[:1]
        later = "blank" if fault == "blank" else "duplicate"
        first = later if seen else fault
        self.symbols.append(symbol(role, first) + symbol(role, later) * (copies - 1))
        if first:
            self.counts[first] += 1
        self.counts[later] += copies - 1
        if turn is not None and turn != self.last_turn:
            self.n_turns += 1
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
        if self.n:
            self.illegal += self.last_role + initial not in ILLEGAL_BUT
        else:
            self.first_role = initial
        self.illegal += copies - 1
        self.last_role = initial
        self.rows.append((role, text, copies))
        self.n += copies
        self.bytes += len(text)

    def row(self, conv, part: int, number: int, open_: bool) -> tuple:
        symbols = "".join(self.symbols)
        cost, audit = (None, None) if open_ else solved(symbols)
        if open_:
            roles, texts, copies = (list(c) for c in zip(*self.rows, strict=True)) if self.rows else ([], [], [])
        else:
            (roles, texts), copies = lines(audit, _each(self.rows), NOTHING), None
        return (
            conv, part, number, open_, self.n_turns, self.first_turn, self.last_turn, *self.counts.values(),
            self.illegal, cost, self.first_role, self.last_role, symbols if open_ else None, audit, roles, texts, copies,
        )


def _each(rows) -> Iterator[tuple[str, str]]:
    return ((role, text) for role, text, copies in rows for _ in range(copies))


def _batch(rows: list[tuple], kinds: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kinds)], schema=kinds)


def _arrow(kind: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(kind)


def _sent(rows: Iterator[tuple], kinds: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows in batches of few texts."""
    texts = kinds.get_field_index("texts")
    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += 1_000 + (sum(map(len, row[texts])) if texts >= 0 else 0)
        if chars >= SENT_CHARS:
            yield _batch(held, kinds)
            held, chars = [], 0
    if held:
        yield _batch(held, kinds)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for at in range(0, batch.num_rows, 1_000):
            yield from zip(*(c.to_pylist() for c in batch.slice(at, 1_000).columns), strict=True)


def _cut(faulty: DataFrame, block: int) -> DataFrame:
    """Conversations solved within their task, and the blocks of all others."""
    kind = _block_type(faulty.schema["conv_id"].dataType)
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role"]
    dealt = faulty.repartitionByRange(*order, F.substring("text", 1, PREFIX))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()

        def blocks() -> Iterator[tuple[object, bool, _Block]]:
            """Conversation, whether it is known to have more than one block, and a block."""
            # The first conversation of a task may have begun in another one.
            for place, (conv, rows) in enumerate(groupby(_rows(batches), lambda r: r[0])):
                held, several = _Block(), place == 0
                for _, turn, role, text, copies, fault in rows:
                    seen = False
                    while copies:
                        if held.n >= block or held.bytes >= BLOCK_BYTES:
                            yield conv, True, held
                            held, several = _Block(), True
                        some = min(copies, block - held.n)
                        held.add(turn, role, text, some, fault, seen)
                        copies, seen = copies - some, True
                yield conv, several, held

        def ended() -> Iterator[tuple]:
            waiting, number = None, 0
            for found in blocks():
                if waiting:
                    yield waiting[2].row(waiting[0], part, number, waiting[1])
                    number += 1
                waiting = found
            if waiting:
                # The last one may go on in another task.
                yield waiting[2].row(waiting[0], part, number, True)

        yield from _sent(ended(), _arrow(kind))

    return dealt.sortWithinPartitions(*order, "text").mapInArrow(run, kind)


PLACE = ["conv_id", "part", "block"]


def _carried(slim: DataFrame, ascending: bool, step, out: str) -> DataFrame:
    """Walk the blocks of each conversation in order; ``step(held, row)`` gives a value and what to hold."""
    kind = T.StructType([*slim.schema.fields[:3], *T.StructType.fromDDL(out).fields])
    order = [F.col(c) if ascending else F.col(c).desc() for c in PLACE]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def walked() -> Iterator[tuple]:
            for _, rows in groupby(_rows(batches), lambda r: r[0]):
                held = None
                for row in rows:
                    values, held = step(held, row)
                    yield (*row[:3], *values)

        yield from _sent(walked(), _arrow(kind))

    return slim.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(run, kind)


def _each_block(blocks: DataFrame, make, kind: T.StructType) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _sent((make(row) for row in _rows(batches)), _arrow(kind))

    return blocks.mapInArrow(run, kind)


def _solve_open(blocks: DataFrame) -> DataFrame:
    """Audits and repaired rows of conversations that lie in several blocks."""
    place = _block_type(blocks.schema["conv_id"].dataType)
    keys = T.StructType(place.fields[:3])
    typed = lambda ddl: T.StructType([*keys.fields, *T.StructType.fromDDL(ddl).fields])

    def flat(row: tuple) -> tuple:
        return (*row[:3], [c for line in product(row[3]) for c in line])

    matrices = _each_block(blocks.select(*PLACE, "symbols"), flat, typed("matrix array<long>"))

    def backwards(held, row: tuple) -> tuple:
        costs = FINISH if held is None else held
        matrix = [row[3][i : i + 4] for i in range(0, 16, 4)]
        before = back(matrix, costs)
        return (list(costs), before[NOTHING], held is None), before

    behind = settle(_carried(matrices, False, backwards, "costs array<long>, before long, last boolean"), "blocks-behind")
    at = ["part", "block"]
    named = lambda df: df.drop("conv_id")

    def leaves(row: tuple) -> tuple:
        _, _, _, symbols, costs, last = row
        ends = [unroll(symbols, tuple(costs), s, last)[1] if min(costs) < NEVER else s for s in range(4)]
        return (*row[:3], ends)

    ends = _each_block(
        blocks.select(*PLACE, "symbols").join(named(behind), at).select(*PLACE, "symbols", "costs", "last"),
        leaves,
        typed("ends array<int>"),
    )
    entered = settle(
        _carried(ends, True, lambda held, row: ((held or NOTHING,), row[3][held or NOTHING]), "entered int"),
        "blocks-entered",
    )
    joined = blocks.join(named(behind), at).join(named(entered), at)
    columns = place.names

    def finish(row: tuple) -> tuple:
        own = dict(zip(columns, row))
        costs, before, last, entered = row[len(columns) :]
        audit, _ = unroll(own["symbols"], tuple(costs), entered, last)
        kept = lines(audit, _each(zip(own["roles"], own["texts"], own["copies"])), entered)
        # The cost of the whole conversation stands with its first block.
        own |= {"audit": audit, "roles": kept[0], "texts": kept[1], "copies": None, "symbols": None, "cost": before}
        return tuple(own.values())

    return _each_block(joined.select(*columns, "costs", "before", "last", "entered"), finish, place)


def repair(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """Blocks of repaired conversations, a written table.

    ``turns`` has ``conv_id, turn, role, text`` and may have ``copies``, how often a row is there (0: not at
    all, but its conversation is); other columns are not read. Null roles and texts are one space. The
    rows of a conversation are taken by turn (nulls first), then role and text; rows with a null id are
    one conversation. Rows: ``conv_id, part, block`` (blocks in order), ``audit``, ``roles`` and ``texts`` of
    the repaired rows, and counts for ``summary``. Of several blocks only the first one's ``cost`` is
    that of the conversation. An empty table has no block.
    """
    if "copies" not in turns.columns:
        turns = turns.withColumn("copies", F.lit(1))
    plain = turns.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        F.col("copies").cast("long").alias("copies"),
    )
    found = settle(_cut(with_faults(plain), block), "conversation-blocks")
    open_ = found.where("open")
    if open_.isEmpty():
        return found
    return settle(found.where("NOT open").unionByName(_solve_open(open_)), "conversations")


def repaired_turns(blocks: DataFrame) -> DataFrame:
    """Repaired conversations as rows: ``conv_id, part, block, place, role, text``."""
    rows = F.posexplode(F.arrays_zip("roles", "texts")).alias("place", "row")
    return blocks.select(*PLACE, rows).select(*PLACE, "place", F.col("row.roles").alias("role"), F.col("row.texts").alias("text"))


def summary(blocks: DataFrame) -> DataFrame:
    """One row per conversation, from the blocks of ``repair``.

    ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``. A digest has to be
    read in order, so the blocks of one long conversation pass through one task, as a stream.
    """
    conv = blocks.schema["conv_id"].dataType
    names = ["conv_id", "n_turns", "first_turn", "last_turn", "blank", "duplicate", "truncated", "illegal", "cost", "first_role", "last_role", "audit", "roles", "texts"]
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    kind = T.StructType(
        [
            T.StructField("conv_id", conv),
            *[T.StructField(n, T.LongType()) for n in numbers],
            T.StructField("audit", T.StringType()),
            T.StructField("repaired_sha256", T.StringType()),
        ]
    )

    def one(conv, rows: Iterator[tuple]) -> tuple:
        digest, audits = hashlib.sha256(), []
        n_turns = blank = duplicate = truncated = illegal = 0
        first_turn = last_turn = last_role = cost = None
        written = False
        for row in rows:
            own = dict(zip(names, row))
            blank, duplicate, truncated = blank + own["blank"], duplicate + own["duplicate"], truncated + own["truncated"]
            illegal += own["illegal"]
            if own["first_role"] is not None:
                if last_role is not None:
                    illegal += last_role + own["first_role"] not in ILLEGAL_BUT
                last_role = own["last_role"]
            if own["first_turn"] is not None:
                n_turns += own["n_turns"] - (own["first_turn"] == last_turn)
                first_turn = own["first_turn"] if first_turn is None else first_turn
                last_turn = own["last_turn"]
            cost = own["cost"] if cost is None else cost
            audits.append(own["audit"])
            for role, text in zip(own["roles"], own["texts"], strict=True):
                digest.update(f"{chr(10) if written else ''}{role}:{text}".encode())
                written = True
        gaps = 0 if first_turn is None else last_turn - first_turn + 1 - n_turns
        return conv, gaps, blank, duplicate, truncated, illegal, cost, "".join(audits), digest.hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = (one(conv, rows) for conv, rows in groupby(_rows(batches), lambda r: r[0]))
        yield from _sent(found, _arrow(kind))

    closed = blocks.where("NOT open").select(*names).mapInArrow(run, kind)
    long = blocks.where("open").repartition("conv_id").sortWithinPartitions(*PLACE)
    return closed.unionByName(long.select(*names).mapInArrow(run, kind))


def damage(conversations: DataFrame) -> DataFrame:
    """``conversations`` with faults that the rows' ids decide about; nulls are one space.

    By the checksum of ``conv_id:turn`` modulo 20: 0 drops a row, 1 empties its text, 2 takes the ends of its
    sentences, 3 repeats it, 4 makes its role user. Returns ``conv_id, turn, role, text, copies``.
    """
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    case: Column = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % 20
    text = spaced("text")
    return conversations.withColumn("case", case).select(
        "conv_id",
        "turn",
        F.when(F.col("case") == 4, "user").otherwise(spaced("role")).alias("role"),
        F.when(F.col("case") == 1, "").when(F.col("case") == 2, F.regexp_replace(text, r"[.!?]", "")).otherwise(text).alias("text"),
        F.when(F.col("case") == 0, 0).when(F.col("case") == 3, 2).otherwise(1).alias("copies"),
    )
