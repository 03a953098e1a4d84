"""Repair of the structure of conversations by a run-length DP (operator 13).

A repaired conversation has roles whose initials are ``(s?(ua)+)?``. Its rows are symbols (what the role is, what is wrong
with the row), equal consecutive symbols a run. A symbol is a 4 x 4 matrix of cheapest steps between the states of that pattern;
a run's matrix comes from cached powers of two of it, in min-plus arithmetic. Costs run from the end backwards over
the runs; from the start forwards the choices are then unrolled, at each place the least letter that still reaches the least cost.

Conversations are sorted by ranges and cut into parts of bounded size. A conversation within one part is solved
there. A longer one, of any length, is solved as the chain of its parts: their matrices give the costs at their ends, the exits for each
entry give their entries, and then all parts unroll by themselves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from quern.llm.common import quoted, small_batches, stored

SPACES = " \t\n\x0b\x0c\r"
ENDS = ".!?"
#: Costs: to give a row another role, to delete one, to insert one, and to leave a truncated one in.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: States: nothing yet, after s, after u, after a. Inserted and re-roled rows lead from each state to one.
MOVE = [2, 2, 3, 2]
ROLES = {2: "user", 3: "assistant"}
FINAL = [0, 2 * INSERT, INSERT, 0]
NEVER = 1 << 60
#: A part holds about so many bytes of text, and so many runs, at most.
PART_BYTES, PART_RUNS = 1 << 20, 1 << 16
#: Rows of a run that are unrolled at once.
BLOCK = 1 << 14
#: Symbol 0 is a row that must go; others are 1 + 2 * (place of the initial in this) + (1 if truncated).
INITIALS = "sua"
LEGAL = {"su", "ua", "au"}


def symbol(initial: str, truncated: bool) -> int:
    """The symbol of a row that may stay."""
    place = INITIALS.find(initial) if initial else -1
    return 1 + 2 * (3 if place < 0 else place) + int(truncated)


@lru_cache(None)
def keeps(sign: int) -> list[int | None]:
    """The state to which keeping a row of this symbol leads, from each state."""
    if not sign:
        return [None] * 4
    return {0: [1, None, None, None], 1: [2, 2, None, 2], 2: [None, None, 3, None]}.get((sign - 1) // 2, [None] * 4)


def penalty(sign: int) -> int:
    return TRUNCATED if sign and not sign % 2 else 0


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The min-plus product."""
    return np.minimum((a[:, :, None] + b[None, :, :]).min(axis=1), NEVER)


@lru_cache(None)
def power(sign: int, j: int) -> np.ndarray:
    """The matrix of 2^j rows of a symbol, each with the rows inserted before it."""
    if j:
        return product(power(sign, j - 1), power(sign, j - 1))
    row, insert = np.full((4, 4), NEVER), np.full((4, 4), NEVER)
    for s in range(4):
        row[s, s], insert[s, s] = DELETE, 0
        insert[s, MOVE[s]] = min(insert[s, MOVE[s]], INSERT)
        if sign:
            row[s, MOVE[s]] = min(row[s, MOVE[s]], REROLE + penalty(sign))
            if (to := keeps(sign)[s]) is not None:
                row[s, to] = min(row[s, to], penalty(sign))
    return product(product(product(insert, insert), product(insert, insert)), row)


@lru_cache(None)
def steps(sign: int) -> list[list[tuple[int, int]]]:
    """The finite entries of a symbol's matrix: (to, cost) from each state."""
    return [[(t, int(c)) for t, c in enumerate(line) if c < NEVER] for line in power(sign, 0)]


def before(sign: int, count: int, after: list[int]) -> list[int]:
    """Costs to the end before a run, from those after it."""
    if count < 8:
        for _ in range(count):
            after = [min(c + after[t] for t, c in line) for line in steps(sign)]
        return after
    costs = np.array(after)
    for j in range(count.bit_length()):
        if count >> j & 1:
            costs = (power(sign, j) + costs).min(axis=1)
    return [int(c) for c in np.minimum(costs, NEVER)]


def places(sign: int, count: int, after: list[int]) -> list[list[int]]:
    """Costs to the end before each row of a run and after the last, by doubling."""
    if count < 32:
        out = [after]
        for _ in range(count):
            out.append(before(sign, 1, out[-1]))
        return out[::-1]
    costs, j = np.array([after]), 0
    while len(costs) <= count:
        earlier = (power(sign, j)[None, :, :] + costs[:, None, :]).min(axis=2)
        costs, j = np.concatenate([np.minimum(earlier, NEVER), costs]), j + 1
    return costs[-count - 1 :].tolist()


def matrix(runs: list[tuple[int, int]]) -> np.ndarray:
    """The min-plus matrix of a sequence of runs."""
    total = np.where(np.eye(4, dtype=bool), 0, NEVER)
    for sign, count in runs:
        for j in range(count.bit_length()):
            if count >> j & 1:
                total = product(total, power(sign, j))
    return total


def unroll(runs: list[tuple[int, int]], state: int, end: list[int], emit: Callable[[str, int, int, int], None]) -> tuple[int, int]:
    """Call ``emit(letter, state, rows, symbol)`` for the cheapest edits in order, the ASCII-least of equal cost; (last state, cost to the end).

    ``end`` has the costs after the runs, with what is inserted there. A path is told by its letters, and none of equal
    cost is the beginning of another (only inserted rows, which cost, could follow), so the least letter at each place is right.
    """
    after = [end]
    for sign, count in reversed(runs):
        after.append(before(sign, count, after[-1]))
    after.reverse()
    cost = after[0][state]
    for at, (sign, count) in enumerate(runs):
        if not sign:
            emit("D", state, count, sign)
            continue
        blocks = [min(BLOCK, count - start) for start in range(0, count, BLOCK)]
        ends = [after[at + 1]]
        for size in reversed(blocks[1:]):
            ends.append(before(sign, size, ends[-1]))
        keep, more = keeps(sign), penalty(sign)
        for size, last in zip(blocks, reversed(ends)):
            costs = places(sign, size, last)
            for here, then in zip(costs, costs[1:]):
                while then[state] + DELETE != here[state] and here[MOVE[state]] + INSERT == here[state]:
                    state = MOVE[state]
                    emit("I", state, 1, sign)
                if then[state] + DELETE == here[state]:
                    letter = "D"
                elif keep[state] is not None and then[keep[state]] + more == here[state]:
                    letter, state = "K", keep[state]
                else:
                    letter, state = "R", MOVE[state]
                emit(letter, state, 1, sign)
    return state, cost


class Part:
    """Rows of one conversation, in order, as they come in."""

    def __init__(self, conv: object, part: int, seq: int) -> None:
        self.conv, self.part, self.seq, self.bytes = conv, part, seq, 0
        self.runs: list[list[int]] = []
        self.roles: list[str] = []
        self.texts: list[str] = []
        self.rows = self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first_initial = self.last_initial = self.low = self.high = None

    def add(self, turn: int | None, role: str, blank: bool, truncated: bool, times: int, text: str | None) -> None:
        """``times`` equal rows; ``text`` is given where the first of them is the first of its role and text."""
        initial = role[:1]
        if self.rows and self.last_initial + initial not in LEGAL:
            self.illegal += 1
        if initial + initial not in LEGAL:
            self.illegal += times - 1
        if not self.rows:
            self.first_initial = initial
        self.last_initial = initial
        self.rows += times
        if turn is not None and turn != self.high:  # rows come by turn
            self.low, self.high, self.turns = turn if self.low is None else self.low, turn, self.turns + 1
        first = text is not None
        if blank:
            self.blank += times
        else:
            self.duplicate += times - first
            self.truncated += first and truncated
        if first:
            self._run(symbol(initial, truncated), 1)
            self.roles.append(role)
            self.texts.append(text)
            self.bytes += len(text) + len(role)
        self._run(0, times - first)

    def _run(self, sign: int, count: int) -> None:
        if count and self.runs and self.runs[-1][0] == sign:
            self.runs[-1][1] += count
        elif count:
            self.runs.append([sign, count])

    def full(self, most_bytes: int, most_runs: int) -> bool:
        return self.bytes >= most_bytes or len(self.runs) >= most_runs

    def row(self, whole: bool) -> dict:
        found = {k: getattr(self, k) for k in ("conv", "part", "seq", "rows", "blank", "duplicate", "truncated", "illegal", "turns", "first_initial", "last_initial", "low", "high", "roles", "texts")}
        return found | {"whole": whole, "signs": bytes(r[0] for r in self.runs), "counts": [r[1] for r in self.runs], "matrix": None if whole else matrix(self.runs).ravel().tolist()}


def part_schema(kind: T.DataType) -> T.StructType:
    numbers = ["rows", "blank", "duplicate", "truncated", "illegal", "turns", "low", "high"]
    texts = T.ArrayType(T.StringType())
    return T.StructType(
        [T.StructField("conv", kind), T.StructField("part", T.LongType()), T.StructField("seq", T.LongType()), T.StructField("whole", T.BooleanType()), *[T.StructField(c, T.LongType()) for c in numbers], T.StructField("first_initial", T.StringType()), T.StructField("last_initial", T.StringType())]
        + [T.StructField("roles", texts), T.StructField("texts", texts), T.StructField("signs", T.BinaryType()), T.StructField("counts", T.ArrayType(T.LongType())), T.StructField("matrix", T.ArrayType(T.LongType()))]
    )


def arrow(schema: T.StructType) -> pa.Schema:
    return pa.schema([(f.name, to_arrow_type(f.dataType)) for f in schema.fields])


def batched(rows: Iterator[tuple[dict, int]], schema: T.StructType, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Batches of about ``most`` bytes from (row, its bytes)."""
    kind, held, size = arrow(schema), [], 0
    names = set(kind.names)
    for row, own in rows:
        held.append({k: v for k, v in row.items() if k in names})
        size += own + 200
        if size >= most:
            yield pa.RecordBatch.from_pylist(held, schema=kind)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=kind)


def ordered(df: DataFrame, conv: str, turn: str, role: str, text: str, absent: Column) -> DataFrame:
    """(conv, turn, role, digest, kind, flags, times, text), sorted within ranges.

    Kind 1: equal rows of a turn, counted before any shuffle, without their text. Kind 0 stands before the first row
    of its role and text, and brings the text; blank texts have none. So no key is as heavy as its copies, and whether a row
    repeats an earlier one takes no join.
    """
    plain = df.select(
        F.col(quoted(conv)).alias("conv"), F.col(quoted(turn)).cast("long").alias("turn"), F.coalesce(F.col(quoted(role)).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(quoted(text)).cast("string"), F.lit(" ")).alias("text"), absent.alias("absent"),
    )
    end = F.rtrim("text", F.lit(SPACES))
    blank, truncated = end == "", ~F.right(end, F.lit(1)).isin(list(ENDS))
    flagged = plain.withColumns({"flags": F.when(blank, 1).otherwise(0) + F.when(truncated, 2).otherwise(0), "digest": F.unhex(F.sha2("text", 256))})
    there = lambda c: F.when(~F.col("absent"), F.col(c)).alias(c)
    light = flagged.select("conv", *[there(c) for c in ("turn", "role", "digest", "flags")], F.when(F.col("absent"), 0).otherwise(1).alias("n"))
    light = light.groupBy("conv", "turn", "role", "digest").agg(F.max("flags").alias("flags"), F.sum("n").alias("times"))
    firsts = plain.where(~F.col("absent") & ~blank).groupBy("conv", "role", "text").agg(F.max(F.col("turn").isNull()).alias("early"), F.min("turn").alias("least"))
    firsts = firsts.select("conv", F.when(~F.col("early"), F.col("least")).alias("turn"), "role", F.unhex(F.sha2("text", 256)).alias("digest"), F.lit(0).alias("flags"), F.lit(0).cast("long").alias("times"), F.lit(0).alias("kind"), "text")
    both = light.select("*", F.lit(1).alias("kind"), F.lit(None).cast("string").alias("text")).unionByName(firsts)
    keys = ["conv", "turn", "role", "digest"]
    return both.repartitionByRange(*keys).sortWithinPartitions(*keys, "kind")


def parts(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", absent: str | None = None, most_bytes: int = PART_BYTES, most_runs: int = PART_RUNS) -> DataFrame:
    """The conversations as parts, stored: runs of symbols, roles and texts of the rows that may stay, and counts."""
    rows = ordered(df, conv, turn, role, text, F.lit(False) if absent is None else F.coalesce(F.col(quoted(absent)), F.lit(False)))
    schema = part_schema(df.schema[conv].dataType)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        own = TaskContext.get().partitionId()

        def made() -> Iterator[tuple[dict, int]]:
            here, waiting, alone = None, None, False  # what a partition begins with may have begun before it
            for batch in batches:
                for r in batch.to_pylist():
                    if here is None:
                        here = Part(r["conv"], own, 0)
                    elif r["conv"] != here.conv:
                        yield here.row(alone), here.bytes
                        here, waiting, alone = Part(r["conv"], own, here.seq + 1), None, True
                    elif here.full(most_bytes, most_runs):
                        yield here.row(False), here.bytes
                        here, alone = Part(here.conv, own, here.seq + 1), False
                    if r["kind"] == 0:
                        waiting = r
                    elif r["times"]:
                        known = waiting and (waiting["turn"], waiting["role"], waiting["digest"]) == (r["turn"], r["role"], r["digest"])
                        here.add(r["turn"], r["role"], bool(r["flags"] & 1), bool(r["flags"] & 2), r["times"], waiting["text"] if known else None)
                        waiting = None
            if here is not None:
                yield here.row(False), here.bytes

        yield from batched(made(), schema)

    small_batches(df.sparkSession)
    return stored(rows.mapInArrow(cut, schema), "conversation-parts")


def scanned(df: DataFrame, schema: T.StructType, order: list[Column], step: Callable[[dict, object], tuple[dict, object]], start: object) -> DataFrame:
    """Carry a value from row to row of each conversation, in order; rows stream by, only the value is held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made() -> Iterator[tuple[dict, int]]:
            begun, conv, value = False, None, None
            for batch in batches:
                for r in batch.to_pylist():
                    if not begun or r["conv"] != conv:
                        begun, conv, value = True, r["conv"], start
                    out, value = step(r, value)
                    yield out, 0

        yield from batched(made(), schema)

    return df.repartition("conv").sortWithinPartitions("conv", *order).mapInArrow(run, schema)


def chained(cut: DataFrame) -> DataFrame:
    """(part, seq, entry, ends) of the parts of conversations that have several: the state before them, the costs after them."""
    longs, ints = T.ArrayType(T.LongType()), T.LongType()
    place = [T.StructField("conv", cut.schema["conv"].dataType), T.StructField("part", ints), T.StructField("seq", ints)]
    told = [*place, T.StructField("ends", longs), T.StructField("last", T.BooleanType())]
    links = cut.where(~F.col("whole"))

    def back(r: dict, after: list[int] | None) -> tuple[dict, list[int]]:
        end = FINAL if after is None else after
        here = [min(NEVER, min(r["matrix"][4 * s + t] + end[t] for t in range(4))) for s in range(4)]
        return r | {"ends": end, "last": after is None}, here

    ends = scanned(links.select("conv", "part", "seq", "matrix"), T.StructType(told), [F.desc("part"), F.desc("seq")], back, None)
    schema = T.StructType([*told, T.StructField("exits", longs)])

    def leave(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made() -> Iterator[tuple[dict, int]]:
            for batch in batches:
                for r in batch.to_pylist():
                    runs = list(zip(r["signs"], r["counts"]))
                    yield r | {"exits": [unroll(runs, s, r["ends"], lambda *_: None)[0] for s in range(4)]}, 0

        yield from batched(made(), schema)

    names = [f.name for f in told]
    left = links.select("part", "seq", "signs", "counts").join(ends, ["part", "seq"]).select(*names, "signs", "counts").mapInArrow(leave, schema)
    enter = lambda r, state: (r | {"entry": state}, r["exits"][state])
    entries = scanned(left, T.StructType([*told, T.StructField("entry", ints)]), [F.col("part"), F.col("seq")], enter, 0)
    return entries.drop("conv")


def repaired(cut: DataFrame) -> DataFrame:
    """``parts`` with their edits: ``cost`` (from here to the end of the conversation), ``audit``, and the repaired ``roles`` and ``texts``."""
    kept = [f for f in cut.schema.fields if f.name not in ("signs", "counts", "matrix")]
    schema = T.StructType([*kept, T.StructField("cost", T.LongType()), T.StructField("audit", T.StringType())])

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batched((solved(r) for batch in batches for r in batch.to_pylist()), schema)

    small_batches(cut.sparkSession)
    rest = cut.drop("matrix")
    alone = rest.where("whole").withColumns({"entry": F.lit(0).cast("long"), "ends": F.lit(FINAL).cast("array<long>"), "last": F.lit(True)})
    return alone.unionByName(rest.where(~F.col("whole")).join(chained(cut), ["part", "seq"])).mapInArrow(solve, schema)


def solved(r: dict) -> tuple[dict, int]:
    """A part's row with its edits, and its bytes."""
    letters: list[str] = []
    roles: list[str] = []
    texts: list[str] = []
    waiting = iter(zip(r["roles"], r["texts"]))

    def emit(letter: str, state: int, rows: int, sign: int) -> None:
        letters.append(letter * rows)
        role, text = next(waiting) if sign and letter != "I" else ("", "")
        if letter != "D":
            roles.append(role if letter == "K" else ROLES[state])
            texts.append(text)

    state, cost = unroll(list(zip(r["signs"], r["counts"])), r["entry"], r["ends"], emit)
    while r["last"] and FINAL[state]:
        state = MOVE[state]
        emit("I", state, 1, 0)
    return r | {"cost": cost, "audit": "".join(letters), "roles": roles, "texts": texts}, sum(map(len, texts)) + sum(map(len, letters))


def messages(edited: DataFrame) -> DataFrame:
    """(conv, part, seq, place, role, text): the repaired messages, in the order of these columns."""
    return edited.select("conv", "part", "seq", F.posexplode(F.arrays_zip("roles", "texts")).alias("place", "m")).select("conv", "part", "seq", "place", F.col("m.roles").alias("role"), F.col("m.texts").alias("text"))


SUMMARY = ["rows", "gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def summaries(edited: DataFrame, conv: str = "conv_id") -> DataFrame:
    """A row for each conversation: SUMMARY, ``audit`` and ``repaired_sha256`` (of ``role:text``, newline-joined).

    Parts of a longer conversation stream by in order; a digest needs all its bytes in turn, so these pass through one task,
    a part at a time, and only the audit is held.
    """
    schema = T.StructType([T.StructField(conv, edited.schema["conv"].dataType), *[T.StructField(c, T.LongType()) for c in SUMMARY], T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batched(told(r for batch in batches for r in batch.to_pylist()), schema)

    def told(rows: Iterator[dict]) -> Iterator[tuple[dict, int]]:
        here: dict = {}
        for r in rows:
            if here and r["conv"] != here[conv]:
                yield closed(here)
                here = {}
            if not here:
                here = {conv: r["conv"], "cost": r["cost"], "pieces": [], "sha": hashlib.sha256(), "some": False, "low": None, "high": None, "turns": 0, "last_initial": None} | dict.fromkeys(SUMMARY[:-1], 0)
            here["illegal"] += here["last_initial"] is not None and r["first_initial"] is not None and here["last_initial"] + r["first_initial"] not in LEGAL
            here["last_initial"] = here["last_initial"] if r["last_initial"] is None else r["last_initial"]
            here["turns"] += r["turns"] - (r["low"] is not None and r["low"] == here["high"])
            here["low"], here["high"] = r["low"] if here["low"] is None else here["low"], here["high"] if r["high"] is None else r["high"]
            for c in ("rows", "blank", "duplicate", "truncated", "illegal"):
                here[c] += r[c]
            here["pieces"].append(r["audit"])
            for role, text in zip(r["roles"], r["texts"]):
                here["sha"].update(f"{chr(10) if here['some'] else ''}{role}:{text}".encode())
                here["some"] = True
        if here:
            yield closed(here)

    def closed(here: dict) -> tuple[dict, int]:
        gaps = here["high"] - here["low"] + 1 - here["turns"] if here["turns"] else 0
        audit = "".join(here["pieces"])
        return here | {"gaps": gaps, "audit": audit, "repaired_sha256": here["sha"].hexdigest()}, len(audit)

    small_batches(edited.sparkSession)
    alone = edited.where("whole").mapInArrow(run, schema)
    return alone.unionByName(edited.where(~F.col("whole")).repartition("conv").sortWithinPartitions("conv", "part", "seq").mapInArrow(run, schema))


def repair(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", absent: str | None = None) -> DataFrame:
    """A row for each conversation: what is wrong with it and its cheapest repair (see ``summaries``).

    Rows stand by turn, nulls first, then by role and digest of the text; equal rows are duplicates after the first. A null
    role or text is one space; a null conversation is one of its own; an empty role has no legal initial. Where the column
    ``absent`` is true, a row only tells that its conversation exists: without others it has zeros, an empty audit and
    the digest of nothing. An empty table gives no rows. Other columns are not read.
    """
    return summaries(repaired(parts(df, conv, turn, role, text, absent)), conv)
