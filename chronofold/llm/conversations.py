"""Repair of the turn order of conversations by the cheapest edits.

A weight is one integer: the cost above, then the letters of the edits in digits of fixed width, the first one
highest, with zeros behind the last. The smaller of two weights is the cheaper, and among equally cheap ones the
least in ASCII order; so a plain minimum over the edges of a graph decides everything. Weights belong to the rest of a
conversation, from a row to the end, since what two rests begin with then stands at the same digits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from chronofold.functions import col_of
from chronofold.sources.scratch import freeze

# Rows of a conversation that are one block; a longer one is solved block by block.
BLOCK = 256

# The edits' letters in ASCII order, their digits, and their costs.
DELETE, INSERT, KEEP, REROLE = "DIKR"
DIGIT = {DELETE: 1, INSERT: 2, KEEP: 3, REROLE: 4}
COST = {DELETE: 3, INSERT: 2, KEEP: 0, REROLE: 2}
TRUNCATED_COST = 1
ROLES = {"u": "user", "a": "assistant"}
# What has been given out so far: nothing, a system turn, a user's turn, an assistant's. Those in END may be the last.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
STATES, END = range(4), (NOTHING, ASSISTANT)
AFTER = {NOTHING: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
TURN = {USER: "u", ASSISTANT: "a"}
# A row's symbol: the initial of its role (o: another), in capitals if it is truncated; x: it has to go.
GONE = "x"


def _row_edges(symbol: str) -> list[list[tuple[str, int, int]]]:
    """For each state the edits of a row: letter, cost, next state."""
    edges: list[list[tuple[str, int, int]]] = [[(DELETE, COST[DELETE], q)] for q in STATES]
    if symbol == GONE:
        return edges
    more, role = (TRUNCATED_COST if symbol.isupper() else 0), symbol.lower()
    for q in STATES:
        if role == TURN[AFTER[q]]:
            edges[q].append((KEEP, COST[KEEP] + more, AFTER[q]))
        elif role == "s" and q == NOTHING:
            edges[q].append((KEEP, COST[KEEP] + more, SYSTEM))
        edges[q].append((REROLE, COST[REROLE] + more, AFTER[q]))
    return edges


_EDGES = {symbol: _row_edges(symbol) for symbol in "suaoSUAO" + GONE}


class Weights:
    """Integers for at most ``letters`` edits."""

    def __init__(self, letters: int) -> None:
        self.width = 3 * letters
        self.mask = (1 << self.width) - 1

    def before(self, letter: str, cost: int, rest: int) -> int:
        """The weight of an edit and what follows it."""
        digits = (DIGIT[letter] << (self.width - 3)) | ((rest & self.mask) >> 3)
        return (((rest >> self.width) + cost) << self.width) | digits

    def joined(self, cost: int, letters: str, rest: int) -> int:
        """The weight of a run of edits and what follows it."""
        digits = (rest & self.mask) >> (3 * len(letters))
        if letters:
            digits |= digits_of(letters) << (self.width - 3 * len(letters))
        return (((rest >> self.width) + cost) << self.width) | digits

    def cost(self, weight: int) -> int:
        return weight >> self.width

    def letters(self, weight: int) -> str:
        digits = oct(weight & self.mask | 1 << self.width)[3:]
        return digits.rstrip("0").translate(_LETTERS)


# Cost and letters from each state to each, sixteen in all; none where no edits lead there.
Ways = list[tuple[int, str] | None]

_LETTERS = {ord(str(d)): letter for letter, d in DIGIT.items()}
_DIGITS = {ord(letter): str(d) for letter, d in DIGIT.items()}


def digits_of(letters: str) -> int:
    return int(letters.translate(_DIGITS), 8)


def with_inserts(weights: Weights, rest: Sequence[int | None]) -> list[int | None]:
    """The best of going on as ``rest`` says from each state, or after one or two inserted turns.

    A third one leads back to a state at a higher cost.
    """
    best = list(rest)
    for _ in range(2):
        after = list(best)
        for q in STATES:
            if (then := after[AFTER[q]]) is not None:
                inserted = weights.before(INSERT, COST[INSERT], then)
                if best[q] is None or inserted < best[q]:
                    best[q] = inserted
    return best


def last_weights(weights: Weights) -> list[int | None]:
    """What it takes from each state to end: nothing, or inserted turns."""
    return with_inserts(weights, [0 if q in END else None for q in STATES])


def solve(weights: Weights, symbols: str, rest: Sequence[int | None]) -> list[int | None]:
    """The least weight from each state over these rows and then ``rest``."""
    for symbol in reversed(symbols):
        edges, after = _EDGES[symbol], rest
        rest = with_inserts(
            weights,
            [
                min((weights.before(x, c, after[to]) for x, c, to in edges[q] if after[to] is not None), default=None)
                for q in STATES
            ],
        )
    return list(rest)


@lru_cache(maxsize=20_000)
def whole(symbols: str) -> tuple[int, str]:
    """Cost and letters for a conversation."""
    weights = Weights(3 * len(symbols) + 3)
    best = solve(weights, symbols, last_weights(weights))[NOTHING]
    return weights.cost(best), weights.letters(best)


@lru_cache(maxsize=2_000)
def block(symbols: str) -> Ways:
    """For each state before and each after these rows, sixteen in all: cost and letters, or none.

    Two runs of edits of one block with equal states and cost are never one the beginning of the other, as the
    longer would have to cost more; so the lesser stays the lesser whatever follows, and blocks can be solved apart.
    """
    weights = Weights(3 * len(symbols) + 3)
    found = [solve(weights, symbols, [0 if q == to else None for q in STATES]) for to in STATES]
    return [
        None if found[to][q] is None else (weights.cost(found[to][q]), weights.letters(found[to][q]))
        for q in STATES
        for to in STATES
    ]


def in_a_row(left: Ways, right: Ways) -> tuple[Ways, bytes]:
    """The ways through two neighbouring blocks, as ``block`` gives them, and the state between them for each."""
    weights = Weights(sum(max((len(w[1]) for w in ways if w), default=0) for ways in (left, right)))
    rest = [None if w is None else weights.joined(*w, 0) for w in right]
    ways, between = [], bytearray()
    for q in STATES:
        for to in STATES:
            # the weight tells the letters and they tell the states, so equal weights can't differ in the state
            weight, middle = min(
                (
                    (weights.joined(*left[4 * q + m], rest[4 * m + to]), m)
                    for m in STATES
                    if left[4 * q + m] is not None and rest[4 * m + to] is not None
                ),
                default=(None, 0),
            )
            ways.append(None if weight is None else (weights.cost(weight), weights.letters(weight)))
            between.append(middle)
    return ways, bytes(between)


def best_ways(blocks: list[Ways]) -> tuple[int, str, list[tuple[int, int]]]:
    """Cost and letters of a conversation in blocks, and the states before and after each of them.

    Neighbours are joined two by two until one is left, so that letters are copied as often as the number of blocks
    can be halved.
    """
    levels, row = [], blocks
    while len(row) > 1:
        joined = [in_a_row(*row[i : i + 2]) for i in range(0, len(row) - 1, 2)]
        levels.append([between for _, between in joined])
        row = [ways for ways, _ in joined] + row[len(row) & ~1 :]
    ways = row[0][4 * NOTHING : 4 * NOTHING + 4]
    weights = Weights(max(len(w[1]) for w in ways if w) + 3)
    last = last_weights(weights)
    weight, to = min((weights.joined(*w, last[to]), to) for to, w in enumerate(ways) if w is not None)
    states = [(NOTHING, to)]
    for level in reversed(levels):
        # one without a neighbour stays as it is
        odd = states[len(level) :]
        states = [
            pair
            for (q, to), between in zip(states, level)
            for pair in ((q, between[4 * q + to]), (between[4 * q + to], to))
        ] + odd
    return weights.cost(weight), weights.letters(weight), states


def edits(symbols: str, state: int, letters: str) -> tuple[list[str], list[str], str, int]:
    """For each row: initials of the turns inserted before it, and its edit (D, K, or the initial of its new role).

    Also the initials of turns inserted after the last row, and the state then.
    """
    before, done, inserted, rows = [], [], "", iter(symbols)
    for letter in letters:
        if letter == INSERT:
            state = AFTER[state]
            inserted += TURN[state]
            continue
        symbol = next(rows)
        _, _, to = next(e for e in _EDGES[symbol][state] if e[0] == letter)
        before.append(inserted)
        done.append(TURN[to] if letter == REROLE else letter)
        inserted, state = "", to
    return before, done, inserted, state


def damage(df: DataFrame) -> DataFrame:
    """Conversations with faults, made by a checksum of conv_id and turn; nulls count as one space."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    way = F.crc32(F.encode(F.concat(space("conv_id"), F.lit(":"), space("turn")), "UTF-8")) % 20
    text = F.when(way == 1, "").when(way == 2, F.regexp_replace(space("text"), "[.!?]", "")).otherwise(space("text"))
    copies = F.when(way == 0, 0).when(way == 3, 2).otherwise(1)
    return df.select(
        "conv_id",
        "turn",
        F.when(way == 4, "user").otherwise(space("role")).alias("role"),
        text.alias("text"),
        F.explode(F.array_repeat(F.lit(0), copies)).alias("_copy"),
    ).drop("_copy")


def _in_order(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """The rows with a position that grows along each conversation, written to the shared folder.

    Rows of one turn come in order of role and of a digest; equal rows are dealt apart by their place in the input.
    """
    space = lambda c: F.coalesce(col_of(c).cast("string"), F.lit(" "))
    rows = df.select(
        col_of(conv).alias("conv"), col_of(turn).cast("long").alias("turn"), space(role).alias("role"), space(text).alias("text")
    )
    said = F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    rows = rows.withColumn("digest", F.unhex(F.sha2(said, 256))).withColumn("_dealt", F.monotonically_increasing_id())
    order = ["conv", F.col("turn").asc_nulls_first(), "role", "digest", "_dealt"]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return freeze(placed.withColumn("at", F.monotonically_increasing_id()).drop("_dealt"))


SPACED = r"[\x20\x09-\x0D]"


def _judged(placed: DataFrame) -> DataFrame:
    """Rows without texts: at, conv, turn, initial, symbol, and the first fault (b, d, t or none)."""
    # one row for each text of a conversation; positions are unique, so neither join nor groups meet a hot key
    first = placed.groupBy("conv", "digest").agg(F.min("at").alias("at")).select("at", F.lit(True).alias("fresh"))
    last = F.regexp_extract("text", rf"(?s)([^\x20\x09-\x0D]){SPACED}*\z", 1)
    fault = (
        F.when(F.col("last") == "", "b")
        .when(F.col("fresh").isNull(), "d")
        .when(~F.col("last").rlike(r"[.!?]"), "t")
        .otherwise("")
    )
    letter = F.substring("role", 1, 1)
    initial = F.when(letter.isin("s", "u", "a"), letter).otherwise("o")
    symbol = F.when(fault.isin("b", "d"), GONE).when(fault == "t", F.upper(initial)).otherwise(initial)
    return (
        placed.select("at", "conv", "turn", "role", last.alias("last"))
        .join(first, "at", "left")
        .select("at", "conv", "turn", initial.alias("initial"), symbol.alias("symbol"), fault.alias("fault"))
    )


# Neighbours' initials that are in order.
LEGAL = {"su", "ua", "au"}
LONG = (1 << 63) - 1


def _counts(turns: list[int | None], initials: str, faults: list[str]) -> dict:
    known = [t for t in turns if t is not None]
    return {
        "n": len(turns),
        "blank": faults.count("b"),
        "duplicate": faults.count("d"),
        "truncated": faults.count("t"),
        "illegal": sum(initials[i : i + 2] not in LEGAL for i in range(len(initials) - 1)),
        "low": min(known, default=None),
        "high": max(known, default=None),
        "turns": len(set(known)),
        "ends": initials[0] + initials[-1],
    }


_SOLVED = (
    "n bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, low bigint, high bigint, turns bigint, "
    "ends string, cost bigint, audit string, at bigint, rows array<bigint>, before array<string>, edit array<string>, "
    "after string, symbols string, ways array<struct<cost:bigint,letters:string>>"
)


def _solved(judged: DataFrame, kind: str, most: int) -> DataFrame:
    """A row for each conversation that one task has whole, and for each block of the others.

    Tasks have runs of positions, so only the first and last conversation of a task, and those longer than a
    block, are solved in blocks: ``ways`` then says what each costs from any state to any other.
    """
    schema = f"conv {kind}, {_SOLVED}"
    rows = judged.repartitionByRange("at").sortWithinPartitions("at").select("conv", "at", "turn", "initial", "symbol", "fault")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[dict] = []

        def close(conv, held: list[tuple], is_whole: bool) -> None:
            at, turns, initials, symbols, faults = zip(*held)
            symbols = "".join(symbols)
            row = {"conv": conv, "at": at[0], "rows": at} | _counts(list(turns), "".join(initials), list(faults))
            if is_whole:
                row["cost"], row["audit"] = whole(symbols)
                row["before"], row["edit"], row["after"], _ = edits(symbols, NOTHING, row["audit"])
            else:
                row["symbols"] = symbols
                row["ways"] = [w and {"cost": w[0], "letters": w[1]} for w in block(symbols)]
            out.append(row)

        conv, held, begun = None, [], True  # begun: rows of this conversation may be elsewhere
        for batch in batches:
            arrow = _arrow(batch.schema.field("conv").type)
            convs, *columns = (c.to_pylist() for c in batch.columns)
            for own, row in zip(convs, zip(*columns)):
                if held and own != conv:
                    close(conv, held, not begun)
                    held, begun = [], False
                elif len(held) == most:
                    close(conv, held, False)
                    held, begun = [], True
                conv = own
                held.append(row)
            if len(out) >= 1000:
                yield pa.RecordBatch.from_pylist(out, schema=arrow)
                out.clear()
        if held:
            close(conv, held, False)
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return freeze(rows.mapInArrow(work, schema))


def _arrow(conv: pa.DataType) -> pa.Schema:
    """The types of ``_SOLVED``."""
    long, texts = pa.int64(), pa.list_(pa.string())
    named = ("n", "blank", "duplicate", "truncated", "illegal", "low", "high", "turns")
    rest = {"ends": pa.string(), "cost": long, "audit": pa.string(), "at": long, "rows": pa.list_(long)}
    rest |= {"before": texts, "edit": texts, "after": pa.string(), "symbols": pa.string()}
    ways = pa.list_(pa.struct({"cost": long, "letters": pa.string()}))
    return pa.schema({"conv": conv} | dict.fromkeys(named, long) | rest | {"ways": ways})


def _joined(solved: DataFrame, kind: str) -> DataFrame:
    """Conversations in blocks, joined two by two.

    A task holds of such a conversation the letters of its blocks' ways, some 50 bytes a row, and no text; its
    time grows little faster than the conversation.
    Returns rows as ``_solved`` does: one of each block with its rows' edits, and one of each conversation with the rest.
    """
    schema = f"conv {kind}, {_SOLVED}"
    parts = solved.where("ways IS NOT NULL").repartition("conv").sortWithinPartitions("conv", "at")

    def finish(blocks: list[dict], arrow: pa.Schema) -> Iterator[pa.RecordBatch]:
        cost, audit, states = best_ways([[w and (w["cost"], w["letters"]) for w in b["ways"]] for b in blocks])
        total = {c: sum(b[c] for b in blocks) for c in ("n", "blank", "duplicate", "truncated", "illegal", "turns")}
        for left, right in zip(blocks, blocks[1:]):
            total["illegal"] += left["ends"][-1] + right["ends"][0] not in LEGAL
            total["turns"] -= left["high"] is not None and left["high"] == right["low"]
        low, high = ([b[c] for b in blocks if b[c] is not None] for c in ("low", "high"))
        total |= {"low": min(low, default=None), "high": max(high, default=None)}
        total |= {"conv": blocks[0]["conv"], "cost": cost, "audit": audit}
        yield pa.RecordBatch.from_pylist([total], schema=arrow)
        used = 0
        for b, (state, to) in zip(blocks, states):
            letters = b["ways"][4 * state + to]["letters"]
            used += len(letters)
            before, edit, _, state = edits(b["symbols"], state, letters)
            after = ""
            if b is blocks[-1]:
                _, _, after, _ = edits("", state, audit[used:])
            row = {"at": b["at"], "rows": b["rows"], "before": before, "edit": edit, "after": after, "conv": b["conv"]}
            yield pa.RecordBatch.from_pylist([row], schema=arrow)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            arrow = _arrow(batch.schema.field("conv").type)
            for row in batch.to_pylist():
                if held and held[0]["conv"] != row["conv"]:
                    yield from finish(held, arrow)
                    held = []
                held.append(row)
        if held:
            yield from finish(held, arrow)

    return freeze(parts.mapInArrow(work, schema))


def _turn(role: Column, text: Column) -> Column:
    return F.struct(role.alias("role"), text.alias("text"))


def _inserted(initials: str) -> Column:
    """Turns without text for a string of initials."""
    letters = F.filter(F.split(F.col(initials), ""), lambda x: x != "")
    return F.transform(letters, lambda x: _turn(F.when(x == "u", ROLES["u"]).otherwise(ROLES["a"]), F.lit("")))


def _repaired(placed: DataFrame, solved: DataFrame) -> DataFrame:
    """Turns of the repaired conversations: conv, at, place, role, text."""
    last = F.size("rows") - 1
    edit = solved.where("edit IS NOT NULL").select(
        F.posexplode(F.arrays_zip("rows", "before", "edit")).alias("i", "e"), last.alias("last"), "after"
    )
    edit = edit.select(
        F.col("e.rows").alias("at"),
        F.col("e.before").alias("before"),
        F.col("e.edit").alias("edit"),
        F.when(F.col("i") == F.col("last"), F.col("after")).otherwise("").alias("after"),
    )
    role = F.when(F.col("edit") == "u", ROLES["u"]).when(F.col("edit") == "a", ROLES["a"]).otherwise(F.col("role"))
    own = F.when(F.col("edit") != DELETE, F.array(_turn(role, F.col("text")))).otherwise(F.array().cast("array<struct<role:string,text:string>>"))
    turns = F.concat(_inserted("before"), own, _inserted("after"))
    return (
        placed.select("at", "conv", "role", "text")
        .join(edit, "at")
        .select("conv", "at", F.posexplode(turns).alias("place", "t"))
        .select("conv", "at", "place", "t.role", "t.text")
    )


def repair(
    df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", most: int = BLOCK
) -> tuple[DataFrame, DataFrame]:
    """The report of each conversation, and the turns of the repaired ones.

    Rows are taken by turn, nulls first, those of one turn by role and a digest. Null roles and texts are one space.
    A blank row, or one whose role and text came before in its conversation, is deleted; the rest is kept, given
    another role or deleted, and turns without text are inserted, so that the roles' initials are ``(s?(ua)+)?``.

    The report has conv, gaps (turn numbers that are missing), blank, duplicate, truncated, illegal (neighbours in a
    wrong order), cost, and audit: the cheapest edits' letters. The turns have conv, at and place (their order), role and
    text; a conversation of which nothing stays has none. Rows without a conversation are one. No rows give no rows.
    A conversation is shared among tasks by its rows' order, whatever its length.
    """
    kind = df.schema[conv].dataType.simpleString()
    placed = _in_order(df, conv, turn, role, text)
    solved = _solved(_judged(placed), kind, most)
    solved = solved.where("ways IS NULL").unionByName(_joined(solved, kind))
    report = solved.where("audit IS NOT NULL").select(
        "conv", _gap_column().alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit"
    )
    return report, _repaired(placed, solved)


def _gap_column() -> Column:
    wide = [F.col(c).cast("decimal(38,0)") for c in ("high", "low", "turns")]
    gap = wide[0] - wide[1] + 1 - wide[2]
    return F.when(gap > LONG, LONG).otherwise(F.coalesce(gap, F.lit(0))).cast("bigint")


def digests(repaired: DataFrame) -> DataFrame:
    """For each conversation the SHA-256 of its turns as ``role:text``, joined by newlines.

    A digest is made from the first byte to the last, so a conversation's turns pass through one task; it sorts them
    on disk if need be and holds a batch of them.
    """
    kind = repaired.schema["conv"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, digest = None, None

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([conv], own), pa.array([digest.hexdigest()])], ["conv", "sha256"])

        for batch in batches:
            own = batch.schema.field("conv").type
            for key, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if digest is not None and key == conv:
                    digest.update(b"\n")
                else:
                    if digest is not None:
                        yield row()
                    conv, digest = key, hashlib.sha256()
                digest.update(line.encode())
        if digest is not None:
            yield row()

    lines = repaired.repartition("conv").sortWithinPartitions("conv", "at", "place")
    lines = lines.select("conv", F.concat("role", F.lit(":"), "text").alias("line"))
    return lines.mapInArrow(work, f"conv {kind}, sha256 string")
