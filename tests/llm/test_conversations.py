import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest
from hypothesis import given, settings, strategies as st

from chronofold.llm import conversations as c
from chronofold.llm import queries

NAMES = {"u": "user", "a": "assistant"}
GRAMMAR = re.compile(r"(s?(ua)+)?")


def by_trial(symbols):
    """The cheapest and then least letters, by trying all edits with up to two inserted turns between rows."""
    ends = []

    def go(i, letters, cost, roles, inserted):
        if i == len(symbols):
            if GRAMMAR.fullmatch(roles):
                ends.append((cost, letters, roles))
        else:
            row, extra = symbols[i].lower(), int(symbols[i].isupper())
            go(i + 1, letters + "D", cost + 3, roles, 0)
            if row != "x":
                go(i + 1, letters + "K", cost + extra, roles + row, 0)
                for r in "ua":
                    go(i + 1, letters + "R", cost + 2 + extra, roles + r, 0)
        if inserted < 2:
            for r in "ua":
                go(i, letters + "I", cost + 2, roles + r, inserted + 1)

    go(0, "", 0, "", 0)
    return min(ends)


@pytest.mark.parametrize("n", [0, 1, 2, 3])
def test_every_short_conversation_by_trial(n):
    import itertools

    for symbols in map("".join, itertools.product("suaoUx" if n == 3 else "suaoSUAOx", repeat=n)):
        cost, letters, roles = by_trial(symbols)
        assert c.whole(symbols) == (cost, letters), symbols
        before, done, after, _ = c.edits(symbols, c.NOTHING, letters)
        made = "".join(b + {"D": "", "K": s.lower()}.get(d, d) for b, d, s in zip(before, done, symbols)) + after
        assert made == roles


def by_pairs(symbols):
    """Cost and letters as tuples, smallest rest first."""

    @lru_cache(None)
    def best(i, q, inserted):
        options = []
        if i == len(symbols):
            if q in (0, 3):
                options.append((0, ""))
        else:
            row, extra = symbols[i].lower(), int(symbols[i].isupper())
            steps = [("D", 3, q)]
            if row != "x":
                to = 3 if q == 2 else 2
                if row == ("a" if q == 2 else "u"):
                    steps.append(("K", extra, to))
                if row == "s" and q == 0:
                    steps.append(("K", extra, 1))
                steps.append(("R", 2 + extra, to))
            for letter, cost, to in steps:
                rest = best(i + 1, to, 0)
                if rest:
                    options.append((rest[0] + cost, letter + rest[1]))
        if inserted < 2:
            rest = best(i, 3 if q == 2 else 2, inserted + 1)
            if rest:
                options.append((rest[0] + 2, "I" + rest[1]))
        return min(options, default=None)

    for i in range(len(symbols), 0, -100):  # from the end, so that no call nests deeply
        for q in range(4):
            best(i, q, 0)
    return best(0, 0, 0)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="suaoSUAOxuaua", max_size=40))
def test_long_conversations(symbols):
    assert c.whole(symbols) == by_pairs(symbols)


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="suaoSUAOxuaua", min_size=1, max_size=30), st.integers(1, 7))
def test_blocks_give_what_the_whole_gives(symbols, size):
    parts = [symbols[i : i + size] for i in range(0, len(symbols), size)]
    cost, letters, states = c.best_ways([c.block(part) for part in parts])
    assert (cost, letters) == c.whole(symbols)
    # each block's way between its states, and then what is inserted at the end
    own = [c.block(part)[4 * q + to][1] for part, (q, to) in zip(parts, states)]
    assert letters.startswith("".join(own)) and set(letters[len("".join(own)) :]) <= {"I"}
    assert all(left[1] == right[0] for left, right in zip(states, states[1:])) and states[0][0] == c.NOTHING


def test_joining_blocks_copies_letters_seldom(monkeypatch):
    copied = []
    plain = c.Weights.letters
    monkeypatch.setattr(c.Weights, "letters", lambda self, w: copied.append(len(x := plain(self, w))) or x)
    rng, length = random.Random(8), 64 * 64
    blocks = [c.block("".join(rng.choices("suaoUAx", k=64))) for _ in range(64)]
    copied.clear()
    c.best_ways(blocks)
    assert sum(copied) < 16 * 1.2 * length * 7


def test_weights_order_as_cost_then_letters():
    w = c.Weights(6)
    listed = [(1, "K"), (1, "KD"), (1, "KI"), (1, "RD"), (2, ""), (2, "D"), (2, "DKI")]
    weights = [w.joined(cost, letters, 0) for cost, letters in listed]
    assert weights == sorted(weights)
    assert [(w.cost(x), w.letters(x)) for x in weights] == listed
    assert w.before("K", 1, w.joined(0, "DI", 0)) == w.joined(1, "KDI", 0)


def plain(rows):
    """Reports by conv_id from the rows (conv_id, turn, role, text) before damage."""
    by = {}
    for conv, turn, role, text in rows:
        own = by.setdefault(conv, [])
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        way = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if way == 0:
            continue
        text = "" if way == 1 else re.sub("[.!?]", "", text) if way == 2 else text
        role = "user" if way == 4 else role
        own += [(turn, role, text)] * (2 if way == 3 else 1)
    return {conv: report(own) for conv, own in by.items()}


def report(rows):
    if not rows:
        return (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    digest = lambda r: hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), digest(r)))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    seen, faults, symbols = set(), [], ""
    for _, role, text in rows:
        last = text.strip(" \t\n\x0b\x0c\r")[-1:]
        fault = "b" if not last else "d" if (role, text) in seen else "t" if last not in ".!?" else ""
        seen.add((role, text))
        faults.append(fault)
        first = role[:1] if role[:1] in ("s", "u", "a") else "o"
        symbols += "x" if fault in ("b", "d") else first.upper() if fault else first
    initials = [r[:1] for _, r, _ in rows]
    illegal = sum(x + y not in ("su", "ua", "au") for x, y in zip(initials, initials[1:]))
    cost, audit = by_pairs(symbols)
    made, left = [], iter(rows)
    state = 0
    for letter in audit:
        to = 3 if state == 2 else 2
        name = "assistant" if state == 2 else "user"
        if letter == "I":
            made.append(f"{name}:")
            state = to
            continue
        _, role, text = next(left)
        if letter == "K":
            made.append(f"{role}:{text}")
            state = 1 if role[:1] == "s" else to
        if letter == "R":
            made.append(f"{name}:{text}")
            state = to
    return (
        min(gaps, 2**63 - 1), *(faults.count(f) for f in "bdt"), illegal, cost, audit,
        hashlib.sha256("\n".join(made).encode()).hexdigest(),
    )


SCHEMA = "conv_id bigint, turn bigint, role string, text string, audit string, at string, conv string"


def compare(spark, tmp_path, rows):
    folder = str(tmp_path / "t")
    spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA).write.parquet(f"{folder}/conversations.parquet")
    got = {r[0]: tuple(r)[1:] for r in queries.op13_conversations(spark, folder).collect()}
    assert got == plain(rows)


def odd_conversations():
    rng = random.Random(5)
    rows = []
    for conv in [*range(120), None, -(2**63)]:
        turn = rng.choice([0, 1, -5])
        for _ in range(rng.randint(1, 9)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "ua", "üser", "User"])
            text = rng.choice(["Fine.", "Fine. ", "cut off", "What?\n", "", " \t\x0b", None, "東京!", "a ", "x.\x85", "Go! " * 300])
            rows.append((conv, turn, role, text))
            turn = None if rng.random() < 0.05 else (turn or 0) + rng.choice([0, 1, 1, 1, 1, 3])
    rows += rows[:25]
    rows += [(500, 2**63 - 1, "user", "a."), (500, -(2**63), "assistant", "b."), (501, None, "user", "Hi."), (501, None, None, None)]
    return rows


def test_odd_conversations(spark, tmp_path):
    compare(spark, tmp_path, odd_conversations())


def test_long_conversation_over_many_tasks(spark, tmp_path, monkeypatch, small_conf):
    small_conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rng = random.Random(6)
    rows = [(7, i // 3, rng.choice(["user", "assistant", "tool"]), rng.choice(["Yes.", f"Number {i}.", "cut", ""])) for i in range(3000)]
    rows += [(i, j, ["user", "assistant"][j % 2], f"{i} {j}.") for i in range(40) for j in range(4)]
    rows += [(9_000, 1, "user", "Same.")] * 700
    compare(spark, tmp_path, rows)
    placed = c._in_order(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"), "conv_id", "turn", "role", "text")
    tasks = placed.where("conv = 9000").selectExpr("count(DISTINCT at >> 33)").first()[0]
    assert tasks > 1


def test_repaired_turns(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "More."), (2, 0, "assistant", ""), (3, 5, "system", "Be."), (3, 6, "user", "Q?")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    report, turns = c.repair(df)
    got = [tuple(r) for r in turns.orderBy("conv", "at", "place").select("conv", "role", "text").collect()]
    assert got == [(1, "user", "Hi."), (1, "assistant", "More."), (3, "system", "Be."), (3, "user", "Q?"), (3, "assistant", "")]
    assert {r["conv"]: (r["cost"], r["audit"]) for r in report.collect()} == {1: (2, "KR"), 2: (3, "D"), 3: (2, "KKI")}


def test_no_conversations(spark):
    report, turns = c.repair(spark.createDataFrame([], SCHEMA))
    assert report.count() == turns.count() == 0


def test_given_tables(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in queries.table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").collect()]
    got = {r[0]: tuple(r)[1:] for r in queries.op13_conversations(spark, folder).collect()}
    assert got == plain(rows)
