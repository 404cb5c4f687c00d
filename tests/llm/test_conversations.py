import hashlib
import heapq
import random
import re
import zlib

import pytest

from carrel.llm import conversations
from carrel.llm.auction import STATES, WHOLE, Lattice, distances
from carrel.llm.queries import QUERIES

WHITE = " \t\n\x0b\x0c\r"
NEXT = [{"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2}]
NEW = ["u", "u", "a", "u"]


def cheapest(rows):
    """Least (cost, letters) by search in order of cost and letters; rows: (role, text, fault)."""
    heap, seen = [(0, "", 0, 0, ())], set()
    while heap:
        cost, audit, i, state, lines = heapq.heappop(heap)
        if (i, state) in seen:
            continue
        seen.add((i, state))
        if i == len(rows) and state in WHOLE:
            return cost, audit, list(lines)
        new = NEW[state]
        name = {"u": "user", "a": "assistant"}[new]
        heapq.heappush(heap, (cost + 2, audit + "I", i, NEXT[state][new], (*lines, f"{name}:")))
        if i < len(rows):
            role, text, fault = rows[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, state, lines))
            if fault not in ("blank", "duplicate"):
                more = fault == "truncated"
                after = NEXT[state].get(role[:1]) if role else state
                if after is not None:
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, after, (*lines, f"{role}:{text}")))
                heapq.heappush(heap, (cost + more + 2, audit + "R", i + 1, NEXT[state][new], (*lines, f"{name}:{text}")))


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        body = text.rstrip(WHITE)
        kind = "blank" if not body else "duplicate" if (role, text) in seen else "" if body[-1] in ".!?" else "truncated"
        seen.add((role, text))
        out.append((role, text, kind))
    return out


def summary(rows):
    """rows: (turn, role, text) in order."""
    known = faults([r[1:] for r in rows])
    cost, audit, lines = cheapest(known)
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    count = lambda kind: sum(k[2] == kind for k in known)
    illegal = sum((a[0][:1] + b[0][:1]) not in ("su", "ua", "au") for a, b in zip(known, known[1:]))
    sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return (gaps, count("blank"), count("duplicate"), count("truncated"), illegal, cost, audit, sha)


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        conv_name, turn_name, role, text = (" " if x is None else str(x) for x in (conv, turn, role, text))
        kind = zlib.crc32(f"{conv_name}:{turn_name}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def expected(original, rows):
    want = {}
    for conv in {r[0] for r in original}:
        own = [r[1:] for r in rows if r[0] == conv]
        want[conv] = summary(sorted(own, key=lambda r: (r[0] is not None, r[0] or 0)))
    return want


def got(frame):
    return {r.conv_id: tuple(r)[1:] for r in frame.collect()}


def drawn(seed, n):
    draw = random.Random(seed)
    rows = []
    for _ in range(n):
        role = draw.choice(["user", "assistant", "user", "assistant", "system", "tool", "", " ", "agent"])
        text = draw.choice(["", " \n", "same.", "Hi there", f"text {draw.random()}.", f"open {draw.random()}", "ok? \t"])
        rows.append((role, text))
    return rows


@pytest.mark.parametrize("seed", range(40))
def test_auction_against_search(seed):
    rows = faults(drawn(seed, seed % 12))
    lattice = Lattice([(r[0][:1], r[2]) for r in rows], [0, None, None, 0], True)
    cost, audit, _ = cheapest(rows)
    assert lattice.solve(0) == cost
    labels, end = lattice.trace(0)
    assert "".join(x for x, _ in labels) == audit and end in WHOLE


@pytest.mark.parametrize("seed", range(10))
def test_costs_of_parts_add_up(seed):
    rows = [(r[0][:1], r[2]) for r in faults(drawn(seed, 11))]
    whole = distances(rows, True)
    both = conversations._both([distances(rows[:4], False), distances(rows[4:7], False), distances(rows[7:], True)])
    assert both == whole
    behind = conversations.OPEN_END
    best = [min(whole[s * STATES + b] + behind[b] for b in range(STATES)) for s in range(STATES)]
    lattice = Lattice(rows, [0, None, None, 0], True)
    assert best == [lattice.solve(s) for s in range(STATES)]


def test_prices_hold_on_long_lattices():
    rows = [("u" if i % 3 else "a", "truncated" if i % 7 == 0 else "") for i in range(2000)]
    lattice = Lattice(rows, [0, None, None, 0], True)
    cost = lattice.solve(0)
    letters = [x for x, _ in lattice.trace(0)[0]]
    assert cost == sum({"K": 0, "R": 2, "D": 3, "I": 2}[x] for x in letters) + sum(
        rows[i][1] == "truncated" for i, x in enumerate(x for x in letters if x != "I") if x != "D"
    )


@pytest.mark.parametrize("sizes", [{}, {"segment": 5, "fan": 4}])
def test_report_against_search(spark, sizes):
    draw = random.Random(5)
    rows = []
    for conv in range(30):
        # One conversation is far longer than a segment.
        for turn, (role, text) in enumerate(drawn(conv, 90 if conv == 7 else draw.randrange(0, 14))):
            rows.append((conv, turn, role, text))
    rows += [(None, 0, "user", "Hello."), (None, 1, "assistant", "Yes."), (50, None, "user", "No number."), (51, 3, None, "x."), (51, 9, "user", None)]
    rows += [(52, 1, "user", "long words " * 20_000 + "."), (52, 2, "assistant", "Ok."), (53, 4, "user", "Twice."), (53, 4, "user", "Twice.")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    if sizes:
        bare = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
        assert got(conversations.report(frame, **sizes)) == expected(rows, bare)
    else:
        worse = conversations.damage(frame)
        assert got(conversations.report(worse, frame)) == expected(rows, damaged(rows))


def test_repaired_turns(spark):
    rows = [(1, 0, "assistant", "First."), (1, 1, "user", "Ask?"), (1, 2, "user", "Again?"), (1, 3, "assistant", " ")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    repair = conversations.Repair(frame)
    _, audit, lines = cheapest(faults([r[2:] for r in rows]))
    turns = [f"{r.role}:{r.text}" for r in repair.turns().collect()]
    assert turns == lines
    assert repair.totals().first().audit == audit


def test_no_turns_and_clashing_names(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert conversations.report(none).collect() == []
    clash = spark.createDataFrame(
        [(1, 0, "user", "Hi.", 1, 2, 3, "x")], "conv_id long, turn long, role string, text string, c int, row_index int, block int, turns string"
    )
    assert got(conversations.report(clash))[1][5:7] == (2, "KI")
    gone = spark.createDataFrame([(1, 0, "user", "Hi.")], "conv_id long, turn long, role string, text string")
    empty = conversations.report(gone.where("false"), gone).first()
    assert tuple(empty) == (1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_query_against_search(spark, docs_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{docs_dir}/conversations.parquet").collect()]
    assert got(QUERIES["op11_auction_repair"](spark, docs_dir)) == expected(rows, damaged(rows))
