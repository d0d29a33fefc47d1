"""Conversation repair and prefix tries against brute force."""

import itertools

import brute
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from eventloom.llm import turn_repair

SCHEMA = "conv_id long, turn long, role string, text string, _c string, seq string, kind string"
TABLES = "/root/testdata/sf0.001"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash", "clash") for r in rows], SCHEMA)


ODD = [
    (1, 0, "system", "Be kind."), (1, 1, "user", "Hello?"), (1, 2, "assistant", "Hello!"),
    (2, 0, "assistant", "No one asked."), (2, 0, "assistant", "No one asked."), (2, 1, "tool", "cut off"),
    (3, None, None, None), (3, None, "user", ""), (3, 5, "", "What. Now!"),
    (None, 0, "user", "no id."), (None, 1, "assistant", "still none."),
    (4, 0, "user", "Long. " * 20_000), (4, 1, "user", "Long. " * 20_000),
    (-5, 7, "user", " \n\t "), (-5, 9, "system", "late system."),
    *[(6, t, "user" if t % 3 else "assistant", f"turn {t % 40}" + "." * (t % 5 > 0)) for t in range(150)],
]


def repaired(spark, rows, **kw):
    fixed = turn_repair.repair(turn_repair.damage(frame(spark, rows)), "conv", "turn", "role", "text", **kw)
    joined = fixed.report.join(turn_repair.digests(fixed.turns), "_c", "left")
    return {r[0]: (*r[1:8], r[8] or brute.sha(b"")) for r in joined.collect()}


@pytest.mark.parametrize("kw", [{}, {"chunk": 8, "fan": 3, "rules": 5}, {"chunk": 1, "fan": 2, "rules": 0}])
def test_repair(spark, kw):
    got = repaired(spark, ODD, **kw)
    name = lambda c: "-" if c is None else f"={c}"
    want = {name(c): brute.repaired(rows) for c, rows in brute.damaged(ODD).items() if rows}
    assert got == want


def test_repair_of_nothing(spark):
    fixed = turn_repair.repair(frame(spark, []))
    assert fixed.report.count() == 0 and fixed.turns.count() == 0


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("suaxSUAXd", min_size=1, max_size=12), min_size=1, max_size=4))
def test_rules_change_nothing(sequences):
    """Costs and edits by rules are those of the plain products, and of brute force on the symbols."""
    rules, pool = [], list(sequences)
    for _ in range(4):
        short = turn_repair.shorten(pool, rules)
        pairs = {a + b for s in short for a, b in zip(s, s[1:])}
        if pairs:
            rules.append(tuple(sorted(pairs)[len(pairs) // 2]))
    known = turn_repair.matrices(rules)
    for seq, short in zip(pool, turn_repair.shorten(pool, rules)):
        row = {turn_repair.START: (0, turn_repair.Rope())}
        for symbol in short:
            row = turn_repair.step(row, known[symbol])
        cost, edits = turn_repair.finish(row)
        texts = {"d": " "}
        rows = [
            (i, {"s": "system", "u": "user", "a": "assistant", "x": "tool"}.get(c.lower(), "tool"), texts.get(c, f"{i}" + "." * c.islower()))
            for i, c in enumerate(seq)
        ]
        want = brute.repaired(rows)
        assert (cost, edits.translate(turn_repair.INITIALS)) == want[5:7]


def test_brute_force_itself():
    """The cheapest of all edit strings of up to seven letters, tried one by one."""
    for roles in itertools.product(("system", "user", "assistant", "tool"), repeat=3):
        rows = [(i, r, f"{i}.") for i, r in enumerate(roles)]
        ways = []
        for size in range(3, 8):
            for edits in itertools.product("DIKR", repeat=size):
                if sum(e != "I" for e in edits) != 3:
                    continue
                state, at, cost, fits = "", 0, 0, True
                for e in edits:
                    new = "a" if state == "u" else "u"
                    if e == "K":
                        first = roles[at][0]
                        fits &= first == new or (first == "s" and state == "")
                        state = first
                    elif e != "D":
                        state = new
                    at, cost = at + (e != "I"), cost + {"D": 3, "I": 2, "K": 0, "R": 2}[e]
                if fits and state in ("", "a"):
                    ways.append((cost, "".join(edits)))
        assert min(ways) == brute.repaired(rows)[5:7]


def test_repair_query(spark):
    import __spark_entry__

    rows = [tuple(r) for r in spark.read.parquet(f"{TABLES}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = __spark_entry__.queries()["op12_conversation_repair"](spark, TABLES)
    assert got.columns == "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256".split()
    want = {(c, *brute.repaired(r)) for c, r in brute.damaged(rows).items()}
    assert {tuple(r) for r in got.collect()} == want


def many_conversations():
    """Shared beginnings, prefixes of one another, long copies and turnless ones."""
    import random

    rng, rows = random.Random(3), []
    for conv in [*range(0, 130), -3, -20, -27, 977, 999]:
        for turn in range(rng.choice([1, 1, 2, 3, 5, 9])):
            rows.append((conv, turn, rng.choice(["user", "assistant"]), f"say {rng.randrange(3)} {'x ' * rng.randrange(3)}"))
    for conv in (300, 301, 302, 303, 320):
        rows += [(conv, t, "user", f"long {t}" if t < 37 or conv < 303 else f"other {t}") for t in range(41 + conv % 2)]
    return rows


def tries(spark, rows, **kw):
    from eventloom.llm import turn_tries

    nodes = turn_tries.prefix_trie(frame(spark, rows), **kw)
    columns = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
    return [tuple(r) for r in nodes.select(columns).collect()]


@pytest.mark.parametrize("rows", [ODD, many_conversations(), ODD + many_conversations()])
@pytest.mark.parametrize("kw", [{}, {"segment": 4, "run": 20}, {"segment": 1, "run": 1}])
def test_trie(spark, rows, kw):
    assert sorted(tries(spark, rows, **kw), key=repr) == sorted(brute.trie(rows), key=repr)


def test_trie_of_nothing(spark):
    assert tries(spark, []) == [] and tries(spark, [(None, 0, "user", "no id")]) == []


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(-1000, 1000), st.lists(st.integers(0, 300), max_size=6), min_size=1, max_size=60))
def test_radix_tree(paths):
    """All turn-aligned prefixes with their members; every layout occurs among ids that differ in their first byte."""
    from eventloom.llm.turn_tries import RadixTree

    turn = lambda n: bytes([n % 256]) * 8 + n.to_bytes(8, "big")
    tree = RadixTree()
    want = {}
    for conv, numbers in paths.items():
        tree.add(b"".join(map(turn, numbers)), conv)
        for d in range(len(numbers) + 1):
            want.setdefault(tuple(numbers[:d]), []).append(conv)
    marks = tree.turns(b"\0" * 16, {turn(n): 1 for n in range(301)})
    assert sorted((m.depth, m.count, m.least) for m in marks) == sorted((len(p), len(c), min(c)) for p, c in want.items())
    assert all(not m.children == 0 or m.leaves == 1 for m in marks if not m.open)


def test_layouts_grow():
    from eventloom.llm.turn_tries import Node4, Node16, Node48, Node256

    node, kinds = Node4(), set()
    for n in range(256):
        node = node.put(n * 7 % 256, n)
        kinds.add(type(node))
        assert [k for _, k in node.items()] == sorted(range(n + 1), key=lambda m: m * 7 % 256)
    assert kinds == {Node4, Node16, Node48, Node256} and node.get(7) == 1
    assert Node4([(1, "a")]).get(2) is None


def test_trie_query(spark):
    import __spark_entry__

    rows = [tuple(r) for r in spark.read.parquet(f"{TABLES}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = __spark_entry__.queries()["op13_prefix_trie"](spark, TABLES)
    assert got.columns == "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(brute.trie(rows), key=repr)
