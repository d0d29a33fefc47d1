"""Repair of conversation structure: a shared Re-Pair grammar over role and fault symbols, min-plus matrices per rule."""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.spread import lookup_join, number_rows
from ..session import settle

#: Turns of one sequence; longer conversations are several, whose matrices are multiplied level by level.
CHUNK, FAN = 512, 64
#: Rules of the grammar and rounds that make them: what no rule covers is multiplied out in place.
RULES, ROUNDS = 1024, 16

# States of the pattern (s?(ua)+)?: before all, after s, after u, after a.
START, SYSTEM, USER, ASSISTANT = range(4)
# Edits inside ropes. The letters sort like the initials they stand for and also name the inserted or given role.
INSERTS = {(START, USER): "I", (SYSTEM, USER): "I", (ASSISTANT, USER): "I", (USER, ASSISTANT): "J"}
INITIALS = str.maketrans("JS", "IR")
ROLES = {"I": "user", "J": "assistant", "R": "user", "S": "assistant"}
KEEPS = {"s": [(START, SYSTEM)], "u": [(START, USER), (SYSTEM, USER), (ASSISTANT, USER)], "a": [(USER, ASSISTANT)]}
KEEP, REROLE, DELETE, INSERT, CUT = 0, 2, 3, 2, 1

_PRIME, _BASE = (1 << 61) - 1, 1_000_003


class Rope:
    """Immutable string as a tree of shared parts, compared by the hashes of prefixes."""

    __slots__ = ("left", "right", "text", "size", "hash")

    def __init__(self, text: str = "", left: Rope | None = None, right: Rope | None = None):
        self.left, self.right, self.text = left, right, text
        if left is None:
            self.size, self.hash = len(text), _digest(text)
        else:
            self.size, self.hash = left.size + right.size, _append(left.hash, right.hash, right.size)

    def __add__(self, other: Rope) -> Rope:
        if not self.size or not other.size:
            return self if self.size else other
        return Rope(left=self, right=other)

    def prefix_hash(self, size: int) -> int:
        done, part = 0, self
        while size < part.size:
            if part.left is None:
                return _append(done, _digest(part.text[:size]), size)
            if size <= part.left.size:
                part = part.left
            else:
                done, size, part = _append(done, part.left.hash, part.left.size), size - part.left.size, part.right
        return _append(done, part.hash, part.size)

    def letter(self, at: int) -> str:
        part = self
        while part.left is not None:
            at, part = (at, part.left) if at < part.left.size else (at - part.left.size, part.right)
        return part.text[at]

    def __lt__(self, other: Rope) -> bool:
        low, high = 0, min(self.size, other.size)
        while low < high:  # the longest common prefix
            mid = (low + high + 1) // 2
            low, high = (mid, high) if self.prefix_hash(mid) == other.prefix_hash(mid) else (low, mid - 1)
        if low in (self.size, other.size):
            return self.size < other.size
        return self.letter(low) < other.letter(low)

    def __str__(self) -> str:
        parts, todo = [], [self]
        while todo:
            part = todo.pop()
            if part.left is None:
                parts.append(part.text)
            else:
                todo += part.right, part.left
        return "".join(parts)


def _digest(text: str) -> int:
    return reduce(lambda done, letter: (done * _BASE + ord(letter)) % _PRIME, text, 0)


def _append(done: int, more: int, size: int) -> int:
    return (done * pow(_BASE, size, _PRIME) + more) % _PRIME


# A matrix has a dictionary of (state after: (cost, rope)) for each state before; what is not there is impossible.
Row = dict[int, tuple[int, Rope]]


def better(row: Row, state: int, cost: int, first: Rope, then: Rope) -> None:
    known = row.get(state)
    if known is None or cost < known[0]:
        row[state] = cost, first + then
    elif cost == known[0] and (edits := first + then) < known[1]:
        row[state] = cost, edits


def step(row: Row, matrix: list[Row]) -> Row:
    """Min-plus product of a row with a matrix: least cost, then the first audit."""
    out: Row = {}
    for middle, (cost, edits) in row.items():
        for state, (more, then) in matrix[middle].items():
            better(out, state, cost + more, edits, then)
    return out


def times(a: list[Row], b: list[Row]) -> list[Row]:
    return [step(row, b) for row in a]


def insertions() -> list[Row]:
    """Empty-text turns that may stand in one place: at most one of each role helps."""
    one: list[Row] = [{i: (0, Rope())} for i in range(4)]
    for (before, after), letter in INSERTS.items():
        better(one[before], after, INSERT, Rope(), Rope(letter))
    return times(one, one)


def symbol_matrix(symbol: str) -> list[Row]:
    """Edits of one turn after any insertions: ``s u a`` or ``x`` (another role), as capitals where truncated, or
    ``d`` for what has to go."""
    edits: list[Row] = [{i: (DELETE, Rope("D"))} for i in range(4)]
    if symbol != "d":
        cut = CUT if symbol.isupper() else 0
        for before, after in KEEPS.get(symbol.lower(), []):
            better(edits[before], after, KEEP + cut, Rope("K"), Rope())
        for before, after in INSERTS:
            better(edits[before], after, REROLE + cut, Rope("R" if after == USER else "S"), Rope())
    return times(insertions(), edits)


def matrices(rules: list[tuple[str, str]]) -> dict[str, list[Row]]:
    """Matrix of every symbol and, bottom-up, of every rule: the product of its two parts."""
    known = {symbol: symbol_matrix(symbol) for symbol in "suaxSUAXd"}
    for at, (left, right) in enumerate(rules):
        known[name_of(at)] = times(known[left], known[right])
    return known


def finish(row: Row) -> tuple[int, str]:
    """Cost and edits of the cheapest way to a complete pattern."""
    closed = step(row, insertions())
    ends: Row = {}
    for state in (START, ASSISTANT):
        if state in closed:
            better(ends, 0, *closed[state], Rope())
    return ends[0][0], str(ends[0][1])


def name_of(rule: int) -> str:
    return chr(0x4E00 + rule)


def shorten(sequences: list[str], rules: list[tuple[str, str]]) -> list[str]:
    """Sequences with all rules put in, in their order and leftmost first."""
    whole = "\n".join(sequences)
    for at, (left, right) in enumerate(rules):
        whole = whole.replace(left + right, name_of(at))
    return whole.split("\n") if sequences else []


def grammar(sequences: DataFrame, rules: int = RULES, rounds: int = ROUNDS) -> list[tuple[str, str]]:
    """Re-Pair over all of ``sequences (seq, uses)``: each round counts the adjacent pairs of all sequences and makes
    rules of the most frequent ones that have no symbol in common, until no pair is used twice."""
    made: list[tuple[str, str]] = []
    for _ in range(rounds):
        known = list(made)

        def count(batches, known=known):
            pairs: Counter = Counter()
            for batch in batches:
                for seq, uses in zip(shorten(batch.column(0).to_pylist(), known), batch.column(1).to_pylist()):
                    for pair in zip(seq, seq[1:]):
                        pairs["".join(pair)] += uses
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(pairs), pa.string()), pa.array(list(pairs.values()), pa.int64())], ["pair", "n"]
            )

        pairs = sequences.select("seq", "uses").mapInArrow(count, "pair string, n long")
        often = pairs.groupBy("pair").agg(F.sum("n").alias("n")).where("n > 1")
        taken: set[str] = set()
        before = len(made)
        for row in often.orderBy(F.desc("n"), "pair").limit(rules).collect():
            left, right = row["pair"]
            if len(made) < rules and not taken & {left, right}:
                taken |= {left, right}
                made.append((left, right))
        if len(made) == before:
            break
    return made


def _solver(rules: list[tuple[str, str]]):
    """Costs and edits of each distinct sequence: its row from the start, or its whole matrix."""

    def solve(batches):
        known = matrices(rules)
        for batch in batches:
            short = shorten(batch.column("seq").to_pylist(), rules)
            out = []
            for seq, first in zip(short, batch.column("first").to_pylist()):
                rows = [{i: (0, Rope())} for i in ([START] if first else range(4))]
                for symbol in seq:
                    rows = times(rows, known[symbol])
                cost, edits = finish(rows[0]) if first else (None, None)
                out.append((_pack(rows), cost, edits))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("name"),
                    pa.array([o[0] for o in out], pa.list_(pa.struct([("f", "int32"), ("t", "int32"), ("c", "int64"), ("e", "string")]))),
                    pa.array([o[1] for o in out], pa.int64()),
                    pa.array([o[2] for o in out], pa.string()),
                ],
                ["name", "ways", "cost", "edits"],
            )

    return solve


def _pack(rows: list[Row]) -> list[dict]:
    return [
        {"f": before, "t": after, "c": cost, "e": str(edits)}
        for before, row in enumerate(rows)
        for after, (cost, edits) in row.items()
    ]


def _unpack(ways: list[dict]) -> list[Row]:
    rows: list[Row] = [{} for _ in range(1 + max((w["f"] for w in ways), default=0))]
    for w in ways:
        rows[w["f"]][w["t"]] = w["c"], Rope(w["e"])
    return rows


_WAYS = "ways array<struct<f int, t int, c long, e string>>"


def _fold(key, table):
    """Product of neighbouring matrices of one conversation."""
    nodes = sorted(zip(table.column("at").to_pylist(), table.column("ways").to_pylist()), key=lambda n: n[0])
    rows = reduce(times, [_unpack(ways) for _, ways in nodes])
    last = len(nodes) and nodes[0][0] == 0
    cost, edits = finish(rows[0]) if last else (None, None)
    return pa.table(
        {
            "_c": [key[0].as_py()],
            "at": [key[1].as_py()],
            "ways": pa.array([_pack(rows)], pa.list_(pa.struct([("f", "int32"), ("t", "int32"), ("c", "int64"), ("e", "string")]))),
            "cost": pa.array([cost], pa.int64()),
            "edits": pa.array([edits], pa.string()),
        }
    )


def _pieces(size: int):
    """Edits of each sequence of a conversation: ``size`` turns with the insertions before them; the last takes the rest."""

    def cut(batches):
        for batch in batches:
            names, places, pieces = [], [], []
            for name, edits in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                turns = re.findall("[IJ]*[DKRS]", edits)
                rest = edits[sum(map(len, turns)) :]
                for first in range(0, max(len(turns), 1), size):
                    names.append(name)
                    places.append(first // size)
                    pieces.append("".join(turns[first : first + size]) + rest * (first + size >= len(turns)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array(places, pa.int64()), pa.array(pieces, pa.string())],
                ["_c", "chunk", "edits"],
            )

    return cut


def _apply(batches):
    """The repaired turns: of each sequence first the edits (in ``text``) come, then its turns in order."""
    current, edits, at, count, last = None, "", 0, 0, 0
    out: list[tuple] = []

    def insert_until_turn() -> None:
        nonlocal at, count
        while at < len(edits) and edits[at] in "IJ":
            out.append((current, last, count, ROLES[edits[at]], ""))
            at, count = at + 1, count + 1

    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("_c", "_n", "_role", "_text"))
        for name, number, role, text in zip(*columns):
            if number < 0:  # a new sequence; what is left of the one before are insertions at its end
                insert_until_turn()
                current, edits, at, count = name, text, 0, 0
                continue
            last = number
            insert_until_turn()
            edit, at = edits[at], at + 1
            if edit != "D":
                out.append((name, number, count, ROLES.get(edit, role), text))
                count += 1
        yield _turns(out)
        out.clear()
    insert_until_turn()
    yield _turns(out)


def _turns(rows: list[tuple]) -> pa.RecordBatch:
    kinds = pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()
    columns = list(zip(*rows)) or [[]] * len(kinds)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds)], ["_c", "_n", "_i", "role", "text"]
    )


class Repair:
    """Result of ``repair``: ``report`` has a row a conversation, ``turns`` the repaired turns ``(_c, _n, _i, role,
    text)`` in the order of ``_n, _i``; ``_c`` names the conversation in both."""

    def __init__(self, report: DataFrame, turns: DataFrame):
        self.report, self.turns = report, turns


def conversation_name(conv: str) -> Column:
    """The id as text, with a name of its own for null."""
    return F.coalesce(F.concat(F.lit("="), F.col(f"`{conv}`").cast("string")), F.lit("-"))


def repair(
    df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    chunk: int = CHUNK, fan: int = FAN, rules: int = RULES,
) -> Repair:
    """Faults of each conversation and the cheapest edits that give its roles the form ``(s?(ua)+)?``.

    Turns go by ``turn`` (null first), then role, then text. A turn's first fault counts: blank, duplicate (role and text
    seen earlier), truncated. Keeping costs nothing, a new role 2, deletion 3 (due for blank and duplicate turns), an
    empty turn put in 2, and a truncated turn that stays 1 more. Among equal costs the least string of initials
    (D, I, K, R) is taken.

    Turns become one of nine symbols, conversations sequences of at most ``chunk`` of them, and equal sequences one row.
    One grammar of at most ``rules`` rules is made over all of them; the matrix of each rule is computed once and serves
    all conversations. Longer conversations multiply the matrices of their sequences, ``fan`` at a time. Only the
    edits of a whole conversation, which the report holds, are as long as it.

    Null roles and texts count as one space, a null id is a conversation of its own, other columns are not read, and
    an empty table gives an empty report.
    """
    space, none = F.lit(" "), F.lit(None).cast("string")
    rows = df.select(
        conversation_name(conv).alias("_c"),
        F.col(f"`{turn}`").alias("_turn"),
        F.coalesce(F.col(f"`{role}`").cast("string"), space).alias("_role"),
        F.coalesce(F.col(f"`{text}`").cast("string"), space).alias("_text"),
    )
    rows = number_rows(rows, ["_c", F.col("_turn").asc_nulls_first(), "_role", "_text"], "_n")
    convs = rows.groupBy("_c").agg(
        F.min("_n").alias("_first"), F.max("_n").alias("_last"),
        (F.max("_turn") - F.min("_turn") + 1).alias("_span"),
    )
    distinct = rows.where("_turn is not null").groupBy("_c", "_turn").agg(F.lit(1).alias("_one"))
    distinct = distinct.groupBy("_c").agg(F.count(F.lit(1)).alias("_turns"))
    convs = settle(convs.join(distinct, "_c", "left"))
    same = F.concat_ws(":", F.xxhash64(F.lit(0), "_c", "_role", "_text"), F.xxhash64(F.lit(1), "_c", "_role", "_text"))
    last = F.regexp_extract("_text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    who = F.substring("_role", 1, 1)
    narrow = rows.select(
        "_c", "_n", same.alias("_same"), (last == "").alias("_blank"), (~last.isin(".", "!", "?")).alias("_cut"),
        F.when(who.isin("s", "u", "a"), who).otherwise("x").alias("_who"),
    )
    narrow = settle(lookup_join(narrow, convs.select("_c", "_first"), "_c", by=["_n"]))
    again = narrow.groupBy("_same").agg(F.min("_n").alias("_seen"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    marked = lookup_join(narrow, settle(again), "_same", "left", by=["_n"])
    late = F.coalesce(F.col("_n") > F.col("_seen"), F.lit(False)) & ~F.col("_blank")
    short = F.col("_cut") & ~F.col("_blank") & ~late
    gone = F.col("_blank") | late
    symbol = F.when(gone, "d").when(short, F.upper("_who")).otherwise(F.col("_who"))
    place = F.floor((F.col("_n") - F.col("_first")) / F.lit(chunk))
    marked = marked.select(
        "_c", "_n", "_blank", late.alias("_late"), short.alias("_short"), "_who", symbol.alias("_symbol"), place.alias("chunk")
    )
    ordered = F.array_sort(F.collect_list(F.struct("_n", "_symbol", "_who")))
    joined = lambda name: F.array_join(F.transform("turns", lambda t: t[name]), "")
    chunks = marked.groupBy("_c", "chunk").agg(
        ordered.alias("turns"), *[F.count_if(f"_{n}").alias(f"n_{n}") for n in ("blank", "late", "short")]
    )
    chunks = chunks.withColumn("seq", joined("_symbol")).withColumn("whos", joined("_who"))
    pairs = F.transform(F.sequence(F.lit(1), F.length("whos")), lambda i: F.substr("whos", i, F.lit(2)))
    wrong = F.size(F.filter(pairs, lambda p: (F.length(p) == 2) & ~p.isin("su", "ua", "au")))
    chunks = chunks.withColumn("n_wrong", wrong).withColumn("first", F.col("chunk") == 0)
    chunks = settle(
        chunks.drop("turns").withColumn("name", F.concat(F.when(F.col("first"), "^").otherwise("-"), "seq"))
    )
    many = chunks.select("_c", "chunk", "whos").join(chunks.where("chunk > 0").select("_c").distinct(), "_c")
    border = many.select("_c", "chunk", F.substring("whos", -1, 1).alias("l")).join(
        many.select("_c", (F.col("chunk") - 1).alias("chunk"), F.substring("whos", 1, 1).alias("r")), ["_c", "chunk"]
    )
    border = border.select("_c", F.when(F.concat("l", "r").isin("su", "ua", "au"), 0).otherwise(1).alias("n_wrong"))
    zero = F.lit(0).cast("bigint")
    faults = chunks.select("_c", "n_blank", "n_late", "n_short", F.col("n_wrong").cast("bigint").alias("n_wrong")).unionByName(
        border.select("_c", zero.alias("n_blank"), zero.alias("n_late"), zero.alias("n_short"), F.col("n_wrong").cast("bigint").alias("n_wrong"))
    )
    faults = faults.groupBy("_c").agg(*[F.sum(c).alias(c) for c in ("n_blank", "n_late", "n_short", "n_wrong")])

    # one grammar over the distinct sequences, then their costs and edits
    sequences = settle(chunks.groupBy("name", "seq", "first").agg(F.count(F.lit(1)).alias("uses")))
    made = grammar(sequences, rules)
    solved = sequences.select("name", "seq", "first").mapInArrow(
        _solver(made), f"name string, {_WAYS}, cost long, edits string"
    )
    solved = settle(solved)
    nodes = lookup_join(chunks.select("_c", "chunk", "name"), solved, "name", by=["_c"])
    nodes = settle(nodes.select("_c", F.col("chunk").alias("at"), "ways", "cost", "edits"))
    ends = convs.select("_c", F.floor((F.col("_last") - F.col("_first")) / F.lit(chunk)).alias("last"))
    done = nodes.join(ends.where("last = 0").select("_c"), "_c").select("_c", "cost", "edits")
    long = settle(nodes.join(ends.where("last > 0").select("_c"), "_c"))
    while long.where("at > 0").limit(1).count():
        group = long.select("_c", F.floor(F.col("at") / fan).alias("up"), "at", "ways").groupBy("_c", "up")
        long = settle(group.applyInArrow(_fold, f"_c string, at long, {_WAYS}, cost long, edits string"))
    done = settle(done.unionByName(long.select("_c", "cost", "edits")))

    pieces = done.select("_c", "edits").mapInArrow(_pieces(chunk), "_c string, chunk long, edits string")
    texts = lookup_join(rows.select("_c", "_n", "_role", "_text"), convs.select("_c", "_first"), "_c", by=["_n"])
    texts = texts.withColumn("chunk", place).drop("_first")
    # edits and turns of a sequence meet in one partition, the edits first, and are read as they come
    first = pieces.select("_c", F.lit(-1).cast("bigint").alias("_n"), none.alias("_role"), F.col("edits").alias("_text"), "chunk")
    both = texts.select("_c", "_n", "_role", "_text", "chunk").unionByName(first)
    both = both.repartition("_c", "chunk").sortWithinPartitions("_c", "chunk", "_n").drop("chunk")
    turns = both.mapInArrow(_apply, "_c string, _n long, _i long, role string, text string")
    report = convs.select("_c", F.coalesce(F.col("_span") - F.col("_turns"), zero).alias("gaps")).join(faults, "_c").join(done, "_c")
    return Repair(
        report.select(
            "_c", "gaps", F.col("n_blank").alias("blank"), F.col("n_late").alias("duplicate"),
            F.col("n_short").alias("truncated"), F.col("n_wrong").alias("illegal"), "cost",
            F.translate("edits", "JS", "IR").alias("audit"),
        ),
        turns,
    )


def digests(turns: DataFrame) -> DataFrame:
    """``(_c, sha256)`` of the lines ``role:text`` of each repaired conversation, read in order as they come."""

    def add_up(batches):
        current, state = None, hashlib.sha256()
        for batch in batches:
            names, sums = [], []
            columns = [batch.column(c).to_pylist() for c in ("_c", "role", "text")]
            for name, role, text in zip(*columns):
                line = f"{role}:{text}".encode()
                if name != current:
                    if current is not None:
                        names.append(current)
                        sums.append(state.hexdigest())
                    current, state = name, hashlib.sha256(line)
                else:
                    state.update(b"\n" + line)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(sums, pa.string())], ["_c", "sha256"])
        if current is not None:
            yield pa.RecordBatch.from_arrays([pa.array([current]), pa.array([state.hexdigest()])], ["_c", "sha256"])

    ordered = turns.repartition("_c").sortWithinPartitions("_c", "_n", "_i")
    return ordered.mapInArrow(add_up, "_c string, sha256 string")


def damage(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Damaged copy ``(conv, turn, role, text)``, by crc32 of ``conv:turn`` modulo 20: 0 drops the turn, 1 empties its text,
    2 takes its end marks away, 3 repeats it, 4 makes it a user's. Nulls in the key, the role and the text are one space."""
    space = F.lit(" ")
    id_text, turn_text = (F.coalesce(F.col(f"`{c}`").cast("string"), space) for c in (conv, turn))
    lot = F.crc32(F.concat(id_text, F.lit(":"), turn_text).cast("binary")) % 20
    old = F.coalesce(F.col(f"`{text}`").cast("string"), space)
    rows = df.select(
        F.col(f"`{conv}`").alias("conv"),
        F.col(f"`{turn}`").alias("turn"),
        F.when(lot == 4, "user").otherwise(F.coalesce(F.col(f"`{role}`").cast("string"), space)).alias("role"),
        F.when(lot == 1, "").when(lot == 2, F.regexp_replace(old, "[.!?]", "")).otherwise(old).alias("text"),
        lot.alias("lot"),
    )
    copies = F.when(F.col("lot") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.where("lot <> 0").select("conv", "turn", "role", "text", F.explode(copies).alias("copy")).drop("copy")

