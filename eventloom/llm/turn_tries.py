"""Prefix tries of conversations: adaptive radix trees over fixed-width turn ids, built per sorted run and joined."""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


from ..operators.spread import lookup_join
from ..session import settle

#: Bytes of a turn id, turns of a path segment, turns of the paths that one task turns into trees at a time.
WIDTH, SEGMENT, RUN = 16, 512, 100_000
#: Conversations share the first turns of the one whose id is a multiple of this, as many as crc32 of the id modulo ``HEADS``.
FAMILY, HEADS = 20, 4
_ROOT = b"\0" * WIDTH


class Node4:
    """Children by their byte, sorted; grows to ``Node16``, ``Node48`` and ``Node256``."""

    __slots__ = ("bytes", "kids")
    room = 4

    def __init__(self, items=()):
        self.bytes, self.kids = bytearray(b for b, _ in items), [k for _, k in items]

    def get(self, byte: int):
        at = bisect_left(self.bytes, byte)
        return self.kids[at] if at < len(self.bytes) and self.bytes[at] == byte else None

    def put(self, byte: int, kid) -> Node4 | Node48 | Node256:
        at = bisect_left(self.bytes, byte)
        if at < len(self.bytes) and self.bytes[at] == byte:
            self.kids[at] = kid
            return self
        if len(self.bytes) == self.room:
            return grown(self).put(byte, kid)
        self.bytes.insert(at, byte)
        self.kids.insert(at, kid)
        return self

    def items(self):
        return list(zip(self.bytes, self.kids))


class Node16(Node4):
    __slots__ = ()
    room = 16


class Node48:
    """A table of 256 places into at most 48 children."""

    __slots__ = ("place", "kids")
    room = 48

    def __init__(self, items=()):
        self.place, self.kids = bytearray(b"\xff" * 256), []
        for byte, kid in items:
            self.place[byte] = len(self.kids)
            self.kids.append(kid)

    def get(self, byte: int):
        return self.kids[self.place[byte]] if self.place[byte] != 255 else None

    def put(self, byte: int, kid) -> Node48 | Node256:
        if self.place[byte] != 255:
            self.kids[self.place[byte]] = kid
            return self
        if len(self.kids) == self.room:
            return grown(self).put(byte, kid)
        self.place[byte] = len(self.kids)
        self.kids.append(kid)
        return self

    def items(self):
        return [(b, self.kids[p]) for b, p in enumerate(self.place) if p != 255]


class Node256:
    """A child for every byte."""

    __slots__ = ("kids",)

    def __init__(self, items=()):
        self.kids = [None] * 256
        for byte, kid in items:
            self.kids[byte] = kid

    def get(self, byte: int):
        return self.kids[byte]

    def put(self, byte: int, kid) -> Node256:
        self.kids[byte] = kid
        return self

    def items(self):
        return [(b, k) for b, k in enumerate(self.kids) if k is not None]


def grown(node):
    larger = {Node4: Node16, Node16: Node48, Node48: Node256}[type(node)]
    return larger(node.items())


class Edge:
    """A compressed stretch of bytes, the children after it, and what passes: members and the smallest of them.

    ``open`` is the depth in bytes up to which other trees may hold the same prefixes.
    """

    __slots__ = ("part", "kids", "count", "least", "open")

    def __init__(self, part: bytes, kids, count: int, least: int):
        self.part, self.kids, self.count, self.least, self.open = part, kids, count, least, -1


class RadixTree:
    def __init__(self):
        self.top = Edge(b"", Node4(), 0, None)

    def add(self, path: bytes, member: int) -> None:
        edge, at = self.top, 0
        while True:
            edge.count += 1
            edge.least = member if edge.least is None else min(edge.least, member)
            at += len(edge.part)
            if at == len(path):
                return
            kid = edge.kids.get(path[at])
            if kid is None:
                edge.kids = edge.kids.put(path[at], Edge(path[at:], Node4(), 1, member))
                return
            same = common(kid.part, path, at)
            if same < len(kid.part):  # the stretch parts here
                upper = Edge(kid.part[:same], Node4(), kid.count, kid.least)
                kid.part = kid.part[same:]
                upper.kids = upper.kids.put(kid.part[0], kid)
                edge.kids = edge.kids.put(path[at], upper)
                kid = upper
            edge = kid

    def open_path(self, path: bytes) -> None:
        """Other trees may hold any prefix of this path."""
        edge, at = self.top, 0
        while True:
            at += len(edge.part)
            edge.open = max(edge.open, at)
            if at >= len(path):
                return
            edge = edge.kids.get(path[at])

    def turns(self, before: bytes, words: dict[bytes, int]):
        """Aligned nodes, children before parents: ``(name, depth, count, least, words, open, n_children, n_leaves,
        saved, parent)`` with the parent's ``(name, least, open)``. Other trees may change open nodes, so they sum up only what lies
        below their children that are not open."""
        root = _Mark(before, 0, 0, self.top, None)
        marks = [root]
        todo = [(kid, hashlib.blake2b(before, digest_size=WIDTH), b"", 0, root) for _, kid in self.top.kids.items()]
        while todo:
            edge, state, tail, depth, above = todo.pop()
            state, tail = state.copy(), tail + edge.part
            while len(tail) >= WIDTH:
                turn, tail = tail[:WIDTH], tail[WIDTH:]
                state.update(turn)
                depth += 1
                above = _Mark(state.digest(), depth, words[turn], edge, above)
                marks.append(above)
            todo += [(kid, state, tail, depth, above) for _, kid in edge.kids.items()]
        for m in reversed(marks):  # every node comes after its parent in ``marks``
            if not m.open:
                m.leaves += not m.children
                m.saved += (m.count - 1) * m.words
            if m.above is not None and not m.open:
                m.above.children += 1
                m.above.leaves += m.leaves
                m.above.saved += m.saved
        return marks


class _Mark:
    """A turn-aligned node."""

    __slots__ = ("name", "depth", "words", "count", "least", "open", "above", "children", "leaves", "saved")

    def __init__(self, name: bytes, depth: int, words: int, edge: Edge, above: _Mark | None):
        self.name, self.depth, self.words, self.above = name, depth, words, above
        self.count, self.least, self.open = edge.count, edge.least, depth * WIDTH <= edge.open
        self.children = self.leaves = self.saved = 0


def common(part: bytes, path: bytes, at: int) -> int:
    """Bytes that ``part`` and the rest of ``path`` share."""
    other = path[at : at + len(part)]
    if part == other:
        return len(part)
    low = next((i for i, (a, b) in enumerate(zip(part, other)) if a != b), None)
    return min(len(part), len(other)) if low is None else low


def heads_of(conv: int) -> int:
    return zlib.crc32(str(conv).encode()) % HEADS


def name_after(before: bytes, path: bytes) -> bytes:
    """Digest of a prefix: what stands before the segment, and the segment up to there."""
    return hashlib.blake2b(before + path, digest_size=WIDTH).digest() if path else before


_SEGMENTS = "conv long, before binary, start long, path binary, words array<int>, more boolean, ended binary"


def _segments(size: int):
    """Paths of rebuilt conversations from turns in order, cut after ``size`` turns."""

    def gather(batches):
        conv, own, skip, before, start = None, False, 0, _ROOT, 0
        path, words, out = [], [], []

        def close(upto: int, more: bool) -> None:
            nonlocal before, start, path, words
            whole = b"".join(path[:upto])
            after = name_after(before, whole)
            out.append((conv, before, start, whole, words[:upto], more, None if more else after))
            before, start, path, words = after, start + upto, path[upto:], words[upto:]

        def shorten(last: bool) -> None:
            while len(words) > size:
                close(size, True)
            if last:
                close(len(words), False)

        for batch in batches:
            for key, mine, turn, n in zip(*(batch.column(c).to_pylist() for c in ("conv", "own", "id", "n_words"))):
                if key != conv:
                    if own:  # without own turns there is no such conversation
                        shorten(True)
                    conv, own, skip, before, start, path, words = key, False, heads_of(key), _ROOT, 0, [], []
                if mine:
                    own = True
                    if skip:
                        skip -= 1
                        continue
                path.append(turn)
                words.append(n)
                if own:
                    shorten(False)
            yield _batch(out)
            out.clear()
        if own:
            shorten(True)
            yield _batch(out)

    return gather


def _batch(rows) -> pa.RecordBatch:
    kinds = pa.int64(), pa.binary(), pa.int64(), pa.binary(), pa.list_(pa.int32()), pa.bool_(), pa.binary()
    columns = list(zip(*rows)) or [[]] * len(kinds)
    names = "conv", "before", "start", "path", "words", "more", "ended"
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], list(names))


_NODES = (
    "name binary, parent binary, depth long, n long, least long, words long, open boolean, children long, leaves long, "
    "saved long, parent_least long, parent_open boolean"
)


def _trees(run: int):
    """Aligned nodes of the trees of runs of sorted segments."""

    def build(batches):
        rows, turns = [], 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("before", "start", "path", "words", "more", "conv"))):
                rows.append(row)
                turns += len(row[3]) + 1
                if turns >= run:
                    yield from nodes_of(rows)
                    rows, turns = [], 0
        if rows:
            yield from nodes_of(rows)

    return build


def nodes_of(rows):
    """Nodes of one run. Segments after the first hang below the digest of what precedes them; their upper end is a
    node of another tree as well, and so is all that lies on the first and last path and on paths that go on."""
    groups: dict[tuple[bytes, int], list] = {}
    for before, start, path, words, more, conv in rows:
        groups.setdefault((before, start), []).append((path, words, more, conv))
    edge_keys = {(rows[0][0], rows[0][1]): rows[0][2]}, {(rows[-1][0], rows[-1][1]): rows[-1][2]}
    out = []
    for (before, start), own in groups.items():
        tree, words = RadixTree(), {}
        for path, counts, _, conv in own:
            tree.add(path, conv)
            words.update((path[i * WIDTH : (i + 1) * WIDTH], n) for i, n in enumerate(counts))
        tree.open_path(b"")
        for path, _, more, _ in own:
            if more:
                tree.open_path(path)
        for edges in edge_keys:
            if (before, start) in edges:
                tree.open_path(edges[before, start])
        for m in tree.turns(before, words):
            # the upper end of a later segment is counted where the segment before it ends
            n, said = (0, 0) if start and not m.depth else (m.count, m.words)
            up = m.above
            out.append(
                (m.name, up and up.name, start + m.depth, n, m.least, said, m.open, m.children, m.leaves, m.saved)
                + ((up.least, up.open) if up else (None, None))
            )
    for first in range(0, len(out), 65_536):
        names = [c.split()[0] for c in _NODES.split(", ")]
        kinds = [pa.binary(), pa.binary(), *[pa.int64()] * 4, pa.bool_(), *[pa.int64()] * 4, pa.bool_()]
        columns = zip(*out[first : first + 65_536])
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def _joined_ids(batches):
    """sha256 of the ids that come in order under one name, joined by commas."""
    current, state = None, None
    for batch in batches:
        names, sums = [], []
        for name, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if name != current:
                if current is not None:
                    names.append(current)
                    sums.append(state.hexdigest())
                current, state = name, hashlib.sha256(str(conv).encode())
            else:
                state.update(f",{conv}".encode())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(sums, pa.string())], ["name", "ends"])
    if current is not None:
        yield pa.RecordBatch.from_arrays([pa.array([current]), pa.array([state.hexdigest()])], ["name", "ends"])


def word_count(text: Column) -> Column:
    """Runs of bytes other than white space."""
    spaced = F.regexp_replace(text, r"[^\x20\x09-\x0D]+", "w")
    return F.length(F.regexp_replace(spaced, r"[\x20\x09-\x0D]+", ""))


def subtree_sums(nodes: DataFrame, values: list[str]) -> DataFrame:
    """``(name, values)`` of ``nodes (name, parent, values)`` summed over each node's subtree, by doubling: after
    round r a node has the sums of the 2^r levels from it down and knows its ancestor 2^r above."""
    state = settle(nodes.select("name", F.col("parent").alias("up"), *values))
    while state.where("up is not null").limit(1).count():
        below = state.where("up is not null").groupBy("up").agg(*[F.sum(v).alias(f"_{v}") for v in values])
        more = [(F.col(v) + F.coalesce(F.col(f"_{v}"), F.lit(0))).alias(v) for v in values]
        summed = state.join(below.withColumnRenamed("up", "name"), "name", "left").select("name", "up", *more)
        higher = state.select(F.col("name").alias("up"), F.col("up").alias("_next"))
        state = settle(lookup_join(summed, higher, "up", "left", by=["name"]).select("name", F.col("_next").alias("up"), *values))
    return state.select("name", *values)


def prefix_trie(
    df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    segment: int = SEGMENT, run: int = RUN,
) -> DataFrame:
    """Nodes ``(name, parent, conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)``
    of the trie of all rebuilt conversations: the first h turns of conversation ``c - c % 20``, then the own turns after
    the first h, where h is crc32 of the id modulo 4.

    Turns go by ``turn`` (null first), then role, then digest of the text. A turn's id is 16 bytes of its role and
    text. The paths are sorted over all partitions and each run of neighbours with ``run`` turns becomes adaptive radix
    trees, so memory is bounded by the run. Nodes that only one tree can hold are complete there; those on the first and last
    path of a tree are joined by name, and their subtree sums follow by doubling. Paths of more than ``segment`` turns
    are cut, and the later part hangs below the digest of what precedes it.

    Rows without an id belong to no conversation. Null roles and texts are empty, repeated turns stay, other columns
    are not read, an empty table has no node.
    """
    none = F.lit("")
    said = [F.coalesce(F.col(f"`{c}`").cast("string"), none) for c in (role, text)]
    key = F.concat(F.length(said[0]).cast("string"), F.lit(":"), *said)
    turns = df.where(F.col(f"`{conv}`").isNotNull()).select(
        F.col(f"`{conv}`").cast("bigint").alias("conv"),
        F.col(f"`{turn}`").alias("turn"),
        said[0].alias("role"),
        F.unhex(F.md5(key.cast("binary"))).alias("id"),
        word_count(said[1]).alias("n_words"),
    )
    turns = settle(turns)
    order = [F.col("turn").asc_nulls_first(), "role", "id"]
    heads = turns.where(F.col("conv") % FAMILY == 0).withColumn("at", F.row_number().over(Window.partitionBy("conv").orderBy(*order)))
    offsets = F.explode(F.sequence(F.lit(1 - FAMILY), F.lit(FAMILY - 1)))
    heads = heads.where(F.col("at") < HEADS).select("conv", "at", "id", "n_words", offsets.alias("offset"))
    to = F.col("conv") + F.col("offset")
    heads = heads.withColumn("to", to).where((to - to % FAMILY == F.col("conv")) & (F.crc32(to.cast("string").cast("binary")) % HEADS >= F.col("at")))
    heads = heads.select(F.col("to").alias("conv"), F.lit(False).alias("own"), F.col("at").cast("bigint").alias("turn"), none.alias("role"), "id", "n_words")
    rebuilt = heads.unionByName(turns.select("conv", F.lit(True).alias("own"), F.col("turn").cast("bigint").alias("turn"), "role", "id", "n_words"))
    ordered = rebuilt.repartition("conv").sortWithinPartitions("conv", "own", *order)
    paths = settle(ordered.select("conv", "own", "id", "n_words").mapInArrow(_segments(segment), _SEGMENTS))

    ended = paths.where("not more").select("ended", "conv").repartition("ended").sortWithinPartitions("ended", "conv")
    ends = ended.mapInArrow(_joined_ids, "name binary, ends string")
    ranged = paths.orderBy("start", "before", "path", "conv")
    nodes = settle(ranged.select("before", "start", "path", "words", "more", "conv").mapInArrow(_trees(run), _NODES))

    closed, open_ = nodes.where("not open"), nodes.where("open")
    merged = open_.groupBy("name").agg(
        F.max("parent").alias("parent"), F.min("depth").alias("depth"), F.sum("n").alias("n"), F.min("least").alias("least"),
        F.max("words").alias("words"), *[F.sum(c).alias(c) for c in ("children", "leaves", "saved")],
    )
    merged = settle(merged)
    kids = merged.where("parent is not null").groupBy("parent").agg(F.count(F.lit(1)).alias("kids"))
    merged = merged.join(kids.withColumnRenamed("parent", "name"), "name", "left")
    merged = merged.withColumn("children", F.col("children") + F.coalesce("kids", F.lit(0)))
    merged = merged.withColumn("saved", F.col("saved") + (F.col("n") - 1) * F.col("words"))
    merged = settle(merged.withColumn("leaves", F.col("leaves") + (F.col("children") == 0).cast("long")))
    sums = subtree_sums(merged.select("name", "parent", "leaves", "saved"), ["leaves", "saved"])
    tops = settle(merged.drop("leaves", "saved", "words", "kids").join(sums, "name"))
    names = tops.select(F.col("name").alias("parent"), F.col("least").alias("_above"))
    below = lookup_join(closed.where("parent_open"), names, "parent", "left", by=["name"])
    columns = "name", "parent", "depth", "n", "least", "children", "leaves", "saved"
    whole = (
        closed.where("not parent_open").select(*columns, F.col("parent_least").alias("above"))
        .unionByName(below.select(*columns, F.col("_above").alias("above")))
        .unionByName(lookup_join(tops, names, "parent", "left", by=["name"]).select(*columns, F.col("_above").alias("above")))
    )
    return whole.join(ends, "name", "left").select(
        "name",
        "parent",
        F.col("least").alias("conv_id"),
        "depth",
        F.col("above").alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


