"""MinHash near-duplicates by an LSH forest: sorted signature orders, prefix neighbours, exact confirmation.

Texts with the same set of shingles become one class first, so copies cost one row. Every tree of the forest is a
sorted order of the classes by its own run of minimum hashes. Neighbours in an order that share a prefix are
candidates; the depth that is asked for grows where a region is crowded. Candidates are confirmed on the full sets
in two passes: near neighbours of a few trees join most of each group, and then all trees look for links between
classes that are still apart. Classes of crowded regions also go through the exact join of ``crowds``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.spread import lookup_join
from ..session import settle
from .crowds import crowded_pairs
from .flat import SPACE_WORDS, U64, Hasher, bounds, mix, slices, text_buffer, whole_rows, windows, words
from .linked import components, star_of

TREES, DEPTH, LEAST_DEPTH = 20, 8, 4
#: Trees whose neighbours are confirmed first.
FIRST_TREES = 3
#: A region of at most so many classes is compared pair by pair; a larger one goes deeper and to ``crowded_pairs``.
REGION = 48
_KEY = 1 + 2 * DEPTH

FEATURES = (
    T.StructType()
    .add("_key", T.LongType())
    .add("ident", T.LongType())
    .add("n_shingles", T.LongType())
    .add("node", T.LongType())
    .add("signature", T.BinaryType())
)
_ROWS = T.StructType().add("order", T.BinaryType()).add("node", T.LongType()).add("n", T.LongType()).add("label", T.LongType())
_PAIRS = T.StructType().add("a", T.LongType()).add("b", T.LongType())
_SETS = T.StructType().add("node", T.LongType()).add("shingles", T.BinaryType())
_LISTS = T.StructType().add("node", T.LongType()).add("shingles", T.ArrayType(T.LongType()))


def shingle_sets(texts: pa.Array, size: int, hasher: Hasher) -> tuple[np.ndarray, np.ndarray]:
    """Ascending distinct shingle fingerprints of all texts in one array, and the n + 1 bounds.

    A shingle is ``size`` consecutive words in lower case (A-Z); a text with fewer words is one shingle as a
    whole; one without words has none.
    """
    data, offsets = text_buffer(texts)
    n = len(offsets) - 1
    starts, ends, owner = words(data, offsets, SPACE_WORDS)
    hashes = hasher.ranges(hasher.prefixes(data), starts, ends)
    first, prints = windows(hashes, owner, size)
    at = bounds(owner[first], n)
    word_at = bounds(owner, n)
    sets = []
    for i in range(n):
        own = prints[at[i] : at[i + 1]]
        if len(own):
            own = np.sort(own)
            own = own[np.append(True, own[1:] != own[:-1])]
        elif word_at[i + 1] > word_at[i]:
            few = hashes[word_at[i] : word_at[i + 1]]
            total = np.array([len(few)], U64)
            for h in few:
                total = mix(total * U64(3) + h)
            own = total
        sets.append(own)
    sizes = np.fromiter(map(len, sets), np.int64, n)
    flat = np.concatenate(sets) if sets else np.zeros(0, U64)
    return flat, np.concatenate([[0], np.cumsum(sizes)])


def set_prints(flat: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One 64-bit fingerprint a set: equal sets have the same."""
    sums = np.zeros(len(flat) + 1, U64)
    np.cumsum(mix(flat + U64(77)), out=sums[1:])
    sizes = np.diff(ends).astype(U64)
    return mix((sums[ends[1:]] - sums[ends[:-1]]) ^ (sizes * U64(0x9E3779B97F4A7C15))).view(np.int64)


def signatures(flat: np.ndarray, ends: np.ndarray, count: int = TREES * DEPTH) -> np.ndarray:
    """16 bits of each of ``count`` minimum hashes, a row a set; zeros for an empty set."""
    out = np.zeros((len(ends) - 1, count), np.uint16)
    full = np.flatnonzero(np.diff(ends) > 0)
    if not len(full):
        return out
    starts = ends[full]
    base = (flat >> U64(32)).astype(np.uint32)
    rng = np.random.default_rng(20)
    factors = (rng.integers(0, 2**31, count, np.uint32) * np.uint32(2)) | np.uint32(1)
    shifts = rng.integers(0, 2**32, count, np.uint32)
    for k in range(count):
        least = np.minimum.reduceat(base * factors[k] + shifts[k], starts)
        out[full, k] = ((least * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.uint16)
    return out


def _ident(key: str, text: str) -> Column:
    """Fingerprint of a row's key, which may be null, and text."""
    return F.xxhash64(F.col(key).isNull(), F.col(key).cast("bigint"), F.col(text).isNull(), F.col(text))


def features(docs: DataFrame, key: str, text: str, shingle: int) -> DataFrame:
    def make(batches):
        hasher = Hasher(5, fold=True)
        for batch in batches:
            for part in slices(batch, "_text"):
                flat, ends = shingle_sets(part.column("_text"), shingle, hasher)
                raw = np.ascontiguousarray(signatures(flat, ends).astype(">u2"))
                signature = [row.tobytes() for row in raw]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("_key"),
                        part.column("ident"),
                        pa.array(np.diff(ends), pa.int64()),
                        pa.array(set_prints(flat, ends), pa.int64()),
                        pa.array(signature, pa.binary()),
                    ],
                    FEATURES.names,
                )

    named = docs.select(F.col(key).cast("bigint").alias("_key"), _ident(key, text).alias("ident"), F.col(text).alias("_text"))
    return named.mapInArrow(make, FEATURES)


def _forest(classes: DataFrame, trees: int) -> DataFrame:
    """A row a tree and class: tree number and signature run as one sortable key."""

    def plant(batches):
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            data, _ = text_buffer(batch.column("signature"))
            runs = data.reshape(n, TREES, 2 * DEPTH)
            for t in range(trees):
                keys = np.empty((n, _KEY), np.uint8)
                keys[:, 0] = t
                keys[:, 1:] = runs[:, t]
                at = np.arange(n + 1, dtype=np.int32) * _KEY
                order = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(at), pa.py_buffer(keys.tobytes())])
                yield pa.RecordBatch.from_arrays(
                    [order, batch.column("node"), batch.column("n"), batch.column("label")], _ROWS.names
                )

    rows = classes.select("signature", "node", "n", "label").mapInArrow(plant, _ROWS)
    return rows.repartitionByRange("order", "node").sortWithinPartitions("order", "node")


def _loaded(batches) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
    """A sorted partition as arrays: prefix shared with the row before, node, size, label."""
    rows = [b for b in batches if b.num_rows]
    if not rows:
        return None
    table = pa.Table.from_batches(rows).combine_chunks()
    data, _ = text_buffer(table.column("order"))
    keys = data.reshape(table.num_rows, _KEY)
    shared = np.zeros(len(keys), np.int64)
    same = keys[1:] == keys[:-1]
    runs = same[:, 1::2] & same[:, 2::2]
    shared[1:] = np.cumprod(runs, axis=1).sum(axis=1) * same[:, 0]
    return shared, *(table.column(c).to_numpy() for c in ("node", "n", "label"))


def _pair_batches(a: np.ndarray, b: np.ndarray, node: np.ndarray, n: np.ndarray, percent: int):
    """Those pairs of rows whose sizes allow the similarity, smaller node first."""
    small, large = np.minimum(n[a], n[b]), np.maximum(n[a], n[b])
    fits = 100 * small >= percent * large
    low, high = np.minimum(node[a], node[b])[fits], np.maximum(node[a], node[b])[fits]
    for first in range(0, len(low), 65_536):
        yield pa.RecordBatch.from_arrays(
            [pa.array(low[first : first + 65_536]), pa.array(high[first : first + 65_536])], _PAIRS.names
        )


def near_neighbours(classes: DataFrame, percent: int, trees: int = FIRST_TREES) -> DataFrame:
    """Pairs next to each other in an order, and of each with the first node of its region."""

    def look(batches):
        loaded = _loaded(batches)
        if loaded is None:
            return
        shared, node, n, _ = loaded
        next_to = np.flatnonzero(shared >= LEAST_DEPTH)
        yield from _pair_batches(next_to - 1, next_to, node, n, percent)
        starts = np.flatnonzero(shared < LEAST_DEPTH)
        ends = np.append(starts[1:], len(node))
        leader = np.repeat(star_of(node, starts), ends - starts)
        others = np.flatnonzero(leader != np.arange(len(node)))
        yield from _pair_batches(leader[others], others, node, n, percent)

    return _forest(classes, trees).mapInArrow(look, _PAIRS).distinct()


def forest_candidates(classes: DataFrame, percent: int, trees: int = TREES) -> DataFrame:
    """Pairs of different label that share a region of some tree at the depth its crowding asks for.

    A class in a region of more than ``REGION`` that is not of one label, or in one that the partition's border may
    cut, is also returned as a pair with itself: what such regions hold beyond these pairs is for ``crowded_pairs``.
    """

    def look(batches):
        loaded = _loaded(batches)
        if loaded is None:
            return
        shared, node, n, label = loaded
        crowded = np.zeros(len(node), np.bool_)
        starts = np.flatnonzero(shared < LEAST_DEPTH)
        crowded[: starts[1] if len(starts) > 1 else len(node)] = True
        crowded[starts[-1] :] = True
        todo = [(LEAST_DEPTH, 0, len(node))]
        while todo:
            depth, low, high = todo.pop()
            starts = np.flatnonzero(shared[low:high] < depth) + low
            if not len(starts) or starts[0] != low:
                starts = np.insert(starts, 0, low)
            sizes = np.diff(np.append(starts, high))
            for first, size in zip(starts[sizes > 1].tolist(), sizes[sizes > 1].tolist()):
                last = first + size
                if size <= REGION:
                    a, b = np.triu_indices(size, 1)
                    a, b = a + first, b + first
                    apart = label[a] != label[b]
                    if apart.any():
                        yield from _pair_batches(a[apart], b[apart], node, n, percent)
                elif (label[first:last] != label[first]).any():
                    crowded[first:last] = True
                    if depth < DEPTH:
                        todo.append((depth + 1, first, last))
        alone = np.flatnonzero(crowded)
        yield from _pair_batches(alone, alone, node, n, percent)

    return _forest(classes, trees).mapInArrow(look, _PAIRS).distinct()


def _sets(nodes: DataFrame, classes: DataFrame, docs: DataFrame, key: str, text: str, shingle: int, schema: T.StructType) -> DataFrame:
    """Shingle sets of the given nodes, from one text of each: as bytes or as an array, whichever ``schema`` names."""
    wanted = lookup_join(classes.select("node", F.col("rep").alias("ident")), nodes, "node", "left_semi")
    wanted = settle(wanted.select("ident").distinct())
    texts = lookup_join(docs.select(_ident(key, text).alias("ident"), F.col(text).alias("_text")), wanted, "ident", "left_semi")
    listed = isinstance(schema["shingles"].dataType, T.ArrayType)

    def make(batches):
        hasher = Hasher(5, fold=True)
        for batch in batches:
            for part in slices(batch, "_text"):
                flat, ends = shingle_sets(part.column("_text"), shingle, hasher)
                if listed:
                    sets = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.view(np.int64)))
                else:
                    raw = flat.tobytes()
                    sets = pa.array([raw[8 * a : 8 * b] for a, b in zip(ends.tolist(), ends[1:].tolist())], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(set_prints(flat, ends)), sets], _SETS.names)

    return texts.mapInArrow(make, schema).groupBy("node").agg(F.first("shingles").alias("shingles"))


def confirm(pairs: DataFrame, classes: DataFrame, docs: DataFrame, key: str, text: str, shingle: int, percent: int) -> DataFrame:
    """Those pairs of nodes whose full sets are similar: 100 * |intersection| >= percent * |union|."""
    pairs = settle(pairs)
    nodes = settle(pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct())
    sets = _sets(nodes, classes, docs, key, text, shingle, _SETS)
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("one"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("other"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "one", "other")

    def check(batches):
        for batch in batches:
            one, other = batch.column("one"), batch.column("other")
            similar = []
            for x, y in zip(one, other):
                x, y = np.frombuffer(x.as_buffer(), U64), np.frombuffer(y.as_buffer(), U64)
                both = np.sort(np.concatenate([x, y]))
                common = int(np.count_nonzero(both[1:] == both[:-1]))
                similar.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(similar, pa.bool_()))

    return joined.mapInArrow(check, _PAIRS)


def _grouped(docs: DataFrame, key: str, text: str, shingle: int, percent: int) -> DataFrame:
    """Per row of ``docs``: key, ``ident``, ``n_shingles``, and where it has shingles the ``label`` of its group with
    the smallest key of the group, null if all are."""
    rows = settle(features(docs, key, text, shingle))
    classes = rows.where("n_shingles > 0").groupBy("node").agg(
        F.min("_key").alias("least"),
        F.min("ident").alias("rep"),
        F.max("n_shingles").alias("n"),
        F.first("signature").alias("signature"),
    )
    classes = settle(classes.withColumn("label", F.col("node")))
    near = near_neighbours(classes, percent)
    first = settle(confirm(near, classes, docs, key, text, shingle, percent))
    joined = components(first)
    labelled = lookup_join(classes.drop("label"), joined.select(F.col("v").alias("node"), F.col("r").alias("label")), "node", "left")
    labelled = settle(labelled.withColumn("label", F.coalesce("label", "node")))
    seen = settle(forest_candidates(labelled, percent))
    crowd = settle(seen.where("a = b").select(F.col("a").alias("node")))
    units = _sets(crowd, classes, docs, key, text, shingle, _LISTS).withColumnRenamed("shingles", "tokens")
    units = units.join(labelled.select("node", "label", "n"), "node")
    pairs = seen.where("a < b").union(crowded_pairs(units, percent)).distinct()
    far = confirm(pairs, classes, docs, key, text, shingle, percent)
    groups = components(joined.union(far.select(F.col("a").alias("v"), F.col("b").alias("r"))))
    members = groups.select(F.col("v").alias("node"), F.col("r").alias("label"))
    placed = lookup_join(classes.select("node", "least"), members, "node", "left")
    placed = settle(placed.withColumn("label", F.coalesce("label", "node")))
    least = placed.groupBy("label").agg(F.min("least").alias("component"))
    # Classes with a group: all others stand for themselves.
    of_node = settle(lookup_join(placed, settle(least), "label").select("node", "label", "component"))
    return lookup_join(rows.select("_key", "ident", "n_shingles", "node"), of_node, "node", "left")


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 5, percent: int = 80
) -> DataFrame:
    """Per row of ``docs``: the key as ``_key``, ``n_shingles`` and ``component``, the smallest key reachable.

    Texts are linked when the sets of their ``shingle``-word runs have a Jaccard similarity of ``percent`` or more,
    counted exactly on the full sets; whether a pair is looked at is a matter of chance: two texts that are just
    similar enough share four minimum hashes in none of the 20 trees in less than 1 case of 30,000. Those that share
    a crowded region are compared by an exact join (``crowds``). A very long text is held with its set in one task.
    A null or empty text or one without words is linked with nothing; repeated rows and ties share a component; a
    null key never becomes the smallest; an empty table gives no rows; other columns are not read.
    """
    found = _grouped(docs, key, text, shingle, percent)
    return found.select("_key", "n_shingles", F.coalesce("component", "_key").alias("component"))


def keep_first(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 5, percent: int = 80) -> DataFrame:
    """Exactly one row of each group of near-duplicates, columns as they are: that with the smallest key (a null key
    is larger than any), of several texts under that key the one with the smallest fingerprint, of copies any one.
    Other texts under the same key are judged by their own group. Rows without words stay."""
    found = _grouped(docs, key, text, shingle, percent).where("n_shingles > 0")
    idents = settle(found.groupBy("ident", "label").agg(F.first("_key").alias("_key"), F.count(F.lit(1)).alias("n")))
    order = F.struct(F.col("_key").isNull().alias("none"), F.col("_key").alias("key"), F.col("ident").alias("ident"))
    least = idents.groupBy("label").agg(F.min(order)["ident"].alias("first"), F.sum("n").alias("rows")).where("rows > 1")
    verdict = lookup_join(idents, settle(least), "label").withColumn("_gone", F.col("ident") != F.col("first"))
    verdict = settle(verdict.where("_gone OR n > 1").select("ident", "_gone"))
    rows = whole_rows(docs)
    rows = rows.withColumn("ident", _ident(f"_row.{key}", f"_row.{text}"))
    judged = lookup_join(rows, verdict, "ident", "left")
    kept = judged.where("_gone IS NULL").select("_row.*")
    copies = verdict.where("NOT _gone")
    if copies.isEmpty():
        return kept
    one = lookup_join(rows, copies, "ident").groupBy("ident").agg(F.first("_row").alias("_row"))
    return kept.unionByName(one.select("_row.*"))
