"""Near-duplicate vectors by spherical-cap filters: product codes, list decoding, verification in shared filters."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.spread import lookup_join
from ..session import settle
from .linked import components

#: Filter directions in the cap of a vector, blocks of the product code, vectors a filter should hold.
LIST, BLOCKS, FILL = 16, 2, 64
#: Share of pairs at the threshold that may be missed, measured on random pairs before the join.
MISSED = 0.004
#: Rows that meet in one task: larger regions are cut into blocks of this size, which meet block by block.
REGION = 4096
#: Rows of a product of vectors that are held at once.
STRIP = 512

_ROUTED = "width int, region long, node long, copies long, vec array<double>, filters binary"
_FOUND = "node long, links long, root long"


def words_a_block(width: int, letters: int, blocks: int) -> int:
    """A block of one dimension has only two unit vectors."""
    return 2 if -(-width // blocks) == 1 else letters


def product_code(width: int, letters: int, blocks: int, seed: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Rotation of the padded space and, for each block, its random unit vectors."""
    rng = np.random.default_rng([seed, width, letters, blocks])
    block = -(-width // blocks)
    turn = np.linalg.qr(rng.normal(size=(block * blocks, block * blocks)))[0]
    books = []
    for _ in range(blocks):
        words = rng.normal(size=(letters, block))
        words /= np.linalg.norm(words, axis=1, keepdims=True)
        books.append(np.array([[-1.0], [1.0]]) if block == 1 else words)
    return turn[:width], books


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision and without overflow."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def decode(
    units: np.ndarray, letters: int, size: int = LIST, blocks: int = BLOCKS, seed: int = 0, code: tuple | None = None
) -> np.ndarray:
    """List decoding: the numbers of the ``size`` filter directions inside each vector's cap, ascending.

    A filter is one code word a block; its product with the vector is the sum of the blocks' products. Only the best
    ``size`` words of a block can take part in the best ``size`` sums, so the code is decoded block by block and never
    spelled out. ``code`` spares making it again.
    """
    turn, books = code or product_code(units.shape[1], letters, blocks, seed)
    turned = units @ turn
    width = turned.shape[1] // blocks
    rows = np.arange(len(units))[:, None]
    sums, numbers = np.zeros((len(units), 1)), np.zeros((len(units), 1), np.int64)
    for b, book in enumerate(books):
        near = turned[:, b * width : (b + 1) * width] @ book.T
        best = np.argsort(-near, axis=1, kind="stable")[:, :size]
        sums = (sums[:, :, None] + near[rows, best][:, None, :]).reshape(len(units), -1)
        numbers = (numbers[:, :, None] * len(book) + best[:, None, :]).reshape(len(units), -1)
        keep = np.argsort(-sums, axis=1, kind="stable")[:, :size]
        sums, numbers = sums[rows, keep], numbers[rows, keep]
    return np.sort(numbers, axis=1)


def letters_for(vectors: int, size: int = LIST, blocks: int = BLOCKS, fill: int = FILL) -> int:
    """Words a block that give filters of about ``fill`` vectors."""
    return max(4, math.ceil((vectors * size / fill) ** (1 / blocks)))


def missed(width: int, letters: int, size: int, cosine: float, blocks: int = BLOCKS, seed: int = 0) -> float:
    """Share of 500 random pairs at exactly ``cosine`` that have no filter in common."""
    rng = np.random.default_rng([seed, width])
    first, away = unit(rng.normal(size=(500, width))), rng.normal(size=(500, width))
    away -= (away * first).sum(axis=1, keepdims=True) * first
    second = cosine * first + math.sqrt(max(0.0, 1 - cosine**2)) * (unit(away) if width > 1 else 0)
    a, b = (decode(unit(v), letters, size, blocks, seed) for v in (first, second))
    return float(np.mean([not np.intersect1d(x, y).size for x, y in zip(a, b)]))


def plan_for(width: int, vectors: int, cosine: float, size: int, blocks: int, fill: int, seed: int) -> tuple[int, int]:
    """Words a block and filters a vector for this width: as many words as fill the filters with ``fill`` vectors, longer
    lists or fewer words where more than ``MISSED`` of the pairs at the threshold would be lost."""
    letters = letters_for(vectors, size, blocks, fill)
    while letters > 4:
        for longer in (size, 2 * size, 4 * size):
            if missed(width, letters, longer, cosine, blocks, seed) <= MISSED:
                return letters, longer
        letters //= 2
    return 4, 4 * size


def _router(plans: dict[int, tuple[int, int, int]], blocks: int, seed: int):
    """Each vector once for every region that holds one of its filters; ``plans`` has letters, list and parts by width."""

    def route(batches):
        codes: dict[int, tuple] = {}
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                some = batch.slice(first, 256)
                vectors = some.column("vec")
                widths = vectors.value_lengths().to_numpy()
                for width in np.unique(widths):
                    own = some.filter(pa.array(widths == width))
                    column = own.column("vec")
                    values = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
                    letters, size, parts = plans[int(width)]
                    if width not in codes:
                        codes[width] = product_code(int(width), letters, blocks, seed)
                    filters = decode(unit(values), letters, size, blocks, seed, codes[width])
                    regions = region_of(filters, int(width), letters, parts, blocks)
                    fresh = np.ones(regions.shape, bool)
                    order = np.argsort(regions, axis=1, kind="stable")
                    ranked = np.take_along_axis(regions, order, 1)
                    fresh[:, 1:] = ranked[:, 1:] != ranked[:, :-1]
                    at, place = np.nonzero(fresh)
                    pick = pa.array(at)
                    lists = pa.array([row.tobytes() for row in filters], pa.binary())
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(at), width), pa.int32()),
                            pa.array(ranked[at, place], pa.int64()),
                            own.column("node").take(pick),
                            own.column("copies").take(pick),
                            column.take(pick),
                            lists.take(pick),
                        ],
                        ["width", "region", "node", "copies", "vec", "filters"],
                    )

    return route


def region_of(filters: np.ndarray, width: int, letters: int, parts: int, blocks: int) -> np.ndarray:
    """Filters that share the first code word (and the remainder of the rest) lie in one region."""
    rest = words_a_block(width, letters, blocks) ** (blocks - 1)
    return filters // rest * parts + filters % rest % parts


def _meeting(least: float, plans: dict[int, tuple[int, int, int]], blocks: int):
    """Links among the rows of one region, or between two blocks of it: their number for each row and the smallest
    row it is linked with there. A pair counts in the first filter that both have, so once in all."""

    def meet(key, table):
        width, region, low, high = (k.as_py() for k in key)
        letters, _, parts = plans[width]
        table = table.sort_by("node")
        nodes = table.column("node").to_numpy()
        copies = table.column("copies").to_numpy()
        sides = table.column("block").to_numpy()
        vectors = table.column("vec").combine_chunks()
        units = unit(vectors.flatten().to_numpy(zero_copy_only=False).reshape(-1, width))
        filters = np.stack([np.frombuffer(f, np.int64) for f in table.column("filters").to_pylist()])
        here = region_of(filters, width, letters, parts, blocks) == region
        row, place = np.nonzero(here)
        own = filters[row, place]
        order = np.argsort(own, kind="stable")
        row, own = row[order], own[order]
        starts = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        links = np.zeros(len(nodes), np.int64)
        label = np.arange(len(nodes))
        for first, end in zip(starts, np.append(starts[1:], len(own))):
            members = row[first:end]
            if end - first > 1 and (low == high or len(np.unique(sides[members])) > 1):
                _links_of_filter(
                    own[first], members, units, filters, sides if low != high else None, least, copies, links, label
                )
        linked = np.flatnonzero(links)
        return pa.table({"node": nodes[linked], "links": links[linked], "root": nodes[label[linked]]})

    return meet


def _links_of_filter(number, members, units, filters, sides, least, copies, links, label) -> None:
    """Add the links among ``members`` of one filter to ``links`` and join their ``label``."""
    inside = units[members]
    for first in range(0, len(members), STRIP):
        hit = inside[first : first + STRIP] @ inside[first:].T >= least
        hit &= np.arange(hit.shape[1]) > np.arange(hit.shape[0])[:, None]
        left, right = members[first : first + STRIP], members[first:]
        if sides is not None:
            hit &= sides[left][:, None] != sides[right]
        if not hit.any():
            continue
        at, to = np.flatnonzero(hit.any(axis=1)), np.flatnonzero(hit.any(axis=0))
        hit, left, right = hit[np.ix_(at, to)], left[at], right[to]
        hit &= ~_share_earlier(filters[left], filters[right], number)
        links[left] += hit @ copies[right]
        links[right] += copies[left] @ hit
        while True:  # smaller labels cross the links until none changes; equal labels move together
            shown = np.where(hit, label[right], len(label)).min(axis=1, initial=len(label))
            rows = np.minimum(label[left], shown)
            columns = np.minimum(label[right], np.where(hit, rows[:, None], len(label)).min(axis=0, initial=len(label)))
            if (rows == label[left]).all() and (columns == label[right]).all():
                break
            above = np.arange(len(label))
            np.minimum.at(above, label[left], rows)
            np.minimum.at(above, label[right], columns)
            while (above[above] != above).any():
                above = above[above]
            label[:] = above[label]


def _share_earlier(left: np.ndarray, right: np.ndarray, number: int) -> np.ndarray:
    """Whether two rows share a filter before ``number``: product of their membership matrices, some columns at a time."""
    known = np.intersect1d(left[left < number], right[right < number])
    shared = np.zeros((len(left), len(right)), bool)
    for first in range(0, len(known), 2048):
        some = known[first : first + 2048]
        shared |= _membership(left, some) @ _membership(right, some).T > 0
    return shared


def _membership(lists: np.ndarray, columns: np.ndarray) -> np.ndarray:
    place = np.minimum(np.searchsorted(columns, lists), len(columns) - 1)
    found = columns[place] == lists
    matrix = np.zeros((len(lists), len(columns)), np.float32)
    matrix[np.nonzero(found)[0], place[found]] = 1
    return matrix


def usable(vec: Column) -> Column:
    """Not null, not empty, all components finite, not all zero."""
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vec, lambda x: x != 0), F.lit(False))


def similar_vectors(
    df: DataFrame,
    key: str = "vec_id",
    vec: str = "embedding",
    cosine: float = 0.95,
    size: int = LIST,
    blocks: int = BLOCKS,
    fill: int = FILL,
    region: int = REGION,
    seed: int = 0,
) -> DataFrame:
    """``(_key, n_links, component)`` for each row of ``df``: the number of other rows whose vector has a cosine of at
    least ``cosine`` to its own, and the smallest key that links reach.

    Equal vectors are one class with a number of copies. A class goes to the regions of the filters in its cap; within
    a region, rows are compared filter by filter in double precision, and only numbers and one link a row leave the
    task. The cap of a vector is as high as leaves ``size`` filters in it: a height common to all leaves a tenth of
    all vectors without any filter. The number of filters follows the number of classes, so a filter holds about
    ``fill`` of them at any size; regions of more than ``region`` rows are dealt out in pairs of blocks, and nothing
    is left out. At most 0.4 % of random pairs at exactly the threshold have no filter in common, which is measured for
    the width and the number of vectors before the join; closer pairs are lost less often.

    Vectors that are null, empty, zero or hold a null or non-finite component have no link; nor have vectors of
    different widths. Rows with a repeated or null key count as rows of their own; a component without any key has a
    null ``component``. An empty table gives an empty result; other columns are not read.
    """
    values = F.transform(F.col(f"`{vec}`"), lambda x: x.cast("double") + 0.0)
    rows = df.select(F.col(f"`{key}`").alias("_key"), values.alias("vec"))
    rows = rows.withColumn("_good", usable(F.col("vec")))
    digest = F.concat_ws(":", F.xxhash64(F.lit(0), "vec"), F.xxhash64(F.lit(1), "vec"))
    rows = rows.withColumn("_class", F.when(F.col("_good"), digest))
    grouped = rows.where("_good").groupBy("_class").agg(
        F.min("_key").alias("least"), F.count(F.lit(1)).alias("copies"), F.first("vec").alias("vec")
    )
    classes = settle(grouped.withColumn("node", F.monotonically_increasing_id()))
    plans = {}
    for width, n in classes.groupBy(F.size("vec")).count().collect():  # a row a width
        letters, longer = plan_for(width, n, cosine, size, blocks, fill, seed)
        plans[width] = letters, longer, max(1, math.ceil(n * longer / letters / (region // 2)))
    vectors = classes.select("node", "copies", "vec")
    routed = vectors.mapInArrow(_router(plans, blocks, seed), _ROUTED)
    crowds = routed.groupBy("width", "region").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > region)
    crowds = settle(
        crowds.select(
            F.concat_ws(":", "width", "region").alias("_region"), F.ceil(F.col("n") / region).cast("int").alias("cuts")
        )
    )
    placed = lookup_join(routed.withColumn("_region", F.concat_ws(":", "width", "region")), crowds, "_region", "left", by=["node"])
    cuts = F.coalesce("cuts", F.lit(1))
    placed = placed.withColumn("block", F.pmod(F.xxhash64("node"), cuts).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), cuts - 1)))
    placed = placed.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))
    pairs = placed.select("width", "region", "low", "high", "block", "node", "copies", "vec", "filters")
    meet = _meeting(cosine, plans, blocks)
    found = settle(pairs.groupBy("width", "region", "low", "high").applyInArrow(meet, _FOUND))
    stars = components(found.select("node", "root"))
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    named = classes.select("_class", "node", "least", "copies").join(counts, "node", "left")
    named = named.join(stars.select(F.col("v").alias("node"), "r"), "node", "left").withColumn("r", F.coalesce("r", "node"))
    named = settle(named)
    firsts = named.groupBy("r").agg(F.min("least").alias("component"))
    linked = named.join(firsts, "r").select(
        "_class", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component"
    )
    out = lookup_join(rows.select("_key", "_class"), settle(linked), "_class", "left", by=["_key"])
    return out.select(
        "_key",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.when(F.col("_class").isNull(), F.col("_key")).otherwise(F.col("component")).alias("component"),
    )

