"""Connected components of a large set of links, as Spark joins; nothing of the graph is on the driver."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import settle

_EDGES = T.StructType().add("v", T.LongType()).add("r", T.LongType())


def _contract(batches):
    """The links of one partition as stars: every vertex with the smallest one it reaches there."""
    above: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while (up := above.get(top, top)) != top:
            top = up
        while x != top:
            above[x], x = top, above.get(x, x)
        return top

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            x, y = root(a), root(b)
            if x != y:
                above[max(x, y)] = min(x, y)
    vertices = list(above)
    for first in range(0, len(vertices), 65_536):
        some = vertices[first : first + 65_536]
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int64()), pa.array([root(v) for v in some], pa.int64())], ["v", "r"]
        )


def _state(edges: DataFrame) -> tuple:
    """Count and order-free sum of the edges: equal only when a round has changed nothing."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("v", "r").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """Vertex ``v`` and the smallest vertex ``r`` of its component, for each vertex of ``links`` (two columns of
    integers) that is not the smallest itself.

    Each partition first reduces its links to stars; then rounds of large and small stars (every neighbour is
    linked to the smallest neighbour) join those, each round written to the shared folder, until a round changes
    nothing. That is the logarithm of the longest path, and the joins split hot vertices. Links to oneself and
    repeated links do no harm; without links the result is empty.
    """
    a, b = links.columns[:2]
    narrow = links.select(F.col(a).cast("bigint").alias("v"), F.col(b).cast("bigint").alias("r")).where("v <> r")
    edges = settle(narrow.mapInArrow(_contract, _EDGES).distinct())
    before = _state(edges)
    while before[0]:
        both = edges.union(edges.select(F.col("r").alias("v"), F.col("v").alias("r")))
        least = both.groupBy("v").agg(F.min("r").alias("m")).select("v", F.least("v", "m").alias("m"))
        large = both.join(least, "v").where("r > v").select(F.col("r").alias("v"), F.col("m").alias("r")).distinct()
        lower = large.groupBy("v").agg(F.min("r").alias("m"))
        small = large.join(lower, "v")
        small = small.where("r <> m").select(F.col("r").alias("v"), F.col("m").alias("r")).union(lower.select("v", "m"))
        edges = settle(small.where("v <> r").distinct())
        after = _state(edges)
        if after == before:
            break
        before = after
    return edges


def star_of(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Place of the smallest value in each run that begins at ``starts``."""
    ends = np.append(starts[1:], len(values))
    least = np.repeat(np.minimum.reduceat(values, starts), ends - starts)
    hits = np.flatnonzero(values == least)
    run = np.searchsorted(starts, hits, "right") - 1
    return hits[np.append(True, run[1:] != run[:-1])]
