"""Every link among classes that stand in crowded regions, without comparing all pairs: prefix filtering by levels.

The tokens of a class are ordered rare ones first. Two sets that are similar enough share one of their first
``size - need + 1`` tokens, so classes meet at the rare tokens among these, and a rare token has few classes by
definition. Classes with fewer rare tokens than that are nearly all common text. Two of them that meet at no rare
token share none, so only their common tokens matter: equal ones become one, and the next level orders those tokens
by the classes that are left. A level that leaves more than half of its tokens ends the descent, and the rest is
counted block against block inside tasks, which send links only.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.spread import lookup_join
from ..session import settle
from .flat import ragged

#: A token of more classes than this is common: so many meet at one token at most.
MOST = 48
#: Tokens a block of classes, on average.
BLOCK_TOKENS = 1 << 19

_PAIRS = T.StructType().add("a", T.LongType()).add("b", T.LongType())


def _ordered(a, b) -> list:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _level(units: DataFrame, percent: int, most: int) -> tuple[DataFrame, DataFrame]:
    """Pairs that meet at a rare token or have the same common tokens, and the classes to look at further."""
    tokens = units.select("node", F.explode("tokens").alias("w"))
    rare = settle(tokens.groupBy("w").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") <= most).select("w"))
    # only rare tokens travel: the common ones, which are most in a crowd of near copies, are what is left of a set
    told = lookup_join(tokens, rare, "w", "left_semi").groupBy("node").agg(F.sort_array(F.collect_list("w")).alias("rare"))
    split = units.join(told, "node", "left").withColumn("rare", F.coalesce("rare", F.array().cast("array<bigint>")))
    left = F.sort_array(F.array_except("tokens", "rare")).alias("tokens")
    parts = settle(split.select("node", "rare", left, "label", "n", "first"))

    posts = parts.select("node", "label", "n", F.explode(F.slice("rare", F.lit(1), F.col("first"))).alias("w"))
    met = posts.groupBy("w").agg(
        F.collect_list(F.struct("node", "label", "n")).alias("all"), F.min("label").alias("low"), F.max("label").alias("high")
    )
    met = met.where("low < high").select(F.explode("all").alias("x"), "all").select("x", F.explode("all").alias("y"))
    met = met.where("x.node < y.node AND x.label <> y.label")
    met = met.where(100 * F.least("x.n", "y.n") >= percent * F.greatest("x.n", "y.n"))
    met = met.select(*_ordered(F.col("x.node"), F.col("y.node"))).distinct()

    heavy = parts.where(F.size("rare") < F.col("first")).withColumn("part", F.xxhash64("tokens"))
    least = heavy.groupBy("part").agg(F.min(F.struct("n", "node", "label")).alias("z"))
    heavy = lookup_join(heavy, settle(least), "part").withColumn("size", F.size("tokens"))
    same = (F.col("node") != F.col("z.node")) & (100 * F.col("size") >= percent * (F.col("n") + F.col("z.n") - F.col("size")))
    heavy = settle(heavy.withColumn("same", same))
    equal = heavy.where("same AND label <> z.label").select(*_ordered(F.col("node"), F.col("z.node")))
    return settle(met.union(equal)), heavy.where("NOT same").select("node", "label", "n", "tokens")


def _counted(left: dict, right: dict, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each class on the left, one similar class on the right of every other label."""
    order = np.argsort(right["flat"], kind="stable")
    sorted_tokens = right["flat"][order]
    owner = np.repeat(np.arange(len(right["node"])), right["sizes"])[order]
    at = np.concatenate([[0], np.cumsum(left["sizes"])])
    low = np.searchsorted(sorted_tokens, left["flat"], "left")
    high = np.searchsorted(sorted_tokens, left["flat"], "right")
    a, b = [], []
    for i in range(len(left["node"])):
        mine = slice(at[i], at[i + 1])
        shared = np.bincount(owner[ragged(low[mine], high[mine] - low[mine])], minlength=len(right["node"]))
        similar = 100 * shared >= percent * (left["n"][i] + right["n"] - shared)
        hits = np.flatnonzero(similar & (right["label"] != left["label"][i]))
        hits = hits[np.unique(right["label"][hits], return_index=True)[1]]
        a.append(np.full(len(hits), left["node"][i]))
        b.append(right["node"][hits])
    return np.concatenate(a), np.concatenate(b)


def _blocks(units: DataFrame, percent: int, block_tokens: int) -> DataFrame:
    """Similar pairs of different label, classes of all labels but the most frequent one against all, in blocks."""
    labels = units.groupBy("label").agg(F.count(F.lit(1)).alias("k"))
    main = labels.agg(F.max(F.struct("k", "label"))["label"]).first()[0]
    others = F.col("label") != main
    sizes = units.agg(F.sum(F.size("tokens")), F.sum(F.when(others, F.size("tokens")))).first()
    rows, columns = (int(s or 0) // block_tokens + 1 for s in reversed(sizes))
    own = F.pmod(F.xxhash64("node", F.lit(3)), F.lit(columns))
    right = units.select(
        "*", F.lit(False).alias("left"), F.explode(F.transform(F.sequence(F.lit(0), F.lit(rows - 1)), lambda i: i * columns + own)).alias("cell")
    )
    own = F.pmod(F.xxhash64("node", F.lit(4)), F.lit(rows))
    left = units.where(others).select(
        "*", F.lit(True).alias("left"), F.explode(F.transform(F.sequence(F.lit(0), F.lit(columns - 1)), lambda j: own * columns + j)).alias("cell")
    )

    def compare(table: pa.Table) -> pa.Table:
        sides = []
        for flag in (True, False):
            part = table.filter(pc.equal(table.column("left"), flag)).combine_chunks()
            lists = part.column("tokens")
            side = {c: part.column(c).to_numpy() for c in ("node", "label", "n")}
            side["sizes"] = pc.list_value_length(lists).to_numpy().astype(np.int64)
            side["flat"] = pc.list_flatten(lists).to_numpy()
            sides.append(side)
        none = np.zeros(0, np.int64)
        a, b = _counted(*sides, percent) if all(len(s["node"]) for s in sides) else (none, none)
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return left.unionByName(right).groupBy("cell").applyInArrow(compare, _PAIRS)


def crowded_pairs(
    units: DataFrame, percent: int, most: int = MOST, block_tokens: int = BLOCK_TOKENS
) -> DataFrame:
    """Pairs ``a < b`` of nodes that join all classes which are linked but have different labels.

    ``units`` has a row a class: ``node``, ``label`` of what is joined already, size ``n`` of its set, and the set as
    ``tokens``. No link is missed: of each pair with 100 * |intersection| >= percent * |union|, either the pair is
    returned or both ends are joined by returned pairs and labels. What is returned need not be linked and is
    confirmed by the caller. Empty sets have no pairs; without units there are none.
    """
    need = F.floor((percent * F.col("n") + 99) / 100).cast("int")
    found = None
    while True:
        units = units.withColumn("first", F.size("tokens") - need + 1).where("first >= 1 AND size(tokens) > 0")
        units = settle(units)
        before = units.agg(F.sum(F.size("tokens"))).first()[0]
        if not before:
            break
        pairs, units = _level(units, percent, most)
        found = pairs if found is None else found.union(pairs)
        after = units.agg(F.sum(F.size("tokens"))).first()[0] or 0
        if 2 * after > before:
            found = found.union(_blocks(units, percent, block_tokens))
            break
    if found is None:
        return units.sparkSession.createDataFrame([], _PAIRS)
    return found.distinct()
