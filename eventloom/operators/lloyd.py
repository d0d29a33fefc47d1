"""K-means and Gaussian mixtures over long cells ``(ident, position, x)``; all models of a sweep share each round.

A round is one aggregate by row (products of its cells with all centres) and one by position (sums of the cells by the
rows' labels). Centres are a table with a row a position, so neither rows nor centres are ever dense vectors, and the
driver holds a few numbers a centre. Every row has a constant cell at position ``CONSTANT``, which carries what a
product has besides the cells: the length of a centre, the mean that is taken off every row, the weight of a component.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import settle
from .spread import BROADCAST_BYTES, spread_join

CONSTANT = -1
# Rows from which the first centres are drawn, cells that are worth a task, and cells of a full task.
SAMPLE, LEAST_CELLS, FULL_CELLS = 256, 60_000, 1_000_000
# Sums of the same numbers in another order differ by less than this share.
NOISE = 1e-13


@dataclass
class Models:
    """One model for each k, side by side. ``labels`` is (ident, one array place a k) and ``costs`` the cost of each;
    ``centres`` has a row a position with the values of all centres, the models after each other."""

    ks: list[int]
    labels: DataFrame
    costs: list[float]
    centres: DataFrame
    rounds: int


class Cells:
    """Prepared cells ``(ident, position, a, m, w)``: a row is ``w * (a - m)`` over all positions."""

    def __init__(self, stored: DataFrame, ident: str, mean_square: float, arrays: DataFrame | None = None, single: bool = False):
        """``arrays`` has the same rows as ``(ident, w, at, a)``, where they came that way; ``single`` if no id comes twice there."""
        self.stored, self.ident, self.mean_square, self.values = stored, ident, mean_square, 1
        self.arrays, self.single = arrays, single
        square = F.when(F.col("position") >= 0, F.col("a") * F.col("a"))
        facts = stored.agg(F.count(F.lit(1)), F.countDistinct("position"), F.sum(square)).first()
        self.size, self.width, self.square = facts[0], facts[1], facts[2] or 0.0
        most = stored.sparkSession.sparkContext.defaultParallelism
        self.parts = max(min(most, self.size // LEAST_CELLS + 1), self.size // FULL_CELLS + 1)
        self.kept: dict[str, DataFrame] = {}

    @property
    def rows(self) -> DataFrame:
        """All cells, those of a row in one partition. Kept in memory while models are fitted; lost parts come from the
        stored table."""
        if "rows" not in self.kept:
            self.kept["rows"] = self.stored.repartition(self.parts, self.ident).persist(StorageLevel.MEMORY_AND_DISK)
        return self.kept["rows"]

    @property
    def lists(self) -> DataFrame:
        """``(ident, w, at, a)``: the cells of a row as two arrays. Rows that came as arrays are dealt as such."""
        if "lists" not in self.kept:
            if self.arrays is None:
                rows = self.stored.repartition(self.parts, self.ident).groupBy(self.ident)
                cell = F.when(F.col("position") >= 0, F.struct(F.col("position").alias("at"), "a"))
                rows = rows.agg(F.max("w").alias("w"), F.collect_list(cell).alias("c"))
                rows = rows.select(self.ident, "w", F.col("c.at").alias("at"), F.col("c.a").alias("a"))
            elif self.single:
                rows = self.arrays.repartition(self.parts, self.ident)
            else:
                rows = self.arrays.repartition(self.parts, self.ident).groupBy(self.ident)
                rows = rows.agg(F.max("w").alias("w"), F.collect_list(F.struct("at", "a")).alias("c"))
                rows = rows.select(self.ident, "w", F.flatten("c.at").alias("at"), F.flatten("c.a").alias("a"))
            self.kept["lists"] = rows.persist(StorageLevel.MEMORY_AND_DISK)
        return self.kept["lists"]

    def close(self) -> None:
        for kept in self.kept.values():
            kept.unpersist()

    def round(self, centres: DataFrame, sums: str, state: str, out: str) -> DataFrame:
        """``(position, m, s)``: ``out`` summed by position beside what ``state`` makes of each row's ``sums``. One plan:
        cells with the values of their position, an aggregate by row, which needs no shuffle where the centres can be
        broadcast, and the labels of a row back at its cells."""
        text, named = self._states(centres, sums, state)
        return self.rows.sparkSession.sql(
            f"""SELECT /*+ SHUFFLE_HASH(l) */ position, max(m) AS m, array({out}) AS s
                FROM {{cells}} c LEFT JOIN ({text}) l ON c.`{self.ident}` = l.ident GROUP BY position""",
            cells=self.rows, **named,
        )

    def states(self, centres: DataFrame, sums: str, state: str) -> DataFrame:
        """``(ident, state)`` of each row from its cells' ``sums`` with the centres' values ``v``."""
        text, named = self._states(centres, sums, state)
        return self.rows.sparkSession.sql(text, **named, **({"cells": self.rows} if self.small else {}))

    def _states(self, centres: DataFrame, sums: str, state: str) -> tuple[str, dict[str, DataFrame]]:
        if self.small:
            near, named = f"SELECT /*+ BROADCAST(v) */ n.*, v FROM {{cells}} n JOIN {{centres}} v ON n.position = v.position", {"centres": centres}
        else:
            near, named = "SELECT * FROM {near}", {"near": spread_join(self.rows, centres, "position", by=[self.ident])}
        return f"SELECT ident, {state} FROM (SELECT `{self.ident}` AS ident, max(w) AS w, {sums} FROM ({near}) GROUP BY 1)", named

    @property
    def small(self) -> bool:
        """Whether a row a position may be broadcast, and be read by the driver."""
        return self.width * self.values * 8 <= BROADCAST_BYTES

    def by_label(self, labels: DataFrame, out: str) -> DataFrame:
        """``out`` summed by position beside given labels ``(ident, ...)``."""
        return self.rows.sparkSession.sql(
            f"""SELECT position, max(m) AS m, array({out}) AS s
                FROM {{cells}} c LEFT JOIN {{labels}} l ON c.`{self.ident}` = l.ident GROUP BY position""",
            cells=self.rows, labels=labels,
        )


def plain_cells(rows: DataFrame, cells: DataFrame, ident: str) -> Cells:
    """Rows as they are; ``rows`` has every row, those without cells too."""
    constant = rows.select(ident, F.lit(CONSTANT).cast("bigint").alias("position"), F.lit(1.0).alias("a"))
    given = cells.select(ident, F.col("position").cast("bigint").alias("position"), F.col("x").alias("a")).where("a <> 0")
    both = given.unionByName(constant)
    return Cells(settle(both.select("*", F.lit(0.0).alias("m"), F.lit(1.0).alias("w"))), ident, 0.0)


def array_cells(rows: DataFrame, ident: str) -> Cells:
    """Rows ``(ident, at, x)`` as they are: each keeps its cells as two arrays, the single cells are seen when they are read."""
    arrays = settle(rows.select(ident, F.lit(1.0).alias("w"), F.col("at").cast("array<bigint>").alias("at"), F.col("x").alias("a")))
    constant = F.array(F.struct(F.lit(CONSTANT).cast("bigint").alias("at"), F.lit(1.0).alias("a")))
    cells = arrays.select(ident, F.explode(F.concat(constant, F.arrays_zip("at", "a"))).alias("_c"))
    cells = cells.select(ident, F.col("_c.at").alias("position"), F.col("_c.a").alias("a"), F.lit(0.0).alias("m"), F.lit(1.0).alias("w"))
    return Cells(cells, ident, 0.0, arrays)


def standard_cells(rows: DataFrame, cells: DataFrame, ident: str, with_mean: bool = True) -> Cells:
    """Rows standardised by position and divided by their length, without making them dense: the cells are scaled, and the
    means stand beside them. Rows of length zero have weight zero, constant positions no cell."""
    cells = cells.select(ident, F.col("position").cast("bigint").alias("position"), "x").where("x <> 0")
    n = rows.count()
    facts = cells.groupBy("position").agg(F.avg("x").alias("mean"), F.var_pop("x").alias("var"), F.count(F.lit(1)).alias("n"))
    among = F.col("n") / F.lit(float(max(n, 1)))  # share of the rows that have a cell; the others are zero
    spread = F.col("n") * F.col("var") + F.col("mean") * F.col("mean") * F.col("n") * (1 - among)
    deviation = F.sqrt(spread / F.lit(float(max(n - 1, 1))))
    m = F.col("mean") * among / F.col("sd") if with_mean else F.lit(0.0)
    level = facts.select("position", "mean", "n", deviation.alias("sd")).where(F.col("sd") > 1e-12 * F.abs("mean"))
    level = settle(level.select("position", "sd", m.alias("m")))
    whole, width = level.agg(F.sum(F.col("m") * F.col("m")), F.count(F.lit(1))).first()
    whole = whole or 0.0
    if width * 48 <= BROADCAST_BYTES:
        scaled = cells.join(F.broadcast(level), "position")
    else:
        scaled = spread_join(cells, level, "position", by=[ident])
    scaled = scaled.select(ident, "position", (F.col("x") / F.col("sd")).alias("a"), "m")
    constant = rows.select(ident, F.lit(CONSTANT).cast("bigint").alias("position"), F.lit(1.0).alias("a"), F.lit(0.0).alias("m"))
    square = F.when(F.col("position") >= 0, F.col("a") * F.col("a")).otherwise(0.0)
    # one shuffle brings the cells of a row together; what follows reads them as arrays
    gathered = scaled.unionByName(constant).where(F.col(ident).isNotNull()).groupBy(ident).agg(
        F.sum(square - 2 * F.col("a") * F.col("m")).alias("q"), F.sum(square).alias("b"),
        F.collect_list(F.struct("position", "a", "m")).alias("c"),
    )
    length = F.col("q") + F.lit(whole)
    weight = F.when(length > 1e-12 * (F.col("b") + F.lit(whole)), 1 / F.sqrt(length)).otherwise(0.0)
    gathered = settle(gathered.select(ident, weight.alias("w"), "c"))
    own = F.filter("c", lambda c: c["position"] >= 0)
    arrays = gathered.select(ident, "w", own.alias("c")).select(ident, "w", F.col("c.position").alias("at"), F.col("c.a").alias("a"))
    stored = gathered.select(ident, "w", F.explode("c").alias("c")).select(ident, "c.position", "c.a", "c.m", "w")
    return Cells(stored, ident, whole, arrays, single=True)


def draw(seed: int, turn: int, ident: object) -> float:
    """Number in (0, 1] that follows from seed, turn and row."""
    return 1 - int(hashlib.md5(f"{seed}:{turn}:{ident}".encode()).hexdigest()[:12], 16) / 2**48


def first_centres(cells: Cells, most: int, seed: int, sample: int = SAMPLE) -> list:
    """Rows that k-means++ picks one after the other, so the first k of them start the model of k. It picks among the
    ``sample`` rows of the smallest digest; every row takes part in the rounds that follow."""
    ident = cells.ident
    rows = cells.stored.where((F.col("position") == CONSTANT) & (F.col("w") > 0)).select(ident, "w")
    order = F.md5(F.concat(F.lit(f"{seed}:0:"), F.col(ident).cast("string")))
    chosen = [tuple(r) for r in rows.orderBy(order, ident).limit(sample).collect()]
    if not chosen:
        return []
    place = {r[0]: i for i, r in enumerate(chosen)}
    own = cells.stored.where(F.col(ident).isin(list(place)) & (F.col("position") >= 0)).select(ident, "position", "a", "m").toPandas()
    row = own[ident].map(place).to_numpy(int)
    at, a, m = own["position"].to_numpy(int), own["a"].to_numpy(float), own["m"].to_numpy(float)
    weights = np.array([r[1] for r in chosen])
    shift = np.bincount(row, a * m, len(chosen))
    square = np.bincount(row, a * a, len(chosen)) - 2 * shift + cells.mean_square
    picked = [0]
    near = np.full(len(chosen), np.inf)
    while len(picked) < most:
        last = picked[-1]
        mine = np.flatnonzero(row == last)
        mine = mine[np.argsort(at[mine])]
        product = np.zeros(len(chosen))
        if len(mine):
            hit = np.minimum(np.searchsorted(at[mine], at), len(mine) - 1)
            same = at[mine][hit] == at
            product = np.bincount(row[same], a[same] * a[mine][hit[same]], len(chosen))
        product = product - shift - shift[last] + cells.mean_square
        far = weights**2 * square + weights[last] ** 2 * square[last] - 2 * weights * weights[last] * product
        near = np.minimum(near, np.maximum(far, 0))
        near[last] = 0
        if not (near > 1e-15).any():
            break
        turn = len(picked)
        keys = [
            (-math.log(draw(seed, turn, r[0])) / d, r[0]) if d > 1e-15 else (math.inf, r[0]) for r, d in zip(chosen, near)
        ]
        picked.append(place[min(keys)[1]])
    return [chosen[i][0] for i in picked]


def scales(
    weight: np.ndarray, square: np.ndarray, product: np.ndarray, mean_square: float, cosine: bool
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weight, factor and constant of each centre: its value at a position is ``factor * (sum - m * weight)``, and the
    constant makes the largest product the nearest centre. Empty clusters never have it."""
    length = square - 2 * weight * product + weight**2 * mean_square
    alive = weight > 0
    with np.errstate(all="ignore"):
        factor = 1 / np.sqrt(np.maximum(length, 1e-300)) if cosine else 1 / weight
    factor = np.where(alive, factor, 0.0)
    constant = -factor * (product - weight * mean_square)
    if not cosine:
        constant = constant - factor**2 * length / 2
    return weight, factor, np.where(alive, constant, -1e300)


def _kmeans_in_tasks(cells: Cells, ks: list[int], seeds: list, cosine: bool, tolerance: float, most: int) -> Models:
    """Rounds for centres of a bounded size: each task takes the products of its sparse rows with all centres and adds up
    its rows by label; the sums meet in one aggregate by position and centre."""
    spark, total = cells.stored.sparkSession, sum(ks)
    means = cells.stored.where("position >= 0").groupBy("position").agg(F.max("m").alias("m")).orderBy("position").toArrow()
    positions, m = (means.column(c).to_numpy() for c in ("position", "m"))
    first = cells.stored.where(F.col(cells.ident).isin(seeds)).select(cells.ident, "position", F.col("w") * F.col("a"))
    place = {s: i for i, s in enumerate(seeds)}
    sums, weight = np.zeros((len(positions), total)), np.zeros(total)
    starts = np.cumsum([0, *ks[:-1]])
    for row, position, value in first.collect():
        columns = [at + place[row] for at, k in zip(starts, ks) if place[row] < k]
        if position == CONSTANT:
            weight[columns] += value
        else:
            sums[np.searchsorted(positions, position), columns] += value
    before, rounds, shared = np.full(len(ks), np.inf), 0, None
    while True:
        own_weight, factor, constant = scales(weight, (sums * sums).sum(0), m @ sums, cells.mean_square, cosine)
        centres = (sums - np.outer(m, own_weight)) * factor
        if shared is not None:
            shared.unpersist()
        shared = spark.sparkContext.broadcast((positions, centres, constant, starts))
        added = cells.lists.mapInArrow(_adder(shared), "position long, centre int, s double")
        added = added.groupBy("position", "centre").agg(F.sum("s").alias("s")).toArrow()
        at, centre, value = (added.column(c).to_numpy() for c in ("position", "centre", "s"))
        sums, weight = np.zeros_like(sums), np.zeros(total + len(ks) + 1)
        inner = at >= 0
        sums[np.searchsorted(positions, at[inner]), centre[inner]] = value[inner]
        weight[centre[~inner]] = value[~inner]
        weight, best, count = weight[:total], weight[total:-1], weight[-1]
        costs, rounds = count - best if cosine else np.maximum(cells.square - 2 * best, 0.0), rounds + 1
        if rounds >= most or not (costs < before * (1 - max(tolerance, NOISE))).any():
            break
        before = costs
    kind = cells.stored.schema[cells.ident].dataType.simpleString()
    labels = settle(cells.lists.mapInArrow(_labeller(shared), f"`{cells.ident}` {kind}, labels array<int>"))
    table = pa.table(
        {"position": np.append(positions, CONSTANT), "v": pa.array([*centres, constant], pa.list_(pa.float64()))}
    )
    return Models(ks, labels, [float(c) for c in costs], spark.createDataFrame(table), rounds)


def _scored(batch: pa.RecordBatch, positions: np.ndarray, centres: np.ndarray, constant: np.ndarray, starts: np.ndarray):
    """``(rows, common, block, others, scores, labels)`` of some rows of the batch at a time: at most two million products. What
    the rows have at the positions ``common`` stands in ``block``, ``others`` are the rest of their cells (see ``_parted``)."""
    lengths = batch.column("at").value_lengths().fill_null(0).to_numpy()
    at = batch.column("at").flatten().to_numpy()
    values = batch.column("a").flatten().to_numpy()
    dense = len(positions) and positions[-1] == len(positions) - 1
    at = at if dense else np.searchsorted(positions, at)
    ends = np.cumsum(lengths)
    most = max(1, 2_000_000 // centres.shape[1])
    first = 0
    while first < len(lengths):
        base = ends[first] - lengths[first]
        last = max(int(np.searchsorted(ends, base + most, "right")), first + 1)
        size = lengths[first:last]
        cells = slice(base, ends[last - 1])
        common, block, others = _parted(np.repeat(np.arange(last - first), size), at[cells], values[cells], last - first, len(positions))
        scores = block @ centres[common] + constant
        row, place, value = others
        if len(row):
            begins = np.flatnonzero(np.diff(row, prepend=-1))
            scores[row[begins]] += np.add.reduceat(centres[place] * value[:, None], begins, axis=0)
        bounds = [*starts, centres.shape[1]]
        labels = np.stack([scores[:, a:b].argmax(1) for a, b in zip(bounds, bounds[1:])], axis=1)
        yield slice(first, last), common, block, others, scores, labels
        first = last


def _parted(row: np.ndarray, at: np.ndarray, values: np.ndarray, n: int, width: int):
    """Cells at positions that at least a quarter of the ``n`` rows have as a matrix (so it is at most four times the cells), and
    all other cells as they are. Values that are not finite stay cells, so they meet no other row's sums."""
    count = np.bincount(at, minlength=width)
    often = (count * 4 >= n) & (count > 0) & np.isfinite(values).all()
    common = np.flatnonzero(often)
    inner = often[at]
    column = (np.cumsum(often) - 1)[at[inner]]
    block = np.bincount(row[inner] * len(common) + column, values[inner], n * len(common)).reshape(n, len(common))
    return common, block, (row[~inner], at[~inner], values[~inner])


def _adder(shared):
    """Sums of a task by position and centre; under ``CONSTANT`` the weights, the best products and the number of rows."""

    def add(batches):
        positions, centres, constant, starts = shared.value
        total = centres.shape[1]
        sums, last = np.zeros(centres.shape), np.zeros(total + len(starts) + 1)
        flat = sums.reshape(-1)
        for batch in batches:
            weights = batch.column("w").to_numpy()
            for rows, common, block, others, scores, labels in _scored(batch, positions, centres, constant, starts):
                w = weights[rows]
                chosen = labels + starts
                if len(common):
                    shares = np.zeros(scores.shape)
                    np.put_along_axis(shares, chosen, w[:, None], axis=1)
                    sums[common] += block.T @ shares
                row, at, values = others
                for i in range(len(starts)):
                    np.add.at(flat, at * total + chosen[row, i], w[row] * values)
                    np.add.at(last, chosen[:, i], w)
                    last[total + i] += w @ scores[np.arange(len(w)), chosen[:, i]]
                last[-1] += (w > 0).sum()
        touched = np.flatnonzero(flat)
        for part in range(0, len(touched), 1 << 20):
            some = touched[part : part + (1 << 20)]
            yield _triples(positions[some // total], some % total, flat[some])
        yield _triples(np.full(len(last), CONSTANT), np.arange(len(last)), last)

    return add


def _triples(at: np.ndarray, centre: np.ndarray, value: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array(at, pa.int64()), pa.array(centre, pa.int32()), pa.array(value, pa.float64())]
    return pa.RecordBatch.from_arrays(columns, ["position", "centre", "s"])


def _labeller(shared):
    def label(batches):
        positions, centres, constant, starts = shared.value
        for batch in batches:
            weights = batch.column("w").to_numpy()
            for rows, _, _, _, _, labels in _scored(batch, positions, centres, constant, starts):
                missing = np.broadcast_to((weights[rows] <= 0)[:, None], labels.shape)
                flat = pa.array(labels.ravel(), pa.int32(), mask=missing.ravel())
                lists = pa.ListArray.from_arrays(np.arange(len(labels) + 1, dtype=np.int32) * labels.shape[1], flat)
                ident = batch.column(0).slice(rows.start, rows.stop - rows.start)
                yield pa.RecordBatch.from_arrays([ident, lists], [batch.schema.names[0], "labels"])

    return label


def kmeans(
    cells: Cells,
    ks: Sequence[int],
    seed: int,
    cosine: bool = False,
    tolerance: float = 1e-4,
    most: int = 300,
) -> Models:
    """K-means for all ``ks`` at once, by squared distance or by cosine to the direction of the centre.

    Rounds go on until no model's cost falls by more than the share ``tolerance``, or ``most`` are made. A cluster that
    loses all its rows stays empty. Rows of weight zero (by cosine, those of length zero) keep a null label.
    """
    ident, spark, ks = cells.ident, cells.stored.sparkSession, list(ks)
    seeds = first_centres(cells, max(ks), seed)
    total, cells.values = sum(ks), sum(ks)
    if cells.small:
        return _kmeans_in_tasks(cells, ks, seeds, cosine, tolerance, most)
    spans = [range(sum(ks[:i]), sum(ks[: i + 1])) for i in range(len(ks))]
    kind = cells.stored.schema[ident].dataType.simpleString()
    names = [f"l{i} int, b{i} double" for i in range(len(ks))]
    start = [(s, *[v for k in ks for v in (j if j < k else None, 0.0)]) for j, s in enumerate(seeds)]
    labels = spark.createDataFrame(start, f"ident {kind}, {', '.join(names)}")
    sums = ", ".join(f"sum(a * v[{j}]) AS s{j}" for j in range(total))
    state = []
    for i, span in enumerate(spans):
        best = f"greatest({', '.join(f's{j}' for j in span)})" if len(span) > 1 else f"s{span[0]}"
        picks = " ".join(f"WHEN s{j} = {best} THEN {j - span[0]}" for j in span)
        state += [f"CASE WHEN w > 0 THEN CASE {picks} END END AS l{i}", f"{best} AS b{i}"]
    state = ", ".join(state)
    out = [f"coalesce(sum(CASE WHEN l{i} = {j} THEN w * a END), 0D)" for i, k in enumerate(ks) for j in range(k)]
    out += [f"coalesce(sum(CASE WHEN position = {CONSTANT} THEN w * b{i} END), 0D)" for i in range(len(ks))]
    out = ", ".join([*out, f"coalesce(sum(CASE WHEN position = {CONSTANT} AND w > 0 THEN 1D END), 0D)"])

    def settled(table: DataFrame):
        """The sums, written down; and the totals of each centre (weight, sum of squares, product with the means), the
        best products of each model, the rows."""
        table = settle(table)
        parts = [f"sum(CASE WHEN position < 0 THEN s[{j}] END)" for j in range(total)]
        parts += [f"sum(CASE WHEN position >= 0 THEN s[{j}] * s[{j}] END)" for j in range(total)]
        parts += [f"sum(CASE WHEN position >= 0 THEN s[{j}] * m END)" for j in range(total)]
        parts += [f"sum(CASE WHEN position < 0 THEN s[{j}] END)" for j in range(total, total + len(ks) + 1)]
        got = np.array([x or 0.0 for x in table.selectExpr(*parts).first()])
        return table, got[: 3 * total].reshape(3, total), got[3 * total : -1], got[-1]

    def centres_of(table, facts: np.ndarray) -> DataFrame:
        weight, factor, constant = scales(*facts, cells.mean_square, cosine)
        w, f, c = (f"array({', '.join(f'{x!r}D' for x in v.tolist())})" for v in (weight, factor, constant))
        inner = f"transform(slice(s, 1, {total}), (x, j) -> (x - m * get({w}, j)) * get({f}, j))"
        return table.selectExpr("position", f"CASE WHEN position < 0 THEN {c} ELSE {inner} END AS v")

    table, facts, _, _ = settled(cells.by_label(labels, out))
    before, rounds = np.full(len(ks), np.inf), 0
    while True:
        centres = centres_of(table, facts)
        table, facts, best, count = settled(cells.round(centres, sums, state, out))
        costs, rounds = count - best if cosine else np.maximum(cells.square - 2 * best, 0.0), rounds + 1
        if rounds >= most or not (costs < before * (1 - max(tolerance, NOISE))).any():
            break
        before = costs
    named = ", ".join(f"l{i}" for i in range(len(ks)))
    final = settle(cells.states(centres, sums, state).selectExpr(f"ident AS `{ident}`", f"array({named}) AS labels"))
    return Models(ks, final, [float(c) for c in costs], settle(centres), rounds)


@dataclass
class Mixture:
    """``labels`` (ident, label, log_likelihood of the row), ``likelihoods`` after each round, and ``parameters``
    (position, means, variances) with ``weights`` by component."""

    labels: DataFrame
    likelihoods: list[float]
    parameters: DataFrame
    weights: list[float]


def mixture(
    cells: Cells,
    start: DataFrame,
    k: int,
    rounds: int = 100,
    tolerance: float = 1e-3,
    least_variance: float = 1e-6,
) -> Mixture:
    """Gaussian mixture with diagonal covariances by expectation-maximisation, from the labels ``start (ident, label)``.

    Both steps are aggregates over the cells: positions without a cell are zeros, whose part of the density is one number
    a component. ``least_variance`` is added to every variance. Rounds end when the mean log-likelihood of a row gains
    less than ``tolerance``.
    """
    ident, spark = cells.ident, cells.stored.sparkSession
    cells.values = 2 * k
    shares = [f"CAST(label = {j} AS DOUBLE) AS r{j}" for j in range(k)]
    hard = start.selectExpr(f"`{ident}` AS ident", "label", "0D AS ll", *shares)
    out = [f"coalesce(sum(r{j} * {x}), 0D)" for x in ("a", "a * a") for j in range(k)]
    out = ", ".join([*out, f"coalesce(sum(CASE WHEN position = {CONSTANT} THEN ll END), 0D)"])
    inner = [f"a * v[{j}] + a * a * v[{k + j}]" for j in range(k)]
    sums = ", ".join(f"sum(CASE WHEN position = {CONSTANT} THEN v[{j}] ELSE {inner[j]} END) AS s{j}" for j in range(k))
    top = f"greatest({', '.join(f's{j}' for j in range(k))})" if k > 1 else "s0"
    whole = " + ".join(f"exp(s{j} - {top})" for j in range(k))
    picks = " ".join(f"WHEN s{j} = {top} THEN {j}" for j in range(k))
    state = [f"exp(s{j} - {top}) / ({whole}) AS r{j}" for j in range(k)]
    state = ", ".join([*state, f"CASE {picks} END AS label", f"{top} + ln({whole}) AS ll"])

    def parameters_of(table: DataFrame) -> tuple[DataFrame, np.ndarray, float]:
        last = np.array(table.where(F.col("position") == CONSTANT).first()["s"])
        with np.errstate(divide="ignore"):
            inverse = np.where(last[:k] > 0, 1 / last[:k], 0.0)
        inverse = f"array({', '.join(f'{x!r}D' for x in inverse.tolist())})"
        known = table.where("position >= 0").selectExpr(
            "position",
            f"transform(slice(s, 1, {k}), (x, j) -> x * get({inverse}, j)) AS means",
            f"transform(slice(s, {k + 1}, {k}), (x, j) -> x * get({inverse}, j)) AS q",
        )
        wide = f"zip_with(q, means, (x, m) -> greatest(x - m * m, 0D) + {least_variance!r}D) AS variances"
        return known.selectExpr("position", "means", wide), last[:k], last[2 * k]

    def factors(known: DataFrame, sizes: np.ndarray) -> DataFrame:
        base = [f"sum(ln(2 * pi() * variances[{j}]) + means[{j}] * means[{j}] / variances[{j}])" for j in range(k)]
        base = np.array([b or 0.0 for b in known.selectExpr(*base).first()])
        with np.errstate(divide="ignore"):
            constant = np.where(sizes > 0, np.log(sizes / sizes.sum()) - base / 2, -1e300)
        first = spark.createDataFrame([(CONSTANT, [*constant.tolist(), *[0.0] * k])], "position long, v array<double>")
        both = "concat(zip_with(means, variances, (m, x) -> m / x), transform(variances, x -> -0.5D / x)) AS v"
        return known.selectExpr("position", both).unionByName(first)

    known, sizes, _ = parameters_of(settle(cells.by_label(hard, out)))
    likelihoods: list[float] = []
    for _ in range(rounds):
        known, sizes, likelihood = parameters_of(settle(cells.round(factors(known, sizes), sums, state, out)))
        likelihoods.append(likelihood)
        if len(likelihoods) > 1 and likelihoods[-1] - likelihoods[-2] < tolerance * sizes.sum():
            break
    final = cells.states(factors(known, sizes), sums, state)
    final = settle(final.selectExpr(f"ident AS `{ident}`", "label", "ll AS log_likelihood"))
    likelihoods.append(final.agg(F.sum("log_likelihood")).first()[0] or 0.0)
    return Mixture(final, likelihoods, known, (sizes / max(sizes.sum(), 1.0)).tolist())
