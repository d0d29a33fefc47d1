"""SQL that repeats the clustering fits round by round, from the same first rows to the same stop."""

from __future__ import annotations

from collections.abc import Sequence

from ..operators.lloyd import SAMPLE

ROUNDS = 40


def draw_sql(seed: int, turn: int) -> str:
    return f"1 - ('0x' || substr(md5('{seed}:{turn}:' || id), 1, 12))::BIGINT / 281474976710656.0::DOUBLE"


def kmeans_sql(
    points: str, ks: Sequence[int], seed: int, cosine: bool = False, tolerance: float = 1e-4, rounds: int = ROUNDS, name: str = "f"
) -> str:
    """Common table expressions over ``points (id, pos, x)`` with all positions; by cosine, the rows have length one.

    They end with ``{name}_costs (t, k, cost)`` and ``{name}_rounds (t, k, id, label)`` of every round.
    """
    n = name
    parts = [
        f"{n}_u AS MATERIALIZED ({points})",
        f"""{n}_cand AS MATERIALIZED (SELECT id, md5('{seed}:0:' || id) AS h FROM (SELECT DISTINCT id FROM {n}_u)
            ORDER BY h, id LIMIT {SAMPLE})""",
        f"{n}_cu AS MATERIALIZED (SELECT u.* FROM {n}_u u JOIN {n}_cand USING (id))",
        f"{n}_s0 AS MATERIALIZED (SELECT 0 AS r, id FROM {n}_cand ORDER BY h, id LIMIT 1)",
    ]
    far = "SELECT a.id, CASE WHEN a.id = any_value(b.id) THEN 0 ELSE sum((a.x - b.x) * (a.x - b.x)) END AS d FROM {n}_cu a JOIN (SELECT c.* FROM {n}_cu c JOIN {n}_s{r} USING (id)) b USING (pos) GROUP BY a.id"
    parts.append(f"{n}_n0 AS MATERIALIZED ({far.format(n=n, r=0)})")
    for r in range(1, max(ks)):
        parts.append(
            f"""{n}_s{r} AS MATERIALIZED (SELECT {r} AS r, id FROM {n}_n{r - 1} WHERE d > 1e-15
                ORDER BY -ln({draw_sql(seed, r)}) / d, id LIMIT 1)"""
        )
        parts.append(
            f"{n}_n{r} AS MATERIALIZED (SELECT id, least(o.d, f.d) AS d FROM {n}_n{r - 1} o JOIN ({far.format(n=n, r=r)}) f USING (id))"
        )
    seeds = " UNION ALL ".join(f"SELECT * FROM {n}_s{r}" for r in range(max(ks)))
    parts.append(
        f"""{n}_c0 AS MATERIALIZED (SELECT k, r AS c, pos, x FROM ({seeds}) JOIN {n}_cu USING (id),
            (SELECT unnest({list(ks)}) AS k) WHERE r < k)"""
    )
    value = "avg(x)"
    for t in range(1, rounds + 1):
        parts.append(
            f"""{n}_l{t} AS MATERIALIZED (SELECT k, id, arg_min(c, d) AS label, min(d) AS d FROM (
                SELECT k, c, u.id, sum((u.x - m.x) * (u.x - m.x)) AS d FROM {n}_u u JOIN {n}_c{t - 1} m USING (pos)
                GROUP BY ALL) GROUP BY k, id)"""
        )
        means = f"SELECT k, label AS c, pos, {value} AS x FROM {n}_u JOIN {n}_l{t} USING (id) GROUP BY ALL"
        if cosine:
            means = f"SELECT k, c, pos, x / sqrt(sum(x * x) OVER (PARTITION BY k, c)) AS x FROM ({means})"
        parts.append(f"{n}_c{t} AS MATERIALIZED ({means})")
    half = " / 2" if cosine else ""
    every = " UNION ALL ".join(f"SELECT {t} AS t, k, id, label, d FROM {n}_l{t}" for t in range(1, rounds + 1))
    parts.append(f"{n}_rounds AS MATERIALIZED ({every})")
    parts.append(
        f"""{n}_costs AS MATERIALIZED (SELECT t, k, cost, cost < lag(cost) OVER (PARTITION BY k ORDER BY t) * (1 - {tolerance}) AS falls
            FROM (SELECT t, k, sum(d){half} AS cost FROM {n}_rounds GROUP BY t, k))"""
    )
    return ",\n".join(parts)


def stop_sql(name: str = "f", where: str = "true") -> str:
    """The round after which no model falls any more."""
    return f"(SELECT min(t) FROM (SELECT t FROM {name}_costs WHERE t > 1 AND {where} GROUP BY t HAVING NOT bool_or(falls)))"


def mixture_sql(points: str, start: str, rounds: int, least: float = 1e-6, name: str = "g") -> str:
    """Expectation-maximisation with diagonal covariances from ``start (id, label)``; ends with ``{name}_e (id, label)``."""
    n = name
    parts = [
        f"{n}_u AS MATERIALIZED ({points})",
        f"{n}_r0 AS MATERIALIZED (SELECT id, label AS j, 1.0::DOUBLE AS r FROM ({start}))",
    ]
    for t in range(rounds + 1):
        parts.append(
            f"""{n}_p{t} AS MATERIALIZED (SELECT j, pos, sum(r * x) / sum(r) AS mu,
                greatest(sum(r * x * x) / sum(r) - (sum(r * x) / sum(r)) * (sum(r * x) / sum(r)), 0) + {least} AS v, sum(r) AS size
                FROM {n}_u JOIN {n}_r{t} USING (id) GROUP BY j, pos)"""
        )
        parts.append(
            f"""{n}_d{t} AS MATERIALIZED (SELECT id, j, ln(any_value(size) / (SELECT count(DISTINCT id) FROM {n}_u))
                - sum(ln(2 * pi() * v) + (x - mu) * (x - mu) / v) / 2 AS s FROM {n}_u JOIN {n}_p{t} USING (pos) GROUP BY id, j)"""
        )
        parts.append(
            f"""{n}_r{t + 1} AS MATERIALIZED (SELECT id, j, exp(s - m) / sum(exp(s - m)) OVER (PARTITION BY id) AS r
                FROM (SELECT *, max(s) OVER (PARTITION BY id) AS m FROM {n}_d{t}))"""
        )
    parts.append(f"{n}_e AS (SELECT id, arg_max(j, s) AS label FROM {n}_d{rounds} GROUP BY id)")
    return ",\n".join(parts)
