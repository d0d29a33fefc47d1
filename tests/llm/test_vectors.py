"""Similar vectors against brute force, odd rows, and functions that travel by value."""

import numpy as np
import pytest

from eventloom.llm import cap_filters

SCHEMA = "vec_id long, embedding array<double>, _key string, _class string, node string, links string, r string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, *["clash"] * 5) for r in rows], SCHEMA)


def brute_links(rows, cosine):
    """(id, links, component) of each row."""
    good = [i for i, (_, v) in enumerate(rows) if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links = {i: set() for i in range(len(rows))}
    for a in good:
        for b in good:
            if a != b and len(rows[a][1]) == len(rows[b][1]):
                x, y = (np.array(rows[i][1]) / np.abs(rows[i][1]).max() for i in (a, b))
                if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= cosine:
                    links[a].add(b)
    out = []
    for i, (key, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            fresh = links[todo.pop()] - seen
            seen |= fresh
            todo += fresh
        keys = [rows[j][0] for j in seen if rows[j][0] is not None]
        out.append((key, len(links[i]), min(keys) if keys else None))
    return sorted(out, key=repr)


def found(df, **kw):
    return sorted((tuple(r) for r in cap_filters.similar_vectors(df, **kw).collect()), key=repr)


def test_odd_rows(spark):
    big = [1e300, 1e300, 0.0]
    rows = [
        (5, [1.0, 0.0, 0.0]), (3, [2.0, 0.0, 0.0]), (3, [2.0, 0.0, 0.0]), (None, [1.0, 0.01, 0.0]), (1, None), (2, []), (4, [0.0, -0.0, 0.0]),
        (6, [float("nan"), 1.0, 0.0]), (7, [float("inf"), 1.0, 0.0]), (8, [None, 1.0, 0.0]), (9, big), (10, [1.0, 1.0, 0.0]), (11, [1.0]),
        (12, [5.0]), (13, [-5.0]), (14, [1.0, 0.0]), (15, [-0.0, 0.0, 1.0]), (16, [0.0, 0.0, 1e-320]), (None, [0.0, 1.0, 0.0]), (17, [1.0, 0.0, 0.0, 0.0]),
    ]
    assert found(frame(spark, rows)) == brute_links(rows, 0.95)
    assert found(frame(spark, [])) == []


@pytest.mark.parametrize("kw", [{}, {"region": 16, "fill": 8}, {"cosine": 0.8, "region": 40}])
def test_groups_chains_and_copies(spark, kw):
    """A dense group, chains whose ends are not linked, copies, and strangers."""
    rng, rows = np.random.default_rng(2), []
    unit = lambda v: v / np.linalg.norm(v)
    for g in range(6):
        centre = unit(rng.normal(size=16))
        for _ in range([80, 3, 2, 5, 9, 4][g]):
            rows.append((len(rows), unit(centre + rng.normal(size=16) * 0.02).tolist()))
    step, end = unit(rng.normal(size=16)), unit(rng.normal(size=16))
    rows += [(len(rows) + i, unit(step + 0.12 * i * end).tolist()) for i in range(12)]
    rows += [(len(rows) + i, rows[i % 3][1]) for i in range(20)]
    rows += [(len(rows) + i, rng.normal(size=16).tolist()) for i in range(100)]
    got, want = found(frame(spark, rows), **kw), brute_links(rows, kw.get("cosine", 0.95))
    if kw.get("cosine"):  # recall of pairs near a low threshold is high, not total, and nothing wrong is linked
        assert sum(n for _, n, _ in got) >= 0.98 * sum(n for _, n, _ in want)
    else:
        assert got == want


@pytest.mark.parametrize("width", [3, 64, 300])
def test_measured_recall(width):
    letters, size = cap_filters.plan_for(width, 50_000, 0.95, cap_filters.LIST, cap_filters.BLOCKS, cap_filters.FILL, 0)
    assert cap_filters.missed(width, letters, size, 0.95, seed=1) <= 0.02


def test_functions_hold_nothing_of_the_package():
    """What goes to the workers can be read where the package is not there."""
    import subprocess
    import sys

    import eventloom
    from eventloom.llm import turn_repair, turn_tries
    from eventloom.operators import lloyd
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(eventloom)
    made = [
        cap_filters._router({3: (4, 4, 1)}, 2, 0), cap_filters._meeting(0.9, {3: (4, 4, 1)}, 2), turn_repair._solver([("u", "a")]),
        turn_repair._pieces(3), turn_repair._apply, turn_tries._segments(3), turn_tries._trees(9), turn_tries._joined_ids,
        lloyd._adder(None), lloyd._labeller(None),
    ]
    code = "import sys, os; sys.path = [p for p in sys.path if p]; from pyspark import cloudpickle; fs = cloudpickle.loads(sys.stdin.buffer.read()); assert 'eventloom' not in sys.modules; print(len(fs), list(fs[4](iter([]))) and 1)"
    done = subprocess.run([sys.executable, "-c", code], input=cloudpickle.dumps(made), capture_output=True, cwd="/", env={"PATH": "/usr/bin"})
    assert done.stdout.decode().split() == ["10", "1"], done.stderr.decode()[-800:]
