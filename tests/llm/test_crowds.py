"""The exact join of crowded regions against brute force, and a template that many pairs share."""

import itertools
import random

import brute
import pytest

from eventloom.llm import crowds, near_dups


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


UNITS = "node long, label long, n long, tokens array<long>"


def joined(nodes, links):
    """Smallest node of each node's component."""
    above = {v: v for v in nodes}

    def root(x):
        while above[x] != x:
            x = above[x]
        return x

    for a, b in links:
        x, y = sorted((root(a), root(b)))
        above[y] = x
    return {v: root(v) for v in nodes}


def family(rng, size, common, own, pool):
    """Sets that share most of ``common`` tokens and have some of a pool each."""
    sets = []
    for _ in range(size):
        core = [t for t in range(common) if rng.random() > 0.01]
        sets.append(core + rng.sample(range(1000, 1000 + pool), rng.randint(0, own)))
    return sets


@pytest.mark.parametrize(
    "common,own,pool,most,block",
    [(100, 30, 4000, 48, 1 << 19), (85, 15, 300, 48, 1500), (85, 15, 300, 6, 400), (95, 10, 40, 6, 1500), (40, 60, 90, 1, 400), (3, 2, 5, 6, 400)],
)
def test_all_links_are_found(spark, common, own, pool, most, block):
    rng = random.Random(common + most)
    sets = {node: sorted(set(s)) for node, s in enumerate(family(rng, 150, common, own, pool) + family(rng, 40, common, 4, 60))}
    links = []
    for a, b in itertools.combinations(sets, 2):
        both = len(set(sets[a]) & set(sets[b]))
        if sets[a] and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
            links.append((a, b))
    label = joined(sets, links[::7])  # a part is joined before
    units = spark.createDataFrame([(v, label[v], len(s), s) for v, s in sets.items()], UNITS)
    found = {(r["a"], r["b"]) for r in crowds.crowded_pairs(units, 80, most, block).collect()}
    assert all(a < b for a, b in found)
    kept = found & set(links)
    assert joined(sets, links) == joined(sets, [*kept, *links[::7]])


def test_no_units(spark):
    units = spark.createDataFrame([], UNITS)
    assert crowds.crowded_pairs(units, 80).count() == 0
    units = spark.createDataFrame([(1, 1, 0, []), (2, 2, 0, [])], UNITS)
    assert crowds.crowded_pairs(units, 80).count() == 0


def template_pairs(pairs):
    """Texts of one template: two of a pair are similar enough, any two others are not."""
    rng = random.Random(31)
    base = [f"w{i}" for i in range(100)]
    rows = []
    for k in range(pairs):
        own = [f"x{k}_{i}" for i in range(40)]
        rows.append((2 * k, " ".join(base + own)))
        changed = list(own)
        changed[rng.randrange(30, 40)] = f"y{k}"
        rows.append((2 * k + 1, " ".join(base + changed[: rng.randint(32, 40)])))
    return rows


@pytest.mark.parametrize("pairs", [150, 1000])
def test_template_pairs(spark, pairs):
    rows = template_pairs(pairs)
    if pairs == 150:
        assert [c for _, _, c in sorted(brute.near_components(rows, 2))] == [k - k % 2 for k in range(2 * pairs)]
    got = near_dups.near_duplicates(frame(spark, rows), shingle=2).collect()
    assert sorted((r["_key"], r["component"]) for r in got) == [(k, k - k % 2) for k in range(2 * pairs)]


def test_candidates_grow_with_the_texts(spark):
    """Rows that the forest sends for a template: a bounded number a text, however many share it."""
    sent = []
    for pairs in (100, 400):
        rows = near_dups.features(frame(spark, template_pairs(pairs)), "doc_id", "text", 2)
        classes = rows.selectExpr("node", "n_shingles AS n", "signature", "node AS label")
        sent.append(near_dups.forest_candidates(classes, 80).count() / pairs)
    assert sent[1] < 2 * sent[0]


def test_common_tokens_of_a_crowd_are_not_joined(spark, monkeypatch):
    """Near copies: only the rows of tokens that few classes have leave the join by token."""
    sets = {node: [*range(80), 1000 + node] for node in range(60)}
    joins = []

    def counted(left, right, key, how="inner", *rest):
        out = crowds_join(left, right, key, how, *rest)
        if key == "w":
            joins.append(out.count())
        return out

    crowds_join = crowds.lookup_join
    monkeypatch.setattr(crowds, "lookup_join", counted)
    units = spark.createDataFrame([(v, v, len(s), s) for v, s in sets.items()], UNITS)
    found = [(r["a"], r["b"]) for r in crowds.crowded_pairs(units, 80).collect()]
    assert set(joined(sets, found).values()) == {0}
    assert joins[0] == 60
