import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from eventloom.functions.vectors import dense
from eventloom.operators import features as X
from eventloom.operators import spread as S
from eventloom.plans.actor_clusters import actor_clusters, actor_graph, training_set


def brute_vocabulary(counts, coverage=0.8):
    """Tokens by (count descending, token), kept until the running sum reaches the share."""
    kept, running, total = [], 0, sum(counts.values())
    for token, n in sorted(counts.items(), key=lambda x: (-x[1], x[0])):
        kept.append(token)
        running += n
        if running >= coverage * total:
            break
    return sorted(kept)


@pytest.mark.parametrize("one_task", [200_000, 0])
def test_vocabulary_by_coverage_against_brute_force(spark, monkeypatch, one_task):
    """With 0 the tied tokens and the index are numbered by the distributed sort."""
    monkeypatch.setattr(S, "ONE_TASK_ROWS", one_task)
    rng = random.Random(3)
    cases = [{"a": 8, "b": 2}, {"a": 5, "b": 3, "c": 2}, {c: 1 for c in "abcdefghij"}, {"x": 1}]
    cases += [{f"t{i}": rng.randint(1, 4) for i in range(rng.randint(2, 60))} for _ in range(3)]
    for counts in cases:
        df = spark.createDataFrame(list(counts.items()), "token string, count long").repartition(3)
        got = X.vocab_by_coverage(df).orderBy("idx").collect()
        assert [r.token for r in got] == brute_vocabulary(counts)
        assert [r.idx for r in got] == list(range(len(got)))
    assert X.vocab_by_coverage(spark.createDataFrame([], "token string, count long")).count() == 0


def test_padded_tokens_count_but_do_not_match(spark):
    df = spark.createDataFrame(
        [(1, "TAX# PROTEST;TAX_X;", None), (2, None, "NEW YORK;ÉLAN;PROTEST"), (3, None, None)],
        "id int, THEMES string, PERSONS string",
    )
    cols = ["THEMES", "PERSONS"]
    counts = {r.token: r["count"] for r in X.token_counts(df, cols).collect()}
    assert counts == Counter({"TAX": 1, "PROTEST": 2, "ÉLAN": 1})
    terms = ["PROTEST", "TAX", "ÉLAN"]
    vocab = spark.createDataFrame([(t, i) for i, t in enumerate(terms)], "token string, idx long")
    vectors = {r.id: list(r.multi_hot) for r in X.multi_hot_tokens(df, "id", vocab, cols).collect()}
    assert vectors == {1: [0, 1, 0], 2: [1, 0, 1], 3: [0, 0, 0]}
    stripped = X.multi_hot_tokens(df, "id", vocab, cols, strip_on_match=True).where("id = 1").first()
    assert list(stripped.multi_hot) == [1, 1, 0]
    long = {(r.id, r.idx) for r in X.multi_hot_long(df, "id", vocab, cols).collect()}
    assert long == {(i, p) for i, v in vectors.items() for p, x in enumerate(v) if x}


ACTOR = "GLOBALEVENTID int, SQLDATE string, Actor1Name string, Actor2Name string, EventRootCode string, EventBaseCode string, EventCode string"


def actor_rows(spark):
    return spark.createDataFrame(
        [(1, "20200215", "POLICE", "JUDGE", "17", "172", "1721"), (2, "20211231", "POLICE", "POLICE", "04", "04", "043"),
         (3, "20200101", "JUDGE", "POLICE", "04", "17", "17")],
        ACTOR,
    )


def test_training_set_layout(spark):
    made = training_set(actor_rows(spark))
    names = [r.feature for r in made.names.orderBy("position").collect()]
    assert names == ["time", "actor_POLICE", "actor_JUDGE", "event_04", "event_17"]
    rows = {r.GLOBALEVENTID: list(r.features) for r in made.rows.collect()}
    assert rows[1] == pytest.approx([75 / 365, 1, 1, 0, 1])
    assert rows[2] == pytest.approx([391 / 365, 1, 0, 1, 0])
    assert rows[3] == pytest.approx([31 / 365, 1, 1, 1, 1])
    wide = made.wide("GLOBALEVENTID")
    assert wide.columns[1:] == names and wide.schema["event_04"].dataType.simpleString() == "int"
    long = {(r.GLOBALEVENTID, r.feature) for r in made.long("GLOBALEVENTID").collect()}
    assert (2, "event_04") in long and (2, "event_17") not in long


def test_actor_plan_end_to_end(spark):
    many = actor_rows(spark).unionByName(actor_rows(spark).withColumn("GLOBALEVENTID", F.col("GLOBALEVENTID") + 10))
    model, labelled = actor_clusters(many, k=2)
    assert labelled.count() == 6 and {r.cluster for r in labelled.collect()} <= {0, 1}
    edges = actor_graph(labelled).collect()
    assert edges and {(r.src, r.dst) for r in edges} <= {("actor_POLICE", "actor_JUDGE"), ("actor_JUDGE", "actor_POLICE")}


def test_combined_vectors_have_length_one_or_zero(spark):
    vocab = spark.createDataFrame([("a", 0), ("b", 1), ("c", 2)], "token string, idx long")
    rows = spark.createDataFrame([(1, ["a", "b"]), (2, [])], "id int, t array<string>")
    df = X.multi_hot(rows, "id", F.col("t"), vocab, "v")
    got = X.combine_and_normalise(df, ["v", "v"]).orderBy("id")
    lengths = [sum(x * x for x in r.f) for r in got.select(dense(got, "features").alias("f")).collect()]
    assert lengths == pytest.approx([1.0, 0.0])


def test_vectors_over_a_vocabulary_of_any_width(spark):
    """Wider than a list on the driver should be; an empty vocabulary gives vectors without positions."""
    vocab = spark.range(2_000_000).select(F.col("id").cast("string").alias("token"), F.col("id").alias("idx"))
    rows = spark.createDataFrame([(1, ["7", "1999999", "x"]), (2, None)], "id int, t array<string>")
    got = {r.id: r.v for r in X.multi_hot(rows, "id", F.col("t"), vocab, "v").collect()}
    assert got[1].size == got[2].size == 2_000_000
    assert got[1].indices.tolist() == [7, 1_999_999] and got[2].indices.tolist() == []
    none = X.multi_hot(rows, "id", F.col("t"), vocab.limit(0), "v").first()
    assert none.v.size == 0


def test_measured_bytes_looks_into_every_type(spark):
    big = spark.range(100).select(F.array(F.repeat(F.lit("x"), 10_000)).alias("a"))
    kinds = {
        "array": big,
        "binary": big.select(F.col("a")[0].cast("binary").alias("a")),
        "struct": big.select(F.struct("a").alias("s")),
        "map": big.select(F.create_map(F.lit("k"), F.col("a")[0]).alias("m")),
        "nested": big.select(F.array(F.struct(F.col("a")[0].alias("t"))).alias("n")),
    }
    for name, df in kinds.items():
        assert 1_000_000 <= S.measured_bytes(df) < 1_100_000, name
    assert S.measured_bytes(spark.createDataFrame([(None, None)], "a array<string>, s struct<t:string>")) < 200


def test_spread_join_equals_the_plain_join(spark):
    rows = [(i, "hot" if i % 3 else f"k{i % 50}") for i in range(3000)] + [(i, None) for i in range(3000, 3100)]
    left = spark.createDataFrame(rows, "id int, key string").repartition(4)
    right = spark.createDataFrame([("hot", 1.0)] + [(f"k{i}", float(i)) for i in range(0, 60, 2)], "key string, v double")
    for how in ("inner", "left", "left_semi"):
        plain = left.join(right, "key", how).orderBy("id").collect()
        dealt = S.spread_join(left, right, "key", how, ["id"], spread=8, share=0.1, at_least=0)
        assert dealt.select(*left.join(right, "key", how).columns).orderBy("id").collect() == plain
    spread_over = S.hot_keys(left, "key", 0.1, 0).collect()
    assert [r.key for r in spread_over] == ["hot"]


def test_numbers_and_ranks(spark):
    rng = random.Random(1)
    rows = [(rng.choice("aab"), rng.random(), i) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, x double, id int").repartition(7)
    numbered = S.number_rows(df, ["x", "id"]).orderBy("rn").collect()
    assert [r.rn for r in numbered] == list(range(1, 501))
    assert [(r.x, r.id) for r in numbered] == sorted((x, i) for _, x, i in rows)
    ranked = S.rank_in_group(df, "g", [F.col("x").desc()]).collect()
    for g in "ab":
        mine = sorted((r for r in ranked if r.g == g), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, len(mine) + 1))
        assert [r.x for r in mine] == sorted((x for k, x, _ in rows if k == g), reverse=True)
