import hashlib
import os
import random
from collections import defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from eventloom.operators import features
from eventloom.operators import text as X
from eventloom.operators import topics
from eventloom.plans.relevant_news import most_covered_news, news_clusters, news_pipeline, news_vectors
from eventloom.sources.snapshots import TableSet
from eventloom.schemas import GKG, NO_SUMMARY
from eventloom.session import settle
from eventloom.sources.sinks import append_table
from eventloom.streaming.arrivals import news_on_new_file, on_new_file


def test_first_text_that_works_and_first_url_only(spark):
    texts = spark.createDataFrame([("u1", ""), ("u2", "two"), ("u3", "three"), ("u4", None)], "url string, text string")
    rows = spark.createDataFrame(
        [(1, "u1<UDIV> u2 <UDIV>u3"), (2, " <UDIV>u3"), (3, "u1"), (4, None), (5, "u9<UDIV>u4<UDIV>u3"), (6, "u2")],
        "row_id int, urls string",
    )
    got = X.first_text_per_row(rows, "row_id", "urls", texts).orderBy("row_id").collect()
    assert [(r.row_id, r.pos, r.text) for r in got] == [(1, 1, "two"), (2, 1, "three"), (5, 2, "three"), (6, 0, "two")]
    only = {r.row_id: r.extracted_text for r in X.representative_text(rows, "urls", texts, ["row_id"]).collect()}
    assert only == {1: "", 2: None, 3: "", 4: None, 5: None, 6: "two"}
    kept = X.drop_rows_without_text(rows, X.first_usable_url(rows, "row_id", "urls", texts), "row_id")
    assert sorted(r.row_id for r in kept.collect()) == [1, 2, 5, 6]


def test_few_urls_travel_to_the_texts(spark):
    texts = spark.range(1000).select(F.col("id").cast("string").alias("url"), F.repeat(F.lit("x"), 50).alias("text"))
    few = spark.createDataFrame([("3",), ("5",)], "url string")
    found = X.texts_of(few, texts)
    assert found.count() == 2
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_repeated_urls_give_one_row_a_cluster(spark, folder):
    gkg, texts = news_inputs(spark)
    tables = news_pipeline(gkg, texts.unionByName(texts.withColumn("text", F.concat("text", F.lit(" Again.")))), folder, ks=range(2, 6))
    assert tables.relevant_news.count() == tables.k
    assert tables.dimension_reduction.count() == 35  # the first page was empty only once


def test_no_row_with_a_text_gives_empty_tables(spark, folder):
    gkg, texts = news_inputs(spark)
    tables = news_pipeline(gkg, texts.limit(0), folder)
    assert (tables.k, tables.relevant_news.count(), tables.dimension_reduction.count()) == (0, 0, 0)
    assert TableSet(spark, folder).read("relevant_news").count() == 0


def test_most_covered_news(spark):
    gkg, texts = news_inputs(spark)
    clusters = news_clusters(gkg, texts, ks=range(2, 6))
    news = most_covered_news(clusters, texts).collect()
    assert len(news) == clusters.k and all(r.NUMARTS == 6 for r in news)
    assert news[0].asDict().keys() == {"cluster_label", "NUMARTS", "SOURCEURLS", "extracted_text", "summary"}


def test_bad_lines_of_a_stream_are_set_aside(spark, folder):
    os.mkdir(f"{folder}/in")
    gkg, _ = news_inputs(spark)
    write_file(f"{folder}/in/a.csv", gkg.collect()[:3])
    with open(f"{folder}/in/a.csv", "a") as out:
        out.write("20240822\tmany" + "\t" * 9 + "\nshort\n")
    counts = []
    on_new_file(spark, f"{folder}/in", f"{folder}/check", lambda b: counts.append(b.count())).awaitTermination()
    assert counts == [3]
    bad = spark.read.parquet(f"{folder}/check-rejected").collect()
    assert sorted(r["_corrupt_record"].split("\t")[0] for r in bad) == ["20240822", "short"]
    assert {r["source_file"] for r in bad} == {"a.csv"}


def test_one_text_per_url(spark):
    df = spark.createDataFrame([(1, "u", ""), (2, "u", "late"), (3, "u", "later"), (4, "v", "")], "page_id int, url string, text string")
    assert {r.url: r.text for r in X.one_text_per_url(df).collect()} == {"u": "late", "v": ""}


def test_summaries(spark):
    text = "Storm hits the coast now. A dog. Storm damage on the coast grows. Nothing else to say here! The storm left the coast."
    df = spark.createDataFrame([(1, text), (2, "Too short."), (3, None), (4, "")], "id int, t string")
    got = {r.id: r.summary for r in X.summarise(df, "id", "t").collect()}
    assert got[1] == "Storm hits the coast now. Storm damage on the coast grows. The storm left the coast."
    assert (got[2], got[3], got[4]) == (NO_SUMMARY, None, NO_SUMMARY)


def test_topics_format(spark):
    rows = [(0, "the police police arrest arrest judge court " * 3), (0, "police court trial in the city"), (1, "the of and"), (2, None), (None, "police court")]
    df = spark.createDataFrame(rows, "cluster_label int, extracted_text string")
    got = {r.cluster_label: r.lda_topics for r in X.cluster_topics(df, "cluster_label", "extracted_text").collect()}
    parts = [p.split(", ") for p in got[0].split("; ")]
    assert len(parts) == 3 and all(len(p) == 3 for p in parts)
    assert "the" not in sum(parts, []) and got[1] is None and 2 not in got
    joined = X.attach_topics(spark.createDataFrame([(0,), (2,)], "cluster_label int"), spark.createDataFrame([(0, "x")], "cluster_label int, lda_topics string"))
    assert {r.cluster_label: r.lda_topics for r in joined.collect()} == {0: "x", 2: None}


def topic_weights_by_hand(counts, n_topics, seed, rounds):
    """The rounds over plain rows ``(cluster, doc, term, n)``."""
    prior, topics = 1 / n_topics, range(n_topics)

    def lot(doc, term, k):
        return 1 + int(hashlib.md5(f"{seed}:{doc}:{term}:{k}".encode()).hexdigest()[:12], 16) / 2.0**48

    share = lambda q: [x / sum(q) for x in q]
    r = {row: share([lot(row[1], row[2], k) for k in topics]) for row in counts}
    for _ in range(rounds + 1):
        t, d, w, words = defaultdict(lambda: [0.0] * n_topics), defaultdict(lambda: [0.0] * n_topics), defaultdict(lambda: [0.0] * n_topics), defaultdict(set)
        for (c, doc, term, n), x in r.items():
            words[c].add(term)
            for k in topics:
                for sums, key in ((t, (c, term)), (d, (c, doc)), (w, c)):
                    sums[key][k] += n * x[k]
        last = t
        r = {
            (c, doc, term, n): share([(t[c, term][k] + prior) / (w[c][k] + len(words[c]) * prior) * (d[c, doc][k] + prior) for k in topics])
            for c, doc, term, n in r
        }
    return last


@pytest.mark.parametrize("small", [True, False])
def test_rounds_of_topics_write_texts_and_not_cells(spark, monkeypatch, small):
    rng = random.Random(4)
    rows = [(i % 2, f"{i // 2:032x}", f"word{j}", rng.randint(1, 4)) for i in range(12) for j in rng.sample(range(60), 25)]
    written = []

    def counted(df):
        kept = settle(df)
        written.append(kept.count())
        return kept

    monkeypatch.setattr(X, "settle", counted)
    monkeypatch.setattr(X, "small_enough", lambda df: small)
    counts = spark.createDataFrame(rows, "cluster int, doc string, term string, n long")
    got = {(r.cluster, r.term): r.weights for r in X.topic_weights(counts, rounds=4).collect()}
    want = topic_weights_by_hand(rows, X.TOPICS, X.TOPIC_SEED, 4)
    assert got.keys() == want.keys() and all(got[key] == pytest.approx(want[key]) for key in want)
    assert written == [300, 2, 12, 12, 12, 12, len(want)]


def test_summaries_have_tasks_for_their_text(spark, monkeypatch, capsys):
    rows = [(i, " ".join(f"Sentence {j} of the text {i} says {'more ' * (j % 4)}words." for j in range(40))) for i in range(20)]
    df = spark.createDataFrame(rows, "row_id int, text string")
    before = sorted(map(tuple, X.summarise(df, "row_id", "text").collect()))
    monkeypatch.setattr(X, "FULL_TEXT", 1000)
    many = X.summarise(df, "row_id", "text")
    many.explain()
    parts = sum(len(t) for _, t in rows) // 1000 + 1
    assert f", {parts}), REPARTITION_BY_NUM" in capsys.readouterr().out
    assert sorted(map(tuple, many.collect())) == before


def plan_nodes(node, above=()):
    yield node, above
    for i in range(node.children().size()):
        yield from plan_nodes(node.children().apply(i), (*above, node))


def test_a_text_is_hashed_and_cut_once_after_equal_texts_have_met(spark):
    """However few tasks read the table; before, the digest of a text was taken again for each of its words."""
    rows = [("a", "Storm storm coast the x"), ("a", "Storm storm coast the x"), ("a", "coast rain"), ("b", "Storm storm coast the x"), ("b", ""), (None, "rain"), ("b", None)]
    df = spark.createDataFrame(rows, "c string, t string").coalesce(1)
    counts = X.term_counts(df, "c", "t", ["the"])
    digest = lambda t: hashlib.md5(t.encode()).hexdigest()
    storm, rain = digest(rows[0][1]), digest(rows[2][1])
    want = {("a", storm, "storm", 4), ("a", storm, "coast", 2), ("a", rain, "coast", 1), ("a", rain, "rain", 1), ("b", storm, "storm", 2), ("b", storm, "coast", 1)}
    assert {tuple(r) for r in counts.collect()} == want and counts.count() == len(want)
    assert counts.dtypes == [("cluster", "string"), ("doc", "string"), ("term", "string"), ("n", "bigint")]
    nodes = list(plan_nodes(counts._jdf.queryExecution().optimizedPlan()))
    assert not [n for n, _ in nodes if n.nodeName() == "Generate"]
    met = [(n, *above) for n, above in nodes if n.nodeName() == "Aggregate"]
    cuts = lambda some: sum("regexp_extract_all" in n.simpleString(500) for n in some)
    assert len(met) == 1 and cuts(met[0]) == cuts(n for n, _ in nodes) == 1


def test_first_shares_are_those_of_md5():
    rng = random.Random(2)
    texts = ["7:" + "d" * rng.randint(0, 140) + rng.choice(["é", "слово", ""]) * rng.randint(0, 30) + ":" for _ in range(500)]
    got = topics.lots(pa.array(texts), 12)
    for k in range(12):
        assert list(got[k]) == [1 + int(hashlib.md5(f"{t}{k}".encode()).hexdigest()[:12], 16) / 2.0**48 for t in texts]


@pytest.mark.parametrize("small", [True, False])
def test_terms_dealt_to_chunks_by_cluster_give_the_same_weights(spark, monkeypatch, small):
    rng = random.Random(9)
    rows = [(f"c{i % 3}", f"{i // 3:032x}", f"wörd{j}", rng.randint(1, 4)) for i in range(30) for j in rng.sample(range(80), 30 if i % 3 else 8)]
    monkeypatch.setattr(X, "LEAST_CELLS", 100)
    monkeypatch.setattr(X, "FULL_CELLS", 100)
    monkeypatch.setattr(topics, "SLICE", 16)
    monkeypatch.setattr(topics, "PACK", 64)
    monkeypatch.setattr(X, "small_enough", lambda df: small)
    seen = []
    monkeypatch.setattr(X, "_round_by_join", lambda *a, f=X._round_by_join: seen.append(a[0].select("chunk", "cid").collect()) or f(*a))
    counts = spark.createDataFrame(rows, "cluster string, doc string, term string, n long")
    got = {(r.cluster, r.term): r.weights for r in X.topic_weights(counts, n_topics=4, seed=7, rounds=3).collect()}
    want = topic_weights_by_hand(rows, 4, 7, 3)
    assert got.keys() == want.keys() and all(got[key] == pytest.approx(want[key]) for key in want)
    for blocks in seen:  # 680 cells: a cluster's terms lie in a run of chunks, not in all
        assert len({b.chunk for b in blocks}) == len(rows) // 100 + 1 and len(blocks) <= len(rows) // 100 + 3
    assert len(seen) == (0 if small else 3)


def test_foremost_terms_keep_what_rounds_to_the_same_weight(spark):
    weights = [(c, f"{c}{i:03d}", [float(i % 50), 7.0 + i * 1e-11, 1.0 / (i + 1)]) for c in "ab" for i in range(300)]
    keyed = pa.Table.from_pylist([{"key": ord(c), "cluster": c, "term": t, "weights": w} for c, t, w in weights])
    rows = [r for b in topics.foremost(keyed.to_batches(max_chunksize=170), 4, 3) for r in b.to_pylist()]
    for c in "ab":
        for k in range(3):
            order = lambda r: (-round(r[1], 9), r[0])
            want = sorted([(t, w[k]) for x, t, w in weights if x == c], key=order)[:4]
            assert sorted([(r["term"], r["weight"]) for r in rows if r["cluster"] == c and r["topic"] == k], key=order)[:4] == want
    assert len(rows) < len(weights) * 3


def news_inputs(spark):
    topics = ["storm coast flood rain damage homes", "court judge trial police verdict law", "market shares bank profit price trade"]
    gkg, texts = [], []
    for i in range(36):
        words = topics[i % 3].split()
        body = f"The {words[i % 6]} and the {words[(i + 1) % 6]} near {words[(i + 2) % 6]} were reported. More {words[0]} news follows about {words[1]} today."
        texts.append((f"http://n/{i}", body if i else ""))
        urls = f"http://n/0<UDIV>http://n/{i}" if i % 5 == 0 else f"http://n/{i}"
        values = dict(DATE="20240822", NUMARTS=2 if i == 35 else 3 + i % 4, THEMES=";".join(words[:3]) + "; PAD;TAX_X", SOURCEURLS=urls)
        gkg.append(tuple(values.get(f.name) for f in GKG.fields))
    return spark.createDataFrame(gkg, GKG), spark.createDataFrame(texts, "url string, text string")


def test_vectors_do_not_carry_the_tokens(spark, monkeypatch):
    gkg, texts = news_inputs(spark)
    carried = []
    stored = features.sparse_vectors

    def seen(rows, *rest):
        carried.append(rows.columns)
        return stored(rows, *rest)

    monkeypatch.setattr(features, "sparse_vectors", seen)
    vectors = news_vectors(gkg, texts)
    assert carried == [["row_id", "NUMARTS", "SOURCEURLS"]]
    assert vectors.columns == ["row_id", "NUMARTS", "SOURCEURLS", "features"] and vectors.count() == 34


def test_news_tables(spark, folder):
    gkg, texts = news_inputs(spark)
    tables = news_pipeline(gkg, texts, folder, ks=range(2, 6))
    news = TableSet(spark, folder).read("relevant_news").orderBy("cluster_label").collect()
    view = TableSet(spark, folder).read("dimension_reduction").collect()
    assert TableSet(spark, folder).read("relevant_news").columns == ["cluster_label", "SOURCEURLS", "extracted_text", "summary", "lda_topics"]
    assert [r.cluster_label for r in news] == list(range(tables.k))
    assert len(view) == 34 and {r.cluster for r in view} == set(range(tables.k))  # row 0 has no text, row 35 few articles
    assert all(r.summary for r in news if r.extracted_text)


def write_file(path, rows):
    with open(path, "w") as out:
        out.write("\t".join(f.name for f in GKG.fields) + "\n")
        for r in rows:
            out.write("\t".join("" if v is None else str(v) for v in r) + "\n")


def test_stream_takes_each_csv_once(spark, folder):
    src, out, check = f"{folder}/in", f"{folder}/out", f"{folder}/check"
    os.mkdir(src)
    gkg, _ = news_inputs(spark)
    rows = gkg.collect()
    write_file(f"{src}/a.csv", rows[:3])
    write_file(f"{src}/b.csv", rows[3:5])
    write_file(f"{src}/c.txt", rows[5:])
    seen = []

    def process(batch):
        seen.append(batch.count())
        append_table(batch, out)

    def run():
        on_new_file(spark, src, check, process).awaitTermination()
        return spark.read.schema(GKG).parquet(out).count()

    assert run() == 5 and sorted(seen) == [2, 3]
    assert run() == 5 and len(seen) == 2
    write_file(f"{src}/d.csv", rows[5:6])
    assert run() == 6 and len(seen) == 3


def test_a_failing_file_stops_the_stream_and_is_taken_again(spark, folder):
    src = f"{folder}/in"
    os.mkdir(src)
    gkg, _ = news_inputs(spark)
    write_file(f"{src}/a.csv", gkg.collect()[:2])

    def broken(batch):
        raise RuntimeError("no good")

    with pytest.raises(Exception, match="no good"):
        on_new_file(spark, src, f"{folder}/check", broken).awaitTermination()
    counts = []
    on_new_file(spark, src, f"{folder}/check", lambda b: counts.append(b.count())).awaitTermination()
    assert counts == [2]


def test_news_of_each_new_file(spark, folder):
    src = f"{folder}/in"
    os.mkdir(src)
    gkg, texts = news_inputs(spark)
    write_file(f"{src}/a.csv", gkg.collect())
    news_on_new_file(spark, src, f"{folder}/check", texts, f"{folder}/out", ks=range(2, 5)).awaitTermination()
    assert TableSet(spark, f"{folder}/out").read("relevant_news").where(F.col("SOURCEURLS").isNotNull()).count() >= 2
