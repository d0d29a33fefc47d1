"""Registered queries and the pipeline over the smallest tables, against SQL or brute force."""

import os

import brute
import pytest

pytestmark = pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables")
TABLES = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def entry():
    import __spark_entry__

    return __spark_entry__


def rows_of(entry, spark, name):
    df = entry.queries()[name](spark, TABLES)
    return df.columns, [tuple(r) for r in df.collect()]


def test_all_are_registered(entry):
    names = set(entry.queries())
    assert {n.split("_")[0] for n in names if n.startswith("op") and n[2:3].isdigit()} == {f"op{i}" for i in range(1, 14)}
    assert "pipeline" in names


@pytest.mark.parametrize("name", ["op2_warc_audit", "op4_url_filter", "op5_near_duplicates", "op7_repeats", "op8_decontamination", "op11_similar_vectors", "op13_prefix_trie"])
def test_against_sql(entry, spark, name):
    import duckdb

    con = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{TABLES}/{table}.parquet'")
    answer = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in answer.description]
    want = answer.fetchall()
    columns, got = rows_of(entry, spark, name)
    order = [names.index(c) for c in columns]
    assert sorted(names) == sorted(columns)
    assert sorted(got, key=repr) == sorted([tuple(r[i] for i in order) for r in want], key=repr)


def test_near_duplicates(entry, spark, documents):
    _, got = rows_of(entry, spark, "op5_near_duplicates")
    want = [(k, n, c if n else k, k == c or not n) for k, n, c in brute.near_components(documents, 2)]
    assert sorted(got) == sorted(want)


def test_repeats(entry, spark, documents):
    _, got = rows_of(entry, spark, "op7_repeats")
    assert sorted(got) == sorted(brute.repeats(documents))


def test_quality(entry, spark, documents):
    columns, got = rows_of(entry, spark, "op9_quality_rules")
    assert columns[:8] == "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept".split()
    want = {key: brute.base_counts(text) for key, text in documents}
    for row in got:
        assert row[1:6] == want[row[0]]
        failed = row[1] < 20 or 100 * row[5] > 30 * row[1]
        assert row[6] == failed and not (failed and row[7])


def test_scores(entry, spark, documents):
    _, got = rows_of(entry, spark, "op3_pitman_yor")
    got = {r[0]: r for r in got}
    for want in brute.unigram_scores(documents):
        assert got[want[0]][:5] == want[:5] and got[want[0]][5] == pytest.approx(want[5], rel=1e-9)


def test_pieces(entry, spark, documents):
    import public_tokenizers
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    _, got = rows_of(entry, spark, "op10_sentencepiece")
    want = []
    for key, text in documents:
        ids = library.encode(text or "", add_eos=True)
        want.append((key, len(ids), brute.sha(" ".join(map(str, ids)).encode()), brute.sha(library.decode(ids).encode())))
    assert sorted(got) == sorted(want)


def test_stages(entry, spark):
    """Each stage against brute force on its own input."""
    import corpus_pipeline
    from eventloom.session import settle

    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{TABLES}/benchmark.parquet").select("item_id", "text").collect()]
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        columns = docs.columns
        docs = settle(stage(spark, docs, TABLES))
        if name == "token_ids":
            assert {r["doc_id"]: r["decoded"] for r in docs.collect()} == before
            continue
        assert docs.columns == columns
        after = {r["doc_id"]: r["text"] for r in docs.collect()}
        rows = sorted(before.items())
        if name == "quality_rules":
            failed = {k for k, t in rows for c in [brute.base_counts(t)] if c[0] < 20 or 100 * c[4] > 30 * c[0]}
            assert not failed & set(after) and len(after) >= 0.8 * (len(before) - len(failed))
        elif name == "near_duplicates":
            assert set(after) == {k for k, n, c in brute.near_components(rows, 5) if k == c or not n}
        elif name == "repeated_passages":
            for key, size, removed, _, digest in brute.repeats(rows):
                if not removed:
                    assert after[key] == before[key]
                else:
                    assert len(after.get(key, "").encode()) <= size - removed
                    assert key not in after or len(after[key].encode()) >= size - removed - 8 * size
        else:
            assert set(after) == {r[0] for r in brute.leaks(rows, items) if not r[2]}
    want = {r["doc_id"] for r in docs.collect()}
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, TABLES).select("doc_id").collect()} == want
