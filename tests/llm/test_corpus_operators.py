"""Near-duplicates, repeats, language model, tokens and audits."""

import hashlib
import random
import zlib
from pathlib import Path

import brute
import numpy as np
import pyarrow as pa
import pytest
from eventloom.llm import linked, near_dups, pieces, pitman_yor, repeats, suffix_arrays, token_files, warc_audit
from eventloom.session import scratch_path
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


# -- components and near-duplicates ---------------------------------------------------------------


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randint(0, 150), rng.randint(0, 150)) for _ in range(90)]
    links += [(1000 + i, 1001 + i) for i in range(200)] + [(5000, 6000 + i) for i in range(50)] + [(7, 7)]
    above = {}

    def root(x):
        while above.get(x, x) != x:
            x = above[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        above[max(a, b)] = min(a, b)
    everyone = {x for link in links for x in link}
    want = {x: root(x) for x in everyone if root(x) != x}
    df = spark.createDataFrame(links, "a long, b long").repartition(7)
    assert {r["v"]: r["r"] for r in linked.components(df).collect()} == want
    assert linked.components(df.where("1 = 0")).count() == 0


def test_near_duplicates(spark):
    rng = random.Random(6)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, key = [], 0
    for _ in range(12):
        text = [rng.choice(vocabulary) for _ in range(rng.randint(1, 120))]
        for _ in range(rng.randint(1, 8)):
            changed = list(text)
            for _ in range(rng.randint(0, 1 + len(text) // 25)):
                changed[rng.randrange(len(changed))] = rng.choice(vocabulary)
            rows.append((key := key + 1, " ".join(changed).title() if rng.random() < 0.5 else " \n".join(changed)))
    rows += [(500, None), (501, ""), (502, " \t"), (503, "solo"), (504, "SOLO"), (None, rows[0][1]), rows[0]]
    for size in (2, 5):
        got = near_dups.near_duplicates(frame(spark, rows), shingle=size)
        want = [(k, n, c if n else k) for k, n, c in brute.near_components(rows, size)]
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_crowded_region_is_joined(spark):
    """A group far larger than a region, with members that differ from each other in many ways."""
    rng = random.Random(9)
    base = [f"w{i}" for i in range(300)]
    rows = []
    for key in range(400):
        text = list(base)
        for _ in range(rng.randint(0, 6)):
            text[rng.randrange(300)] = f"x{rng.randrange(10_000)}"
        rows.append((key, " ".join(text)))
    got = near_dups.near_duplicates(frame(spark, rows), shingle=2).collect()
    assert sorted(map(tuple, got)) == sorted(brute.near_components(rows, 2))


def test_near_duplicates_odd_rows(odd_documents, no_documents):
    got = near_dups.near_duplicates(odd_documents)
    assert got.count() == odd_documents.count()
    kept = near_dups.keep_first(odd_documents)
    assert kept.columns == odd_documents.columns
    # The second text goes with its repetition; null, empty and other texts stay.
    assert kept.count() == odd_documents.count() - 2
    assert near_dups.keep_first(no_documents).count() == 0


def test_keep_first_keeps_one_row_of_each_group(spark):
    rng = random.Random(8)
    one, other, third = (" ".join(rng.choice("abcdefgh") + str(rng.randrange(300)) for _ in range(120)) for _ in range(3))
    rows = [(1, one), (1, one), (5, one), (None, one), (1, other), (9, third), (9, one + " x")]
    rows += [(None, other + " y"), (None, other + " y"), (7, None), (7, None), (None, "")]
    kept = sorted(map(tuple, near_dups.keep_first(frame(spark, rows)).collect()), key=repr)
    assert kept == sorted([(1, one), (1, other), (9, third), (7, None), (7, None), (None, "")], key=repr)
    nulls = frame(spark, [(None, one)] * 3 + [(None, other)] * 2 + [(None, other + " z")])
    kept = [r["text"].removesuffix(" z") for r in near_dups.keep_first(nulls).collect()]
    assert sorted(kept) == sorted([one, other])


def test_copies_under_one_key_survive_the_stages(spark):
    text = " ".join(f"word{i}" for i in range(100))
    for key in (1, None):
        rows = frame(spark, [(key, text), (key, text)])
        kept = repeats.cut_repeats(near_dups.keep_first(rows))
        assert [tuple(r) for r in kept.collect()] == [(key, text)]


# -- suffix arrays and repeats --------------------------------------------------------------------


@pytest.mark.parametrize("letters", [1, 2, 4])
def test_suffix_arrays(monkeypatch, letters):
    monkeypatch.setattr(suffix_arrays, "SYMBOLS_A_LETTER", 0.0001)
    rng = np.random.default_rng(letters)
    for n in (1, 2, 3, 10, 60, 200):
        for copies in (1, 4):
            text = np.append(np.tile(rng.integers(1, letters + 1, n), copies), 0).astype(np.uint8)
            raw = text.tobytes()
            order = suffix_arrays.suffix_array(text, letters + 1)
            assert order.tolist() == sorted(range(len(raw)), key=lambda i: raw[i:])
            shared = suffix_arrays.permuted_common_prefixes(text, order, 20)
            for before, at in zip(order, order[1:]):
                m = 0
                while m < 20 and at + m < len(raw) and before + m < len(raw) and raw[at + m] == raw[before + m]:
                    m += 1
                assert shared[at] == m


def test_sliding_minimum():
    keys = np.random.default_rng(3).integers(0, 50, 500).astype(np.uint64)
    assert repeats.sliding_minimum(keys, 7).tolist() == [min(keys[i : i + 7]) for i in range(494)]


@pytest.fixture(scope="module")
def repeating():
    rng = random.Random(3)
    vocabulary = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7))) for _ in range(60)]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    passages, rows = [say(70) for _ in range(6)], []
    for i in range(120):
        text = say(rng.randint(0, 120))
        if i % 2:
            text = f"{text} {passages[i % 6]} {say(20)}"
        rows.append((i % 110, "ab" * rng.randint(1, 300) if i % 10 == 0 else text))
    rows += [(999, None), (1000, ""), (1001, "a" * 199), (1002, "b" * 200), (1003, "c" * 201), (None, "d" * 400), (1004, "é" * 300)]
    return rows + rows[5:9]


@pytest.mark.parametrize("options", [{}, {"hot": 3}, {"shard_bytes": 5000}])
def test_repeats(spark, repeating, options):
    got = repeats.report(frame(spark, repeating), **options).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(brute.repeats(repeating), key=repr)


def test_cut_repeats_keeps_whole_characters(spark):
    passage = "é日" * 60
    rows = [(1, f"x{passage}a"), (2, f"yy{passage}b"), (3, "clean"), (4, passage * 2), (5, None), (6, " ")]
    df = frame(spark, rows).withColumn("n_chars", F.length("text")).withColumn("starts", F.lit(1))
    got = {r["doc_id"]: r for r in repeats.cut_repeats(df).collect()}
    assert set(got) == {1, 2, 3, 5, 6}
    assert got[1]["text"] == "xa" and got[2]["text"] == "yyb" and got[1]["n_chars"] == 2
    assert got[5]["text"] is None and got[6]["text"] == " " and got[3]["starts"] == 1


def test_repeats_odd_rows(odd_documents, no_documents):
    got = repeats.report(odd_documents)
    assert got.count() == odd_documents.count()
    kept = repeats.cut_repeats(odd_documents)
    assert kept.columns == odd_documents.columns and kept.count() == odd_documents.count() - 2
    assert repeats.report(no_documents).count() == repeats.cut_repeats(no_documents).count() == 0


# -- language model -------------------------------------------------------------------------------


def test_seating_follows_the_rule():
    """Mean number of tables against the recursion of the process, the dish's own tables included: 50 customers, two other
    tables, strength 1, discount 0.75 and a parent's probability of a half give 16.8."""
    c, discount, share = 50, 0.75, 0.5
    pull = (1 + discount * 2) * share
    chance = {1: 1.0}
    for i in range(1, c):
        after = {}
        for t, p in chance.items():
            opening = pull + discount * t * share
            new = opening / (opening + i - discount * t)
            after[t + 1] = after.get(t + 1, 0) + p * new
            after[t] = after.get(t, 0) + p * (1 - new)
        chance = after
    mean = sum(t * p for t, p in chance.items())
    n = 20_000
    tables = pitman_yor.seat(np.full(n, c), np.full(n, pull), np.full(n, share), discount, np.arange(n).astype(np.uint64), 0)
    assert abs(tables.mean() - mean) < 0.1 and abs(mean - 16.8) < 0.1
    big = pitman_yor.seat(np.array([0, 1, 10**9]), np.array([1.0, 1.0, 1e6]), np.zeros(3), 0.5, np.arange(3).astype(np.uint64), 0)
    assert big[0] == 0 and big[1] == 1 and 1 < big[2] < 10**9


@pytest.mark.parametrize("shares", [{}, {"frequent_share": 300, "pair_share": 2000}])
def test_language_model(spark, documents, shares):
    docs = frame(spark, documents)
    got = {r["doc_id"]: tuple(r) for r in pitman_yor.score(docs, **shares).collect()}
    for want in brute.unigram_scores(documents):
        assert got[want[0]][:5] == want[:5]
        assert got[want[0]][5] == pytest.approx(want[5], rel=1e-9)
    training = docs.where(~pitman_yor.held_out(F.col("doc_id"))).select(F.col("text").alias("_text"))
    model, rare = pitman_yor.fit(training, **shares)
    mass = rare.agg(F.sum("parent")).first()[0] or 0.0
    assert model.parent.sum() + mass + model.unknown == pytest.approx(1, abs=1e-6)
    context = np.bincount(model.pairs >> 21, model.own, len(model.weight)) + model.weight
    assert context == pytest.approx(np.ones(len(context)), abs=1e-9)


def test_language_model_beats_the_base(spark):
    scored = pitman_yor.score(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).where("held_out")
    assert pitman_yor.perplexity(scored) < 0.5 * pitman_yor.perplexity(scored, "base_score")


def test_language_model_is_the_same_at_every_share(spark, documents):
    """Shares decide where a number is looked up: a corpus with few frequent words and listed pairs scores alike."""
    docs = frame(spark, documents)
    whole = {r["doc_id"]: tuple(r) for r in pitman_yor.score(docs).collect()}
    for shares in ({"frequent_share": 300, "pair_share": 2000}, {"frequent_share": 1, "pair_share": 1}):
        for row in pitman_yor.score(docs, **shares).collect():
            assert tuple(row)[:5] == whole[row["doc_id"]][:5]
            assert tuple(row)[5:] == pytest.approx(whole[row["doc_id"]][5:], rel=1e-9)


def test_language_model_leaves_no_spent_tables(spark, documents):
    """What a sweep or a join replaces goes from the shared folder, and its shuffles from the executors' disks."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    folder, before = Path(scratch_path(spark, "x").removeprefix("file:")).parent, spark.conf.get(name, None)
    tables = set(folder.glob("settled-*"))
    rows = pitman_yor.score(frame(spark, documents), sweeps=6)
    assert len(set(folder.glob("settled-*")) - tables) <= 12
    assert spark.conf.get(name, None) == before
    assert rows.count() == len(documents)


def test_language_model_odd_rows(odd_documents, no_documents):
    got = pitman_yor.score(odd_documents).collect()
    assert len(got) == odd_documents.count()
    assert all(r["score"] < 0 and r["n_tokens"] > 0 for r in got)
    assert pitman_yor.score(no_documents).count() == 0
    untrained = odd_documents.where("doc_id = 1").withColumn("doc_id", F.lit(None).cast("long"))
    assert pitman_yor.score(untrained).first()["held_out"] is False


# -- tokens ---------------------------------------------------------------------------------------


def odd_texts(n, alphabet, seed=2):
    rng = random.Random(seed)
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(n)]
    return [*texts, "", " ", "  ", " a", "a ", "▁", "a\n b", "</s>", "<0x0A>", "ab" * 400, "日本語" * 200, " " * 600, "the" * 300, "q" * 2000]


def test_cuts_of_byte_pieces_equal_the_library(monkeypatch):
    """Texts are cut at marks and line ends too, and cuts met again are not encoded again, whatever is forgotten."""
    encoder = token_files.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    alphabet = [*" \n\t\rabZ'.,!\"-09éà×÷ßЖ日　\u00a0\u0085\u2003\u2028\u202f“–…😀\x00\x1c\x7f¼", "  ", "\n\n", "'ll", " 'd", " “", " a", " b"]
    texts = odd_texts(3000, alphabet)
    want = [e.ids for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    monkeypatch.setattr(token_files, "REMEMBERED", 500)
    for first in range(0, len(texts), 100):
        flat, ends = encoder.encode(texts[first : first + 100])
        assert [flat[a:b].tolist() for a, b in zip(ends, ends[1:])] == want[first : first + 100]

    asked, ids_of = [], encoder._ids
    monkeypatch.setattr(encoder, "_ids", lambda some: asked.extend(some) or ids_of(some))
    monkeypatch.setattr(token_files, "REMEMBERED", 12)
    for text in ("so one two, two. two! one", "so three four five six seven eight nine", "so one two; two"):
        encoder.encode([text])
    assert "".join(asked).count(" two") == 1 and "".join(asked).count("one") == 1


def test_pieces_equal_the_library():
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = odd_texts(1500, " \n\tabcde the ing▁é日本語😀<s>0123ñß\x00   aaaa")
    with open(path, "rb") as f:
        encoder = pieces.Encoder(pieces.PieceModel(f.read()), 2)
    found = encoder.encode(texts)
    for text, ids, places in zip(texts, found, encoder.numbers(texts)):
        assert ids.tolist() == library.encode(text, add_eos=True)
        assert encoder.decoded(places) == library.decode(ids.tolist())


def test_pieces_with_little_memory(monkeypatch, documents):
    import sentencepiece

    monkeypatch.setattr(pieces, "REMEMBERED", 50)
    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    with open(path, "rb") as f:
        encoder = pieces.Encoder(pieces.PieceModel(f.read()), 2)
    for first in range(0, 40, 5):
        texts = [t for _, t in documents[first : first + 5]]
        assert [x.tolist() for x in encoder.encode(texts)] == library.encode(texts, add_eos=True)


def test_pieces_known_words_are_not_merged_again(monkeypatch):
    """A full memory keeps the words of the present call."""
    import sentencepiece

    monkeypatch.setattr(pieces, "REMEMBERED", 50)
    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    with open(path, "rb") as f:
        encoder = pieces.Encoder(pieces.PieceModel(f.read()), 2)
    asked, encode_words = [], encoder.model.encode_words
    monkeypatch.setattr(encoder.model, "encode_words", lambda words: asked.append(len(words)) or encode_words(words))
    first, second = " ".join(f"w{i}é" for i in range(40)), " ".join(f"w{i}é" for i in range(30, 60))
    for text in (first, second, second):
        ids = library.encode(text, add_eos=True)
        assert encoder.digests([text]) == (
            [len(ids)],
            [hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()],
            [hashlib.sha256(library.decode(ids).encode()).hexdigest()],
        )
    assert asked == [40, 20]


def test_pieces_odd_rows(odd_documents, no_documents):
    path = public_tokenizers.path("piece_bpe_32k.model")
    rows = pieces.encode(odd_documents, path).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in odd_documents.collect()}
    assert len(rows) == odd_documents.count()
    assert all(r["decoded"] == texts[r["doc_id"]] and r["ids"][-1] == 2 for r in rows)
    assert pieces.encode(no_documents, path).count() == pieces.digests(no_documents, path).count() == 0


def test_ids_equal_the_library():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    library.encode_special_tokens = True
    texts = odd_texts(1500, " \n\tabc the ing'sé日😀<|endoftext|>0123\x00\xa0  \x1c\x85.,!  ")
    flat, ends = token_files.Encoder(path).encode(texts)
    assert [flat[a:b].tolist() for a, b in zip(ends, ends[1:])] == [
        e.ids for e in library.encode_batch(texts, add_special_tokens=False)
    ]


def test_ids_of_added_tokens_equal_the_library():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    end = "<|endoftext|>"
    texts = ["plain text", f"a {end} b", f"one   {end}two", end, f"{end}{end} x", f"   {end}", "", f"{end[:-1]} >", "the end"]
    flat, ends = token_files.Encoder(path).encode(texts)
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [flat[a:b].tolist() for a, b in zip(ends, ends[1:])] == want
    assert library.token_to_id(end) in want[1]


def test_sequences_are_views_of_the_file(folder):
    ids = np.arange(5000, dtype=np.uint16)
    with pa.OSFile(f"{folder}/x.arrow", "wb") as sink:
        writer = token_files.SequenceWriter(sink, np.uint16, length=64, batch=8)
        for first in range(0, 5000, 700):
            writer.add(ids[first : first + 700])
        assert writer.close() == 5000
    with pa.memory_map(f"{folder}/x.arrow") as data:
        before = pa.total_allocated_bytes()
        file = token_files.SequenceFile(data)
        values, mask = file.sequence(3, batch=8)
        assert values.tolist() == list(range(192, 256)) and mask.all()
        assert pa.total_allocated_bytes() - before < 1024
        values, mask = file.sequence(78, batch=8)
        assert mask.sum() == 5000 - 78 * 64
        assert np.concatenate(list(file.batches())).tolist() == ids.tolist()


def test_token_files(spark, folder, odd_documents, no_documents):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    library.encode_special_tokens = True
    got = token_files.read_documents(token_files.write_files(odd_documents, f"file://{folder}/t", path, length=128)).collect()
    at = 0
    texts = {r["doc_id"]: r["text"] or "" for r in odd_documents.collect()}
    rows = sorted(got, key=lambda r: r["start"])
    assert [r["key"] for r in rows] == sorted([k for k in texts if k is not None] + [2], key=lambda k: k) if None not in texts else True
    for row in rows:
        ids = [*library.encode(texts[row["key"]], add_special_tokens=False).ids, 2]
        assert (row["start"], row["n_tokens"]) == (at, len(ids))
        assert row["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)
    assert len(rows) == odd_documents.count()
    assert rows[0]["key"] is None and [r["key"] for r in rows[1:]] == [1, 2, 2, 3, 4, 5, 6, 7, 8]
    assert token_files.read_documents(token_files.write_files(no_documents, f"file://{folder}/n", path)).count() == 0


# -- replicas -------------------------------------------------------------------------------------


def test_audit_finds_the_damage(spark, folder):
    rng = random.Random(8)
    rows = [(i, f"http://h/{i}", "".join(rng.choice("abcdef<>") for _ in range(rng.randint(0, 9000)))) for i in range(300)]
    rows += [(300, None, None), (301, "", ""), (301, "", ""), (302, "u\r\nX: y", "é" * 50_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    one, two = f"file://{folder}/one", f"file://{folder}/two"
    index = warc_audit.write_warc(pages, one)
    warc_audit.copy_replica(index, one, two, F.col("key").isin(5, 77, 302))
    found = warc_audit.audit(index, one, two)
    assert sorted(r["key"] for r in index.join(found, ["file", "offset"]).collect()) == [5, 77, 302]
    assert warc_audit.audit(index, one, one).count() == 0
    read = {r["key"]: r["payload_sha256"] for r in warc_audit.payloads(index, one).collect()}
    assert read == {key: brute.sha((page or "").encode()) for key, _, page in rows}
    broken = warc_audit.payloads(index, two).where("payload_sha256 IS NULL").collect()
    assert {r["key"] for r in broken} == {5, 77, 302}
    # A replica that lacks a file differs in all its records.
    assert warc_audit.audit(index, one, f"file://{folder}/nothing").count() == len(rows)
    empty = warc_audit.write_warc(pages.where("1 = 0"), one)
    assert empty.count() == warc_audit.audit(empty, one, two).count() == 0
