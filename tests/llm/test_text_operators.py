"""Extraction, quality rules, decontamination and the URL filter."""

import html
import random
import re

import brute
import numpy as np
import pyarrow as pa
import pytest
from eventloom.llm import decontamination, html_text, quality, url_rules
from eventloom.llm.flat import SPACE_WORDS, Hasher, slices, words
from pyspark.sql import functions as F

ALPHABET = "ab cd\n\t\x0b éß日😀.,#|<X Y  "


def random_texts(n=300, seed=4):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 90))) for _ in range(n)] + ["", None, "a " * 50]


def test_words_and_fingerprints():
    texts = random_texts()
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["t"])
    seen = {}
    for limit in (50, 1 << 20):
        found = []
        for part in slices(batch, "t", limit):
            from eventloom.llm.flat import text_buffer

            data, offsets = text_buffer(part.column("t"))
            starts, ends, owner = words(data, offsets, SPACE_WORDS)
            prints = (h := Hasher(3)).ranges(h.prefixes(data), starts, ends)
            own = [[] for _ in range(part.num_rows)]
            for a, b, o, p in zip(starts, ends, owner, prints.tolist()):
                word = bytes(data[a:b]).decode()
                own[o].append(word)
                assert seen.setdefault(word, p) == p
            found += own
        assert found == [brute.SPACE_WORDS.findall(t or "") for t in texts]
    assert len(set(seen.values())) == len(seen)


def test_quality_counts():
    texts = random_texts() + ["a\nb\na\n\n\nb", "x y z " * 9, "w " * 8 + "q"]
    got = quality.measure(pa.array(texts))
    names = "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"
    assert list(zip(*(got[n].tolist() for n in names))) == [brute.base_counts(t) for t in texts]


def test_label_model_finds_accuracies():
    rng = np.random.default_rng(1)
    truth = rng.random(20_000) < 0.7
    accuracy = [0.95, 0.8, 0.7, 0.9]
    votes = np.stack([np.where(rng.random(len(truth)) < a, truth, ~truth) * 2 - 1 for a in accuracy], 1)
    votes[rng.random(votes.shape) < 0.3] = 0
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = quality.fit_label_model(patterns, counts, list("abcd"))
    assert abs(model.prior - 0.7) < 0.03
    for name, a in zip("abcd", accuracy):
        assert abs(model.accuracies()[name] - a) < 0.04


def test_label_model_without_rows():
    model = quality.fit_label_model(np.zeros((0, 2)), np.zeros(0), ["a", "b"])
    assert model.prior == 0.5


def test_quality_odd_rows(odd_documents, no_documents):
    judged = quality.judge(odd_documents)
    assert judged.count() == odd_documents.count()
    kept = quality.keep_good(odd_documents)
    assert kept.columns == odd_documents.columns
    assert kept.count() == judged.where("kept").count()
    assert quality.judge(no_documents).count() == quality.keep_good(no_documents).count() == 0


def test_quality_on_labels(spark):
    """The verdicts agree with the labels far better than the base rules alone."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = quality.judge(docs).where("NOT base_failed").join(labels, "doc_id").groupBy("quality", "kept").count().collect()
    got = {(r["quality"], r["kept"]): r["count"] for r in rows}
    assert got.get((1, False), 0) <= 0.01 * got[1, True]
    assert got.get((0, True), 0) <= 0.2 * got[0, False]


@pytest.mark.parametrize("limit", [1 << 20, 60])
def test_leaks(spark, limit):
    rng = random.Random(5)
    vocabulary = ["a", "B", "cé", "日", "x1", "it"]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, say(rng.randint(0, 14))) for i in range(12)] + [(50, None), (51, ""), (52, "?!"), (53, "it")]
    docs = [(i, say(rng.randint(0, 30)) + rng.choice(["", "!", " - ?", "\n"])) for i in range(80)]
    docs += [(90 + k, f"{say(3)}, {t}; {say(2)}") for k, (_, t) in enumerate(items) if t] + [(200, None), (201, "")]
    left = spark.createDataFrame(docs, "doc_id long, text string")
    right = spark.createDataFrame(items, "item_id long, text string")
    got = decontamination.find_leaks(left, right, limit=limit).select(
        "_key", "n_words", decontamination.hit_words(), F.size(F.array_distinct("item_ids")), decontamination.ids_digest()
    )
    assert sorted(map(tuple, got.collect())) == sorted(brute.leaks(docs, items))
    kept = {r["doc_id"] for r in decontamination.drop_leaks(left, right, limit=limit).collect()}
    assert kept == {key for key, _, hit, _, _ in brute.leaks(docs, items) if not hit}


def test_leak_spans_lie_in_the_original(spark):
    item = "one two three four five six seven eight nine ten"
    text = "Before... ONE, two -- three four (five) six seven eight nine TEN! after"
    docs, items = spark.createDataFrame([(1, text)], "doc_id long, text string"), spark.createDataFrame([(7, item)], "item_id long, text string")
    row = decontamination.find_leaks(docs, items).first()
    span = row["spans"][0]
    assert text.encode()[span["begin"] : span["end"]].decode() == "ONE, two -- three four (five) six seven eight nine TEN"


def test_leaks_odd_rows(spark, odd_documents, no_documents):
    items = spark.createDataFrame([(1, None), (2, "six seven"), (2, "six seven")], "item_id long, text string")
    assert decontamination.find_leaks(odd_documents, items).where("size(hit_ranges) > 0").count() == 3
    kept = decontamination.drop_leaks(odd_documents, items)
    assert kept.columns == odd_documents.columns and kept.count() == odd_documents.count() - 3
    assert decontamination.find_leaks(odd_documents, items.where("1 = 0")).where("size(hit_ranges) > 0").count() == 0
    assert decontamination.find_leaks(no_documents, items).count() == 0


def article(source):
    inner = re.search(r"<article>(.*?)</article>", source, re.DOTALL)[1]
    inner = re.sub(r"<[^>]*>", " ", re.sub(r"</?(p|h1)>", "\x00", inner))
    return "\n".join(t for t in (" ".join(html.unescape(b).split()) for b in inner.split("\x00")) if t)


def test_extraction_of_all_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    whole = {r["page_id"]: r["html"] for r in pages.collect()}
    for row in html_text.extract(pages).collect():
        assert row["text"] == article(whole[row["page_id"]])
        assert row["n_chars"] == len(row["text"])


PAGE = """<html><body><header><h1>Site</h1><nav><a href=x>Home</a></nav></header>
<div class="cookie-notice">We use cookies, fine?</div><div id="wrap"><div class="content"><h1>Title</h1>
<p>First, with &amp; and&nbsp;x.<p>Second   part<br>goes on, <a href=y>link</a> too.</p><form><p>Join</p><input></form>
<ul><li>item one<li>item two</ul><ul><li><a href=a>A</a><li><a href=b>B</a><li><a href=c>C</a></ul>
<blockquote>Quote, yes</blockquote><script>var p = "<p>no</p>"</script><!-- <p>no</p> --></div>
<div class="sidebar"><p>Side, long, text, with, commas, and, more, of, them, all</p></div>
<section id="comments"><p>Nice, thanks, a lot, really, very, good</p></section></div><footer>c</footer></body></html>"""


def test_extraction_of_parts():
    assert html_text.main_text(PAGE) == (
        "Title\nFirst, with & and x.\nSecond part goes on, link too.\nitem one\nitem two\nQuote, yes"
    )


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("<main><h1>T</h1><article><p>a, b</p><p>c</p></article><p class='notice'>n</p></main>", "T\na, b\nc"),
        ("<body><h1>Site</h1><article><section><h2>A</h2><p>x, y</p></section><section><p>z</p></section></article></body>", "A\nx, y\nz"),
        ("<div><div><p>one, two, three</p></div><div><p>four, five, six</p></div></div>", "one, two, three\nfour, five, six"),
        ("", ""),
        ("<p>", ""),
        ("plain &lt;text&gt;", "plain <text>"),
        ("<div>" * 5000 + "x, y" + "</span>" * 5000, "x, y"),
        ("<p>a</p><!-- open <p>b</p>", "a"),
        ("<p>a</p><script>var x = '<p>b</p>'", "a"),
    ],
)
def test_extraction_of_broken_pages(page, text):
    assert html_text.main_text(page) == text


def test_extraction_odd_rows(spark):
    rows = [(1, None, None, "c"), (2, "u", "", "c"), (2, "u", "", "c"), (None, "u", "<p>a b</p>", "c")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = html_text.extract(pages)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted(r["text"] for r in got.collect()) == ["", "", "", "a b"]
    assert html_text.extract(pages.where("1 = 0")).count() == 0


RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"))


def test_url_parts(spark):
    urls = ["http://A.B.com:80/x/y?q#f", "https://h", "ftp://H?x/y", "no scheme/x", None, "", "a://b#c/d", "x://y://z/w"]
    df = spark.createDataFrame([(u,) for u in urls], "url string").select("url", *url_rules.host_and_path("url"))
    got = [tuple(r)[1:] for r in df.collect()]
    assert got == [("a.b.com:80", "/x/y"), ("h", ""), ("h", ""), ("", ""), ("", ""), ("", ""), ("b", ""), ("y:", "//z/w")]


@pytest.mark.parametrize("per_array", [1 << 20, 2])
def test_url_filter(spark, monkeypatch, per_array):
    monkeypatch.setattr(url_rules.build_arrays, "__defaults__", (per_array,))
    monkeypatch.setattr(url_rules.probe, "__defaults__", (per_array,))
    urls = [
        ("http://a.bad.com/x", "block"),
        ("http://notbad.com/x", "allow"),
        ("http://bad.com", "block"),
        ("http://ok.net/page?x", "block"),
        ("http://ok.net/page/2", "allow"),
        ("http://bad.com.org/", "allow"),
        ("http://x.example.org/es/1", "block"),
        ("http://x.example.org/fr/1", "allow"),
        (None, "allow"),
        ("", "allow"),
        ("http://" + "a." * 3000 + "bad.com/", "block"),
    ]
    df = spark.createDataFrame([(u, v, "clash") for u, v in urls * 2], "url string, expected string, verdict string")
    listed = spark.createDataFrame([("bad.com",), ("ok.net/page",), ("x.org",), (None,), ("",), ("bad.com",)], "e string")
    got = url_rules.judge(df, listed, RULES).collect()
    assert len(got) == len(urls) * 2
    assert all(r["verdict"] == r["expected"] for r in got)
    assert url_rules.judge(df, listed.where("1 = 0"), RULES).where("verdict = 'block'").count() == 2
    assert url_rules.judge(df.where("1 = 0"), listed, RULES).count() == 0


def test_digest_collisions():
    keys = pa.array(["a", "b", "c", "dd"])
    same = np.array([5, 5, 5, 9], np.uint64)
    array = url_rules.DigestArray(url_rules.digest_array(keys, same))
    asked = pa.array(["c", "x", "dd", "a"])
    assert array.contains(asked, np.array([5, 5, 9, 5], np.uint64)).tolist() == [True, False, True, True]
    assert array.contains(asked, np.array([6, 6, 6, 10], np.uint64)).tolist() == [False] * 4


# -- wrappers and rounds --------------------------------------------------------------------------


@pytest.mark.parametrize(
    "wrapper", ["<div class='content has-sidebar'>", "<div id='page' class='header-fixed'>", "<div class='container no-sidebar'>"]
)
def test_wrappers_named_like_what_stands_beside(wrapper):
    paragraphs = [f"This is paragraph {i}, with words, commas and enough text to count as one." for i in range(8)]
    comments = "".join(f"<div class='comment'><p>Comment {i}, not a part of the text.</p></div>" for i in range(20))
    page = (
        f"<html><body><div id='header'>Site</div>{wrapper}<div class='sidebar'><p>Beside, and more.</p></div>"
        f"{''.join(f'<p>{p}</p>' for p in paragraphs)}<div id='comments'>{comments}</div></div><div id='footer'>Foot</div></body></html>"
    )
    assert html_text.main_text(page) == "\n".join(paragraphs)


def test_leaks_are_the_same_in_many_rounds(spark, odd_documents):
    more = [(None, "a six seven"), (None, "a six seven"), (None, None), (11, "two three"), (11, "six, seven! eight nine two three")]
    docs = odd_documents.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id long, text string"))
    items = [(1, None), (2, "six seven"), (2, "six seven"), (3, "eight nine"), (4, "two three"), (5, "some words")]
    items = spark.createDataFrame(items, "item_id long, text string")
    once = sorted(map(repr, decontamination.find_leaks(docs, items).collect()))
    rounds = decontamination.find_leaks(docs, items, limit=4)
    assert sorted(map(repr, rounds.collect())) == once
    assert len(once) == docs.count()


@pytest.mark.parametrize("attributes", ['class="col hidden xs"', "title='the hidden gem'", 'data-x="display:none"', 'class=hidden', 'aria-label="aria-hidden=true"'])
def test_words_in_values_do_not_hide(attributes):
    from eventloom.llm.html_text import is_hidden

    assert not is_hidden(" " + attributes)


@pytest.mark.parametrize("attributes", ["hidden", 'class="a" HIDDEN', "hidden=hidden", 'style="color:red; display : none"', "style='visibility:hidden'", 'aria-hidden="true"', "aria-hidden=true"])
def test_attributes_that_hide(attributes):
    from eventloom.llm.html_text import is_hidden

    assert is_hidden(" " + attributes)


def test_clean_texts_in_other_scripts_stay(spark, documents):
    import random

    from eventloom.llm import quality

    rng, rows = random.Random(4), []
    for i in range(60):
        letters = ["абвгдежзиклмнопрстуфхцчшыьэюя", "αβγδεζηθικλμνξοπρστυφχψω", "ابتثجحخدذرزسشصضطظعغفقكلمنهوي"][i % 3]
        word = lambda: "".join(rng.choice(letters) for _ in range(rng.randrange(2, 10)))
        lines = [" ".join([word().capitalize(), *(word() for _ in range(rng.randrange(5, 12)))]) + "." for _ in range(rng.randrange(6, 40))]
        rows.append((10**9 + i, " ".join(lines)))
    docs = spark.createDataFrame([*documents, *rows], "doc_id long, text string")
    kept = {r["doc_id"] for r in quality.keep_good(docs).collect()}
    assert {key for key, _ in rows} <= kept
