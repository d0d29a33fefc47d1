"""Tables that change together, and counts that a file adds to."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from eventloom.operators.analysis import corr_matrix, daily_category_counts
from eventloom.operators.features import token_counts, vocab_by_coverage
from eventloom.plans.increments import add_daily_counts, add_token_counts, merged_daily_counts, merged_token_counts
from eventloom.plans.relevant_news import NewsTables, news_pipeline
from eventloom.sources.snapshots import Conflict, TableSet


def rows(spark, *values):
    return spark.createDataFrame(list(values), "day string, x int, source_file string")


def content(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_parts_are_replaced_and_versions_stay(spark, folder):
    tables = TableSet(spark, folder)
    schema = rows(spark, ("", 0, "")).schema
    assert tables.version() == 0 and tables.read("t", schema).count() == 0
    tables.put("t", rows(spark, ("20240101", 1, "a"), ("20240102", 2, "a"), ("20240105", 3, "b")), day="day")
    seen = tables.read("t", schema)
    tables.put("t", rows(spark, ("20240103", 9, "a")), day="day")
    assert content(seen) == [("20240101", 1, "a"), ("20240102", 2, "a"), ("20240105", 3, "b")]  # what a reader has, stays
    assert content(tables.read("t", schema)) == [("20240103", 9, "a"), ("20240105", 3, "b")]
    assert content(tables.read("t", schema, version=1)) == content(seen)
    assert tables.put("t", rows(spark, ("", 0, "")).limit(0)) == 2


def test_a_range_of_days_opens_only_its_files(spark, folder):
    tables = TableSet(spark, folder)
    some = rows(spark, *[(f"202401{d:02d}", d, f"f{d // 5}") for d in range(1, 31)])
    tables.put("t", some, day="day")
    found = tables.read("t", some.schema, between=("20240111", "20240113"))
    assert {r.source_file for r in found.collect()} == {"f2"} and len(found.inputFiles()) < len(tables.read("t", some.schema).inputFiles())
    odd = rows(spark, ("20240101", 1, None), (None, 2, "a/b =%"))
    tables.put("odd", odd, day="day")
    assert sorted(map(str, content(tables.read("odd", odd.schema)))) == sorted(map(str, content(odd)))


def test_both_tables_or_none(spark, folder, monkeypatch):
    """The second write fails: a reader sees both old tables. Afterwards both change at once."""
    tables = TableSet(spark, folder)
    one = lambda n: spark.createDataFrame([(n,)], "n int")
    tables.replace({"relevant_news": one(1), "dimension_reduction": one(1)})
    broken = one(2).select(F.raise_error(F.lit("disk full")).cast("int").alias("n"))
    from eventloom.plans import relevant_news as plan

    for second, fails in ((broken, True), (one(2), False)):
        monkeypatch.setattr(plan, "relevant_news_tables", lambda *a, s=second, **k: NewsTables(s, one(2), 2))
        if fails:
            with pytest.raises(Exception, match="disk full"):
                news_pipeline(one(0), one(0), folder)
        else:
            news_pipeline(one(0), one(0), folder)
        want = 1 if fails else 2
        assert [tables.read(t).first().n for t in ("relevant_news", "dimension_reduction")] == [want, want]
    assert tables.version() == 2


def test_of_two_writers_of_a_version_one_is_told(spark, folder, monkeypatch):
    tables, other = TableSet(spark, folder), TableSet(spark, folder)
    tables.replace({"t": spark.range(1)})
    monkeypatch.setattr(TableSet, "version", lambda self: 1)
    results = []
    for who, n in ((tables, 2), (other, 3)):
        try:
            results.append((n, who.replace({"t": spark.range(n)})))
        except Conflict:
            results.append((n, None))
    winners = [n for n, v in results if v]
    monkeypatch.undo()
    assert tables.read("t").count() == winners[-1]


def test_token_counts_by_file_equal_a_recount(spark, folder):
    """After each of three files, after one of them came again, and after one came without any token."""
    tables, held = TableSet(spark, folder), {}
    loads = [("a", ["x;y", "x#zz"]), ("b", ["y; y ;q", None]), ("c", ["1;2;x"]), ("a", ["zz;zz"]), ("b", [""])]
    for name, texts in loads:
        df = spark.createDataFrame([(t, name) for t in texts], "text string, source_file string")
        held[name] = texts
        add_token_counts(tables, df, cols=["text"])
        every = spark.createDataFrame([(t, n) for n, ts in held.items() for t in ts], "text string, source_file string")
        recount = token_counts(every, ["text"])
        assert content(merged_token_counts(tables)) == content(recount)
        assert content(vocab_by_coverage(merged_token_counts(tables))) == content(vocab_by_coverage(recount))


def test_daily_series_by_file_equal_recomputation(spark, folder):
    """Days spread over files, a replaced file, a file that no longer counts, and the correlations that follow."""
    import random

    rng, tables, held = random.Random(1), TableSet(spark, folder), {}
    codes = {"one": ["a", "b"], "two": ["c"], "three": ["d"]}
    series = {"One": "one", "Two": "two", "Three": "three", "Tone": "avg_tone"}
    schema = "day date, code string, tone double, keep boolean, source_file string"

    def load(keep=True):
        return [
            (dt.date(2024, 1, rng.randrange(1, 9)), rng.choice("abcde"), rng.choice([None, rng.random() * 10]), keep) for _ in range(40)
        ]

    for name, part in [("f1", load()), ("f2", load()), ("f3", load()), ("f2", load()), ("f1", load(False))]:
        held[name] = part
        frame = lambda ps: spark.createDataFrame([(*r, n) for n, p in ps for r in p], schema)
        options = dict(date=F.col("day"), code="code", categories=codes, tone="tone", where=F.col("keep"))
        add_daily_counts(tables, frame([(name, part)]), **options)
        want = daily_category_counts(frame(held.items()), **options)
        got = merged_daily_counts(tables, categories=codes)
        a, b = ({r.date: tuple(r)[1:] for r in d.select("date", *codes, "avg_tone").collect()} for d in (got, want))
        assert a.keys() == b.keys() and all(a[d] == pytest.approx(b[d], abs=1e-12) for d in a)
        m, n = ({(r.type1, r.type2): r.correlation for r in corr_matrix(d, series).collect()} for d in (got, want))
        assert m == pytest.approx(n, abs=1e-12)
    some = merged_daily_counts(tables, categories=codes, between=("2024-01-03", "2024-01-04"))
    assert {r.date.day for r in some.collect()} <= {3, 4}
