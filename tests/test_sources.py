import datetime as dt
import io
import os
import zipfile

from pyspark.sql import functions as F

from eventloom.schemas import EVENTS, GKG
from eventloom.sources import readers, sinks, zips
from eventloom.streaming.arrivals import daily_append


def event_line(ident, day="20200101", code="061", tone="1.5"):
    values = dict(GLOBALEVENTID=ident, SQLDATE=day, EventCode=code, AvgTone=tone, NumArticles="4")
    return "\t".join(values.get(f.name, "") for f in EVENTS.fields)


def make_zip(path, members):
    with zipfile.ZipFile(path, "w") as archive:
        for name, text in members.items():
            archive.writestr(name, text)


def test_zips_first_member_bad_files_and_skipped_header(spark, folder):
    make_zip(f"{folder}/a.zip", {"readme.txt": "no", "a.CSV": event_line("1") + "\n" + event_line("2", code="0331") + "\n", "b.csv": event_line("9")})
    make_zip(f"{folder}/none.zip", {"readme.txt": "no"})
    with open(f"{folder}/broken.zip", "wb") as out:
        out.write(b"PK not a zip")
    make_zip(f"{folder}/bad.zip", {"bad.csv": event_line("3", tone="warm") + "\n" + event_line("4")})
    good, rejected = readers.split_quarantine(zips.read_zipped_members(spark, folder, EVENTS))
    rows = good.select("GLOBALEVENTID", "EventCode", "AvgTone", "NumArticles", "source_file").orderBy("GLOBALEVENTID").collect()
    assert [tuple(r) for r in rows] == [
        ("1", "061", 1.5, 4, "a.CSV"), ("2", "0331", 1.5, 4, "a.CSV"), ("4", "061", 1.5, 4, "bad.csv")]
    reasons = sorted(r[readers.CORRUPT] for r in rejected.collect())
    assert len(reasons) == 3
    assert any("no CSV member" in r for r in reasons) and any("BadZipFile" in r for r in reasons)
    assert any("warm" in r for r in reasons)


def test_checksum_failure_rejects_the_whole_member(spark, folder):
    target = io.BytesIO()
    with zipfile.ZipFile(target, "w", zipfile.ZIP_STORED) as archive:
        archive.writestr("x.csv", "\n".join(event_line(str(i)) for i in range(50)))
    data = bytearray(target.getvalue())
    data[2000] ^= 1
    with open(f"{folder}/x.zip", "wb") as out:
        out.write(data)
    good, rejected = readers.split_quarantine(zips.read_zipped_members(spark, folder, EVENTS))
    assert (good.count(), rejected.count()) == (0, 1)


def test_large_members_come_in_batches_and_can_be_spread(spark, folder, monkeypatch):
    lines = [event_line(str(i)) for i in range(1000)]
    make_zip(f"{folder}/x.zip", {"x.csv": "\r\n".join(lines)})
    for spread in (None, 5):
        good, _ = readers.split_quarantine(zips.read_zipped_members(spark, folder, EVENTS, spread=spread))
        assert sorted(int(r[0]) for r in good.select("GLOBALEVENTID").collect()) == list(range(1000))


def test_gkg_header_in_zip_and_file(spark, folder):
    header = "\t".join(f.name for f in GKG.fields)
    row = "\t".join(["20240822", "3", "", "TAX;PROTEST#", "", "", "", "", "", "", "u1<UDIV>u2"])
    make_zip(f"{folder}/g.zip", {"g.csv": f"{header}\n{row}\n"})
    os.mkdir(f"{folder}/plain")
    with open(f"{folder}/plain/g.csv", "w") as out:
        out.write(f"{header}\n{row}\n")
    zipped, _ = readers.split_quarantine(zips.read_zipped_members(spark, folder, GKG, skip_header=1))
    plain, bad = readers.split_quarantine(readers.read_gkg_tsv(spark, f"{folder}/plain"))
    for rows in (zipped, plain):
        r = rows.first()
        assert (r.NUMARTS, r.THEMES, r.SOURCEURLS, r.COUNTS) == (3, "TAX;PROTEST#", "u1<UDIV>u2", None)
    assert bad.collect() == []


def test_events_tsv_sets_bad_lines_aside(spark, folder):
    with open(f"{folder}/e.tsv", "w") as out:
        out.write(event_line("1") + "\n" + event_line("2", tone="x") + "\nshort\tline\n")
    good, rejected = readers.split_quarantine(readers.read_events_tsv(spark, folder).cache())
    assert [r.GLOBALEVENTID for r in good.collect()] == ["1"]
    assert rejected.count() == 2


def test_index_selection_tests_the_whole_line(spark):
    lines = ['<A HREF="20240822.gkg.csv.zip">daily</A>', '<A HREF="20240822.gkgcounts.csv.zip">daily</A>',
             '<A HREF="20240821.gkg.csv.zip">old</A>', "no link with gkg daily"]
    index = spark.createDataFrame([(x,) for x in lines], "value string")
    include = ["gkg"]
    terms = readers.previous_day_filter(include, dt.datetime(2024, 8, 23, 12))
    assert terms == ["gkg", "20240822"] and include == ["gkg"]
    urls = readers.select_source_files(index, "http://x.org/feed", terms, ["counts"]).collect()
    assert [r.url for r in urls] == ["http://x.org/feed/20240822.gkg.csv.zip"]
    assert readers.select_source_files(index, "http://x.org", ["daily"]).count() == 2


def test_reload_replaces_only_the_files_own_rows(spark, folder):
    def rows(*items):
        return spark.createDataFrame(items, "GLOBALEVENTID string, SQLDATE string, source_file string")

    path = f"{folder}/t"
    sinks.append_table(rows(("1", "20200101", "f1"), ("2", "20200102", "f1")), path, sort_col="SQLDATE")
    sinks.append_table(rows(("3", "20200101", "f2")), path)
    sinks.append_table(rows(("1", "20200101", "f1"), ("4", "20200102", "f1")), path)
    assert sorted(r[0] for r in spark.read.parquet(path).collect()) == ["1", "3", "4"]
    sinks.append_table(rows(("3", "20200101", "f2")), path, strict_append=True)
    assert sorted(r[0] for r in spark.read.parquet(path).collect()) == ["1", "3", "3", "4"]


def test_ctas_refuses_and_chunks_are_bounded(spark, folder):
    import pytest

    df = spark.range(25).coalesce(1)
    sinks.ctas(df, f"{folder}/c")
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        sinks.ctas(df, f"{folder}/c")
    sinks.append_in_chunks(df, f"{folder}/d", rows=10)
    parts = [n for n in os.listdir(f"{folder}/d") if n.endswith(".parquet")]
    assert len(parts) == 3 and spark.read.parquet(f"{folder}/d").count() == 25


def test_daily_append_takes_yesterday_once(spark, folder):
    os.mkdir(f"{folder}/zips")
    for day in ("20240113", "20240114"):
        make_zip(f"{folder}/zips/{day}.export.CSV.zip", {f"{day}.export.CSV": event_line(day, day) + "\n"})
    for _ in range(2):
        rejected = daily_append(spark, f"{folder}/zips", f"{folder}/t", EVENTS, dt.datetime(2024, 1, 16, 3), sort_col="SQLDATE")
    assert rejected.count() == 0
    rows = spark.read.parquet(f"{folder}/t").select("GLOBALEVENTID", "source_file").collect()
    assert [tuple(r) for r in rows] == [("20240114", "20240114.export.CSV")]


def test_wide_profile_becomes_long(spark, folder):
    wide = spark.createDataFrame(
        [(1, "actor_A", 0.9, "event_1", 0.8), (2, "event_2", 0.5, None, None)],
        "rank int, feature_Centroid1 string, appereance_Centroid1 double, feature_Centroid2 string, appereance_Centroid2 double",
    )
    long = readers.long_profile(wide, 2).orderBy("cluster", "rank").collect()
    assert [tuple(r) for r in long] == [(1, 1, "actor_A", 0.9), (1, 2, "event_2", 0.5), (2, 1, "event_1", 0.8)]


def test_profile_ranks_run_over_all_files(spark, folder):
    names = [f"{kind}_Centroid{i}" for i in (1, 2) for kind in ("feature", "appereance")]
    for part, rows in enumerate([[("a", 0.9, "b", 0.8), ("c", 0.7, "d", 0.6)], [("e", 0.5, "", "")]]):
        with open(f"{folder}/part-{part}.csv", "w") as out:
            out.write("\n".join([",".join(names), *[",".join(map(str, r)) for r in rows]]) + "\n")
    got = readers.read_cluster_profile(spark, folder, 2).orderBy("cluster", "rank").collect()
    assert [(r.cluster, r["rank"], r.feature) for r in got] == [(1, 1, "a"), (1, 2, "c"), (1, 3, "e"), (2, 1, "b"), (2, 2, "d")]


def test_calendar(spark, folder):
    with open(f"{folder}/c.csv", "w") as out:
        out.write("Date,Event\n20200311,Something declared\n")
    assert tuple(readers.read_calendar(spark, folder).first()) == ("20200311", "Something declared")


def test_write_edges_header_is_positions(spark, folder):
    sinks.write_edges(spark.createDataFrame([("a", "b", "e", "centroid_1")], "src string, dst string, event string, centroid string"), f"{folder}/g")
    assert spark.read.csv(f"{folder}/g", header=True).columns == ["0", "1", "2", "3"]


def test_a_text_is_joined_once_and_rows_stay_those_of_two_joins(spark, folder):
    """Pages that are absent, repeated or without a number, documents below zero, repeated or without one."""
    from pyspark.sql import functions as F

    from eventloom.catalog.ingestion import gkg_rows

    pages = [(0, "u0"), (1, "u1"), (1, "again"), (3, None), (None, "x"), (-1, "below")]
    docs = [(i, f"word{i}", "en", "s", 100) for i in (0, 1, 2, 3, 4, 5, 1, None, -1, -2, -6, 11)]
    spark.createDataFrame(pages, "page_id long, url string").write.parquet(f"{folder}/pages.parquet")
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    rem = lambda i: i if i is None else int(i - 6 * int(i / 6))
    found = lambda key: [u for p, u in pages if key is not None and p == key] or [None]
    want = []
    for i, *_ in docs:
        for a in found(rem(i)):
            for b in found(None if i is None else rem(i + 1)):
                want.append((None if i is None else str(i), "<UDIV>".join(u for u in (a, b) if u) or None))
    rows = gkg_rows(spark, folder)
    assert sorted(map(str, want)) == sorted(str((r.SOURCES, r.SOURCEURLS)) for r in rows.collect())

    def carriers(node):
        names = [node.output().apply(i).name() for i in range(node.output().size())]
        own = node.nodeName() == "Join" and "text" in names
        return own + sum(carriers(node.children().apply(i)) for i in range(node.children().size()))

    assert carriers(rows._jdf.queryExecution().optimizedPlan()) == 1


def test_settled_tables_are_packed(spark):
    from eventloom.session import settle

    assert all(name.endswith(".zstd.parquet") for name in settle(spark.range(10).toDF("n")).inputFiles())
