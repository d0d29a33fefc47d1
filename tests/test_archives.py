"""The archive data source, its streams, and files known by their content."""

import datetime as dt
import hashlib
import os
import shutil
import zipfile

import pytest
from pyspark.sql import types as T

from eventloom.sources import contents
from eventloom.sources.archives import archive_lines
from eventloom.sources.contents import content_digests
from eventloom.streaming.arrivals import BINARY, append_new_archives, daily_stream, on_new_content

ROW = T.StructType().add("a", T.LongType()).add("b", T.StringType())


@pytest.fixture(scope="module", autouse=True)
def by_value():
    import eventloom
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(eventloom)


def pack(path, text, member="data.CSV"):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        archive.writestr("about.txt", "x")
        archive.writestr(member, text)


def stored(spark, path):
    return sorted((r.a, r.b) for r in spark.read.schema(ROW).parquet(path).collect())


def test_lines_of_archives(spark, folder):
    src = f"{folder}/zips"
    os.mkdir(src)
    assert archive_lines(spark, src).count() == 0
    long = "\n".join(f"{i}\t{'x' * 100}" for i in range(60_000))
    pack(f"{src}/1.zip", long)
    pack(f"{src}/2.zip", "1\tone\r\n\r\n2\ttwo", "two.csv")
    pack(f"{src}/3.zip", "no", "readme.md")
    with open(f"{src}/4.zip", "wb") as broken:
        broken.write(open(f"{src}/1.zip", "rb").read()[:5000])
    with open(f"{src}/5.txt", "w") as other:
        other.write("1\tno archive")
    lines = archive_lines(spark, src)
    by_file = {os.path.basename(r.path): r for r in lines.groupBy("path").agg({"line": "count", "line_no": "max", "error": "max"}).collect()}
    assert sorted(by_file) == ["1.zip", "2.zip", "3.zip", "4.zip"]
    assert (by_file["1.zip"]["count(line)"], by_file["1.zip"]["max(line_no)"]) == (60_000, 59_999)
    assert by_file["2.zip"]["count(line)"] == 3 and by_file["3.zip"]["max(error)"] == "no CSV member"
    assert "BadZipFile" in by_file["4.zip"]["max(error)"] and by_file["4.zip"]["count(line)"] == 0
    assert lines.rdd.getNumPartitions() == 4 and archive_lines(spark, src, "2").count() == 3


def test_a_second_run_adds_nothing_and_a_new_archive_only_itself(spark, folder):
    src, table, check = f"{folder}/zips", f"{folder}/table", f"{folder}/check"
    os.mkdir(src)

    def run():
        append_new_archives(spark, src, table, ROW, check).awaitTermination()
        return stored(spark, table)

    pack(f"{src}/20240101.zip", "1\tone\nbad\tx\n", "20240101.CSV")
    pack(f"{src}/20240102.zip", "2\ttwo\n", "20240102.CSV")
    assert run() == [(1, "one"), (2, "two")]
    files = sorted(os.listdir(table))
    assert run() == [(1, "one"), (2, "two")] and sorted(os.listdir(table)) == files
    pack(f"{src}/20240103.zip", "3\tthree\n", "20240103.CSV")
    with open(f"{src}/20240104.zip", "wb") as broken:
        broken.write(b"PK nothing")
    assert run() == [(1, "one"), (2, "two"), (3, "three")]
    aside = spark.read.parquet(f"{check}-rejected").collect()
    assert {r.source_file for r in aside} == {"20240101.CSV", "unreadable"}


def test_daily_stream_takes_yesterday(spark, folder):
    src = f"{folder}/zips"
    os.mkdir(src)
    for day in (14, 15, 16):
        pack(f"{src}/202401{day}.export.CSV.zip", f"{day}\tx\n", f"202401{day}.export.CSV")
    for hour in (3, 4):  # 15 January on the feed's clock
        daily_stream(spark, src, f"{folder}/t", ROW, dt.datetime(2024, 1, 16, hour), f"{folder}/check").awaitTermination()
    assert stored(spark, f"{folder}/t") == [(14, "x")]
    daily_stream(spark, src, f"{folder}/t", ROW, dt.datetime(2024, 1, 17, 3), f"{folder}/check").awaitTermination()
    assert stored(spark, f"{folder}/t") == [(14, "x"), (15, "x")]


def test_the_same_content_under_another_name_is_taken_once(spark, folder):
    from test_news import news_inputs, write_file

    src, check, seen = f"{folder}/in", f"{folder}/check", []
    os.mkdir(src)
    rows = news_inputs(spark)[0].collect()

    def run():
        on_new_content(spark, src, check, lambda good: seen.append(good.count())).awaitTermination()

    write_file(f"{src}/a.csv", rows[:3])
    shutil.copy(f"{src}/a.csv", f"{src}/b.csv")
    run()
    assert seen == [3]
    shutil.copy(f"{src}/a.csv", f"{src}/c.csv")  # after a restart the digests are still known
    write_file(f"{src}/d.csv", rows[3:5])
    run()
    assert seen == [3, 2]


def test_files_are_hashed_through_open_files_and_never_read_as_values(spark, folder, monkeypatch):
    src, files = f"{folder}/in", {"a.csv": b"x", "b c%20#ü.csv": os.urandom(1000), "d.csv": os.urandom(300) * 7}
    os.mkdir(src)
    for name, content in files.items():
        with open(f"{src}/{name}", "wb") as out:
            out.write(content)
    want = {name: hashlib.sha256(content).hexdigest() for name, content in files.items()}
    read = lambda at: spark.read.format("binaryFile").schema(BINARY).load(at)
    told = lambda df: {r["path"].rsplit("/", 1)[1]: r["digest"] for r in df.collect()}
    hashed = content_digests(read(src), src)
    assert told(hashed) == want
    assert "content" not in hashed._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(contents, "CHUNK", 512)  # files of several pieces
    assert {name: contents.sha256_of(f"file:{src}/{name}") for name in files} == want
    # a store that only Spark reaches
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.digests.link./in", f"file://{src}")
    assert told(content_digests(read("viewfs://digests/in"), "viewfs://digests/in")) == want


def test_files_beyond_the_largest_value_come_through_the_stream(spark, folder):
    from test_news import news_inputs, write_file

    src, seen, limit = f"{folder}/in", [], "spark.sql.sources.binaryFile.maxLength"
    os.mkdir(src)
    write_file(f"{src}/a.csv", news_inputs(spark)[0].collect()[:3])
    spark.conf.set(limit, "10")
    try:
        on_new_content(spark, src, f"{folder}/check", lambda good: seen.append(good.count())).awaitTermination()
    finally:
        spark.conf.unset(limit)
    assert seen == [3]
