import datetime as dt

from pyspark.sql import functions as F

from eventloom.functions import columns as C
from eventloom.functions.paragraphs import paragraph_text_of
from eventloom.schemas import EVENTS, GKG


def one(spark, value, *exprs):
    return tuple(spark.createDataFrame([(value,)], "c string").select(*exprs).first())


def test_schema_shapes():
    kinds = [f.dataType.simpleString() for f in EVENTS.fields]
    assert (len(kinds), kinds.count("string"), kinds.count("bigint"), kinds.count("double")) == (58, 42, 7, 9)
    assert len(GKG.fields) == 11 and GKG["NUMARTS"].dataType.simpleString() == "bigint"


def test_strip_and_alpha_follow_python(spark):
    samples = [" PROTEST ", " x　", "TAX_X", "NEW YORK", "", "a1", "été", "\x1cz\x1f", "ß", "٣", "a\n"]
    rows = spark.createDataFrame([(s,) for s in samples], "c string").select(
        "c", C.strip("c"), C.is_alpha(C.strip("c")), C.is_alpha("c")
    ).collect()
    for raw, stripped, alpha, raw_alpha in rows:
        assert stripped == raw.strip()
        assert alpha == raw.strip().isalpha()
        assert raw_alpha == raw.isalpha()


def test_pieces_keep_empty_ones(spark):
    assert one(spark, "a#b;;c#", C.pieces("c"))[0] == ["a", "b", "", "c", ""]


def test_urls(spark):
    text = " <UDIV> u1 <UDIV>u2"
    assert one(spark, text, C.url_list("c"), C.first_url("c")) == (["", "u1", "u2"], "")
    assert one(spark, None, C.url_list("c"), C.first_url("c")) == (None, None)


def test_dates(spark):
    row = one(
        spark, "20201231", C.day_of("c"), C.date_of_parts("c"), C.season_position(C.day_of("c")),
        C.day_of(F.lit("2020xx31"), lenient=True),
    )
    assert row == (dt.date(2020, 12, 31), dt.date(2020, 12, 31), (360 + 31) / 365, None)


def test_bad_date_is_an_error(spark):
    import pytest

    with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP|INVALID"):
        one(spark, "20201341", C.day_of("c"))


def test_day_before_crosses_midnight_of_the_zone(spark):
    for text, expected in (("2024-01-16 03:00:00", "20240114"), ("2024-01-16 05:00:00", "20240115")):
        assert one(spark, text, C.day_before(F.col("c").cast("timestamp_ntz")))[0] == expected


def test_terms_quotes_paths(spark):
    line = '<A HREF="20240822.gkg.csv.zip">x</A>'
    assert one(
        spark, line, C.has_terms("c", ["gkg", "HREF"], ["export"]), C.has_terms("c", ["gkg"], ["zip"]), C.quoted("c")
    ) == (True, False, "20240822.gkg.csv.zip")
    assert one(spark, "no quotes", C.quoted("c"))[0] is None
    assert one(spark, "feed/a.csv", C.path_matches("c", "feed/"), C.path_matches("c", "other/"))== (True, False)


def test_paragraphs_nest_like_a_lenient_tree():
    assert paragraph_text_of("<p>a</p><p>b</p>") == "a b"
    assert paragraph_text_of("<div><p>a<p>b</p></div><p>c</p>") == "ab b c"
    assert paragraph_text_of("<div><p>a<p>b</p></div><p>c</p>", nested=False) == "a b c"
    assert paragraph_text_of("<div><p>a</div>outside<p>b") == "a b"
    assert paragraph_text_of("<p>x<br>y<img src=1>z</p></p>") == "xyz"
    assert paragraph_text_of("<p>a<script>var t='</p>';</script>b<style>p{}</style></p>") == "ab"
    assert paragraph_text_of("<p>&copy; 1 &lt; 2</p>") == "© 1 < 2"
    assert paragraph_text_of("<p>a <!-- hidden --> b</p>") == "a  b"
    assert paragraph_text_of("<p>a</p>\n  \n<p>  \n </p><p/>") == "a \n "
    assert paragraph_text_of("<div>none</div>") == ""
