import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from touchline.functions import casts, chance, html, text


def column(spark, values, fn, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    by_name = [r[0] for r in df.orderBy("i").select(fn("v")).collect()]
    by_column = [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]
    assert by_name == by_column
    return by_name


def test_int_from_text(spark):
    values = ["3", " 3 ", "3.0", "3.5", "-2.5", "1e2", "", None, "x", "1d", "9999999999", "nan"]
    assert column(spark, values, casts.to_int) == [3, 3, 3, 4, -3, 100, None, None, None, None, None, None]


def test_double_from_text(spark):
    assert column(spark, ["1.5", "1e-2", "2f", "2D", "", None], casts.to_double) == [1.5, 0.01, None, None, None, None]


def test_no_failing_cast(spark):
    """Text that is no number costs about what a number costs: a cast that fails raises within its task."""
    assert column(spark, ["\t5\n", "+5", "0x1p3", "Infinity", "1.", ".5e1"], casts.to_double) == [5, 5, 8, float("inf"), 1, 5]
    assert column(spark, ["\t5\n", "+5", "1.", "2147483648", "1 2", "5%", "-"], casts.to_int) == [5, 5, 1, None, None, None, None]
    cells = spark.range(300_000, numPartitions=1).select(F.col("id").cast("string").alias("n"), F.lit("").alias("blank")).persist()
    cells = cells.withColumn("blank", F.when(F.col("n") == "-1", "x").otherwise(F.col("blank")))

    def seconds(c):
        began = time.perf_counter()
        cells.agg(F.sum(casts.to_int(c)), F.count(F.lit(1))).collect()
        return time.perf_counter() - began

    seconds("n")
    assert min(seconds("blank") for _ in range(3)) < 2 * min(seconds("n") for _ in range(3))


def test_dates(spark):
    values = ["2001-9-1", "2001/09/01", "2001-09-01 10:00", "01/09/2001", "2001", "2001-13-01", None]
    day = dt.date(2001, 9, 1)
    assert column(spark, values, casts.to_date) == [day, day, day, None, None, None, None]
    assert column(spark, ["20250901", "2025-09-01", "20250901.0", "x"], casts.to_match_date) == [
        dt.date(2025, 9, 1),
        dt.date(2025, 9, 1),
        dt.date(2025, 9, 1),
        None,
    ]
    long = ["August 14, 2021", "May 7, 2018", "Sept 1, 2020", ""]
    assert column(spark, long, casts.to_long_date) == [dt.date(2021, 8, 14), dt.date(2018, 5, 7), None, None]


def test_clock(spark):
    values = ["9:05", "23:59", "24:00", "12:60", "late", "", None]
    assert column(spark, values, casts.to_seconds) == [9 * 3600 + 300, 86340, 0, 0, 0, 0, 0]


def test_name_variants(spark):
    df = spark.createDataFrame([("Alavés",), ("FC Köln",), ("Athletic Club",), ("A.C. Milan ",), ("Brøndby",)], "v string")
    got = {
        v: [r[0] for r in df.select(text.normalise_name("v", v)).collect()] for v in ("clean", "inspect", "build")
    }
    assert got["clean"] == ["alaves", "koln", "", "milan", "brndby"]
    assert got["inspect"] == ["alavs", "fc kln", "athletic club", "ac milan ", "brndby"]
    assert got["build"] == ["laves", "oln", "thletic lub", "ilan", "rndby"]
    with pytest.raises(ValueError):
        text.normalise_name("v", "other")


def test_accents(spark):
    df = spark.createDataFrame([("ÀéîõüñçŠžŐ ø ß Æ é",)], "v string")
    assert df.select(text.fold_accents("v")).first()[0] == "AeiouncSzO ø ß Æ e"


def test_titles(spark):
    rows = [
        ("Leeds vs. Hull Match Report – Monday May 7, 2018",),
        ("Leeds vs Hull",),
        ("Leeds–Hull Match Report",),
        ("Leeds",),
        ("",),
        (None,),
    ]
    df = spark.createDataFrame(rows, "t string")
    got = df.select(text.title_home("t"), text.title_away("t"), text.title_date("t")).collect()
    assert [tuple(r) for r in got] == [
        ("Leeds", "Hull", "May 7, 2018"),
        ("Leeds", "Hull", None),
        ("Leeds", "Hull", None),
        ("Leeds", None, None),
        (None, None, None),
        (None, None, None),
    ]


def test_html_text(spark):
    df = spark.createDataFrame([("<h1 class='a'> <b>A &amp; B</b> vs. &#233;&lt;C </h1><!-- <p>x</p> -->",)], "h string")
    row = df.select(html.first_heading("h"), html.open_comments("h")).first()
    assert row[0] == "A & Bvs. é<C"
    assert row[1].endswith(" <p>x</p> ")
    none = spark.createDataFrame([("<h2>x</h2>",)], "h string").select(html.first_heading("h")).first()[0]
    assert none is None


def test_first_maximum_ties_and_gaps(spark):
    df = spark.createDataFrame([(1.0, 1.0, 0.0), (0.0, None, 5.0), (0.0, 1.0, 2.0)], "a double, d double, h double")
    got = [r[0] for r in df.select(chance.first_maximum([F.col(c) for c in "adh"], ("A", "D", "H"))).collect()]
    assert got == ["A", "D", "H"]


def test_kelly(spark):
    df = spark.createDataFrame([(0.6, 2.0), (0.4, 2.0), (0.6, 1.0), (0.6, None)], "p double, o double")
    got = [r[0] for r in df.select(chance.kelly_fraction(F.col("p"), F.col("o"))).collect()]
    assert got == [pytest.approx(0.2), 0.0, 0.0, 0.0]


def test_character_references(spark):
    texts = {
        "Jos&eacute; &#x27;K&#39;": "José 'K'",
        "&#128512; &#x1F600;": "😀 😀",
        "&amp;lt; &lt; &nope; & &;": "&lt; < &nope; & &;",
        "&#0; &#xD800; &#99999999;": "\ufffd \ufffd \ufffd",
        "plain": "plain",
        "": "",
    }
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r[0]: r[1] for r in df.select("t", html.decode_entities("t")).collect()}
    assert got == texts
