import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.operators import players
from touchline.sources import pages, ragged, records, tables


def write(path, body):
    path.write_text(body, encoding="utf-8")
    return str(path)


def test_lenient_scan(spark, tmp_path):
    path = write(tmp_path / "a.csv", 'a,b,c\n1,"x, ""y""",3\n4,5\n6,7,8,9\n,,\n')
    rows = [tuple(r) for r in tables.scan_lenient(spark, path).collect()]
    assert sorted(rows, key=str) == [("1", 'x, "y"', "3"), ("4", "5", None), (None, None, None)]
    cut = [tuple(r) for r in tables.scan(spark, path).collect()]
    assert ("6", "7", "8") in cut
    assert set(tables.columns_of(tables.scan(spark, path)).values()) == {"string"}


def test_headerless_scan_and_types(spark, tmp_path):
    path = write(tmp_path / "b.csv", "1,2.5\n3,x\n")
    assert tables.scan_lenient(spark, path, ["a", "b"], header=False).count() == 2
    typed = tables.scan_typed(spark, write(tmp_path / "c.csv", "a,b\n1,2.5\n"))
    assert dict(typed.dtypes) == {"a": "int", "b": "double"}
    schema = T.StructType.fromDDL("a long, b string")
    assert dict(tables.scan_typed(spark, str(tmp_path / "c.csv"), schema).dtypes)["a"] == "bigint"


def test_first_existing(spark, tmp_path):
    path = write(tmp_path / "d.csv", "a\n")
    assert tables.first_existing(spark, [str(tmp_path / "none.csv"), path]) == path
    with pytest.raises(FileNotFoundError):
        tables.first_existing(spark, [str(tmp_path / "none.csv")])


def test_exports(spark, tmp_path):
    df = spark.createDataFrame([("a", ["x", "y"])], "k string, v array<string>")
    tables.export_csv(df, str(tmp_path / "out"))
    back = tables.scan(spark, str(tmp_path / "out")).first()
    assert json.loads(back["v"]) == ["x", "y"]
    tables.export_parquet(df, str(tmp_path / "pq"), ["k"])
    assert spark.read.parquet(str(tmp_path / "pq")).count() == 1


def test_append_once(spark, tmp_path):
    sink, done = str(tmp_path / "sink"), str(tmp_path / "done")
    schema = "league string, season int, v int"
    first = spark.createDataFrame([("L", 1, 10), ("L", 1, 11)], schema)
    late = spark.createDataFrame([("L", 1, 99), ("L", 2, 20)], schema)
    for rows, delivery in ((first, "a"), (late, "b"), (first, "a")):
        tables.append_once(rows, sink, done, ["league", "season"], delivery)
    assert sorted(r["v"] for r in spark.read.parquet(sink).collect()) == [10, 11, 20, 99]
    assert spark.read.parquet(done).distinct().count() == 3
    units = spark.createDataFrame([("L", 1), ("L", 3)], "league string, season int")
    assert [r["season"] for r in tables.pending_units(units, spark.read.parquet(done), ["league", "season"]).collect()] == [3]


def tail(kind, season, url="u"):
    return f'{url},L,S,{kind},T,"A vs. B, x",L,{season}'


def test_ragged_fields_and_tags(spark):
    lines = [
        'a,"b, ""c""",,' + tail("summary", 2018),
        "a," + tail("Keepers", 2017),
        "," + tail("summary", "x"),
        "too,short",
    ]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(lines)], "n int, value string")
    rows = {r["tag"]: r for r in ragged.split_ragged(df).collect()}
    assert set(rows) == {"summary_neu", "keeper_alt", "summary_alt"}
    assert rows["summary_neu"]["fields"] == ["a", 'b, "c"', ""]
    assert rows["summary_neu"]["match_title"] == "A vs. B, x"
    assert rows["summary_alt"]["fields"] == [""] and rows["summary_alt"]["season_end"] == "x"
    widths = {r["tag"]: r["width"] for r in ragged.header_widths(df, "n").collect()}
    assert widths == {"summary_neu": 11, "keeper_alt": 9, "summary_alt": 9}


def test_long_quoted_field_is_read_whole(spark):
    long = "x, " * 20_000
    df = spark.createDataFrame([(f'"{long}",' + tail("summary", 2019),)], "value string")
    assert ragged.split_ragged(df).first()["fields"] == [long]


def test_alignment_of_narrow_rows(spark):
    df = spark.createDataFrame([("a,b," + tail("summary", 2018, "url"),)], "value string")
    split = ragged.split_ragged(df)
    kept = ragged.to_columns(split, "summary_neu", 3).first()
    assert (kept["c02"], kept["c03"], kept["match_url"], kept["season_end"]) == ("b", None, "url", "2018")
    moved = ragged.to_columns(split, "summary_neu", 3, align="right_pad").first()
    assert (moved["c03"], moved["match_url"], moved["season_end"]) == ("url", "L", "")


def test_width_profile(spark):
    df = spark.createDataFrame([("a," + tail("s", 2018),), ("a," + tail("s", 2018),), ("x,y",)], "value string")
    got = {(r["season_end"], r["width"]): r["n_rows"] for r in ragged.width_profile(df).collect()}
    assert got == {(2018, 9): 2, (None, 2): 1}
    assert [r["width"] for r in ragged.top_widths(ragged.width_profile(df), 1).collect()] == [9]


def test_both_harmonisers_agree(spark):
    old = ["P", "1", "EN", "FW", "20", "90", *[str(i) for i in range(7, 24)]]
    new = ["Q", "1", "EN", "FW", "20", "90", *[str(i) for i in range(7, 26)], "81.5%", *[str(i) for i in range(27, 32)]]
    lines = [",".join(f) + "," + tail("summary", s) for f, s in ((old, 2010), (new, 2020))]
    lines += [",".join(["16 Players", *old[1:]]) + "," + tail("summary", 2010), "a," + tail("keeper", 2010)]
    split = ragged.split_ragged(spark.createDataFrame([(v,) for v in lines], "value string"))
    one = players.harmonise_split(split)
    two = players.harmonise_players(
        ragged.to_columns(split, "summary_alt", 23), ragged.to_columns(split, "summary_neu", 31)
    )
    assert one.dtypes == two.dtypes
    assert sorted(map(str, one.collect())) == sorted(map(str, two.collect()))
    rows = {r["player"]: r for r in one.collect()}
    assert rows["P"]["fls"] == 15 and rows["P"]["touches"] is None and rows["P"]["pkcon"] == 23
    assert rows["Q"]["pass_cmp_pct"] == 81.5 and rows["Q"]["touches"] == 15 and rows["Q"]["tklw"] is None
    team = players.team_aggregate(one).orderBy("season_end").collect()
    assert team[0]["gls_p90"] == pytest.approx(7.0) and team[0]["xg_sum"] is None


def test_page_tables_and_links(spark):
    html = (
        "<h1>A vs. B</h1><a href='/en/matches/1'>x</a><a href=\"/en/matches/1\">y</a><a href='/en/other'>z</a>"
        "<!-- <table id='stats_team-x_summary'><thead><tr><th>G</th></tr><tr><th>Player</th><th>Min</th></tr></thead>"
        "<tbody><tr><th>P <b>Q</b></th><td>90</td></tr></tbody></table> --><table id='other'><tr><td>1</td></tr></table>"
    )
    df = spark.createDataFrame([("u", html)], "url string, html string")
    row = pages.extract_tables(df).collect()
    assert len(row) == 1
    assert (row[0]["team_hint"], row[0]["table_type"], row[0]["header"], row[0]["cells"]) == (
        "team-x",
        "summary",
        ["Player", "Min"],
        ["P Q", "90"],
    )
    links = pages.extract_links(df, site="https://s").collect()
    assert [(r["position"], r["link"]) for r in links] == [(0, "https://s/en/matches/1")]
    lined = pages.table_lines(pages.extract_tables(df), F.lit("L"), F.lit("2019-2020"), F.lit(2020)).first()
    assert lined["match_title"] == "A vs. B" and lined["season_end"] == "2020"


def test_cells_as_a_reader_sees_them(spark):
    """Inline tags, breaks, spans, nested tables and character references, with values written by hand."""
    html = (
        "<table id='stats_a_summary'><thead><tr><th colspan=2>Name</th><th>Min</th></tr></thead>"
        "<tr><td>Heung-min <b>Son</b></td><td>a<br>b</td><td> 1 \n 2 </td></tr>"
        "<tr><td colspan='2'>Jos&eacute; &#x27;K&#39; &#128512;&amp;lt;</td><td rowspan=2>90</td></tr>"
        "<tr><td>x</td><td>y</td></tr>"
        "<tr><td>out <table id='stats_in_keeper'><tr><td>in</td><td>2</td></tr></table> side</td><td>&nope; &copy</td><td></td>"
        "</table>"
    )
    df = spark.createDataFrame([("u", html), ("v", None), ("w", "<table id='stats_b_summary'><tr><td>open")], "url string, html string")
    found = [(r["team_hint"], r["table_type"], r["table_no"], r["header"], r["cells"]) for r in pages.extract_tables(df).collect()]
    head = ["Name", "Name", "Min"]
    assert found == [
        ("a", "summary", 0, head, ["Heung-min Son", "a b", "1 2"]),
        ("a", "summary", 0, head, ["José 'K' 😀&lt;", "José 'K' 😀&lt;", "90"]),
        ("a", "summary", 0, head, ["x", "y", "90"]),
        ("a", "summary", 0, head, ["out in2 side", "&nope; ©", ""]),
        ("in", "keeper", 1, [], ["in", "2"]),
        ("b", "summary", 0, [], ["open"]),
    ]


def test_season_grid(spark):
    grid = pages.season_grid(pages.league_table(spark), 2024, 2025)
    assert grid.count() == 10
    row = grid.where("league_slug = 'Premier-League' and season_end = 2025").first()
    assert row["url"].endswith("/en/comps/9/2024-2025/schedule/2024-2025-Premier-League-Scores-and-Fixtures")


def test_records(spark):
    schema = T.StructType.fromDDL("match_date string, HomeElo double, OddHome double")
    body = json.dumps([{"match_date": "2025-09-01", "HomeElo": 1500}, {"OddHome": 2.1, "extra": 1}])
    rows = records.from_records(spark.createDataFrame([(body,)], "body string"), schema)
    assert rows.count() == 2
    out = [json.loads(r[0]) for r in records.to_payload(rows.withColumn("match_date", F.col("match_date").cast("date"))).collect()]
    assert out[0] == {"match_date": "2025-09-01", "HomeElo": 1500.0, "OddHome": None}
    nan = records.to_payload(spark.createDataFrame([(float("nan"),)], "x double")).first()[0]
    assert json.loads(nan) == {"x": None}


PIECES = (
    "<table id='stats_a_summary'>|<TABLE ID=stats_b_keeper class=x>|</table>|<tr>|</tr>|<td>|<td>t &amp;</td>|<td rowspan=2>u</td >|<td colspan=2>|</td>|"
    "<th COLSPAN=2/>|<thead>|</thead>|a|&nope|&#x27;|x < y|>|<br/>|<b>|</b>|<p class='a>b'>|<div|<!DOCTYPE html>|<!-- x -->|<script>v='<td>' < 3;</script>|"
    "<script/>|<style>|<title>t<td></title>|</>|<td a=b/>|<td a='1'b='2'>|<td id=1 colspan=1 colspan=3>|</table|&|<td colspan='&#50;'>"
).split("|")


def test_pages_read_by_tags_equal_pages_read_by_the_parser(monkeypatch):
    rng, fed = random.Random(5), []
    told = lambda tables: [(t.id, t.number, t.header, t.rows) for t in tables]
    for _ in range(2000):
        html = "<table id='stats_q_summary'>" + "".join(rng.choice(PIECES) for _ in range(rng.randrange(1, 30)))
        whole = pages._TableReader()
        whole.feed(html)
        whole.close()
        while whole.open:
            whole.handle_endtag("table")
        assert told(pages._read_tables(html)) == told(sorted(whole.done, key=lambda t: t.number)), html
    # A page of plain tags costs the parser nothing; it reads the odd ones alone.
    monkeypatch.setattr(pages._TableReader, "feed", lambda self, text: fed.append(text))
    page = "<p>x</p><table id='stats_a_summary'><tr><td class=\"x\">1 <b>2</b></td><td>&lt;</td></tr></table>"
    assert pages._read_tables(page)[0].rows == [["1 2", "<"]] and not fed
    pages._read_tables("<!DOCTYPE html>" + page)
    assert fed == ["<!DOCTYPE html>"]
