"""Quoted line breaks in files read by splits, against a read of the whole file; rejects with counts."""

import csv
import io
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from touchline.operators import split
from touchline.sources import quoted, ragged, tables


@pytest.fixture
def small_splits(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(64 << 10))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def body(n, seed, ends="\n"):
    """Rows of three fields with breaks, quotes and commas; some fields are longer than a split."""
    rng = random.Random(seed)
    pieces = ["a", "b ", ",", '"', "\n", "\n\n", "é", "x" * 50]
    rows = []
    for i in range(n):
        free = "".join(rng.choice(pieces) for _ in range(rng.randrange(12)))
        if i in (n // 3, n // 2):
            free = ('line of "text"\n' * 9000) + free
        rows.append([str(i), free, rng.choice(["", "end", 'quo"te'])])
    out = io.StringIO()
    csv.writer(out, lineterminator=ends).writerows([["id", "text", "tail"], *rows])
    return out.getvalue(), rows


@pytest.mark.parametrize("ends", ["\n", "\r\n"])
def test_splits_equal_a_read_in_one_piece(spark, tmp_path, small_splits, ends):
    text, rows = body(12_000, 1, ends)
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.csv").write_bytes(text.encode())
    (tmp_path / "in/b.csv").write_bytes(("id,text,tail\n" + '"last ""one""\nof all",,').encode())
    found = tables.scan_lenient(spark, str(tmp_path / "in"))
    records = quoted.quoted_records(spark, str(tmp_path / "in"))
    assert records.select("file", "split").distinct().count() > 5
    wanted = [tuple(x or None for x in r) for r in rows] + [('last "one"\nof all', None, None)]
    assert sorted(map(str, found.collect())) == sorted(str(r) for r in spark.createDataFrame(wanted, "id string, text string, tail string").collect())


def test_states_compose():
    rng = np.random.default_rng(0)
    outside, inside = rng.random(200) < 0.3, rng.random(200) < 0.7
    for start in (False, True):
        state, wanted = start, []
        for a, b in zip(outside, inside, strict=True):
            state = bool(b if state else a)
            wanted.append(state)
        assert quoted.walk(outside, inside, start).tolist() == wanted


@pytest.mark.parametrize(
    ("line", "open_"),
    [("", False), ("a,b", False), ('"a', True), ('a,"b', True), ('"a""', True), ('"a"', False), ('"a","b', True), ('5" pipe,x', False), ('x,5"', False), ('"a"b,"c', True), (",,\"", True)],
)
def test_open_fields(spark, line, open_):
    df = spark.createDataFrame([(line,)], "v string")
    assert df.select(quoted._ends_inside(F.col("v")).alias("o")).first()["o"] is open_


def test_unclosed_quote_and_wide_rows_are_counted(spark, tmp_path):
    (tmp_path / "a.csv").write_text('a,b\n1,2\n3,4,5\n6,"x\ny"\n7\n\n8,"never\nclosed\n9,9')
    (tmp_path / "b.csv").write_text('a,b\n10,11\n')
    found = tables.scan_screened(spark, str(tmp_path), ["a", "b"])
    assert found.counts == {"unclosed_quote": 3, "too_wide": 1}
    assert sorted(tuple(r) for r in found.kept.collect()) == [("1", "2"), ("10", "11"), ("6", "x\ny"), ("7", None)]
    assert sorted(tuple(r) for r in found.rejects.collect()) == [
        ("too_wide", "3,4,5"), ("unclosed_quote", '8,"never'), ("unclosed_quote", "9,9"), ("unclosed_quote", "closed"),
    ]
    assert tables.scan_lenient(spark, str(tmp_path), ["a", "b"]).count() == 4


def test_empty_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    (tmp_path / "b.csv").write_text("a,b\n")
    assert tables.scan_lenient(spark, str(tmp_path), ["a", "b"]).count() == 0
    assert tables.scan_screened(spark, str(tmp_path), ["a", "b"]).counts == {"unclosed_quote": 0, "too_wide": 0}


def test_screened_lines_and_seasons(spark):
    lines = spark.createDataFrame([("a,b",), ("1,2,3,4,5,6,7,8",), ("",)], "value string")
    found = ragged.screened_lines(lines)
    assert found.counts == {"shorter_than_tail": 2} and found.kept.columns == ["value"] and found.kept.count() == 1
    seasons = spark.createDataFrame([(1, "2010"), (2, "x"), (3, None), (4, "201o")], "id int, season_end string")
    told = split.screened_slices(seasons)
    assert told.counts == {"season_not_a_number": 2} and told.kept.count() == 2
    assert sorted(r["reject_record"] for r in told.rejects.collect()) == ['{"id":2,"season_end":"x"}', '{"id":4,"season_end":"201o"}']
