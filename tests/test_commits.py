"""Committed tables: a job killed between data and mark, repeated deliveries, empty and failed units."""

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.sources.commits import CommitTable, once
from touchline.streaming import ingest

SCHEMA = T.StructType().add("league", "string").add("season", "integer").add("v", "integer")


def table(spark, tmp_path):
    return CommitTable(spark, str(tmp_path / "t"), ("league", "season"), SCHEMA)


def rows(spark, *values):
    return spark.createDataFrame([("L", s, v) for s, v in values], SCHEMA)


def values(df):
    return sorted(r["v"] for r in df.collect())


def test_deliveries_and_states(spark, tmp_path):
    t = table(spark, tmp_path)
    units = spark.createDataFrame([("L", s) for s in range(1, 6)], "league string, season int")
    assert t.read().count() == 0 and t.pending(units).count() == 5
    t.append(rows(spark, (1, 10), (1, 11)), "a", asked=units.where("season <= 2"))
    t.append(rows(spark, (1, 99), (3, 30)), "b")
    t.fail(units.where("season = 4"), "timeout")
    assert values(t.read()) == [10, 11, 30, 99]
    assert {r["season"]: r["status"] for r in t.states().collect()} == {1: "complete", 2: "empty", 3: "complete", 4: "failed"}
    assert sorted(r["season"] for r in t.pending(units).collect()) == [2, 4, 5]
    # A delivery that comes again replaces its own rows only; a unit that was lost is complete once it came.
    t.append(rows(spark, (1, 12)), "a")
    t.append(rows(spark, (4, 40)), "c")
    assert values(t.read()) == [12, 30, 40, 99]
    assert sorted(r["season"] for r in t.pending(units).collect()) == [2, 5]


def test_a_job_killed_between_data_and_mark(spark, tmp_path, monkeypatch):
    t = table(spark, tmp_path)
    rows(spark, (1, 1), (2, 2)).coalesce(1).write.option("header", True).csv(str(tmp_path / "in" / "0"))

    def run():
        stream = ingest.read_stream(spark, str(tmp_path / "in" / "*"), SCHEMA)
        ingest.ingest_commits(stream, t, str(tmp_path / "marks")).awaitTermination()

    def die(self, manifest):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(CommitTable, "publish", die)
        with pytest.raises(StreamingQueryException):
            run()
    assert list((tmp_path / "t" / "data").iterdir())  # the data are there, and nobody sees them
    assert t.read().count() == 0 and t.states().count() == 0
    run()
    assert values(t.read()) == [1, 2]
    # Killed after the mark, before the stream's own: the batch runs again and replaces itself.
    for name in (tmp_path / "marks" / "commits").iterdir():
        name.unlink()
    run()
    assert values(t.read()) == [1, 2] and t.states().agg(F.sum("n_rows")).first()[0] == 2


def test_a_lost_race_takes_the_next_number(spark, tmp_path):
    t = table(spark, tmp_path)
    (tmp_path / "t" / "log" / "commit=7").mkdir(parents=True)
    t.append(rows(spark, (1, 1)), "a")
    assert (tmp_path / "t" / "log" / "commit=8").exists()


def test_folders_that_no_manifest_names_are_pruned(spark, tmp_path):
    t = table(spark, tmp_path)
    t.append(rows(spark, (1, 1)), "a")
    plan = t.read()._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower() or "BroadcastHashJoin" in plan


def test_repeats_within_the_watermark(spark, tmp_path):
    schema = "id int, at timestamp"
    for n, ids in enumerate(([1, 2, 2], [2, 3, 1])):
        spark.createDataFrame([(i,) for i in ids], "id int").select("id", F.lit("2024-01-01 00:00:00").cast("timestamp").alias("at")).coalesce(1).write.json(str(tmp_path / "in" / str(n)))
        stream = once(spark.readStream.schema(schema).json(str(tmp_path / "in" / "*")), ["id"], "at", "1 day")
        q = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "marks"))
        q.trigger(availableNow=True).start().awaitTermination()
    assert sorted(r["id"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [1, 2, 3]
