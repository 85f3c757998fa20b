"""Tables written on the way: freed when asked for, and without their shuffles."""

from pathlib import Path

from pyspark.sql import functions as F

from touchline.session import drop_tables, materialise


def folder(table):
    return Path(table.inputFiles()[0].split(":", 1)[1]).parent


def test_only_the_named_tables_go(spark):
    first, second = (materialise(spark.range(n)) for n in (3, 5))
    gone, stays = folder(first), folder(second)
    drop_tables(first)
    assert not gone.exists() and stays.exists() and second.count() == 5


def test_a_write_leaves_no_setting_behind(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    told = materialise(spark.range(100).groupBy((F.col("id") % 7).alias("k")).count())
    assert told.count() == 7 and spark.conf.get(key, None) == before
