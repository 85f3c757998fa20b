"""Running sums against plain loops, with keys that span many ranges."""

from itertools import groupby

import pytest
from pyspark.sql import functions as F

from touchline.operators.running import running


@pytest.mark.parametrize("partitions", [1, 3, 17])
def test_running_sums_of_hot_and_small_keys(spark, partitions):
    # One key with half of the rows, all at one place in the order; others with a few rows.
    rows = [("hot", 0, 1)] * 400 + [(f"k{i % 40}", i, i % 7) for i in range(400)]
    df = spark.createDataFrame(rows, "k string, t int, v int").repartition(5)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = running(df, ["k"], [F.col("t")], {"place": F.lit(1), "total": F.col("v")}).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    wanted = []
    for _, group in groupby(sorted(rows), key=lambda r: r[0]):
        total = 0
        for place, (k, t, v) in enumerate(group, 1):
            total += v
            wanted.append((k, t, v, place, total))
    assert sorted(map(tuple, out)) == sorted(wanted)


def test_running_sum_of_a_whole_table(spark):
    df = spark.createDataFrame([(x,) for x in "banana"] + [(None,)], "x string")
    out = running(df, [], [F.col("x").asc_nulls_last()], {"place": F.lit(1)})
    assert sorted((r["place"], r["x"]) for r in out.collect()) == list(enumerate(["a", "a", "a", "b", "n", "n", None], 1))
    assert running(df.limit(0), [], [F.col("x")], {"place": F.lit(1)}).count() == 0
