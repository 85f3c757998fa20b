from pyspark.sql import functions as F

from touchline import session


def test_materialised_table_is_read_by_column_and_can_be_dropped(spark):
    before = len(session._written)
    df = session.materialise(spark.range(10).withColumn("x", F.col("id") * 2))
    assert df.count() == 10 and len(session._written) == before + 1
    plan = df.select("x")._jdf.queryExecution().executedPlan().toString()
    assert "parquet [x" in plan and "id#" not in plan
    empty = session.materialise(spark.range(0))
    assert empty.count() == 0 and empty.columns == ["id"]
    kept, session._written[:] = session._written[:before], session._written[before:]
    assert session.drop_materialised(spark) == 2
    session._written[:] = kept


def test_tune_keeps_what_the_user_set(spark):
    key = "spark.sql.codegen.hugeMethodLimit"
    spark.conf.set(key, "12345")
    assert session.tune(spark).conf.get(key) == "12345"
    spark.conf.set(key, "65535")
    assert session.tune(spark).conf.get(key) == "8000"
