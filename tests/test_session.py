"""Cutting lineage."""

from pyspark.sql import functions as F

from panelwright.session import cut


def test_size_estimates_do_not_grow_over_rounds(spark):
    df = cut(spark.range(10).select("id", (F.col("id") % 3).alias("j")))
    for _ in range(6):
        other = df.select(F.col("id").alias("j"), F.col("j").alias("k"))
        df = cut(df.join(other, "j", "left").select("id", F.col("k").alias("j")))
    assert df.count() == 10
    assert df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() < 10**20


def test_cut_keeps_rows_and_types(spark):
    df = spark.sql("SELECT 1 AS a, cast(null AS string) AS b, array(struct(1 AS x)) AS c UNION ALL SELECT 2, '', array()")
    got = cut(df)
    assert got.schema.simpleString() == df.schema.simpleString()
    assert sorted(map(str, got.collect())) == sorted(map(str, df.collect()))
    assert "checkpoint" not in got._jdf.queryExecution().logical().toString().lower()


def test_small_files_of_many_rows_do_not_pass_through_the_driver(spark):
    """A text that repeats takes a bit a row in a file and dozens of bytes in memory; the join is planned by the rows."""

    def plan(n):
        small = cut(spark.range(n).select((F.col("id") % 7).alias("j"), F.lit("a text that repeats in every row").alias("t")))
        assert small.count() == n
        return spark.range(10**7).join(small.where("t <> ''").select(F.col("j").alias("id"), "t"), "id")._jdf.queryExecution().sparkPlan().toString()

    assert "BroadcastHashJoin" in plan(100)
    assert "BroadcastHashJoin" not in plan(600_000)
