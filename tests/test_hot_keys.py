"""Operators stay exact when one key holds a third of all rows."""

from pyspark.sql import functions as F

from hiresight.operators.enrich import add_company_features
from hiresight.operators.relational import keep_first
from hiresight.operators.sampling import sample_exact_per_group


def _skewed(spark, n=30000):
    # a third of the rows share company '' and title 'x' (the hot key)
    return spark.range(n).select(
        F.col("id").alias("post_id"), (F.col("id") % 2).cast("int").alias("source_rank"),
        F.when(F.col("id") % 3 == 0, F.lit("")).otherwise(F.concat(F.lit("c"), (F.col("id") % 997).cast("string")))
        .alias("company"),
        F.when(F.col("id") % 3 == 0, F.lit("x")).otherwise((F.col("id") % 13).cast("string")).alias("title"),
        F.when(F.col("id") % 3 == 0, F.lit("Junior")).otherwise(F.lit("Senior")).alias("level"))


def test_keep_first_with_hot_key(spark):
    df = _skewed(spark).repartition(16)
    out = keep_first(df, ["title", "company"], ["source_rank", "post_id"])
    hot = out.where((F.col("company") == "") & (F.col("title") == "x")).collect()
    assert len(hot) == 1 and hot[0]["post_id"] == 0
    assert out.count() == df.select("title", "company").distinct().count()


def test_company_size_with_hot_company(spark):
    df = _skewed(spark).repartition(16)
    out = add_company_features(df)
    sizes = {r[0]: r[1] for r in out.where(F.col("company").isin("", "c1")).select("company", "company_size")
             .distinct().collect()}
    assert sizes[""] == 10000
    assert out.count() == 30000


def test_exact_sample_of_hot_group(spark):
    df = _skewed(spark).repartition(16)
    targets = spark.createDataFrame([("Junior", 7000), ("Senior", 100)], "level string, target long")
    got = {r[0]: r[1] for r in sample_exact_per_group(df, ["level"], targets).groupBy("level").count().collect()}
    assert got == {"Junior": 7000, "Senior": 100}
