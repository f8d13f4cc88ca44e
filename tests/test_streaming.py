"""Incremental ingestion: restarts append nothing twice; new files add only unseen URLs."""

from pyspark.sql import functions as F

from hiresight.sources.feeds import scratch_path
from hiresight.streaming.incremental import run_incremental


def test_restart_and_new_files(spark):
    schema = "post_id long, source string, source_url string, title string"
    stored = spark.createDataFrame([(1, "a", "https://x.example/j/1.html?p=1", "t1")], schema)
    first = spark.createDataFrame([(2, "b", "https://x.example/j/1.html", "dup of stored"),
                                   (3, "b", "https://x.example/j/2.html#top", "new"),
                                   (4, "b", "https://x.example/j/2.html", "same url, later id")], schema)
    sink, src, ck = (scratch_path(spark, n) for n in ("t-sink", "t-src", "t-ck"))
    stored.write.parquet(sink)
    first.write.parquet(src)
    run_incremental(spark, src, sink, ck, stored.schema)
    ids = sorted(r[0] for r in spark.read.parquet(sink).select("post_id").collect())
    assert ids == [1, 3]
    # restart with nothing new: the checkpoint prevents re-processing
    run_incremental(spark, src, sink, ck, stored.schema)
    assert sorted(r[0] for r in spark.read.parquet(sink).select("post_id").collect()) == [1, 3]
    # a new file: only its unseen URL is appended
    spark.createDataFrame([(5, "b", "https://x.example/j/2.html", "seen"),
                           (6, "b", "https://x.example/j/3.html", "unseen")], schema) \
        .write.mode("append").parquet(src)
    run_incremental(spark, src, sink, ck, stored.schema)
    got = spark.read.parquet(sink)
    assert sorted(r[0] for r in got.select("post_id").collect()) == [1, 3, 6]
    assert got.select(F.countDistinct("source_url")).first()[0] == 3


def test_an_unreadable_sink_is_an_error_not_an_empty_one(spark):
    import pytest

    from hiresight.streaming.incremental import append_new_only
    sink = scratch_path(spark, "t-broken")
    spark.createDataFrame([("not", "parquet")], "a string, b string").write.csv(sink)
    batch = spark.createDataFrame([(1, "https://x.example/1")], "post_id long, source_url string")
    with pytest.raises(Exception):
        append_new_only(batch, sink)
    assert spark.read.csv(sink).count() == 1


def test_the_stream_asks_its_state_and_not_the_sink(spark):
    schema = "post_id long, source string, source_url string, score double, at timestamp, tags array<string>"
    rows = spark.sql("""SELECT id AS post_id, 'b' AS source, concat('https://x.example/j/', id, '.html') AS source_url, id / 7 AS score,
                        timestamp'2024-01-02 03:04:05.678901' AS at, CASE WHEN id % 2 = 0 THEN array('a', NULL) END AS tags
                        FROM range(9007199254740993, 9007199254741013)""")
    one, other, src, ck = (scratch_path(spark, n) for n in ("t-one", "t-other", "t-src", "t-ck"))
    rows.write.parquet(src)
    run_incremental(spark, src, one, ck, schema)
    key = lambda r: r["post_id"]
    assert sorted(spark.read.parquet(one).collect(), key=key) == sorted(rows.collect(), key=key)
    # the same URLs again and a new one: an empty sink changes nothing
    rows.withColumn("source_url", F.concat("source_url", F.lit("?p=2"))).write.mode("append").parquet(src)
    rows.limit(1).withColumn("source_url", F.lit("https://x.example/new")).write.mode("append").parquet(src)
    run_incremental(spark, src, other, ck, schema)
    assert [r[0] for r in spark.read.parquet(other).select("source_url").collect()] == ["https://x.example/new"]


def test_a_repeated_batch_is_not_appended_twice(spark):
    from hiresight.streaming.incremental import _publish
    staged, sink = scratch_path(spark, "t-staged"), scratch_path(spark, "t-sink")
    spark.range(100).repartition(4).write.parquet(staged)
    _publish(spark, staged, sink, "batch-0")
    _publish(spark, staged, sink, "batch-0")
    assert spark.read.parquet(sink).count() == 100


def test_hot_and_missing_urls(spark):
    schema = "post_id long, source_url string"
    src, sink, ck = (scratch_path(spark, n) for n in ("t-src", "t-sink", "t-ck"))
    spark.sql("""SELECT id AS post_id, CASE WHEN id < 5 THEN NULL WHEN id % 3 = 0 THEN 'https://x.example/hot'
                 ELSE concat('https://x.example/', id) END AS source_url FROM range(3000)""").repartition(8).write.parquet(src)
    run_incremental(spark, src, sink, ck, schema)
    ids = {r[0] for r in spark.read.parquet(sink).select("post_id").collect()}
    assert ids == set(range(5)) | {6} | {i for i in range(5, 3000) if i % 3}
