"""Queries: feed scans and sinks, resume / incremental ingestion, metric files."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from ..functions.html import url_normalise
from ..operators import relational as R
from ..operators.ml import regression_metrics
from ..sources import feeds as FD
from ..sources.postings import raw_postings
from ..streaming.incremental import run_incremental
from . import clean as C
from . import oracle as O
from .catalog import register

W = O.with_ctes
POSTING = O.posting_ctes()
CLEAN = O.clean_ctes()


@register("scan_feeds", W(POSTING, """SELECT title, company, city_raw, salary_min, salary_max, exp_raw, description,
    working_form, source FROM posting"""))
def q_scan_feeds(spark, sf):
    """Write both feeds as quoted CSV (18 raw fields), read them back with the
    multi-line reader and a fixed schema, conform and union them."""
    raw = raw_postings(spark, sf)
    paths = []
    for feed in ("feed_a", "feed_b"):
        p = FD.scratch_path(spark, f"feed-{feed}")
        FD.write_raw_csv(raw.where(F.col("source") == feed), p)
        paths.append(p)
    a, b = (R.conform_schema(FD.read_raw_csv(spark, p).drop("source"), source=f)
            for p, f in zip(paths, ("feed_a", "feed_b")))
    return R.union_feeds(a, b).drop("source_rank", "source_url")


@register("scan_layer", W(CLEAN, "SELECT post_id, salary, level, array_to_string(skills, ',') AS skills FROM clean"))
def q_scan_layer(spark, sf):
    path = FD.scratch_path(spark, "clean-layer")
    FD.sink_layer(C.clean_postings(spark, sf), path)
    return FD.scan_layer(spark, path).select("post_id", "salary", "level", F.array_join("skills", ",").alias("skills"))


@register("sink_raw_append", W(POSTING, "SELECT source, count(*) AS n FROM raw GROUP BY source"))
def q_sink_append(spark, sf):
    """First feed written with a header, the second appended to it (resume mode)."""
    raw = raw_postings(spark, sf)
    path = FD.scratch_path(spark, "raw-append")
    FD.write_raw_csv(raw.where(F.col("source") == "feed_a"), path, mode="overwrite")
    FD.write_raw_csv(raw.where(F.col("source") == "feed_b"), path, mode="append")
    return FD.read_raw_csv(spark, path).groupBy("source").agg(F.count(F.lit(1)).alias("n"))


NEW_ONLY_SQL = W(POSTING, """SELECT post_id FROM posting WHERE source = 'feed_b' AND regexp_replace(source_url, '[;?#].*$', '')
    NOT IN (SELECT regexp_replace(source_url, '[;?#].*$', '') FROM posting WHERE source = 'feed_a')""")


@register("incremental_new_only", NEW_ONLY_SQL)
def q_new_only(spark, sf):
    p = C.postings(spark, sf).withColumn("u", url_normalise(F.col("source_url")))
    existing = p.where(F.col("source") == "feed_a").select("u")
    return R.anti_join_new(p.where(F.col("source") == "feed_b"), existing, "u").select("post_id")


@register("incremental_stream", W(POSTING, """SELECT min(post_id) AS post_id FROM posting WHERE source = 'feed_b'
    AND regexp_replace(source_url, '[;?#].*$', '') NOT IN
        (SELECT regexp_replace(source_url, '[;?#].*$', '') FROM posting WHERE source = 'feed_a')
    GROUP BY regexp_replace(source_url, '[;?#].*$', '')"""))
def q_stream(spark, sf):
    """feed_a is the stored output; feed_b arrives as files; an availableNow
    stream appends only URLs not stored yet."""
    p = C.postings(spark, sf).select("post_id", "source", "source_url", "title")
    sink = FD.scratch_path(spark, "stream-sink")
    src = FD.scratch_path(spark, "stream-src")
    ck = FD.scratch_path(spark, "stream-ckpt")
    p.where(F.col("source") == "feed_a").write.parquet(sink)
    p.where(F.col("source") == "feed_b").repartition(4).write.parquet(src)
    run_incremental(spark, src, sink, ck, p.schema)
    stored = spark.read.parquet(sink)
    return stored.where(F.col("source") == "feed_b").select("post_id")


@register("dead_letter", W(POSTING, """SELECT CASE WHEN title = '' THEN 'failed' ELSE 'ok' END AS status, count(*) AS n
    FROM posting GROUP BY 1"""))
def q_dead_letter(spark, sf):
    p = C.postings(spark, sf).withColumn("error", F.when(F.col("title") == "", F.lit("no title")))
    good, bad = R.split_dead_letter(p)
    return good.select(F.lit("ok").alias("status")).unionByName(bad.select(F.lit("failed").alias("status"))) \
        .groupBy("status").agg(F.count(F.lit(1)).alias("n"))


_PSEUDO = [("m7", 7), ("m11", 11)]
_MSQL = """round(avg(abs(y - p)), 2) AS mae, round(sqrt(avg((y - p) * (y - p))), 2) AS rmse,
    round(1 - sum((y - p) * (y - p)) / sum((y - (SELECT avg(salary) FROM clean)) * (y - (SELECT avg(salary) FROM clean))), 4) AS r2,
    round(avg(abs((y - p) / (y + 0.01))) * 100, 1) AS mape"""


@register("scan_metrics", W(CLEAN, "SELECT model, metric, value FROM (" + " UNION ALL ".join(
    f"SELECT '{n}' AS model, {_MSQL} FROM (SELECT salary AS y, salary * (1 + (CAST(post_id % {m} AS DOUBLE) - {m // 2}) / 100.0)"
    f" AS p FROM clean)" for n, m in _PSEUDO) + ") UNPIVOT (value FOR metric IN (mae, rmse, r2, mape))"))
def q_scan_metrics(spark, sf):
    return FD.scan_metrics(spark, _written_metrics(spark, sf))


def _written_metrics(spark, sf):
    c = C.clean_postings(spark, sf)
    parts = []
    for n, m in _PSEUDO:
        pr = c.select(F.col("salary").alias("label"), (F.col("salary") * (1 + ((F.col("post_id") % m).cast("double")
                                                                              - m // 2) / 100.0)).alias("prediction"))
        parts.append(regression_metrics(pr, log_scale=False).select(F.lit(n).alias("model"), "*"))
    met = parts[0].unionByName(parts[1])
    path = FD.scratch_path(spark, "metrics")
    FD.sink_metrics(met, path)
    return path


@register("sink_metrics", W(CLEAN, " UNION ALL ".join(
    f"SELECT '{n}' AS model, {_MSQL} FROM (SELECT salary AS y, salary * (1 + (CAST(post_id % {m} AS DOUBLE) - {m // 2}) / 100.0)"
    f" AS p FROM clean)" for n, m in _PSEUDO)))
def q_sink_metrics(spark, sf):
    """The metric rows as they stand in the written file."""
    return spark.read.schema("model string, mae double, rmse double, r2 double, mape double").json(_written_metrics(spark, sf))


@register("model_save_load")
def q_model_save_load(spark, sf):
    """Fit a small pipeline, save it, load it back and score with the loaded copy."""
    c = C.clean_postings(spark, sf).select("post_id", "exp_years", "num_skills", "remote", "english",
                                           F.log1p("salary").alias("label"))
    pipe = Pipeline(stages=[VectorAssembler(inputCols=["exp_years", "num_skills", "remote", "english"],
                                            outputCol="features"), LinearRegression(regParam=0.0)])
    model = pipe.fit(c)
    path = FD.scratch_path(spark, "model")
    model.write().overwrite().save(path)
    from pyspark.ml import PipelineModel
    loaded = PipelineModel.load(path)
    return loaded.transform(c).select("post_id", F.round(F.expm1("prediction"), 1).alias("predicted_salary"))


_PROFILED = ["title", "company", "city_raw", "salary_raw"]


@register("profile_columns", W(POSTING, " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count({c}) AS non_null, count(DISTINCT {c}) AS distinct_values,
    (SELECT string_agg(coalesce({c}, ''), '|' ORDER BY post_id) FROM (SELECT post_id, {c} FROM raw ORDER BY post_id LIMIT 10)) AS first_values
    FROM raw""" for c in _PROFILED)))
def q_profile(spark, sf):
    return FD.profile_columns(raw_postings(spark, sf), _PROFILED, order="post_id")
