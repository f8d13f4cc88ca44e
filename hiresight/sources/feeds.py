"""Raw CSV feeds (18 string fields), layer sinks and metric files.

Feeds are read with a fixed schema (no inference pass over the data);
descriptions may contain newlines, and files are split all the same (``split_csv``).  Every
folder written here lives under a caller-given base path, which on a cluster
is a shared location (by default inside ``spark.checkpoint.dir``).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir, path_exists
from .split_csv import read_quoted_csv

# --- FIXED VALUES: raw record field order (the misspelt salarry_max is the feed's name).
RAW_FIELDS = ["job_title", "salary_min", "salarry_max", "location", "experience", "job_description",
              "qualifications", "benefit", "job_location", "company", "size", "industry", "level",
              "working form", "salary_raw", "crawl_date", "source_url", "source"]
RAW_SCHEMA = T.StructType([T.StructField(f, T.StringType(), True) for f in RAW_FIELDS])


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint location."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def to_raw_record(df: DataFrame, crawl_date: str = "2026-01-01") -> DataFrame:
    """Fixture posting rows -> the 18-field raw record, missing -> ''."""
    m = {"job_title": "title", "salary_min": "salary_min", "salarry_max": "salary_max", "location": "city_raw",
         "experience": "exp_raw", "job_description": "job_description", "qualifications": "qualifications",
         "company": "company", "working form": "working_form", "salary_raw": "salary_raw",
         "source_url": "source_url", "source": "source"}
    cols = []
    for f in RAW_FIELDS:
        if f == "crawl_date":
            cols.append(F.lit(crawl_date).alias(f))
        elif f in m and m[f] in df.columns:
            cols.append(F.coalesce(F.col(m[f]).cast("string"), F.lit("")).alias(f))
        else:
            cols.append(F.lit("").alias(f))
    return df.select(*cols)


def write_raw_csv(df: DataFrame, path: str, mode: str = "overwrite", header: bool = True) -> None:
    """UTF-8, every field quoted, fixed field order.

    Every file of a feed has the header (or none has): an appended file is
    a file of its own here, so it repeats the header and readers that expect
    one lose no row.
    """
    (to_raw_record(df) if set(RAW_FIELDS) - set(df.columns) else df.select(*[F.col(f"`{f}`") for f in RAW_FIELDS])) \
        .write.mode(mode).option("header", header).option("quoteAll", True) \
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False) \
        .option("escape", '"').option("encoding", "UTF-8").csv(path)


def read_raw_csv(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """Read a feed with the fixed raw schema (multi-line quoted fields), large files in many tasks."""
    return read_quoted_csv(spark, path, RAW_SCHEMA, header)


def sink_layer(df: DataFrame, path: str) -> None:
    """Write a layer as Parquet, overwrite (arrays stay arrays)."""
    df.write.mode("overwrite").parquet(path)


def scan_layer(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def sink_metrics(metrics: DataFrame, path: str) -> None:
    metrics.coalesce(1).write.mode("overwrite").json(path)


# --- FIXED VALUES: the metrics shown when none were written.
METRICS_SHOWN = [("Random Forest", 5.26, 9.02, 0.9033, 21.1), ("XGBoost", 4.89, 8.54, 0.9134, 20.6),
                 ("LightGBM", 5.58, 9.48, 0.8933, 22.6), ("Gradient Boosting", 5.17, 8.90, 0.9060, 21.3)]
METRICS_DDL = "model string, mae double, rmse double, r2 double, mape double"


def scan_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Metrics JSON -> long form (model, metric, value); the fixed table if nothing was written there."""
    m = spark.read.schema(METRICS_DDL).json(path) if path_exists(spark, path) else spark.createDataFrame(METRICS_SHOWN, METRICS_DDL)
    return m.select("model", F.expr("stack(4, 'mae', mae, 'rmse', rmse, 'r2', r2, 'mape', mape) AS (metric, value)"))


def profile_columns(df: DataFrame, cols, order: str | None = None, first: int = 10) -> DataFrame:
    """Per column: non-null and distinct counts (one aggregate pass) and, with
    ``order``, the values of the ``first`` rows in that order, joined by '|'."""
    aggs = []
    for c in cols:
        aggs += [F.count(F.col(f"`{c}`")).alias(f"{c}__n"), F.countDistinct(F.col(f"`{c}`")).alias(f"{c}__d")]
    counts = df.agg(*aggs)
    stack = ", ".join(f"'{c}', `{c}__n`, `{c}__d`" for c in cols)
    out = counts.select(F.expr(f"stack({len(cols)}, {stack}) AS (column_name, non_null, distinct_values)"))
    if order is None:
        return out
    top = df.select(order, *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in cols]).orderBy(order).limit(first)
    shown = top.agg(*[_in_order(order, c) for c in cols])
    stack = ", ".join(f"'{c}', `{c}`" for c in cols)
    return out.join(shown.select(F.expr(f"stack({len(cols)}, {stack}) AS (column_name, first_values)")), "column_name")


def _in_order(order: str, col: str):
    """The values of a bounded number of rows, in order, joined by '|'."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, col))), lambda x: x[col]), "|").alias(col)
