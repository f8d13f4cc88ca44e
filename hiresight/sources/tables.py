"""Driver tables as DataFrames (Parquet; Catalyst prunes columns and pushes filters)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame, sf_dir: str, name: str, task_bytes: int = 64 << 10) -> DataFrame:
    """Rows of a table dealt out evenly, for work that costs far more than reading.

    A file of one row group is one task however many cores there are.  A task
    gets ``task_bytes`` of the file, but there are no more tasks than the
    shuffle partitions or three for each core."""
    spark = df.sparkSession
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{name}.parquet")
    size = p.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(p).getLength()
    most = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 3 * spark.sparkContext.defaultParallelism)
    return df.repartition(max(1, min(-(-size // task_bytes), most)))


def register_views(spark: SparkSession, sf_dir: str, names=None) -> None:
    """Register the driver tables as temp views (for the SQL-text fixtures)."""
    for name in names or TABLES:
        table(spark, sf_dir, name).createOrReplaceTempView(name)
