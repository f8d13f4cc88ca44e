"""Helpers shared by the operators: shared tables, Arrow batches, key columns."""

from __future__ import annotations

import sys
import types
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hiresight.session import ensure_checkpoint_dir

#: Arrow batches stay small whatever the row width, so that a Python worker's
#: memory does not depend on how long the texts are.
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_CONF = {"spark.sql.execution.arrow.maxRecordsPerBatch": "4096", BATCH_BYTES: str(16 << 20)}


def session_of(df: DataFrame, most_bytes: int | None = None) -> SparkSession:
    """The frame's session, with the batch limits in force; a lower limit on bytes that is set already stays."""
    spark = df.sparkSession
    before = str(spark.conf.get(BATCH_BYTES))
    for k, v in BATCH_CONF.items():
        spark.conf.set(k, v)
    now = int(before.rstrip("b")) if before.rstrip("b").isdigit() else 0
    limits = [int(BATCH_CONF[BATCH_BYTES]), *([now] if now else []), *([most_bytes] if most_bytes else [])]
    spark.conf.set(BATCH_BYTES, str(min(limits)))
    return spark


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the cluster's shared folder (``spark.checkpoint.dir``)."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    A lost executor costs its running tasks only: finished files stay.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def id_bucket(modulus: int, col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as ''."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit(""))) % modulus


def arrow_schema(ddl: dict[str, pa.DataType]) -> pa.Schema:
    return pa.schema([pa.field(k, v) for k, v in ddl.items()])


def wider(schema: T.StructType, **added: str) -> T.StructType:
    """A copy of ``schema`` with more columns (``StructType.add`` would change it)."""
    out = T.StructType(list(schema.fields))
    for name, kind in added.items():
        out = out.add(name, kind)
    return out


def batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    """A record batch of ``schema``; a column that is not given is null."""
    n = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema],
        schema=schema)


def worker_state() -> dict:
    """A dict that lives as long as the Python worker process.

    Spark reuses workers between tasks; memos kept here save repeated work and
    never carry results (a new worker only starts with empty memos).
    """
    return sys.modules.setdefault("_hiresight_worker_state", types.ModuleType("_hiresight_worker_state")).__dict__


def task_id() -> int:
    from pyspark import TaskContext

    return TaskContext.get().partitionId()
