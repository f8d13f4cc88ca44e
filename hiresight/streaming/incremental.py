"""Incremental ingestion with Structured Streaming.

The resume rule of the crawlers ("skip URLs already in the output") becomes a
stream over a folder of new posting files with one state entry per normalised
URL.  The URLs stored before the first start enter the state once; from then on
a batch touches the entries of its own URLs only, however large the sink is.
The checkpoint folder holds progress, state and the batch being appended, so a
restarted job (or a lost executor) resumes without duplicates; ``availableNow``
processes what is there and stops.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.html import url_normalise
from ..session import path_exists

# executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: state on local disk with changes logged to the checkpoint: neither memory nor a batch's upload grows with all keys
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
#: rows pass the state as text, so that no type is changed on the way
JSON = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
        "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
PACKED = "_k string, _stored boolean, _order long, _row string"


def append_new_only(batch: DataFrame, sink_path: str, key: str = "source_url") -> None:
    """Append the rows of a plain table whose normalised key is not stored yet,
    reading the keys of the whole sink (the stream below keeps them as state).

    Only a missing sink counts as empty; any other failure to read it ends the
    batch, since taking it for empty would append everything again.
    """
    spark = batch.sparkSession
    b = batch.withColumn("_k", url_normalise(F.col(key)))
    if path_exists(spark, sink_path):
        existing = spark.read.schema(batch.schema).parquet(sink_path).select(url_normalise(F.col(key)).alias("_k")).distinct()
        b = b.join(existing, "_k", "left_anti")
    # rows repeated inside one batch are kept once (first by post id)
    b = b.dropDuplicates(["_k"]) if "post_id" not in b.columns else \
        b.groupBy("_k").agg(F.min(F.struct(*[c for c in b.columns if c != "_k"])).alias("r")).select("r.*")
    b.drop("_k").write.mode("append").parquet(sink_path)


def _packed(df: DataFrame, key: str) -> DataFrame:
    """(key, order, row as JSON); rows without a key are told apart by all their columns."""
    row: Column = F.to_json(F.struct(*[F.col(c) for c in df.columns]), JSON)
    order = F.coalesce(F.col("post_id").cast("long"), F.lit(-(1 << 63))) if "post_id" in df.columns else F.lit(0).cast("long")
    return df.select(F.coalesce(url_normalise(F.col(key)), F.concat(F.lit("\n"), F.sha2(row, 256))).alias("_k"),
                     F.lit(False).alias("_stored"), order.alias("_order"), row.alias("_row"))


def _combine(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The first row of each key of a part, so that a hot key is small before rows are shuffled."""
    for p in parts:
        yield p.sort_values(["_order", "_row"]).drop_duplicates("_k")


def _first_unseen(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """The key's first row by (order, row) if the key is new; its state entry either way."""
    seen, first = state.exists, None
    for p in parts:
        seen = seen or bool(p["_stored"].any())
        if not seen:
            least = min(zip(p["_order"], p["_row"]))
            first = least if first is None else min(first, least)
    if not state.exists:
        state.update((True,))
    if not seen and first is not None:
        yield pd.DataFrame({"_row": [first[1]]})


def _write_stored_keys(spark: SparkSession, sink_path: str, schema: T.StructType, key: str, path: str) -> None:
    """The keys of the sink as it is at the first start (none if it is missing)."""
    if path_exists(spark, f"{path}/_SUCCESS"):
        return
    rows = spark.read.schema(schema).parquet(sink_path) if path_exists(spark, sink_path) else spark.createDataFrame([], schema)
    (rows.select(url_normalise(F.col(key)).alias("_k")).where("_k IS NOT NULL").distinct()
     .select("_k", F.lit(True).alias("_stored"), F.lit(0).cast("long").alias("_order"), F.lit("").alias("_row"))
     .write.mode("overwrite").parquet(path))


def _publish(spark: SparkSession, staged: str, sink_path: str, name: str) -> None:
    """Move the files of a complete batch into the sink under names of their own.

    A batch that is repeated after a failure moves what is left of it."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    source, target = hadoop.Path(staged), hadoop.Path(sink_path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(target)
    for f in fs.listStatus(source):
        file = f.getPath().getName()
        if file.endswith(".parquet") and not fs.rename(f.getPath(), hadoop.Path(target, f"{name}-{file}")):
            raise OSError(f"{file} of {name} could not be moved to {sink_path}")


def run_incremental(spark: SparkSession, source_path: str, sink_path: str, checkpoint_path: str,
                    schema, key: str = "source_url") -> None:
    """Process every file present in ``source_path`` once (availableNow) and stop.

    Rows whose normalised key was met before are skipped; of rows of one key in
    a batch the first by post id stays; rows without a key are skipped only if
    an equal row was met by this stream.  The sink is read at the first start
    only: keys that others append to it later are unknown to the stream.
    """
    empty = spark.createDataFrame([], schema)
    schema = empty.schema
    stored, staging = f"{checkpoint_path}/stored", f"{checkpoint_path}/staged"
    _write_stored_keys(spark, sink_path, schema, key, stored)

    def append(batch: DataFrame, batch_id: int) -> None:
        path = f"{staging}/{batch_id}"
        if not path_exists(spark, f"{path}/_SUCCESS"):
            batch.select(F.from_json("_row", schema, JSON).alias("r")).select("r.*").write.mode("overwrite").parquet(path)
        _publish(spark, path, sink_path, f"batch-{batch_id}")

    before = {k: spark.conf.get(k, None) for k in STATE_CONF}
    for k, v in STATE_CONF.items():
        spark.conf.set(k, v)
    try:
        # without a limit on files the stored keys are whole in the first batch
        rows = _packed(spark.readStream.schema(schema).parquet(source_path), key).mapInPandas(_combine, PACKED)
        q = (spark.readStream.schema(PACKED).parquet(stored).unionByName(rows).groupBy("_k")
             .applyInPandasWithState(_first_unseen, "_row string", "seen boolean", "append", GroupStateTimeout.NoTimeout)
             .writeStream.foreachBatch(append).option("checkpointLocation", f"{checkpoint_path}/progress")
             .trigger(availableNow=True).start())
        q.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
