"""Session construction and cluster-safe scratch locations."""

from __future__ import annotations

import hashlib
import os
import tempfile
import uuid
from collections.abc import Callable, Iterable
from functools import cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on: AQE re-plans joins at runtime (a shuffled side
# that turns out small becomes a broadcast, i.e. broadcasts happen only behind
# a measured size), splits skewed join partitions and coalesces tiny ones.
CORE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # window group limit (top-k per group before the shuffle) is on by default
    # in Spark 4; keep it explicit because the sampling operators depend on it.
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "hiresight", extra: dict | None = None) -> SparkSession:
    """Create (or get) a session with the package's settings.

    ``shuffle_partitions`` should be sized so a shuffle partition stays around
    128-256 MB at the target scale; AQE coalesces it down for small inputs.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(CORE_CONF)
    conf["spark.ui.enabled"] = "false"
    # only takes effect when this builder launches the JVM (local runs)
    conf.setdefault("spark.driver.memory", os.environ.get("HIRESIGHT_DRIVER_MEMORY", "16g"))
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    apply_runtime_conf(spark)
    ensure_checkpoint_dir(spark)
    return spark


def apply_runtime_conf(spark: SparkSession) -> None:
    """Apply the SQL settings to an existing session (the driver's, in checks)."""
    for k, v in CORE_CONF.items():
        if spark.conf.isModifiable(k):
            spark.conf.set(k, v)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's checkpoint folder; set a scratch one only in local runs.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    is.  Only a ``local`` master (tests, one machine) gets a fresh scratch
    folder when it is unset; any other master without it is an error, since
    executors don't see each other's disks.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    path = tempfile.mkdtemp(prefix="hiresight-ckpt-", dir=os.environ.get("HIRESIGHT_SCRATCH", "/tmp"))
    sc.setCheckpointDir(path)
    return path


def materialise(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Survives executor loss like a checkpoint, but later scans read only the
    columns they need and filters reach the files.
    """
    spark = df.sparkSession
    path = path or f"{ensure_checkpoint_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, by whatever file system it names."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def fingerprint(spark: SparkSession, paths: Iterable[str]) -> str:
    """Digest of the names, sizes and modification times under ``paths``."""
    h = hashlib.sha256()
    for path in paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
        for f in sorted((str(x.getPath()), x.getLen(), x.getModificationTime()) for x in [fs.getFileStatus(p), *fs.listStatus(p)]):
            h.update(repr(f).encode())
    return h.hexdigest()[:24]


@cache
def code_digest() -> str:
    """Digest of the package's sources and data outside of ``llm``: layers of other code are other layers."""
    root, h = Path(__file__).parent, hashlib.sha256()
    for p in sorted(p for p in root.rglob("*") if p.suffix in (".py", ".tsv") and "llm" not in p.relative_to(root).parts):
        h.update(str(p.relative_to(root)).encode() + b"\0" + p.read_bytes())
    return h.hexdigest()[:12]


def publish(spark: SparkSession, source: str, target: str) -> bool:
    """Rename a finished folder to its place, at once; False if another job was first."""
    jvm = spark._jvm
    a, b = jvm.org.apache.hadoop.fs.Path(source), jvm.org.apache.hadoop.fs.Path(target)
    fs = jvm.org.apache.hadoop.fs.FileContext.getFileContext(b.getFileSystem(spark._jsc.hadoopConfiguration()).getUri(), spark._jsc.hadoopConfiguration())
    never = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)  # without overwriting
    try:
        fs.rename(a, b, never)
        return True
    except Exception:
        if path_exists(spark, f"{target}/_SUCCESS"):
            return False
        raise


def layer(spark: SparkSession, name: str, inputs: Iterable[str], build: Callable[[], DataFrame], params: object = None) -> DataFrame:
    """A named layer, written once per state of its input files, code and parameters, and read pruned.

    The path holds the fingerprints of the inputs and of the package, and the
    parameters.  A layer is written to a path of its own and renamed when it is
    complete, so readers never see a part of it, and of two jobs that write the
    same layer one publishes."""
    key = hashlib.sha256(repr((fingerprint(spark, inputs), code_digest(), params)).encode()).hexdigest()[:24]
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/layers"
    path = f"{folder}/{name}-{key}"
    if not path_exists(spark, f"{path}/_SUCCESS"):
        own = f"{folder}/.writing-{name}-{uuid.uuid4().hex}"
        build().write.parquet(own)
        publish(spark, own, path)
    return spark.read.parquet(path)


def cluster_conf(input_bytes: int, target_partition_bytes: int = 256 << 20, executors: int = 1000,
                 cores_per_executor: int = 4) -> dict:
    """Shuffle/scan sizing for a cluster run over ``input_bytes`` of Parquet.

    Shuffle partitions start at ~2x the input over the target partition size
    (at least 2 waves of the cluster's cores) and AQE coalesces them to the
    advisory size; scans split files at the same target.  For 100 TB this
    gives ~800k initial partitions coalesced at runtime.
    """
    cores = executors * cores_per_executor
    parts = max(2 * cores, int(2 * input_bytes / target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(16 << 20),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
    }
