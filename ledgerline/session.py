"""Spark session defaults shared by the library, the tests and the bench."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Session settings every job in this library assumes.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(app: str = "ledgerline", master: str | None = None,
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """Return (or create) a session with the library's defaults.

    On a cluster ``master`` stays ``None`` and the launcher decides; tests and
    the bench pass ``local[N]``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in BASE_CONF.items():
        if not k.startswith("spark.ui."):
            spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)
    return spark


def scale_conf(input_bytes: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Shuffle and scan sizing for a run over ``input_bytes`` of input.

    The initial shuffle partition count is sized so a partition of the
    largest shuffle (at most the input) is about ``target_partition_bytes``
    and fits an executor task without heavy spill; AQE then coalesces small
    shuffles down to the advisory size and splits skewed partitions.  For
    100 TB this gives ~400k requested partitions (AQE coalescing brings the
    actual count down for the smaller shuffles).
    """
    parts = max(200, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }


def apply_scale_conf(spark: SparkSession, input_bytes: int, **kw) -> dict[str, str]:
    """Set ``scale_conf`` on a session (runtime SQL settings only) and return it."""
    conf = scale_conf(input_bytes, **kw)
    for k, v in conf.items():
        spark.conf.set(k, v)
    return conf


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; only a local master without
    one (tests) gets a fresh directory under the system temp folder, which
    other machines could not read."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key
            configured = None
    if not configured:
        if not sc.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="ledgerline-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique directory inside the shared checkpoint folder, for
    tables a job writes to cut lineage or stage data between steps."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists; every other failure is raised."""
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(sc._jsc.hadoopConfiguration()).exists(p)


def read_if_exists(spark: SparkSession, path: str, schema=None):
    """The Parquet table at ``path``, or None when there is no such path (an
    unreadable table is an error, never an empty one)."""
    if not path_exists(spark, path):
        return None
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of the library's own; one that is not there is no error."""
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)


def move_path(spark: SparkSession, path: str, to: str) -> None:
    """Rename a folder of the library's own; ``to`` must not exist."""
    sc = spark.sparkContext
    source, target = (sc._jvm.org.apache.hadoop.fs.Path(p) for p in (path, to))
    if not source.getFileSystem(sc._jsc.hadoopConfiguration()).rename(source, target):
        raise OSError(f"cannot move {path} to {to}")


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path``."""
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return [s.getPath().getName() for s in p.getFileSystem(sc._jsc.hadoopConfiguration()).listStatus(p) if s.isDirectory()]


def stored(df, name: str):
    """``df`` written as Parquet into the session's checkpoint folder and read
    back: the lineage is cut at a durable, shared place, and consumers still read
    only the columns and rows they need."""
    path = scratch_dir(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
