"""Session construction and table access.

The session settings are the ones that matter at scale:

* AQE on, with partition coalescing and skew-join splitting, so shuffle
  sizes are re-planned from runtime statistics and a hot key (one key may
  hold a third of all rows) is split across tasks.
* Broadcast joins only through AQE's runtime size check
  (``spark.sql.autoBroadcastJoinThreshold`` on the measured side) or through
  explicit ``broadcast()`` on dimension tables whose cardinality is fixed
  (``nation``, ``region``, lexicons given as literals).
* No UI server.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def get_spark(master: str | None = None, app: str = "cairn",
              shuffle_partitions: int | None = None) -> SparkSession:
    """Return the active session, or build a local one configured for tests
    and benchmarks. On a cluster, ``spark-submit`` supplies the master and
    the session already exists; this only adds SQL settings."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    master = master or os.environ.get("CAIRN_MASTER", "local[8]")
    parts = shuffle_partitions or int(os.environ.get("CAIRN_SHUFFLE_PARTITIONS", "8"))
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("CAIRN_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder used to cut lineage (``DataFrame.checkpoint``) and to
    hold staging tables.

    On a cluster it is whatever ``spark.checkpoint.dir`` names (a shared file
    system every executor can reach). Only when it is unset, as in local
    tests, a fresh folder is made and registered."""
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(conf)
        return conf
    ctx_dir = spark.sparkContext.getCheckpointDir()
    if ctx_dir:
        spark.conf.set("spark.checkpoint.dir", ctx_dir)
        return ctx_dir
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    local = tempfile.mkdtemp(prefix="cairn-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    spark.sparkContext.setCheckpointDir(local)
    return local


def size_shuffles(spark: SparkSession, input_bytes: int, target_bytes: int = 256 << 20,
                  max_split_bytes: int = 512 << 20) -> int:
    """Size shuffles for an input of ``input_bytes``: start AQE from enough
    partitions that each holds about ``target_bytes`` (AQE then coalesces
    small ones and splits skewed ones), and read files in splits of at most
    ``max_split_bytes``. At 100 TB this gives about 400k initial shuffle
    partitions of 256 MB, each well inside an executor's memory. Returns the
    partition count set."""
    n = max(1, -(-int(input_bytes) // int(target_bytes)))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(n))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(int(target_bytes)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(int(max_split_bytes)))
    return n


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Lazy table scan. Column pruning and filter pushdown reach the
    parquet reader because nothing here materialises the frame."""
    return spark.read.parquet(table_path(root, name))
