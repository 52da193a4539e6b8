"""Session helpers: a configured builder and the shared working folder.

The shared folder is the one the cluster names in ``spark.checkpoint.dir``;
every staged file, stream checkpoint and lineage cut of this library lives
under it.  Only a session with a local master (one machine, as in tests) may
leave it unset and gets a private folder; on a cluster that is an error,
because executors would write to their own disks.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

BASE_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app: str = "envstats", extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def session_key(spark: SparkSession) -> str:
    """Identity of the running application (memo keys for per-session caches)."""
    try:
        return spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001  (sessions without a local SparkContext)
        return f"session-{id(spark)}"


def shared_dir(spark: SparkSession) -> str:
    """Shared folder of the cluster (``spark.checkpoint.dir``).

    Read from the session.  A private one is made only under a local master;
    any other master without the setting raises.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("spark.checkpoint.dir is not set: on a cluster it must name a "
                               "folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="envstats-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir().rstrip("/")


def data_version(df: DataFrame) -> tuple:
    """Version of the files that ``df`` reads: (path, bytes, modification time)
    of each.  A cache keyed by it forgets a table that changed in place."""
    sc = df.sparkSession.sparkContext
    jvm, conf = sc._jvm, sc._jsc.hadoopConfiguration()
    out = []
    for f in sorted(df.inputFiles()):
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(f))
        st = path.getFileSystem(conf).getFileStatus(path)
        out.append((f, st.getLen(), st.getModificationTime()))
    return tuple(out)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path under the shared folder."""
    return f"{shared_dir(spark)}/envstats/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as parquet under the shared folder
    (``spark.checkpoint.dir``) and return a scan of it.

    Used for a prepared table that many queries read (e.g. a repaired
    dimension): later plans scan a few files, with column pruning and
    filter pushdown, instead of re-running the joins that built it.  The
    files live in the cluster's shared folder, so the table survives the
    loss of any executor (unlike a cached or locally checkpointed copy).
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)


def scale_conf(input_bytes: int, total_cores: int, partition_bytes: int = 256 * 1024 * 1024,
               large_state: bool = False, max_partitions: int | None = None) -> dict:
    """Settings sized for a cluster reading ``input_bytes``.

    * scan splits and shuffle partitions of about ``partition_bytes`` (they
      fit executor memory; adaptive execution coalesces small ones), at
      least two waves of ``total_cores`` (``max_partitions`` caps the count
      where a cluster cannot schedule as many; partitions then grow);
    * skew join on: a partition 5x the median and over 512 MB is split;
    * the auto-broadcast limit equals the library's own broadcast budget, so
      Spark never broadcasts more than the checked size;
    * optionally the RocksDB state store for streams with many groups.
    Stream state partitions are fixed when a checkpoint is created: set them
    before the first start of a query.
    """
    from envstats.operators.joins import BROADCAST_BUDGET_BYTES
    n = max(2 * total_cores, -(-int(input_bytes) // partition_bytes))
    if max_partitions:
        n = min(n, max_partitions)
    conf = {
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(BROADCAST_BUDGET_BYTES),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(BROADCAST_BUDGET_BYTES),
    }
    if large_state:
        conf["spark.sql.streaming.stateStore.providerClass"] = (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    return conf
