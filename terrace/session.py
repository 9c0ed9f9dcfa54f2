"""Session construction and the shared scratch folder.

Jobs that must cut lineage or land intermediate files write below the folder the cluster
names in ``spark.checkpoint.dir``. Only when that setting is absent *and* Spark runs in
local mode (tests, the local benchmark) do we create one ourselves.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

# Settings that matter at scale; all are plain public Spark options.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def cluster_conf(total_cores: int, shuffle_bytes_tb: float = 20.0) -> dict[str, str]:
    """Settings for a large cluster (e.g. 1000 executors over ~100 TB of input).

    * Shuffle partitions are sized for ~256 MB per partition of the largest expected shuffle
      (``shuffle_bytes_tb``) and never below 3x the cores; AQE coalesces the small ones and
      splits skewed ones, so over-provisioning is cheap while under-provisioning spills.
    * Scan splits of 256 MB match typical Parquet row groups.
    * Broadcasts stay behind a measured size (AQE converts at run time under 64 MB).
    * Runtime bloom filters prune the fact side of star joins before the shuffle.
    * Decommissioning migrates shuffle and cached blocks off a leaving executor, so losing
      executors costs re-fetches rather than recomputed stages.
    """
    parts = max(3 * total_cores, int(shuffle_bytes_tb * 1024 * 1024 / 256))
    return {
        **DEFAULT_CONF,
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.files.maxPartitionBytes": "256m",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
        "spark.sql.autoBroadcastJoinThreshold": "64m",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
        "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
        "spark.decommission.enabled": "true",
        "spark.storage.decommission.enabled": "true",
        "spark.storage.decommission.shuffleBlocks.enabled": "true",
        "spark.storage.decommission.rddBlocks.enabled": "true",
    }


def build_session(cpus: int | str = 8, shuffle_partitions: int | None = None,
                  app: str = "terrace") -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    parts = shuffle_partitions or (int(cpus) if str(cpus).isdigit() else 8)
    builder = (builder.config("spark.sql.shuffle.partitions", str(parts))
               .config("spark.driver.memory", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a local one only in local mode."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir() or current
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="terrace-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def materialize(df):
    """Reliable (eager) checkpoint in the shared checkpoint folder: the rows are computed once,
    later uses read them back, and the lineage is cut (executor loss cannot force a rerun of
    the upstream plan)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/terrace/{name}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check for a file or folder on any file system Spark can read. Resolving a
    file-source relation lists the path on the driver and fails for a missing path; no job
    runs and no file content is read."""
    try:
        spark.read.format("binaryFile").load(path).select("path")
        return True
    except AnalysisException:
        return False

