"""Session construction and the shared checkpoint folder.

Jobs never build their own SparkSession on a cluster: they take the one they are given.
``local_session`` is for tests, the bench and the smoke entry point only.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session of ours wants. AQE re-plans shuffles at runtime (partition coalescing,
# skew-join splitting); UTC makes day and hour boundaries independent of the machine.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # upload small change logs per batch instead of full snapshots
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "viewtide",
                  extra: dict | None = None) -> SparkSession:
    """A local session for tests and benchmarks (UI off, small shuffle width)."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", "8g"))
    for k, v in {**BASE_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _context(spark: SparkSession):
    try:
        return spark.sparkContext
    except Exception:  # Spark Connect sessions have no local SparkContext
        return None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    On a cluster the folder is configured by the operator and is only read here; one that is unset is an
    error, since executors do not share a folder of the driver's machine. Only on a local master
    (tests, local runs) is a fresh private folder created and registered.
    """
    sc = _context(spark)
    current = (sc.getCheckpointDir() if sc else None) or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if sc is not None and not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current.rstrip("/")
    if sc is None or not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="viewtide-ckpt-")
    if sc is not None:
        sc.setCheckpointDir(local)
        local = sc.getCheckpointDir()
    spark.conf.set("spark.checkpoint.dir", local)
    return local.rstrip("/")


def cluster_conf(input_bytes: int, executors: int, cores_per_executor: int,
                 target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings to size a large run (apply at submit time; nothing here is set automatically).

    Shuffle width follows the pre-aggregated volume (assumed at most a quarter of the input for
    these jobs), rounded up to whole waves of the cluster's cores; AQE coalesces below that when a
    stage turns out smaller and splits skewed partitions.
    """
    cores = executors * cores_per_executor
    shuffle_bytes = max(input_bytes // 4, target_partition_bytes)
    parts = -(-shuffle_bytes // target_partition_bytes)
    parts = max(cores, -(-parts // cores) * cores)
    return {
        **BASE_CONF,
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(16 << 20),
        "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
        "spark.ui.enabled": "false",
    }


def scratch_path(spark: SparkSession, name: str) -> str:
    """A unique folder under the shared checkpoint folder, for written tables and stream state."""
    root = ensure_checkpoint_dir(spark)
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"
