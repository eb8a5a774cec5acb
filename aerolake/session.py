"""Session construction and shared-folder helpers."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on.  The session zone is fixed to UTC because
# date_int / time_int keys are derived from timestamps and must not depend on
# the machine the job runs on.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.optimizer.nestedSchemaPruning.enabled": "true",
    # Tables with column statistics (ANALYZE) are planned by them.
    "spark.sql.cbo.enabled": "true",
    "spark.sql.cbo.joinReorder.enabled": "true",
    # Target ~128 MB per post-shuffle partition; skewed partitions above
    # 5x the median and 256 MB are split by AQE.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256m",
    # Streaming state (the parameter dedup keeps every key it has seen) lives
    # in RocksDB off the JVM heap; its changelogs and snapshots go to the
    # query checkpoint in the shared folder, so a lost executor's state is
    # rebuilt from there.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.ui.enabled": "false",
}


def scale_conf(shuffle_bytes: int, cores: int,
               partition_bytes: int = 256 * 1024 ** 2) -> dict[str, str]:
    """Shuffle and scan sizing for a cluster run.

    ``shuffle_bytes`` is the largest expected shuffle (the fact dedup: the
    measurement rows after pruning to key, order and value columns);
    ``cores`` the total executor cores.  The initial partition count gives
    about ``partition_bytes`` per reducer, so a task's share fits in its
    execution memory at any size, and at least 3 tasks per core.  AQE then
    coalesces small partitions down to the advisory size and splits skewed
    ones.  Scan splits are 256 MB: large sequential parquet reads, and scan
    tasks outnumber cores even on small tables.  A caller who wants fewer
    and larger partitions gives ``partition_bytes``.

    For example, 30 TB of shuffled rows gives 122,880 partitions of 256 MB.
    """
    n = max(3 * cores, -(-shuffle_bytes // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 ** 2),
    }


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "aerolake", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings the library expects.

    On a cluster ``master`` is left to the launcher; tests pass ``local[*]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_runtime_conf(spark)
    return spark


def apply_runtime_conf(spark: SparkSession) -> None:
    """Apply the runtime SQL settings to a session built elsewhere.

    Only what nobody has set: a launcher's own sizes stay.  The time zone is
    always UTC, as keys depend on it.  Static settings (``spark.ui.enabled``)
    are left to the launcher.
    """
    given = spark.conf.getAll
    for k, v in BASE_CONF.items():
        if k.startswith("spark.sql.") and (k not in given or k.endswith(".timeZone")):
            spark.conf.set(k, v)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is the shared file system every executor sees, and a
    session without it is an error: a machine-local folder would lose
    stream state and written layers with the machine.  Only a local-mode
    session (tests) without one gets a fresh local folder.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: name a shared folder "
                               "(e.g. on the cluster file system) for checkpoints and tables")
        import tempfile

        root = tempfile.mkdtemp(prefix="aerolake-ckpt-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder below the shared checkpoint root for one run."""
    return f"{checkpoint_root(spark)}/aerolake/{name}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for code that needs a plain OS path."""
    if path.startswith("file:"):
        path = path[len("file:"):]
        while path.startswith("//"):
            path = path[1:]
    return os.path.normpath(path)
