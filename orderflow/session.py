"""Spark session helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the engine relies on.  AQE re-plans joins from runtime sizes
# (broadcast when a side turns out small, skew splitting otherwise) and
# coalesces small shuffle partitions.
ENGINE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}

#: Whether the shuffle files of a query are removed when it ends, and not when the driver next collects its garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
#: What a task reads (:func:`bounded_tasks`).
TASK_SIZES = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m", "spark.sql.files.maxPartitionBytes": "16m", INITIAL_PARTITIONS: "800"}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  driver_memory: str = "8g", app_name: str = "orderflow",
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Session for tests and local runs (on a cluster, use the cluster's)."""
    builder = (SparkSession.builder.master(master).appName(app_name)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.driver.memory", driver_memory)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions)))
    for key, value in {**ENGINE_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, creating a local one only when unset in
    local mode.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    is; a cluster session without it is an error (a machine-local folder would
    not survive the loss of an executor).  Only a ``local[...]`` session with
    no setting (tests, local runs) gets a scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on HDFS or object storage)")
        configured = tempfile.mkdtemp(prefix="orderflow-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def bounded_tasks(spark: SparkSession) -> None:
    """Deal out files and shuffles in smaller pieces than Spark does by itself, where the session sets no size.

    Order lines are packed some 20 times denser in files and shuffles than in the sorts and hash tables of a task,
    which chains several of these; AQE joins small pieces."""
    sizes = dict(TASK_SIZES)
    if spark.conf.get("spark.sql.shuffle.partitions", None) is not None:
        sizes.pop(INITIAL_PARTITIONS)
    for key, value in sizes.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` as parquet below the checkpoint folder and read it back with its own schema.

    Cuts the lineage like a checkpoint, but plans on top of it prune columns, push filters and know its size.  The
    folder is the session's ``spark.checkpoint.dir``; give it a retention rule, as for checkpoints.  Nothing reads the
    shuffles of the write again, so their files go when it ends: disk holds the tables and one job's shuffles."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    before = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)
