"""Session construction and the shared workspace folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every strata job assumes. ANSI is on by default in Spark 4, so
# all parsing goes through try_cast; the zone is pinned so timestamps are
# reproducible across machines.
SESSION_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
    # concurrent table ingests (plans/runs.ingest_many) share executors fairly
    "spark.scheduler.mode": "FAIR",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "strata", extra: dict | None = None) -> SparkSession:
    """A session with strata's defaults. Local mode (tests, bench) gets a small
    shuffle width and a large driver heap; on a cluster the shuffle width
    is left to the cluster's settings (see ``recommended_conf``) unless
    given, so a fixed small default can never throttle a large job."""
    master = master or os.environ.get("SPARK_MASTER", "local[*]")
    local = master.startswith("local")
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(SESSION_DEFAULTS)
    if shuffle_partitions is not None or local:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or 8)
    if local:
        conf["spark.driver.memory"] = "16g"
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_LOCAL_ROOT: dict[int, str] = {}


def workspace_root(spark: SparkSession) -> str:
    """Shared folder for layer tables, streaming checkpoints and versions.

    On a cluster this is the folder named by ``spark.checkpoint.dir`` (it must
    be shared storage; a cluster session without one is an error). Only a
    local-mode session without one — tests — gets a fresh folder, which is
    also registered as its checkpoint dir.
    """
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.conf.get("spark.checkpoint.dir")
        except Exception:
            root = None
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...): layer tables, "
                               "stream checkpoints and state versions must survive executor loss")
        key = id(spark.sparkContext)
        if key not in _LOCAL_ROOT:
            _LOCAL_ROOT[key] = tempfile.mkdtemp(prefix="strata-ws-")
            spark.sparkContext.setCheckpointDir(os.path.join(_LOCAL_ROOT[key], "rdd"))
        root = _LOCAL_ROOT[key]
    return root.rstrip("/") + "/strata"


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new, unique folder under the workspace (one per run)."""
    return f"{workspace_root(spark)}/{purpose}/{uuid.uuid4().hex}"


#: The most scan and shuffle tasks of one stage: their product is the number of shuffle blocks.
MOST_SCAN_TASKS, MOST_SHUFFLE_PARTITIONS = 200_000, 50_000


def recommended_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 128 << 20) -> dict:
    """Sizing for a cluster run: scan splits of ~128 MB, larger ones where they would be more than ``MOST_SCAN_TASKS``, and as many shuffle partitions
    as splits up to ``MOST_SHUFFLE_PARTITIONS`` (AQE coalesces the small ones and splits skewed ones at run time; a large one spills). Streaming
    state is kept in RocksDB, outside the heap."""
    split = max(target_partition_bytes, -(-input_bytes // MOST_SCAN_TASKS))
    shuffle = min(MOST_SHUFFLE_PARTITIONS, max(2 * total_cores, -(-input_bytes // split)))
    return {
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
