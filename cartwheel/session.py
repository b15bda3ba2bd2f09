"""Session settings the operators rely on.

Two settings decide results, not only speed: the session time zone (row keys
use epoch millis of naive timestamps) and ANSI mode (casts and division).
Both are pinned by :func:`configure`; the rest are throughput settings that a
cluster deployment would size to its own data volume.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings that change results; applied to any session the library is given.
RESULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Throughput settings: AQE re-plans joins from runtime sizes (a join side only
# becomes a broadcast when its measured size is under the threshold), coalesces
# small shuffle partitions and splits skewed ones.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.optimizer.nestedSchemaPruning.enabled": "true",
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
}


def configure(spark: SparkSession) -> SparkSession:
    """Pin the result-affecting settings on an existing session."""
    for k, v in RESULT_CONF.items():
        spark.conf.set(k, v)
    return spark


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "cartwheel", extra: dict | None = None) -> SparkSession:
    """Session builder. With a ``local[...]`` master it also sizes shuffles and
    folders for one machine; without a master (spark-submit on a cluster) only
    the result and AQE settings are applied - shuffle sizing then comes from
    the cluster (see :func:`cluster_conf`)."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = {**RESULT_CONF, **SCALE_CONF,
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.execution.arrow.pyspark.enabled": "true"}
    if master and master.startswith("local"):
        # single-machine runs only: a cluster brings its own sizing and folders
        conf.update({
            "spark.sql.shuffle.partitions": str(shuffle_partitions),
            "spark.ui.enabled": "false",
            "spark.driver.memory": os.environ.get("CARTWHEEL_DRIVER_MEMORY", "8g"),
            # bucketed landing registers tables; keep the catalog folder out of the cwd
            "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="cartwheel-wh-")})
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for written tables.

    The session's ``spark.checkpoint.dir``. Where it is unset, a local master
    gets a fresh scratch folder; a cluster must name one, since a folder of
    each machine's own would not be read back by the others."""
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="cartwheel-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    return d


def cluster_conf(input_bytes: int, target_partition_bytes: int = 256 * 1024 * 1024,
                 cores: int | None = None) -> dict[str, str]:
    """Shuffle sizing for a cluster run: start from about one shuffle
    partition per ``target_partition_bytes`` of input (at least 2 per core) and
    let AQE coalesce small ones and split skewed ones at runtime. E.g. 100 TB
    -> ~400k initial partitions of <= 256 MB, each comfortably inside an
    executor's memory with spill."""
    n = max(1, -(-input_bytes // target_partition_bytes))
    if cores:
        n = max(n, 2 * cores)
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(min(target_partition_bytes, 512 * 1024 * 1024)),
    }
