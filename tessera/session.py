"""SparkSession construction with the settings the plans rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings every plan in this package is designed around. AQE re-plans at each
# shuffle: it coalesces small partitions, turns small shuffled sides into
# broadcasts from measured sizes, and splits skewed join partitions (a hot
# engagement or a hot NULL key) into several tasks.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Settings for the full-size job (on the order of 100 TB of product rows on
# about 1,000 executors). Scan splits of 1 GB keep the map side at 1e5 tasks
# there; the number of reducers is set from the input by size_shuffles(). A
# partition over 1 GB and 5x the median is split by the skew-join rule.
# Blocks are meant to be served by the external shuffle service with
# push-based merging (YARN): a reducer then reads merged chunks instead of a
# small block from every map task. Without that service, decommissioning
# migrates shuffle and cached blocks off an executor that is being taken away.
CLUSTER_CONF = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "512m",
    "spark.sql.files.maxPartitionBytes": "1g",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.shuffle.push.enabled": "true",
    "spark.decommission.enabled": "true",
    "spark.storage.decommission.enabled": "true",
    "spark.storage.decommission.shuffleBlocks.enabled": "true",
    "spark.task.maxFailures": "8",
}

PROFILES = {"local": {}, "cluster": CLUSTER_CONF}


def build_session(
    master: str | None = None,
    app_name: str = "tessera",
    shuffle_partitions: int | None = None,
    checkpoint_dir: str | None = None,
    extra_conf: dict[str, str] | None = None,
    profile: str = "local",
) -> SparkSession:
    """Create (or reuse) a session with the package defaults.

    ``checkpoint_dir`` is only a fallback: a directory the cluster already
    names in ``spark.checkpoint.dir`` always wins.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    conf.update(PROFILES[profile])
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark, checkpoint_dir)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str | None:
    """Make sure reliable checkpoints have a shared directory to go to.

    The directory named by ``spark.checkpoint.dir`` is used when present;
    ``fallback`` is applied only where that setting is unset (tests, local
    runs). Returns the directory in effect, or None when there is none.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    target = configured or fallback
    if target:
        sc.setCheckpointDir(target)
        return sc.getCheckpointDir()
    return None


# Input behind one reducer. Shuffles carry narrow product rows, about a fifth
# of the input, so a reducer reads about 400 MB.
BYTES_A_REDUCER = 2 << 30
MOST_REDUCERS = 50_000


def size_shuffles(spark: SparkSession, input_bytes: int) -> int:
    """Set the number of shuffle partitions from the size of the input."""
    cores = spark.sparkContext.defaultParallelism
    parts = min(MOST_REDUCERS, max(2 * cores, -(-input_bytes // BYTES_A_REDUCER)))
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    return parts


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below ``path``, from the file system's own summary."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(where).getLength()
