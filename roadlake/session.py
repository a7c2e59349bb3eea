"""Session construction and the shared folder used for lineage cuts/sinks."""

from __future__ import annotations

import functools
import tempfile

from pyspark.sql import SparkSession

# Settings the pipeline relies on.  Session time zone is part of the data
# contract: day keys (``dt``) and hour buckets are UTC.
PIPELINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


# Starting points for a large cluster (1000 executors, ~100 TB inputs): many
# shuffle partitions that AQE coalesces to ~256 MB each, 512 MB scan splits,
# and broadcasts only below a measured 64 MB.  Applied when no master is
# given (spark-submit decides the cluster); any key can be overridden.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "16000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
}


def build_session(master: str | None = None, app: str = "roadlake",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the pipeline's settings.

    On a cluster pass ``master=None`` and let spark-submit decide; for local
    tests pass ``"local[8]"`` and a small ``shuffle_partitions``.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(PIPELINE_CONF)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    if master and master.startswith("local"):
        conf["spark.driver.memory"] = "12g"
    elif not master:
        conf.update(CLUSTER_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Pin the session zone to UTC (day keys are defined in UTC)."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def ensure_compiled(spark: SparkSession) -> None:
    """Keep generated methods to a size that the JVM compiles: a larger one
    (the feeds' wide projections) would run interpreted."""
    key, limit = "spark.sql.codegen.hugeMethodLimit", PIPELINE_CONF["spark.sql.codegen.hugeMethodLimit"]
    if spark.conf.get(key, None) != limit:
        spark.conf.set(key, limit)


def shared_dir(spark: SparkSession) -> str:
    """Folder shared by all executors: the session's checkpoint directory.

    The cluster names it in ``spark.checkpoint.dir``; only when it is unset
    (local tests) is a private temporary folder created and registered; on
    any other master an unset folder is an error, as executors would write to
    their own disks.
    """
    try:
        sc = spark.sparkContext
    except Exception:                      # remote (Connect) session: no context
        sc = None
    if sc is None:
        d = spark.conf.get("spark.checkpoint.dir", None)
        if not d:
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        return d.rstrip("/")
    d = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="roadlake-ckpt-"))
        d = sc.getCheckpointDir()
    return d.rstrip("/")


def parallelism(spark: SparkSession) -> int:
    """Shuffle width for CPU-heavy stages: the configured shuffle partition
    count (sized for the data, e.g. 16000 on a large cluster), never fewer
    than the task slots (default parallelism)."""
    width = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    try:
        slots = int(spark.sparkContext.defaultParallelism)
    except Exception:                      # remote session: no context
        slots = 1
    return max(width, slots, 1)


def path_exists(spark: SparkSession, path: str) -> bool | None:
    """Whether a folder exists on its Hadoop file system (None when the
    file system is not reachable from this session)."""
    try:
        jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        p = jvm.org.apache.hadoop.fs.Path(path)
        return bool(p.getFileSystem(conf).exists(p))
    except Exception:
        return None


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a folder that a job wrote, on its Hadoop file system."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def expr_cache(fn):
    """Memoise a function that builds (unresolved) Column expressions.

    Column trees are immutable and not bound to any DataFrame, so one copy
    per Spark context can serve every query; building the large normaliser
    expressions once saves thousands of driver-to-JVM calls per query.
    Arguments must be hashable."""
    cache = {}

    @functools.wraps(fn)
    def wrapper(*args):
        from pyspark import SparkContext
        # the context object itself is the key (held, so never confused with
        # a later context); a stopped context's entries are simply unused
        key = (SparkContext._active_spark_context,) + args
        if key not in cache:
            cache[key] = fn(*args)
        return cache[key]
    return wrapper
