"""Session helpers: a configured SparkSession and the shared output folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None, app: str = "grantscope") -> SparkSession:
    """A session. With a ``master`` (tests, bench) it gets local settings; without one, the cluster's own settings
    stay as they are, but for the SQL settings of ``CLUSTER_SQL_CONF`` that the cluster has not set itself."""
    builder = SparkSession.builder.appName(app)
    if master is None:
        spark = builder.getOrCreate()
        return apply_cluster_conf(spark)
    spark = (
        builder.master(master)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    try:
        spark.sparkContext.setLogLevel("ERROR")
    except Exception:
        pass
    return spark


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh folder under the cluster's shared ``spark.checkpoint.dir``.

    The setting is read from the session (or the context's checkpoint folder).
    Only a plain local master, where driver and tasks share one machine, may
    leave it unset: then a scratch folder is made. On a cluster an unset
    folder is an error, because executors could not see a driver-local path.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="grantscope-")
        spark.sparkContext.setCheckpointDir(base)
        base = spark.sparkContext.getCheckpointDir()
    base = str(base).rstrip("/")
    leaf = "/".join(parts) if parts else "run"
    return f"{base}/grantscope/{leaf}-{uuid.uuid4().hex[:12]}"


# Settings for a large cluster (~100 TB of grants). SQL settings are applied
# to a running session by ``apply_cluster_conf``; the rest belong on spark-submit.
CLUSTER_SQL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.shuffle.partitions": "20000",  # upper bound; AQE coalesces small partitions
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.session.timeZone": "UTC",
}
CLUSTER_SUBMIT_CONF = {
    "spark.task.maxFailures": "8",
    "spark.stage.maxConsecutiveAttempts": "8",
    "spark.decommission.enabled": "true",
    "spark.storage.decommission.enabled": "true",
    "spark.storage.decommission.shuffleBlocks.enabled": "true",
    "spark.speculation": "true",
}


def apply_cluster_conf(spark: SparkSession, conf: dict | None = None) -> SparkSession:
    """Set what the cluster's own configuration leaves unset; a plain local master is left alone."""
    master = spark.sparkContext.master
    if master == "local" or master.startswith("local["):
        return spark
    given = dict(spark.sparkContext.getConf().getAll())
    for k, v in (conf or CLUSTER_SQL_CONF).items():
        if k not in given:
            spark.conf.set(k, v)
    return spark


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, in whatever store the path names."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


@contextmanager
def sql_setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A SQL setting of the session for the plans made inside, then as it was."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def file_stream(spark: SparkSession, source_dir: str, schema, fmt: str = "parquet", max_files: int | None = None,
                file_glob: str | None = None):
    """A stream of the files in ``source_dir``, with a declared schema.

    ``max_files`` bounds the files of a micro-batch; by default a backlog is one micro-batch.
    """
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    return reader.load(source_dir)
