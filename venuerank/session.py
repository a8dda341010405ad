"""Spark session settings and the shared scratch area."""

from __future__ import annotations

import logging
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger(__name__)

# The skew settings matter: a single venue may own a large share of all reviews, and the
# enrichment join relies on AQE to split that venue's partition. A task that writes few partitions
# keeps a file open for each and sorts, and spills, nothing.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.maxConcurrentOutputFileWriters": "16",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}

_local_scratch: dict[str, str] = {}


def build_session(app_name: str = "venuerank", master: str | None = None, **settings: str) -> SparkSession:
    """Session with the engine's defaults; `settings` win over them.

    Dots in setting names are written as double underscores, e.g.
    ``spark__sql__shuffle__partitions="8"``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    merged = dict(SESSION_DEFAULTS)
    merged.update({name.replace("__", "."): value for name, value in settings.items()})
    for name, value in merged.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Put the engine's SQL settings on a session somebody else created."""
    for name, value in SESSION_DEFAULTS.items():
        spark.conf.set(name, value)
    return spark


def sibling(spark: SparkSession) -> SparkSession:
    """Another session of the same application, hence with the same shared folder, and with the same SQL settings."""
    other = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if other.conf.isModifiable(name):
            other.conf.set(name, value)
    return other


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it then gets a temporary folder, says so,
    and has the setting from then on.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if context.applicationId not in _local_scratch:
        made = _local_scratch[context.applicationId] = tempfile.mkdtemp(prefix="venuerank-")
        log.warning("spark.checkpoint.dir is not set, intermediate tables go to %s", made)
        spark.conf.set("spark.checkpoint.dir", made)
    return _local_scratch[context.applicationId]


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Let iterative ML fits checkpoint into the shared folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once to the shared folder and read it back.

    Cuts lineage, computes the rows exactly once, survives the loss of any executor and
    gives the optimizer a real size for later joins.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    stored.scratch_path = path
    return stored


def discard(*stored: DataFrame) -> None:
    """Delete tables that `materialise` made, once everything read from them is itself stored."""
    for df in stored:
        _delete(df.sparkSession, df.scratch_path)


def release_scratch(spark: SparkSession) -> None:
    """Delete what this application wrote to the shared folder; call when its results are stored."""
    _delete(spark, f"{shared_dir(spark)}/{spark.sparkContext.applicationId}")


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
