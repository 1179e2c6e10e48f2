"""Session settings and the one way this package cuts lineage."""

from __future__ import annotations

import atexit
import tempfile
import uuid
import warnings
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

# Settings a cluster session should carry.  Broadcasts are left to the
# size-checked threshold; skewed join partitions are split at run time.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # call sites of column expressions are not recorded: building plans is several times faster
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


#: Spark's own setting: remove the shuffle files of an execution when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: If set, gets the plan of every table that ``durable`` writes: a query's own plan shows only what follows the last of them.
plan_listener: Callable[[str], None] | None = None
_staged: list[tuple[SparkSession, str]] = []


def local_session(cores: str = "8", app: str = "treadmark", **conf: str) -> SparkSession:
    """A single-JVM session for tests and the local bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "16g")
    )
    for key, value in {**CLUSTER_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder for checkpoints and scratch tables, as the cluster names it.

    ``spark.checkpoint.dir`` is used when set.  A local session without it gets
    a temporary folder; a cluster session without it is an error, because a
    machine-local folder is lost with its executor.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if not sc.master.startswith("local") and (named.startswith("file:") or ":" not in named):
            warnings.warn(f"{named} must be mounted on every machine of the cluster", stacklevel=2)
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(named)
        return named.rstrip("/")
    current = sc.getCheckpointDir()
    if current is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="treadmark-"))
        current = sc.getCheckpointDir()
    return current.rstrip("/")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared one."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def staged_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared one that goes when the program ends, or with ``clear_staged``."""
    path = scratch_path(spark, name)
    _staged.append((spark, path))
    return path


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that nothing reads any more."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def durable(df: DataFrame, name: str = "stage") -> DataFrame:
    """``df`` written once to the shared folder and read back from there.

    Cuts lineage: what follows reads columns from files and never recomputes
    ``df``, whichever executors are lost.  The folder goes when the program
    ends, or with ``clear_staged``.
    """
    if plan_listener:
        plan_listener(df._jdf.queryExecution().executedPlan().toString())
    path, conf = staged_path(df.sparkSession, name), df.sparkSession.conf
    before = conf.get(CLEANUP, "false")
    conf.set(CLEANUP, "true")  # nothing reads the shuffle files of a written table again
    try:
        df.write.parquet(path)
    finally:
        conf.set(CLEANUP, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@atexit.register
def clear_staged() -> None:
    """Delete the folders that ``durable`` wrote; results that still read them must be written before."""
    while _staged:
        spark, path = _staged.pop()
        try:
            drop_path(spark, path)
        except Exception:  # the session has ended: its temporary folder or the folder's owner cleans up
            _staged.clear()
