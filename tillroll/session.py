"""Session construction and the shared scratch / checkpoint locations.

On a cluster, ``spark.checkpoint.dir`` names a shared (HDFS/S3/ABFS) folder.
Everything that has to outlive a task (checkpoints that cut lineage, scratch
tables written by round-trip checks) goes below it. A machine-local folder
is only chosen when the setting is absent, which is the case in unit tests.
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def build_session(
    app_name: str = "tillroll",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Session with UTC wall-clock semantics and adaptive execution on.

    ``master`` and sizing are left to ``spark-submit`` unless given.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        # Local runs / tests only: no shared folder was configured.
        configured = tempfile.mkdtemp(prefix="tillroll-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def _filesystem(spark: SparkSession, path: str):
    """The Hadoop file system of ``path`` and the path in its terms."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return hadoop_path.getFileSystem(conf), hadoop_path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint location, in the scratch
    folder of this application, which is deleted when the application ends."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    own = f"{base}/tillroll-scratch/{spark.sparkContext.applicationId}"
    fs, folder = _filesystem(spark, own)
    fs.mkdirs(folder)
    fs.deleteOnExit(folder)
    return f"{own}/{name}-{uuid.uuid4().hex}"


# Tables of the innermost scratch scope of the current context. Each thread has
# its own context, so overlapping runs cannot see each other's tables; a worker
# thread of a run joins its scope by running in a copy of the run's context.
_scope: ContextVar[list[str] | None] = ContextVar("tillroll_scratch_scope", default=None)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet below the shared checkpoint location and
    read it back: cuts the lineage, survives executor loss, and unlike an
    eager ``checkpoint()`` does not compute the plan a second time to save it.
    Inside ``scratch_scope`` the table is removed when the scope closes,
    elsewhere when the application ends.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    paths = _scope.get()
    if paths is not None:
        paths.append(path)
    return df.sparkSession.read.parquet(path)


@contextmanager
def scratch_scope(spark: SparkSession):
    """Delete the tables materialized inside the block when it ends.

    Only for callers that have finished reading them (e.g. after all results
    are written); DataFrames returned from inside the block must not be used
    afterwards.
    """
    paths: list[str] = []
    token = _scope.set(paths)
    try:
        yield paths
    finally:
        _scope.reset(token)
        for p in paths:
            fs, folder = _filesystem(spark, p)
            fs.delete(folder, True)
