"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# What differs from Spark's own defaults and matters here: rows of an Arrow batch carry whole
# texts or vectors, and stored timestamps must not depend on where a job runs.
SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "5000",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app_name: str = "vecloom", master: str | None = None, **overrides: str) -> SparkSession:
    """Session with SETTINGS; keyword overrides use ``__`` for the dots of a setting's name.

    Shuffle width and memory stay with the cluster: AQE coalesces or splits
    partitions by size, so no width is pinned here.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = SETTINGS | {k.replace("__", "."): str(v) for k, v in overrides.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: the session's ``spark.checkpoint.dir``.

    Only a local session, which has one machine, may fall back to a temporary folder.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured is None:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
            configured = tempfile.mkdtemp(prefix="vecloom-")
        context.setCheckpointDir(configured)
    return context.getCheckpointDir()


def path_exists(spark: SparkSession, name: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


_scopes: list[list[str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    for scope in _scopes:
        scope.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Removes the scratch tables made inside when it ends. Frames that read them must not outlive it."""
    made: list[str] = []
    _scopes.append(made)
    try:
        yield
    finally:
        _scopes.remove(made)
        for name in made:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    It is computed once, survives the loss of any executor, and its readers get column
    pruning and real sizes for the choice of joins.
    """
    path = scratch_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
