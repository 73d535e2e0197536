"""What the operators of this subpackage share: tables, and intermediate results in the cluster's shared folder."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
from collections.abc import Iterable

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir of the session. Where that is unset, a single
    machine gets a temporary folder, as in tests; on a cluster this raises, for its machines share no such folder."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        found = "file://" + tempfile.mkdtemp(prefix="studygraph-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


#: Paths written and not deleted yet.
_live: set[str] = set()


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, which counts as live until it is deleted."""
    path = f"{shared_dir(spark)}/studygraph/{name}-{uuid.uuid4().hex}"
    _live.add(path)
    return path


def live() -> set[str]:
    """The paths that results still read. A lazy result needs its last tables until it has been read, so they stay; a
    caller that is done with all results made since `before = live()` deletes them by clear(spark, live() - before), and
    those left go when the driver's Python ends with its session still up."""
    return set(_live)


def clear(spark: SparkSession, paths: Iterable[str]) -> None:
    for path in paths:
        delete(spark, path)


@atexit.register
def _clear_at_exit() -> None:
    spark = SparkSession.getActiveSession() if SparkContext._active_spark_context is not None else None
    if spark is not None:
        with contextlib.suppress(Exception):  # the session may be ending; what is left is files only
            clear(spark, live())


class Written:
    """Tables written on the way to a result. Each cuts the lineage, so that a lost executor costs no more than the
    step that runs. drop() deletes those that no later step reads."""

    CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.paths: dict[str, str] = {}

    def put(self, name: str, df: DataFrame) -> DataFrame:
        """Writes df to the shared folder and reads it again; the shuffle files of that job go at its end."""
        path = fresh_path(self.spark, name)
        before = self.spark.conf.get(self.CLEAN, None)
        self.spark.conf.set(self.CLEAN, "true")
        try:
            df.write.option("compression", "zstd").parquet(path)
        finally:
            if before is None:
                self.spark.conf.unset(self.CLEAN)
            else:
                self.spark.conf.set(self.CLEAN, before)
        self.paths[name] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            delete(self.spark, self.paths.pop(name))


def delete(spark: SparkSession, path: str) -> None:
    """Deletes a path in whatever store holds it."""
    jvm = spark.sparkContext._jvm
    _live.discard(path)
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
