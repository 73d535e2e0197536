"""Registry of named queries and of the SQL each one is compared with."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the parquet tables of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all machines share, spark.checkpoint.dir; a single machine that lacks it gets a temporary one, which
    the session keeps."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        shared = "file://" + tempfile.mkdtemp(prefix="studygraph-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return shared.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that all machines share."""
    return f"{shared_dir(spark)}/studygraph-{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """df written to the shared folder by checkpoint(), so that a lost executor costs no more than what follows."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


def drop(spark: SparkSession, path: str) -> None:
    """Deletes a path in whatever store holds it."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Registers a function (spark, sf_dir) -> DataFrame under a name, with the SQL that gives the same rows."""

    def register(f: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = f
        if oracle is not None:
            ORACLES[name] = oracle
        return f

    return register
