"""The shared folder: where streams keep their files, and where intermediate tables are written."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}  # of each local application that names no folder


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach: the session's checkpoint folder; a temporary one only in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is not None:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    application = spark.sparkContext.applicationId
    if application not in _own:
        _own[application] = tempfile.mkdtemp(prefix="keyrill-")
    return _own[application]


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder for one run, inside the shared folder."""
    return f"{shared_folder(spark)}/keyrill/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared folder and read it back, so that nothing before it is computed again."""
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _located(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), at


def exists(spark: SparkSession, path: str) -> bool:
    system, at = _located(spark, path)
    return system.exists(at)


def remove(spark: SparkSession, path: str) -> None:
    system, at = _located(spark, path)
    system.delete(at, True)
