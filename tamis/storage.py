"""Tables in the folder that the driver and all executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see: ``spark.checkpoint.dir``.

    Where the setting is absent a temporary folder of this application stands in, in local mode alone: elsewhere executors
    would not see it."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if at:
        return at.rstrip("/")
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = tempfile.mkdtemp(prefix="tamis-")
        atexit.register(shutil.rmtree, _own[app], ignore_errors=True)
    return f"file://{_own[app]}"


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/tamis-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"


def materialise(df: DataFrame, name: str, compression: str = "zstd", path: str | None = None, by: str | None = None) -> DataFrame:
    """``df`` written once to the shared folder and read back, which cuts its lineage and survives lost executors; ``by`` is
    a column of few values by which the files are parted, so that a filter on it reads no others."""
    path = path or scratch(df.sparkSession, name)
    out = df.write.option("compression", compression)
    (out.partitionBy(by) if by else out).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def discard(spark: SparkSession, path: str) -> None:
    """Deletes what was written to ``path``, once nothing reads it any more."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
