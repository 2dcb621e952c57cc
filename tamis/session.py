"""Sessions that can run this package's Python functions."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import SparkSession

ROOT = str(Path(__file__).resolve().parent.parent)


def reach(spark: SparkSession) -> SparkSession:
    """Let Python workers find this package where it lies at the same path as on the driver; on clusters where it does
    not, ship it with ``--py-files``."""
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(":") if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = ":".join([*paths, ROOT])
    return spark


def local(cores: int | str = 8, partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and the bench."""
    builder = SparkSession.builder.master(f"local[{cores}]")
    settings = {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        **conf,
    }
    spark = builder.config(map=settings).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return reach(spark)
