"""Session settings that the jobs rely on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {"spark.sql.session.timeZone": "UTC", "spark.sql.mapKeyDedupPolicy": "LAST_WIN"}


def prepare(spark: SparkSession) -> SparkSession:
    """Times are UTC; of repeated JSON keys the last wins."""
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where none is set, one of our own on a single machine; on
    a cluster an error, as what one machine writes to its own disk the others do not see."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
        found = spark.sparkContext.getCheckpointDir()
    return found.rstrip("/")


def written(df: DataFrame) -> DataFrame:
    """A frame written once in the shared folder and read again: what follows finds the same rows,
    and a lost executor costs no more than reading them. Such tables lie in one folder for each
    application, which may be deleted once its results are written."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/questlog-{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
