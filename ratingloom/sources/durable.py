"""Intermediate tables that are written once and survive the loss of an executor."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, from the setting ``spark.checkpoint.dir``.

    Only a local session without the setting gets a folder of its own.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not folder:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="ratingloom-"))
        folder = sc.getCheckpointDir()
    return folder.rstrip("/")


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder once and read it from there.

    Used where a table is read several times (a fitted table, token counts) or
    where a plan grows with every iteration. The copy is columnar, so a reader
    takes only its columns, and its size is known to the join planner.
    """
    spark = df.sparkSession
    # one folder per application, to be deleted when the application is done
    path = f"{shared_folder(spark)}/ratingloom/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
