"""Folders for tables written between the steps of a job."""

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, else one below the warehouse of the session.

    A warehouse on a local disk will not do on a cluster, where it is another one on each machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        if warehouse.startswith("file:") and not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = warehouse.rstrip("/") + "/checkpoints"
    return folder.rstrip("/")


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows of ``df``, written to the shared folder, with the plan cut there."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, for a table whose reader outlives the step that writes it."""
    return f"{shared_folder(spark)}/loanscope-{uuid.uuid4().hex}/{name}"


@contextmanager
def work_folder(spark: SparkSession) -> Iterator[str]:
    """A new folder in the shared folder, removed with all it holds in the end, also after a failure.

    It is the place of a database that is dropped, so that Spark itself removes
    it, wherever it is stored.
    """
    database = f"work_{uuid.uuid4().hex}"
    path = f"{shared_folder(spark)}/{database}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{path}'")
    try:
        yield path
    finally:
        spark.sql(f"DROP DATABASE {database} CASCADE")


@contextmanager
def intermediates(spark: SparkSession) -> Iterator[str]:
    """A work folder that also takes what ``checkpointed`` writes meanwhile; all of it goes in the end.

    What is to stay must be written elsewhere before.
    """
    context = spark.sparkContext
    with work_folder(spark) as folder:
        context.setCheckpointDir(f"{folder}/checkpoints")
        try:
            yield folder
        finally:
            context.setCheckpointDir(shared_folder(spark))
