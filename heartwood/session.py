"""A session with the settings the operators are tuned for."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from heartwood.sources.files import remove

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    # a hot account in a fact table is split even where that costs one more shuffle, and
    # early, since its many equal keys compress well and look smaller than they are
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64m",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
}

MIB = 2**20
GIB = 2**30
TIB = 2**40


def settings_for(
    input_bytes: int, bytes_per_partition: int = 5 * GIB, split_bytes: int = 128 * MIB
) -> dict[str, str]:
    """Split and shuffle sizes for raw tables of ``input_bytes`` in total.

    What is shuffled is pre-aggregated and has few columns, at most a twentieth of the
    input: one partition per 5 GiB of input receives about 256 MiB. Adaptive execution
    joins small partitions, so the number may be generous. Beyond some 100 TiB give larger
    ``split_bytes`` and ``bytes_per_partition`` to hold down the number of tasks and blocks.
    """
    partitions = max(-(-input_bytes // bytes_per_partition), 200)
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(split_bytes),
    }


def build_session(
    app_name: str = "heartwood",
    master: str | None = None,
    settings: dict[str, str] | None = None,
    input_bytes: int = 0,
) -> SparkSession:
    """A session; ``input_bytes`` sizes splits and shuffles, ``settings`` have the last word."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    sized = settings_for(input_bytes) if input_bytes else {}
    for key, value in {**SETTINGS, **sized, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables of this application, one that all executors share.

    In ``spark.checkpoint.dir``, or in the warehouse where that is not set.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/intermediate"
    return f"{folder.rstrip('/')}/heartwood-{spark.sparkContext.applicationId}"


def store_once(df: DataFrame) -> DataFrame:
    """Write the rows to the shared folder now and go on from there.

    For a result that several branches read: its plan is carried out once, and executors may be
    lost afterwards. :func:`clear_stored` removes the tables of an application.
    """
    path = f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_stored(spark: SparkSession) -> None:
    """Remove what :func:`store_once` has written for this application; its results end with it."""
    remove(spark, shared_folder(spark))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Store the rows in the cluster's checkpoint folder and go on from there.

    For a result that several steps read. The folder is the one named in
    ``spark.checkpoint.dir``, which all executors have to share; without it this raises.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(folder)
    return df.checkpoint()
