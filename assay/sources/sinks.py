"""Writing logs, snapshots and control tables as plain parquet."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assay.sources.commits import append_once, read_committed


def append_log(df: DataFrame, path: str, day_of: str | None = None, run: str | None = None) -> None:
    """Append rows; with ``day_of`` the table is partitioned by the day of that timestamp.

    With ``run`` the rows take effect once, however often that run is appended or broken off; such a log is
    read by ``read_log``.
    """
    partitions = () if day_of is None else ("log_day",)
    rows = df if day_of is None else df.withColumn("log_day", F.to_date(day_of))
    if run is not None:
        append_once(rows, path, run, partitions)
    else:
        rows.write.mode("append").partitionBy(*partitions).parquet(path)


def read_log(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """All rows of a log whose runs have names."""
    return read_committed(spark, path, schema)


def overwrite_snapshot(df: DataFrame, root: str, version: int) -> None:
    """Write a full new version, then point to it. Readers see the old or the new version whole.

    The data go to a folder of a new name, so a run that broke off half-way is simply run again.
    """
    folder = f"version={version}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(f"{root}/data/{folder}")
    pointer = df.sparkSession.range(1).select(
        F.lit(version).cast("long").alias("version"), F.lit(folder).alias("folder"), F.current_timestamp().alias("written")
    )
    pointer.coalesce(1).write.mode("append").parquet(f"{root}/current")


def read_snapshot(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The current version, or an earlier one by number; of a version written twice, the later one."""
    known = spark.read.schema("version long, folder string, written timestamp").parquet(f"{root}/current")
    if version is not None:
        known = known.filter(F.col("version") == version)
    held = known.agg(F.max_by("folder", F.struct("version", "written")).alias("folder")).first()
    if held["folder"] is None:
        raise ValueError(f"no version {version} under {root}")
    return spark.read.parquet(f"{root}/data/{held['folder']}")


def control_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table at ``path``; an empty one of that schema while nothing was written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def create_if_absent(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Create an empty control table; does nothing when it exists."""
    spark.createDataFrame([], schema).write.mode("ignore").parquet(path)
    return control_table(spark, path, schema)
