"""Session helpers: a local session for tests and the shared folder for cut lineage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# For sessions on one machine only.
LOCAL_FOLDER = "file:///tmp/checkpoints/assay"


def local_session(app: str = "assay", cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.checkpoint.dir", LOCAL_FOLDER)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, or the context's checkpoint folder.

    Without either this is an error: a machine-local folder would be lost with its machine.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return configured.rstrip("/")
    if context.getCheckpointDir() is None:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return context.getCheckpointDir().rstrip("/")


def use_local_folder(spark: SparkSession) -> None:
    """Give a single-machine session without a checkpoint folder one of its own; leave others alone."""
    context = spark.sparkContext
    one_machine = context.master == "local" or context.master.startswith("local[")
    if one_machine and not spark.conf.get("spark.checkpoint.dir", None) and context.getCheckpointDir() is None:
        context.setCheckpointDir(LOCAL_FOLDER)


# Paths given out in this process, for release().
_GIVEN: list[str] = []


def new_shared_path(spark: SparkSession, label: str) -> str:
    _GIVEN.append(f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}")
    return _GIVEN[-1]


def release(spark: SparkSession) -> int:
    """Delete all tables this process has cut or kept in the shared folder; returns how many paths there were.

    Call it when the results are written: a DataFrame that still reads one of them fails afterwards.
    """
    for path in _GIVEN:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    paths = len(_GIVEN)
    _GIVEN.clear()
    return paths


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` as Parquet in the shared folder and forget how it was made.

    Unlike a checkpoint it is read back by column, with statistics and pushed filters.
    """
    path = new_shared_path(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
