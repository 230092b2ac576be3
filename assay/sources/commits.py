"""Appends that take effect once, by a list of commits that readers honour.

Rows of a run go to a folder of their own; a commit file named after the run, created only if there is
none, then makes them part of the table. A run that broke off leaves a folder no reader looks at and
is simply run again; a run that is repeated changes nothing.
"""

from __future__ import annotations

import json
import uuid
from urllib.parse import quote

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _file(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _file(spark, path)
    return bool(fs.exists(where))


def create_once(spark: SparkSession, path: str, content: str) -> bool:
    """Write a small file, whole and only if there is none; False if there is.

    It is written under another name and renamed, which fails where the name is taken: of two writers one
    succeeds, and a half-written file is never seen.
    """
    fs, where = _file(spark, path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(where.getParent(), f".{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    out.write(bytearray(content.encode()))
    out.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    options = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        context = hadoop.FileContext.getFileContext(where.toUri(), spark._jsc.hadoopConfiguration())
        context.rename(fs.makeQualified(draft), fs.makeQualified(where), options)
    except Py4JJavaError as e:
        fs.delete(draft, False)
        if "FileAlreadyExists" not in e.java_exception.getClass().getName():
            raise
        return False
    return True


def append_once(df: DataFrame, root: str, run: str, partition_by: tuple[str, ...] = ()) -> bool:
    """Append ``df`` as the rows of ``run``; False, and nothing is written, if that run is in the table already."""
    spark = df.sparkSession
    commit = f"{root}/commits/run-{quote(run, safe='')}"
    if exists(spark, commit):
        return False
    folder = f"attempt={uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(f"{root}/data/{folder}")
    return create_once(spark, commit, json.dumps({"run": run, "folder": folder}))


def committed_runs(spark: SparkSession, root: str) -> DataFrame:
    """(run, folder) of every run in the table."""
    schema = "run string, folder string"
    try:
        listed = spark.read.schema("value string").option("pathGlobFilter", "run-*").text(f"{root}/commits")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    return listed.select(F.from_json("value", schema).alias("c")).select("c.run", "c.folder")


def read_committed(spark: SparkSession, root: str, schema: str | StructType | None = None) -> DataFrame:
    """Rows of all committed runs; by ``schema``, if given, also while there are none.

    The folders of committed runs, one name per run, are all that reaches the driver.
    """
    folders = [f"{root}/data/{r['folder']}" for r in committed_runs(spark, root).collect()]
    if not folders and schema is not None:
        return spark.createDataFrame([], schema)
    if not folders:
        raise ValueError(f"nothing was appended to {root}, and no schema is given")
    reader = spark.read.option("basePath", f"{root}/data")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(*sorted(folders)).drop("attempt")
