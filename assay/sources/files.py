"""Batch and streaming reads of landing files, and listings of them."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from assay.specs import SourceSpec

# JSON landing files hold one array of records each; CSV files have a header row. CSV columns go by the
# names in the header, which every file of a folder must agree on.
READ_OPTIONS = {"json": {"multiLine": "true"}, "csv": {"header": "true", "enforceSchema": "false"}, "parquet": {}}
DATA_FILES = {"json": "*.json", "csv": "*.csv", "parquet": "*.parquet"}


def raw_schema(spark: SparkSession, source: SourceSpec, path: str, pattern: str | None = None) -> StructType:
    """Schema of a source with every raw column, in the order of the files.

    Text for CSV and JSON, so '01234' stays as it is; the types in the file footer for parquet. Names
    are found by Spark: from the header of a CSV file, from all records of JSON files. A mapped column
    that no file has is an error.
    """
    reader = spark.read.format(source.format).options(**READ_OPTIONS[source.format])
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if source.format == "csv":
        reader = reader.option("enforceSchema", "true")
    if source.format == "json":
        reader = reader.option("primitivesAsString", "true")
    found = reader.load(path).schema
    if source.format != "parquet":
        found = StructType([StructField(f.name, StringType()) for f in found])
    missing = sorted(set(source.columns.values()) - set(found.names))
    if missing:
        raise ValueError(f"source {source.name}: no column {', '.join(missing)} in {path}")
    return found


def remembered_schema(spark: SparkSession, source: SourceSpec, path: str, store: str, pattern: str | None = None) -> StructType:
    """The schema kept at ``store``, or the present one, which is then kept: later files are read by it."""
    try:
        return StructType.fromJson(json.loads(spark.read.parquet(store).first()["schema"]))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
    found = raw_schema(spark, source, path, pattern)
    kept = spark.range(1).select(F.lit(json.dumps(found.jsonValue())).alias("schema"))
    kept.coalesce(1).write.parquet(store)
    return found


def read_batch(spark: SparkSession, source: SourceSpec, path: str | None = None) -> DataFrame:
    path = path or source.landing_path
    reader = spark.read.format(source.format).options(**READ_OPTIONS[source.format])
    return reader.schema(raw_schema(spark, source, path)).load(path)


def read_stream(
    spark: SparkSession,
    source: SourceSpec,
    path: str | None = None,
    schema: StructType | None = None,
    max_files: int | None = None,
    pattern: str | None = None,
) -> DataFrame:
    """Incremental read: every new file once, remembered by the checkpoint of the query.

    ``path`` is a folder; ``pattern`` limits it to files of that name.
    """
    path = path or source.landing_path
    reader = spark.readStream.format(source.format).options(**READ_OPTIONS[source.format])
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.schema(schema or raw_schema(spark, source, path, pattern)).load(path)


def list_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, modificationTime, length) of data files; contents are never read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path", "modificationTime", "length")
    )


def latest_file(spark: SparkSession, source: SourceSpec, path: str | None = None) -> DataFrame:
    """One row (entity, source, latest, problem): newest data file of a landing folder."""
    tag = [F.lit(source.entity).alias("entity"), F.lit(source.name).alias("source")]
    try:
        files = list_files(spark, path or source.landing_path, DATA_FILES[source.format])
    except AnalysisException:
        return spark.range(1).select(
            *tag, F.lit(None).cast("timestamp").alias("latest"), F.lit("no such folder").alias("problem")
        )
    newest = files.agg(F.max("modificationTime").alias("latest"))
    return newest.select(*tag, "latest", F.when(F.col("latest").isNull(), F.lit("nothing has arrived")).alias("problem"))
