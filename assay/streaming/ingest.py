"""Landing files to raw and standardised tables as Structured Streaming queries.

Each source is one query with its own checkpoint: a restart continues after the last finished
file. Standardising is stateless, so nothing is shuffled and no watermark is needed.
"""

from __future__ import annotations

from pyspark.errors import PySparkException, StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from assay.operators.standardize import standardize, union_all
from assay.sources import commits, evolution, files
from assay.specs import EntitySpec, SourceSpec


class IngestError(RuntimeError):
    """Some sources did not land; the message names them."""


def tag_stream(df: DataFrame, source: SourceSpec, as_of=None) -> DataFrame:
    """Provenance for streamed rows; the load time is the batch time unless given."""
    loaded = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    return df.select(
        "*",
        F.lit(source.name).alias("_source_system"),
        F.lit(source.priority).cast("int").alias("_source_priority"),
        loaded.alias("_ingested_at"),
        F.col("_metadata.file_path").alias("_source_file"),
    )


def _drain(df: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    return (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(table)
    )


def ingest_source(
    spark: SparkSession,
    source: SourceSpec,
    landing: str,
    table: str,
    checkpoint: str,
    as_of=None,
    schema=None,
    max_files: int | None = None,
    pattern: str | None = None,
) -> StreamingQuery:
    """Append every landing file not seen before to the raw table of the source.

    Unless given, the schema of the first run is kept beside the checkpoint and used from then on.
    """
    if schema is None:
        schema = files.remembered_schema(spark, source, landing, f"{checkpoint.rstrip('/')}-schema", pattern)
    raw = files.read_stream(spark, source, landing, schema=schema, max_files=max_files, pattern=pattern)
    return _drain(tag_stream(raw, source, as_of), table, checkpoint)


def ingest_entity(spark: SparkSession, entity: EntitySpec, root: str, as_of=None, landing: str | None = None) -> dict:
    """Start one query per source of the entity and wait for all; returns raw table paths.

    A source that cannot start or fails does not keep the others from landing; which ones failed, and
    why, is raised at the end.
    """
    tables = {s.name: f"{root}/{s.raw_table}" for s in entity.sources}
    running, failed = {}, {}
    for s in entity.sources:
        try:
            running[s.name] = ingest_source(
                spark,
                s,
                f"{landing}/{s.landing_path}" if landing else s.landing_path,
                tables[s.name],
                f"{root}/_checkpoints/{s.raw_table}",
                as_of,
            )
        except (PySparkException, ValueError) as e:
            failed[s.name] = e
    for name, query in running.items():
        try:
            query.awaitTermination()
        except StreamingQueryException as e:
            failed[name] = e
    if failed:
        raise IngestError("; ".join(f"{name}: {str(e).splitlines()[0]}" for name, e in failed.items()))
    return tables


def standardize_stream(spark: SparkSession, entity: EntitySpec, tables: dict[str, str]) -> DataFrame:
    """One canonical stream over the raw tables of all sources."""
    frames = []
    for source in entity.sources:
        path = tables[source.name]
        raw = spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)
        frames.append(standardize(raw, entity, source))
    return union_all(frames)


def refresh_standardized(
    spark: SparkSession, entity: EntitySpec, tables: dict[str, str], table: str, checkpoint: str
) -> None:
    """Append what is new in the raw tables to the standardised table."""
    _drain(standardize_stream(spark, entity, tables), table, checkpoint).awaitTermination()


def land_evolving(
    spark: SparkSession,
    source: SourceSpec,
    landing: str,
    table: str,
    checkpoint: str,
    as_of=None,
    max_files: int = 1_000,
    pattern: str | None = None,
    **options,
) -> StreamingQuery:
    """Append every new landing file to ``table`` by a schema that follows the files; see ``read_landed``.

    The stream is one of file names: each batch of at most ``max_files`` first brings the schema up to date, then
    reads its files by it. Batches are appended once each, so one that broke off is landed again whole.
    """
    listing = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("pathGlobFilter", pattern or files.DATA_FILES[source.format])
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", str(max_files))
        .load(landing)
        .select("path")
    )
    loaded = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")

    def land(names: DataFrame, batch: int) -> None:
        paths = [r["path"] for r in names.collect()]
        if not paths:
            return
        store = evolution.SchemaStore(names.sparkSession, schema_path(table))
        rows = evolution.read_files(names.sparkSession, source, paths, store, **options)
        tagged = rows.select(
            "*",
            F.lit(source.name).alias("_source_system"),
            F.lit(source.priority).cast("int").alias("_source_priority"),
            loaded.alias("_ingested_at"),
        )
        commits.append_once(tagged, table, f"batch-{batch}")

    return (
        listing.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def schema_path(table: str) -> str:
    return f"{table.rstrip('/')}/schema"


def read_landed(spark: SparkSession, table: str, version: int | None = None) -> DataFrame:
    """All rows landed so far by the newest schema, or by an earlier version of it, with provenance and ``_rescued``."""
    _, schema = evolution.SchemaStore(spark, schema_path(table)).latest(version)
    own = f"{evolution.RESCUED} map<string, string>, _source_file string, _source_system string, _source_priority int, _ingested_at timestamp"
    return commits.read_committed(spark, table, StructType([*schema.fields, *StructType.fromDDL(own).fields]))
