"""Landing files whose columns change: versions of a schema, a rule to merge them, and a map for what does not fit.

Every set of new files is first asked for its columns, per group of files that agree (CSV: by header, JSON: all
names in the records, Parquet: by footer). What is new joins the schema as its next version; rows are then
read by the merged schema. Three rules decide per column:

* a new column is added, null in older rows; a missing one is null;
* a wider type of the same kind (whole, fractional, decimal, date to timestamp) widens the column;
* any other type leaves it as it is: a value is cast if its cast can be cast back to the same value,
  else it goes, as text, into the map column ``_rescued`` under its name, and the column is null.

Names that differ only in case are one column; further ones of the same file are rescued. Lines or
documents that cannot be parsed are rescued whole under ``_line``. So no value is lost, whatever arrives.
"""

from __future__ import annotations

import json
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assay.sources.commits import create_once
from assay.sources.files import DATA_FILES, READ_OPTIONS, list_files
from assay.specs import SourceSpec

RESCUED = "_rescued"
BAD_LINE = "_line"
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTION = (T.FloatType, T.DoubleType)
# Types a text column may be inferred to have, the first that gives every value back.
INFERRED = ("bigint", "double", "date", "timestamp", "boolean")


class SchemaStore:
    """Numbered versions of one schema under a path, one small file each; none is ever overwritten."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def versions(self) -> DataFrame:
        """(version, schema as JSON) of every version."""
        try:
            files = self.spark.read.schema("value string").option("pathGlobFilter", "version-*").text(self.path)
        except PySparkException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], "version int, schema string")
        number = F.regexp_extract("_metadata.file_name", r"^version-(\d+)$", 1).cast("int")
        return files.select(number.alias("version"), F.col("value").alias("schema"))

    def latest(self, version: int | None = None) -> tuple[int, T.StructType]:
        """The newest version (or an earlier one) and its number; 0 and no columns before the first."""
        known = self.versions()
        if version is not None:
            known = known.filter(F.col("version") == version)
        row = known.agg(F.max_by("schema", "version").alias("schema"), F.max("version").alias("version")).first()
        if row["version"] is None and version:
            raise ValueError(f"no version {version} under {self.path}")
        return (row["version"], T.StructType.fromJson(json.loads(row["schema"]))) if row["version"] else (0, T.StructType())

    def evolve(self, found: T.StructType, attempts: int = 5) -> T.StructType:
        """Merge ``found`` into the newest version and keep the result if it differs.

        Another writer may be faster; the merge is then made again with what that one wrote.
        """
        for _ in range(attempts):
            version, known = self.latest()
            merged = merge(known, found)
            if version and merged == known:
                return known
            if create_once(self.spark, f"{self.path}/version-{version + 1:06d}", merged.json()):
                return merged
        raise RuntimeError(f"{self.path} keeps changing")


def wider(known: T.DataType, found: T.DataType) -> T.DataType:
    """The type of a column that had ``known`` when values of ``found`` arrive."""
    for kinds in (_WHOLE, _FRACTION):
        if isinstance(known, kinds) and isinstance(found, kinds):
            return max(known, found, key=lambda t: kinds.index(type(t)))
    if isinstance(known, T.DecimalType) and isinstance(found, T.DecimalType):
        scale = max(known.scale, found.scale)
        whole = max(known.precision - known.scale, found.precision - found.scale)
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else known
    if isinstance(known, T.DateType) and isinstance(found, T.TimestampNTZType):
        return found
    if isinstance(known, T.NullType):
        return found
    if isinstance(known, T.StructType) and isinstance(found, T.StructType):
        return merge(known, found)
    if isinstance(known, T.ArrayType) and isinstance(found, T.ArrayType):
        return T.ArrayType(wider(known.elementType, found.elementType))
    return known


def merge(known: T.StructType, found: T.StructType) -> T.StructType:
    """``known`` with wider types where ``found`` has them, then the new columns of ``found``; all nullable."""
    at = {f.name.lower(): f for f in known.fields}
    for f in found.fields:
        old = at.get(f.name.lower())
        at[f.name.lower()] = T.StructField(old.name if old else f.name, wider(old.dataType, f.dataType) if old else f.dataType)
    return T.StructType(list(at.values()))


def _options(fmt: str) -> dict[str, str]:
    if fmt == "parquet":
        return {}
    return READ_OPTIONS[fmt] | {"enforceSchema": "true", "columnNameOfCorruptRecord": BAD_LINE}


def _csv_groups(spark: SparkSession, paths: list[str]) -> list[tuple[list[str], T.StructType]]:
    """Files by their header line; the first line of a file is the first of the split at its start."""
    path = F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B"))).alias("file_path")
    lines = spark.read.schema("value string").text(paths).select(
        "value", path, "_metadata.file_block_start", F.monotonically_increasing_id().alias("at")
    )
    first = lines.filter("file_block_start = 0").groupBy("file_path").agg(F.min_by("value", "at").alias("header"))
    by: dict[str, list[str]] = {}
    for r in first.collect():
        by.setdefault(r["header"], []).append(r["file_path"])
    groups = []
    for header in sorted(by):
        names = spark.read.options(**_options("csv")).csv(sorted(by[header])[:1]).schema.names
        groups.append((by[header], T.StructType([T.StructField(n, T.StringType()) for n in names])))
    return groups


def _json_groups(spark: SparkSession, paths: list[str]) -> list[tuple[list[str], T.StructType]]:
    names = spark.read.options(**_options("json"), primitivesAsString="true").json(paths).schema.names
    return [(paths, T.StructType([T.StructField(n, T.StringType()) for n in names if n != BAD_LINE]))]


def _parquet_groups(spark: SparkSession, paths: list[str]) -> list[tuple[list[str], T.StructType]]:
    """Files whose footers agree. Where a merge of all fails, halves are tried: a few jobs per real conflict."""
    try:
        return [(paths, spark.read.option("mergeSchema", "true").parquet(*paths).schema)]
    except (PySparkException, Py4JJavaError) as e:
        if len(paths) == 1 or "CANNOT_MERGE" not in str(e):
            raise
    half = len(paths) // 2
    groups: list[tuple[list[str], T.StructType]] = []
    for files, schema in _parquet_groups(spark, paths[:half]) + _parquet_groups(spark, paths[half:]):
        same = next((g for g in groups if g[1] == schema), None)
        if same:
            same[0].extend(files)
        else:
            groups.append((list(files), schema))
    return groups


_GROUPS = {"csv": _csv_groups, "json": _json_groups, "parquet": _parquet_groups}


def _text(column: Column, kind: T.DataType) -> Column:
    return F.to_json(column) if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)) else column.cast("string")


def inferred(df: DataFrame, columns: list[str]) -> dict[str, str]:
    """For text columns the first type of INFERRED whose text is the very text of every value, else string.

    '007' is therefore no number. A column without values is a string. One aggregate over all columns.
    """
    if not columns:
        return {}
    checks = []
    for i, c in enumerate(columns):
        value = F.col(f"`{c}`")
        checks.append(F.count(value).alias(f"n{i}"))
        for j, kind in enumerate(INFERRED):
            checks.append(F.count(F.when(value.try_cast(kind).cast("string") == value, 1)).alias(f"n{i}_{j}"))
    n = df.agg(*checks).first()
    return {
        c: next((kind for j, kind in enumerate(INFERRED) if n[f"n{i}"] and n[f"n{i}_{j}"] == n[f"n{i}"]), "string")
        for i, c in enumerate(columns)
    }


def fitted(df: DataFrame, found: T.StructType, target: T.StructType) -> DataFrame:
    """``df``, with the columns ``found`` (and _line, if it has one), as the columns of ``target`` and ``_rescued``."""
    at: dict[str, T.StructField] = {}
    misfits: list[tuple[str, Column]] = []
    for f in found.fields:
        if f.name.lower() in at:
            misfits.append((f.name, _text(F.col(f"`{f.name}`"), f.dataType)))
        else:
            at[f.name.lower()] = f
    columns = []
    for t in target.fields:
        f = at.get(t.name.lower())
        if f is None:
            columns.append(F.lit(None).cast(t.dataType).alias(t.name))
            continue
        value = F.col(f"`{f.name}`")
        if f.dataType == t.dataType or wider(f.dataType, t.dataType) == t.dataType:
            columns.append(value.cast(t.dataType).alias(t.name))
            continue
        nested = any(isinstance(k, (T.StructType, T.ArrayType, T.MapType)) for k in (f.dataType, t.dataType))
        text = _text(value, f.dataType)
        if isinstance(t.dataType, T.StringType):
            columns.append(text.alias(t.name))
            continue
        if nested:
            columns.append(F.lit(None).cast(t.dataType).alias(t.name))
            misfits.append((f.name, text))
            continue
        cast = value.try_cast(t.dataType)
        # a date for a time, or 1 for 1.0, is given back by its own type, text only by its text
        fits = cast.isNotNull() & (cast.try_cast(f.dataType) == value)
        columns.append(F.when(fits, cast).alias(t.name))
        misfits.append((f.name, F.when(~F.coalesce(fits, F.lit(False)), text)))
    if BAD_LINE in df.columns and BAD_LINE not in found.names:
        misfits.append((BAD_LINE, F.col(BAD_LINE)))
    entries = F.filter(
        F.array(*[F.struct(F.lit(n).alias("key"), v.alias("value")) for n, v in misfits])
        if misfits
        else F.array().cast("array<struct<key: string, value: string>>"),
        lambda e: e["value"].isNotNull(),
    )
    rescued = F.when(F.size(entries) > 0, F.map_from_entries(entries)).cast("map<string, string>")
    file = F.col("_metadata.file_path").alias("_source_file")
    return df.select(*columns, rescued.alias(RESCUED), file)


def read_files(
    spark: SparkSession,
    source: SourceSpec,
    paths: list[str],
    store: SchemaStore,
    infer: bool = False,
    types: dict[str, str] | None = None,
) -> DataFrame:
    """Rows of the files by the schema in ``store``, which learns their new columns first.

    Columns that CSV and JSON files bring are text, or what ``types`` says, or with ``infer`` a type that
    gives back every value of the files that bring them. A column the source maps must be known by then.
    """
    read = []
    _, known = store.latest()
    names = {f.name.lower() for f in known.fields}
    proposals = []
    for files, found in _GROUPS[source.format](spark, sorted(paths)):
        if source.format == "parquet":
            df, proposed = spark.read.schema(found).parquet(*files), found
        else:
            first: dict[str, str] = {}  # names that differ in case cannot be read apart
            for n in found.names:
                first.setdefault(n.lower(), n)
            declared = {c.lower(): t for c, t in (types or {}).items()}
            schema = T.StructType([*found.fields, T.StructField(BAD_LINE, T.StringType())])
            df = spark.read.options(**_options(source.format)).schema(schema).format(source.format).load(files)
            new = [n for k, n in first.items() if k not in names]
            kinds = inferred(df, [n for n in new if n.lower() not in declared]) if infer else {}
            kinds |= {n: declared[n.lower()] for n in new if n.lower() in declared}
            proposed = T.StructType(
                [T.StructField(n, T._parse_datatype_string(kinds.get(n, "string"))) for n in new]
            )
        proposals.append(proposed)
        read.append((df, found))
    merged = reduce(merge, proposals, known)
    missing = sorted({c for c in source.columns.values()} - set(merged.names))
    if missing:
        raise ValueError(f"source {source.name}: no column {', '.join(missing)} in its files")
    target = store.evolve(merged)
    frames = [fitted(df, found, target) for df, found in read]
    return reduce(DataFrame.unionByName, frames)


def read_evolving(
    spark: SparkSession, source: SourceSpec, store: SchemaStore, path: str | None = None, **options
) -> DataFrame:
    """Batch read of all data files of a landing folder; see read_files."""
    found = list_files(spark, path or source.landing_path, DATA_FILES[source.format]).select("path").collect()
    if not found:
        raise ValueError(f"source {source.name}: no files in {path or source.landing_path}")
    return read_files(spark, source, [r["path"] for r in found], store, **options)
