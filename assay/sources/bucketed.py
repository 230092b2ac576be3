"""A keyed table in buckets, of which a change rewrites only those it touches.

A version is one small file that names, for every bucket, the folder its rows lie in. A change writes the
touched buckets to a new folder and then the next version, which keeps the folders of all others: their
files stay as they are, byte by byte. Readers see the old or the new version whole; a change that broke
off leaves a folder no version names.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from assay.operators.upsert import latest_per_key, upsert
from assay.session import cut
from assay.sources.commits import create_once


class BucketedTable:
    """``keys`` decide the bucket of a row; ``buckets`` holds for a new table, an existing one keeps its own number."""

    def __init__(self, spark: SparkSession, root: str, keys: list[str], buckets: int = 64) -> None:
        self.spark, self.root, self.keys, self.buckets = spark, root.rstrip("/"), keys, buckets

    def version(self, number: int | None = None) -> dict | None:
        """The newest version (or an earlier one): number, buckets, schema and the folder of each bucket that has rows."""
        try:
            listed = self.spark.read.schema("value string").option("pathGlobFilter", "version-*").text(f"{self.root}/versions")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        at = F.regexp_extract("_metadata.file_name", r"^version-(\d+)$", 1).cast("int")
        if number is not None:
            listed = listed.filter(at == number)
        held = listed.agg(F.max_by("value", at).alias("value")).first()["value"]
        return json.loads(held) if held else None

    def bucket(self) -> Column:
        held = self.version()
        return F.pmod(F.hash(*self.keys), F.lit(held["buckets"] if held else self.buckets))

    def touched(self, rows: DataFrame) -> list[int]:
        """Buckets of the keys of ``rows``; at most as many numbers as there are buckets."""
        return sorted(r["b"] for r in rows.select(self.bucket().alias("b")).distinct().collect())

    def read(self, schema: str | None = None, only: Iterable[int] | None = None, number: int | None = None) -> DataFrame:
        """All rows, or those of some buckets; an empty table of ``schema`` while nothing was written."""
        held = self.version(number)
        if held is None:
            if schema is None or number is not None:
                raise ValueError(f"nothing was written to {self.root}")
            return self.spark.createDataFrame([], schema)
        kinds = StructType.fromJson(held["schema"])
        wanted = None if only is None else {str(b) for b in only}
        paths = [f"{self.root}/data/{f}/bucket={b}" for b, f in held["folders"].items() if wanted is None or b in wanted]
        return self.spark.read.schema(kinds).parquet(*sorted(paths)) if paths else self.spark.createDataFrame([], kinds)

    def replace(self, rows: DataFrame, touched: list[int] | None = None) -> int:
        """Put ``rows`` in place of all rows of the touched buckets (of all without); returns the new version."""
        held = self.version()
        buckets = held["buckets"] if held else self.buckets
        folder = f"attempt={uuid.uuid4().hex}"
        marked = rows.withColumn("bucket", self.bucket())
        marked.repartition("bucket").write.partitionBy("bucket").parquet(f"{self.root}/data/{folder}")
        written = self._written(f"{self.root}/data/{folder}")
        folders = {} if held is None or touched is None else dict(held["folders"])
        for b in folders.keys() & {str(b) for b in touched or ()}:
            del folders[b]
        if touched is not None and not written <= set(touched):
            raise ValueError(f"rows of buckets {sorted(written - set(touched))} that are not replaced")
        number = (held["number"] if held else 0) + 1
        manifest = {
            "number": number,
            "buckets": buckets,
            "schema": rows.schema.jsonValue(),
            "folders": folders | {str(b): folder for b in written},
        }
        if not create_once(self.spark, f"{self.root}/versions/version-{number:08d}", json.dumps(manifest)):
            raise RuntimeError(f"another writer made version {number} of {self.root}")
        return number

    def _written(self, path: str) -> set[int]:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = where.getFileSystem(self.spark._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in fs.listStatus(where)]
        return {int(n.partition("=")[2]) for n in names if n.startswith("bucket=")}

    def merge(self, source: DataFrame, recency: str) -> int:
        """Insert every source row, or put it in place of the row of its key; returns how many buckets were rewritten."""
        held = self.version()
        if held is None:
            self.replace(latest_per_key(source, self.keys, recency))
            return self.buckets
        incoming = cut(latest_per_key(source, self.keys, recency))
        touched = self.touched(incoming)
        if touched:
            old = self.read(only=touched)
            self.replace(upsert(old, incoming.select(*old.columns), self.keys, recency), touched)
        return len(touched)
