"""What the operators share: materialising in the shared folder, label splits, ranks without hot tasks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from assay.session import new_shared_path

# Hexadecimal digits of the hash that splits a group before its rows are ranked: 16 ** 3 parts.
SPLIT_DIGITS = 3


# Bytes of a batch sent to Python: a task holds a few times as many. Spark's own limit is 64 MB.
BATCH_BYTES = 4 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession) -> None:
    """Set the session's limit of bytes per batch, unless it is below Spark's own default already."""
    if int(spark.conf.get(_BATCH).rstrip("b")) >= 64 << 20:
        spark.conf.set(_BATCH, str(BATCH_BYTES))


def unused(columns: list[str], *names: str) -> list[str]:
    """``names``, each with as many underscores behind it as it takes to be none of ``columns``, in any case."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, no lineage, safe from lost executors."""
    path = new_shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Rows of a few numbers that are broadcast at most: some 30 MB.
BROADCAST_ROWS = 1_000_000


def small_side(kept: DataFrame) -> DataFrame:
    """A materialised table marked for broadcast if its row count, which is looked up, is small enough."""
    return F.broadcast(kept) if kept.count() <= BROADCAST_ROWS else kept


def delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


class Scratch:
    """Tables that an operator materialises on its way, in one folder that goes when its result is written.

    Nothing that is still to be computed may read a table that is discarded.
    """

    def __init__(self, spark: SparkSession, label: str) -> None:
        self.spark, self.root, self.made = spark, new_shared_path(spark, label), 0

    def keep(self, df: DataFrame, label: str) -> DataFrame:
        path = f"{self.root}/{self.made}-{label}"
        self.made += 1
        df.write.parquet(path)
        kept = self.spark.read.schema(df.schema).parquet(path)
        kept.scratch_path = path
        return kept

    def discard(self, kept: DataFrame) -> None:
        delete(self.spark, kept.scratch_path)

    def clear(self) -> None:
        delete(self.spark, self.root)


def crc_remainder(doc_id: str | Column, parts: int) -> Column:
    """crc32 of the id written as text, modulo ``parts``; -1 for a null id."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % parts, F.lit(-1)).cast("int")


def text_key(text: str = "text") -> Column:
    """32 bits of the text: keeps rows that share an id but not the text apart."""
    return F.hash(F.col(text))


def slots(df: DataFrame, group: list[str], doc_id: str = "doc_id", digits: int = SPLIT_DIGITS) -> DataFrame:
    """``df`` with ``slot``, the rank from 0 of each row in its group, ordered by md5 of the id, then the id.

    A group is cut into 16 ** digits parts by the md5, counted with partial aggregation, and only
    rows of one part meet in a task; the counts of the parts before it give where it starts.
    ``group`` values must not be null. Rows with equal ids are ranked in any order among themselves.
    """
    digest = F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary"))
    split = df.withColumn("_digest", digest).withColumn("_part", F.substring("_digest", 1, digits))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = split.groupBy(*group, "_part").agg(F.count("*").alias("_n"))
    starts = sizes.select(*group, "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*group, "_part").orderBy("_digest", doc_id)
    ranked = split.withColumn("_rank", F.row_number().over(inside) - 1)
    return (
        ranked.join(starts, [*group, "_part"])
        .withColumn("slot", (F.col("_start") + F.col("_rank")).cast("long"))
        .drop("_digest", "_part", "_rank", "_start")
    )


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
