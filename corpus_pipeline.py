"""A training corpus from raw documents: five stages, each over all its predecessor kept.

A stage is a function of (spark, docs, sf_dir) that returns a DataFrame; what it returns is written as
Parquet and read again as the next one's docs. All but the last return the columns of documents.
Every stage also takes empty tables, null and repeated rows and further columns. What a stage decides
holds for a row, known by its id (or none) and text, not for all rows that share its id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assay.llm import decontaminate, near_dup, packing, suffix_dedup, toxicity
from assay.llm.common import bound_batches, keep, table, unused

# Shingle similarity, in percent, from which documents are near copies.
SIMILARITY = 80
# Bytes of a repeated passage (some 35 words) and children per node of its offset tree.
PASSAGE, FAN = 200, 5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of being toxic is below one half."""
    bound_batches(spark)
    return toxicity.clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def join_rows(docs: DataFrame, rows: DataFrame, how: str) -> DataFrame:
    """``docs`` joined with ``rows`` (id, hash) of the same id, or none, and the same xxhash64 of the text.

    ``how`` is left_semi or left_anti; the columns of ``docs`` may have any names.
    """
    i, t = unused(docs.columns, "_id", "_th")
    named = rows.toDF(i, t)
    return docs.join(named, F.col("doc_id").eqNullSafe(F.col(i)) & (F.xxhash64("text") == F.col(t)), how)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every group of near copies, the one with the smallest id (then hash of the text).

    Rows without an id are near copies of nothing; rows equal in id (or none) and text stay once.
    """
    bound_batches(spark)
    marked = near_dup.near_duplicate_rows(docs, SIMILARITY)
    key = [F.col("doc_id").alias("_id"), F.col("th").alias("_th")]
    left = join_rows(docs, marked.filter(~F.col("first")).select(*key).distinct(), "left_anti")
    repeated = marked.filter("first").groupBy(*key).agg(F.count("*").alias("n"))
    repeated = keep(repeated.filter("n > 1").select("_id", "_th"), "pipeline-repeated")
    if not repeated.isEmpty():
        (t,) = unused(docs.columns, "_th")
        once = join_rows(left, repeated, "left_semi").withColumn(t, F.xxhash64("text")).dropDuplicates(["doc_id", t])
        left = join_rows(left, repeated, "left_anti").unionByName(once.drop(t))
    return left.select(*docs.columns)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that an earlier row holds too; n_chars follows the text.

    Rows without an id come first, then rows by id; rows that share an id, or have none, by hash of the text.
    """
    bound_batches(spark)
    cut = suffix_dedup.cut(suffix_dedup.with_spans(docs, PASSAGE, FAN, first_stays=True))
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return cut.select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that share no run of ten words with a benchmark item."""
    bound_batches(spark)
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark")).filter("contaminated")
    found = keep(found.select(F.col("doc_id").alias("_id"), "_th").distinct(), "pipeline-hits")
    return join_rows(docs, found, "left_anti")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Length bucket and batch of every document left."""
    bound_batches(spark)
    return packing.pack(packing.word_lengths(docs))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_copies),
    ("suffix_dedup", cut_repeats),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

# Trained classifiers have no SQL form: tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
