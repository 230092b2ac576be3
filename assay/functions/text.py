"""Column expressions shared by standardisation, blocking and survivorship."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted shapes of update dates.
DATE_FORMATS = ("yyyy-MM-dd", "MM/dd/yyyy", "yyyyMMdd")
DATE_SHAPES = (r"^\d{4}-\d{2}-\d{2}$", r"^\d{2}/\d{2}/\d{4}$", r"^\d{8}$")


def clean(raw: Column, collapse_ws: bool = False) -> Column:
    """Raw value as trimmed text; optionally every whitespace run becomes one space."""
    text = raw.cast("string")
    if collapse_ws:
        text = F.regexp_replace(text, r"\s+", " ")
    return F.trim(text)


def email_domain(email: Column) -> Column:
    return F.regexp_extract(email, "@(.+)$", 1)


def parse_updated_at(text: Column) -> Column:
    """First configured format that fits, else null. The shape is tested first, so a
    lenient parser can never read one format as another."""
    return F.coalesce(
        *[
            F.when(text.rlike(shape), F.try_to_timestamp(text, F.lit(fmt)))
            for fmt, shape in zip(DATE_FORMATS, DATE_SHAPES)
        ],
        F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:"), F.try_to_timestamp(text)),
    )


def record_key(source: Column, raw_id: Column) -> Column:
    return F.concat(source, F.lit(":"), raw_id)


def last_word(name: Column) -> Column:
    return F.regexp_extract(name, r"(\S+)\s*$", 1)


# Blocking columns computed on demand from canonical ones.
DERIVED_BLOCK_COLUMNS = {
    "postal_code_prefix": lambda: F.substring(F.col("postal_code"), 1, 3),
    "email_domain": lambda: F.nullif(email_domain(F.col("email")), F.lit("")),
    "last_name_soundex": lambda: F.nullif(F.soundex(last_word(F.col("full_name"))), F.lit("")),
}


def block_column(name: str, existing: list[str]) -> Column:
    if name in DERIVED_BLOCK_COLUMNS and (name not in existing or name == "email_domain"):
        return DERIVED_BLOCK_COLUMNS[name]()
    return F.col(name).cast("string")
