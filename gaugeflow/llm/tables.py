"""Small DataFrame helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Blank, tab, line feed, vertical tab, form feed and carriage return separate words.
BLANKS = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def whole_text(text: str = "text") -> Column:
    """The text with null as empty."""
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def crc_part(doc_id: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; null ids count as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(parts))


def hash_share(*columns: str, seed: int) -> Column:
    """A number in [0, 1) that depends on the seed and the given columns only."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 11) / float(1 << 53)


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    """UTF-8 bytes of all texts, one pass over one column."""
    return docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
