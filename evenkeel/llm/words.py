"""Words of a text as native column expressions.

A word is a run of characters other than space and the control characters 0x09 to 0x0D.
A null text has no words. Whole texts are read, whatever their length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

GAP = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pieces(text: Column) -> Column:
    """The text cut at every gap; the first and last piece are empty where a gap stands at that end."""
    return F.split(F.coalesce(text, F.lit("")), GAP)


def word_count(text_pieces: Column) -> Column:
    n = F.size(text_pieces)
    leading = (F.element_at(text_pieces, 1) == "").cast("int")
    trailing = ((n > 1) & (F.element_at(text_pieces, -1) == "")).cast("int")
    return (n - leading - trailing).cast("long")


def word_list(text_pieces: Column) -> Column:
    start = F.when(F.element_at(text_pieces, 1) == "", 2).otherwise(1)
    return F.slice(text_pieces, start, word_count(text_pieces).cast("int"))


def unit_draw(*parts: Column) -> Column:
    """A uniform number in [0, 1) that depends on the parts alone: 52 bits of an MD5."""
    digest = F.md5(F.concat_ws("/", *[p.cast("string") for p in parts]).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long").cast("double") / F.lit(float(1 << 52))
