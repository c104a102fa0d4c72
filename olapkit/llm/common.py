"""What several operators of this folder share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: The white space that separates words: space and the controls from tab to carriage return.
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_CLASS = r"[^\x20\x09-\x0D]+"
#: The bytes of that white space.
SPACE_BYTES = bytes([0x20, *range(0x09, 0x0E)])


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column), F.lit(""))


def words_of(text: Column) -> Column:
    """The words of a text as an array, empty for a text without words."""
    return F.filter(F.split(text, SPACE_CLASS + "+"), lambda w: w != "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often and wherever ``body`` uses it.

    Inside the function of a transform or an aggregate, a plain column would be computed
    anew for every element.
    """
    return F.element_at(F.transform(F.array(value), body), 1)
