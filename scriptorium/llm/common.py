"""What the training-data operators share: table access, words, joins on hot keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..tables import Scratch, map_rows, slices, to_batch

__all__ = ["BLANKS", "Scratch", "join_skewed", "map_rows", "slices", "table", "to_batch", "words"]

#: ASCII blanks that separate words: space, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = " \t\n\u000b\f\r"
WORD_GAP = "[\\x20\\x09-\\x0D]+"
#: Most keys that a join may broadcast as hot, and the rows that no key under is hot.
HOT_KEYS, HOT_ROWS = 10_000, 256


def table(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def join_skewed(left: DataFrame, right: DataFrame, on: list[str], rows: int) -> DataFrame:
    """Inner join of left with right, a table of distinct keys whose column c counts left's rows of the key.

    Keys of more than a HOT_KEYS-th of left's rows (`rows` at least) are HOT_KEYS at most whatever the
    size: they are broadcast, and their rows stay where they are. All other keys are shuffled.
    """
    least = max(HOT_ROWS, -(-rows // HOT_KEYS))
    hot = F.broadcast(right.filter(F.col("c") > least))
    rest = left.join(hot.select(*on), on, "left_anti").join(right.filter(F.col("c") <= least), on)
    return left.join(hot, on).unionByName(rest)


def words(text: Column) -> Column:
    """Words of a text, split at runs of ASCII blanks; null and blank texts have none."""
    bare = F.trim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(F.length(bare) == 0, F.array().cast("array<string>")).otherwise(F.split(bare, WORD_GAP))
