"""Sinks. Spark's commit protocol makes each write atomic; inputs are never overwritten."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def text(df: DataFrame, path: str, column: str = "text") -> None:
    """SNK1"""
    df.select(F.col(column).alias("value")).write.text(path)


def tsv(df: DataFrame, path: str, order: list, limit: int | None = 1000) -> DataFrame:
    """SNK2, SNK3: the first rows in that order; returns what was written."""
    out = df.orderBy(*order)
    out = out.limit(limit) if limit else out
    out.write.csv(path, sep="\t", header=True)
    return out


def judged_sample(df: DataFrame, n: int, word: str = "word", pos: str = "pos") -> DataFrame:
    """SNK3: shortest words first, with an empty column for the judgement."""
    return df.orderBy(F.length(word), pos, word).limit(n).withColumn("jugement", F.lit(""))


def model(df: DataFrame, path: str, version: int) -> str:
    """SNK4: each version has a folder of its own."""
    at = f"{path.rstrip('/')}/v{version:06d}"
    df.write.json(at)
    return at


def records(df: DataFrame, path: str) -> None:
    """SNK5, SNK8: JSON records, a line each, non-ASCII kept."""
    df.select(F.to_json(F.struct("*")).alias("value")).write.text(path)


def structure(pages: DataFrame, toc: DataFrame, sections: DataFrame, path: str, dry_run: bool = False) -> dict[str, DataFrame]:
    """SNK6, SNK7: the three tables of a volume; a dry run writes nothing and returns them."""
    out = {"pages": pages, "toc": toc, "sections": sections}
    if not dry_run:
        for name, df in out.items():
            df.write.parquet(f"{path.rstrip('/')}/{name}")
    return out
