"""Sources: texts, lexicons, validation tables, nested JSON, configuration."""

from __future__ import annotations

import os
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import normalize_unicode

BLOCK = "id STRING, vpos INT, hpos INT, width INT, height INT, word_offset INT, word_count INT, font_size INT, text STRING"
PRESS = f"processes ARRAY<STRING>, documents ARRAY<STRUCT<id:STRING, publication_date:STRING, publication_title:STRING, pages:ARRAY<STRUCT<id:STRING, width:INT, height:INT, blocks:ARRAY<STRUCT<{BLOCK.replace(' ', ':').replace(',:', ', ')}>>>>>>"


def texts(spark: SparkSession, path: str, utf8_only: bool = False) -> DataFrame:
    """SRC1: (path, text); bytes that aren't UTF-8 are read as Latin-1 unless utf8_only. A file without any byte gives no row."""
    raw = spark.read.format("binaryFile").load(path).select("path", "content")
    good = F.expr("is_valid_utf8(CAST(content AS STRING))")
    other = F.lit(None).cast("string") if utf8_only else F.decode("content", "ISO-8859-1")
    return raw.select("path", F.when(good, F.col("content").cast("string")).otherwise(other).alias("text"))


def lexicon(spark: SparkSession, path: str) -> DataFrame:
    """SRC2: (form), trimmed, in normal form NFC, without blanks and repeats."""
    return spark.read.text(path).select(normalize_unicode(F.trim("value")).alias("form")).filter("form <> ''").distinct()


def abbreviation_list(spark: SparkSession, path: str) -> DataFrame:
    """SRC3: one abbreviation a line; what follows a # is a comment."""
    return spark.read.text(path).select(F.trim(F.split_part("value", F.lit("#"), F.lit(1))).alias("abbreviation")).filter("abbreviation <> ''")


def tsv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """SRC4: header row, all strings unless a schema says otherwise; a byte-order mark is taken off the first name."""
    df = spark.read.csv(path, sep="\t", header=True, schema=schema)
    return df.toDF(*(c.lstrip("﻿") for c in df.columns))


def csv(spark: SparkSession, path: str, sep: str = ",", schema: str | None = None) -> DataFrame:
    """SRC5"""
    return spark.read.csv(path, sep=sep, header=True, schema=schema, inferSchema=schema is None)


def excel(spark: SparkSession, path: str, sheet: int | str = 0) -> DataFrame:
    """SRC6: needs openpyxl on the driver; workbooks are small by nature."""
    import pandas as pd

    return spark.createDataFrame(pd.read_excel(path, sheet_name=sheet))


def json(spark: SparkSession, path: str, schema: str | None = None, recursive: bool = False) -> DataFrame:
    """SRC7, SRC8: one JSON value a file; recursive takes every .json below the folder."""
    reader = spark.read.option("multiLine", True)
    if recursive:
        reader = reader.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json")
    return (reader.schema(schema) if schema else reader).json(path)


def press_blocks(df: DataFrame, containing: str | None = None) -> DataFrame:
    """NST1: documents -> pages -> blocks; rows with a missing list vanish. `containing` filters without regard to case (PRJ10)."""
    d = df.select(F.explode("documents").alias("d")).select("d.publication_date", "d.publication_title", F.explode("d.pages").alias("p"))
    out = d.select("publication_date", "publication_title", F.col("p.id").alias("page_id"), F.explode("p.blocks").alias("b")).select("publication_date", "publication_title", "page_id", F.col("b.text").alias("texte"))
    return out if containing is None else out.filter(F.lower("texte").contains(containing.lower()))


def geojson(spark: SparkSession, path: str) -> DataFrame:
    """SRC10: properties as columns, the geometry as GeoJSON text."""
    f = spark.read.option("multiLine", True).json(path).select(F.explode("features").alias("f"))
    return f.select("f.properties.*", F.to_json("f.geometry").alias("geometry"))


def earlier_output(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """SRC11: an earlier run's rows; none if there is no such path or a line doesn't parse."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


@dataclass(frozen=True)
class Options:
    """SRC12: settings from the environment (SCRIPTORIUM_<NAME>), with defaults."""

    min_score: float = 85.0
    max_auto_distance: int = 1
    batch_size: int = 40
    export_limit: int = 1000

    @classmethod
    def from_environment(cls) -> Options:
        found = {f.name: os.environ.get(f"SCRIPTORIUM_{f.name.upper()}") for f in fields(cls)}
        return cls(**{k: type(getattr(cls, k))(v) for k, v in found.items() if v is not None})
