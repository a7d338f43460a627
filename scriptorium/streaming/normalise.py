"""The text rules on a stream: they are stateless projections and need no watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import CHAIN


def normalised(stream: DataFrame, text: str = "text") -> DataFrame:
    out = stream
    for _, rule in CHAIN:  # a projection for each rule keeps generated methods short
        out = out.withColumn(text, rule(F.col(text)))
    return out


def to_parquet(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """SNK9: each micro-batch is committed once; a restart goes on from the checkpoint."""
    return normalised(stream).writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
