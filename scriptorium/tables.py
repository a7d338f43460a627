"""Written scratch tables and Arrow row mappers that the operators share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; on a local master (tests) one of our own where that is unset."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("scriptorium.scratch", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = f"file://{tempfile.mkdtemp(prefix='scriptorium-')}"
        spark.conf.set("scriptorium.scratch", found)
    return found.rstrip("/")


class Scratch:
    """Written tables that cut the lineage and outlive executors; `drop` removes those no longer read."""

    def __init__(self, spark: SparkSession, tag: str) -> None:
        self.spark, self.base, self.paths = spark, f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}", {}

    def save(self, df: DataFrame) -> DataFrame:
        path = f"{self.base}/{len(self.paths)}-{uuid.uuid4().hex[:6]}"
        df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = (path, out)
        return out

    def drop(self, df: DataFrame) -> None:
        path, _ = self.paths.pop(id(df))
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)


def slices(column: pa.Array, step: int = 512) -> Iterator:
    """Python values of an Arrow column, converted a slice at a time."""
    for at in range(0, len(column), step):
        yield from column.slice(at, step).to_pylist()


def map_column(df: DataFrame, column: str, each: Callable, *more: str) -> DataFrame:
    """df with the values of a string column replaced by each(value, *values of more), a slice of rows at a time, so that a worker holds
    the Arrow batch and the Python values of SLICE_BYTES of it (of one row, if that is larger)."""
    names = (column, *more)

    def run(batches):
        for batch in batches:
            for part in parts(batch, column):
                values = [each(*row) for row in zip(*(part.column(c).to_pylist() for c in names), strict=True)]
                at = part.schema.get_field_index(column)
                yield part.set_column(at, part.schema.field(at), pa.array(values, part.schema.field(at).type))

    return df.mapInArrow(run, df.schema)


#: Bytes of a text column whose Python values a worker holds at a time.
SLICE_BYTES = 4_000_000


def parts(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about SLICE_BYTES of a string column each."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start = held = 0
    for k, n in enumerate(lengths):
        if k > start and held + n > SLICE_BYTES:
            yield batch.slice(start, k - start)
            start, held = k, 0
        held += n
    if start < len(lengths):
        yield batch.slice(start)


def map_rows(df: DataFrame, columns: list[str], schema: pa.Schema, ddl: str, make: Callable[[], Callable]) -> DataFrame:
    """Maps rows through make()(value, ...) -> iterable of tuples, in Arrow batches of bounded size.

    `make` runs once in each task, so that automata, tables and models are built there.
    """

    def run(batches):
        each = make()
        for batch in batches:
            rows = []
            for values in zip(*(slices(batch.column(c)) for c in columns), strict=True):
                rows.extend(each(*values))
                if len(rows) >= 4096:
                    yield to_batch(rows, schema)
                    rows = []
            if rows:
                yield to_batch(rows, schema)

    return df.select(*columns).mapInArrow(run, ddl)


def to_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), schema, strict=True)], schema=schema)
