"""Helpers the operators of this subpackage share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tollgate.session import durable_dir

#: The white space of the contracts, \x20 and \x09-\x0D. `bytes.split()` splits on the same set.
SPACE = " \t\n\x0b\f\r"
SLICE = 256  # rows turned into Python objects at a time


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder every executor reaches; Hadoop deletes it when the driver's JVM ends."""
    path = f"{durable_dir(spark, fallback=tempfile.gettempdir())}/{name}-{uuid.uuid4().hex}"
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jvm_path)
    return path


def drop(spark: SparkSession, path: str) -> None:
    """Deletes a scratch folder whose last reader is done."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)


def stored(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """The frame as a table in the shared folder: cuts the lineage and outlives executors. With a path, the caller drops it."""
    path = path or scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def map_rows(df: DataFrame, function: Callable[[Iterator[tuple]], Iterable[tuple]], ddl: str, limit: int = 1024) -> DataFrame:
    """Run a generator over each partition's rows; tuples in, tuples out, in small Arrow batches.

    A batch goes out after `limit` rows or about 8 MB of text, so memory stays bounded when texts are long.
    """
    schema = T.StructType.fromDDL(ddl)
    arrow = to_arrow_schema(schema)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                part = batch.slice(start, SLICE)
                yield from zip(*(column.to_pylist() for column in part.columns), strict=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        weight = 0
        for row in function(rows(batches)):
            held.append(row)
            weight += sum(len(v) for v in row if isinstance(v, (str, bytes)))
            if len(held) >= limit or weight >= 8_000_000:
                yield batch_of(held, arrow)
                held, weight = [], 0
        if held:
            yield batch_of(held, arrow)

    return df.mapInArrow(run, schema)


def batch_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def same(left: DataFrame, right: DataFrame, *names: str) -> Column:
    """Null-safe equality of the named columns."""
    condition = F.lit(True)
    for name in names:
        condition = condition & left[name].eqNullSafe(right[name])
    return condition


def keep_rows(df: DataFrame, text: str, make_test: Callable[[], Callable[[str], bool]]) -> DataFrame:
    """Rows whose text passes a test that each task makes once; null is tested as the empty text. All columns stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        test = make_test()
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                part = batch.slice(start, SLICE)
                texts = part.column(part.schema.get_field_index(text)).to_pylist()
                yield part.filter(pa.array([test(t or "") for t in texts], pa.bool_()))

    return df.mapInArrow(run, df.schema)
