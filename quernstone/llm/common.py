"""What the operators share: Arrow buffers, shared storage, partition counts."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quernstone.session import shared_folder


_MADE: list[str] = []


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, deleted when the driver ends, or with `drop` before."""
    path = f"{shared_folder(spark)}/quernstone-{name}-{uuid.uuid4().hex}"
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hpath)
    _MADE.append(path)
    return path


def drop(spark: SparkSession, path: str) -> None:
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hpath, True)
    if path in _MADE:
        _MADE.remove(path)


class Chain:
    """Tables of a chain of stages, each of which needs only what the one before has written."""

    def __init__(self, spark: SparkSession):
        self.spark, self.before, self.path = spark, set(_MADE), None

    def written(self, df: DataFrame, name: str) -> DataFrame:
        """`df` as a table; what the stages so far have left in the shared folder goes, the table that `df` came from as well."""
        out = written(df, name)
        self.path = _MADE[-1]
        for path in [p for p in _MADE if p not in self.before and p != self.path]:
            drop(self.spark, path)
        return out

    def close(self) -> None:
        """The last table goes, once its successor no longer reads it."""
        if self.path:
            drop(self.spark, self.path)


def fresh_name(df: DataFrame, name: str) -> str:
    """`name`, with as many underscores before it as tell it from all columns of `df`."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """`df` as a table in the shared folder: lineage ends there and a lost executor loses nothing."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def quoted(name: str) -> Column:
    """The column of that name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def buffers(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (int64) and bytes of a string or binary array without nulls."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    large = pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)
    kind = np.dtype(np.int64 if large else np.int32)
    _, offsets, data = arr.buffers()
    if offsets is None or not len(arr):
        return np.zeros(len(arr) + 1, np.int64), np.zeros(0, np.uint8)
    off = np.frombuffer(offsets, kind, len(arr) + 1, arr.offset * kind.itemsize).astype(np.int64)
    return off, np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)


def row_bytes(arr: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of every value of a string array without nulls."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    large = pa.types.is_large_string(arr.type)
    return arr.cast(pa.large_binary() if large else pa.binary()).to_pylist()


def spans(lengths: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges whose lengths sum to at most `limit`, single longer rows alone."""
    start, total = 0, 0
    for i, n in enumerate(lengths.tolist()):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(lengths):
        yield start, len(lengths)


def batches(rows: Iterable[tuple], schema: pa.Schema, size: int = 4096, limit: int = 8 << 20, weight: int | None = None) -> Iterator[pa.RecordBatch]:
    """Tuples as record batches of bounded rows and, by the column `weight`, bounded bytes."""
    held: list[tuple] = []
    total = 0
    for row in rows:
        held.append(row)
        if weight is not None and row[weight] is not None:
            total += len(row[weight])
        if len(held) >= size or total > limit:
            yield as_batch(held, schema)
            held, total = [], 0
    if held:
        yield as_batch(held, schema)


def as_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def parts_for(total: float, each: float, least: int = 1) -> int:
    """Partitions so that each holds about `each` of `total`."""
    return max(least, int(-(-total // each)))
