"""Curated files and stores: YAML lists as tables, and tables of a database by JDBC."""

from __future__ import annotations

import datetime as dt
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import ArrayType, DoubleType, LongType, MapType, StructType

#: Fixed value: how long a connection to a store may take, in seconds.
CONNECT_SECONDS = 10


def jdbc_table(
    spark: SparkSession, url: str, table: str, driver: str | None = None, partition: tuple[str, int, int, int] | None = None, fetch: int = 10_000, connect_seconds: int = CONNECT_SECONDS, **options: str
) -> DataFrame:
    """A table, or a query in brackets with a name, of a database.

    With `partition` (column, lowest, highest, number) it is read by so many connections at a
    time, each a range of the column; rows outside the bounds are in the outer ranges. Filters and
    columns go to the database.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).option("fetchsize", fetch)
    for key, value in (options | ({"driver": driver} if driver else {})).items():
        reader = reader.option(key, value)
    if url.startswith("jdbc:postgresql:"):
        reader = reader.option("connectTimeout", connect_seconds)
    if partition:
        column, lowest, highest, n = partition
        reader = reader.option("partitionColumn", column).option("lowerBound", lowest).option("upperBound", highest).option("numPartitions", n)
    return reader.load()


def _fitted(value: Any, kind) -> Any:
    """A value of a YAML file as the schema has it; what does not fit is an error, null what is missing."""
    if value is None:
        return None
    if isinstance(kind, StructType):
        return tuple(_fitted(value.get(f.name), f.dataType) for f in kind)
    if isinstance(kind, ArrayType):
        return [_fitted(v, kind.elementType) for v in value]
    if isinstance(kind, MapType):
        return {str(k): _fitted(v, kind.valueType) for k, v in value.items()}
    name = kind.simpleString()
    if name == "string":
        return value.isoformat() if isinstance(value, dt.date) else str(value).strip()
    if isinstance(kind, DoubleType):
        return float(value)
    if isinstance(kind, LongType) or name == "int":
        return int(value)
    return value


def yaml_rows(spark: SparkSession, path: str, section: str, schema: str) -> DataFrame:
    """The list `section` of a YAML file as a table, with its place in the list as `ord`; a missing file or section is an empty table.

    Files of this kind are written by hand, so they are read by the driver.
    """
    try:
        import yaml
    except ImportError as e:
        raise RuntimeError("reading YAML needs the yaml package") from e
    from pyarrow import fs

    kind = StructType.fromDDL(schema)
    system, name = fs.FileSystem.from_uri(path if ":" in path else f"file://{path}")
    found: list = []
    if system.get_file_info(name).is_file:
        with system.open_input_stream(name) as file:
            found = (yaml.safe_load(file.read()) or {}).get(section) or []
    rows = [(k, *_fitted(row, kind)) for k, row in enumerate(found)]
    return spark.createDataFrame(rows, StructType(StructType.fromDDL("ord long").fields + kind.fields))
