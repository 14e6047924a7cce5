"""Versioned rows: latest per key, best per group, survivors of duplicates, samples.

Every order ends in a unique key, so that results do not depend on how rows arrive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quernstone.operators.graph import checkpointed


def _cols(keys: list[str | Column]) -> list[Column]:
    return [F.col(k) if isinstance(k, str) else k for k in keys]


def top_n(df: DataFrame, keys: list[str | Column], order: list[Column], n: int = 1, rank: str | None = None) -> DataFrame:
    """The first n rows of each key; Spark filters by rank before the shuffle as well (WindowGroupLimit)."""
    out = df.withColumn(rank or "_rn", F.row_number().over(Window.partitionBy(*_cols(keys)).orderBy(*order))).where(F.col(rank or "_rn") <= n)
    return out if rank else out.drop("_rn")


def latest(df: DataFrame, keys: list[str | Column], at: str, tie: str) -> DataFrame:
    """The newest row of each key: by time, then by the unique column `tie`.

    An aggregate of one struct a key instead of a window: partial results before the
    shuffle, no sort, and no trouble with a key that has a large share of all rows.
    """
    row = F.max_by(F.struct(*[F.col(c) for c in df.columns]), F.struct(F.col(at).isNotNull().alias("known"), F.col(at).alias("at"), F.col(tie).alias("tie")))
    return df.groupBy(*[k.alias(f"_k{i}") for i, k in enumerate(_cols(keys))]).agg(row.alias("_row")).select("_row.*")


def latest_per_variant(df: DataFrame, keys: list[str], variant: Column, at: str, tie: str, default: str = "v1") -> DataFrame:
    """The newest row of each key and variant, a missing variant being the default one."""
    return latest(df, [*keys, F.coalesce(variant, F.lit(default))], at, tie)


def preferred(df: DataFrame, keys: list[str], undecided: Column, at: str, tie: str) -> DataFrame:
    """Per key a decided row rather than an undecided one, then the newest."""
    return top_n(df, keys, [undecided.asc(), F.col(at).desc_nulls_last(), F.col(tie).desc()])


def argmax(df: DataFrame, keys: list[str], value: str, tie: str) -> DataFrame:
    """The row that holds each key's largest value, the smaller `tie` of equals."""
    return top_n(df, keys, [F.col(value).desc_nulls_last(), F.col(tie).asc()])


def with_survivor(df: DataFrame, content: list[str | Column], key: str, survivor: str = "survivor") -> DataFrame:
    """Each row with the smallest key among rows of equal content; nulls are equal."""
    return df.withColumn(survivor, F.min(key).over(Window.partitionBy(*_cols(content))))


def duplicates(df: DataFrame, content: list[str | Column], key: str) -> DataFrame:
    """The rows beyond the first of each content, by key, with their place."""
    return df.withColumn("copy", F.row_number().over(Window.partitionBy(*_cols(content)).orderBy(key))).where("copy > 1")


def every_nth(df: DataFrame, keys: list[str], order: list[Column], n: int = 5) -> DataFrame:
    """A systematic sample within each key. Sample the whole universe, then filter; not the other way round."""
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1
    return df.withColumn("_no", number).where(F.col("_no") % n == 0).drop("_no")


def with_neighbours(df: DataFrame, keys: list[str], order: list[Column], hit: Column, context: int = 1, name: str = "selected") -> DataFrame:
    """Whether a row or one of its neighbours in order is a hit."""
    frame = Window.partitionBy(*keys).orderBy(*order).rowsBetween(-context, context)
    return df.withColumn(name, F.max(hit).over(frame))


def placed(df: DataFrame, order: list[Column], name: str = "place") -> DataFrame:
    """Every row with its place in `order`, from 1.

    Rows are sorted by ranges and kept in a reliable checkpoint; the ranges' row counts, one
    a task, are broadcast, so that no window has all rows in one task.
    """
    at = checkpointed(df.orderBy(*order)).withColumn("_at", F.monotonically_increasing_id())
    task = F.shiftright("_at", 33)
    begin, total = [], 0
    for of_task, n in at.groupBy(task.alias("task")).count().orderBy("task").collect():
        begin.append((of_task, total))
        total += n
    starts = df.sparkSession.createDataFrame(begin, "_task long, _begin long")
    place = F.col("_begin") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return at.withColumn("_task", task).join(F.broadcast(starts), "_task").withColumn(name, place).drop("_task", "_begin", "_at")


def first_home(df: DataFrame, item: str, home: str, order: str, ties: list[str] | None = None) -> DataFrame:
    """Each item with the first home, by order, that lists it; equals by `ties`, the least home without them.

    Rows without a home or an order list nothing; an item with no others has a null home.
    """
    place = F.struct(F.col(order), *[F.col(c) for c in ties or [home]])
    return df.groupBy(item).agg(F.min_by(F.col(home), F.when(F.col(home).isNotNull() & F.col(order).isNotNull(), place)).alias(home))


def numbered_names(df: DataFrame, keys: list[str], order: list[Column], kind: str, ext: str, name: str = "file_name") -> DataFrame:
    """`001 - kind.ext` within each key; names that differ in case alone get a suffix from their content's hash."""
    number = F.lpad(F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("string"), 3, "0")
    plain = F.concat(number, F.lit(" - "), F.col(kind), F.lit("."), F.col(ext))
    clash = F.count(F.lit(1)).over(Window.partitionBy(*keys, F.lower(plain))) > 1
    return df.withColumn(name, F.when(clash, F.concat(number, F.lit(" - "), F.col(kind), F.lit("-"), F.substring(F.md5(F.col(kind)), 1, 6), F.lit("."), F.col(ext))).otherwise(plain))
