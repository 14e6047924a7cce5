"""Streams that keep the promises of a resumable reader: nothing twice, nothing lost, no state undone.

Each micro-batch merges into a keyed table that is written as a new version, of the whole or
of the buckets it touches, and then switched to, so a batch that is replayed after a
failure changes nothing.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quernstone.operators import merge


class Store:
    """Files under `path`, by whatever file system Spark can reach."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _at(self, name: str = ""):
        jpath = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)
        return jpath, jpath.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self) -> list[str]:
        jpath, fs = self._at()
        return [s.getPath().getName() for s in fs.listStatus(jpath)] if fs.exists(jpath) else []

    def _delete(self, name: str) -> None:
        jpath, fs = self._at(name)
        fs.delete(jpath, True)

    def _put(self, name: str, text: str) -> None:
        """A small file that is there whole or not at all."""
        draft, fs = self._at(f".{name}")
        out = fs.create(draft, True)
        out.write(bytearray(text.encode()))
        out.close()
        fs.rename(draft, self._at(name)[0])


class VersionedTable(Store):
    """A Parquet table under `path`: `v<batch>` folders, the newest complete one counts. A batch is written once: a number that is not above the newest is a replay.

    Every batch writes the whole table; `BucketedTable` writes only what it touches.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str):
        super().__init__(spark, path)
        self.schema = schema

    def _versions(self) -> list[int]:
        return sorted(int(n[1:]) for n in self._names() if n[:1] == "v" and n[1:].isdigit() and self._at(f"{n}/_SUCCESS")[1].exists(self._at(f"{n}/_SUCCESS")[0]))

    def read(self) -> DataFrame:
        v = self._versions()
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/v{v[-1]}") if v else self.spark.createDataFrame([], self.schema)

    def commit(self, batch: int, df: DataFrame) -> bool:
        done = self._versions()
        if done and batch <= done[-1]:
            return False
        df.write.mode("overwrite").parquet(f"{self.path}/v{batch}")
        for version in self._versions()[:-2]:  # readers of the one before the last are left in peace
            self._delete(f"v{version}")
        return True

    def merge(self, batch: int, rows: DataFrame, change: Callable[[DataFrame, DataFrame], DataFrame]) -> bool:
        """The table as `change` makes it of what is there and the rows."""
        return self.commit(batch, change(self.read(), rows))


class BucketedTable(Store):
    """A keyed Parquet table in buckets by the hash of its keys; a batch reads and writes only the buckets that its rows fall into.

    `manifest-<batch>.json` says in which version folder the newest files of each bucket are; it
    is the last thing that a batch writes, so a batch counts whole or not at all, and one whose
    number is not above the newest is a replay. Folders that the last two manifests do not name go.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: list[str], buckets: int = 64):
        super().__init__(spark, path)
        self.schema, self.keys, self.buckets = schema, keys, buckets

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _manifests(self) -> list[int]:
        return sorted(int(n[9:-5]) for n in self._names() if n.startswith("manifest-") and n.endswith(".json"))

    def _places(self, batch: int | None) -> dict[int, int]:
        if batch is None:
            return {}
        text = self.spark.read.text(f"{self.path}/manifest-{batch}.json", wholetext=True).first()[0]
        return {int(b): v for b, v in json.loads(text).items()}

    def _newest(self) -> dict[int, int]:
        return self._places(max(self._manifests(), default=None))

    def read(self, buckets: list[int] | None = None) -> DataFrame:
        places = self._newest()
        paths = [f"{self.path}/v{v}/_b={b}" for b, v in sorted(places.items()) if buckets is None or b in buckets]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def merge(self, batch: int, rows: DataFrame, change: Callable[[DataFrame, DataFrame], DataFrame]) -> bool:
        """The touched buckets as `change` makes them of what is there and the rows; no key may leave its bucket."""
        done = self._manifests()
        if done and batch <= done[-1]:
            return False
        touched = [r[0] for r in rows.select(self._bucket()).distinct().collect()]
        out = change(self.read(touched), rows).withColumn("_b", self._bucket())
        out.repartition(max(1, len(touched)), "_b").write.mode("overwrite").partitionBy("_b").parquet(f"{self.path}/v{batch}")
        self._put(f"manifest-{batch}.json", json.dumps(self._newest() | dict.fromkeys(touched, batch)))
        done.append(batch)
        for old in done[:-2]:
            self._delete(f"manifest-{old}.json")
        live = {f"v{v}" for m in done[-2:] for v in self._places(m).values()}
        for name in [n for n in self._names() if n[:1] == "v" and n[1:].isdigit() and n not in live]:
            self._delete(name)
        return True


class Units(Store):
    """Tables that are told together: a unit adds rows to several, and counts in all of them or in none.

    A unit's rows are in `u<number>/<table>`; `u<number>.done`, written last, makes it count. What a
    lost writer has left without it is written anew under the same number.
    """

    def __init__(self, spark: SparkSession, path: str, schemas: dict[str, str]):
        super().__init__(spark, path)
        self.schemas = schemas

    def _done(self) -> list[int]:
        return sorted(int(n[1:-5]) for n in self._names() if n[:1] == "u" and n.endswith(".done"))

    def commit(self, number: int, tables: dict[str, DataFrame]) -> bool:
        if number in self._done():
            return False
        for name, df in tables.items():
            df.write.mode("overwrite").parquet(f"{self.path}/u{number}/{name}")
        self._put(f"u{number}.done", json.dumps(sorted(tables)))
        return True

    def read(self, name: str) -> DataFrame:
        paths = [f"{self.path}/u{n}/{name}" for n in self._done() if self._at(f"u{n}/{name}")[1].exists(self._at(f"u{n}/{name}")[0])]
        return self.spark.read.schema(self.schemas[name]).parquet(*paths) if paths else self.spark.createDataFrame([], self.schemas[name])


def one_a_key(batch: DataFrame, keys: list[str], newest: str | None = None) -> DataFrame:
    """Of a batch's rows with one key the newest, of equals the one with the greatest other columns: the same row on every replay."""
    others = [c for c in batch.columns if c not in keys]
    if not others:
        return batch.distinct()
    first = [newest, *[c for c in others if c != newest]] if newest else others
    return batch.groupBy(*keys).agg(F.max(F.struct(*first)).alias("_row")).select(*keys, *[F.col(f"_row.{c}").alias(c) for c in others]).select(*batch.columns)


def merging(table: VersionedTable | BucketedTable, keys: list[str], policies: dict, state: str | None = None, final: str = "read", newest: str | None = None):
    """A foreachBatch function: upserts each batch, or with `state` never changes rows whose state is final."""

    def apply(batch: DataFrame, number: int) -> None:
        change = (lambda base, rows: merge.state_guarded(base, rows, keys, state, final)) if state else (lambda base, rows: merge.upsert(base, rows, keys, policies))
        table.merge(number, one_a_key(batch, keys, newest), change)

    return apply


def merged_stream(stream: DataFrame, table: VersionedTable | BucketedTable, keys: list[str], checkpoint: str, policies: dict | None = None, state: str | None = None) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(merging(table, keys, policies or {}, state)).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def pending(universe: DataFrame, ledger: DataFrame, key: str, model: str, version: str, again: tuple[str, ...] = ("not_extracted",)) -> DataFrame:
    """What this model and version has not read yet; states in `again` come back."""
    done = ledger.where((F.col("model") == model) & (F.col("prompt_version") == version) & ~F.col("read_state").isin(*again))
    return universe.join(done.select(key).distinct(), key, "left_anti")


def shard(df: DataFrame, key: str, n: int, k: int) -> DataFrame:
    """The k-th of n disjoint shares, by key."""
    return df.where(F.pmod(F.col(key), F.lit(n)) == k)


def _timed(events: DataFrame, late: str) -> DataFrame:
    """Events with a watermark, which needs instants rather than wall-clock times."""
    return events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)


def tumbling(events: DataFrame, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Counts and sums by window and type; rows later than `late` behind the newest are dropped in a stream."""
    w = _timed(events, late).groupBy(F.window("ts", width), "event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return w.select(F.col("window.start").alias("start"), "event_type", "n", "total")


def sliding(events: DataFrame, width: str = "2 hours", step: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    w = _timed(events, late).groupBy(F.window("ts", width, step)).agg(F.count(F.lit(1)).alias("n"))
    return w.select(F.col("window.start").alias("start"), "n")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    w = _timed(events, late).groupBy(F.session_window("ts", gap), "user_id").agg(F.count(F.lit(1)).alias("n"))
    return w.select(F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "user_id", "n")


def deduplicated(events: DataFrame, keys: list[str], late: str = "10 minutes") -> DataFrame:
    return _timed(events, late).dropDuplicatesWithinWatermark(keys)


def running_state(events: DataFrame) -> DataFrame:
    """user_id, n, total after each batch, by a custom state that outlives batches."""

    def update(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        n, total = state.get if state.exists else (0, 0.0)
        for pdf in frames:
            n, total = n + len(pdf), total + float(pdf["value"].sum())
        state.update((n, total))
        yield pd.DataFrame({"user_id": [key[0]], "n": [n], "total": [round(total, 4)]})

    return events.groupBy("user_id").applyInPandasWithState(update, "user_id long, n long, total double", "n long, total double", "update", "NoTimeout")


def rate(progress: dict, left: int) -> tuple[float, float | None]:
    """Rows an hour of a stream's progress, and hours until `left` rows are done."""
    per_hour = float(progress.get("processedRowsPerSecond") or 0) * 3600
    return per_hour, left / per_hour if per_hour else None
