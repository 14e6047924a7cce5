from pyspark.sql import functions as F

from quernstone.operators import merge
from quernstone.session import load
from quernstone.streaming import contracts


def test_replayed_batches_change_nothing(spark, tmp_path):
    table = contracts.VersionedTable(spark, str(tmp_path / "t"), "id int, state string")
    source = tmp_path / "in"
    spark.createDataFrame([(1, "read"), (2, "no_text"), (2, "no_text")], "id int, state string").write.json(str(source))
    stream = spark.readStream.schema("id int, state string").json(str(source))
    contracts.merged_stream(stream, table, ["id"], str(tmp_path / "c1"), state="state").awaitTermination()
    first = sorted(tuple(r) for r in table.read().collect())
    assert first == [(1, "read"), (2, "no_text")]
    apply = contracts.merging(table, ["id"], {}, "state")
    again = spark.createDataFrame([(1, "failed"), (2, "read")], "id int, state string")
    apply(again, 0)  # a batch number that is done
    assert sorted(tuple(r) for r in table.read().collect()) == first
    apply(again, 1)
    assert sorted(tuple(r) for r in table.read().collect()) == [(1, "read"), (2, "read")]


def test_windows_in_a_stream_equal_those_of_a_batch(spark, sf_dir, tmp_path):
    e = load(spark, sf_dir, "events")
    src = str(tmp_path / "e")
    e.write.parquet(src)
    stream = contracts.tumbling(spark.readStream.schema(e.schema).parquet(src))
    q = stream.writeStream.format("memory").queryName("tumbled").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    got, want = spark.table("tumbled"), contracts.tumbling(e)
    assert got.exceptAll(want).count() == 0 and want.count() == got.count()


def test_running_state(spark, sf_dir, tmp_path):
    e = load(spark, sf_dir, "events").select("user_id", "value")
    src = str(tmp_path / "e")
    e.repartition(3).write.parquet(src)
    stream = spark.readStream.option("maxFilesPerTrigger", 1).schema(e.schema).parquet(src)
    q = contracts.running_state(stream).writeStream.format("memory").queryName("running").outputMode("update").trigger(availableNow=True).start()
    q.awaitTermination()
    last = spark.table("running").groupBy("user_id").agg(F.max("n").alias("n"))
    assert last.exceptAll(e.groupBy("user_id").agg(F.count("*").alias("n"))).count() == 0


def test_pending_and_rate(spark):
    u = spark.createDataFrame([(k,) for k in range(4)], "doc int")
    ledger = spark.createDataFrame([(0, "m", "1", "read"), (1, "m", "1", "not_extracted"), (2, "m", "2", "read")], "doc int, model string, prompt_version string, read_state string")
    assert sorted(r.doc for r in contracts.pending(u, ledger, "doc", "m", "1").collect()) == [1, 2, 3]
    assert contracts.rate({"processedRowsPerSecond": 2.0}, 3600) == (7200.0, 0.5)
    assert merge.overwrite(1, 2) == 2


def test_bucketed_table_writes_what_it_touches(spark, tmp_path):
    table = contracts.BucketedTable(spark, str(tmp_path / "t"), "id long, v string, at int", ["id"], 8)
    merge = contracts.merging(table, ["id"], {}, newest="at")
    first = spark.range(40).selectExpr("id", "'a' AS v", "1 AS at")
    merge(first, 0)
    assert table.read().count() == 40 and len(table._newest()) == 8
    again = spark.createDataFrame([(3, "b", 1), (3, "c", 2), (3, "z", 1), (99, "n", 1)], "id long, v string, at int")
    merge(again, 1)
    merge(again.withColumn("v", F.lit("other")), 1)  # a replay
    got = {r.id: r.v for r in table.read().collect()}
    assert got[3] == "c" and got[99] == "n" and len(got) == 41 and sum(v == "a" for v in got.values()) == 39
    assert sorted(table._newest().values()).count(1) <= 2
    for number in (2, 3, 4):
        merge(first.withColumn("v", F.lit(str(number))), number)
    names = sorted(p.name for p in (tmp_path / "t").iterdir() if not p.name.startswith("."))
    assert [n for n in names if n.startswith("manifest")] == ["manifest-3.json", "manifest-4.json"] and "v2" not in names
    assert {r.v for r in table.read().where("id = 5").collect()} == {"4"}


def test_units_count_whole_or_not_at_all(spark, tmp_path):
    units = contracts.Units(spark, str(tmp_path / "u"), {"a": "x long", "b": "y long"})
    assert units.read("a").count() == 0
    one, two = spark.range(3).toDF("x"), spark.range(2).toDF("y")
    assert units.commit(7, {"a": one, "b": two}) and not units.commit(7, {"a": one, "b": two})
    one.write.parquet(str(tmp_path / "u" / "u8" / "a"))  # broken off
    assert (units.read("a").count(), units.read("b").count()) == (3, 2)
    assert units.commit(8, {"a": one})
    assert (units.read("a").count(), units.read("b").count()) == (6, 2)
