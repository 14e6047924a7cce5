"""Components of linked records, their stable keys and what joined them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernstone.session import shared_folder


def checkpointed(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in the folder of spark.checkpoint.dir, which only local sessions may leave unset.

    A checkpoint carries the size that was estimated for its plan, for joins the product of their
    sides'. Over the rounds of a loop its digits double until planning takes longer than the
    work, so the result is taken anew from the rows, without an estimate.
    """
    spark = df.sparkSession
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    held = df.checkpoint()._jdf.toDF()
    return DataFrame(spark._jsparkSession.createDataFrame(held.javaRDD(), held.schema()), spark)


#: A key that more than one in HEAVY rows share is heavy, so that there are HEAVY heavy keys at most; below LEAST_HEAVY rows none is.
HEAVY, LEAST_HEAVY, SPREAD = 20_000, 100, 1024


def heavy_keys(rows: DataFrame, key: str, total: int) -> DataFrame:
    """The keys that many rows share: at most HEAVY rows, whatever the size of `rows`."""
    return rows.groupBy(F.col(key).alias("heavy")).count().where(F.col("count") > max(LEAST_HEAVY, total // HEAVY)).select("heavy")


def looked_up(rows: DataFrame, key: str, table: DataFrame, heavy: DataFrame) -> DataFrame:
    """`rows` with `value` from `table` (node, value; one row a node), null where it has none.

    Rows of heavy keys hear it by a broadcast of these keys' values, of bounded size, and are
    spread in the join that serves all others; so no task gets all rows of one key.
    """
    told = table.join(F.broadcast(heavy), table.node == F.col("heavy"), "left_semi").select(F.col("node").alias("_node"), F.col("value").alias("_told"))
    spread = F.when(F.col("_node").isNotNull(), 1 + F.pmod(F.xxhash64(*[F.col(c) for c in rows.columns]), F.lit(SPREAD))).otherwise(F.lit(0).cast("long"))
    marked = rows.join(F.broadcast(told), F.col(key) == F.col("_node"), "left").withColumn("_spread", spread)
    rest = table.select(F.col("node").alias("_at"), F.col("value").alias("_found"), F.lit(0).cast("long").alias("_zero"))
    joined = marked.join(rest, (F.col(key) == F.col("_at")) & (F.col("_spread") == F.col("_zero")), "left")
    return joined.select(*rows.columns, F.coalesce("_told", "_found").alias("value"))


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """node, root (the least node reachable) for `nodes` (node) and `edges` (src, dst).

    Least labels spread to neighbours and jump over their own label, so a chain of n nodes
    takes about log n rounds, each a reliable checkpoint; labels only fall, and a round
    without a change is the last. A node with many neighbours and a label that many nodes
    have are heavy keys, told by broadcast.
    """
    both = edges.select("src", "dst").union(edges.select("dst", "src")).where("src <> dst").distinct()
    both = checkpointed(both)
    centres = checkpointed(heavy_keys(both, "dst", both.count()))
    every = nodes.select("node").union(both.select(F.col("src").alias("node"))).distinct()
    label = checkpointed(every.withColumn("root", F.col("node")))
    total = label.count()
    while True:
        near = looked_up(both, "dst", label.select("node", F.col("root").alias("value")), centres).groupBy("src").agg(F.min("value").alias("least"))
        fresh = label.join(near, label.node == near.src, "left").select("node", F.col("root").alias("old"), F.least("root", F.coalesce("least", "root")).alias("root"))
        fresh = checkpointed(fresh)
        jumped = looked_up(fresh, "root", fresh.select("node", F.col("root").alias("value")), heavy_keys(fresh, "root", total))
        jumped = checkpointed(jumped.select("node", "old", F.coalesce("value", "root").alias("root")))
        changed = jumped.where("old <> root").limit(1).count()
        label = jumped.select("node", "root")
        if not changed:
            return label


#: How strong each kind of join is.
STRENGTH = {"project_link": 4, "family": 3, "family_description": 2, "spatial": 1}


def joined_via(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """node, via: the strongest kind (column `via` of edges) that joins it, or singleton."""
    strength = F.create_map(*[F.lit(x) for kv in STRENGTH.items() for x in kv])
    ends = edges.select(F.col("src").alias("node"), "via").union(edges.select("dst", "via"))
    best = ends.groupBy("node").agg(F.max_by("via", F.coalesce(strength[F.col("via")], F.lit(0))).alias("via"))
    return nodes.select("node").join(best, "node", "left").select("node", F.coalesce("via", F.lit("singleton")).alias("via"))


def partition_conflicts(labelled: DataFrame) -> DataFrame:
    """Roots whose members (root, node, partition) belong to more than one partition."""
    return labelled.where("partition is not null").groupBy("root").agg(F.countDistinct("partition").alias("partitions"), F.array_sort(F.collect_set("partition")).alias("names")).where("partitions > 1")


def closed_partitions(labelled: DataFrame) -> DataFrame:
    """root, node, partition: members without one inherit that of their component."""
    own = labelled.where("partition is not null").groupBy("root").agg(F.min("partition").alias("_p"))
    return labelled.join(own, "root", "left").select("root", "node", F.coalesce("partition", "_p").alias("partition"))


def one_hop(seeds: DataFrame, edges: DataFrame) -> DataFrame:
    """Seeds and their neighbours: a closure of one pass, by design."""
    out = edges.join(seeds.select(F.col("node").alias("src")), "src", "left_semi").select(F.col("dst").alias("node"))
    back = edges.join(seeds.select(F.col("node").alias("dst")), "dst", "left_semi").select(F.col("src").alias("node"))
    return seeds.select("node").union(out).union(back).distinct()


def stable_keys(members: DataFrame) -> DataFrame:
    """root, site_key, display of members (root, kind, key, title): the least project number as text, else the least reference."""
    project = F.col("kind") == "project"
    least = F.min_by(F.struct("key", "title"), F.struct((~project).alias("later"), F.col("key"))).alias("lead")
    out = members.groupBy("root").agg(least, F.bool_or(project).alias("has_project"))
    return out.select("root", F.concat(F.when(F.col("has_project"), "PTNO-").otherwise("SITE-"), F.col("lead.key")).alias("site_key"), F.coalesce("lead.title", "lead.key").alias("display_name"))


def classification(members: DataFrame) -> DataFrame:
    """root, classification of members (root, kind, in_universe, lat): which of the two sources knows the site."""
    project, app = F.col("kind") == "project", F.col("kind") == "application"
    flags = members.groupBy("root").agg(F.bool_or(app & F.col("in_universe")).alias("ours"), F.bool_or(project).alias("theirs"), F.bool_or(app).alias("any_app"), F.bool_or(app & F.col("lat").isNotNull()).alias("located"))
    name = F.when(F.col("ours") & F.col("theirs"), "both").when(F.col("ours") & ~F.col("located"), "unlocatable").when(F.col("ours"), "ours_only").when(F.col("theirs") & F.col("any_app"), "barbour_covered").when(F.col("theirs"), "barbour_only").otherwise("dropped")
    return flags.select("root", name.alias("classification"))
