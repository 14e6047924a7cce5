"""Sites: applications and projects that links, references and places join.

Nodes are applications of the universe, linked ones, those one family step away, and all
projects. What the record itself says (links, references) is joined first, and spreads
named partitions over its components; places join only inside a partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quernstone.operators import graph
from quernstone.operators.linkage import radius_pairs

APPLICATION, PROJECT = "A:", "P:"
#: Fixed value: the verdict that family references do not pass.
OUTSIDE = "not_dc"


def _node(kind: str, key: str | Column) -> Column:
    return F.concat(F.lit(kind), (F.col(key) if isinstance(key, str) else key).cast("string"))


def universe_nodes(apps: DataFrame, links: DataFrame, family: DataFrame) -> DataFrame:
    """node of the applications that count: those in the universe or linked, and those one family reference away."""
    own = apps.where("in_universe").select(_node(APPLICATION, "id").alias("node")).union(links.select(_node(APPLICATION, "application_id"))).distinct()
    known = apps.select(_node(APPLICATION, "id").alias("node"))
    own = own.join(known, "node", "left_semi")
    return graph.one_hop(own, family.select(_node(APPLICATION, "src").alias("src"), _node(APPLICATION, "dst").alias("dst"))).join(known, "node", "left_semi")


def record_edges(nodes: DataFrame, apps: DataFrame, links: DataFrame, family: DataFrame, skip_outside: bool = True) -> DataFrame:
    """src, dst, via: links of projects, and family references between nodes that are not outside."""
    passed = apps.where(~F.coalesce(F.col("verdict") == OUTSIDE, F.lit(False)) | F.lit(not skip_outside)).select(_node(APPLICATION, "id").alias("node"))
    inner = passed.join(nodes, "node", "left_semi")
    via = F.when(F.col("source") == "associated_id", "family").otherwise("family_description")
    relatives = family.where("src <> dst").select(_node(APPLICATION, "src").alias("src"), _node(APPLICATION, "dst").alias("dst"), via.alias("via"))
    for end in ("src", "dst"):
        relatives = relatives.join(inner.select(F.col("node").alias(end)), end, "left_semi")
    linked = links.select(_node(PROJECT, "project_id").alias("src"), _node(APPLICATION, "application_id").alias("dst"), F.lit("project_link").alias("via"))
    linked = linked.join(nodes.select(F.col("node").alias("dst")), "dst", "left_semi")
    return linked.select("src", "dst", "via").union(relatives.select("src", "dst", "via")).distinct()


def place_edges(located: DataFrame, km: float) -> DataFrame:
    """src, dst, via of located nodes (node, lat, lon, partition) within `km` in one partition.

    Nodes at one place are joined to the least of them, and only that one is held against other places.
    """
    place = located.groupBy("lat", "lon", "partition").agg(F.min("node").alias("id"))
    same = located.alias("l").join(place.alias("p"), (F.col("l.lat") == F.col("p.lat")) & (F.col("l.lon") == F.col("p.lon")) & F.col("l.partition").eqNullSafe(F.col("p.partition")) & (F.col("l.node") != F.col("p.id")))
    near = radius_pairs(place, place, km).where("left_id < right_id")
    named = place.select("id", "partition")
    a, b = named.select(F.col("id").alias("left_id"), F.col("partition").alias("_a")), named.select(F.col("id").alias("right_id"), F.col("partition").alias("_b"))
    near = near.join(a, "left_id").join(b, "right_id").where(F.col("_a").eqNullSafe(F.col("_b")))
    return same.select(F.col("l.node").alias("src"), F.col("p.id").alias("dst")).union(near.select("left_id", "right_id")).withColumn("via", F.lit("spatial"))


def clusters(apps: DataFrame, projects: DataFrame, links: DataFrame, family: DataFrame, partitions: DataFrame | None = None, km: float = 1.0, skip_outside: bool = True) -> DataFrame:
    """root, node, kind, key, joined_via, partition of every node.

    apps: id, ref, lat, lon, verdict, in_universe. projects: id, ptno, lat, lon, is_tender.
    links: project_id, application_id. family: src, dst (applications), source.
    partitions: kind (application or project), key (ref or ptno), partition.

    A partition that names a record there is not, and records of two partitions that the
    record itself joins, are errors.
    """
    nodes = universe_nodes(apps, links, family)
    a = apps.join(nodes.withColumnRenamed("node", "_n"), _node(APPLICATION, "id") == F.col("_n"), "left_semi")
    every = a.select(_node(APPLICATION, "id").alias("node"), F.lit("application").alias("kind"), F.col("ref").alias("key"), "lat", "lon").union(
        projects.select(_node(PROJECT, "id").alias("node"), F.lit("project").alias("kind"), F.col("ptno").cast("string").alias("key"), F.when(~F.col("is_tender"), F.col("lat")).alias("lat"), F.col("lon"))
    )
    if partitions is None:
        every = every.withColumn("partition", F.lit(None).cast("string"))
    else:
        _all_known(partitions, apps, projects)
        p = partitions.select(F.col("kind").alias("_kind"), F.upper("key").alias("_key"), "partition")
        every = every.join(p, (F.col("kind") == F.col("_kind")) & (F.upper("key") == F.col("_key")), "left").drop("_kind", "_key")
    every = graph.checkpointed(every)
    said = graph.checkpointed(record_edges(nodes, apps, links, family, skip_outside))
    if partitions is not None:
        joined = graph.components(every.select("node"), said).join(every.select("node", "partition"), "node")
        conflicts = graph.partition_conflicts(joined).limit(20).collect()
        if conflicts:
            raise ValueError("the record joins partitions: " + "; ".join(" and ".join(r["names"]) for r in conflicts))
        every = every.drop("partition").join(graph.closed_partitions(joined).select("node", "partition"), "node")
    edges = graph.checkpointed(said.union(place_edges(every.where("lat is not null and lon is not null"), km).select("src", "dst", "via")))
    root = graph.components(every.select("node"), edges)
    return every.join(root, "node").join(graph.joined_via(every, edges).withColumnRenamed("via", "joined_via"), "node").select("root", "node", "kind", "key", "joined_via", "partition")


def _all_known(partitions: DataFrame, apps: DataFrame, projects: DataFrame) -> None:
    known = apps.select(F.lit("application").alias("kind"), F.upper("ref").alias("key")).union(projects.select(F.lit("project"), F.upper(F.col("ptno").cast("string"))))
    unknown = partitions.select("kind", F.upper("key").alias("key")).join(known, ["kind", "key"], "left_anti").limit(20).collect()
    if unknown:
        raise ValueError("partitions name records there are not: " + ", ".join(sorted(r["key"] for r in unknown)))


def sites(members: DataFrame, apps: DataFrame, projects: DataFrame) -> DataFrame:
    """root, site_key, display_name, classification, lat, lon, coord_source of the clusters that are sites.

    The least project that is no tender leads, else the least application; its place, and else that of
    the least application that has one, is the site's. Clusters of tenders alone, and of
    applications outside the universe without a project, are no sites.
    """
    a = apps.select(_node(APPLICATION, "id").alias("node"), F.coalesce(F.nullif("address", F.lit("")), F.nullif("description", F.lit("")), "ref").alias("title"), "in_universe", F.lit(False).alias("is_tender"), "lat", "lon", "coord_source")
    p = projects.select(_node(PROJECT, "id").alias("node"), "title", F.lit(False).alias("in_universe"), "is_tender", "lat", "lon", F.lit("barbour").alias("coord_source"))
    m = members.select("root", "node", "kind", "key").join(a.unionByName(p), "node").where(~F.col("is_tender"))
    named, kinds = graph.stable_keys(m), graph.classification(m).where("classification <> 'dropped'")
    leads = F.struct((F.col("kind") != "project").alias("later"), F.when(F.col("kind") == "application", F.col("lat").isNull()).otherwise(F.lit(False)).alias("nowhere"), F.col("key"))
    place = m.groupBy("root").agg(F.min_by(F.struct("lat", "lon", F.when(F.col("lat").isNotNull() | (F.col("kind") == "project"), F.col("coord_source")).alias("coord_source")), leads).alias("at"))
    return kinds.join(named, "root").join(place, "root").select("root", "site_key", "display_name", "classification", "at.lat", "at.lon", "at.coord_source")


def superset_report(members: DataFrame, apps: DataFrame, projects: DataFrame) -> DataFrame:
    """classification, sites, applications, projects: how far the two sources cover one another."""
    s = sites(members, apps, projects).select("root", "classification")
    m = members.join(s, "root").groupBy("classification", "root").agg(F.count_if(F.col("kind") == "application").alias("a"), F.count_if(F.col("kind") == "project").alias("p"))
    return m.groupBy("classification").agg(F.count("*").alias("sites"), F.sum("a").alias("applications"), F.sum("p").alias("projects"))
