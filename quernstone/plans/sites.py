"""Queries over sites, claims and permits, over stand-ins made of the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernstone.operators import claims, entities, graph, permits, profiles, quality, sites
from quernstone.plans.registry import query
from quernstone.session import load

# Customers stand for applications, four to a place and 0.67 km apart; suppliers for projects.
KM = 1.0


def _apps(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("c_custkey")
    group, there = F.floor(k / 4), k % 11 != 0
    c = load(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    return c.select(
        k.alias("id"),
        F.concat(F.lit("C"), F.col("c_nationkey").cast("string"), F.lit("/"), F.lpad(k.cast("string"), 9, "0")).alias("ref"),
        F.when(there, 50 + (group % 40) * 0.1 + (k % 4) * 0.006).alias("lat"),
        F.when(there, -5 + (F.floor(group / 40) % 900) * 0.2).cast("double").alias("lon"),
        F.when(there, "application").alias("coord_source"),
        F.when(k % 13 == 0, "not_dc").otherwise("new_build").alias("verdict"),
        ((F.col("c_mktsegment") != "BUILDING") & (k % 13 != 0)).alias("in_universe"),
        F.when(k % 2 == 0, F.concat(F.lit("Address "), k.cast("string"))).otherwise("").alias("address"),
        F.col("c_mktsegment").alias("description"),
    )


def _projects(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("s_suppkey")
    group = F.floor(k * 5 / 4)
    s = load(spark, sf, "supplier").select("s_suppkey", "s_name")
    return s.select(
        k.alias("id"), (k + 1_000_000).alias("ptno"), F.col("s_name").alias("title"), (50 + (group % 40) * 0.1 + 0.002).alias("lat"),
        (-5 + (F.floor(group / 40) % 900) * 0.2).cast("double").alias("lon"), (k % 17 == 0).alias("is_tender"),
    )


def _members(spark: SparkSession, sf: str) -> DataFrame:
    apps, projects = _apps(spark, sf), _projects(spark, sf)
    links = projects.select(F.col("id").alias("project_id"), (F.col("id") * 6 + 1).alias("application_id"))
    family = apps.where("id % 9 = 0").select(F.col("id").alias("src"), (F.col("id") + 4).alias("dst"), F.when(F.col("id") % 18 == 0, "associated_id").otherwise("description").alias("source"))
    named = apps.where("id % 50 = 0").select(F.lit("application").alias("kind"), F.col("ref").alias("key"), F.when(F.col("id") % 100 == 0, "east").otherwise("west").alias("partition"))
    return graph.checkpointed(sites.clusters(apps, projects, links, family, named, KM))


_PLACE = "50 + (g % 40) * 0.1"
_CLUSTERS = f"""
    WITH RECURSIVE a AS (SELECT *, 'A:' || id AS node FROM (SELECT c_custkey AS id, 'C' || c_nationkey || '/' || lpad(c_custkey::VARCHAR, 9, '0') AS ref,
            CASE WHEN c_custkey % 11 <> 0 THEN {_PLACE} + (c_custkey % 4) * 0.006 END AS lat, CASE WHEN c_custkey % 11 <> 0 THEN -5 + ((g // 40) % 900) * 0.2 END AS lon,
            c_custkey % 13 = 0 AS outside, c_mktsegment <> 'BUILDING' AND c_custkey % 13 <> 0 AS in_universe,
            CASE WHEN c_custkey % 2 = 0 THEN 'Address ' || c_custkey ELSE c_mktsegment END AS title FROM (SELECT *, c_custkey // 4 AS g FROM customer))),
    p AS (SELECT s_suppkey AS id, 'P:' || s_suppkey AS node, (s_suppkey + 1000000)::VARCHAR AS ptno, s_name AS title, {_PLACE} + 0.002 AS lat, -5 + ((g // 40) % 900) * 0.2 AS lon, s_suppkey % 17 = 0 AS is_tender FROM (SELECT *, (s_suppkey * 5) // 4 AS g FROM supplier)),
    f AS (SELECT x.node AS src, y.node AS dst, CASE WHEN x.id % 18 = 0 THEN 'family' ELSE 'family_description' END AS via, x.outside OR y.outside AS skipped FROM a x JOIN a y ON y.id = x.id + 4 WHERE x.id % 9 = 0),
    l AS (SELECT p.node AS src, a.node AS dst FROM p JOIN a ON a.id = p.id * 6 + 1),
    own AS (SELECT node FROM a WHERE in_universe UNION SELECT dst FROM l),
    an AS (SELECT node FROM own UNION SELECT dst FROM f WHERE src IN (SELECT node FROM own) UNION SELECT src FROM f WHERE dst IN (SELECT node FROM own)),
    n AS (SELECT node, 'application' AS kind, ref AS key, lat, lon, CASE WHEN id % 100 = 0 THEN 'east' WHEN id % 50 = 0 THEN 'west' END AS own_part FROM a WHERE node IN (SELECT node FROM an)
        UNION ALL SELECT node, 'project', ptno, CASE WHEN NOT is_tender THEN lat END, lon, NULL FROM p),
    said AS (SELECT src, dst, 'project_link' AS via FROM l UNION ALL SELECT src, dst, via FROM f WHERE NOT skipped AND src IN (SELECT node FROM an) AND dst IN (SELECT node FROM an)),
    both_said AS (SELECT src, dst FROM said UNION SELECT dst, src FROM said),
    r1 AS (SELECT node, node AS r FROM n UNION SELECT r1.node, e.dst FROM r1 JOIN both_said e ON e.src = r1.r),
    c1 AS (SELECT node, min(r) AS root FROM r1 GROUP BY node),
    m AS (SELECT n.*, max(own_part) OVER (PARTITION BY root) AS partition FROM n JOIN c1 USING (node)),
    near AS (SELECT x.node AS src, y.node AS dst, 'spatial' AS via FROM m x JOIN m y ON x.node < y.node AND x.partition IS NOT DISTINCT FROM y.partition AND abs(x.lat - y.lat) < 0.02 AND abs(x.lon - y.lon) < 0.03
        AND 2 * 6371.0 * asin(sqrt(pow(sin(radians(y.lat - x.lat) / 2), 2) + cos(radians(x.lat)) * cos(radians(y.lat)) * pow(sin(radians(y.lon - x.lon) / 2), 2))) <= {KM}),
    e AS (SELECT * FROM said UNION ALL SELECT * FROM near),
    both_ends AS (SELECT src, dst FROM e UNION SELECT dst, src FROM e),
    r2 AS (SELECT node, node AS r FROM n UNION SELECT r2.node, b.dst FROM r2 JOIN both_ends b ON b.src = r2.r),
    c2 AS (SELECT node, min(r) AS root FROM r2 GROUP BY node),
    strongest AS (SELECT node, max(CASE via WHEN 'project_link' THEN 4 WHEN 'family' THEN 3 WHEN 'family_description' THEN 2 ELSE 1 END) AS s FROM (SELECT src AS node, via FROM e UNION ALL SELECT dst, via FROM e) GROUP BY node),
    members AS (SELECT c2.root, m.node, m.kind, m.key, CASE s WHEN 4 THEN 'project_link' WHEN 3 THEN 'family' WHEN 2 THEN 'family_description' WHEN 1 THEN 'spatial' ELSE 'singleton' END AS joined_via, m.partition FROM m JOIN c2 USING (node) LEFT JOIN strongest USING (node)),
    w AS (SELECT members.root, members.node, members.kind, members.key, x.title, x.in_universe, x.lat, x.lon, x.src FROM members JOIN (
        SELECT node, title, in_universe, lat, lon, CASE WHEN lat IS NOT NULL THEN 'application' END AS src FROM a UNION ALL SELECT node, title, false, lat, lon, 'barbour' FROM p WHERE NOT is_tender) x USING (node)),
    k AS (SELECT root, bool_or(kind = 'application' AND in_universe) AS ours, bool_or(kind = 'project') AS theirs, bool_or(kind = 'application') AS any_app, bool_or(kind = 'application' AND lat IS NOT NULL) AS located,
        CASE WHEN bool_or(kind = 'project') THEN 'PTNO-' || min(key) FILTER (WHERE kind = 'project') ELSE 'SITE-' || min(key) END AS site_key,
        CASE WHEN bool_or(kind = 'project') THEN arg_min(title, key) FILTER (WHERE kind = 'project') ELSE arg_min(title, key) END AS display_name,
        CASE WHEN bool_or(kind = 'project') THEN arg_min(lat, key) FILTER (WHERE kind = 'project') ELSE arg_min(lat, key) FILTER (WHERE lat IS NOT NULL) END AS lat,
        CASE WHEN bool_or(kind = 'project') THEN arg_min(lon, key) FILTER (WHERE kind = 'project') ELSE arg_min(lon, key) FILTER (WHERE lat IS NOT NULL) END AS lon,
        CASE WHEN bool_or(kind = 'project') THEN 'barbour' ELSE arg_min(src, key) FILTER (WHERE lat IS NOT NULL) END AS coord_source FROM w GROUP BY root),
    s AS (SELECT root, site_key, display_name, CASE WHEN ours AND theirs THEN 'both' WHEN ours AND NOT located THEN 'unlocatable' WHEN ours THEN 'ours_only' WHEN theirs AND any_app THEN 'barbour_covered' WHEN theirs THEN 'barbour_only' END AS classification, lat, lon, coord_source
        FROM k WHERE ours OR theirs)
"""


@query("gr_clusters", _CLUSTERS + "SELECT root, node, kind, key, joined_via, partition FROM members")
def clusters(spark: SparkSession, sf: str) -> DataFrame:
    return _members(spark, sf)


@query("gr_sites", _CLUSTERS + "SELECT root, site_key, display_name, classification, round(lat::DOUBLE, 6) AS lat, round(lon::DOUBLE, 6) AS lon, coord_source FROM s")
def clustered_sites(spark: SparkSession, sf: str) -> DataFrame:
    found = sites.sites(_members(spark, sf), _apps(spark, sf), _projects(spark, sf))
    return found.withColumn("lat", F.round("lat", 6)).withColumn("lon", F.round("lon", 6))


@query("gr_superset", _CLUSTERS + "SELECT classification, count(DISTINCT root) AS sites, count(*) FILTER (WHERE kind = 'application') AS applications, count(*) FILTER (WHERE kind = 'project') AS projects FROM members JOIN s USING (root) GROUP BY classification")
def superset(spark: SparkSession, sf: str) -> DataFrame:
    return sites.superset_report(_members(spark, sf), _apps(spark, sf), _projects(spark, sf))


@query(
    "txt_verify_claim",
    """
    WITH c AS (SELECT p_partkey AS id, p_partkey % 7 <> 0 AS there, p_partkey % 6 AS k FROM part)
    SELECT id, CASE WHEN NOT there THEN 'no_text' WHEN k = 1 THEN 'quote_missing' WHEN k = 2 THEN 'value_missing' WHEN k = 4 THEN 'sum_differs' WHEN k = 5 THEN 'ratings_missing' END AS problem FROM c
    """,
)
def verify_claim(spark: SparkSession, sf: str) -> DataFrame:
    """A part's name and size as a page; claims that hold, and one for each way not to."""
    k, size = F.col("p_partkey"), F.col("p_size")
    p = load(spark, sf, "part").select("p_partkey", "p_name", "p_size")
    said = F.concat("p_name", F.lit("\n  is rated "), size.cast("string"), F.lit(" MWth  and made\tof 2 x 3.5 MWth"))
    pages = p.where(k % 7 != 0).select(k.alias("doc"), F.lit(1).alias("page"), said.alias("text"))
    quote = F.concat(F.lit(" is rated "), size.cast("string"), F.lit(" MWth and made of 2 x 3.5"))
    engines = F.when(k % 6 == 5, F.array(F.struct(F.lit(2).alias("n"), F.lit(9.25).alias("mw")))).when(k % 6 >= 3, F.array(F.struct(F.lit(2).alias("n"), F.lit(3.5).alias("mw"))))
    value = F.when(k % 6 == 2, size + 1000).when(k % 6 == 3, 7.0).when(k % 6 == 4, 8.0).otherwise(size)
    stated = p.select(k.alias("id"), k.alias("doc"), F.lit(1).alias("page"), F.when(k % 6 == 1, "never said").otherwise(quote).alias("quote"), value.cast("double").alias("value"), engines.alias("engines"))
    return claims.verified_claims(stated, pages)


@query("txt_verify_digits", "SELECT p_partkey AS id, CASE WHEN p_partkey % 5 = 0 THEN 'no_text' WHEN p_partkey % 5 = 1 THEN 'value_missing' END AS problem FROM part")
def verify_digits(spark: SparkSession, sf: str) -> DataFrame:
    """Prices on scanned pages that lost their marks, some with another figure."""
    k, price = F.col("p_partkey"), F.col("p_retailprice")
    p = load(spark, sf, "part").select("p_partkey", "p_retailprice")
    printed = F.format_number(price, 2)
    scan = F.concat(F.lit("Total ("), F.translate(F.when(k % 5 == 1, F.lit("77,777.77")).otherwise(printed), ".", " "), F.lit(") GWh"))
    pages = p.where(k % 5 != 0).select(k.alias("doc"), F.lit(3).alias("page"), scan.alias("text"))
    return claims.verified_digits(p.select(k.alias("id"), k.alias("doc"), F.lit(3).alias("page"), price.alias("value")), pages)


@query(
    "txt_permit_reader",
    """
    WITH t AS (SELECT p_partkey AS doc, p_partkey % 5 AS k, p_size % 9 + 2 AS n, p_size % 7 + 1.5 AS mw, p_size % 4 + 2 AS m FROM part),
    e AS (SELECT *, CASE WHEN k IN (0, 1, 3) THEN round(n * mw + m * 3.0, 3)::DOUBLE END AS engines_total FROM t)
    SELECT doc, CASE k WHEN 0 THEN engines_total WHEN 1 THEN 900.0 WHEN 2 THEN 1245.0 WHEN 3 THEN engines_total END AS total_mwth, CASE WHEN k = 0 THEN 2 WHEN k < 4 THEN 1 END AS total_page, engines_total,
        CASE WHEN k IN (0, 1, 3) THEN 2 ELSE 0 END AS n_engines, CASE WHEN k IN (0, 1, 3) THEN n::INT WHEN k = 2 THEN 12 END AS generators, CASE WHEN k = 0 THEN 'N+1' WHEN k = 2 THEN '2N' END AS redundancy,
        CASE k WHEN 0 THEN 'agrees' WHEN 1 THEN 'disagrees' WHEN 2 THEN 'unchecked' WHEN 3 THEN 'summed' ELSE 'none' END AS agreement, CASE WHEN k = 0 THEN 'two' END AS covers FROM e
    """,
)
def permit_reader(spark: SparkSession, sf: str) -> DataFrame:
    """Permits written from parts: totals that agree, differ, stand alone, are only summed, or none."""
    k, size = F.col("p_partkey") % 5, F.col("p_size")
    n, mw, m = size % 9 + 2, size % 7 + 1.5, size % 4 + 2
    engines = F.concat(F.lit("The site has "), n.cast("string"), F.lit(" generators of "), F.format_string("%.1f", mw), F.lit(" MWth. There are also "), m.cast("string"), F.lit(" x 3 MWth."))
    total = F.concat(F.lit("The total thermal input\nis "), F.format_string("%.1f", n * mw + m * 3), F.lit(" MWth across two sites. Redundancy is by N + 1."))
    pages = (
        F.when(k == 0, F.array(engines, total))
        .when(k == 1, F.array(F.concat(engines, F.lit(" A combined 900 MWth is stated."))))
        .when(k == 2, F.array(F.lit("The 12 standby generators have an aggregate of 1,245 MW(th), in the redundant 2 N scheme. One has a thermal input of 4 MWth in total.")))
        .when(k == 3, F.array(engines))
        .otherwise(F.array(F.lit("Nothing is stated here."), F.lit(None).cast("string")))
    )
    return permits.permit_readings(load(spark, sf, "part").select(F.col("p_partkey").alias("doc"), pages.alias("pages"))).drop("total_quote")


@query("txt_permit_title", "SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN s_name || ' Hall' WHEN 1 THEN s_name || ' Park' WHEN 2 THEN 'Unit ' || s_suppkey ELSE s_name || ', Annex' END || ' (EPR/' || s_suppkey || ')' AS name FROM supplier")
def permit_names(spark: SparkSession, sf: str) -> DataFrame:
    k, name = F.col("s_suppkey"), F.col("s_name")
    head = lambda first, title: F.concat(F.lit(f"{first} EPR/AB12/X "), (k % 100).cast("string"), F.lit(" "), title, F.lit(" Permit number EPR/AB12"))
    pages = (
        F.when(k % 4 == 0, F.array(F.lit("cover"), head("Permit number", F.concat(F.lit("OFFICIAL "), name, F.lit(" Hall -")))))
        .when(k % 4 == 1, F.array(head("Variation and consolidation application number", F.concat(name, F.lit(" Park")))))
        .when(k % 4 == 2, F.array(head("Permit number", F.lit("Schedule 1"))))
        .otherwise(F.array(F.lit("no head")))
    )
    address = F.when(k % 4 == 2, F.concat(F.lit("Unit "), k.cast("string"), F.lit(" - EPR/XY99/A001, Mill Lane, Town"))).otherwise(F.concat(name, F.lit(", "), F.lower(name), F.lit(", , Annex, Old Road, Town")))
    s = load(spark, sf, "supplier").select("s_suppkey", "s_name", pages.alias("pages"), address.alias("address"))
    return s.select("s_suppkey", permits.claim_name(F.col("pages"), F.col("address"), F.concat(F.lit("EPR/"), k.cast("string"))).alias("name"))


@query(
    "txt_parties_rank",
    """
    WITH c AS (SELECT c_nationkey AS site, CASE WHEN c_custkey % 3 = 0 THEN 'agent' ELSE 'applicant' END AS bucket, lower(c_mktsegment) AS key, count(*) AS n, arg_min(c_mktsegment || CASE WHEN c_custkey % 2 = 0 THEN ' Ltd' ELSE '' END, c_custkey) AS display FROM customer GROUP BY ALL),
    r AS (SELECT *, row_number() OVER (PARTITION BY site, bucket ORDER BY n DESC, key) AS rank FROM c)
    SELECT site, bucket, string_agg(display || ' (' || n || ')', '; ' ORDER BY rank) AS names FROM r WHERE rank <= 3 GROUP BY site, bucket
    """,
)
def parties_rank(spark: SparkSession, sf: str) -> DataFrame:
    """Segments as companies, with and without their legal form."""
    k = F.col("c_custkey")
    said = F.concat(F.when(k % 2 == 0, F.concat("c_mktsegment", F.lit(" Ltd"))).otherwise(F.col("c_mktsegment")), F.when(k % 5 == 0, " acting as the applicant").otherwise(""))
    c = load(spark, sf, "customer").select(F.col("c_nationkey").alias("site"), F.when(k % 3 == 0, "agent").otherwise("applicant").alias("bucket"), k.alias("ord"), said.alias("said"))
    ranked = entities.ranked_parties(entities.parties(c, "said"))
    return ranked.select("site", "bucket", F.array_join("names", "; ").alias("names"))


@query(
    "txt_acquisition_status",
    """
    SELECT s_suppkey, CASE WHEN s_suppkey % 5 = 0 THEN 'No public application exists yet (pre-planning stage)' WHEN s_suppkey % 5 = 1 AND s_suppkey % 2 = 0 THEN 'A portal that refuses' WHEN s_suppkey % 5 = 1 AND s_suppkey % 3 = 0 THEN 'Register entry ' || s_suppkey WHEN s_suppkey % 5 = 1 THEN 'No documents fetched yet'
        WHEN s_suppkey % 6 = 0 THEN 'Documents held; some applications not retrievable (a portal that REFUSES; register entry ' || s_suppkey || ')' WHEN s_suppkey % 2 = 0 THEN 'Documents held; some applications not retrievable (a portal that REFUSES)'
        WHEN s_suppkey % 3 = 0 THEN 'Documents held; some applications not retrievable (register entry ' || s_suppkey || ')' ELSE 'Documents held' END AS status FROM supplier
    """,
)
def acquisition(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("s_suppkey")
    blocked = F.array(F.when(k % 2 == 0, "a portal that REFUSES"), F.when(k % 2 == 0, "a portal that REFUSES"))
    login = F.when(k % 3 == 0, F.array(F.concat(F.lit("register entry "), k.cast("string"))))
    status = profiles.acquisition_status(k % 5 == 0, F.when(k % 5 == 1, 0).otherwise(k), blocked, login)
    return load(spark, sf, "supplier").select("s_suppkey", status.alias("status"))


@query("srt_total_order_check", "SELECT l_orderkey, l_shipdate, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def total_order(spark: SparkSession, sf: str) -> DataFrame:
    """Where an order of lines by order and day leaves places open."""
    return quality.ties(load(spark, sf, "lineitem"), ["l_orderkey", "l_shipdate"])


@query("srt_random", "SELECT count(*) AS n, count(DISTINCT p_partkey) AS parts FROM (SELECT p_partkey FROM part LIMIT 100)")
def random_sample(spark: SparkSession, sf: str) -> DataFrame:
    """A hundred parts in an order drawn by a seed; the sample is the feature."""
    return load(spark, sf, "part").orderBy(F.rand(7)).limit(100).agg(F.count("*").alias("n"), F.countDistinct("p_partkey").alias("parts"))


@query(
    "dq_mapped_plus_unmapped",
    "SELECT c_custkey, CASE WHEN c_custkey % 10 = 7 THEN 'lost' ELSE 'doubled' END AS problem FROM customer WHERE c_custkey % 10 IN (7, 8) UNION ALL SELECT -s_suppkey - 1, 'foreign' FROM supplier WHERE s_suppkey % 9 = 0",
)
def mapping_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """Customers dealt to two parts with faults: some in neither, some in both, and keys of no customer."""
    c, k = load(spark, sf, "customer").select("c_custkey"), F.col("c_custkey")
    strange = load(spark, sf, "supplier").where("s_suppkey % 9 = 0").select((-F.col("s_suppkey") - 1).alias("c_custkey"))
    mapped = c.where((k % 2 == 0) & (k % 10 != 7)).union(strange)
    return quality.mapping_gaps(c, mapped, c.where(((k % 2 == 1) | (k % 10 == 8)) & (k % 10 != 7)), "c_custkey")
