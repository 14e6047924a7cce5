"""Queries that profile groups of records, over stand-ins made of the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernstone.functions import text as T
from quernstone.operators import linkage, profiles, versioned
from quernstone.plans.registry import query
from quernstone.session import load


def _said(spark: SparkSession, sf: str, phrases: dict[str, str]) -> DataFrame:
    """site, text: what each event says, by its type."""
    k, out = F.col("event_type"), None
    for kind, phrase in phrases.items():
        out = F.when(k == kind, phrase) if out is None else out.when(k == kind, phrase)
    return load(spark, sf, "events").select(F.col("user_id").alias("site"), out.alias("text"))


@query(
    "txt_fuels",
    """
    WITH c AS (SELECT user_id, count(*) FILTER (WHERE event_type IN ('view', 'click')) AS d, count(*) FILTER (WHERE event_type = 'click') AS h, count(*) FILTER (WHERE event_type = 'error') AS chp FROM events GROUP BY user_id),
    l AS (SELECT user_id, chp >= 2 AS is_chp, CASE WHEN d = 0 THEN '' WHEN h = 0 THEN 'Diesel (' || d || ' mentions)' WHEN h >= d * 0.15 THEN 'Diesel (' || d || ' mentions), HVO (' || h || ')' ELSE 'Diesel (' || d || ' mentions); also referenced: HVO' END AS label FROM c)
    SELECT user_id AS site, CASE WHEN is_chp AND label <> '' THEN label || ' — CHP' ELSE label END AS label, is_chp FROM l
    """,
)
def fuels(spark: SparkSession, sf: str) -> DataFrame:
    return profiles.fuel_profile(_said(spark, sf, {"view": "red diesel", "click": "diesel or HVO", "error": "a CHP plant"}))


@query("txt_eia_status", "SELECT user_id AS site, CASE WHEN bool_or(event_type = 'purchase' AND event_id % 2 = 0) THEN 'eia_required' WHEN bool_or(event_type = 'view' AND event_id % 5 = 0) THEN 'eia_not_required' WHEN bool_or(event_type = 'click' AND event_id % 7 = 0) THEN 'scoping' WHEN bool_or(event_type = 'signup') THEN 'screening_requested' END AS status FROM events GROUP BY user_id")
def eia(spark: SparkSession, sf: str) -> DataFrame:
    e = load(spark, sf, "events")
    k, n = F.col("event_type"), F.col("event_id")
    said = F.when((k == "purchase") & (n % 2 == 0), "accompanied by an Environmental Statement").when((k == "view") & (n % 5 == 0), "EIA not required here").when((k == "click") & (n % 7 == 0), "a scoping report").when(k == "signup", "a screening opinion requested")
    return profiles.eia_status(e.select(F.col("user_id").alias("site"), said.alias("text")))


@query("txt_generator_profile", "SELECT l_suppkey AS site, max(l_partkey) FILTER (WHERE l_partkey > 0 AND l_partkey <= 1000) AS generators FROM lineitem GROUP BY 1")
def generators(spark: SparkSession, sf: str) -> DataFrame:
    return profiles.generator_count(load(spark, sf, "lineitem").select(F.col("l_suppkey").alias("site"), F.col("l_partkey").alias("n")))


@query(
    "txt_site_overlays",
    """
    WITH s AS (SELECT source, lang, count(*) AS held, count(l.doc_id) AS read, max(CASE WHEN n_chars > 15000 THEN n_chars END) AS v FROM documents LEFT JOIN labels l USING (doc_id) GROUP BY ALL)
    SELECT source, lang, CASE WHEN lang = 'es' AND held < 5 THEN 'pre_application' WHEN v IS NOT NULL THEN 'disclosed' WHEN read = 0 THEN 'not_yet_analysed' WHEN read < held THEN 'partially_analysed' ELSE 'read_none_disclosed' END AS status, read < held AS provisional FROM s
    """,
)
def overlays(spark: SparkSession, sf: str) -> DataFrame:
    read = load(spark, sf, "labels").select("doc_id").distinct().withColumn("r", F.lit(1))
    d = load(spark, sf, "documents").select("doc_id", "source", "lang", "n_chars").join(read, "doc_id", "left")
    g = d.groupBy("source", "lang").agg(F.count("*").alias("held"), F.count("r").alias("read"), F.max(F.when(F.col("n_chars") > 15000, F.col("n_chars"))).alias("v"))
    status = profiles.capacity_status((F.col("lang") == "es") & (F.col("held") < 5), F.col("held"), F.col("read"), F.col("v"), F.lit("Disclosed"))
    return g.select("source", "lang", status.alias("status"), profiles.is_provisional(F.col("held"), F.col("read")).alias("provisional"))


@query("txt_no_documents_reason", "SELECT o_custkey, CASE WHEN bool_or(o_orderpriority = '1-URGENT') THEN 'Not yet retrieved' WHEN bool_or(o_orderpriority = '2-HIGH') THEN 'Retrieval failed — will retry' ELSE 'Register publishes no documents' END AS reason FROM orders GROUP BY o_custkey")
def no_documents(spark: SparkSession, sf: str) -> DataFrame:
    p = F.col("o_orderpriority")
    outcome = F.when(p == "2-HIGH", "error").when(p != "1-URGENT", "none_published")
    g = load(spark, sf, "orders").groupBy("o_custkey").agg(F.collect_set(F.coalesce(outcome, F.lit("untried"))).alias("o"))
    return g.select("o_custkey", profiles.no_documents_reason(F.col("o")).alias("reason"))


@query(
    "txt_consumption_classify",
    """
    WITH s AS (SELECT p_partkey, CASE WHEN p_size > 3 THEN p_size::DOUBLE END AS c, CASE WHEN p_partkey % 3 = 0 THEN p_retailprice / 50 END AS g, CASE WHEN p_partkey % 2 = 0 THEN p_retailprice / 60 END AS n FROM part)
    SELECT p_partkey, CASE WHEN c IS NULL THEN 'no-consumption-figure' WHEN g < c * 0.8 AND p_partkey % 4 > 1 THEN 'possible-clustering-artefact' WHEN g < c * 0.8 THEN 'contradicted'
        WHEN n / c < 0.5 AND p_partkey % 5 = 0 THEN 'generation-understated' WHEN g IS NOT NULL OR n / c BETWEEN 0.8 AND 1.5 THEN 'corroborated' WHEN n / c < 0.5 THEN 'partial-generation' ELSE 'uncorroborated' END AS status FROM s
    """,
)
def consumption(spark: SparkSession, sf: str) -> DataFrame:
    k, none = F.col("p_partkey"), F.lit(None).cast("double")
    status = profiles.consumption_status(F.when(F.col("p_size") > 3, F.col("p_size").cast("double")), F.when(k % 3 == 0, F.col("p_retailprice") / 50), F.when(k % 2 == 0, F.col("p_retailprice") / 60), none, none, k % 4, k % 5 == 0)
    return load(spark, sf, "part").select("p_partkey", status.alias("status"))


@query("txt_generation_arith", "SELECT l_orderkey, l_linenumber, CASE WHEN abs(l_extendedprice - l_quantity * (l_extendedprice / l_quantity)) <= 0.02 * l_extendedprice THEN 'fleet' END AS fits, CASE WHEN l_quantity / 20 > 1.5 THEN 'generation above stated load' WHEN l_quantity / 20 >= 0.8 THEN 'generation comparable to stated load' WHEN l_quantity / 20 >= 0.5 THEN 'generation between half and four-fifths of stated load' ELSE 'generation below half of stated load' END AS band FROM lineitem")
def generation(spark: SparkSession, sf: str) -> DataFrame:
    q, e = F.col("l_quantity"), F.col("l_extendedprice")
    return load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", profiles.unit_arithmetic(q, e / q, e).alias("fits"), profiles.generation_band(q, F.lit(20.0)).alias("band"))


@query("txt_suspect_view", "SELECT p_partkey, p_retailprice > 1500 AS implausible, p_type = 'ECONOMY' AS signal_says_energy, p_size > 40 AS quote_says_energy FROM part WHERE p_retailprice > 1500 OR p_type = 'ECONOMY' OR p_size > 40")
def suspect(spark: SparkSession, sf: str) -> DataFrame:
    p = load(spark, sf, "part").select("p_partkey", F.lit("site_capacity").alias("verdict"), F.col("p_retailprice").alias("value_mw"), F.when(F.col("p_type") == "ECONOMY", "annual_figure").otherwise("load").alias("signal_type"), F.when(F.col("p_size") > 40, "5 GWh").otherwise("5 MW").alias("evidence"))
    return profiles.suspects(p, 1500.0).select("p_partkey", "implausible", "signal_says_energy", "quote_says_energy")


@query(
    "txt_gap_classify",
    """
    WITH b AS (SELECT DISTINCT ON (o_custkey) o_custkey, o_orderstatus = 'O' AS kw, o_orderdate AS s FROM orders WHERE o_orderpriority <> '5-LOW' ORDER BY o_custkey, o_orderstatus = 'O' DESC, o_orderdate DESC)
    SELECT c.o_custkey AS ref, CASE WHEN b.o_custkey IS NULL THEN 'ref_collision' WHEN s < TIMESTAMP '1995-01-01' THEN 'pre_2018' WHEN NOT kw THEN 'no_keywords' WHEN s > TIMESTAMP '1998-01-01' THEN 'post_sweep' ELSE 'sweep_escape' END AS reason FROM (SELECT DISTINCT o_custkey FROM orders) c LEFT JOIN b USING (o_custkey)
    """,
)
def gaps(spark: SparkSession, sf: str) -> DataFrame:
    day = lambda d: F.lit(d).cast("timestamp_ntz")
    found = load(spark, sf, "orders").select(F.col("o_custkey").alias("ref"), (F.col("o_orderpriority") != "5-LOW").alias("in_authority"), (F.col("o_orderstatus") == "O").alias("has_keyword"), F.col("o_orderdate").alias("start"), day("1995-01-01").alias("before"), day("1998-01-01").alias("after"))
    return profiles.gap_reason(found)


@query("txt_null_sweep", "SELECT user_id AS site, CASE user_id % 3 WHEN 0 THEN 'unread' WHEN 1 THEN 'partly' ELSE 'fully' END AS cohort, CASE WHEN user_id % 3 = 0 THEN 'unsweepable' WHEN bool_or(event_type = 'click' AND event_id % 9 = 0) THEN 'flagged' WHEN bool_or(event_type = 'view' AND event_id % 11 = 0) THEN 'benign' ELSE 'clean' END AS finding FROM events GROUP BY user_id")
def null_sweep(spark: SparkSession, sf: str) -> DataFrame:
    e = load(spark, sf, "events")
    k, n, site = F.col("event_type"), F.col("event_id"), F.col("user_id")
    said = F.when((k == "click") & (n % 9 == 0), "10 MW substation").when((k == "view") & (n % 11 == 0), "7 kW EV charger")
    hits = e.select(site.alias("site"), said.alias("context")).where("context is not null")
    coverage = e.groupBy(site.alias("site")).agg(F.count("*").alias("held")).withColumn("read", F.when(F.col("site") % 3 == 0, 0).when(F.col("site") % 3 == 1, F.col("held") - 1).otherwise(F.col("held")))
    return profiles.null_sweep(hits, coverage)


@query(
    "txt_operator_rows",
    """
    WITH c AS (SELECT l_orderkey * 10 + l_linenumber AS ord, l_partkey AS site, CASE WHEN l_returnflag <> 'N' THEN l_suppkey END AS operator, l_linestatus || l_returnflag AS audience FROM lineitem),
    o AS (SELECT site, arg_min(operator, ord) AS owner FROM c WHERE operator IS NOT NULL GROUP BY site)
    SELECT coalesce(operator, owner) AS operator, count(DISTINCT audience) AS audiences, count(DISTINCT site) AS sites FROM c LEFT JOIN o USING (site) WHERE coalesce(operator, owner) IS NOT NULL GROUP BY 1
    """,
)
def operators(spark: SparkSession, sf: str) -> DataFrame:
    c = load(spark, sf, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ord"), F.col("l_partkey").alias("site"), F.when(F.col("l_returnflag") != "N", F.col("l_suppkey")).alias("operator"), F.concat("l_linestatus", "l_returnflag").alias("audience"))
    return profiles.operator_rows(c)


@query("txt_claim_divergence", "SELECT l_partkey AS site, l_returnflag AS quantity_type, count(DISTINCT l_suppkey) AS audiences, min(l_quantity) AS low, max(l_quantity) AS high, round(max(l_quantity) / min(l_quantity), 6) AS ratio FROM lineitem GROUP BY ALL HAVING count(DISTINCT l_suppkey) > 1")
def claim_divergence(spark: SparkSession, sf: str) -> DataFrame:
    c = load(spark, sf, "lineitem").select(F.col("l_partkey").alias("site"), F.col("l_returnflag").alias("quantity_type"), F.col("l_suppkey").alias("audience"), F.col("l_quantity").alias("value"))
    return profiles.divergences(c).withColumn("ratio", F.round("ratio", 6))


@query(
    "txt_lineage",
    """
    WITH s AS (SELECT s_suppkey, s_suppkey % 6 AS k, n_name, n_nationkey FROM supplier JOIN nation ON n_nationkey = s_nationkey)
    SELECT s_suppkey, CASE k WHEN 0 THEN 'Matched a keyword in the description.' WHEN 1 THEN 'Spatial neighbour (within 1 km) of `' || n_name || '` — *' || n_name || ' place*' || CASE WHEN n_nationkey % 2 = 0 THEN ' (at ' || n_name || ' Road)' ELSE '' END || '.'
        WHEN 2 THEN 'Shares agent or applicant **' || n_name || '** with another application.' WHEN 3 THEN 'Parent permission of `' || n_name || '`.' WHEN 4 THEN 'Known duplicate of `' || n_name || '`.' ELSE 'Spatial neighbour (within 1 km) of `nowhere`.' END AS line FROM s
    """,
)
def lineage(spark: SparkSession, sf: str) -> DataFrame:
    """A tag of each kind, one that names a record there is not, and one that says nothing."""
    s, n = load(spark, sf, "supplier"), load(spark, sf, "nation")
    k = F.col("s_suppkey") % 6
    named = lambda kind: F.concat(F.lit(kind), "n_name")
    tag = F.when(k == 0, "dc_keyword").when(k == 1, named("spatial:")).when(k == 2, named("operator:")).when(k == 3, named("parent_backfill:")).when(k == 4, named("duplicate_of:")).otherwise("spatial:nowhere")
    tags = s.join(n, s.s_nationkey == n.n_nationkey).select(F.col("s_suppkey").alias("ref"), F.array(tag, F.lit("zzz")).alias("tags"))
    anchors = n.select(F.col("n_name").alias("ref"), F.concat("n_name", F.lit(" place")).alias("description"), F.when(F.col("n_nationkey") % 2 == 0, F.concat("n_name", F.lit(" Road"))).otherwise("").alias("address"))
    return profiles.lineage(tags, anchors).select(F.col("ref").alias("s_suppkey"), "line")


@query("gr_inferred_coords", "SELECT s_suppkey AS ref, CASE WHEN s_suppkey % 2 = 0 THEN 1.0 WHEN s_suppkey % 3 = 0 THEN 2.0 END::DOUBLE AS lat, CASE WHEN s_suppkey % 2 = 0 THEN 'application' WHEN s_suppkey % 3 = 0 THEN 'inferred_prior' END AS coord_source FROM supplier")
def coordinates(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("s_suppkey")
    s = load(spark, sf, "supplier").select(k.alias("ref"), F.when(k % 2 == 0, 1.0).alias("lat"), F.when(k % 2 == 0, 1.0).alias("lon"))
    priors = s.where("ref % 3 = 0").select("ref", F.lit(2.0).alias("lat"), F.lit(2.0).alias("lon"))
    return profiles.with_coordinates(s, priors).select("ref", "lat", "coord_source")


@query("gr_colocated", "SELECT s_suppkey AS anchor, s_nationkey AS candidate, 'biomass' AS hit FROM supplier WHERE s_suppkey <> s_nationkey AND s_suppkey % 2 = 0")
def colocated(spark: SparkSession, sf: str) -> DataFrame:
    said = F.when(F.col("s_suppkey") % 2 == 0, "a Biomass plant").otherwise("a shed")
    p = load(spark, sf, "supplier").select(F.col("s_suppkey").alias("anchor"), F.col("s_nationkey").cast("long").alias("candidate"), said.alias("text"), *[F.lit(float(k)).alias(n) for k, n in enumerate(("lat1", "lon1", "lat2", "lon2"))])
    return profiles.colocated(p).select("anchor", F.col("candidate").cast("int").alias("candidate"), F.col("keyword_hits")[0].alias("hit"))


@query("gr_parent_backfill", "SELECT 'A/' || o_orderkey AS child, 'A/' || (o_orderkey + 1) || '/FUL' AS parent FROM orders WHERE o_orderkey % 5 <> 0")
def parents(spark: SparkSession, sf: str) -> DataFrame:
    o = load(spark, sf, "orders").select("o_orderkey", F.concat((F.col("o_orderkey") + 1).cast("string"), F.lit("/FUL")).alias("bare"))
    known = o.where("o_orderkey % 5 = 0").select(F.concat(F.lit("A/"), "bare").alias("ref"))
    return profiles.missing_parents(o.select(F.concat(F.lit("A/"), F.col("o_orderkey").cast("string")).alias("ref"), F.array("bare").alias("candidates")), known)


@query("gr_universe", "WITH l AS (SELECT DISTINCT ON (user_id, event_type) user_id, event_type, value FROM events WHERE event_type IN ('view', 'click') ORDER BY user_id, event_type, ts DESC, event_id DESC) SELECT user_id, bool_or(event_type = 'view' AND value > 50 OR event_type = 'click' AND value <= 50) AS in_universe FROM l GROUP BY user_id")
def universe(spark: SparkSession, sf: str) -> DataFrame:
    """In if the latest verdict of either rubric says so."""
    e = load(spark, sf, "events").where("event_type in ('view', 'click')").drop("props")
    last = versioned.latest_per_variant(e, ["user_id"], F.col("event_type"), "ts", "event_id")
    k, v = F.col("event_type"), F.col("value")
    return last.groupBy("user_id").agg(F.bool_or((k == "view") & (v > 50) | (k == "click") & (v <= 50)).alias("in_universe"))


@query("dq_corpus_stats", "WITH l AS (SELECT DISTINCT ON (user_id) user_id, event_type FROM events ORDER BY user_id, ts DESC, event_id DESC) SELECT (SELECT count(*) FROM orders) AS total, count(*) AS triaged, count(*) FILTER (WHERE event_type = 'view') AS dc, count(*) FILTER (WHERE event_type = 'error') AS unknown FROM l")
def stats(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("event_type")
    last = versioned.latest(load(spark, sf, "events").select("user_id", "event_type", "ts", "event_id"), ["user_id"], "ts", "event_id")
    v = last.select(F.when(k == "view", "DC").when(k == "error", "unknown").otherwise("unrelated").alias("verdict"), F.lit("yes").alias("worth"))
    return profiles.corpus_stats(load(spark, sf, "orders").select(F.col("o_orderdate").alias("received")), v).select("total", "triaged", "dc", "unknown")


@query("jn_family_ref", "SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'K/' || o_custkey || '/100' WHEN o_orderkey % 3 = 0 THEN o_custkey || '/100' END AS parent FROM orders")
def family_ref(spark: SparkSession, sf: str) -> DataFrame:
    o = load(spark, sf, "orders")
    bare = F.concat(F.col("o_custkey").cast("string"), F.lit("/100"))
    k = F.col("o_orderkey")
    ref = F.concat_ws("/", F.when(k % 2 == 0, "K").when(k % 3 == 0, "Q").otherwise("Z"), k.cast("string"))
    known = o.where("o_orderkey % 2 = 0").select(F.concat(F.lit("K/"), bare).alias("ref")).union(o.where("o_orderkey % 3 = 0 and o_orderkey % 2 <> 0").select(bare.alias("ref"))).distinct()
    children = o.select(ref.alias("ref"), k.alias("o_orderkey"), F.lower(F.concat(F.lit("see "), bare)).alias("said"))
    links = linkage.family_links(children.where("ref not like 'Z/%'"), known.withColumn("ref", F.col("ref")), T.candidate_refs(F.col("said")), F.split_part("ref", F.lit("/"), F.lit(1)))
    found = children.join(links.select(F.col("child").alias("ref"), "parent"), "ref", "left")
    wanted = F.when(k % 2 == 0, F.concat(F.lit("K/"), F.split_part("said", F.lit(" "), F.lit(2)))).when(k % 3 == 0, F.split_part("said", F.lit(" "), F.lit(2)))
    return found.select("o_orderkey", F.when(F.col("parent") == wanted, F.col("parent")).alias("parent"))


@query(
    "jn_exact_or_within",
    """
    WITH p AS (SELECT s_suppkey AS id, s_nationkey AS k, 50 + (s_suppkey * 37 % 100) / 1000.0 AS lat, s_suppkey // 100 * 0.2 + (s_suppkey * 53 % 100) / 1000.0 AS lon FROM supplier),
    d AS (SELECT a.id AS left_id, b.id AS right_id, a.k = b.k AS e, 2 * 6371.0 * asin(sqrt(pow(sin(radians(b.lat - a.lat) / 2), 2) + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lon - a.lon) / 2), 2))) AS km FROM p a, p b),
    r AS (SELECT left_id, right_id, row_number() OVER (PARTITION BY left_id ORDER BY CASE WHEN e THEN 0 ELSE 1 END, CASE WHEN e THEN 0 ELSE round(km, 9) END, right_id) AS n FROM d WHERE e OR km <= 1.0)
    SELECT left_id, right_id FROM r WHERE n <= 6
    """,
)
def exact_or_within(spark: SparkSession, sf: str) -> DataFrame:
    """Places derived from keys, a hundred to an area, six neighbours each."""
    k = F.col("s_suppkey")
    lon = F.floor(k / 100) * 0.2 + (k * 53 % 100) / 1000.0
    p = load(spark, sf, "supplier").select(k.alias("id"), F.col("s_nationkey").alias("pc"), (50 + (k * 37 % 100) / 1000.0).alias("lat"), lon.cast("double").alias("lon"))
    return linkage.exact_or_near(p, p, "pc", 1.0).select("left_id", "right_id")
