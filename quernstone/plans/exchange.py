"""Queries of readers over recorded bodies and of writers' rows, made of the test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quernstone.operators import merge, quality
from quernstone.plans.registry import query
from quernstone.session import load
from quernstone.sources import readers, sinks


def _text(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _join(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


# readers --------------------------------------------------------------------------


@query("src_json_api", "SELECT o_orderkey AS id, unnest(range(0, (o_orderkey % 3)::INT)) AS ord FROM orders")
def json_records(spark: SparkSession, sf: str) -> DataFrame:
    """The records of pages of an interface: none, one and two a page."""
    k = F.col("o_orderkey")
    record = lambda i: F.struct(F.concat(k.cast("string"), F.lit("/"), i.cast("string")).alias("name"))
    records = F.when(k % 3 == 0, F.array().cast("array<struct<name:string>>")).otherwise(F.transform(F.sequence(F.lit(1).cast("long"), F.greatest(k % 3, F.lit(1))), record))
    body = F.to_json(F.struct(records.alias("records"), F.size(records).alias("total")))
    parsed = F.from_json(body, "struct<records: array<struct<name: string>>>")["records"]
    return load(spark, sf, "orders").select(k.alias("id"), F.posexplode(parsed).alias("ord", "r")).select("id", F.col("ord").cast("long").alias("ord"))


@query(
    "src_cache_as_resume",
    """
    WITH s AS (SELECT event_id, user_id, event_type, ts, user_id % 3 <> 0 OR event_type = 'view' AS good FROM events), w AS (SELECT DISTINCT user_id, event_type FROM events)
    SELECT user_id AS source_id, event_type AS key FROM w WHERE (user_id, event_type) NOT IN (SELECT (user_id, event_type) FROM s WHERE good)
    """,
)
def pending_requests(spark: SparkSession, sf: str) -> DataFrame:
    """Requests without a good answer in the cache."""
    e = load(spark, sf, "events")
    cache = e.select(F.col("event_id").alias("id"), F.col("user_id").alias("source_id"), F.col("event_type").alias("key"), F.col("ts").alias("fetched_at"), F.when((F.col("user_id") % 3 == 0) & (F.col("event_type") != "view"), 500).otherwise(200).alias("status_code"))
    return readers.pending_requests(cache.select("source_id", "key").distinct(), cache)


@query(
    "src_snapshots_replay",
    """
    WITH r AS (SELECT user_id AS name, event_id AS id, ts, CASE WHEN event_type = 'view' THEN NULL ELSE event_type END AS kind FROM events)
    SELECT DISTINCT ON (name) name, kind FROM r ORDER BY name, kind IS NULL, ts DESC, id DESC
    """,
)
def snapshots(spark: SparkSession, sf: str) -> DataFrame:
    """Bodies with a record each, some partial: whole ones first, then the newest."""
    e = load(spark, sf, "events")
    record = F.struct(_text("user_id").alias("name"), F.when(F.col("event_type") != "view", F.col("event_type")).alias("kind"))
    cached = e.select(F.col("event_id").alias("id"), F.col("ts").alias("fetched_at"), F.to_json(F.struct(F.array(record).alias("records"))).alias("body"))
    return readers.replayed(cached, "struct<name: string, kind: string>").select(F.col("name").cast("long").alias("name"), "kind")


@query("src_csv_http", "SELECT s_suppkey, CASE WHEN s_suppkey % 3 < 2 THEN s_suppkey / 100.0 END::DOUBLE AS lon, CASE s_suppkey % 3 WHEN 0 THEN 51.5 WHEN 1 THEN 51.25 END::DOUBLE AS lat FROM supplier")
def gps(spark: SparkSession, sf: str) -> DataFrame:
    """Places written `'lng, lat`, without the apostrophe, and not at all."""
    k = F.col("s_suppkey")
    at = F.format_string("%.2f", k / 100.0)
    field = F.when(k % 3 == 0, _join("'", at, ", 51.50")).when(k % 3 == 1, _join(at, ",51.25")).otherwise("not known")
    place = readers.gps_column(field)
    return load(spark, sf, "supplier").select("s_suppkey", place["lon"].alias("lon"), place["lat"].alias("lat"))


@query("src_csv_series", "SELECT n_name AS authority, 2000 + n_regionkey AS year, n_nationkey * 1.5::DOUBLE AS kwh FROM nation")
def series(spark: SparkSession, sf: str) -> DataFrame:
    n = load(spark, sf, "nation")
    name = F.when(F.col("n_nationkey") % 2 == 0, F.concat("n_name", F.lit(" / Casnewydd"))).otherwise(F.concat(F.lit(" "), "n_name"))
    return readers.annual_series(n.select(name.alias("local_authority"), (F.col("n_regionkey") + 2000).alias("year"), (F.col("n_nationkey") * 1.5).alias("total_kwh")))


@query("src_overpass_geojson", "SELECT CASE WHEN s_suppkey % 2 = 0 THEN 'node/' ELSE 'way/' END || s_suppkey AS id, s_suppkey / 10.0::DOUBLE AS lat, -s_suppkey / 20.0::DOUBLE AS lon, s_name AS name FROM supplier WHERE s_suppkey % 5 <> 3")
def overpass(spark: SparkSession, sf: str) -> DataFrame:
    """Nodes with a place, ways with a centre, and elements with neither."""
    k = F.col("s_suppkey")
    lat, lon = k / 10.0, -k / 20.0
    at = F.when((k % 2 == 0) & (k % 5 != 3), F.struct(lat.alias("lat"), lon.alias("lon")))
    centre = F.when((k % 2 == 1) & (k % 5 != 3), F.struct(lat.alias("lat"), lon.alias("lon")))
    element = F.struct(F.when(k % 2 == 0, "node").otherwise("way").alias("type"), k.alias("id"), at["lat"].alias("lat"), at["lon"].alias("lon"), centre.alias("center"), F.create_map(F.lit("name"), F.col("s_name")).alias("tags"))
    body = F.to_json(F.struct(F.array(element).alias("elements")))
    return readers.overpass_points(load(spark, sf, "supplier").select(body.alias("body"))).select("id", "lat", "lon", F.col("tags")["name"].alias("name"))


@query("src_html_docs_idox", "SELECT p_partkey AS page_id, i AS row, 'Plan ' || i AS description, CASE WHEN i = 1 THEN '/files/' || p_partkey || '/1.pdf' END AS href FROM part, (VALUES (0::BIGINT), (1::BIGINT)) v(i) WHERE p_partkey % 4 <> 0")
def document_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Tables of documents: a row whose only anchor is a viewer, and one with a file behind it; every fourth page has none."""
    k = F.col("p_partkey")
    row = lambda i, extra: _join("<tr class=x><td>", F.lit(i), "</td><td> Plan <b>", F.lit(i), "</b></td><td><a href='/Viewer?id=", F.lit(i), "'>view</a>", extra, "</td></tr>")
    table = _join("<table><TR><th>No</th><th>Description</th><th>Link</th></TR>", row(0, F.lit("")), row(1, _join('<a class="y" href="/files/', k, '/1.pdf">get</a>')), "</table>")
    pages = load(spark, sf, "part").select(k.alias("page_id"), F.when(k % 4 == 0, "<p>no documents</p>").otherwise(table).alias("html"))
    return readers.document_table(pages).select("page_id", F.col("row").cast("long").alias("row"), F.col("cells")["Description"].alias("description"), "href")


@query("src_html_docs_ocella", "SELECT p_partkey AS page_id, 'view?file=a%20b' || p_partkey || '.pdf' AS href, 'a b' || p_partkey || '.pdf' AS name FROM part UNION ALL SELECT p_partkey, '/docs/' || p_partkey || '/plan.pdf?x=1', 'plan.pdf' FROM part")
def loose_links(spark: SparkSession, sf: str) -> DataFrame:
    """Anchors written loosely, one of them twice."""
    k = F.col("p_partkey")
    html = _join("<A class=q href = view?file=a%20b", k, ".pdf >x</A><a\nhref='/docs/", k, "/plan.pdf?x=1'>y</a> <a href=\"view?file=a%20b", k, ".pdf\">again</a>")
    return readers.document_links(load(spark, sf, "part").select(k.alias("page_id"), html.alias("html")))


@query("src_html_docs_arcus", "SELECT p_partkey AS page_id, '/doc/' || p_partkey AS href, 'One ' || p_partkey AS name FROM part UNION ALL SELECT p_partkey, '/get?id=' || p_partkey, 'Two' FROM part UNION ALL SELECT p_partkey, '/plain', 'Three' FROM part WHERE p_partkey % 2 = 0")
def attribute_links(spark: SparkSession, sf: str) -> DataFrame:
    """Addresses in anchors and in attributes of other elements, each once."""
    k = F.col("p_partkey")
    html = _join("<a href='/doc/", k, "' title='One ", k, "'>view</a><button class=b data-url='/get?id=", k, "' data-name='Two'>b</button><a href='/doc/", k, "'>again</a>", F.when(k % 2 == 0, "<a href=\"/plain\"> Three </a>").otherwise(""))
    return readers.data_links(load(spark, sf, "part").select(k.alias("page_id"), html.alias("html")))


@query("src_json_docs", "SELECT s_suppkey AS id, 'group ' || (s_suppkey % 2) AS \"group\", 'doc ' || s_suppkey AS title FROM supplier WHERE s_suppkey % 4 > 1 UNION ALL SELECT s_suppkey, NULL, NULL FROM supplier WHERE s_suppkey % 4 = 0")
def grouped_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Bodies with documents in groups, without any, and that are no JSON."""
    k = F.col("s_suppkey")
    full = F.to_json(F.struct(F.array(F.struct(_join("group ", k % 2).alias("name"), F.array(F.struct(_join("doc ", k).alias("title"), F.lit("u").alias("url"))).alias("documents"))).alias("groups")))
    body = F.when(k % 4 == 0, "<html>not found</html>").when(k % 4 == 1, '{"groups": []}').otherwise(full)
    return readers.flattened_groups(load(spark, sf, "supplier").select(k.alias("id"), body.alias("body"))).select("id", "group", F.col("document.title").alias("title"))


@query("src_operator_page", "SELECT p_partkey AS page_id, 1 AS json_ld, p_size || '+' AS counter, p_size || ' MW|' || (p_size + 1) || 'GW' AS capacities FROM part")
def operator_facts(spark: SparkSession, sf: str) -> DataFrame:
    k, n = F.col("p_partkey"), F.col("p_size")
    html = _join('<script type="application/ld+json">{"@type": "Place"}</script><b data-count="', n, '+">x</b><p>', n, " MW, then ", n + 1, "GW and again ", n, " MW</p>")
    f = readers.operator_facts(load(spark, sf, "part").select(k.alias("page_id"), html.alias("html")))
    return f.select("page_id", F.size("json_ld").alias("json_ld"), F.get("counters", F.lit(0)).alias("counter"), F.array_join("capacities", "|").alias("capacities"))


@query(
    "src_portal_fetch",
    "SELECT CASE event_type WHEN 'view' THEN 'ok' WHEN 'click' THEN 'rate_limited' WHEN 'error' THEN 'timeout' WHEN 'signup' THEN CASE WHEN event_id % 2 = 0 THEN 'gone_or_forbidden' ELSE 'server' END ELSE 'other' END AS error_class, count(*) AS n FROM events GROUP BY 1",
)
def fetch_errors(spark: SparkSession, sf: str) -> DataFrame:
    t = F.col("event_type")
    error = F.when(t == "click", "HTTP 429 Too Many Requests").when(t == "error", "read timed out").when((t == "signup") & (F.col("event_id") % 2 == 0), "403 Forbidden").when(t == "signup", "502 Bad Gateway").when(t == "purchase", "reset by peer")
    return readers.error_classes(load(spark, sf, "events").select(error.alias("error")))


def _sheet(spark: SparkSession, sf: str) -> DataFrame:
    """A workbook's rows: a header and a row for each supplier, ids as spreadsheets write them, some cells empty."""
    k = F.col("s_suppkey")
    header = spark.range(1).select(F.lit("w").alias("path"), F.lit("S").alias("sheet"), F.lit(1).cast("long").alias("row"), F.array(*map(F.lit, ("Ptno", "Title", "Value", "Site1", "Site2", "Longitude"))).alias("cells"))
    cells = F.array(F.when(k % 7 != 0, _join(k, ".0")), F.col("s_name"), F.when(k % 2 == 0, _text(k * 10)).otherwise("0"), F.lit("Yard"), F.when(k % 3 == 0, ".").otherwise(_join("Town ", k)), F.format_string("%.1f", k / 2.0))
    rows = load(spark, sf, "supplier").select(F.lit("w").alias("path"), F.lit("S").alias("sheet"), (k + 2).alias("row"), cells.alias("cells"))
    return header.unionByName(rows)


@query(
    "src_xlsx_projects",
    "SELECT s_suppkey::VARCHAR AS external_ref, s_name AS title, CASE WHEN s_suppkey % 3 = 0 THEN 'Yard' ELSE 'Yard, Town ' || s_suppkey END AS address, CASE WHEN s_suppkey > 0 THEN s_suppkey / 2.0 END::DOUBLE AS longitude, CASE WHEN s_suppkey % 2 = 0 AND s_suppkey > 0 THEN s_suppkey * 10 END::DOUBLE AS value_gbp FROM supplier WHERE s_suppkey % 7 <> 0",
)
def workbook_projects(spark: SparkSession, sf: str) -> DataFrame:
    return readers.projects(_sheet(spark, sf)).select("external_ref", "title", "address", "longitude", "value_gbp")


@query("src_xlsx_register", "SELECT s_suppkey + 2 AS excel_row, s_name AS title, 'Yard' AS place FROM supplier")
def workbook_register(spark: SparkSession, sf: str) -> DataFrame:
    return readers.register_rows(_sheet(spark, sf), 1, {"Title": "title", "Site1": "place", "None": "missing"}).where("missing is null").drop("missing")


# writers --------------------------------------------------------------------------


@query("snk_geojson", """SELECT '{"type":"Feature","geometry":{"type":"Point","coordinates":[' || (s_suppkey + 0.5) || ',' || (s_suppkey + 1.5) || ']},"properties":{"s_suppkey":' || s_suppkey || ',"s_name":"' || s_name || '"}}' AS value FROM supplier""")
def features(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("s_suppkey")
    return sinks.geojson(load(spark, sf, "supplier").select("s_suppkey", "s_name", (k + 0.5).cast("double").alias("lon"), (k + 1.5).cast("double").alias("lat")), ["s_suppkey", "s_name"])


@query("snk_kml", "SELECT '<Placemark><name>' || s_name || ' &amp; &lt;co&gt;</name><description>' || CASE WHEN s_suppkey % 2 = 0 THEN '&quot;' || s_suppkey || '&quot;' ELSE '' END || '</description><Point><coordinates>' || (s_suppkey + 0.5) || ',1.5</coordinates></Point></Placemark>' AS value FROM supplier")
def placemarks(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("s_suppkey")
    p = load(spark, sf, "supplier").select(_join(F.col("s_name"), " & <co>").alias("name"), F.when(k % 2 == 0, _join('"', k, '"')).alias("note"), (k + 0.5).cast("double").alias("lon"), F.lit(1.5).alias("lat"))
    return sinks.kml(p, "name", "note")


@query("snk_md", r"SELECT '| ' || n_nationkey || ' | ' || n_name || ' \| x y | ' || coalesce(CASE WHEN n_regionkey > 1 THEN n_regionkey::VARCHAR END, '') || ' |' AS value FROM nation")
def table_rows(spark: SparkSession, sf: str) -> DataFrame:
    n = load(spark, sf, "nation")
    return sinks.markdown_rows(n.select("n_nationkey", F.concat("n_name", F.lit(" | x \n y")).alias("name"), F.when(F.col("n_regionkey") > 1, F.col("n_regionkey")).alias("region")))


@query("snk_csv_bundle", "SELECT n_nationkey, n_regionkey, CASE n_nationkey % 3 WHEN 0 THEN '''=' || n_name WHEN 1 THEN '''-' || n_name ELSE n_name END AS name FROM nation")
def guarded_rows(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("n_nationkey") % 3
    return sinks.guarded(load(spark, sf, "nation").select("n_nationkey", "n_regionkey", F.concat(F.when(k == 0, "=").when(k == 1, "-").otherwise(""), "n_name").alias("name")))


@query("snk_manifest", """SELECT n_regionkey, '[' || string_agg('{"n_nationkey":' || n_nationkey || ',"n_name":"' || n_name || '"}', ',' ORDER BY n_name DESC) || ']' AS manifest FROM (SELECT *, -n_nationkey AS o FROM nation) GROUP BY n_regionkey""")
def manifest(spark: SparkSession, sf: str) -> DataFrame:
    n = load(spark, sf, "nation").select("n_regionkey", "n_nationkey", "n_name")
    ranked = n.withColumn("place", F.row_number().over(Window.partitionBy("n_regionkey").orderBy(F.desc("n_name"))))
    lists = sinks.manifests(ranked, "n_regionkey", "place")
    return lists.select("n_regionkey", F.regexp_replace("manifest", r',"place":\d+', "").alias("manifest"))


@query(
    "snk_file_convert",
    """
    WITH f AS (SELECT doc_id AS path, sha256(text) AS sha256, n_chars AS bytes, CASE doc_id % 6 WHEN 0 THEN 'text' WHEN 1 THEN 'zip' WHEN 2 THEN 'image' WHEN 3 THEN 'doc' WHEN 4 THEN 'pdf' ELSE 'csv' END AS format FROM documents),
    r AS (SELECT *, row_number() OVER (PARTITION BY sha256 ORDER BY path) > 1 AS again FROM f)
    SELECT path, CASE WHEN format = 'image' OR again THEN 'drop' WHEN format IN ('text', 'csv') AND bytes > 2000 THEN 'split' WHEN format = 'zip' THEN 'unpack' WHEN format = 'doc' THEN 'convert' ELSE 'copy' END AS action, CASE WHEN format = 'image' THEN 'no text' WHEN again THEN 'same content' END AS reason FROM r
    """,
)
def file_actions(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("doc_id") % 6
    kind = F.when(k == 0, "text").when(k == 1, "zip").when(k == 2, "image").when(k == 3, "doc").when(k == 4, "pdf").otherwise("csv")
    files = load(spark, sf, "documents").select(F.col("doc_id").alias("path"), F.sha2("text", 256).alias("sha256"), F.col("n_chars").alias("bytes"), kind.alias("format"))
    return sinks.file_actions(files, 2000).select("path", "action", "reason")


@query("snk_claims", "SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'new' ELSE 'stored' END AS value, CASE WHEN c_custkey % 5 = 0 THEN 'old attrs' ELSE 'attrs' END AS attrs FROM customer WHERE c_custkey % 3 <> 0 OR c_custkey % 5 <> 0")
def claims(spark: SparkSession, sf: str) -> DataFrame:
    """Two thirds are stored, four fifths are produced: stored values stay, their attributes are refreshed, orphans are kept."""
    c, k = load(spark, sf, "customer").select("c_custkey"), F.col("c_custkey")
    stored = c.where(k % 3 != 0).select("c_custkey", F.lit("stored").alias("value"), F.lit("old attrs").alias("attrs"))
    produced = c.where(k % 5 != 0).select("c_custkey", F.lit("new").alias("value"), F.lit("attrs").alias("attrs"))
    return merge.merged_claims(stored, produced, ["c_custkey"], refresh="attrs")[0]


@query("snk_claims_pruned", "SELECT 'kept' AS what, count(*) AS n FROM customer WHERE c_custkey % 5 <> 0 UNION ALL SELECT 'orphan', count(*) FROM customer WHERE c_custkey % 5 = 0 AND c_custkey % 3 <> 0")
def pruned_claims(spark: SparkSession, sf: str) -> DataFrame:
    c, k = load(spark, sf, "customer").select("c_custkey"), F.col("c_custkey")
    kept, gone = merge.merged_claims(c.where(k % 3 != 0), c.where(k % 5 != 0), ["c_custkey"], prune=True)
    return kept.agg(F.lit("kept").alias("what"), F.count("*").alias("n")).union(gone.agg(F.lit("orphan"), F.count("*")))


@query("snk_upsert_council", """SELECT 'E' || n_nationkey AS gss_code, CASE WHEN n_nationkey % 2 = 0 AND n_nationkey % 5 <> 0 THEN n_name || ' Council' ELSE n_name END AS name, CASE WHEN n_nationkey % 2 = 0 AND n_nationkey % 5 <> 0 THEN '{"region":' || n_regionkey || '}' END AS notes FROM nation""")
def councils(spark: SparkSession, sf: str) -> DataFrame:
    """Every other nation comes again as an area that plans; every fifth has no code."""
    n, k = load(spark, sf, "nation"), F.col("n_nationkey")
    code = _join("E", k)
    stored = n.select(code.alias("gss_code"), F.col("n_name").alias("name"), F.lit(None).cast("string").alias("notes"))
    areas = n.select(F.when(k % 5 != 0, code).alias("gss_code"), F.concat("n_name", F.lit(" Council")).alias("name"), (k % 2 == 0).alias("is_planning"), F.col("n_regionkey").alias("region"))
    return merge.upserted_councils(stored, areas)


@query("snk_drive_sync", "SELECT p_partkey FROM part WHERE p_partkey % 3 = 0")
def vanishing(spark: SparkSession, sf: str) -> DataFrame:
    """What a mirror would delete, a third of all, which is still allowed."""
    p = load(spark, sf, "part").select("p_partkey")
    return quality.prune_guard(p, p.where("p_partkey % 3 <> 0"), "p_partkey")
