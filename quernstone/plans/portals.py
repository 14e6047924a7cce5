"""Queries of the readers that work on recorded responses and caches, over pages and lists made of the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernstone.plans.registry import query
from quernstone.session import load
from quernstone.sources import formats, readers


@query(
    "src_nsip_page",
    """
    WITH p AS (SELECT p_partkey AS page_id, p_partkey % 3 AS k, p_size AS n, p_brand || ' Energy' AS who, p_type AS kind FROM part)
    SELECT page_id, 'Scheme ' || page_id AS name, CASE WHEN k < 2 THEN kind END AS app_type, CASE k WHEN 0 THEN who || ' Waste plant of ' || n || ' MW and again ' || n || 'MW at 5 kV.' WHEN 1 THEN who END AS applicant,
        CASE k WHEN 0 THEN 'Waste plant of ' || n || ' MW and again ' || n || 'MW at 5 kV' WHEN 1 THEN 'The line of 1,' || (n + 100) || ' kV' END AS description,
        CASE k WHEN 0 THEN n || ' MW|5 KV' WHEN 1 THEN '1' || (n + 100) || ' KV' ELSE '' END AS capacities, CASE WHEN k = 1 THEN 'Decision' END AS stage,
        CASE WHEN k = 0 THEN '3 May 2024' END AS latest_update, CASE WHEN k = 0 THEN 'https://site.example/' || page_id END AS developer_site FROM p
    """,
)
def project_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Project pages written from parts: the applicant known from elsewhere, from the page, and not at all."""
    k, n, who = F.col("p_partkey") % 3, F.col("p_size").cast("string"), F.concat("p_brand", F.lit(" Energy"))
    head = F.concat(F.lit("<html><script>var x = 'Name of applicant: nobody';</script><h1>Scheme "), F.col("p_partkey").cast("string"), F.lit("</h1> - <b>Project information</b>"))
    named = F.concat(F.lit("<dl>Type of application: "), F.col("p_type"), F.lit(" </dl><p>Name of applicant: "), who, F.lit(" "))
    known = F.concat(F.lit("<p>Latest update - 3 May 2024</p>"), named, F.lit("Waste plant of "), n, F.lit(" MW and again "), n, F.lit("MW at 5 kV.</p><a href=\"https://site.example/"), F.col("p_partkey").cast("string"), F.lit("\" rel=x> View the developer's site</a>"))
    own = F.concat(F.lit("<p>This project is at the <b>Decision</b> stage</p>"), named, F.lit("The line of 1,"), (F.col("p_size") + 100).cast("string"), F.lit(" kV</p> Project stage"))
    html = F.concat(head, F.when(k == 0, known).when(k == 1, own).otherwise("<p>Nothing is known.</p>"))
    pages = load(spark, sf, "part").select(F.col("p_partkey").alias("page_id"), html.alias("html"), F.when(k == 0, F.upper(who)).alias("hint"))
    return readers.project_pages(pages, hint="hint").withColumn("capacities", F.array_join("capacities", "|")).drop("description_raw")


@query(
    "src_salesforce",
    """
    WITH a AS (SELECT doc_id, doc_id % 4 AS n FROM documents WHERE doc_id % 3 < 2)
    SELECT 'A/' || doc_id AS ref, CASE WHEN doc_id % 5 = 0 THEN 'needs_listing' WHEN n = 0 THEN 'no_documents' ELSE 'listed' END AS status, CASE WHEN doc_id % 5 = 0 THEN 0 ELSE n END AS links, CASE WHEN doc_id % 5 <> 0 AND n > 0 AND doc_id % 2 = 0 THEN 1 ELSE 0 END AS skipped FROM a
    """,
)
def listings(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("doc_id")
    ref = F.concat(F.lit("A/"), k.cast("string"))
    d = load(spark, sf, "documents").select("doc_id")
    url = F.when(k % 3 == 0, "https://x.example/pr/s/detail/1").when(k % 3 == 1, "https://X.example/PR/S/Planning-Application/2").otherwise("https://x.example/s/1")
    place = lambda i: F.concat(F.lit("u"), k.cast("string"), F.lit("/"), i.cast("string"))
    listed = F.when(k % 4 == 0, F.array().cast("array<struct<url:string,description:string>>")).otherwise(F.transform(F.sequence(F.lit(1).cast("long"), F.greatest(k % 4, F.lit(1))), lambda i: F.struct(place(i).alias("url"), F.lit("plan").alias("description"))))
    have = d.where(k % 5 != 0).select(ref.alias("ref"), listed.alias("documents"))
    return readers.listed_documents(d.select(ref.alias("ref"), url.alias("url")), have, d.where(k % 2 == 0).select(place(F.lit(1)).alias("url")))[1]


@query("fmt_stale", "SELECT doc_id AS path FROM documents WHERE doc_id % 5 IN (0, 1, 4)")
def stale(spark: SparkSession, sf: str) -> DataFrame:
    """Two of five caches say that nothing has read the file, and one is missing."""
    d, k = load(spark, sf, "documents").select(F.col("doc_id").alias("path")), F.col("path")
    cache = d.where(k % 5 != 4).select("path", F.when(k % 5 == 0, "skipped").when(k % 5 == 1, "unsupported").when(k % 5 == 2, "empty").alias("status"))
    return formats.unread(d, cache)


@query("fmt_dispatch_cache", "SELECT doc_id AS path FROM documents WHERE doc_id % 6 IN (0, 1)")
def cacheable(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("doc_id") % 6
    status = F.when(k == 1, "empty").when(k == 2, "empty").when(k == 3, "unsupported").when(k == 4, "failed: BadZipFile").when(k == 5, "skipped")
    results = load(spark, sf, "documents").select(F.col("doc_id").alias("path"), F.when(k == 1, "pdf").otherwise("docx").alias("format"), status.alias("status"))
    return formats.cacheable(results).select("path")


@query("fmt_pagination_backfill", "SELECT doc_id AS path, CASE doc_id % 6 WHEN 0 THEN 'sheets' WHEN 2 THEN 'pages' WHEN 4 THEN 'slides' END AS pagination FROM documents")
def pagination(spark: SparkSession, sf: str) -> DataFrame:
    """Recorded units, recorded formats that are none, and files of which only the first bytes can tell."""
    k = F.col("doc_id") % 6
    recorded = F.when(k == 0, "sheets").when(k == 1, "docx").when(k == 4, "slides")
    content = F.when(k.isin(1, 2), F.concat(F.lit("%PDF-1.7 "), F.col("text"))).when(k == 3, F.col("text")).cast("binary")
    return formats.pagination_of(load(spark, sf, "documents").select(F.col("doc_id").alias("path"), recorded.alias("pagination"), content.alias("content")))
