"""Readers: paged JSON, snapshots, archives, workbooks, series, points and document lists.

All take paths that Spark can open and read in parallel; nothing here goes to a network
from an executor.
"""

from __future__ import annotations

import csv
import datetime as dt
import io
import json
import re
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from quernstone.functions import numbers as N
from quernstone.operators.versioned import latest, top_n


class PagedJson(DataSource):
    """A recorded paged JSON API: `page-1.json`, `page-2.json`, ... under `path`, one partition a page.

    The pages of an interface end at the first short one; `page_size` tells which that is.
    """

    @classmethod
    def name(cls) -> str:
        return "paged_json"

    def schema(self) -> str:
        return "page int, ord int, record string"

    def reader(self, schema: StructType) -> DataSourceReader:
        return PagedJsonReader(self.options)


class PagedJsonReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.field, self.size = options["path"], options.get("field", "records"), int(options.get("page_size", 0))

    def _open(self, page: int):
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(self.path if ":" in self.path else f"file://{self.path}")
        name = f"{base}/page-{page}.json"
        return system.open_input_stream(name) if system.get_file_info(name).is_file else None

    def partitions(self) -> list[InputPartition]:
        out, page = [], 1
        while (file := self._open(page)) is not None:
            with file:
                n = len(json.loads(file.read())[self.field])
            out.append(InputPartition(page))
            if n < self.size:
                break
            page += 1
        return out

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        with self._open(partition.value) as file:
            for k, record in enumerate(json.loads(file.read())[self.field]):
                yield partition.value, k, json.dumps(record)


def paged_json(spark: SparkSession, path: str, field: str = "records", page_size: int = 0) -> DataFrame:
    spark.dataSource.register(PagedJson)
    return spark.read.format("paged_json").option("path", path).option("field", field).option("page_size", page_size).load()


def cached_response(snapshots: DataFrame) -> DataFrame:
    """The newest good snapshot of each source and key: what a request need not ask for again."""
    return latest(snapshots.where("status_code = 200"), ["source_id", "key"], "fetched_at", "id")


def pending_requests(wanted: DataFrame, snapshots: DataFrame) -> DataFrame:
    return wanted.join(cached_response(snapshots).select("source_id", "key"), ["source_id", "key"], "left_anti")


def replayed(snapshots: DataFrame, record_schema: str) -> DataFrame:
    """The records of cached bodies, one a name: those with all fields before partial ones, then the newest."""
    body = F.from_json(F.col("body"), f"struct<records: array<{record_schema}>>")
    rows = snapshots.select("fetched_at", "id", F.posexplode(body["records"]).alias("ord", "r")).select("fetched_at", "id", "ord", "r.*")
    full = F.lit(0)
    for c in rows.columns[3:]:
        full = full + F.col(c).isNotNull().cast("int")
    return top_n(rows, ["name"], [full.desc(), F.desc("fetched_at"), F.desc("id"), F.col("ord")]).drop("fetched_at", "id", "ord")


def csv_in_zip(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of the CSV files inside zip archives, header first, marks of byte order dropped; columns by name, missing ones null."""
    names = StructType.fromDDL(schema).fieldNames()

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for content in pdf["content"]:
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    for member in sorted(n for n in archive.namelist() if n.lower().endswith(".csv")):
                        with archive.open(member) as raw:
                            reader = csv.DictReader(io.TextIOWrapper(raw, "utf-8-sig", newline=""))
                            held = []
                            for row in reader:
                                held.append([row.get(n) for n in names])
                                if len(held) == 10_000:
                                    yield pd.DataFrame(held, columns=names, dtype=object)
                                    held = []
                            if held:
                                yield pd.DataFrame(held, columns=names, dtype=object)

    text = ", ".join(f"`{n}` string" for n in names)
    raw = spark.read.format("binaryFile").load(path).select("content").mapInPandas(rows, text)
    return raw.select(*[F.trim(F.col(f"`{f.name}`")).try_cast(f.dataType).alias(f.name) for f in StructType.fromDDL(schema)])


SHEET = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "r": "http://schemas.openxmlformats.org/officeDocument/2006/relationships"}
DAY_ZERO = dt.datetime(1899, 12, 30)


def _column(ref: str) -> int:
    n = 0
    for ch in re.match("[A-Z]+", ref)[0]:
        n = 26 * n + ord(ch) - 64
    return n - 1


def workbook_rows(content: bytes) -> Iterator[tuple[str, int, list[str | None]]]:
    """sheet, row number and cells as text of an OOXML workbook; cells that are dates by format become ISO dates."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        names = set(z.namelist())
        shared = ["".join(t.text or "" for t in si.iter(f"{{{SHEET['m']}}}t")) for si in ET.fromstring(z.read("xl/sharedStrings.xml"))] if "xl/sharedStrings.xml" in names else []
        dates: list[bool] = []
        if "xl/styles.xml" in names:
            styles = ET.fromstring(z.read("xl/styles.xml"))
            own = {int(f.get("numFmtId")): f.get("formatCode", "") for f in styles.iter(f"{{{SHEET['m']}}}numFmt")}
            for xf in styles.findall("m:cellXfs/m:xf", SHEET):
                code = int(xf.get("numFmtId", 0))
                dates.append(14 <= code <= 22 or 45 <= code <= 47 or bool(re.search("[ymdh]", re.sub(r'"[^"]*"|\[[^\]]*\]', "", own.get(code, "")))))
        links = {r.get("Id"): r.get("Target") for r in ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        for sheet in ET.fromstring(z.read("xl/workbook.xml")).findall("m:sheets/m:sheet", SHEET):
            target = links[sheet.get(f"{{{SHEET['r']}}}id")].lstrip("/")
            for row in ET.fromstring(z.read(target if target.startswith("xl/") else f"xl/{target}")).iter(f"{{{SHEET['m']}}}row"):
                cells: list[str | None] = []
                for c in row.findall("m:c", SHEET):
                    at = _column(c.get("r")) if c.get("r") else len(cells)
                    cells += [None] * (at + 1 - len(cells))
                    value = c.findtext("m:v", None, SHEET)
                    kind, style = c.get("t"), int(c.get("s", 0))
                    if kind == "s" and value is not None:
                        value = shared[int(value)]
                    elif kind == "inlineStr":
                        value = "".join(t.text or "" for t in c.iter(f"{{{SHEET['m']}}}t"))
                    elif kind is None and value is not None and style < len(dates) and dates[style]:
                        value = (DAY_ZERO + dt.timedelta(days=float(value))).date().isoformat()
                    cells[at] = value
                yield sheet.get("name"), int(row.get("r", 0)), cells


def workbooks(spark: SparkSession, path: str) -> DataFrame:
    """path, sheet, row, cells of every row of the workbooks under `path`."""

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for name, content in zip(pdf["path"], pdf["content"], strict=True):
                yield pd.DataFrame([(name, *r) for r in workbook_rows(content)], columns=["path", "sheet", "row", "cells"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(rows, "path string, sheet string, row long, cells array<string>")


def register_rows(rows: DataFrame, header_row: int, columns: dict[str, str]) -> DataFrame:
    """Rows below a fixed header by column title; `excel_row` tells where each one stands."""
    header = rows.where(F.col("row") == header_row).select("path", "sheet", F.col("cells").alias("header"))
    joined = rows.where(F.col("row") > header_row).join(header, ["path", "sheet"])  # a row a sheet; small ones are broadcast by Spark
    picked = [F.try_element_at("cells", F.nullif(F.array_position("header", title), F.lit(0)).cast("int")).alias(name) for title, name in columns.items()]
    return joined.select(F.col("row").alias("excel_row"), *picked)


def projects(rows: DataFrame, header_row: int = 1) -> DataFrame:
    """Project rows of a workbook: ids without decimals, zeros and lone stops as absent, the address from four cells, the whole row kept as JSON."""
    header = rows.where(F.col("row") == header_row).select("path", "sheet", F.col("cells").alias("header"))
    cell = lambda title: F.try_element_at("cells", F.nullif(F.array_position("header", title), F.lit(0)).cast("int"))
    joined = rows.where(F.col("row") > header_row).join(header, ["path", "sheet"])
    address = F.nullif(F.concat_ws(", ", *[N.clean_text(cell(f"Site{k}")) for k in range(1, 5)]), F.lit(""))
    raw = F.to_json(F.map_from_arrays("header", F.slice(F.concat("cells", F.array_repeat(F.lit(None).cast("string"), F.size("header"))), 1, F.size("header"))))
    out = joined.select(
        N.clean_id(cell("Ptno")).alias("external_ref"), N.clean_text(cell("Title")).alias("title"), N.clean_text(cell("Details")).alias("description"), address.alias("address"),
        N.clean_number(cell("Longitude")).alias("longitude"), N.clean_number(cell("Latitude")).alias("latitude"), N.clean_number(cell("Value")).alias("value_gbp"),
        N.clean_text(cell("planning_ref")).alias("planning_ref"), N.clean_text(cell("Authority")).alias("authority_name"), raw.alias("raw_metadata"),
    )
    return out.where("external_ref is not null")


def annual_series(df: DataFrame, name: str = "local_authority") -> DataFrame:
    """authority, year, kwh of a long table; a dual name counts under its first part. A year twice is an error."""
    out = df.select(F.trim(F.split(F.col(name), " / ")[0]).alias("authority"), F.col("year").cast("int").alias("year"), F.col("total_kwh").cast("double").alias("kwh"))
    n = F.count(F.lit(1))
    return out.groupBy("authority", "year").agg(F.when(n == 1, F.max("kwh")).otherwise(F.raise_error(F.concat(F.lit("a year twice: "), F.first("authority"))).cast("double")).alias("kwh"))


def gps_column(c: Column) -> Column:
    """struct(lat, lon) of a field `'lng, lat`, with or without the apostrophe."""
    parts = F.split(F.regexp_replace(c, "^'", ""), ",")
    return F.struct(F.trim(F.get(parts, F.lit(1))).try_cast("double").alias("lat"), F.trim(F.get(parts, F.lit(0))).try_cast("double").alias("lon"))


OVERPASS = "struct<elements: array<struct<type: string, id: bigint, lat: double, lon: double, center: struct<lat: double, lon: double>, tags: map<string,string>>>>"


def overpass_points(responses: DataFrame, body: str = "body") -> DataFrame:
    """id, lat, lon, tags of the elements of a response; ways and relations by their centre."""
    e = F.explode(F.from_json(F.col(body), OVERPASS)["elements"]).alias("e")
    lat, lon = F.coalesce("e.lat", "e.center.lat"), F.coalesce("e.lon", "e.center.lon")
    return responses.select(e).select(F.concat_ws("/", "e.type", F.col("e.id").cast("string")).alias("id"), lat.alias("lat"), lon.alias("lon"), F.col("e.tags").alias("tags")).where("lat is not null and lon is not null")


def geojson_points(spark: SparkSession, path: str) -> DataFrame:
    schema = "features array<struct<geometry: struct<coordinates: array<double>>, properties: map<string,string>>>"
    f = spark.read.schema(schema).option("multiLine", True).json(path).select(F.explode("features").alias("f"))
    return f.select(F.col("f.geometry.coordinates")[1].alias("lat"), F.col("f.geometry.coordinates")[0].alias("lon"), F.col("f.properties").alias("properties"))


def document_links(pages: DataFrame, html: str = "html") -> DataFrame:
    """page_id, href, name of the anchors of a document list, however loosely written; `file=` is decoded, each address once."""
    anchor = F.explode(F.regexp_extract_all(F.col(html), F.lit(r"""(?is)<a\b[^>]*?href\s*=\s*["']?([^"'\s>]+)"""), F.lit(1))).alias("href")
    links = pages.select("page_id", anchor).distinct()
    file = F.try_url_decode(F.regexp_extract("href", r"[?&]file=([^&]+)", 1))
    return links.select("page_id", "href", F.coalesce(F.nullif(file, F.lit("")), F.regexp_extract("href", r"([^/?#]+)(?:[?#].*)?$", 1)).alias("name"))


def document_table(pages: DataFrame, html: str = "html") -> DataFrame:
    """page_id, row, cells (map of header to text), href of tables of documents: the first anchor that is no viewer is the link."""
    rows = F.regexp_extract_all(F.col(html), F.lit(r"(?is)<tr\b[^>]*>(.*?)</tr>"), F.lit(1))
    strip = lambda c: F.trim(F.regexp_replace(F.regexp_replace(c, "(?s)<[^>]+>", " "), r"\s+", " "))
    cells = lambda c: F.transform(F.regexp_extract_all(c, F.lit(r"(?is)<t[hd]\b[^>]*>(.*?)</t[hd]>"), F.lit(1)), strip)
    t = pages.select("page_id", rows.alias("rows")).where(F.size("rows") > 1).select("page_id", cells(F.get("rows", F.lit(0))).alias("header"), F.posexplode(F.slice("rows", F.lit(2), F.greatest(F.size("rows") - 1, F.lit(0)))).alias("row", "tr"))
    hrefs = F.filter(F.regexp_extract_all("tr", F.lit(r"""(?is)<a\b[^>]*?href\s*=\s*["']([^"']+)"""), F.lit(1)), lambda h: ~F.lower(h).contains("viewer"))
    padded = F.slice(F.concat(cells(F.col("tr")), F.array_repeat(F.lit(""), F.size("header"))), 1, F.size("header"))
    return t.where(F.size(F.array_distinct("header")) == F.size("header")).select("page_id", "row", F.map_from_arrays("header", padded).alias("cells"), F.get(hrefs, F.lit(0)).alias("href"))


def data_links(pages: DataFrame, html: str = "html") -> DataFrame:
    """page_id, href, name of lists that keep addresses in attributes: anchors, and elements with data-url or data-href; each address once, as first named."""
    tag = F.regexp_extract_all(F.col(html), F.lit(r"""(?is)<[a-z]+\b[^>]*?(?:\bhref|\bdata-(?:url|href))\s*=\s*["'][^"']+["'][^>]*>[^<]*"""), F.lit(0))
    t = pages.select("page_id", F.posexplode(tag).alias("ord", "tag"))
    at = lambda names: F.nullif(F.regexp_extract("tag", rf"""(?is)\b(?:{names})\s*=\s*["']([^"']+)""", 1), F.lit(""))
    name = F.coalesce(at("data-(?:name|title)|title"), F.nullif(F.trim(F.regexp_extract("tag", r"(?s)>([^<]*)$", 1)), F.lit("")))
    links = t.select("page_id", "ord", F.coalesce(at("data-url|data-href"), at("href")).alias("href"), name.alias("name"))
    return links.groupBy("page_id", "href").agg(F.min_by("name", "ord").alias("name"))


#: What stands around the fields of a project page, and how capacities are written.
PROJECT_NEXT = r"(?:Type of application|Name of applicant|Development|The |This |View |Project stage)"
PROJECT_BLOCK = r"(?s)Name of applicant:\s*(.{2,1400}?)\s*(?:View the developer|Project stage|Project information|$)"
CAPACITY = r"(?i)(\d[\d,]*(?:\.\d+)?)\s*(MW|GW|MWh|GWh|kV)\b"


def project_pages(pages: DataFrame, html: str = "html", hint: str | None = None) -> DataFrame:
    """page_id, name, app_type, applicant, description, description_raw, capacities, stage, latest_update, developer_site of project pages; null is what a page does not show.

    The applicant's name runs into the description; `hint`, a column with the name as known from
    elsewhere, or else the page's own field tells where it ends. Without either the block is kept raw.
    """
    body = F.regexp_replace(F.col(html), r"(?is)<script.*?</script>|<style.*?</style>", " ")
    text = F.trim(F.regexp_replace(F.regexp_replace(body, "<[^>]+>", " "), r"\s+", " "))
    site = r"(?s)href=\"(https?://(?!national-infrastructure-consenting)[^\"]{6,160})\"[^>]*>\s*View the developer"
    p = pages.select("page_id", *([F.col(hint).alias("_hint")] if hint else [F.lit(None).cast("string").alias("_hint")]), body.alias("_body"), text.alias("_t"))
    got = lambda pattern, c="_t": F.nullif(F.trim(F.regexp_extract(c, pattern, 1)), F.lit(""))
    field = lambda label: got(rf"{label}:\s*(.{{2,90}}?)\s*{PROJECT_NEXT}")
    p = p.select("*", field("Type of application").alias("app_type"), field("Name of applicant").alias("applicant"), got(PROJECT_BLOCK).alias("_block"))
    begins = lambda who: (F.trim(who) != "") & F.startswith(F.lower("_block"), F.lower(F.trim(who)))
    known = F.when(begins(F.col("_hint")), F.trim("_hint")).when(begins(F.col("applicant")), F.trim("applicant"))
    rest = F.btrim(F.substr(F.col("_block"), F.length(known) + 1), F.lit(" .,–—-"))
    p = p.withColumn("description", F.nullif(rest, F.lit(""))).withColumn("description_raw", F.when(known.isNull(), F.col("_block")))
    said = F.coalesce("description", "description_raw", F.lit(""))
    numbers, units = (F.regexp_extract_all(said, F.lit(CAPACITY), F.lit(g)) for g in (1, 2))
    capacities = F.array_distinct(F.zip_with(numbers, units, lambda n, u: F.concat(F.replace(n, F.lit(","), F.lit("")), F.lit(" "), F.upper(u))))
    return p.select(
        "page_id", got(r"^(.{2,140}?)\s*-\s*Project information").alias("name"), "app_type", "applicant", "description", "description_raw", capacities.alias("capacities"),
        got(r"This project is at the\s+(.{3,40}?)\s+stage").alias("stage"), got(r"Latest update\s*-\s*(\d{1,2} \w+ \d{4})").alias("latest_update"), got(site, "_body").alias("developer_site"),
    )


def is_listing_url(url: Column) -> Column:
    """Whether an address is one of the portals whose document lists have to be harvested."""
    u = F.coalesce(F.lower(url), F.lit(""))
    return F.contains(u, F.lit("/pr/s/detail/")) | F.contains(u, F.lit("/pr/s/planning-application/"))


def listed_documents(applications: DataFrame, listings: DataFrame, stored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What to fetch (ref, url, description) and ref, status, links, skipped of applications (ref, url) on such portals.

    listings: ref, documents (array<struct(url, description)>); stored: url of what is held. An
    application without a listing needs one and is not empty.
    """
    a = applications.where(is_listing_url(F.col("url"))).select("ref")
    j = a.join(listings.select("ref", "documents"), "ref", "left")
    links = j.select("ref", F.explode("documents").alias("d")).select("ref", F.col("d.url").alias("url"), F.col("d.description").alias("description"))
    held = stored.select(F.col("url").alias("_url")).distinct()
    marked = links.join(held, F.col("url") == F.col("_url"), "left")
    counts = marked.groupBy("ref").agg(F.count("*").alias("links"), F.count("_url").alias("skipped"))
    status = F.when(F.col("documents").isNull(), "needs_listing").when(F.size("documents") == 0, "no_documents").otherwise("listed")
    out = j.select("ref", status.alias("status")).join(counts, "ref", "left").select("ref", "status", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("skipped", F.lit(0)).alias("skipped"))
    return marked.where("_url is null").select("ref", "url", "description"), out


def flattened_groups(responses: DataFrame, body: str = "body") -> DataFrame:
    """id, group, document of grouped JSON; a body that is no JSON means no such case and gives a null document, an empty one gives none."""
    parsed = F.from_json(F.col(body), "struct<groups: array<struct<name: string, documents: array<struct<title: string, url: string>>>>>")
    valid = F.get_json_object(F.col(body), "$.groups").isNotNull()
    found = responses.where(valid).select("id", F.explode(parsed["groups"]).alias("g")).select("id", F.col("g.name").alias("group"), F.explode("g.documents").alias("document"))
    none = responses.where(~valid).select("id", F.lit(None).cast("string").alias("group"), F.lit(None).cast("struct<title: string, url: string>").alias("document"))
    return found.unionByName(none)


def operator_facts(pages: DataFrame, html: str = "html") -> DataFrame:
    """page_id, json_ld, counters, capacities: what a page states in its markup."""
    h = F.col(html)
    return pages.select(
        "page_id",
        F.regexp_extract_all(h, F.lit(r'(?is)<script[^>]+application/ld\+json[^>]*>(.*?)</script>'), F.lit(1)).alias("json_ld"),
        F.regexp_extract_all(h, F.lit(r'(?i)data-(?:count|value|to)\s*=\s*"([^"]+)"'), F.lit(1)).alias("counters"),
        F.array_distinct(F.regexp_extract_all(h, F.lit(r"(?i)(\d[\d,.]*\s*(?:MW|GW|MVA))\b"), F.lit(1))).alias("capacities"),
    )


def error_classes(attempts: DataFrame) -> DataFrame:
    """How often a fetch ended how."""
    e = F.lower(F.coalesce("error", F.lit("")))
    name = F.when(e == "", "ok").when(e.rlike("429|too many"), "rate_limited").when(e.rlike("timed? ?out"), "timeout").when(e.rlike("40[134]|410"), "gone_or_forbidden").when(e.rlike("5\\d\\d"), "server").otherwise("other")
    return attempts.groupBy(name.alias("error_class")).agg(F.count(F.lit(1)).alias("n"))


def new_files(spark: SparkSession, inbox: str, known: DataFrame) -> DataFrame:
    """path, sha256, bytes of the files of an inbox whose content is not known (column content_sha256)."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(inbox).select("path", F.sha2("content", 256).alias("sha256"), F.col("length").alias("bytes"))
    one = found.groupBy("sha256").agg(F.min_by(F.struct("path", "bytes"), "path").alias("f")).select("f.path", "sha256", "f.bytes")
    return one.join(known.select(F.col("content_sha256").alias("sha256")), "sha256", "left_anti")
