"""Queries over documents, pages, conversations and labels, with their DuckDB equivalents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernstone.functions import lexicon as L
from quernstone.functions import numbers as N
from quernstone.functions import text as T
from quernstone.operators import entities, passages, quality
from quernstone.plans.registry import query
from quernstone.session import load

NORM = "trim(regexp_replace(lower({}), '\\s+', ' ', 'g'))"
#: Terms that the invented texts have, in place of a subject lexicon.
TERMS = {"articles": ["the", "der", "la", "un"], "links": ["and", "und", "et", "y"], "licences": ["Apache License", "public-license"]}


def _docs(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "documents").select("doc_id", "text", "lang", "source", "n_chars")


@query("fn_norm_ws", f"SELECT doc_id, md5({NORM.format('text')}) AS h FROM documents")
def norm_ws(spark: SparkSession, sf: str) -> DataFrame:
    return _docs(spark, sf).select("doc_id", F.md5(T.norm_ws(F.col("text"))).alias("h"))


@query("fn_digit_density", "SELECT doc_id, round(length(regexp_replace(text, '[^0-9]', '', 'g')) / nullif(length(trim(regexp_replace(text, '\\s+', ' ', 'g'))), 0), 6) AS density FROM documents")
def digit_density(spark: SparkSession, sf: str) -> DataFrame:
    return _docs(spark, sf).select("doc_id", F.round(T.digit_density(F.col("text")), 6).alias("density"))


@query("fn_digit_blob", "SELECT doc_id, regexp_replace(text, '[^0-9]', '', 'g') AS blob FROM documents")
def digit_blob(spark: SparkSession, sf: str) -> DataFrame:
    return _docs(spark, sf).select("doc_id", T.digit_blob(F.col("text")).alias("blob"))


@query("fn_word_count_min_len", "SELECT doc_id, len(list_filter(regexp_split_to_array(lower(text), '[^a-z]+'), lambda w: length(w) >= 3)) AS n FROM documents")
def word_count(spark: SparkSession, sf: str) -> DataFrame:
    return _docs(spark, sf).select("doc_id", T.words_of_length(F.col("text")).cast("long").alias("n"))


@query("fn_regex_extract_num", "SELECT doc_id, TRY_CAST(nullif(regexp_extract(text, '([0-9]+)', 1), '') AS BIGINT) AS n FROM documents")
def first_number(spark: SparkSession, sf: str) -> DataFrame:
    return _docs(spark, sf).select("doc_id", F.regexp_extract("text", "([0-9]+)", 1).try_cast("long").alias("n"))


@query("fn_units", "SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN p_retailprice WHEN 1 THEN p_retailprice * 0.001 WHEN 2 THEN p_retailprice * 1000.0 END AS mw, CASE WHEN p_retailprice >= 1500 THEN 'a' WHEN p_retailprice >= 1000 THEN 'b' ELSE 'c' END AS band FROM part")
def units(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("p_size") % 4
    unit = F.when(k == 0, " MW").when(k == 1, "kw").when(k == 2, "GW").otherwise("MVA")
    bands = ((1500.0, "a"), (1000.0, "b"), (0.0, "c"))
    return load(spark, sf, "part").select("p_partkey", N.to_mw(F.col("p_retailprice"), unit).alias("mw"), N.band(F.col("p_retailprice"), bands).alias("band"))


@query("fn_round_sensibly", "SELECT p_partkey, CASE WHEN p_size < 10 THEN p_size WHEN p_size < 100 THEN round_even(p_size / 5.0, 0) * 5 ELSE round_even(p_size / 10.0, 0) * 10 END::DOUBLE AS mw FROM part")
def round_sensibly(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "part").select("p_partkey", N.round_sensibly(F.col("p_size").cast("double")).alias("mw"))


@query("fn_quote_key", "SELECT doc_id, array_to_string(list_slice(string_split(trim(regexp_replace(regexp_replace(lower(text), '[^a-z0-9 ]+', ' ', 'g'), ' +', ' ', 'g')), ' '), 1, 12), ' ') AS k FROM documents")
def quote_key(spark: SparkSession, sf: str) -> DataFrame:
    return _docs(spark, sf).select("doc_id", T.quote_key(F.col("text")).alias("k"))


@query(
    "fn_jaccard",
    """
    WITH t AS (SELECT doc_id, source, list_distinct(string_split(lower(text), ' ')) AS s FROM documents), p AS (
    SELECT a.doc_id AS a, b.doc_id AS b, len(list_intersect(a.s, b.s)) AS i, len(a.s) + len(b.s) AS u FROM t a JOIN t b ON a.source = b.source AND b.doc_id = (SELECT min(doc_id) FROM t c WHERE c.source = a.source) AND a.doc_id <> b.doc_id)
    SELECT a, b, round(i / (u - i), 6) AS jaccard FROM p
    """,
)
def jaccard(spark: SparkSession, sf: str) -> DataFrame:
    """Texts against the first one of their source."""
    d = _docs(spark, sf).select("doc_id", "source", F.array_distinct(F.split(F.lower("text"), " ")).alias("s"))
    first = d.groupBy("source").agg(F.min_by(F.struct("doc_id", "s"), "doc_id").alias("f"))
    j = d.join(first, "source").where("doc_id <> f.doc_id")
    return j.select(F.col("doc_id").alias("a"), F.col("f.doc_id").alias("b"), F.round(T.jaccard(F.col("s"), F.col("f.s")), 6).alias("jaccard"))


@query("fn_hashes", "SELECT doc_id, sha256(text) AS sha, md5(text) AS md5 FROM documents")
def hashes(spark: SparkSession, sf: str) -> DataFrame:
    return _docs(spark, sf).select("doc_id", F.sha2("text", 256).alias("sha"), F.md5("text").alias("md5"))


@query("fn_trim_words", "SELECT doc_id, CASE WHEN length(trim(text)) <= 60 THEN trim(text) WHEN contains(left(trim(text), 60), ' ') THEN regexp_extract(left(trim(text), 60), '^(.*) ', 1, 's') || '…' ELSE left(trim(text), 60) || '…' END AS head FROM documents")
def trim_words(spark: SparkSession, sf: str) -> DataFrame:
    return _docs(spark, sf).select("doc_id", T.trim_words(F.col("text"), 60).alias("head"))


@query("fn_slugs_and_cells", "SELECT p_partkey, regexp_replace(regexp_replace(lower(p_name), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS slug, replace(p_type, '|', '\\|') AS cell, CASE WHEN regexp_matches(p_brand, '^[=+\\-@]') THEN '''' || p_brand ELSE p_brand END AS guarded, '=HYPERLINK(\"http://x/' || p_partkey || '\",\"' || p_name || '\")' AS link FROM part")
def slugs(spark: SparkSession, sf: str) -> DataFrame:
    url = F.concat(F.lit("http://x/"), F.col("p_partkey").cast("string"))
    return load(spark, sf, "part").select("p_partkey", T.anchor_slug(F.col("p_name")).alias("slug"), T.md_cell(F.col("p_type")).alias("cell"), T.formula_guard(F.col("p_brand")).alias("guarded"), T.hyperlink(url, F.col("p_name")).alias("link"))


@query("fn_dates_and_pages", "SELECT event_id, CAST(ts AS DATE) AS day, CASE event_type WHEN 'view' THEN 'page ' || user_id WHEN 'click' THEN 'sheet ' || user_id ELSE user_id::VARCHAR END AS cite, year(ts) AS y FROM events")
def dates_pages(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("event_type")
    kind = F.when(k == "view", "pages").when(k == "click", "sheets")
    return load(spark, sf, "events").select("event_id", T.parse_date(F.col("ts").cast("string")).alias("day"), T.cite_page(F.col("user_id"), kind).alias("cite"), F.year("ts").cast("long").alias("y"))


@query("fn_url_host", "SELECT page_id, regexp_extract(lower(url), '^[a-z]+://([^/:?#]+)', 1) AS host FROM pages")
def url_host(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "pages").select("page_id", T.url_host(F.col("url")).alias("host"))


@query("fn_strip_html", "SELECT page_id, length(trim(regexp_replace(replace(replace(replace(replace(regexp_replace(regexp_replace(html, '<(script|style)\\b.*?</(script|style)\\s*>', ' ', 'gis'), '<[^>]+>', ' ', 'gs'), '&quot;', '\"'), '&copy;', '©'), '&middot;', '·'), '&amp;', '&'), '\\s+', ' ', 'g'))) AS n FROM pages")
def strip_html(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "pages").select("page_id", F.length(T.strip_html(F.col("html"))).cast("long").alias("n"))


@query("fn_council_words", "SELECT n_nationkey, trim(lower(regexp_replace(regexp_replace(n_name || 'Area', '([a-z])([A-Z])', '\\1 \\2', 'g'), '[-\\s]+', ' ', 'g'))) AS name FROM nation")
def council_words(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "nation").select("n_nationkey", T.council_words(F.concat("n_name", F.lit("Area City Council (Phone: 1)"))).alias("name"))


@query("fn_json_nullable_bool", "SELECT event_id, CASE WHEN (props->>'$.k')::BIGINT % 2 = 0 THEN true WHEN (props->>'$.k')::BIGINT % 3 = 0 THEN false END AS enriched FROM events")
def nullable_bool(spark: SparkSession, sf: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("long")
    j = F.to_json(F.struct(F.when(k % 2 == 0, True).when(k % 3 == 0, False).alias("enriched")))
    return load(spark, sf, "events").select("event_id", F.get_json_object(j, "$.enriched").cast("boolean").alias("enriched"))


@query("txt_keyword_hits", "SELECT doc_id, array_to_string(list_sort(list_filter(['apache', 'license', 'stupid', 'trash'], lambda k: contains(lower(text), k))), ',') AS hits FROM documents")
def keyword_hits(spark: SparkSession, sf: str) -> DataFrame:
    return _docs(spark, sf).select("doc_id", F.array_join(T.keyword_hits(F.col("text"), ["trash", "stupid", "license", "apache"]), ",").alias("hits"))


@query(
    "txt_lexicon_signals",
    """
    WITH l(subject, term, pattern) AS (VALUES ('articles', 'the', 'the'), ('articles', 'der', 'der'), ('articles', 'la', 'la'), ('articles', 'un', 'un'), ('links', 'and', 'and'), ('links', 'und', 'und'), ('links', 'et', 'et'), ('links', 'y', 'y'),
        ('licences', 'Apache License', 'apache[-\\s]*license'), ('licences', 'public-license', 'public[-\\s]*license'))
    SELECT doc_id, subject, term FROM documents, l WHERE regexp_matches(lower(text), '(^|[^a-z0-9])' || pattern || '([^a-z0-9]|$)')
    """,
)
def lexicon_signals(spark: SparkSession, sf: str) -> DataFrame:
    s = _docs(spark, sf).select("doc_id", F.explode(L.subject_signals(F.col("text"), TERMS)).alias("s"))
    return s.select("doc_id", F.col("s.subject").alias("subject"), F.explode("s.terms").alias("term"))


@query("txt_page_score", "SELECT doc_id, len(list_distinct(regexp_extract_all(lower(text), '\\b(apache|license|work|version)\\b', 1))) AS score FROM documents")
def page_score(spark: SparkSession, sf: str) -> DataFrame:
    return _docs(spark, sf).select("doc_id", L.page_score(F.col("text"), ["apache", "license", "work", "version"], {"none": ["zzzzqqqq"]}).cast("long").alias("score"))


@query("txt_tier_hits", "SELECT user_id, count(*) FILTER (WHERE event_type IN ('purchase', 'click')) AS hits FROM events GROUP BY user_id")
def tier_hits(spark: SparkSession, sf: str) -> DataFrame:
    g = load(spark, sf, "events").groupBy("user_id").agg(F.collect_list("event_type").alias("signals"))
    return g.select("user_id", L.tier_hits(F.col("signals"), "(purchase|click)").cast("long").alias("hits"))


@query("txt_character", "SELECT source, CASE WHEN bool_or(n_chars > 8000) THEN 'standalone_datacentre' WHEN bool_or(n_chars > 4000) THEN 'institutional_facility' ELSE 'unclear' END AS character FROM documents GROUP BY source, lang")
def character(spark: SparkSession, sf: str) -> DataFrame:
    said = F.when(F.col("n_chars") > 8000, "erection of a data centre").when(F.col("n_chars") > 4000, "university hall").otherwise("shed")
    rank = F.create_map(*[F.lit(x) for kv in L.SIGNIFICANCE.items() for x in kv])
    d = _docs(spark, sf).select("source", "lang", L.character_for(said).alias("c"))
    return d.groupBy("source", "lang").agg(F.max_by("c", rank[F.col("c")]).alias("character")).select("source", "character")


_FIGURE = r"(?<![\w.])[0-9]{1,4}(\.[0-9]+)?"


@query(
    "txt_sentence_candidates",
    r"""
    WITH s AS (SELECT doc_id, unnest(string_split(regexp_replace(regexp_replace(text, '([.!?])\s+([A-Z])', '\1' || chr(31) || '\2', 'g'), '\n{2,}', chr(31), 'g'), chr(31))) AS s FROM documents),
    t AS (SELECT DISTINCT doc_id, regexp_replace(s, '^\s+|\s+$', '', 'g') AS s FROM s)
    SELECT doc_id, count(*) AS n FROM t WHERE regexp_matches(s, '(^|[^\w.])[0-9]{1,4}') GROUP BY doc_id
    """,
)
def sentence_candidates(spark: SparkSession, sf: str) -> DataFrame:
    """Sentences that hold a figure, each once."""
    p = _docs(spark, sf).select(F.col("doc_id").alias("doc"), F.lit(1).alias("page"), "text")
    return passages.sentence_candidates(p, {"figure": _FIGURE}).groupBy(F.col("doc").alias("doc_id")).agg(F.count("*").alias("n"))


@query(
    "txt_candidates",
    """
    WITH c AS (SELECT p_partkey, p_partkey % 4 AS k, p_size AS n FROM part)
    SELECT p_partkey AS doc, 'capacity' AS pattern, n || ' MW' AS match FROM c WHERE k = 0 UNION ALL SELECT p_partkey, 'capacity', n || 'kVA' FROM c WHERE k = 3
    UNION ALL SELECT p_partkey, 'generator_count', n || ' standby generators' FROM c WHERE k IN (1, 3) UNION ALL SELECT p_partkey, 'fuel_storage', n || ' hours of diesel' FROM c WHERE k = 2
    """,
)
def candidates(spark: SparkSession, sf: str) -> DataFrame:
    """The capacity, fleet and fuel patterns in sentences made of parts."""
    k, n = F.col("p_partkey") % 4, F.col("p_size").cast("string")
    said = F.when(k == 0, F.concat(F.lit("It draws "), n, F.lit(" MW. Nothing more."))).when(k == 1, F.concat(F.lit("There are "), n, F.lit(" standby generators! No 5.x here.")))
    said = said.when(k == 2, F.concat(F.lit("Up to "), n, F.lit(" hours of diesel"))).otherwise(F.concat(F.lit("Each of "), n, F.lit(" standby generators has a rating of "), n, F.lit("kVA.")))
    p = load(spark, sf, "part").select(F.col("p_partkey").alias("doc"), F.lit(1).alias("page"), said.alias("text"))
    return passages.sentence_candidates(p).select("doc", "pattern", "match")


@query(
    "txt_paginate",
    r"""
    WITH RECURSIVE b AS (SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: regexp_replace(x, '[\s\v]+$', '')), lambda x: x <> '') AS bs FROM documents),
    w AS (SELECT doc_id, i, length(bs[i]) AS n FROM (SELECT doc_id, bs, unnest(range(1, len(bs) + 1)) AS i FROM b)),
    r AS (SELECT doc_id, 0::BIGINT AS i, 0::BIGINT AS section, 0::BIGINT AS size, 0::BIGINT AS n FROM documents
        UNION ALL SELECT r.doc_id, w.i, CASE WHEN r.size > 0 AND r.size + w.n > 1000 THEN r.section + 1 ELSE r.section END, CASE WHEN r.size > 0 AND r.size + w.n > 1000 THEN w.n + 1 ELSE r.size + w.n + 1 END,
            CASE WHEN r.size = 0 OR r.size + w.n > 1000 THEN w.n ELSE r.n + 1 + w.n END FROM r JOIN w ON w.doc_id = r.doc_id AND w.i = r.i + 1)
    SELECT doc_id, section, max(n) AS n FROM r WHERE i > 0 GROUP BY doc_id, section
    """,
)
def paginate(spark: SparkSession, sf: str) -> DataFrame:
    d = _docs(spark, sf).select("doc_id", F.posexplode(passages.paginate(F.split("text", "\n"), 1000)).alias("section", "body"))
    return d.select("doc_id", F.col("section").cast("long").alias("section"), F.length("body").cast("long").alias("n"))


@query("txt_select_pages", "WITH p AS (SELECT doc_id, n, s, CASE WHEN contains(lower(s), 'that') THEN 1 ELSE 0 END AS hit FROM (SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS n, unnest(string_split(text, chr(10))) AS s FROM documents)) SELECT doc_id, n::BIGINT AS page FROM (SELECT *, count(*) OVER (PARTITION BY doc_id) AS c, max(hit) OVER (PARTITION BY doc_id ORDER BY n ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS near FROM p) WHERE c <= 6 OR n < 2 OR near = 1")
def select_pages(spark: SparkSession, sf: str) -> DataFrame:
    p = _docs(spark, sf).select(F.col("doc_id").alias("doc"), F.posexplode(F.split("text", "\n")).alias("page", "text"))
    chosen = passages.selected_pages(p, F.contains(F.lower("text"), F.lit("that")).cast("int"), F.lit(1))
    return chosen.where("selected").select(F.col("doc").alias("doc_id"), F.col("page").cast("long").alias("page"))


@query(
    "txt_chunk_pages",
    """
    WITH RECURSIVE b AS (SELECT doc_id, string_split(text, chr(10)) AS bs FROM documents),
    w AS (SELECT doc_id, i, length('[PAGE ' || i || ']') + 2 + length(bs[i]) AS n FROM (SELECT doc_id, bs, unnest(range(1, len(bs) + 1)) AS i FROM b)),
    r AS (SELECT doc_id, 0::BIGINT AS i, 0::BIGINT AS chunk, 0::BIGINT AS n FROM documents
        UNION ALL SELECT r.doc_id, w.i, CASE WHEN r.n > 0 AND r.n + w.n > 2000 THEN r.chunk + 1 ELSE r.chunk END, CASE WHEN r.n > 0 AND r.n + w.n > 2000 THEN w.n ELSE r.n + w.n END FROM r JOIN w ON w.doc_id = r.doc_id AND w.i = r.i + 1)
    SELECT doc_id AS doc, chunk, count(*) AS pages, max(n) AS n FROM r WHERE i > 0 GROUP BY doc_id, chunk
    """,
)
def chunk_pages(spark: SparkSession, sf: str) -> DataFrame:
    p = _docs(spark, sf).select(F.col("doc_id").alias("doc"), F.posexplode(F.split("text", "\n")).alias("page", "text"))
    return passages.chunk_pages(p, 2000).select("doc", "chunk", F.size("pages").cast("long").alias("pages"), F.length("text").cast("long").alias("n"))


@query("txt_best_clause")
def best_clause(spark: SparkSession, sf: str) -> DataFrame:
    return passages.best_clause(_docs(spark, sf), "doc_id", "text")


@query("fn_fragments_in_order", "WITH t AS (SELECT doc_id, text, left(text, 10) AS a, substring(text, 21, 10) AS b FROM documents WHERE n_chars > 40) SELECT doc_id, strpos(substring(text, 11), b) > 0 AS forwards FROM t")
def fragments_in_order(spark: SparkSession, sf: str) -> DataFrame:
    d = _docs(spark, sf).where("n_chars > 40")
    return d.select("doc_id", T.fragments_in_order(F.col("text"), F.array(F.substring("text", 1, 10), F.substring("text", 21, 10))).alias("forwards"))


@query("txt_verify_quote", f"WITH d AS (SELECT doc_id, {NORM.format('text')} AS t FROM documents), b AS (SELECT item_id, {NORM.format('text')} AS q FROM benchmark) SELECT item_id, doc_id FROM b JOIN d ON contains(t, q)")
def verify_quote(spark: SparkSession, sf: str) -> DataFrame:
    b = load(spark, sf, "benchmark").select(F.col("item_id").alias("id"), F.col("text").alias("quote"))
    d = _docs(spark, sf).select(F.col("doc_id").alias("doc"), "text")
    return passages.containing_documents(b, d).select(F.col("id").alias("item_id"), F.col("doc").alias("doc_id"))


def _norm_quote(c: str) -> str:
    """The normal form of quotes and pages, for DuckDB."""
    marks = "[''‘’ʼʻ\"“”„‟‚‛]"
    c = rf"regexp_replace(regexp_replace({c}, '{marks}', '', 'g'), '[•●○◦∙·▪◆■□]', '', 'g')"
    c = rf"regexp_replace(regexp_replace({c}, '\s*[-–—]\s*', '-', 'g'), '\s*([/&+.,:;()])\s*', '\1', 'g')"
    return rf"regexp_replace({NORM.format(c)}, '\b([a-z]{{4,}})\s+(s)(\s|[.,;:?!)\]}}])', '\1\2\3', 'g')"


@query(
    "txt_verify_status",
    rf"""
    WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents), p AS (SELECT doc_id, i AS page, ls[i] AS line, {_norm_quote("ls[i]")} AS t FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM l)),
    f AS (SELECT doc_id, doc_id % 4 + 1 AS page, list_filter(list_transform(regexp_split_to_array(substring(line, 3, 40), '\s*\.{{3,}}\s*|\s*…\s*'), lambda x: regexp_replace(regexp_replace(trim(x), '^[\s(\[{{"‘“]+', ''), '[\s.,;:!?)\]}}"’”]+$', '')), lambda x: x <> '') AS fs FROM p WHERE page = 2),
    q AS (SELECT doc_id, page, list_transform(fs, lambda x: {_norm_quote("x")}) AS fs FROM f),
    j AS (SELECT q.doc_id, q.page, q.fs, p.page AS seen, p.t, trim(p.line) = '' AS blank, len(fs) > 0 AND contains(t, fs[1]) AND (len(fs) = 1 OR contains(substring(t, strpos(t, fs[1]) + length(fs[1])), fs[2])) AS whole FROM q JOIN p USING (doc_id)),
    r AS (SELECT *, CASE WHEN NOT whole THEN NULL WHEN seen = page THEN 0 WHEN seen = page - 1 THEN 1 WHEN seen = page + 1 THEN 2 ELSE 10 + seen END AS rank FROM j),
    g AS (SELECT doc_id, page, any_value(fs) AS fs, min(rank) AS rank, arg_min(seen, rank) AS verified_page, bool_or(seen = page AND blank) AS empty, bool_or(seen = page) AS in_range,
        bool_or(contains(t, fs[1])) AND (any_value(len(fs)) < 2 OR bool_or(contains(t, fs[2]))) AS everywhere FROM r GROUP BY doc_id, page)
    SELECT doc_id AS id, page, verified_page, CASE WHEN len(fs) = 0 THEN 'fail' WHEN rank = 0 THEN 'pass' WHEN empty THEN 'page_empty' WHEN rank <= 2 THEN 'pass_adjacent' WHEN everywhere THEN 'pass_cross_page' WHEN NOT in_range THEN 'page_out_of_range' ELSE 'fail' END AS status FROM g
    """,
)
def verify_status(spark: SparkSession, sf: str) -> DataFrame:
    """Quotes from every document's second line, claimed for its first, third or own page."""
    p = _docs(spark, sf).select(F.col("doc_id").alias("doc"), F.posexplode(F.split("text", "\n")).alias("n", "text")).select("doc", (F.col("n") + 1).alias("page"), "text")
    q = p.where("page = 2").select(F.col("doc").alias("id"), "doc", (F.pmod("doc", F.lit(4)) + 1).alias("page"), F.substring("text", 3, 40).alias("quote"))
    return passages.verified_quotes(q, p).select("id", "page", F.col("verified_page").cast("long").alias("verified_page"), "status")


@query("txt_delta_class", "SELECT l_orderkey, l_linenumber, CASE WHEN contains(lower(p_name || ' ' || l_quantity::BIGINT || ' kg'), (l_linenumber * 10)::VARCHAR || ' kg') THEN 'CONFIRMATION' WHEN l_returnflag = 'A' THEN 'REFINEMENT' ELSE 'NEW_DISCLOSURE' END AS category FROM lineitem JOIN part ON p_partkey = l_partkey")
def delta_class(spark: SparkSession, sf: str) -> DataFrame:
    li, p = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_returnflag"), load(spark, sf, "part").select("p_partkey", "p_name")
    said = F.concat("p_name", F.lit(" "), F.col("l_quantity").cast("long").cast("string"), F.lit(" kg"))
    there = F.contains(T.norm_ws(said), F.concat((F.col("l_linenumber") * 10).cast("string"), F.lit(" kg")))
    category = F.when(there, "CONFIRMATION").when(F.col("l_returnflag") == "A", "REFINEMENT").otherwise("NEW_DISCLOSURE")
    return li.join(p, li.l_partkey == p.p_partkey).select("l_orderkey", "l_linenumber", category.alias("category"))


@query("txt_headline", "SELECT user_id, arg_min(event_id, CASE event_type WHEN 'purchase' THEN 0 WHEN 'signup' THEN 1 ELSE 9 END * 1000000000::BIGINT + event_id) AS event_id FROM events GROUP BY user_id")
def headline(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("event_type")
    return passages.headlines(load(spark, sf, "events"), "user_id", "event_id", F.when(k == "purchase", 0).when(k == "signup", 1).otherwise(9))


@query("txt_parties", "SELECT s_suppkey, replace(lower(s_name), '#', '') AS key FROM supplier")
def parties(spark: SparkSession, sf: str) -> DataFrame:
    s = load(spark, sf, "supplier").select("s_suppkey", F.concat(F.lit("Applicant is "), F.col("s_name"), F.lit(" Ltd acting as agent")).alias("t"))
    return entities.parties(s, "t").select("s_suppkey", "key")


@query("txt_candidate_refs", "SELECT o_orderkey, 'P' || o_orderkey || '/S' || (o_custkey + 100) || '/FUL' AS ref FROM orders")
def candidate_refs(spark: SparkSession, sf: str) -> DataFrame:
    ref = F.concat(F.lit("P"), F.col("o_orderkey").cast("string"), F.lit("/S"), (F.col("o_custkey") + 100).cast("string"), F.lit("/FUL"))
    said = F.concat(F.lit("Discharge of condition 1/2 (A1/B8) on "), ref, F.lit(" and "), ref)
    return load(spark, sf, "orders").select("o_orderkey", F.explode(T.candidate_refs(said)).alias("ref"))


@query("txt_normalise_parent", "SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority || '/x' ELSE o_orderpriority || '/' || o_orderstatus END AS ref FROM orders")
def normalise_parent(spark: SparkSession, sf: str) -> DataFrame:
    child = F.concat("o_orderpriority", F.lit("/child"))
    candidate = F.when(F.col("o_orderkey") % 2 == 0, F.concat("o_orderpriority", F.lit("/x"))).otherwise(F.col("o_orderstatus"))
    return load(spark, sf, "orders").select("o_orderkey", T.full_ref(child, candidate).alias("ref"))


@query("txt_triage_parse", "SELECT event_id, CASE event_type WHEN 'view' THEN 'new_build' ELSE 'not_dc' END AS verdict, CASE WHEN value > 50 THEN 'yes' ELSE 'no' END AS worth_deep_read, 'probable' AS confidence, 2::BIGINT AS n_signals FROM events")
def triage_parse(spark: SparkSession, sf: str) -> DataFrame:
    verdict = F.when(F.col("event_type") == "view", "New Build").otherwise("NOT_DC")
    reply = F.concat(F.lit('Sure:\n```json\n{"verdict": "'), verdict, F.lit('", "worth_deep_read": "'), F.when(F.col("value") > 50, "Yes!").otherwise("nope"), F.lit('", "confidence": "Probably", "signals": "chp, gas engine,"}\n```'))
    p = passages.parsed_verdicts(load(spark, sf, "events").select("event_id", reply.alias("raw")), "raw", ["new_build", "not_dc"])
    return p.select("event_id", "verdict", "worth_deep_read", "confidence", F.size("signals").cast("long").alias("n_signals"))


@query("txt_parse_findings", "SELECT event_id, CASE WHEN value > 20 THEN 2 END::BIGINT AS parsed, CASE WHEN value > 20 THEN 2 ELSE 1 END::BIGINT AS salvaged FROM events")
def parse_findings(spark: SparkSession, sf: str) -> DataFrame:
    whole, cut = F.lit('```json\n{"findings": [{"a": 1}, {"a": 2}]}\n```'), F.lit('{"findings": [{"a": 1}, {"a": "half')
    r = load(spark, sf, "events").select("event_id", F.when(F.col("value") > 20, whole).otherwise(cut).alias("raw"))
    return passages.parsed_replies(r).select("event_id", F.when(F.col("parsed").isNotNull(), F.size("parsed")).cast("long").alias("parsed"), F.size("salvaged").cast("long").alias("salvaged"))


@query("txt_origin_routes", "SELECT user_id, array_to_string(list_sort(list_distinct(list_transform(array_agg(event_type), lambda k: CASE k WHEN 'view' THEN 'Barbour ABI' WHEN 'click' THEN 'Keyword search' ELSE 'Reviewed and excluded' END))), ';') AS routes FROM events GROUP BY user_id")
def origin_routes(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("event_type")
    tag = F.when(k == "view", "barbour:7").when(k == "click", "dc_keyword").otherwise("exclude:x")
    g = load(spark, sf, "events").groupBy("user_id").agg(F.collect_list(tag).alias("tags"))
    return g.select("user_id", F.array_join(F.array_sort(L.routes(F.col("tags"))), ";").alias("routes"))


@query("txt_ranked_label", "WITH c AS (SELECT source, lang, count(*) AS n FROM documents GROUP BY ALL), r AS (SELECT source, lang, n, row_number() OVER (PARTITION BY source ORDER BY n DESC, lang) AS rn, max(n) OVER (PARTITION BY source) AS top FROM c) SELECT source, string_agg(CASE WHEN rn = 1 THEN lang || ' (' || n || ' mentions)' WHEN n >= top * 0.2 THEN lang || ' (' || n || ')' END, ', ' ORDER BY rn) || coalesce('; also referenced: ' || string_agg(CASE WHEN rn > 1 AND n < top * 0.2 THEN lang END, ', ' ORDER BY rn), '') AS label FROM r GROUP BY source")
def ranked_label(spark: SparkSession, sf: str) -> DataFrame:
    n = _docs(spark, sf).groupBy("source", "lang").agg(F.count("*").alias("n"))
    g = n.groupBy("source").agg(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("m"), F.col("lang").alias("label"), "n"))), lambda r: F.struct(r["label"].alias("label"), r["n"].alias("n"))).alias("ranked"))
    return g.select("source", L.ranked_label(F.col("ranked"), 0.2).alias("label"))


@query("txt_power_estimate", "SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN p_retailprice WHEN 1 THEN p_size::DOUBLE END AS value_mw, CASE p_size % 4 WHEN 0 THEN 'Disclosed IT load' WHEN 1 THEN 'Grid connection capacity' WHEN 2 THEN 'No documents held' ELSE 'Not yet analysed' END AS basis FROM part")
def power_estimate(spark: SparkSession, sf: str) -> DataFrame:
    k, none = F.col("p_size") % 4, F.lit(None).cast("double")
    e = N.power_estimate(F.when(k == 0, F.col("p_retailprice")), none, F.when(k <= 1, F.col("p_size").cast("double")), none, none, k != 2, F.lit(3), F.lit(0))
    return load(spark, sf, "part").select("p_partkey", e["value_mw"].alias("value_mw"), e["basis"].alias("basis"))


@query("txt_large_review", "SELECT count(*) AS n FROM (SELECT DISTINCT p_partkey FROM part WHERE p_retailprice >= 1000)")
def large_review(spark: SparkSession, sf: str) -> DataFrame:
    p = load(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("site"), F.col("p_retailprice").alias("value_mw"), F.lit("MW").alias("unit"), F.lit("it_load").alias("quantity_type"), F.col("p_name").alias("evidence"), F.col("p_type").alias("signal_type"))
    return quality.large_figures(p, 1000.0).agg(F.count("*").alias("n"))


@query("txt_mlabel_eval", "SELECT quality AS truth, CASE WHEN regexp_matches(text, '[*$%]{3}|!!|\\|') THEN 0 ELSE 1 END AS guess, count(*) AS n FROM documents JOIN labels USING (doc_id) GROUP BY ALL")
def label_eval(spark: SparkSession, sf: str) -> DataFrame:
    guess = F.when(F.col("text").rlike(r"[*$%]{3}|!!|\|"), 0).otherwise(1)
    j = _docs(spark, sf).join(load(spark, sf, "labels").select("doc_id", "quality"), "doc_id").withColumn("guess", guess)
    return quality.confusion(j, "quality", "guess")


@query("txt_agreement", "SELECT count(*) FILTER (WHERE a.k = b.k) AS agree, count(*) AS shared FROM (SELECT l_orderkey, max(l_quantity) AS k FROM lineitem WHERE l_returnflag = 'N' GROUP BY 1) a JOIN (SELECT l_orderkey, max(l_quantity) AS k FROM lineitem GROUP BY 1) b USING (l_orderkey)")
def agreement(spark: SparkSession, sf: str) -> DataFrame:
    """Two readers of one order: one sees some lines, the other all."""
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_quantity", "l_returnflag")
    most = lambda df: df.groupBy("l_orderkey").agg(F.max("l_quantity").alias("k"))
    return quality.agreement(most(li.where("l_returnflag = 'N'")), most(li), ["l_orderkey"], "k")


@query("txt_enrich_context", "SELECT conv_id, string_agg(role || ': ' || left(text, 20), ' | ' ORDER BY turn) AS context FROM conversations GROUP BY conv_id")
def enrich_context(spark: SparkSession, sf: str) -> DataFrame:
    return passages.context_lines(load(spark, sf, "conversations"), "conv_id", "turn", F.concat("role", F.lit(": "), F.left("text", F.lit(20))))


@query("src_page_links", "SELECT page_id, unnest(regexp_extract_all(html, 'href\\s*=\\s*\"([^\"]*)\"', 1)) AS href FROM pages")
def page_links(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit(r'href\s*=\s*"([^"]*)"'), F.lit(1))).alias("href"))


@query("src_portal_family", "SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'arcus' WHEN page_id % 3 = 1 THEN 'salesforce' ELSE 'bespoke/other' END AS family FROM pages")
def portal(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("page_id") % 3
    tail = F.when(k == 0, "/planning/display/1").when(k == 1, "/s/detail/2").otherwise("/zz")
    return load(spark, sf, "pages").select("page_id", T.portal_family(F.concat("url", tail)).alias("family"))
