"""Pages, sections, chunks and clauses of documents, and quotes held against them."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType
from pyspark.sql.window import Window

from quernstone.functions import text as T


def paginate(blocks: Column, target: int = 3000) -> Column:
    """Blocks joined into sections of about `target` characters; no block is cut, empty ones go."""
    clean = F.filter(F.transform(blocks, lambda b: F.regexp_replace(b, r"\s+$", "")), lambda b: F.trim(F.regexp_replace(b, r"\s", "")) != "")
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("open"), F.lit(0).alias("size"))

    def add(state: Column, block: Column) -> Column:
        full = (state["size"] > 0) & (state["size"] + F.length(block) > target)
        return F.struct(
            F.when(full, F.concat(state["done"], F.array(state["open"]))).otherwise(state["done"]).alias("done"),
            F.when(full | (state["size"] == 0), block).otherwise(F.concat(state["open"], F.lit("\n"), block)).alias("open"),
            F.when(full, F.length(block) + 1).otherwise(state["size"] + F.length(block) + 1).alias("size"),
        )

    return F.aggregate(clean, start, add, lambda s: F.when(s["size"] > 0, F.concat(s["done"], F.array(s["open"]))).otherwise(s["done"]))


def selected_pages(pages: DataFrame, score: Column, context: Column, min_score: int = 1, first: int = 2, whole: int = 6) -> DataFrame:
    """pages (doc, page from 0, text, ...) with score and selected: all of a short document, else the first ones and hits with their neighbours.

    `context` says how many neighbours, 0 or 1.
    """
    w = Window.partitionBy("doc")
    scored = pages.withColumn("score", score).withColumn("_n", F.count(F.lit(1)).over(w))
    hit = F.col("score") >= min_score
    near = F.max(hit).over(w.orderBy("page").rowsBetween(-1, 1))
    return scored.withColumn("selected", (F.col("_n") <= whole) | (F.col("page") < first) | hit | ((context > 0) & near)).drop("_n")


def select_within(pages: DataFrame, budget: int, first: int = 2) -> DataFrame:
    """`selected_pages` cut to a budget of characters a document: the first pages always, then by score, whole pages only.

    Only numbers of pages and their sizes are gathered by document, and folded there; texts stay with their pages.
    """
    later = F.col("page") >= first
    size = F.when(F.col("selected"), F.length("text")).otherwise(0)
    order = F.array_sort(F.collect_list(F.when(F.col("selected") & later, F.struct((-F.col("score")).alias("worst"), F.col("page").alias("page"), size.alias("size")))))
    sums = pages.groupBy("doc").agg(F.sum(size).alias("_all"), F.sum(F.when(~later, size).otherwise(0)).alias("_first"), order.alias("_order"))
    start = F.struct((F.lit(budget) - F.col("_first")).alias("left"), F.array().cast(ArrayType(pages.schema["page"].dataType)).alias("kept"))

    def take(state: Column, page: Column) -> Column:
        fits = page["size"] <= state["left"]
        return F.struct(F.when(fits, state["left"] - page["size"]).otherwise(state["left"]).alias("left"), F.when(fits, F.concat(state["kept"], F.array(page["page"]))).otherwise(state["kept"]).alias("kept"))

    kept = sums.select("doc", "_all", F.aggregate("_order", start, take, lambda state: state["kept"]).alias("_kept"))
    fits = (F.col("_all") <= budget) | ~later | F.array_contains("_kept", F.col("page"))
    return pages.join(kept, "doc").withColumn("selected", F.col("selected") & fits).select(*pages.columns)


def lines_within(body: Column, limit: Column) -> Column:
    """array<string>: pieces of whole lines of at most `limit` characters; a longer line stays whole."""
    lines = F.filter(F.split(body, r"(?<=\n)"), lambda line: line != "")
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("open"))

    def add(state: Column, line: Column) -> Column:
        full = (state["open"] != "") & (F.length(state["open"]) + F.length(line) > limit)
        return F.struct(F.when(full, F.concat(state["done"], F.array(state["open"]))).otherwise(state["done"]).alias("done"), F.when(full, line).otherwise(F.concat(state["open"], line)).alias("open"))

    return F.aggregate(lines, start, add, lambda s: F.when((s["open"] != "") | (F.size(s["done"]) == 0), F.concat(s["done"], F.array(s["open"]))).otherwise(s["done"]))


def chunk_pages(pages: DataFrame, limit: int) -> DataFrame:
    """doc, chunk, pages, text of selected pages (doc, page from 0, text): chunks of about `limit` characters, each piece of a page behind its mark."""
    mark = F.concat(F.lit("[PAGE "), (F.col("page") + 1).cast("string"), F.lit("]\n"))
    pieces = lines_within(F.concat(F.coalesce("text", F.lit("")), F.lit("\n")), F.greatest(F.lit(1), F.lit(limit) - F.length(mark)))
    blocks = F.transform(pieces, lambda piece: F.struct((F.col("page") + 1).cast("long").alias("number"), F.concat(mark, piece).alias("text")))
    of_doc = pages.groupBy("doc").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct(F.col("page").alias("page"), blocks.alias("blocks")))), lambda p: p["blocks"])).alias("blocks"))
    open_ = lambda pages, text: F.struct(pages.alias("pages"), text.alias("text"))
    none = F.array().cast("array<long>")
    start = F.struct(F.array().cast("array<struct<pages:array<bigint>,text:string>>").alias("done"), none.alias("pages"), F.lit("").alias("text"))

    def add(state: Column, block: Column) -> Column:
        full = (state["text"] != "") & (F.length(state["text"]) + F.length(block["text"]) > limit)
        return F.struct(
            F.when(full, F.concat(state["done"], F.array(open_(state["pages"], state["text"])))).otherwise(state["done"]).alias("done"),
            F.when(full, F.array(block["number"])).otherwise(F.array_union(state["pages"], F.array(block["number"]))).alias("pages"),
            F.when(full, block["text"]).otherwise(F.concat(state["text"], block["text"])).alias("text"),
        )

    chunks = F.aggregate("blocks", start, add, lambda s: F.when(s["text"] != "", F.concat(s["done"], F.array(open_(s["pages"], s["text"])))).otherwise(s["done"]))
    return of_doc.select("doc", F.posexplode(chunks).alias("chunk", "c")).select("doc", F.col("chunk").cast("long").alias("chunk"), "c.pages", "c.text")


#: Fixed value: from how many characters on a document is a large one.
LARGE = 400_000


def is_large(characters: Column, least: int = LARGE) -> Column:
    """Whether a document, or all documents of a group, have so many characters that they are read apart."""
    return F.coalesce(characters >= least, F.lit(False))


def headlines(findings: DataFrame, key: str, item: str, rank: Column) -> DataFrame:
    """key, item: the finding of each key that ranks first; of equals the one with the least item."""
    return findings.groupBy(key).agg(F.min_by(F.col(item), F.struct(rank, F.col(item))).alias(item))


def context_lines(rows: DataFrame, key: str, order: str, line: Column, name: str = "context") -> DataFrame:
    """key, context: the lines of each key in order, between bars."""
    lines = F.array_sort(F.collect_list(F.struct(F.col(order).alias("at"), line.alias("line"))))
    return rows.groupBy(key).agg(F.array_join(F.transform(lines, lambda x: x["line"]), " | ").alias(name))


# What a sentence is searched for.
CANDIDATES = {
    "capacity": r"(?<![\w.])(\d{1,4}(?:\.\d+)?)\s*-?\s*(MW|kVA|kW|MVA)\b",
    "generator_count": r"(?<![\w.])(\d{1,3})\s*(?:×|x|\*)?\s*(?:new\s+|proposed\s+|standby\s+|emergency\s+|backup\s+|back-up\s+|diesel\s+|gas\s+)*(?:reciprocating\s+)?(?:engine\s+)?generators?\b",
    "fuel_storage": r"(?<![\w.])(\d{1,6}(?:,\d{3})*(?:\.\d+)?)\s*(hour|hours|hr|hrs|litres?|l|tonnes?|t)\s+(?:of\s+)?(?:diesel|gas|fuel|LPG|propane)\b",
}


def sentence_candidates(pages: DataFrame, patterns: dict[str, str] = CANDIDATES) -> DataFrame:
    """doc, page, pattern, sentence, match: the first match of each pattern in each distinct sentence of a page."""
    sentences = F.split(F.col("text"), r"(?<=[.!?])\s+(?=[A-Z])|\n{2,}")
    s = pages.select("doc", "page", F.posexplode(sentences).alias("place", "sentence")).withColumn("sentence", F.trim(F.regexp_replace("sentence", r"^\s+|\s+$", ""))).where("sentence <> ''")
    tried = F.array(*[F.struct(F.lit(n).alias("pattern"), F.regexp_extract("sentence", "(?i)" + p, 0).alias("match")) for n, p in patterns.items()])
    hits = s.select("doc", "page", "place", "sentence", F.explode(F.filter(tried, lambda t: t["match"] != "")).alias("t"))
    return hits.groupBy("doc", "page", F.col("t.pattern").alias("pattern"), "sentence").agg(F.min_by("t.match", "place").alias("match"))


# How a clause begins or what it names, with the weight of each.
DEVELOPMENT = r"^\s*(?:the\s+|a\s+|an\s+|proposed\s+)?(erection|construction|demolition|redevelopment|re[-\s]development|development of|installation|provision of|change of use|conversion|outline (?:planning )?(?:application|permission)|hybrid (?:planning )?application|full planning (?:application|permission)|extension|creation of|replacement of|alterations?|refurbishment|use of (?:the )?(?:land|site)|proposed development|new \w+|build|siting of|laying out)\b"
PROCEDURE = r"^\s*(?:an?\s+)?(variation|discharge|to discharge|part discharge|partial discharge|non[-\s]material|reserved matters|approval of (?:details|condition)|application (?:for approval|pursuant|to replace|under section|submitted under)|removal of condition|submission of|details? (?:pursuant|required|reserved|of)|consultation (?:from|with)|out of borough|prior (?:notification|approval)|certificate of|request for|screening opinion|scoping opinion|eia (?:screening|scoping)|condition \d|conditions? \d|amendment to|amend the|s\.?\s?73\b|section \d+[a-z]?\b|minor material|compliance with|notification of|confirmation of|deed of|approval of|submission pursuant|further to)\b"
CLAUSE_WEIGHTS = [
    (DEVELOPMENT, 6.0),
    (PROCEDURE, -8.0),
    (r"data\s?cent(?:re|er)|data\s+storage|digital infrastructure|server|technology (?:park|campus)|substation|energy centre|switch\s?room|generator|battery|compute|colocation|co-location|hyperscale", 4.0),
    (r"(?:erection|construction|development|redevelopment|provision|creation|delivery)\s+of\s+(?:\S+\s+){0,8}?(?:data\s?cent|technology (?:park|campus)|digital infrastructure|energy centre|substation)", 3.5),
    (r"(?<!demolition of )(?<!removal of )(?<!replacement of )(?<!clearance of )(?<!demolish )existing\s+(?:data\s?cent(?:re|er)|building|facility|premises|structure|unit|plant)", -4.0),
    (r"\d[\d,.]*\s?(?:sq\.?\s?m|sqm|m2|m²|hectares?|\bha\b|MW|MVA|GW|kVA)", 1.5),
]
REFERENCE = r"\b(?:[A-Z]{1,4}[./])?\d{2,6}[/.]\d{3,6}(?:[/.][A-Z0-9]{1,8})*\b|\b\d{2}/\d{4,5}/[A-Z]+\b"
BOUNDARY = r"\s*(?:;|:|\s[-–—]\s|\.\s+(?=[A-Z])|\[|\]|\)\s+(?=[A-Z])|\band\s+(?=[A-Z]))\s*"
# The lengths of a clause that count, and the weights of what is counted in it.
SHORTEST, LONGEST, LENGTH_SCALE = 24, 200, 90
CONDITION = r"(?i)\bconditions?\s+\d"
CONDITION_WEIGHT, REFERENCE_WEIGHT, OPEN_END_WEIGHT = 1.2, 0.8, 3.0


def clauses(text: Column) -> Column:
    """The clauses of a description, in order: cut at delimiters and after references, short ones dropped."""
    edge = r"^[ ,.\-–—()\[\]]+|[ ,.\-–—()\[\]]+$"
    cut = F.split(text, BOUNDARY)
    # a reference followed by enough text ends a clause
    marked = F.transform(cut, lambda p: F.regexp_replace(p, rf"(?i)(?:{REFERENCE})(?=.{{{SHORTEST + 1},}})", "\x1f"))
    parts = F.flatten(F.transform(marked, lambda p: F.split(p, "\x1f")))
    return F.filter(F.transform(parts, lambda p: F.regexp_replace(p, edge, "")), lambda p: F.length(p) >= SHORTEST)


def clause_score(clause: Column) -> Column:
    """How much a clause reads like a description of what is built; above zero it does.

    The counts of conditions and references are only taken where there is a figure.
    """
    out = F.lit(0.0)
    for pattern, weight in CLAUSE_WEIGHTS:
        out = out + F.when(clause.rlike("(?i)" + pattern), weight).otherwise(0.0)
    counted = CONDITION_WEIGHT * F.regexp_count(clause, F.lit(CONDITION)) + REFERENCE_WEIGHT * F.regexp_count(clause, F.lit("(?i)" + REFERENCE))
    out = out - F.when(clause.rlike("[0-9]"), counted).otherwise(0.0)
    closed, opened = (F.length(clause) - F.length(F.replace(clause, F.lit(b), F.lit(""))) for b in ")(")
    return out - F.when(closed > opened, OPEN_END_WEIGHT).otherwise(0.0) + F.least(F.length(clause), F.lit(LONGEST)) / LENGTH_SCALE


def best_clause(df: DataFrame, key: str, text: str) -> DataFrame:
    """key, clause, score: the clause of each key's texts with the best score, the first of equals.

    Clauses are scored inside their row; one of each row goes to the aggregate.
    """
    scored = F.transform(clauses(F.col(text)), lambda c, k: F.struct(F.round(clause_score(c), 6).alias("score"), (-k).alias("place"), c.alias("clause")))
    best = df.select(key, F.array_max(scored).alias("b")).groupBy(key).agg(F.max("b").alias("b"))
    return best.where("b is not null").select(key, "b.clause", "b.score")


def verified_quotes(quotes: DataFrame, pages: DataFrame) -> DataFrame:
    """quotes (id, doc, page from 1, quote) with verified_page and status.

    Each side is brought to its normal form once. The claimed page counts first, then its
    neighbours, then any page of the document; else every fragment somewhere in it.
    """
    normal = pages.select("doc", F.col("page").alias("_p"), T.norm_quote(F.col("text")).alias("_t"), (F.trim("text") == "").alias("_blank"))
    q = quotes.withColumn("_f", F.transform(T.quote_fragments(F.col("quote")), T.norm_quote))
    joined = q.join(normal, "doc", "left")
    whole = T.fragments_in_order(F.col("_t"), F.col("_f")) & (F.size("_f") > 0)
    step = F.abs(F.col("_p") - F.col("page"))
    rank = F.when(whole & (step == 0), 0).when(whole & (step == 1), F.when(F.col("_p") < F.col("page"), 1).otherwise(2)).when(whole, F.lit(10) + F.col("_p"))
    found = F.transform("_f", lambda f: F.contains(F.col("_t"), f))
    grouped = joined.groupBy("id").agg(
        F.min(F.struct(rank.alias("rank"), F.col("_p").alias("at"))).alias("none"),
        F.min(F.when(rank.isNotNull(), F.struct(rank.alias("rank"), F.col("_p").alias("at")))).alias("best"),
        F.collect_list(found).alias("found"),
        F.bool_or((step == 0) & F.col("_blank")).alias("empty"),
        F.bool_or(step == 0).alias("in_range"),
        F.count("_p").alias("n_pages"),
        F.first("_f").alias("_f"),
    )
    each = F.transform(F.sequence(F.lit(0), F.greatest(F.size("_f") - 1, F.lit(0))), lambda k: F.exists("found", lambda page: F.coalesce(F.get(page, k), F.lit(False))))
    status = (
        F.when(F.col("n_pages") == 0, "cache_missing")
        .when(F.size("_f") == 0, "fail")
        .when(F.col("best.rank") == 0, "pass")
        .when(F.coalesce("empty", F.lit(False)), "page_empty")
        .when(F.col("best.rank") <= 2, "pass_adjacent")
        .when(F.forall(each, lambda x: x), "pass_cross_page")
        .when(~F.coalesce("in_range", F.lit(False)), "page_out_of_range")
        .otherwise("fail")
    )
    return quotes.join(grouped.select("id", F.col("best.at").alias("verified_page"), status.alias("status")), "id")


#: Up to so many quote keys go to the documents; beyond it both sides are shuffled by key.
MOST_KEYS = 1_000_000


def _trigrams(c: Column, step: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.greatest(F.length(c) - step + 1, F.lit(1))), lambda k: F.substring(c, k, step))


def _inner_run(words: str, n: int):
    """n words from the i-th on, with the letters that stand next to them."""
    return lambda i: F.concat(F.right(F.get(words, i - 2), F.lit(1)), F.lit(" "), F.array_join(F.slice(words, i, F.lit(n)), " "), F.lit(" "), F.left(F.get(words, i + n - 1), F.lit(1)))


def containing_documents(quotes: DataFrame, docs: DataFrame) -> DataFrame:
    """id, doc of every document whose normal form holds the quote's, once.

    Words at a quote's ends may be parts of words, so quotes find their candidates by what is
    inside them: a run of eight words for ten words and more; for three to nine all inner words,
    with the letters next to them; for shorter ones three characters (or all there are) of
    their middle. Only candidates are searched. Up to MOST_KEYS keys go to the documents and
    meet them before anything is shuffled.
    """
    words = lambda c: F.filter(F.split(c, " "), lambda w: w != "")
    q = quotes.select("id", F.trim(T.norm_ws(F.col("quote"))).alias("q")).where("q <> ''").withColumn("qw", words(F.col("q"))).withColumn("n", F.size("qw"))
    inner = F.array_join(F.slice("qw", F.lit(2), F.greatest(F.col("n") - 2, F.lit(0))), " ")
    some = F.concat(F.right(F.get("qw", F.lit(0)), F.lit(1)), F.lit(" "), inner, F.lit(" "), F.left(F.element_at("qw", -1), F.lit(1)))
    width = F.least(F.length("q"), F.lit(3))
    middle = F.substring(F.col("q"), F.floor((F.length("q") - width) / 2).cast("int") + 1, width)
    kind = F.when(F.col("n") >= 10, -8).when(F.col("n") >= 3, -(F.col("n") - 2)).otherwise(width)
    text = F.when(F.col("n") >= 10, F.array_join(F.slice("qw", 2, 8), " ")).when(F.col("n") >= 3, some).otherwise(middle)
    keys = q.select("id", kind.alias("kind"), F.xxhash64(kind, text).alias("key"))
    kinds = {r["kind"]: r["n"] for r in keys.groupBy("kind").agg(F.count("*").alias("n")).collect()}

    d = docs.select("doc", T.norm_ws(F.col("text")).alias("t")).withColumn("tw", words(F.col("t")))
    hashed = lambda kind: lambda c: F.xxhash64(F.lit(kind), c)
    found = None
    for k in sorted(kinds):
        if k == -8:
            texts = F.when(F.size("tw") >= 8, F.transform(F.sequence(F.lit(1), F.size("tw") - 7), lambda i: F.array_join(F.slice("tw", i, 8), " ")))
        elif k < 0:
            texts = F.when(F.size("tw") >= 2 - k, F.transform(F.sequence(F.lit(2), F.size("tw") + k), _inner_run("tw", -k)))
        else:
            texts = F.when(F.length("t") >= k, _trigrams(F.col("t"), F.lit(k)))
        held = d.select("doc", F.explode(F.array_distinct(F.transform(texts, hashed(k)))).alias("key"))
        wanted = keys.where(F.col("kind") == k).select("key", "id")
        hits = held.join(F.broadcast(wanted) if kinds[k] <= MOST_KEYS else wanted, "key").select("doc", "id")
        found = hits if found is None else found.unionByName(hits)
    if found is None:
        return docs.select(F.lit(None).cast(quotes.schema["id"].dataType).alias("id"), "doc").limit(0)
    sought = found.distinct().join(q.select("id", "q"), "id").join(d.select("doc", "t"), "doc")
    return sought.where(F.contains("t", F.col("q"))).select("id", "doc").distinct()


FENCE = re.compile(r"^\s*```(?:json)?\s*|\s*```\s*$")


def _objects(raw: str | None) -> tuple[list | None, list]:
    """Findings of a model's reply as parsed, None if it cannot be; and the complete objects of its array."""
    body = FENCE.sub("", (raw or "").strip())
    decode = json.JSONDecoder().raw_decode
    brace, bracket = body.find("{"), body.find("[")
    parsed: list | None = None
    try:
        if bracket >= 0 and (brace < 0 or bracket < brace):
            value = decode(body[bracket:])[0]
        else:
            value = decode(body[brace:])[0].get("findings") if brace >= 0 else None
        parsed = value if isinstance(value, list) else None
    except ValueError:
        pass
    whole, at = [], bracket + 1
    while bracket >= 0 and (start := body.find("{", at)) >= 0:
        try:
            value, length = decode(body[start:])
        except ValueError:
            break
        if isinstance(value, dict):
            whole.append(value)
        at = start + length
    return parsed, whole


def parsed_replies(replies: DataFrame, raw: str = "raw") -> DataFrame:
    """replies with parsed (null where the reply is cut short) and salvaged: arrays of JSON objects as text."""

    @F.pandas_udf("parsed array<string>, salvaged array<string>")
    def parse(values: pd.Series) -> pd.DataFrame:
        both = [_objects(v) for v in values]
        return pd.DataFrame({"parsed": [None if p is None else [json.dumps(x) for x in p] for p, _ in both], "salvaged": [[json.dumps(x) for x in w] for _, w in both]})

    return replies.withColumn("_o", parse(F.col(raw))).select(*replies.columns, "_o.parsed", "_o.salvaged")


def parsed_verdicts(df: DataFrame, raw: str, verdicts: list[str]) -> DataFrame:
    """df with verdict, worth_deep_read, confidence, signals, why from a reply with a JSON object somewhere in it.

    All in expressions: the object is cut out, read permissively, and loose values are
    brought to the closed vocabularies.
    """
    o = F.from_json(F.regexp_extract(raw, r"(?s)\{.*\}", 0), "verdict string, worth_deep_read string, confidence string, signals string, why string")
    v = F.regexp_replace(F.lower(F.trim(o["verdict"])), "[ -]", "_")
    verdict = F.when(v.isin(verdicts), v).otherwise(F.trim(o["verdict"]))
    deep = F.lower(F.trim(o["worth_deep_read"]))
    deep = F.when(deep.startswith("y"), "yes").when(deep.startswith("n"), "no").when(deep.startswith("may"), "maybe").otherwise(deep)
    sure = F.lower(F.trim(F.coalesce(o["confidence"], F.lit("guessing"))))
    sure = F.when(sure.startswith("sure"), "sure").when(sure.startswith("prob"), "probable").when(sure.startswith("guess"), "guessing").otherwise(sure)
    listed = F.from_json(o["signals"], "array<string>")
    signals = F.filter(F.transform(F.coalesce(listed, F.split(o["signals"], ",")), lambda s: F.trim(s)), lambda s: s != "")
    return df.select("*", verdict.alias("verdict"), deep.alias("worth_deep_read"), sure.alias("confidence"), F.coalesce(signals, F.array().cast("array<string>")).alias("signals"), F.trim(F.coalesce(o["why"], F.lit(""))).alias("why"))


def greedy_groups(rows: DataFrame, keys: list[str], order: list[Column], size: Column, limit: int, name: str = "chunk") -> DataFrame:
    """Rows with the number of the group they fall into when groups are filled in order up to `limit`.

    The running total starts anew whenever a group overflows, which no window frame can
    say; one pass of an aggregate over each key's ordered sizes can.
    """
    ordered = rows.withColumn("_at", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).withColumn("_s", size.cast("long"))
    sizes = ordered.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("_at", "_s"))), lambda r: r["_s"]).alias("_sizes"))
    start = F.struct(F.array().cast("array<int>").alias("groups"), F.lit(0).alias("group"), F.lit(0).cast("long").alias("total"))

    def add(state: Column, n: Column) -> Column:
        full = (state["total"] > 0) & (state["total"] + n > limit)
        group = F.when(full, state["group"] + 1).otherwise(state["group"])
        return F.struct(F.concat(state["groups"], F.array(group)).alias("groups"), group.alias("group"), F.when(full, n).otherwise(state["total"] + n).alias("total"))

    grouped = sizes.select(*keys, F.posexplode(F.aggregate("_sizes", start, add, lambda s: s["groups"])).alias("_p", name)).withColumn("_at", F.col("_p") + 1).drop("_p")
    return ordered.join(grouped, [*keys, "_at"]).drop("_at", "_s")


def tranches(groups: DataFrame, cap: int = 20_000) -> pd.DataFrame:
    """group, tranche of groups (group, n) in order of name: ceil(total / cap) tranches of about equal share, no group split.

    A row a group reaches the driver, in chunks; the boundary goes to the side that is closer to the share.
    """
    rows = [(r["group"], r["n"]) for r in groups.orderBy("group").toLocalIterator()]
    total = sum(n for _, n in rows)
    count = max(1, -(-total // cap))
    share, out, held, number = total / count, [], 0, 1
    for group, n in rows:
        if held and number < count and (held + n > cap or abs(held + n - share) > abs(held - share)):
            number, held = number + 1, 0
        held += n
        out.append((group, number))
    return pd.DataFrame(out, columns=["group", "tranche"])


def stream_rows(df: DataFrame) -> Iterator:
    """Rows to the driver a partition at a time."""
    return df.toLocalIterator()
