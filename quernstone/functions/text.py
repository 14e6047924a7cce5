"""Text functions as column expressions: normal forms, keys, cuts and guards."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters that a quote is compared without.
QUOTE_MARKS = "['‘’ʼʻ\"“”„‟‚‛]"
BULLETS = "[•●○◦∙·▪◆■□-]"


def or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def norm_ws(c: Column) -> Column:
    """White space collapsed, ends trimmed, lower case."""
    return F.trim(F.regexp_replace(F.lower(c), r"\s+", " "))


def norm_quote(c: Column) -> Column:
    """The form in which quotes and pages are compared: no quote marks or bullets, dashes alike, no blanks around punctuation, split plurals repaired."""
    c = F.regexp_replace(F.regexp_replace(c, QUOTE_MARKS, ""), BULLETS, "")
    c = F.regexp_replace(c, r"\s*[-–—]\s*", "-")
    c = F.regexp_replace(c, r"\s*([/&+.,:;()])\s*", "$1")
    return F.regexp_replace(norm_ws(c), r"\b([a-z]{4,})\s+(s)(?=\s|[.,;:?!)\]}])", "$1$2")


def quote_fragments(c: Column) -> Column:
    """A quote's parts between ellipses, without punctuation at their ends; empty parts go."""
    parts = F.split(c, r"\s*\.{3,}\s*|\s*…\s*")
    trimmed = F.transform(parts, lambda p: F.regexp_replace(F.regexp_replace(F.trim(p), r"""^[\s(\[{"‘“]+""", ""), r"""[\s.,;:!?)\]}"’”]+$""", ""))
    return F.filter(trimmed, lambda p: p != "")


def fragments_in_order(text: Column, fragments: Column) -> Column:
    """Whether every fragment stands in the text, each after the one before."""
    end = F.aggregate(
        fragments,
        F.lit(1),
        lambda at, f: F.when(at == 0, 0).otherwise(F.when(F.call_function("locate", f, text, at) > 0, F.call_function("locate", f, text, at) + F.length(f)).otherwise(0)),
    )
    return end > 0


def digit_blob(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def digit_density(c: Column) -> Column:
    """Digits per character of the text with white space collapsed; null for an empty one."""
    return F.length(digit_blob(c)) / F.nullif(F.length(F.trim(F.regexp_replace(c, r"\s+", " "))), F.lit(0))


def words_of_length(c: Column, least: int = 3) -> Column:
    """How many runs of at least `least` ASCII letters."""
    return F.size(F.filter(F.split(F.lower(c), "[^a-z]+"), lambda w: F.length(w) >= least))


def trim_words(c: Column, n: int) -> Column:
    """At most n characters, cut at a blank, with an ellipsis where something was cut."""
    t = F.trim(or_empty(c))
    head = F.substring(t, 1, n)
    cut = F.when(F.instr(head, " ") > 0, F.regexp_extract(head, r"(?s)^(.*) ", 1)).otherwise(head)
    return F.when(F.length(t) <= n, t).otherwise(F.concat(cut, F.lit("…")))


def anchor_slug(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def clean_filename(c: Column, cap: int = 80) -> Column:
    """Characters that file systems refuse become blanks, runs of blanks one, at most `cap` characters."""
    t = F.trim(F.regexp_replace(F.regexp_replace(c, r'[\\/:*?"<>|\x00-\x1f]+', " "), r"\s+", " "))
    return F.regexp_replace(F.substring(t, 1, cap), r"[ .]+$", "")


def md_cell(c: Column) -> Column:
    """A value inside a Markdown table: one line, bars escaped."""
    return F.trim(F.regexp_replace(F.replace(or_empty(c), F.lit("|"), F.lit("\\|")), r"\s*[\r\n]+\s*", " "))


def formula_guard(c: Column) -> Column:
    """Text that a spreadsheet would run gets a leading apostrophe."""
    return F.when(c.rlike(r"^[=+\-@]"), F.concat(F.lit("'"), c)).otherwise(c)


def hyperlink(url: Column, label: Column) -> Column:
    doubled = [F.replace(or_empty(c), F.lit('"'), F.lit('""')) for c in (url, label)]
    return F.concat(F.lit('=HYPERLINK("'), doubled[0], F.lit('","'), doubled[1], F.lit('")'))


def tidy_case(c: Column) -> Column:
    """Sentence case for text that is over four fifths capitals, else a capital first letter; a missing last bracket is added."""
    t = F.trim(or_empty(c))
    letters = F.length(F.regexp_replace(t, r"[^\p{L}]", ""))
    capitals = F.length(F.regexp_replace(t, r"[^\p{Lu}]", ""))
    first = F.upper(F.substring(t, 1, 1))
    cased = F.when((letters > 0) & (capitals > 0.8 * letters), F.concat(first, F.lower(F.substr(t, F.lit(2))))).otherwise(F.concat(first, F.substr(t, F.lit(2))))
    opened, closed = (F.length(t) - F.length(F.replace(t, F.lit(b), F.lit(""))) for b in "()")
    return F.concat(cased, F.when(opened > closed, F.lit(")")).otherwise(F.lit("")))


def parse_date(c: Column) -> Column:
    """A date from the first ten characters, null where they are none."""
    return F.when(F.substring(c, 1, 10).rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_timestamp(F.substring(c, 1, 10), F.lit("yyyy-MM-dd"))).cast("date")


#: What one unit of a document is called, by how it is divided.
PAGINATION_NOUNS = {"pages": "page", "sections": "section", "sheets": "sheet", "slides": "slide"}


def cite_page(page: Column, pagination: Column) -> Column:
    named = F.create_map(*[F.lit(x) for kv in PAGINATION_NOUNS.items() for x in kv])[or_empty(pagination)]
    return F.when(page.isNull(), "").otherwise(F.concat_ws(" ", named, page.cast("string")))


def coerce_page(c: Column) -> Column:
    """The first number in a page mark such as "[PAGE 7]"."""
    return F.regexp_extract(c, r"(\d+)", 1).try_cast("int")


def nul_strip(c: Column) -> Column:
    return F.translate(c, "\x00", "")


def council_words(c: Column) -> Column:
    """CamelCase to words, a phone note and a council suffix dropped, hyphens and case folded."""
    c = F.regexp_replace(F.replace(c, F.lit("&"), F.lit("and")), r"\s*\(Phone:[^)]*\)\s*$", "")
    c = F.regexp_replace(F.trim(c), r"\s+(?:Borough\s+|City\s+|County\s+|District\s+)?Council$", "")
    return F.trim(F.lower(F.regexp_replace(F.regexp_replace(c, "(?<=[a-z])(?=[A-Z])", " "), r"[-\s]+", " ")))


def url_host(c: Column) -> Column:
    return F.lower(F.try_parse_url(c, F.lit("HOST")))


#: The character references that plain text needs; `&amp;` last.
ENTITIES = {"&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&copy;": "©", "&middot;": "·", "&amp;": "&"}


def strip_html(c: Column) -> Column:
    """Text of a page: scripts and styles dropped, tags to blanks, references decoded, white space collapsed."""
    c = F.regexp_replace(c, r"(?is)<(script|style)\b.*?</\1\s*>", " ")
    c = F.regexp_replace(c, r"(?s)<[^>]+>", " ")
    for name, char in ENTITIES.items():
        c = F.replace(c, F.lit(name), F.lit(char))
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def strip_xml(c: Column) -> Column:
    """Text of a document part, a line for each paragraph, list item or table row."""
    c = F.regexp_replace(c, r"</(?:w:p|text:p|text:h|a:p|text:list-item|table:table-row|w:tr)>", "\n")
    c = F.regexp_replace(c, "<[^>]+>", "")
    for name, char in ENTITIES.items():
        c = F.replace(c, F.lit(name), F.lit(char))
    return c


def quote_key(c: Column, words: int = 12) -> Column:
    """Lower case, letters and digits only, the first words: what two readers' quotes are compared on."""
    t = F.trim(F.regexp_replace(F.regexp_replace(F.lower(or_empty(c)), "[^a-z0-9 ]+", " "), " +", " "))
    return F.array_join(F.slice(F.split(t, " "), 1, words), " ")


def finding_key(doc: Column, number: Column, unit: Column, quote: Column) -> Column:
    """struct(doc, number, unit, quote) by which two readers' findings are one: figure and unit where there is a figure, else the quote."""
    from quernstone.functions.numbers import sig4

    figured = number.isNotNull()
    return F.struct(doc.alias("doc"), sig4(number).alias("number"), F.when(figured, F.lower(F.trim(or_empty(unit)))).alias("unit"), F.when(~figured, quote_key(quote)).alias("quote"))


def value_in_text(text: Column, number: Column, unit: Column) -> Column:
    """Whether number and unit stand in the text, with or without a blank between."""
    whole = F.when(number == F.floor(number), number.cast("long").cast("string")).otherwise(number.cast("string"))
    unit = F.lower(or_empty(unit))
    t = norm_ws(text)
    return F.contains(t, F.concat(whole, unit)) | F.contains(t, F.concat(whole, F.lit(" "), unit))


def jaccard(a: Column, b: Column) -> Column:
    """Shared over all distinct members; two empty sets are alike, one empty set is unlike."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / union)


def keyword_hits(c: Column, keywords: list[str]) -> Column:
    """The keywords that stand in the text, sorted."""
    t = F.lower(or_empty(c))
    return F.array_sort(F.filter(F.array(*map(F.lit, sorted(set(keywords)))), lambda k: F.contains(t, F.lower(k))))


def candidate_refs(c: Column) -> Column:
    """Slash-joined reference tokens with three digits in a row in some segment, each once, in order."""
    tokens = F.regexp_extract_all(or_empty(c), F.lit(r"([A-Za-z][A-Za-z0-9_-]*(?:/[A-Za-z0-9_-]+)+|\d+(?:/[A-Za-z0-9_-]+)+)"), F.lit(1))
    return F.array_distinct(F.filter(tokens, lambda t: t.rlike(r"\d{3}")))


def full_ref(child: Column, candidate: Column) -> Column:
    """The candidate behind the child's own prefix, unless it has that already."""
    prefix = F.when(F.contains(child, F.lit("/")), F.split_part(child, F.lit("/"), F.lit(1)))
    return F.when(prefix.isNull() | F.startswith(candidate, F.concat(prefix, F.lit("/"))), candidate).otherwise(F.concat(prefix, F.lit("/"), candidate))


def authority_key(c: Column) -> Column:
    """An authority's name without brackets and the words that all of them share."""
    #: Words dropped, and short names with their long ones.
    words = "london borough of|royal borough of|borough|city|county|district|metropolitan|council|the|of"
    short = {"bucks": "buckinghamshire", "herts": "hertfordshire", "notts": "nottinghamshire", "wilts": "wiltshire"}
    key = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.lower(c), r"\(.*", ""), rf"\b(?:{words})\b", " "), "[^a-z0-9]", "")
    return F.coalesce(F.create_map(*[F.lit(x) for kv in short.items() for x in kv])[key], key)


def same_authority(a: Column, b: Column) -> Column:
    """Equal keys, or the shorter, of five characters at least, begins the longer; an unknown side is no objection."""
    a, b = or_empty(authority_key(a)), or_empty(authority_key(b))
    starts = F.when(F.length(a) <= F.length(b), F.startswith(b, a)).otherwise(F.startswith(a, b))
    return (a == "") | (b == "") | (a == b) | ((F.least(F.length(a), F.length(b)) >= 5) & starts)


def portal_family(url: Column) -> Column:
    """The product behind a portal's address; the first rule that fits decides."""
    u = F.lower(url)
    #: Marks of each product, in order of precedence.
    rules = [
        ("idox", ["online-applications", "applicationdetails.do"]),
        ("ocella", ["/ocellaweb/planningdetails"]),
        ("agile", ["agileapplications.co.uk"]),
        ("ni_planning", ["planningsystemni.gov.uk"]),
        ("arcus", ["planningregister.", "/planning/display/"]),
        ("nec", ["/assure/"]),
        ("northgate", ["stddetails.aspx", "/northgate/planningexplorer/", "/necsws/planningexplorer/"]),
        ("salesforce", ["/s/detail/", "/s/papplication/", "/s/planning-application/"]),
        ("nec", ["lpassure", "necsws"]),
    ]
    out = F.when(or_empty(url) == "", "no_url")
    for name, marks in rules:
        any_mark = F.lit(False)
        for mark in marks:
            any_mark = any_mark | F.contains(u, F.lit(mark))
        out = out.when(any_mark, name)
    return out.otherwise("bespoke/other")
