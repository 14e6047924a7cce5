"""Main text of web pages, with each site's template removed.

For the site template, the subtrees of every page are hashed (tags and text) and the
different pages of each host that have a hash are counted in Spark, copies of a page
once; a subtree found on many pages of its host is deleted. Inside an article these are
blocks only, no list items, headings or table parts, and only where they are a small part
of it; an element that holds an article is never deleted as template. What a page has to
itself, and all of a host with too few pages, is left to rules: elements that are never
article text go by their tag, role, class or id, unless they hold the page's article or,
where there is none, most of its text. The article is what `article` or `main` holds,
else what is left of the body.

Parsing takes time in proportion to the page, whatever is in it. Elements nested deeper
than 512 become children of the one at that depth, as in browsers.

Defined cases: null html counts as empty (text empty); a null or odd url has the host
"" with the other such pages; unclosed and misnested tags close as browsers close them
for paragraphs, list items, table parts and options; repeated rows are all returned;
pages of any length are read whole; an empty table gives an empty result; other columns
are ignored, whatever their names.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernstone.operators import graph
from quernstone.operators.graph import checkpointed

#: A tag ends before the next `<` outside of quotes, so that one without an end costs no more than its length.
TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/<>]*+)((?:[^<>"']|"[^"]*"|'[^']*')*+)>""", re.S)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
DROPPED = frozenset("head script style noscript template svg canvas math iframe object applet embed audio video map nav header footer aside menu dialog form fieldset button select option datalist input textarea label title".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar toolbar dialog alertdialog alert status note tablist".split())
DROPPED_WORDS = frozenset(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar sidebars aside footer foot header masthead topbar toolbar banner ad ads adv advert adverts advertisement advertisements advertising adsense sponsor sponsored promo promotion "
    "cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login comment comments commentlist disqus reply replies respond discussion share sharing social related recommended recommendations "
    "pagination pager widget widgets search skip copyright disclaimer form hidden".split()
)
#: Class words that say where a part stands or that it is one; with a word above they make a token that drops, as in `sidebar-left` or `comment-list`.
PLACES = frozenset("left right top bottom site global primary secondary list area container wrapper box block section bar links buttons icons items posts articles".split())
#: What never holds an article, and what counts as no text of the page.
NEVER = frozenset("head script style noscript template svg canvas math iframe object applet embed audio video map select option datalist input textarea button label title".split())
UNCOUNTED = DROPPED - frozenset("header form fieldset".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small span strike strong sub sup time tt u var wbr ruby rt rp".split())
CLOSES_P = frozenset("address article aside blockquote center details dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
#: A start tag closes an open element of the second set, unless one of the third stands between.
IMPLIED = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "option": (frozenset(["option"]), frozenset(["select", "datalist"])),
    "tr": (frozenset(["tr", "td", "th"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "tbody": (frozenset(["thead", "tbody", "tr", "td", "th"]), frozenset(["table"])),
    "tfoot": (frozenset(["thead", "tbody", "tr", "td", "th"]), frozenset(["table"])),
}
#: No template inside an article: what can recur there with a meaning of its own.
PARTS = INLINE | frozenset("article main body li dt dd option tr td th thead tbody tfoot caption h1 h2 h3 h4 h5 h6 br hr img pre".split())
SCOPE = frozenset("article section div td th table body main li button".split())
ENDS_IN_SCOPE = INLINE | {"p"}
DEEPEST = 512
RAW_END = {tag: re.compile(rf"</{tag}\b[^<>]*>", re.I) for tag in RAW}


class Element:
    __slots__ = ("tag", "attrs", "children", "size", "kept", "holds", "hash", "parsed")

    def __init__(self, tag: str, attrs: str = ""):
        self.tag, self.attrs, self.size, self.kept, self.holds, self.hash, self.parsed = tag, attrs, 0, False, False, None, None
        self.children: list[Element | str] = []

    def attributes(self) -> dict[str, str]:
        if self.parsed is None:
            self.parsed = {m[0].lower(): html.unescape(m[1] or m[2] or m[3]) for m in ATTRIBUTE.findall(self.attrs)} if self.attrs.strip(" /") else {}
        return self.parsed

    def is_main(self) -> bool:
        return self.tag == "main" or "main" in self.attrs and self.attributes().get("role") == "main"

    def dropped(self, in_article: bool) -> bool:
        if self.kept:
            return False
        if self.tag in DROPPED and not (self.tag == "header" and in_article):
            return True
        if not self.attrs or self.tag in ("html", "body"):
            return False
        a = self.attributes()
        if "hidden" in a or a.get("aria-hidden") == "true" or a.get("role", "").lower() in DROPPED_ROLES:
            return True
        if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", a.get("style", "")):
            return True
        if self.tag in ("article", "main"):
            return any(w in ("comment", "comments", "reply") for words in _tokens(a) for w in words)
        return any(not words.isdisjoint(DROPPED_WORDS) and words <= DROPPED_WORDS | PLACES for words in _tokens(a))


def _tokens(attributes: dict[str, str]) -> Iterator[set[str]]:
    """The words of each class and of the id; a token drops only if all of it says so (`cookie-notice`, not `has-sidebar`)."""
    for name in ("class", "id"):
        for token in attributes.get(name, "").split():
            yield set(re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", token).lower()))


def parse(page: str) -> Element:
    root = Element("#root")
    stack = [root]
    places: dict[str, list[int]] = defaultdict(list)  # of the open elements with a tag, in the stack
    scopes: list[int] = [0]  # places of elements that end a search for an inline element
    flat: dict[str, int] = defaultdict(int)  # elements too deep to be opened, by tag

    def cut(place: int) -> None:
        while len(stack) > place:
            tag = stack.pop().tag
            places[tag].pop()
            if tag in SCOPE:
                scopes.pop()

    def last(names: frozenset[str]) -> int:
        return max((places[n][-1] for n in names if places.get(n)), default=0)

    def close(names: frozenset[str], wall: int) -> None:
        place = last(names)
        if place > wall:
            cut(place)

    at, end = 0, len(page)
    while at < end:
        m = TOKEN.search(page, at)
        if m is None:
            stack[-1].children.append(page[at:])
            break
        if m.start() > at:
            stack[-1].children.append(page[at : m.start()])
        at = m.end()
        tag = m[2]
        if not tag:
            continue
        tag = tag.lower()
        if m[1]:
            if flat[tag]:
                flat[tag] -= 1
            elif places.get(tag) and not (tag in ENDS_IN_SCOPE and scopes[-1] > places[tag][-1]):
                cut(places[tag][-1])
            continue
        if tag in CLOSES_P:
            close(frozenset(["p"]), scopes[-1])
        if tag in IMPLIED:
            names, walls = IMPLIED[tag]
            for _ in names:
                close(names, last(walls))
        element = Element(tag, m[3])
        stack[-1].children.append(element)
        if tag in RAW:
            stop = RAW_END[tag].search(page, at)
            element.children.append(page[at : stop.start() if stop else end])
            at = stop.end() if stop else end
        elif tag not in VOID and not m[3].endswith("/"):
            if len(stack) > DEEPEST:
                flat[tag] += 1
                continue
            places[tag].append(len(stack))
            if tag in SCOPE:
                scopes.append(len(stack))
            stack.append(element)
    return root


def subtree_hashes(element: Element, found: list[Element], in_article: bool = False) -> int:
    """Hash of tags and text of a subtree; those that can be template and have text are added to `found`."""
    digest = xxhash.xxh64(element.tag)
    has_text = False
    article = in_article or element.tag in ("article", "main")
    for child in element.children:
        if isinstance(child, str):
            text = " ".join(html.unescape(child).split())
            if text:
                digest.update("\x01" + text)
                has_text = True
        else:
            inner = subtree_hashes(child, found, article)
            element.holds |= child.holds or child.tag in ("article", "main")
            if inner:
                digest.update(inner.to_bytes(8, "little"))
                has_text = True
    if not has_text:
        return 0
    value = digest.intdigest() or 1
    if element.tag not in (PARTS if article else ("#root", "html", "body", "head")) and not element.holds:
        element.hash = value - (1 << 63)
        found.append(element)
    return value


def _recurring(element: Element, template: frozenset[int]) -> list[Element]:
    """The outermost template subtrees below an element."""
    out = []
    for child in element.children:
        if not isinstance(child, str):
            out += [child] if child.hash in template else _recurring(child, template)
    return out


def _blocks(element: Element, out: list[list[str]], in_article: bool) -> None:
    """Text by blocks: what is inline stays in the block that is open."""
    inline = element.tag in INLINE
    if not inline:
        out.append([])
    for child in element.children:
        if isinstance(child, str):
            out[-1].append(html.unescape(child))
        elif child.tag == "br":
            out[-1].append(" ")
        elif not child.dropped(in_article):
            if child.tag == "header":
                _headings(child, out)
            else:
                _blocks(child, out, in_article)
    if not inline:
        out.append([])


def _headings(element: Element, out: list[list[str]]) -> None:
    """Of an article's own header, its headings."""
    for child in element.children:
        if not isinstance(child, str) and not child.dropped(True):
            if re.fullmatch("h[1-6]", child.tag):
                _blocks(child, out, True)
            else:
                _headings(child, out)


def _articles(element: Element, names: frozenset[str]) -> list[Element]:
    out = []
    for child in element.children:
        if not isinstance(child, str) and not child.dropped(False):
            if child.tag in names or child.attrs and "main" in names and child.attributes().get("role") == "main":
                out.append(child)
            else:
                out += _articles(child, names)
    return out


def _measure(element: Element) -> int:
    """Sets how much text each element has, without what is no text of the page by its tag."""
    size = 0
    for child in element.children:
        size += len(" ".join(child.split())) if isinstance(child, str) else _measure(child)
    element.size = 0 if element.tag in UNCOUNTED else size
    return element.size


def _candidates(element: Element, lost: tuple[Element, ...], found: list[tuple[Element, tuple[Element, ...]]]) -> None:
    """Every article and main with the elements around it that would be dropped."""
    for child in element.children:
        if isinstance(child, str) or child.tag in NEVER:
            continue
        gone = child.dropped(False)
        if child.tag == "article" or child.is_main():
            if not gone or child.tag not in ("article", "main"):
                found.append((child, (*lost, child) if gone else lost))
            elif gone:
                continue
        _candidates(child, (*lost, child) if gone else lost, found)


def _left(element: Element, most: int, large: list[Element]) -> int:
    """How much text stays outside of what is dropped; elements dropped with over `most` are listed."""
    left = 0
    for child in element.children:
        if isinstance(child, str):
            left += len(" ".join(child.split()))
        elif not child.dropped(False):
            left += _left(child, most, large)
        elif child.size > most:
            large.append(child)
            _left(child, most, large)
    return left


def _keep_article(root: Element) -> None:
    """What would be dropped with the page's article in it is kept: its main, or an article with more text than is left elsewhere.

    A page without either keeps what has over half of its text. Comments and teasers can be
    articles too, so a smaller one does not keep what is around it.
    """
    total = _measure(root)
    found: list[tuple[Element, tuple[Element, ...]]] = []
    _candidates(root, (), found)
    large: list[Element] = []
    if not found:
        _left(root, total // 2, large)
        for element in large:
            element.kept = True
        return
    main = [f for f in found if f[0].is_main()]
    article, lost = max(main or found, key=lambda f: f[0].size)
    if lost:
        free = [f[0].size for f in found if not f[1]]
        if main or article.size > (max(free) if free else _left(root, total, large)):
            for element in lost:
                element.kept = True


def _delete_template(element: Element, template: frozenset[int], small: float) -> None:
    """Deletes the template outside of articles, and in each article where it has at most `small` of the text."""
    for child in element.children:
        if isinstance(child, str):
            continue
        if child.tag in ("article", "main"):
            recurring = _recurring(child, template)
            if sum(e.size for e in recurring) <= small * child.size:
                for e in recurring:
                    e.children = []
        elif child.hash in template:
            child.children = []
        else:
            _delete_template(child, template, small)


def main_text(page: str, template: frozenset[int] = frozenset(), small: float = 0.2) -> str:
    root = parse(page)
    if template:
        subtree_hashes(root, [])
        _measure(root)
        _delete_template(root, template, small)
    _keep_article(root)
    main = _articles(root, frozenset(["article"])) or _articles(root, frozenset(["main"]))
    out: list[list[str]] = []
    for element in main or [root]:
        _blocks(element, out, bool(main))
    return " ".join(t for t in (" ".join("".join(b).split()) for b in out) if t)


HASH_DDL = "host string, page long, hashes array<long>"
HASHES = pa.schema([("host", pa.string()), ("page", pa.int64()), ("hashes", pa.list_(pa.int64()))])
TEXT_DDL = "page_id long, url string, text string, n_chars long"
TEXTS = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


def _hashed(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in stream:
        pages, hashes = [], []
        for page in batch["html"].to_pylist():
            found: list[Element] = []
            pages.append(subtree_hashes(parse(page), found) - (1 << 63))
            hashes.append(sorted({e.hash for e in found}))
        yield pa.RecordBatch.from_arrays([batch["host"], pa.array(pages, pa.int64()), pa.array(hashes, pa.list_(pa.int64()))], schema=HASHES)


def site_templates(pages: DataFrame, share: float = 0.2, least: int = 5) -> DataFrame:
    """host, template: the subtrees on at least `share` of a host's different pages and on `least` of them.

    Pages with equal trees are one. Counts are summed before the shuffle, and a host with
    many of them hears its number of pages by broadcast. As every hash has `share` of the
    pages, a host has at most 1/share times as many as a page has subtrees.
    """
    trees = checkpointed(pages.select("host", "html").mapInArrow(_hashed, HASH_DDL).groupBy("host", "page").agg(F.min("hashes").alias("hashes")))
    counts = trees.select("host", F.explode("hashes").alias("hash")).groupBy("host", "hash").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    counts = checkpointed(counts)
    totals = trees.groupBy("host").agg(F.count("*").alias("value")).withColumnRenamed("host", "node")
    often = graph.looked_up(counts, "host", totals, graph.heavy_keys(counts, "host", counts.count())).where(F.col("n") >= share * F.col("value"))
    return often.groupBy("host").agg(F.collect_set("hash").alias("template"))


def _extracted(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in stream:
        texts = []
        for page, template in zip(batch["html"].to_pylist(), batch["template"].to_pylist(), strict=True):
            texts.append(main_text(page, frozenset(template or ())))
        yield pa.RecordBatch.from_arrays([batch["page_id"], batch["url"], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], schema=TEXTS)


def extract_pages(pages: DataFrame, share: float = 0.2, least: int = 5, broadcast_bytes: int = 32 << 20) -> DataFrame:
    """page_id, url, text, n_chars of every page.

    Two passes over the pages. Templates are short lists of hashes: up to `broadcast_bytes`
    in all they go to the pages, which then never move; beyond that pages are dealt by host,
    those of a host with many pages over many tasks.
    """
    host = F.coalesce(F.lower(F.regexp_extract(F.col("url").cast("string"), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"), host.alias("host"))
    templates = checkpointed(site_templates(rows, share, least))
    size = templates.agg(F.sum(F.octet_length("host") + 8 * F.size("template") + 64)).first()[0] or 0
    if size <= broadcast_bytes:
        joined = rows.join(F.broadcast(templates), "host", "left")
    else:
        heavy = graph.heavy_keys(rows, "host", rows.count())
        joined = graph.looked_up(rows, "host", templates.select(F.col("host").alias("node"), F.col("template").alias("value")), heavy).withColumnRenamed("value", "template")
    return joined.select("page_id", "url", "html", "template").mapInArrow(_extracted, TEXT_DDL)
