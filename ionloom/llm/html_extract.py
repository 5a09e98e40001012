"""Main text of web pages: site template removal beside plain rules.

Every page's block-level elements are hashed, each from its tag, its text and the hashes of what it holds. Spark counts for
each host on how many different pages a subtree recurs; those on at least ``min_pages`` are candidates. Copies of one
article on pages that differ elsewhere are no template, so a candidate is one only where its pages differ in what they are
about: a page's LONGEST longest text blocks (of its article, where one is marked) stand for it, and in at least half of
these places no single text holds more than half of the candidate's pages. Templates are deleted on every page of the
host, and a page that holds nothing else has an empty text.

Beside that, a page that marks its article (article, main or role=main) gives the text inside it; the article itself and
its headings, paragraphs, lists' and tables' cells aren't judged as templates, its other elements are. By rule go, on any
page: scripts, styles, forms and what HTML's tags, roles or whole class names and ids call menus, page headers, footers,
sidebars, notices, adverts and reader comments. Ids don't judge headings and text elements in an article. No class or id
drops an element around the page's main, nor one around its only articles if these hold more text than the rest.
Character references are decoded, white space inside a block becomes one space, blocks are trimmed and joined by \\n.

A host needs ``min_pages`` different pages before anything can recur on so many; on smaller hosts the rules alone decide.
A null or empty page has an empty text; broken markup is read as far as it goes: a tag that never ends is text, and a
quote that doesn't close doesn't hide the tag's end. Work grows with the length of a page, whatever it holds. Rows are
told apart by host and content, so repeated rows get the same text each; a null url is a host of its own. No rows give no
rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ionloom.llm.common import bounded_batches, chunks, materialize

# HTML's element kinds, and the words that name what is not the article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead title tr ul".split())
NEVER = frozenset("head title nav footer aside form script style noscript template iframe object svg math canvas audio video button select textarea dialog menu".split())
NEVER_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
NEVER_NAMES = frozenset("ad ads adsense advert adverts advertisement advertising sponsor sponsored promo menu nav navbar navigation breadcrumb breadcrumbs sidebar footer cookie cookies consent gdpr notice notices popup modal newsletter subscribe comment comments disqus respond share sharing social related".split())
# A name of theirs also comes before one of AFTER or behind one of BEFORE, as in share-bar and site-footer.
AFTER = frozenset("banner bar box buttons container form icons links list overlay posts signup slot thread widget widgets wrap wrapper".split())
BEFORE = frozenset("main page primary secondary site top".split())
# Words that say where or how a part is laid out; a name made of these and of at least one of NEVER_NAMES is one of theirs.
LAYOUT = AFTER | BEFORE | frozenset("area articles block bottom column google group header inner item items left outer panel post posts right row section".split())
WHOLE_NAMES = frozenset("adsbygoogle widget-area site-info".split())
TEXT_TAGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup p li dt dd blockquote pre table caption td th tr figure figcaption ol ul dl span a b i em strong".split())
HEAD_NAMES = frozenset("header masthead banner topbar".split())
# What an opening tag ends when it is still open, and where the search for it stops.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "thead": ("tr", "td", "th"), "tbody": ("thead", "tr", "td", "th"), "tfoot": ("tbody", "tr", "td", "th")}
FENCE = frozenset("html body article main section div aside nav header footer form table td th ul ol dl blockquote".split())

NAME = re.compile(r"[a-zA-Z][^\s/>]*")
MARK = re.compile("[>\"']")
ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
SPACES = re.compile(r"\s+")
MAIN_ROLE = re.compile(r"\brole\s*=\s*[\"']?main\b", re.I)
#: Text blocks that stand for what a page is about.
LONGEST = 4


class _Element:
    """An open or closed element; ``judged`` says whether its subtree may be a template."""

    __slots__ = ("tag", "parent", "number", "dropped", "main", "judged", "digest")

    def __init__(self, tag: str, parent: _Element | None, number: int, dropped: str, main: bool, judged: bool) -> None:
        self.tag, self.parent, self.number, self.dropped, self.main, self.judged = tag, parent, number, dropped, main, judged
        self.digest = hashlib.blake2b(tag.encode(), digest_size=8)


class _Scanner:
    """Finds a page's tags. A tag ends at the first > outside of quotes, or, if quotes would hide every one, at the first.
    Marks from which no end is reached are remembered, so that none is looked at twice in vain."""

    def __init__(self, page: str) -> None:
        self.page, self.last = page, page.rfind(">")
        self.last_of = {q: page.rfind(q) for q in "\"'"}
        self.vain: set[int] = set()

    def next(self, at: int) -> tuple[int, int, str, str, str] | None:
        """(begin, end, kind, name, attributes) of the next tag; kinds are "<", "</" and "!" for comments and declarations."""
        page = self.page
        while (at := page.find("<", at)) >= 0:
            if page.startswith("<!--", at):
                end = page.find("-->", at + 4)
                return at, len(page) if end < 0 else end + 3, "!", "", ""
            if at > self.last:
                return None
            if page.startswith(("<!", "<?"), at):
                return at, page.find(">", at) + 1, "!", "", ""
            kind = "</" if page.startswith("</", at) else "<"
            name = NAME.match(page, at + len(kind))
            if name:
                end = self._end(name.end())
                return at, end, kind, name[0].lower(), page[name.end() : end - 1]
            at += 1
        return None

    def _end(self, begin: int) -> int:
        page, end, seen = self.page, begin, []
        while (m := MARK.search(page, end)) and m.start() not in self.vain:
            end = m.end()
            if m[0] == ">":
                return end
            seen.append(m.start())
            if self.last_of[m[0]] >= end:  # else the quote never closes and hides nothing
                end = page.find(m[0], end) + 1
        self.vain.update(seen)
        end = page.find(">", begin)
        return len(page) if end < 0 else end + 1


def _names(token: str, names: frozenset[str]) -> bool:
    first, _, rest = token.replace("_", "-").partition("-")
    return token in names or first in names and rest in AFTER or first in BEFORE and rest in names


def _never(token: str) -> bool:
    if token in NEVER_NAMES or token in WHOLE_NAMES:
        return True
    parts = token.replace("_", "-").split("-")
    return any(p in NEVER_NAMES for p in parts) and all(p in NEVER_NAMES or p in LAYOUT for p in parts)


def _unwanted(tag: str, attributes: str, in_main: bool) -> str:
    """What drops the element: "rule", "name" (its class or id) or nothing."""
    if tag in NEVER or tag == "header" and not in_main:
        return "rule"
    if not attributes.strip():
        return ""
    named = ""
    for m in ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name == "role" and value in NEVER_ROLES or name == "hidden" or name == "aria-hidden" and value == "true":
            return "rule"
        if name == "class" or name == "id" and not (in_main and tag in TEXT_TAGS):
            if tag not in ("body", "html", "article", "main") and any(_never(t) or not in_main and _names(t, HEAD_NAMES) for t in value.split()):
                named = "name"
    return named


def blocks(page: str, gone: frozenset[int] = frozenset()) -> tuple[list[tuple[str, _Element | None]], bool, list[_Element]]:
    """What ``_blocks`` finds, with the names around the page's main or only articles ignored, and without the blocks in
    subtrees whose hash is in ``gone``."""
    found, marked, main, elements, around = _blocks(page)
    strong, weak = around
    if strong and not main:
        found, marked, _, elements, _ = _blocks(page, strong)
    elif weak and not marked:
        other = _blocks(page, weak)
        if sum(len(t) for t, _ in other[0]) > sum(len(t) for t, _ in found):
            found, marked, _, elements, _ = other
    if gone:
        dead: set[int] = set()
        for e in elements:  # in order of their beginnings, so parents come first
            if e.parent is not None and e.parent.number in dead or e.judged and digest(e) in gone:
                dead.add(e.number)
        found = [(t, e) for t, e in found if e is None or e.number not in dead]
    return found, marked, elements


def digest(e: _Element) -> int:
    """The hash of an element's subtree."""
    return int.from_bytes(e.digest.digest(), "little", signed=True)


def _blocks(page: str, spared: frozenset[int] = frozenset()) -> tuple[list[tuple[str, _Element | None]], bool, bool, list[_Element], tuple[frozenset[int], frozenset[int]]]:
    """(text blocks of the page with their innermost elements, whether an article is marked, whether by main or its role,
    all elements, the elements around a main and around articles that their names drop).

    With an article only its blocks come back.
    """
    found: list[tuple[str, _Element | None]] = []
    elements: list[_Element] = []
    stack: list[_Element] = []
    held: list[str] = []
    places: dict[str, list[int]] = {}  # of the open elements by tag, and of those that end a search
    fences: list[int] = []
    at, marked, by_main = 0, False, False
    strong: set[int] = set()
    weak: set[int] = set()
    scanner = _Scanner(page)

    def flush() -> None:
        text = SPACES.sub(" ", html.unescape("".join(held))).strip()
        held.clear()
        if text:
            found.append((text, stack[-1] if stack else None))

    def close(depth: int) -> None:
        while len(stack) > depth:
            if stack[-1].tag in BLOCK:
                flush()
            e = stack.pop()
            places[e.tag].pop()
            if e.tag in FENCE:
                fences.pop()
            if e.parent is not None:
                e.parent.digest.update(e.digest.digest())

    def last(tags: tuple[str, ...], fenced: bool = True) -> int:
        """The innermost open element of these tags, unless an element of FENCE lies inside it; else -1."""
        found = max((places[t][-1] for t in tags if places.get(t)), default=-1)
        return -1 if fenced and fences and fences[-1] > found else found

    def text(piece: str) -> None:
        if piece and not (stack and stack[-1].dropped):
            held.append(piece)
            if stack and not piece.isspace():
                stack[-1].digest.update(b"\0" + SPACES.sub(" ", piece).encode("utf-8", "replace"))

    while token := scanner.next(at):
        begin, end, kind, tag, attributes = token
        text(page[at:begin])
        at = end
        if kind == "!":
            continue
        if kind == "</":
            depth = last((tag,), False)
            if depth >= 0:
                close(depth)
            elif tag in BLOCK:
                flush()
            continue
        if tag == "br":
            text(" ")
        if tag in VOID:
            if tag in BLOCK:
                flush()
            continue
        if tag in BLOCK:
            flush()
            for ended in (("p",), ENDS.get(tag, ())):
                depth = last(ended) if ended else -1
                if depth >= 0:
                    close(depth)
        above = stack[-1] if stack else None
        in_main = above is not None and above.main
        number = len(elements) + 1
        own = _unwanted(tag, attributes, in_main)
        if own == "name" and number in spared:
            own = ""
        dropped = "rule" if "rule" in (own, above.dropped if above else "") else own or (above.dropped if above else "")
        is_main = tag == "main" or "role" in attributes and bool(MAIN_ROLE.search(attributes))
        if dropped == "name" and (is_main or tag == "article"):
            kept = strong if is_main else weak
            if own:
                kept.add(number)
            e = above
            while e is not None and e.number not in kept:  # those above one that is in are in as well
                if e.dropped:
                    kept.add(e.number)
                e = e.parent
        main = in_main or not dropped and (is_main or tag == "article")
        marked |= main
        by_main |= main and is_main
        if attributes.rstrip().endswith("/") and tag not in BLOCK and tag not in RAW:
            continue
        judged = not dropped and tag in BLOCK and tag not in ("html", "body") and not (main and (not in_main or tag in TEXT_TAGS))
        elements.append(_Element(tag, above, number, dropped, main, judged))
        places.setdefault(tag, []).append(len(stack))
        if tag in FENCE:
            fences.append(len(stack))
        stack.append(elements[-1])
        if tag in RAW:
            close_tag = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(page, at)
            at = page.find(">", close_tag.end()) + 1 if close_tag else 0
            at = at or len(page)
            close(len(stack) - 1)
    text(page[at:])
    close(0)
    flush()
    return [(t, e) for t, e in found if not marked or e is not None and e.main], marked, by_main, elements, (frozenset(strong), frozenset(weak))


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, page, subtrees, texts): a page's different subtrees and its LONGEST longest text blocks."""
    for batch in batches:
        for start, stop, pages in chunks(batch, "html"):
            subtrees, texts = [], []
            for page in pages:
                found, _, elements = blocks((page or b"").decode("utf-8", "replace"))
                subtrees.append(sorted({digest(e) for e in elements if e.judged}))
                longest = [_hash(t) for t in sorted({t for t, _ in found}, key=lambda t: (-len(t), t))[:LONGEST]] or [0]
                texts.append([longest[k % len(longest)] for k in range(LONGEST)])
            own = lambda c: batch.column(c).slice(start, stop - start)  # noqa: B023, E731
            yield pa.record_batch({"host": own("host"), "page": own("page"), "subtrees": pa.array(subtrees, pa.list_(pa.int64())), "texts": pa.array(texts, pa.list_(pa.int64()))})


def _text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        gone = batch.column("gone").to_pylist()
        for start, stop, pages in chunks(batch, "html"):
            texts = ["\n".join(t for t, _ in blocks((p or b"").decode("utf-8", "replace"), frozenset(gone[i] or ()))[0]) for i, p in enumerate(pages, start)]
            yield pa.record_batch({"page_id": batch.column("page_id").slice(start, stop - start), "url": batch.column("url").slice(start, stop - start), "text": pa.array(texts, pa.string())})


def templates(seen: DataFrame, min_pages: int) -> DataFrame:
    """(host, subtree) of those that recur on at least ``min_pages`` pages of their host which differ in their longest texts.

    ``seen`` has a row for each host, page and different subtree. All counts are summed map-side, so no host, however
    large, comes together in one task.
    """
    often = seen.groupBy(F.col("host").alias("h_"), F.col("subtree").alias("s_")).agg(F.count("*").alias("n")).where(F.col("n") >= min_pages)
    often = materialize(often, "html-often")
    some = seen.join(often, (seen["host"] == often["h_"]) & (seen["subtree"] == often["s_"])).select("host", "subtree", "n", F.posexplode("texts").alias("place", "text"))
    most = some.groupBy("host", "subtree", "n", "place", "text").agg(F.count("*").alias("c")).groupBy("host", "subtree", "n", "place").agg(F.max("c").alias("most"))
    varied = most.groupBy("host", "subtree").agg(F.count_if(2 * F.col("most") <= F.col("n")).alias("varied"))
    return materialize(varied.where(2 * F.col("varied") >= LONGEST).select("host", "subtree"), "html-templates")


def extract(df: DataFrame, min_pages: int = 5) -> DataFrame:
    """page_id, url, text (the main text, empty if none) and n_chars for every row (page_id, url, html) of ``df``."""
    bounded_batches(df.sparkSession)
    page = F.coalesce(F.col("html").cast("string"), F.lit(""))
    pages = df.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), page.alias("html"))
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^[a-zA-Z][-+.\w]*://(?:[^/@]*@)?([^/:?#]*)", 1)), F.lit(""))
    pages = pages.withColumn("host", F.xxhash64(host)).withColumn("page", F.xxhash64("host", "html"))  # a page is its host and its content
    parsed = pages.select("host", "page", "html").mapInArrow(_subtrees, "host long, page long, subtrees array<long>, texts array<long>")
    seen = materialize(parsed.distinct(), "html-subtrees").select("host", "page", "texts", F.explode("subtrees").alias("subtree"))
    site = templates(seen, min_pages).select(F.col("host").alias("h_"), F.col("subtree").alias("s_"))
    gone = seen.join(site, (seen["host"] == site["h_"]) & (seen["subtree"] == site["s_"])).groupBy(F.col("page").alias("of")).agg(F.collect_set("subtree").alias("gone"))
    gone = materialize(gone, "html-gone")
    rows = pages.join(gone, pages["page"] == gone["of"], "left").select("page_id", "url", "html", "gone")
    return rows.mapInArrow(_text, "page_id long, url string, text string").withColumn("n_chars", F.char_length("text").cast("long"))
