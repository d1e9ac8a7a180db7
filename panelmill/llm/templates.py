"""Main text of web pages, without what a site repeats on its pages."""

from __future__ import annotations

import html as entities
import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelmill.llm.common import BROADCAST_ROWS
from panelmill.session import stage

# In a tag, quotes bind only behind an equals sign: an apostrophe in a value without quotes is a letter.
TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<![^>]*(?:>|$)|<\?[^>]*(?:>|$)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]|=\s*(?:\"[^\"]*\"|'[^']*')?)*)(?:>|$)",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
NAME_PART = re.compile(r"[a-z0-9]+")

# Element names of HTML and customary names of page furniture.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes plaintext noscript".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav "
    "ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
DROPPED = frozenset(
    "nav footer aside form script style noscript template iframe svg math button select textarea "
    "input object embed canvas audio video dialog menu head title link meta map xmp noembed noframes".split()
)
DROPPED_NAMES = frozenset(
    "nav navbar navigation menu submenu footer sidebar ad ads advert adverts advertisement advertising banner sponsor "
    "sponsored promo cookie cookies notice notices consent gdpr popup modal overlay newsletter subscribe "
    "subscription share sharing social comment comments disqus respond breadcrumb breadcrumbs related "
    "widget login signup toolbar skip alert pagination pager masthead".split()
)
COMMENT_NAMES = frozenset("comment comments disqus respond".split())
# Elements that hold text rather than other blocks.
TEXT_LEVEL = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dt dd td th caption figcaption span em strong b i a".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar".split())
# Elements that an opening tag of the key ends, and those beyond which it ends nothing.
CLOSES = {
    "li": (frozenset(("li",)), frozenset(("ul", "ol", "menu"))),
    "dt": (frozenset(("dt", "dd")), frozenset(("dl",))),
    "dd": (frozenset(("dt", "dd")), frozenset(("dl",))),
    "tr": (frozenset(("tr", "td", "th")), frozenset(("table",))),
    "td": (frozenset(("td", "th")), frozenset(("tr", "table"))),
    "th": (frozenset(("td", "th")), frozenset(("tr", "table"))),
    "option": (frozenset(("option",)), frozenset(("select",))),
}
INLINE_ENDS = frozenset(("a", "b", "i", "em", "strong", "span", "u", "s", "small", "sub", "sup", "font", "code", "tt", "big", "cite", "q", "abbr"))


class Element:
    __slots__ = ("name", "attrs", "children")

    def __init__(self, name: str, attrs: str = ""):
        self.name, self.attrs, self.children = name, attrs, []


def parse(source: str) -> Element:
    """A lenient tree of elements and texts; missing and stray end tags are tolerated."""
    root = Element("html")
    stack, at, size = [root], 0, len(source)
    while at < size:
        match = TOKEN.search(source, at)
        if match is None:
            stack[-1].children.append(entities.unescape(source[at:]))
            break
        if match.start() > at:
            stack[-1].children.append(entities.unescape(source[at : match.start()]))
        at = match.end()
        name = match[2]
        if not name:
            continue
        name = name.lower()
        if match[1]:
            close(stack, name)
            continue
        if name in BLOCK and name != "body":
            shut(stack, frozenset(("p",)), frozenset(("article", "section", "div", "td", "th", "li", "body", "blockquote")))
        if name in CLOSES:
            shut(stack, *CLOSES[name])
        if name in HEADINGS and stack[-1].name in HEADINGS:
            stack.pop()
        element = Element(name, match[3])
        stack[-1].children.append(element)
        if name in VOID or match[3].endswith("/") and name not in BLOCK and name not in RAW:
            continue
        if name in RAW:
            end = re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|$)", re.I).search(source, at)
            element.children.append(source[at : end.start() if end else size])
            at = end.end() if end else size
            continue
        stack.append(element)
    return root


def shut(stack: list[Element], names: frozenset, beyond: frozenset) -> None:
    """End the innermost open element of these names, unless one of ``beyond`` is nearer."""
    for n in range(len(stack) - 1, 0, -1):
        if stack[n].name in names:
            del stack[n:]
            return
        if stack[n].name in beyond:
            return


def close(stack: list[Element], name: str) -> None:
    """End the innermost open element of this name; inline ends stop at blocks."""
    for n in range(len(stack) - 1, 0, -1):
        if stack[n].name == name:
            del stack[n:]
            return
        if name in INLINE_ENDS and stack[n].name in BLOCK:
            return


def attributes(element: Element) -> dict[str, str]:
    return {m[1].lower(): entities.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(element.attrs)}


# How sure it is from its name that an element isn't part of the article.
NOT, PERHAPS, SURELY = range(3)


def furniture(element: Element, inside: bool) -> int:
    """What name, class, id or role say of an element.

    Sure are elements of their kind, hidden ones, roles, a customary name as it is, and comments.  A name
    that only begins or ends with a customary word, and any name on an element that holds text and not
    other blocks, is a hint: ``related-work`` may be a chapter, and ``notice`` a paragraph.
    """
    if element.name in DROPPED:
        return SURELY
    if not element.attrs.strip() or element.name in ("html", "body", "main"):
        return NOT
    attrs = attributes(element)
    if "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true" or attrs.get("role", "").lower() in DROPPED_ROLES:
        return SURELY
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attrs.get("style", "")):
        return SURELY
    names = f"{attrs.get('class', '')} {attrs.get('id', '')}".lower()
    parts = set(NAME_PART.findall(names))
    known = parts & DROPPED_NAMES or not inside and parts & {"header"}
    if not known:
        return NOT
    if element.name in TEXT_LEVEL:
        return PERHAPS
    return SURELY if known & COMMENT_NAMES or known & set(names.split()) else PERHAPS


def content_roots(root: Element) -> list[Element]:
    """The outermost article elements that aren't furniture, else those of main, else the page."""
    for wanted in (lambda e: e.name == "article", lambda e: e.name == "main" or 'role="main"' in e.attrs):
        found: list[Element] = []
        queue = [root]
        while queue:
            element = queue.pop()
            inner = [c for c in element.children if isinstance(c, Element) and furniture(c, False) != SURELY]
            if wanted(element):
                found.append(element)
            else:
                queue += reversed(inner)
        if found:
            return found
    return [root]


def squeeze(parts: list[str]) -> str:
    return " ".join("".join(parts).split())


def signed_hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "replace")) - (1 << 63)


class Block:
    """A block subtree: what it holds in order, and the words on the way, also those in links."""

    __slots__ = ("name", "up", "path", "holds", "words", "linked", "hint", "hash", "place", "gone")

    def __init__(self, name: str, up: int, path: str, hint: bool):
        self.name, self.up, self.path, self.hint = name, up, path, hint
        self.holds: list[str] = []
        self.words = self.linked = 0
        self.hash = self.place = 0
        self.gone = False

    def running(self) -> bool:
        """Whether it holds prose: some words, most of them outside links."""
        return self.words >= RUNNING and 2 * self.linked < self.words


RUNNING = 8


class Page:
    """The texts below the content roots of a page in order, and the block subtrees around them.

    One walk with a stack of its own, so that pages may be nested as deep as they like.  The hash of a
    subtree is made of its element's name and of what it holds, texts and hashes of inner blocks, and its
    place of the path of block elements as well; each is made once, from those of its children.
    """

    def __init__(self, source: str | None):
        self.blocks: list[Block] = []
        self.texts: list[tuple[int, str]] = []
        self.longest = (0, 0)
        for root in content_roots(parse(source)) if source else ():
            self.walk(root)

    def open(self, name: str, up: int, hint: bool) -> int:
        path = str(signed_hash(f"{self.blocks[up].path}/{name}")) if up >= 0 else ""
        self.blocks.append(Block(name, up, path, hint))
        return len(self.blocks) - 1

    def close(self, at: int) -> None:
        block = self.blocks[at]
        if block.hint and not block.running():
            block.gone = True
        elif block.holds:
            content = "\x01".join(block.holds)
            block.hash = signed_hash(f"{block.name}\x00{content}")
            block.place = signed_hash(f"{block.path}\x00{content}")
            if block.up >= 0:
                outer = self.blocks[block.up]
                outer.holds.append(f"\x02{block.hash}")
                outer.words += block.words
                outer.linked += block.linked

    def walk(self, root: Element) -> None:
        line: list[str] = []

        def flush(at: int) -> None:
            if text := squeeze(line):
                self.texts.append((at, text))
                self.blocks[at].holds.append(text)
                self.longest = max(self.longest, (len(text), signed_hash(text)))
            line.clear()

        # What is open: element, next child, block around it, whether the element is that block, links, header.
        first = self.open(root.name, -1, False)
        stack = [[root, 0, first, True, 0, False]]
        while stack:
            frame = stack[-1]
            element, at, block, own, links, header = frame
            if at == len(element.children):
                stack.pop()
                if own:
                    flush(block)
                    self.close(block)
                continue
            frame[1] += 1
            child = element.children[at]
            if isinstance(child, str):
                if not header:
                    line.append(child)
                    found = len(child.split())
                    self.blocks[block].words += found
                    self.blocks[block].linked += found if links else 0
                continue
            if child.name in ("br", "img", "wbr"):
                line.append(" " if child.name == "br" else "")
                continue
            sure = furniture(child, True)
            if sure == SURELY:
                if child.name in BLOCK:
                    flush(block)
                continue
            if child.name not in BLOCK and sure == NOT:
                stack.append([child, 0, block, False, links + (child.name == "a"), header])
                continue
            # A block, or an inline element whose name is a hint and that therefore stands for itself.
            flush(block)
            inner = self.open(child.name, block, sure == PERHAPS)
            # Of a header inside the article, only the headings belong to it.
            stack.append([child, 0, inner, True, links, child.name == "header" or header and child.name not in HEADINGS])

    def kept(self, goes) -> list[str]:
        """The texts without those in a block that is gone or for which ``goes`` holds."""
        out: list[bool] = []
        for block in self.blocks:
            out.append(block.gone or block.up >= 0 and out[block.up] or bool(block.hash) and goes(block.hash, block.place, block.hint))
        return [text for at, text in self.texts if not out[at]]


def main_text(source: str | None, repeated: set[int], placed: set[int] = frozenset()) -> str:
    """Text blocks of the article in page order, joined by an empty line; without those repeated, or placed where they are."""
    return "\n\n".join(Page(source).kept(lambda h, place, hint: h in repeated or place in placed))


def host_of(url):
    """Host of an address in lower case; null for a null address."""
    return F.lower(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://)?(?:[^/?#@]*@)?([^/?#:]*)", 1))


def section_of(url):
    """First folder of an address's path; null without one."""
    return F.nullif(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://)?[^/?#]*/([^/?#]+)/", 1), F.lit(""))


def language_of(html):
    """Main language that the html element names, in lower case; empty without one."""
    return F.lower(F.coalesce(F.regexp_extract(html, r"(?i)<html\b[^>]*?\slang\s*=\s*[\"']?([A-Za-z]+)", 1), F.lit("")))


# Parts in which subtrees are counted: a host by what they are, by what and where they are, and those with a hint.
ANYWHERE, PLACED, HINTED = "anywhere", "", "hinted"


def templates(pages: DataFrame, share: float, least: int, fewest: int = 3, fewest_of_part: int = 10, fewest_hinted: int = 2) -> DataFrame:
    """(host, part, hash): subtrees that recur in a host or a part of it, its sections and languages.

    Votes are distinct articles, told apart by their longest text, so that copies of an article have one vote and
    never make a template of it.  A subtree is a template of a host if ``least`` articles have it and ``share`` of them;
    at one place, the path of block elements around it, also if ``fewest`` of a host or ``fewest_of_part`` of a part have it and
    half of the articles, of less than ten all but a fifth.  One whose name hints at furniture needs ``fewest_hinted``
    articles only.  Tasks count before they shuffle, so that a hot host sends one row per task, hash and article.
    """

    def batches(rows):
        votes: set = set()

        def flush():
            out = [pa.array([v[k] for v in votes], kind) for k, kind in enumerate((pa.string(), pa.string(), pa.int64(), pa.int64()))]
            votes.clear()
            return pa.RecordBatch.from_arrays(out, ["host", "part", "hash", "article"])

        for batch in rows:
            for host, section, language, html in zip(*[batch.column(k).to_pylist() for k in range(4)], strict=True):
                page = Page(html)
                found, article = [b for b in page.blocks if b.hash], page.longest[1]
                if not found:
                    continue
                parts = [PLACED, *([f"section {section}"] if section else ()), *([f"language {language}"] if language else ())]
                votes.update((host, part, h, article) for part in parts for h in (None, *{b.place for b in found}))
                votes.update((host, ANYWHERE, h, article) for h in (None, *{b.hash for b in found}))
                votes.update((host, HINTED, b.hash, article) for b in found if b.hint)
            if len(votes) > 200_000:
                yield flush()
        yield flush()

    rows = pages.where("host IS NOT NULL").select("host", "section", "language", "html")
    votes = rows.mapInArrow(batches, "host string, part string, hash long, article long").distinct()
    needed = F.when(F.col("part") == PLACED, fewest).when(F.col("part") == HINTED, fewest_hinted).when(F.col("part") == ANYWHERE, least).otherwise(fewest_of_part)
    counts = votes.groupBy("host", "part", "hash").agg(F.count("*").alias("n")).where((F.col("n") >= needed) | F.col("hash").isNull())
    counts = stage(counts, "votes")
    sizes = counts.where("hash IS NULL").select("host", "part", F.col("n").alias("articles"))
    found = counts.where("hash IS NOT NULL").join(sizes, ["host", "part"], "left")
    lacking = F.when(F.col("articles") >= 10, F.col("articles") / 2).otherwise(F.floor(F.col("articles") / 5))
    anywhere = (F.col("part") == ANYWHERE) & (F.col("n") >= share * F.col("articles"))
    placed = (F.col("part") != ANYWHERE) & (F.col("articles") - F.col("n") <= lacking)
    return found.where((F.col("part") == HINTED) | anywhere | placed).select("host", "part", "hash")


def extract(pages: DataFrame, share: float = 0.5, least: int = 10) -> DataFrame:
    """Per page: page_id, url, text and n_chars of its article.

    A page's content is its article elements, or main, or the whole body, without elements that
    are surely menu, header, footer, sidebar, notice, advert, form, comment, script or style by their
    kind, class, id or role.  Where a name is only a hint, an element with a few words or of links goes, one with prose
    stays unless it recurs.  Site templates go as well: subtrees of the content are hashed, counted
    once per distinct article of a host, and deleted where they recur (see ``templates``).
    A host has a bounded number of templates for each article's subtrees, so that they travel as one row per host, those
    of a section with the section.

    A page is parsed for its votes and again for its text: a table of all texts and hashes, kept in between, would take more
    disk than the pages do.  Templates are sent to the pages as long as they are few; beyond that pages
    and templates meet by host.  Null or empty html gives an empty text.  Pages with a null url lose no repeated
    subtrees.  Repeated rows are one article.  Character references are decoded, white space inside a
    block becomes one space, blocks are joined by an empty line.
    """
    columns = [host_of(F.col("url")).alias("host"), section_of(F.col("url")).alias("section"), language_of(F.col("html")).alias("language")]
    source = pages.select("page_id", "url", "html", *columns)
    found = stage(templates(source, share, least), "templates")
    few = found.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    wide = found.where("part NOT LIKE 'section %'").groupBy("host").agg(F.collect_list(F.struct("part", "hash")).alias("repeated"))
    sections = found.where("part LIKE 'section %'").groupBy("host", F.expr("substring(part, 9)").alias("section")).agg(F.collect_list("hash").alias("in_section"))

    def texts(rows):
        for batch in rows:
            out = []
            for html, language, repeated, section in zip(*[batch.column(k).to_pylist() for k in range(2, 6)], strict=True):
                by_part: dict[str, set[int]] = {}
                for r in repeated or ():
                    by_part.setdefault(r["part"], set()).add(r["hash"])
                anywhere, hinted = (by_part.get(p, set()) for p in (ANYWHERE, HINTED))
                placed = by_part.get(PLACED, set()) | by_part.get(f"language {language}", set()) | set(section or ())
                left = Page(html).kept(lambda h, place, hint: h in anywhere or place in placed or hint and h in hinted)
                out.append("\n\n".join(left).encode("utf-8", "replace").decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    kind = pages.schema["page_id"].dataType.simpleString()
    if few:  # as many rows at most as there are templates
        wide, sections = F.broadcast(wide), F.broadcast(sections)
    joined = source.join(wide, "host", "left").join(sections, ["host", "section"], "left")
    joined = joined.select("page_id", "url", "html", "language", "repeated", "in_section")
    return joined.mapInArrow(texts, f"page_id {kind}, url string, text string, n_chars long")
