"""Main text of web pages, with site templates removed.

1. Every page is parsed once. All of its element subtrees that hold text, menus, footers and adverts included, are hashed (tag, class and
   text). What is never shown as text (scripts, styles, media and the like) is left out.
2. Spark counts for each host and hash on how many different pages the subtree stands. Pages with the same remaining text count once, so
   copies of an article do not make its text a template.
3. Subtrees that stand on ``min_pages`` pages and ``min_share`` of the host's different pages are a template of that host; pages lose the blocks
   inside them, wherever they are. Within a marked article only boxes (not headings, paragraphs, list items or quotes) can be templates: a sentence
   that many articles share is text.
4. What recurs too seldom to be a template (a menu or an advert that changes from page to page, a host with few pages) goes by marks: the
   tag, role, class or id of menus, footers, forms, adverts, comments and the like, and all outside of a marked article or main part.

Parsed pages are a written table of texts and hashes, so neither html nor the parser is met twice. Templates of a host are few: each takes up
``min_share`` of its pages. They are joined to the pages by host, and Spark broadcasts them only if their table is small.

Defined cases: NULL and empty html give an empty text; a NULL url has an empty host and shares templates with such pages; a page without
any markup is one block; white space alone is no block; elements nested deeper than 200 belong to the one above; a broken declaration is a comment up
to the next ``>``; repeated rows are extracted alike and count as one page; extra columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from html.parser import HTMLParser

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_pulse.llm.common import small, written

# --- fixed values of HTML ---
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form
    h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul""".split())
_PROSE = frozenset("h1 h2 h3 h4 h5 h6 p li dt dd blockquote pre".split())
_NEVER = frozenset("""script style noscript template head title nav footer aside form button select option textarea input label dialog menu iframe
    object embed canvas svg math audio video""".split())
#: elements whose content is never shown as text
_SILENT = frozenset("script style noscript template head title select option textarea iframe object embed canvas svg math audio video".split())
#: an end of these is implied by the start of the elements listed
_CLOSED_BY = {"p": _BLOCK, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot"}, "td": {"td", "th", "tr"},
              "th": {"td", "th", "tr"}, "option": {"option"}}
_SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "option": {"select"}}
_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog".split())
#: words of class and id names that mark what is no article (fixed values of this operator)
_NAMES = frozenset("""ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar side nav navbar navigation menu
    breadcrumb breadcrumbs footer masthead cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login
    share sharing social related recommended recommendations comment comments commentlist disqus respond reply replies widget toolbar pagination pager""".split())
#: compound names of the same meaning, which count as a whole
_COMPOUNDS = frozenset("""ad-box ad-banner ad-slot ad-unit ad-container ad-wrapper advert-box cookie-notice cookie-banner cookie-bar cookie-consent side-bar
    nav-bar nav-menu nav-links post-navigation site-footer page-footer article-footer entry-footer post-footer share-buttons share-bar share-links share-tools
    social-share social-sharing social-links social-buttons social-media related-posts related-articles related-links related-stories related-content
    comment-list comments-list comment-section comments-section comments-area comment-form newsletter-signup newsletter-box newsletter-form signup-form
    subscribe-box subscribe-form login-form""".split())
#: names that a heading's anchor may also have: as the id of a part of an article they say nothing
_ANCHORS = frozenset("""ad side notice notices alert share sharing social related recommended recommendations promotion consent subscription subscribe menu
    advertising advertisement sponsor sponsored login signup reply replies respond navigation newsletter cookie cookies banner overlay toolbar comment""".split())
_WORD = re.compile(r"[a-z]+")
_JOINT = re.compile(r"[_-]+")
_SPACE = re.compile(r"\s+")


#: elements nested deeper count as text of the one above, as browsers do from some depth on
_DEPTH = 200


class _Node:
    __slots__ = ("tag", "name", "skip", "left", "parts")

    def __init__(self, tag: str, name: str, skip: bool, left: bool = False):
        #: ``skip``: marked as no article; ``left``: that, or inside such an element
        self.tag, self.name, self.skip, self.left, self.parts = tag, name, skip, skip or left, []


def _named(tag: str, classes: str, ident: str, inside: bool) -> bool:
    """Whether class or id mark what is no article.

    Names count as a whole; single words of a class count only outside of a marked part, and not for headings and prose, which no id marks.
    """
    tokens = {_JOINT.sub("-", c).strip("-") for c in classes.split()}
    if not (tokens.isdisjoint(_NAMES) and tokens.isdisjoint(_COMPOUNDS)):
        return True
    if tag in _PROSE:
        return False
    ident = _JOINT.sub("-", ident.strip()).strip("-")
    if ident in _COMPOUNDS or ident in _NAMES and not (inside and ident in _ANCHORS):
        return True
    return not inside and not _NAMES.isdisjoint(_WORD.findall(classes))


class _Tree(HTMLParser):
    """Element tree of a page as browsers would mend it, as far as text blocks need it."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = _Node("#root", "", False)
        self.open = [self.root]
        self.title: list[str] = []
        #: tags opened below the greatest depth, whose text belongs to the element above
        self.flat: dict[str, int] = {}

    def _pop_to(self, tag: str, stop=frozenset()) -> None:
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag == tag:
                del self.open[k:]
                return
            if self.open[k].tag in stop:
                return

    def handle_starttag(self, tag, attrs):
        for old, by in _CLOSED_BY.items():
            if tag in by and any(n.tag == old for n in self.open):
                self._pop_to(old, _SCOPE.get(old, frozenset(("button", "td", "th", "li", "dd", "article", "section", "div", "main", "body"))))
        if tag in _VOID:
            if tag == "br":
                self.open[-1].parts.append(" ")
            elif tag == "hr":
                self.open[-1].parts.append(_Node(tag, "", False))
            return
        own = {k: v or "" for k, v in attrs}
        inside = any(n.tag in ("article", "main") for n in self.open)
        named = _named(tag, own.get("class", "").lower(), own.get("id", "").lower(), inside)
        skip = (tag in _NEVER or tag == "header" and not inside or own.get("role", "").lower() in _ROLES or "hidden" in own
                or own.get("aria-hidden", "").lower() == "true"
                or tag not in ("html", "body", "article", "main") and named
                or tag == "article" and named and inside)
        above = self.open[-1].left
        if len(self.open) >= _DEPTH and (above or not skip):
            self.flat[tag] = self.flat.get(tag, 0) + 1
            return
        node = _Node(tag, own.get("class", "").lower(), skip, above)
        self.open[-1].parts.append(node)
        self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self._pop_to(tag)

    def handle_endtag(self, tag):
        if tag == "br":
            self.open[-1].parts.append(" ")
        elif self.flat.get(tag):
            self.flat[tag] -= 1
        elif tag not in _VOID:
            self._pop_to(tag)

    def parse_marked_section(self, i, report=1):
        try:
            return super().parse_marked_section(i, report)
        except AssertionError:  # no known section: a comment up to the next >
            end = self.rawdata.find(">", i)
            return end + 1 if end >= 0 else len(self.rawdata)

    def handle_data(self, data):
        if self.open[-1].tag == "title":
            self.title.append(data)
        self.open[-1].parts.append(data)


def _main_parts(root: _Node) -> tuple[list[_Node], bool]:
    """The marked article elements that are in no other one, or else the main elements, or else the whole page."""
    def find(node, tag):
        for p in node.parts:
            if isinstance(p, _Node) and not p.skip:
                if p.tag == tag:
                    yield p
                else:
                    yield from find(p, tag)

    for tag in ("article", "main"):
        got = list(find(root, tag))
        if got:
            return got, True
    return [root], False


@dataclass(frozen=True)
class Page:
    """Blocks and element subtrees of a page, in page order; an element comes before those inside it."""

    title: str
    #: text of each block; None for those that a mark leaves out
    texts: list[str | None]
    #: number of the innermost element of each block
    at: list[int]
    #: number of the element around each element, -1 for the outermost
    up: list[int]
    #: hash of each element's subtree, None for those that cannot be a template
    hashes: list[int | None]

    def identity(self) -> int:
        """Hash of the text that the marks leave."""
        return _hash("\n".join(t for t in self.texts if t is not None))


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - 2**63


def parse(html: str | None) -> Page:
    """The blocks of a page and the hashes of all its subtrees that hold text."""
    if not html:
        return Page("", [], [], [], [])
    tree = _Tree()
    tree.feed(html)
    tree.close()
    parts, marked = _main_parts(tree.root)
    mains = {id(n) for n in parts}
    texts: list[str | None] = []
    at: list[int] = []
    up: list[int] = []
    hashes: list[int | None] = []

    def walk(node: _Node, above: int, out: bool, inside: bool) -> str:
        """Number a block element and all in it; its subtree as text ("" if there is none). ``out``: a mark leaves it out; ``inside``: in a main part."""
        me = len(up)
        up.append(above)
        hashes.append(None)
        main = id(node) in mains
        if main:
            out, inside = False, True
        seen: list[str] = []
        text: list[str] = []

        def flush():
            t = _SPACE.sub(" ", "".join(text)).strip()
            text.clear()
            if t:
                texts.append(None if out else t)
                at.append(me)
                seen.append(t)

        def run(n: _Node):
            for p in n.parts:
                if isinstance(p, str):
                    text.append(p)
                elif p.skip:
                    if p.tag in _BLOCK:
                        flush()
                    if p.tag not in _SILENT:
                        whole = walk(p, me, True, inside)
                        if node.left:
                            seen.append(whole)
                elif p.tag in _BLOCK or id(p) in mains:
                    flush()
                    seen.append(walk(p, me, out, inside))
                else:
                    run(p)

        run(node)
        flush()
        seen = [x for x in seen if x]
        if not seen:
            return ""
        whole = f"{node.tag}.{node.name}({'|'.join(seen)})"
        if above >= 0 and not main and not (marked and inside and not out and node.tag in _PROSE):
            hashes[me] = _hash(whole)
        return whole

    walk(tree.root, -1, marked, False)
    return Page(_SPACE.sub(" ", "".join(tree.title)).strip(), texts, at, up, hashes)


def blocks(html: str | None) -> tuple[str, list[tuple[str, list[int]]]]:
    """Title of a page and the blocks that marks leave: text, and hashes of the subtrees that hold it and could be templates."""
    page = parse(html)

    def around(k: int):
        while k >= 0:
            if page.hashes[k] is not None:
                yield page.hashes[k]
            k = page.up[k]

    return page.title, [(t, list(around(k))) for t, k in zip(page.texts, page.at, strict=True) if t is not None]


def _host(url_col: str):
    return F.lower(F.regexp_extract(F.coalesce(F.col(url_col).cast("string"), F.lit("")), r"^[^:/?#]*://([^/?#]*)", 1))


def parsed(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: ``id``, ``url``, ``host``, ``page`` (hash of the text that marks leave), and the arrays of ``Page``."""
    src = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), _host(url_col).alias("host"), F.col(html_col).cast("string").alias("html"))
    ints = pa.list_(pa.int32())

    def run(batches):
        for b in small(batches):
            found = [parse(html) for html in b.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), pa.array([p.identity() for p in found], pa.int64()), pa.array([p.texts for p in found], pa.list_(pa.string())),
                 pa.array([p.at for p in found], ints), pa.array([p.up for p in found], ints), pa.array([p.hashes for p in found], pa.list_(pa.int64()))],
                names=["id", "url", "host", "page", "texts", "at", "up", "hashes"])

    return src.mapInArrow(run, f"id {dict(src.dtypes)['id']}, url string, host string, page long, texts array<string>, at array<int>, up array<int>, hashes array<long>")


def templates(found: DataFrame, min_pages: int = 5, min_share: float = 0.1) -> DataFrame:
    """(host, template): the subtree hashes of each host that stand on many of its different pages; ``found``: rows of ``parsed``."""
    has_text = F.size("texts") > 0
    # one row without a hash counts the page itself
    each = F.explode(F.array_distinct(F.concat("hashes", F.array(F.lit(None).cast("long"))))).alias("hash")
    seen = found.filter(has_text).select("host", "page", each).distinct().groupBy("host", "hash").agg(F.count("*").alias("n"))
    seen = written(seen, "html-subtrees")
    # a table of its own: Spark knows its size, and broadcasts it as long as it is small, so that no host's hashes are dealt to one task
    total = written(seen.filter("hash IS NULL").select("host", F.col("n").alias("total")), "html-hosts")
    return (seen.filter(F.col("hash").isNotNull() & (F.col("n") >= min_pages)).join(total, "host").filter(F.col("n") >= min_share * F.col("total"))
            .groupBy("host").agg(F.collect_list("hash").alias("template")))


def _kept(texts: list[str | None], at: list[int], up: list[int], hashes: list[int | None], gone: set[int]) -> tuple[list[str], int, int]:
    """Blocks that stay, and the numbers of blocks that templates and that marks alone take."""
    if not gone:
        kept = [t for t in texts if t is not None]
        return kept, 0, len(texts) - len(kept)
    cut: list[bool] = []
    for k, h in enumerate(hashes):
        cut.append(h in gone or up[k] >= 0 and cut[up[k]])
    rest = [t for t, k in zip(texts, at, strict=True) if not cut[k]]
    kept = [t for t in rest if t is not None]
    return kept, len(texts) - len(rest), len(rest) - len(kept)


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_pages: int = 5, min_share: float = 0.1) -> DataFrame:
    """One row per input row: ``id_col``, ``url``, ``text`` (blocks joined by a line feed), ``n_chars`` (code points), and the numbers of
    blocks that went as part of a template (``n_template``) and by marks alone (``n_marked``)."""
    found = written(parsed(pages, id_col, url_col, html_col), "html-parsed")
    drop = written(templates(found, min_pages, min_share), "html-templates")

    def run(batches):
        for b in small(batches):
            texts, by_template, by_mark = [], [], []
            for *page, gone in zip(*(b.column(i).to_pylist() for i in range(2, 7)), strict=True):
                kept, cut, left = _kept(*page, set(gone or ()))
                texts.append("\n".join(kept))
                by_template.append(cut)
                by_mark.append(left)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64()),
                                              pa.array(by_template, pa.int32()), pa.array(by_mark, pa.int32())],
                                             names=["id", "url", "text", "n_chars", "n_template", "n_marked"])

    kind = dict(found.dtypes)["id"]
    return (found.join(drop, "host", "left").select("id", "url", "texts", "at", "up", "hashes", "template")
            .mapInArrow(run, f"id {kind}, url string, text string, n_chars long, n_template int, n_marked int").withColumnRenamed("id", id_col))
