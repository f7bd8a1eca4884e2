"""Main text of web pages, with site templates removed.

Every element subtree of a page is hashed, menus, footers and adverts as well;
Spark counts on how many different pages of a host a subtree occurs, and those
that recur on many are deleted.  Where a subtree occurs on too few pages to tell,
what names itself a menu, footer, advert, comment and so on is left out by its
element or its class, unless the article stands in it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import ascii_lower, stage_table, with_row_key

#: a subtree is template on so many different pages of a host that are a tenth of them, or on fewer that are at least half of them
MANY_PAGES, FEW_PAGES = 5, 3
PART = 10
#: of a subtree on one page: it can be the article's own text, and is template only on half of the pages; it holds most of the text;
#: it names itself a menu, footer, advert …, and FEW_PAGES are enough to tell
_STRICT, _MOST, _NAMED_SO = 1, 2, 4

_TOKEN = re.compile(
    r"""[^<]+
      | <!--.*?(?:-->|\Z)
      | <(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?>[^>"']+|"[^"]*"|'[^']*')*+)>
      | <[a-zA-Z/!?][^>]*(?:>|\Z)
      | <""", re.S | re.X)
_ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
#: elements that are never part of the text
_LEFT_OUT = frozenset("head script style noscript template textarea title xmp iframe noembed noframes object svg canvas audio "
                      "video button select map".split())
#: elements that are not, unless the article stands in them
_AROUND = frozenset("nav footer aside form dialog menu".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp "
                    "small span strike strong sub sup time tt u var wbr".split())
#: blocks that are text of an article wherever they recur
_PROSE = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd blockquote pre td th tr tbody thead caption figcaption".split())
_FRAME = frozenset("html body article main".split())
#: a start tag closes the open elements of the first set, up to the nearest of the second
_RULES = [({"p"}, {"td", "th", "button", "table", "li"}), ({"li"}, {"ul", "ol", "menu"}), ({"dt", "dd"}, {"dl"}),
          ({"tr", "td", "th"}, {"table"}), ({"td", "th"}, {"tr", "table"}), ({"option"}, {"select"}), ({"head"}, {"html"})]
_RULE_OF = ({t: 0 for t in "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main "
             "nav ol p pre section table ul".split()} | {"li": 1, "dt": 2, "dd": 2, "tr": 3, "td": 4, "th": 4, "option": 5, "body": 6})
#: by tag and rule: 1 where the element is one to close, -1 where it stops the search, 0 elsewhere
_REACH = {t: tuple(1 if t in ends else -1 if t in stops else 0 for ends, stops in _RULES) for t in {t for e, s in _RULES for t in e | s}}
_WORDS = ("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice "
          "notices notification notifications alert popup modal overlay newsletter subscribe subscription signup paywall nav navbar "
          "navigation menu breadcrumb breadcrumbs sidebar footer masthead topbar comment comments commentlist disqus respond replies "
          "related recommended recommendations share sharing social pagination pager skip login search toolbar copyright")
_AFFIX = r"(?:site|page|main|global|top|bottom|left|right|primary|secondary|user|reader|blog|post|article|header|cookie|google|sticky|nav)"
_ENDS = (r"(?:box|bar|wrap|wrapper|container|area|block|section|list|widget|unit|slot|banner|notice|form|links?|thread|item|content|panel|"
         r"menu|nav|top|bottom|left|right|inner|outer|main|\d+)")
#: words of the list that a part of an article may be named by
_KEPT_IN_ARTICLE = frozenset("related recommended recommendations".split())
_NAMED = re.compile(rf"(?:{_AFFIX}[-_]+)*(?:{'|'.join(_WORDS.split())})(?:[-_]*{_ENDS})*\Z")
_NAMED_INSIDE = re.compile(rf"(?:{_AFFIX}[-_]+)*(?:{'|'.join(w for w in _WORDS.split() if w not in _KEPT_IN_ARTICLE)})(?:[-_]*{_ENDS})*\Z")
_HEADER = re.compile(rf"(?:{_AFFIX}[-_]+)*header(?:[-_]*{_ENDS})*\Z")
_COMMENT = re.compile(rf"(?:{_AFFIX}[-_]+)*comments?(?:[-_]*{_ENDS})*\Z")
_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())


#: why an element is left out: not at all, by its name unless the article stands in it, as readers' comments, in any case
_IN, _BY_NAME, _COMMENTS, _NEVER = range(4)
_NO_RULE = (-1,) * len(_RULES)


class _Node:
    """An open element; ``block`` is the innermost element around that is no inline one, ``ident`` its subtree's number."""

    __slots__ = ("tag", "out", "comments", "article", "main", "hash", "ident", "block", "reach")

    def __init__(self, tag, out=False, comments=False, article=False, main=False, block=None, reach=_NO_RULE):
        self.tag, self.out, self.comments, self.article, self.main = tag, out, comments, article, main
        self.hash, self.ident, self.block, self.reach = None, -1, block or self, reach


def _names(attrs: dict[str, str]) -> list[str]:
    return (attrs.get("class", "") + " " + attrs.get("id", "")).lower().split()


def _left_out(tag: str, attrs: dict[str, str], article: bool) -> int:
    if tag in _LEFT_OUT:
        return _NEVER
    if "hidden" in attrs or attrs.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", attrs.get("style", "")):
        return _NEVER
    names = _names(attrs) if attrs else []
    if any(_COMMENT.match(n) for n in names) and not (article and tag in _PROSE):
        return _COMMENTS
    if tag in _AROUND or tag == "header" and not article:
        return _BY_NAME
    if not attrs or tag in _FRAME or tag == "header" or attrs.get("role") == "main" or article and tag in _PROSE:
        return _IN
    pattern = _NAMED_INSIDE if article else _NAMED
    return _BY_NAME if attrs.get("role") in _ROLES or any(pattern.match(n) or not article and _HEADER.match(n) for n in names) else _IN


class Page:
    """Blocks of text of one page, and the hashes of the element subtrees they lie in.

    Subtrees are numbered in the order they open, so a parent's number is under
    its children's; time and memory grow with the html, however deep it is.
    """

    def __init__(self, html: str, decode: bool = True):
        self._decode = unescape if decode else str
        self.blocks: list[tuple[str, int, bool, bool]] = []  # text, innermost subtree, in article, in main
        self.parent: list[int] = []
        self.hashes: list[int] = []
        self.named: list[bool] = []      # left out by its name
        self.forms: list[int] = []
        self._counts: list[bool] = []    # may be a template
        self._strict: list[bool] = []
        self._text: list[str] = []
        self._stack = [_Node("")]
        self._stack[0].hash = xxhash.xxh3_64()
        self._open_named: list[int] = []
        self._open_tags: dict[str, int] = {}
        self._read(html)
        self._keep_a_page_in_a_form()

    def _flush(self) -> None:
        if self._text:
            text = " ".join("".join(self._text).split())
            self._text = []
            if text:
                own = self._stack[-1].block
                self.blocks.append((text, own.ident, own.article, own.main))
                own.hash.update(text.encode("utf-8", "surrogatepass") + b"\n")

    def _open(self, tag: str, attrs: dict[str, str]) -> None:
        top = self._stack[-1]
        self._open_tags[tag] = self._open_tags.get(tag, 0) + 1
        reach = top.reach
        if tag in _REACH:
            here = len(self._stack)
            reach = tuple([r if not c else here if c > 0 else -1 for c, r in zip(_REACH[tag], reach)])
        if top.out:
            self._stack.append(_Node(tag, out=True, block=top.block, reach=reach))
            return
        why = _left_out(tag, attrs, top.article)
        if tag in _INLINE:
            self._stack.append(_Node(tag, why == _NEVER, top.comments, top.article, top.main, top.block, reach))
            return
        self._flush()
        comments = top.comments or why == _COMMENTS
        article = tag == "article" and not top.article and not comments and why == _IN
        main = (tag == "main" or attrs.get("role") == "main") and not comments and why == _IN
        if tag == "article" and not article:  # an article within one is a comment or a teaser
            why = max(why, _BY_NAME)
        if article or main:
            for i in self._open_named:  # what holds the article is left out by no name
                self.named[i] = False
            self._open_named.clear()
        own = _Node(tag, why == _NEVER, comments, top.article or article, top.main or main, None, reach)
        inside = own.article or own.main
        own.hash, own.ident = xxhash.xxh3_64(tag + " named" * (why in (_BY_NAME, _COMMENTS))), len(self.hashes)
        self.parent.append(top.block.ident)
        self.hashes.append(0)
        self.named.append(why in (_BY_NAME, _COMMENTS))
        self._counts.append(why != _NEVER and tag not in _FRAME and not (inside and tag in _PROSE))
        self._strict.append(inside or tag in _PROSE)
        if why == _BY_NAME and tag != "article":
            self._open_named.append(own.ident)
            if tag == "form":
                self.forms.append(own.ident)
        self._stack.append(own)

    def _close(self) -> None:
        own = self._stack[-1]
        if own.block is own:
            self._flush()
        self._stack.pop()
        self._open_tags[own.tag] -= 1
        if own.hash is not None:
            self.hashes[own.ident] = own.hash.intdigest()
            self._stack[-1].block.hash.update(own.hash.digest())
            if self._open_named and self._open_named[-1] == own.ident:
                self._open_named.pop()

    def _close_implied(self, tag: str) -> None:
        rule = _RULE_OF.get(tag)
        while rule is not None and (k := self._stack[-1].reach[rule]) > 0:
            while len(self._stack) > k:
                self._close()
            if tag != "tr":
                return

    def _end(self, tag: str) -> None:
        if self._open_tags.get(tag):
            for k in range(len(self._stack) - 1, 0, -1):
                name = self._stack[k].tag
                if name == tag:
                    while len(self._stack) > k:
                        self._close()
                    return
                if tag in _INLINE and name not in _INLINE:  # a stray inline end tag closes no block
                    return
        elif tag not in _INLINE:
            self._flush()

    def _read(self, html: str) -> None:
        at, n, match = 0, len(html), _TOKEN.match
        while at < n:
            m = match(html, at)
            at = m.end()
            tag = m["tag"]
            if tag is None:
                piece = m[0]
                if (piece[0] != "<" or piece == "<") and not self._stack[-1].out:
                    self._text.append(self._decode(piece) if "&" in piece else piece)
                continue
            tag = tag.lower()
            if m["end"]:
                if tag == "br":
                    self._text.append(" ")
                else:
                    self._end(tag)
                continue
            if tag == "br":
                self._text.append(" ")
                continue
            self._close_implied(tag)
            if tag in _VOID:
                if tag == "hr":
                    self._flush()
                continue
            attrs = {}
            if (given := m["attrs"]) and not self._stack[-1].out:
                attrs = {a[0].lower(): unescape(a[1] or a[2] or a[3]) for a in _ATTR.findall(given)}
            if tag in _RAW:
                end = re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*>?", re.I).search(html, at)
                at = end.end() if end else n
                continue
            self._open(tag, attrs)
        while len(self._stack) > 1:
            self._close()
        self._flush()

    def _up(self, own: list[int]) -> list[int]:
        """Amounts of subtrees with those inside them added."""
        for i in range(len(own) - 1, -1, -1):
            if self.parent[i] >= 0:
                own[self.parent[i]] += own[i]
        return own

    def _down(self, cut: list[bool]) -> list[bool]:
        """Marks of subtrees carried to all that is inside them."""
        for i, p in enumerate(self.parent):
            if p >= 0 and cut[p]:
                cut[i] = True
        return cut

    def _sizes(self, blocks) -> list[int]:
        own = [0] * len(self.hashes)
        for b in blocks:
            if b[1] >= 0:
                own[b[1]] += len(b[0])
        return self._up(own)

    def _keep_a_page_in_a_form(self) -> None:
        """A form that holds more than half of a page without article is the page, not a part of it."""
        if self.forms and not any(b[2] or b[3] for b in self.blocks):
            sizes, total = self._sizes(self.blocks), sum(len(b[0]) for b in self.blocks)
            for i in self.forms:
                if 2 * sizes[i] > total:
                    self.named[i] = False

    def said(self) -> list[tuple[str, int, bool, bool]]:
        """The blocks that nothing leaves out by its name."""
        out = self._down(list(self.named))
        return [b for b in self.blocks if b[1] < 0 or not out[b[1]]]

    def _chosen(self, blocks):
        """The article's blocks, else main's, else all."""
        for k in (2, 3):
            if any(b[k] for b in blocks):
                return [b for b in blocks if b[k]]
        return blocks

    def text(self, template: frozenset[int] | set[int] = frozenset()) -> str:
        """The article's blocks (else main's, else all) without the subtrees whose hash is in ``template``."""
        blocks = self._chosen(self.said())
        if template:
            cut = self._down([c and h in template for c, h in zip(self._counts, self.hashes)])
            blocks = [b for b in blocks if b[1] < 0 or not cut[b[1]]]
        return "\n\n".join(b[0] for b in blocks)

    def subtrees(self) -> dict[int, int]:
        """Hashes of the subtrees that hold text, each with its marks ``_STRICT``, ``_MOST`` and ``_NAMED_SO``.

        What lies inside a subtree that is left out by its name is counted with it.
        """
        chosen = self._chosen(self.said())
        own, holds = self._sizes(chosen), self._sizes(self.blocks)
        total = sum(len(b[0]) for b in chosen)
        inside = self._down([self.parent[i] >= 0 and self.named[self.parent[i]] for i in range(len(self.parent))])
        found: dict[int, int] = {}
        for i, h in enumerate(self.hashes):
            if holds[i] and self._counts[i] and not inside[i]:
                found[h] = (found.get(h, 0) | _STRICT * self._strict[i] | _MOST * (2 * own[i] > total)
                            | _NAMED_SO * self.named[i])
        return found


def _signed(h: int) -> int:
    return h - (1 << 64) if h >= 1 << 63 else h


def _hash_pages(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in frames:
        own, kinds, marks = [], [], []
        for html in pdf["html"]:
            page = Page(html or "", decode=False)
            found = sorted(page.subtrees().items())
            own.append([_signed(h) for h, _ in found])
            kinds.append([kind for _, kind in found])
            marks.append(_signed(xxhash.xxh3_64_intdigest("\n".join(b[0] for b in page.said()).encode("utf-8", "surrogatepass"))))
        yield pd.DataFrame({"rid": pdf["rid"], "host": pdf["host"], "mark": marks, "hashes": own, "kinds": kinds})


def _clean(htmls: pd.Series, cuts: pd.Series) -> pd.Series:
    return pd.Series([Page(html).text(set() if cut is None else {int(h) % (1 << 64) for h in cut}) if html else ""
                      for html, cut in zip(htmls, cuts)], dtype=object)


def _host(url):
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def templates(pages: DataFrame, many: int = MANY_PAGES, few: int = FEW_PAGES) -> DataFrame:
    """(rid, cut): for each row (rid, host, html) with template subtrees, their hashes.

    Pages of a host with the same text count as one.  A page tells nothing of a
    subtree that holds most of its text: that is the text itself, if other pages
    are near-copies.  What can be a part of the text, in an article or as a
    paragraph, is template on at least half of the host's pages alone; what names
    itself a menu, footer or advert on ``few`` pages.
    """
    hashed = stage_table(pages.mapInPandas(_hash_pages, "rid string, host string, mark long, hashes array<long>, kinds array<int>"), "subtrees")
    each = hashed.select("host", "mark", F.explode(F.arrays_zip("hashes", "kinds")).alias("x")).groupBy(
        "host", "mark", F.col("x.hashes").alias("h")).agg(F.bit_or("x.kinds").alias("kind"))
    each = each.groupBy("host", "h").agg(F.count_if(F.col("kind").bitwiseAND(_MOST) == 0).alias("n"),
                                         F.max(F.col("kind").bitwiseAND(_STRICT)).alias("strict"),
                                         F.min(F.col("kind").bitwiseAND(_NAMED_SO)).alias("named"))
    size = hashed.select("host", "mark").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    wide = (F.col("n") >= many) & (PART * F.col("n") >= F.col("pages")) & (F.col("strict") == 0)
    common = each.filter(F.col("n") >= few).join(size, "host").filter(
        wide | (2 * F.col("n") >= F.col("pages")) | (F.col("named") > 0)).select("host", "h")
    found = hashed.select("rid", "host", F.explode("hashes").alias("h")).join(common, ["host", "h"])
    return stage_table(found.groupBy("rid").agg(F.collect_list("h").alias("cut")), "cut")  # of one page


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of ``pages``: page_id, url, text, n_chars.

    The text is the article's (else the main element's, else the body's)
    blocks without menus, headers, footers, sidebars, notices, adverts, forms,
    scripts, styles, comments of readers and site templates.  Character
    references are decoded, white space in a block is one space, blocks are
    joined by two line feeds.  Null and empty html give an empty text; markup may
    be cut off, unclosed or of any length; pages of null urls count as of one
    host; repeated rows and pages of equal text count once as evidence of a
    template; no pages give no rows.
    """
    keyed = with_row_key(pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html")), "rid")
    cut = templates(keyed.select("rid", _host(F.col("url")).alias("host"), "html"))
    # the list of pages with templates is joined as its measured size allows; pages keep their place
    rows = keyed.join(cut, "rid", "left")
    clean = F.pandas_udf(_clean, "string")
    return rows.select("page_id", "url", clean("html", "cut").alias("text")).withColumn(
        "n_chars", F.char_length("text").cast("long"))

