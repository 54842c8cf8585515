"""Main text of web pages by the maximum-scoring run of words and tags.

A page is a row of tags and pieces of text. Each word and each tag has a weight; the run with the
greatest sum, found in one pass, is the content region. Weights are log-odds of lying inside the
content, counted on labelled pages: a bounded sample of the pages whose markup names its content
(`article` or `main`). They depend on the tag, on whether a word stands in a link, in running text or
in a part that is no content, and, on pages that name their content, on whether it lies there. What
stands in menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader
comments is never part of the text; a name says so only of an element that does not hold the content,
and a name that may as well be the subject of a section, such as "discussion", not of the most of an
article. On pages that name their content such parts weigh nothing, so a long advert parts no article,
nor does what stands between two articles side by side; on others they have their weight in the sum.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import log

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from skyfare.llm.common import bounded_sample, whole_text

LABELLED = 2000
_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|</(?P<close>[a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    r"|<(?P<open>[a-zA-Z][^\s/>]*)(?P<attributes>(?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*?)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.S)
_PARTS_OF_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")

# Fixed values of HTML
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span"
    " strike strong sub sup time tt u var wbr br td th label input select button".split()
)
_CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3"
    " h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul li dt dd".split()
)
_ITEM = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_HOLDS_ITEMS = frozenset("ul ol menu dl table select tbody thead tfoot".split())
_OTHER_TAGS = frozenset(
    "audio body caption col colgroup datalist head html legend map math meter object optgroup option output picture"
    " progress slot svg tbody template tfoot thead tr video".split()
)
_TAGS = _VOID | _RAW | _INLINE | _CLOSES_P | _HOLDS_ITEMS | _OTHER_TAGS | frozenset(_ITEM)
_SCOPE = frozenset("html body div article main section aside nav header footer form td th li blockquote table button".split())

# Parts of a page that are no content
_ASIDE = frozenset(
    "head script style noscript template nav footer aside form button select option textarea input label svg canvas"
    " object iframe dialog menu title xmp noembed noframes".split()
)
_ASIDE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner promo promotion sponsor sponsored cookie cookies"
    " consent gdpr notice alert popup modal overlay newsletter subscribe subscription signup sidebar menu nav navbar"
    " navigation breadcrumb breadcrumbs footer comment comments disqus reply replies respond share sharing social"
    " related recommended widget toolbar pagination pager search login hidden skip copyright disclaimer discussion"
    " discussions responses feedback paywall".split()
)
_ASIDE_ROLES = frozenset("navigation banner complementary contentinfo search dialog alert alertdialog form menu menubar".split())
_CONTENT_NAMES = frozenset("content main article post entry story".split())
_TOP_NAMES = frozenset("header masthead topbar".split())  # no content unless inside the content
# Names of other people's text, which may be the most of a page
_OTHERS = frozenset(
    "comment comments disqus reply replies respond discussion discussions responses feedback related recommended".split()
)
# Names that may as well be the subject of a section
_SUBJECTS = frozenset(
    "discussion discussions responses feedback related recommended social login sharing search notice alert promotion"
    " copyright disclaimer consent subscription navigation pagination".split()
)
# Names and tags inside such a section that show it to be what its name says
_NAMES_OF_USERS = frozenset(
    "comment comments disqus reply replies response author user username avatar commenter teaser card".split()
)
_CONTROLS = frozenset("form button input select textarea label article".split())
# What may follow such a name and still only says how the part is laid out; "alert-history" says more
_LAYOUT = frozenset(
    "add area article articles author background backdrop bar block body bottom box boxes btn button buttons card close"
    " col column container content count cta desktop dialog entries field fixed follow follows form global google grid"
    " group head heading hero holder icon icons image images info inline inner input item items label law leaderboard"
    " left link links list lists logo logos main mega media message meta mobile module network networks news next number"
    " numbers open outer page pages panel placeholder policy post posts prev previous primary products reading region"
    " register right row secondary section side site slot sponsor stack sticky stories strip tabs text thread this title"
    " toggle top topics unit videos wall widgets wrap wrapper zone".split()
)


@dataclass
class Piece:
    """A tag or a stretch of text, as the scan sees it."""

    feature: str  # what it is, apart from where the content is named
    count: int  # words, or 1 for a tag
    named: bool  # inside a part that the page names as its content
    block: int = -1  # of text that may be content
    text: str = ""
    aside: bool = False  # inside a part that is no content
    between: bool = False  # between two articles side by side


@dataclass
class _Open:
    tag: str
    aside: bool
    named: bool
    link: bool
    hard: bool = False  # no content whatever it holds, as its tag, role or hiding or those of a part around it say
    own: bool = False  # hard by itself
    soft: bool = False  # no content, as a name says
    at: int = 0
    cut: str = ""  # the word of its class or id for which it may be no content
    words: int = 0  # of running text inside
    main: bool = False  # it holds a part of this name
    article: bool = False
    root: _Open | None = None  # the article or main around it, or itself
    firm: bool = False  # no content by a name that can mean nothing else, its own or one around it
    item: bool = False  # in a list
    plain: int = 0  # words of running text inside, but for those in firm parts
    other: int = 0  # words in links and lists
    users: bool = False  # it holds controls, articles or names that show it to be other people's text

    def subject(self) -> bool:
        """Whether its name is the subject of a section, which is most of an article and written like one."""
        if self.cut not in _SUBJECTS or self.root is None or self.root is self:
            return False
        return 2 * self.plain > self.root.plain and not self.users and 2 * self.other <= self.plain


@dataclass
class Page:
    pieces: list[Piece] = field(default_factory=list)
    names_content: bool = False


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(text)}


def _of_users(attributes: dict[str, str]) -> bool:
    names = attributes.get("class", "") + " " + attributes.get("id", "")
    return any(p.lower() in _NAMES_OF_USERS for p in _PARTS_OF_NAME.findall(names))


def _hidden(attributes: dict[str, str]) -> bool:
    """Whether role or hiding say that an element is no content."""
    if "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true":
        return True
    if "display:none" in attributes.get("style", "").replace(" ", "").lower():
        return True
    return attributes.get("role", "").lower() in _ASIDE_ROLES


def _aside_name(attributes: dict[str, str], inside: bool) -> str:
    """The word by which class or id say that an element is no content, or ""."""
    names = [*attributes.get("class", "").split(), *attributes.get("id", "").split()]
    if any(n.lower() in _CONTENT_NAMES for n in names):
        return ""
    banned = _ASIDE_NAMES if inside else _ASIDE_NAMES | _TOP_NAMES
    for name in names:
        parts = [p.lower() for p in _PARTS_OF_NAME.findall(name)]
        if not parts or parts[0] in ("has", "with", "no") or parts[-2:-1] == ["with"]:
            continue
        if parts[-1] in banned:
            return parts[-1]
        if parts[0] in banned and parts[0] != "hidden" and all(len(p) < 3 or p.isdigit() or p in banned or p in _LAYOUT for p in parts[1:]):
            return parts[0]
    return ""


def read_page(source: str) -> Page:
    """The tags and texts of a page in order, with what encloses them. Works on any text, broken markup too.

    A name of no content does not leave an element out that holds the page's `main`, or most of its
    running text and an article, or most of it where nothing else is named as content; nor does one that may
    be the subject of a section leave out the most of an article.
    """
    page, cut, words = _read(source, frozenset())
    kept = {
        o.at
        for o in cut
        if o.main or o.subject() or (o.cut not in _OTHERS and 2 * o.words > words and (o.article or not page.names_content))
    }
    return _read(source, frozenset(kept))[0] if kept else page


def _tag(tag: str) -> str:
    return f"tag {tag}" if tag in _TAGS else "tag other"


def _read(source: str, kept: frozenset[int]) -> tuple[Page, list[_Open], int]:
    """The page, the elements that a name may leave out, and the words of running text.

    Names do not count at the places `kept`.
    """
    page, stack, block, cut, words = Page(), [], 0, [], 0
    siblings: dict[int, list[int]] = {}  # by their parent: where the first of several articles starts, and the last
    top = _Open("", False, False, False)

    def add_text(raw: str) -> None:
        nonlocal words
        if not raw.strip():
            if raw and page.pieces and page.pieces[-1].text and page.pieces[-1].block == block:
                page.pieces[-1].text += " "
            return
        text = html.unescape(raw) if "&" in raw else raw
        where = "aside" if top.aside else "link" if top.link else "text"
        n = len(text.split())
        if not top.hard:
            if not top.link:
                top.words += n
                words += n
            if not top.firm:
                top.plain += 0 if top.link else n
                top.other += n if top.link or top.item else 0
        page.pieces.append(Piece(f"word {where}", n, top.named, -1 if top.aside else block, text, top.aside))

    def pop_to(depth: int) -> None:
        nonlocal top
        while len(stack) > depth:
            done = stack.pop()
            if done.cut:
                cut.append(done)
            if stack:
                stack[-1].words += done.words
                stack[-1].main |= done.main
                stack[-1].article |= done.article
                stack[-1].plain += done.plain
                stack[-1].other += done.other
                stack[-1].users |= done.users or done.tag in _CONTROLS
        top = stack[-1] if stack else _Open("", False, False, False)

    def close(tags: tuple[str, ...], stop: frozenset[str]) -> None:
        for depth in range(len(stack) - 1, -1, -1):
            if stack[depth].tag in tags:
                pop_to(depth)
                return
            if stack[depth].tag in stop:
                return

    at, end = 0, len(source)
    while at < end:
        m = _MARKUP.search(source, at)
        if m is None:
            add_text(source[at:])
            break
        if m.start() > at:
            add_text(source[at : m.start()])
        at = m.end()
        if m["open"]:
            tag = m["open"].lower()
            if tag in _CLOSES_P:
                close(("p",), _SCOPE)
            if tag in _ITEM:
                close(_ITEM[tag], _HOLDS_ITEMS)
            if tag not in _INLINE:
                block += 1
            if tag in _CONTROLS:
                top.users = True
            named = top.named or tag in ("article", "main")
            users, own, name, raw = False, tag in _ASIDE or (tag == "header" and not top.named), "", m["attributes"]
            hard = top.hard or own
            if tag in ("article", "main") and top.hard and all(not o.own or o.tag == "form" for o in stack):
                hard = False  # a form around the whole page
            if not hard and raw and tag not in ("html", "body", "main") and tag not in _VOID:
                attributes = _attributes(raw)
                own = hard = _hidden(attributes)
                users = top.root is not None and _of_users(attributes)
                name = "" if hard else _aside_name(attributes, top.named or tag == "article")
            soft = top.soft or (name != "" and m.start() not in kept)
            top.users |= users
            aside = hard or soft
            page.names_content |= named and not aside
            if tag == "article" and not top.named and not aside:
                siblings.setdefault(top.at, [len(page.pieces), 0])[1] = len(page.pieces)
            page.pieces.append(Piece(_tag(tag), 1, named and not aside, aside=aside))
            if tag in _RAW:
                finish = re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I).search(source, at)
                at = finish.start() if finish else end
                continue
            if tag not in _VOID and not raw.endswith("/"):
                around = top
                top = _Open(tag, aside, named and not aside, around.link or tag == "a", hard, own, soft, m.start(), name)
                top.root = top if tag in ("article", "main") else around.root
                top.firm = around.firm or (name != "" and name not in _SUBJECTS)
                top.item = around.item or tag in ("li", "dd")
                top.main, top.article = tag == "main" and not hard, tag == "article" and not hard and not name
                stack.append(top)
        elif m["close"]:
            tag = m["close"].lower()
            page.pieces.append(Piece(_tag(tag), 1, top.named, aside=top.aside))
            close((tag,), frozenset())
            if tag not in _INLINE:
                block += 1
        elif m[0].startswith("<![CDATA["):
            add_text(html.escape(m[0][9:].removesuffix("]]>"), quote=False))
        if m["open"] and m["open"].lower() in ("br", "td", "th") or m["close"] and m["close"].lower() in ("td", "th"):
            if page.pieces:
                page.pieces[-1].text, page.pieces[-1].block = " ", (-1 if top.aside else block)
    pop_to(0)
    edges: Counter = Counter()
    for first, last in siblings.values():
        edges[first] += 1
        edges[last] -= 1
    open_ranges = 0
    for i, piece in enumerate(page.pieces if siblings else ()):
        open_ranges += edges.get(i, 0)
        piece.between = open_ranges > 0 and not piece.named
    return page, cut, words


# --- weights -------------------------------------------------------------------------------------------

#: Weights where no labelled page is at hand.
PLAIN = {
    "word text": 1.0,
    "word link": -0.5,
    "word aside": -2.0,
    **{f"tag {t}": 1.0 for t in "h1 h2 h3 h4 h5 h6 article main".split()},
    **{f"tag {t}": 0.1 for t in "p pre blockquote br b i em strong code".split()},
}
UNSEEN_TAG = -1.0


def feature_counts(page: Page) -> Counter:
    """(feature, inside) counted on a page that names its content, once as such and once as if it did not."""
    found: Counter = Counter()
    for p in page.pieces:
        found[f"{'in' if p.named else 'out'} {p.feature}", p.named] += p.count
        found[f"any {p.feature}", p.named] += p.count
    return found


def log_odds(counts: dict[tuple[str, bool], int]) -> dict[str, float]:
    names = {n for n, _ in counts}
    return {
        n: max(-5.0, min(5.0, log((counts.get((n, True), 0) + 0.5) / (counts.get((n, False), 0) + 0.5)))) for n in names
    }


def learn_weights(pages: DataFrame, most: int = LABELLED) -> dict[str, float]:
    """Log-odds from at most `most` of the pages that name their content; tags beyond HTML's own are counted as one."""

    @F.pandas_udf("boolean")
    def names_content(sources: pd.Series) -> pd.Series:
        return pd.Series([read_page(s).names_content for s in sources], dtype=bool)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: Counter = Counter()
        for batch in batches:
            for source in batch["html"]:
                page = read_page(source)
                if page.names_content:
                    found.update(feature_counts(page))
        rows = [(n, inside, c) for (n, inside), c in found.items()]
        yield pd.DataFrame(rows, columns=["feature", "inside", "n"])

    every = pages.select("page_id", whole_text(pages, "html").alias("html"))
    named = every.filter(F.col("html").rlike("(?i)<(article|main)")).filter(names_content("html"))
    few = bounded_sample(named, "page_id", most)
    totals = few.mapInPandas(count, "feature string, inside boolean, n bigint").groupBy("feature", "inside").agg(F.sum("n").alias("n"))
    return log_odds({(r.feature, r.inside): r.n for r in totals.collect()})  # some hundred names


def weight(piece: Piece, names_content: bool, weights: dict[str, float]) -> float:
    if names_content and (piece.aside or piece.between):
        return 0.0  # left out of the text anyway, or between two articles
    where = ("in " if piece.named else "out ") if names_content else "any "
    known = weights.get(where + piece.feature)
    if known is None:
        known = PLAIN.get(piece.feature, UNSEEN_TAG)
        if names_content:
            known = abs(known) if piece.named else -abs(known)
    return known * piece.count


def best_run(scores: list[float]) -> tuple[int, int]:
    """(start, end) of the run with the greatest positive sum; the first and longest of equals; (0, 0) if none."""
    best, run, start, found = 0.0, 0.0, 0, (0, 0)
    for i, s in enumerate(scores):
        if run < 0:
            run, start = 0.0, i
        run += s
        if run > best or (run == best and run > 0 and found[0] == start):
            best, found = run, (start, i + 1)
    return found


def main_text(source: str, weights: dict[str, float]) -> str:
    """The blocks of the content region, white space made one space, joined by an empty line."""
    page = read_page(source)
    start, end = best_run([weight(p, page.names_content, weights) for p in page.pieces])
    blocks: dict[int, list[str]] = {}
    for p in page.pieces[start:end]:
        if p.block >= 0 and p.text:
            blocks.setdefault(p.block, []).append(p.text)
    texts = (" ".join("".join(parts).split()) for parts in blocks.values())
    return "\n\n".join(t for t in texts if t)


def extract_text(pages: DataFrame, labelled: int = LABELLED) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of `pages` (page_id, url, html).

    Null html counts as empty; a page without content has an empty text. Pages of any length are read whole.
    Repeated rows are each returned, null ids too; of regions with equal sums the first is taken. An empty table
    gives an empty result. Other columns of `pages`, whatever their names, are not looked at.
    """
    weights = learn_weights(pages, labelled)

    @F.pandas_udf("string")
    def texts(sources: pd.Series) -> pd.Series:
        return pd.Series([main_text(s, weights) for s in sources], dtype=object)

    found = pages.select(pages["page_id"], pages["url"], texts(whole_text(pages, "html")).alias("text"))
    return found.withColumn("n_chars", F.length("text").cast("bigint"))
