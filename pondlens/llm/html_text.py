"""Main-text extraction by two-pass block rules.

A page is cut into blocks at block-level tags. Structure decides first:
menus, page headers, footers, sidebars, forms, scripts, and containers whose
class, id or role names an advert, a notice or reader comments are never main
text; neither is what lies outside the article, if the page marks one. The
first pass then labels blocks by link density, length and stop-word density;
short blocks stay open. In the second pass an open block inherits the label of
the nearest decided neighbour in its own region (the one before it wins a
tie); in a region without decided blocks it is text inside an article,
boilerplate elsewhere.

Names are read class by class: a class that states something about the page
(``has-sidebar``, ``comments-open``) names no boilerplate, and ``html``,
``body`` and ``main`` are never dropped by name, an ``article`` only as a
reader comment after another article. Blocks that read as prose survive a
container named after sharing. ``main`` ends whatever boilerplate is open, an
``article`` an unclosed menu or page header. On a page whose blocks hold next
to no stop words (another language) long blocks with few links are text,
measured in characters, since a script may write no blanks.

Null and empty pages, and pages without main text, give an empty text with 0
characters. Broken markup (missing end tags, stray brackets, open comments)
never raises. Repeated rows each get their text; an empty table gives an empty
result. Whole pages are read, whatever their length, one at a time.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pondlens.llm import textops as T

SHORT_WORDS = 8          # shorter blocks are open
MAX_LINK_SHARE = 0.5     # of a block's characters
MIN_STOP_SHARE = 0.12    # of a block's words
LONG_WORDS = 25          # such blocks are text even if stop words are few, inside an article
PROSE_WORDS = 16         # such blocks survive a container named after sharing
UNKNOWN_STOP_SHARE = 0.03    # no block of a page in another language has so many
LONG_CHARS = 80          # such blocks are text on a page in another language

# Frequent function words of the languages read.
STOP_WORDS = frozenset("""
the of and to in a is that it for on with as was be by at are this from or an not have has he she they you we but which
der die das und in zu den von mit ist im für auf dem nicht ein eine als auch es an werden aus er hat dass sie nach bei
le la les de des du et en un une est que qui dans pour par sur au aux pas plus ne se ce il elle avec sont
el los las y que del se por un una con no su para es al lo como más pero sus o
di il che e della per non sono da del dei een het van niet met op te dat os um uma com não mais
""".split())

DROP = frozenset("nav footer aside form script style noscript template iframe svg math select option button textarea head "
                 "object canvas audio video dialog menu".split())
RAW = frozenset("script style noscript template iframe textarea title svg math xmp".split())
CONTAINERS = frozenset("html body head div section article main nav aside header footer form ul ol dl table figure "
                       "details fieldset noscript template select button object dialog menu center".split())
BLOCKS = CONTAINERS | frozenset("p h1 h2 h3 h4 h5 h6 li dt dd tr td th thead tbody tfoot caption pre blockquote "
                                "figcaption address hr summary legend title option".split())
#: Classes, ids and roles that mark boilerplate, alone or as part of a compound name.
NAMED = re.compile(
    r"(?:^|[_-])(?:ads?|adverts?|advertisements?|advertising|adsense|banners?|promos?|promotions?|sponsor(?:ed|s)?|"
    r"sidebars?|side-?bar|menus?|navbar|navigation|nav|breadcrumbs?|comments?|disqus|replies|cookies?|consent|notices?|"
    r"gdpr|popups?|modals?|newsletters?|subscribe|signup|footers?|masthead|related|recommended|"
    r"complementary|contentinfo|alerts?|toolbar|pagination|pager|search(?:box)?|login)(?:$|[_-])", re.I)
SHARING = re.compile(r"(?:^|[_-])(?:social|share|sharing)(?:$|[_-])", re.I)
#: Names that state something about the page instead.
STATE = re.compile(r"(?:^|[_-])(?:has|have|with|without|no|not|is)[_-]|[_-](?:open|opened|closed|enabled|disabled|on|off|layout)$", re.I)
COMMENT = re.compile(r"comments?|reply|replies", re.I)
STRUCTURAL = frozenset(("html", "body", "main"))

TAG = re.compile(r"""<!--|<!\[CDATA\[|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>""")
NAMES = re.compile(r"""(?:^|[\s"'/])(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
HIDDEN = re.compile(r"""(?:^|\s)(?:hidden(?=[\s=/]|$)|aria-hidden\s*=\s*["']?true)|display\s*:\s*none""", re.I)
WORD = re.compile(r"[^\W\d_]+")


@dataclass
class Block:
    text: str
    link_chars: int
    region: int       # number of the article it lies in, 0 outside
    dropped: bool     # by structure
    sharing: bool = False    # in a container named after sharing
    label: bool | None = None


def split_blocks(page: str) -> list[Block]:
    """Cut a page into blocks, in page order; blocks without text are left out."""
    out: list[Block] = []
    stack: list[tuple[str, int, bool]] = []     # open containers: tag, kept (0), sharing (1) or dropped (2), opens an article
    parts: list[str] = []
    links: list[str] = []
    own_drop, in_link, region, articles, at = 0, 0, 0, 0, 0
    ahead: dict[str, re.Match | None] = {}

    def unclosed(tag: str) -> bool:
        """Whether the next tag of this kind opens another one, or there is none."""
        if tag not in ahead or ahead[tag] is not None and ahead[tag].start() < at:
            ahead[tag] = re.compile(rf"<(/?){tag}\b", re.I).search(page, at)
        return ahead[tag] is None or not ahead[tag][1]

    def closes(tag: str) -> bool:
        """Whether an article or main ends the boilerplate it stands in."""
        first = next(i for i, (_, bad, _) in enumerate(stack) if bad == 2)
        if tag == "main" or stack[first][0] in ("nav", "header", "menu") and unclosed(stack[first][0]):
            del stack[first:]
            return True
        return False

    def text(piece: str) -> None:
        if piece:
            piece = html.unescape(piece)
            parts.append(piece)
            if in_link:
                links.append(piece)

    def flush() -> None:
        nonlocal own_drop
        whole = " ".join("".join(parts).split())
        if whole:
            linked = len(" ".join("".join(links).split()))
            level = max(own_drop, stack[-1][1] if stack else 0)
            out.append(Block(whole, linked, region, level == 2, level == 1))
        parts.clear()
        links.clear()
        own_drop = 0

    n = len(page)
    while at < n:
        m = TAG.search(page, at)
        if m is None:
            text(page[at:])
            break
        text(page[at:m.start()])
        at = m.end()
        token = m[0]
        if token == "<!--":
            end = page.find("-->", at)
            at = n if end < 0 else end + 3
            continue
        if token == "<![CDATA[":
            end = page.find("]]>", at)
            text(page[at:n if end < 0 else end])
            at = n if end < 0 else end + 3
            continue
        if m[2] is None:
            continue
        tag, closing = m[2].lower(), bool(m[1])
        if tag == "a":
            in_link = 0 if closing else 1
        elif tag == "br":
            parts.append(" ")
        elif tag in RAW and not closing and not m[3].endswith("/"):
            # its content is no text: up to the end tag, or to the end
            end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = n if end is None else end.end()
            parts.append(" ")
        elif tag in BLOCKS:
            flush()
            if tag not in CONTAINERS:
                own_drop = 0 if closing else 2 if tag in DROP else _named(m[3])
                continue
            if closing:
                if any(t == tag for t, _, _ in stack):
                    while stack:
                        t, _, article = stack.pop()
                        region = 0 if article else region
                        if t == tag:
                            break
            elif not m[3].endswith("/"):
                in_link = 0
                bad = stack[-1][1] if stack else 0
                if tag in ("article", "main"):
                    if bad == 2 and closes(tag):
                        bad = stack[-1][1] if stack else 0
                    bad = 0 if bad == 1 else bad
                    if tag == "article" and articles and _comment(m[3]):
                        bad = 2
                elif tag in DROP or tag == "header" and not region:
                    bad = 2
                elif tag not in STRUCTURAL:
                    bad = max(bad, _named(m[3]))
                if HIDDEN.search(m[3]):
                    bad = 2
                article = tag in ("article", "main") and not region and bad != 2
                if article:
                    articles += 1
                    region = articles
                stack.append((tag, bad, article))
    flush()
    return out


def _names(attributes: str) -> list[str]:
    """The single classes, ids and roles."""
    return [t for a, b, c in NAMES.findall(attributes) for t in (a or b or c).split()]


def _named(attributes: str) -> int:
    """2 if hidden or named after boilerplate, 1 if named after sharing, else 0."""
    if not attributes:
        return 0
    if HIDDEN.search(attributes):
        return 2
    names = [t for t in _names(attributes) if not STATE.search(t)]
    return 2 if any(NAMED.search(t) for t in names) else 1 if any(SHARING.search(t) for t in names) else 0


def _comment(attributes: str) -> bool:
    return any(COMMENT.fullmatch(t) for t in _names(attributes))


def decide(blocks: list[Block]) -> None:
    """Both passes over one page's blocks."""
    marked = any(b.region and not b.dropped for b in blocks)
    measured = []
    for b in blocks:
        words = WORD.findall(b.text.lower())
        measured.append((len(b.text.split()), b.link_chars / len(b.text), sum(w in STOP_WORDS for w in words) / max(1, len(words))))
    foreign = not any(n >= SHORT_WORDS and stop >= UNKNOWN_STOP_SHARE for b, (n, _, stop) in zip(blocks, measured) if not b.dropped)
    for b, (n, link, stop) in zip(blocks, measured):
        if b.dropped or marked and not b.region:
            b.label = False
        elif b.sharing:
            b.label = n >= PROSE_WORDS and link <= MAX_LINK_SHARE / 2 and (stop >= MIN_STOP_SHARE or foreign)
        elif link > MAX_LINK_SHARE and n < LONG_WORDS:
            b.label = False
        elif foreign and not b.region and len(b.text) >= LONG_CHARS and link <= MAX_LINK_SHARE / 2:
            b.label = True
        elif n < SHORT_WORDS:
            b.label = None
        elif stop >= MIN_STOP_SHARE or b.region and n >= LONG_WORDS:
            b.label = True
        elif not b.region and n >= LONG_WORDS and link > MAX_LINK_SHARE / 2:
            b.label = False
        else:
            b.label = None
    for region in {b.region for b in blocks if not b.dropped}:
        here = [b for b in blocks if b.region == region and not b.dropped]
        # links inside an article say nothing about the short blocks beside them
        known = [(i, b.label) for i, b in enumerate(here) if b.label is not None and (b.label or not region)]
        k = 0
        for i, b in enumerate(here):
            if b.label is None:
                while k + 1 < len(known) and abs(known[k + 1][0] - i) < abs(known[k][0] - i):
                    k += 1
                b.label = known[k][1] if known else bool(region)


def main_text(page: str | None) -> str:
    if not page:
        return ""
    blocks = split_blocks(page)
    decide(blocks)
    return "\n\n".join(b.text for b in blocks if b.label)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars."""
    T.bound_batches(pages.sparkSession)
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))

    def run(batches):
        for b in batches:
            texts = [main_text(h.as_py()) for h in b["html"]]
            yield pa.RecordBatch.from_arrays(
                [b["page_id"], b["url"], pa.array(texts, type=pa.string()), pa.array([len(t) for t in texts], type=pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    kind = rows.schema["page_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars bigint")
