"""Main text of web pages by two passes of block rules.

A page is cut into blocks at block-level tags. The first pass decides a block where it can: containers
that hold no article text (menus, footers, sidebars, notices, adverts, forms, reader comments) and
blocks that are mostly links are boilerplate; long blocks with many stop words are text; what is
short, or long without stop words, stays open. The second pass gives an open block the label of the
nearest decided neighbour, counted in blocks. Blocks in the containers named above are no neighbours:
they decide only themselves. An article or main element bounds the search: blocks outside it are
boilerplate and open blocks inside it inherit within it; where nothing is decided they are text, so
short articles and tables of words survive. A class, id or role counts by its whole names ("comments",
"site-nav"); names that remark on the page ("has-sidebar") and other attributes say nothing. A notice
that no end tag closes ends where an article starts; an article in a closed container of that kind is
part of it.

A null page is the empty text. Rows that repeat a page each have their row; an empty table gives no
rows. Other columns of the input are not read.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import pieces, texts_of

#: Elements whose content is never text.
RAW = ("script", "style", "noscript", "template", "iframe", "object", "svg", "canvas", "math", "head", "title", "textarea", "select", "button", "audio", "video", "map")
#: Elements that hold no article text.
AWAY = frozenset("nav footer aside form dialog menu fieldset".split())
#: Elements that bound the article.
ARTICLE = frozenset("article main".split())
#: Elements that end a block.
BLOCK = frozenset(
    "address article aside blockquote body br caption center col colgroup dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
CONTAINERS = BLOCK | {"section"}
#: Elements that hold the article, whatever their class.
KEPT = ARTICLE | {"body", "html"}
#: Elements without an end tag.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: What a class, id or role calls containers that hold no article text: a whole name, or a part of one between hyphens.
NOT_TEXT = frozenset(
    (
        "ad ads advert adverts advertisement advertisements adsense banner promo promos promotion promotions sponsor sponsored cookie cookies consent notice notices alert popup modal overlay newsletter subscribe subscription "
        "nav navbar navigation menu menus breadcrumb breadcrumbs sidebar sidebars widget widgets footer masthead siteheader pageheader toolbar pagination pager share sharing social related recommended "
        "comment comments commentlist respond replies disqus login signup search skip contentinfo complementary"
    ).split()
)
#: Parts that make of a name a remark on the page ("has-sidebar", "comments-closed"), so that it names no container.
_REMARKS = frozenset("has have no non not with without is hide hides hidden show shows closed open opened enabled disabled on off free count counts allowed active inactive".split())
#: Names of two parts that hold no article text only together.
_TOGETHER = frozenset({("site", "header"), ("page", "header"), ("side", "bar")})
#: Frequent function words of the languages served.
STOP = frozenset(
    (
        "a about after all also an and any are as at be been but by can did do for from had has have he her his how i if in into is it its more no not of on one or other our out she so some than that the their them then there these they this to up was we were what when which who will with would you your "
        "au aux avec ce ces cette dans de des du elle en est et eu il ils je la le les leur lui ma mais me mes mon ne nous on ou par pas pour qu que qui sa sans se ses son sur te toi tu un une vos votre vous "
        "aber als am an auch auf aus bei bin bis da das dass dem den der des die doch du ein eine einem einen einer er es für hat ich ihr im in ist ja kann man mit nach nicht noch nur oder sein sich sie sind so über um und uns unter vom von vor war was wenn wie wir zu zum zur "
        "al algo como con cuando de del desde donde dos el ella ellos en entre era es esta este fue ha hay la las le lo los más me mi muy no nos o para pero por porque que se ser si sin sobre su sus también te un una y ya yo"
    ).split()
)
LONG, STOP_LEAST, LINKS_MOST = 60, 0.15, 0.5

_TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<(?P<raw>" + "|".join(RAW) + r")\b[^>]*?(?:/>|>.*?(?:</(?P=raw)\s*>|$))|<(?P<end>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?/][^>]*>",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"([^\s=\"'<>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")


@dataclass(slots=True)
class Block:
    text: str
    links: int  # characters inside links
    away: bool  # in a container that holds no article text
    scope: int  # the article around it, 0 for none


def _names_no_text(name: str) -> bool:
    """Whether one name of a class, id or role is that of a container without article text."""
    parts = re.split(r"[-_]+", name.strip("-_"))
    if not _REMARKS.isdisjoint(parts):
        return False
    return not NOT_TEXT.isdisjoint(parts) or any(x in _TOGETHER for x in zip(parts, parts[1:]))


def _says_no_text(name: str, rest: str, article: bool) -> bool:
    """What the element's name and its own class, id, role and hidden attributes say. An article, body or html element never says so by its class."""
    if name in AWAY or name == "header" and not article:
        return True
    if not rest.strip(" /"):
        return False
    for m in _ATTRIBUTE.finditer(rest):
        key, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if key == "hidden" and value != "false" or key == "aria-hidden" and value == "true":
            return True
        if key in ("class", "id", "role") and name not in KEPT and any(map(_names_no_text, value.split())):
            return True
    return False


def _stacked(name: str, rest: str) -> bool:
    return name not in VOID and not rest.endswith("/") and name not in ("p", "li", "dt", "dd", "tr", "td", "th", "option")


def _left_open(tags: list[re.Match]) -> set[int]:
    """Places in tags of the containers that no end tag of their own closes."""
    stack: list[tuple[str, int]] = []
    out: set[int] = set()
    for i, m in enumerate(tags):
        name = m["name"].lower()
        if m["end"]:
            at = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == name), None)
            if at is not None:
                out.update(k for _, k in stack[at + 1 :])
                del stack[at:]
        elif _stacked(name, m["rest"]):
            stack.append((name, i))
    return out | {k for _, k in stack}


def blocks(page: str) -> list[Block]:
    """The page's blocks with text, in order."""
    out: list[Block] = []
    stack: list[tuple[str, bool, int, int]] = []  # name, holds no article text, article, place among the containers' tags
    scopes, link, links, parts, away, scope, at = 0, 0, 0, [], False, 0, 0
    tokens = list(_TOKEN.finditer(page))
    tags = [m for m in tokens if (m["name"] or "").lower() in CONTAINERS]
    left_open: set[int] | None = None

    def close() -> None:
        nonlocal links, parts
        text = " ".join(entities.unescape("".join(parts)).split())
        if text:
            out.append(Block(text, links, away, scope))
        parts, links = [], 0

    place = -1
    for m in tokens:
        if m.start() > at:
            parts.append(page[at : m.start()])
            if link:
                links += m.start() - at
        at = m.end()
        if not (name := (m["name"] or "").lower()):
            continue
        if name == "a":
            link = 0 if m["end"] else 1
        if name not in CONTAINERS:
            continue
        place += 1
        if name in BLOCK:
            close()
            link = 0 if name not in ("br",) else link
        if m["end"]:
            names = [s[0] for s in stack]
            if name in names:
                del stack[len(names) - 1 - names[::-1].index(name) :]
        elif _stacked(name, m["rest"]):
            no = _says_no_text(name, m["rest"], bool(scope))
            if name in ARTICLE and not no and not scope and any(s[1] for s in stack):
                left_open = _left_open(tags) if left_open is None else left_open
                stack = _without_open_notices(stack, left_open)
            if name in ARTICLE and not no:
                inside = any(s[1] for s in stack)
                scopes += not scope and not inside
                stack.append((name, no, scope or (0 if inside else scopes), place))
            else:
                stack.append((name, no, scope, place))
        elif name in ("p", "li", "td", "th") and m["rest"] and _says_no_text(name, m["rest"], bool(scope)):
            stack.append((name, True, scope, place))
        away, scope = any(s[1] for s in stack), stack[-1][2] if stack else 0
    parts.append(page[at:])
    close()
    return out


def _without_open_notices(stack: list[tuple[str, bool, int, int]], left_open: set[int]) -> list[tuple[str, bool, int, int]]:
    """The open containers around an article: of those of a name, as many as no end tag closes are notices left open, innermost first, and end before the article."""
    spare = Counter(s[0] for s in stack if s[3] in left_open)
    out = []
    for name, no, scope, place in reversed(stack):
        if no and spare[name]:
            spare[name] -= 1
            no = False
        out.append((name, no, scope, place))
    return out[::-1]


def _first_pass(block: Block) -> int:
    """1 text, -1 boilerplate, 0 open."""
    words = block.text.lower().split()
    if block.away or block.links > LINKS_MOST * len(block.text):
        return -1
    if len(block.text) >= LONG and sum(w.strip(".,;:!?\"'()") in STOP for w in words) >= STOP_LEAST * len(words):
        return 1
    return 0


def _inherit(labels: list[int], where: list[int]) -> None:
    """Open places among where take the label of the nearest decided one; of two as near, and of none, text wins."""
    decided = [i for i in where if labels[i]]
    for n in [i for i in where if not labels[i]]:
        labels[n] = -min((abs(n - i), -labels[i]) for i in decided)[1] if decided else 1


def main_text(page: str | None) -> str:
    """The article's text: its blocks in page order, joined by one space."""
    found = blocks(page or "")
    first = [_first_pass(b) for b in found]
    inside = any(b.scope and not b.away for b in found)  # an article bounds the search
    where = [i for i, b in enumerate(found) if not b.away and (b.scope or not inside)]
    labels = [-1] * len(found)
    for i in where:
        labels[i] = first[i]
    _inherit(labels, where)
    return " ".join(b.text for b, x in zip(found, labels) if x == 1)


def extracted(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The named columns of every row with text and n_chars, its code points."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces(whole, column="__html"):
                texts = [main_text(x) for x in texts_of(batch.column(batch.num_columns - 1))]
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], names=[*keep, "text", "n_chars"])

    rows = pages.select(*keep, F.col(html_col).cast("string").alias("__html"))
    schema = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes[:-1])
    return rows.mapInArrow(run, f"{schema}, text string, n_chars long")
