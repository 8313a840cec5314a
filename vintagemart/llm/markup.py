"""Pages as trees of block elements with text slots, for use inside tasks.

Inline elements dissolve into the text of their block. End tags may be missing, wrong
or cut off; comments, scripts and styles leave nothing behind.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape

# Element names of the HTML standard, by how they are treated.
BLOCK = frozenset(
    "html body article aside address blockquote caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr legend li main menu nav ol optgroup "
    "option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NEVER = frozenset(
    "head nav footer aside form fieldset button select datalist iframe object svg canvas audio video map "
    "dialog menu search label".split()
)
# An open element that a new one ends, and the elements beyond which it doesn't reach.
ENDED_BY = {
    "li": ("li", ("ul", "ol", "menu", "dir")),
    "dt": ("dt dd", ("dl",)),
    "dd": ("dt dd", ("dl",)),
    "tr": ("tr td th", ("table",)),
    "td": ("td th", ("tr", "table")),
    "th": ("td th", ("tr", "table")),
    "option": ("option", ("select", "datalist")),
    "body": ("head", ()),
}
# Words of class names, ids and roles that mark what isn't the article.
BESIDE = frozenset(
    "ad ads adbox advert adverts advertisement advertising adsense alert alertdialog aside banner breadcrumb "
    "breadcrumbs byline comment comments commentlist complementary consent contentinfo cookie cookies disclaimer "
    "discussion disqus feedback gdpr login masthead menu modal nav navbar navigation newsletter notice "
    "notification overlay pager pagination popup promo promotion promoted recommended related replies reply "
    "respond responses search share sharing sidebar signup skip social sponsor sponsored subscribe subscription "
    "teaser toolbar topbar warning widget".split()
)
# Those that also name sections of an article, so that an id made from a heading may be one.
TITLES = frozenset(
    "alert consent disclaimer discussion feedback login menu modal navigation notice notification overlay pagination "
    "promotion recommended related replies reply respond responses search share sharing social sponsor subscription "
    "warning widget".split()
)
# Words that do so outside an article only.
AROUND = frozenset("header footer foot top bottom meta tags".split())
# Blocks nested deeper are no parts of their own (twice as deep for blocks that may be the
# article or stand beside it); their texts stay.
DEEPEST = 100
MAIN_WORDS = frozenset("article content entry main post story".split())
MAIN_PARTS = frozenset("area body content column container inner page text wrap wrapper".split()) | MAIN_WORDS

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)
      |<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^"'>]++|"[^"]*"|'[^']*')*+)>
      |<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^<>]*)(?:>|\Z)""",
    re.DOTALL | re.VERBOSE,
)
_MARKS = re.compile(r"""(?:^|\s)(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_HIDDEN = re.compile(
    r"""(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.IGNORECASE
)
_WORDS = re.compile(r"[a-z]+")


@dataclass
class Slot:
    """A block's text: white space folded, character references decoded. ``mark`` is
    that of the block."""

    text: str
    linked: int
    mark: str = ""


@dataclass
class Element:
    """``mark`` names the kind of element: its tag and the words of its class, id and
    role. ``level`` is above 0 if it may be the article, ``beside`` says that it
    isn't part of one wherever it stands, ``around`` outside an article only.
    ``doubtful`` elements are beside it if their texts say so, too."""

    tag: str
    mark: str
    level: int = 0
    beside: bool = False
    around: bool = False
    doubtful: bool = False
    children: list[Element | Slot] = field(default_factory=list)


_KINDS: dict[tuple[str, str], tuple] = {}


def _element(tag: str, attributes: str) -> Element:
    key = (tag, attributes)
    kind = _KINDS.get(key)
    if kind is None:
        if len(_KINDS) > 20_000:
            _KINDS.clear()
        found = {}
        for name, *values in _MARKS.findall(attributes):
            found[name.lower()] = unescape("".join(values))
        # Words of camelCase names are told apart, too.
        split = lambda v: _WORDS.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", v).lower())
        words = [w for value in found.values() for w in split(value)]
        named = [
            w
            for name in ("class", "id")
            for token in found.get(name, "").split()
            if (w := tuple(split(token)))
        ]
        level = 0
        if tag == "article" or found.get("itemprop", "").lower() == "articlebody" or "article" == found.get("role"):
            level = 3
        elif tag == "main" or found.get("role") == "main":
            level = 2
        elif any(set(w) & MAIN_WORDS and set(w) <= MAIN_PARTS for w in named):
            level = 1
        # Whole names only; an article element is what it says, and headings, paragraphs
        # and inline elements have ids to be linked to.
        tokens = {t for name, value in found.items() if name != "id" for t in value.lower().split()}
        section = tag in BLOCK and tag != "p" and not re.fullmatch("h[1-6]", tag)
        ids = set(found.get("id", "").lower().split()) if section else set()
        named_beside = tag != "article" and bool(BESIDE & (tokens | ids - TITLES))
        beside = tag in NEVER or named_beside or bool(_HIDDEN.search(attributes))
        doubtful = not beside and section and tag != "article" and bool(BESIDE & set(words))
        around = tag == "header" or bool(AROUND & set(words))
        kind = (f"{tag}.{'.'.join(sorted(set(words)))}" if words else tag, level, beside, around, doubtful)
        _KINDS[key] = kind
    return Element(tag, *kind)


def parse(html: str | None) -> Element:
    """The tree of a page; an empty one for null."""
    root = Element("", "")
    # Open elements: tag, the block it is or None, inside a link, dropped.
    stack: list[tuple[str, Element | None, bool, bool]] = [("", root, False, False)]
    # Blocks that stand too deep are their parents' text; the depth of each open one.
    blocks, depths = [root], [0]
    held: list[str] = []
    linked = 0
    html = html or ""
    at, size = 0, len(html)

    def flush() -> None:
        nonlocal linked
        if held:
            text = " ".join("".join(held).split())
            if text:
                blocks[-1].children.append(Slot(text, min(linked, len(text)), blocks[-1].mark))
            held.clear()
            linked = 0

    def close(depth: int) -> None:
        """Ends all elements above a depth."""
        while len(stack) > depth:
            _, block, _, _ = stack.pop()
            if block is not None:
                flush()
                blocks.pop()
                depths.pop()

    def say(text: str) -> None:
        nonlocal linked
        _, _, link, dropped = stack[-1]
        if text and not dropped:
            text = unescape(text)
            held.append(text)
            if link:
                linked += len(text)

    while at < size:
        match = _TOKEN.search(html, at)
        if match is None:
            say(html[at:])
            break
        if match.start() > at:
            say(html[at : match.start()])
        at = match.end()
        end, tag, attributes = match.group(1, 2, 3) if match[2] else match.group(4, 5, 6)
        if tag is None:
            continue
        tag = tag.lower()
        if end:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == tag:
                    close(depth)
                    break
                if stack[depth][1] is not None and tag not in BLOCK:
                    break
            else:
                if tag == "p":
                    flush()
            continue
        if tag in RAW:
            if not attributes.endswith("/"):
                stop = re.compile(rf"</{tag}\b[^>]*>?", re.IGNORECASE).search(html, at)
                at = stop.end() if stop else size
            continue
        if tag == "br":
            say("\n")
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            continue
        ended, beyond = ENDED_BY.get(tag, ("", ()))
        if tag in BLOCK and tag not in ("option", "optgroup"):
            # A block ends an open paragraph, and a paragraph in a container doesn't end that.
            ended, beyond = ended + " p", (*beyond, "div", "section", "article", "main", "td", "th", "li", "body")
            if tag in ENDED_BY:
                beyond = ENDED_BY[tag][1]
        if ended:
            those = ended.split()
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] in beyond and stack[depth][0] not in those:
                    break
                if stack[depth][0] in those:
                    close(depth)
                    if tag not in ENDED_BY:
                        break
        if attributes.endswith("/") and tag not in BLOCK:
            continue
        _, _, link, dropped = stack[-1]
        if tag in BLOCK or tag in NEVER:
            flush()
            block = _element(tag, attributes)
            says = block.level or block.beside or block.around or block.doubtful
            if depths[-1] < (2 * DEEPEST if says else DEEPEST):
                blocks[-1].children.append(block)
                depths.append(depths[-1] + 1)
            else:
                block = blocks[-1]
                depths.append(depths[-1])
            blocks.append(block)
            stack.append((tag, block, link, dropped))
        else:
            # Inline elements that stand beside the article are left out of its text.
            out = "=" in attributes and _element(tag, attributes).beside
            stack.append((tag, None, link or tag == "a", dropped or out))
    close(1)
    flush()
    return root
