"""Blocks of text of an HTML page, each with its place in the page's tree."""

from __future__ import annotations

import re
from html import unescape
from typing import NamedTuple

# Fixed values of the format.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template noscript iframe textarea title xmp noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt "
    "ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
#: An open element that a new one of these names ends, if it is in the same list or table.
ENDS = {
    "li": ("li", ("ul", "ol", "menu")),
    "dt": ("dt dd", ("dl",)),
    "dd": ("dt dd", ("dl",)),
    "tr": ("tr td th", ("table",)),
    "td": ("td th", ("tr", "table")),
    "th": ("td th", ("tr", "table")),
    "option": ("option", ("select",)),
}

#: Elements that are never part of an article.
NOISE_TAGS = frozenset(
    "nav footer aside form button select option menu dialog svg canvas object audio video head fieldset "
    "datalist map".split()
)
#: Words in class, id and role that tell parts around an article.
NOISE_WORDS = frozenset(
    "ad ads adsense adslot advert adverts advertisement advertising alert alerts banner banners "
    "breadcrumb breadcrumbs comment comments commentlist complementary consent contentinfo cookie "
    "cookies disqus dropdown footer gdpr header login masthead menu menus modal nav navbar navigation "
    "newsletter notice notices notification overlay pager pagination paywall popup promo promoted "
    "promotion recommended related replies reply respond search share sharing sidebar signup "
    "skyscraper social sponsor sponsored sponsors subscribe subscription teaser toolbar topbar "
    "tracking widget widgets".split()
)
#: Elements that hold the article itself.
ARTICLE_TAGS = frozenset(("article", "main"))

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"""|<(/?)([A-Za-z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+>|[^>]*(?:>|\Z))""",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
#: A class or id that begins so says what the page has around the element, not what the element is.
_ABOUT = re.compile(r"(?:has|no|with|without)(?=[-_A-Z])")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")


class Block(NamedTuple):
    """A run of text within one block element: the element's path, what kind of branch it is in
    (article, noise or neither) and the tags that stand in the text."""

    path: str
    article: bool
    noise: bool
    tags: str
    text: str


class _Element(NamedTuple):
    tag: str
    path: str
    article: bool
    noise: bool
    named: tuple[int, ...]  # the elements around it, itself included, that are noise by their names


def _names(value: str) -> set[str]:
    return {w.lower() for name in value.split() if not _ABOUT.match(name) for w in _NAME.findall(name)}


def _opened(tag: str, attributes: str, parent: _Element, number: int) -> _Element:
    found = {}
    if len(attributes) > 1:
        for m in _ATTRIBUTE.finditer(attributes):
            found.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    label = "".join(sorted(f".{w}" for w in found.get("class", "").lower().split() if not w[-1].isdigit()))
    article = parent.article or tag in ARTICLE_TAGS
    named = parent.named
    noise = parent.noise or tag in NOISE_TAGS or (tag == "header" and not article)
    if not noise and found and tag not in ("html", "body"):
        said = _names(" ".join(found.get(k, "") for k in ("class", "id", "role")))
        holds = tag in ARTICLE_TAGS and not parent.article
        if said & NOISE_WORDS and not holds:
            # Below zero: within an article, of which it can only be a part.
            named = (*parent.named, -number if parent.article else number)
        noise = (
            "hidden" in found
            or found.get("aria-hidden", "").lower() == "true"
            or bool(_HIDDEN.search(found.get("style", "").lower()))
        )
    return _Element(tag, f"{parent.path}/{tag}{label}", article, noise, named)


def _spared(found: list[tuple[Block, tuple[int, ...]]]) -> set[int]:
    """The elements that are noise by their names, but hold the page's article: if no marked article
    stands outside of such elements, those that hold one or more than half of the text."""
    seen = [(b, named) for b, named in found if not b.noise]
    if any(b.article and not named for b, named in seen):
        return set()
    size, marked = {}, set()
    for block, named in seen:
        for k in named:
            size[k] = size.get(k, 0) + len(block.text)
            if block.article and k > 0:
                marked.add(k)
    half = sum(len(b.text) for b, _ in seen) / 2
    return {k for k, n in size.items() if n > half} | marked


def blocks(html: str) -> list[Block]:
    """The blocks of a page in order, without those that hold only white space.

    Character references are decoded and white space within a block becomes one space. Scripts,
    styles and the like are passed over whole; a tag or comment that the page's end cuts off is
    no text. Elements that are not closed end with what is around them.
    """
    out: list[tuple[Block, tuple[int, ...]]] = []
    stack = [_Element("", "", False, False, ())]
    number = 0
    text: list[str] = []
    tags: list[str] = []
    at, raw = 0, None

    def flush() -> None:
        nonlocal text, tags
        if text:
            found = " ".join(unescape("".join(text)).split())
            if found:
                k = len(stack) - 1
                while k and stack[k].tag in INLINE:
                    k -= 1
                last = stack[-1]
                out.append((Block(stack[k].path, last.article, last.noise, " ".join(tags), found), last.named))
        text, tags = [], []

    while m := (raw or _TAG).search(html, at):
        if raw is None and m.start() > at:
            text.append(html[at : m.start()])
        at = m.end()
        if raw is not None:
            raw = None
            continue
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        closing = bool(m[1])
        if tag == "br" or tag == "hr":
            text.append(" ")
            tags.append(tag)
            if tag == "hr":
                flush()
        elif tag in VOID:
            tags.append(tag)
        elif closing:
            if not any(e.tag == tag for e in stack):
                continue
            if tag not in INLINE or stack[-1].noise or stack[-1].named:
                flush()
            while stack.pop().tag != tag:
                pass
        elif tag in RAW:
            if not m[3].endswith("/>"):
                raw = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)|\Z", re.IGNORECASE)
        elif tag in INLINE:
            tags.append(tag)
            number += 1
            element = _opened(tag, m[3], stack[-1], number)
            if (element.noise and not stack[-1].noise) or element.named != stack[-1].named:
                flush()
            stack.append(element)
        else:
            flush()
            _end_before(tag, stack)
            number += 1
            stack.append(_opened(tag, m[3], stack[-1], number))
    if raw is None and at < len(html):
        text.append(html[at:])
    flush()
    spared = _spared(out)
    return [b if b.noise or spared.issuperset(named) else b._replace(noise=True) for b, named in out]


def _end_before(tag: str, stack: list[_Element]) -> None:
    """Close what a new block element ends: an open paragraph, or the item before."""
    names, within = ENDS.get(tag, ("p", ("div", "section", "article", "td", "li", "blockquote", "button")))
    wanted = names.split()
    for k in range(len(stack) - 1, 0, -1):
        if stack[k].tag in wanted:
            del stack[k:]
            return
        if stack[k].tag in within:
            return
