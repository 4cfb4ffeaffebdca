"""Text blocks of an HTML page, each with what the markup says of its place.

A forgiving reader: comments, raw texts (script, style and their like) and tags are cut off, elements
left open are closed where HTML closes them, a tag or comment that the page's end cuts off is dropped.
Character references are decoded, also those without a semicolon that HTML allows; white space inside
a block becomes one space.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache
from html import unescape

_TOKEN = re.compile(r"""<!--(?:>|->|.*?(?:--!?>|\Z))|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]|=\s*"[^"]*"|=\s*'[^']*'|=)*+)>|<[!?][^>]*(?:>|\Z)|</[^a-zA-Z][^>]*(?:>|\Z)|</?[a-zA-Z][^>]*\Z""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_TELLING = re.compile(r"(?:^|\s)(?:class|id|role|itemprop|hidden|aria-hidden|style)\b", re.I).search
_CAMEL = re.compile(r"([a-z0-9])([A-Z])")
_NAME_WORD = re.compile(r"[a-z0-9]+")
_NOT_SHOWN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")

# Fixed values of HTML
RAW = {"script", "style", "title", "textarea", "xmp", "iframe", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
IN_HEAD = {"base", "link", "meta", "noscript", "script", "style", "template", "title"}
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "br", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure",
    "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "optgroup", "option", "p",
    "pre", "search", "section", "select", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
ENDS_P = BLOCK - {"br", "caption", "legend", "option", "optgroup", "tbody", "td", "tfoot", "th", "thead", "tr"}
ENDS_LIKE = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
             "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"})}

# What belongs to no article: by element, role, or a word of a class or id
CHROME_TAGS = {"nav", "header", "form", "menu", "search", "dialog", "fieldset", "head"}
ASIDE_TAGS = {"aside", "footer", "button", "select", "noscript", "template", "svg", "math", "object", "canvas", "audio", "video", "label", *RAW}
CHROME_ROLES = {"navigation", "banner", "search", "form", "dialog", "alertdialog", "alert", "status", "menu", "menubar", "toolbar", "tablist"}
ASIDE_ROLES = {"complementary", "contentinfo"}
CHROME_WORDS = {
    "nav", "navbar", "navigation", "menu", "menus", "submenu", "breadcrumb", "breadcrumbs", "crumbs", "masthead", "topbar", "toolbar", "sidebar", "cookie", "cookies",
    "consent", "gdpr", "notice", "notices", "notification", "alert", "banner", "popup", "modal", "overlay", "lightbox", "login", "signin", "signup", "subscribe", "subscription",
    "newsletter", "search", "searchbox", "pagination", "pager", "paging", "skip", "skiplink", "paywall", "disclaimer"}
ASIDE_WORDS = {
    "ad", "ads", "adv", "advert", "adverts", "advertisement", "advertisements", "advertising", "adsense", "adslot", "adbox", "adunit", "sponsor", "sponsors", "sponsored", "promo",
    "promos", "promoted", "promotion", "commercial", "comment", "comments", "commentlist", "disqus", "respond", "reply", "replies", "related", "recommended", "recommendations",
    "share", "sharing", "sharebar", "social", "follow", "widget", "widgets", "footer", "copyright", "outbrain", "taboola"}
HEADER_WORDS = {"header", "pageheader", "siteheader"}
NOT_THAT = {"no", "not", "has", "with", "without", "hide"}
LAYOUT = {"content", "main", "wrap", "wrapper", "layout", "container"}
MAIN_NAMES = {
    "article", "articlebody", "articlecontent", "articletext", "post", "postbody", "postcontent", "entrybody", "entrycontent", "storybody", "storycontent", "maincontent",
    "contentmain", "main", "content", "bodytext"}

PLAIN, CHROME, ASIDE = 0, 1, 2   # what an element is; an article inside CHROME is one all the same
BODY, MAIN, ARTICLE = 0, 1, 2


@dataclass(slots=True)
class Block:
    text: str
    place: int      # BODY, MAIN or ARTICLE
    dropped: bool   # the markup calls it something other than text
    linked: bool    # a list item that is a link and nothing else


@lru_cache(maxsize=1 << 14)
def _kind(name: str, attributes: str, place: int) -> tuple[int, int]:
    """What an element of this name is, and the place of what stands in it."""
    found = CHROME if name in CHROME_TAGS and not (name == "header" and place) else ASIDE if name in ASIDE_TAGS else PLAIN
    inner = max(place, ARTICLE if name == "article" else MAIN if name == "main" else BODY)
    if not attributes:
        return found, inner
    for key, *values in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), "".join(values)
        if key in ("class", "id"):
            if name in ("html", "body", "main"):
                continue
            for item in value.split():
                words = _NAME_WORD.findall(_CAMEL.sub(r"\1 \2", item).lower())
                if not NOT_THAT.isdisjoint(words):
                    continue
                if not ASIDE_WORDS.isdisjoint(words):
                    found = ASIDE
                elif name != "article" and not CHROME_WORDS.isdisjoint(words) and not ("sidebar" in words and not LAYOUT.isdisjoint(words)):
                    found = max(found, CHROME)
                elif not place and name != "article" and not HEADER_WORDS.isdisjoint(words):
                    found = max(found, CHROME)
                elif "".join(words) in MAIN_NAMES:
                    inner = max(inner, MAIN)
        elif key == "role":
            value = value.strip().lower()
            found = max(found, CHROME if value in CHROME_ROLES else ASIDE if value in ASIDE_ROLES else PLAIN)
            inner = max(inner, ARTICLE if value == "article" else MAIN if value == "main" else BODY)
        elif key == "itemprop" and value.strip() == "articleBody":
            inner = ARTICLE
        elif key == "hidden" or key == "aria-hidden" and value.strip().lower() == "true" or key == "style" and _NOT_SHOWN.search(value.lower()):
            found = ASIDE
    return found, inner


def blocks(html: str) -> list[Block]:
    """All blocks with text, in page order, dropped ones included."""
    out: list[Block] = []
    stack: list[tuple[str, int, int]] = [("", PLAIN, BODY)]  # name, kind with what stands around it, place
    held: list[str] = []
    outside_link = False
    links = 0

    def flush() -> None:
        nonlocal outside_link
        if held:
            text = " ".join("".join(held).split())
            if text:
                _, kind, place = stack[-1]
                listed = not outside_link and any(s[0] == "li" for s in stack[-4:])
                out.append(Block(text, place, kind != PLAIN, listed))
            held.clear()
        outside_link = False

    def say(raw: str) -> None:
        nonlocal outside_link
        if stack[-1][1] != PLAIN and stack[-1][0] not in BLOCK and any(s[0] in BLOCK and s[1] == PLAIN for s in stack[-1:-6:-1]):
            return  # dropped inside a block that stays
        text = unescape(raw) if "&" in raw else raw
        held.append(text)
        if not links and not text.isspace():
            outside_link = True

    def pop(size: int) -> None:
        nonlocal links
        if any(s[0] in BLOCK for s in stack[size:]):
            flush()
        links -= sum(s[0] == "a" for s in stack[size:])
        del stack[size:]

    def open_of(names: set[str], stop: set[str]) -> int:
        for k in range(len(stack) - 1, 0, -1):
            if stack[k][0] in names:
                return k
            if stack[k][0] in stop:
                return 0
        return 0

    at = 0
    while at < len(html):
        m = _TOKEN.search(html, at)
        if m is None:
            say(html[at:])
            break
        if m.start() > at:
            say(html[at:m.start()])
        at = m.end()
        name = m[2]
        if name is None:
            continue
        name = name.lower()
        if m[1]:
            if name == "br":
                flush()
            elif name in BLOCK:
                k = open_of({name}, set())
                if k:
                    pop(k)
                else:
                    flush()
            else:
                k = open_of({name}, BLOCK)
                if k:
                    pop(k)
            continue
        if stack[-1][0] == "head" and name not in IN_HEAD:
            pop(len(stack) - 1)
        if name in ENDS_P and (k := open_of({"p"}, BLOCK - {"p"})):
            pop(k)
        if name in ENDS_LIKE and (k := open_of(*ENDS_LIKE[name])):
            pop(k)
        if name in RAW:
            end = re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I).search(html, at)
            at = end.end() if end else len(html)
            continue
        if name in BLOCK:
            flush()
        if name in VOID:
            continue
        if name == "a" and (k := open_of({"a"}, BLOCK)):
            pop(k)
        _, around, place = stack[-1]
        kind, inner = _kind(name, m[3] if m[3] and _TELLING(m[3]) else "", place)
        if name in ("article", "main") and around == CHROME and kind != ASIDE:
            around = PLAIN
        stack.append((name, max(kind, around), inner))
        links += name == "a"
    pop(1)
    flush()
    return out


def candidates(found: list[Block]) -> list[int]:
    """The blocks that the markup leaves: those of the article; without one, of the main part; without
    that, all but the links of lists."""
    left = [i for i, b in enumerate(found) if not b.dropped]
    place = max((found[i].place for i in left), default=BODY)
    return [i for i in left if found[i].place == place and (place or not found[i].linked)]
