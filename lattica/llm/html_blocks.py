"""Blocks of a web page in page order, and where in the page's structure each stands."""

from __future__ import annotations

import html
import re
from typing import NamedTuple

#: Where a block stands: in the article, somewhere that the markup says nothing about, in what surrounds an article.
ARTICLE, OPEN, AROUND = "A", "N", "C"

# Fixed values of the HTML standard and of common usage: elements by kind, roles, words in class and id.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset("noscript template svg math object select datalist button audio video canvas map".split())
SELF_CLOSING = frozenset("li dt dd td th tr option p".split())
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
SURROUNDINGS = frozenset("nav footer aside form menu dialog".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar status log".split())
COMMENT_WORDS = frozenset("comment comments commentlist disqus replies reply respond".split())
CHROME_WORDS = COMMENT_WORDS | frozenset(
    """ad ads adv advert adverts advertisement advertising adsense banner billboard breadcrumb breadcrumbs consent cookie cookies copyright footer gdpr login menu modal nav navbar
    navigation newsletter notice notices notification outbrain pager pagination paywall popup promo promoted promotion recommended recommendations related search share sharing sidebar
    signup skyscraper social sponsor sponsored subscribe subscription taboola toolbar topbar widget widgets""".split()
)
HEADER_WORDS = frozenset("header masthead".split())
CONTENT_WORDS = frozenset("article content entry post story".split())

MARKUP = re.compile(
    r"""<!--(?:-?>|.*?(?:--!?>|\Z))
    |<(script|style|title|textarea|iframe|noembed|noframes|xmp)(?=[\s/>])[^>]*>.*?(?:</\1(?=[\s/>])[^>]*>|\Z)
    |<(/?)([a-z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^>"'])*+)>
    |<(/?)([a-z][^\s/>]*)([^>]*)>
    |<[!?/][^>]*>""",
    re.I | re.S | re.X,
)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


class Block(NamedTuple):
    tag: str
    text: str
    kind: str


class State(NamedTuple):
    """chrome: 1 said by a name, 2 said by an element, a role or the name of comments; zone: 1 content by name, 2 main, 3 article."""

    tag: str
    chrome: int
    zone: int
    skipped: bool


def entered(tag: str, attributes: str, above: State) -> State:
    """State inside an element that opens under ``above``."""
    chrome, zone, words, role, prop = above.chrome, above.zone, set(), "", ""
    if "=" in attributes:
        for name, *values in ATTRIBUTE.findall(attributes):
            value, name = "".join(values), name.lower()
            if name in ("class", "id"):
                words.update(w.lower() for w in NAME_PART.findall(value))
            elif name == "role":
                role = value.strip().lower()
            elif name == "itemprop":
                prop = value.strip().lower()
    opens = 3 if tag == "article" or prop == "articlebody" or role == "article" else 2 if tag == "main" or role == "main" else 0
    if opens:
        zone = max(zone, opens)
        if chrome < 2:
            chrome = 0
        words &= COMMENT_WORDS
    if tag in SURROUNDINGS or role in ROLES or (tag == "header" and zone < 2):
        chrome = 2
    elif tag not in ("html", "body"):
        if words & COMMENT_WORDS:
            chrome = 2
        elif words & CHROME_WORDS or (words & HEADER_WORDS and zone < 2):
            chrome = max(chrome, 1)
        elif words & CONTENT_WORDS:
            zone = max(zone, 1)
    return State(tag, chrome, zone, above.skipped or tag in SKIPPED)


def unfinished(m: re.Match) -> bool:
    """Whether a comment or a raw element runs to the page's end for want of its closing mark."""
    found = m.group()
    if m.group(1):
        return not re.search(rf"</{m.group(1)}(?=[\s/>])[^>]*>\Z", found, re.I)
    return found.startswith("<!--") and not found.endswith(("-->", "--!>", "<!-->", "<!--->"))


def blocks(page: str | None) -> list[Block]:
    """Non-empty blocks in page order: character references decoded, white space runs one space, trimmed.

    Scripts, styles, titles, comments and form controls have no text.  ``kind``: blocks inside an article
    (or, without one, inside the main element) are ARTICLE; where a page has neither, the blocks inside
    elements named as content, or else all that no markup calls surroundings, are OPEN; the rest is
    AROUND.  Menus, headers, footers, sidebars, notices, adverts, forms and reader comments are told by
    element, role or name, and are AROUND inside an article too.
    """
    found: list[tuple[str, str, State]] = []
    stack, parts, tag_now, at = [State("", 0, 0, False)], [], "", 0
    page = page or ""

    def flush():
        if parts:
            text = " ".join("".join(parts).split())
            parts.clear()
            if text:
                found.append((tag_now, text, stack[-1]))

    end = page.rfind(">") + 1  # nothing behind the last one closes a tag, so no tag's search runs to the page's end
    for m in MARKUP.finditer(page, 0, end):
        if m.start() > at and not stack[-1].skipped:
            parts.append(html.unescape(page[at : m.start()]))
        at = m.end()
        if at == end and unfinished(m):
            at = len(page)
        closing, tag, attributes = m.group(2, 3, 4) if m.group(3) else m.group(5, 6, 7)
        if not tag:
            continue
        tag = tag.lower()
        inline = tag in INLINE
        if tag == "br":
            parts.append(" ")
        elif not inline:
            flush()
            tag_now = tag
        if closing:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    flush()
                    del stack[i:]
                    break
        elif tag not in VOID:
            if not inline and ((tag in SELF_CLOSING and stack[-1].tag == tag) or (tag in CLOSES_P and stack[-1].tag == "p")):
                stack.pop()
            state = entered(tag, attributes, stack[-1])
            if not inline or state[1:] != stack[-1][1:]:
                if inline:
                    flush()
                stack.append(state)
    if not stack[-1].skipped:
        parts.append(html.unescape(page[at:]))
    flush()
    level = max((s.zone for _, _, s in found if not s.chrome), default=0)
    kind = lambda s: AROUND if s.chrome or s.zone < level else ARTICLE if level >= 2 else OPEN
    return [Block(tag, text, kind(s)) for tag, text, s in found]
