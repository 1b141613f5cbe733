"""A page's text blocks with the path of elements they stand in: the small per-page part of ``style_tree``."""

from __future__ import annotations

import html
import re

import xxhash

# ---- fixed values: HTML vocabulary and what sites call their parts ----
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset("head script style template noscript title iframe object svg math canvas audio video textarea noembed "
                   "noframes select datalist button input map".split())
BLOCK = frozenset("address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset "
                  "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol "
                  "option p pre section summary table tbody td tfoot th thead tr ul".split())
CLOSES_P = BLOCK - frozenset("body br caption head html option tbody td tfoot th thead tr".split())
CONTENT = frozenset("article main".split())
NOISE = frozenset("nav footer aside form menu dialog".split())
SITE_HEADER = "header"  # noise unless it stands in the content
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar "
                        "toolbar".split())
NOISE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr "
    "notice notification alert popup modal overlay newsletter subscribe subscription signup login comment comments commentlist "
    "disqus replies respond sidebar widget widgets menu nav navbar navigation breadcrumb breadcrumbs pagination pager share "
    "sharing social related recommended trending footer masthead topbar toolbar skip".split())
# of these, parts whose text differs from page to page, so that counts say nothing against the name
VARIED_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion comment comments commentlist disqus "
    "replies respond share sharing social related recommended trending".split())
ABOUT = frozenset("has no with without".split())  # such a name says what a part has, not what it is: has-menu, no-sidebar
# an open element of the key is closed by the start of one of the values
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option", "optgroup"},
             "td": {"td", "th", "tr", "tbody", "tfoot"}, "th": {"td", "th", "tr", "tbody", "tfoot"},
             "tr": {"tr", "tbody", "tfoot"}, "thead": {"tbody", "tfoot"}, "tbody": {"tbody", "tfoot"}}
HOLDS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "option": {"select"}, "td": {"table"}, "th": {"table"},
         "tr": {"table"}, "thead": {"table"}, "tbody": {"table"}}

# An unquoted value may hold quotes, and one stray quote may follow a quoted value; a quote that is never closed opens no tag.
VALUE = r"""(?:"[^"]*+"|'[^']*+')(?:["'](?=[\s/>]))?|[^\s"'>][^\s>]*+"""
TAG = re.compile(rf"""<(?:(!--)|(/?)([a-zA-Z][^\s/>]*)((?:[\s/]++|[^\s/>="'][^\s/>=]*+(?:\s*+=\s*+(?:{VALUE}))?|=)*+)>|[!?][^>]*>)""")
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>][^\s>]*))")
HIDDEN = re.compile(rf"""(?:^|[\s/])hidden(?=[\s/=]|$)""", re.IGNORECASE)
ONE_VALUE = re.compile(rf"=\s*(?:{VALUE})")
SPLIT_NAME = re.compile(r"[^a-z0-9]+")

NOTHING, OUTSIDE, INSIDE, DROPPED, NAMED = -1, 0, 1, 2, 3  # where a block stands
# known only when the whole page is read: below a varied word, content below one or below a form, below a form, in a header
_VARIED, _MAYBE, _FORM, _HEADER = 4, 5, 6, 7


def _attributes(raw: str) -> dict[str, str]:
    return {m[0].lower(): m[1] or m[2] or m[3] for m in ATTRIBUTE.findall(raw)} if "=" in raw else {}


def _noise(tag: str, attributes: dict[str, str], hidden: bool, inside: bool) -> int | None:
    if hidden:
        return DROPPED
    if attributes.get("role", "").lower() in NOISE_ROLES or attributes.get("aria-hidden", "").lower() == "true":
        return DROPPED
    if tag == "form" and not inside:
        return _FORM
    if tag in NOISE:
        return DROPPED
    if tag == SITE_HEADER and not inside:
        return _HEADER
    if tag in ("html", "body") or not ("class" in attributes or "id" in attributes):
        return None
    names = f"{attributes.get('class', '')} {attributes.get('id', '')}".lower().split()
    words = {w for parts in map(SPLIT_NAME.split, names) if ABOUT.isdisjoint(parts) for w in parts}
    if NOISE_WORDS.isdisjoint(words):
        return None
    return NAMED if VARIED_WORDS.isdisjoint(words) else _VARIED


def path_hash(path: str) -> int:
    value = xxhash.xxh3_64_intdigest(path)
    return value - (1 << 64) if value >> 63 else value


def blocks(page: str | None) -> list[tuple[str, int, str]]:
    """(path, place, text) of each block in page order. ``place``: INSIDE the content element, OUTSIDE, NAMED (in a part
    whose class or id says that it is none of the content, which counts may overrule), or DROPPED (its element, role or a name of
    parts with varied text says so). ``article`` and ``main`` are content within NAMED parts too, ``main`` within all that are dropped by name. On
    a page without other content, an ``article`` below a form or in a part named like varied text is the content; a header is a NAMED part; and a
    form that holds most of the text is no form to fill in but a wrapper."""
    page = page or ""
    out: list[tuple[str, int, str]] = []
    # open elements: tag, path, place; an element that is not seen has place NOTHING
    stack: list[tuple[str, str, int]] = [("", "", OUTSIDE)]
    parts: list[str] = []

    def flush() -> None:
        text = " ".join("".join(parts).split()) if parts else ""
        parts.clear()
        if text:
            at = len(stack) - 1
            while stack[at][2] == NOTHING:  # no text comes from there
                at -= 1
            place = stack[at][2]
            while at and stack[at][0] not in BLOCK:
                at -= 1
            out.append((stack[at][1], place, text))

    def close(at: int) -> None:
        if any(t in BLOCK for t, _, _ in stack[at:]):
            flush()
        del stack[at:]

    def add(text: str) -> None:
        if text and stack[-1][2] != NOTHING:
            parts.append(html.unescape(text) if "&" in text else text)

    at = 0
    while True:
        m = TAG.search(page, at)
        if m is None:
            add(page[at:])
            break
        add(page[at:m.start()])
        at = m.end()
        if m[1]:
            end = page.find("-->", at)
            at = len(page) if end < 0 else end + 3
            continue
        if not m[3]:
            continue
        tag = m[3].lower()
        if m[2]:
            low = 1
            if tag not in BLOCK:  # an inline end tag does not reach beyond its block
                low = max((k for k in range(1, len(stack)) if stack[k][0] in BLOCK), default=0) + 1
            found = next((k for k in range(len(stack) - 1, low - 1, -1) if stack[k][0] == tag), None)
            if found is not None:
                close(found)
            elif tag == "p":
                flush()
            continue
        if tag in CLOSES_P:
            found = next((k for k in range(len(stack) - 1, 0, -1) if stack[k][0] == "p"), None)
            if found is not None:
                close(found)
        if tag in CLOSED_BY:
            for k in range(len(stack) - 1, 0, -1):
                if tag in CLOSED_BY.get(stack[k][0], ()):
                    close(k)
                    break
                if stack[k][0] in HOLDS[tag]:
                    break
        if tag in BLOCK:
            flush()
        if tag in VOID:
            continue
        _, path, place = stack[-1]
        attributes = _attributes(m[4])
        if place == NOTHING or tag in UNSEEN:
            place = NOTHING
        elif place != DROPPED:
            hidden = "hidden" in m[4].lower() and HIDDEN.search(ONE_VALUE.sub("=", m[4])) is not None
            noise = _noise(tag, attributes, hidden, place in (INSIDE, _MAYBE))
            mark = tag if tag in CONTENT else attributes.get("role", "").lower()
            if noise == DROPPED or (noise in (_VARIED, _FORM) and place in (INSIDE, _MAYBE)):
                place = DROPPED if mark != "main" or noise == DROPPED else INSIDE
            elif mark in CONTENT:
                unsure = place in (_VARIED, _FORM) or noise == _VARIED
                place = INSIDE if mark == "main" and place != _FORM or not unsure else _MAYBE
            elif noise and place in (OUTSIDE, NAMED, _HEADER):
                place = noise
        if tag in BLOCK or place == NOTHING:
            path = f"{path}/{tag}.{' '.join(sorted(attributes.get('class', '').split()))}"
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])", re.IGNORECASE).search(page, at)
            at = len(page) if end is None else end.start()
        stack.append((tag, path, place))
    flush()
    return _settled(out)


def _settled(found: list[tuple[str, int, str]]) -> list[tuple[str, int, str]]:
    """Places that depend on the whole page."""
    places = {place for _, place, _ in found}
    if places.isdisjoint((_VARIED, _MAYBE, _FORM, _HEADER)):
        return found
    content = INSIDE in places
    meant = {_VARIED: DROPPED, _MAYBE: DROPPED if content else INSIDE, _FORM: DROPPED, _HEADER: DROPPED if content or _MAYBE in places else NAMED}
    if not content and _MAYBE not in places and _FORM in places:
        inside = sum(len(text) for _, place, text in found if place == _FORM)
        if 2 * inside > sum(len(text) for _, place, text in found if place != DROPPED):
            meant[_FORM] = OUTSIDE
    return [(path, meant.get(place, place), text) for path, place, text in found]
