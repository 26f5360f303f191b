"""One page as a sequence of tokens, and its article's blocks. Per-page helper."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

# HTML element names by kind.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt
    ruby s samp small span strike strong sub sup time tt u var wbr img""".split())
RAW = frozenset("script style textarea title xmp".split())  # their content has no tags
UNSEEN = frozenset("""head title script style noscript template svg math canvas iframe object audio video map
    form button select option textarea input datalist fieldset dialog""".split())
CHROME = frozenset("nav footer aside menu".split())
CLOSES_P = frozenset("""address article aside blockquote center details dialog dir div dl fieldset figcaption figure
    footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul""".split())
# Which open elements a start tag ends, and the elements that stop the search.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
          "option": ({"option"}, {"select"})}
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert".split())
# Words in a class or id that mark what is not the article.
MARKS = frozenset("""ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner nav
    navbar navigation menu breadcrumb breadcrumbs sidebar footer masthead topbar cookie cookies consent gdpr notice
    notices notification alert popup modal overlay newsletter subscribe subscription signup comment comments disqus
    reply replies respond discussion reactions share sharing social related recommended recommendations widget toolbar
    pagination pager login search skip side rail aside adbox adslot submenu dropdown""".split())
ARTICLE_MARKS = frozenset("""ad ads advert advertisement sponsored promo comment comments reply related recommended
    teaser""".split())  # on an article element itself
CONTAINERS = frozenset("article body center div main section td".split())
STATES = frozenset("has with no not without is".split())  # "has-sidebar" says what the rest of the page has
OUTER_MARKS = frozenset(["header"])  # not the article's own header

TOKEN = re.compile(r"<!--(?:.*?-->|.*)|<!\[CDATA\[(.*?)\]\]>|<[!?][^>]*(?:>|$)"
                   r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|$)", re.S)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
PARTS = re.compile(r"[a-z]+|[0-9]+")


@dataclass(slots=True)
class Text:
    """A run of text inside one block: its place, role and value."""

    at: int
    block: int
    path: str
    value: str
    chrome: bool
    article: int  # number of the article, or of main, that it lies in; -1 outside
    main: bool
    seen: bool  # in no element that a browser does not show as text
    linked: bool


@dataclass(slots=True)
class Open:
    name: str
    path: str
    chrome: bool
    article: int
    main: bool
    seen: bool = True
    linked: bool = False
    children: dict[str, int] = field(default_factory=dict)  # how many there were of each container


def _words(value: str) -> set[str]:
    """The words in class names and ids, without names that only state something."""
    out: set[str] = set()
    for name in value.split():
        parts = PARTS.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", name).lower())
        if parts and parts[0] not in STATES:
            out.update(parts)
    return out


def scan(page: str) -> tuple[list[tuple[int, str]], list[Text]]:
    """(tags: place and role; texts). A role is the element's path with classes and ids, and
    with the number of a container that is not the first of its like in its parent.

    Unclosed elements end where HTML says they do or with the page; stray end tags, comments
    and a tag that the page's end cuts short are passed over.
    """
    tags: list[tuple[int, str]] = []
    texts: list[Text] = []
    stack = [Open("", "", False, -1, False)]  # paths start with the root's empty name
    place = block = articles = 0
    pos, size = 0, len(page)

    def text(raw: str) -> None:
        nonlocal place
        if raw:
            top = stack[-1]
            value = html.unescape(raw) if "&" in raw else raw
            texts.append(Text(place, block, top.path, value, top.chrome, top.article, top.main, top.seen, top.linked))
            place += 1

    def close(k: int) -> None:
        nonlocal block, place
        while len(stack) > k:
            o = stack.pop()
            tags.append((place, o.path + "/end"))
            place += 1
            block += o.name not in INLINE

    while pos < size:
        found = TOKEN.search(page, pos)
        if found is None:
            text(page[pos:])
            break
        text(page[pos:found.start()])
        pos = found.end()
        if found[1] is not None:
            text(html.escape(found[1], quote=False))
        if not found[3]:
            continue
        name = found[3].lower()
        if not page[found.start():pos].endswith(">"):
            break  # cut short
        if found[2]:
            k = next((k for k in range(len(stack) - 1, 0, -1) if stack[k].name == name), 0)
            if k and not (name in INLINE and any(o.name not in INLINE for o in stack[k + 1:])):
                close(k)
            elif name in ("p", "br"):
                block += 1
            continue
        if name in CLOSES_P:
            k = next((k for k in range(len(stack) - 1, 0, -1) if stack[k].name in ("p", "button", "td", "th", "li", "div")), 0)
            if k and stack[k].name == "p":
                close(k)
        if name in CLOSES:
            ends, stops = CLOSES[name]
            low = 0
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].name in stops:
                    break
                if stack[k].name in ends:
                    low = k
            if low:
                close(low)
        attributes = {a[0].lower(): a[1] or a[2] or a[3] for a in ATTRIBUTE.findall(found[4])} if found[4].strip() else {}
        named = f"{attributes.get('class', '')} {attributes.get('id', '')}".strip()
        top = stack[-1]
        chrome = top.chrome or name in UNSEEN or name in CHROME or attributes.get("role", "").lower() in ROLES
        article, main = top.article, top.main or name == "main" or attributes.get("role", "").lower() == "main"
        if name not in ("html", "body", "article", "main"):
            words = _words(named) if named else set()
            chrome = chrome or bool(words & MARKS) or (article < 0 and (name == "header" or bool(words & OUTER_MARKS)))
        elif name == "article":
            chrome = chrome or bool(_words(named) & ARTICLE_MARKS)
            if not chrome and article < 0:
                article, articles = articles, articles + 1
        segment = name + ("." + ".".join(named.split()) if named else "")
        if name in CONTAINERS:
            nth = top.children[segment] = top.children.get(segment, 0) + 1
            if nth > 1:
                segment += f"[{nth}]"
        path = f"{top.path}/{segment}"
        seen, linked = top.seen and name not in UNSEEN, top.linked or name == "a"
        tags.append((place, path))
        place += 1
        block += name not in INLINE
        if name in RAW:
            end = re.compile(rf"</{name}\b[^>]*>", re.I).search(page, pos)
            if name in ("title", "textarea"):
                stack.append(Open(name, path, True, article, main, False))
                text(page[pos:end.start() if end else size])
                stack.pop()
            pos = end.end() if end else size
        elif name not in VOID and not found[4].rstrip().endswith("/"):
            stack.append(Open(name, path, chrome, article, main, seen, linked))
        elif name not in VOID:
            if name not in INLINE or name in UNSEEN:
                continue
            stack.append(Open(name, path, chrome, article, main, seen, linked))
    close(1)
    return tags, texts


def clean(value: str) -> str:
    return " ".join(value.split())


def blocks(texts: list[Text], template: set[int], role) -> list[str]:
    """The article's blocks in page order: what the page's slots hold, inside the longest
    article (else the main part, else the page), without chrome and without the texts whose
    role, ``role(text)``, is in the host's ``template``."""
    own = [t for t in texts if not t.chrome]
    lengths: dict[int, int] = {}
    for t in own:
        if t.article >= 0:
            lengths[t.article] = lengths.get(t.article, 0) + len(t.value.strip())
    best = max(lengths, key=lambda a: (lengths[a], -a), default=-1)
    if lengths.get(best):
        own = [t for t in own if t.article == best]
    elif any(t.main and t.value.strip() for t in own):
        own = [t for t in own if t.main]
    slots = [t for t in own if role(t) not in template]
    if not any(t.value.strip() for t in slots):
        slots = own  # nothing varies on this host: the template tells nothing
    return joined(slots)


def joined(texts: list[Text]) -> list[str]:
    """The blocks that texts make up, in page order, without empty ones."""
    out: list[str] = []
    last = None
    for t in texts:
        if t.block == last:
            out[-1] += t.value
        else:
            out.append(t.value)
            last = t.block
    return [b for b in map(clean, out) if b]
