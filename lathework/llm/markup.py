"""HTML tokens of a page with what stands around each text."""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|template|textarea|noscript|iframe|svg|math|title|object|select)\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>.*?(?:</\1\s*>|\Z)"
    r"|<[!?][^>]*+>"
    r"|<(/?[a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?[a-zA-Z][^\s/>]*+)([^>]*+)>"
    r"|([^<]++|<)",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)

#: Elements without an end, elements that begin a block of text, and those whose start ends open ones.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
ENDS = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th"), "tr": ("tr", "td", "th"), "option": ("option",)}
#: Elements and words of class, id or role that mark what is not the article.
ASIDE = frozenset("aside button dialog fieldset footer form head input label menu nav option".split())
ASIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation navigator menu menubar breadcrumb breadcrumbs "
    "sidebar side aside footer foot masthead topbar toolbar comment comments commentlist disqus reply replies respond notice notices alert cookie cookies "
    "consent gdpr popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended widget pagination pager search "
    "contentinfo complementary dialog skip copyright disclaimer".split()
)
#: Elements whose words say nothing of their content, and words after which another says what is beside it.
FRAME, BESIDE = frozenset(("html", "body", "article", "main")), frozenset("with has no without".split())
CONTENT = frozenset(("article", "main"))
#: Elements whose ids are made from titles.
TITLED = frozenset("h1 h2 h3 h4 h5 h6 section".split())


#: Elements within a line: they part no texts unless they bear a class, id or role.
INLINE = frozenset("a abbr b bdi bdo big cite code del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var".split())
#: What an element says of its content.
PLAIN, BESIDE_IT, ARTICLE, HEADER = range(4)


@dataclass(slots=True)
class Text:
    """A text of a page: its decoded characters, block number, and what the page's own elements say of it.

    ``within`` says whether it is beside the article if all around is known to be in it, where no header counts.
    """

    value: str
    block: int
    aside: bool
    inside: bool
    within: bool = False


@dataclass(slots=True)
class Element:
    """An element of a page's token stream, or a text (label "#") by its number.

    One that stands for a node of a wrapper also knows how many pages had it, whether some lacked it and some had
    several; ``again`` is a further round of a group, whose kids the first one has shown.
    """

    label: str
    mark: int
    kids: list[Element]
    text: int = -1
    weight: int = 1
    optional: bool = False
    repeated: bool = False
    again: bool = False


def label(name: str, attributes: str, inside: bool) -> tuple[str, bool, bool, bool]:
    """Name with its class, whether it marks an aside, whether the article, and whether a header.

    Inside an article only whole class and role tokens tell; elsewhere their parts and those of ids, but of headings no
    id and of sections a whole one only, as these are made from titles.
    """
    words: list[str] = []
    first, role = "", ""
    for key, *values in ATTRIBUTE.findall(attributes) if attributes else ():
        key, value = key.lower(), "".join(values)
        if key not in ("class", "id", "role"):
            continue
        if key == "id" and name in TITLED:
            words += [value.lower()] if name == "section" and not inside else []
        elif inside:
            words += value.lower().split() if key != "id" else []
        else:
            words += re.findall("[a-z]+", value.lower())
        if key == "class":
            first = value
        elif key == "role":
            role = value.lower()
    told = name not in FRAME and BESIDE.isdisjoint(words)
    aside = name in ASIDE or told and not ASIDE_WORDS.isdisjoint(words)
    header = name == "header" or told and "header" in words
    return f"{name}.{first}" if first else name, aside, name in CONTENT or role in ("main", "article"), header


def parse(page: str) -> tuple[Element, list[Text]]:
    """The balanced token stream of a page and its texts in order, those of only white space left out.

    A label is an element's name with its class and what it says of its content; elements without an end and plain
    ones within a line are no part of the stream.
    """
    texts: list[Text] = []
    root = Element("", PLAIN, [])
    # name, the element whose kids are next, and whether an aside, an article or a header is open
    stack: list[tuple[str, Element, bool, bool, bool]] = [("", root, False, False, False)]
    opened: Counter[str] = Counter()
    block = 0
    pending_space = ""

    def close(at: int) -> None:
        nonlocal block
        for name, *_ in stack[at:]:
            opened[name] -= 1
            block += name in BLOCK
        del stack[at:]

    for raw, name, attributes, name2, attributes2, text in TOKEN.findall(page):
        _, holder, beside, inside, header = stack[-1]
        if text:
            value = html.unescape(text)
            if not value.strip():
                pending_space = " "
                continue
            holder.kids.append(Element("#", PLAIN, [], len(texts)))
            texts.append(Text(pending_space + value, block, beside or header and not inside, inside))
            pending_space = ""
            continue
        name, attributes = (name or name2).lower(), attributes or attributes2
        if raw or not name:
            continue
        if name[0] == "/":
            name = name[1:]
            if name in BLOCK:
                block += 1
                pending_space = ""
            if opened[name]:
                close(next(i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == name))
            continue
        if name in BLOCK:
            block += 1
            pending_space = ""
        if ends := ENDS.get(name):
            last = len(stack)
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] in ends:
                    last = i
                elif stack[i][0] in BLOCK:
                    break
            close(last)
            _, holder, beside, inside, header = stack[-1]
        if name in VOID or attributes.endswith("/"):
            if name == "br":
                pending_space = " "
            continue
        shown, aside, article, head = label(name, attributes, inside)
        mark = BESIDE_IT if aside else ARTICLE if article else HEADER if head else PLAIN
        own = holder
        if mark or shown != name or name not in INLINE:
            own = Element(f"{shown}!{mark}" if mark else shown, mark, [])
            holder.kids.append(own)
        stack.append((name, own, beside or aside, inside or article, header or head))
        opened[name] += 1
    return root, texts


def join(texts: list[Text]) -> str:
    """Blocks in page order, one a line, white space as one blank."""
    out: list[str] = []
    held: list[str] = []
    now = None
    for t in texts:
        if t.block != now:
            out.append("".join(held))
            held, now = [], t.block
        held.append(t.value)
    out.append("".join(held))
    return "\n".join(line for line in (" ".join(x.split()) for x in out) if line)
