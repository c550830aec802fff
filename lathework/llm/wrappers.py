"""HTML extraction: union-free wrappers inferred from the pages of a host."""

from __future__ import annotations

import json
import pickle
import zlib
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from functools import partial
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lathework.llm.markup import ARTICLE, BESIDE_IT, HEADER, PLAIN, Element, Text, join, parse
from lathework.llm.runtime import arrow, prepare, stage_table

#: Wrappers merged in one call; nodes of a repeated group; how far ahead a node is looked for when two streams differ
#: (beyond, it counts as missing); bytes of wrappers that may be sent to every worker (more are joined by host) and
#: parts into which a host's rows are dealt in that join.
FAN, LONGEST_GROUP, REACH, BROADCAST_BYTES, SALTS = 64, 24, 256, 16 << 20, 32
#: Nodes of a wrapper: beyond, those that the fewest pages have are left out.
MOST_NODES = 1 << 14
#: Different pages from which literals in the midst of the main text are told, and of how many one may be unlike the rest.
SURE, REST = 3, 10
TEXT, GROUP = "#", "+"


@dataclass(slots=True, eq=False)
class Node:
    """Part of a wrapper: an element, a text slot (TEXT) or a group of several nodes that repeats (GROUP).

    ``weight`` is the number of pages that have it. A slot knows, by their hashes, the texts that the host's pages have
    there in common: its literals. ``chars`` is what else the pages have in a slot, and in all slots below a node.
    """

    label: str
    mark: int = 0
    kids: list[Node] = field(default_factory=list)
    optional: bool = False
    repeated: bool = False
    seen: bool = False
    said: set[int] = field(default_factory=set)
    beside: bool = False
    inside: bool = False
    weight: int = 0
    chars: int = 0

    def takes(self, label: str) -> bool:
        return self.label == label or self.label == GROUP and any(k.takes(label) for k in self.kids)


def ahead(nodes: list, at: int, fits) -> int | None:
    return next((i for i in range(at, min(at + REACH, len(nodes))) if fits(nodes[i])), None)


def follows_itself(items: list[Node], at: int, met: set[Node], stream: list[Element], j: int) -> int:
    """Nodes before ``at`` that the stream has once more from ``j`` on; 0 if there is no such group."""
    for n in range(2, min(at, LONGEST_GROUP) + 1):
        if items[at - n] not in met:
            return 0
        if not items[at - n].takes(stream[j].label):
            continue
        k = j
        for item in items[at - n : at]:
            if k == len(stream) or not item.takes(stream[k].label):
                break
            k += 1
            while item.repeated and k < len(stream) and item.takes(stream[k].label):
                k += 1
        else:
            return n
    return 0


def rounds(group: Node, stream: list[Element], j: int) -> tuple[list[list[Element]], int]:
    """The repeats of a group from ``j`` on, and where they end."""
    out: list[list[Element]] = []
    at = len(group.kids)
    while j < len(stream):
        fits = [i for i, k in enumerate(group.kids) if k.takes(stream[j].label)]
        if not fits:
            break
        on = next((i for i in fits if i > at or i == at and group.kids[i].repeated), None)
        if on is None:
            out.append([])
        at = fits[0] if on is None else on
        out[-1].append(stream[j])
        j += 1
    return out, j


def align(wrapper: Node, page: Element, slots: list[Node | None], grow: bool, loose: list[tuple[Node, Element]] | None = None) -> bool:
    """Lays a page's stream along the wrapper: ``slots`` gets the slot of each text, None where the wrapper has none.

    What follows itself is a repeat. Where the streams differ, the nearer place counts at which one side's next node
    stands on the other; what is skipped is optional, and what nobody has is a node of its own. With ``grow`` the
    wrapper takes the page in, otherwise it stays, and ``loose`` gets what it lacks with the node around. Returns whether it describes the page from the first node to the last.
    """
    whole = True
    todo: list[tuple[Node, list[Element]]] = [(wrapper, page.kids)]
    while todo:
        node, stream = todo.pop()
        items, at, j, fresh = node.kids, 0, 0, not node.seen
        met: set[Node] = set()
        while j < len(stream):
            e = stream[j]
            item = items[at] if at < len(items) else None
            if item is None or not item.takes(e.label):
                prior = items[at - 1] if at and items[at - 1] in met else None
                if prior is not None and prior.takes(e.label):
                    whole &= grow or prior.repeated
                    prior.repeated |= grow
                    at, item = at - 1, prior
                elif grow and (n := follows_itself(items, at, met, stream, j)):
                    item = Node(GROUP, kids=items[at - n : at], repeated=True, seen=True)
                    item.weight = max(k.weight for k in item.kids)
                    items[at - n : at] = [item]
                    at -= n
                else:
                    p = ahead(items, at + 1, lambda x, e=e: x.takes(e.label))
                    q = ahead(stream, j + 1, lambda x, item=item: item.takes(x.label)) if item is not None else None
                    if p is not None and (q is None or p - at <= q - j):
                        at, item = p, items[p]
                    elif grow:
                        item = Node(e.label, e.mark, optional=not fresh)
                        items.insert(at, item)
                    else:
                        whole, item = False, None
            if item is None:
                if loose is not None:
                    loose.append((node, e))
                j += 1
                continue
            met.add(item)
            at += 1
            if grow:
                item.weight += e.weight
                item.optional |= e.optional
                item.repeated |= e.repeated
            if item.label == GROUP:
                found, j = rounds(item, stream, j)
                todo += [(item, r) for r in found]
                continue
            if e.text >= 0:
                slots[e.text] = item
            elif not e.again:
                todo.append((item, e.kids))
            j += 1
        for item in items:
            if item not in met and not item.optional:
                whole &= grow
                item.optional |= grow
        node.seen |= grow
    return whole


def walk(root: Node) -> Iterator[tuple[Node, Node | None]]:
    """Every node with its parent, parents first."""
    todo: list[tuple[Node, Node | None]] = [(root, None)]
    while todo:
        node, parent = todo.pop()
        yield node, parent
        todo += [(k, node) for k in reversed(node.kids)]


def expression(root: Node) -> str:
    """The wrapper as text: groups in brackets, ``?`` after what is optional and ``+`` after what repeats."""
    out: list[str] = []
    todo: list[Node | str] = list(reversed(root.kids))
    while todo:
        n = todo.pop()
        if isinstance(n, str):
            out.append(n)
            continue
        end = ("+" if n.repeated else "") + ("?" if n.optional else "")
        todo.append(")" + end if n.kids else end)
        out.append(" " + ("" if n.label == GROUP else n.label) + ("(" if n.kids else ""))
        todo += reversed(n.kids)
    return "".join(out).replace("( ", "(").strip()


class Wrapper:
    """The union-free expression of a host's pages, with what is known of its slots."""

    def __init__(self, root: Node):
        self.root = root
        self.nodes = [node for node, _ in walk(root)]
        self.number = {node: i for i, node in enumerate(self.nodes)}
        self.parent = dict(walk(root))
        #: Slots that are some page's main text.
        self.main: list[int] = []

    def dump(self) -> bytes:
        """The same bytes for the same wrapper, whatever it was made from."""
        rows = [
            (n.label, n.mark, -1 if (p := self.parent[n]) is None else self.number[p], n.optional, n.repeated, n.weight, sorted(n.said), n.beside, n.inside, n.chars)
            for n in self.nodes
        ]
        return zlib.compress(json.dumps([rows, self.main], separators=(",", ":")).encode(), 1)

    @staticmethod
    def load(data: bytes) -> Wrapper:
        nodes: list[Node] = []
        rows, main = json.loads(zlib.decompress(data))
        for label, mark, parent, optional, repeated, weight, said, beside, inside, chars in rows:
            nodes.append(Node(label, mark, [], optional, repeated, True, set(said), beside, inside, weight, chars))
            if parent >= 0:
                nodes[parent].kids.append(nodes[-1])
        wrapper = Wrapper(nodes[0])
        wrapper.main = main
        return wrapper


def sketch(stream: Element, texts: list[Text]) -> bytes:
    """The wrapper of one page alone."""
    root = Node("")
    align(root, stream, [None] * len(texts), True)
    made = Wrapper(root)
    for node in made.nodes:
        node.weight = 1
    return made.dump()


def stream_of(nodes: list[Node], times: int, optional: bool = False, again: bool = False) -> list[Element]:
    """A stream that the nodes describe and from which alignment finds them again; a group's is shown twice, the groups in its second round once."""
    out: list[Element] = []
    for n in nodes:
        if n.label == GROUP:
            for more in (True,) if again else (False, True):
                out += stream_of(n.kids, times, optional or n.optional, more)
            continue
        out.append(Element(n.label, n.mark, [], 0 if n.label == TEXT else -1, 0 if again else n.weight * times, optional or n.optional, n.repeated, again))
    return out


def rendered(wrapper: Wrapper, times: int) -> Element:
    """A page that stands for all pages of a wrapper, which is met ``times`` times."""
    top = Element("", PLAIN, [])
    todo: list[tuple[Element, Node]] = [(top, wrapper.root)]
    while todo:
        element, node = todo.pop()
        element.kids = stream_of(node.kids, times)
        of = iter(leaves(node))
        for e in element.kids:
            if not e.again and (n := next(of)).label != TEXT:
                todo.append((e, n))
    return top


def leaves(node: Node) -> Iterator[Node]:
    """The nodes below one, groups opened."""
    for k in node.kids:
        if k.label == GROUP:
            yield from leaves(k)
        else:
            yield k


def merge(wrappers: Iterable[tuple[bytes, int]]) -> Wrapper:
    """One wrapper of all that the given ones describe, each with the number of times it is met.

    The most frequent come first, equal ones by their bytes, so the order of the rows says nothing. If there are
    more than MOST_NODES nodes, those on the fewest pages are left out: a page's text there has no slot and goes by
    the node around it and the page's own elements below.
    """
    root, held = Node(""), 0
    for data, times in sorted(wrappers, key=lambda x: (-x[1], x[0])):
        w = Wrapper.load(data)
        align(root, rendered(w, times), [None], True)
        held += len(w.nodes)
        if held > MOST_NODES:
            held = prune(root, MOST_NODES)
    return Wrapper(root)


def prune(root: Node, most: int) -> int:
    """Halves a wrapper of more than ``most`` nodes by the pages that have them; returns how many there are."""
    found = list(walk(root))
    if len(found) <= most:
        return len(found)
    weight: dict[Node, int] = {}
    for node, parent in found:
        weight[node] = 1 << 62 if parent is None else min(node.weight, weight[parent])
    keep = {n for n, _ in sorted(found, key=lambda x: -weight[x[0]])[: most // 2]}
    for node in keep:
        node.kids = [k for k in node.kids if k in keep]
    for node, parent in reversed(found):
        if node.label == GROUP and node in keep and not node.kids:
            parent.kids.remove(node)
            keep.discard(node)
    return len(keep)


def blocks(texts: list[Text]) -> list[int]:
    """For each text a hash of 64 bits of what its whole block says, white space apart."""
    held: dict[int, list[str]] = {}
    for t in texts:
        held.setdefault(t.block, []).append(t.value)
    said = {b: int.from_bytes(blake2b(" ".join("".join(v).split()).encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True) for b, v in held.items()}
    return [said[t.block] for t in texts]


def lay(wrapper: Wrapper, stream: Element, texts: list[Text]) -> tuple[list[int], bool]:
    """The number of each text's slot, and whether the wrapper describes the page to the last token.

    A text that has no slot gets -2 less the number of the deepest node around it, and keeps what the elements between
    them say of it.
    """
    slots: list[Node | None] = [None] * len(texts)
    loose: list[tuple[Node, Element]] = []
    whole = align(wrapper.root, stream, slots, False, loose)
    out = [-1 if s is None else wrapper.number[s] for s in slots]
    for node, top in loose:
        todo = [(top, False, False, False)]
        while todo:
            e, aside, within, inside = todo.pop()
            if e.text >= 0:
                out[e.text] = -2 - wrapper.number[node]
                texts[e.text].aside, texts[e.text].within, texts[e.text].inside = aside, within, inside
                continue
            marked = e.mark == BESIDE_IT
            told = aside or marked or e.mark == HEADER and not inside, within or marked, inside or e.mark == ARTICLE
            todo += [(k, *told) for k in e.kids]
    return out, whole


def judge(wrapper: Wrapper, slots: Iterable[tuple[int, int, list[int]]]) -> None:
    """Tells what is beside the article from each slot's characters that are no literals, and its literals.

    An element that marks what is beside the article does so unless it holds more than half of what fills the host's
    slots, so a form or a class name around the whole page tells nothing. Slots in article or main elements are the
    main text where a host has such.
    """
    for slot, chars, said in slots:
        if slot >= 0:
            wrapper.nodes[slot].said = set(said)
        wrapper.nodes[slot if slot >= 0 else -2 - slot].chars += chars
    for node in reversed(wrapper.nodes):
        if (above := wrapper.parent[node]) is not None:
            above.chars += node.chars
    total = wrapper.root.chars
    for node in wrapper.nodes:
        if (above := wrapper.parent[node]) is not None:
            node.inside = above.inside or node.mark == ARTICLE
            tells = 2 * node.chars <= total or not total
            node.beside = above.beside or tells and (node.mark == BESIDE_IT or node.mark == HEADER and not above.inside)


def has_inside(wrapper: Wrapper) -> bool:
    return any(n.inside and not n.beside and (n.chars or n.said) for n in wrapper.nodes if n.label == TEXT)


def mains(wrapper: Wrapper, inside: bool, slots: Iterable[int]) -> list[int]:
    """Places of a page's texts that are the main text by their slots."""
    own = [i for i, s in enumerate(slots) if s >= 0 and not wrapper.nodes[s].beside]
    return inside and [i for i in own if wrapper.nodes[slots[i]].inside] or own


def core(wrapper: Wrapper) -> set[int]:
    """Nodes from the deepest one down that holds all that fills the main text's slots."""
    holds: set[Node] = set()
    for s in wrapper.main:
        node: Node | None = wrapper.nodes[s]
        while node is not None and node not in holds:
            holds.add(node)
            node = wrapper.parent[node]
    top = wrapper.root
    while True:
        inner = [k for k in top.kids if k.chars and not k.beside and k in holds]
        if len(inner) != 1 or inner[0].label == TEXT or inner[0].repeated:
            return {wrapper.number[n] for n, _ in walk(top)}
        top = inner[0]


def against(wrapper: Wrapper, inside: bool, under: set[int], slots: list[int], sizes: list[int], said: list[int]) -> tuple[bool, bool]:
    """Whether a page looks like a copy, as less than half of its text fills slots, and whether literals fill its main text."""
    literal = free = every = 0
    for i in mains(wrapper, inside, slots):
        known = said[i] in wrapper.nodes[slots[i]].said
        every += sizes[i]
        if slots[i] in under:
            literal, free = literal + sizes[i] * known, free + sizes[i] * (not known)
    return 2 * (literal + free) < every, 2 * literal >= literal + free


def settle(wrapper: Wrapper, under: set[int], pages: int, copies: int, filled: int) -> None:
    """Takes back literals where they can't be told from text that the pages share by chance.

    Literals among the main text count as the template's where SURE pages or more have them and more text besides; if
    less than half of the text fills slots, the pages are copies rather than fillings of a template, and nothing
    is literal. One page in REST may be otherwise.
    """
    copied, sure = copies * REST > pages, pages >= SURE and filled * REST <= pages
    for s in wrapper.main:
        if copied or s in under and not sure:
            wrapper.nodes[s].said = set()


def literal(slot: int, pages: int, of: int) -> bool:
    """Whether a text that so many of a host's different pages have in a slot is the template's."""
    return slot >= 0 and of > 1 and pages * REST >= of * (REST - 1)


def key_of(said: list[int]) -> bytes:
    """What tells pages that say the same."""
    return blake2b(np.unique(np.array(said, np.int64)).tobytes(), digest_size=16).digest()


def infer(pages: list[str]) -> Wrapper:
    """The wrapper of a host's pages, as ``extract_text`` makes it, each of its slots judged.

    The pages' token streams are aligned into one expression, and each page is laid along it. Pages that say the same
    count once. A text that all of several pages have in one slot, or nine tenths of ten and more, is a literal of
    the template, any other fills the slot.
    """
    parsed = [p for p in map(parse, pages) if p[1]]
    wrapper = merge(Counter(sketch(*p) for p in parsed).items())
    laid = {}
    for stream, texts in parsed:
        said = blocks(texts)
        laid.setdefault(key_of(said), (lay(wrapper, stream, texts)[0], [len(t.value) for t in texts], said))
    had, chars = Counter(), Counter()
    for slots, sizes, said in laid.values():
        had.update(set(zip(slots, said, strict=True)))
        for s, v, n in zip(slots, said, sizes, strict=True):
            chars[s, v] += n
    held: dict[int, tuple[int, list[int]]] = {}
    for (s, v), n in had.items():
        size, known = held.get(s, (0, []))
        held[s] = (size, [*known, v]) if literal(s, n, len(laid)) else (size + chars[s, v], known)
    judge(wrapper, ((s, *x) for s, x in held.items()))
    inside = has_inside(wrapper)
    wrapper.main = sorted({slots[i] for slots, _, _ in laid.values() for i in mains(wrapper, inside, slots)})
    under = core(wrapper)
    speak = [against(wrapper, inside, under, *page) for page in laid.values()]
    settle(wrapper, under, len(laid), sum(c for c, _ in speak), sum(f for _, f in speak))
    return wrapper


def chosen(wrapper: Wrapper, slots: list[int], said: list[int], texts: list[Text]) -> str:
    """Main text by the slots of a page's texts; those without a slot go by the node around and the elements below it."""
    own: list[tuple[Text, bool, bool]] = []
    for t, v, s in zip(texts, said, slots, strict=True):
        n = wrapper.nodes[s if s >= 0 else -2 - s]
        if s >= 0 and not n.beside:
            own.append((t, n.inside, v in n.said))
        elif s < 0 and not (n.beside or (t.within if n.inside else t.aside)):
            own.append((t, n.inside or t.inside, False))
    own = [x for x in own if x[1]] or own
    return join([t for t, _, known in own if not known] or [t for t, _, _ in own])


def main_text(page: str, wrapper: Wrapper | None) -> tuple[str, bool]:
    """Main text of a page by its host's wrapper, and whether the wrapper describes the page to the last token.

    Each text goes by the slot that the alignment gives it: beside the article, literal of the template, or main text.
    Texts for which the wrapper has no slot go by the deepest node around them and the page's own elements below it, so
    what the wrapper does not have stays, wherever it stands. Without a wrapper nothing is known of a text, and all stay.
    """
    stream, texts = parse(page)
    if wrapper is None:
        return join(texts), False
    slots, covered = lay(wrapper, stream, texts)
    return chosen(wrapper, slots, blocks(texts), texts), covered


MADE = pa.schema([("host", pa.string()), ("wrapper", pa.binary()), ("n", pa.int64())])
LAID = pa.schema([
    ("host", pa.string()), ("page_id", pa.int64()), ("url", pa.string()), ("key", pa.binary()), ("slots", pa.list_(pa.int32())), ("sizes", pa.list_(pa.int64())),
    ("said", pa.list_(pa.int64())), ("rest", pa.binary()), ("covered", pa.bool_()),
])
COUNTED = pa.schema([("host", pa.string()), ("slot", pa.int32()), ("said", pa.int64()), ("pages", pa.int64()), ("chars", pa.int64())])
MAIN = pa.schema([("host", pa.string()), ("slot", pa.int32())])
AGAINST = pa.schema([("host", pa.string()), ("pages", pa.int64()), ("copies", pa.int64()), ("filled", pa.int64())])
JUDGED = "host string, wrapper binary"


def table(rows: Iterable[tuple], schema: pa.Schema) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)


def lists(batch: pa.RecordBatch, *names: str) -> Iterator[tuple]:
    return zip(*(batch[n].to_pylist() for n in names), strict=True)


class Held:
    """Wrappers of the hosts met last, from ``known`` or from the rows."""

    def __init__(self, known: dict[str, bytes] | None = None):
        self.known, self.held = known, {}

    def rows(self, batch: pa.RecordBatch, more: Callable[[Wrapper], object] = lambda w: None) -> Iterator[tuple[Wrapper, object] | tuple[None, None]]:
        """The wrapper of each row's host, and what ``more`` says of it."""
        hosts = batch["host"].to_pylist()
        given = [self.known.get(h) for h in hosts] if self.known is not None else batch["wrapper"].to_pylist()
        for host, data in zip(hosts, given, strict=True):
            if data is None:
                yield None, None
                continue
            if host not in self.held:
                if len(self.held) >= 256:
                    self.held.clear()
                wrapper = Wrapper.load(data)
                self.held[host] = wrapper, more(wrapper)
            yield self.held[host]


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        met: Counter = Counter()
        for host, page in lists(batch, "host", "html"):
            stream, texts = parse(page)
            if texts:
                met[host, sketch(stream, texts)] += 1
        yield table([(*x, n) for x, n in met.items()], MADE)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield table([(host, merge((x["wrapper"], x["n"]) for x in some).dump(), 1) for host, some in lists(batch, "host", "some")], MADE)


def _lay(known: dict[str, bytes] | None, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = Held(known)
    for batch in batches:
        rows = []
        for (host, page_id, url, page), (wrapper, _) in zip(lists(batch, "host", "page_id", "url", "html"), held.rows(batch), strict=True):
            stream, texts = parse(page or "")
            said = blocks(texts)
            slots, whole = lay(wrapper, stream, texts) if wrapper is not None else ([-1] * len(texts), False)
            rest = pickle.dumps([(t.value, t.block, t.aside, t.inside, t.within) for t in texts])
            rows.append((host, page_id, url, key_of(said) if texts else None, slots, [len(t.value) for t in texts], said, rest, whole))
        yield table(rows, LAID)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        met: dict[tuple[str, int, int], list[int]] = {}
        for host, slots, sizes, said in lists(batch, "host", "slots", "sizes", "said"):
            own: Counter = Counter()
            for s, v, n in zip(slots, said, sizes, strict=True):
                own[s, v] += n
            for (s, v), n in own.items():
                x = met.setdefault((host, s, v), [0, 0])
                x[0] += 1
                x[1] += n
        yield table([(*k, *x) for k, x in met.items()], COUNTED)


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = []
        for data, slots in lists(batch, "wrapper", "slots"):
            wrapper = Wrapper.load(data)
            judge(wrapper, ((x["slot"], x["chars"], x["said"]) for x in slots or ()))
            made.append(wrapper.dump())
        yield pa.RecordBatch.from_arrays([batch["host"], pa.array(made, pa.binary())], ["host", "wrapper"])


def _mains(known: dict[str, bytes] | None, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = Held(known)
    for batch in batches:
        met: set[tuple[str, int]] = set()
        for (host, slots), (wrapper, inside) in zip(lists(batch, "host", "slots"), held.rows(batch, has_inside), strict=True):
            met |= {(host, slots[i]) for i in mains(wrapper, inside, slots)}
        yield table(met, MAIN)


def _core(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = []
        for data, main in lists(batch, "wrapper", "main"):
            wrapper = Wrapper.load(data)
            wrapper.main = main or []
            made.append(wrapper.dump())
        yield pa.RecordBatch.from_arrays([batch["host"], pa.array(made, pa.binary())], ["host", "wrapper"])


def _against(known: dict[str, bytes] | None, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = Held(known)
    for batch in batches:
        met: dict[str, list[int]] = {}
        found = held.rows(batch, lambda w: (has_inside(w), core(w)))
        for (host, *page), (wrapper, told) in zip(lists(batch, "host", "slots", "sizes", "said"), found, strict=True):
            x = met.setdefault(host, [0, 0, 0])
            for i, n in enumerate((1, *against(wrapper, *told, *page))):
                x[i] += n
        yield table([(h, *x) for h, x in met.items()], AGAINST)


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = []
        for data, *speak in lists(batch, "wrapper", "pages", "copies", "filled"):
            wrapper = Wrapper.load(data)
            if speak[0] is not None:
                settle(wrapper, core(wrapper), *speak)
            made.append(wrapper.dump())
        yield pa.RecordBatch.from_arrays([batch["host"], pa.array(made, pa.binary())], ["host", "wrapper"])


def _extract(known: dict[str, bytes] | None, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = Held(known)
    for batch in batches:
        out = []
        for (slots, said, rest), (wrapper, _) in zip(lists(batch, "slots", "said", "rest"), held.rows(batch), strict=True):
            texts = [Text(*t) for t in pickle.loads(rest)]
            out.append(join(texts) if wrapper is None else chosen(wrapper, slots, said, texts))
        yield pa.RecordBatch.from_arrays([batch["page_id"], batch["url"], pa.array(out, pa.string()), batch["covered"]], ["page_id", "url", "text", "covered"])


def by_host(df: DataFrame, hosts: DataFrame, small: bool, *salt: str) -> DataFrame:
    """``df`` with the columns of its hosts; a host's rows are dealt apart where the hosts are too many to send."""
    if small:
        return df.join(F.broadcast(hosts), "host", "left")
    dealt = hosts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return df.withColumn("salt", F.pmod(F.xxhash64(*salt), F.lit(SALTS)).cast("int")).join(dealt, ["host", "salt"], "left").drop("salt")


def is_small(hosts: DataFrame) -> bool:
    return (hosts.agg(F.sum(F.octet_length("wrapper") + F.octet_length("host"))).first()[0] or 0) <= BROADCAST_BYTES


def with_wrapper(df: DataFrame, hosts: DataFrame, run: Callable, schema, *salt: str) -> DataFrame:
    """``run`` over all rows beside their hosts' wrappers: workers get all of them once, or each row its own."""
    if is_small(hosts):
        return arrow(df, partial(run, {r.host: bytes(r.wrapper) for r in hosts.collect()}), schema)
    return arrow(by_host(df, hosts, False, *salt), partial(run, None), schema)


def host_wrappers(pages: DataFrame) -> DataFrame:
    """One wrapper a host (``host, wrapper``) of all its pages (``host, html``), not yet judged.

    Each page's own wrapper is made; those that are the same count as one with its number of pages, and FAN at a time
    are merged, dealt by their hashes, until a host has one.
    """
    shape = "host string, wrapper binary, n long"
    made = stage_table(pages.where("html is not null").select("host", "html").transform(arrow, _sketches, shape).groupBy("host", "wrapper").agg(F.sum("n").alias("n")), "sketches")
    last = False
    while not last:
        many = made.groupBy("host").count().where(F.col("count") > FAN)
        last = many.isEmpty()
        dealt = made.withColumn("part", F.lit(0).cast("long"))
        if not last:
            parts = many.select("host", F.ceil(F.col("count") / FAN).alias("parts"))
            dealt = made.join(F.broadcast(parts), "host", "left").withColumn("part", F.pmod(F.xxhash64("wrapper"), F.coalesce("parts", F.lit(1).cast("long"))))
        some = dealt.groupBy("host", "part").agg(F.collect_list(F.struct("wrapper", "n")).alias("some"))
        made = stage_table(some.select("host", "some").transform(arrow, _merge, shape), "wrappers")
    return made.select("host", "wrapper")


def judged_wrappers(made: DataFrame, laid: DataFrame) -> DataFrame:
    """The wrappers with their slots judged by all different pages of each host."""
    once = laid.where("key is not null").groupBy("host", "key").agg(F.min(F.struct("slots", "sizes", "said")).alias("p"))
    once = stage_table(once.select("host", "key", "p.*"), "once")
    counted = once.drop("key").transform(arrow, _count, "host string, slot int, said long, pages long, chars long")
    counted = counted.groupBy("host", "slot", "said").agg(F.sum("pages").alias("pages"), F.sum("chars").alias("chars"))
    counted = by_host(counted, once.groupBy("host").agg(F.count("*").alias("of")), is_small(made), "slot", "said")
    known = (F.col("slot") >= 0) & (F.col("of") > 1) & (F.col("pages") * REST >= F.col("of") * (REST - 1))
    slots = counted.groupBy("host", "slot").agg(F.sum(F.when(known, 0).otherwise(F.col("chars"))).alias("chars"), F.collect_list(F.when(known, F.col("said"))).alias("said"))
    slots = slots.groupBy("host").agg(F.collect_list(F.struct("slot", "chars", "said")).alias("slots"))
    judged = stage_table(made.join(slots, "host", "left").transform(arrow, _judge, JUDGED), "judged")
    main = with_wrapper(once, judged, _mains, "host string, slot int", "key").distinct().groupBy("host").agg(F.array_sort(F.collect_list("slot")).alias("main"))
    judged = stage_table(judged.join(main, "host", "left").transform(arrow, _core, JUDGED), "main")
    speak = with_wrapper(once, judged, _against, "host string, pages long, copies long, filled long", "key")
    speak = speak.groupBy("host").agg(*(F.sum(c).alias(c) for c in ("pages", "copies", "filled")))
    return stage_table(judged.join(speak, "host", "left").transform(arrow, _settle, JUDGED), "settled")


def extract_text(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Main text of every page: ``page_id, url, text, n_chars, covered``.

    For each host a wrapper is inferred from all its pages by aligning their token streams, whole pages each. Every
    page is then laid along its host's wrapper, its slots are judged by what all of the host's different pages have in
    them, and the text is read from the slots: menus, headers, footers, sidebars, notices, adverts, forms, comments,
    scripts and styles are left out, character references decoded, white space turned into blanks, and blocks joined by
    line feeds. ``covered`` says whether the wrapper describes the page from the first token to the last.

    A null page is empty, an empty page has no text; a null or odd url is a host of its own kind, and a host of one
    page has a wrapper of that page. A very long page is read whole, as one row. Neither the order of the rows nor ids
    matter. Repeated rows are each extracted, and count once for their host; other columns are ignored.
    """
    prepare(pages.sparkSession)
    host = F.lower(F.coalesce(F.regexp_extract(url_col, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))
    plain = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), host.alias("host"))
    made = host_wrappers(plain)
    laid = "host string, page_id long, url string, key binary, slots array<int>, sizes array<long>, said array<long>, rest binary, covered boolean"
    laid = stage_table(with_wrapper(plain, made, _lay, laid, "page_id", "url"), "laid")
    found = with_wrapper(laid, judged_wrappers(made, laid), _extract, "page_id long, url string, text string, covered boolean", "page_id", "url")
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"), "covered")
