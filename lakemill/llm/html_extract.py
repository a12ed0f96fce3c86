"""Main text of web pages by wrappers that are inferred for each host.

A page is a stream of tags and texts. Repeats that stand next to each other are folded into repeated groups. The folded
streams of a host are aligned one after the other into one union-free regular expression, its wrapper: what only some
pages have becomes an optional group, what repeats a repeated one, and a text that is not the same on all pages a slot.
A text that stays the same on every page is the host's template, whatever its element is called.

A page is then matched with its host's wrapper, which tells each of its texts the place of the wrapper that it fills.
Kept are the slots of the article or main element if the page has one, else all slots outside navigation; template text
and page furniture go. Inside an article element nothing is taken for template, as the element itself says what it is.

A host may hold a third of all pages. Pages of one structure are merged by a plain aggregation first; the structures of
a host are merged in rounds of bounded groups; wrappers reach the pages by broadcast where their size allows it, which
is measured, and else by a join that deals hot hosts by salt.
"""

from __future__ import annotations

import html
import json
import re
from collections.abc import Iterator
from hashlib import blake2b
from zlib import crc32

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemill.llm.common import cut, every_salt, salt_of, small_batches, text_or_empty

#: Fixed values of HTML: elements without an end, elements that lay out blocks, elements whose content is no markup.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul".split()
)
RAW = "script|style|noscript|template|iframe|textarea|svg|object"
#: Elements, and words in class, id or role, of what is not the article.
FURNITURE = frozenset("head title nav footer aside form button select option input label dialog menu canvas audio video".split())
FURNITURE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies copyright disclaimer "
    "discussion footer form login masthead menu modal nav navbar navigation newsletter notice notices pagination pager popup promo promoted related "
    "replies respond search share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)
#: What an article element's own class may say of it: that it is not the article, but a reader's or another one.
OTHERS = frozenset("comment comments replies respond related promo promoted sponsored".split())
#: Words of furniture that do not count for an element that holds most of a page's text, as a form around a whole page or
#: a "share-price-report" does. A discussion may well be longer than what it is about.
WEAK_WORDS = FURNITURE_WORDS - OTHERS - {"discussion"}
#: What is not shown.
HIDDEN = "hidden-element"
_HIDDEN = re.compile(r"(?<![\w-])hidden(?![\w-])(?!\s*=\s*[\"']?until)|display\s*:\s*none", re.IGNORECASE)
#: Furniture unless it stands inside the article.
HEADS = frozenset("header".split())
MAIN = frozenset("article main".split())

#: Attributes up to the end of a tag, which is >, the next <, or the end of the page; a quote that is never closed is a sign
#: like any other. No part can be read in two ways, so a page is read in one pass.
_REST = r"(?:\"[^\"]*\"|'[^']*'|[^'\"<>]|[\"'])*+"
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})\b(?!(?<=svg)[^<>]*/>){_REST}>?.*?(?:</(?P=raw)\s*>|\Z)|<[!?][^>]*(?:>|\Z)"
    rf"|<(?P<end>/?)(?P<tag>[a-z][^\s/<>]*)(?P<rest>{_REST})>?|(?P<text>[^<]+|<)",
    re.IGNORECASE | re.DOTALL,
)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
SLOT = "#"


def read(page: str) -> Iterator[tuple[str, str, str]]:
    """A page's tokens: ("open", symbol, tag), ("close", "/" + tag, tag) or ("text", "#", text). A symbol is the tag with
    the words of its class, id and role; numbers of three digits or more, which count pages, are left out."""
    for m in _TOKEN.finditer(page):
        if m["text"] is not None:
            yield "text", SLOT, m["text"]
        elif m["tag"] is not None:
            tag = m["tag"].lower()
            if m["end"]:
                yield "close", f"/{tag}", tag
            else:
                names = {w for found in _NAMES.findall(m["rest"]) for w in re.split(r"[^a-z0-9]+|[0-9]{3,}", "".join(found).lower()) if w} if "=" in m["rest"] else ()
                hidden = [HIDDEN] if ("idden" in m["rest"] or "none" in m["rest"]) and tag != "input" and _HIDDEN.search(_NAMES.sub("", m["rest"])) else []
                yield "open", ".".join([tag, *sorted(names), *hidden]), tag


def weighed(tokens: list[tuple[str, str, str]]) -> list[tuple[str, str, str]]:
    """read() tokens in which forms and elements of weak words that hold most of the text are plain elements."""
    doubtful = {i for i, (kind, symbol, tag) in enumerate(tokens) if kind == "open" and (tag == "form" or not WEAK_WORDS.isdisjoint(symbol.split(".")[1:]))}
    if not doubtful:
        return tokens
    opened: dict[str, list[int]] = {}
    weight, starts, out = 0, {}, list(tokens)
    spans: list[tuple[int, int]] = []
    for i, (kind, _, value) in enumerate(tokens):
        if kind == "text":
            weight += len(value.strip())
        elif kind == "open" and value not in VOID:
            opened.setdefault(value, []).append(i)
            starts[i] = weight
        elif kind == "close" and opened.get(value):
            first = opened[value].pop()
            if first in doubtful:
                spans.append((first, weight - starts[first]))
    spans += [(i, weight - starts[i]) for own in opened.values() for i in own if i in doubtful]
    for i, own in spans:
        if 2 * own > weight:
            tag, *words = tokens[i][1].split(".")
            out[i] = "open", ".".join(["div" if tag == "form" else tag, *(w for w in words if w not in WEAK_WORDS)]), tokens[i][2]
    return out


#: What a text is: furniture or template, outside the article element, or inside it.
GONE, FREE, ARTICLE = 0, 1, 2


class Place:
    """Where in a page something stands: a name for the elements around it, and what they say of a text in them."""

    __slots__ = ("article", "gone", "inside", "inner", "name")

    def __init__(self, number: int = 0, gone: bool = False, inside: bool = False, article: bool = False) -> None:
        self.gone, self.inside, self.article = gone, inside, article
        self.name = f"{number:08x}{GONE if gone else ARTICLE if inside else FREE}{'a' * article}"
        self.inner: dict[str, Place] = {}

    def into(self, symbol: str) -> Place:
        """The place inside an element of this symbol."""
        found = self.inner.get(symbol)
        if found is None:
            tag, *words = symbol.split(".")
            names, gone, inside = set(words), self.gone, self.inside
            if HIDDEN in names or tag == "article" and self.article:
                gone = True  # an article inside an article is what a reader says of it
            elif tag in MAIN and not names & OTHERS:
                inside = True
            elif tag not in ("html", "body"):
                gone = gone or tag in FURNITURE or bool(names & FURNITURE_WORDS) or not inside and (tag in HEADS or bool(names & HEADS))
                inside = inside or "main" in names
            found = self.inner[symbol] = Place(crc32(symbol.encode(), crc32(self.name.encode())), gone, inside, self.article or tag == "article" and inside)
        return found


def kind_of(place: str) -> int:
    """What a text is by the elements around it, as the name of its place says."""
    return int(place[8])


def placed(page: str) -> Iterator[tuple[str, str, str]]:
    """read(), with the name of the place in which each token stands instead of its kind; ends that HTML implies are
    made: a block element ends an open paragraph, an item the item before it, an end tag all that is open inside its
    element. A token takes the same time at any depth, so pages that nest without end are read in one pass too."""
    stack: list[tuple[str, Place]] = []
    last: dict[str, list[int]] = {}
    blocks: list[int] = []
    here = Place()

    def cut_to(depth: int) -> None:
        nonlocal here
        while len(stack) > depth:
            tag, here = stack.pop()
            last[tag].pop()
            if tag in BLOCK:
                blocks.pop()

    for kind, symbol, value in weighed(list(read(page))):
        if kind == "open":
            if value in BLOCK and blocks:
                top = stack[blocks[-1]][0]
                if top == "p" or top == value in ("li", "dt", "dd", "tr", "td", "th"):
                    cut_to(blocks[-1])
            yield symbol, here.name, value
            if value not in VOID:
                last.setdefault(value, []).append(len(stack))
                if value in BLOCK:
                    blocks.append(len(stack))
                stack.append((value, here))
                here = here.into(symbol)
        elif kind == "close":
            if last.get(value):
                cut_to(last[value][-1])
                yield symbol, here.name, value
        else:
            yield symbol, here.name, value


# A wrapper is a tuple of nodes: a tag's symbol; a text (SLOT, place, literal, pages), whose literal is the hash of the
# text that all of so many pages have there, or None where they differ; a repeated group ("+", nodes); an optional
# group ("?", nodes).


def shape(node: object) -> object:
    """A node without its literals."""
    if isinstance(node, str):
        return node
    return node[:2] if node[0] == SLOT else (node[0], tuple(map(shape, node[1])))


def _paired(a: object, b: object, one_page: bool) -> object:
    """Two nodes of one shape as one. On one page a repeated text is the sequence of its texts; on several pages it stays
    a literal only if they agree."""
    if isinstance(a, str):
        return a
    if a[0] != SLOT:
        return a[0], tuple(_paired(x, y, one_page) for x, y in zip(a[1], b[1], strict=True))
    if one_page:
        return SLOT, a[1], hash((a[2], b[2])), 1
    return SLOT, a[1], a[2] if a[2] == b[2] else None, a[3] + b[3]


def folded(stream: list) -> tuple:
    """The stream with adjacent repeats, the shortest first, turned into groups ("+", unit).

    A repeat of any length is found by the distance from one of its nodes to the next node of the same shape.
    """
    seq, numbers = list(stream), {}
    ids = [numbers.setdefault(shape(x), len(numbers)) for x in seq]
    tried = 0
    while True:
        last, distances = {}, set()
        for i, x in enumerate(ids):
            if x in last and i - last[x] > tried:
                distances.add(i - last[x])
            last[x] = i
        for unit in sorted(distances):
            out, new, i, found = [], [], 0, False
            while i < len(seq):
                n = 1
                while i + (n + 1) * unit <= len(ids) and ids[i] == ids[i + n * unit] and ids[i : i + unit] == ids[i + n * unit : i + (n + 1) * unit]:
                    n += 1
                if n == 1:
                    out.append(seq[i])
                    new.append(ids[i])
                    i += 1
                    continue
                found, group = True, seq[i : i + unit]
                for k in range(1, n):
                    group = [_paired(x, y, True) for x, y in zip(group, seq[i + k * unit : i + (k + 1) * unit], strict=True)]
                node = group[0] if unit == 1 and group[0][0] == "+" else ("+", tuple(group))
                out.append(node)
                new.append(numbers.setdefault(shape(node), len(numbers)))
                i += n * unit
            tried = unit
            if found:
                seq, ids, tried = out, new, 0
                break
        else:
            return tuple(seq)


def _bare(node: object) -> tuple:
    """What an optional group holds, or the node itself as a run of one."""
    return node[1] if node[0] == "?" and isinstance(node, tuple) else (node,)


def _is(node: object, kind: str) -> bool:
    return isinstance(node, tuple) and node[0] == kind


def aligned(a: tuple, b: tuple) -> tuple:
    """The expression that covers both: nodes in common stay, others become optional, repeats of unequal units align
    their units. What both begin and end with needs no search."""
    sa, sb = tuple(map(shape, a)), tuple(map(shape, b))
    if sa == sb:
        return tuple(_paired(x, y, False) for x, y in zip(a, b, strict=True))
    # An optional or repeated group at the edge might serve for more than one node; those are left to the search.
    plain = lambda x: isinstance(x, str) or x[0] == SLOT
    head = 0
    while head < min(len(a), len(b)) and sa[head] == sb[head] and plain(a[head]):
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and sa[-1 - tail] == sb[-1 - tail] and plain(a[-1 - tail]):
        tail += 1
    begin = tuple(_paired(x, y, False) for x, y in zip(a[:head], b[:head], strict=True))
    end = tuple(_paired(x, y, False) for x, y in zip(a[len(a) - tail :], b[len(b) - tail :], strict=True))
    middle = slice(head, len(a) - tail), slice(head, len(b) - tail)
    return begin + _searched(a[middle[0]], b[middle[1]], sa[middle[0]], sb[middle[1]]) + end


def _searched(a: tuple, b: tuple, sa: tuple, sb: tuple) -> tuple:
    """aligned() by dynamic programming; sa and sb are the shapes."""
    n, m = len(a), len(b)
    ba, bb = [_bare(x) for x in sa], [_bare(x) for x in sb]
    units = [[x[0][1] if len(x) == 1 and _is(x[0], "+") else () for x in side] for side in (ba, bb)]
    best = [[0.0] * (m + 1) for _ in range(n + 1)]
    move = [[""] * (m + 1) for _ in range(n + 1)]
    for i in range(n, -1, -1):
        for j in range(m, -1, -1):
            top, how = -1.0, ""
            if i < n:
                top, how = best[i + 1][j], "a"
            if j < m and best[i][j + 1] > top:
                top, how = best[i][j + 1], "b"
            if i < n and j < m:
                x, y, u, v = ba[i], bb[j], units[0][i], units[1][j]
                same = 2.0 if x == y else 1.0 if u and v and u[0] == v[0] else 0.0
                if same and best[i + 1][j + 1] + same > top:
                    top, how = best[i + 1][j + 1] + same, "="
                if u and sb[j : j + len(u)] == u and best[i + 1][j + len(u)] + 1.5 > top:
                    top, how = best[i + 1][j + len(u)] + 1.5, f"A{len(u)}"
                if v and sa[i : i + len(v)] == v and best[i + len(v)][j + 1] + 1.5 > top:
                    top, how = best[i + len(v)][j + 1] + 1.5, f"B{len(v)}"
            if how:
                best[i][j], move[i][j] = top, how
    out: list = []
    i = j = 0

    def once(group: object, run: tuple) -> object:
        """A repeated group, optional or not, that a run of its nodes joins."""
        unit = tuple(_paired(x, y, False) for x, y in zip(_bare(group)[0][1], run, strict=True))
        return ("?", (("+", unit),)) if group[0] == "?" else ("+", unit)

    while i < n or j < m:
        step = move[i][j]
        if step == "=":
            x, y = _bare(a[i]), _bare(b[j])
            node = tuple(_paired(u, v, False) for u, v in zip(x, y, strict=True)) if ba[i] == bb[j] else (("+", aligned(x[0][1], y[0][1])),)
            out.append(("?", node)) if _is(a[i], "?") or _is(b[j], "?") else out.extend(node)
            i, j = i + 1, j + 1
        elif step[0] == "A":
            k = int(step[1:])
            out.append(once(a[i], b[j : j + k]))
            i, j = i + 1, j + k
        elif step[0] == "B":
            k = int(step[1:])
            out.append(once(b[j], a[i : i + k]))
            i, j = i + k, j + 1
        else:
            node = a[i] if step == "a" else b[j]
            out.append(node if _is(node, "?") else ("?", (node,)))
            i, j = i + (step == "a"), j + (step == "b")
    return tuple(out)


def _tuples(x: object) -> object:
    return tuple(map(_tuples, x)) if isinstance(x, list) else x


def wrapper_of(streams: list[str]) -> str:
    """The wrapper of some streams or wrappers, as JSON; the order of the streams is by text, so reruns agree."""
    found = [_tuples(json.loads(s)) for s in sorted(streams)]
    whole = found[0]
    for other in found[1:]:
        whole = aligned(whole, other)
    return json.dumps(whole, ensure_ascii=False)


class Automaton:
    """A wrapper as an automaton whose states are the places of its symbols and texts, in order.

    match() finds a path for a page's symbols. The sets of states that a symbol leads to are worked out once and
    remembered, so a page takes two look-ups for each symbol: forwards to the sets, backwards to the path.
    """

    def __init__(self, wrapper: tuple, known: int = 100_000) -> None:
        self.symbols: list[str] = []
        self.nodes: list[object] = []
        self.follow: list[set[int]] = []
        self.known = known

        def state(node: object) -> int:
            self.symbols.append(node if isinstance(node, str) else SLOT + node[1])
            self.nodes.append(node)
            self.follow.append(set())
            return len(self.symbols) - 1

        def walk(nodes: tuple) -> tuple[set[int], set[int], bool]:
            """The states that a run of nodes may begin with and end with, and whether it may be empty."""
            first, last, empty = set(), set(), True
            for node in nodes:
                if isinstance(node, str) or node[0] == SLOT:
                    one = {state(node)}
                    begun, ended, none = one, one, False
                else:
                    begun, ended, none = walk(node[1])
                    if node[0] == "+":
                        for s in ended:
                            self.follow[s] |= begun
                    none = none or node[0] == "?"
                for s in last:
                    self.follow[s] |= begun
                first = first | begun if empty else first
                last = last | ended if none else ended
                empty = empty and none
            return first, last, empty

        state("")
        first, last, empty = walk(wrapper)
        self.follow[0] |= first
        self.ends = last | {0} if empty else last
        self.sets: list[frozenset[int]] = [frozenset([0])]
        self.numbers = {self.sets[0]: 0}
        self.forward: dict[tuple[int, str], int] = {}
        self.back: dict[tuple[int, int], int] = {}

    def match(self, symbols: list[str]) -> list[int] | None:
        """The state of each symbol, or None if the wrapper does not cover the page."""
        if len(self.forward) + len(self.back) > self.known:
            self.sets, self.numbers, self.forward, self.back = self.sets[:1], {self.sets[0]: 0}, {}, {}
        at, path = 0, [0]
        for symbol in symbols:
            to = self.forward.get((at, symbol))
            if to is None:
                found = frozenset(t for s in self.sets[at] for t in self.follow[s] if self.symbols[t] == symbol)
                to = self.numbers.setdefault(found, len(self.sets))
                if to == len(self.sets):
                    self.sets.append(found)
                self.forward[at, symbol] = to
            path.append(at := to)
        state = min((s for s in self.sets[at] if s in self.ends), default=None)
        if state is None:
            return None
        out = [state]
        for k in range(len(symbols) - 1, 0, -1):
            before = self.back.get((path[k], state))
            if before is None:
                before = self.back[path[k], state] = min(s for s in self.sets[path[k]] if state in self.follow[s])
            out.append(state := before)
        return out[::-1]


def kinds(automaton: Automaton, least: int = 3) -> list[int]:
    """By state what its text is. A literal of at least so many pages is template, unless an article element holds it, or
    the wrapper has no slot that differs from page to page: then its pages are copies, which tell nothing."""
    places = [n[1] if _is(n, SLOT) else None for n in automaton.nodes]
    plain = [GONE if p is None else kind_of(p) for p in places]
    differing = any(k != GONE and n[2] is None for k, n in zip(plain, automaton.nodes, strict=True))
    in_article = [p is not None and p.endswith("a") for p in places]
    template = [differing and not a and k != GONE and n[2] is not None and n[3] >= least for a, k, n in zip(in_article, plain, automaton.nodes, strict=True)]
    return [GONE if t else k for t, k in zip(template, plain, strict=True)]


def _symbols(tokens: list[tuple[str, str, str]]) -> list[str]:
    """A page's symbols; a text's is SLOT with its place, and texts of white space have none."""
    return [s + place if s == SLOT else s for s, place, value in tokens if s != SLOT or not value.isspace()]


def text_of(page: str, automaton: Automaton | None = None, found: list[int] | None = None) -> str:
    """The text of a page: references decoded, white space inside a block made one blank, a line for each block.

    Without a wrapper, or if it does not cover the page, the elements around a text decide alone.
    """
    tokens = list(placed(page))
    states = iter(automaton.match(_symbols(tokens)) or ()) if automaton else iter(())
    marked: list[int] = []
    for symbol, place, value in tokens:
        kind = -1
        if symbol != SLOT or not value.isspace():
            state = next(states, None)
            if symbol == SLOT:
                kind = kind_of(place) if state is None else found[state]
        marked.append(kind)
    # The article element's text, unless it is but a teaser beside what the page says.
    weight = {kind: sum(len(v.strip()) for (s, _, v), k in zip(tokens, marked, strict=True) if k == kind and s == SLOT) for kind in (FREE, ARTICLE)}
    wanted = ARTICLE if weight[ARTICLE] and 3 * weight[ARTICLE] >= weight[FREE] else FREE
    blocks: list[str] = []
    run: list[str] = []

    def close() -> None:
        if run and (text := " ".join(html.unescape("".join(run)).split())):
            blocks.append(text)
        run.clear()

    for (symbol, _, value), kind in zip(tokens, marked, strict=True):
        if symbol == SLOT:
            if kind == wanted:
                run.append(value)
            elif kind == -1 and run:
                run.append(" ")
        elif value in BLOCK:
            close()
        elif value == "br" and run:
            run.append("\n")
    close()
    return "\n".join(blocks)


def stream_of(page: str) -> tuple[tuple, list[int]]:
    """A page's folded stream, and the literals of its texts in the order of its slots."""
    seq = []
    for symbol, place, value in placed(page):
        if symbol != SLOT:
            seq.append(symbol)
        elif not value.isspace():
            text = " ".join(value.split()).encode("utf-8", "surrogatepass")
            seq.append((SLOT, place, int.from_bytes(blake2b(text, digest_size=8).digest(), "big", signed=True), 1))
    stream = folded(seq)
    return stream, [n[2] for n in _slots(stream)]


def _slots(nodes: tuple) -> Iterator[tuple]:
    for node in nodes:
        if _is(node, SLOT):
            yield node
        elif not isinstance(node, str):
            yield from _slots(node[1])


def _filled(nodes: tuple, literals: Iterator[int | None], pages: int) -> tuple:
    """The stream with its slots' literals set anew, in order."""
    return tuple(n if isinstance(n, str) else (SLOT, n[1], next(literals), pages) if n[0] == SLOT else (n[0], _filled(n[1], literals, pages)) for n in nodes)


def wrappers(pages: DataFrame, fan: int = 32) -> DataFrame:
    """(host, wrapper) of pages(host, html).

    Pages of a host that have one structure are merged by an aggregation over their slots; which pages a task meets
    together makes no difference. The host's structures are then merged in rounds, in groups of about `fan` by hash.
    """

    def structures(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            held: dict[tuple[str, str], list] = {}
            for host, page in zip(batch["host"], batch["html"], strict=True):
                stream, literals = stream_of(page)
                key = host, json.dumps(_filled(stream, iter([0] * len(literals)), 0), ensure_ascii=False)
                own = held.get(key)
                if own is None:
                    held[key] = [1, list(literals), list(literals)]
                else:
                    own[0] += 1
                    own[1], own[2] = list(map(min, own[1], literals)), list(map(max, own[2], literals))
            rows = [(h, s, n, low, high) for (h, s), (n, low, high) in held.items()]
            yield pd.DataFrame(rows, columns=["host", "structure", "pages", "low", "high"])

    def filled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for structure, literals, pages_ in zip(batch["structure"], batch["literals"], batch["pages"], strict=True):
                found = iter([x["low"] if x["same"] else None for x in literals if x["slot"] is not None])
                out.append(json.dumps(_filled(_tuples(json.loads(structure)), found, int(pages_)), ensure_ascii=False))
            yield pd.DataFrame({"host": batch["host"], "stream": out})

    def merged(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"host": rows["host"].iloc[:1], "stream": [wrapper_of(rows["stream"].tolist())]})

    schema = "host string, stream string"
    met = pages.select("host", "html").mapInPandas(structures, "host string, structure string, pages bigint, low array<bigint>, high array<bigint>")
    met = cut(met.withColumn("key", F.unhex(F.sha2("structure", 256))))
    slots = met.select("host", "key", F.posexplode_outer(F.arrays_zip("low", "high")).alias("slot", "x"))
    slots = slots.groupBy("host", "key", "slot").agg(F.min("x.low").alias("low"), F.max("x.high").alias("high"))
    slots = slots.groupBy("host", "key").agg(F.array_sort(F.collect_list(F.struct("slot", "low", (F.col("low") == F.col("high")).alias("same")))).alias("literals"))
    kinds_ = met.groupBy("host", "key").agg(F.any_value("structure").alias("structure"), F.sum("pages").alias("pages"))
    found = cut(kinds_.join(slots, ["host", "key"]).select("host", "structure", "literals", "pages").mapInPandas(filled, schema))
    most = found.groupBy("host").count().agg(F.max("count")).first()[0] or 0
    while most > 1:
        most = -(-most // fan)
        part = F.pmod(F.xxhash64("stream"), F.lit(most)).alias("part")
        found = cut(found.groupBy("host", part).applyInPandas(merged, schema))
    return found.withColumnRenamed("stream", "wrapper")


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", broadcast_bytes: int = 32 << 20) -> DataFrame:
    """(page_id, url, text, n_chars), one row for each row of pages, from the whole page.

    Null html counts as empty; a page without article text has the empty text. Pages whose url is null or names no
    host have no wrapper. Ids and urls are carried through, also null and repeated ones; repeated rows count as pages of
    their own, so copies of a page alone never make it template; an empty table gives an empty result; other columns are
    not read. Markup that breaks off is read as far as it goes. Wrappers are broadcast if they take no more than
    broadcast_bytes.
    """
    small_batches(pages.sparkSession)
    host = F.lower(F.coalesce(F.regexp_extract(F.col(url_col), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.make_valid_utf8(text_or_empty(html_col)).alias("html"), host.alias("host"))
    known = wrappers(rows.where("host <> ''"))
    kind = rows.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, tuple[Automaton, list[int]]] = {}
        for batch in batches:
            texts = []
            for page, wrapper in zip(batch["html"], batch["wrapper"], strict=True):
                if wrapper is None:
                    texts.append(text_of(page))
                    continue
                if wrapper not in held:
                    if len(held) >= 200:
                        held.clear()
                    automaton = Automaton(_tuples(json.loads(wrapper)))
                    held[wrapper] = automaton, kinds(automaton)
                texts.append(text_of(page, *held[wrapper]))
            yield pd.DataFrame({"page_id": batch["page_id"], "url": batch["url"], "text": texts})

    size = known.agg(F.sum(F.octet_length("wrapper") + F.octet_length("host"))).first()[0] or 0
    if size <= broadcast_bytes:
        told = rows.join(F.broadcast(known), "host", "left")
    else:
        told = rows.withColumn("salt", salt_of("html")).join(known.select("host", "wrapper", every_salt()), ["host", "salt"], "left")
    found = told.select("page_id", "url", "html", "wrapper").mapInPandas(run, f"page_id {kind}, url string, text string")
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
