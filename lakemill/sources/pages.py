"""Facts from web pages: names listed under headings, who speaks at an anchor, keywords. One page at a time; a page that is
broken is read as far as it goes."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: What a heading of a list of candidates says, elements without content, and words that are no keywords.
HEADING = re.compile(r"candidat|déclaré|pressenti|en lice", re.IGNORECASE)
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
NO_KEYWORDS = frozenset("les de cette réunion reunion mot mots clé cle".split())
KEYWORD_HEAD = re.compile(r"^(?:mots\s+clés|mots\s+cles|mot-clé|mot-cle|clés|cles)\s*[:\-]?\s*", re.IGNORECASE)

SPEAKER_CHARS, LEAST_NAME, LEAST_LINK, MOST_KEYWORDS = 220, 3, 5, 8


@dataclass
class Node:
    """An element, its attributes, and its texts and elements in order."""

    name: str
    attributes: dict[str, str | None]
    parent: Node | None = None
    parts: list[Node | str] = field(default_factory=list)

    def below(self) -> Iterator[Node]:
        """All elements below, in the order of the page; no recursion, as pages may be nested deeply."""
        waiting = [p for p in reversed(self.parts) if isinstance(p, Node)]
        while waiting:
            node = waiting.pop()
            yield node
            waiting += [p for p in reversed(node.parts) if isinstance(p, Node)]

    def text(self) -> str:
        """All texts below, trimmed, joined by blanks."""
        found, waiting = [], list(reversed(self.parts))
        while waiting:
            part = waiting.pop()
            if isinstance(part, str):
                found.append(part.strip())
            else:
                waiting += reversed(part.parts)
        return " ".join(" ".join(t for t in found if t).split())

    def classes(self) -> list[str]:
        return (self.attributes.get("class") or "").split()


class _Tree(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.now = Node("", {})

    def handle_starttag(self, tag: str, attrs: list) -> None:
        node = Node(tag, dict(attrs), self.now)
        self.now.parts.append(node)
        if tag not in VOID:
            self.now = node

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.now.parts.append(Node(tag, dict(attrs), self.now))

    def handle_endtag(self, tag: str) -> None:
        node: Node | None = self.now
        while node and node.name != tag:
            node = node.parent
        if node and node.parent:
            self.now = node.parent

    def handle_data(self, data: str) -> None:
        self.now.parts.append(data)


def tree(page: str | None) -> Node:
    parser = _Tree()
    parser.feed(page or "")
    parser.close()
    return parser.root


def _item_name(item: Node) -> str:
    link = next((n for n in item.below() if n.name == "a"), None)
    name = link.text() if link else ""
    if len(name) > LEAST_NAME and not name.startswith("["):
        return name
    return re.split(r"[,(]", item.text())[0].strip()


def listed(page: str | None) -> list[tuple[str, bool]]:
    """(name, whether it is a guess) of a page, each name once.

    Names are the items of lists that follow a matching heading, beside it, before the next one: the first link's text,
    or what stands before a comma or bracket. Where there are none, the texts of links to other articles are guesses.
    """
    root, names = tree(page), {}
    for heading in root.below():
        if heading.name not in ("h2", "h3", "h4") or not HEADING.search(heading.text()):
            continue
        beside = [p for p in heading.parent.parts if isinstance(p, Node)]
        place = next(i for i, p in enumerate(beside) if p is heading)
        for node in beside[place + 1 :]:
            if node.name in ("h2", "h3", "h4"):
                break
            for item in node.parts if node.name in ("ul", "ol") else []:
                if isinstance(item, Node) and item.name == "li" and len(name := _item_name(item)) > LEAST_NAME:
                    names.setdefault(name, False)
    if not names:
        for link in root.below():
            target = link.attributes.get("href") or "" if link.name == "a" else ""
            if "/wiki/" in target and ":" not in target.split("/wiki/")[-1]:
                name = link.text()
                if len(name) > LEAST_LINK and " " in name:
                    names.setdefault(name, True)
    return list(names.items())


def speaker(page: str | None, anchor: str | None) -> tuple[str | None, str | None]:
    """(name, address) in the first short block of a person, within the intervention that an anchor names; of an anchor
    that the page does not have, in the whole page."""
    return _speaker(tree(page), anchor)


def _speaker(root: Node, anchor: str | None) -> tuple[str | None, str | None]:
    scope = root
    if anchor:
        every = list(root.below())
        found = next((n for n in every if n.attributes.get("id") == anchor), None) or next((n for n in every if n.attributes.get("name") == anchor), None)
        if found:
            scope = found
            while scope and "intervention" not in scope.classes():
                scope = scope.parent
            scope = scope or found
    for block in scope.below():
        if block.name == "div" and "perso" in block.classes():
            text = block.text()
            if text and len(text) < SPEAKER_CHARS:
                return text, next((n.attributes["href"] for n in block.below() if n.name == "a" and n.attributes.get("href")), None)
    return None, None


def keywords(page: str | None) -> list[str]:
    """The first words of the page's cloud of tags."""
    return _keywords(tree(page))


def _keywords(root: Node) -> list[str]:
    cloud = next((n for n in root.below() if "nuage_de_tags" in n.classes()), None)
    words = [KEYWORD_HEAD.sub("", w).strip(" :.-") for w in re.split(r"[\s,;]+", cloud.text())] if cloud else []
    return [w for w in words if w and w.lower() not in NO_KEYWORDS][:MOST_KEYWORDS]


def listed_names(html: Column) -> Column:
    """array<struct<name, guess>> of listed()."""

    @F.pandas_udf("array<struct<name: string, guess: boolean>>")
    def run(pages: pd.Series) -> pd.Series:
        return pd.Series([[{"name": n, "guess": g} for n, g in listed(p)] for p in pages])

    return run(F.make_valid_utf8(html))


def session_facts(html: Column, anchor: Column) -> Column:
    """struct<speaker, address, keywords> of a page and the anchor of an intervention."""

    @F.pandas_udf("speaker string, address string, keywords array<string>")
    def run(pages: pd.Series, anchors: pd.Series) -> pd.DataFrame:
        roots = ((tree(p), a) for p, a in zip(pages, anchors, strict=True))  # a page is parsed once
        rows = [(*_speaker(root, a), _keywords(root)) for root, a in roots]
        return pd.DataFrame(rows, columns=["speaker", "address", "keywords"])

    return run(F.make_valid_utf8(html), anchor)
