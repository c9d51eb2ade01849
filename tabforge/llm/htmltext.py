"""Main text of web pages by tree scoring.

A null or empty page has an empty text. Pages of any length or nesting are read whole and without recursion; broken mark-up
is closed the way browsers do in the common cases. Equal pages give equal texts; of containers with equal scores the first
in the page wins. An empty table gives an empty result; an extra column named like a result gives way to it.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left, bisect_right

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabforge.llm.common import small_batches, with_columns

# Element names and words of class, id and role that mark what isn't the article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table "
    "tbody td tfoot th thead tr ul".split()
)
RAW = frozenset("script style noscript template textarea iframe svg object canvas select title xmp noembed".split())
DROPPED = RAW | frozenset("head nav footer aside button dialog menu input label fieldset audio video map".split())
NOISE = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments complementary consent "
    "contentinfo cookie cookies dialog disqus footer gdpr login menu modal nav navbar navigation newsletter notice notices "
    "overlay pager pagination popup promo promoted promotion related recommended reply respond search share sharing "
    "sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)
#: Beside a noise word, a first part that denies it and last parts that leave it one.
STATES = frozenset("has have no not with without is hide show".split())
BOXES = frozenset(
    "area bar block body bottom box btn button buttons col column container content footer form group header icons inner "
    "item items left link links list main outer panel posts right row section slot text title top unit wrap wrapper".split()
)
ROOTS = frozenset("html body article main".split())
PLAIN = frozenset("a b i span em strong".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CLOSED_BY = {
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr"]),
    "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]), "option": frozenset(["option"]),
}
SCOPES = frozenset("table ul ol dl menu nav article section main aside header footer div form body html td th".split())

# quantifiers that never give back keep every match linear in what it reads
_COMMENT = re.compile(r"<!--.*?(?:-->|\Z)", re.S)
_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/><]*+)")
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/><]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")
_MARKS = re.compile("[<>\"']")
_ATTRIBUTE = re.compile(r"(?<![\w:-])([a-zA-Z][\w:-]*+)\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++))")
_WORDS = re.compile(r"[a-z]+")
_QUOTED = re.compile(r"\"[^\"]*\"|'[^']*'")
_HIDDEN = re.compile(r"(?:^|\s)hidden(?=[\s=/]|$)", re.I)
#: Share of a page's text outside links below which its class rules left too little.
LITTLE = 0.2
#: Scored text beside a wrapper that makes it part of the page's text: a share of the best container's points, and points.
BESIDE, LEAST_BESIDE = 0.1, 3.0
MENUS = frozenset("ul ol div table section dl".split())


#: What an element is by its own mark-up: wanted, noise by a word or a form (which may err), or never part of the text.
CLEAN, SOFT, HARD = 0, 1, 2


class _Node:
    __slots__ = ("tag", "parent", "kids", "mark", "noise", "score", "chars", "linked", "runs", "points")

    def __init__(self, tag: str, parent: _Node | None, mark: int):
        self.tag, self.parent, self.mark, self.noise = tag, parent, mark, False
        self.kids: list[_Node | str] = []
        self.score = self.points = 0.0
        self.chars = self.linked = self.runs = 0


class _Open:
    """The open elements, innermost last, with the depths of each tag and of those that bound implied end tags."""

    def __init__(self, root: _Node):
        self.path, self.depths, self.scopes = [root], {}, []

    def push(self, node: _Node) -> None:
        self.depths.setdefault(node.tag, []).append(len(self.path))
        if node.tag in SCOPES:
            self.scopes.append(len(self.path))
        self.path.append(node)

    def cut(self, depth: int) -> None:
        """Close the element at ``depth`` and all in it."""
        while len(self.path) > depth:
            node = self.path.pop()
            self.depths[node.tag].pop()
            if node.tag in SCOPES:
                self.scopes.pop()

    def last(self, tag: str) -> int:
        """Depth of the innermost open element of this tag, 0 if there is none."""
        found = self.depths.get(tag)
        return found[-1] if found else 0

    def end(self, tag: str) -> None:
        """An end tag; one of an inline element doesn't close blocks."""
        depth = self.last(tag)
        if depth and (tag in SCOPES or tag in BLOCKS or not self.scopes or self.scopes[-1] <= depth):
            self.cut(depth)

    def close(self, tags: frozenset[str]) -> None:
        """Implied end tags: close the outermost element of ``tags`` within the nearest scope."""
        at = len(self.scopes) - 1
        while at >= 0 and self.path[self.scopes[at]].tag in tags:
            at -= 1
        bound = self.scopes[at] if at >= 0 else 0
        first = len(self.path)
        for tag in tags:
            found = self.depths.get(tag)
            if found and found[-1] > bound:
                first = min(first, found[bisect_right(found, bound)])
        self.cut(first)


def _tag_ends(page: str) -> tuple[list[int], list[int]]:
    """Every bracket and quote of the page, and where a tag that reads on from there ends (-1: nowhere)."""
    places = [m.start() for m in _MARKS.finditer(page)]
    ends = [-1] * (len(places) + 1)
    after = {'"': len(places), "'": len(places)}  # of the next such quote
    for i in range(len(places) - 1, -1, -1):
        c = page[places[i]]
        if c == ">":
            ends[i] = places[i]
        elif c == "<":
            ends[i] = ends[i + 1]
        else:
            ends[i] = ends[after[c] + 1] if after[c] < len(places) else -1
            after[c] = i
    return places, ends


def _tokens(page: str):
    """Text pieces, and tags as (slash, name, attributes), in page order; a bracket that begins no tag is text.

    As soon as one tag has no end, the ends of all others are found in one pass from the back, so that no page is
    searched again from each of its brackets.
    """
    place, end, last = 0, len(page), page.rfind(">")
    marks: tuple[list[int], list[int]] | None = None
    while place < end:
        at = page.find("<", place)
        if at != place:
            at = end if at < 0 else at
            yield page[place:at]
            place = at
            continue
        lead = page[place + 1 : place + 2]
        if lead in ("!", "?") and lead:
            if page.startswith("<!--", place):
                place = _COMMENT.match(page, place).end()
                continue
            if place < last:
                place = page.find(">", place) + 1
                continue
        name = _NAME.match(page, place) if place < last else None
        tag = None
        if name is not None:
            if marks is None:
                tag = _TAG.match(page, place)
                marks = _tag_ends(page) if tag is None else None
            elif marks[1][bisect_left(marks[0], name.end())] >= 0:
                tag = _TAG.match(page, place)
        if tag is None:
            yield "<"
            place += 1
            continue
        place = tag.end()
        yield tag
        if not tag[1] and tag[2].lower() in RAW:
            close = re.compile(rf"</{re.escape(tag[2])}\s*+>", re.I).search(page, place)
            place = close.end() if close else end


def _names_noise(token: str, in_article: bool) -> bool:
    """Whether a whole class, id or role says noise, by itself or by its last part (by its first, if the last is a box)."""
    parts = _WORDS.findall(token.split("--")[0])
    if not parts or parts[0] in STATES:
        return False
    noisy = [p in NOISE or (p == "header" and not in_article) for p in (parts[0], parts[-1])]
    return noisy[1] or (noisy[0] and parts[-1] in BOXES)


def _mark(tag: str, attributes: str, in_article: bool) -> int:
    if tag == "form":
        mark = SOFT
    elif tag in DROPPED or (tag == "header" and not in_article):
        return HARD
    else:
        mark = CLEAN
    if not attributes or tag in ROOTS or tag == "header":
        return mark
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), next((v for v in values if v), "").lower()
        if name in ("class", "id", "role"):
            if any(_names_noise(token, in_article) for token in value.split()):
                mark = SOFT
        elif (name == "style" and "display:none" in value.replace(" ", "")) or (name == "aria-hidden" and value == "true"):
            return HARD
    return HARD if _HIDDEN.search(_QUOTED.sub('""', attributes)) else mark


def parse(page: str) -> tuple[_Node, list[_Node]]:
    """The page's elements as a tree and in page order; scripts, styles and the like keep no text."""
    root = _Node("html", None, CLEAN)
    nodes, open_ = [root], _Open(root)
    for token in _tokens(page):
        if isinstance(token, str):
            open_.path[-1].kids.append(html.unescape(token))
            continue
        tag, attributes = token[2].lower(), token[3]
        if token[1]:
            open_.end(tag)
            continue
        if tag == "html":
            continue
        if tag == "body":  # ends the head, closed or not
            open_.cut(1)
        if tag in BLOCKS:  # a block ends an open paragraph, a list item the one before, and so on
            open_.close(CLOSED_BY.get(tag, frozenset()) | {"p"} | (HEADINGS if tag in HEADINGS else frozenset()))
        at = open_.path[-1]
        node = _Node(tag, at, _mark(tag, attributes, bool(open_.last("article") or open_.last("main"))))
        at.kids.append(node)
        nodes.append(node)
        # a closing slash means nothing on blocks and the common inline elements
        if tag not in RAW and tag not in VOID and (not attributes.endswith("/") or tag in BLOCKS or tag in PLAIN):
            open_.push(node)
    return root, nodes


def _spread(nodes: list[_Node], least: int) -> None:
    """Elements marked ``least`` or worse are noise, with all below them."""
    for node in nodes:
        node.noise = node.mark >= least or (node.parent is not None and node.parent.noise)


def _sum_up(root: _Node, nodes: list[_Node]) -> list[tuple[_Node, str, int]]:
    """The text runs, and in every element the characters, those in links, and the runs of all below it but noise."""
    for node in nodes:
        node.chars = node.linked = node.runs = 0
    blocks = _blocks(root)
    for owner, text, linked in blocks:
        owner.chars += len(text)
        owner.linked += min(linked, len(text))
        owner.runs += 1
    for node in reversed(nodes):  # what is below an element comes after it
        if node.parent is not None:
            node.parent.chars += node.chars
            node.parent.linked += node.linked
            node.parent.runs += node.runs
    return blocks


def _plain(node: _Node) -> int:
    """Characters outside links."""
    return node.chars - node.linked


def _clear_wrappers(root: _Node, nodes: list[_Node]) -> None:
    """Find the noise; a word or a form marks nothing that wraps the page's main, its article or most of its text."""
    if not any(n.mark == SOFT for n in nodes):
        _spread(nodes, SOFT)
        return
    _spread(nodes, HARD)
    _sum_up(root, nodes)
    plain = {id(n): _plain(n) for n in nodes}
    told = [n for n in nodes if n.tag in ("article", "main") and plain[id(n)]]
    mains = [n for n in told if n.tag == "main"]
    _spread(nodes, SOFT)
    wrapped = mains
    if not any(not n.noise for n in told):
        within = set()  # elements below an article
        for n in nodes:
            if n.parent is not None and (n.parent.tag == "article" or id(n.parent) in within):
                within.add(id(n))
        wrapped = mains or (told if sum(id(n) not in within for n in told) == 1 else [])
    cleared: set[int] = set()
    for node in wrapped:
        while node.parent is not None and id(node.parent) not in cleared:
            node = node.parent
            node.mark = CLEAN
            cleared.add(id(node))
    _spread(nodes, SOFT)
    _sum_up(root, nodes)
    if any(_plain(n) for n in told) or _plain(root) >= LITTLE * plain[id(root)]:
        return
    for node in nodes:
        if node.mark == SOFT and 2 * plain[id(node)] > plain[id(root)]:
            node.mark = CLEAN
    _spread(nodes, SOFT)
    _sum_up(root, nodes)
    if _plain(root) < LITTLE * plain[id(root)]:
        _spread(nodes, HARD)


def _blocks(top: _Node):
    """Paragraph-like runs of text under ``top`` in page order: (innermost block, text, characters in links)."""
    out: list[tuple[_Node, str, int]] = []
    parts: list[str] = []
    linked = 0

    def flush(owner: _Node) -> None:
        nonlocal linked
        text = " ".join("".join(parts).split())
        if text:
            out.append((owner, text, linked))
        parts.clear()
        linked = 0

    stack: list[tuple[_Node, int, _Node, bool]] = [(top, 0, top, False)]
    while stack:
        node, k, owner, link = stack.pop()
        if k == len(node.kids):
            if node.tag in BLOCKS:
                flush(node)
            continue
        stack.append((node, k + 1, owner, link))
        kid = node.kids[k]
        if isinstance(kid, str):
            parts.append(kid)
            if link:
                linked += len(kid.strip())
        elif kid.noise:
            if kid.tag in BLOCKS:
                flush(owner)
        elif kid.tag in ("br", "wbr"):
            parts.append(" " if kid.tag == "br" else "")
        else:
            block = kid.tag in BLOCKS
            if block:
                flush(owner)
            stack.append((kid, 0, kid if block else owner, link or kid.tag == "a"))
    flush(top)
    return out


def _is_menu(node: _Node) -> bool:
    return node.tag in MENUS and node.runs >= 3 and node.linked > 0.6 * node.chars


def _container(best: _Node) -> _Node:
    """What stands beside the best container belongs to it, bare text too; and so do wrappers beside its own wrapper
    that hold scored text, however deep."""
    if best.parent is None or best.tag == "body":
        return best
    top = at = best.parent
    while at.parent is not None and at.tag != "body":
        if at.parent.points - at.points >= max(LEAST_BESIDE, BESIDE * best.points):
            top = at.parent
        at = at.parent
    return top


def _in_menus(part: _Node, spared: bool, best: _Node, whole: frozenset[str]):
    """A test of elements in ``part``: whether a list of links holds them that is no part of an article."""
    known: dict[int, tuple[bool, bool]] = {}  # (below an article, in a menu)

    def settle(node: _Node) -> None:
        path = []
        while id(node) not in known and node.tag not in whole and node is not part:
            path.append(node)
            node = node.parent
        if id(node) not in known:
            ends = node.tag in whole or spared
            known[id(node)] = (node.tag in whole, not ends and node is not best and _is_menu(node))
        for below in reversed(path):
            inside, menu = known[id(below.parent)]
            known[id(below)] = (inside, menu or (below is not best and _is_menu(below)))

    def menu(node: _Node) -> bool:
        settle(node)
        inside, listed = known[id(node)]
        return listed and not inside

    return menu


def main_text(page: str | None) -> str:
    """Text of the article or main that the best-scored container lies in, else of the container and all beside it."""
    if not page:
        return ""
    root, nodes = parse(page)
    _clear_wrappers(root, nodes)
    blocks = _sum_up(root, nodes)
    if not blocks:
        return ""
    for owner, text, linked in blocks:
        points = 1 + text.count(",") + min(len(text) / 100, 3)
        points *= 1 - min(1.0, linked / len(text))
        owner.points += points
        node, level = owner.parent if owner.parent and owner.tag not in ROOTS else owner, 0
        while node is not None and level < 4:
            node.score += points if level == 0 else points / (2 * level)
            node, level = node.parent, level + 1
    best, top_score, articles = None, -1.0, False
    for node in nodes:
        if not node.chars:
            continue
        articles = articles or node.tag == "article"
        score = (node.score + (25 if node.tag in ("article", "main") else 0)) * (1 - min(1.0, node.linked / node.chars))
        if score > top_score:
            best, top_score = node, score
    for node in reversed(nodes):
        if node.parent is not None:
            node.parent.points += node.points
    article, node = None, best
    while node is not None:
        article = node if node.tag in ("article", "main") else article
        node = node.parent
    if article is None:
        chosen = [_container(best)]
    else:
        chosen = []
        for kid in article.parent.kids:
            if kid is article:
                chosen.append(kid)
            elif isinstance(kid, _Node) and not kid.noise and kid.chars and not _is_menu(kid):
                density = kid.linked / kid.chars
                alike = kid.score * (1 - density) >= max(10, 0.2 * top_score) or kid.tag == article.tag == "article"
                if alike or (kid.tag == "p" and kid.chars > 80 and density < 0.25) or kid.tag in HEADINGS:
                    chosen.append(kid)
    # a list of links is part of an article, or of a main without articles
    whole = frozenset({"article"} if articles else {"article", "main"})
    out = []
    for part in chosen:
        menu = _in_menus(part, part is best or part is article, best, whole)
        out += [text for owner, text, _ in _blocks(part) if not menu(owner)]
    return "\n".join(out)


def extract(df: DataFrame, html_col: str = "html") -> DataFrame:
    """Replace the page by ``text`` and its length in code points, ``n_chars``."""
    small_batches(df.sparkSession)

    @F.pandas_udf("string")
    def text_of(pages: pd.Series) -> pd.Series:
        return pd.Series([main_text(p) for p in pages], dtype=object)

    page: Column = F.col(f"`{html_col}`").cast("string")
    out = with_columns(df.withColumnRenamed(html_col, "__html") if html_col == "text" else df, {"text": text_of(page if html_col != "text" else F.col("__html"))})
    return with_columns(out, {"n_chars": F.length("text").cast("long")}).drop(html_col if html_col != "text" else "__html")
