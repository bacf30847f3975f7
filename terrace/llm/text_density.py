"""Main text of web pages by composite text density.

A page becomes a tree of elements. Elements that never hold an article go first, with all that is in them: head, scripts,
styles, menus, footers, forms, page headers and the like, by name, role, or words of class and id. For every element that
is left, with C characters of text, T tags, and LC and LT of both in links, within its subtree (0 counts as 1), the density is

    C / T * log_b(C / LC * T / LT),   b = ln(C / (C - LC) * LC + LC_body / C_body * C + e)

and its sum is that of its children's densities, texts counting as leaves. The element with the largest sum is taken. If it
lies in an article, main or content element, the nearest of these is the text. Otherwise the least density on the path
from it to the body is the threshold: wherever an element reaches it, the element of the largest sum below it is text too.
Lists and boxes of links within the text go.

Blocks are what block elements hold between their borders. White space in a block is one space; blocks follow each other
in page order with an empty line between. Character references are decoded.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm._spark import sliced

#: Elements of which nothing is text of an article.
NEVER = frozenset("head title script style noscript template nav aside footer form svg math iframe object canvas audio video button select textarea datalist dialog menu frameset noframes".split())
#: Elements whose content is no markup.
RAW = frozenset("script style textarea title iframe noframes xmp".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noscript ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements that an opening tag ends, where they are open and none of the others lies between.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "td", "th"}),
    "dt": ({"dt", "dd"}, {"dl", "td", "th"}),
    "dd": ({"dt", "dd"}, {"dl", "td", "th"}),
    "tr": ({"tr", "caption"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tfoot"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
#: Elements that close no paragraph beyond them and that end tags of others don't cross.
WALLS = frozenset("table td th caption button object html".split())
#: Words of class, id and role by which an element isn't the article's.
FOREIGN = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner menu nav navbar navigation breadcrumb breadcrumbs footer masthead sidebar aside complementary contentinfo search cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription paywall share sharing social related recommended recommendations comment comments disqus reply replies respond pagination pager widget login signup toolbar skip".split()
)
#: Words by which an element is the article's container.
CONTENT = frozenset("article articlebody content post entry story main".split())
#: A class that begins so tells what a page has or lacks, not what the element is.
PREFIXES = ("no", "with", "without", "has", "is")

_MARKUP = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^<>=]++|=\s*(?:"[^"]*"|'[^']*')|=)*+)>""", re.S)
_NAMED = re.compile(r"""(?:^|[\s"'/])(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORDS = re.compile(r"[a-z]+|[0-9]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


def _kinds(attributes: str) -> tuple[bool, bool]:
    """Whether an element's class, id, role or itemprop is foreign to the article, and whether it names its container."""
    foreign = content = False
    for _, *values in _NAMED.findall(attributes):
        for name in "".join(values).split():
            words = _WORDS.findall(_CAMEL.sub("-", name).lower())
            if words and words[0] in PREFIXES:
                continue
            foreign |= not FOREIGN.isdisjoint(words)
            content |= not CONTENT.isdisjoint(words)
    return foreign, content


@dataclass
class Tree:
    """A page's elements in the order of their start tags, and its texts in page order."""

    names: list[str] = field(default_factory=lambda: ["#page"])
    parents: list[int] = field(default_factory=lambda: [-1])
    gone: list[bool] = field(default_factory=lambda: [False])
    content: list[bool] = field(default_factory=lambda: [False])
    #: Element, block and text; a block's texts follow each other.
    texts: list[tuple[int, int, str]] = field(default_factory=list)


def parsed(page: str) -> Tree:
    """The tree of a page, with the end tags that HTML lets authors leave out."""
    tree, stack, block, at = Tree(), [0], 0, 0
    names, parents, gone = tree.names, tree.parents, tree.gone
    counts: dict[str, int] = {}

    def close(depth: int) -> None:
        for i in stack[depth:]:
            counts[names[i]] -= 1
        del stack[depth:]

    def close_open(ends: set[str], walls: frozenset[str] | set[str]) -> None:
        if any(counts.get(n) for n in ends):
            for depth in range(len(stack) - 1, 0, -1):
                if names[stack[depth]] in ends:
                    return close(depth)
                if names[stack[depth]] in walls:
                    return

    def text(to: int) -> None:
        if to > at and not gone[stack[-1]]:
            piece = page[at:to]
            tree.texts.append((stack[-1], block, html.unescape(piece) if "&" in piece else piece))

    while True:
        found = _MARKUP.search(page, at)
        if found is None:
            text(len(page))
            return tree
        text(found.start())
        at = found.end()
        if found[2] is None:
            continue
        name = found[2].lower()
        block += name in BLOCKS
        if found[1]:
            if counts.get(name) and name not in ("html", "body"):
                inline = name not in BLOCKS
                for depth in range(len(stack) - 1, 0, -1):
                    here = names[stack[depth]]
                    if here == name:
                        close(depth)
                        break
                    if inline and here in BLOCKS or here in WALLS and name not in ("table", "tbody", "thead", "tfoot", "tr"):
                        break
            continue
        if name in BLOCKS:
            close_open({"p"}, WALLS)
        if name in ENDS:
            close_open(*ENDS[name])
        up = stack[-1]
        foreign, content = _kinds(found[3]) if "=" in found[3] else (False, False)
        if name in ("html", "body") and counts.get(name):
            continue
        if name == "br":
            if not gone[up]:
                tree.texts.append((up, block, " "))
        whole = name in ("article", "main", "body", "html")
        lost = name in NEVER or foreign and (not whole or name == "article" and not content) and name not in VOID
        if name == "header":
            lost = lost or not any(counts.get(n) for n in ("article", "main"))
        # Some pages are one form.
        saved = name in ("article", "main", "h1") and counts.get("form", 0) > 0 and not any(counts.get(n) for n in NEVER - {"form"})
        names.append(name)
        parents.append(up)
        gone.append((gone[up] and not saved) or lost)
        tree.content.append(content and name not in ("html", "body") and not lost)
        if name in VOID:
            continue
        if name in RAW:
            end = re.compile(rf"</{name}(?=[\s/>]|\Z)", re.I).search(page, at)
            at = end.start() if end else len(page)
        stack.append(len(names) - 1)
        counts[name] = counts.get(name, 0) + 1


def composite(chars: int, tags: int, link_chars: int, link_tags: int, share: float) -> float:
    """Composite text density; share: of the body's characters, those in links."""
    if chars == 0 or link_chars == chars:
        return 0.0
    tags, link_chars, link_tags = max(tags, 1), max(link_chars, 1), max(link_tags, 1)
    base = math.log(chars / max(chars - link_chars, 1) * link_chars + share * chars + math.e)
    return chars / tags * math.log(max(chars / link_chars * tags / link_tags, 1.0)) / math.log(base)


def main_text(page: str | None) -> str:
    """The article of a page; empty without one."""
    tree = parsed(page or "")
    names, parents, gone, n = tree.names, tree.parents, tree.gone, len(tree.names)
    chars, tags, link_chars, link_tags, own = [0] * n, [0] * n, [0] * n, [0] * n, [0] * n
    linked = [False] * n
    for i in range(1, n):
        linked[i] = linked[parents[i]] or names[i] == "a"
    for i, _, t in tree.texts:
        size = len("".join(t.split()))
        chars[i] += size
        own[i] += size
        link_chars[i] += size * linked[i]
    for i in range(n - 1, 0, -1):
        up = parents[i]
        chars[up] += chars[i]
        link_chars[up] += link_chars[i]
        tags[up] += tags[i] + (not gone[i])
        link_tags[up] += link_tags[i] + (names[i] == "a" and not gone[i])
    if chars[0] == 0:
        return ""
    share = link_chars[0] / chars[0]
    density = [0.0 if gone[i] else composite(chars[i], tags[i], link_chars[i], link_tags[i], share) for i in range(n)]
    sums = [composite(own[i], 1, own[i] * linked[i], 0, share) for i in range(n)]
    for i in range(n - 1, 0, -1):
        sums[parents[i]] += density[i]
    top = max((i for i in range(n) if not gone[i]), key=lambda i: (sums[i], -i))
    path = [top]
    while parents[path[-1]] >= 0:
        path.append(parents[path[-1]])
    taken = [False] * n
    kinds = (lambda i: names[i] == "article", lambda i: names[i] == "main", lambda i: tree.content[i])
    home = next((i for kind in kinds for i in path if kind(i)), None)
    if home is not None:
        taken[home] = True
    else:
        body = next((k for k, i in enumerate(path) if names[i] == "body"), len(path) - 1)
        threshold = min(density[i] for i in path[: body + 1])
        best = list(range(n))
        for i in range(n - 1, 0, -1):
            if not gone[i] and sums[best[i]] > sums[best[parents[i]]]:
                best[parents[i]] = best[i]
        for i in range(n):
            if not gone[i] and density[i] >= threshold:
                taken[best[i]] = True
    out: dict[int, list[str]] = {}
    menu = [False] * n
    for i in range(1, n):
        box = names[i] in ("ul", "ol", "div", "section", "table") and link_tags[i] >= 3 and 10 * link_chars[i] >= 8 * chars[i]
        taken[i] = taken[i] or taken[parents[i]]
        menu[i] = menu[parents[i]] or box
    for i, block, t in tree.texts:
        if taken[i] and not menu[i] and not gone[i]:
            out.setdefault(block, []).append(t)
    blocks = (" ".join("".join(pieces).split()) for pieces in out.values())
    return "\n\n".join(b for b in blocks if b)


def extracted(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """page_id, url, text and n_chars (code points) of every row.

    Null and empty pages, and pages without an article, have an empty text. Rows are independent: repeated rows and null
    ids or urls stay as they are. Of elements with equal sums the outermost, first one is taken. Very long pages are read
    whole. An empty table gives no rows; other columns don't matter.
    """
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).cast("string").alias("url"), F.col(page).cast("string").alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "html"):
            texts = [main_text(p) for p in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    kind = dict(rows.dtypes)["page_id"]
    return rows.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
