"""Operator 6, HTML extraction by tag-path ratios.

A page is read into leaves of text, each with the path of open tags from the root, inline
tags left aside and class names as part of a step. Leaves of one path are added up: length of text, marks of
punctuation and number of leaves. A path's ratios are length and punctuation per leaf;
both are smoothed over the paths next to it in page order and fused by multiplying them. Paths
beyond a share of the largest fused value are content. From the deepest tag that holds them
the text is widened: to the article or main around it, or else to the highest tag that
brings in neither lists of links nor page furniture, such as a menu or a footer. The page's
text is all that stands below, so headings, leads, lists and short paragraphs of the article
come along with its long ones. If no h1 is below, the last one before it that stands beside
it, or in the same main, goes along with what is in between, lists of links excepted.

Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader
comments are known by their tags, roles and words of their class or id, and are left out
before and after. Words alone do not leave out a part with every main, every article or
every h1 of the page, or with over half of its paragraphs, unless it is mostly links; for
reader comments paragraphs do not count, nor do articles that are named so. Headers stay in
an article, by tag and by name. Words of layout, such as with-sidebar, name no part. A block ends where a block-level tag opens or closes; inline tags and `br` do not
end one. Character references are decoded, white space inside a block becomes one space,
and blocks are joined by an empty line.

Null and empty html, and pages without content, give the empty text. Unclosed and stray
tags, unclosed comments and cut-off pages are read to their end. Parts that are hidden, by their
attribute or style, are left out. A tag longer than TAG_MOST ends at its first `>`, quoted or
not. Pages are read in one pass: open tags are counted by name and paths are numbers of a
tree, so time grows with the page, however deep or broken it is. Rows with the same page_id
stay apart, an empty table gives no rows, other columns are not read.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Share of the largest fused ratio that makes a path content.
LEAST_SHARE = 0.1
SMOOTH = (0.25, 0.5, 0.25)
#: A path with this many links, and over half of its text in them, is a list of links.
LEAST_LINKS = 3

COMMENT = re.compile(r"<!--.*?(?:--!?>|\Z)", re.S)
TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")
LOOSE_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*+)([^>]*+)>|<[!?/][^>]*+>")
TAG_MOST = 1 << 14
HREF = re.compile(r"\bhref\s*=", re.I)
NAMED = re.compile(
    r"(?<![^\s\"'/])(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))|(?=[\s/]|$))"
    r"|\"[^\"]*\"|'[^']*'",
    re.I,
)
UNSEEN = re.compile(r"\b(?:display\s*:\s*none|visibility\s*:\s*hidden)\b", re.I)
# Elements of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea iframe svg math object select title canvas".split())
INLINE = frozenset(
    "a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd mark q s samp small span strike "
    "strong sub sup time tt u var wbr".split()
)
ENDS_P = frozenset(
    "address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav "
    "ol p pre section table ul".split()
)
#: Elements that close a sibling of their own kind which was left open, up to their container.
CLOSES = {"li": ("ul", "ol"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr",), "th": ("tr",)}
#: Parts of a page that are never content.
LEFT_OUT = frozenset("head nav header footer aside form button dialog menu label".split())
LEFT_OUT_ROLES = frozenset("navigation banner contentinfo complementary search alert dialog menu".split())
LEFT_OUT_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisement|sponsor(?:ed)?|promo|banner|cookies?|consent|notices?|alert|popup|modal|"
    r"menu|nav|navbar|navigation|breadcrumbs?|header|masthead|footer|sidebar|side-?bar|aside|widget|related|"
    r"comments?|disqus|replies|respond|share|sharing|social|newsletter|subscribe|login|search|pagination|toolbar)"
    r"(?:$|[\s_-])",
    re.I,
)
#: Parts that frame a page; the others that are left out may stand within an article.
FURNITURE = frozenset("nav header footer aside".split())
FURNITURE_ROLES = frozenset("navigation banner contentinfo complementary".split())
FURNITURE_NAMES = re.compile(
    r"(?:^|[\s_-])(?:menu|nav|navbar|navigation|header|masthead|footer|side-?bar|aside|banner|cookies?|consent)(?:$|[\s_-])",
    re.I,
)
COMMENT_NAMES = re.compile(r"(?:^|[\s_-])(?:comments?|disqus|replies|respond)(?:$|[\s_-])", re.I)
HEADER_NAMES = re.compile(r"(?:^|(?<=[\s_-]))(?:header|masthead)(?=$|[\s_-])", re.I)
#: Class names that say how a page is laid out, or name the heading of its content.
LAYOUT_NAMES = re.compile(
    r"(?<!\S)(?:(?:with|without|no|has)[_-]\S+|\S+[_-](?:open|opened|closed|enabled|disabled)"
    r"|(?:article|content|entry|page|post|story)[_-]header)(?!\S)",
    re.I,
)
#: What the content of a page stands in or under.
LANDMARKS = ("main", "article", "h1")
PUNCTUATION = re.compile(r"[.,;:!?…。，、；：！？·¿¡]")


def _left_out(tag: str, said: dict[str, str], inside_article: bool) -> bool:
    """Whether the tag or its role leaves a part out, whatever it holds."""
    if tag in LEFT_OUT and not (tag == "header" and inside_article):
        return True
    if "hidden" in said or UNSEEN.search(said.get("style", "")):
        return True
    return said.get("role", "").lower() in LEFT_OUT_ROLES or said.get("aria-hidden", "").lower() == "true"


def _named(tag: str, said: dict[str, str], inside_article: bool) -> str:
    """The class and id if a word of theirs is that of a part to leave out, or else nothing."""
    if tag in ("html", "body", "main", "article"):
        return ""
    names = LAYOUT_NAMES.sub(" ", f"{said.get('class', '')} {said.get('id', '')}")
    if inside_article:
        names = HEADER_NAMES.sub(" ", names)
    return names if LEFT_OUT_NAMES.search(names) else ""


ROOT = 0


class Paths:
    """The paths of a page as a tree: a number each, the parent before its children."""

    def __init__(self):
        self.parent, self.tag, self.depth = [ROOT], [""], [0]
        self.known: dict[tuple[int, str], int] = {}

    def below(self, path: int, step: str) -> int:
        found = self.known.get((path, step))
        if found is None:
            found = self.known[path, step] = len(self.parent)
            self.parent.append(path)
            self.tag.append(step.split(".")[0])
            self.depth.append(self.depth[path] + 1)
        return found

    def shared(self, some: list[int]) -> int:
        """The deepest path that all of these begin with."""
        held = [0] * len(self.parent)
        for path in some:
            held[path] += 1
        for path in range(len(held) - 1, ROOT, -1):
            if held[path] == len(some):
                return path
            held[self.parent[path]] += held[path]
        return ROOT

    def within(self, path: int, *tags: str) -> int | None:
        """The nearest of these tags that a path is or stands in."""
        while path != ROOT:
            if self.tag[path] in tags:
                return path
            path = self.parent[path]
        return None

    def all_below(self, *roots: int) -> list[bool]:
        """For every path whether it is one of these or stands in one."""
        inside = [False] * len(self.parent)
        for root in roots:
            inside[root] = True
        for path in range(1, len(inside)):
            inside[path] = inside[path] or inside[self.parent[path]]
        return inside


class Leaf(NamedTuple):
    path: int
    block: int
    text: str
    linked: bool
    paragraph: bool
    part: int  # the innermost named part that it stands in, or -1


class Part(NamedTuple):
    """A part whose class or id has a word of those to leave out."""

    names: str
    path: int
    part: int  # the named part that it stands in, or -1


def parts_to_leave(leaves: list[Leaf], parts: list[Part], landmarks: list[tuple[str, int]]) -> list[bool]:
    """For every named part whether it, or one that it stands in, does not hold the page's content."""
    n = len(parts) + 1  # the last one is the page
    length, linked, paragraphs = [0] * n, [0] * n, [0] * n
    held = {tag: [0] * n for tag in LANDMARKS}
    for leaf in leaves:
        size = len(leaf.text.strip())
        length[leaf.part] += size
        linked[leaf.part] += size * leaf.linked
        paragraphs[leaf.part] += size * (leaf.paragraph and not leaf.linked)
    for tag, part in landmarks:
        held[tag][part] += 1
    sums = [length, linked, paragraphs, *held.values()]
    for k in range(len(parts) - 1, -1, -1):
        for total in sums:
            total[parts[k].part] += total[k]

    def holds_content(k: int) -> bool:
        if 2 * linked[k] > length[k]:
            return False
        if any(x[k] and x[k] == x[-1] for x in held.values()):
            return True
        return 2 * paragraphs[k] > paragraphs[-1] and not COMMENT_NAMES.search(parts[k].names)

    leave = [False] * n
    for k, part in enumerate(parts):
        leave[k] = leave[part.part] or not holds_content(k)
    return leave


def read_leaves(page: str) -> tuple[list[Leaf], list[int], Paths]:
    """Every leaf outside the parts that are left out, and where page furniture stands.

    No path has inline tags.
    """
    paths = Paths()
    leaves: list[Leaf] = []
    furniture: list[int] = []
    parts: list[Part] = []
    landmarks: list[tuple[str, int]] = []
    open_parts, part_from = [-1], []  # named parts, and their depths
    links: list[int] = []  # depths of open links
    out_from: list[int] = []  # depths at which a left-out part begins
    tags: list[str] = []
    here: list[int] = [ROOT]  # the path at each depth
    depths: dict[str, list[int]] = defaultdict(list)  # of the open tags of each name
    block = at = begun = 0
    last = page.rfind(">")

    def close(depth: int) -> None:
        while len(tags) > depth:
            depths[tags.pop()].pop()
            here.pop()
        while out_from and out_from[-1] >= depth:
            out_from.pop()
        while links and links[-1] >= depth:
            links.pop()
        while part_from and part_from[-1] >= depth:
            part_from.pop(), open_parts.pop()

    def add(text: str) -> None:
        if text and not out_from:
            leaves.append(Leaf(here[-1], block, text, bool(links), bool(depths["p"]), open_parts[-1]))

    while True:
        sign = page.find("<", at)
        if sign >= 0 and page.startswith("<!--", sign):
            m = COMMENT.match(page, sign)
        elif 0 <= sign < last:
            m = TAG.match(page, sign, sign + TAG_MOST) or LOOSE_TAG.match(page, sign)
            if not m:
                at = sign + 1
                continue
        else:
            m = None
        add(page[begun : m.start() if m else len(page)])
        if not m:
            break
        at = begun = m.end()
        tag = (m[2] or "").lower() if m.re is not COMMENT else ""
        if not tag:
            continue
        if tag not in INLINE:
            block += 1
        own = depths[tag]
        if m[1]:
            if own:
                close(own[-1])
            continue
        rest = m[3] or ""
        if tag in RAW:
            if not rest.endswith("/"):
                end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at) if at < last else None
                at = begun = end.end() if end else len(page)
            continue
        if tag in VOID:
            continue
        if tag in ENDS_P and depths["p"]:
            close(depths["p"][-1])
        elif tag in CLOSES and own:
            if not any(depths[x] and depths[x][-1] > own[-1] for x in CLOSES[tag]):
                close(own[-1])
        said = {x[0].lower(): x[1] or x[2] or x[3] for x in NAMED.findall(rest) if x[0]} if rest else {}
        inside_article = bool(depths["article"])
        if _left_out(tag, said, inside_article):
            if not out_from and (tag in FURNITURE or said.get("role", "").lower() in FURNITURE_ROLES):
                furniture.append(here[-1])
            out_from.append(len(tags))
        elif not out_from:
            if names := _named(tag, said, inside_article):
                parts.append(Part(names, here[-1], open_parts[-1]))
                open_parts.append(len(parts) - 1)
                part_from.append(len(tags))
            if tag in LANDMARKS and not (tag == "article" and COMMENT_NAMES.search(said.get("class", ""))):
                landmarks.append((tag, open_parts[-1]))
        if tag == "a" and HREF.search(rest):
            links.append(len(tags))
        depths[tag].append(len(tags))
        tags.append(tag)
        step = tag + "." + said["class"] if said.get("class") else tag
        here.append(here[-1] if tag in INLINE else paths.below(here[-1], step))
    leave = parts_to_leave(leaves, parts, landmarks)
    furniture += [
        x.path for k, x in enumerate(parts) if leave[k] and not leave[x.part] and FURNITURE_NAMES.search(x.names)
    ]
    return [x for x in leaves if not leave[x.part]], furniture, paths


def content_root(leaves: list[Leaf], paths: Paths) -> int | None:
    """The path of the deepest tag that holds the content."""
    sums: dict[int, list[float]] = defaultdict(lambda: [0.0, 0.0, 0.0])
    for path, _, text, *_ in leaves:
        length = len(text.strip())
        if length:
            own = sums[path]
            own[0] += length
            own[1] += 1 + len(PUNCTUATION.findall(text))
            own[2] += 1
    if not sums:
        return None
    named = list(sums)

    def smoothed(of: int) -> list[float]:
        raw = [sums[p][of] / sums[p][2] for p in named]
        padded = [raw[0], *raw, raw[-1]]
        return [sum(w * x for w, x in zip(SMOOTH, padded[i : i + 3], strict=True)) for i in range(len(raw))]

    # The share of the page's text weighs in, so that one long notice is no article.
    fused = [a * b * sums[p][0] for a, b, p in zip(smoothed(0), smoothed(1), named, strict=True)]
    most = max(fused)
    chosen = [p for p, value in zip(named, fused, strict=True) if value >= LEAST_SHARE * most]
    # Above a paragraph stands the tag that holds its neighbours as well.
    if len(chosen) == 1 and paths.depth[chosen[0]] > 1:
        return paths.parent[chosen[0]]
    return paths.shared(chosen)


def link_lists(leaves: list[Leaf]) -> set[int]:
    """Paths that hold mostly links."""
    sums: dict[int, list[int]] = defaultdict(lambda: [0, 0, 0])
    for leaf in leaves:
        length = len(leaf.text.strip())
        if length:
            own = sums[leaf.path]
            own[0] += length
            own[1] += length * leaf.linked
            own[2] += leaf.linked
    return {p for p, (all_, linked, n) in sums.items() if n >= LEAST_LINKS and 2 * linked > all_}


def widened(root: int, barred: set[int], paths: Paths) -> int:
    """The article or main around root, or the highest tag that brings in no barred path."""
    around = paths.within(root, "article", "main")
    if around is not None:
        return around
    on_the_way, path = {ROOT}, root
    while path != ROOT:
        on_the_way.add(path)
        path = paths.parent[path]
    met = [0] * len(paths.parent)  # how deep each path goes along with root
    for path in range(1, len(met)):
        met[path] = paths.depth[path] if path in on_the_way else met[paths.parent[path]]
    depth = max((met[p] for p in barred if met[p] < paths.depth[root]), default=-1) + 1
    while paths.depth[root] > depth:
        root = paths.parent[root]
    return root


def content(leaves: list[Leaf], furniture: list[int], paths: Paths) -> list[Leaf]:
    """The leaves of the main text."""
    root = content_root(leaves, paths)
    if root is None:
        return []
    lists = link_lists(leaves)
    root = widened(root, {*lists, *furniture}, paths)
    below = paths.all_below(root)
    inside = [below[leaf.path] for leaf in leaves]
    in_heading = paths.all_below(*(p for p, tag in enumerate(paths.tag) if tag == "h1"))
    headed = [in_heading[leaf.path] for leaf in leaves]
    if root != ROOT and not any(held and h for held, h in zip(inside, headed, strict=True)):
        above = paths.parent[root]
        scope = paths.within(above, "main")
        near = paths.all_below(above if scope is None else scope)
        first = inside.index(True)
        beside = [k for k in range(first) if near[leaves[k].path]]
        block = next((leaves[k].block for k in reversed(beside) if headed[k]), None)
        if block is not None:
            for k in beside:
                inside[k] = leaves[k].block >= block and leaves[k].path not in lists
    return [leaf for leaf, held in zip(leaves, inside, strict=True) if held]


def extract(page: str | None) -> str:
    """The main text of a page."""
    blocks: dict[int, list[str]] = defaultdict(list)
    for leaf in content(*read_leaves(page or "")):
        blocks[leaf.block].append(leaf.text)
    made = (" ".join(html.unescape("".join(x)).split()) for x in blocks.values())
    return "\n\n".join(x for x in made if x)


def extracted(page: Column | str) -> Column:
    @F.arrow_udf("string")
    def one(column: pa.Array) -> pa.Array:
        return pa.array([extract(x) for x in column.to_pylist()], pa.string())

    return one(page)


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url and the main text of each page with its length."""
    read = pages.select("page_id", "url", extracted("html").alias("text"))
    return read.withColumn("n_chars", F.length("text").cast("bigint"))
