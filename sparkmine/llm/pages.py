"""Main text of web pages by tag-path ratios.

A page is cut into text nodes, each under its path of tags (and first classes)
from the root; paths are numbers with links to the path above. Per path the text
length, the share of it outside links, the punctuation and the number of nodes are
summed up; their product is the path's ratio.

1. *Smooth.* A path's smoothed ratio adds those of the paths one step away (above,
   below, beside) and two steps away (two above, two below) with the weights of a
   Gaussian, so that a heading or short paragraph is carried by the paragraphs
   beside it. Sums over children make this linear in the number of paths.
2. *Threshold.* Paths are chosen whose smoothed ratio reaches a share of the spread
   of all ratios on the page.
3. *Fuse.* The main part is the deepest element path that holds ``HOLDS`` of the chosen
   text; all paths below it belong to it, also those of tables and captions. Block
   elements in it whose text is mostly links go. Text outside of it goes, whatever
   its classes. Where no element holds that much, the chosen paths are taken.

Scripts, styles and form controls are never text (``NEVER``). Tags, roles and whole
classes or ids that name menus, headers, footers, side bars, notices, adverts or
comments, and article elements, are priors: a marked element counts for
nothing, unless it holds ``OVERRULES`` of the page's plain text (reader comments stay
out); an article that holds ``ARTICLE`` of it is where paths are judged.

The text of the chosen nodes is put into blocks at the borders of block-level
elements; references are decoded, white space inside a block is one blank,
blocks are joined by a line end.

Every step takes constant time per tag or text node, whatever the depth of the page
and the number of its classes.

Defined results: null html is an empty page; a page without chosen text has an
empty text; repeated rows are extracted one by one; an empty table gives an
empty result; further columns are ignored. Each page is read whole.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Kinds of elements.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style|iframe|textarea|title|xmp"
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
# An element that is still open when one of these begins, up to its container, ends there.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
NEVER = set("head form button dialog select template svg canvas audio video".split())
BOILER_TAGS = set("nav header footer aside menu label fieldset noscript".split())
KEPT_INSIDE = {"label", "noscript"}  # boilerplate only outside an article
FOREIGN = {"svg", "math"}
BOILER_ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
BOILER_WORDS = set(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies "
    "disqus footer gdpr header masthead menu modal nav navbar navigation newsletter notice popup promo promoted promotion related "
    "replies respond share sharing sidebar signup social sponsor sponsored subscribe subscription toolbar topbar widget".split()
)
# A class or id counts if it is one of the words above or a compound of them with these: "site-footer", "ad-slot-2", not
# "related-work", "ad-hoc-networks" or "with-sidebar".
FRAME_WORDS = set(
    "area article articles bar blog body bottom box button buttons center column container content desktop entry fixed floating form "
    "global group holder icon icons inner item items left link links list main media mobile module outer overlay page pane panel post "
    "posts primary region right row secondary section site slot sticky story stories tertiary top unit wrap wrapper".split()
)
MAIN_TAGS = {"article", "main"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
PUNCTUATION = re.compile(r"[.,;:!?…。，、；：！？।؟]")

WIDTH = 1.0  # of the Gaussian, in steps of a path
STEP = [math.exp(-(d**2) / (2 * WIDTH**2)) for d in range(3)]
REACH = 0.1  # share of the standard deviation of the ratios that a path must reach
HOLDS = 0.75  # share of the chosen text below the element that fuses paths
LINKED = 0.6  # share of links from which a block of the main part is a menu
OVERRULES = 0.8  # share of plain text from which a marked element is none of what its name says
ARTICLE = 0.25
COMMENT_WORDS = set("comment comments commentlist disqus replies respond".split())

_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})\b(?:\"[^\"]*\"|'[^']*'|[^'\">])*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^'\">])*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)>|<[!?/][^>]*>",
    re.S | re.I,
)
_ATTR = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_BETWEEN = re.compile(r"[-_:.0-9]+")


def _marks(names: list[str]) -> set[str]:
    """Boilerplate words among those classes and ids that consist of them and
    of words for parts of a page."""
    found: set[str] = set()
    for name in names:
        pieces = {x for x in _BETWEEN.split(name) if x}
        if pieces & BOILER_WORDS and pieces <= BOILER_WORDS | FRAME_WORDS:
            found |= pieces & BOILER_WORDS
    return found


_ENDED = tuple(ENDS)


class _Open:
    """An element that is open: its path, and what it says about the text below it."""

    __slots__ = ("tag", "path", "never", "mark", "link", "main", "title", "heading", "foreign", "paragraph", "ends")

    def __init__(self, tag: str, attrs: str, parent: _Open, depth: int, page: _Page):
        found = {m[1].lower(): (m[2] or m[3] or m[4] or "").lower() for m in _ATTR.finditer(attrs)} if attrs else {}
        classes = found.get("class", "").split()
        role = found.get("role")
        inside = parent.main
        # The id of a heading, or of a section of the article, is a slug of its title.
        slug = tag in HEADINGS or inside and tag == "section"
        words = _marks([*classes, *([] if slug else found.get("id", "").split())])
        # The header of an article holds its title; only the headings count.
        title = inside and not parent.mark and (tag == "header" or "header" in words)
        marked = bool(words) and tag not in ("html", "body") or role in BOILER_ROLES or tag in BOILER_TAGS and not (inside and tag in KEPT_INSIDE)
        self.tag = tag
        self.never = parent.never or tag in NEVER
        self.mark = page.marked(parent.mark, bool(words & COMMENT_WORDS)) if marked and not title else parent.mark
        self.title = parent.title or title
        self.heading = parent.heading or tag in HEADINGS
        self.main = inside or tag in MAIN_TAGS or role in MAIN_TAGS
        self.link = parent.link or tag == "a"
        self.foreign = parent.foreign or tag in FOREIGN
        self.path = page.path(parent.path, f"{tag}.{classes[0]}" if classes else tag, tag in BLOCK)
        # Depth of an open paragraph that a block would end, and of elements that others end.
        self.paragraph = depth if tag == "p" else 0 if tag in BLOCK else parent.paragraph
        self.ends = parent.ends
        for k, name in enumerate(_ENDED):
            ended, container = ENDS[name]
            if tag in ended or tag in container:
                self.ends = (*self.ends[:k], depth if tag in ended else 0, *self.ends[k + 1 :])

    @staticmethod
    def root() -> _Open:
        self = _Open.__new__(_Open)
        self.tag, self.path, self.mark, self.paragraph, self.ends = "", 0, 0, 0, (0,) * len(_ENDED)
        self.never = self.link = self.main = self.title = self.heading = self.foreign = False
        return self


class _Page:
    """Paths as numbers: ``parent`` and ``step`` of each, path 0 is the root. Marked
    elements the same way: ``above`` the mark that encloses each, mark 0 is none."""

    def __init__(self) -> None:
        self.parent, self.step, self.block = [0], [""], [False]
        self.numbers: dict[tuple[int, str], int] = {}
        self.above, self.comments = [0], [False]
        # Text nodes in page order: block, path, text, mark, link, article.
        self.nodes: list[tuple[int, int, str, int, bool, int]] = []

    def path(self, parent: int, step: str, block: bool) -> int:
        number = self.numbers.setdefault((parent, step), len(self.parent))
        if number == len(self.parent):
            self.parent.append(parent)
            self.step.append(step)
            self.block.append(block)
        return number

    def marked(self, above: int, comments: bool) -> int:
        self.above.append(above)
        self.comments.append(comments)
        return len(self.above) - 1


LINE_BREAK = -1  # the path of a line break


def read(page: str) -> _Page:
    out = _Page()
    stack = [_Open.root()]
    is_open: dict[str, int] = {}
    block, at, articles, article = 0, 0, 0, 0

    def text(until: int) -> None:
        top = stack[-1]
        if at < until and not top.never and not (top.title and not top.heading):
            out.nodes.append((block, top.path, html.unescape(page[at:until]), top.mark, top.link, article))

    def close(depth: int) -> None:
        nonlocal article
        for o in stack[depth:]:
            is_open[o.tag] -= 1
        del stack[depth:]
        if article and not stack[-1].main:
            article = 0

    last = page.rfind(">") + 1  # nothing behind it can be a tag
    for m in _TOKEN.finditer(page, 0, last):
        text(m.start())
        at = m.end()
        tag = (m["tag"] or m["tag2"] or "").lower()
        if not tag:  # a comment, a declaration, or an element whose content is not text
            if at == last and _unclosed(m):
                at = len(page)
            continue
        if m["end"] or m["end2"]:
            block += tag in BLOCK
            if is_open.get(tag):
                depth = len(stack) - 1
                while stack[depth].tag != tag:
                    depth -= 1
                close(depth)
            continue
        if tag == "br":
            out.nodes.append((block, LINE_BREAK, " ", 0, False, article))
            continue
        block += tag in BLOCK
        if tag in VOID:
            continue
        if tag in BLOCK and stack[-1].paragraph:  # a paragraph ends where a block begins, through any inline elements
            close(stack[-1].paragraph)
        if tag in ENDS and stack[-1].ends[_ENDED.index(tag)]:
            close(stack[-1].ends[_ENDED.index(tag)])
        attrs = (m["attrs"] if m["tag"] else m["attrs2"]) or ""
        if attrs.endswith("/") and (tag in FOREIGN or stack[-1].foreign):
            continue
        opened = _Open(tag, attrs, stack[-1], len(stack), out)
        stack.append(opened)
        is_open[tag] = is_open.get(tag, 0) + 1
        if opened.main and not article:
            articles += 1
            article = articles
    comment = page.find("<!--", max(at, last))
    text(comment if comment >= 0 else len(page))
    return out


def _unclosed(m: re.Match) -> bool:
    """Whether a comment or an element without text runs on behind the last tag."""
    if m["raw"]:
        return not re.search(rf"</{m['raw']}\s*>\Z", m[0], re.I)
    return m[0].startswith("<!--") and not m[0].endswith("-->")


def _visible(text: str) -> int:
    return len(text) - text.count(" ") if not text.isspace() else 0


def boilerplate(page: _Page) -> list[bool]:
    """Of each mark, whether it stands. Marked text may be the page's main text after
    all; then the ratio of plain text overrules the name."""
    plain, held = 0, [0] * len(page.above)
    for _, _, text, mark, link, _ in page.nodes:
        size = 0 if link else _visible(text)
        plain += size
        held[mark] += size
    for mark in range(len(held) - 1, 0, -1):
        held[page.above[mark]] += held[mark] if page.above[mark] else 0
    out = [False]
    for mark in range(1, len(held)):
        stands = page.comments[mark] or held[mark] < OVERRULES * plain or not plain
        out.append(stands or out[page.above[mark]])
    return out


def smoothed(parent: list[int], ratio: list[float]) -> list[float]:
    """Ratios with those of paths up to two steps away: above and below, and beside
    (one step). Path 0 is above all and has no ratio."""
    n = len(parent)
    below, two_below = [0.0] * n, [0.0] * n
    for p in range(1, n):
        below[parent[p]] += ratio[p]
    for p in range(1, n):
        two_below[parent[p]] += below[p]
    out = [0.0] * n
    for p in range(1, n):
        up = parent[p]
        beside = below[up] - ratio[p]
        two_up = ratio[parent[up]] if up else 0.0
        out[p] = ratio[p] + STEP[1] * (ratio[up] + below[p] + beside) + STEP[2] * (two_up + two_below[p])
    return out


def chosen_paths(page: _Page, texts: list[tuple[int, str, bool]]) -> list[bool]:
    """Of each path, whether it belongs to the main part, given ``path, text, link``."""
    n = len(page.parent)
    size, plain, points, count = [0] * n, [0] * n, [0] * n, [0] * n
    for path, text, link in texts:
        seen = _visible(text)
        if seen:
            size[path] += seen
            plain[path] += 0 if link else seen
            points[path] += len(PUNCTUATION.findall(text))
            count[path] += 1
    ratio = [(plain[p] / count[p]) * (plain[p] / size[p]) * (1 + points[p] / count[p]) if size[p] else 0.0 for p in range(n)]
    held = [p for p in range(n) if size[p]]
    if not held:
        return [False] * n
    smooth = smoothed(page.parent, ratio)
    mean = sum(ratio) / len(held)
    spread = math.sqrt(sum((ratio[p] - mean) ** 2 for p in held) / len(held))
    chosen = [smooth[p] > 0 and smooth[p] >= REACH * (spread or mean) for p in range(n)]
    # Sums over whole subtrees; a path comes behind the one above it.
    mass, all_text, links = [size[p] if chosen[p] else 0 for p in range(n)], size[:], [size[p] - plain[p] for p in range(n)]
    depth = [0] * n
    for p in range(n - 1, 0, -1):
        for sums in (mass, all_text, links):
            sums[page.parent[p]] += sums[p]
    for p in range(1, n):
        depth[p] = depth[page.parent[p]] + 1
    holders = [p for p in range(1, n) if mass[p] >= HOLDS * mass[0] and page.block[p] and page.step[p].split(".")[0] not in ("html", "body", "p")]
    holder = max(holders, key=depth.__getitem__, default=0)
    inside, menu = [False] * n, [False] * n
    for p in range(1, n):
        up = page.parent[p]
        inside[p] = p == holder or inside[up]
        menu[p] = menu[up] or p != holder and page.block[p] and links[p] > LINKED * all_text[p]
    return [(inside[p] if holder else chosen[p]) and not menu[p] for p in range(n)]


def main_text(page: str | None, ratios: bool = True, lists: bool = True) -> str:
    """``ratios`` and ``lists`` switch off the judgement of paths and the priors, to
    see what each decides."""
    held = read(page or "")
    stands = boilerplate(held) if lists else [False] * len(held.above)
    texts = [x for x in held.nodes if x[1] == LINE_BREAK or not stands[x[3]]]
    total = sum(_visible(x[2]) for x in texts if not x[4])
    within = sum(_visible(x[2]) for x in texts if not x[4] and x[5])
    if lists and within and within >= ARTICLE * total:
        texts = [x for x in texts if x[5]]
    asked = [(path, text, link) for _, path, text, _, link, _ in texts if path != LINE_BREAK]
    chosen = chosen_paths(held, asked) if ratios else [True] * len(held.parent)
    blocks: dict[int, list[str]] = {}
    for block, path, text, _, _, _ in texts:
        if path == LINE_BREAK:
            if block in blocks:
                blocks[block].append(text)
        elif chosen[path]:
            blocks.setdefault(block, []).append(text)
    joined = (" ".join("".join(parts).split()) for parts in blocks.values())
    return "\n".join(t for t in joined if t)


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p) for p in batch.column("html").to_pylist()]
            yield pa.record_batch({
                "page_id": batch.column("page_id"),
                "url": batch.column("url"),
                "text": pa.array(texts, pa.string()),
                "n_chars": pa.array([len(t) for t in texts], pa.int64()),
            })

    asked = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return asked.mapInArrow(run, "page_id long, url string, text string, n_chars long")
