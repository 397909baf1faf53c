"""Main text of web pages by tag-path ratios.

A page becomes blocks: the runs of text between block-level tags, each with its root-to-leaf
tag path (names with their classes and ids; inline tags are no part of it). Then

1. text length and punctuation are summed for each path; their ratios to the number of its
   blocks, less what is link text, give every block two values in page order;
2. both sequences are smoothed with a Gaussian and fused (geometric mean);
3. a path passes if the mean fused value of its blocks reaches a share of their standard deviation and it is not mostly
   links. A path that ends in a plain container (``div``, ``section``) must reach that by its own
   ratios too, since smoothing lends it those of its neighbours;
4. names, roles and classes of elements are hints. Paths under one of a menu, footer, form, advert, comment and
   so on do not count, unless that element holds nearly all that passes: then it is what the page is about;
5. what passes selects the blocks: those of passing paths, and around them the headings, list items, cells and short
   paragraphs of the same ``article`` or ``main`` element or, on pages without one, of the same container.

Scripts, styles, controls and hidden elements have no blocks. Everything is linear in the size of the page (times a logarithm for
hints inside hints): tags are cut by patterns that never go back, paths are numbers of parent and label, and no step walks up the
open elements. Link text is that of an ``a`` with an address, up to its end or the end of its first block.

Pages are independent, so this is one pass over Arrow batches without a shuffle.
"""

from __future__ import annotations

import heapq
import html
import re
import string
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gazette.llm.shared import chunks, table

#: Standard deviation, in blocks, of the smoothing Gaussian.
SMOOTH = 1.0
#: Share of the standard deviation that a content path's mean must reach.
THRESHOLD = 0.5
#: Share of link text from which a path is a list of links.
LINKS = 0.5
#: A hint is disregarded if all unhinted content has less than this share of the text under it ...
DOMINATED = 0.25
#: ... or than this, where the hint is of readers' comments or the rest is an article.
DOMINATED_STRICT = 0.02
#: Factor for paths under an element that has a hint's word in a longer name.
WEAK_HINT = 0.5

# Element names of HTML and common class names.
INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr picture q rp rt ruby s samp small source span strike strong sub sup time tt u var wbr".split())
VOID = set("area base br col embed frame hr img input link meta param source track wbr".split())
#: Hold no text of the page, whatever their classes.
NO_TEXT = set("applet audio button canvas datalist dialog frameset head iframe map meter noframes noscript object optgroup option output progress script select style svg template textarea title video".split())
#: Elements that are hints by their names; the last only outside an article.
HINT_TAGS = set("aside footer form menu nav".split())
HINT_OUTSIDE = {"header"}
ARTICLES = {"article", "main"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Elements that hold a run of text by their nature; paths that end in others are plain containers.
TEXTUAL = HEADINGS | set("address blockquote caption dd dt figcaption legend li p pre summary td th".split())
PAGE = {"", "html", "body"}
ROLES = set("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search tablist toolbar".split())
REACTIONS = set("comment comments disqus replies reply respond responses".split())
HINTS = REACTIONS | set(
    "ad ads adbox adsense advert adverts advertisement advertising banner breadcrumb breadcrumbs cookie cookies consent disclaimer dropdown footer gdpr hidden masthead menu modal nav navbar "
    "navigation newsletter notice notices notification pagination pager popup promo promotion recommend recommended related share sharing sidebar signup social sponsor sponsored subscribe subscription "
    "teaser toolbar topbar widget".split()
)
#: Parts of names that say nothing about what an element holds.
NEUTRAL = set("area bar block box bottom container content first group inner item items last left links list main outer panel right section site title top wrap wrapper".split())
#: A name that begins so tells of something elsewhere.
ELSEWHERE = {"has", "is", "js", "no", "with", "without"}
#: An opening tag ends an open element of these, up to a barrier.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"}, "option": {"option"}}
BARRIERS = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}, "tbody": {"table"}, "tfoot": {"table"}, "option": {"select"}}
#: What keeps an open paragraph from being ended by a block inside.
PARAGRAPH_BARRIERS = {"article", "section", "div", "td", "th", "li", "body", "main", "table", "button", "object"}
PUNCTUATION = re.compile("[" + re.escape(string.punctuation + "…“”‘’«»„–—·¿¡、。，；：？！「」") + "]")


def hint(names: list[str]) -> tuple[float, bool]:
    """(factor, of readers' comments) of an element's classes and id: 0 if a name is that of a hint, WEAK_HINT if a part is, else 1."""
    factor, reaction = 1.0, False
    for name in names:
        parts = [x for x in re.split(r"[-_]+", name) if x and not x.isdigit()]
        if not parts or parts[0] in ELSEWHERE:
            continue
        telling = [x for x in parts if x not in NEUTRAL]
        if telling and telling[-1] in HINTS and parts[-1] in HINTS | NEUTRAL:
            factor, reaction = 0.0, reaction or telling[-1] in REACTIONS
        elif HINTS & set(parts):
            factor = min(factor, WEAK_HINT)
    return factor, reaction


class Paths:
    """Tag paths as numbers: each has its parent (a smaller number), leaf tag, and what its label says."""

    def __init__(self):
        self.known: dict[tuple, int] = {}
        self.parent, self.tag, self.no_text, self.article = [0], [""], [False], [-1]
        #: The nearest hint at or above a path (-1: none), and of hints whether they are of comments.
        self.hint, self.weak, self.reaction = [-1], [1.0], [False]

    def below(self, parent: int, tag: str, attrs: tuple[tuple[str, str], ...] = ()) -> int:
        key = (parent, tag, attrs)
        found = self.known.get(key)
        if found is None:
            found = self.known[key] = len(self.parent)
            self._add(found, parent, tag, dict(attrs))
        return found

    def _add(self, new: int, parent: int, tag: str, given: dict[str, str]) -> None:
        factor, reaction = hint(given["names"].split()) if "names" in given else (1.0, False)
        inside = self.article[parent] >= 0
        if tag in ("html", "body", "main"):
            factor = 1.0
        elif tag in HINT_TAGS or (tag in HINT_OUTSIDE and not inside) or given.get("role", "") in ROLES:
            factor = 0.0
        self.parent.append(parent)
        self.tag.append(tag)
        self.no_text.append(self.no_text[parent] or tag in NO_TEXT or "hidden" in given)
        self.article.append(self.article[parent] if inside else new if tag in ARTICLES else -1)
        self.hint.append(new if factor == 0 else self.hint[parent])
        self.weak.append(min(self.weak[parent], factor) if factor else self.weak[parent])
        self.reaction.append(reaction)

    def __len__(self) -> int:
        return len(self.parent)


@dataclass
class Block:
    path: int
    parts: list[str] = field(default_factory=list)
    link_chars: int = 0
    text: str = ""


#: What markup begins with, and the parts of a tag.
_MARKUP = re.compile(r"<(?=[A-Za-z/!?])")
_NAME = re.compile(r"/?([A-Za-z][^\s/>]*)")
_ATTRIBUTE = re.compile(r"""[\s/]*(?:(>)|([^\s/>][^\s/>=]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*)))?)""")
#: Elements whose content is text up to their end tag, whatever it looks like.
RAW = set("iframe noembed noframes script style textarea title xmp".split())
#: Attributes that say something about an element here.
TELLING = set("aria-hidden class hidden href id role style".split())


def events(page: str) -> Iterator[tuple[str, str, list[tuple[str, str]]]]:
    """("text" | "start" | "end" | "empty", text or lower-case name, attributes) of a page.

    Every character is looked at a bounded number of times: a comment, tag or raw element that isn't closed reaches to the
    end of the page, as the HTML standard has it, so nothing is tried again from behind it.
    """
    at, size = 0, len(page)
    while at < size:
        m = _MARKUP.search(page, at)
        begin = m.start() if m else size
        if begin > at:
            yield "text", html.unescape(page[at:begin]), []
        if not m:
            return
        name = _NAME.match(page, begin + 1)
        if name is None:
            if page.startswith("<!--", begin):
                # An end may overlap the opening: <!--> and <!---> are whole.
                end = page.find("-->", begin + 2)
            else:
                end = page.find(">", begin)
            if end < 0:
                return
            at = page.index(">", end) + 1
            continue
        tag, closing, at = name[1].lower(), page[begin + 1] == "/", name.end()
        given: dict[str, str] = {}
        slash = False
        while True:
            a = _ATTRIBUTE.match(page, at)
            if a is None:
                return  # a tag without an end
            if a[1]:
                slash = page[a.start(1) - 1] == "/" and a.start(1) > at
                at = a.end()
                break
            at = a.end()
            if (key := a[2].lower()) in TELLING and not closing:
                given.setdefault(key, html.unescape(a[3] or a[4] or a[5] or ""))
        if closing:
            yield "end", tag, []
            continue
        yield ("empty" if slash else "start"), tag, list(given.items())
        if tag in RAW and not slash:
            end_tag = re.compile(f"</{re.escape(tag)}(?=[\\s/>])", re.I).search(page, at)
            if end_tag is None:
                return
            at = end_tag.start()


class PageParser:
    """Collects the blocks of a page; unclosed and stray tags are tolerated."""

    def __init__(self):
        self.paths = Paths()
        #: Whether text is that of a link, and whether the link has had a block of its own.
        self.linked = False
        self.blocks: list[Block] = []
        self.open: Block | None = None
        #: Open elements as (tag, path); a closed one inside others has no tag any more.
        self.stack: list[tuple[str, int]] = []
        #: Where in the stack the open elements of each name are, and the block-level ones.
        self.at: dict[str, list[int]] = {}
        self.block_at: list[int] = []

    def _close_block(self) -> None:
        if self.open is not None:
            self.open.text = " ".join("".join(self.open.parts).split())
            if self.open.text:
                self.blocks.append(self.open)
                # A link that isn't closed, or is around whole blocks, is that of its first block only.
                self.linked = False
            self.open = None

    def _innermost(self, names) -> int:
        return max((self.at[n][-1] for n in names if self.at.get(n)), default=-1)

    def _cut(self, size: int) -> None:
        """Closes all open elements from a place in the stack on."""
        while len(self.stack) > size:
            tag, _ = self.stack.pop()
            if tag:
                self.at[tag].pop()
        while self.block_at and self.block_at[-1] >= size:
            self.block_at.pop()

    def _push(self, tag: str, path: int) -> None:
        self.at.setdefault(tag, []).append(len(self.stack))
        if tag not in INLINE:
            self.block_at.append(len(self.stack))
        self.stack.append((tag, path))

    def feed(self, page: str) -> None:
        for kind, what, attrs in events(page):
            if kind == "text":
                self.handle_data(what)
            elif kind == "end":
                self.handle_endtag(what)
            else:
                self.handle_starttag(what, attrs)
                if kind == "empty":
                    self.handle_endtag(what)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str]]) -> None:
        if tag in INLINE:
            if tag == "a":  # ends an open one; without an address it is no link
                self.linked = any(k == "href" for k, _ in attrs)
            if tag == "br":
                self.handle_data(" ")
            if tag not in VOID:
                given = self._given(attrs) if attrs else ()
                path = self.stack[-1][1] if self.stack else 0
                # An inline element is part of a path only where it is hidden.
                self._push(tag, self.paths.below(path, tag, (("hidden", ""),)) if ("hidden", "") in given else path)
            return
        self._close_block()
        if tag in ENDS:
            while (i := self._innermost(ENDS[tag])) > self._innermost(BARRIERS[tag]):
                self._cut(i)
        elif (i := self._innermost(("p",))) > self._innermost(PARAGRAPH_BARRIERS):  # as browsers do
            self._cut(i)
        if tag not in VOID:
            self._push(tag, self.paths.below(self.stack[-1][1] if self.stack else 0, tag, self._given(attrs) if attrs else ()))

    @staticmethod
    def _given(attrs: list[tuple[str, str]]) -> tuple[tuple[str, str], ...]:
        """What of the attributes makes a label: names, role, and whether it is hidden."""
        given = {k: v.lower() for k, v in attrs}
        out = []
        if names := " ".join(sorted(f"{given.get('class', '')} {given.get('id', '')}".split())):
            out.append(("names", names))
        if "role" in given:
            out.append(("role", given["role"]))
        if "hidden" in given or given.get("aria-hidden") == "true" or "display:none" in given.get("style", "").replace(" ", ""):
            out.append(("hidden", ""))
        return tuple(out)

    def handle_endtag(self, tag: str) -> None:
        if tag in VOID:
            return
        if tag == "a":
            self.linked = False
        if tag not in INLINE:
            self._close_block()
            i = self._innermost((tag,))
            if i >= 0 and (tag in ("html", "body") or i > self._innermost(("body",))):
                self._cut(i)
            return
        i = self._innermost((tag,))
        if i > (self.block_at[-1] if self.block_at else -1):
            self.at[tag].pop()
            self.stack[i] = ("", self.stack[i][1])
            while self.stack and not self.stack[-1][0]:
                self.stack.pop()

    def handle_data(self, data: str) -> None:
        path = self.stack[-1][1] if self.stack else 0
        if self.paths.no_text[path]:
            return
        if self.open is None:
            self.open = Block(path)
        self.open.parts.append(data)
        if self.linked:
            self.open.link_chars += len(data)

    def finish(self) -> list[Block]:
        self._close_block()
        return self.blocks


def smooth(values: np.ndarray, width: float = SMOOTH) -> np.ndarray:
    reach = int(np.ceil(2 * width))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / width) ** 2)
    weight = np.convolve(np.ones(len(values)), kernel, "full")[reach : reach + len(values)]
    return np.convolve(values, kernel, "full")[reach : reach + len(values)] / weight


@dataclass
class Ratios:
    """By path: characters of its blocks without links, share of links, fused value (smoothed; NaN: no blocks), and its own."""

    length: np.ndarray
    links: np.ndarray
    fused: np.ndarray
    own: np.ndarray
    least: float


def ratios(blocks: list[Block], n_paths: int) -> Ratios:
    path = np.array([b.path for b in blocks])
    chars, linked = np.array([len(b.text) for b in blocks], float), np.array([b.link_chars for b in blocks], float)
    count = np.bincount(path, minlength=n_paths)
    length = np.bincount(path, np.maximum(0, chars - linked), n_paths)
    marks = np.bincount(path, [len(PUNCTUATION.findall(b.text)) if b.link_chars < LINKS * len(b.text) else 0 for b in blocks], n_paths)
    per = np.maximum(count, 1)
    fused = np.sqrt(smooth((length / per)[path]) * (smooth((marks / per)[path]) + 1))
    mean = np.where(count > 0, np.bincount(path, fused, n_paths) / per, np.nan)
    share = np.bincount(path, np.minimum(linked, chars), n_paths) / np.maximum(np.bincount(path, chars, n_paths), 1)
    return Ratios(length, share, mean, np.sqrt(length / per * (marks / per + 1)), THRESHOLD * float(fused.std()))


def passing(r: Ratios, paths: Paths) -> np.ndarray:
    """Whether a path's ratios reach the threshold; the best one does at least."""
    plain = np.array([t not in TEXTUAL for t in paths.tag])
    able = (r.length > 0) & (r.links < LINKS) & ~np.isnan(r.fused)
    if not able.any():
        return able
    value = np.where(able, np.where(plain, np.minimum(r.fused, r.own), r.fused), 0) * np.array(paths.weak)
    return able & (value >= min(r.least, float(value.max())))


def disregarded(paths: Paths, good: np.ndarray, length: np.ndarray) -> set[int]:
    """The hints that hold nearly all that passes, from the outermost in."""
    rest, rest_is_article = 0.0, False
    own: dict[int, float] = {}  # by the nearest hint above
    article: set[int] = set()
    for p in np.flatnonzero(good).tolist():
        h = paths.hint[p]
        if h < 0:
            rest += float(length[p])
            rest_is_article |= paths.article[p] >= 0
        else:
            own[h] = own.get(h, 0.0) + float(length[p])
            if paths.article[p] >= 0:
                article.add(h)
    held, inner = dict(own), {}
    for h in range(len(paths) - 1, 0, -1):  # what is below a path comes first
        if paths.hint[h] == h and h in held:
            above = paths.hint[paths.parent[h]]
            inner.setdefault(above, []).append(h)
            if above >= 0:
                held[above] = held.get(above, 0.0) + held[h]
    out: set[int] = set()
    waiting = [(-held[h], h) for h in inner.get(-1, [])]
    heapq.heapify(waiting)
    while waiting:
        size, most = heapq.heappop(waiting)
        strict = rest_is_article or paths.reaction[most]
        if rest >= (DOMINATED_STRICT if strict else DOMINATED) * -size:
            break
        out.add(most)
        rest += own.get(most, 0.0)
        rest_is_article |= most in article
        for h in inner.get(most, []):
            heapq.heappush(waiting, (-held[h], h))
    return out


def selected(blocks: list[Block], paths: Paths) -> list[Block]:
    """The blocks of the article, by their paths."""
    r = ratios(blocks, len(paths))
    good = passing(r, paths)
    ignored = disregarded(paths, good, r.length)
    counted: list[bool] = [True] * len(paths)  # under no hint that counts
    for p in range(1, len(paths)):
        counted[p] = counted[paths.parent[p]] and (paths.hint[p] != p or p in ignored)
    seeds = [p for p in np.flatnonzero(good).tolist() if counted[p]]
    if not seeds:
        return []
    total = sum(r.length[p] for p in seeds)
    named = {paths.article[p] for p in seeds if paths.article[p] >= 0}
    use_named = sum(r.length[p] for p in seeds if paths.article[p] >= 0) * 2 >= total
    # A container is what text stands in directly: the parent of a paragraph, or a plain element itself.
    homes = named if use_named else {paths.parent[p] if paths.tag[p] in TEXTUAL else p for p in seeds}
    inside: list[bool] = [False] * len(paths)
    above: list[bool] = [False] * len(paths)  # a home, or an element around one
    for p in range(len(paths)):
        parent = paths.parent[p]
        if paths.tag[parent] in PAGE and not use_named and paths.tag[p] not in TEXTUAL | {"ul", "ol", "dl", "table"}:
            inside[p] = p in homes  # the page itself is no container of the sections in it
        else:
            inside[p] = p in homes or (p > 0 and inside[parent])
    for p in range(len(paths) - 1, -1, -1):
        if p in homes:
            above[p] = True
        if p and above[p]:
            above[paths.parent[p]] = True
    chosen, later, seed = set(), set(), set(seeds)
    for p in range(len(paths)):
        if not counted[p] or np.isnan(r.fused[p]):
            continue
        tag = paths.tag[p]
        if p in seed:
            ok = inside[p]
        elif inside[p]:
            ok = tag in HEADINGS or tag in TEXTUAL
            if ok and tag not in HEADINGS and not use_named and r.links[p] >= LINKS:
                later.add(p)  # links among the text or after it, such as references; before it they are a menu
        else:  # a heading over the text
            ok = not use_named and tag in HEADINGS and above[paths.parent[p]]
        if ok:
            chosen.add(p)
    first = next((i for i, b in enumerate(blocks) if b.path in seed and b.path in chosen), len(blocks))
    return [b for i, b in enumerate(blocks) if b.path in chosen and (i > first or b.path not in later)]


def main_blocks(page: str) -> list[str]:
    """The texts of a page's content blocks, in page order."""
    parser = PageParser()
    parser.feed(page)
    blocks = parser.finish()
    return [b.text for b in selected(blocks, parser.paths)] if blocks else []


def extract(df: DataFrame, column: str = "html") -> DataFrame:
    """page_id, url, text and n_chars of every row of df.

    Blocks of the text are joined by one line end. Null and empty html, and pages without text, give
    an empty text and 0. Equal rows give equal texts; an empty table gives none; columns other than page_id, url
    and ``column`` are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, pages in chunks(batches, column):
            texts = ["\n".join(main_blocks(x.decode(errors="replace"))) for x in pages]
            yield pa.RecordBatch.from_pydict({"page_id": piece.column("page_id"), "url": piece.column("url"), "text": pa.array(texts, pa.string()), "n_chars": pa.array([len(t) for t in texts], pa.int64())})

    return df.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), column).mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op6_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages."""
    return extract(table(spark, sf_dir, "pages"))
