"""Main text of web pages by consensus paths of each host.

Every page names its best container under a generalised path of tags and
classes (digits in class names count as one digit): from the page's root
down, the next element that still holds nearly all of the text outside links
and furniture, so an article spread over sibling elements is named by the
element around them. Spark adds up the votes per host and path; every page
is then read again with its host's winning paths (``main_text``). Pages of
one site share a template, so a page whose own scores mislead (a long notice,
a short article) is read where its siblings keep their articles.

What is no main text: fixed tags and roles (navigation, header, footer and
the like), hidden elements, and elements whose class or id names furniture
(a whole name such as ``sidebar`` or its last part as in ``site-footer``; not
a layout name such as ``has-sidebar``). A name or a form may deceive: an
element excluded for these alone stays if it holds most of the page's prose.

Votes are one small row per page, added up within tasks first, so a host
with a third of all pages is no heavier than others. The winning paths (one
row per host) join the pages by Spark's own choice: pages stay in place while
the stored path table is under its broadcast threshold, beyond it they are
shuffled by host and adaptive execution splits the large hosts.

A page is read in one pass, in time linear in its length whatever its
markup: stray quotes, unclosed tags and deep nesting included.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices, text_or_empty, written

# Fixed values of the HTML standard and of common page templates.
RAW = ("script", "style", "noscript", "template", "iframe", "svg", "math", "textarea", "select", "object", "audio",
       "video", "canvas", "title", "xmp", "noembed", "noframes")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote body br caption center dd details dialog div dl dt fieldset "
                  "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol "
                  "p pre search section summary table tbody td tfoot th thead tr ul".split())
CLOSES_P = BLOCK - {"br", "body", "html", "caption", "dd", "dt", "legend", "li", "summary", "tbody", "td", "tfoot",
                    "th", "thead", "tr", "figcaption"}
SAME_KIND = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
             "th": ("td", "th"), "option": ("option",)}
NOT_MAIN = frozenset("nav header footer aside menu button dialog search head label".split())
NOT_MAIN_ROLE = frozenset("navigation banner contentinfo complementary search dialog alert form menu".split())
NOT_MAIN_NAME = frozenset(
    "ad ads advert adverts advertisement advertisements advertising banner breadcrumb breadcrumbs comment comments commentlist "
    "consent cookie cookies disqus footer gdpr header masthead menu modal nav navbar navigation newsletter notice notices "
    "notification overlay pagination pager popup promo promoted promotion related replies respond share sharing sidebar sidebox "
    "signup social sponsor sponsored subscribe subscription toolbar widget".split())
LAYOUT_PREFIX = frozenset("has have no not with without is hide show".split())       # has-sidebar names a layout
CONTAINER = frozenset("main article section div td center details form".split())
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dd dt figcaption td".split())
STOP_P = frozenset("html body main article section div td th table button".split())
LISTS = frozenset("ul ol dl table tbody thead tfoot menu html body main article section div".split())
DECLARED = ("article", "main")

OPEN_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)|<!--|<!\[CDATA\[|<[!?]|</(?=[^a-zA-Z])")
ATTRIBUTE_NAME = re.compile(r"[\s/]*([^\s/>][^\s/>=]*)(\s*=\s*)?")
SPACE_OR_SLASH = re.compile(r"[\s/]*")
UNQUOTED = re.compile(r"[^\s>]*")
HIDING = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
NAME_PART = re.compile(r"[-_]+")
DIGITS = re.compile(r"\d+")
WHITE = re.compile(r"\s+")
RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>]|$)[^>]*(?:>|$)", re.I) for tag in RAW}

NEARLY_ALL, MOST = 0.8, 0.5      # of a page's prose: to go on to a child; to keep a path, or what only a name excludes


def names_furniture(names: str) -> bool:
    """Whether a class list (or an id) names what is no main text."""
    for name in names.lower().split():
        parts = NAME_PART.split(name)
        if parts[-1] in NOT_MAIN_NAME and parts[0] not in LAYOUT_PREFIX:
            return True
    return False


class Page:
    """A parsed page: its blocks in order, the tree of its container paths, and what only a name excludes.

    ``parent`` and ``label`` describe the nodes of the path tree (0 is the
    root); equal paths are one node. A block is ``(node, text, linked,
    prose, doubt)``: its container, its length inside links, whether a
    paragraph or the like encloses it, and the innermost doubtful element
    around it (-1: none). ``doubts`` has each doubtful element's next one outwards.
    """

    def __init__(self):
        self.parent, self.label, self.nodes = [-1], ["body"], {}
        self.blocks: list[tuple[int, str, int, bool, int]] = []
        self.doubts: list[int] = []
        self._main: list[tuple[int, str, int, bool]] | None = None

    def node(self, above: int, label: str) -> int:
        found = self.nodes.setdefault((above, label), len(self.parent))
        if found == len(self.parent):
            self.parent.append(above)
            self.label.append(label)
        return found

    def main(self) -> list[tuple[int, str, int, bool]]:
        """Blocks of main text. A doubtful element counts as main text if it holds most of the prose."""
        if self._main is None:
            inside, total = [0.0] * len(self.doubts), 0.0
            for _, text, linked, prose, doubt in self.blocks:
                value = _value(text, linked, prose)
                total += value
                if doubt >= 0:
                    inside[doubt] += value
            for at in range(len(self.doubts) - 1, -1, -1):      # inner ones come later
                if self.doubts[at] >= 0:
                    inside[self.doubts[at]] += inside[at]
            out = [False] * len(self.doubts)
            for at, outer in enumerate(self.doubts):
                out[at] = inside[at] <= MOST * total or outer >= 0 and out[outer]
            self._main = [b[:4] for b in self.blocks if b[4] < 0 or not out[b[4]]]
        return self._main

    def masses(self) -> list[float]:
        """Per node the value of the main text below it."""
        mass = [0.0] * len(self.parent)
        for node, text, linked, prose in self.main():
            mass[node] += _value(text, linked, prose)
        for node in range(len(mass) - 1, 0, -1):                # children come after their parents
            mass[self.parent[node]] += max(0.0, mass[node])
        return mass

    def path(self, node: int) -> str:
        labels = []
        while node >= 0:
            labels.append(self.label[node])
            node = self.parent[node]
        return "/".join(reversed(labels))

    def find(self, path: str) -> int:
        """The node of a path, -1 if the page has none."""
        first, *rest = path.split("/")
        node = 0 if first == self.label[0] else -1
        for label in rest:
            node = self.nodes.get((node, label), -1)
        return node

    def text_below(self, node: int) -> tuple[str, float]:
        """Main text below a node, its blocks joined by one space, and its value."""
        if node < 0:
            return "", 0.0
        inside = [False] * len(self.parent)
        inside[node] = True
        for at in range(node + 1, len(inside)):
            inside[at] = inside[self.parent[at]]
        held = [b for b in self.main() if inside[b[0]]]
        return " ".join(text for _, text, _, _ in held), sum(_value(text, linked, prose) for _, text, linked, prose in held)


def _value(text: str, linked: int, prose: bool) -> float:
    return max(0, len(text) - 2 * linked) * (1.0 if prose else 0.5)


class _Attributes:
    """Reads a tag's attributes; remembers from where on a page has no further closing quote."""

    def __init__(self, page: str):
        self.page, self.none_after = page, {'"': len(page), "'": len(page)}

    def read(self, at: int) -> tuple[dict[str, str], int, bool]:
        """Attributes from ``at`` on, where the tag ends, and whether it closes itself."""
        page, named, end = self.page, {}, len(self.page)
        while True:
            blank = SPACE_OR_SLASH.match(page, at).end()
            if blank >= end:
                return named, end, False
            if page[blank] == ">":
                return named, blank + 1, blank > at and page[blank - 1] == "/"
            found = ATTRIBUTE_NAME.match(page, blank)
            name, at, value = found.group(1).lower(), found.end(), ""
            if found.group(2):
                quote = page[at:at + 1]
                stop = -1
                if quote in self.none_after and quote and at + 1 < self.none_after[quote]:
                    stop = page.find(quote, at + 1)
                    if stop < 0:
                        self.none_after[quote] = at + 1
                if stop >= 0:
                    value, at = page[at + 1:stop], stop + 1
                else:
                    stop = UNQUOTED.match(page, at).end()
                    value, at = page[at:stop], stop
            named.setdefault(name, value)


def parse(page: str) -> Page:
    """The page's blocks in order.

    Tolerant of wrong markup: unclosed and stray tags, a comment or raw
    element without end (it runs to the end of the page), a paragraph inside
    a paragraph (the first is closed), a less-than sign in prose, quotes
    without end.
    """
    out, read = Page(), _Attributes(page)
    # tag, container node, inside prose, inside a link, excluded, innermost doubtful element
    stack: list[tuple[str, int, bool, bool, bool, int]] = []
    here = ("", 0, False, False, False, -1)
    opened: Counter = Counter()
    buffer: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        if buffer:
            if not here[4]:
                text = WHITE.sub(" ", entities.unescape("".join(buffer))).strip()
                if text:
                    out.blocks.append((here[1], text, min(linked, len(text)), here[2], here[5]))
            buffer.clear()
        linked = 0

    def close(depth: int) -> None:
        nonlocal here
        if any(entry[0] in BLOCK for entry in stack[depth:]):
            flush()
        for entry in stack[depth:]:
            opened[entry[0]] -= 1
        del stack[depth:]
        here = stack[-1] if stack else ("", 0, False, False, False, -1)

    at, end = 0, len(page)
    while at < end:
        found = OPEN_TAG.search(page, at)
        start = found.start() if found else end
        if start > at:
            buffer.append(page[at:start])
            if here[3]:
                linked += start - at
        if found is None:
            break
        at = found.end()
        slash, tag = found.groups()
        if tag is None:
            mark = found.group()
            stop = {"<!--": "-->", "<![CDATA[": "]]>"}.get(mark, ">")
            closed = page.find(stop, at if mark != "<!--" else start + 2)
            at = closed + len(stop) if closed >= 0 else end
            continue
        tag = tag.lower()
        named, at, alone = read.read(at)
        if slash:
            if opened[tag]:
                depth = len(stack) - 1
                while stack[depth][0] != tag:
                    depth -= 1
                close(depth)
            elif tag == "p":
                flush()
            continue
        if tag in RAW_END:
            if not (alone and tag in ("svg", "math", "object")):
                stop = RAW_END[tag].search(page, at)
                at = stop.end() if stop else end
            continue
        if tag in BLOCK:
            flush()
        if tag in VOID:
            continue
        if tag in CLOSES_P and opened["p"]:
            depth = len(stack) - 1
            while depth >= 0 and stack[depth][0] not in STOP_P:
                if stack[depth][0] == "p":
                    close(depth)
                    break
                depth -= 1
        elif tag in SAME_KIND and any(opened[k] for k in SAME_KIND[tag]):
            depth = len(stack) - 1
            while depth >= 0 and stack[depth][0] not in LISTS:
                if stack[depth][0] in SAME_KIND[tag]:
                    close(depth)
                depth = min(depth, len(stack)) - 1
        _, node, prose, in_link, excluded, doubt = here
        label = named.get("class", "")
        excluded = (excluded or tag in NOT_MAIN or "hidden" in named or named.get("role", "").lower() in NOT_MAIN_ROLE
                    or named.get("aria-hidden", "").lower() == "true" or bool(HIDING.search(named.get("style", ""))))
        if tag not in ("body", "html", *DECLARED) and (
                tag == "form" or label and names_furniture(label) or "id" in named and names_furniture(named["id"])):
            out.doubts.append(doubt)
            doubt = len(out.doubts) - 1
        if tag in CONTAINER:
            classes = ".".join(sorted(set(DIGITS.sub("0", label.lower()).replace("/", "|").split())))
            node, prose = out.node(node, f"{tag}.{classes}" if classes else tag), tag in PROSE
        elif tag in PROSE:
            prose = True
        here = (tag, node, prose, in_link or tag == "a", excluded, doubt)
        stack.append(here)
        opened[tag] += 1
    flush()
    return out


def best_container(page: Page) -> tuple[str, float] | None:
    """The path of the page's best container and the value of what it holds; None without main text.

    An article or main element with text is a declaration, not a guess: the
    one with the most. Else the deepest element, from the root down, that
    holds nearly all of what the one around it holds.
    """
    mass = page.masses()
    declared = [n for n in range(len(mass)) if mass[n] > 0 and page.label[n].split(".")[0] in DECLARED]
    if declared:
        inner = max(declared, key=lambda n: (mass[n], n))
        return page.path(inner), mass[inner]
    if mass[0] <= 0:
        return None
    heaviest = [-1] * len(mass)
    for n in range(1, len(mass)):
        above = page.parent[n]
        if heaviest[above] < 0 or mass[n] > mass[heaviest[above]]:
            heaviest[above] = n
    best = 0
    while heaviest[best] >= 0 and mass[heaviest[best]] >= NEARLY_ALL * mass[best]:
        best = heaviest[best]
    return page.path(best), mass[best]


def main_text(page: Page, paths: Iterable[str] = (), lead: str | None = None) -> str:
    """The page's main text, given its host's winning paths and the one, if any, that most pages of the host chose.

    A page whose own best container is a winning path is read there; else at
    the first winning path that holds most of its prose; else at the host's
    leading path if the page has text there (its own scores mislead); else
    at its own container.
    """
    own = best_container(page)
    if own is None:
        return ""
    paths = list(paths)
    if own[0] not in paths:
        for path in paths:
            text, value = page.text_below(page.find(path))
            if text and value >= MOST * own[1]:
                return text
        text, _ = page.text_below(page.find(lead)) if lead else ("", 0.0)
        if text:
            return text
    return page.text_below(page.find(own[0]))[0]


HOST = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)"


def container_votes(pages: DataFrame, url_col: str, html_col: str) -> DataFrame:
    """``(host, path, votes, score)``: how many pages of a host chose a path, and their scores' sum."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            best = [best_container(parse(p)) for p in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([b and b[0] for b in best], pa.string()),
                 pa.array([b and b[1] for b in best], pa.float64())], ["host", "path", "score"])

    return (pages.select(_host(url_col).alias("host"), text_or_empty(html_col).alias("html"))
            .mapInArrow(run, "host string, path string, score double").where("path is not null")
            .groupBy("host", "path").agg(F.count(F.lit(1)).alias("votes"),
                                         F.sum(F.round("score").cast("long")).alias("score")))


def _host(url_col: str):
    return F.lower(F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), HOST, 1))


def winning_paths(votes: DataFrame, keep: int = 3) -> DataFrame:
    """``(host, paths, lead)``: a host's paths by votes, then score, then name; a path needs a tenth of the votes.

    A tenth bounds the list to ten paths; ``keep`` of them are tried. A page's
    vote for itself alone wins nothing where there are others. ``lead`` is the
    first path if it has over half of the votes.
    """
    # a host has as many paths as its templates; the ranked list is built from those with a tenth of the votes
    total = votes.groupBy("host").agg(F.sum("votes").alias("all"))
    strong = votes.join(total, "host").where((F.col("votes") * 10 >= F.col("all"))
                                             & ((F.col("votes") > 1) | (F.col("votes") * 2 > F.col("all"))))
    order = F.sort_array(F.collect_list(F.struct(-F.col("votes"), -F.col("score"), F.col("path"))))
    leading = F.max(F.when(F.col("votes") * 2 > F.col("all"), F.col("path"))).alias("lead")
    return strong.groupBy("host").agg(F.slice(order, 1, keep).alias("ranked"), leading).select(
        "host", F.transform("ranked", lambda r: r["path"]).alias("paths"), "lead")


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                      keep: int = 3) -> DataFrame:
    """Per row: id, url, ``text`` and ``n_chars`` (code points).

    Which of its host's winning paths a page is read at says ``main_text``. NULL and empty pages, and pages without main text, give the
    empty text. URLs without a host (NULL, relative) vote together as one
    host with no name. Repeated rows are separate pages; other columns are
    not read; an empty table gives no rows.
    """
    votes, _ = written(container_votes(pages, url_col, html_col), "host-votes")     # used twice below
    paths, _ = written(winning_paths(votes, keep), "host-paths")
    kind, url_kind = pages.schema[id_col].dataType, pages.schema[url_col].dataType
    slim = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), _host(url_col).alias("host"),
                        text_or_empty(html_col).alias("html"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [main_text(parse(page), ranked or (), lead) for page, ranked, lead in
                     zip(*(batch.column(k).to_pylist() for k in (2, 3, 4)))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array(np.array([len(t) for t in texts], np.int64))], ["id", "url", "text", "n_chars"])

    schema = T.StructType([T.StructField("id", kind), T.StructField("url", url_kind),
                           T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    return (slim.join(paths, "host", "left").select("id", "url", "html", "paths", "lead")
            .mapInArrow(run, schema).withColumnsRenamed({"id": id_col, "url": url_col}))


__all__ = ["parse", "Page", "best_container", "main_text", "names_furniture", "container_votes", "winning_paths", "extract_main_text"]
