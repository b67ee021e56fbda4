"""Operator 6: HTML extraction by wrapper induction.

Pages of a host are aligned by simple tree matching: the largest matching of
two DOM trees that keeps labels, order and ancestry.  Runs of equal leaves
count as one repeated slot.  Over the aligned pages a slot's text that stands
on most of them is template; texts that vary are content, unless the slot
plays another part (menu, footer, advert, form, comments ...) by its element,
or is mostly links.  Where a page marks its article, content stands inside it.
Class, id or role names of another part are evidence only: what stands below
them is not content where that is a small share of the aligned pages' text, or,
inside a marked article, not nearly all of the article's.  They say nothing
about ``html``, ``body``, ``main``, ``article`` or what holds the marked article.
A page-wide form (one that holds the marked article or most of the page's text),
and any other part that holds the marked article with most of the text, is no
other part.  A text that stands in one slot of most pages is template inside an
article too.

A host of more than ``GROUP_PAGES`` pages is dealt by a hash of the page into
groups of about that many; every other host is one group.  A group induces its
wrapper from all its pages, so what a page's text is depends on the pages alone,
not on how they are stored or shuffled, and no group is the short rest of a host.  A
host with a third of all pages is many groups.  Hosts' page counts are narrow rows; those of
the large hosts are broadcast behind a size check, and one shuffle of the
pages is all there is.  Copies of a page count once, so that they don't make its
text a template.

Defined results: null or empty html has the empty text; a null or odd url is a
host of its own kind; a page without article, template or other evidence keeps
all text that plays no other part; elements nested deeper than ``DEEPEST``
aren't aligned, their text counts for the slot of the one at that depth.  Blocks are joined by two line feeds; white space in
a block, line breaks included, is one space.
"""

from __future__ import annotations

import html as entities
import math
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import bounded_broadcast

#: Pages of a group; least distinct pages and least share of them that make a text template.
GROUP_PAGES, LEAST_PAGES, CONSTANT = 256, 4, 0.6
#: Share of link text from which a slot outside an article is a menu; deepest nesting aligned.
LINKED, DEEPEST = 0.5, 100
#: Share of the text below which an element named as another part is one.
SMALL = 0.3
#: Share of an article's text above which a name inside it says nothing.
NEARLY_ALL = 0.8

# Elements of HTML by the part they play.
INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q s samp "
             "small span strike strong sub sup time tt u var wbr "
             "math semantics mrow mi mn mo ms mtext mfrac msqrt mroot msub msup msubsup munder mover munderover mtable mtr "
             "mtd mstyle mpadded mphantom mspace".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template textarea title iframe object svg select xmp noembed noframes "
          "annotation annotation-xml".split())
OTHER_PARTS = set("nav header footer aside form button dialog menu head canvas audio video".split())
# Elements that names say nothing about; words in class, id or role that name another part.
OWN_PARTS = set("html body main article".split())
OTHER_WORDS = set("ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner nav "
                  "navbar navigation menu breadcrumb breadcrumbs sidebar aside complementary contentinfo footer header "
                  "masthead cookie cookies consent gdpr notice notices alert popup modal newsletter subscribe "
                  "subscription comment comments disqus reply replies respond share sharing social related "
                  "recommended widget toolbar pagination pager search login signup".split())
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
          "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"},
          "body": {"head"}}
SCOPES = set("ul ol dl table div article section main body html blockquote nav aside footer header form".split())

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)", re.S)
_NAMES = re.compile(r"(?:\s|^)(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
_SPLIT = re.compile(r"[^a-z0-9]+")
_HOST = re.compile(r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)")


class Node:
    __slots__ = ("tag", "label", "other", "inside", "children", "slot", "marks", "hint", "named", "anchor", "words",
                 "size", "holds", "key")

    def __init__(self, tag, label="", marks=False, words=frozenset()):
        self.tag, self.label, self.marks, self.words = tag, label or tag, marks, words
        self.children: list[Node] = []
        self.slot = -1
        self.hint = self.other = self.inside = self.holds = False
        self.size = 0                                # characters of text below it
        self.key: int | None = None                  # of the labels below it, see ``form_of``
        self.anchor = self                           # the element whose slot its text counts for
        self.named: Node | None = None               # the outermost element round it, or itself, of such a name


class Page:
    """The block elements of a page, and its blocks: [node, text, characters in links]."""

    def __init__(self, source: str):
        self.root = Node("#page")
        self.blocks: list[tuple[Node, str, int]] = []
        self.marked = False
        stack, said, linked, in_link, at = [self.root], [], 0, 0, 0
        opened: dict[str, int] = {}                  # open elements by tag

        def close():
            node = stack.pop()
            opened[node.tag] -= 1
            return node

        def flush():
            nonlocal linked
            text = " ".join(entities.unescape("".join(said)).split())
            if text:
                self.blocks.append((stack[-1], text, linked))
            said.clear()
            linked = 0

        def say(text):
            nonlocal linked
            said.append(text)
            if in_link:
                linked += len(text.strip())

        while at < len(source):
            found = _MARKUP.search(source, at)
            if not found:
                say(source[at:])
                break
            if found.start() > at:
                say(source[at:found.start()])
            at = found.end()
            closing, name, rest = found.group(1, 2, 3) if found.group(2) else found.group(4, 5, 6)
            if not name:                             # a comment or declaration
                continue
            tag = name.lower()
            if tag in RAW and not closing:
                end = re.compile(rf"</{re.escape(tag)}[^>]*>", re.I).search(source, at)
                if not (rest or "").endswith("/"):
                    at = end.end() if end else len(source)
                continue
            if tag in INLINE:
                if tag == "br":
                    say(" ")
                elif tag == "a":
                    in_link = 0 if closing else 1
                continue
            if tag in VOID:
                if tag == "hr":
                    flush()
                continue
            if closing:
                if opened.get(tag):
                    flush()
                    while close().tag != tag:
                        pass
                    in_link = 0
                continue
            flush()
            in_link = 0
            ends = CLOSES.get(tag, {"p"})
            while len(stack) > 1 and stack[-1].tag in ends and (stack[-1].tag not in SCOPES):
                close()
            if any(opened.get(t) for t in CLOSES.get(tag, ())):                        # an open element of the kind, below others
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth].tag in SCOPES:
                        break
                    if stack[depth].tag in CLOSES[tag]:
                        while len(stack) > depth:
                            close()
                        break
            names = _NAMES.findall(rest or "")
            words = {w for _, v in names for w in _SPLIT.split(v.strip("\"'").lower()) if w}
            parent = stack[-1]
            marks = tag in ("article", "main") or "main" in words and "role" in {k.lower() for k, _ in names}
            label = tag + "".join(sorted("." + v.strip("\"'").lower() for k, v in names if k.lower() == "class"))
            node = Node(tag, label, marks, words & OTHER_WORDS)
            parent.children.append(node)
            if len(stack) > DEEPEST:
                node.anchor = parent.anchor
            stack.append(node)
            opened[tag] = opened.get(tag, 0) + 1
        flush()
        self._parts()
        self._name()

    def _parts(self):
        """Which elements play another part by their tag, and which mark the article."""
        for node, text, _ in self.blocks:
            node.size += len(text)
        order = list(self._walk())
        for node, parent in reversed(order):
            if parent:
                parent.size += node.size
                parent.holds |= node.holds or node.marks
        for node, parent in order:
            if not parent:
                continue
            most = 2 * node.size > self.root.size
            page_wide = node.holds and most or node.tag == "form" and (node.holds or most)
            own_head = node.tag == "header" and parent.inside            # the article's own head
            node.other = parent.other or node.tag in OTHER_PARTS and not own_head and not page_wide
            node.marks = node.marks and not node.other
            node.inside = parent.inside or node.marks
            node.hint = node.tag not in OWN_PARTS and bool(node.words) and not (parent.inside and node.words == {"header"})

    def _walk(self):
        todo = [(self.root, None)]
        while todo:
            node, parent = todo.pop()
            yield node, parent
            todo += [(child, node) for child in node.children]

    def _name(self):
        """Which elements stand below a name of another part, and inside the marked article."""
        marks, parents = [], {}
        for node, parent in self._walk():
            parents[node] = parent
            node.named = parent and parent.named or (node if node.hint else None)
            if node.marks:
                marks.append(node)
        free = {n for n in marks if not n.named}
        if marks and not free:                       # names round the only marked article say nothing
            free = set(marks)
            for node in marks:
                while node:
                    node.hint, node = False, parents[node]
        for node, parent in self._walk():
            node.named = parent and parent.named or (node if node.hint else None)
            node.inside = bool(parent and parent.inside) or node in free
        self.marked = bool(free)


def shape(node: Node) -> list[list[Node]]:
    """A node's children, runs of equal leaves as one."""
    runs: list[list[Node]] = []
    for child in node.children:
        if runs and not child.children and not runs[-1][0].children and runs[-1][0].label == child.label:
            runs[-1].append(child)
        else:
            runs.append([child])
    return runs


def form_of(node: Node) -> int:
    """A hash of the labels of a subtree: equal for subtrees that are alike."""
    todo = [node]
    while todo:
        here = todo[-1]
        below = [c for c in here.children if c.key is None]
        if here.key is None and below:
            todo += below
            continue
        if here.key is None:
            here.key = hash((here.label, *(c.key for c in here.children)))
        todo.pop()
    return node.key


def tree_match(a: Node, b: Node, pairs: list | None = None, depth: int = 0) -> int:
    """Simple tree matching: nodes in the largest matching of two trees, 0 if the roots' labels differ.

    pairs: gets the matched (node of a, node of b); a run of leaves stands for its nodes."""
    if a.label != b.label:
        return 0
    left, right = (shape(a), shape(b)) if depth < DEEPEST else ([], [])
    m, n = len(left), len(right)
    if pairs is not None:
        pairs.append((a, b))
    if not m or not n:
        return 1
    # runs that are alike are matched once: by label, the places of the runs of each form and length (one or more)
    alike: dict[str, dict[tuple, list[int]]] = {}
    for j, y in enumerate(right):
        alike.setdefault(y[0].label, {}).setdefault((form_of(y[0]), len(y) > 1), []).append(j)
    known: dict[tuple, np.ndarray] = {}

    def weights_of(x):
        key = (form_of(x[0]), len(x) > 1)
        if key not in known:
            known[key] = np.zeros(n, np.int32)
            for places in alike[x[0].label].values():
                known[key][places] = _run_match(x, right[places[0]], None, depth + 1)
        return known[key]

    def rows(row, i, stop):
        """The rows of scores from i to stop, after ``row``."""
        for x in left[i:stop]:
            best = row.copy()
            if x[0].label in alike:
                best[1:] = np.maximum.accumulate(np.maximum(row[1:], row[:-1] + weights_of(x)))
            row = best
            yield row

    # every step-th row is kept, those between are made again for the way back
    step = max(64, math.isqrt(m))
    kept, row = [np.zeros(n + 1, np.int32)], None
    for i, row in enumerate(rows(kept[0], 0, m), 1):
        if i % step == 0:
            kept.append(row)
    total = int(row[n])
    if pairs is not None:
        i, j = m, n
        while i and j:
            base = (i - 1) // step
            score = [kept[base], *rows(kept[base], base * step, i)]
            while i > base * step and j:
                here = score[i - base * step]
                if here[j] == score[i - base * step - 1][j]:
                    i -= 1
                elif here[j] == here[j - 1]:
                    j -= 1
                else:
                    i, j = i - 1, j - 1
                    _run_match(left[i], right[j], pairs, depth + 1)
    return 1 + total


def _run_match(x: list[Node], y: list[Node], pairs, depth: int) -> int:
    if len(x) == 1 and len(y) == 1:
        return tree_match(x[0], y[0], pairs, depth)
    if x[0].label != y[0].label or x[0].children or y[0].children:
        return 0
    if pairs is not None:
        pairs.extend((node, y[0]) for node in x)
    return 1


def main_texts(sources: list[str | None]) -> list[str]:
    """The main text of each page of one host's group."""
    parsed: dict[str, Page] = {}
    for s in sources:
        if s and s not in parsed:
            parsed[s] = Page(s)
    pages = list(parsed.values())
    pivot = max(pages, key=lambda p: (p.marked, -len(p.blocks)), default=None)   # the plainest marked page
    slots: list[Node] = []
    for page in pages:
        if page is not pivot:
            pairs: list[tuple[Node, Node]] = []
            tree_match(page.root, pivot.root, pairs)
            for node, other in pairs:
                node.slot = id(other)
                slots.append(other)                  # keeps the ids in use
        else:
            todo = [page.root]
            while todo:
                node = todo.pop()
                for run in shape(node):
                    for child in run:
                        child.slot = id(run[0])
                        todo.append(child)
            page.root.slot = id(page.root)
    seen: dict[tuple[int, int], int] = {}
    links: dict[int, list[int]] = {}
    for page in pages:
        for key in {(node.anchor.slot, xxhash.xxh3_64_intdigest(text)) for node, text, _ in page.blocks if node.anchor.slot != -1}:
            seen[key] = seen.get(key, 0) + 1
        for node, text, linked in page.blocks:
            share = links.setdefault(node.anchor.slot, [0, 0])
            share[0] += linked
            share[1] += len(text)
    # text below each element of a telling name, and of the pages, or the articles, that have it
    below: dict[int, list[int]] = {}
    for page in pages:
        total, article, named = 0, 0, {}
        for node, text, _ in page.blocks:
            if not node.other:
                total += len(text)
                article += len(text) * node.inside
                if node.named:
                    named[node.named] = named.get(node.named, 0) + len(text)
        for node, n in named.items():
            one = below.setdefault(node.slot if node.slot != -1 else id(node), [0, 0])
            one[0] += n
            one[1] += article if node.inside else total
    often = max(LEAST_PAGES, CONSTANT * len(pages))
    out = {}
    for source, page in parsed.items():
        kept = []
        for node, text, linked in page.blocks:
            if node.other or page.marked and not node.inside:
                continue
            if node.named:
                share = below[node.named.slot if node.named.slot != -1 else id(node.named)]
                if share[0] < (NEARLY_ALL if node.named.inside else SMALL) * share[1]:
                    continue
            if seen.get((node.anchor.slot, xxhash.xxh3_64_intdigest(text)), 0) >= often:
                continue                             # template
            share = links[node.anchor.slot] if node.anchor.slot != -1 else [linked, len(text)]
            if not node.inside and share[0] > LINKED * share[1]:
                continue
            kept.append(text)
        out[source] = "\n\n".join(kept)
    return [out.get(s, "") if s else "" for s in sources]


def _extract(batches):
    """Rows sorted by group: each group's texts; copies of one page beyond twice ``GROUP_PAGES`` rows are a run of their own."""
    held, count, group = [], 0, None

    def out(rows: pa.Table):
        texts = main_texts(rows.column("html").to_pylist())
        return pa.RecordBatch.from_arrays(
            [rows.column("page_id").combine_chunks(), rows.column("url").combine_chunks(),
             pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            names=["page_id", "url", "text", "n_chars"])

    for batch in batches:
        if not len(batch):
            continue
        keys = list(zip(batch.column("grp").to_pylist(), batch.column("part").to_pylist()))
        cuts = [i for i in range(1, len(keys)) if keys[i] != keys[i - 1]]
        for a, z in zip([0, *cuts], [*cuts, len(batch)]):
            if count and keys[a] != group:
                yield out(pa.Table.from_batches(held))
                held, count = [], 0
            group = keys[a]
            while a < z:
                take = min(z - a, 2 * GROUP_PAGES - count)
                held.append(batch.slice(a, take))
                a, count = a + take, count + take
                if count == 2 * GROUP_PAGES:
                    yield out(pa.Table.from_batches(held))
                    held, count = [], 0
    if held:
        yield out(pa.Table.from_batches(held))


def extract(pages: DataFrame) -> DataFrame:
    """``pages`` (page_id, url, html) -> page_id, url, text, n_chars; a row for each row."""
    host = F.lower(F.coalesce(F.regexp_extract("url", _HOST.pattern, 1), F.lit("")))
    grp = F.xxhash64(host).alias("grp")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", grp,
                        F.xxhash64("page_id", "url").alias("at"))
    large = (pages.select(grp).groupBy("grp").agg(F.count("*").alias("n")).where(F.col("n") > GROUP_PAGES)
             .select("grp", F.round(F.col("n") / GROUP_PAGES).cast("long").alias("parts")))
    dealt = (rows.join(bounded_broadcast(large), "grp", "left")
             .withColumn("part", F.pmod("at", F.coalesce("parts", F.lit(1)))))
    return (dealt.repartition("grp", "part").sortWithinPartitions("grp", "part", "at", "page_id")
            .select("grp", "part", "page_id", "url", "html")
            .mapInArrow(_extract, "page_id bigint, url string, text string, n_chars bigint"))
