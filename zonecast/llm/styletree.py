"""Main text of web pages by site style trees.

All pages of a host are merged into one tree: an element's place is the chain of
(tag, class words) from the body down, so equal places of different pages are
one node.  Per node two distributions are counted over all its occurrences on the
host: its *presentation* (the sequence of its children's tags, repeats as one)
and its *content* (its block texts).  With m occurrences and entropy H, the
importance is H / log m: 0 where every page shows the same, 1 where each shows
something of its own.  Nodes with fewer than ``EVIDENCE`` occurrences on their
host take their place's importance over all hosts.  Inside an ``article`` or
``main`` element, pages whose text in such elements is the same count once, so
many copies of one article on a host don't make it boilerplate.

On a page a branch's importance is the text-weighted mean of its blocks' content
importance, with ``STYLE`` parts of its presentation importance.  Branches below
``LEAST`` are removed, from the top down; an unknown place counts as important.
Beside that:

* Tag and class words name menus, headers, footers, side bars, notices, adverts, forms and reader
  comments.  Such branches go whatever their importance, as much of them differs from page to page.
  ``has-``, ``no-``, ``with-`` or ``without-`` before a word takes it back, and a header inside an
  ``article`` or ``main`` is judged by its importance.
* The main elements of a page are its outermost ``article`` and ``main`` elements outside such branches
  (if there are none: in them).  Words never remove a branch that holds one.
* On a page without, words decide where at least ``FREE`` of the text is important and outside such
  branches.  Elsewhere they are a prior of ``BOILERPLATE`` that a branch is main text, and its importance changes the
  odds; a branch with most of the page's text goes only if nothing in it is important.
* Importance never removes a main element or what holds it, nor the place with most of the text in it.
  If importance would leave nothing of a page, it removes nothing in main elements and no branch with most of the text.

Scripts, styles, markup and what is never shown are dropped; character
references decoded; white space in a block becomes one space; blocks are joined
by line feeds in page order.

Counting is one aggregation with map-side combining (a host or a line with a
third of all rows is a few rows a task); the tree of a host comes back to its
pages by a join that Spark broadcasts while its file is small and shuffles (and
splits where skewed) beyond.

Defined cases: null or empty html gives empty text; null url is a host of its own;
broken markup is read as far as it goes (linear in the page), and the end of ``head`` and
of list items, cells and paragraphs may be missing; repeated ids are read each; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settled

LEAST, STYLE, EVIDENCE = 0.35, 0.2, 8
BOILERPLATE, FREE = 0.2, 0.15

# fixed values: element kinds
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe svg math head title textarea select option button object canvas audio video".split())
RAW_TEXT = frozenset("script style title textarea iframe noscript".split())
FOREIGN = frozenset("svg math iframe object canvas video audio".split())
ENDS = {tag: re.compile(rf"</{tag}[\s/>]", re.I) for tag in RAW_TEXT}
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var br img wbr".split())
IN_HEAD = frozenset("title meta link script style base noscript template head html".split())
BOILER_TAGS = frozenset("nav header footer aside form menu dialog fieldset".split())
ENDS_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
SELF_CLOSING = {"li": ("li", ("ul", "ol", "menu")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)), "tr": ("tr td th", ("table",)), "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table"))}
# fixed values: class and id words
BOILER_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar side-bar menu nav navbar navigation breadcrumb breadcrumbs footer header masthead topbar cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login search share sharing social comment comments respond replies disqus related recommended widget pagination pager copyright toolbar contentinfo complementary dialog".split()
)
TAKES_BACK = frozenset("has no with without".split())

TOKEN = re.compile(r"<!--|<!|<\?|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:=\s*+(?:\"[^\"]*\"|'[^']*')|[^><])*+)>?")
ATTR = re.compile(r"([^\s=/]++)(?:\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|(\S*)))?")  # one after the other, values whole
UNSEEN = re.compile(r"display\s*:\s*none", re.I)
WORD = re.compile(r"[a-z]+(?:-[a-z]+)*")


def _hash(*parts: str) -> int:
    return int.from_bytes(blake2b("\0".join(parts).encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


def _is_boilerplate(tag: str, words: list[str], inside: bool) -> bool:
    if tag in BOILER_TAGS and not (inside and tag == "header"):
        return True
    for word in words:
        before = ""
        for part in ((word,) if "-" not in word else (word, *word.split("-"))):
            if part in BOILER_WORDS and before not in TAKES_BACK and not (inside and part == "header"):
                return True
            before = part
    return False


class Page:
    """Nodes of a page in order of their start; node 0 is the body.  ``weight`` is 0 where nothing is shown, ``main``
    tells outermost article and main elements.  ``blocks``: (node, text) in page order."""

    __slots__ = ("key", "parent", "children", "weight", "inside", "main", "blocks")

    def __init__(self, html: str):
        self.key, self.parent, self.children, self.weight, self.inside, self.main = [_hash("body")], [-1], [[]], [1.0], [False], [False]
        self.blocks: list[tuple[int, str]] = []
        self._read(html)

    def _node(self, parent: int, tag: str, attrs: str) -> int:
        names: list[str] = []
        hidden = False
        if attrs:
            for m in ATTR.finditer(attrs):
                kind = m[1].lower()
                if kind == "hidden":
                    hidden = True
                elif kind == "style":
                    hidden = hidden or bool(UNSEEN.search(m[2] or m[3] or m[4] or ""))
                elif kind in ("class", "id", "role"):
                    names += entities.unescape(m[2] or m[3] or m[4] or "").lower().split()
        words = sorted({w for n in names for w in WORD.findall(n)})
        hidden = hidden or not self.weight[parent]
        boiler = _is_boilerplate(tag, words, self.inside[parent])
        self.key.append(_hash(str(self.key[parent]), tag, *words))
        self.parent.append(parent)
        self.children.append([])
        self.children[parent].append(tag)
        self.weight.append(0.0 if hidden else BOILERPLATE if boiler else 1.0)
        main = tag in ("article", "main")
        self.inside.append(main or self.inside[parent])
        self.main.append(main and not hidden and not self.inside[parent])
        return len(self.key) - 1

    def _read(self, html: str) -> None:
        stack: list[tuple[str, int]] = [("body", 0)]  # open elements; inline ones share their block's node
        count: dict[str, int] = {"body": 1}
        text: list[str] = []
        muted = 0  # open elements that are never shown
        endless: set[str] = set()  # raw elements without a further end tag

        def flush() -> None:
            if text:
                words = entities.unescape("".join(text)).split()
                text.clear()
                if words:
                    self.blocks.append((stack[-1][1], " ".join(words)))

        def pop() -> None:
            nonlocal muted
            tag, _ = stack[-1]
            if tag not in INLINE:
                flush()
            stack.pop()
            count[tag] -= 1
            if tag in RAW:
                muted -= 1

        def close(tag: str) -> None:
            while stack[-1][0] != tag:
                pop()
            pop()

        at, size = 0, len(html)
        while at < size:
            low = html.find("<", at)
            if low < 0:
                low = size
            if low > at:
                if stack[-1][0] == "head" and not html[at:low].isspace():
                    close("head")
                if not muted:
                    text.append(html[at:low])
            if low == size:
                break
            m = TOKEN.match(html, low)
            if m is None:
                if not muted:
                    text.append("<")
                at = low + 1
                continue
            if m[2] is None:  # comment or declaration
                end = html.find("-->", low + 4) if m[0] == "<!--" else html.find(">", low)
                at = size if end < 0 else end + (3 if m[0] == "<!--" else 1)
                continue
            at, tag = m.end(), m[2].lower()
            if m[1]:
                if count.get(tag) and tag != "body":
                    close(tag)
                elif tag == "br" and not muted:
                    text.append(" ")
                continue
            if tag not in IN_HEAD and count.get("head"):
                close("head")  # its end tag may be missing
            if tag in ("html", "body"):
                continue
            if tag in FOREIGN and m[3].endswith("/"):
                if not muted:
                    text.append(" ")
                continue
            if tag in RAW_TEXT:
                end = None if tag in endless else ENDS[tag].search(html, at)
                if end is None:
                    endless.add(tag)
                    if tag in ("script", "style", "title", "textarea"):
                        break
                    continue
                at = html.find(">", end.start())
                at = size if at < 0 else at + 1
                if not muted:
                    text.append(" ")
                continue
            if tag in VOID:
                if tag in INLINE:
                    if not muted:
                        text.append(" ")
                else:
                    flush()
                continue
            if tag in ENDS_P and count.get("p"):
                close("p")
            if tag in SELF_CLOSING:
                ends, scope = SELF_CLOSING[tag]
                ends = ends.split()
                if any(count.get(e) for e in ends):
                    i = len(stack) - 1
                    while i and stack[i][0] not in scope and stack[i][0] not in ends:
                        i -= 1
                    if stack[i][0] in ends:
                        while len(stack) > i:
                            pop()
            if tag in INLINE:
                stack.append((tag, stack[-1][1]))
            else:
                flush()
                if tag in RAW:
                    muted += 1
                stack.append((tag, self._node(stack[-1][1], tag, m[3])))
            count[tag] = count.get(tag, 0) + 1
        if not muted:
            flush()

    def style(self, node: int) -> int:
        seq: list[str] = []
        for t in self.children[node]:
            if not seq or seq[-1] != t:
                seq.append(t)
        return _hash(*seq)


def kept_blocks(page: Page, importance: dict[tuple[int, bool], tuple[float, bool]]) -> list[str]:
    """Blocks of the branches that stay; ``importance`` of (node key, is content), and if it rests on ``EVIDENCE``."""
    n = len(page.key)
    unknown = (1.0, False)
    # ``good``: an unknown place is important; ``odds``: it says nothing
    size, good, odds, best = [0.0] * n, [0.0] * n, [0.0] * n, [0.0] * n
    for node, text in page.blocks:
        value, sure = importance.get((page.key[node], True), unknown)
        size[node] += len(text)
        good[node] += len(text) * value
        odds[node] += len(text) * (value if sure else min(value, 0.5))
        best[node] = value
    for node in range(n - 1, 0, -1):  # children come after their parents
        above = page.parent[node]
        size[above] += size[node]
        good[above] += good[node]
        odds[above] += odds[node]
        best[above] = max(best[above], best[node])
    free, clean, free_good = [True] * n, False, 0.0
    for node in range(1, n):
        free[node] = free[page.parent[node]] and page.weight[node] == 1
        clean = clean or (page.main[node] and free[node] and size[node] > 0)
    for node, text in page.blocks:
        if free[node]:
            free_good += len(text) * importance.get((page.key[node], True), unknown)[0]
    holds = [m and s > 0 and (f or not clean) for m, s, f in zip(page.main, size, free, strict=True)]
    inside = holds[:]
    for node in range(1, n):
        inside[node] = inside[node] or inside[page.parent[node]]
    main = sum(s for h, s in zip(holds, size, strict=True) if h)
    words_decide = main or free_good >= FREE * size[0]
    place: dict[int, float] = {}
    for node in range(n - 1, 0, -1):
        holds[page.parent[node]] |= holds[node]
        place[page.key[node]] = place.get(page.key[node], 0.0) + size[node]

    def goes(node: int, careful: bool) -> bool:
        weight, most = page.weight[node], 2 * size[node] > size[0]
        if not weight:
            return True
        if holds[node]:
            return False
        style, sure = importance.get((page.key[node], False), unknown)
        if weight < 1:
            if words_decide:
                return True
            if not most:
                v = (1 - STYLE) * odds[node] / size[node] + STYLE * (style if sure else min(style, 0.5))
                return weight * v < LEAST * (weight * v + (1 - weight) * (1 - v))
        if inside[node]:
            if careful or 2 * place[page.key[node]] > main:
                return False
        elif most and not main:
            return not careful and best[node] < LEAST
        return (1 - STYLE) * good[node] / size[node] + STYLE * style < LEAST

    for careful in (False, True):
        gone = [False] * n
        for node in range(1, n):
            gone[node] = gone[page.parent[node]] or (size[node] > 0 and goes(node, careful))
        kept = [text for node, text in page.blocks if not gone[node]]
        if kept:
            break
    return kept


def host_of():
    return F.coalesce(F.lower(F.regexp_extract(F.col("url").cast("string"), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)", 1)), F.lit(""))


def _pages(pages: DataFrame) -> DataFrame:
    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), host_of().alias("host"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))


def style_trees(pages: DataFrame) -> DataFrame:
    """host, key, content (else presentation), m, importance, sure (it rests on ``EVIDENCE``): the merged nodes of every host."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for low in range(0, b.num_rows, 200):
                host, key, content, feature, copy, times = [], [], [], [], [], []
                part = b.slice(low, 200)
                for h, source in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    page = Page(source)
                    text = _hash(*[t for n, t in page.blocks if page.inside[n]])
                    own = Counter((page.key[n], False, page.style(n), text if page.inside[n] else None) for n in range(1, len(page.key)))
                    own.update((page.key[n], True, _hash(t), text if page.inside[n] else None) for n, t in page.blocks)
                    for (k, c, f, t), often in own.items():
                        host.append(h)
                        key.append(k)
                        content.append(c)
                        feature.append(f)
                        copy.append(t)
                        times.append(often)
                yield pa.RecordBatch.from_arrays([pa.array(host, pa.string()), pa.array(key, pa.int64()), pa.array(content, pa.bool_()), pa.array(feature, pa.int64()), pa.array(copy, pa.int64()), pa.array(times, pa.int64())], names=["host", "key", "content", "feature", "copy", "times"])

    seen = _pages(pages).select("host", "html").mapInArrow(run, "host string, key long, content boolean, feature long, copy long, times long")
    # inside an article or main, copies of its text count once
    once = F.when(F.col("copy").isNull(), F.sum("times")).otherwise(F.max("times"))
    counts = settled(seen.groupBy("host", "key", "content", "feature", "copy").agg(once.alias("times")), "style-counts")
    measure = [F.sum("c").alias("m"), F.sum(F.col("c") * F.log(F.col("c").cast("double"))).alias("clog")]
    value = F.when(F.col("m") > 1, F.greatest(F.lit(0.0), 1 - F.col("clog") / (F.col("m") * F.log(F.col("m").cast("double"))))).otherwise(1.0)
    here = counts.groupBy("host", "key", "content", "feature").agg(F.sum("times").alias("c"))
    own = here.groupBy("host", "key", "content").agg(*measure).withColumn("own", value)
    every = counts.groupBy("key", "content", "feature", "copy").agg(once.alias("times")).groupBy("key", "content", "feature").agg(F.sum("times").alias("c"))
    every = every.groupBy("key", "content").agg(*measure).select("key", "content", F.col("m").alias("m_everywhere"), value.alias("everywhere"))
    both = own.join(every, ["key", "content"])
    return both.select("host", "key", "content", "m", F.when(F.col("m") >= EVIDENCE, F.col("own")).otherwise(F.col("everywhere")).alias("importance"), (F.greatest("m", "m_everywhere") >= EVIDENCE).alias("sure"))


def main_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars."""
    # important places without evidence need no entry: that is what an unknown place counts as
    trees = style_trees(pages).where("sure or importance < 0.999")
    table = settled(trees.groupBy("host").agg(F.collect_list(F.struct("key", "content", "importance", "sure")).alias("tree")), "style-trees")
    rows = _pages(pages).join(table, "host", "left").select("page_id", "url", "html", "host", "tree")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, dict[tuple[int, bool], float]] = {}
        for b in batches:
            for low in range(0, b.num_rows, 200):
                part = b.slice(low, 200)
                texts = []
                for source, host, tree in zip(part.column(2).to_pylist(), part.column(3).to_pylist(), part.column(4), strict=True):
                    if host not in known:
                        if len(known) > 1000:
                            known.clear()
                        known[host] = {(e["key"], e["content"]): (e["importance"], e["sure"]) for e in tree.as_py() or ()}
                    texts.append("\n".join(kept_blocks(Page(source), known[host])))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
