"""HTML main text by consensus host paths.

1. Every page is read into a tree of elements; boilerplate (navigation, headers, footers, sidebars, notices,
   adverts, forms, reader comments, scripts, styles) is marked by tag, role or, at elements that hold blocks, class
   words. Inline elements, quotations and code are never marked by their class, nor is anything by a class that tells of a
   state (`has-sidebar`, `nav-open`). What a class word marks is judged once the page is read: it stays if it holds an
   article or most of the page's prose, and where the word has other meanings too (`discussion`) if neither
   links nor forms nor comments prevail in it. Each container is scored by the prose outside links that it
   holds, weighted by tag and class words. The page's best is its article (else main) element if that scores
   three quarters of the highest; else the deepest container that holds all prose of the page.
2. The page votes for its best container's path: tags with their classes from the root on, with digits
   generalised. Votes are summed per host and path in Spark, combined before the shuffle; the paths with SHARE of
   their host's votes win, however many those are.
3. Pages are read again: the text is that of the containers on the winning path of most votes that holds all
   prose of the page's own best, so that only link text and bare lines lie outside; else of the page's best container.

Blocks of the chosen containers come in page order, one a line: character references are decoded, white
space (a `<br>` too) becomes one space. Nothing else is dropped or cut. Reading takes time in proportion to the page:
a `<` that no `>` follows is text, a tag whose quotes don't close ends at its first `>`, and elements deeper than
MAX_DEPTH are read as if they weren't there, with their text kept. Null html is an empty page; a page without
text gives an empty text. The host is what op3's rule names so; null urls share one empty host. Null and repeated ids
and rows stay. An empty table gives an empty one. Only the named columns are read; others may have any name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loam.llm.shared import small, written
from loam.llm.urlfilter import host_of

#: A path wins with this share of its host's votes.
SHARE = 0.01
#: Open elements at most.
MAX_DEPTH = 512
#: Of text in a bare division, so many characters are prose.
PROSE = 40
#: Tags of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title template iframe svg select noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
SIBLINGS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table", "tbody", "thead", "tfoot"), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",), "tbody": ("table",), "thead": ("table",), "tfoot": ("table",)}
ALIKE = {"dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th"), "tbody": ("tbody", "thead", "tfoot"), "thead": ("tbody", "thead", "tfoot"), "tfoot": ("tbody", "thead", "tfoot")}
DROPPED_TAGS = frozenset("nav footer aside button dialog head object canvas audio video menu datalist".split()) | RAW
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
#: Tags that may hold an article.
HOLDERS = frozenset("html body main article section div center".split())
#: Tags whose class words may mark boilerplate; and those that hold no text of their own as a rule.
MARKED = frozenset("div section ul ol dl menu table details header footer center p fieldset form".split())
CONTROLS = frozenset("input select textarea button form".split())
BARE = frozenset("div section center".split())
#: Words in a class or id that mark boilerplate, and those that mark main text.
DROPPED_WORDS = frozenset("""nav navbar navigation menu submenu footer header masthead topbar toolbar sidebar aside rail ad ads adv advert adverts
advertisement advertising adsense banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices popup modal overlay newsletter
subscribe subscription signup login social share sharing related recommended recommendations breadcrumb breadcrumbs pagination pager comment
comments commentlist discussion disqus respond replies reply skip hidden copyright legal disclaimer widget paywall form""".split())
COMMENT_WORDS = frozenset("comment comments commentlist disqus".split())
#: Those of the words that often mean something else; and those that name parts of a page, so that its frame may bear them.
SOFT_WORDS = frozenset("discussion social respond replies reply".split())
FRAME_WORDS = frozenset("nav navbar navigation menu submenu footer header masthead topbar toolbar sidebar aside rail banner notice notices overlay modal skip hidden copyright legal disclaimer widget".split())
#: Words that make a class tell of a state.
STATE_WORDS = frozenset("has no with without open opened closed enabled disabled active inactive free visible collapsed expanded".split())
#: How sure a mark is, and the share of a page's prose beyond which what it marks stays.
SOFT, FRAME, SURE = 1, 2, 3
STAYS = {SOFT: 0.5, FRAME: 0.5, SURE: 0.9}
#: Those of the words that inside an article may name parts of it.
ARTICLE_WORDS = frozenset("header masthead banner notice notices legal disclaimer copyright skip form rail".split())
MAIN_WORDS = frozenset("article content entry main post story body text".split())
_NAME = re.compile(r"/?([a-zA-Z][^\s/>]*)")
_REST = re.compile(r"(?>[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>")
_ATTR = re.compile(r"""([^\s"'=<>/]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_WORD = re.compile(r"[a-z]+|[A-Z][a-z]*|[A-Z]+")
_RAW_END = {tag: re.compile(f"</{tag}", re.I) for tag in RAW}
_DIGITS = re.compile(r"\d+")


class Node:
    __slots__ = ("tag", "parent", "path", "dropped", "article", "weight", "prose", "size", "links", "holds", "mark", "out", "inline", "block", "math", "link")

    def __init__(self, tag: str, parent: Node | None, attrs: str):
        self.tag, self.parent, self.prose, self.size, self.links, self.weight, self.out = tag, parent, 0, 0, 0, 1.0, False
        #: of an article, of form controls, of reader comments
        self.holds = [tag in ("article", "main"), False, False]
        named = {k.lower(): a or b or c for k, a, b, c in _ATTR.findall(attrs)} if attrs and not attrs.isspace() else {}
        classes = unescape(named.get("class", "")).split()
        names = [{w.lower() for w in _WORD.findall(x)} for x in (*classes, named.get("id", ""))]
        words = {w for own in names if not own & STATE_WORDS for w in own}
        self.article = parent is not None and parent.article or tag in ("article", "main")
        self.math = tag == "math" or parent is not None and parent.math
        self.inline = tag in INLINE or self.math
        self.block = parent.block if self.inline and parent else self
        self.link = tag == "a" or parent is not None and parent.link
        if self.inline and parent:
            self.path = parent.path
        else:
            own = f"{tag}.{'.'.join(sorted({_DIGITS.sub('#', c) for c in classes}))}" if classes else tag
            self.path = path_id(parent.path if parent else 0, own)
        self.dropped = parent is not None and parent.dropped or self._boilerplate(tag, named)
        self.mark = 0 if self.dropped else self._marked(tag, words)
        if tag in ("html", "body"):
            self.weight = 0.8
        elif tag in ("article", "main") or named.get("role") in ("main", "article"):
            self.weight = 1.5
        elif words & MAIN_WORDS:
            self.weight = 1.25

    def _boilerplate(self, tag: str, named: dict) -> bool:
        if tag in ("html", "body"):
            return False
        if tag in DROPPED_TAGS or named.get("role", "").lower() in DROPPED_ROLES:
            return True
        if "hidden" in named or "none" in re.findall(r"display\s*:\s*(\w+)", named.get("style", "").lower()):
            return True
        return tag == "header" and not self.article

    def _marked(self, tag: str, words: set) -> int:
        if tag not in MARKED:
            return 0
        found = words & DROPPED_WORDS - (ARTICLE_WORDS if self.article else frozenset())
        if found <= {"header"} and words & MAIN_WORDS:
            found = frozenset()
        self.holds[2] = bool(found & COMMENT_WORDS)
        if tag == "form" or found - SOFT_WORDS - FRAME_WORDS:
            return SURE
        return FRAME if found - SOFT_WORDS else SOFT if found else 0

    @property
    def score(self) -> float:
        return self.prose * self.weight


def path_id(parent: int, own: str) -> int:
    """A path's name: a hash of its parent's name and the element's tag and classes."""
    return xxhash.xxh64_intdigest(f"{parent}>{own}", 0) - (1 << 63)


class Page:
    """A page's containers, with scores, and its blocks: (text, its container)."""

    def __init__(self, html: str):
        root = Node("html", None, "")
        self.nodes: list[Node] = [root]
        self.blocks: list[tuple[str, Node]] = []
        self._text: list[str] = []
        self._links = 0
        self._stack = [root]
        self._beyond: dict[str, int] = {}
        self._read(html)
        self._sum()

    def _flush(self) -> None:
        if self._text:
            text = " ".join("".join(self._text).split())
            if text:
                node, size = self._stack[-1].block, max(0, len(text) - self._links)
                self.blocks.append((text, node))
                node.size += size
                node.links += len(text) - size
                if 2 * size > len(text) and (size >= PROSE or node.tag not in BARE):
                    node.prose += size
            self._text, self._links = [], 0

    def _add(self, raw: str) -> None:
        top = self._stack[-1]
        if top.dropped:
            if not raw.isspace() and not top.inline:
                self._flush()
            return
        text = unescape(raw) if "&" in raw else raw
        self._text.append(text)
        if top.link:
            self._links += len(text)

    def _pop_to(self, k: int) -> None:
        if any(not n.inline for n in self._stack[k:]):
            self._flush()
        del self._stack[k:]

    def _open(self, tag: str, attrs: str) -> None:
        stack = self._stack
        if tag == "html":
            return
        if tag in CONTROLS:
            stack[-1].block.holds[1] = True
        if tag in CLOSES_P and stack[-1].block.tag == "p":
            self._pop_to(next(k for k in range(len(stack) - 1, 0, -1) if stack[k].tag == "p"))
        if tag in SIBLINGS:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in ALIKE.get(tag, (tag,)):
                    self._pop_to(k)
                    break
                if stack[k].tag in SIBLINGS[tag]:
                    break
        if tag == "br":
            self._add(" ")
        elif tag not in INLINE and tag != "math" and not stack[-1].math:
            self._flush()
        if tag in VOID:
            return
        if len(stack) >= MAX_DEPTH:
            self._beyond[tag] = self._beyond.get(tag, 0) + 1
            return
        node = Node(tag, stack[-1], attrs)
        stack.append(node)
        if not node.inline and not node.dropped:
            self.nodes.append(node)

    def _close(self, tag: str) -> None:
        stack = self._stack
        if tag == "br":
            self._add(" ")
        elif self._beyond.get(tag):
            self._beyond[tag] -= 1
            if tag not in INLINE:
                self._flush()
            return
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag == tag:
                self._pop_to(k)
                return
            if tag in INLINE and not stack[k].inline:
                return

    def _read(self, html: str) -> None:
        at, strict = 0, True
        while (start := html.find("<", at)) >= 0:
            found = _NAME.match(html, start + 1)
            if html.startswith("<!--", start):
                end = html.find("-->", start + 4)
                end = len(html) if end < 0 else end + 3
            elif found or html.startswith(("<!", "<?"), start):
                close = html.find(">", start)
                if close < 0:  # no tag ends any more
                    break
                end = close + 1
                if found and strict:
                    rest = _REST.match(html, found.end())
                    strict = rest is not None
                    end = rest.end() if rest else end
            else:
                self._add(html[at : start + 1])
                at = start + 1
                continue
            if start > at:
                self._add(html[at:start])
            at = end
            if not found:
                continue
            tag, attrs = found[1].lower(), html[found.end() : end - 1]
            if html[start + 1] == "/":
                self._close(tag)
                continue
            self._open(tag, attrs)
            if tag in RAW and not attrs.endswith("/"):
                ended = _RAW_END[tag].search(html, at)
                at = ended.start() if ended else len(html)
        if at < len(html):
            self._add(html[at:])
        self._pop_to(1)
        self._flush()

    def _sum(self) -> None:
        """Judge what is marked, then sum up sizes and prose of all that stays in a container."""
        own = [(n.size, n.prose) for n in self.nodes]
        self._add_up()
        most = self.nodes[0].prose
        for least in (SOFT, SURE):
            for n in self.nodes:  # containers come before those within them
                n.out = n.parent is not None and n.parent.block.out or n.mark >= least and self._goes(n, most)
            if not most or any(prose and not n.out for n, (_, prose) in zip(self.nodes, own, strict=True)):
                break  # else all prose is marked; then only what surely is boilerplate goes
        for n, (size, prose) in zip(self.nodes, own, strict=True):
            n.size, n.prose = (0, 0) if n.out else (size, prose)
        self._add_up()

    def _goes(self, n: Node, most: int) -> bool:
        article, controls, comments = n.holds
        if article or n.prose > STAYS[n.mark] * most:
            return False
        return n.mark > SOFT or controls or comments or n.links > n.size

    def _add_up(self) -> None:
        for node in reversed(self.nodes):
            if node.parent:
                up = node.parent.block
                up.size += node.size
                up.prose += node.prose
                up.links += node.links
                up.holds = [a or b for a, b in zip(up.holds, node.holds, strict=True)]

    def best(self) -> Node:
        holders = [n for n in self.nodes if n.tag in HOLDERS and not n.out]
        most = max(n.score for n in holders)
        for tag in ("article", "main"):
            own = [n for n in holders if n.tag == tag and n.score >= 0.75 * most]
            if own:
                return max(own, key=lambda n: n.score)  # the first, so the outermost, of equal ones
        root = self.nodes[0]
        whole = "prose" if root.prose else "size"
        return [n for n in holders if getattr(n, whole) == getattr(root, whole)][-1] if root.size else root

    def text(self, paths: list[int]) -> str:
        best = self.best()
        by_path: dict[int, list[Node]] = {}
        if paths:
            for n in self.nodes:
                if not n.out:
                    by_path.setdefault(n.path, []).append(n)
        # nodes of one path have equal depth, so none holds another
        found = next((by_path[p] for p in paths if p in by_path and sum(n.prose for n in by_path[p]) >= best.prose), [best])
        inside: dict[int, bool] = {id(n): True for n in found}
        for n in self.nodes:
            if id(n) not in inside:
                inside[id(n)] = not n.out and n.parent is not None and inside.get(id(n.parent.block), False)
        return "\n".join(text for text, node in self.blocks if inside.get(id(node)))


def page_path(html: str | None) -> int | None:
    """The path of the page's best container; null where the page has no text."""
    page = Page(html or "")
    return page.best().path if any(not node.out for _, node in page.blocks) else None


def page_votes(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, path, votes): how many pages of a host have their best container at the path, a hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            paths = [page_path(x.as_py()) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(paths, pa.int64())], ["host", "path"])

    rows = pages.select(host_of(F.col(url_col)).alias("host"), F.col(html_col).alias("html"))
    return rows.mapInArrow(run, "host string, path long").filter("path is not null").groupBy("host", "path").agg(F.count("*").alias("votes"))


def winning_paths(votes: DataFrame, share: float = SHARE) -> DataFrame:
    """(host, paths): each host's paths with the share of its votes, 1 / share at most, best first."""
    host = Window.partitionBy("host")
    best = votes.withColumn("all", F.sum("votes").over(host)).filter(F.col("votes") >= share * F.col("all"))
    order = F.sort_array(F.collect_list(F.struct((-F.col("votes")).alias("less"), "path")))
    return best.groupBy("host").agg(F.transform(order, lambda x: x["path"]).alias("paths"))


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text): the main text of each page."""
    won = written(winning_paths(page_votes(pages, url_col, html_col)), "host-paths")
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), host_of(F.col(url_col)).alias("host"), F.col(html_col).alias("html"))
    rows = rows.join(won, "host", "left").select("page_id", "url", "html", "paths")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            texts = [Page(html.as_py() or "").text(paths or []) for html, paths in zip(batch.column(2), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    return rows.mapInArrow(run, f"page_id {pages.schema[id_col].dataType.simpleString()}, url string, text string")
