"""Main text of web pages, with each site's templates removed.

Every element subtree of a page gets a hash of its tag, classes, id, text and children. Spark counts, for each host, on how
many pages each subtree occurs, and subtrees that recur across many pages of their host are deleted: menus, notices, footers
and the like, whatever they are called. A few elements that HTML or their class names mark as something else than the article
(menus, forms, scripts, adverts, comments, ...) are left out as well, since a host of few pages shows no recurrence. Of what is
left, the text of the page's articles, else of its main element, else of the containers named as content, else all of it is
given as blocks.

What counts as many pages: pages whose articles are equal count once, so that copies of an article don't make its own
paragraphs a template. A subtree outside any article that isn't a paragraph, heading or the like is deleted from
``LEAST_PAGES`` pages on, if they are ``SHARE`` of the host's or ``MANY_PAGES``. Paragraphs and whatever stands within an
article may well be quoted by several pages; they go when more than half of the host's pages, and at least ``LEAST_QUOTED``,
have them.

Subtrees travel as 64-bit hashes; nothing of a host is gathered anywhere. Up to ``SENT_HASHES`` deleted hashes are sent to all
tasks; more of them are joined to the pages that hold them, with the same result.

Defined results: a null or empty html gives an empty text. A page without a host has no templates. Rows are pages each for
itself, whatever their ids; equal rows count once and each gives its row. An empty table gives no rows. Other columns,
whatever their names, aren't read. White space, as Python's ``str.split`` takes it, becomes one space within a block;
``<br>`` and the border of two table cells are white space. Elements left open end where their block does. A page is parsed
whole, by one task.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.llm.scratch import discard, materialise
from panelwright.llm.urls import host_of

LEAST_PAGES, SHARE, MANY_PAGES, LEAST_QUOTED = 3, 0.02, 10, 8
#: Deleted subtrees' hashes that are sent to every task, 8 bytes each.
SENT_HASHES = 500_000

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
_BLOCK = frozenset(
    "address article aside blockquote caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr legend li main menu nav ol optgroup option p pre search section summary table tbody tfoot thead tr ul".split()
)
_PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dt dd figcaption caption td th tr".split())
#: Elements without a node of their own.
_CLEAR = frozenset("html head body".split())
_NOT_TEXT = frozenset(
    "nav aside footer form script style noscript template iframe object embed svg canvas video audio button select datalist input textarea title "
    "dialog menu noembed noframes map progress meter".split()
)
#: Words of classes, ids and roles that name something else than the article.
_OTHER = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion menu nav navbar navigation topbar breadcrumb "
    "breadcrumbs sidebar aside complementary cookie cookies consent gdpr notice notification popup modal overlay newsletter subscribe subscription "
    "signup login footer contentinfo masthead share sharing social related recommended recommendations "
    "widget toolbar pagination pager search dialog alert skip".split()
)
_READERS = frozenset("comment comments disqus respond reply replies".split())
_CONTENT = frozenset("article post entry story content main".split())
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++))?""")
_TAG_REST = re.compile(r"""(?:[^>"']++|"[^"]*+"|'[^']*+'|["'])*+>""")
_NAME = re.compile(r"[a-zA-Z][^\s/>]*+")
_RAW_ENDS = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in _RAW}


def _tokens(html: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name or text, attributes): kind is "t" for text, "o" and "c" for opening and closing tags."""
    at, n, last = 0, len(html), html.rfind(">")
    while at < n:
        mark = html.find("<", at)
        if mark < 0 or mark > last and not html.startswith("<!--", mark):  # no tag can end any more
            yield "t", html[at:], ""
            return
        if mark > at:
            yield "t", html[at:mark], ""
        name = _NAME.match(html, mark + 1)
        if name:
            rest = _TAG_REST.match(html, name.end())
            if rest is None:
                yield "t", html[mark:], ""
                return
            tag = name.group().lower()
            yield "o", tag, html[name.end() : rest.end() - 1]
            at = rest.end()
            if tag in _RAW:
                end = _RAW_ENDS[tag].search(html, at)
                at = end.start() if end else n
            continue
        if html.startswith("<!--", mark):
            end = html.find("-->", mark + 2)
            at = end + 3 if end >= 0 else n
        elif html.startswith(("<!", "<?", "</"), mark):
            name = _NAME.match(html, mark + 2) if html[mark + 1] == "/" else None
            end = html.find(">", mark)
            if name:
                yield "c", name.group().lower(), ""
            at = end + 1
        else:
            yield "t", "<", ""
            at = mark + 1


class Page:
    """A page's elements in the order in which they open, with their subtrees' hashes, and its text in pieces."""

    def __init__(self, html: str, host: str):
        self.host = host.encode()
        self.tags, self.parents, self.hashes, self.named = [""], [-1], [0], [False]
        self.other = [0]  # 3: not of the article; 2: neither, unless a main or h1 stands in it; 1: unless an article does
        self.holds, self.within = [0], [False]  # 1: has an article in it, 2: a main or h1; stands in an article or main
        self.pieces: list[tuple[int, str | None]] = []  # (element, text); a None text is the border of a block
        parts: list[list[bytes]] = [[b""]]
        stack, opened = [0], {}
        self._stack, self._kinds, self._parts, self._opened = stack, [""], parts, opened
        for kind, name, attributes in _tokens(html):
            if kind == "t":
                text = unescape(name)
                self.pieces.append((stack[-1], text))
                if not text.isspace():
                    parts[-1].append(" ".join(text.split()).encode("utf-8", "replace"))
            elif name in _CLEAR:
                continue
            elif kind == "o":
                self._open(name, attributes)
            elif opened.get(name, 0):
                self._close(name)
        while len(stack) > 1:
            self._pop()
        self.hashes[0] = xxhash.xxh3_64_intdigest(b"\x00".join(parts[0]))

    def _open(self, tag: str, attributes: str) -> None:
        stack, tags = self._stack, self.tags
        if tag in _VOID:
            if tag == "br":
                self.pieces.append((stack[-1], " "))
            elif tag == "hr":
                self._end_of("p")
                self.pieces.append((stack[-1], None))
            return
        if tag in _BLOCK and self._opened.get("p"):
            self._end_of("p")
        if tag == "li":
            self._end_of("li")
        elif tag in ("dt", "dd"):
            self._end_of("dt"), self._end_of("dd")
        elif tag in ("td", "th", "tr"):
            self._end_of("td"), self._end_of("th")
            if tag == "tr":
                self._end_of("tr")
        parent = stack[-1]
        words, key = (), b""
        if attributes and not attributes.isspace():
            found = {}
            for name, value in _ATTRIBUTE.findall(attributes):
                name = name.lower()
                if name in ("class", "id", "role", "hidden", "aria-hidden", "style"):
                    found.setdefault(name, unescape(value.strip("\"'")))
            words = [w.lower() for name in ("class", "id", "role") if name in found for w in _WORDS.findall(found[name])]
            key = "\x01".join(f"{k}={v}" for k, v in sorted(found.items())).encode("utf-8", "replace")
        main = tag in ("article", "main") or "role" in (found if words else ()) and found["role"] == "main"
        unseen = bool(key) and ("hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "").lower())
        tags.append("main" if main and tag != "article" else tag), self.parents.append(parent), self.hashes.append(0)
        if tag in _NOT_TEXT and tag != "form" or tag == "header" and not self.within[parent]:
            self.other.append(3)
        elif not _READERS.isdisjoint(words):
            self.other.append(2)
        else:
            self.other.append(int(not main and (tag == "form" or unseen or not _OTHER.isdisjoint(words))))
        self.named.append(not _CONTENT.isdisjoint(words))
        self.holds.append(2 if tag == "h1" or main and tag != "article" else int(main)), self.within.append(main or self.within[parent])
        stack.append(len(tags) - 1), self._parts.append([tag.encode("utf-8", "replace"), key])
        self._opened[tag] = self._opened.get(tag, 0) + 1
        self._kinds.append(tag)
        if tag in _BLOCK:
            self.pieces.append((len(tags) - 1, None))
        elif tag in ("td", "th"):
            self.pieces.append((parent, " "))

    def _pop(self) -> None:
        node, parts, tag = self._stack.pop(), self._parts.pop(), self._kinds.pop()
        value = xxhash.xxh3_64_intdigest(b"\x00".join(parts))
        if len(parts) > 2:  # has text or children with text
            self.hashes[node] = value
            self._parts[-1].append(value.to_bytes(8, "little"))
        self.holds[self.parents[node]] = max(self.holds[self.parents[node]], self.holds[node])
        self._opened[tag] -= 1
        if tag in _BLOCK:
            self.pieces.append((self._stack[-1], None))

    def _end_of(self, tag: str) -> None:
        """Close an open element that the next one's start ends: the nearest of that tag, unless another block lies between."""
        if not self._opened.get(tag):
            return
        for depth in range(len(self._kinds) - 1, 0, -1):
            kind = self._kinds[depth]
            if kind == tag:
                while len(self._kinds) > depth:
                    self._pop()
                return
            if kind in _BLOCK and not (tag == "li" and kind in ("p", "div", "address")) or kind in ("table", "td", "th"):
                return

    def _close(self, tag: str) -> None:
        if tag not in _BLOCK and tag not in ("td", "th"):  # what isn't a block can't end one
            for depth in range(len(self._kinds) - 1, 0, -1):
                if self._kinds[depth] == tag:
                    break
                if self._kinds[depth] in _BLOCK:
                    return
        while self._kinds[-1] != tag:
            self._pop()
        self._pop()

    def key(self, node: int) -> int:
        """The hash of a subtree on this host, as a signed 64-bit number."""
        return xxhash.xxh3_64_intdigest(self.hashes[node].to_bytes(8, "little") + self.host) - (1 << 63)

    def subtrees(self) -> set[tuple[int, bool]]:
        """(hash, may be quoted) of each element with text that is a block."""
        return {(self.key(i), self.within[i] or t in _PROSE) for i, t in enumerate(self.tags) if i and self.hashes[i] and t in _BLOCK and t not in ("tbody", "thead", "tfoot")}

    def digest(self) -> int:
        """A hash of the page's articles; without any, of its three longest blocks."""
        own = sorted(h for t, h, p in zip(self.tags, self.hashes, self.parents, strict=True) if h and t in ("article", "main") and not self.within[p])
        if not own:
            blocks = sorted(set(self._blocks([True] * len(self.tags))), key=lambda b: (-len(b), b))[:3]
            own = [xxhash.xxh3_64_intdigest(b.encode("utf-8", "replace")) for b in blocks]
        return xxhash.xxh3_64_intdigest(b"".join(h.to_bytes(8, "little") for h in own)) - (1 << 63)

    def _blocks(self, keep: list[bool]) -> list[str]:
        out, current = [], []
        for node, text in [*self.pieces, (0, None)]:
            if text is None:
                if current and (block := " ".join("".join(current).split())):
                    out.append(block)
                current = []
            elif keep[node]:
                current.append(text)
        return out

    def text(self, deleted: set[int]) -> str:
        """The blocks that stay without the subtrees whose hashes are ``deleted``."""
        n = len(self.tags)
        keep = [True] * n
        for i in range(1, n):
            drop = self.other[i] > self.holds[i]
            keep[i] = keep[self.parents[i]] and not drop and not (deleted and self.hashes[i] and self.tags[i] in _BLOCK and self.key(i) in deleted)
        every = "\n".join(self._blocks(keep))
        for least, chosen in ((0.0, [t == "article" for t in self.tags]), (0.0, [t == "main" for t in self.tags]), (0.5, self.named)):
            inside = [False] * n  # containers that only their names mark must hold half of the text
            for i in range(1, n):
                inside[i] = keep[i] and (inside[self.parents[i]] or chosen[i])
            own = "\n".join(self._blocks(inside)) if any(inside) else ""
            if own and len(own) >= least * len(every):
                return own
        return every


_ELEMENTS = "page long, site long, article long, subtree long, quoted boolean"


def _elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        columns: tuple[list, ...] = ([], [], [], [], [])
        for page, host, html in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
            parsed = Page(html, host)
            article, site = parsed.digest(), xxhash.xxh3_64_intdigest(parsed.host) - (1 << 63)
            for subtree, quoted in parsed.subtrees():
                for to, x in zip(columns, (page, site, article, subtree, quoted), strict=True):
                    to.append(x)
        yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns[:4]), pa.array(columns[4], pa.bool_())], ["page", "site", "article", "subtree", "quoted"])


def recurring(elements: DataFrame) -> DataFrame:
    """subtree: the hashes that recur on many pages of their host."""
    once = elements.groupBy("site", "subtree", "article").agg(F.max("quoted").alias("quoted"))
    counted = once.groupBy("site", "subtree").agg(F.count(F.lit(1)).alias("pages"), F.max("quoted").alias("quoted")).where(F.col("pages") >= LEAST_PAGES)
    hosts = elements.groupBy("site", "article").agg(F.lit(1).alias("one")).groupBy("site").agg(F.count(F.lit(1)).alias("of"))
    frame = F.col("pages") >= F.least(F.lit(float(MANY_PAGES)), F.lit(SHARE) * F.col("of"))
    quoted = (F.col("pages") >= LEAST_QUOTED) & (2 * F.col("pages") > F.col("of"))
    return counted.join(hosts, "site").where(F.when(F.col("quoted"), quoted).otherwise(frame)).select("subtree")


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars (its code points) of every row."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    rows = rows.withColumn("host", host_of(F.col("url"))).withColumn("page", F.xxhash64("page_id", "url", "html"))
    elements = materialise(rows.where("host <> '' and html <> ''").select("page", "host", "html").mapInArrow(_elements, _ELEMENTS), "elements")
    deleted = materialise(recurring(elements), "recurring")
    few = deleted.count() <= SENT_HASHES
    if few:
        sent = np.sort(deleted.toArrow()["subtree"].to_numpy())
        rows = rows.withColumn("deleted", F.lit(None).cast("array<long>"))
    else:
        sent = np.zeros(0, np.int64)
        own = elements.join(deleted, "subtree").groupBy("page").agg(F.collect_set("subtree").alias("deleted"))
        rows = rows.join(own, "page", "left")

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        everywhere = set(sent.tolist())
        for b in batches:
            out = []
            for host, html, own in zip(*(b.column(i).to_pylist() for i in (2, 3, 4)), strict=True):
                out.append(Page(html, host).text((everywhere if few else set(own or ())) if host else set()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())], ["page_id", "url", "text", "n_chars"])

    out = rows.select("page_id", "url", "host", "html", "deleted").mapInArrow(extracted, "page_id long, url string, text string, n_chars long")
    if few:
        discard(elements, deleted)
    return out
