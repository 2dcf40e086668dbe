"""Main text of web pages with site template removal (operator 10).

Pages are parsed into an element tree where they lie. Each element subtree that a template could have put there is
hashed, bottom up; Spark counts, for each host, the pages of different text that hold a subtree, and subtrees on many of
them are deleted from every page of that host. Counts can't tell boilerplate that differs from page to page (an advert
in turn, a menu of the section) or that of a host of few pages, so elements whose tag, role, class or id names
boilerplate go as well. What is left of the article (or the main element, or the body) is returned block by block.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnwright.llm.common import in_arrow
from turnwright.storage import cut

# Fixed values of HTML: elements by kind.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr br img picture ruby rt rp".split())
TEXT_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dt dd td th tr figcaption".split())
FRAME = frozenset("html head body main article".split())
#: A start tag on the left ends an open element on the right.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: Where the search for an element to end stops.
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}, "option": {"select"}}

# What boilerplate is called.
DROP_TAGS = frozenset("head nav aside footer form script style noscript iframe svg button select textarea template dialog menu object canvas title noembed noframes xmp math audio video map".split())
DROP_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form status".split())
DROP_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices notification popup modal overlay newsletter subscribe subscription signup login sidebar menu nav navbar navigation breadcrumb breadcrumbs footer header masthead topbar comment comments disqus reply replies respond share sharing social related recommended recommendations widget pagination pager toolbar alert legal copyright".split()
)

#: Share of a page's text above which a class or id doesn't make an element boilerplate.
MOST_TEXT = 0.6

TOKEN = re.compile(
    r"""<!--(?:.*?-->|.*\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""",
    re.S,
)
ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")


class Page:
    """The elements of a page in document order: tag, attributes, parent and extent; and its text pieces.

    A piece is (element, block, text). The block number changes wherever a block-level element starts or ends.
    """

    def __init__(self, source: str) -> None:
        self.source = source
        self.tag, self.attrs, self.parent, self.start, self.stop = ["#"], [""], [-1], [0], [len(source)]
        self.pieces: list[tuple[int, int, str]] = []
        self._parse()

    def _parse(self) -> None:
        source, stack, at, block, pieces = self.source, [0], 0, 0, self.pieces
        tags = self.tag

        def close(depth: int, where: int) -> None:
            while len(stack) > depth:
                self.stop[stack.pop()] = where

        pos = 0
        while m := TOKEN.search(source, pos):
            if m.start() > at:
                pieces.append((stack[-1], block, source[at : m.start()]))
            at = pos = m.end()
            name = m[2] or m[5]
            if not name:
                continue
            name = name.lower()
            if m[1] or m[4]:
                depth = next((d for d in range(len(stack) - 1, 0, -1) if tags[stack[d]] == name), 0)
                if depth:
                    close(depth + 1, m.start())
                    close(depth, m.end())
                if name not in INLINE:
                    block += 1
                continue
            if name == "br":
                pieces.append((stack[-1], block, " "))
                continue
            if name not in INLINE:
                block += 1
                if name not in VOID:
                    depth = next((d for d in range(len(stack) - 1, 0, -1) if tags[stack[d]] not in INLINE), 0)
                    if depth and tags[stack[depth]] in ("p", "h1", "h2", "h3", "h4", "h5", "h6") and (tags[stack[depth]] == "p" or name[0] == "h" and name[1:].isdigit()):
                        close(depth, m.start())
                    if name in ENDS:
                        for d in range(len(stack) - 1, 0, -1):
                            if tags[stack[d]] in ENDS[name]:
                                close(d, m.start())
                                if name != "tr":
                                    break
                            elif tags[stack[d]] in SCOPE[name] or tags[stack[d]] in FRAME:
                                break
            if name in VOID:
                continue
            self.tag.append(name)
            self.attrs.append(m[3] if m[2] else m[6])
            self.parent.append(stack[-1])
            self.start.append(m.start())
            self.stop.append(len(source))
            if name in RAW:
                end = re.compile(rf"</{name}\s*>", re.I).search(source, pos)
                at = pos = end.end() if end else len(source)
                self.stop[-1] = pos
                continue
            if (m[3] if m[2] else m[6]).endswith("/") and name == "svg":
                continue
            stack.append(len(tags) - 1)
        if at < len(source):
            pieces.append((stack[-1], block, source[at:]))

    def _named(self, i: int) -> bool:
        if not self.attrs[i]:
            return False
        for key, value in ATTRIBUTE.findall(self.attrs[i]):
            key, value = key.lower(), html.unescape(value.strip("\"'"))
            if key == "hidden" or key == "aria-hidden" and value.lower() == "true" or key == "style" and re.search(r"display\s*:\s*none", value):
                return True
            if key == "role" and value.lower() in DROP_ROLES:
                return True
            if key in ("class", "id"):
                if any(w.lower() in DROP_NAMES for word in value.split() for w in ({word} | {NAME.search(word)[0] if NAME.search(word) else ""} | set(NAME.findall(word)[-1:]))):
                    return True
        return False

    def analyse(self) -> None:
        """content: is it within the article; holds: does it hold one; dropped: boilerplate by name."""
        n = len(self.tag)
        article, main = [False] * n, [False] * n
        self.dropped, inside = [False] * n, [False] * n
        for i in range(1, n):
            p, tag = self.parent[i], self.tag[i]
            inside[i] = inside[p] or tag in ("article", "main")
            gone = tag in DROP_TAGS or tag == "header" and not inside[p]
            if not gone and tag not in ("html", "body", "main") and not (tag == "article" and not inside[p]):
                gone = self._named(i)
            self.dropped[i] = self.dropped[p] or gone
            article[i] = tag == "article"
            main[i] = tag == "main" or 'role="main"' in self.attrs[i]
        found = [i for i in range(n) if article[i] and not self.dropped[i]] or [i for i in range(n) if main[i] and not self.dropped[i]]
        self.rooted = bool(found)
        if not found and any(article) or any(main):  # a container's name says boilerplate, but the article is in it
            found = found or [i for i in range(n) if article[i]] or [i for i in range(n) if main[i]]
            self.rooted = True
        roots = set(found) if found else {0}
        if not found:  # without an article, what holds most of the page's text is no boilerplate, whatever it is called
            size = [0] * n
            for i, _, piece in self.pieces:
                size[i] += len(piece.strip())
            for i in range(n - 1, 0, -1):
                size[self.parent[i]] += size[i]
            for i in range(1, n):
                p, tag = self.parent[i], self.tag[i]
                named = tag not in ("html", "body") and size[i] <= MOST_TEXT * size[0] and self._named(i)
                self.dropped[i] = self.dropped[p] or tag in DROP_TAGS or tag == "header" or named
        self.content, self.holds = [False] * n, [False] * n
        for i in range(n):
            self.content[i] = i in roots or i > 0 and self.content[self.parent[i]]
        for i in found:
            while i >= 0:
                self.holds[i] = True
                i = self.parent[i]
        if found and all(self.dropped[i] for i in found):
            for i in range(1, n):
                p = self.parent[i]
                self.dropped[i] = not self.holds[i] and (self.dropped[p] and not self.holds[p] or self.tag[i] in DROP_TAGS or self._named(i))

    def plain(self, i: int, tags: frozenset[str] = TEXT_BLOCKS) -> bool:
        """Whether an element is a paragraph or other text block without any mark."""
        return self.tag[i] in tags and not self.attrs[i].strip()

    def template_parts(self) -> Iterator[tuple[int, bool]]:
        """(element, does it matter for the text) for every subtree that a template could have put there.

        Inside an article, paragraphs, headings and other plain text blocks are never taken for a template.
        """
        for i in range(1, len(self.tag)):
            tag = self.tag[i]
            if tag in FRAME or tag in INLINE or self.holds[i] or self.rooted and self.plain(i):
                continue
            yield i, self.content[i] and not self.dropped[i]

    def keys(self) -> list[int]:
        """A hash of each element's subtree: its own source, white space normalized, with its children's hashes in it.

        Worked out from the last element to the first, so each character is hashed once, however deep it lies.
        """
        n = len(self.tag)
        children: list[list[int]] = [[] for _ in range(n)]
        for i in range(1, n):
            children[self.parent[i]].append(i)
        out = [0] * n
        for i in range(n - 1, 0, -1):
            digest, at = hashlib.blake2b(digest_size=8), self.start[i]
            for c in children[i]:
                digest.update(" ".join(self.source[at : self.start[c]].split()).encode("utf-8", "surrogatepass"))
                digest.update(b"\0" + out[c].to_bytes(8, "little", signed=True))
                at = self.stop[c]
            digest.update(" ".join(self.source[at : self.stop[i]].split()).encode("utf-8", "surrogatepass"))
            out[i] = int.from_bytes(digest.digest(), "little", signed=True)
        return out

    def hits(self, templates: frozenset[int]) -> set[int]:
        """The elements that matter for the text and are templates."""
        if not templates:
            return set()
        keys = self.keys()
        return {i for i, matters in self.template_parts() if matters and keys[i] in templates}

    def text(self, hit: set[int] = frozenset()) -> str:
        """The blocks of the content without dropped elements and the elements hit, joined by blank lines."""
        gone = self.dropped
        if hit:
            gone = list(gone)
            for i in range(1, len(gone)):
                gone[i] = gone[i] or i in hit or gone[self.parent[i]]
        blocks: dict[int, list[str]] = {}
        for i, block, piece in self.pieces:
            if self.content[i] and not gone[i]:
                blocks.setdefault(block, []).append(piece)
        return "\n\n".join(t for parts in blocks.values() if (t := " ".join(html.unescape("".join(parts)).split())))


def host_of(url: F.Column) -> F.Column:
    """The host of a url in lower case, without user and port; empty for a null url or one without a host."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^\s*[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?(\[[^\]/?#]*\]|[^/?#:]*)", 1), F.lit("")))


def parse(source: str | None) -> Page:
    page = Page(source or "")
    page.analyse()
    return page


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


PARTS = "page_id long, host string, part long, content long, matters boolean, plain boolean"


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each distinct subtree of a page that could be a template part, from rows (page_id, host, html)."""
    kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_())
    for batch in batches:
        for lo in range(0, batch.num_rows, 100):
            part = batch.slice(lo, 100)
            rows: list[tuple] = []
            for page_id, host, source in zip(*(part.column(i).to_pylist() for i in range(3)), strict=True):
                page = parse(source)
                content, keys = _hash(page.text()), page.keys()
                seen: dict[int, tuple[bool, bool]] = {}
                for i, matters in page.template_parts():
                    k = keys[i]
                    seen[k] = (k in seen and seen[k][0] or matters, page.plain(i, TEXT_BLOCKS | {"tr"}))
                rows += [(page_id, host, k, content, matters, plain) for k, (matters, plain) in seen.items()]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], [f.split()[0] for f in PARTS.split(", ")])


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, 100):
            part = batch.slice(lo, 100)
            texts, removed = [], []
            for source, gone in zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True):
                page = parse(source)
                hit = page.hits(frozenset(gone or ()))
                texts.append(page.text(hit))
                removed.append(len(hit))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64()), pa.array(removed, pa.int64())], ["page_id", "url", "text", "n_chars", "n_templates"])


def site_templates(parts: DataFrame, least_pages: int, least_share: float, many_pages: int) -> DataFrame:
    """(host, part) of the subtrees that are template parts of their host, from rows of PARTS. Counts are partially
    aggregated, so a host of very many pages meets as narrow sums."""
    counts = parts.select("host", "part", "content", "plain").distinct().groupBy("host", "part").agg(F.count("*").alias("n"), F.bool_and("plain").alias("plain")).where(F.col("n") >= least_pages)
    hosts = parts.select("host", "content").distinct().groupBy("host").agg(F.count("*").alias("of"))
    return counts.join(hosts, "host").where((F.col("n") >= least_share * F.col("of")) | ~F.col("plain") & (F.col("n") >= many_pages)).select("host", "part")


def page_texts(pages: DataFrame, least_pages: int = 5, least_share: float = 0.2, many_pages: int = 50, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars, n_templates) for each row of pages; n_templates subtrees of the text were templates.

    A subtree is a template part of its host if it is on at least ``least_pages`` pages of different text and on
    ``least_share`` of the host's; copies of a page count once. For containers and marked elements ``many_pages`` are
    enough, whatever the share: a large host has sections and notices in turn. An unmarked text block, such as a table
    row, may well recur by itself, and needs the share. A host of fewer than ``least_pages`` has no templates. Within
    an article or main element only containers and marked elements can be template parts, as articles may share
    passages.

    Elements named as boilerplate by tag, role, class or id go whatever the counts. On a page without article and main
    element, a class or id says nothing of an element that holds more than MOST_TEXT of the page's text.

    A null or empty html has an empty text; a null or malformed url has the empty host. Rows with equal ids each have
    their own row, and templates of their own host alone. Other columns are ignored. A page of any length is one row
    in memory; each of its characters is hashed once.
    """
    url = F.col(url_col).cast("string")
    base = pages.select(F.col(id_col).cast("long").alias("page_id"), url.alias("url"), F.col(html_col).cast("string").alias("html"), host_of(url).alias("host"))
    parts = cut(in_arrow(base.select("page_id", "host", "html"), _parts, PARTS))
    templates = cut(site_templates(parts, least_pages, least_share, many_pages))
    gone = cut(parts.where("matters").join(templates, ["host", "part"]).groupBy("page_id", "host").agg(F.collect_set("part").alias("gone")))
    if gone.isEmpty():
        judged = base.select("page_id", "url", "html", F.lit(None).cast("array<bigint>").alias("gone"))
    else:
        near = gone.select(F.col("page_id").alias("_p"), F.col("host").alias("_h"), "gone")
        judged = base.join(near, base["page_id"].eqNullSafe(near["_p"]) & (base["host"] == near["_h"]), "left").select("page_id", "url", "html", "gone")
    return in_arrow(judged, _extract, "page_id long, url string, text string, n_chars long, n_templates long").withColumnsRenamed({"page_id": id_col, "url": url_col})
