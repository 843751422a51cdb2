"""EPUB archives as DataFrames: metadata, spine items, contents entries and chapters.

``epub_files`` lists archives with the binary file source; ``archive_items`` and ``chapters``
open each one in a Python worker, where it is. A damaged archive gives one error row.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from posixpath import dirname, join, normpath
from urllib.parse import unquote
from xml.etree import ElementTree
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioloom.functions import text as X

_ITEMS = "archive string, kind string, position int, id string, href string, title string, media_type string, content binary"


def _local(tag: str) -> str:
    return tag.rsplit("}", 1)[-1]


def open_archive(content: bytes) -> list[tuple]:
    """Rows (kind, position, id, href, title, media_type, content) of one archive.

    Kinds: meta, spine, toc, image, cover. Raises on damaged archives.
    """
    rows: list[tuple] = []
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        names = set(z.namelist())
        root = next(e.get("full-path") for e in ElementTree.fromstring(z.read("META-INF/container.xml")).iter() if _local(e.tag) == "rootfile")
        opf, base = ElementTree.fromstring(z.read(root)), dirname(root)
        manifest, cover = {}, None
        for e in opf.iter():
            tag = _local(e.tag)
            if tag in ("title", "creator", "language", "subject", "description") and e.text:
                rows.append(("meta", len(rows), tag, None, e.text.strip(), None, None))
            elif tag == "meta" and e.get("name") == "cover":
                cover = e.get("content")
            elif tag == "item":
                manifest[e.get("id")] = (normpath(join(base, unquote(e.get("href") or ""))), e.get("media-type") or "", e.get("properties") or "")

        def data(path: str) -> bytes | None:
            return z.read(path) if path in names else None

        spine = [e.get("idref") for e in opf.iter() if _local(e.tag) == "itemref"]
        for n, key in enumerate(k for k in spine if k in manifest):
            rows.append(("spine", n, key, manifest[key][0], None, manifest[key][1], data(manifest[key][0]) or b""))
        for key, (href, kind, properties) in manifest.items():
            if kind.startswith("image/"):
                is_cover = key == cover or "cover-image" in properties
                rows.append(("cover" if is_cover else "image", 0, key, href, None, kind, data(href)))
            elif kind == "application/x-dtbncx+xml" and data(href):
                for n, point in enumerate(e for e in ElementTree.fromstring(data(href)).iter() if _local(e.tag) == "navPoint"):
                    label = next((e.text for e in point.iter() if _local(e.tag) == "text" and e.text), "")
                    source = next((e.get("src") for e in point if _local(e.tag) == "content"), None)
                    if source:
                        rows.append(("toc", n, point.get("id"), normpath(join(dirname(href), unquote(source))), label.strip(), None, None))
    return rows


_NAMES = [c.split()[0] for c in _ITEMS.split(", ")]
_BROKEN = (zipfile.BadZipFile, KeyError, StopIteration, ElementTree.ParseError, RuntimeError, ValueError, OSError, EOFError)


def epub_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, content) of all archives under ``path``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.epub").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content")


def archive_items(files: DataFrame) -> DataFrame:
    """All rows of the archives (path, content); a damaged one gives one row of kind ``error`` with the reason as title."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"]):
                try:
                    if content is None or content[:2] != b"PK":
                        raise zipfile.BadZipFile("no archive")
                    rows = [(name, *r) for r in open_archive(content)]
                except _BROKEN as problem:
                    rows = [(name, "error", 0, None, None, f"{type(problem).__name__}: {problem}", None, None)]
                yield pd.DataFrame(rows, columns=_NAMES)

    return files.select("path", "content").mapInPandas(run, _ITEMS)


def read_epubs(spark: SparkSession, path: str) -> DataFrame:
    """All rows of all archives under ``path``."""
    return archive_items(epub_files(spark, path))


def build_archive(meta: list[tuple[str, str]], pages: list[tuple[str, str | None]], toc: list[tuple[str, str]] = (), images: list[tuple[str, bytes]] = (), cover: bytes | None = None) -> bytes:
    """An EPUB archive: metadata (tag, text), pages (file, HTML; null for a missing file), contents (title, href) and images."""
    kinds = {"png": "image/png", "gif": "image/gif", "webp": "image/webp"}
    items = [f'<item id="p{n}" href="{escape(f)}" media-type="application/xhtml+xml"/>' for n, (f, _) in enumerate(pages)]
    items += [f'<item id="i{n}" href="{escape(f)}" media-type="{kinds.get(f.rsplit(".", 1)[-1], "image/jpeg")}"/>' for n, (f, _) in enumerate(images)]
    items += ['<item id="cover-image" href="cover.jpg" media-type="image/jpeg" properties="cover-image"/>'] if cover is not None else []
    head = "".join(f"<dc:{tag}>{escape(text)}</dc:{tag}>" for tag, text in meta)
    opf = (
        f'<package xmlns="http://www.idpf.org/2007/opf" xmlns:dc="http://purl.org/dc/elements/1.1/"><metadata>{head}</metadata><manifest>{"".join(items)}'
        f'<item id="ncx" href="toc.ncx" media-type="application/x-dtbncx+xml"/></manifest><spine toc="ncx">{"".join(f"<itemref idref={chr(34)}p{n}{chr(34)}/>" for n in range(len(pages)))}</spine></package>'
    )
    points = "".join(f'<navPoint id="n{n}"><navLabel><text>{escape(title)}</text></navLabel><content src="{escape(href)}"/></navPoint>' for n, (title, href) in enumerate(toc))
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("META-INF/container.xml", '<container><rootfiles><rootfile full-path="OEBPS/content.opf"/></rootfiles></container>')
        z.writestr("OEBPS/content.opf", opf)
        z.writestr("OEBPS/toc.ncx", f"<ncx><navMap>{points}</navMap></ncx>")
        for name, content in [(f, h.encode("utf-8", "replace")) for f, h in pages if h is not None] + list(images) + ([("cover.jpg", cover)] if cover is not None else []):
            z.writestr(f"OEBPS/{name}", content)
    return out.getvalue()


def metadata(items: DataFrame) -> DataFrame:
    """(archive, title, author, language, subjects, description) with the defaults for missing ones."""
    m = items.where("kind = 'meta'")
    one = lambda k, fall: F.coalesce(F.min_by(F.when(F.col("id") == k, F.col("title")), F.when(F.col("id") == k, F.col("position"))), F.lit(fall))
    subjects = F.transform(F.sort_array(F.collect_list(F.when(F.col("id") == "subject", F.struct("position", "title")))), lambda x: x["title"])
    return m.groupBy("archive").agg(
        one("title", "Unknown").alias("title"), one("creator", "Unknown").alias("author"), one("language", "en").alias("language"), subjects.alias("subjects"), one("description", "").alias("description")
    )


def anchor_slices(html: str, anchors: list[str]) -> list[str]:
    """The piece of a file from each anchor's tag to the next located anchor, in the anchors' order; '' if not found."""
    at = []
    for anchor in anchors:
        m = re.search(rf"""id=["']?{re.escape(anchor)}["']?""", html)
        at.append(html.rfind("<", 0, m.start()) if m else -1)
    marks = sorted({a for a in at if a >= 0}) + [len(html)]
    return ["" if a < 0 else html[a : next(x for x in marks if x > a)] for a in at]


def before_anchors(html: str, anchors: list[str]) -> str | None:
    """The piece of a file before the first located anchor; null if no anchor is found or none follows it."""
    at = [html.rfind("<", 0, m.start()) for a in anchors if (m := re.search(rf"""id=["']?{re.escape(a)}["']?""", html))]
    first = min((x for x in at if x >= 0), default=0)
    return html[:first] if first > 0 else None


# Words of titles that are no chapters, phrases of title pages, words of chapter titles, parts of file names.
SKIPPED = ("colophon", "imprint", "license", "copyright", "uncopyright", "endnotes", "cover", "titlepage", r"cover\s+image", r"book\s+cover", r"front\s+cover")
SKIPPED_FILES = ("cover", "titlepage")
NO_CONTINUATION = ("cover", "titlepage", "uncopyright", "colophon", "endnotes", "loi")
TITLE_PAGE = (
    r"\bBY THE AUTHOR OF\b",
    r"\bPRINTED FOR\b",
    r"\bCOPYRIGHT\s+(?:BY|\d{4})",
    r"\bALL RIGHTS RESERVED\b",
    r"\bFIRST (?:PUBLISHED|EDITION|PRINTED)\b",
    r"\bPUBLISHED\s+(?:IN|BY)\b",
)
NUMBERED = r"\b(?:chapter|book|part|canto|act|scene|prologue|epilogue|introduction|preface|foreword)\s+(?:\d+|[ivxlcdm]+)\b"
NARRATIVE = r"\b(?:chapter|book|part|prologue|epilogue|introduction|preface|foreword|appendix|act|scene|canto|volume|letter)\b"
# Sizes in characters and words.
LEAST_FILE, LEAST_PIECE, LEAST_ORPHAN = 100, 100, 50
FRAGMENT_WORDS, BEFORE_WORDS, ORPHAN_WORDS, LONE_ORPHAN_WORDS, SHORT_WORDS, EDGE = 30, 50, 5, 200, 300, 3

_SKIP_TITLE = r"(?i)(?<![A-Za-z0-9_])(?:" + "|".join(SKIPPED) + r")(?![A-Za-z0-9_])"
_HEADINGS = re.compile(r"<h([1-3])\b[^>]*>(.*?)</h\1>", re.S | re.I)
_CAPTION = re.compile("|".join(rf"""<{t}\b[^>]*class=["'][^"']*(?:caption|illustration)[^"']*["'][^>]*>.*?</{t}>""" for t in ("span", "div", "p", "figcaption", "small", "i", "em", "b")), re.S | re.I)
_TAG = re.compile(r"<[^>]+>")


def skippable(title: Column, href: Column) -> Column:
    """Whether a title or file name says that it is no chapter."""
    low = F.lower(F.coalesce(href, F.lit("")))
    return F.coalesce(title, F.lit("")).rlike(_SKIP_TITLE) | F.contains(low, F.lit(SKIPPED_FILES[0])) | F.contains(low, F.lit(SKIPPED_FILES[1]))


def front_matter(html: Column) -> Column:
    """Whether a text is a fragment of less than ``FRAGMENT_WORDS`` words or begins like a title page."""
    text = X.strip_html(html)
    return (X.count_words(text) < FRAGMENT_WORDS) | F.upper(F.left(text, F.lit(500))).rlike("|".join(TITLE_PAGE))


def heading_title(html: Column, publisher: X.Publisher) -> Column:
    """Text of the first heading of level 1 to 3 that is neither a sign nor a notice, captions left out; null if there is none."""
    bare = F.regexp_replace(html, "(?is)" + _CAPTION.pattern, "")
    found = F.transform(F.regexp_extract_all(bare, F.lit(r"(?is)<h[1-3]\b[^>]*>(.*?)</h[1-3]>"), F.lit(1)), lambda h: X.trim_ws(F.regexp_replace(F.regexp_replace(h, "<[^>]+>", ""), rf"[{X.WS}]+", " ")))
    notice = "(?i)ebook of|" + re.escape(publisher.name)
    return F.try_element_at(F.filter(found, lambda h: h.rlike("[A-Za-z0-9]{2,}") & ~h.rlike(notice)), F.lit(1))


def by_anchors(toc: list[tuple[str, str]]) -> bool:
    """Whether the contents name many places of few files."""
    files = {href.split("#")[0] for _, href in toc if href.split("#")[0]}
    return bool(files) and len(toc) > 1.5 * len(files)


class _Extraction:
    """The chapters of one archive: sections named by the contents, files that continue them, edges and repeats gone."""

    def __init__(self, spine: list[tuple[str, str, str]], toc: list[tuple[str, str]], publisher: X.Publisher) -> None:
        self.spine, self.toc = spine, toc
        self.notice = re.compile("ebook of|" + re.escape(publisher.name), re.I)
        self.found: list[list] = []  # [title, href, html]
        self.named: set[int] = set()
        self.last_of: dict[int, int] = {}

    @staticmethod
    def plain(html: str) -> str:
        text = re.sub(r"<(style|script)[^>]*>.*?</\1>", "", html, flags=re.S | re.I)
        return " ".join(_TAG.sub(" ", text).split())

    def heading(self, html: str) -> str | None:
        for m in _HEADINGS.finditer(_CAPTION.sub("", html)):
            text = " ".join(_TAG.sub("", m[2]).split())
            if re.search("[A-Za-z0-9]{2,}", text) and not self.notice.search(text):
                return text
        return None

    def place(self, href: str) -> int | None:
        """The spine file that a contents entry means: the same name, or one that ends with it."""
        base = href.split("#")[0]
        return next((n for n, (_, file, _) in enumerate(self.spine) if base and (file == base or file.endswith(base))), None)

    def add(self, title: str, href: str, html: str, at: int) -> None:
        """A section, unless its title, file, size or beginning says that it is no chapter."""
        if _skips(title, href) or len(html) < LEAST_PIECE:
            return
        title = self.heading(html) or title or f"Chapter {len(self.found) + 1}"
        text = self.plain(html)
        if _skips(title, href) or len(text.split()) < FRAGMENT_WORDS or any(re.search(p, text[:500].upper()) for p in TITLE_PAGE):
            return
        self.found.append([title, href, html])
        self.last_of[at] = len(self.found) - 1

    def sections_by_anchor(self) -> None:
        numbered = [e for e in self.toc if re.search(NUMBERED, e[0] or "", re.I)]
        used = numbered if len(numbered) >= 5 and len(numbered) < len(self.toc) / 2 else self.toc
        files: dict[str, list[tuple[str, str]]] = {}
        for title, href in used:
            base, _, anchor = href.partition("#")
            if base and anchor:
                files.setdefault(base, []).append((title, href))
        for base, entries in files.items():
            at = self.place(base)
            if at is None:
                continue
            self.named.add(at)
            html = self.spine[at][2]
            if len(html) < LEAST_FILE:
                continue
            anchors = [href.partition("#")[2] for _, href in entries]
            pieces = anchor_slices(html, anchors)
            before = before_anchors(html, anchors)
            if before and len(words := self.plain(before).split()) >= BEFORE_WORDS and not self._is_notice(" ".join(words)[:500]):
                if self.found:
                    self.found[-1][2] += "\n" + before
                elif pieces[0]:
                    pieces[0] = before + pieces[0]
            for (title, href), piece in zip(entries, pieces):
                self.add(title, href, piece, at)

    def _is_notice(self, text: str) -> bool:
        return bool(self.notice.search(text) or re.search(r"\*\*\* (?:START|END) OF", text))

    def sections_by_file(self) -> None:
        for n, (title, href) in enumerate(self.toc or [("", file) for _, file, _ in self.spine]):
            at = self.place(href)
            if at is None or _skips(title, href):
                continue
            self.named.add(at)
            self.add(title or f"Chapter {n + 1}", href, self.spine[at][2], at)

    def join_orphans(self) -> None:
        """Files that no entry names continue the chapter before them, or stand alone if they are long and come first."""
        current, own = -1, []
        for at, (key, href, html) in enumerate(self.spine):
            if at in self.named:
                current = self.last_of.get(at, current)
                continue
            low = href.lower()
            if any(x in low for x in NO_CONTINUATION) or key in ("pg-header", "pg-footer") or low.endswith(("-h-0.htm.html", "-h-0.htm.xhtml")):
                continue
            text = self.plain(html)
            words = len(text.split())
            if len(html) < LEAST_ORPHAN or words < ORPHAN_WORDS or self.notice.search(text[:300]):
                continue
            if current >= 0:
                self.found[current][2] += "\n" + html
            elif words >= LONE_ORPHAN_WORDS:
                own.append((at, href, html))
        for at, href, html in own:
            self.add("", href, html, at)

    def chapters(self) -> list[tuple[int, str, str, str, int]]:
        """(order_num, title, href, html, word_count)."""
        if by_anchors(self.toc):
            self.sections_by_anchor()
        else:
            self.sections_by_file()
        self.join_orphans()
        seen: set[str] = set()
        kept = []
        for title, href, html in self.found:
            text = self.plain(html)
            if text[:500] and text[:500] not in seen:
                seen.add(text[:500])
                kept.append((title, href, html, len(text.split())))
        low, high = 0, len(kept)
        if len(kept) > EDGE:
            can_go = [c[3] < SHORT_WORDS and not re.search(NARRATIVE, c[0], re.I) and not re.fullmatch("[IVXLCDM]+", c[0].strip(), re.I) for c in kept]
            while low < min(EDGE, len(kept) - 1) and can_go[low]:
                low += 1
            while high > max(len(kept) - EDGE, low + 1) and can_go[high - 1]:
                high -= 1
        return [(n, *c) for n, c in enumerate(kept[low:high], 1)]


def _skips(title: str, href: str) -> bool:
    return bool(title and re.search(_SKIP_TITLE, title)) or any(x in href.lower() for x in SKIPPED_FILES)


_CHAPTERS = "archive string, order_num int, title string, href string, html_content string, word_count int"


def chapters(files: DataFrame, publisher: X.Publisher) -> DataFrame:
    """(archive, order_num, title, href, html_content, word_count) of the chapters of archives (path, content).

    An archive is one value and is taken apart where it is, without a shuffle. Contents
    entries that share files are cut at their anchors; text before the first anchor and
    files that no entry names join the chapter before them; title pages, skipped titles and
    repeated texts go; short edge pieces without a chapter-like title are trimmed.
    Damaged archives give no chapters (``archive_items`` has their errors).
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for name, content in zip(batch["path"], batch["content"]):
                try:
                    items = open_archive(content) if content is not None else []
                except _BROKEN:
                    continue
                spine = [(key, href, (data or b"").decode("utf-8", "replace")) for kind, _, key, href, _, _, data in items if kind == "spine"]
                toc = [(title or "", href) for kind, _, _, href, title, _, _ in items if kind == "toc"]
                rows += [(name, *c) for c in _Extraction(spine, toc, publisher).chapters()]
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in _CHAPTERS.split(", ")])

    return files.select("path", "content").mapInPandas(run, _CHAPTERS)
