"""Oversized bodies cut into pieces at natural places, with overlap.

Method. Dynamic programming over boundary positions, in two steps. The first goes over the
lines that are shaped like a heading and finds those with which a section begins, at least
penalty for sections without text and for shapes left out; lines whose title comes again
later are cheap to leave out, so a table of contents falls away. The second goes over
section headings, line ends, sentence ends and gaps between words, possible cuts of rising
penalty, and finds the cuts of least total penalty plus size imbalance, subject to the
maximum length of a piece and the stated overlap. A body is oversized if that takes a cut.

Sizes count non-blank characters without tags. A piece repeats the last ``overlap`` such
characters of the one before, all of it if it is shorter; the repeated part counts towards
the limit.

Defined results: null content and a null or non-positive limit give nothing; an overlap
that is null or negative is 0, one of the limit or more is the limit less one character; a
body that fits is one piece; a stretch without any natural place is cut between characters;
bodies are read whole; a repeated body counts once. A line that is cut keeps its inline
tags: those open at a cut are closed before it and opened again after it.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import deque
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioloom.llm import charforms

_TAG = re.compile(r"<[^<>]*>")
_BLANK = re.compile(r"\s+")
# The forms of section headings, Chinese and English.
_NUMERAL = "一二三四五六七八九十百千零〇两0-9０-９"
_ZH_HEADING = re.compile(
    rf"第[{_NUMERAL}]+[回章节節篇卷集部](?:\s|[：:、·]|$)|第[{_NUMERAL}]+[回章节節篇卷集部][^。！？，；]*$"
    rf"|卷[{_NUMERAL}上中下]+(?:\s|[：:、]|$)|[上中下][篇卷部](?:\s|$)"
    r"|(?:自?序言?|前言|楔子|引子|引言|缘起|后记|後記|跋|尾声|尾聲|附录|附錄|凡例|题记)$"
    rf"|[一二三四五六七八九十百]+、|[0-9０-９]{{1,3}}[.、．]|【[^】]+】$"
)
_EN_HEADING = re.compile(
    r"(?:chapter|part|letter|book|section|canto|act|scene|volume|stave)\s+(?:\d+|[ivxlc]+|one|two|three|four|five|six|seven|eight|nine|ten|eleven|twelve)\b"
    r"|[ivxlc]+\.?$|\d{1,3}\.?$|\d{1,3}[.)]\s"
    r"|(?:preface|prologue|introduction|epilogue|to the reader|foreword|afterword|conclusion|appendix|dedication|finale)$",
    re.I,
)
_CONTENTS = re.compile(r"(?:目\s*录|目\s*錄|(?:table of )?contents)\s*[:：]?$", re.I)
_STOP = re.compile(r"[。！？.!?，,；;：:…][”’\"'』」）)]*\s*$|[”\"』」]\s*$")
_SENTENCE_END = re.compile(r"[。！？!?…]+[”’』」\"]*|\.[”’\"]*(?=\s)")
_SOFT_END = re.compile(r"[，,；;：:、]|\s")
_HEADING_TAG = re.compile(r"\s*<h[1-6]\b", re.I)
_BOLD_LINE = re.compile(r"\s*<(?:p|div)\b[^<>]*>\s*<(?:b|strong)\b[^<>]*>[^<>]*</(?:b|strong)>\s*</(?:p|div)>\s*$", re.I)

#: Penalties of a section without text, of a heading's shape left out, and of one whose title comes again later.
EMPTY_SECTION, LEFT_OUT, LEFT_OUT_AGAIN = 2.0, 3.0, 1.0
#: Penalties of a cut before a heading, between lines, after a sentence, at a gap, and anywhere.
PENALTY = {"heading": 0.0, "line": 1.0, "sentence": 3.0, "gap": 8.0, "forced": 20.0}
#: Weight of a piece's squared deviation from the even size.
BALANCE = 4.0


class Piece(NamedTuple):
    piece_no: int
    title: str | None
    html: str
    char_count: int
    overlap: int


def visible(line: str) -> str:
    """A line without tags, entities as characters."""
    return charforms.unescape(_TAG.sub("", line))


def size_of(text: str) -> int:
    """Non-blank characters without tags."""
    return len(_BLANK.sub("", visible(text)))


def heading_shapes(lines: list[str], plain: list[str]) -> list[int]:
    """Numbers (from 0) of the lines that are shaped like a heading; links to places of the same text are none."""
    found = []
    for i, (line, words) in enumerate(zip(lines, plain)):
        if not words or _CONTENTS.match(words):
            continue
        low = line.lower()
        if "<li" in low or 'href="#' in low or "href='#" in low:
            continue
        if _HEADING_TAG.match(line) or (not _STOP.search(words) and (_BOLD_LINE.match(line) or _ZH_HEADING.match(words) or _EN_HEADING.match(words))):
            found.append(i)
    return found


def section_starts(shapes: list[int], plain: list[str], prose: list[bool]) -> list[int]:
    """The shaped lines with which a section begins, at least total penalty.

    ``prose`` tells which lines hold text that is no shape. Between two lines of prose the
    order of states is linear: either a start is waiting for text or none is.
    """
    again: set[int] = set()
    seen: set[str] = set()
    for i in reversed(shapes):
        if plain[i] in seen:
            again.add(i)
        seen.add(plain[i])
    # state: whether a chosen start has no text yet -> (cost, chosen lines as a chain)
    free: tuple[float, tuple | None] = (0.0, None)
    waiting: tuple[float, tuple | None] = (float("inf"), None)
    last = 0
    for i in shapes:
        if any(prose[last:i]):
            free, waiting = min(free, waiting, key=lambda s: s[0]), (float("inf"), None)
        fee = LEFT_OUT_AGAIN if i in again else LEFT_OUT
        take = min((free[0], free[1]), (waiting[0] + EMPTY_SECTION, waiting[1]), key=lambda s: s[0])
        free, waiting = (free[0] + fee, free[1]), min((take[0], (i, take[1])), (waiting[0] + fee, waiting[1]), key=lambda s: s[0])
        last = i
    chain = min((free, waiting), key=lambda s: s[0])[1]
    out = []
    while chain:
        out.append(chain[0])
        chain = chain[1]
    return out[::-1]


def heading_lines(text: str) -> list[int]:
    """Numbers (from 0) of the lines that are headings with which a section begins."""
    lines = text.split("\n")
    plain = [charforms.fold(visible(line)).strip() for line in lines]
    shapes = heading_shapes(lines, plain)
    shaped = set(shapes)
    prose = [bool(words) and i not in shaped and not _CONTENTS.match(words) and "<li" not in line.lower() for i, (line, words) in enumerate(zip(lines, plain))]
    return section_starts(shapes, plain, prose)


def cut_positions(text: str, headings: set[int], reach: int) -> list[tuple[int, float]]:
    """(position, penalty) of the possible cuts, positions counting non-blank characters.

    Gaps between words fill in where other places are more than a quarter of the reach
    apart, which takes a line that long, and cuts between characters where there is no
    other place within the reach.
    """
    best: dict[int, float] = {}
    gaps: list[int] = []

    def ends(pattern: re.Pattern, words: str, at: int) -> Iterator[int]:
        last = 0
        for m in pattern.finditer(words):
            at += len(_BLANK.sub("", words[last : m.end()]))
            last = m.end()
            yield at

    at = 0
    for i, line in enumerate(text.split("\n")):
        fee = PENALTY["heading"] if i in headings else PENALTY["line"]
        best[at] = min(fee, best.get(at, fee))
        words = visible(line)
        for place in ends(_SENTENCE_END, words, at):
            best.setdefault(place, PENALTY["sentence"])
        if len(words) * 4 > reach:
            gaps += ends(_SOFT_END, words, at)
        at += len(_BLANK.sub("", words))
    best.pop(0, None)
    best.pop(at, None)
    _fill(best, at, max(1, reach // 4), sorted(set(gaps)), PENALTY["gap"])
    _fill(best, at, reach, None, PENALTY["forced"])
    return sorted(best.items())


def _fill(best: dict[int, float], total: int, reach: int, places: list[int] | None, fee: float) -> None:
    """Adds cuts where neighbours are more than ``reach`` apart: at the given places, or at every ``reach``."""
    marks = [0, *sorted(best), total]
    for low, high in zip(marks, marks[1:]):
        if high - low > reach:
            inner = range(low + reach, high, reach) if places is None else places[bisect_left(places, low + 1) : bisect_left(places, high)]
            for place in inner:
                best.setdefault(place, fee)


def best_cuts(total: int, cuts: list[tuple[int, float]], limit: int, overlap: int) -> list[int]:
    """The chosen cut positions by dynamic programming.

    For each place the places before it are tried from the one that makes an even piece
    outwards, until the imbalance alone costs more than what is found, beside the least cost
    in reach (kept in a sliding window).
    """
    if total <= limit:
        return []
    reach = limit - overlap
    pieces = 1 + max(1, -(-(total - limit) // reach))
    even = total / pieces
    scale = BALANCE / (even * even)
    places = [0, *[p for p, _ in cuts], total]
    fee = [0.0, *[f for _, f in cuts], 0.0]
    never = float("inf")
    cost, back = [0.0] + [never] * (len(places) - 1), [0] * len(places)
    low, least = 1, deque()  # places in reach after the first, those of rising cost
    for j in range(1, len(places)):
        at = places[j]
        if j > 1:
            while least and cost[least[-1]] >= cost[j - 1]:
                least.pop()
            least.append(j - 1)
        while at - places[low] > reach and low < j:
            low += 1
        while least and least[0] < low:
            least.popleft()
        best, way = never, 0
        if at <= limit:  # the first piece repeats nothing
            best = scale * (at - even) ** 2
        if least:
            floor = cost[least[0]]
            ideal = bisect_left(places, at - even, low, j)
            for side in (range(ideal, j), range(ideal - 1, low - 1, -1)):
                for i in side:
                    off = scale * (at - places[i] - even) ** 2
                    if floor + off >= best:
                        break
                    if cost[i] + off < best:
                        best, way = cost[i] + off, i
        cost[j], back[j] = best + fee[j], way
    chosen, j = [], back[-1]
    while j > 0:
        chosen.append(places[j])
        j = back[j]
    return chosen[::-1]


_UNIT = re.compile(r"&(?:#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);?|.", re.S)
_NAME = re.compile(r"</?\s*([A-Za-z][A-Za-z0-9]*)")
# Elements without an end tag.
_VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"))


def _cut_line(line: str, start: int, begin: int, end: int) -> str:
    """The part of a line between two positions; tags open at its ends are opened and closed again."""
    out: list[str] = []
    opened: list[tuple[str, str]] = []
    at, begun = start, False
    for k, piece in enumerate(_TAG_PIECES.split(line)):
        if k % 2:
            name = _NAME.match(piece)
            if name and name[1].lower() not in _VOID and not piece.endswith("/>"):
                if piece.startswith("</"):
                    if not any(n == name[1].lower() for n, _ in opened):
                        continue
                    while opened and opened[-1][0] != name[1].lower():
                        opened.pop()
                    opened.pop()
                else:
                    opened.append((name[1].lower(), piece))
            if begun and at < end:
                out.append(piece)
            elif begun and piece.startswith("</"):
                out.append(piece)
            continue
        for unit in _UNIT.findall(piece):
            size = len(_BLANK.sub("", charforms.unescape(unit) if unit[0] == "&" else unit))
            if size and begin <= at < end and not begun:
                begun = True
                out += [tag for _, tag in opened]
            if begun and at + size <= end and (size or at < end):
                out.append(unit)
            at += size
        if begun and at >= end:
            break
    if begun:
        out += [f"</{n}>" for n, _ in reversed(opened)]
    return "".join(out).strip()


_TAG_PIECES = re.compile(r"(<[^<>]*>)")


def _part(lines: list[str], starts: list[int], begin: int, end: int) -> str:
    """The markup of the visible characters from ``begin`` to ``end``."""
    out = []
    for line, start, after in zip(lines, starts, starts[1:]):
        if after <= begin and not (start == after == begin and begin) or start >= end:
            continue
        out.append(line if start >= begin and after <= end else _cut_line(line, start, begin, end))
    return "\n".join(out)


class Plan(NamedTuple):
    """Lines of a text, positions at which they start and the last one ends, section headings and chosen cuts."""

    lines: list[str]
    starts: list[int]
    headings: list[int]
    cuts: list[int]
    overlap: int


def plan_text(text: str, limit: int, overlap: int | None = 0) -> Plan:
    """The boundaries and cuts of a text."""
    overlap = min(max(0, overlap or 0), limit - 1)
    lines = text.split("\n")
    starts = [0]
    for line in lines:
        starts.append(starts[-1] + len(_BLANK.sub("", visible(line))))
    heads = heading_lines(text)
    cuts = best_cuts(starts[-1], cut_positions(text, set(heads), limit - overlap), limit, overlap) if starts[-1] > limit else []
    return Plan(lines, starts, heads, cuts, overlap)


def split_text(text: str, limit: int, overlap: int | None = 0) -> list[Piece]:
    """The ordered pieces of a text."""
    lines, starts, heads, cuts, overlap = plan_text(text, limit, overlap)
    titles = [(starts[i], visible(lines[i]).strip()) for i in heads]
    out = []
    for n, (begin, end) in enumerate(zip([0, *cuts], [*cuts, starts[-1]])):
        own = min(overlap, out[-1].char_count) if n else 0
        title = next((t for p, t in reversed(titles) if p <= begin), None)
        html = _part(lines, starts, begin - own, end) if cuts else text
        out.append(Piece(n + 1, title, html, end - begin + own, own))
    return out


def _bodies(bodies: DataFrame) -> DataFrame:
    chosen = bodies.select(F.col("body_id").cast("long").alias("body_id"), F.col("html_content").cast("string").alias("text"), F.col("size_limit").cast("int").alias("size_limit"), F.col("overlap").cast("int").alias("overlap"))
    return chosen.where("text is not null and size_limit > 0 and body_id is not null")


def oversized_headings(bodies: DataFrame) -> DataFrame:
    """(body_id, line_no): 0 for each body that takes a cut, and the numbers from 1 of its section headings."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, text, limit, overlap in zip(batch["body_id"], batch["text"], batch["size_limit"], batch["overlap"]):
                plan = plan_text(text, int(limit), None if pd.isna(overlap) else int(overlap))
                if plan.cuts:
                    rows += [(key, 0), *((key, i + 1) for i in plan.headings)]
            yield pd.DataFrame(rows, columns=["body_id", "line_no"]).astype({"body_id": "int64", "line_no": "int32"})

    return _bodies(bodies).mapInPandas(run, "body_id long, line_no int").distinct()


def split_bodies(bodies: DataFrame) -> DataFrame:
    """(body_id, piece_no, title, html, char_count, overlap) of every body, once per body."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, text, limit, overlap in zip(batch["body_id"], batch["text"], batch["size_limit"], batch["overlap"]):
                rows += [(key, *p) for p in split_text(text, int(limit), None if pd.isna(overlap) else int(overlap))]
            yield pd.DataFrame(rows, columns=["body_id", *Piece._fields]).astype({"body_id": "int64"})

    schema = "body_id long, piece_no int, title string, html string, char_count int, overlap int"
    return _bodies(bodies).dropDuplicates(["body_id"]).mapInPandas(run, schema)
