"""Column functions over plain text and HTML; all but ``clean_dom`` stay in the JVM.

White space and word boundaries follow the ECMAScript definitions, spelled out as
character classes, because Java's and RE2's shorthands differ.
Null input gives null unless a docstring says otherwise.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce
from html.parser import HTMLParser
from operator import or_
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: ECMAScript white space as a class body valid in Java and RE2.
WS = r"\s\x0B\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}"
#: ASCII word boundaries, before and after a word.
B0, B1 = r"(?<![A-Za-z0-9_])", r"(?![A-Za-z0-9_])"


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` applied to a value that is evaluated once, however often ``use`` names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def trim_ws(text: Column) -> Column:
    """Trim of all white space."""
    return F.regexp_replace(text, rf"^[{WS}]+|[{WS}]+\z", "")


def squeeze(text: Column) -> Column:
    """Runs of white space to one space, trimmed."""
    return F.trim(F.regexp_replace(text, rf"[{WS}]+", " "))


def round_half_up(value: Column) -> Column:
    """floor(x + 0.5), the rounding of the stored scores."""
    return F.floor(value + F.lit(0.5))


def one_decimal(n: Column, unit: int) -> Column:
    """``n / unit`` with one decimal, rounded by the exact value of the double, exact ties up.

    Only where the decimal value is a tie does the double's own error decide; it is told
    from the high and low half of the quotient, whose products are exact.
    """
    x = n / F.lit(float(unit))
    high = x.cast("float").cast("double")
    error = (high * unit - n) + (x - high) * unit
    tenth = unit // 10
    below = (n % tenth == tenth // 2) & (error < 0)
    k = F.floor((n + tenth // 2) / tenth) - F.when(below, 1).otherwise(0)
    return F.concat(F.floor(k / 10).cast("string"), F.lit("."), (k % 10).cast("string"))


def short_number(n: Column) -> Column:
    """Counts as 12.3K and 4.5M from a thousand and a million on."""
    return F.when(n >= 1000000, F.concat(one_decimal(n, 1000000), F.lit("M"))).when(n >= 1000, F.concat(one_decimal(n, 1000), F.lit("K"))).otherwise(n.cast("string"))


def drop_active_tags(html: Column) -> Column:
    """HTML without style and script elements."""
    return F.regexp_replace(F.regexp_replace(html, r"(?is)<style[^>]*>.*?</style>", ""), r"(?is)<script[^>]*>.*?</script>", "")


def strip_html(html: Column) -> Column:
    """Text of HTML: active elements gone, tags to blanks, white space squeezed."""
    return squeeze(F.regexp_replace(drop_active_tags(html), r"<[^>]+>", " "))


def strip_html_entities(html: Column, numeric: bool = False) -> Column:
    """``strip_html`` that also blanks named (and numeric) entities."""
    bare = F.regexp_replace(F.regexp_replace(drop_active_tags(html), r"<[^>]+>", " "), r"(?i)&[a-z]+;", " ")
    return squeeze(F.regexp_replace(bare, r"&#\d+;", " ") if numeric else bare)


def strip_tags_raw(html: Column) -> Column:
    """Tags to blanks without squeezing."""
    return F.regexp_replace(drop_active_tags(html), r"<[^>]+>", " ")


def strip_tags_decode(html: Column) -> Column:
    """Tags away, the six common entities decoded in order, trimmed."""
    text = F.regexp_replace(html, r"<[^>]+>", "")
    for entity, sign in (("&nbsp;", " "), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'")):
        text = F.replace(text, F.lit(entity), F.lit(sign))
    return trim_ws(text)


def count_words(text: Column) -> Column:
    """Runs of non-blank characters."""
    return bound(squeeze(text), lambda s: F.when(s == "", F.lit(0)).otherwise(F.length(s) - F.length(F.replace(s, F.lit(" "), F.lit(""))) + 1).cast("long"))


def count_cjk(text: Column) -> Column:
    """Ideographs of the two basic blocks."""
    return F.regexp_count(text, F.lit(r"[\x{4e00}-\x{9fff}\x{3400}-\x{4dbf}]")).cast("long")


def count_nonspace(text: Column) -> Column:
    """Characters that are not white space."""
    return F.length(F.regexp_replace(text, rf"[{WS}]", "")).cast("long")


def strip_markers(html: Column) -> Column:
    """Without ``[Illustration…]``, ``[Footnote: …]``, ``[p. 4]`` and ``{12}``."""
    patterns = (r"(?i)\[Illustration(?::\s*[^\]]*?)?\]", r"(?i)\[Footnote:\s*[^\]]*?\]", r"(?i)\[pg?\.\s*\d+\]", r"\{\d+\}")
    return reduce(lambda text, p: F.regexp_replace(text, p, ""), patterns, html)


def unlink_endnotes(html: Column) -> Column:
    """Links to notes replaced by their text."""
    return F.regexp_replace(html, r"""(?is)<a\b[^>]*href=["'][^"']*(?:endnote|footnote|#fn|#note|#ref)[^"']*["'][^>]*>(.*?)</a>""", "$1")


def section_breaks(html: Column) -> Column:
    """Paragraphs of asterisks to rules."""
    return F.regexp_replace(html, r"(?im)^<p[^>]*>\s*(?:\*\s*){2,}\s*</p>$", "<hr/>")


def wrap_section(html: Column) -> Column:
    """HTML inside one chapter section unless it starts with one."""
    return bound(html, lambda h: F.when(trim_ws(h).startswith("<section"), h).otherwise(F.concat(F.lit('<section data-epub-type="chapter">\n'), h, F.lit("\n</section>"))))


def shift_headings(html: Column) -> Column:
    """All headings one level down, at most 6, if a level 1 occurs."""

    def shifted(h: Column) -> Column:
        return reduce(lambda text, level: F.regexp_replace(text, rf"(?i)<(/?)h{level}(\b[^>]*>)", f"<$1h{level + 1}$2"), (5, 4, 3, 2, 1), h)

    return bound(html, lambda h: F.when(h.rlike(r"(?i)<h1\b"), shifted(h)).otherwise(h))


def captions(html: Column) -> Column:
    """Texts of ``[Illustration: …]`` in order."""
    return F.transform(F.regexp_extract_all(html, F.lit(r"(?i)\[Illustration:\s*([^\]]*?)\]"), F.lit(1)), lambda c: trim_ws(c))


def escape_attribute(text: Column) -> Column:
    """Text safe inside a double-quoted attribute."""
    for sign, entity in (("&", "&amp;"), ('"', "&quot;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(sign), F.lit(entity))
    return text


def image_filename(href: Column) -> Column:
    """Base name with unsafe characters replaced by ``_``."""
    return F.regexp_replace(F.element_at(F.split(href, "/"), -1), r"[^a-zA-Z0-9.\-_]", "_")


class Publisher(NamedTuple):
    """Who distributes the texts: the name, the site and the persons that its notices mention."""

    name: str
    site: str
    persons: tuple[str, ...] = ()


# Phrases that mark distribution notices in public-domain texts; NAME and SITE stand for the publisher's.
NOTICE_PHRASES = (
    r"The NAME E[Bb]ook",
    r"NAME License",
    r"www\.SITE",
    r"SITE/license",
    r"This eBook is for the use of anyone anywhere",
    r"SMALL PRINT!",
    r"START OF (?:THIS |THE )?NAME",
    r"END OF (?:THIS |THE )?NAME",
    r"End of NAME's",
    r"\*\*\* START OF",
    r"\*\*\* END OF",
    r"Most people start at our Web site",
    r"PLEASE READ THIS BEFORE YOU DISTRIBUTE",
    r"Updated editions will replace the previous one",
    r"You may copy it, give it away or re-use it",
    r"Creating the works from print editions",
    r"The Foundation's principal office is in",
    r"The NAME Literary Archive Foundation",
    r"Volunteers and financial support",
    r"This etext was prepared by",
    r"Produced by [^<]{0,200}(?:NAME|Online Distributed|Distributed Proofreading|Internet Archive|PGDP|pgdp\.net)",
    r"Release Date:",
    r"Character set encoding:",
    r"A free ebook from NAME",
    r"This file should be named",
    r"If you received this eBook on a physical medium",
    r"Transcribed from the",
    r"Section \d+\.\s+General Information About NAME",
)
# What a notice says of a person of the publisher; PERSON stands for the name.
PERSON_PHRASES = (
    r"Professor PERSON was the originator",
    r"Produced by [^<]{0,200}PERSON",
    r"by PERSON",
)
_BLOCKS = "p|div|span|pre|h[1-6]|li|blockquote|section"


def notice_phrases(publisher: Publisher) -> list[str]:
    """The patterns of the notices of one publisher."""
    named = [p.replace("NAME", re.escape(publisher.name).replace(r"\ ", " ")).replace("SITE", re.escape(publisher.site)) for p in NOTICE_PHRASES]
    return named + [p.replace("PERSON", re.escape(who)) for who in publisher.persons for p in PERSON_PHRASES]


def _fragments(phrases: list[str]) -> list[str]:
    """For each pattern a literal part in lower case that every text it matches holds."""
    split = re.compile(r"\\.|\[[^\]]*\]|\(\?:[^)]*\)|\{[^}]*\}|[.*+?()|^$]")
    return [max(split.split(p.replace(r"\ ", " ")), key=len).lower() for p in phrases]


def clean_notices(html: Column, publisher: Publisher) -> Column:
    """Without distribution notices: marked containers, START/END blocks, blocks with a notice phrase, links.

    Guards, first by literal parts of the phrases, keep the long chain away from texts that hold none.
    """
    text, name, phrases = html, re.escape(publisher.name), notice_phrases(publisher)
    # Containers and blocks that hold nothing but notices.
    for pattern in (
        r"""(?is)<section[^>]*(?:class="[^"]*pg-boilerplate[^"]*"|id="pg-(?:header|footer)")[^>]*>.*?</section>""",
        r"""(?is)<div[^>]*id="pg-(?:machine-header|start-separator|end-separator)"[^>]*>.*?</div>""",
        r"""(?is)<(p|div)\b[^>]*class="[^"]*\btoc\b[^"]*"[^>]*>.*?</\1>""",
        r"(?is)<nav\b[^>]*>.*?</nav>",
        rf"(?is)\*\*\*\s*START OF (?:THIS |THE )?{name}.*?\*\*\*",
        rf"(?is)\*\*\*\s*END OF (?:THIS |THE )?{name}.*\z",
    ):
        text = F.regexp_replace(text, pattern, "")

    def without_phrases(h: Column) -> Column:
        chained = reduce(lambda t, p: F.regexp_replace(t, rf"(?is)<({_BLOCKS})\b[^>]*>.*?(?:{p}).*?</\1>", ""), phrases, h)
        held = bound(F.lower(h), lambda low: reduce(or_, [F.contains(low, F.lit(f)) for f in _fragments(phrases)]))
        return F.when(held & h.rlike("(?i)" + "|".join(phrases)), chained).otherwise(h)

    text = bound(text, without_phrases)
    text = F.regexp_replace(text, rf"""(?is)<a[^>]*href="[^"]*{re.escape(publisher.site)}[^"]*"[^>]*>.*?</a>""", "")
    return trim_ws(F.regexp_replace(text, r"\n\s*\n\s*\n", "\n\n"))


def clean_chapter(html: Column, publisher: Publisher) -> Column:
    """Active elements, notices, inline markers and note links removed, in this order."""
    return trim_ws(unlink_endnotes(strip_markers(clean_notices(drop_active_tags(html), publisher))))


# Signs of wrong decoding.
MOJIBAKE = r"Ã[¤¶¼©¨ ]|â€|Â |\x{FFFD}|[\x{80}-\x{9F}]|Ã[\x{80}-\x{BF}]|Â[^" + WS + "]"
# Signs that a distribution notice is left; NAME and SITE stand for the publisher's.
RESIDUE = ("NAME", "SITE", r"\*\*\* START OF", r"\*\*\* END OF", "This eBook is for the use of anyone", "SMALL PRINT!")


def residue_pattern(publisher: Publisher) -> str:
    """The pattern of the notices left of one publisher."""
    return "(?i)" + "|".join(p.replace("NAME", re.escape(publisher.name).replace(r"\ ", " ")).replace("SITE", re.escape(publisher.site)) for p in RESIDUE)


def has_mojibake(text: Column) -> Column:
    """Whether a text shows wrongly decoded characters."""
    return text.rlike(MOJIBAKE)


def has_residue(html: Column, publisher: Publisher) -> Column:
    """Whether distribution notices are left."""
    return html.rlike(residue_pattern(publisher))


def long_words(text: Column) -> Column:
    """The words of a text with more than two characters."""
    return F.filter(F.split(text, rf"[{WS}]+"), lambda w: F.length(w) > 2)


def foreign_words(words: Column) -> Column:
    """Those of the words that hold a non-ASCII character other than typographic signs."""
    return F.filter(words, lambda w: F.regexp_replace(w, r"[\x{2018}\x{2019}\x{201C}\x{201D}\x{2014}\x{2013}\x{2026}\x{A0}\x{200A}\x{2060}]", "").rlike(r"[^\x00-\x7F]"))


def non_english_ratio(text: Column) -> Column:
    """Share of the long words that are foreign ones; 0 without words."""
    words = long_words(text)
    return F.when(F.size(words) > 0, F.size(foreign_words(words)) / F.size(words)).otherwise(F.lit(0.0))


def needs_punctuation(text: Column) -> Column:
    """Whether a text of 100 characters or more has less than 2 % punctuation."""
    marks = F.regexp_count(text, F.lit(r"""[，。！？、；：""''（）《》【】…—·.,!?;:"'()]"""))
    return F.when(F.length(text) < 100, F.lit(False)).otherwise(marks / F.length(text) < 0.02)


def chunks(text: Column, size: int = 2000) -> Column:
    """Consecutive pieces of ``size`` characters; empty text gives one empty piece."""
    return F.transform(F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1)), F.lit(size)), lambda at: F.substring(text, at, F.lit(size)))


# Dynasties and the look of a cover for each.
COVER_STYLES = (
    ("先秦", "ancient Chinese bronze and jade aesthetic, archaic oracle bone motifs"),
    ("两汉", "Han dynasty lacquerware style, flowing silk painting aesthetic"),
    ("魏晋南北朝", "ethereal landscape, bamboo forest, scholar-recluse atmosphere"),
    ("唐", "Tang dynasty golden age, vibrant colors, peony and crane motifs"),
    ("宋", "Song dynasty refined ink wash painting, misty mountains, minimalist elegance"),
    ("元", "Yuan dynasty steppe meets Chinese garden, bold brushwork"),
    ("明", "Ming dynasty blue and white porcelain aesthetic, garden architecture"),
    ("清", "Qing dynasty elaborate detail, imperial garden, traditional painting"),
    ("民国", "Republican era art deco meets Chinese modernism, vintage book cover style"),
)
COVER_STYLE = "classical Chinese ink wash painting, elegant brushwork"
COVER_RULES = (
    "No text, no letters, no words, no title on the image.",
    "Portrait orientation, 1600x2400 pixels, high resolution.",
    "Rich color palette with harmonious tones, detailed and atmospheric composition.",
)


def cover_prompt(title: Column, author: Column, dynasty: Column, subjects: Column) -> Column:
    """The request for a cover picture; dynasty and subjects (an array) may be null or empty."""
    named = F.when(F.coalesce(dynasty, F.lit("")) != "", dynasty)
    style = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for pair in COVER_STYLES for x in pair]), named), F.lit(COVER_STYLE))
    opening = F.concat(F.lit('A book cover illustration for "'), F.coalesce(title, F.lit("")), F.lit('" by '), F.coalesce(author, F.lit("")), F.coalesce(F.concat(F.lit(", "), named, F.lit(" period")), F.lit("")), F.lit("."))
    themes = F.when(F.size(subjects) > 0, F.concat(F.lit("Thematic elements: "), F.array_join(subjects, ", "), F.lit(".")))
    return F.concat_ws(" ", opening, F.concat(F.lit("Style: "), style, F.lit(".")), *[F.lit(r) for r in COVER_RULES], themes)


def json_in_answer(answer: Column, schema: str) -> Column:
    """The object from the first opening to the last closing brace of an answer, by a schema; null if there is none that can be read."""
    return F.from_json(F.nullif(F.regexp_extract(answer, r"(?s)\{.*\}", 0), F.lit("")), schema)


def source_kind(source_type: Column) -> Column:
    """Kind of a source in the receiving catalogue."""
    return F.when(source_type == "haodoo", "HAODOO").when(source_type == "wenshuoge", "WENSHUOGE").otherwise("USER_UPLOAD")


def iso_time(ts: Column) -> Column:
    """A time in ISO form with milliseconds and ``Z``."""
    return F.date_format(ts.cast("timestamp_ntz"), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def between_markers(text: Column, publisher: Publisher) -> Column:
    """The text between the first START and END lines of three asterisks; from the beginning or to the end where one is missing."""
    line = rf"(?is)\*\*\*\s*{{0}} OF (?:THE |THIS )?(?:{re.escape(publisher.name)} )?EBOOK.*?\*\*\*"
    after = F.element_at(F.split(text, line.format("START"), 2), -1)
    return F.element_at(F.split(after, line.format("END"), 2), 1)


def internal_key(path: Column) -> Column:
    """A storage key without ``../`` and leading slashes."""
    return F.regexp_replace(F.replace(path, F.lit("../"), F.lit("")), "^/+", "")


class _Kept(HTMLParser):
    """Writes HTML again without script, style and link elements."""

    GONE = ("script", "style")

    def __init__(self) -> None:
        super().__init__(convert_charrefs=False)
        self.out: list[str] = []
        self.inside = 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in self.GONE:
            self.inside += 1
        elif tag != "link" and not self.inside:
            self.out.append(self.get_starttag_text())

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        if tag not in (*self.GONE, "link") and not self.inside:
            self.out.append(self.get_starttag_text())

    def handle_endtag(self, tag: str) -> None:
        if tag in self.GONE:
            self.inside = max(0, self.inside - 1)
        elif tag != "link" and not self.inside:
            self.out.append(f"</{tag}>")

    def handle_data(self, data: str) -> None:
        if not self.inside:
            self.out.append(data)

    def handle_entityref(self, name: str) -> None:
        self.handle_data(f"&{name};")

    def handle_charref(self, name: str) -> None:
        self.handle_data(f"&#{name};")

    def handle_comment(self, data: str) -> None:
        self.handle_data(f"<!--{data}-->")


def rewrite_dom(html: str) -> str:
    """One text parsed and written again without script, style and link elements."""
    parser = _Kept()
    parser.feed(html)
    parser.close()
    return "".join(parser.out)


def clean_dom(html: Column) -> Column:
    """``rewrite_dom`` as a Column function (Arrow batches). Null stays null."""

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(rewrite_dom, na_action="ignore")

    return run(html)
