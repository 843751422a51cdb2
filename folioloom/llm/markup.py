"""Structure of texts that mix HTML, Markdown, wiki and LaTeX markup.

Method. ``body_lines`` finds the body of a text by the line-block distribution: markup is
stripped, the text lengths of the lines are summed over a sliding window of lines with
text, the body begins where the sum surges and ends where it dives. Blocks that survive as
structure (headings, list items, code, formulas) are taken from the lines between such
points by a grammar (``split_blocks``, ``structure``); ``clean_inline`` removes inline
markup from the prose left over. Sentences outside the body stay in ``clean_text``.

Defined results: null and empty texts have no blocks; unclosed markup is taken as plain
text; texts are read whole; nothing raises on malformed input.
"""

from __future__ import annotations

import html as _html
import re
from typing import NamedTuple

HEADING, LIST_ITEM, CODE, FORMULA = "heading", "list_item", "code", "formula"

_TAG = re.compile(r"</?[A-Za-z][^<>]*>|<!--.*?-->|<[!?][^<>]*>", re.S)
#: Elements whose content is no text of the document.
_HIDDEN = re.compile(r"<(script|style|nav|noscript|template)\b[^<>]*>.*?</\1\s*>", re.S | re.I)
_CODE = re.compile(
    r"<pre\b[^>]*>(?P<pre>.*?)</pre\s*>"
    r"|<(?P<tag>nowiki|source|syntaxhighlight|listing|xmp)\b[^>]*>(?P<wiki>.*?)</(?P=tag)\s*>"
    r"|\\begin\{(?P<env>lstlisting|verbatim|minted|alltt)\*?\}(?:\[[^\]\n]*\]|\{[^}\n]*\})?(?P<tex>.*?)\\end\{(?P=env)\*?\}"
    r"|^[ ]{0,3}(?P<fence>```+|~~~+)[^\n`]*\n(?P<md>.*?)\n?^[ ]{0,3}(?P=fence)[`~]*[ \t]*$",
    re.S | re.I | re.M,
)
_FORMULA = re.compile(
    r"<math\b[^>]*>(?P<math>.*?)</math\s*>"
    r"|\\begin\{(?P<env>equation|displaymath|math|align|gather|eqnarray|multline)\*?\}(?P<tex>.*?)\\end\{(?P=env)\*?\}"
    r"|\$\$(?P<dd>[^$]+?)\$\$"
    r"|\\\[(?P<br>.+?)\\\]"
    r"|\\\((?P<par>.+?)\\\)"
    r"|(?<![\\$\w])\$(?P<d>(?=[^$\n]*[\\^_=])[^\s$](?:[^$\n]*[^\s$])?)\$(?![\d$])",
    re.S | re.I,
)
_HTML_BLOCK = re.compile(r"<(?P<h>h[1-6])\b[^>]*>(?P<ht>.*?)</(?P=h)\s*>|<li\b[^>]*>(?P<li>.*?)(?=</li\b|<li\b|</?[uo]l\b|\Z)", re.S | re.I)
_TEX_HEADING = re.compile(r"\\(?:part|chapter|(?:sub){0,2}section|(?:sub)?paragraph)\*?(?:\[[^\]\n]*\])?\{((?:[^{}]|\{[^{}]*\})*)\}")
_MD_HEADING = re.compile(r"[ ]{0,3}(#{1,6})[ \t]+(.+?)[ \t]*#*[ \t]*$")
_WIKI_HEADING = re.compile(r"[ ]{0,3}(={1,6})[ \t]*([^=\n].*?)[ \t]*\1[ \t]*$")
_UNDERLINE = re.compile(r"[ ]{0,3}(?:={3,}|-{3,})[ \t]*$")
_ITEM = re.compile(r"[ \t]{0,8}(?:(?:[*+\-•][ \t]+)|(?:\d{1,3}[.)][ \t]+)|(?:[*#]{1,6}[ \t]*)|(?:\\item\b(?:\[[^\]\n]*\])?[ \t]*))(\S.*)$")
_EMPHASIS_START = re.compile(r"[ \t]*(\*{1,3})(?=\S)[^*\n]*?(?<=\S)\1(?!\*)")
_RULE = re.compile(r"[ \t]*(?:(?:[*\-_~=•·#+][ \t]*){3,}|[*\-_~=•·#+\s]*)$")
_STRUCTURE = re.compile(r"[ \t]*\\(?:begin|end)\{(?:itemize|enumerate|description|document|center|quote)\}(?:\[[^\]]*\])?[ \t]*$")

_LINKS = re.compile(r"!?\[([^\[\]\n]*)\]\([^()\s]*(?:[ \t]\"[^\"]*\")?\)")
_WIKI_LINK = re.compile(r"\[\[(?:[^\[\]|\n]*\|)?([^\[\]|\n]*)\]\]")
_TEX_INLINE = re.compile(r"\\(?:textbf|textit|emph|texttt|underline|textsc|textrm|textsf|mbox|footnote)\{([^{}]*)\}")
_TEX_GROUP = re.compile(r"\{\\(?:it|bf|em|tt|sc|rm|sf|sl|itshape|bfseries)\b[ \t]*([^{}]*)\}")
_WIKI_QUOTES = re.compile(r"'{5}(?=\S)(.+?)'{5}|'{3}(?=\S)(.+?)'{3}|'{2}(?=\S)(.+?)'{2}")
_STARS = re.compile(r"(?<![\w*])(\*{1,3})(?=[^\s*])([^*\n]*?[^\s*])\1(?![\w*])")
_BARS = re.compile(r"(?<![\w_])(_{1,3})(?=[^\s_])([^_\n]*?[^\s_])\1(?![\w_])")
_TICKS = re.compile(r"(`+)([^`\n]+)\1|~~(?=\S)([^~\n]+)~~")
_BREAK = re.compile(r"<(?:br|hr|/?p|/?div|/?td|/?tr)\b[^<>]*>", re.I)
_SPACE = re.compile(r"\s+")
_WIDE = re.compile("[\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uac00-\ud7af\uf900-\ufaff\U00020000-\U0003134f]")
#: Longest line, in characters, that is looked through for a letter or digit.
_SIGNS = 400
_SENTENCE = re.compile(r"""[.!?…,;:。！？，；：、][\"'”’»」』）)\]]*$|[.!?…][\"'”’»)\]]*\s|[。！？]""")


class Block(NamedTuple):
    """A block with its first line and how many more lines it has."""

    kind: str
    text: str
    line: int
    more: int = 0


def squeeze(text: str) -> str:
    """Each run of white space one space, trimmed."""
    return _SPACE.sub(" ", text).strip()


def decode(text: str) -> str:
    """Entities to characters; markup that was escaped twice comes out as markup."""
    for _ in range(2):
        if "&" not in text:
            break
        text = _html.unescape(text)
    return text


def clean_inline(text: str) -> str:
    """A piece of text without inline markup of any of the four kinds."""
    if "<" in text:
        text = _TAG.sub("", _BREAK.sub(" ", text))
    if "[" in text:
        text = _LINKS.sub(r"\1", text)
        text = _WIKI_LINK.sub(r"\1", text)
    if "\\" in text:
        text = _TEX_INLINE.sub(r"\1", text)
        if "{\\" in text:
            text = _TEX_GROUP.sub(r"\1", text)
    if "''" in text:
        text = _WIKI_QUOTES.sub(lambda m: m[1] or m[2] or m[3], text)
    if "*" in text:
        text = _STARS.sub(r"\2", text)
    if "_" in text:
        text = _BARS.sub(r"\2", text)
    if "`" in text or "~~" in text:
        text = _TICKS.sub(lambda m: m[2] or m[3], text)
    return text


def _hollow(match: re.Match) -> str:
    """What stays of an extracted region: its line feeds, so that lines keep their numbers."""
    return "\n" * match.group().count("\n")


def decode_lines(text: str) -> str:
    """``decode`` that keeps the number of lines."""
    plain = decode(text)
    if plain.count("\n") != text.count("\n"):
        plain = "\n".join(decode(line).replace("\n", " ") for line in text.split("\n"))
    return plain


def split_blocks(text: str) -> tuple[list[Block], list[str]]:
    """The structure blocks of a text, and its lines with every block taken out.

    The second list has as many entries as the text has lines.
    """
    return _split(decode_lines(text))


def _split(plain: str) -> tuple[list[Block], list[str]]:
    blocks: list[Block] = []

    def take(kind: str, body: str, at: int, more: int = 0) -> None:
        body = squeeze(body)
        if body:
            blocks.append(Block(kind, body, at, more))

    def place(m: re.Match) -> tuple[int, int]:
        return m.string.count("\n", 0, m.start()), m.group().count("\n")

    def code(m: re.Match) -> str:
        body = m["pre"] if m["pre"] is not None else m["wiki"] if m["wiki"] is not None else m["tex"] if m["tex"] is not None else m["md"]
        if m["pre"] is not None or m["wiki"] is not None:
            body = re.sub(r"</?(?:code|span|b|i|em|strong|tt|kbd)\b[^<>]*>", "", body, flags=re.I)
        take(CODE, body, *place(m))
        return _hollow(m)

    def formula(m: re.Match) -> str:
        body = next(m[k] for k in ("math", "tex", "dd", "br", "par", "d") if m[k] is not None)
        if m["math"] is not None:
            body = _TAG.sub("", body)
            inner = re.fullmatch(r"\s*(?:\$\$?|\\\(|\\\[)(.*?)(?:\$\$?|\\\)|\\\])\s*", body, re.S)
            body = inner[1] if inner else body
        take(FORMULA, body, *place(m))
        return _hollow(m)

    def html_block(m: re.Match) -> str:
        kind, body = (HEADING, m["ht"]) if m["h"] else (LIST_ITEM, m["li"])
        take(kind, clean_inline(body), *place(m))
        return _hollow(m)

    lower = plain.lower() if "<" in plain else ""
    if "```" in plain or "~~~" in plain or "\\begin" in plain or "<pre" in lower or "<nowiki" in lower or "<source" in lower or "<syntax" in lower or "<listing" in lower or "<xmp" in lower:
        plain = _CODE.sub(code, plain)
    if "$" in plain or "\\" in plain or "<math" in lower:
        plain = _FORMULA.sub(formula, plain)
    if "<h" in lower or "<li" in lower:
        plain = _HTML_BLOCK.sub(html_block, plain)
    lines = plain.split("\n")
    for i, line in enumerate(lines):
        first = line[:1]
        if not first or first == "<" or (first.isalpha() and not (i + 1 < len(lines) and lines[i + 1][:3] in ("===", "---"))):
            continue
        if _STRUCTURE.match(line):
            lines[i] = ""
            continue
        if _RULE.match(line):
            lines[i] = ""
            continue
        if i + 1 < len(lines) and lines[i + 1][:3] in ("===", "---") and _UNDERLINE.match(lines[i + 1]) and not _ITEM.match(line):
            take(HEADING, clean_inline(line), i)
            lines[i] = lines[i + 1] = ""
            continue
        if "=" == first and (m := _WIKI_HEADING.match(line)):
            take(HEADING, clean_inline(m[2]), i)
            lines[i] = ""
            continue
        if "\\" == first and (m := _TEX_HEADING.search(line)):
            take(HEADING, clean_inline(m[1]), i)
            lines[i] = line[: m.start()] + line[m.end() :]
            continue
        if "#" == first and (m := _MD_HEADING.match(line)) and (len(m[1]) > 1 or _titled(m[2]) and not _list_run(lines, i)):
            take(HEADING, clean_inline(m[2]), i)
            lines[i] = ""
            continue
        if _EMPHASIS_START.match(line) or line.startswith("**"):
            continue
        if (m := _ITEM.match(line)):
            take(LIST_ITEM, clean_inline(m[1]), i)
            lines[i] = ""
    blocks.sort(key=lambda b: b.line)
    return blocks, lines


def _titled(text: str) -> bool:
    """Whether a single-# line reads as a title: capitals on its first and last word."""
    words = [w for w in re.findall(r"[^\W\d_]+", text)]
    return bool(words) and words[0][0].isupper() and words[-1][0].isupper()


def _list_run(lines: list[str], i: int) -> bool:
    """Whether the line next to line ``i`` is a wiki list line of the same sign."""
    return any(0 <= j < len(lines) and re.match(r"#[^#\s]|# ?[a-z]", lines[j]) for j in (i - 1, i + 1))


def line_sizes(plain: str) -> list[int]:
    """Size of the text in each line: characters without tags and blanks, an ideograph as much as three letters.

    A line of signs without a letter or digit has no size.
    """
    if "<" in plain:
        plain = _TAG.sub(_hollow, plain)
    wide = not plain.isascii()
    sizes = []
    for line in plain.split("\n"):
        size = len(line) - line.count(" ")
        if size and size <= _SIGNS and not any(map(str.isalnum, line)):
            size = 0
        if wide and size and not line.isascii():
            size += 2 * len(_WIDE.findall(line))
        sizes.append(size)
    return sizes


def _usual(sizes: list[int]) -> int:
    """The line size at which half of the text lies in lines of that size or more."""
    left = sum(sizes)
    total = left
    for size in sorted(sizes, reverse=True):
        left -= size
        if 2 * left <= total:
            return size
    return 0


def body_lines(sizes: list[int], window: int = 3, surge: int = 80) -> list[bool]:
    """Which lines lie between a surge and a dive of the line-block distribution.

    The sizes of ``window`` consecutive lines with text are summed; a body begins at a line
    with text whose sum reaches ``surge``, or the usual line size of a text with shorter
    lines, and ends with the last line before ``window`` lines without text.
    """
    level = min(surge, _usual(sizes))
    keep = [False] * len(sizes)
    filled = [i for i, size in enumerate(sizes) if size]
    inside, last = False, -1
    for k, i in enumerate(filled):
        if inside and i - last > window:
            inside = False
        if not inside and sum(sizes[j] for j in filled[k : k + window] if j - i < 2 * window) >= level:
            inside = True
            last = i
        if inside:
            for j in range(last, i + 1):
                keep[j] = True
            last = i
    return keep


def sentence_like(line: str) -> bool:
    """Whether a line ends as a sentence or clause does, or holds the end of one."""
    return bool(_SENTENCE.search(line))


def structure(text: str, distribution: bool = True) -> tuple[list[Block], list[str], list[bool]]:
    """The structure blocks in the body of a text, its lines without blocks, and which lines are body.

    ``distribution=False`` takes the whole text for the body.
    """
    plain = decode_lines(text)
    if "<" in plain:
        plain = _HIDDEN.sub(_hollow, plain)
    blocks, rest = _split(plain)
    keep = body_lines(line_sizes(plain)) if distribution else [True] * len(rest)
    return [b for b in blocks if any(keep[b.line : b.line + 1 + b.more])], rest, keep


def clean_text(text: str | None) -> str | None:
    """The text without markup residue; headings, items, code and formulas keep a plain form.

    Headings come out as ``# title``, items as ``- item``, code between fences, formulas
    between ``$$``. Lines outside the body go unless they read as sentences. Null stays null.
    """
    if text is None:
        return None
    blocks, rest, keep = structure(text)
    out: list[str] = []
    at = 0
    forms = {HEADING: "# {}", LIST_ITEM: "- {}", CODE: "```\n{}\n```", FORMULA: "$$ {} $$"}
    for i, line in enumerate(rest):
        while at < len(blocks) and blocks[at].line <= i:
            out.append(forms[blocks[at].kind].format(blocks[at].text))
            at += 1
        line = squeeze(clean_inline(line)) if line else ""
        if line and (keep[i] or sentence_like(line)):
            out.append(line)
    return "\n".join(out)
