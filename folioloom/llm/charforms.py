"""Tables of characters that look alike, and the folding they define.

``fold`` maps a text to its table skeleton: look-alike letters to the Latin letter they
resemble, full-width and mathematical letters and digits to plain ones, ligatures to
their letters, compatibility and radical ideographs to the unified ideograph, blanks of
any kind to one space, ignorable characters to nothing, and decomposed accents to
composed ones. Accents, capitals, punctuation and line breaks stay.
"""

from __future__ import annotations

import html
import re
import sys
import unicodedata
from functools import lru_cache

# Letters of other scripts and the Latin letter each looks like.
CYRILLIC = dict(zip("АВЕЅІЈКМНОРСТУХԚԜаеорсухѕіјһԛԝ", "ABESIJKMHOPCTYXQWaeopcyxsijhqw"))
CYRILLIC["к"] = "k"
CYRILLIC["ӏ"] = "l"
CYRILLIC["Ү"] = "Y"
CYRILLIC["ԁ"] = "d"
GREEK = dict(zip("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧνορ", "ABEZHIKMNOPTYXvop"))
ARMENIAN = dict(zip("օսհ", "ouh"))
# Supplementary radicals without a decomposition and the ideograph each looks like.
RADICALS = dict(zip("⺟⻁⻄⻅⻆⻉⻋⻒⻓⻔⻗⻘⻙⻚⻛⻜⻝⻢⻣⻤⻥⻦⻧⻨⻩⻬⻮⻰⻳", "母虎西见角贝车镸长门雨青韦页风飞食马骨鬼鱼鸟卤麦黄齐齿龙龟"))
# Characters that a reader does not see.
IGNORABLE = "\u00ad\u034f\u061c\u115f\u1160\u17b4\u17b5\u180b\u180c\u180d\u180e\u200b\u200c\u200d\u200e\u200f\u202a\u202b\u202c\u202d\u202e\u2060\u2061\u2062\u2063\u2064\ufeff"


def _tables() -> dict[int, str]:
    table: dict[int, str] = {}
    for code in range(0x80, 0x30000):
        ch = chr(code)
        kind = unicodedata.category(ch)
        if kind == "Zs":
            table[code] = " "
        elif 0xFE00 <= code <= 0xFE0F or 0xE0100 <= code <= 0xE01EF:
            table[code] = ""
        elif 0xFF01 <= code <= 0xFF5E and kind in ("Lu", "Ll", "Nd"):
            table[code] = chr(code - 0xFEE0)
        elif 0x1D400 <= code <= 0x1D7FF or 0x2F00 <= code <= 0x2FD5 or 0xF900 <= code <= 0xFAFF or 0xFB00 <= code <= 0xFB06 or 0x2F800 <= code <= 0x2FA1F:
            plain = unicodedata.normalize("NFKC", ch)
            if plain != ch:
                table[code] = plain
        elif 0x2100 <= code <= 0x214F and kind in ("Lu", "Ll") and code != 0x2126:
            plain = unicodedata.normalize("NFKC", ch)
            if plain.isalpha() and plain != ch:
                table[code] = plain
    for source in (CYRILLIC, GREEK, ARMENIAN, RADICALS):
        table.update({ord(k): v for k, v in source.items()})
    for code in range(0x370, 0x530):  # accented letters of these scripts follow their base
        base, *marks = unicodedata.normalize("NFD", chr(code))
        if marks and ord(base) in table:
            table[code] = unicodedata.normalize("NFC", table[ord(base)] + "".join(marks))
    table.update({ord(ch): "" for ch in IGNORABLE})
    table[0x09] = table[0x0B] = table[0x0C] = " "
    # images are final: a mathematical Greek capital looks like what the Greek capital looks like
    return {code: "".join(table.get(ord(ch), ch) for ch in image) for code, image in table.items()}


TABLE = _tables()
BLANKS = "".join(sorted(chr(k) for k, v in TABLE.items() if v == " "))


def _char_class(codes: list[int]) -> str:
    """A regular-expression class of the given code points, as ranges."""
    parts, start, last = [], None, None
    for code in sorted(codes):
        if start is None:
            start = last = code
        elif code == last + 1:
            last = code
        else:
            parts.append((start, last))
            start = last = code
    if start is not None:
        parts.append((start, last))
    return "".join(re.escape(chr(a)) if a == b else f"{re.escape(chr(a))}-{re.escape(chr(b))}" for a, b in parts)


_MARKS = list(range(0x300, 0x370))
_CJK = [k for k in TABLE if 0x2E80 <= k <= 0x2FDF or 0xF900 <= k <= 0xFAFF or 0x2F800 <= k <= 0x2FA1F]
#: Letters of the scripts whose letters may look like Latin ones.
SCRIPTS = {
    name: frozenset(chr(c) for c in range(low, high) if unicodedata.category(chr(c)).startswith("L"))
    for name, low, high in (("greek", 0x370, 0x400), ("cyrillic", 0x400, 0x530), ("armenian", 0x530, 0x590))
}
_FOREIGN = [ord(ch) for letters in SCRIPTS.values() for ch in letters]
ODD_LETTER_CLASS = _char_class(sorted({k for k, v in TABLE.items() if v != " " and k not in set(_CJK)} | set(_MARKS) | set(_FOREIGN)))
ODD_CJK_CLASS = _char_class(_CJK)
BLANK_CLASS = _char_class([ord(ch) for ch in BLANKS])
#: Any character that ``fold`` may change, that may compose with its neighbour, or of another script with look-alikes.
ODD = re.compile(f"[{ODD_LETTER_CLASS}{ODD_CJK_CLASS}{BLANK_CLASS}]")
#: The same characters as a set.
ODD_CHARS = frozenset({chr(k) for k in TABLE} | {chr(k) for k in _MARKS} | {chr(k) for k in _FOREIGN})
#: A letter run with at least one odd character in it, one odd ideograph, or one odd blank.
ODD_TOKEN = re.compile(f"[0-9A-Za-zÀ-ɏ]*+[{ODD_LETTER_CLASS}][0-9A-Za-zÀ-ɏ{ODD_LETTER_CLASS}]*+|[{ODD_CJK_CLASS}][{_char_class([ord(c) for c in IGNORABLE])}]*+|[{BLANK_CLASS}]")
#: Letter runs of plain text, cut as ``ODD_TOKEN`` cuts.
PLAIN_WORD = re.compile("[0-9A-Za-zÀ-ɏ]+")
#: What the letters of each script look like, and the letters themselves.
_READABLE = {name: letters | {part for ch in letters for part in TABLE.get(ord(ch), ch)} for name, letters in SCRIPTS.items()}


def unescape(text: str) -> str:
    """Entities to characters, one level."""
    return html.unescape(text) if "&" in text else text


def has_odd(text: str) -> bool:
    """Whether a text holds a character that ``ODD`` finds; each distinct character is looked up once."""
    return not ODD_CHARS.isdisjoint(set(text))


def fold(text: str) -> str:
    """The table skeleton of a text; plain text comes back as it is."""
    if text.isascii():
        return text.replace("\t", " ") if "\t" in text else text
    odd = ODD_CHARS.intersection(set(text))
    if not odd:
        return text
    for ch in odd:  # a few distinct ones; no image in the table is odd itself
        text = text.replace(ch, TABLE.get(ord(ch), ch))
    return unicodedata.normalize("NFC", text)


@lru_cache(maxsize=1 << 16)
def fold_token(token: str) -> str:
    """``fold`` for short tokens that recur."""
    return unicodedata.normalize("NFC", token.translate(TABLE))


@lru_cache(maxsize=1 << 16)
def native_script(token: str) -> str | None:
    """The script that all letters of a token belong to, if it is one with look-alikes and nothing else is in the token."""
    letters = [ch for ch in token if not ch.isdigit()]
    return next((name for name, own in SCRIPTS.items() if letters and own.issuperset(letters)), None)


@lru_cache(maxsize=1 << 16)
def may_be_native(skeleton: str) -> bool:
    """Whether one of the other scripts can write something of this table skeleton."""
    letters = {ch for ch in skeleton if not ch.isdigit()}
    return bool(letters) and any(readable.issuperset(letters) for readable in _READABLE.values())


@lru_cache(maxsize=1 << 16)
def char_class(ch: str) -> str:
    """The look-alike class of one character, named by its table image."""
    return TABLE.get(ord(ch), ch)


assert sys.version_info >= (3, 11)  # possessive quantifiers
