"""Semantic marking of chapter HTML: titles, numerals, units, headings and verse.

Everything but the verse heuristic is a composition of JVM expressions.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from folioloom.functions.text import B0, B1, WS, shift_headings, wrap_section
from folioloom.functions.typography import on_text_nodes

# Titles before or after names, contexts of Roman numerals, and units of measure.
TITLES = (
    "Mr", "Mrs", "Ms", "Miss", "Dr", "Prof", "Rev", "St", "Jr", "Sr", "Capt", "Col", "Gen", "Sgt", "Cpl", "Lt", "Maj", "Adm", "Cmdr", "Supt", "Insp",
    "Gov", "Pres", "Sen", "Rep", "Esq", "Messrs", "Mme", "Mlle",
)
CONTEXTS = (
    "Chapter", "Act", "Scene", "Part", "Book", "Volume", "Vol", "Canto", "Section", "Article",
)
UNITS = (
    "miles?", "yards?", "feet", "foot", "inches?", "leagues?", "furlongs?", "fathoms?", "rods?", "chains?", "pounds?", "lbs?\\.?", "ounces?",
    "oz\\.?", "stones?", "tons?", "hundredweight", "cwt\\.?", "grains?", "gallons?", "quarts?", "pints?", "bushels?", "barrels?", "hogsheads?",
    "firkins?", "gills?", "shillings?", "pence", "guineas?", "crowns?", "florins?", "sovereigns?", "acres?", "knots?", "ft\\.?", "in\\.?", "yd\\.?",
    "mi\\.?", "mph",
)
# Roman numerals as they are recognised.
_ROMAN = r"X{0,3}(?:IX|IV|V?I{1,3})|X{1,3}|XL|L(?:X{0,3})|(?:XC|C)?[MDCLXVI]+"


def wrap_abbreviations(html: Column) -> Column:
    """Titles with their stop in an ``abbr`` element."""
    mark = r'<abbr data-epub-type="z3998:name-title">$1.</abbr>'
    return on_text_nodes(html, lambda x: F.regexp_replace(x, rf"{B0}({'|'.join(TITLES)})\.", mark))


def wrap_roman(html: Column) -> Column:
    """Roman numerals after a context word in a ``span``; one space between."""
    mark = r'$1 <span data-epub-type="z3998:roman">$2</span>'
    return on_text_nodes(html, lambda x: F.regexp_replace(x, rf"(?i){B0}({'|'.join(CONTEXTS)})[{WS}]+({_ROMAN}){B1}", mark))


def wrap_units(html: Column) -> Column:
    """Numbers with a unit of measure in a ``span``."""
    mark = r'<span data-epub-type="z3998:unit">$0</span>'
    return on_text_nodes(html, lambda x: F.regexp_replace(x, rf"(?i)\d{{1,3}}(?:,\d{{3}})*(?:\.\d+)?[{WS}]+(?:{'|'.join(UNITS)}){B1}", mark))


# Elements whose class marks verse, quotations, and the mark they get.
_VERSE_CLASS = re.compile(r'<(blockquote|div|p|pre)(\s[^>]*?)class="([^"]*\b(?:verse|poem|stanza)\b[^"]*)"([^>]*?)>', re.I)
_QUOTE = re.compile(r"<blockquote(\b[^>]*)>([\s\S]*?)</blockquote>", re.I)
_BREAK = re.compile(r"<br\s*/?>", re.I)
_MARK = ' data-epub-type="z3998:verse"'


def verse_blocks(html: str) -> str:
    """Elements of a verse class, and quotations of short broken lines, marked as verse."""

    def by_class(m: re.Match) -> str:
        return m[0] if "data-epub-type" in m[0] else f'<{m[1]}{m[2]}class="{m[3]}"{_MARK}{m[4]}>'

    def by_shape(m: re.Match) -> str:
        lines = [x for x in (re.sub(r"<[^>]+>", "", part).strip() for part in _BREAK.split(m[2])) if x]
        short = len(_BREAK.findall(m[2])) >= 3 and len(lines) >= 4 and sum(map(len, lines)) / len(lines) < 60
        return f"<blockquote{m[1]}{_MARK}>{m[2]}</blockquote>" if short and "data-epub-type" not in m[1] else m[0]

    return _QUOTE.sub(by_shape, _VERSE_CLASS.sub(by_class, html))


_MAY_BE_VERSE = re.compile("<blockquote|verse|poem|stanza", re.I)


def mark_verse(html: Column) -> Column:
    """``verse_blocks`` as a Column function (Arrow batches); only texts that can hold verse are looked through. Null stays null."""

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: verse_blocks(t) if _MAY_BE_VERSE.search(t) else t, na_action="ignore")

    return run(html)


def semanticize(html: Column) -> Column:
    """Section, headings, verse, numerals, titles and units, in this order."""
    return wrap_units(wrap_abbreviations(wrap_roman(mark_verse(shift_headings(wrap_section(html))))))
