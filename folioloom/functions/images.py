"""Images in chapter HTML: sources rewritten by a map, captions as alternative texts, inline data taken out."""

from __future__ import annotations

import html as _html
import re
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_IMG = re.compile(r"<img\b([^>]*?)>", re.I)
_SRC = re.compile(r"""src\s*=\s*["']([^"']*?)["']""", re.I)
_ALT = re.compile(r"""alt\s*=\s*["']([^"']*)["']""", re.I)
_DATA = r"""src=["'](data:image/([a-zA-Z0-9.+-]+);base64,([A-Za-z0-9+/=\s]+))["']"""


def image_map(images: list[tuple[str, str]]) -> dict[str, str]:
    """Every written form of an image's place and the address it gets."""
    out: dict[str, str] = {}
    for href, url in images:
        for form in dict.fromkeys((href, unquote(href))):
            out[f"/images/{form}"] = url
            out[form] = url
    return out


def rewrite(text: str, places: dict[str, str], captions: list[str]) -> str:
    """Sources replaced (exact form first, then a part), and images without a text given the next caption."""
    left = list(captions)

    def one(m: re.Match) -> str:
        attrs = m[1]
        source = _SRC.search(attrs)
        if not source:
            return m[0]
        new = places.get(source[1]) or next((u for form, u in places.items() if form in source[1]), source[1])
        attrs = attrs[: source.start()] + f'src="{new}"' + attrs[source.end() :]
        alt = _ALT.search(attrs)
        if left and not (alt and alt[1]):
            caption = _html.escape(left.pop(0))
            if alt:
                attrs = attrs[: alt.start()] + f'alt="{caption}"' + attrs[alt.end() :]
            elif "alt=" not in attrs.lower().replace(" ", ""):
                attrs = attrs.rstrip() + f' alt="{caption}"'
        return f"<img{attrs}>"

    return _IMG.sub(one, text)


def rewrite_images(html: Column, places: dict[str, str], captions: Column) -> Column:
    """``rewrite`` as a Column function; only texts with an image go to Python."""

    @F.pandas_udf("string")
    def run(texts: pd.Series, lists: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else rewrite(t, places, list(c) if c is not None else []) for t, c in zip(texts, lists)])

    return F.when(html.rlike(r"(?i)<img\b"), run(html, captions)).otherwise(html)


def inline_images(html: Column) -> Column:
    """Array of (position, format, bytes) of the images stored inside a text."""
    kinds = F.regexp_extract_all(html, F.lit(_DATA), F.lit(2))
    data = F.regexp_extract_all(html, F.lit(_DATA), F.lit(3))
    return F.transform(F.arrays_zip(kinds.alias("kind"), data.alias("data")), lambda x, i: F.struct(i.alias("position"), x["kind"].alias("format"), F.unbase64(F.regexp_replace(x["data"], r"\s", "")).alias("content")))


def without_inline_images(html: Column) -> Column:
    """Inline data replaced by numbered placeholders, in order."""
    parts = F.split(html, r"""src=["']data:image/[a-zA-Z0-9.+-]+;base64,[A-Za-z0-9+/=\s]+["']""")
    return F.array_join(F.transform(parts, lambda p, i: F.when(i == 0, p).otherwise(F.concat(F.lit('src="__INLINE_IMAGE_'), (i - 1).cast("string"), F.lit('__"'), p))), "")


def with_image_urls(html: Column, urls: Column) -> Column:
    """Placeholders replaced by the addresses of an array, in order."""
    return F.aggregate(F.transform(urls, lambda u, i: F.struct(i.alias("i"), u.alias("u"))), html, lambda acc, x: F.replace(acc, F.concat(F.lit("__INLINE_IMAGE_"), x["i"].cast("string"), F.lit("__")), x["u"]))
