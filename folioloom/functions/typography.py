"""Typography of text nodes: quotes, dashes, ellipses, joining signs and spaces.

``on_text_nodes`` maps a Column function over the text between tags; the rules are
Column functions over one node, so ``^`` and ``$`` mean the ends of the node.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from folioloom.functions.text import B0, B1, WS, section_breaks

LDQ, RDQ, LSQ, RSQ = "“", "”", "‘", "’"
WJ, EM, EN, DOTS, NBSP, HAIR = "⁠", "—", "–", "…", " ", " "
TWO_EM, THREE_EM = "⸺", "⸻"
# Abbreviations that keep to the next word.
JOINED_ABBREVIATIONS = ("Mr", "Mrs", "Ms", "Dr", "St", "Jr", "Sr", "Prof", "Rev", "Vol", "No", "vs", "etc")
_W = "[A-Za-z0-9_]"


def segments(html: Column) -> Column:
    """Tags and text nodes in order; an unclosed ``<`` begins a last text node."""
    return F.regexp_extract_all(html, F.lit(r"<[^>]*>|[^<]+|<[^>]*\z"), F.lit(0))


def on_text_nodes(html: Column, change: Callable[[Column], Column]) -> Column:
    """HTML with ``change`` applied to the text between tags."""
    return F.array_join(F.transform(segments(html), lambda x: F.when(x.startswith("<") & x.endswith(">"), x).otherwise(change(x))), "")


def smart_quotes(node: Column) -> Column:
    """Straight quotes to typographic ones, apostrophes first, then double, then single quotes."""
    s = node
    for entity, sign in (("&quot;", '"'), ("&apos;", "'"), ("&#39;", "'")):
        s = F.replace(s, F.lit(entity), F.lit(sign))
    end = rf"[{WS}.,;:!?)\]}}\-{EM}{EN}"
    # Patterns and replacements in their order.
    steps = (
        (rf"(?i)({_W})'(t|s|d|ll|re|ve|m){B1}", f"$1{RSQ}$2"),
        (rf"(?i)(?<={_W})'(tis|twas|em|n|cause){B1}", f"{RSQ}$1"),
        (rf"({_W})s'([{WS}]|\z)", f"$1s{RSQ}$2"),
        (rf"(?i){B0}(o)'(clock)", f"$1{RSQ}$2"),
        (rf"'(\d\ds?{B1})", f"{RSQ}$1"),
        (rf'(^|[{WS}(\[{{])"', f"$1{LDQ}"),
        (rf'"({end}]|\z)', f"{RDQ}$1"),
        (rf'({_W})"', f"$1{RDQ}"),
        (rf'"({_W})', f"{LDQ}$1"),
        ('"', RDQ),
        (rf"(^|[{WS}(\[{{]|{LDQ})'(?={_W})", f"$1{LSQ}"),
        (rf"'({end}{RDQ}]|\z)", f"{RSQ}$1"),
        ("'", RSQ),
    )
    for pattern, to in steps:
        s = F.regexp_replace(s, pattern, to)
    return F.when(node.rlike("['\"]|&quot;|&apos;|&#39;"), s).otherwise(node)


def em_dashes(node: Column) -> Column:
    """Double hyphens and spaced dashes to a joined em dash."""
    s = F.regexp_replace(node, " ?-- ?", WJ + EM)
    s = F.regexp_replace(s, f" ?{EM} ?", EM)
    return F.regexp_replace(s, f"{WJ}?{EM}", WJ + EM)


def multi_em_dashes(node: Column) -> Column:
    """Runs of em dashes to the two-em and three-em dash."""
    s = F.regexp_replace(node, f"(?:{WJ}?{EM}){{3,}}", THREE_EM)
    return F.regexp_replace(s, f"(?:{WJ}?{EM}){{2}}", TWO_EM)


def en_dashes(node: Column) -> Column:
    """Hyphens between digits to joined en dashes, left to right without overlap."""
    return F.regexp_replace(node, rf"(\d)[{WS}]*-[{WS}]*(\d)", f"$1{WJ}{EN}{WJ}$2")


def ellipses(node: Column) -> Column:
    """Three stops, spaced or not, to a joined ellipsis."""
    s = F.regexp_replace(node, r"\. \. \.|\.\.\.", WJ + DOTS)
    return F.regexp_replace(s, f"{WJ}?{DOTS}", WJ + DOTS)


def joined_abbreviations(node: Column) -> Column:
    """A no-break space after abbreviations before a letter."""
    return F.regexp_replace(node, rf"{B0}({'|'.join(JOINED_ABBREVIATIONS)})\. (?=[A-Za-z])", f"$1.{NBSP}")


def hair_spaces(node: Column) -> Column:
    """Hair spaces between nested quotes."""
    s = F.replace(node, F.lit(LDQ + LSQ), F.lit(LDQ + HAIR + LSQ))
    return F.replace(s, F.lit(RSQ + RDQ), F.lit(RSQ + HAIR + RDQ))


def typographize(html: Column) -> Column:
    """Section breaks, then all rules on every text node."""

    def node(x: Column) -> Column:
        for rule in (smart_quotes, em_dashes, multi_em_dashes, en_dashes, ellipses, joined_abbreviations, hair_spaces):
            x = rule(x)
        return x

    return on_text_nodes(section_breaks(html), node)
