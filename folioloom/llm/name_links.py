"""Spellings of names as people type them, linked to the listed name they mean.

Method. A symmetric-delete neighbourhood index on tokens: the distinct tokens of typed names
and the last words of listed names are spread to their forms with one letter deleted, or
two in long tokens; equal forms meet in an equi-join, which finds all tokens within so many
edits without comparing all pairs. Names that hold such a token are candidates for the
listed name, and their tokens are aligned by optimal assignment, permitting initials,
abbreviations, nicknames and edits. The alignment asks for the last word of a listed name,
so an index of last words misses nothing that it could accept.

A misspelt last name is no link if that spelling is another family's: if names that mean
nobody listed have it as their last name, at least ``OTHER_SHARE`` as many as have the
listed last name in its agreed spelling. Both counts grow with the corpus, so a stray typo
elsewhere takes no link away.

Only distinct spellings are aligned; records join their spelling's link in the end.

Defined results: null and empty names, placeholders and names of nobody listed have no
link; a name that means two listed ones equally well has none, unless years decide;
repeated records count once; agreed spellings link to themselves.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioloom.functions.chinese import simplify
from folioloom.llm import charforms
from folioloom.session import materialise

#: Least letters of a token that may have one edit and two, and most edits of a name.
ONE_EDIT_LENGTH, TWO_EDITS_LENGTH, MAX_EDITS = 4, 8, 2
#: Least letters of the tokens of a name with more than one edit.
LONG_LENGTH = 6
MAX_COST = 2.5
#: Share of a listed last name's own uses that makes a misspelling of it another family's name.
OTHER_SHARE = 0.02
YEARS_APART = 3

# Titles and roles that are no part of a name.
TITLES = frozenset((
    "mr", "mrs", "ms", "miss", "dr", "prof", "rev", "sir", "lady", "lord", "capt", "col", "gen", "fr", "sr", "jr", "esq", "the", "of", "and", "by",
    "author", "editor", "translator", "ed", "eds", "trans", "et", "al", "ii", "iii", "iv",
))
# Placeholders for an unknown name.
PLACEHOLDERS = frozenset((
    "unknown", "anonymous", "anon", "various", "na", "none", "null", "nil", "untitled", "佚名", "无名氏", "不详", "未知", "阙名",
))
# Words by which an organisation is told from a person.
ORGANISATION_WORDS = frozenset(("society", "company", "institute", "association", "university", "college", "academy", "club", "committee", "council", "department", "ministry", "museum", "library", "press", "church", "bureau", "union", "league"))
# Full first names and their familiar forms.
NICKNAMES = {
    "alexander": ("alec", "alex", "sandy", "al", "xander"),
    "andrew": ("andy", "drew"),
    "anne": ("annie", "nan", "nancy"),
    "anthony": ("tony",),
    "augusta": ("gussie", "gus"),
    "benjamin": ("ben", "benny", "benjy"),
    "catherine": ("kate", "kitty", "cathy", "katie", "kit", "cat"),
    "charles": ("charlie", "chas", "chuck"),
    "christopher": ("chris", "kit"),
    "daniel": ("dan", "danny"),
    "david": ("dave", "davy"),
    "dorothea": ("dora", "dot", "dolly", "thea"),
    "edward": ("ted", "ned", "ed", "eddie", "teddy"),
    "eleanor": ("nell", "ellie", "nora", "nellie"),
    "elizabeth": ("bess", "lizzie", "liz", "beth", "betty", "eliza", "lisa"),
    "frances": ("fanny", "fran"),
    "francis": ("frank",),
    "frederick": ("fred", "freddie", "freddy"),
    "george": ("georgie",),
    "henry": ("harry", "hal", "hank"),
    "james": ("jim", "jimmy", "jamie"),
    "john": ("jack", "johnny"),
    "joseph": ("joe",),
    "josephine": ("jo", "josie"),
    "katherine": ("kate", "kitty"),
    "lawrence": ("larry",),
    "margaret": ("peggy", "meg", "maggie", "madge", "greta"),
    "martha": ("patty",),
    "mary": ("molly", "polly"),
    "matilda": ("tilly", "mattie", "maud"),
    "matthew": ("matt",),
    "michael": ("mike", "mick"),
    "nathaniel": ("nat", "nate"),
    "nicholas": ("nick",),
    "patrick": ("pat", "paddy"),
    "philip": ("phil", "pip"),
    "rebecca": ("becky",),
    "richard": ("dick", "rick", "rich"),
    "robert": ("bob", "rob", "bobby", "robbie", "bert"),
    "samuel": ("sam", "sammy"),
    "sarah": ("sally",),
    "susan": ("sue",),
    "theodore": ("theo", "ted", "teddy"),
    "theresa": ("tess",),
    "thomas": ("tom", "tommy"),
    "timothy": ("tim",),
    "walter": ("walt",),
    "william": ("bill", "will", "billy", "willie", "liam"),
}
_NICK = {full: frozenset(short) for full, short in NICKNAMES.items()}

_CJK = re.compile("[㐀-鿿]")
_YEARS = re.compile(r"(?<!\d)(\d{3,4})\s*[-–—]\s*(\d{3,4})?(?!\d)")
_BRACKETS = re.compile(r"[（(\[〔【〈《][^）)\]〕】〉》]*[）)\]〕】〉》]")
_ZH_BEFORE = re.compile(r"^.*[：:·•]")
# Signs of a role after a Chinese name.
_ZH_AFTER = re.compile("(?:先生|女士|编著|主编|著|编|撰|译|輯|辑|作|等)+$")
_DOTS = re.compile(r"(?<=[A-Za-z])\.(?=[A-Za-z])")
_PIECES = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?\.?")


def bare(text: str) -> str:
    """Lower case without accents."""
    return "".join(ch for ch in unicodedata.normalize("NFD", text.lower()) if not unicodedata.combining(ch))


def parse_name(name: str | None) -> tuple[str, list[str], str | None, int | None, int | None]:
    """(kind, tokens, last name, birth, death) of a typed name; kind is latin, zh or none.

    A token that ends with a full stop is an initial or an abbreviation. The last name is
    the last token, or the last before a comma.
    """
    if not name:
        return ("none", [], None, None, None)
    text = charforms.fold(charforms.unescape(name)).strip()
    birth = death = None
    if found := _YEARS.search(text):
        birth, death = int(found[1]), int(found[2]) if found[2] else None
        text = text[: found.start()] + " " + text[found.end() :]
    text = _BRACKETS.sub(" ", text)
    if _CJK.search(text):
        core = re.sub(r"[\s\W]+", "", _ZH_BEFORE.sub("", simplify(re.sub(r"\s+", "", text))))
        if len(core) > 2:
            core = _ZH_AFTER.sub("", core) or core
        return ("none", [], None, birth, death) if not core or core in PLACEHOLDERS else ("zh", [core], core, birth, death)
    parts = [_tokens(part) for part in text.split(",")]
    tokens = [t for part in parts for t in part]
    if not tokens or all(t.rstrip(".") in PLACEHOLDERS for t in tokens):
        return ("none", [], None, birth, death)
    last = parts[0][-1] if parts[0] and len(parts) > 1 and any(parts[1:]) else tokens[-1]
    return ("latin", tokens, last.rstrip("."), birth, death)


def _tokens(text: str) -> list[str]:
    found = map(bare, _PIECES.findall(_DOTS.sub(". ", text)))
    return [t for t in found if t.rstrip(".") not in TITLES]


def is_organisation(name: str) -> bool:
    """Whether a listed name is that of an organisation."""
    words = set(re.findall(r"[^\W\d_]+", name.lower()))
    return bool(words & ORGANISATION_WORDS) or " of " in name


def edits_allowed(token: str) -> int:
    """Edits that a token of this length may have."""
    return 0 if len(token) < ONE_EDIT_LENGTH else 1 if len(token) < TWO_EDITS_LENGTH else 2


def deletes(token: str, most: int | None = None) -> set[str]:
    """The token and its forms with up to ``most`` letters deleted (``edits_allowed`` by default)."""
    forms = last = {token}
    for _ in range(edits_allowed(token) if most is None else most):
        last = {f[:i] + f[i + 1 :] for f in last for i in range(len(f))}
        forms = forms | last
    return forms


@lru_cache(maxsize=1 << 16)
def edits_apart(a: str, b: str) -> int:
    """Substitutions, insertions, deletions and swaps of neighbours between two strings, each letter edited once."""
    before: list[int] = []
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, last, row = row, before, [i] + [0] * len(b)
        for j, y in enumerate(b, 1):
            row[j] = min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                row[j] = min(row[j], last[j - 2] + 1)
    return row[-1]


@lru_cache(maxsize=1 << 16)
def token_cost(typed: str, listed: str, place: str) -> tuple[float, int] | None:
    """(cost, edits) of a typed token standing for a listed one; None if it can't.

    ``place`` is first, middle, last or any (a word of an organisation).
    """
    plain = typed.rstrip(".")
    if plain == listed:
        return (0.0, 0)
    if place != "last":
        if len(plain) == 1:
            return (0.4, 0) if listed.startswith(plain) else None
        if plain in _NICK.get(listed, ()):
            return (0.3, 0)
        if typed.endswith(".") and listed.startswith(plain):
            return (0.3, 0)
    most = min(edits_allowed(plain), edits_allowed(listed))
    if most and abs(len(plain) - len(listed)) <= most and 0 < (n := edits_apart(plain, listed)) <= most:
        return (float(n), n)
    return None


def align(typed: list[str], listed: list[str], organisation: bool) -> tuple[float, int, str | None] | None:
    """(cost, edits, misspelt last name or None) of the best assignment of typed tokens to listed ones.

    Every typed token needs a partner. Of a person the first and the last name need one,
    a middle name may be left out; of an organisation every word needs one. At most
    ``MAX_EDITS`` edits in all, more than one only where all typed tokens but initials are
    long; a misspelt last name needs the first name in full.
    """
    places = ["any"] * len(listed) if organisation else ["first", *["middle"] * (len(listed) - 2), "last"]
    places[-1] = "last"
    if len(typed) > len(listed) or len(typed) < (len(listed) if organisation else min(2, len(listed))):
        return None
    most = MAX_EDITS if all(len(t.rstrip(".")) >= LONG_LENGTH or len(t.rstrip(".")) == 1 for t in typed) else 1
    ways: dict[int, tuple[float, int, str, bool]] = {0: (0.0, 0, "", True)}
    for token in typed:
        nxt: dict[int, tuple[float, int, str, bool]] = {}
        for used, (cost, edits, wrong_last, full_first) in ways.items():
            for k, word in enumerate(listed):
                if used >> k & 1 or (step := token_cost(token, word, places[k])) is None or edits + step[1] > most:
                    continue
                way = (
                    cost + step[0],
                    edits + step[1],
                    token.rstrip(".") if places[k] == "last" and step[1] else wrong_last,
                    full_first and not (places[k] == "first" and len(token.rstrip(".")) == 1),
                )
                if used | 1 << k not in nxt or way < nxt[used | 1 << k]:
                    nxt[used | 1 << k] = way
        ways = nxt
    need = (1 << len(listed)) - 1 if organisation else 1 | 1 << (len(listed) - 1)
    good = [(cost + 0.1 * (len(listed) - bin(used).count("1")), edits, wrong) for used, (cost, edits, wrong, full) in ways.items() if used & need == need and (full or not wrong)]
    if not good:
        return None
    cost, edits, wrong = min(good)
    return (cost, edits, wrong or None)


_PARSED = "name string, kind string, tokens array<string>, own_last string, name_birth int, name_death int"


def _parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = [(n, *parse_name(n)) for n in batch["name"]]
        out = pd.DataFrame(rows, columns=["name", "kind", "tokens", "own_last", "name_birth", "name_death"])
        yield out.astype({"name_birth": "Int32", "name_death": "Int32"})


def _spread(tokens: DataFrame, token: str) -> DataFrame:
    """(token, form): the deletion neighbourhood of each of the distinct tokens (token, kind)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(t, f) for t, kind in zip(batch[token], batch["kind"]) for f in (deletes(t) if kind == "latin" else {t})]
            yield pd.DataFrame(rows, columns=[token, "form"])

    return tokens.select(token, "kind").distinct().mapInPandas(run, f"{token} string, form string")


def _align(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for name, kind, tokens, author, listed, organisation in zip(
            batch["name"], batch["kind"], batch["tokens"], batch["author_id"], batch["listed"], batch["organisation"]
        ):
            tokens, listed = list(tokens), list(listed)
            if kind == "zh":
                found = (0.0, 0, None) if tokens == listed else None
            else:
                found = align(tokens, listed, bool(organisation))
            if found and found[0] <= MAX_COST:
                rows.append((name, author, listed[-1], *found))
        yield pd.DataFrame(rows, columns=["name", "author_id", "listed_last", "cost", "edits", "wrong_last"])


def typed_names(records: DataFrame) -> DataFrame:
    """The distinct names of records, parsed; placeholders and names without letters are left out."""
    return materialise(records.select("name").distinct().mapInPandas(_parse, _PARSED).where("kind != 'none'"), "names")


def listed_names(authors: DataFrame) -> DataFrame:
    """(author_id, kind, listed, last, organisation, a_birth, a_death) of authors (id, name, birth_year, death_year)."""
    listed = (
        authors.select(F.col("name"), F.col("id").cast("string").alias("author_id"), "birth_year", "death_year")
        .dropDuplicates(["author_id"])
        .where("name is not null")
    )
    parsed = listed.select("name").distinct().mapInPandas(_parse, _PARSED).where("kind != 'none'")
    parsed = parsed.select(F.col("name").alias("p_name"), "kind", F.col("tokens").alias("listed"), F.regexp_replace(F.element_at("tokens", -1), r"\.$", "").alias("last"))
    organisation = F.udf(is_organisation, "boolean", useArrow=False)
    listed = listed.join(parsed, F.col("name") == F.col("p_name")).select(
        "author_id", "kind", "listed", "last", organisation("name").alias("organisation"), F.col("birth_year").alias("a_birth"), F.col("death_year").alias("a_death")
    )
    return materialise(listed, "listed")


def aligned_names(typed: DataFrame, listed: DataFrame) -> DataFrame:
    """(name, author_id, listed_last, cost, edits, wrong_last) of typed and listed names that an alignment brings together."""
    held = typed.select("name", "kind", F.explode(F.array_distinct(F.transform("tokens", lambda t: F.regexp_replace(t, r"\.$", "")))).alias("token"))
    left, right = _spread(held, "token"), _spread(listed, "last")
    near = left.join(right.withColumnRenamed("form", "l_form"), F.col("form") == F.col("l_form")).select(F.col("token").alias("n_token"), F.col("last").alias("n_last")).distinct()
    pairs = held.join(near, F.col("token") == F.col("n_token")).select(F.col("name").alias("c_name"), "n_last").distinct()
    candidates = (
        pairs.join(typed, F.col("c_name") == F.col("name"))
        .join(listed.select("author_id", "listed", "organisation", "last", F.col("kind").alias("a_kind")), F.col("n_last") == F.col("last"))
        .where("kind = a_kind")
        .select("name", "kind", "tokens", "author_id", "listed", "organisation")
        .distinct()
    )
    return candidates.mapInPandas(_align, "name string, author_id string, listed_last string, cost double, edits int, wrong_last string")


def link_names(records: DataFrame, authors: DataFrame) -> DataFrame:
    """(record_table, record_key, author_id) of records (record_table, record_key, name, birth_year, death_year)
    that mean a row of authors (id, name, birth_year, death_year)."""
    once = records.select("record_table", "record_key", "name", "birth_year", "death_year").where(F.col("name").isNotNull() & (F.trim("name") != "")).distinct()
    typed, listed = typed_names(once), listed_names(authors)
    aligned = materialise(aligned_names(typed, listed), "aligned")

    known = aligned.select(F.col("name").alias("k_name")).distinct()
    others = typed.where("kind = 'latin'").join(known, F.col("name") == F.col("k_name"), "left_anti").groupBy(F.col("own_last").alias("other_last")).agg(F.count("*").alias("other_uses"))
    agreed = typed.where("kind = 'latin'").groupBy(F.col("own_last").alias("agreed_last")).agg(F.count("*").alias("agreed_uses"))
    misspelt = aligned.where("wrong_last is not null").select("wrong_last", "listed_last").distinct()
    weighed = misspelt.join(others, F.col("wrong_last") == F.col("other_last")).join(agreed, F.col("listed_last") == F.col("agreed_last"), "left")
    foreign = weighed.where(F.col("other_uses") >= F.lit(OTHER_SHARE) * F.coalesce("agreed_uses", F.lit(0))).select(F.col("wrong_last").alias("f_wrong"), F.col("listed_last").alias("f_listed"))
    kept = aligned.join(foreign, (F.col("wrong_last") == F.col("f_wrong")) & (F.col("listed_last") == F.col("f_listed")), "left_anti")

    years = listed.select(F.col("author_id").alias("y_author"), "a_birth", "a_death")
    of_name = typed.select(F.col("name").alias("t_name"), "name_birth", "name_death")
    ways = (
        once.join(kept.withColumnRenamed("name", "w_name"), F.col("name") == F.col("w_name"))
        .join(of_name, F.col("name") == F.col("t_name"))
        .join(years, F.col("author_id") == F.col("y_author"))
    )
    birth, death = F.coalesce("birth_year", "name_birth"), F.coalesce("death_year", "name_death")
    both_apart = (F.abs(birth - F.col("a_birth")) > YEARS_APART) & F.coalesce(F.abs(death - F.col("a_death")) > YEARS_APART, F.lit(True))
    apart = F.coalesce(both_apart, F.lit(False))
    near = F.coalesce(F.abs(birth - F.col("a_birth")) <= 1, F.lit(False)) | F.coalesce(F.abs(death - F.col("a_death")) <= 1, F.lit(False))
    ranked = ways.where(~(apart & (F.col("edits") > 0))).withColumn("rank", F.struct("cost", (~near).cast("int").alias("far")))
    best = ranked.groupBy("record_table", "record_key", "name").agg(F.min("rank").alias("best"), F.collect_list(F.struct("rank", "author_id")).alias("all"))
    winners = F.array_distinct(F.transform(F.filter("all", lambda x: x["rank"] == F.col("best")), lambda x: x["author_id"]))
    return best.select("record_table", "record_key", winners.alias("w")).where(F.size("w") == 1).select("record_table", "record_key", F.col("w")[0].alias("author_id")).distinct()
