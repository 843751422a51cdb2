"""Texts that look the same but differ in their characters, brought to one form.

Method. The spellings of the corpus form a vocabulary, kept in tries: words of Latin
letters from every text, and words written wholly in another script that has look-alikes
(Greek, Cyrillic, Armenian). A token with odd characters is traversed through a trie by a
weighted edit automaton in which look-alike substitutions and ignorable characters cost
nothing. Among the spellings reached one in Latin letters comes first, since texts without
odd characters hold it as it is; else the most frequent is canonical, so that a native word
keeps its script. A token that reaches none is normalised by the table of ``charforms``, as
are single ideographs and blanks.

Zero-cost spellings share one table skeleton, so vocabulary and odd tokens are sharded by a
hash of the skeleton, with as many shards as their number asks for; nothing is broadcast by
hand. A text's key is a fingerprint mod 2^127 - 1 of its canonical form that can be put
together from the fingerprints of its parts, so no text is shuffled: only texts with tokens
that another script could write wait for their canonical spellings, as fingerprints.

Defined results: null and empty texts have no form and take part in nothing; a repeated
row counts once; extra columns are ignored; texts are processed whole.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioloom.llm import charforms
from folioloom.operators.layout import once
from folioloom.session import materialise

#: Distinct odd tokens of one shard, about.
SHARD_TOKENS = 100_000
#: Distinct tokens a task holds before it hands its counts on.
VOCABULARY_FLUSH = 200_000

_COLUMNS = ["kind", "part", "id", "variant", "key", "prints", "sizes", "tokens", "token", "skeleton", "n"]
_SCAN_SCHEMA = "kind string, part string, id string, variant string, key string, prints array<string>, sizes array<long>, tokens array<string>, token string, skeleton string, n long"


class LookalikeTrie:
    """Vocabulary spellings with their counts, searched by a weighted edit automaton.

    Zero cost: a character of the same look-alike class, and an ignorable character of
    the token. ``other_cost``: any other substitution, insertion or deletion, allowed up
    to ``max_cost`` in total (0 keeps to spellings that look the same).
    """

    def __init__(self, other_cost: float = 1.0, max_cost: float = 0.0) -> None:
        self.root: dict = {}
        self.other_cost = other_cost
        self.max_cost = max_cost

    def add(self, spelling: str, count: int) -> None:
        node = self.root
        for ch in spelling:
            node = node.setdefault(ch, {})
        node[""] = (count, spelling)

    def search(self, token: str) -> list[tuple[float, int, str]]:
        """(cost, count, spelling) of every spelling within ``max_cost``."""
        symbols = charforms.fold_token(token)
        found: dict[str, tuple[float, int]] = {}
        best: dict[tuple[int, int], float] = {}
        stack = [(self.root, 0, 0.0)]
        while stack:
            node, at, cost = stack.pop()
            state = (id(node), at)
            if best.get(state, cost + 1) <= cost:
                continue
            best[state] = cost
            if at == len(symbols) and "" in node:
                count, spelling = node[""]
                if found.get(spelling, (cost + 1, 0))[0] > cost:
                    found[spelling] = (cost, count)
            for edge, child in node.items():
                if edge == "":
                    continue
                if at < len(symbols):
                    same = charforms.char_class(edge) == symbols[at]
                    step = cost + (0.0 if same else self.other_cost)
                    if step <= self.max_cost:
                        stack.append((child, at + 1, step))
                if cost + self.other_cost <= self.max_cost:
                    stack.append((child, at, cost + self.other_cost))
            if at < len(symbols) and cost + self.other_cost <= self.max_cost:
                stack.append((node, at + 1, cost + self.other_cost))
        return [(cost, count, spelling) for spelling, (cost, count) in found.items()]

    def canonical(self, token: str) -> str | None:
        """The canonical spelling: least cost, then without odd characters, then most frequent, then first in order."""
        reached = self.search(token)
        if not reached:
            return None
        return min(reached, key=lambda x: (x[0], charforms.has_odd(x[2]), -x[1], x[2]))[2]


def _digest(text: str) -> str:
    return hashlib.md5(text.encode("utf-8", "surrogatepass")).hexdigest()


_MODULUS = (1 << 127) - 1


def fingerprint(text: str) -> tuple[int, int]:
    """(value mod 2^127 - 1, length) of a text's bytes read as one number to base 256."""
    raw = text.encode("utf-8", "surrogatepass")
    return int.from_bytes(raw, "big") % _MODULUS, len(raw)


def joined(parts: list[tuple[int, int]]) -> str:
    """The key of the text whose parts have these fingerprints, one after the other."""
    value = size = 0
    for part, length in parts:
        value = (value * pow(256, length, _MODULUS) + part) % _MODULUS
        size += length
    return f"{value:032x}-{size:x}"


def _open(token: str) -> bool:
    """Whether the canonical spelling of an odd token may differ from its table skeleton."""
    return charforms.may_be_native(charforms.fold_token(token))


def cut_open(text: str) -> tuple[list[str], list[str]]:
    """A decoded text with its odd tokens folded, cut at those whose spelling is open: (stretches, open tokens)."""
    stretches, tokens, current, at = [], [], [], 0
    for match in charforms.ODD_TOKEN.finditer(text):
        current.append(text[at : match.start()])
        token = match.group()
        if _open(token):
            stretches.append("".join(current))
            tokens.append(token)
            current = []
        else:
            current.append(charforms.fold_token(token))
        at = match.end()
    stretches.append("".join([*current, text[at:]]))
    return stretches, tokens


def _scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One pass over the texts: keys, parts of texts with open tokens, odd tokens and vocabulary counts."""
    pieces: Counter[str] = Counter()
    odd: Counter[str] = Counter()

    def words() -> pd.DataFrame:
        vocabulary: Counter[str] = Counter()
        for piece, n in pieces.items():
            for word in charforms.PLAIN_WORD.findall(piece):
                vocabulary[word] += n
        rows = [_word_row("vocab", w, w, n) for w, n in vocabulary.items()]
        for token, n in odd.items():
            skeleton = charforms.fold_token(token)
            rows.append(_word_row("odd", token, skeleton, n))
            if charforms.native_script(token):
                rows.append(_word_row("vocab", token, skeleton, n))
        pieces.clear()
        odd.clear()
        return _frame(rows)

    for batch in batches:
        rows: list[tuple] = []
        for part, key, text in zip(batch["part"], batch["id"], batch["text"]):
            decoded = charforms.unescape(text)
            variant = _digest(text)
            if (decoded.isascii() and "\t" not in decoded) or not charforms.has_odd(decoded):
                pieces.update(decoded.split())
                rows.append(("key", part, key, variant, joined([fingerprint(decoded)]), *_NO_PARTS))
                continue
            odd.update(t for t in charforms.ODD_TOKEN.findall(decoded) if len(t) > 1 or t.isalpha() and t < "\u2e80")
            pieces.update(charforms.ODD_TOKEN.sub(" ", decoded).split())
            stretches, tokens = cut_open(decoded)
            if tokens:
                prints = [fingerprint(s) for s in stretches]
                rows.append(("open", part, key, variant, None, [f"{v:x}" for v, _ in prints], [n for _, n in prints], tokens, None, None, None))
            else:
                rows.append(("key", part, key, variant, joined([fingerprint(stretches[0])]), *_NO_PARTS))
        yield _frame(rows)
        if len(pieces) + len(odd) > VOCABULARY_FLUSH:
            yield words()
    yield words()


_NO_PARTS = (None, None, None, None, None, None)


def _word_row(kind: str, token: str, skeleton: str, n: int) -> tuple:
    return (kind, None, None, None, None, None, None, None, token, skeleton, n)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=_COLUMNS)
    out["n"] = out["n"].astype("Int64")
    return out


def _resolve(odd: pd.DataFrame, vocabulary: pd.DataFrame) -> pd.DataFrame:
    """Canonical spellings of the odd tokens of one shard."""
    trie = LookalikeTrie()
    for spelling, n in zip(vocabulary["spelling"], vocabulary["uses"]):
        trie.add(spelling, int(n))
    tokens = odd["odd_token"].tolist()
    return pd.DataFrame({"token": tokens, "skeleton": odd["odd_skeleton"], "canonical": [trie.canonical(t) or charforms.fold_token(t) for t in tokens]})


def scan_texts(texts: DataFrame) -> DataFrame:
    """The scan of (part, id, text) rows as one shared intermediate table."""
    rows = texts.select(
        F.col("part").cast("string").alias("part"), F.col("id").cast("string").alias("id"), F.col("text").cast("string").alias("text")
    ).where(F.col("text").isNotNull() & (F.length("text") > 0) & F.col("id").isNotNull())
    return materialise(rows.mapInPandas(_scan, _SCAN_SCHEMA), "lookalike", "kind")


def canonical_spellings(scan: DataFrame) -> DataFrame:
    """(token, skeleton, canonical) of every odd token of a scan."""
    odd = materialise(scan.where("kind = 'odd'").select(F.col("token").alias("odd_token"), F.col("skeleton").alias("odd_skeleton")).distinct(), "odd")
    shards = odd.count() // SHARD_TOKENS + odd.sparkSession.sparkContext.defaultParallelism
    shard = lambda c: F.pmod(F.xxhash64(c), F.lit(shards))
    wanted = odd.select(F.col("odd_skeleton").alias("wanted")).distinct()
    vocabulary = (
        scan.where("kind = 'vocab'")
        .join(wanted, F.col("skeleton") == F.col("wanted"), "left_semi")
        .groupBy("token", "skeleton")
        .agg(F.sum("n").alias("uses"))
        .select(shard("skeleton").alias("v_shard"), F.col("token").alias("spelling"), "uses")
    )
    tokens = odd.select(shard("odd_skeleton").alias("o_shard"), "odd_token", "odd_skeleton")
    return (
        tokens.groupBy("o_shard")
        .cogroup(vocabulary.groupBy("v_shard"))
        .applyInPandas(_resolve, "token string, skeleton string, canonical string")
    )


def _spelled(scan: DataFrame) -> DataFrame:
    """The texts of a scan with open tokens, each with its (token, canonical) pairs where the table doesn't give the spelling."""
    texts = scan.where("kind = 'open'").select("part", "id", "variant", "prints", "sizes", "tokens")
    differs = materialise(canonical_spellings(scan).where("canonical != skeleton").select(F.col("token").alias("c_token"), "canonical"), "spellings")
    held = texts.select("part", "id", "variant", F.explode(F.array_distinct("tokens")).alias("token")).join(differs, F.col("token") == F.col("c_token"))
    pairs = held.groupBy(F.col("part").alias("s_part"), F.col("id").alias("s_id"), F.col("variant").alias("s_variant")).agg(F.map_from_entries(F.collect_set(F.struct("token", "canonical"))).alias("spellings"))
    same = (F.col("part") == F.col("s_part")) & (F.col("id") == F.col("s_id")) & (F.col("variant") == F.col("s_variant"))
    return texts.join(pairs, same, "left").drop("s_part", "s_id", "s_variant")


def _put_together(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        keys = []
        for prints, sizes, tokens, spellings in zip(batch["prints"], batch["sizes"], batch["tokens"], batch["spellings"]):
            known = dict(spellings) if spellings is not None else {}
            parts = [(int(prints[0], 16), int(sizes[0]))]
            for token, value, size in zip(tokens, prints[1:], sizes[1:]):
                parts += [fingerprint(known.get(token) or charforms.fold_token(token)), (int(value, 16), int(size))]
            keys.append(joined(parts))
        yield pd.DataFrame({"part": batch["part"], "id": batch["id"], "variant": batch["variant"], "key": keys})


def lookalike_keys(texts: DataFrame) -> DataFrame:
    """(part, id, variant, key): texts of one part look the same exactly if their keys are equal.

    ``variant`` tells the stored strings apart. One row per distinct (id, string).
    """
    scan = scan_texts(texts)
    closed = scan.where("kind = 'key'").select("part", "id", "variant", "key")
    opened = _spelled(scan).mapInPandas(_put_together, "part string, id string, variant string, key string")
    return materialise(closed.unionByName(opened).distinct(), "keys")


def canonical_texts(texts: DataFrame) -> DataFrame:
    """(part, id, canonical): every non-empty text in its one form, once per id; texts without open tokens are folded where they are."""
    spellings = _spelled(scan_texts(texts)).where("spellings is not null").select(F.col("part").alias("o_part"), F.col("id").alias("o_id"), "spellings").dropDuplicates(["o_part", "o_id"])

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text, known in zip(batch["text"], batch["spellings"]):
                stretches, tokens = cut_open(charforms.unescape(text))
                spelled = dict(known) if known is not None else {}
                out.append("".join([stretches[0], *[(spelled.get(t) or charforms.fold_token(t)) + s for t, s in zip(tokens, stretches[1:])]]))
            yield pd.DataFrame({"part": batch["part"], "id": batch["id"], "canonical": out})

    rows = texts.select(F.concat_ws("\u0001", "part", "id").alias("row_key"), *(F.col(c).cast("string").alias(c) for c in ("part", "id", "text"))).where("text != '' and id is not null")
    joined_rows = once(rows, "row_key").join(spellings, (F.col("part") == F.col("o_part")) & (F.col("id") == F.col("o_id")), "left")
    return joined_rows.select("part", "id", "text", "spellings").mapInPandas(write, "part string, id string, canonical string")


def lookalike_classes(keys: DataFrame) -> DataFrame:
    """One row per text with its class (the key), the class's size and its number of different strings."""
    sizes = keys.groupBy("part", "key").agg(F.count("*").alias("class_size"), F.countDistinct("variant").alias("variants"))
    return keys.join(sizes, ["part", "key"]).select("part", "id", F.col("key").alias("class_id"), "class_size", "variants")


def lookalike_pairs(keys: DataFrame) -> DataFrame:
    """(id_a, id_b) of texts that look the same and are different strings, id_a < id_b.

    Only classes with two strings or more go on. Their different strings are paired first and
    their texts after, so copies of one string never meet each other.
    """
    mixed = materialise(
        keys.groupBy("part", "key").agg(F.min("variant").alias("low"), F.max("variant").alias("high")).where("low != high").select(F.col("part").alias("m_part"), F.col("key").alias("m_key")), "mixed"
    )
    rows = materialise(keys.join(mixed, (F.col("part") == F.col("m_part")) & (F.col("key") == F.col("m_key")), "left_semi"), "mixed_rows")
    strings = rows.select("part", "key", "variant").distinct()
    a = strings.select("part", "key", F.col("variant").alias("va"))
    b = strings.select(F.col("part").alias("b_part"), F.col("key").alias("b_key"), F.col("variant").alias("vb"))
    unlike = a.join(b, (F.col("part") == F.col("b_part")) & (F.col("key") == F.col("b_key")) & (F.col("va") < F.col("vb"))).select("part", "key", "va", "vb")
    named = rows.select(F.col("part").alias("r_part"), F.col("key").alias("r_key"), "variant", "id")
    first = unlike.join(named, (F.col("part") == F.col("r_part")) & (F.col("key") == F.col("r_key")) & (F.col("va") == F.col("variant"))).select("part", "key", "vb", F.col("id").alias("x"))
    both = first.join(named, (F.col("part") == F.col("r_part")) & (F.col("key") == F.col("r_key")) & (F.col("vb") == F.col("variant"))).where("x != id")
    return both.select(F.least("x", "id").alias("id_a"), F.greatest("x", "id").alias("id_b")).distinct()
