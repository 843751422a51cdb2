"""Several values packed in one field, split into one value per row with its place.

Method. Quoting is read first: JSON arrays (also stored as a JSON string), list
literals and CSV-quoted spans give values that stay atomic. What is left is a lattice of
atoms between possible delimiters. Expectation-maximisation over the whole column learns
how often each value occurs: the first counts come from the fields that can be read in one
way only, each round weighs all segmentations of each other field by forward-backward and
adds up the expected counts (a field's own share is left out when it is scored), until the
weights stay (``TOLERANCE``). A Viterbi pass then picks the likeliest segmentation, so
``Law, civil`` stays one value beside ``Orphans, Fables``.

Each distinct field is segmented once, named by a hash of 128 bits, with its candidates
joined to the counts by shuffle; fields without a choice take no part in the rounds;
nothing is collected or broadcast by hand.

A lattice holds all spans of up to ``MAX_SPAN`` atoms. A longer value can only win if it
stands quoted somewhere, since each further atom makes an unknown value 1e-5 times as
likely; the longer spans that read as such a quoted value are found by a join on their first
``MAX_SPAN`` atoms and added to the lattice.

Defined results: null and empty fields, and fields of delimiters only, give no rows;
empty values are not counted; values that recur stay; a repeated row counts once.
"""

from __future__ import annotations

import ast
import json
import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioloom.session import materialise

MAX_SPAN = 8
#: Most rounds, and the share of all weight that may still move when they end.
ROUNDS, TOLERANCE = 8, 1e-3
#: Share of a value's probability that comes from the base measure instead of the counts.
NEW_SHARE = 0.05
BASE_ONE, BASE_MORE = 1e-3, 1e-5
#: Probability that a value goes on across a delimiter, by delimiter.
JOIN = {";": 1e-6, "|": 1e-6, "\n": 1e-9, "\t": 1e-9, "；": 1e-6, "、": 1e-5, "，": 0.01, ",": 0.02, ", ": 0.05}
#: The same for a comma in a field that has another delimiter as well.
JOIN_COMMA_BESIDE = 0.9

_DELIMITER = re.compile(r"\r\n|[\n\t;|；、，,]")
_WAY = "i int, j int, segment string, spans int, joins double, breaks double"
_FIELDS = f"field_name string, fid binary, n_atoms int, ways array<struct<{_WAY.replace(' int', ':int').replace(' string', ':string').replace(' double', ':double')}>>, values array<string>, long_values array<string>"
_CANDIDATES = f"field_name string, fid binary, n_atoms int, {_WAY}"


def structured(text: str) -> list[str] | None:
    """The values of a field written as a JSON array or a list literal; None if it is neither."""
    body = text.strip()
    for _ in range(3):
        if not body or body[0] not in "[\"'":
            return None
        value: object = None
        try:
            value = json.loads(body)
        except ValueError:
            if body[0] == "[" and body[-1] == "]":
                try:
                    value = ast.literal_eval(body)
                except (ValueError, SyntaxError, MemoryError, RecursionError):
                    return None
        if isinstance(value, list):
            return [str(v).strip() for v in value if v is not None and str(v).strip()]
        if not isinstance(value, str) or not value.strip().startswith("["):
            return None
        body = value.strip()
    return None


def atoms(text: str) -> tuple[list[tuple[str, bool]], list[str]]:
    """The atoms of a plain field with a mark for quoted ones, and the delimiters between them.

    A quote opens a span only at the start of a value and closes it only before a
    delimiter or the end; doubled quotes inside stand for one.
    """
    found: list[tuple[str, bool]] = []
    between: list[str] = []
    at, size = 0, len(text)
    while True:
        start = at
        while start < size and text[start] in "  　":
            start += 1
        quoted = re.compile(r'"((?:[^"]|"")*)"[  　]*(?=[\r\n\t;|；、，,]|\Z)').match(text, start) if start < size and text[start] == '"' else None
        if quoted:
            found.append((quoted[1].replace('""', '"').strip(), True))
            at = quoted.end()
        else:
            nxt = _DELIMITER.search(text, at)
            end = nxt.start() if nxt else size
            found.append((text[at:end], False))
            at = end
        if at >= size:
            return found, between
        mark = _DELIMITER.match(text, at)
        sign = mark.group()
        at = mark.end()
        if sign == "," and text[at : at + 1] == " ":
            sign = ", "
        between.append("\n" if sign == "\r\n" else sign)


class Lattice:
    """The atoms of a plain field and the spans of atoms that may be one value."""

    def __init__(self, text: str) -> None:
        self.parts, self.between = atoms(text)
        signs = [s.strip() or s for s in self.between]
        beside = any(s not in (",", "，") for s in signs)
        self.joins = [JOIN_COMMA_BESIDE if beside and s in (",", ", ", "，") else JOIN.get(s, 0.01) for s in self.between]

    def spans(self, i: int, longest: int) -> Iterator[tuple[int, int, str, int, float, float]]:
        """The segments (i, j, value, spans, log join, log break) from atom ``i`` on."""
        first, is_quoted = self.parts[i]
        text, log_join = first, 0.0
        for j in range(i + 1, min(len(self.parts), i + longest) + 1):
            if j > i + 1:
                if is_quoted or self.parts[j - 1][1] or not self.parts[j - 1][0].strip() or not first.strip():
                    return
                sign = self.between[j - 2]
                text += ("," if sign == ", " else sign) + self.parts[j - 1][0]
                log_join += math.log(self.joins[j - 2])
            log_break = math.log(1 - self.joins[j - 1]) if j <= len(self.between) else 0.0
            yield (i, j, text if is_quoted else text.strip(), j - i, log_join, log_break)

    def long_ways(self, i: int, values: list[str]) -> Iterator[tuple[int, int, str, int, float, float]]:
        """The spans from atom ``i`` on, longer than ``MAX_SPAN``, that read as one of the values."""
        most = max(len(atoms(v)[0]) for v in values)
        wanted = set(values)
        return (s for s in self.spans(i, most) if s[3] > MAX_SPAN and s[2] in wanted)


def lattice(text: str) -> tuple[int, list[tuple[int, int, str, int, float, float]]]:
    """Number of atoms and the candidate segments of up to ``MAX_SPAN`` atoms."""
    found = Lattice(text)
    return len(found.parts), [s for i in range(len(found.parts)) for s in found.spans(i, MAX_SPAN)]


def _long(values: list[str]) -> list[str]:
    return [v for v in values if len(v) > 2 * MAX_SPAN and len(atoms(v)[0]) > MAX_SPAN]


def head_of(value: str) -> str:
    """The first ``MAX_SPAN`` atoms of a value, as a span of a lattice reads."""
    return list(Lattice(value).spans(0, MAX_SPAN))[-1][2]


def _prepare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Distinct fields to their values, if they can be read in one way only, or to their candidate segments."""
    for batch in batches:
        rows = []
        for name, fid, field in zip(batch["field_name"], batch["fid"], batch["field"]):
            fixed = structured(field)
            if fixed is not None:
                rows.append((name, fid, len(fixed), None, fixed, _long(fixed)))
                continue
            size, segments = lattice(field)
            quoted = _long([text for text, is_quoted in atoms(field)[0] if is_quoted])
            if all(s[3] == 1 for s in segments):
                rows.append((name, fid, size, None, [s[2] for s in segments if s[2]], quoted))
            else:
                rows.append((name, fid, size, [dict(zip(_WAY_NAMES, s)) for s in segments], None, quoted))
        yield pd.DataFrame(rows, columns=["field_name", "fid", "n_atoms", "ways", "values", "long_values"])


_WAY_NAMES = [c.split()[0] for c in _WAY.split(", ")]
_NAMES = [c.split()[0] for c in _CANDIDATES.split(", ")]


def _log_score(segment: str, spans: int, joins: float, breaks: float, share: float) -> float:
    if not segment:
        return breaks
    base = BASE_ONE * BASE_MORE ** max(0, spans - 1)
    return math.log((1 - NEW_SHARE) * share + NEW_SHARE * base) + joins + breaks


def _add(a: float, b: float) -> float:
    if a == -math.inf:
        return b
    if b == -math.inf:
        return a
    return max(a, b) + math.log1p(math.exp(-abs(a - b)))


def posteriors(size: int, segments: list[tuple[int, int, float]]) -> list[float]:
    """Probability of each segment (i, j, log score) over all ways through the lattice."""
    ahead = [-math.inf] * (size + 1)
    behind = [-math.inf] * (size + 1)
    ahead[0] = behind[size] = 0.0
    for i, j, s in sorted(segments):
        ahead[j] = _add(ahead[j], ahead[i] + s)
    for i, j, s in sorted(segments, key=lambda x: -x[1]):
        behind[i] = _add(behind[i], behind[j] + s)
    whole = ahead[size]
    return [math.exp(min(0.0, ahead[i] + s + behind[j] - whole)) if whole > -math.inf else 0.0 for i, j, s in segments]


def best_way(size: int, segments: list[tuple[int, int, float]]) -> list[int]:
    """Indices of the segments on the likeliest way; ties go to the way of more segments."""
    best: list[tuple[float, int, int]] = [(-math.inf, 0, -1)] * (size + 1)
    best[0] = (0.0, 0, -1)
    for at in sorted(range(len(segments)), key=lambda k: segments[k][:2]):
        i, j, s = segments[at]
        option = (best[i][0] + s, best[i][1] + 1, at)
        if best[i][0] > -math.inf and option[:2] > best[j][:2]:
            best[j] = option
    way, at = [], size
    while at > 0 and best[at][2] >= 0:
        way.append(best[at][2])
        at = segments[best[at][2]][0]
    return way[::-1]


def _scored(batch: pd.DataFrame) -> Iterator[tuple[str, bytes, int, list, list[tuple[int, int, float]]]]:
    for name, fid, size, ways in zip(batch["field_name"], batch["fid"], batch["n_atoms"], batch["ways"]):
        ways = sorted(ways, key=lambda w: (w["i"], w["j"]))
        scores = [(w["i"], w["j"], _log_score(w["segment"], w["spans"], w["joins"], w["breaks"], w["share"])) for w in ways]
        yield name, fid, int(size), ways, scores


def _expect(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for name, fid, size, ways, scores in _scored(batch):
            for w, p in zip(ways, posteriors(size, scores)):
                rows.append((name, fid, size, w["i"], w["j"], w["segment"], w["spans"], w["joins"], w["breaks"], p, abs(p - w["weight"])))
        yield pd.DataFrame(rows, columns=[*_NAMES, "weight", "moved"])


def _decide(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for name, fid, size, ways, scores in _scored(batch):
            rows.append((name, fid, [ways[k]["segment"] for k in best_way(size, scores) if ways[k]["segment"]]))
        yield pd.DataFrame(rows, columns=["field_name", "fid", "values"])


def _weighed(candidates: DataFrame, known: DataFrame) -> DataFrame:
    """One row per field with its candidates and the share each has among all values but the field's own.

    ``known`` (field_name, segment, weight) are the counts of fields without a choice.
    """
    real = candidates.where("segment != ''").select("field_name", "segment", "weight").unionByName(known)
    counts = real.groupBy(F.col("field_name").alias("c_name"), F.col("segment").alias("c_segment")).agg(F.sum("weight").alias("count"))
    totals = real.groupBy(F.col("field_name").alias("t_name")).agg(F.sum("weight").alias("total"))
    own = candidates.join(counts, (F.col("field_name") == F.col("c_name")) & (F.col("segment") == F.col("c_segment")), "left")
    own = own.join(F.broadcast(totals), F.col("field_name") == F.col("t_name"), "left")  # one row per column of fields
    share = F.greatest(F.lit(0.0), F.coalesce("count", F.lit(0.0)) - F.col("weight")) / F.greatest(F.lit(1.0), F.coalesce("total", F.lit(0.0)))
    return (
        own.withColumn("share", share)
        .groupBy("field_name", "fid", "n_atoms")
        .agg(F.collect_list(F.struct("i", "j", "segment", "spans", "joins", "breaks", "share", "weight")).alias("ways"))
    )


def _long_candidates(read: DataFrame, candidates: DataFrame, fields: DataFrame) -> DataFrame | None:
    """Candidates longer than ``MAX_SPAN`` that read as a quoted value of the column; None without such values."""
    values = read.select("field_name", F.explode("long_values").alias("value")).distinct()
    if values.isEmpty():
        return None

    def heads(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"h_name": batch["field_name"], "head": batch["value"].map(head_of), "value": batch["value"]})

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for name, fid, size, i, field, found in zip(batch["field_name"], batch["fid"], batch["n_atoms"], batch["i"], batch["field"], batch["found"]):
                rows += [(name, fid, size, *way) for way in Lattice(field).long_ways(int(i), list(found))]
            yield pd.DataFrame(rows, columns=_NAMES)

    by_head = values.mapInPandas(heads, "h_name string, head string, value string")
    full = candidates.where(F.col("spans") == MAX_SPAN)
    met = full.join(by_head, (F.col("field_name") == F.col("h_name")) & (F.col("segment") == F.col("head")))
    met = met.groupBy("field_name", "fid", "n_atoms", "i").agg(F.collect_set("value").alias("found"))
    texts = fields.select(F.col("fid").alias("f_fid"), "field")
    return met.join(texts, F.col("fid") == F.col("f_fid")).mapInPandas(add, _CANDIDATES)


def _fid() -> Column:
    return F.unhex(F.md5(F.concat_ws("\u0001", "field_name", "field"))).alias("fid")


def segment_fields(fields: DataFrame, rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> DataFrame:
    """(field_name, fid, values) of each distinct field of ``fields(field_name, field)``."""
    distinct = fields.select("field_name", "field").where(F.col("field").isNotNull() & (F.col("field") != "")).distinct().withColumn("fid", _fid())
    read = materialise(distinct.mapInPandas(_prepare, _FIELDS), "packed")
    fixed = read.where("values is not null").select("field_name", "fid", "values")
    known = materialise(
        fixed.select("field_name", F.explode("values").alias("segment")).where("segment != ''").groupBy("field_name", "segment").agg(F.count("*").cast("double").alias("weight")), "known"
    )
    candidates = read.where("ways is not null").select("field_name", "fid", "n_atoms", F.explode("ways").alias("w")).select("field_name", "fid", "n_atoms", "w.*")
    longer = _long_candidates(read, candidates, distinct)
    if longer is not None:
        candidates = candidates.unionByName(longer)
    candidates = materialise(candidates.withColumn("weight", F.lit(0.0)), "packed0")
    for at in range(rounds):
        candidates = materialise(_weighed(candidates, known).mapInPandas(_expect, _CANDIDATES + ", weight double, moved double"), f"packed{at + 1}")
        moved, weight = candidates.agg(F.sum("moved"), F.sum("weight")).first()
        candidates = candidates.drop("moved")
        if not weight or moved <= tolerance * weight:
            break
    decided = _weighed(candidates, known).mapInPandas(_decide, "field_name string, fid binary, values array<string>")
    return fixed.unionByName(decided)


def unpack_fields(rows: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(id, field_name, value_no, packed_value) of every value of the named columns, once per key and field."""
    stack = [F.struct(F.lit(c).alias("field_name"), F.col(c).cast("string").alias("field")) for c in columns]
    long = rows.select(F.col(key).cast("string").alias("id"), F.explode(F.array(*stack)).alias("x")).select("id", "x.field_name", "x.field")
    long = long.where(F.col("field").isNotNull() & (F.col("field") != "")).distinct()
    ways = segment_fields(long).select(F.col("fid").alias("w_fid"), "values")
    return (
        long.select("id", "field_name", _fid())
        .join(ways, F.col("fid") == F.col("w_fid"))
        .select("id", "field_name", F.posexplode("values").alias("at", "packed_value"))
        .select("id", "field_name", (F.col("at") + 1).cast("int").alias("value_no"), "packed_value")
    )
