"""Subject areas of documents.

Method. Terms (words, and pairs of ideographs) are weighted by the ratio of their document
frequency in an area's labelled documents to the frequency outside the area, which
follows from their document frequency in the whole corpus.
Documents in term weights are reduced by truncated singular value decomposition; a
sentence is the sum of its terms' reduced vectors. Seed centroids are taken from
sentences of each area's labelled documents and refined iteratively by cosine similarity
(spherical k-means); a centroid speaks for the area of the documents that hold most of
its sentences. Every sentence of every document goes to its nearest centroid, and a
document has the areas that hold at least ``MIN_SHARE`` of its sentences.

Bounds. The classifier (weights' label side, decomposition, centroids) is fitted on at
most about ``MAX_LABELLED`` labelled documents, chosen by a hash of their id; document
frequencies and the assignment cover all documents. Its terms are all those that at least
``MIN_TERM_DOCUMENTS`` of these documents hold, so the sample bounds them too, and the
decomposition works on the sparse matrix itself, whatever their number. The model is
broadcast to the workers once.

Defined results: null, empty and blank texts, and texts without a weighted term, have no
area; labelled documents count as all others do; a repeated label counts once; without
labels no document has an area.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioloom.llm import charforms

MAX_LABELLED = 6000
#: Least documents of the sample that hold a term.
MIN_TERM_DOCUMENTS = 3
RANK = 160
SEEDS_PER_AREA = 8
ROUNDS = 12
#: Least frequency ratio and z-score of a term with weight, least weight of a sentence, least similarity and share.
MIN_LIFT, MIN_Z, MIN_WEIGHT, MIN_COSINE, MIN_SHARE = 2.5, 3.0, 1.0, 0.4, 0.17
#: Least share of a centroid's sentences whose document is labelled with the area it speaks for.
MIN_CENTROID_RATE = 0.5
NO_AREA = "none"

_SENTENCE = re.compile(r"[.!?。！？\n]+")
_WORD = re.compile(r"[^\W\d_]+")


class Terms(dict):
    """Blank-delimited piece of lower-case text -> its terms (or their numbers), kept while seen often."""

    LIMIT = 1 << 18

    def __init__(self, index: dict[str, int] | None = None) -> None:
        super().__init__()
        self.index = index

    def __missing__(self, piece: str) -> tuple:
        terms: list = []
        for word in _WORD.findall(charforms.fold(charforms.unescape(piece)).lower()):
            terms += [word] if word[0] < "⺀" else [word[i : i + 2] for i in range(max(1, len(word) - 1))]
        value = tuple(terms) if self.index is None else tuple(self.index[t] for t in terms if t in self.index)
        if len(self) >= self.LIMIT:
            self.clear()
        self[piece] = value
        return value


def sentences(text: str) -> list[list[str]]:
    """The sentences of a text as blank-delimited pieces; pieces without a letter make no sentence."""
    return [pieces for s in _SENTENCE.split(text.lower()) if (pieces := s.split()) and any(map(_WORD.search, pieces))]


def document_frequencies(documents: DataFrame, wanted: set[str] | None = None) -> DataFrame:
    """(term, documents) over all documents, counted map-side first; only of the wanted terms, if given."""
    index = documents.sparkSession.sparkContext.broadcast({t: t for t in wanted}) if wanted is not None else None

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache, seen = Terms(index.value if index else None), Counter()
        for batch in batches:
            for text in batch["text"]:
                seen.update(set().union(*map(cache.__getitem__, set(text.lower().split()))))
            if len(seen) > 300_000:
                yield pd.DataFrame(seen.items(), columns=["term", "documents"])
                seen.clear()
        yield pd.DataFrame(seen.items(), columns=["term", "documents"]).astype({"documents": "int64"})

    return documents.select("text").mapInPandas(count, "term string, documents long").groupBy("term").agg(F.sum("documents").alias("documents"))


@dataclass
class SubjectModel:
    """Weights, reduced term vectors and centroids with the area each speaks for."""

    areas: list[str] = field(default_factory=list)
    index: dict[str, int] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0, np.float32))
    vectors: np.ndarray = field(default_factory=lambda: np.zeros((0, 0), np.float32))
    centroids: np.ndarray = field(default_factory=lambda: np.zeros((0, 0), np.float32))
    speaks_for: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    def sentence_areas(self, rows: list[tuple[int, ...]]) -> np.ndarray:
        """Area number of each sentence of term numbers; -1 for none."""
        out = np.full(len(rows), -1, np.int64)
        able = [k for k, r in enumerate(rows) if r]
        if not able or not len(self.centroids):
            return out
        vectors, weight = _sums(self.vectors, self.weights, [rows[k] for k in able])
        scores = vectors @ self.centroids.T
        best = scores.argmax(1)
        good = (weight >= MIN_WEIGHT) & (scores[np.arange(len(best)), best] > MIN_COSINE)
        out[able] = np.where(good, self.speaks_for[best], -1)
        return out


class SentenceAreas(dict):
    """Term numbers of a sentence -> its area, kept while seen often; new ones are worked out together."""

    LIMIT = 1 << 18

    def __init__(self, model: SubjectModel) -> None:
        super().__init__()
        self.model = model

    def of(self, rows: list[tuple[int, ...]]) -> list[int]:
        if len(self) > self.LIMIT:
            self.clear()
        new = list({r for r in rows if r not in self})
        if new:
            self.update(zip(new, self.model.sentence_areas(new).tolist()))
        return [self[r] for r in rows]


def _sums(vectors: np.ndarray, weights: np.ndarray, rows: list) -> tuple[np.ndarray, np.ndarray]:
    """Unit sums of term vectors and sums of weights, of non-empty rows of term numbers; one pass for each place in a row."""
    sizes = np.fromiter(map(len, rows), np.int64, len(rows))
    flat = np.fromiter((t for r in rows for t in r), np.int64, int(sizes.sum()))
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    order = np.argsort(-sizes, kind="stable")
    sizes_down, starts_down = sizes[order], starts[order]
    summed, weight = vectors[flat[starts_down]], weights[flat[starts_down]]
    for place in range(1, int(sizes_down[0]) if len(rows) else 0):
        many = int(np.searchsorted(-sizes_down, -place, side="left"))  # rows with more than ``place`` terms
        terms = flat[starts_down[:many] + place]
        summed[:many] += vectors[terms]
        weight[:many] += weights[terms]
    back = np.empty_like(order)
    back[order] = np.arange(len(order))
    summed, weight = summed[back], weight[back]
    return summed / (np.linalg.norm(summed, axis=1, keepdims=True) + 1e-9), weight


def fit_subjects(texts: list[str], labels: list[set[str]], frequencies: dict[str, int], n_documents: int) -> SubjectModel:
    """The classifier of labelled texts; ``frequencies`` are document frequencies in the corpus."""
    areas = sorted({a for s in labels for a in s} - {NO_AREA})
    if not areas or not frequencies:
        return SubjectModel()
    cache = Terms({t: k for k, t in enumerate(sorted(frequencies))})
    split = [[[t for p in s for t in cache[p]] for s in sentences(text)] for text in texts]
    size = len(frequencies)
    wide = np.array([frequencies[t] for t in sorted(frequencies)], float) / max(1, n_documents)
    marks = np.array([[a in s for a in areas] for s in labels], float)
    together = np.zeros((size, len(areas)))
    for d, doc in enumerate(split):
        held = list({t for s in doc for t in s})
        together[held] += marks[d]
    held_by = marks.sum(0)
    share = np.minimum(0.9, held_by / max(1, len(marks)))
    expected = wide[:, None] * held_by[None, :]
    inside = (together + 0.5) / (held_by + 1)[None, :]
    outside = np.maximum(wide[:, None] - share[None, :] * inside, 0) / (1 - share)[None, :]
    lift = inside / (outside + 0.5 / (held_by + 1)[None, :])
    z = (together - expected) / np.sqrt(expected * np.maximum(0, 1 - wide[:, None]) + 0.5)
    of = lift.argmax(1)
    top = lift[np.arange(size), of]
    weight = np.where(z[np.arange(size), of] > MIN_Z, np.maximum(0, np.log(top) - math.log(MIN_LIFT)), 0)
    chosen = np.flatnonzero(weight > 0)
    if not len(chosen):
        return SubjectModel()
    place = {int(t): k for k, t in enumerate(chosen)}
    weights, area_of = weight[chosen].astype(np.float32), of[chosen]
    split = [[[place[t] for t in s if t in place] for s in doc] for doc in split]

    base = _subspace(_SparseRows(split, weights), min(RANK, len(chosen)))
    vectors = (base * weights[:, None]).astype(np.float32)

    rows, owner = [], []
    for d, doc in enumerate(split):
        for s in doc:
            if s and weights[s].sum() >= MIN_WEIGHT:
                rows.append(s)
                owner.append(d)
    if not rows:
        return SubjectModel()
    points, totals = _sums(vectors, weights, rows)
    marks = marks[owner]
    seeds = []
    for a in range(len(areas)):
        own = np.flatnonzero(marks[:, a] > 0)
        pure = [k for k in own if weights[[t for t in rows[k] if area_of[t] == a]].sum() > 0.6 * totals[k]]
        if not pure:
            continue
        here = points[pure]
        taken, far = [0], 1 - here @ here[0]
        while len(taken) < min(SEEDS_PER_AREA, len(pure)):
            taken.append(int(far.argmax()))
            far = np.minimum(far, 1 - here @ here[taken[-1]])
        seeds.append(here[taken])
    if not seeds:
        return SubjectModel()
    centroids = np.concatenate(seeds)
    for _ in range(ROUNDS):
        nearest = (points @ centroids.T).argmax(1)
        moved = centroids.copy()
        for k in np.unique(nearest):
            moved[k] = points[nearest == k].sum(0)
        centroids = moved / (np.linalg.norm(moved, axis=1, keepdims=True) + 1e-9)
    nearest = (points @ centroids.T).argmax(1)
    speaks_for = np.full(len(centroids), -1)
    for k in np.unique(nearest):
        rates = marks[nearest == k].mean(0)
        if rates.max() >= MIN_CENTROID_RATE:
            speaks_for[k] = rates.argmax()
    names = sorted(frequencies)
    return SubjectModel(areas, {names[t]: k for t, k in place.items()}, weights, vectors, centroids.astype(np.float32), speaks_for)


class _SparseRows:
    """Documents as unit rows of weighted terms, log(1 + count) * weight, with products from both sides."""

    CHUNK = 1 << 16

    def __init__(self, documents: list[list[list[int]]], weights: np.ndarray) -> None:
        rows, terms, values = [], [], []
        for d, doc in enumerate(documents):
            counts = Counter(t for s in doc for t in s)
            if counts:
                held = np.fromiter(counts, np.int64, len(counts))
                value = np.log1p(np.fromiter(counts.values(), np.float32, len(counts))) * weights[held]
                rows.append(np.full(len(held), d))
                terms.append(held)
                values.append(value / (np.linalg.norm(value) + 1e-9))
        empty = [np.zeros(0, np.int64)]
        self.rows, self.terms = np.concatenate(rows or empty), np.concatenate(terms or empty)
        self.values = np.concatenate(values or [np.zeros(0)]).astype(np.float32)
        self.shape = (len(documents), len(weights))
        self.by_term = np.argsort(self.terms, kind="stable")

    def _product(self, out_of: np.ndarray, into: np.ndarray, values: np.ndarray, right: np.ndarray, size: int) -> np.ndarray:
        """Sum of values * right[out_of] by ``into``, which is in order."""
        out = np.zeros((size, right.shape[1]), np.float32)
        for start in range(0, len(into), self.CHUNK):
            part = slice(start, start + self.CHUNK)
            keys, first = np.unique(into[part], return_index=True)
            out[keys] += np.add.reduceat(values[part, None] * right[out_of[part]], first, axis=0)
        return out

    def gram(self, right: np.ndarray) -> np.ndarray:
        """(transpose of the matrix) * matrix * right."""
        left = self._product(self.terms, self.rows, self.values, right, self.shape[0])
        order = self.by_term
        return self._product(self.rows[order], self.terms[order], self.values[order], left, self.shape[1])


def _subspace(matrix: _SparseRows, rank: int, rounds: int = 6) -> np.ndarray:
    """The leading right singular directions of a matrix by subspace iteration."""
    size = matrix.shape[1]
    basis = np.random.default_rng(11).standard_normal((size, min(size, rank + 16))).astype(np.float32)
    for _ in range(rounds):
        basis, _ = np.linalg.qr(matrix.gram(basis))
    values, turn = np.linalg.eigh(basis.T @ matrix.gram(basis))
    return basis @ turn[:, np.argsort(-values)[:rank]]


def train(documents: DataFrame, labels: DataFrame) -> SubjectModel:
    """Fits the classifier on a bounded sample of labelled documents and the whole corpus's frequencies."""
    held = documents.select(F.col("doc_id").alias("held_id"), "text").where("trim(text) != ''")
    per_document = labels.where("doc_id is not null and area is not null").groupBy("doc_id").agg(F.collect_set("area").alias("areas"))
    n_labelled = per_document.count()
    if n_labelled > MAX_LABELLED:
        per_document = per_document.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1_000_000 * MAX_LABELLED / n_labelled))
    # About MAX_LABELLED ids at most, so the join needs no shuffle of the texts.
    sample = held.join(F.broadcast(per_document), F.col("held_id") == F.col("doc_id")).select("doc_id", "text", "areas").dropDuplicates(["doc_id"]).orderBy("doc_id").toPandas()
    if sample.empty:
        return SubjectModel()
    texts, marks = sample["text"].tolist(), [set(a) for a in sample["areas"]]
    cache, seen = Terms(), Counter()
    for text in texts:
        seen.update(set().union(*map(cache.__getitem__, set(text.lower().split()))))
    wanted = {t for t, n in seen.items() if n >= MIN_TERM_DOCUMENTS}
    frequencies = document_frequencies(held, wanted).toPandas()  # of the sample's terms
    return fit_subjects(texts, marks, dict(zip(frequencies["term"], frequencies["documents"].astype(int))), held.count())


def assign(documents: DataFrame, model: SubjectModel) -> DataFrame:
    """(doc_id, area, share) of every document and area that holds enough of its sentences."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = shared.value
        cache, areas = Terms(model.index), SentenceAreas(model)
        for batch in batches:
            rows, owners = [], []
            counts = np.zeros(len(batch), np.int64)
            for d, text in enumerate(batch["text"]):
                split = sentences(text)
                counts[d] = len(split)
                for pieces in split:
                    terms = tuple(chain.from_iterable(map(cache.__getitem__, pieces)))
                    if terms:
                        rows.append(terms)
                        owners.append(d)
            held: Counter = Counter((d, a) for d, a in zip(owners, areas.of(rows)) if a >= 0)
            ids = batch["doc_id"].tolist()
            out = [(ids[d], model.areas[a], n / counts[d]) for (d, a), n in held.items() if n >= MIN_SHARE * counts[d]]
            yield pd.DataFrame(out, columns=["doc_id", "area", "share"])

    chosen = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("trim(text) != ''")
    return chosen.mapInPandas(run, "doc_id long, area string, share double")


def subject_areas(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, area, share) of every document by a classifier fitted on the labels."""
    return assign(documents, train(documents, labels))


def composition(assigned: DataFrame, areas: DataFrame) -> DataFrame:
    """(area, area_name, documents, weight): documents by area; a document of n areas weighs 1/n in each."""
    per = assigned.select("doc_id", "area").distinct()
    shares = per.groupBy(F.col("doc_id").alias("of_doc")).agg(F.count("*").alias("n"))
    weighed = per.join(shares, F.col("doc_id") == F.col("of_doc"))
    sums = weighed.groupBy(F.col("area").alias("of_area")).agg(F.count("*").alias("documents"), F.sum(F.lit(1.0) / F.col("n")).alias("weight"))
    return (
        areas.select("area", "area_name")
        .dropDuplicates(["area"])
        .join(sums, F.col("area") == F.col("of_area"), "left")
        .select("area", "area_name", F.coalesce("documents", F.lit(0)).alias("documents"), F.round(F.coalesce("weight", F.lit(0.0)), 6).alias("weight"))
    )
