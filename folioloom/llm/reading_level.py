"""Reading level of texts: Flesch score, CEFR level and difficulty.

Method. Features of the prose feed a ridge-regularised proportional-odds regression whose
cuts are calibrated to graded text: lexical diversity (type-token ratio by paragraph,
averaged by words), word rarity (share of words that few documents of the corpus hold),
connectives, commas and semicolons a sentence as a proxy for clause depth, and lengths of
sentences, words and text. The graded text is a bounded sample (``TRAIN_ROWS``) of
documents with a level noted elsewhere. Such grades are noisy: after a first fit those that
lie more than a level off are left out and the model is fitted again.

The level of a document is the model's. An exact check by the defined score follows where
the model is not sure: within ``BAND`` of a cut, measured in mean distances of
neighbouring cuts, the exact level holds. Without usable grades all levels are exact.

Word frequencies are counted over all documents in a pass of their own; the common words
that it sends on are bounded by ``COMMON_SHARE``. The features are sums over lines, taken
in the same pass that finds the keys of lines, so lines that the site repeats can be left
out after their support is known, without another pass over the texts.

Defined results: null and empty texts, and texts with less than ``MIN_WORDS`` words of
prose, have no level; a repeated row counts once; texts are read whole.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioloom.llm import boilerplate, charforms, markup
from folioloom.session import materialise

MIN_WORDS = 60
#: Most rows of graded text, about, that the regression is fitted on.
TRAIN_ROWS = 8000
#: Half width of the stretch round a cut in which the exact score decides.
BAND = 0.3
#: Least share of the documents that hold a common word; every other word is rare.
COMMON_SHARE = 0.05
LEVELS = ("A1", "A2", "B1", "B2", "C1", "C2")

# Abbreviations whose stop ends no sentence.
ABBREVIATIONS = ("Mr.", "Mrs.", "Ms.", "Dr.", "Prof.", "Sr.", "Jr.", "St.", "vs.", "etc.", "Vol.", "No.", "e.g.", "i.e.")
# Connectives that open or join clauses.
CONNECTIVES = frozenset((
    "and", "but", "or", "nor", "yet", "so", "because", "although", "though", "while", "whereas", "unless", "until", "since", "if", "when", "after",
    "before", "therefore", "however", "moreover", "meanwhile", "later", "presently", "once",
))

_BITS = 24
_ENDS = re.compile(r"[.!?]+")
_NOT_AZ = re.compile(r"[^a-z]+")
_VOWELS = re.compile(r"[aeiouy]+")
_ABBREVIATION = re.compile("|".join(r"(?<![A-Za-z])" + re.escape(a) for a in sorted(ABBREVIATIONS, key=len, reverse=True)))


def syllables(word: str) -> int:
    """Syllables of a word by the vowel-run rule."""
    w = _NOT_AZ.sub("", word.lower())
    if len(w) <= 2:
        return 1
    n = len(_VOWELS.findall(w))
    if w[-1] == "e" and n > 1:
        n -= 1
    if w.endswith("le") and w[-3] not in "aeiouy":
        n += 1
    if w.endswith("ed") and len(w) > 3 and w[-3] not in "td" and n > 1:
        n -= 1
    return max(n, 1)


class _LineEnds(dict):
    """Token -> how a line that ends with it closes: 0 look further back, 1 a sentence without a stop, 2 nothing to add."""

    def __missing__(self, token: str) -> int:
        pieces = _ENDS.split(_ABBREVIATION.sub("", token))
        stops = len(_ENDS.split(_ABBREVIATION.sub(lambda m: m[0].replace(".", ""), token))) > 1
        if stops:
            value = 1 if re.search(r"\w", pieces[-1]) else 2
        else:
            value = 1 if re.search(r"\w", token) else 0
        if len(self) >= TokenCounts.LIMIT:
            self.clear()
        self[token] = value
        return value


class TokenCounts(dict):
    """Blank-delimited token -> its counts packed into one integer.

    Fields from the low end: words, syllables, sentence ends, connectives, commas, rare
    words, each of ``_BITS`` bits.
    """

    LIMIT = 1 << 18

    def __init__(self, common: frozenset[str] = frozenset()) -> None:
        super().__init__()
        self.common = common
        self.ends = _LineEnds()

    def __missing__(self, token: str) -> int:
        letters = bool(_LETTER.search(token))
        plain = _ABBREVIATION.sub(lambda m: m[0].replace(".", ""), token) if "." in token else token
        bare = bare_word(token)
        value = (
            letters
            | (syllables(token) if letters else 0) << _BITS
            | (len(_ENDS.split(plain)) - 1) << 2 * _BITS
            | (bare in CONNECTIVES) << 3 * _BITS
            | (token.count(",") + token.count(";")) << 4 * _BITS
            | (letters and bare not in self.common) << 5 * _BITS
        )
        if len(self) >= self.LIMIT:
            self.clear()
        self[token] = value
        return value


_MASK = (1 << _BITS) - 1
_LETTER = re.compile("[A-Za-z]")
_EDGES = re.compile(r"^[^a-z]+|[^a-z]+$")


def bare_word(token: str) -> str:
    """A token in lower case without what is no letter at its ends."""
    return _EDGES.sub("", token.lower())


def line_counts(line: str, counts: TokenCounts) -> tuple[int, int, int, int, int, int, int]:
    """(words, syllables, sentences, connectives, commas, rare words, types) of one line of prose."""
    tokens = line.split()
    if not tokens:
        return (0, 0, 0, 0, 0, 0, 0)
    total = sum(map(counts.__getitem__, tokens))
    sentences = total >> 2 * _BITS & _MASK
    for token in reversed(tokens):
        close = counts.ends[token]
        if close:
            sentences += close == 1
            break
    types = len(set(line.lower().split()))
    return (total & _MASK, total >> _BITS & _MASK, sentences, total >> 3 * _BITS & _MASK, total >> 4 * _BITS & _MASK, total >> 5 * _BITS & _MASK, types)


SUMS = ("words", "syllables", "sentences", "connectives", "commas", "rare_words", "types")


def prose_rows(text: str, keys: list, counts: TokenCounts) -> list[tuple]:
    """(line key or 0, counts...) of each line of prose of a text."""
    _, lines = markup.split_blocks(text)
    rows = []
    for key, line in zip(keys, lines):
        if line:
            found = line_counts(charforms.fold(markup.clean_inline(line)), counts)
            if any(found):
                rows.append((key or 0, *found))
    return rows


_BETWEEN = bytes(i if i > 127 or chr(i).isalpha() or chr(i) in "'-" else 32 for i in range(256))


def distinct_words(text: str) -> set[bytes]:
    """The distinct words of a text with its markup in lower case, as bytes."""
    low = text.lower()
    if not low.isascii():
        for sign in "“”—…":
            low = low.replace(sign, " ")
    return set(low.encode("utf-8", "surrogatepass").translate(_BETWEEN).split())


def common_words(documents: DataFrame, min_share: float = COMMON_SHARE) -> frozenset[str]:
    """The words that at least ``min_share`` of all documents (id, text) hold.

    There can be at most (mean distinct words of a document) / ``min_share`` of them.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()

        def held() -> pa.RecordBatch:
            words: Counter[str] = Counter()
            for word, n in seen.items():
                words[bare_word(word.decode("utf-8", "surrogatepass"))] += n
            seen.clear()
            return pa.RecordBatch.from_arrays([pa.array(list(words), pa.string()), pa.array(list(words.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                seen.update(distinct_words(text))
            if len(seen) > 300_000:
                yield held()
        yield held()

    texts = documents.select("text").where(F.col("text").isNotNull())
    many = texts.count()
    counted = texts.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return frozenset(r.word for r in counted.where((F.col("n") >= F.lit(min_share) * F.lit(many)) & (F.col("word") != "")).select("word").collect())


def prose_features(documents: DataFrame) -> DataFrame:
    """(id, words, syllables, sentences, connectives, commas, rare_words, types) of each document's prose.

    ``types`` sums the distinct words of each line.
    """
    common = documents.sparkSession.sparkContext.broadcast(common_words(documents))

    def counter() -> boilerplate.Extra:
        counts = TokenCounts(common.value)
        return lambda text, keys: prose_rows(text, keys, counts)

    scan = boilerplate.scan_lines(documents, counter, ("prose_keys", *SUMS))
    nodes = boilerplate.frequent_nodes(scan).where("not is_title")
    by_site = materialise(nodes.groupBy(F.col("site").alias("n_site")).agg(F.collect_set("key").alias("site_keys")), "sites")
    prose = scan.where(F.size("prose_keys") > 0).select("site", "id", "prose_keys", *SUMS)
    joined = prose.join(by_site, F.col("site") == F.col("n_site"), "left")
    stays = F.transform("prose_keys", lambda k: F.when((k != 0) & F.array_contains("site_keys", k), F.lit(0)).otherwise(F.lit(1)))
    marked = joined.withColumn("stays", F.when(F.col("site_keys").isNotNull(), stays))
    added = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda acc, n: acc + n)
    left = lambda c: F.when(F.col("stays").isNull(), added(F.col(c))).otherwise(added(F.zip_with(c, "stays", lambda n, k: n * k)))
    return marked.select("id", *[left(c).alias(c) for c in SUMS])


def level_of(score: Column) -> Column:
    """The level of a score."""
    level = F.when(score >= 90, "A1")
    for least, name in ((80, "A2"), (60, "B1"), (50, "B2"), (30, "C1")):
        level = level.when(score >= least, name)
    return level.otherwise("C2")


def with_score(features: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The defined score: flesch_score, cefr_level and difficulty_score of prose with enough words."""
    raw = F.lit(206.835) - F.lit(1.015) * (F.col("words") / F.col("sentences")) - F.lit(84.6) * (F.col("syllables") / F.col("words"))
    score = F.greatest(F.lit(0.0), F.least(F.lit(100.0), F.floor(raw * 10 + F.lit(0.5)) / 10))
    return (
        features.where((F.col("words") >= min_words) & (F.col("sentences") > 0))
        .withColumn("flesch_score", score)
        .withColumn("cefr_level", level_of(F.col("flesch_score")))
        .withColumn("difficulty_score", F.round(F.lit(100.0) - F.col("flesch_score"), 1))
    )


FEATURES = ("sentence_length", "word_syllables", "diversity", "rarity", "connective_share", "clause_depth", "log_length")


def _feature_columns() -> list[Column]:
    w, s = F.col("words").cast("double"), F.col("sentences").cast("double")
    return [
        (w / s).alias("sentence_length"),
        (F.col("syllables") / w).alias("word_syllables"),
        (F.col("types") / w).alias("diversity"),
        (F.col("rare_words") / w).alias("rarity"),
        (F.col("connectives") / w).alias("connective_share"),
        (F.col("commas") / s).alias("clause_depth"),
        F.log(w).alias("log_length"),
    ]


def fit_ordinal(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, rounds: int = 400, rate: float = 0.5) -> dict:
    """A ridge-regularised proportional-odds model: P(level <= k) = sigmoid(cut_k - w.x)."""
    mean, scale = x.mean(0), x.std(0) + 1e-9
    z = (x - mean) / scale
    classes = len(LEVELS)
    weight = np.zeros(z.shape[1])
    cuts = np.linspace(-2, 2, classes - 1)
    m_w, v_w, m_c, v_c = np.zeros_like(weight), np.zeros_like(weight), np.zeros_like(cuts), np.zeros_like(cuts)
    above = (y[:, None] > np.arange(classes - 1)[None, :]).astype(float)
    for step in range(1, rounds + 1):
        odds = 1 / (1 + np.exp(-(z @ weight[:, None] - cuts[None, :])))
        error = odds - above
        g_w = (error.sum(1)[:, None] * z).mean(0) + ridge * weight
        g_c = -error.mean(0)
        for value, grad, m, v in ((weight, g_w, m_w, v_w), (cuts, g_c, m_c, v_c)):
            m[:] = 0.9 * m + 0.1 * grad
            v[:] = 0.999 * v + 0.001 * grad * grad
            value -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        cuts.sort()
    return {"mean": mean.tolist(), "scale": scale.tolist(), "weight": weight.tolist(), "cuts": cuts.tolist()}


def fit_levels(scored: DataFrame, grades: DataFrame, rows: int = TRAIN_ROWS) -> dict:
    """The model fitted on about ``rows`` of the graded documents, chosen by a hash of their id (a bounded sample).

    ``grades`` has columns id and level. Grades more than a level away from the first fit
    are taken as wrong and left out of the second.
    """
    known = grades.where(F.col("level").isin(*LEVELS)).groupBy(F.col("id").cast("string").alias("g_id")).agg(F.min("level").alias("level"))
    many = known.count()
    drawn = known.where(F.pmod(F.xxhash64("g_id"), F.lit(1_000_000)) < int(1_000_000 * rows / many)) if many > rows else known
    sample = scored.join(drawn, F.col("id") == F.col("g_id")).select(*_feature_columns(), "level").orderBy(*FEATURES, "level").toPandas()
    if sample["level"].nunique() < 2:
        return {}
    x, y = sample[list(FEATURES)].to_numpy(float), sample["level"].map(LEVELS.index).to_numpy()
    model = fit_ordinal(x, y)
    near = np.abs(model_levels(x, model) - y) <= 1
    return fit_ordinal(x[near], y[near])


def model_levels(x: np.ndarray, model: dict) -> np.ndarray:
    """Level numbers of rows of features."""
    score = (x - np.array(model["mean"])) / np.array(model["scale"]) @ np.array(model["weight"])
    return np.searchsorted(np.array(model["cuts"]), score)


def predict_levels(scored: DataFrame, model: dict) -> DataFrame:
    """Adds ``model_score`` (position on the ordinal scale), ``model_level`` and ``near_cut``, whether the exact check applies."""
    if not model:
        return scored.select("*", F.lit(None).cast("double").alias("model_score"), F.lit(None).cast("string").alias("model_level"), F.lit(True).alias("near_cut"))
    terms = [(c - F.lit(m)) / F.lit(s) * F.lit(w) for c, m, s, w in zip(_feature_columns(), model["mean"], model["scale"], model["weight"])]
    out = scored.withColumn("model_score", sum(terms[1:], terms[0]))
    level = F.lit(LEVELS[0])
    for cut, name in zip(model["cuts"], LEVELS[1:]):
        level = F.when(F.col("model_score") > F.lit(cut), F.lit(name)).otherwise(level)
    reach = BAND * (model["cuts"][-1] - model["cuts"][0]) / (len(model["cuts"]) - 1)
    near = [F.abs(F.col("model_score") - F.lit(cut)) <= F.lit(reach) for cut in model["cuts"]]
    return out.withColumn("model_level", level).withColumn("near_cut", reduce(or_, near))


def reading_levels(documents: DataFrame, grades: DataFrame) -> DataFrame:
    """One row per document with enough prose: ``cefr_level`` is the model's level, near a cut the exact one (``exact_level``)."""
    scored = materialise(with_score(prose_features(documents)).withColumnRenamed("cefr_level", "exact_level"), "levels")
    judged = predict_levels(scored, fit_levels(scored, grades))
    return judged.withColumn("cefr_level", F.when(F.col("near_cut"), F.col("exact_level")).otherwise(F.col("model_level")))


def agreeing_grades(results: DataFrame) -> DataFrame:
    """(id, level) of stored results (chapter_id, flesch_score, cefr_level, difficulty_score) that agree with themselves."""
    stored = results.select("chapter_id", "flesch_score", F.col("cefr_level").alias("stored_level"), "difficulty_score").where("chapter_id is not null and flesch_score between 0 and 100")
    same = (level_of(F.col("flesch_score")) == F.col("stored_level")) & (F.abs(F.lit(100.0) - F.col("flesch_score") - F.col("difficulty_score")) < 0.051)
    return stored.where(same).select(F.col("chapter_id").alias("id"), F.col("stored_level").alias("level"))
