"""p4: reading levels."""

import random

import numpy as np
import pytest

from folioloom.llm import reading_level as R

SCHEMA = "site string, id string, title string, text string, words int, site_keys string"


@pytest.mark.parametrize(
    "word, n", [("the", 1), ("table", 2), ("jumped", 1), ("wanted", 2), ("people", 2), ("queue", 1), ("rhythm", 1), ("created", 2), ("beautiful", 3), ("free", 1), ("a", 1), ("quietly", 2), ("Évequist", 2)]
)
def test_syllables(word, n):
    assert R.syllables(word) == n


def test_line_counts():
    counts = R.TokenCounts(frozenset({"the", "is", "here", "no", "mr"}))
    # words, syllables, sentences, connectives, commas, rare words, types
    assert R.line_counts("The cat sat. Mr. Smith jumped! No. 5 is here", counts) == (9, 9, 3, 0, 0, 4, 10)
    assert R.line_counts("“Stop!” he cried.”", counts)[:3] == (3, 3, 2)
    assert R.line_counts("12 – 13", counts) == (0, 0, 1, 0, 0, 0, 3)
    assert R.line_counts("", counts) == (0, 0, 0, 0, 0, 0, 0)
    assert R.line_counts("and so, the sea", counts)[3:] == (2, 1, 3, 4)


def test_common_words_of_all_documents(spark):
    df = spark.createDataFrame([(f"d{i}", "The sea. “The” SEA" + (" lantern" if i == 3 else "")) for i in range(30)] + [("n", None)], "id string, text string")
    assert R.common_words(df, 0.05) == {"the", "sea"}
    assert R.common_words(df.limit(0)) == frozenset()


def prose(rng, hard, n=12):
    easy = "the cat sat on a mat by the old door".split()
    long = "administration considerable philosophical resignation notwithstanding recommendation".split()
    return "\n".join("<p>" + " ".join(rng.choice(long if rng.random() < hard else easy) for _ in range(12)) + ".</p>" for _ in range(n))


def brute(text):
    import re

    w = s = y = 0
    for line in re.findall("<p>(.*?)</p>", text):
        for sentence in re.split(r"[.!?]+", line):
            words = sentence.split()
            w, s, y = w + len(words), s + bool(words), y + sum(map(R.syllables, words))
    f = max(0.0, min(100.0, int((206.835 - 1.015 * w / s - 84.6 * y / w) * 10 + 0.5) / 10)) if 206.835 - 1.015 * w / s - 84.6 * y / w > 0 else 0.0
    return next(name for least, name in ((90, "A1"), (80, "A2"), (60, "B1"), (50, "B2"), (30, "C1"), (-1, "C2")) if f >= least)


def graded(spark, n=400):
    """Prose of rising difficulty with grades of which every fifth is wrong."""
    rng = random.Random(3)
    texts = {f"c{i}": prose(rng, 0.3 * i / n, 30) for i in range(n)}
    exact = {k: brute(t) for k, t in texts.items()}
    noisy = [(k, v if i % 5 else rng.choice(R.LEVELS)) for i, (k, v) in enumerate(exact.items())]
    grades = lambda shift=0: spark.createDataFrame([(k, R.LEVELS[min(5, R.LEVELS.index(v) + shift)]) for k, v in noisy] + [("c0", "?"), ("c1", None)], "id string, level string")
    rows = [("s", k, None, t, 1, "x") for k, t in texts.items()]
    rows += [("s", "c0", None, texts["c0"], 1, "x"), ("s", "null", None, None, 1, "x"), ("s", "empty", "", "", 1, "x"), ("s", "short", None, "<p>Too short.</p>", 1, "x"), (None, "nosite", None, texts["c5"], None, None)]
    return spark.createDataFrame(rows, SCHEMA), grades, exact | {"nosite": brute(texts["c5"])}


def test_levels_come_from_the_model_with_an_exact_check_near_the_cuts(spark):
    df, grades, exact = graded(spark)
    got = {r.id: r for r in R.reading_levels(df, grades()).collect()}
    assert set(got) == set(exact)
    assert np.mean([r.model_level == exact[k] for k, r in got.items()]) > 0.9
    assert np.mean([r.cefr_level == exact[k] for k, r in got.items()]) > 0.98
    assert all(r.cefr_level == (r.exact_level if r.near_cut else r.model_level) and r.exact_level == exact[k] for k, r in got.items())
    assert 0.1 < np.mean([r.near_cut for r in got.values()]) < 0.6
    # A model fitted on grades one level off gives other levels: the rows come from the model.
    moved = R.reading_levels(df, grades(1)).collect()
    assert np.mean([r.cefr_level != exact[r.id] for r in moved]) > 0.3


def test_without_grades_the_exact_levels_hold(spark):
    df, grades, exact = graded(spark, 30)
    got = {r.id: (r.cefr_level, r.model_level) for r in R.reading_levels(df, grades().limit(0)).collect()}
    assert got == {k: (v, None) for k, v in exact.items()}


def test_grades_that_agree_with_themselves(spark):
    rows = [("a", 95.0, "A1", 5.0), ("b", 95.0, "A2", 5.0), ("c", 95.0, "A1", 50.0), ("d", None, "A1", 5.0), (None, 95.0, "A1", 5.0), ("e", 29.9, "C2", 70.1), ("f", 50.0, None, 50.0)]
    df = spark.createDataFrame(rows, "chapter_id string, flesch_score double, cefr_level string, difficulty_score double")
    assert {(r.id, r.level) for r in R.agreeing_grades(df).collect()} == {("a", "A1"), ("e", "C2")}


def test_structure_does_not_count(spark):
    rng = random.Random(4)
    plain = prose(rng, 0.2)
    marked = "## Considerable Philosophical Resignation\n- administration recommendation\n```\nadministration\n```\n$$x^2$$\n" + plain
    df = spark.createDataFrame([("s", "a", None, plain, 1, "x"), ("s", "b", None, marked, 1, "x")], SCHEMA)
    features = {r.id: (r.words, r.sentences, r.syllables) for r in R.prose_features(df).collect()}
    assert features["a"] == features["b"]
    assert R.reading_levels(df.limit(0), spark.createDataFrame([], "id string, level string")).count() == 0


def test_ordinal_fit_orders_levels():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 7))
    y = np.clip(np.floor(x[:, 0] * 1.5 + 3), 0, 5).astype(int)
    m = R.fit_ordinal(x, y)
    score = ((x - m["mean"]) / m["scale"]) @ np.array(m["weight"])
    assert np.corrcoef(score, x[:, 0])[0, 1] > 0.99 and m["cuts"] == sorted(m["cuts"])
