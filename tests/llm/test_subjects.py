"""p10: subject areas, by held-out accuracy on made-up texts."""

import random

import numpy as np

from folioloom.llm import subjects as S

DOCS = "doc_id long, text string, area string"
VOCABULARY = {"sea": "mast rudder anchor keel hawser buoy".split(), "mus": "sonata aria libretto cadenza chord tenor".split(), "law": "verdict plaintiff lien notary statute deed".split(), "zh": []}
COMMON = "the old river found a grey stone under every narrow window while some quiet teacher kept his lamp near it".split()


def make(rng, areas, n=20):
    out = []
    for _ in range(n):
        area = rng.choice(areas) if areas and rng.random() < 0.6 else None
        words = [rng.choice(COMMON) for _ in range(8)]
        if area:
            for k in rng.sample(range(8), 2):
                words[k] = rng.choice(VOCABULARY[area])
        out.append(" ".join(words).capitalize() + ".")
    return " ".join(out)


def corpus(seed=1, n=400):
    rng = random.Random(seed)
    docs, truth = [], {}
    for i in range(n):
        areas = rng.sample(["sea", "mus", "law"], rng.choice((0, 1, 1, 2)))
        text = make(rng, areas)
        docs.append((i, text, "clash"))
        truth[i] = {a for a in areas if sum(any(w in s for w in VOCABULARY[a]) for s in text.split(".")) >= 4}
    return docs, truth


def test_held_out_accuracy(spark):
    docs, truth = corpus()
    labels = [(i, a, "x") for i, s in truth.items() if i % 4 == 0 for a in (s or {"none"})] + [(0, "law", "wrong"), (None, "sea", "x"), (4, None, "x")]
    extra = [(1000, None, "c"), (1001, "", "c"), (1002, " \n ", "c"), (1003, docs[1][1], "c"), (1, docs[1][1], "clash")]
    d = spark.createDataFrame(docs + extra, DOCS)
    found = S.subject_areas(d, spark.createDataFrame(labels, "doc_id long, area string, labeller string"))
    got: dict = {}
    for r in found.select("doc_id", "area").distinct().collect():
        got.setdefault(r.doc_id, set()).add(r.area)
    wrong = sum(got.get(i, set()) != s for i, s in truth.items() if i % 4)
    assert wrong < 20 and not {1000, 1001, 1002} & set(got) and got.get(1003) == got.get(1)
    areas = spark.createDataFrame([("sea", "Sea", "g"), ("sea", "Sea", "g"), ("none_such", "N", "g")], "area string, area_name string, gloss string")
    table = {r.area: (r.documents, r.weight) for r in S.composition(found, areas).collect()}
    assert table["none_such"] == (0, 0.0) and table["sea"][0] == sum("sea" in s for s in got.values())


def test_empty(spark):
    docs = spark.createDataFrame([(1, "Some text.", "x")], DOCS)
    labels = spark.createDataFrame([], "doc_id long, area string, labeller string")
    assert S.subject_areas(docs, labels).count() == 0
    assert S.subject_areas(docs.limit(0), spark.createDataFrame([(1, "sea", "x")], "doc_id long, area string, labeller string")).count() == 0


def test_frequencies(spark):
    df = spark.createDataFrame([("A fox, a FOX.",), ("the fox",), ("古井灯火",)], "text string")
    assert {r.term: r.documents for r in S.document_frequencies(df).collect()} == {"a": 1, "fox": 2, "the": 1, "古井": 1, "井灯": 1, "灯火": 1}


def test_only_wanted_terms_are_counted(spark):
    df = spark.createDataFrame([("A fox, a FOX.",), ("the fox",), (" ",)], "text string")
    assert {r.term: r.documents for r in S.document_frequencies(df, {"fox", "gone"}).collect()} == {"fox": 2}


def test_the_sparse_decomposition_equals_the_dense_one():
    rng = np.random.default_rng(5)
    docs = [[rng.integers(0, 40, rng.integers(0, 9)).tolist() for _ in range(rng.integers(0, 5))] for _ in range(70)]
    weights = rng.random(40).astype(np.float32) + 0.1
    dense = np.zeros((70, 40))
    for d, doc in enumerate(docs):
        for s in doc:
            np.add.at(dense[d], s, 1)
    dense = np.log1p(dense) * weights
    dense /= np.linalg.norm(dense, axis=1, keepdims=True) + 1e-9
    matrix = S._SparseRows(docs, weights)
    matrix.CHUNK = 64
    right = rng.standard_normal((40, 6)).astype(np.float32)
    assert np.allclose(matrix.gram(right), dense.T @ (dense @ right), atol=1e-3)
    base = S._subspace(matrix, 5, rounds=40)
    values = np.linalg.svd(dense, compute_uv=False)[:5]
    assert np.allclose(np.linalg.norm(dense @ base, axis=0), values, rtol=1e-2)
    assert S._SparseRows([[], [[]]], weights).gram(right).sum() == 0
