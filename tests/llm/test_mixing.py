"""p9: shares of sources."""

import pytest

from folioloom.llm import mixing as M

DOCS = "doc_id long, text string, source string, repeats int"
AIMS = "source string, target_share double, max_repeats int"


def test_plan_reaches_targets_within_caps():
    tokens, target, caps = {"a": 1000, "b": 300, "c": 50}, {"a": 0.5, "b": 0.3, "c": 0.2}, {"a": 1, "b": 2, "c": 4}
    b = M.plan(tokens, target, caps)
    total = sum(b.values())
    assert all(abs(b[s] / total - target[s]) < 1e-9 for s in b) and all(b[s] <= tokens[s] * caps[s] + 1e-6 for s in b)
    more = M.plan(tokens, target, caps, total=1500)
    assert abs(sum(more.values()) - 1500) < 1 and all(more[s] <= tokens[s] * caps[s] + 1e-6 for s in more)
    assert M.plan({}, target, caps) == {"a": 0.0, "b": 0.0, "c": 0.0}


def test_entropy_weights():
    natural = {"a": 0.7, "b": 0.2, "c": 0.1}
    for aim in (0.9, 1.0, 1.08):
        assert abs(M.entropy(M.entropy_weights(natural, aim)) - aim) < 1e-6


@pytest.fixture(scope="module")
def mixed_tables(spark):
    rows = []
    for i in range(900):
        source = "hot" if i % 3 else ("cold" if i % 2 else " COLD ")
        rows.append((i, f"text {i} " + "word " * (i % 17 + 3), source, 5))
    rows += [(2000 + i, f"text {i} " + "word " * (i % 17 + 3), "hot", 5) for i in range(1, 60, 3)]  # copies
    rows += [(3000, None, "hot", 5), (3001, "  ", "cold", 5), (3002, "other", "other", 5), (3003, "x", None, 5)]
    return spark.createDataFrame(rows, DOCS), spark.createDataFrame([("hot", 0.3, 1), ("cold", 0.7, 3), ("gone", 0.0, 2)], AIMS)


def test_mix(spark, mixed_tables):
    docs, aims = mixed_tables
    got = M.mix(docs, aims).collect()
    caps = {"hot": 1, "cold": 3}
    by_text, texts = {}, {r.doc_id: r.text for r in docs.collect()}
    for r in got:
        by_text[texts[r.doc_id]] = by_text.get(texts[r.doc_id], 0) + r.repeats
        assert 1 <= r.repeats <= caps[r.source]
    assert max(by_text.values()) <= 3 and len(by_text) == len(got)
    shares = {r.source: r for r in M.reached_shares(M.mix(docs, aims), aims).collect()}
    assert abs(shares["hot"].reached_share - 0.3) < 0.001 and abs(shares["cold"].reached_share - 0.7) < 0.001 and shares["gone"].tokens == 0


def test_empty(spark, mixed_tables):
    docs, aims = mixed_tables
    assert M.mix(docs.limit(0), aims).count() == 0 and M.mix(docs, aims.limit(0)).count() == 0


def reached(mixed):
    return {r.source: r.reached_share for r in mixed.collect()}


def test_a_total_beyond_reach_bisects_the_exponent(spark, mixed_tables, monkeypatch):
    docs, _ = mixed_tables
    aims = spark.createDataFrame([("hot", 0.2, 1), ("cold", 0.8, 1)], AIMS)
    exact, more = reached(M.mix(docs, aims)), reached(M.mix(docs, aims, stretch=1.4))
    assert abs(exact["cold"] - 0.8) < 0.002 and 0.3 < more["cold"] < 0.6
    assert max(r.repeats for r in M.mix(docs, aims, stretch=1.4).collect()) == 1
    monkeypatch.setattr(M, "bisect_exponent", lambda fits, low=0.0, high=1.0, rounds=60: high)
    assert abs(reached(M.mix(docs, aims, stretch=1.4))["cold"] - more["cold"]) > 0.01


def test_a_target_entropy(spark, mixed_tables):
    docs, aims = mixed_tables
    for aim in (0.4, 0.6):
        shares = reached(M.mix(docs, aims, target_entropy=aim))
        assert abs(M.entropy(shares) - aim) < 0.01 and shares["hot"] > shares["cold"]


def test_copies_and_blocks(spark, mixed_tables, monkeypatch):
    docs, aims = mixed_tables
    used = {r.doc_id for r in M.mix(docs, aims).collect()}
    assert not any(2000 <= i < 2100 for i in used)  # the least id of equal texts
    again = docs.unionByName(docs.where("doc_id < 50"))
    assert {r.doc_id for r in M.mix(again, aims).collect()} == used
    monkeypatch.setattr(M, "BLOCK_TEXTS", 16)
    shares = reached(M.mix(docs, aims))
    assert abs(shares["hot"] - 0.3) < 0.001
