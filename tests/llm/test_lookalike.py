"""p1: one form for texts that look the same."""

import itertools

from folioloom.llm import charforms, lookalike

SCHEMA = "part string, id string, text string, variant string, key string"


def frame(spark, texts):
    return spark.createDataFrame([("t", i, t, "clash", "clash") for i, t in texts], SCHEMA)


def pairs(spark, texts):
    return {tuple(r) for r in lookalike.lookalike_pairs(lookalike.lookalike_keys(frame(spark, texts))).collect()}


def test_fold():
    assert charforms.fold("Τһe ｆox ﬁﬆ") == "The fox fist"
    assert charforms.fold("a b​c­") == "a bc"
    assert charforms.fold("⼈⻋，Ａ") == "人车，A"
    assert charforms.fold("N\u043e\u0451lle Br\u04e7sby N\u0435\u0308") == charforms.fold_token("N\u043e\u0451lle Br\u04e7sby N\u0435\u0308") == "No\u00eblle Br\u00f6sby N\u00eb"
    assert charforms.fold("café") == "café" != charforms.fold("cafe")
    assert charforms.fold("plain “text”") == "plain “text”"


def test_trie_prefers_least_cost_then_frequency():
    trie = lookalike.LookalikeTrie(max_cost=1.0)
    for word, n in (("Москва", 9), ("the", 5), ("tho", 50)):
        trie.add(word, n)
    assert trie.canonical("tһe") == "the"
    assert trie.canonical("Mосква") == "Москва"  # a native spelling wins over the table
    assert trie.canonical("zzzz") is None
    assert {s for _, _, s in trie.search("thx")} == {"the", "tho"}
    assert lookalike.LookalikeTrie().canonical("the") is None


def test_pairs(spark):
    texts = [
        ("a", "<p>The same café</p>"), ("b", "<p>Thе ѕame café</p>"), ("c", "<p>T&#104;e same ｃafé</p>"), ("d", "<p>The same cafe</p>"),
        ("e", "<p>the same café</p>"), ("f", "<p>The same café</p>\n"), ("g", "<p>The same café</p>"), ("g", "<p>The same café</p>"), ("h", None), ("i", ""), ("j", None), ("k", ""),
        ("l", "<p>The same café</p>"),
    ]
    same = ["a", "b", "c", "g", "l"]
    wanted = {p for p in itertools.combinations(same, 2)} - {("a", "g"), ("a", "l"), ("g", "l")}  # equal strings are no pair
    assert pairs(spark, texts) == wanted


def test_brute_force(spark):
    import random

    rng = random.Random(1)
    words = "river lantern stone cabin 古井 灯火 café".split()
    swaps = {"r": "r", "i": "і", "e": "е", "o": "ο", "a": "ａ", "灯": "灯", "s": "ѕ"}
    texts = []
    for n in range(60):
        base = " ".join(rng.choice(words) for _ in range(3))
        texts.append((f"x{n:03}", "".join(swaps.get(ch, ch) if rng.random() < 0.3 else ch for ch in base)))
    by = {}
    for i, t in texts:
        by.setdefault(charforms.fold(t), []).append((i, t))
    wanted = {(a, b) for v in by.values() for (a, x), (b, y) in itertools.combinations(sorted(v), 2) if x != y}
    assert pairs(spark, texts) == wanted


def test_classes_long_and_empty(spark):
    long = "wоrd " * 40_000
    got = lookalike.lookalike_classes(lookalike.lookalike_keys(frame(spark, [("a", long), ("b", "word " * 40_000)]))).collect()
    assert {(r.id, r.class_size, r.variants) for r in got} == {("a", 2, 2), ("b", 2, 2)}
    assert pairs(spark, []) == set()


def canonical(spark, texts):
    return {r.id: r.canonical for r in lookalike.canonical_texts(frame(spark, texts)).collect()}


def test_canonical_texts(spark):
    assert canonical(spark, [("a", "tһe\u00a0fox &amp; ⼈"), ("a", "tһe\u00a0fox &amp; ⼈"), ("b", "the fox"), ("c", None)]) == {"a": "the fox & 人", "b": "the fox"}


NATIVE = [("a", "Москва и Волга"), ("b", "Mосква и Bолга"), ("c", "Μосква и Волга!"), ("d", "Σοφία"), ("e", "Σoφία\u200b")]


def test_native_words_keep_their_script(spark):
    got = canonical(spark, NATIVE)
    assert got["a"] == got["b"] == "Москва и Волга" and got["c"] == "Москва и Волга!" and got["d"] == got["e"] == "Σοφία"
    assert pairs(spark, NATIVE) == {("a", "b"), ("d", "e")}


def test_the_trie_decides_and_not_the_table(spark, monkeypatch):
    spelled = lambda: {r.token: r.canonical for r in lookalike.canonical_spellings(lookalike.scan_texts(frame(spark, NATIVE))).collect()}
    assert spelled()["Mосква"] == "Москва"
    monkeypatch.setattr(lookalike, "_resolve", lambda odd, vocabulary: lookalike.pd.DataFrame({"token": odd["odd_token"], "skeleton": odd["odd_skeleton"], "canonical": odd["odd_skeleton"]}))
    assert spelled()["Mосква"] == "Mockвa"


def test_a_latin_spelling_comes_first_where_the_corpus_has_it(spark):
    texts = [("a", "COH here"), ("b", "СОН here"), ("c", "СОН дома"), ("d", "СОН дома."), ("e", "а man"), ("f", "a man"), ("g", "хор"), ("h", "xoр")]
    assert pairs(spark, texts) == {("a", "b"), ("e", "f"), ("g", "h")}
    assert canonical(spark, texts)["g"] == "хор"


def test_keys_are_those_of_the_whole_text():
    text = "Москва — the сity, Σοφία и́ Boлга; plain end"
    stretches, tokens = lookalike.cut_open(text)
    assert tokens and len(stretches) == len(tokens) + 1
    parts = [lookalike.fingerprint(stretches[0])]
    for token, stretch in zip(tokens, stretches[1:]):
        parts += [lookalike.fingerprint(charforms.fold_token(token)), lookalike.fingerprint(stretch)]
    whole = "".join([stretches[0], *[charforms.fold_token(t) + s for t, s in zip(tokens, stretches[1:])]])
    assert lookalike.joined(parts) == lookalike.joined([lookalike.fingerprint(whole)])
    assert lookalike.joined([lookalike.fingerprint("\0a")]) != lookalike.joined([lookalike.fingerprint("a")])
