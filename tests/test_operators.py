"""Relational operators, sources and streams on small frames."""

import io
import zipfile

import pytest
from pyspark.sql import functions as F

from folioloom.functions.text import Publisher
from folioloom.operators import catalog as C
from folioloom.operators import packed_values as P
from folioloom.operators import quality
from folioloom.sources import epub, listing
from folioloom.streaming import jobs


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_upsert_keeps_what_a_patch_leaves_out(spark):
    stored = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "id int, name string, kind string")
    patch = spark.createDataFrame([(2, "B"), (3, "c"), (1, None)], "id int, name string")
    assert rows(C.upsert(stored, patch, "id")) == [(1, "a", "x"), (2, "B", "y"), (3, "c", None)]
    assert rows(C.upsert(C.upsert(stored, patch, "id"), patch, "id")) == rows(C.upsert(stored, patch, "id"))


def test_insert_ignore_and_change_log(spark):
    stored = spark.createDataFrame([(1, "a")], "id int, name string")
    batch = spark.createDataFrame([(1, "z"), (2, "b"), (2, "b")], "id int, name string")
    assert rows(C.insert_ignore(stored, batch, "id")) == [(1, "a"), (2, "b")]
    assert rows(C.change_log(stored, spark.createDataFrame([(1, "q")], "id int, name string"), "id", ["name"])) == [(1, "name", "a", "q")]
    assert rows(C.change_log(stored, spark.createDataFrame([(1, None)], "id int, name string"), "id", ["name"])) == []


def test_anti_and_semi_split_a_table(spark):
    left = spark.range(10).toDF("k")
    known = spark.range(5).toDF("x")
    assert len(rows(C.anti(left, "k", known))) + len(rows(C.semi(left, "k", known))) == 10


def test_sequence_gaps(spark):
    df = spark.createDataFrame([("a", n) for n in (1, 2, 5, 9)] + [("b", 1), ("b", 9)], "g string, n int")
    assert rows(C.sequence_gaps(df, "g", "n")) == [("a", 3), ("a", 6)]


def test_edge_trim_never_empties(spark):
    df = spark.createDataFrame([("a", i, w) for i, w in enumerate((10, 10, 900, 900, 10))] + [("b", i, 10) for i in range(5)], "g string, n int, w int")
    out = C.edge_trim(df, "g", F.col("w") < 300, [F.col("n")])
    assert [r for r in rows(out.select("g", "n")) if r[0] == "a"] == [("a", 2), ("a", 3)]
    assert {r[0] for r in rows(out.select("g"))} == {"a", "b"}


def test_empty_tables(spark):
    none = spark.createDataFrame([], "id int, name string")
    assert rows(C.upsert(none, none, "id")) == [] and rows(C.insert_ignore(none, none, "id")) == []
    assert rows(C.renumber(none, "name", F.col("id"))) == []


def test_stop_after_known(spark):
    pages = spark.createDataFrame([(1, False), (2, True), (3, True), (4, False), (5, True), (6, True), (7, True), (8, False)], "p int, known boolean")
    assert [r[0] for r in rows(C.stop_after_known(pages, "p", "known", 3))] == [1, 2, 3, 4, 5, 6, 7]


PUBLISHER = Publisher("Lantern Press", "lantern.example")
_CHAPTERS = "book_id string, id string, order_num int, title string, html_content string, word_count int"


def test_quality_of_damaged_books(spark):
    long = "word " * 60
    data = [("b", f"c{i}", i, f"T{i}", f"<p>{long}{i}</p>", w) for i, w in enumerate((1200, 1100, 60))]
    data += [("d", f"d{i}", i, f"T{i}", f"<p>{long}</p>", 900) for i in range(2)]
    data += [("r", f"r{i}", i, f"T{i}", f"<p>{long}{i} A Lantern Press book</p>", 4000) for i in range(2)]
    data += [("p", f"p{i}", i, ["Preface", "One"][i], f"<p>{long}{i}</p>", 4000) for i in range(2)]
    books = spark.createDataFrame([("b", False), ("d", True), ("r", True), ("p", True), ("none", True)], "book_id string, has_cover boolean")
    got = {r.book_id: r for r in quality.english_quality(books, spark.createDataFrame(data, _CHAPTERS), PUBLISHER).collect()}
    # 100 - 10 (2360 words) - 10 (no cover) - 10 (last chapter cut)
    assert (got["b"].score, got["b"].tier, got["b"].passed) == (70, "needs_review", True)
    assert got["b"].issues == ["few_words", "no_cover", "truncated_end"]
    assert (got["d"].score, got["d"].tier) == (0, "rejected") and "equal_chapters" in got["d"].issues
    assert (got["r"].score, got["r"].issues) == (30, ["residue"])
    assert (got["p"].score, got["p"].tier) == (100, "needs_review")
    assert (got["none"].score, got["none"].issues) == (20, ["no_chapters", "very_few_words"])


def test_quality_of_chinese_books(spark):
    data = [("a", f"a{i}", i, f"第{i}回", f"<p>{'江水东去' * 300}{'一二三'[i]}</p>", 0) for i in range(3)] + [("e", "e0", 0, "x", None, 0)]
    books = spark.createDataFrame([("a", True), ("e", False)], "book_id string, has_cover boolean")
    got = {r.book_id: r for r in quality.chinese_quality(books, spark.createDataFrame(data, _CHAPTERS), PUBLISHER).collect()}
    assert (got["a"].score, got["a"].tier, got["a"].issues) == (100, "auto_approved", [])
    assert got["e"].score == 100 - 15 - 30 - 5 - 10 and got["e"].issues == ["few_chapters", "very_few_characters", "empty_chapters", "no_cover"]


def test_fidelity(spark):
    df = spark.createDataFrame([(1, "a a b c", "a b b d"), (2, "", "")], "key int, ours string, theirs string")
    got = {r.key: (r.miss_rate, r.verdict) for r in quality.fidelity(df).collect()}
    assert got[1] == (0.5, "SUSPECT") and got[2][0] == 1.0
    words = " ".join(f"w{i}" for i in range(400))
    assert quality.compare_texts("One, TWO\n two", "two one") == (3, 2, "NA", 0.2)
    assert quality.compare_texts(words, words)[2:] == ("OK", 0.0) and quality.compare_texts(words, words[::-1])[2] == "MISS"
    assert quality.fidelity(spark.createDataFrame([(1, None, "a")], "key long, ours string, theirs string")).first().verdict == "SUSPECT"


def test_vocabulary_levels(spark):
    texts = spark.createDataFrame([("k", "书信灯火x雨")], "key string, text string")
    words = spark.createDataFrame([("书信", 1), ("灯火", 2), ("灯火", 4)], "word string, level int")
    assert {r.level: r.n for r in quality.vocabulary_levels(texts, words).collect()} == {1: 1, 2: 1, None: 1}


def make_epub(anchors: bool) -> bytes:
    prose = " ".join(["The grey harbour kept its lamps."] * 80)
    pages = {f"c{i}.xhtml": f"<html><body><h2>Chapter {i}</h2><p>{prose} {i}</p></body></html>" for i in (1, 2, 3)}
    points = "".join(f'<navPoint id="n{i}"><navLabel><text>Chapter {i}</text></navLabel><content src="c{i}.xhtml"/></navPoint>' for i in (1, 3))
    if anchors:
        body = "".join(f'<h2 id="a{i}">Chapter {i}</h2><p>{i} {prose} {i}</p>' for i in (1, 2, 3))
        pages = {"all.xhtml": f"<html><body>{body}</body></html>"}
        points = "".join(f'<navPoint id="n{i}"><navLabel><text>Chapter {i}</text></navLabel><content src="all.xhtml#a{i}"/></navPoint>' for i in (1, 2, 3))
    items = "".join(f'<item id="i{k}" href="{n}" media-type="application/xhtml+xml"/>' for k, n in enumerate(pages))
    refs = "".join(f'<itemref idref="i{k}"/>' for k in range(len(pages)))
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("META-INF/container.xml", '<container><rootfiles><rootfile full-path="O/content.opf"/></rootfiles></container>')
        z.writestr("O/content.opf", f'<package><metadata><title>T</title><subject>s1</subject><subject>s2</subject></metadata><manifest>{items}<item id="ncx" href="toc.ncx" media-type="application/x-dtbncx+xml"/><item id="p" href="p.png" media-type="image/png"/></manifest><spine>{refs}</spine></package>')
        z.writestr("O/toc.ncx", f"<ncx><navMap>{points}</navMap></ncx>")
        z.writestr("O/p.png", b"x")
        for name, html in pages.items():
            z.writestr("O/" + name, html)
    return out.getvalue()


@pytest.mark.parametrize("anchors", [False, True])
def test_epub(spark, tmp_path, anchors):
    (tmp_path / "a.epub").write_bytes(make_epub(anchors))
    (tmp_path / "broken.epub").write_bytes(b"PK nonsense")
    items = epub.read_epubs(spark, str(tmp_path)).cache()
    meta = epub.metadata(items).first()
    assert (meta.title, meta.author, meta.language, meta.subjects) == ("T", "Unknown", "en", ["s1", "s2"])
    got = epub.chapters(epub.epub_files(spark, str(tmp_path)), PUBLISHER).orderBy("order_num").collect()
    assert [r.archive.rsplit("/", 1)[-1] for r in items.where("kind = 'error'").collect()] == ["broken.epub"]
    assert [c.title for c in got] == (["Chapter 1", "Chapter 2", "Chapter 3"] if anchors else ["Chapter 1", "Chapter 3"])
    assert [c.order_num for c in got] == list(range(1, len(got) + 1))
    if not anchors:
        assert "Chapter 2" in got[0].html_content  # a file that no entry names joins the chapter before it
    assert items.where("kind = 'image'").count() == 1


def test_listings(spark):
    page = '<font color="CC0000">甲</font><a href="?M=book&P=1">【书】</a><a href="?M=book&P=2">二</a>'
    assert rows(listing.author_listing(spark.createDataFrame([("p", page)], "page string, html string"))) == [("p", "1", "书", "甲"), ("p", "2", "二", "甲")]
    links = '<a href="/f/x.txt">红楼 TXT</a><a href="/f/x.epub">红楼 EPUB</a><a href="/about">no</a>'
    assert rows(listing.download_listing(spark.createDataFrame([("p", links)], "page string, html string"), "https://h")) == [("p", "x", "红楼", "https://h/f/x.epub", "epub")]


def test_packed_values(spark):
    fields = ["[\"Law, civil\", \"Orphans\"]", "Law, civil; Orphans", "Orphans,Fables,\"Law, civil\"", "['Fables', 'Orphans']", "\"[\\\"Fables\\\"]\"", "|Fables | Orphans|", '"""big"" house";Fables', ";;", " ", ""]
    df = spark.createDataFrame([(str(i), f, None) for i, f in enumerate(fields)] + [("n", None, None), ("0", fields[0], None)], "id string, field string, field_name string")
    got: dict = {}
    for r in P.unpack_fields(df.drop("field_name"), "id", ["field"]).collect():
        got.setdefault(r.id, {})[r.value_no] = r.packed_value
    lists = {k: [v[n] for n in sorted(v)] for k, v in got.items()}
    assert lists == {
        "0": ["Law, civil", "Orphans"], "1": ["Law, civil", "Orphans"], "2": ["Orphans", "Fables", "Law, civil"], "3": ["Fables", "Orphans"],
        "4": ["Fables"], "5": ["Fables", "Orphans"], "6": ['"big" house', "Fables"],
    }
    assert P.unpack_fields(df.drop("field_name").limit(0), "id", ["field"]).count() == 0


def unpacked(spark, fields, **kw):
    df = spark.createDataFrame([(str(i), f) for i, f in enumerate(fields)], "id string, field string")
    got: dict = {}
    for r in P.unpack_fields(df, "id", ["field"]).collect():
        got.setdefault(int(r.id), {})[r.value_no] = r.packed_value
    return {k: [v[n] for n in sorted(v)] for k, v in got.items()}


def test_values_longer_than_the_lattice(spark):
    nine = "a1, b2, c3, d4, e5, f6, g7, h8, i9"
    got = unpacked(spark, [f'"{nine}";x{i}' for i in range(21)] + [f"{nine};Fables", f"Fables; {nine}", nine + ", j10", "a1, b2"])
    assert got[21] == [nine, "Fables"] and got[22] == ["Fables", nine] and got[0] == [nine, "x0"]
    assert got[23] == [nine, "j10"] and got[24] == ["a1", "b2"]
    assert P.head_of(nine) == "a1, b2, c3, d4, e5, f6, g7, h8"


def test_rounds_end_when_the_weights_stay(spark, monkeypatch):
    names = []
    monkeypatch.setattr(P, "materialise", lambda df, name, f=P.materialise: names.append(name) or f(df, name))
    fields = ["Law, civil; Orphans", '"Law, civil"', "Orphans", "Law, civil", "Orphans, Fables", "Fables"]
    assert unpacked(spark, fields)[0] == ["Law, civil", "Orphans"] and unpacked(spark, fields)[4] == ["Orphans", "Fables"]
    assert "packed2" in names and f"packed{P.ROUNDS}" not in names


def test_a_very_long_field(spark):
    assert [len(v) for v in unpacked(spark, [";".join(f"v{i}" for i in range(5000))]).values()] == [5000]


def test_packed_posteriors_sum_to_one():
    size, segments = P.lattice("a, b, c")
    scored = [(i, j, P._log_score(t, n, x, y, 0.1)) for i, j, t, n, x, y in segments]
    post = P.posteriors(size, scored)
    assert abs(sum(p for p, (i, j, _) in zip(post, scored) if i == 0) - 1) < 1e-9


def test_stream_equals_batch(spark, small, tmp_path):
    batch = spark.read.parquet(f"{small}/events.parquet")
    stream = spark.readStream.schema(batch.schema).option("maxFilesPerTrigger", 1).parquet(f"{small}/events.parquet*")
    q = jobs.attempts(stream).writeStream.format("memory").queryName("attempts").outputMode("update").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert rows(spark.table("attempts")) == rows(jobs.attempts_batch(batch))
    q = jobs.intake(stream, str(tmp_path / "out"), str(tmp_path / "c2"))
    q.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).count() == batch.count()
    source = tmp_path / "feed"
    source.mkdir()
    feed = spark.readStream.schema(batch.schema).parquet(str(source))
    for n, part in enumerate((batch.where("event_id < 20"), batch.where("event_id between 20 and 29"))):
        part.coalesce(1).write.mode("overwrite").parquet(str(tmp_path / f"part{n}"))
        next((tmp_path / f"part{n}").glob("*.parquet")).rename(source / f"{n}.parquet")
        jobs.pull(feed, str(tmp_path / "jobs"), str(tmp_path / "c4"), 6).awaitTermination(120)
    taken = spark.read.parquet(str(tmp_path / "jobs/taken"))
    first = [r.event_id for r in taken.where("batch = 0").collect()]
    order = lambda df: [r.event_id for r in df.orderBy(F.desc("value"), "event_id").collect()]
    assert sorted(first) == sorted(order(batch.where("event_id < 20"))[:6])
    rest = batch.where(F.col("event_id").between(0, 29) & ~F.col("event_id").isin(first))
    assert sorted(r.event_id for r in taken.where("batch = 1").collect()) == sorted(order(rest)[:6])  # what was left waits with what is new
    counts = jobs.windowed_counts(stream).writeStream.format("memory").queryName("windows").outputMode("complete").option("checkpointLocation", str(tmp_path / "c3")).trigger(availableNow=True).start()
    counts.awaitTermination(120)
    assert rows(spark.table("windows").select("start", "event_type", "n")) == rows(jobs.windowed_counts(batch).select("start", "event_type", "n"))


def test_suffix_join_matches_every_book(spark, tmp_path):
    from folioloom.plans import registry

    spark.createDataFrame([("b1", 4), ("b3", 6), ("b2", 6), ("b9", 1234), ("n", None)], "id string, pg_id int").write.parquet(f"{tmp_path}/books.parquet")
    hrefs = [("c1", "text/ch004.xhtml"), ("c2", "ch006.xhtml"), ("c2", "ch006.xhtml"), ("c3", "a/b/ch1234.xhtml"), ("c4", "xch006.xhtml"), ("c5", None), ("c6", "ch006.xhtml/")]
    spark.createDataFrame(hrefs, "id string, href string").write.parquet(f"{tmp_path}/chapters.parquet")
    rows = registry.QUERIES["suffix_join"](spark, str(tmp_path)).collect()
    assert {(r.id, r.book) for r in rows} == {("c1", "b1"), ("c2", "b2"), ("c3", "b9")} and len(rows) == 3


def test_unique_conflicts_of_every_row(spark, tmp_path):
    import duckdb

    from folioloom.plans import registry

    rows = [(1, "a", "x"), (5, "a", "x"), (5, "a", "x"), (6, "b", "x"), (6, "b", "x"), (7, "a", None), (8, "a", None), (4, "c", "y"), (9, "c", "y"), (11, "c", "z")]
    spark.createDataFrame(rows, "id long, source_type string, source_book_id string").write.parquet(f"{tmp_path}/zh_sources.parquet")
    got = registry.QUERIES["unique_conflicts"](spark, str(tmp_path)).collect()
    assert sorted(r.id for r in got) == [1, 4, 5, 9]
    duck = duckdb.connect()
    duck.execute(f"create view zh_sources as select * from '{tmp_path}/zh_sources.parquet/*.parquet'")
    assert sorted(r[0] for r in duck.execute(registry.SQL["unique_conflicts"]).fetchall()) == [1, 4, 5, 9]


def test_intermediates_can_be_dropped(spark):
    from folioloom.session import drop_intermediates, materialise, shared_folder

    df = materialise(spark.range(3), "droptest")
    assert df.count() == 3
    assert drop_intermediates(spark) >= 1 and drop_intermediates(spark) == 0
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(shared_folder(spark))
    left = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)
    assert not any("droptest" in f.getPath().getName() for f in left)


def test_top_two_matches_against_all_pairs(spark):
    import random

    rng = random.Random(7)
    sets = {f"i{n:02}": sorted(rng.sample("abcdefghij", rng.randint(0, 5))) for n in range(60)}
    got = {r.id: (r.best, r.best_score, r.runner_up, r.runner_score) for r in C.top_two_matches(spark.createDataFrame(list(sets.items()), "id string, t array<string>"), "id", "t").collect()}
    score = lambda a, b: len(set(a) & set(b)) / len(set(a) | set(b)) if a and b else 0.0
    for key, held in sets.items():
        ranked = sorted(((-score(held, other), k) for k, other in sets.items() if k != key and score(held, other) > 0))[:2]
        if not ranked:
            assert key not in got
            continue
        wanted = (ranked[0][1], -ranked[0][0], *((ranked[1][1], -ranked[1][0]) if len(ranked) > 1 else (None, None)))
        assert got[key] == wanted


def test_top_two_matches_of_another_table(spark):
    covers = spark.createDataFrame([("c1", ["strange", "case", "jekyll"]), ("c2", ["strange", "house"]), ("c3", ["x"])], "id string, t array<string>")
    books = spark.createDataFrame([("b1", ["strange", "case", "jekyll", "hyde"]), ("c2", ["y"])], "id string, t array<string>")
    got = C.top_two_matches(books, "id", "t", covers).collect()
    assert [(r.id, r.best, r.best_score, r.runner_up, r.runner_score) for r in got] == [("b1", "c1", 0.75, "c2", 0.2)]
