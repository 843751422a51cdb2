"""Updates, plans, archives, stores and Chinese books on small frames."""

import json

import pytest
from pyspark.sql import functions as F

from folioloom.functions import metrics as M
from folioloom.functions import text as X
from folioloom.operators import books as whole_books
from folioloom.operators import catalog as C
from folioloom.operators import quality
from folioloom.operators.vocabulary import common_words
from folioloom.sources import epub, objects, pages

PUBLISHER = X.Publisher("Lantern Press", "lantern.example")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def one(spark, expression, *values):
    df = spark.createDataFrame([tuple(values)], [f"c{i}" for i in range(len(values))])
    return df.select(expression(*[F.col(c) for c in df.columns]).alias("x")).first().x


def test_partial_update_and_log(spark):
    stored = spark.createDataFrame([(1, "a", "x"), (2, "b", None)], "id int, name string, kind string")
    patch = spark.createDataFrame([(2, "B", "new"), (1, None, "z"), (9, "n", "n")], "id int, name string, kind string")
    assert rows(C.partial_update(stored, patch, "id", ["name"])) == [(1, "a", "x"), (2, "B", None)]
    after, log = C.with_log(stored, patch, "id", ["name", "kind"], F.lit("now"))
    assert rows(after) == [(1, "a", "z"), (2, "B", "new")]
    assert rows(log) == [(1, "kind", "x", "z", "now"), (2, "kind", None, "new", "now"), (2, "name", "b", "B", "now")]
    assert rows(C.partial_update(stored.limit(0), patch, "id", ["name"])) == []


def test_new_rows(spark):
    keys, active = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int"), spark.createDataFrame([(2,), (None,)], "k int")
    got = C.new_rows(keys, active, "k", status=F.lit("queued")).collect()
    assert [(r.k, r.status) for r in got] == [(1, "queued")] and len(got[0].id) == 36


def test_within_budget(spark):
    df = spark.createDataFrame([(p, i) for p in (1, 2, 4) for i in range(4)], "page int, i int")
    got = C.within_budget(df, "page", ["i"], 6)
    assert rows(got.select("page", "i")) == [(1, 0), (1, 1), (1, 2), (1, 3), (2, 0), (2, 1)]
    assert {r.page: r.budget_before for r in got.collect()} == {1: 6, 2: 2}
    assert C.within_budget(df, "page", ["i"], 0).count() == 0


@pytest.mark.parametrize("count, bonus", [(0, 300), (1, 84), (2, None)])
def test_gap_bonus(spark, count, bonus):
    targets = spark.createDataFrame([("Fiction", 15.0), ("Other", 93.0)], "c string, t double")
    counts = spark.createDataFrame([("Fiction", count), ("Other", 10 - count)], "c string, n int")
    got = {r.c: r.bonus for r in C.gap_bonus(counts, targets, "c", "n", "t").collect()}
    assert got.get("Fiction") == bonus


def test_store_and_report(spark, tmp_path):
    folder = str(tmp_path / "store")
    put = lambda data: objects.put_texts(spark.createDataFrame(data, "book_id string, id string, html string"), folder)
    put([("b1", "c1", "x"), ("b2", "c2", "y")])
    put([("b2", "c3", "z")])
    assert rows(objects.get_texts(spark, folder).select("book_id", "id")) == [("b1", "c1"), ("b2", "c3")]
    assert objects.delete_prefix(spark, folder, "book_id=b1") == 1
    assert rows(objects.get_texts(spark, folder).select("book_id", "id")) == [("b2", "c3")]
    with pytest.raises(ValueError):
        objects.delete_prefix(spark, folder, "../x")
    objects.write_report(spark.createDataFrame([(1, "a")], "n int, s string"), str(tmp_path / "report"))
    text = "".join(p.read_text() for p in (tmp_path / "report").glob("*.txt"))
    assert json.loads(text) == {"n": 1, "s": "a"} and text.count("\n") > 2


def test_pages(spark, tmp_path):
    for n, ids in ((1, (7, 8)), (3, (8, 9))):
        (tmp_path / f"page-{n}.json").write_text(json.dumps({"results": [{"id": i, "title": f"T{i}-{n}", "languages": ["en"]} for i in ids]}))
    got = pages.read_pages(spark, str(tmp_path), 1, 4)
    assert rows(got.select("page", "position", "id", "title")) == [(1, 0, 7, "T7-1"), (1, 1, 8, "T8-1"), (3, 0, 8, "T8-3"), (3, 1, 9, "T9-3")]
    found = pages.lookup(got, spark.createDataFrame([(8,), (5,)], "x int"))
    assert rows(found.select("id", "title")) == [(5, None), (8, "T8-1")]
    assert rows(pages.read_pages(spark, str(tmp_path), 2).select("id")) == [(8,), (9,)]


def test_dom():
    html = '<p class="x">a &amp; b&#8212;<script>if (1 < 2) {}</script><link rel="s"/><br/><!-- c --><STYLE>p{}</STYLE><b>d</b></p>'
    assert X.rewrite_dom(html) == '<p class="x">a &amp; b&#8212;<br/><!-- c --><b>d</b></p>'
    assert X.rewrite_dom("") == "" and X.rewrite_dom("a < b") == "a < b"


def test_between_markers(spark):
    cut = lambda t: X.between_markers(t, PUBLISHER)
    assert one(spark, cut, "x *** START OF THE LANTERN PRESS EBOOK a *** body *** END OF THIS EBOOK a *** y") == " body "
    assert one(spark, cut, "body *** END OF EBOOK *** y") == "body " and one(spark, cut, "x ***START OF EBOOK*** body") == " body"
    assert one(spark, cut, "*** START OF PLAY *** body") == "*** START OF PLAY *** body"


def test_prompts_and_answers(spark):
    got = spark.createDataFrame([("红楼", "曹", "清", ["a", "b"]), ("T", "A", None, None)], "t string, a string, d string, s array<string>").select(X.cover_prompt(F.col("t"), F.col("a"), F.col("d"), F.col("s")).alias("p")).collect()
    assert got[0].p.startswith('A book cover illustration for "红楼" by 曹, 清 period. Style: Qing dynasty') and got[0].p.endswith("Thematic elements: a, b.")
    assert got[1].p.startswith('A book cover illustration for "T" by A. Style: classical Chinese ink wash') and "Thematic" not in got[1].p
    read = lambda a: X.json_in_answer(a, "n int")
    assert one(spark, read, 'ok ```{"n": 3}``` done').n == 3 and one(spark, read, "nothing") is None


def test_compatible_form(spark):
    assert one(spark, M.normalize_compatible, "Ｆｕｌｌ ﬁne №5, “x”") == "full fine no5 x"


def test_common_words(spark):
    df = spark.createDataFrame([("The sea, the SEA",), ("sea’s don't",), (None,)], "text string")
    assert common_words(df, min_share=0.5) == set() and common_words(df, min_share=0.3) == {"the", "sea", "sea’s", "don't"}


# ---- archives


PROSE = " ".join(["The grey harbour kept its lamps."] * 60)


def extracted(spark, *args, **kw):
    files = spark.createDataFrame([("a", bytearray(epub.build_archive(*args, **kw)))], "path string, content binary")
    return [(r.title, r.word_count, r.html_content) for r in epub.chapters(files, PUBLISHER).orderBy("order_num").collect()]


def test_archives_are_read_as_they_were_built(spark):
    built = epub.build_archive([("title", "T & <t>"), ("language", "de")], [("a.xhtml", "<p>é</p>"), ("gone.xhtml", None)], [("One", "a.xhtml#x")], [("i.png", b"1")], b"2")
    items = epub.archive_items(spark.createDataFrame([("a", bytearray(built)), ("b", bytearray(b"PK")), ("c", None)], "path string, content binary"))
    got = {(r.archive, r.kind, r.position): (r.title, bytes(r.content) if r.content is not None else None) for r in items.collect()}
    assert got["a", "spine", 0][1].decode() == "<p>é</p>" and got["a", "spine", 1][1] == b"" and got["a", "cover", 0][1] == b"2" and got["a", "image", 0][1] == b"1"
    assert got["a", "toc", 0][0] == "One" and ("b", "error", 0) in got and ("c", "error", 0) in got
    assert epub.metadata(items).first().title == "T & <t>"


def test_text_before_the_first_anchor(spark):
    part = lambda n: f'<h2 id="c{n}">Chapter {n}</h2><p>{n} {PROSE}</p>'
    before = f"<p>It went on. {PROSE}</p>"
    pages_, toc = [("one.xhtml", part(1) + part(2)), ("two.xhtml", before + part(3) + part(4))], [(f"Ch {n}", f"{f}.xhtml#c{n}") for n, f in ((1, "one"), (2, "one"), (3, "two"), (4, "two"))]
    got = extracted(spark, [], pages_, toc)
    assert [t for t, _, _ in got] == ["Chapter 1", "Chapter 2", "Chapter 3", "Chapter 4"]
    assert got[1][2].endswith(before) and "It went on" not in got[2][2]
    first = extracted(spark, [], [("two.xhtml", before + part(3) + part(4))], toc[2:])
    assert first[0][2].startswith("<p>It went on")  # nothing comes before it
    assert epub.by_anchors(toc) and not epub.by_anchors(toc[1:3]) and not epub.by_anchors([])


def test_only_numbered_entries_cut_where_labels_abound(spark):
    body = "".join(f'<h2 id="c{n}">Chapter {n}</h2><p>{n} {PROSE}</p><h3 id="s{n}">A remark</h3><p>{n} {PROSE} end</p><h3 id="t{n}">Another</h3><p>x</p>' for n in range(1, 7))
    toc = [(t, f"b.xhtml#{k}{n}") for n in range(1, 7) for k, t in (("c", f"Chapter {n}"), ("s", "A remark"), ("t", "Another"))]
    got = extracted(spark, [], [("b.xhtml", body)], toc)
    assert [t for t, _, _ in got] == [f"Chapter {n}" for n in range(1, 7)] and "A remark" in got[0][2]


def test_titles_orphans_and_edges(spark):
    page = lambda n, head="": f"<html><body>{head or f'<h2>Chapter {n}</h2>'}<p>{n} {PROSE}</p></body></html>"
    head = '<h2><span class="caption">A picture</span>CHAPTER I.</h2>'
    pages_ = [("cover.xhtml", page(0)), ("t.xhtml", page(9, "<h2>The Lantern Press eBook of X</h2>")), ("a.xhtml", page(1, head)), ("b.xhtml", "<p>And then it went on and on, and on again, and on.</p>"), ("c.xhtml", page(3)), ("d.xhtml", page(1, head)), ("e.xhtml", "<p>" + "By the author of this. " * 40 + "</p>"), ("f.xhtml", "<h2>Other works</h2><p>" + "one two three " * 30 + "</p>")]
    toc = [("Cover", "cover.xhtml"), ("Start", "t.xhtml"), ("I", "text/a.xhtml"), ("I", "a.xhtml"), ("III", "c.xhtml"), ("I", "d.xhtml"), ("E", "e.xhtml"), ("Works", "f.xhtml")]
    got = extracted(spark, [], pages_, [t for t in toc if t[1] != "text/a.xhtml"])
    assert [t for t, _, _ in got] == ["Start", "CHAPTER I.", "Chapter 3"]
    assert got[1][2].endswith("and on again, and on.</p>")
    assert one(spark, lambda h: epub.heading_title(h, PUBLISHER), head) == "CHAPTER I."
    assert one(spark, epub.front_matter, "<p>" + "By the author of this. " * 40 + "</p>") is True


# ---- Chinese books


def test_titles_are_found_with_their_places(spark):
    html = "<h2>第一回</h2><p>江水</p><H3>卷上</H3><p>第三回</p>"
    got = quality.detected_chapters(spark.createDataFrame([("a", html), ("b", "<p>x</p>字<p>第三回</p><p>一般的话</p>"), ("c", None)], "key string, html string"))
    assert rows(got) == [("a", 0, "第一回", "numbered"), ("a", html.index("<H3>"), "卷上", "volume"), ("b", 9, "第三回", "numbered")]


def test_a_large_text_is_split_at_its_titles(spark):
    part = lambda n: f"<h2>第{n}回</h2><p>" + "江水东去。" * 500 + "</p>"
    whole = "<script>x</script>" + "".join(map(part, "一二三四五")) + "<h2>跋</h2>"
    df = spark.createDataFrame([("a", "书", whole), ("b", "短", "<p>灯火</p>"), ("n", "x", None), ("t", "傳", "<p>" + "漁書" * 30 + "</p>")], "key string, title string, html string")
    got = {(r.key, r.order_num): r for r in quality.clean_chinese(df).collect()}
    assert [got["a", n].title for n in range(1, 6)] == ["第一回", "第二回", "第三回", "第四回", "第五回"] and len(got) == 7
    assert got["a", 2].html.startswith("<h2>第二回") and got["a", 2].characters == 2503 and not got["a", 2].needs_punctuation
    assert (got["b", 1].title, got["b", 1].characters) == ("短", 2)
    assert got["t", 1].script == "traditional" and "渔书" in got["t", 1].html


def test_chinese_books_as_a_whole(spark):
    texts = spark.createDataFrame([("a", "书", "<p>" + "书信灯火。" * 500 + "</p>", True), ("n", "x", None, False)], "key string, title string, html string, has_cover boolean")
    words = spark.createDataFrame([("书信", 1), ("灯火", 3)], "word string, level int")
    got = {r.book_id: r for r in quality.process_chinese(texts, words, PUBLISHER).collect()}
    assert (got["a"].chapter_count, got["a"].characters, got["a"].level, got["a"].minutes) == (1, 2000, "HSK2", 4)
    assert got["a"].score == 85 and got["n"].chapter_count == 0 and "no_chapters" in got["n"].issues
    shares = quality.level_shares(quality.vocabulary_levels(spark.createDataFrame([("k", "书信灯火雨")], "key string, text string"), words)).first()
    assert shares.distribution == {"1": 1, "3": 1, "unknown": 1} and shares.level == 2.0


@pytest.mark.parametrize("many, wanted", [(5, [0, 1, 2, 3, 4]), (12, [0, 2, 4, 6, 8]), (3, [0, 1, 2]), (9, [0, 1, 2, 3, 4])])
def test_sampled_chapters(spark, many, wanted):
    df = spark.createDataFrame([("b", f"c{i:02}", i) for i in range(many)], "book_id string, id string, order_num int")
    assert sorted(r.order_num for r in whole_books.sampled(df).collect()) == wanted


def test_english_books_as_a_whole(spark):
    built = epub.build_archive([("title", "T")], [(f"{n}.xhtml", f"<h2>Chapter {n}</h2><p>{n} {PROSE} Tokio -- far.</p>") for n in (1, 2, 3)], [(f"Chapter {n}", f"{n}.xhtml") for n in (1, 2, 3)])
    found = epub.chapters(spark.createDataFrame([("a", bytearray(built))], "path string, content binary"), PUBLISHER)
    chapters = found.select(F.concat_ws("/", "archive", "order_num").alias("id"), F.col("archive").alias("book_id"), "order_num", "title", "html_content")
    books = spark.createDataFrame([("a", True), ("none", False)], "book_id string, has_cover boolean")
    got = {r.book_id: r for r in whole_books.english_books(books, chapters, PUBLISHER, frozenset({"the"})).collect()}
    cleaned = {r.order_num: r.html for r in whole_books.cleaned_chapters(chapters, PUBLISHER, frozenset({"the"})).collect()}
    assert "Tokyo⁠—far." in cleaned[1] and cleaned[1].startswith('<section data-epub-type="chapter">')
    a = got["a"]
    assert (a.chapter_count, a.issues, a.score, a.tier) == (3, ["few_words"], 90, "auto_approved") and a.words > 1000 and a.minutes == round(a.words / 250)
    assert a.flesch > 80 and a.cefr in ("A1", "A2") and abs(a.difficulty - (100 - a.flesch)) < 0.06
    assert (got["none"].chapter_count, got["none"].flesch) == (0, None) and "no_chapters" in got["none"].issues
