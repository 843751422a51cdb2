"""Source records, remaining lookups, Chinese books, calibration and the whole chapter pipeline."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from folioloom.functions import text as X
from folioloom.operators import books as whole_books
from folioloom.operators import catalog as C
from folioloom.operators import quality, vocabulary
from folioloom.operators.layout import spread
from folioloom.plans.catalog_queries import PUBLISHER, STRIP, T, books, query

_WS = X.WS


@query("SELECT id, coalesce(nullif(title, ''), 'Unknown') AS title, coalesce(nullif(author, ''), 'Unknown') AS author, coalesce(nullif(language, ''), 'en') AS language, coalesce(description, '') AS description FROM books")
def src_metadata(s, d):
    fall = lambda c, v: F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit(v)).alias(c)
    return T(s, d, "books").select("id", fall("title", "Unknown"), fall("author", "Unknown"), fall("language", "en"), F.coalesce("description", F.lit("")).alias("description"))


@query("SELECT id, coalesce(nullif(CASE WHEN id LIKE '%1' THEN 'https://host/' || id || '.epub' WHEN id LIKE '%2' THEN '' END, ''), CASE WHEN id NOT LIKE '%3' THEN 'https://host/' || id END) AS url FROM books")
def src_epub_url(s, d):
    formats = F.map_filter(
        F.create_map(
            F.lit("application/epub+zip"), F.when(F.col("id").endswith("1"), F.concat(F.lit("https://host/"), "id", F.lit(".epub"))).when(F.col("id").endswith("2"), ""),
            F.lit("application/epub"), F.when(~F.col("id").endswith("3"), F.concat(F.lit("https://host/"), "id")),
        ),
        lambda k, v: v.isNotNull(),
    )
    df = T(s, d, "books").select("id", formats.alias("formats"))
    get = lambda k: F.nullif(F.try_element_at("formats", F.lit(k)), F.lit(""))
    return df.select("id", F.coalesce(get("application/epub+zip"), get("application/epub")).alias("url"))


@query("SELECT source_type, source_book_id, id FROM (SELECT *, row_number() OVER (PARTITION BY source_type, source_book_id ORDER BY (epub_format IS DISTINCT FROM 'epub')::INT, id) AS r FROM (SELECT DISTINCT id, source_type, source_book_id, epub_format FROM zh_sources) z) t WHERE r = 1 ORDER BY id LIMIT 100")
def src_dedup_limit(s, d):
    z = T(s, d, "zh_sources").select("id", "source_type", "source_book_id", "epub_format").distinct()
    rank = F.row_number().over(Window.partitionBy("source_type", "source_book_id").orderBy((~F.col("epub_format").eqNullSafe("epub")).cast("int"), "id"))
    return z.withColumn("r", rank).where("r = 1").orderBy("id").limit(100).select("source_type", "source_book_id", "id")


@query(r"SELECT id, array_to_string(list_sort(list_distinct(regexp_extract_all(coalesce(html_content, ''), 'href=\"#n(\d+)\"', 1))), ',') AS targets FROM chapters")
def src_link_ids(s, d):
    found = F.regexp_extract_all(F.coalesce("html_content", F.lit("")), F.lit(r'href="#n(\d+)"'), F.lit(1))
    return T(s, d, "chapters").select("id", F.array_join(F.sort_array(F.array_distinct(found)), ",").alias("targets"))


@query("SELECT b.id, coalesce(string_agg(DISTINCT z.source_book_id, ',' ORDER BY z.source_book_id), '') AS ids FROM (SELECT DISTINCT id, zh_source_id FROM books) b LEFT JOIN zh_sources z ON z.id = b.zh_source_id GROUP BY b.id")
def src_id_resolution(s, d):
    z = T(s, d, "zh_sources").select(F.col("id").alias("z_id"), "source_book_id")
    joined = T(s, d, "books").select("id", "zh_source_id").distinct().join(z, F.col("zh_source_id") == F.col("z_id"), "left")
    return joined.groupBy("id").agg(F.array_join(F.sort_array(F.collect_set("source_book_id")), ",").alias("ids"))


@query("SELECT id, CASE lower(regexp_extract(href, '\\.([a-zA-Z0-9]+)$', 1)) WHEN 'png' THEN 'image/png' WHEN 'webp' THEN 'image/webp' WHEN 'txt' THEN 'text/plain' WHEN 'xhtml' THEN 'application/xhtml+xml' WHEN 'html' THEN 'text/html' ELSE 'image/jpeg' END AS mime FROM chapters")
def mime_map(s, d):
    table = {"png": "image/png", "webp": "image/webp", "txt": "text/plain", "xhtml": "application/xhtml+xml", "html": "text/html"}
    kinds = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    ext = F.lower(F.regexp_extract("href", r"\.([a-zA-Z0-9]+)$", 1))
    return T(s, d, "chapters").select("id", F.coalesce(F.try_element_at(kinds, ext), F.lit("image/jpeg")).alias("mime"))


@query("SELECT c.id, min(b.id) AS book FROM (SELECT DISTINCT id, split_part(href, '/', -1) AS file FROM chapters) c JOIN (SELECT id, printf('ch%03d.xhtml', pg_id) AS tail FROM books WHERE pg_id IS NOT NULL) b ON c.file = b.tail GROUP BY c.id")
def suffix_join(s, d):
    """Every book with a number; a path ends with a file name exactly if that is its last part."""
    tails = T(s, d, "books").where("pg_id is not null").groupBy(F.format_string("ch%03d.xhtml", "pg_id").alias("tail")).agg(F.min("id").alias("book"))
    c = T(s, d, "chapters").select("id", F.element_at(F.split("href", "/"), -1).alias("file")).distinct()
    return c.join(tails, F.col("file") == F.col("tail")).groupBy("id").agg(F.min("book").alias("book"))


@query(
    """SELECT w, count(*) AS n, coalesce(max(d.level), -1) AS level FROM (SELECT unnest(string_split(lower(title), ' ')) AS w FROM books WHERE title IS NOT NULL) t
       LEFT JOIN (SELECT word, min(level) AS level FROM (SELECT unnest(regexp_extract_all(lower(gloss), '[a-z]+')) AS word, length(area)::INTEGER AS level FROM subject_areas) g GROUP BY 1) d ON t.w = d.word GROUP BY w"""
)
def dict_join(s, d):
    """Title words with the level of a word list; a word that is listed twice has its lowest level."""
    listed = T(s, d, "subject_areas").select(F.explode(F.regexp_extract_all(F.lower("gloss"), F.lit("[a-z]+"), F.lit(0))).alias("word"), F.length("area").alias("level"))
    words = listed.groupBy("word").agg(F.min("level").alias("level"))
    t = T(s, d, "books").where("title is not null").select(F.explode(F.split(F.lower("title"), " ")).alias("w"))
    return t.groupBy("w").agg(F.count("*").alias("n")).join(words, F.col("w") == F.col("word"), "left").select("w", "n", F.coalesce("level", F.lit(-1)).alias("level"))


@query("SELECT language, count(DISTINCT author) AS authors, array_to_string(list_sort(list(DISTINCT source_type)), ',') AS sources FROM books WHERE language IS NOT NULL GROUP BY language")
def agg_distinct_sets(s, d):
    g = T(s, d, "books").where("language is not null").groupBy("language")
    return g.agg(F.countDistinct("author").alias("authors"), F.array_join(F.sort_array(F.collect_set("source_type")), ",").alias("sources"))


@query("SELECT id, sum(v)::BIGINT AS bonus FROM (SELECT id, CASE x WHEN 'Orphans' THEN 30 WHEN 'Fables' THEN 20 ELSE 0 END AS v FROM (SELECT id, unnest(from_json(CASE WHEN json_valid(subjects) AND json_type(subjects) = 'ARRAY' THEN subjects END, '[\"VARCHAR\"]')) AS x FROM (SELECT DISTINCT id, subjects FROM books) b) t) u GROUP BY id")
def agg_list_bonus(s, d):
    each = books(s, d).select("id", F.explode(F.from_json("subjects", "array<string>", {"allowSingleQuotes": "false"})).alias("x"))
    return each.groupBy("id").agg(F.sum(F.when(F.col("x") == "Orphans", 30).when(F.col("x") == "Fables", 20).otherwise(0)).alias("bonus"))


# Authors whose names tell a dynasty, first match decides.
DYNASTIES = (
    ("先秦", ("孔子", "孟子", "老子", "庄子", "荀子", "韩非", "孙武", "墨子")),
    ("两汉", ("司马迁", "刘安", "班固")),
    ("魏晋南北朝", ("曹操", "曹植", "陶渊明", "刘义庆")),
    ("唐", ("李白", "杜甫", "白居易", "韩愈", "柳宗元", "王维")),
    ("宋", ("苏轼", "欧阳修", "辛弃疾", "李清照", "司马光", "朱熹")),
    ("元", ("关汉卿", "马致远")),
    ("明", ("罗贯中", "施耐庵", "吴承恩", "冯梦龙", "凌濛初", "吴敬梓", "曹雪芹", "蒲松龄")),
    ("清", ("纪昀", "李汝珍", "刘鹗", "曾国藩", "李宝嘉")),
    ("民国", ("鲁迅", "胡适", "老舍", "梁启超", "林语堂", "郁达夫", "朱自清")),
)
_DYNASTY = "CASE " + " ".join(f"WHEN regexp_matches(h, '{'|'.join(w)}') THEN '{n}'" for n, w in DYNASTIES) + " END"


@query(f"SELECT id, {_DYNASTY} AS dynasty FROM (SELECT id, coalesce(author, '') || ' ' || coalesce(title, '') || CASE id % 4 WHEN 0 THEN '鲁迅' WHEN 1 THEN '李白' ELSE '' END AS h FROM zh_sources) t")
def detect_dynasty(s, d):
    h = F.concat(F.coalesce("author", F.lit("")), F.lit(" "), F.coalesce("title", F.lit("")), F.when(F.col("id") % 4 == 0, "鲁迅").when(F.col("id") % 4 == 1, "李白").otherwise(""))
    name = reduce(lambda acc, x: acc.when(h.rlike("|".join(x[1])), x[0]), DYNASTIES[1:], F.when(h.rlike("|".join(DYNASTIES[0][1])), DYNASTIES[0][0]))
    return T(s, d, "zh_sources").select("id", name.alias("dynasty"))


@query("SELECT id, CASE WHEN content_url IS NULL THEN NULL ELSE regexp_replace(content_url, '[^/]+$', 'cover-1700000000.jpg') END AS cover FROM (SELECT id, 'books/' || book_id || '/' || href AS content_url FROM chapters) t")
def rekey_cover(s, d):
    url = F.concat(F.lit("books/"), "book_id", F.lit("/"), "href")
    return T(s, d, "chapters").select("id", F.regexp_replace(url, "[^/]+$", "cover-1700000000.jpg").alias("cover"))


@query("SELECT id, coalesce(order_num, 0) AS order_num, book_id FROM chapters c WHERE NOT EXISTS (SELECT 1 FROM books b WHERE b.id = c.book_id AND b.quality_score < 50)")
def apply_exclusions(s, d):
    out = T(s, d, "books").where("quality_score < 50").select("id")
    return C.anti(T(s, d, "chapters"), "book_id", out).select("id", F.coalesce("order_num", F.lit(0)).alias("order_num"), "book_id")


@query("SELECT doc_id FROM documents ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id LIMIT 25")
def sample_rows(s, d):
    return T(s, d, "documents").orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").limit(25).select("doc_id")


# ---- Chinese books


def _zh(s, d):
    return T(s, d, "zh_chapters").select("id", "book_id", "order_num", "title", "html_content", "word_count").where("book_id is not null").dropDuplicates(["id"])


_CJK = r"[\x{4e00}-\x{9fff}\x{3400}-\x{4dbf}]"
_ZH_TEXT = STRIP.replace("html_content", "coalesce(html_content, '')")


@query(
    rf"""WITH m AS (SELECT book_id, len(regexp_extract_all({_ZH_TEXT}, '{_CJK}')) AS size, length(regexp_replace({_ZH_TEXT}, '[{_WS}]', '', 'g')) AS signs, row_number() OVER (PARTITION BY book_id ORDER BY order_num, id) AS p
       FROM (SELECT DISTINCT id, book_id, order_num, html_content FROM zh_chapters WHERE book_id IS NOT NULL) c)
       SELECT book_id, count(*) AS n_chapters, sum(size)::BIGINT AS n_words, count(*) FILTER (size < 20) AS n_empty, round(coalesce(sum(size) FILTER (p <= 3) / nullif(sum(signs) FILTER (p <= 3), 0), 1.0)::DOUBLE, 6) AS cjk_ratio FROM m GROUP BY book_id"""
)
def quality_checks_zh(s, d):
    return quality.chinese_checks(_zh(s, d), PUBLISHER).select("book_id", "n_chapters", "n_words", "n_empty", F.round("cjk_ratio", 6).alias("cjk_ratio"))


@query(
    rf"""WITH c AS (SELECT DISTINCT id, book_id, order_num, html_content FROM zh_chapters WHERE book_id IS NOT NULL), bk AS (SELECT DISTINCT id, description IS NOT NULL AS cover FROM books WHERE zh_source_id IS NOT NULL),
       m AS (SELECT book_id, len(regexp_extract_all({_ZH_TEXT}, '{_CJK}')) AS w, length(regexp_replace({_ZH_TEXT}, '[{_WS}]', '', 'g')) AS g, row_number() OVER (PARTITION BY book_id ORDER BY order_num, id) AS p, regexp_replace(lower({_ZH_TEXT}), '[{_WS}]+', '', 'g') AS x,
         regexp_matches(coalesce(html_content, ''), '{X.MOJIBAKE}') AS k, regexp_matches(coalesce(html_content, ''), '{X.residue_pattern(PUBLISHER)}') AS r FROM c),
       dc AS (SELECT book_id, sum(n) AS n FROM (SELECT book_id, sha1(x) AS h, count(*) AS n FROM m WHERE length(x) >= 100 GROUP BY 1, 2 HAVING count(*) > 1) q GROUP BY 1),
       g AS (SELECT book_id, count(*) AS n, sum(w) AS tw, count(*) FILTER (w < 20) AS e, max(k::INT) AS k, count(*) FILTER (r) AS r, sum(g) FILTER (p <= 3) AS sg, sum(w) FILTER (p <= 3) AS sw, stddev_pop(CASE WHEN w > 0 THEN w END) / avg(CASE WHEN w > 0 THEN w END) AS cv, count(*) FILTER (w > 0) AS nf FROM m GROUP BY 1),
       a AS (SELECT bk.id AS book_id, cover, coalesce(g.n, 0) AS n, coalesce(tw, 0) AS tw, coalesce(e, 0) AS e, coalesce(g.k, 0) AS k, coalesce(r, 0) AS r, coalesce(sg, 0) > 0 AND sw / sg < 0.3 AS low, cv, coalesce(nf, 0) AS nf, coalesce(dc.n, 0) AS dc FROM bk LEFT JOIN g ON g.book_id = bk.id LEFT JOIN dc ON dc.book_id = bk.id),
       s1 AS (SELECT *, CASE WHEN dc > 0 THEN 0 ELSE CASE WHEN tw > 2000000 THEN 0 ELSE 100 - CASE WHEN n = 0 THEN 50 WHEN n < 2 THEN 15 ELSE 0 END - CASE WHEN tw < 500 THEN 30 WHEN tw < 2000 THEN 10 ELSE 0 END END
         - e * 5 - CASE WHEN cover THEN 0 ELSE 10 END - CASE WHEN low THEN 20 ELSE 0 END - CASE WHEN k > 0 THEN 15 ELSE 0 END END - CASE WHEN nf >= 4 THEN CASE WHEN cv > 2.0 THEN 10 WHEN cv > 1.5 THEN 5 ELSE 0 END ELSE 0 END AS sc FROM a),
       s2 AS (SELECT *, greatest(0, least(100, CASE WHEN r >= n * 0.5 AND n > 0 THEN least(sc, 30) ELSE sc - floor(coalesce(r / nullif(n, 0), 0) * 40 + 0.5) END))::INTEGER AS score FROM s1)
       SELECT book_id, score, CASE WHEN score >= 80 THEN 'auto_approved' WHEN score >= 60 THEN 'needs_review' ELSE 'rejected' END AS tier, score >= 60 AS passed,
       array_to_string(list_filter([CASE WHEN n = 0 THEN 'no_chapters' END, CASE WHEN n = 1 THEN 'few_chapters' END, CASE WHEN tw > 2000000 THEN 'impossible_size' END, CASE WHEN tw < 500 THEN 'very_few_characters' END, CASE WHEN tw BETWEEN 500 AND 1999 THEN 'few_characters' END,
       CASE WHEN e > 0 THEN 'empty_chapters' END, CASE WHEN NOT cover THEN 'no_cover' END, CASE WHEN low THEN 'low_cjk_ratio' END, CASE WHEN k > 0 THEN 'encoding' END, CASE WHEN dc > 0 THEN 'equal_chapters' END, CASE WHEN nf >= 4 AND cv > 1.5 THEN 'length_variation' END,
       CASE WHEN r > 0 THEN 'residue' END], lambda v: v IS NOT NULL), ',') AS issues FROM s2"""
)
def quality_scores_zh(s, d):
    """Books with a Chinese source; a described one has its cover."""
    b = T(s, d, "books").where("zh_source_id is not null").select(F.col("id").alias("book_id"), F.col("description").isNotNull().alias("has_cover")).distinct()
    return quality.chinese_quality(b, _zh(s, d), PUBLISHER).withColumn("issues", F.array_join("issues", ","))


@query(
    rf"""SELECT b.id, array_to_string(list_filter([CASE WHEN x.signs > 0 AND x.size / x.signs < 0.5 THEN 'low_cjk_ratio' END, CASE WHEN b.chapter_count > 0 AND coalesce(b.word_count, 0) / b.chapter_count < 200 THEN 'short_chapters' END], lambda v: v IS NOT NULL), ',') AS flags
       FROM (SELECT DISTINCT id, word_count, chapter_count FROM books WHERE language = 'zh') b LEFT JOIN (SELECT book_id, len(regexp_extract_all(left(t, 5000), '{_CJK}')) AS size, length(regexp_replace(left(t, 5000), '[{_WS}]', '', 'g')) AS signs FROM
       (SELECT book_id, arg_min({_ZH_TEXT}, (order_num, id)) AS t FROM zh_chapters WHERE html_content IS NOT NULL GROUP BY 1) q) x ON x.book_id = b.id"""
)
def quality_flags_zh(s, d):
    first = _zh(s, d).where("html_content is not null").groupBy(F.col("book_id").alias("f_book")).agg(F.min_by("html_content", F.struct("order_num", "id")).alias("html"))
    head = F.left(X.strip_html(F.col("html")), F.lit(5000))
    first = first.select("f_book", X.count_cjk(head).alias("size"), X.count_nonspace(head).alias("signs"))
    b = T(s, d, "books").where("language = 'zh'").select("id", "word_count", "chapter_count").distinct().join(first, F.col("id") == F.col("f_book"), "left")
    flags = F.array_compact(
        F.array(
            F.when((F.col("signs") > 0) & (F.try_divide("size", "signs") < 0.5), "low_cjk_ratio"),
            F.when((F.col("chapter_count") > 0) & (F.try_divide(F.coalesce("word_count", F.lit(0)), F.col("chapter_count")) < 200), "short_chapters"),
        )
    )
    return b.select("id", F.array_join(flags, ",").alias("flags"))


@query()
def detected_chapters(s, d):
    return quality.detected_chapters(T(s, d, "raw_bodies").where("html_content is not null").select(F.col("body_id").alias("key"), F.col("html_content").alias("html")).dropDuplicates(["key"]))


@query(
    """SELECT b.id, (floor(((c.w - coalesce(b.word_count, 0)) / (CASE WHEN coalesce(b.word_count, 0) = 0 THEN 1 ELSE b.word_count END)) * 10000 + 0.5) / 10000)::DOUBLE AS difference,
       abs((c.w - coalesce(b.word_count, 0)) / (CASE WHEN coalesce(b.word_count, 0) = 0 THEN 1 ELSE b.word_count END)) <= 0.15 AND coalesce(b.quality_score, 0) >= 80 AS passed
       FROM (SELECT DISTINCT id, word_count, quality_score FROM books) b JOIN (SELECT book_id, sum(word_count) AS w FROM (SELECT DISTINCT id, book_id, word_count FROM chapters) q GROUP BY 1) c ON c.book_id = b.id WHERE c.w IS NOT NULL"""
)
def calibrate(s, d):
    words = T(s, d, "chapters").select("id", "book_id", "word_count").distinct().groupBy("book_id").agg(F.sum("word_count").alias("words")).where("words is not null")
    b = T(s, d, "books").select("id", "word_count", "quality_score").distinct()
    pairs = b.join(words, F.col("id") == F.col("book_id")).select(F.col("id").alias("key"), "words", F.coalesce("word_count", F.lit(0)).alias("truth"), F.coalesce("quality_score", F.lit(0.0)).alias("score"))
    return quality.calibration(pairs).withColumnRenamed("key", "id")


@query()
def process_chapters(s, d):
    """Clean, typographic, modernised, semantically marked and language-tagged chapters with their captions and counts, in one narrow pass."""
    c = spread(T(s, d, "chapters").where("html_content is not null").select("id", "book_id", "order_num", F.lit(None).cast("string").alias("title"), "html_content"))
    return whole_books.cleaned_chapters(c, PUBLISHER, vocabulary.english_words(c)).drop("title")


@query()
def process_books(s, d):
    """Whole English books from the chapters table; a book with a number in the source catalogue has its cover there."""
    b = T(s, d, "books").where("zh_source_id is null").select(F.col("id").alias("book_id"), F.col("pg_id").isNotNull().alias("has_cover")).distinct()
    c = T(s, d, "chapters").select("id", "book_id", "order_num", "title", "html_content").dropDuplicates(["id"])
    return whole_books.english_books(b, c, PUBLISHER, vocabulary.english_words(c))
