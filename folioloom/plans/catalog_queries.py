"""Catalogue queries: filters, joins, aggregates, windows, paging, sets and writes, each with SQL.

The order and event tables stand in for jobs: orders are jobs, lineitem the bridge
between suppliers (authors) and parts (books).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioloom.functions import metrics as M
from folioloom.functions import text as X
from folioloom.operators import catalog as C
from folioloom.session import read_table

#: The publisher whose notices the queries look for, as the test tables name it.
PUBLISHER = X.Publisher("Quarto Reading Rooms", "quarto.example")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    """Registers a query under its function's name, with the SQL that states the same."""

    def keep(run: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[run.__name__] = run
        if sql:
            SQL[run.__name__] = sql
        return run

    return keep


def T(spark: SparkSession, d: str, name: str) -> DataFrame:
    return read_table(spark, d, name)


def books(s: SparkSession, d: str) -> DataFrame:
    return T(s, d, "books").dropDuplicates(["id"])


def chapters(s: SparkSession, d: str, *columns: str) -> DataFrame:
    return T(s, d, "chapters").select("id", "book_id", "order_num", *columns).dropDuplicates(["id"])


BOOKS = "(SELECT DISTINCT * FROM books) b"


def CH(*columns: str) -> str:
    return f"(SELECT DISTINCT id, book_id, order_num{''.join(', ' + c for c in columns)} FROM chapters) c"


# ---- filters and projections


@query("SELECT id, title, status FROM books WHERE status = 'ready' AND language = 'en'")
def flt_eq(s, d):
    return T(s, d, "books").where("status = 'ready' and language = 'en'").select("id", "title", "status")


@query("SELECT id, status FROM books WHERE status IN ('ready', 'approved')")
def flt_default_status(s, d):
    return T(s, d, "books").where(F.col("status").isin("ready", "approved")).select("id", "status")


@query("SELECT id, title, author FROM books WHERE title ILIKE '%king%' OR author ILIKE '%king%'")
def flt_search(s, d):
    return C.search(T(s, d, "books"), "king", "title", "author").select("id", "title", "author")


@query("SELECT id, dynasty FROM books WHERE dynasty IS DISTINCT FROM '清'")
def flt_cover_source(s, d):
    return T(s, d, "books").where(~F.col("dynasty").eqNullSafe("清")).select("id", "dynasty")


@query("SELECT id FROM books WHERE description IS NULL AND ai_tags IS NULL")
def flt_null(s, d):
    return T(s, d, "books").where(F.col("description").isNull() & F.col("ai_tags").isNull()).select("id")


@query("SELECT id, cefr_level FROM books WHERE cefr_level IS NOT NULL")
def flt_not_null(s, d):
    return T(s, d, "books").where(F.col("cefr_level").isNotNull()).select("id", "cefr_level")


@query("SELECT id, pg_id FROM books WHERE status = 'ready' AND word_count >= 1000 AND language = 'en'")
def flt_conjunction(s, d):
    df = T(s, d, "books")
    return C.where_all(df, F.col("status") == "ready", F.col("word_count") >= 1000, None, F.col("language") == "en").select("id", "pg_id")


@query("SELECT id, pg_id FROM books WHERE pg_id IN (3, 7, 11, 500)")
def flt_in(s, d):
    return C.ids_from_text(T(s, d, "books"), "3, 7,x,11,500,", "pg_id").select("id", "pg_id")


@query("SELECT id, pipeline_version FROM books WHERE pipeline_version < 3 OR pipeline_version IS NULL")
def flt_stale(s, d):
    return T(s, d, "books").where("pipeline_version < 3 or pipeline_version is null").select("id", "pipeline_version")


@query("SELECT id, source_type FROM books WHERE source_type <> 'quarto'")
def flt_ne(s, d):
    return T(s, d, "books").where(F.col("source_type") != "quarto").select("id", "source_type")


@query("SELECT record_id, download_count FROM gutendex_authors WHERE download_count >= 100 AND name IS NOT NULL")
def flt_min_downloads(s, d):
    return T(s, d, "gutendex_authors").where("download_count >= 100 and name is not null").select("record_id", "download_count")


@query("SELECT id, coalesce(nullif(title, ''), 'Unknown') AS title, coalesce(nullif(author, ''), 'Unknown') AS author, coalesce(word_count, 0) AS word_count FROM books")
def flt_projection_defaults(s, d):
    fall = lambda c: F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit("Unknown")).alias(c)
    return T(s, d, "books").select("id", fall("title"), fall("author"), F.coalesce("word_count", F.lit(0)).alias("word_count"))


@query(
    """SELECT id, array_to_string(list_filter([CASE WHEN coalesce(title, '') = '' THEN 'missing_title' END, CASE WHEN coalesce(author, '') = '' THEN 'missing_author' END,
       CASE WHEN coalesce(chapter_count, 0) = 0 THEN 'no_chapters' END, CASE WHEN coalesce(word_count, 0) < 1000 THEN 'insufficient_word_count' END], lambda x: x IS NOT NULL), ',') AS issues FROM books"""
)
def flt_validate(s, d):
    empty = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    issues = F.array_compact(
        F.array(
            F.when(empty("title"), "missing_title"),
            F.when(empty("author"), "missing_author"),
            F.when(F.coalesce("chapter_count", F.lit(0)) == 0, "no_chapters"),
            F.when(F.coalesce("word_count", F.lit(0)) < 1000, "insufficient_word_count"),
        )
    )
    return T(s, d, "books").select("id", F.array_join(issues, ",").alias("issues"))


@query(r"SELECT id, href FROM chapters WHERE regexp_matches(href, 'ch\d+\.')")
def flt_regex(s, d):
    return T(s, d, "chapters").where(F.col("href").rlike(r"ch\d+\.")).select("id", "href")


@query(
    """SELECT id, CAST(coalesce(try_strptime(created_at, '%Y-%m-%dT%H:%M:%S.%gZ'), try_strptime(created_at, '%Y-%m-%d %H:%M:%S')) AS DATE) AS created_on FROM books"""
)
def flt_two_time_formats(s, d):
    return T(s, d, "books").select("id", F.to_date(C.parse_time(F.col("created_at"))).alias("created_on"))


# ---- joins


@query("SELECT g.record_id, g.author_pos, a.id AS author_id FROM gutendex_authors g JOIN authors a ON g.name = a.name")
def join_book_authors(s, d):
    a = T(s, d, "authors").select(F.col("id").alias("author_id"), F.col("name").alias("a_name"))
    return T(s, d, "gutendex_authors").join(a, F.col("name") == F.col("a_name")).select("record_id", "author_pos", "author_id")


@query("SELECT DISTINCT g.name, b.id AS book_id, b.title FROM gutendex_authors g JOIN books b ON g.pg_id = b.pg_id")
def join_author_books(s, d):
    b = T(s, d, "books").select(F.col("id").alias("book_id"), "title", F.col("pg_id").alias("b_pg"))
    return T(s, d, "gutendex_authors").join(b, F.col("pg_id") == F.col("b_pg")).select("name", "book_id", "title").distinct()


@query("SELECT record_id, pg_id FROM gutendex_authors g WHERE NOT EXISTS (SELECT 1 FROM books b WHERE b.pg_id = g.pg_id) AND NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderstatus = 'P' AND o.o_custkey = g.pg_id)")
def anti_existing(s, d):
    known = T(s, d, "books").select(F.col("pg_id").cast("long")).where("pg_id is not null")
    synced = T(s, d, "orders").where("o_orderstatus = 'P'").select("o_custkey")
    return C.anti(T(s, d, "gutendex_authors"), "pg_id", known, synced).select("record_id", "pg_id")


@query("SELECT p_partkey FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 48 UNION SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def anti_union(s, d):
    return C.anti(T(s, d, "part"), "p_partkey", T(s, d, "lineitem").where("l_quantity > 48").select("l_partkey"), T(s, d, "orders").where("o_orderstatus = 'P'").select("o_custkey")).select("p_partkey")


@query("SELECT id, pg_id FROM books WHERE pg_id IN (SELECT pg_id FROM gutendex_authors)")
def semi_exists(s, d):
    return C.semi(T(s, d, "books"), "pg_id", T(s, d, "gutendex_authors").select("pg_id")).select("id", "pg_id")


@query("SELECT c_custkey FROM customer c WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderstatus IN ('O', 'P'))")
def anti_active_jobs(s, d):
    active = T(s, d, "orders").where(F.col("o_orderstatus").isin("O", "P")).select("o_custkey")
    return C.anti(T(s, d, "customer"), "c_custkey", active).select("c_custkey")


@query(
    f"""SELECT b.id, coalesce(string_agg(c.order_num || ':' || c.id, ',' ORDER BY c.order_num, c.id), '') AS chapters, count(c.id) AS n
       FROM {BOOKS} LEFT JOIN {CH()} ON c.book_id = b.id GROUP BY b.id"""
)
def nest_children(s, d):
    nested = C.nest(books(s, d).select(F.col("id").alias("book")), "book", chapters(s, d), "book_id", "order_num", ["id"], "chapters")
    shown = F.array_join(F.transform("chapters", lambda c: F.concat_ws(":", c["order_num"].cast("string"), c["id"])), ",")
    return nested.select(F.col("book").alias("id"), shown.alias("chapters"), F.size("chapters").cast("long").alias("n"))


@query("SELECT b.id, coalesce(z.category, 'none') AS category FROM books b LEFT JOIN (SELECT DISTINCT id, category FROM zh_sources) z ON b.zh_source_id = z.id")
def bonus_lookup(s, d):
    z = T(s, d, "zh_sources").select(F.col("id").alias("z_id"), "category").distinct()
    return T(s, d, "books").join(z, F.col("zh_source_id") == F.col("z_id"), "left").select("id", F.coalesce("category", F.lit("none")).alias("category"))


@query("SELECT z.id, z.source_book_id, b.id AS book_id FROM zh_sources z JOIN books b ON b.zh_source_id = z.id AND replace(z.source_book_id, '_', '/') <> '' WHERE z.status IN ('downloaded', 'cleaned', 'enriched', 'synced')")
def slug_join(s, d):
    b = T(s, d, "books").select(F.col("id").alias("book_id"), "zh_source_id")
    z = T(s, d, "zh_sources").where(F.col("status").isin("downloaded", "cleaned", "enriched", "synced"))
    z = z.where(F.replace(F.col("source_book_id"), F.lit("_"), F.lit("/")) != "")
    return z.join(b, F.col("id") == F.col("zh_source_id")).select("id", "source_book_id", "book_id")


# ---- aggregates


@query("SELECT count(*) AS total FROM books WHERE status = 'ready'")
def agg_count(s, d):
    return T(s, d, "books").where("status = 'ready'").agg(F.count("*").alias("total"))


@query(
    """SELECT 'total' AS kind, NULL AS value, count(*) AS n FROM books UNION ALL SELECT 'status', status, count(*) FROM books WHERE status IS NOT NULL GROUP BY status
       UNION ALL SELECT 'language', language, count(*) FROM books WHERE language IS NOT NULL GROUP BY language"""
)
def agg_stats(s, d):
    sets = T(s, d, "books").groupingSets([[], ["status"], ["language"]], "status", "language").agg(F.count("*").alias("n"), F.grouping_id().alias("g"))
    kind = F.when(F.col("g") == 3, "total").when(F.col("g") == 1, "status").otherwise("language")
    value = F.when(F.col("g") == 1, F.col("status")).when(F.col("g") == 2, F.col("language"))
    return sets.select(kind.alias("kind"), value.alias("value"), "n").where("kind = 'total' or value is not null")


@query("SELECT cefr_level, count(*) AS n FROM books WHERE cefr_level IS NOT NULL GROUP BY cefr_level")
def agg_cefr(s, d):
    return T(s, d, "books").where("cefr_level is not null").groupBy("cefr_level").agg(F.count("*").alias("n"))


_CATEGORY = "CASE WHEN contains(x, 'fiction') AND NOT contains(x, 'non-fiction') AND NOT contains(x, 'science fiction') THEN 'Fiction' " + " ".join(
    "WHEN " + " OR ".join(f"contains(x, '{p}')" for p in parts) + f" THEN '{name}'" for name, parts in M.CATEGORIES
) + " END"


@query(
    f"""SELECT category, count(*) AS n FROM (SELECT {_CATEGORY} AS category FROM (SELECT lower(unnest(from_json(CASE WHEN json_valid(subjects) AND json_type(subjects) = 'ARRAY' THEN subjects END, '["VARCHAR"]'))) AS x FROM books)) t
       WHERE category IS NOT NULL GROUP BY category"""
)
def agg_subjects(s, d):
    parsed = F.from_json("subjects", "array<string>", {"allowSingleQuotes": "false"})
    each = T(s, d, "books").select(F.explode(parsed).alias("subject"))
    return each.select(M.subject_category(F.col("subject")).alias("category")).where("category is not null").groupBy("category").agg(F.count("*").alias("n"))


@query(f"SELECT book_id, CAST(sum(word_count) AS BIGINT) AS words, count(*) AS n FROM {CH('word_count')} GROUP BY book_id")
def agg_word_totals(s, d):
    return chapters(s, d, "word_count").groupBy("book_id").agg(F.sum("word_count").alias("words"), F.count("*").alias("n"))


@query(f"SELECT book_id, round(stddev_pop(word_count) / avg(word_count), 6) AS cv FROM {CH('word_count')} WHERE word_count > 0 GROUP BY book_id HAVING count(*) >= 4")
def agg_cv(s, d):
    g = chapters(s, d, "word_count").where("word_count > 0").groupBy("book_id")
    return g.agg(F.round(F.stddev_pop("word_count") / F.avg("word_count"), 6).alias("cv"), F.count("*").alias("n")).where("n >= 4").drop("n")


@query(
    f"""SELECT book_id, count(*) AS repeated FROM (SELECT book_id, p, count(*) AS n FROM (SELECT book_id, lower(trim(regexp_replace(unnest(regexp_extract_all(html_content, '(?is)<p[^>]*>.*?</p>')), '<[^>]+>', '', 'g'))) AS p
       FROM {CH('html_content')}) t WHERE length(p) > 50 GROUP BY book_id, p HAVING count(*) >= 2) u GROUP BY book_id"""
)
def agg_dup_paragraphs(s, d):
    p = F.explode(F.regexp_extract_all("html_content", F.lit(r"(?is)<p[^>]*>.*?</p>"), F.lit(0))).alias("p")
    plain = chapters(s, d, "html_content").select("book_id", p).select("book_id", F.lower(F.trim(F.regexp_replace("p", "<[^>]+>", ""))).alias("p"))
    twice = plain.where(F.length("p") > 50).groupBy("book_id", "p").agg(F.count("*").alias("n")).where("n >= 2")
    return twice.groupBy("book_id").agg(F.count("*").alias("repeated"))


_WS = X.WS
_DROP = r"regexp_replace(regexp_replace(html_content, '(?is)<style[^>]*>.*?</style>', '', 'g'), '(?is)<script[^>]*>.*?</script>', '', 'g')"
STRIP = rf"trim(regexp_replace(regexp_replace({_DROP}, '<[^>]+>', ' ', 'g'), '[{_WS}]+', ' ', 'g'))"


@query(
    f"""SELECT book_id, sum(n)::BIGINT AS members, count(*) AS groups FROM (SELECT book_id, sha1(t) AS h, count(*) AS n FROM (SELECT book_id, regexp_replace(lower({STRIP}), '[{_WS}]+', '', 'g') AS t FROM {CH('html_content')}) x
       WHERE length(t) >= 100 GROUP BY book_id, h HAVING count(*) > 1) y GROUP BY book_id"""
)
def agg_dup_chapters(s, d):
    t = F.regexp_replace(F.lower(X.strip_html(F.col("html_content"))), rf"[{_WS}]+", "")
    hashed = chapters(s, d, "html_content").select("book_id", t.alias("t")).where(F.length("t") >= 100).select("book_id", F.sha1("t").alias("h"))
    groups = hashed.groupBy("book_id", "h").agg(F.count("*").alias("n")).where("n > 1")
    return groups.groupBy("book_id").agg(F.sum("n").alias("members"), F.count("*").alias("groups"))


@query(
    f"""SELECT book_id, t AS title, n FROM (SELECT book_id, lower(trim(title)) AS t, count(*) AS n FROM {CH('title')} GROUP BY book_id, t) x WHERE t <> '' AND n > 1"""
)
def agg_dup_titles(s, d):
    t = F.lower(F.trim("title"))
    return chapters(s, d, "title").select("book_id", t.alias("title")).where("title != ''").groupBy("book_id", "title").agg(F.count("*").alias("n")).where("n > 1")


@query(f"SELECT book_id, count(*) FILTER (word_count < 50) AS empties FROM {CH('word_count')} GROUP BY book_id")
def agg_empty(s, d):
    return chapters(s, d, "word_count").groupBy("book_id").agg(F.count_if(F.col("word_count") < 50).alias("empties"))


@query(
    """SELECT doc_a AS doc_id, round(sum(abs(coalesce(a, 0) - coalesce(b, 0))) / sum(coalesce(a, 0) + coalesce(b, 0)), 6) AS difference FROM (
       SELECT coalesce(x.book_id, y.book_id) AS doc_a, a, b FROM
       (SELECT book_id, w, count(*) AS a FROM (SELECT book_id, unnest(string_split(lower(title), ' ')) AS w FROM (SELECT DISTINCT id, book_id, title FROM chapters)) t WHERE book_id IS NOT NULL GROUP BY 1, 2) x FULL OUTER JOIN
       (SELECT book_id, w, count(*) AS b FROM (SELECT id AS book_id, unnest(string_split(lower(title), ' ')) AS w FROM (SELECT DISTINCT id, title FROM books)) t GROUP BY 1, 2) y ON x.book_id = y.book_id AND x.w = y.w) z GROUP BY doc_a"""
)
def agg_multiset_diff(s, d):
    w = lambda df, k: df.select(F.col(k).alias("doc_id"), F.explode(F.split(F.lower("title"), " ")).alias("w"))
    left = w(T(s, d, "chapters").select("id", "book_id", "title").where("book_id is not null").dropDuplicates(["id"]), "book_id")
    out = C.multiset_difference(left, w(books(s, d), "id"), "doc_id", "w")
    return out.select("doc_id", F.round("difference", 6).alias("difference"))


@query(
    """SELECT pipeline_version, round(ok / n, 6) AS rate, round(sum(ok) OVER w / sum(n) OVER w, 6) AS cumulative FROM (SELECT pipeline_version, count(*) AS n, count(*) FILTER (quality_score >= 80) AS ok
       FROM books WHERE pipeline_version IS NOT NULL GROUP BY 1) t WINDOW w AS (ORDER BY pipeline_version ROWS UNBOUNDED PRECEDING)"""
)
def agg_passrate(s, d):
    per = T(s, d, "books").where("pipeline_version is not null").groupBy("pipeline_version").agg(F.count("*").alias("n"), F.count_if(F.col("quality_score") >= 80).alias("ok"))
    w = Window.orderBy("pipeline_version").rowsBetween(Window.unboundedPreceding, 0)  # one row per version
    return per.select("pipeline_version", F.round(F.col("ok") / F.col("n"), 6).alias("rate"), F.round(F.sum("ok").over(w) / F.sum("n").over(w), 6).alias("cumulative"))


@query(
    """SELECT status, count(*) AS n, CAST(sum(word_count) AS BIGINT) AS words, round(avg(quality_score), 6) AS quality FROM books GROUP BY status"""
)
def agg_quality_report(s, d):
    return T(s, d, "books").groupBy("status").agg(F.count("*").alias("n"), F.sum("word_count").alias("words"), F.round(F.avg("quality_score"), 6).alias("quality"))


@query("SELECT id, list_min(v) AS lowest, list_max(v) AS highest FROM (SELECT id, list_transform(regexp_extract_all(html_content, '(?i)<h([1-6])', 1), lambda x: CAST(x AS INTEGER)) AS v FROM chapters) t WHERE len(v) > 0")
def agg_array_extremes(s, d):
    levels = F.transform(F.regexp_extract_all("html_content", F.lit("(?i)<h([1-6])"), F.lit(1)), lambda x: x.cast("int"))
    df = T(s, d, "chapters").select("id", levels.alias("v")).where(F.size("v") > 0)
    return df.select("id", F.array_min("v").alias("lowest"), F.array_max("v").alias("highest"))


# ---- windows


@query(f"SELECT id, lag(id) OVER w AS previous, lead(id) OVER w AS next FROM {CH()} WINDOW w AS (PARTITION BY book_id ORDER BY order_num, id)")
def win_prev_next(s, d):
    w = Window.partitionBy("book_id").orderBy("order_num", "id")
    return chapters(s, d).select("id", F.lag("id").over(w).alias("previous"), F.lead("id").over(w).alias("next"))


@query(f"SELECT id, row_number() OVER (PARTITION BY book_id ORDER BY order_num, id) AS position FROM {CH('word_count')} WHERE word_count >= 100")
def win_renumber(s, d):
    return C.renumber(chapters(s, d, "word_count").where("word_count >= 100"), "book_id", F.col("order_num"), F.col("id")).select("id", F.col("position").cast("long").alias("position"))


@query(
    f"""WITH m AS (SELECT *, (coalesce(word_count, 0) < 300 AND NOT regexp_matches(coalesce(title, ''), '(?i)chapter'))::INT AS g FROM {CH('word_count', 'title')}),
       n AS (SELECT *, row_number() OVER a AS f, row_number() OVER b AS e, min(g) OVER (a ROWS UNBOUNDED PRECEDING) AS p, min(g) OVER (b ROWS UNBOUNDED PRECEDING) AS q, count(*) OVER (PARTITION BY book_id) AS c
       FROM m WINDOW a AS (PARTITION BY book_id ORDER BY order_num, id), b AS (PARTITION BY book_id ORDER BY order_num DESC, id DESC)),
       k AS (SELECT *, c > 3 AND ((p = 1 AND f <= 3) OR (q = 1 AND e <= 3)) AS goes FROM n), z AS (SELECT *, sum((NOT goes)::INT) OVER (PARTITION BY book_id) AS l FROM k) SELECT id, book_id FROM z WHERE NOT goes OR l = 0"""
)
def win_edge_trim(s, d):
    can_go = (F.coalesce("word_count", F.lit(0)) < 300) & ~F.coalesce("title", F.lit("")).rlike("(?i)chapter")
    return C.edge_trim(chapters(s, d, "word_count", "title"), "book_id", can_go, [F.col("order_num"), F.col("id")]).select("id", "book_id")


@query(
    f"""SELECT id FROM (SELECT id, row_number() OVER (PARTITION BY book_id, k ORDER BY order_num, id) AS r FROM (SELECT *, left({STRIP}, 500) AS k FROM {CH('html_content')}) t WHERE k <> '') u WHERE r = 1"""
)
def win_first_dedup(s, d):
    df = chapters(s, d, "html_content")
    return C.first_of_equal(df, "book_id", F.left(X.strip_html(F.col("html_content")), F.lit(500)), F.col("order_num"), F.col("id")).select("id")


@query(
    f"""SELECT book_id, p + 1 AS missing FROM (SELECT book_id, n, lag(n) OVER (PARTITION BY book_id ORDER BY n) AS p, count(*) OVER (PARTITION BY book_id) AS m FROM
       (SELECT book_id, try_cast(nullif(regexp_extract(title, '(?i)\\bchapter\\s+(\\d+)\\b', 1), '') AS INTEGER) AS n FROM {CH('title')}) t WHERE n IS NOT NULL) u WHERE m >= 3 AND n - p > 1"""
)
def win_seq_gaps(s, d):
    number = F.nullif(F.regexp_extract("title", r"(?i)\bchapter\s+(\d+)\b", 1), F.lit("")).try_cast("int")
    return C.sequence_gaps(chapters(s, d, "title").withColumn("n", number), "book_id", "n")


@query(
    f"""SELECT book_id, lw AS last_words FROM (SELECT book_id, count(*) AS n, avg(coalesce(word_count, 0)) AS a, max_by(coalesce(word_count, 0), order_num * 1000000 + CAST(substr(id, 2) AS BIGINT) % 1000000) AS lw FROM {CH('word_count')} GROUP BY book_id) t
       WHERE n >= 3 AND lw < 0.3 * a AND lw < 200"""
)
def win_last_truncated(s, d):
    words = F.coalesce("word_count", F.lit(0))
    place = F.col("order_num") * 1000000 + F.substring("id", 2, 20).cast("long") % 1000000
    g = chapters(s, d, "word_count").groupBy("book_id").agg(F.count("*").alias("n"), F.avg(words).alias("a"), F.max_by(words, place).alias("last_words"))
    return g.where("n >= 3 and last_words < 0.3 * a and last_words < 200").select("book_id", "last_words")


@query(
    f"""SELECT id FROM (SELECT id, row_number() OVER (PARTITION BY book_id ORDER BY order_num, id) - 1 AS i, count(*) OVER (PARTITION BY book_id) AS n FROM {CH()}) t
       WHERE n <= 5 OR (i % (n // 5) = 0 AND i // (n // 5) < 5)"""
)
def win_sample_chapters(s, d):
    df = C.renumber(chapters(s, d), "book_id", F.col("order_num"), F.col("id")).withColumn("n", F.count("*").over(Window.partitionBy("book_id")))
    return df.where("n <= 5 or ((position - 1) % floor(n / 5) = 0 and floor((position - 1) / floor(n / 5)) < 5)").select("id")


@query(
    f"""WITH first AS (SELECT book_id, min_by(html_content, order_num * 1000000 + CAST(substr(id, 2) AS BIGINT) % 1000000) AS html_content FROM {CH('html_content')} GROUP BY book_id) SELECT book_id, md5(left({STRIP}, 2000)) AS sample FROM first WHERE html_content IS NOT NULL"""
)
def first_chapter_sample(s, d):
    place = F.col("order_num") * 1000000 + F.substring("id", 2, 20).cast("long") % 1000000
    first = chapters(s, d, "html_content").groupBy("book_id").agg(F.min_by("html_content", place).alias("html"))
    return first.where("html is not null").select("book_id", F.md5(F.left(X.strip_html(F.col("html")), F.lit(2000))).alias("sample"))


@query(
    """WITH p AS (SELECT o_custkey // 10 AS page, bool_and(o_totalprice < 150000) AS known FROM orders GROUP BY 1), i AS (SELECT *, sum((NOT known)::INT) OVER (ORDER BY page) AS g FROM p),
       r AS (SELECT *, sum(known::INT) OVER (PARTITION BY g ORDER BY page) AS run FROM i), q AS (SELECT *, max((run >= 3)::INT) OVER (ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS stopped FROM r)
       SELECT CAST(page AS BIGINT) AS page, known FROM q WHERE coalesce(stopped, 0) = 0"""
)
def win_early_stop(s, d):
    pages = T(s, d, "orders").groupBy(F.floor(F.col("o_custkey") / 10).alias("page")).agg(F.bool_and(F.col("o_totalprice") < 150000).alias("known"))
    return C.stop_after_known(pages, "page", "known", 3)


@query(
    """SELECT event_id, last_value(CASE WHEN event_type = 'signup' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS signup FROM events"""
)
def win_fill_down(s, d):
    df = T(s, d, "events").withColumn("mark", F.when(F.col("event_type") == "signup", F.col("event_id")))
    return C.fill_down(df, "user_id", "event_id", "mark", "signup").select("event_id", "signup")


@query(
    """WITH o AS (SELECT DISTINCT l_orderkey AS g, CAST(l_quantity AS INTEGER) AS a FROM lineitem), e AS (SELECT g, a, lead(a) OVER (PARTITION BY g ORDER BY a) AS b FROM o)
       SELECT l.l_orderkey, l.l_linenumber, coalesce(e.b, 100) AS segment_end FROM lineitem l JOIN e ON e.g = l.l_orderkey AND e.a = CAST(l.l_quantity AS INTEGER)"""
)
def win_segment_ends(s, d):
    df = T(s, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").cast("int").alias("a"))
    return C.segment_ends(df, "l_orderkey", "a", F.lit(100)).select("l_orderkey", "l_linenumber", "segment_end")


# ---- order, limits, sets


@query("SELECT id, title FROM books ORDER BY id, title LIMIT 20 OFFSET 20")
def page_books(s, d):
    return C.page(T(s, d, "books").select("id", "title"), 2, 20, F.col("id"), F.col("title"))


@query("SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderstatus = 'O' ORDER BY o_orderpriority, o_orderkey LIMIT 100")
def topk_jobs(s, d):
    return T(s, d, "orders").where("o_orderstatus = 'O'").orderBy("o_orderpriority", "o_orderkey").limit(100).select("o_orderkey", "o_orderpriority")


@query("SELECT id, quality_score FROM (SELECT DISTINCT id, quality_score FROM books) t ORDER BY quality_score DESC NULLS LAST, id LIMIT 30")
def topk_quality(s, d):
    df = T(s, d, "books").select("id", "quality_score").distinct()
    return df.orderBy(F.col("quality_score").desc_nulls_last(), "id").limit(30)


@query(f"SELECT book_id, string_agg(id, ',' ORDER BY order_num, id) AS ordered FROM {CH()} GROUP BY book_id")
def order_children(s, d):
    g = chapters(s, d).groupBy("book_id").agg(F.sort_array(F.collect_list(F.struct("order_num", "id"))).alias("x"))
    return g.select("book_id", F.array_join("x.id", ",").alias("ordered"))


@query("SELECT CAST(ceil(count(*) / 32.0) AS BIGINT) AS pages FROM books")
def page_count(s, d):
    return T(s, d, "books").agg(F.ceil(F.count("*") / 32).alias("pages"))


@query("SELECT pg_id AS id FROM books WHERE pg_id IS NOT NULL UNION SELECT pg_id FROM gutendex_authors WHERE pg_id IS NOT NULL")
def set_union_ids(s, d):
    a, b = (T(s, d, t).select(F.col("pg_id").alias("id")).where("id is not null") for t in ("books", "gutendex_authors"))
    return a.union(b).distinct()


@query("SELECT pg_id AS id FROM gutendex_authors WHERE pg_id IS NOT NULL EXCEPT SELECT pg_id FROM books")
def set_diff(s, d):
    return T(s, d, "gutendex_authors").select(F.col("pg_id").alias("id")).where("id is not null").subtract(T(s, d, "books").select(F.col("pg_id").alias("id")))


_TOK = r"""list_distinct(list_filter(string_split(trim(regexp_replace(regexp_replace(lower({0}), '[;:,.''"!?—–-]', ' ', 'g'), '\s+', ' ', 'g')), ' '), lambda w: length(w) > 1 AND w NOT IN ('the','a','an','of','and','or','in','on','to','for')))"""


@query(
    f"""WITH b AS (SELECT DISTINCT id, {_TOK.format('title')} AS t FROM books WHERE title IS NOT NULL), s AS (SELECT x.id AS a, y.id AS b, len(list_intersect(x.t, y.t)) / (len(x.t) + len(y.t) - len(list_intersect(x.t, y.t))) AS score
       FROM b x JOIN b y ON x.id <> y.id AND len(list_intersect(x.t, y.t)) > 0), r AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY score DESC, b) AS k FROM s)
       SELECT a AS id, max(CASE WHEN k = 1 THEN b END) AS best, round(max(CASE WHEN k = 1 THEN score END), 6) AS best_score, max(CASE WHEN k = 2 THEN b END) AS runner_up, round(max(CASE WHEN k = 2 THEN score END), 6) AS runner_score
       FROM r WHERE k <= 2 GROUP BY a"""
)
def fuzzy_jaccard(s, d):
    b = T(s, d, "books").where("title is not null").select("id", M.title_tokens(F.col("title")).alias("tokens")).dropDuplicates(["id"])
    top = C.top_two_matches(b, "id", "tokens")
    return top.select("id", "best", F.round("best_score", 6).alias("best_score"), "runner_up", F.round("runner_score", 6).alias("runner_score"))


# ---- writes, as before and after frames


@query(
    """SELECT coalesce(a.c_custkey, p.c_custkey) AS c_custkey, coalesce(p.c_name, a.c_name) AS c_name, a.c_mktsegment FROM customer a FULL OUTER JOIN
       (SELECT c_custkey + 1000 AS c_custkey, CASE WHEN c_custkey % 2 = 0 THEN upper(c_name) END AS c_name FROM customer) p ON a.c_custkey = p.c_custkey"""
)
def upsert_books(s, d):
    stored = T(s, d, "customer").select("c_custkey", "c_name", "c_mktsegment")
    patch = stored.select((F.col("c_custkey") + 1000).alias("c_custkey"), F.when(F.col("c_custkey") % 2 == 0, F.upper("c_name")).alias("c_name"))
    return C.upsert(stored, patch, "c_custkey")


@query(
    """SELECT o_orderkey, CASE WHEN o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') THEN 'F' ELSE o_orderstatus END AS o_orderstatus FROM orders"""
)
def batch_status(s, d):
    ids = T(s, d, "lineitem").where("l_returnflag = 'R'").select("l_orderkey")
    return C.set_values(T(s, d, "orders").select("o_orderkey", "o_orderstatus"), "o_orderkey", ids, o_orderstatus=F.lit("F"))


@query("SELECT n_nationkey, n_name FROM nation WHERE n_nationkey < 10 UNION ALL SELECT n_nationkey, upper(n_name) FROM nation WHERE n_nationkey >= 10")
def insert_ignore(s, d):
    n = T(s, d, "nation").select("n_nationkey", "n_name")
    batch = n.where("n_nationkey >= 5").select("n_nationkey", F.upper("n_name").alias("n_name"))
    return C.insert_ignore(n.where("n_nationkey < 10"), batch, "n_nationkey")


@query("SELECT DISTINCT id, source_type, source_book_id FROM zh_sources WHERE (source_type, source_book_id) IN (SELECT (source_type, source_book_id) FROM zh_sources WHERE source_type IS NOT NULL AND source_book_id IS NOT NULL GROUP BY source_type, source_book_id HAVING count(DISTINCT id) > 1)")
def unique_conflicts(s, d):
    return C.shared_keys(T(s, d, "zh_sources").select("id", "source_type", "source_book_id").distinct(), "id", ["source_type", "source_book_id"])


@query(
    """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')
       UNION ALL SELECT o_orderkey, 1, CAST(1 AS DOUBLE) FROM orders WHERE o_orderstatus = 'P'"""
)
def replace_chapters(s, d):
    batch = T(s, d, "orders").where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("l_orderkey"), F.lit(1).alias("l_linenumber"), F.lit(1.0).alias("l_quantity"))
    return C.replace_children(T(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity"), batch, "l_orderkey")


@query("SELECT id, 'books/' || book_id || '/chapters/' || id || '.html' AS content_key, 'images/' || regexp_replace(split_part(href, '/', -1), '[^a-zA-Z0-9.\\-_]', '_', 'g') AS image_key FROM chapters")
def key_layout(s, d):
    key = F.format_string("books/%s/chapters/%s.html", "book_id", "id")
    df = T(s, d, "chapters")
    return df.select("id", F.when(F.col("book_id").isNotNull(), key).alias("content_key"), F.concat(F.lit("images/"), X.image_filename(F.col("href"))).alias("image_key"))


@query(
    """SELECT id, CASE WHEN regexp_matches(href, '(?i)^https?://') THEN href ELSE 'https://host/' || href END AS url, left(title, 255) AS title FROM chapters"""
)
def sync_projection(s, d):
    url = F.when(F.col("href").rlike("(?i)^https?://"), F.col("href")).otherwise(F.concat(F.lit("https://host/"), "href"))
    return T(s, d, "chapters").select("id", url.alias("url"), F.left("title", F.lit(255)).alias("title"))


