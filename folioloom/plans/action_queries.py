"""Updates, planning, hand-over, archives and checks that use the operators over whole tables, with SQL where it can state them."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from folioloom.functions import metrics as M
from folioloom.functions import text as X
from folioloom.operators import catalog as C
from folioloom.operators import quality
from folioloom.operators.layout import spread
from folioloom.plans import text_queries
from folioloom.plans.catalog_queries import PUBLISHER, SQL, STRIP, T, chapters, query
from folioloom.session import scratch_folder
from folioloom.sources import epub, schemas

_WS = X.WS
_B = "(SELECT DISTINCT id, pg_id, title, author, language, description, subjects, status, quality_score, pipeline_version, word_count, cefr_level FROM books) b"


def _books(s, d, *columns):
    return T(s, d, "books").select("id", *columns).distinct()


# ---- updates and their logs


@query(f"SELECT id, CASE WHEN language = 'zh' AND title IS NOT NULL THEN upper(title) ELSE title END AS title, status FROM {_B}")
def partial_update(s, d):
    """Only the allowed column of the patch is taken; its new ids and other columns are not."""
    b = _books(s, d, "title", "status", "language")
    patch = b.where("language = 'zh'").select("id", F.upper("title").alias("title"), F.lit("x").alias("status"))
    patch = patch.unionByName(patch.select(F.concat(F.lit("new"), "id").alias("id"), "title", "status"))
    return C.partial_update(b.select("id", "title", "status"), patch, "id", ["title"])


@query("SELECT pg_id, 'queued' AS status, 0 AS attempts FROM (SELECT DISTINCT pg_id FROM books WHERE pg_id IS NOT NULL) b WHERE pg_id NOT IN (SELECT pg_id FROM gutendex_authors WHERE pg_id IS NOT NULL AND download_count < 50)")
def insert_jobs(s, d):
    active = T(s, d, "gutendex_authors").where("pg_id is not null and download_count < 50")
    return C.new_rows(T(s, d, "books"), active, "pg_id", status=F.lit("queued"), attempts=F.lit(0)).drop("id")


@query(f"SELECT id, 'status' AS field, status AS old_value, v AS new_value FROM (SELECT id, status, CASE WHEN quality_score < 50 THEN 'rejected' WHEN quality_score >= 80 THEN 'approved' END AS v FROM {_B}) t WHERE v IS NOT NULL AND v IS DISTINCT FROM status")
def review_log(s, d):
    b = _books(s, d, "status", "quality_score")
    patch = b.select("id", F.when(F.col("quality_score") < 50, "rejected").when(F.col("quality_score") >= 80, "approved").alias("status"))
    _, log = C.with_log(b.select("id", "status"), patch, "id", ["status"], F.current_timestamp())
    return log.drop("at")


@query(f"SELECT id, CASE WHEN status = 'ready' THEN 'r-' || id END AS record_id FROM {_B}")
def mark_synced(s, d):
    b = _books(s, d, "status").withColumn("record_id", F.lit(None).cast("string"))
    done = b.where("status = 'ready'").select("id", F.concat(F.lit("r-"), "id").alias("record_id"))
    return C.partial_update(b, done, "id", ["record_id"]).select("id", "record_id")


@query(f"SELECT id, coalesce(status IN ('pending', 'ready', 'approved', 'rejected', 'excluded'), false) AS valid FROM {_B}")
def valid_status(s, d):
    return _books(s, d, "status").select("id", F.coalesce(F.col("status").isin("pending", "ready", "approved", "rejected", "excluded"), F.lit(False)).alias("valid"))


@query(
    """WITH o AS (SELECT DISTINCT id, title, author, dynasty, category FROM zh_sources), n AS (SELECT id, trim(replace(title, '【全】', '')) AS title, nullif(trim(author), '') AS author, CASE WHEN dynasty = '宋' THEN '宋代' ELSE dynasty END AS dynasty, upper(category) AS category FROM o)
       SELECT * FROM (SELECT o.id, 'title' AS field, o.title AS old_value, n.title AS new_value FROM o JOIN n USING (id) UNION ALL SELECT o.id, 'author', o.author, n.author FROM o JOIN n USING (id)
       UNION ALL SELECT o.id, 'dynasty', o.dynasty, n.dynasty FROM o JOIN n USING (id) UNION ALL SELECT o.id, 'category', o.category, n.category FROM o JOIN n USING (id)) t WHERE new_value IS NOT NULL AND old_value IS DISTINCT FROM new_value"""
)
def change_log(s, d):
    old = T(s, d, "zh_sources").select("id", "title", "author", "dynasty", "category").distinct()
    new = old.select(
        "id", F.trim(F.replace("title", F.lit("【全】"), F.lit(""))).alias("title"), F.nullif(F.trim("author"), F.lit("")).alias("author"),
        F.when(F.col("dynasty") == "宋", "宋代").otherwise(F.col("dynasty")).alias("dynasty"), F.upper("category").alias("category"),
    )
    return C.change_log(old, new, "id", ["title", "author", "dynasty", "category"])


@query(f"SELECT id, CASE WHEN quality_score < 50 THEN 'excluded' ELSE status END AS status FROM {_B}")
def exclude_books(s, d):
    b = _books(s, d, "status", "quality_score")
    return C.set_values(b, "id", b.where("quality_score < 50").select("id"), status=F.lit("excluded")).select("id", "status")


@query("SELECT id, 'books/' || book_id || '/cover-1700000000.jpg' AS cover, 'manual' AS cover_source, true AS rekeyed FROM (SELECT DISTINCT id, book_id FROM chapters WHERE book_id IS NOT NULL) c")
def cover_rekeyed(s, d):
    c = T(s, d, "chapters").where("book_id is not null").select("id", F.concat(F.lit("books/"), "book_id", F.lit("/cover.jpg")).alias("cover")).distinct()
    new = F.regexp_replace("cover", "[^/]+$", "cover-1700000000.jpg")
    return c.select("id", new.alias("cover"), F.lit("manual").alias("cover_source"), new.rlike(r"/cover-\d+\.").alias("rekeyed"))


# ---- filters


@query("SELECT id, dynasty FROM books WHERE dynasty = '清'")
def flt_cover_manual(s, d):
    return T(s, d, "books").where("dynasty = '清'").select("id", "dynasty")


@query("SELECT record_id FROM gutendex_authors WHERE pg_id IS NOT NULL AND download_count >= 100")
def flt_has_epub(s, d):
    formats = F.map_filter(F.create_map(F.lit("application/epub+zip"), F.concat(F.lit("https://host/"), F.col("pg_id").cast("string"), F.lit(".epub")), F.lit("text/html"), F.lit("x")), lambda k, v: v.isNotNull())
    has = F.try_element_at(formats, F.lit("application/epub+zip")).isNotNull()
    return T(s, d, "gutendex_authors").where(has & (F.col("download_count") >= 100)).select("record_id")


@query(f"SELECT id FROM {_B} WHERE status = 'ready' AND coalesce(pipeline_version, 0) < 3 AND description IS NOT NULL ORDER BY id LIMIT 100")
def flt_unsynced(s, d):
    """The cut comes after all filters."""
    b = _books(s, d, "status", "pipeline_version", "description")
    return b.where("status = 'ready' and coalesce(pipeline_version, 0) < 3 and description is not null").orderBy("id").limit(100).select("id")


@query("SELECT id, 'content/' || regexp_replace(regexp_replace(href, '/+', '/', 'g'), '^/|/$', '', 'g') AS public_key, regexp_replace(replace('//../' || href, '../', ''), '^/+', '') AS internal_key FROM chapters WHERE href IS NOT NULL AND book_id IS NOT NULL")
def flt_sanitize_path(s, d):
    c = T(s, d, "chapters").where("href is not null and book_id is not null")
    public = C.sanitize_path(F.concat(F.lit("/content/./"), "book_id", F.lit("/../"), "href"))
    return c.select("id", public.alias("public_key"), X.internal_key(F.concat(F.lit("//../"), "href")).alias("internal_key"))


# ---- aggregates, windows, sets


@query(f"SELECT book_id, round(count(*) FILTER (regexp_matches(coalesce(html_content, ''), '{X.residue_pattern(PUBLISHER)}')) / count(*), 6) AS residue FROM (SELECT DISTINCT id, book_id, html_content FROM chapters) c GROUP BY book_id")
def agg_residue(s, d):
    marked = chapters(s, d, "html_content").select("book_id", X.has_residue(F.coalesce("html_content", F.lit("")), PUBLISHER).alias("left_over"))
    return marked.groupBy("book_id").agg(F.round(F.count_if("left_over") / F.count("*"), 6).alias("residue"))


@query(f"SELECT verdict, count(*) AS n, round(count(*) FILTER (alignment = 'OK') / nullif(count(*) FILTER (alignment <> 'NA'), 0), 6) AS ok_rate FROM ({SQL['audit_fidelity']}) a GROUP BY verdict")
def agg_verdicts(s, d):
    rows = text_queries.audit_fidelity(s, d)
    comparable = F.nullif(F.count_if(F.col("alignment") != "NA"), F.lit(0))
    return rows.groupBy("verdict").agg(F.count("*").alias("n"), F.round(F.count_if(F.col("alignment") == "OK") / comparable, 6).alias("ok_rate"))


@query(
    """WITH c AS (SELECT category, count(*) AS n FROM (SELECT DISTINCT id, category FROM zh_sources) z WHERE category IS NOT NULL GROUP BY 1), t AS (SELECT sum(n) AS total, count(*) AS kinds FROM c)
       SELECT category, CAST(floor((greatest(0, 100.0::DOUBLE / kinds - n * 100.0::DOUBLE / total) / (100.0::DOUBLE / kinds)) * 300 + 0.5) AS BIGINT) AS bonus FROM c, t WHERE floor((greatest(0, 100.0::DOUBLE / kinds - n * 100.0::DOUBLE / total) / (100.0::DOUBLE / kinds)) * 300 + 0.5) > 0"""
)
def agg_category_bonus(s, d):
    """Every category is to have the same share."""
    counts = T(s, d, "zh_sources").select("id", "category").distinct().where("category is not null").groupBy("category").agg(F.count("*").alias("n"))
    return C.gap_bonus(counts, counts.select("category", F.lit(1.0).alias("target")), "category", "n", "target")


@query("SELECT count(*) FILTER (status IN ('ready', 'approved')) AS processed, count(*) FILTER (status = 'rejected') AS failed, count(*) FILTER (status IS NULL OR status NOT IN ('ready', 'approved', 'rejected')) AS skipped FROM (SELECT DISTINCT id, status FROM books) b")
def report_counters(s, d):
    kind = F.when(F.col("status").isin("ready", "approved"), "processed").when(F.col("status") == "rejected", "failed").otherwise("skipped")
    return _books(s, d, "status").select(kind.alias("kind")).agg(*[F.count_if(F.col("kind") == k).alias(k) for k in ("processed", "failed", "skipped")])


@query("SELECT o_orderstatus AS status, count(*) AS jobs, count(*) FILTER (o_orderpriority = '1-URGENT') AS urgent FROM orders GROUP BY 1")
def agg_jobs_by_status(s, d):
    return T(s, d, "orders").groupBy(F.col("o_orderstatus").alias("status")).agg(F.count("*").alias("jobs"), F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("urgent"))


@query(
    """SELECT o_orderkey, CAST(50 - coalesce(before, 0) AS BIGINT) AS budget_before FROM (SELECT *, row_number() OVER (PARTITION BY page ORDER BY o_orderkey) AS place FROM (SELECT o_orderkey, o_custkey // 100 AS page FROM orders) o
       JOIN (SELECT page AS p, sum(n) OVER (ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM (SELECT o_custkey // 100 AS page, count(*) AS n FROM orders GROUP BY 1) q) c ON c.p = o.page) t WHERE place <= 50 - coalesce(before, 0)"""
)
def win_remaining_budget(s, d):
    pages = T(s, d, "orders").select("o_orderkey", F.floor(F.col("o_custkey") / 100).alias("page"))
    return C.within_budget(pages, "page", ["o_orderkey"], 50).select("o_orderkey", "budget_before")


@query("SELECT source, n FROM (SELECT source, count(*) AS n FROM documents WHERE source IS NOT NULL GROUP BY 1) t ORDER BY n DESC, source LIMIT 10")
def topk_sources(s, d):
    return T(s, d, "documents").where("source is not null").groupBy("source").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "source").limit(10)


@query("SELECT id, status FROM books WHERE status = 'ready' UNION ALL SELECT id, status FROM books WHERE status = 'approved'")
def set_union_status(s, d):
    b = T(s, d, "books").select("id", "status")
    return b.where("status = 'ready'").unionByName(b.where("status = 'approved'"))


@query(
    """SELECT c.book_id, array_to_string(list_sort(list_distinct(list_concat(c.keys, coalesce(b.keys, [])))), ',') AS keys FROM (SELECT book_id, list(DISTINCT site) AS keys FROM chapters WHERE book_id IS NOT NULL AND site IS NOT NULL GROUP BY 1) c
       LEFT JOIN (SELECT id, [source_type] AS keys FROM (SELECT DISTINCT id, source_type FROM books WHERE source_type IS NOT NULL) x) b ON b.id = c.book_id"""
)
def set_union_keys(s, d):
    """Keys of two maps by book: counts by site and by source."""
    sites = T(s, d, "chapters").where("book_id is not null and site is not null").groupBy("book_id", "site").agg(F.count("*").alias("n")).groupBy("book_id").agg(F.map_from_entries(F.collect_list(F.struct("site", "n"))).alias("a"))
    kinds = _books(s, d, "source_type").where("source_type is not null").select(F.col("id").alias("b_id"), F.create_map("source_type", F.lit(1)).alias("b"))
    joined = sites.join(kinds, F.col("book_id") == F.col("b_id"), "left")
    keys = F.array_union(F.map_keys("a"), F.coalesce(F.map_keys("b"), F.array().cast("array<string>")))
    return joined.select("book_id", F.array_join(F.sort_array(keys), ",").alias("keys"))


# ---- plans


@query(
    """WITH g AS (SELECT pg_id, max(download_count) AS n FROM gutendex_authors WHERE pg_id IS NOT NULL AND download_count >= 20 GROUP BY 1), n AS (SELECT * FROM g WHERE pg_id NOT IN (SELECT pg_id FROM books WHERE pg_id IS NOT NULL AND status IN ('ready', 'approved'))),
       l AS (SELECT pg_id, max(CASE WHEN contains(coalesce(subjects, ''), 'Orphans') THEN 300 ELSE 0 END) AS bonus FROM books WHERE pg_id IS NOT NULL GROUP BY 1)
       SELECT n.pg_id, n.n + coalesce(l.bonus, 0) AS priority FROM n LEFT JOIN l ON l.pg_id = n.pg_id ORDER BY priority DESC, n.pg_id LIMIT 50"""
)
def discover_priority(s, d):
    """New source records by downloads and list bonus; the daily limit is part of the plan."""
    seen = T(s, d, "books").where("pg_id is not null")
    g = T(s, d, "gutendex_authors").where("pg_id is not null and download_count >= 20").groupBy("pg_id").agg(F.max("download_count").alias("n"))
    new = C.anti(g, "pg_id", seen.where(F.col("status").isin("ready", "approved")).select("pg_id"))
    bonus = seen.groupBy(F.col("pg_id").alias("l_id")).agg(F.max(F.when(F.contains(F.coalesce("subjects", F.lit("")), F.lit("Orphans")), 300).otherwise(0)).alias("bonus"))
    ranked = new.join(bonus, F.col("pg_id") == F.col("l_id"), "left").select("pg_id", (F.col("n") + F.coalesce("bonus", F.lit(0))).alias("priority"))
    return ranked.orderBy(F.desc("priority"), "pg_id").limit(50)


@query(
    f"""SELECT id, pg_id, coalesce(pipeline_version, 0) AS version, 1000000 AS priority FROM (SELECT * FROM {_B} WHERE pipeline_version < 3 OR pipeline_version IS NULL ORDER BY id LIMIT 500) t
       WHERE pg_id IS NOT NULL AND pg_id NOT IN (SELECT pg_id FROM gutendex_authors WHERE pg_id IS NOT NULL AND download_count < 20)"""
)
def reprocess(s, d):
    """The limit comes before the anti join, as callers of the plan expect."""
    due = _books(s, d, "pg_id", "pipeline_version").where("pipeline_version < 3 or pipeline_version is null").orderBy("id").limit(500)
    active = T(s, d, "gutendex_authors").where("pg_id is not null and download_count < 20").select("pg_id")
    out = C.anti(due.where("pg_id is not null"), "pg_id", active)
    return out.select("id", "pg_id", F.coalesce("pipeline_version", F.lit(0)).alias("version"), F.lit(1_000_000).alias("priority"))


_ARRAY = "CASE WHEN json_valid(subjects) AND json_type(subjects) = 'ARRAY' THEN from_json(subjects, '[\"VARCHAR\"]') ELSE [] END"


@query(
    f"""SELECT b.id, left(b.title, 255) AS title, array_to_string({_ARRAY}, '|') AS subjects, c.chapters FROM {_B} LEFT JOIN (SELECT book_id, string_agg(coalesce(order_num::VARCHAR, '') || ':' || left(coalesce(title, ''), 255) || ':' || coalesce(url, ''), ';' ORDER BY order_num NULLS FIRST, id) AS chapters
       FROM (SELECT DISTINCT id, book_id, order_num, title, CASE WHEN starts_with(href, 'http') THEN href ELSE 'https://host/' || href END AS url FROM chapters) x GROUP BY 1) c ON c.book_id = b.id WHERE b.status = 'ready'"""
)
def sync_out(s, d):
    """Ready books with their subjects as an array and their chapters nested in order."""
    b = _books(s, d, "title", "subjects", "status").where("status = 'ready'")
    subjects = F.coalesce(F.from_json("subjects", "array<string>", {"allowSingleQuotes": "false"}), F.array().cast("array<string>"))
    url = F.when(F.col("href").startswith("http"), F.col("href")).otherwise(F.concat(F.lit("https://host/"), "href"))
    c = T(s, d, "chapters").select("id", "book_id", "order_num", F.left(F.coalesce("title", F.lit("")), F.lit(255)).alias("title"), url.alias("url")).distinct()
    packed = C.nest(b.select("id", F.left("title", F.lit(255)).alias("title"), subjects.alias("subjects")), "id", c.withColumnRenamed("id", "c_id"), "book_id", "order_num", ["c_id", "title", "url"], "chapters")
    line = lambda x: F.concat(F.coalesce(x["order_num"].cast("string"), F.lit("")), F.lit(":"), x["title"], F.lit(":"), F.coalesce(x["url"], F.lit("")))
    flat = F.when(F.size("chapters") > 0, F.array_join(F.transform("chapters", line), ";"))
    return packed.select("id", "title", F.array_join("subjects", "|").alias("subjects"), flat.alias("chapters"))


@query("SELECT id, CASE WHEN json_valid(subjects) AND json_type(subjects) = 'ARRAY' THEN array_to_string(from_json(subjects, '[\"VARCHAR\"]'), '|') END AS values, to_json({'title': title, 'words': word_count})::VARCHAR AS packed FROM (SELECT DISTINCT id, subjects, title, word_count FROM books WHERE title IS NOT NULL AND word_count IS NOT NULL) b")
def json_arrays(s, d):
    b = _books(s, d, "subjects", "title", "word_count").where("title is not null and word_count is not null")
    values = F.array_join(F.from_json("subjects", "array<string>", {"allowSingleQuotes": "false"}), "|")
    return b.select("id", values.alias("values"), F.to_json(F.struct("title", F.col("word_count").alias("words"))).alias("packed"))


# ---- text


_TITLE_PAGE = "|".join(epub.TITLE_PAGE)


@query(rf"SELECT id, len(regexp_extract_all({STRIP}, '[^{_WS}]+')) < 30 OR regexp_matches(upper(left({STRIP}, 500)), '{_TITLE_PAGE}') AS front FROM (SELECT id, html_content FROM chapters WHERE html_content IS NOT NULL) c")
def front_matter(s, d):
    h = T(s, d, "chapters").where("html_content is not null")
    return spread(h.select("id", "html_content")).select("id", epub.front_matter(F.col("html_content")).alias("front"))


@query(
    r"""SELECT id, regexp_matches(coalesce(title, ''), '(?i)(^|[^A-Za-z0-9_])(colophon|imprint|license|copyright|uncopyright|endnotes|cover|titlepage|cover\s+image|book\s+cover|front\s+cover)($|[^A-Za-z0-9_])')
       OR contains(lower(coalesce(href, '')), 'cover') OR contains(lower(coalesce(href, '')), 'titlepage') AS skip FROM chapters"""
)
def skippable(s, d):
    return T(s, d, "chapters").select("id", epub.skippable(F.col("title"), F.col("href")).alias("skip"))


_CAP = epub._CAPTION.pattern.replace("'", "''")


@query(
    rf"""SELECT id, list_filter(list_transform(regexp_extract_all(regexp_replace(html_content, '(?is){_CAP}', '', 'g'), '(?is)<h[1-3]\b[^>]*>(.*?)</h[1-3]>', 1), lambda x: regexp_replace(regexp_replace(regexp_replace(x, '<[^>]+>', '', 'g'), '[{_WS}]+', ' ', 'g'), '^ | \z', '', 'g')),
       lambda x: regexp_matches(x, '[A-Za-z0-9]{{2,}}') AND NOT regexp_matches(x, '(?i)ebook of|{PUBLISHER.name}'))[1] AS heading FROM (SELECT id, html_content FROM chapters WHERE html_content IS NOT NULL) c"""
)
def extract_title(s, d):
    h = T(s, d, "chapters").where("html_content is not null")
    return spread(h.select("id", "html_content")).select("id", epub.heading_title(F.col("html_content"), PUBLISHER).alias("heading"))


_STOPS = ", ".join(f"'{w}'" for w in M.STOP_WORDS)


@query(rf"SELECT id, array_to_string(list_sort(list_distinct(list_filter(string_split(trim(regexp_replace(regexp_replace(lower(title), '[;:,.''\"!?—–-]', ' ', 'g'), '\s+', ' ', 'g')), ' '), lambda w: length(w) > 1 AND w NOT IN ({_STOPS})))), ' ') AS tokens FROM books WHERE title IS NOT NULL")
def title_tokens(s, d):
    return T(s, d, "books").where("title is not null").select("id", F.array_join(F.sort_array(M.title_tokens(F.col("title"))), " ").alias("tokens"))


@query(
    rf"""SELECT doc_id, md5(regexp_replace(regexp_replace(t, '(?is)^.*?\*\*\*\s*START OF (?:THE |THIS )?(?:{PUBLISHER.name} )?EBOOK.*?\*\*\*', ''), '(?is)\*\*\*\s*END OF (?:THE |THIS )?(?:{PUBLISHER.name} )?EBOOK.*?\*\*\*.*$', '')) AS digest FROM
       (SELECT doc_id, CASE WHEN lang = 'en' THEN 'head *** START OF THE {PUBLISHER.name} EBOOK of x ***' || text || '*** END OF THIS EBOOK x *** tail' WHEN lang = 'de' THEN text || ' *** end of ebook *** tail' ELSE text END AS t FROM documents WHERE text IS NOT NULL) q"""
)
def strip_text_markers(s, d):
    framed = F.when(F.col("lang") == "en", F.concat(F.lit(f"head *** START OF THE {PUBLISHER.name} EBOOK of x ***"), "text", F.lit("*** END OF THIS EBOOK x *** tail"))).when(F.col("lang") == "de", F.concat("text", F.lit(" *** end of ebook *** tail"))).otherwise(F.col("text"))
    return T(s, d, "documents").where("text is not null").select("doc_id", F.md5(X.between_markers(framed, PUBLISHER)).alias("digest"))


@query(
    r"""SELECT doc_id, CASE WHEN length(a) > 600 AND length(b) > 600 THEN CASE WHEN contains(b, substr(a, 201, 200)) THEN 'OK' ELSE 'MISS' END ELSE 'NA' END AS alignment FROM (SELECT doc_id, trim(regexp_replace(regexp_replace(lower(text), '[^a-z0-9\s]+', ' ', 'g'), '\s+', ' ', 'g')) AS a,
       trim(regexp_replace(regexp_replace(lower(CASE WHEN lang = 'en' THEN text ELSE replace(text, 'e', 'a') END), '[^a-z0-9\s]+', ' ', 'g'), '\s+', ' ', 'g')) AS b FROM documents WHERE text IS NOT NULL) t"""
)
def align_check(s, d):
    """Texts against a second reading of them, which differs in the other languages."""
    t = T(s, d, "documents").where("text is not null").select(F.col("doc_id").alias("key"), F.col("text").alias("ours"), F.when(F.col("lang") == "en", F.col("text")).otherwise(F.replace("text", F.lit("e"), F.lit("a"))).alias("theirs"))
    return quality.fidelity(t).select(F.col("key").alias("doc_id"), "alignment")


@query("SELECT id, 'A book cover illustration for \"' || coalesce(title, '') || '\" by ' || coalesce(author, '') || coalesce(', ' || nullif(dynasty, '') || ' period', '') || '. Style: ' || CASE coalesce(dynasty, '') " + " ".join(f"WHEN '{n}' THEN '{v}'" for n, v in X.COVER_STYLES) + f" ELSE '{X.COVER_STYLE}' END || '. {' '.join(X.COVER_RULES)}' || coalesce(' Thematic elements: ' || category || '.', '') AS prompt, CASE source_type WHEN 'haodoo' THEN 'HAODOO' WHEN 'wenshuoge' THEN 'WENSHUOGE' ELSE 'USER_UPLOAD' END AS kind FROM zh_sources")
def cover_prompts(s, d):
    themes = F.when(F.col("category").isNotNull(), F.array("category"))
    return T(s, d, "zh_sources").select("id", X.cover_prompt(F.col("title"), F.col("author"), F.col("dynasty"), themes).alias("prompt"), X.source_kind(F.col("source_type")).alias("kind"))


@query("SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS iso, epoch_us(ts) // 1000 AS millis FROM events")
def event_times(s, d):
    return T(s, d, "events").select("event_id", X.iso_time(F.col("ts")).alias("iso"), F.unix_millis(F.col("ts").cast("timestamp")).alias("millis"))


@query("SELECT id, title AS description, 1 AS n_tags FROM books WHERE title IS NOT NULL")
def answers_read(s, d):
    """Objects read out of answers that have other text around them."""
    answer = F.concat(F.lit("Here it is:\n```json\n"), F.to_json(F.struct(F.col("title").alias("description"), F.array("id").alias("tags"))), F.lit("\n```\nDone."))
    out = X.json_in_answer(answer, "description string, tags array<string>")
    return T(s, d, "books").where("title is not null").select("id", out["description"].alias("description"), F.size(out["tags"]).alias("n_tags"))


@query()
def normalize_compatible(s, d):
    return spread(T(s, d, "documents").where("text is not null").select("doc_id", "text")).select("doc_id", M.normalize_compatible(F.col("text")).alias("plain"))


@query()
def clean_dom(s, d):
    return spread(T(s, d, "chapters").where("html_content is not null").select("id", "html_content")).select("id", X.clean_dom(F.col("html_content")).alias("html"))


@query("SELECT doc_id, CASE WHEN length(text) > 500 THEN text WHEN length(title) > 500 THEN title ELSE source END AS truth FROM documents")
def text_fallback(s, d):
    """The first of several candidates that is long enough, else the last."""
    long = lambda c: F.when(F.length(c) > 500, F.col(c))
    return T(s, d, "documents").select("doc_id", F.coalesce(long("text"), long("title"), F.col("source")).alias("truth"))


# ---- archives built from the tables and read again


def _archives(s, d):
    """One archive a book: its metadata, a page with the description (a missing file if there is none), a cover if it has a number."""

    def build(batches):
        for batch in batches:
            out = []
            for key, title, author, language, description, numbered in zip(batch["id"], batch["title"], batch["author"], batch["language"], batch["description"], batch["numbered"]):
                meta = [(tag, text) for tag, text in (("title", title), ("creator", author), ("language", language)) if text]
                out.append(epub.build_archive(meta, [("text/page.xhtml", description)], [("One", "text/page.xhtml#a")], [("fig.png", key.encode())], key.encode() if numbered else None))
            yield pd.DataFrame({"path": batch["id"], "content": out})

    b = _books(s, d, "title", "author", "language", "description", "pg_id").withColumn("numbered", F.col("pg_id").isNotNull())
    return b.mapInPandas(build, "path string, content binary")


@query("SELECT id AS archive, coalesce(nullif(trim(title), ''), 'Unknown') AS title, coalesce(nullif(trim(author), ''), 'Unknown') AS author, coalesce(nullif(trim(language), ''), 'en') AS language FROM (SELECT DISTINCT id, title, author, language FROM books) b WHERE coalesce(title, '') || coalesce(author, '') || coalesce(language, '') <> ''")
def epub_metadata(s, d):
    """Archives with at least one entry of metadata."""
    return epub.metadata(epub.archive_items(_archives(s, d))).select("archive", "title", "author", "language")


@query("SELECT id AS archive, coalesce(md5(description), md5('')) AS digest FROM (SELECT DISTINCT id, description FROM books) b")
def epub_spine(s, d):
    """Content of the spine files; a missing file is empty."""
    return epub.archive_items(_archives(s, d)).where("kind = 'spine'").select("archive", F.md5("content").alias("digest"))


@query("SELECT id AS archive, 'image' AS kind, 'image/png' AS media_type, id AS content FROM (SELECT DISTINCT id FROM books) b UNION ALL SELECT id, 'cover', 'image/jpeg', id FROM (SELECT DISTINCT id FROM books WHERE pg_id IS NOT NULL) b")
def epub_images(s, d):
    items = epub.archive_items(_archives(s, d)).where("kind in ('image', 'cover')")
    return items.select("archive", "kind", "media_type", F.decode("content", "utf-8").alias("content"))


@query("SELECT id, 'archive' AS kind FROM (SELECT DISTINCT id FROM books) b UNION ALL SELECT id, CASE WHEN starts_with(html_content, 'PK') THEN 'archive' ELSE 'other' END FROM (SELECT DISTINCT id, html_content FROM chapters WHERE html_content IS NOT NULL) c")
def src_magic_bytes(s, d):
    """Archives and texts told apart by their first two bytes."""
    kind = F.when(F.substring("content", 1, 2) == F.lit(b"PK"), "archive").otherwise("other")
    texts = T(s, d, "chapters").where("html_content is not null").select(F.col("id").alias("path"), F.encode("html_content", "utf-8").alias("content")).distinct()
    return _archives(s, d).unionByName(texts).select(F.col("path").alias("id"), kind.alias("kind"))


@query()
def epub_chapters(s, d):
    """Chapters of archives that hold one body each and have no contents."""

    def build(batches):
        for batch in batches:
            pages = [[("body.xhtml", html)] for html in batch["html_content"]]
            yield pd.DataFrame({"path": batch["key"], "content": [epub.build_archive([("title", k)], p) for k, p in zip(batch["key"], pages)]})

    bodies = T(s, d, "raw_bodies").where("html_content is not null").select(F.col("body_id").cast("string").alias("key"), "html_content").dropDuplicates(["key"])
    return epub.chapters(bodies.mapInPandas(build, "path string, content binary"), PUBLISHER)


@query("SELECT pg_id AS id, title, download_count FROM (SELECT pg_id, min(name) AS title, max(download_count) AS download_count FROM gutendex_authors WHERE pg_id IS NOT NULL GROUP BY 1) g")
def json_records(s, d):
    """Source records written as JSON lines and read again with their schema."""
    g = T(s, d, "gutendex_authors").where("pg_id is not null").groupBy(F.col("pg_id").alias("id")).agg(F.min("name").alias("title"), F.max("download_count").alias("download_count"))
    folder = scratch_folder(s, "records")
    g.write.json(folder)
    return schemas.read_records(s, folder).select("id", "title", "download_count")


# ---- Chinese books


def _bodies(s, d):
    b = T(s, d, "raw_bodies").where("html_content is not null").select(F.col("body_id").alias("key"), F.lit(None).cast("string").alias("title"), F.col("html_content").alias("html"), F.col("source_id").isNotNull().alias("has_cover"))
    return b.dropDuplicates(["key"])


@query()
def clean_chinese(s, d):
    return quality.clean_chinese(_bodies(s, d))


@query()
def process_chinese(s, d):
    """Whole Chinese books; the vocabulary is the 600 most frequent pairs of ideographs of chapter titles, six levels by rank."""
    title = F.regexp_replace("title", r"[^\x{4e00}-\x{9fff}]", "")
    pairs = T(s, d, "zh_chapters").where("title is not null").select(title.alias("t")).where("length(t) > 1").select(F.explode(F.transform(F.sequence(F.lit(1), F.length("t") - 1), lambda i: F.substring("t", i, F.lit(2)))).alias("word"))
    ranked = pairs.groupBy("word").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "word").limit(600)
    level = F.floor((F.row_number().over(Window.orderBy(F.desc("n"), "word")) - 1) / 100) + 1  # 600 rows
    return quality.process_chinese(_bodies(s, d), ranked.select("word", level.cast("int").alias("level")), PUBLISHER)
