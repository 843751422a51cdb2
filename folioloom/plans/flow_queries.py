"""Queries over the job feed and over sources, with SQL for those that SQL can state."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioloom.functions import foreign, images
from folioloom.functions import text as X
from folioloom.operators import vocabulary
from folioloom.plans.catalog_queries import T, query
from folioloom.sources import listing
from folioloom.streaming import jobs


@query("SELECT time_bucket(INTERVAL '1 hour', ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def stream_tumbling(s, d):
    return jobs.windowed_counts(T(s, d, "events")).select("start", "event_type", "n", F.round("total", 4).alias("total"))


@query(
    """SELECT start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM (SELECT unnest([time_bucket(INTERVAL '30 minutes', ts), time_bucket(INTERVAL '30 minutes', ts) - INTERVAL '30 minutes']) AS start, event_type, value FROM events) t GROUP BY 1, 2"""
)
def stream_sliding(s, d):
    return jobs.windowed_counts(T(s, d, "events"), "1 hour", "30 minutes").select("start", "event_type", "n", F.round("total", 4).alias("total"))


@query(
    """SELECT user_id, min(ts) AS start, count(*) AS n FROM (SELECT user_id, ts, sum(g) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM
       (SELECT *, CASE WHEN ts >= lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL '30 minutes' THEN 1 ELSE 0 END AS g FROM events) a) b GROUP BY user_id, k"""
)
def stream_sessions(s, d):
    return jobs.sessions(T(s, d, "events"))


@query(
    """SELECT user_id, a - r AS attempts, a - r >= 3 AS failed, l AS last_type FROM (SELECT user_id, max(n) AS a, coalesce(max(CASE WHEN event_type <> 'error' THEN n END), 0) AS r, arg_max(event_type, n) AS l FROM
       (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events) t GROUP BY 1) u"""
)
def stream_attempts(s, d):
    return jobs.attempts_batch(T(s, d, "events"))


@query("SELECT user_id, event_id, before, after FROM (SELECT user_id, event_id, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before, event_type AS after FROM events) t WHERE before IS DISTINCT FROM after")
def stream_status_log(s, d):
    return jobs.status_log(T(s, d, "events"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events WHERE CAST(json_extract(props, '$.k') AS BIGINT) > 50")
def json_props(s, d):
    k = F.get_json_object("props", "$.k").try_cast("long")
    return T(s, d, "events").select("event_id", k.alias("k")).where("k > 50")


@query(
    """SELECT name AS page, book_id, title, CASE WHEN length(trim(name)) BETWEEN 1 AND 19 THEN trim(name) ELSE '未知' END AS author FROM (SELECT name, CAST(id AS VARCHAR) AS book_id, trim(translate(title, '【】《》[]', '')) AS title FROM
       (SELECT DISTINCT regexp_replace(coalesce(author, ''), '[<>&"]', ' ', 'g') AS name, id, regexp_replace(title, '[<>&"]', ' ', 'g') AS title FROM zh_sources WHERE title IS NOT NULL)) t WHERE title <> ''"""
)
def src_author_listing(s, d):
    """Pages of every author; a page whose name is empty or too long for a name has an unknown one."""
    plain = lambda c: F.regexp_replace(F.coalesce(c, F.lit("")), '[<>&"]', " ")
    z = T(s, d, "zh_sources").where("title is not null").select(plain("author").alias("name"), "id", plain("title").alias("title")).distinct()
    link = F.concat(F.lit('<a href="?M=book&P='), F.col("id").cast("string"), F.lit('">'), F.col("title"), F.lit("</a><br>"))
    page = F.concat(F.lit('<font color="CC0000">'), "name", F.lit("</font>"), F.array_join(F.collect_list(link), "\n"))
    pages = z.groupBy("name").agg(page.alias("html")).select(F.col("name").alias("page"), "html")
    return listing.author_listing(pages)


@query(r"SELECT id, regexp_replace(split_part(regexp_replace(href, '[?#].*$', ''), '/', -1), '(?i)\.(epub|txt)$', '') AS book_id, CASE WHEN regexp_matches(href, '(?i)^https?://') THEN href ELSE 'https://host/' || regexp_replace(href, '^/+', '') END AS url FROM chapters")
def src_url_ids(s, d):
    href = F.col("href")
    return T(s, d, "chapters").select("id", listing.book_id_of(href).alias("book_id"), listing.resolve("https://host", href).alias("url"))


@query()
def src_download_listing(s, d):
    c = T(s, d, "chapters").where("title is not null").select(F.col("book_id").alias("page"), F.concat(F.lit('<a href="/files/'), "id", F.lit('.txt">'), "title", F.lit(' TXT</a> <a href="/files/'), "id", F.lit('.epub">'), "title", F.lit(" EPUB</a>")).alias("html"))
    return listing.download_listing(c, "https://host")


@query()
def tag_foreign(s, d):
    """Italics with few of the corpus's own common words are foreign, besides the listed phrases."""
    h = T(s, d, "chapters").where("html_content is not null")
    return h.select("id", foreign.tag_foreign(F.col("html_content"), vocabulary.english_words(h)).alias("html"))


@query()
def rewrite_images(s, d):
    html = F.concat(F.lit('<img src="/images/a%20b.png"><img src="x/c.png" alt=""> '), F.coalesce("html_content", F.lit("")))
    places = images.image_map([("a%20b.png", "https://host/1.png"), ("c.png", "https://host/2.png")])
    return T(s, d, "chapters").select("id", images.rewrite_images(html, places, X.captions(F.concat(F.lit("[Illustration: "), F.coalesce("title", F.lit("x")), F.lit("]")))).alias("html"))
