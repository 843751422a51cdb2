"""Queries over text: HTML, words, languages, readability, typography, with SQL where RE2 can say it."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioloom.functions import chinese, spelling, typography
from folioloom.functions import metrics as M
from folioloom.functions import semantics as S
from folioloom.functions import text as X
from folioloom.operators import quality
from folioloom.operators.layout import spread
from folioloom.plans.catalog_queries import PUBLISHER, STRIP, T, query

_WS = X.WS
_DOC = "documents WHERE text IS NOT NULL"


def docs(s, d):
    return T(s, d, "documents").where("text is not null")


def html(s, d, table: str = "chapters"):
    return T(s, d, table).where("html_content is not null").select("id", F.col("html_content").alias("h"), "title")


_H = "(SELECT id, html_content, title FROM chapters WHERE html_content IS NOT NULL) c"
_Z = "(SELECT id, html_content, title FROM zh_chapters WHERE html_content IS NOT NULL) z"


@query(f"SELECT id, md5({STRIP}) AS digest FROM {_H}")
def strip_html(s, d):
    return spread(html(s, d)).select("id", F.md5(X.strip_html(F.col("h"))).alias("digest"))


_DROP = r"regexp_replace(regexp_replace(html_content, '(?is)<style[^>]*>.*?</style>', '', 'g'), '(?is)<script[^>]*>.*?</script>', '', 'g')"
_ENT = rf"trim(regexp_replace(regexp_replace(regexp_replace({_DROP}, '<[^>]+>', ' ', 'g'), '(?i)&[a-z]+;', ' ', 'g'), '[{_WS}]+', ' ', 'g'))"


@query(f"SELECT id, md5({_ENT}) AS digest FROM {_H}")
def strip_html_entities(s, d):
    return html(s, d).select("id", F.md5(X.strip_html_entities(F.col("h"))).alias("digest"))


@query(
    rf"SELECT id, md5(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(html_content, '<[^>]+>', '', 'g'), '&nbsp;', ' '), '&amp;', '&'), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '^[{_WS}]+|[{_WS}]+\z', '', 'g')) AS digest FROM {_Z}"
)
def strip_tags_decode(s, d):
    return html(s, d, "zh_chapters").select("id", F.md5(X.strip_tags_decode(F.col("h"))).alias("digest"))


@query(rf"SELECT id, length(regexp_replace({_DROP}, '<[^>]+>', ' ', 'g')) AS n FROM {_H}")
def strip_nonorm(s, d):
    return html(s, d).select("id", F.length(X.strip_tags_raw(F.col("h"))).cast("long").alias("n"))


@query(rf"SELECT doc_id, len(regexp_extract_all(text, '[^{_WS}]+')) AS words FROM {_DOC}")
def count_words(s, d):
    return docs(s, d).select("doc_id", X.count_words(F.col("text")).alias("words"))


@query(rf"SELECT id, len(regexp_extract_all(html_content, '[\x{{4e00}}-\x{{9fff}}\x{{3400}}-\x{{4dbf}}]')) AS n FROM {_Z}")
def count_cjk(s, d):
    return html(s, d, "zh_chapters").select("id", X.count_cjk(F.col("h")).alias("n"))


@query(rf"SELECT doc_id, length(regexp_replace(text, '[{_WS}]', '', 'g')) AS n FROM {_DOC}")
def count_nonspace(s, d):
    return docs(s, d).select("doc_id", X.count_nonspace(F.col("text")).alias("n"))


_MARKED = "'a [Illustration: x] b {12} [pg. 4] [pg 5] ' || coalesce(title, '') || ' [Footnote: see <b>this</b>] [illustration]'"


@query(rf"SELECT id, regexp_replace(regexp_replace(regexp_replace(regexp_replace({_MARKED}, '(?i)\[Illustration(?::\s*[^\]]*?)?\]', '', 'g'), '(?i)\[Footnote:\s*[^\]]*?\]', '', 'g'), '(?i)\[pg?\.\s*\d+\]', '', 'g'), '\{{\d+\}}', '', 'g') AS clean FROM {_H}")
def strip_markers(s, d):
    marked = F.concat(F.lit("a [Illustration: x] b {12} [pg. 4] [pg 5] "), F.coalesce("title", F.lit("")), F.lit(" [Footnote: see <b>this</b>] [illustration]"))
    return html(s, d).select("id", X.strip_markers(marked).alias("clean"))


@query(
    r"""SELECT id, md5(regexp_replace(replace(html_content, '#n1', '#fn1'), '(?is)<a\b[^>]*href=["''][^"'']*(?:endnote|footnote|#fn|#note|#ref)[^"'']*["''][^>]*>(.*?)</a>', '\1', 'g')) AS digest FROM """ + _H
)
def unlink_endnotes(s, d):
    return html(s, d).select("id", F.md5(X.unlink_endnotes(F.replace(F.col("h"), F.lit("#n1"), F.lit("#fn1")))).alias("digest"))


@query(rf"SELECT id, md5(regexp_replace(html_content, '(?im)^<p[^>]*>\s*(?:\*\s*){{2,}}\s*</p>$', '<hr/>', 'g')) AS digest FROM {_H}")
def section_breaks(s, d):
    return html(s, d).select("id", F.md5(X.section_breaks(F.col("h"))).alias("digest"))


@query(
    rf"""SELECT id, md5(CASE WHEN starts_with(regexp_replace(html_content, '^[{_WS}]+', ''), '<section') THEN html_content
       ELSE '<section data-epub-type="chapter">' || chr(10) || html_content || chr(10) || '</section>' END) AS digest FROM {_H}"""
)
def wrap_section(s, d):
    return html(s, d).select("id", F.md5(X.wrap_section(F.col("h"))).alias("digest"))


_SHIFT = "html_content"
for _level in (5, 4, 3, 2, 1):
    _SHIFT = rf"regexp_replace({_SHIFT}, '(?i)<(/?)h{_level}(\b[^>]*>)', '<\1h{_level + 1}\2', 'g')"


@query(rf"SELECT id, md5(CASE WHEN regexp_matches(html_content, '(?i)<h1\b') THEN {_SHIFT} ELSE html_content END) AS digest FROM {_H}")
def shift_headings(s, d):
    return html(s, d).select("id", F.md5(X.shift_headings(F.col("h"))).alias("digest"))


@query(r"SELECT id, array_to_string(list_transform(regexp_extract_all('[Illustration: ' || coalesce(title, '') || ' ] [illustration: b]', '(?i)\[Illustration:\s*([^\]]*?)\]', 1), lambda c: trim(c)), '|') AS captions FROM " + _H)
def captions(s, d):
    text = F.concat(F.lit("[Illustration: "), F.coalesce("title", F.lit("")), F.lit(" ] [illustration: b]"))
    return html(s, d).select("id", F.array_join(X.captions(text), "|").alias("captions"))


@query("SELECT id, replace(replace(replace(replace(title, '&', '&amp;'), '\"', '&quot;'), '<', '&lt;'), '>', '&gt;') AS safe FROM chapters")
def escape_attribute(s, d):
    return T(s, d, "chapters").select("id", X.escape_attribute(F.col("title")).alias("safe"))


@query(rf"SELECT doc_id, regexp_matches(text, '{X.MOJIBAKE}') AS broken FROM {_DOC}")
def mojibake(s, d):
    return docs(s, d).select("doc_id", X.has_mojibake(F.col("text")).alias("broken"))


@query(rf"SELECT id, regexp_matches(html_content || coalesce(title, ''), '{X.residue_pattern(PUBLISHER)}') AS residue FROM {_H}")
def residue(s, d):
    return html(s, d).select("id", X.has_residue(F.concat("h", F.coalesce("title", F.lit(""))), PUBLISHER).alias("residue"))


@query(
    rf"""SELECT doc_id, round(CASE WHEN len(w) > 0 THEN len(list_filter(w, lambda x: regexp_matches(regexp_replace(x, '[\x{{2018}}\x{{2019}}\x{{201C}}\x{{201D}}\x{{2014}}\x{{2013}}\x{{2026}}\x{{A0}}\x{{200A}}\x{{2060}}]', '', 'g'), '[^\x00-\x7F]'))) / len(w) ELSE 0 END, 6) AS ratio
       FROM (SELECT doc_id, list_filter(regexp_split_to_array(text, '[{_WS}]+'), lambda x: length(x) > 2) AS w FROM {_DOC}) t"""
)
def non_english_ratio(s, d):
    return docs(s, d).select("doc_id", F.round(X.non_english_ratio(F.col("text")), 6).alias("ratio"))


@query(
    r"""SELECT id, coalesce(try_cast(nullif(regexp_extract(title, '(?i)\bchapter\s+(\d+)\b', 1), '') AS INTEGER), try_cast(nullif(regexp_extract(title, '(?i)\bch\.?\s+(\d+)\b', 1), '') AS INTEGER),
       MAP {'I':1,'II':2,'III':3,'IV':4,'V':5,'VI':6,'VII':7,'VIII':8,'IX':9,'X':10,'XI':11,'XII':12,'XIII':13,'XIV':14,'XV':15,'XVI':16,'XVII':17,'XVIII':18,'XIX':19,'XX':20}[upper(regexp_extract(title, '(?i)\bchapter\s+(X{0,2}(?:IX|IV|V?I{0,3}))\b', 1))]) AS n FROM chapters"""
)
def chapter_number(s, d):
    return T(s, d, "chapters").select("id", M.chapter_number(F.col("title")).alias("n"))


_WORDS = rf"list_filter(regexp_split_to_array(text, '[{_WS}]+'), lambda w: regexp_matches(w, '[a-zA-Z]'))"
_SYLLABLES = """WITH w AS (SELECT DISTINCT unnest(string_split(lower(title), ' ')) AS word FROM books WHERE title IS NOT NULL), z AS (SELECT word, regexp_replace(word, '[^a-z]', '', 'g') AS z FROM w),
       a AS (SELECT *, len(regexp_extract_all(z, '[aeiouy]+')) AS n1 FROM z), b AS (SELECT *, n1 - CASE WHEN z LIKE '%e' AND n1 > 1 THEN 1 ELSE 0 END AS n2 FROM a),
       c AS (SELECT *, n2 + CASE WHEN regexp_matches(z, '[^aeiouy]le$') THEN 1 ELSE 0 END AS n3 FROM b),
       e AS (SELECT *, n3 - CASE WHEN regexp_matches(z, '[^td]ed$') AND length(z) > 3 AND n3 > 1 THEN 1 ELSE 0 END AS n4 FROM c)"""


@query(_SYLLABLES + " SELECT word, CASE WHEN length(z) <= 2 THEN 1 ELSE greatest(1, n4) END AS syllables FROM e")
def syllables(s, d):
    words = T(s, d, "books").where("title is not null").select(F.explode(F.split(F.lower("title"), " ")).alias("word")).distinct()
    return words.select("word", M.syllables(F.col("word")).alias("syllables"))


_MASK = "text"
for _a in M.ABBREVIATIONS:
    _MASK = f"replace({_MASK}, '{_a}', '{_a.replace('.', '~', 1)}')"
_SENT = rf"list_filter(regexp_split_to_array({_MASK}, '[.!?]+'), lambda x: regexp_matches(x, '[^{_WS}]'))"


@query(rf"SELECT doc_id, len({_WORDS}) AS words, len({_SENT}) AS sentences FROM {_DOC} AND lang = 'en'")
def words_and_sentences(s, d):
    df = docs(s, d).where("lang = 'en'")
    return df.select("doc_id", F.size(M.words(F.col("text"))).cast("long").alias("words"), F.size(M.sentences(F.col("text"))).cast("long").alias("sentences"))


@query(
    rf"""WITH t AS (SELECT doc_id, {_WORDS} AS w, len({_SENT}) AS s FROM {_DOC} AND lang = 'en'), x AS (SELECT doc_id, unnest(w) AS word FROM t), z AS (SELECT doc_id, regexp_replace(lower(word), '[^a-z]', '', 'g') AS z FROM x),
       a AS (SELECT *, len(regexp_extract_all(z, '[aeiouy]+')) AS n1 FROM z), b AS (SELECT *, n1 - CASE WHEN z LIKE '%e' AND n1 > 1 THEN 1 ELSE 0 END AS n2 FROM a),
       c AS (SELECT *, n2 + CASE WHEN regexp_matches(z, '[^aeiouy]le$') THEN 1 ELSE 0 END AS n3 FROM b), e AS (SELECT doc_id, CASE WHEN length(z) <= 2 THEN 1 ELSE greatest(1, n3 - CASE WHEN regexp_matches(z, '[^td]ed$') AND length(z) > 3 AND n3 > 1 THEN 1 ELSE 0 END) END AS syl FROM c),
       g AS (SELECT doc_id, sum(syl)::DOUBLE AS syl FROM e GROUP BY 1), f AS (SELECT t.doc_id, len(w) AS nw, CASE WHEN len(w) > 0 AND s > 0 THEN greatest(0.0, least(100.0, floor((206.835::DOUBLE - 1.015::DOUBLE * (len(w) / s) - 84.6::DOUBLE * (syl / len(w))) * 10 + 0.5) / 10)) ELSE 50.0 END AS flesch FROM t LEFT JOIN g USING (doc_id))
       SELECT doc_id, round(flesch, 1)::DOUBLE AS flesch, CASE WHEN flesch >= 90 THEN 'A1' WHEN flesch >= 80 THEN 'A2' WHEN flesch >= 60 THEN 'B1' WHEN flesch >= 50 THEN 'B2' WHEN flesch >= 30 THEN 'C1' ELSE 'C2' END AS cefr,
       (floor((100 - flesch) * 10 + 0.5) / 10)::DOUBLE AS difficulty, greatest(1, floor(nw / 250 + 0.5))::BIGINT AS minutes FROM f"""
)
def flesch_levels(s, d):
    df = spread(docs(s, d).where("lang = 'en'").select("doc_id", "text")).select("doc_id", M.words(F.col("text")).alias("w"), F.size(M.sentences(F.col("text"))).alias("n"))
    df = df.select("doc_id", F.size("w").alias("nw"), "n", M.total_syllables(F.col("w")).alias("syl"))
    score = df.withColumn("flesch", M.flesch(F.col("nw"), F.col("n"), F.col("syl")))
    return score.select("doc_id", F.round("flesch", 1).alias("flesch"), M.cefr(F.col("flesch")).alias("cefr"), M.difficulty(F.col("flesch")).alias("difficulty"), M.reading_minutes(F.col("nw")).alias("minutes"))


@query(rf"SELECT id, len(list_filter(regexp_split_to_array({STRIP}, '[。！？；\n]+'), lambda x: regexp_matches(x, '[^{_WS}]'))) AS sentences FROM {_Z}")
def sentences_zh(s, d):
    return html(s, d, "zh_chapters").select("id", F.size(M.zh_sentences(X.strip_html(F.col("h")))).cast("long").alias("sentences"))


_ZH_CASE = "CASE " + " ".join(f"WHEN regexp_matches(title, '{p}') THEN '{n}'" for n, p in M.ZH_PATTERNS) + " END"


@query(f"SELECT id, {_ZH_CASE} AS pattern FROM zh_chapters")
def zh_title_pattern(s, d):
    return T(s, d, "zh_chapters").select("id", M.zh_title_pattern(F.col("title")).alias("pattern"))


@query(rf"""SELECT id, CASE WHEN length(t) < 100 THEN false ELSE len(regexp_extract_all(t, '[，。！？、；：""''（）《》【】…—·.,!?;:()]')) / length(t) < 0.02 END AS needs FROM (SELECT id, {STRIP} AS t FROM {_Z}) x""")
def needs_punctuation(s, d):
    return html(s, d, "zh_chapters").select("id", X.needs_punctuation(X.strip_html(F.col("h"))).alias("needs"))


@query("SELECT doc_id, len(list_transform(range(1, greatest(length(text), 1) + 1, 2000), lambda i: substr(text, i, 2000))) AS pieces, md5(array_to_string(list_transform(range(1, greatest(length(text), 1) + 1, 2000), lambda i: substr(text, i, 2000)), '|')) AS digest FROM documents WHERE text IS NOT NULL")
def chunk_text(s, d):
    pieces = X.chunks(F.col("text"))
    return docs(s, d).select("doc_id", F.size(pieces).cast("long").alias("pieces"), F.md5(F.array_join(pieces, "|")).alias("digest"))


@query(
    rf"""SELECT doc_id, CASE WHEN regexp_matches(text, '[äöüßÄÖÜ]') THEN 'de' WHEN regexp_matches(text, '[ñáéíóú¿¡ÑÁÉÍÓÚ]') THEN 'es' WHEN regexp_matches(text, '[àâçèêëîïôùûüœÀÂÇÈÊËÎÏÔÙÛŒ]') THEN 'fr' WHEN regexp_matches(text, '[ìòÌÒ]') THEN 'it' ELSE 'la' END AS language FROM {_DOC}"""
)
def guess_language(s, d):
    return docs(s, d).select("doc_id", M.guess_language(F.col("text")).alias("language"))


@query(f"SELECT id, translate(coalesce(author, ''), '{chinese._FROM}', '{chinese._TO}') AS simplified FROM zh_sources")
def to_simplified(s, d):
    return T(s, d, "zh_sources").select("id", chinese.to_simplified(F.coalesce("author", F.lit(""))).alias("simplified"))


@query(f"SELECT id, CASE WHEN length(coalesce(author, '')) = 0 THEN false ELSE length(translate(author, '{chinese._FROM}', '')) * 1.0 / length(author) < 0.98 END AS traditional FROM zh_sources")
def is_traditional(s, d):
    return T(s, d, "zh_sources").select("id", chinese.is_traditional(F.coalesce("author", F.lit(""))).alias("traditional"))


@query(r"SELECT id, trim(regexp_replace(regexp_replace(coalesce(title, ''), '[^a-zA-Z0-9\s]+', ' ', 'g'), '\s+', ' ', 'g')) AS plain, lower(left(coalesce(title, ''), 500)) AS head FROM books")
def normalize_title(s, d):
    plain = F.trim(F.regexp_replace(F.regexp_replace(F.coalesce("title", F.lit("")), r"[^a-zA-Z0-9\s]+", " "), r"\s+", " "))
    return T(s, d, "books").select("id", plain.alias("plain"), F.lower(F.left(F.coalesce("title", F.lit("")), F.lit(500))).alias("head"))


@query(r"SELECT doc_id, md5(trim(regexp_replace(regexp_replace(lower(text), '[^a-z0-9\s]+', ' ', 'g'), '\s+', ' ', 'g'))) AS digest FROM documents WHERE text IS NOT NULL AND lang = 'en'")
def normalize_audit(s, d):
    return docs(s, d).where("lang = 'en'").select("doc_id", F.md5(M.normalize_ascii(F.col("text"))).alias("digest"))


@query(
    """SELECT record_id, CASE WHEN download_count >= 1000000 THEN CASE WHEN download_count % 1000000 = 250000 THEN printf('%d.3M', download_count // 1000000) ELSE printf('%.1fM', download_count / 1000000) END
       WHEN download_count >= 1000 THEN CASE WHEN download_count % 1000 = 250 THEN printf('%d.3K', download_count // 1000) ELSE printf('%.1fK', download_count / 1000) END ELSE download_count::VARCHAR END AS shown FROM gutendex_authors"""
)
def format_number(s, d):
    """Every record; printf takes exact ties to the even digit, the operator up, so the SQL states the one tie that differs."""
    return T(s, d, "gutendex_authors").select("record_id", X.short_number(F.col("download_count")).alias("shown"))


@query(r"SELECT id, coalesce(nullif(lower(regexp_extract(href, '\.([a-zA-Z0-9]+)(?:\?[^/]*)?$', 1)), ''), 'epub') AS ext FROM chapters")
def ext_from_url(s, d):
    ext = F.lower(F.regexp_extract("href", r"\.([a-zA-Z0-9]+)(?:\?[^/]*)?$", 1))
    return T(s, d, "chapters").select("id", F.coalesce(F.nullif(ext, F.lit("")), F.lit("epub")).alias("ext"))


@query("SELECT pg_id, printf('pg%d-images.epub', pg_id) AS file, regexp_replace(coalesce(source_type, '') || '/' || id, '[^a-zA-Z0-9]', '_', 'g') AS cache_key FROM books WHERE pg_id IS NOT NULL")
def url_templates(s, d):
    key = F.regexp_replace(F.concat(F.coalesce("source_type", F.lit("")), F.lit("/"), "id"), "[^a-zA-Z0-9]", "_")
    return T(s, d, "books").where("pg_id is not null").select("pg_id", F.format_string("pg%d-images.epub", "pg_id").alias("file"), key.alias("cache_key"))


@query(r"SELECT id, trim(regexp_replace(regexp_replace(title, '[【】《》\[\]]', '', 'g'), '(?i)(epub|txt)$', '')) AS clean FROM zh_sources")
def clean_title(s, d):
    return T(s, d, "zh_sources").select("id", F.trim(F.regexp_replace(F.regexp_replace("title", r"[【】《》\[\]]", ""), "(?i)(epub|txt)$", "")).alias("clean"))


@query("SELECT doc_id, sha1(text) AS sha, md5(text) AS digest FROM documents WHERE text IS NOT NULL")
def content_hash(s, d):
    return docs(s, d).select("doc_id", F.sha1("text").alias("sha"), F.md5("text").alias("digest"))


@query(rf"SELECT doc_id, md5(regexp_replace(regexp_replace(regexp_replace(replace(text, '-', '--'), ' ?-- ?', chr(8288) || chr(8212), 'g'), ' ?' || chr(8212) || ' ?', chr(8212), 'g'), chr(8288) || '?' || chr(8212), chr(8288) || chr(8212), 'g')) AS digest FROM {_DOC}")
def em_dashes(s, d):
    return docs(s, d).select("doc_id", F.md5(typography.em_dashes(F.replace(F.col("text"), F.lit("-"), F.lit("--")))).alias("digest"))


@query(rf"SELECT id, md5(regexp_replace(html_content, '(\d)[{_WS}]*-[{_WS}]*(\d)', '\1' || chr(8288) || chr(8211) || chr(8288) || '\2', 'g')) AS digest FROM {_H}")
def en_dashes(s, d):
    return html(s, d).select("id", F.md5(typography.en_dashes(F.col("h"))).alias("digest"))


# ---- results that SQL cannot state; tested on literals


@query()
def typographize(s, d):
    return spread(html(s, d)).select("id", typography.typographize(F.col("h")).alias("html"))


@query()
def modernize_spelling(s, d):
    return spread(html(s, d)).select("id", spelling.modernize_spelling(F.col("h")).alias("html"))


@query()
def semanticize(s, d):
    return spread(html(s, d)).select("id", S.semanticize(F.col("h")).alias("html"))


@query()
def clean_chapter(s, d):
    return spread(html(s, d)).select("id", X.clean_chapter(F.col("h"), PUBLISHER).alias("html"))


# ---- checks over whole books


def _chapters(s, d):
    return T(s, d, "chapters").select("id", "book_id", "order_num", "title", "html_content", "word_count").where("book_id is not null").dropDuplicates(["id"])


_DISTINCT = "(SELECT DISTINCT id, book_id, order_num, title, html_content, word_count FROM chapters WHERE book_id IS NOT NULL)"


@query(
    rf"""WITH c AS {_DISTINCT}, m AS (SELECT book_id, id, coalesce(word_count, 0) AS w, lower(trim(coalesce(title, ''))) AS t, row_number() OVER (PARTITION BY book_id ORDER BY order_num, id) AS p,
         regexp_replace(lower({STRIP.replace('html_content', "coalesce(html_content, '')")}), '[{_WS}]+', '', 'g') AS x, regexp_matches(coalesce(html_content, ''), '{X.MOJIBAKE}') AS k FROM c),
       dt AS (SELECT book_id, count(*) AS n FROM (SELECT book_id, t FROM m WHERE t <> '' GROUP BY 1, 2 HAVING count(*) > 1) q GROUP BY 1),
       dc AS (SELECT book_id, sum(n) AS n FROM (SELECT book_id, sha1(x) AS h, count(*) AS n FROM m WHERE length(x) >= 100 GROUP BY 1, 2 HAVING count(*) > 1) q GROUP BY 1)
       SELECT m.book_id, count(*) AS n_chapters, sum(w)::BIGINT AS n_words, count(*) FILTER (w < 50) AS n_empty, max(k::INT) AS broken, coalesce(max(dt.n), 0)::BIGINT AS dup_titles, coalesce(max(dc.n), 0)::BIGINT AS dup_chapters,
       round(stddev_pop(CASE WHEN w > 0 THEN w END) / avg(CASE WHEN w > 0 THEN w END), 6) AS cv, max_by(w, p)::INTEGER AS last_words FROM m LEFT JOIN dt ON dt.book_id = m.book_id LEFT JOIN dc ON dc.book_id = m.book_id GROUP BY m.book_id"""
)
def quality_checks(s, d):
    out = quality.book_checks(_chapters(s, d), PUBLISHER)
    return out.select("book_id", "n_chapters", "n_words", "n_empty", "broken", "dup_titles", "dup_chapters", F.round("cv", 6).alias("cv"), "last_words")


_TRIM = lambda x: rf"regexp_replace({x}, '^[{_WS}]+|[{_WS}]+\z', '', 'g')"
_FULL = STRIP.replace("html_content", "coalesce(html_content, '')")
_SIGNS = r"[\x{2018}\x{2019}\x{201C}\x{201D}\x{2014}\x{2013}\x{2026}\x{A0}\x{200A}\x{2060}]"


@query(
    rf"""WITH c AS {_DISTINCT}, bk AS (SELECT DISTINCT id, pg_id IS NOT NULL AS cover FROM books WHERE zh_source_id IS NULL),
       m AS (SELECT book_id, id, coalesce(word_count, 0) AS w, {_TRIM("lower(coalesce(title, ''))")} AS t, row_number() OVER (PARTITION BY book_id ORDER BY order_num, id) AS p, regexp_replace(lower({_FULL}), '[{_WS}]+', '', 'g') AS x,
         regexp_matches(coalesce(html_content, ''), '{X.MOJIBAKE}') AS k, regexp_matches(coalesce(html_content, ''), '{X.residue_pattern(PUBLISHER)}') AS r, list_filter(regexp_split_to_array({_FULL}, '[{_WS}]+'), lambda v: length(v) > 2) AS lw,
         coalesce(try_cast(nullif(regexp_extract(title, '(?i)\bchapter\s+(\d+)\b', 1), '') AS INTEGER), try_cast(nullif(regexp_extract(title, '(?i)\bch\.?\s+(\d+)\b', 1), '') AS INTEGER),
         MAP {{'I':1,'II':2,'III':3,'IV':4,'V':5,'VI':6,'VII':7,'VIII':8,'IX':9,'X':10,'XI':11,'XII':12,'XIII':13,'XIV':14,'XV':15,'XVI':16,'XVII':17,'XVIII':18,'XIX':19,'XX':20}}[upper(regexp_extract(title, '(?i)\bchapter\s+(X{{0,2}}(?:IX|IV|V?I{{0,3}}))\b', 1))]) AS num FROM c),
       dt AS (SELECT book_id, count(*) AS n FROM (SELECT book_id, t FROM m WHERE t <> '' GROUP BY 1, 2 HAVING count(*) > 1) q GROUP BY 1),
       dc AS (SELECT book_id, sum(n) AS n FROM (SELECT book_id, sha1(x) AS h, count(*) AS n FROM m WHERE length(x) >= 100 GROUP BY 1, 2 HAVING count(*) > 1) q GROUP BY 1),
       dp AS (SELECT book_id, count(*) AS n FROM (SELECT book_id, y FROM (SELECT book_id, lower({_TRIM("regexp_replace(q, '<[^>]+>', '', 'g')")}) AS y FROM (SELECT book_id, unnest(regexp_extract_all(coalesce(html_content, ''), '(?is)<p[^>]*>.*?</p>')) AS q FROM c) u) v WHERE length(y) > 50 GROUP BY 1, 2 HAVING count(*) > 1) z GROUP BY 1),
       dg AS (SELECT book_id, count(*) AS n FROM (SELECT book_id, num - lag(num) OVER (PARTITION BY book_id ORDER BY num) AS step, count(*) OVER (PARTITION BY book_id) AS many FROM m WHERE num IS NOT NULL) q WHERE many >= 3 AND step > 1 GROUP BY 1),
       g AS (SELECT book_id, count(*) AS n, sum(w) AS tw, count(*) FILTER (w < 50) AS e, max(k::INT) AS k, count(*) FILTER (r) AS r, max_by(w, p) AS lastw, min_by(w, p) AS firstw, min_by(t, p) AS firstt, avg(w) AS mw,
         coalesce(sum(len(list_filter(lw, lambda v: regexp_matches(regexp_replace(v, '{_SIGNS}', '', 'g'), '[^\x00-\x7F]')))) FILTER (p <= 3) / nullif(sum(len(lw)) FILTER (p <= 3), 0), 0) AS fr,
         stddev_pop(CASE WHEN w > 0 THEN w END) / avg(CASE WHEN w > 0 THEN w END) AS cv, count(*) FILTER (w > 0) AS nf FROM m GROUP BY 1),
       a AS (SELECT bk.id AS book_id, cover, coalesce(g.n, 0) AS n, coalesce(tw, 0) AS tw, coalesce(e, 0) AS e, coalesce(g.k, 0) AS k, coalesce(g.r, 0) AS r, lastw, mw, fr, cv, coalesce(nf, 0) AS nf, coalesce(dt.n, 0) AS dt, coalesce(dc.n, 0) AS dc, coalesce(dp.n, 0) AS dp, coalesce(dg.n, 0) AS dg,
         coalesce(g.n >= 2 AND tw > 0 AND firstw >= 0.3 * tw AND regexp_matches(firstt, '\b(introduction|preface|translator|foreword|prologue)\b'), false) AS pre
         FROM bk LEFT JOIN g ON g.book_id = bk.id LEFT JOIN dt ON dt.book_id = bk.id LEFT JOIN dc ON dc.book_id = bk.id LEFT JOIN dp ON dp.book_id = bk.id LEFT JOIN dg ON dg.book_id = bk.id),
       s1 AS (SELECT *, CASE WHEN tw > 1500000 THEN 0 ELSE 100 - CASE WHEN n = 0 THEN 50 WHEN n < 2 THEN 15 ELSE 0 END - CASE WHEN tw < 1000 THEN 30 WHEN tw < 5000 THEN 10 ELSE 0 END - CASE WHEN tw > 800000 THEN 10 ELSE 0 END END
         - e * 5 - CASE WHEN cover THEN 0 ELSE 10 END - CASE WHEN k > 0 THEN 15 ELSE 0 END - CASE WHEN dt > 0 THEN 10 ELSE 0 END - CASE WHEN n >= 3 AND lastw < mw * 0.3 AND lastw < 200 THEN 10 ELSE 0 END - CASE WHEN dg > 0 THEN 5 ELSE 0 END AS sc FROM a),
       s2 AS (SELECT *, CASE WHEN r >= n * 0.5 AND n > 0 THEN least(sc, 30) ELSE sc - floor(coalesce(r / nullif(n, 0), 0) * 40 + 0.5) END - CASE WHEN dp > 3 THEN least(15, dp * 3) ELSE 0 END - CASE WHEN fr > 0.3 THEN 20 WHEN fr > 0.15 THEN 10 ELSE 0 END
         - CASE WHEN nf >= 4 THEN CASE WHEN cv > 2.0 THEN 10 WHEN cv > 1.5 THEN 5 ELSE 0 END ELSE 0 END AS sd FROM s1),
       s3 AS (SELECT *, greatest(0, least(100, CASE WHEN dc > 0 THEN 0 ELSE sd END))::INTEGER AS score FROM s2)
       SELECT book_id, score, CASE WHEN score >= 80 THEN CASE WHEN pre THEN 'needs_review' ELSE 'auto_approved' END WHEN score >= 60 THEN 'needs_review' ELSE 'rejected' END AS tier, score >= 60 AS passed,
       array_to_string(list_filter([CASE WHEN n = 0 THEN 'no_chapters' END, CASE WHEN n = 1 THEN 'few_chapters' END, CASE WHEN tw < 1000 THEN 'very_few_words' END, CASE WHEN tw BETWEEN 1000 AND 4999 THEN 'few_words' END, CASE WHEN tw > 1500000 THEN 'impossible_size' END,
       CASE WHEN tw > 800000 AND tw <= 1500000 THEN 'very_long' END, CASE WHEN e > 0 THEN 'empty_chapters' END, CASE WHEN NOT cover THEN 'no_cover' END, CASE WHEN k > 0 THEN 'encoding' END, CASE WHEN dt > 0 THEN 'repeated_titles' END,
       CASE WHEN n >= 3 AND lastw < mw * 0.3 AND lastw < 200 THEN 'truncated_end' END, CASE WHEN dg > 0 THEN 'sequence_gaps' END, CASE WHEN r > 0 THEN 'residue' END, CASE WHEN dp > 3 THEN 'repeated_paragraphs' END, CASE WHEN fr > 0.15 THEN 'foreign' END,
       CASE WHEN nf >= 4 AND cv > 1.5 THEN 'length_variation' END, CASE WHEN dc > 0 THEN 'equal_chapters' END, CASE WHEN pre THEN 'preface_dominates' END], lambda v: v IS NOT NULL), ',') AS issues FROM s3"""
)
def quality_scores(s, d):
    """Books without a Chinese source; a book with a number in the source catalogue has its cover there."""
    b = T(s, d, "books").where("zh_source_id is null").select(F.col("id").alias("book_id"), F.col("pg_id").isNotNull().alias("has_cover")).distinct()
    out = quality.english_quality(b, _chapters(s, d), PUBLISHER)
    return out.withColumn("issues", F.array_join("issues", ","))


@query(
    f"""SELECT book_id FROM (SELECT book_id, count(*) AS n, sum(coalesce(word_count, 0)) AS total, arg_min(coalesce(word_count, 0), (order_num, id)) AS f, arg_min(lower(title), (order_num, id)) AS t FROM {_DISTINCT} c GROUP BY 1) q
       WHERE n >= 2 AND total > 0 AND f >= 0.3 * total AND regexp_matches(t, '(introduction|preface|translator|foreword|prologue)')"""
)
def first_dominates(s, d):
    return quality.first_dominates(_chapters(s, d))


_NA = r"trim(regexp_replace(regexp_replace(lower({0}), '[^a-z0-9\s]+', ' ', 'g'), '\s+', ' ', 'g'))"


@query(
    f"""WITH t AS (SELECT doc_id, {_NA.replace('{0}', "coalesce(text, '')")} AS a, {_NA.replace('{0}', "coalesce(title, '') || ' ' || coalesce(text, '')")} AS b FROM documents WHERE lang = 'en'),
       x AS (SELECT doc_id, w, count(*) AS n FROM (SELECT doc_id, unnest(string_split(a, ' ')) AS w FROM t WHERE a <> '') q GROUP BY 1, 2), y AS (SELECT doc_id, w, count(*) AS n FROM (SELECT doc_id, unnest(string_split(b, ' ')) AS w FROM t WHERE b <> '') q GROUP BY 1, 2),
       m AS (SELECT coalesce(x.doc_id, y.doc_id) AS doc_id, sum(abs(coalesce(x.n, 0) - coalesce(y.n, 0))) / sum(coalesce(x.n, 0) + coalesce(y.n, 0)) AS miss FROM x FULL OUTER JOIN y ON x.doc_id = y.doc_id AND x.w = y.w GROUP BY 1),
       r AS (SELECT t.doc_id, CASE WHEN a = '' THEN 0 ELSE len(string_split(a, ' ')) END AS na, CASE WHEN b = '' THEN 0 ELSE len(string_split(b, ' ')) END AS nb, CASE WHEN length(a) > 600 AND length(b) > 600 THEN CASE WHEN contains(b, substr(a, 201, 200)) THEN 'OK' ELSE 'MISS' END ELSE 'NA' END AS alignment,
       coalesce(miss, 1.0) AS miss FROM t LEFT JOIN m ON m.doc_id = t.doc_id) SELECT doc_id, alignment, round(miss::DOUBLE, 6) AS miss_rate, CASE WHEN na / greatest(nb, 1) BETWEEN 0.95 AND 1.05 AND alignment <> 'MISS' AND miss < 0.05 THEN 'OK' WHEN na / greatest(nb, 1) BETWEEN 0.9 AND 1.1 AND miss < 0.1 THEN 'WARN' ELSE 'SUSPECT' END AS verdict FROM r"""
)
def audit_fidelity(s, d):
    english = spread(T(s, d, "documents").where("lang = 'en'").select("doc_id", "title", "text"))
    pairs = english.select(F.col("doc_id").alias("key"), F.coalesce("text", F.lit("")).alias("ours"), F.concat(F.coalesce("title", F.lit("")), F.lit(" "), F.coalesce("text", F.lit(""))).alias("theirs"))
    return quality.fidelity(pairs).select(F.col("key").alias("doc_id"), "alignment", F.round("miss_rate", 6).alias("miss_rate"), "verdict")


@query()
def vocabulary_levels(s, d):
    words = s.createDataFrame([("书信", 1), ("灯火", 2), ("江水", 2), ("旧友", 3), ("石阶", 5), ("樵夫", 6)], "word string, level int")
    texts = html(s, d, "zh_chapters").select(F.col("id").alias("key"), X.strip_html(F.col("h")).alias("text"))
    return quality.vocabulary_levels(texts, words).groupBy("key").agg(F.sum("n").alias("tokens"), (F.sum(F.col("level") * F.col("n")) / F.sum(F.when(F.col("level").isNotNull(), F.col("n")))).alias("mean_level"))
