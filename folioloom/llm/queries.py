"""The queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioloom.llm import boilerplate, lookalike, markup_blocks, mixing, name_links, reading_level, splitting, subjects, tokenizer
from folioloom.session import read_table


def _chapter_texts(spark: SparkSession, d: str) -> DataFrame:
    def one(name: str) -> DataFrame:
        return read_table(spark, d, name).select(F.lit(name).alias("part"), "id", F.col("html_content").alias("text"))

    return one("chapters").unionByName(one("zh_chapters"))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of chapters that look the same and are not the same string."""
    return lookalike.lookalike_pairs(lookalike.lookalike_keys(_chapter_texts(spark, d)))


def p1_classes(spark: SparkSession, d: str) -> DataFrame:
    """One row per chapter with the class of texts that look like it."""
    return lookalike.lookalike_classes(lookalike.lookalike_keys(_chapter_texts(spark, d)))


def p1_canonical(spark: SparkSession, d: str) -> DataFrame:
    """Every chapter in its one form."""
    return lookalike.canonical_texts(_chapter_texts(spark, d))


def _site_documents(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "chapters").select("site", "id", "title", F.col("html_content").alias("text"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Lines and title parts that a site repeats, by chapter."""
    return boilerplate.repeated_lines(_site_documents(spark, d)).select("id", F.col("line_no").cast("int").alias("line_no")).distinct()


def p3_clean(spark: SparkSession, d: str) -> DataFrame:
    """Chapters without the lines that their site repeats."""
    return boilerplate.without_boilerplate(_site_documents(spark, d))


def p3_blocks(spark: SparkSession, d: str) -> DataFrame:
    """The boilerplate blocks of each site: nodes with their support and block; ``full`` marks those with full support."""
    return boilerplate.blocks(boilerplate.scan_lines(_site_documents(spark, d))).select("site", "is_title", "block", "key", "support", "documents", "full")


def _levels(spark: SparkSession, d: str) -> DataFrame:
    return reading_level.reading_levels(_site_documents(spark, d), reading_level.agreeing_grades(read_table(spark, d, "difficulty_results")))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """CEFR level of every chapter with enough prose: the model's, checked by the exact score near a cut."""
    return _levels(spark, d).select("id", "cefr_level").distinct()


def p4_levels(spark: SparkSession, d: str) -> DataFrame:
    """Scores, features, the model's level and the exact one of every chapter with enough prose."""
    return _levels(spark, d)


def p4_checks(spark: SparkSession, d: str) -> DataFrame:
    """By level: documents, those near a cut (decided by the exact score), those the check changed, and those off a cut whose exact level differs."""
    of = lambda c: F.count_if(c)
    differs = F.col("model_level") != F.col("exact_level")
    return _levels(spark, d).groupBy("cefr_level").agg(
        F.count("*").alias("documents"), of(F.col("near_cut")).alias("near_cut"), of(F.col("near_cut") & differs).alias("changed"), of(~F.col("near_cut") & differs).alias("left_to_model")
    )


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Headings, list items, code and formulas of chapters, without markup."""
    return markup_blocks.blocks(_chapter_texts(spark, d)).select("id", "block_kind", "block_text").distinct()


def p5_clean(spark: SparkSession, d: str) -> DataFrame:
    """Chapters as clean text that keeps its structure."""
    return markup_blocks.clean(_chapter_texts(spark, d))


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    """Token ids of every document."""
    return tokenizer.encode_documents(read_table(spark, d, "documents"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    """Subject areas of every document."""
    found = subjects.subject_areas(read_table(spark, d, "documents"), read_table(spark, d, "subject_labels"))
    return found.select("doc_id", "area").distinct()


def p10_composition(spark: SparkSession, d: str) -> DataFrame:
    """Make-up of the corpus by subject area."""
    found = subjects.subject_areas(read_table(spark, d, "documents"), read_table(spark, d, "subject_labels"))
    return subjects.composition(found, read_table(spark, d, "subject_areas"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """Records of three tables whose author means a listed one."""
    books, gutendex, sources = (read_table(spark, d, t) for t in ("books", "gutendex_authors", "zh_sources"))
    no_year = F.lit(None).cast("int")
    records = (
        books.select(F.lit("books").alias("record_table"), F.col("id").cast("string").alias("record_key"), F.col("author").alias("name"), no_year.alias("birth_year"), no_year.alias("death_year"))
        .unionByName(gutendex.select(F.lit("gutendex_authors").alias("record_table"), F.col("record_id").cast("string").alias("record_key"), "name", "birth_year", "death_year"))
        .unionByName(sources.select(F.lit("zh_sources").alias("record_table"), F.col("id").cast("string").alias("record_key"), F.col("author").alias("name"), no_year.alias("birth_year"), no_year.alias("death_year")))
    )
    return name_links.link_names(records, read_table(spark, d, "authors"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Oversized bodies and the lines with which their sections begin."""
    return splitting.oversized_headings(read_table(spark, d, "raw_bodies"))


def p2_pieces(spark: SparkSession, d: str) -> DataFrame:
    """Bodies as ordered pieces under their limit, with overlap."""
    return splitting.split_bodies(read_table(spark, d, "raw_bodies"))


def p9_mix(spark: SparkSession, d: str) -> DataFrame:
    """Documents chosen to give every source its share of all tokens."""
    return mixing.mix(read_table(spark, d, "documents"), read_table(spark, d, "mix_targets"))


def p9_mix_stretched(spark: SparkSession, d: str) -> DataFrame:
    """A mix half as large again as the targets allow: weights tempered towards what the repetition limits leave."""
    return mixing.mix(read_table(spark, d, "documents"), read_table(spark, d, "mix_targets"), stretch=1.5)


def p9_mix_entropy(spark: SparkSession, d: str) -> DataFrame:
    """A mix whose weights are the natural token shares raised to the exponent that gives them the entropy of the targets."""
    targets = read_table(spark, d, "mix_targets")
    shares = {r.source: r.target_share for r in targets.where("target_share is not null").collect()}  # one row per source
    return mixing.mix(read_table(spark, d, "documents"), targets, target_entropy=mixing.entropy(shares))


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    """Shares that the mix reaches."""
    targets = read_table(spark, d, "mix_targets")
    return mixing.reached_shares(mixing.mix(read_table(spark, d, "documents"), targets), targets)


QUERIES = {"p1_found": p1_found, "p1_classes": p1_classes, "p1_canonical": p1_canonical, "p3_found": p3_found, "p3_clean": p3_clean, "p3_blocks": p3_blocks, "p4_found": p4_found, "p4_levels": p4_levels, "p4_checks": p4_checks, "p5_found": p5_found, "p5_clean": p5_clean, "p2_found": p2_found, "p2_pieces": p2_pieces, "p6_found": p6_found, "p9_mix": p9_mix, "p9_shares": p9_shares, "p9_mix_stretched": p9_mix_stretched, "p9_mix_entropy": p9_mix_entropy, "p8_ids": p8_ids, "p10_found": p10_found, "p10_composition": p10_composition}
SQL: dict[str, str] = {}
