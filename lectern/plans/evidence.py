"""Queries over words, layout, structure, hierarchy and fragments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as t
from ..operators import fragments, hierarchy, layout, ocr, structure
from ..sources.tables import once, table
from . import fixtures as fx

_joined = lambda c: F.array_join(F.col(c), ",").alias(c)


def page_confidence_summary(spark: SparkSession, d: str) -> DataFrame:
    return ocr.confidence_summary(fx.words(spark, d))


def semantic_confidence_summary(spark: SparkSession, d: str) -> DataFrame:
    return ocr.semantic_confidence_summary(fx.words(spark, d))


def page_review_first_pass(spark: SparkSession, d: str) -> DataFrame:
    return ocr.page_review_first_pass(fx.words(spark, d)).select("source", "page", "n_words", "mean_confidence", "longest", _joined("reasons"))


def page_review_refined(spark: SparkSession, d: str) -> DataFrame:
    return ocr.page_review_refined(fx.words(spark, d)).select("source", "page", "n_words", "mean_confidence", "below_50", _joined("reasons"))


def translation_gate(spark: SparkSession, d: str) -> DataFrame:
    return ocr.translation_gate(fx.words(spark, d))


def document_lexicon(spark: SparkSession, d: str) -> DataFrame:
    return ocr.lexicon(fx.words(spark, d))


def lexicon_spelling_candidates(spark: SparkSession, d: str) -> DataFrame:
    words = fx.words(spark, d)
    out = ocr.spelling_candidates(words, ocr.lexicon(words))
    shown = F.array_join(F.transform("proposals", lambda p: F.concat_ws(":", p["known"], p["canonical"], p["edit_distance"].cast("string"), p["occurrences"].cast("string"))), "|")
    return out.select("source", "page", "line_num", "word_num", "original", "confidence", "token", "status", "ties", shown.alias("proposals"), F.array_join(F.transform("bbox", lambda x: x.cast("string")), ",").alias("bbox"))


def ocr_lines(spark: SparkSession, d: str) -> DataFrame:
    words = layout.regions(fx.words(spark, d, dealt_by_page=True))
    return layout.lines(words).select("source", "page", "region", "line_num", "line_index", "text", "x0", "y0", "x1", "y1", "word_count", "mean_confidence")


def page_text(spark: SparkSession, d: str) -> DataFrame:
    return ocr.page_text(fx.words(spark, d, dealt_by_page=True))


def region_word_counts(spark: SparkSession, d: str) -> DataFrame:
    words = layout.regions(fx.words(spark, d, dealt_by_page=True))
    placed = layout.column_regions(words, layout.best_gutter(layout.gutter_candidates(words)))
    return placed.groupBy("source", "page", "region").agg(F.count(F.lit(1)).alias("n_words"))


def gutter_candidates(spark: SparkSession, d: str) -> DataFrame:
    return layout.gutter_candidates(layout.regions(fx.words(spark, d, dealt_by_page=True)))


def best_gutters(spark: SparkSession, d: str) -> DataFrame:
    return layout.best_gutter(layout.gutter_candidates(layout.regions(fx.words(spark, d, dealt_by_page=True))))


def page_layout(spark: SparkSession, d: str) -> DataFrame:
    words = layout.regions(fx.words(spark, d, dealt_by_page=True))
    return layout.page_layout(words, layout.best_gutter(layout.gutter_candidates(words)))


def native_column_signal(spark: SparkSession, d: str) -> DataFrame:
    lines = layout.lines(layout.regions(fx.words(spark, d, dealt_by_page=True))).withColumn("page_width", F.lit(fx.PAGE_WIDTH))
    return layout.native_column_signal(lines)


def phase_sequence_status(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import Window as W

    order = W.partitionBy("procedure", "phase").orderBy("number", "shipped", "part", "supplier", "price")
    steps = fx.numbered(spark, d).withColumns(structure.sequence_columns(order))
    out = steps.groupBy("procedure", "phase").agg(F.count(F.lit(1)).alias("n_steps"), F.coalesce(F.sum("break"), F.lit(0)).alias("breaks"))
    return out.withColumn("status", structure.sequence_status(F.col("n_steps"), F.col("breaks")))


def _lines(spark: SparkSession, d: str) -> DataFrame:
    return fx.source_lines(spark, d)


def procedures(spark: SparkSession, d: str) -> DataFrame:
    out = structure.procedures(_lines(spark, d))
    return out.select("page", "region", "anchor", "repair_number", "title", "n_steps", "n_phases", F.array_join(F.transform("step_numbers", lambda x: x.cast("string")), ",").alias("step_numbers"), "n_uncategorised", "sequence_status", _joined("review_reasons"))


def procedure_steps(spark: SparkSession, d: str) -> DataFrame:
    return structure.steps(_lines(spark, d)).select("page", "region", "anchor", "phase_no", "step_no", "phase", "number", "text", "subitems", "n_subitems", "least_confidence")


def procedure_phases(spark: SparkSession, d: str) -> DataFrame:
    return structure.phases(_lines(spark, d)).select("page", "region", "anchor", "phase_no", "phase", "phase_source", "n_steps", "status")


def numbered_lines(spark: SparkSession, d: str) -> DataFrame:
    return structure.numbered_lines(_lines(spark, d)).select("page", "region", "line_index", "number", "body")


def page_class(spark: SparkSession, d: str) -> DataFrame:
    return structure.page_class(_lines(spark, d)).drop("source")


def page_class_histogram(spark: SparkSession, d: str) -> DataFrame:
    return structure.page_class(_lines(spark, d)).groupBy("page_class").agg(F.count(F.lit(1)).alias("n_pages"))


def title_candidates(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_num", "line"))
    upper = lines.select("doc_id", "line_num", F.when((F.col("doc_id") + F.col("line_num")) % 3 == 0, F.translate("line", "abcdefghijklmnopqrstuvwxyzäöüéèñ", "ABCDEFGHIJKLMNOPQRSTUVWXYZÄÖÜÉÈÑ")).otherwise(F.col("line")).alias("line"))
    title, heading = F.col("title"), F.col("heading")
    upper = once(once(upper, title=t.spaced(F.col("line"))), heading=t.clean_heading(title, True))
    upper = once(upper, is_title=t.is_title(title, True), is_heading=t.is_heading(heading, True))
    return upper.where("is_title OR is_heading").select("doc_id", "line_num", "title", "heading", "is_title", "is_heading")


def heading_ratio(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_num", "line"))
    s = t.spaced(F.col("line"))
    return lines.select("doc_id", "line_num", F.length(t.letters(s)).alias("n_letters"), t.upper_ratio(s).alias("upper_share"), t.noise_ratio(s).alias("noise"))


def contents_pages(spark: SparkSession, d: str) -> DataFrame:
    """Every order's parts as a contents page: a CONTENTS line, group headings, and entries with printed page numbers."""
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey").distinct().join(table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name"), "l_partkey", "left")
    name = F.coalesce("p_name", F.lit("part"))
    k = F.col("l_linenumber")
    text = F.when(k == 1, "Contents:").when(k == 3, "REPAIRS").when(k == 5, "General  information.").otherwise(F.concat(F.lit("  "), name, F.lit(" . . . "), F.col("l_partkey") % 400, F.lit(" ")))
    text = F.when(F.col("l_partkey") % 11 == 0, F.concat(F.lit("#### ... "), name)).otherwise(text)
    return lines.select(F.lit("manual").alias("source"), F.col("l_orderkey").alias("page"), F.when(F.col("l_partkey") % 13 == 0, "header").otherwise("body").alias("region"), (k * 1_000_000 + F.col("l_partkey")).alias("seq"), text.alias("text"))


def contents_entries(spark: SparkSession, d: str) -> DataFrame:
    return hierarchy.contents_entries(contents_pages(spark, d)).drop("source")


def _pages(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select(F.lit("manual").alias("source"), F.col("page_id").alias("page"))


def chapter_ranges(spark: SparkSession, d: str) -> DataFrame:
    return hierarchy.chapters(fx.chapter_anchors(spark, d), _pages(spark, d)).drop("source")


def page_chapter_context(spark: SparkSession, d: str) -> DataFrame:
    pages = _pages(spark, d)
    return hierarchy.page_context(pages, hierarchy.chapters(fx.chapter_anchors(spark, d), pages)).drop("source")


def anchor_titles(spark: SparkSession, d: str) -> DataFrame:
    """Anchors with headers of their own and of following pages: the nations' names stand on every third page."""
    pages = _pages(spark, d)
    nations = table(spark, d, "nation").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("text"))
    heads = pages.where("page % 3 = 0").withColumn("k", F.expr("cast(page % 25 as int)")).join(nations, "k").select("source", "page", F.lit("header").alias("region"), F.lit(0).alias("seq"), "text")
    anchors = pages.where("page % 5 = 0")
    return hierarchy.anchor_titles(anchors, heads).drop("source")


def _context(spark: SparkSession, d: str) -> DataFrame:
    """Chapters of 40 pages each over the manual's pages."""
    pages = fx.source_pages(spark, d)
    return pages.withColumn("chapter_id", F.when(F.col("page") % 29 != 0, F.concat(F.lit("chapter-"), F.expr("page div 40"))))


def fragments_raw(spark: SparkSession, d: str) -> DataFrame:
    out = fragments.raw_fragments(_lines(spark, d))
    return out.select("page", "region", "first_step", "last_step", "n_phases", F.array_join(F.transform("step_numbers", lambda x: x.cast("string")), ",").alias("step_numbers"))


def fragments_accepted(spark: SparkSession, d: str) -> DataFrame:
    out = fragments.fragments_of(_lines(spark, d), _context(spark, d))
    return out.select("page", "region", "first_step", "last_step", "chapter_id", "same_chapter", "accepted", _joined("evidence"), "rejection")


def fragment_links(spark: SparkSession, d: str) -> DataFrame:
    out = fragments.link_candidates(fragments.fragments_of(_lines(spark, d), _context(spark, d)))
    return out.select("from_page", "to_page", "to_region", "chapter_id", F.array_join(F.transform("step_numbers", lambda x: x.cast("string")), ",").alias("step_numbers"), _joined("evidence"))


QUERIES = {
    f.__name__: f
    for f in (
        page_confidence_summary, semantic_confidence_summary, page_review_first_pass, page_review_refined, translation_gate, document_lexicon, lexicon_spelling_candidates,
        ocr_lines, page_text, region_word_counts, gutter_candidates, best_gutters, page_layout, native_column_signal, phase_sequence_status, procedures, procedure_steps,
        procedure_phases, numbered_lines, page_class, page_class_histogram, title_candidates, heading_ratio, contents_entries, chapter_ranges, page_chapter_context,
        anchor_titles, fragments_raw, fragments_accepted, fragment_links,
    )
}
