"""Continuations of procedures across pages: raw fragments, acceptance by context, link candidates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.shared import discard, stash
from .ocr import reasons
from .structure import LEAST_STEPS, REGION, marked, pieces


def raw_fragments(lines: DataFrame) -> DataFrame:
    """Body regions without a repair number, with two numbered lines at least, that have a phase heading or begin after step 1."""
    return fragments_in(regions_whole(lines))


def regions_whole(lines: DataFrame) -> DataFrame:
    """Regions as pieces, without a look at segments: only regions without a repair number can be fragments, and they have none."""
    numbers = F.transform(F.array_sort(F.collect_list(F.when(F.col("number").isNotNull(), F.struct("line_index", "number")))), lambda x: x["number"])
    out = marked(lines).groupBy(*REGION).agg(numbers.alias("step_numbers"), F.count("phase_source").alias("n_phases"), F.count("repair").alias("n_repairs"))
    return out.withColumn("anchor", F.lit(None))


def fragments_in(found: DataFrame) -> DataFrame:
    """Raw fragments among pieces."""
    out = found.where(F.col("anchor").isNull() & (F.col("n_repairs") == 0) & (F.size("step_numbers") >= 2))
    out = out.withColumns({"first_step": F.element_at("step_numbers", 1), "last_step": F.element_at("step_numbers", -1)})
    return out.where((F.col("n_phases") > 0) | (F.col("first_step") > 1)).select(*REGION, "step_numbers", "n_phases", "first_step", "last_step")


def judged_fragments(fragments: DataFrame, procedure_rows: DataFrame, context: DataFrame) -> DataFrame:
    """Accepted or rejected, with the evidence. A phase heading is enough; numbers alone need the same chapter as the page before, and there a
    procedure or an accepted fragment that ends one step earlier.

    Acceptance depends on acceptance only along a chain of pages and steps that both grow by the fragment's length. What can be reached from
    that which is accepted on its own is found by hops of 1, 2, 4, ... fragments: rounds of equi-joins on (page, step), as many as the
    logarithm of the longest chain."""
    here = context.select("source", "page", "chapter_id")
    before = context.select("source", (F.col("page") + 1).alias("page"), F.col("chapter_id").alias("chapter_before"))
    f = fragments.join(here, ["source", "page"], "left").join(before, ["source", "page"], "left")
    f = f.withColumn("same_chapter", F.coalesce((F.col("page") > 1) & (F.col("chapter_id") == F.col("chapter_before")), F.lit(False)))
    ends = procedure_rows.select("source", (F.col("page") + 1).alias("page"), (F.element_at("step_numbers", -1) + 1).alias("first_step")).distinct().withColumn("after_procedure", F.lit(True))
    f = f.join(ends, ["source", "page", "first_step"], "left").withColumn("after_procedure", F.coalesce("after_procedure", F.lit(False)))
    by_phase = F.col("n_phases") > 0
    f = stash(f.withColumn("own", by_phase | (F.col("same_chapter") & F.col("after_procedure"))), "fragments")
    state = ["source", "page", "step"]
    after = lambda rows: rows.select("source", (F.col("page") + 1).alias("page"), (F.col("last_step") + 1).alias("step")).distinct()
    waiting = f.where("NOT own AND same_chapter")
    hops = stash(waiting.select("source", "page", F.col("first_step").alias("step"), (F.col("page") + 1).alias("to_page"), (F.col("last_step") + 1).alias("to_step")).distinct(), "fragments-hops")
    reached = stash(after(f.where("own")), "fragments-reached")
    while not hops.isEmpty():
        further = reached.join(hops, state).select("source", F.col("to_page").alias("page"), F.col("to_step").alias("step"))
        more = stash(reached.union(further).distinct(), "fragments-reached")
        ends = hops.select("source", F.col("page").alias("to_page"), F.col("step").alias("to_step"), F.col("to_page").alias("end_page"), F.col("to_step").alias("end_step"))
        twice = stash(hops.join(ends, ["source", "to_page", "to_step"]).select(*state, F.col("end_page").alias("to_page"), F.col("end_step").alias("to_step")).distinct(), "fragments-hops")
        discard(reached, hops)
        reached, hops = more, twice
    chained = waiting.join(reached.withColumnRenamed("step", "first_step"), ["source", "page", "first_step"], "left_semi")
    f = f.join(chained.select(*REGION).withColumn("chained", F.lit(True)), REGION, "left").withColumn("chained", F.coalesce("chained", F.lit(False)))
    discard(hops)
    accepted = F.col("own") | F.col("chained")
    evidence = reasons(
        (by_phase, "manufacturer_phase_heading"),
        (F.col("same_chapter"), "same_manufacturer_chapter"),
        (~by_phase & F.col("after_procedure"), "continues_previous_page_procedure_numbering"),
        (~by_phase & ~F.col("after_procedure") & F.col("chained"), "continues_previous_page_fragment_numbering"),
    )
    reason = F.when(~F.col("same_chapter"), "numbering_only_without_same_resolved_chapter").otherwise("numbering_only_without_adjacent_procedure_progression")
    return f.select(*REGION, "step_numbers", "first_step", "last_step", "n_phases", "chapter_id", "same_chapter", accepted.alias("accepted"), F.when(accepted, evidence).alias("evidence"), F.when(~accepted, reason).alias("rejection"))


def link_candidates(judged: DataFrame) -> DataFrame:
    """One candidate link from the page before for every accepted fragment in the same chapter; none is ever made by itself."""
    kept = judged.where("accepted AND page > 1 AND same_chapter")
    evidence = F.array_distinct(F.concat(F.array(F.lit("adjacent_physical_page"), F.lit("same_manufacturer_chapter")), F.col("evidence")))
    return kept.select("source", (F.col("page") - 1).alias("from_page"), F.col("page").alias("to_page"), F.col("region").alias("to_region"), "chapter_id", "step_numbers", evidence.alias("evidence"), F.lit("REVIEW_REQUIRED").alias("status"))


def fragments_of(lines: DataFrame, context: DataFrame) -> DataFrame:
    """Judged fragments of lines; segments and regions are summed up once, and procedures kept by page and last step only."""
    found = pieces(lines)
    procedure = F.col("anchor").isNotNull() & (F.col("n_steps") >= LEAST_STEPS) & (F.col("n_phases") > 0)
    numbers = F.when(F.col("anchor").isNotNull(), F.slice("step_numbers", -1, 1)).otherwise(F.col("step_numbers"))
    found = found.where(procedure | (F.col("anchor").isNull() & (F.col("n_repairs") == 0) & (F.col("n_steps") >= 2)))
    found = stash(found.select(*REGION, "anchor", numbers.alias("step_numbers"), "n_phases", "n_repairs"), "fragments-pieces")
    out = judged_fragments(fragments_in(found), found.where("anchor IS NOT NULL"), context)
    discard(found)
    return out


def contiguous_pages(pages: DataFrame) -> DataFrame:
    """Per source: whether its pages are 1, 2, 3, ... without gap or repeat."""
    place = F.row_number().over(W.partitionBy("source").orderBy("page"))
    return pages.withColumn("place", place).groupBy("source").agg(F.count(F.lit(1)).alias("n_pages"), F.bool_and(F.col("place") == F.col("page")).alias("contiguous"))
