"""Repair procedures in ordered lines: anchors, titles, segments, phases, steps, sequence verdicts, page classes.

Lines have: source, page, region, line_index (from 0 in the region), text, mean_confidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as t
from .ocr import reasons

REGION = ["source", "page", "region"]
OUTSIDE = ["header", "footer", "spanning"]
# Fixed values of the procedure rules.
LOOKBACK, LOW_STEP, LEAST_STEPS, CONTENTS_LINES, LIST_LINES = 4, 70.0, 2, 8, 5


def marked(lines: DataFrame, outside: bool = False) -> DataFrame:
    """Lines of body regions with their text spaced and what it is by itself: repair number, title, phase heading, step number. outside: lines
    of other regions too, which are none of these."""
    text = F.col("text")
    body = lines.where(F.lit(True) if outside else ~F.col("region").isin(OUTSIDE)).withColumn("text", t.spaced(text))
    own = lambda x: F.when(~F.col("region").isin(OUTSIDE), x) if outside else x
    return body.withColumns({"repair": own(t.repair_number(text, True)), "titled": own(t.is_title(text, True)), "phase_source": own(t.phase_source(text, True)), "number": own(t.step_number(text, True))})


def anchored(lines: DataFrame, outside: bool = False) -> DataFrame:
    """Marked lines with the title line above an anchor (the nearest of four), and the procedure segment they lie in: from the line after an
    anchor to the next anchor's title, or to that anchor if it has none of its own. phase_no, step_no and phase_source count and keep phase
    headings and steps from the anchor on; before is the number of the step before a line.

    All is running values over a region's lines, which are sorted once: a title that ends a segment stands at most four lines above the next
    anchor, and what is counted within segments and phases is the count at a line less that at the line that opens them."""
    order = W.partitionBy(*REGION).orderBy("line_index")
    back, ahead = order.rowsBetween(-LOOKBACK, -1), order.rowsBetween(1, LOOKBACK)
    so_far, up_to = order.rowsBetween(W.unboundedPreceding, -1), order.rowsBetween(W.unboundedPreceding, 0)
    is_anchor, is_phase = F.col("repair").isNotNull(), F.col("phase_source").isNotNull()
    is_step = ~is_phase & F.col("number").isNotNull()
    body = marked(lines, outside).withColumns({"is_step": is_step})
    body = body.withColumns({
        "above": F.max(F.when(F.col("titled"), F.struct("line_index", "text"))).over(back),
        "phases": F.sum(is_phase.cast("int")).over(up_to), "steps": F.sum(F.col("is_step").cast("int")).over(up_to),
        "heading": F.last("phase_source", True).over(up_to), "before": F.last(F.when(F.col("is_step"), F.col("number")), True).over(so_far),
    })
    anchor = F.struct(F.col("line_index").alias("at"), "repair", "above", "phases")
    body = body.withColumns({
        "own": F.last(F.when(is_anchor, anchor), True).over(so_far), "ends": F.first(F.when(is_anchor, F.struct(F.col("above.line_index").alias("at"))), True).over(ahead),
        "opened": F.last(F.when(is_anchor | is_phase, F.col("steps")), True).over(up_to),
    })
    cut = F.coalesce((F.col("ends.at") > F.col("own.at")) & (F.col("line_index") >= F.col("ends.at")), F.lit(False))
    body = body.withColumn("anchor", F.when(F.col("own").isNotNull() & ~is_anchor & ~cut, F.col("own.at")))
    phase_no = F.col("phases") - F.col("own.phases")
    return body.withColumns({"phase_no": phase_no, "step_no": F.col("steps") - F.col("opened"), "heading": F.when(phase_no > 0, F.col("heading"))}).drop("titled", "phases", "steps", "ends", "opened")


def kinds(body: DataFrame) -> DataFrame:
    """Anchored lines by what they are within a segment, and whether a step breaks the numbering of its phase (null for the first one)."""
    open_step = F.col("step_no") > 0
    kind = F.when(F.col("phase_source").isNotNull(), "phase").when(F.col("is_step"), "step").when(open_step & t.is_bullet(F.col("text"), True), "bullet").when(open_step, "continuation").otherwise("other")
    return body.withColumns({"kind": F.when(F.col("anchor").isNotNull() & (F.col("text") != ""), kind), "breaks": F.when(F.col("is_step") & (F.col("step_no") > 1), F.col("number") != F.col("before") + 1)})


def segment_lines(lines: DataFrame) -> DataFrame:
    """Lines inside segments by what they are: phase, step, bullet (only below a step), continuation (below a step) or other. phase_no and step_no
    count within the segment; a phase heading closes the step before it. breaks: a step whose number is not one more than that before it in
    its phase (null for the first)."""
    inside = kinds(anchored(lines).where("anchor IS NOT NULL AND text <> ''"))
    return inside.select(*REGION, "anchor", "line_index", "kind", "phase_no", t.phase_label(F.col("heading")).alias("phase"), F.col("heading").alias("phase_source"), "step_no", "number", "breaks", "text", "mean_confidence")


def steps(lines: DataFrame) -> DataFrame:
    """Steps of segments: number, whole text (continuations joined), bullets, and the least confidence of its own and continuing lines."""
    inside = segment_lines(lines).where("kind IN ('step', 'bullet', 'continuation')")
    said = F.when(F.col("kind") == "step", t.step_body(F.col("text"), True)).when(F.col("kind") == "continuation", F.col("text"))
    item = F.when(F.col("kind") == "bullet", F.struct("line_index", t.bullet_body(F.col("text"), True).alias("said")))
    own = F.col("kind") != "bullet"
    joined = lambda parts, by: F.array_join(F.transform(F.array_sort(F.collect_list(parts)), lambda x: x["said"]), by)
    return inside.groupBy(*REGION, "anchor", "phase_no", "step_no").agg(
        F.max("phase").alias("phase"), F.max(F.when(F.col("kind") == "step", F.col("number"))).alias("number"), F.min("line_index").alias("line_index"),
        F.trim(joined(F.when(own, F.struct("line_index", said.alias("said"))), " ")).alias("text"),
        joined(item, "|").alias("subitems"), F.count(item).alias("n_subitems"), F.min(F.when(own, F.col("mean_confidence"))).alias("least_confidence"),
    )


def sequence_status(n: Column, breaks: Column) -> Column:
    """none, single_step, contiguous or gap_restart_or_ocr_error, from the number of steps and of places where a number is not one more than the
    one before."""
    return F.when(n == 0, "none").when(n == 1, "single_step").when(breaks == 0, "contiguous").otherwise("gap_restart_or_ocr_error")


def sequence_columns(order: W) -> dict[str, Column]:
    return {"break": (F.col("number") != F.lag("number").over(order) + 1).cast("int")}


def phases(lines: DataFrame) -> DataFrame:
    """Phases of segments, each heading one, with the verdict on their numbers."""
    inside = segment_lines(lines).where("phase_no > 0")
    is_step = F.col("kind") == "step"
    out = inside.groupBy(*REGION, "anchor", "phase_no", "phase", "phase_source").agg(
        F.min(F.when(F.col("kind") == "phase", F.col("line_index"))).alias("line_index"), F.count(F.when(is_step, 1)).alias("n_steps"), F.count(F.when(is_step & F.col("breaks"), 1)).alias("breaks"),
    )
    return out.withColumn("status", sequence_status(F.col("n_steps"), F.col("breaks"))).drop("breaks")


def pieces(lines: DataFrame) -> DataFrame:
    """What procedures and raw fragments are made of, by one aggregation: the sums of each segment, and of the lines of each region that lie in
    none (anchor is null)."""
    body = kinds(anchored(lines))
    inside, is_step = F.col("anchor").isNotNull(), F.col("number").isNotNull()
    low = F.col("kind").isin("step", "continuation") & (F.col("mean_confidence") < LOW_STEP)
    numbers = F.transform(F.array_sort(F.collect_list(F.when(is_step, F.struct("line_index", "number")))), lambda x: x["number"])
    return body.groupBy(*REGION, "anchor").agg(
        F.first(F.when(inside, F.struct("own.repair", F.col("own.above.text").alias("title")))).alias("own"), F.count(F.when(is_step, 1)).alias("n_steps"), F.count("phase_source").alias("n_phases"),
        F.count(F.when(is_step & (F.col("phase_no") == 0), 1)).alias("unphased"), F.count(F.when(low, 1)).alias("low"), numbers.alias("step_numbers"), F.count(F.when(F.col("kind") == "other", 1)).alias("n_uncategorised"),
        (F.count(F.when((F.col("phase_no") > 0) & F.col("breaks"), 1)) > 0).alias("bad_phase"), F.count("repair").alias("n_repairs"),
    )


def procedures_of(found: DataFrame) -> DataFrame:
    """Procedures among pieces."""
    out = found.where(F.col("anchor").isNotNull() & (F.col("n_steps") >= LEAST_STEPS) & (F.col("n_phases") > 0))
    title = F.col("own.title")
    status = F.when(F.col("bad_phase"), "phase_sequence_issue").when(F.col("unphased") > 0, "unphased_steps_present").otherwise("contiguous_by_phase")
    why = reasons((title.isNull(), "missing_title"), (F.col("unphased") > 0, "step_without_phase"), (F.col("bad_phase"), "phase_step_sequence_not_contiguous"), (F.col("low") > 0, "low_ocr_confidence_in_step"))
    return out.select(*REGION, "anchor", F.col("own.repair").alias("repair_number"), title.alias("title"), "n_steps", "n_phases", "step_numbers", "n_uncategorised", status.alias("sequence_status"), why.alias("review_reasons"))


def procedures(lines: DataFrame) -> DataFrame:
    """Segments with two steps and a phase at least: repair number, title, step numbers, verdict on the sequence by phase, and why a person has to
    look. All of them are candidates."""
    return procedures_of(pieces(lines))


def numbered_lines(lines: DataFrame) -> DataFrame:
    """Lines of body regions that begin with a step number."""
    body = lines.where(~F.col("region").isin(OUTSIDE)).withColumn("text", t.spaced(F.col("text")))
    body = body.withColumn("number", t.step_number(F.col("text"), True)).where("number IS NOT NULL")
    return body.select(*REGION, "line_index", "number", t.step_body(F.col("text"), True).alias("body"))


def page_class(lines: DataFrame) -> DataFrame:
    """The class of each page, by its procedures, a CONTENTS or INTRODUCTION line of its own, and its numbered lines. Segments and pages are
    summed up in one go."""
    page = ["source", "page"]
    alone = lambda x: F.bool_or(t.is_standalone(F.col("text"), x, True))
    sums = anchored(lines, outside=True).groupBy(*REGION, "anchor").agg(
        F.count(F.lit(1)).alias("n_lines"), F.count("number").alias("n_numbered"), F.count("phase_source").alias("n_phases"), alone("CONTENTS").alias("contents"), alone("INTRODUCTION").alias("introduction"),
    )
    found = F.col("anchor").isNotNull() & (F.col("n_numbered") >= LEAST_STEPS) & (F.col("n_phases") > 0)
    out = sums.groupBy(*page).agg(
        F.sum("n_lines").alias("n_lines"), F.sum("n_numbered").alias("n_numbered"), F.bool_or("contents").alias("contents"), F.bool_or("introduction").alias("introduction"),
        F.count(F.when(found, 1)).alias("n_procedures"),
    )
    kind = (
        F.when(F.col("n_procedures") > 0, "repair_procedure_page")
        .when(F.col("contents") & (F.col("n_lines") >= CONTENTS_LINES), "contents_page_candidate")
        .when(F.col("n_numbered") >= LIST_LINES, "numbered_component_or_reference_list_candidate")
        .when(F.col("introduction"), "front_matter_or_narrative_candidate")
        .otherwise("unclassified_candidate")
    )
    return out.select(*page, "n_lines", "n_numbered", "n_procedures", kind.alias("page_class"))
