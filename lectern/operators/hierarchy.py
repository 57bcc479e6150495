"""Contents pages, chapter anchors and their titles, chapters and the context of each page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as t

# Fixed values of the hierarchy rules.
FORWARD_PAGES, NOISY = 4, 0.45


def contents_entries(lines: DataFrame) -> DataFrame:
    """Of pages with a CONTENTS line the lines after the first such one, without headers, footers and blank lines: group headings, and entries
    with their group, title, printed page and share of noise. Lines need a `seq` in page order."""
    page = W.partitionBy("source", "page")
    order = page.orderBy("seq")
    text = t.spaced(F.col("text"))
    start = F.min(F.when(t.is_standalone(F.col("text"), "CONTENTS"), F.col("seq"))).over(page)
    after = lines.withColumns({"start": start, "raw_text": text}).where((F.col("seq") > F.col("start")) & ~F.col("region").isin("header", "footer") & (text != ""))
    heading = t.stripped(F.col("raw_text"), t.HEADING_EDGES)
    is_group = F.upper(heading).isin(t.CONTENT_GROUPS)
    after = after.withColumn("group", F.last(F.when(is_group, heading), True).over(order.rowsBetween(W.unboundedPreceding, 0)))
    printed = t.trailing_page(F.col("raw_text"))
    title = F.when(printed.isNotNull(), F.regexp_replace(F.regexp_replace(F.col("raw_text"), t.TRAILING_PAGE, ""), r"[ .:\-]+$", "")).otherwise(F.col("raw_text"))
    entry = ~is_group
    after = after.withColumns({"title_candidate": F.when(entry, title), "printed_page": F.when(entry, printed), "role": F.when(entry, "contents_entry_candidate").otherwise("group_heading_candidate")})
    after = after.withColumn("noise_ratio", F.when(F.col("title_candidate").isNotNull(), t.noise_ratio(F.col("title_candidate"))))
    status = F.when(F.col("noise_ratio") > NOISY, "REVIEW_REQUIRED").otherwise("CANDIDATE_ONLY")
    return after.select("source", "page", "seq", "role", status.alias("status"), "group", "raw_text", "title_candidate", "printed_page", "noise_ratio")


def anchor_titles(anchors: DataFrame, lines: DataFrame) -> DataFrame:
    """Title of each contents page: the first heading in its header, else in that of the next four pages, else none."""
    heads = lines.where("region = 'header'").where(t.is_heading(F.col("text"))).select("source", F.col("page").alias("p"), "seq", t.clean_heading(F.col("text")).alias("title"))
    wide = anchors.select("source", "page", F.explode(F.sequence(F.col("page"), F.col("page") + FORWARD_PAGES)).alias("p"))  # an equi-join on the page instead of a range
    best = wide.join(heads, ["source", "p"], "left").groupBy("source", "page").agg(F.min(F.when(F.col("title").isNotNull(), F.struct("p", "seq", "title"))).alias("best"))
    here = F.col("best.p") == F.col("page")
    method = F.when(F.col("best").isNull(), "unresolved").when(here, "contents_page_header").otherwise("nearby_following_page_header")
    return best.select("source", "page", F.col("best.title").alias("title"), method.alias("method"), F.when(here, "CANDIDATE_ONLY").otherwise("REVIEW_REQUIRED").alias("status"))


def slug(text: Column) -> Column:
    """Latin letters without their accents, lower case, other runs as one dash; unresolved if nothing is left.

    Accents come off by a table of the Latin letters that decompose; letters that do not become dashes' neighbours only if they are ASCII."""
    plain = F.translate(F.coalesce(text, F.lit("")), _ACCENTED, _PLAIN)
    cut = F.btrim(F.regexp_replace(F.lower(F.regexp_replace(plain, r"[^\x00-\x7F]", "")), "[^a-z0-9]+", "-"), F.lit("-"))
    return F.when(cut == "", "unresolved").otherwise(cut)


def _decomposed() -> tuple[str, str]:
    import unicodedata

    pairs = []
    for code in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00)):
        ascii_only = unicodedata.normalize("NFKD", chr(code)).encode("ascii", "ignore").decode()
        if len(ascii_only) == 1:
            pairs.append((chr(code), ascii_only))
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


_ACCENTED, _PLAIN = _decomposed()


def chapters(anchors: DataFrame, pages: DataFrame) -> DataFrame:
    """anchors: source, page, title, status. Neighbouring anchors with one title (spaces and case apart) are a chapter, anchors without a title
    never merge; a chapter ends before the next one begins, the last at the last page."""
    order = W.partitionBy("source").orderBy("page")
    known = F.lower(t.spaced(F.col("title")))
    a = anchors.withColumn("known", F.when(F.col("title").isNotNull() & (F.col("title") != ""), known))
    new = F.col("known").isNull() | F.lag("known").over(order).isNull() | (F.col("known") != F.lag("known").over(order))
    a = a.withColumn("chapter_no", F.sum(new.cast("int")).over(order.rowsBetween(W.unboundedPreceding, 0)))
    out = a.groupBy("source", "chapter_no").agg(
        F.min("page").alias("start_page"), F.min_by("title", "page").alias("title"), F.count(F.lit(1)).alias("n_anchors"),
        F.bool_or(F.col("status") == "REVIEW_REQUIRED").alias("review"),
    )
    last = pages.groupBy("source").agg(F.max("page").alias("last_page"))
    out = out.join(last, "source", "left")
    end = F.coalesce(F.lead("start_page").over(W.partitionBy("source").orderBy("start_page")) - 1, F.col("last_page"))
    name = F.concat(F.lit("chapter-"), F.lpad(F.col("start_page").cast("string"), 4, "0"), F.lit("-"), slug(F.col("title")))
    return out.select("source", name.alias("chapter_id"), "title", "start_page", end.alias("end_page"), "n_anchors", F.when(F.col("review"), "REVIEW_REQUIRED").otherwise("CANDIDATE_ONLY").alias("status"))


def page_context(pages: DataFrame, chapter_rows: DataFrame) -> DataFrame:
    """Each page's chapter: the last that began at or before it. A running value, not a range join."""
    marks = chapter_rows.select("source", F.col("start_page").alias("page"), "chapter_id", F.col("title").alias("chapter_title"))
    joined = pages.select("source", "page").distinct().join(marks, ["source", "page"], "left")
    so_far = W.partitionBy("source").orderBy("page").rowsBetween(W.unboundedPreceding, 0)
    own = F.last(F.when(F.col("chapter_id").isNotNull(), F.struct("chapter_id", "chapter_title")), True).over(so_far)
    reason = F.when(F.col("own").isNull(), "before_first_resolved_chapter_anchor").otherwise("physical_range_from_manufacturer_contents_anchor")
    return joined.withColumn("own", own).select("source", "page", F.col("own.chapter_id").alias("chapter_id"), F.col("own.chapter_title").alias("chapter_title"), reason.alias("reason"))
