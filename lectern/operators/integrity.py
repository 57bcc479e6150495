"""Constraint checks of a store, set comparisons, gates and verdicts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .ocr import reasons


def foreign_key_violations(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str, name: str) -> DataFrame:
    """One row: how many child rows point to no parent; null points nowhere and is no violation."""
    keys = parent.select(F.col(parent_key).alias("__k"))
    lost = child.where(F.col(child_key).isNotNull()).join(keys, F.col(child_key) == F.col("__k"), "left_anti")
    return lost.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("constraint"), "violations")


def key_violations(table: DataFrame, keys: list[str], name: str) -> DataFrame:
    """One row: how many key values occur more than once (null included, as one value)."""
    twice = table.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return twice.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("constraint"), "violations")


def null_violations(table: DataFrame, columns: list[str], name: str) -> DataFrame:
    """One row: how many rows have a null in a column that must not."""
    bad = reduce(lambda a, b: a | b, [F.col(x).isNull() for x in columns])
    return table.agg(F.count(F.when(bad, 1)).alias("violations")).select(F.lit(name).alias("constraint"), "violations")


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return union_all([df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows") for name, df in tables.items()])


def review_gate(items: DataFrame, keys: list[str]) -> DataFrame:
    """Review items (severity, status) by key: pending, pending critical ones, and whether publication is blocked: by any that is pending."""
    pending = F.col("status") == "pending"
    out = items.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_items"), F.count(F.when(pending, 1)).alias("pending"), F.count(F.when(pending & (F.col("severity") == "critical"), 1)).alias("critical_pending"))
    return out.withColumn("publication_blocked", F.col("pending") > 0)


def store_validation(violations: DataFrame, items: DataFrame) -> DataFrame:
    """One row for a whole store: sum of violations, pending items and the gate."""
    v = violations.agg(F.sum("violations").alias("violations"))
    pending = F.col("status") == "pending"
    i = items.agg(F.count(F.when(pending, 1)).alias("pending"), F.count(F.when(pending & (F.col("severity") == "critical"), 1)).alias("critical_pending"))
    out = v.withColumn("one", F.lit(1)).join(i.withColumn("one", F.lit(1)), "one").drop("one")
    return out.withColumn("integrity", F.when(F.col("violations") == 0, "ok").otherwise("violated")).withColumn("publication_blocked", (F.col("pending") > 0) | (F.col("violations") > 0))


def page_set_by_revision(pages: DataFrame) -> DataFrame:
    """pages: revision, page, extraction_status -> per revision and status (null and empty: UNSPECIFIED) the number of pages."""
    status = F.when(F.coalesce("extraction_status", F.lit("")) == "", "UNSPECIFIED").otherwise(F.col("extraction_status"))
    return pages.groupBy("revision", status.alias("extraction_status")).agg(F.count(F.lit(1)).alias("n_pages"), F.countDistinct("page").alias("n_distinct_pages"))


def symmetric_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that only one side has, as often as it has more of them, with the side."""
    return a.exceptAll(b).withColumn("side", F.lit("only_first")).unionByName(b.exceptAll(a).withColumn("side", F.lit("only_second")))


def publication_state(findings: DataFrame) -> DataFrame:
    """findings: code, kind (blocker or unproven) -> one row: BLOCKED if any blocker, else REVIEW_REQUIRED if anything is unproven, else
    TECHNICALLY_VERIFIED; with the distinct codes, sorted. Codes are a closed set."""
    pick = lambda kind: F.array_sort(F.collect_set(F.when(F.col("kind") == kind, F.col("code"))))
    out = findings.agg(pick("blocker").alias("blockers"), pick("unproven").alias("not_yet_proven"))
    state = F.when(F.size("blockers") > 0, "BLOCKED").when(F.size("not_yet_proven") > 0, "REVIEW_REQUIRED").otherwise("TECHNICALLY_VERIFIED")
    return out.withColumn("state", state)


def counted_blocker(frame: DataFrame, code: str) -> DataFrame:
    """CODE:n if the frame has n > 0 rows, else no row."""
    return frame.agg(F.count(F.lit(1)).alias("n")).where("n > 0").select(F.concat(F.lit(f"{code}:"), "n").alias("code"), F.lit("blocker").alias("kind"))


def findings_of(spark: SparkSession, rows: list[tuple[str, str]]) -> DataFrame:
    return spark.createDataFrame(rows, "code string, kind string")


# pages of natively decoded documents

BLANK_INK = 0.0005


def page_kind(pages: DataFrame) -> DataFrame:
    """pages: text_chars, images, vectors, links, annotations, ink -> page_kind; the first rule that fits decides."""
    c = lambda x: F.col(x) > 0
    kind = (
        F.when(c("text_chars") & (c("images") | c("vectors")), "native_text_with_visuals")
        .when(c("text_chars"), "native_text")
        .when(c("images") & c("vectors"), "raster_and_vector_without_native_text")
        .when(c("images"), "raster_without_native_text")
        .when(c("vectors"), "vector_without_native_text")
        .when(c("links") | c("annotations"), "interactive_without_native_text")
        .when(F.col("ink") <= BLANK_INK, "blank_verified_by_render")
        .otherwise("visible_content_not_explained_by_native_objects")
    )
    return pages.withColumn("page_kind", kind)


def review_items(pages: DataFrame) -> DataFrame:
    """pages: sha256, page, page_kind, multicolumn -> up to three review items a page, each with an id that follows from what it is about."""
    from ..functions.text import review_id

    kind = F.col("page_kind")
    codes = reasons(
        (F.col("multicolumn"), "READING_ORDER_REVIEW"),
        (kind.isin("raster_without_native_text", "raster_and_vector_without_native_text"), "OCR_REQUIRED"),
        (kind.isin("vector_without_native_text", "raster_and_vector_without_native_text"), "VECTOR_PASS_REQUIRED"),
        (kind == "visible_content_not_explained_by_native_objects", "VISIBLE_CONTENT_UNRESOLVED"),
    )
    out = pages.withColumn("code", F.explode(codes))
    return out.select(review_id(F.col("sha256"), F.col("page").cast("string"), F.col("code")).alias("review_id"), "sha256", "page", "code", F.lit("blocking").alias("severity"), F.lit("unresolved").alias("status"))


def document_counters(pages: DataFrame, keys: list[str]) -> DataFrame:
    """Totals of a document's pages."""
    n = lambda c: F.count(F.when(c, 1))
    return pages.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_pages"), F.sum("text_chars").alias("text_chars"), F.sum("images").alias("images"), F.sum("vectors").alias("vectors"), F.sum("links").alias("links"),
        n(F.col("text_chars") > 0).alias("text_pages"), n((F.col("images") > 0) & (F.col("text_chars") == 0)).alias("ocr_pages"), n(F.col("page_kind") == "blank_verified_by_render").alias("blank_pages"), n(F.col("multicolumn")).alias("multicolumn_pages"),
    )


def ink_fraction(samples: Column, white: int = 250) -> Column:
    """Share of gray samples that are not white; 0 without samples."""
    return F.coalesce(F.try_divide(F.size(F.filter(samples, lambda x: x < white)), F.size(samples)), F.lit(0.0))
