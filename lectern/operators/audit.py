"""Whole-document audits: layers, evidence, references, revisions, supplementary sources, and the summary that gates publication."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as t
from .identity import IMAGE_SUFFIXES, page_coverage, resolved_references
from .ocr import reasons

# The verdict of a sequence that is no issue, what samples show at most, and the reason that only a person takes away.
GOOD_SEQUENCE = "contiguous_by_phase"
SAMPLE_ROWS, SAMPLE_CHARS = 150, 500
ALWAYS = "semantic_and_human_validation_not_completed"


def _beside(frame: DataFrame, row: DataFrame) -> DataFrame:
    """frame with the columns of the one row of an aggregate."""
    return frame.withColumn("__one", F.lit(1)).join(F.broadcast(row.withColumn("__one", F.lit(1))), "__one").drop("__one")


def entries(table: DataFrame, key: str, value: str) -> DataFrame:
    """Key and value as text, in the order of the keys."""
    return table.select(F.col(key).cast("string").alias("key"), F.col(value).cast("string").alias("value")).orderBy("key")


def upserted(current: DataFrame, changes: DataFrame, key: str = "key") -> DataFrame:
    """current with the rows of changes in place of, or beside, its own; changes has seq, and of several changes of a key the last counts."""
    columns = current.columns
    last = changes.groupBy(key).agg(F.max(F.struct("seq", *columns)).alias("c")).select(*[F.col(f"c.{x}").alias(x) for x in columns])
    return current.join(last.select(key), key, "left_anti").select(*columns).unionByName(last)


def empty_store(spark, schemas: dict[str, str]) -> dict[str, DataFrame]:
    """Tables of the given schemas without rows."""
    return {name: spark.createDataFrame([], schema) for name, schema in schemas.items()}


def sample(table: DataFrame, order: list[str], rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> DataFrame:
    """The first rows by the given order, texts cut: a preview, limited on purpose."""
    shown = [F.substring(f.name, 1, chars).alias(f.name) if f.dataType.simpleString() == "string" else F.col(f.name) for f in table.schema.fields]
    return table.orderBy(*order).limit(rows).select(*shown)


def keys_of(table: DataFrame, key: str) -> DataFrame:
    """Distinct keys, none null, in order."""
    return table.where(F.col(key).isNotNull()).select(F.col(key).alias("key")).distinct().orderBy("key")


def page_lists(pages: DataFrame) -> DataFrame:
    """pages: revision, page -> a revision's pages in order, repeated ones too, and their number."""
    return pages.groupBy("revision").agg(F.sort_array(F.collect_list("page")).alias("pages"), F.count(F.lit(1)).alias("n_pages"))


def with_reference(knowledge: DataFrame, reference: str = "reference") -> DataFrame:
    """Rows whose reference is not null and not blank."""
    return knowledge.where(F.col(reference).isNotNull() & (F.trim(reference) != ""))


def repair_numbers(procedures: DataFrame) -> DataFrame:
    """Distinct repair numbers, none empty, in order."""
    return procedures.where("repair_number <> ''").select("repair_number").distinct().orderBy("repair_number")


def layer_counts(layers: dict[str, DataFrame]) -> DataFrame:
    """Layer, its number of pages, and whether all layers have as many. A layer is a frame with a column page."""
    counts = reduce(DataFrame.unionByName, [df.agg(F.count_distinct("page").alias("n_pages")).select(F.lit(name).alias("layer"), "n_pages") for name, df in layers.items()])
    same = counts.agg((F.count_distinct("n_pages") == 1).alias("layers_match"))
    return _beside(counts, same)


def sequence_issues(procedures: DataFrame) -> DataFrame:
    """Procedures whose numbering by phase is not in order."""
    return procedures.where(F.col("sequence_status") != GOOD_SEQUENCE).select("source", "page", "region", "repair_number", "title", "step_numbers", "sequence_status", "review_reasons")


def summary(layers: DataFrame, review: DataFrame, procedures: DataFrame, fragments: DataFrame) -> DataFrame:
    """One row for a document: totals, why it may not be published, and the gate, which no program opens.

    layers: of layer_counts; review: pages with reasons; procedures: with sequence_status; fragments: with accepted. Sequences are judged by
    phase; every reason is made anew from the rows, so that a corrected layer takes its reason away."""
    has = lambda name: F.count(F.when(F.array_contains("reasons", name), 1))
    parts = [
        layers.agg(F.bool_and("layers_match").alias("layers_match"), F.max("n_pages").alias("n_pages")),
        review.agg(has("ocr_parse_warning").alias("warning_pages"), has("no_ocr_words").alias("no_word_pages"), has("suspiciously_long_ocr_token").alias("long_token_pages"), F.count(F.when(F.size("reasons") > 0, 1)).alias("review_pages")),
        procedures.agg(F.count(F.lit(1)).alias("n_procedures"), F.count(F.when(F.col("sequence_status") != GOOD_SEQUENCE, 1)).alias("n_sequence_issues")),
        fragments.agg(F.count(F.when(F.col("accepted"), 1)).alias("n_fragments")),
    ]
    out = reduce(_beside, parts)
    why = reasons(
        (~F.col("layers_match"), "page_count_mismatch_between_layers"),
        (F.col("warning_pages") > 0, "ocr_parse_warnings"),
        (F.col("long_token_pages") > 0, "suspicious_long_ocr_tokens"),
        (F.col("no_word_pages") > 0, "pages_without_ocr_words_require_visual_review"),
        (F.col("n_sequence_issues") > 0, "procedure_step_sequence_issues_require_review"),
        (F.col("n_fragments") > 0, "continuation_fragments_require_review"),
        (F.lit(True), ALWAYS),
    )
    return out.withColumns({"blocking_reasons": why, "publication_gate": F.lit("BLOCKED_REVIEW")})


def page_pairs(layout: DataFrame, structure: DataFrame, keys: list[str]) -> DataFrame:
    """Pages of both layers: paired, or missing in one of them. Work that needs both goes on only if every page is paired."""
    both = layout.select(*keys).distinct().withColumn("l", F.lit(1)).join(structure.select(*keys).distinct().withColumn("s", F.lit(1)), keys, "full_outer")
    return both.select(*keys, F.when(F.col("s").isNull(), "MISSING_STRUCTURE").when(F.col("l").isNull(), "MISSING_LAYOUT").otherwise("PAIRED").alias("state"))


def knowledge_links(knowledge: DataFrame, corrections: DataFrame, visual_assets: DataFrame, diagrams: DataFrame, files: DataFrame) -> DataFrame:
    """knowledge: key, reference; corrections: key, legacy_ref, effective (array). Per row with a reference: its parts, how many resolve, the status
    of them all, what is missing, and whether the parts are those of a correction, which counts if it names the reference that it replaces.

    Each distinct reference is resolved once."""
    k = with_reference(knowledge).join(corrections, "key", "left")
    corrected = F.coalesce(F.col("reference") == F.col("legacy_ref"), F.lit(False))
    k = k.select("key", corrected.alias("corrected"), F.posexplode(F.when(corrected, F.col("effective")).otherwise(t.expanded_references(F.col("reference")))).alias("at", "part"))
    found = resolved_references(k.select(F.col("part").alias("key"), F.col("part").alias("reference")).distinct(), visual_assets, diagrams, files).select(F.col("key").alias("part"), "status")
    k = k.join(found, "part", "left")
    missing = F.transform(F.array_sort(F.collect_list(F.when(F.col("status") != "OK", F.struct("at", "part")))), lambda x: x["part"])
    out = k.groupBy("key").agg(F.bool_or("corrected").alias("corrected"), F.count(F.lit(1)).alias("n_parts"), F.count(F.when(F.col("status") == "OK", 1)).alias("n_ok"), missing.alias("missing_parts"))
    return out.withColumn("link_status", F.when(F.col("n_ok") == F.col("n_parts"), "OK").when(F.col("n_ok") > 0, "PARTIAL").otherwise("NOT_RESOLVED"))


def status_histogram(rows: DataFrame, status: str) -> DataFrame:
    return rows.groupBy(F.col(status).alias("status")).agg(F.count(F.lit(1)).alias("n"))


def unique_revisions(matched: DataFrame, revisions: DataFrame) -> DataFrame:
    """matched: document_key, sha256, n_pages; revisions: revision, document_key, source_sha256 -> matched with its revision: the one with key and
    digest, null if there is none or more than one."""
    named = revisions.select("document_key", F.lower("source_sha256").alias("sha"), "revision")
    one = named.groupBy("document_key", "sha").agg(F.count(F.lit(1)).alias("n"), F.min("revision").alias("revision")).where("n = 1").drop("n")
    return matched.withColumn("sha", F.lower("sha256")).join(one, ["document_key", "sha"], "left").drop("sha")


def revision_coverage(matched: DataFrame, revisions: DataFrame, pages: DataFrame) -> DataFrame:
    """The page coverage of each matched source by its one revision; unverified without one."""
    own = unique_revisions(matched, revisions)
    cover = page_coverage(own.where("revision IS NOT NULL").select("revision", "n_pages").distinct(), pages.join(own.select("revision").distinct(), "revision", "left_semi"))
    out = own.join(cover.select("revision", "n_pages", "n_missing", "n_unexpected", "n_found", "coverage"), ["revision", "n_pages"], "left")
    return out.withColumn("coverage", F.coalesce("coverage", F.lit("UNVERIFIED")))


def supplementary_sources(extra: DataFrame, registry: DataFrame, knowledge: DataFrame, assets: DataFrame) -> DataFrame:
    """extra: path, sha256, pages; registry (a short list): document, expected_sha256, physical_pages, prefix, expected_knowledge, expected_visuals;
    knowledge: key; assets: document, status. What an additional file is: registered by digest and pages or not, and if the facts with its
    prefix and its available images are as many as registered.

    Prefixes are met by equality, one for each length that the registry has."""
    lengths = [r[0] for r in registry.select(F.length("prefix")).distinct().collect()]
    heads = F.array(*[F.substring("key", 1, n) for n in lengths]) if lengths else F.array().cast("array<string>")
    facts = knowledge.select("key", F.explode(F.array_distinct(heads)).alias("prefix")).join(registry.select("prefix").distinct(), "prefix").groupBy("prefix").agg(F.count(F.lit(1)).alias("n_knowledge"))
    images = assets.where("status = 'OK'").groupBy("document").agg(F.count(F.lit(1)).alias("n_visuals"))
    r = registry.join(facts, "prefix", "left").join(images, "document", "left").fillna(0, ["n_knowledge", "n_visuals"])
    out = extra.join(r, (F.col("sha256") == F.col("expected_sha256")) & (F.col("pages") == F.col("physical_pages")), "left")
    same = (F.col("n_knowledge") == F.col("expected_knowledge")) & (F.col("n_visuals") == F.col("expected_visuals"))
    state = F.when(F.col("document").isNull(), "UNREGISTERED_ADDITIONAL_PDF").when(same, "EXACT_PDF_PARTIALLY_PUBLISHED_AS_STRUCTURED_FACTS_AND_VISUALS").otherwise("SUPPLEMENTARY_PDF_INTEGRATION_DISCREPANCY")
    return out.select("path", "document", "n_knowledge", "n_visuals", state.alias("state"))


def reference_audit(visual_assets: DataFrame, diagrams: DataFrame, files: DataFrame) -> DataFrame:
    """Every image that the manifest lists against the files: unsafe path, missing, available (no digest declared), verified or another digest; and
    images that it does not list. visual_assets and diagrams: path, sha256 (null if not declared); of a path listed twice the first counts."""
    listed = visual_assets.select("path", "sha256", F.lit(0).alias("rank")).unionByName(diagrams.select("path", "sha256", F.lit(1).alias("rank")))
    listed = listed.groupBy("path").agg(F.min(F.struct("rank", "sha256")).alias("first")).select("path", F.col("first.sha256").alias("wanted"), F.lit(True).alias("listed"))
    both = listed.join(files.select("path", F.lower("sha256").alias("actual"), F.lit(True).alias("found")), "path", "full_outer")
    image = F.lower(F.regexp_extract("path", r"(\.[^./]*)$", 1)).isin(IMAGE_SUFFIXES)
    status = (
        F.when(F.col("listed").isNull(), "UNLISTED_IMAGE")
        .when(~t.is_safe_path(F.col("path")) | ~image, "UNSAFE_PATH")
        .when(F.col("found").isNull(), "MISSING")
        .when(F.col("wanted").isNull(), "AVAILABLE")
        .when(F.lower("wanted") == F.col("actual"), "SHA256_VERIFIED")
        .otherwise("HASH_MISMATCH")
    )
    return both.where(F.col("listed").isNotNull() | image).select("path", status.alias("status"))


def ocr_evidence(expected: DataFrame, evidence: DataFrame, payloads: DataFrame) -> DataFrame:
    """expected: source_sha256, n_pages; evidence: source_sha256, page, says_sha256, says_page, raw_sha256; payloads: source_sha256, page, sha256 (of
    the unpacked word table). Each page's first failing check, or OK: a pack is made only if all are.

    The rows of both sides are digests, which files' sizes and column types tell nothing of, so the joins are never broadcast by an estimate."""
    evidence, payloads = (x.hint("merge") for x in (evidence.withColumn("there", F.lit(True)), payloads.select("source_sha256", "page", F.col("sha256").alias("payload"))))
    pages = expected.where("n_pages > 0").select("source_sha256", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n_pages").cast("long"))).alias("page"))
    out = pages.join(evidence, ["source_sha256", "page"], "left").join(payloads, ["source_sha256", "page"], "left")
    status = (
        F.when(F.col("there").isNull(), "MISSING_OCR_PAGE")
        .when(~F.col("says_sha256").eqNullSafe(F.col("source_sha256")) | ~F.col("says_page").eqNullSafe(F.col("page")), "OCR_PROVENANCE_MISMATCH")
        .when(F.col("payload").isNull(), "OCR_TSV_ABSENT")
        .when(~F.col("payload").eqNullSafe(F.col("raw_sha256")), "OCR_TSV_HASH_MISMATCH")
        .otherwise("OK")
    )
    return out.select("source_sha256", "page", status.alias("status"))
