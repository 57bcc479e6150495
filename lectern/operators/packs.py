"""Document packs as member lists with digests: inspection, catalogue, staging."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as t

# Fixed values of the pack format.
FORMAT, FORMAT_VERSION, CANDIDATE = "lectern-document-pack", 1, "CANDIDATE_NOT_VALIDATED"
REQUIRED = ["manifest.json", "source/document.pdf", "data/knowledge.sqlite"]
LARGEST_MEMBER = 2 << 30


def inspect(packs: DataFrame, members: DataFrame) -> DataFrame:
    """packs: pack_id, format, format_version, declared (map of member to sha256), source_sha256, declared_pages, declared_ocr_pages, found_pages,
    found_ocr_pages, publication_state; members: pack_id, member, sha256. The first check that fails is the error; none: valid."""
    declared = packs.select("pack_id", F.explode("declared").alias("member", "wanted"))
    both = declared.withColumn("is_declared", F.lit(True)).join(members.withColumn("is_there", F.lit(True)), ["pack_id", "member"], "full_outer")
    allowed = t.is_allowed_member(F.col("member"))
    sums = both.groupBy("pack_id").agg(
        F.count(F.when(F.col("is_there") & ~allowed, 1)).alias("unexpected"),
        F.count_distinct(F.when(F.col("is_there") & F.col("member").isin(REQUIRED), F.col("member"))).alias("required"),
        F.count(F.when((F.col("member") != "manifest.json") & (F.col("is_declared").isNull() | F.col("is_there").isNull()), 1)).alias("listed_otherwise"),
        F.count(F.when(F.col("is_declared") & F.col("is_there") & (F.col("wanted") != F.col("sha256")), 1)).alias("bad_hash"),
        F.max(F.when(F.col("member") == "source/document.pdf", F.col("sha256"))).alias("pdf_sha256"),
    )
    p = packs.join(sums, "pack_id", "left")
    error = (
        F.when((F.coalesce("unexpected", F.lit(0)) > 0) | (F.coalesce("required", F.lit(0)) < len(REQUIRED)), "unexpected_or_missing_members")
        .when(F.col("format") != FORMAT, "unknown_format")
        .when(F.col("format_version") != FORMAT_VERSION, "unknown_format_version")
        .when(F.col("listed_otherwise") > 0, "manifest_member_list_mismatch")
        .when(F.col("bad_hash") > 0, "member_hash_invalid")
        .when(F.col("pdf_sha256") != F.col("source_sha256"), "source_sha256_invalid")
        .when((F.col("declared_pages") != F.col("found_pages")) | (F.col("declared_ocr_pages") != F.col("found_ocr_pages")), "sqlite_validation_failed")
    )
    return p.select("pack_id", error.isNull().alias("valid"), error.alias("error"), "publication_state")


def catalogue_problems(entries: DataFrame) -> DataFrame:
    """Digests and pack ids that occur more than once, and entries that are no candidates; a catalogue is drafted only if there are none."""
    sources = entries.groupBy(F.col("source_sha256").alias("value")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.lit("DUPLICATE_SOURCE").alias("problem"), "value", "n")
    ids = entries.groupBy(F.col("pack_id").alias("value")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.lit("DUPLICATE_PACK_ID").alias("problem"), "value", "n")
    states = entries.where(F.col("publication_state") != CANDIDATE).groupBy(F.col("publication_state").alias("value")).agg(F.count(F.lit(1)).alias("n")).select(F.lit("NOT_A_CANDIDATE").alias("problem"), "value", "n")
    return sources.union(ids).union(states)


def catalogue(entries: DataFrame) -> DataFrame:
    """Entries with the fixed fields of a draft: nothing in it is approved."""
    return entries.withColumns({"validation_state": F.lit(CANDIDATE), "approved_for_ai": F.lit(False), "redistribution_approved": F.lit(False)})


def staged(current: DataFrame, incoming: DataFrame) -> DataFrame:
    """incoming packs (source_sha256, pack_sha256, largest_member) against those installed (source_sha256, pack_sha256): new, present, or refused."""
    old = current.select("source_sha256", F.col("pack_sha256").alias("installed"))
    out = incoming.join(old, "source_sha256", "left")
    action = (
        F.when(~t.is_sha256(F.col("source_sha256")), "INVALID_SHA256")
        .when(F.col("largest_member") > LARGEST_MEMBER, "MEMBER_TOO_LARGE")
        .when(F.col("installed").isNull(), "STAGED")
        .when(F.col("installed") == F.col("pack_sha256"), "ALREADY_PRESENT")
        .otherwise("CONFLICTING_PACK_REVISION")
    )
    return out.withColumn("action", action).drop("installed")
