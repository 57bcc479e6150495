"""Correction lots: reading them out of SQL text that is never run, checking them, and applying them to a copy with a history."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the lot format; the two tables' names and the prefix of links are the lot's own and come as parameters.
CORRECTION_START, LINK_START = "INSERT OR REPLACE INTO {}(", "INSERT OR IGNORE INTO {}("
CORRECTION_TABLE, LINK_TABLE, LINK_PREFIX = "source_reference_correction", "illustration_link", "REF:"
QUOTED = "'((?:[^']|'')*)'"
CORRECTION_FIELDS = ["correction_key", "fact_key", "legacy_ref", "effective_ref", "reason", "verification_level", "notes"]
LINK_FIELDS = ["fact_key", "illustration_key", "role", "notes"]
ROLES, VERIFIED, EXPECTED = ["source", "effective_source"], "verifie_constructeur", 3
OLD_SECTION, NEW_SECTION, KNOWLEDGE_PREFIX = "39.1", "39.2", "KNOW-"


def _values(lines: DataFrame, start: str, fields: list[str]) -> DataFrame:
    own = lines.where(F.trim("line").startswith(start)).withColumn("found", F.transform(F.regexp_extract_all("line", F.lit(QUOTED), F.lit(1)), lambda x: F.replace(x, F.lit("''"), F.lit("'"))))
    return own.select("lot", "seq", F.size("found").alias("n_values"), *[F.try_element_at("found", F.lit(k + 1)).alias(f) for k, f in enumerate(fields)])


def parsed(lots: DataFrame, correction_table: str = CORRECTION_TABLE, link_table: str = LINK_TABLE, prefix: str = LINK_PREFIX) -> tuple[DataFrame, DataFrame]:
    """lots: lot, sql -> corrections (with n_values, of which 7 are right) and usable links, in the order of the text."""
    lines = lots.select("lot", F.posexplode(F.split("sql", r"\r\n|\r|\n")).alias("seq", "line"))
    corrections = _values(lines, CORRECTION_START.format(correction_table), CORRECTION_FIELDS)
    links = _values(lines, LINK_START.format(link_table), LINK_FIELDS).where(f"n_values = {len(LINK_FIELDS)}")
    links = links.where(F.col("role").isin(ROLES) & F.col("illustration_key").startswith(prefix))
    return corrections, links.select("lot", "seq", "fact_key", F.substr("illustration_key", F.lit(len(prefix) + 1)).alias("image_ref"), "role")


def lot_status(lots: DataFrame, correction_table: str = CORRECTION_TABLE, link_table: str = LINK_TABLE, prefix: str = LINK_PREFIX) -> DataFrame:
    """Per lot: OK if every correction is whole, verified by the maker and among its fact's links, and there are three facts exactly."""
    corrections, links = parsed(lots, correction_table, link_table, prefix)
    linked = links.select("lot", "fact_key", F.col("image_ref").alias("effective_ref")).distinct().withColumn("linked", F.lit(True))
    last = corrections.groupBy("lot", "fact_key").agg(F.max_by(F.struct("effective_ref", "verification_level"), "seq").alias("c"))
    last = last.select("lot", "fact_key", "c.effective_ref", "c.verification_level").join(linked, ["lot", "fact_key", "effective_ref"], "left")
    good = F.coalesce(F.col("linked"), F.lit(False)) & (F.col("verification_level") == VERIFIED)
    sums = last.groupBy("lot").agg(F.count(F.lit(1)).alias("n_facts"), F.count(F.when(~good, 1)).alias("bad_links"))
    whole = corrections.groupBy("lot").agg(F.count(F.when(F.col("n_values") != len(CORRECTION_FIELDS), 1)).alias("malformed"))
    out = lots.select("lot").join(sums, "lot", "left").join(whole, "lot", "left").fillna(0)
    status = F.when(F.col("malformed") > 0, "INVALID_CORRECTION_SQL").when(F.col("bad_links") > 0, "INVALID_CORRECTION_LINKS").when(F.col("n_facts") != EXPECTED, "CORRECTION_COUNT_MISMATCH").otherwise("OK")
    return out.withColumn("status", status)


def applied(knowledge: DataFrame, corrections: DataFrame, links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """knowledge: knowledge_key, image_ref, source_section -> the corrected rows and the history of what was changed. A row is changed only if its
    reference is the one the correction replaces and its section names the old number; the source is not touched."""
    images = links.groupBy("fact_key").agg(F.array_sort(F.collect_list(F.struct("seq", "image_ref"))).alias("l"))
    images = images.select("fact_key", F.array_join(F.array_distinct(F.transform("l", lambda x: x["image_ref"])), ",").alias("new_ref"))
    c = corrections.join(images, "fact_key").select(F.concat(F.lit(KNOWLEDGE_PREFIX), "fact_key").alias("knowledge_key"), "correction_key", "legacy_ref", "new_ref")
    k = knowledge.join(c, "knowledge_key", "left")
    section = F.replace("source_section", F.lit(OLD_SECTION), F.lit(NEW_SECTION))
    hit = F.coalesce((F.col("image_ref") == F.col("legacy_ref")) & (section != F.col("source_section")), F.lit(False))
    k = k.withColumn("hit", hit)
    fixed = k.select("knowledge_key", F.when(F.col("hit"), F.col("new_ref")).otherwise(F.col("image_ref")).alias("image_ref"), F.when(F.col("hit"), section).otherwise(F.col("source_section")).alias("source_section"))
    history = k.where("hit").select("correction_key", "knowledge_key", F.col("image_ref").alias("old_image_ref"), F.col("new_ref").alias("new_image_ref"), F.col("source_section").alias("old_section"), section.alias("new_section"))
    return fixed, history


def applied_whole(knowledge: DataFrame, corrections: DataFrame, links: DataFrame, images: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """As applied(), for lots (corrections and links with a column lot; images: image_ref, that resolve), each of them whole or not at all: a lot
    with other than three corrections, with one that does not hit its row, or with an image that does not resolve changes nothing.

    Returns the rows, the history, and per lot its status. A row that two lots would change takes both out."""
    keyed = corrections.select("lot", F.concat(F.lit(KNOWLEDGE_PREFIX), "fact_key").alias("knowledge_key"), "fact_key", "legacy_ref")
    k = keyed.join(knowledge, "knowledge_key", "left")
    section = F.replace("source_section", F.lit(OLD_SECTION), F.lit(NEW_SECTION))
    hit = F.coalesce((F.col("image_ref") == F.col("legacy_ref")) & (section != F.col("source_section")), F.lit(False))
    claims = keyed.groupBy("knowledge_key").agg(F.count_distinct("lot").alias("lots"))
    k = k.join(claims, "knowledge_key").groupBy("lot").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(~hit, 1)).alias("missed"), F.max("lots").alias("lots"))
    lost = links.join(images.select("image_ref").distinct(), "image_ref", "left_anti").groupBy("lot").agg(F.count(F.lit(1)).alias("lost"))
    bare = keyed.join(links.select("lot", "fact_key").distinct(), ["lot", "fact_key"], "left_anti").groupBy("lot").agg(F.count(F.lit(1)).alias("bare"))
    k = k.join(lost, "lot", "left").join(bare, "lot", "left").fillna(0, ["lost", "bare"])
    status = (
        F.when(F.col("n") != EXPECTED, "CORRECTION_COUNT_MISMATCH")
        .when(F.col("missed") > 0, "LEGACY_VALUE_MISMATCH")
        .when((F.col("lost") > 0) | (F.col("bare") > 0), "IMAGE_NOT_RESOLVED")
        .when(F.col("lots") > 1, "CONFLICTING_LOTS")
        .otherwise("APPLIED")
    )
    states = k.select("lot", status.alias("status"))
    good = states.where("status = 'APPLIED'").select("lot")
    rows, history = applied(knowledge, corrections.join(good, "lot", "left_semi"), links.join(good, "lot", "left_semi"))
    return rows, history, states


def inspected(lots: DataFrame, terms: list[str], most_lines: int = 60, most_chars: int = 750) -> DataFrame:
    """The first lines of each lot that hold one of the terms (case apart), cut to a length: a preview, limited on purpose."""
    lines = lots.select("lot", F.posexplode(F.split("sql", r"\r\n|\r|\n")).alias("seq", "line"))
    hit = F.lit(False)
    for term in terms:
        hit = hit | F.contains(F.lower("line"), F.lit(term.lower()))
    from pyspark.sql import Window as W

    found = lines.where(hit).withColumn("place", F.row_number().over(W.partitionBy("lot").orderBy("seq")))
    return found.where(F.col("place") <= most_lines).select("lot", "seq", F.substring("line", 1, most_chars).alias("line"))
