"""Identity by content: digests, first-wins copies, matching of sources to packs, page sets, references."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as t

# Fixed values of the identity rules.
KEY_PREFIX, LEAST_PREFIX = "DOC_PDFSHA256", 16
IMAGE_SUFFIXES = [".png", ".jpg", ".jpeg", ".webp", ".gif", ".bmp"]
PROOFS = {1: "DOCUMENT_METADATA_ORIGINAL_FILENAME", 2: "SHA256_PREFIX_OF_ORIGINAL_PDF", 3: "EXACT_DOCUMENT_NAME", 4: "DOCUMENT_METADATA_SHA256_PREFIX", 5: "DOCUMENT_METADATA_EXACT_SHA256"}


def file_identity(files: DataFrame) -> DataFrame:
    """files: path, content (binary) -> digests, size and the ids that follow from them."""
    sha = F.sha2("content", 256)
    out = files.select("path", F.length("content").cast("long").alias("size_bytes"), sha.alias("sha256"), t.git_blob_sha1(F.col("content")).alias("git_blob_sha1"))
    return out.withColumns({"revision_id": F.concat(F.lit("REV_"), "sha256"), "document_id": F.concat(F.lit("DOC_"), F.substring("sha256", 1, 24))})


def first_wins(files: DataFrame, order: str = "path", key: str = "sha256") -> DataFrame:
    """The first file of each content is the original, the others are duplicates of it. Only the least position of a digest is grouped, so a
    content with very many copies is no large group."""
    firsts = files.groupBy(key).agg(F.min(order).alias("original"))
    out = files.join(firsts, key)
    return out.withColumn("role", F.when(F.col(order) == F.col("original"), "original").otherwise("duplicate"))


def page_coverage(expected: DataFrame, pages: DataFrame, key: str = "revision") -> DataFrame:
    """expected: revision, n_pages (null if unknown); pages: revision, page. Missing and unexpected pages, and the verdict: complete only if the
    pages are 1 to n, each once; unverified without pages or without n. Pages are compared as rows, so no page list is put together."""
    got = pages.groupBy(key, "page").agg(F.count(F.lit(1)).alias("times"))
    wanted = expected.where("n_pages > 0").select(key, F.explode(F.sequence(F.lit(1), F.col("n_pages").cast("int"))).alias("page"))
    both = wanted.withColumn("wanted", F.lit(1)).join(got, [key, "page"], "full_outer")
    sums = both.groupBy(key).agg(
        F.count(F.when(F.col("times").isNull(), 1)).alias("n_missing"), F.count(F.when(F.col("wanted").isNull(), 1)).alias("n_unexpected"),
        F.coalesce(F.sum("times"), F.lit(0)).alias("n_found"),
    )
    out = expected.join(sums, key, "left")
    out = out.fillna(0, ["n_missing", "n_unexpected", "n_found"])
    complete = (F.col("n_missing") == 0) & (F.col("n_unexpected") == 0) & (F.col("n_found") == F.col("n_pages"))
    verdict = F.when((F.col("n_found") == 0) | F.col("n_pages").isNull(), "UNVERIFIED").when(complete, "COMPLETE_PAGE_SET").otherwise("INCOMPLETE_PAGE_SET")
    return out.withColumn("coverage", verdict)


def source_pack_identity(sources: DataFrame, keys: DataFrame, metadata: DataFrame | None = None) -> DataFrame:
    """sources: path, sha256, seq; keys: document_key, seq; metadata: document_key, kind (hash or filename), value, seq. Which pack key each source is
    proven to be: by a digest in the key or the metadata (16 digits at least) or by name; the proof found last counts, a file name in the
    metadata only if there is no other. One key exactly, else UNMATCHED or AMBIGUOUS; a key that an earlier source took is refused.

    Prefixes are joined on their first 16 digits, names on their normal form: no source meets all keys."""
    s = sources.select("path", F.upper("sha256").alias("sha"), F.col("seq").alias("source_seq"), t.normal_key(t.file_stem(F.col("path"))).alias("stem")).withColumn("block", F.substring("sha", 1, LEAST_PREFIX))
    k = keys.select("document_key", F.upper("document_key").alias("upper"), F.col("seq").alias("key_seq"))
    prefix = F.substring("upper", len(KEY_PREFIX) + 1, 64)
    hashed = k.where(F.col("upper").startswith(KEY_PREFIX)).withColumn("prefix", prefix).where(F.col("prefix").rlike(f"^[0-9A-F]{{{LEAST_PREFIX},}}$")).withColumn("block", F.substring("prefix", 1, LEAST_PREFIX))
    by_key = s.join(hashed, "block").where(F.col("sha").startswith(F.col("prefix"))).select("path", "document_key", F.lit(2).alias("proof"), F.col("key_seq").alias("at"), F.lit(0).alias("part"))
    by_name = s.join(k.withColumn("stem", t.normal_key(F.col("document_key"))), "stem").select("path", "document_key", F.lit(3).alias("proof"), F.col("key_seq").alias("at"), F.lit(1).alias("part"))
    found = by_key.union(by_name)
    if metadata is not None:
        m = metadata.join(k.select("document_key"), "document_key", "left_semi")
        far = F.lit(1_000_000_000) + F.col("seq")
        literal = m.where("kind = 'hash'").withColumn("prefix", F.upper(F.trim(F.coalesce("value", F.lit(""))))).where(F.length("prefix") >= LEAST_PREFIX).withColumn("block", F.substring("prefix", 1, LEAST_PREFIX))
        exact = F.when(F.col("prefix") == F.col("sha"), 5).otherwise(4)
        by_hash = s.join(literal.select("document_key", "prefix", "block", "seq"), "block").where(F.col("sha").startswith(F.col("prefix"))).select("path", "document_key", exact.alias("proof"), far.alias("at"), F.lit(2).alias("part"))
        named = m.where("kind = 'filename'").withColumn("stem", t.normal_key(F.col("value")))
        by_file = s.join(named.select("document_key", "stem"), "stem").select("path", "document_key", F.lit(1).alias("proof"), F.lit(-1).cast("long").alias("at"), F.lit(0).alias("part"))
        found = found.union(by_hash).union(by_file)
    best = found.groupBy("path", "document_key").agg(F.max(F.struct("at", "part", "proof")).alias("best"))
    name = F.element_at(F.create_map(*[F.lit(x) for pair in PROOFS.items() for x in pair]), F.col("best.proof"))
    one = best.groupBy("path").agg(F.count(F.lit(1)).alias("n_keys"), F.min("document_key").alias("document_key"), F.min(name).alias("proof"))
    out = s.select("path", "source_seq").join(one, "path", "left")
    single = F.col("n_keys") == 1
    out = out.withColumns({"document_key": F.when(single, F.col("document_key")), "proof": F.when(single, F.col("proof")).when(F.col("n_keys").isNull(), "UNMATCHED").otherwise("AMBIGUOUS")})
    first = out.where("document_key IS NOT NULL").groupBy("document_key").agg(F.min("source_seq").alias("first_seq"))
    out = out.join(first, "document_key", "left")
    taken = F.col("document_key").isNotNull() & (F.col("source_seq") > F.col("first_seq"))
    state = F.when(F.col("document_key").isNull(), "source_id_not_proven").when(taken, "ambiguous_source_id").otherwise("matched")
    return out.select("path", "document_key", "proof", state.alias("state"))


def resolved_references(references: DataFrame, visual_assets: DataFrame, diagrams: DataFrame, files: DataFrame, prefix: str = "ref:") -> DataFrame:
    """references: key, reference. Each single reference is looked up as an asset, as an asset with the prefix, then as a diagram (path
    literals stay themselves); its file must be listed, safe, an image, there, and of the declared digest.

    visual_assets and diagrams: key, path, sha256 (null if not declared); files: path, sha256."""
    value = F.trim("reference")
    own = F.regexp_replace(F.replace(value, F.lit("\\"), F.lit("/")), "(?i)^database/reference/", "")
    literal = F.lower("own").startswith("images/")
    r = references.withColumns({"value": value, "own": own})
    look = lambda df, name: df.select(F.col("key").alias(f"{name}_key"), F.struct("path", "sha256").alias(name))
    r = r.join(look(visual_assets, "direct"), F.col("value") == F.col("direct_key"), "left")
    r = r.join(look(visual_assets, "prefixed"), F.concat(F.lit(prefix), "value") == F.col("prefixed_key"), "left")
    r = r.join(look(diagrams, "diagram"), F.col("value") == F.col("diagram_key"), "left")
    item = F.coalesce("direct", "prefixed", "diagram")
    r = r.withColumns({"item": item}).withColumns({"path": F.when(literal, F.col("own")).otherwise(F.col("item.path")), "expected": F.when(~literal, F.col("item.sha256"))})
    r = r.join(files.select(F.col("path").alias("file"), F.lower("sha256").alias("actual")), F.col("path") == F.col("file"), "left")
    suffix = F.lower(F.regexp_extract("path", r"(\.[^./]*)$", 1))
    status = (
        F.when(F.col("value") == "", "EMPTY_REFERENCE")
        .when(F.col("path").isNull(), "NOT_LISTED")
        .when(~t.is_safe_path(F.col("path")) | ~suffix.isin(IMAGE_SUFFIXES), "UNSAFE_PATH")
        .when(F.col("file").isNull(), "FILE_MISSING")
        .when(F.col("expected").isNotNull() & (F.lower("expected") != F.col("actual")), "HASH_MISMATCH")
        .otherwise("OK")
    )
    return r.select(*references.columns, F.col("path").alias("relative_path"), status.alias("status"))


def link_status(resolved: DataFrame, key: str = "key") -> DataFrame:
    """Per knowledge row: OK if all parts of its reference resolve, PARTIAL if some do, else NOT_RESOLVED."""
    out = resolved.groupBy(key).agg(F.count(F.lit(1)).alias("n_parts"), F.count(F.when(F.col("status") == "OK", 1)).alias("n_ok"))
    return out.withColumn("link_status", F.when(F.col("n_ok") == F.col("n_parts"), "OK").when(F.col("n_ok") > 0, "PARTIAL").otherwise("NOT_RESOLVED"))


def original_audit(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """Files on disk against a manifest (path, size_bytes, git_blob_sha1): OK, MISSING, INVALID, or EXTRA for files it does not list."""
    found = files.select("path", F.col("size_bytes").alias("size"), F.col("git_blob_sha1").alias("blob"))
    out = manifest.withColumn("listed", F.lit(True)).join(found, "path", "full_outer")
    same = (F.col("size") == F.col("size_bytes")) & (F.col("blob") == F.col("git_blob_sha1"))
    state = F.when(F.col("listed").isNull(), "EXTRA").when(F.col("blob").isNull(), "MISSING").when(same, "OK").otherwise("INVALID")
    return out.select("path", state.alias("state"))


def numbered_by(df: DataFrame, *order: str, name: str = "seq") -> DataFrame:
    """A dense number from 0 in the given order within the whole (small) frame."""
    return df.withColumn(name, F.row_number().over(W.orderBy(*order)) - 1)
