"""Queries over identity, integrity, search, packs, corrections and sources, each with its SQL where SQL can say it."""

from __future__ import annotations

import base64
import io
import struct
import zipfile
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as t
from ..operators import corrections, fragments, hierarchy, identity, integrity, packs, search
from ..sources import files as sources
from ..sources import tsv
from ..sources.tables import table

_csv = lambda c: F.array_join(c, ",")


def _native_pages(spark: SparkSession, d: str) -> DataFrame:
    """Orders as natively decoded pages: counters from key digits."""
    k = F.col("o_orderkey")
    mod = lambda n, least=0: F.greatest(F.lit(0), k % n - least).cast("bigint")
    return table(spark, d, "orders").select(
        F.sha2(F.col("o_custkey").cast("string"), 256).alias("sha256"), k.alias("page"), F.when(k % 3 == 0, k % 1000).otherwise(0).cast("bigint").alias("text_chars"), mod(4, 2).alias("images"), mod(5, 3).alias("vectors"),
        mod(7, 5).alias("links"), mod(11, 9).alias("annotations"), (F.when(k % 13 < 6, 0).otherwise(k % 13) / 1000).alias("ink"), (k % 17 == 0).alias("multicolumn"),
    )


_NATIVE_SQL = """n AS (SELECT sha256(CAST(o_custkey AS VARCHAR)) AS sha256, o_orderkey AS page, CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey % 1000 ELSE 0 END AS text_chars, greatest(0, o_orderkey % 4 - 2) AS images,
  greatest(0, o_orderkey % 5 - 3) AS vectors, greatest(0, o_orderkey % 7 - 5) AS links, greatest(0, o_orderkey % 11 - 9) AS annotations, CASE WHEN o_orderkey % 13 < 6 THEN 0 ELSE o_orderkey % 13 END / 1000 AS ink, o_orderkey % 17 = 0 AS multicolumn FROM orders),
k AS (SELECT *, CASE WHEN text_chars > 0 THEN CASE WHEN images > 0 OR vectors > 0 THEN 'native_text_with_visuals' ELSE 'native_text' END WHEN images > 0 AND vectors > 0 THEN 'raster_and_vector_without_native_text'
  WHEN images > 0 THEN 'raster_without_native_text' WHEN vectors > 0 THEN 'vector_without_native_text' WHEN links > 0 OR annotations > 0 THEN 'interactive_without_native_text' WHEN ink <= 0.0005 THEN 'blank_verified_by_render'
  ELSE 'visible_content_not_explained_by_native_objects' END AS page_kind FROM n)"""


def page_kind(spark: SparkSession, d: str) -> DataFrame:
    return integrity.page_kind(_native_pages(spark, d)).select("page", "page_kind")


def review_items_from_pages(spark: SparkSession, d: str) -> DataFrame:
    return integrity.review_items(integrity.page_kind(_native_pages(spark, d)))


def document_counters(spark: SparkSession, d: str) -> DataFrame:
    return integrity.document_counters(integrity.page_kind(_native_pages(spark, d)), ["sha256"])


def ink_shares(spark: SparkSession, d: str) -> DataFrame:
    """Sample values from the prices of an order's lines."""
    samples = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_list((F.col("l_extendedprice") % 256).cast("int")).alias("samples"))
    return samples.select("l_orderkey", integrity.ink_fraction(F.col("samples"), 200).alias("ink"))


def _page_sets(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    lines = table(spark, d, "lineitem")
    turns = table(spark, d, "conversations")
    pages = lines.select(F.concat(F.lit("order-"), "l_orderkey").alias("revision"), F.col("l_linenumber").cast("bigint").alias("page")).union(turns.select(F.concat(F.lit("talk-"), "conv_id"), F.col("turn") + 1))
    expected = pages.groupBy("revision").agg(F.max("page").alias("n_pages"))
    expected = expected.withColumn("n_pages", F.when(F.col("revision").rlike("^order-.*77$"), None).when(F.col("revision").rlike("^order-.*5$"), F.col("n_pages") + 1).otherwise(F.col("n_pages")))
    missing = spark.createDataFrame([("absent-1", 3), ("absent-2", 0)], "revision string, n_pages bigint")
    return expected.unionByName(missing), pages


def page_set_coverage(spark: SparkSession, d: str) -> DataFrame:
    expected, pages = _page_sets(spark, d)
    return identity.page_coverage(expected, pages)


def coverage_totals(spark: SparkSession, d: str) -> DataFrame:
    expected, pages = _page_sets(spark, d)
    done = F.col("coverage") == "COMPLETE_PAGE_SET"
    return identity.page_coverage(expected, pages).agg(F.coalesce(F.sum("n_pages"), F.lit(0)).alias("expected_pages"), F.sum(F.when(done, F.col("n_pages")).otherwise(0)).alias("verified_pages"), F.count(F.when(done, 1)).alias("complete_sets"))


def contiguous_pages(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("source"), F.col("l_linenumber").alias("page"))
    return fragments.contiguous_pages(pages)


def page_status_by_revision(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("revision"), F.col("l_linenumber").alias("page"), F.when(F.col("l_returnflag") == "R", None).when(F.col("l_returnflag") == "A", "").otherwise(F.col("l_linestatus")).alias("extraction_status"))
    return integrity.page_set_by_revision(pages)


_PAGE_SETS_SQL = """pages0 AS (SELECT 'order-' || l_orderkey AS revision, CAST(l_linenumber AS BIGINT) AS page FROM lineitem UNION ALL SELECT 'talk-' || conv_id, turn + 1 FROM conversations),
expected AS (SELECT revision, CASE WHEN regexp_matches(revision, '^order-.*77$') THEN NULL WHEN regexp_matches(revision, '^order-.*5$') THEN max(page) + 1 ELSE max(page) END AS n_pages FROM pages0 GROUP BY revision
  UNION ALL VALUES ('absent-1', 3), ('absent-2', 0)),
lists AS (SELECT revision, list(page) AS l FROM pages0 GROUP BY revision),
sets AS (SELECT revision, n_pages, coalesce(l, []) AS l, list_distinct(coalesce(l, [])) AS u, CASE WHEN n_pages > 0 THEN range(1, n_pages + 1) ELSE [] END AS w FROM expected LEFT JOIN lists USING (revision)),
cover AS (SELECT revision, n_pages, CAST(len(w) - len(list_intersect(w, u)) AS BIGINT) AS n_missing, CAST(len(u) - len(list_intersect(w, u)) AS BIGINT) AS n_unexpected, CAST(len(l) AS BIGINT) AS n_found FROM sets),
verdicts AS (SELECT *, CASE WHEN n_found = 0 OR n_pages IS NULL THEN 'UNVERIFIED' WHEN n_missing = 0 AND n_unexpected = 0 AND n_found = n_pages THEN 'COMPLETE_PAGE_SET' ELSE 'INCOMPLETE_PAGE_SET' END AS coverage FROM cover)"""


def _files(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return docs.select(F.concat(F.lit("depot/"), F.lpad(F.col("doc_id").cast("string"), 9, "0"), F.lit(".pdf")).alias("path"), F.encode("text", "utf-8").alias("content"))


def file_identity(spark: SparkSession, d: str) -> DataFrame:
    return identity.file_identity(_files(spark, d))


def source_dedup(spark: SparkSession, d: str) -> DataFrame:
    return identity.first_wins(identity.file_identity(_files(spark, d)).select("path", "sha256"))


def original_audit(spark: SparkSession, d: str) -> DataFrame:
    """The files against a manifest that lacks every 7th, lists every 11th with another size, and names two that are not there."""
    files = identity.file_identity(_files(spark, d))
    n = F.regexp_extract("path", r"([0-9]+)\.pdf$", 1).cast("int")
    manifest = files.where(n % 7 != 0).select("path", F.when(n % 11 == 0, F.col("size_bytes") + 1).otherwise(F.col("size_bytes")).alias("size_bytes"), "git_blob_sha1")
    manifest = manifest.union(spark.createDataFrame([("depot/gone-1.pdf", 1, "x"), ("depot/gone-2.pdf", 2, "y")], "path string, size_bytes bigint, git_blob_sha1 string"))
    return identity.original_audit(manifest, files)


def source_pack_identity(spark: SparkSession, d: str) -> DataFrame:
    """Documents as sources, keys by digest, by name and through metadata."""
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("n"), F.sha2("text", 256).alias("sha256"))
    src = docs.select(F.concat(F.lit("in/Doc "), F.col("n"), F.lit(".pdf")).alias("path"), "sha256", F.col("n").alias("seq"), "n")
    by_hash = F.concat(F.lit("DOC_PDFSHA256"), F.upper(F.substring("sha256", 1, 20)))
    keys = src.select(F.when(F.col("n") % 4 == 0, by_hash).when(F.col("n") % 4 == 1, F.concat(F.lit("DOC"), "n")).when(F.col("n") % 4 == 2, F.concat(F.lit("meta-"), "n")).otherwise("other").alias("document_key"), "seq")
    keys = keys.groupBy("document_key").agg(F.min("seq").alias("seq"))
    meta = src.where("n % 4 = 2").select(F.concat(F.lit("meta-"), "n").alias("document_key"), F.when(F.col("n") % 8 == 2, "hash").otherwise("filename").alias("kind"), F.when(F.col("n") % 8 == 2, F.col("sha256")).otherwise(F.concat(F.lit("doc "), "n")).alias("value"), "seq")
    return identity.source_pack_identity(src.drop("n"), keys, meta)


_SOURCE_PACK_SQL = """s AS (SELECT doc_id AS n, 'in/Doc ' || doc_id || '.pdf' AS path, upper(sha256(text)) AS sha, 'doc' || doc_id AS stem FROM documents),
keys0 AS (SELECT CASE n % 4 WHEN 0 THEN 'DOC_PDFSHA256' || sha[1:20] WHEN 1 THEN 'DOC' || n WHEN 2 THEN 'meta-' || n ELSE 'other' END AS document_key, n AS seq FROM s),
keys AS (SELECT document_key, min(seq) AS seq FROM keys0 GROUP BY 1),
proofs AS (
  SELECT path, document_key, seq AS pos, 0 AS part, 'SHA256_PREFIX_OF_ORIGINAL_PDF' AS proof FROM s JOIN keys ON starts_with(document_key, 'DOC_PDFSHA256') AND starts_with(sha, document_key[14:])
  UNION ALL SELECT path, document_key, seq, 1, 'EXACT_DOCUMENT_NAME' FROM s JOIN keys ON regexp_replace(lower(document_key), '[^a-z0-9]', '', 'g') = stem
  UNION ALL SELECT s.path, 'meta-' || m.n, 1000000000 + m.n, 2, 'DOCUMENT_METADATA_EXACT_SHA256' FROM s JOIN s m ON m.n % 8 = 2 AND m.sha = s.sha
  UNION ALL SELECT s.path, 'meta-' || m.n, -1, 0, 'DOCUMENT_METADATA_ORIGINAL_FILENAME' FROM s JOIN s m ON m.n % 8 = 6 AND s.n = m.n),
best AS (SELECT path, document_key, max_by(proof, pos * 10 + part) AS proof FROM proofs GROUP BY 1, 2),
one AS (SELECT path, count(*) AS k, min(document_key) AS document_key, min(proof) AS proof FROM best GROUP BY 1),
joined AS (SELECT s.path, n, CASE WHEN k = 1 THEN document_key END AS document_key, CASE WHEN k = 1 THEN proof WHEN k IS NULL THEN 'UNMATCHED' ELSE 'AMBIGUOUS' END AS proof FROM s LEFT JOIN one USING (path))"""


def _references(spark: SparkSession, d: str) -> DataFrame:
    """Customers' keys as references: single ones, short, long, reversed and cross-major ranges, paths, and what does not parse."""
    k = F.col("c_custkey")
    a, b = k % 7 + 1, k % 20 + 1
    text = (
        F.when(k % 9 == 0, F.concat(F.lit("DOC1:"), a, F.lit("."), b)).when(k % 9 == 1, F.concat(F.lit(" DOC1:"), a, F.lit("."), b, F.lit(" , "), a + 1, F.lit(".2;"), a, F.lit("."), b))
        .when(k % 9 == 2, F.concat(F.lit("DOC2:"), a, F.lit("."), b, F.lit("-"), a, F.lit("."), b + 4)).when(k % 9 == 3, F.concat(F.lit("DOC2:"), a, F.lit("."), b, F.lit("-"), a, F.lit("."), b + 13))
        .when(k % 9 == 4, F.concat(F.lit("DOC3:"), a, F.lit("."), b + 5, F.lit("-"), a, F.lit("."), b)).when(k % 9 == 5, F.concat(F.lit("DOC3:"), a, F.lit("."), b, F.lit("-"), a + 1, F.lit("."), b))
        .when(k % 9 == 6, F.concat(F.lit("images/p"), b, F.when(k % 2 == 0, ".png").otherwise(".exe"))).when(k % 9 == 7, F.lit("  ")).otherwise(F.concat(F.lit("see "), a))
    )
    return table(spark, d, "customer").select(k.alias("key"), text.alias("reference"))


_REFERENCES_SQL = r"""refs AS (SELECT c_custkey AS key, CASE c_custkey % 9 WHEN 0 THEN 'DOC1:' || a || '.' || b WHEN 1 THEN ' DOC1:' || a || '.' || b || ' , ' || (a + 1) || '.2;' || a || '.' || b
  WHEN 2 THEN 'DOC2:' || a || '.' || b || '-' || a || '.' || (b + 4) WHEN 3 THEN 'DOC2:' || a || '.' || b || '-' || a || '.' || (b + 13) WHEN 4 THEN 'DOC3:' || a || '.' || (b + 5) || '-' || a || '.' || b
  WHEN 5 THEN 'DOC3:' || a || '.' || b || '-' || (a + 1) || '.' || b WHEN 6 THEN 'images/p' || b || CASE WHEN c_custkey % 2 = 0 THEN '.png' ELSE '.exe' END WHEN 7 THEN '  ' ELSE 'see ' || a END AS reference
  FROM (SELECT c_custkey, c_custkey % 7 + 1 AS a, c_custkey % 20 + 1 AS b FROM customer)),
parts AS (SELECT key, trim(reference) AS r, unnest(regexp_split_to_array(regexp_replace(trim(reference), '^[A-Za-z0-9_]+:', ''), '\s*[,;]\s*')) AS p, generate_subscripts(regexp_split_to_array(regexp_replace(trim(reference), '^[A-Za-z0-9_]+:', ''), '\s*[,;]\s*'), 1) AS i FROM refs
  WHERE regexp_matches(trim(reference), '^[A-Za-z0-9_]+:\d+\.\d+(\s*[,;-]\s*\d+\.\d+)*$')),
ends AS (SELECT *, regexp_extract(r, '^([A-Za-z0-9_]+):', 1) AS doc, TRY_CAST(regexp_extract(p, '^(\d+)\.(\d+)-(\d+)\.(\d+)$', 1) AS BIGINT) AS m1, TRY_CAST(regexp_extract(p, '^(\d+)\.(\d+)-(\d+)\.(\d+)$', 2) AS BIGINT) AS x,
  TRY_CAST(regexp_extract(p, '^(\d+)\.(\d+)-(\d+)\.(\d+)$', 3) AS BIGINT) AS m2, TRY_CAST(regexp_extract(p, '^(\d+)\.(\d+)-(\d+)\.(\d+)$', 4) AS BIGINT) AS y FROM parts),
spread AS (SELECT key, i, x + j AS n, doc || ':' || m1 || '.' || (x + j) AS one FROM (SELECT *, unnest(range(0, y - x + 1)) AS j FROM ends WHERE m1 = m2 AND y - x BETWEEN 0 AND 12)
  UNION ALL SELECT key, i, 0, doc || ':' || p FROM ends WHERE m1 IS NULL OR m1 <> m2 OR y - x NOT BETWEEN 0 AND 12
  UNION ALL SELECT key, 0, 0, trim(reference) FROM refs WHERE trim(reference) <> '' AND NOT regexp_matches(trim(reference), '^[A-Za-z0-9_]+:\d+\.\d+(\s*[,;-]\s*\d+\.\d+)*$')),
firsts AS (SELECT key, one, min(i * 1000000 + n) AS pos FROM spread GROUP BY 1, 2)"""


def expand_references(spark: SparkSession, d: str) -> DataFrame:
    return _references(spark, d).select("key", F.size(t.expanded_references(F.col("reference"))).alias("n_parts"), F.array_join(t.expanded_references(F.col("reference")), "|").alias("parts"))


def reference_store(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Assets, diagrams and files of a made-up reference store."""
    keys = spark.range(1, 9).select(F.col("id").alias("a")).join(spark.range(1, 40).select(F.col("id").alias("b"), F.lit(1).alias("one")), F.lit(1) == F.col("one"))
    item = lambda doc: F.concat(F.lit(doc), F.lit(":"), "a", F.lit("."), "b")
    path = lambda doc: F.concat(F.lit("images/"), F.lit(doc), F.lit("_"), "a", F.lit("_"), "b", F.when(F.col("b") % 10 == 9, ".txt").otherwise(".png"))
    sha = lambda doc: F.when(F.col("b") % 3 != 0, F.sha2(path(doc), 256))
    assets = keys.where("b % 4 <> 3").select(item("DOC1").alias("key"), path("DOC1").alias("path"), sha("DOC1").alias("sha256")).union(keys.select(F.concat(F.lit("ref:"), item("DOC2")), path("DOC2"), sha("DOC2")))
    diagrams = keys.select(item("DOC3").alias("key"), path("DOC3").alias("path"), F.lit(None).cast("string").alias("sha256"))
    every = keys.select(path("DOC1").alias("path"), "b").union(keys.select(path("DOC2"), "b")).union(keys.select(path("DOC3"), "b")).union(keys.where("a = 1").select(F.concat(F.lit("images/p"), "b", F.lit(".png")), "b"))
    files = every.where("b % 7 <> 6").select("path", F.when(F.col("b") % 5 == 4, "00").otherwise(F.sha2("path", 256)).alias("sha256"))
    return assets, diagrams, files


def _resolved(spark: SparkSession, d: str) -> DataFrame:
    parts = _references(spark, d).select("key", F.explode(t.expanded_references(F.col("reference"))).alias("reference"))
    return identity.resolved_references(parts, *reference_store(spark, d))


def resolve_references(spark: SparkSession, d: str) -> DataFrame:
    return _resolved(spark, d)


def reference_link_status(spark: SparkSession, d: str) -> DataFrame:
    return identity.link_status(_resolved(spark, d))


_RESOLVED_SQL = f"""{_REFERENCES_SQL},
grid AS (SELECT a, b FROM range(1, 9) x(a), range(1, 40) y(b)),
named AS (SELECT doc || ':' || a || '.' || b AS key, 'images/' || doc || '_' || a || '_' || b || CASE WHEN b % 10 = 9 THEN '.txt' ELSE '.png' END AS path, doc, b FROM grid, (VALUES ('DOC1'), ('DOC2'), ('DOC3')) v(doc)),
items AS (SELECT key, path, CASE WHEN doc <> 'DOC3' AND b % 3 <> 0 THEN sha256(path) END AS sha FROM named WHERE doc <> 'DOC1' OR b % 4 <> 3),
there AS (SELECT path, CASE WHEN b % 5 = 4 THEN '00' ELSE sha256(path) END AS actual FROM (SELECT path, b FROM named UNION ALL SELECT 'images/p' || b || '.png', b FROM range(1, 40) y(b)) WHERE b % 7 <> 6),
looked AS (SELECT f.key, f.one AS reference, CASE WHEN starts_with(lower(f.one), 'images/') THEN f.one ELSE i.path END AS relative_path, i.sha FROM firsts f LEFT JOIN items i ON i.key = f.one),
resolved AS (SELECT l.key, reference, relative_path, CASE WHEN relative_path IS NULL THEN 'NOT_LISTED' WHEN NOT regexp_matches(lower(relative_path), '\\.(png|jpg|jpeg|webp|gif|bmp)$') THEN 'UNSAFE_PATH' WHEN t.path IS NULL THEN 'FILE_MISSING'
  WHEN sha IS NOT NULL AND sha <> actual THEN 'HASH_MISMATCH' ELSE 'OK' END AS status FROM looked l LEFT JOIN there t ON t.path = relative_path)"""

_FOREIGN = [
    ("lineitem", "l_orderkey", "orders", "o_orderkey"), ("lineitem", "l_partkey", "part", "p_partkey"), ("lineitem", "l_suppkey", "supplier", "s_suppkey"), ("orders", "o_custkey", "customer", "c_custkey"),
    ("customer", "c_nationkey", "nation", "n_nationkey"), ("supplier", "s_nationkey", "nation", "n_nationkey"), ("nation", "n_regionkey", "region", "r_regionkey"), ("labels", "doc_id", "documents", "doc_id"),
]
_KEYS = {"orders": ["o_orderkey"], "customer": ["c_custkey"], "part": ["p_partkey"], "supplier": ["s_suppkey"], "nation": ["n_nationkey"], "region": ["r_regionkey"], "documents": ["doc_id"], "lineitem": ["l_orderkey", "l_linenumber"], "conversations": ["conv_id", "turn"], "pages": ["page_id"]}


def fk_violations(spark: SparkSession, d: str) -> DataFrame:
    return integrity.union_all([integrity.foreign_key_violations(table(spark, d, c), table(spark, d, p), ck, pk, f"{c}.{ck}") for c, ck, p, pk in _FOREIGN])


def pk_duplicates(spark: SparkSession, d: str) -> DataFrame:
    return integrity.union_all([integrity.key_violations(table(spark, d, n), keys, n) for n, keys in _KEYS.items()])


def null_violations(spark: SparkSession, d: str) -> DataFrame:
    return integrity.union_all([integrity.null_violations(table(spark, d, n), keys, n) for n, keys in _KEYS.items()])


def table_counts(spark: SparkSession, d: str) -> DataFrame:
    return integrity.table_counts({n: table(spark, d, n) for n in _KEYS})


def _review_queue(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    severity = F.when(F.col("event_type").isin("purchase", "error"), "critical").otherwise("blocking")
    return e.select("event_id", "user_id", "event_type", severity.alias("severity"), F.when(F.col("value") > 50, "pending").otherwise("resolved").alias("status"))


def review_gate(spark: SparkSession, d: str) -> DataFrame:
    return integrity.review_gate(_review_queue(spark, d), ["user_id"])


def store_validation(spark: SparkSession, d: str) -> DataFrame:
    return integrity.store_validation(fk_violations(spark, d).unionByName(pk_duplicates(spark, d)), _review_queue(spark, d))


_FK_SQL = " UNION ALL ".join(f"SELECT '{c}.{ck}' AS \"constraint\", count(*) AS violations FROM {c} WHERE {ck} IS NOT NULL AND {ck} NOT IN (SELECT {pk} FROM {p})" for c, ck, p, pk in _FOREIGN)
_PK_SQL = " UNION ALL ".join(f"SELECT '{n}' AS \"constraint\", count(*) AS violations FROM (SELECT 1 FROM {n} GROUP BY {', '.join(k)} HAVING count(*) > 1)" for n, k in _KEYS.items())
_QUEUE_SQL = "q AS (SELECT user_id, CASE WHEN event_type IN ('purchase', 'error') THEN 'critical' ELSE 'blocking' END AS severity, CASE WHEN value > 50 THEN 'pending' ELSE 'resolved' END AS status FROM events)"


def _bases(spark: SparkSession, d: str) -> list[search.Searchable]:
    return [
        search.Searchable("documents", table(spark, d, "documents"), ("text", "source", "title"), ("doc_id", "lang", "source"), ("doc_id",)),
        search.Searchable("conversations", table(spark, d, "conversations"), ("text", "role"), ("conv_id", "turn", "role"), ("conv_id", "turn")),
        search.Searchable("benchmark", table(spark, d, "benchmark"), ("text",), ("item_id", "text"), ("item_id",)),
        search.Searchable("part", table(spark, d, "part"), ("p_name", "p_type"), ("p_partkey", "p_name"), ("p_partkey",)),
    ]


_TERM = " THE "


def search_documents(spark: SparkSession, d: str) -> DataFrame:
    hits = search.search(_bases(spark, d), _TERM, 50)
    return hits.select("table_rank", "row_key", "source_table", F.coalesce(F.col("fields")["lang"], F.lit("")).alias("lang"))


def search_hits(spark: SparkSession, d: str) -> DataFrame:
    """All hits of a term by table: the search without its limit."""
    return search.matches(_bases(spark, d), "thé%").unionByName(search.matches(_bases(spark, d), "EAU")).groupBy("source_table").agg(F.count(F.lit(1)).alias("n"), F.min("row_key").alias("first"), F.max("row_key").alias("last"))


def search_combined(spark: SparkSession, d: str) -> DataFrame:
    bases = _bases(spark, d)
    out = search.combined(search.matches(bases[2:], "the"), search.matches(bases[:2], "the"), 20)
    return out.select("place", "scope_rank", "scope", "validation", "source_table", "row_key")


def _search_sql(tables: list[tuple[int, str, list[str], str]], term: str) -> str:
    parts = []
    for rank, name, columns, key in tables:
        hits = [f"contains(translate({c}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{term}')" for c in columns]
        lang = "lang" if name == "documents" else "''"
        parts.append(f"SELECT {rank} AS table_rank, {key} AS row_key, '{name}' AS source_table, {lang} AS lang FROM {name} WHERE {' OR '.join(hits)}")
    return " UNION ALL ".join(parts)


_pad = lambda c: f"lpad(CAST({c} AS VARCHAR), 20, '0')"
_BASES_SQL = [(0, "documents", ["text", "source"], _pad("doc_id")), (1, "conversations", ["text", "role"], f"{_pad('conv_id')} || '|' || {_pad('turn')}"), (2, "benchmark", ["text"], _pad("item_id")), (3, "part", ["p_name", "p_type"], _pad("p_partkey"))]


def _entries(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    sha = F.sha2("text", 256)
    return docs.select(
        F.concat(F.lit("DOC_"), F.substring(sha, 1, 24)).alias("pack_id"), F.concat(F.lit("pack-"), "doc_id", F.lit(".zip")).alias("pack_file"), sha.alias("source_sha256"), F.length("text").cast("bigint").alias("pack_size_bytes"),
        F.when(F.col("doc_id") % 97 == 5, "PUBLISHED").otherwise(packs.CANDIDATE).alias("publication_state"),
    )


def catalogue_entries(spark: SparkSession, d: str) -> DataFrame:
    return packs.catalogue(_entries(spark, d))


def catalogue_problems(spark: SparkSession, d: str) -> DataFrame:
    return packs.catalogue_problems(_entries(spark, d))


def catalogue_verify(spark: SparkSession, d: str) -> DataFrame:
    """A stored catalogue in which every 50th entry was edited, against the recomputed one."""
    now = _entries(spark, d).select("pack_id", "pack_file", "source_sha256", "pack_size_bytes")
    n = F.regexp_extract("pack_file", "-([0-9]+)", 1).cast("bigint")
    stored = now.withColumn("pack_size_bytes", F.when(n % 50 == 0, F.col("pack_size_bytes") + 1).otherwise(F.col("pack_size_bytes"))).where(n % 31 != 3)
    return integrity.symmetric_difference(stored, now)


def pack_inspection(spark: SparkSession, d: str) -> DataFrame:
    """A pack for each order: members with digests, some of them broken in one way or another."""
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("k"))
    sha = lambda name: F.sha2(F.concat(F.lit(name), "k"), 256)
    names = ["source/document.pdf", "data/knowledge.sqlite", "ocr/page-1.tsv.gz"]
    declared = F.map_from_arrays(F.array(*[F.lit(n) for n in names]), F.array(*[sha(n) for n in names]))
    p = o.select(F.col("k").cast("string").alias("pack_id"), F.when(F.col("k") % 23 == 0, "zip").otherwise(packs.FORMAT).alias("format"), F.when(F.col("k") % 29 == 0, 2).otherwise(1).alias("format_version"), declared.alias("declared"),
                 F.when(F.col("k") % 31 == 0, "00").otherwise(sha(names[0])).alias("source_sha256"), F.lit(3).alias("declared_pages"), F.lit(1).alias("declared_ocr_pages"), F.when(F.col("k") % 37 == 0, 2).otherwise(3).alias("found_pages"), F.lit(1).alias("found_ocr_pages"), F.lit(packs.CANDIDATE).alias("publication_state"))
    member = F.explode(F.array(*[F.lit(n) for n in ["manifest.json", *names, "extra.txt"]]))
    m = o.withColumn("member", member).where("(member <> 'extra.txt' OR k % 13 = 0) AND NOT (member = 'manifest.json' AND k % 17 = 0) AND NOT (member = 'ocr/page-1.tsv.gz' AND k % 19 = 0)")
    m = m.select(F.col("k").cast("string").alias("pack_id"), "member", F.when((F.col("k") % 11 == 0) & (F.col("member") == names[1]), "ff").otherwise(F.sha2(F.concat("member", "k"), 256)).alias("sha256"))
    return packs.inspect(p, m).select("pack_id", "valid", "error")


def pack_staging(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("k"))
    sha = F.sha2(F.col("k").cast("string"), 256)
    incoming = c.select("k", F.when(F.col("k") % 17 == 0, "no digest").otherwise(sha).alias("source_sha256"), F.sha2(F.concat(F.lit("p"), "k"), 256).alias("pack_sha256"), F.when(F.col("k") % 13 == 0, packs.LARGEST_MEMBER + 1).otherwise(10).alias("largest_member"))
    current = c.where("k % 3 = 0").select(sha.alias("source_sha256"), F.when(F.col("k") % 2 == 0, F.sha2(F.concat(F.lit("p"), "k"), 256)).otherwise("old").alias("pack_sha256"))
    return packs.staged(current, incoming).select("k", "action")


def _lots(spark: SparkSession, d: str) -> DataFrame:
    """A correction lot for each nation: three corrections and their links, some of them broken."""
    n = table(spark, d, "nation").select(F.col("n_nationkey").alias("n"), "n_name")
    level = F.when(F.col("n") % 7 == 3, "draft").otherwise(corrections.VERIFIED)
    lines = []
    for i in range(3):
        values = [F.concat(F.lit(f"C{i}-"), "n"), F.concat(F.lit("F"), "n", F.lit(f"-{i}")), F.concat(F.lit("DOC:39.1-"), F.lit(i)), F.lit(f"DOC:39.2{i}"), F.concat(F.lit("it''s "), "n_name"), level, F.lit("note")]
        values = [F.concat(F.lit("'"), v, F.lit("'")) for v in values]
        full = F.concat(F.lit(corrections.CORRECTION_START.format(corrections.CORRECTION_TABLE)), F.concat_ws(",", *values), F.lit(");"))
        short = F.concat(F.lit(corrections.CORRECTION_START.format(corrections.CORRECTION_TABLE)), F.concat_ws(",", *values[:6]), F.lit(");"))
        lines.append(F.when((F.col("n") % 11 == 5) & F.lit(i == 1), short).when((F.col("n") % 5 == 4) & F.lit(i == 2), F.lit("-- none")).otherwise(full))
        role = F.when((F.col("n") % 9 == 2) & F.lit(i == 0), "other").otherwise("source")
        lines.append(F.concat(F.lit("  " + corrections.LINK_START.format(corrections.LINK_TABLE) + "'F"), "n", F.lit(f"-{i}','REF:DOC:39.2{i}','"), role, F.lit("','x');")))
    return n.select(F.concat(F.lit("lot-"), "n").alias("lot"), F.concat_ws("\n", *lines).alias("sql"))


def lot_status(spark: SparkSession, d: str) -> DataFrame:
    return corrections.lot_status(_lots(spark, d))


def _knowledge(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "nation").select(F.col("n_nationkey").alias("n")).withColumn("i", F.explode(F.array(*[F.lit(x) for x in range(4)])))
    return n.select(F.concat(F.lit("KNOW-F"), "n", F.lit("-"), "i").alias("knowledge_key"), F.when(F.col("n") % 6 == 1, "DOC:1.1").otherwise(F.concat(F.lit("DOC:39.1-"), "i")).alias("image_ref"), F.when(F.col("n") % 8 == 0, "section 4").otherwise("section 39.1, 39.10").alias("source_section"))


def corrections_apply(spark: SparkSession, d: str) -> DataFrame:
    fixes, links = corrections.parsed(_lots(spark, d))
    good = corrections.lot_status(_lots(spark, d)).where("status = 'OK'").select("lot")
    c, l = fixes.join(good, "lot").drop("lot"), links.join(good, "lot").drop("lot")
    return corrections.applied(_knowledge(spark, d), c, l)[0]


def _whole_lots(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The sound lots, two of them with an image that is not there."""
    fixes, links = corrections.parsed(_lots(spark, d))
    good = corrections.lot_status(_lots(spark, d)).where("status = 'OK'").select("lot")
    links = links.join(good, "lot").withColumn("image_ref", F.when(F.col("lot").isin("lot-17", "lot-23"), "gone").otherwise(F.col("image_ref")))
    images = spark.createDataFrame([(f"DOC:39.2{i}",) for i in range(3)], "image_ref string")
    return corrections.applied_whole(_knowledge(spark, d), fixes.join(good, "lot"), links, images)


def corrections_whole(spark: SparkSession, d: str) -> DataFrame:
    return _whole_lots(spark, d)[0]


def correction_history(spark: SparkSession, d: str) -> DataFrame:
    return _whole_lots(spark, d)[1]


def lot_application(spark: SparkSession, d: str) -> DataFrame:
    return _whole_lots(spark, d)[2]


_LOTS_SQL = """facts AS (SELECT n_nationkey AS n, i FROM nation, range(3) r(i)),
lots AS (SELECT n, 3 - CAST(n % 5 = 4 AS INTEGER) AS n_facts, CAST(n % 11 = 5 AS INTEGER) AS malformed,
  CASE WHEN n % 7 = 3 THEN 3 - CAST(n % 5 = 4 AS INTEGER) ELSE CAST(n % 9 = 2 AS INTEGER) END AS bad_links FROM (SELECT n_nationkey AS n FROM nation)),
judged AS (SELECT *, CASE WHEN malformed > 0 THEN 'INVALID_CORRECTION_SQL' WHEN bad_links > 0 THEN 'INVALID_CORRECTION_LINKS' WHEN n_facts <> 3 THEN 'CORRECTION_COUNT_MISMATCH' ELSE 'OK' END AS status FROM lots)"""


def _tsv_files(spark: SparkSession, d: str) -> DataFrame:
    """Documents as word tables: quotes, tabs in the last field, short lines, broken numbers, unknown confidences, other levels."""
    docs = table(spark, d, "documents").select("doc_id", "lang", F.split(F.regexp_replace("text", "[\t\r]", " "), "[ \n]+").alias("w"))

    def line(word, i):
        k = F.col("doc_id") + i
        conf = F.when(k % 5 == 0, "-1").when(k % 7 == 0, "").when(k % 23 == 0, "bad").otherwise(((k * 7) % 100).cast("string"))
        said = F.when(k % 11 == 0, F.concat(F.lit('"'), word)).when(k % 13 == 0, F.concat(word, F.lit("\tmore"))).otherwise(word)
        full = F.concat_ws("\t", F.when(k % 17 == 0, "4").otherwise("5"), F.lit("1"), F.when(k % 19 == 0, "").otherwise("2"), F.lit("1"), (i % 7).cast("string"), i.cast("string"), F.lit("10"), F.lit("20"), F.lit("30"), F.lit("40"), conf, said)
        return F.when(k % 29 == 0, "5\t1\t2").otherwise(full)

    head = F.when(F.col("doc_id") % 6 == 1, "a\tb").otherwise("\t".join(tsv.HEADER))
    text = F.when(F.col("doc_id") % 50 == 7, "").otherwise(F.concat_ws("\n", F.array(head), F.transform("w", line)))
    return docs.select(F.col("lang").alias("source"), F.col("doc_id").alias("page"), text.alias("tsv"))


def tsv_words(spark: SparkSession, d: str) -> DataFrame:
    return tsv.words(_tsv_files(spark, d)).select("page", "block_num", "line_num", "word_num", "left", "confidence", "text")


def tsv_warnings(spark: SparkSession, d: str) -> DataFrame:
    return tsv.warnings(_tsv_files(spark, d)).select("page", "code", "line_number")


_TSV_SQL = """w0 AS (SELECT doc_id, regexp_split_to_array(regexp_replace(text, '[\t\r]', ' ', 'g'), '[ \n]+') AS w FROM documents WHERE doc_id % 50 <> 7),
w1 AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS i FROM w0),
w2 AS (SELECT *, doc_id + i AS k FROM w1),
rows0 AS (SELECT doc_id AS page, i, k, i + 2 AS line_number, CASE WHEN k % 19 = 0 THEN 0 ELSE 2 END AS block_num, i % 7 AS line_num, i AS word_num,
  CASE WHEN k % 5 = 0 OR k % 7 = 0 THEN NULL WHEN k % 23 = 0 THEN 'bad' ELSE CAST((k * 7) % 100 AS VARCHAR) END AS conf, k % 29 = 0 AS short, k % 17 <> 0 AS is_word,
  trim(CASE WHEN k % 11 = 0 THEN '"' || word WHEN k % 13 = 0 THEN word || chr(9) || 'more' ELSE word END) AS text FROM w2)"""


def document_slugs(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_num", "line"))
    return lines.select("doc_id", "line_num", hierarchy.slug(F.col("line")).alias("slug"))


def preview_pages(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "orders").select((F.col("o_orderkey") % 700 + 1).cast("int").alias("n_pages")).distinct()
    return n.select("n_pages", _csv(F.transform(sources.preview_pages(F.col("n_pages")), lambda x: x.cast("string"))).alias("pages"))


def changed_files(spark: SparkSession, d: str) -> DataFrame:
    """Files of a push: the 2nd of each ten was added, the 3rd modified, the 4th deleted, the 5th renamed."""
    files = _files(spark, d).select("path", F.regexp_extract("path", r"([0-9]+)\.pdf$", 1).cast("bigint").alias("n"))
    changes = files.where("n % 10 BETWEEN 2 AND 5").select("path", F.when(F.col("n") % 10 == 2, "A").when(F.col("n") % 10 == 3, "M").when(F.col("n") % 10 == 4, "D").otherwise("R100").alias("status"))
    return sources.changed_only(files, changes, "push", "a" * 40)


def safe_paths(spark: SparkSession, d: str) -> DataFrame:
    """URLs and made-up paths by the rules for paths and archive members."""
    p = table(spark, d, "pages").select("page_id", F.regexp_extract("url", r"://[^/]*(.*)$", 1).alias("u"))
    made = F.when(F.col("page_id") % 6 == 0, F.concat(F.lit("images"), "u")).when(F.col("page_id") % 6 == 1, F.concat(F.lit("a\\..\\"), "u")).when(F.col("page_id") % 6 == 2, F.concat(F.lit("ocr/page-"), "page_id", F.lit(".tsv.gz"))).when(F.col("page_id") % 6 == 3, F.lit("C:/x")).when(F.col("page_id") % 6 == 4, F.lit("manifest.json")).otherwise(F.col("u"))
    return p.select("page_id", made.alias("path")).select("page_id", "path", t.is_safe_path(F.col("path")).alias("safe"), t.is_allowed_member(F.col("path")).alias("allowed"))


def publication_state(spark: SparkSession, d: str) -> DataFrame:
    """The gate over findings of several checks of the tables here."""
    bad = fk_violations(spark, d).where("violations > 0")
    twice = source_dedup(spark, d).where("role = 'duplicate'")
    sets = page_set_coverage(spark, d)
    found = [integrity.counted_blocker(bad, "FOREIGN_KEYS_BROKEN"), integrity.counted_blocker(twice, "DUPLICATE_SOURCES"), integrity.counted_blocker(sets.where("coverage = 'INCOMPLETE_PAGE_SET'"), "PACK_PDF_PHYSICAL_PAGES_INCOMPLETE")]
    found.append(integrity.findings_of(spark, [("SEMANTIC_COVERAGE_REQUIRES_PAGE_LEVEL_AUDIT", "unproven"), ("SEMANTIC_COVERAGE_REQUIRES_PAGE_LEVEL_AUDIT", "unproven")]))
    return integrity.publication_state(integrity.union_all(found)).select("state", _csv(F.col("blockers")).alias("blockers"), _csv(F.col("not_yet_proven")).alias("not_yet_proven"))


def inflate_lots(spark: SparkSession, d: str) -> DataFrame:
    """Nations' names as packed lots; every 4th says a wrong length, every 5th is cut off."""
    rows = []
    for r in table(spark, d, "nation").select("n_nationkey", "n_name").collect():  # 25 rows, by the table's definition
        data = r.n_name.encode() * 3
        raw = struct.pack(">I", len(data) + (r.n_nationkey % 4 == 0)) + zlib.compress(data)
        rows.append((str(r.n_nationkey), base64.b64encode(raw[:3] if r.n_nationkey % 5 == 0 else raw).decode()))
    return sources.unpacked_lots(spark.createDataFrame(rows, "lot string, packed string"))


def zip_members(spark: SparkSession, d: str) -> DataFrame:
    """Regions' names as archives of two members, the last of them broken."""
    rows = []
    for r in table(spark, d, "region").select("r_regionkey", "r_name").collect():  # 5 rows, by the table's definition
        held = io.BytesIO()
        with zipfile.ZipFile(held, "w") as z:
            z.writestr("manifest.json", "{}")
            z.writestr("data/x.txt", r.r_name)
        rows.append((f"r{r.r_regionkey}.zip", held.getvalue()[:20] if r.r_regionkey == 4 else held.getvalue()))
    return sources.zip_members(spark.createDataFrame(rows, "path string, content binary")).select("path", "member", "size_bytes", "sha256", "error")


QUERIES = {
    f.__name__: f
    for f in (
        page_kind, review_items_from_pages, document_counters, ink_shares, page_set_coverage, coverage_totals, contiguous_pages, page_status_by_revision, file_identity, source_dedup, original_audit,
        source_pack_identity, expand_references, resolve_references, reference_link_status, fk_violations, pk_duplicates, null_violations, table_counts, review_gate, store_validation, search_documents,
        search_hits, search_combined, catalogue_entries, catalogue_problems, catalogue_verify, pack_inspection, pack_staging, lot_status, corrections_apply, corrections_whole, correction_history, lot_application, tsv_words, tsv_warnings, document_slugs,
        preview_pages, changed_files, safe_paths, publication_state, inflate_lots, zip_members,
    )
}

_SHA = "sha256(text)"

ORACLE_SQL = {
    "page_kind": f"WITH {_NATIVE_SQL} SELECT page, page_kind FROM k",
    "review_items_from_pages": f"""WITH {_NATIVE_SQL}, c AS (SELECT sha256, page, unnest([CASE WHEN multicolumn THEN 'READING_ORDER_REVIEW' END, CASE WHEN page_kind IN ('raster_without_native_text', 'raster_and_vector_without_native_text') THEN 'OCR_REQUIRED' END,
  CASE WHEN page_kind IN ('vector_without_native_text', 'raster_and_vector_without_native_text') THEN 'VECTOR_PASS_REQUIRED' END, CASE WHEN page_kind = 'visible_content_not_explained_by_native_objects' THEN 'VISIBLE_CONTENT_UNRESOLVED' END]) AS code FROM k)
SELECT sha256(sha256 || ':' || page || ':' || code)[1:24] AS review_id, sha256, page, code, 'blocking' AS severity, 'unresolved' AS status FROM c WHERE code IS NOT NULL""",
    "document_counters": f"""WITH {_NATIVE_SQL} SELECT sha256, count(*) AS n_pages, CAST(sum(text_chars) AS BIGINT) AS text_chars, CAST(sum(images) AS BIGINT) AS images, CAST(sum(vectors) AS BIGINT) AS vectors, CAST(sum(links) AS BIGINT) AS links,
  count(*) FILTER (text_chars > 0) AS text_pages, count(*) FILTER (images > 0 AND text_chars = 0) AS ocr_pages, count(*) FILTER (page_kind = 'blank_verified_by_render') AS blank_pages, count(*) FILTER (multicolumn) AS multicolumn_pages FROM k GROUP BY 1""",
    "ink_shares": "SELECT l_orderkey, count(*) FILTER (CAST(trunc(l_extendedprice % 256) AS INTEGER) < 200) / count(*) AS ink FROM lineitem GROUP BY 1",
    "page_set_coverage": f"WITH {_PAGE_SETS_SQL} SELECT * FROM verdicts",
    "coverage_totals": f"WITH {_PAGE_SETS_SQL} SELECT CAST(sum(n_pages) AS BIGINT) AS expected_pages, CAST(sum(CASE WHEN coverage = 'COMPLETE_PAGE_SET' THEN n_pages ELSE 0 END) AS BIGINT) AS verified_pages, count(*) FILTER (coverage = 'COMPLETE_PAGE_SET') AS complete_sets FROM verdicts",
    "contiguous_pages": "SELECT l_orderkey AS source, count(*) AS n_pages, list_sort(list(l_linenumber)) = list_transform(range(1, count(*) + 1), lambda x: CAST(x AS INTEGER)) AS contiguous FROM lineitem GROUP BY 1",
    "page_status_by_revision": "SELECT l_orderkey AS revision, CASE WHEN l_returnflag IN ('R', 'A') THEN 'UNSPECIFIED' ELSE l_linestatus END AS extraction_status, count(*) AS n_pages, count(DISTINCT l_linenumber) AS n_distinct_pages FROM lineitem GROUP BY 1, 2",
    "file_identity": f"""SELECT 'depot/' || lpad(CAST(doc_id AS VARCHAR), 9, '0') || '.pdf' AS path, CAST(strlen(text) AS BIGINT) AS size_bytes, {_SHA} AS sha256, sha1(encode('blob ' || strlen(text)) || '\\x00'::BLOB || encode(text)) AS git_blob_sha1,
  'REV_' || {_SHA} AS revision_id, 'DOC_' || {_SHA}[1:24] AS document_id FROM documents""",
    "source_dedup": f"""WITH f AS (SELECT 'depot/' || lpad(CAST(doc_id AS VARCHAR), 9, '0') || '.pdf' AS path, {_SHA} AS sha256 FROM documents)
SELECT path, sha256, first_value(path) OVER w AS original, CASE WHEN row_number() OVER w = 1 THEN 'original' ELSE 'duplicate' END AS role FROM f WINDOW w AS (PARTITION BY sha256 ORDER BY path)""",
    "original_audit": """SELECT 'depot/' || lpad(CAST(doc_id AS VARCHAR), 9, '0') || '.pdf' AS path, CASE WHEN doc_id % 7 = 0 THEN 'EXTRA' WHEN doc_id % 11 = 0 THEN 'INVALID' ELSE 'OK' END AS state FROM documents
UNION ALL VALUES ('depot/gone-1.pdf', 'MISSING'), ('depot/gone-2.pdf', 'MISSING')""",
    "source_pack_identity": f"""WITH {_SOURCE_PACK_SQL} SELECT path, document_key, proof, CASE WHEN document_key IS NULL THEN 'source_id_not_proven' WHEN row_number() OVER (PARTITION BY document_key ORDER BY n) > 1 THEN 'ambiguous_source_id' ELSE 'matched' END AS state FROM joined""",
    "expand_references": f"WITH {_REFERENCES_SQL} SELECT r.key, count(one) AS n_parts, coalesce(string_agg(one, '|' ORDER BY pos), '') AS parts FROM refs r LEFT JOIN firsts f ON f.key = r.key GROUP BY r.key",
    "resolve_references": f"WITH {_RESOLVED_SQL} SELECT key, reference, relative_path, status FROM resolved",
    "reference_link_status": f"""WITH {_RESOLVED_SQL}, s AS (SELECT key, count(*) AS n_parts, count(*) FILTER (status = 'OK') AS n_ok FROM resolved GROUP BY key)
SELECT *, CASE WHEN n_ok = n_parts THEN 'OK' WHEN n_ok > 0 THEN 'PARTIAL' ELSE 'NOT_RESOLVED' END AS link_status FROM s""",
    "fk_violations": _FK_SQL,
    "pk_duplicates": _PK_SQL,
    "null_violations": " UNION ALL ".join(f"SELECT '{n}' AS \"constraint\", count(*) FILTER ({' OR '.join(f'{x} IS NULL' for x in k)}) AS violations FROM {n}" for n, k in _KEYS.items()),
    "table_counts": " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS n_rows FROM {n}" for n in _KEYS),
    "review_gate": f"WITH {_QUEUE_SQL} SELECT user_id, count(*) AS n_items, count(*) FILTER (status = 'pending') AS pending, count(*) FILTER (status = 'pending' AND severity = 'critical') AS critical_pending, count(*) FILTER (status = 'pending') > 0 AS publication_blocked FROM q GROUP BY 1",
    "store_validation": f"""WITH {_QUEUE_SQL}, v AS ({_FK_SQL} UNION ALL {_PK_SQL}), a AS (SELECT CAST(sum(violations) AS BIGINT) AS violations FROM v), b AS (SELECT count(*) FILTER (status = 'pending') AS pending, count(*) FILTER (status = 'pending' AND severity = 'critical') AS critical_pending FROM q)
SELECT *, CASE WHEN violations = 0 THEN 'ok' ELSE 'violated' END AS integrity, pending > 0 OR violations > 0 AS publication_blocked FROM a, b""",
    "search_documents": f"SELECT * FROM ({_search_sql(_BASES_SQL, 'the')}) ORDER BY table_rank, row_key LIMIT 50",
    "search_hits": f"SELECT source_table, count(*) AS n, min(row_key) AS first, max(row_key) AS last FROM ({_search_sql(_BASES_SQL, 'thé%')} UNION ALL {_search_sql(_BASES_SQL, 'eau')}) GROUP BY 1",
    "search_combined": f"""WITH a AS (SELECT *, row_number() OVER (ORDER BY table_rank, row_key) AS place, 0 AS scope_rank, 'EXISTING_REFERENCE' AS scope, 'INSTALLED_REFERENCE' AS validation FROM ({_search_sql(_BASES_SQL[2:], 'the')})),
b AS (SELECT *, row_number() OVER (ORDER BY table_rank, row_key) AS place, 1 AS scope_rank, 'DOCUMENT_UPDATE_PREVIEW' AS scope, 'UNVERIFIED_SOURCE_TEXT' AS validation FROM ({_search_sql(_BASES_SQL[:2], 'the')}))
SELECT place, scope_rank, scope, validation, source_table, row_key FROM (SELECT * FROM a UNION ALL SELECT * FROM b) ORDER BY place, scope_rank LIMIT 20""",
    "catalogue_entries": f"""SELECT 'DOC_' || {_SHA}[1:24] AS pack_id, 'pack-' || doc_id || '.zip' AS pack_file, {_SHA} AS source_sha256, CAST(length(text) AS BIGINT) AS pack_size_bytes, CASE WHEN doc_id % 97 = 5 THEN 'PUBLISHED' ELSE 'CANDIDATE_NOT_VALIDATED' END AS publication_state,
  'CANDIDATE_NOT_VALIDATED' AS validation_state, false AS approved_for_ai, false AS redistribution_approved FROM documents""",
    "catalogue_problems": f"""SELECT 'DUPLICATE_SOURCE' AS problem, {_SHA} AS "value", count(*) AS n FROM documents GROUP BY 2 HAVING count(*) > 1 UNION ALL SELECT 'DUPLICATE_PACK_ID', 'DOC_' || {_SHA}[1:24], count(*) FROM documents GROUP BY 2 HAVING count(*) > 1
UNION ALL SELECT 'NOT_A_CANDIDATE', 'PUBLISHED', count(*) FROM documents WHERE doc_id % 97 = 5 HAVING count(*) > 0""",
    "catalogue_verify": f"""WITH now AS (SELECT doc_id, 'DOC_' || {_SHA}[1:24] AS pack_id, 'pack-' || doc_id || '.zip' AS pack_file, {_SHA} AS source_sha256, CAST(length(text) AS BIGINT) AS pack_size_bytes FROM documents)
SELECT pack_id, pack_file, source_sha256, pack_size_bytes + 1 AS pack_size_bytes, 'only_first' AS side FROM now WHERE doc_id % 50 = 0 AND doc_id % 31 <> 3 UNION ALL SELECT pack_id, pack_file, source_sha256, pack_size_bytes, 'only_second' FROM now WHERE doc_id % 50 = 0 OR doc_id % 31 = 3""",
    "pack_inspection": """SELECT CAST(o_orderkey AS VARCHAR) AS pack_id, e IS NULL AS valid, e AS error FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 13 = 0 OR o_orderkey % 17 = 0 THEN 'unexpected_or_missing_members' WHEN o_orderkey % 23 = 0 THEN 'unknown_format'
  WHEN o_orderkey % 29 = 0 THEN 'unknown_format_version' WHEN o_orderkey % 19 = 0 THEN 'manifest_member_list_mismatch' WHEN o_orderkey % 11 = 0 THEN 'member_hash_invalid' WHEN o_orderkey % 31 = 0 THEN 'source_sha256_invalid' WHEN o_orderkey % 37 = 0 THEN 'sqlite_validation_failed' END AS e FROM orders)""",
    "pack_staging": """SELECT c_custkey AS k, CASE WHEN c_custkey % 17 = 0 THEN 'INVALID_SHA256' WHEN c_custkey % 13 = 0 THEN 'MEMBER_TOO_LARGE' WHEN c_custkey % 3 <> 0 THEN 'STAGED' WHEN c_custkey % 2 = 0 THEN 'ALREADY_PRESENT' ELSE 'CONFLICTING_PACK_REVISION' END AS action FROM customer""",
    "lot_status": f"WITH {_LOTS_SQL} SELECT 'lot-' || n AS lot, CAST(n_facts AS BIGINT) AS n_facts, CAST(bad_links AS BIGINT) AS bad_links, CAST(malformed AS BIGINT) AS malformed, status FROM judged",
    "corrections_apply": f"""WITH {_LOTS_SQL}, k AS (SELECT n_nationkey AS n, i, 'KNOW-F' || n_nationkey || '-' || i AS knowledge_key, CASE WHEN n_nationkey % 6 = 1 THEN 'DOC:1.1' ELSE 'DOC:39.1-' || i END AS image_ref, CASE WHEN n_nationkey % 8 = 0 THEN 'section 4' ELSE 'section 39.1, 39.10' END AS source_section FROM nation, range(4) r(i)),
h AS (SELECT k.*, coalesce(j.status = 'OK' AND i < 3 AND k.n % 6 <> 1 AND k.n % 8 <> 0, false) AS hit FROM k LEFT JOIN judged j ON j.n = k.n)
SELECT knowledge_key, CASE WHEN hit THEN 'DOC:39.2' || i ELSE image_ref END AS image_ref, CASE WHEN hit THEN replace(source_section, '39.1', '39.2') ELSE source_section END AS source_section FROM h""",
    "corrections_whole": f"""WITH {_LOTS_SQL}, k AS (SELECT n_nationkey AS n, i, 'KNOW-F' || n_nationkey || '-' || i AS knowledge_key, CASE WHEN n_nationkey % 6 = 1 THEN 'DOC:1.1' ELSE 'DOC:39.1-' || i END AS image_ref, CASE WHEN n_nationkey % 8 = 0 THEN 'section 4' ELSE 'section 39.1, 39.10' END AS source_section FROM nation, range(4) r(i)),
h AS (SELECT k.*, coalesce(j.status = 'OK' AND i < 3 AND k.n % 6 <> 1 AND k.n % 8 <> 0 AND k.n NOT IN (17, 23), false) AS hit FROM k LEFT JOIN judged j ON j.n = k.n)
SELECT knowledge_key, CASE WHEN hit THEN 'DOC:39.2' || i ELSE image_ref END AS image_ref, CASE WHEN hit THEN replace(source_section, '39.1', '39.2') ELSE source_section END AS source_section FROM h""",
    "correction_history": f"""WITH {_LOTS_SQL} SELECT 'C' || i || '-' || j.n AS correction_key, 'KNOW-F' || j.n || '-' || i AS knowledge_key, 'DOC:39.1-' || i AS old_image_ref, 'DOC:39.2' || i AS new_image_ref, 'section 39.1, 39.10' AS old_section, 'section 39.2, 39.20' AS new_section
FROM judged j, range(3) r(i) WHERE status = 'OK' AND j.n % 6 <> 1 AND j.n % 8 <> 0 AND j.n NOT IN (17, 23)""",
    "lot_application": f"""WITH {_LOTS_SQL} SELECT 'lot-' || n AS lot, CASE WHEN n % 6 = 1 OR n % 8 = 0 THEN 'LEGACY_VALUE_MISMATCH' WHEN n IN (17, 23) THEN 'IMAGE_NOT_RESOLVED' ELSE 'APPLIED' END AS status FROM judged WHERE status = 'OK'""",
    "tsv_words": f"WITH {_TSV_SQL} SELECT page, block_num, line_num, word_num, 10 AS \"left\", CAST(conf AS DOUBLE) AS confidence, text FROM rows0 WHERE NOT short AND is_word AND text <> '' AND conf IS DISTINCT FROM 'bad'",
    "tsv_warnings": f"""WITH {_TSV_SQL} SELECT doc_id AS page, 'EMPTY_TSV' AS code, 0 AS line_number FROM documents WHERE doc_id % 50 = 7 UNION ALL SELECT doc_id, 'UNEXPECTED_TSV_HEADER', 1 FROM documents WHERE doc_id % 6 = 1 AND doc_id % 50 <> 7
UNION ALL SELECT page, 'MALFORMED_TSV_ROW', line_number FROM rows0 WHERE short UNION ALL SELECT page, 'INVALID_TSV_WORD_ROW', line_number FROM rows0 WHERE NOT short AND is_word AND text <> '' AND conf = 'bad'""",
    "document_slugs": """SELECT doc_id, line_num, coalesce(nullif(trim(regexp_replace(lower(regexp_replace(strip_accents(line), '[^\\x00-\\x7F]', '', 'g')), '[^a-z0-9]+', '-', 'g'), '-'), ''), 'unresolved') AS slug
FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_num FROM documents)""",
    "preview_pages": """WITH n AS (SELECT DISTINCT CAST(o_orderkey % 700 + 1 AS INTEGER) AS n_pages FROM orders), c AS (SELECT n_pages, unnest(range(1, 13)) AS p FROM n UNION SELECT n_pages, unnest([100, 200, 300, 400, n_pages]) FROM n
UNION SELECT n_pages, greatest(1, least(n_pages, CAST(round_even(n_pages * s, 0) AS INTEGER))) FROM n, (VALUES (0.1::DOUBLE), (0.25), (0.5), (0.75), (0.9)) v(s) WHERE n_pages > 20)
SELECT n_pages, string_agg(CAST(p AS VARCHAR), ',' ORDER BY p) AS pages FROM c WHERE p BETWEEN 1 AND n_pages GROUP BY 1""",
    "changed_files": "SELECT 'depot/' || lpad(CAST(doc_id AS VARCHAR), 9, '0') || '.pdf' AS path, doc_id AS n FROM documents WHERE doc_id % 10 IN (2, 3, 5)",
    "safe_paths": """WITH u AS (SELECT page_id, regexp_extract(url, '://[^/]*(.*)$', 1) AS u FROM pages),
m AS (SELECT page_id, CASE page_id % 6 WHEN 0 THEN 'images' || u WHEN 1 THEN 'a\\..\\' || u WHEN 2 THEN 'ocr/page-' || page_id || '.tsv.gz' WHEN 3 THEN 'C:/x' WHEN 4 THEN 'manifest.json' ELSE u END AS path FROM u)
SELECT page_id, path, path <> '' AND NOT contains(path, ':') AND NOT list_has_any(string_split(replace(path, '\\', '/'), '/'), ['', '.', '..']) AS safe, regexp_full_match(path, 'manifest\\.json|source/document\\.pdf|data/knowledge\\.sqlite|ocr/page-[0-9]+\\.tsv\\.gz') AS allowed FROM m""",
    "publication_state": f"""WITH {_PAGE_SETS_SQL}, f AS ({_FK_SQL}), b AS (SELECT 'FOREIGN_KEYS_BROKEN:' || count(*) AS code FROM f WHERE violations > 0 HAVING count(*) > 0
UNION ALL SELECT 'DUPLICATE_SOURCES:' || n FROM (SELECT count(*) - count(DISTINCT text) AS n FROM documents) WHERE n > 0 UNION ALL SELECT 'PACK_PDF_PHYSICAL_PAGES_INCOMPLETE:' || count(*) FROM verdicts WHERE coverage = 'INCOMPLETE_PAGE_SET' HAVING count(*) > 0)
SELECT CASE WHEN count(*) > 0 THEN 'BLOCKED' ELSE 'REVIEW_REQUIRED' END AS state, coalesce(string_agg(code, ',' ORDER BY code), '') AS blockers, 'SEMANTIC_COVERAGE_REQUIRES_PAGE_LEVEL_AUDIT' AS not_yet_proven FROM b""",
}
