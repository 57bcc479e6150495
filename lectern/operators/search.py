"""Substring search over allow-listed tables, merged scopes, ordered limits."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as t

MOST_ROWS = 50


@dataclass(frozen=True)
class Searchable:
    """A table with the columns that are matched and those that are shown; columns it does not have are left out."""

    name: str
    frame: DataFrame
    match: tuple[str, ...]
    show: tuple[str, ...]
    order: tuple[str, ...]


def clamp(limit: int) -> int:
    return max(1, min(MOST_ROWS, limit))


def matches(tables: list[Searchable], term: str) -> DataFrame:
    """All hits: rank of the table, position keys as text, name and a map of the shown fields. A is a but É is not é; no character of the term
    is a wildcard; blanks around it do not count, and an empty term hits nothing."""
    wanted = F.lit(term.strip().translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    out = None
    for rank, s in enumerate(tables):
        match, show = ([c for c in names if c in s.frame.columns] for names in (s.match, s.show))
        if not match or not show:
            continue
        hit = F.lit(False)
        for c in match:
            hit = hit | F.coalesce(F.contains(t.ascii_lower(F.col(c).cast("string")), wanted), F.lit(False))
        fields = F.create_map(*[x for c in show for x in (F.lit(c), F.col(c).cast("string"))])
        padded = lambda x: F.when(F.length(x) < 20, F.lpad(x, 20, "0")).otherwise(x)  # noqa: E731 (longer keys stay whole)
        order = F.concat_ws("|", *[padded(F.col(c).cast("string")) for c in s.order])
        own = s.frame.where(hit if term.strip() else F.lit(False)).select(F.lit(rank).alias("table_rank"), order.alias("row_key"), F.lit(s.name).alias("source_table"), fields.alias("fields"))
        out = own if out is None else out.unionByName(own)
    return out


def search(tables: list[Searchable], term: str, limit: int = 20) -> DataFrame:
    """The first hits, tables in their order and rows in that of their keys; one limit for all tables."""
    return matches(tables, term).orderBy("table_rank", "row_key").limit(clamp(limit))


def combined(existing: DataFrame, previews: DataFrame, limit: int = 20) -> DataFrame:
    """Hits of two scopes in turn, the installed one first, so that both are seen when both have any."""
    scopes = [(existing, 0, "EXISTING_REFERENCE", "INSTALLED_REFERENCE"), (previews, 1, "DOCUMENT_UPDATE_PREVIEW", "UNVERIFIED_SOURCE_TEXT")]
    rows = None
    for frame, rank, scope, validation in scopes:
        first = frame.orderBy("table_rank", "row_key").limit(clamp(limit))  # no more than the limit can show, so the ranking below is over few rows
        own = first.withColumn("place", F.row_number().over(W.orderBy("table_rank", "row_key"))).withColumns({"scope_rank": F.lit(rank), "scope": F.lit(scope), "validation": F.lit(validation)})
        rows = own if rows is None else rows.unionByName(own)
    return rows.orderBy("place", "scope_rank").limit(clamp(limit))


def search_bases(bases: dict[str, list[Searchable]], term: str, limit: int = 20) -> tuple[DataFrame, DataFrame]:
    """Several bases in one request: the hits, those of the first base first, and how many each base has, as far as the limit lets it show them.
    A base that has none does not end the search."""
    rows = None
    for rank, (name, tables) in enumerate(bases.items()):
        own = matches(tables, term).orderBy("table_rank", "row_key").limit(clamp(limit)).select(F.lit(rank).alias("base_rank"), F.lit(name).alias("base"), "*")
        rows = own if rows is None else rows.unionByName(own)
    names = rows.sparkSession.createDataFrame([(k, n) for k, n in enumerate(bases)], "base_rank int, base string")
    report = names.join(rows.groupBy("base").agg(F.count(F.lit(1)).alias("hits")), "base", "left").fillna(0, ["hits"])
    return rows.orderBy("base_rank", "table_rank", "row_key").limit(clamp(limit)), report


def enriched(hits: DataFrame, links: DataFrame, key: str, reference: str) -> DataFrame:
    """Hits whose fields have a reference, with what became of it (see audit.knowledge_links): its status, the parts that are missing, and whether
    a correction replaced it. Other hits have nulls."""
    own = hits.withColumn("__key", F.when(F.trim(F.col("fields")[reference]) != "", F.col("fields")[key]))
    found = links.select(F.col("key").cast("string").alias("__key"), F.col("link_status").alias("image_reference_status"), "n_ok", "missing_parts", "corrected")
    return own.join(found, "__key", "left").drop("__key")
