"""The star-schema and text tables as evidence records, by fixed integer arithmetic, and the same in SQL for the oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import dealt, table

PAGE_WIDTH, PAGE_HEIGHT = 2480, 3508
#: Bytes of documents' files whose words a task gets: about a thousand texts.
PAGES_BYTES = 2 << 20


def words(spark: SparkSession, sf_dir: str, dealt_by_page: bool = False) -> DataFrame:
    """Every space-separated word of every line of documents, with a confidence from 40 to 100 and a box on a page; even pages have two columns.

    dealt_by_page: documents are dealt to tasks by page before they become words, so that lines, regions and pages are put together where their
    words are: a document is a fraction of its words' rows."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    if dealt_by_page:
        docs = dealt(docs, ["lang", "doc_id"], table(spark, sf_dir, "documents"), PAGES_BYTES)
    lines = docs.select("doc_id", "lang", F.posexplode(F.split("text", "\n")).alias("line_num", "line"))
    out = lines.select("doc_id", "lang", "line_num", F.posexplode(F.split("line", " ")).alias("word_num", "text")).where("text <> ''")
    row, col = F.expr("word_num div 16"), F.col("word_num") % 16
    left = F.when(F.col("doc_id") % 2 == 0, F.lit(100) + (F.col("word_num") % 8) * 130 + F.when(col >= 8, 1250).otherwise(0)).otherwise(F.lit(100) + col * 140 + (F.col("line_num") % 7) * 20)
    confidence = (F.col("doc_id") * 31 + F.col("line_num") * 17 + F.col("word_num") * 7) % 61 + 40
    return out.select(
        F.col("lang").alias("source"), F.col("doc_id").alias("page"), F.col("line_num").alias("block_num"), F.lit(1).alias("par_num"), "line_num", "word_num",
        left.cast("int").alias("left"), (F.lit(60) + ((F.col("line_num") * 3 + row) % 110) * 31).cast("int").alias("top"), F.lit(100).alias("width"), F.lit(30).alias("height"),
        "text", confidence.cast("double").alias("confidence"), F.lit(PAGE_WIDTH).alias("page_width"), F.lit(PAGE_HEIGHT).alias("page_height"),
    )


WORDS_SQL = f"""
lines0 AS (SELECT doc_id, lang, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_num FROM documents),
words0 AS (SELECT doc_id, lang, line_num, unnest(string_split(line, ' ')) AS text, generate_subscripts(string_split(line, ' '), 1) - 1 AS word_num FROM lines0),
words AS (SELECT lang AS source, doc_id AS page, line_num AS block_num, 1 AS par_num, line_num, word_num,
  CASE WHEN doc_id % 2 = 0 THEN 100 + (word_num % 8) * 130 + CASE WHEN word_num % 16 >= 8 THEN 1250 ELSE 0 END ELSE 100 + (word_num % 16) * 140 + (line_num % 7) * 20 END AS "left",
  60 + ((line_num * 3 + word_num // 16) % 110) * 31 AS top, 100 AS width, 30 AS height, text,
  CAST((doc_id * 31 + line_num * 17 + word_num * 7) % 61 + 40 AS DOUBLE) AS confidence, {PAGE_WIDTH} AS page_width, {PAGE_HEIGHT} AS page_height
  FROM words0 WHERE text <> '')"""


def numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as numbered steps: procedure, phase and number."""
    flag = F.col("l_returnflag")
    phase = F.when(flag == "R", "remove").when(flag == "A", "adjust").otherwise("refit")
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("procedure"), phase.alias("phase"), F.col("l_linenumber").alias("number"), F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supplier"), F.col("l_shipdate").alias("shipped"), F.col("l_extendedprice").alias("price"))


def source_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of manual pages from orders and their parts: per order (of every fourth group without its number, so that fragments occur) a title,
    a repair number, phase headings, numbered steps with a bullet and a continuation. Page = order key div 4, region by its parity.

    Order lines are dealt to tasks by page once; whatever is made of pages, regions and segments after that needs no other exchange."""
    from pyspark.sql import Window as W

    key = F.col("procedure")
    rank = F.when(F.col("phase") == "remove", 1).when(F.col("phase") == "adjust", 2).otherwise(3)
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("part"), F.col("p_name").alias("name"))
    steps = numbered(spark, sf_dir).join(parts.hint("shuffle_hash"), "part", "left")
    steps = steps.select(F.lit("manual").alias("source"), F.expr("procedure div 4").alias("page"), F.when(key % 2 == 0, "left").otherwise("right").alias("region"), "procedure", rank.alias("rank"), "number", "part", "name")
    steps = dealt(steps, ["page"], table(spark, sf_dir, "lineitem"))
    whole = W.partitionBy("source", "page", "region", "procedure")
    own = ["rank", "number", "part", "name"]
    order = whole.orderBy(*own)
    steps = steps.withColumns({"opens": F.row_number().over(order) == 1} | {f"same_{x}": F.lag(x).over(order).eqNullSafe(F.col(x)) for x in own})
    steps = steps.where(F.col("opens") | ~(F.col("same_rank") & F.col("same_number") & F.col("same_part") & F.col("same_name")))  # each once
    steps = steps.withColumn("first", F.min(F.when(F.col("part").isNotNull(), F.struct("part", "name"))).over(whole))
    line = lambda o1, o2, o3, o4, text: F.struct(o1.alias("o1"), o2.alias("o2"), o3.alias("o3"), o4.alias("o4"), text.alias("text"))
    zero, k, number, part = F.lit(0), F.col("rank"), F.col("number"), F.col("part")
    anchored = F.col("opens") & (key % 8 != 3)
    repair = F.concat(F.lit("Service Repair No. "), key % 90 + 10, F.lit("."), key % 7, F.lit("."), key % 50)
    phase = F.concat(F.element_at(F.array(*map(F.lit, ["Remove", "Adjust", "Refit"])), k), F.when(key % 3 == 0, ":").otherwise(""))
    made = F.array(
        F.when(anchored, line(zero, zero, zero, F.lit(0).cast("bigint"), F.upper(F.coalesce("first.name", F.lit("PART"))))),
        F.when(anchored, line(zero, F.lit(1), zero, F.lit(0).cast("bigint"), repair)),
        F.when((F.col("opens") | ~F.col("same_rank")) & (key % 16 != 11), line(k, zero, zero, F.lit(0).cast("bigint"), phase)),
        line(k, number, zero, part, F.concat(number, F.lit(". "), F.coalesce("name", F.lit("part")))),
        F.when(part % 5 == 0, line(k, number, F.lit(1), part, F.concat(F.lit("- item "), part))),
        F.when(part % 7 == 0, line(k, number, F.lit(2), part, F.concat(F.lit("and then "), part))),
    )
    out = steps.select("source", "page", "region", "procedure", F.explode(made).alias("l")).where("l IS NOT NULL").select("source", "page", "region", "procedure", "l.*")
    order = W.partitionBy("source", "page", "region").orderBy("procedure", "o1", "o2", "o4", "o3", "text")
    confidence = (F.col("procedure") * 13 + F.col("o2") * 7 + F.col("o1")) % 45 + 56
    return out.select("source", "page", "region", (F.row_number().over(order) - 1).alias("line_index"), "text", confidence.cast("double").alias("mean_confidence"))


def source_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages of source_lines, which has a line at least for every order line."""
    return table(spark, sf_dir, "lineitem").select(F.lit("manual").alias("source"), F.expr("l_orderkey div 4").alias("page")).distinct()


SOURCE_LINES_SQL = """
steps0 AS (SELECT DISTINCT l_orderkey AS procedure, CASE l_returnflag WHEN 'R' THEN 'remove' WHEN 'A' THEN 'adjust' ELSE 'refit' END AS phase,
  CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 2 ELSE 3 END AS rank, l_linenumber AS number, l_partkey AS part, p_name AS name FROM lineitem LEFT JOIN part ON p_partkey = l_partkey),
first0 AS (SELECT procedure, min(part) AS part FROM steps0 GROUP BY procedure),
first1 AS (SELECT procedure, p_name AS name FROM first0 LEFT JOIN part ON p_partkey = part),
lines1 AS (
  SELECT procedure, 0 AS o1, 0 AS o2, 0 AS o3, 0 AS o4, upper(coalesce(name, 'PART')) AS text FROM first1 WHERE procedure % 8 <> 3
  UNION ALL SELECT procedure, 0, 1, 0, 0, 'Service Repair No. ' || (procedure % 90 + 10) || '.' || (procedure % 7) || '.' || (procedure % 50) FROM first1 WHERE procedure % 8 <> 3
  UNION ALL SELECT DISTINCT procedure, rank, 0, 0, 0, upper(phase[1]) || phase[2:] || CASE WHEN procedure % 3 = 0 THEN ':' ELSE '' END FROM steps0 WHERE procedure % 16 <> 11
  UNION ALL SELECT procedure, rank, number, 0, part, number || '. ' || coalesce(name, 'part') FROM steps0
  UNION ALL SELECT procedure, rank, number, 1, part, '- item ' || part FROM steps0 WHERE part % 5 = 0
  UNION ALL SELECT procedure, rank, number, 2, part, 'and then ' || part FROM steps0 WHERE part % 7 = 0),
source_lines AS (SELECT 'manual' AS source, procedure // 4 AS page, CASE WHEN procedure % 2 = 0 THEN 'left' ELSE 'right' END AS region,
  row_number() OVER (PARTITION BY procedure // 4, procedure % 2 ORDER BY procedure, o1, o2, o4, o3, text) - 1 AS line_index, text,
  CAST((procedure * 13 + o2 * 7 + o1) % 45 + 56 AS DOUBLE) AS mean_confidence FROM lines1)"""


def chapter_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as contents anchors: every 17th page opens a chapter; neighbouring anchors share titles, every fifth has none."""
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").alias("page"))
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("name"))
    anchors = pages.where("page % 17 = 0").withColumn("k", F.expr("cast((page div 34) % 25 as int)")).join(nations, "k", "left")
    title = F.when(F.expr("(page div 17) % 5 <> 4"), F.col("name"))
    return anchors.select(F.lit("manual").alias("source"), "page", title.alias("title"), F.when(F.expr("(page div 17) % 3 = 0"), "CANDIDATE_ONLY").otherwise("REVIEW_REQUIRED").alias("status"))


ANCHORS_SQL = """
anchors AS (SELECT 'manual' AS source, page_id AS page, CASE WHEN (page_id // 17) % 5 <> 4 THEN n_name END AS title,
  CASE WHEN (page_id // 17) % 3 = 0 THEN 'CANDIDATE_ONLY' ELSE 'REVIEW_REQUIRED' END AS status
  FROM pages LEFT JOIN nation ON n_nationkey = (page_id // 34) % 25 WHERE page_id % 17 = 0)"""
