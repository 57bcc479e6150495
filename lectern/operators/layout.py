"""Page layout from word boxes: regions, gutter, columns, lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .ocr import PAGE

# Fixed values of the layout rules.
HEADER_SHARE, FOOTER_SHARE = 0.055, 0.94
GUTTER_FROM, GUTTER_TO, GUTTER_STEP = 0.32, 0.68, 10
LEAST_BODY, LEAST_SIDE = 20, 10
CROSSING_COST, GAP_GAIN, BALANCE_GAIN = 1000, 2, 20
REGION_RANK = {"header": 0, "left": 1, "body": 1, "right": 2, "spanning": 3, "footer": 4}


def regions(words: DataFrame) -> DataFrame:
    """words with page_width and page_height -> vertical region: header, footer or body."""
    region = F.when(F.col("top") < F.col("page_height") * HEADER_SHARE, "header").when(F.col("top") >= F.col("page_height") * FOOTER_SHARE, "footer").otherwise("body")
    return words.withColumn("region", region)


def gutter_candidates(words: DataFrame) -> DataFrame:
    """words with region -> per page and candidate x: crossing, left and right words, gap, balance and score, where 10 words at least stand
    on either side and 20 in the body.

    Words are first counted by the last candidate at or before them and the first at or after them; all that lie beyond the candidates on one
    side are one row then. Such a row is written down only at the candidates where its words become left, stop being right, and begin and
    end to cross; counts and edges at the others are running sums, so that words are not multiplied by candidates."""
    body = words.where("region = 'body' AND page_width > 0")
    first, last = (F.col("page_width") * GUTTER_FROM).cast("int"), (F.col("page_width") * GUTTER_TO).cast("int")
    body = body.select(*PAGE, "left", (F.col("left") + F.col("width")).alias("right_edge"), first.alias("first"), last.alias("last"))
    on_grid = lambda steps: F.col("first") + steps.cast("int") * GUTTER_STEP
    before = F.greatest(F.col("first") - GUTTER_STEP, on_grid(F.floor((F.least("left", "last") - F.col("first")) / GUTTER_STEP)))
    after = F.greatest(F.col("first"), on_grid(F.ceil((F.least("right_edge", F.col("last") + GUTTER_STEP) - F.col("first")) / GUTTER_STEP)))
    rows = body.groupBy(*PAGE, "first", "last", before.alias("before"), after.alias("after")).agg(F.count(F.lit(1)).cast("int").alias("n"), F.max("right_edge").alias("edge"), F.min("left").alias("start"))
    zero, none, n = F.lit(0), F.lit(None).cast("int"), F.col("n")
    event = lambda x, n=zero, lefts=zero, edge=none, rights=zero, start=none, cross=zero: F.struct(x.alias("x"), n.alias("n"), lefts.alias("lefts"), edge.alias("edge"), rights.alias("rights"), start.alias("start"), cross.alias("cross"))
    begins = F.col("before") + GUTTER_STEP
    crossing = F.when(begins < F.col("after"), begins)
    events = F.array(
        event(F.col("first"), n=n), event(F.col("after"), lefts=n, edge=F.col("edge")), event(F.col("before"), rights=n, start=F.col("start")),
        event(crossing, cross=n), event(F.when(begins < F.col("after"), F.col("after")), cross=-n),
    )
    met = rows.select(*PAGE, "first", "last", F.explode(events).alias("e")).where("e.x BETWEEN first AND last").select(*PAGE, "e.*")
    grid = body.groupBy(*PAGE).agg(F.min("first").alias("first"), F.max("last").alias("last")).select(*PAGE, F.explode(F.sequence("first", "last", F.lit(GUTTER_STEP))).alias("x"))
    met = met.unionByName(grid, allowMissingColumns=True).groupBy(*PAGE, "x").agg(*[f(x).alias(x) for f, x in ((F.sum, "n"), (F.sum, "lefts"), (F.max, "edge"), (F.sum, "rights"), (F.min, "start"), (F.sum, "cross"))])
    page = W.partitionBy(*PAGE)
    up_to, from_on = page.orderBy("x").rowsBetween(W.unboundedPreceding, 0), page.orderBy("x").rowsBetween(0, W.unboundedFollowing)
    total = lambda x, over: F.coalesce(F.sum(x).over(over), F.lit(0))
    out = met.select(
        *PAGE, "x", total("n", page).alias("body_words"), total("cross", up_to).alias("crossing_words"), total("lefts", up_to).alias("left_words"), total("rights", from_on).alias("right_words"),
        (F.min("start").over(from_on) - F.max("edge").over(up_to)).alias("gap_px"),
    )
    out = out.where((F.col("body_words") >= LEAST_BODY) & (F.col("left_words") >= LEAST_SIDE) & (F.col("right_words") >= LEAST_SIDE))
    balance = F.least("left_words", "right_words") / F.greatest("left_words", "right_words")
    score = F.col("crossing_words") * CROSSING_COST - F.greatest(F.lit(0), F.col("gap_px")) * GAP_GAIN - F.col("balance") * BALANCE_GAIN
    return out.withColumn("balance", balance).withColumn("score", score.cast("double")).drop("body_words")


def best_gutter(candidates: DataFrame) -> DataFrame:
    """Per page the candidate of least score (of equals the leftmost), and whether it makes two columns plausible."""
    best = F.min(F.struct("score", "x", "crossing_words", "left_words", "right_words", "gap_px", "balance")).alias("g")
    out = candidates.groupBy(*PAGE).agg(best).select(*PAGE, "g.*")
    wide = ((F.col("balance") >= 0.35) & (F.col("gap_px") >= 35)) | ((F.col("balance") >= 0.18) & (F.col("gap_px") >= 120))
    return out.withColumn("two_columns", (F.col("crossing_words") <= 1) & wide)


def column_regions(words: DataFrame, gutters: DataFrame) -> DataFrame:
    """Body words of pages with two plausible columns become left, right or spanning."""
    plausible = gutters.where("two_columns").select(*PAGE, F.col("x").alias("gutter_x"))
    out = words.join(plausible, PAGE, "left")
    column = F.when(F.col("left") + F.col("width") <= F.col("gutter_x"), "left").when(F.col("left") >= F.col("gutter_x"), "right").otherwise("spanning")
    return out.withColumn("region", F.when((F.col("region") == "body") & F.col("gutter_x").isNotNull(), column).otherwise(F.col("region")))


def lines(words: DataFrame) -> DataFrame:
    """Words of a region with one (block, paragraph, line) make a line: text by left edge, box, number of words, mean confidence; line_index
    numbers a region's lines from 0 by top, then left edge, then key."""
    key = ["block_num", "par_num", "line_num"]
    said = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("left", "word_num", "text"))), lambda w: w["text"]), " ")
    out = words.groupBy(*PAGE, "region", *key).agg(
        said.alias("text"),
        F.min("left").alias("x0"), F.min("top").alias("y0"),
        F.max(F.col("left") + F.col("width")).alias("x1"), F.max(F.col("top") + F.col("height")).alias("y1"),
        F.count(F.lit(1)).alias("word_count"), F.avg("confidence").alias("mean_confidence"),
    )
    order = W.partitionBy(*PAGE, "region").orderBy("y0", "x0", *key)
    return out.withColumn("line_index", F.row_number().over(order) - 1)


def page_layout(words: DataFrame, gutters: DataFrame) -> DataFrame:
    """Per page: layout type, status, words by region, and the text of all lines in the order header, columns or body, spanning, footer."""
    placed = column_regions(words, gutters)
    rank = F.element_at(F.create_map(*[F.lit(x) for pair in REGION_RANK.items() for x in pair]), F.col("region"))
    texts = F.transform(F.filter(F.array_sort(F.collect_list(F.struct(rank.alias("r"), "line_index", "text"))), lambda x: F.trim(x["text"]) != ""), lambda x: x["text"])
    sums = [F.coalesce(F.sum(F.when(F.col("region") == r, F.col("word_count"))), F.lit(0)).alias(f"{r}_words") for r in REGION_RANK]
    out = lines(placed).groupBy(*PAGE).agg(F.array_join(texts, "\n").alias("candidate_text"), F.count(F.lit(1)).alias("n_lines"), *sums)
    two = F.coalesce(F.col("two_columns"), F.lit(False))
    out = out.join(gutters.select(*PAGE, "two_columns"), PAGE, "left")
    layout = F.when(two, "possible_two_columns").otherwise("single_flow_or_noncolumn")
    return out.withColumns({"layout_type": layout, "status": F.when(two, "REVIEW_REQUIRED").otherwise("CANDIDATE_ONLY")}).drop("two_columns")


def native_column_signal(lines: DataFrame) -> DataFrame:
    """lines: source, page, page_width, text, x0, y0, x1, y1 -> per page the signal of several columns among lines of 4 characters at least:
    full-width lines (0.72 of the width) apart, three centres left of 0.46 and three right of 0.54; how far both sides overlap in height."""
    usable = (F.length(F.trim("text")) >= 4) & (F.col("page_width") > 0)
    ratio = F.greatest(F.lit(0.0), (F.col("x1") - F.col("x0")) / F.col("page_width"))
    center = (F.col("x0") + F.col("x1")) / 2
    full = usable & (ratio >= 0.72)
    left, right = (usable & ~full & side for side in (center < F.col("page_width") * 0.46, center > F.col("page_width") * 0.54))
    edge = lambda f, c, x: f(F.when(c, F.col(x)))
    out = lines.groupBy(*PAGE).agg(
        F.count(F.when(left, 1)).alias("left_lines"), F.count(F.when(right, 1)).alias("right_lines"), F.count(F.when(full, 1)).alias("full_width_lines"),
        edge(F.min, left, "y0").alias("ly0"), edge(F.max, left, "y1").alias("ly1"), edge(F.min, right, "y0").alias("ry0"), edge(F.max, right, "y1").alias("ry1"),
    )
    possible = (F.col("left_lines") >= 3) & (F.col("right_lines") >= 3)
    overlap = F.greatest(F.lit(0), F.least("ly1", "ry1") - F.greatest("ly0", "ry0")) / F.greatest(F.lit(1), F.least(F.col("ly1") - F.col("ly0"), F.col("ry1") - F.col("ry0")))
    out = out.withColumn("possible_multicolumn", possible).withColumn("vertical_overlap_ratio", F.when(possible, overlap).otherwise(0.0))
    return out.withColumn("status", F.when(possible, "review_required").otherwise("native_geometry_preserved")).drop("ly0", "ly1", "ry0", "ry1")
