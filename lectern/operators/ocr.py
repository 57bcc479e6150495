"""Words of scanned pages: confidence, review reasons, lexicon and spelling proposals.

Words have: source, page, block_num, par_num, line_num, word_num, left, top, width, height, text, confidence (null if unknown)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as t

# Fixed values of the review rules.
LOW, MIDDLE, HIGH = 50.0, 70.0, 85.0
DENSE_COUNT, DENSE_RATIO, LONGEST_TOKEN = 3, 0.05, 120
# Tokens beyond this length meet by pieces, not by rests, whose number grows with the square of the length.
LONG_TOKEN = 12
LEXICON_CONFIDENCE, LEXICON_OCCURRENCES, LEAST_SUSPECT, SHORT_TOKEN, PROPOSALS = 92.0, 2, 4, 7, 5
PAGE = ["source", "page"]
READING_ORDER = ["block_num", "par_num", "line_num", "word_num"]


def confidence_columns(confidence: Column) -> list[Column]:
    return [
        F.count(confidence).alias("n_words"),
        F.avg(confidence).alias("mean_confidence"),
        *[F.count(F.when(confidence < x, 1)).alias(f"below_{x:.0f}") for x in (LOW, MIDDLE, HIGH)],
    ]


def confidence_summary(words: DataFrame, keys: list[str] = PAGE) -> DataFrame:
    """Per page: number of words with a confidence, its mean (null if none), and how many are below 50, 70 and 85."""
    return words.groupBy(*keys).agg(*confidence_columns(F.col("confidence")))


def semantic_confidence_summary(words: DataFrame, keys: list[str] = PAGE) -> DataFrame:
    """The same for word-like tokens only, with ratios (null if there are none). Pages without such tokens are kept, with counts of 0."""
    kept = F.when(t.is_word_like(t.token(F.col("text"))), F.col("confidence"))
    out = words.groupBy(*keys).agg(*confidence_columns(kept))
    return out.withColumns({f"{x}_ratio": F.try_divide(F.col(x), F.col("n_words")) for x in ("below_50", "below_85")})


def reasons(*pairs: tuple[Column, str]) -> Column:
    """The names whose conditions hold, in order."""
    return F.array_compact(F.array(*[F.when(c, F.lit(n)) for c, n in pairs]))


def _all_pages(sums: DataFrame, keys: list[str], pages: DataFrame | None) -> DataFrame:
    """sums with a row of zeros for pages of the list that have no words."""
    if pages is None:
        return sums
    zeros = [x for x, kind in sums.dtypes if kind in ("bigint", "int") and x not in keys and x != "longest"]
    return pages.select(*keys).distinct().join(sums, keys, "left").fillna(0, zeros)


def page_review_first_pass(words: DataFrame, keys: list[str] = PAGE, warnings: Column | None = None, pages: DataFrame | None = None) -> DataFrame:
    """Why a page needs review by plain confidence. pages: all pages there are, so that those without words are told; else only pages with words
    have a row."""
    warned = F.lit(0) if warnings is None else F.max(warnings.cast("int"))
    out = words.groupBy(*keys).agg(*confidence_columns(F.col("confidence")), F.count(F.lit(1)).alias("tokens"), F.max(F.length("text")).alias("longest"), warned.alias("warned"))
    out = _all_pages(out, keys, pages)
    why = reasons(
        (F.col("warned") > 0, "ocr_parse_warning"),
        (F.col("tokens") == 0, "no_ocr_words"),
        (F.col("mean_confidence") < HIGH, "mean_ocr_confidence_below_85"),
        (F.col("below_50") > 0, "contains_ocr_word_below_50"),
        (F.col("longest") > LONGEST_TOKEN, "suspiciously_long_ocr_token"),
    )
    return out.withColumn("reasons", why)


def page_review_refined(words: DataFrame, keys: list[str] = PAGE, warnings: Column | None = None, pages: DataFrame | None = None) -> DataFrame:
    """Why a whole page needs review by its word-like tokens: single doubtful words stay local, dense ones do not. pages: as for the first pass."""
    kept = F.when(t.is_word_like(t.token(F.col("text"))), F.col("confidence"))
    warned = F.lit(0) if warnings is None else F.max(warnings.cast("int"))
    out = words.groupBy(*keys).agg(*confidence_columns(kept), F.count(F.lit(1)).alias("tokens"), F.max(F.length("text")).alias("longest"), warned.alias("warned"))
    out = _all_pages(out, keys, pages)
    dense = F.greatest(F.lit(DENSE_COUNT), F.ceil(F.col("n_words") * DENSE_RATIO))
    why = reasons(
        (F.col("warned") > 0, "ocr_parse_warning"),
        (F.col("tokens") == 0, "no_ocr_words"),
        ((F.col("tokens") > 0) & (F.col("n_words") == 0), "no_semantic_ocr_words"),
        (F.col("mean_confidence") < HIGH, "semantic_mean_ocr_confidence_below_85"),
        ((F.col("n_words") > 0) & (F.col("below_50") >= dense), "dense_semantic_ocr_words_below_50"),
        (F.col("longest") > LONGEST_TOKEN, "suspiciously_long_ocr_token"),
    )
    return out.withColumn("reasons", why)


def translation_gate(words: DataFrame, keys: list[str] = PAGE) -> DataFrame:
    """BLOCKED_OCR_REVIEW if any word-like token is below 85, else SOURCE_TEXT_READY."""
    doubtful = t.is_word_like(t.token(F.col("text"))) & (F.col("confidence") < HIGH)
    out = words.groupBy(*keys).agg(F.count(F.when(doubtful, 1)).alias("doubtful_words"))
    return out.withColumn("gate", F.when(F.col("doubtful_words") > 0, "BLOCKED_OCR_REVIEW").otherwise("SOURCE_TEXT_READY"))


def page_text(words: DataFrame) -> DataFrame:
    """Text of each page: words of a line in order, lines in order, an empty line wherever block or paragraph changes."""
    line = ["block_num", "par_num", "line_num"]
    said = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("word_num", "text"))), lambda w: w["text"]), " ")
    lines = words.groupBy(*PAGE, *line).agg(said.alias("said"))
    ordered = F.array_sort(F.collect_list(F.struct(*line, "said")))
    pages = lines.groupBy(*PAGE).agg(ordered.alias("lines"))
    block = lambda x: F.struct(x["block_num"], x["par_num"])
    gap = lambda x, i: F.when((i > 0) & (block(x) != block(F.try_element_at("lines", i))), F.concat(F.lit("\n"), x["said"])).otherwise(x["said"])
    return pages.select(*PAGE, F.array_join(F.transform("lines", gap), "\n").alias("page_text"))


def lexicon(words: DataFrame, least: float = LEXICON_CONFIDENCE, occurrences: int = LEXICON_OCCURRENCES) -> DataFrame:
    """Tokens that a source uses confidently at least twice: canonical form (the commonest, of equals the first met), occurrences and mean
    confidence. The first aggregation is by written form, so no token's occurrences are put together as rows."""
    seen = F.struct("page", *READING_ORDER)
    kept = words.where(F.col("confidence") >= least).withColumn("token", t.token(F.col("text"))).where(t.is_word_like(F.col("token")))
    forms = kept.groupBy("source", "token", "text").agg(F.count(F.lit(1)).alias("n"), F.sum("confidence").alias("total"), F.min(seen).alias("first"))
    best = F.min(F.struct((-F.col("n")).alias("n"), F.col("first"), F.col("text")))
    out = forms.groupBy("source", "token").agg(F.sum("n").alias("occurrences"), F.sum("total").alias("total"), best.alias("best"))
    return out.where(F.col("occurrences") >= occurrences).select("source", "token", F.col("best.text").alias("canonical"), "occurrences", (F.col("total") / F.col("occurrences")).alias("mean_confidence"))


def _with_gaps(token: Column, most: Column) -> Column:
    """The token and what is left of it without one, and if most is 2 without two, of its letters after the first."""
    def one(s: Column) -> Column:
        cut = lambda i: F.concat(F.substr(s, F.lit(1), i - 1), F.substr(s, i + 1))
        return F.when(F.length(s) >= 2, F.transform(F.sequence(F.lit(2), F.length(s)), cut)).otherwise(F.array().cast("array<string>"))

    once = one(token)
    twice = F.when(most >= 2, F.flatten(F.transform(once, one))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(F.array(token), once, twice))


def spelling_matches(words: DataFrame, lex: DataFrame, suspect: float = HIGH) -> DataFrame:
    """Distinct doubtful tokens of a source that its lexicon lacks, with all lexicon tokens of the same first letter within the edit distance
    allowed (1 up to 7 letters, else 2).

    Two words within distance d have a common rest after at most d deletions each: the join is on that rest, so no block of tokens with one
    first letter is compared all against all. Of a long token cut into three pieces one at least stands in any word within distance 2, at most
    2 places off: there the join is on pieces."""
    doubtful = words.where(F.col("confidence") < suspect).select("source", t.token(F.col("text")).alias("token"))
    doubtful = doubtful.where((F.length("token") >= LEAST_SUSPECT) & t.is_word_like(F.col("token"))).distinct()
    doubtful = doubtful.join(lex.select("source", "token"), ["source", "token"], "left_anti").withColumn("allowed", F.when(F.length("token") <= SHORT_TOKEN, 1).otherwise(2))
    length = F.length("token")
    left = doubtful.where(length <= LONG_TOKEN).withColumn("rest", F.explode(_with_gaps(F.col("token"), F.col("allowed"))))
    # a lexicon token meets tokens of up to two letters less, which allow two gaps only beyond the short ones
    gaps = F.when(F.length("token") <= SHORT_TOKEN - 2, 1).otherwise(2)
    right = lex.where(length <= LONG_TOKEN + 2).withColumn("rest", F.explode(_with_gaps(F.col("token"), gaps))).withColumnRenamed("token", "known")
    near = left.join(right, ["source", "rest"]).drop("rest")
    third = F.col("whole").cast("int") / 3
    begins, size = 1 + F.col("k") * F.floor(third), F.when(F.col("k") < 2, F.floor(third)).otherwise(F.col("whole") - 2 * F.floor(third))
    parts = doubtful.where(length > LONG_TOKEN).withColumn("whole", length).withColumn("k", F.explode(F.array(*map(F.lit, range(3)))))
    parts = parts.withColumn("piece", F.substr("token", begins.cast("int"), size.cast("int")))
    known = lex.withColumnRenamed("token", "known").where(F.length("known") > LONG_TOKEN - 2).withColumn("whole", F.explode(F.sequence(F.length("known") - 2, F.length("known") + 2))).where(F.col("whole") > LONG_TOKEN)
    known = known.withColumn("k", F.explode(F.array(*map(F.lit, range(3))))).withColumn("shift", F.explode(F.sequence(F.lit(-2), F.lit(2)))).withColumn("at", F.col("shift") + begins).where((F.col("at") >= 1) & (F.col("at") + size - 1 <= F.length("known")))
    known = known.withColumn("piece", F.substr("known", F.col("at").cast("int"), size.cast("int"))).drop("at", "shift")
    far = parts.join(known, ["source", "whole", "k", "piece"]).drop("whole", "k", "piece")
    near = near.unionByName(far).distinct().withColumn("distance", F.levenshtein("token", "known", 2))  # -1 beyond 2
    return near.where(F.col("distance").between(0, F.col("allowed")) & (F.substring("token", 1, 1) == F.substring("known", 1, 1)))


def spelling_candidates(words: DataFrame, lex: DataFrame, suspect: float = HIGH) -> DataFrame:
    """For each doubtful word its proposals: the best matches by distance, occurrences and mean confidence; ties are all kept for review, at
    most five of them shown. Nothing is applied."""
    near = spelling_matches(words, lex, suspect)
    order = W.partitionBy("source", "token").orderBy("distance", F.desc("occurrences"), F.desc("mean_confidence"))
    best = near.withColumn("place", F.rank().over(order)).where("place = 1")
    proposals = F.slice(F.array_sort(F.collect_list(F.struct("known", "canonical", F.col("distance").alias("edit_distance"), "occurrences", "mean_confidence"))), 1, PROPOSALS)
    best = best.groupBy("source", "token").agg(F.count(F.lit(1)).alias("ties"), proposals.alias("proposals"))
    status = F.when(F.col("ties") == 1, "STRONG_CANDIDATE_REVIEW_REQUIRED").otherwise("REVIEW_REQUIRED")
    found = words.where(F.col("confidence") < suspect).withColumn("token", t.token(F.col("text"))).join(best, ["source", "token"])
    box = F.array("left", "top", F.col("left") + F.col("width"), F.col("top") + F.col("height"))
    return found.select("source", "page", *READING_ORDER, F.col("text").alias("original"), "confidence", "token", box.alias("bbox"), status.alias("status"), "ties", "proposals", F.lit(False).alias("applied"))
