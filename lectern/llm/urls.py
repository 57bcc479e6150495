"""URL filter: rules first, then the likelihood ratio of two character Markov models, for rejected and for accepted URLs. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import common as c

#: (host and path, verdict); a host stands for its subdomains too, and the longest rule that fits wins.
RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]
#: Words of host names by which URLs are taken as rejected examples; all others are presumed to be accepted ones.
SEEDS = ["adserver", "ads", "bet", "bets", "casino", "clickbait", "jackpot", "loan", "loans", "phishing", "pills", "poker", "porn", "slots", "spam", "viagra", "warez", "xxx"]
#: Parts into which hosts are dealt, so that a URL's score is of models that have seen no URL of its host; and rejected URLs that weigh as much
#: as one accepted one that is blocked with them, when the threshold is sought.
FOLDS = 4
COST = 4
#: Rows of the table of ratios up to which it is broadcast (some 10 MB); a larger one is joined by key.
BROADCAST_ROWS = 200_000
#: Characters of a model's n-grams at most, and the alphabet: digits are one letter, and all that is not named here is another.
ORDER = 4
ALPHABET = "abcdefghijklmnopqrstuvwxyz0./_%=&~+-*^$"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty for null or without ://."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, null if none does."""
    rule = verdict = None
    for text, what in sorted(rules, key=lambda r: (-len(r[0]), r[0])):
        own_host, slash, own_path = text.partition("/")
        fits = ((host == own_host) | host.endswith(f".{own_host}")) & path.startswith(slash + own_path)
        rule = F.when(fits, F.lit(text)) if rule is None else rule.when(fits, F.lit(text))
        verdict = F.when(fits, F.lit(what)) if verdict is None else verdict.when(fits, F.lit(what))
    none = F.lit(None).cast("string")
    return (none, none) if rule is None else (rule, verdict)


def seed_pattern(seeds: list[str]) -> str:
    return r"(^|[.\-])(" + "|".join(seeds) + r")([.\-]|$)"


def letters(text: Column) -> Column:
    """In the model's alphabet."""
    return F.regexp_replace(F.regexp_replace(F.translate(text, _UPPER, _LOWER), "[0-9]", "0"), r"[^a-z0./_%=&~+\-]", "*")


def fold_of(host: Column) -> Column:
    return (F.instr(F.lit("0123456789abcdef"), F.substring(F.md5(host), 1, 1)) - 1) % FOLDS


def _grams(strings: DataFrame) -> DataFrame:
    """__s and other columns -> one row for each position, with its n-gram."""
    at = F.explode(F.sequence(F.lit(ORDER), F.length("__s")))
    return strings.select("*", at.alias("__i")).withColumn("gram", F.expr(f"substring(__s, __i - {ORDER - 1}, {ORDER})")).drop("__i")


def ratios(strings: DataFrame) -> DataFrame:
    """strings: __s, fold, accepted, rejected (numbers of URLs). Returns view, gram, n (how often the n-gram occurs) and ratio: the log of its
    last letter's chance after the others with rejected URLs, less that with accepted ones. View k is of the URLs outside of fold k, view FOLDS
    of all.

    Chances of orders 0 to ORDER - 1 are mixed by Witten and Bell's rule: the more different letters have followed a context, the more
    weight the next shorter one gets; a context never seen gives it all. There are at most (FOLDS + 1) * len(ALPHABET) ** ORDER rows, however
    many URLs."""
    size = len(ALPHABET)
    counts = _grams(strings).groupBy("gram", "fold").agg(F.sum("accepted").alias("a"), F.sum("rejected").alias("r"))
    views = counts.select("gram", "fold", "a", "r", F.explode(F.sequence(F.lit(0), F.lit(FOLDS))).alias("view"))
    seen = F.col("view") != F.col("fold")
    views = views.groupBy("view", "gram").agg(*[F.sum(F.when(seen, F.col(x)).otherwise(0)).alias(x) for x in "ar"], F.sum(F.col("a") + F.col("r")).alias("n"))
    counts = c.stash(views, "urls-grams")
    below = None
    for k in range(1, ORDER + 1):
        gram = F.substring("gram", ORDER - k + 1, k)
        own = counts.groupBy("view", gram.alias("g")).agg(F.sum("a").alias("a"), F.sum("r").alias("r"), F.sum("n").alias("n"))
        if k == 1:
            all_of = W.partitionBy("view")
            below = own.select("view", "g", *[((F.col(x) + 1.0) / (F.sum(x).over(all_of) + size)).alias(f"p{x}") for x in "ar"])
            continue
        context = W.partitionBy("view", F.substring("g", 1, k - 1))
        own = own.select("view", "g", "a", "r", "n", *[F.sum(x).over(context).alias(f"n{x}") for x in "ar"], *[F.sum(F.when(F.col(x) > 0, 1).otherwise(0)).over(context).alias(f"t{x}") for x in "ar"])
        own = own.join(below.select(F.col("view").alias("v"), F.col("g").alias("h"), F.col("pa").alias("qa"), F.col("pr").alias("qr")), (F.col("view") == F.col("v")) & (F.substring("g", 2, k - 1) == F.col("h")))
        mixed = [F.when(F.col(f"n{x}") > 0, (F.col(x) + F.col(f"t{x}") * F.col(f"q{x}")) / (F.col(f"n{x}") + F.col(f"t{x}"))).otherwise(F.col(f"q{x}")).alias(f"p{x}") for x in "ar"]
        below = own.select("view", "g", "n", *mixed)
    out = c.stash(below.select("view", F.col("g").alias("gram"), "n", (F.log("pr") - F.log("pa")).alias("ratio")), "urls-ratios")
    c.discard(counts)
    return out


def judge(pages: DataFrame, url_col: str = "url", rules: list[tuple[str, str]] = RULES, seeds: list[str] = SEEDS) -> DataFrame:
    """Append host, path, rule, verdict and score (the mean log ratio of a letter) to every row of pages.

    The verdict is the rule's, else block if the score is at the threshold or over it. Hosts are dealt to folds by a hash. A URL without a seed word is
    only presumed to be accepted, so it is scored by models that have seen no URL of its fold: what looks like rejected hosts is blocked whether
    or not the list names it. One with a seed word is known, and its score is that of models of all URLs. The threshold is taken from scores
    outside of the own fold for both, where a histogram of fixed size (hundredths from -8 to 8) separates best: most rejected URLs over it less
    COST times the accepted ones, as shares, the highest such. Without rejected or without accepted examples nothing is blocked but by rules.
    Null URLs and those without :// have an empty host and path: there is nothing to block them for. Repeated URLs are judged alike; an empty table
    gives no rows; input columns of these names are replaced."""
    added = ["host", "path", "rule", "verdict", "score"]
    base = pages.select(*[F.col(f"`{n}`") for n in pages.columns if n.lower() not in added or n == url_col])
    url = F.col(f"`{url_col}`").cast("string")
    base = base.withColumns({"__host": host_of(url), "__path": path_of(url)})
    rule, fixed = rule_for(F.col("__host"), F.col("__path"), rules)
    base = base.withColumns({"__rule": rule, "__fixed": fixed, "__h": letters(F.col("__host"))})
    base = base.withColumn("__s", F.concat(F.lit("^" * (ORDER - 1)), "__h", letters(F.col("__path")), F.lit("$")))  # a path begins with /, which no host has: __s tells __h
    seeded = F.col("__h").rlike(seed_pattern(seeds)) if seeds else F.lit(False)
    strings = base.groupBy("__s").agg(F.min(fold_of(F.col("__h"))).cast("int").alias("fold"), F.max(seeded).alias("seeded"), F.count(F.lit(1)).alias("n"))
    strings = strings.select("*", F.when(F.col("seeded"), 0).otherwise(F.col("n")).alias("accepted"), F.when(F.col("seeded"), F.col("n")).otherwise(0).alias("rejected"))
    strings = c.stash(strings, "urls-strings")
    model = ratios(strings)
    views = F.explode(F.when(F.col("seeded"), F.array("fold", F.lit(FOLDS))).otherwise(F.array("fold")))
    grams, rows = _grams(strings.select("__s", views.alias("view"))), model.count()
    if rows <= BROADCAST_ROWS:
        met = grams.join(F.broadcast(model), ["view", "gram"])
    else:
        met = c.spread_join(grams, model, ["view", "gram"], model.select("view", "gram", "n"), model.agg(F.sum("n")).first()[0] or 0)
    scored = c.stash(met.groupBy("__s", "view").agg(F.avg("ratio").alias("score")).join(strings.drop("n"), "__s"), "urls-scored")
    bins = F.floor(F.greatest(F.lit(-8.0), F.least(F.lit(8.0), F.col("score"))) * 100)
    histogram = scored.where("view = fold").groupBy(bins.alias("bin")).agg(F.sum("accepted").alias("a"), F.sum("rejected").alias("r")).orderBy("bin").collect()
    limit = threshold([(x["bin"], x["a"], x["r"]) for x in histogram])
    final = scored.where(F.col("view") == F.when(F.col("seeded"), FOLDS).otherwise(F.col("fold"))).select("__s", F.col("score").alias("__score"))
    out = c.spread_join(base, final, ["__s"], strings.select("__s", "n"), strings.agg(F.sum("n")).first()[0] or 0)
    blocked = (F.col("__host") != "") & (F.col("__score") >= limit) if limit is not None else F.lit(False)
    verdict = F.coalesce("__fixed", F.when(blocked, "block").otherwise("allow"))
    kept = [F.col(f"`{n}`") for n in base.columns if not n.startswith("__") and n.lower() not in added]
    out = out.select(*kept, F.col("__host").alias("host"), F.col("__path").alias("path"), F.col("__rule").alias("rule"), verdict.alias("verdict"), F.col("__score").alias("score"))
    c.discard(model)
    return out


def threshold(histogram: list[tuple[int, int, int]]) -> float | None:
    """histogram: (bin of a hundredth, accepted, rejected), by bin. The lower edge of the best bin; None if one kind is missing."""
    accepted, rejected = sum(x[1] for x in histogram), sum(x[2] for x in histogram)
    if not accepted or not rejected:
        return None
    best, over_a, over_r = (0, None), 0, 0
    for at, a, r in reversed(histogram):
        over_a, over_r = over_a + a, over_r + r
        gain = over_r * accepted - COST * over_a * rejected
        if gain > best[0]:
            best = gain, at
    return None if best[1] is None else best[1] / 100


def op2_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's URL."""
    pages = c.table(spark, sf_dir, "pages").select("page_id", "url")
    return judge(pages).select("page_id", "host", "path", "rule", "verdict")


def _sql() -> str:
    k, size = ORDER, len(ALPHABET)
    fits = []
    for text, what in sorted(RULES, key=lambda r: (-len(r[0]), r[0])):
        host, slash, path = text.partition("/")
        fits.append((f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{slash + path}')", text, what))
    rule = "CASE " + " ".join(f"WHEN {f} THEN '{t}'" for f, t, _ in fits) + " END"
    fixed = "CASE " + " ".join(f"WHEN {f} THEN '{w}'" for f, _, w in fits) + " END"
    steps = [f"o1 AS (SELECT view, g, (a + 1.0::DOUBLE) / (sum(a) OVER (PARTITION BY view) + {size})::DOUBLE AS pa, (r + 1.0::DOUBLE) / (sum(r) OVER (PARTITION BY view) + {size})::DOUBLE AS pr FROM (SELECT view, substr(gram, {k}, 1) AS g, sum(a) AS a, sum(r) AS r FROM counts GROUP BY 1, 2))"]
    for n in range(2, k + 1):
        mixed = ", ".join(f"CASE WHEN n{x} > 0 THEN (c{x} + t{x} * o.p{x}) / (n{x} + t{x}) ELSE o.p{x} END AS p{x}" for x in "ar")
        windows = ", ".join(f"sum(c{x}) OVER (PARTITION BY view, substr(g, 1, {n - 1}))::DOUBLE AS n{x}, sum(CASE WHEN c{x} > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY view, substr(g, 1, {n - 1}))::DOUBLE AS t{x}" for x in "ar")
        steps.append(f"""o{n} AS (SELECT w.view, w.g, {mixed} FROM (SELECT view, g, ca, cr, {windows} FROM (SELECT view, substr(gram, {k - n + 1}, {n}) AS g, sum(a)::DOUBLE AS ca, sum(r)::DOUBLE AS cr FROM counts GROUP BY 1, 2)) w
  JOIN o{n - 1} o ON o.view = w.view AND o.g = substr(w.g, 2, {n - 1}))""")
    letters_of = lambda x: f"regexp_replace(regexp_replace(translate({x}, '{_UPPER}', '{_LOWER}'), '[0-9]', '0', 'g'), '[^a-z0./_%=&~+\\-]', '*', 'g')"
    return f"""
WITH u AS (SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), '{_UPPER}', '{_LOWER}') AS host,
                  coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
base AS (SELECT *, {rule} AS rule, {fixed} AS fixed, {letters_of("host")} AS h, '{"^" * (k - 1)}' || {letters_of("host || path")} || '$' AS s FROM u),
labelled AS (SELECT s, (instr('0123456789abcdef', substr(md5(h), 1, 1)) - 1) % {FOLDS} AS fold, regexp_matches(h, '{seed_pattern(SEEDS)}') AS seeded FROM base),
strings AS (SELECT s, fold, seeded, sum(CASE WHEN seeded THEN 0 ELSE 1 END) AS a, sum(CASE WHEN seeded THEN 1 ELSE 0 END) AS r FROM labelled GROUP BY s, fold, seeded),
grams AS (SELECT s, fold, seeded, a, r, substr(s, i - {k - 1}, {k}) AS gram FROM (SELECT *, unnest(range({k}, length(s) + 1)) AS i FROM strings)),
counts AS (SELECT view, gram, sum(CASE WHEN view <> fold THEN a ELSE 0 END) AS a, sum(CASE WHEN view <> fold THEN r ELSE 0 END) AS r FROM grams, (SELECT unnest(range({FOLDS + 1})) AS view) GROUP BY 1, 2),
{", ".join(steps)},
scored AS (SELECT s, fold, seeded, a, r, view, avg(ln(pr) - ln(pa)) AS score FROM grams JOIN o{k} ON g = gram GROUP BY ALL),
bins AS (SELECT floor(greatest(-8.0, least(8.0, score)) * 100) AS bin, sum(a) AS a, sum(r) AS r FROM scored WHERE view = fold GROUP BY 1),
gains AS (SELECT bin, sum(r) OVER (ORDER BY bin DESC) * (SELECT sum(a) FROM bins) - {COST} * sum(a) OVER (ORDER BY bin DESC) * (SELECT sum(r) FROM bins) AS gain FROM bins),
best AS (SELECT bin / 100 AS limit_at FROM gains WHERE gain > 0 ORDER BY gain DESC, bin DESC LIMIT 1)
SELECT page_id, host, path, rule, coalesce(fixed, CASE WHEN host <> '' AND score >= (SELECT limit_at FROM best) THEN 'block' ELSE 'allow' END) AS verdict
FROM base JOIN scored USING (s) WHERE view = CASE WHEN seeded THEN {FOLDS} ELSE fold END
"""


OP2_SQL = _sql()
