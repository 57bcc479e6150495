"""Quality classifier: cumulative-link regression on graded ratings over hashed text."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common as c

#: Hash buckets, rated documents used for fitting at most, and the least chi-square and number of documents of a bucket that gets a weight.
BUCKETS = 1 << 20
SAMPLE = 6000
CHI_SQUARE = 12.0
LEAST_DOCS = 4
#: Grades: 0 toxic, 1 poor, 2 good. A document is kept if its grade is 2 with this probability at least.
GRADES = 3
KEEP = 0.5

_WORD_LETTER = c.WORD
_MARK = ~c.WORD & ~c.SPACE & ~np.isin(np.arange(256), [0x2E, 0x2C, 0x27])
_UPPER = (np.arange(256) >= 0x41) & (np.arange(256) <= 0x5A)


def features(texts: pa.Array, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, bucket) of each text: lower-cased words, runs of marks, and shares (in eighths, if any) of words that repeat the
    one before and of capital letters. wanted: flags of buckets; others are left out."""
    data, offsets = c.utf8(texts)
    n = len(texts)
    starts, ends, bounds = c.words(data, offsets)
    hashes = c.span_hash(data, starts, ends, lower=True)
    marks = c.runs(_MARK, data, offsets)
    mark_hashes = c.span_hash(data, *marks[:2]) ^ np.uint64(1)
    counts = np.maximum(np.diff(bounds), 1)
    docs = np.repeat(np.arange(n), np.diff(bounds))
    same = (hashes[1:] == hashes[:-1]) & (docs[1:] == docs[:-1])
    repeated = np.bincount(docs[1:][same], minlength=n) / counts
    big = np.concatenate([[0], np.cumsum(_UPPER[data])])
    capital = np.diff(big[offsets]) / np.maximum(np.diff(offsets), 1)
    shape = []
    for k, share in enumerate((repeated, capital)):
        level = np.ceil(share * 8).astype(np.uint64) * (share > 0.05)
        shape.append(c.mix(level + np.uint64(1000 * (k + 1))))
    bucket = np.concatenate([hashes, mark_hashes, *shape]) & np.uint64(BUCKETS - 1)
    doc = np.concatenate([docs, np.repeat(np.arange(n), np.diff(marks[2])), np.arange(n), np.arange(n)])
    if wanted is not None:
        found = wanted[bucket]
        bucket, doc = bucket[found], doc[found]
    pairs = np.unique(doc.astype(np.uint64) * np.uint64(BUCKETS) + bucket)
    return (pairs // np.uint64(BUCKETS)).astype(np.int64), (pairs % np.uint64(BUCKETS)).astype(np.int64)


@dataclass
class CumulativeLink:
    """P(grade <= j) = logistic(cuts[j] - weights . x), one set of weights for all cuts."""

    buckets: np.ndarray
    weights: np.ndarray
    cuts: np.ndarray

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade > j) for each j; a row for each score."""
        return _logistic(scores[:, None] - self.cuts[None, :])


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def fit(doc: np.ndarray, bucket: np.ndarray, grades: np.ndarray, steps: int = 400, l2: float = 0.3) -> CumulativeLink:
    """Screen buckets by chi-square at each cut, then fit weights and ordered cuts by gradient steps with moments (Adam).

    A grade that nobody has gives a cut at the end of the range; without ratings every document gets the best grade."""
    n, levels = len(grades), GRADES - 1
    if not n:
        return CumulativeLink(np.zeros(0, np.int64), np.zeros(0), np.full(levels, -10.0))
    have = np.bincount(bucket, minlength=BUCKETS)
    best = np.zeros(BUCKETS)
    for j in range(levels):
        low = grades <= j
        share = low.mean()
        if 0 < share < 1:
            got = np.bincount(bucket, weights=low[doc], minlength=BUCKETS)
            expected = have * share
            spread = expected * (1 - share) * np.maximum(1 - have / n, 1 / n)
            best = np.maximum(best, np.where(have >= LEAST_DOCS, (got - expected) ** 2 / np.maximum(spread, 1e-12), 0))
    chosen = np.flatnonzero((best >= CHI_SQUARE) & (have < n))
    column = np.full(BUCKETS, -1)
    column[chosen] = np.arange(len(chosen))
    used = column[bucket] >= 0
    rows, cols = doc[used], column[bucket[used]]
    w, cuts = np.zeros(len(chosen)), np.array([-2.0 + j for j in range(levels)])
    moments = [np.zeros(len(w) + levels), np.zeros(len(w) + levels)]
    for step in range(1, steps + 1):
        scores = np.bincount(rows, weights=w[cols], minlength=n)
        above = np.concatenate([np.ones((n, 1)), _logistic(scores[:, None] - cuts), np.zeros((n, 1))], 1)  # P(grade >= j)
        chance = np.maximum(above[np.arange(n), grades] - above[np.arange(n), grades + 1], 1e-9)
        slope = above * (1 - above)
        up, down = slope[np.arange(n), grades] / chance, slope[np.arange(n), grades + 1] / chance
        by_score = up - down
        grad_w = np.bincount(cols, weights=by_score[rows], minlength=len(w)) - l2 * w
        grad_cut = np.array([(np.where(grades == j, down, 0) - np.where(grades == j + 1, up, 0)).sum() for j in range(levels)])
        grad = np.concatenate([grad_w, grad_cut])
        moments[0] = 0.9 * moments[0] + 0.1 * grad
        moments[1] = 0.99 * moments[1] + 0.01 * grad**2
        move = 0.05 * (moments[0] / (1 - 0.9**step)) / (np.sqrt(moments[1] / (1 - 0.99**step)) + 1e-8)
        w += move[: len(w)]
        cuts = np.clip(cuts + move[len(w) :], -10, 10)
        cuts = np.maximum.accumulate(cuts + np.arange(levels) * 1e-6)
    return CumulativeLink(chosen, w, cuts)


def grade(quality: str = "quality", toxic: str = "toxic") -> F.Column:
    """0 toxic, 1 poor, 2 good; null where a rating is missing that decides."""
    return F.when(F.col(toxic) == 1, 0).when(F.col(toxic).isNull() | F.col(quality).isNull(), None).when(F.col(quality) == 0, 1).otherwise(2)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> CumulativeLink:
    """Fit on at most `sample` rated documents, the first in the order of a hash of the id; their whole texts are used.

    Ratings with a null id or grade are left out; of several ratings of one document the lowest counts, and of several texts with one id the
    one of the least digest. The sample, by its bound, is broadcast to find the texts, and only distinct buckets of each sampled text come to
    the driver, in the order of their ids."""
    c.small_batches(docs.sparkSession)
    rated = labels.select(F.col(id_col).alias("__id"), grade().alias("__grade")).where("__id IS NOT NULL AND __grade IS NOT NULL")
    rated = rated.groupBy("__id").agg(F.min("__grade").alias("__grade"))
    rated = rated.orderBy(F.xxhash64("__id"), "__id").limit(sample)
    found = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).join(F.broadcast(rated), "__id")
    one = F.min(F.struct(F.md5(F.coalesce("__text", F.lit(""))).alias("digest"), F.col("__text").alias("text"), F.col("__grade").alias("grade")))
    found = found.groupBy("__id").agg(one.alias("one")).select("__id", F.col("one.text").alias("__text"), F.col("one.grade").alias("__grade"))

    def run(batches):
        for b in batches:
            texts, grades = b.column(b.schema.get_field_index("__text")), b.column(b.schema.get_field_index("__grade"))
            for i, j in c.pieces(texts):
                doc, bucket = features(texts.slice(i, j - i))
                bounds = np.searchsorted(doc, np.arange(j - i + 1))
                flat = bucket.astype("<i4")
                rows = [flat[bounds[k] : bounds[k + 1]].tobytes() for k in range(j - i)]
                yield pa.RecordBatch.from_arrays([grades.slice(i, j - i), pa.array(rows, pa.binary())], names=["grade", "buckets"])

    grades, buckets = [], []
    for r in found.repartitionByRange("__id").sortWithinPartitions("__id").mapInArrow(run, "grade int, buckets binary").toLocalIterator():
        grades.append(r["grade"])
        buckets.append(np.frombuffer(r["buckets"], "<i4"))
    doc = np.repeat(np.arange(len(grades)), [len(b) for b in buckets]) if grades else np.zeros(0, np.int64)
    return fit(doc, np.concatenate(buckets).astype(np.int64) if grades else np.zeros(0, np.int64), np.array(grades, np.int64))


def classify(docs: DataFrame, model: CumulativeLink, text_col: str = "text", keep_at: float = KEEP) -> DataFrame:
    """Append expected_grade (0 to 2), p_good (the chance of grade 2), p_toxic (of grade 0) and keep to every row.

    Null and empty texts have no words and are judged by the cuts alone. Repeated rows are judged alike; empty tables give no rows; input
    columns of these names are replaced."""
    shared = docs.sparkSession.sparkContext.broadcast((model.buckets, model.weights, model.cuts))
    ready: list[np.ndarray] = []

    def make(texts: pa.Array) -> list[pa.Array]:
        buckets, weights, cuts = shared.value
        if not ready:
            ready.extend([np.zeros(BUCKETS, bool), np.zeros(BUCKETS)])
            ready[0][buckets], ready[1][buckets] = True, weights
        wanted, value = ready
        doc, bucket = features(texts, wanted)
        scores = np.bincount(doc, weights=value[bucket], minlength=len(texts))
        tails = CumulativeLink(buckets, weights, cuts).tails(scores)
        return [pa.array(tails.sum(1)), pa.array(tails[:, -1]), pa.array(1 - tails[:, 0]), pa.array(tails[:, -1] >= keep_at)]

    added = [("expected_grade", T.DoubleType()), ("p_good", T.DoubleType()), ("p_toxic", T.DoubleType()), ("keep", T.BooleanType())]
    return c.mapped(docs, added, make, text_col)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grades of every document, by a model fitted on a bounded sample of the rated ones."""
    docs = c.table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, c.table(spark, sf_dir, "labels"))
    return classify(docs, model).drop("text")
