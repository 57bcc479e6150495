"""Vectorised byte work and Arrow mapping that the operators of this subpackage share."""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.shared import discard, stash  # noqa: F401
from ..sources.tables import table  # noqa: F401

#: Bytes of text that a Python worker handles at once; one longer document is handled alone. Bytes of a batch that goes to or from it.
PIECE, BATCH = 1 << 20, 4 << 20
#: Longest span hashed with the shared power table; longer ones get their own.
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def small_batches(spark: SparkSession) -> None:
    """Have rows go to Python in batches of BATCH bytes, of which both sides hold several. This holds for the session from now on, as plans
    are run after operators return; a smaller setting of the session's own stays."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    set_to = spark.conf.get(name, "64m").lower().removesuffix("b")
    size = int(float(set_to.rstrip("kmg")) * {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}.get(set_to[-1], 1))
    if not 0 < size <= BATCH:
        spark.conf.set(name, str(BATCH))


def frees_shuffles(make: Callable) -> Callable:
    """Have Spark delete the shuffle files of each query that make(rows, ...) runs when that query ends; else they stay until the driver happens
    to collect its garbage. The session's setting holds again for the plan that make returns."""

    @wraps(make)
    def run(rows: DataFrame, *args, **named) -> DataFrame:
        conf, name = rows.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
        before = conf.get(name, None)
        conf.set(name, "true")
        try:
            return make(rows, *args, **named)
        finally:
            conf.unset(name) if before is None else conf.set(name, before)

    return run


#: Bytes of a file of a held table, about, as they are kept in memory.
FILE_BYTES = 32 << 20


def hold(df: DataFrame) -> DataFrame:
    """Compute df and stash it in as few files as its bytes need, however many partitions it came in; release() it when done. The rows are kept
    in memory or on disk only until they are written. out._rows: their number."""
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    rows = kept.count()
    size = int(str(kept.select("*")._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    out = stash(kept.coalesce(size // FILE_BYTES + 1), "held")
    kept.unpersist()
    out._rows = rows
    return out


def release(*frames: DataFrame) -> None:
    discard(*frames)


#: Keys that can be hot at most: a key is if it has more than that part of all rows, and more than HOT_ROWS.
HOT_KEYS, HOT_ROWS = 1000, 200


def spread_join(left: DataFrame, right: DataFrame, on: list[str], counts: DataFrame, rows: int, how: str = "inner") -> DataFrame:
    """left.join(right, on, how) for keys that may have a large part of left's rows. counts: the columns `on` and n, how many rows of left have
    the key (keys of few rows may be missing); rows: how many rows left has in all.

    A key with more than rows / HOT_KEYS rows is dealt to as many tasks as it has that many; its rows of right go to each. There are fewer than
    HOT_KEYS such keys, whatever left is, so the list of them is broadcast."""
    limit = max(rows // HOT_KEYS, HOT_ROWS)
    hot = counts.where(F.col("n") > limit).select(*on, F.ceil(F.col("n") / limit).cast("int").alias("__salts"))
    if hot.isEmpty():
        return left.join(right, on, how)
    hot = F.broadcast(hot)
    salted = left.join(hot, on, "left").withColumn("__salt", F.when(F.col("__salts").isNull(), 0).otherwise(F.pmod(F.xxhash64(*left.columns), F.col("__salts")).cast("int"))).drop("__salts")
    copies = right.join(hot, on, "left").withColumn("__salt", F.explode(F.sequence(F.lit(0), F.coalesce("__salts", F.lit(1)) - 1))).drop("__salts")
    return salted.join(copies, [*on, "__salt"], how).drop("__salt")


def with_columns(df: DataFrame, added: list[tuple[str, T.DataType]]) -> tuple[DataFrame, T.StructType]:
    """df without columns that clash with the added ones, and the schema with them; names are compared as Spark does, without case."""
    names = {n.lower() for n, _ in added}
    kept = df.select(*[F.col(f"`{f.name}`") for f in df.schema.fields if f.name.lower() not in names])
    return kept, T.StructType([*kept.schema.fields, *(T.StructField(n, t) for n, t in added)])


def mapped(df: DataFrame, added: list[tuple[str, T.DataType]], make: Callable, *texts: str) -> DataFrame:
    """Append columns that make(*text columns as Arrow string arrays) returns, batch by batch, piece by piece.

    make gets the columns named in texts (null for null) and returns one Arrow array for each added column."""
    small_batches(df.sparkSession)
    kept, schema = with_columns(df, added)
    names = [n for n, _ in added]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(batch.schema.get_field_index(t)) for t in texts]
            for i, j in pieces(columns[0]):
                new = make(*(c.slice(i, j - i) for c in columns))
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([*part.columns, *new], names=[*part.schema.names, *names])

    return kept.mapInArrow(run, schema)


def pieces(texts: pa.Array, limit: int = PIECE) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most limit bytes of text, one row at least."""
    _, offsets = utf8(texts)
    n, i = len(texts), 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = j


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string array and its len + 1 offsets into them, from 0; null is empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(texts) + 1, texts.offset * 8) if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


_BYTES = np.arange(256)
#: Bytes of words: digits, letters, and all of UTF-8 beyond ASCII.
WORD = ((_BYTES >= 0x30) & (_BYTES <= 0x39)) | ((_BYTES >= 0x41) & (_BYTES <= 0x5A)) | ((_BYTES >= 0x61) & (_BYTES <= 0x7A)) | (_BYTES >= 0x80)
LOWER = np.where((_BYTES >= 0x41) & (_BYTES <= 0x5A), _BYTES + 32, _BYTES).astype(np.uint8)
SPACE = np.isin(_BYTES, [9, 10, 11, 12, 13, 32])


def runs(kind: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of bytes of a kind (a table of 256 flags), none across documents: starts, ends, and len(offsets) bounds of each document's runs."""
    m = kind[data]
    if not len(m):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    first, last = m.copy(), m.copy()
    first[1:] &= ~m[:-1]
    last[:-1] &= ~m[1:]
    inner = offsets[(offsets > 0) & (offsets < len(m))]
    first[inner] = m[inner]
    last[inner - 1] = m[inner - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def words_sql(column: str) -> str:
    """The same words as a DuckDB list."""
    lower = f"translate(coalesce({column}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"regexp_extract_all({lower}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


def words(data: np.ndarray, offsets: np.ndarray):
    """Words as `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` finds them once A-Z are lower-case."""
    return runs(WORD, data, offsets)


def mix(h: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, n of them at least."""
    if len(_powers.get("up", ())) < n:
        size = max(n, PIECE + 1)
        up, down = (np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, b, np.uint64)])) for b in (_BASE, _INVERSE))
        if size > 8 * PIECE:
            return up, down
        _powers.update(up=up, down=down)
    return _powers["up"], _powers["down"]


def span_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of the bytes of each span (sorted, not overlapping): a polynomial from prefix sums, mixed with the length."""
    out, i = np.zeros(len(starts), np.uint64), 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + PIECE, "right")))
        base = starts[i]
        part = data[base : ends[j - 1]]
        up, down = _power(len(part) + 1)
        sums = np.zeros(len(part) + 1, np.uint64)
        terms = (LOWER[part] if lower else part).astype(np.uint64)
        terms += np.uint64(1)
        terms *= up[: len(part)]
        np.cumsum(terms, out=sums[1:])
        s, e = starts[i:j] - base, ends[i:j] - base
        out[i:j] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        i = j
    return out


def shingles(hashes: np.ndarray, bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of n consecutive words within each document and their bounds; a document of fewer words, but not none, gives one of all its words."""
    counts = np.diff(bounds)
    size = np.where(counts >= n, counts - n + 1, (counts > 0).astype(np.int64))
    out_bounds = np.concatenate([np.zeros(1, np.int64), np.cumsum(size)])
    if not len(hashes):
        return np.zeros(0, np.uint64), out_bounds
    full = np.zeros(max(0, len(hashes) - n + 1), np.uint64)
    for k in range(n):
        full = full * _BASE + hashes[k : k + len(full)]
    whole = np.repeat(counts >= n, size)
    out = np.zeros(out_bounds[-1], np.uint64)
    at = np.repeat(bounds[:-1] - out_bounds[:-1], size) + np.arange(out_bounds[-1])
    out[whole] = full[at[whole]]
    for d in np.flatnonzero((counts > 0) & (counts < n)):
        h = np.uint64(counts[d])
        for w in hashes[bounds[d] : bounds[d + 1]]:
            h = np.uint64((int(h) * int(_BASE) + int(w)) & 0xFFFFFFFFFFFFFFFF)
        out[out_bounds[d]] = h
    return mix(out), out_bounds


def remembered(key: str, make: Callable):
    """make() once in a Python process: a worker that is used again keeps it from task to task."""
    kept = sys.__dict__.setdefault("_lectern_kept", {})
    if key not in kept:
        kept[key] = make()
    return kept[key]


def sha256_hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()
