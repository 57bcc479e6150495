"""Token counts by section: whole documents are encoded once, token spans meet section spans, and tokens across a boundary go by an explicit rule."""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common as c

#: Where a token goes whose characters lie in several sections: to the one of its first character, or to the one that has most of its
#: characters (the earlier of equals).
RULES = ("first", "most")


def read_ranks(path: str | None = None) -> str:
    """The text of a ranks file (one vocabulary: of bounded size), read where the driver runs."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    with open(path, encoding="ascii") as f:
        return f.read()


def encoder(ranks: str, pattern: str):
    """A tiktoken encoding and the number of bytes of each token."""
    import tiktoken

    merges = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}
    sizes = np.zeros(max(merges.values()) + 1, np.int64)
    for token, rank in merges.items():
        sizes[rank] = len(token)
    return tiktoken.Encoding("lectern", pat_str=pattern, mergeable_ranks=merges, special_tokens={}), sizes


def line_sections(text: str) -> np.ndarray:
    """Where sections begin, in characters, if each line with its line feed is one; an empty rest after the last line feed is none."""
    breaks = [0]
    at = text.find("\n")
    while 0 <= at < len(text) - 1:
        breaks.append(at + 1)
        at = text.find("\n", at + 1)
    return np.array(breaks, np.int64)


def attribute(starts: np.ndarray, stops: np.ndarray, begins: np.ndarray, end: int, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens [starts, stops) in characters over sections that begin at begins (the last ends at end): tokens of each section, and of them
    those that cross a boundary."""
    first = np.searchsorted(begins, starts, "right") - 1
    last = np.searchsorted(begins, np.maximum(stops - 1, starts), "right") - 1
    owner, crossing = first.copy(), np.flatnonzero(last > first)
    if rule == "most":
        edges = np.append(begins, end)
        for t in crossing:
            s = np.arange(first[t], last[t] + 1)
            owner[t] = s[np.argmax(np.minimum(edges[s + 1], stops[t]) - np.maximum(edges[s], starts[t]))]
    return np.bincount(owner, minlength=len(begins)), np.bincount(owner[crossing], minlength=len(begins))


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks: str | None = None, pattern: str | None = None, rule: str = "most", sections=line_sections) -> DataFrame:
    """One row per row of docs and section of its text: doc_id, section (from 0), start_char, end_char, n_tokens, n_crossing (its tokens that
    reach into another section) and doc_tokens (of the whole text; the sum over its sections).

    A token's characters are all those of which it has a byte, so a character that several tokens share counts for each. Null and empty texts
    have one section without characters or tokens. Repeated rows give repeated rows, also with a null id; an empty table gives no rows.
    Other columns of docs, whatever their names, are not read and not carried over."""
    if rule not in RULES:
        raise ValueError(f"rule: one of {RULES}")
    c.small_batches(docs.sparkSession)
    if pattern is None:
        import public_tokenizers

        pattern = public_tokenizers.PATTERN
    shared = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks))
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("__text"))
    names = ["section", "start_char", "end_char", "n_tokens", "n_crossing", "doc_tokens"]

    def run(batches):
        encoding, sizes = encoder(shared.value, pattern)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for i, j in c.pieces(texts):
                columns: list[list[np.ndarray]] = [[] for _ in names]
                rows = []
                for k, text in enumerate(texts.slice(i, j - i).fill_null("").to_pylist()):
                    raw = np.frombuffer(text.encode("utf-8"), np.uint8)
                    char = np.cumsum((raw & 0xC0) != 0x80) - 1
                    ends = np.cumsum(sizes[encoding.encode_ordinary(text)])
                    begins = sections(text)
                    n = len(begins)
                    if len(ends):
                        whole, crossing = attribute(char[np.concatenate([[0], ends[:-1]])], char[ends - 1] + 1, begins, len(text), rule)
                    else:
                        whole = crossing = np.zeros(n, np.int64)
                    rows.append(np.full(n, i + k))
                    for column, values in zip(columns, (np.arange(n), begins, np.append(begins[1:], len(text)), whole, crossing, np.full(n, len(ends)))):
                        column.append(values)
                out = [pa.array(np.concatenate(x).astype(np.int64)) for x in columns]
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(np.concatenate(rows))), *out], names=["doc_id", *names])

    return source.mapInArrow(run, T.StructType([source.schema["doc_id"], *(T.StructField(n, T.LongType()) for n in names)]))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document by line."""
    return count_tokens(c.table(spark, sf_dir, "documents").select("doc_id", "text"))
