"""Connected components of links, by contraction."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import hold, release

#: Rows of a table of nodes up to which it is broadcast (a few MB of ids or digests); larger ones are joined by merging.
BROADCAST_ROWS = 100_000
#: Links up to which one task finishes the contraction (16 MB of digests at most).
LAST_LINKS = 250_000


def roots_of(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """The least node of each node's component, for links i - j between n nodes."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, root[i], low)
        np.minimum.at(new, root[j], low)
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _finished(edges: DataFrame) -> DataFrame:
    """node, root of a bounded number of links, in one task."""

    def run(batches):
        got = [b for b in batches if b.num_rows]
        if got:
            ends = pa.chunked_array([b.column(k) for k in (0, 1) for b in got]).combine_chunks().dictionary_encode()
            at = ends.indices.to_numpy()
            half = len(at) // 2
            root = roots_of(at[:half], at[half:], len(ends.dictionary))
            yield pa.RecordBatch.from_arrays([ends.dictionary, ends.dictionary.take(pa.array(root))], names=["node", "root"])

    kind = edges.schema["a"].dataType
    return edges.select("a", "b").coalesce(1).mapInArrow(run, T.StructType([T.StructField("node", kind), T.StructField("root", kind)]))


def components(links: DataFrame, last: int = LAST_LINKS) -> DataFrame:
    """links: columns a, b of one type, nulls and loops ignored. Returns node, root for every node of a link; root is the same for all nodes
    of a component and is one of them. The result is held: release() it. out._rounds: how many it took.

    Each round maps every node to that of its neighbours and itself which a hash puts first, and carries links and nodes over to those. The
    hash changes with every second round: whatever the ids, about half of a chain's nodes are left by a round, and a star ends in two. Once
    there are at most `last` links left, one task finishes. Only per-node minima are grouped, and every round's tables are held."""
    edges = hold(links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select("a", "b").distinct())
    roots, number = None, 0
    while edges._rows:
        if edges._rows <= last:
            up = hold(_finished(edges).withColumnRenamed("node", "a").withColumnRenamed("root", "up"))
        else:
            order = lambda x: F.struct(F.xxhash64(x, F.lit(number // 2)).alias("h"), F.col(x).alias("k"))  # noqa: E731, B023
            both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
            up = hold(both.groupBy("a").agg(F.min(order("b")).alias("least")).select("a", F.least("least", order("a"))["k"].alias("up")))
        number += 1
        near = F.broadcast(up) if up._rows <= BROADCAST_ROWS else up.hint("merge")
        if roots is None:
            new = hold(up.select(F.col("a").alias("node"), F.col("up").alias("root")))
        else:
            new = hold(roots.join(near.withColumnRenamed("a", "root"), "root", "left").select("node", F.coalesce("up", "root").alias("root")))
            release(roots)
        roots = new
        if edges._rows <= last:
            release(up)
            break
        first = edges.join(near.select("a", F.col("up").alias("ua")), "a").select("b", "ua")
        second = first.join(near.select(F.col("a").alias("b"), F.col("up").alias("ub")), "b").select("ua", "ub")
        left = hold(second.where("ua <> ub").select(F.least("ua", "ub").alias("a"), F.greatest("ua", "ub").alias("b")).distinct())
        release(edges, up)
        edges = left
    if roots is None:
        roots = hold(edges.select(F.col("a").alias("node"), F.col("b").alias("root")))
    release(edges)
    roots._rounds = number
    return roots
