"""Embedding near-dedup: vectors in PCA order, compared tile by tile; leading dimensions first, the rest bounded by suffix norms."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common as c
from .graph import components, roots_of

THRESHOLD = 0.93
#: Vectors of a tile (about), vectors that the rotation and the cells are fitted on at most, and dimensions of a tile's box.
TILE = 1024
SAMPLE = 4096
BOX = 8
#: Bytes of vectors of a pack (neighbouring tiles of one label that are sent together) and of a block (the packs of one file), and bytes of the
#: blocks that a round compares with all that their labels have.
PACK = 1 << 20
BLOCK = 16 << 20
ROUND = 128 << 20
#: Leading dimensions that the bound is tried on, in single precision, and by how much it may be wrong there (34 rounded products of sum 1 at most).
LEAD = 32
SINGLE = 1e-5
#: Pairs that are gathered at once hold so many numbers.
GATHERED = 1 << 21
#: Sums whose distance from the threshold is less than this are taken again from the vectors as given.
CLOSE = 1e-9


def vectors(rows: DataFrame, id_col: str, vector_col: str, label_col: str) -> tuple[DataFrame, str]:
    """__id, __group (label and number of dimensions) and __raw (the components' bytes); __group and __raw are null for vectors that link
    with nothing. Also the numpy type of the bytes."""
    element = rows.schema[vector_col].dataType.elementType
    kind = "<f4" if isinstance(element, T.FloatType) else "<f8"
    source = rows.select(F.col(id_col).alias("__id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).cast("array<float>" if kind == "<f4" else "array<double>").alias("v"))

    def run(batches):
        for batch in batches:
            label, lists = batch.column(1), batch.column(2)
            n = batch.num_rows
            raw, group = [None] * n, [None] * n
            names, known = label.to_pylist(), lists.is_valid().to_numpy(zero_copy_only=False)
            values = lists.values
            holes = values.is_null().to_numpy(zero_copy_only=False) if values.null_count else np.zeros(len(values), bool)
            flat = np.nan_to_num(values.fill_null(0).to_numpy(zero_copy_only=False).astype(kind), nan=np.nan)
            bad = holes | ~np.isfinite(flat)
            offsets = lists.offsets.to_numpy()
            for k in np.flatnonzero(known):
                a, b = offsets[k], offsets[k + 1]
                x = flat[a:b]
                if names[k] is not None and not bad[a:b].any() and x.any():
                    raw[k], group[k] = x.tobytes(), f"{names[k]}|{b - a}"
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(group, pa.string()), pa.array(raw, pa.binary())], names=["__id", "__group", "__raw"])

    schema = T.StructType([source.schema["__id"], T.StructField("__group", T.StringType()), T.StructField("__raw", T.BinaryType())])
    return source.mapInArrow(run, schema), kind


def unit(raw: np.ndarray) -> np.ndarray:
    """Vectors of length 1; they are brought near it first, so that no square of a finite component is lost or infinite."""
    x = raw.astype(np.float64)
    x = x / np.abs(x).max(1)[:, None]
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


class Frame:
    """A rotation to principal axes for each number of dimensions, and a tree of cells by medians along the leading axes."""

    def __init__(self, sample: list[np.ndarray], depth: int) -> None:
        self.axes: dict[int, np.ndarray] = {}
        self.cuts: dict[int, np.ndarray] = {}
        self.depth = depth
        for d in {len(x) for x in sample}:
            x = unit(np.stack([v for v in sample if len(v) == d]))
            _, axes = np.linalg.eigh(x.T @ x)
            self.axes[d] = np.ascontiguousarray(axes[:, ::-1])
            y = x @ self.axes[d]
            cuts, code = np.zeros(1 << depth), np.ones(len(y), np.int64)
            for level in range(depth):
                at = y[:, self.axis(level, d)]
                for node in range(1 << level, 2 << level):
                    own = at[code == node]
                    cuts[node] = np.median(own) if len(own) else 0.0
                code = 2 * code + (at > cuts[code])
            self.cuts[d] = cuts

    @staticmethod
    def axis(level: int, d: int) -> int:
        """After the mean direction (the first axis) the next seven in turn."""
        return (1 + level % (BOX - 1)) % d

    def rotated(self, raw: np.ndarray) -> np.ndarray:
        x = unit(raw)
        axes = self.axes.get(x.shape[1])
        return x if axes is None else x @ axes

    def cells(self, y: np.ndarray) -> np.ndarray:
        code = np.ones(len(y), np.int64)
        cuts = self.cuts.get(y.shape[1])
        for level in range(self.depth if cuts is not None else 0):
            code = 2 * code + (y[:, self.axis(level, y.shape[1])] > cuts[code])
        return code


def leading(y: np.ndarray) -> np.ndarray:
    """Of rotated vectors the leading dimensions and the norm of the rest, in single precision."""
    rest = np.sqrt(np.einsum("ij,ij->i", y[:, LEAD:], y[:, LEAD:]))
    return np.concatenate([y[:, :LEAD], rest[:, None]], 1).astype(np.float32)


def linked(a: np.ndarray, b: np.ndarray, raw_a: np.ndarray, raw_b: np.ndarray, threshold: float, leads: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) of rotated unit vectors with cosine >= threshold. leads: leading(a) and leading(b), where they are known.

    The product of the leading dimensions plus the product of the norms of the rest bounds the cosine from above: pairs that cannot reach the
    threshold are dropped, and what is left is summed in double precision. Sums close to the threshold are decided by the given vectors."""
    lead_a, lead_b = leads or (leading(a), leading(b))
    i, j = np.divmod(np.flatnonzero(lead_a @ lead_b.T >= np.float32(threshold - SINGLE)), len(b))
    if 16 * len(i) > len(a) * len(b):
        sums = (a @ b.T)[i, j]
    else:
        sums, some = np.zeros(len(i)), max(1, GATHERED // a.shape[1])
        for k in range(0, len(i), some):
            sums[k : k + some] = np.einsum("ij,ij->i", a[i[k : k + some]], b[j[k : k + some]])
    good = sums >= threshold
    close = np.flatnonzero(np.abs(sums - threshold) <= CLOSE)
    if len(close):
        x, y = (v / np.exp2(np.floor(np.log2(np.abs(v).max(1))))[:, None] for v in (raw_a[i[close]].astype(np.float64), raw_b[j[close]].astype(np.float64)))  # by powers of two: exactly
        dot = lambda p, q: np.einsum("ij,ij->i", p, q)
        good[close] = dot(x, y) / (np.sqrt(dot(x, x)) * np.sqrt(dot(y, y))) >= threshold
    return i[good], j[good]


@c.frees_shuffles
def near_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", threshold: float = THRESHOLD, tile: int = TILE) -> DataFrame:
    """One row per row of rows: vec_id, n_links, component_id (the least id reachable by links, its own included) and kept (vec_id =
    component_id).

    Vectors are compared if their labels are equal and not null and they have as many dimensions. Vectors that are null, empty, zero or hold
    null or non-finite components, and rows with a null id, link with nothing: n_links 0, a component of their own. Equal vectors of a label
    are compared once and count with their number, repeated rows too. An id that occurs with several vectors is one node of its components.
    Ids are whole numbers (of any integer type). Components may be as large or small as doubles can be. Other columns, whatever their names,
    are not read. An empty table gives no rows.

    Every pair of tiles of a label is compared whose boxes along the leading axes are not too far apart for any link: that skips nothing. Packs
    of tiles are written once, in blocks; rounds of blocks meet the blocks of the same labels from there on in a cartesian product, whose tasks
    read both sides' files. So pairs of tiles grow with the square of a label, and so does what is read, but not what is on disk."""
    spark = rows.sparkSession
    c.small_batches(spark)
    found, kind = vectors(rows, id_col, vector_col, label_col)
    whole = found.withColumn("__key", F.when(F.col("__id").isNotNull(), F.unhex(F.md5(F.concat(F.col("__group").cast("binary"), F.col("__raw"))))))
    whole = c.stash(whole, "vectors")
    classes = whole.where("__key IS NOT NULL").groupBy("__key").agg(F.min("__id").alias("rep"), F.count(F.lit(1)).alias("times"), F.any_value("__group").alias("__group"), F.any_value("__raw").alias("__raw"))
    classes = c.stash(classes, "vectors-classes")
    found = c.stash(whole.select("__id", "__key"), "vectors-ids")
    c.discard(whole)
    n, size = classes.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("__raw")), F.lit(0))).first()
    sample = [np.frombuffer(r[0], kind) for r in classes.select("__raw", "__key").orderBy("__key").limit(SAMPLE).collect()]
    depth = int(min(np.log2(SAMPLE), np.ceil(np.log2(max(1.0, n / tile)))))
    frame = Frame(sample, depth)

    def place(batches):
        for batch in batches:
            raws = batch.column(batch.schema.get_field_index("__raw")).to_pylist()
            cells = np.zeros(len(raws), np.int64)
            sizes = np.array([len(r) for r in raws])
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                cells[at] = frame.cells(frame.rotated(np.frombuffer(b"".join(raws[k] for k in at), kind).reshape(len(at), -1)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells)], names=[*batch.schema.names, "cell"])

    order = ("__group", "cell", "__key")
    blocks = max(1, min(-(-n // tile), max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BLOCK))))
    celled = classes.mapInArrow(place, T.StructType([*classes.schema.fields, T.StructField("cell", T.LongType())]))
    celled = celled.repartitionByRange(blocks, *order).sortWithinPartitions(*order)

    def pack(batches):
        block, number, group, held = TaskContext.get().partitionId(), 0, None, []

        def packed():
            reps, times = (np.array([x[k] for x in held], np.int64) for k in (0, 1))
            raws = b"".join(x[2] for x in held)
            y = frame.rotated(np.frombuffer(raws, kind).reshape(len(held), -1))[:, :BOX]
            values = group, number, y.min(0).tolist(), y.max(0).tolist(), reps.tobytes(), times.tobytes(), raws, block
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds)], names=names)

        names = ["__group", "number", "low", "high", "reps", "times", "raws", "block"]
        kinds = [pa.string(), pa.int32(), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.binary(), pa.binary(), pa.binary(), pa.int32()]
        for batch in batches:
            for own, *row in zip(*(batch.column(batch.schema.get_field_index(x)).to_pylist() for x in ("__group", "rep", "times", "__raw"))):
                if held and (own != group or len(held) >= most):
                    yield packed()
                    number, held = number + 1, []
                if not held:
                    group, most = own, max(64, min(4 * tile, PACK // len(row[2])))
                held.append(row)
        if held:
            yield packed()

    packs = c.stash(celled.mapInArrow(pack, "__group string, number int, low array<double>, high array<double>, reps binary, times binary, raws binary, block int"), "vectors-packs", by=("block",))
    rep_type = classes.schema["rep"].dataType
    reps = c.stash(classes.select("__key", "rep", "times"), "vectors-reps")
    c.discard(classes)

    def opened(reps: bytes, times: bytes, raws: bytes) -> tuple:
        reps, times = np.frombuffer(reps, "<i8"), np.frombuffer(times, "<i8")
        raw = np.frombuffer(raws, kind).reshape(len(reps), -1)
        y = frame.rotated(raw)
        tiles = [slice(s, min(s + tile, len(reps))) for s in range(0, len(reps), tile)]
        return reps, times, raw, y, [(s, y[s, :BOX].min(0), y[s, :BOX].max(0), leading(y[s])) for s in tiles]

    def compare(batches):
        # all that a task finds is summed in it: where its packs' vectors begin and their links, and pairs of ends in one component
        name, left, met, ids, ends, total = None, None, {}, [], [], 0
        for batch in batches:
            column = {x: batch.column(batch.schema.get_field_index(x)) for x in batch.schema.names}
            for r in range(batch.num_rows):
                one, two = ((column[f"block{x}"][r].as_py(), column[f"number{x}"][r].as_py()) for x in ("", "_b"))
                if one != name:
                    name, left = one, opened(*(column[x][r].as_py() for x in ("reps", "times", "raws")))
                same = one == two
                right = left if same else opened(*(column[f"{x}_b"][r].as_py() for x in ("reps", "times", "raws")))
                for x, (reps, *_) in ((one, left), (two, right)):
                    if x not in met:
                        met[x] = total, np.zeros(len(reps))
                        ids.append(reps)
                        total += len(reps)
                (_, times_a, raw_a, a, tiles_a), (_, times_b, raw_b, b, tiles_b) = left, right
                (base_a, links_a), (base_b, links_b) = met[one], met[two]
                for s, low, high, lead in tiles_a:
                    for t, low_b, high_b, lead_b in tiles_b:
                        gap = np.maximum(0, np.maximum(low - high_b, low_b - high))
                        if same and t.start < s.start or gap @ gap > 2 - 2 * threshold + 1e-6:
                            continue
                        i, j = linked(a[s], b[t], raw_a[s], raw_b[t], threshold, (lead, lead_b))
                        if same and s == t:
                            i, j = i[i < j], j[i < j]
                        if len(i):
                            half = s.stop - s.start
                            at = np.concatenate([np.arange(s.start, s.stop) + base_a, np.arange(t.start, t.stop) + base_b])
                            links_a[s] += np.bincount(i, times_b[t][j], half)
                            links_b[t] += np.bincount(j, times_a[s][i], len(at) - half)
                            root = roots_of(i, j + half, len(at))
                            far = np.flatnonzero(root != np.arange(len(at)))
                            ends.append((at[far], at[root[far]]))
                if sum(len(x) for x, _ in ends) > 1 << 20:
                    root = roots_of(*(np.concatenate(x) for x in zip(*ends)), total)
                    far = np.flatnonzero(root != np.arange(total))
                    ends = [(far, root[far])]
        if ends:
            root = roots_of(*(np.concatenate(x) for x in zip(*ends)), total)
            ids, links = np.concatenate(ids), np.concatenate([n for _, n in met.values()])
            at = np.flatnonzero(links)
            for k in range(0, len(at), 1 << 16):
                x = at[k : k + (1 << 16)]
                yield pa.RecordBatch.from_arrays([pa.array(ids[x]), pa.array(links[x].astype(np.int64)), pa.array(ids[root[x]])], names=["rep", "n", "root"])

    kept = "rep long, n long, root long"
    links = c.stash(spark.createDataFrame([], kept), "vectors-links")
    spans = sorted((r.block, r.least, r.most) for r in packs.groupBy("block").agg(F.min("__group").alias("least"), F.max("__group").alias("most")).collect())
    step = max(1, len(spans) * ROUND // max(1, size))
    gaps = F.zip_with(F.arrays_zip("low", "high"), F.arrays_zip("low_b", "high_b"), lambda x, y: F.greatest(F.lit(0.0), x["low"] - y["high_b"], y["low_b"] - x["high"]))
    apart = F.aggregate(gaps, F.lit(0.0), lambda s, g: s + g * g)
    for k in range(0, len(spans), step):
        first, (last, _, group) = spans[k][0], spans[k : k + step][-1]
        end = max([last, *(block for block, least, _ in spans[k + step :] if least == group)])
        one = packs.where(F.col("block").between(first, last))
        two = packs.where(F.col("block").between(first, end))
        two = two.select(*[F.col(x).alias(f"{x}_b") for x in two.columns])
        # of two packs of the round each is met by the other; half of the pairs are taken on either side, so that tasks are even
        before = F.struct("block", "number") < F.struct("block_b", "number_b")
        even = (F.col("block") + F.col("number") + F.col("block_b") + F.col("number_b")) % 2 == 0
        same = (F.col("block") == F.col("block_b")) & (F.col("number") == F.col("number_b"))
        met = one.hint("shuffle_replicate_nl").join(two, (F.col("__group") == F.col("__group_b")) & ((F.col("block_b") > last) | same | (before == even)) & (apart <= 2 - 2 * threshold + 1e-6))
        links = c.stash(met.mapInArrow(compare, kept), "vectors-links", onto=links)
    c.discard(packs)
    sums = links.groupBy("rep").agg(F.sum("n").alias("n"))
    ends = components(links.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    least = c.hold(ends.groupBy("root").agg(F.min("node").alias("top")))
    tops = ends.join(least, "root").select(F.col("node").alias("rep"), "top")
    judged = reps.select("__key", F.col("rep").cast("long").alias("rep"), "times").join(sums, "rep", "left").join(tops, "rep", "left")
    judged = c.stash(judged.select("__key", (F.coalesce("n", F.lit(0)) + F.col("times") - 1).alias("n_links"), F.coalesce("top", "rep").cast(rep_type).alias("top")), "vectors-judged")
    c.release(ends, least)
    c.discard(reps, links)
    out = found.select(F.col("__id").alias("vec_id"), "__key").join(judged, "__key", "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("top", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op4_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors."""
    out = near_vectors(c.table(spark, sf_dir, "embeddings"))
    return out.select(F.col("vec_id").cast("long"), "n_links", F.col("component_id").cast("long"), "kept")


OP4_SQL = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= {THRESHOLD}),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
tops AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
sums AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT CAST(vec_id AS BIGINT) AS vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, CAST(least(vec_id, coalesce(tops.b, vec_id)) AS BIGINT) AS component_id,
       vec_id = least(vec_id, coalesce(tops.b, vec_id)) AS kept
FROM embeddings LEFT JOIN sums ON sums.a = vec_id LEFT JOIN tops ON tops.a = vec_id
"""
