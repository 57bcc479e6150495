"""MinHash near-dedup: BagMinHash signatures of word shingles, banding, and verified multiset overlap."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common as c
from .graph import components

#: Words of a shingle, least similarity, signature components (a power of two), and bands of so many rows: two texts of similarity 0.8
#: share a band with a chance of 0.99995.
SHINGLE = 5
SIMILARITY = 0.8
COMPONENTS = 128
BANDS, ROWS = 25, 5
#: Orders by which the first heads of bands are chosen, and rounds in which what stands apart meets another head of its band's largest component.
ORDERS, ROUNDS = 3, 1
#: A band of more texts in several components is compared by blocks of about so many, or so many shingles, and a task takes so many pairs of them.
SMALL_BAND, BLOCK, BLOCK_SHINGLES, BLOCK_PAIRS = 64, 512, 1 << 19, 64
#: Parts into which shingles fall by their hash, to bound an overlap from above; signatures of texts met before that a worker remembers.
PARTS = 1024
REMEMBERED = 4096
_STEP = np.uint64(0x9E3779B97F4A7C15)


def bags(texts: pa.Array, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text by (document, hash): document, hash, count."""
    data, offsets = c.utf8(texts)
    starts, ends, bounds = c.words(data, offsets)
    hashes, out = c.shingles(c.span_hash(data, starts, ends, lower=True), bounds, shingle)
    docs = np.repeat(np.arange(len(texts)), np.diff(out))
    order = np.lexsort((hashes, docs))
    docs, hashes = docs[order], hashes[order]
    first = np.ones(len(docs), bool)
    first[1:] = (docs[1:] != docs[:-1]) | (hashes[1:] != hashes[:-1])
    at = np.flatnonzero(first)
    return docs[at], hashes[at], np.diff(np.append(at, len(docs)))


def signatures(docs: np.ndarray, hashes: np.ndarray, counts: np.ndarray, n: int, k: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """BagMinHash signatures, n x k, and which documents have one (those with shingles).

    A shingle's weights are discretised at 0, 1, 2, 4, 8, ...: each interval below its count has a Poisson process of its own whose rate is
    the interval's length; of the last interval only points below the count are taken. Each point falls on a component at random; a
    component keeps the shingle of its first point. Equal components then have the chance of the weighted Jaccard similarity. Processes
    are drawn in time order and stop once they are later than every component of their document."""
    levels = np.where(counts > 1, np.ceil(np.log2(np.maximum(counts, 1))).astype(np.int64) + 1, 1)
    owner = np.repeat(np.arange(len(docs)), levels)
    level = np.arange(len(owner)) - np.repeat(np.cumsum(levels) - levels, levels)
    doc = docs[owner]
    low = np.where(level > 0, 2.0 ** (level - 1), 0.0)
    length = np.maximum(low, 1.0)
    below = np.minimum((counts[owner] - low) / length, 1.0)  # share of the interval that counts
    seed = c.mix(hashes[owner] + level.astype(np.uint64) * np.uint64(0xA24BAED4963EE407))
    rate = np.bincount(doc, weights=length * below, minlength=n)
    draws = np.clip(2 ** np.ceil(np.log2(4 * k / np.maximum(rate[doc], 1e-9))), 1, 4 * k).astype(np.int64)
    times, winners = np.full(n * k, np.inf), np.zeros(n * k, np.uint64)
    for m in np.unique(draws):
        at = np.flatnonzero(draws == m)
        now, begun = np.zeros(len(at)), np.uint64(0)
        while len(at):
            number = begun + np.arange(1, m + 1, dtype=np.uint64)
            x = c.mix(seed[at][:, None] + number[None, :] * _STEP)
            gaps = -np.log(((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / length[at][:, None]
            t = now[:, None] + np.cumsum(gaps, 1)
            y = c.mix(x ^ _STEP)
            fits = ((y & np.uint64(0xFFFFFFFF)).astype(np.float64) * 2.0**-32 < below[at][:, None]) & np.isfinite(t)
            slot = doc[at][:, None] * k + (y >> np.uint64(64 - k.bit_length() + 1)).astype(np.int64)
            slot, points, ids = slot[fits], t[fits], x[fits]
            near = points < times[slot]
            slot, points, ids = slot[near], points[near], ids[near]
            np.minimum.at(times, slot, points)
            won = times[slot] == points
            winners[slot[won]] = ids[won]
            now = t[:, -1]
            late = times.reshape(n, k).max(1)[doc[at]]
            going = now < late
            at, now = at[going], now[going]
            begun += np.uint64(m)
    return winners.reshape(n, k), rate > 0


def bands(winners: np.ndarray, b: int = BANDS, r: int = ROWS) -> np.ndarray:
    """A key for each band of each signature; keys of different bands differ."""
    out = np.zeros((len(winners), b), np.uint64)
    for j in range(r):
        out = out * _STEP + winners[:, j : b * r : r]
    return c.mix(out + np.arange(1, b + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))


def overlap_set(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A bag as a sorted set of 64-bit numbers: one for the k-th of each shingle's occurrences."""
    number = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return np.sort(c.mix(np.repeat(hashes, counts) + number.astype(np.uint64) * _STEP).astype("<u8"))


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Multiset Jaccard of two overlap sets."""
    both = np.sort(np.concatenate([a, b]), kind="stable")
    shared = int((both[1:] == both[:-1]).sum())
    return shared / max(1, len(both) - shared)


def parts(bag: np.ndarray) -> np.ndarray:
    """How many of an overlap set's numbers lie in each part."""
    return np.bincount((bag >> np.uint64(64 - PARTS.bit_length() + 1)).astype(np.int64), minlength=PARTS)


def ceiling(own: np.ndarray, others: np.ndarray) -> np.ndarray:
    """The highest similarity that bags with these parts can have: they share no more in a part than the smaller one has."""
    shared = np.minimum(own, others).sum(-1)
    return shared / np.maximum(1, own.sum() + others.sum(-1) - shared)


def agreement(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal components of signatures of one byte a component."""
    return (a == b).mean(-1)


def _sketched(texts: DataFrame) -> DataFrame:
    """__id, __key, __text -> __id, __key, bands, sig (a byte of each component; of texts with shingles) and shingles (how many).

    Copies of a text are sketched once in a piece, and not again while the worker remembers them."""

    def run(batches):
        known: dict[bytes, tuple] = {}
        for batch in batches:
            column = batch.column(batch.schema.get_field_index("__text"))
            rest = batch.select(["__id", "__key"])
            digests = rest.column(1).to_pylist()
            for i, j in c.pieces(column):
                if len(known) > REMEMBERED:
                    known.clear()
                new = {digests[k]: k for k in range(j - 1, i - 1, -1) if digests[k] not in known}
                at = sorted(new.values())
                docs, hashes, counts = bags(column.take(pa.array(at, pa.int64())))
                winners, has = signatures(docs, hashes, counts, len(at))
                keys, size = bands(winners).astype(np.int64), np.bincount(docs, weights=counts, minlength=len(at)).astype(np.int64)
                low = (winners[:, : BANDS * ROWS] >> np.uint64(56)).astype(np.uint8)
                for k, row in enumerate(at):
                    known[digests[row]] = (keys[k], low[k].tobytes(), int(size[k])) if has[k] else (keys[k, :0], None, 0)
                own = [known[d] for d in digests[i:j]]
                bounds = np.concatenate([[0], np.cumsum([len(x) for x, _, _ in own])]).astype(np.int32)
                flat = np.concatenate([x for x, _, _ in own])
                made = [pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat)), pa.array([x for _, x, _ in own], pa.binary()), pa.array([x for _, _, x in own], pa.int64())]
                yield pa.RecordBatch.from_arrays([*rest.slice(i, j - i).columns, *made], names=["__id", "__key", "bands", "sig", "shingles"])

    fields = [texts.schema["__id"], texts.schema["__key"], T.StructField("bands", T.ArrayType(T.LongType())), T.StructField("sig", T.BinaryType()), T.StructField("shingles", T.LongType())]
    return texts.mapInArrow(run, T.StructType(fields))


def _bagged(texts: DataFrame) -> DataFrame:
    """__key, __text -> __key, bag."""

    def run(batches):
        for batch in batches:
            column, keys = batch.column(batch.schema.get_field_index("__text")), batch.column(batch.schema.get_field_index("__key"))
            for i, j in c.pieces(column):
                docs, hashes, counts = bags(column.slice(i, j - i))
                at = np.searchsorted(docs, np.arange(j - i + 1))
                rows = [overlap_set(hashes[at[k] : at[k + 1]], counts[at[k] : at[k + 1]]).tobytes() for k in range(j - i)]
                yield pa.RecordBatch.from_arrays([keys.slice(i, j - i), pa.array(rows, pa.binary())], names=["__key", "bag"])

    return texts.mapInArrow(run, "__key binary, bag binary")


def _verified(pairs: DataFrame, bag: DataFrame, least: float) -> DataFrame:
    """Of pairs a, b (keys) those whose bags overlap enough."""
    sides = pairs.join(bag.select(F.col("__key").alias("a"), F.col("bag").alias("bag_a")), "a")
    sides = sides.join(bag.select(F.col("__key").alias("b"), F.col("bag").alias("bag_b")), "b")

    def run(batches):
        for batch in batches:
            a, b = (batch.column(batch.schema.get_field_index(x)) for x in ("bag_a", "bag_b"))
            good = [similarity(np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8")) >= least for x, y in zip(a, b)]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return sides.select("a", "b", "bag_a", "bag_b").mapInArrow(run, "a binary, b binary")


def _placed(member: DataFrame, roots: DataFrame | None) -> DataFrame:
    """band, __key, shingles and the root of the text's component so far."""
    return member.join(roots.withColumnRenamed("node", "__key"), "__key", "left").select("band", "__key", "shingles", F.coalesce("root", "__key").alias("root"))


def _mixed(placed: DataFrame, salt: int) -> DataFrame:
    """Bands whose texts are in several components: band, main (the root of most of them), head (one of those), and of all and of those outside
    of the main component how many they are (total, rest) and how many shingles they have (total_size, rest_size)."""
    sums = placed.groupBy("band", "root").agg(F.count(F.lit(1)).alias("n"), F.sum("shingles").alias("size"), F.min(F.struct(F.xxhash64("__key", F.lit(salt)).alias("h"), F.col("__key").alias("k"))).alias("head"))
    best = F.max(F.struct("n", "root", "head", "size")).alias("m")
    out = sums.groupBy("band").agg(best, F.count(F.lit(1)).alias("parts"), F.sum("n").alias("total"), F.sum("size").alias("total_size")).where("parts > 1")
    out = out.select("band", F.col("m.root").alias("main"), F.col("m.head.k").alias("head"), "total", "total_size", (F.col("total") - F.col("m.n")).alias("rest"), (F.col("total_size") - F.col("m.size")).alias("rest_size"))
    return c.hold(out)


def _small_pairs(placed: DataFrame, mixed: DataFrame, least: float) -> DataFrame:
    """Of bands of up to SMALL_BAND texts, pairs in different components whose sizes allow the similarity."""
    own = placed.join(mixed.where(f"total <= {SMALL_BAND}").select("band"), "band")
    other = own.select("band", F.col("__key").alias("b"), F.col("root").alias("root_b"), F.col("shingles").alias("shingles_b"))
    pairs = own.withColumnRenamed("__key", "a").join(other, "band").where("root < root_b").where(F.least("shingles", "shingles_b") >= F.floor(F.greatest("shingles", "shingles_b") * least))
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _block_links(placed: DataFrame, mixed: DataFrame, classes: DataFrame, bag: DataFrame, least: float) -> DataFrame:
    """Of larger bands, links between texts outside of the main component and all texts, by pairs of blocks: a block of the ones meets each
    block of the others. Texts whose parts allow the similarity are compared in full until they are joined, those of the likest signatures first.

    Blocks hold a bounded number of texts and, but for a longer text alone, of shingles. Pairs of blocks of a band are dealt to as many tasks
    as they need."""
    own = placed.join(mixed.where(f"total > {SMALL_BAND}").drop("head"), "band").join(classes.select("__key", "sig"), "__key").join(bag, "__key")
    blocks = lambda n, size: F.greatest(F.ceil(F.col(n) / BLOCK), F.ceil(F.col(size) / BLOCK_SHINGLES), F.lit(1))
    own = own.select("band", "main", "__key", "root", "sig", "bag", blocks("rest", "rest_size").alias("rests"), blocks("total", "total_size").alias("alls"))
    own = own.withColumn("tasks", F.least("alls", F.ceil(F.col("rests") * F.col("alls") / BLOCK_PAIRS)).cast("long"))
    dealt = lambda n: F.pmod(F.xxhash64("__key", F.lit(5)), F.col(n))

    def pack(table: pa.Table) -> pa.Table:
        get = lambda x: table.column(x).to_pylist()
        bags_ = get("bag")
        sizes = np.array([len(x) for x in bags_], np.int64)
        return pa.table({"band": [get("band")[0]], "block": [get("block")[0]], "tasks": [get("tasks")[0]], "keys": [b"".join(get("__key"))], "roots": [b"".join(get("root"))], "sigs": [b"".join(get("sig"))], "sizes": [sizes.tobytes()], "bags": [b"".join(bags_)]})

    schema = "band long, block long, tasks long, keys binary, roots binary, sigs binary, sizes binary, bags binary"
    columns, needed = ["keys", "roots", "sigs", "sizes", "bags"], ["band", "block", "tasks", "__key", "root", "sig", "bag"]
    rest = own.where("root <> main").withColumn("block", dealt("rests")).select(*needed).groupBy("band", "block").applyInArrow(pack, schema)
    every = own.withColumn("block", dealt("alls")).select(*needed).groupBy("band", "block").applyInArrow(pack, schema)
    rest, every = c.stash(rest, "minhash-rest"), c.stash(every, "minhash-every")
    left = rest.select("band", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tasks") - 1)).alias("task"), *columns)
    right = every.select("band", F.pmod("block", "tasks").alias("task"), *[F.col(x).alias(f"{x}_b") for x in columns])
    pairs = left.join(right, ["band", "task"])

    def run(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                side = []
                for end in ("", "_b"):
                    raw = {x: batch.column(batch.schema.get_field_index(x + end))[r].as_py() for x in columns}
                    keys = [raw["keys"][k : k + 16] for k in range(0, len(raw["keys"]), 16)]
                    roots = [raw["roots"][k : k + 16] for k in range(0, len(raw["roots"]), 16)]
                    cut = np.concatenate([[0], np.cumsum(np.frombuffer(raw["sizes"], np.int64) // 8)])
                    whole = np.frombuffer(raw["bags"], "<u8")
                    own_bags = [whole[x:y] for x, y in zip(cut, cut[1:])]
                    side.append((keys, roots, np.frombuffer(raw["sigs"], np.uint8).reshape(len(keys), -1), own_bags, np.stack([parts(x) for x in own_bags]).astype(np.int32)))
                (keys, roots, sigs, own_bags, own_parts), (keys_b, roots_b, sigs_b, bags_b, parts_b) = side
                up: dict[bytes, bytes] = {}

                def find(x):
                    while up.get(x, x) != x:  # noqa: B023
                        x = up[x]  # noqa: B023
                    return x

                out = []
                for k in range(len(keys)):
                    at = np.flatnonzero(ceiling(own_parts[k], parts_b) >= least)
                    like = agreement(sigs[k], sigs_b[at])
                    for x in at[np.argsort(-like, kind="stable")]:
                        p, q = find(roots[k]), find(roots_b[x])
                        if p != q and similarity(own_bags[k], bags_b[x]) >= least:
                            up[max(p, q)] = min(p, q)
                            out.append((keys[k], keys_b[x]))
                yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in out], pa.binary()), pa.array([b for _, b in out], pa.binary())], names=["a", "b"])

    out = c.hold(pairs.select("band", *columns, *[f"{x}_b" for x in columns]).mapInArrow(run, "a binary, b binary"))
    c.release(rest, every)
    return out


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = SIMILARITY) -> DataFrame:
    """One row per row of docs: doc_id, class_id (the least id of the same text), component_id (the least id reachable by links between
    texts of similarity >= least), kept (doc_id = component_id) and __key (the text's digest, null for null).

    Rows of one text are one class and are never paired. Texts are linked if they share a band and their bags of five-word shingles (lower
    case; all the words of a shorter text are one shingle) overlap enough. Each band's texts are first compared with a head of the band; in
    further rounds those outside of a band's largest component meet another head of it; then, so that no link is missed, all that are still
    in different components of a band are compared: pair by pair in small bands, by blocks in large ones. No band's texts are paired all with
    all, and none is put together in one task. Pairs are passed over only where sizes, or counts of shingles by parts of the hash, show that
    they cannot be similar enough; overlaps are counted with 64-bit hashes.
    Null text: a class and component of its own. Texts without words are linked with the same text only. Rows with a null id take part;
    ids of a class or component with other rows come from those. Repeated rows get equal rows. Empty table: no rows."""
    c.small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("__id"), F.unhex(F.md5(F.col(text_col))).alias("__key"), F.col(text_col).alias("__text"))
    sketched = c.stash(_sketched(rows), "minhash-sketch")
    classes = sketched.where("__key IS NOT NULL").groupBy("__key").agg(F.min("__id").alias("class_id"), F.any_value("bands").alias("bands"), F.any_value("sig").alias("sig"), F.any_value("shingles").alias("shingles"), F.count(F.lit(1)).alias("n"))
    classes = c.stash(classes, "minhash-classes")
    copies = c.hold(classes.select("__key", "n").where(f"n > {c.HOT_ROWS}"))
    rows_in_all = classes.agg(F.sum("n")).first()[0] or 0
    member = classes.select("__key", "shingles", F.posexplode("bands").alias("at", "band"))
    order = F.xxhash64("__key", F.pmod(F.col("at"), F.lit(ORDERS)))
    heads = member.groupBy("band").agg(F.min(F.struct(order.alias("h"), F.col("__key").alias("k"))).alias("head"), F.count(F.lit(1)).alias("n"))
    heads = c.hold(heads.where("n > 1").select("band", F.col("head.k").alias("head")))
    member = kept_members = c.stash(member.select("band", "__key", "shingles").join(heads, "band"), "minhash-members")
    pairs = member.where("__key <> head").select(F.least("__key", "head").alias("a"), F.greatest("__key", "head").alias("b")).distinct()
    member = member.select("band", "__key", "shingles")
    wanted = member.select("__key").distinct()
    wanted = classes.select("__key", F.col("class_id").alias("__id")).join(wanted, "__key").select(F.col("__key").alias("__k"), F.col("__id").alias("__i"))
    texts = rows.join(wanted.hint("merge"), rows["__key"].eqNullSafe(F.col("__k")) & rows["__id"].eqNullSafe(F.col("__i")), "left_semi")
    bag = c.stash(_bagged(texts.select("__key", "__text")).dropDuplicates(["__key"]), "minhash-bags")
    c.release(heads)

    def verified(pairs: DataFrame) -> DataFrame:
        pairs = c.hold(pairs)
        out = c.hold(_verified(pairs, bag, least))
        c.release(pairs)
        return out

    def rooted(links: list[DataFrame], before: DataFrame | None = None) -> DataFrame:
        if before is not None:
            c.release(before)
        return components(reduce(DataFrame.union, links))

    links = [verified(pairs)]
    roots = rooted(links)
    for salt in range(1, ROUNDS + 1):
        placed = c.hold(_placed(member, roots))
        mixed = _mixed(placed, salt)
        pairs = placed.join(mixed, "band").where("root <> main").select(F.least("__key", "head").alias("a"), F.greatest("__key", "head").alias("b")).distinct()
        links.append(verified(pairs))
        c.release(placed, mixed)
        roots = rooted(links, roots)
    placed = c.hold(_placed(member, roots))
    mixed = _mixed(placed, 0)
    links.append(verified(_small_pairs(placed, mixed, least)))
    if not mixed.where(f"total > {SMALL_BAND}").isEmpty():
        links.append(_block_links(placed, mixed, classes, bag, least))
    roots = rooted(links, roots)
    grouped = classes.select("__key", "class_id").join(roots.withColumnRenamed("node", "__key"), "__key", "left")
    grouped = grouped.withColumn("root", F.coalesce("root", "__key"))
    tops = c.hold(grouped.groupBy("root").agg(F.min("class_id").alias("component_id")))
    found = c.stash(grouped.join(tops, "root").select("__key", "class_id", "component_id"), "minhash-found")
    c.release(tops, roots, placed, mixed)
    c.discard(classes, kept_members, bag, *links)
    out = c.spread_join(sketched.select(F.col("__id").alias("doc_id"), "__key"), found, ["__key"], copies, rows_in_all, "left")
    out = out.withColumns({x: F.when(F.col("__key").isNull(), F.col("doc_id")).otherwise(F.col(x)) for x in ("class_id", "component_id")})
    return out.select("doc_id", "class_id", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "__key")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = SIMILARITY) -> DataFrame:
    """The rows of docs that near_duplicates keeps, with their columns; of rows that repeat id and text one stays."""
    found = near_duplicates(docs, id_col, text_col, least)
    kept = found.where("kept").groupBy(F.col("doc_id").alias("__id"), F.col("__key").alias("__digest")).agg(F.count(F.lit(1)).alias("__n"))
    kept = c.hold(kept)
    keyed = docs.withColumn("__digest", F.unhex(F.md5(F.col(text_col))))
    out = keyed.join(kept.hint("merge"), keyed[id_col].eqNullSafe(kept["__id"]) & keyed["__digest"].eqNullSafe(kept["__digest"]), "left_semi")
    if not kept.where("__n > 1 AND __digest IS NOT NULL").isEmpty():
        out = out.dropDuplicates([id_col, "__digest"])
    return out.select(*[F.col(f"`{n}`") for n in docs.columns])


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes and components of all documents."""
    docs = c.table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs).select("doc_id", "class_id", "component_id", "kept")


#: DuckDB: all pairs of distinct texts that share a shingle, and the components of those similar enough.
OP5_SQL = f"""
WITH RECURSIVE classes AS (SELECT text, min(doc_id) AS id FROM documents WHERE text IS NOT NULL GROUP BY text),
w AS (SELECT id, {c.words_sql("text")} AS w FROM classes),
sh AS (SELECT id, array_to_string(list_slice(w, i, i + 4), ' ') AS s FROM (SELECT id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
bag AS (SELECT id, s, count(*) AS n FROM sh GROUP BY 1, 2),
total AS (SELECT id, sum(n) AS t FROM bag GROUP BY 1),
shared AS (SELECT a.id AS a, b.id AS b, sum(least(a.n, b.n)) AS s FROM bag a JOIN bag b ON a.s = b.s AND a.id < b.id GROUP BY 1, 2),
near AS (SELECT a, b FROM shared JOIN total x ON x.id = a JOIN total y ON y.id = b WHERE s >= {SIMILARITY} * (x.t + y.t - s)),
links AS (SELECT a, b FROM near UNION ALL SELECT b, a FROM near),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
tops AS (SELECT a, min(b) AS b FROM reach GROUP BY 1)
SELECT d.doc_id, coalesce(c.id, d.doc_id) AS class_id, least(coalesce(c.id, d.doc_id), coalesce(t.b, c.id, d.doc_id)) AS component_id,
       d.doc_id = least(coalesce(c.id, d.doc_id), coalesce(t.b, c.id, d.doc_id)) AS kept
FROM documents d LEFT JOIN classes c ON c.text = d.text LEFT JOIN tops t ON t.a = c.id
"""
