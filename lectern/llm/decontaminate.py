"""Benchmark decontamination: generalised suffix automata of the items' words, through which the documents' words stream.

Items that make one block are one automaton, which every task gets. More are dealt to blocks, and a text streams through the automata of those
blocks only that have a window with the hash of one of its own."""

from __future__ import annotations

import re
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common as c

#: Consecutive words of an item that make a window.
WINDOW = 10
#: Bytes of item texts in one automaton, about; more items are dealt to several automata.
BLOCK_BYTES = 1 << 20
#: Bits of the hashes of item windows that a table of flags covers, and those within a part of it (the table is of fixed size: 8 MB).
FLAG_BITS, PART_BITS = 26, 16
#: Texts that meet one copy of a block's automaton, about.
BLOCK_TEXTS = 20_000
_WORDS = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def item_words(text: str | None) -> list[bytes]:
    return _WORDS.findall((text or "").encode("utf-8", "surrogatepass").lower())


class Automaton:
    """All runs of words of a block of items; streams give the windows of `window` words, and whole shorter items, that occur."""

    def __init__(self, items: list[tuple], window: int = WINDOW) -> None:
        """items: (item_id, words)."""
        self.window = window
        self.ids: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.len = [-1], [0]
        coded = [(item, [self.ids.setdefault(w, len(self.ids)) for w in ws]) for item, ws in items if ws]
        for _, ws in coded:
            last = 0
            for w in ws:
                last = self._extend(last, w)
        self.items_at: dict[int, set] = {}
        self.short_at: dict[int, list[tuple[int, object]]] = {}
        shorts: dict[int, set[int]] = {}
        pairs = set()
        for item, ws in coded:
            pairs.update(zip(ws, ws[1:]))
            state, length = 0, 0
            for w in ws:
                state, length = self.step(state, length, w)
                if len(ws) >= window and length >= window:
                    self.items_at.setdefault(self._window_state(state), set()).add(item)
            if len(ws) < window:
                self.short_at.setdefault(state, []).append((len(ws), item))
                shorts.setdefault(len(ws), set()).add(tuple(ws))
        self.least = min((min(len(ws), window) for _, ws in coded), default=0)
        text = np.frombuffer(b" ".join(self.ids), np.uint8)
        starts, ends, _ = c.words(text, np.array([0, len(text)]))
        hashes = c.span_hash(text, starts, ends)
        self.bits = max(12, int(np.ceil(np.log2(8 * len(hashes) + 1))))
        self.slots = np.zeros(1 << self.bits, bool)
        self.slots[hashes >> np.uint64(64 - self.bits)] = True
        order = np.argsort(hashes)
        self.hashes, self.codes = hashes[order], order.astype(np.int64)
        self.pairs = np.array(sorted(a * len(self.ids) + b for a, b in pairs), np.int64)
        self.pair_bits = max(12, int(np.ceil(np.log2(8 * len(self.pairs) + 1))))
        self.pair_slots = np.zeros(1 << self.pair_bits, bool)
        self.pair_slots[self._pair_slot(self.pairs)] = True

    def _pair_slot(self, code: np.ndarray) -> np.ndarray:
        return c.mix(code.astype(np.uint64)) >> np.uint64(64 - self.pair_bits)

    def _extend(self, last: int, w: int) -> int:
        nxt, link, length = self.next, self.link, self.len
        if w in nxt[last]:
            q = nxt[last][w]
            return q if length[q] == length[last] + 1 else self._clone(last, w, q)
        new = len(nxt)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p != -1 and w not in nxt[p]:
            nxt[p][w] = new
            p = link[p]
        if p != -1:
            q = nxt[p][w]
            link[new] = q if length[q] == length[p] + 1 else self._clone(p, w, q)
        return new

    def _clone(self, p: int, w: int, q: int) -> int:
        nxt, link, length = self.next, self.link, self.len
        copy = len(nxt)
        nxt.append(dict(nxt[q]))
        link.append(link[q])
        length.append(length[p] + 1)
        link[q] = copy
        while p != -1 and nxt[p].get(w) == q:
            nxt[p][w] = copy
            p = link[p]
        return copy

    def step(self, state: int, length: int, w: int) -> tuple[int, int]:
        """The longest run of item words that ends with w."""
        while state and w not in self.next[state]:
            state = self.link[state]
            length = self.len[state]
        if w in self.next[state]:
            return self.next[state][w], length + 1
        return 0, 0

    def _window_state(self, state: int) -> int:
        while self.len[self.link[state]] >= self.window:
            state = self.link[state]
        return state

    def coded(self, hashes: np.ndarray) -> np.ndarray:
        """The code of each word, -1 for words of no item."""
        out = np.full(len(hashes), -1, np.int64)
        if len(self.hashes):
            maybe = np.flatnonzero(self.slots[hashes >> np.uint64(64 - self.bits)])
            at = np.minimum(np.searchsorted(self.hashes, hashes[maybe]), len(self.hashes) - 1)
            same = self.hashes[at] == hashes[maybe]
            out[maybe[same]] = self.codes[at[same]]
        return out

    def segments(self, codes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Maximal runs of words whose neighbours are neighbours in some item, `least` words at least; matches lie inside them."""
        known = codes >= 0
        both = np.flatnonzero(known[:-1] & known[1:])
        code = codes[both] * len(self.ids) + codes[both + 1]
        ok = np.flatnonzero(self.pair_slots[self._pair_slot(code)])
        at = np.minimum(np.searchsorted(self.pairs, code[ok]), max(0, len(self.pairs) - 1))
        joined = np.zeros(len(codes) + 1, bool)  # word i follows on word i - 1
        if len(self.pairs):
            joined[both[ok[self.pairs[at] == code[ok]]] + 1] = True
        joined[bounds] = False
        starts = np.flatnonzero(known & ~joined[:-1])
        ends = np.flatnonzero(known & ~joined[1:]) + 1
        long = ends - starts >= self.least
        return starts[long], ends[long]

    def stream(self, codes: list[int]) -> tuple[list[tuple[int, int]], set]:
        """Hit ranges [from, to) of word positions, and the items whose windows occur."""
        state = length = 0
        hits, found = [], set()
        for i, w in enumerate(codes):
            state, length = self.step(state, length, w)
            if length >= self.window:
                at = self._window_state(state)
                if at in self.items_at:
                    hits.append((i + 1 - self.window, i + 1))
                    found |= self.items_at[at]
            if self.short_at:
                up = state
                while up > 0:
                    for n, item in self.short_at.get(up, ()):
                        if n <= length:
                            hits.append((i + 1 - n, i + 1))
                            found.add(item)
                    up = self.link[up]
        return hits, found


def _only_block(items: DataFrame, id_col: str, text_col: str, window: int) -> Automaton | None:
    """The automaton of items that are one block, built on the driver; None if they are more."""
    size = items.agg(F.sum(F.octet_length(F.col(f"`{text_col}`")))).first()[0] or 0
    if size > BLOCK_BYTES:
        return None
    rows = items.where(F.col(f"`{text_col}`") != "").select(id_col, text_col).collect()
    return Automaton([("" if item is None else str(item), item_words(text)) for item, text in rows], window)


def run_hashes(hashes: np.ndarray, bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """A hash of every n consecutive words within each text: text, hash."""
    full = np.zeros(max(0, len(hashes) - n + 1), np.uint64)
    for k in range(n if len(full) else 0):
        full = full * c._BASE + hashes[k : k + len(full)]
    size = np.maximum(np.diff(bounds) - n + 1, 0)
    at = np.repeat(bounds[:-1] - np.cumsum(size) + size, size) + np.arange(size.sum())
    return np.repeat(np.arange(len(size)), size), c.mix(full[at] + np.uint64(n) * np.uint64(0xA24BAED4963EE407))


def _item_windows(items: DataFrame, window: int) -> DataFrame:
    """__item, __text, block -> block, n (words of the window) and hash, once each."""

    def run(batches):
        for batch in batches:
            texts, blocks = batch.column(batch.schema.get_field_index("__text")), batch.column(batch.schema.get_field_index("block"))
            for i, j in c.pieces(texts):
                data, offsets = c.utf8(texts.slice(i, j - i))
                starts, ends, bounds = c.words(data, offsets)
                hashes, counts = c.span_hash(data, starts, ends, lower=True), np.diff(bounds)
                for n in np.unique(np.minimum(counts, window)):
                    if n:
                        at, found = run_hashes(hashes, bounds, int(n))
                        own = (counts[at] == n) | (n == window)
                        yield pa.RecordBatch.from_arrays([blocks.take(pa.array(at[own] + i)), pa.array(np.full(own.sum(), n, np.int32)), pa.array(found[own].astype(np.int64))], names=["block", "n", "hash"])

    return items.mapInArrow(run, "block int, n int, hash long").distinct()


def _flags(windows: DataFrame) -> np.ndarray:
    """A table of flags, by the leading bits of a hash, of all windows. Parts of it are made by tasks; what comes here is of fixed size."""
    slot = F.shiftrightunsigned("hash", 64 - FLAG_BITS)
    slots = windows.select(F.shiftright(slot, PART_BITS).cast("int").alias("part"), slot.bitwiseAND((1 << PART_BITS) - 1).cast("int").alias("at")).distinct()

    def pack(table: pa.Table) -> pa.Table:
        bits = np.zeros(1 << PART_BITS, bool)
        bits[table.column("at").to_numpy()] = True
        return pa.table({"part": table.column("part").slice(0, 1), "bits": [np.packbits(bits).tobytes()]})

    out = np.zeros(1 << FLAG_BITS >> 3, np.uint8)
    step = 1 << PART_BITS >> 3
    for part, bits in slots.groupBy("part").applyInArrow(pack, "part int, bits binary").toLocalIterator():
        out[part * step : (part + 1) * step] = np.frombuffer(bits, np.uint8)
    return out


def _hits_by_blocks(docs: DataFrame, items: DataFrame, id_col: str, item_text: str, text_col: str, window: int) -> DataFrame:
    """__key (the md5 of a text), ranges (hit words [start, stop), merged) and items of every text that has a hit. The result is stashed."""
    size = items.agg(F.sum(F.octet_length(F.col(f"`{item_text}`")))).first()[0] or 0
    named = items.select(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("__item"), F.col(f"`{item_text}`").alias("__text")).where("__text <> ''")
    named = named.withColumn("block", F.pmod(F.xxhash64("__item", "__text"), F.lit(size // BLOCK_BYTES + 1)).cast("int"))
    windows = c.stash(_item_windows(named, window), "leaks-windows")
    shared = docs.sparkSession.sparkContext.broadcast((_flags(windows), [r.n for r in windows.select("n").distinct().collect()]))
    keyed = docs.select(F.unhex(F.md5(F.col(f"`{text_col}`"))).alias("__key"), F.col(f"`{text_col}`").alias("__text")).where("__text <> ''")

    def look(batches):
        flags, sizes = shared.value
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            for i, j in c.pieces(texts):
                data, offsets = c.utf8(texts.slice(i, j - i))
                starts, ends, bounds = c.words(data, offsets)
                hashes = c.span_hash(data, starts, ends, lower=True)
                found = [run_hashes(hashes, bounds, n) for n in sizes]
                doc, window_hash = np.concatenate([d for d, _ in found]), np.concatenate([h for _, h in found])
                slot = (window_hash >> np.uint64(64 - FLAG_BITS)).astype(np.int64)
                maybe = (flags[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8)) & 1 == 1
                doc, window_hash = doc[maybe], window_hash[maybe].astype(np.int64)
                order = np.argsort(doc, kind="stable")
                have, first = np.unique(doc[order], return_index=True)
                at = pa.array(have + i)
                lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(doc)).astype(np.int32)), pa.array(window_hash[order]))
                yield pa.RecordBatch.from_arrays([keys.take(at), texts.take(at), lists], names=["__key", "__text", "hashes"])

    seen = T.StructType([T.StructField("__key", T.BinaryType()), T.StructField("__text", T.StringType()), T.StructField("hashes", T.ArrayType(T.LongType()))])
    maybe = c.stash(keyed.mapInArrow(look, seen).dropDuplicates(["__key"]), "leaks-maybe")
    asked = maybe.select("__key", F.explode(F.array_distinct("hashes")).alias("hash"))
    counts = c.hold(asked.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).join(windows.select("hash").distinct(), "hash"))
    meet = c.spread_join(asked, windows.select("hash", "block").distinct(), ["hash"], counts, counts.agg(F.sum("n")).first()[0] or 0)
    meet = c.hold(meet.select("__key", "block").distinct())
    copies = meet.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / BLOCK_TEXTS).cast("int").alias("copies"))
    copies = c.hold(copies)
    texts = maybe.select("__key", "__text").join(meet.join(F.broadcast(copies), "block"), "__key")  # a row for each block: as few as there are MB of items
    texts = texts.select("block", F.pmod(F.xxhash64("__key"), F.col("copies")).cast("int").alias("copy"), F.lit(1).alias("kind"), F.col("__key"), F.lit("").alias("__item"), "__text")
    parts = named.join(F.broadcast(copies), "block").select("block", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"), F.lit(0).alias("kind"), F.lit(b"").alias("__key"), "__item", "__text")
    n_tasks = max(1, copies.agg(F.sum("copies")).first()[0] or 0)

    def stream(batches):
        here, known, scan = None, [], None
        for batch in batches:
            block, copy, kind, keys, names, said = batch.columns
            where = np.stack([block.to_numpy(), copy.to_numpy()], 1)
            kinds = kind.to_numpy()
            change = np.flatnonzero(np.any(where[1:] != where[:-1], 1) | (kinds[1:] != kinds[:-1])) + 1
            for i, j in zip([0, *change], [*change, batch.num_rows]):
                if i == j:
                    continue
                if here != tuple(where[i]):
                    here, known, scan = tuple(where[i]), [], None
                if kinds[i] == 0:
                    known += [(x, item_words(t)) for x, t in zip(names.slice(i, j - i).to_pylist(), said.slice(i, j - i).to_pylist())]
                    continue
                scan = scan or _scan([Automaton(known, window)])
                own = said.slice(i, j - i)
                for a, z in c.pieces(own):
                    merged = scan(own.slice(a, z - a))[-1]
                    at = pa.array([i + a + d for d in merged], pa.int64())
                    ranges = [[{"start": int(x), "stop": int(y)} for x, y in r] for r, _ in merged.values()]
                    yield pa.RecordBatch.from_arrays([keys.take(at), pa.array(ranges, RANGES), pa.array([sorted(x) for _, x in merged.values()], pa.list_(pa.string()))], names=["__key", "ranges", "items"])

    c.small_batches(docs.sparkSession)
    rows = texts.unionByName(parts).repartition(n_tasks, "block", "copy").sortWithinPartitions("block", "copy", "kind")
    found = rows.mapInArrow(stream, "__key binary, ranges array<struct<start: int, stop: int>>, items array<string>")
    whole = found.groupBy("__key").agg(F.array_sort(F.flatten(F.collect_list("ranges"))).alias("ranges"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))
    out = c.stash(whole, "leaks-found")
    c.release(counts, meet, copies)
    c.discard(windows, maybe)
    return out


RANGES = pa.list_(pa.struct([pa.field("start", pa.int32()), pa.field("stop", pa.int32())]))


def _joined(ranges: list[tuple[int, int]]) -> list[list[int]]:
    """Ranges that touch or overlap as one."""
    out: list[list[int]] = []
    for a, z in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1][1] = max(z, out[-1][1])
        else:
            out.append([a, z])
    return out


def _with_hits(docs: DataFrame, found: DataFrame, text_col: str) -> DataFrame:
    """docs with __ranges and __items of their text's hits (null for none). Texts of very many copies are dealt to several tasks."""
    keyed = docs.withColumn("__key", F.unhex(F.md5(F.col(f"`{text_col}`"))))
    hit = F.broadcast(found.select("__key")) if found.count() <= 100_000 else found.select("__key")
    counts = c.hold(keyed.select("__key").join(hit, "__key").groupBy("__key").agg(F.count(F.lit(1)).alias("n")))
    rows = counts.agg(F.sum("n")).first()[0] or 0
    return c.spread_join(keyed, found.select("__key", F.col("ranges").alias("__ranges"), F.col("items").alias("__items")), ["__key"], counts, rows, "left").drop("__key")


def scanner(shared):
    """A broadcast automaton -> texts -> their bytes, the words' byte bounds, the numbers of words, and by document the merged hit ranges of
    words and the items."""
    ready: list = []

    def scan(texts: pa.Array):
        if not ready:
            auto = Automaton.__new__(Automaton)
            vars(auto).update(shared.value)
            ready.append(_scan([auto]))
        return ready[0](texts)

    return scan


def _scan(automata: list[Automaton]):
    def scan(texts: pa.Array):
        data, offsets = c.utf8(texts)
        starts, ends, bounds = c.words(data, offsets)
        hashes = c.span_hash(data, starts, ends, lower=True)
        hits: dict[int, list] = {}
        for auto in automata:
            codes = auto.coded(hashes)
            for s, e in zip(*auto.segments(codes, bounds)):
                found, items = auto.stream(codes[s:e].tolist())
                if found:
                    d = int(np.searchsorted(bounds, s, "right")) - 1
                    ranges, known = hits.setdefault(d, [[], set()])
                    ranges += [(a + s - bounds[d], z + s - bounds[d]) for a, z in found]
                    known |= items
        return data, offsets, starts, ends, bounds, {d: (_joined(ranges), items) for d, (ranges, items) in hits.items()}

    return scan


def flag(docs: DataFrame, items: DataFrame, id_col: str = "item_id", item_text: str = "text", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Append n_words, n_hit, n_items, items_sha256 and contaminated to every row of docs.

    Null or empty text: no words, not contaminated, the hash of the empty string. Repeated rows are judged alike; items that share
    an id count once; a null item_id counts as the empty string. Input columns of these names are replaced. Empty tables: no rows, or no hits.
    Items of up to BLOCK_BYTES of text are broadcast as one automaton; more are dealt to blocks that meet candidates only, so that no machine
    holds more than one block's automaton at a time."""
    only, empty = _only_block(items, id_col, item_text, window), c.sha256_hex(b"")

    def judged(n_words: np.ndarray, merged: dict) -> list[pa.Array]:
        n = len(n_words)
        n_hit, n_items, sha = np.zeros(n, np.int64), np.zeros(n, np.int64), [empty] * n
        for d, (ranges, found) in merged.items():
            n_hit[d] = sum(z - a for a, z in ranges)
            n_items[d] = len(found)
            sha[d] = c.sha256_hex(",".join(sorted(found)).encode())
        return [pa.array(n_words, pa.int64()), pa.array(n_hit), pa.array(n_items), pa.array(sha), pa.array(n_hit > 0)]

    added = [("n_words", T.LongType()), ("n_hit", T.LongType()), ("n_items", T.LongType()), ("items_sha256", T.StringType()), ("contaminated", T.BooleanType())]
    if only is not None:
        scan = scanner(docs.sparkSession.sparkContext.broadcast(vars(only)))

        def make(texts: pa.Array) -> list[pa.Array]:
            *_, bounds, merged = scan(texts)
            return judged(np.diff(bounds), merged)

        return c.mapped(docs, added, make, text_col)
    found = _hits_by_blocks(docs, items, id_col, item_text, text_col, window)

    def combine(texts: pa.Array, ranges: pa.Array, names: pa.Array) -> list[pa.Array]:
        data, offsets = c.utf8(texts)
        *_, bounds = c.words(data, offsets)
        return judged(np.diff(bounds), _listed(ranges, names))

    kept, _ = c.with_columns(docs, added)
    return c.mapped(_with_hits(kept, found, text_col), added, combine, text_col, "__ranges", "__items").drop("__ranges", "__items")


def _listed(ranges: pa.Array, names: pa.Array) -> dict:
    return {d: (_joined([(x["start"], x["stop"]) for x in r]), set(k)) for d, (r, k) in enumerate(zip(ranges.to_pylist(), names.to_pylist())) if r}


def remove(docs: DataFrame, items: DataFrame, id_col: str = "item_id", item_text: str = "text", text_col: str = "text", window: int = WINDOW, max_coverage: float = 0.5) -> DataFrame:
    """docs with every hit run of words cut out of the text; a document of which more than max_coverage of the words is hit goes.

    A cut takes the bytes from the first hit word to the end of the last, and one space stands for it. Texts without hits stay byte for byte;
    null stays null. Cutting is repeated until no window is left, as the words on both sides of a cut can make a new one."""
    only = _only_block(items, id_col, item_text, window)

    def cut(texts: pa.Array, merged: dict, data, offsets, starts, ends, bounds) -> list[str | None]:
        """The texts without their hits; None where the text goes."""
        out = texts.to_pylist()
        for d, (ranges, _) in merged.items():
            if sum(z - a for a, z in ranges) > max_coverage * (bounds[d + 1] - bounds[d]):
                out[d] = None
                continue
            kept, at = [], offsets[d]
            for a, z in ranges:
                kept.append(data[at : starts[bounds[d] + a]].tobytes())
                at = ends[bounds[d] + z - 1]
            kept.append(data[at : offsets[d + 1]].tobytes())
            out[d] = b" ".join(kept).decode("utf-8", "surrogatepass")
        return out

    names = docs.columns
    added = [("__text", T.StringType()), ("__gone", T.BooleanType())]

    def result(new: list, texts: pa.Array, merged: dict) -> list[pa.Array]:
        return [pa.array(new, pa.string()), pa.array([a is None and b for a, b in zip(new, texts.is_valid().to_pylist())], pa.bool_())]

    if only is not None:
        scan = scanner(docs.sparkSession.sparkContext.broadcast(vars(only)))

        def make(texts: pa.Array) -> list[pa.Array]:
            *where, merged = scan(texts)
            new, again = cut(texts, merged, *where), sorted(merged)
            while again := [d for d in again if new[d] is not None]:
                rest = pa.array([new[d] for d in again], pa.large_string())
                *where, merged = scan(rest)
                for k, t in enumerate(cut(rest, merged, *where)):
                    new[again[k]] = t
                again = [again[k] for k in sorted(merged)]
            return result(new, texts, merged)

        out = c.mapped(docs, added, make, text_col).where(~F.col("__gone"))
        return out.select(*[F.col("__text").alias(n) if n == text_col else F.col(f"`{n}`") for n in names])

    def make_listed(texts: pa.Array, ranges: pa.Array, found: pa.Array) -> list[pa.Array]:
        data, offsets = c.utf8(texts)
        merged = _listed(ranges, found)
        return result(cut(texts, merged, data, offsets, *c.words(data, offsets)), texts, merged)

    rest, done = docs, []
    while True:  # only texts that were cut are looked at again
        found = _hits_by_blocks(rest, items, id_col, item_text, text_col, window)
        joined = c.mapped(_with_hits(rest, found, text_col), added, make_listed, text_col, "__ranges", "__items")
        joined = joined.select(*[F.col("__text").alias(n) if n == text_col else F.col(f"`{n}`") for n in names], F.col("__ranges").isNotNull().alias("__hit"), "__gone")
        joined = c.stash(joined.where(~F.col("__gone")).drop("__gone"), "leaks-cut")
        done.append(joined.where(~F.col("__hit")).drop("__hit"))
        rest = joined.where("__hit").drop("__hit")
        if rest.isEmpty():
            return reduce(DataFrame.unionByName, done)


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits of every document with the benchmark's items."""
    docs = c.table(spark, sf_dir, "documents").select("doc_id", "text")
    out = flag(docs, c.table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


#: DuckDB: every window as words joined by spaces, so that a run of words is a window if the strings are equal.
OP7_SQL = r"""
WITH iw AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10 + 1, 1) + 1)) AS i FROM iw WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
runs AS (
  SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, sizes WHERE len(w) >= n),
found AS (
  SELECT r.doc_id, r.i, r.n, win.item_id
  FROM (SELECT doc_id, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS g FROM runs) r JOIN win ON r.g = win.g AND r.n = win.n),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id)
SELECT dw.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)
"""
