"""Line dedup by winnowing: of the grams in each window the least is a fingerprint; positions of equal fingerprints are joined, matches extended both ways, and later repeats deleted."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common as c

#: Words of a window, and so of the shortest run of lines that is found for certain and deleted.
MIN_WORDS = 50
#: Words of a gram, the shortest run of lines whose hash can be a fingerprint: a line that is common by itself and shorter is none.
GRAM_WORDS = 16
_STEP = np.uint64(0x9E3779B97F4A7C15)


def lines(texts: pa.Array) -> tuple[np.ndarray, ...]:
    """Lines with words, of all texts: hash, number of words, number of the line in its text; then their bounds by text, the bytes, and where all lines start and end, with bounds."""
    data, offsets = c.utf8(texts)
    breaks = np.flatnonzero(data == 10)
    starts, ends = np.sort(np.concatenate([offsets[:-1], breaks + 1])), np.sort(np.concatenate([breaks, offsets[1:]]))
    all_bounds = np.concatenate([[0], np.cumsum(np.diff(np.searchsorted(breaks, offsets)) + 1)]) if len(texts) else np.zeros(1, np.int64)
    word_starts, _, _ = c.words(data, offsets)
    n_words = np.searchsorted(word_starts, ends) - np.searchsorted(word_starts, starts)
    full = np.flatnonzero(n_words > 0)
    number = full - np.repeat(all_bounds[:-1], np.diff(all_bounds))[full]
    return c.span_hash(data, starts[full], ends[full]), n_words[full], number, np.searchsorted(full, all_bounds), data, starts, ends, all_bounds


def _runs(total: np.ndarray, size: int, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """From each line on the shortest run of `size` words: where it ends (beyond all lines if there is none), and the sums that digests are made of."""
    stop = np.searchsorted(total, total[:-1] + size)
    up, _ = c._power(len(hashes) + 1)
    return stop, np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * up[: len(hashes)], dtype=np.uint64)])


def _digest(sums: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    _, down = c._power(len(sums))
    return c.mix(c.mix((sums[stop] - sums[start]) * down[start]) ^ (stop - start).astype(np.uint64))


def fingerprints(hashes: np.ndarray, n_words: np.ndarray, bounds: np.ndarray, min_words: int = MIN_WORDS, gram_words: int = GRAM_WORDS) -> tuple[np.ndarray, ...]:
    """Winnowing: a window is the shortest run of lines from a line on that has min_words words, a gram that of gram_words; of the grams within
    a window the one of least hash (the last of equals) is its fingerprint. Neighbouring windows mostly share theirs.

    Returns of each fingerprint its text, key (the gram's hash), position and a digest of its surroundings, which are all the windows that chose
    it; and of each window its digest and the number of its fingerprint. Two texts that share a window share its fingerprint, in the same place
    of the window; fingerprints of equal surroundings were chosen by the same windows."""
    total = np.concatenate([[0], np.cumsum(n_words)])
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    stop, sums = _runs(total, min_words, hashes)
    at = np.flatnonzero(stop <= bounds[1:][doc])
    if not len(at):
        return (np.zeros(0, np.int64),) * 6
    gram_stop, _ = _runs(total, min(gram_words, min_words), hashes)
    grams = _digest(sums, np.arange(len(hashes)), np.minimum(gram_stop, len(hashes)))
    stop = stop[at]
    last = np.searchsorted(gram_stop, stop, "right")  # grams up to this one end within the window
    best, where = grams[at], at.copy()
    k, going = 1, np.flatnonzero(last - at > 1)
    while len(going):
        h = grams[at[going] + k]
        less = going[h <= best[going]]
        best[less], where[less] = grams[at[less] + k], at[less] + k
        k += 1
        going = going[last[going] - at[going] > k]
    windows = _digest(sums, at, stop)
    first = np.flatnonzero(np.diff(where, prepend=-1))  # windows that choose a fingerprint lie side by side
    number = np.cumsum(np.diff(where, prepend=-1) != 0) - 1
    end = np.append(first[1:], len(at)) - 1
    place = where[first]
    around = c.mix(_digest(sums, at[first], stop[end]) ^ (place - at[first]).astype(np.uint64) * _STEP)
    return doc[place], best[first].astype(np.int64), place - bounds[doc[place]], around.astype(np.int64), windows.astype(np.int64), number


def _profiled(rows: DataFrame, min_words: int) -> DataFrame:
    """__id, __k1, __k2, __text -> without the text, with hashes and sizes of lines, the fingerprints' keys, places and surroundings, and the
    windows' digests with the key and place of their fingerprint."""
    names = ["__id", "__k1", "__k2"]
    lists = [("keys", T.LongType()), ("places", T.IntegerType()), ("around", T.LongType()), ("windows", T.LongType()), ("chosen", T.LongType()), ("chosen_at", T.IntegerType())]

    def run(batches):
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("__text"))
            rest = batch.select(names)
            for i, j in c.pieces(texts):
                hashes, n_words, _, bounds, *_ = lines(texts.slice(i, j - i))
                doc, key, at, around, windows, number = fingerprints(hashes, n_words, bounds, min_words)
                cut = np.searchsorted(doc, np.arange(j - i + 1)).astype(np.int32)
                cut_windows = np.searchsorted(doc[number], np.arange(j - i + 1)).astype(np.int32)
                own = [(hashes[a:b].tobytes(), n_words[a:b].astype("<i4").tobytes()) for a, b in zip(bounds, bounds[1:])]
                at = at.astype(np.int32)
                new = [pa.array([h for h, _ in own], pa.binary()), pa.array([w for _, w in own], pa.binary())]
                new += [pa.ListArray.from_arrays(pa.array(cut), pa.array(x)) for x in (key, at, around)]
                new += [pa.ListArray.from_arrays(pa.array(cut_windows), pa.array(x)) for x in (windows, key[number], at[number])]
                yield pa.RecordBatch.from_arrays([*rest.slice(i, j - i).columns, *new], names=[*names, "lines", "sizes", *(x for x, _ in lists)])

    fields = [rows.schema[n] for n in names]
    fields += [T.StructField("lines", T.BinaryType()), T.StructField("sizes", T.BinaryType()), *(T.StructField(x, T.ArrayType(t)) for x, t in lists)]
    return rows.mapInArrow(run, T.StructType(fields))


def _meetings(marks: DataFrame, key: str) -> DataFrame:
    """marks: __id, __k1, __k2, at and a key. Of each key with several places: those but the first, with the first (s1, s2, source)."""
    first = F.struct(F.col("first.k1").alias("k1"), F.col("first.k2").alias("k2"), F.col("first.at").alias("at"))
    firsts = _firsts(marks, key).where("n > 1").select(key, "n", first.alias("first"))
    return _met(marks, c.hold(firsts), key)


def _firsts(marks: DataFrame, key: str, *more) -> DataFrame:
    place = F.struct(F.col("__id").isNull().alias("last"), F.col("__id").alias("id"), F.col("__k1").alias("k1"), F.col("__k2").alias("k2"), F.col("at").alias("at"))
    return marks.groupBy(key).agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"), *more)


def _met(marks: DataFrame, firsts: DataFrame, key: str) -> DataFrame:
    """marks that are not the first places (k1, k2, at) of their keys, with those; the result is held, and firsts are released."""
    rows = firsts.agg(F.sum("n")).first()[0] or 0
    met = c.spread_join(marks.select("__k1", "__k2", key, "at"), firsts.select(key, "first"), [key], firsts.select(key, "n"), rows)
    met = met.where("NOT (__k1 = first.k1 AND __k2 = first.k2 AND at = first.at)")
    out = c.hold(met.select("__k1", "__k2", "at", F.col("first.k1").alias("s1"), F.col("first.k2").alias("s2"), F.col("first.at").alias("source")))
    c.release(firsts)
    return out


def extended(own: np.ndarray, other: np.ndarray, sizes: np.ndarray, at: int, source: int) -> tuple[int, int]:
    """The longest run of own around `at` that equals the run of other around `source`: [from, to)."""
    back = min(at, source)
    differ = np.flatnonzero(own[at - back : at][::-1] != other[source - back : source][::-1])
    start = at - (differ[0] if len(differ) else back)
    ahead = min(len(own) - at, len(other) - source)
    differ = np.flatnonzero(own[at : at + ahead] != other[source : source + ahead])
    return int(start), int(at + (differ[0] if len(differ) else ahead))


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """Runs of lines to delete: __k1, __k2 (the text's row key) and runs, an array of [from, to) over its lines with words.

    Texts are in the order of their ids (null last), and of a digest of the text where ids are equal. A run of lines with words, min_words
    words in all at least, is deleted if a window in it has an earlier place, in that order or in the same text, and the lines around are
    equal to those around the window's first place as far as the run goes. First places themselves stay unless they repeat an earlier one.

    Positions are joined by fingerprints. Most fingerprints that occur again have the same surroundings everywhere, so their first place is
    that of all their windows. Those with different surroundings (a licence's line, say) are told apart by the digests of their windows, so that
    no place hides a passage that begins elsewhere; keys of very many places are dealt to several tasks."""
    c.small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("__id"), *_row_key(id_col, text_col), F.col(text_col).alias("__text")).where("__text IS NOT NULL")
    profile = c.stash(_profiled(rows, min_words), "lines-profile")
    exploded = lambda *names: profile.select("__id", "__k1", "__k2", F.explode(F.arrays_zip(*names)).alias("m"))
    marks = exploded("keys", "places", "around").select("__id", "__k1", "__k2", F.col("m.keys").alias("key"), F.col("m.places").alias("at"), F.col("m.around").alias("around"))
    firsts = c.hold(_firsts(marks, "key", F.min("around").alias("low"), F.max("around").alias("high")).where("n > 1").select("key", "n", "low", "high", F.struct("first.k1", "first.k2", "first.at").alias("first")))
    alike, mixed = c.hold(firsts.where("low = high").select("key", "n", "first")), c.hold(firsts.where("low <> high").select("key", "n"))
    c.release(firsts)
    windows = exploded("windows", "chosen", "chosen_at").select("__id", "__k1", "__k2", F.col("m.windows").alias("window"), F.col("m.chosen").alias("key"), F.col("m.chosen_at").alias("at"))
    many = mixed.agg(F.sum("n")).first()[0] or 0
    # of a mixed key some windows are chosen together: they are as many as its marks, at least, so its share of them is estimated by those
    windows = c.hold(c.spread_join(windows, mixed.select("key"), ["key"], mixed, many).drop("key"))
    met, again = _met(marks, alike, "key"), _meetings(windows, "window")
    # one meeting on each diagonal of two texts is enough for neighbouring ones that lie in the same run, but runs may be apart: all are carried
    sides = met.union(again).groupBy("__k1", "__k2", "s1", "s2", (F.col("at") - F.col("source")).alias("shift")).agg(F.collect_set("at").alias("at"))
    sides = c.hold(sides)
    c.release(met, again, windows, mixed)
    profiles = profile.select("__k1", "__k2", "lines", "sizes").dropDuplicates(["__k1", "__k2"])
    wanted = sides.select("__k1", "__k2").union(sides.select(F.col("s1").alias("__k1"), F.col("s2").alias("__k2"))).distinct()
    profiles = c.hold(profiles.join(wanted, ["__k1", "__k2"]))
    others = profiles.select(F.col("__k1").alias("s1"), F.col("__k2").alias("s2"), F.col("lines").alias("others"))
    sources = c.hold(sides.groupBy("s1", "s2").agg(F.count(F.lit(1)).alias("n")))
    met = sides
    sides = c.spread_join(sides.join(profiles, ["__k1", "__k2"]), others, ["s1", "s2"], sources, sides._rows)

    def run(batches):
        for batch in batches:
            k1, k2, shifts, ats, mine, sizes, others = (batch.column(batch.schema.get_field_index(x)) for x in ("__k1", "__k2", "shift", "at", "lines", "sizes", "others"))
            rows, starts, stops = [], [], []
            for r in range(batch.num_rows):
                own, other, n_words = np.frombuffer(mine[r].as_buffer(), "<u8"), np.frombuffer(others[r].as_buffer(), "<u8"), np.frombuffer(sizes[r].as_buffer(), "<i4")
                shift, done = shifts[r].as_py(), -1
                for at in sorted(ats[r].as_py()):
                    if at < done:
                        continue
                    start, done = extended(own, other, n_words, at, at - shift)
                    if n_words[start:done].sum() >= min_words:
                        rows.append(r)
                        starts.append(start)
                        stops.append(done)
            yield pa.RecordBatch.from_arrays([k1.take(pa.array(rows, pa.int64())), k2.take(pa.array(rows, pa.int64())), pa.array(starts, pa.int32()), pa.array(stops, pa.int32())], names=["__k1", "__k2", "start", "stop"])

    found = sides.select("__k1", "__k2", "shift", "at", "lines", "sizes", "others").mapInArrow(run, "__k1 long, __k2 long, start int, stop int")
    runs = c.stash(found.groupBy("__k1", "__k2").agg(F.collect_set(F.struct("start", "stop")).alias("runs")), "lines-runs")
    c.release(met, profiles, sources)
    c.discard(profile)
    return runs


def _row_key(id_col: str, text_col: str) -> list:
    """128 bits for an id with its text."""
    pair = F.struct(F.col(id_col).alias("i"), F.col(text_col).alias("t"))
    return [F.xxhash64(F.lit(1), pair).alias("__k1"), F.xxhash64(F.lit(2), pair, F.lit(3)).alias("__k2")]


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """docs with the repeated runs (see repeats) deleted from the text, and n_lines (all lines of the text) and n_removed appended.

    A run goes from the first of its lines to the last, with lines without words between them; the lines that stay are joined by line feeds.
    A text of which nothing is deleted stays byte for byte. Null stays null (no lines). Rows that share id and text are one document and get
    the same text; an empty table gives no rows; input columns named n_lines or n_removed are replaced."""
    runs = repeats(docs, id_col, text_col, min_words)
    k1, k2 = _row_key(id_col, text_col)
    keyed = docs.withColumns({"__k1": k1, "__k2": k2})
    joined = keyed.join(runs.hint("merge"), ["__k1", "__k2"], "left")  # runs grow with the corpus: no broadcast at any size

    added = [("n_lines", T.LongType()), ("n_removed", T.LongType())]
    kept, _ = c.with_columns(joined.drop("__k1", "__k2", "runs"), added)
    out_names = kept.columns
    kept = joined.select(*[F.col(f"`{n}`") for n in out_names], F.col("runs").alias("__runs"))
    schema = T.StructType([*[f for f in kept.schema.fields if f.name != "__runs"], *(T.StructField(n, t) for n, t in added)])
    where = out_names.index(text_col)

    def run(batches):
        for batch in batches:
            for i, j in c.pieces(batch.column(where)):
                part = batch.slice(i, j - i)
                texts, marks = part.column(where), part.column(part.num_columns - 1)
                _, _, number, bounds, data, starts, ends, all_bounds = lines(texts)
                new, removed = texts.to_pylist(), np.zeros(j - i, np.int64)
                for d in np.flatnonzero(marks.is_valid().to_numpy(zero_copy_only=False)):
                    own, first = number[bounds[d] : bounds[d + 1]], all_bounds[d]
                    gone = np.zeros(all_bounds[d + 1] - first, bool)
                    for m in marks[int(d)].as_py():
                        gone[own[m["start"]] : own[m["stop"] - 1] + 1] = True
                    new[d] = b"\n".join(data[starts[first + x] : ends[first + x]].tobytes() for x in np.flatnonzero(~gone)).decode("utf-8", "surrogatepass")
                    removed[d] = gone.sum()
                n_lines = np.where(texts.is_valid().to_numpy(zero_copy_only=False), np.diff(all_bounds), 0)
                columns = part.columns[:-1]
                columns[where] = pa.array(new, texts.type)
                yield pa.RecordBatch.from_arrays([*columns, pa.array(n_lines, pa.int64()), pa.array(removed)], names=[*part.schema.names[:-1], "n_lines", "n_removed"])

    return kept.mapInArrow(run, schema)


def op6_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the runs of lines that an earlier one has."""
    docs = c.table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_removed", "text")


#: DuckDB: windows as strings, their first places, and the islands of equal lines on the diagonal of each meeting.
OP6_SQL = f"""
WITH raw AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS number FROM documents),
counted AS (SELECT doc_id, number, line, len({c.words_sql("line")}) AS words FROM raw),
own AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY number) AS p, sum(words) OVER (PARTITION BY doc_id ORDER BY number) AS upto FROM counted WHERE words > 0),
ends AS (SELECT a.doc_id, a.p, min(b.p) AS q FROM own a JOIN own b ON b.doc_id = a.doc_id AND b.p >= a.p AND b.upto >= a.upto - a.words + {MIN_WORDS} GROUP BY 1, 2),
spans AS (SELECT e.doc_id, e.p, string_agg(o.line, chr(10) ORDER BY o.p) AS window_text FROM ends e JOIN own o ON o.doc_id = e.doc_id AND o.p BETWEEN e.p AND e.q GROUP BY 1, 2),
firsts AS (SELECT *, first_value(doc_id) OVER w AS d0, first_value(p) OVER w AS p0 FROM spans WINDOW w AS (PARTITION BY window_text ORDER BY doc_id, p)),
met AS (SELECT doc_id, p, d0, p - p0 AS shift FROM firsts WHERE doc_id <> d0 OR p <> p0),
diagonals AS (SELECT DISTINCT doc_id, d0, shift FROM met),
alike AS (SELECT g.doc_id, g.d0, g.shift, a.p, a.words, a.number FROM diagonals g JOIN own a ON a.doc_id = g.doc_id JOIN own b ON b.doc_id = g.d0 AND b.p = a.p - g.shift AND b.line = a.line),
islands AS (SELECT *, p - row_number() OVER (PARTITION BY doc_id, d0, shift ORDER BY p) AS island FROM alike),
runs AS (SELECT doc_id, d0, shift, min(p) AS lo, max(p) AS hi, min(number) AS first_line, max(number) AS last_line FROM islands GROUP BY doc_id, d0, shift, island HAVING sum(words) >= {MIN_WORDS}),
cut AS (SELECT DISTINCT r.doc_id, r.first_line, r.last_line FROM runs r JOIN met m ON m.doc_id = r.doc_id AND m.d0 = r.d0 AND m.shift = r.shift AND m.p BETWEEN r.lo AND r.hi),
marked AS (SELECT c.doc_id, c.number, c.line, EXISTS (SELECT 1 FROM cut WHERE cut.doc_id = c.doc_id AND c.number BETWEEN cut.first_line AND cut.last_line) AS gone FROM counted c),
done AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed, coalesce(string_agg(line, chr(10) ORDER BY number) FILTER (NOT gone), '') AS text FROM marked GROUP BY 1)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, x.text FROM documents d LEFT JOIN done x USING (doc_id)
"""
