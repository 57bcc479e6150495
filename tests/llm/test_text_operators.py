"""Operators on texts against brute force, and their edge cases."""

import collections
import hashlib
import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import types as T

from lectern.llm import bpe, common, decontaminate, lines, minhash, quality, token_counts

WORDS = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
EDGES = [None, "", " \n\n", "one", "one two three four", "Ünïcode wörds ß ǅ 漢字 here", "a " * 30000, "!!! ### |", "x\x00y", "line\nline\nline", "tail\n"]


def words_of(text):
    return WORDS.findall((text or "").encode().lower())


def frame(spark, rows, id_type="long"):
    return spark.createDataFrame(rows, f"doc_id {id_type}, text string")


def edge_frame(spark):
    """Null ids and texts, repeated rows, clashing column names."""
    rows = [(i, t, i, "x") for i, t in enumerate(EDGES)] + [(None, "no id", 0, "y"), (None, "no id", 0, "y"), (1, "", 1, "x"), (3, "one", 3, "z"), (99, "one", 3, "z")]
    return spark.createDataFrame(rows, "doc_id long, text string, N_TOKENS int, keep string")


def random_text(rng, vocabulary, n):
    out = [rng.choice(vocabulary) for _ in range(n)]
    return "".join(w + rng.choice([" ", " ", " ", ", ", "\n", ". "]) for w in out)


def test_words_and_hashes_follow_the_pattern():
    texts = [t for t in EDGES if t is not None] + ["A-b_c", "né", "n", "é"]
    data, offsets = common.utf8(pa.array(texts))
    starts, ends, bounds = common.words(data, offsets)
    got = [bytes(common.LOWER[data[s:e]]) for s, e in zip(starts, ends)]
    want = [words_of(t) for t in texts]
    assert got == list(itertools.chain(*want))
    assert np.diff(bounds).tolist() == [len(w) for w in want]
    hashes = common.span_hash(data, starts, ends, lower=True)
    assert len(set(hashes.tolist())) == len(set(got))


def test_utf8_honours_slices_and_nulls():
    column = pa.array(["aa", None, "bé", "c"]).slice(1, 3)
    data, offsets = common.utf8(column)
    assert bytes(data) == "béc".encode() and offsets.tolist() == [0, 0, 3, 4]
    assert list(common.pieces(pa.array(["ab", "cd", "e" * 10, "f"]), 4)) == [(0, 2), (2, 3), (3, 4)]
    assert list(common.pieces(pa.array([], pa.string()))) == []


# decontamination


def brute_hits(text, items, window=10):
    ws = words_of(text)
    hit, found = set(), set()
    for item, t in items:
        iw = words_of(t)
        n = min(window, len(iw))
        if not n:
            continue
        grams = {tuple(iw[k : k + n]) for k in range(len(iw) - n + 1)}
        for k in range(len(ws) - n + 1):
            if tuple(ws[k : k + n]) in grams:
                hit |= set(range(k, k + n))
                found.add(str(item))
    return len(ws), len(hit), sorted(found)


@pytest.mark.parametrize("block_bytes", [decontaminate.BLOCK_BYTES, 30])
def test_decontamination_equals_brute_force(spark, block_bytes, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(common, "HOT_ROWS", 1)
    rng = random.Random(5)
    vocabulary = ["the", "of", "Ä", "b2", "c", "dd"]
    items = [(k, random_text(rng, vocabulary, rng.choice([0, 1, 3, 9, 10, 11, 25]))) for k in range(12)] + [(100, None), (3, "the of c"), (7, "solo")]
    docs = [(k, random_text(rng, vocabulary + ["zz"] * (k % 3), rng.randint(0, 120))) for k in range(40)]
    docs += [(50 + k, "start " + (items[k][1] or "") + " end") for k in range(12)] + [(70, None), (71, ""), (70, None)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.flag(frame(spark, docs), bench).collect()
    for r, (i, t) in zip(sorted(got, key=lambda r: (r.doc_id, r.text or "")), sorted(docs, key=lambda d: (d[0], d[1] or ""))):
        n, hit, found = brute_hits(t, items)
        sha = hashlib.sha256(",".join(found).encode()).hexdigest()
        assert (r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == (i, n, hit, len(found), sha, hit > 0)


def test_decontamination_by_a_hundred_blocks(spark, monkeypatch):
    """As by one automaton, with texts that meet several blocks, copies of a text, and blocks whose texts are dealt to several tasks."""
    rng = random.Random(8)
    vocabulary = [f"w{k}" for k in range(40)]
    items = [(k, random_text(rng, vocabulary, rng.choice([4, 12, 30, 60]))) for k in range(250)]
    pieces = [" ".join(t.split()[:14]) for _, t in items]
    docs = [(k, " ".join([random_text(rng, vocabulary, 30), *rng.sample(pieces, k % 5), random_text(rng, vocabulary, 20)])) for k in range(120)]
    docs += [(200 + k, docs[3][1]) for k in range(50)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = lambda df: sorted(map(tuple, df.collect()))
    flagged, left = rows(decontaminate.flag(frame(spark, docs), bench)), rows(decontaminate.remove(frame(spark, docs), bench))
    size = sum(len(t) for _, t in items)
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", size // 100)
    monkeypatch.setattr(decontaminate, "BLOCK_TEXTS", 3)
    assert rows(decontaminate.flag(frame(spark, docs), bench)) == flagged and sum(r[-1] for r in flagged) > 50
    assert rows(decontaminate.remove(frame(spark, docs), bench)) == left


def test_decontamination_removes_passages_and_keeps_clean_texts(spark):
    item = " ".join(f"w{k}" for k in range(14))
    docs = [(1, "Before, it. " + item + "! After it a tail of its own words that goes on and on for long enough to stay."), (2, "clean  text\n"), (3, item), (4, None)]
    out = {r.doc_id: r.text for r in decontaminate.remove(frame(spark, docs), spark.createDataFrame([(1, item)], "item_id long, text string")).collect()}
    assert out == {1: "Before, it.  ! After it a tail of its own words that goes on and on for long enough to stay.", 2: "clean  text\n", 4: None}


def test_decontamination_edges(spark):
    empty = spark.createDataFrame([], "item_id long, text string")
    got = decontaminate.flag(edge_frame(spark), empty)
    assert got.count() == len(EDGES) + 5 and got.where("contaminated").count() == 0
    assert decontaminate.flag(frame(spark, []), empty).count() == 0


# BPE


@pytest.fixture(scope="module")
def library():
    tokenizers = pytest.importorskip("tokenizers")
    import public_tokenizers

    return tokenizers.Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def test_bpe_equals_the_library(library):
    rng = random.Random(1)
    parts = ["a", "E", "é", "é", "Σ", "ς", "İ", "ß", "1", "²", "½", "'s", "'LL", "_", "\x1c", "\x85", "\xa0", " ", "\n", "<|endoftext|>", "<|startoftext|>", "😀", "漢", "-", "...", "​", "ǅ", "ﬁ", "</w>", "\x00", "ा", "Ⅷ", "the", "ing", "K"]
    texts = [t or "" for t in EDGES] + ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(1500)]
    model = bpe.WordBpe(bpe.read_vocabulary())
    for text, (ids, said) in zip(texts, model.encode(texts)):
        want = library.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == want, repr(text)
        assert said == library.decode(want, skip_special_tokens=False)
    assert 0 < model.merged < model.asked


def test_bpe_query_and_round_trip(spark, library):
    out = bpe.encode(edge_frame(spark), with_ids=True)
    assert out.columns == ["doc_id", "text", "keep", "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"]
    rows = bpe.decode(out.drop("decoded")).collect()
    assert len(rows) == len(EDGES) + 5
    for r in rows:
        want = library.encode(r.text or "", add_special_tokens=False).ids
        assert r.ids == want and r.n_tokens == len(want)
        assert r.ids_sha256 == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
        assert r.decoded == library.decode(want, skip_special_tokens=False)
        assert r.decoded_sha256 == hashlib.sha256(r.decoded.encode()).hexdigest()
    assert bpe.encode(frame(spark, [])).count() == 0


def test_bpe_forgets_and_relearns(library):
    model, texts = bpe.WordBpe(bpe.read_vocabulary()), [f"word{k} qz{k}x" for k in range(40)]
    kept, bpe.REMEMBERED = bpe.REMEMBERED, 10
    try:
        for _ in range(3):
            for t in texts:
                assert model.encode([t])[0][0].tolist() == library.encode(t, add_special_tokens=False).ids
    finally:
        bpe.REMEMBERED = kept


# token counts


def test_token_counts_equal_the_library_by_offsets(spark):
    tokenizers = pytest.importorskip("tokenizers")
    import public_tokenizers

    library = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    library.encode_special_tokens = True
    rng = random.Random(2)
    parts = ["the", " ", "\n", "\n\n", "  ", "é", "漢字", "😀", "x", ".", "ing", " of"]
    docs = [(k, "".join(rng.choice(parts) for _ in range(rng.randint(0, 60)))) for k in range(60)] + [(100, None), (101, "")]
    for rule in token_counts.RULES:
        got = collections.defaultdict(dict)
        for r in token_counts.count_tokens(frame(spark, docs), rule=rule).collect():
            got[r.doc_id][r.section] = (r.start_char, r.end_char, r.n_tokens, r.n_crossing, r.doc_tokens)
        for i, text in docs:
            text = text or ""
            begins = [0] + [k + 1 for k, ch in enumerate(text[:-1]) if ch == "\n"]
            ends = begins[1:] + [len(text)]
            want = [[0, 0] for _ in begins]
            spans = library.encode(text, add_special_tokens=False).offsets
            for a, b in spans:
                shares = [max(0, min(b, e) - max(a, s)) for s, e in zip(begins, ends)]
                inside = [k for k, x in enumerate(shares) if x]
                owner = inside[0] if rule == "first" else shares.index(max(shares))
                want[owner][0] += 1
                want[owner][1] += len(inside) > 1
            assert got[i] == {k: (s, e, n, x, len(spans)) for k, (s, e, (n, x)) in enumerate(zip(begins, ends, want))}, repr(text)


def test_token_counts_edges(spark):
    out = token_counts.count_tokens(edge_frame(spark))
    assert out.select("doc_id").distinct().count() == len(EDGES) + 2
    assert out.where("doc_id = 0").collect()[0].n_tokens == 0
    assert token_counts.count_tokens(frame(spark, [])).count() == 0
    with pytest.raises(ValueError):
        token_counts.count_tokens(frame(spark, []), rule="last")


# near duplicates


def bag_of(text):
    w = words_of(text)
    return collections.Counter([tuple(w[k : k + 5]) for k in range(len(w) - 4)] or ([tuple(w)] if w else []))


def jaccard(a, b):
    both = sum((a & b).values())
    return both / max(1, sum(a.values()) + sum(b.values()) - both)


def brute_components(docs, least=0.8):
    texts = {}
    for i, t in docs:
        if t is not None:
            texts[t] = min(i, texts.get(t, i))
    bags = {i: bag_of(t) for t, i in texts.items()}
    root = {i: i for i in bags}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(bags), 2):
        if bags[a] and jaccard(bags[a], bags[b]) >= least:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {(i, t): (i, i) if t is None else (texts[t], find(texts[t])) for i, t in docs}


def near_docs(seed=3):
    rng = random.Random(seed)
    vocabulary = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in "lmnr"]
    docs = []
    for group in range(6):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([12, 60, 300]))]
        for _ in range(8):
            own = list(base)
            for _ in range(rng.randint(0, max(1, len(own) // 40))):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            docs.append(" ".join(own))
    docs += ["repeat me " * 200, "repeat me " * 190, "repeat me " * 100, "Short", "short", "", "", None, None]
    return [(k, t) for k, t in enumerate(docs)] + [(200, docs[0]), (201, docs[0])]


@pytest.mark.parametrize("small", [64, 1])
def test_minhash_equals_brute_force(spark, small, monkeypatch):
    """small 1: every band with several components goes by blocks."""
    monkeypatch.setattr(minhash, "SMALL_BAND", small)
    monkeypatch.setattr(minhash, "BLOCK", 3)
    docs = near_docs()
    if small == 1:  # blocks by shingles, with longer texts alone; pairs of blocks and copies of a text by several tasks
        for module, name, value in ((minhash, "BLOCK_SHINGLES", 200), (minhash, "BLOCK_PAIRS", 2), (common, "HOT_ROWS", 1), (common, "HOT_KEYS", 1 << 30), (minhash, "REMEMBERED", 3)):
            monkeypatch.setattr(module, name, value)
        long = " ".join(f"w{k % 7919}" for k in range(40_000))
        docs += [(300, long), (301, long + " and an end"), (302, long[: len(long) // 2])]
    want = brute_components(docs)
    got = minhash.near_duplicates(frame(spark, docs)).collect()
    assert len(got) == len(docs)
    text = dict(docs)
    for r in got:
        assert (r.class_id, r.component_id) == want[r.doc_id, text[r.doc_id]], text[r.doc_id]
        assert r.kept == (r.doc_id == r.component_id)
    kept = [r.doc_id for r in minhash.keep_first(frame(spark, docs)).collect()]
    assert sorted(kept) == sorted(r.doc_id for r in got if r.kept)


def test_parts_bound_the_similarity():
    rng = np.random.default_rng(1)
    for _ in range(50):
        a, b = (np.sort(rng.integers(0, 1 << 63, 300, np.uint64) * np.uint64(2)) for _ in range(2))
        n = int(rng.integers(0, 300))
        b[:n] = a[:n]
        b = np.sort(b)
        assert minhash.ceiling(minhash.parts(a), minhash.parts(b)[None])[0] >= minhash.similarity(a, b)
    assert minhash.ceiling(minhash.parts(a), minhash.parts(a)[None])[0] == 1


def test_bagminhash_estimates_weighted_jaccard():
    rng = random.Random(4)
    values = [f"v{k}" for k in range(40)]
    worst = 0
    for _ in range(30):
        a = collections.Counter({v: rng.choice([1, 1, 2, 7, 40]) for v in values})
        b = collections.Counter({v: max(0, a[v] + rng.choice([0, 0, 0, 1, -1, 9])) for v in values})
        got = []
        for bag in (a, b):
            items = [(common.mix(np.array([int(v[1:]) + 1], np.uint64))[0], n) for v, n in bag.items() if n]
            h, n = np.array([x[0] for x in items], np.uint64), np.array([x[1] for x in items])
            got.append(minhash.signatures(np.zeros(len(h), np.int64), h, n, 1, 1024)[0][0])
        worst = max(worst, abs((got[0] == got[1]).mean() - jaccard(a, b)))
    assert worst < 0.06  # the standard error is 0.016 at most


def test_minhash_edges(spark):
    got = minhash.near_duplicates(edge_frame(spark)).collect()
    assert len(got) == len(EDGES) + 5
    assert minhash.near_duplicates(frame(spark, [])).count() == 0
    assert minhash.keep_first(edge_frame(spark)).columns == ["doc_id", "text", "N_TOKENS", "keep"]
    assert minhash.keep_first(frame(spark, [(1, "same"), (1, "same"), (None, None)])).count() == 2


# line dedup


def brute_lines(docs, min_words=50):
    """Lines to delete by document, from all windows and their first places, with plain lists."""
    rows = sorted({d for d in docs if d[1] is not None}, key=lambda d: (d[0] is None, d[0] or 0))
    own = [[x for x in t.split("\n") if words_of(x)] for _, t in rows]
    first, met = {}, []
    for d, ls in enumerate(own):
        sizes = [len(words_of(x)) for x in ls]
        for i in range(len(ls)):
            for j in range(i + 1, len(ls) + 1):
                if sum(sizes[i:j]) >= min_words:
                    key = tuple(ls[i:j])
                    if key in first:
                        met.append((d, i, *first[key]))
                    else:
                        first[key] = d, i
                    break
    gone = collections.defaultdict(set)
    for d, i, s, k in met:
        a, b = i, k
        while a > 0 and b > 0 and own[d][a - 1] == own[s][b - 1]:
            a, b = a - 1, b - 1
        z, y = i, k
        while z < len(own[d]) and y < len(own[s]) and own[d][z] == own[s][y]:
            z, y = z + 1, y + 1
        gone[d] |= {(a, z)}
    out = {}
    for d, (i, t) in enumerate(rows):
        ls = t.split("\n")
        full = [k for k, x in enumerate(ls) if words_of(x)]
        drop = {k for a, z in gone[d] for k in range(full[a], full[z - 1] + 1)}
        out[i, t] = ("\n".join(x for k, x in enumerate(ls) if k not in drop) if drop else t, len(ls), len(drop))
    return out


def line_docs(seed=6):
    rng = random.Random(seed)
    pool = [" ".join(rng.choice("abcdefgh") + str(rng.randint(0, 9)) for _ in range(rng.choice([2, 5, 12, 30, 60]))) for _ in range(30)] + ["", "***"]
    docs = [(k, "\n".join(rng.choice(pool) for _ in range(rng.randint(0, 14)))) for k in range(60)]
    passage = pool[:8]
    docs += [(100 + k, "\n".join([f"own line {k}", *passage, "its end"])) for k in range(5)]
    return docs + [(200, "\n".join([pool[3]] * 40)), (201, None), (202, "")]


def test_lines_equal_brute_force(spark):
    docs = line_docs()
    want = brute_lines(docs)
    text = dict(docs)
    for r in lines.dedup_lines(frame(spark, docs)).collect():
        assert (r.text, r.n_lines, r.n_removed) == want.get((r.doc_id, text[r.doc_id]), (None, 0, 0)), r.doc_id


def test_lines_with_hot_keys_equal_brute_force(spark, monkeypatch):
    """Every key that repeats is dealt to several tasks."""
    monkeypatch.setattr(common, "HOT_ROWS", 2)
    monkeypatch.setattr(common, "HOT_KEYS", 1 << 30)
    docs = line_docs(11)
    want, text = brute_lines(docs), dict(docs)
    for r in lines.dedup_lines(frame(spark, docs)).collect():
        assert (r.text, r.n_lines, r.n_removed) == want.get((r.doc_id, text[r.doc_id]), (None, 0, 0)), r.doc_id


def test_winnowing_chooses_few_grams_and_the_same_in_equal_windows():
    rng = random.Random(2)
    said = ["\n".join(" ".join(f"w{rng.randint(0, 99)}" for _ in range(rng.randint(6, 12))) for _ in range(200)) for _ in range(20)]
    passage = "\n".join(said[0].split("\n")[50:58])
    said.append("\n".join(["x y z", passage, "an end"]))
    hashes, n_words, _, bounds, *_ = lines.lines(pa.array(said))
    doc, key, at, around, windows, number = lines.fingerprints(hashes, n_words, bounds)
    assert len(doc) < 0.5 * len(windows) and len(number) == len(windows) and number[-1] == len(doc) - 1
    mine = set(key[doc == 20].tolist()) & set(key[(doc == 0) & (at >= 50) & (at < 58)].tolist())
    assert mine and all(n in np.unique(number) for n in range(len(doc)))
    by_window = collections.defaultdict(set)
    for w, n in zip(windows.tolist(), number.tolist()):
        by_window[w].add(int(key[n]))
    assert all(len(x) == 1 for x in by_window.values())


def test_common_lines_hide_no_passage(spark):
    """A line of a licence, met first elsewhere, begins a passage that two later documents share."""
    licence = " ".join(f"licence{k}" for k in range(30))
    rest = "\n".join(" ".join(f"{x}{k}" for k in range(25)) for x in "pq")
    docs = [(1, licence + "\nown"), (2, f"{licence}\n{rest}"), (3, f"its own\n{licence}\n{rest}\nend"), (4, f"{licence}\nother")]
    got = {r.doc_id: r.text for r in lines.dedup_lines(frame(spark, docs)).collect()}
    assert got == {**dict(docs), 3: "its own\nend"}


def test_lines_leave_no_repeated_window(spark):
    rows = lines.dedup_lines(frame(spark, line_docs(8))).collect()
    assert sum(r.n_removed for r in rows) > 0


def test_lines_edges(spark):
    out = lines.dedup_lines(edge_frame(spark))
    assert out.columns == ["doc_id", "text", "N_TOKENS", "keep", "n_lines", "n_removed"]
    assert {(r.doc_id, r.text) for r in out.collect()} == {(r.doc_id, r.text) for r in edge_frame(spark).collect()}
    assert lines.dedup_lines(frame(spark, [])).count() == 0


# quality


def rated(n=900, seed=7):
    rng = random.Random(seed)
    docs, labels = [], []
    for k in range(n):
        ws = [f"w{rng.randint(0, 300)}" for _ in range(rng.randint(20, 80))]
        kind = rng.choice([0, 1, 2, 2, 2])
        if kind == 0:
            ws[rng.randrange(len(ws))] = rng.choice(["vile", "awful"])
        if kind == 1:
            ws = [w + rng.choice(["###", "$$$"]) for w in ws]
        docs.append((k, " ".join(ws)))
        labels.append((k, 0 if kind == 1 else 1, int(kind == 0)))
    return docs, labels


def test_quality_held_out_accuracy(spark):
    docs, labels = rated()
    schema = "doc_id long, quality int, toxic int"
    model = quality.train(frame(spark, docs[:600]), spark.createDataFrame(labels[:600], schema))
    assert (np.diff(model.cuts) > 0).all()
    right = total = 0
    truth = {i: q == 1 and not t for i, q, t in labels}
    for r in quality.classify(frame(spark, docs[600:]), model).collect():
        right += r.keep == truth[r.doc_id]
        total += 1
        assert 0 <= r.expected_grade <= 2 and r.p_good <= 1 - r.p_toxic + 1e-12
    assert right / total > 0.97


def test_quality_edges(spark):
    docs, labels = rated(60)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.classify(edge_frame(spark), quality.train(frame(spark, docs), none)).where("keep").count() == len(EDGES) + 5
    odd = spark.createDataFrame([(None, 1, 1), (1, None, None), (1, 1, 0), (1, 1, 1), (2, 0, None), (3, None, 1)], "doc_id long, quality int, toxic int")
    model = quality.train(frame(spark, docs), odd)
    assert quality.classify(frame(spark, []), model).count() == 0
    assert [f.name for f in quality.classify(edge_frame(spark), model).schema] == ["doc_id", "text", "N_TOKENS", "expected_grade", "p_good", "p_toxic", "keep"]


def test_stash_needs_no_lineage(spark):
    df = common.stash(spark.range(10).toDF("n"), "test")
    assert df.count() == 10 and df.schema["n"].dataType == T.LongType()
