"""BPE encoding by speculation: greedy longest matches propose tokens, all adjacent pairs are checked at once, and only words with a failing pair are merged exactly."""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterable
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from . import common as c

#: White space as the vocabulary's normaliser and words take it, for a regular expression's class.
SPACES = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: Words of a generation, and pairs: a worker remembers those of the last full one and of the one that grows; what is met again stays.
#: About 200 bytes a word and 130 a pair, so less than 100 MB besides the vocabulary.
REMEMBERED, REMEMBERED_PAIRS = 1 << 17, 1 << 18


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable ones for themselves, the others in turn from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b if b in plain else next(rest)) for b in range(256)]


class WordBpe:
    """A BPE vocabulary file of the tokenizers library whose words end in a suffix, with its normaliser (NFC, spaces, lower case) and its words."""

    def __init__(self, source: str) -> None:
        """source: the text of the file."""
        spec = json.loads(source)
        model, split = spec["model"], spec["pre_tokenizer"]["pretokenizers"][0]
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]], split["behavior"], split["invert"], spec["decoder"], spec["post_processor"]
        if kinds != (["NFC", "Replace", "Lowercase"], "Removed", True, None, None) or model["unk_token"] or model["dropout"] or model["continuing_subword_prefix"]:
            raise ValueError(f"not a vocabulary of this kind: {kinds}")
        self.suffix = model["end_of_word_suffix"]
        self.vocab: dict[str, int] = model["vocab"]
        self.names = {i: t for t, i in self.vocab.items()}
        self.ranks = {tuple(m): r for r, m in enumerate(model["merges"])}
        self.longest = max(len(t.removesuffix(self.suffix)) for t in self.vocab)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in spec["added_tokens"]):
            raise ValueError("special tokens with options are not supported")
        self.names |= {i: t for t, i in self.special.items()}
        self.cut = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        self.split = regex.compile(split["pattern"]["Regex"].replace(r"\s", SPACES))
        self.letters = byte_letters()
        self.own: dict[int, bool] = {}  # tokens that their own letters merge to
        self.fits: dict[int, bool] = {}  # pairs that stay a pair when merged from their letters
        self.words: dict[str, bytes] = {}  # ids as little-endian 32-bit numbers
        self.before: dict[str, bytes] = {}
        self.merged = 0  # words that took exact merging, of self.asked
        self.asked = 0

    def normalise(self, text: str) -> str:
        """Without the replacement of white space, of which no word has any."""
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()  # sigma apart: letters are lowered one by one, without regard to the end of a word

    def symbols(self, word: str) -> list[str]:
        letters = [self.letters[b] for b in word.encode("utf-8", "surrogatepass")]
        letters[-1] += self.suffix
        return letters

    def merge(self, symbols: list[str]) -> list[str]:
        """Exact merging: the pair of least rank first, the leftmost of equals."""
        symbols, rank, none = list(symbols), self.ranks.get, 1 << 40
        ranks = [rank(pair, none) for pair in zip(symbols, symbols[1:])]
        while ranks and (least := min(ranks)) < none:
            i = ranks.index(least)
            symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]
            del ranks[i]
            if i:
                ranks[i - 1] = rank((symbols[i - 1], symbols[i]), none)
            if i < len(ranks):
                ranks[i] = rank((symbols[i], symbols[i + 1]), none)
        return symbols

    def letters_of(self, token: int) -> list[str]:
        name = self.names[token]
        if not name.endswith(self.suffix) or name == self.suffix:
            return list(name)
        stem = name[: -len(self.suffix)]
        return [*stem[:-1], stem[-1] + self.suffix]

    def propose(self, symbols: list[str]) -> list[int] | None:
        """Greedy longest match from the left; None where some letter is in no token."""
        n = len(symbols)
        stem, get, out, i = "".join(symbols)[: -len(self.suffix)], self.vocab.get, [], 0
        while i < n:
            t = get(stem[i:] + self.suffix) if n - i <= self.longest else None
            j = n if t is not None else min(n - 1, i + self.longest)
            while t is None and j > i:
                t = get(stem[i:j])
                j -= t is None
            if t is None:
                return None
            out.append(t)
            i = j
        return out

    def stays(self, tokens: Iterable[int]) -> bool:
        tokens = list(tokens)
        got = self.merge([x for t in tokens for x in self.letters_of(t)])
        return [self.vocab.get(s) for s in got] == tokens

    def learn(self, new: list[str]) -> None:
        """Encode words not seen so far, all together."""
        symbols = [self.symbols(w) for w in new]
        proposed = [self.propose(s) for s in symbols]
        flat = np.fromiter(chain.from_iterable(p or () for p in proposed), np.int64)
        owner = np.repeat(np.arange(len(new)), [len(p or ()) for p in proposed])
        bad = np.array([p is None for p in proposed], bool)
        size = max(self.names) + 1
        for known, codes, at in ((self.own, flat, owner), (self.fits, (flat[:-1] * size + flat[1:])[owner[:-1] == owner[1:]], owner[1:][owner[:-1] == owner[1:]])):
            distinct, back = np.unique(codes, return_inverse=True)
            for x in distinct.tolist():
                if x not in known:
                    known[x] = self.stays([x] if known is self.own else divmod(x, size))
            fine = np.fromiter((known[x] for x in distinct.tolist()), bool, len(distinct))
            bad[at[~fine[back]]] = True
        for k in np.flatnonzero(bad):
            proposed[k] = [self.vocab[s] for s in self.merge(symbols[k]) if s in self.vocab]
        self.asked += len(new)
        self.merged += int(bad.sum())
        for w, p in zip(new, proposed):
            self.words[w] = np.array(p, "<u4").tobytes()

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, str]]:
        """Ids of each text and what decoding them, special tokens kept, gives: the tokens' names joined by spaces."""
        parts: list[list[list[str] | int]] = []
        fresh: set[str] = set()
        for text in texts:
            own: list[list[str] | int] = []
            for piece in self.cut.split(text) if self.cut else [text]:
                if piece in self.special:
                    own.append(self.special[piece])
                elif piece:
                    ws = self.split.findall(self.normalise(piece))
                    own.append(ws)
                    fresh.update(ws)
            parts.append(own)
        if len(self.words) > REMEMBERED:
            self.before, self.words = self.words, {}
        if len(self.fits) > REMEMBERED_PAIRS:
            self.fits.clear()
        fresh.difference_update(self.words)
        for w in fresh & self.before.keys():
            self.words[w] = self.before[w]
        self.learn([w for w in fresh if w not in self.words])
        get, name = self.words.__getitem__, self.names.__getitem__
        out = []
        for own in parts:
            ids: list[bytes] = []
            for p in own:
                if isinstance(p, int):
                    ids.append(np.array([p], "<u4").tobytes())
                else:
                    ids.extend(map(get, p))
            whole = np.frombuffer(b"".join(ids), "<u4")
            out.append((whole, " ".join(map(name, whole.tolist()))))
        return out


def read_vocabulary(path: str | None = None) -> str:
    """The text of a vocabulary file (of bounded size: one vocabulary), read where the driver runs."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as f:
        return f.read()


def encode(docs: DataFrame, vocabulary: str | None = None, text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Append n_tokens, ids_sha256 and decoded_sha256 to every row; with_ids also ids (array of int) and decoded (string).

    Null and empty texts have no tokens, and both hashes are those of the empty string. Repeated rows are encoded alike, empty tables give no
    rows, and input columns of these names are replaced. Special tokens written in a text are encoded as such. vocabulary: a file's path."""
    source = read_vocabulary(vocabulary)
    digest = c.sha256_hex(source.encode())
    shared = docs.sparkSession.sparkContext.broadcast(source)

    def make(texts: pa.Array) -> list[pa.Array]:
        got = c.remembered(f"bpe-{digest}", lambda: WordBpe(shared.value)).encode(texts.fill_null("").to_pylist())
        out = [
            pa.array([len(i) for i, _ in got], pa.int64()),
            pa.array([c.sha256_hex(i.tobytes()) for i, _ in got]),
            pa.array([hashlib.sha256(d.encode("utf-8", "surrogatepass")).hexdigest() for _, d in got]),
        ]
        if with_ids:
            bounds = np.concatenate([[0], np.cumsum([len(i) for i, _ in got])]).astype(np.int32)
            flat = np.concatenate([i for i, _ in got]).astype(np.int32) if got else np.zeros(0, np.int32)
            out += [pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat)), pa.array([d for _, d in got], pa.string())]
        return out

    added = [("n_tokens", T.LongType()), ("ids_sha256", T.StringType()), ("decoded_sha256", T.StringType())]
    added += [("ids", T.ArrayType(T.IntegerType())), ("decoded", T.StringType())] if with_ids else []
    return c.mapped(docs, added, make, text_col)


def decode(rows: DataFrame, vocabulary: str | None = None, ids_col: str = "ids") -> DataFrame:
    """Append decoded: the tokens' names joined by spaces, special tokens kept. Null ids give null; ids of no token are left out."""
    shared = rows.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))
    kept, schema = c.with_columns(rows, [("decoded", T.StringType())])

    def run(batches):
        names = WordBpe(shared.value).names
        for b in batches:
            ids = b.column(b.schema.get_field_index(ids_col)).to_pylist()
            said = [None if x is None else " ".join(names[i] for i in x if i in names) for x in ids]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(said, pa.string())], names=[*b.schema.names, "decoded"])

    return kept.mapInArrow(run, schema)


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's tokens and of what they decode to."""
    out = encode(c.table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
