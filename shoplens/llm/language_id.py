"""Language identification by segmentation-marginalised unigrams (operator 1).

A fixed public vocabulary of byte pieces (with all 256 single bytes) and, for
each language, a probability for every piece. A text's words (runs of letters,
lower-cased, with a space before) are scored by a forward pass that sums over
all ways to segment the word into pieces; a text's log likelihood is the sum
over its words, and ``score`` the posterior of the best language under equal
priors.

The probabilities are learned by expectation maximisation on a documented,
bounded number of labelled rows per language (``fit_rows``, chosen by a hash of
the id); each step is one distributed pass over the distinct words of those
rows, of any length: in scripts without spaces a word is a sentence or more.
Every distinct word of a slice of texts is scored once.

Edge cases: null texts and texts without a letter get ``und`` and score 0, and
so does every text if there is nothing to learn from; ties go to the language
that sorts first; texts of any length are scored whole (memory follows the longest
run of letters); repeated rows are
scored each; an empty table gives an empty result; columns of any other name
are kept.
"""

from __future__ import annotations

import base64
import functools
import math
import re
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm import _common as C

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
LONGEST_PIECE = 9
FIT_ROWS = 3000
EM_STEPS = 3
SMOOTHING = 0.02
UNDETERMINED = "und"

LETTER = np.zeros(256, bool)
LETTER[0x41:0x5B] = LETTER[0x61:0x7B] = LETTER[0x80:] = True


IN_WORD = re.compile(rb" ?[a-z\x80-\xff]+").fullmatch


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> tuple[dict[bytes, int], frozenset[bytes]]:
    """Piece -> number, for pieces that words can hold (letters, a space before)
    and single bytes; and all their prefixes."""
    pieces: dict[bytes, int] = {}
    for line in Path(path).read_bytes().splitlines():
        piece = base64.b64decode(line.split()[0])
        if len(piece) == 1 or (len(piece) <= LONGEST_PIECE and IN_WORD(piece)):
            pieces[piece] = len(pieces)
    return pieces, frozenset(p[:k] for p in pieces for k in range(1, len(p) + 1))


def edges(word: bytes, pieces, prefixes) -> list[list[tuple[int, int]]]:
    """For each place, the pieces that begin there: (end, piece number)."""
    out = []
    n = len(word)
    for i in range(n):
        here = []
        for j in range(i + 1, min(i + LONGEST_PIECE, n) + 1):
            part = word[i:j]
            if part not in prefixes:
                break
            k = pieces.get(part)
            if k is not None:
                here.append((j, k))
        out.append(here)
    return out


def forward(lattice: list[list[tuple[int, int]]], prob) -> tuple[list[float], float]:
    """Sums over all segmentations up to each place, scaled, and the log of
    the sum for the whole word."""
    n = len(lattice)
    alpha = [0.0] * (n + 1)
    alpha[0] = 1.0
    scale = 0.0
    for i, here in enumerate(lattice):
        a = alpha[i]
        if i % 16 == 15 and 0 < a < 1e-100:  # keep long words above the smallest double
            for j in range(i, min(i + LONGEST_PIECE, n) + 1):
                alpha[j] /= a
            scale += math.log(a)
            a = 1.0
        for j, k in here:
            alpha[j] += a * prob[k]
    return alpha, scale + math.log(alpha[n])


def expected_counts(lattice, prob, weight: float, into: dict[int, float]) -> None:
    """Adds the expected number of uses of each piece in the word."""
    n = len(lattice)
    alpha = [0.0] * (n + 1)
    beta = [0.0] * (n + 1)
    alpha[0] = beta[n] = 1.0
    shrunk: dict[int, float] = {}  # place: factor by which sums from there on were made smaller, as in forward
    for i, here in enumerate(lattice):
        a = alpha[i]
        if i % 16 == 15 and 0 < a < 1e-100:
            for j in range(i, min(i + LONGEST_PIECE, n) + 1):
                alpha[j] /= a
            shrunk[i] = a
            a = 1.0
        for j, k in here:
            alpha[j] += a * prob[k]
    whole = alpha[n]
    if whole <= 0.0:
        return
    at, factor = n + 1, 1.0  # the nearest such place after i: pieces that pass it take its factor
    for i in range(n - 1, -1, -1):
        if i + 1 in shrunk:
            at, factor = i + 1, shrunk[i + 1]
        a = alpha[i] * weight / whole
        b = 0.0
        for j, k in lattice[i]:
            x = prob[k] * beta[j]
            if j >= at:
                x /= factor
            b += x
            into[k] = into.get(k, 0.0) + a * x
        beta[i] = b


def lower(data: np.ndarray) -> np.ndarray:
    """ASCII and Latin-1 capitals lower-cased, byte for byte."""
    out = data.copy()
    out[(data >= 0x41) & (data <= 0x5A)] += 32
    if len(data) > 1:
        latin = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)) + 1
        out[latin] += 32
    return out


def words_of(t: C.Texts) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """Codes of the words of all rows, the distinct words, and the number of
    the first word of each row (and the end)."""
    data = lower(t.data)
    w = LETTER[data]
    edge = np.zeros(len(w) + 1, bool)
    edge[t.off] = True
    if not w.any():
        return np.zeros(0, np.int64), [], np.zeros(len(t) + 1, np.int64)
    begins = w & (~np.concatenate([[False], w[:-1]]) | edge[:-1])
    at = np.flatnonzero(begins)
    inside = np.cumsum(w) - 1  # place of a letter among the letters
    codes, words = C.distinct(data[w], inside[at])
    return codes, words, np.searchsorted(at, t.off)


def word_counts(sample: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    """lang, word, n of the labelled rows."""
    name = C.fresh_name(sample, "words")

    def make():
        def run(t, _):
            codes, words, rows = words_of(t)
            out = []
            for a, b in zip(rows[:-1], rows[1:]):
                found, n = np.unique(codes[a:b], return_counts=True)
                out.append([{"word": words[c], "n": int(k)} for c, k in zip(found.tolist(), n.tolist())])
            return [out]
        return run

    counted = C.annotate(sample.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("t")), "t",
                         "w array<struct<word: binary, n: long>>", make, name)
    return (counted.select("lang", F.explode(f"{name}.w").alias("w"))
            .groupBy("lang", F.col("w.word").alias("word")).agg(F.sum("w.n").alias("n")))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        tokenizer_dir: str | None = None, fit_rows: int = FIT_ROWS, steps: int = EM_STEPS) -> dict[str, np.ndarray]:
    """Piece probabilities by language. ``docs``: the labelled rows."""
    path = C.tokenizer_path(VOCABULARY, tokenizer_dir)
    size = len(vocabulary(path)[0])
    labelled = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    rows = {r[lang_col]: r["n"] for r in labelled.groupBy(lang_col).agg(F.count(F.lit(1)).alias("n")).collect()}
    if not rows:
        return {}
    share = F.create_map(*[F.lit(x) for lang, n in sorted(rows.items()) for x in (lang, fit_rows / n)])
    draw = F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.lit(1 << 30)) / float(1 << 30)
    sample = labelled.where(draw < share[F.col(lang_col)])
    words = C.cut(word_counts(sample, lang_col, text_col))
    langs = sorted(rows)
    prob = {lang: np.full(size, 1.0 / size) for lang in langs}
    for _ in range(steps):
        held = words.sparkSession.sparkContext.broadcast(prob)  # languages x pieces numbers

        def step(batches, held=held):
            pieces, prefixes = vocabulary(path)
            p = {lang: v.tolist() for lang, v in held.value.items()}
            into: dict[str, dict[int, float]] = {}
            for b in batches:
                for lang, word, n in zip(*(b.column(c).to_pylist() for c in ("lang", "word", "n"))):
                    expected_counts(edges(b" " + word, pieces, prefixes), p[lang], float(n), into.setdefault(lang, {}))
            import pyarrow as pa

            for lang, found in into.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(found)), pa.array(found.keys(), pa.int32()), pa.array(found.values(), pa.float64())],
                    names=["lang", "piece", "n"])

        uses = words.mapInArrow(step, "lang string, piece int, n double").groupBy("lang", "piece").agg(F.sum("n").alias("n"))
        prob = {lang: np.zeros(size) for lang in langs}
        for r in uses.collect():  # at most one row per language and piece
            prob[r.lang][r.piece] = r.n
        held.unpersist()
        prob = {lang: (1 - SMOOTHING) * v / max(v.sum(), 1e-300) + SMOOTHING / size for lang, v in prob.items()}
    return prob


class Trie:
    """The vocabulary as a table of steps: step[node, byte], 0 if no piece
    goes on like that; ``piece`` of a node, or the last number for none."""

    def __init__(self, pieces: dict[bytes, int]):
        node = {b"": 1}
        for p in pieces:
            for k in range(1, len(p) + 1):
                node.setdefault(p[:k], len(node) + 1)
        self.step = np.zeros((len(node) + 1, 256), np.min_scalar_type(len(node)))
        self.piece = np.full(len(node) + 1, len(pieces), np.int32)
        for part, k in node.items():
            if part:
                self.step[node[part[:-1]], part[-1]] = k
            if part in pieces:
                self.piece[k] = pieces[part]


@functools.lru_cache(maxsize=1)
def trie(path: str) -> Trie:
    return Trie(vocabulary(path)[0])


#: Words up to so many bytes are summed together; probabilities times this
#: factor for each byte stay far from the smallest and largest doubles.
TOGETHER, BYTE_SCALE = 64, 256.0


class Scorer:
    def __init__(self, path: str, model: dict[str, np.ndarray], most: int = 200_000):
        pieces, self.prefixes = vocabulary(path)
        self.pieces, self.trie, self.most = pieces, trie(path), most
        self.langs = sorted(model)
        self.prob = [model[lang].tolist() for lang in self.langs]
        size = np.array([len(p) for p in pieces], float)
        self.scaled = np.zeros((len(pieces) + 1, len(self.langs)))  # the last row is no piece
        self.scaled[:-1] = np.stack([model[lang] for lang in self.langs], axis=1) * BYTE_SCALE ** size[:, None]
        self.memo: dict[bytes, int] = {}
        self.known = np.zeros((1 << 12, len(self.langs)))

    def together(self, words: list[bytes]) -> np.ndarray:
        """Log likelihoods of words of one length, by one forward pass."""
        n = len(words[0]) + 1
        text = np.frombuffer(b"".join(b" " + w for w in words), np.uint8).reshape(-1, n)
        alpha = np.zeros((n + 1, len(words), len(self.langs)))
        alpha[0] = 1.0
        for i in range(n):
            node = self.trie.step[1, text[:, i]]
            for j in range(i + 1, min(i + LONGEST_PIECE, n) + 1):
                alpha[j] += alpha[i] * self.scaled[self.trie.piece[node]]
                if j == n:
                    break
                node = self.trie.step[node, text[:, j]]
                if not node.any():
                    break
        return np.log(alpha[n]) - n * math.log(BYTE_SCALE)

    def learn(self, words: list[bytes]) -> None:
        """Scores the words that are not yet known."""
        if len(self.memo) > self.most:  # bounded memory
            self.memo.clear()
        memo = self.memo
        by_length: dict[int, list[bytes]] = {}
        for w in words:
            if w not in memo:
                by_length.setdefault(len(w), []).append(w)
        for size, new in by_length.items():
            for i in range(0, len(new), 20_000):
                some = new[i:i + 20_000]
                if size <= TOGETHER:
                    found = self.together(some)
                else:
                    found = np.array([[forward(edges(b" " + w, self.pieces, self.prefixes), p)[1] for p in self.prob]
                                      for w in some])
                first = len(memo)
                while first + len(some) > len(self.known):
                    self.known = np.concatenate([self.known, np.zeros_like(self.known)])
                self.known[first:first + len(some)] = found
                memo.update(zip(some, range(first, first + len(some))))

    def scores(self, t: C.Texts) -> np.ndarray:
        """Log likelihood of each row under each language."""
        codes, words, rows = words_of(t)
        out = np.zeros((len(t), len(self.langs)))
        if len(codes):
            self.learn(words)
            memo = self.memo
            each = self.known[np.array([memo[w] for w in words])[codes]]
            some = np.flatnonzero(rows[1:] > rows[:-1])
            out[some] = np.add.reduceat(each, rows[some], axis=0)
        return out


_SCORERS: dict[int, Scorer] = {}  # of this Python worker, by model


def forget() -> None:
    """Empties the worker's caches."""
    _SCORERS.clear()
    trie.cache_clear()
    vocabulary.cache_clear()


def predict(docs: DataFrame, model: dict[str, np.ndarray], text_col: str = "text", tokenizer_dir: str | None = None,
            name: str = "language") -> DataFrame:
    """``docs`` plus a struct ``name``: lang_pred, score."""
    path = C.tokenizer_path(VOCABULARY, tokenizer_dir)
    if not model:
        return docs.withColumn(name, F.struct(F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score")))
    held = docs.sparkSession.sparkContext.broadcast(model)
    key = hash((path, *((lang, v.tobytes()) for lang, v in sorted(model.items()))))

    def make():
        if key not in _SCORERS:
            _SCORERS.clear()
            _SCORERS[key] = Scorer(path, held.value)
        scorer = _SCORERS[key]

        def run(t, _):
            s = scorer.scores(t)
            best = s.argmax(axis=1)
            top = s[np.arange(len(s)), best]
            posterior = 1.0 / np.exp(s - top[:, None]).sum(axis=1)
            return [[scorer.langs[k] for k in best.tolist()], posterior]
        return run

    raw = C.fresh_name(docs, f"{name}_raw")
    scored = C.annotate(docs, text_col, "lang string, score double", make, raw, C.WORD_SLICE_BYTES, forget)
    has_letter = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))
    return scored.withColumn(name, F.struct(
        F.when(has_letter, F.col(f"{raw}.lang")).otherwise(UNDETERMINED).alias("lang_pred"),
        F.when(has_letter, F.col(f"{raw}.score")).otherwise(0.0).alias("score"))).drop(raw)


def held_out(id_col: str = "doc_id"):
    return C.by_crc(id_col, 5) == 0


def op1_language_id(spark, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents")
    model = fit(docs.where(~held_out()).select("doc_id", "text", "lang"))
    found = predict(docs.select("doc_id", "text"), model, name="p")
    return found.select("doc_id", held_out().alias("held_out"), F.col("p.lang_pred"), F.col("p.score"))
