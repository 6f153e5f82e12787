"""Phrase collocations by mergeable Misra-Gries summaries (operator 11).

A text is cut into pieces and these into words; a phrase is up to
``most_words`` words in a row inside a piece, and everything is counted for
each language by itself. A candidate phrase has two words or more and occurs
at least ``threshold`` times.

Which phrases may be frequent is found by summaries of hashed n-grams. The
hashes are dealt into partitions; a task sums up each partition's n-grams of
its stretch of texts, and all summaries of a partition are merged under a
capacity above the partition's mass (its number of n-gram occurrences) divided
by the threshold. A merge that exceeds the capacity takes the same count off
every counter, which can happen fewer than ``threshold`` times over, so every
frequent n-gram survives. Sizes are summarised in steps - words, pairs, longer
phrases - and a step leaves out n-grams with a part that did not survive.
A second pass counts the survivors exactly, by their text, and only these
counts decide.

Bounds: a partition holds about ``PART_MASS`` occurrences, so a merge fits a
task at any size of the corpus; survivors are sent to the tasks as a table of
2**BITS bits, which lets some others through to be counted but misses none.
Counts and phrases are shuffled as compressed blocks, one for each partition and
stretch of texts, in which every n-gram of the stretch is once.

Scores are exact: whole numbers in decimals wider than 64 bits.

Edge cases: a null language counts as ``und``; null and empty texts have no
words; repeated rows count each; languages without candidates give no rows; an
empty table gives an empty result; columns of any other name do not matter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoplens.llm import _common as C
from shoplens.llm import _grams as G

THRESHOLD = 30
MOST_WORDS = 4
FIRST = 2000
OVERLAP = 80  # hundredths of a phrase's occurrences that lie inside a longer one
UNDETERMINED = "und"
PARTING = ~G.byte_class(*b".,;:!?", *range(0x0A, 0x0E))
INSIDE = ~PARTING & G.byte_class(0x20, 0x09)
PART_MASS = 1 << 21
CHUNK = 1 << 22
BITS = 25
MOST_HELD, MOST_HELD_BYTES = 600_000, 32 << 20


class Summary:
    """Misra-Gries counters of 64-bit keys. ``count`` of a key is too small by
    ``loss`` at most; a key without a counter occurred ``loss`` times at most."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.keys, self.counts, self.loss = np.zeros(0, np.uint64), np.zeros(0, np.int64), 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Takes in the counters of another summary, or exact counts."""
        self.keys, back = np.unique(np.concatenate([self.keys, keys]), return_inverse=True)
        both = np.zeros(len(self.keys), np.int64)
        np.add.at(both, back, np.concatenate([self.counts, counts]))
        self.counts = both
        over = len(self.keys) - self.capacity
        if over > 0:
            off = int(np.partition(both, over - 1)[over - 1])  # at least ``over`` counters have no more
            keep = both > off
            self.keys, self.counts, self.loss = self.keys[keep], both[keep] - off, self.loss + off

    def may_reach(self, threshold: int) -> np.ndarray:
        return self.keys[self.counts + self.loss >= threshold]


# ------------------------------------------------------------------ n-grams
class Grams:
    """n-grams of a slice that can be frequent by what is known of their parts."""

    def __init__(self, t: C.Texts, langs: list, known: dict[int, G.Bits], parts: int):
        self.words = G.Words(t, INSIDE, PARTING)
        self.langs = [UNDETERMINED if x is None else x for x in langs]
        salt = {x: xxhash.xxh64_intdigest(x.encode()) for x in set(self.langs)}
        self.salt = np.array([salt[x] for x in self.langs], np.uint64)
        self.known, self.parts = known, parts
        self.good: dict[int, np.ndarray] = {}

    def of(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """First words and hashes of the n-grams of ``size`` words."""
        n = len(self.words.start)
        if size == 1:
            at, h = self.words.grams(1, self.salt)
        else:
            part = self._good(min(size - 1, max(self.known, default=1)))
            some = np.flatnonzero(self._run(part, size)) if n >= size else np.zeros(0, np.int64)
            at = some[self.words.piece[some] == self.words.piece[some + size - 1]] if len(some) else some
            h = self.words.hash_at(at, size, self.salt)
        if size in self.known:
            keep = self.known[size].hits(C.scramble(reduced(h, self.parts)))
            at, h = at[keep], h[keep]
        return at, h

    def _good(self, size: int) -> tuple[int, np.ndarray]:
        if size not in self.good:
            mark = np.zeros(len(self.words.start), bool)
            mark[self.of(size)[0]] = True
            self.good[size] = mark
        return size, self.good[size]

    def _run(self, part: tuple[int, np.ndarray], size: int) -> np.ndarray:
        """Where all parts of an n-gram survived."""
        inner, mark = part
        n = len(mark) - size + 1
        out = np.ones(n, bool)
        for j in range(size - inner + 1):
            out &= mark[j:j + n]
        return out


def _parts(texts: DataFrame) -> int:
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(1, size // (4 * PART_MASS))


def reduced(h: np.ndarray, parts: int) -> np.ndarray:
    """What of a hash the summaries keep: its partition and 32 bits. n-grams
    that agree in these are summed up together, which can only make more survive."""
    part = (h >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)
    return part << np.uint64(32) | h & np.uint64(0xFFFFFFFF)


def packed(values: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers, compressed byte by byte of their places."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values.astype(np.uint32).view(np.uint8).reshape(-1, 4).T).tobytes())


def unpacked(block: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(block), np.uint8)
    return np.ascontiguousarray(raw.reshape(4, -1).T).view(np.uint32).ravel()


def _split(part: np.ndarray) -> list[tuple[int, int, int]]:
    """(partition, first, end) of the runs of a sorted array."""
    names, first = np.unique(part, return_index=True)
    return list(zip(names.tolist(), first.tolist(), [*first[1:].tolist(), len(part)]))


def survivors(texts: DataFrame, sizes: tuple[int, ...], known: dict[int, G.Bits], parts: int, threshold: int) -> DataFrame:
    """key: reduced hashes of n-grams, all with ``threshold`` occurrences among them."""
    shared = texts.sparkSession.sparkContext.broadcast(known)

    def summed(batches):
        bits = shared.value
        held, total = [], 0

        def flush():
            keys, n = np.unique(np.concatenate(held), return_counts=True)
            low = (keys & np.uint64(0xFFFFFFFF)).astype(np.uint32)
            rows = [(p, packed(np.diff(low[a:b], prepend=np.uint32(0))), packed(n[a:b]))
                    for p, a, b in _split((keys >> np.uint64(32)).astype(np.int64))]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.binary(), pa.binary()))],
                                              names=["part", "keys", "counts"])

        for b in batches:
            langs = b.column("lang").to_pylist()
            for s in C.slices(C.texts_of(b.column("text"))):
                g = Grams(s, langs[s.first:s.first + len(s)], bits, parts)
                for size in sizes:
                    h = reduced(g.of(size)[1], parts)
                    held.append(h)
                    total += len(h)
                if total >= CHUNK:
                    yield flush()
                    held, total = [], 0
        if total:
            yield flush()

    def merged(key: tuple, rows: pa.Table) -> pa.Table:
        some = [(np.cumsum(unpacked(k), dtype=np.uint64), unpacked(n).astype(np.int64))
                for k, n in zip(rows.column("keys").to_pylist(), rows.column("counts").to_pylist())]
        summary = Summary(sum(int(n.sum()) for _, n in some) // threshold + 1)
        for k, n in some:
            summary.add(k, n)
        part = np.uint64(key[0].as_py() << 32)
        return pa.table({"key": pa.array((summary.may_reach(threshold) | part).view(np.int64))})

    C.ship(texts.sparkSession)
    return (texts.select("lang", "text").mapInArrow(summed, "part long, keys binary, counts binary")
            .groupBy("part").applyInArrow(merged, "key long"))


def exact_counts(texts: DataFrame, known: dict[int, G.Bits], parts: int, most_words: int, threshold: int) -> DataFrame:
    """lang, n, phrase, f of all phrases of up to ``most_words`` words with
    ``threshold`` occurrences or more; n = 0 has all word occurrences."""
    shared = texts.sparkSession.sparkContext.broadcast(known)

    def counted(batches):
        bits = shared.value
        held: dict[int, bytes] = {}  # by hash
        keys, counts, words, weight = [], [], {}, 0

        def flush():
            flat, back = np.unique(np.concatenate(keys), return_inverse=True)
            n = np.zeros(len(flat), np.int64)
            np.add.at(n, back, np.concatenate(counts))
            rows = []
            for p, a, b in _split(((flat >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)):
                named = sorted((held[k], c) for k, c in zip(flat[a:b].tolist(), n[a:b].tolist()))
                rows.append((p, zstandard.ZstdCompressor(level=1).compress(b"\n".join(x for x, _ in named)),
                             packed(np.array([c for _, c in named]))))
            rows += [(xxhash.xxh64_intdigest(x) % parts, zstandard.compress(_named(x, 0, b"")), packed(np.array([c]))) for x, c in words.items()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.binary(), pa.binary()))],
                                              names=["part", "phrases", "counts"])

        for b in batches:
            langs = b.column("lang").to_pylist()
            for s in C.slices(C.texts_of(b.column("text"))):
                g = Grams(s, langs[s.first:s.first + len(s)], bits, parts)
                for x, k in zip(g.langs, g.words.count.tolist()):
                    words[x.encode()] = words.get(x.encode(), 0) + k
                for size in range(1, most_words + 1):
                    at, h = g.of(size)
                    some, first, n = np.unique(h, return_index=True, return_counts=True)
                    keys.append(some)
                    counts.append(n)
                    for key, i in zip(some.tolist(), at[first].tolist()):
                        if key not in held:
                            held[key] = _named(g.langs[g.words.row[i]].encode(), size, g.words.text(i, size))
                            weight += len(held[key])
                if len(held) > MOST_HELD or weight > MOST_HELD_BYTES:
                    yield flush()
                    held, keys, counts, words, weight = {}, [], [], {}, 0
        if keys:
            yield flush()

    def summed(rows: pa.Table) -> pa.Table:
        phrases = [x for block in rows.column("phrases").to_pylist() for x in zstandard.decompress(block).split(b"\n")]
        counts = [unpacked(n).astype(np.int64) for n in rows.column("counts").to_pylist()]
        both = pa.table({"t": pa.array(phrases, pa.binary()), "n": np.concatenate(counts)}).group_by("t").aggregate([("n", "sum")])
        out = [(*t.split(b"\t"), f) for t, f in zip(both.column("t").to_pylist(), both.column("n_sum").to_pylist())
               if f >= threshold or t.endswith(b"\t0\t")]
        lang, size, phrase, f = zip(*out) if out else ((), (), (), ())
        return pa.table({"lang": pa.array([bytes.fromhex(x.decode()).decode() for x in lang], pa.string()), "n": pa.array(map(int, size), pa.int32()),
                         "phrase": pa.array(phrase, pa.binary()), "f": pa.array(f, pa.int64())})

    C.ship(texts.sparkSession)
    return (texts.select("lang", "text").mapInArrow(counted, "part long, phrases binary, counts binary")
            .groupBy("part").applyInArrow(summed, "lang string, n int, phrase binary, f long").withColumn("phrase", F.col("phrase").cast("string")))


def _named(lang: bytes, size: int, phrase: bytes) -> bytes:
    """A counted phrase; words have neither tabs nor line feeds, languages might."""
    return lang.hex().encode() + b"\t%d\t" % size + phrase


# -------------------------------------------------------------------- scores
def scored(counts: DataFrame, overlap: int = OVERLAP) -> DataFrame:
    """lang, phrase, a, l, r, score of the candidates that no longer one has
    nearly all occurrences of."""
    phrases = counts.where("n > 0")
    candidates = phrases.where("n > 1")
    cuts = candidates.selectExpr("lang", "phrase", "f AS a", "n", "explode(sequence(1, n - 1)) AS k").selectExpr(
        "lang", "phrase", "a", "k", "substring_index(phrase, ' ', k) AS head", "substring_index(phrase, ' ', k - n) AS tail")
    part = phrases.select("lang", "phrase", "f")
    cuts = (cuts.join(part.selectExpr("lang", "phrase AS head", "f AS l"), ["lang", "head"])
            .join(part.selectExpr("lang", "phrase AS tail", "f AS r"), ["lang", "tail"]))
    wide = "(CAST(a AS DECIMAL(20, 0)) * 2000000) div (CAST(l AS DECIMAL(20, 0)) + CAST(r AS DECIMAL(20, 0)))"
    best = (cuts.groupBy("lang", "phrase", "a").agg(F.expr(f"min(struct({wide} AS score, k, l, r))").alias("cut"))
            .select("lang", "phrase", "a", "cut.score", "cut.l", "cut.r"))
    inner = """flatten(transform(sequence(2, n - 1), m -> transform(sequence(1, n - m + 1),
                                 i -> array_join(slice(split(phrase, ' '), i, m), ' '))))"""
    longer = (candidates.where("n > 2").selectExpr("lang", "f", f"explode({inner}) AS phrase")
              .groupBy("lang", "phrase").agg(F.max("f").alias("within")))
    return (best.join(longer, ["lang", "phrase"], "left")
            .where(f"within IS NULL OR CAST(within AS DECIMAL(20, 0)) * 100 < CAST(a AS DECIMAL(20, 0)) * {overlap}").drop("within"))


def _scrambled(keys: DataFrame) -> DataFrame:
    """Reduced hashes fill the bits of a long unevenly; a filter wants them spread."""
    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(C.scramble(b.column(0).to_numpy().view(np.uint64)).view(np.int64))], names=["key"])

    return keys.mapInArrow(run, "key long")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", threshold: int = THRESHOLD,
                 most_words: int = MOST_WORDS, first: int = FIRST, overlap: int = OVERLAP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first phrases."""
    texts = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    parts = _parts(texts)
    known: dict[int, G.Bits] = {}
    for sizes in [(1,), (2,), tuple(range(3, most_words + 1))]:
        if sizes and sizes[-1] <= most_words:
            keys = C.cut(survivors(texts, sizes, known, parts, threshold))
            bits = G.Bits.of(_scrambled(keys), "key", BITS)
            known = {**known, **{size: bits for size in sizes}}
    counts = C.cut(exact_counts(texts, known, parts, most_words, threshold))
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    top = scored(counts, overlap).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= first)
    words = counts.where("n = 0").selectExpr("lang", "f AS n")
    return top.join(words, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op11_collocations(spark, sf_dir: str) -> DataFrame:
    return collocations(C.table(spark, sf_dir, "documents"))


ORACLE = """
WITH d AS (SELECT coalesce(lang, 'und') AS lang,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM d),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[ \\t]+'), lambda x: x <> '') AS words FROM p),
g AS (SELECT lang, m.n AS size, unnest(list_transform(range(1, len(words) - m.n + 2),
                                                 lambda i: array_to_string(list_slice(words, i, i + m.n - 1), ' '))) AS phrase
      FROM w, (VALUES (1), (2), (3), (4)) m(n) WHERE len(words) >= m.n),
f AS (SELECT lang, size, phrase, count(*) AS f FROM g GROUP BY ALL),
t AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE size = 1 GROUP BY lang),
c AS (SELECT * FROM f WHERE size > 1 AND f >= 30),
k AS (SELECT c.lang, c.phrase, c.size, c.f AS a, k.k, array_to_string(string_split(c.phrase, ' ')[1:k.k], ' ') AS head,
             array_to_string(string_split(c.phrase, ' ')[k.k + 1:], ' ') AS tail
      FROM c, (VALUES (1), (2), (3)) k(k) WHERE k.k < c.size),
s AS (SELECT k.lang, k.phrase, k.size, k.a, k.k, x.f AS l, y.f AS r,
             (CAST(k.a AS HUGEINT) * 2000000) // (CAST(x.f AS HUGEINT) + y.f) AS score
      FROM k JOIN f x ON x.lang = k.lang AND x.phrase = k.head JOIN f y ON y.lang = k.lang AND y.phrase = k.tail),
b AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS place FROM s),
i AS (SELECT c.lang, c.f, array_to_string(string_split(c.phrase, ' ')[o.o:o.o + m.m - 1], ' ') AS phrase
      FROM c, (VALUES (2), (3)) m(m), (VALUES (1), (2), (3)) o(o) WHERE m.m < c.size AND o.o + m.m - 1 <= c.size),
x AS (SELECT lang, phrase, max(f) AS within FROM i GROUP BY ALL),
r AS (SELECT b.lang, b.phrase, a, l, r, CAST(score AS BIGINT) AS score,
             row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, encode(b.phrase)) AS rank
      FROM b LEFT JOIN x ON x.lang = b.lang AND x.phrase = b.phrase
      WHERE place = 1 AND (within IS NULL OR 100 * CAST(within AS HUGEINT) < 80 * CAST(a AS HUGEINT)))
SELECT r.lang, rank, phrase, a, l, r, n, score FROM r JOIN t ON t.lang = r.lang WHERE rank <= 2000
"""
