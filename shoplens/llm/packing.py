"""Best-fit packing with bound-certified repacking (operator 6).

Each document becomes token ids (a public BPE tokenizer, then the end id);
only documents longer than a sequence are cut into pieces. Pieces are dealt
into groups of bounded size and each group is packed by best-fit decreasing.
Dual feasible functions give a lower bound on each group's number of
sequences. A group that meets its bound is certified and stays, but for its
least filled sequence; of the others, all sequences that are not full are open.
The pieces of open sequences are exchanged: pooled, dealt anew into larger
groups and packed again by best-fit decreasing. An exchange is kept only if it
saves sequences. Rounds go on until one saves nothing, or the whole table's
bound is met.

Only the pieces' lengths are shuffled, never texts or ids. The driver sees a few
sums per round and, for the table's bound, how many pieces have each length.
``certificate`` gives sequences and bound of a packed table.

Tokenizing: texts are cut where the tokenizer itself always begins a new word
(at ASCII white space, and between a Latin letter and ASCII punctuation other
than an apostrophe), ASCII and Latin-1 capitals are lower-cased as it does, and
each distinct word is given to the library once per worker. Texts that may
hold one of its special strings go to the library whole.

Edge cases: a null or empty text is the end id alone; texts of any length are
packed whole; repeated rows are packed each; an empty table gives an empty
result; columns of any other name do not matter.
"""

from __future__ import annotations

import functools
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm import _common as C

VOCABULARY = "word_bpe_49k.json"
CAPACITY = 2048
END_ID = 0
GROUP = 8192  # pieces packed together in the first round
POOL = 32768  # and in the exchange rounds

ASCII_SPACE = np.zeros(256, bool)
ASCII_SPACE[[0x20, *range(0x09, 0x0E)]] = True
ASCII_LETTER = np.zeros(256, bool)
ASCII_LETTER[0x61:0x7B] = True
PUNCTUATION = np.zeros(256, bool)
PUNCTUATION[0x21:0x7F] = True
PUNCTUATION[[0x27, *range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = False


#: A word that the tokenizer's pattern keeps whole: Latin letters, or punctuation.
ONE_WORD = re.compile(rb"[ \t-\r]*(?:(?:[a-z]|\xc3[\xa0-\xb6\xb8-\xbf\x9f])+|[!-&(-/:-@\[-`{-~]+)").fullmatch


class WordTokenizer:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.special = [t.content.lower().encode() for t in self.library.get_added_tokens_decoder().values()]
        ids = self.library.encode("0", add_special_tokens=False).ids
        assert len(ids) == 1  # a digit is always a word of its own: it separates words below
        self.mark = ids[0]
        self.model = self.library.model
        # the tokenizer's byte alphabet: visible bytes stand for themselves, the others follow from 256 on
        shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        rest = [b for b in range(256) if b not in shown]
        self.alphabet = {b: 256 + k for k, b in enumerate(rest)}
        self.memo: dict[bytes, bytes] = {}

    def encode(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def learn(self, words: list[bytes]) -> None:
        """Ids of the words that are not yet known."""
        memo, tokenize, alphabet = self.memo, self.model.tokenize, self.alphabet
        if len(memo) > 200_000:  # bounded memory
            memo.clear()
        plain = []
        for w in words:
            if w in memo:
                continue
            if ONE_WORD(w):
                memo[w] = struct.pack(f"<{len(x)}I", *x) if (
                    x := [t.id for t in tokenize(w.strip().decode("latin-1").translate(alphabet))]) else b""
            elif b"0" in w:
                self.memo[w] = self.encode(w.decode("utf-8", "replace"))
            else:
                plain.append(w)
        for i in range(0, len(plain), 2000):
            some = plain[i:i + 2000]
            ids = np.array(self.library.encode(" 0 ".join(w.decode("utf-8", "replace") for w in some),
                                               add_special_tokens=False).ids, "<u4")
            ends = np.flatnonzero(ids == self.mark)
            begin = [0, *(ends + 1).tolist()]
            end = [*ends.tolist(), len(ids)]
            assert len(begin) == len(some)
            self.memo.update((w, ids[a:b].tobytes()) for w, a, b in zip(some, begin, end))

    def ids(self, t: C.Texts) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows after another, and where each row begins (and the end)."""
        from shoplens.llm.language_id import lower

        if b"<|" in t.data.tobytes() and any(s in lower(t.data).tobytes() for s in self.special):
            rows = [self.encode(t.row(i).decode("utf-8", "replace")) for i in range(len(t))]
            off = np.zeros(len(rows) + 1, np.int64)
            np.cumsum([len(r) // 4 for r in rows], out=off[1:])
            return np.frombuffer(b"".join(rows), "<u4"), off
        if not len(t.data):
            return np.zeros(0, "<u4"), np.zeros(len(t) + 1, np.int64)
        d = lower(t.data)
        a, b = d[:-1], d[1:]
        space = ASCII_SPACE[d]
        cut = space[1:] & ~space[:-1]
        latin_end = np.zeros(len(d), bool)  # last byte of a two-byte Latin-1 letter
        latin_end[1:] = (a == 0xC3) & (b >= 0x80) & (b != 0x97) & (b != 0xB7)
        latin_begin = np.zeros(len(d), bool)
        latin_begin[:-1] = latin_end[1:]
        letter = ASCII_LETTER[d]
        punct = PUNCTUATION[d]
        cut |= (letter[:-1] | latin_end[:-1]) & punct[1:]
        cut |= punct[:-1] & (letter[1:] | latin_begin[1:])
        starts = C.starts_of(t, cut)
        codes, words = C.distinct(d, starts)
        self.learn(words)
        coded = [self.memo[w] for w in words]
        length = np.array([len(x) // 4 for x in coded], np.int64)
        first = np.cumsum(length) - length
        pool = np.frombuffer(b"".join(coded), "<u4")
        each = length[codes]
        upto = np.concatenate([[0], np.cumsum(each)])
        return pool[C.ragged(first[codes], each)], upto[np.searchsorted(starts, t.off)]


@functools.lru_cache(maxsize=2)
def tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)  # once per Python worker


PIECES = "p array<struct<piece: int, start: long, length: long, ids_crc32: long>>"


def cut_pieces(ids: np.ndarray, off: np.ndarray, capacity: int) -> list[list[dict]]:
    out = []
    end = np.array([END_ID], "<u4").tobytes()
    for a, b in zip(off[:-1].tolist(), off[1:].tolist()):
        whole = ids[a:b].tobytes() + end
        n = b - a + 1
        out.append([{"piece": k, "start": s, "length": min(capacity, n - s),
                     "ids_crc32": zlib.crc32(whole[4 * s:4 * (s + capacity)])}
                    for k, s in enumerate(range(0, n, capacity))])
    return out


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer_dir: str | None = None,
           capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: the documents' pieces."""
    path = C.tokenizer_path(VOCABULARY, tokenizer_dir)

    def make():
        tok = tokenizer(path)
        return lambda t, _: [cut_pieces(*tok.ids(t), capacity)]

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return (C.annotate(rows, "text", PIECES, make, "cut", C.WORD_SLICE_BYTES, tokenizer.cache_clear)
            .select("doc_id", F.explode("cut.p").alias("p")).select("doc_id", "p.*"))


# ---------------------------------------------------------------- packing
def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and place of each piece, and the load of each bin. ``room`` has a
    bit for every amount of free space that some bin has."""
    bins = np.empty(len(lengths), np.int64)
    places = np.empty(len(lengths), np.int64)
    loads: list[int] = []
    free: dict[int, list[int]] = {}
    room = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        fits = room >> size
        if fits:
            left = size + (fits & -fits).bit_length() - 1  # the tightest
            held = free[left]
            k = held.pop()
            if not held:
                room &= ~(1 << left)
        else:
            left, k = capacity, len(loads)
            loads.append(0)
        bins[i], places[i] = k, loads[k]
        loads[k] += size
        left -= size
        if left:
            free.setdefault(left, []).append(k)
            room |= 1 << left
    return bins, places, np.array(loads, np.int64)


def lower_bound(lengths: np.ndarray, capacity: int, counts: np.ndarray | None = None) -> int:
    """Least number of bins, by two families of dual feasible functions, for
    pieces of ``lengths``, each as often as ``counts`` says (once).

    For each threshold x up to half the capacity, pieces over capacity - x
    count as full bins and pieces under x as nothing; and for k = 1, 2, ...
    a share s of a bin with (k + 1) s not whole counts as floor((k + 1) s) / k.
    """
    if not len(lengths):
        return 0
    order = np.argsort(lengths, kind="stable")
    size = lengths[order].astype(np.int64)
    many = np.ones(len(size), np.int64) if counts is None else counts[order].astype(np.int64)
    total = np.concatenate([[0], np.cumsum(size * many)])
    number = np.concatenate([[0], np.cumsum(many)])
    x = np.unique(np.concatenate([[0], size[size <= capacity // 2]]))
    lo = np.searchsorted(size, x, side="left")
    hi = np.searchsorted(size, capacity - x, side="right")
    best = int(np.max(number[-1] - number[hi] + -(-(total[hi] - total[lo]) // capacity)))
    for k in range(1, 21):
        scaled = (k + 1) * size
        whole = scaled % capacity == 0
        # in units of 1 / (k * capacity) of a bin
        units = np.where(whole, size * k, scaled // capacity * capacity)
        best = max(best, int(-(-int((units * many).sum()) // (k * capacity))))
    return best


def table_bound(items: DataFrame, capacity: int = CAPACITY) -> int:
    """Least number of sequences for all pieces (of at most ``capacity``
    different lengths)."""
    rows = items.groupBy("length").agg(F.count(F.lit(1)).alias("n")).toArrow()
    return lower_bound(rows.column("length").to_numpy(), capacity, rows.column("n").to_numpy())


def certificate(packed: DataFrame, capacity: int = CAPACITY) -> dict[str, int]:
    """Sequences of a packed table, and the bound that no packing can be under."""
    return {"sequences": packed.where("offset = 0").count(), "bound": table_bound(packed, capacity)}


def pack_groups(items: DataFrame, groups: int, turn: int, capacity: int) -> DataFrame:
    """Packs each group; adds bin, offset, load (of the bin), bins and bound
    (of the group), and whether the bin is the group's least filled one."""
    keep = [c for c in items.columns if c not in ("group", "turn", "bin", "offset", "load", "bins", "bound", "tail")]
    dealt = items.select(*keep, F.pmod(F.xxhash64("deal", F.lit(turn)), F.lit(groups)).alias("group"),
                         F.lit(turn).alias("turn"))
    extra = "bin long, offset long, load long, bins long, bound long, tail boolean"

    def run(rows: pa.Table) -> pa.Table:
        lengths = rows.column("length").to_numpy()
        # the order of a group's rows must not matter
        order = np.argsort(rows.column("deal").to_numpy(), kind="stable")
        bins, places, loads = best_fit_decreasing(lengths[order], capacity)
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        n = len(lengths)
        for name, values in (("bin", bins[back]), ("offset", places[back]), ("load", loads[bins[back]]),
                             ("bins", np.full(n, len(loads))), ("bound", np.full(n, lower_bound(lengths, capacity)))):
            rows = rows.append_column(name, pa.array(values, pa.int64()))
        return rows.append_column("tail", pa.array(bins[back] == (int(loads.argmin()) if len(loads) else -1)))

    C.ship(items.sparkSession)
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.schema.fields) + ", " + extra
    return dealt.groupBy("group").applyInArrow(run, ddl)


def pack(items: DataFrame, capacity: int = CAPACITY, group: int = GROUP, pool: int = POOL,
         rounds: int | None = None) -> DataFrame:
    """Pieces with sequence_id and offset. ``items``: any columns and length.
    ``rounds`` of exchange at most, by default as many as save anything."""
    items = C.cut(items.withColumn("deal", F.monotonically_increasing_id()))  # fixed by the checkpoint
    n = items.count()
    least = table_bound(items, capacity)
    state = C.cut(pack_groups(items, max(1, -(-n // group)), 0, capacity))
    sequences = state.where("offset = 0").count()  # an offset of 0 is a sequence's first piece
    done, turn = None, 0
    while sequences > least and turn != rounds:
        turn += 1
        gap = (F.col("load") < capacity) & ((F.col("bins") > F.col("bound")) | F.col("tail"))
        open_ = state.where(gap)
        have = open_.agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("tokens"),
                         F.sum((F.col("offset") == 0).cast("long")).alias("bins")).first()
        if not have.n or have.bins <= -(-have.tokens // capacity):
            break
        again = C.cut(pack_groups(open_, max(1, -(-have.n // pool)), turn, capacity))
        saved = have.bins - again.where("offset = 0").count()
        if saved <= 0:
            break
        sequences -= saved
        kept = state.where(~gap)
        done = kept if done is None else done.unionByName(kept)
        state = again
    out = state if done is None else done.unionByName(state)
    # a turn's groups are numbered after those of the turns before
    sequence = (F.col("turn").cast("long") * max(1, -(-n // min(group, pool))) + F.col("group")) * (1 << 24) + F.col("bin")
    return out.withColumn("sequence_id", sequence).drop("deal", "group", "turn", "bin", "load", "bins", "bound", "tail")


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer_dir: str | None = None,
                   capacity: int = CAPACITY, group: int = GROUP, pool: int = POOL,
                   rounds: int | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    packed = pack(pieces(docs, id_col, text_col, tokenizer_dir, capacity), capacity, group, pool, rounds)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op6_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    return pack_documents(C.table(spark, sf_dir, "documents").select("doc_id", "text"))
