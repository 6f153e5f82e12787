"""SimHash near-duplicates by anchor-point covering (operator 5).

A text's fingerprint has a bit set where over half of its shingles' XXH64
values have it. Two texts are linked if their fingerprints differ in at most
``max_bits`` bits; groups are the connected components of the links.

Covering: of three differing bits at most one falls into one of two disjoint
31-bit halves of the fingerprint (bits 0-30 and 33-63). In a half the anchors
are the code words of the perfect (31, 26) Hamming code, a covering of radius 1:
every word is at home at the one anchor within 1, and is copied to all 1 or 16
anchors within 2 = covering radius 1 + threshold 1. If two words differ in at
most one bit, each has a copy at the other's home. Fingerprints are compared
per anchor; every link is a true distance over all 64 bits.

Work is on distinct fingerprints, so copies cost nothing. An anchor's
fingerprints leave the task as links that join them, never as all pairs; an
anchor with more than ``most`` of them is not held by one task: its rows are
dealt into cells of pairs of blocks and compared there.

Edge cases: null and empty texts and texts without words have fingerprint
zero, linked like any other; fewer words than a shingle are one shingle;
repeated rows and ids fall into one group by their fingerprint; a group's id is its
smallest non-null id; an empty table gives an empty result; columns of any
other name do not matter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm import _common as C
from shoplens.llm.components import connected_components

SHINGLE = 3
MAX_BITS = 3
SEED = 42
MOST_AT_ANCHOR = 20_000
SMALL = 48  # up to so many fingerprints at an anchor are compared in one sweep with other anchors'


# ------------------------------------------------------------ fingerprints
def shingle_hashes(row: bytes, size: int) -> list[int]:
    words = row.lower().split()
    n = len(words)
    if not n:
        return []
    norm = b" ".join(words)
    if n <= size:
        return [xxhash.xxh64_intdigest(norm, SEED)]
    ends = np.cumsum([len(w) + 1 for w in words])
    begin = [0, *ends[:n - size].tolist()]
    end = (ends[size - 1:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    return [digest(norm[s:e], SEED) for s, e in zip(begin, end)]


def majority(hashes: list[int], block: int = 1 << 16) -> int:
    """Bits set in over half of the values."""
    count = np.zeros(64, np.int64)
    for i in range(0, len(hashes), block):
        h = np.array(hashes[i:i + block], ">u8")
        count += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * count > len(hashes)).tobytes(), "big") if hashes else 0


def with_fingerprint(docs: DataFrame, text_col: str = "text", shingle: int = SHINGLE, name: str = "simhash") -> DataFrame:
    """``docs`` plus a struct ``name`` with the fingerprint as a signed long."""
    def make():
        def run(t, _):
            prints = np.array([majority(shingle_hashes(t.row(i), shingle)) for i in range(len(t))], np.uint64)
            return [prints.view(np.int64)]
        return run

    return C.annotate(docs, text_col, "fingerprint long", make, name)


def as_hex(fingerprint):
    return F.lpad(F.lower(F.hex(fingerprint)), 16, "0")


# ----------------------------------------------------------------- anchors
HALVES = (0, 33)  # first bits of the two 31-bit halves
LENGTH = 31
#: Flips of two bits whose labels (1-31) cancel a syndrome: 15 pairs for each of 1-31.
PAIR_FLIPS = np.array([[(1 << (i - 1)) | (1 << ((i ^ s) - 1)) for i in range(1, 32) if i < (i ^ s)] for s in range(1, 32)],
                      np.int64)


def syndrome(word: np.ndarray) -> np.ndarray:
    """Sum of the labels of the set bits; 0 for code words."""
    out = np.zeros(len(word), np.int64)
    for j in range(5):
        mask = np.int64(sum(1 << (i - 1) for i in range(1, 32) if i >> j & 1))
        out |= (np.bitwise_count(word & mask).astype(np.int64) & 1) << j
    return out


def anchors(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All (anchor, fingerprint, at home) of the fingerprints; an anchor is a
    code word with the number of its half above."""
    keys, whose, home = [], [], []
    for k, first in enumerate(HALVES):
        word = ((prints >> np.uint64(first)) & np.uint64((1 << LENGTH) - 1)).astype(np.int64)
        s = syndrome(word)
        base = np.int64(k) << LENGTH
        off = s > 0
        nearest = word.copy()
        nearest[off] ^= np.int64(1) << (s[off] - 1)
        keys.append(base | nearest)
        whose.append(prints)
        home.append(np.ones(len(prints), bool))
        visits = word[off, None] ^ PAIR_FLIPS[s[off] - 1]
        keys.append((base | visits).ravel())
        whose.append(np.repeat(prints[off], visits.shape[1]))
        home.append(np.zeros(visits.size, bool))
    return np.concatenate(keys), np.concatenate(whose), np.concatenate(home)


def near(a: np.ndarray, b, max_bits: int) -> np.ndarray:
    return np.bitwise_count(a ^ b) <= max_bits


def spanning_links(prints: np.ndarray, max_bits: int) -> tuple[list, list]:
    """Links that join what is within ``max_bits``, directly or in steps: one
    per fingerprint at most. Each one absorbs its neighbours once."""
    rest = np.unique(prints)
    a, b = [], []
    while len(rest):
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            f = queue.pop()
            hit = near(rest, f, max_bits)
            if hit.any():
                found = rest[hit]
                a.append(np.full(len(found), f))
                b.append(found)
                queue.extend(found)
                rest = rest[~hit]
    return a, b


def compare(keys: np.ndarray, prints: np.ndarray, home: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links among rows sorted by key, anchor by anchor."""
    if not len(keys):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    size = np.diff(np.append(first, len(keys)))
    group = np.repeat(np.arange(len(first)), size)
    a, b = [], []
    at = np.flatnonzero(home & (size[group] > 1) & (size[group] <= SMALL))
    for i in range(0, len(at), 1 << 16):  # each resident with all others of its anchor
        some = at[i:i + (1 << 16)]
        left = np.repeat(prints[some], size[group[some]])
        right = prints[C.ragged(first[group[some]], size[group[some]])]
        hit = (left != right) & near(left, right, max_bits)
        a.append(left[hit])
        b.append(right[hit])
    for g in np.flatnonzero(size > SMALL):
        rows = slice(first[g], first[g] + size[g])
        if home[rows].any():
            x, y = spanning_links(prints[rows], max_bits)
            a += x
            b += y
    if not a:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return np.concatenate(a), np.concatenate(b)


LINK = "anchor long, a long, b long"  # anchor is null in a link; b is null in a row put off


def _links_of_sorted(batches, max_bits: int, most: int):
    """Links of rows that come sorted by anchor; rows of an anchor that has
    more than ``most`` are passed on as they come, not held."""
    def batch(anchor, a, b):
        return pa.RecordBatch.from_arrays([anchor, a, b], names=["anchor", "a", "b"])

    def links(keys, prints, home):
        a, b = compare(keys, prints, home, max_bits)
        pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
        return batch(pa.nulls(len(pairs), pa.int64()), pa.array(np.ascontiguousarray(pairs[:, 0]).view(np.int64)),
                     pa.array(np.ascontiguousarray(pairs[:, 1]).view(np.int64)))

    def put_off(keys, prints):
        return batch(pa.array(keys), pa.array(prints.view(np.int64)), pa.nulls(len(keys), pa.int64()))

    held = (np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, bool))
    hot = None
    for x in batches:
        new = (x.column("anchor").to_numpy(), x.column("print").to_numpy().view(np.uint64),
               x.column("home").to_numpy(zero_copy_only=False))
        keys, prints, home = (np.concatenate(c) for c in zip(held, new))
        if hot is not None:
            n = int(np.searchsorted(keys, hot, side="right"))
            yield put_off(keys[:n], prints[:n])
            keys, prints, home = keys[n:], prints[n:], home[n:]
            if len(keys):
                hot = None
        if not len(keys):
            held = (keys, prints, home)
            continue
        last = int(np.searchsorted(keys, keys[-1], side="left"))
        if last:
            yield from _whole_anchors(keys[:last], prints[:last], home[:last], most, links, put_off)
        held = (keys[last:], prints[last:], home[last:])
        if len(held[0]) > most:
            hot = int(held[0][0])
            yield put_off(held[0], held[1])
            held = tuple(c[:0] for c in held)
    yield from _whole_anchors(*held, most, links, put_off)


def _whole_anchors(keys, prints, home, most, links, put_off):
    if not len(keys):
        return
    _, back, size = np.unique(keys, return_inverse=True, return_counts=True)
    large = size[back] > most
    yield links(keys[~large], prints[~large], home[~large])
    if large.any():
        yield put_off(keys[large], prints[large])


def find_links(prints: DataFrame, max_bits: int = MAX_BITS, most: int = MOST_AT_ANCHOR) -> DataFrame:
    """a, b: links that join all near fingerprints. ``prints``: one long
    column ``fingerprint``, each value once."""
    if not 0 <= max_bits <= 3:
        raise ValueError("two halves and a threshold of one bit in a half cover up to three bits")
    C.ship(prints.sparkSession)

    def copies(batches):
        for x in batches:
            f = x.column("fingerprint").to_numpy().view(np.uint64)
            for i in range(0, len(f), 1 << 15):
                keys, whose, home = anchors(f[i:i + (1 << 15)])
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(whose.view(np.int64)), pa.array(home)],
                                                 names=["anchor", "print", "home"])

    at_anchors = (prints.select("fingerprint").mapInArrow(copies, "anchor long, print long, home boolean")
                  .repartition("anchor").sortWithinPartitions("anchor"))
    found = C.cut(at_anchors.mapInArrow(lambda batches: _links_of_sorted(batches, max_bits, most), LINK))
    near_links = found.where("anchor IS NULL").select("a", "b")
    hot = found.where("anchor IS NOT NULL").select("anchor", F.col("a").alias("print"))
    if hot.isEmpty():
        return near_links
    return near_links.unionByName(_links_of_hot(hot, max_bits, most))


def _links_of_hot(hot: DataFrame, max_bits: int, most: int) -> DataFrame:
    """Compares an anchor's fingerprints block by block: each row goes to the
    cells (i, j), i <= j, of its block with every block of its anchor."""
    blocks = hot.groupBy("anchor").agg(F.ceil(F.count(F.lit(1)) / F.lit(most)).cast("long").alias("blocks"))
    mine = F.pmod(F.xxhash64("print"), F.col("blocks"))
    cells = (hot.join(blocks, "anchor").select("anchor", "print", mine.alias("mine"),
                                               F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"))
             .select("anchor", "print", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j")))

    def run(rows: pa.Table) -> pa.Table:
        a, b = spanning_links(rows.column("print").to_numpy().view(np.uint64), max_bits)
        none = [np.zeros(0, np.uint64)]
        return pa.table({"a": np.concatenate(a or none).view(np.int64), "b": np.concatenate(b or none).view(np.int64)})

    return cells.groupBy("anchor", "i", "j").applyInArrow(run, "a long, b long")


# ------------------------------------------------------------------ groups
def _groups(slim: DataFrame, max_bits: int, most: int) -> DataFrame:
    """fingerprint, root, component_id of each distinct fingerprint in
    ``slim`` (doc_id, fingerprint)."""
    prints = slim.groupBy("fingerprint").agg(F.min("doc_id").alias("least"))
    roots = connected_components(find_links(prints, max_bits, most))
    prints = (prints.join(roots, prints.fingerprint == roots.node, "left")
              .select("fingerprint", "least", F.coalesce("root", "fingerprint").alias("root")))
    ids = prints.groupBy("root").agg(F.min("least").alias("component_id"))
    return prints.join(ids, "root").select("fingerprint", "root", "component_id")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS, most: int = MOST_AT_ANCHOR) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id, one row per row."""
    slim = with_fingerprint(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "text", shingle)
    slim = C.cut(slim.select("doc_id", "simhash.fingerprint"))
    groups = _groups(slim, max_bits, most).select("fingerprint", "component_id")
    return slim.join(groups, "fingerprint").select("doc_id", as_hex(F.col("fingerprint")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
             max_bits: int = MAX_BITS, most: int = MOST_AT_ANCHOR) -> DataFrame:
    """One row of each group, the one with the smallest id, as it is in
    ``docs``. Rows are known by two hashes of id and text, so that the texts
    are shuffled once, for the choice and for repeated rows."""
    def keys(i, t):
        return [F.xxhash64(F.lit(k), F.col(i), F.col(t)) for k in range(2)]

    k1, k2 = C.fresh_name(docs, "row_k1"), C.fresh_name(docs, "row_k2")
    slim = with_fingerprint(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "text", shingle)
    a, b = keys("doc_id", "text")
    slim = C.cut(slim.select("doc_id", a.alias(k1), b.alias(k2), "simhash.fingerprint"))
    groups = _groups(slim, max_bits, most).select("fingerprint", "root")
    kept = (slim.join(groups, "fingerprint").groupBy("root")
            .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", k1, k2)).alias("k")).select(f"k.{k1}", f"k.{k2}"))
    a, b = keys(id_col, text_col)
    rows = docs.withColumns({k1: a, k2: b}).join(kept, [k1, k2], "left_semi")
    return rows.dropDuplicates([k1, k2]).select(*[F.col(f"`{c}`") for c in docs.columns])


def op5_simhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(C.table(spark, sf_dir, "documents"))
