"""Similarity join of documents on word shingles by a token-group matrix (operator 12).

A document's set holds the 64-bit hashes of its distinct shingles. Two sets
link when the intersection has at least ``percent`` hundredths of the union.

Documents with equal sets are one set. Sets are partitioned into groups of
similar ones: of about the same size and with the same smallest shingle (by a
hash); a group that is too large for a task is cut into several.

Which groups to look at. Linked sets differ in at most d shingles, d known from
their sizes. So when shingles are dealt by hash into d + 1 parts, linked sets are
equal in at least one part. The rows of the matrix are such parts - a hash of all
shingles of a set that fall into one - and its columns the groups that have a
member with it: as a part holds several shingles, sets that are not alike hardly
ever meet, however large the corpus. A part without shingles says nothing: a set
that has one is dealt a second time by another hash, and so on ``ROUNDS`` times.

A part that very many sets have (more than ``HOT``: the words of a common line,
or a crowd of near copies) is no row. The sets that have any such part meet by
single shingles instead, each once, in however many such parts it is. In any order of
all shingles, the larger of two linked sets has, among its first
n - ceil(percent n / 100) + 1, one of the smaller's first n - ceil(2 percent n /
(100 + percent)) + 1. Shingles that are frequent anywhere in the corpus come
last in the order, so what meets there shares something rare.

For a group that a query meets, the group's texts are fetched. The query's overlap
with the union of the members' shingles bounds that with any member; only a
group that passes is opened, that is, its members' overlaps are counted.

The result is components, so a group is looked into only where it can still
change them. First groups are joined within themselves, and the parts of a group
that was cut with its first part. Then every query looks into one other group
that is not all in its component, then into all of these that are left. No step
emits the pairs of a group of copies: a query yields one link for each component
of members.

Bounds: a group has at most about ``MOST`` sets and ``GROUP_TOKENS`` shingles
(a larger set is alone); its queries stream past it, in cells where they are
many. The frequent shingles (at most ``FREQUENT``) and the filter of the texts
to fetch (2**BITS bits) are broadcast; both are of fixed size and change only
the work, never the result.

Edge cases: fewer words than a shingle are one shingle; null and empty texts
and texts without words have an empty set, linked with nothing, and their own
id as component; rows with equal sets link; rows are told apart by their sets,
not their ids, so repeated rows and null ids are in the component of their set,
whose id is the smallest that is not null; an empty table gives an empty
result; columns of any other name do not matter.
"""

from __future__ import annotations

import contextlib
import functools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm import _common as C
from shoplens.llm import _grams as G
from shoplens.llm.components import connected_components

SHINGLE = 3
PERCENT = 90
INSIDE = G.byte_class(0x20, *range(0x09, 0x0E))
MOST = 1024
GROUP_TOKENS = 1 << 20
FREQUENT = 1 << 16
BITS = 26
STEP = 1.25  # sizes of one band of sets
ROUNDS = 4
HOT = 64
ROWS_PER_PARTITION = 1 << 15  # of tables with keys and numbers only
TEXTS_PER_PARTITION = 1 << 9
CHUNK = 1 << 21  # shingles of a task that are counted at once for frequent ones
SHARE = 256  # frequent: in one of so many documents of a chunk


# ------------------------------------------------------------------- sets
def sets_of(t: C.Texts, size: int) -> list[np.ndarray]:
    """Each row's distinct shingle hashes, ascending."""
    w = G.Words(t, INSIDE)
    at, h = w.grams(size)
    bounds = np.searchsorted(w.row[at], np.arange(len(t) + 1))
    out = []
    for r in range(len(t)):
        if 0 < w.count[r] < size:
            out.append(w.hash_at(w.row_at[r:r + 1], int(w.count[r])))
        else:
            out.append(np.unique(h[bounds[r]:bounds[r + 1]]))
    return out


SALT = np.uint64(0xA0761D6478BD642F)


def signature(s: np.ndarray) -> tuple[int, int]:
    """128 bits that equal sets share."""
    with np.errstate(over="ignore"):
        return int(C.scramble(s).sum(dtype=np.uint64)), int(C.scramble(s ^ SALT).sum(dtype=np.uint64))


def needed(n: int, percent: int) -> int:
    return -(-percent * n // 100)


class Order:
    """All shingles in one order: those not known as frequent by hash, then
    the frequent ones, the more frequent the later."""

    def __init__(self, tokens: np.ndarray, counts: np.ndarray):
        by_token = np.argsort(tokens)
        self.tokens = tokens[by_token]
        self.place = np.empty(len(tokens), np.int64)
        self.place[np.lexsort((tokens, counts))] = np.arange(len(tokens))
        self.place = self.place[by_token]

    def split(self, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rare ones, frequent ones), each in order."""
        if not len(self.tokens):
            return s, s[:0]
        at = np.minimum(np.searchsorted(self.tokens, s), len(self.tokens) - 1)
        known = self.tokens[at] == s
        often = s[known]
        return s[~known], often[np.argsort(self.place[at[known]])]


def frequent_shingles(texts: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles in many distinct sets of some stretch of the table, with the
    counts of these stretches; the ``FREQUENT`` most counted of them."""
    def counted(batches):
        held, seen, total = [], set(), 0

        def flush():
            tokens, n = np.unique(np.concatenate(held), return_counts=True)
            many = n >= max(4, len(seen) // SHARE)
            return pa.RecordBatch.from_arrays([pa.array(tokens[many].view(np.int64)), pa.array(n[many])], names=["token", "n"])

        for b in batches:
            for part in C.slices(C.texts_of(b.column("text"))):
                for s in sets_of(part, size):
                    key = signature(s)
                    if len(s) and key not in seen:
                        seen.add(key)
                        held.append(s)
                        total += len(s)
                if total >= CHUNK:
                    yield flush()
                    held, seen, total = [], set(), 0
        if held:
            yield flush()

    C.ship(texts.sparkSession)
    top = (texts.select("text").mapInArrow(counted, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
           .orderBy(F.col("n").desc(), "token").limit(FREQUENT).toArrow())
    return top.column("token").to_numpy().view(np.uint64), top.column("n").to_numpy()


def first_ones(order: Order, s: np.ndarray, percent: int) -> tuple[np.ndarray, int]:
    """The shingles by which a set meets smaller ones, in order, and how many of
    them it meets larger ones by."""
    rare, often = order.split(s)
    n = len(s)
    p = n - needed(n, percent) + 1
    some = rare[:p] if len(rare) >= p else np.concatenate([rare, often[:p - len(rare)]])
    return some, n - -(-2 * percent * n // (100 + percent)) + 1


# ------------------------------------------------------------------- parts
@functools.lru_cache(maxsize=1 << 16)
def band_of(n: int) -> int:
    return int(math.log(n) / math.log(STEP) + 1e-9)


@functools.lru_cache(maxsize=1 << 12)
def parts_of(band: int, percent: int) -> int:
    """More than two linked sets can differ in, the larger of which is in ``band``."""
    top = int(STEP ** (band + 1)) + 2
    while band_of(top) > band:
        top -= 1
    return (100 - percent) * 2 * top // (100 + percent) + 1


def part_keys(s: np.ndarray, percent: int) -> np.ndarray:
    """Hashes of a set's parts, for each band that the larger set of a link
    can be in."""
    n = len(s)
    out = []
    for band in range(band_of(n), band_of(100 * n // percent) + 1):
        parts = parts_of(band, percent)
        if parts == 1:
            continue  # only equal sets link
        for turn in range(ROUNDS):
            mixed = C.scramble(s ^ np.uint64((turn + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
            place = (mixed % np.uint64(parts)).astype(np.int64)
            total = np.zeros(parts, np.uint64)
            np.add.at(total, place, C.scramble(mixed ^ SALT))
            held = np.bincount(place, minlength=parts)
            with np.errstate(over="ignore"):
                number = np.uint64((band * ROUNDS + turn) << 32) + np.arange(parts, dtype=np.uint64)
                keys = C.scramble(total + C.scramble(number) + held.astype(np.uint64))
            empty = held == 0
            out.append(keys if turn == ROUNDS - 1 else keys[~empty])
            if not empty.any():
                break
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


SET_FIELDS = "n long, handle long, sid binary, least long, parts array<bigint>"


def key_of(s: np.ndarray) -> bytes:
    a, b = signature(s)
    return a.to_bytes(8, "big") + b.to_bytes(8, "big")


def handle_of(sid: bytes) -> int:
    return int.from_bytes(sid[:8], "big", signed=True)


def with_sets(docs: DataFrame, size: int, percent: int, name: str) -> DataFrame:
    """``docs`` plus a struct: the set's size, its key (16 bytes, of which
    ``handle`` is the first half), its smallest shingle by another hash, and its parts."""
    def make():
        def run(t, _):
            n, sid, least, parts, off = [], [], [], [], [0]
            for s in sets_of(t, size):
                n.append(len(s))
                sid.append(key_of(s))
                least.append(int(C.scramble(s ^ SALT).min().view(np.int64)) if len(s) else 0)
                parts.append(part_keys(s, percent) if len(s) else s)
                off.append(off[-1] + len(parts[-1]))
            flat = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
            return [n, [handle_of(x) for x in sid], pa.array(sid, pa.binary()), least, G.lists(flat.view(np.int64), np.array(off))]
        return run

    return C.annotate(docs, "text", SET_FIELDS, make, name)


def shared_parts(full: DataFrame) -> DataFrame:
    """key, handle: each part that different sets have, with these."""
    def run(batches):
        key, handle, sent = np.zeros(0, np.int64), np.zeros(0, np.int64), False  # the last key's rows so far
        for b in batches:
            k = np.concatenate([key, b.column("key").to_numpy()])
            h = np.concatenate([handle, b.column("handle").to_numpy()])
            if not len(k):
                continue
            new = np.ones(len(k), bool)
            new[1:] = (k[1:] != k[:-1]) | (h[1:] != h[:-1])
            k, h = k[new], h[new]
            first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
            size = np.diff(np.append(first, len(k)))
            several = np.repeat(size > 1, size)
            if sent:
                several[0] = False  # went out with the batch before
            yield pa.RecordBatch.from_arrays([pa.array(k[several]), pa.array(h[several])], names=["key", "handle"])
            sent = bool(size[-1] > 1) or (sent and len(size) == 1)
            key, handle = k[-1:], h[-1:]

    entries = full.select(F.explode("parts").alias("key"), "handle").repartition("key").sortWithinPartitions("key", "handle")
    return entries.mapInArrow(run, "key long, handle long")


# ------------------------------------------------------------------ groups
def grouped(sets: DataFrame, percent: int, scratch: C.Scratch) -> DataFrame:
    """``sets`` plus gid and head: groups of sets with the same ``least`` and
    sizes in the same band, and the first part of the group if it was cut.
    Larger groups have larger numbers. Different groups that get the same
    number are one group; it does not matter which sets share one."""
    step = math.log(100 / percent) if percent < 100 else 1.0
    sets = sets.withColumn("band", F.floor(F.log(F.col("n").cast("double")) / F.lit(step)))
    of_group = scratch.table(sets.groupBy("band", "least").agg(F.count(F.lit(1)).alias("members"), F.sum("n").alias("tokens"))
                             .where("members > 1"), "group-sizes")
    parts = F.greatest(F.ceil(F.col("members") / F.lit(MOST)), F.ceil(F.col("tokens") / F.lit(GROUP_TOKENS)))
    many = of_group.select("band", "least", "members", parts.alias("parts"))
    out = sets.join(many, ["band", "least"], "left")
    part = F.coalesce(F.pmod(F.xxhash64("sid"), F.col("parts")), F.lit(0).cast("long"))
    size = F.floor(F.log2(F.coalesce(F.col("members") / F.col("parts"), F.lit(1.0)) + F.lit(0.5))).cast("long")

    def number(k):
        return F.shiftleft(size, 56).bitwiseOR(F.shiftrightunsigned(F.xxhash64("band", "least", k), 8))

    return out.withColumns({"gid": number(part), "head": number(F.lit(0).cast("long"))}).drop("band", "least", "members", "parts")


def divided(texts: DataFrame, shared: DataFrame, sets: DataFrame, size: int, percent: int, scratch: C.Scratch) -> DataFrame:
    """key, handle, first: ``shared`` without the keys of very many sets, and
    single shingles of the sets that have such a key. Both of two linked sets
    that share one have it, so a set's shingles are needed once, not for each
    of its keys. ``first``: whether the set meets larger ones by it."""
    hot = scratch.table(shared.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HOT).select("key"), "hot-keys")
    plain = shared.withColumn("first", F.lit(True))
    if hot.isEmpty():
        return plain
    order = texts.sparkSession.sparkContext.broadcast(Order(*frequent_shingles(texts, size)))
    crowded = shared.join(hot, "key", "left_semi").select("handle").distinct()
    wanted = scratch.table(sets.join(crowded, "handle", "left_semi").select("k1", "k2"), "crowded-texts")

    def run(batches):
        known = order.value
        for b in batches:
            for part in C.slices(C.texts_of(b.column("text"))):
                handle, tokens, off, first = [], [], [0], []
                for s in sets_of(part, size):
                    if len(s):
                        some, n = first_ones(known, s, percent)
                        handle.append(handle_of(key_of(s)))
                        tokens.append(some)
                        off.append(off[-1] + len(some))
                        first.append(n)
                flat = np.concatenate(tokens) if tokens else np.zeros(0, np.uint64)
                yield pa.RecordBatch.from_arrays([pa.array(handle, pa.int64()), G.lists(flat.view(np.int64), np.array(off)),
                                                  pa.array(first, pa.int32())], names=["handle", "tokens", "n_first"])

    ones = fetched(texts, wanted).select("text").mapInArrow(run, "handle long, tokens array<bigint>, n_first int")
    parted = ones.select("handle", "n_first", F.posexplode("tokens").alias("at", "token")).select(
        F.xxhash64(F.lit("shingle"), "token").alias("key"), "handle", (F.col("at") < F.col("n_first")).alias("first"))
    return plain.join(hot, "key", "left_anti").unionByName(parted)


def met_groups(entries: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """handle, gid, shared: the groups of larger number that a set meets, and
    in how many keys; not those that are in its component already. ``sets``:
    handle, gid, n, and ``linked``, a number of its component, null if it is alone."""
    entries = entries.join(sets.select("handle", "gid", F.col("n").cast("int").alias("n"), "linked"), "handle").repartition("key")
    matrix = entries.groupBy("key", "gid").agg(
        F.min("n").alias("least_n"), F.max("n").alias("most_n"), F.min(F.when(F.col("first"), F.col("n"))).alias("least_first"),
        F.min("linked").alias("low"), F.max("linked").alias("high"), F.count_if(F.col("linked").isNull()).alias("alone"))
    q = entries.alias("q")
    g = matrix.alias("g")
    met = q.join(g, (F.col("q.key") == F.col("g.key")) & (F.col("q.gid") < F.col("g.gid"))
                 & ((F.col("g.alone") > 0) | (F.col("g.low") != F.col("g.high")) | ~F.col("q.linked").eqNullSafe(F.col("g.low")))
                 & ((F.col("q.first") & (F.col("g.most_n") >= F.col("q.n"))) | F.coalesce(F.col("g.least_first") <= F.col("q.n"), F.lit(False)))
                 & (F.col("g.most_n").cast("long") * 100 >= F.col("q.n").cast("long") * percent)
                 & (F.col("g.least_n").cast("long") * percent <= F.col("q.n").cast("long") * 100))
    return met.groupBy("q.handle", "g.gid").agg(F.count(F.lit(1)).cast("int").alias("shared"))


def can_link(overlap, n, least, percent: int):
    """Whether so large an overlap of a set of ``n`` with sets of ``least`` or
    more lets any of them link with it."""
    least = np.maximum(least, needed(n, percent))
    return (100 + percent) * overlap >= percent * (n + least)


def runs(batches, keys: list[str]):
    """(first of its key, rows) for each stretch of equal ``keys`` in sorted
    batches; a key that spans batches comes in several stretches."""
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        cols = [b.column(k).to_numpy() for k in keys]
        new = np.ones(b.num_rows, bool)
        new[1:] = np.any([c[1:] != c[:-1] for c in cols], axis=0)
        at = np.append(np.flatnonzero(new), b.num_rows)
        for i, j in zip(at[:-1].tolist(), at[1:].tolist()):
            key = tuple(c[i] for c in cols)
            yield key != last, b.slice(i, j - i)
            last = key


# ----------------------------------------------------------- opening groups
class Group:
    """Members of a group: the token union and who holds each token."""

    def __init__(self, sets: list[np.ndarray], percent: int):
        self.percent = percent
        self.size = np.array([len(s) for s in sets], np.int64)
        self.sets = sets
        self._index(np.arange(len(sets)))

    def _index(self, members: np.ndarray):
        some = [self.sets[i] for i in members]
        flat = np.concatenate(some) if some else np.zeros(0, np.uint64)
        who = np.repeat(members, self.size[members])
        order = np.argsort(flat, kind="stable")
        self.union, self.first = np.unique(flat[order], return_index=True)
        self.first = np.append(self.first, len(flat))
        self.who = who[order]
        self.least = int(self.size[members].min()) if len(members) else 0

    def linked(self, s: np.ndarray) -> np.ndarray:
        """Members that link with ``s``; none, without opening the group, if
        too few of its tokens are in the union."""
        if not len(self.union) or not len(s):
            return np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.union, s), len(self.union) - 1)
        at = at[self.union[at] == s]
        if not can_link(len(at), len(s), self.least, self.percent):
            return np.zeros(0, np.int64)
        holders = self.who[C.ragged(self.first[at], self.first[at + 1] - self.first[at])]
        both = np.bincount(holders, minlength=len(self.size))
        return np.flatnonzero((both > 0) & (100 * both >= self.percent * (len(s) + self.size - both)))

    def components(self) -> tuple[np.ndarray, list[tuple[int, int]]]:
        """A label per member, and the links that make the components: each
        member takes in those of the rest that link with it."""
        label = np.full(len(self.sets), -1, np.int64)
        links = []
        left = indexed = len(self.sets)
        for seed in range(len(self.sets)):
            if label[seed] >= 0:
                continue
            label[seed] = seed
            left -= 1
            queue = [seed]
            while queue and left:
                if 2 * left < indexed:
                    rest = np.flatnonzero(label < 0)
                    self._index(rest)
                    indexed = len(rest)
                i = queue.pop()
                for j in self.linked(self.sets[i]).tolist():
                    if label[j] < 0:
                        label[j] = seed
                        links.append((i, j))
                        queue.append(j)
                        left -= 1
        self._index(np.arange(len(self.sets)))
        return label, links


def _open_sorted(batches, size: int, percent: int):
    """Links of cells whose rows come sorted, members before queries."""
    group, sets, sid, label, a, b = None, [], [], None, [], []

    def flush():
        out = pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])
        a.clear()
        b.clear()
        return out

    def close(within):
        nonlocal group, label
        group = Group(sets, percent)
        found, _ = group.components()
        # stars around the least member need the fewest rounds to join
        order = sorted(range(len(sid)), key=sid.__getitem__)
        least = {}
        label = np.array([least.setdefault(x, i) for x, i in zip(found[order].tolist(), order)], np.int64)[np.argsort(order)]
        if within:
            rays = np.flatnonzero(label != np.arange(len(label))).tolist()
            a.extend(sid[i] for i in rays)
            b.extend(sid[label[i]] for i in rays)

    inside = False
    for new, rows in runs(batches, ["gid", "cell"]):
        if new:
            if group is None and sets:
                close(inside)
            group, sets, sid = None, [], []
            inside = rows.column("within")[0].as_py()
        asks = rows.column("asks").to_numpy(zero_copy_only=False)
        keys = rows.column("sid").to_pylist()
        found = [s for part in C.slices(C.texts_of(rows.column("text"))) for s in sets_of(part, size)]
        for asking, key, s in zip(asks.tolist(), keys, found):
            if not asking:
                sets.append(s)
                sid.append(key)
                continue
            if group is None:
                close(inside)
            hit = group.linked(s)
            if len(hit):
                mine = [sid[j] for j in np.unique(label[hit]).tolist()]
                a.extend([key] * len(mine))
                b.extend(mine)
        if len(a) > 10_000:
            yield flush()
    if group is None and sets:
        close(inside)
    yield flush()


def fetched(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """k1, k2, text: each text that a row of ``wanted`` names, once. Texts that
    a bounded filter of the keys excludes are not shuffled."""
    shared = texts.sparkSession.sparkContext.broadcast(G.Bits.of(wanted.select("k1").distinct(), "k1", BITS))

    def run(batches):
        bits = shared.value
        for b in batches:
            yield b.filter(pa.array(bits.hits(b.column("k1").to_numpy().view(np.uint64))))

    C.ship(texts.sparkSession)
    got = texts.select(*text_keys(), "text").mapInArrow(run, "k1 long, k2 long, text string")
    return got.groupBy("k1", "k2").agg(F.first("text").alias("text"))


def text_keys():
    return [F.xxhash64("text").alias("k1"), F.xxhash64(F.lit(1), F.col("text")).alias("k2")]


def open_groups(texts: DataFrame, sets: DataFrame, asked: DataFrame, crowds: DataFrame | None, size: int, percent: int,
                sizes: Sizes, scratch: C.Scratch) -> DataFrame:
    """a, b: links of queries with members of the groups that they ask, and of
    the members of ``crowds`` with each other. ``sets``: sid, handle, n, gid,
    k1, k2 of every set; ``asked``: handle, gid; ``crowds``: gid."""
    asking = asked.join(sets.select("handle", "sid", "n", "k1", "k2"), "handle")
    load = asking.groupBy("gid").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("size"))
    cells = load.select("gid", F.greatest(F.ceil(F.col("rows") / F.lit(8 * MOST)), F.ceil(F.col("size") / F.lit(4 * GROUP_TOKENS)))
                        .cast("long").alias("cells"), F.lit(False).alias("within"))
    if crowds is not None:
        cells = cells.unionByName(crowds.select("gid", F.lit(1).cast("long").alias("cells"), F.lit(True).alias("within")))
        cells = cells.groupBy("gid").agg(F.max("cells").alias("cells"), F.max("within").alias("within"))
    cells = scratch.table(cells, "cells")
    members = sets.join(cells, "gid").select(
        "gid", F.explode(F.sequence(F.lit(0).cast("long"), F.col("cells") - 1)).alias("cell"), "within", "sid", "k1", "k2", F.lit(False).alias("asks"))
    members = members.withColumn("within", F.col("within") & (F.col("cell") == 0))
    queries = asking.join(cells, "gid").select(
        "gid", F.pmod(F.xxhash64("sid"), F.col("cells")).alias("cell"), F.lit(False).alias("within"), "sid", "k1", "k2", F.lit(True).alias("asks"))
    rows = scratch.table(members.unionByName(queries), "cell-rows")
    with sizes.of(rows.count(), TEXTS_PER_PARTITION):
        rows = rows.join(fetched(texts, rows), ["k1", "k2"]).drop("k1", "k2")
        rows = rows.repartition("gid", "cell").sortWithinPartitions("gid", "cell", "asks")
        return scratch.table(rows.mapInArrow(lambda batches: _open_sorted(batches, size, percent), "a binary, b binary"), "links")


class Sizes:
    """Shuffle partitions for jobs over tables of known size: not more than
    their rows need, nor than the session has."""

    NAME = "spark.sql.shuffle.partitions"

    def __init__(self, spark):
        self.spark, self.usual = spark, int(spark.conf.get(self.NAME))

    @contextlib.contextmanager
    def of(self, rows: int, each: int = ROWS_PER_PARTITION):
        before = self.spark.conf.get(self.NAME)
        self.spark.conf.set(self.NAME, str(max(1, min(self.usual, -(-rows // each)))))
        try:
            yield
        finally:
            self.spark.conf.set(self.NAME, before)


def _components(links: DataFrame, sizes: Sizes, scratch: C.Scratch) -> DataFrame:
    with sizes.of(links.count()):
        return scratch.table(connected_components(links, write=lambda edges: scratch.table(edges, "edges")), "roots")


def _labelled(sets: DataFrame, roots: DataFrame) -> DataFrame:
    return sets.join(roots, sets.sid == roots.node, "left").select(*sets.columns, F.coalesce("root", "sid").alias("root"))


def similarity_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, one row per row."""
    if not 0 < percent <= 100:
        raise ValueError("percent is from 1 to 100")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    scratch = C.Scratch(docs.sparkSession)
    full = scratch.table(with_sets(texts, shingle, percent, "s").select("doc_id", *text_keys(), "s.*"), "sets-of-rows")
    slim = full.select("doc_id", "n", "sid")
    sets = full.where("n > 0").groupBy("sid").agg(*[F.first(c).alias(c) for c in ("handle", "n", "least")],
                                                  F.min(F.struct("k1", "k2")).alias("k"), F.min("doc_id").alias("min_id"))
    sets = scratch.table(grouped(sets.select("*", "k.k1", "k.k2").drop("k"), percent, scratch), "sets")
    members = sets.select("sid", "handle", "n", "gid", "k1", "k2")

    shared = scratch.table(shared_parts(full), "shared-parts")
    sizes, n = Sizes(docs.sparkSession), sets.count()

    # groups within themselves, and the parts of one group with its first
    with sizes.of(n):
        crowds = sets.groupBy("gid").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("gid")
        parts = sets.where("gid <> head").select("handle", F.col("head").alias("gid"))
        roots = _components(open_groups(texts, members, parts, crowds, shingle, percent, sizes, scratch), sizes, scratch)

    # other groups, where they can change a component
    with sizes.of(max(n, 16 * shared.count())):
        entries = divided(texts, shared, members, shingle, percent, scratch)
        linked = roots.select("node", F.xxhash64("root").alias("linked"))
        linked = members.select("sid", "handle", "n", "gid").join(linked, F.col("sid") == F.col("node"), "left")
        met = scratch.table(met_groups(entries, linked, percent), "met")
    with sizes.of(max(n, met.count())):
        best = scratch.table(met.groupBy("handle").agg(F.max_by("gid", F.struct("shared", F.xxhash64("handle", "gid"))).alias("gid")), "best")
        roots = _grown(roots, open_groups(texts, members, best, None, shingle, percent, sizes, scratch), sizes, scratch)
        now = scratch.table(_labelled(members, roots).select("handle", "gid", "root"), "labels")
        span = now.groupBy("gid").agg(F.min("root").alias("low"), F.max("root").alias("high"))
        rest = scratch.table(met.select("handle", "gid").join(best, ["handle", "gid"], "left_anti").join(now.select("handle", "root"), "handle")
                             .join(span, "gid").where("low <> high OR root <> low").select("handle", "gid").distinct(), "rest")
        if not rest.isEmpty():
            roots = _grown(roots, open_groups(texts, members, rest, None, shingle, percent, sizes, scratch), sizes, scratch)

    ids = _labelled(sets.select("sid", "min_id"), roots)
    least = ids.groupBy("root").agg(F.min("min_id").alias("component_id"))
    found = slim.join(ids.join(least, "root").select("sid", "component_id"), "sid", "left")
    result = C.Scratch(docs.sparkSession).table(found.select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")), "components")
    scratch.clear()
    return result


def _grown(roots: DataFrame, links: DataFrame, sizes: Sizes, scratch: C.Scratch) -> DataFrame:
    """Components of the stars ``roots`` and further links (both written)."""
    if links.isEmpty():
        return roots
    stars = roots.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))
    return _components(stars.unionByName(links), sizes, scratch)


def op12_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return similarity_join(C.table(spark, sf_dir, "documents"))
