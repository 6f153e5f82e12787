"""Repeated long substrings by a logarithmic family of suffix arrays (operator 8).

A byte is removed if it lies in a string of ``length`` bytes that also starts
anywhere else, judged on the input. Texts are compared as bytes; matches never
cross documents.

Suffixes. Indexing all suffixes of the corpus would take several times its
size, so the arrays are sparse. A window of ``length`` bytes owns the suffix
that starts at its smallest 32-byte gram (by hash, leftmost on ties). Equal
windows own equal suffixes at the same distance, so comparing suffixes (and
what stands before them) finds all equal windows. Their order is that of a hash
of their first 32 bytes, not of the bytes: equal ones stand together, which is
all that matching asks for.

Index family. The texts come in batches. A batch's suffix array has its owned
suffixes - text, place, windows, hashes - in the order of a hash of their first
32 bytes (the core), then of text and place. On arrival it is scanned against
every level of the family, which finds the suffixes that occur again, in it or
in an earlier batch; then it joins the family as a level of size one, and while
two levels have the same size they are merged, so that each entry is rewritten a
logarithmic number of times. All other suffixes have no match. Of those found,
one that occurs with its whole context again matches for all its windows; one
that matches in part is refined, first in blocks of 24 windows (common core,
whole extent), then window by window, each time counted over all texts.

Equal texts are one text with a mark, so groups of copies cost nothing; counts
are aggregated before they are shuffled, so a common passage is no hot key.
Texts travel compressed and are shuffled once.

Cores are only a filter. What decides is compared by 128 bits: a whole context
by the hashes of its core and of itself, a window by two hashes. Two different
ones among n agree with probability n * n / 2 ** 129.

Edge cases: null and empty texts and texts under ``length`` bytes lose nothing;
texts of any length are compared whole, in segments; repeated rows are copies
of each other and lose everything if long enough; an empty table gives an
empty result; columns of any other name are kept by ``remove_repeats``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm import _common as C
from shoplens.llm._common import Scratch

LENGTH = 400
GRAM = 32
BLOCK = 24
BATCHES = 4
SEGMENT = 1 << 19


# ------------------------------------------------------------ local search
class Segment:
    """Bytes of some rows' segments one after another. Segment i holds its
    row's bytes from ``base[i]``; it stands at off[i]:off[i + 1]."""

    def __init__(self, parts: list[tuple[int, int, bytes]]):
        self.row = np.array([r for r, _, _ in parts], np.int64)
        self.base = np.array([b for _, b, _ in parts], np.int64)
        self.off = np.zeros(len(parts) + 1, np.int64)
        np.cumsum([len(x) for _, _, x in parts], out=self.off[1:])
        self.data = np.frombuffer(b"".join(x for _, _, x in parts), np.uint8)
        self.hashes = [C.RangeHash(self.data, base) for base in C.BASES]

    def hash(self, start, end) -> np.ndarray:
        """Two hashes of a range, made one that is never 0."""
        a, b = (h(start, end) for h in self.hashes)
        return (C.scramble(a ^ (b >> np.uint64(1))) | np.uint64(1)).view(np.int64)


def segments(rows: list[tuple[int, bytes, np.ndarray | None]], length: int) -> Iterator[tuple[Segment, list]]:
    """Slices of whole rows' segments of about SEGMENT bytes. A segment of a
    long row is one of its SEGMENT-long stretches with ``length`` bytes before
    and twice that after. With each slice: the (row, stretch) of its parts."""
    parts, which, held = [], [], 0
    for r, text, places in rows:
        wanted = range(0, len(text), SEGMENT) if places is None else np.unique(places // SEGMENT * SEGMENT).tolist()
        for s in wanted:
            base = max(0, s - length)
            piece = text[base:s + SEGMENT + 2 * length]
            if held and held + len(piece) > SEGMENT + 4 * length:
                yield Segment(parts), which
                parts, which, held = [], [], 0
            parts.append((r, base, piece))
            which.append((r, s))
            held += len(piece)
    if parts:
        yield Segment(parts), which


def sliding_minimum(v: np.ndarray, width: int) -> np.ndarray:
    """Smallest value of each run of ``width`` values."""
    n = len(v) - width + 1
    padded = np.full(-(-len(v) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:len(v)] = v
    grid = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1:width - 1 + n])


def own_suffixes(rows: list[tuple[int, bytes]], length: int) -> dict[str, np.ndarray]:
    """The suffixes that windows own: row, place, nearest and farthest start
    of an owned window before it, and hashes of the gram (core) and of all
    that windows around it can hold (extent; 0 where that runs over the ends)."""
    reach = length - GRAM
    out = []
    for seg, which in segments([(r, x, None) for r, x in rows if len(x) >= length], length):
        n = len(seg.data)
        gram = seg.hashes[0](np.arange(n - GRAM + 1), np.arange(GRAM, n + 1))
        v = (gram & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(gram), dtype=np.uint64)
        smallest = sliding_minimum(v, reach + 1)
        # the windows that start in the stretch and end in the row
        begin = np.array([seg.off[i] + s - seg.base[i] for i, (_, s) in enumerate(which)], np.int64)
        count = np.minimum(seg.off[1:] - length + 1 - begin, SEGMENT).clip(min=0)
        window = C.ragged(begin, count)
        if not len(window):
            continue
        part = np.repeat(np.arange(len(which)), count)
        place = (smallest[window] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (part[1:] != part[:-1])]))
        last = np.append(first[1:], len(window)) - 1
        a, part = place[first], part[first]
        whole = (a - reach >= seg.off[part]) & (a + length <= seg.off[part + 1])
        core = seg.hashes[0](a, a + GRAM).view(np.int64)
        extent = np.where(whole, seg.hash(np.where(whole, a - reach, a), np.where(whole, a + length, a)), 0)
        to_row = seg.base[part] - seg.off[part]
        out.append([seg.row[part], a + to_row, a - window[last], a - window[first], core, extent])
    names = ("row", "place", "near", "far", "core", "extent")
    cols = {n: np.concatenate([o[k] for o in out]) if out else np.zeros(0, np.int64) for k, n in enumerate(names)}
    # a suffix at the seam of two stretches is one
    same = np.flatnonzero((cols["row"][1:] == cols["row"][:-1]) & (cols["place"][1:] == cols["place"][:-1])) + 1
    for i in same[::-1].tolist():
        cols["near"][i - 1] = min(cols["near"][i - 1], cols["near"][i])
        cols["far"][i - 1] = max(cols["far"][i - 1], cols["far"][i])
    return {k: np.delete(c, same) for k, c in cols.items()}


def _in_segments(rows: list[tuple[int, bytes]], node_row: np.ndarray, place: np.ndarray, length: int):
    """For each slice of segments: the numbers of the nodes in it and where
    they stand in the slice, and their parts."""
    by_row = {r: np.flatnonzero(node_row == r) for r, _ in rows} if len(rows) < 64 else None
    if by_row is None:
        order = np.argsort(node_row, kind="stable")
        cuts = np.searchsorted(node_row[order], [r for r, _ in rows] + [np.iinfo(np.int64).max])
        ends = np.searchsorted(node_row[order], [r for r, _ in rows], side="right")
        by_row = {r: order[c:e] for (r, _), c, e in zip(rows, cuts, ends)}
    for seg, which in segments([(r, x, place[by_row[r]]) for r, x in rows], length):
        nodes, at, part = [], [], []
        for i, (r, s) in enumerate(which):
            mine = by_row[r]
            mine = mine[(place[mine] >= s) & (place[mine] < s + SEGMENT)]
            nodes.append(mine)
            at.append(place[mine] - seg.base[i] + seg.off[i])
            part.append(np.full(len(mine), i))
        yield seg, np.concatenate(nodes), np.concatenate(at), np.concatenate(part)


def block_hashes(rows: list[tuple[int, bytes]], node_row, place, near, far, length: int) -> list[np.ndarray]:
    """For each node and each block of distances it has: node, block, nearest
    and farthest distance, core (what all the block's windows share) and extent
    (all that they hold)."""
    out = []
    top = length - GRAM
    for seg, nodes, at, part in _in_segments(rows, node_row, place, length):
        first, last = near[nodes] // BLOCK, far[nodes] // BLOCK
        count = last - first + 1
        block = C.ragged(first, count)
        n, a, p = np.repeat(nodes, count), np.repeat(at, count), np.repeat(part, count)
        lo, hi = block * BLOCK, np.minimum(block * BLOCK + BLOCK - 1, top)
        whole = (a - hi >= seg.off[p]) & (a - lo + length <= seg.off[p + 1])
        core = seg.hash(a - lo, a - hi + length) ^ (block + 1)
        extent = np.where(whole, seg.hash(np.where(whole, a - hi, a), np.where(whole, a - lo + length, a)), 0)
        out.append([n, block, np.maximum(near[n], lo), np.minimum(far[n], hi), core, extent])
    return [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 6


def window_hashes(rows: list[tuple[int, bytes]], node_row, place, near, far, length: int) -> list[np.ndarray]:
    """For each node and distance: node, start of the window, hashes."""
    out = []
    for seg, nodes, at, _ in _in_segments(rows, node_row, place, length):
        count = far[nodes] - near[nodes] + 1
        d = C.ragged(near[nodes], count)
        n, a = np.repeat(nodes, count), np.repeat(at, count)
        out.append([n, place[n] - d, *[h(a - d, a - d + length).view(np.int64) for h in seg.hashes]])
    return [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 4


# ------------------------------------------------------------------- records
# A record is (k1, k2, node, core, extent): the text's key, a place in it with
# what it stands for, and two hashes. ``node`` packs place, nearest and
# farthest distance of the windows, block of distances and whether the text has
# copies into one long. ``extent`` is 0 where it runs over the text's ends.
PLACE, NEAR, FAR, BLOCK_AT = 25, 16, 7, 1
NINE, FIVE = 0x1FF, 0x1F
KEY = ["k1", "k2"]
RECORD = "k1 long, k2 long, node long, core long, extent long"


def pack_nodes(place, near, far, block, copied) -> np.ndarray:
    return (place << PLACE) | (near << NEAR) | (far << FAR) | (block << BLOCK_AT) | copied


def unpack_nodes(node: np.ndarray) -> tuple[np.ndarray, ...]:
    """place, nearest, farthest."""
    return node >> PLACE, (node >> NEAR) & NINE, (node >> FAR) & NINE


def _weight():
    """Occurrences of a record, as far as they matter: 1, or 2 for copies."""
    return F.lit(1).cast("long") + F.col("node").bitwiseAND(1)


def _window_range():
    """First and last start of the windows a record stands for."""
    place = F.shiftright("node", PLACE)
    return F.struct((place - F.shiftright("node", FAR).bitwiseAND(NINE)).alias("first"),
                    (place - F.shiftright("node", NEAR).bitwiseAND(NINE)).alias("last"))


# ------------------------------------------------------------ index family
class IndexFamily:
    """Suffix arrays as levels of 1, 2, 4, ... batches. An array holds records
    in the order of (core, text, place); a batch that arrives is scanned
    against every level, and two levels of a size are merged into one."""

    def __init__(self, scratch: Scratch):
        self.scratch = scratch
        self.levels: list[tuple[int, DataFrame]] = []
        self.found: list[DataFrame] = []

    def _array(self, records: DataFrame) -> DataFrame:
        """Sorted by range; a core with very many records is cut by text."""
        order = ["core", *KEY, "node"]
        return self.scratch.table(records.repartitionByRange(*order).sortWithinPartitions(*order), "suffix-array")

    def add(self, records: DataFrame) -> None:
        """A batch of records (a written table) becomes a suffix array; the
        cores that it has more than once or that a level has are matches."""
        size, array = 1, self._array(records)
        cores = array.groupBy("core").agg(F.sum(_weight()).alias("n"))
        hits = cores.where("n > 1").select("core")
        for _, level in self.levels:
            hits = hits.unionByName(cores.select("core").join(level.select("core").distinct(), "core", "left_semi"))
        self.found.append(self.scratch.table(hits.distinct(), "core-matches"))
        while self.levels and self.levels[-1][0] == size:
            pair = [self.levels.pop()[1], array]
            array = self._array(pair[0].unionByName(pair[1]))
            size *= 2
            for old in pair:
                self.scratch.drop(old)
        self.levels.append((size, array))

    def matched(self) -> DataFrame:
        """All records whose core occurs again, in whichever batch."""
        cores, live = self.found[0], self.levels[0][1]
        for x in self.found[1:]:
            cores = cores.unionByName(x)
        for _, x in self.levels[1:]:
            live = live.unionByName(x)
        cores = self.scratch.table(cores.distinct(), "core-matches")
        return self.scratch.table(live.join(cores, "core", "left_semi"), "matched")


def judge(live: DataFrame, scratch: Scratch) -> DataFrame:
    """Records whose core occurs again: ``repeated`` if their whole extent does
    (all their windows match), ``open`` if they are to be refined, for
    themselves or as the one witness of equal extents for others. Counts are
    written before they are joined: between two plain shuffles Spark splits the
    records of a very common core among tasks."""
    whole = F.col("extent") != 0
    # a core is mixed unless all its extents are whole and the same
    cores = live.groupBy("core").agg(F.sum(_weight()).alias("total"), F.min("extent").alias("low"), F.max("extent").alias("high"),
                                     F.max((~whole).cast("int")).alias("cut"))
    cores = scratch.table(cores.where("total > 1").select(
        "core", ((F.col("low") != F.col("high")) | (F.col("cut") == 1)).alias("mixed")), "cores")
    again = (live.where(whole).groupBy("core", "extent")
             .agg(F.sum(_weight()).alias("n"), F.min(F.xxhash64(*KEY, "node")).alias("witness"))
             .where("n > 1").select("core", "extent", "witness"))
    again = scratch.table(again, "extents")
    repeated = F.col("witness").isNotNull()
    is_witness = F.xxhash64(*KEY, "node") == F.col("witness")
    return live.join(cores, "core").join(again, ["core", "extent"], "left").select(
        *KEY, "node", repeated.alias("repeated"), (F.col("mixed") & (~repeated | is_witness)).alias("open"))


# ------------------------------------------------------------------ search
def text_key(text_col: str) -> list:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2")]


def distinct_texts(docs: DataFrame, text_col: str, length: int) -> DataFrame:
    """k1, k2, copied (1 if it has copies) and z (compressed text) of each
    distinct text that is long enough; spread by the key, each partition in its
    order. Copies are dropped before texts are shuffled."""
    rows = docs.select(*text_key(text_col), F.col(text_col).alias("t")).where(F.octet_length("t") >= length)

    def squeeze(batches):
        C.hold(__name__)
        pack = zstandard.ZstdCompressor(level=3).compress
        for b in batches:
            z = pa.array([pack(x) for x in b.column("t").cast(pa.large_binary()).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column("k1"), b.column("k2"), z], names=["k1", "k2", "z"])

    spark = docs.sparkSession
    C.ship(spark)
    return (rows.mapInArrow(squeeze, "k1 long, k2 long, z binary")
            .groupBy(*KEY).agg((F.count(F.lit(1)) > 1).cast("long").alias("copied"), F.first("z").alias("z"))
            .repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), *KEY).sortWithinPartitions(*KEY))


def _map_texts(joined: DataFrame, ddl: str, work) -> DataFrame:
    """Runs ``work`` on slices of (compressed) texts with their nodes, if any;
    it returns row numbers and then the columns after k1, k2."""
    names = [part.split()[0] for part in ddl.split(", ")]
    with_nodes = "nodes" in joined.columns

    def run(batches):
        C.hold(__name__)
        unpack = zstandard.ZstdDecompressor().decompress
        for big in batches:
            # slices of bounded size: texts are unpacked a few at a time
            size = np.cumsum([zstandard.frame_content_size(x) for x in big.column("z").to_pylist()])
            i = 0
            while i < len(big):
                j = max(i + 1, int(np.searchsorted(size, (size[i - 1] if i else 0) + SEGMENT, side="right")))
                b = big.slice(i, j - i)
                i = j
                rows = [(r, unpack(z)) for r, z in enumerate(b.column("z").to_pylist())]
                copied = b.column("copied").to_numpy()
                if with_nodes:
                    lists = b.column("nodes")
                    nodes = lists.flatten().to_numpy()
                    row, *cols = work(rows, copied, np.repeat(np.arange(len(rows)), np.asarray(lists.value_lengths())), nodes)
                else:
                    row, *cols = work(rows, copied)
                if len(row):
                    take = pa.array(row)
                    yield pa.RecordBatch.from_arrays([b.column("k1").take(take), b.column("k2").take(take),
                                                      *[pa.array(c) for c in cols]], names=["k1", "k2", *names])
        pa.default_memory_pool().release_unused()

    C.ship(joined.sparkSession)
    return joined.mapInArrow(run, f"k1 long, k2 long, {ddl}")


def _with_open(texts: DataFrame, judged: DataFrame) -> DataFrame:
    nodes = judged.where("open").groupBy(*KEY).agg(F.collect_list("node").alias("nodes"))
    return texts.join(nodes, KEY).select(*KEY, "copied", "z", "nodes")


def repeated_windows(texts: DataFrame, scratch: Scratch, length: int = LENGTH, batches: int = BATCHES) -> DataFrame:
    """k1, k2, ranges: (first, last) starts of windows that occur elsewhere."""
    hashes = "node long, core long, extent long"

    def suffixes(rows, copied):
        s = own_suffixes(rows, length)
        node = pack_nodes(s["place"], s["near"], s["far"], 0, copied[s["row"]])
        return s["row"], node, s["core"], s["extent"]

    family = IndexFamily(scratch)
    for k in range(batches):
        batch = texts.where(F.pmod(F.xxhash64(*KEY), F.lit(batches)) == k).select(*KEY, "copied", "z")
        records = scratch.table(_map_texts(batch, hashes, suffixes), "suffixes")
        family.add(records)
        scratch.drop(records)
    judged = scratch.table(judge(family.matched(), scratch), "matches")
    found = judged.where("repeated").select(*KEY, _window_range().alias("range"))

    def blocks(rows, copied, row, nodes):
        n, block, near, far, core, extent = block_hashes(rows, row, *unpack_nodes(nodes), length)
        return row[n], pack_nodes(nodes[n] >> PLACE, near, far, block, copied[row[n]]), core, extent

    records = scratch.table(_map_texts(_with_open(texts, judged), hashes, blocks), "blocks")
    judged = scratch.table(judge(records, scratch), "block-matches")
    found = found.unionByName(judged.where("repeated").select(*KEY, _window_range().alias("range")))

    def windows(rows, copied, row, nodes):
        n, place, h1, h2 = window_hashes(rows, row, *unpack_nodes(nodes), length)
        return row[n], (place << 1) | copied[row[n]], h1, h2

    records = scratch.table(_map_texts(_with_open(texts, judged), "node long, h1 long, h2 long", windows), "windows")
    again = records.groupBy("h1", "h2").agg(F.sum(_weight()).alias("n")).where("n > 1").select("h1", "h2")
    again = scratch.table(again, "window-matches")
    start = F.shiftright("node", 1)
    single = records.join(again, ["h1", "h2"]).select(*KEY, F.struct(start.alias("first"), start.alias("last")).alias("range"))
    return found.unionByName(single).groupBy(*KEY).agg(F.collect_list("range").alias("ranges"))


def covered(ranges: list[dict], copied: int, size: int, length: int) -> list[tuple[int, int]]:
    """Maximal runs of removed bytes."""
    if copied and size >= length:
        return [(0, size)]
    out: list[list[int]] = []
    for a, b in sorted((r["first"], r["last"] + length) for r in ranges or []):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


RESULT = "k1 long, k2 long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<first: long, last: long>>"


def find_repeats(docs: DataFrame, text_col: str = "text", length: int = LENGTH, batches: int = BATCHES) -> DataFrame:
    """Of each distinct text that loses bytes: k1, k2 (its key), n_removed,
    n_spans, kept_sha256, spans (bytes removed, end exclusive)."""
    if length < 2 * GRAM:
        raise ValueError(f"strings of at least {2 * GRAM} bytes are looked for")
    texts = distinct_texts(docs, text_col, length).persist(StorageLevel.DISK_ONLY)
    scratch = Scratch(docs.sparkSession)
    ranges = repeated_windows(texts, scratch, length, batches)
    kinds = C.arrow_schema(C.StructType.fromDDL(RESULT))

    def run(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        for b in batches:
            out = []
            for k1, k2, copied, z, found in zip(*(b.column(c).to_pylist() for c in ("k1", "k2", "copied", "z", "ranges"))):
                text = unpack(z)
                spans = covered(found, copied, len(text), length)
                digest, at = hashlib.sha256(), 0
                for s, e in spans:
                    digest.update(text[at:s])
                    at = e
                digest.update(text[at:])
                out.append((k1, k2, sum(e - s for s, e in spans), len(spans), digest.hexdigest(),
                            [{"first": s, "last": e} for s, e in spans]))
            cols = list(zip(*out)) or [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(cols, kinds)], names=kinds.names)

    C.ship(docs.sparkSession)
    losing = texts.join(ranges, KEY, "left").where("copied = 1 OR ranges IS NOT NULL")
    result = Scratch(docs.sparkSession).table(losing.select(*KEY, "copied", "z", "ranges").mapInArrow(run, RESULT), "repeats")
    texts.unpersist()
    scratch.clear()
    return result


def remove_repeats(docs: DataFrame, text_col: str = "text", length: int = LENGTH, batches: int = BATCHES,
                   count_col: str | None = None) -> DataFrame:
    """All rows of ``docs``, without the characters that lie wholly in
    removed bytes; ``count_col``, if given, becomes the text's length."""
    found = find_repeats(docs, text_col, length, batches)
    k1, k2, spans, kept = (C.fresh_name(docs, x) for x in ("repeats_k1", "repeats_k2", "repeats_spans", "repeats_kept"))
    found = found.select(F.col("k1").alias(k1), F.col("k2").alias(k2), F.col("spans").alias(spans))
    keys = text_key(text_col)
    rows = docs.withColumns({k1: keys[0], k2: keys[1]}).join(found, [k1, k2], "left")

    def make():
        def run(t, batch):
            col = batch.column(batch.schema.names.index(spans))
            out = []
            for i in range(len(t)):
                row, at, parts = t.row(i), 0, []
                for s in col[t.first + i].as_py() or []:
                    a, b = s["first"], s["last"]
                    while a < b and row[a] & 0xC0 == 0x80:
                        a += 1  # the rest of a character that begins before
                    while b > a and b < len(row) and row[b] & 0xC0 == 0x80:
                        b -= 1  # a character that goes on behind
                    parts.append(row[at:a])
                    at = b
                out.append(None if t.null[i] else (b"".join(parts) + row[at:]).decode("utf-8", "replace"))
            return [out]
        return run

    rows = C.annotate(rows, text_col, "text string", make, kept).withColumn(text_col, F.col(f"{kept}.text"))
    if count_col:
        rows = rows.withColumn(count_col, F.length(text_col).cast(docs.schema[count_col].dataType))
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns])


def op8_suffix_array_dedup(spark, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_repeats(docs).drop("spans")
    text = F.coalesce("text", F.lit(""))
    whole = docs.select("doc_id", *text_key("text"), F.octet_length(text).cast("long").alias("n_bytes"),
                        F.sha2(text, 256).alias("whole_sha256"))
    return whole.join(found, KEY, "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).alias("n_spans"), F.coalesce("kept_sha256", "whole_sha256").alias("kept_sha256"))
