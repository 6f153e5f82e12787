"""Benchmark decontamination by a broadcast set of test n-grams (operator 4).

A-Z are lower-cased; words are runs of digits, letters and non-ASCII
characters. The benchmark's windows (13 consecutive words of an item; a
shorter item is one window) become a hash set. Documents are scanned in slices:
rolling 64-bit hashes of all their windows are looked up in it, every hit is
verified word by word, and the words inside a verified window are hit.

What is broadcast is bounded: the distinct items are measured first and dealt
by hash into blocks, so many that none has more than twice ``block_bytes`` of
text unless it is one item. The documents are scanned once for each block. Usual
benchmarks are one block; of further ones only the hits are kept, by two hashes of
the text, and joined to the documents at the end.

Edge cases: null and empty texts and texts without words have no words and no
hits, as have such items; items with a null id mark words but are not named;
repeated rows are judged each; an empty benchmark contaminates nothing; an
empty table gives an empty result; columns of any other name are kept.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm import _common as C

WINDOW = 13
BLOCK_BYTES = 2 << 20  # a window of a block takes some hundred bytes in a worker
FILTER_BITS = 20

WORD = np.zeros(256, bool)
WORD[0x30:0x3A] = WORD[0x61:0x7B] = WORD[0x80:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


class Words:
    """Words of some rows: their byte ranges, hashes and rows."""

    def __init__(self, t: C.Texts):
        self.data = LOWER[t.data]
        w = WORD[self.data]
        edge = np.zeros(len(w) + 1, bool)  # a row's first byte begins anew
        edge[t.off] = True
        before = np.concatenate([[False], w[:-1]]) if len(w) else w
        self.start = np.flatnonzero(w & (~before | edge[:-1]))
        after = np.concatenate([w[1:], [False]]) if len(w) else w
        self.end = np.flatnonzero(w & (~after | edge[1:])) + 1
        self.row_at = np.searchsorted(self.start, t.off)  # first word of each row, and the end
        self.count = np.diff(self.row_at)
        self.row = np.repeat(np.arange(len(t)), self.count)
        self.hash = C.RangeHash(self.data)(self.start, self.end) if len(self.start) else np.zeros(0, np.uint64)

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """First words of all windows of ``size`` words inside a row, and hashes."""
        n = len(self.start) - size + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        at = np.flatnonzero(self.row[:n] == self.row[size - 1:])
        power = C.odd_powers(C.BASES[1], size)
        with np.errstate(over="ignore"):
            h = np.zeros(n, np.uint64)
            for j in range(size):
                h += self.hash[j:j + n] * power[j]
        return at, C.scramble(h[at])

    def words(self, first: int, size: int) -> bytes:
        return b" ".join(self.data[self.start[k]:self.end[k]].tobytes() for k in range(first, first + size))


class WindowSet:
    """Windows of benchmark items by size: hash -> window -> item numbers."""

    def __init__(self, rows: list[tuple[object, str | None]], window: int = WINDOW):
        import pyarrow as pa

        self.ids = [None if i is None else str(i) for i, _ in rows]
        self.by_size: dict[int, dict[int, dict[bytes, set[int]]]] = {}
        t = C.texts_of(pa.array([x or "" for _, x in rows], pa.string()))
        w = Words(t)
        for size in sorted({min(int(c), window) for c in w.count if c}):
            table = self.by_size.setdefault(size, {})
            at, hashes = w.windows(size)
            whole = w.count[w.row[at]]
            mine = (whole >= window) if size == window else (whole == size)
            for first, h in zip(at[mine].tolist(), hashes[mine].tolist()):
                table.setdefault(h, {}).setdefault(w.words(first, size), set()).add(int(w.row[first]))

    def prepare(self):
        """Per size: a bit per hash prefix, which passes few other windows."""
        out = []
        for size, table in self.by_size.items():
            keys = np.fromiter(table, np.uint64, len(table))
            bits = np.zeros(1 << FILTER_BITS, bool)
            bits[(keys >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
            out.append((size, table, bits))
        return out


def scan(t: C.Texts, prepared, ids) -> list:
    """Per row: n_words, hit spans (words and bytes, disjoint), item ids."""
    w = Words(t)
    delta = np.zeros(len(w.start) + 1, np.int64)
    items: dict[int, set[int]] = {}
    for size, table, bits in prepared:
        at, h = w.windows(size)
        near = np.flatnonzero(bits[(h >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
        for first, key in zip(at[near].tolist(), h[near].tolist()):
            found = table.get(key)
            found = found and found.get(w.words(first, size))
            if found:
                delta[first] += 1
                delta[first + size] -= 1
                items.setdefault(int(w.row[first]), set()).update(found)
    hit = np.cumsum(delta[:-1]) > 0
    spans: list[list] = [[] for _ in range(len(t))]
    names: list[list] = [[] for _ in range(len(t))]
    for r, found in items.items():
        a, b = w.row_at[r], w.row_at[r + 1]
        edge = np.flatnonzero(np.diff(np.concatenate([[0], hit[a:b].view(np.int8), [0]])))
        for s, e in zip(edge[::2].tolist(), edge[1::2].tolist()):
            spans[r].append({"first": s, "last": e, "from_byte": int(w.start[a + s] - t.off[r]),
                             "to_byte": int(w.end[a + e - 1] - t.off[r])})
        names[r] = sorted({ids[k] for k in found if ids[k] is not None})
    return [w.count.astype(np.int64), spans, names]


SPAN = "struct<first: long, last: long, from_byte: long, to_byte: long>"
FOUND = f"n_words long, spans array<{SPAN}>, items array<string>"


def find_windows(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                 item_text_col: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES,
                 name: str = "contamination") -> DataFrame:
    """``docs`` plus a struct ``name``: n_words, n_hit, spans (of hit words,
    end exclusive, with byte places), items (sorted ids), contaminated."""
    spark = docs.sparkSession
    bench = benchmark.select(F.col(item_col).cast("string").alias("id"), F.col(item_text_col).alias("t")).distinct()
    blocks = _blocks(bench, block_bytes)

    def marked(rows: DataFrame, col: str, k: int, at: str) -> DataFrame:
        mine = bench.where(F.pmod(F.xxhash64("id", "t"), F.lit(blocks)) == k)
        held = spark.sparkContext.broadcast(WindowSet([(r.id, r.t) for r in mine.collect()], window))

        def make():
            prepared, ids = held.value.prepare(), held.value.ids
            return lambda t, _: scan(t, prepared, ids)

        return C.annotate(rows, col, FOUND, make, at)

    found = [C.fresh_name(docs, f"{name}_block")]
    more = None
    for k in range(1, blocks):
        hits = (marked(docs.select(F.col(text_col).alias("t")), "t", k, "f").where("size(f.spans) > 0")
                .groupBy(*_text_keys("t")).agg(F.first("f").alias("f")))
        more = hits if more is None else more.unionByName(hits)
    kept = docs
    if more is not None:
        found.append(C.fresh_name(docs, f"{name}_others"))
        k1, k2 = C.fresh_name(docs, "text_k1"), C.fresh_name(docs, "text_k2")
        a, b = _text_keys(text_col)
        flat = C.cut(more).groupBy(F.col("k1").alias(k1), F.col("k2").alias(k2)).agg(F.struct(
            F.flatten(F.collect_list("f.spans")).alias("spans"), F.flatten(F.collect_list("f.items")).alias("items")).alias(found[1]))
        kept = docs.withColumns({k1: a, k2: b}).join(flat, [k1, k2], "left").drop(k1, k2)
        none = F.struct(F.array().cast(f"array<{SPAN}>").alias("spans"), F.array().cast("array<string>").alias("items"))
        kept = kept.withColumn(found[1], F.coalesce(F.col(found[1]), none))
    docs = marked(kept, text_col, 0, found[0])

    spans = F.array_sort(F.concat(*[F.col(f"{c}.spans") for c in found]))
    n_hit = F.aggregate(
        spans, F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("upto")),
        lambda a, x: F.struct((a.n + F.greatest(F.lit(0).cast("long"), x["last"] - F.greatest(x["first"], a.upto))).alias("n"),
                              F.greatest(a.upto, x["last"]).alias("upto")),
        lambda a: a.n)
    n_words = F.col(f"{found[0]}.n_words")
    out = F.struct(
        n_words.alias("n_words"), n_hit.alias("n_hit"), spans.alias("spans"),
        F.array_sort(F.array_distinct(F.concat(*[F.col(f"{c}.items") for c in found]))).alias("items"),
        ((n_hit > 0) & (n_hit * 20 >= n_words)).alias("contaminated"))
    return docs.withColumn(name, out).drop(*found)


def _blocks(bench: DataFrame, block_bytes: int) -> int:
    """So many blocks that the largest is small enough, if items can be parted."""
    size = bench.select("id", "t", F.octet_length("t").alias("n"))
    blocks = max(1, -(-(size.agg(F.sum("n")).first()[0] or 0) // block_bytes))
    while blocks > 1:
        of = size.groupBy(F.pmod(F.xxhash64("id", "t"), F.lit(blocks))).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("k"))
        if not of.where(f"n > {2 * block_bytes} AND k > 1").limit(1).count():
            break
        blocks *= 2
    return blocks


def _text_keys(col: str) -> list:
    return [F.xxhash64(F.col(col)).alias("k1"), F.xxhash64(F.lit(1), F.col(col)).alias("k2")]


def remove_documents(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """Rows that are not contaminated, with the columns of ``docs``."""
    name = C.fresh_name(docs, "contamination")
    found = find_windows(docs, benchmark, text_col, name=name, **options)
    return found.where(~F.col(f"{name}.contaminated")).select(*[F.col(f"`{c}`") for c in docs.columns])


def remove_spans(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """All rows; hit spans (first to last hit byte) are cut out of the text."""
    name = C.fresh_name(docs, "contamination")
    found = find_windows(docs, benchmark, text_col, name=name, **options)
    kept = C.fresh_name(found, "kept")

    def make():
        def run(t, batch):
            col = batch.column(batch.schema.names.index(name)).field("spans")
            out = []
            for i in range(len(t)):
                row, at, parts = t.row(i), 0, []
                for s in sorted(col[t.first + i].as_py(), key=lambda s: s["from_byte"]):
                    parts.append(row[at:max(at, s["from_byte"])])
                    at = max(at, s["to_byte"])
                out.append(None if t.null[i] else (b"".join(parts) + row[at:]).decode("utf-8", "replace"))
            return [out]
        return run

    cutout = C.annotate(found, text_col, "text string", make, kept)
    return cutout.withColumn(text_col, F.col(f"{kept}.text")).select(*[F.col(f"`{c}`") for c in docs.columns])


def op4_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_windows(docs, C.table(spark, sf_dir, "benchmark"), name="c")
    return found.select(
        "doc_id", F.col("c.n_words"), F.col("c.n_hit"), F.size("c.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("c.items", ","), 256).alias("items_sha256"), F.col("c.contaminated"))


_WORDS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS rn, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS m, array_to_string(w[i + 1:i + least(len(w), 13)], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(0, greatest(len(w) - 13, 0) + 1)) AS i FROM b WHERE len(w) > 0)),
dw AS (
  SELECT rn, m, i, array_to_string(w[i + 1:i + m], ' ') AS win
  FROM (SELECT rn, m, w, unnest(range(0, len(w) - m + 1)) AS i
        FROM d, (SELECT DISTINCT m FROM bw) s WHERE len(w) >= m)),
h AS (SELECT dw.rn, dw.m, dw.i, bw.item_id FROM dw JOIN bw ON dw.m = bw.m AND dw.win = bw.win),
hw AS (SELECT rn, count(DISTINCT p) AS n_hit
       FROM (SELECT rn, unnest(range(i, i + m)) AS p FROM (SELECT DISTINCT rn, m, i FROM h)) GROUP BY rn),
hi AS (SELECT rn, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
       FROM (SELECT DISTINCT rn, CAST(item_id AS VARCHAR) AS id FROM h WHERE item_id IS NOT NULL) GROUP BY rn)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(hw.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(hi.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(hi.ids, '')) AS items_sha256,
       coalesce(hw.n_hit, 0) > 0 AND 20 * coalesce(hw.n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN hw USING (rn) LEFT JOIN hi USING (rn)
"""
