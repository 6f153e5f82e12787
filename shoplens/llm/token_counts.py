"""Token counts by heap-and-linked-list byte-pair merging (operator 7).

The vocabulary is read from a public sentencepiece BPE model; texts are never
given to the library. A segment starts as a linked list of characters. A heap
holds every adjacent pair whose concatenation is a piece, by rank, ties by
place; the lowest is popped and merged until none is left. The count is the
number of initial symbols (a character outside the vocabulary stands for its
UTF-8 bytes) minus the number of merges; no token ids are made.

Texts are cut only where no piece of the vocabulary holds the two bytes at the
cut side by side, so no merge could cross it and counts of segments add up.
Each distinct segment of a slice is merged once.

Edge cases: null and empty texts have 0 bytes and 0 tokens; a text of any
length is counted in full (memory follows its longest segment without a cut); repeated rows are counted each; an empty table
gives an empty result; other columns do not matter.
"""

from __future__ import annotations

import functools
import heapq
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm import _common as C

VOCABULARY = "piece_bpe_32k.model"
TOKEN_LIMIT = 4096
SPACE = "▁"


class Merger:
    """Pieces with ranks (0 merges first), and the bytes that may not be cut."""

    def __init__(self, model_path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=Path(model_path).read_bytes())
        self.rank = {sp.id_to_piece(i).replace(SPACE, " "): -sp.get_score(i) for i in range(sp.get_piece_size())
                     if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))}
        self.cut = np.ones((256, 256), bool)
        for piece in self.rank:
            for a, b in zip(piece, piece[1:]):
                self.cut[a.encode()[-1], b.encode()[0]] = False
        self.cut[:, 0x80:0xC0] = False  # inside a character
        self.memo = C.Memo(lambda segment: self.count(segment.decode("utf-8", "replace")))

    def count(self, text: str) -> int:
        """Tokens of ``text`` (spaces stand for the space mark), by merging."""
        rank = self.rank
        symbols = sum(1 if c in rank else len(c.encode("utf-8", "replace")) for c in text)
        n = len(text)
        if n < 2:
            return symbols
        piece = list(text)
        right = list(range(1, n + 1))  # linked list; n ends it
        left = list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            r = rank.get(text[i:i + 2])
            if r is not None:
                heap.append((r, i, i + 1, 2))
        heapq.heapify(heap)
        merges = 0
        while heap:
            _, i, j, size = heapq.heappop(heap)
            a, b = piece[i], piece[j]
            if not a or not b or len(a) + len(b) != size:
                continue  # one side has merged meanwhile
            piece[i], piece[j] = a + b, ""
            merges += 1
            k = right[i] = right[j]
            if k < n:
                left[k] = i
                r = rank.get(a + b + piece[k])
                if r is not None:
                    heapq.heappush(heap, (r, i, k, size + len(piece[k])))
            h = left[i]
            if h >= 0:
                r = rank.get(piece[h] + a + b)
                if r is not None:
                    heapq.heappush(heap, (r, h, i, size + len(piece[h])))
        return symbols - merges

    def counts(self, t: C.Texts) -> np.ndarray:
        """Tokens of each row."""
        if SPACE.encode() in t.data.tobytes():
            t = plain_spaces(t)
        rows = np.flatnonzero(t.off[1:] > t.off[:-1])
        out = np.zeros(len(t), np.int64)
        if not len(rows):
            return out
        d = t.data
        starts = C.starts_of(t, self.cut[d[:-1], d[1:]])
        codes, words = C.distinct(d, starts)
        memo = self.memo
        tokens = np.array([memo[w] for w in words], np.int64)[codes]
        # a text begins with a space mark: its first segment is counted with it
        firsts = np.searchsorted(starts, t.off[rows])
        for k in firsts:
            tokens[k] = memo[b" " + words[codes[k]]]
        out[rows] = np.add.reduceat(tokens, firsts)
        return out


def plain_spaces(t: C.Texts) -> C.Texts:
    rows = [t.row(i).replace(SPACE.encode(), b" ") for i in range(len(t))]
    off = np.zeros(len(rows) + 1, np.int64)
    np.cumsum([len(r) for r in rows], out=off[1:])
    return C.Texts(np.frombuffer(b"".join(rows), np.uint8), off, t.null, t.first)


@functools.lru_cache(maxsize=2)
def merger(model_path: str) -> Merger:
    return Merger(model_path)  # once per Python worker


def count_tokens(df: DataFrame, text_col: str = "text", tokenizer_dir: str | None = None,
                 limit: int = TOKEN_LIMIT, name: str = "tokens") -> DataFrame:
    """``df`` plus a struct ``name``: n_bytes, n_tokens, over_limit."""
    path = C.tokenizer_path(VOCABULARY, tokenizer_dir)

    def make():
        m = merger(path)

        def run(t, _):
            n = m.counts(t)
            return [np.diff(t.off), n, n > limit]
        return run

    return C.annotate(df, text_col, "n_bytes long, n_tokens long, over_limit boolean", make, name,
                      C.WORD_SLICE_BYTES, merger.cache_clear)


def op7_token_counts(spark, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents").select("doc_id", "text")
    return count_tokens(docs, name="t").select("doc_id", F.col("t.n_bytes"), F.col("t.n_tokens"), F.col("t.over_limit"))
