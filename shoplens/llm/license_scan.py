"""License scans by patience alignment (operator 10).

A template's words are aligned with a text's: equal words at the heads and tails
are matched, then words that occur once in both; the longest increasing run of
these is kept as anchors, and the gaps between anchors are aligned the same way.
What is left without such words stays unmatched. Of the matches, the run that
has the most matched words less ``least`` for each strange word inside it is the
stretch, and it is aligned again by itself, as more of its words are unique
there, until it no longer shrinks. Coverage is the share of words that are
matched, of the template's words and the strange words of the stretch; at
``least`` or more the license is found there.

Where to align: a template covered to ``least`` misses few words, so at least
one of its ``n - least * n + 1`` rarest words stands in the text, and the stretch
has at most ``n / least - n`` strange words. So only windows around these words
are looked at: where the template would lie if nothing were changed, then with
room for all strange words. Found stretches are skipped over, so each notice of
a text is found. Where stretches of several templates overlap, the one that
explains most is kept: matched words less unmatched ones of template and
stretch, then coverage, then the first by name.

Templates are a table (license, text) or the set below; they are held by every
worker, so a table over ``MOST_BYTES`` is an error.

Edge cases: null and empty texts have no licenses; texts of any length are
scanned whole; of licenses with equal coverage the first by name is best;
repeated rows are scanned each; templates without words find nothing; an empty
table gives an empty result; columns of any other name are kept.
"""

from __future__ import annotations

import bisect
import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm import _common as C
from shoplens.llm.decontaminate import Words

LEAST = 0.8
MOST_BYTES = 8 << 20

# Usual license notices (public texts), by SPDX-like name.
TEMPLATES = {
    "AGPL-3.0": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
        "your option) any later version.",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at",
    ],
    "BSD-2-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met:",
        "Licensed under the BSD 2-Clause License.",
    ],
    "BSD-3-Clause": [
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission.",
        "Licensed under the BSD 3-Clause License.",
    ],
    "CC-BY-4.0": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
    ],
    "CC-BY-NC-4.0": [
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC 4.0.",
    ],
    "CC-BY-NC-ND-4.0": [
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
        "Licensed under CC BY-NC-ND 4.0.",
    ],
    "CC-BY-NC-SA-4.0": [
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
        "Licensed under CC BY-NC-SA 4.0.",
    ],
    "CC-BY-ND-4.0": [
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
        "Licensed under CC BY-ND 4.0.",
    ],
    "CC-BY-SA-4.0": [
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Licensed under CC BY-SA 4.0.",
    ],
    "CC0-1.0": [
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this "
        "work.",
        "This work is licensed under the CC0 1.0 Universal Public Domain Dedication.",
    ],
    "EPL-2.0": [
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 2 of the License, or (at "
        "your option) any later version.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "LGPL-2.1": [
        "This work is licensed under the GNU Lesser General Public License, version 2.1.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation, either version 2.1 of the License, or (at "
        "your option) any later version.",
    ],
    "LGPL-3.0": [
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
        "your option) any later version.",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain.",
    ],
}


# --------------------------------------------------------------- alignment
def unique_places(words: list) -> dict:
    seen: dict = {}
    for i, w in enumerate(words):
        seen[w] = -1 if w in seen else i
    return {w: i for w, i in seen.items() if i >= 0}


def longest_increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest run of pairs (sorted by the first) that increases in the second."""
    tops: list[int] = []
    heads: list[int] = []
    back: list[int] = []
    for k, (_, j) in enumerate(pairs):
        at = bisect.bisect_left(tops, j)
        back.append(heads[at - 1] if at else -1)
        if at == len(tops):
            tops.append(j)
            heads.append(k)
        else:
            tops[at], heads[at] = j, k
    out, k = [], heads[-1] if heads else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def patience(a: list, b: list) -> list[tuple[int, int]]:
    """Matched places of two word lists, in order."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 >= a1 or b0 >= b1:
            continue
        left, right = unique_places(a[a0:a1]), unique_places(b[b0:b1])
        anchors = longest_increasing(sorted((a0 + i, b0 + right[w]) for w, i in left.items() if w in right))
        if anchors:
            out += anchors
            ends = [(a0 - 1, b0 - 1), *anchors, (a1, b1)]
            todo += [(i + 1, k, j + 1, m) for (i, j), (k, m) in zip(ends, ends[1:])]
    return sorted(out)


def densest(pairs: list[tuple[int, int]], strange: float) -> list[tuple[int, int]]:
    """The run of matches with the most of them less ``strange`` for each other
    word of the first list between them."""
    best, value, first, out = 0.0, 0.0, 0, (0, 0)
    for k, (i, _) in enumerate(pairs):
        value -= strange * (i - pairs[k - 1][0] - 1) if k else 0.0
        if value <= 0:
            value, first = 0.0, k
        value += 1
        if value > best + 1e-9:
            best, out = value, (first, k + 1)
    return pairs[out[0]:out[1]]


# -------------------------------------------------------------------- scan
class Templates:
    def __init__(self, texts: dict[str, list[str]], least: float):
        self.least = least
        flat = [(name, x) for name, some in sorted(texts.items()) for x in some]
        self.names = [name for name, _ in flat]
        w = Words(C.texts_of(pa.array([x for _, x in flat], pa.string())))
        hashes = [w.hash[a:b].tolist() for a, b in zip(w.row_at[:-1], w.row_at[1:])]
        self.words = hashes
        in_templates: dict[int, int] = {}
        for h in hashes:
            for x in set(h):
                in_templates[x] = in_templates.get(x, 0) + 1
        width = {int(h): int(e - s) for h, s, e in zip(w.hash, w.start, w.end)}
        # few templates and many letters make a word rare
        self.owners: dict[int, list[int]] = {}
        for i, h in enumerate(hashes):
            order = sorted(set(h), key=lambda x: (in_templates[x], -width[x], x))
            for x in order[:math.floor(len(h) - least * len(h) + 1e-9) + 1]:
                self.owners.setdefault(x, []).append(i)
        self.keys = [[x for x, some in self.owners.items() if i in some] for i in range(len(hashes))]
        self.counts = [Counter(h) for h in hashes]
        self.places: list[dict[int, list[int]]] = [{} for _ in hashes]
        for i, h in enumerate(hashes):
            for p, x in enumerate(h):
                self.places[i].setdefault(x, []).append(p)
        self.every = np.unique(np.array(list(self.owners), np.uint64))

    def notice(self, text: list, i: int) -> tuple[int, int, int] | None:
        """First and last word (exclusive) and matched words of the notice of
        template ``i`` in these words, if it is covered to ``least``."""
        words, counts = self.words[i], self.counts[i]
        held = Counter(x for x in text if x in counts)
        if sum(min(n, counts[x]) for x, n in held.items()) < self.least * len(words) - 1e-9:
            return None
        lo, hi = 0, len(text)
        while True:
            run = [(lo + x, y) for x, y in densest(patience(text[lo:hi], words), self.least)]
            if not run:
                return None
            first, last = run[0][0], run[-1][0] + 1
            if (first, last) == (lo, hi):
                break
            lo, hi = first, last
        covered = self.coverage(first, last, len(run), i) >= self.least - 1e-9
        return (first, last, len(run)) if covered else None

    def around(self, hashes: list, k: int, i: int, lo: int, hi: int) -> tuple[int, int, int] | None:
        """The best covered notice of template ``i`` that word ``k`` is in,
        between the words lo and hi."""
        n = len(self.words[i])
        room = math.ceil(n / self.least - n)
        found = []
        for p in self.places[i][hashes[k]]:
            for more in (0, room // 3, room):
                a, b = max(lo, k - p - more), min(hi, k - p + n + more)
                x = self.notice(hashes[a:b], i)
                if x and a + x[0] <= k < a + x[1]:
                    found.append((self.coverage(*x, i), (a + x[0], a + x[1], x[2])))
                    if x[2] == n == x[1] - x[0]:
                        return found[-1][1]
        return max(found, key=lambda x: x[0])[1] if found else None

    def find(self, w: Words) -> list[list[dict]]:
        """Notices of each row: license, coverage, first and last word
        (exclusive) and the bytes they span."""
        out: list[list[dict]] = [[] for _ in range(len(w.count))]
        if not len(self.every):
            return out
        at = np.minimum(np.searchsorted(self.every, w.hash), len(self.every) - 1)
        hit = np.flatnonzero(self.every[at] == w.hash)
        if not len(hit):
            return out
        hashes = w.hash.tolist()
        by_row: dict[int, dict[int, list[int]]] = {}
        for k, x, r in zip(hit.tolist(), w.hash[hit].tolist(), w.row[hit].tolist()):
            places = by_row.setdefault(r, {})
            for i in self.owners[x]:
                places.setdefault(i, []).append(k)
        for r, by_template in by_row.items():
            begin, end = int(w.row_at[r]), int(w.row_at[r + 1])
            found = []
            for i, places in by_template.items():
                after = begin
                for k in places:
                    if k >= after and (x := self.around(hashes, k, i, after, end)):
                        found.append((*x, i))
                        after = x[1]
            for first, last, matched, i in self.most_explained(found):
                out[r].append({"license": self.names[i], "coverage": self.coverage(first, last, matched, i),
                               "first": first - begin, "last": last - begin,
                               "from_byte": int(w.start[first]), "to_byte": int(w.end[last - 1])})
        return out

    def coverage(self, first: int, last: int, matched: int, i: int) -> float:
        return matched / (len(self.words[i]) + last - first - matched)

    def most_explained(self, found: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
        """Of notices (first, last, matched words, template) those that no
        better one overlaps."""
        def rank(x):
            first, last, matched, i = x
            return 3 * matched - len(self.words[i]) - (last - first), self.coverage(*x), -i, -first

        kept: list[tuple[int, int, int, int]] = []
        for x in sorted(found, key=rank, reverse=True):
            at = bisect.bisect_left(kept, x)
            if (at == 0 or kept[at - 1][1] <= x[0]) and (at == len(kept) or kept[at][0] >= x[1]):
                kept.insert(at, x)
        return kept


FOUND = ("n_words long, notices array<struct<license: string, coverage: double, first: long, last: long, "
         "from_byte: long, to_byte: long>>")


def templates_of(table: DataFrame, license_col: str = "license", text_col: str = "text") -> dict[str, list[str]]:
    """Templates from a table: notices or whole license texts."""
    rows = table.select(F.col(license_col).cast("string").alias("name"), F.col(text_col).cast("string").alias("t")).where(
        "name IS NOT NULL AND t IS NOT NULL").distinct()
    size = rows.agg(F.sum(F.octet_length("t") + F.octet_length("name"))).first()[0] or 0
    if size > MOST_BYTES:
        raise ValueError(f"{size} bytes of templates; at most {MOST_BYTES} are held by each worker")
    out: dict[str, list[str]] = {}
    for r in sorted(rows.collect()):
        out.setdefault(r.name, []).append(r.t)
    return out


def scan_licenses(docs: DataFrame, text_col: str = "text", templates: dict[str, list[str]] | DataFrame | None = None,
                  least: float = LEAST, name: str = "licenses") -> DataFrame:
    """``docs`` plus a struct ``name``: n_words and the notices found.
    ``templates``: a table (license, text), texts by license, or TEMPLATES."""
    texts = TEMPLATES if templates is None else templates if isinstance(templates, dict) else templates_of(templates)

    def make():
        known = Templates(texts, least)

        def run(t, _):
            w = Words(t)
            notices = known.find(w)
            for r, found in enumerate(notices):
                for x in found:
                    x["from_byte"] -= int(t.off[r])
                    x["to_byte"] -= int(t.off[r])
                found.sort(key=lambda x: (x["first"], x["last"], x["license"]))
            return [w.count.astype(np.int64), notices]
        return run

    return C.annotate(docs, text_col, FOUND, make, name)


def op10_license_scan(spark, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents").select("doc_id", "text")
    found = F.col("s.notices")
    names = F.array_sort(F.array_distinct(F.transform(found, lambda x: x.license)))
    best = F.array_max(F.transform(found, lambda x: x.coverage))
    top = F.array_min(F.transform(F.filter(found, lambda x: x.coverage == best), lambda x: x.license))
    return scan_licenses(docs, name="s").select(
        "doc_id", F.col("s.n_words"), F.size(found).cast("long").alias("n_notices"), F.array_join(names, ",").alias("licenses"),
        top.alias("best_license"), F.coalesce(best, F.lit(0.0)).alias("best_coverage"),
        F.get(found, 0)["first"].alias("first_word"), F.get(found, 0)["last"].alias("last_word"))
