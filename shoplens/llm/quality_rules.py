"""Quality classifier as a sparse rule ensemble (operator 3).

Statistics of the text (shares of kinds of characters, repeated words and the
like) are taken in one pass over its bytes. On a documented, bounded
number of labelled rows (``fit_rows``, by a hash of the id) small boosted trees
are grown; every path from a root becomes a rule, a conjunction of comparisons;
a logistic model with an L1 penalty weighs the rules, most of them zero. The
rest are compiled into one Spark column expression, so scoring is a projection.

Edge cases: null and empty texts have all statistics zero and are scored like
any other; texts of any length are measured whole; labels that are null or
repeated: the former are skipped, the latter count each; without both classes
to learn from the score is the smoothed share of label 1; repeated rows are
scored each; an empty table gives an empty result; columns of any other name
are kept.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.llm import _common as C

FIT_ROWS = 20_000
TREES = 16
DEPTH = 3
THRESHOLDS = 31
PENALTIES = (0.03, 0.01, 0.003, 0.001)
CUT = 0.3


STATISTICS = ("chars", "words", "word_length", "letters", "capitals", "digits", "symbols", "bare_words", "stops",
              "distinct_words", "doubled_words", "line_length")


def _flags(*runs: tuple[int, int]) -> np.ndarray:
    out = np.zeros(256, bool)
    for a, b in runs:
        out[a:b + 1] = True
    return out


SPACE = _flags((0x09, 0x0D), (0x20, 0x20))
LETTER = _flags((0x41, 0x5A), (0x61, 0x7A), (0xC3, 0xF4))  # by first byte
CAPITAL = _flags((0x41, 0x5A))
DIGIT = _flags((0x30, 0x39))
STOP = _flags((0x21, 0x21), (0x2E, 0x2E), (0x3F, 0x3F))  # ends of sentences
PROSE = STOP | _flags((0x22, 0x22), (0x27, 0x29), (0x2C, 0x2D), (0x3A, 0x3B))  # and what else stands in them
SYMBOL = _flags((0x21, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7E)) & ~PROSE  # all other ASCII signs


def measure(t: C.Texts) -> list[np.ndarray]:
    """Statistics of each row, in the order of STATISTICS."""
    d, off = t.data, t.off

    def per_row(flag: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flag, dtype=np.int64)])
        return (total[off[1:]] - total[off[:-1]]).astype(np.float64)

    def share(part, whole):
        return np.divide(part, whole, out=np.zeros(len(part)), where=whole > 0)

    latin = np.zeros(len(d), bool)  # Latin-1 capitals, by first byte
    if len(d) > 1:
        latin[:-1] = (d[:-1] == 0xC3) & (d[1:] >= 0x80) & (d[1:] <= 0x9E) & (d[1:] != 0x97)
    chars = per_row((d & 0xC0) != 0x80)
    letters = per_row(LETTER[d])
    inside = ~SPACE[d]
    edge = np.zeros(len(d) + 1, bool)
    edge[off] = True
    begins = inside & (~np.concatenate([[False], inside[:-1]]) | edge[:-1])
    words = per_row(begins)
    at = np.flatnonzero(begins)
    codes, found = C.distinct(d[inside], (np.cumsum(inside) - 1)[at])
    row = np.repeat(np.arange(len(t)), words.astype(np.int64))
    n = len(t)
    different = np.bincount(np.unique(row * (len(found) + 1) + codes) // (len(found) + 1), minlength=n).astype(np.float64)
    again = np.bincount(row[1:][(codes[1:] == codes[:-1]) & (row[1:] == row[:-1])], minlength=n).astype(np.float64)
    lines = per_row(d == 0x0A) + 1
    bare = np.add.reduceat((LETTER | DIGIT)[d], at, dtype=np.int64) == 0 if len(at) else at  # words without a letter or digit
    bare = np.bincount(row[bare], minlength=n).astype(np.float64) if len(at) else np.zeros(n)
    return [chars, words, share(per_row(inside & ((d & 0xC0) != 0x80)), words), share(letters, chars),
            share(per_row(CAPITAL[d] | latin), letters), share(per_row(DIGIT[d]), chars), share(per_row(SYMBOL[d]), words),
            share(bare, words), share(per_row(STOP[d]), words), share(different, words), share(again, words),
            share(chars, lines)]


def with_statistics(docs: DataFrame, text_col: str = "text", name: str = "statistics") -> DataFrame:
    """``docs`` plus a struct ``name`` of statistics, all doubles."""
    return C.annotate(docs, text_col, ", ".join(f"{s} double" for s in STATISTICS), lambda: lambda t, _: measure(t), name)


# ------------------------------------------------------------------- rules
Rule = tuple[tuple[int, bool, float], ...]  # (statistic, greater, threshold): all must hold


@dataclass
class Model:
    names: list[str]
    rules: list[Rule]
    weights: list[float]
    intercept: float

    def score(self, struct: str) -> Column:
        """The ensemble as one column expression over a struct of statistics."""
        total = F.lit(float(self.intercept))
        for rule, w in zip(self.rules, self.weights):
            holds = F.lit(True)
            for k, greater, at in rule:
                col = F.col(f"{struct}.{self.names[k]}")
                holds = holds & ((col > F.lit(at)) if greater else (col <= F.lit(at)))
            total = total + F.when(holds, F.lit(float(w))).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for k, greater, at in rule:
        out &= (x[:, k] > at) if greater else (x[:, k] <= at)
    return out


def grow(x: np.ndarray, residual: np.ndarray, weight: np.ndarray, cuts: list[np.ndarray], depth: int) -> list[tuple[Rule, float]]:
    """Paths of one regression tree, each with its node's value."""
    out: list[tuple[Rule, float]] = []
    least = max(5.0, 0.002 * len(x))

    def node(rows: np.ndarray, path: Rule) -> None:
        g, h = residual[rows], weight[rows]
        value = g.sum() / (h.sum() + 1.0)
        if path:
            out.append((path, float(value)))
        if len(path) == depth or len(rows) < 2 * least:
            return
        best = (1e-6, None)
        base = g.sum() ** 2 / (h.sum() + 1.0)
        for k, at in enumerate(cuts):
            if not len(at):
                continue
            bin_ = np.searchsorted(at, x[rows, k], side="left")  # bin b: at[b - 1] < x <= at[b]
            gs = np.cumsum(np.bincount(bin_, g, len(at) + 1))[:-1]
            hs = np.cumsum(np.bincount(bin_, h, len(at) + 1))[:-1]
            n = np.cumsum(np.bincount(bin_, minlength=len(at) + 1))[:-1]
            gain = gs ** 2 / (hs + 1.0) + (g.sum() - gs) ** 2 / (h.sum() - hs + 1.0) - base
            gain[(n < least) | (len(rows) - n < least)] = -1.0
            i = int(gain.argmax())
            if gain[i] > best[0]:
                best = (float(gain[i]), (k, float(at[i])))
        if best[1] is None:
            return
        k, at = best[1]
        right = x[rows, k] > at
        node(rows[~right], (*path, (k, False, at)))
        node(rows[right], (*path, (k, True, at)))

    node(np.arange(len(x)), ())
    return out


def simplest(rule: Rule) -> Rule:
    """At most one lower and one upper limit per statistic."""
    limits: dict[tuple[int, bool], float] = {}
    for k, greater, at in rule:
        old = limits.get((k, greater), at)
        limits[(k, greater)] = max(old, at) if greater else min(old, at)
    return tuple(sorted((k, g, at) for (k, g), at in limits.items()))


def sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500)))


def extract_rules(x: np.ndarray, y: np.ndarray, trees: int, depth: int) -> list[Rule]:
    """Rules of boosted trees, each grown on a half of the rows."""
    rng = np.random.default_rng(3)
    cuts = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, THRESHOLDS + 2)[1:-1])) for k in range(x.shape[1])]
    cuts = [c[c < x[:, k].max()] for k, c in enumerate(cuts)]
    margin = np.full(len(x), np.log((y.mean() + 1e-9) / (1 - y.mean() + 1e-9)))
    rules: dict[Rule, None] = {}
    for _ in range(trees):
        p = sigmoid(margin)
        half = rng.random(len(x)) < 0.5
        paths = grow(x[half], (y - p)[half], (p * (1 - p))[half], cuts, depth)
        inner = {path[:-1] for path, _ in paths}
        for path, value in paths:
            rules[simplest(path)] = None
            if path not in inner:  # a leaf
                margin += 0.3 * value * holds(path, x)
    return list(rules)


def lasso(r: np.ndarray, y: np.ndarray, penalty: float, steps: int = 400) -> tuple[np.ndarray, float]:
    """Logistic regression with an L1 penalty by accelerated proximal steps."""
    n, m = r.shape
    size = 4.0 / (float(np.linalg.norm(r, 2)) ** 2 / n + 1.0)
    w, b = np.zeros(m), float(np.log((y.mean() + 1e-9) / (1 - y.mean() + 1e-9)))
    w0, b0, t = w, b, 1.0
    for _ in range(steps):
        error = sigmoid(r @ w0 + b0) - y
        step = w0 - size * (r.T @ error) / n
        new, nb = np.sign(step) * np.maximum(np.abs(step) - size * penalty, 0), b0 - size * error.mean()
        t1 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        w0, b0 = new + (t - 1) / t1 * (new - w), nb + (t - 1) / t1 * (nb - b)
        w, b, t = new, nb, t1
    return w, b


def fit_rules(x: np.ndarray, y: np.ndarray, names: list[str], trees: int = TREES, depth: int = DEPTH) -> Model:
    if not len(y) or y.min() == y.max():
        share = (y.sum() + 1.0) / (len(y) + 2.0)
        return Model(names, [], [], float(np.log(share / (1 - share))))
    train = np.arange(len(y)) % 4 != 0  # the rest chooses the penalty
    if len(np.unique(y[train])) < 2 or len(np.unique(y[~train])) < 2:
        train[:] = True
    rules = extract_rules(x[train], y[train], trees, depth)
    if not rules:
        return fit_rules(x[:0], y[:0], names)
    r = np.stack([holds(rule, x) for rule in rules], axis=1).astype(np.float64)
    best = None
    for penalty in PENALTIES:
        w, b = lasso(r[train], y[train], penalty)
        test = ~train if not train.all() else train
        p = np.clip(sigmoid(r[test] @ w + b), 1e-9, 1 - 1e-9)
        loss = -float(np.mean(y[test] * np.log(p) + (1 - y[test]) * np.log(1 - p)))
        if best is None or loss < best[0] - 1e-4:
            best = (loss, w, b)
    _, w, b = best
    keep = np.flatnonzero(np.abs(w) > 1e-6)
    return Model(names, [rules[k] for k in keep], [float(w[k]) for k in keep], float(b))


def fit(measured: DataFrame, label_col: str, struct: str = "statistics", id_col: str = "doc_id",
        fit_rows: int = FIT_ROWS) -> Model:
    """``measured``: labelled rows with their statistics."""
    names = measured.schema[struct].dataType.names
    rows = measured.where(F.col(label_col).isNotNull())
    n = rows.count()
    draw = F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.lit(1 << 30)) / float(1 << 30)
    sample = (rows.where(draw < fit_rows / max(n, 1))
              .select(F.col(id_col).cast("string").alias("key"), F.col(label_col).cast("double").alias("y"), f"{struct}.*")
              .toPandas().sort_values(["key", "y"], kind="stable"))
    return fit_rules(sample[names].to_numpy(np.float64), sample["y"].to_numpy(np.float64), list(names))


def score(measured: DataFrame, model: Model, struct: str = "statistics", name: str = "quality") -> DataFrame:
    """``measured`` plus a struct ``name``: score, predicted."""
    s = model.score(struct)
    return measured.withColumn(name, F.struct(s.alias("score"), F.when(s >= CUT, 1).otherwise(0).alias("predicted")))


def op3_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents").select("doc_id", "text")
    measured = C.cut(with_statistics(docs).select("doc_id", "statistics"))
    labels = C.table(spark, sf_dir, "labels").select("doc_id", "quality")
    held_out = C.by_crc("doc_id", 5) == 0
    model = fit(measured.where(~held_out).join(labels, "doc_id"), "quality")
    return score(measured, model).select(
        "doc_id", held_out.alias("held_out"), F.col("quality.score"), F.col("quality.predicted"))
