"""Quality scores by Bradley-Terry pairwise ranking (operator 6).

A document's strength is linear in features of its whole text: its shape and
repetition, and the shares of its words and word pairs in hashed classes, whose
weights are learnt.  Every labelled document that is good is preferred to every
bad one, and the weights minimise the logistic loss of the feature differences
over all these pairs.  The cut is a quantile of all labelled scores: the share of
rows labelled bad; a logistic curve puts it at the threshold.

Features are taken from each text once and written.  A step of Newton's method
reads those of the labelled rows twice.  The loss of a row against all rows of the
other label depends on its score alone, so the first reading counts the scores of
both labels over a fine grid, which gives that loss as a curve over scores; the
second one sums the rows' slopes and curvature.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batch_of, discard, loaded_once, texts_of, written_at
from .ngram_join import WordHashes

#: Penalties of the weights of shape features and of word classes; the number of word classes.
RIDGE, WORD_RIDGE, CLASSES = 1e-4, 1e-2, 512
#: Good rows whose pairs with all bad ones are held at once (8 MB a matrix).
PAIR_ROWS = 250
#: Cells of the score grid per unit, groups of cells with one curvature, rows held as a matrix at once.
CELLS, GROUPS, HELD_ROWS = 64, 64, 1_024
#: Numbers of a long sum that are added in one place (128 KB from each task).
PIECE = 16_384
#: Steps of the quantiles' scores per unit; children per round of their search.
UNITS, CHILDREN = 10**9, 4_096
NOT_LETTER = re.compile(r"[\W\d_]")
SYMBOL = re.compile(r"[^\w\s.,;:'\"()-]")
DIGIT = re.compile(r"\d")
LINK = re.compile(r"https?://|www\.|@")


def features(text: str) -> list[float]:
    """Shape and repetition of a whole text: all finite, for empty texts too."""
    chars, words = max(1, len(text)), text.split()
    n = max(1, len(words))
    counts = Counter(words)
    pairs, triples = len(set(zip(words, words[1:]))), len(set(zip(words, words[1:], words[2:])))
    lines = [x for x in text.split("\n") if x.strip()]
    return [
        np.log(n), sum(map(len, words)) / n, sum(map(str.isupper, words)) / n,
        1 - len(NOT_LETTER.findall(text)) / chars, len(SYMBOL.findall(text)) / chars, len(DIGIT.findall(text)) / chars,
        len(counts) / n, max(counts.values(), default=0) / n, sum(a == b for a, b in zip(words, words[1:])) / n,
        1 - len(set(lines)) / max(1, len(lines)), 1 - (pairs + 1) / n, 1 - (triples + 2) / n if n > 2 else 0.0,
        sum(1 for w in words if SYMBOL.search(w)) / n, text.count("!!") / n, text.count("|") / n,
        np.log1p(len(lines)), n / max(1, len(lines)), text.count(".") / n, text.count(",") / n,
        len(LINK.findall(text)) / n,
    ]


def class_counts(text: str, hashes: WordHashes) -> tuple[int, np.ndarray]:
    """Number of words, and of words and word pairs in each hashed class."""
    h = np.fromiter(map(hashes.__getitem__, text.lower().split()), dtype=np.uint64)
    with np.errstate(over="ignore"):
        pairs = (h[:-1] * np.uint64(0x9E3779B97F4A7C15)) ^ h[1:]
    classes = np.concatenate((h, pairs)) % np.uint64(CLASSES)
    return len(h), np.bincount(classes.astype(np.int64), minlength=CLASSES)


def word_classes(text: str, hashes: WordHashes) -> np.ndarray:
    """Square roots of the shares of words and word pairs in hashed classes."""
    n, counts = class_counts(text, hashes)
    return np.sqrt(counts / max(1, n))


SHAPES = 20
KEPT = pa.schema([("id", pa.int64()), ("shape", pa.binary()), ("classes", pa.binary())])


@dataclass
class Ranking:
    """Weights over standardised features, the squares of shape features, and
    the cut."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float = -1.0
    spread: float = 1.0
    threshold: float = 0.7

    def expand(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        shape = z[:, :SHAPES]
        return np.hstack([shape, shape * shape / 6, z[:, SHAPES:]])

    def score(self, x: np.ndarray) -> np.ndarray:
        s = (self.expand(x) @ self.weights - self.cut) / self.spread + np.log(self.threshold / (1 - self.threshold))
        return 1 / (1 + np.exp(-np.clip(s, -30, 30)))


def penalties(width: int) -> np.ndarray:
    """Ridge of each weight of ``width`` features, the squares of shapes included."""
    out = np.full(width + SHAPES, WORD_RIDGE)
    out[:2 * SHAPES] = RIDGE
    return out


def pair_loss(weights: np.ndarray, good: np.ndarray, bad: np.ndarray, ridge: np.ndarray):
    """Mean logistic loss of all pairs of a good and a bad row with its
    gradient and curvature, in sums over the matrix of score differences."""
    upper, lower, n = good @ weights, bad @ weights, len(good) * len(bad)
    loss, rows, columns = 0.0, np.zeros(len(good)), np.zeros(len(bad))
    bends, bend = np.zeros(len(bad)), np.diag(ridge * n)
    for k in range(0, len(good), PAIR_ROWS):  # the matrix is never whole
        part = slice(k, k + PAIR_ROWS)
        d = np.clip(upper[part, None] - lower[None, :], -30, 30)
        lost = 1 / (1 + np.exp(d))
        loss -= np.log1p(-lost).sum()
        rows[part], curve = lost.sum(axis=1), lost * (1 - lost)
        columns += lost.sum(axis=0)
        bends += curve.sum(axis=0)
        cross = good[part].T @ (curve @ bad)
        bend += (good[part] * curve.sum(axis=1)[:, None]).T @ good[part] - cross - cross.T
    bend += (bad * bends[:, None]).T @ bad
    slope = ridge * weights - (good.T @ rows - bad.T @ columns) / n
    return loss / n + (ridge * weights * weights).sum() / 2, slope, bend / n


def descend(weights: np.ndarray, evaluate: Callable, enough: float = 1e-5, slack: float = 0.0) -> np.ndarray:
    """Newton's method, steps halved while they raise the loss by more than
    ``slack``, until they are less than ``enough``.  ``evaluate`` gives the loss
    and a function for its gradient and curvature."""
    loss, bends = evaluate(weights)
    for _ in range(40):
        slope, bend = bends()
        step = np.linalg.solve(bend, slope)
        while (now := evaluate(weights - step))[0] > loss + slack and np.abs(step).max() > enough * 1e-4:
            step = step / 2
        weights, (loss, bends) = weights - step, now
        if np.abs(step).max() < enough:
            break
    return weights


def fit_ranking(x: np.ndarray, good: np.ndarray, threshold: float = 0.7) -> Ranking:
    """The fit over rows in memory.  Without rows of both labels there is no
    pair: every score is the same, above the threshold."""
    width = x.shape[1]
    if not good.any() or good.all():
        return level(width, threshold)
    model = Ranking(x.mean(axis=0), x.std(axis=0) + 1e-9, np.zeros(width + SHAPES), threshold=threshold)
    z, ridge = model.expand(x), penalties(width)

    def evaluate(weights: np.ndarray):
        loss, slope, bend = pair_loss(weights, z[good], z[~good], ridge)
        return loss, lambda: (slope, bend)

    model.weights = descend(model.weights, evaluate)
    s = np.sort(z @ model.weights)
    at = min(max(1, int(round((~good).mean() * len(s)))), len(s) - 1)
    model.cut = float((s[at - 1] + s[at]) / 2)
    model.spread = max(1e-6, float(np.median(np.abs(s - model.cut))) / 4)
    return model


def level(width: int, threshold: float) -> Ranking:
    return Ranking(np.zeros(width), np.ones(width), np.zeros(width + SHAPES), threshold=threshold)


def unpacked(shape: pa.Array, classes: pa.Array) -> np.ndarray:
    """The features of kept rows, as ``_feature_rows`` gives them for their texts."""
    shapes = np.frombuffer(b"".join(shape.to_pylist()), "<f8").reshape(len(shape), SHAPES + 1)
    raw = classes.to_pylist()
    if all(len(c) == CLASSES for c in raw):
        counts = np.frombuffer(b"".join(raw), "u1").reshape(len(raw), CLASSES)
    else:
        counts = np.array([np.frombuffer(c, "u1" if len(c) == CLASSES else "<u4") for c in raw], dtype=np.int64)
    return np.hstack([shapes[:, :SHAPES], np.sqrt(counts / np.maximum(1, shapes[:, SHAPES:]))])


def kept_features(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, str]:
    """``id, shape, classes`` of every row as a written table, and where it is:
    the shape features and the number of words, and the counts of the hashed
    classes (a byte each, or four where one does not fit)."""
    def extract(batches):
        hashes = loaded_once(WordHashes)
        for b in batches:
            shape, classes = [], []
            for text in texts_of(b.column(1)):
                n, counts = class_counts(text, hashes)
                shape.append(np.array([*features(text), n], "<f8").tobytes())
                classes.append(counts.astype("u1" if counts.max() < 256 else "<u4").tobytes())
            yield batch_of(KEPT, [b.column(0), shape, classes])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return written_at(rows.mapInArrow(extract, "id long, shape binary, classes binary"), "features")


def merged(batches, per_rows: Callable, merge: Callable):
    """``merge`` over ``per_rows(features, good, bad)`` of a task's rows; None without rows."""
    total = None
    for b in batches:
        for k in range(0, b.num_rows, HELD_ROWS):
            part = b.slice(k, HELD_ROWS)
            x, good, bad = unpacked(part.column(2), part.column(3)), part.column(0), part.column(1)
            now = per_rows(x, *(c.to_numpy(zero_copy_only=False).astype(float) for c in (good, bad)))
            total = now if total is None else merge(total, now)
    return total


class Labelled:
    """The kept features of all labelled rows: ``good`` and ``bad`` count how
    often a row has each label.  Sums over them come to the driver: short ones
    per task, with as many tasks as cores, and a single one of the curvature."""

    def __init__(self, rows: DataFrame):
        self.rows = rows.select("good", "bad", "shape", "classes").coalesce(rows.sparkSession.sparkContext.defaultParallelism)

    def sums(self, per_rows: Callable, merge: Callable):
        """``merge`` over ``per_rows(features, good, bad)`` of all rows, in the
        order of the tasks; None without rows."""
        def run(batches):
            total = merged(batches, per_rows, merge)
            if total is not None:
                sums = [np.ascontiguousarray(t, dtype="<f8") for t in total]
                yield pa.RecordBatch.from_pydict({
                    "task": pa.array([TaskContext.get().partitionId()], pa.int32()),
                    "shapes": pa.array([[list(t.shape) for t in sums]], pa.list_(pa.list_(pa.int32()))),
                    "sums": pa.array([[t.tobytes() for t in sums]], pa.list_(pa.binary()))})

        got = self.rows.mapInArrow(run, "task int, shapes array<array<int>>, sums array<binary>").collect()
        total = None
        for r in sorted(got, key=lambda r: r["task"]):
            now = [np.frombuffer(t, "<f8").reshape(shape) for t, shape in zip(r["sums"], r["shapes"])]
            total = now if total is None else merge(total, now)
        return total

    def added(self, per_rows: Callable) -> np.ndarray:
        """The sum of the vectors ``per_rows(features, good, bad)`` of all rows,
        for long ones: pieces of the tasks' vectors meet by their place and are
        added there, in the order of the tasks."""
        def run(batches):
            total = merged(batches, per_rows, np.add)
            if total is not None:
                parts = [total[k:k + PIECE].astype("<f8").tobytes() for k in range(0, len(total), PIECE)]
                task = TaskContext.get().partitionId()
                yield pa.RecordBatch.from_pydict({
                    "piece": pa.array(range(len(parts)), pa.int32()), "task": pa.array([task] * len(parts), pa.int32()),
                    "part": pa.array(parts, pa.binary())})

        def add(parts: pd.DataFrame) -> pd.DataFrame:
            inorder = parts.sort_values("task")["part"]
            total = reduce(np.add, (np.frombuffer(p, "<f8") for p in inorder))
            return pd.DataFrame({"piece": parts["piece"].iloc[:1], "part": [total.tobytes()]})

        pieces = self.rows.mapInArrow(run, "piece int, task int, part binary")
        got = pieces.groupBy("piece").applyInPandas(add, "piece int, part binary").collect()
        return np.concatenate([np.frombuffer(r["part"], "<f8") for r in sorted(got, key=lambda r: r["piece"])])

    def moments(self):
        """Numbers of good and bad rows, mean and squared deviations of the features."""
        def per_rows(x, good, bad):
            w = good + bad
            mean = w @ x / w.sum()
            return np.array([good.sum(), bad.sum()]), mean, w @ (x - mean) ** 2

        def merge(a, b):
            m, n = a[0].sum(), b[0].sum()
            apart = b[1] - a[1]
            return a[0] + b[0], a[1] + apart * (n / (m + n)), a[2] + b[2] + apart ** 2 * (m * n / (m + n))

        return self.sums(per_rows, merge)

    def score_counts(self, model: Ranking):
        """The first cell with a score, and per cell from there on the numbers
        of good and bad rows and of their distances from its start, in cells."""
        def per_rows(x, good, bad):
            s = model.expand(x) @ model.weights * CELLS
            cell = np.floor(s)
            first = cell.min()
            at, over = (cell - first).astype(np.int64), s - cell
            return np.array([first]), np.array([np.bincount(at, w) for w in (good, bad, good * over, bad * over)])

        def merge(a, b):
            first = min(a[0][0], b[0][0])
            out = np.zeros((4, int(max(t[0][0] + t[1].shape[1] for t in (a, b)) - first)))
            for t in (a, b):
                k = int(t[0][0] - first)
                out[:, k:k + t[1].shape[1]] += t[1]
            return np.array([first]), out

        first, counts = self.sums(per_rows, merge)
        return first[0], counts

    def evaluate(self, model: Ranking, weights: np.ndarray, ridge: np.ndarray):
        """Mean logistic loss of all pairs, and a function for its gradient and
        curvature.  Scores between two cells' starts count for both by their
        distances; the gradient reads the rows' losses between them likewise;
        one curvature serves the pairs of two groups of cells."""
        model = Ranking(model.mean, model.scale, weights)
        first, (good, bad, good_over, bad_over) = self.score_counts(model)
        cells = len(good)
        pairs = good.sum() * bad.sum()

        def dealt(whole, over):
            return np.append(whole - over, 0) + np.append(0, over)

        far = np.arange(-cells, cells + 1) / CELLS  # distances of any two cells' starts
        lost = 1 / (1 + np.exp(np.clip(far, -700, 700)))
        goods, bads = dealt(good, good_over), dealt(bad, bad_over)
        loss = goods @ np.convolve(bads, np.logaddexp(0, -far))[cells:2 * cells + 1] / pairs
        loss_good = np.convolve(bads, lost)[cells:2 * cells + 1] / pairs  # of a good row at a cell's start
        loss_bad = np.convolve(goods, lost[::-1])[cells:2 * cells + 1] / pairs
        wide = -(-cells // GROUPS)
        n = -(-cells // wide)
        group_good, group_bad = (np.bincount(np.arange(cells) // wide, w, n) for w in (good, bad))
        half = 1 / (2 * np.cosh(np.clip(np.subtract.outer(np.arange(n), np.arange(n)) * (wide / CELLS / 2), -300, 300)))
        curve = half * half / pairs
        curve_good, curve_bad = curve @ group_bad, curve @ group_good

        def per_rows(x, good, bad):
            z = model.expand(x)
            s = z @ model.weights * CELLS - first
            cell = np.clip(np.floor(s).astype(np.int64), 0, cells - 1)
            group, starts = cell // wide, np.arange(cells + 1)
            slopes = good * np.interp(s, starts, loss_good) - bad * np.interp(s, starts, loss_bad)
            ones = np.zeros((2, n, len(s)))
            ones[:, group, np.arange(len(s))] = good, bad
            bent = good * curve_good[group] + bad * curve_bad[group]
            bend = (z * bent[:, None]).T @ z
            return np.concatenate((slopes @ z, bend[np.triu_indices(len(bend))], *(ones @ z)), axis=None)

        def bends():
            width = len(weights)
            upper = np.triu_indices(width)
            slopes, half, of_good, of_bad = np.split(
                self.added(per_rows), np.cumsum([width, len(upper[0]), n * width]))
            bend = np.zeros((width, width))
            bend[upper] = half
            bend.T[upper] = half
            cross = of_good.reshape(n, width).T @ curve @ of_bad.reshape(n, width)
            return ridge * weights - slopes, bend - cross - cross.T + np.diag(ridge)

        return loss + (ridge * weights * weights).sum() / 2, bends

    def fit(self, threshold: float = 0.7) -> Ranking:
        """The fit over all rows and pairs; steps end at 1e-4, where the grid's
        rounding lies.  Without rows of both labels every score is the same,
        above the threshold."""
        width = SHAPES + CLASSES
        moments = self.moments()
        if moments is None or not moments[0].all():
            return level(width, threshold)
        (good, bad), mean, squares = moments
        model = Ranking(mean, np.sqrt(squares / (good + bad)) + 1e-9, np.zeros(width + SHAPES), threshold=threshold)
        ridge = penalties(width)
        model.weights = descend(model.weights, lambda w: self.evaluate(model, w, ridge), enough=1e-4, slack=1e-6)
        scores, path = written_at(self.scores(model), "scores")
        model.cut, model.spread = cut_and_spread(scores, int(good + bad), int(bad))
        discard(scores.sparkSession, path)
        return model

    def scores(self, model: Ranking) -> DataFrame:
        """``v, w``: each row's strength in units, and how often it is labelled."""
        @F.pandas_udf("long")
        def strength(shape: pd.Series, classes: pd.Series) -> pd.Series:
            x = unpacked(pa.array(shape, pa.binary()), pa.array(classes, pa.binary()))
            return pd.Series(np.rint(model.expand(x) @ model.weights * UNITS).astype(np.int64))

        return self.rows.select(strength("shape", "classes").alias("v"), (F.col("good") + F.col("bad")).alias("w"))


def ranked(scores: DataFrame, k: int) -> int:
    """The ``k``-th smallest ``v`` of rows that count ``w`` times each: the
    interval that holds it is cut into equal parts, counted, until they are single values."""
    low, high = scores.agg(F.min("v"), F.max("v")).first()
    while low < high:
        wide = -(-(high - low + 1) // CHILDREN)
        inside = scores.where(F.col("v").between(low, high))
        parts = inside.groupBy(F.expr(f"(v - {low}L) div {wide}L").alias("part")).agg(F.sum("w").alias("w")).collect()
        for part, w in sorted((r["part"], r["w"]) for r in parts):
            if k <= w:
                break
            k -= w
        low, high = low + part * wide, min(high, low + (part + 1) * wide - 1)
    return low


def cut_and_spread(scores: DataFrame, n: int, bad: int) -> tuple[float, float]:
    """The cut lies between two neighbouring scores with about ``bad`` rows
    below it: equal scores stay together, on the side that fits better."""
    at = min(max(1, bad), n - 1)
    v = ranked(scores, at)
    below, upto, before, after = scores.agg(
        F.sum(F.when(F.col("v") < v, F.col("w"))), F.sum(F.when(F.col("v") <= v, F.col("w"))),
        F.max(F.when(F.col("v") < v, F.col("v"))), F.min(F.when(F.col("v") > v, F.col("v")))).first()
    if after is not None and upto - at <= at - (below or 0):
        cut = (v + after) / 2
    else:
        cut = (v + (v - 2 if before is None else before)) / 2
    apart = scores.select(F.abs(F.col("v") - F.lit(int(cut))).alias("v"), "w")
    return cut / UNITS, max(1e-6, ranked(apart, (n + 1) // 2) / UNITS / 4)


def _feature_rows(texts: pd.Series) -> np.ndarray:
    hashes = loaded_once(WordHashes)
    rows = [np.concatenate((features(t or ""), word_classes(t or "", hashes))) for t in texts]
    return np.array(rows, dtype=np.float64).reshape(len(rows), SHAPES + CLASSES)


def held_out(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 4, is 2; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def train(kept: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality",
          threshold: float = 0.7) -> Ranking:
    """Fits on the kept features of all labelled rows that are not held out.
    Labels other than 0 and 1 and null ids are not used; a row counts once for
    each label of its id.  Labels meet features by a join, texts are not moved."""
    usable = labels.where(~held_out(id_col) & F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1))
    counts = usable.groupBy(F.col(id_col).cast("long").alias("id")).agg(
        F.sum(F.col(label_col).cast("long")).alias("good"), F.sum(1 - F.col(label_col).cast("long")).alias("bad"))
    # In one order, so that sums are the same in each run.
    rows, path = written_at(kept.where(~held_out("id") & F.col("id").isNotNull()).join(counts, "id")
                            .sortWithinPartitions("id", "shape", "classes"), "labelled")
    model = Labelled(rows).fit(threshold)
    discard(rows.sparkSession, path)
    return model


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   threshold: float = 0.7) -> DataFrame:
    """``doc_id, held_out, score, predicted`` per document (1 from ``threshold`` on).

    Null texts score as empty ones; null and repeated ids give a row each;
    without labels of both kinds every document passes; an empty table gives
    no rows; other columns are never read.
    """
    kept, _ = kept_features(docs, id_col, text_col)
    model = train(kept, labels, id_col, threshold=threshold)

    @F.pandas_udf("double")
    def score(shape: pd.Series, classes: pd.Series) -> pd.Series:
        x = unpacked(pa.array(shape, pa.binary()), pa.array(classes, pa.binary()))
        return pd.Series(model.score(x))

    return (kept.select(F.col("id").alias("doc_id"), held_out("id").alias("held_out"), score("shape", "classes").alias("score"))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))


def accepted(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs`` whose score reaches ``threshold``, as they are."""
    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(_feature_rows(texts)))

    kept, path = kept_features(docs.where(~held_out(id_col)), id_col, text_col)
    model = train(kept, labels, id_col, threshold=threshold)
    discard(docs.sparkSession, path)
    return docs.where(score(F.col(text_col)) >= threshold)
