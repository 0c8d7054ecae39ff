"""Quality classifier: a generalised additive model with pairwise interactions."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stargrain.llm.common import SPACE, bounded_batches, slices, texts_of, utf8, word_hashes

#: labelled rows the model is fitted on, at most: those with the smallest hash of doc_id
SAMPLE = 20_000
THRESHOLD = 0.7
BINS, PAIR_BINS, PAIRS = 32, 8, 6
ROUNDS, RATE, LEAF_ROWS = 120, 0.15, 8

FEATURES = (
    "log_bytes", "log_words", "word_bytes", "long_words", "upper", "digits", "points", "marks", "marks_per_word",
    "exclaim", "letters", "beyond_ascii", "line_words", "distinct_words", "repeated_pairs", "capital_words", "same_lines",
)


def features(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of FEATURES per text. Only the text's bytes count; an empty text has zeros."""
    n = np.diff(offsets).astype(float)
    byte = np.maximum(n, 1)

    def share(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask)])
        return total[offsets[1:]] - total[offsets[:-1]]

    upper = (raw >= 65) & (raw <= 90)
    lower = (raw >= 97) & (raw <= 122)
    digit = (raw >= 48) & (raw <= 57)
    point = np.isin(raw, np.frombuffer(b".,;:'?-()\"", np.uint8))
    high = raw >= 128
    space = SPACE[raw]
    mark = ~(upper | lower | digit | point | high | space)
    words, counts = word_hashes(raw, offsets)
    word = np.maximum(counts, 1)
    owner = np.repeat(np.arange(len(n)), counts)
    first = ~space
    first[1:] &= space[:-1]
    starts = offsets[:-1][(n > 0)]
    first[starts] = ~space[starts]
    at = np.flatnonzero(first)
    length = np.zeros(len(at))
    if len(at):
        length = np.add.reduceat((~space).astype(float), at)
    marked = np.add.reduceat(mark.astype(float), at) > 0 if len(at) else length

    def per_text(values: np.ndarray) -> np.ndarray:
        return np.bincount(owner, values, minlength=len(n))

    def distinct(keys: np.ndarray, own: np.ndarray) -> np.ndarray:
        order = np.lexsort((keys, own))
        k, o = keys[order], own[order]
        new = np.ones(len(k), bool)
        new[1:] = (k[1:] != k[:-1]) | (o[1:] != o[:-1])
        return np.bincount(o[new], minlength=len(n))

    with np.errstate(over="ignore"):
        pair = words[:-1] * np.uint64(0x9E3779B97F4A7C15) + words[1:] if len(words) else words
    same = owner[:-1] == owner[1:]
    pairs = np.maximum(np.bincount(owner[:-1][same], minlength=len(n)), 1)
    # lines as sums of their bytes' places, enough to count equal ones
    line_end = raw == 10
    line = np.concatenate([[0], np.cumsum(line_end)])[:-1] + np.repeat(np.arange(len(n)), np.diff(offsets))
    lines = share(line_end) + 1
    if len(raw):
        edge = np.flatnonzero(np.concatenate([[True], line[1:] != line[:-1]]))
        place = np.arange(len(raw)) - np.repeat(edge, np.diff(np.append(edge, len(raw))))
        with np.errstate(over="ignore"):
            key = np.add.reduceat((raw.astype(np.uint64) + 1) * (place.astype(np.uint64) * 2 + 1) * (place.astype(np.uint64) + 7), edge)
        line_owner = np.repeat(np.arange(len(n)), np.diff(offsets))[edge]
        key_lines = np.maximum(np.bincount(line_owner, minlength=len(n)), 1)
        different = distinct(key, line_owner)
    else:
        key_lines, different = np.ones(len(n)), np.ones(len(n))
    start_upper = upper[at].astype(float) if len(at) else length
    return np.stack([
        np.log1p(n), np.log1p(counts), per_text(length) / word, per_text((length > 12).astype(float)) / word,
        share(upper) / byte, share(digit) / byte, share(point) / byte, share(mark) / byte, per_text(marked) / word,
        share(raw == 33) / byte, share(upper | lower | high) / byte, share(high) / byte, counts / lines,
        distinct(words, owner) / word, 1 - np.minimum(distinct(pair[same], owner[:-1][same]) / pairs, 1), per_text(start_upper) / word,
        1 - np.minimum(different / key_lines, 1),
    ], axis=1)


@dataclass
class Model:
    """Lookup tables: a score for each bin of a feature and for each cell of two features."""

    intercept: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    grids: list[np.ndarray] = field(default_factory=list)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)], axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        if self.edges:
            b = self.bins(x)
            for j, t in enumerate(self.tables):
                total += t[b[:, j]]
            for (i, j), g in zip(self.pairs, self.grids):
                total += g[_coarse(b[:, i], self.edges[i]), _coarse(b[:, j], self.edges[j])]
        return 1 / (1 + np.exp(-total))


def _coarse(b: np.ndarray, edges: np.ndarray) -> np.ndarray:
    return b * PAIR_BINS // (len(edges) + 1)


def _split(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> tuple[float, int]:
    """(gain, bins to the left) of the best cut of a row of bins."""
    gl, hl, nl = np.cumsum(g)[:-1], np.cumsum(h)[:-1], np.cumsum(n)[:-1]
    gr, hr, nr = g.sum() - gl, h.sum() - hl, n.sum() - nl
    gain = gl**2 / (hl + 1) + gr**2 / (hr + 1) - g.sum() ** 2 / (h.sum() + 1)
    gain = np.where((nl >= LEAF_ROWS) & (nr >= LEAF_ROWS), gain, -1.0)
    return (float(gain.max()), int(gain.argmax()) + 1) if len(gain) else (-1.0, 0)


def _tree(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> np.ndarray:
    """A tree of depth two over the bins of one feature, as the step for each bin."""
    out = np.zeros(len(g))

    def grow(lo: int, hi: int, depth: int) -> None:
        gain, cut = _split(g[lo:hi], h[lo:hi], n[lo:hi]) if depth else (-1.0, 0)
        if gain > 1e-6:
            grow(lo, lo + cut, depth - 1)
            grow(lo + cut, hi, depth - 1)
        else:
            out[lo:hi] = g[lo:hi].sum() / (h[lo:hi].sum() + 1)

    grow(0, len(g), 2)
    return out


def _grid_tree(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> tuple[float, np.ndarray]:
    """(gain, step for each cell) of the best tree that cuts one feature, then the other on both sides."""
    best, out = 0.0, np.zeros_like(g)
    for turn in (False, True):
        G, H, N = (a.T if turn else a for a in (g, h, n))
        for cut in range(1, len(G)):
            step, gain = np.zeros_like(G), 0.0
            for part in (slice(0, cut), slice(cut, None)):
                rg, rh, rn = G[part].sum(0), H[part].sum(0), N[part].sum(0)
                gain += rg.sum() ** 2 / (rh.sum() + 1)
                more, at = _split(rg, rh, rn)
                for side in (slice(0, at), slice(at, None)) if more > 0 else (slice(0, None),):
                    step[part, side] = rg[side].sum() / (rh[side].sum() + 1)
                gain += max(more, 0)
            gain -= g.sum() ** 2 / (h.sum() + 1)
            if gain > best:
                best, out = gain, step.T if turn else step
    return best, out


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Cyclic boosting: one shallow tree per feature and turn, then trees over the best pairs.

    Without rows of both labels the score is the smoothed share of label 1 for every text.
    """
    rate = (y.sum() + 1) / (len(y) + 2)
    model = Model(float(np.log(rate / (1 - rate))))
    if not 0 < y.sum() < len(y):
        return model
    for j in range(x.shape[1]):
        model.edges.append(np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])))
    b = model.bins(x)
    total = np.full(len(y), model.intercept)
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return y - p, np.maximum(p * (1 - p), 1e-6)

    for _ in range(ROUNDS):
        for j, table in enumerate(model.tables):
            g, h = slopes()
            step = RATE * _tree(*(np.bincount(b[:, j], w, minlength=len(table)) for w in (g, h, np.ones(len(y)))))
            table += step
            total += step[b[:, j]]

    def cells(i: int, j: int, w: np.ndarray) -> np.ndarray:
        key = _coarse(b[:, i], model.edges[i]) * PAIR_BINS + _coarse(b[:, j], model.edges[j])
        return np.bincount(key, w, minlength=PAIR_BINS**2).reshape(PAIR_BINS, PAIR_BINS)

    g, h = slopes()
    one = np.ones(len(y))
    ranked = sorted(((_grid_tree(cells(i, j, g), cells(i, j, h), cells(i, j, one))[0], i, j)
                     for i in range(x.shape[1]) for j in range(i)), key=lambda r: (-r[0], r[1:]))
    model.pairs = [(i, j) for _, i, j in ranked[:PAIRS]]
    model.grids = [np.zeros((PAIR_BINS, PAIR_BINS)) for _ in model.pairs]
    for _ in range(ROUNDS // 4):
        for (i, j), grid in zip(model.pairs, model.grids):
            g, h = slopes()
            step = RATE * _grid_tree(cells(i, j, g), cells(i, j, h), cells(i, j, one))[1]
            grid += step
            total += step[_coarse(b[:, i], model.edges[i]), _coarse(b[:, j], model.edges[j])]
    return model


def held_out(doc_id) -> F.Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on at most SAMPLE labelled rows that aren't held out, chosen by a hash of doc_id.

    Several labels of one document count as their mean, rounded; rows without doc_id or label are
    left out. Only the sample's features reach the driver.
    """
    spark = docs.sparkSession
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("quality"))
             .filter("doc_id IS NOT NULL AND quality IS NOT NULL").filter(~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("quality"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE))
    rows = texts_of(docs).join(F.broadcast(known), "doc_id").select("doc_id", "text", "quality")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(it, 1):
            x = features(*utf8(b.column(1)))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(list(x), pa.list_(pa.float64())), b.column(2)], ["doc_id", "x", "y"])

    bounded_batches(spark)
    found = (rows.mapInArrow(run, "doc_id long, x array<double>, y int").orderBy(F.xxhash64("doc_id"), "doc_id", "x")
             .limit(SAMPLE).toPandas())
    if found.empty:
        return Model()
    return fit(np.stack(found["x"].to_numpy()), found["y"].to_numpy().astype(float))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row; a null text is scored as an empty one."""
    bounded_batches(docs.sparkSession)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(it, 1):
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(model.score(features(*utf8(b.column(1)))), pa.float64())], ["doc_id", "score"])

    return texts_of(docs).mapInArrow(run, "doc_id long, score double").select(
        "doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of `docs` with all their columns whose text isn't rejected; repeated rows are all judged alike.

    A model fitted without rows of both labels tells nothing of a text: all rows stay, whatever its score.
    """
    if not model.edges:
        return docs
    bounded_batches(docs.sparkSession)

    @F.pandas_udf("double")
    def quality(texts: pd.Series) -> pd.Series:
        parts = slices(iter([pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])]), 0)
        return pd.Series(np.concatenate([model.score(features(*utf8(b.column(0)))) for b in parts] or [np.zeros(0)]))

    return docs.filter(quality(F.coalesce(F.col("text").cast("string"), F.lit(""))) >= THRESHOLD)
