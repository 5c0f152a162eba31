"""Quality classifier: a generalised additive model with pairwise interactions.

Features of a text are put into quantile bins.  Cyclic boosting visits one feature at a time, fits a shallow tree to
the current gradient over the feature's bins and adds it to that feature's lookup table; later rounds do the same
for the feature pairs that explain most of what is left, on two-dimensional tables.  A score is the sigmoid of a sum
of table entries, so scoring is a vectorised bin lookup and addition.

The model is fitted on at most ``SAMPLE_ROWS`` labelled rows (chosen by a hash of the id); scoring reads every whole
text in bounded Arrow batches.  The tables' size depends on the numbers of features and bins only.

Defined cases: a null text counts as empty; an empty text has a score like any other; labelled ids without a document
do no harm; rows with a null label or id are not learned from; with no labelled row the
score is 0.5, with one class only it is that class's smoothed share; repeated labels count as the larger one.  Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import bounded_batches, text_bytes

SAMPLE_ROWS = 30_000
BINS = 32
PAIR_BINS = 8
ROUNDS = 60
PAIRS = 6
PAIR_ROUNDS = 20
RATE = 0.25
THRESHOLD = 0.3
FEATURES = ("log_bytes", "log_words", "word_length", "upper", "digits", "marks", "bars", "exclaims", "stops", "non_ascii",
            "distinct_words", "adjacent_repeats", "distinct_lines", "words_per_line", "distinct_bigrams")

_GROUPS = (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"*$%#&@~^<>{}[]\\/_=+", b"|", b"!?", b".,;:", bytes(range(128, 256)))


def text_features(text: bytes) -> list[float]:
    words, lines = text.split(), text.split(b"\n")
    count, size = len(words), len(text)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    solid = max(1, sum(map(len, words)))
    shares = [float(counts[list(g)].sum()) / solid for g in _GROUPS]
    if not count:
        return [float(np.log1p(size)), 0.0, 0.0, *shares, 1.0, 0.0, 1.0, 0.0, 1.0]
    pairs = list(zip(words, words[1:]))
    return [float(np.log1p(size)), float(np.log1p(count)), solid / count, *shares, len(set(words)) / count,
            sum(a == b for a, b in pairs) / count, len(set(lines)) / len(lines), count / len(lines),
            len(set(pairs)) / max(1, len(pairs))]


def feature_matrix(texts: list[bytes]) -> np.ndarray:
    return np.array([text_features(t) for t in texts], np.float64).reshape(len(texts), len(FEATURES))


def _best_split(gain: np.ndarray, weight: np.ndarray, lo: int, hi: int) -> tuple[float, int]:
    """Best place to cut bins lo..hi-1 in two: (improvement, first bin of the right part)."""
    g, h = np.cumsum(gain[lo:hi]), np.cumsum(weight[lo:hi])
    if hi - lo < 2:
        return 0.0, lo
    left = g[:-1] ** 2 / (h[:-1] + 1.0)
    right = (g[-1] - g[:-1]) ** 2 / (h[-1] - h[:-1] + 1.0)
    better = left + right - g[-1] ** 2 / (h[-1] + 1.0)
    k = int(np.argmax(better))
    return float(better[k]), lo + k + 1


def _step(gain: np.ndarray, weight: np.ndarray, depth: int) -> np.ndarray:
    """Shallow tree over ordered bins: the step of each bin."""
    out = np.zeros(len(gain))
    parts = [(0, len(gain))]
    for _ in range(depth):
        new = []
        for lo, hi in parts:
            better, at = _best_split(gain, weight, lo, hi)
            new += [(lo, at), (at, hi)] if better > 1e-6 else [(lo, hi)]
        parts = new
    for lo, hi in parts:
        out[lo:hi] = gain[lo:hi].sum() / (weight[lo:hi].sum() + 1.0)
    return out


def _pair_step(gain: np.ndarray, weight: np.ndarray) -> tuple[float, np.ndarray]:
    """Tree of depth two on a grid: cut one feature, then the other on either side.  (improvement, step of each cell)"""
    best, step = -1.0, np.zeros_like(gain)
    whole = gain.sum() ** 2 / (weight.sum() + 1.0)
    for turned in (False, True):
        g, h = (gain.T, weight.T) if turned else (gain, weight)
        for cut in range(1, len(g)):
            score, out = -whole, np.zeros_like(g)
            for rows in (slice(0, cut), slice(cut, len(g))):
                sums, weights = g[rows].sum(axis=0), h[rows].sum(axis=0)
                _, at = _best_split(sums, weights, 0, len(sums))
                for cols in (slice(0, at), slice(at, len(sums))):
                    s, w = sums[cols].sum(), weights[cols].sum() + 1.0
                    score += s * s / w
                    out[rows, cols] = s / w
            if score > best:
                best, step = score, out.T if turned else out
    return best, step


@dataclass
class AdditiveModel:
    base: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pairs: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for f, (edges, table) in enumerate(zip(self.edges, self.tables)):
            total += table[np.searchsorted(edges, x[:, f], "right")]
        for (f, g), table in self.pairs.items():
            total += table[np.searchsorted(self.pair_edges[f], x[:, f], "right"),
                           np.searchsorted(self.pair_edges[g], x[:, g], "right")]
        return 1.0 / (1.0 + np.exp(-np.clip(total, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray) -> AdditiveModel:
    """Cyclic boosting of single features, then of the strongest pairs.

    Rows are brought into a fixed order first, so the model does not depend on the order they come in.
    """
    order = np.lexsort([*x.T, y])
    x, y = x[order], y[order].astype(float)
    share = (y.sum() + 0.5) / (len(y) + 1.0)
    model = AdditiveModel(base=float(np.log(share / (1 - share))))
    if not len(y) or y.min() == y.max():
        return model

    def cuts(bins: int) -> list[np.ndarray]:
        return [np.unique(np.quantile(c, np.arange(1, bins) / bins, method="higher")) for c in x.T]

    def binned(edges: list[np.ndarray]) -> list[np.ndarray]:
        return [np.searchsorted(e, c, "right") for e, c in zip(edges, x.T)]

    model.edges, model.pair_edges = cuts(BINS), cuts(PAIR_BINS)
    bins, coarse = binned(model.edges), binned(model.pair_edges)
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    total = np.full(len(y), model.base)

    def slope() -> tuple[np.ndarray, np.ndarray]:
        p = 1.0 / (1.0 + np.exp(-np.clip(total, -30, 30)))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for f, table in enumerate(model.tables):
            g, h = slope()
            step = RATE * _step(np.bincount(bins[f], g, len(table)), np.bincount(bins[f], h, len(table)), 2)
            table += step
            total += step[bins[f]]
    shapes = [len(e) + 1 for e in model.pair_edges]

    def grid(f: int, g: int, values: np.ndarray) -> np.ndarray:
        return np.bincount(coarse[f] * shapes[g] + coarse[g], values, shapes[f] * shapes[g]).reshape(shapes[f], shapes[g])

    g, h = slope()
    found = sorted(((_pair_step(grid(a, b, g), grid(a, b, h))[0], a, b)
                    for a in range(len(shapes)) for b in range(a + 1, len(shapes))), reverse=True)
    model.pairs = {(a, b): np.zeros((shapes[a], shapes[b])) for _, a, b in found[:PAIRS]}
    for _ in range(PAIR_ROUNDS):
        for (a, b), table in model.pairs.items():
            g, h = slope()
            step = RATE * _pair_step(grid(a, b, g), grid(a, b, h))[1]
            table += step
            total += step[coarse[a], coarse[b]]
    return model


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id's decimal text, modulo the number of folds."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(folds)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, rows: int) -> DataFrame:
    """(doc_id, y, text) of at most about ``rows`` labelled documents for which ``learn`` holds.

    The choice is by a hash of the id; the chosen ids are a bounded number, so other documents are not shuffled, and
    an id that many rows share counts once.
    """
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
             .where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & learn)
             .groupBy("doc_id").agg(F.max("y").alias("y")))
    there = known.count()
    keep = min(1.0, rows / max(1, there))
    chosen = known.where(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 20)) < F.lit(int(keep * (1 << 20))))
    found = (bounded_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("text"))
             .join(F.broadcast(chosen), "doc_id"))
    # One row per id, combined before the shuffle: a repeated id brings one of its texts, not all of its rows.
    one = F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("one")
    return found.groupBy("doc_id", "y").agg(one).select("doc_id", "y", F.col("one.text").alias("text"))


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", learn: Column | None = None) -> AdditiveModel:
    sample = labelled_sample(docs, labels, label, F.lit(True) if learn is None else learn, SAMPLE_ROWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = feature_matrix(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, x.T)], ["y", *FEATURES])

    columns = ", ".join(f"{f} double" for f in FEATURES)
    rows = sample.select("y", "text").mapInArrow(run, f"y int, {columns}").toArrow()
    x = np.column_stack([rows.column(f).to_numpy() for f in FEATURES]) if len(rows) else np.empty((0, len(FEATURES)))
    return fit(x, rows.column("y").to_numpy())


def scorer(model: AdditiveModel) -> Callable[[Column], Column]:
    """Column function: the score of a text's UTF-8 bytes."""

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(model.score(feature_matrix(texts.to_pylist())))

    return score


def score_texts(docs: DataFrame, model: AdditiveModel) -> DataFrame:
    """(doc_id, score) of every whole text."""
    return bounded_batches(docs).select("doc_id", scorer(model)(text_bytes()).alias("score"))


def keep_quality(docs: DataFrame, model: AdditiveModel, threshold: float = THRESHOLD) -> DataFrame:
    """The documents with a score of at least the threshold, all their columns unchanged."""
    return bounded_batches(docs).where(scorer(model)(text_bytes()) >= threshold)
