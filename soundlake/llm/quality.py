"""Quality of texts: a generalised additive model with pairwise interactions over cheap text statistics."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


from soundlake.llm.words import chain, parts, text_bytes, word_hashes
from soundlake.operators.lineage import cut

FEATURES = (
    "log_bytes", "log_words", "word_bytes", "long_word", "upper", "digit", "mark", "stop", "line", "space", "high", "distinct_words", "top_word", "same_next",
    "distinct_triples", "first_upper", "last_mark",
)
#: Labelled rows that a model is fitted on, about; a deterministic sample where there are more.
FIT_ROWS = 20_000
BINS, PAIR_BINS, PAIRS = 64, 12, 8
ROUNDS, PAIR_ROUNDS, RATE, RIDGE, LEAST = 300, 80, 0.1, 1.0, 5


def _classes() -> np.ndarray:
    kinds = np.zeros((6, 256), bool)
    kinds[0, 65:91] = True  # upper
    kinds[1, 48:58] = True  # digit
    kinds[2, 33:127] = True  # mark
    kinds[2, [*range(48, 58), *range(65, 91), *range(97, 123), *b".,;:'\"()-"]] = False
    kinds[3, list(b".!?")] = True  # stop
    kinds[4, 10] = True  # line
    kinds[5, 128:] = True  # high
    return kinds


_KINDS = _classes()


def features(texts: pa.Array) -> np.ndarray:
    """One row of ``FEATURES`` per text, over the whole of it; an empty or null text has zeros."""
    data, bounds = text_bytes(texts)
    h, starts, ends, first = word_hashes(data, bounds)
    n, words = np.diff(bounds), np.diff(first)
    out = np.zeros((len(n), len(FEATURES)))
    size = np.maximum(n, 1)

    def per_text(flags: np.ndarray, edges: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return total[edges[1:]] - total[edges[:-1]]

    body = data[:-8]
    out[:, 0], out[:, 1] = np.log1p(n), np.log1p(words)
    length = ends - starts
    out[:, 2] = per_text(length, first) / np.maximum(words, 1)
    out[:, 3] = per_text(length > 20, first) / np.maximum(words, 1)
    for k, column in enumerate((4, 5, 6, 7, 8, 10)):
        out[:, column] = per_text(_KINDS[k][body], bounds) / size
    out[:, 9] = 1 - per_text(length, first) / size
    out[:, 15] = per_text(_KINDS[0][data[starts]], first) / np.maximum(words, 1)
    out[:, 16] = per_text(_KINDS[2][data[ends - 1]], first) / np.maximum(words, 1)
    same = np.concatenate([h[1:] == h[:-1], [False]]) if len(h) else np.zeros(0, bool)
    same[first[1:][words > 0] - 1] = False
    out[:, 13] = per_text(same, first) / np.maximum(words, 1)
    triples = chain(h, 3)
    for i in np.flatnonzero(words).tolist():
        a, b = first[i], first[i + 1]
        _, count = np.unique(h[a:b], return_counts=True)
        out[i, 11], out[i, 12] = len(count) / (b - a), count.max() / (b - a)
        out[i, 14] = len(np.unique(triples[a : b - 2])) / (b - a - 2) if b - a > 2 else 1.0
    return out


def text_features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and x (array of ``FEATURES``) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts(batches, 1):
            x = features(part.column(1))
            offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1])
            yield pa.record_batch([part.column(0), pa.ListArray.from_arrays(offsets, pa.array(x.ravel()))], names=["doc_id", "x"])

    return docs.select(id_col, text_col).mapInArrow(run, f"doc_id {docs.schema[id_col].dataType.simpleString()}, x array<double>")


@dataclass
class Additive:
    """``bias + sum of one table per feature + sum of one table per pair``, all looked up by bin."""

    bias: float
    cuts: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]]
    coarse: list[np.ndarray]
    grids: list[np.ndarray]

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.bias)
        for j, (c, t) in enumerate(zip(self.cuts, self.tables, strict=True)):
            total += t[np.searchsorted(c, x[:, j], "right")]
        for (i, j), g in zip(self.pairs, self.grids, strict=True):
            total += g[np.searchsorted(self.coarse[i], x[:, i], "right"), np.searchsorted(self.coarse[j], x[:, j], "right")]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _cuts(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.arange(1, bins) / bins)) if len(values) else np.zeros(0)


def _split(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> tuple[float, int, float, float]:
    """(gain, first bin on the right, left value, right value) of the best split of one axis of bins."""
    gl, hl, nl = np.cumsum(g)[:-1], np.cumsum(h)[:-1], np.cumsum(n)[:-1]
    gr, hr, nr = g.sum() - gl, h.sum() - hl, n.sum() - nl
    gain = np.where((nl >= LEAST) & (nr >= LEAST), gl**2 / (hl + RIDGE) + gr**2 / (hr + RIDGE) - g.sum() ** 2 / (h.sum() + RIDGE), -1.0)
    if not len(gain) or gain.max() <= 1e-9:
        return 0.0, 0, 0.0, 0.0
    k = int(gain.argmax())
    return float(gain[k]), k + 1, float(gl[k] / (hl[k] + RIDGE)), float(gr[k] / (hr[k] + RIDGE))


def fit(x: np.ndarray, y: np.ndarray) -> Additive:
    """Cyclic gradient boosting on logistic loss: in each round every feature in turn gets one shallow tree, whose leaves are added to
    its table; then the pairs with the largest gain on what is left get trees of depth two on coarse grids."""
    m = x.shape[1]
    rate = float(np.clip(y.mean() if len(y) else 0.5, 0.01, 0.99))
    model = Additive(float(np.log(rate / (1 - rate))), [_cuts(x[:, j], BINS) for j in range(m)], [], [], [_cuts(x[:, j], PAIR_BINS) for j in range(m)], [])
    model.tables = [np.zeros(len(c) + 1) for c in model.cuts]
    if not len(y):
        return model
    fine = [np.searchsorted(c, x[:, j], "right") for j, c in enumerate(model.cuts)]
    rough = [np.searchsorted(c, x[:, j], "right") for j, c in enumerate(model.coarse)]
    total = np.full(len(y), model.bias)

    def slopes():
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for j in range(m):
            g, h = slopes()
            size = len(model.tables[j])
            gain, k, left, right = _split(np.bincount(fine[j], g, size), np.bincount(fine[j], h, size), np.bincount(fine[j], minlength=size))
            if gain > 0:
                step = np.where(np.arange(size) < k, left, right) * RATE
                model.tables[j] += step
                total += step[fine[j]]

    def grid(i, j, w):
        shape = len(model.coarse[i]) + 1, len(model.coarse[j]) + 1
        return np.bincount(rough[i] * shape[1] + rough[j], w, shape[0] * shape[1]).reshape(shape)

    def tree(i, j, g, h):
        """Depth two: split one feature, then each half on the other."""
        gs, hs, ns = grid(i, j, g), grid(i, j, h), grid(i, j, np.ones(len(y)))
        best = (0.0, None)
        for axis in (0, 1):
            a, b, c = (v if axis == 0 else v.T for v in (gs, hs, ns))
            for k in range(1, len(a)):
                step, gain = np.zeros(a.shape), 0.0
                for half in (slice(0, k), slice(k, None)):
                    won, s, left, right = _split(a[half].sum(0), b[half].sum(0), c[half].sum(0))
                    gain += won
                    if won > 0:
                        step[half] = np.where(np.arange(a.shape[1]) < s, left, right)
                if gain > best[0]:
                    best = gain, step if axis == 0 else step.T
        return best

    g, h = slopes()
    gains = sorted(((tree(i, j, g, h)[0], i, j) for i in range(m) for j in range(i + 1, m)), reverse=True)
    model.pairs = [(i, j) for gain, i, j in gains[:PAIRS] if gain > 0]
    model.grids = [np.zeros((len(model.coarse[i]) + 1, len(model.coarse[j]) + 1)) for i, j in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for q, (i, j) in enumerate(model.pairs):
            gain, step = tree(i, j, *slopes())
            if gain > 0:
                model.grids[q] += step * RATE
                total += RATE * step[rough[i], rough[j]]
    return model


def fit_labelled(table: DataFrame, labels: DataFrame, rows: int = FIT_ROWS, quality: str = "quality") -> Additive:
    """A model from a feature table (doc_id, x) and labels (doc_id, quality 0 or 1). Null labels are not used; a sample of about ``rows`` rows, picked by a
    hash of the id, goes to the driver, where bins and boosting take seconds."""
    labels = labels.where(F.col(quality).isNotNull()).select(F.col("doc_id").alias("_id"), F.col(quality).cast("double").alias("y"))
    share = min(1.0, rows / max(1, labels.count()))
    picked = labels.where(F.pmod(F.xxhash64("_id"), F.lit(1 << 20)) < share * (1 << 20))
    found = table.join(picked, F.col("doc_id") == F.col("_id")).select("x", "y").toArrow()
    y = found["y"].to_numpy()
    x = found["x"].combine_chunks().flatten().to_numpy().reshape(len(y), len(FEATURES)) if len(y) else np.zeros((0, len(FEATURES)))
    order = np.lexsort((*x.T, y))
    return fit(x[order], y[order])


def score(table: DataFrame, model: Additive) -> DataFrame:
    """doc_id and score (0 to 1) of every row of a feature table, by adding one looked-up number per feature and pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(FEATURES))
            yield pa.record_batch([batch.column(0), pa.array(model.score(x))], names=["doc_id", "score"])

    return table.select("doc_id", "x").mapInArrow(run, f"doc_id {table.schema['doc_id'].dataType.simpleString()}, score double")


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, score of every document with a model learned from ``labels``.

    Null and empty texts are scored as texts of no length; repeated rows are scored alike; without labels every score is 0.5; empty tables give no
    rows; extra columns are not read.
    """
    table = cut(text_features(docs), "features")
    return score(table, fit_labelled(table, labels))
