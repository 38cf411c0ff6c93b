"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature is cut into bins and has a table with one score per bin; some pairs of features have a table with one
score per pair of bins. The tables are learned by boosting in cycles: feature after feature, a tree of few leaves is
fitted to what is left unexplained and added to that feature's table. A text's score is a sum of table entries.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailmart.llm.labelled import TRAIN_ROWS, held_out, training_texts
from retailmart.llm.texts import doc_texts, map_arrow, texts_of
from retailmart.llm.textstats import TextStats

FEATURES = ("words", "word_length", "symbols", "upper", "digits", "repeats", "dup_lines", "distinct", "stops", "pipes", "shouts", "line_words")
BINS, LEAVES, ROUNDS, RATE, PAIRS, SMOOTH = 32, 3, 80, 0.15, 6, 5.0


def features(text: bytes) -> list[float]:
    """Shares and logarithms; a text without words has zeros."""
    s = TextStats(text)
    words, letters = max(s.n_words, 1), max(s.n_letters, 1)
    return [
        float(np.log1p(s.n_words)),
        s.word_chars / words,
        s.n_symbols / words,
        s.n_upper / letters,
        s.n_digits / max(s.word_chars, 1),
        s.n_repeat_words / words,
        s.n_dup_lines / max(s.n_lines, 1),
        s.n_distinct_words / words,
        s.n_stops / words,
        s.count(b"|") / words,
        s.count(b"!") / words,
        s.n_words / max(s.n_lines, 1),
    ]


class Gam:
    """Bin edges and score tables."""

    def __init__(self, edges: list[np.ndarray], base: float):
        self.edges, self.base = edges, base
        self.tables = [np.zeros(len(e) + 1) for e in edges]
        self.pairs: list[tuple[int, int, np.ndarray]] = []

    def binned(self, x: np.ndarray) -> list[np.ndarray]:
        return [np.searchsorted(e, x[:, k], "right") for k, e in enumerate(self.edges)]

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probabilities, one per row of features."""
        bins = self.binned(x)
        total = np.full(len(x), self.base)
        for table, b in zip(self.tables, bins):
            total += table[b]
        for i, j, table in self.pairs:
            total += table[bins[i], bins[j]]
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray) -> Gam:
    """Learn from ``x`` (rows by features) and ``y`` (0 or 1). Without rows of both kinds the score is a constant."""
    share = (y.sum() + 1) / (len(y) + 2)
    edges = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, BINS + 1)[1:-1])) if len(x) else np.zeros(0) for k in range(len(FEATURES))]
    model = Gam(edges, float(np.log(share / (1 - share))))
    if not len(y) or y.min() == y.max():
        return model
    bins = model.binned(x)
    total = np.full(len(y), model.base)
    for _ in range(ROUNDS):
        for table, b in zip(model.tables, bins):
            step = RATE * _tree(*_sums(y, total, b, len(table)))
            table += step
            total += step[b]
    gains = sorted(((_corner(*_sums2(y, total, bins, i, j, model))[0], i, j) for i, j in combinations(range(len(bins)), 2)), reverse=True)
    model.pairs = [(i, j, np.zeros((len(model.tables[i]), len(model.tables[j])))) for _, i, j in gains[:PAIRS]]
    for _ in range(ROUNDS // 4):
        for i, j, table in model.pairs:
            step = RATE * _corner(*_sums2(y, total, bins, i, j, model))[1]
            table += step
            total += step[bins[i], bins[j]]
    return model


def _slopes(y: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    p = 1 / (1 + np.exp(-total))
    return y - p, p * (1 - p)


def _sums(y, total, b, size) -> tuple[np.ndarray, np.ndarray]:
    g, h = _slopes(y, total)
    return np.bincount(b, g, size), np.bincount(b, h, size)


def _tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """A step per bin: the bins are cut into ``LEAVES`` stretches, each cut where it gains most."""
    leaves = [(0, len(g))]
    while len(leaves) < LEAVES:
        best = None
        for a, b in leaves:
            if b - a < 2:
                continue
            cg, ch = np.cumsum(g[a:b]), np.cumsum(h[a:b])
            gain = cg[:-1] ** 2 / (ch[:-1] + SMOOTH) + (cg[-1] - cg[:-1]) ** 2 / (ch[-1] - ch[:-1] + SMOOTH) - cg[-1] ** 2 / (ch[-1] + SMOOTH)
            k = int(gain.argmax())
            if best is None or gain[k] > best[0]:
                best = (gain[k], a, b, a + k + 1)
        if best is None or best[0] <= 0:
            break
        leaves.remove(best[1:3])
        leaves += [(best[1], best[3]), (best[3], best[2])]
    step = np.zeros(len(g))
    for a, b in leaves:
        step[a:b] = g[a:b].sum() / (h[a:b].sum() + SMOOTH)
    return step


def _sums2(y, total, bins, i, j, model) -> tuple[np.ndarray, np.ndarray]:
    g, h = _slopes(y, total)
    shape = (len(model.tables[i]), len(model.tables[j]))
    flat = bins[i] * shape[1] + bins[j]
    return np.bincount(flat, g, shape[0] * shape[1]).reshape(shape), np.bincount(flat, h, shape[0] * shape[1]).reshape(shape)


def _corner(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """(gain, step per pair of bins) of the best cut of the table into four corners."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    if min(g.shape) < 2:
        return 0.0, np.zeros(g.shape)

    def parts(c):
        low = c[:-1, :-1]
        return low, c[:-1, -1:] - low, c[-1:, :-1] - low, c[-1, -1] - c[:-1, -1:] - c[-1:, :-1] + low

    gain = sum(pg**2 / (ph + SMOOTH) for pg, ph in zip(parts(cg), parts(ch))) - cg[-1, -1] ** 2 / (ch[-1, -1] + SMOOTH)
    a, b = np.unravel_index(int(gain.argmax()), gain.shape)
    step = np.zeros(g.shape)
    for rows in (slice(0, a + 1), slice(a + 1, None)):
        for columns in (slice(0, b + 1), slice(b + 1, None)):
            step[rows, columns] = g[rows, columns].sum() / (h[rows, columns].sum() + SMOOTH)
    return float(gain[a, b]), step


def _feature_rows(texts: DataFrame) -> DataFrame:
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = pa.array([features(t) for t in texts_of(batch.column("text"))], pa.list_(pa.float64()))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), found], ["doc_id", "label", "x"])

    return map_arrow(texts, work, "doc_id long, label int, x array<double>")


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = TRAIN_ROWS, **columns) -> Gam:
    """Fit on the features of at most ``rows`` labelled documents, which come to the driver in the order of their ids."""
    found = sorted(_feature_rows(training_texts(docs, labels, label, rows, **columns)).collect())
    x = np.array([r["x"] for r in found], np.float64).reshape(len(found), len(FEATURES))
    return fit(x, np.array([r["label"] for r in found], np.float64))


def score_quality(docs: DataFrame, model: Gam, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per input row; null and empty texts are scored like any other.

    Only the text makes the score. An empty table gives no rows.
    """
    state = vars(model)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = Gam.__new__(Gam)
        vars(own).update(state)
        x = np.array([features(t) for t in texts_of(batch.column("text"))], np.float64)
        scores = own.scores(x)
        columns = [batch.column("doc_id"), pa.array(scores), pa.array((scores >= threshold).astype(np.int32))]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "score", "predicted"])

    scored = map_arrow(doc_texts(docs, id_col, text_col), work, "doc_id long, score double, predicted int")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
