"""Quality classifier: a generalised additive model with pairwise interactions.

Every feature and every chosen pair of features has a look-up table over bins. The tables
are learned by cyclic gradient boosting of shallow trees, and a score is the sum of
one entry per table.
"""

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, functions as F

from milepost.llm.arrow import add_columns
from milepost.llm.measures import NAMES, measure

MAX_TRAINING_ROWS = 20_000  # the classifier is fitted on about so many labelled rows at most
BINS, ROUNDS, PAIR_ROUNDS, PAIRS, RATE = 32, 120, 40, 6, 0.15
LEAST_LEAF = 8  # training rows in a leaf
FEATURES = (
    "log_words", "word_length", "symbols", "dup_lines", "repeats", "adjacent", "upper", "digits", "marks",
    "distinct", "longest", "line_length",
)


def features(counts: np.ndarray) -> np.ndarray:
    """Rows of measures.NAMES -> rows of FEATURES, all finite."""
    c = {name: counts[:, i].astype(float) for i, name in enumerate(NAMES)}
    words, chars, lines = (np.maximum(c[n], 1) for n in ("n_words", "word_chars", "n_lines"))
    return np.column_stack([
        np.log1p(c["n_words"]), chars / words, c["n_symbols"] / chars, c["n_dup_lines"] / lines,
        c["n_repeat_words"] / words, c["n_adjacent"] / words, c["n_upper"] / chars, c["n_digits"] / chars,
        c["n_marks"] / words, c["n_distinct"] / words, np.log1p(c["longest"]), words / lines,
    ])


@dataclass
class Model:
    edges: list[np.ndarray]  # per feature: upper bounds of its bins but the last
    base: float
    tables: list[np.ndarray]
    pairs: list[tuple[int, int, np.ndarray]]

    def score(self, x: np.ndarray) -> np.ndarray:
        bins = [np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(self.edges)]
        total = np.full(len(x), self.base)
        for b, table in zip(bins, self.tables):
            total += table[b]
        for i, j, table in self.pairs:
            total += table[bins[i], bins[j]]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _split(g: np.ndarray, h: np.ndarray, n: np.ndarray, depth: int, out: np.ndarray) -> None:
    """A regression tree over ordered bins, by summed gradients: fills its leaf values."""
    gain, at = 0.0, 0
    if depth and len(g) > 1:
        gl, hl, nl = np.cumsum(g)[:-1], np.cumsum(h)[:-1], np.cumsum(n)[:-1]
        gr, hr, nr = g.sum() - gl, h.sum() - hl, n.sum() - nl
        gains = gl**2 / (hl + 1) + gr**2 / (hr + 1) - g.sum() ** 2 / (h.sum() + 1)
        gains[(nl < LEAST_LEAF) | (nr < LEAST_LEAF)] = 0
        at = int(gains.argmax())
        gain = gains[at]
    if gain > 1e-9:
        _split(g[: at + 1], h[: at + 1], n[: at + 1], depth - 1, out[: at + 1])
        _split(g[at + 1 :], h[at + 1 :], n[at + 1 :], depth - 1, out[at + 1 :])
    else:
        out[:] = g.sum() / (h.sum() + 1)


def _plane(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, float]:
    """The best cut into four along both axes: leaf values and gain."""
    c = [np.cumsum(np.cumsum(a, 0), 1) for a in (g, h, n)]
    gain, at = 0.0, None
    parts = []
    for a in c:
        low, left, top, all_ = a[:-1, :-1], a[:-1, -1:], a[-1:, :-1], a[-1, -1]
        parts.append((low, left - low, top - low, all_ - left - top + low))
    gains = sum(q**2 / (w + 1) for q, w in zip(parts[0], parts[1]))
    gains = np.where(sum((m >= LEAST_LEAF).astype(int) for m in parts[2]) >= 3, gains, 0) - g.sum() ** 2 / (h.sum() + 1)
    out = np.zeros_like(g)
    if gains.size and gains.max() > 1e-9:
        i, j = at = np.unravel_index(gains.argmax(), gains.shape)
        gain = float(gains[at])
        for rows in (slice(0, i + 1), slice(i + 1, None)):
            for cols in (slice(0, j + 1), slice(j + 1, None)):
                out[rows, cols] = g[rows, cols].sum() / (h[rows, cols].sum() + 1)
    return out, gain


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Tables by cyclic boosting: single features first, then the pairs with most to gain."""
    if not len(y):
        return Model([np.zeros(0)] * x.shape[1], 0.0, [np.zeros(1)] * x.shape[1], [])
    edges = [np.unique(np.quantile(col, np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for col in x.T]
    bins = [np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)]
    sizes = [len(e) + 1 for e in edges]
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    tables, total = [np.zeros(s) for s in sizes], np.full(len(y), base)

    def gradients():
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for j, size in enumerate(sizes):
            if size < 2:
                continue
            g, h = gradients()
            step = np.zeros(size)
            _split(np.bincount(bins[j], g, size), np.bincount(bins[j], h, size), np.bincount(bins[j], minlength=size), 2, step)
            tables[j] += RATE * step
            total += RATE * step[bins[j]]

    def sums(i, j, values):
        return np.bincount(bins[i] * sizes[j] + bins[j], values, sizes[i] * sizes[j]).reshape(sizes[i], sizes[j])

    g, h = gradients()
    one = np.ones(len(y))
    gains = sorted(
        ((_plane(sums(i, j, g), sums(i, j, h), sums(i, j, one))[1], i, j) for i in range(len(sizes)) for j in range(i + 1, len(sizes))), reverse=True
    )
    pairs = [(i, j, np.zeros((sizes[i], sizes[j]))) for gain, i, j in gains[:PAIRS] if gain > 0]
    for _ in range(PAIR_ROUNDS):
        for i, j, table in pairs:
            g, h = gradients()
            step, _ = _plane(sums(i, j, g), sums(i, j, h), sums(i, j, one))
            table += RATE * step
            total += RATE * step[bins[i], bins[j]]
    return Model(edges, base, tables, pairs)


def held_out(key: str, folds: int = 4, fold: int = 2):
    """Whether a row is never learned from: by the checksum of its id as text; a null id counts as ''."""
    return F.pmod(F.crc32(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit(""))), F.lit(folds)) == fold


def train(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", max_rows: int = MAX_TRAINING_ROWS
) -> Model:
    """Fit on labelled documents that are not held out.

    Of more than `max_rows` labels those with the lowest hash of the id are taken (a
    share of max_rows / all, so about max_rows). Only these ids are broadcast, and only
    the counts of their texts, a dozen numbers each, reach the driver. Rows without
    label or id are not learned from; a document labelled twice counts twice. Without
    labels every score is 0.5.
    """
    usable = labels.select(F.col(f"`{key}`").alias("_id"), F.col(f"`{label}`").cast("int").alias("_y"))
    usable = usable.where("_id is not null and _y is not null").where(~held_out("_id"))
    n = usable.count()
    slices = 1_000_000
    picked = usable.where(F.pmod(F.xxhash64("_id"), F.lit(slices)) < F.lit(slices * max_rows // max(n, max_rows)))
    chosen = docs.select(F.col(f"`{key}`").alias("_id"), F.col(f"`{text}`").alias("_t")).join(F.broadcast(picked), "_id")
    counted = add_columns(chosen, "_t", ", ".join(f"{c} bigint" for c in NAMES), lambda: lambda texts: list(zip(*map(measure, texts))) or [[] for _ in NAMES])
    rows = counted.toArrow().to_pandas().sort_values(["_id", "_y", *NAMES])
    return fit(features(rows[list(NAMES)].to_numpy()), rows["_y"].to_numpy(float))


def score(docs: DataFrame, model: Model, text: str = "text", keep_text: bool = False, name: str = "score") -> DataFrame:
    """`docs` with `name`: how likely label 1 is, 0 to 1.

    Whole texts, batch by batch: bins of all features, then one table entry each is
    added. No shuffle; the broadcast model has a fixed size. A null text scores like an
    empty one. Other columns are kept (the text with keep_text); one named like the score is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        def work(texts):
            counts = np.array([measure(t) for t in texts], float).reshape(len(texts), len(NAMES))
            return [shared.value.score(features(counts))]

        return work

    return add_columns(docs, text, f"{name} double", make, keep_text)
