"""Document quality: histogram gradient-boosted trees over document statistics.

The statistics are computed for whole texts inside the tasks. The trees are grown on a bounded sample of
labelled documents and flattened into arrays, which numpy walks for all rows and trees at once.

Defined results: a null or empty text has statistics of zero and gets a score like any other; a repeated
row gets its score again; without labelled rows, or with one label only, every score is the (smoothed) share
of label 1, 0.5 without rows; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiquarry.llm import arrays as ar
from lexiquarry.llm.sampling import sample_labels, with_texts

LINE_TABLE = np.zeros(256, bool)
LINE_TABLE[[0x0A, 0x0D]] = True


def _bytes(chars: str) -> np.ndarray:
    return np.frombuffer(chars.encode("ascii"), np.uint8)


UPPER, LOWER = np.arange(65, 91), np.arange(97, 123)
DIGITS, STOPS, COMMAS, MARKS = _bytes("0123456789"), _bytes("."), _bytes(",;:"), _bytes("!?")
SYMBOLS, BARS, BRACKETS, QUOTES = _bytes("#$%&*@^~+=\\"), _bytes("|_/"), _bytes("()[]{}<>"), _bytes("'\"`-")

STATISTICS = (
    "log_bytes log_words word_bytes upper lower non_ascii digits stops commas marks symbols bars brackets "
    "quotes control entropy distinct_words top_word words_per_stop log_lines line_words distinct_lines "
    "short_words"
).split()


def _repetition(hashes: np.ndarray) -> tuple[float, float]:
    """Share of distinct values, share of the most frequent one."""
    if not len(hashes):
        return 0.0, 0.0
    _, counts = np.unique(hashes, return_counts=True)
    return len(counts) / len(hashes), counts.max() / len(hashes)


def document_statistics(column: pa.Array) -> np.ndarray:
    """One row of `STATISTICS` per text."""
    data, offsets = ar.text_buffers(column)
    out = np.zeros((len(offsets) - 1, len(STATISTICS)))
    lines = ar.words_by_row(column, LINE_TABLE)
    for (row, words), (_, line) in zip(ar.words_by_row(column), lines, strict=True):
        text = data[offsets[row]:offsets[row + 1]]
        n = len(text)
        if not n:
            continue
        counts = np.zeros(256, np.int64)
        for at in range(0, n, ar.BLOCK_BYTES):
            counts += np.bincount(text[at:at + ar.BLOCK_BYTES], minlength=256)
        spaces = counts[list(ar.WHITE_SPACE)].sum()
        n_words, ink = max(len(words), 1), max(n - spaces, 1)
        share = counts[counts > 0] / n
        distinct, top = _repetition(words)
        distinct_lines, _ = _repetition(line)
        classes = [counts[c].sum() / ink for c in (
            UPPER, LOWER, np.arange(128, 256), DIGITS, STOPS, COMMAS, MARKS, SYMBOLS, BARS, BRACKETS, QUOTES)]
        control = (counts[:32].sum() - counts[9:14].sum() + counts[127]) / n
        out[row] = [np.log1p(n), np.log1p(len(words)), ink / n_words, *classes, control,
                    -(share * np.log2(share)).sum(), distinct, top,
                    n_words / (1 + counts[STOPS].sum() + counts[MARKS].sum()), np.log1p(len(line)),
                    n_words / max(len(line), 1), distinct_lines, spaces / n_words]
    return out


@dataclass(frozen=True)
class Forest:
    """All trees in flat arrays; a leaf points to itself, so a walk of `depth` steps ends in one."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    base: float
    depth: int

    def score(self, rows: np.ndarray) -> np.ndarray:
        total = np.full(len(rows), self.base)
        for at in range(0, len(rows), 4096):
            part = rows[at:at + 4096]
            index = np.arange(len(part))[:, None]
            node = np.broadcast_to(self.roots, (len(part), len(self.roots)))
            for _ in range(self.depth):
                low = part[index, self.feature[node]] <= self.threshold[node]
                node = np.where(low, self.left[node], self.right[node])
            total[at:at + 4096] += self.value[node].sum(axis=1)
        return 1 / (1 + np.exp(-total))


def grow_forest(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, bins: int = 64,
                rate: float = 0.15, ridge: float = 1.0, least_rows: int = 8) -> Forest:
    """Boosted trees for a 0/1 target: second-order gains on histograms of quantile bins."""
    share = (y.sum() + 1) / (len(y) + 2)
    base = float(np.log(share / (1 - share)))
    nodes: list[list] = []  # feature, threshold, left, right, value
    roots = []
    one_label = not len(y) or y.min() == y.max()
    if not one_label:
        edges = [np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1])) for column in x.T]
        binned = np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T, strict=True)], axis=1)
        n_features = x.shape[1]
        cell = binned + np.arange(n_features) * bins
        total = np.full(len(y), base)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-total))
            g, h = p - y, p * (1 - p)
            roots.append(len(nodes))
            nodes.append([0, 0.0, 0, 0, 0.0])
            level = [(roots[-1], np.arange(len(y)))]
            for step in range(depth + 1):
                following = []
                for node, rows in level:
                    gs, hs = g[rows].sum(), h[rows].sum()
                    best = None
                    if step < depth and len(rows) >= 2 * least_rows:
                        flat = cell[rows].ravel()
                        size = n_features * bins
                        hist = [np.bincount(flat, w, size).reshape(n_features, bins).cumsum(axis=1)
                                for w in (np.repeat(g[rows], n_features), np.repeat(h[rows], n_features), None)]
                        gl, hl, nl = hist
                        gain = gl**2 / (hl + ridge) + (gs - gl)**2 / (hs - hl + ridge) - gs**2 / (hs + ridge)
                        gain[(nl < least_rows) | (len(rows) - nl < least_rows)] = -1
                        f, b = np.unravel_index(int(gain.argmax()), gain.shape)
                        if gain[f, b] > 1e-6 and b < len(edges[f]):
                            best = int(f), int(b)
                    if best is None:
                        nodes[node] = [0, 0.0, node, node, -rate * gs / (hs + ridge)]
                        total[rows] += nodes[node][4]
                        continue
                    f, b = best
                    low = binned[rows, f] <= b
                    nodes[node] = [f, edges[f][b], len(nodes), len(nodes) + 1, 0.0]
                    nodes += [[0, 0.0, 0, 0, 0.0], [0, 0.0, 0, 0, 0.0]]
                    following += [(len(nodes) - 2, rows[low]), (len(nodes) - 1, rows[~low])]
                level = following
    columns = list(zip(*nodes, strict=True)) if nodes else [[], [], [], [], []]
    kinds = (np.int64, np.float64, np.int64, np.int64, np.float64)
    return Forest(np.array(roots, np.int64), *[np.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                  base, depth)


def fit_quality(documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
                label: str = "quality", max_rows: int = 8000) -> Forest:
    """Trees from at most `max_rows` labelled documents; their statistics come to the driver, no text does."""
    known = labels.select(key, F.col(label).cast("int").alias("__y")).where(F.col("__y").isin(0, 1)).dropna()
    sample = with_texts(sample_labels(known, key, max_rows), documents, key, text)

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        x = document_statistics(batch.column(0))
        yield {"x": ar.list_column(list(x), pa.float64()), "y": batch.column(1)}

    rows = ar.map_arrow(sample.select(text, "__y"), work, "x array<double>, y int").toArrow()
    if not rows.num_rows:
        return grow_forest(np.zeros((0, len(STATISTICS))), np.zeros(0))
    x = np.array(rows["x"].combine_chunks().flatten()).reshape(-1, len(STATISTICS))
    order = np.lexsort([*x.T[::-1], np.array(rows["y"])])  # the same trees whatever order the tasks end in
    return grow_forest(x[order], np.array(rows["y"], float)[order])


def score_quality(documents: DataFrame, forest: Forest, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score, predicted) for every row."""
    kind = dict(documents.dtypes)[key]

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        score = forest.score(document_statistics(batch.column(1)))
        yield {key: batch.column(0), "score": score, "predicted": (score >= 0.5).astype(np.int32)}

    return ar.map_arrow(documents.select(key, text), work, f"{key} {kind}, score double, predicted int")
