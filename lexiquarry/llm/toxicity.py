"""Toxicity: a classifier chain over hashed words.

The categories are predicted one after the other. Each link is a ridge logistic regression over the
presence of words and word beginnings, and the probabilities of the earlier categories. A link is trained on out-of-fold
probabilities of the earlier ones, so it meets in training what it will meet in use.

Defined results: a null, empty or wordless text has no word and gets each link's rate for such a text; a
repeated row gets its result again; label rows with a null category teach nothing; without labelled rows
all probabilities are 0, and a category that never occurs stays near 0; an empty table gives an empty
result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiquarry.llm import arrays as ar
from lexiquarry.llm.sampling import sample_labels, with_texts

BUCKET_BITS = 22
FOLDS = 5

# Words are runs of letters here; bytes of non-ASCII characters count as letters.
NON_LETTERS = np.ones(256, bool)
NON_LETTERS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = False


# Beginnings of words are features too, so that inflected forms share what is learnt.
STEM_BYTES = (4, 5, 6, 7)
ENDING_BYTES = 8


def _word_and_stems(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each word and, where the rest is short, of its beginnings; 0 where there is none."""
    columns = [ar.hash_words(data, starts, ends)]
    size = ends - starts
    for n, salt in zip(STEM_BYTES, ar.mix(np.arange(len(STEM_BYTES), dtype=np.uint64)), strict=True):
        stem = ar.hash_words(data, starts, np.minimum(starts + n, ends)) ^ salt
        columns.append(np.where((size > n) & (size <= n + ENDING_BYTES), stem, np.uint64(0)))
    return np.stack(columns, axis=1)


def word_buckets(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(row, buckets of its words and stems) for every text."""
    for row, words in ar.words_by_row(column, NON_LETTERS, _word_and_stems):
        flat = words.ravel()
        yield row, (flat[flat != 0] >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


@dataclass(frozen=True)
class Link:
    """One category: buckets it looks at, their weights, weights of the earlier links, and the intercept."""

    buckets: np.ndarray
    weights: np.ndarray
    earlier: np.ndarray
    bias: float

    def probability(self, x: np.ndarray, before: np.ndarray) -> np.ndarray:
        return logistic(x @ self.weights + before @ self.earlier + self.bias)


@dataclass(frozen=True)
class Chain:
    """`thresholds` are the probabilities from which on a category is decided, best out of fold."""

    categories: tuple[str, ...]
    links: tuple[Link, ...]
    thresholds: tuple[float, ...] = ()

    def threshold(self, category: str) -> float:
        return self.thresholds[self.categories.index(category)] if self.thresholds else 0.5

    def probabilities(self, column: pa.Array) -> np.ndarray:
        out = np.zeros((len(column), len(self.categories)))
        if not self.links or not len(column):
            return out
        used = np.unique(np.concatenate([link.buckets for link in self.links]))
        place = np.full(1 << BUCKET_BITS, -1, np.int32)
        place[used] = np.arange(len(used))
        x = np.zeros((len(column), len(used)), np.float32)
        for row, buckets in word_buckets(column):
            found = place[buckets]
            x[row, found[found >= 0]] = 1
        for k, link in enumerate(self.links):
            out[:, k] = link.probability(x[:, place[link.buckets]], out[:, :k])
        return out


def _select(docs: list[np.ndarray], y: np.ndarray, n_features: int) -> np.ndarray:
    """Buckets whose presence tells most about the category (likelihood ratio)."""
    sizes = [len(d) for d in docs]
    flat = np.concatenate(docs) if docs else np.zeros(0, np.int64)
    of = np.repeat(y, sizes)
    with_1 = np.bincount(flat[of == 1], minlength=1 << BUCKET_BITS)
    with_all = np.bincount(flat, minlength=1 << BUCKET_BITS)
    seen = np.flatnonzero(with_all >= 3)
    n, n1 = len(y), y.sum()
    a, t = with_1[seen].astype(float), with_all[seen].astype(float)
    gain = np.zeros(len(seen))
    for got, row, col in ((a, t, n1), (t - a, t, n - n1), (n1 - a, n - t, n1), (n - n1 - t + a, n - t, n - n1)):
        expected = np.maximum(row * col / n, 1e-9)
        gain += np.where(got > 0, got * np.log(np.maximum(got, 1e-9) / expected), 0)
    return np.sort(seen[np.argsort(-gain, kind="stable")[:n_features]])


def _presence(docs: list[np.ndarray], buckets: np.ndarray) -> np.ndarray:
    place = np.full(1 << BUCKET_BITS, -1, np.int32)
    place[buckets] = np.arange(len(buckets))
    x = np.zeros((len(docs), len(buckets)))
    for i, d in enumerate(docs):
        found = place[d]
        x[i, found[found >= 0]] = 1
    return x


def _solve(x: np.ndarray, curvature: np.ndarray, penalty: np.ndarray, pull: np.ndarray) -> np.ndarray:
    """Solve (x' diag(curvature) x + diag(penalty)) step = pull by conjugate gradients."""
    step, left = np.zeros(len(pull)), pull.copy()
    scale = 1 / ((x**2).T @ curvature + penalty)
    along = scale * left
    size = left @ along
    for _ in range(60):
        image = x.T @ (curvature * (x @ along)) + penalty * along
        rate = size / max(along @ image, 1e-300)
        step += rate * along
        left -= rate * image
        size, before = left @ (scale * left), size
        if size < 1e-12:
            break
        along = scale * left + (size / before) * along
    return step


def _fit_link(docs: list[np.ndarray], before: np.ndarray, y: np.ndarray, n_features: int, ridge: float) -> Link:
    buckets = _select(docs, y, n_features)
    x = np.hstack([_presence(docs, buckets), before, np.ones((len(docs), 1))])
    w = np.zeros(x.shape[1])
    w[-1] = np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-3
    for _ in range(20):
        p = logistic(x @ w)
        step = _solve(x, p * (1 - p), penalty, x.T @ (p - y) + penalty * w)
        # Newton steps from afar overshoot, so none moves a weight by more than two.
        w -= step * min(1, 2 / max(abs(step).max(), 1e-12))
        if abs(step).max() < 1e-3:
            break
    k = before.shape[1]
    return Link(buckets, w[:len(buckets)], w[len(buckets):len(buckets) + k], float(w[-1]))


def best_threshold(p: np.ndarray, y: np.ndarray) -> float:
    """The cut between 0.1 and 0.9 with the largest F measure, precision weighing twice as much as recall.

    Of equal cuts it is the one nearest to 0.5.
    """
    cuts = sorted(np.arange(10, 91, 5) / 100, key=lambda c: abs(c - 0.5))
    return float(max(cuts, key=lambda c: 1.25 * y[p >= c].sum() / max((p >= c).sum() + y.sum() / 4, 1)))


def fit_chain(docs: list[np.ndarray], targets: np.ndarray, categories: Sequence[str], n_features: int = 384,
              ridge: float = 0.5) -> Chain:
    """`docs` hold distinct word buckets, `targets` a 0/1 column per category, in chain order."""
    if not docs:
        return Chain(tuple(categories), ())
    fold = np.arange(len(docs)) % FOLDS
    out_of_fold, links, thresholds = np.zeros((len(docs), 0)), [], []
    for k in range(len(categories)):
        y = targets[:, k].astype(float)
        held = np.zeros(len(docs))
        for f in range(FOLDS):
            learn, rest = np.flatnonzero(fold != f), np.flatnonzero(fold == f)
            if not len(learn) or not len(rest):
                continue
            link = _fit_link([docs[i] for i in learn], out_of_fold[learn], y[learn], n_features, ridge)
            x = _presence([docs[i] for i in rest], link.buckets)
            held[rest] = link.probability(x, out_of_fold[rest])
        links.append(_fit_link(docs, out_of_fold, y, n_features, ridge))
        thresholds.append(best_threshold(held, y))
        out_of_fold = np.hstack([out_of_fold, held[:, None]])
    return Chain(tuple(categories), tuple(links), tuple(thresholds))


def fit_toxicity(documents: DataFrame, labels: DataFrame, categories: Sequence[str], key: str = "doc_id",
                 text: str = "text", max_rows: int = 10_000) -> Chain:
    """A chain from at most `max_rows` labelled documents; `labels` has a 0/1 column per category.

    Only the distinct word buckets of the sampled documents come to the driver.
    """
    known = labels.select(key, *[F.col(c).cast("int").alias(c) for c in categories]).dropna()
    sample = with_texts(sample_labels(known, key, max_rows), documents, key, text)

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        distinct = [np.unique(b) for _, b in word_buckets(batch.column(1))]
        yield {"key": batch.column(0), "buckets": ar.list_column(distinct, pa.int32()),
               "y": ar.list_column([np.array(r) for r in zip(*map(np.array, batch.columns[2:]), strict=True)], pa.int32())}

    kind = dict(documents.dtypes)[key]
    rows = ar.map_arrow(sample.select(key, text, *categories), work,
                        f"key {kind}, buckets array<int>, y array<int>").toArrow().combine_chunks()
    if not rows.num_rows:
        return fit_chain([], np.zeros((0, len(categories))), categories)
    buckets = rows["buckets"].combine_chunks()
    docs = np.split(np.array(buckets.flatten(), dtype=np.int64), np.cumsum(pc.list_value_length(buckets))[:-1])
    targets = np.array(rows["y"].combine_chunks().flatten()).reshape(len(docs), -1)
    keys = rows["key"].to_pylist()
    order = sorted(range(len(docs)), key=lambda i: (keys[i], len(docs[i]), docs[i].sum()))
    return fit_chain([docs[i] for i in order], targets[order], categories)


def score_toxicity(documents: DataFrame, chain: Chain, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, p_<category> per category in chain order) for every row."""
    kind = dict(documents.dtypes)[key]

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        for at in range(0, batch.num_rows, 2048):
            part = batch.slice(at, 2048)
            p = chain.probabilities(part.column(1))
            yield {key: part.column(0)} | {f"p_{c}": p[:, k] for k, c in enumerate(chain.categories)}

    columns = ", ".join(f"p_{c} double" for c in chain.categories)
    return ar.map_arrow(documents.select(key, text), work, f"{key} {kind}, {columns}")
