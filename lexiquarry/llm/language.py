"""Language identification with error-correcting output codes.

Every language has a codeword. One linear classifier over hashed byte n-grams predicts each bit, and
decoding takes the language whose codeword has the smallest weighted logistic loss; bits whose classifier
does badly on the sample weigh less. A prediction is flagged as ambiguous when the runner-up is close.

Defined results: a null text, and one without a letter, is `und` with score 0; a repeated row gets its
result again; without rows to learn from everything is `und`; with one language all lettered texts get it;
an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiquarry.llm import arrays as ar
from lexiquarry.llm.sampling import sample_labels, with_texts

UNKNOWN = "und"
BINS = 2048
EXHAUSTIVE_UP_TO = 5

# Letters stay, every other ASCII byte becomes a space; bytes of longer characters count as letters.
_LETTERS = np.full(256, 0x20, np.uint8)
for _c in (*range(97, 123), *range(128, 256)):
    _LETTERS[_c] = _c
_LETTERS[65:91] = np.arange(97, 123)


def ngram_features(column: pa.Array) -> np.ndarray:
    """Square roots of the shares of hashed byte pairs and triples, one row per text."""
    low = column.cast(pa.large_string())
    data, offsets = ar.text_buffers(pc.utf8_lower(low))
    out = np.zeros((len(offsets) - 1, BINS), np.float32)
    for row in range(len(offsets) - 1):
        counts = np.zeros(BINS, np.int64)
        for at in range(offsets[row], offsets[row + 1], ar.BLOCK_BYTES):  # blocks overlap by two bytes
            b = _LETTERS[data[at:min(at + ar.BLOCK_BYTES + 2, offsets[row + 1])]].astype(np.uint32)
            pair = b[:-1] * np.uint32(0x9E3779B1) + b[1:] * np.uint32(0x85EBCA6B)
            apart = (b[:-1] == 0x20) & (b[1:] == 0x20)
            triple = (pair[:-1] ^ (b[2:] * np.uint32(0xC2B2AE35))) * np.uint32(0x27D4EB2F)
            counts += np.bincount((pair[~apart] * np.uint32(0x27D4EB2F)) >> np.uint32(21), minlength=BINS)
            counts += np.bincount(triple[~apart[:-1] | ~apart[1:]] >> np.uint32(21), minlength=BINS)
        out[row] = np.sqrt(counts / max(counts.sum(), 1))
    return out


def codewords(n: int, seed: int = 0) -> np.ndarray:
    """+1/-1 codewords, one per row: all splits for few languages, else random ones kept far apart."""
    if n < 2:
        return np.ones((n, 1))
    if n <= EXHAUSTIVE_UP_TO:
        splits = np.arange(1, 2 ** (n - 1))
        return np.stack([np.ones(len(splits)), *[1 - 2.0 * ((splits >> i) & 1) for i in range(n - 1)]])
    rng, bits = np.random.default_rng(seed), int(np.ceil(10 * np.log2(n)))
    best, apart = None, -1
    for _ in range(200):
        code = rng.integers(0, 2, (n, bits)) * 2.0 - 1
        code = code[:, abs(code.sum(axis=0)) < n]
        distance = (code.shape[1] - code @ code.T) / 2 + np.eye(n) * bits
        if distance.min() > apart:
            best, apart = code, distance.min()
    return best


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    code: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    trust: np.ndarray
    ambiguity: float = 0.2

    def losses(self, x: np.ndarray) -> np.ndarray:
        """Weighted mean loss of every codeword, one row per text."""
        margin = (x @ self.weights + self.bias)[:, None, :] * self.code[None]
        return (np.logaddexp(0, -margin) * self.trust).sum(axis=2) / self.trust.sum()


def fit_bits(x: np.ndarray, signs: np.ndarray, steps: int = 120, ridge: float = 1e-5) -> tuple[np.ndarray, np.ndarray]:
    """Logistic regressions of all bits at once, by accelerated gradient steps."""
    x1 = np.hstack([x, np.ones((len(x), 1), np.float32)])
    # Rows have length sqrt(2) at most, so the loss has curvature 1/2 at most.
    rate, w = 2.0, np.zeros((x1.shape[1], signs.shape[1]), np.float32)
    ahead, previous = w, w
    for step in range(steps):
        pull = -signs / (1 + np.exp(signs * (x1 @ ahead)))
        w = ahead - rate * 4 * ((x1.T @ pull).astype(np.float32) / len(x1) + ridge * ahead)
        ahead, previous = w + (step / (step + 3)) * (w - previous), w
    return w[:-1], w[-1]


def fit_languages(documents: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
                  max_rows: int = 2400, per_language: int = 600) -> LanguageModel:
    """A model from at most `per_language` rows of each language and `max_rows` in all.

    Rows without language, or whose text has no letter, teach nothing.
    """
    known = documents.select(key, F.col(lang).alias("__lang")).dropna()
    sample = with_texts(sample_labels(known, key, max_rows, "__lang", per_language), documents, key, text)

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            yield {"x": [r.tobytes() for r in ngram_features(part.column(0))], "lang": part.column(1)}

    lettered = sample.where(F.col(text).rlike(r"\p{L}")).select(text, "__lang")
    rows = ar.map_arrow(lettered, work, "x binary, lang string").toArrow().to_pydict()
    if not rows["lang"]:
        return LanguageModel((), codewords(0), np.zeros((BINS, 1)), np.zeros(1), np.ones(1))
    pairs = sorted(zip(rows["lang"], rows["x"], strict=True))
    x = np.frombuffer(b"".join(p[1] for p in pairs), np.float32).reshape(-1, BINS)
    languages = tuple(sorted({p[0] for p in pairs}))
    code = codewords(len(languages))
    signs = code[[languages.index(p[0]) for p in pairs]].astype(np.float32)
    if len(languages) == 1:
        return LanguageModel(languages, code, np.zeros((BINS, 1)), np.ones(1), np.ones(1))
    w, b = fit_bits(x, signs)
    right = ((x @ w + b) * signs > 0).mean(axis=0)
    return LanguageModel(languages, code, w, b, np.maximum(2 * right - 1, 0.05))


def predict_languages(documents: DataFrame, model: LanguageModel, key: str = "doc_id",
                      text: str = "text") -> DataFrame:
    """(key, lang_pred, score, ambiguous) for every row; the score is the share of the nearest codeword."""
    kind = dict(documents.dtypes)[key]
    names = np.array([*model.languages, UNKNOWN], object)

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            texts = part.column(1)
            lettered = np.array(pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False))
            best, score = np.full(len(texts), len(names) - 1), np.zeros(len(texts))
            unsure = np.zeros(len(texts), bool)
            if model.languages:
                loss = model.losses(ngram_features(texts))
                share = np.exp(-loss * model.code.shape[1])
                share /= share.sum(axis=1, keepdims=True)
                order = np.sort(share, axis=1)
                best = np.where(lettered, loss.argmin(axis=1), best)
                score = np.where(lettered, order[:, -1], 0.0)
                if len(model.languages) > 1:
                    unsure = lettered & (order[:, -1] - order[:, -2] < model.ambiguity)
            yield {key: part.column(0), "lang_pred": names[best], "score": score, "ambiguous": unsure}

    return ar.map_arrow(documents.select(key, text), work,
                        f"{key} {kind}, lang_pred string, score double, ambiguous boolean")
