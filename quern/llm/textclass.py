"""Text classifiers with tables of fixed size, fitted on a bounded sample: byte n-grams by naive Bayes, words by logistic regression."""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


class GramModel:
    """Log-probabilities of hashed byte n-grams under each class; class len(classes) is uniform: text of none of them."""

    def __init__(self, classes: list[str], orders: tuple[int, ...] = (3, 4), bits: int = 16, smooth: float = 0.5) -> None:
        self.classes, self.orders, self.bits, self.smooth = list(classes), orders, bits, smooth
        self.counts = np.zeros((len(self.classes), len(orders) << bits))
        self.rows = np.zeros(len(self.classes))
        self.table = np.zeros((len(orders) << bits, len(self.classes)), np.float32)

    def grams(self, text: str | None) -> np.ndarray:
        """Table rows of all n-grams of the text between spaces, ASCII in lower case, digits as one."""
        raw = b" " + b" ".join((text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()) + b" "
        b = np.frombuffer(raw, np.uint8).astype(np.uint32)
        b = np.where((b >= 48) & (b <= 57), np.uint32(48), b)
        out = []
        for k, n in enumerate(self.orders):
            if len(b) >= n:
                h = b[: len(b) - n + 1].copy()
                for i in range(1, n):
                    h = h * np.uint32(0x01000193) + b[i : len(b) - n + 1 + i]
                out.append(((h * np.uint32(0x9E3779B1)) >> np.uint32(32 - self.bits)).astype(np.int64) + (k << self.bits))
        return np.concatenate(out) if out and len(raw) > 2 else np.empty(0, np.int64)

    def learn(self, texts: list[str | None], classes: list[str]) -> None:
        for text, name in zip(texts, classes):
            k = self.classes.index(name)
            self.counts[k] += np.bincount(self.grams(text), minlength=self.counts.shape[1])
            self.rows[k] += 1

    def fitted(self) -> "GramModel":
        size = 1 << self.bits
        for k in range(len(self.orders)):
            own = self.counts[:, k * size : (k + 1) * size] + self.smooth
            self.table[k * size : (k + 1) * size] = np.log(own / own.sum(1, keepdims=True)).T
        self.counts = np.zeros((0, 0))
        return self

    def scores(self, text: str | None) -> tuple[int, np.ndarray]:
        """The number of n-grams and the log-likelihood under each class and the uniform one."""
        g = self.grams(text)
        known = self.table[g].sum(0, dtype=np.float64) if len(g) else np.zeros(len(self.classes))
        return len(g), np.r_[known, -len(g) * self.bits * np.log(2)]


def bounded_sample(rows: DataFrame, key: str, label: Column, classes: list[str], most: int) -> list[tuple[int, str]]:
    """At most so many (key, class) of each class, those with the least hashes of the key: the same at every partitioning. A key that has two labels is left out."""
    out: list[tuple[int, str]] = []
    narrow = rows.select(F.col(key).cast("long").alias("key"), label.alias("label")).filter("key is not null and label is not null")
    narrow = narrow.groupBy("key").agg(F.min("label").alias("label"), F.max("label").alias("other")).filter("label = other")
    for name in classes:
        own = narrow.filter(F.col("label") == name).select("key").orderBy(F.xxhash64("key"), "key").limit(most)
        out += [(r["key"], name) for r in own.collect()]
    return out


def fit_on_sample(model, docs: DataFrame, key: str, text_col: str, sample: list[tuple[int, str]], **options):
    """Fits a model on the texts of a bounded sample; they are read on the driver one partition at a time."""
    labels = dict(sample)
    ids = docs.sparkSession.createDataFrame([(k,) for k in labels], "__key long")
    rows = docs.select(F.col(key).cast("long").alias("__key"), F.col(text_col).cast("string").alias("text"))
    own = rows.join(F.broadcast(ids), "__key", "left_semi")  # no larger than the sample
    for r in own.toLocalIterator():
        model.learn([r["text"]], [labels[r["__key"]]])
    return model.fitted(**options)


_WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


class WordModel:
    """Multinomial logistic regression on which hashed words a text holds; the size of its table is fixed."""

    def __init__(self, classes: list[str], bits: int = 16, ridge: float = 1e-4, rounds: int = 150) -> None:
        self.classes, self.bits, self.ridge, self.rounds = list(classes), bits, ridge, rounds
        self.weights = np.zeros((1 << bits, len(classes)))
        self.bias = np.zeros(len(classes))
        self.rows = np.zeros(len(classes))
        self._held: list[tuple[np.ndarray, int]] = []

    def features(self, text: str | None) -> np.ndarray:
        mask, crc = (1 << self.bits) - 1, zlib.crc32
        return np.fromiter({crc(w) & mask for w in (text or "").encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()}, np.int64)

    def learn(self, texts: list[str | None], classes: list[str]) -> None:
        for text, name in zip(texts, classes):
            self._held.append((np.sort(self.features(text)), self.classes.index(name)))
            self.rows[self.classes.index(name)] += 1

    def _logits(self, at: np.ndarray, row: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        scale = 1 / np.sqrt(np.maximum(sizes, 1))
        sums = np.stack([np.bincount(row, self.weights[at, k], len(sizes)) for k in range(len(self.classes))], axis=1)
        return sums * scale[:, None] + self.bias

    def fitted(self, shares: dict[str, float] | None = None) -> "WordModel":
        """Gradient steps with per-weight rates; shares: the classes' shares where the model is used, if the sample has others."""
        held, self._held = sorted(self._held, key=lambda x: (x[1], len(x[0]), x[0].tobytes())), []
        if held:
            sizes = np.array([len(f) for f, _ in held])
            at, row, y = np.concatenate([f for f, _ in held]), np.repeat(np.arange(len(held)), sizes), np.array([k for _, k in held])
            scale = 1 / np.sqrt(np.maximum(sizes, 1))
            weight = (1 / np.maximum(self.rows, 1))[y] / len(self.classes)
            squares, wide = np.full_like(self.weights, 1e-8), np.full_like(self.bias, 1e-8)
            for _ in range(self.rounds):
                p = _softmax(self._logits(at, row, sizes))
                p[np.arange(len(y)), y] -= 1
                p *= weight[:, None]
                grad = np.stack([np.bincount(at, (p[:, k] * scale)[row], len(self.weights)) for k in range(len(self.classes))], axis=1) + self.ridge * self.weights
                squares += grad**2
                wide += (g := p.sum(0)) ** 2
                self.weights -= 0.5 * grad / np.sqrt(squares)
                self.bias -= 0.1 * g / np.sqrt(wide)
        if shares:
            self.bias = self.bias + np.log([max(shares.get(c, 0.0), 1e-6) for c in self.classes])
        self.weights = self.weights.astype(np.float32)
        return self

    def posteriors(self, texts: list[str | None]) -> np.ndarray:
        own = [self.features(x) for x in texts]
        sizes = np.array([len(f) for f in own], np.int64)
        return _softmax(self._logits(np.concatenate([np.empty(0, np.int64), *own]), np.repeat(np.arange(len(own)), sizes), sizes))


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)
