"""Mixing to target weights over soft memberships.

A classifier fitted on a table of labels gives every document its posterior over domains. With n
tokens and posterior p, a document adds rate * n * p to the expected token totals; rates are the
nonnegative least-squares fit of these totals to the targets, by projected gradient from rate START:
gradients are taken in the metric in which a document weighs its tokens, and rates are projected to 0..most. First
steps whiten residuals by the domains' second moments, which reaches targets within reach at once; where
bounds keep targets out of reach, accelerated steps on the plain residuals follow until the sum of squares
settles. A step needs only sums over all documents, so the driver holds one residual for each step and every
task replays the steps on its rows: no row is moved, nothing grows with the corpus.

A null or empty text has no tokens and the posterior of no words, and changes no total. A null
doc_id is sampled like any other. Repeated rows each have a rate. A key with labels of two domains teaches nothing. Domains without a labelled row, and an
empty table of labels, are an error; an empty table of documents gives no rows. Columns of the input
other than the id are read only through the text.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.common import pieces, texts_of, written
from quern.llm.textclass import WordModel, bounded_sample, fit_on_sample

#: Labelled rows of each domain that the classifier is fitted on.
SAMPLE = 1000
START, STEPS, MORE_STEPS, CLOSE = 1.0, 60, 200, 1e-4
SEED = "mixing"
_LOG = logging.getLogger(__name__)


def fit_domains(docs: DataFrame, labels: DataFrame, label: Column, domains: list[str], sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> WordModel:
    """The domain classifier from at most so many labelled rows of each domain."""
    chosen = bounded_sample(labels, id_col, label, domains, sample)
    if missing := set(domains) - {d for _, d in chosen}:
        raise ValueError(f"no labelled rows for the domains {sorted(missing)}")
    named = labels.groupBy(label.alias("d")).count().filter(F.col("d").isin(domains)).collect()
    total = sum(r["count"] for r in named)
    return fit_on_sample(WordModel(domains), docs, id_col, text_col, chosen, shares={r["d"]: r["count"] / total for r in named})


def memberships(docs: DataFrame, model: WordModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, same, n_tokens, p): words and posterior of every row; same is the hash of its text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for whole in batches:
            for batch in pieces(whole):
                texts = texts_of(batch.column(1))
                p = own.posteriors(texts)
                n = [len(x.encode("utf-8", "surrogatepass").split()) for x in texts]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(n, pa.int64()), pa.array(p.tolist(), pa.list_(pa.float64()))], names=["doc_id", "same", "n_tokens", "p"])

    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("same")).mapInArrow(run, "doc_id long, same long, n_tokens long, p array<double>")


#: A step: the residual's image and the momentum with which it was taken.
Step = tuple[np.ndarray, float]


def _last_two(p: np.ndarray, steps: list[Step], most: float) -> tuple[np.ndarray, np.ndarray]:
    """The rates after all steps, and before the last one."""
    before = r = np.full(len(p), START)
    for g, momentum in steps:
        before, r = r, np.clip(r + momentum * (r - before) - p @ g, 0, most)
    return r, before


def _replay(p: np.ndarray, steps: list[Step], most: float) -> np.ndarray:
    return _last_two(p, steps, most)[0]


def _posteriors(column: pa.Array, k: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), k)


def fit_rates(rows: DataFrame, weights: dict[str, float], domains: list[str], budget: float | None = None, most: float = np.inf) -> tuple[list[Step], np.ndarray, np.ndarray]:
    """The steps that give every row its rate, the totals they reach and the targets (for the domains in order).

    weights: target shares by domain, positive. budget: tokens to reach; default: for unbounded rates
    the corpus's own, else the largest that rates up to most can reach in the domain of the largest
    share, so scarce domains of small shares don't lower it; their targets are at most all they have.
    """
    k = len(domains)
    share = np.array([weights[d] for d in domains], float)
    share /= share.sum()

    def moments(steps: list[Step], momentum: float = 0.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Token totals by domain, those of the point from which a step with momentum starts, and second moments over the rows whose rate can still move."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(2 * k + k * k)
            for b in batches:
                p, n = _posteriors(b.column(1), k), b.column(0).to_numpy().astype(float)
                r, before = _last_two(p, steps, most)
                free = n * ((r > 0) & (r < most) if steps else np.ones(len(r)))
                total += np.r_[(n * r) @ p, (n * (r + momentum * (r - before))) @ p, (p.T @ (p * free[:, None])).ravel()]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int64()), pa.array(total)], names=["at", "x"])

        sums = rows.select("n_tokens", "p").mapInArrow(run, "at long, x double").groupBy("at").agg(F.sum("x").alias("x")).collect()
        flat = np.zeros(2 * k + k * k)
        for r in sums:
            flat[r["at"]] = r["x"]
        return flat[:k], flat[k : 2 * k], flat[2 * k :].reshape(k, k)

    steps: list[Step] = []
    totals, _, second = moments(steps)
    whole, full = second, second / max(1.0, totals.sum())
    if budget is None:
        budget = totals.sum() if np.isinf(most) else float((most * totals / START / share)[share >= share.max() * (1 - 1e-9)].min())
    targets = share * budget if np.isinf(most) else np.minimum(share * budget, most * totals / START)
    scale, close = max(1.0, totals.sum()), CLOSE * max(1.0, budget)
    for _ in range(STEPS):
        if np.abs(totals - targets).max(initial=0) <= close:
            return steps, totals, targets
        white = second / scale + 0.02 * full + 1e-9 * np.eye(k)
        steps.append((np.linalg.solve(white, (totals - targets) / scale), 0.0))
        before = totals
        totals, _, second = moments(steps)
        if np.abs(totals - before).max() <= close:
            break  # rates at their bounds keep the targets out of this metric's reach
    # the plain sum of squares, with momentum that starts anew whenever the sum grows
    size, still, t, ahead, error = 1 / max(1e-9, np.linalg.norm(whole, 2)), 0, 1.0, totals, np.square(totals - targets).sum()
    for _ in range(MORE_STEPS):
        if still == 3 or np.abs(totals - targets).max(initial=0) <= close:
            break
        steps.append((size * (ahead - targets), 0.0 if t == 1.0 else momentum))
        now = (1 + np.sqrt(1 + 4 * t * t)) / 2
        momentum, t = (t - 1) / now, now
        totals, ahead, _ = moments(steps, momentum)
        last, error = error, np.square(totals - targets).sum()
        if error > last:
            t, ahead = 1.0, totals
        still = still + 1 if abs(np.sqrt(last) - np.sqrt(error)) <= close / 10 else 0
    return steps, totals, targets


def mixed(docs: DataFrame, labels: DataFrame, label: Column, weights: dict[str, float], budget: float | None = None, most: float = np.inf, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, same, n_tokens, p, rate, copies) for every row of docs.

    label: a column over labels that names a domain of weights, or null. copies: the rate rounded to a
    whole number, up with the probability of its fraction, by a hash of doc_id and text.
    """
    domains = sorted(weights)
    model = fit_domains(docs, labels, label, domains, id_col=id_col, text_col=text_col)
    rows = written(memberships(docs, model, id_col, text_col), "memberships", texts=True)
    steps, totals, targets = fit_rates(rows, weights, domains, budget, most)
    said = ", ".join(f"{d} {t:.0f} of {g:.0f}" for d, t, g in zip(domains, totals, targets))
    far = np.abs(totals - targets).max(initial=0) > 0.01 * max(1.0, targets.sum())
    _LOG.log(logging.WARNING if far else logging.INFO, "expected tokens of targets after %d steps: %s", len(steps), said)
    k = len(domains)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rate = _replay(_posteriors(b.column(3), k), steps, most)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(rate)], names=["doc_id", "same", "n_tokens", "p", "rate"])

    rated = rows.mapInArrow(run, "doc_id long, same long, n_tokens long, p array<double>, rate double")
    u = F.shiftrightunsigned(F.xxhash64(F.lit(SEED), "doc_id", "same"), 11).cast("double") / F.lit(float(1 << 53))
    return rated.withColumn("copies", (F.floor("rate") + (u < F.col("rate") - F.floor("rate")).cast("int")).cast("long"))
