"""Language ID by Bayesian evidence fusion.

Hashed byte n-grams give each text's likelihood under every language and under none of them (a uniform
model). Three more pieces of evidence are fused with it: the language that the markup declares and the
suffix of the address, each through its probabilities under a language, and the host's prior, smoothed
towards its domain's, which is smoothed towards the whole table's. All three are learned from the
texts' own best languages by grouped aggregations with map-side sums, so a host that holds a third of
all rows costs a row a task; a row's own vote is taken out of its host's and domain's counts.

N-grams overlap and repeat, so their log-likelihood counts TRUST of its value. A text without letters
has no language (und). Nulls in any evidence say nothing; repeated rows each have their row; an empty
table gives no rows. Columns of the input are kept as they are, whatever their names, but for lid_lang,
lid_confidence and lid_accepted, which are the operator's results and replace columns of that name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.common import pieces, texts_of, written
from quern.llm.textclass import GramModel, bounded_sample, fit_on_sample

LANGUAGES = ("de", "en", "es", "fr")
#: Rows of each language that the text model is fitted on.
SAMPLE = 400
TRUST, HOST_WEIGHT, DOMAIN_WEIGHT, EVIDENCE_WEIGHT, LEAST = 0.1, 4.0, 16.0, 1.0, 0.5
#: Tables of votes of so many keys at most are broadcast, so that rows with their texts stay where they are; larger ones are joined by a shuffle.
SMALL = 50_000
RESULTS = ("lid_lang", "lid_confidence", "lid_accepted")
_OWN = ["lid_n", "lid_ll", "lid_best", "lid_declared", "lid_suffix", "lid_host", "lid_domain"]


def host_of(url: Column) -> Column:
    return F.lower(F.nullif(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1), F.lit("")))


def suffix_of(host: Column) -> Column:
    return F.nullif(F.regexp_extract(host, r"\.([a-z]{2,})\.?$", 1), F.lit(""))


def domain_of(host: Column) -> Column:
    return F.nullif(F.regexp_extract(host, r"([^.]+\.[^.]+)\.?$", 1), F.lit(""))


def declared_of(html: Column) -> Column:
    """The two-letter language of the html element's lang attribute."""
    return F.lower(F.nullif(F.regexp_extract(html, r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]{2})", 1), F.lit("")))


def fit_text_model(docs: DataFrame, id_col: str, text_col: str, declared: Column, languages: tuple[str, ...] = LANGUAGES, sample: int = SAMPLE) -> GramModel:
    """A text model from at most so many rows of each declared language."""
    chosen = bounded_sample(docs, id_col, declared, list(languages), sample)
    return fit_on_sample(GramModel(list(languages)), docs, id_col, text_col, chosen)


def _with_likelihoods(docs: DataFrame, model: GramModel, text_col: str) -> DataFrame:
    """docs (the input's columns, lid_declared, lid_host, lid_address, and text unless the input's is kept) with the text's likelihoods and the address's parts, without text and address."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.withColumns({"lid_suffix": suffix_of(F.col("lid_address")), "lid_domain": F.coalesce(domain_of(F.col("lid_address")), F.lit(""))}).drop("lid_address")
    at = kept.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        names = np.array([*own.classes, "und"])
        for whole in batches:
            for batch in pieces(whole, column=text_col):
                texts = texts_of(batch.column(at))
                found = [own.scores(x) for x in texts]
                ll = np.array([s for _, s in found]).reshape(len(found), len(names))
                letters = [any(map(str.isalpha, x)) for x in texts]
                best = [str(names[k]) if ok else "und" for k, ok in zip(ll.argmax(1), letters)]
                more = [pa.array([n if ok else 0 for (n, _), ok in zip(found, letters)], pa.int64()), pa.array(ll.tolist(), pa.list_(pa.float64())), pa.array(best, pa.string())]
                rest = [(c, x) for c, x in zip(batch.schema.names, batch.columns) if c != "text"]
                yield pa.RecordBatch.from_arrays([*(x for _, x in rest), *more], names=[*(c for c, _ in rest), "lid_n", "lid_ll", "lid_best"])

    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema if f.name != "text")
    return kept.mapInArrow(run, f"{out}, lid_n long, lid_ll array<double>, lid_best string")


def _votes(rows: DataFrame, key: str, languages: list[str], name: str) -> DataFrame:
    """For each key the number of rows whose text is best in each language, as an array."""
    sums = [F.sum(F.when(F.col("lid_best") == x, 1).otherwise(0)).cast("double") for x in languages]
    return rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.array(*sums).alias(name))


def identified(docs: DataFrame, model: GramModel, text_col: str = "text", declared: Column | None = None, host: Column | None = None, address: Column | None = None, keep: list[str] | None = None, least: float = LEAST) -> DataFrame:
    """The columns of docs (or those in keep) with lid_lang, lid_confidence and lid_accepted for every row.

    declared, host and address: columns over docs; address is a host name whose suffix and domain count.
    A row is accepted if its best language has a posterior of at least least.
    """
    null = F.lit(None).cast("string")
    declared, host, address = (null if c is None else c for c in (declared, host, address))
    names, kept = model.classes, [c for c in (docs.columns if keep is None else keep) if c not in RESULTS]
    # the input's columns go by place, so that none can clash with the operator's own
    own = docs.select(*[docs[c].alias(f"in_{k}") for k, c in enumerate(kept)], *([] if text_col in kept else [docs[text_col].alias("text")]), F.lower(declared).alias("lid_declared"), F.lower(host).alias("lid_host"), address.alias("lid_address"))
    rows = _with_likelihoods(own, model, f"in_{kept.index(text_col)}" if text_col in kept else "text")
    inputs = [f"in_{k}" for k in range(len(kept))]
    rows = written(rows.select(*inputs, *_OWN), "likelihoods", texts=True)
    total = rows.agg(*[F.sum(F.when(F.col("lid_best") == x, 1).otherwise(0)).alias(f"n{k}") for k, x in enumerate(names)]).first()
    base = [(total[k] or 0) + 1.0 for k in range(len(names))]
    joined = rows
    for key, name in (("lid_host", "lid_h"), ("lid_domain", "lid_d"), ("lid_suffix", "lid_s"), ("lid_declared", "lid_c")):
        votes = written(_votes(rows, key, names, name), "votes")
        joined = joined.join(F.broadcast(votes) if votes.count() <= SMALL else votes, key, "left")
    fused = _fused(names, np.array(base))(F.col("lid_n"), "lid_ll", "lid_best", "lid_h", "lid_d", F.when(F.col("lid_declared").isNotNull(), F.col("lid_c")), F.when(F.col("lid_suffix").isNotNull(), F.col("lid_s")))
    out = joined.select(*inputs, fused.alias("lid_found"))
    lang, confidence = F.col("lid_found.lang"), F.col("lid_found.confidence")
    return out.select(*[F.col(x).alias(c) for x, c in zip(inputs, kept)], lang.alias("lid_lang"), confidence.alias("lid_confidence"), ((lang != "und") & (confidence >= least)).alias("lid_accepted"))


def _fused(names: list[str], base: np.ndarray):
    """The best language and its posterior, from the text's likelihoods and the votes of host, domain, declared language and suffix, batch by batch. base: rows of each language, one more each."""
    k, named = len(names), np.array([*names, "und"])

    def votes(column: pa.Array, own: np.ndarray) -> np.ndarray:
        """Counts without the row's own vote; zeros for null."""
        out, there = np.zeros((len(column), k)), column.is_valid().to_numpy(zero_copy_only=False)
        out[there] = column.drop_null().flatten().to_numpy().reshape(-1, k)
        return np.maximum(out - own, 0)

    def smoothed(counts: np.ndarray, prior: np.ndarray, weight: float) -> np.ndarray:
        return (counts + weight * prior) / (counts.sum(1, keepdims=True) + weight)

    def evidence(column: pa.Array, own: np.ndarray) -> np.ndarray:
        """log P(key | language) up to a constant: counts over the language's rows, smoothed by the key's share of all rows; nothing for null."""
        counts = votes(column, own)
        spread = (counts.sum(1, keepdims=True) + 1) / base.sum()
        logs = np.log((counts + EVIDENCE_WEIGHT * spread) / (base + EVIDENCE_WEIGHT))
        logs[column.is_null().to_numpy(zero_copy_only=False)] = 0
        return logs

    @F.arrow_udf("lang string, confidence double")
    def run(n: pa.Array, ll: pa.Array, best: pa.Array, host: pa.Array, domain: pa.Array, declared: pa.Array, suffix: pa.Array) -> pa.Array:
        own = (np.array(best.to_pylist(), object)[:, None] == np.array(names, object)[None, :]).astype(float).reshape(-1, k)
        prior = smoothed(votes(host, own), smoothed(votes(domain, own), base / base.sum(), DOMAIN_WEIGHT), HOST_WEIGHT)
        meta = np.log(prior) + evidence(declared, own) + evidence(suffix, own)
        # the uniform model has the evidence of the least likely language
        logs = TRUST * ll.flatten().to_numpy().reshape(-1, k + 1) + np.concatenate([meta, meta.min(1, keepdims=True)], 1)
        top = logs.max(1, keepdims=True)
        empty = n.to_numpy() == 0
        lang = np.where(empty, "und", named[logs.argmax(1)])
        confidence = np.where(empty, 0.0, 1 / np.exp(logs - top).sum(1))
        return pa.StructArray.from_arrays([pa.array(lang.tolist(), pa.string()), pa.array(confidence)], names=["lang", "confidence"])

    return run
