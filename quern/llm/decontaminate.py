"""Benchmark decontamination: a BM25 inverted index of test items with block-max WAND, then verification.

The index holds the items' words; items stand in blocks of BLOCK by length, and each word has, for each
block, the largest part that it can add to an item's score there. Scores are BM25 divided by the item's
own threshold: the item's score of itself less its heaviest words, as many as an overlap of SIMILARITY
of its five-word shingles can lose. So every item that could pass verification scores 1 at least, and
one cut-off holds for all. The passage that queries the index is the whole document, so an item is found
however far apart its pieces stand. Words whose parts together can't lift any item to half its threshold
are non-essential: they have no list of blocks. As blocks have the same bounds for all words and the cut-off is fixed, the
pivots are found for all blocks at once: a block is one if the maxima of the essential words held and its largest non-essential rest
reach 1, and all other blocks are skipped unread. In a pivot an item's words are added from the heaviest on, and the item is
left as soon as the words to come can't lift it to 1. Items at 1 or more are verified by the share of question shingles, and of answer
shingles where there is an answer, that the document holds. Nothing is cut short: no limit on
candidates, and none on the length of documents.

Words are runs of letters and digits (ASCII ones in lower case, other characters as they are), so
punctuation and case don't hide a copy. Items without words match nothing; items of fewer than five
words match as a whole. Null texts are empty. Repeated rows each have their row. An empty benchmark
flags nothing; an empty table gives no rows. The benchmark is read by the driver in shards of at most
SHARD bytes of text, one job over the documents each, so what the workers hold at a time is bounded.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import pieces, same_text, written

K1, B = 1.2, 0.75
SHINGLE, SIMILARITY, BLOCK, SHARD = 5, 0.8, 4, 4 << 20
_MAP = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_MAP).split()


def _shingles(seq: tuple[int, ...]) -> set[tuple[int, ...]]:
    return {seq[i : i + SHINGLE] for i in range(len(seq) - SHINGLE + 1)} or ({seq} if seq else set())


class Index:
    """items: (id, question, answer or None)."""

    def __init__(self, items: list[tuple[int, str | None, str | None]]) -> None:
        self.terms: dict[bytes, int] = {}
        self.items = []
        for i, question, answer in items:
            q, a = (tuple(self.terms.setdefault(w, len(self.terms)) for w in words(x)) for x in (question, answer))
            if q:
                self.items.append((i, q, _shingles(q), _shingles(a)))
        self.items.sort(key=lambda x: (len(x[1]), x[0]))
        n, df = len(self.items), Counter(t for x in self.items for t in set(x[1]))
        mean = sum(len(x[1]) for x in self.items) / max(1, n)
        self.parts: list[dict[int, float]] = []  # for each item, what each word adds, as a share of its threshold
        for _, q, shingles, _ in self.items:
            tf = Counter(q)
            part = {t: math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * c * (K1 + 1) / (c + K1 * (1 - B + B * len(q) / mean)) for t, c in tf.items()}
            lost = math.floor((1 - SIMILARITY) * len(shingles) + 1e-9)
            least = sum(sorted(part.values())[: max(1, len(part) - lost)]) * (1 - 1e-9)
            self.parts.append({t: p / least for t, p in part.items()})
        self.blocks = [range(s, min(n, s + BLOCK)) for s in range(0, n, BLOCK)]
        self._essential(df)
        self._block_maxima()
        self.total = [sum(part.values()) for part in self.parts]
        self.heavy = [sorted(part.items(), key=lambda x: -x[1]) for part in self.parts]

    def _essential(self, df: Counter) -> None:
        """Frequent words first, words stay non-essential while no item can reach half its threshold by them alone."""
        holders = defaultdict(list)
        for k, part in enumerate(self.parts):
            for t in part:
                holders[t].append(k)
        rest, self.free = [0.0] * len(self.parts), set()
        for t in sorted(df, key=lambda t: (-df[t], t)):
            if all(rest[k] + self.parts[k][t] <= 0.5 for k in holders[t]):
                self.free.add(t)
                for k in holders[t]:
                    rest[k] += self.parts[k][t]
        self.rest = rest

    def _block_maxima(self) -> None:
        """Postings of essential words as arrays: for word t, blocks at[t]:at[t+1] and their maxima."""
        most: dict[int, dict[int, float]] = defaultdict(dict)
        for b, block in enumerate(self.blocks):
            for k in block:
                for t, p in self.parts[k].items():
                    if t not in self.free:
                        most[t][b] = max(most[t].get(b, 0.0), p)
        sizes = [len(most[t]) if t in most else 0 for t in range(len(self.terms))]
        self.at = np.cumsum([0, *sizes])
        self.block_of = np.array([b for t in range(len(self.terms)) for b in sorted(most.get(t, ()))], np.int64)
        self.maxima = np.array([most[t][b] for t in range(len(self.terms)) for b in sorted(most.get(t, ()))])
        self.need = np.array([1 - max(self.rest[k] for k in block) for block in self.blocks])

    def lookup(self, text: str | None) -> np.ndarray:
        w = words(text)
        return np.fromiter(map(self.terms.get, w, (-1,) * len(w)), np.int64, len(w))

    def pivots(self, held: np.ndarray) -> list[int]:
        """The blocks in which block maxima of the words held (ascending, each once) allow an item to reach its threshold."""
        times = self.at[held + 1] - self.at[held]
        total = int(times.sum())
        entry = np.repeat(self.at[held] - np.cumsum(times) + times, times) + np.arange(total)
        most = np.bincount(self.block_of[entry], self.maxima[entry], len(self.blocks)) if total else np.zeros(len(self.blocks))
        return np.flatnonzero(most >= self.need - 1e-9).tolist()

    def reaches(self, k: int, held: set[int]) -> bool:
        """Whether item k scores 1 at least over the words held."""
        score, rest = 0.0, self.total[k]
        for t, part in self.heavy[k]:
            rest -= part
            if t in held:
                score += part
                if score >= 1:
                    return True
            elif score + rest < 1 - 1e-9:
                return False
        return score >= 1 - 1e-9

    def matches(self, text: str | None) -> list[int]:
        """Ids of the items whose question, and answer if any, the text holds, ascending."""
        tids = self.lookup(text)
        once = np.unique(tids[tids >= 0])
        held, found, runs = set(once.tolist()), set(), {}

        def share(own: set[tuple[int, ...]]) -> float:
            size = len(next(iter(own)))
            if size not in runs:  # only runs of known words can be an item's
                known = np.flatnonzero(np.convolve(tids >= 0, np.ones(size, int), "valid") == size) if len(tids) >= size else ()
                runs[size] = set(map(tuple, tids[np.asarray(known, np.int64)[:, None] + np.arange(size)].tolist()))
            return len(own & runs[size]) / len(own)

        for b in self.pivots(once):
            for k in self.blocks[b]:
                i, _, own, answer = self.items[k]
                if i not in found and self.reaches(k, held) and share(own) >= SIMILARITY - 1e-9 and (not answer or share(answer) >= SIMILARITY - 1e-9):
                    found.add(i)
        return sorted(found)


def _shards(items: DataFrame, id_col: str, question_col: str, answer_col: str | None) -> Iterator[list[tuple[int, str | None, str | None]]]:
    """The benchmark in shards of bounded size, read one partition at a time."""
    rows = items.select(F.col(id_col).cast("long"), F.col(question_col).cast("string"), F.col(answer_col).cast("string") if answer_col else F.lit(None).cast("string"))
    shard, size = [], 0
    for r in rows.toLocalIterator():
        n = len(r[1] or "") + len(r[2] or "") + 100
        if shard and size + n > SHARD:
            yield shard
            shard, size = [], 0
        shard.append((r[0], r[1], r[2]))
        size += n
    yield shard


def contaminated_rows(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", question_col: str = "text", answer_col: str | None = None) -> DataFrame:
    """(doc_id, same, item_ids) for every row of docs: same is the hash of its text, item_ids ascend."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), same_text(text_col).alias("same"), F.col(text_col).cast("string").alias("text"))

    def queried(index: Broadcast) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for batch in pieces(whole):
                    found = [index.value.matches(x) for x in batch.column(2).to_pylist()]
                    yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int64()))], names=["doc_id", "same", "item_ids"])

        return rows.mapInArrow(run, "doc_id long, same long, item_ids array<long>")

    shards = _shards(items, item_id, question_col, answer_col)
    shard, parts = next(shards), []
    for following in chain(shards, [None]):
        index = spark.sparkContext.broadcast(Index(shard))
        if following is None and not parts:
            return queried(index)
        parts.append(written(queried(index), "shard", texts=True))  # one index at a time is held
        index.unpersist()
        shard = following
    # every shard gives each row once; rows of one id and text match the same items
    found = reduce(DataFrame.unionAll, parts)
    items_of = found.select("doc_id", "same", F.explode("item_ids").alias("item")).groupBy("doc_id", "same").agg(F.sort_array(F.collect_set("item")).alias("found"))
    times = found.groupBy("doc_id", "same").agg((F.count("*") / len(parts)).cast("long").alias("times"))
    match = times["doc_id"].eqNullSafe(items_of["doc_id"]) & (times["same"] == items_of["same"])
    both = times.join(items_of, match, "left").select(times["doc_id"], times["same"], "times", F.coalesce("found", F.expr("cast(array() as array<bigint>)")).alias("item_ids"))
    return both.withColumn("time", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times")))).select("doc_id", "same", "item_ids")


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", question_col: str = "text", answer_col: str | None = None) -> DataFrame:
    """(doc_id, contaminated, n_items, item_ids) for every row of docs; item_ids ascending."""
    out = contaminated_rows(docs, items, id_col, text_col, item_id, question_col, answer_col)
    return out.select("doc_id", (F.size("item_ids") > 0).alias("contaminated"), F.size("item_ids").cast("long").alias("n_items"), "item_ids")
