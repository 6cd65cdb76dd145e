"""Token counts of whole texts, huge ones by overlapping chunks that are resynchronised.

A SentencePiece model whose pieces never hold a word-start mark after another character can't join
characters across the start of a word: a space after a character that is neither a space nor the mark
is a boundary in every encoding that sees both characters. Texts beyond CHUNK characters are encoded
as chunks that overlap; two chunks are spliced at such a boundary that both encodings have at the same
offset, and tokens are counted to the left of it in one chunk and to the right in the other. Where the
overlap holds none, it is widened, to the whole chunk and beyond, so the count is always exact. Memory
is bounded by the chunk, not by the text. Models without that property have their texts encoded whole.

A null text is the empty text and has no tokens; repeated rows each have their row; an empty table
gives no rows. Other columns of the input are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import pieces, texts_of

CHUNK, OVERLAP = 16_384, 256
MARK = "▁"
_BOUNDARY = re.compile(f"(?<=[^ {MARK}]) ")


class PieceCounter:
    """Counts the tokens of whole texts; widened: how often an overlap had to grow."""

    def __init__(self, path: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.chunk, self.overlap, self.widened = chunk, overlap, 0
        held = (self.model.id_to_piece(i) for i in range(self.model.get_piece_size()))
        self.splits = not any(MARK in p.lstrip(MARK) for p in held)

    def _starts(self, text: str, at: int, end: int) -> np.ndarray:
        """Offsets in the text at which the tokens of text[at:end] begin, in order."""
        spans = self.model.encode(text[at:end], return_type="offset_mapping")["offsets"]
        return np.fromiter((a for a, _ in spans), np.int64, len(spans)) + at

    def _common(self, text: str, at: int, end: int, left: np.ndarray, right: np.ndarray) -> int | None:
        """The first proven boundary within text[at+1:end] at which tokens of both chunks begin."""
        for m in _BOUNDARY.finditer(text, at + 1, end):
            p = m.start()
            if all(i < len(x) and x[i] == p for x in (left, right) for i in (np.searchsorted(x, p),)):
                return p
        return None

    def _by_chunks(self, text: str) -> int:
        n, total, base, start, end = len(text), 0, 0, 0, self.chunk
        left = self._starts(text, 0, end)
        while end < n:
            overlap = self.overlap
            while True:
                at = max(base, end - overlap)
                stop = min(n, at + max(self.chunk, 2 * overlap))
                right = self._starts(text, at, stop)
                p = self._common(text, at, end, left, right)
                if p is not None:
                    total += int(np.searchsorted(left, p) - np.searchsorted(left, base))
                    left, base, start, end = right, p, at, stop
                    break
                self.widened += 1
                if at == base:  # nothing to splice at since the last boundary: the chunk itself grows
                    end = min(n, end + (end - start) + self.chunk)
                    left = self._starts(text, start, end)
                    break
                overlap *= 2
        return total + len(left) - int(np.searchsorted(left, base))

    def count(self, texts: list[str]) -> list[int]:
        out = [0] * len(texts)
        whole = [i for i, x in enumerate(texts) if len(x) <= self.chunk or not self.splits]
        for i, ids in zip(whole, self.model.encode([texts[i] for i in whole], num_threads=1)):
            out[i] = len(ids)
        for i in set(range(len(texts))).difference(whole):
            out[i] = self._by_chunks(texts[i])
        return out


@lru_cache(maxsize=2)
def counter(path: str) -> PieceCounter:
    return PieceCounter(path)


def token_counts(docs: DataFrame, model: str | None = None, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row. model: a SentencePiece file's path on every machine."""
    path = model or public_tokenizers.path("piece_bpe_32k.model")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces(whole):
                texts = texts_of(batch.column(1))
                n = counter(path).count(texts)
                sizes = [len(x.encode("utf-8")) for x in texts]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
