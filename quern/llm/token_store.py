"""Content-addressed store of token ids.

Documents are encoded once. A rolling hash over the ids cuts each document's stream where its
content says so, so equal passages give equal chunks wherever they stand. A chunk's address is the
BLAKE2b of its bytes; each address is stored once. A document is a recipe: its chunks' addresses and
lengths, in range partitions by ascending doc_id, with the place where its ids start. The manifest is a
Merkle tree over recipes (256 children a node) with one root a partition, and reading checks it.

A store is a folder: chunks/ (hash, n, payload), recipes/ (pid, idx, doc_id, start_in_part, n_tokens,
hashes, lens), manifest/ (pid, n_docs, n_tokens, root). Ids are little-endian, two bytes each where the
vocabulary allows, else four.

A null text is the empty text (only the end id); a null doc_id sorts first; rows that repeat a doc_id
are kept, in the order of their chunks' addresses; an empty table gives an empty store. Other columns
of the input are not read.
"""

from __future__ import annotations

import hashlib
import os
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from operator import attrgetter, sub

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm.common import pieces, scratch_path, write_kinds

FANOUT = 256
WINDOW, MEAN, LEAST, MOST = 8, 256, 64, 1024
_LETTERS, _MARKS = "[A-Za-zªµºÀ-ÖØ-öø-ɏ]+", r"[!-&(-/:-@\[-`{-~]*"
TOGETHER = 256  # words whose tokens the library's model gives at a time: few, so that they stay in the processor's cache
_id = attrgetter("id")
#: Latin letters, then ASCII marks but the apostrophe; perhaps a line break and the same again. The pre-tokenizer cuts between these parts.
_SIMPLE = rf"\A(?P<word>{_LETTERS})(?P<tail>{_MARKS})(?P<line>\n?)(?P<after>(?:{_LETTERS})?)(?P<last>{_MARKS})\z"
_WORD = rf"\A{_LETTERS}\z"
#: The byte-level alphabet: printable bytes stand for themselves, the others for characters from 256 on.
_BYTES = np.arange(256, dtype="<u4")
_BYTES[[b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255)]] = 256 + np.arange(68)
_BYTES[32] = 32


def _ragged(pool: np.ndarray, first: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The runs of pool that start at first and have so many ids each, one after the other."""
    ends = np.cumsum(lens, dtype=np.int32)
    return pool[np.repeat((first - ends + lens).astype(np.int32), lens) + np.arange(int(ends[-1]) if len(ends) else 0, dtype=np.int32)]


class Encoder:
    """The tokenizers library over whole texts, with the ids of space-separated segments kept between calls.

    The vocabulary's pre-tokenizer always cuts between a non-space, one space and a non-space, so ids
    of "a b" are those of "a" and of " b". Texts in which white space touches a space are encoded whole.
    Arrow splits texts, finds their distinct segments and looks them up among those kept; the library
    sees a segment once, as long as it is kept: beyond KEPT segments, those used longest ago are
    dropped. What is kept stands in arrays, so a segment takes some thirty bytes.
    """

    KEPT = 400_000

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.opens = np.zeros(size, bool)
        for token, i in self.tokenizer.get_vocab(with_added_tokens=True).items():
            self.opens[i] = token.startswith("Ġ")  # the byte-level alphabet's space
        self.marks = {"": b""}
        self.batch = 0
        self.segments = pa.array([], pa.string())
        self.pool, self.lens, self.used = np.empty(0, self.dtype), np.empty(0, np.int32), np.empty(0, np.int32)

    def plain(self, texts: list[str]) -> list[bytes]:
        return [np.array(x.ids, self.dtype).tobytes() for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, segments: pa.StringArray) -> np.ndarray:
        """Keeps the ids of " " + segment for each new segment, none where it doesn't stand alone; returns the order in which they are kept.

        A run of Latin letters is one pre-token with the space before it, marks after it are another, and
        so are a line break and what follows it, so words go to the library's model directly and are
        shared by the segments that hold them. Segments of letters alone, most of all, come first: they are
        distinct and not kept, so they need no look-up, and are found for the others.
        """
        alone = pa.compute.match_substring_regex(segments, _WORD)
        words = np.flatnonzero(alone.to_numpy(zero_copy_only=False))
        if len(words):
            part = segments.take(pa.array(words))
            pool, lens = self._encoded_words(part, "Ġ")
            self._keep(part, pool, lens)
        others = np.flatnonzero(~alone.to_numpy(zero_copy_only=False))
        return np.concatenate([words, others[self._learn_others(segments.take(pa.array(others)))]])

    def _keep(self, segments: pa.StringArray, pool: np.ndarray, lens: np.ndarray) -> None:
        self.pool, self.lens = np.concatenate([self.pool, pool]), np.concatenate([self.lens, lens.astype(np.int32)])
        self.segments = pa.concat_arrays([self.segments, segments])
        self.used = np.concatenate([self.used, np.full(len(lens), self.batch, np.int32)])

    def _encoded_words(self, words: pa.StringArray, before: str) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words one after the other, as the library's model gives them, and how many are each word's."""
        tokenize, flat, lens = self.tokenizer.model.tokenize, [np.empty(0, self.dtype)], [np.empty(0, np.int32)]
        for a in range(0, len(words), TOGETHER):
            part = words.slice(a, TOGETHER)
            names = part.to_pylist()
            if not pa.compute.all(pa.compute.string_is_ascii(part)).as_py():
                raw = np.frombuffer(" ".join(names).encode("utf-8"), np.uint8)
                names = _BYTES[raw].tobytes().decode("utf-32-le").split(" ")
            found = list(map(tokenize, [before + x if x else "" for x in names]))
            lens.append(np.fromiter(map(len, found), np.int32, len(found)))
            flat.append(np.fromiter(map(_id, chain.from_iterable(found)), self.dtype, int(lens[-1].sum())))
        return np.concatenate(flat), np.concatenate(lens)

    def _learn_others(self, segments: pa.StringArray) -> np.ndarray:
        parts = pa.compute.extract_regex(segments, _SIMPLE)
        fits = parts.is_valid()
        if len(segments):  # a second word stands after a line break and nowhere else
            line, after = parts.field("line"), parts.field("after")
            fits = pa.compute.and_(fits, pa.compute.equal(pa.compute.equal(line, ""), pa.compute.equal(after, "")).fill_null(False))
        fits = fits.to_numpy(zero_copy_only=False)
        simple, other = np.flatnonzero(fits), np.flatnonzero(~fits)
        runs = [self._cut(parts.field(k).take(pa.array(simple)), k) for k in ("word", "tail", "line", "after", "last")]
        starts = np.cumsum([0, *(len(pool) for pool, _, _ in runs)])
        pool = np.concatenate([pool for pool, _, _ in runs])
        lens = np.stack([lens[at] for _, lens, at in runs], 1)
        first = np.stack([(np.cumsum(lens) - lens)[at] + start for (_, lens, at), start in zip(runs, starts)], 1)
        rest = self._whole(segments.take(pa.array(other)).to_pylist())
        more = np.fromiter(map(len, rest), np.int32, len(rest)) // self.dtype.itemsize
        order = np.concatenate([simple, other])
        self._keep(segments.take(pa.array(order)), np.concatenate([_ragged(pool, first.ravel(), lens.ravel()), np.frombuffer(b"".join(rest), self.dtype)]), np.concatenate([lens.sum(1), more]))
        return order

    def _cut(self, column: pa.StringArray, part: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of a column's distinct values, how many each has, and which value stands in each row."""
        coded = column.dictionary_encode()
        at = coded.indices.to_numpy()
        if part not in ("word", "after"):
            if len(self.marks) > 10_000:
                self.marks = {"": b""}
            values = coded.dictionary.to_pylist()
            if new := [x for x in values if x not in self.marks]:
                self.marks.update(zip(new, self.plain(new)))
            found = [self.marks[x] for x in values]
            return np.frombuffer(b"".join(found), self.dtype), np.fromiter(map(len, found), np.int32, len(found)) // self.dtype.itemsize, at
        lens, first = np.zeros(len(coded.dictionary), np.int32), np.zeros(len(coded.dictionary), np.int64)
        place = np.full(len(lens), -1)
        if part == "word" and len(self.lens):  # a word that is kept as a segment
            place = pa.compute.index_in(coded.dictionary, self.segments).fill_null(-1).to_numpy()
            held = np.flatnonzero(place >= 0)
            lens[held], first[held] = self.lens[place[held]], (np.cumsum(self.lens) - self.lens)[place[held]]
        new = np.flatnonzero(place < 0)
        pool, lens[new] = self._encoded_words(coded.dictionary.take(pa.array(new)), "Ġ" if part == "word" else "")
        first[new] = len(self.pool) + np.cumsum(lens[new]) - lens[new]
        return _ragged(np.concatenate([self.pool, pool]), first, lens), lens, at

    def _whole(self, segments: list[str]) -> list[bytes]:
        """The ids of " " + segment by the library's whole encoding; none where white space stands at an end."""
        found = dict.fromkeys(segments, b"")
        general = [s for s in segments if s and not s[0].isspace() and not s[-1].isspace()]
        for i in range(0, len(general), 2000):
            part = general[i : i + 2000]
            ids = np.array(self.tokenizer.encode_batch_fast([" " + " ".join(part)], add_special_tokens=False)[0].ids, self.dtype)
            cuts = np.flatnonzero(self.opens[ids])
            if len(cuts) == len(part):
                raw, size = ids.tobytes(), self.dtype.itemsize
                at = [*(cuts * size).tolist(), len(raw)]
                found.update(zip(part, (raw[a:b] for a, b in zip(at, at[1:]))))
            else:
                found.update(zip(part, self.plain([" " + s for s in part])))
        return [found[s] for s in segments]

    def _forget(self) -> None:
        """Drops the segments used longest ago if there are more than KEPT, to half of it."""
        if len(self.used) > self.KEPT:
            keep = np.sort(np.argsort(-self.used, kind="stable")[: self.KEPT // 2])
            held = np.zeros(len(self.used), bool)
            held[keep] = True
            self.pool = self.pool[np.repeat(held, self.lens)]
            self.segments, self.lens, self.used = self.segments.take(pa.array(keep)), self.lens[keep], self.used[keep]

    def _places(self, segments: pa.StringArray) -> np.ndarray:
        """Where each of the distinct segments is kept."""
        self.batch += 1
        self._forget()
        place = pa.compute.index_in(segments, self.segments)
        found = place.fill_null(-1).to_numpy().astype(np.int32)
        new = np.flatnonzero(found < 0)
        self.used[found[found >= 0]] = self.batch
        if len(new):
            before = len(self.used)
            order = self._learn(segments.take(pa.array(new)))
            found[new[order]] = before + np.arange(len(new))
        return found

    def encode(self, texts: pa.Array, end: bytes = b"", rows: int = 1000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The ids of whole texts in turn, as many texts at a time as rows says: all ids, and how many are each text's. Null is the empty text; end follows each text."""
        texts = texts.fill_null("")
        split = pa.compute.split_pattern(texts, " ")
        starts = split.offsets.to_numpy().astype(np.int64) - split.offsets[0].as_py()
        coded = split.flatten().dictionary_encode()
        at = coded.indices.to_numpy()
        heads = coded.dictionary.take(pa.array(at[starts[:-1]])).to_pylist()
        place = self._places(coded.dictionary)
        kept = len(self.lens)
        at = place[at]
        at[starts[:-1]] = kept + np.arange(len(heads))
        more = [*self.plain(heads), end]
        lens = np.concatenate([self.lens, np.fromiter(map(len, more), np.int32, len(more)) // self.dtype.itemsize])
        pool, first = np.concatenate([self.pool, np.frombuffer(b"".join(more), self.dtype)]), (np.cumsum(lens) - lens).astype(np.int32)
        bad = lens == 0
        bad[-1] = False
        bad[kept:-1] = [not h or h[-1].isspace() for h in heads]
        any_bad = bad[place].any() or bad[kept:].any()
        for a in range(0, len(heads), rows):
            own = starts[a : a + rows + 1]
            here, inner = np.insert(at[own[0] : own[-1]], own[1:] - own[0], len(lens) - 1), own - own[0] + np.arange(len(own))
            times = lens[here]
            ids = _ragged(pool, first[here], times)
            sizes = np.add.reduceat(times, inner[:-1]).astype(np.int64)
            whole = np.logical_or.reduceat(bad[here], inner[:-1]) & (np.diff(inner) > 2) if any_bad else np.zeros(1, bool)
            if whole.any():
                parts = np.split(ids, np.cumsum(sizes)[:-1])
                for k in np.flatnonzero(whole).tolist():
                    parts[k] = np.frombuffer(self.plain([texts[a + k].as_py()])[0] + end, self.dtype)
                ids, sizes = np.concatenate(parts), np.array([len(p) for p in parts])
            yield ids, sizes


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


@lru_cache(maxsize=1)
def _gear() -> np.ndarray:
    return np.random.default_rng(20240501).integers(0, 1 << 63, 1 << 16, np.uint64)


def cut_points(ids: np.ndarray, sizes: np.ndarray) -> list[list[int]]:
    """For each of the streams that stand in ids one after the other, the ends of its chunks.

    A chunk ends where the rolling hash of the last WINDOW ids has its low bits zero, LEAST to MOST ids
    apart. As LEAST is more than WINDOW, no hash that decides a cut reaches into the stream before.
    """
    g = _gear()[ids & 0xFFFF]
    h = np.zeros(len(ids), np.uint64)
    for k in range(min(WINDOW, len(ids))):
        h[k:] += g[: len(ids) - k] << np.uint64(k)
    marks = np.flatnonzero((h >> np.uint64(40)) % MEAN == 0) + 1
    stops = np.cumsum(sizes)
    lows = np.searchsorted(marks, stops - sizes, "right").tolist()
    highs = np.searchsorted(marks, stops, "left").tolist()
    marks, out = marks.tolist(), []
    for n, stop, low, high in zip(sizes.tolist(), stops.tolist(), lows, highs):
        start = base = stop - n
        ends = []
        for c in marks[low:high]:
            while c - start > MOST:
                start += MOST
                ends.append(start - base)
            if c - start >= LEAST:
                start = c
                ends.append(c - base)
        while stop - start > MOST:
            start += MOST
            ends.append(start - base)
        if stop > start:
            ends.append(n)
        out.append(ends)
    return out


def address(payload: bytes) -> bytes:
    return hashlib.blake2b(payload, digest_size=16).digest()


def _encoded(docs: DataFrame, id_col: str, text_col: str, path: str, end_id: int) -> DataFrame:
    """Rows of two kinds: documents with their recipes, and chunks, each once a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        size, end = own.dtype.itemsize, np.array([end_id], own.dtype).tobytes()
        for whole in batches:
            chunks: dict[bytes, bytes] = {}
            for batch in pieces(whole, rows=16_384, size=12 << 20):
                n, hashes, lens = [], [], []
                for ids, sizes in own.encode(batch.column(1), end):
                    raw, start = ids.tobytes(), 0
                    for count, ends in zip(sizes.tolist(), cut_points(ids, sizes)):
                        parts = [raw[(start + a) * size : (start + b) * size] for a, b in zip([0, *ends], ends)]
                        at = [address(p) for p in parts]
                        chunks.update(zip(at, parts))
                        n.append(count), hashes.append(b"".join(at)), lens.append(array("I", map(sub, ends, [0, *ends])).tobytes())
                        start += count
                k = batch.num_rows
                yield pa.RecordBatch.from_arrays([pa.array(["doc"] * k), batch.column(0), pa.array(n, pa.int64()), pa.array(hashes, pa.binary()), pa.array(lens, pa.binary())], names=["kind", "doc_id", "n_tokens", "hashes", "body"])
                if sum(map(len, chunks.values())) > 4 << 20:
                    yield _chunk_rows(chunks, size)
                    chunks = {}
            if chunks:
                yield _chunk_rows(chunks, size)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "kind string, doc_id long, n_tokens long, hashes binary, body binary")


def _chunk_rows(chunks: dict[bytes, bytes], size: int) -> pa.RecordBatch:
    k = len(chunks)
    return pa.RecordBatch.from_arrays([pa.array(["chunk"] * k), pa.nulls(k, pa.int64()), pa.array([len(x) // size for x in chunks.values()], pa.int64()), pa.array(list(chunks), pa.binary()), pa.array(list(chunks.values()), pa.binary())], names=["kind", "doc_id", "n_tokens", "hashes", "body"])


def _once(chunks: DataFrame) -> DataFrame:
    """Each chunk once. A chunk's address gives all its columns, so whole rows are compared: that needs no sort, as a first payload by address would."""
    return chunks.distinct()


def merkle_roots(leaves: DataFrame) -> DataFrame:
    """(pid, n_docs, n_tokens, root) from (pid, idx, n_tokens, leaf): SHA-256 over the leaves in order, FANOUT children a node, level by level.

    Each level is a grouped aggregation over groups of at most FANOUT; the number of levels is fixed
    for up to FANOUT^4 documents a partition.
    """
    level = leaves.select("pid", "idx", F.lit(1).cast("long").alias("n_docs"), "n_tokens", "leaf")
    for _ in range(4):
        node = F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("idx", "leaf"))), lambda x: x["leaf"]), ""), 256)
        level = level.groupBy("pid", F.expr(f"idx div {FANOUT}").alias("idx")).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"), node.alias("leaf"))
    whole = F.when(F.col("idx") > 0, F.raise_error(F.lit("a partition has too many documents for the tree"))).otherwise(F.col("leaf"))
    return level.select("pid", "n_docs", "n_tokens", whole.alias("root"))


def _leaf() -> Column:
    return F.sha2(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"), F.lit(b"\0"), "hashes", "lens"), 256).alias("leaf")


def write_store(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encodes every whole text, appends end_id, and writes the store to path.

    tokenizer: the path of a tokenizers file on every machine; default: the byte-level BPE of 50k.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    stage = scratch_path(spark, "encoded")
    write_kinds(_encoded(docs, id_col, text_col, tokenizer or public_tokenizers.path("byte_bpe_50k.json"), end_id), stage)
    rows = spark.read.schema("doc_id long, n_tokens long, hashes binary, body binary, kind string").parquet(stage)
    chunks = rows.filter("kind = 'chunk'").select(F.col("hashes").alias("hash"), F.col("n_tokens").alias("n"), F.col("body").alias("payload"))
    _once(chunks).write.option("compression", "zstd").parquet(f"{path}/chunks")
    recipes = rows.filter("kind = 'doc'").select("doc_id", "n_tokens", "hashes", F.col("body").alias("lens"))
    ordered = recipes.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "hashes").withColumn("pid", F.spark_partition_id())

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = tokens = 0
        for b in batches:
            n = b.column(1).to_numpy()
            start = tokens + np.cumsum(n) - n
            yield pa.RecordBatch.from_arrays([b.column(4), pa.array(np.arange(rows, rows + len(n))), b.column(0), pa.array(start), *b.columns[1:4]], names=["pid", "idx", "doc_id", "start_in_part", "n_tokens", "hashes", "lens"])
            rows, tokens = rows + len(n), tokens + int(n.sum())

    ordered.mapInArrow(number, "pid int, idx long, doc_id long, start_in_part long, n_tokens long, hashes binary, lens binary").write.option("compression", "zstd").parquet(f"{path}/recipes")
    merkle_roots(_recipes(spark, path).select("pid", "idx", "n_tokens", _leaf())).write.parquet(f"{path}/manifest")


def _recipes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("pid int, idx long, doc_id long, start_in_part long, n_tokens long, hashes binary, lens binary").parquet(f"{path}/recipes")


def _chunks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("hash binary, n long, payload binary").parquet(f"{path}/chunks")


def verify_manifest(spark: SparkSession, path: str) -> list[tuple[int, int]]:
    """(pid, n_tokens) of each partition in order; raises ValueError where recipes don't give the manifest's roots. Reads a row a partition."""
    said = {r["pid"]: r for r in spark.read.schema("pid int, n_docs long, n_tokens long, root string").parquet(f"{path}/manifest").collect()}
    found = {r["pid"]: r for r in merkle_roots(_recipes(spark, path).select("pid", "idx", "n_tokens", _leaf())).collect()}
    wrong = sorted(p for p in said.keys() | found.keys() if said.get(p) != found.get(p))
    if wrong:
        raise ValueError(f"recipes of {len(wrong)} partitions don't match the manifest, first {wrong[0]}")
    return [(p, said[p]["n_tokens"]) for p in sorted(said)]


@lru_cache(maxsize=1)
def _crc_shifts() -> np.ndarray:
    """shifts[k][b][x]: what byte b of a CRC-32, of value x, becomes after 2^k ids of four zero bytes."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    basis = np.uint32(1) << np.arange(32, dtype=np.uint32)
    for _ in range(4):
        basis = (basis >> 8) ^ table[basis & 255]
    out = []
    for _ in range(48):
        rows = [np.bitwise_xor.reduce(np.where(np.arange(256)[:, None] >> np.arange(8)[None] & 1, basis[8 * b : 8 * b + 8][None], 0), axis=1) for b in range(4)]
        out.append(np.stack(rows).astype(np.uint32))
        t = out[-1]
        basis = t[0][basis & 255] ^ t[1][basis >> 8 & 255] ^ t[2][basis >> 16 & 255] ^ t[3][basis >> 24]
    return np.stack(out)


def shifted_crcs(crc: np.ndarray, tail: np.ndarray) -> np.ndarray:
    """Each CRC-32 moved before so many ids: their XOR over a document's chunks is the document's CRC-32."""
    v, t = crc.astype(np.uint32), _crc_shifts()
    for k in range(int(tail.max(initial=0)).bit_length()):
        at = np.flatnonzero(tail >> k & 1)
        x = v[at]
        v[at] = t[k][0][x & 255] ^ t[k][1][x >> 8 & 255] ^ t[k][2][x >> 16 & 255] ^ t[k][3][x >> 24]
    return v


def _refs(recipes: DataFrame) -> DataFrame:
    """A row for each chunk of each recipe: pos, hash, n and how many ids of the document follow it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lens = [np.frombuffer(x, "<u4").astype(np.int64) for x in b.column(6).to_pylist()]
            times = np.array([len(x) for x in lens])
            at = pa.array(np.repeat(np.arange(len(lens)), times))
            hashes = b"".join(b.column(5).to_pylist())
            refs = pa.Array.from_buffers(pa.binary(16), len(hashes) // 16, [None, pa.py_buffer(hashes)]).cast(pa.binary())
            flat = lambda xs: pa.array(np.concatenate(xs) if xs else np.empty(0, np.int64))
            yield pa.RecordBatch.from_arrays([*(b.column(k).take(at) for k in range(5)), flat([np.arange(len(x)) for x in lens]), refs, flat(lens), flat([x.sum() - np.cumsum(x) for x in lens])], names=["pid", "idx", "doc_id", "start_in_part", "n_tokens", "pos", "hash", "n", "tail"])

    return recipes.mapInArrow(run, "pid int, idx long, doc_id long, start_in_part long, n_tokens long, pos long, hash binary, n long, tail long")


def _bytes_an_id(chunks: DataFrame) -> int:
    one = chunks.select("n", F.octet_length("payload").alias("b")).first()
    return one["b"] // one["n"] if one else 2


def read_back(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, n_chunks) of every document, from the files.

    Each stored chunk is read once, its address is checked, and its ids' CRC-32 is joined to the recipes
    that name it; a document's CRC-32 is combined from its chunks'. A chunk that is missing or has
    another length raises an error, as does a manifest that the recipes don't give.
    """
    before, offsets = 0, []
    for pid, n in verify_manifest(spark, path):
        offsets.append((pid, before))
        before += n
    chunks = _chunks(spark, path)
    dtype = np.dtype(f"<u{_bytes_an_id(chunks)}")

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            crc, payloads = [], b.column(1).to_pylist()
            for h, payload in zip(b.column(0).to_pylist(), payloads):
                if address(payload) != h:
                    raise ValueError(f"chunk {h.hex()} doesn't have its address")
                crc.append(zlib.crc32(np.frombuffer(payload, dtype).astype("<u4").tobytes()))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(crc, pa.int64()), pa.array([len(x) // dtype.itemsize for x in payloads], pa.int64())], names=["hash", "crc", "stored"])

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = shifted_crcs(b.column(5).to_numpy(), b.column(6).to_numpy())
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(v.astype(np.int64))], names=["pid", "idx", "doc_id", "start_in_part", "n_tokens", "crc"])

    keys = ["pid", "idx", "doc_id", "start_in_part", "n_tokens"]
    joined = _refs(_recipes(spark, path)).join(chunks.select("hash", "payload").mapInArrow(sums, "hash binary, crc long, stored long"), "hash", "left")
    held = joined.withColumn("crc", F.when(F.col("stored") == F.col("n"), F.col("crc")).otherwise(F.raise_error(F.lit("a recipe names a chunk that the store doesn't hold"))))
    moved = held.select(*keys, "crc", "tail").mapInArrow(move, "pid int, idx long, doc_id long, start_in_part long, n_tokens long, crc long")
    whole = moved.groupBy(*keys).agg(F.bit_xor("crc").alias("ids_crc32"), F.count("*").alias("n_chunks"))
    bases = spark.createDataFrame(offsets, "pid int, base long")
    return whole.join(bases, "pid").select("doc_id", (F.col("base") + F.col("start_in_part")).alias("start"), "n_tokens", "ids_crc32", "n_chunks")


def documents_ids(spark: SparkSession, path: str, doc_ids: list[int]) -> dict[int, list[int]]:
    """The ids of the named documents, rebuilt from their chunks; documents that the store doesn't hold are left out."""
    chunks = _chunks(spark, path)
    dtype = np.dtype(f"<u{_bytes_an_id(chunks)}")
    refs = _refs(_recipes(spark, path).filter(F.col("doc_id").isin(doc_ids)))
    out: dict[int, list[int]] = {}
    for r in refs.join(chunks.select("hash", "payload"), "hash").orderBy("doc_id", "idx", "pos").collect():
        out.setdefault(r["doc_id"], []).extend(np.frombuffer(r["payload"], dtype).tolist())
    return out
