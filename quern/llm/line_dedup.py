"""Line dedup over whole tables: hashes in range partitions, decisions as keep bitmaps.

Every line long enough gives a row of its key's hash, its document and its place. The rows are range
partitioned and sorted by (hash, document, place), so a line that a third of all documents share is
spread over several partitions. Each task streams its sorted rows and names the lines to drop: those
in other documents than the first that it sees for a hash. Only the first document of a partition's
first hash can't be judged within the task; those few are settled from one summary row a partition.
What comes back is a zlib-compressed bitmap of kept lines for each document that loses any, not text.

Null and empty texts are one empty line. A null doc_id counts as one document after all others. Rows
that repeat a doc_id are one document; identical rows get the same decisions. An empty table gives no
rows. Other columns of the input are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.common import written

_WHITE = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LAST = (1 << 63) - 1


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(_WHITE)), _UPPER, _LOWER)


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text")).withColumn("doc", F.coalesce("doc_id", F.lit(_LAST))).withColumn("same", F.xxhash64("text"))


def _lines(docs: DataFrame, least: int) -> DataFrame:
    lines = docs.select("doc", "same", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line")).withColumn("key", line_key(F.col("line")))
    return lines.filter(F.char_length("key") >= least).select(F.unhex(F.md5("key")).alias("h"), "doc", "same", "pos")


def _first_seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Streams rows sorted by (h, doc, pos). kind 0: drop; 1: the first document of the first hash; 2: the last hash and its first document here."""
    first = last = owner = None
    pid = -1
    for batch in batches:
        if not batch.num_rows:
            continue
        pid = batch.column(4)[0].as_py()
        h, doc = batch.column(0).to_pylist(), batch.column(1).to_numpy()
        fresh = np.fromiter((a != b for a, b in zip(h, [last, *h])), bool, len(h))
        at = np.maximum.accumulate(np.where(fresh, np.arange(len(h)), -1))
        owners = np.where(at >= 0, doc[at], 0 if owner is None else owner)
        kind = np.where(doc != owners, 0, 9)
        if first is None:
            first = h[0]
        n = next((i for i, x in enumerate(h) if x != first), len(h)) if h[0] == first else 0
        kind[:n][kind[:n] == 9] = 1
        last, owner = h[-1], int(owners[-1])
        out = pa.RecordBatch.from_arrays([pa.array(kind), *batch.columns], names=["kind", "h", "doc", "same", "pos", "pid"])
        yield out.filter(pa.array(kind != 9))
    if last is not None:
        yield pa.RecordBatch.from_arrays([pa.array([2]), pa.array([last], pa.binary()), pa.array([owner]), pa.array([0]), pa.array([0], pa.int32()), pa.array([pid], pa.int32())], names=["kind", "h", "doc", "same", "pos", "pid"])


def _settle(found: DataFrame) -> list[int]:
    """The partitions whose first document of the first hash loses its lines; reads two rows a partition."""
    ends = {r["pid"]: r for r in found.filter("kind = 2").select("pid", "h", "doc").collect()}
    starts = {r["pid"]: r for r in found.filter("kind = 1").groupBy("pid").agg(F.first("h").alias("h"), F.first("doc").alias("doc")).collect()}
    lose, carry = [], (None, None)
    for pid in sorted(ends):
        start, end = starts[pid], ends[pid]
        goes_on = start["h"] == carry[0]
        if goes_on and start["doc"] != carry[1]:
            lose.append(pid)
        if not (goes_on and end["h"] == carry[0]):
            carry = (end["h"], end["doc"])
    return lose


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 10) -> DataFrame:
    """(doc, same, keep): for each document that loses lines, the zlib-compressed bitmap of the lines it keeps.

    doc: the doc_id (the largest long for null); same: the hash of its text; keep: bit i of the
    bitmap (least first) stands for line i, and lines beyond its end are kept.
    """
    spark = docs.sparkSession
    lines = written(_lines(_keyed(docs, id_col, text_col), least), "lines")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = lines.repartitionByRange(parts, "h", "doc", "pos").sortWithinPartitions("h", "doc", "pos").withColumn("pid", F.spark_partition_id())
    found = written(order.mapInArrow(_first_seen, "kind long, h binary, doc long, same long, pos int, pid int"), "decisions")
    dropped = found.filter((F.col("kind") == 0) | ((F.col("kind") == 1) & F.col("pid").isin(_settle(found))))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            maps = []
            for pos in batch.column(2).to_pylist():
                bits = np.ones(max(pos) // 8 * 8 + 8, bool)
                bits[pos] = False
                maps.append(zlib.compress(np.packbits(bits, bitorder="little").tobytes()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(maps, pa.binary())], names=["doc", "same", "keep"])

    return dropped.groupBy("doc", "same").agg(F.collect_list("pos").alias("pos")).mapInArrow(pack, "doc long, same long, keep binary")


def kept_lines(text: str, keep: bytes | None) -> tuple[list[str], int]:
    """The lines that a bitmap keeps and the number of lines before."""
    lines = text.split("\n")
    if keep is None:
        return lines, len(lines)
    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), bitorder="little")
    return [x for i, x in enumerate(lines) if i >= len(bits) or bits[i]], len(lines)


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 10, with_text: bool = False) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_sha256[, text]) for every row, after a join of bitmaps to texts."""
    base = _keyed(docs, id_col, text_col)
    joined = base.join(keep_bitmaps(docs, id_col, text_col, least), ["doc", "same"], "left").select("doc_id", "text", "keep")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, n, lost, sha, texts = [], [], [], [], []
            for i, text, keep in zip(*(c.to_pylist() for c in batch.columns)):
                kept, lines = kept_lines(text, keep)
                left = "\n".join(kept)
                ids.append(i), n.append(lines), lost.append(lines - len(kept)), sha.append(hashlib.sha256(left.encode("utf-8")).hexdigest())
                if with_text:
                    texts.append(left)
            columns = [pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(lost, pa.int64()), pa.array(sha, pa.string())]
            names = ["doc_id", "n_lines", "n_dropped", "kept_sha256"]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(texts, pa.string())] * with_text, names=names + ["text"] * with_text)

    return joined.mapInArrow(run, "doc_id long, n_lines long, n_dropped long, kept_sha256 string" + ", text string" * with_text)


SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), lines AS (
  SELECT r, doc_id, i, l[i] AS line,
    translate(trim(l[i], chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT r, doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM (SELECT r, doc_id, string_split(text, chr(10)) AS l FROM docs))
), owners AS (
  SELECT key, min(doc_id) AS owner FROM lines WHERE length(key) >= 10 GROUP BY key
), marked AS (
  SELECT r, lines.doc_id, i, line, owner IS NOT NULL AND owner <> lines.doc_id AS dropped
  FROM lines LEFT JOIN owners ON lines.key = owners.key
)
SELECT any_value(doc_id) AS doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE dropped)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY r
"""
