"""Token store and token counts against the libraries themselves."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from quern.llm import token_counts, token_store
from quern.llm.common import scratch_path

PATH = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["the ", "a", "  ", " ", "\n", " \n", "é😀", " ", "zz", "ing ", "it's ", "<|endoftext|>", " x12,", "\t", "word. ", "Ǆx "]


def odd_texts(n, seed=1, most=60):
    r = random.Random(seed)
    return ["".join(r.choice(ODD) for _ in range(r.randint(0, most))) for _ in range(n)]


def test_encoder_gives_the_ids_of_whole_texts():
    own = token_store.Encoder(PATH)
    own.KEPT = 40  # segments are dropped and learned again
    for seed in range(20):
        texts = odd_texts(30, seed)
        for end in (b"", b"\2\0"):
            found = [part.tobytes() for ids, sizes in own.encode(pa.array(texts), end, 7) for part in np.split(ids, np.cumsum(sizes)[:-1])]
            assert found == [x + end for x in own.plain(texts)]
    assert [sizes.tolist() for _, sizes in own.encode(pa.array([None, ""]))] == [[0, 0]]


def test_segments_of_all_shapes():
    """Letters, marks, digits, line breaks and spaces in any order give the ids of whole texts."""
    own, r = token_store.Encoder(PATH), random.Random(7)
    own.KEPT = 300
    letters = ["ab", "Z", "é", "ªx", "ɏ", "ɐ", "word", "Ǆ", "ß"]
    others = [".", ",", "!?", "###", "'", "'s", "1", "23", "_", "\n", "\n\n", "\t", "-", "\"", "…", "—"]
    for _ in range(30):
        texts = [" ".join("".join(r.choice(letters if r.random() < 0.5 else others) for _ in range(r.randint(0, 6))) for _ in range(r.randint(0, 12))) for _ in range(40)]
        found = [part.tobytes() for ids, sizes in own.encode(pa.array(texts), b"", 16) for part in np.split(ids, np.cumsum(sizes)[:-1])]
        assert found == own.plain(texts)


def test_cut_points_depend_on_content_alone():
    r = np.random.default_rng(1)
    streams = [r.integers(0, 50_000, n) for n in (1, 63, 64, 65, 3000, 20_000, 5)]
    streams.append(np.zeros(5000, np.int64))
    sizes = np.array([len(s) for s in streams])
    together = token_store.cut_points(np.concatenate(streams), sizes)
    assert together == [token_store.cut_points(s, np.array([len(s)]))[0] for s in streams]
    for n, ends in zip(sizes.tolist(), together):
        lens = np.diff([0, *ends])
        assert ends[-1] == n and lens.max() <= token_store.MOST and (lens[:-1] >= token_store.LEAST).all()
    moved = token_store.cut_points(np.concatenate([r.integers(0, 50_000, 100), streams[5]]), np.array([20_100]))[0]
    assert len(set(e - 100 for e in moved) & set(together[5])) > 0.9 * len(together[5])


def expected(rows):
    t, start, out = Tokenizer.from_file(PATH), 0, {}
    for i, text in sorted(rows, key=lambda r: r[0]):
        ids = np.array(t.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        out[i] = (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    return out


def test_store_round_trip(spark, prose):
    texts = prose(40, words=400)
    rows = [(i * 7 % 41, texts[i % 30] + (" " + texts[3]) * (i % 3)) for i in range(40)] + [(100, None), (101, ""), (102, texts[5] * 40)]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, hash string").repartition(5)
    path = scratch_path(spark, "test-store")
    token_store.write_store(df, path)
    found = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in token_store.read_back(spark, path).collect()}
    assert found == expected(rows)
    t = Tokenizer.from_file(PATH)
    ids = token_store.documents_ids(spark, path, [100, 102, 7])
    assert ids[100] == [2] and ids[102] == t.encode(texts[5] * 40, add_special_tokens=False).ids + [2]
    stored = spark.read.parquet(f"{path}/chunks")
    assert stored.count() == stored.select("hash").distinct().count() < token_store._refs(token_store._recipes(spark, path)).count()


def test_store_notices_what_was_changed(spark, prose):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(prose(4, words=300))], "doc_id long, text string")
    path = scratch_path(spark, "test-store")
    token_store.write_store(df, path)
    spark.read.parquet(f"{path}/manifest").selectExpr("pid", "n_docs", "n_tokens", "reverse(root) AS root").write.parquet(f"{path}/other")
    jvm = spark._jvm.org.apache.hadoop.fs
    fs = jvm.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.delete(jvm.Path(f"{path}/manifest"), True)
    fs.rename(jvm.Path(f"{path}/other"), jvm.Path(f"{path}/manifest"))
    with pytest.raises(ValueError, match="manifest"):
        token_store.read_back(spark, path)


def test_store_of_nothing_and_of_repeats(spark):
    path = scratch_path(spark, "test-store")
    token_store.write_store(spark.createDataFrame([], "doc_id long, text string"), path)
    assert token_store.read_back(spark, path).count() == 0
    path = scratch_path(spark, "test-store")
    token_store.write_store(spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c")], "doc_id long, text string"), path)
    found = sorted((r["start"], r["n_tokens"]) for r in token_store.read_back(spark, path).collect())
    assert found == [(0, 2), (2, 3), (5, 3)]


def test_crc_of_parts():
    r = np.random.default_rng(3)
    for _ in range(20):
        ids = r.integers(0, 50_000, r.integers(1, 900)).astype("<u4")
        cut = sorted(r.integers(0, len(ids) + 1, 3).tolist())
        parts = np.split(ids, cut)
        tails = np.array([sum(map(len, parts[i + 1 :])) for i in range(len(parts))])
        crcs = np.array([zlib.crc32(p.tobytes()) for p in parts])
        assert np.bitwise_xor.reduce(token_store.shifted_crcs(crcs, tails)) == zlib.crc32(ids.tobytes())


def test_piece_counts_by_small_chunks():
    own, r = token_counts.PieceCounter(PIECES, chunk=60, overlap=6), random.Random(4)
    for _ in range(300):
        text = "".join(r.choice(["the ", "a", "  ", " ", "\n", "é😀", "▁", "zz", "ing ", "x" * r.randint(1, 40), "<s>"]) for _ in range(r.randint(1, 150)))
        assert own.count([text]) == [len(own.model.encode(text))]
    assert own.widened > 0


def test_piece_counts_table(spark):
    df = spark.createDataFrame([(1, "a b é"), (2, None), (3, ""), (3, ""), (4, "long words " * 9000)], "doc_id long, text string")
    model = token_counts.counter(PIECES).model
    found = sorted(map(tuple, token_counts.token_counts(df).collect()))
    assert found == sorted((i, len((t or "").encode()), len(model.encode(t or "")), len(model.encode(t or "")) > 4096) for i, t in [(r[0], r[1]) for r in df.collect()])
    assert token_counts.token_counts(df.limit(0)).count() == 0
