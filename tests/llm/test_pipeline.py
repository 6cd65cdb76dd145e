"""The pipeline over small tables, each stage against what it should keep."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from quern.llm import decontaminate, simhash

WORDS = {
    "en": "the of and to in is that it was for on are with as his they at be this from have or by one had not but what all were when we there can an your which their said if do".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei einer um am sind noch wie einem".split(),
    "fr": "le de un être et à il avoir ne je son que se qui ce dans en du elle au pour pas sur faire plus dire me on mon lui nous comme mais pouvoir avec tout y aller voir".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más o pero sus le ha me si sin sobre este ya entre cuando todo esta ser son dos también fue".split(),
}


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    d, r = str(tmp_path_factory.mktemp("tables")), random.Random(4)
    invented = ["".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(4, 9))) for _ in range(3000)]

    def prose(lang, n):
        return " ".join(r.choice(WORDS[lang]) if r.random() < 0.5 else r.choice(invented) for _ in range(n))

    bench = [(i, prose("en", 40)) for i in range(5)]
    docs = []
    for i in range(160):
        lang = ("en", "de", "fr", "es")[i % 4]
        text = prose(lang, 150) + (" worthless stupid idiots disgusting trash" * 3 if i % 10 == 3 else "") + (" ### $$$ click buy now cheap" * 4 if i % 10 == 7 else "")
        docs.append((i, text, lang, f"src{i % 3}", len(text)))
    docs += [(200 + i, docs[i][1], docs[i][2], "src0", 1) for i in range(10)]
    docs += [(300 + i, docs[i][1] + " " + bench[i][1] + " " + prose("en", 50), "en", "src1", 1) for i in range(5)]
    docs += [(400, None, "en", "src0", 0), (401, "", "en", None, 0), (402, "12 34 !!", "de", "src0", 3), (200, docs[0][1], "en", "src0", 1)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    labels = [(i, 0 if i % 10 == 7 else 1, 1 if i % 10 == 3 else 0) for i in range(160)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return d, docs, bench


def test_stages(spark, tables):
    d, docs, bench = tables
    table = spark.read.parquet(f"{d}/documents.parquet")
    steps, now = {}, table
    for name, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, d)
        if name != "token_output":
            assert now.columns == table.columns
        now = spark.createDataFrame(now.collect(), now.schema)
        steps[name] = {r["doc_id"] for r in now.collect()}
    assert {x[0] for x in docs} - steps["language_id"] == {400, 401, 402}
    fps = {i: simhash.fingerprint(simhash.shingle_hashes(t)) for i, t, *_ in docs if i in steps["language_id"]}
    first = {i: min(j for j in fps if (fps[i] ^ fps[j]).bit_count() <= 3) for i in fps}
    assert steps["near_dedup"] == {i for i in fps if first[i] == i}
    index = decontaminate.Index([(i, t, None) for i, t in bench])
    texts = {i: t for i, t, *_ in docs}
    assert steps["decontamination"] == {i for i in steps["near_dedup"] if not index.matches(texts[i])}
    assert steps["decontamination"] == set(range(160))
    kept = steps["mixing"]
    good = [i for i in range(160) if i % 10 not in (3, 7)]
    assert kept <= set(range(160)) and len(kept & set(good)) >= 0.9 * len(good)
    assert len([i for i in kept if i % 10 == 3]) <= 8  # toxic ones are thinned
    assert steps["token_output"] == kept
    t, start = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), 0
    for r in sorted(now.collect(), key=lambda r: r["doc_id"]):
        ids = np.array(t.encode(texts[r["doc_id"]], add_special_tokens=False).ids + [2], "<u4")
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_run(spark, tables):
    d, _, _ = tables
    rows = corpus_pipeline.run(spark, d).collect()
    assert 100 < len(rows) <= 160 and min(r["start"] for r in rows) == 0
