"""Words of letters alone go to the library's model by themselves; chunks become distinct without a sort."""

import numpy as np
import public_tokenizers
import pyarrow as pa

from quern.llm import token_store


def test_words_against_the_library():
    e = token_store.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    words = ["the", "Straße", "a", "naïveté", "ªº", "ſƀɏ", "unheardofword", "É"] * 100
    for before, space in (("Ġ", " "), ("", "")):
        ids, lens = e._encoded_words(pa.array(words), before)
        want = [e.tokenizer.encode(space + w, add_special_tokens=False).ids for w in words]
        assert [x.tolist() for x in np.split(ids, np.cumsum(lens)[:-1])] == want


def test_words_alone_need_no_captures(monkeypatch):
    e = token_store.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    seen = []
    learn = token_store.Encoder._learn_others
    monkeypatch.setattr(token_store.Encoder, "_learn_others", lambda self, x: (seen.extend(x.to_pylist()), learn(self, x))[1])
    text = "first words über alles, and Straße.\nNext d'accord  Привет 42 words, alles"
    ids, _ = next(e.encode(pa.array([text, "x words alles"])))
    assert ids.tolist() == sum((e.tokenizer.encode(t, add_special_tokens=False).ids for t in (text, "x words alles")), [])
    assert not {"words", "über", "and", "alles"} & set(seen) and "alles," in seen


def test_chunks_are_distinct_without_a_sort(spark):
    rows = [(bytes([i % 7]) * 16, 2, bytes([i % 7]) * 4) for i in range(50)]
    once = token_store._once(spark.createDataFrame(rows, "hash binary, n long, payload binary"))
    assert sorted(bytes(r["hash"]) for r in once.collect()) == [bytes([i]) * 16 for i in range(7)]
    plan = once._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "Sort" not in plan
