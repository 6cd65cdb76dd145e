"""Page extraction, decontamination, language ID, mixing and the language model."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quern.llm import context_mixing, decontaminate, html_text, language_id, mixing
from quern.llm.textclass import GramModel

LONG = "The cat sat on the mat and it was one of the best in the house of them all."


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("", ""),
        (None, ""),
        ("plain &amp; text", "plain & text"),
        (f"<nav><a href=x>Home</a></nav><article><h1>T&eacute;</h1><p>Short.<p>{LONG}<br>x</article><footer>f</footer>", f"Té Short. {LONG} x"),
        (f"<header>site</header><article><header><h1>T</h1></header><p>a<form>f</form><aside>q</aside><div class='ad'>z</div>b</article>", "T a b"),
        (f"<div class='menu'>Home</div><div><p>{LONG}</p><p>Short.</p></div><div id=comments><p>{LONG}</p></div>", f"{LONG} Short."),
        (f"<ul><li><a href=1>one two</a></li></ul><p>{LONG}</p><p>tail</p>", f"{LONG} tail"),
        ("<article><p>one</p><script>var a='</p>';</script><style>p{}</style><!-- c --><p>two&nbsp;  three</p></article>", "one two three"),
        ("<article><p>fo<b>o</b>t</p><p>a &lt;b&gt; c</p></article>", "foot a <b> c"),
        (f"<div class=ad>buy<article><p>{LONG}</p></article>", LONG),
        ("<body><div class='cookie-notice'>We use cookies</div><main><p>x</p></main></body>", "x"),
        ("<article><p>%%% *** ###</p><p>a | b | c</p></article>", "%%% *** ### a | b | c"),
    ],
)
def test_main_text(page, text):
    assert html_text.main_text(page) == text


def test_extracted_table(spark):
    df = spark.createDataFrame([(1, "u", "<p>x</p>", 5), (2, None, None, 6), (1, "u", "<p>x</p>", 5)], "page_id long, url string, html string, text int")
    assert sorted(map(tuple, html_text.extracted(df.select("page_id", "url", "html")).collect()), key=str) == [(1, "u", "x", 1), (1, "u", "x", 1), (2, None, "", 0)]
    assert html_text.extracted(df.limit(0)).count() == 0


def brute_matches(text, items):
    out = []
    for i, q in items:
        w, t = decontaminate.words(q), decontaminate.words(text)
        if not w:
            continue
        n = min(5, len(w))
        own = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)}
        held = {tuple(t[k : k + n]) for k in range(len(t) - n + 1)}
        if len(own & held) >= 0.8 * len(own) - 1e-9:
            out.append(i)
    return sorted(out)


def test_decontamination_against_brute_force(spark, prose):
    import random

    r = random.Random(3)
    items = [(i, " ".join(t.split()[: r.randint(1, 60)])) for i, t in enumerate(prose(90, 11))] + [(200, ""), (201, None), (202, "lone"), (203, prose(1, 5, 900)[0])]
    docs = []
    for i, base in enumerate(prose(150, 12, 300)):
        w = base.split()
        for at in sorted(r.sample(range(len(w)), r.randint(0, 3)), reverse=True):
            q = (r.choice(items)[1] or "").split()
            for _ in range(r.randint(0, 3)):
                if q:
                    q[r.randrange(len(q))] = "edited"
            w[at:at] = q
        docs.append((i, " ".join(w).upper() if i % 5 == 0 else ", ".join(w) if i % 7 == 0 else " ".join(w)))
    docs += [(900, None), (901, ""), (902, "x " * 5000 + items[-1][1])]
    df = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, item_ids int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = {x["doc_id"]: x["item_ids"] for x in decontaminate.contamination(df, bench).collect()}
    assert found == {i: brute_matches(t, items) for i, t in docs}
    assert sum(map(bool, found.values())) > 40
    whole, decontaminate.SHARD = decontaminate.SHARD, 3000
    try:
        assert {x["doc_id"]: x["item_ids"] for x in decontaminate.contamination(df, bench).collect()} == found
    finally:
        decontaminate.SHARD = whole
    assert not any(x["contaminated"] for x in decontaminate.contamination(df, bench.limit(0)).collect())
    assert decontaminate.contamination(df.limit(0), bench).count() == 0


def test_answers_must_be_there_too():
    index = decontaminate.Index([(1, "one two three four five six", "seven eight"), (2, "one two three four five six", None)])
    assert index.matches("x one two three four five six y seven eight") == [1, 2]
    assert index.matches("x one two three four five six y seven") == [2]


def language_rows():
    en = "the house of the people and that is what they have in this place for all of them"
    de = "das haus der leute und das ist was sie an diesem ort für alle von ihnen haben"
    rows = [(i, f"{en} {i}" if i % 2 else f"{de} {i}", "en" if i % 2 else "de", f"www.h{i % 4}.example.{'com' if i % 2 else 'de'}") for i in range(200)]
    return rows


def test_language_id(spark):
    rows = language_rows() + [(900, "", "en", None), (901, None, "de", "x"), (902, "12 34", "de", "x"), (903, "ok", "de", "www.h0.example.de"), (904, "ok", "en", "www.h1.example.com"), (905, "это другой язык и другие буквы которых здесь нет " * 3, "de", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    model = language_id.fit_text_model(df, "doc_id", "text", F.col("lang"), ("de", "en"), 50)
    host = language_id.host_of(F.concat(F.lit("https://"), F.col("source"), F.lit("/p")))
    got = language_id.identified(df, model, "text", F.col("lang"), host, host).collect()
    found = {r["doc_id"]: r for r in got}
    assert len(got) == len(rows) and set(got[0].asDict()) == {"doc_id", "text", "lang", "source", "lid_lang", "lid_confidence", "lid_accepted"}
    assert all(found[i]["lid_lang"] == ("en" if i % 2 else "de") and found[i]["lid_accepted"] for i in range(200))
    assert [found[i]["lid_lang"] for i in (900, 901, 902)] == ["und"] * 3
    assert found[903]["lid_lang"] == "de" and found[904]["lid_lang"] == "en"  # the evidence decides
    assert found[905]["lid_lang"] == "und" and not found[905]["lid_accepted"]
    assert language_id.identified(df.limit(0), model, "text", F.col("lang"), host, host).count() == 0


def test_language_by_hand(spark):
    """The fused posterior of one row, recomputed outside Spark."""
    rows = language_rows()[:40]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    model = language_id.fit_text_model(df, "doc_id", "text", F.col("lang"), ("de", "en"), 50)
    got = {r["doc_id"]: r["lid_confidence"] for r in language_id.identified(df, model, "text", F.col("lang"), F.col("source"), F.col("source")).collect()}
    best = {i: int(model.scores(t)[1].argmax()) for i, t, _, _ in rows}
    base = [1 + sum(b == k for b in best.values()) for k in (0, 1)]
    i, text, lang, host = rows[3]
    others = [r for r in rows if r[0] != i]
    count = lambda f: [sum(best[r[0]] == k and f(r) for r in others) for k in (0, 1)]
    smooth = lambda c, p, w: [(a + w * b) / (sum(c) + w) for a, b in zip(c, p)]
    domain = lambda r: ".".join(r[3].split(".")[-2:])
    prior = smooth(count(lambda r: r[3] == host), smooth(count(lambda r: domain(r) == domain(rows[3])), [b / sum(base) for b in base], 16), 4)
    ev = lambda c: [math.log((a + (sum(c) + 1) / sum(base)) / (b + 1)) for a, b in zip(c, base)]
    meta = [math.log(p) + x + y for p, x, y in zip(prior, ev(count(lambda r: r[2] == lang)), ev(count(lambda r: r[3].endswith(host[-4:]))))]
    logs = np.array(meta + [min(meta)]) + 0.1 * model.scores(text)[1]
    assert got[i] == pytest.approx(1 / np.exp(logs - logs.max()).sum(), rel=1e-9)


def test_url_parts(spark):
    df = spark.createDataFrame([("https://u@www.A.example.COM:8/x?y",), ("no url",), (None,)], "url string")
    h = language_id.host_of(F.col("url"))
    assert [tuple(r) for r in df.select(h, language_id.suffix_of(h), language_id.domain_of(h)).collect()] == [("www.a.example.com", "com", "example.com"), (None, None, None), (None, None, None)]


def test_mixing_reaches_its_targets(spark, prose):
    rows = [(i, t + (" bad worse awful dire poor" if i % 4 == 0 else " fine good nice sound well")) for i, t in enumerate(prose(400, 21, 40))] + [(500, None), (501, "")]
    docs = spark.createDataFrame([(i, t, 1.0) for i, t in rows], "doc_id long, text string, rate double")
    labels = spark.createDataFrame([(i, "bad" if i % 4 == 0 else "fine") for i in range(0, 400, 3)] + [(9999, "bad"), (2, None)], "doc_id long, d string")
    got = mixing.mixed(docs, labels, F.col("d"), {"bad": 0.5, "fine": 0.5}).collect()
    assert len(got) == len(rows)
    p, n, rate = np.array([r["p"] for r in got]), np.array([r["n_tokens"] for r in got]), np.array([r["rate"] for r in got])
    assert (rate >= 0).all() and np.allclose((n * rate) @ p, n.sum() / 2, rtol=1e-3)
    held = {r["doc_id"]: r["p"] for r in got}
    right = [(held[i][0] > 0.5) == (i % 4 == 0) for i in range(400) if i % 3]
    assert np.mean(right) > 0.9
    assert all(math.floor(r["rate"]) <= r["copies"] <= math.ceil(r["rate"]) for r in got)
    down = mixing.mixed(docs, labels, F.col("d"), {"bad": 0.1, "fine": 0.9}, most=1.0).collect()
    assert all(0 <= r["rate"] <= 1 and r["copies"] in (0, 1) for r in down)
    t = np.array([r["n_tokens"] * r["rate"] for r in down]) @ np.array([r["p"] for r in down])
    assert t[0] / t.sum() == pytest.approx(0.1, abs=0.02)
    with pytest.raises(ValueError, match="no labelled rows"):
        mixing.mixed(docs, labels.filter("d = 'bad'"), F.col("d"), {"bad": 0.5, "fine": 0.5})
    assert mixing.mixed(docs.limit(0), labels, F.col("d"), {"bad": 0.5, "fine": 0.5}).count() == 0


def test_gram_model_separates():
    m = GramModel(["a", "b"])
    m.learn(["aa bb ab"] * 5, ["a"] * 5)
    m.learn(["xx yy xy"] * 5, ["b"] * 5)
    m.fitted()
    assert m.scores("ab aa")[1].argmax() == 0 and m.scores("yy")[1].argmax() == 1 and m.scores(None)[0] == 0
    assert m.scores("qqqq zzzz kkkk")[1].argmax() == 2


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def test_language_model_counts_and_base(spark, prose):
    rows = [(i, t) for i, t in enumerate(prose(60, 31, 50))] + [(100, None), (101, " \n"), (102, "É Ünique WORD"), (None, "a b"), (5, prose(60, 31, 50)[5])]
    df = spark.createDataFrame([(i, t, 2) for i, t in rows], "doc_id long, text string, n int")
    got = context_mixing.scored(df).toPandas()
    c = Counter(w for i, t in rows if not context_mixing.held_out(i) for w in [*tokens(t), None])
    n, v = sum(c.values()), len(c)
    want = sorted((-1 if i is None else i, context_mixing.held_out(i), len(tokens(t)) + 1, sum(c[w] > 0 for w in [*tokens(t), None]), round(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in [*tokens(t), None]), 6)) for i, t in rows)
    found = sorted((-1 if r.doc_id != r.doc_id else int(r.doc_id), bool(r.held_out), r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got.itertuples())
    assert found == want and set(got.train_tokens) == {n}
    assert (got.score < 0).all() and got.bits_per_byte.mean() < 5
    assert context_mixing.scored(df.limit(0)).count() == 0
    crc = [context_mixing.held_out(i) for i in range(50)]
    assert crc == [zlib.crc32(str(i).encode()) % 10 == 0 for i in range(50)]
