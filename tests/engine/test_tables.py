"""Relational operators against plain loops."""

import random

import pytest
from pyspark.sql import functions as F

from quern.functions import edits as E
from quern.functions import text as T
from quern.operators import assemble, dictionary, judge, metrics, noise, select, similarity


def sets(n, seed):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        base = rows[r.randrange(len(rows))][1].split() if rows and r.random() < 0.6 else [f"w{r.randrange(40)}" for _ in range(r.randint(0, 14))]
        for _ in range(r.randint(0, 2)):
            if base:
                base[r.randrange(len(base))] = f"w{r.randrange(40)}"
        rows.append((i, " ".join(base)))
    return rows


def near(a, b):
    a, b = set(a.split()), set(b.split())
    return bool(a and b) and 5 * len(a & b) >= 4 * len(a | b)


@pytest.mark.parametrize("seed", [1, 2])
def test_similarity(spark, seed):
    rows = sets(120, seed) + [(200, "a b c d e"), (201, "a b c d"), (202, "b c d"), (203, "c d")]
    df = spark.createDataFrame(rows, "id long, text string")
    texts = dict(rows)
    rep = {i: min(j for j in texts if set(texts[j].split()) == set(texts[i].split())) for i in texts if texts[i]}
    want = {(a, b) for a in set(rep.values()) for b in set(rep.values()) if a < b and near(texts[a], texts[b])}
    assert {tuple(r) for r in similarity.near_pairs(df, "id", "text").collect()} == want
    kept = []
    for i, t in rows:
        if not any(near(t, texts[k]) for k in kept):
            kept.append(i)
    found = {r["id"]: r["kept"] for r in similarity.greedy_kept(df, "id", "text").collect()}
    assert found == {i: i in kept for i, _ in rows}
    others = spark.createDataFrame([(i + 1000, t) for i, t in sets(40, seed + 9)] + [(i + 2000, t) for i, t in rows[:5]], "k long, body string")
    held = [(r["k"], r["body"]) for r in others.collect()]
    first = {r["id"]: r["match"] for r in similarity.first_near(df, others, "id", "text", "k", "body").collect()}
    assert first == {i: min((k for k, b in held if near(t, b)), default=None) for i, t in rows}


def test_dictionary(spark):
    words = spark.createDataFrame([("walk",), ("carry",), ("the",), ("from",), ("don't",), ("nice",)], "word string")
    df = spark.createDataFrame([(1, "the walked carries walker"), (2, "zzz the i"), (3, "dont"), (4, "the 4x u"), (5, "fromthe don't"), (6, "walk's U.S.A. The")], "id long, text string")
    assert {r["id"]: r["reason"] for r in dictionary.spelling_reasons(df, words).collect()} == {2: "unknown_word", 3: "missing_apostrophe", 4: "textspeak", 5: "unknown_word"}
    assert {r["id"]: r["words"] for r in dictionary.unknown_words(df, words).collect()} == {2: ["zzz", "i"], 3: ["dont"], 4: ["u"], 5: ["fromthe"]}
    assert {r["id"] for r in dictionary.run_together(df, words).collect()} == {5}


@pytest.mark.parametrize("cap", [0.0, 0.25, 0.5, 1.0])
def test_quota(spark, cap):
    r = random.Random(3)
    rows = [(i, r.random() < 0.6, i % 2) for i in range(200)]
    want, state = {}, {0: [0, 0], 1: [0, 0]}
    for i, lim, g in rows:
        kept, limited = state[g]
        keep = not lim or cap >= 1 or limited + 1 <= cap * (kept + 1)
        if keep:
            state[g] = [kept + 1, limited + lim]
        want[i] = keep
    df = spark.createDataFrame(rows, "i long, lim boolean, g long")
    assert {x["i"]: x["kept"] for x in select.quota_kept(df, F.col("lim"), "i", cap, "g").collect()} == want


def test_split_keeps_groups_together(spark):
    df = spark.createDataFrame([(i, "a" if i < 80 else "b" if i < 99 else "c", i // 4) for i in range(100)], "i long, kind string, key long")
    rows = select.group_split(df, "kind", "key", 0.1, "s", F.col("i") == 0).collect()
    by = {}
    for r in rows:
        by.setdefault((r["kind"], r["key"]), set()).add(r["split"])
    assert all(len(v) == 1 for v in by.values()) and by[("a", 0)] == {"train"} and by[("c", 24)] == {"train"}
    assert sum(v == {"valid"} for k, v in by.items() if k[0] == "a") == 2 and sum(v == {"valid"} for k, v in by.items() if k[0] == "b") == 1
    with pytest.raises(ValueError):
        select.group_split(df, "kind", "key", 1.0, "s")


def test_selection(spark):
    df = spark.createDataFrame([(i, "s", None if i % 3 == 0 else "bad") for i in range(30)], "i long, s string, r string")
    row = select.selection_report(df, "s", "i", "r", 4).first()
    assert (row["fetched"], row["kept"], row["dropped"]) == (10, 4, 6)
    assert select.sampled(df, "i", "x", 7).count() == 7 and select.take_by_hash(df, "s", "i", "x", 5).count() == 5
    assert select.first_of_group(df, "s", "i").first()["i"] == 0


def test_assembly(spark):
    pairs = spark.createDataFrame([(1, "a", "b"), (2, "a", "b"), (3, "c", "d")], "id long, input string, output string")
    assert [r["id"] for r in assemble.unseen_pairs(pairs, pairs.filter("id = 3"), "id").collect()] == [1]
    rows = spark.createDataFrame([(1, "", "x"), (2, None, ""), (3, "t", None)], "id long, input string, instruction string")
    assert [r["id"] for r in assemble.unusable(rows).collect()] == [2]
    with pytest.raises(Exception, match="no input and no instruction: 2"):
        assemble.checked_usable(rows, "id").collect()
    said = rows.filter("id <> 2").select(assemble.chat_messages("s", F.col("input"), F.col("instruction"), F.lit("o")).alias("m")).collect()
    assert sorted(r["m"][1]["content"] for r in said) == ["t", "x"]
    with pytest.raises(ValueError):
        assemble.sampled_pairs(pairs, ["id"], "s", 9)
    long = spark.createDataFrame([(i, 5) for i in range(30)] + [(99, 50)], "id long, n long")
    with pytest.raises(ValueError, match="1 of 31 rows"):
        assemble.length_guarded(long, F.col("n"), 10)
    assert assemble.length_guarded(long, F.col("n"), 10, 0.05).count() == 30
    got = {r["id"]: r["next"] for r in assemble.next_in_order(long.filter("id < 3"), "id", "id").collect()}
    assert got == {0: 1, 1: 2, 2: 0}


def test_metrics(spark):
    rows = [("Hi there.\nAnn", "Hi there.\nAnn"), ("a b c", "a  b c"), ("a b c\nd", "a x c\ne"), ("one\ntwo", "one two")]
    df = spark.createDataFrame(rows, "t string, o string")
    scores = metrics.scored(df, "t", "o", E.diffed(F.col("t"), F.col("o"))["word_edits"])
    s = metrics.summary(scores).first().asDict()
    assert s["n"] == 4 and s["changed"] == 0.75 and s["whitespace_only"] == 2 and s["one_to_three_edits"] == 1.0
    assert s["with_signoff"] == 3 and s["signoff_kept"] == 0.3333 and s["lines_kept"] == 0.75
    assert metrics.summary(scores.limit(0)).first()["changed"] == 0.0
    cache = spark.createDataFrame([("1", "x", "keep")], "id string, sha256 string, verdict string")
    texts = spark.createDataFrame([("1", "changed"), ("2", "new")], "id string, text string")
    with pytest.raises(Exception, match="1: text differs"):
        metrics.strict_verdicts(texts, cache, "id", "text").collect()

    def client():
        return lambda i, text: "No." if text == "new" else 1 / 0

    fresh = judge.cleanliness(texts.filter("id = '2'"), cache, "id", "text", client).collect()
    assert [(r["id"], r["verdict"]) for r in fresh] == [("2", "keep")]
    failed = judge.asked(texts.filter("id = '1'"), "id", "text", client).first()
    assert failed["reply"] is None and failed["error"] == "ZeroDivisionError"
    assert judge.calibrated(0.98, 0.95) and not judge.calibrated(0.97, 1.0)


def test_word_edits_and_kinds():
    assert [E.edit_count(a, b) for a, b in (("a b c", "a x c"), ("a b", "a b c"), ("a", "a"), ("", "x y"))] == [1, 1, 0, 2]
    assert E.edit_count(" ".join(["to be"] * 140), " ".join(["to be"] * 70 + ["to bee"] + ["to be"] * 69)) == 1
    assert E.edit_kinds("We are here.", "We are here") == ["punctuation"] and E.edit_kinds("We are", "we are") == ["case"]
    assert E.edit_kinds("the house", "teh house") == ["typo"] and E.edit_kinds("go to it", "go it") is None and E.edit_kinds("at 5", "at 6") is None
    assert [E.distance(a, b) for a, b in (("abc", "abd"), ("abc", "abc"), ("abcd", "wxyz"), ("", "ab"), ("ab", "ba"))] == [1, 0, 3, 2, 2]


def test_contract():
    known = {"your", "my", "credit", "there"}.__contains__
    ok = [("their house", "there house"), ("I could have gone", "I could of gone"), ("Peace of mind", "piece of mind"), ("A  b", "a b"), ("the credit", "the credti")]
    assert all(E.off_contract(a, b, known) == [] for a, b in ok)
    assert E.off_contract("my house", "your house", known) == ["real-word swap"]
    assert E.off_contract("the plan", "the cambic", known) == ["garbled"]
    assert E.off_contract("the plan", "the", known) == ["words added or dropped"]


@pytest.mark.parametrize(("source", "new", "want"), [("Their", "there", "There"), ("THEIR", "there", "THERE"), ("Peace of Mind", "piece of mind", "Piece of Mind"), ("a lot", "alot", "alot"), ("A lot", "alot", "Alot"), ("123", "x", "x")])
def test_case(source, new, want):
    assert E.match_case(source, new) == want


def test_noise_properties():
    text = "Their plan could have worked, and it's definitely weird. See www.site.example/a b and report.pdf for Ann.\nBest wishes, Bo"
    lexicon = kinds = 0
    for i in range(400):
        edits = E.chosen(E.places(text), E.Draws("s", i))
        assert 1 <= len(edits) <= 3 and sum(e[3] == "double_space" for e in edits) <= 1
        spans = sorted((s, e) for s, e, *_ in edits)
        assert all(b <= c for (_, b), (c, _) in zip(spans, spans[1:]))
        out = E.with_edits(text, edits)
        assert out.endswith("\nBest wishes, Bo") and "www.site.example/a" in out and "report.pdf" in out
        lexicon, kinds = lexicon + (edits[0][3] == "lexicon"), kinds + 1
    assert 0.62 < lexicon / kinds < 0.78
    assert E.injected(text, E.Draws(1)) == E.injected(text, E.Draws(1)) and E.injected("", E.Draws(1)) == ""
    with pytest.raises(ValueError):
        E.chosen(E.places("x"), E.Draws(1), 2, 1)
    slips = [E.places("keyboard")["fat_finger"][0][2](E.Draws(i)) for i in range(50)]
    assert all(s[0] == "k" and sum(a != b for a, b in zip(s, "keyboard")) == 1 for s in slips)


def test_variants(spark):
    df = spark.createDataFrame([(1, "The house was there all the time, I think."), (2, "x"), (3, None), (4, "The house was there all the time, I think.")], "id long, text string")
    rows = noise.variants(df, "id", "text", 3, "s").collect()
    assert [r["variant"] for r in sorted(rows, key=lambda r: r["variant"])] == [1, 2, 3] and {r["id"] for r in rows} == {1}
    assert len({r["output"] for r in rows}) == 3 and all(r["output"] != r["input"] for r in rows)
    again = noise.variants(df.repartition(3), "id", "text", 3, "s").collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_candidates_and_edits(spark):
    df = spark.createDataFrame([(1, "We saw Ann and NATO. Then (Bob) left, I said; Tom"), (2, "\"Hello\" Bo")], "id long, text string")
    found = sorted((r["id"], r["start"], r["replacement"]) for r in noise.lowercase_candidates(df, "id", "text").collect())
    assert found == [(1, 7, "ann"), (1, 27, "bob"), (1, 46, "tom"), (2, 8, "bo")]
    edits = spark.createDataFrame([(1, 0, 2, "Us"), (1, 7, 10, "")], "id long, start long, end long, replacement string")
    out = {r["id"]: r["output"] for r in noise.corrupted(df, edits, "id", "text").collect()}
    assert out == {1: "Us saw  and NATO. Then (Bob) left, I said; Tom", 2: "\"Hello\" Bo"}
    lex = spark.createDataFrame([("ann", "anne")], "phrase string, wrong string")
    assert [(r["start"], r["end"]) for r in noise.lexicon_matches(df, "id", "text", lex).collect()] == [(7, 10)]
    fat = noise.fat_finger(df, "id", "text", "s").collect()
    assert all(r["end"] - r["start"] == len(r["replacement"]) for r in fat) and len(fat) == 2


def test_memorisation(spark):
    text = " ".join(f"w{i}" for i in range(40))
    df = spark.createDataFrame([(1, text, " ".join(f"W{i}" for i in range(10, 18))), (2, text, " ".join(f"w{i}" for i in range(0, 8))), (3, text, "w10 w11")], "i long, t string, c string")
    hits = {r["i"]: r["h"] for r in df.select("i", F.coalesce(metrics.continues(F.col("c"), F.col("t"), 5, 8), F.lit(False)).alias("h")).collect()}
    assert hits == {1: True, 2: False, 3: False}


def test_decoding(spark):
    df = spark.createDataFrame([(1, bytearray("é".encode()), None), (2, bytearray(b"\xe9"), "latin-1"), (3, bytearray(b"\x93\x81"), "nope")], "i long, b binary, c string")
    assert {r["i"]: r["t"] for r in df.select("i", E.decoded(F.col("b"), F.col("c")).alias("t")).collect()} == {1: "é", 2: "é", 3: "“�"}


def test_case_of_one_word(spark):
    df = spark.createDataFrame([("ABC",), ("Abc",), ("abc",), ("A",)], "w string")
    assert [r[0] for r in df.select(T.one_word_case(F.col("w"), F.lit("xy"))).collect()] == ["XY", "Xy", "xy", "Xy"]
