"""Steps whose cost has to grow no faster than their input."""

import random

from pyspark.sql import functions as F

from quern.functions import text as T
from quern.operators import noise, similarity


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_words_and_slips_need_no_shuffle(spark):
    df = spark.createDataFrame([(1, "Dear Ann, it was a Monday 😀 when James wrote."), (2, ""), (3, None)], "id long, text string")
    lex = spark.createDataFrame([("it was", "x"), ("when", "wen")], "phrase string, wrong string")
    for out in (noise.words_at(df, "id", "text"), noise.lowercase_candidates(df, "id", "text"), noise.fat_finger(df, "id", "text", "s"), noise.lexicon_matches(df, "id", "text", lex)):
        assert "hashpartitioning(id" not in _plan(out) and "Window" not in _plan(out)
    assert sorted((r["start"], r["phrase"]) for r in noise.lexicon_matches(df, "id", "text", lex).collect()) == [(10, "it was"), (28, "when")]
    assert [(r["start"], r["replacement"]) for r in noise.lowercase_candidates(df, "id", "text").collect() if r["start"] > 5] == [(19, "monday"), (33, "james")]


def test_token_sets_are_worked_out_once(spark):
    df = spark.createDataFrame([(1, "a b"), (2, "..")], "id long, text string")
    sets = similarity.token_sets(df, "id", "text")
    assert _plan(sets.select("id", "tokens")).count("regexp_extract_all") == 1
    assert [r["tokens"] for r in sets.collect()] == [["a", "b"]]


def test_candidates_of_sets_that_share_one_word_are_few(spark):
    """Sets of the same sizes with common words: the bitmaps leave near ones alone to compare."""
    r = random.Random(3)
    rows = [(i, " ".join(r.sample([f"w{k}" for k in range(120)], 40))) for i in range(300)]
    rows += [(1000 + i, t + " more") for i, t in rows[:20]]
    sets = similarity._distinct_sets(similarity.token_sets(spark.createDataFrame(rows, "id long, text string"), "id", "text"))
    hashed = similarity._hashed(sets)
    parts = similarity.materialised(similarity._parts(hashed, similarity._ranked(hashed)))
    found = {(x["x"], x["y"]) for x in similarity._candidates(parts, parts, F.col("x") > F.col("y")).distinct().collect()}
    assert {(1000 + i, i) for i in range(20)} <= found and len(found) < 60


def test_folding_of_common_and_uncommon_letters(spark):
    rows = [("Straße ÉTÉ “x”",), ("ﬁne Ⅳ",), ("ΟΔΟΣ",), ("don`t",)]
    got = [x[0] for x in spark.createDataFrame(rows, "t string").select(T.token_set(F.col("t"))).collect()]
    assert got == [["strasse", "x", "été"], ["fine", "ⅳ"], ["οδοσ"], ["don't"]]


def test_long_diffs_take_no_square_of_their_words():
    import time

    from quern.functions import edits as E

    r = random.Random(1)
    words = [r.choice("the of and to in that is it for was".split()) for _ in range(30_000)]
    wrong = [*words]
    wrong[50], wrong[15_000], wrong[29_990] = "teh", "off", "fr"
    del wrong[20_000]
    began = time.process_time()
    found = list(E._opcodes(words, wrong))
    assert time.process_time() - began < 5
    assert [x[:2] for x in found if x[1] - x[0] == 1 == x[3] - x[2]] == [(50, 51), (15_000, 15_001), (29_990, 29_991)] and len(found) == 4


def test_numbers_are_found_in_what_is_left_of_a_text(spark):
    r = random.Random(2)
    parts = ["fe80::1:2", " 12 Main Street", "+44 (0)20 7946 0958", "Order: 2125550187", "2125550187", "10.20.30.255", "123-45-6789", "(212) 555-0187", "4111 1111 1111 1111", "x" * 90, " word" * 40, "\n", "a.b@c.de", "www.x.y", " 7 ", "."]
    rows = [("".join(r.choice(parts) for _ in range(r.randint(1, 5))),) for _ in range(300)]
    from quern.functions import rules

    c, df = F.col("t"), spark.createDataFrame(rows, "t string")
    whole = F.coalesce(*[F.when(hit, name) for name, hit in rules.pii_kinds(c).items()])
    assert df.filter(~rules.pii_reason(c).eqNullSafe(whole)).count() == 0
    assert df.select(F.max(F.length(rules.numbers(c)) < F.length(c))).first()[0]


def test_variants_reach_python_in_small_batches(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(noise, "materialised", lambda df, rows=None: seen.append(rows) or df)
    noise.variants(spark.createDataFrame([(1, "Some text here.")], "id long, text string"), "id", "text", 1, "s")
    assert seen == [500]


def test_frequent_known_words_leave_before_the_shuffle(spark, monkeypatch):
    from quern.operators import dictionary

    rows = [(i, f"the cat odd{'abcdef'[i]} the cat i") for i in range(6)] + [(9, "the cat."), (10, "the sat")]
    df, words = spark.createDataFrame(rows, "id long, text string"), spark.createDataFrame([("the",), ("cat",), ("sat",)], "word string")
    results = []
    for small in (500_000, 3):
        monkeypatch.setattr(dictionary, "SMALL", small)
        spelled, unknown = dictionary.spelling_reasons(df, words), dictionary.unknown_words(df, words)
        assert ("LeftAnti" in _plan(spelled)) == ("LeftAnti" in _plan(unknown)) == (small == 3)
        results.append((sorted(map(tuple, spelled.collect())), sorted((r["id"], *r["words"]) for r in unknown.collect())))
    assert results[0] == results[1] and results[0][0] == [(i, "unknown_word") for i in range(6)]
