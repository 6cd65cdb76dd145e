"""Spelling at sentence starts, the pre-gate, the pair filter, running values and selections, against loops in plain Python."""

import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from quern.functions import edits as E
from quern.functions import rules
from quern.functions import text as T
from quern.operators import dictionary, gate, judge, noise, select, similarity
from quern.operators.ordered import Ordered, added

WORDS = ["dear", "the", "house", "was", "it", "is", "fine", "and", "we", "walk", "you", "see", "soon", "then", "go", "home", "who", "bob", "all", "of", "us", "a", "had", "lot"]


def words_table(spark, more=()):
    return spark.createDataFrame([(w,) for w in [*WORDS, *more]], "word string")


SPELLED = {
    "Dear Mr. Zqx, the house was fine.": None,  # a name after an honorific
    "The house. Zqx was fine.": "unknown_word",
    "The house.\n(\"Zqx\" was fine": "unknown_word",
    "the house, Zqx was [Zqx] fine": None,
    "It is NATO and NATO. NATO is fine": None,
    "Walked and walking; the house's walks": None,
    "the zqx": "unknown_word",
    "it is i": "lowercase_i",
    "we dont go": "missing_apostrophe",
    "Dont go": "missing_apostrophe",
    "see u soon": "textspeak",
    "a 4x zq4 of e.g. u.s.a. all": None,
    "I had a lot": "unknown_word",  # I opens the text and the dictionary doesn't hold it
    "zqx and i": "unknown_word",
    "Dr. Zqx is fine. Rev. Zqx too": "unknown_word",  # too
    "": None,
}


def test_spelling(spark):
    df = spark.createDataFrame(list(enumerate(SPELLED)), "id long, text string")
    got = {r["id"]: r["reason"] for r in dictionary.spelling_reasons(df, words_table(spark)).collect()}
    assert [got.get(i) for i in range(len(SPELLED))] == list(SPELLED.values())


def test_pregate(spark):
    rows = [("Sure! Here is zqx and more of it all.", False, None, False), ("The zqx was fine and all of us walk.", False, None, False), ("The house was fine and all of us walk.", True, "length", False), ("The house was fine and all of us walk.", True, "stop", True), ("The house was fine and all of us.\nBob", True, "stop", True), ("The house was fine and all of us walk.", False, "length", True)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id long, text string, draft boolean, finish string, closing boolean")
    got = gate.pregate_reasons(df, words_table(spark), "id", "text", None, F.col("draft"), F.col("finish"), F.col("closing")).orderBy("id").collect()
    assert [r["reason"] for r in got] == ["wrapper_preamble", "unknown_word", "truncated", "no_signoff", None, None]


def test_pairs(spark):
    good = "The house was fine and all of us walk home."
    cases = [
        (good, good.replace("walk", "wlak"), None),
        ("The house was fine.", "The huose was fine.", "word_count"),
        (good, good, "edit_count"),
        (good, good.replace("house", "tower"), "edit_type"),
        (good.replace("fine", "zqx"), good.replace("fine", "zqx").replace("walk", "wlak"), "clean_unknown_word"),
        (good.replace("fine", "recieved"), good.replace("fine", "recieved").replace("walk", "wlak"), "clean_known_error"),
        (good + "\n12 Main Street", good.replace("walk", "wlak") + "\n12 Main Street", "pii_street"),
        (good.replace("house", "bomb"), good.replace("house", "bomb").replace("walk", "wlak"), "sensitive"),
        (good.replace("house", "bombs,"), good.replace("house", "bombs"), "sensitive"),
        (None, good, "word_count"),
    ]
    df = spark.createDataFrame([(i, a, b) for i, (a, b, _) in enumerate(cases)], "id long, input string, output string")
    got = gate.pair_reasons(df, words_table(spark, ["bomb", "main", "street"]), ["bomb"]).orderBy("id").collect()
    assert [r["reason"] for r in got] == [c[2] for c in cases]


def test_described_edits_are_those_of_the_whole_diff():
    """Always where no word repeats; a whole diff may align repeated words otherwise, which is rare."""
    r, same = random.Random(5), 0
    for k in range(400):
        words = ["their", "house", "lose", "could", "have", "Bob", "walked", "x", "it's", "fine.", "Weird", "a", "lot", "morning"]
        text = " ".join(r.sample(words, r.randint(1, 14)) if k % 2 else r.choices(words, k=r.randint(1, 25)))
        chosen = E.chosen(E.places(text), E.Draws(k))
        whole, local = E.described(E.changes(text, E.with_edits(text, chosen))), E.described_edits(text, chosen)
        assert whole == local or k % 2 == 0
        same += whole == local
    assert same >= 390


@pytest.mark.parametrize("parts", [1, 7])
def test_running_values(spark, parts):
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    r = random.Random(1)
    rows = [(i, r.choice("aab"), r.randint(-9, 9)) for i in range(400)]
    df = spark.createDataFrame(rows, "i long, g string, x int").repartition(5)
    got = Ordered(df, ["i"], "g").running("s", F.col("x"), F.sum, added).running("m", F.col("x"), F.min, F.least, before=True).next("n", "x").result().collect()
    last, sums, least = {}, {}, {}
    want = {}
    for i, g, x in rows:
        sums[g] = sums.get(g, 0) + x
        want[i] = [sums[g], least.get(g), None]
        least[g] = min(x, least.get(g, x))
        if g in last:
            want[last[g]][2] = x
        last[g] = i
    assert {t["i"]: [t["s"], t["m"], t["n"]] for t in got} == want
    spark.conf.set("spark.sql.shuffle.partitions", 4)


def test_quota_without_groups(spark):
    r = random.Random(2)
    rows = [(i, r.random() < 0.5) for i in range(300)]
    kept, political, want = 0, 0, {}
    for i, lim in rows:
        want[i] = not (lim and political + 1 > 0.25 * (kept + 1))
        political, kept = political + (lim and want[i]), kept + want[i]
    got = select.quota_kept(spark.createDataFrame(rows, "i long, lim boolean").repartition(3), F.col("lim"), "i", 0.25).collect()
    assert {t["i"]: t["kept"] for t in got} == want


def test_sources_in_turn(spark):
    r = random.Random(3)
    rows = [(i, r.choice("abc"), r.choice(["One two", "one  TWO", "x", "y", "z", "w", "v"]), r.random() < 0.2) for i in range(200)]
    df = spark.createDataFrame(rows, "i long, source string, text string, bad boolean")
    picks, report = select.selected(df, ["b", "a", "none"], 4, "i", F.when(F.col("bad"), "bad"))
    seen, want, counts = set(), [], {}
    for s in ("b", "a"):
        taken = 0
        for i, source, text, bad in rows:
            if source != s or taken >= 4:
                continue
            norm = " ".join(text.lower().split())
            stage = "bad" if bad else "duplicate" if norm in seen else "kept"
            for key in ("fetched", stage):
                counts[s, key] = counts.get((s, key), 0) + 1
            if stage == "kept":
                seen.add(norm)
                taken += 1
                want.append((i, len(want) + 1))
    assert [(t["i"], t["number"]) for t in picks.orderBy("number").collect()] == want
    assert {(t["source"], t["stage"]): t["n"] for t in report.collect()} == counts


def test_phrases_of_several_words(spark):
    df = spark.createDataFrame([(1, "A lot of It’s deep-seated; bear in mind, bear in mindful. It's x_a lot a  lot")], "id long, text string")
    lex = spark.createDataFrame([("a lot", "alot"), ("it's", "its"), ("deep-seated", "d"), ("bear in mind", "b"), ("a", "an")], "phrase string, wrong string")
    got = sorted((r["start"], r["end"], r["phrase"]) for r in noise.lexicon_matches(df, "id", "text", lex).collect())
    assert got == [(0, 1, "a"), (0, 5, "a lot"), (9, 13, "it's"), (14, 25, "deep-seated"), (27, 39, "bear in mind"), (58, 62, "it's"), (71, 72, "a")]


def test_sets_against_all_pairs(spark):
    r = random.Random(4)
    pool = [f"w{min(r.randrange(60), r.randrange(60))}" for _ in range(3000)]
    texts = []
    for i in range(150):
        w = [pool[r.randrange(3000)] for _ in range(r.randint(1, 14))]
        texts += [(3 * i, " ".join(w)), (3 * i + 1, " ".join(w[: max(1, len(w) - r.randint(0, 2))]))] + ([(3 * i + 2, " ".join([*w, f"only{i}"]))] if i % 2 else [])
    sets = {i: frozenset(t.split()) for i, t in texts}
    reps = {s: min(i for i in sets if sets[i] == s) for s in sets.values()}
    near = sorted((a, b) for x, a in reps.items() for y, b in reps.items() if a < b and 5 * len(x & y) >= 4 * len(x | y))
    df = spark.createDataFrame(texts, "id long, text string")
    assert sorted(map(tuple, similarity.near_pairs(df, "id", "text").collect())) == near and len(near) > 50
    some = spark.createDataFrame([t for t in texts if t[0] % 5 == 0], "other long, text string")
    want = {i: min((o for o, _ in texts if o % 5 == 0 and 5 * len(sets[o] & s) >= 4 * len(sets[o] | s)), default=None) for i, s in sets.items()}
    assert {r["id"]: r["match"] for r in similarity.first_near(df, some, "id", "text", "other", "text").collect()} == want


def test_personal_data_screen_loses_nothing(spark):
    texts = ["write to a.b@c.example.org", "fe80::1 x", "dead:beef:a:b:c:d:e:f x", "WWW.x.example", "a::b", "plain words only: yes", "12 Main\nStreet", "202-\n555-0170"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, t string")
    c = F.col("t")
    got = [tuple(r) for r in df.orderBy("i").select(rules.pii_reason(c), rules.pii_reason_any(c)).collect()]
    assert all(a is None or a == b for a, b in got) and got[5] == (None, None) and got[6][1] == "street" and got[7][1] == "phone"


def test_token_sets_fold_as_python_does(spark):
    texts = ["ＡＢＣ ｆｕｌｌ １２", "ﬁne oﬀ ĳs", "Σίσυφος ΣΊΣΥΦΟΣ", "ſtraße STRASSE ŉo", "µ ª º ²x", "Привет МИР ё", "Ǆabc ǆ", "İstanbul", "don’t ´s", "ﾊﾛｰ ㍿", "naïve Éa", "plain Words"]
    apostrophes = str.maketrans(dict.fromkeys("’‘ʼ`´", "'"))
    want = [sorted(set(re.findall(r"[^\W_]+(?:'[^\W_]+)*", unicodedata.normalize("NFKC", t.translate(apostrophes)).casefold()))) for t in texts]
    df = spark.createDataFrame(list(enumerate(texts)), "i long, t string")
    got = [r[0] for r in df.orderBy("i").select(T.token_set(F.col("t"))).collect()]
    assert [i for i in range(len(texts)) if got[i] != want[i]] == [9]  # one sign that stands for several letters


def test_memorised(spark):
    text = " ".join(f"w{i}" for i in range(30))
    df = spark.createDataFrame([("1", text), ("2", text), ("3", text)], "id string, t string")
    client = lambda: lambda i, prompt: {"1": " ".join(f"W{k}" for k in range(7, 16)), "2": prompt}[i]
    got = sorted(map(tuple, judge.memorised(df, "id", "t", client).collect()))
    assert got == [("1", True, None), ("2", False, None), ("3", None, "KeyError")]


def test_rewrites(spark):
    df = spark.createDataFrame([("1", "one two", "MIT"), ("2", "one two", "leaked"), ("3", "x", None)], "id string, t string, l string")
    client = lambda: lambda i, text: {"1": "one tow", "2": "one two"}[i]
    got = {r["id"]: r for r in judge.rewrites(df, "id", "t", "l", client).collect()}
    assert (got["1"]["human"], got["1"]["input"], got["1"]["output"], got["1"]["changed"], got["1"]["word_edits"]) == (False, "one two", "one tow", True, 1)
    assert (got["2"]["human"], got["2"]["input"], got["2"]["output"], got["2"]["changed"]) == (True, None, None, False)
    assert got["3"]["error"] == "KeyError" and got["3"]["output"] is None
    assert all(r["input"] is None for r in judge.rewrites(df, "id", "t", "l", client, private=True).collect())
