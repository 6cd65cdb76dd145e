"""Dictionary checks as joins: tokens against a table of words, with simple inflections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions import fixed
from quern.functions.rules import ocr_shape_reason
from quern.functions.text import straight
from quern.sources.scratch import materialised

TOKEN = rf"{fixed.ALNUM}+(?:'{fixed.ALNUM}+)*"


def stems(word: Column) -> Column:
    """The word, without a possessive, and with each inflection undone that leaves more than two characters."""
    bases = F.filter(F.array(word, F.when(word.rlike("'s$"), F.regexp_replace(word, "'s$", "")).when(word.rlike("'$"), F.regexp_replace(word, "'$", ""))), lambda x: x.isNotNull())

    def undo(suffix: str, restored: str) -> Column:
        return F.transform(bases, lambda b: F.when(b.endswith(suffix) & (F.length(b) > len(suffix) + 2), F.concat(F.substring(b, F.lit(1), F.length(b) - len(suffix)), F.lit(restored))))

    return F.array_distinct(F.filter(F.concat(bases, *[undo(s, r) for s, r in fixed.INFLECTIONS]), lambda x: x.isNotNull()))


#: Stands before a token that opens a sentence; no token holds it.
_MARK = "\ue000"
_OPENS = rf"(?:\A|(?<=[.!?\n])(?<!\b(?:{'|'.join(fixed.HONORIFICS)})\.))([ \t\"'“‘”’()\[\]]*)"


def _blanked(c: Column) -> Column:
    return F.regexp_replace(straight(c), fixed.DOTTED, " ")


def tokens(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, pos, token) of every word token, dotted abbreviations blanked."""
    return df.select(F.col(id_col).alias("id"), F.posexplode(F.regexp_extract_all(_blanked(F.col(text_col)), F.lit(f"({TOKEN})"), F.lit(1))).alias("pos", "token"))


def opening_tokens(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, pos, token, opens): opens tells whether a token starts a sentence or line; the period of an honorific ends none."""
    text = F.regexp_replace(_blanked(F.replace(F.col(text_col), F.lit(_MARK), F.lit(" "))), _OPENS, f"$1{_MARK}")
    every = df.select(F.col(id_col).alias("id"), F.posexplode(F.regexp_extract_all(text, F.lit(f"({_MARK}?{TOKEN})"), F.lit(1))).alias("pos", "t"))
    return every.select("id", "pos", F.ltrim("t", F.lit(_MARK)).alias("token"), F.col("t").startswith(_MARK).alias("opens"))


def known_words(vocabulary: DataFrame, dictionary: DataFrame) -> DataFrame:
    """The distinct tokens of vocabulary (token) that the dictionary (word) knows."""
    own = vocabulary.select("token").distinct()
    return own.select("token", F.explode(stems(F.col("token"))).alias("word")).join(dictionary.select("word").distinct(), "word", "left_semi").select("token").distinct()


def _is_lower(c: Column) -> Column:
    return (c == F.lower(c)) & (c != F.upper(c))


#: Distinct words of at most so many rows are broadcast, so that the tokens of texts stay where they are; more are joined by a shuffle.
SMALL = 500_000


def _without_known(vocabulary: DataFrame, dictionary: DataFrame) -> DataFrame:
    """The tokens of vocabulary that the dictionary doesn't know: a table of the vocabulary's size, not of the texts'."""
    own = vocabulary.select("token")
    return materialised(own.join(known_words(own, dictionary), "token", "left_anti"))


def _counted(rows: DataFrame, word: str) -> DataFrame:
    """(word, n) of every word of the rows; what follows reads it, not the texts."""
    return materialised(rows.filter(F.col(word).isNotNull()).groupBy(word).agg(F.count("*").alias("n")))


def _sifted(rows: DataFrame, word: str, counted: DataFrame, missing: DataFrame) -> DataFrame:
    """Where too many words are missing to be broadcast: rows without those of the most frequent words that are not, SMALL at most, which are most rows of texts and so need no shuffle."""
    if missing.count() <= SMALL:
        return rows
    log = F.floor(F.log2("n") * 8).cast("int")
    found, least, total = materialised(counted.join(missing.select(word), word, "left_anti")), None, 0
    for r in sorted(found.groupBy(log.alias("log")).count().collect(), key=lambda r: -r["log"]):
        total += r["count"]
        if total > SMALL:
            break
        least = r["log"]
    return rows if least is None else rows.join(F.broadcast(found.filter(log >= least).select(word)), word, "left_anti")


def _sized(words: DataFrame) -> DataFrame:
    return F.broadcast(words) if words.count() <= SMALL else words


def unknown_words(df: DataFrame, dictionary: DataFrame, id_col: str = "id", text_col: str = "text") -> DataFrame:
    """(id, words): the lower-case words without digits that the dictionary doesn't know, in order; rows without any are left out."""
    own = tokens(df, id_col, text_col).filter(_is_lower(F.col("token")) & ~F.col("token").rlike(r"\d"))
    counted = _counted(own, "token")
    unknown = _without_known(counted, dictionary)
    missing = _sifted(own, "token", counted, unknown).join(_sized(unknown), "token", "left_semi")
    return missing.groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "token"))), lambda x: x["token"]).alias("words"))


def spelling_reasons(df: DataFrame, dictionary: DataFrame, id_col: str = "id", text_col: str = "text") -> DataFrame:
    """(id, reason): the first failing token's reason; rows that pass are left out.

    Lower-case words are looked up as they are. A word with a capital is looked up only where it opens a
    sentence, as it is and in lower case; elsewhere it is a name, and words all in capitals are
    acronyms. Words with digits pass.
    """
    own = opening_tokens(df, id_col, text_col).filter(~F.col("token").rlike(r"\d"))
    t = F.col("token")
    slip = F.when(t == "i", "lowercase_i").when(F.lower(t).isin(fixed.CASUAL), "missing_apostrophe").when(t.isin(fixed.TEXTSPEAK), "textspeak")
    capitals = (F.length(t) > 1) & (t == F.upper(t)) & (t != F.lower(t))
    checked = _is_lower(t) | F.col("opens") & ~capitals
    asked = own.select("id", "pos", "token", slip.alias("slip"), F.when(checked & slip.isNull(), t).alias("word")).filter("slip IS NOT NULL OR word IS NOT NULL")
    vocabulary = _counted(asked, "word")
    forms = vocabulary.select("word", F.explode(F.array_distinct(F.array("word", F.lower("word")))).alias("token"))
    known = forms.join(known_words(forms, dictionary), "token", "left_semi").select("word").distinct()
    unknown = materialised(vocabulary.select("word").join(known, "word", "left_anti")).withColumn("unknown", F.lit(True))
    judged = _sifted(asked, "word", vocabulary, unknown).join(_sized(unknown), "word", "left")
    reason = F.coalesce("slip", F.when(F.col("unknown"), "unknown_word"))
    return judged.withColumn("reason", reason).filter("reason IS NOT NULL").groupBy("id").agg(F.min_by("reason", "pos").alias("reason"))


def run_together(df: DataFrame, dictionary: DataFrame, id_col: str = "id", text_col: str = "text") -> DataFrame:
    """(id): rows with an unknown lower-case word of at least five letters that is two known words, each of two letters or more."""
    words = df.select(F.col(id_col).alias("id"), F.explode(F.array_distinct(F.regexp_extract_all(F.col(text_col), F.lit(f"({fixed.LETTER}+)"), F.lit(1)))).alias("token"))
    words = words.filter((F.length("token") >= 5) & _is_lower(F.col("token")))
    dictionary = materialised(dictionary.select("word").distinct())  # looked up twice
    odd = _without_known(materialised(words.select("token").distinct()), dictionary)
    cut = odd.select("token", F.explode(F.sequence(F.lit(2), F.length("token") - 2)).alias("i"))
    cut = cut.select("token", F.substring("token", F.lit(1), F.col("i")).alias("left"), F.substring("token", F.col("i") + 1, F.length("token")).alias("right"))
    known = known_words(cut.select(F.explode(F.array("left", "right")).alias("token")), dictionary)
    both = cut.join(known.select(F.col("token").alias("left")), "left", "left_semi").join(known.select(F.col("token").alias("right")), "right", "left_semi")
    return words.join(_sized(materialised(both.select("token").distinct())), "token", "left_semi").select("id").distinct()


def ocr_reasons(df: DataFrame, dictionary: DataFrame, id_col: str = "id", text_col: str = "text") -> DataFrame:
    """(id, reason): the first that applies of a line break after a hyphen, a digit inside a word, and words run together; null for none."""
    shape = df.select(F.col(id_col).alias("id"), ocr_shape_reason(F.col(text_col)).alias("shape"))
    joined = run_together(df, dictionary, id_col, text_col).withColumn("joined", F.lit("ocr_run_together"))
    return shape.join(joined, "id", "left").select("id", F.coalesce("shape", "joined").alias("reason"))
