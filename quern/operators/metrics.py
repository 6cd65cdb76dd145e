"""Scores of rewrites, summaries, verdict caches and memorisation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions import fixed
from quern.functions.text import identity_ok, signoff_line, words
from quern.sources.scratch import materialised


def breaks(c: Column) -> Column:
    return F.size(F.split(c, "\n", -1)) - 1


def score_columns(text: Column, output: Column, edits: Column) -> dict[str, Column]:
    """The scores of a rewrite; edits is its number of word edits."""
    closing = signoff_line(text)
    return {
        "changed": output != text,
        "word_edits": edits.cast("long"),
        "whitespace_only": (output != text) & (edits == 0),
        "lines_kept": breaks(text) == breaks(output),
        "signoff_kept": F.when(closing.isNotNull(), signoff_line(output).eqNullSafe(closing)),
        "length_ratio": F.when(F.length(text) > 0, F.length(output) / F.length(text)).otherwise(0.0),
    }


def scored(df: DataFrame, text: str, output: str, edits: Column) -> DataFrame:
    return df.withColumns(score_columns(F.col(text), F.col(output), edits))


def summary_columns() -> list[Column]:
    """Rates and counts over scores; a rate over nothing is zero; four places, half to even."""

    def rate(part: Column, whole: Column) -> Column:
        return F.when(whole > 0, F.bround(part / whole, 4)).otherwise(0.0)

    n, worded = F.count("*"), F.col("changed") & ~F.col("whitespace_only")
    closing = F.count_if(F.col("signoff_kept").isNotNull())
    return [
        n.alias("n"),
        rate(F.count_if("changed"), n).alias("changed"),
        rate(F.count_if(worded & F.col("word_edits").between(1, 3)), F.count_if(worded)).alias("one_to_three_edits"),
        F.count_if("whitespace_only").alias("whitespace_only"),
        rate(F.count_if("lines_kept"), n).alias("lines_kept"),
        rate(F.count_if("signoff_kept"), closing).alias("signoff_kept"),
        closing.alias("with_signoff"),
        F.when(n > 0, F.bround(F.avg("length_ratio"), 4)).otherwise(0.0).alias("mean_length_ratio"),
    ]


def summary(scores: DataFrame) -> DataFrame:
    return scores.agg(*summary_columns())


def segments(scores: DataFrame, by: str) -> DataFrame:
    """The summary of all rows and of each value of a column, in one pass over grouping sets; segment is all or the value."""
    rolled = scores.rollup(by).agg(F.grouping(by).alias("__all"), *summary_columns())
    return rolled.withColumn("segment", F.when(F.col("__all") == 1, "all").otherwise(F.col(by).cast("string"))).drop("__all", by)


def redacted(df: DataFrame, license_col: str, texts: list[str], private: bool = False) -> DataFrame:
    """df with human, and with the texts of human rows taken out. private: all rows come from a private file, so all are human."""
    human = F.lit(True) if private else F.coalesce(F.col(license_col).isin(*fixed.HUMAN_LICENSES), F.lit(False))
    return df.withColumns({"human": human} | {c: F.when(~human, F.col(c)) for c in texts})


def cached_verdicts(df: DataFrame, cache: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """df with verdict (null for a text never judged) and drifted (judged with another text)."""
    own = cache.select(F.col("id").alias("__id"), "sha256", "verdict")
    joined = df.join(own, F.col(id_col) == F.col("__id"), "left")
    drifted = F.col("sha256").isNotNull() & (F.sha2(F.col(text_col), 256) != F.col("sha256"))
    return joined.withColumn("drifted", drifted).drop("__id", "sha256")


def strict_verdicts(df: DataFrame, cache: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Like cached_verdicts, but a drifted text raises an error with its id."""
    out = cached_verdicts(df, cache, id_col, text_col)
    return out.withColumn("verdict", F.when(F.col("drifted"), F.raise_error(F.concat(F.col(id_col).cast("string"), F.lit(": text differs from the judged text")))).otherwise(F.col("verdict"))).drop("drifted")


def calibration(df: DataFrame, suite: str, verdict: str) -> DataFrame:
    """yes, no, unparsed and their number by suite."""
    v = F.col(verdict)
    return df.groupBy(suite).agg(F.count("*").alias("n"), F.count_if(v).alias("yes"), F.count_if(~v).alias("no"), F.count_if(v.isNull()).alias("unparsed"))


def runs(c: Column, n: int) -> Column:
    """All runs of n words, in lower case. The words are bound to a lambda's variable, so they are split once."""
    every = lambda w: F.transform(F.sequence(F.lit(1), F.size(w) - n + 1), lambda i: F.array_join(F.slice(w, i, F.lit(n)), " "))
    return F.flatten(F.transform(F.array(words(F.lower(c))), lambda w: F.when(F.size(w) >= n, every(w)).otherwise(F.array().cast("array<string>"))))


#: Rows that are broadcast at most.
SMALL = 200_000


def verbatim(df: DataFrame, others: DataFrame, id_col: str, text_col: str, other_id: str, other_text: str, n: int) -> DataFrame:
    """(id, other_id): rows that share a run of n words with another table's row, by an equi-join on distinct runs.

    Up to SMALL runs of the other table are broadcast, so the runs of df stay where they are.
    """
    a = df.select(F.col(id_col).alias("id"), F.explode(F.array_distinct(runs(F.col(text_col), n))).alias("run"))
    b = materialised(others.select(F.col(other_id).alias("other_id"), F.explode(F.array_distinct(runs(F.col(other_text), n))).alias("run")))
    return a.join(F.broadcast(b) if b.count() <= SMALL else b, "run").select("id", "other_id").distinct()


def continues(continuation: Column, text: Column, prefix_words: int, n: int) -> Column:
    """Whether a continuation has a run of n words of what follows the text's first words."""
    rest = F.array_join(F.slice(words(text), F.lit(prefix_words + 1), F.greatest(F.size(words(text)) - prefix_words, F.lit(0))), " ")
    return F.arrays_overlap(runs(continuation, n), runs(rest, n))


def passed(df: DataFrame, answer: str, product: str, by: list[str]) -> DataFrame:
    """(by, n, passed): answers that name the product and no other, in each group."""
    return df.groupBy(*by).agg(F.count("*").alias("n"), F.count_if(identity_ok(F.col(answer), product)).alias("passed"))
