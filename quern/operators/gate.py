"""The pre-gate and the filter of pairs: cheap rules first, joins and diffs only for what passes them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions import fixed, rules
from quern.functions.edits import diffed
from quern.functions.text import n_words
from quern.operators.dictionary import spelling_reasons
from quern.sources.scratch import materialised


def cheap_reason(c: Column, band: Column | None = None, max_chars: int = fixed.MAX_CHARS) -> Column:
    """Wrappers, known errors and lengths."""
    return F.coalesce(rules.wrapper_reason(c), rules.known_error_reason(c), rules.length_reason(c, band, max_chars))


def pregate_reasons(df: DataFrame, dictionary: DataFrame, id_col: str, text_col: str, band: Column | None = None, drafted: Column | None = None, finish: Column | None = None, needs_signoff: Column | None = None) -> DataFrame:
    """(id, reason) of every row: the first failing one of wrappers, known errors, lengths and spelling, then for drafts of cut and sign-off; null for none.

    drafted: whether a row is a draft; finish and needs_signoff are columns of drafts. Ids are unique.
    """
    c, null = F.col(text_col), F.lit(None).cast("string")
    draft = null if drafted is None else F.when(drafted, rules.draft_reason(c, null if finish is None else finish, F.lit(False) if needs_signoff is None else needs_signoff))
    rows = materialised(df.select(F.col(id_col).alias("id"), cheap_reason(c, band).alias("first"), draft.alias("draft"), c.alias("text")))
    spelled = spelling_reasons(rows.filter("first IS NULL"), dictionary).withColumnRenamed("reason", "spelled")
    return rows.join(spelled, "id", "left").select("id", F.coalesce("first", "spelled", "draft").alias("reason"))


def pair_reasons(pairs: DataFrame, dictionary: DataFrame, terms: Iterable[str], allow: Iterable[str] = (), id_col: str = "id", clean_col: str = "input", wrong_col: str = "output") -> DataFrame:
    """(id, reason) of every pair of a clean and a wrong text: the first failing rule, null for none.

    In this order: words of either side, number of changed words, their kinds, the clean side's pre-gate, and for
    the clean and then the wrong side personal data and sensitive terms. Ids are unique.
    """
    rows = pairs.select(F.col(id_col).alias("id"), F.col(clean_col).alias("clean"), F.col(wrong_col).alias("wrong"))
    fits = n_words(F.col("clean")).between(*fixed.PAIR_WORDS) & n_words(F.col("wrong")).between(*fixed.PAIR_WORDS)
    rows = rows.withColumn("fits", F.coalesce(fits, F.lit(False)))
    rows = rows.withColumn("d", diffed(F.when(F.col("fits"), F.col("clean")), F.when(F.col("fits"), F.col("wrong"))))
    first = F.when(~F.col("fits"), "word_count").when(~F.col("d.word_edits").between(*fixed.PAIR_EDITS), "edit_count").when(F.col("d.kinds").isNull(), "edit_type")
    judged = materialised(rows.select("id", "clean", "wrong", first.alias("first")))
    gated = _clean_side(judged, dictionary)
    sides = []
    for side in ("clean", "wrong"):
        sides += [F.concat(F.lit("pii_"), rules.pii_reason_any(F.col(side))), F.when(rules.sensitive_match(F.col(side), terms, allow).isNotNull(), "sensitive")]
    joined = judged.join(gated, "id", "left")
    open_ = F.col("first").isNull() & F.col("gate").isNull()
    return joined.select("id", F.coalesce("first", "gate", F.when(open_, F.coalesce(*sides))).alias("reason"))


def _clean_side(judged: DataFrame, dictionary: DataFrame) -> DataFrame:
    rows = judged.filter("first IS NULL").select("id", F.col("clean").alias("text"))
    cheap = rows.select("id", cheap_reason(F.col("text"), max_chars=fixed.PAIR_CHARS).alias("cheap"))
    spelled = spelling_reasons(rows, dictionary)
    return cheap.join(spelled, "id", "left").select("id", F.concat(F.lit("clean_"), F.coalesce("cheap", "reason")).alias("gate"))
