"""Model calls inside plans: a callable for each partition over Arrow batches, with errors caught by type."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.functions import fixed
from quern.functions.edits import diffed
from quern.functions.text import cleanliness_verdict, meaning_verdict, words
from quern.operators.metrics import continues, redacted, scored, strict_verdicts


def judge_messages(text: str) -> list[dict[str, str]]:
    return [{"role": "system", "content": fixed.JUDGE_SYSTEM}, {"role": "user", "content": f'{fixed.JUDGE_QUESTION}\n\nText:\n"""\n{text}\n"""\n\nAnswer yes or no.'}]


def asked(df: DataFrame, id_col: str, text_col: str, client: Callable[[], Callable[[str, str], str]]) -> DataFrame:
    """(id, reply, error): client() gives, once a partition, a callable (id, text) -> reply; an error keeps its type's name only."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ask = client()
        for b in batches:
            replies, errors = [], []
            for i, text in zip(b["id"], b["text"]):
                try:
                    replies.append(ask(str(i), text)), errors.append(None)
                except Exception as e:  # noqa: BLE001
                    replies.append(None), errors.append(type(e).__name__)
            yield pd.DataFrame({"id": b["id"], "reply": replies, "error": errors})

    own = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return own.mapInPandas(run, f"id {own.schema['id'].dataType.simpleString()}, reply string, error string")


def cleanliness(df: DataFrame, cache: DataFrame, id_col: str, text_col: str, client: Callable[[], Callable[[str, str], str]]) -> DataFrame:
    """(id, sha256, verdict) of texts that the cache doesn't have: what to append to it. A text that changed since it was judged is an error."""
    missing = strict_verdicts(df, cache, id_col, text_col).filter("verdict IS NULL")
    replies = asked(missing, id_col, text_col, client).filter("error IS NULL")
    texts = df.select(F.col(id_col).alias("id"), F.sha2(text_col, 256).alias("sha256"))
    return replies.join(texts, "id").select("id", "sha256", cleanliness_verdict(F.col("reply")).alias("verdict"))


def meaning_messages(clean: str, wrong: str) -> list[dict[str, str]]:
    return [{"role": "user", "content": f"{fixed.MEANING_QUESTION}\n\nVersion A: {clean}\n\nVersion B: {wrong}"}]


def meanings(df: DataFrame, cache: DataFrame, id_col: str, clean_col: str, wrong_col: str, client: Callable[[], Callable[[str, str], str]]) -> DataFrame:
    """(id, sha256, verdict, error) of the pairs that the cache (id, sha256, verdict) doesn't have: verdict is true where the wrong text says the same, null where the reply says neither.

    client gives, once a partition, a callable (id, prompt) -> reply. A pair whose texts changed since it was judged is an error.
    """
    prompt = F.concat(F.lit(fixed.MEANING_QUESTION + "\n\nVersion A: "), F.col(clean_col), F.lit("\n\nVersion B: "), F.col(wrong_col))
    rows = df.select(F.col(id_col).alias("id"), prompt.alias("text"))
    missing = strict_verdicts(rows, cache, "id", "text").filter("verdict IS NULL").select("id", "text")
    replies = asked(missing, "id", "text", client)
    return replies.join(rows, "id").select("id", F.sha2("text", 256).alias("sha256"), meaning_verdict(F.col("reply")).alias("verdict"), "error")


def rewrites(df: DataFrame, id_col: str, text_col: str, license_col: str, client: Callable[[], Callable[[str, str], str]], private: bool = False) -> DataFrame:
    """(id, human, input, output, scores..., error) of every text: a model's rewrite and its scores; texts of human rows are left out, and an error leaves only its type's name."""
    texts = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("input"), F.col(license_col).alias("license"))
    replies = asked(texts, "id", "input", client).withColumnRenamed("reply", "output")
    rows = texts.join(replies, "id")
    scores = scored(rows, "input", "output", diffed(F.col("input"), F.col("output"))["word_edits"])
    return redacted(scores, "license", ["input", "output"], private).drop("license")


def memorised(df: DataFrame, id_col: str, text_col: str, client: Callable[[], Callable[[str, str], str]], prefix_words: int = 5, run: int = 8) -> DataFrame:
    """(id, hit, error) of every text: whether a model that is given its first words goes on with a run of words of what follows them."""
    prefix = F.array_join(F.slice(words(F.col(text_col)), 1, prefix_words), " ")
    probes = df.select(F.col(id_col).alias("id"), F.concat(F.lit(fixed.PROBE), prefix).alias("text"))
    replies = asked(probes, "id", "text", client)
    texts = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("whole"))
    hit = F.coalesce(continues(F.col("reply"), F.col("whole"), prefix_words, run), F.lit(False))
    return replies.join(texts, "id").select("id", F.when(F.col("error").isNull(), hit).alias("hit"), "error")


def calibrated(yes_on_clean: float, no_on_mismatched: float) -> bool:
    return yes_on_clean >= fixed.CALIBRATED[0] and no_on_mismatched >= fixed.CALIBRATED[1]
