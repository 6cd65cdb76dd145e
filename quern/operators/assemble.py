"""Training rows: unions, anti-joins, guards and chat records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions import fixed
from quern.functions.text import estimated_tokens, uniform
from quern.operators.ordered import Ordered


def crossed(questions: DataFrame, answers: DataFrame) -> DataFrame:
    """Every question with every answer of its kind: an equi-join, as each kind's table is small and fixed."""
    return questions.join(answers, "kind")


def sampled_pairs(pairs: DataFrame, key: list[str], seed: str, k: int) -> DataFrame:
    """k distinct pairs by hash; an error if there are fewer."""
    n = pairs.count()
    if k > n:
        raise ValueError(f"{k} rows are wanted and there are {n}")
    return pairs.withColumn("__u", uniform(seed, *map(F.col, key))).orderBy("__u", *key).limit(k).drop("__u")


def repeated(df: DataFrame, times: int) -> DataFrame:
    return df.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(times))))


def unseen_pairs(pairs: DataFrame, taken: DataFrame, order: str) -> DataFrame:
    """The first row of each (input, output) that taken doesn't have."""
    new = pairs.join(taken.select("input", "output").distinct(), ["input", "output"], "left_anti")
    names = [c for c in pairs.columns]
    return new.groupBy("input", "output").agg(F.min_by(F.struct(*names), order).alias("__row")).select("__row.*")


def united(*tables: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def barren(seeds: DataFrame, tasks: DataFrame) -> DataFrame:
    """Distinct seed texts that no task row has as its input."""
    return seeds.select("text").subtract(tasks.select(F.col("input").alias("text")))


def chat_messages(system: str, user: Column, instruction: Column, output: Column) -> Column:
    """The three messages of a record; the user's is the input, or the instruction where that is empty."""
    said = F.coalesce(F.nullif(user, F.lit("")), F.nullif(instruction, F.lit("")))
    return F.array(*[F.struct(F.lit(r).alias("role"), c.alias("content")) for r, c in (("system", F.lit(system)), ("user", said), ("assistant", output))])


def unusable(df: DataFrame) -> DataFrame:
    """Rows with neither input nor instruction."""
    return df.filter((F.coalesce("input", F.lit("")) == "") & (F.coalesce("instruction", F.lit("")) == ""))


def checked_usable(df: DataFrame, id_col: str) -> DataFrame:
    """df; reading an unusable row raises an error that names its id, never its text."""
    bad = (F.coalesce("input", F.lit("")) == "") & (F.coalesce("instruction", F.lit("")) == "")
    return df.withColumn("input", F.when(bad, F.raise_error(F.concat(F.lit("no input and no instruction: "), F.col(id_col).cast("string")))).otherwise(F.col("input")))


def short_enough(df: DataFrame, *texts: str, limit: int = fixed.TOKEN_LIMIT) -> DataFrame:
    return df.filter(estimated_tokens(F.concat(*[F.coalesce(F.col(c), F.lit("")) for c in texts])) <= limit)


def length_guarded(df: DataFrame, tokens: Column, limit: int, most: float = 0.01) -> DataFrame:
    """Rows of at most limit tokens; an error if more than a share of most is longer."""
    total = df.agg(F.count("*").alias("n"), F.count_if(tokens > limit).alias("over")).first()
    if total["over"] > most * total["n"]:
        raise ValueError(f"{total['over']} of {total['n']} rows are over {limit} tokens")
    return df.filter(tokens <= limit)


def next_in_order(df: DataFrame, order: str, value: str) -> DataFrame:
    """df with next: the value of the next row, the first row's for the last."""
    first = df.agg(F.min_by(value, order)).first()[0]
    return Ordered(df, [order]).next("next", value).result().withColumn("next", F.coalesce("next", F.lit(first)))
