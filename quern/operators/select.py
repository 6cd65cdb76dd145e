"""Quotas, take-N with reports, samples and splits, as aggregates and running values over range partitions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.functions.text import collapsed, uniform
from quern.operators.ordered import Ordered, added
from quern.sources.scratch import materialised


def quota_kept(df: DataFrame, limited: Column, order: str, cap: float, by: str | None = None) -> DataFrame:
    """df with kept: in order, a limited row stays only if limited rows then are at most cap of all kept; others stay.

    With n others so far, m = floor(cap * n / (1 - cap)) may stand; the i-th limited row stays if
    i + min(0, running minimum of m - i) grows. by: a column whose groups have quotas of their own.
    """
    if cap >= 1:
        return df.withColumn("kept", F.lit(True))
    share = (F.lit(cap).cast("decimal(12,9)") / F.lit(1 - cap).cast("decimal(12,9)")).cast("double")
    rows = Ordered(df.withColumn("__lim", limited), [order], by)
    rows = rows.running("__n", F.when(F.col("__lim"), 0).otherwise(1), F.sum, added).running("__i", F.when(F.col("__lim"), 1).otherwise(0), F.sum, added)
    rows = rows.column("__room", F.when(F.col("__lim"), F.floor(F.col("__n") * share + 1e-9) - F.col("__i")))
    rows = rows.running("__low", F.col("__room"), F.min, F.least)
    rows = rows.column("__held", F.col("__i") + F.least(F.lit(0), F.coalesce("__low", F.lit(0))))
    rows = rows.running("__last", F.col("__held"), F.max, F.greatest, before=True)
    grew = F.col("__held") > F.coalesce("__last", F.lit(0))
    return rows.result().withColumn("kept", F.when(F.col("__lim"), grew).otherwise(True)).drop("__lim", "__n", "__i", "__room", "__low", "__held", "__last")


def first_of_group(df: DataFrame, group: str, order: str) -> DataFrame:
    """The first row of each group; map-side, without moving the rest of a hot group."""
    names = [c for c in df.columns]
    first = df.groupBy(group).agg(F.min_by(F.struct(*names), order).alias("__row"))
    return first.select("__row.*")


def take_by_hash(df: DataFrame, source: str, key: str, seed: str, want: int) -> DataFrame:
    """Of each source the want rows with the least hashes of (source, key); a hot source is cut before the shuffle by the window's limit."""
    w = Window.partitionBy(source).orderBy("__u", key)
    return df.withColumn("__u", uniform(seed, F.col(source), F.col(key))).withColumn("place", F.row_number().over(w)).filter(F.col("place") <= want).drop("__u")


def sampled(df: DataFrame, key: str, seed: str, k: int) -> DataFrame:
    """The k rows with the least hashes of their key."""
    return df.withColumn("__u", uniform(seed, F.col(key))).orderBy("__u", key).limit(k).drop("__u")


def selection_report(df: DataFrame, source: str, order: str, reason: str, want: int) -> DataFrame:
    """(source, fetched, kept, dropped) over the rows visited until the want-th accepted one."""
    rows = Ordered(df, [order], source).running("__before", F.when(F.col(reason).isNull(), 1).otherwise(0), F.sum, added, before=True)
    seen = rows.result().filter(F.coalesce("__before", F.lit(0)) < want)
    return seen.groupBy(source).agg(F.count("*").alias("fetched"), F.count_if(F.col(reason).isNull()).alias("kept"), F.count_if(F.col(reason).isNotNull()).alias("dropped"))


def selected(df: DataFrame, sources: list[str], want: int, order: str, reason: Column, source_col: str = "source", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Picks of each source in turn, and the report on the rows visited for them.

    A source's rows are visited in order until want of them are picked. A row is dropped for its reason,
    or as a duplicate if a row picked before, of this source or one before it, has the same words in lower case. Picks: the columns
    of df and number, which runs over all picks from 1. Report: (source, stage, n) with the stages
    fetched, kept, duplicate and each reason. sources is a short list of names; values of order are unique in a source.
    """
    norm = F.sha2(F.lower(collapsed(F.col(text_col))), 256)
    names, picks, reports = df.columns, [], []
    for rank, name in enumerate(sources):
        own = df.filter(F.col(source_col) == name).withColumns({"__reason": reason, "__norm": norm})
        rows = materialised(own)
        taken = reduce(DataFrame.unionByName, [p.select("__norm") for p in picks]).distinct().withColumn("__taken", F.lit(True)) if picks else None
        firsts = rows.filter("__reason IS NULL").groupBy("__norm").agg(F.min(order).alias("__first"))
        marked = rows.join(firsts, "__norm", "left")
        marked = marked.join(taken, "__norm", "left") if taken is not None else marked.withColumn("__taken", F.lit(None).cast("boolean"))
        again = F.col("__taken").isNotNull() | (F.col(order) > F.col("__first"))
        marked = marked.withColumn("__stage", F.coalesce("__reason", F.when(again, "duplicate"), F.lit("kept")))
        run = Ordered(marked, [order]).running("__before", F.when(F.col("__stage") == "kept", 1).otherwise(0), F.sum, added, before=True)
        seen = materialised(run.result().filter(F.coalesce("__before", F.lit(0)) < want).withColumn("__rank", F.lit(rank)))
        picks.append(seen.filter("__stage = 'kept'"))
        reports += [seen.groupBy(F.lit(name).alias("source"), F.col("__stage").alias("stage")).agg(F.count("*").alias("n")), seen.groupBy(F.lit(name).alias("source"), F.lit("fetched").alias("stage")).agg(F.count("*").alias("n"))]
    every = Ordered(reduce(DataFrame.unionByName, picks), ["__rank", order]).running("number", F.lit(1), F.sum, added)
    return every.result().select(*names, "number"), reduce(DataFrame.unionAll, reports)


#: Bits of the hash by which groups are counted before they are ranked.
_BIN_BITS = 16


def group_split(df: DataFrame, kind: str, key: str, ratio: float, seed: str, forced: Column | None = None) -> DataFrame:
    """df with split: groups of one key stay together; of each kind's k groups min(max(1, round(k * ratio)), k - 1) are valid, none for k <= 1.

    forced: groups with such a row go to train. Groups are ranked by a hash: a histogram over its first
    bits tells which ranks a bin holds, so a kind's groups are ranked bin by bin and not in one task.
    """
    if not 0 < ratio < 1:
        raise ValueError("ratio has to lie between 0 and 1")
    hold = F.max(F.coalesce(forced, F.lit(False))) if forced is not None else F.lit(False)
    groups = df.groupBy(kind, key).agg(hold.alias("__hold")).withColumn("__u", uniform(seed, F.col(kind), F.col(key)))
    groups = groups.withColumn("__bin", F.shiftright("__u", 60 - _BIN_BITS))
    bins = groups.filter(~F.col("__hold")).groupBy(kind, "__bin").agg(F.count("*").alias("__c"))
    own = Window.partitionBy(kind)  # at most 2^_BIN_BITS rows a kind
    bins = bins.withColumn("__k", F.sum("__c").over(own)).withColumn("__less", F.sum("__c").over(own.orderBy("__bin")) - F.col("__c"))
    n = F.when(F.col("__k") <= 1, 0).otherwise(F.least(F.greatest(F.bround(F.col("__k") * ratio), F.lit(1)), F.col("__k") - 1))
    bins = bins.select(kind, "__bin", (n - F.col("__less")).alias("__room"))
    rank = F.row_number().over(Window.partitionBy(kind, "__bin").orderBy(F.col("__hold").cast("int"), "__u", key))
    ranked = groups.withColumn("__rank", rank).join(bins, [kind, "__bin"], "left")
    split = F.when(~F.col("__hold") & (F.col("__rank") <= F.col("__room")), "valid").otherwise("train")
    return df.join(ranked.select(kind, key, split.alias("split")), [kind, key])
