"""Running sums, minima and maxima over an order of any length: range partitions, each scanned by itself, and what the partitions before hand on."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.sources.scratch import materialised

_PART = "__part"


class Ordered:
    """Rows in an order, within each value of by if it is given; no group and no table has to fit one task.

    Each running value needs one aggregate by (by, partition), whose rows are as many as partitions and
    groups together, and one window inside partitions.
    """

    def __init__(self, df: DataFrame, order: list[str], by: str | None = None) -> None:
        self.by, self.order = by, order
        keyed = df.withColumn("__by", F.col(by) if by else F.lit(0))
        ranged = keyed.repartitionByRange("__by", *order).withColumn(_PART, F.spark_partition_id())
        self.rows = materialised(ranged)

    def _inside(self, last: int) -> Window:
        return Window.partitionBy("__by", _PART).orderBy(*self.order).rowsBetween(Window.unboundedPreceding, last)

    def running(self, name: str, value: Column, aggregate: Callable[[Column], Column], join: Callable[[Column, Column], Column], before: bool = False) -> "Ordered":
        """Adds name: the aggregate of value over the rows up to each row (before: up to the one before), null where there are none; join puts two aggregates together."""
        own = self.rows.groupBy("__by", _PART).agg(aggregate(value).alias("__own"))
        earlier = Window.partitionBy("__by").orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
        carried = own.select("__by", _PART, aggregate(F.col("__own")).over(earlier).alias("__carried"))
        here = self.rows.withColumn("__here", aggregate(value).over(self._inside(-1 if before else 0)))
        both = F.coalesce(join(F.col("__carried"), F.col("__here")), "__carried", "__here")
        out = here.join(carried, ["__by", _PART]).withColumn(name, both).drop("__carried", "__here")
        return self._with(out)

    def _with(self, rows: DataFrame) -> "Ordered":
        new = object.__new__(Ordered)
        new.by, new.order, new.rows = self.by, self.order, rows
        return new

    def column(self, name: str, value: Column) -> "Ordered":
        return self._with(self.rows.withColumn(name, value))

    def next(self, name: str, value: str) -> "Ordered":
        """Adds name: the value of the row after, null for the last."""
        firsts = self.rows.groupBy("__by", _PART).agg(F.min_by(value, F.struct(*self.order)).alias("__first"))
        later = firsts.select("__by", _PART, F.lead("__first").over(Window.partitionBy("__by").orderBy(_PART)).alias("__later"))
        inside = Window.partitionBy("__by", _PART).orderBy(*self.order)
        ends = F.row_number().over(Window.partitionBy("__by", _PART).orderBy(*[F.col(c).desc() for c in self.order])) == 1
        here = self.rows.withColumn("__next", F.lead(value).over(inside)).withColumn("__ends", ends)
        out = here.join(later, ["__by", _PART]).withColumn(name, F.when(F.col("__ends"), F.col("__later")).otherwise(F.col("__next")))
        return self._with(out.drop("__later", "__next", "__ends"))

    def result(self) -> DataFrame:
        return self.rows.drop("__by", _PART)


def added(a: Column, b: Column) -> Column:
    return a + b
