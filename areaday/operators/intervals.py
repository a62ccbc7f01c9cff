"""Day ranges: which days lie in at least one of them."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from areaday.functions.dates import days_between, first_midnight


def flag_days(days: DataFrame, ranges: DataFrame, flags: dict[str, Column], bounds: DataFrame) -> DataFrame:
    """Add one boolean per flag to ``days``: does any range with that condition cover the date?

    Ranges run from ``start_date`` to ``end_date``, both instants and inclusive, a range without either covers nothing; a day counts by its midnight. A range
    counts one more from its first day within ``bounds`` (one row: ``lo``, ``hi``) and one less after its last, so it gives
    two rows however long it is. They are added up per day and then over the days, of which the bounds have few: the
    running sums need one task, and say how many ranges cover each stretch of days between two changes.
    """
    limit = bounds.select(F.struct("lo", "hi")).scalar()
    known = ranges.dropna(subset=["start_date", "end_date"])
    chosen = known.select("start_date", "end_date", *[F.coalesce(c, F.lit(False)).cast("int").alias(name) for name, c in flags.items()])
    marked = chosen.withColumn("_limit", limit).select(
        F.greatest(first_midnight(F.col("start_date")), F.col("_limit.lo")).alias("_first"),
        F.date_add(F.least(F.to_date("end_date"), F.col("_limit.hi")), 1).alias("_after"),
        *flags,
    )
    change = lambda date, sign: F.struct(F.col(date).alias("date"), *[(sign * F.col(name)).alias(name) for name in flags])
    changes = marked.filter(F.col("_first") < F.col("_after")).select(F.inline(F.array(change("_first", 1), change("_after", -1))))
    per_day = changes.groupBy("date").agg(*[F.sum(name).alias(name) for name in flags])
    in_order = Window.orderBy("date")
    stretches = per_day.select(
        "date", F.lead("date").over(in_order).alias("_next"), *[(F.sum(name).over(in_order) > 0).alias(name) for name in flags]
    )
    any_flag = reduce(or_, [F.col(name) for name in flags])
    spread = stretches.filter(any_flag).select(F.explode(days_between(F.col("date"), F.date_sub("_next", 1))).alias("date"), *flags)
    joined = days.join(F.broadcast(spread), "date", "left")
    return joined.withColumns({name: F.coalesce(name, F.lit(False)) for name in flags})
