"""Joins of moments with the periods that hold them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Days of a bucket; a period lies in one bucket more than it is long.
BUCKET_DAYS = 64


def _bucket(day: Column) -> Column:
    return F.floor(F.datediff(day, F.lit("1970-01-01")) / BUCKET_DAYS)


def within_period(
    moments: DataFrame, periods: DataFrame, on: Sequence[str], at: str, start: str, end: str, how: str = "left"
) -> DataFrame:
    """Each row of `moments` with the rows of `periods` that have its keys and hold its day, both ends included.

    A period without an end goes on for ever, and one without a start has always been; a null day is in no period. Days
    are cut into buckets: a period has a row for each bucket from its start to its end, and the join is one of equal keys
    and buckets with the range checked on what meets, so a key with very many periods meets a moment with a few of them.
    Open ends are drawn to the first and last day of the moments, so that their rows stay finite. Columns other than `on`
    must differ.
    """
    day = F.to_date(at)
    known = moments.agg(F.min(day).alias("first"), F.max(day).alias("last")).first()
    if known["first"] is None:
        first = last = F.lit("1970-01-01").cast("date")
    else:
        first, last = F.lit(known["first"]), F.lit(known["last"])
    low = F.greatest(F.coalesce(F.to_date(start), first), first)
    high = F.least(F.coalesce(F.to_date(end), last), last)
    own = periods.withColumn("_low", low).withColumn("_high", high).filter("_low <= _high")
    own = own.withColumn("_bucket", F.explode(F.sequence(_bucket(F.col("_low")), _bucket(F.col("_high")))))
    ours = moments.withColumn("_bucket", _bucket(day))
    keys = [*on, "_bucket"]
    renamed = own.select(*(F.col(c).alias(f"_of_{c}") if c in keys else F.col(c) for c in own.columns))
    same = (day >= F.col("_low")) & (day <= F.col("_high"))
    for k in keys:
        same = same & (F.col(k) == F.col(f"_of_{k}"))
    found = ours.join(renamed, same, how)
    return found.drop("_bucket", "_low", "_high", *(f"_of_{k}" for k in keys))


def latest_before(moments: DataFrame, states: DataFrame, on: Sequence[str], at: str, since: str, tie_break: Sequence[str]) -> DataFrame:
    """Each row of `moments` with the latest row of `states` of its keys that began on its day or before, if any.

    Of states that begin on one day the last by `tie_break` holds. States are cut to one a key and day, each ends on the day
    before the next, and `within_period` joins the two.
    """
    day = F.to_date(since)
    last = Window.partitionBy(*on, day).orderBy(*[F.col(c).desc_nulls_last() for c in tie_break])
    one = states.filter(day.isNotNull()).withColumn("_rank", F.row_number().over(last)).filter("_rank = 1").drop("_rank")
    following = F.lead(day).over(Window.partitionBy(*on).orderBy(day))
    one = one.withColumn("_until", F.date_sub(following, 1))
    return within_period(moments, one, on, at, since, "_until").drop("_until")
