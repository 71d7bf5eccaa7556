"""Trees held as rows with the key of their parent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hemicycle.session import written


def roots(rows: DataFrame, key: str, parent: str) -> DataFrame:
    """(key, root, depth, in_cycle): the topmost ancestor of every row, by pointer doubling.

    In each round a row's pointer skips to where its target's points, so a chain of n rows takes log2(n) rounds and the
    driver learns one count a round. A parent that is no key counts as none. Rows of a cycle, and rows that lead to one, have
    no root: `in_cycle` is true, root and depth are null. Keys are unique; a null key is left out.
    """
    keys = rows.select(F.col(key).alias("key"), F.col(parent).alias("up")).filter("key IS NOT NULL")
    known = keys.select(F.col("key").alias("up"), F.lit(1).alias("known"))
    # a row at the top points at itself, no step away
    now = keys.join(known, "up", "left").select(
        "key", F.coalesce(F.when(F.col("known").isNotNull(), F.col("up")), F.col("key")).alias("at"), F.coalesce("known", F.lit(0)).cast("long").alias("steps")
    )
    now = written(now)
    n = now.count()
    moving, rounds = n, 0
    while moving and 1 << rounds <= 2 * n:
        target = now.select(F.col("key").alias("at"), F.col("at").alias("next"), F.col("steps").alias("more"))
        after = written(now.join(target, "at").select("key", F.col("next").alias("at"), (F.col("steps") + F.col("more")).alias("steps"), (F.col("more") > 0).alias("moved")))
        moving = after.filter("moved").count()
        now, rounds = after.drop("moved"), rounds + 1
    # what still moves after so many rounds has made more steps than there are rows
    tops = keys.join(known, "up", "left_anti").select(F.col("key").alias("at"), F.lit(True).alias("top"))
    ended: Column = F.col("top").isNotNull()
    return now.join(tops, "at", "left").select(
        "key", F.when(ended, F.col("at")).alias("root"), F.when(ended, F.col("steps")).alias("depth"), (~ended).alias("in_cycle")
    )


def rolled_up(rows: DataFrame, key: str, parent: str, value: Column, name: str = "total") -> DataFrame:
    """(key, total, members): for each row the sum of `value` over itself and all below it, and how many those are.

    In round k each row adds to the ancestor 2 ** k above it what the row has gathered from fewer than 2 ** k levels
    below. Nulls count as 0. Rows of a cycle and rows that lead to one count for themselves alone.
    """
    found = roots(rows, key, parent)
    fine = found.filter("NOT in_cycle").select("key", "depth")
    own = rows.filter(F.col(key).isNotNull()).select(F.col(key).alias("key"), F.col(parent).alias("up"), F.coalesce(value, F.lit(0)).alias("sum"))
    deepest = fine.agg(F.max("depth")).first()[0] or 0
    top = own.join(found.select("key", "depth"), "key")
    state = written(top.select("key", F.when(F.col("depth") > 0, F.col("up")).alias("up"), "sum", F.lit(1).cast("long").alias("members")))
    reach = 1
    while reach <= deepest:
        gathered = state.filter("up IS NOT NULL").groupBy("up").agg(F.sum("sum").alias("more"), F.sum("members").alias("others"))
        higher = state.select(F.col("key").alias("up"), F.col("up").alias("next"))
        state = state.join(gathered.withColumnRenamed("up", "key"), "key", "left").join(higher, "up", "left")
        state = written(state.select(
            "key", F.col("next").alias("up"), (F.col("sum") + F.coalesce("more", F.lit(0))).alias("sum"), (F.col("members") + F.coalesce("others", F.lit(0))).alias("members")
        ))
        reach *= 2
    return state.select("key", F.col("sum").alias(name), "members")
