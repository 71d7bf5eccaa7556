"""Periods, trees, levels and long text lists on awkward rows against plain Python."""

from __future__ import annotations

import random
import re
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from hemicycle.operators import aggregates, hierarchy, intervals

DAY = date(2024, 1, 1)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def days(n: int | None) -> date | None:
    return None if n is None else DAY + timedelta(days=n)


def test_moments_meet_the_periods_that_hold_them(spark):
    rng = random.Random(3)
    moments = [(i, rng.choice("abc"), days(rng.choice([None, *range(-400, 900, 13)]))) for i in range(300)]
    periods = []
    for i in range(200):
        start = rng.choice([None, *range(-900, 900, 7)])
        length = rng.choice([None, -3, 0, 1, 63, 64, 65, 700])
        periods.append((i, rng.choice(["a", "b", "d", None]), days(start), None if length is None else days((start or 0) + length)))
    m = spark.createDataFrame(moments, "m int, who string, day date")
    p = spark.createDataFrame(periods, "p int, who string, since date, till date")
    for how in ("left", "inner"):
        expected = []
        for i, who, day in moments:
            held = [k for k, other, a, z in periods if other == who and day and (a is None or a <= day) and (z is None or day <= z)]
            expected += [(i, who, day, k) for k in held] or ([(i, who, day, None)] if how == "left" else [])
        found = intervals.within_period(m, p, ["who"], "day", "since", "till", how)
        assert sorted(map(str, [(r.m, r.who, r.day, r.p) for r in found.collect()])) == sorted(map(str, expected))
        assert "NestedLoop" not in plan_of(found) and "Cartesian" not in plan_of(found)
    assert intervals.within_period(m.filter("m < 0"), p, ["who"], "day", "since", "till").count() == 0
    assert intervals.within_period(m, p.filter("p < 0"), ["who"], "day", "since", "till").count() == 300


def test_a_member_with_very_many_periods(spark):
    periods = spark.range(20_000).select(F.lit("hot").alias("who"), F.expr("date_add(DATE'2000-01-01', CAST(id AS INT))").alias("since"), F.col("id").alias("party"))
    votes = spark.range(5_000).select(F.lit("hot").alias("who"), F.expr("date_add(DATE'2000-01-01', CAST(id * 4 - 100 AS INT))").alias("day"), "id")
    found = intervals.latest_before(votes, periods, ["who"], "day", "since", ["party"])
    assert "NestedLoop" not in plan_of(found)
    rows = found.collect()
    assert len(rows) == 5_000
    assert all(r.party == (None if r.id * 4 < 100 else r.id * 4 - 100) for r in rows)


def test_latest_state_by_tie_break(spark):
    states = spark.createDataFrame([("a", days(0), "x", 1), ("a", days(0), "y", 2), ("a", days(5), "z", 1), ("a", None, "no", 9), (None, days(0), "n", 1)],
                                   "who string, since date, party string, n int")
    votes = spark.createDataFrame([(i, w, days(d)) for i, (w, d) in enumerate([("a", -1), ("a", 0), ("a", 4), ("a", 5), ("a", 99), ("b", 3), (None, 3), ("a", None)])], "i int, who string, day date")
    found = {r.i: r.party for r in intervals.latest_before(votes, states, ["who"], "day", "since", ["n"]).collect()}
    assert found == {0: None, 1: "y", 2: "y", 3: "z", 4: "z", 5: None, 6: None, 7: None}


def tree(rng: random.Random) -> list[tuple]:
    rows = [(i, None if i < 3 else rng.randrange(i) if i < 60 else i - 1, rng.choice([None, 1, 5, -2])) for i in range(150)]
    rows += [(200, 201, 1), (201, 202, 2), (202, 200, 3), (203, 202, 4), (204, 204, 5), (205, 999, 6), (206, 205, 7), (None, 1, 8)]
    return rows


def test_roots_depths_and_sums(spark):
    rows = tree(random.Random(4))
    parent = {k: p for k, p, _ in rows if k is not None}
    value = {k: v or 0 for k, _, v in rows if k is not None}

    def line(k):
        seen = [k]
        while parent.get(k) in parent and parent[k] is not None:
            k = parent[k]
            if k in seen:
                return None
            seen.append(k)
        return seen

    df = spark.createDataFrame(rows, "id int, up int, v int")
    lines = {k: line(k) for k in parent}
    expected = {k: (None, None, True) if x is None else (x[-1], len(x) - 1, False) for k, x in lines.items()}
    assert {r.key: (r.root, r.depth, r.in_cycle) for r in hierarchy.roots(df, "id", "up").collect()} == expected
    assert sum(e[2] for e in expected.values()) == 5 and max(e[1] or 0 for e in expected.values()) > 80
    below = {k: [j for j, x in lines.items() if x and k in x] if lines[k] else [k] for k in parent}
    sums = {k: (sum(value[j] for j in below[k]), len(below[k])) for k in parent}
    assert {r.key: (r.total, r.members) for r in hierarchy.rolled_up(df, "id", "up", F.col("v")).collect()} == sums
    assert hierarchy.roots(df.filter("id < 0"), "id", "up").count() == 0


def test_levels_come_from_one_scan(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    columns = ["l_returnflag", "l_linestatus"]
    found = aggregates.summary_levels(rows, columns, aggregates.cube_levels(columns), [F.count("*").alias("n")])
    plan = plan_of(found)
    assert plan.count("FileScan") == 1 and plan.count("Expand") == 1
    assert sum(r.n for r in found.filter("_levels = 3").collect()) == rows.count()
    assert aggregates.rollup_levels(["a", "b"]) == [["a", "b"], ["a"], []]


@pytest.mark.parametrize("partitions", ["3", "16"])
def test_text_lists_of_a_hot_key(spark, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        hot = spark.range(30_000).select(F.lit("hot").alias("k"), F.concat(F.lit("v"), (F.col("id") % 20_000).cast("string")).alias("v"))
        few = spark.createDataFrame([("a", "y"), ("a", "x"), ("a", None), ("a", "x"), ("b", None), (None, "n"), ("c", "")], "k string, v string")
        dealt = hot.select("k", "v").distinct().repartitionByRange("k", "v")
        assert dealt.groupBy(F.spark_partition_id()).count().count() > 1  # the hot key lies in several segments
        found = {r.k: r["values"] for r in aggregates.text_lists(hot.unionByName(few), ["k"], "v", "values").collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before[0])
        spark.conf.set("spark.sql.adaptive.enabled", before[1])
    assert found == {"hot": ", ".join(sorted(f"v{i}" for i in range(20_000))), "a": "x, y", "b": None, None: "n", "c": ""}
    assert not re.search("collect_set", plan_of(aggregates.text_lists(few, ["k"], "v", "values")))
