"""The physical plans that matter at scale, and answers when one key holds most of the rows."""

from __future__ import annotations

from contextlib import redirect_stdout
from datetime import date
from io import StringIO
from statistics import median

import pytest
from pyspark.sql import functions as F

from hemicycle.driver.roles import CivicTables, read_source
from hemicycle.operators import aggregates, filters, joins, ordering
from hemicycle.plans import pages
from hemicycle.sinks.tables import replace_partitions
from hemicycle.sources.store import read_table


def plan_of(df, run=False):
    if run:
        df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df):
    out = StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    orders = read_source(spark, sf_dir, "orders")
    df = filters.keep(
        orders,
        filters.within_or_null(orders, "o_orderdate", (date(1996, 1, 1), date(1996, 12, 31))),
        filters.one_of("o_orderstatus", ["F"]),
    ).select("o_orderkey")
    plan = formatted(df)
    assert "LessThan(o_orderdate" in plan and "GreaterThanOrEqual(o_orderdate" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string,o_orderdate:timestamp_ntz>" in plan


def test_legislature_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_partitions(spark.range(30).select("id", F.concat(F.lit("0"), F.col("id") % 3).alias("_legislatura")), path)
    df = filters.keep(read_table(spark, path), filters.in_legislature("01"))
    assert "PartitionFilters: [isnotnull(_legislatura" in plan_of(df)
    assert df.count() == 10


def test_page_evaluates_its_filters_once(spark, sf_dir):
    page = pages.initiatives(CivicTables(spark, sf_dir), "1997", parties=[f"NATION_{i}" for i in range(25)], vote_tie_break=["id"])
    plan = plan_of(page, run=True).split("Initial Plan")[0]
    assert "ReusedExchange" in plan
    assert "TakeOrderedAndProject" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_existence_tests_reduce_keys_before_the_shuffle(spark, sf_dir):
    t = CivicTables(spark, sf_dir)
    plan = plan_of(joins.having(t["iniciativas"], t["iniciativa_eventos"], ["IniId"]))
    assert "LeftSemi" in plan and plan.count("HashAggregate") >= 2


def test_latest_row_is_limited_inside_the_map_tasks(spark, sf_dir):
    t = CivicTables(spark, sf_dir)
    plan = plan_of(ordering.latest(t["iniciativa_eventos"], ["IniId"], [ordering.down("DataFase")]))
    assert "Partial" in plan.split("Exchange")[-1] and "WindowGroupLimit" in plan.split("Exchange")[-1]


@pytest.fixture
def hot(spark):
    """5,000 rows, most of them under one key."""
    rows = [(1 if i % 3 else i, i % 7, i * 37 % 5003) for i in range(5000)]
    df = spark.createDataFrame(rows, "k int, g int, x int").repartition(6)
    return rows, df


def test_latest_under_a_hot_key(hot):
    rows, df = hot
    got = {r.k: r.x for r in ordering.latest(df, ["k"], [ordering.down("x")]).collect()}
    best = {}
    for k, _, x in rows:
        best[k] = max(best.get(k, -1), x)
    assert got == best


def test_existence_under_a_hot_key(spark, hot):
    rows, df = hot
    keys = spark.createDataFrame([(i,) for i in range(0, 5000, 2)], "k int")
    expected = {k for k, g, _ in rows if g == 3 and k % 2 == 0}
    assert {r.k for r in joins.having(keys, df, ["k"], F.col("g") == 3).collect()} == expected
    assert joins.lacking(keys, df, ["k"], F.col("g") == 3).count() == keys.count() - len(expected)


def test_text_list_under_a_hot_key(hot):
    rows, df = hot
    got = {r.k: r.gs for r in df.groupBy("k").agg(aggregates.ordered_text_list("CAST(g AS STRING)").alias("gs")).collect()}
    groups = {}
    for k, g, _ in rows:
        groups.setdefault(k, set()).add(str(g))
    assert got == {k: ", ".join(sorted(v)) for k, v in groups.items()}


@pytest.mark.parametrize("values", [[5], [1, 2], [7, 7, 7, 1], [-3, 10**9, 4, None, 70000, 65536, 65535], [None]])
def test_exact_median(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x int")
    known = [v for v in values if v is not None]
    expected = int(median(known)) if known else None
    found = aggregates.sum_and_median(df, "x").first()
    assert (found.median, found.total) == (expected, sum(known))


def test_median_of_many(hot):
    rows, df = hot
    assert aggregates.sum_and_median(df, "x").first().median == int(median([x for _, _, x in rows]))


def test_skewed_partition_is_split_when_written(spark, tmp_path):
    from hemicycle.sinks.tables import replace_partitions as write

    rows = spark.range(300000).select(
        F.sha2(F.col("id").cast("string"), 512).alias("x"),
        F.when(F.col("id") % 100 == 0, "01").otherwise("17").alias("_legislatura"),
    )
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, str(4 << 20))
    try:
        write(rows.repartition(8), str(tmp_path / "t"))
    finally:
        spark.conf.set(name, before)
    files = {leg: len(list((tmp_path / "t" / f"_legislatura={leg}").glob("*.parquet"))) for leg in ("01", "17")}
    assert files["17"] > 1 and files["01"] == 1


def test_no_registered_plan_has_a_cross_or_nested_loop_join(spark, sf_dir):
    from hemicycle.driver import QUERIES

    found = []
    for name, query in QUERIES.items():
        plan = query(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        if "BroadcastNestedLoopJoin" in plan or "CartesianProduct" in plan:
            found.append(name)
    assert found == []
