"""Periods and moments, trees, and summaries at several levels, over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hemicycle.driver.registry import add, add_civic
from hemicycle.driver.roles import CivicTables, read_source
from hemicycle.operators import aggregates, hierarchy, intervals

# Periods ------------------------------------------------------------------------------------


def _party_at_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The party (an order's priority) that a member (a customer) had on the day of each vote (a line of an order)."""
    orders = read_source(spark, sf_dir, "orders")
    votes = read_source(spark, sf_dir, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    votes = votes.select("l_orderkey", "l_linenumber", F.col("o_custkey").alias("member"), F.to_date("l_shipdate").alias("day"))
    states = orders.select(F.col("o_custkey").alias("member"), F.to_date("o_orderdate").alias("since"), F.col("o_orderpriority").alias("party"), "o_orderkey")
    found = intervals.latest_before(votes, states, ["member"], "day", "since", ["o_orderkey"])
    return found.select("l_orderkey", "l_linenumber", "member", "day", "party")


add(
    "party_at_vote",
    _party_at_vote,
    """WITH s AS (SELECT o_custkey AS member, CAST(o_orderdate AS DATE) AS since, arg_max(o_orderpriority, o_orderkey) AS party FROM orders GROUP BY ALL),
    v AS (SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, o_custkey AS member, CAST(l_shipdate AS DATE) AS d FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
    SELECT l_orderkey, l_linenumber, v.member, CAST(d AS VARCHAR) AS day, party FROM v ASOF LEFT JOIN s ON v.member = s.member AND v.d >= s.since""",
)


def _open_mandates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each order, how many of its customer's orders were open on its day: begun and not all shipped."""
    orders = read_source(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("day"))
    ends = read_source(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.to_date(F.max("l_shipdate")).alias("till"))
    periods = orders.join(ends, "o_orderkey", "left").select("o_custkey", F.col("day").alias("since"), "till", F.col("o_orderkey").alias("mandate"))
    held = intervals.within_period(orders, periods, ["o_custkey"], "day", "since", "till")
    return held.groupBy("o_orderkey").agg(F.count("mandate").alias("n_open"))


add(
    "open_mandates",
    _open_mandates,
    """WITH e AS (SELECT l_orderkey, CAST(max(l_shipdate) AS DATE) AS till FROM lineitem GROUP BY 1),
    p AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS since, till FROM orders LEFT JOIN e ON l_orderkey = o_orderkey)
    SELECT o_orderkey, count(p.since) AS n_open FROM orders o LEFT JOIN p ON p.o_custkey = o.o_custkey
      AND CAST(o_orderdate AS DATE) >= since AND (till IS NULL OR CAST(o_orderdate AS DATE) <= till) GROUP BY 1""",
)

# Trees --------------------------------------------------------------------------------------

add_civic(
    "budget_roots",
    lambda t: hierarchy.roots(t["orcamento_do_estado"], "ID", "ID_Pai"),
    """WITH RECURSIVE b AS (SELECT ID, CASE WHEN ID_Pai IN (SELECT ID FROM orcamento_do_estado) THEN ID_Pai END AS up FROM orcamento_do_estado),
    r AS (SELECT ID AS key, ID AS root, CAST(0 AS BIGINT) AS depth FROM b WHERE up IS NULL
      UNION ALL SELECT b.ID, r.root, r.depth + 1 FROM b JOIN r ON b.up = r.key)
    SELECT key, root, depth, false AS in_cycle FROM r""",
)
add_civic(
    "budget_rollup",
    lambda t: hierarchy.rolled_up(t["orcamento_do_estado"], "ID", "ID_Pai", F.col("Numero").cast("long")),
    """WITH RECURSIVE b AS (SELECT ID, CASE WHEN ID_Pai IN (SELECT ID FROM orcamento_do_estado) THEN ID_Pai END AS up, CAST(Numero AS BIGINT) AS n
      FROM orcamento_do_estado),
    a AS (SELECT ID AS key, up, n FROM b UNION ALL SELECT b.ID, b.up, a.n FROM a JOIN b ON b.ID = a.up)
    SELECT key, CAST(sum(n) AS BIGINT) AS total, count(*) AS members FROM a GROUP BY key""",
)

# Levels -------------------------------------------------------------------------------------

_LEVELS = ["_legislatura", "resultado", "tipoReuniao"]


def _summary(levels: list[list[str]]) -> Callable[[CivicTables], DataFrame]:
    def query(t: CivicTables) -> DataFrame:
        return aggregates.distinct_levels(t["iniciativa_eventos_votacao"], _LEVELS, levels, "IniId", "n", "initiatives")

    return query


def _summary_check(grouping: str) -> str:
    return f"""SELECT _legislatura, resultado, tipoReuniao, CAST(GROUPING_ID(_legislatura, resultado, tipoReuniao) AS BIGINT) AS _levels,
      count(*) AS n, count(DISTINCT IniId) AS initiatives FROM iniciativa_eventos_votacao GROUP BY {grouping}"""


add_civic("votes_rollup", _summary(aggregates.rollup_levels(_LEVELS)), _summary_check("ROLLUP (_legislatura, resultado, tipoReuniao)"))
add_civic("votes_cube", _summary(aggregates.cube_levels(_LEVELS)), _summary_check("CUBE (_legislatura, resultado, tipoReuniao)"))
add_civic(
    "votes_grouping_sets",
    _summary([["_legislatura", "resultado"], ["tipoReuniao"], []]),
    _summary_check("GROUPING SETS ((_legislatura, resultado), (tipoReuniao), ())"),
)
