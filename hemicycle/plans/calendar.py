"""The calendar dimension: one row per day from the first recorded date to a year from today."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hemicycle.functions.dates import as_date, utc_now_text

# Where dates are looked for, the default start, and the names of months and days.
DATE_COLUMNS = {
    "iniciativas": "data_entrada",
    "iniciativa_eventos": "DataFase",
    "intervencoes": "DataReuniaoPlenaria",
    "perguntas_e_requerimentos": "DataEnvio",
    "peticoes": "PetDataEntrada",
    "diploma_publicacao": "pubdt",
}
DEFAULT_START = date(2024, 1, 1)
MONTHS = "janeiro fevereiro marco abril maio junho julho agosto setembro outubro novembro dezembro".split()
DAYS = "segunda-feira terca-feira quarta-feira quinta-feira sexta-feira sabado domingo".split()


def first_date(tables: Mapping[str, DataFrame]) -> DataFrame | None:
    """One row with the earliest date over the fact tables; tables that are missing are passed over."""
    lowest = [
        tables[name].agg(F.min(as_date(F.col(column))).alias("d"))
        for name, column in DATE_COLUMNS.items()
        if name in tables and column in tables[name].columns
    ]
    if not lowest:
        return None
    merged = lowest[0]
    for frame in lowest[1:]:
        merged = merged.unionByName(frame)
    return merged.agg(F.coalesce(F.min("d"), F.lit(DEFAULT_START)).alias("first_date"))


def _named(names: list[str], number: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), number.cast("int"))


def calendar(spark: SparkSession, tables: Mapping[str, DataFrame], today: date | None = None) -> DataFrame:
    """The dimension itself, with `_generated_at` naming the run."""
    now = F.current_date() if today is None else F.lit(today)
    bounds = first_date(tables)
    if bounds is None:
        bounds = spark.range(1).select(F.lit(DEFAULT_START).alias("first_date"))
    days = bounds.select(F.explode(F.sequence("first_date", F.date_add(now, 365))).alias("data"))
    return attributes(days).withColumn("_generated_at", utc_now_text())


def attributes(days: DataFrame) -> DataFrame:
    """Calendar columns for a frame of days in `data`."""
    d = F.col("data")
    weekday = F.weekday(d) + 1
    quarter = F.quarter(d)
    return days.select(
        d,
        F.year(d).alias("ano"),
        quarter.cast("tinyint").alias("trimestre"),
        F.month(d).cast("tinyint").alias("mes"),
        _named(MONTHS, F.month(d)).alias("mes_nome"),
        F.weekofyear(d).cast("tinyint").alias("semana_iso"),
        F.date_format(d, "yyyy-MM").alias("ano_mes"),
        F.concat(F.year(d).cast("string"), F.lit("-T"), quarter.cast("string")).alias("ano_trimestre"),
        F.dayofmonth(d).cast("tinyint").alias("dia"),
        F.dayofyear(d).cast("smallint").alias("dia_ano"),
        weekday.cast("tinyint").alias("dia_semana_iso"),
        _named(DAYS, weekday).alias("dia_semana_nome"),
        (weekday >= 6).alias("fim_de_semana"),
    )


def by_period(facts: DataFrame, column: str, days: DataFrame, *period: str) -> DataFrame:
    """Rows per calendar period. Facts are counted per day first, so the join sees one row per day."""
    daily = facts.select(as_date(F.col(column)).alias("data")).dropna().groupBy("data").agg(F.count("*").alias("c"))
    return daily.join(days.select("data", *period), "data").groupBy(*period).agg(F.sum("c").alias("n"))
