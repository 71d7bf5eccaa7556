"""One query per operator, over the whole given tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hemicycle.driver.registry import add, add_civic
from hemicycle.driver.roles import read_source
from hemicycle.functions import dates, numbers, text
from hemicycle.operators import aggregates, filters, joins, ordering, reshape
from hemicycle.sources.catalogue import name_parts, pending, select_entries


def _on(table: str, build):
    """A query over one given table."""
    return lambda spark, sf_dir: build(read_source(spark, sf_dir, table))


# Predicates ---------------------------------------------------------------------------------

_RANGE = (date(1995, 3, 1), date(1997, 9, 30))


def _conjunctive(df: DataFrame) -> DataFrame:
    return filters.keep(
        df,
        filters.within_or_null(df, "o_orderdate", _RANGE),
        filters.one_of("o_orderstatus", ["F", "P"]),
        filters.one_of("o_orderpriority", []),
        filters.search(["o_orderpriority"], "high"),
    ).select("o_orderkey", "o_custkey")


add(
    "filter_conjunctive",
    _on("orders", _conjunctive),
    """SELECT o_orderkey, o_custkey FROM orders WHERE (o_orderdate IS NULL OR CAST(o_orderdate AS DATE)
      BETWEEN DATE '1995-03-01' AND DATE '1997-09-30') AND o_orderstatus IN ('F', 'P') AND o_orderpriority ILIKE '%high%'""",
)
add_civic(
    "null_tolerant_range",
    lambda t: filters.keep(
        t["intervencoes"],
        filters.within_or_null(t["intervencoes"], "DataReuniaoPlenaria", (date(2024, 1, 5), date(2024, 1, 9))),
    ).select("Id"),
    """SELECT Id FROM intervencoes WHERE DataReuniaoPlenaria IS NULL
      OR CAST(DataReuniaoPlenaria AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-09'""",
)
add_civic(
    "null_tolerant_range_of_text",
    lambda t: filters.keep(
        t["iniciativa_eventos_votacao"],
        filters.within_or_null(t["iniciativa_eventos_votacao"], "data", (date(1996, 1, 1), date(1996, 12, 31))),
    ).select("IniId", "id", "data"),
    """SELECT IniId, id, data FROM iniciativa_eventos_votacao WHERE data IS NULL
      OR TRY_CAST(data AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'""",
)
add(
    "multi_in",
    _on(
        "lineitem",
        lambda df: filters.keep(
            df, filters.one_of("l_returnflag", ["A", "R"]), filters.one_of("l_linenumber", [1, 3, 5])
        ).select("l_orderkey", "l_partkey"),
    ),
    "SELECT l_orderkey, l_partkey FROM lineitem WHERE l_returnflag IN ('A', 'R') AND l_linenumber IN (1, 3, 5)",
)
add(
    "ilike_any",
    _on("documents", lambda df: filters.keep(df, filters.search(["text", "source"], "ÉO_O%e")).select("doc_id")),
    "SELECT doc_id FROM documents WHERE text ILIKE '%ÉO_O%e%' OR source ILIKE '%ÉO_O%e%'",
)
add_civic(
    "ilike_null_safe",
    lambda t: filters.keep(t["reunioes_e_visitas"], filters.search(["Nome", "Promotor"], "NATION_1", True)).select("Id"),
    """SELECT Id FROM reunioes_e_visitas
    WHERE coalesce(Nome, '') ILIKE '%NATION_1%' OR coalesce(Promotor, '') ILIKE '%NATION_1%'""",
)
for _mode, _sql in {
    "all": "TRUE",
    "only": "unanime = 'unanime'",
    "without": "(unanime IS NULL OR unanime <> 'unanime')",
}.items():
    add_civic(
        f"tri_state_flag_{_mode}",
        lambda t, m=_mode: filters.keep(
            t["iniciativa_eventos_votacao"], filters.flagged("unanime", m, "unanime")
        ).groupBy("resultado").agg(F.count("*").alias("n")),
        f"SELECT resultado, count(*) AS n FROM iniciativa_eventos_votacao WHERE {_sql} GROUP BY 1",
    )
add(
    "try_cast_threshold",
    _on(
        "events",
        lambda df: filters.keep(
            df.select("event_id", F.get_json_object("props", "$.k").alias("k")), filters.at_least("k", 40)
        ),
    ),
    "SELECT event_id, props->>'$.k' AS k FROM events WHERE TRY_CAST(props->>'$.k' AS INTEGER) >= 40",
)
add_civic(
    "try_cast_integer",
    lambda t: t["peticoes"].select("PetId", numbers.try_int(F.col("PetNrAssinaturas")).alias("assinaturas")),
    "SELECT PetId, CAST(TRY_CAST(PetNrAssinaturas AS INTEGER) AS BIGINT) AS assinaturas FROM peticoes",
)
add_civic(
    "equal_ids",
    lambda t: t["deputados"].join(
        t["iniciativa_autores_deputados"].withColumn("k", numbers.id_text(F.col("idCadastro"))),
        numbers.id_text(F.col("DepCadId")) == F.col("k"),
    ).groupBy("DepCadId").agg(F.count("*").alias("n")),
    """SELECT d.DepCadId, count(*) AS n FROM deputados d JOIN iniciativa_autores_deputados a
    ON CAST(CAST(d.DepCadId AS BIGINT) AS VARCHAR) = a.idCadastro GROUP BY 1""",
)
add_civic(
    "display_projection",
    lambda t: filters.visible(t["atividades_eventos"]),
    "SELECT IDEvento, SessaoLegislativa, TipoEvento, Designacao, LocalEvento, Concedida FROM atividades_eventos",
)

# Ordering -----------------------------------------------------------------------------------

add_civic(
    "sort_nulls_last_topk",
    lambda t: ordering.top(t["iniciativas"], [ordering.down("data_entrada")], 500, ["IniId"]).select("IniId", "data_entrada"),
    """SELECT IniId, CAST(data_entrada AS VARCHAR) AS data_entrada FROM iniciativas
    ORDER BY iniciativas.data_entrada DESC NULLS LAST, IniId LIMIT 500""",
)
add_civic(
    "sort_ascending_nulls_last_topk",
    lambda t: ordering.top(
        t["iniciativa_autores_deputados"].select("IniId", "idCadastro", "nome").distinct(),
        [ordering.up("nome")],
        300,
        ["IniId", "idCadastro"],
    ),
    """SELECT DISTINCT IniId, idCadastro, nome FROM iniciativa_autores_deputados
    ORDER BY nome ASC NULLS LAST, IniId, idCadastro LIMIT 300""",
)
add_civic(
    "sort_by_number_in_text",
    lambda t: ordering.top(t["diplomas_aprovados"].select("Id", "Numero"), [ordering.number_down("Numero")], 400, ["Id"]),
    "SELECT Id, Numero FROM diplomas_aprovados ORDER BY TRY_CAST(Numero AS INTEGER) DESC NULLS LAST, Id LIMIT 400",
)
add_civic(
    "latest_vote_per_initiative",
    lambda t: ordering.latest(
        t["iniciativa_eventos_votacao"].select("IniId", "data", "_json_idx", "id", "resultado", "unanime"),
        ["IniId"],
        [F.col("data").try_cast("date").desc_nulls_last(), ordering.down("_json_idx"), ordering.down("id")],
    ).select("IniId", "resultado", "unanime"),
    """SELECT IniId, resultado, unanime FROM (SELECT IniId, resultado, unanime, row_number() OVER (PARTITION BY IniId
      ORDER BY TRY_CAST(data AS DATE) DESC NULLS LAST, _json_idx DESC, id DESC) AS rn FROM iniciativa_eventos_votacao)
    WHERE rn = 1""",
)

# Joins --------------------------------------------------------------------------------------

add_civic(
    "inner_using",
    lambda t: t["iniciativas"].select("IniId", "IniTipo").join(
        t["iniciativa_autores_gp"].select("IniId", "GP"), "IniId"
    ).groupBy("IniTipo", "GP").agg(F.count("*").alias("n")),
    """SELECT IniTipo, GP, count(*) AS n FROM iniciativas JOIN iniciativa_autores_gp USING (IniId) GROUP BY 1, 2""",
)
add_civic(
    "inner_composite",
    lambda t: t["iniciativa_eventos_votacao"].join(t["iniciativas"], ["IniId", "_legislatura"]).select(
        "IniId", "id", "resultado", "IniDescTipo"
    ),
    """SELECT v.IniId, v.id, v.resultado, i.IniDescTipo FROM iniciativa_eventos_votacao v
    JOIN iniciativas i ON i.IniId = v.IniId AND i._legislatura = v._legislatura""",
)
add_civic(
    "left_composite",
    lambda t: t["iniciativa_eventos_votacao"].join(t["iniciativas"], ["IniId", "_legislatura"], "left").select(
        "IniId", "id", "resultado", "IniDescTipo"
    ),
    """SELECT v.IniId, v.id, v.resultado, i.IniDescTipo FROM iniciativa_eventos_votacao v
    LEFT JOIN iniciativas i ON i.IniId = v.IniId AND i._legislatura = v._legislatura""",
)
add_civic(
    "semi_exists",
    lambda t: joins.having(
        t["iniciativas"], t["iniciativa_autores_gp"], ["IniId"], filters.one_of("GP", ["NATION_3", "NATION_9"])
    ).select("IniId"),
    """SELECT IniId FROM iniciativas i WHERE EXISTS (SELECT 1 FROM iniciativa_autores_gp g
    WHERE g.IniId = i.IniId AND g.GP IN ('NATION_3', 'NATION_9'))""",
)
add_civic(
    "semi_composite",
    lambda t: joins.having(t["iniciativa_eventos_votacao"], t["iniciativas"], ["IniId", "_legislatura"]).select("IniId", "id"),
    """SELECT IniId, id FROM iniciativa_eventos_votacao v WHERE EXISTS (SELECT 1 FROM iniciativas i
    WHERE i.IniId = v.IniId AND i._legislatura = v._legislatura)""",
)
add_civic(
    "semi_nested",
    lambda t: joins.having(
        t["pergunta_destinatarios"],
        joins.having(
            t["perguntas_e_requerimentos"], t["pergunta_autores"], ["Id"], filters.one_of("GP", ["NATION_3"])
        ),
        ["Id"],
        filters.one_of("Tipo", ["Pergunta"]),
    ).groupBy("nomeEntidade").agg(F.count("*").alias("n")),
    """SELECT nomeEntidade, count(*) AS n FROM pergunta_destinatarios d WHERE EXISTS (SELECT 1
      FROM perguntas_e_requerimentos p WHERE p.Id = d.Id AND p.Tipo = 'Pergunta' AND EXISTS (SELECT 1
        FROM pergunta_autores a WHERE a.Id = p.Id AND a.GP = 'NATION_3')) GROUP BY 1""",
)
add_civic(
    "semi_with_history",
    lambda t: joins.having(
        t["orgaos_detalhe"],
        t["orgaos_historico_composicao"],
        [("oId", "orgao_id")],
        filters.conjunction([filters.one_of("legDes", ["Sessão F"]), filters.one_of("depGP", ["GP3"])]),
    ).select("oId", "tipo_orgao"),
    """SELECT oId, tipo_orgao FROM orgaos_detalhe o WHERE EXISTS (SELECT 1 FROM orgaos_historico_composicao h
    WHERE h.orgao_id = o.oId AND h.legDes IN ('Sessão F') AND h.depGP IN ('GP3'))""",
)


def _catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File names built from the customers, as a catalogue lists them."""
    name = F.concat(F.col("c_nationkey").cast("string"), F.lit("_"), F.lower("c_mktsegment"), F.lit("_"), F.col("c_custkey"))
    files = read_source(spark, sf_dir, "customer").select(name.alias("filename"))
    return files.select(*name_parts(F.col("filename")), "filename")


def _ingested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same names for the customers that have an urgent order."""
    known = joins.having(
        read_source(spark, sf_dir, "customer"),
        read_source(spark, sf_dir, "orders"),
        [("c_custkey", "o_custkey")],
        F.col("o_orderpriority") == "1-URGENT",
    )
    name = F.concat(F.col("c_nationkey").cast("string"), F.lit("_"), F.lower("c_mktsegment"), F.lit("_"), F.col("c_custkey"))
    return known.select(name.alias("filename"))


_CATALOGUE_SQL = """catalogue AS (SELECT CAST(c_nationkey AS VARCHAR) || '_' || lower(c_mktsegment) || '_'
    || CAST(c_custkey AS VARCHAR) AS filename, c_custkey, CAST(c_nationkey AS VARCHAR) AS legislatura,
    lower(c_mktsegment) || '_' || CAST(c_custkey AS VARCHAR) AS categoria FROM customer)"""
add(
    "catalogue_name_parts",
    _catalogue,
    f"WITH {_CATALOGUE_SQL} SELECT legislatura, categoria, filename FROM catalogue",
)
add(
    "catalogue_selection",
    lambda spark, sf_dir: select_entries(
        _catalogue(spark, sf_dir).withColumn("categoria", F.regexp_replace("categoria", "_.*", "")),
        ["3", "7"],
        ["building", "machinery"],
    ),
    f"""WITH {_CATALOGUE_SQL} SELECT legislatura, regexp_replace(categoria, '_.*', '') AS categoria, filename
    FROM catalogue WHERE legislatura IN ('3', '7') AND regexp_replace(categoria, '_.*', '') IN ('building', 'machinery')""",
)
add(
    "anti_new_files",
    lambda spark, sf_dir: pending(_catalogue(spark, sf_dir), _ingested(spark, sf_dir)).select("filename"),
    f"""WITH {_CATALOGUE_SQL} SELECT filename FROM catalogue WHERE NOT EXISTS (SELECT 1 FROM orders
    WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')""",
)

# Aggregates ---------------------------------------------------------------------------------

add_civic(
    "group_count_distinct",
    lambda t: aggregates.distinct_by(t["iniciativa_autores_gp"], "GP", "IniId"),
    "SELECT GP, count(DISTINCT IniId) AS n FROM iniciativa_autores_gp GROUP BY 1",
)
add_civic(
    "group_count",
    lambda t: aggregates.count_by(t["intervencoes"], "dep_GP"),
    "SELECT dep_GP, count(*) AS n FROM intervencoes WHERE dep_GP IS NOT NULL GROUP BY 1",
)
add_civic(
    "count_distinct_global",
    lambda t: t["pergunta_autores"].agg(F.count_distinct("Id").alias("n"), F.count("*").alias("total")),
    "SELECT count(DISTINCT Id) AS n, count(*) AS total FROM pergunta_autores",
)
add_civic(
    "facet_distinct_chain",
    lambda t: filters.facet_options(
        t["diplomas_aprovados"],
        [filters.Facet.on(c) for c in ("Tipo", "AnoCivil", "Sessao")],
        2,
        [["1-URGENT"], ["1995", "1996"]],
    ),
    """SELECT DISTINCT Sessao AS option FROM diplomas_aprovados
    WHERE Tipo IN ('1-URGENT') AND AnoCivil IN ('1995', '1996') AND Sessao IS NOT NULL""",
)
add_civic(
    "string_agg_distinct",
    lambda t: aggregates.text_lists(t["pergunta_autores"], ["Id"], "GP", "gps"),
    "SELECT Id, string_agg(DISTINCT GP, ', ' ORDER BY GP) AS gps FROM pergunta_autores GROUP BY 1",
)
add_civic(
    "min_any_value",
    lambda t: t["diploma_publicacao"].groupBy("Id").agg(F.min("pubdt").alias("pubdt"), F.max("URLDiario").alias("URLDiario")),
    """SELECT Id, CAST(min(pubdt) AS VARCHAR) AS pubdt, max(URLDiario) AS URLDiario FROM diploma_publicacao GROUP BY 1""",
)
add_civic(
    "outcome_rates",
    lambda t: aggregates.outcome_rates(
        t["iniciativa_eventos_votacao"],
        {"aprovadas": F.col("resultado") == "Aprovado", "unanimes": F.col("unanime") == "unanime"},
    ),
    """SELECT count(*) AS n, count(*) FILTER (WHERE resultado = 'Aprovado') AS n_aprovadas,
      round(count(*) FILTER (WHERE resultado = 'Aprovado') / count(*), 2) AS share_aprovadas,
      count(*) FILTER (WHERE unanime = 'unanime') AS n_unanimes,
      round(count(*) FILTER (WHERE unanime = 'unanime') / count(*), 2) AS share_unanimes FROM iniciativa_eventos_votacao""",
)
add_civic(
    "nunique_kpis",
    lambda t: aggregates.distinct_counts(t["intervencoes"], ["dep_nome", "dep_GP", "TipoIntervencao"]),
    """SELECT count(*) AS n, count(DISTINCT dep_nome) AS distinct_dep_nome, count(DISTINCT dep_GP) AS distinct_dep_GP,
      count(DISTINCT TipoIntervencao) AS distinct_TipoIntervencao FROM intervencoes""",
)
add_civic(
    "sum_median",
    lambda t: aggregates.sum_and_median(
        t["peticoes"].select(numbers.try_int(F.col("PetNrAssinaturas")).alias("assinaturas")), "assinaturas"
    ),
    """SELECT CAST(sum(x) AS BIGINT) AS total, CAST(trunc(median(x)) AS BIGINT) AS median
    FROM (SELECT TRY_CAST(PetNrAssinaturas AS INTEGER) AS x FROM peticoes)""",
)
add_civic(
    "monthly_series",
    lambda t: aggregates.monthly(t["iniciativas"], "data_entrada"),
    """SELECT strftime(data_entrada, '%Y-%m') AS mes, count(*) AS n FROM iniciativas WHERE data_entrada IS NOT NULL
    GROUP BY 1""",
)
add_civic(
    "month_by_category",
    lambda t: aggregates.monthly(t["iniciativa_eventos_votacao"], "data", "unanime"),
    """SELECT strftime(TRY_CAST(data AS DATE), '%Y-%m') AS mes, unanime, count(*) AS n FROM iniciativa_eventos_votacao
    WHERE TRY_CAST(data AS DATE) IS NOT NULL AND unanime IS NOT NULL GROUP BY 1, 2""",
)
add_civic(
    "day_by_category",
    lambda t: aggregates.daily(t["intervencoes"], "DataReuniaoPlenaria", "dep_GP"),
    """SELECT CAST(CAST(DataReuniaoPlenaria AS DATE) AS VARCHAR) AS dia, dep_GP, count(*) AS n FROM intervencoes
    WHERE DataReuniaoPlenaria IS NOT NULL AND dep_GP IS NOT NULL GROUP BY 1, 2""",
)
add_civic(
    "date_bounds",
    lambda t: aggregates.date_bounds(t["iniciativas"], "data_entrada"),
    """SELECT CAST(min(data_entrada) AS VARCHAR) AS min_d, CAST(max(data_entrada) AS VARCHAR) AS max_d FROM iniciativas""",
)

# Set operations and reshaping ---------------------------------------------------------------

add_civic(
    "union_by_name",
    lambda t: reshape.union_all(
        [
            t["delegacoes_eventuais"].select("Id", "Nome", "Local").withColumn("tipo", F.lit("eventual")),
            t["grupos_parlamentares_de_amizade"].select("Nome", F.col("Id").cast("string").alias("Id"), "Sessao"),
        ]
    ),
    """SELECT CAST(Id AS VARCHAR) AS Id, Nome, Local, 'eventual' AS tipo, NULL AS Sessao FROM delegacoes_eventuais
    UNION ALL SELECT CAST(Id AS VARCHAR), Nome, NULL, NULL, Sessao FROM grupos_parlamentares_de_amizade""",
)
add_civic(
    "unpivot_all_counters",
    lambda t: reshape.unpivot_counters(t["deputado_atividade_contadores"].drop("_legislatura"), ["DepCadId"]),
    """SELECT DepCadId, substr(categoria, 3) AS categoria, n FROM (UNPIVOT (SELECT DepCadId, n_Ini, n_Intev, n_Req, n_Scgt
      FROM deputado_atividade_contadores) ON n_Ini, n_Intev, n_Req, n_Scgt INTO NAME categoria VALUE n)""",
)
add_civic(
    "timeline_of_all",
    lambda t: reshape.timeline(
        t["deputados_dep_gp"].select("DepCadId", "GpSigla", "GpDtInicio", "GpDtFim"),
        "GpDtInicio",
        "GpDtFim",
        date(2002, 6, 30),
    ),
    """SELECT DepCadId, GpSigla, CAST(TRY_CAST(GpDtInicio AS DATE) AS VARCHAR) AS GpDtInicio,
      CAST(coalesce(TRY_CAST(GpDtFim AS DATE), DATE '2002-06-30') AS VARCHAR) AS GpDtFim FROM deputados_dep_gp""",
)

# Scalar functions ---------------------------------------------------------------------------

add(
    "html_to_text",
    _on("pages", lambda df: df.select("page_id", text.plain_text(F.col("html")).alias("texto"))),
    r"""SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(html, '<BR\s*/?>', ' | ', 'g'),
      '<[^>]+>', '', 'g'), '[\s\x{000B}\x{0085}\p{Z}]+', ' ', 'g')) AS texto FROM pages""",
)
add_civic(
    "vote_detail_text",
    lambda t: t["iniciativa_eventos_votacao"].select("IniId", "id", text.plain_text(F.col("detalhe")).alias("detalhe")),
    r"""SELECT IniId, id, trim(regexp_replace(regexp_replace(regexp_replace(coalesce(detalhe, ''), '<BR\s*/?>', ' | ', 'g'),
      '<[^>]+>', '', 'g'), '\s+', ' ', 'g')) AS detalhe FROM iniciativa_eventos_votacao""",
)
add(
    "snake_case_names",
    _on(
        "part",
        lambda df: df.select(
            "p_partkey",
            text.snake_case(F.concat(F.initcap("p_name"), F.lit("-"), F.col("p_brand"), F.lit("Final_json"))).alias("nome"),
            text.column_name(F.concat("p_name", F.lit(" "), "p_brand")).alias("chave"),
        ),
    ),
    r"""SELECT p_partkey, trim(lower(regexp_replace(regexp_replace(array_to_string(list_transform(string_split(p_name, ' '),
      lambda w: upper(w[1]) || lower(w[2:])), ' ') || '-' || p_brand || 'Final', '([a-z0-9])([A-Z])', '\1_\2', 'g'),
      '[^a-zA-Z0-9_]', '_', 'g')), '_') AS nome, regexp_replace(p_name || ' ' || p_brand, '[^a-zA-Z0-9_]', '_', 'g') AS chave
    FROM part""",
)
add_civic(
    "label_fallback",
    lambda t: t["deputados"].select(
        "DepCadId",
        text.person_label(F.col("DepNomeParlamentar"), F.col("DepNomeCompleto"), F.col("DepCPDes")).alias("label"),
        text.or_dash(F.col("DepCargo")).alias("cargo"),
    ),
    """SELECT DepCadId, coalesce(DepNomeParlamentar, DepNomeCompleto, '(s/n)') || ' — ' || coalesce(DepCPDes, '—') AS label,
      coalesce(DepCargo, '—') AS cargo FROM deputados""",
)
add(
    "day_first_dates",
    _on(
        "orders",
        lambda df: df.select(
            "o_orderkey",
            dates.day_first_timestamp(
                F.when(F.col("o_orderkey") % 3 == 0, F.date_format("o_orderdate", "yyyy-MM-dd"))
                .when(F.col("o_orderkey") % 3 == 1, F.date_format("o_orderdate", "dd/MM/yyyy"))
                .otherwise(F.date_format("o_orderdate", "d-M-yyyy"))
            ).alias("dia"),
            dates.day_first_with_time(
                F.date_format("o_orderdate", "dd/MM/yyyy"),
                F.when(F.col("o_orderkey") % 2 == 0, F.lit("09:05")),
            ).alias("momento"),
        ),
    ),
    """SELECT o_orderkey, CAST(o_orderdate AS VARCHAR) AS dia, CAST(o_orderdate
      + CASE WHEN o_orderkey % 2 = 0 THEN INTERVAL 545 MINUTE ELSE INTERVAL 0 MINUTE END AS VARCHAR) AS momento FROM orders""",
)
