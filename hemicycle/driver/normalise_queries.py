"""Normalised tables over documents derived from the orders."""

from __future__ import annotations

from hemicycle.driver.documents import (
    KEY,
    TERM,
    date_text,
    document_sql,
    documents,
    field_json,
    list_json,
    nested_json,
    table_check,
    text_value,
    tree,
)
from hemicycle.driver.registry import add
from hemicycle.plans.categories import (
    ACTIVITIES,
    AGENDA,
    CATEGORIES,
    DELEGATIONS,
    DEPUTIES,
    DEPUTY_ACTIVITIES,
    GROUP_MEMBERS,
    INITIATIVES,
    INTERVENTIONS,
    ORGANS,
)
from hemicycle.plans.normalise import normalise

_ORIGIN_SQL = "{term} AS _legislatura, {term} || '/{category}.json' AS _source_file"


def _origin(category: str) -> str:
    return _ORIGIN_SQL.format(term=TERM, category=category)


def _register(category, name: str, sql: str, check: str) -> None:
    add(
        f"normalise_{name}",
        lambda spark, sf_dir: normalise(category, documents(spark, sf_dir, sql, category.name), [name])[name],
        check,
    )


def _register_all(category, extra: dict | None = None, computed: dict[str, str] | None = None) -> None:
    for table in category.tables:
        sql = document_sql(category, None if table.lists else extra, only=table.name)
        _register(category, table.name, sql, table_check(table, category.name, computed))


def _spans(first: str, column: str) -> str:
    return f"""(SELECT {first}(x) FROM (SELECT CASE WHEN {KEY} % 11 = 0 OR {KEY} % 13 = 0 THEN NULL
      ELSE nullif({date_text('DataFase', 1, False)}, '') END AS x
      FROM (SELECT unnest(range(CAST({KEY} % 4 AS BIGINT))) AS i)) d)"""


def _quoted(sql: str) -> str:
    return f"""coalesce('"' || {sql} || '"', 'null')"""


# Categories whose columns are all copied.
for _name in ("perguntas_e_requerimentos", "peticoes", "diplomas_aprovados", "informacao_base", "orcamento_do_estado"):
    _register_all(CATEGORIES[_name])

_register_all(
    INITIATIVES,
    extra={("IniEventos",): list_json(tree([(("DataFase",), _quoted(f"({date_text('DataFase', 1, False)})"))]), 1)},
    computed={
        "legislatura_ingest": TERM,
        "data_entrada": f"CAST(TRY_CAST({_spans('min', 'DataFase')} AS TIMESTAMP) AS VARCHAR)",
        "data_ultimo_evento": f"CAST(TRY_CAST({_spans('max', 'DataFase')} AS TIMESTAMP) AS VARCHAR)",
    },
)


def _first_of(key: str) -> str:
    """The list under `key` as the document holds it, keys in order."""
    table = INTERVENTIONS.tables[0]
    return tree([(f.path[1:], field_json(f, 0)) for f in table.columns if f.path[:1] == (key,)])


_register_all(
    INTERVENTIONS,
    computed={
        "legislatura_ingest": TERM,
        "av_all_json": _first_of("DadosAudiovisual"),
        "pub_all_json": _first_of("Publicacao"),
    },
)

_CLOCK = f"CASE WHEN {KEY} % 4 = 0 THEN NULL WHEN {KEY} % 4 = 1 THEN '' ELSE '14:30' END"


def _moment(name: str) -> str:
    day = date_text(name, 0, True)
    parsed = f"coalesce(TRY_CAST({day} AS TIMESTAMP), try_strptime({day}, '%d/%m/%Y'))"
    shift = f"CASE WHEN {KEY} % 4 IN (2, 3) THEN INTERVAL 870 MINUTE ELSE INTERVAL 0 MINUTE END"
    return f"CAST({parsed} + {shift} AS VARCHAR)"


_AGENDA_DATES = {
    "EventStartDate": date_text("EventStartDate", 0, True),
    "EventEndDate": date_text("EventEndDate", 0, True),
    "EventStartTime": _CLOCK,
    "EventEndTime": _CLOCK,
}
_agenda = AGENDA.tables[0]
_register(
    AGENDA,
    _agenda.name,
    document_sql(AGENDA, {(k,): _quoted(v) for k, v in _AGENDA_DATES.items()}),
    "SELECT * EXCLUDE (o_orderkey, o_orderdate) REPLACE ("
    + ", ".join(f"{sql} AS {name}" for name, sql in _AGENDA_DATES.items())
    + ") FROM ("
    + table_check(
        _agenda, AGENDA.name, {"data_inicio": _moment("EventStartDate"), "data_fim": _moment("EventEndDate")}
    ).replace(" FROM orders", ", o_orderkey, o_orderdate FROM orders")
    + ")",
)

# Deputies: each activity is a list of 0 to 3 items, an object, a scalar or absent.
_COUNTS = {k: f"({KEY} + {i}) % 7" for i, k in enumerate(DEPUTY_ACTIVITIES)}
_ACTIVITY = {
    k: f"""CASE {n} WHEN 0 THEN '[]' WHEN 1 THEN '[1]' WHEN 2 THEN '[1,2]' WHEN 3 THEN '[1,2,3]' WHEN 4 THEN '{{}}'
      WHEN 5 THEN 'null' ELSE '7' END"""
    for k, n in _COUNTS.items()
}
_BLOCK = tree([((k,), v) for k, v in _ACTIVITY.items()])
_NO_BLOCK = f"{KEY} % 12 = 0"
_register_all(
    DEPUTIES,
    extra={("AtividadeDeputadoList",): f"CASE WHEN {_NO_BLOCK} THEN '[]' ELSE '[' || {_BLOCK} || ', 5]' END"},
    computed={
        "legislatura_ingest": TERM,
        "atividade_json": f"CASE WHEN {_NO_BLOCK} THEN NULL ELSE {_BLOCK} END",
        **{
            f"n_{k}": f"""CAST(CASE WHEN {_NO_BLOCK} OR {n} IN (5, 6) THEN 0 WHEN {n} = 4 THEN 1 ELSE {n} END AS BIGINT)"""
            for k, n in _COUNTS.items()
        },
    },
)

# Delegations: the start is the first date that is filled in.
for _category in DELEGATIONS:
    _day = {
        n: f"CASE WHEN ({KEY} + {i}) % 3 = 0 THEN '' WHEN ({KEY} + {i}) % 5 = 0 THEN NULL ELSE {date_text(n, 0, True)} END"
        for i, n in enumerate(("DataInicio", "DataCriacao", "DataEleicao", "DataFim"))
    }

    def _stamp(sql: str) -> str:
        return f"CAST(coalesce(TRY_CAST({sql} AS TIMESTAMP), try_strptime({sql}, '%d/%m/%Y')) AS VARCHAR)"

    _filled = ", ".join(f"nullif({_day[n]}, '')" for n in ("DataInicio", "DataCriacao", "DataEleicao"))
    for _table in _category.tables:
        _extra = {(k,): _quoted(v) for k, v in _day.items()}
        if _table is GROUP_MEMBERS:
            _extra[_table.lists[0]] = list_json(tree([(f.path, field_json(f, 1)) for f in _table.columns]), 1)
        _sql = document_sql(_category, _extra, only=_table.name)
        _check = table_check(
            _table, _category.name, {"data_inicio": _stamp(f"coalesce({_filled})"), "data_fim": _stamp(_day["DataFim"])}
        )
        if not _table.lists:
            for _k, _v in _day.items():
                _check = _check.replace(f"{text_value(_k, 0)} AS {_k},", f"{_v} AS {_k},")
        _register(_category, _table.name, _sql, _check)


# Activities: items have free keys, some of them whitelisted.
_ACTIVITY_FIELDS = {
    "Assunto": _quoted(f"({text_value('Assunto', 1)})"),
    "Data": _quoted(f"CASE WHEN ({KEY} + i) % 3 = 0 THEN '' ELSE {date_text('Data', 1, True)} END"),
    "DataEntrada": _quoted(f"({date_text('DataEntrada', 1, True)})"),
    "Tipo": f"""CASE WHEN ({KEY} + i) % 4 = 0 THEN '["x"]' ELSE {_quoted(f"({text_value('Tipo', 1)})")} END""",
    "Nota": _quoted(f"({text_value('Nota', 1)})"),
    "Entidades": nested_json("Entidades", 1),
}
_ACTIVITY_LIST = list_json(tree([((k,), v) for k, v in _ACTIVITY_FIELDS.items()]), 1)
_ACTIVITY_DOC = tree(
    [
        *[((k,), _ACTIVITY_LIST) for k in ("Audicoes", "Audiencias", "Debates", "Deslocacoes", "Eventos")],
        (("OrcamentoContasGerencia",), _ACTIVITY_LIST),
        (("AtividadesGerais", "Atividades"), _ACTIVITY_LIST),
        (("AtividadesGerais", "Relatorios"), _ACTIVITY_LIST),
    ]
)
_DATA = f"CASE WHEN ({KEY} + i) % 3 = 0 THEN '' ELSE {date_text('Data', 1, True)} END"
_FIRST_DATE = f"coalesce(nullif({_DATA}, ''), nullif({date_text('DataEntrada', 1, True)}, ''))"
for _name in ACTIVITIES.dynamic:
    _register(
        ACTIVITIES,
        _name,
        _ACTIVITY_DOC,
        f"""SELECT {text_value('Assunto', 1)} AS Assunto, {_DATA} AS Data, {date_text('DataEntrada', 1, True)} AS DataEntrada,
          CASE WHEN ({KEY} + i) % 4 <> 0 THEN {text_value('Tipo', 1)} END AS Tipo,
          CASE WHEN ({KEY} + i) % 4 = 0 THEN '["x"]' END AS Tipo_json, {text_value('Nota', 1)} AS Nota_json,
          nullif({nested_json('Entidades', 1)}, 'null') AS Entidades_json,
          CAST(coalesce(TRY_CAST({_FIRST_DATE} AS TIMESTAMP), try_strptime({_FIRST_DATE}, '%d/%m/%Y')) AS VARCHAR) AS _data,
          {_origin('atividades')}
        FROM orders, LATERAL (SELECT unnest(range(CAST({KEY} % 4 AS BIGINT))) AS i)
        WHERE NOT ({KEY} % 11 = 0) AND NOT ({KEY} % 13 = 0)""",
    )

# Organs: two kinds in lists, one single; the id goes by four names.
_ID_NAME = f"CASE ({KEY} + i) % 4 WHEN 0 THEN 'oId' WHEN 1 THEN 'Id' WHEN 2 THEN 'id' ELSE 'cargoId' END"
_MEMBER = tree(
    [
        (("depNomeParlamentar",), _quoted(f"({text_value('depNomeParlamentar', 2)})")),
        (("DataInicio",), _quoted(f"({date_text('DataInicio', 2, True)})")),
        (("DepGP",), nested_json("DepGP", 2)),
    ]
)
_DETAIL = f"""'{{"sigla":' || {_quoted(f"({text_value('sigla', 1)})")} || ',"' || {_ID_NAME} || '":' || CAST({KEY} + i AS STRING)
  || ',"reunioes":' || {nested_json('reunioes', 1)} || '}}'"""
_ORGAN = tree([(("DetalheOrgao",), _DETAIL), (("HistoricoComposicao",), list_json(_MEMBER, 2))])
_SINGLE = f"array_join(transform(array(0), i -> {_ORGAN}), '')"
_CPC = tree([(("DetalheOrgao",), _DETAIL), (("HistoricoComposicaoCPC",), list_json(_MEMBER, 2))])
_SINGLE_CPC = f"array_join(transform(array(0), i -> {_CPC}), '')"
_ORGAN_DOC = tree(
    [
        (("Comissoes",), list_json(_ORGAN, 1)),
        (("GruposTrabalho",), list_json(_ORGAN, 1)),
        (("Plenario",), f"CASE WHEN {KEY} % 6 = 0 THEN 'null' ELSE {_SINGLE} END"),
        (("ConferenciaPresidentesComissoes",), _SINGLE_CPC),
    ]
)
_LISTED = f"""(SELECT *, kind FROM orders, LATERAL (SELECT unnest(range(CAST({KEY} % 4 AS BIGINT))) AS i),
    (VALUES ('Comissao'), ('GrupoTrabalho')) k(kind) WHERE NOT ({KEY} % 11 = 0) AND NOT ({KEY} % 13 = 0))"""
_PLENARIES = f"(SELECT *, CAST(0 AS BIGINT) AS i, 'Plenario' AS kind FROM orders WHERE {KEY} % 6 <> 0)"
_PRESIDENTS = "(SELECT *, CAST(0 AS BIGINT) AS i, 'ConferenciaPresidentesComissoes' AS kind FROM orders)"
_ORGAN_ROWS = f"""(SELECT * FROM {_LISTED} UNION ALL BY NAME SELECT * FROM {_PLENARIES}
    UNION ALL BY NAME SELECT * FROM {_PRESIDENTS})"""
_register(
    ORGANS,
    "orgaos_detalhe",
    _ORGAN_DOC,
    f"""SELECT kind AS tipo_orgao, {text_value('sigla', 1)} AS sigla, CAST(NULL AS VARCHAR) AS reunioes,
      nullif({nested_json('reunioes', 1)}, 'null') AS reunioes_json,
      CASE WHEN ({KEY} + i) % 4 = 0 THEN CAST({KEY} + i AS VARCHAR) END AS oId,
      CASE WHEN ({KEY} + i) % 4 IN (1, 2) THEN CAST({KEY} + i AS VARCHAR) END AS Id,
      CASE WHEN ({KEY} + i) % 4 = 3 THEN CAST({KEY} + i AS VARCHAR) END AS cargoId, {_origin('composicao_de_orgaos')}
    FROM {_ORGAN_ROWS}""",
)
_MEMBER_DAY = date_text("DataInicio", 2, True)
_register(
    ORGANS,
    "orgaos_historico_composicao",
    _ORGAN_DOC,
    f"""SELECT CASE WHEN kind = 'ConferenciaPresidentesComissoes' THEN kind || '.CPC' ELSE kind END AS tipo_orgao,
      CASE WHEN {KEY} + i <> 0 THEN CAST({KEY} + i AS VARCHAR) END AS orgao_id,
      {text_value('depNomeParlamentar', 2)} AS depNomeParlamentar, {_MEMBER_DAY} AS DataInicio,
      CAST(coalesce(TRY_CAST({_MEMBER_DAY} AS TIMESTAMP), try_strptime({_MEMBER_DAY}, '%d/%m/%Y')) AS VARCHAR) AS DataInicio_ts,
      CAST(NULL AS VARCHAR) AS DepGP, nullif({nested_json('DepGP', 2)}, 'null') AS DepGP_json, {_origin('composicao_de_orgaos')}
    FROM {_ORGAN_ROWS}, LATERAL (SELECT unnest(range(CAST(({KEY} + i) % 3 AS BIGINT))) AS j)""",
)
