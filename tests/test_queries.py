"""Registered queries against the SQL that checks them."""

from __future__ import annotations

import pytest
from compare import connect, difference

import __spark_entry__ as entry

QUERIES, CHECKS = entry.queries(), entry.oracle_sql()

# One table per category here; `python tests/compare.py` runs them all.
NORMALISED = (
    "iniciativas iniciativa_eventos intervencoes pergunta_respostas peticao_relatores peticao_associadas diploma_publicacao "
    "agenda_parlamentar deputado_atividade_contadores informacao_base_sessoes orcamento_do_estado delegacoes_eventuais "
    "grupo_amizade_composicao atividades_debates orgaos_historico_composicao"
).split()
NAMES = [n for n in QUERIES if not n.startswith("normalise_") or n.removeprefix("normalise_") in NORMALISED]


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", [n for n in NAMES if n in CHECKS])
def test_matches_sql(spark, duck, sf_dir, name):
    problem, _ = difference(spark, duck, sf_dir, QUERIES[name], CHECKS[name])
    assert problem is None


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_every_check_has_a_query():
    assert set(CHECKS) <= set(QUERIES)
