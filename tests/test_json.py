"""Explode, inventory and profile on hand-made JSON text."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from hemicycle.functions.variants import parse
from hemicycle.plans import json_explode, json_inventory, json_profile
from hemicycle.plans.dynamic import key_catalogue, wide_form
from hemicycle.plans.json_explode import long_satellite, nested_satellite


@pytest.fixture
def frame(spark):
    def build(*values):
        rows = [("17", i, v) for i, v in enumerate(values)]
        return spark.createDataFrame(rows, "_legislatura string, Id int, Votacao_json string")

    return build


@pytest.mark.parametrize(
    ("value", "n"),
    [
        (None, 0),
        ("", 0),
        ("bad{", 0),
        ("null", 0),
        ("[]", 0),
        ("{}", 0),
        ("7", 1),
        ('"x"', 1),
        ('{"a":1}', 1),
        ('[1,null,{},{"a":[]}]', 4),
    ],
)
def test_rows_per_value(frame, value, n):
    assert json_explode.json_items(frame(value), "Votacao_json", ["Id"]).count() == n


def test_rows_equal_list_lengths(frame):
    lists = [[{"a": i}] * (i % 5) for i in range(40)]
    df = frame(*[json.dumps(x) for x in lists])
    assert json_explode.json_items(df, "Votacao_json", ["Id"]).count() == sum(map(len, lists))


def test_objects_spread_over_columns(frame):
    df = frame('[{"a b":1,"n":{"x":[1]},"vazio":{},"Id":"own"},"solto",[3]]')
    rows = [r.asDict() for r in json_explode.explode_column(df, "Votacao_json", ["Id"]).orderBy("_json_idx").collect()]
    assert rows[0] == {
        "Id": 0,
        "_json_idx": 0,
        "item_Id": "own",
        "a_b": "1",
        "n_json": '{"x":[1]}',
        "vazio_json": None,
        "_value": None,
    }
    assert [r["_value"] for r in rows[1:]] == ["solto", "[3]"]


def test_lenient_text_becomes_a_value(frame):
    rows = json_explode.explode_column(frame("texto livre", '{"a":1}'), "Votacao_json", ["Id"], strict=False).collect()
    assert {(r.Id, r["_value"]) for r in rows} == {(0, "texto livre"), (1, None)}


def test_all_keys_come_back(frame):
    df = frame(json.dumps({f"k{i}": i for i in range(2100)}))
    (row,) = json_explode.explode_column(df, "Votacao_json", ["Id"]).collect()
    assert len(row) == 2102 and row["k2099"] == "2099"
    names = json_explode.dry_run(df, "t", "Votacao_json").filter("subject = 'column' AND name LIKE 'k%'")
    assert names.count() == 2100


def test_keys_of_one_column_name_lose_no_value(frame):
    df = frame('{"Id":"A","item_Id":"B","a-b":1,"a b":2,"Ab":3,"AB":4}', '{"c d":5}', '{"c-d":6}')
    rows = json_explode.explode_column(df, "Votacao_json", ["Id"]).orderBy("Id").collect()
    assert sorted(v for v in rows[0][2:] if v is not None) == ["1", "2", "3", "4", "A", "B"]
    assert [rows[1]["c_d"], rows[2]["c_d"]] == ["5", "6"]


def test_keys_with_quotes_are_read(frame):
    df = frame(json.dumps({'q"uote': 1, "back\\slash": 2, "a.b": 3, "c[0]": 4}))
    (row,) = json_explode.explode_column(df, "Votacao_json", ["Id"]).collect()
    assert sorted(row[2:]) == ["1", "2", "3", "4"]


@pytest.mark.parametrize(
    ("table", "columns", "keys"),
    [
        ("iniciativa_eventos", ["IniId", "EvtId", "Fase"], ["IniId", "EvtId"]),
        ("iniciativa_eventos_votacao", ["IniId", "EvtId", "id", "data"], ["IniId", "EvtId", "id"]),
        ("peticao_dados_comissao_audiencias", ["PetId", "comissao_idx", "x"], ["PetId", "comissao_idx"]),
        ("atividades_gerais_publicacao", ["pubNr"], []),
        ("outra_tabela", ["a", "_b", "c_json", "d", "e", "f", "g"], ["a", "d", "e", "f"]),
    ],
)
def test_parent_keys(table, columns, keys):
    assert json_explode.parent_keys(columns, table) == keys


def test_a_failing_column_does_not_stop_the_rest(frame):
    source = frame('{"a":1}').withColumn("Outra_json", F.lit('{"b":[{"c":1}]}'))
    stored = {"t": source}

    def write(name, rows):
        if name == "t_votacao":
            raise RuntimeError("disk full")
        stored[name] = rows

    reports = list(json_explode.explode_all(lambda name: stored[name], write, ["t", "missing"]))
    assert [(r["satellite"], r["status"]) for r in reports] == [
        ("t_outra", "written"),
        ("t_votacao", "error"),
        (None, "error"),
        ("t_outra_b", "written"),
    ]
    (row,) = stored["t_outra_b"].collect()
    assert (row.c, row["_source_table"], row["_source_col"]) == ("1", "t_outra", "b_json")


def test_inventory(frame):
    df = frame(None, "", "[]", "x{", "5", '{"a":1}', '[{"a":1,"b":2}]', "null")
    (row,) = json_inventory.statistics(df).collect()
    assert (row.total, row.nulls, row.non_null, row.blank, row.significant) == (8, 1, 7, 4, 3)
    assert row.pct_significant == 42.9
    keys = json_inventory.top_keys(json_inventory.long_values(df)).orderBy("rank").collect()
    assert [(r.key, r.n) for r in keys] == [("a", 2), ("b", 1)]


def test_json_columns_by_name(spark):
    df = spark.createDataFrame([("", "", 1, "")], "a_json string, _b_json string, c_json int, d string")
    assert json_explode.json_columns(df) == ["a_json"]


def _walk_by_hand(node, path="$", depth=0):
    kind = type(node).__name__
    yield path, depth, kind
    children = node.items() if isinstance(node, dict) else [(None, v) for v in node] if isinstance(node, list) else []
    for key, value in children:
        yield from _walk_by_hand(value, f"{path}.{key}" if key else f"{path}[]", depth + 1)


def test_profile_agrees_with_a_recursive_walk(spark):
    docs = [
        {"a": [1, {"x": "q", "y": None}, [], [2.5, True]], "b": {}, "c": {"d": {"e": ["z"] * 12}}},
        [],
        "texto",
        [{"a": i} for i in range(60)],
        None,
    ]
    df = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)], "Id int, t string")
    nodes = json_profile.walk(df.select("Id", parse(F.col("t")).alias("v")), ["Id"])
    got = sorted((r.Id, r.path, r.depth, r.type) for r in nodes.collect())
    assert got == sorted((i, *n) for i, d in enumerate(docs) for n in _walk_by_hand(d))
    per_path = {r.path: r for r in json_profile.paths(nodes).collect()}
    assert per_path["$.c.d.e"].list_len_10 == 1


def test_profile_opens_as_many_levels_as_there_are(spark):
    deep = "1"
    for i in range(20):
        deep = f'{{"k{i}":{deep}}}' if i % 2 else f'["[{{\\"",{deep}]'
    df = spark.createDataFrame([(deep,), ("{}",), (None,)], "t string").select(F.lit(1).alias("Id"), parse(F.col("t")).alias("v"))
    assert json_profile.depth_of(df) == 20
    nodes = json_profile.walk(df, ["Id"]).collect()
    assert max(r.depth for r in nodes) == 20 and len(nodes) == 32


def test_long_form_with_very_many_keys(spark):
    """A fixed schema, a table of keys of any length, and the columns that are asked for; no list of keys on the driver."""
    rows = spark.range(100_000).select(
        F.lit("17").alias("_legislatura"), F.col("id").alias("IniId"), F.format_string('{"k%d": %d, "same": "v", "list": [{"a": %d}]}', "id", "id", "id").alias("dados_json")
    )
    long = long_satellite(rows, "iniciativas", "dados_json")
    names = ["_legislatura", "IniId", "_json_idx", "name", "key", "value", "nested", "clash"]
    assert long.columns[: len(names)] == names and len(long.columns) < 16
    keys = key_catalogue(long)
    assert keys.count() == 100_002
    assert {tuple(r) for r in keys.filter("key IN ('same', 'list', 'k5')").select("name", "key", "nested", "n").collect()} == {
        ("same", "same", False, 100_000), ("list_json", "list", True, 100_000), ("k5", "k5", False, 1)
    }
    wide = wide_form(long, ["IniId", "_json_idx"], ["same", "k5", "list_json", "missing"])
    assert wide.count() == 100_000
    assert [tuple(r) for r in wide.filter("IniId = 5").collect()] == [(5, 0, "v", "5", '[{"a":5}]', None)]
    nested = nested_satellite(long, "iniciativas")
    assert nested.count() == 100_000 and tuple(nested.filter("IniId = 7").select("in_key", "in_idx", "key", "value").first()) == ("list", "0", "a", "7")


def test_long_form_of_clashing_and_plain_items(spark):
    texts = ['{"a b": 1, "a_b": 2, "A-B": 3, "c": null, "d": [], "e": {"x": 1}}', "[5, {\"a b\": 7}, null, [1]]", "not json", "", None]
    rows = spark.createDataFrame([("17", i, t) for i, t in enumerate(texts)], "_legislatura string, IniId int, x_json string")
    long = long_satellite(rows, "iniciativas", "x_json")
    found = {(r.IniId, r._json_idx, r["name"], r.key, r.value, r.nested, r.clash) for r in long.collect()}
    assert found == {
        (0, 0, "a_b", "a b", "1", False, True), (0, 0, "a_b", "a_b", "2", False, True), (0, 0, "A_B", "A-B", "3", False, True),
        (0, 0, "e_json", "e", '{"x":1}', True, False), (1, 0, None, None, "5", False, False), (1, 1, "a_b", "a b", "7", False, False),
        (1, 3, None, None, "[1]", True, False), (2, 0, None, None, "not json", False, False),
    }
    wide = {(r.IniId, r._json_idx): (r.a_b, r._value) for r in wide_form(long, ["IniId", "_json_idx"], ["a_b"], plain="_value").collect()}
    assert wide[0, 0] == ("3", None) and wide[1, 0] == (None, "5") and wide[1, 1] == ("7", None) and wide[2, 0] == (None, "not json")
