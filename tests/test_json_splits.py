"""Large JSON files cut into elements by many tasks, against Python's own parser."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from hemicycle.plans.categories import CATEGORIES
from hemicycle.plans.normalise import normalise
from hemicycle.sources import json_splits
from hemicycle.sources.json_splits import cut_lists, fragments
from hemicycle.sources.raw import list_files, object_parts, read_category

PLAIN = ["x}", 'a"b', "\\", '\\"}{[', "[", "]", "{", "ç", "", "plain text", "}\\", "line\nbreak", " ", 5, 1.5, None, True]


def value(rng: random.Random, depth: int = 0):
    r = rng.random()
    if r < 0.35 or depth > 3:
        return rng.choice(PLAIN)
    if r < 0.7:
        return [value(rng, depth + 1) for _ in range(rng.randint(0, 3))]
    return {rng.choice(["k}", "k", '"q', "[z", "\\"]): value(rng, depth + 1) for _ in range(rng.randint(0, 3))}


def elements(seed: int, n: int) -> list:
    rng = random.Random(seed)
    objects = [{"id": i, "v": value(rng), "w": value(rng)} for i in range(n)]
    return [x for e in objects for x in ([e] if rng.random() < 0.8 else [5, e, "a}", [{"n": 1}], None])]


def same(a: list, b: list) -> bool:
    return sorted(json.dumps(x, sort_keys=True) for x in a) == sorted(json.dumps(x, sort_keys=True) for x in b)


def write(path, content: str):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(content, encoding="utf-8")


@pytest.fixture(params=[1 << 20, 300], ids=["one range", "elements over several ranges"])
def ranges(spark, request):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(request.param))
    spark.conf.set("spark.sql.files.openCostInBytes", "64")
    yield request.param
    for k, v in before.items():
        spark.conf.set(k, v)


def test_elements_of_lists_and_the_rest(spark, tmp_path, ranges):
    listed = elements(1, 120)
    write(tmp_path / "17" / "list.json", json.dumps(listed, ensure_ascii=False))
    a, b = elements(2, 30), elements(3, 60)
    whole = {"first": {"a": {"b": 1}, "Inner": a, "Other": [1, [{"x": 2}]]}, "Item": b, "tail": {"l": [{"m": 1}], "s": "}"}, "none": [], "deep": {"d": {"Item": [{"z": 1}]}}}
    write(tmp_path / "17" / "object.json", json.dumps(whole, indent=1))
    read = fragments(spark, str(tmp_path), "list.json")
    if ranges < 1000:
        busy = read.select(F.spark_partition_id().alias("p")).distinct().count()
        assert busy >= 8
    found, rest = cut_lists(read, [()])
    assert same([x for r in found.collect() for x in json.loads(f"[{r.text}]")], listed)
    assert [(r.text, r.whole) for r in rest.collect()] == [("[]", True)]
    found, rest = cut_lists(fragments(spark, str(tmp_path), "object.json"), [("Item",), ("first", "Inner"), ("none",), ("missing",)])
    rows = found.collect()
    for keys, wanted in ((["Item"], b), (["first", "Inner"], a)):
        assert same([x for r in rows if r["keys"] == keys for x in json.loads(f"[{r.text}]")], wanted)
    assert {tuple(r["keys"]) for r in rows} == {("Item",), ("first", "Inner")}
    (left,) = rest.collect()
    assert left.whole and json.loads(left.text) == {**whole, "Item": [], "first": {**whole["first"], "Inner": []}}


def test_text_is_shuffled_by_nobody(spark, tmp_path, ranges, monkeypatch):
    """Both passes work on text where it is read; what is shuffled is one row a range."""
    plans = []
    keep = json_splits.written
    monkeypatch.setattr(json_splits, "written", lambda df: (plans.append(df._jdf.queryExecution().executedPlan().toString()), keep(df))[1])
    write(tmp_path / "17" / "list.json", json.dumps(elements(4, 40)))
    found, _ = cut_lists(fragments(spark, str(tmp_path), "list.json"), [()])
    assert same([x for r in found.collect() for x in json.loads(f"[{r.text}]")], elements(4, 40))
    reads = 0
    for plan in plans:
        lines = plan.splitlines()
        for i, line in enumerate(lines):
            if "FileScan text" in line:
                reads += 1
                above = next(x for x in reversed(lines[:i]) if "Exchange" in x or "MapInArrow" in x)
                assert "MapInArrow" in above, plan
    assert reads == 2


def test_keys_and_lists_that_look_like_named_ones(spark, tmp_path, ranges):
    pad = [{"p": "x}" * 40}] * 12
    whole = {"x}Item": [{"a": 1}], "Pad": pad, '"Item': [{"b": 1}], "Item": [{"c": [{"Item": [{"d": 1}]}]}] * 20, "In": {"x}Item": [{"e": 1}], "Item": [{"f": "}"}, 3], "Pad": pad}}
    write(tmp_path / "17" / "object.json", json.dumps(whole))
    found, rest = cut_lists(fragments(spark, str(tmp_path), "object.json"), [("Item",), ("In", "Item")])
    rows = found.collect()
    for keys, wanted in ((["Item"], whole["Item"]), (["In", "Item"], whole["In"]["Item"])):
        assert same([x for r in rows if r["keys"] == keys for x in json.loads(f"[{r.text}]")], wanted)
    (left,) = rest.collect()
    assert left.whole and json.loads(left.text) == {**whole, "Item": [], "In": {**whole["In"], "Item": []}}


def test_files_that_are_not_whole_stop_the_query(spark, tmp_path):
    good = json.dumps([{"a": {"b": "}"}}] * 50)
    broken = [good[:-1], good[:-2], good[:-5], good[:-7], good + "]", '{"a": 1}', "5", '"x"', "  ", "[[1, 2]", good.replace("}}, {", "}} {", 1), "[{]}", "[{},]", "[,{}]", "[{}, ,{}]"]
    for i, content in enumerate(broken):
        write(tmp_path / str(i) / "17" / "x.json", content)
        with pytest.raises(Exception, match="expected a list in 17/x.json"):
            list_files(spark, str(tmp_path / str(i)), "x").collect()
    whole = json.dumps({"a": {"b": 1}, "Item": [{"c": 1}] * 20})
    for i, content in enumerate([whole[:-1], "[1]"]):
        write(tmp_path / f"o{i}" / "17" / "x.json", content)
        with pytest.raises(Exception, match="expected an object in 17/x.json"):
            object_parts(spark, str(tmp_path / f"o{i}"), "x", [("Item",)]).collect()
    for content in ("[1, [{}], null]", good + "\n\n"):
        write(tmp_path / "fine" / "17" / "x.json", content)
        assert list_files(spark, str(tmp_path / "fine"), "x").count() == (50 if content.startswith(good) else 0)
    write(tmp_path / "nothing" / "17" / "x.json", "")
    assert list_files(spark, str(tmp_path / "nothing"), "x").count() == 0


@pytest.mark.parametrize("ranges", [500], indirect=True)
def test_object_parts_give_the_tables_of_whole_files(spark, tmp_path, ranges):
    base = {
        "Deputados": [{"DepId": str(i), "DepGP": [{"gpSigla": "PS", "x": "}"}]} for i in range(40)],
        "GruposParlamentares": [{"nome": "Grupo", "sigla": "G"}, 7],
        "CirculosEleitorais": {"cpId": "1", "cpDes": "not a list"},
        "DetalheLegislatura": {"id": "17", "sigla": "XVII", "dtini": "2024-03-26"},
    }
    write(tmp_path / "17" / "informacao_base.json", json.dumps(base))
    activities = {"Audicoes": [{"IDAudicao": i, "Data": "2024-01-02"} for i in range(30)], "AtividadesGerais": {"Atividades": [{"Tipo": "A", "n": {"m": 1}}] * 3, "Relatorios": []}, "Eventos": None}
    write(tmp_path / "17" / "atividades.json", json.dumps(activities))
    organs = {"Comissoes": [{"DetalheOrgao": {"oId": i, "nome": f"C{i}"}, "HistoricoComposicao": [{"depId": j} for j in range(3)]} for i in range(9)],
              "Plenario": {"DetalheOrgao": {"oId": 99}, "HistoricoComposicao": [{"depId": 1}, {"depId": 2}]}, "MesaAR": None}
    write(tmp_path / "17" / "composicao_de_orgaos.json", json.dumps(organs))
    text = F.col("text")
    for name in ("informacao_base", "atividades", "composicao_de_orgaos"):
        category = CATEGORIES[name]
        content = (tmp_path / "17" / f"{name}.json").read_text(encoding="utf-8")
        whole = spark.createDataFrame([("17", f"17/{name}.json", content)], "_legislatura string, _source_file string, text string")
        whole = whole.select("_legislatura", "_source_file", F.parse_json(text).alias("v"))
        parts = read_category(spark, str(tmp_path), category)
        assert parts.filter("NOT is_part").count() == 1 and parts.count() > 9
        expected = normalise(category, whole)
        for table, rows in normalise(category, parts).items():
            assert sorted(map(str, rows.collect())) == sorted(map(str, expected[table].collect())), table


def test_results_do_not_depend_on_shuffle_settings(spark):
    import __spark_entry__ as entry

    names = ("raw_list_files", "raw_object_files")
    settings = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    try:
        seen = {}
        for partitions, adaptive in (("4", "true"), ("24", "false")):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            spark.conf.set("spark.sql.adaptive.enabled", adaptive)
            for name in names:
                rows = sorted(map(str, entry.queries()[name](spark, "/root/testdata/sf0.01").collect()))
                assert rows and seen.setdefault(name, rows) == rows
    finally:
        for k, v in settings.items():
            spark.conf.set(k, v)
