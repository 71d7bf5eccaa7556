"""Work that must grow with the input alone: where documents are built, how often, and what is shuffled."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

import __spark_entry__ as entry
from hemicycle.driver.documents import KEY, documents
from hemicycle.driver.roles import CivicTables
from hemicycle.operators import aggregates
from hemicycle.plans.categories import CATEGORIES
from hemicycle.plans.dynamic import key_usage
from hemicycle.plans.normalise import normalise
from hemicycle.sinks.raw import write_raw
from hemicycle.sources import json_splits


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def orders(spark, tmp_path, n: int = 400) -> str:
    rows = spark.range(n).select(
        F.col("id").alias(KEY), F.lit("O").alias("o_orderstatus"), F.lit("1-URGENT").alias("o_orderpriority"), (F.col("id") % 7).alias("o_custkey"),
        F.timestamp_add("DAY", F.col("id").cast("int"), F.lit("1995-01-01").cast("timestamp_ntz")).alias("o_orderdate"),
    )
    rows.coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    return str(tmp_path)


def test_documents_are_built_once_and_by_many_tasks(spark, tmp_path):
    sf_dir, text = orders(spark, tmp_path), f"concat('{{\"Id\":\"', {KEY}, '\"}}')"
    docs = documents(spark, sf_dir, text, "intervencoes")
    assert docs.select(F.spark_partition_id()).distinct().count() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = normalise(CATEGORIES["intervencoes"], docs, ["intervencoes"])["intervencoes"]
    assert plan(rows).count("parseJson") == 1
    assert sorted(int(r["Id"]) for r in rows.collect()) == list(range(400))


def test_items_with_free_keys_are_built_once_for_their_keys_and_their_rows(spark, tmp_path):
    sf_dir, text = orders(spark, tmp_path), f"""concat('{{"Audicoes":[{{"Nota":"', {KEY}, '"}},5]}}')"""
    docs = documents(spark, sf_dir, text, "atividades")
    rows = normalise(CATEGORIES["atividades"], docs, ["atividades_audicoes"])["atividades_audicoes"]
    assert "parseJson" not in plan(rows)
    assert sorted(int(r["Nota_json"]) for r in rows.collect()) == list(range(400))


def test_levels_with_a_distinct_count_shuffle_rows_without_their_levels(spark):
    rows = [(i % 5 if i % 4 else None, "ab"[i % 2], None if i % 3 == 0 else "x", i % 2 == 0) for i in range(60)]
    df, columns = spark.createDataFrame(rows, "v long, a string, b string, c boolean"), ["a", "b", "c"]
    levels = [*aggregates.cube_levels(columns), ["a"]]  # one level twice
    expected = aggregates.summary_levels(df, columns, levels, [F.count("*").alias("n"), F.count_distinct("v").alias("values")])
    found = aggregates.distinct_levels(df, columns, levels, "v", "n", "values")
    assert found.schema.simpleString() == expected.schema.simpleString()
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))
    assert aggregates.distinct_levels(df.limit(0), columns, levels, "v").count() == 0
    votes = CivicTables(spark, "/root/testdata/sf0.001")
    cube = entry.queries()["votes_cube"](spark, "/root/testdata/sf0.001")
    assert "Expand" not in plan(cube)
    assert {r.n for r in cube.where("_levels = 7").collect()} == {votes["iniciativa_eventos_votacao"].count()}


def test_only_fragments_at_the_ends_of_lists_are_parted(spark, tmp_path):
    listed = [{"id": i, "b": [{"c": [{"d": "]"}]}, {"e": []}]} for i in range(100)]
    (tmp_path / "17").mkdir()
    (tmp_path / "17" / "x.json").write_text(json.dumps(listed))
    read = json_splits.fragments(spark, str(tmp_path), "x.json")
    rows = json_splits._with_effects(read)
    tokens = json_splits._tokens(rows, json_splits._range_states(rows))
    assert tokens.count() <= read.count() + 30
    found, _ = json_splits.cut_lists(read, [()])
    assert sorted((x for r in found.collect() for x in json.loads(f"[{r.text}]")), key=lambda x: x["id"]) == listed


def test_items_are_not_broadcast_when_raw_files_are_written(spark, tmp_path):
    items = spark.range(300).repartition(4, "id").select("id", F.lit("17").alias("_legislatura"), F.format_string('{"id":%s}', "id").alias("item"))
    write_raw(items, str(tmp_path), "x", "id", per_file=10)
    files = list(tmp_path.glob("*/17/x.json"))
    assert len(files) > 20 and sorted(x["id"] for f in files for x in json.loads(f.read_text())) == list(range(300))


def test_text_of_documents_is_compiled_field_by_field(spark, tmp_path):
    sf_dir, text = orders(spark, tmp_path), f"concat('{{\"Id\":\"', {KEY}, '\"}}')"
    docs = documents(spark, sf_dir, text, "intervencoes")
    (generator,) = [line for line in plan(docs).splitlines() if "parseJson" in line]
    assert "concat" not in generator  # the generator gets the text and does not build it
    (project,) = [line for line in docs._jdf.queryExecution().sparkPlan().toString().splitlines() if " AS text#" in line]
    assert "transform(" in project or "lambdafunction(" in project
    compiled = docs._jdf.queryExecution().executedPlan().toString()
    assert not [line for line in compiled.splitlines() if " AS text#" in line and "*(" in line]


def test_keys_are_named_once_for_each_set_of_keys(spark):
    items = spark.range(200).selectExpr("""parse_json(CASE id % 5 WHEN 0 THEN '{"k y":1,"K_Y":[2]}' WHEN 1 THEN '{"k y":null,"k_y":' || id || '}'
      WHEN 2 THEN '[1]' WHEN 3 THEN 'null' ELSE '{}' END) AS item""").repartition(3)  # fmt: skip
    found = key_usage(items)
    shown = plan(found).splitlines()
    sets = max(i for i, line in enumerate(shown) if "Aggregate [" in line)
    assert any("lower(" in line for line in shown[: sets + 1])
    assert not any("lower(" in line for line in shown[sets + 1 :])  # rows are grouped to sets of keys before
    assert sorted((r["is_object"], r["key"] or "", r["nested"], bool(r["clashes"])) for r in found.collect()) == [
        (False, "", False, False), (True, "", False, False), (True, "K_Y", True, True), (True, "k y", False, True), (True, "k_y", False, True),
    ]
