"""Raw files, manifests, the partitioned store and exports, end to end on small files."""

from __future__ import annotations

import hashlib
import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from hemicycle.plans import calendar, pages
from hemicycle.plans.categories import CATEGORIES
from hemicycle.plans.pipeline import explode_store, store_raw
from hemicycle.sinks.export import write_csv
from hemicycle.sinks.lineage import stamp
from hemicycle.sinks.manifest import FILE_KEY, TABLE_KEY, append, current, upsert
from hemicycle.sinks.tables import load, replace_partitions, row_counts, write_dimension
from hemicycle.sources.catalogue import pending, read_catalogue, select_entries
from hemicycle.sources.raw import accepted, fingerprints, read_category, rejected
from hemicycle.sources.store import read_table, wider
from hemicycle.streaming.refresh import start_refresh


def initiative(n, votes, leg="17"):
    events = [{"EvtId": f"e{n}-{i}", "DataFase": f"2024-01-{i + 1:02d}", "Votacao": v} for i, v in enumerate(votes)]
    return {
        "IniId": n,
        "IniNr": str(n),
        "IniDescTipo": "Projeto de Lei",
        "IniTitulo": f"Título {n}",
        "IniAutorGruposParlamentares": [{"GP": "PS" if n % 2 else "PSD"}],
        "IniAutorDeputados": [{"idCadastro": n * 10, "nome": f"D{n}", "GP": "PS"}],
        "IniEventos": events,
    }


def write(path, value):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(value, ensure_ascii=False), encoding="utf-8")


@pytest.fixture
def raw(tmp_path):
    root = tmp_path / "raw"
    vote = [{"id": "v1", "data": "2024-01-05", "resultado": "Aprovado", "unanime": "unanime", "tipoReuniao": "RP"}]
    later = {"id": "v2", "data": "2024-02-05", "resultado": "Rejeitado", "unanime": None, "tipoReuniao": "RP"}
    write(root / "01" / "iniciativas.json", [initiative(1, [vote]), None, 5])
    write(root / "17" / "iniciativas.json", [initiative(1, [vote, later]), initiative(2, [None]), initiative(3, [])])
    write(root / "17" / "agenda_parlamentar.json", [{"Id": 1, "EventStartDate": "02/03/2024", "EventStartTime": "10:00"}])
    return root


def test_missing_files_are_skipped_and_roots_checked(spark, raw, tmp_path):
    docs = read_category(spark, str(raw), CATEGORIES["iniciativas"])
    assert docs.groupBy("_legislatura").count().collect() != []
    assert docs.filter("_legislatura = '01'").count() == 1
    assert read_category(spark, str(raw), CATEGORIES["iniciativas"], ["05"]).count() == 0
    assert read_category(spark, str(raw), CATEGORIES["peticoes"]).count() == 0
    for i, content in enumerate(['{"not": "a list"}', '[{"a": 1}, {"b": ', "5"]):
        path = tmp_path / f"bad{i}" / "17" / "iniciativas.json"
        path.parent.mkdir(parents=True)
        path.write_text(content, encoding="utf-8")
        with pytest.raises(Exception, match="expected a list in 17/iniciativas.json"):
            read_category(spark, str(tmp_path / f"bad{i}"), CATEGORIES["iniciativas"]).collect()
    write(tmp_path / "badobject" / "17" / "atividades.json", [1])
    with pytest.raises(Exception, match="expected an object"):
        read_category(spark, str(tmp_path / "badobject"), CATEGORIES["atividades"]).collect()


def test_lines_are_read_one_document_each(spark, tmp_path):
    path = tmp_path / "raw" / "17" / "iniciativas.jsonl"
    path.parent.mkdir(parents=True)
    path.write_text("\n".join(json.dumps(initiative(n, [])) for n in range(5)), encoding="utf-8")
    docs = read_category(spark, str(tmp_path / "raw"), CATEGORIES["iniciativas"], lines=True)
    assert docs.count() == 5 and docs.first()["_source_file"] == "17/iniciativas.jsonl"


def test_fingerprints(spark, raw):
    (raw / "17" / "estragado.json").write_text("{", encoding="utf-8")
    write(raw / "17" / "escalar.json", 5)
    write(raw / "17" / "orcamento_do_estado.json", {"Item": [], "x": 1})
    files = fingerprints(spark, str(raw))
    rows = {r.path: r for r in files.collect()}
    listed = rows["17/iniciativas.json"]
    content = (raw / "17" / "iniciativas.json").read_bytes()
    assert (listed.bytes, listed.sha256) == (len(content), hashlib.sha256(content).hexdigest())
    assert (listed.top_level_type, listed.top_level_len) == ("list", 3)
    assert (rows["17/orcamento_do_estado.json"].top_level_type, rows["17/orcamento_do_estado.json"].top_level_len) == ("dict", 2)
    assert rows["17/escalar.json"].top_level_len is None
    assert [r.path for r in rejected(files).collect()] == ["17/estragado.json"]
    assert accepted(files).count() == len(rows) - 1


def test_catalogue(spark, tmp_path):
    path = tmp_path / "x" / "catalogue.json"
    names = ["16_iniciativas", "17_iniciativas", "17_grupos_parlamentares_de_amizade", "solto"]
    write(path, {"rows": [{"filename": n, "json": f"https://example.org/{n}"} for n in names]})
    entries = read_catalogue(spark, str(tmp_path))
    assert {(r.legislatura, r.categoria) for r in entries.collect()} == {
        ("16", "iniciativas"),
        ("17", "iniciativas"),
        ("17", "grupos_parlamentares_de_amizade"),
        ("solto", ""),
    }
    assert [r.filename for r in select_entries(entries).collect()] == ["17_iniciativas"]
    assert select_entries(entries, None, None).count() == 4
    done = spark.createDataFrame([("17_iniciativas",)], "filename string")
    assert pending(entries, done).count() == 3
    assert pending(entries, done, force=True).count() == 4


def test_manifest_upsert_and_log(spark, tmp_path):
    kind = "table string, legislatura string, rows int, generated_at string"
    old = spark.createDataFrame([("a", "16", 1, "1"), ("a", "17", 2, "1"), ("cal", None, 3, "1")], kind)
    new = spark.createDataFrame([("a", "17", 9, "2"), ("cal", None, 4, "2"), ("b", "16", 5, "2")], kind)
    expected = [("a", "16", 1), ("a", "17", 9), ("b", "16", 5), ("cal", None, 4)]
    assert [tuple(r)[:3] for r in upsert(old, new, TABLE_KEY).collect()] == expected
    path = str(tmp_path / "manifest")
    append(old, path)
    append(new, path)
    assert [tuple(r)[:3] for r in current(spark, path, TABLE_KEY).collect()] == expected
    assert upsert(
        spark.createDataFrame([("f", 1)], "filename string, bytes int"),
        spark.createDataFrame([("f", 2)], "filename string, bytes int"),
        FILE_KEY,
    ).collect()[0].bytes == 2


def test_lineage_of_an_empty_frame(spark):
    empty = spark.createDataFrame([], "x int, _legislatura string, _source_file string")
    assert stamp(empty, "n").columns == [
        "x", "_legislatura", "_source_file", "_source_sha256", "_normalizer", "_normalized_at",
    ]


def test_partitions_are_replaced_one_by_one(spark, tmp_path):
    path = str(tmp_path / "t")
    kind = "x int, _legislatura string"
    replace_partitions(spark.createDataFrame([(1, "01"), (2, "16"), (3, "17")], kind), path)
    assert replace_partitions(spark.createDataFrame([(9, "16")], kind), path, ["16", "17"]) == {"17"}
    assert sorted(map(tuple, read_table(spark, path).collect())) == [(1, "01"), (9, "16")]


def test_types_are_widened_over_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    frames = {"01": "1 AS a, 1.5D AS b, DATE '2024-01-01' AS c", "16": "'x' AS a, 2 AS b", "17": "3L AS a, 'n' AS extra"}
    for leg, cells in frames.items():
        spark.sql(f"SELECT {cells}").write.parquet(f"{path}/_legislatura={leg}")
    df = read_table(spark, path)
    assert dict(df.dtypes) == {"a": "string", "b": "double", "c": "date", "extra": "string", "_legislatura": "string"}
    got = sorted(tuple(r) for r in df.select("_legislatura", "a", "b", "extra").collect())
    assert got == [("01", "1", 1.5, None), ("16", "x", 2.0, None), ("17", "3", None, "n")]


def test_wider_types(spark):
    kinds = {f.name: f.dataType for f in spark.sql("SELECT 1 AS i, 1L AS l, 1.0D AS d, 'x' AS s, true AS b").schema}
    assert wider(kinds["i"], kinds["l"]) == kinds["l"]
    assert wider(kinds["l"], kinds["d"]) == kinds["d"]
    assert wider(kinds["b"], kinds["i"]) == kinds["s"]


def test_csv_has_a_byte_order_mark(spark, tmp_path):
    df = spark.createDataFrame([("ação", 'com "aspas", vírgula', None, True), (" x ", "duas\nlinhas", "", False)], "a string, b string, c string, d boolean")
    assert write_csv(df, str(tmp_path / "out"), single_file=True)
    (part,) = (tmp_path / "out").glob("part-*")
    content = part.read_bytes()
    assert content.startswith(b"\xef\xbb\xbfa,b,c,d\n")
    assert content.decode("utf-8-sig") == 'a,b,c,d\nação,"com ""aspas"", vírgula",,True\n x ,"duas\nlinhas",,False\n'
    assert not write_csv(df.limit(0), str(tmp_path / "none"))
    assert not (tmp_path / "none").exists()


def snapshot(spark, store, table):
    rows = read_table(spark, f"{store}/tables/{table}").drop("_normalized_at")
    return sorted(map(str, rows.collect()))


def test_from_raw_files_to_a_page(spark, raw, tmp_path):
    store = str(tmp_path / "store")
    hashes = fingerprints(spark, str(raw))
    store_raw(spark, str(raw), store, ["iniciativas", "agenda_parlamentar", "peticoes"], hashes=hashes)
    names = ["iniciativas", "iniciativa_eventos", "iniciativa_autores_gp", "iniciativa_autores_deputados"]
    facts = read_table(spark, f"{store}/tables/iniciativas")
    assert {(r._legislatura, r.IniId) for r in facts.collect()} == {("01", "1"), ("17", "1"), ("17", "2"), ("17", "3")}
    digest = hashlib.sha256((raw / "01" / "iniciativas.json").read_bytes()).hexdigest()
    assert facts.filter("_legislatura = '01'").first()["_source_sha256"] == digest

    manifest = current(spark, f"{store}/meta/tables", TABLE_KEY)
    stored = {(r.table, r.legislatura): r.rows for r in manifest.collect()}
    assert stored[("iniciativas", "17")] == 3 and stored[("iniciativa_anexos", "01")] == 0

    before = {n: snapshot(spark, store, n) for n in names}
    store_raw(spark, str(raw), store, ["iniciativas"], hashes=hashes)
    assert {n: snapshot(spark, store, n) for n in names} == before
    assert current(spark, f"{store}/meta/tables", TABLE_KEY).count() == len(stored)

    reports = list(explode_store(spark, store, ["iniciativa_eventos"], "Votacao_json"))
    assert [r["status"] for r in reports] == ["written"]
    tables = load(spark, store, [*names, "iniciativa_eventos_votacao"])
    page = pages.initiatives(tables, "17", parties=["PS", "PSD"], dates=(date(2024, 1, 1), date(2024, 12, 31)))
    assert [(r.nr, r.resultado, r.unanime) for r in page.collect()] == [
        ("1", "Rejeitado", None),
        ("2", None, None),
        ("3", None, None),
    ]
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_legislatura" in plan
    assert row_counts({"iniciativas": tables["iniciativas"]}).collect()[0].n == 4
    assert spark.sql("SELECT count(*) AS n FROM iniciativa_autores_gp").first().n == 4

    days = calendar.calendar(spark, tables, date(2024, 3, 1))
    write_dimension(days, store, "dim_calendario", "calendar")
    dimension = spark.read.parquet(f"{store}/tables/dim_calendario")
    bounds = dimension.agg(F.min("data"), F.max("data"), F.count("*"), F.count_distinct("data")).first()
    assert tuple(bounds) == (date(2024, 1, 1), date(2025, 3, 1), 426, 426)
    last = current(spark, f"{store}/meta/tables", TABLE_KEY).filter("table = 'dim_calendario'").first()
    assert (last.legislatura, last.rows, last["columns"]) == (None, 426, 14)


def test_satellite_partitions_without_rows_are_emptied(spark, raw, tmp_path):
    store = str(tmp_path / "store")
    store_raw(spark, str(raw), store, ["iniciativas"])
    list(explode_store(spark, store, ["iniciativa_eventos"], "Votacao_json"))
    write(raw / "01" / "iniciativas.json", [initiative(1, [])])
    store_raw(spark, str(raw), store, ["iniciativas"], ["01"])
    list(explode_store(spark, store, ["iniciativa_eventos"], "Votacao_json"))
    votes = read_table(spark, f"{store}/tables/iniciativa_eventos_votacao")
    assert {r._legislatura for r in votes.collect()} == {"17"}


def test_calendar_attributes_and_default(spark):
    days = calendar.calendar(spark, {}, date(2024, 1, 1))
    assert days.count() == 366
    df = spark.sql("SELECT DATE '2021-01-03' AS data")
    row = calendar.attributes(df).first()
    assert (row.semana_iso, row.dia_semana_iso, row.dia_semana_nome, row.fim_de_semana) == (53, 7, "domingo", True)
    assert (row.ano_mes, row.ano_trimestre, row.mes_nome, row.dia_ano) == ("2021-01", "2021-T1", "janeiro", 3)


def test_refresh_takes_each_landed_file_once(spark, tmp_path):
    landing, store, marks = tmp_path / "landing", str(tmp_path / "store"), str(tmp_path / "marks")
    write(landing / "run1" / "16" / "iniciativas.json", [initiative(1, [])])
    write(landing / "run1" / "17" / "iniciativas.json", [initiative(1, []), initiative(2, [])])
    start_refresh(spark, str(landing), store, marks).awaitTermination()
    write(landing / "run2" / "17" / "iniciativas.json", [initiative(5, [])])
    start_refresh(spark, str(landing), store, marks).awaitTermination()
    start_refresh(spark, str(landing), store, marks).awaitTermination()
    rows = {(r._legislatura, r.IniId) for r in read_table(spark, f"{store}/tables/iniciativas").collect()}
    assert rows == {("16", "1"), ("17", "5")}


def test_refresh_passes_over_an_older_run_that_lands_later(spark, tmp_path):
    landing, store, marks = tmp_path / "landing", str(tmp_path / "store"), str(tmp_path / "marks")
    write(landing / "run2" / "17" / "iniciativas.json", [initiative(5, [])])
    start_refresh(spark, str(landing), store, marks).awaitTermination()
    write(landing / "run1" / "17" / "iniciativas.json", [initiative(1, [])])
    write(landing / "run1" / "16" / "iniciativas.json", [initiative(2, [])])
    start_refresh(spark, str(landing), store, marks).awaitTermination()
    rows = {(r._legislatura, r.IniId) for r in read_table(spark, f"{store}/tables/iniciativas").collect()}
    assert rows == {("16", "2"), ("17", "5")}


def test_list_files_over_several_lines_are_read_whole(spark, tmp_path):
    path = tmp_path / "17" / "iniciativas.json"
    path.parent.mkdir(parents=True)
    path.write_text("[\n" + ",\n".join(json.dumps(initiative(i, []), indent=1) for i in range(3)) + "\n]\n")
    from hemicycle.plans.categories import CATEGORIES
    from hemicycle.sources.raw import read_category

    assert read_category(spark, str(tmp_path), CATEGORIES["iniciativas"]).count() == 3


def test_schemas_of_a_store_come_from_records(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    replace_partitions(spark.createDataFrame([("a", i, str(i)) for i in range(6)], "x string, n int, _legislatura string"), path)
    replace_partitions(spark.createDataFrame([("b", 2.5, "new", "3"), ("c", 1.0, "new", "9")], "x string, n double, y string, _legislatura string"), path, ["4"])
    asked = []
    reader = type(spark.read)
    parquet = reader.parquet
    monkeypatch.setattr(reader, "parquet", lambda self, *paths, **options: asked.append(paths) or parquet(self, *paths, **options))
    rows = {tuple(r) for r in read_table(spark, path).select("x", "n", "y", "_legislatura").collect()}
    assert rows == {("a", float(i), None, str(i)) for i in (0, 1, 2, 5)} | {("b", 2.5, "new", "3"), ("c", 1.0, "new", "9")}
    assert len(asked) == 3  # the records, and one scan for each of the two schemas
    # a partition that others wrote, without a record, is asked itself
    spark.createDataFrame([("z", "text")], "x string, n string").write.parquet(f"{path}/_legislatura=77")
    assert read_table(spark, path).schema["n"].dataType.simpleString() == "string"
    assert read_table(spark, path).filter("_legislatura = '77'").first()["n"] == "text"
