from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from hemicycle.functions import dates, numbers, text, variants


def one(spark, value, build, kind="string"):
    df = spark.createDataFrame([(value,)], f"x {kind}")
    return df.select(build(F.col("x")).alias("y")).collect()[0].y


@pytest.mark.parametrize(
    ("value", "expected"),
    [
        ("2024-03-02", datetime(2024, 3, 2)),
        ("02/03/2024", datetime(2024, 3, 2)),
        ("2/3/2024 9:05", datetime(2024, 3, 2, 9, 5)),
        ("02-03-2024 14:30:15", datetime(2024, 3, 2, 14, 30, 15)),
        ("2024-02-30", None),
        ("30/02/2024", None),
        ("", None),
        ("sem data", None),
        (None, None),
    ],
)
def test_day_first(spark, value, expected):
    assert one(spark, value, dates.day_first_timestamp) == expected


def test_dates_do_not_move_with_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Lisbon")
    try:
        assert one(spark, "31/03/2024 01:30", dates.day_first_timestamp) == datetime(2024, 3, 31, 1, 30)
        assert one(spark, "2024-03-31 01:30:00", dates.iso_timestamp) == datetime(2024, 3, 31, 1, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_day_and_time(spark):
    df = spark.createDataFrame([("02/03/2024", "14:30"), ("02/03/2024", ""), ("", "10:00"), (None, None)], "d string, t string")
    got = [r[0] for r in df.select(dates.day_first_with_time(F.col("d"), F.col("t"))).collect()]
    assert got == [datetime(2024, 3, 2, 14, 30), datetime(2024, 3, 2), None, None]


@pytest.mark.parametrize(
    ("value", "expected"), [("12", 12), (" 12 ", 12), ("12.7", 13), ("-12.5", -13), ("12a", None), ("12d", None), ("12f", None), ("1e2", 100), (".5", 1), ("", None), (None, None)]
)
def test_try_int(spark, value, expected):
    assert one(spark, value, numbers.try_int) == expected


@pytest.mark.parametrize(("value", "kind"), [("7", "string"), ("7.0", "string"), (7.0, "double"), (7, "bigint")])
def test_id_text(spark, value, kind):
    assert one(spark, value, numbers.id_text, kind) == "7"


def test_long_ids_keep_their_digits(spark):
    assert one(spark, "9007199254740993", numbers.id_text) == "9007199254740993"


@pytest.mark.parametrize(
    ("value", "expected"),
    [
        ("A Favor: <I>PS</I><BR>Contra:  <I>CH</I>", "A Favor: PS | Contra: CH"),
        ("um<BR />dois", "um | dois"),
        ("  muitos \n\t espaços  ", "muitos espaços"),
        (None, ""),
    ],
)
def test_plain_text(spark, value, expected):
    assert one(spark, value, text.plain_text) == expected


@pytest.mark.parametrize(
    ("value", "expected"),
    [("Votacao_json", "votacao"), ("PublicacaoFase_json", "publicacao_fase"), ("DepGP", "dep_gp"), ("a b-C", "a_b_c")],
)
def test_snake_case(spark, value, expected):
    assert one(spark, value, text.snake_case) == expected
    assert text.snake_name(value) == expected


@pytest.mark.parametrize(("pattern", "hit"), [("AÇÃO", True), ("a%o", True), ("\\", False), ("x_z", False)])
def test_contains(spark, pattern, hit):
    assert one(spark, "Uma ação", lambda c: text.contains(c, pattern)) is hit


@pytest.mark.parametrize(
    ("value", "blank"),
    [
        ("null", True),
        ('""', True),
        ("[]", True),
        ("{}", True),
        ("bad{", True),
        (None, True),
        ("0", False),
        ("false", False),
        ('"x"', False),
        ("[null]", False),
        ('{"a":null}', False),
    ],
)
def test_blank(spark, value, blank):
    assert one(spark, value, lambda c: variants.is_blank(variants.parse(c))) is blank


@pytest.mark.parametrize(
    ("value", "n"), [('{"a":[1,2]}', 2), ('{"a":{}}', 1), ('{"a":null}', 0), ('{"a":7}', 0), ("{}", 0), ("[]", 0)]
)
def test_entry_count(spark, value, n):
    assert one(spark, value, lambda c: variants.entry_count(variants.parse(c), "a")) == n


def test_first_truthy(spark):
    doc = '{"a":0,"b":"","c":null,"d":false,"e":"0","f":9}'
    paths = [(k,) for k in "abcdef"]
    assert one(spark, doc, lambda c: variants.first_truthy(variants.parse(c), *paths)) == "0"
    assert one(spark, doc, lambda c: variants.first_truthy(variants.parse(c), ("a",), ("f",))) == "9"


@pytest.mark.parametrize(
    ("value", "an_object", "a_list"),
    [('{"a":[1]}', True, False), ("{}", True, False), ('[{"a":1},2,null]', False, True), ("[]", False, True), ("null", False, False), ("3", False, False), ('"x"', False, False), (None, False, False)],
)
def test_shapes_are_told_without_copying_what_they_hold(spark, value, an_object, a_list):
    assert one(spark, value, lambda x: variants.is_object(variants.parse(x))) == an_object
    assert one(spark, value, lambda x: variants.is_list(variants.parse(x))) == a_list
    shown = spark.sql("SELECT parse_json('1') AS v").select(variants.is_nested(F.col("v")))._jdf.queryExecution().analyzed().toString().lower()
    assert "map" not in shown and "array<variant>" not in shown and "arraytype(variant" not in shown
