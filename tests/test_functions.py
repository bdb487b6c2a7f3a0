import datetime as dt

import pytest
from pyspark.sql import functions as F

from rentlens.functions import numeric as N
from rentlens.functions import text as T


def one(spark, values, expr, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")
    return [r[0] for r in df.orderBy("i").select(expr("c")).collect()]


def test_local_amount(spark):
    got = one(spark, ["82.000", "10", "1.111.111", ",", None, "85000", "1.500,5", ""], T.local_amount)
    assert got == [82000.0, 0.0, None, None, None, 85000.0, 1500.5, None]


def test_distance(spark):
    got = one(spark, ["0 mins - 15 metros", "12 mins - 1.2 km", "sin dato", "1.250 metros", "3,5 metros", None], T.distance_metres)
    assert got == [15.0, 1200.0, None, 1250.0, 3.5, None]


def test_relative_date(spark):
    day = dt.date(2024, 6, 30)
    got = one(spark, ["hoy", " Esta Semana ", "11 días", "2 semanas", "3 meses", "1 año", "garbage", None], lambda c: T.relative_date(c, "2024-06-30"))
    assert got == [day, day - dt.timedelta(3), day - dt.timedelta(11), day - dt.timedelta(14), day - dt.timedelta(90), day - dt.timedelta(365), None, None]


def test_date_precision(spark):
    assert one(spark, ["hoy", "esta semana", "", None], T.date_precision) == ["exacta", "aproximada_categoria", None, None]


def test_numbers(spark):
    assert one(spark, [" 3.7 ", "x", None, "-2.9"], T.to_integer) == [3, None, None, -2]
    assert one(spark, [" 3,7", "1"], T.decimal_comma) == [3.7, 1.0]
    assert one(spark, ["$ 450.000", "abc"], T.digits_only) == [450000.0, None]


def test_words(spark):
    assert one(spark, ["Sí", "si", " NO ", "1.0", "quizás", None], T.yes_no) == [True, True, False, True, None, None]
    assert one(spark, ["Clínicas ", "ÑUÑOA"], T.strip_accents_lower) == ["clinicas", "nunoa"]
    assert one(spark, ["ñuñoa áéí"], T.upper_ascii) == ["NUNOA AEI"]
    assert one(spark, ["AMUEBLADA", "depto amoblado", "otro", None], T.text_flag) == [1, 1, 0, 0]
    assert one(spark, ["Aviso pausado", "FINALIZADA", "?", None], T.status_word) == ["pausado", "finalizado", "pausado", "activo"]


@pytest.mark.parametrize("days,label", [(0, "hoy"), (1, "hace 1 día"), (29, "hace 29 días"), (30, "hace 1 mes"), (364, "hace 12 meses"), (365, "hace 1 año"), (800, "hace 2 años")])
def test_age_label(spark, days, label):
    row = spark.range(1).select(T.age_label(F.date_sub(F.lit("2024-12-31").cast("date"), days), "2024-12-31")).first()
    assert row[0] == "Publicado: " + label


def test_format(spark):
    assert one(spark, [1234567.2, 950.0], T.thousands, "double") == ["1.234.567", "950"]
    df = spark.createDataFrame([("san-pedro-biobio", "Andalué"), ("tome-biobio", None)], "a string, b string")
    assert [r[0] for r in df.select(T.place_label("a", "b")).collect()] == ["Andalué, San Pedro", "Tome"]


def test_ratio_and_buckets(spark):
    df = spark.createDataFrame([(4.0, 0.0), (4.0, 2.0), (None, 2.0)], "a double, b double")
    assert [r[0] for r in df.select(N.safe_ratio("a", "b")).collect()] == [None, 2.0, None]
    assert one(spark, [0, 1, 4, 9], N.room_bucket, "int") == ["0", "1", "4+", "4+"]
    assert one(spark, [-1.0, -1.1, 1.0, 1.1, None], N.label_by_threshold, "double") == ["precio_de_mercado", "oportunidad", "precio_de_mercado", "caro", None]


def test_match_and_block(spark):
    assert one(spark, ["x"], lambda c: T.match_check(F.lit("a/MLC-1"), F.lit("b/MLC-1"), F.lit("MLC-1"))) == [True]
    assert one(spark, ["x"], lambda c: T.match_check(F.lit("a/MLC-1"), F.lit(None).cast("string"), F.lit("MLC-1"))) == [False]
    text = ["CAPTCHA here", "captcha Dormitorios 3", "nothing", "x" * 8000 + "captcha"]
    assert one(spark, text, lambda c: T.block_check(c, c, r"Dormitorios\s*\d+")) == [True, False, False, False]


def test_hash_is_independent_of_argument_order(spark):
    df = spark.createDataFrame([(1, "x")], "b int, a string")
    assert df.select(T.canonical_hash8("a", "b")).first() == df.select(T.canonical_hash8("b", "a")).first()
    v = df.select(T.version_id(F.lit(7), F.lit("20250101"), F.lit("gbt"), F.lit("abcd1234"))).first()[0]
    assert v == "v0007_20250101_gbt_abcd1234"
