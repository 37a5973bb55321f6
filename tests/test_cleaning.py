"""Every branch of the scalar functions."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from marajo.functions import cleaning as C


def apply(spark, f, values, kind="string"):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.x for r in frame.select("i", f(F.col("v")).alias("x")).orderBy("i").collect()]


def test_money(spark):
    given = ["0000034679700,00", "34.679.700,00", "34679700,00", "34679700.00", None, "", " ", "None", "NaN", "xNaN", "abc", "-1.234,56", "0,5", "00,00", "12"]
    want = [34679700, 34679700, 34679700, 34679700, 0, 0, 0, 0, 0, 0, None, Decimal("-1234.56"), Decimal("0.5"), 0, 12]
    assert apply(spark, C.parse_financial, given) == want


def test_numbers(spark):
    assert apply(spark, C.parse_int, ["1", " 2 ", "None", "", None, "x", "1.5"]) == [1, 2, None, None, None, None, None]
    assert apply(spark, lambda c: C.parse_numeric(c, "double"), ["1,5", "1.5", "None", "", "x", None]) == [1.5, 1.5, None, None, None, None]
    assert apply(spark, C.num_br, ["1.234,5", "-", "", " 7 ", "x", None, "-3,25"]) == [1234.5, None, None, 7.0, None, None, -3.25]
    assert apply(spark, C.null_sentinels, ["-", "..", "...", "", "1", None]) == [None, None, None, "", "1", None]
    assert apply(spark, lambda c: C.scale_round(c, 1000), ["1250", "1350", "-1250", None]) == [1.3, 1.4, -1.3, None]


def test_dates(spark):
    d = dt.date
    given = ["31/12/2024", "20241231", "2024-12-31", "2024-12-31 10:00", "31/02/2024", "99999999", "", None, "12/2024"]
    assert apply(spark, C.parse_date_br, given) == [d(2024, 12, 31)] * 4 + [None] * 5
    assert apply(spark, C.parse_date_ddmmyyyy, ["31122024", "3112024", "31132024", None]) == [d(2024, 12, 31), None, None, None]
    assert apply(spark, C.period_to_date, ["202402", "202413", "x", None]) == [d(2024, 2, 1), None, None, None]
    assert apply(spark, lambda c: C.period_to_date(c, "mm/yyyy"), ["02/2024", "13/2024"]) == [d(2024, 2, 1), None]
    assert apply(spark, lambda c: C.quarter_start(F.lit(2025), c), ["4T2025", "1", "5T2025", "T", None]) == [d(2025, 10, 1), d(2025, 1, 1), None, None, None]
    assert apply(spark, lambda c: C.month_start(F.lit(2025), c), [1, 12, 0, 13, None], "int") == [d(2025, 1, 1), d(2025, 12, 1), None, None, None]
    assert apply(spark, lambda c: C.days_between(c, F.lit("2020-01-01")), ["2020-01-31", "1900-01-01", None]) == [30, None, None]


def test_keys(spark):
    given = ["0626780-03", "62678003", "626780", "0064659798", " ", None, "a1"]
    assert apply(spark, C.normalize_key, given) == ["62678003", "62678003", "00626780", "64659798", None, None, "00000001"]
    assert apply(spark, lambda c: C.normalize_key(c, compat=True), given)[0] == "06267800"
    assert apply(spark, C.format_cnpj, ["12.345.678/0001-95", "345678000195", "", None]) == ["12.345.678/0001-95", "00.345.678/0001-95", None, None]
    assert apply(spark, C.flag_s, ["S", " S ", "N", "", None]) == [True, True, False, False, False]
    assert apply(spark, lambda c: C.clean_text(c, none=True), [" a ", "None", "", None]) == ["a", None, None, None]
    assert [x and tuple(x) for x in apply(spark, C.split_note_number, ["2024NC000123", "short", None])] == [("2024", "000123"), None, None]
    assert [x and tuple(x) for x in apply(spark, C.split_control_number, ["0001-1-000007/2024", "0001-1/2024", None])] == [("0001", "1", 7, 2024), None, None]


def test_labels_and_ratios(spark):
    assert apply(spark, lambda c: C.decode(c, {"1": "A"}), ["1", "2", None]) == ["A", "OUTRO (2)", "OUTRO (N/A)"]
    assert apply(spark, lambda c: C.bucket(c, {"g": ["a", "b"]}, "rest"), ["a", "c", None]) == ["g", "rest", "rest"]
    assert apply(spark, lambda c: C.safe_ratio(c, F.lit(0)), [1, None], "int") == [0.0, 0.0]
    assert apply(spark, lambda c: C.search_label(c, F.lit(None), F.lit("DF"), F.lit("casa")), ["1"]) == ["1 - /DF - CASA"]
    assert apply(spark, lambda c: C.sum_components(c, F.lit(1)), [2, None], "int") == [3, 1]


@pytest.mark.parametrize("triple,want", [((0, 0, 0), None), ((-15, 30, 36), -15.51), ((0, 30, 0), 0.5), ((None, 1, 1), None)])
def test_coordinates(spark, triple, want):
    got = spark.createDataFrame([triple], "d int, m int, s int").select(C.null_dms("d", "m", "s")).first()[0]
    assert got == (want if want is None else pytest.approx(want))
