"""Hand-computed results of the column functions."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelwright.functions import scalars as S


def apply(spark, fn, values, kind="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {kind}").coalesce(1)
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


@pytest.mark.parametrize("fn, cases", [
    (S.clean_price_string, {"Rp 45.000": 45000, "45,500": 45500, "0": 0, "-": None, "": None, "45 000": None,
                            "-5": None, "45.000,50": 4500050, " 45.000 ": 45000, None: None}),
    (S.clean_price, {" 45.000 ": 45000.0, "nan": None, "None": None, "-": None, "": None, "Rp 45.000": None,
                     "-500": -500.0, "1e5": 100000.0, "5d": None, None: None}),
    (S.clean_shop_price, {None: 0, "Rp 45.000": 45000, "45,000": 45000, "45.5": 45500, "12.34": 1234,
                          "45000.0": 45000000, "abc": None, "1.x": None, "": None}),
    (S.clean_rating, {"4,8": 4.8, " 5 ": 5.0, "baru": 0.0, None: 0.0, "nan": 0.0}),
    (S.normalize_name, {"D.K.I. Jakarta": "DKIJAKARTA", "di  yogyakarta": "DIYOGYAKARTA"}),
    (S.header_date, {"01/ 12/ 2025": dt.date(2025, 12, 1), "1/2/2025": dt.date(2025, 2, 1), "x": None,
                     "31/02/2026": None, "1/2": None, "1/2/3/4": None}),
    (S.to_date_or_null, {" 2025-01-02 ": dt.date(2025, 1, 2), "2025-01-02 00:00:00": dt.date(2025, 1, 2),
                         "besok": None, "": None}),
    (S.file_stem, {"/a/Jawa Barat_Cabai.csv": "Jawa Barat_Cabai", "x.y/b": "b"}),
    (S.file_key, {"DKI Jakarta": "DKI_Jakarta"}),
    (S.blank_if_null, {None: "", "a": "a"}),
])
def test_text(spark, fn, cases):
    assert apply(spark, fn, list(cases)) == list(cases.values())


@pytest.mark.parametrize("fn, kind, cases", [
    (S.rupiah, "bigint", {500: "Rp 500", 1234567: "Rp 1.234.567"}),
    (S.round_to, "double", {150.0: 200.0, 250.0: 200.0, 350.0: 400.0, 45050.0: 45000.0, 45150.0: 45200.0}),
    (S.round_int, "double", {0.5: 0, 1.5: 2, 2.5: 2}),
    (S.clip01, "double", {-1.0: 0.0, 0.25: 0.25, 7.0: 1.0, None: None}),
    (S.iso_date, "date", {dt.date(2025, 3, 4): "2025-03-04"}),
])
def test_numbers(spark, fn, kind, cases):
    assert apply(spark, fn, list(cases), kind) == list(cases.values())


def test_numeric_price_keeps_fraction_and_drops_nan(spark):
    clean = lambda c: S.clean_price(c, T.DoubleType())
    assert apply(spark, clean, [12.5, float("nan"), None], "double") == [12.5, None, None]


def test_shop_price_of_numbers(spark):
    assert apply(spark, S.clean_shop_price, [45000, None], "int") == [45000, 0]


def test_stem_keys_cut_at_first_underscore(spark):
    df = spark.createDataFrame([("Jawa Barat_Cabai Rawit Merah",), ("a_b_c",), ("abc",)], "s string").coalesce(1)
    rows = df.select(*S.stem_keys(F.col("s"), ("p", "j"))).collect()
    assert [tuple(r) for r in rows] == [("Jawa Barat", "Cabai Rawit Merah"), ("a", "b_c"), (None, None)]


def test_scale_has_no_clipping_and_constant_is_zero(spark):
    df = spark.range(1)
    row = df.select(S.scale(F.lit(25.0), F.lit(10.0), F.lit(20.0)), S.scale(F.lit(5.0), F.lit(5.0), F.lit(5.0)),
                    S.unscale(F.lit(1.5), F.lit(10.0), F.lit(20.0))).first()
    assert tuple(row) == (1.5, 0.0, 25.0)


def test_one_hot_slots_follow_sorted_levels(spark):
    df = spark.createDataFrame([("b",), ("a",), ("z",)], "v string").coalesce(1)
    rows = [r[0] for r in df.select(S.one_hot(F.col("v"), ["c", "a", "b"])).collect()]
    assert rows == [[0, 1, 0], [1, 0, 0], [0, 0, 0]]


def test_implausible(spark):
    fn = lambda c: S.implausible(c, 500000)
    assert apply(spark, fn, [-1.0, 0.0, 500000.0, 500001.0, None], "double") == [True, False, False, True, True]


def test_same_text_ignores_case_and_accents_on_request(spark):
    df = spark.createDataFrame([("ACÉH",)], "v string")
    assert df.filter(S.same_text(F.col("v"), "aceh", True)).count() == 1
    assert df.filter(S.same_text(F.col("v"), "aceh")).count() == 0
