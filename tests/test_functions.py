"""Scalar functions on the awkward values ledgers hold."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from motorledger import values as V
from motorledger.functions import classes, dates, nulls, numbers, text


def apply(spark, value, fn, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(fn("c").alias("r")).first()[0]


@pytest.mark.parametrize(
    ("value", "mode", "expected"),
    [
        ("1,234", "coerce", 0.0), ("1,234", "strip_commas", 1234.0), ("-12.5", "coerce", -12.5), ("-12.5", "digits_only", 12.5),
        ("nan", "coerce", 0.0), (None, "coerce", 0.0), ("", "coerce", 0.0), ("12d", "coerce", 0.0), (" 7 ", "coerce", 7.0),
        ("1e3", "coerce", 1000.0), ("约3.5元", "digits_only", 3.5), ("1.2.3", "digits_only", 0.0), (".5", "coerce", 0.5),
    ],
)
def test_to_number(spark, value, mode, expected):
    assert apply(spark, value, lambda c: numbers.to_number(c, mode)) == expected


def test_to_number_keeps_sign_and_rejects_unknown_modes(spark):
    assert apply(spark, "-1,2", lambda c: numbers.to_number(c, "digits_only", keep_sign=True)) == -12.0
    with pytest.raises(ValueError):
        numbers.to_number("c", "guess")


@pytest.mark.parametrize(
    ("value", "expected"),
    [("36,24", "36期"), ("None", "0期"), (None, "0期"), ("48.0", "48期"), ("12期", "0期"), ("24", "24期")],
)
def test_loan_term(spark, value, expected):
    assert apply(spark, value, numbers.loan_term) == expected


@pytest.mark.parametrize(("value", "expected"), [("", ""), (None, ""), ("0", ""), ("13800.0", "13800"), ("ab1", "ab1"), ("0139", "139")])
def test_phone_text(spark, value, expected):
    assert apply(spark, value, numbers.phone_text) == expected


@pytest.mark.parametrize(("value", "expected"), [("免考核", 0.0), ("", None), (None, None), ("-20000", -20000.0), (" ", None)])
def test_incentive_number(spark, value, expected):
    assert apply(spark, value, numbers.incentive_number) == expected


def test_percent_and_term_units(spark):
    assert apply(spark, "5%", numbers.percent_to_fraction) == 0.05
    assert apply(spark, "x%", numbers.percent_to_fraction) is None
    assert apply(spark, "12期", numbers.strip_cjk) == "12"


def test_vat_tax_rounds_half_even_and_ignores_losses(spark):
    assert apply(spark, -5.0, lambda c: numbers.vat_tax(F.col(c)), "double") == 0.0
    assert apply(spark, 1130.0, lambda c: numbers.vat_tax(F.col(c)), "double") == 145.6


@pytest.mark.parametrize(
    ("value", "expected"),
    [
        ("2025/3/1", datetime(2025, 3, 1)), ("2025-03-01 10:20:30", datetime(2025, 3, 1, 10, 20, 30)), ("20250301", datetime(2025, 3, 1)),
        ("2025年3月1日", datetime(2025, 3, 1)), ("202503", None), ("2025年3月", None), ("bad", None), ("", None), ("2025-13-01", None),
        ("2025-03-01T08:00:00", datetime(2025, 3, 1, 8)), ("2025/3/1 9:5:7", datetime(2025, 3, 1, 9, 5, 7)),
    ],
)
def test_parse_ts(spark, value, expected):
    assert apply(spark, value, dates.parse_ts) == expected


@pytest.mark.parametrize(
    ("value", "expected"),
    [("2025年3月", datetime(2025, 3, 1)), (" 2025年12月5日", datetime(2025, 12, 5)), ("2025-03-01 01:02:03", datetime(2025, 3, 1, 1, 2, 3)), ("2025/3/1", None), (None, None)],
)
def test_parse_cn_date(spark, value, expected):
    assert apply(spark, value, dates.parse_cn_date) == expected


@pytest.mark.parametrize(
    ("value", "expected"),
    [("2025年3月", date(2025, 3, 1)), ("约 2025 年 03 月", date(2025, 3, 1)), ("2025/3/17", date(2025, 3, 1)), ("202511", date(2025, 11, 1)), ("202513", None), ("2025年13月", None), (None, None)],
)
def test_month_start(spark, value, expected):
    assert apply(spark, value, dates.month_start) == expected


def test_month_ends_and_serials(spark):
    assert apply(spark, date(2024, 2, 29), dates.month_end, "date") == date(2024, 2, 29)
    assert apply(spark, "45717", dates.excel_date) == date(2025, 3, 1)
    df = spark.createDataFrame([("2024年", "2月份"), ("x", "2"), ("2024", "13")], "y string, m string")
    assert [r[0] for r in df.select(dates.month_end_from("y", "m")).collect()] == [date(2024, 2, 29), None, None]


def test_days_are_floored_and_three_valued_labels(spark):
    df = spark.createDataFrame(
        [(datetime(2025, 1, 1), datetime(2025, 1, 1, 12)), (datetime(2025, 4, 1), datetime(2025, 1, 1)), (None, datetime(2025, 1, 1))],
        "a timestamp_ntz, b timestamp_ntz",
    )
    got = df.select(
        dates.days_between("a", "b"), dates.within_days("a", "b"), dates.within_months("a", "b"), dates.later_date("a", "b"),
        dates.same_month("a", "b"), dates.date_label("a", dates.when_at("2025-02-01")),
    ).collect()
    assert tuple(got[0]) == (-1, V.NO, V.YES, datetime(2025, 1, 1, 12), 1, V.NO)
    assert tuple(got[1]) == (90, V.YES, V.NO, datetime(2025, 4, 1), 0, V.YES)
    assert tuple(got[2]) == (None, V.NO, V.DATE_MISSING, datetime(2025, 1, 1), 0, V.DATE_EMPTY)


def test_later_date_gives_the_second_even_when_null(spark):
    df = spark.createDataFrame([(date(2025, 1, 1), None)], "a date, b date")
    assert df.select(dates.later_date("a", "b")).first()[0] is None


def test_null_rules(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,), ("",)], "c string")
    keep = lambda cond: [r[0] for r in df.where(cond).collect()]
    assert keep(nulls.not_in("c", ["a"])) == ["b", None, ""]
    assert keep(nulls.not_in("c", [])) == ["a", "b", None, ""]
    assert keep(nulls.differs("c", "a")) == ["b", None, ""]
    assert keep(nulls.non_empty("c")) == ["a", "b"]
    assert keep(nulls.contains("c", "a")) == ["a"]
    assert keep(nulls.contains("c", "a", na=True)) == ["a", None]


def test_row_sums_and_means(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (2.0, 4.0)], "a double, b double")
    got = df.select(nulls.row_sum(["a", "b"]), nulls.row_sum(["a", "b"], min_count=1), nulls.row_mean(["a", "b"]), nulls.count_positive(["a", "b"], {"a": 2})).collect()
    assert [tuple(r) for r in got] == [(1.0, 1.0, 1.0, 2), (0.0, None, 0.0, 0), (6.0, 6.0, 3.0, 3)]


def test_bands_are_left_closed_and_open_ended(spark):
    df = spark.createDataFrame([(-1.0,), (0.0,), (100000.0,), (9e9,), (None,)], "p double")
    got = [r[0] for r in df.select(classes.band("p", V.PRICE_EDGES, V.PRICE_LABELS)).collect()]
    assert got == [None, "0-10万", "10-15万", "35-40万", None]


def test_stock_age_and_status(spark):
    df = spark.createDataFrame([(200, "在途"), (200, "在库"), (None, "在库"), (30, None)], "d int, s string")
    assert [r[0] for r in df.select(classes.stock_age_class("d", "s")).collect()] == ["未到库", "180天以上", "30天以下", "30-60天"]
    got = [r[0] for r in df.select(classes.map_status("s", {"在途": "x"}, "other")).collect()]
    assert got == ["x", "other", "other", None]


def test_party_kinds(spark):
    df = spark.createDataFrame([("ACME", "调拨"), ("A long buyer", "调拨"), ("A long buyer", "x"), (None, "调拨")], "b string, t string")
    got = [r[0] for r in df.select(classes.transfer_kind("b", "t", ["other"])).collect()]
    assert got == [V.INTERNAL_OUT, V.EXTERNAL_OUT, None, None]


def test_text_helpers(spark):
    assert apply(spark, "a b c", text.after_first) == "b c"
    assert apply(spark, "abc", text.after_first) == "abc"
    assert apply(spark, "  A  B\tKm ", text.normalize_text) == "a b KM"
    assert apply(spark, None, text.normalize_text) == ""
    assert apply(spark, "招商光大", text.bank_name) == "光大"
    assert apply(spark, None, text.bank_name) is None
    assert text.header(" 车架\n号 ") == "车架号"


def test_match_keys_do_not_collide(spark):
    df = spark.createDataFrame([("ab", "c"), ("a", "bc"), (None, "abc")], "x string, y string")
    assert df.select(text.match_key(["x", "y"])).distinct().count() == 3
