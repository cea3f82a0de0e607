"""Edge values of every cleaning function, in ANSI mode."""

from __future__ import annotations

import re
from datetime import date
from decimal import ROUND_HALF_UP, Decimal, localcontext

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strataflow import functions as fn


def apply(spark, function, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [row[0] for row in df.orderBy("i").select(function(F.col("v"))).collect()]


def test_ansi_mode_is_left_on(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"


def test_money(spark):
    values = ["609$", "4966", "USD 12.50", "-$1,234.50 USD", "19.995", "", "abc", "1.2.3", "123456789.1", None]
    expected = ["609.00", "4966.00", "12.50", "1234.50", "20.00", None, None, None, None, None]
    assert apply(spark, fn.money, values) == [e and Decimal(e) for e in expected]


def test_money_with_decimal_comma(spark):
    read = lambda c: fn.money(c, decimal_comma=True, as_type="double")
    assert apply(spark, read, ["12,50 USD", "609$", "1,234.50", "", "USD"]) == [12.5, 609.0, None, None, None]


def test_whole_number(spark):
    assert apply(spark, fn.whole_number, [" 12 ", "12.7", "abc", "", None, "99999999999"]) == [
        12,
        None,
        None,
        None,
        None,
        None,
    ]


DAY = date(2022, 9, 1)


@pytest.mark.parametrize(
    ("text", "strict", "lenient", "normalised", "normalised_timed"),
    [
        ("2022-09-1", DAY, DAY, DAY, DAY),
        ("2022-09-01", DAY, DAY, DAY, DAY),
        ("2022-9-1", DAY, DAY, DAY, DAY),
        ("2022/09/1", None, DAY, None, None),
        ("2022-02-30", None, None, None, None),
        ("2022-09-1 10:00", None, DAY, None, DAY),
        ("2022-09-01T12:34:56", None, DAY, None, DAY),
        (" 2022-09-01 ", None, DAY, DAY, DAY),
        ("unknown", None, None, None, None),
        ("2022-9-123", None, None, None, None),
        ("", None, None, None, None),
        (None, None, None, None, None),
    ],
)
def test_days(spark, text, strict, lenient, normalised, normalised_timed):
    v = F.lit(text).cast("string")
    row = spark.range(1).select(
        fn.day_unpadded(v), fn.day_lenient(v), fn.day_normalised(v), fn.day_normalised(v, time_part=True)
    )
    assert tuple(row.first()) == (strict, lenient, normalised, normalised_timed)


def test_padded_day_refuses_unpadded_text(spark):
    assert apply(spark, fn.day_padded, ["2022-09-01", "2022-09-1", "2022/09/01"]) == [DAY, None, None]


def test_day_text(spark):
    assert apply(spark, fn.day_text, ["2022-9-1", "2022-12-31", "22-9-1", "2022-9"]) == [
        "2022-09-01",
        "2022-12-31",
        None,
        None,
    ]


def test_timestamp_text(spark):
    got = apply(spark, lambda c: fn.timestamp_text(c).cast("string"), ["2022-09-01 10:11:12", "2022-09-01", "x"])
    assert got == ["2022-09-01 10:11:12", None, None]


def test_names(spark):
    names = ["Jorge Sullivan", "Ann Mary Lee", "Cher", "Two  Spaces", None]
    assert apply(spark, fn.first_name_of, names) == ["Jorge", "Ann", "Cher", "Two", None]
    assert apply(spark, fn.last_name_of, names) == ["Sullivan", "Mary Lee", None, " Spaces", None]


@pytest.mark.parametrize(
    ("born", "today", "mean", "exact"),
    [
        ("2002-09-01", "2022-09-01", 20, 20),
        ("2022-09-01", "2023-09-01", 0, 1),
        ("2000-02-29", "2021-02-28", 20, 21),
        (None, "2022-09-01", None, None),
    ],
)
def test_ages(spark, born, today, mean, exact):
    born, today = F.lit(born).cast("date"), F.lit(today).cast("date")
    assert tuple(spark.range(1).select(fn.age_years(born, today), fn.age_exact(born, today)).first()) == (mean, exact)


def test_age_band(spark):
    assert apply(spark, fn.age_band, [0, 9, 10, 27, None], "bigint") == ["0-9", "0-9", "10-19", "20-29", None]


def test_text_helpers(spark):
    assert apply(spark, fn.blank_to_null, [" ", "", " a ", None]) == [None, None, "a", None]
    assert apply(spark, fn.email_key, [" A@B.Com "]) == ["a@b.com"]
    assert apply(spark, lambda c: fn.without_token(c, "N/A"), ["N/A", "xN/Ay", "NA"]) == ["", "xy", "NA"]
    valid = apply(spark, lambda c: c.rlike(fn.LIKELY_EMAIL), ["a.b_1@x.example.com", "a@b", "a b@x.com", "a@x.c"])
    assert valid == [True, False, False, False]


PRICE_PIECES = st.sampled_from(["$", "USD ", "-", ",", ".", " ", "x", *"0123456789", "12", "345678", "99999999"])
DATE_PIECES = st.sampled_from(["2022", "1999", "-", "/", "9", "09", "31", "123", "T", " ", "10:00"])


def read_price(text):
    """The rule in plain Python: digits and dots only, eight digits before the point, cents half up."""
    kept = re.sub("[^0-9.]", "", text)
    if not re.fullmatch(r"\d+\.?\d*|\.\d+", kept):
        return None
    with localcontext(prec=1000):  # as many digits as a text may have
        value = Decimal(kept).quantize(Decimal("0.01"), ROUND_HALF_UP)
    return value if value < 10**8 else None


def read_day(text):
    """Year of four digits, month and day of one or two, and a real calendar day."""
    match = re.fullmatch(r"(\d{4})-(\d{1,2})-(\d{1,2})", text)
    try:
        return match and date(*map(int, match.groups()))
    except ValueError:
        return None


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(PRICE_PIECES, max_size=6).map("".join), min_size=150, max_size=300))
def test_any_price_text(spark, texts):
    assert apply(spark, fn.money, texts) == [read_price(text) for text in texts]


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(DATE_PIECES, max_size=6).map("".join), min_size=150, max_size=300))
def test_any_date_text(spark, texts):
    strict = [read_day(text) for text in texts]
    assert apply(spark, fn.day_unpadded, texts) == strict
    assert apply(spark, fn.day_normalised, texts) == [read_day(text.strip(" ")) for text in texts]
    whole = [text.strip(" ").replace("/", "-") for text in texts]
    assert apply(spark, fn.day_lenient, texts) == [read_day(re.split(r"[T\s]", text)[0]) for text in whole]
