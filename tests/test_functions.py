from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from millrace.functions import dates, money


def one(spark, value, expression, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expression.alias("y")).first()["y"]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Tokyo"])
@pytest.mark.parametrize("text,expected", [
    ("2026-10-24T21:30:00Z", date(2026, 10, 25)),      # still summer time
    ("2026-10-25T21:30:00Z", date(2026, 10, 25)),      # winter time since the morning
    ("2026-11-14T22:00:00Z", date(2026, 11, 15)),
    ("2026-03-28T21:59:59Z", date(2026, 3, 28)),
])
def test_local_date_does_not_depend_on_the_session_zone(spark, zone, text, expected):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert one(spark, text, dates.local_date(dates.parse_timestamp("x"))) == expected
        assert one(spark, text, dates.parse_date_or_instant("x")) == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize("text,kind", [("2026-11-02", "date"), ("2026-11-01T22:00:00Z", "utc_instant"),
                                       ("02/11/2026", "invalid"), (None, None), ("2026-13-40", "invalid")])
def test_date_format_kind(spark, text, kind):
    assert one(spark, text, dates.date_format_kind("x")) == kind


@pytest.mark.parametrize("text,value", [("12.50", Decimal("12.50")), ("12,50", None), ("n/a", None), ("12.555", None),
                                        ("-8.32", Decimal("-8.32")), ("7", Decimal("7.00")), ("", None), (None, None)])
def test_money_is_never_corrected(spark, text, value):
    assert one(spark, text, money.parse_money("x")) == value


def test_half_up(spark):
    assert one(spark, Decimal("2.345"), money.half_up("x"), "decimal(10,3)") == Decimal("2.35")
    assert one(spark, Decimal("-2.345"), money.half_up("x"), "decimal(10,3)") == Decimal("-2.35")


@pytest.mark.parametrize("score,band", [(999, "A"), (800, "A"), (799, "B"), (650, "B"), (500, "C"), (350, "D"), (349, "E"), (None, None)])
def test_bands(spark, score, band):
    assert one(spark, score, money.band("x"), "int") == band


def iban(bban):
    return f"LT{98 - int(bban + '212900') % 97:02d}{bban}"


@pytest.mark.parametrize("text,valid", [(iban("1234567890123456"), True), (iban("0000000000000000"), True),
                                        ("LT00" + "1" * 16, False), ("LV" + iban("1" * 16)[2:], False), ("LT12", False), (None, None)])
def test_iban(spark, text, valid):
    assert one(spark, text, money.iban_valid("x")) is valid


@pytest.mark.parametrize("rating,risk,ok", [("low", 3, True), ("low", 4, False), ("medium", 5, True), ("high", 7, True), ("none", 1, None)])
def test_suitability(spark, rating, risk, ok):
    assert one(spark, rating, money.suitable(F.lit(risk), "x")) is ok


@pytest.mark.parametrize("channel,device,ok", [("pos", "pos_terminal", True), ("mobile_app", "ios", True),
                                               ("mobile_app", "pos_terminal", False), ("fax", "ios", False)])
def test_devices(spark, channel, device, ok):
    assert one(spark, channel, money.device_allowed("x", F.lit(device))) is ok


def test_sequence_round_trip(spark):
    made = one(spark, date(2026, 9, 1), dates.change_sequence("x", F.lit(1)), "date")
    assert made == 202609010000001
    assert one(spark, made, dates.sequence_day("x"), "bigint") == date(2026, 9, 1)
    assert one(spark, 999999990000001, dates.sequence_day("x"), "bigint") is None


def test_hash_tells_null_from_empty(spark):
    df = spark.createDataFrame([(None, "a"), ("", "a"), ("a", None)], "x string, y string")
    assert df.select(money.null_safe_hash("x", "y").alias("h")).distinct().count() == 3


def test_report_month(spark):
    assert one(spark, date(2026, 1, 2), dates.report_month("x"), "date") == "2025-12"


def test_signed_amounts(spark):
    df = spark.createDataFrame([("refund", 1), ("salary_in", 1), ("purchase", 1)], "k string, a int")
    assert [r[0] for r in df.select(money.signed_amount("k", "a")).collect()] == [1, 1, -1]
