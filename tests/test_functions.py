"""Literal cases for every column function, branch by branch."""

import datetime as dt
import hashlib
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from opsmart.functions import dates, keys, numbers, phone, similarity, sku, text

D = dt.date


def S(v):
    return F.lit(v).cast("string")


@pytest.mark.parametrize("raw, want", [
    ("1,234", 1234.0), ("$1,234.50", 1234.5), ("abc", None), ("", None), (None, None), ("(12.50)", None), ("-3", -3.0),
])
def test_parse_amount(value, raw, want):
    assert value(numbers.parse_amount(S(raw))) == want


@pytest.mark.parametrize("raw, want", [("1,234.5", 1235), ("2.4", 2), ("x", None), (None, None)])
def test_parse_count(value, raw, want):
    assert value(numbers.parse_count(S(raw))) == want


@pytest.mark.parametrize("raw, want", [("12", 12), ("12.5", 13), ("n/a", None), ("", None)])
def test_parse_int(value, raw, want):
    assert value(numbers.parse_int(S(raw))) == want


def test_parse_wide_integer(value):
    assert value(numbers.parse_wide_integer(S("12345678901234567890123456789012345678"))) == Decimal("12345678901234567890123456789012345678")
    assert value(numbers.parse_wide_integer(S("1Z999"))) is None


def test_ratio(value):
    assert value(numbers.ratio(F.lit(1), F.lit(0))) is None
    assert value(numbers.ratio(F.lit(None).cast("int"), F.lit(2))) is None
    assert value(numbers.ratio(F.lit(1), F.lit(4), per=100)) == 25.0
    assert value(numbers.ratio(F.lit(354779.53), F.lit(2), 2)) == 177389.77
    assert value(numbers.from_micros(F.lit(2500000))) == 2.5


@pytest.mark.parametrize("raw, want", [
    ("01/02/23", D(2023, 1, 2)), ("1/2/23", D(2023, 1, 2)), ("01/02/2023", D(2023, 1, 2)), (" 12/31/2022 ", D(2022, 12, 31)),
    ("2023-01-02", None), ("13/45/2023", None), ("soon", None), (None, None),
])
def test_parse_slash_date(value, raw, want):
    assert value(dates.parse_slash_date(S(raw))) == want


@pytest.mark.parametrize("raw, want", [
    ("03/31/2023 11:59:00 PM", dt.datetime(2023, 3, 31, 23, 59)), ("3/1/2023 12:00:00 AM", dt.datetime(2023, 3, 1)),
    ("31.03.2023", None), (None, None),
])
def test_parse_us_timestamp(value, raw, want):
    assert value(dates.parse_us_timestamp(S(raw))) == want


def test_calendar_helpers(value):
    assert value(dates.serial_date(F.lit(45000))) == D(2023, 3, 15)
    assert value(dates.leading_date(S("2023-04-05T10:00"))) == D(2023, 4, 5)
    assert value(dates.leading_date(S("TBD"))) is None
    assert value(dates.report_date(S("stock_2023-02-03_x.csv"), "stock_")) == D(2023, 2, 3)
    assert value(dates.is_month_end(F.lit(D(2024, 2, 29)))) is True
    assert value(dates.is_month_end(F.lit(D(2023, 2, 27)))) is False
    assert value(dates.is_month_end(F.lit(None).cast("date"))) is False


@pytest.mark.parametrize("raw, want", [
    ("000123", "123"), ("A0012", "A0012"), ("000", ""), ("12 3", "12 3"), (None, None), ("7", "7"),
])
def test_strip_leading_zeros(value, raw, want):
    assert value(text.strip_leading_zeros(S(raw))) == want


def test_text_helpers(value):
    assert value(text.full_match(S("a12b"), r"\d+")) is False
    assert value(text.full_match(S("12"), r"\d+|x")) is True
    assert value(text.flag(S(None) == "x")) is False
    assert value(text.code_of(S("810-Invoice"))) == "810"
    assert value(text.label_of(S("810-Invoice"))) == "Invoice"
    assert value(text.is_cancelled(S("01/02/2023- CAN"))) is True
    assert value(text.is_cancelled(S("01/02/2023-CAN"))) is True
    assert value(text.is_cancelled(S(None))) is False
    assert value(text.without_cancel_mark(S("01/02/2023- CAN"))) == "01/02/2023"
    assert value(text.blank_to_null(S(""))) is None
    assert value(text.blank_to_null(S("N/A"), "N/A")) is None
    assert value(text.resource_id(F.lit(None).cast("bigint"), S("customers/1/adGroups/77"), "adGroups/")) == "77"
    assert value(text.resource_id(F.lit(5), S("customers/1/adGroups/77"), "adGroups/")) == "5"
    assert value(text.any_ilike(S("utm SPRING sale"), ["%spring%", "%x%"])) is True
    assert value(text.any_ilike(S(None), ["%spring%"])) is False


@pytest.mark.parametrize("raw, history, current, line", [
    (".ABC-DELETE", "ABC", "ABC", "ABC"),
    ("AB C-DELETE", "ABC", "AB C", "AB C"),
    ("ABC SKU#:A12-34/0123", "ABC", "ABC", "ABC SKU#:A12-34/0123"),
    ("AB/C SKU#:0123", "AB", "AB", "AB/C SKU#:0123"),
    ("A.B", "AB", "A.B", "AB"),
    (" ", " ", " ", ""),
    (".", "", "", ""),
    (None, None, None, None),
])
def test_clean_sku(value, raw, history, current, line):
    assert value(sku.clean_sku_history(S(raw))) == history
    assert value(sku.clean_sku_current(S(raw))) == current
    assert value(sku.clean_sku_line(S(raw))) == line


@pytest.mark.parametrize("raw, history, current", [
    ("ABC SKU#:A12-34/0123", "0123", "0123"), ("ABC SKU#: 0123", "0123", ""), ("ABC SKU#:A12-34", None, ""),
    ("ABC", None, None), (None, None, None),
])
def test_upc(value, raw, history, current):
    assert value(sku.upc_history(S(raw))) == history
    assert value(sku.upc_current(S(raw))) == current


@pytest.mark.parametrize("raw, qualifier, item, want", [
    ("X", "Q1", "B07-11 Soap", "Q1"), ("X", None, "B07-11 Soap", "B07-11"), ("X SKU#:A12-34/1", None, "Soap", "A12-34"),
    ("X", None, "Soap", None), ("X", None, "B07-11Soap", None),
])
def test_location_history(value, raw, qualifier, item, want):
    assert value(sku.location_history(S(raw), S(qualifier), S(item))) == want


def test_item_and_header(value):
    assert value(sku.item_name(S("B07-11 soap bar"))) == "soap bar"
    assert value(sku.item_name(S("soap BARDELETED"))) == "Soap Bar"
    assert value(sku.warehouse_name(S("Warehouse: Reno From 2023-03-31 00:00:00.00"))) == "Reno "
    assert value(sku.header_run_date(S("Warehouse: Reno From 2023-03-31 00:00:00.00"))) == D(2023, 3, 31)
    assert value(sku.header_run_date(S("nothing"))) is None
    assert value(sku.is_misc_supply(S("MISC SUPPLY tape"))) is True
    assert value(sku.is_misc_supply(S(None))) is False
    assert value(sku.location_current(S("X SKU#:A12-34/1"))) == "A12-34"


def test_row_ids(value):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert value(keys.row_id(S("a.csv"), F.lit(7))) == sha("a.csv-7")
    assert value(keys.row_id(S("a"), S(None), S("b"))) is None
    stamp = F.lit("2023-01-02 03:04:05.5").cast("timestamp")
    assert value(keys.row_id(keys.stamp_text(stamp), F.lit(1))) == sha("2023-01-02 03:04:05.500000-1")


@pytest.mark.parametrize("raw, region, want", [
    ("(212) 555-0142", "US", "+12125550142"), ("1-212-555-0142", "US", "+12125550142"), ("+49 30 901820", "US", "+4930901820"),
    ("030 901820", "DE", "+4930901820"), ("020 7946 0000", "GB", "+442079460000"), ("0049 30 901820", "GB", "+4930901820"),
    ("011 49 30 901820", "US", "+4930901820"), ("212-555-0142 ext. 9", "", "+12125550142"), ("212-555-0142", None, "+12125550142"),
    ("555-CALL-NOW", "US", None), ("123", "US", None), ("", "US", None), (None, "US", None), ("+999 12345678", "US", None),
    ("212 555 0142", "ZZ", None), ("+1 212 555 01", "US", None),
])
def test_e164(value, raw, region, want):
    assert value(phone.e164(S(raw), S(region))) == want


@pytest.mark.parametrize("a, b, want", [
    ("martha", "marhta", 0.9611111), ("dwayne", "duane", 0.84), ("dixon", "dicksonx", 0.8133333), ("", "a", 0.0), ("x", "x", 1.0), ("abc", "xyz", 0.0),
])
def test_jaro_winkler(a, b, want):
    assert similarity.jaro_winkler(a, b) == pytest.approx(want, abs=1e-6)


def test_similarity_score():
    assert similarity.similarity_score("ACME", "acme") == 100
    assert similarity.similarity_score(None, "a") is None
    assert similarity.similarity_score("", "a") == 0
