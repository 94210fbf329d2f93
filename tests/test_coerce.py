"""C1-C14 on literal edge cases."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from konform.functions import coerce as C


def one(spark, values, fn, schema="v string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(fn(F.col("v")).alias("o")).collect()]


def test_to_int_truncates_and_defaults(spark):
    got = one(spark, ["1.9", "-1.9", " 12 ", "1e3", "abc", None, "inf", "NaN", "9999999999999999999", "42"],
              C.to_int)
    assert got == [1, -1, 12, 1000, 0, 0, 0, 0, 0, 42]


def test_to_tinyint_wraps(spark):
    got = one(spark, [None, 5, 256, 300, -5], lambda c: C.to_tinyint(c), "v long")
    assert got == [0, 5, 0, 44, 251]


def test_to_tinyint_strict_fails_on_text(spark):
    with pytest.raises(Exception):
        one(spark, ["abc"], lambda c: C.to_tinyint(c, strict=True))


def test_to_decimal(spark):
    got = one(spark, ["12.5", " -0 ", None, "1e3"], lambda c: C.to_decimal(c, strict=False))
    assert got == [Decimal("12.5"), Decimal("0"), None, Decimal("1000")]
    with pytest.raises(Exception):
        one(spark, ["twelve"], lambda c: C.to_decimal(c, strict=True))


def test_to_bit(spark):
    got = one(spark, ["True", "1", "FALSE", "0", None, "yes", "1.0"], C.to_bit)
    assert got == [True, True, False, False, False, False, False]


def test_to_string_trim_and_null(spark):
    assert one(spark, ["  a ", None], lambda c: C.to_string(c, trim=True)) == ["a", None]
    assert one(spark, ["  a ", None], C.to_string) == ["  a ", None]


def test_uuid_forms(spark):
    u = "0123456789abcdef0123456789abcdef"
    canon = "01234567-89ab-cdef-0123-456789abcdef"
    vals = [canon, "{" + u.upper() + "}", "urn:uuid:" + canon, u, "nope", None]
    assert one(spark, vals, lambda c: C.to_uuid(c, strict=False)) == [canon, canon, canon, canon, None, None]
    with pytest.raises(Exception):
        one(spark, ["nope"], lambda c: C.to_uuid(c, strict=True))
    assert one(spark, [5], lambda c: C.to_uuid(c, strict=False, numeric_input=True), "v long") == [None]


def test_to_date(spark):
    got = one(spark, ["/Date(86400000)/", "/Date(-1)/", "2024-03-05", "05-03-2024", "2024-02-31", "x", None],
              C.to_date)
    assert got == [dt.date(1970, 1, 2), dt.date(1969, 12, 31), dt.date(2024, 3, 5), dt.date(2024, 3, 5),
                   None, None, None]


def test_to_datetime_drops_offset(spark):
    got = one(spark, ["2024-01-01T23:30:00+02:00", "2024-01-01 23:30:00.5Z", "2024-01-01T08:00:00",
                      "05-03-2024 17:05:00", "/Date(1000)/", "2024-13-01", "garbage"], C.to_datetime)
    assert got == [dt.datetime(2024, 1, 1, 23, 30), dt.datetime(2024, 1, 1, 23, 30, 0, 500000),
                   dt.datetime(2024, 1, 1, 8), dt.datetime(2024, 3, 5, 17, 5), dt.datetime(1970, 1, 1, 0, 0, 1),
                   None, None]
    assert one(spark, [1500], lambda c: C.to_datetime(c, numeric_input=True), "v long") == [
        dt.datetime(1970, 1, 1, 0, 0, 1, 500000)]


def test_datetime_text(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 2, 3, 4, 5),)], "v timestamp_ntz")
    assert df.select(C.datetime_text(F.col("v"))).first()[0] == "2024-01-02 03:04:05"


def test_coerce_table_policies(spark):
    df = spark.createDataFrame([("1", "x")], "a string, b string")
    types = [("a", "int"), ("b", "nvarchar"), ("c", "bit"), ("d", "decimal")]
    with pytest.raises(ValueError):
        C.coerce_table(df, types, C.ACCOUNTING)
    out = C.coerce_table(df, types, C.ERP)
    assert out.columns == ["a", "b", "c", "d"]
    assert tuple(out.first()) == (1, "x", False, None)
    with pytest.raises(ValueError):
        C.coerce_table(df, [("a", "money")], C.ERP)


def test_audit_counts(spark):
    df = spark.createDataFrame([("1", "2024-01-01"), ("x", "bad"), (None, None)], "a string, b string")
    r = C.audit(df, [("a", "int"), ("b", "date")]).first()
    assert (r["a"], r["b"]) == (1, 1)


def test_metadata_cast(spark):
    df = spark.createDataFrame([("12", "3.456", "2024-01-01", "k")], "a string, b string, c string, d string")
    out = C.metadata_cast(df, {"a": "int", "b": "decimal(10,2)", "c": "date", "d": None})
    assert out.dtypes == [("a", "int"), ("b", "decimal(10,2)"), ("c", "date"), ("d", "string")]
    assert tuple(out.first()) == (12, Decimal("3.46"), dt.date(2024, 1, 1), "k")
