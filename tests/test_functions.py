from __future__ import annotations

import hashlib
from datetime import datetime
from decimal import Decimal

import pandas as pd
from pyspark.sql import functions as F

from meterline.functions import casts, decode, keys, temporal, text


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_safe_casts_give_null_instead_of_errors(spark):
    df = spark.createDataFrame([("1.0",), ("2",), ("x",), (None,), ("2.5",), (" 7 ",), ("99999999999",), ("NaN",)], "v string")
    got = [tuple(r) for r in df.select("v", casts.safe_int(F.col("v")), casts.int_via_double(F.col("v"))).collect()]
    assert got == [
        ("1.0", None, 1), ("2", 2, 2), ("x", None, None), (None, None, None), ("2.5", None, 3),
        (" 7 ", 7, 7), ("99999999999", None, None), ("NaN", None, None),
    ]


def test_casts_of_numbers_skip_the_text_check(spark):
    assert one(spark, casts.safe_int(F.lit(5), is_text=False), casts.int_via_double(F.lit(1.5), is_text=False)) == (5, 2)


def test_numeric_is_exact(spark):
    total = spark.createDataFrame([(0.1,), (0.2,)], "v double").agg(F.sum(casts.numeric(F.col("v")))).first()[0]
    assert total == Decimal("0.3")


def test_payment_labels(spark):
    df = spark.createDataFrame([("1.0",), ("2",), ("3",), ("4",), ("5",), ("6",), ("7",), ("x",), (None,)], "p string")
    got = [r[0] for r in df.select(decode.payment_type_description(F.col("p"))).collect()]
    assert got == ["Credit card", "Cash", "No charge", "Dispute", "Unknown", "Voided trip", "EMPTY", "EMPTY", "EMPTY"]


def test_payment_label_of_a_number(spark):
    assert one(spark, decode.payment_type_description(F.lit(2), is_text=False)) == ("Cash",)


def test_surrogate_key_marks_nulls_and_separates(spark):
    df = spark.createDataFrame([(1, "23"), (12, "3"), (None, "3")], "a int, b string")
    got = [r[0] for r in df.select(keys.surrogate_key(F.col("a"), F.col("b"))).collect()]
    wanted = ["1-23", "12-3", "_dbt_utils_surrogate_key_null_-3"]
    assert got == [hashlib.md5(w.encode()).hexdigest() for w in wanted]


def test_row_hash_collides_without_separator(spark):
    df = spark.createDataFrame([("1", "23"), ("12", "3")], "a string, b string")
    hashes = {r[0] for r in df.select(keys.row_hash(F.col("a"), F.col("b"))).collect()}
    assert hashes == {hashlib.md5(b"123").hexdigest()}
    raw = df.select(keys.row_hash_bytes(F.col("a"), F.col("b"))).first()[0]
    assert bytes(raw) == hashlib.md5(b"123").digest()


def test_base_id_native_and_python_agree(spark):
    @F.pandas_udf("string")
    def base_id_udf(base_number: pd.Series) -> pd.Series:
        number = pd.to_numeric(base_number.astype("string").str[1:], errors="coerce").astype("Int64")
        known = number.dropna().astype("int64")
        letter = pd.Series("e", index=known.index).mask(known % 3 == 0, "a").mask(known % 7 == 0, "s")
        return (letter + "/" + known.map("{:03x}".format)).reindex(base_number.index).astype(object)

    df = spark.createDataFrame([("B02884",), ("B00003",), ("B00001",), ("B00007",), ("B99999",), (None,)], "b string")
    native = [r[0] for r in df.select(text.base_id(F.col("b"))).collect()]
    python = [r[0] for r in df.select(base_id_udf(F.col("b"))).collect()]
    assert native == ["s/b44", "a/003", "e/001", "s/007", "a/1869f", None]
    assert python == native


def test_long_base_numbers_are_read_whole(spark):
    df = spark.createDataFrame([("B0000000000000000028844",), ("B00000000000000002884",), ("B" + "9" * 22,)], "b string")
    assert [r[0] for r in df.select(text.base_id(F.col("b"))).collect()] == ["e/70ac", "s/b44", None]


def test_zero_padding_never_cuts(spark):
    assert one(spark, text.zero_padded(F.lit("7"), 3), text.zero_padded(F.lit("12345"), 3)) == ("007", "12345")


def test_labels(spark):
    ts = F.lit("2020-03-31 23:59:59").cast("timestamp")
    assert one(spark, text.year_quarter(ts), text.digits_only(F.lit("a1b2")), text.zone_label(F.lit("Q"), F.lit(None).cast("string"))) == (
        "2020/Q1", "12", None,
    )
    assert one(spark, text.zone_label(F.lit("Queens"), F.lit("JFK"))) == ("Queens/JFK",)


def test_event_times(spark):
    df = spark.createDataFrame([("2019-10-01 00:26:02",), ("2019-10-01",), ("2019-13-01 00:00:00",), (None,)], "t string")
    got = [r[0] for r in df.select(temporal.parse_event_time(F.col("t"))).collect()]
    assert got == [datetime(2019, 10, 1, 0, 26, 2), None, None, None]


def test_epoch_millis_may_be_a_float(spark):
    got = one(spark, temporal.from_epoch_millis(F.lit(1500.75)), temporal.from_epoch_millis(F.lit(0)))
    assert got == (datetime(1970, 1, 1, 0, 0, 1, 500000), datetime(1970, 1, 1))


def test_elapsed_seconds_are_whole(spark):
    a, b = (F.lit(t).cast("timestamp") for t in ("2020-01-01 00:00:00.9", "2020-01-01 00:00:02.1"))
    assert one(spark, temporal.elapsed_seconds(a, b), temporal.fractional_hours(a, b)) == (1, 2 / 3600)


def test_period_starts(spark):
    ts = F.lit("2020-02-29 13:45:10").cast("timestamp")
    assert one(spark, temporal.month_start(ts), temporal.hour_start(ts)) == (datetime(2020, 2, 1), datetime(2020, 2, 29, 13))
