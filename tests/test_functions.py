import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cdclake.functions import decode_decimal, encode_decimal, falsy_default, seconds_after, title_word, zero_pad

# FIXTURES §4 "decode": text -> expected double
DECODE_CASES = [
    ("AQuU", 68.5), ("AlQL4/8=", 9999999.999), ("/Bg=", 64.536), ("AA==", 0.0), (None, 0.0), ("", 0.0),
    ("abc", 0.0), ("A===", 0.0), ("====", 0.0), ("!!!!", 0.0), ("68.5", 0.0), ("////////////////", (2**96 - 1) / 1000),
]


def test_decode_fixture(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(DECODE_CASES)], "i int, t string")
    got = {r.i: r.v for r in df.select("i", decode_decimal("t").alias("v")).collect()}
    for i, (_, want) in enumerate(DECODE_CASES):
        assert abs(got[i] - want) < 1e-9, (DECODE_CASES[i], got[i])


def test_decode_signed(spark):
    df = spark.createDataFrame([("/Bg=",)], "t string")
    assert df.select(decode_decimal("t", signed=True).alias("v")).first().v == -1.0


def test_decode_wide_and_negative_values(spark):
    import base64

    def text(value, nbytes):
        return base64.b64encode(value.to_bytes(nbytes, "big", signed=value < 0)).decode()

    cases = [(12345678, 9), (10**30 + 7, 13), (2**64 - 1, 9), (2**200 + 12345, 30), (0, 20), (-1000, 8), (-1000, 2), (-(10**20), 12), (-(2**150), 25)]
    df = spark.createDataFrame([(i, text(*c)) for i, c in enumerate(cases)], "i int, t string")
    got = df.select("i", decode_decimal("t", signed=True).alias("v"), decode_decimal("t").alias("u")).collect()
    for r in got:
        value = cases[r.i][0]
        assert abs(r.v - value / 1000) <= 1e-12 * abs(value), (cases[r.i], r.v)
        if value >= 0:
            assert abs(r.u - value / 1000) <= 1e-12 * value
    back = spark.createDataFrame([(-5.25,), (7.5,), (0.0,)], "v double")
    assert [r[0] for r in back.select(decode_decimal(encode_decimal("v", nbytes=9), signed=True)).collect()] == [-5.25, 7.5, 0.0]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(min_value=0, max_value=9_999_999_999), min_size=1, max_size=50))
def test_encode_decode_identity(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "n long")
    out = df.select("n", decode_decimal(encode_decimal(F.col("n") / 1000.0)).alias("v")).collect()
    for r in out:
        assert round(r.v * 1000) == r.n


def test_string_helpers(spark):
    df = spark.createDataFrame([(5, "credit", None), (100, "", "x")], "n int, c string, d string")
    rows = df.select(zero_pad("n", 2).alias("p"), falsy_default("c", "debit").alias("f"), title_word("c").alias("t")).collect()
    assert [r.p for r in rows] == ["05", "100"]  # never truncates
    assert [r.f for r in rows] == ["credit", "debit"]
    assert rows[0].t == "Credit"


def test_seconds_after(spark):
    df = spark.createDataFrame([(100,), (None,)], "n long")
    got = [r.t for r in df.select(seconds_after("n").alias("t")).collect()]
    assert got == [dt.datetime(2026, 1, 1, 0, 1, 40), None]


def test_scale_conf_sizes_partitions():
    from cdclake.session import scale_conf

    small = scale_conf(10 * 1024**3, 64)
    assert int(small["spark.sql.shuffle.partitions"]) == 192  # at least three waves of tasks
    big = scale_conf(30 * 1024**4, 8000)
    assert int(big["spark.sql.shuffle.partitions"]) == 122_880  # 256 MB each
    assert int(big["spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes"]) == 1024**3


def test_change_stream_needs_a_source(spark):
    import pytest

    from cdclake.streaming.bronze import change_stream, kafka_available

    assert kafka_available(spark) in (True, False)
    with pytest.raises(ValueError):
        change_stream(spark)
