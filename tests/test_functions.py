import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tidemark.functions import arrays, strings, times, values


def one(spark, column, **inputs):
    df = spark.createDataFrame([tuple(inputs.values())], list(inputs)) if inputs else spark.range(1)
    return df.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(("year", "day", "month", "of_month"), [(2016, 365, 12, 30), (2016, 60, 2, 29), (2015, 60, 3, 1), (2016, 20, 1, 20), (2015, 20, 1, 20), (2016, 366, 12, 31), (2011, 365, 12, 31), (2017, 1, 1, 1), (2020, 1, 1, 1)])
def test_day_of_year(spark, year, day, month, of_month):
    assert one(spark, times.day_of_year(F.col("y"), F.col("d")), y=year, d=day) == dt.date(year, month, of_month)


@pytest.mark.parametrize(("year", "day"), [(-1, 200), (2013, 0), (2012, 367), (2013, 366)])
def test_day_of_year_errors(spark, year, day):
    with pytest.raises(Exception, match="year"):
        one(spark, times.day_of_year(F.col("y"), F.col("d")), y=year, d=day)


def test_second_sixty_is_the_next_minute(spark):
    args = [F.lit(x) for x in (2012, 10, 27, 11, 14, 60)]
    assert one(spark, times.timestamp_60(*args)) == dt.datetime(2012, 10, 27, 11, 15)


def test_synoptic_next_goes_back_after_18(spark):
    ts = F.lit("2024-01-02 19:30:00").cast("timestamp")
    assert one(spark, times.synoptic_next(ts)) == dt.datetime(2024, 1, 2)
    assert one(spark, times.synoptic_next(ts, literal=False)) == dt.datetime(2024, 1, 3)


def test_field_range_is_empty_when_it_wraps(spark):
    a, b = (F.lit(x).cast("timestamp") for x in ("2024-01-01 22:00:00", "2024-01-02 03:00:00"))
    assert one(spark, times.field_range(a, b, "HH")) == []
    assert one(spark, times.field_range(a, b, "dd")) == ["01", "02"]


def test_intervals_need_order(spark):
    a, b = (F.lit(x).cast("timestamp") for x in ("2024-01-02", "2024-01-01"))
    with pytest.raises(Exception, match="after"):
        one(spark, times.intervals(a, b, F.expr("INTERVAL 1 HOUR")))


@pytest.mark.parametrize(("day", "hour"), [(3, 0), (3, 6), (31, 12), (50, 18), (1, 12)])
def test_pack_code_round_trip(spark, day, hour):
    packed = one(spark, times.pack_code(F.col("d"), F.col("h")), d=day, h=hour)
    assert packed["code"] == ("X" if hour % 12 == 0 else "Y")
    back = one(spark, times.unpack_code(F.col("c"), F.col("d")), c=packed["code"], d=packed["day"])
    assert (back["day"], back["hour"]) == (day, hour)


def test_tenths_are_kept_or_dropped(spark):
    text = F.lit("201208180059467")
    assert one(spark, times.parse_tenths(text)).microsecond == 700_000
    assert one(spark, times.parse_seconds(text)).microsecond == 0


@pytest.mark.parametrize(("value", "want"), [(-999.0, -999.0), (100.0, 1.0), (60_000.0, -999.0), (-1.0, -999.0), (0.0, 0.0)])
def test_rescaled(spark, value, want):
    assert one(spark, values.rescaled(F.col("v"), 0.01, 0.0, 0.0, 500.0), v=value) == pytest.approx(want)


def test_rescaled_keeps_nan(spark):
    assert math.isnan(one(spark, values.rescaled(F.col("v"), 0.01, 0.0, 0.0, 500.0), v=float("nan")))


def test_longitudes(spark):
    assert one(spark, values.lon_signed(F.lit(285.0))) == -75.0
    assert one(spark, values.lon_signed(F.lit(180.0))) == 180.0
    assert one(spark, values.lon_positive(F.lit(0.0))) == 0.0
    assert one(spark, values.lon_positive(F.lit(0.0), center=True)) == 360.0
    with pytest.raises(Exception, match="out of range"):
        one(spark, values.checked_latitude(F.lit(90.5)))


def test_level_label_and_index(spark):
    assert one(spark, values.level_label(F.lit(85049.6))) == "850.0"
    levels = F.array(F.lit("850.0"), F.lit("925.0"))
    assert one(spark, arrays.level_index(levels, F.lit("925.0"))) == 1
    with pytest.raises(Exception, match="unknown level"):
        one(spark, arrays.level_index(levels, F.lit("1.0")))


def test_arrays(spark):
    assert one(spark, values.axis(F.lit(0.0), F.lit(20.0), F.lit(3))) == [0.0, 10.0, 20.0]
    assert one(spark, arrays.record_count(F.array(F.lit(3), F.lit(4)))) == 12
    assert one(spark, arrays.transposed(F.array(F.array(F.lit(1), F.lit(2)), F.array(F.lit(3), F.lit(4))))) == [[1, 3], [2, 4]]
    assert one(spark, arrays.steps(0, 127, 6))[-1] == 126
    assert one(spark, arrays.masked_add(F.array(F.lit(-1.0), F.lit(2.0)), lambda x: x < 0, 360.0)) == [359.0, 2.0]


def test_strings(spark):
    assert one(spark, strings.path_parts(F.lit("/a/b/c.txt"))) == ["/", "a", "b", "c.txt"]
    assert one(spark, strings.extension(F.lit("a.b/c.tar.gz"))) == ".tar.gz" or one(spark, strings.extension(F.lit("c.gz"))) == ".gz"
    assert one(spark, strings.date_format_pattern(F.lit("%Y_%j"))) == r"\d{4}_\d{3}"
    assert one(spark, strings.date_format_printf(F.lit("%H:%M"))) == "%02d:%02d"
    assert one(spark, strings.alternation(F.array(F.lit("b"), F.lit("a"), F.lit("b")))) == "(a|b)"
    assert one(spark, strings.filled(F.lit("f_%x%"), {"x": F.lit("1")}, right="%")) == "f_1"
    assert one(spark, strings.key_value(F.lit("k=v")))["value"] == "v"
    with pytest.raises(Exception, match="not key=value"):
        one(spark, strings.key_value(F.lit("k=v=w")))
    with pytest.raises(Exception, match="unknown basin"):
        one(spark, strings.basin_name(F.lit("zz")))
