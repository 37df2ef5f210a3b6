import math

import pytest
from pyspark.sql import functions as F

from keyframe.functions.numeric import round_double_cols, signif


@pytest.mark.parametrize(
    "value, digits, expected",
    [
        (2.0, 2, 2.0),
        (1.3, 2, 1.3),
        (1.5, 1, 2.0),
        (2.5, 1, 2.0),
        (3.5, 1, 4.0),
        (-2.5, 1, -2.0),
        (1.5000000001, 10, 1.5),
        (42972.72604058508295565844, 15, 42972.7260405851),
        (42972.72604058508295565844, 16, 42972.72604058508),
        (42972.72604058507567970082, 15, 42972.7260405851),
        (42972.72604058507567970082, 17, 42972.726040585076),
        (123456.0, 2, 120000.0),
        (1e300, 3, 1e300),
        (1.23456e-300, 3, 1.23e-300),
        (1.23456e200, 3, 1.23e200),
        (-9.87654e-30, 2, -9.9e-30),
        (1.7976931348623157e308, 3, 1.80e308),
        (5e-324, 3, 5e-324),
        (999.9999999999999, 3, 1000.0),
        (0.000123456, 3, 0.000123),
        (0.1, 22, 0.1),
        (5.955, 0, 6.0),
        (0.0, 3, 0.0),
        (math.inf, 3, math.inf),
        (-math.inf, 3, -math.inf),
        (None, 3, None),
    ],
)
def test_signif(spark, value, digits, expected):
    frame = spark.createDataFrame([(value,)], "x double")
    assert frame.select(signif(F.col("x"), digits)).first()[0] == expected


def test_signif_keeps_small_differences(spark):
    frame = spark.createDataFrame([(1.50000000001,), (1.500001,)], "x double")
    assert [r[0] for r in frame.select(signif(F.col("x"), 12)).collect()] == [1.50000000001, 1.500001]


def test_nan(spark):
    frame = spark.createDataFrame([(math.nan,)], "x double")
    assert math.isnan(frame.select(signif(F.col("x"), 3)).first()[0])


def test_only_double_columns_change(spark):
    frame = spark.createDataFrame(
        [("a", 1000001, math.pi), ("b", None, None)], "name string, million int, pi double"
    )
    assert [tuple(r) for r in round_double_cols(frame, 3).collect()] == [("a", 1000001, 3.14), ("b", None, None)]
    text = frame.select("name")
    assert round_double_cols(text).collect() == text.collect()
    whole = spark.createDataFrame([(1000001.0,)], "x double")
    assert round_double_cols(whole, 15).first()[0] == 1000001.0
