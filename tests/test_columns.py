from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillhouse.functions import columns as C


def one(spark, value, kind, **exprs):
    return spark.createDataFrame([(value,)], f"v {kind}").select(*[e.alias(n) for n, e in exprs.items()]).first()


@pytest.mark.parametrize("text,second", [
    ("2017-01-01 10:20:59.499999", 59), ("2017-01-01 10:20:59.5", 60), ("2017-01-01 10:20:58.5", 58),
    ("2017-01-01 10:20:57.5", 58), ("2017-01-01 10:20:00", 0)])
def test_second_is_rounded_half_to_even(spark, text, second):
    assert one(spark, datetime.fromisoformat(text), "timestamp_ntz", **C.date_parts("v"))["second"] == second


def test_date_parts(spark):
    sunday = one(spark, datetime(2017, 1, 1, 23, 59), "timestamp_ntz", **C.date_parts("v"))
    assert tuple(sunday) == (2017, 1, 1, 7, 23, 59, 0)
    assert one(spark, datetime(2017, 1, 2), "timestamp_ntz", **C.date_parts("v"))["day_of_week"] == 1


def test_literals(spark):
    assert one(spark, "O'Hara", "string", a=C.null_literal("v"))["a"] == "'O''Hara'"
    assert one(spark, None, "string", a=C.null_literal("v"))["a"] == "NULL"
    assert one(spark, date(2017, 1, 2), "date", a=C.null_literal("v"))["a"] == "'2017-01-02'"
    row = one(spark, None, "string", a=C.comma_list(F.lit("x"), "v", F.lit("y")), b=C.row_literal(F.lit(1), "v"))
    assert tuple(row) == ("x, y", "('1', NULL)")


def test_window_holds_both_ends(spark):
    times = [datetime(2016, 1, 1), datetime(2018, 1, 1), datetime(2018, 1, 1, 0, 0, 0, 1), datetime(2015, 12, 31)]
    df = spark.createDataFrame([(t,) for t in times], "t timestamp_ntz")
    assert df.where(C.in_window("t", "2016-01-01", "2018-01-01")).count() == 2
    assert df.where(C.in_window("t", times[0], times[0])).count() == 1


def test_defaults_only_fill_absent_columns(spark):
    df = spark.createDataFrame([(None,)], "payed boolean")
    assert tuple(C.apply_defaults(df, {"payed": False, "cnt": 0.0}).first()) == (None, 0.0)


def test_conform(spark):
    schema = T.StructType([T.StructField("b", T.LongType()), T.StructField("a", T.StringType())])
    df = C.conform(spark.createDataFrame([(1, 2)], "a int, c int"), schema)
    assert df.dtypes == [("b", "bigint"), ("a", "string")] and tuple(df.first()) == (None, "1")
