"""Typed bounds, watermark text and labels, pushdown."""

from datetime import date, datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulier.errors import SchemaError
from haulier.functions import bounds as B
from haulier.functions.names import clashes, quote_ident, require_column
from haulier.sources.tables import lower_bound


@pytest.mark.parametrize(
    ("dtype", "label"),
    [
        (T.DateType(), "timestamp"),
        (T.TimestampType(), "timestamp"),
        (T.TimestampNTZType(), "timestamp"),
        (T.ShortType(), "int"),
        (T.LongType(), "int"),
        (T.BooleanType(), "int"),
        (T.DoubleType(), "string"),
        (T.DecimalType(10, 2), "string"),
        (T.StringType(), "string"),
    ],
)
def test_watermark_label(dtype, label):
    assert B.watermark_type(dtype) == label


def observed(spark, sql, name="c"):
    frame = spark.sql(sql)
    dtype = frame.schema[name].dataType
    value = frame.agg(B.max_expression(F.col(name), dtype).alias("top")).first().top
    return B.watermark_text(value, dtype), dtype, frame


@pytest.mark.parametrize(
    ("values", "text"),
    [
        ("(TIMESTAMP_NTZ'2025-05-10 22:00:00'), (NULL)", "2025-05-10 22:00:00"),
        ("(TIMESTAMP_NTZ'2025-05-10 22:00:00.647')", "2025-05-10 22:00:00.647000"),
        ("(TIMESTAMP_NTZ'2025-05-10 22:00:00.000001')", "2025-05-10 22:00:00.000001"),
        ("(TIMESTAMP'2025-05-10 22:00:00.5Z')", "2025-05-10 22:00:00.500000+00:00"),
        ("(DATE'2024-02-29')", "2024-02-29"),
        ("(7), (NULL), (9)", "9"),
        ("(true), (false)", "True"),
        ("(1.5D), (double('NaN')), (NULL)", "1.5"),
        ("(CAST(1.25 AS DECIMAL(9,3)))", "1.250"),
        ("('b'), ('a')", "b"),
        ("(CAST(NULL AS INT))", None),
    ],
)
def test_text_round_trip(spark, values, text):
    got, dtype, frame = observed(spark, f"SELECT * FROM VALUES {values} AS t(c)")
    assert got == text
    if text is not None:
        # the stored text, read back as a bound, keeps exactly the largest value (and NaN, see README)
        keep = B.from_start(F.col("c"), text, dtype)
        if isinstance(dtype, T.DoubleType):
            keep = keep & ~F.isnan("c")
        assert frame.filter(keep).count() == 1
        assert frame.filter(B.after(F.col("c"), text, dtype) & keep).count() == 0


def test_zoned_bound_ignores_session_zone(spark):
    frame = spark.sql("SELECT TIMESTAMP'2024-01-01 00:00:00Z' AS c")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        for value in ("2024-01-01", "2024-01-01 00:00:00", "2024-01-01T00:00:00+00:00", date(2024, 1, 1), datetime(2024, 1, 1)):
            assert lower_bound(frame, "c", value).count() == 1
            assert lower_bound(frame, "c", value, inclusive=False).count() == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize(
    "text",
    ["2000-06-30 00:00:00.000000", "2000-06-30 00:00:00", "2000-06-30T00:00:00.0", "2000-06-30T00:00:00", "2000-06-30"],
)
def test_iso_forms_reach_the_scan(spark, text):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    frame = lower_bound(orders, "o_orderdate", text)
    plan = frame._jdf.queryExecution().explainString(frame._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "GreaterThanOrEqual(o_orderdate,2000-06-30T00:00" in plan
    assert frame.count() == orders.filter("o_orderdate >= TIMESTAMP_NTZ'2000-06-30'").count()


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_bad_bound_text_fails(spark, ansi):
    frame = spark.sql("SELECT DATE'2024-01-01' AS c")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        for value in ("30/06/2000", "None", None):
            with pytest.raises((SchemaError, PySparkException)):
                lower_bound(frame, "c", value)
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_names():
    assert quote_ident('a"b', "postgresql") == '"a""b"'
    assert quote_ident("a]b", "sqlserver") == "[a]]b]"
    assert quote_ident("a`b") == "`a``b`"
    assert clashes(["Id", "x"], ["ID", "y"]) == ["ID"]
    assert require_column(["a"], " a ", "role") == "a"
    for bad in ("A", "", None, "  "):
        with pytest.raises(SchemaError):
            require_column(["a"], bad, "role")
