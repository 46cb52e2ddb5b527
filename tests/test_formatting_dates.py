"""Formatting builders against a plain-Python model of the dashboard formatters; date buckets and periods."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st

from bizlens.functions import dates as D
from bizlens.functions import formatting as K
from conftest import col_values


def py_currency(x, sign=False):
    """The text by Python's own formatter, separators swapped."""
    if x is None:
        return "R$ 0,00"
    body = f"{abs(x):,.2f}".translate(str.maketrans(",.", ".,"))
    return f"R$ -{body}" if x < 0 else (f"R$ +{body}" if sign and x > 0 else f"R$ {body}")


def test_rounding_is_that_of_the_binary_value(spark):
    values = [0.125, 2.675, 1.005, 1.25, 2.5, 0.375, 1e15 / 7, 0.5, 1.5]
    assert col_values(spark, lambda c: K.format_number_br(c, 2), values, "double") == [
        f"{v:,.2f}".translate(str.maketrans(",.", ".,")) for v in values]
    assert col_values(spark, K.signed_fixed, values, "double") == [f"{v:+.1f}".replace(".", ",") for v in values]
    assert col_values(spark, K.format_compact, [2.5, 3.5, 0.5], "double") == ["2", "4", "0"]


def test_currency_vectors(spark):
    vals = [1234.56, -1234.5, 0.0, None, 1e9 + 0.125, 0.005]
    assert col_values(spark, K.format_currency, vals, "double") == [
        "R$ 1.234,56", "R$ -1.234,50", "R$ 0,00", "R$ 0,00", "R$ 1.000.000.000,12", "R$ 0,01"]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.one_of(st.none(), st.floats(-1e12, 1e12, allow_nan=False)), min_size=1, max_size=30))
def test_currency_model(spark, values):
    assert col_values(spark, lambda c: K.format_currency(c, True), values, "double") == [py_currency(v, True)
                                                                                          for v in values]


def test_percentage_compact_delta(spark):
    assert col_values(spark, K.format_percentage, [0.125, -0.5, None], "double") == ["12,5%", "-50,0%", "0,0%"]
    assert col_values(spark, K.format_compact, [12345.0, -1.5e6, 2e9, 999.0, None], "double") == [
        "12,3K", "-1,5M", "2,0B", "999", "0"]
    assert col_values(spark, K.signed_fixed, [1.25, -0.34, 0.0], "double") == ["+1,2", "-0,3", "+0,0"]
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(5.0, None), (-2.5, 10.0)], "p double, y double")
    got = [r[0] for r in df.select(K.delta_text("p", "y")).collect()]
    assert got == ["+5,0% (Mês)", "+10,0% (Ano) | -2,5% (Mês)"]
    d = df.select(K.format_delta(F.col("y") / 100, is_percentage=True).alias("d")).collect()
    assert [(r.d.texto, r.d.cor) for r in d] == [("0", "off"), ("+10,0%", "normal")]


def test_week_ending_monday(spark):
    vals = [dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 7)]
    assert col_values(spark, D.week_ending_monday, vals, "date") == [dt.date(2024, 1, 1), dt.date(2024, 1, 8),
                                                                     dt.date(2024, 1, 8)]


def test_periods_and_granularity():
    p = D.comparison_periods(dt.date(1998, 3, 1), dt.date(1998, 3, 31))
    assert [(x.start, x.end) for x in p] == [(dt.date(1998, 3, 1), dt.date(1998, 3, 31)),
                                             (dt.date(1998, 1, 29), dt.date(1998, 2, 28)),
                                             (dt.date(1997, 3, 1), dt.date(1997, 3, 31))]
    assert D.granularity(dt.date(1998, 3, 1), dt.date(1998, 3, 31)) == "D"
    assert D.granularity(dt.date(1998, 1, 1), dt.date(1998, 5, 31)) == "W"
    assert D.granularity(dt.date(1998, 1, 1), dt.date(1998, 12, 31)) == "M"
