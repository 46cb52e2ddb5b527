"""Invariants over the bound warehouse and a property test of the hours parser."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as E
from bizlens.functions import cleaning as C
from conftest import col_values


def test_pl_total_equals_sum_of_groups(spark, small_dir):
    q = E.queries()
    groups = q["pl_by_group"](spark, small_dir).collect()
    kpi = {r["periodo"]: r for r in q["financial_kpis"](spark, small_dir).collect()}["atual"]
    assert abs(sum(r["valor"] for r in groups) - kpi["lucro_liquido"]) < 1e-6
    by = {r["grupo_metrica"]: r["valor"] for r in groups}
    assert abs(by.get("Receita Bruta", 0.0) - kpi["receita_bruta"]) < 1e-6


def test_statement_counts_match_quality_report(spark, small_dir):
    q = E.queries()
    counts = {r["grupo_metrica"]: r["total_registros"] for r in q["pl_counts"](spark, small_dir).collect()}
    quality = {r["grupo_metrica"]: r["registros"] for r in q["pl_quality"](spark, small_dir).collect()}
    assert counts == quality and sum(counts.values()) == q["pl_statement"](spark, small_dir).count()


def py_hours(v):
    """Plain-Python model of the reference's HH:MM parser (strings only; no '_' grouping, inf or nan)."""
    if v is None or v == "":
        return 0.0
    s = v.strip()
    if not s:
        return 0.0
    num = re.compile(r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?")
    parts = s.split(":")
    if len(parts) >= 2:
        h, m = parts[0].strip(), parts[1].strip()
        if num.fullmatch(h) and num.fullmatch(m):
            return float(h) + float(m) / 60.0
        return 0.0
    return float(s) if num.fullmatch(s) else 0.0


@settings(max_examples=20, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="0123456789:.- x", max_size=9)), min_size=1, max_size=30))
def test_hours_matches_python_model(spark, values):
    assert col_values(spark, C.hours_decimal, values) == [py_hours(v) for v in values]


def test_scale_conf():
    from bizlens.session import scale_conf

    big = scale_conf(100 * 2**40, 8000)
    assert int(big["spark.sql.shuffle.partitions"]) == 409600
    assert int(scale_conf(10**7, 8)["spark.sql.shuffle.partitions"]) == 16
