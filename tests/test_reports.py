"""Chart dataset operators on small frames: gap fill, empty policy, shares, signed split, weekday mean."""

import datetime as dt
from decimal import Decimal

from bizlens.operators import frames as FR
from bizlens.operators import reports as RP

D1, D3 = dt.date(2024, 1, 1), dt.date(2024, 1, 3)


def _pl(spark, rows):
    return spark.createDataFrame([(d, Decimal(v)) for d, v in rows], "data date, valor decimal(38,4)")


def test_evolution_gap_fill_and_series(spark):
    pl = _pl(spark, [(D1, "100"), (D1, "-40"), (D3, "-10")])
    out = RP.financial_evolution(pl, D1, dt.date(2024, 1, 31)).collect()
    assert len(out) == 3 * 3                                   # 3 days (one empty, filled) x 3 series
    by = {(r["Data_Sort"], r["Tipo"]): r["Valor"] for r in out}
    assert by[(D1, "Receitas")] == 100.0 and by[(D1, "Despesas")] == 40.0 and by[(D1, "Lucro Líquido")] == 60.0
    assert by[(dt.date(2024, 1, 2), "Receitas")] == 0.0        # gap filled
    assert {r["Data_Formatada"] for r in out} == {"01/01", "02/01", "03/01"}


def test_evolution_empty_when_no_activity(spark):
    pl = _pl(spark, [(D1, "0"), (D3, "0")])
    assert RP.financial_evolution(pl, D1, dt.date(2024, 1, 31)).count() == 0


def test_weekly_and_monthly_labels(spark):
    pl = _pl(spark, [(dt.date(2024, 1, 2), "10"), (dt.date(2024, 3, 5), "5")])
    weeks = {r["Data_Sort"] for r in RP.financial_evolution(pl, D1, dt.date(2024, 5, 31)).collect()}
    assert min(weeks) == dt.date(2024, 1, 8) and all(d.weekday() == 0 for d in weeks)
    months = {r["Data_Formatada"] for r in RP.financial_evolution(pl, D1, dt.date(2024, 12, 31)).collect()}
    assert months == {"jan/2024", "fev/2024", "mar/2024"}


def test_share_of_total_zero_total(spark):
    df = spark.createDataFrame([("a", Decimal("5")), ("b", Decimal("-5"))], "k string, valor decimal(18,2)")
    assert {r["k"]: r["percentual"] for r in FR.share_of_total(df, "valor").collect()} == {"a": 0.0, "b": 0.0}
    df = spark.createDataFrame([("a", Decimal("1")), ("b", Decimal("3"))], "k string, valor decimal(18,2)")
    assert {r["k"]: r["percentual"] for r in FR.share_of_total(df, "valor").collect()} == {"a": 25.0, "b": 75.0}


def test_weekday_mean_is_per_line(spark):
    sales = spark.createDataFrame([(dt.date(2024, 1, 1), Decimal("10")), (dt.date(2024, 1, 1), Decimal("20")),
                                   (dt.date(2024, 1, 8), Decimal("60"))], "data date, valor decimal(18,2)")
    r = RP.weekday_performance(sales).collect()
    assert [(x["dia_semana_num"], x["dia_semana"], x["valor"]) for x in r] == [(0, "Seg", 30.0)]


def test_top_expenses_group_exclusion_keeps_null_groups(spark):
    pl = spark.createDataFrame([("A", None, Decimal("-5")), ("B", "Comissões", Decimal("-50")),
                                ("C", "Despesas Operacionais", Decimal("-7")), ("D", None, Decimal("3"))],
                               "categoria string, grupo_metrica string, valor decimal(38,4)")
    got = [(r["categoria"], r["valor_abs"]) for r in RP.top_expenses(pl).collect()]
    assert got == [("C", 7.0), ("A", 5.0)]


def test_sales_kpis_staged_counts(spark):
    from bizlens.operators import metrics as MT

    facts = spark.createDataFrame([
        (D1, "t1", Decimal("10")), (D1, "t1", Decimal("20")), (D1, "t2", Decimal("30")),
        (D3, None, Decimal("5")), (D3, "t3", Decimal("-1")),
    ], "data date, id_comanda string, valor decimal(18,2)")
    k = {r["periodo"]: r for r in MT.sales_kpis(spark, facts, D1, dt.date(2024, 1, 31)).collect()}["atual"]
    # 4 positive lines on 2 days, 2 distinct non-null tickets (null key excluded like nunique)
    assert (k["faturamento"], k["dias_com_venda"], k["atendimentos"], k["itens"]) == (65.0, 2, 2, 4)
    assert k["ticket_medio"] == 32.5 and k["itens_por_cesta"] == 2.0 and k["faturamento_medio_diario"] == 32.5
