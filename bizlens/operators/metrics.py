"""Period KPIs: current, previous (same length) and year-ago (-365 days) in one pass over the facts.

A row is tagged with every period containing its date (periods can overlap) and aggregated by period, so all
three periods cost one scan and one (tiny) shuffle; the 3-row periods table drives a left join so an empty
period still yields zeros.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bizlens.functions import dates as D
from bizlens.functions import formatting as K
from bizlens.plans import model as M

CURRENT, PREVIOUS, YEAR_AGO = "atual", "anterior", "ano_anterior"


def tag_periods(facts: DataFrame, date_col: str, periods: list[D.Period]) -> DataFrame:
    """Facts dated inside any period, one row per (fact, containing period)."""
    return (facts.where(D.any_period(date_col, periods))
            .withColumn("periodo", F.explode(D.period_tags(date_col, periods))))


def with_all_periods(spark: SparkSession, periods: list[D.Period], agg: DataFrame, zero: dict[str, object]) -> DataFrame:
    """Left-join a per-period aggregate onto the periods table (a few rows, broadcast); missing -> ``zero``."""
    out = D.periods_frame(spark, periods).join(F.broadcast(agg), "periodo", "left")
    return out.withColumns({n: F.coalesce(F.col(n), F.lit(v).cast(agg.schema[n].dataType)) for n, v in zero.items()})


def period_aggregate(spark: SparkSession, facts: DataFrame, date_col: str, periods: list[D.Period],
                     aggs: dict[str, Column], zero: dict[str, object]) -> DataFrame:
    """One row per period: ``aggs`` over the facts dated inside it; empty periods get ``zero`` values."""
    agg = tag_periods(facts, date_col, periods).groupBy("periodo").agg(*[c.alias(n) for n, c in aggs.items()])
    return with_all_periods(spark, periods, agg, zero)


def _ratio(num: Column, den: Column) -> Column:
    return F.when(den > 0, num.cast("double") / den.cast("double")).otherwise(F.lit(0.0))


# ---------------------------------------------------------------------------------------------- sales
SALES_KPIS = ["faturamento", "faturamento_medio_diario", "atendimentos", "ticket_medio", "itens_por_cesta"]


def sales_kpis(spark: SparkSession, sales_fact: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Revenue, daily average (per day with sales), tickets, ticket average, items per ticket; lines with
    ``valor > 0`` only; all zero for an empty period."""
    periods = D.comparison_periods(start, end)
    facts = sales_fact.where(F.col("valor") > 0).select("data", "id_comanda", "valor")
    # A visit key belongs to one day, so distinct days and tickets come from staged pre-aggregation
    # (ticket -> day -> period) instead of distinct aggregates that replicate every line before the shuffle.
    tickets = tag_periods(facts, "data", periods).groupBy("periodo", "data", "id_comanda") \
        .agg(F.sum("valor").alias("_v"), F.count(F.lit(1)).alias("_n"))
    days = tickets.groupBy("periodo", "data").agg(F.sum("_v").alias("_v"), F.sum("_n").alias("_n"),
                                                  F.count("id_comanda").alias("_t"))
    per = days.groupBy("periodo").agg(F.sum("_v").alias("_fat"), F.count(F.lit(1)).alias("dias_com_venda"),
                                      F.sum("_t").alias("atendimentos"), F.sum("_n").alias("itens"))
    a = with_all_periods(spark, periods, per, {"_fat": 0, "dias_com_venda": 0, "atendimentos": 0, "itens": 0})
    fat = F.col("_fat").cast("double")
    return a.select(
        F.col("ordem").cast("bigint").alias("ordem"), "periodo", "inicio", "fim",
        fat.alias("faturamento"),
        _ratio(fat, F.col("dias_com_venda")).alias("faturamento_medio_diario"),
        F.col("atendimentos").cast("bigint").alias("atendimentos"),
        _ratio(fat, F.col("atendimentos")).alias("ticket_medio"),
        _ratio(F.col("itens"), F.col("atendimentos")).alias("itens_por_cesta"),
        F.col("dias_com_venda").cast("bigint").alias("dias_com_venda"),
        F.col("itens").cast("bigint").alias("itens"))


def _by_metric(kpis: DataFrame, metrics: list[str]) -> DataFrame:
    """3 period rows x N metrics -> N metric rows with the three period values side by side."""
    long = kpis.select("periodo", F.explode(F.array(*[
        F.struct(F.lit(i).alias("ordem"), F.lit(m).alias("metrica"), F.col(m).cast("double").alias("v"))
        for i, m in enumerate(metrics)])).alias("x")).select("periodo", "x.*")
    pick = lambda p: F.max(F.when(F.col("periodo") == p, F.col("v")))
    return long.groupBy("ordem", "metrica").agg(pick(CURRENT).alias("atual"), pick(PREVIOUS).alias("anterior"),
                                                pick(YEAR_AGO).alias("ano_anterior"))


def sales_kpi_deltas(spark: SparkSession, sales_fact: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Per KPI: % change vs previous period (base <= 0 -> 0) and vs year ago (base <= 0 -> null) + text."""
    w = _by_metric(sales_kpis(spark, sales_fact, start, end), SALES_KPIS)
    a, p, y = F.col("atual"), F.col("anterior"), F.col("ano_anterior")
    pop = F.when(p > 0, (a - p) / p * F.lit(100.0)).otherwise(F.lit(0.0))
    yoy = F.when(y > 0, (a - y) / y * F.lit(100.0))
    return w.select(F.col("ordem").cast("bigint").alias("ordem"), "metrica", "atual", "anterior", "ano_anterior",
                    pop.alias("pct_pop"), yoy.alias("pct_yoy")) \
        .withColumn("delta_texto", K.delta_text("pct_pop", "pct_yoy"))


# ---------------------------------------------------------------------------------------------- finance
EXPENSE_GROUPS = (M.GROUP_OPERATING, M.GROUP_FEES, M.GROUP_FINANCIAL)
FINANCIAL_KPIS = ["receita_bruta", "comissoes", "taxas", "despesas", "lucro_liquido"]
FINANCIAL_RATIOS = ["margem_liquida", "custo_comissao_pct", "impacto_taxas_pct"]


def financial_kpis(spark: SparkSession, pl: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Totals by P&L group for the three periods (one conditional aggregation) and the efficiency ratios."""
    periods = D.comparison_periods(start, end)
    g, v = F.col("grupo_metrica"), F.col("valor")
    sum_if = lambda cond: F.sum(F.when(cond, v))
    a = period_aggregate(spark, pl.select("data", "grupo_metrica", "valor"), "data", periods, {
        "receita_bruta": sum_if(g == M.GROUP_REVENUE), "comissoes": sum_if(g == M.GROUP_COMMISSIONS),
        "taxas": sum_if(g == M.GROUP_FEES), "despesas": sum_if(g.isin(*EXPENSE_GROUPS)),
        "lucro_liquido": F.sum(v),
    }, {k: 0 for k in FINANCIAL_KPIS})
    d = {k: F.col(k).cast("double") for k in FINANCIAL_KPIS}
    rev = d["receita_bruta"]
    pct = lambda num: F.when(rev > 0, num / rev * F.lit(100.0)).otherwise(F.lit(0.0))
    return a.select(F.col("ordem").cast("bigint").alias("ordem"), "periodo", "inicio", "fim",
                    *[d[k].alias(k) for k in FINANCIAL_KPIS],
                    pct(d["lucro_liquido"]).alias("margem_liquida"),
                    pct(F.abs(d["comissoes"])).alias("custo_comissao_pct"),
                    pct(F.abs(d["taxas"])).alias("impacto_taxas_pct"))


def financial_deltas(spark: SparkSession, pl: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """% change for the totals (PoP base 0 -> 0, YoY base 0 -> null; costs compared in absolute value,
    profit over |base|) and percentage-point deltas for the ratios."""
    metrics = FINANCIAL_KPIS + FINANCIAL_RATIOS
    w = _by_metric(financial_kpis(spark, pl, start, end), metrics)
    m, a, p, y = F.col("metrica"), F.col("atual"), F.col("anterior"), F.col("ano_anterior")
    is_abs = m.isin("comissoes", "despesas")
    is_ratio = m.isin(*FINANCIAL_RATIOS)

    def change(base: Column, none_value: Column) -> Column:
        num = F.when(is_abs, F.abs(a) - F.abs(base)).otherwise(a - base)
        den = F.when(m.isin("comissoes", "despesas", "lucro_liquido"), F.abs(base)).otherwise(base)
        return F.when(is_ratio, a - base).when(base != 0, num / den * F.lit(100.0)).otherwise(none_value)

    out = w.select(F.col("ordem").cast("bigint").alias("ordem"), "metrica", "atual", "anterior", "ano_anterior",
                   change(p, F.lit(0.0)).alias("delta_pop"),
                   change(y, F.lit(None).cast("double")).alias("delta_yoy"),
                   F.when(is_ratio, F.lit("p.p.")).otherwise(F.lit("%")).alias("unidade"))
    pp_text = F.concat(K.signed_fixed("delta_yoy"), F.lit(" p.p. (Ano) | "), K.signed_fixed("delta_pop"),
                       F.lit(" p.p. (Mês)"))
    return out.withColumn("delta_texto", F.when(is_ratio, pp_text).otherwise(K.delta_text("delta_pop", "delta_yoy")))
