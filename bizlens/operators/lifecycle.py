"""Client lifecycle numbers: new clients, churn, ranking.

One aggregate per client over the sales lines gives everything: the first day ever, and per period the visits, the revenue
and the first and last day. Lines are first reduced to one row per visit (a visit has one day), so a client with a very
large share of all lines is spread over its visits, and periods are told apart inside the aggregate: no self join. Lines
without a known client (null key, or one of ``unknown``) count for no client; like the sales KPIs, only lines with
``valor > 0`` count.

Definitions (the dashboard names these numbers but shows no value for them): a client is new in the period that holds its first
visit ever; a client of a period is lost if it has no visit in the next one; the ranking is by visits, then revenue.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bizlens.functions import dates as D
from bizlens.operators import frames as FR
from bizlens.operators import metrics as MT

CLIENT = "id_cliente"


def _in(day: str, period: D.Period) -> Column:
    return F.col(day).between(F.lit(period.start), F.lit(period.end))


def client_activity(sales_fact: DataFrame, periods: list[D.Period], unknown: tuple[str, ...] = (),
                    firsts: DataFrame | None = None) -> DataFrame:
    """One row per known client: ``primeira`` (day of the first visit) and, for the i-th period, ``visitas_i``, ``valor_i``,
    ``ultima_i``. ``firsts`` may give the clients' first lines (client, data) kept by ``plans.first_purchase`` over lines with
    a value; then only lines inside the periods are read, and clients without any of these have no row."""
    lines = sales_fact.where((F.col("valor") > 0) & F.col(CLIENT).isNotNull())
    if unknown:
        lines = lines.where(~F.col(CLIENT).isin(*unknown))
    if firsts is not None:
        lines = lines.where(D.any_period("data", periods))
    visits = lines.groupBy(CLIENT, "id_comanda").agg(F.min("data").alias("_d"), F.sum("valor").alias("_v"))
    found = visits.groupBy(CLIENT).agg(
        F.min("_d").alias("primeira"),
        *[a for i, p in enumerate(periods) for a in (
            F.count_if(_in("_d", p)).alias(f"visitas_{i}"), F.sum(F.when(_in("_d", p), F.col("_v"))).alias(f"valor_{i}"),
            F.max(F.when(_in("_d", p), F.col("_d"))).alias(f"ultima_{i}"))])
    if firsts is None:
        return found
    known = firsts.select(F.col(CLIENT).alias("_k"), F.col("data").alias("_p"))
    return found.join(known, F.col(CLIENT) == F.col("_k"), "left") \
        .withColumn("primeira", F.coalesce("_p", "primeira")).drop("_k", "_p")


def new_clients(spark: SparkSession, sales_fact: DataFrame, start: dt.date, end: dt.date, **known) -> DataFrame:
    """Per period (current, previous, year ago): clients with a visit, those whose first visit it holds, and their share in
    percent. A period without visits has zeros."""
    periods = D.comparison_periods(start, end)
    activity = client_activity(sales_fact, periods, **known)
    counts = activity.agg(*[a for i, p in enumerate(periods) for a in (
        F.count_if(F.col(f"visitas_{i}") > 0).alias(f"ativos_{i}"),
        F.count_if((F.col(f"visitas_{i}") > 0) & _in("primeira", p)).alias(f"novos_{i}"))])
    # the one row of counts, as one row per period
    rows = counts.select(F.inline(F.array(*[F.struct(F.lit(p.name).alias("periodo"), F.col(f"ativos_{i}").alias("clientes_ativos"),
                                                     F.col(f"novos_{i}").alias("novos_clientes"))
                                            for i, p in enumerate(periods)])))
    out = MT.with_all_periods(spark, periods, rows, {"clientes_ativos": 0, "novos_clientes": 0})
    return out.select("ordem", "periodo", "inicio", "fim", "clientes_ativos", "novos_clientes",
                      _percent("novos_clientes", "clientes_ativos").alias("novos_pct"))


def _percent(part: str, whole: str) -> Column:
    return F.when(F.col(whole) > 0, F.col(part).cast("double") / F.col(whole).cast("double") * F.lit(100.0)).otherwise(F.lit(0.0))


def churn(sales_fact: DataFrame, start: dt.date, end: dt.date, **known) -> DataFrame:
    """One row: clients of the previous period, those of them without a visit in the current one, their share in percent and
    the revenue that they had brought."""
    now, before = D.comparison_periods(start, end)[:2]
    activity = client_activity(sales_fact, [now, before], **known)
    there, lost = F.col("visitas_1") > 0, (F.col("visitas_1") > 0) & (F.col("visitas_0") == 0)
    out = activity.agg(F.count_if(there).alias("clientes_anteriores"), F.count_if(lost).alias("clientes_perdidos"),
                       F.coalesce(F.sum(F.when(lost, F.col("valor_1"))), F.lit(0)).cast("double").alias("valor_perdido"))
    return out.withColumn("churn_pct", _percent("clientes_perdidos", "clientes_anteriores"))


def churned_clients(sales_fact: DataFrame, start: dt.date, end: dt.date, **known) -> DataFrame:
    """The clients behind :func:`churn`: their visits, revenue and last day in the previous period."""
    now, before = D.comparison_periods(start, end)[:2]
    activity = client_activity(sales_fact, [now, before], **known)
    return activity.where((F.col("visitas_1") > 0) & (F.col("visitas_0") == 0)).select(
        CLIENT, F.col("visitas_1").alias("visitas"), F.col("valor_1").cast("double").alias("valor"),
        F.col("ultima_1").alias("ultima_visita"))


def client_ranking(sales_fact: DataFrame, start: dt.date, end: dt.date, k: int = 10, **known) -> DataFrame:
    """The k clients of the period with most visits (ties: most revenue, then the smallest key)."""
    period = D.Period("atual", start, end)
    activity = client_activity(sales_fact, [period], **known).where(F.col("visitas_0") > 0)
    top = FR.top_k(activity, [F.col("visitas_0").desc(), F.col("valor_0").desc(), F.col(CLIENT).asc()], k)
    return top.select(CLIENT, F.col("visitas_0").alias("visitas"), F.col("valor_0").cast("double").alias("valor"),
                      "primeira", F.col("ultima_0").alias("ultima_visita"))
