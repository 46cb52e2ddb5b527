"""Chart datasets and report tables (the DataFrame behind each dashboard element; drawing is not built).

Each function takes the period slice it needs (already filtered) and returns a small aggregated frame; the work
is a partial/final aggregation over the slice, never a collect.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bizlens.functions import cleaning as C
from bizlens.functions import dates as D
from bizlens.functions import formatting as K
from bizlens.operators import frames as FR

# Fixed values that must equal the source behaviour.
EVOLUTION_SERIES = ["Receitas", "Despesas", "Lucro Líquido"]
EXCLUDED_EXPENSE_GROUPS = ["Comissões", "Despesas Financeiras", "Impostos", "Custos Variáveis"]
EXCLUDED_EXPENSE_TERMS = ["COMISSÃO", "COMISSAO", "TAXA", "IMPOSTO"]
TOP_N = 10


MONTH_COL = "_mes"


def period_slice(df: DataFrame, date_col: str, start: dt.date, end: dt.date) -> DataFrame:
    """Inclusive date range (pushed down to the scan through the view chain). On month-partitioned facts the
    matching month range is added, so only the period's month folders are listed and read."""
    out = df.where(F.col(date_col).between(F.lit(start), F.lit(end)))
    if MONTH_COL in df.columns:
        out = out.where(F.col(MONTH_COL).between(F.lit(start.replace(day=1)), F.lit(end.replace(day=1))))
    return out


def shared_slice(df: DataFrame, date_col: str, start: dt.date, end: dt.date) -> DataFrame:
    """The period slice persisted once (memory, spilling to disk) for the KPIs and charts that all read it;
    call ``unpersist()`` when the report is done."""
    from pyspark import StorageLevel

    return period_slice(df, date_col, start, end).persist(StorageLevel.MEMORY_AND_DISK)


def query_period(spark, view: str, columns: str, start: dt.date, end: dt.date, date_col: str = "data"):
    """Period query over a registered view with bound parameters (no values formatted into the SQL text)."""
    return spark.sql(f"SELECT {columns} FROM {view} WHERE {date_col} BETWEEN :inicio AND :fim",
                     args={"inicio": start, "fim": end})


@dataclass
class PeriodResult:
    """The rows of a period query, or an empty frame with the same columns and the error."""

    df: DataFrame
    error: str | None = None


def period_result(spark, view: str, schema: str, start: dt.date, end: dt.date, date_col: str = "data",
                  run: bool = False) -> PeriodResult:
    """Period query that never fails: of a view that is missing or lacks a column the result is empty, typed by ``schema`` (a
    DDL list of the columns asked for), and the error is recorded. ``run`` also executes the query now, so an error in the
    rows is recorded as well; the rows are then persisted (free them with ``unpersist``)."""
    wanted = spark.createDataFrame([], schema).schema
    try:
        df = query_period(spark, view, ", ".join(f"`{f.name}`" for f in wanted), start, end, date_col)
        df = df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in wanted])
        if run:
            df = df.persist()
            df.count()
        return PeriodResult(df)
    except PySparkException as e:
        return PeriodResult(spark.createDataFrame([], wanted), f"{type(e).__name__}: {e}")


def sales_slice(sales_fact: DataFrame, start: dt.date, end: dt.date, title_names: bool = True) -> DataFrame:
    """Current-period sales lines with ``valor > 0``; display names title-cased as the dashboard shows them."""
    s = period_slice(sales_fact, "data", start, end).where(F.col("valor") > 0)
    if title_names:
        s = s.withColumns({c: C.title_case(c) for c in ("profissional", "servico", "categoria_servico")
                            if c in s.columns})
    return s


# ---------------------------------------------------------------------------------------------- P1 evolution
def financial_evolution(pl_slice: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Revenue / expense / net per time bucket (granularity from the period span), every bucket between the first
    and the last present, long format with pt-BR labels; empty when revenue and expenses are both zero."""
    grain = D.granularity(start, end)
    split = FR.signed_split(pl_slice.withColumn("_b", D.bucket("data", grain)).where(F.col("_b").isNotNull()),
                            ["_b"], "valor")
    # empty when the period has neither revenue nor expenses (checked inside the one-row bounds aggregate)
    filled = FR.gap_fill(split, "_b", D.bucket_step(grain), ["receitas", "despesas", "lucro_liquido"],
                         keep_if=F.sum(F.col("receitas") + F.col("despesas")) != 0)
    long = filled.select(
        F.col("_b").alias("Data_Sort"), D.bucket_label("_b", grain).alias("Data_Formatada"),
        F.col("receitas").cast("double").alias(EVOLUTION_SERIES[0]),
        F.col("despesas").cast("double").alias(EVOLUTION_SERIES[1]),
        F.col("lucro_liquido").cast("double").alias(EVOLUTION_SERIES[2]),
    ).unpivot(["Data_Sort", "Data_Formatada"], EVOLUTION_SERIES, "Tipo", "Valor")
    return long.withColumn("Valor_Formatado", K.format_currency("Valor"))


# ---------------------------------------------------------------------------------------------- P2 top expenses
def top_expenses(pl_slice: DataFrame, by_group: bool = True, k: int = TOP_N,
                 excluded_groups=EXCLUDED_EXPENSE_GROUPS, excluded_terms=EXCLUDED_EXPENSE_TERMS) -> DataFrame:
    """Top-k expense categories by absolute value. With a group column the excluded groups are dropped
    (``NOT IN`` keeps null groups); without it, categories whose text names an excluded term are dropped."""
    e = pl_slice.where(F.col("valor") < 0)
    if by_group:
        e = e.where(~F.coalesce(F.col("grupo_metrica").isin(*excluded_groups), F.lit(False)))
    else:
        e = e.where(C.text_excludes("categoria", excluded_terms))
    g = e.where(F.col("categoria").isNotNull()).groupBy("categoria") \
        .agg(F.sum(F.abs(F.col("valor"))).cast("double").alias("valor_abs"))
    top = FR.top_k(g, [F.col("valor_abs").desc(), F.col("categoria").asc()], k)
    return top.withColumn("valor_fmt", K.format_currency("valor_abs"))


# ---------------------------------------------------------------------------------------------- P3-P6 sales charts
def _sum_by(sales: DataFrame, key: str) -> DataFrame:
    return sales.where(F.col(key).isNotNull()).groupBy(key).agg(F.sum("valor").alias("valor"))


def professional_ranking(sales: DataFrame) -> DataFrame:
    """Revenue per professional, share of the total (0 unless the total is positive), formatted texts."""
    g = FR.share_of_total(_sum_by(sales, "profissional"), "valor").withColumn("valor", F.col("valor").cast("double"))
    return g.select("profissional", "valor", "percentual", K.format_currency("valor").alias("valor_fmt"),
                    K.share_text("percentual").alias("percentual_fmt")) \
            .orderBy(F.col("valor").desc(), F.col("profissional").asc())


def top_services(sales: DataFrame, k: int = TOP_N) -> DataFrame:
    """Top-k services by revenue (blank names dropped)."""
    g = _sum_by(sales.where(F.col("servico") != ""), "servico").withColumn("valor", F.col("valor").cast("double"))
    top = FR.top_k(g, [F.col("valor").desc(), F.col("servico").asc()], k)
    return top.withColumn("valor_fmt", K.format_currency("valor"))


def category_mix(sales: DataFrame) -> DataFrame:
    """Revenue and share per service category (blank categories dropped)."""
    g = FR.share_of_total(_sum_by(sales.where(F.col("categoria_servico") != ""), "categoria_servico"), "valor") \
        .withColumn("valor", F.col("valor").cast("double"))
    return g.select("categoria_servico", "valor", "percentual", K.format_currency("valor").alias("valor_fmt"),
                    K.share_text("percentual").alias("percentual_fmt"))


def weekday_performance(sales: DataFrame) -> DataFrame:
    """Mean line value per weekday (Monday = 0, short pt-BR names), in weekday order."""
    g = (sales.where(F.col("data").isNotNull())
         .groupBy(D.weekday_monday0("data").cast("bigint").alias("dia_semana_num"))
         .agg((F.sum("valor").cast("double") / F.count(F.lit(1)).cast("double")).alias("valor")))
    return g.select("dia_semana_num", D.weekday_short_pt("dia_semana_num").alias("dia_semana"), "valor",
                    K.format_currency("valor").alias("valor_fmt")).orderBy("dia_semana_num")


# ---------------------------------------------------------------------------------------------- J8 ledger detail
def ledger_detail(pl_slice: DataFrame) -> DataFrame:
    """Audit listing of the period's P&L lines, newest first, display-cased, value formatted."""
    return pl_slice.select(
        "data", F.coalesce(F.col("grupo_metrica"), F.lit("-")).alias("grupo_metrica"),
        C.title_case("categoria_detalhada").alias("categoria"), C.title_case("descricao").alias("descricao"),
        K.format_currency("valor").alias("valor_formatado")).orderBy(F.col("data").desc_nulls_last())


def pl_current_columns(pl: DataFrame) -> DataFrame:
    """The detail projection the financial tab reads (``categoria_detalhada`` exposed as ``categoria``)."""
    return pl.select("data", "grupo_metrica", F.col("categoria_detalhada").alias("categoria"), "descricao", "valor")

