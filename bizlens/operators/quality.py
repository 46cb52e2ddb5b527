"""Data-quality checks as DataFrames (one row per check, with a pass flag)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def orphan_keys(fact: DataFrame, fact_key, dim: DataFrame, dim_key: str, check: str,
                weight: str | None = None) -> DataFrame:
    """Fact rows whose key has no dimension member (null keys count as orphans).

    The fact is first reduced to one row per key (partial aggregation, so a key holding a large share of the rows
    costs one row per map task), and only those per-key counts meet the dimension keys in a left join.
    ``weight`` names a row-count column when ``fact`` is already pre-aggregated; ``fact_key`` may be a Column.
    """
    key = F.col(fact_key) if isinstance(fact_key, str) else fact_key
    n = F.sum(weight) if weight else F.count(F.lit(1))
    per_key = fact.groupBy(key.alias("_k")).agg(n.alias("_n"))
    known = dim.select(F.col(dim_key).alias("_d")).where(F.col("_d").isNotNull()).distinct()
    lost = F.col("_d").isNull()
    # one aggregate after one join gives the total and the orphans
    return per_key.join(known, F.col("_k") == F.col("_d"), "left").agg(
        F.coalesce(F.sum(F.when(lost, F.col("_n"))), F.lit(0)).cast("bigint").alias("linhas_orfas"),
        F.count(F.when(lost, 1)).cast("bigint").alias("chaves_orfas"),
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("linhas")) \
        .select(F.lit(check).alias("checagem"), "linhas_orfas", "chaves_orfas", "linhas",
                (F.col("linhas_orfas") == 0).alias("ok"))


def duplicate_members(dim: DataFrame, name_col: str, check: str) -> DataFrame:
    """Names that appear under more than one key in a dimension (e.g. two unknown members)."""
    per_name = dim.groupBy(name_col).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    return per_name.agg(F.count(F.lit(1)).cast("bigint").alias("violacoes")) \
        .select(F.lit(check).alias("checagem"), "violacoes", (F.col("violacoes") == 0).alias("ok"))


def sign_conventions(pl: DataFrame, revenue_groups: list[str], cost_groups: list[str]) -> DataFrame:
    """Revenue lines must not be negative and cost lines must not be positive (one row per rule)."""
    g, v = F.col("grupo_metrica"), F.col("valor")
    a = pl.agg(F.count(F.when(g.isin(*revenue_groups) & (v < 0), 1)).cast("bigint").alias("receita_negativa"),
               F.count(F.when(g.isin(*cost_groups) & (v > 0), 1)).cast("bigint").alias("custo_positivo"))
    return a.select(F.explode(F.array(
        F.struct(F.lit("receita_negativa").alias("checagem"), F.col("receita_negativa").alias("violacoes")),
        F.struct(F.lit("custo_positivo").alias("checagem"), F.col("custo_positivo").alias("violacoes")))).alias("x")) \
        .select("x.*").withColumn("ok", F.col("violacoes") == 0)
