"""The layered model (dim_ / fct_ / int_ / rep_) as DataFrame builders.

Every builder takes its input tables as DataFrames, so Catalyst inlines the whole chain: filters and column
pruning cross view boundaries and reach the Parquet scans. ``register_views`` publishes them by name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bizlens.functions import cleaning as C
from bizlens.functions import dates as D
from bizlens.operators import frames as FR

# Fixed values that must equal the source behaviour (P&L groups, levels, texts).
LEVEL_REVENUE = "1. Receita Bruta"
LEVEL_VARIABLE_COSTS = "3. Custos Variáveis"
LEVEL_OPERATING = "4. Despesas Operacionais"
LEVEL_FINANCIAL = "5. Resultado Financeiro"
COMMISSION_CATEGORY = "PROFISSIONAIS - COMISSÕES"
GROUP_REVENUE = "Receita Bruta"
GROUP_COMMISSIONS = "Comissões"
GROUP_COSTS = "Custo Serviço/Produto"
GROUP_OPERATING = "Despesas Operacionais"
GROUP_FEES = "Despesas Financeiras"
GROUP_FINANCIAL = "Resultado Financeiro"
COMMISSION_TEXT = "Comissões de Profissionais"
FEES_TEXT = "Taxas de Cartão"
FEES_DESCRIPTION = "Taxas Maquininha/Antecipação"
SALE_REFERENCE_PREFIX = "Ref. Venda #"
CATEGORY_FALLBACK = "Outros"
STATUS_ACTIVE = "Ativo"
STATUS_INACTIVE = "Inativo"
ROLE_HISTORICAL = "Histórico"

PL_VALUE = "decimal(38,4)"
# Month partition column of the fact tables written by the pipeline (carried through the views when present).
MONTH_COL = "_mes"
FEE_FACT_SCHEMA = ("data_competencia date, bandeira string, valor_faturado double, valor_liquido double, "
                   "valor_taxa double")


def _not_blank(c: str) -> Column:
    return F.col(c).isNotNull() & (F.col(c) != "")


# ---------------------------------------------------------------------------------------------- dimensions
def dim_profissionais(professionals: DataFrame, sales: DataFrame) -> DataFrame:
    """Master professionals (active) plus names seen in sales but absent from the master (historical).

    The absent set is a ``left_anti`` join on the normalised name (not LEFT JOIN ... IS NULL, which Catalyst
    does not rewrite); distinct names are reduced map-side before the shuffle.
    """
    master = professionals.where(_not_blank("nome")).select(
        "id_profissional", "nome", "cargo", F.lit(STATUS_ACTIVE).alias("status"))
    seen = (sales.where(_not_blank("profissional")).select("profissional").distinct()
                 .withColumn("_k", C.normalized_key("profissional")))
    known = professionals.select(C.normalized_key("nome").alias("_k")).where(F.col("_k").isNotNull()).distinct()
    history = seen.join(known, "_k", "left_anti").select(
        C.md5_key("profissional").alias("id_profissional"), F.col("profissional").alias("nome"),
        F.lit(ROLE_HISTORICAL).alias("cargo"), F.lit(STATUS_INACTIVE).alias("status"))
    return master.unionByName(history)


def dim_clientes(clients_table: DataFrame) -> DataFrame:
    return clients_table.select("id_cliente", "cliente", "email", "celular", "data_nascimento", "sexo")


def dim_servicos(sales: DataFrame) -> DataFrame:
    return sales.where(F.col("servico").isNotNull()).select("id_servico", "servico", "grupo_servico").distinct()


def dim_calendario(spark: SparkSession, start=D.CALENDAR_START, end=D.CALENDAR_END) -> DataFrame:
    bounds = spark.range(1).select(F.lit(start).alias("a"), F.lit(end).alias("b"))
    return calendar_from_bounds(bounds, "a", "b")


def calendar_from_bounds(bounds: DataFrame, start_col: str, end_col: str) -> DataFrame:
    days = D.date_spine(bounds, start_col, end_col, F.expr("INTERVAL 1 DAY"), "d")
    return days.select(*D.calendar_columns("d"))


# ---------------------------------------------------------------------------------------------- resolved members
def resolved_members(listed: DataFrame, name_col: str, facts: list[DataFrame], key_col: str = "id_membro") -> DataFrame:
    """A dimension whose keys meet those of the facts: the listed members by :func:`cleaning.member_key` (one row a key), the
    names that stand for nobody as the one unknown row, and a row with the name alone for each name that only facts have.

    ``facts`` have the name in a column ``name_col``; they are reduced to distinct keys on the map side first.
    """
    key, known = C.member_key(name_col), ~C.is_unknown(name_col)
    others = [c for c in listed.columns if c not in (key_col, name_col)]
    members = FR.first_per_key(listed.where(known).withColumn(key_col, key), [key_col], [name_col])
    seen = [f.where(known).groupBy(key.alias(key_col)).agg(F.min(C.member_name(name_col)).alias(name_col)) for f in facts]
    names = FR.stack(seen).groupBy(key_col).agg(F.min(name_col).alias(name_col))
    extra = names.join(members.select(key_col), key_col, "left_anti")
    unknown = {key_col: C.UNKNOWN_KEY, name_col: C.NOT_IDENTIFIED_CLIENT}
    out = members.select(key_col, name_col, *others).unionByName(extra, allowMissingColumns=True)
    return FR.append_member(out, unknown)


def with_member_key(fact: DataFrame, name_col: str, key_col: str) -> DataFrame:
    """The fact with the resolved key of the member named in ``name_col``."""
    return fact.withColumn(key_col, C.member_key(name_col))


# ---------------------------------------------------------------------------------------------- facts
def fct_taxas_cartao(card_fees: DataFrame) -> DataFrame:
    return (card_fees.where(F.col("valor_faturado").isNotNull() & F.col("valor_liquido").isNotNull())
            .select("data_competencia", "bandeira", "valor_faturado", "valor_liquido",
                    (F.col("valor_faturado") - F.col("valor_liquido")).alias("valor_taxa"), *_month_of(card_fees)))


def fct_ocupacao(occupancy_table: DataFrame) -> DataFrame:
    return occupancy_table.where(_not_blank("profissional")).select(
        C.md5_key("profissional").alias("id_profissional"), "profissional", "data_competencia",
        "horas_agendadas_decimal", *_month_of(occupancy_table))


def _month_of(table: DataFrame) -> list[str]:
    """The month partition column, if the table has it."""
    return [MONTH_COL] if MONTH_COL in table.columns else []


def fct_vendas(sales: DataFrame, row_order=None, with_recurrence: bool = True, keys: DataFrame | None = None,
               firsts: DataFrame | None = None) -> DataFrame:
    """Sales fact: visit key, client/professional keys, category fallback and the recurrence flag.

    ``is_recorrente`` is true for every line that is not the client's first line (by ``row_order``, a total
    order). The first line per client comes from a ``row_number() = 1`` window that Spark limits per key
    before the shuffle, and is joined back on the unique row identity, so the client key (where one unknown
    client can own a large share of all lines) never forces a whole group into one task. ``keys`` may give the
    same lines with the client and the order columns only, so the first lines come from a narrower plan.
    ``firsts`` may give the clients' first lines themselves (client key and order columns, kept by
    ``plans.first_purchase``): then no history is read for them. Lines that have the flag already (:func:`flag_recurrence`)
    keep it. Keys are made after the join, so only the columns that they are made of move with the lines.
    Of ``sales`` that lacks columns, the fact has the columns that it admits.
    """
    if with_recurrence and not row_order:
        raise ValueError("recurrence needs a total order of the lines: pass row_order")
    fact = {
        "data": ("data",), "comanda": ("comanda",), "id_comanda": ("data", "comanda", "cliente"),
        "id_cliente": ("cliente",), "id_profissional": ("profissional",), "profissional": ("profissional",),
        "servico": ("servico",), "grupo_servico": ("grupo_servico",), "categoria_servico": ("grupo_servico",),
        **{c: (c,) for c in ("valor", "desconto", "comissao", "custo", "liquido", MONTH_COL)},
    }
    made = {
        "id_comanda": lambda: C.visit_key("data", "comanda", "cliente"), "id_cliente": lambda: C.md5_key("cliente"),
        "id_profissional": lambda: C.md5_key("profissional"),
        "categoria_servico": lambda: C.first_non_blank("grupo_servico", F.lit(CATEGORY_FALLBACK)),
    }
    admitted = [c for c, needs in fact.items() if set(needs) <= set(sales.columns)]
    columns = [made[c]().alias(c) if c in made else F.col(c) for c in admitted]
    flag = [RECURRENT] if with_recurrence else []
    if with_recurrence and RECURRENT not in sales.columns:
        needs = dict.fromkeys(n for c in admitted for n in fact[c])
        lines = sales.select(*needs, *[c for c in dict.fromkeys(["cliente", *row_order]) if c not in needs])
        sales = flag_recurrence(lines, list(row_order), keys, firsts)
    return sales.select(*columns, *flag)


RECURRENT = "is_recorrente"


def flag_recurrence(lines: DataFrame, row_order: list[str], keys: DataFrame | None = None,
                    firsts: DataFrame | None = None) -> DataFrame:
    """The lines with the recurrence flag of :func:`fct_vendas`; they have the client and the order columns, and may lack all
    others, so the flag can be set before texts are joined to the lines."""
    if firsts is None:
        narrow = (lines if keys is None else keys).select(C.md5_key("cliente").alias("id_cliente"), *row_order)
        return _flagged(lines, row_order, FR.first_per_key(narrow, ["id_cliente"], row_order))
    # A kept table of first lines: a small filter over it tells which lines may be in it, and only these meet it. All other
    # lines are recurrent where they stand, so they are not shuffled (the lines are read twice).
    types = dict(lines.dtypes)
    order = [FR.hashable(F.col(c).cast(types[c]), types[c]) for c in row_order]
    marked = FR.with_marks(lines, [FR.hashable(F.col(c), types[c]) for c in row_order], FR.marks(firsts, order), "_pode_ser")
    may, cannot = marked.where("_pode_ser").drop("_pode_ser"), marked.where("NOT _pode_ser").drop("_pode_ser")
    return _flagged(may, row_order, firsts).unionByName(cannot.withColumn(RECURRENT, F.lit(True)))


def _flagged(lines: DataFrame, row_order: list[str], firsts: DataFrame) -> DataFrame:
    firsts = firsts.select(*[F.col(c).alias(f"_f_{c}") for c in ("id_cliente", *row_order)], F.lit(True).alias("_is_first"))
    # One first row per client, joined on the client too: the join never multiplies lines. The client's key is compared
    # last, where the order columns are equal already.
    same = [F.col(c).eqNullSafe(F.col(f"_f_{c}")) for c in row_order]
    flagged = lines.join(firsts, on=[*same, C.md5_key("cliente").eqNullSafe(F.col("_f_id_cliente"))], how="left")
    return flagged.select(*lines.columns, F.col("_is_first").isNull().alias(RECURRENT))


# ---------------------------------------------------------------------------------------------- ledger
def _with_levels(ledger_table: DataFrame, seed: DataFrame) -> DataFrame:
    """LEFT join of the ledger to the category seed on UPPER(TRIM(categoria)).

    The seed's categories are unique (checked where it is loaded); how to join is the planner's choice by size.
    """
    dim = (seed.select(C.normalized_key("categoria").alias("_cat"), "nivel_1", "nivel_2", "excluir_dre"))
    return (ledger_table.withColumn("_cat", C.normalized_key("categoria"))
            .join(dim, "_cat", "left").drop("_cat"))


def int_financeiro_competencia(ledger_table: DataFrame, seed: DataFrame) -> DataFrame:
    f = _with_levels(ledger_table.where(F.col("tipo") == "Competencia"), seed)
    return f.select("data_movimento", "categoria", "titulo", "fornecedor_cliente", "observacoes", "valor",
                    "nivel_1", "nivel_2", "excluir_dre", *([MONTH_COL] if MONTH_COL in ledger_table.columns else []))


def int_financeiro_caixa(ledger_table: DataFrame, seed: DataFrame) -> DataFrame:
    f = _with_levels(ledger_table.where(F.col("tipo") == "Caixa"), seed)
    return f.select(*[c for c in ledger_table.columns], "nivel_1", "nivel_2", "excluir_dre")


def rep_financeiro_competencia(ledger_table: DataFrame, seed: DataFrame, sales_fact: DataFrame,
                               card_fee_fact: DataFrame, exclude_flagged: bool = False) -> DataFrame:
    """Unified P&L: ledger (4 groups in one scan) + commissions from sales + card fees.

    The four ledger branches of the statement read the same accrual ledger; here it is scanned once and the
    group, sign and filter are CASE expressions over that scan. When the inputs are month-partitioned tables,
    their partition column is carried as ``_mes`` so a period slice prunes whole month folders. ``exclude_flagged`` leaves
    out ledger lines whose category is flagged ``excluir_dre`` (the statement keeps them by default).
    """
    f = int_financeiro_competencia(ledger_table, seed)
    if exclude_flagged:
        f = f.where(~F.coalesce(F.col("excluir_dre"), F.lit(False)))
    with_month = MONTH_COL in f.columns or MONTH_COL in sales_fact.columns

    def month(df: DataFrame, day: str) -> list[Column]:
        if not with_month:
            return []
        return [F.col(MONTH_COL) if MONTH_COL in df.columns else F.trunc(day, "MM").alias(MONTH_COL)]

    lvl = F.col("nivel_1")
    group = (F.when(lvl == LEVEL_REVENUE, F.lit(GROUP_REVENUE))
              .when((lvl == LEVEL_VARIABLE_COSTS) & (C.normalized_key("categoria") != F.lit(COMMISSION_CATEGORY)),
                    F.lit(GROUP_COSTS))
              .when(lvl == LEVEL_OPERATING, F.lit(GROUP_OPERATING))
              .when(lvl == LEVEL_FINANCIAL, F.lit(GROUP_FINANCIAL)))
    v = F.col("valor").cast(PL_VALUE)
    value = F.when(F.col("grupo_metrica").isin(GROUP_COSTS, GROUP_OPERATING), -F.abs(v)).otherwise(v)
    ledger_part = (f.withColumn("grupo_metrica", group).where(F.col("grupo_metrica").isNotNull())
                   .select(F.col("data_movimento").alias("data"), "grupo_metrica", F.col("nivel_2").alias("subgrupo"),
                           value.alias("valor"), F.col("categoria").alias("categoria_detalhada"),
                           C.first_non_blank("titulo", "fornecedor_cliente", "observacoes", "categoria")
                           .alias("descricao"), *month(f, "data_movimento")))
    commissions = sales_fact.select(
        "data", F.lit(GROUP_COMMISSIONS).alias("grupo_metrica"), F.lit(COMMISSION_TEXT).alias("subgrupo"),
        (-F.col("comissao")).cast(PL_VALUE).alias("valor"), F.lit(COMMISSION_TEXT).alias("categoria_detalhada"),
        F.concat(F.lit(SALE_REFERENCE_PREFIX), F.col("comanda").cast("string"), F.lit(" - "),
                 F.col("profissional")).alias("descricao"), *month(sales_fact, "data"))
    fees = card_fee_fact.select(
        F.col("data_competencia").alias("data"), F.lit(GROUP_FEES).alias("grupo_metrica"),
        F.lit(FEES_TEXT).alias("subgrupo"), (-F.col("valor_taxa")).cast(PL_VALUE).alias("valor"),
        F.lit(FEES_TEXT).alias("categoria_detalhada"), F.lit(FEES_DESCRIPTION).alias("descricao"),
        *month(card_fee_fact, "data_competencia"))
    return ledger_part.unionByName(commissions).unionByName(fees)


# ---------------------------------------------------------------------------------------------- registration
DEPRECATED_VIEWS = ("vw_dim_profissionais", "vw_dim_clientes", "vw_dim_servicos", "vw_dim_calendario",
                    "vw_dim_categorias", "vw_fato_financeiro", "vw_fato_taxas_cartao", "vw_fato_ocupacao",
                    "vw_fato_vendas", "vw_competencia")


def register_views(spark: SparkSession, tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Publish the model as temp views. ``tables`` maps warehouse names (``tbl_0186_comandas`` ...) to frames."""
    for name in DEPRECATED_VIEWS:
        spark.catalog.dropTempView(name)
    t = tables
    views: dict[str, DataFrame] = {}
    if "tbl_0186_comandas" in t:
        sales = t["tbl_0186_comandas"]
        position = [c for c in ("_arquivo", "_linha") if c in sales.columns]
        # Without the raw position the line's own columns complete the order.
        order = ["data", "comanda", *(position or [c for c in sales.columns if c not in ("data", "comanda")])]
        views["fct_vendas"] = fct_vendas(sales, order, firsts=t.get("est_primeiras_linhas") if position else None)
        views["dim_servicos"] = dim_servicos(t["tbl_0186_comandas"])
        if "tbl_0229_profissionais" in t:
            views["dim_profissionais"] = dim_profissionais(t["tbl_0229_profissionais"], t["tbl_0186_comandas"])
    if "tbl_0002_clientes" in t:
        views["dim_clientes"] = dim_clientes(t["tbl_0002_clientes"])
    views["dim_calendario"] = dim_calendario(spark)
    if "tbl_0188_bandeirascartao" in t:
        views["fct_taxas_cartao"] = fct_taxas_cartao(t["tbl_0188_bandeirascartao"])
    if "tbl_0126_ocupacao" in t:
        views["fct_ocupacao"] = fct_ocupacao(t["tbl_0126_ocupacao"])
    if "tbl_0387_financeiro" in t and "tbl_dim_categorias" in t:
        views["int_financeiro_competencia"] = int_financeiro_competencia(t["tbl_0387_financeiro"],
                                                                         t["tbl_dim_categorias"])
        views["int_financeiro_caixa"] = int_financeiro_caixa(t["tbl_0387_financeiro"], t["tbl_dim_categorias"])
        if "fct_vendas" in views:
            # a month without card-fee extracts contributes no fee lines (schema-stable empty input)
            fees = views.get("fct_taxas_cartao") or spark.createDataFrame([], FEE_FACT_SCHEMA)
            views["rep_financeiro_competencia"] = rep_financeiro_competencia(
                t["tbl_0387_financeiro"], t["tbl_dim_categorias"],
                fct_vendas(t["tbl_0186_comandas"], with_recurrence=False), fees)
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return views
