"""The warehouse tables (``tbl_*``) and views bound to the input tables of one scale directory.

Tables are DataFrames built lazily from ``sources.bindings`` (+ the report transforms where the binding is raw),
so every query reads the input Parquet and grows with it.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bizlens.plans import model as M
from bizlens.plans import transforms as T
from bizlens.sources import bindings as B


class Warehouse:
    """``periods`` (start, end): the card fees hold the months that these touch; none given: all months."""

    def __init__(self, spark: SparkSession, sf_dir: str, *periods):
        self.spark = spark
        self.sf_dir = sf_dir
        self.periods = periods

    # ------------------------------------------------------------------ tables
    @cached_property
    def sales(self) -> DataFrame:
        """tbl_0186_comandas (+ line identity columns used as a total order)."""
        return self.sales_lines()

    def sales_lines(self, *columns: str) -> DataFrame:
        """The sales table with the given columns: joins only what they need."""
        return B.sales_lines(self.spark, self.sf_dir, columns)

    @cached_property
    def professionals(self) -> DataFrame:
        """tbl_0229_profissionais: the professionals transform over the raw master."""
        return T.professionals(B.professionals_master(self.spark, self.sf_dir), seq_cols=["seq"])

    @cached_property
    def ledger(self) -> DataFrame:
        """tbl_0387_financeiro."""
        return B.ledger(self.spark, self.sf_dir)

    @cached_property
    def seed(self) -> DataFrame:
        """tbl_dim_categorias."""
        return B.category_seed(self.spark)

    @cached_property
    def card_fees(self) -> DataFrame:
        """tbl_0188_bandeirascartao."""
        return B.card_fees(self.spark, self.sf_dir, self.periods)

    @cached_property
    def occupancy(self) -> DataFrame:
        """tbl_0126_ocupacao: the occupancy transform over the raw report."""
        return T.occupancy(B.occupancy(self.spark, self.sf_dir))

    @cached_property
    def clients(self) -> DataFrame:
        """tbl_0002_clientes: the clients transform (best record per name + unknown member)."""
        return T.clients(B.clients(self.spark, self.sf_dir), seq_cols=["seq"])

    # ------------------------------------------------------------------ views
    def sales_fact(self, with_recurrence: bool = True) -> DataFrame:
        if not with_recurrence:
            return M.fct_vendas(self.sales, with_recurrence=False)
        # flagged while the lines are narrow, before part and supplier give them their texts
        lines = B.ticket_lines(self.spark, self.sf_dir).withColumns({
            "comanda": F.col("l_orderkey"), "valor": F.col("l_extendedprice").cast(B.MONEY)})
        flagged = M.flag_recurrence(lines, list(B.SALES_ROW_ORDER))
        sales = B.described_lines(self.spark, self.sf_dir, flagged, tuple(self.sales.columns), (M.RECURRENT,))
        return M.fct_vendas(sales, B.SALES_ROW_ORDER)

    def sales_slice(self, *columns: str) -> DataFrame:
        """The sales fact without recurrence, of the given columns of the sales table."""
        return M.fct_vendas(self.sales_lines(*columns), with_recurrence=False)

    @cached_property
    def card_fee_fact(self) -> DataFrame:
        return M.fct_taxas_cartao(self.card_fees)

    @cached_property
    def pl(self) -> DataFrame:
        """rep_financeiro_competencia (commissions need no recurrence flag, so it is not computed)."""
        commissions = self.sales_slice("data", "comanda", "profissional", "comissao")
        return M.rep_financeiro_competencia(self.ledger, self.seed, commissions, self.card_fee_fact)

    def tables(self) -> dict[str, DataFrame]:
        return {"tbl_0186_comandas": self.sales, "tbl_0229_profissionais": self.professionals,
                "tbl_0387_financeiro": self.ledger, "tbl_dim_categorias": self.seed,
                "tbl_0188_bandeirascartao": self.card_fees, "tbl_0126_ocupacao": self.occupancy,
                "tbl_0002_clientes": self.clients}
