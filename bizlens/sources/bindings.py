"""Bindings of the input tables to the shapes of the monthly reports.

Each builder turns the star tables into one report-shaped DataFrame, injecting the nulls, blanks, padding, case
noise, unmapped categories and duplicates the reports carry. They are plain projections, joins and one
aggregation, so they scale with the tables; the same definitions exist as SQL in ``plans.oracle_bindings``.

  V sales lines (warehouse table of report 0186)   G ledger (0387)        S category seed
  P professionals master (0229)                     C card fees (0188)     O occupancy (0126)
  K clients (0002)                                  R returns (0007)
"""

from __future__ import annotations

import datetime as dt
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bizlens.functions.cleaning import md5_key
from bizlens.sources.snapshots import deal
from bizlens.sources.tables import in_slice, key_slices, read_table, stored_bytes, table_path

MONEY = "decimal(18,2)"
RATE = "decimal(4,2)"

# Unique row order of the sales lines: (data, comanda) + the line identity.
SALES_ROW_ORDER = ("data", "comanda", "l_linenumber", "l_partkey", "l_suppkey", "valor")


def _sales_columns() -> dict:
    """Each column of V: the joined tables it needs and its expression."""
    price = F.col("l_extendedprice").cast(MONEY)
    discount = price * F.col("l_discount").cast(RATE)
    return {
        "data": ("orders", F.col("data")),
        "comanda": ("", F.col("l_orderkey")),
        "cliente": ("orders customer", F.col("cliente")),
        "profissional": ("supplier", F.col("s_name")),
        "servico": ("part", F.col("p_name")),
        "grupo_servico": ("part", F.when(F.col("p_size") % 10 == 0, F.lit(" ")).otherwise(F.col("p_type"))),
        "valor": ("", price),
        "desconto": ("", discount),
        "comissao": ("", price * F.col("l_tax").cast(RATE)),
        "custo": ("part", F.col("p_retailprice").cast(MONEY)),
        "qtd": ("", F.col("l_quantity").cast("bigint")),
        "l_linenumber": ("", F.col("l_linenumber")),
        "l_partkey": ("", F.col("l_partkey")),
        "l_suppkey": ("", F.col("l_suppkey")),
        "liquido": ("", price - discount),
        "id_servico": ("part", md5_key("p_name")),
    }


def sales_lines(spark: SparkSession, sf_dir: str, columns: tuple[str, ...] | None = None) -> DataFrame:
    """V: one row per ticket line, the sales table plus the line identity; all columns or the given ones.

    Lines keep their row when a dimension lacks their key (left joins), so only the tables that the columns need
    are joined.
    """
    known = _sales_columns()
    needed = {t for c in columns or known for t in known[c][0].split()}
    return described_lines(spark, sf_dir, ticket_lines(spark, sf_dir, needed & {"orders", "customer"}), tuple(columns or known))


def ticket_lines(spark: SparkSession, sf_dir: str, tables=("orders", "customer"), part: tuple[int, int] = (0, 1)) -> DataFrame:
    """The lines as they are stored, with day and client of their ticket; those of slice k of n by their ticket.

    The client is looked up per order, not per line: lines meet the orders once, and no line moves for its client.
    """
    lines = read_table(spark, sf_dir, "lineitem")
    if "orders" not in tables:
        return lines
    orders, day = read_table(spark, sf_dir, "orders"), F.to_date("o_orderdate").alias("data")
    if part[1] > 1:
        lines, orders = lines.where(in_slice("l_orderkey", *part)), orders.where(in_slice("o_orderkey", *part))
    if "customer" in tables:
        client = F.when(F.col("o_custkey") % 50 == 0, F.lit(None).cast("string")).otherwise(F.col("c_name"))
        orders = orders.join(read_table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"), "left") \
            .select("o_orderkey", day, client.alias("cliente"))
    else:
        orders = orders.select("o_orderkey", day)
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")


def described_lines(spark: SparkSession, sf_dir: str, lines: DataFrame, columns: tuple[str, ...],
                    keep: tuple[str, ...] = ()) -> DataFrame:
    """The given columns of V over :func:`ticket_lines` (with columns of their own to keep): part and supplier are joined if
    these need them, the longer texts of the supplier last."""
    known = _sales_columns()
    lines = with_descriptions(spark, sf_dir, lines, {t for c in columns for t in known[c][0].split()})
    return lines.select(*[known[c][1].alias(c) for c in columns], *keep)


def sales_by_month(spark: SparkSession, sf_dir: str, month: str, where: Column | None = None,
                   part: tuple[int, int] = (0, 1)) -> DataFrame:
    """V with the month of the line's day in a column ``month``, dealt by it (``snapshots.deal``) before amounts and keys are
    made of the stored columns. ``where`` is a condition on the ticket lines and the month; ``part`` is slice k of n."""
    return from_stored(stored_by_month(spark, sf_dir, month, where, part), month)


def sales_slices(spark: SparkSession, sf_dir: str, month: str, where: Column | None = None, few: bool = False) -> list[DataFrame]:
    """:func:`sales_by_month` in as many slices as the lines need, each ticket in one, to be written in turn; ``few`` when the
    condition leaves little but the lines themselves to move."""
    n = sales_slice_count(spark, sf_dir, few)
    return [sales_by_month(spark, sf_dir, month, where, (k, n)) for k in range(n)]


def sales_slice_count(spark: SparkSession, sf_dir: str, few: bool = False) -> int:
    n = key_slices(stored_bytes(spark, table_path(sf_dir, "lineitem")))
    return (n + 1) // 2 if few else n


def stored_by_month(spark: SparkSession, sf_dir: str, month: str, where: Column | None = None,
                    part: tuple[int, int] = (0, 1)) -> DataFrame:
    """The stored columns of :func:`sales_by_month`, dealt by month."""
    lines = ticket_lines(spark, sf_dir, part=part).withColumn(month, F.trunc("data", "MM"))
    lines = lines if where is None else lines.where(where)
    return deal(with_descriptions(spark, sf_dir, lines, {"part", "supplier"}).select(*_STORED, month), month)


def from_stored(stored: DataFrame, month: str) -> DataFrame:
    """V of its stored columns."""
    return stored.select(*[expr.alias(c) for c, (_, expr) in _sales_columns().items()], month)


#: What the columns of V are made of.
_STORED = ("data", "cliente", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
           "l_tax", "s_name", "p_name", "p_type", "p_size", "p_retailprice")


def with_descriptions(spark: SparkSession, sf_dir: str, lines: DataFrame, needed: set[str]) -> DataFrame:
    """The stored lines with the columns of part and supplier, if needed."""
    for table, left, right in (("part", "l_partkey", "p_partkey"), ("supplier", "l_suppkey", "s_suppkey")):
        if table in needed:
            lines = lines.join(read_table(spark, sf_dir, table), F.col(left) == F.col(right), "left")
    return lines


def professionals_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P: the professionals master, one row per supplier; one in ten has another name there than in sales, so the
    dimension has a history branch."""
    s = read_table(spark, sf_dir, "supplier", ["s_suppkey", "s_name"])
    k = F.col("s_suppkey")
    number = k.cast("string")
    return s.select(
        k.alias("seq"),
        F.when(k % 10 == 0, F.concat(F.lit("Cadastro "), F.col("s_name")))
         .when(k % 4 == 1, F.concat(F.lit("  "), F.lower("s_name"), F.lit(" ")))
         .otherwise(F.col("s_name")).alias("nome"),
        F.when(k % 5 != 0, F.concat(F.lit(" cargo "), (k % 7).cast("string"))).alias("cargo"),
        F.when(k % 6 == 0, F.lit("nan")).when(k % 6 != 1, F.concat(F.lpad(number, 9, "0"), F.lit("-"), F.lpad(number, 2, "3")))
         .alias("cpf"),
        F.when(k % 3 != 0, F.concat(F.lit("apelido "), number)).alias("apelido"),
        F.lit("Estética ").alias("especialidade"),
        F.when(k % 4 == 0, F.lit("15/03/2021 08:30")).when(k % 4 == 1, F.lit("2020-02-29")).when(k % 4 == 2, F.lit("31/02/2021"))
         .alias("data_cadastro"))


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G: the cash + accrual ledger, one row per order."""
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                              "o_orderdate", "o_orderpriority"])
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_name"])
    prio = F.col("o_orderpriority")
    key = F.col("o_orderkey")
    return o.join(c, o.o_custkey == c.c_custkey).select(
        F.to_date("o_orderdate").alias("data_movimento"),
        F.when(F.col("o_orderstatus") == "O", F.lit("Caixa")).otherwise(F.lit("Competencia")).alias("tipo"),
        F.when((prio == "2-HIGH") & (key % 11 == 0), F.lit("Profissionais - Comissões"))
         .when(key % 7 == 0, F.concat(F.lit(" "), F.lower(prio))).otherwise(prio).alias("categoria"),
        (F.col("o_totalprice").cast(MONEY) * F.when(prio.isin("2-HIGH", "3-MEDIUM"), F.lit(-1)).otherwise(F.lit(1)))
        .alias("valor"),
        F.when(key % 3 == 0, F.lit("  ")).otherwise(F.concat(F.lit("Lançamento "), key.cast("string"))).alias("titulo"),
        F.when(F.col("o_custkey") % 4 == 0, F.lit(None).cast("string")).otherwise(F.col("c_name"))
         .alias("fornecedor_cliente"),
        F.when(key % 5 == 0, F.lit("")).otherwise(F.concat(F.lit("obs "), F.col("o_orderstatus"))).alias("observacoes"),
        key.alias("seq"),
    )


# Fixed category seed (the chart of accounts; '5-LOW' is unmapped on purpose).
CATEGORY_SEED_ROWS = [
    ("1-URGENT", "1. Receita Bruta", "Serviços", False),
    ("2-HIGH", "3. Custos Variáveis", "Produtos", False),
    ("Profissionais - Comissões", "3. Custos Variáveis", "Comissões", False),
    ("3-MEDIUM", "4. Despesas Operacionais", "Fixas", True),
    ("4-NOT SPECIFIED", "5. Resultado Financeiro", "Juros", False),
]
CATEGORY_SEED_SCHEMA = "categoria string, nivel_1 string, nivel_2 string, excluir_dre boolean"


def category_seed(spark: SparkSession) -> DataFrame:
    """S: the category seed dimension (a handful of configuration rows)."""
    return spark.createDataFrame(CATEGORY_SEED_ROWS, CATEGORY_SEED_SCHEMA)


def card_fees(spark: SparkSession, sf_dir: str, periods: tuple[tuple[dt.date, dt.date], ...] = ()) -> DataFrame:
    """C: card fees per month and brand (gross, net); with ``periods``, of the months they touch only.

    The months are ranges of the shipping time itself, so they reach the scan below the aggregate.
    """
    li = read_table(spark, sf_dir, "lineitem", ["l_shipdate", "l_returnflag", "l_extendedprice", "l_tax"])
    if periods:
        ship = F.col("l_shipdate")
        months = [(a.replace(day=1), (b.replace(day=1) + dt.timedelta(days=32)).replace(day=1)) for a, b in periods]
        li = li.where(reduce(or_, [(ship >= F.lit(a)) & (ship < F.lit(b)) for a, b in months]))
    price = F.col("l_extendedprice").cast(MONEY)
    return (li.groupBy(F.to_date(F.date_trunc("month", "l_shipdate")).alias("data_competencia"),
                       F.col("l_returnflag").alias("bandeira"))
              .agg(F.sum(price).alias("valor_faturado"),
                   F.sum(price * (F.lit(1).cast(RATE) - F.col("l_tax").cast(RATE))).alias("valor_liquido")))


def occupancy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O: booked time per professional and month as ``H:MM`` text (some rows unreadable)."""
    li = read_table(spark, sf_dir, "lineitem", ["l_shipdate", "l_suppkey", "l_quantity"])
    s = read_table(spark, sf_dir, "supplier", ["s_suppkey", "s_name"])
    q = (li.join(s, li.l_suppkey == s.s_suppkey)
           .groupBy(F.to_date(F.date_trunc("month", "l_shipdate")).alias("data_competencia"),
                    F.col("s_name").alias("profissional"))
           .agg(F.sum("l_quantity").cast("bigint").alias("m")))
    m = F.col("m")
    text = F.concat(((m - m % 60) / 60).cast("bigint").cast("string"), F.lit(":"),
                    F.lpad((m % 60).cast("string"), 2, "0"))
    return q.select("data_competencia", "profissional",
                    F.when(m % 13 == 0, F.lit("Invalid")).otherwise(text).alias("total_agendado"))


def clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K: client list with duplicates, trailing dots, bad phones and literal 'nan'."""
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_name"])
    k = F.col("c_custkey")
    return c.select(
        k.alias("seq"),
        F.when(k % 97 == 0, F.lit(None).cast("string"))
         .when(k % 10 < 3, F.concat(F.lit(" cliente "), (k % 100).cast("string"), F.lit(".")))
         .otherwise(F.col("c_name")).alias("cliente"),
        F.when(k % 4 == 0, F.lit(None).cast("string"))
         .when(k % 4 == 1, F.concat(F.lit("(11) 9"), F.lpad(k.cast("string"), 8, "0")))
         .when(k % 4 == 2, F.lit("abc"))
         .otherwise(F.lpad(k.cast("string"), 11, "1")).alias("celular"),
        F.when(k % 3 == 0, F.lit(None).cast("string"))
         .when(k % 3 == 1, F.concat(F.lit(" USER"), k.cast("string"), F.lit("@Mail.com")))
         .otherwise(F.lit("nan")).alias("email"),
        F.when(k % 2 == 0, F.lit("01/02/1990")).otherwise(F.lit(None).cast("string")).alias("data_nascimento"),
    )


def returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R: return list, one row per client name, under the report's headers; the last visit as ``dd/mm/yyyy`` text."""
    o = read_table(spark, sf_dir, "orders", ["o_custkey", "o_orderdate"])
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_name"])
    q = o.join(c, o.o_custkey == c.c_custkey).groupBy("c_name").agg(F.max(F.to_date("o_orderdate")).alias("d"),
                                                                        F.min("c_custkey").alias("k"))
    d, k = F.col("d"), F.col("k")
    return q.select(F.col("c_name").alias("Cliente"),
                    F.when(k % 3 == 1, F.concat(F.lit(" USER"), k.cast("string"), F.lit("@Mail.com ")))
                     .when(k % 3 == 2, F.lit("nan")).alias("E-mail"),
                    F.concat(F.lit("(11) "), F.lpad(k.cast("string"), 8, "3")).alias("Telefone"),
                    F.when(k % 4 != 0, F.concat(F.lit("9"), F.lpad(k.cast("string"), 8, "8"))).alias("Celular"),
                    F.when(k % 4 == 1, F.lit(" f ")).when(k % 4 == 2, F.lit("nan")).when(k % 4 == 3, F.lit("M")).alias("Sexo"),
                    F.concat(F.lpad(F.dayofmonth(d).cast("string"), 2, "0"), F.lit("/"),
                             F.lpad(F.month(d).cast("string"), 2, "0"), F.lit("/"),
                             F.year(d).cast("string")).alias("Última Visita"))
