"""Registered queries of the loading side: landing, discovery, stream, seed, pipeline, registered views.

They add to the registry of ``plans.queries``. What a query writes goes to fresh folders under the shared work folder.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bizlens.functions import cleaning as C
from bizlens.operators import frames as FR
from bizlens.operators import reports as RP
from bizlens.plans import first_purchase as FP
from bizlens.plans import model as M
from bizlens.plans import pipeline as PL
from bizlens.plans import queries as QR
from bizlens.plans.oracle_bindings import with_ctes
from bizlens.plans.queries import register
from bizlens.plans.warehouse import Warehouse
from bizlens.session import freed_shuffles, shared_path
from bizlens.sources import bindings as B
from bizlens.sources import catalog as CAT
from bizlens.sources import landing as LD
from bizlens.sources import sinks as SK
from bizlens.sources import snapshots as SN
from bizlens.sources.tables import read_table
from bizlens.streaming import ingest

SPEC = {LD.report_key(r): r for r in CAT.REPORTS}
FEES = SPEC["0188"]


def _raw(df: DataFrame, headers: dict[str, str], month: Column) -> DataFrame:
    """Report rows: an expression for each header, and the month of the extract."""
    made = df.select(*[F.expr(e).alias(h) for h, e in headers.items()], month.alias("_dia"))
    return LD.with_month(made, F.col("_dia")).drop("_dia")


def _raw_fees(spark, sf_dir) -> DataFrame:
    return _raw(B.card_fees(spark, sf_dir), QR._C_RAW_COLS, F.col("data_competencia"))


_RAW_FEES_SQL = f"""
SELECT data_competencia, bandeira AS "Bandeira", {QR._C_RAW_COLS['Valor faturado']} AS "Valor faturado",
  {QR._C_RAW_COLS['Valor']} AS "Valor" FROM c"""


def _last_month(spark, sf_dir) -> Column:
    return read_table(spark, sf_dir, "orders", ["o_orderdate"]).select(F.trunc(F.max("o_orderdate"), "MM")).scalar()


# ---------------------------------------------------------------------------------------------- windows and discovery
@register("report_windows", """
WITH o AS (SELECT CAST(o_orderdate AS DATE) AS dia FROM orders),
m AS (SELECT CAST(date_trunc('month', MAX(dia)) AS DATE) AS mes FROM o)
SELECT 'padrao' AS tipo, COUNT(*) AS linhas, MIN(dia) AS primeiro, MAX(dia) AS ultimo FROM o, m WHERE dia BETWEEN mes AND last_day(mes)
UNION ALL
SELECT 'comparacao', COUNT(*), MIN(dia), MAX(dia) FROM o, m WHERE dia BETWEEN CAST(mes - INTERVAL 1 MONTH AS DATE) AND last_day(mes)
UNION ALL
SELECT 'sem_data', COUNT(*), MIN(dia), MAX(dia) FROM o""")
def report_windows(spark, sf_dir):
    """Rows that a report of each kind covers in the newest month: one month, two months, everything."""
    days = read_table(spark, sf_dir, "orders", ["o_orderdate"]).select(F.to_date("o_orderdate").alias("dia"))
    month = _last_month(spark, sf_dir)
    kinds = [LD.apply_window(days, "dia", *LD.report_window(month, kind))
             .agg(F.count(F.lit(1)).alias("linhas"), F.min("dia").alias("primeiro"), F.max("dia").alias("ultimo"))
             .select(F.lit(kind).alias("tipo"), "linhas", "primeiro", "ultimo")
             for kind in ("padrao", "comparacao", "sem_data")]
    return FR.stack(kinds)


@register("landed_months", with_ctes([("c", ""), ("m", QR._ORDER_MONTHS_SQL)], """
SELECT m.data_competencia, m.data_competencia IN (SELECT data_competencia FROM c) AS presente FROM m"""))
def landed_months(spark, sf_dir):
    """Land the card fees, then find each order month among the landing table's own folders, or not."""
    root = shared_path(spark, "landing")
    LD.land(_raw_fees(spark, sf_dir), root, FEES)
    spine = QR._order_months(spark, sf_dir)
    missing = LD.missing_months(spine, LD.landed_months_of(spark, root, FEES))
    return spine.join(missing.withColumn("_falta", F.lit(True)), "data_competencia", "left") \
        .select("data_competencia", F.col("_falta").isNull().alias("presente"))


# ---------------------------------------------------------------------------------------------- stream and sinks
@register("stream_landing", with_ctes([("c", "")], _RAW_FEES_SQL))
def stream_landing(spark, sf_dir):
    """An old delivery with other texts, then a newer one that arrives in two batches: readers see the newer, whole."""
    inbox, root = shared_path(spark, "inbox"), shared_path(spark, "landing")
    raw = _raw_fees(spark, sf_dir)
    for delivery, rows in (("1", raw.withColumn("Bandeira", F.lower("Bandeira"))), ("2", raw.where("Bandeira = 'N'")),
                           ("2", raw.where("Bandeira <> 'N'"))):
        rows.write.mode("append").parquet(f"{inbox}/{delivery}")
        ingest.start_landing(spark, inbox, root, FEES).awaitTermination()
    return LD.read_report(spark, root, FEES)


@register("warehouse_replace", with_ctes([("c", "")], f"""
SELECT data_competencia, bandeira, CAST(valor_faturado AS DOUBLE) AS valor_faturado FROM c
WHERE data_competencia >= CAST(date_trunc('month', (SELECT MAX(data_competencia) FROM c)) - INTERVAL {LD.REFRESH_MONTHS} MONTH AS DATE)"""))
def warehouse_replace(spark, sf_dir):
    """A table laid out by month, replaced by the months of the refresh horizon: the others are gone."""
    c = B.card_fees(spark, sf_dir).select("data_competencia", "bandeira",
                                          F.col("valor_faturado").cast("double").alias("valor_faturado"))
    target = shared_path(spark, "warehouse", "fees")
    SK.replace_if_not_empty(c, target, partition_by=["data_competencia"])
    recent = c.where(LD.refresh_flag(F.col("data_competencia"), c.select(F.max("data_competencia")).scalar()))
    SK.replace_if_not_empty(recent, target, partition_by=["data_competencia"])
    return spark.read.parquet(target)


# ---------------------------------------------------------------------------------------------- ledger streams
_LEDGER_MONEY = {"Caixa": "Valor Pago", "Competencia": "Valor Previsto"}


def _land_ledger(spark, sf_dir, root, rows: DataFrame | None = None) -> None:
    """The two streams of the ledger, each with its own header for the money."""
    g = B.ledger(spark, sf_dir) if rows is None else rows
    for stream, money in _LEDGER_MONEY.items():
        headers = {money if h == "Valor" else h: e for h, e in QR._G_RAW.items()}
        LD.land(_raw(g.where(F.col("tipo") == stream), headers, F.col("data_movimento")), root, SPEC[f"0387_{stream}"])


@register("ledger_alias_columns", with_ctes([("g", "")], QR._L1_SQL))
def ledger_alias_columns(spark, sf_dir):
    """Both ledger streams landed beside the card fees in one root, with alias headers, then unified."""
    root = shared_path(spark, "landing")
    LD.land(_raw_fees(spark, sf_dir), root, FEES)
    _land_ledger(spark, sf_dir, root)
    return PL.transform_report(spark, root, "0387", list(CAT.REPORTS))


# ---------------------------------------------------------------------------------------------- seed
@register("seed_levels", with_ctes([("g", ""), ("s", ""), ("gl", QR.GL_SQL), ("fc", QR.FC_SQL)], """
SELECT nivel_1, nivel_2, excluir_dre, COUNT(*) AS linhas, CAST(SUM(valor) AS DOUBLE) AS valor,
  (SELECT COUNT(*) FROM s) AS linhas_seed
FROM fc GROUP BY 1, 2, 3"""))
def seed_levels(spark, sf_dir):
    """The category seed from CSV to a table, counted and joined to the accrual ledger."""
    csv, target = shared_path(spark, "seed-csv"), shared_path(spark, "warehouse", "tbl_dim_categorias")
    spark.createDataFrame(B.CATEGORY_SEED_ROWS, B.CATEGORY_SEED_SCHEMA).toDF(*CAT.SEED_SCHEMA.names) \
        .write.option("header", True).csv(csv)
    SK.replace(CAT.load_category_seed(spark, csv), target)
    seed = spark.read.parquet(target)
    f = M.int_financeiro_competencia(Warehouse(spark, sf_dir).ledger, seed)
    g = f.groupBy("nivel_1", "nivel_2", "excluir_dre").agg(F.count(F.lit(1)).alias("linhas"),
                                                            F.sum("valor").cast("double").alias("valor"))
    return g.withColumn("linhas_seed", seed.select(F.count(F.lit(1))).scalar())


# ---------------------------------------------------------------------------------------------- whole pipeline
def _land_sales(spark, sf_dir, root, where: Column | None = None, **changed: Column) -> None:
    """The sales lines (those of a condition on their day, with changed columns), dealt by month before they are texts.

    Large ones are first written by month in slices, with their stored columns: the landing replaces its months by one job, which
    then finds the rows in order and shuffles nothing."""
    n, work = B.sales_slice_count(spark, sf_dir, few=where is not None), shared_path(spark, "sales-by-month")
    if n == 1:
        v = B.sales_by_month(spark, sf_dir, "_m", where)
    else:
        stored = [B.stored_by_month(spark, sf_dir, "_m", where, (k, n)) for k in range(n)]
        if not SN.publish(stored, work, ["_m"], dealt=True):
            return
        v = B.from_stored(SN.read(spark, work), "_m")
    LD.land(_raw(v.withColumns(changed), QR._V_RAW, F.col("_m")), root, SPEC["0186"], dealt=True)
    SN.remove(spark, work)


def _land_all(spark, sf_dir, root) -> None:
    """All eight catalogue entries in one landing root."""
    last = _last_month(spark, sf_dir)
    month = F.col("data_competencia")
    plain = {
        "0126": (B.occupancy(spark, sf_dir), {"Profissional": "profissional", "Total Agendado": "total_agendado"}, month),
        "0002": (B.clients(spark, sf_dir), {"Cliente": "cliente", "Celular": "celular", "E-mail": "email",
                                            "Data de Nascimento": "data_nascimento"}, last),
        "0007": (B.returns(spark, sf_dir), {h: f"`{h}`" for h in SPEC["0007"].headers}, last),
        "0229": (B.professionals_master(spark, sf_dir),
                 {"Nome": "nome", "Cargo": "cargo", "CPF": "cpf", "Apelido": "apelido", "Especialidade": "especialidade",
                  "Data Cadastro": "data_cadastro"}, last),
    }
    _land_sales(spark, sf_dir, root)
    for key, (df, headers, day) in plain.items():
        LD.land(_raw(df, headers, day), root, SPEC[key])
    LD.land(_raw_fees(spark, sf_dir), root, FEES)
    _land_ledger(spark, sf_dir, root)


_TABLE_ROWS = {"tbl_0002_clientes": "kc", "tbl_0007_retorno": "r", "tbl_0126_ocupacao": "o", "tbl_0186_comandas": "v",
               "tbl_0188_bandeirascartao": "c", "tbl_0229_profissionais": "pr", "tbl_0387_financeiro": "g"}


@register("pipeline_tables", with_ctes(
    [("v", ""), ("p", ""), ("g", ""), ("c", ""), ("o", ""), ("k", ""), ("r", ""), ("kc", QR.KC_SQL), ("pr", QR.PR_SQL)],
    " UNION ALL ".join(f"SELECT '{t}' AS tabela, 'written' AS situacao, COUNT(*) AS linhas FROM {cte}"
                       for t, cte in _TABLE_ROWS.items())))
def pipeline_tables(spark, sf_dir):
    """All eight catalogue entries landed in one root and run through the batch pipeline: rows of each table."""
    landing, warehouse = shared_path(spark, "landing"), shared_path(spark, "warehouse")
    _land_all(spark, sf_dir, landing)
    runs = PL.run(spark, landing, warehouse)
    status = spark.createDataFrame([(r.table, r.status) for r in runs], "tabela string, situacao string")
    counts = CAT.row_counts({r.table: PL.read_table(spark, warehouse, r.table) for r in runs if r.status == "written"})
    return status.join(counts, "tabela", "left").select("tabela", "situacao", "linhas")


#: Report id -> the raw rows that are landed for it.
_RAW_ROWS = {"0002": "k", "0007": "r", "0126": "o", "0186": "v", "0188": "c", "0229": "p", "0387": "g"}


@register("report_catalogue", with_ctes([(cte, "") for cte in _RAW_ROWS.values()], " UNION ALL ".join(
    f"SELECT '{i}' AS relatorio, CAST({sum(r.report_id == i for r in CAT.REPORTS)} AS BIGINT) AS entradas, "
    f"COUNT(*) AS linhas FROM {cte}" for i, cte in _RAW_ROWS.items())))
def report_catalogue(spark, sf_dir):
    """Each report of the catalogue with its entries and the rows that lie landed under their folders (A1)."""
    root = shared_path(spark, "landing")
    _land_all(spark, sf_dir, root)
    reports = CAT.load_reports()
    rows = CAT.row_counts({f"{r.report_id}/{k}": LD.read_report(spark, root, r) for k, r in enumerate(reports)})
    return rows.groupBy(F.split("tabela", "/")[0].alias("relatorio")).agg(
        F.count(F.lit(1)).alias("entradas"), F.sum("linhas").alias("linhas"))


# ---------------------------------------------------------------------------------------------- incremental runs
_HORIZON_SQL = f"SELECT CAST(date_trunc('month', MAX(o_orderdate)) - INTERVAL {LD.REFRESH_MONTHS} MONTH AS DATE) AS inicio FROM orders"


def _month_sums_sql(table: str, cte: str, day: str, value: str, change: str) -> str:
    return (f"SELECT '{table}' AS tabela, CAST(date_trunc('month', {day}) AS DATE) AS mes, COUNT(*) AS linhas, "
            f"CAST(SUM(CASE WHEN {day} >= inicio THEN {value} {change} ELSE {value} END) AS DOUBLE) AS valor FROM {cte}, h GROUP BY 1, 2")


_CHANGES = {"tbl_0186_comandas": ("v", "data", "valor", "+ 1"), "tbl_0387_financeiro": ("g", "data_movimento", "valor", "- 1"),
            "tbl_0188_bandeirascartao": ("c", "data_competencia", "valor_faturado", "+ 2")}


@register("incremental_run", with_ctes([("v", ""), ("g", ""), ("c", ""), ("h", _HORIZON_SQL)], " UNION ALL ".join(
    _month_sums_sql(t, *change) for t, change in _CHANGES.items())))
def incremental_run(spark, sf_dir):
    """The fact reports landed and run whole, then the months of the refresh horizon landed with other values and run by the
    horizon: the fact tables by month equal a full recomputation (A7, A8, A18)."""
    landing, warehouse = shared_path(spark, "landing"), shared_path(spark, "warehouse")
    reports = [r for r in CAT.REPORTS if CAT.table_name(PL.TABLE_OF[r.report_id]) in _CHANGES]
    _land_sales(spark, sf_dir, landing)
    LD.land(_raw_fees(spark, sf_dir), landing, FEES)
    _land_ledger(spark, sf_dir, landing)
    PL.run(spark, landing, warehouse, reports)
    as_of = _max_day(spark, sf_dir)
    start = F.lit(LD.horizon_start(as_of))
    _land_sales(spark, sf_dir, landing, F.col("data") >= start, valor=(F.col("valor") + 1).cast(B.MONEY))
    g = B.ledger(spark, sf_dir).where(F.col("data_movimento") >= start)
    _land_ledger(spark, sf_dir, landing, g.withColumn("valor", (F.col("valor") - 1).cast(B.MONEY)))
    c = B.card_fees(spark, sf_dir).where(F.col("data_competencia") >= start)
    c = c.withColumn("valor_faturado", F.col("valor_faturado") + 2)
    LD.land(_raw(c, QR._C_RAW_COLS, F.col("data_competencia")), landing, FEES)
    PL.run(spark, landing, warehouse, reports, as_of=as_of)
    return FR.stack([PL.read_table(spark, warehouse, table).groupBy(F.lit(table).alias("tabela"), F.col(M.MONTH_COL).alias("mes"))
                     .agg(F.count(F.lit(1)).alias("linhas"), F.sum(F.col(value).cast("decimal(28,2)")).cast("double").alias("valor"))
                     for table, (_, _, value, _) in _CHANGES.items()])


def _max_day(spark, sf_dir) -> dt.date:
    return read_table(spark, sf_dir, "orders", ["o_orderdate"]).agg(F.max(F.to_date("o_orderdate"))).first()[0]


def _month_after(month: dt.date, k: int) -> dt.date:
    months = month.year * 12 + month.month - 1 + k
    return dt.date(months // 12, months % 12 + 1, 1)


@register("sales_facts_incremental", QR.ORACLE["sales_facts"])
def sales_facts_incremental(spark, sf_dir):
    """The sales fact over first lines kept from run to run: the oldest months arrive late and the newest are corrected,
    then it equals the fact of the whole history (F1, M7)."""
    with freed_shuffles(spark):
        first, last = B.sales_lines(spark, sf_dir, ("data",)).agg(F.min(F.trunc("data", "MM")), F.max(F.trunc("data", "MM"))).first()
    late = F.col(PL.EXTRACT) < F.add_months(F.lit(first), 3)
    corrected = F.col(PL.EXTRACT) > F.add_months(F.lit(last), -3)
    roots = [shared_path(spark, "warehouse", t) for t in (PL.SALES, PL.MONTH_FIRST_LINES, PL.FIRST_LINES)]
    state = {"client": C.md5_key("cliente"), "order": list(B.SALES_ROW_ORDER)}
    whole = ~late & ~(corrected & (F.col("l_linenumber") == 1))  # the newest months lack lines at first
    SN.publish(B.sales_slices(spark, sf_dir, PL.EXTRACT, whole), roots[0], [PL.EXTRACT], dealt=True)
    FP.refresh(spark, *roots, **state)
    # The months that are replaced are known from the bounds; one without lines was not in the table either.
    months = {_month_after(first, k) for k in range(3)} | {_month_after(last, -k) for k in range(3)}
    again = B.sales_slices(spark, sf_dir, PL.EXTRACT, late | corrected, few=True)
    SN.publish_parts(again, roots[0], [PL.EXTRACT], sorted(m.isoformat() for m in months), dealt=True)
    FP.refresh(spark, *roots, **state)
    f = M.fct_vendas(SN.read(spark, roots[0]), B.SALES_ROW_ORDER, firsts=SN.read(spark, roots[2]))
    return f.select(*QR._FV_COLS, *[F.col(c).cast("double").alias(c) for c in QR._FV_MONEY], "is_recorrente")


# ---------------------------------------------------------------------------------------------- registered views
@register("sales_facts_registered", with_ctes([("v", ""), ("fv", QR.FV_SQL)], """
SELECT id_cliente, COUNT(*) AS linhas, CAST(SUM(valor) AS DOUBLE) AS valor, COUNT(*) - 1 AS recorrentes FROM fv GROUP BY id_cliente"""))
def sales_facts_registered(spark, sf_dir):
    """The sales fact of the registered views by client: as many lines as the table, all but one recurrent."""
    M.register_views(spark, Warehouse(spark, sf_dir).tables())
    return spark.table("fct_vendas").groupBy("id_cliente").agg(
        F.count(F.lit(1)).alias("linhas"), F.sum("valor").cast("double").alias("valor"),
        F.count_if("is_recorrente").alias("recorrentes"))


@register("pl_by_group_sql", with_ctes(QR.PL_CTES, f"""
SELECT grupo_metrica, CAST(SUM(valor) AS DOUBLE) AS valor FROM pl WHERE {QR._between('data', QR.CURRENT)} GROUP BY grupo_metrica"""))
def pl_by_group_sql(spark, sf_dir):
    """P&L total per group by SQL with bound dates over the registered view."""
    M.register_views(spark, Warehouse(spark, sf_dir, QR.CURRENT).tables())
    lines = RP.query_period(spark, "rep_financeiro_competencia", "grupo_metrica, valor", *QR.CURRENT)
    return lines.groupBy("grupo_metrica").agg(F.sum("valor").cast("double").alias("valor"))


@register("preview_fees", with_ctes([("c", "")], """
SELECT data_competencia, bandeira, CAST(valor_faturado AS DOUBLE) AS valor_faturado FROM c
ORDER BY data_competencia DESC, bandeira LIMIT 5"""))
def preview_fees(spark, sf_dir):
    """The preview of a registered view: its five newest rows (G7; the limit is the feature)."""
    M.register_views(spark, {"tbl_0188_bandeirascartao": B.card_fees(spark, sf_dir)})
    newest = FR.top_k(spark.table("fct_taxas_cartao"), [F.col("data_competencia").desc(), F.col("bandeira").asc()], 5)
    return newest.select("data_competencia", "bandeira", F.col("valor_faturado").cast("double").alias("valor_faturado"))


@register("calendar_coverage", """
WITH cal AS (SELECT CAST(unnest(generate_series(DATE '2023-01-01', DATE '2030-12-31', INTERVAL 1 DAY)) AS DATE) AS d),
ped AS (SELECT CAST(o_orderdate AS DATE) AS d, COUNT(*) AS n FROM orders GROUP BY 1)
SELECT CAST(year(COALESCE(cal.d, ped.d)) AS BIGINT) AS ano, COUNT(cal.d) AS dias_calendario, COUNT(ped.d) AS dias_com_pedido,
  CAST(COALESCE(SUM(ped.n), 0) AS BIGINT) AS pedidos
FROM cal FULL JOIN ped ON cal.d = ped.d GROUP BY 1""")
def calendar_coverage(spark, sf_dir):
    """The fixed calendar against the order days, by year: days of the calendar, days with orders, orders."""
    cal = M.dim_calendario(spark).select("data")
    days = read_table(spark, sf_dir, "orders", ["o_orderdate"]).groupBy(F.to_date("o_orderdate").alias("dia")) \
        .agg(F.count(F.lit(1)).alias("n"))
    both = cal.join(days, F.col("data") == F.col("dia"), "full")
    return both.groupBy(F.year(F.coalesce("data", "dia")).cast("bigint").alias("ano")).agg(
        F.count("data").alias("dias_calendario"), F.count("dia").alias("dias_com_pedido"),
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("pedidos"))
