"""Registered queries of client lifecycle, resolved members, persistent views, SQL functions, shared slices and typed inputs.

They add to the registry of ``plans.queries``. What a query writes goes to fresh folders under the shared work folder.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bizlens.functions import cleaning as C
from bizlens.functions import sql as FS
from bizlens.operators import frames as FR
from bizlens.operators import lifecycle as LC
from bizlens.operators import metrics as MT
from bizlens.operators import quality as QC
from bizlens.operators import reports as RP
from bizlens.operators.slices import Slices
from bizlens.plans import first_purchase as FP
from bizlens.plans import model as M
from bizlens.plans import pipeline as PL
from bizlens.plans import queries as QR
from bizlens.plans import sqlfrag as Q
from bizlens.plans import transforms as T
from bizlens.plans import views as V
from bizlens.plans.oracle_bindings import with_ctes
from bizlens.plans.queries import CURRENT, MONTHLY_RANGE, register
from bizlens.plans.warehouse import Warehouse
from bizlens.session import shared_path
from bizlens.sources import bindings as B
from bizlens.sources import dirty as X
from bizlens.sources import snapshots as SN
from bizlens.sources.tables import read_table

# ---------------------------------------------------------------------------------------------- client lifecycle
_VISITS_SQL = "SELECT id_cliente, id_comanda, data, valor FROM fv WHERE valor > 0 AND id_cliente IS NOT NULL"
_LIFE_CTES = [("v", ""), ("fv", QR.FV_SQL), ("periods", Q.periods_values(*CURRENT)), ("vis", _VISITS_SQL),
              ("pri", "SELECT id_cliente, MIN(data) AS primeira FROM vis GROUP BY 1")]


def _client_lines(spark, sf_dir) -> DataFrame:
    return Warehouse(spark, sf_dir).sales_slice("data", "comanda", "cliente", "valor")


@register("new_clients", with_ctes([*_LIFE_CTES,
    ("atv", "SELECT p.periodo, COUNT(DISTINCT id_cliente) AS n FROM periods p JOIN vis ON data BETWEEN inicio AND fim GROUP BY 1"),
    ("nv", "SELECT p.periodo, COUNT(*) AS n FROM periods p JOIN pri ON primeira BETWEEN inicio AND fim GROUP BY 1")], """
SELECT CAST(p.ordem AS BIGINT) AS ordem, p.periodo, p.inicio, p.fim, COALESCE(atv.n, 0) AS clientes_ativos,
  COALESCE(nv.n, 0) AS novos_clientes,
  CASE WHEN atv.n > 0 THEN CAST(COALESCE(nv.n, 0) AS DOUBLE) / CAST(atv.n AS DOUBLE) * 100.0 ELSE 0.0 END AS novos_pct
FROM periods p LEFT JOIN atv USING (periodo) LEFT JOIN nv USING (periodo)"""))
def new_clients(spark, sf_dir):
    """Clients with a visit and clients with their first one, for the current, previous and year-ago periods."""
    out = LC.new_clients(spark, _client_lines(spark, sf_dir), *CURRENT)
    return out.withColumn("ordem", F.col("ordem").cast("bigint"))


_CHURN_CTES = [*_LIFE_CTES,
    ("agora", "SELECT DISTINCT id_cliente FROM vis JOIN periods ON data BETWEEN inicio AND fim WHERE periodo = 'atual'"),
    ("antes", "SELECT id_cliente, COUNT(DISTINCT id_comanda) AS visitas, SUM(valor) AS valor, MAX(data) AS ultima_visita "
              "FROM vis JOIN periods ON data BETWEEN inicio AND fim WHERE periodo = 'anterior' GROUP BY 1"),
    ("perd", "SELECT * FROM antes WHERE id_cliente NOT IN (SELECT id_cliente FROM agora)")]


@register("churned_clients", with_ctes(_CHURN_CTES,
                                       "SELECT id_cliente, visitas, CAST(valor AS DOUBLE) AS valor, ultima_visita FROM perd"))
def churned_clients(spark, sf_dir):
    """Clients of the previous period without a visit in the current one."""
    return LC.churned_clients(_client_lines(spark, sf_dir), *CURRENT)


@register("churn_rate", with_ctes(_CHURN_CTES, """
SELECT (SELECT COUNT(*) FROM antes) AS clientes_anteriores, COUNT(*) AS clientes_perdidos,
  CAST(COALESCE(SUM(valor), 0) AS DOUBLE) AS valor_perdido,
  CASE WHEN (SELECT COUNT(*) FROM antes) > 0 THEN CAST(COUNT(*) AS DOUBLE) / CAST((SELECT COUNT(*) FROM antes) AS DOUBLE) * 100.0
       ELSE 0.0 END AS churn_pct FROM perd"""))
def churn_rate(spark, sf_dir):
    """Share of the previous period's clients that did not come back, and the revenue they had brought."""
    return LC.churn(_client_lines(spark, sf_dir), *CURRENT)


@register("client_ranking", with_ctes([("v", ""), ("fv", QR.FV_SQL), ("vis", _VISITS_SQL)], f"""
SELECT id_cliente, COUNT(DISTINCT id_comanda) FILTER (no) AS visitas, CAST(SUM(valor) FILTER (no) AS DOUBLE) AS valor,
  MIN(data) AS primeira, MAX(data) FILTER (no) AS ultima_visita
FROM (SELECT *, {QR._between('data', MONTHLY_RANGE)} AS no FROM vis) GROUP BY 1 HAVING COUNT(*) FILTER (no) > 0
ORDER BY visitas DESC, SUM(valor) FILTER (no) DESC, id_cliente LIMIT 10"""))
def client_ranking(spark, sf_dir):
    """The ten clients with most visits in a year (J10; the limit is the feature)."""
    return LC.client_ranking(_client_lines(spark, sf_dir), *MONTHLY_RANGE)


# ---------------------------------------------------------------------------------------------- resolved members
def _member_sql(x: str) -> str:
    name = f"trim(regexp_replace(upper(trim({x})), '\\.+$', ''))"
    return f"CASE WHEN {x} IS NULL OR {name} IN ({', '.join(repr(n) for n in C.UNKNOWN_NAMES)}) THEN 'UNKNOWN' ELSE md5({name}) END"


_ORPHANS_SQL = """
SELECT '{name}' AS checagem, COUNT(DISTINCT k) FILTER (k NOT IN (SELECT k FROM {dim})) AS valor, COUNT(*) AS linhas,
  COUNT(*) FILTER (k NOT IN (SELECT k FROM {dim})) = 0 AS ok FROM (SELECT {key} AS k FROM {fact})"""
_UNKNOWN_SQL = ("SELECT '{name}' AS checagem, COUNT(*) FILTER (k = 'UNKNOWN') AS valor, COUNT(*) AS linhas, "
                "COUNT(*) FILTER (k = 'UNKNOWN') = 1 AS ok FROM {dim}")


@register("resolved_members", with_ctes(
    [("v", ""), ("k", ""), ("kc", QR.KC_SQL), ("p", ""), ("pr", QR.PR_SQL), ("o", ""), ("oc", QR._OC_SQL),
     ("dc", f"SELECT {_member_sql('cliente')} AS k FROM kc UNION SELECT {_member_sql('cliente')} FROM v UNION SELECT 'UNKNOWN'"),
     ("dpr", f"SELECT {_member_sql('nome')} AS k FROM pr UNION SELECT {_member_sql('profissional')} FROM v "
             f"UNION SELECT {_member_sql('profissional')} FROM oc UNION SELECT 'UNKNOWN'")],
    " UNION ALL ".join([
        _ORPHANS_SQL.format(name="vendas_clientes", key=_member_sql("cliente"), fact="v", dim="dc"),
        _ORPHANS_SQL.format(name="vendas_profissionais", key=_member_sql("profissional"), fact="v", dim="dpr"),
        _ORPHANS_SQL.format(name="ocupacao_profissionais", key=_member_sql("profissional"), fact="oc", dim="dpr"),
        _UNKNOWN_SQL.format(name="clientes", dim="dc"), _UNKNOWN_SQL.format(name="profissionais", dim="dpr")])))
def resolved_members(spark, sf_dir):
    """Dimensions and facts keyed by one resolver: no orphan in any fact, one unknown row per dimension."""
    w = Warehouse(spark, sf_dir)

    def kept(df: DataFrame) -> DataFrame:  # names and members are read by several checks: made once
        path = shared_path(spark, "members")
        df.write.parquet(path)
        return spark.read.parquet(path)

    def counted(df: DataFrame, name: str) -> DataFrame:  # names are few beside lines
        return kept(df.groupBy(name).agg(F.count(F.lit(1)).alias("linhas")))

    buyers, sellers = counted(w.sales_lines("cliente"), "cliente"), counted(w.sales_lines("profissional"), "profissional")
    booked = counted(w.occupancy, "profissional")
    clients = kept(M.resolved_members(w.clients.drop("id_cliente"), "cliente", [buyers]))
    people = kept(M.resolved_members(w.professionals.drop("id_profissional").withColumnRenamed("nome", "profissional"),
                                     "profissional", [sellers, booked]))
    orphans = [QC.orphan_keys(fact, C.member_key(name), dim, "id_membro", check, weight="linhas")
               .select("checagem", F.col("chaves_orfas").alias("valor"), "linhas", "ok")
               for fact, name, dim, check in ((buyers, "cliente", clients, "vendas_clientes"),
                                              (sellers, "profissional", people, "vendas_profissionais"),
                                              (booked, "profissional", people, "ocupacao_profissionais"))]
    unknown = [dim.agg(F.count_if(F.col("id_membro") == C.UNKNOWN_KEY).alias("valor"), F.count(F.lit(1)).alias("linhas"))
               .select(F.lit(name).alias("checagem"), "valor", "linhas", (F.col("valor") == 1).alias("ok"))
               for name, dim in (("clientes", clients), ("profissionais", people))]
    return FR.stack([*orphans, *unknown])


# ---------------------------------------------------------------------------------------------- persistent views
DATABASE = "bizlens_views"


def publish_warehouse(spark, sf_dir: str, root: str) -> None:
    """The warehouse tables of a scale directory as snapshots, facts by month, with the clients' first lines."""
    w = Warehouse(spark, sf_dir)
    # the lines' own order (their numbers repeat) as the place in a file
    place = [F.lpad(c.cast("bigint").cast("string"), 15, "0") for c in (
        F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey"), F.col("valor") * 100)]
    sales = [part.withColumns({"_arquivo": F.concat(*place), "_linha": F.lit(0).cast("bigint")})
             for part in B.sales_slices(spark, sf_dir, PL.EXTRACT)]
    tables = {"tbl_0186_comandas": (sales, "data"), "tbl_0387_financeiro": (w.ledger, "data_movimento"),
              "tbl_0188_bandeirascartao": (w.card_fees, "data_competencia"), "tbl_0126_ocupacao": (w.occupancy, "data_competencia"),
              "tbl_0229_profissionais": (w.professionals, None), "tbl_0002_clientes": (w.clients, None)}
    for name, (made, day) in tables.items():
        frames = made if isinstance(made, list) else [made]
        if day:
            frames = [df.withColumns({PL.EXTRACT: F.trunc(day, "MM"), M.MONTH_COL: F.trunc(day, "MM")}) for df in frames]
        SN.publish(frames, f"{root}/{name}", PL.PARTITIONS if day else None, dealt=name == PL.SALES)
    FP.refresh(spark, *[f"{root}/{t}" for t in (PL.SALES, PL.MONTH_FIRST_LINES, PL.FIRST_LINES)],
               client=C.md5_key("cliente"), order=PL.SALES_ORDER)


@register("pl_persistent_views", with_ctes([*QR.PL_CTES, ("fv", QR.FV_SQL)], """
SELECT grupo_metrica AS chave, COUNT(*) AS linhas, CAST(SUM(valor) AS DOUBLE) AS valor FROM pl GROUP BY 1
UNION ALL SELECT 'recorrentes', COUNT(*), CAST(SUM(valor) AS DOUBLE) FROM fv WHERE is_recorrente
UNION ALL SELECT 'clientes', COUNT(DISTINCT id_cliente), 0.0 FROM fv"""))
def pl_persistent_views(spark, sf_dir):
    """Warehouse tables as external catalog tables, the view layer created over them as persistent views in order of
    dependency, and the P&L and the sales fact read by name (A15, A19, M10, M7)."""
    root, before = shared_path(spark, "warehouse"), spark.catalog.currentDatabase()
    publish_warehouse(spark, sf_dir, root)
    try:
        made = V.create_views(spark, PL.register_tables(spark, root, DATABASE, Warehouse(spark, sf_dir).seed))
    finally:
        spark.catalog.setCurrentDatabase(before)
    if set(made) != set(V.VIEWS):
        raise ValueError(f"views left out: {sorted(set(V.VIEWS) - set(made))}")
    pl, sales = spark.table(f"{DATABASE}.rep_financeiro_competencia"), spark.table(f"{DATABASE}.fct_vendas")
    total = [F.count(F.lit(1)).alias("linhas"), F.sum("valor").cast("double").alias("valor")]
    return FR.stack([
        pl.groupBy(F.col("grupo_metrica").alias("chave")).agg(*total),
        sales.where("is_recorrente").agg(*total).select(F.lit("recorrentes").alias("chave"), "linhas", "valor"),
        sales.agg(F.count_distinct("id_cliente").alias("linhas")).select(F.lit("clientes").alias("chave"), "linhas",
                                                                         F.lit(0.0).alias("valor"))])


# ---------------------------------------------------------------------------------------------- SQL functions
@register("lines_by_sql_functions", f"""
SELECT l_orderkey, l_linenumber, {Q.clean_currency('moeda')} AS valor, {Q.clean_date('dia')} AS data, {Q.hours_decimal('hora')} AS horas,
  {Q.currency('l_extendedprice')} AS texto
FROM (SELECT *, {X.CURRENCY_RAW} AS moeda, {X.DATE_RAW} AS dia, {X.HOURS_RAW} AS hora FROM lineitem)""")
def lines_by_sql_functions(spark, sf_dir):
    """Money, dates, hours and currency text of every line, cleaned by SQL alone."""
    FS.register_sql(spark)
    return spark.sql(f"""
SELECT l_orderkey, l_linenumber, clean_currency(moeda) AS valor, clean_date(dia) AS data, hours_decimal(hora) AS horas,
  format_currency(CAST(l_extendedprice AS DOUBLE)) AS texto
FROM (SELECT *, {X.CURRENCY_RAW} AS moeda, {X.DATE_RAW} AS dia, {X.HOURS_RAW} AS hora FROM {{lineitem}})""",
                     lineitem=read_table(spark, sf_dir, "lineitem"))


@register("clients_by_sql_functions", f"""
SELECT c_custkey, {Q.clean_phone('fone')} AS celular, {Q.clean_email('mail')} AS email, {Q.clean_name('nome')} AS cliente,
  {Q.title('nome')} AS titulo, {_member_sql('nome')} AS id_membro
FROM (SELECT *, {X.PHONE_RAW} AS fone, {X.EMAIL_RAW} AS mail, {X.NAME_RAW} AS nome FROM customer)""")
def clients_by_sql_functions(spark, sf_dir):
    """Phones, e-mails, names, titles and member keys of every client, cleaned by SQL alone."""
    FS.register_sql(spark)
    return spark.sql(f"""
SELECT c_custkey, clean_phone(fone) AS celular, clean_email(mail) AS email, clean_name(nome) AS cliente, title_case(nome) AS titulo,
  member_key(nome) AS id_membro
FROM (SELECT *, {X.PHONE_RAW} AS fone, {X.EMAIL_RAW} AS mail, {X.NAME_RAW} AS nome FROM {{customer}})""",
                     customer=read_table(spark, sf_dir, "customer"))


# ---------------------------------------------------------------------------------------------- shared slices
@register("report_from_slices", with_ctes([*QR.PL_CTES, ("x", f"SELECT * FROM pl WHERE {QR._between('data', CURRENT)}")], f"""
SELECT 'grupo' AS saida, grupo_metrica AS chave, CAST(SUM(2 * valor) AS DOUBLE) AS valor FROM x GROUP BY 2
UNION ALL
SELECT * FROM (SELECT 'despesa', categoria_detalhada, CAST(SUM(abs(2 * valor)) AS DOUBLE) AS v FROM x
  WHERE valor < 0 AND categoria_detalhada IS NOT NULL
  AND NOT COALESCE(grupo_metrica IN ({', '.join(f"'{g}'" for g in RP.EXCLUDED_EXPENSE_GROUPS)}), false)
  GROUP BY 2 ORDER BY v DESC, 2 LIMIT {RP.TOP_N})"""))
def report_from_slices(spark, sf_dir):
    """Two outputs of one request from one slice of the P&L; the table's month is then published with doubled values, the slice
    is forgotten, and the outputs are the new ones (A21)."""
    root, out = shared_path(spark, "warehouse", "pl"), shared_path(spark, "report")
    pl = Warehouse(spark, sf_dir, CURRENT).pl.withColumn(M.MONTH_COL, F.trunc("data", "MM"))
    slices = Slices()

    def report() -> DataFrame:
        x = slices.get("pl", SN.version(spark, root), lambda: SN.read(spark, root), *CURRENT)
        groups = x.groupBy(F.col("grupo_metrica").alias("chave")).agg(F.sum("valor").cast("double").alias("valor"))
        top = RP.top_expenses(RP.pl_current_columns(x))
        return FR.stack([groups.select(F.lit("grupo").alias("saida"), "chave", "valor"),
                         top.select(F.lit("despesa").alias("saida"), F.col("categoria").alias("chave"),
                                    F.col("valor_abs").alias("valor"))])

    SN.publish(pl, root, [M.MONTH_COL])
    SN.publish(report(), out)
    month = CURRENT[0].replace(day=1)
    SN.publish_parts(pl.where(F.col(M.MONTH_COL) == F.lit(month)).withColumn("valor", (F.col("valor") * 2).cast(M.PL_VALUE)),
                     root, [M.MONTH_COL], [month.isoformat()])
    SN.publish(report(), out)
    slices.clear()
    return SN.read(spark, out)


# ---------------------------------------------------------------------------------------------- flags, errors, typed times
@register("pl_without_flagged", with_ctes([("v", ""), ("g", ""), ("s", ""), ("c", ""), ("gl", QR.GL_SQL),
    ("fc", QR.FC_SQL + " AND NOT COALESCE(excluir_dre, false)"), ("pl", QR.PL_SQL)], """
SELECT grupo_metrica, COUNT(*) AS linhas, CAST(SUM(valor) AS DOUBLE) AS valor FROM pl GROUP BY 1"""))
def pl_without_flagged(spark, sf_dir):
    """P&L per group without the categories flagged to stay out."""
    w = Warehouse(spark, sf_dir)
    commissions = w.sales_slice("data", "comanda", "profissional", "comissao")
    pl = M.rep_financeiro_competencia(w.ledger, w.seed, commissions, w.card_fee_fact, exclude_flagged=True)
    return pl.groupBy("grupo_metrica").agg(F.count(F.lit(1)).alias("linhas"), F.sum("valor").cast("double").alias("valor"))


@register("period_query_errors", with_ctes(QR.PL_CTES, f"""
SELECT 'certa' AS consulta, COUNT(*) AS linhas, false AS falhou FROM pl WHERE {QR._between('data', CURRENT)}
UNION ALL SELECT 'sem_visao', 0, true UNION ALL SELECT 'sem_coluna', 0, true"""))
def period_query_errors(spark, sf_dir):
    """Period queries that work, lack their view and lack a column: rows, or a typed empty frame with the error."""
    M.register_views(spark, Warehouse(spark, sf_dir, CURRENT).tables())
    asked = {"certa": ("rep_financeiro_competencia", "grupo_metrica string, valor decimal(38,4)"),
             "sem_visao": ("vw_competencia", "grupo_metrica string, valor decimal(38,4)"),
             "sem_coluna": ("rep_financeiro_competencia", "grupo string")}
    out = []
    for name, (view, schema) in asked.items():
        result = RP.period_result(spark, view, schema, *CURRENT)
        out.append(result.df.agg(F.count(F.lit(1)).alias("linhas")).select(
            F.lit(name).alias("consulta"), "linhas", F.lit(result.error is not None).alias("falhou")))
    return FR.stack(out)


_TIMES = "timestampadd(MINUTE, CAST(o_orderkey % 1500 AS INT), CAST(o_orderdate AS TIMESTAMP))"


@register("occupancy_typed_times", """
SELECT CAST(date_trunc('month', t) AS DATE) AS data_competencia, o_orderpriority AS profissional,
  CAST(hour(t) AS DOUBLE) + CAST(minute(t) AS DOUBLE) / 60.0 AS horas_agendadas_decimal
FROM (SELECT *, CAST(o_orderdate AS TIMESTAMP) + to_minutes(CAST(o_orderkey % 1500 AS INTEGER)) AS t FROM orders)""".replace(
    "o_orderpriority AS profissional", f"{Q.title('o_orderpriority')} AS profissional"))
def occupancy_typed_times(spark, sf_dir):
    """The occupancy transform over booked times that arrive as timestamps, one per order."""
    raw = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_orderdate", "o_orderpriority"]).select(
        F.expr(_TIMES).alias("Total Agendado"), F.col("o_orderpriority").alias("Profissional"))
    return T.occupancy(raw.withColumn("data_competencia", F.to_date(F.trunc("Total Agendado", "MM"))))


# ---------------------------------------------------------------------------------------------- headers, periods without data (B1, H7)
#: Raw headers of the sales and card reports over the line items, with the names they become.
_HEADERS = {"l_orderkey": ("Comanda", "comanda"), "l_quantity": ("Qtd.", "qtd"), "l_extendedprice": ("Valor faturado", "valor_faturado"),
            "l_discount": ("Comissão (%)", "comissao"), "l_tax": ("Taxa de Ocupação (%)", "taxa_de_ocupacao"),
            "l_returnflag": ("Fornecedor/Cliente", "fornecedor_cliente"), "l_linestatus": (" E-mail ", "e_mail"),
            "l_shipdate": ("Última  Visita", "ultima_visita"), "l_linenumber": ("Líquido - Nº", "liquido_no")}


@register("clean_column_names", "SELECT " + ", ".join(
    f"COUNT(DISTINCT {c}) AS {name}" for c, (_, name) in _HEADERS.items()) + " FROM lineitem")
def clean_column_names(spark, sf_dir):
    """Distinct values of every column under its cleaned header, as the reports spell the headers (B1)."""
    raw = read_table(spark, sf_dir, "lineitem", list(_HEADERS)).toDF(*[header for header, _ in _HEADERS.values()])
    df = C.sanitize_columns(raw)
    # Two steps, so that no line is replicated per distinct aggregate: the values of each column once, then their number.
    values = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("coluna"), F.col(c).cast("string").alias("v"))
                                           for c in df.columns])).alias("x")).select("x.*").where("v IS NOT NULL").distinct()
    counts = values.groupBy("coluna").agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(*[F.coalesce(F.sum(F.when(F.col("coluna") == c, F.col("n"))), F.lit(0)).alias(c) for c in df.columns])


#: A period that lies beyond the data, as do the one before and the one a year ago.
_WITHOUT_DATA = (dt.date(2050, 3, 1), dt.date(2050, 3, 31))


@register("empty_period_kpis", with_ctes([c if c[0] != "periods" else ("periods", Q.periods_values(*_WITHOUT_DATA))
                                          for c in QR.SALES_KPI_CTES], "SELECT * FROM k"))
def empty_period_kpis(spark, sf_dir):
    """Sales KPIs of periods without any line: a row per period with zeros (H7)."""
    w = Warehouse(spark, sf_dir)
    return MT.sales_kpis(spark, w.sales_slice("data", "comanda", "cliente", "valor"), *_WITHOUT_DATA)
