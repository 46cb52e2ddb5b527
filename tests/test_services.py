"""Lifecycle numbers, resolved members, persistent views, SQL functions, slices, typed times, period errors."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from bizlens.functions import cleaning as C
from bizlens.functions import formatting as K
from bizlens.functions import sql as FS
from bizlens.operators import lifecycle as LC
from bizlens.operators import reports as RP
from bizlens.operators.slices import Slices
from bizlens.plans import model as M
from bizlens.plans import pipeline as PL
from bizlens.plans import service_queries as SQ
from bizlens.plans import transforms as T
from bizlens.plans import views as V
from bizlens.plans.warehouse import Warehouse
from bizlens.session import shared_path
from bizlens.sources import snapshots as SN
from tests.conftest import col_values

FEB = (dt.date(2024, 2, 1), dt.date(2024, 2, 29))


def visits(spark, rows):
    return spark.createDataFrame([(dt.date(2024, m, d), t, c, Decimal(v)) for m, d, t, c, v in rows],
                                 "data date, id_comanda string, id_cliente string, valor decimal(18,2)")


VISITS = [(1, 20, "t1", "a", 10), (2, 5, "t2", "a", 20), (2, 5, "t2", "a", 5), (2, 7, "t3", "b", 30), (1, 25, "t4", "c", 40),
          (2, 9, "t5", None, 50), (2, 9, "t6", "u", 60), (2, 10, "t7", "d", -1), (1, 4, "t8", "d", 7)]


def test_lifecycle(spark):
    facts = visits(spark, VISITS)
    got = {r["periodo"]: tuple(r[c] for c in ("clientes_ativos", "novos_clientes", "novos_pct"))
           for r in LC.new_clients(spark, facts, *FEB, unknown=("u",)).collect()}
    assert got == {"atual": (2, 1, 50.0), "anterior": (3, 3, 100.0), "ano_anterior": (0, 0, 0.0)}
    lost = LC.churned_clients(facts, *FEB, unknown=("u",)).orderBy("id_cliente").collect()
    assert [tuple(r) for r in lost] == [("c", 1, 40.0, dt.date(2024, 1, 25)), ("d", 1, 7.0, dt.date(2024, 1, 4))]
    row = LC.churn(facts, *FEB, unknown=("u",)).first()
    assert (row["clientes_anteriores"], row["clientes_perdidos"], row["valor_perdido"]) == (3, 2, 47.0)
    assert abs(row["churn_pct"] - 200 / 3) < 1e-9
    rank = [(r["id_cliente"], r["visitas"], r["valor"]) for r in LC.client_ranking(facts, *FEB, k=2).collect()]
    assert rank == [("u", 1, 60.0), ("b", 1, 30.0)]
    empty = (dt.date(2020, 1, 1), dt.date(2020, 1, 31))
    assert LC.client_ranking(facts, *empty).count() == 0 and LC.churned_clients(facts, *empty).count() == 0
    assert LC.churn(facts, *empty).first()["churn_pct"] == 0.0
    assert [r["novos_clientes"] for r in LC.new_clients(spark, facts, *empty).collect()] == [0, 0, 0]


def test_lifecycle_from_kept_first_lines(spark):
    facts = visits(spark, VISITS).where("valor > 0")
    firsts = facts.groupBy("id_cliente").agg(F.min("data").alias("data"))
    some = LC.new_clients(spark, facts, *FEB, firsts=firsts)
    assert some.collect() == LC.new_clients(spark, facts, *FEB).collect()


def test_lifecycle_has_no_self_join(spark, small_dir):
    plan = SQ.churned_clients(spark, small_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("lineitem") <= 1 and plan.count("l_extendedprice") > 0 and "LeftAnti" not in plan


NAMES = [None, "", "  ", "nan", "None", "NAO IDENTIFICADO", " não identificado. ", "Não Informado", "Desconhecido", "Ana", " ana. ", "ANA", "Bia S."]


def test_member_keys(spark):
    keys = col_values(spark, C.member_key, NAMES)
    assert keys[:9] == ["UNKNOWN"] * 9 and keys[9] == keys[10] == keys[11] != keys[12] and "UNKNOWN" not in keys[9:]
    listed = spark.createDataFrame([("ANA", "a@b"), ("NAO IDENTIFICADO", "x"), (None, "y"), ("CEU", "c@d")], "cliente string, email string")
    fact = spark.createDataFrame([(n,) for n in NAMES], "cliente string")
    dim = M.resolved_members(listed, "cliente", [fact])
    got = {r["id_membro"]: (r["cliente"], r["email"]) for r in dim.collect()}
    assert dim.count() == len(got) == 4
    assert got["UNKNOWN"] == ("NAO IDENTIFICADO", None) and got[keys[9]] == ("ANA", "a@b") and got[keys[12]] == ("BIA S", None)
    assert M.with_member_key(fact, "cliente", "k").join(dim, F.col("k") == F.col("id_membro"), "left_anti").count() == 0


def test_persistent_views_equal_the_builders(spark, small_dir):
    root = shared_path(spark, "t-views")
    SQ.publish_warehouse(spark, small_dir, root)
    seed = Warehouse(spark, small_dir).seed
    try:
        tables = PL.register_tables(spark, root, "bizlens_t_views", seed)
        spark.sql("CREATE OR REPLACE VIEW vw_fato_vendas AS SELECT 1 AS x")             # a name of the former layer
        made = V.create_views(spark, tables)
        assert set(made) == set(V.VIEWS) and not spark.catalog.tableExists("bizlens_t_views.vw_fato_vendas")
        assert made.index("fct_taxas_cartao") < made.index("rep_financeiro_competencia")
        assert V.create_views(spark, tables) == made                                    # again, over themselves
        # without a table: its views and those that read them are left out
        few = V.ordered(V.VIEWS, set(tables) - {"tbl_0188_bandeirascartao"})
        assert "rep_financeiro_competencia" not in few and "fct_vendas" in few
    finally:
        spark.catalog.setCurrentDatabase("default")
    other = spark.newSession()
    built = PL.publish_views(spark, root, seed)
    assert set(V.VIEWS) - set(built) == {"int_primeiras_linhas"}
    for name, df in built.items():
        view = other.table(f"bizlens_t_views.{name}")
        columns = sorted(df.columns)
        assert sorted(view.columns) == columns, name
        rows = lambda d: sorted(map(repr, d.select(*columns).collect()))  # noqa: E731, B023
        assert rows(view) == rows(df), name
    jan = other.table("bizlens_t_views.fct_vendas").where("_mes = DATE '1998-01-01'")
    assert "PartitionFilters: [isnotnull(_mes" in jan._jdf.queryExecution().executedPlan().toString()


SQL_VALUES = ["R$ 1.234,56", "(10,5)", " x ", "12:30", "1:xx", "2,5%", None, "", " Maria D'Ávila..", "nan", "A@B.com ", "(11) 98888-7777",
              "31/12/2020", "32/1/2020", "5/1/2020", "DESCONHECIDO", " ana+bia \x1c", "1.5", "'\\", "9.9.9", "25:99:00", " (3) "]


@pytest.mark.parametrize("name", ["title_case", "clean_currency", "clean_date", "hours_decimal", "clean_phone", "clean_email",
                                  "clean_name", "member_key", "py_strip"])
def test_sql_functions_equal_the_builders(spark, name):
    assert name in FS.register_sql(spark)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(SQL_VALUES)], "i int, x string")
    by_sql = [r[0] for r in spark.sql(f"SELECT {name}(x) AS o, i FROM {{t}} ORDER BY i", t=df).collect()]
    assert by_sql == col_values(spark, getattr(C, name), SQL_VALUES)


def test_currency_text_in_sql(spark):
    FS.register_sql(spark)
    df = spark.createDataFrame([(float(v),) for v in ("1234.565", "-0.5", "0", "nan", "-1234567.891")] + [(None,)], "v double")
    got = df.selectExpr("v", "format_currency(v) AS a").select("a", K.format_currency("v").alias("b")).collect()
    assert [r["a"] for r in got] == [r["b"] for r in got]
    plan = df.selectExpr("format_currency(v) AS a")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_slices_are_shared_and_forgotten(spark):
    root = shared_path(spark, "t-slices")
    lines = spark.createDataFrame([(dt.date(2024, 2, d), d) for d in range(1, 20)], "data date, v int")
    SN.publish(lines, root)
    slices, built = Slices(most=2), []

    def table():
        built.append(1)
        return SN.read(spark, root)

    def ask(period=FEB):
        return slices.get("t", SN.version(spark, root), table, *period)

    one, two = ask().agg(F.sum("v")), ask().groupBy("v").count()
    for out in (one, two):
        assert "InMemoryTableScan" in out._jdf.queryExecution().executedPlan().toString()
    assert len(built) == 1 and one.first()[0] == 190 and two.count() == 19
    held = ask()
    SN.publish(lines.withColumn("v", F.col("v") * 2), root)                        # a new version: built anew, the old one freed
    assert ask().agg(F.sum("v")).first()[0] == 380 and len(built) == 2
    assert not held.storageLevel.useMemory
    ask((dt.date(2024, 2, 1), dt.date(2024, 2, 2)))
    ask((dt.date(2024, 2, 1), dt.date(2024, 2, 3)))                                # beyond the most: the oldest goes
    assert len(slices._held) == 2 and slices.clear("other") == 0 and slices.clear("t") == 2


def test_typed_hours(spark):
    t = [dt.datetime(2024, 1, 1, 8, 30), dt.datetime(2024, 1, 1, 0, 0, 59), None]
    assert col_values(spark, lambda c: C.hours_decimal(c, "timestamp"), t, "timestamp") == [8.5, 0.0, 0.0]
    assert col_values(spark, lambda c: C.hours_decimal(c, "double"), [1.5, float("nan"), None], "double") == [1.5, 0.0, 0.0]
    raw = spark.createDataFrame([(dt.date(2024, 1, 1), "ana", t[0])], "data_competencia date, Profissional string, `Total Agendado` timestamp")
    assert T.occupancy(raw).first()["horas_agendadas_decimal"] == 8.5
    assert col_values(spark, lambda c: K.format_percentage(c, 2), [None, 0.5], "double") == ["0,0%", "50,00%"]


def test_period_errors(spark):
    spark.createDataFrame([(dt.date(2024, 2, 3), "x", "7")], "data date, g string, v string").createOrReplaceTempView("t_period")
    good = RP.period_result(spark, "t_period", "g string, v int", *FEB)
    assert good.error is None and good.df.collect() == [("x", 7)]
    for view, schema in (("t_nope", "g string, v int"), ("t_period", "g string, w int")):
        bad = RP.period_result(spark, view, schema, *FEB)
        assert bad.error and bad.df.count() == 0 and ", ".join(f"{n} {t}" for n, t in bad.df.dtypes) == schema
    late = RP.period_result(spark, "t_period", "g int", *FEB, run=True)            # 'x' is no number: fails in the rows
    assert late.error and late.df.count() == 0


def test_flagged_categories(spark):
    ledger = spark.createDataFrame([(dt.date(2024, 1, 1), "Competencia", "A", None, None, None, Decimal(5)),
                                    (dt.date(2024, 1, 1), "Competencia", "B", None, None, None, Decimal(7))],
                                   "data_movimento date, tipo string, categoria string, titulo string, fornecedor_cliente string, "
                                   "observacoes string, valor decimal(18,2)")
    seed = spark.createDataFrame([("A", M.LEVEL_REVENUE, "x", True), ("B", M.LEVEL_REVENUE, "x", None)],
                                 "categoria string, nivel_1 string, nivel_2 string, excluir_dre boolean")
    sales = spark.createDataFrame([], "data date, comissao decimal(18,2), comanda int, profissional string")
    fees = spark.createDataFrame([], M.FEE_FACT_SCHEMA)
    values = lambda **k: sorted(float(r["valor"]) for r in M.rep_financeiro_competencia(ledger, seed, sales, fees, **k).collect())
    assert values() == [5.0, 7.0] and values(exclude_flagged=True) == [7.0]
