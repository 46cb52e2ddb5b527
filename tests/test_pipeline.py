"""End-to-end batch pipeline over a landing zone, view registration, seed loading, parameterised SQL."""

import datetime as dt

from pyspark.sql import functions as F

from bizlens.functions import dates as D
from bizlens.operators import metrics as MT
from bizlens.operators import reports as RP
from bizlens.plans import pipeline as PL
from bizlens.session import shared_path
from bizlens.sources import catalog as CAT
from bizlens.sources import landing as LD

SPEC = {(r.report_id, r.stream): r for r in CAT.REPORTS}
JAN, FEB = dt.date(2024, 1, 1), dt.date(2024, 2, 1)


def _land(spark, root):
    sales = spark.createDataFrame([
        ("05/01/2024", "1", "corte", "cabelo", "ana", "maria s.", "R$ 100,00", "10,00"),
        ("05/01/2024", "1", "escova", "cabelo", "ana", "maria s.", "R$ 50,00", "5,00"),
        ("07/02/2024", "2", "corte", "cabelo", "bia", "MARIA S", "R$ 100,00", "10,00"),
    ], "Data string, Comanda string, Item string, Categoria string, Profissional string, Cliente string, "
       "Valor string, `Comissão` string")
    LD.land(LD.with_month(sales, F.trunc(F.to_date("Data", "dd/MM/yyyy"), "MM")), root, SPEC[("0186", "generic")])
    ledger = spark.createDataFrame([("05/01/2024", "Receita", "R$ 1.000,00"), ("06/01/2024", "Aluguel", "(300,00)")],
                                   "`Competência` string, Categoria string, Valor string")
    LD.land(LD.with_month(ledger, JAN), root, SPEC[("0387", "Competencia")])
    LD.land(LD.with_month(ledger.limit(0), JAN), root, SPEC[("0387", "Caixa")])
    clients = spark.createDataFrame([("Maria S.", "11-8888-7777", None)], "Cliente string, Celular string, "
                                    "`E-mail` string")
    LD.land(LD.with_month(clients, JAN), root, SPEC[("0002", "generic")])


def test_pipeline_views_and_kpis(spark):
    landing, wh = shared_path(spark, "t-pl-landing"), shared_path(spark, "t-pl-wh")
    _land(spark, landing)
    runs = {r.report_id: r for r in PL.run(spark, landing, wh)}
    assert runs["0186"].status == "written" and runs["0002"].status == "written"
    assert runs["0387"].status == "written"
    assert runs["0126"].status == "failed"                     # nothing landed for it: isolated failure
    seed = spark.createDataFrame([("RECEITA", "1. Receita Bruta", "Serviços", False),
                                  ("ALUGUEL", "4. Despesas Operacionais", "Fixas", False)],
                                 "categoria string, nivel_1 string, nivel_2 string, excluir_dre boolean")
    views = PL.publish_views(spark, wh, seed)
    assert {"fct_vendas", "dim_clientes", "rep_financeiro_competencia", "dim_calendario"} <= set(views)
    assert CAT.existing_tables(spark, ["fct_vendas", "nope"]) == ["fct_vendas"]
    rec = sorted((r["data"], r["servico"], r["is_recorrente"]) for r in spark.table("fct_vendas").collect())
    # line level: the first line of the first ticket is the only non-recurrent one (file order breaks the tie)
    assert rec == [(dt.date(2024, 1, 5), "Corte", False), (dt.date(2024, 1, 5), "Escova", True),
                   (dt.date(2024, 2, 7), "Corte", True)]
    got = RP.query_period(spark, "rep_financeiro_competencia", "grupo_metrica, valor", JAN,
                          dt.date(2024, 1, 31)).collect()
    groups = sorted(r[0] for r in got)
    assert groups == ["Comissões", "Comissões", "Despesas Operacionais", "Receita Bruta"]
    k = {r["periodo"]: r for r in MT.sales_kpis(spark, spark.table("fct_vendas"), JAN, dt.date(2024, 1, 31))
         .collect()}
    assert k["atual"]["faturamento"] == 150.0 and k["atual"]["atendimentos"] == 1
    assert k["atual"]["itens_por_cesta"] == 2.0
    assert k["anterior"]["faturamento"] == 0.0 and k["ano_anterior"]["atendimentos"] == 0   # empty -> zeros


def test_seed_csv(spark):
    path = shared_path(spark, "t-seed")
    spark.createDataFrame([("Aluguel", "4. Despesas Operacionais", "Fixas", "true")],
                          "Categoria string, `Nivel 1` string, `Nivel 2` string, ExcluirDRE string") \
        .write.option("header", True).csv(path)
    row = CAT.load_category_seed(spark, path).collect()[0]
    assert (row["categoria"], row["nivel_1"], row["excluir_dre"]) == ("Aluguel", "4. Despesas Operacionais", True)


def test_windows_and_month_injection(spark):
    df = spark.createDataFrame([(dt.date(2024, 2, 10),)], "d date")
    lo, hi = LD.report_window(F.lit(FEB), "comparacao")
    assert LD.apply_window(df, "d", lo, hi).count() == 1
    lo, hi = LD.report_window(F.lit(JAN), "padrao")
    assert LD.apply_window(df, "d", lo, hi).count() == 0
    assert LD.apply_window(df, "d", *LD.report_window(F.lit(JAN), "sem_data")).count() == 1
    assert LD.with_month(df, dt.date(2024, 2, 17)).collect()[0]["data_competencia"] == FEB
    assert D.granularity(JAN, dt.date(2024, 3, 1)) == "D"


def test_database_and_catalog_tables(spark):
    from bizlens.sources import sinks as SK

    CAT.use_database(spark, "bizlens_test")
    try:
        df = spark.createDataFrame([(1, "a")], "id int, v string")
        SK.replace(df, "tbl_t", as_table=True)
        SK.append(df.select("v", "id"), "tbl_t", as_table=True)       # appended by name, not by position
        assert sorted(tuple(r) for r in spark.table("tbl_t").collect()) == [(1, "a"), (1, "a")]
        assert CAT.existing_tables(spark, ["tbl_t", "tbl_missing"]) == ["tbl_t"]
    finally:
        spark.catalog.setCurrentDatabase("default")


def test_period_slice_prunes_month_partitions(spark):
    landing, wh = shared_path(spark, "t-pl-landing2"), shared_path(spark, "t-pl-wh2")
    _land(spark, landing)
    PL.run(spark, landing, wh)
    seed = spark.createDataFrame([("RECEITA", "1. Receita Bruta", "Serviços", False)],
                                 "categoria string, nivel_1 string, nivel_2 string, excluir_dre boolean")
    views = PL.publish_views(spark, wh, seed)
    feb = RP.period_slice(views["fct_vendas"], "data", FEB, dt.date(2024, 2, 29))
    plan = feb._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_mes" in plan and "2024-02-01" in plan
    assert [r["data"] for r in feb.collect()] == [dt.date(2024, 2, 7)]
    pl = RP.period_slice(views["rep_financeiro_competencia"], "data", JAN, dt.date(2024, 1, 31))
    assert "PartitionFilters: [isnotnull(_mes" in pl._jdf.queryExecution().executedPlan().toString()
    assert sorted(r["grupo_metrica"] for r in pl.collect()) == ["Comissões", "Comissões", "Receita Bruta"]
