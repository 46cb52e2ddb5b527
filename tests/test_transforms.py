"""Report transforms on inline rows (the reference's test vectors) and the router."""

import datetime as dt
import hashlib

import pytest

from bizlens.plans import transforms as T


def test_clients_best_record(spark):
    rows = [
        (1, "maria s.", "11-8888-7777", "MARIA@TEST.COM", None),
        (2, "Carlos", None, None, None),
        (3, "carlos", "11999998888", None, None),
        (4, "Ana", "11911112222", None, None),
        (5, "ANA", "11933334444", None, None),
        (6, "Bruno", "abc", None, None),
        (7, None, None, None, None),
    ]
    raw = spark.createDataFrame(rows, "seq int, Cliente string, Celular string, `E-mail` string, Sexo string")
    out = {r["cliente"]: r for r in T.clients(raw, ["seq"]).collect()}
    assert out["MARIA S"]["celular"] == "1188887777" and out["MARIA S"]["email"] == "maria@test.com"
    assert out["MARIA S"]["id_cliente"] == hashlib.md5(b"MARIA S").hexdigest()
    assert out["CARLOS"]["celular"] == "11999998888"          # richer record wins
    assert out["ANA"]["celular"] == "11933334444"             # tie -> last seen wins
    assert out["BRUNO"]["celular"] is None                    # garbage phone -> null
    ids = [r["id_cliente"] for r in T.clients(raw, ["seq"]).collect()]
    assert "UNKNOWN" in ids and len(ids) == 4 + 1 + 1         # 4 names + null-name group + unknown member


def test_occupancy(spark):
    raw = spark.createDataFrame([("  Maria  ", "01:30", dt.date(2024, 1, 1)), ("JOAO", "02:00", dt.date(2024, 1, 1)),
                                 (None, "Invalid", dt.date(2024, 1, 1))],
                                "Profissional string, `Total Agendado` string, data_competencia date")
    got = sorted((r[1], r[2]) for r in T.occupancy(raw).collect())
    assert got == [("Desconhecido", 0.0), ("Joao", 2.0), ("Maria", 1.5)]


def test_occupancy_missing_month_column(spark):
    raw = spark.createDataFrame([("Maria", "01:30")], "Profissional string, `Total Agendado` string")
    with pytest.raises(T.MissingColumns):
        T.occupancy(raw)
    assert T.occupancy(raw, on_missing="empty").count() == 0


def test_returns(spark):
    raw = spark.createDataFrame([("  Joao Silva  ", "JOAO@TEST.COM", "m", "01/01/2023")],
                                "Cliente string, `E-mail` string, Sexo string, `Última Visita` string")
    r = T.returns(raw).collect()[0]
    assert (r["cliente"], r["email"], r["sexo"], r["ultima_visita"]) == ("Joao Silva", "joao@test.com", "M",
                                                                        dt.date(2023, 1, 1))


def test_professionals_latest_snapshot_and_dedupe(spark):
    raw = spark.createDataFrame([
        (1, " ana ", "123.456.789-01", "01/02/2020", dt.date(2024, 1, 1)),
        (1, " ana ", "123.456.789-01", "01/02/2020", dt.date(2024, 2, 1)),
        (2, "ANA", None, "2020-02-03", dt.date(2024, 2, 1)),
        (3, None, "nan", "x", dt.date(2024, 2, 1)),
    ], "seq int, Nome string, CPF string, `Data Cadastro` string, data_competencia date")
    rows = T.professionals(raw, ["seq"]).collect()
    assert rows[0]["id_profissional"] == "UNKNOWN"
    by_name = {r["nome"]: r for r in rows[1:]}
    assert set(by_name) == {"ANA", "NÃO INFORMADO"}
    assert by_name["ANA"]["cpf"] == "12345678901" and by_name["ANA"]["data_cadastro"] == dt.date(2020, 2, 1)
    assert by_name["NÃO INFORMADO"]["id_profissional"] == "UNKNOWN"


def test_ledger_streams(spark):
    cols = "`Competência` string, Pagamento string, `Cobrança` string, Categoria string, Valor string, `Título` string"
    cash = spark.createDataFrame([("01/01/2024", "05/01/2024", "x", " aluguel ", "(1.200,50)", "  ")], cols)
    accr = spark.createDataFrame([("01/01/2024", "05/01/2024", "x", None, "R$ 10,00", "mensal")], cols)
    rows = {r["tipo"]: r for r in T.ledger(cash, accr).collect()}
    assert rows["Caixa"]["data_movimento"] == dt.date(2024, 1, 5) and rows["Caixa"]["valor"] == -1200.5
    assert rows["Caixa"]["categoria"] == "ALUGUEL" and rows["Caixa"]["titulo"] == "Não Informado"
    assert rows["Competencia"]["data_movimento"] == dt.date(2024, 1, 1)
    assert rows["Competencia"]["categoria"] == "NÃO INFORMADO" and rows["Competencia"]["titulo"] == "Mensal"
    assert rows["Competencia"]["observacoes"] == "Não Informado"


def test_sales_lines(spark):
    raw = spark.createDataFrame([("05/01/2024", "12", "corte feminino", "cabelo", "ana", "maria s.", "R$ 100,00",
                                  "10", "2.0")],
                                "Data string, Comanda string, Item string, Categoria string, Profissional string, "
                                "Cliente string, Valor string, `Comissão (%)` string, `Qtd.` string")
    r = T.sales_lines(raw).collect()[0]
    assert (r["servico"], r["grupo_servico"], r["profissional"], r["cliente"]) == ("Corte Feminino", "Cabelo", "ANA",
                                                                                    "MARIA S")
    assert r["valor"] == 100.0 and r["qtd"] == 2 and r["comissao"] == 0.0
    assert r["id_comanda"] == hashlib.md5(b"122024-01-05").hexdigest()


def test_router(spark):
    assert set(T.TRANSFORMS) == {"0387", "0186", "0002", "0126", "0188", "0007", "0229"}
    with pytest.raises(ValueError):
        T.transform("9999")


def test_reports_of_which_nothing_came_are_empty_tables(spark):
    empty = T.ledger(None, None)
    assert empty.columns == T.LEDGER_COLUMNS and empty.count() == 0
    assert dict(empty.dtypes)["valor"] == "double" and dict(empty.dtypes)["data_movimento"] == "date"
    no_name = spark.createDataFrame([("x",)], "Cargo string")
    with pytest.raises(T.MissingColumns):
        T.professionals(no_name, ["Cargo"])
    kept = T.professionals(no_name, ["Cargo"], on_missing="empty")
    assert kept.columns == T.PROFESSIONAL_COLUMNS and kept.count() == 0


def test_professionals_all_columns(spark):
    raw = spark.createDataFrame(
        [(1, " ana ", "gerente", "123.456.789-09", "aninha", None, "15/03/2021 08:30"), (2, "ANA", "outro", None, None, None, None),
         (3, "bia", None, "nan", None, "unhas", "31/02/2021")],
        "seq int, Nome string, Cargo string, CPF string, Apelido string, Especialidade string, `Data Cadastro` string")
    out = {r["nome"]: r for r in T.professionals(raw, ["seq"]).collect()}
    assert (out["ANA"]["cargo"], out["ANA"]["cpf"], out["ANA"]["apelido"]) == ("GERENTE", "12345678909", "ANINHA")
    assert out["ANA"]["data_cadastro"] == dt.date(2021, 3, 15) and out["ANA"]["especialidade"] == "NÃO INFORMADO"
    assert out["BIA"]["cpf"] == "NÃO INFORMADO" and out["BIA"]["data_cadastro"] is None and len(out) == 3
