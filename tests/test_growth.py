"""What moves with the sales lines: clients per order, raw columns before keys and texts, members made once."""

import datetime as dt

import pytest

import __spark_entry__ as e
from bizlens.functions import cleaning as C
from bizlens.plans import loading_queries as LQ
from bizlens.plans import model as M
from bizlens.plans import pipeline as PL
from bizlens.sources import bindings as B
from bizlens.sources import landing as LD
from bizlens.sources import snapshots as SN


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    """Twelve lines of four orders in two months; one order has no client, one line no part."""
    root = str(tmp_path_factory.mktemp("sf"))
    day = lambda m, d: dt.datetime(2000, m, d)
    tables = {
        "customer": ([(1, "Ana"), (2, "Bia")], "c_custkey long, c_name string"),
        "supplier": ([(1, "Sal"), (2, "Sol")], "s_suppkey long, s_name string"),
        "part": ([(1, "corte", "CABELO", 3, 10.0), (2, "barba", "ROSTO", 10, 5.5)],
                 "p_partkey long, p_name string, p_type string, p_size int, p_retailprice double"),
        "orders": ([(1, 1, "O", 10.0, day(1, 5), "5-LOW"), (2, 1, "F", 10.0, day(2, 5), "5-LOW"),
                    (3, 2, "F", 10.0, day(1, 9), "2-HIGH"), (4, 9, "O", 10.0, day(2, 9), "5-LOW")],
                   "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, "
                   "o_orderpriority string"),
        "lineitem": ([(o, 1 + (o + n) % 3, 1 + n % 2, n, 2.0, 10.0 * n + o, 0.05, 0.1, "N", day(1 + o % 2, 7))
                      for o in (1, 2, 3, 4) for n in (1, 2, 3)],
                     "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                     "l_discount double, l_tax double, l_returnflag string, l_shipdate timestamp"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{root}/{name}.parquet")
    return root


def plan(df) -> list[str]:
    return df._jdf.queryExecution().optimizedPlan().toString().splitlines()


def below(lines: list[str], at: int) -> list[str]:
    """The plan lines beneath one."""
    depth = lambda s: len(s) - len(s.lstrip(" :+-"))
    out = []
    for line in lines[at + 1:]:
        if depth(line) <= depth(lines[at]):
            break
        out.append(line)
    return out


def test_clients_are_looked_up_per_order(spark, sf):
    """the join to the customers reads no lines."""
    lines = plan(B.sales_lines(spark, sf))
    [at] = [i for i, s in enumerate(lines) if "Join" in s and "c_custkey" in s]
    assert not any("l_orderkey" in s for s in below(lines, at))


def test_keys_are_made_after_the_flag(spark):
    """The join that sets the flag carries no made key of the lines."""
    sales = spark.createDataFrame([(dt.date(2000, 1, 1), 1, "Ana", "Sal", "x", "g")],
                                  "data date, comanda long, cliente string, profissional string, servico string, grupo_servico string")
    lines = plan(M.fct_vendas(sales, ["data", "comanda"]))
    at = next(i for i, s in enumerate(lines) if "Join" in s)
    assert not any("AS id_comanda" in s or "AS id_profissional" in s for s in below(lines, at))


def test_flag_of_narrow_lines(spark, sf):
    """One line of each client is not recurrent, the first by day and order, and the texts are those of its part."""
    rows = e.queries()["sales_facts"](spark, sf).where("not is_recorrente").collect()
    assert {(r["id_cliente"], r["comanda"]) for r in rows} == {
        (r[0], n) for name, n in (("Ana", 1), ("Bia", 3)) for r in spark.sql(f"select md5(upper('{name}'))").collect()} | {(None, 4)}


def test_members_are_made_once(spark, sf):
    """no check of the result reads the lines again."""
    files = e.queries()["resolved_members"](spark, sf).inputFiles()
    assert not [f for f in files if "lineitem" in f or "orders" in f]


def test_rows_are_dealt_before_they_are_made(spark, sf, tmp_path):
    """one exchange by month, beneath amounts and keys; the raw rows of a report as well."""
    made = plan(B.sales_by_month(spark, sf, "_m"))
    at = next(i for i, s in enumerate(made) if "Rebalance" in s)
    assert not any("AS liquido" in s or "md5" in s for s in below(made, at))
    root = str(tmp_path)
    LQ._land_sales(spark, sf, root)
    raw = plan(PL._transformed(spark, root, "0186", list(LQ.CAT.REPORTS), None))
    at = next(i for i, s in enumerate(raw) if "Rebalance" in s)
    assert not any("md5" in s for s in below(raw, at))
    assert SN.publish(PL._transformed(spark, root, "0186", list(LQ.CAT.REPORTS), None), f"{root}_t", [PL.EXTRACT], dealt=True)
    assert SN.read(spark, f"{root}_t").count() == LD.read_report(spark, root, LQ.SPEC["0186"]).count() == 12
    assert set(SN.current(spark, f"{root}_t").folders) == {"2000-01-01", "2000-02-01"}


def test_int_coerce_reads_plain_digits_at_once(spark):
    """the same numbers with and without the short way."""
    texts = ["12", "007", " 12 ", "1.9", "-3.7", "x", "", None, "9" * 15, "9" * 16, "1e3", "12\n", "٣"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", C.int_coerce("t").alias("n"))
    found = dict(df.collect())
    assert found == {"12": 12, "007": 7, " 12 ": 12, "1.9": 1, "-3.7": -3, "x": 0, "": 0, None: 0, "9" * 15: 10 ** 15 - 1,
                     "9" * 16: 10 ** 16, "1e3": 1000, "12\n": 12, "٣": 0}
