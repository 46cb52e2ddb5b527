"""What a job holds on disk at a time: shuffles of finished steps are given back, large tables are worked on in slices, and lines
that cannot be a client's first do not move."""

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from bizlens.functions import cleaning as C
from bizlens.operators import frames as FR
from bizlens.plans import first_purchase as FP
from bizlens.plans import loading_queries as LQ
from bizlens.plans import model as M
from bizlens.plans import pipeline as PL
from bizlens.plans import views as V
from bizlens.session import FREED, shared_path
from bizlens.sources import bindings as B
from bizlens.sources import landing as LD
from bizlens.sources import snapshots as SN
from bizlens.sources import tables as TB


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    """Sixty lines of twenty orders in four months, a line twice and one without order; an order without client or day."""
    root = str(tmp_path_factory.mktemp("sf"))
    day = lambda o: None if o == 20 else dt.datetime(2000, 1 + o % 4, 1 + o)
    lines = [(o, 1 + (o + n) % 3, 1 + n % 2, n, 2.0, 10.0 * n + o, 0.05, 0.1, "N", dt.datetime(2000, 1 + o % 2, 7))
             for o in range(1, 21) for n in (1, 2, 3)]
    tables = {
        "customer": ([(1, "Ana"), (2, "Bia"), (3, None)], "c_custkey long, c_name string"),
        "supplier": ([(1, "Sal"), (2, "Sol")], "s_suppkey long, s_name string"),
        "part": ([(1, "corte", "CABELO", 3, 10.0), (2, "barba", "ROSTO", 10, 5.5)],
                 "p_partkey long, p_name string, p_type string, p_size int, p_retailprice double"),
        "orders": ([(o, 1 + o % 4, "FO"[o % 2], 10.0, day(o), "5-LOW") for o in range(1, 21)],
                   "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, "
                   "o_orderpriority string"),
        "lineitem": ([*lines, lines[0], (None, 1, 1, 1, 2.0, 7.0, 0.05, 0.1, "N", dt.datetime(2000, 1, 7))],
                     "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                     "l_discount double, l_tax double, l_returnflag string, l_shipdate timestamp"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{root}/{name}.parquet")
    return root


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def shuffle_files(spark) -> set[str]:
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {n for n in (found.apply(i).getName() for i in range(found.size())) if n.startswith("shuffle_")}


def test_writes_give_their_shuffles_back(spark, tmp_path):
    """neither a published table nor a landed report leaves shuffle files behind."""
    df = spark.range(1000).select(F.col("id").cast("string").alias("Bandeira"), F.lit(dt.date(2000, 1, 1)).alias("data_competencia"))
    setting, before = spark.conf.get(FREED, None), shuffle_files(spark)
    assert SN.publish(df, f"{tmp_path}/t", ["data_competencia"])
    LD.land(df, f"{tmp_path}/l", LQ.FEES)
    until = time.time() + 20
    while shuffle_files(spark) - before and time.time() < until:  # deleted behind the query
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert spark.conf.get(FREED, None) == setting


def test_slices_hold_each_ticket_once(spark, sf, monkeypatch):
    """the slices together are the sales lines, those without a ticket or twice included; they are published together."""
    whole = B.sales_by_month(spark, sf, "_m")
    assert len(B.sales_slices(spark, sf, "_m")) == 1
    monkeypatch.setattr(TB, "SLICE_BYTES", 1)
    parts = B.sales_slices(spark, sf, "_m")
    assert len(parts) == TB.MAX_KEY_SLICES and len(B.sales_slices(spark, sf, "_m", few=True)) == TB.MAX_KEY_SLICES // 2
    root = shared_path(spark, "t-slices")
    assert SN.publish(parts, root, ["_m"], dealt=True)
    assert rows(SN.read(spark, root)) == rows(whole) and whole.count() == 62
    tickets = [{r[0] for r in p.select("comanda").collect()} for p in parts]
    assert sum(map(len, tickets)) == len(set().union(*tickets)) == 21
    assert SN.version(spark, root) == 1
    with pytest.raises(ValueError):
        SN.publish_parts(parts, root, ["_m"], ["2000-01-01"], dealt=True)


def test_month_slices():
    sizes = {"2000-03": 5, "2000-01": 3, "2000-02": 4, "2000-04": 100}
    old, TB.SLICE_BYTES = TB.SLICE_BYTES, 8
    try:
        assert TB.month_slices(sizes) == [["2000-01", "2000-02"], ["2000-03"], ["2000-04"]]
        assert TB.month_slices({}) == [[]]
        many = TB.month_slices({f"{m:05}": 8 for m in range(1000)})
        assert len(many) < 2 * TB.MAX_MONTH_SLICES and sum(map(len, many)) == 1000
    finally:
        TB.SLICE_BYTES = old


def test_landing_and_tables_in_slices(spark, sf, monkeypatch, tmp_path):
    """sales and ledger landed and run by groups of months are the same tables; a month landed again replaces its rows."""
    reports = [r for r in LQ.CAT.REPORTS if r.report_id in ("0186", "0387")]
    found = {}
    for way in ("whole", "sliced"):
        if way == "sliced":
            monkeypatch.setattr(TB, "SLICE_BYTES", 1)
            monkeypatch.setattr(TB, "MAX_KEY_SLICES", 2)
        found[way] = []
        # all rows in one run, then those with a day, of which the newest months are landed and run again
        for k, since in enumerate((None, dt.date(2000, 1, 1))):
            land, house = f"{tmp_path}/{way}{k}/l", f"{tmp_path}/{way}{k}/w"
            LQ._land_sales(spark, sf, land, F.col("data") >= F.lit(since) if since else None)
            LQ._land_ledger(spark, sf, land, B.ledger(spark, sf).where("data_movimento IS NOT NULL") if since else None)
            runs = PL.run(spark, land, house, reports)
            if since:
                LQ._land_sales(spark, sf, land, F.col("data") >= F.lit(dt.date(2000, 3, 1)), valor=F.lit(1).cast(B.MONEY))
                runs += PL.run(spark, land, house, reports, as_of=dt.date(2000, 5, 1))
            assert {r.status for r in runs} == {"written"}, runs
            # the place in a file depends on how the files were written
            tables = {t: PL.read_table(spark, house, t) for t in (PL.SALES, "tbl_0387_financeiro", PL.FIRST_LINES)}
            found[way].append({t: rows(df.drop("_arquivo", "_linha")) for t, df in tables.items()})
    slices = PL._slices(spark, f"{tmp_path}/sliced0/l", "0186", reports, None)
    assert len(slices) == 5 and ["__HIVE_DEFAULT_PARTITION__"] in slices
    assert found["sliced"] == found["whole"] and [len(t[PL.SALES]) for t in found["whole"]] == [62, 58]


def test_no_row_is_missed_by_the_filter(spark):
    """A key of the table always passes, of others nearly none; nulls and both zeros count as the join counts them."""
    known = spark.createDataFrame([(i * 7, None if i % 5 == 0 else float(i)) for i in range(2000)] + [(None, None), (1, 0.0)], "a long, b double")
    asked = known.union(spark.createDataFrame([(1, -0.0)], "a long, b double")).withColumn("there", F.lit(True)) \
        .union(spark.range(1, 200001).select((F.col("id") * 7 + 3).alias("a"), F.lit(0.5), F.lit(False)))
    key = [F.col("a"), FR.hashable(F.col("b"), "double")]
    found = dict(FR.with_marks(asked, key, FR.marks(known, key), "may").groupBy("there").agg(F.count_if("may")).collect())
    assert found[True] == 2003 and found[False] < 200
    assert FR.with_marks(known, key, FR.marks(known.limit(0), key), "may").where("may").count() == 0


def test_lines_that_cannot_be_first_do_not_move(spark, sf):
    """with kept first lines most lines get their flag without meeting them, and it is the flag of the window."""
    lines = B.sales_lines(spark, sf)
    order = list(B.SALES_ROW_ORDER)
    firsts = FP.first_lines(lines.withColumn("_m", F.lit(1)), C.md5_key("cliente"), order, "_m").drop("_m")
    kept, made = M.fct_vendas(lines, order, firsts=firsts), M.fct_vendas(lines, order)
    assert rows(kept) == rows(made) and kept.where("NOT is_recorrente").count() >= 3
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan and "true AS is_recorrente" in plan
    assert "NOT pode_ser" in V.VIEWS["fct_vendas"]
