"""Snapshots of warehouse tables and the plain sinks: parts, crashes, schemas, catalog tables."""

import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from bizlens.session import shared_path
from bizlens.sources import catalog as CAT
from bizlens.sources import sinks as SK
from bizlens.sources import snapshots as SN


def rows(spark, data):
    return spark.createDataFrame(data, "mes string, n int")


def held(spark, root):
    return sorted(tuple(r) for r in SN.read(spark, root).select("mes", "n").collect())


def files(root):
    return {os.path.join(d, f) for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")}


def test_parts_are_replaced_and_others_keep_their_files(spark):
    root = shared_path(spark, "t-snap")
    assert not SN.exists(spark, root) and SN.version(spark, root) == 0
    with pytest.raises(AnalysisException):
        SN.read(spark, root)
    assert SN.publish(rows(spark, [("a", 1), ("b", 2), ("c", 3)]), root, ["mes"])
    before = files(root)
    assert SN.publish_parts(rows(spark, [("c", 30), ("d", 4)]), root, ["mes"], ["c", "d"])
    assert held(spark, root) == [("a", 1), ("b", 2), ("c", 30), ("d", 4)]
    assert {f for f in before if "mes=c" not in f} <= files(root)
    # a given part without rows is gone, unless none is left
    assert SN.publish_parts(rows(spark, [("d", 5)]), root, ["mes"], ["c", "d"])
    assert held(spark, root) == [("a", 1), ("b", 2), ("d", 5)]
    assert not SN.publish_parts(rows(spark, []), root, ["mes"], ["x"])
    assert not SN.publish_parts(rows(spark, []), root, ["mes"], ["a", "b", "d"])
    with pytest.raises(ValueError):
        SN.publish_parts(rows(spark, [("z", 1)]), root, ["mes"], ["a"])
    assert not SN.publish(rows(spark, []), root, ["mes"])
    assert held(spark, root) == [("a", 1), ("b", 2), ("d", 5)]


def test_null_parts_and_whole_tables(spark):
    root = shared_path(spark, "t-snap")
    assert SN.publish(rows(spark, [(None, 1), ("a", 2)]), root, ["mes"])
    assert sorted(SN.read(spark, root).select("mes", "n").collect(), key=str) == [("a", 2), (None, 1)]
    plain = shared_path(spark, "t-snap")
    for n in (1, 2, 3):
        assert SN.publish(rows(spark, [("a", n)]), plain)
        assert held(spark, plain) == [("a", n)] and SN.version(spark, plain) == n
    assert len([d for d in os.listdir(plain) if d.startswith(SN.VERSION)]) == 2  # the last two snapshots' folders


def test_a_job_that_dies_leaves_the_old_table(spark, monkeypatch):
    root = shared_path(spark, "t-snap")
    SN.publish(rows(spark, [("a", 1), ("b", 2)]), root, ["mes"])

    def dies(*_):
        raise RuntimeError("killed")

    monkeypatch.setattr(SN, "_commit", dies)
    with pytest.raises(RuntimeError):
        SN.publish(rows(spark, [("a", 9)]), root, ["mes"])
    with pytest.raises(RuntimeError):
        SN.publish_parts(rows(spark, [("a", 9)]), root, ["mes"], ["a"])
    monkeypatch.undo()
    assert held(spark, root) == [("a", 1), ("b", 2)]
    # a rows' failure in the middle of the write
    bad = rows(spark, [("a", 9), ("b", 0)]).withColumn("n", F.when(F.col("n") == 0, F.raise_error(F.lit("lost")).cast("int")).otherwise(F.col("n")))
    with pytest.raises(Exception, match="lost"):
        SN.publish(bad, root, ["mes"])
    # a snapshot file that was never finished
    with open(f"{root}/_snapshots/00000002.json", "w") as f:
        f.write('{"number": 2, "fol')
    assert held(spark, root) == [("a", 1), ("b", 2)]
    assert SN.publish(rows(spark, [("a", 7)]), root, ["mes"])
    assert held(spark, root) == [("a", 7)] and SN.version(spark, root) == 3


def test_a_second_writer_fails(spark, monkeypatch):
    root = shared_path(spark, "t-snap")
    SN.publish(rows(spark, [("a", 1)]), root)
    monkeypatch.setattr(SN, "_numbers", lambda *_: [])
    with pytest.raises(Exception, match="already exists"):
        SN.publish(rows(spark, [("a", 2)]), root)
    monkeypatch.undo()
    assert held(spark, root) == [("a", 1)]


def test_catalog_table_over_a_snapshot_prunes_parts(spark):
    root = shared_path(spark, "t-snap")
    SN.publish(rows(spark, [("a", 1), ("b", 2), (None, 3)]).withColumn("x", F.lit("y")), root, ["mes", "x"])
    SN.publish_parts(rows(spark, [("b", 20)]).withColumn("x", F.lit("z")), root, ["mes", "x"], ["b"])
    CAT.use_database(spark, "bizlens_snap")
    try:
        SN.register_table(spark, "tbl_snap", root)
        t = spark.newSession().table("bizlens_snap.tbl_snap")
        assert sorted(map(tuple, t.select("n", "mes", "x").collect())) == [(1, "a", "y"), (3, None, "y"), (20, "b", "z")]
        assert t.where("mes = 'b'").collect()[0]["n"] == 20
        assert len(t.where("mes = 'b'").inputFiles()) >= 1 and all("mes=b" in f for f in t.where("mes = 'b'").inputFiles())
        SN.register_table(spark, "tbl_snap", root)  # again, over the same name
        assert spark.table("tbl_snap").count() == 3
    finally:
        spark.catalog.setCurrentDatabase("default")


def test_plain_replacement_survives_a_death_between_the_renames(spark, monkeypatch):
    target = shared_path(spark, "t-plain")
    SK.replace_if_not_empty(rows(spark, [("a", 1)]), target)
    rename, calls = SK._rename, []

    def dies(spark, source, to):
        calls.append(to)
        if len(calls) == 2:
            raise RuntimeError("killed")
        return rename(spark, source, to)

    monkeypatch.setattr(SK, "_rename", dies)
    with pytest.raises(RuntimeError):
        SK.replace_if_not_empty(rows(spark, [("a", 2)]), target)
    monkeypatch.undo()
    assert SK.recover(spark, target) and spark.read.parquet(target).collect() == [("a", 1)]
    assert SK.replace_if_not_empty(rows(spark, [("b", 3), ("c", 4)]), target, ["mes"])
    assert spark.read.parquet(target).count() == 2
    assert [d for d in os.listdir(os.path.dirname(target)) if d.startswith(os.path.basename(target) + ".")] == []


def test_append_checks_the_schema(spark):
    target = shared_path(spark, "t-append")
    SK.append(rows(spark, []), target)                                    # creates the empty table
    assert spark.read.parquet(target).count() == 0
    SK.append(rows(spark, [("a", 1)]).select("n", "mes"), target)         # by name
    SK.append(rows(spark, [("b", 2)]).withColumn("n", F.col("n").cast("smallint")), target)
    assert sorted(map(tuple, spark.read.parquet(target).select("mes", "n").collect())) == [("a", 1), ("b", 2)]
    for bad in (rows(spark, [("a", 1)]).drop("n"), rows(spark, [("a", 1)]).withColumn("x", F.lit(1)),
                rows(spark, [("a", 1)]).withColumn("n", F.col("n").cast("bigint"))):
        with pytest.raises(SK.SchemaMismatch):
            SK.append(bad, target)
    assert spark.read.parquet(target).count() == 2
