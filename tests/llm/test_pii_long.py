"""Operator 6 on very long texts, on its own marks, and on clashing column names."""

import time

import pytest
from pyspark.sql import functions as F

from bizlens.llm import pii
from tests.llm.test_text_rules import frame

RUNS = {"labels": "b.", "letters": "a", "digits": "7", "plus": "+", "plus digits": "+1 ", "separators": "1-", "at": "a@",
        "dots": ".", "dates": "1.2.", "brackets": "(1) ", "keys": "token=", "hyphens": "a-", "slashes": "1/", "quotes": "'\" ",
        "colons": "a:", "sixes": "1::", "prefixes": "sk-", "ibans": "DE89 3704 ", "pairs": "01 23 ", "identities": "X-1"}


@pytest.mark.parametrize("size", [10_000, 200_000])
def test_long_runs_take_time_in_proportion(spark, size):
    texts = []
    for unit in RUNS.values():
        run = (unit * (size // len(unit) + 1))[:size]
        texts += [f"x {run} y", f"x a@{run} y", f"x a@b.{run} y", f"x {run}@b.com y", f"x token={run} y", f"x +{run} y"]
    start = time.time()
    got = pii.pseudonymise(frame(spark, texts), "k").select("doc_id", F.substring("text", 1, 2).alias("a"),
                                                            F.substring("text", -2, 2).alias("z")).collect()
    assert len(got) == len(texts) and all(r["a"] == "x " and r["z"] == " y" for r in got)
    assert time.time() - start < 120


def test_ten_megabytes(spark):
    texts = [unit * (10_000_000 // len(unit)) for unit in ("b.", "a", "1-")] + ["x token=" + "ab1" * 3_000_000]
    got = pii.pseudonymise(frame(spark, texts), "k").select(F.length("text").alias("n"), "n_pii").collect()
    assert [r["n"] for r in got] == [len(t) for t in texts]


def test_addresses_within_the_limits(spark):
    texts = ["x jérôme@exemple.fr y", "x a.b-c+d@sub.my-host.example.org. y", f"x {'a' * 64}@b.com y", "x .a@b.com y",
             f"x a@{'.'.join(['lab'] * 10)} y"]
    got = pii.pseudonymise(frame(spark, texts), "k").orderBy("doc_id").collect()
    assert [r["n_pii"] for r in got] == [1] * len(texts)
    for t, r in zip(texts, got, strict=True):
        assert len(r["text"]) == len(t) and r["text"] != t
    assert got[0]["text"].endswith(".fr y") and got[1]["text"].endswith(".org. y")


def test_marks_in_the_text_stay(spark):
    own = [f"a{pii.MARK}b", f"{pii.ESCAPE}{pii.MARK} a@b.com {pii.MARKED}{pii.ESCAPE}{pii.ESCAPE}", pii.MARK, "a@b.com"]
    got = [r["text"] for r in pii.pseudonymise(frame(spark, own), "k").orderBy("doc_id").collect()]
    assert got[0] == own[0] and got[2] == own[2]
    assert got[1] == own[1].replace("a@b.com", got[3]) and got[3] != own[3]


def test_names_that_clash(spark):
    df = frame(spark, ["a@b.com", None]).selectExpr("doc_id", "text", "7 AS n_pii", "text AS _pk", "'s' AS _ps", "3 AS _p_m")
    got = pii.pseudonymise(df, "k").orderBy("doc_id").collect()
    assert [(r["n_pii"], r["_pk"], r["_ps"], r["_p_m"]) for r in got] == [(1, "a@b.com", "s", 3), (0, None, "s", 3)]
    kept = pii.pseudonymise(df, "k", count_col=None)
    assert kept.columns == df.columns and [r["n_pii"] for r in kept.collect()] == [7, 7]
