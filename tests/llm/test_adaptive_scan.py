"""Operator 13: exact scores and recall against brute force."""

import math

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from bizlens.llm import adaptive_scan, queries

SMALL, MORE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def brute(rows, k=5):
    """(query id, rank) -> (id, score) over (id, vector) rows, by plain double sums."""
    valid = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and None not in v
             and all(math.isfinite(x) for x in v) and any(v)]
    x = np.stack([v for _, v in valid])
    ids = np.array([i for i, _ in valid])
    norm = np.sqrt((x * x).sum(axis=1))
    best = {}
    for at in np.flatnonzero(ids % 50 == 0).tolist():
        score = (x * x[at]).sum(axis=1) / (norm * norm[at])
        for j in np.flatnonzero(ids != ids[at]).tolist():
            key = (int(ids[at]), int(ids[j]))
            best[key] = max(best.get(key, -9), float(score[j]))
    out = {}
    for q in {q for q, _ in best}:
        some = sorted((-s, c) for (a, c), s in best.items() if a == q)[:k]
        out.update({(q, r + 1): (c, -s) for r, (s, c) in enumerate(some)})
    return out


def rows_of(df):
    rows = df.collect()
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in rows}
    assert len(got) == len(rows)
    return got


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", 3) for i, v in rows], "vec_id long, embedding array<float>, list string, id int")


def is_query():
    return F.col("id") % 50 == 0


def recall(got, want):
    near = lambda r, q: {c for (a, _), (c, _) in r.items() if a == q}
    return sum(len(near(got, q) & near(want, q)) for q in {q for q, _ in want}) / len(want)


@pytest.mark.parametrize("folder", [SMALL, MORE])
def test_op13_recall_and_scores(spark, folder):
    table = pq.read_table(f"{folder}/embeddings.parquet", columns=["vec_id", "embedding"]).to_pylist()
    rows = [(r["vec_id"], r["embedding"]) for r in table]
    got, want = rows_of(queries.op13_adaptive_scan(spark, folder)), brute(rows)
    assert set(got) == set(want) and recall(got, want) >= 0.9
    vector = dict(rows)
    for (q, _), (c, s) in got.items():
        a, b = np.array(vector[q], float), np.array(vector[c], float)
        assert abs(s - float((a * b).sum() / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum())))) < 1e-12


def test_clusters_copies_and_a_hot_group(spark, monkeypatch):
    """Clustered data with a third of all rows near one point, exact copies and several cells: few lists are probed."""
    monkeypatch.setattr(adaptive_scan, "CELL_ROWS", 100)
    rng = np.random.default_rng(2)
    centre = rng.standard_normal((20, 24))
    x = centre[rng.integers(0, 20, 1500)] + 0.2 * rng.standard_normal((1500, 24))
    x[:500] = centre[0] + 0.01 * rng.standard_normal((500, 24))
    x[600:640] = x[600]
    rows = [(i, [float(v) for v in np.float32(r)]) for i, r in enumerate(x)]
    df = frame(spark, rows)
    index = adaptive_scan.build_index(df)
    probes, share = adaptive_scan.probes_needed(index, index.rows.where(is_query()), 5)
    assert probes < len(index.centroids) / 3 and share >= adaptive_scan.TARGET
    assert adaptive_scan.cells_of(index.counts, 100)[2] > 10
    got, want = rows_of(adaptive_scan.search(index, index.rows.where(is_query()), probes)), brute(rows)
    assert recall(got, want) >= 0.95
    assert all(c < 650 for (q, _), (c, _) in got.items() if q == 600)
    assert [got[600, r][0] for r in range(1, 6)] == [601, 602, 603, 604, 605]


def test_all_lists_probed_is_brute_force(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(v) for v in np.float32(r)]) for i, r in enumerate(rng.integers(-2, 3, (700, 20)))]
    index = adaptive_scan.build_index(frame(spark, rows))
    got = rows_of(adaptive_scan.search(index, index.rows.where(is_query()), len(index.centroids)))
    want = brute(rows)
    assert recall(got, want) > 0.9 and set(got) == set(want)
    assert np.allclose([got[k][1] for k in sorted(got)], [want[k][1] for k in sorted(want)], atol=1e-9)


def test_the_tests_abandon_candidates():
    """Far candidates are left before all columns are read, and none of the near ones."""
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.standard_normal((1000, 64)), 5 + 0.1 * rng.standard_normal((20, 64))])
    cell = adaptive_scan.Cell(np.arange(1020), x, np.zeros(1020, int), adaptive_scan.rotation(64))
    q = 5 + 0.1 * rng.standard_normal((1, 64))
    turned = (adaptive_scan.unit(q) @ adaptive_scan.rotation(64)).astype(np.float32)
    blocks = [turned[:, b:b + adaptive_scan.BLOCK] for b in range(0, 64, adaptive_scan.BLOCK)]
    worst = np.full(1, np.inf, np.float32)
    qi, ci = cell.scan(0, 1020, np.array([-1]), blocks, worst, 5)
    exact = adaptive_scan.cosines(np.repeat(adaptive_scan.scaled(q), 1020, 0), cell.vectors)
    assert set(np.argsort(-exact)[:5]) <= set(ci.tolist()) and len(ci) < 15


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i, [1.0, float(i), 0.5]) for i in (50, 1, 2)]
    odd = [(100, None), (150, [0.0, 0.0, 0.0]), (200, [nan, 1.0, 1.0]), (250, [inf, 0.0, 1.0]), (300, [None, 1.0, 2.0]),
           (None, [1.0, 1.0, 1.0]), (350, [1.0, 2.0]), (400, [])]
    twice = [(50, [1.0, 50.0, 0.5]), (2, [3.0, 50.0, 0.5])]
    got = rows_of(adaptive_scan.nearest(frame(spark, good + odd + twice), is_query()))
    want = brute([(i, v) for i, v in good + twice])
    assert {k: c for k, (c, _) in got.items()} == {k: c for k, (c, _) in want.items()} and len(got) == 2
    assert adaptive_scan.nearest(frame(spark, odd[:2]), is_query()).count() == 0
    assert adaptive_scan.nearest(frame(spark, []), is_query()).count() == 0
    big = [(50, [3e38, 1e38]), (1, [3e38, 2e38]), (2, [1e-40, 0.0]), (3, [-1.0, 0.0])]
    assert [c for _, (c, _) in sorted(rows_of(adaptive_scan.nearest(frame(spark, big), is_query())).items())] == [1, 2, 3]
