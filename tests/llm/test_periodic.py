"""Operator 11 against brute force over every start and period."""

import hashlib
import random
import zlib
from fractions import Fraction

import pyarrow.parquet as pq

from bizlens.llm import periodic, queries

SMALL = "/root/testdata/sf0.001"


def brute(words, min_length=24, exponent=3):
    n, out = len(words), []
    for q in range(1, n // exponent + 1):
        at = 0
        while at + q < n:
            end = at
            while end + q < n and words[end] == words[end + q]:
                end += 1
            length = end - at + q
            if end > at and length >= max(min_length, exponent * q):
                part = words[at:at + length]
                if not any(all(part[i] == part[i + d] for i in range(length - d)) for d in range(1, q)):
                    out.append((at, length, q))
            at = end + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def texts():
    rng = random.Random(5)
    out = [None, "", " \t ", "one", "a " * 24, "a " * 23, "a b " * 12, "x\x85y " * 30, "é " * 25 + "è " * 25]
    for _ in range(150):
        words = [rng.choice("abcd") for _ in range(rng.randint(0, 40))]
        for _ in range(rng.randint(0, 3)):
            period = [rng.choice(["a", "b", "cc", "Ω"]) for _ in range(rng.randint(1, 14))]
            words += (period * rng.randint(2, 9))[:rng.randint(1, 120)] + [rng.choice("abz") for _ in range(rng.randint(0, 6))]
        out.append(" ".join(words))
    out.append("fib " + " ".join(fibonacci(300)))
    out.append(" ".join((fibonacci(21) * 4)[:80]))
    return out


def fibonacci(n):
    a, b = "a", "ab"
    while len(b) < n:
        a, b = b, b + a
    return list(b[:n])


def test_runs_match_brute_force(spark):
    rows = list(enumerate(texts())) + [(3, "a b " * 12), (3, "a b " * 12), (None, "a " * 30)]
    df = spark.createDataFrame([(k, t, 9, "c") for k, t in rows], "doc_id long, text string, n_words int, runs string")
    got = sorted(((r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"])
                  for r in periodic.find_runs(df).collect()), key=repr)
    want = []
    for k, t in rows:
        words = [w.decode() for w in (t or "").encode().split()]
        runs = brute(words)
        dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
        want.append((k, len(words), runs, " ".join(w for i, w in enumerate(words) if i not in dropped)))
    assert got == sorted(want, key=repr)
    assert sum(len(w[2]) for w in want) > 100
    assert periodic.find_runs(df.limit(0)).count() == 0


def test_texts_share_slices_without_mixing(monkeypatch):
    some = [t.encode().split() for t in texts() if t]
    monkeypatch.setattr(periodic, "SLICE", 50)
    sliced = [r for s in periodic._slices([b" ".join(w) for w in some]) for r in periodic.runs_of(s)]
    assert periodic.runs_of(some) == sliced


def test_long_texts_of_one_word_and_of_long_periods():
    words = [b"w"] * 200_000
    assert periodic.runs_of([words]) == [[(0, 200_000, 1)]]
    rng = random.Random(1)
    period = [str(rng.random()).encode() for _ in range(20_000)]
    assert periodic.runs_of([[b"x", *period, *period, *period, b"y"]]) == [[(1, 60_000, 20_000)]]
    assert periodic.runs_of([[b"x", *period, *period, *period[:-1], b"y"]]) == [[]]


def test_op11_matches_the_contract(spark):
    table = pq.read_table(f"{SMALL}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    got = {r["doc_id"]: r for r in queries.op11_periodic_runs(spark, SMALL).collect()}
    changed = 0
    for row in table:
        words = [w.decode() for w in (row["text"] or "").encode().split()]
        h, n = zlib.crc32(str(row["doc_id"]).encode()), len(words)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
            changed += 1
        if n > 3000:
            continue
        runs = brute(words)
        best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None, None, None))
        dropped = {i for s, m, q in runs for i in range(s + q, s + m)}
        left = " ".join(w for i, w in enumerate(words) if i not in dropped)
        r = got[row["doc_id"]]
        assert (r["n_runs"], r["start"], r["length"], r["period"]) == (len(runs), *best)
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        assert r["runs_sha256"] == hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(left.encode()).hexdigest()
    assert len(got) == len(table) and changed
