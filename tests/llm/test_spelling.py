"""Operator 12 against brute force over all pairs of words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest

from bizlens.llm import queries, spelling

SMALL = "/root/testdata/sf0.001"


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + 1:] == b[i + 1:] if len(a) == len(b) else a[i:] == b[i + 1:]


def brute(counts, ratio=2):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted((w, n, len(near[w]), form[w], counts.get(form[w]), root(w)) for w, n in counts.items())


def rows_of(df):
    return sorted((r["word"], r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in df.collect())


def vocabulary():
    rng = random.Random(3)
    words = {"".join(rng.choice("abé") for _ in range(rng.randint(1, 6))) for _ in range(300)}
    words |= {"x" * 60, "x" * 61, "x" * 59 + "y", "hello", "helo", "hell", "ÿÿÿÿÿ", "ÿÿÿÿ", "ÿàÿÿÿ", "𐐷abc", "𐐷abd"}
    return {w: rng.choice([1, 2, 3, 8, 40]) for w in words}


@pytest.mark.parametrize("filter_bytes", [spelling.FILTER_BYTES, 200])
def test_variants_match_brute_force(spark, filter_bytes):
    counts = vocabulary()
    if filter_bytes < 1000:
        lengths = Counter(min(len(w), spelling.LAST_SHARD) for w in counts)
        assert spelling.plan_filters(lengths, filter_bytes)[0] > 2  # several passes
    df = spark.createDataFrame([(w, n, "x") for w, n in counts.items()], "word string, n long, form string")
    assert rows_of(spelling.variants(df, filter_bytes=filter_bytes)) == brute(counts)
    assert spelling.variants(df.limit(0)).count() == 0


def test_the_filters_decide_what_is_joined():
    """Edits that are no words hardly ever pass; those that are always do."""
    rng = random.Random(7)
    words = sorted({"".join(rng.choice("abcdefghij") for _ in range(7)) for _ in range(5000)})
    sizes = {7: len(words)}
    slices, blocks = spelling.plan_filters(sizes, spelling.FILTER_BYTES)
    filters = spelling.Filters(blocks, slices, 0)
    h = spelling._mixed(spelling.word_sums(words))
    block = filters.block(h, np.full(len(words), 7))
    for lane in range(8):
        np.bitwise_or.at(filters.lanes, (block, np.full(len(words), lane)), filters.bits(h, lane))
    found = list(spelling.positives(words, np.array(sorted(map(ord, "abcdefghij"))), filters))
    known = set(words)
    true = {(words[w], e) for w, e in found if e in known}
    pairs = {(a, b) for a in words for b in {a[:i] + c + a[i + 1:] for i in range(7) for c in "abcdefghij" if c > a[i]} & known}
    assert true == pairs
    tried = sum(sum(c > a for c in "abcdefghij") for w in words for a in w)
    assert len(found) - len(true) < 0.005 * tried


def test_words_are_counted_whole(spark):
    rows = [(1, "Hello HELLO hello123hello ÀÉÎõü×÷ abcd"), (1, "hello"), (2, None), (3, ""), (None, "hello  "), (4, "z" * 3000)]
    df = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, n int")
    got = {r["word"]: r["n"] for r in spelling.word_counts(df).collect()}
    assert got == {"hello": 6, "ÀÉÎõü×÷": 1, "z" * 3000: 1}


def test_op12_matches_the_contract(spark):
    counts = Counter()
    for row in pq.read_table(f"{SMALL}/documents.parquet", columns=["doc_id", "text"]).to_pylist():
        for run in re.findall("[A-Za-zÀ-ÿ]+", row["text"] or ""):
            word = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{row['doc_id']}:{word}".encode())
            if h % 97 == 0:
                word = word[:h % len(word)] + word[h % len(word) + 1:]
            counts[word] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    got = rows_of(queries.op12_spelling_variants(spark, SMALL))
    assert got == brute(counts)
    assert sum(r[3] is not None for r in got) > 10
