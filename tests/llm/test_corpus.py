"""Operators 7, 8, 9, the pipeline and the registry against brute force."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
import xxhash

import __spark_entry__
import corpus_pipeline
from bizlens.llm import pii, quality, sharding, simhash, weighted_sampling
from bizlens.llm.components import components

SMALL = "/root/testdata/sf0.001"
TEXTS = [None, "", " ", "one", "a b c", "a b c", "some words stand here and go on for a while " * 30, "x " * 5000,
         "Some Words stand here and go on for a while " * 30] + [f"text {i} of many others {i * 7}" for i in range(60)]


def frame(spark, rows):
    return spark.createDataFrame([(k, t, 1, "c") for k, t in rows], "doc_id long, text string, shard int, fp string")


def fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    n = max(1, len(words) - 3)
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i:i + 4]), 42) for i in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > n)


def groups(ids, fps, distance):
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= distance:
                root[find(i)] = find(j)
    least = {}
    for i, k in enumerate(ids):
        least[find(i)] = min(least.get(find(i), k), k)
    return [least[find(i)] for i in range(len(ids))]


def test_simhash_components_match_brute_force(spark):
    rows = list(enumerate(TEXTS))
    fps = [fingerprint(t) for t in TEXTS]
    want = groups([k for k, _ in rows], fps, 4)
    got = {r["doc_id"]: r for r in simhash.near_duplicates(frame(spark, rows)).collect()}
    assert [got[k]["fp"] & (1 << 64) - 1 for k, _ in rows] == fps
    assert [got[k]["component_id"] for k, _ in rows] == want
    assert simhash.near_duplicates(frame(spark, [])).count() == 0


def test_components_with_null_and_repeated_ids(spark):
    """A component's id is its smallest; null where all its ids are null; equal ids alone link nothing."""
    words = [" ".join(f"{a}{i}" for i in range(60)) for a in "abc"]
    rows = [(9, words[0]), (4, words[0]), (None, words[0]), (None, words[1]), (4, words[2]), (4, words[2])]
    # A component of many classes: each differs from its neighbours by a word near the end of a long text.
    long = [f"z{i}" for i in range(400)]
    chain = [(100 - k, " ".join(long + [f"end{j}" for j in range(k)])) for k in range(12)]
    found = simhash.near_duplicates(frame(spark, rows + chain), carry=("text",)).collect()
    got = {(r["doc_id"], r["text"]): r["component_id"] for r in found}
    assert [got[r] for r in rows] == [4, 4, 4, None, 4, 4]
    fps = [fingerprint(t) for _, t in chain]
    assert len(set(fps)) > 3
    assert [got[r] for r in chain] == groups([k for k, _ in chain], fps, 4)
    roots = {r["text"]: r["root"] for r in found}
    assert roots[words[0]] != roots[words[2]] and len(simhash.one_of_each(frame(spark, rows)).collect()) == 3


@pytest.mark.parametrize("distance", [1, 4, 7])
def test_pigeonhole_loses_no_link(spark, distance):
    rng = np.random.default_rng(distance)
    centre = rng.integers(0, 1 << 63, 40, dtype=np.int64)
    near = [int(c) ^ sum(1 << int(b) for b in rng.choice(63, rng.integers(0, 10), replace=False))
            for c in centre for _ in range(12)]
    fps = sorted(set(near))
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    got = {(r["u"], r["v"]) for r in simhash.links(df, distance).collect()}
    want = {(a, b) for i, a in enumerate(fps) for b in fps[i + 1:] if (a ^ b).bit_count() <= distance}
    assert got == want


def test_thresholds_spend_the_whole_distance():
    together = np.full((64, 64), 250.0)
    np.fill_diagonal(together, 500)
    for n in (10, 10 ** 5, 10 ** 9):
        chosen = simhash.allocate(n, together * n / 1000, 4)
        assert sum(t + 1 for _, t in chosen) == 5
        bits = [b for part, _ in chosen for b in part]
        assert len(bits) == len(set(bits))


def test_components_of_chain_star_and_ring(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(500, i) for i in range(501, 560)] + [(1, 2), (2, 3), (3, 1), (7, 7)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert {got[i] for i in range(100, 141)} == {100} and {got[i] for i in range(500, 560)} == {500}
    assert got[1] == got[2] == got[3] == 1


def test_shards_are_even_ordered_and_whole(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(1000 + i, "hot copy of a text") for i in range(300)]
    rows += [(None, "null id"), (5, "again"), (5, "again")]
    got = sharding.assign(frame(spark, rows), 4).collect()
    assert Counter((r["doc_id"], r["text_crc32"]) for r in got) == Counter(
        (k, zlib.crc32((t or "").encode())) for k, t in rows)
    total, most = sum(r["size"] for r in got), max(r["size"] for r in got)
    for s in range(4):
        mine = [r for r in got if r["shard"] == s]
        assert sorted(r["slot"] for r in mine) == list(range(len(mine)))
        assert abs(sum(r["size"] for r in mine) - total / 4) <= most + 0.002 * total
    assert sharding.assign(frame(spark, []), 4).count() == 0
    assert len(sharding.assign(frame(spark, [(1, "x")]), 4).collect()) == 1


def jaccard(a, b):
    a, b = Counter(a.split()), Counter(b.split())
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def test_collision_rate_is_generalised_jaccard():
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{x}" for x in rng.zipf(1.6, 300) % 400) for _ in range(40)]
    sig = weighted_sampling.signatures([weighted_sampling.bag(t) for t in texts], 4096)
    error = [float((sig[i] == sig[j]).mean()) - jaccard(texts[i], texts[j]) for i in range(40) for j in range(i)]
    assert abs(np.mean(error)) < 0.02 and np.max(np.abs(error)) < 0.06


def test_error_of_the_returned_likeness():
    rng = np.random.default_rng(6)
    assert 0.5 / weighted_sampling.SAMPLES ** 0.5 < 0.056
    texts = [" ".join(f"w{x}" for x in rng.zipf(1.6, 300) % 400) for _ in range(40)]
    texts += [weighted_sampling.edited(a, b) for a, b in zip(texts, texts[1:])]
    sig = weighted_sampling.signatures([weighted_sampling.bag(t) for t in texts])
    error = [float((sig[i] == sig[j]).mean()) - jaccard(texts[i], texts[j])
             for i in range(len(texts)) for j in range(i)]
    assert np.sqrt(np.mean(np.square(error))) < 0.062 and np.max(np.abs(error)) < 0.25


def test_neighbours_match_brute_force(spark):
    rows = list(enumerate(TEXTS))
    got = {r["doc_id"]: r for r in weighted_sampling.neighbours(frame(spark, rows)).collect()}
    assert len(got) == len(rows)
    texts = [t or "" for t in TEXTS]
    for k, t in enumerate(texts):
        other = texts[(k + 1) % len(texts)]
        q = len(t) // 4
        new = t[:len(t) - q] + other[:q]
        r = got[k]
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), hashlib.sha256(new.encode()).hexdigest())
        sig = weighted_sampling.signatures([weighted_sampling.bag(x) for x in (t, new, other)])
        assert r["fingerprint"] == sig[0].astype(">u2").tobytes().hex()
        assert r["near_edited"] == (sig[0] == sig[1]).mean() and r["near_next"] == (sig[0] == sig[2]).mean()
    assert weighted_sampling.neighbours(frame(spark, [])).count() == 0
    lone = weighted_sampling.neighbours(frame(spark, [(None, "a lone text")])).collect()
    assert len(lone) == 1 and lone[0]["near_next"] == 1.0


def test_pipeline_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept = {r["doc_id"]: r["cleaned"] for r in quality.judge(docs.select("doc_id", "text")).collect() if r["kept"]}
    ids = sorted(kept)
    least = groups(ids, [fingerprint(kept[k]) for k in ids], 4)
    want = {k for k, c in zip(ids, least) if k == c}
    packed = corpus_pipeline.run(spark, SMALL).collect()
    assert {r["doc_id"] for r in packed} == want
    stage = spark.createDataFrame([(k, kept[k]) for k in sorted(want)], "doc_id long, text string")
    texts = {r["doc_id"]: r["text"] for r in pii.pseudonymise(stage, corpus_pipeline.PII_KEY).collect()}
    from tokenizers import Tokenizer
    import public_tokenizers

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for k in want:
        data = tok.encode(texts[k], add_special_tokens=False).ids + [0]
        mine = sorted((r for r in packed if r["doc_id"] == k), key=lambda r: r["piece"])
        assert sum(r["length"] for r in mine) == len(data)
        for r in mine:
            ids_here = np.array(data[r["start"]:r["start"] + r["length"]], "<u4")
            assert zlib.crc32(ids_here.tobytes()) == r["ids_crc32"]


def test_pipeline_stages_keep_the_columns_of_documents(spark):
    names = pq.read_schema(f"{SMALL}/documents.parquet").names
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SMALL).columns == names
        assert stage(spark, docs.limit(0), SMALL).count() == 0
    twice = docs.unionByName(docs)
    once = corpus_pipeline.near_dedup(spark, docs, SMALL)
    assert corpus_pipeline.near_dedup(spark, twice, SMALL).count() == once.count()


def test_pipeline_limits_the_documents_of_a_sequence(spark):
    docs = spark.createDataFrame([(i, "word") for i in range(100)], "doc_id long, text string")
    placed = corpus_pipeline.best_fit_packing(spark, docs, SMALL).collect()
    assert sorted(r["doc_id"] for r in placed) == list(range(100))
    assert max(Counter(r["sequence_id"] for r in placed).values()) <= 32


def test_every_query_is_registered_with_its_oracle():
    names = __spark_entry__.queries()
    assert "pipeline" in names
    assert {n.split("_")[0] for n in names if n.startswith("op")} >= {f"op{n}" for n in range(1, 11)}
    assert "op3_quality_rules" in __spark_entry__.oracle_sql()
