"""Operators 1, 2 and 4 against the tokenizers library, and their building blocks."""

import hashlib
import io
import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from bizlens.llm import bpe, packing, token_files
from bizlens.llm.tokens import encoder

BYTE, WORD = P.path("byte_bpe_50k.json"), P.path("word_bpe_49k.json")
ATOMS = ["'", "s", "S", "re", " ", "\n", "  ", "\t", "a", "Zq", "qz", "é", "É", "é", "ß", "İ", "Σ", "!", "{", "~",
         ".", ",", "1", "23", "’", "x", "<|endoftext|>", "<|startoftext|>", "<|", "</w>", "\x00", "日本", "😀", "̸",
         "²", "\x1c", "\x85", "\xa0", "||", "µ", "ª", "É,", "ñ."]
TEXTS = [None, "", " ", "\n", "word", "same text", "same text", "a" * 9000, "long words here. " * 3000, "é " * 5000,
         "token <|endoftext|> inside", "don't stop, it's {~} Zq'sqz"]


def library(path, text):
    return Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_fragments_give_the_library_ids(path):
    rng = random.Random(7)
    texts = ["".join(rng.choice(ATOMS) for _ in range(rng.randint(0, 25))) for _ in range(4000)] + [t or "" for t in TEXTS]
    ids, at = encoder(path).encode(pa.array(texts))
    want = [e.ids for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == want


def frame(spark, texts):
    rows = [(i, t, "clash", 1) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, length int")


def test_round_trip_matches_library(spark):
    tok = Tokenizer.from_file(WORD)
    got = {r["doc_id"]: r for r in bpe.round_trip(frame(spark, TEXTS), WORD).collect()}
    assert len(got) == len(TEXTS)
    for k, t in enumerate(TEXTS):
        ids = library(WORD, t)
        decoded = tok.decode(ids, skip_special_tokens=False)
        assert got[k]["n_tokens"] == len(ids)
        assert got[k]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[k]["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()
    assert bpe.round_trip(frame(spark, []), WORD).count() == 0
    lists = {r["doc_id"]: r["ids"] for r in bpe.encode_texts(frame(spark, TEXTS), WORD).collect()}
    assert all(lists[k] == library(WORD, t) for k, t in enumerate(TEXTS))


@pytest.mark.parametrize("limits", [{}, {"max_docs": 3}, {"max_cost": 3000}, {"by": "dot"}, {"max_docs": 2, "by": "dot"}])
def test_packing_keeps_every_constraint_and_every_id(spark, limits):
    top = 64
    docs = frame(spark, TEXTS + ["few words", "some more words than before"] * 40)
    if "max_cost" in limits:
        limits = {"max_cost": top * top + limits["max_cost"]}
    rows = packing.pack_documents(docs, BYTE, top, 0, with_ids=True, **limits).collect()
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_seq.setdefault(r["sequence_id"], []).append(r)
    for k, t in enumerate(TEXTS):
        want = library(BYTE, t) + [0]
        mine = sorted(by_doc[k], key=lambda r: r["piece"])
        assert [r["piece"] for r in mine] == list(range(len(mine)))
        assert [i for r in mine for i in r["ids"]] == want
        assert all(r["length"] == top for r in mine[1:])
        for r in mine:
            assert want[r["start"]:r["start"] + r["length"]] == r["ids"]
            assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"]
    for group in by_seq.values():
        at = 0
        for r in sorted(group, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= top
        assert len(group) <= limits.get("max_docs", top)
        assert sum(r["length"] ** 2 for r in group) <= limits.get("max_cost", top * top)
    if not limits:
        total = sum(r["length"] for r in rows)
        assert len(by_seq) <= -(-total // top) + 2


def test_packed_sequences_hold_their_pieces(spark):
    placed = packing.pack_documents(frame(spark, TEXTS), BYTE, 128, 0, with_ids=True)
    whole = {r["sequence_id"]: r["ids"] for r in packing.sequences(placed).collect()}
    for r in placed.collect():
        assert whole[r["sequence_id"]][r["offset"]:r["offset"] + r["length"]] == r["ids"]


def test_packing_edge_tables(spark):
    assert packing.pack_documents(frame(spark, []), BYTE).count() == 0
    one = packing.pack_documents(frame(spark, [None]), BYTE).collect()
    assert [(r["piece"], r["length"], r["offset"]) for r in one] == [(0, 1, 0)]
    with pytest.raises(ValueError):
        packing.plan({10: 1}, 8, 8, 64, (1, 1, 1), "norm")


def test_plan_places_each_piece_once():
    rng = random.Random(3)
    histogram = {n: rng.randint(1, 30) for n in range(1, 65)}
    steps = packing.plan(dict(histogram), 64, 64, 4096, (1.0, 0.1, 0.1), "norm")
    for n, m in histogram.items():
        spans = sorted((a, b) for size, a, b, *_ in steps if size == n)
        assert spans[0][0] == 0 and spans[-1][1] == m
        assert all(x[1] == y[0] for x, y in zip(spans, spans[1:]))


@pytest.mark.parametrize("top", [1, 15, 255, 256, 50256, 2 ** 31])
def test_any_id_is_read_by_position(top):
    rng = np.random.default_rng(top % 97)
    ids = rng.integers(0, top + 1, 5000).astype(np.uint32)
    ids[::3] >>= np.uint32(6)
    raw = token_files.dump(ids, np.arange(2), np.zeros(2, bool), np.array([0, 17, 5000]))
    file = token_files.TokenFile(io.BytesIO(raw))
    for lo, hi in [(0, 5000), (0, 0), (4999, 5000), (511, 513), (17, 1041), (3, 4)]:
        assert (file.ids(lo, hi) == ids[lo:hi]).all()
    for i in range(0, 5000, 371):
        assert file.ids(i, i + 1)[0] == ids[i]
    assert file.documents()[2].tolist() == [0, 17, 5000]


def test_token_files_read_back_what_was_written(spark):
    rows = [(5, "b c"), (3, None), (None, "null id"), (4, ""), (3, "twin"), (3, "twin")]
    rows += [(10 + i, t) for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame([(k, t, "x") for k, t in rows], "doc_id long, text string, n_ids string")
    got = token_files.token_file_round_trip(docs, BYTE, 2).orderBy("start").collect()
    assert len(got) == len(rows)
    assert [r["doc_id"] for r in got] == [None] + sorted(k for k, _ in rows if k is not None)
    assert all(b["start"] == a["start"] + a["n_tokens"] for a, b in zip(got, got[1:]))
    want = {(k, zlib.crc32(np.array(library(BYTE, t) + [2], "<u4").tobytes())) for k, t in rows}
    assert {(r["doc_id"], r["ids_crc32"]) for r in got} == want
    assert token_files.token_file_round_trip(docs.limit(0), BYTE, 2).count() == 0
