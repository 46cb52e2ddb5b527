"""Bounds of memory, exchanges, clashing columns, and the Feistel network against plain Python."""

import hashlib
import random
import re

import public_tokenizers
import pyarrow as pa
import pytest

from bizlens.llm import licences, pii, quality, sharding, tokens
from tests.llm.test_text_rules import frame


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_the_memo_is_bounded_by_bytes(monkeypatch, name):
    """100,000 distinct fragments without a place to cut, long and short, stay under the stated bound."""
    monkeypatch.setattr(tokens, "MEMO_BYTES", 2 << 20)
    enc, rng, most = tokens.Encoder(public_tokenizers.path(name)), random.Random(1), 0
    for _ in range(20):
        texts = ["".join(chr(rng.randint(0x4E00, 0x9FFF)) for _ in range(n)) for n in [3] * 4900 + [200] * 100]
        ids, at = enc.encode(pa.array(texts))
        want = enc.tokenizer.encode(texts[-1], add_special_tokens=False).ids
        assert ids[at[-2]:at[-1]].tolist() == want
        assert all(len(w) <= tokens.KEPT_BYTES for w in enc.memo)
        assert enc.held >= sum(len(w) * 4 + len(v) for w, v in enc.memo.items())
        most = max(most, enc.held)
    assert most < (2 << 20) + 5000 * (tokens.ENTRY_BYTES + 8 * 3) and len(enc.memo) < 20_000


def test_shards_are_exchanged_by_the_counted_splitters(spark):
    rows = [(i, f"text {i % 700} " + "w " * (i % 40)) for i in range(2000)]
    df = frame(spark, rows_of(rows))
    plans = []
    real = sharding.written
    sharding.written = lambda d, n: (plans.append((n, d._jdf.queryExecution().executedPlan().toString())), real(d, n))[1]
    try:
        got = sharding.assign(df, 4).collect()
    finally:
        sharding.written = real
    plan = dict(plans)["shard-rows"]
    assert "rangepartitioning" not in plan and plan.count("Exchange hashpartitioning(piece") == 1
    for s in range(4):
        mine = sorted((r["slot"], r["doc_id"]) for r in got if r["shard"] == s)
        assert [m[0] for m in mine] == list(range(len(mine)))
    shards = {}
    for r in got:
        shards.setdefault(r["text_crc32"], set()).add(r["shard"])
    assert sum(len(s) > 1 for s in shards.values()) <= 3


def rows_of(rows):
    return [t for _, t in rows]


def feistel(symbols, radices, form, key):
    half, state = (len(symbols) + 1) // 2, list(symbols)
    for rnd in range(8):
        left = rnd % 2 == 0
        other = state[half:] if left else state[:half]
        digest = hashlib.sha256(f"{key}|{form}|{rnd}|{','.join(map(str, other))}".encode()).hexdigest()
        turn = [int(hashlib.sha256(f"{digest}|{i}".encode()).hexdigest()[:15], 16) for i in range(len(state))]
        state = [(s + t) % r if (i < half) == left else s for i, (s, t, r) in enumerate(zip(state, turn, radices, strict=True))]
    return state


def plain(kind, value, key):
    """The pseudonym of an address, a token or a social security number, by plain Python."""
    if kind == "ip":
        symbols, radices = list(map(int, value.split("."))), [256] * 4
    elif kind == "ssn":
        a, g, s = map(int, value.split("-"))
        symbols, radices = [a - (2 if a > 666 else 1), g - 1, s - 1], [898, 99, 9999]
    else:
        body = value.rsplit(".", 1)[0] if kind == "email" else value.split("=", 1)[1]
        small = [(ord(c) - 48, 10, "0") if c.isdigit() else (ord(c) - 97, 26, "a") if "a" <= c <= "z" else
                 (ord(c) - 65, 26, "A") if "A" <= c <= "Z" else (0, 1, c) for c in body]
        symbols, radices = [x[0] for x in small], [x[1] for x in small]
    out = feistel(symbols, radices, f"{kind}:{','.join(map(str, radices))}", key)
    if kind == "ip":
        return ".".join(map(str, out))
    if kind == "ssn":
        a = out[0] + (2 if out[0] >= 665 else 1)
        return f"{a:03d}-{out[1] + 1:02d}-{out[2] + 1:04d}"
    new = "".join(chr(ord(x[2]) + o) if x[1] > 1 else x[2] for x, o in zip(small, out, strict=True))
    return new + "." + value.rsplit(".", 1)[1] if kind == "email" else value.split("=")[0] + "=" + new


def test_pseudonyms_match_a_plain_network(spark):
    rng = random.Random(3)
    values = []
    for _ in range(60):
        values.append(("ip", ".".join(str(rng.randint(0, 255)) for _ in range(4))))
        values.append(("ssn", f"{rng.choice([1, 665, 667, 899, 123]):03d}-{rng.randint(1, 99):02d}-{rng.randint(1, 9999):04d}"))
        values.append(("email", f"u{rng.randint(0, 999)}.Ana_{rng.randint(0, 9)}@m{rng.randint(0, 99)}-x.example.org"))
        values.append(("secret", "token=" + "".join(rng.choice("GhijZ019-") for _ in range(rng.randint(8, 40))) + "Zz"))
    got = [r["text"] for r in pii.pseudonymise(frame(spark, [f"x {v} y" for _, v in values]), "k7").orderBy("doc_id").collect()]
    assert got == [f"x {plain(kind, v, 'k7')} y" for kind, v in values]


def test_results_replace_columns_of_their_name(spark):
    text = "A clean text stands here under the MIT license. It has more than ten words, and it ends well."
    df = frame(spark, [text]).selectExpr("doc_id", "text", "'a' AS n_words", "'b' AS kept", "'c' AS labels", "'d' AS source",
                                         "'e' AS score", "'f' AS cleaned")
    judged, scanned = quality.judge(df).first(), licences.scan(df).first()
    assert judged["n_words"] == 19 == len(re.findall(r"\S+", text)) and judged["kept"] is True and judged["cleaned"] == text
    assert (judged["labels"], judged["source"], judged["score"]) == ("c", "d", "e")
    assert scanned["labels"] == "mit" and scanned["n_words"] == 19 and scanned["score"] > 0
    assert (scanned["kept"], scanned["source"], scanned["cleaned"]) == ("b", "d", "f")
