"""Document fingerprints by consistent weighted sampling (operator 9).

A text is a bag of words weighted by their counts. For each of ``SAMPLES`` samples and each word, r and c are drawn from
Gamma(2, 1) and b from the uniform distribution, all from the word's hash; with t = floor(ln w / r + b) the word with
least ln c - r (t - b) - r is the sample, and (word, t) its value. Two texts share a sample's value with probability
equal to the generalised Jaccard similarity of their weights. A fingerprint keeps 16 bits per sample.

The query compares each text with an edited text made from its neighbour in id order: rows are exchanged once by range of
the id and sorted; each task streams its rows, and only the first and last text of each partition are joined again.

Defined results: a null text is an empty one; a text without words has a fingerprint of zeros, like itself only;
repeated rows are neighbours in order of text, then position; a null id sorts first; a single row is its own next one;
an empty table gives no rows; columns besides id and text are not read.
"""

from __future__ import annotations

import hashlib
import itertools
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from bizlens.llm.work import written

SAMPLES = 80
#: Texts and characters fingerprinted at once: bounds of memory.
TEXTS_AT_ONCE = 1000
CHARS_AT_ONCE = 4_000_000


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit numbers (fixed constants of the usual finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _uniform(words: np.ndarray, sample: int, draw: int) -> np.ndarray:
    step = np.uint64((sample * 5 + draw + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    return ((_mix(words + step) >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53


def signatures(bags: list[dict[bytes, int]], samples: int = SAMPLES) -> np.ndarray:
    """uint16 [texts, samples] for bags of weighted words; zeros for an empty bag."""
    from xxhash import xxh64_intdigest

    out = np.zeros((len(bags), samples), np.uint16)
    full = [k for k, b in enumerate(bags) if b]
    if not full:
        return out
    places: dict[tuple[bytes, int], int] = defaultdict(itertools.count().__next__)
    codes = np.fromiter((places[x] for k in full for x in bags[k].items()), np.int64)
    starts = np.concatenate([[0], np.cumsum([len(bags[k]) for k in full])[:-1]])
    index: dict[bytes, int] = {}  # a word's draws do not depend on its count
    word = np.fromiter((index.setdefault(w, len(index)) for w, _ in places), np.int64)
    hashes = np.array([xxh64_intdigest(w) for w in index], np.uint64)
    words = hashes[word]
    log_w = np.log(np.array([c for _, c in places], np.float64))
    for s in range(samples):
        r = -np.log(_uniform(hashes, s, 0) * _uniform(hashes, s, 1))[word]
        log_c = np.log(-np.log(_uniform(hashes, s, 2) * _uniform(hashes, s, 3)))[word]
        b = _uniform(hashes, s, 4)[word]
        t = np.floor(log_w / r + b)
        rank = (log_c - r * (t - b) - r).astype(np.float32).view(np.uint32)
        # Unsigned order of the bits is the order of the numbers; the sample's value rides along below.
        order = np.where(rank >> 31, ~rank, rank | np.uint32(1 << 31)).astype(np.uint64)
        value = _mix(words ^ _mix(t.astype(np.int64).view(np.uint64) + np.uint64(s))) & np.uint64(0xFFFFFFFF)
        least = np.minimum.reduceat((order << np.uint64(32) | value)[codes], starts)
        out[full, s] = (least & np.uint64(0xFFFF)).astype(np.uint16)
    return out


def bag(text: str) -> dict[bytes, int]:
    return Counter(text.encode("utf-8", "surrogatepass").split())


def edited(text: str, other: str) -> str:
    """``text`` with its last quarter replaced by as much of the other text's start (or all of it)."""
    q = len(text) // 4
    return text[:len(text) - q] + other[:q]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal samples, row by row."""
    return (a == b).mean(axis=1)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint) of each row, in one map."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
                part = batch.slice(at, TEXTS_AT_ONCE)
                sig = signatures([bag(t or "") for t in part.column("t").to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column("k"), pa.array(map(_hex, sig), pa.string())],
                                                 ["k", "fingerprint"])

    out = docs.select(F.col(id_col).alias("k"), F.col(text_col).alias("t")).mapInArrow(
        run, f"k {kind}, fingerprint string")
    return out.withColumnRenamed("k", id_col)


def _hex(signature: np.ndarray) -> str:
    return signature.astype(">u2").tobytes().hex()


_RESULT = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                     ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
                     ("near_edited", pa.float64()), ("near_next", pa.float64())])
_SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
           "near_edited double, near_next double")


def _compared(ids: list, texts: list[str]) -> pa.RecordBatch:
    """Result rows of all texts but the last, each compared with the one behind it."""
    changed = [edited(a, b) for a, b in zip(texts[:-1], texts[1:], strict=True)]
    both = signatures([bag(t) for t in [*texts, *changed]])  # at once: the two share most of their words
    own, other = both[:len(texts)], both[len(texts):]
    n = len(changed)
    return pa.RecordBatch.from_arrays([
        pa.array(ids[:n], pa.int64()), pa.array([len(t) for t in texts[:n]], pa.int64()),
        pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in changed], pa.string()),
        pa.array(map(_hex, own[:n]), pa.string()), pa.array(map(_hex, other), pa.string()),
        pa.array(likeness(own[:n], other)), pa.array(likeness(own[:n], own[1:]))], schema=_RESULT)


def neighbours(docs: DataFrame) -> DataFrame:
    """Each document against its edited text and its next document in ascending id order."""
    rows = docs.select(F.col("doc_id").cast("long").alias("k"), F.coalesce("text", F.lit("")).alias("t"),
                       F.xxhash64("text").alias("h"), F.monotonically_increasing_id().alias("p"))
    ordered = rows.repartitionByRange("k", "h", "p").sortWithinPartitions("k", "h", "p").select("k", "t")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, ids, texts, first = TaskContext.get().partitionId(), [], [], True

        def ends(kind: str, key, text: str) -> pa.RecordBatch:
            nulls = [pa.nulls(1, f.type) for f in _RESULT]
            return full(pa.RecordBatch.from_arrays([pa.array([key], pa.int64()), *nulls[1:]], schema=_RESULT),
                        kind, [text])

        def full(rows: pa.RecordBatch, kind: str, text: list) -> pa.RecordBatch:
            n = rows.num_rows
            return pa.RecordBatch.from_arrays(
                [*rows.columns, pa.array([part] * n, pa.int64()), pa.array([kind] * n, pa.string()),
                 pa.array(text, pa.string())], [*_RESULT.names, "part", "kind", "text"])

        size = 0
        for batch in batches:
            for k, t in zip(batch.column("k").to_pylist(), batch.column("t").to_pylist(), strict=True):
                if first:
                    yield ends("first", k, t)
                    first = False
                ids.append(k)
                texts.append(t)
                size += len(t)
                if len(texts) > TEXTS_AT_ONCE or size > CHARS_AT_ONCE and len(texts) > 1:
                    done = _compared(ids, texts)
                    yield full(done, "row", [None] * done.num_rows)
                    ids, texts, size = ids[-1:], texts[-1:], len(texts[-1])
        if len(texts) > 1:
            done = _compared(ids, texts)
            yield full(done, "row", [None] * done.num_rows)
        if texts:
            yield ends("last", ids[-1], texts[-1])

    made = written(ordered.mapInArrow(run, f"{_SCHEMA}, part long, kind string, text string"), "cws-rows")
    # Two texts per partition are left: each partition's last row meets the first row of the next partition.
    lasts = made.where("kind = 'last'").select("part", "doc_id", "text")
    heads = made.where("kind = 'first'").select(F.col("part").alias("next"), F.col("text").alias("next_text"))
    whole = Window.orderBy("part")
    order = lasts.select("part", F.coalesce(F.lead("part").over(whole), F.first("part").over(whole)).alias("next"))
    pairs = lasts.join(order, "part").join(heads, "next").select("doc_id", "text", "next_text")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield _compared([row["doc_id"], None], [row["text"], row["next_text"]])

    return made.where("kind = 'row'").select(*_RESULT.names).unionByName(pairs.mapInArrow(finish, _SCHEMA))
