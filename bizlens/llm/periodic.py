"""Periodic runs of words by a dictionary of basic factors (operator 11). One Arrow map: no shuffle.

A run is a stretch of words with smallest period q, at least ``min_length`` words and ``min_exponent`` periods long,
that no neighbouring word extends. For each power of two m every factor of m words gets a name, from the names of its
halves. Successor occurrences of a factor between m and 2m words apart are steps of an arithmetic progression and propose
their distance as a period: in a run of period q (m < q <= 2m) of three periods or more, some factor of m words stands
once per period, so its successor is exactly q away. Proposals are extended word by word to both sides; those that
grow into a stretch already found with the same period are left out. A proposed distance is the smallest period of
what it grows into: a smaller one would divide it and put an occurrence in between.

Factors that occur once in their text have no name, so upper levels hold repeated passages only. Texts are worked on
together, in slices of about ``SLICE`` words; a text longer than that is a slice by itself, and the memory needed is some
150 bytes a word of the longest text.

Defined results: a null or empty text has no runs and collapses to an empty text; repeated rows get the same result;
an empty table gives no rows; columns besides id and text are not read; a null id is kept.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

SLICE = 100_000
RUN = "struct<start: bigint, length: bigint, period: bigint>"


def _matching(x: np.ndarray, at: int, d: int, back: bool) -> int:
    """How many positions from ``at`` on (``back``: before ``at``) hold the word that stands ``d`` further."""
    total, width = 0, 32
    room = at if back else len(x) - d - at
    while total < room:
        w = min(width, room - total)
        lo = at - total - w if back else at + total
        unlike = np.flatnonzero(x[lo:lo + w] != x[lo + d:lo + d + w])
        if len(unlike):
            return total + int(w - 1 - unlike[-1] if back else unlike[0])
        total, width = total + w, 2 * width
    return total


def _extended(x: np.ndarray, starts: np.ndarray, gaps: np.ndarray, min_length: int, min_exponent: int) -> list[tuple]:
    """The runs (start, length, period) that the proposals (position, distance) grow into."""
    by = np.lexsort((starts, gaps))
    s, g = starts[by], gaps[by]
    first = np.ones(len(s), bool)
    first[1:] = (g[1:] != g[:-1]) | (s[1:] != s[:-1] + 1)
    s, g = s[first], g[first]
    # A run's matching positions around s are at least ``half * 2`` many, so they reach one of s - half, s + half.
    half = np.maximum(min_length - g, (min_exponent - 1) * g) // 2
    last = len(x) - 1
    before, after = s - half, s + half
    likely = (before >= 0) & (x[np.maximum(before, 0)] == x[np.clip(before + g, 0, last)])
    likely |= (after + g <= last) & (x[np.minimum(after, last)] == x[np.minimum(after + g, last)])
    found, end, period = [], -1, 0
    for a, d in zip(s[likely].tolist(), g[likely].tolist(), strict=True):
        if d == period and a < end:
            continue
        start = a - _matching(x, a, d, back=True)
        end, period = a + _matching(x, a, d, back=False), d
        length = end - start + d
        if length >= max(min_length, min_exponent * d):
            found.append((start, length, d))
    return found


def stretches(x: np.ndarray, longest: int, min_length: int, min_exponent: int) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of a sequence of numbers, by start and period; ``longest``: most words of a text.
    Different texts in ``x`` share no number."""
    if min_exponent < 3:
        raise ValueError("runs of less than three periods need not show in the factors")
    found: set[tuple[int, int, int]] = set()
    at, key, m = np.arange(len(x)), x, 1
    name = np.empty(len(x), np.int64)
    while len(at) > 1 and (m == 1 or m * min_exponent < longest):
        by = np.argsort(key, kind="stable")
        where, key = at[by], key[by]
        same = key[1:] == key[:-1]
        gap = where[1:] - where[:-1]
        pick = same & (gap <= 2 * m) & (gap > (0 if m == 1 else m))
        if pick.any():
            found.update(_extended(x, where[:-1][pick], gap[pick], min_length, min_exponent))
        repeated = np.zeros(len(where), bool)
        repeated[1:] = same
        repeated[:-1] |= same
        number = np.concatenate([[0], np.cumsum(~same)])
        name.fill(-1)
        name[where[repeated]] = number[repeated]
        at = np.flatnonzero((name[:-m] >= 0) & (name[m:] >= 0)) if m < len(x) else at[:0]
        key = name[at] * (int(number[-1]) + 1) + name[at + m]
        m *= 2
    return sorted(found, key=lambda r: (r[0], r[2]))


def _slices(texts: list[bytes | None]) -> Iterator[list[list[bytes]]]:
    some, total = [], 0
    for text in texts:
        words = (text or b"").split()  # bytes split at the six ASCII blanks only
        if some and total + len(words) > SLICE:
            yield some
            some, total = [], 0
        some.append(words)
        total += len(words)
    if some:
        yield some


def runs_of(texts: list[list[bytes]], min_length: int = 24, min_exponent: int = 3) -> list[list[tuple[int, int, int]]]:
    """The runs of each text (a list of words), by start and period."""
    numbers: dict[bytes, int] = defaultdict(count().__next__)
    lengths = np.array([len(w) for w in texts], np.int64)
    x = np.fromiter((numbers[w] for words in texts for w in words), np.int64, int(lengths.sum()))
    of = np.repeat(np.arange(len(texts)), lengths)
    x += of * (len(numbers) + 1)
    begins = np.cumsum(lengths) - lengths
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if len(x):
        for start, length, period in stretches(x, int(lengths.max()), min_length, min_exponent):
            i = int(of[start])
            out[i].append((start - int(begins[i]), length, period))
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by blanks without those behind the first period of a run."""
    if not runs:
        return b" ".join(words)
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period:start + length] = False
    return b" ".join([words[i] for i in np.flatnonzero(keep).tolist()])


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 24,
              min_exponent: int = 3) -> DataFrame:
    """(id, n_words, runs, collapsed): each text's runs by start and period, and the text without their repeats."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, runs, texts = [], [], []
            for some in _slices(batch.column("t").cast(pa.binary()).to_pylist()):
                for words, found in zip(some, runs_of(some, min_length, min_exponent), strict=True):
                    sizes.append(len(words))
                    runs.append(found)
                    texts.append(collapsed(words, found))
            flat = np.array([r for found in runs for r in found], np.int64).reshape(-1, 3)
            fields = pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], ["start", "length", "period"])
            ends = np.cumsum([0, *map(len, runs)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("i"), pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(pa.array(ends), fields),
                 pa.array(texts, pa.binary()).view(pa.utf8())], ["i", "n_words", "runs", "collapsed"])

    rows = docs.select(F.col(id_col).alias("i"), F.col(text_col).cast("string").alias("t"))
    out = rows.mapInArrow(run, f"i {id_type}, n_words bigint, runs array<{RUN}>, collapsed string")
    return out.select(F.col("i").alias(id_col), "n_words", "runs", "collapsed")


def strongest(runs: Column) -> Column:
    """The run of greatest exact length/period; ties: the first (smallest start, then period). Null without runs."""
    return F.aggregate(runs, F.get(runs, F.lit(0)), lambda best, r: F.when(
        r["length"] * best["period"] > best["length"] * r["period"], r).otherwise(best))


def listed(runs: Column) -> Column:
    """Every run as ``start,length,period`` and a line feed."""
    line = lambda r: F.concat_ws(",", *[r[f].cast("string") for f in ("start", "length", "period")])
    return F.array_join(F.transform(runs, lambda r: F.concat(line(r), F.lit("\n"))), "")
