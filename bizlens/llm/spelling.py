"""Spelling variants grouped by Bloom-guided neighbourhoods (operator 12).

Words are counted in one map (a counter per task) and one aggregate. Two words are near if they differ by one inserted,
deleted or replaced character. Every vocabulary word generates its one-character deletions (an insertion is the other
word's deletion) and its replacements by a later character of the vocabulary's alphabet (one by an earlier character is
the other word's), so each near pair is generated once. The edits are tested, as numbers only, against a broadcast
split-block Bloom filter of the edit's length; only positives become strings and go to an exact join with the
vocabulary, which removes the false ones.

Bounds: a filter takes 16 bits a word. Beyond ``FILTER_BYTES`` the vocabulary is cut by hash into slices, each with its own
filters and its own pass, so a broadcast never exceeds that size and no word is left out. The alphabet is at most the
code points of Unicode. A word's edits are worked on in steps of ``STEP`` positions, whatever its length. The root of
a word is found by pointer doubling over words that have a form; each round is written.

Defined results: a null or empty text has no words; repeated rows count again; without words that come often enough the
result is empty; columns besides id and text are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from bizlens.llm.work import written

#: Fixed value: what a word is made of.
LETTERS = "[a-zÀ-ÿ]"
MIN_LENGTH, MIN_COUNT, RATIO = 5, 3, 2
FILTER_BYTES = 16 << 20
BLOCK_BYTES, BITS_A_WORD = 32, 16
#: Lengths from here on share one filter.
LAST_SHARD = 48
STEP = 4096
#: Words a task of the probing gets.
WORDS_A_TASK = 20_000
#: Distinct words a counting task holds before it hands them on.
HELD = 200_000
#: Odd multipliers of the split-block filter, one a lane.
SALTS = np.array([0x47B6137B, 0x44974D91, 0x8824AD5B, 0xA2B7289D, 0x705495C7, 0x2DF1424B, 0x9EFC4947, 0x5C6BFB31],
                 np.uint32)


# ---------------------------------------------------------------------------------------------- words
def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
                changed: Callable[[object, str], str] | None = None) -> DataFrame:
    """(word, n): how often each word of at least ``min_length`` letters occurs; capitals A to Z are made small.
    ``changed`` (id, word) may give another word for a text's word."""
    pattern = f"{LETTERS}{{{min_length},}}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = re.compile(pattern)
        held: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.utf8()), pa.array(held.values(), pa.int64())],
                                              ["word", "n"])

        for batch in batches:
            texts = batch.column("t").cast(pa.binary())
            for i, text in zip(batch.column("i").to_pylist(), texts, strict=True):
                # small ASCII letters only: bytes know no others
                found = words.findall((text.as_py() or b"").lower().decode("utf-8", "replace"))
                for word, n in Counter(found).items():
                    new = changed(i, word) if changed else word
                    if len(new) >= min_length:
                        held[new] += n
                if len(held) > HELD:
                    yield out()
                    held.clear()
        yield out()

    rows = docs.select(F.col(id_col).alias("i"), F.col(text_col).cast("string").alias("t")).where("t IS NOT NULL")
    return rows.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


# ---------------------------------------------------------------------------------------------- hashing
def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _weights(n: int) -> np.ndarray:
    """An odd 64-bit weight for each place of a word."""
    return _mixed((np.arange(n, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(code points plus one of all words in a row, lengths)."""
    codes = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.uint64) + np.uint64(1)
    return codes, np.array([len(w) for w in words], np.int64)


def _places(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word number, place in the word) of every character of the words in a row."""
    of = np.repeat(np.arange(len(lengths)), lengths)
    return of, np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def word_sums(words: list[str]) -> np.ndarray:
    """The sum over each (non-empty) word of code times place weight, modulo 2^64."""
    codes, lengths = _codes(words)
    _, place = _places(lengths)
    return np.add.reduceat(codes * _weights(int(lengths.max()))[place], np.cumsum(lengths) - lengths)


def shard_of(lengths: np.ndarray) -> np.ndarray:
    return np.minimum(lengths, LAST_SHARD)


# ---------------------------------------------------------------------------------------------- filters
class Filters:
    """Split-block Bloom filters of one slice of the vocabulary, one for each word length."""

    def __init__(self, blocks_of: dict[int, int], slices: int, number: int):
        self.slices, self.number = slices, number
        n = np.zeros(LAST_SHARD + 1, np.int64)
        for shard, blocks in blocks_of.items():
            n[shard] = blocks
        self.blocks, self.first = n.astype(np.uint64), (np.cumsum(n) - n)
        self.lanes = np.zeros((int(n.sum()), 8), np.uint32)

    def in_slice(self, h: np.ndarray) -> np.ndarray:
        return (h >> np.uint64(8)) % np.uint64(self.slices) == np.uint64(self.number)

    def block(self, h: np.ndarray, shard: np.ndarray) -> np.ndarray:
        return self.first[shard] + (((h >> np.uint64(32)) * self.blocks[shard]) >> np.uint64(32)).astype(np.int64)

    @staticmethod
    def bits(h: np.ndarray, lane: int) -> np.ndarray:
        return np.uint32(1) << ((h.astype(np.uint32) * SALTS[lane]) >> np.uint32(27))

    def hits(self, sums: np.ndarray, shard: np.ndarray) -> np.ndarray:
        """Which sums (of edits of the shard's length) may stand in the vocabulary's slice: their positions."""
        at = np.flatnonzero(self.blocks[shard])
        h = _mixed(sums[at])
        if self.slices > 1:
            mine = self.in_slice(h)
            at, h = at[mine], h[mine]
        block = self.block(h, shard[at])
        for lane in range(8):
            kept = self.lanes[block, lane] & self.bits(h, lane) != 0
            at, h, block = at[kept], h[kept], block[kept]
        return at


def plan_filters(shards: dict[int, int], filter_bytes: int) -> tuple[int, dict[int, int]]:
    """(slices, blocks of each length's filter in a slice) for the numbers of words of each length."""
    need = sum(shards.values()) * BITS_A_WORD // 8 + len(shards) * BLOCK_BYTES
    slices = max(1, math.ceil(need / filter_bytes))
    return slices, {s: max(1, math.ceil(n * BITS_A_WORD / 8 / BLOCK_BYTES / slices)) for s, n in shards.items()}


def build_filters(vocabulary: DataFrame, empty: Filters) -> Filters:
    """The filters of a slice: blocks are put together by an aggregate, the driver gets at most the filter's bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column("word").to_pylist()
            if not words:
                continue
            h = _mixed(word_sums(words))
            mine = empty.in_slice(h)
            shard = shard_of(np.array([len(w) for w in words], np.int64))[mine]
            h = h[mine]
            pairs = [(empty.bits(h, i).astype(np.uint64) | (empty.bits(h, i + 1).astype(np.uint64) << np.uint64(32)))
                     for i in range(0, 8, 2)]
            yield pa.RecordBatch.from_arrays([pa.array(empty.block(h, shard)), *[pa.array(p.view(np.int64)) for p in pairs]],
                                             ["b", "l0", "l1", "l2", "l3"])

    parts = vocabulary.select("word").mapInArrow(run, "b bigint, l0 bigint, l1 bigint, l2 bigint, l3 bigint")
    blocks = parts.groupBy("b").agg(*[F.bit_or(f"l{i}").alias(f"l{i}") for i in range(4)]).toArrow()
    at = blocks["b"].to_numpy()
    for i in range(4):
        pair = blocks[f"l{i}"].to_numpy().astype(np.int64).view(np.uint64)
        empty.lanes[at, 2 * i] = pair.astype(np.uint32)
        empty.lanes[at, 2 * i + 1] = (pair >> np.uint64(32)).astype(np.uint32)
    return empty


# ---------------------------------------------------------------------------------------------- neighbourhoods
def positives(words: list[str], alphabet: np.ndarray, filters: Filters) -> Iterator[tuple[int, str]]:
    """(word number, edit) of every deletion and every replacement by a later letter that passes the filters."""
    codes, lengths = _codes(words)
    of, place = _places(lengths)
    weights = _weights(int(lengths.max()) + 1)
    terms = codes * weights[place]
    ends = np.cumsum(lengths)
    sums = np.add.reduceat(terms, ends - lengths)
    # Without a character the following ones move one place to the front.
    before = np.cumsum(terms) - terms
    moved = codes * weights[np.maximum(place - 1, 0)]
    behind = np.cumsum(moved)
    start = ends - lengths
    shorter = before - before[start][of] + behind[ends - 1][of] - behind
    # A character equal to the one before gives the same deletion.
    again = (place > 0) & (codes == np.roll(codes, 1))
    once = np.flatnonzero(~again & (lengths[of] > 1))
    for i in once[filters.hits(shorter[once], shard_of(lengths[of[once]] - 1))].tolist():
        w, p = int(of[i]), int(place[i])
        yield w, words[w][:p] + words[w][p + 1:]
    letters = alphabet.astype(np.uint64) + np.uint64(1)
    for lo in range(0, len(codes), STEP):
        c, o, p = codes[lo:lo + STEP, None], of[lo:lo + STEP], place[lo:lo + STEP]
        new = sums[o][:, None] + (letters[None, :] - c) * weights[p][:, None]
        later = np.flatnonzero((letters[None, :] > c).reshape(-1))
        which = later // len(letters)
        for i in later[filters.hits(new.reshape(-1)[later], shard_of(lengths[o[which]]))].tolist():
            j, letter = divmod(i, len(letters))
            w, at = int(o[j]), int(p[j])
            yield w, words[w][:at] + chr(int(alphabet[letter])) + words[w][at + 1:]


def near_pairs(vocabulary: DataFrame, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """(word, n, near, near_n): every pair of near words of the vocabulary (word, n; distinct, not empty), once."""
    spark = vocabulary.sparkSession
    vocabulary = vocabulary.where("word <> ''").select("word", "n")
    shards = {r["s"]: r["c"] for r in vocabulary.groupBy(F.least(F.length("word"), F.lit(LAST_SHARD)).alias("s"))
              .agg(F.count("*").alias("c")).collect()}
    chars = vocabulary.select(F.explode(F.split("word", "")).alias("c")).where("c <> ''").distinct().collect()
    alphabet = np.array(sorted(ord(r["c"]) for r in chars), np.int64)
    slices, blocks = plan_filters(shards, filter_bytes)
    tasks = max(1, math.ceil(sum(shards.values()) / WORDS_A_TASK))
    found = None
    for number in range(slices):
        filters = spark.sparkContext.broadcast(build_filters(vocabulary, Filters(blocks, slices, number)))

        def run(batches: Iterator[pa.RecordBatch], filters=filters) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for lo in range(0, whole.num_rows, STEP):
                    batch = whole.slice(lo, STEP)
                    words, n = batch.column("word").to_pylist(), batch.column("n").to_pylist()
                    some = list(positives(words, alphabet, filters.value))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([e for _, e in some], pa.utf8()), pa.array([words[w] for w, _ in some], pa.utf8()),
                         pa.array([n[w] for w, _ in some], pa.int64())], ["edit", "word", "n"])

        probes = vocabulary.repartition(tasks, "word").mapInArrow(run, "edit string, word string, n bigint")
        known = vocabulary.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
        pairs = probes.join(known, F.col("edit") == F.col("near")).select("word", "n", "near", "near_n")
        pairs = written(pairs, "spelling-pairs")
        found = pairs if found is None else found.unionByName(pairs)
    return found


# ---------------------------------------------------------------------------------------------- forms and roots
def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the last word that forms lead to, by pointer doubling; (word, form) lead to more frequent words."""
    now = written(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        to = now.select(F.col("word").alias("_w"), F.col("root").alias("_r"))
        step = now.join(to, now["root"] == to["_w"], "left")
        step = written(step.select("word", F.coalesce("_r", "root").alias("root"), F.col("_r").isNotNull().alias("moved")),
                       "spelling-roots")
        now = step.select("word", "root")
        if step.where("moved").isEmpty():
            return now


def variants(vocabulary: DataFrame, ratio: int = RATIO, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word of the vocabulary (word, n): how many words are near, the
    most frequent of them (ties: the smallest) if it is at least ``ratio`` times as frequent, and where forms end."""
    vocabulary = written(vocabulary.select("word", "n"), "spelling-vocabulary")
    pairs = near_pairs(vocabulary, filter_bytes)
    both = pairs.unionByName(pairs.select(F.col("near").alias("word"), F.col("near_n").alias("n"),
                                          F.col("word").alias("near"), F.col("n").alias("near_n")))
    best = both.groupBy("word", "n").agg(F.count("*").alias("n_near"),
                                         F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near").alias("w"))).alias("b"))
    fits = -F.col("b.m") >= ratio * F.col("n")
    best = written(best.select("word", "n_near", F.when(fits, F.col("b.w")).alias("form"),
                               F.when(fits, -F.col("b.m")).alias("form_n")), "spelling-forms")
    last = roots(best.where("form IS NOT NULL"))
    rows = vocabulary.join(best, "word", "left").join(last, "word", "left")
    return rows.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form", "form_n",
                       F.coalesce("root", "word").alias("root"))
