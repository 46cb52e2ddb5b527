"""Vector best-fit packing of documents into sequences (operator 1).

Every piece is a vector (tokens, 1 document, attention cost = tokens squared); a sequence has a capacity in each
dimension. Pieces go, longest first, into the open sequence that fits in every dimension with the smallest weighted
norm of the residual left (or the largest weighted dot product). A piece's vector depends on its length alone, so the
choice is made for runs of equal pieces over runs of equal sequences: the driver sees a histogram of at most
``max_tokens`` lengths, whatever the input's size, and returns placement steps. Each piece then finds its step by its
length and its rank among pieces of that length. Ranks come from counters per input partition plus offsets of the
partitions, so no length is gathered in one task.

Defined results: a null text is an empty one (its document is the end id alone); repeated rows are packed each; an
empty table gives no rows; columns besides id and text are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from bizlens.llm.tokens import encoder, slices
from bizlens.llm.work import written

#: Placement steps up to this number are broadcast (48 bytes each); more are joined by shuffle.
BROADCAST_STEPS = 100_000


def pieces(docs: DataFrame, tokenizer_path: str, max_tokens: int, end_id: int, with_ids: bool = False,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents as pieces of at most ``max_tokens`` ids, each ended by ``end_id``; the first piece may be short.

    ``part`` and ``rank`` number the pieces of equal length within their input partition.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    names = [id_col, "piece", "start", "length", "ids_crc32", "part", "rank"] + ["ids"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part_no = encoder(tokenizer_path), TaskContext.get().partitionId()
        seen = np.zeros(max_tokens + 1, np.int64)
        for batch in batches:
            for part in slices(batch, "t"):
                ids, at = enc.encode(part.column("t"))
                n = len(at) - 1
                ids = np.insert(ids, at[1:], end_id).astype("<u4")
                at = at + np.arange(n + 1)
                size = np.diff(at)
                count = -(-size // max_tokens)
                doc = np.repeat(np.arange(n), count)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
                first = size - (count - 1) * max_tokens
                start = np.where(piece == 0, 0, first[doc] + (piece - 1) * max_tokens)
                length = np.where(piece == 0, first[doc], max_tokens)
                order = np.argsort(length, kind="stable")
                _, begin, same = np.unique(length[order], return_index=True, return_counts=True)
                rank = np.empty(len(doc), np.int64)
                rank[order] = np.arange(len(doc)) - np.repeat(begin, same)
                rank += seen[length]
                seen += np.bincount(length, minlength=max_tokens + 1)
                lo = at[doc] + start
                data = memoryview(ids).cast("B")
                crc = [zlib.crc32(data[4 * a:4 * b]) for a, b in zip(lo.tolist(), (lo + length).tolist(), strict=True)]
                columns = [part.column("k").take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start),
                           pa.array(length), pa.array(crc, pa.int64()), pa.array(np.full(len(doc), part_no)),
                           pa.array(rank)]
                if with_ids:
                    ends = np.append(lo, len(ids)).astype(np.int64)
                    columns.append(pa.LargeListArray.from_arrays(ends, ids.astype(np.int32))
                                   .cast(pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = f"`{id_col}` {kind}, piece int, start long, length long, ids_crc32 long, part long, rank long"
    return docs.select(F.col(id_col).alias("k"), F.col(text_col).alias("t")).mapInArrow(
        run, schema + (", ids array<int>" if with_ids else ""))


def plan(histogram: dict[int, int], max_tokens: int, max_docs: int, max_cost: int,
         weights: tuple[float, float, float], by: str) -> list[tuple[int, int, int, int, int, int]]:
    """Steps (length, from rank, to rank, first sequence, pieces per sequence, offset) for a histogram of lengths.

    The pieces of a step fill consecutive sequences, ``pieces per sequence`` each, from the offset on. ``by`` is
    "norm" (least weighted norm of the residual after placing) or "dot" (largest weighted dot product with it).
    """
    if by not in ("norm", "dot"):
        raise ValueError(f"unknown selection {by!r}")
    cap = np.array([max_tokens, max_docs, max_cost], float)
    weight = np.array(weights, float)
    left = np.zeros((0, 3), np.int64)  # residual capacity of each run of equal sequences
    first, many = np.zeros(0, np.int64), np.zeros(0, np.int64)
    steps, bins = [], 0

    def add(residual, at, n):
        nonlocal left, first, many
        if n and residual.min() > 0:
            left, first, many = np.vstack([left, residual]), np.append(first, at), np.append(many, n)

    for length in sorted(histogram, reverse=True):
        item, m, rank = np.array([length, 1, length * length]), histogram[length], 0
        if (item > cap).any():
            raise ValueError(f"a piece of {length} tokens fits no empty sequence")
        while m:
            fits = np.flatnonzero((left >= item).all(axis=1))
            if len(fits):
                if by == "norm":
                    j = fits[np.argmin((((left[fits] - item) / cap) ** 2 * weight).sum(axis=1))]
                else:
                    j = fits[np.argmax((left[fits] / cap * (item / cap) * weight).sum(axis=1))]
                residual, at, n = left[j].copy(), int(first[j]), int(many[j])
                keep = np.arange(len(left)) != j
                left, first, many = left[keep], first[keep], many[keep]
            else:
                residual = np.array([max_tokens, max_docs, max_cost])
                n, at = -(-m // int((residual // item).min())), bins
                bins += n
            each = int((residual // item).min())
            offset = max_tokens - int(residual[0])
            full = min(n, m // each)
            if full:
                steps.append((length, rank, rank + full * each, at, each, offset))
                add(residual - each * item, at, full)
                rank, m = rank + full * each, m - full * each
            if full < n:
                if m:
                    steps.append((length, rank, rank + m, at + full, m, offset))
                    add(residual - m * item, at + full, 1)
                    full, m = full + 1, 0
                add(residual, at + full, n - full)
    return steps


def pack(items: DataFrame, max_tokens: int = 2048, max_docs: int | None = None, max_cost: int | None = None,
         weights: tuple[float, float, float] = (1.0, 0.1, 0.1), by: str = "norm") -> DataFrame:
    """Adds (sequence_id, offset) to a written table of pieces with length, part and rank.

    ``max_docs`` and ``max_cost`` default to the values at which they exclude nothing that the tokens admit.
    """
    spark = items.sparkSession
    counts = written(items.groupBy("part", "length").agg(F.count("*").alias("n")), "pack-counts")
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    # At most max_tokens rows come to the driver.
    histogram = {r[0]: r[1] for r in counts.groupBy("length").agg(F.sum("n")).collect()}
    steps = plan(histogram, max_tokens, max_docs or max_tokens, max_cost or max_tokens ** 2, weights, by)
    table = spark.createDataFrame(steps, "length long, lo long, hi long, seq long, each long, base long")
    if len(steps) <= BROADCAST_STEPS:
        table = F.broadcast(table)
    ranked = items.join(offsets, ["part", "length"]).withColumn("rank", F.col("rank") + F.col("before"))
    placed = ranked.join(table, "length").where("rank >= lo AND rank < hi")
    return (placed.withColumn("sequence_id", F.expr("seq + (rank - lo) div each"))
            .withColumn("offset", F.expr("base + (rank - lo) % each * length"))
            .drop("part", "rank", "before", "lo", "hi", "seq", "each", "base"))


def pack_documents(docs: DataFrame, tokenizer_path: str, max_tokens: int = 2048, end_id: int = 0,
                   with_ids: bool = False, **limits) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset (and ids, if wanted)."""
    items = written(pieces(docs, tokenizer_path, max_tokens, end_id, with_ids), "pack-pieces")
    out = pack(items, max_tokens, **limits)
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset",
                      *["ids"] * with_ids)


def sequences(placed: DataFrame) -> DataFrame:
    """(sequence_id, ids) of pieces packed ``with_ids``: a sequence holds at most ``max_tokens`` ids."""
    rows = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return placed.groupBy("sequence_id").agg(F.flatten(F.transform(rows, lambda r: r["ids"])).alias("ids"))
