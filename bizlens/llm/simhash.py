"""SimHash near-duplicates by the generalised pigeonhole principle (operator 8).

Fingerprints are worked out in one map; equal ones are one class from there on. Bits that go together over all classes
are put into the same part. With thresholds t_i, sum(t_i + 1) = distance + 1, two fingerprints within the distance agree
to within t_i bits in some part i. How many parts and which thresholds: a dynamic program over the expected probes and
candidates, from the bit frequencies of all classes. Each class probes, in each part, the values within the part's
threshold; candidates meet in one equi-join whose condition verifies the whole distance, so only links leave it.
Links run between classes; documents get their class's component.

The driver sees 64 bit counts and 2,016 bit-pair counts, whatever the input's size.

Defined results: a null text is an empty one; a text without words has fingerprint zero, linked like any other; fewer
words than a shingle are one shingle; repeated rows get the same fingerprint; a null id is ignored as a component's
smallest; an empty table gives no rows; columns besides id and text are not read.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from bizlens.llm.components import components
from bizlens.llm.work import written

BITS = 64
#: Relative cost of a probe row and of a candidate compared in the join.
PROBE_COST, CANDIDATE_COST = 1.0, 0.02


def text_fingerprint(text: str, shingle: int) -> int:
    from xxhash import xxh64_intdigest

    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    n = max(1, len(words) - shingle + 1)
    starts = np.concatenate([[0], ends[:-1] + 1])[:n].tolist()
    stops = ends[min(shingle, len(words)) - 1:].tolist()
    hashes = [xxh64_intdigest(joined[a:b], 42) for a, b in zip(starts, stops, strict=True)]
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, 1 << 16):  # bounded memory for very long texts
        part = np.array(hashes[at:at + (1 << 16)], "<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text",
                 carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, fp, carried columns): the fingerprint of each row as a signed 64-bit number."""
    kept = docs.select(id_col, *carry).schema
    names = [f"c{i}" for i in range(len(kept))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([text_fingerprint(t or "", shingle) for t in batch.column("t").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(fps.view(np.int64))], [*names, "fp"])

    columns = [F.col(f.name).alias(n) for f, n in zip(kept, names, strict=True)]
    out = docs.select(F.col(text_col).alias("t"), *columns).mapInArrow(run, ", ".join(
        [f"{n} {f.dataType.simpleString()}" for f, n in zip(kept, names, strict=True)] + ["fp long"]))
    return out.select(F.col("c0").alias(id_col), "fp", *[F.col(n).alias(c) for n, c in zip(names[1:], carry, strict=True)])


def bit_counts(classes: DataFrame) -> tuple[int, np.ndarray]:
    """(n, together): how many classes there are, and how many have both of two bits set (64 x 64, exact)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        together, n = np.zeros((BITS, BITS), np.int64), 0
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            bits = np.unpackbits(fps.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float64)
            together += (bits.T @ bits).astype(np.int64)
            n += len(fps)
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([together.reshape(-1).tolist()])], ["n", "c"])

    rows = classes.select("fp").mapInArrow(run, "n long, c array<long>")
    total = rows.agg(F.sum("n")).first()[0] or 0
    summed = rows.select(F.posexplode("c")).groupBy("pos").agg(F.sum("col").alias("c")).collect()
    together = np.zeros(BITS * BITS, np.int64)
    for pos, c in summed:
        together[pos] = c
    return total, together.reshape(BITS, BITS)


def group_bits(n: int, together: np.ndarray, parts: int) -> list[list[int]]:
    """Parts of near-equal size; each starts with a free bit and takes the free bits that correlate most with it."""
    p = together.diagonal() / max(1, n)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs(together / max(1, n) - np.outer(p, p)) / np.outer(spread, spread)
    np.fill_diagonal(corr, 0)
    free, out = set(range(BITS)), []
    for k in range(parts):
        size = BITS // parts + (k < BITS % parts)
        part = [max(free, key=lambda b: (corr[b, sorted(free)].sum(), -b))]
        free -= {part[0]}
        while len(part) < size:
            best = max(free, key=lambda b: (corr[b, part].sum(), -b))
            part.append(best)
            free -= {best}
        out.append(sorted(part))
    return out


def within(part: list[int], p: np.ndarray, most: int) -> list[float]:
    """Chance that two independent fingerprints differ in at most 0, 1, ... ``most`` bits of the part."""
    dist = np.zeros(len(part) + 1)
    dist[0] = 1.0
    for b in part:
        q = 2 * p[b] * (1 - p[b])
        dist[1:] = dist[1:] * (1 - q) + dist[:-1] * q
        dist[0] *= 1 - q
    return np.cumsum(dist)[:most + 1].tolist()


def allocate(n: int, together: np.ndarray, distance: int) -> list[tuple[list[int], int]]:
    """(bits, threshold) per part, at least expected cost; parts with threshold -1 are not probed and left out."""
    p = together.diagonal() / max(1, n)
    best: tuple[float, list[tuple[list[int], int]]] = (math.inf, [])
    for parts in range(1, distance + 2):
        groups = group_bits(n, together, parts)
        # cost[u]: least cost so far with u = sum of (threshold + 1)
        cost: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
        for bits in groups:
            chance = within(bits, p, distance)
            new: dict[int, tuple[float, list[int]]] = {}
            for used, (c, chosen) in cost.items():
                for t in range(-1, distance - used + 1):
                    probes = sum(math.comb(len(bits), d) for d in range(t + 1))
                    more = (n + 1) * probes * PROBE_COST + (n * n * chance[t] * CANDIDATE_COST if t >= 0 else 0)
                    if c + more < new.get(used + t + 1, (math.inf, []))[0]:
                        new[used + t + 1] = (c + more, [*chosen, t])
            cost = new
        total, chosen = cost[distance + 1]
        if total < best[0]:
            best = (total, [(g, t) for g, t in zip(groups, chosen, strict=True) if t >= 0])
    return best[1]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def links(classes: DataFrame, distance: int, node: str = "fp") -> DataFrame:
    """(u, v): every pair of distinct fingerprints that differ in at most ``distance`` bits, u < v.

    ``node`` names the column that is returned for the fingerprints (the order of u and v stays that of the fingerprints)."""
    n, together = bit_counts(classes)
    keys, probes = [], []
    for i, (bits, threshold) in enumerate(allocate(n, together, distance)):
        value = F.col("fp").bitwiseAND(F.lit(_signed(sum(1 << b for b in bits))))
        keys.append(F.struct(F.lit(i).alias("i"), value.alias("key")))
        masks = [_signed(sum(1 << b for b in some)) for d in range(threshold + 1)
                 for some in itertools.combinations(bits, d)]
        probes.append(_variants(value, masks, i))
    index = classes.select(F.col("fp").alias("fv"), F.col(node).alias("v"), F.inline(F.array(*keys)))
    probing = classes.select(F.col("fp").alias("fu"), F.col(node).alias("u"), F.inline(F.flatten(F.array(*probes))))
    near = F.bit_count(F.col("fu").bitwiseXOR(F.col("fv"))) <= distance
    found = probing.join(index, (probing["i"] == index["i"]) & (probing["key"] == index["key"])
                         & (F.col("fu") < F.col("fv")) & near)
    return found.select("u", "v").distinct()


def _variants(value, masks: list[int], i: int):
    table = F.array(*[F.lit(m) for m in masks])
    return F.transform(table, lambda m: F.struct(F.lit(i).alias("i"), value.bitwiseXOR(m).alias("key")))


def near_duplicates(docs: DataFrame, shingle: int = 4, distance: int = 4, id_col: str = "doc_id",
                    text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, fp, component_id, carried columns): the smallest id reachable over links, the row's own included."""
    rows = written(fingerprints(docs, shingle, id_col, text_col, carry), "simhash-rows")
    # A class is known by (no id, smallest id, fingerprint): a component's smallest class holds its smallest id.
    name = F.struct(F.col("first_id").isNull().alias("no_id"), F.col("first_id").alias("id"), "fp")
    classes = written(rows.groupBy("fp").agg(F.min(id_col).alias("first_id")).select("fp", name.alias("class")),
                      "simhash-classes")
    roots = written(components(links(classes, distance, "class")), "simhash-roots")
    root = F.coalesce("root", "class")
    named = classes.join(roots, classes["class"] == roots["node"], "left").select(
        "fp", root["id"].alias("component_id"), root["fp"].alias("root"))
    return rows.join(named, "fp").select(id_col, "fp", "component_id", "root", *carry)


def one_of_each(docs: DataFrame, shingle: int = 4, distance: int = 4) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component the row of smallest (doc_id, text hash) stays."""
    text_hash = F.xxhash64("text")
    found = near_duplicates(docs.select("doc_id", "text", text_hash.alias("_h")), shingle, distance, carry=("_h",))
    kept = found.groupBy("root").agg(F.min(F.struct("doc_id", "_h")).alias("x")).select(
        F.col("x.doc_id").alias("_id"), F.col("x._h").alias("_h"))
    rows = docs.withColumn("_t", text_hash)
    rows = rows.join(kept, rows["doc_id"].eqNullSafe(kept["_id"]) & (rows["_t"] == kept["_h"]), "left_semi")
    # Repeated rows share id and text: one of them stays.
    again = F.row_number().over(Window.partitionBy("doc_id", "_t").orderBy(F.lit(1)))
    return rows.withColumn("_n", again).where("_n = 1").select(*docs.columns)


def shown(fp):
    """A fingerprint as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
