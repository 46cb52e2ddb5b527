"""Nearest neighbours by cosine with an adaptive dimension scan over inverted lists (operator 13).

Index: every vector goes to the list of its nearest centroid. Centroids are fitted on the ``SAMPLE`` rows of smallest id
hash (a bounded sample; every row is indexed): about the square root of the number of rows, at most ``MAX_LISTS``. Lists
are put into cells of about ``CELL_ROWS`` rows; a longer list is dealt over several cells by id hash, so a hot list is
never one group.

How many lists a query probes is measured, not guessed: ``TRIALS`` queries are compared with all rows, and the number is
the smallest with which ``TARGET`` of their true neighbours stand in probed lists. On data without clusters that is
most lists; on clustered data a few.

Scan: unit vectors are rotated by one random rotation and laid out in blocks of columns. After each block a
hypothesis test on the partial distance d of D columns seen abandons a candidate when
partial > d/D * (1 + EPSILON/sqrt(d))^2 * (distance of the k-th best so far). What is left gets its exact score on the
original vectors. A task holds one cell and streams its queries through it.

Defined results: vectors that are null, zero, of another length than that of the smallest id's vector, or with null or
non-finite components take no part, as rows with a null id; with fewer than k candidates all are returned; ties go to the
smaller id; rows with one id are one candidate, by the best of their vectors; an empty table gives no rows; columns
besides id and vector are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from bizlens.llm.work import written

SAMPLE, MAX_LISTS, ROUNDS = 32_768, 2_048, 8
TRIALS, TARGET = 256, 0.97
CELL_ROWS = 8_192
#: Significance of the test: the larger, the fewer neighbours are lost and the fewer candidates abandoned.
EPSILON = 2.1
BLOCK = 16
#: Query-candidate pairs worked on at once.
PAIRS = 1 << 18
#: What single precision may be off in a squared distance of unit vectors.
SLACK = 1e-5


@dataclass
class Index:
    """``rows``: (id, vector, list), written. The rest is small: at most MAX_LISTS centroids and counts."""

    rows: DataFrame
    centroids: np.ndarray
    counts: np.ndarray
    dim: int


# ---------------------------------------------------------------------------------------------- vectors
def usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def scaled(x: np.ndarray) -> np.ndarray:
    """Each row times a power of two, so that squares neither overflow nor vanish."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None])


def unit(x: np.ndarray) -> np.ndarray:
    x = scaled(x)
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The cosine of each row of (scaled) ``a`` with the same row of ``b``; equal rows give equal results."""
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def rotation(dim: int) -> np.ndarray:
    """A random orthogonal matrix, always the same for a dimension."""
    q, r = np.linalg.qr(np.random.default_rng(dim).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


# ---------------------------------------------------------------------------------------------- index
def fit(sample: np.ndarray, lists: int) -> np.ndarray:
    """Centroids of unit vectors (spherical k-means on a bounded sample)."""
    rng = np.random.default_rng(lists)
    centroids = sample[rng.choice(len(sample), min(lists, len(sample)), replace=False)]
    for _ in range(ROUNDS):
        nearest = nearest_list(sample, centroids)
        total = np.zeros_like(centroids)
        np.add.at(total, nearest, sample)
        norm = np.sqrt((total * total).sum(axis=1))
        some = norm > 1e-9
        centroids[some] = total[some] / norm[some][:, None]
    return centroids


def nearest_list(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    step = max(1, PAIRS * 4 // len(centroids))
    return np.concatenate([np.argmax(x[lo:lo + step] @ centroids.T, axis=1) for lo in range(0, len(x), step)]
                          or [np.zeros(0, np.int64)])


def build_index(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> Index | None:
    """The index over all usable vectors; None without any."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v")).where(F.col("id").isNotNull())
    rows = rows.where(usable(F.col("v")))
    dim, n = rows.agg(F.min_by(F.size("v"), "id"), F.count("*")).first()
    if dim is None:
        return None
    rows = rows.where(F.size("v") == dim)
    chosen = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("v").toArrow()["v"].combine_chunks()
    centroids = fit(unit(_matrix(chosen, dim)), min(MAX_LISTS, max(1, round(math.sqrt(n)))))
    shared = spark.sparkContext.broadcast(centroids)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = nearest_list(unit(_matrix(batch.column("v"), dim)), shared.value)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("v"), pa.array(lists, pa.int32())],
                                             ["id", "v", "list"])

    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    assigned = written(rows.mapInArrow(assign, f"id {types['id']}, v {types['v']}, list int"), "ann-index")
    counts = np.zeros(len(centroids), np.int64)
    for number, c in assigned.groupBy("list").count().collect():
        counts[number] = c
    return Index(assigned, centroids, counts, dim)


# ---------------------------------------------------------------------------------------------- how many lists
def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best scores, ties by id."""
    if len(scores) > 4 * k:
        at = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))][:k]


def probes_needed(index: Index, queries: DataFrame, k: int) -> tuple[int, float]:
    """(lists to probe, share of the trial queries' true neighbours that stand in them)."""
    some = queries.orderBy(F.xxhash64("id"), "id").limit(TRIALS).select("id", "v").toArrow()
    if not some.num_rows:
        return 1, 1.0
    q_ids = some["id"].to_numpy()
    q = unit(_matrix(some["v"].combine_chunks(), index.dim))
    dim = index.dim
    shared = index.rows.sparkSession.sparkContext.broadcast((q_ids, q))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_q, trial = shared.value
        for whole in batches:
            for lo in range(0, whole.num_rows, PAIRS // TRIALS):
                batch = whole.slice(lo, PAIRS // TRIALS)
                ids = batch.column("id").to_numpy(zero_copy_only=False)
                lists = batch.column("list").to_numpy(zero_copy_only=False)
                scores = trial @ unit(_matrix(batch.column("v"), dim)).T
                scores[ids_q[:, None] == ids[None, :]] = -np.inf
                best = [(i, int(at), float(s[at])) for i, s in enumerate(scores) for at in _best(ids, s, k)
                        if s[at] > -np.inf]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b[0] for b in best], pa.int32()), pa.array([int(ids[b[1]]) for b in best], pa.int64()),
                     pa.array([int(lists[b[1]]) for b in best], pa.int32()), pa.array([b[2] for b in best], pa.float64())],
                    ["q", "id", "list", "score"])

    near = index.rows.mapInArrow(compare, "q int, id bigint, list int, score double")
    order = Window.partitionBy("q").orderBy(F.desc("score"), "id")
    near = near.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k).select("q", "list").collect()
    if not near:
        return 1, 1.0
    place = np.argsort(np.argsort(-(q @ index.centroids.T), axis=1, kind="stable"), axis=1)
    needed = np.sort([place[r["q"], r["list"]] for r in near])
    probes = int(needed[math.ceil(TARGET * len(needed)) - 1]) + 1
    return probes, float((needed < probes).mean())


# ---------------------------------------------------------------------------------------------- cells
def cells_of(counts: np.ndarray, cell_rows: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(first cell, number of cells) of each list, and the number of cells: short lists share one, long ones have some."""
    first, parts = np.zeros(len(counts), np.int64), np.ones(len(counts), np.int64)
    cell, room = -1, 0
    for i, c in enumerate(counts.tolist()):
        if c > cell_rows:
            parts[i] = math.ceil(c / cell_rows)
            first[i], cell, room = cell + 1, cell + int(parts[i]), 0
            continue
        if c > room:
            cell, room = cell + 1, cell_rows
        first[i], room = max(cell, 0), room - c
    return first, parts, max(cell, 0) + 1


def _probed(x: np.ndarray, centroids: np.ndarray, probes: int) -> np.ndarray:
    """Which lists (columns) each query (row) probes: exactly ``probes`` of them."""
    near = np.argsort(-(x @ centroids.T), axis=1, kind="stable")[:, :probes]
    out = np.zeros((len(x), len(centroids)), bool)
    np.put_along_axis(out, near, True, axis=1)
    return out


# ---------------------------------------------------------------------------------------------- scan
class Cell:
    """The candidates of one cell by list: ids, original vectors, and rotated unit vectors in blocks of columns."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, lists: np.ndarray, turn: np.ndarray):
        by = np.lexsort((ids, lists))
        self.ids, self.vectors, self.lists = ids[by], scaled(vectors[by]), lists[by]
        turned = (unit(vectors[by]) @ turn).astype(np.float32)
        self.blocks = [np.ascontiguousarray(turned[:, lo:lo + BLOCK]) for lo in range(0, turned.shape[1], BLOCK)]
        self.distinct = len(np.unique(ids)) == len(ids)
        self.dim = turned.shape[1]

    def spans(self) -> Iterator[tuple[int, int, int]]:
        """(list, first row, end) of each list in the cell."""
        starts = np.flatnonzero(np.concatenate([[True], self.lists[1:] != self.lists[:-1]])) if len(self.lists) else []
        for a, b in zip(starts, [*starts[1:], len(self.lists)], strict=True):
            yield int(self.lists[a]), int(a), int(b)

    def scan(self, lo: int, hi: int, q_ids: np.ndarray, q_blocks: list[np.ndarray], worst: np.ndarray,
             k: int) -> tuple[np.ndarray, np.ndarray]:
        """Query-candidate pairs (query, row of the cell) that no test abandons; ``worst`` holds each query's k-th
        smallest squared distance so far and is lowered."""
        n, ids = hi - lo, self.ids[lo:hi]
        own = q_ids[:, None] == ids[None, :]
        partial = _distances(q_blocks[0], self.blocks[0][lo:hi])
        partial[own] = np.inf
        if self.distinct and n > k:
            # A few candidates that start well are measured in full: they bound the k-th distance.
            seeds = np.argpartition(partial, min(4 * k, n - 1), axis=1)[:, :4 * k]
            full = np.take_along_axis(partial, seeds, axis=1)
            for qb, cb in zip(q_blocks[1:], self.blocks[1:], strict=True):
                full += ((qb[:, None, :] - cb[lo:hi][seeds]) ** 2).sum(axis=2)
            if full.shape[1] >= k:
                np.minimum(worst, np.partition(full, k - 1, axis=1)[:, k - 1], out=worst)
        qi, ci, value = None, None, None
        for b in range(len(q_blocks)):
            if b and qi is None:
                partial += _distances(q_blocks[b], self.blocks[b][lo:hi])
            elif b:
                value += ((q_blocks[b][qi] - self.blocks[b][lo:hi][ci]) ** 2).sum(axis=1)
            seen = min(self.dim, (b + 1) * BLOCK)
            test = 1.0 if seen == self.dim else seen / self.dim * (1 + EPSILON / math.sqrt(seen)) ** 2
            limit = (test * worst + SLACK).astype(np.float32)
            if qi is None:
                stays = partial <= limit[:, None]
                # While many candidates stay, whole blocks are cheaper than picked ones.
                if seen == self.dim or 4 * int(stays.sum()) < stays.size:
                    qi, ci = np.nonzero(stays & np.isfinite(partial))
                    value = partial[qi, ci]
                else:
                    partial[~stays] = np.inf
            else:
                kept = value <= limit[qi]
                qi, ci, value = qi[kept], ci[kept], value[kept]
        if self.distinct and len(qi):
            _lower(worst, qi, value, k)
            kept = value <= worst[qi] + SLACK
            qi, ci = qi[kept], ci[kept]
        return qi, ci + lo


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * (a @ b.T)
    return np.maximum(d, 0)


def _lower(worst: np.ndarray, qi: np.ndarray, value: np.ndarray, k: int) -> None:
    """Lowers each query's k-th distance to the k-th smallest of its values, if it has as many."""
    by = np.lexsort((value, qi))
    first = np.searchsorted(qi[by], np.arange(len(worst)))
    enough = np.searchsorted(qi[by], np.arange(len(worst)), side="right") - first >= k
    at = first[enough] + k - 1
    worst[enough] = np.minimum(worst[enough], value[by][at])


def search_cell(cell: Cell, q_ids: np.ndarray, q: np.ndarray, centroids: np.ndarray, turn: np.ndarray, probes: int,
                k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(query ids, candidate ids, scores): at most k candidates a query, of the cell's lists that the query probes."""
    spans = list(cell.spans())
    if not spans:
        return
    step = max(1, min(512, PAIRS // max(b - a for _, a, b in spans)))
    for at in range(0, len(q_ids), step):
        ids, some = q_ids[at:at + step], q[at:at + step]
        plain = unit(some)
        probed = _probed(plain, centroids, probes)
        turned, exact = (plain @ turn).astype(np.float32), scaled(some)
        blocks = [np.ascontiguousarray(turned[:, b:b + BLOCK]) for b in range(0, cell.dim, BLOCK)]
        worst = np.full(len(ids), np.inf, np.float32)
        pairs = []
        for number, lo, hi in spans:
            mine = np.flatnonzero(probed[:, number])
            if not len(mine):
                continue
            bound = worst[mine]
            qi, ci = cell.scan(lo, hi, ids[mine], [b[mine] for b in blocks], bound, k)
            worst[mine] = bound
            scores = np.concatenate([cosines(exact[mine[qi[p:p + 65536]]], cell.vectors[ci[p:p + 65536]])
                                     for p in range(0, len(qi), 65536)] or [np.zeros(0)])
            # Of each list the k best go on, counting an id once.
            by = np.lexsort((cell.ids[ci], -scores, qi))
            pairs.append(_first(mine[qi[by]], cell.ids[ci[by]], scores[by], k))
        if pairs:
            qn, cand, score = (np.concatenate(x) for x in zip(*pairs, strict=True))
            by = np.lexsort((cand, -score, qn))
            qn, cand, score = _first(qn[by], cand[by], score[by], k)
            yield ids[qn], cand, score


def _first(qn: np.ndarray, cand: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first k distinct candidates of each query, of triples in order."""
    _, once = np.unique(np.stack([qn, cand], axis=1), axis=0, return_index=True) if len(qn) else (None, np.zeros(0, int))
    once = np.sort(once)
    qn, cand, score = qn[once], cand[once], score[once]
    place = np.arange(len(qn)) - np.searchsorted(qn, qn)
    return qn[place < k], cand[place < k], score[place < k]


def search(index: Index, queries: DataFrame, probes: int, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's (id, v) k nearest rows found in the ``probes`` nearest lists."""
    spark, dim = index.rows.sparkSession, index.dim
    first, parts, cells = cells_of(index.counts, CELL_ROWS)
    shared = spark.sparkContext.broadcast((index.centroids, rotation(dim), first, parts))
    probes = min(probes, len(index.centroids))
    id_type, v_type = (index.rows.schema[c].dataType.simpleString() for c in ("id", "v"))
    shape = f"cell int, asks int, list int, id {id_type}, v {v_type}"

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, _, begin, many = shared.value
        for batch in batches:
            lists = batch.column("list").to_numpy(zero_copy_only=False)
            cell = begin[lists] + batch.column("h").to_numpy(zero_copy_only=False).astype(np.uint64) % many[lists].astype(np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int32)), pa.array(np.zeros(len(lists), np.int32)),
                                              batch.column("list"), batch.column("id"), batch.column("v")],
                                             ["cell", "asks", "list", "id", "v"])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids, _, begin, many = shared.value
        for whole in batches:
            for lo in range(0, whole.num_rows, 128):
                batch = whole.slice(lo, 128)
                asker, number = np.nonzero(_probed(unit(_matrix(batch.column("v"), dim)), centroids, probes))
                each = many[number]  # a list's cells stand in a row
                within = np.arange(int(each.sum())) - np.repeat(np.cumsum(each) - each, each)
                pair = np.unique(np.repeat(asker, each) * cells + np.repeat(begin[number], each) + within)
                qn, cell = np.divmod(pair, cells)
                for p in range(0, len(qn), 8192):
                    at = pa.array(qn[p:p + 8192])
                    size = len(at)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(cell[p:p + 8192].astype(np.int32)), pa.array(np.ones(size, np.int32)),
                         pa.array(np.full(size, -1, np.int32)), batch.column("id").take(at), batch.column("v").take(at)],
                        ["cell", "asks", "list", "id", "v"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids, turn, _, _ = shared.value
        now, held, cell = -1, [], None
        for batch in batches:
            cell_of = batch.column("cell").to_numpy(zero_copy_only=False)
            asks = batch.column("asks").to_numpy(zero_copy_only=False)
            ids = batch.column("id").to_numpy(zero_copy_only=False).astype(np.int64)
            lists = batch.column("list").to_numpy(zero_copy_only=False)
            vectors = _matrix(batch.column("v"), dim)
            cuts = np.flatnonzero((np.diff(cell_of) != 0) | (np.diff(asks) != 0)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(cell_of)], strict=True):
                if a == b:
                    continue
                if cell_of[a] != now:
                    now, held, cell = int(cell_of[a]), [], None
                if not asks[a]:
                    held.append((ids[a:b], vectors[a:b], lists[a:b]))
                    continue
                if cell is None:
                    if not held:
                        continue
                    cell = Cell(*(np.concatenate(x) for x in zip(*held, strict=True)), turn)
                    held = []
                for q, c, s in search_cell(cell, ids[a:b], vectors[a:b], centroids, turn, probes, k):
                    yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(c), pa.array(s)], ["query_id", "vec_id", "score"])

    placed = index.rows.withColumn("h", F.xxhash64("id")).mapInArrow(place, shape)
    asked = queries.select("id", F.col("v").cast(v_type).alias("v")).mapInArrow(send, shape)
    both = placed.unionByName(asked).repartition(cells, "cell").sortWithinPartitions("cell", "asks")
    found = both.mapInArrow(scan, "query_id bigint, vec_id bigint, score double")
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id",
            vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows of each row for which ``is_query`` (on ``id``) holds."""
    index = build_index(vectors, id_col, vector_col)
    if index is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    queries = index.rows.where(is_query).select("id", "v")
    probes, _ = probes_needed(index, queries, k)
    return search(index, queries, probes, k)
