"""Token files with directly addressable codes (operator 4).

Each id is split into chunks, low bits first. Level k holds the k-th chunk of all ids that have one, densely packed;
a bitmap per level says which ids go on in the next level, and a rank directory (set bits before each block of 512)
leads to the place there. Any id, or any range of ids, is read from its own bytes only: no block is decoded.

File: header (magic, ids, documents, levels), then per level (width, entries, offsets of its parts), document ids,
null flags and document starts, then the levels. Widths are chosen per file among 4, 8 and 16 bits for the least size.

Documents are range-partitioned by id (ties by text, then input position) and sorted; each task writes files of at
most ``file_tokens`` ids under a name of its own attempt, and only files named in the manifest count, so a lost or
repeated task leaves nothing wrong behind.

Defined results: a null text is an empty one (the end id alone); a null id sorts first; repeated rows are kept each; an
empty table gives no files and no rows; columns besides id and text are not read.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from bizlens.llm.tokens import encoder, slices
from bizlens.llm.work import work_path, written

MAGIC = b"DACT0001"
WIDTHS = (4, 8, 16)
BLOCK_BITS = 512
#: Bits set in each byte value.
_ONES = np.array([bin(b).count("1") for b in range(256)], np.uint8)


def choose_widths(ids: np.ndarray) -> list[int]:
    """Chunk widths of least total size: chunks plus one continuation bit per entry of every level but the last."""
    longest = max(1, int(ids.max()).bit_length()) if len(ids) else 1
    # longer[b]: ids that need more than b bits
    longer = [int(np.count_nonzero(ids >> np.uint32(b))) if b else len(ids) for b in range(longest)]
    best: dict[int, tuple[int, list[int]]] = {}
    for b in range(longest - 1, -1, -1):
        options = []
        for w in WIDTHS:
            if b + w >= longest:
                options.append((longer[b] * w, [w]))
            else:
                rest = best[b + w]
                options.append((longer[b] * (w + 1) + rest[0], [w, *rest[1]]))
        best[b] = min(options)
    return best[0][1]


def _packed(chunk: np.ndarray, width: int) -> bytes:
    if width == 4:
        chunk = np.append(chunk, np.zeros(len(chunk) % 2, chunk.dtype)).astype(np.uint8)
        return (chunk[0::2] | chunk[1::2] << 4).tobytes()
    return chunk.astype("<u1" if width == 8 else "<u2").tobytes()


def dump(ids: np.ndarray, doc_ids: np.ndarray, nulls: np.ndarray, starts: np.ndarray) -> bytes:
    """The bytes of one file. ``starts`` has one more entry than there are documents."""
    widths = choose_widths(ids)
    parts, heads = [], []
    rest = ids.astype(np.uint32)
    for k, w in enumerate(widths):
        more = (rest >> np.uint32(w)) if w < 32 else np.zeros_like(rest)
        go_on = more > 0
        chunk = _packed(rest & np.uint32((1 << w) - 1), w)
        bits = directory = b""
        if k + 1 < len(widths):
            packed = np.packbits(go_on, bitorder="little")
            blocks = np.add.reduceat(_ONES[packed].astype(np.uint64), np.arange(0, len(packed), BLOCK_BITS // 8)) \
                if len(packed) else np.zeros(0, np.uint64)
            directory = np.concatenate([[0], np.cumsum(blocks)]).astype("<u8").tobytes()
            bits = packed.tobytes()
        heads.append((w, len(rest), len(chunk), len(bits), len(directory)))
        parts += [chunk, bits, directory]
        rest = more[go_on]
    head = MAGIC + struct.pack("<QQQ", len(ids), len(doc_ids), len(widths))
    head += b"".join(struct.pack("<QQQQQ", *h) for h in heads)
    index = doc_ids.astype("<i8").tobytes() + nulls.astype("u1").tobytes() + starts.astype("<u8").tobytes()
    return b"".join([head, index, *parts])


class TokenFile:
    """Reads ids by position from a seekable file, fetching only the bytes that hold them."""

    def __init__(self, file):
        self.file = file
        head = self._read(0, 32)
        if head[:8] != MAGIC:
            raise ValueError("not a token file")
        self.n_ids, self.n_docs, levels = struct.unpack("<QQQ", head[8:])
        at = 32 + 40 * levels
        self.docs_at = at
        at += self.n_docs * 9 + (self.n_docs + 1) * 8
        self.levels = []
        for h in struct.iter_unpack("<QQQQQ", self._read(32, 40 * levels)):
            self.levels.append((h[0], at, at + h[2], at + h[2] + h[3]))
            at += h[2] + h[3] + h[4]

    def _read(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        return self.file.read(n)

    def documents(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, null flags, starts with the end appended) of the file's documents."""
        n = self.n_docs
        raw = self._read(self.docs_at, n * 9 + (n + 1) * 8)
        return (np.frombuffer(raw[:8 * n], "<i8"), np.frombuffer(raw[8 * n:9 * n], "u1").astype(bool),
                np.frombuffer(raw[9 * n:], "<u8").astype(np.int64))

    def _bits(self, level: int, lo: int, hi: int) -> np.ndarray:
        at = self.levels[level][2]
        raw = np.frombuffer(self._read(at + lo // 8, -(-hi // 8) - lo // 8), np.uint8)
        return np.unpackbits(raw, bitorder="little")[lo % 8:lo % 8 + hi - lo]

    def _rank(self, level: int, i: int) -> int:
        """Set bits before position i, from the directory and at most one block."""
        block = i // BLOCK_BITS
        base = struct.unpack("<Q", self._read(self.levels[level][3] + 8 * block, 8))[0]
        return base + int(self._bits(level, block * BLOCK_BITS, i).sum()) if i % BLOCK_BITS else base

    def ids(self, lo: int, hi: int) -> np.ndarray:
        """The ids at positions lo to hi - 1."""
        return self._level(0, lo, hi) if hi > lo else np.zeros(0, np.uint32)

    def _level(self, level: int, lo: int, hi: int) -> np.ndarray:
        width, at = self.levels[level][:2]
        if width == 4:
            raw = np.frombuffer(self._read(at + lo // 2, -(-hi // 2) - lo // 2), np.uint8)
            both = np.stack([raw & 15, raw >> 4], axis=1).reshape(-1)
            out = both[lo % 2:lo % 2 + hi - lo].astype(np.uint32)
        else:
            size = width // 8
            out = np.frombuffer(self._read(at + lo * size, (hi - lo) * size), f"<u{size}").astype(np.uint32)
        if level + 1 < len(self.levels):
            go_on = self._bits(level, lo, hi).astype(bool)
            if go_on.any():
                first = self._rank(level, lo)
                deeper = self._level(level + 1, first, first + int(go_on.sum()))
                out[go_on] |= deeper << np.uint32(width)
        return out


def write_files(docs: DataFrame, tokenizer_path: str, path: str, end_id: int, file_tokens: int = 4 << 20) -> DataFrame:
    """Writes the documents in ascending id order; returns the written manifest (part, no, file, n_docs, n_ids)."""
    keyed = docs.select(F.col("doc_id").cast("long").alias("k"), F.col("text").alias("t"),
                        F.xxhash64("text").alias("h"), F.monotonically_increasing_id().alias("p"))
    ordered = keyed.repartitionByRange("k", "h", "p").sortWithinPartitions("k", "h", "p").select("k", "t")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part_no = encoder(tokenizer_path), TaskContext.get().partitionId()
        store, folder = fs.FileSystem.from_uri(path)
        store.create_dir(folder, recursive=True)
        held, size, no = [], 0, 0

        def flush():
            nonlocal held, size, no
            ids = np.concatenate([h[0] for h in held])
            lens = np.concatenate([h[3] for h in held])
            name = f"{part_no:06d}-{no:04d}-{uuid.uuid4().hex}.tok"
            with store.open_output_stream(f"{folder}/{name}") as f:
                f.write(dump(ids, np.concatenate([h[1] for h in held]), np.concatenate([h[2] for h in held]),
                             np.concatenate([[0], np.cumsum(lens)])))
            row = pa.RecordBatch.from_pylist([{"part": part_no, "no": no, "file": name, "n_docs": len(lens),
                                               "n_ids": len(ids)}], schema=manifest)
            held, size, no = [], 0, no + 1
            return row

        manifest = pa.schema([("part", pa.int64()), ("no", pa.int64()), ("file", pa.string()),
                              ("n_docs", pa.int64()), ("n_ids", pa.int64())])
        for batch in batches:
            for part in slices(batch, "t"):
                ids, at = enc.encode(part.column("t"))
                ids = np.insert(ids, at[1:], end_id).astype(np.uint32)
                k = part.column("k")
                held.append((ids, k.fill_null(0).to_numpy(), k.is_null().to_numpy(zero_copy_only=False),
                             np.diff(at) + 1))
                size += len(ids)
                if size >= file_tokens:
                    yield flush()
        if held:
            yield flush()

    rows = ordered.mapInArrow(run, "part long, no long, file string, n_docs long, n_ids long")
    return written(rows, "token-manifest")


def read_documents(manifest: DataFrame, path: str, files: int) -> DataFrame:
    """Reads every document back by position: (doc_id, start, n_tokens, ids_crc32), start over all files."""
    before = Window.orderBy("part", "no").rowsBetween(Window.unboundedPreceding, -1)
    # One row per file, a few for each task that wrote.
    at = manifest.withColumn("before", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = fs.FileSystem.from_uri(path)
        for batch in batches:
            for row in batch.to_pylist():
                with store.open_input_file(f"{folder}/{row['file']}") as f:
                    tokens = TokenFile(f)
                    doc_ids, nulls, starts = tokens.documents()
                    crc, lo = [], 0
                    while lo < len(doc_ids):  # documents in runs of about a million ids
                        hi = max(lo + 1, int(np.searchsorted(starts, starts[lo] + (1 << 20), "right")) - 1)
                        hi = min(hi, len(doc_ids))
                        data = memoryview(tokens.ids(int(starts[lo]), int(starts[hi])).astype("<u4")).cast("B")
                        at = ((starts[lo:hi + 1] - starts[lo]) * 4).tolist()
                        crc += [zlib.crc32(data[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
                        lo = hi
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_ids, pa.int64(), mask=nulls), pa.array(starts[:-1] + row["before"]),
                     pa.array(np.diff(starts)), pa.array(crc, pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"])

    spread = at.select("file", "before").repartition(max(1, files))
    return spread.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_file_round_trip(docs: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """Writes all documents to token files in the shared folder and reads them back."""
    path = work_path(docs.sparkSession, "token-files")
    manifest = write_files(docs, tokenizer_path, path, end_id)
    return read_documents(manifest, path, manifest.count())
