"""BPE encoding and decoding of whole texts with forced-boundary splitting (operator 2).

Byte pairs that occur inside no vocabulary token mark certain cuts (``tokens.forced_cuts``). The fragments between
cuts are encoded independently, each distinct one once per batch, and their ids are concatenated. A fragment that
ends inside a word is encoded without the word-end mark. Work is one map over the input: no shuffle.

Defined results: a null text is an empty one (no ids); empty texts give zero ids and an empty decoded text; repeated
rows give repeated results; an empty table gives an empty result; other columns of the input are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from bizlens.llm.tokens import encoder, slices

#: Text encoded and decoded at once: its ids are also held as Python numbers.
ROUND_TRIP_BYTES = 4 << 20


def decode(tokenizer, ids: list[int], names: dict[int, str]) -> str:
    """What the library's ``decode(ids, skip_special_tokens=False)`` returns."""
    if tokenizer.decoder is not None:
        return tokenizer.decode(ids, skip_special_tokens=False)
    return " ".join(map(names.__getitem__, ids))


def encode_texts(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids): the token ids of each row's text, special tokens added by nobody."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path)
        for batch in batches:
            for part in slices(batch, "t"):
                ids, at = enc.encode(part.column("t"))
                lists = pa.LargeListArray.from_arrays(at, ids.astype(np.int32)).cast(pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column("k"), lists], ["k", "ids"])

    out = docs.select(F.col(id_col).alias("k"), F.col(text_col).alias("t")).mapInArrow(run, f"k {kind}, ids array<int>")
    return out.withColumnRenamed("k", id_col)


def round_trip(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of each text, encoded and decoded without leaving the task."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path)
        names = {i: t for t, i in enc.tokenizer.get_vocab(with_added_tokens=True).items()}
        for batch in batches:
            for part in slices(batch, "t", ROUND_TRIP_BYTES):
                ids, at = enc.encode(part.column("t"))
                data, listed, at = ids.astype("<u4").tobytes(), ids.tolist(), at.tolist()
                spans = list(zip(at[:-1], at[1:], strict=True))
                yield pa.RecordBatch.from_arrays([
                    part.column("k"),
                    pa.array([b - a for a, b in spans], pa.int64()),
                    pa.array([hashlib.sha256(data[4 * a:4 * b]).hexdigest() for a, b in spans], pa.string()),
                    pa.array([hashlib.sha256(decode(enc.tokenizer, listed[a:b], names).encode()).hexdigest()
                              for a, b in spans], pa.string()),
                ], ["k", "n_tokens", "ids_sha256", "decoded_sha256"])

    out = docs.select(F.col(id_col).alias("k"), F.col(text_col).alias("t")).mapInArrow(
        run, f"k {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return out.withColumnRenamed("k", id_col)
