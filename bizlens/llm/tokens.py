"""Token ids of whole texts, computed per distinct fragment.

A text is cut where no token of the vocabulary can reach across, every distinct fragment of a batch is encoded once,
and the ids are gathered back in numpy. Two cut rules are offered:

* ``byte_level``: for byte-level BPE with the pattern below. Cuts: before white space that follows other text, between
  an ASCII letter and ASCII punctuation, and between ASCII punctuation (not an apostrophe) and an ASCII letter. At each
  of these the pattern starts a new piece whatever stands around it.
* ``forced_pairs``: for word-end BPE. A byte pair that occurs inside no vocabulary token is a certain cut.

Texts that hold a special token's string are encoded whole by the tokenizers library, so the result is its result.
"""

from __future__ import annotations

import json
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Fixed value: the piece pattern of byte-level BPE as the tokenizer file's ByteLevel pre-tokenizer applies it.
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: What the memo of a Python worker may take, with ``ENTRY_BYTES`` for each entry's objects; beyond it the memo starts anew.
#: Fragments of more than ``KEPT_BYTES`` (texts without places to cut) are not kept. Bounds of memory, not of results.
MEMO_BYTES, ENTRY_BYTES, KEPT_BYTES = 64 << 20, 160, 64
#: Bytes of text handled at once inside a task.
SLICE_BYTES = 16 << 20

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_MARK = np.zeros(256, bool)
_MARK[33:127] = True
_MARK &= ~(_LETTER | _DIGIT)
_APOSTROPHE = 39


def byte_alphabet() -> dict[str, int]:
    """The printable character that byte-level BPE files write for each byte, as character -> byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def byte_level_cuts() -> np.ndarray:
    """table[x, y]: a new piece always starts between the bytes x and y."""
    cut = ~_SPACE[:, None] & _SPACE[None, :]
    # Bytes of other characters may be white space themselves (U+00A0, U+2003, ...): no cut after them.
    cut[128:, :] = False
    cut |= _LETTER[:, None] & _MARK[None, :]
    after = _MARK.copy()
    after[_APOSTROPHE] = False
    cut |= after[:, None] & _LETTER[None, :]
    return cut


def token_bytes(token: str, suffix: str, alphabet: dict[str, int]) -> bytes:
    """The bytes of a vocabulary entry without its word-end mark."""
    return bytes(alphabet[c] for c in (token.removesuffix(suffix) if suffix else token))


def inside_pairs(vocab: dict[str, int], suffix: str) -> np.ndarray:
    """table[x, y]: the byte y follows the byte x inside some vocabulary token."""
    alphabet, inside = byte_alphabet(), np.zeros((256, 256), bool)
    for token in vocab:
        b = np.frombuffer(token_bytes(token, suffix, alphabet), np.uint8)
        inside[b[:-1], b[1:]] = True
    return inside


def forced_cuts(vocab: dict[str, int], suffix: str) -> tuple[np.ndarray, np.ndarray]:
    """(cut, inner): byte pairs of raw text that occur inside no token, and those of them inside one word piece.

    The vocabulary is lower case, so ASCII capitals count as their small letters. Only ASCII pairs are used: between
    them normalisation cannot compose characters. An apostrophe may begin a contraction, so nothing is cut after one,
    nor before one that continues a run of marks. White space is in no token: every pair with it is a cut.
    """
    low = np.arange(256)
    low[65:91] += 32
    cut = ~inside_pairs(vocab, suffix)[low][:, low]
    cut[128:, :] = cut[:, 128:] = False
    cut[32, :128] = cut[:128, 32] = True
    cut[_APOSTROPHE, :] = False
    cut[_APOSTROPHE, _SPACE] = True
    cut[_MARK, _APOSTROPHE] = False
    printable = _LETTER | _DIGIT | _MARK | _SPACE
    cut &= printable[:, None] & printable[None, :]
    inner = cut & ((_LETTER[:, None] & _LETTER[None, :]) | (_MARK[:, None] & _MARK[None, :]))
    return cut, inner


class Encoder:
    """Encodes Arrow string arrays. Make it inside a task with :func:`encoder`, which keeps one per Python worker."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [t["content"].encode() for t in spec["added_tokens"]]
        model = spec["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.memo: dict[str, bytes] = {}
        self.held = 0
        self.fast = self.open_end = None
        if self.suffix:
            self.cut, self.inner = forced_cuts(model["vocab"], self.suffix)
            spec["model"]["end_of_word_suffix"] = None
            # The same merges without the word-end mark, for a fragment that ends inside a word.
            self.open_end = Tokenizer.from_str(json.dumps(spec))
            self.shown = {b: c for c, b in byte_alphabet().items()}
            self.marks = {m: self.tokenizer.encode(m, add_special_tokens=False).ids for m in ",.;:!?"}
        else:
            self.cut, self.inner = byte_level_cuts(), None
            self.fast = _ranked(model)

    def fragments(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(starts, inner): where fragments start in the batch's bytes; whether each ends inside a word piece."""
        first = np.zeros(len(data) + 1, bool)
        pair = (data[:-1].astype(np.uint16) << 8) | data[1:]
        first[1:-1] = self.cut.reshape(-1)[pair]
        raw = data.tobytes() if self.special else b""
        for s in self.special:
            at = raw.find(s)
            while at >= 0:
                lo, hi = (np.searchsorted(offsets, at, "right") - 1, np.searchsorted(offsets, at, "right"))
                first[offsets[lo] + 1:offsets[hi]] = False
                at = raw.find(s, at + len(s))
        first[offsets] = True
        first[-1] = False
        starts = np.flatnonzero(first)
        inner = np.zeros(len(starts), bool)
        if self.inner is not None and len(starts) > 1:
            ends = starts[1:]
            inner[:-1] = self.inner[data[ends - 1], data[ends]] & ~np.isin(ends, offsets)
        return starts, inner

    def _closed(self, new: list[str]) -> None:
        """Remembers the ids of fragments that end where a piece ends."""
        rest = new
        self.held += sum(map(self._taken, new))
        if self.fast is not None:
            marks = [s.decode() for s in self.special]
            rest = [f for f in new if any(m in f for m in marks)] if any(m in "\0".join(new) for m in marks) else []
            skip = set(rest)
            plain = [f for f in new if f not in skip]
            for f, ids in zip(plain, map(self.fast._core_bpe.encode_ordinary, plain), strict=True):
                self.memo[f] = array("I", ids).tobytes()
        if self.suffix:
            rest = [f for f in new if not self._one_word(f)]
        for f, e in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False), strict=True):
            self.memo[f] = array("I", e.ids).tobytes()

    def _forget_long(self, words: list[str]) -> None:
        for w in words:
            if len(w) > KEPT_BYTES and self.memo.pop(w, None) is not None:
                self.held -= self._taken(w)

    @staticmethod
    def _taken(word: str) -> int:
        """At most: four bytes a character of the text, and an id for each of its bytes."""
        return ENTRY_BYTES + 8 * len(word)

    def _one_word(self, fragment: str) -> bool:
        """Encodes a Latin-1 word, with one mark behind it or none, straight by the model; False if it is not one.

        Such a word is one piece, and normalising it only lower-cases each letter.
        """
        word, mark = (fragment[:-1], fragment[-1]) if fragment[-1] in self.marks else (fragment, "")
        if not word.isalpha() or max(word) > "\xff":
            return False
        piece = word.lower().encode().decode("latin-1").translate(self.shown)
        ids = [t.id for t in self.tokenizer.model.tokenize(piece)]
        self.memo[fragment] = array("I", ids + self.marks.get(mark, [])).tobytes()
        return True

    def _open(self, fragment: str) -> list[int]:
        """Ids of a fragment whose last word piece goes on behind its end: that piece is encoded without a word end."""
        pieces = self.tokenizer.pre_tokenizer.pre_tokenize_str(self.tokenizer.normalizer.normalize_str(fragment))
        model = self.tokenizer.model
        head = [t.id for piece, _ in pieces[:-1] for t in model.tokenize(piece)]
        return head + [t.id for t in self.open_end.model.tokenize(pieces[-1][0])]

    def encode_fragments(self, texts: pa.Array):
        """(flat, lens, codes, bounds) of a string array; see :meth:`encode`. A null text is an empty one."""
        texts = texts.fill_null("").cast(pa.large_string())
        n = len(texts)
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + n + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
        offsets = offsets - offsets[0]
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(n + 1, np.int64), []
        starts, inner = self.fragments(data, offsets)
        ends = np.append(starts, len(data)).astype(np.int64)
        frags = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(ends), pa.py_buffer(data))
        coded = frags.dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        words = coded.dictionary.to_pylist()
        if self.held > MEMO_BYTES:
            self.memo.clear()
            self.held = 0
        if inner.any():
            used, codes = np.unique(codes * 2 + inner, return_inverse=True)
            open_end = (used & 1).astype(bool).tolist()
            words = [words[k] for k in (used >> 1).tolist()]
            self._closed([w for w, o in zip(words, open_end, strict=True) if not o and w not in self.memo])
            found = [array("I", self._open(w)).tobytes() if o else self.memo[w]
                     for w, o in zip(words, open_end, strict=True)]
            self._forget_long(words)
        else:
            new = [w for w in words if w not in self.memo]
            if new:
                self._closed(new)
            found = [self.memo[w] for w in words]
            self._forget_long(new)
        lens = np.fromiter(map(len, found), np.int64, len(found)) >> 2
        flat = np.frombuffer(b"".join(found), np.uint32)
        return flat, lens, codes, np.searchsorted(starts, offsets), found

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets): the ids of all texts one after another, text k at offsets[k]:offsets[k + 1]."""
        flat, lens, codes, bounds, _ = self.encode_fragments(texts)
        n = lens[codes]
        ends = np.concatenate([[0], np.cumsum(n)])
        where = np.repeat((np.cumsum(lens) - lens)[codes] - ends[:-1], n)
        where += np.arange(len(where))
        return flat[where], ends[bounds]


def _ranked(model: dict):
    """A byte-pair encoder over the file's own vocabulary, if its merge order is its id order; else None."""
    import tiktoken

    vocab, alphabet = model["vocab"], byte_alphabet()
    base = len(vocab) - len(model["merges"])
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    if base != 256 or any(vocab.get(a + b) != base + i for i, (a, b) in enumerate(pairs)):
        return None
    ranks = {token_bytes(t, "", alphabet): i for t, i in vocab.items()}
    return tiktoken.Encoding("file", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={})


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file; the file must be readable on every executor."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES):
    """Consecutive slices of a batch whose text is at most ``limit`` bytes, or a single row."""
    size = np.cumsum(np.asarray(pc.binary_length(batch.column(column).fill_null("")), np.int64))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + limit, "right")))
        yield batch.slice(at, to - at)
        at = to
