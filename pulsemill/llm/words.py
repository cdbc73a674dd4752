"""Words and shingles of whole batches of texts as 64-bit hashes, in numpy.

A batch is hashed over its UTF-8 bytes: every byte maps to a random value, a word's hash
is a polynomial in its bytes' values. Bytes of 0x80 and above belong to characters beyond
ASCII, so classes that hold all of those can be decided byte by byte.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

PIECE_BYTES = 2 << 20
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0xD6E8FEB86659FD93)
_STEP = np.uint64(0xA0761D6478BD642F)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def random_values(n: int, seed: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * _GOLDEN + np.uint64(seed))


@dataclass(frozen=True)
class Alphabet:
    """Which bytes belong to words, and the value of each."""

    inside: np.ndarray
    value: np.ndarray


def _alphabet(inside: np.ndarray, fold: bool) -> Alphabet:
    value = random_values(256, 7)
    if fold:
        value[65:91] = value[97:123]
    return Alphabet(inside, value)


_codes = np.arange(256)
#: Runs of ASCII letters, digits and characters beyond ASCII; A-Z count as a-z.
ALNUM = _alphabet(
    ((_codes >= 48) & (_codes <= 57)) | ((_codes >= 65) & (_codes <= 90))
    | ((_codes >= 97) & (_codes <= 122)) | (_codes >= 128), True)
#: Runs between ASCII white space, as they are.
SPACED = _alphabet(~((_codes == 32) | ((_codes >= 9) & (_codes <= 13))), False)


@dataclass
class Words:
    """Words of a batch in order; ``start`` and ``end`` are positions in ``data``."""

    n_texts: int
    data: np.ndarray
    text: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray

    def counts(self) -> np.ndarray:
        return np.bincount(self.text, minlength=self.n_texts)

    def bounds(self) -> np.ndarray:
        """Words of text i are bounds[i] to bounds[i + 1]."""
        return np.concatenate(([0], np.cumsum(self.counts())))


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (first is 0) and bytes; a null has no bytes."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.fill_null("").cast(pa.large_binary())
    if not len(texts):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    if data is None or offsets[-1] == offsets[0]:
        return offsets - offsets[0], np.zeros(0, np.uint8)
    return offsets - offsets[0], np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]]


def slices(batch: pa.RecordBatch, column: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into row ranges of about ``limit`` bytes of text, one row at least."""
    offsets, _ = utf8(batch.column(column))
    at = 0
    while at < batch.num_rows:
        to = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
        to = min(max(to, at + 1), batch.num_rows)
        yield batch.slice(at, to - at)
        at = to


def _pieces(data: np.ndarray, inside: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges that cut no word, so that one very long text is hashed piece by piece."""
    at = 0
    while at < len(data):
        to = min(len(data), at + PIECE_BYTES)
        while to < len(data):
            gaps = np.flatnonzero(~inside[data[to:to + PIECE_BYTES]])
            if len(gaps):
                to += int(gaps[0])
                break
            to = min(len(data), to + PIECE_BYTES)
        yield at, to
        at = to


def words(texts: pa.Array, alphabet: Alphabet) -> Words:
    offsets, data = utf8(texts)
    parts = [_hashed(data, at, to, offsets, alphabet) for at, to in _pieces(data, alphabet.inside)]
    empty = np.zeros(0, np.int64)
    start, end, hashes = (
        (np.concatenate(x) for x in zip(*parts, strict=True)) if parts
        else (empty, empty, np.zeros(0, np.uint64)))
    text = np.searchsorted(offsets[1:], start, "right")
    return Words(len(texts), data, text, start, end, hashes)


def _hashed(data, at, to, offsets, alphabet):
    piece = data[at:to]
    member = alphabet.inside[piece]
    fresh = np.zeros(len(piece) + 1, bool)
    fresh[offsets[np.searchsorted(offsets, at):np.searchsorted(offsets, to)] - at] = True
    before = np.concatenate(([False], member[:-1]))
    after = np.concatenate((member[1:], [False]))
    start = np.flatnonzero(member & (~before | fresh[:-1]))
    end = np.flatnonzero(member & (~after | fresh[1:])) + 1
    if not len(start):
        return start, end, np.zeros(0, np.uint64)
    length = end - start
    first = np.cumsum(length) - length
    place = np.arange(length.sum()) - np.repeat(first, length)
    power = np.multiply.accumulate(np.full(int(length.max()), _BASE))
    value = alphabet.value[piece[member]] * power[place]
    total = np.add.reduceat(value, first)
    return start + at, end + at, mix(total + length.astype(np.uint64) * _GOLDEN)


def shingles(w: Words, k: int, whole_if_shorter: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text of every run of k words, ordered by text.

    A text with fewer words, but not none, is one shingle if ``whole_if_shorter``.
    """
    n = len(w.hash) - k + 1
    hashes, text = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if n > 0:
        total = np.zeros(n, np.uint64)
        powers = np.multiply.accumulate(np.full(k, _STEP))
        for i in range(k):
            total += w.hash[i:i + n] * powers[i]
        same = w.text[:n] == w.text[k - 1:]
        hashes, text = mix(total[same]), w.text[:n][same]
    if whole_if_shorter:
        count = w.counts()
        short = (count[w.text] < k) if len(w.text) else np.zeros(0, bool)
        if short.any():
            own, of = w.hash[short], w.text[short]
            first = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1])))
            place = np.arange(len(of)) - np.repeat(first, np.diff(np.append(first, len(of))))
            power = np.multiply.accumulate(np.full(k, _STEP))
            total = mix(np.add.reduceat(own * power[place], first) + np.uint64(k))
            hashes, text = np.concatenate((hashes, total)), np.concatenate((text, of[first]))
            order = np.argsort(text, kind="stable")
            hashes, text = hashes[order], text[order]
    return hashes, text


def as_long(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))
