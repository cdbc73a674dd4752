"""Sorted zstd runs of token pairs: written by radix, merged through a heap, side-major.

A pair is one integer, the first vocabulary's id above the second's, so ascending order keeps
all pairs of a first id together.
"""

from __future__ import annotations

import heapq
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import zstandard

BLOCK = 1 << 16
_LEVEL = 3
_HEAD = "<qii"  # first pair, number of pairs, bytes of the block
_KINDS = ("u1", "u2", "u4", "u8", "i8")


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of whole numbers in their narrowest types, compressed."""
    parts = []
    for x in arrays:
        kind = np.min_scalar_type(int(x.max())) if len(x) and x.min() >= 0 else np.dtype("i8" if len(x) else "u1")
        parts += [struct.pack("<BI", _KINDS.index(kind.str[1:]), len(x)), x.astype(kind).tobytes()]
    return zstandard.ZstdCompressor(level=_LEVEL).compress(b"".join(parts))


def unpack(packed: bytes) -> list[np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(packed)
    out, at = [], 0
    while at < len(data):
        kind, n = struct.unpack_from("<BI", data, at)
        x = np.frombuffer(data, _KINDS[kind], n, at + 5)
        at += 5 + x.nbytes
        out.append(x.astype(np.int64))
    return out


def run_of(pairs: np.ndarray, *values: np.ndarray) -> bytes:
    """A run: ascending pairs, each once, and their values, in blocks that are read one by one."""
    parts = []
    for at in range(0, len(pairs), BLOCK):
        own = pairs[at:at + BLOCK]
        block = pack(np.diff(own, prepend=own[:1]), *[v[at:at + BLOCK] for v in values])
        parts += [struct.pack(_HEAD, int(own[0]), len(own), len(block)), block]
    return b"".join(parts)


def blocks(run: bytes) -> Iterator[tuple[int, int, int]]:
    """First pair and place of every block, without reading the blocks."""
    at = 0
    while at < len(run):
        first, _, size = struct.unpack_from(_HEAD, run, at)
        at += struct.calcsize(_HEAD)
        yield first, at, at + size
        at += size


def read_block(run: bytes, first: int, at: int, to: int) -> list[np.ndarray]:
    steps, *values = unpack(run[at:to])
    return [first + np.cumsum(steps), *values]


def read(run: bytes) -> list[np.ndarray]:
    parts = [read_block(run, *b) for b in blocks(run)]
    return [np.concatenate(x) for x in zip(*parts, strict=True)] if parts else []


def merged(runs: Iterable[bytes], emit: int = 4 * BLOCK) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs in ascending order and the sums of their counts over all runs.

    The heap holds the next block of every run by its first pair. A block is read when
    its turn comes; what lies below the heap's least pair is complete and leaves. So a few
    blocks per run are in memory, never a whole run.
    """
    runs = list(runs)
    ahead = [blocks(r) for r in runs]
    heap = [(block, i) for i, a in enumerate(ahead) if (block := next(a, None)) is not None]
    heapq.heapify(heap)
    held: list[list[np.ndarray]] = []
    size = 0
    while heap:
        block, i = heap[0]
        held.append(read_block(runs[i], *block))
        size += len(held[-1][0])
        following = next(ahead[i], None)
        if following is None:
            heapq.heappop(heap)
        else:
            heapq.heapreplace(heap, (following, i))
        if heap and size < emit:
            continue
        pairs, counts = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.argsort(pairs, kind="stable")
        pairs, counts = pairs[order], counts[order]
        start = np.flatnonzero(np.concatenate(([True], pairs[1:] != pairs[:-1])))
        pairs, counts = pairs[start], np.add.reduceat(counts, start)
        done = np.searchsorted(pairs, heap[0][0][0]) if heap else len(pairs)
        if done:
            yield pairs[:done], counts[:done]
        held = [[pairs[done:], counts[done:]]]
        size = len(pairs) - done


def with_maxima(parts: Iterable[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, ...]]:
    """Add to merged pairs whether a pair's count is the highest of its first id.

    Pairs come side-major, so a first id is complete as soon as the next begins; only the
    last one's pairs, at most one per id of the second vocabulary, are held back.
    """
    rest = (np.zeros(0, np.int64), np.zeros(0, np.int64))

    def flagged(pairs: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, ...]:
        side = pairs >> 32
        start = np.flatnonzero(np.concatenate(([True], side[1:] != side[:-1])))
        highest = np.maximum.reduceat(counts, start)
        return pairs, counts, counts == np.repeat(highest, np.diff(np.append(start, len(pairs))))

    for pairs, counts in parts:
        pairs, counts = (np.concatenate(x) for x in zip(rest, (pairs, counts), strict=True))
        cut = int(np.searchsorted(pairs, (pairs[-1] >> 32) << 32))
        if cut:
            yield flagged(pairs[:cut], counts[:cut])
        rest = pairs[cut:], counts[cut:]
    if len(rest[0]):
        yield flagged(*rest)
