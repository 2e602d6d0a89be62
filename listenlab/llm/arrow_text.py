"""Texts of Arrow batches as flat byte arrays: word bounds and word hashes
without a Python object per word.

Every separator used here is an ASCII byte, and ASCII bytes never occur
inside a multi-byte UTF-8 character, so words can be cut on bytes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C55
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Bytes of text worked on at once, unless one text alone is longer.
CHUNK = 1 << 20

#: \x20 and \x09-\x0D
SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, U64)
    out[0] = 1
    done = 1
    while done < n:
        step = min(done, n - done)
        out[done:done + step] = out[:step] * U64(pow(base, done, 1 << 64))
        done += step
    return out


_POW = _powers(_BASE, 1 << 16)
_INV = _powers(_INVERSE, 1 << 16)


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _POW, _INV
    if n > len(_POW):
        size = max(n, min(CHUNK + 1, 2 * n))
        if size > 2 * CHUNK:  # one giant text: not kept
            return _powers(_BASE, size), _powers(_INVERSE, size)
        _POW, _INV = _powers(_BASE, size), _powers(_INVERSE, size)
    return _POW, _INV


def mix64(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose every bit depends on all bits."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(27)
    h *= U64(0x94D049BB133111EB)
    h ^= h >> U64(31)
    return h


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts of a column and len + 1 offsets; null: empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return raw, offs


def chunks(column: pa.Array, most: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows of about ``most`` bytes."""
    if len(column) == 0:
        return
    raw, offs = text_bytes(column)
    lo, n = 0, len(column)
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + most, "right")) - 1)
        yield lo, hi, raw[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
        lo = hi


def word_bounds(buf: np.ndarray, offs: np.ndarray, separators: np.ndarray = SPACE):
    """(starts, ends, first): byte bounds of the words, and for each text the
    index of its first word (len + 1 entries)."""
    if len(buf) == 0:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(offs), np.int64)
    inside = ~separators[buf]
    cut = offs[(offs > 0) & (offs < len(buf))]
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    start[cut] = inside[cut]
    end = inside.copy()
    end[:-1] &= ~inside[1:]
    end[cut - 1] = inside[cut - 1]
    starts = np.flatnonzero(start)
    return starts, np.flatnonzero(end) + 1, np.searchsorted(starts, offs)


#: Bytes of a span that are hashed in blocks of eight; the digest of a longer one is cryptographic.
_IN_BLOCKS = 32


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hashes of byte spans, equal for equal bytes. Every block of
    eight bytes is mixed by itself, so spans of one length up to eight bytes
    never share a hash; another ``seed`` gives hashes that are independent
    for longer ones."""
    size = ends - starts
    salt = U64((seed * 0x9E3779B97F4A7C55 + 0x632BE59BD9B4E019) & (2**64 - 1))
    h = mix64(size.astype(U64) * U64(0xD6E8FEB86659FD93) + salt)
    padded = np.concatenate([buf, np.zeros(8, np.uint8)])
    blocks = np.lib.stride_tricks.as_strided(padded[:8].view("<u8"), (len(buf) + 1,), (1,))
    for at in range(0, _IN_BLOCKS, 8):
        rest = size - at
        open_ = np.flatnonzero(rest > 0) if at else slice(None)
        if at and not len(open_):
            break
        rest = np.minimum(rest[open_], 8)
        block = blocks[starts[open_] + at] & (U64(2**64 - 1) >> (U64(64) - U64(8) * np.maximum(rest, 1).astype(U64)))
        if not at:
            block[rest <= 0] = 0
        h[open_] = mix64(h[open_] * U64(0xA24BAED4963EE407) ^ block)
    for i in np.flatnonzero(size > _IN_BLOCKS).tolist():
        digest = hashlib.blake2b(buf[starts[i]:ends[i]].tobytes(), digest_size=8, salt=seed.to_bytes(8, "little")).digest()
        h[i] = int.from_bytes(digest, "little")
    return h


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of every ``n`` consecutive words; entry i starts at word i."""
    if len(words) < n:
        return np.empty(0, U64)
    out = np.zeros(len(words) - n + 1, U64)
    for k in range(n):
        out = (out ^ (out >> U64(29))) * U64(0xC2B2AE3D27D4EB4F) + words[k:len(words) - n + 1 + k]
    return mix64(out)


def grams_inside(first: np.ndarray, n: int, total: int) -> np.ndarray:
    """Mask over gram starts: those whose ``n`` words lie in one text."""
    inside = np.zeros(max(total - n + 1, 0), bool)
    lo, hi = first[:-1], first[1:] - n + 1
    ok = hi > lo
    edge = np.zeros(len(inside) + 1, np.int32)
    np.add.at(edge, lo[ok], 1)
    np.add.at(edge, hi[ok], -1)
    return np.cumsum(edge[:-1]).astype(bool) if len(inside) else inside
