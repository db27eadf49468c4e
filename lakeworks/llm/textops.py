"""Vectorised word hashing for Arrow batches (numpy, used inside tasks).

Words are runs of *word bytes*: the word rules of the operators name ASCII separators only, so every
byte of a non-ASCII UTF-8 character is a word byte and whole batches can be cut bytewise, without
decoding. Only A-Z is lower-cased. Memory per call is bounded by ``PIECE`` bytes of text at a time
(8-byte words of a long text are kept, its per-byte arrays are not).
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: bytes of text hashed at a time
PIECE = 1 << 17
#: bytes that separate words: ASCII white space (shingles) or everything ASCII but letters and digits
SPACE_BYTES = bytes([0x20, *range(0x09, 0x0E)])
NON_ALNUM_BYTES = bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])

_R = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_RINV = pow(_R, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """``base ** 0 .. base ** (n - 1)`` modulo 2**64 (grown on demand, kept per worker)."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, PIECE + 1)
        have = np.full(size, base, np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit multiply-xorshift hash."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def byte_tables(separators: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(is-word flags, lower-cased byte values plus one) by byte value."""
    word = np.ones(256, np.int8)
    word[list(separators)] = 0
    low = np.arange(256, dtype=np.uint64)
    low[0x41:0x5B] += np.uint64(0x20)
    return word, low + np.uint64(1)


def _hash_piece(raw: bytes, tables) -> tuple[np.ndarray, np.ndarray]:
    """Word starts and 64-bit word hashes of one piece."""
    word, low = tables
    b = np.frombuffer(raw, np.uint8)
    flags = np.zeros(len(b) + 2, np.int8)
    flags[1:-1] = word[b]
    edge = np.diff(flags)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    total = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(low[b] * _power(_R, len(b)), out=total[1:])
    h = (total[ends] - total[starts]) * _power(_RINV, len(b) + 1)[starts]
    return starts, mix(h ^ ((ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))


def _cut(raw: bytes, word: np.ndarray) -> Iterator[bytes]:
    """A long text in pieces of about ``PIECE`` bytes that end on a separator."""
    at = 0
    while len(raw) - at > PIECE:
        stop = at + PIECE
        while True:
            tail = np.flatnonzero(word[np.frombuffer(raw, np.uint8, min(4096, stop - at), stop - min(4096, stop - at))] == 0)
            if len(tail):
                stop = stop - min(4096, stop - at) + int(tail[-1]) + 1
                break
            if stop >= len(raw):
                break
            stop = min(len(raw), stop + 4096)  # a word longer than the window: extend to its end
        yield raw[at:stop]
        at = stop
    yield raw[at:]


def word_blocks(texts: list[bytes], tables) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first, last, doc, hash)``: for the texts ``first..last-1`` the hash of each word in order and
    the text (relative to ``first``) it belongs to."""
    k = 0
    while k < len(texts):
        if len(texts[k]) > PIECE:
            parts = [_hash_piece(p, tables)[1] for p in _cut(texts[k], tables[0])]
            h = np.concatenate(parts)
            yield k, k + 1, np.zeros(len(h), np.int64), h
            k += 1
            continue
        first, size = k, 0
        while k < len(texts) and size + len(texts[k]) <= PIECE:
            size += len(texts[k]) + 1
            k += 1
        begins = np.cumsum([0] + [len(t) + 1 for t in texts[first:k]])
        starts, h = _hash_piece(b" ".join(texts[first:k]), tables)
        yield first, k, np.searchsorted(begins, starts, side="right") - 1, h


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` word hashes (length ``len(h) - k + 1``)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = h[:n].copy()
    for j in range(1, k):
        out = out * np.uint64(0xC2B2AE3D27D4EB4F) + h[j : j + n]
    return mix(out)


def sliding(x: np.ndarray, w: int, op) -> np.ndarray:
    """``op``-reduction (minimum or maximum) of each window of ``w`` values, by doubling."""
    span, out = 1, x
    while span < w:
        step = min(span, w - span)
        out = op(out[: len(out) - step], out[step:])
        span += step
    return out


#: bytes of an Arrow batch that a worker gets at a time
BATCH_BYTES = 2 << 20
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def limit_batches(spark) -> None:
    """Bound the Arrow batches of the session by bytes, where its setting allows larger ones: a number of
    rows alone bounds nothing when texts are long."""
    now = spark.conf.get(_BATCH_CONF, "67108864").rstrip("b")
    if not now.isdigit() or not 0 < int(now) <= BATCH_BYTES:
        spark.conf.set(_BATCH_CONF, str(BATCH_BYTES))


def release() -> None:
    """Give freed memory back to the system at the end of a task: workers stay alive, beside the executor's heap."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim is not None:
        trim(0)


def texts_of(column: pa.Array) -> list[bytes]:
    """The values of a string column as UTF-8 bytes, null as empty."""
    return [b"" if t is None else t for t in column.cast(pa.binary()).to_pylist()]
