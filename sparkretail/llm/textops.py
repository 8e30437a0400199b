"""Vectorised text helpers shared by the operators: byte views of Arrow string
columns, word spans, 64-bit word and shingle hashes. All work on slices of
512 KB, so memory does not grow with the batch (a single longer text makes a
slice of its own)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 19

_U = np.uint64
_C1, _C2 = _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = x ^ (x >> _U(30))
    x = x * _C1
    x = x ^ (x >> _U(27))
    x = x * _C2
    return x ^ (x >> _U(31))


_rng = np.random.default_rng(20240607)
#: separators of the contracts: space and U+0009..U+000D
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256)
_LOWER[65:91] += 32
#: one random odd number per byte, the same for A-Z and a-z
_BYTE_VALUE = (_rng.integers(1, 2**63, 256, dtype=np.uint64) | _U(1))[_LOWER]
_P = 0x9E3779B97F4A7C15
_PINV = pow(_P, -1, 2**64)
_POW: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POW or len(_POW["p"]) < n + 1:
        size = max(n + 1, SLICE_BYTES + 1)
        for name, base in (("p", _P), ("q", _PINV)):
            a = np.full(size, base, np.uint64)
            a[0] = 1
            _POW[name] = np.cumprod(a, dtype=np.uint64)
    return _POW["p"], _POW["q"]


def slices(arr: pa.Array, max_bytes: int = SLICE_BYTES):
    """``(start, stop, bytes, offsets)`` over runs of rows of a string column;
    null counts as the empty text."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if arr.null_count:
        arr = pc.fill_null(arr, "")
    arr = arr.cast(pa.large_string())
    n = len(arr)
    if n == 0:
        return
    buf = arr.buffers()
    off = np.frombuffer(buf[1], np.int64)[arr.offset:arr.offset + n + 1]
    data = np.frombuffer(buf[2], np.uint8) if buf[2] is not None else np.empty(0, np.uint8)
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(off, off[a] + max_bytes, "right")) - 1)
        yield a, b, data[off[a]:off[b]], off[a:b + 1] - off[a]
        a = b


def word_spans(data: np.ndarray, off: np.ndarray, separator: np.ndarray = SEPARATOR):
    """Start and end byte of every word, and the first word of each document
    (n + 1 entries)."""
    if len(data) == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(off), np.int64)
    word = ~separator[data]
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    begin, end = off[:-1], off[1:]
    full = end > begin
    first[begin[full]] = word[begin[full]]
    last[end[full] - 1] = word[end[full] - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, off)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span, A-Z taken as a-z."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    p, q = _powers(len(data))
    acc = np.empty(len(data) + 1, np.uint64)
    acc[0] = 0
    np.cumsum(_BYTE_VALUE[data] * p[:len(data)], out=acc[1:])
    h = (acc[ends] - acc[starts]) * q[starts]
    return mix64(h + (ends - starts).astype(np.uint64) * _U(0xD6E8FEB86659FD93))


_K = (_rng.integers(1, 2**63, 64, dtype=np.uint64) << _U(1)) | _U(1)


def shingle_hashes(words: np.ndarray, first: np.ndarray, k: int):
    """Hashes of the k-word shingles of each document and the first shingle of
    each (n + 1 entries). A document of fewer words gives its whole sequence
    as one shingle, one without words none."""
    count = np.diff(first)
    n_sh = np.where(count >= k, count - k + 1, (count > 0).astype(np.int64))
    out_first = np.concatenate([[0], np.cumsum(n_sh)])
    if len(words) == 0:
        return np.zeros(0, np.uint64), out_first, np.zeros(0, np.int64)
    pad = np.concatenate([words, np.zeros(k, np.uint64)])
    full = pad[:len(words)] * _K[0]
    for j in range(1, k):
        full += pad[j:j + len(words)] * _K[j % 64]
    full = mix64(full + _U(k))
    doc = np.repeat(np.arange(len(count)), n_sh)
    at = np.arange(out_first[-1]) - out_first[doc] + first[doc]
    h = full[at]
    for d in np.flatnonzero((count > 0) & (count < k)):
        w = words[first[d]:first[d + 1]]
        h[out_first[d]] = mix64((w * _K[:len(w)]).sum(dtype=np.uint64, keepdims=True) + _U(len(w)))[0]
    return h, out_first, at


def hash_texts(arr: pa.Array, k: int):
    """For each slice of a text column: ``(start, stop, shingle hashes, first
    shingle, byte length of each shingle with its words joined by one
    space)``; like the hashes, the length does not depend on the separators."""
    for a, b, data, off in slices(arr):
        s, e, first = word_spans(data, off)
        w = span_hashes(data, s, e)
        h, hf, at = shingle_hashes(w, first, k)
        doc_last = np.repeat(first[1:] - 1, np.diff(hf))
        upto = np.concatenate([[0], np.cumsum(e - s + 1)])
        length = upto[np.minimum(at + k - 1, doc_last) + 1] - upto[at] - 1 if len(at) else at
        yield a, b, h, hf, length
