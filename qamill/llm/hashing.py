"""Words, word hashes and word-window hashes of Arrow text batches, with numpy.

Everything here works on one batch inside a task.  A batch is cut into slices
of a few MB of text, so memory does not grow with the batch.  Null texts count
as empty.  All separators are ASCII, so the work can be done on UTF-8 bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
SLICE_BYTES = 6 << 20
_PIECE = 1 << 20
_BASE = U64(0x9E3779B97F4A7C15 | 5)
_MULTIPLIERS = 64


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective), in place on a copy."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def seeded(n: int, seed: int) -> np.ndarray:
    """n fixed pseudo-random 64-bit numbers."""
    with np.errstate(over="ignore"):
        return mix64(np.arange(1, n + 1, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(seed))


_BYTES = seeded(256, 11)
_BYTES[ord("A"):ord("Z") + 1] = _BYTES[ord("a"):ord("z") + 1]
_ODD = seeded(_MULTIPLIERS, 12) | U64(1)

#: Byte is a separator.  White space: space and 0x09-0x0D.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: ASCII other than digits and letters.
NOT_ALNUM = np.zeros(256, dtype=bool)
NOT_ALNUM[[b for b in range(128) if not chr(b).isalnum()]] = True

_powers: list[np.ndarray] = []


def _pow(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least n of them."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, 1 << 16)
        inverse = U64(pow(int(_BASE), -1, 1 << 64))
        _powers[:] = []
        for b in (_BASE, inverse):
            p = np.full(size, b, dtype=U64)
            p[0] = U64(1)
            _powers.append(np.multiply.accumulate(p))
    return _powers[0], _powers[1]


def text_slices(ids: pa.Array, texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yield (first row, end row, bytes, offsets) so that a slice has about SLICE_BYTES.

    One text longer than that is a slice of its own: texts are never cut.
    """
    del ids
    n = len(texts)
    if n == 0:
        return
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, off, data = texts.buffers()
    offs = np.frombuffer(off, dtype=np.int64 if wide else np.int32)[texts.offset:texts.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    a = 0
    while a < n:
        b = int(np.searchsorted(offs, offs[a] + SLICE_BYTES, side="right")) - 1
        b = min(max(b, a + 1), n)
        yield a, b, raw[offs[a]:offs[b]], offs[a:b + 1] - offs[a]
        a = b


def word_spans(buf: np.ndarray, offs: np.ndarray, separator: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words, and for each row the index of its first word (n + 1 entries)."""
    sep = separator[buf]
    first = np.empty(len(buf), dtype=bool)
    last = np.empty(len(buf), dtype=bool)
    if len(buf):
        first[0] = last[-1] = True
        first[1:] = sep[:-1]
        last[:-1] = sep[1:]
        inner = offs[(offs > 0) & (offs < len(buf))]
        first[inner] = True
        last[inner - 1] = True
        first &= ~sep
        last &= ~sep
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offs)


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word, A-Z as a-z."""
    out = np.empty(len(starts), dtype=U64)
    i = 0
    while i < len(starts):
        j = max(int(np.searchsorted(ends, starts[i] + _PIECE, side="right")), i + 1)
        a, b = int(starts[i]), int(ends[j - 1])
        up, down = _pow(b - a + 1)
        s = np.zeros(b - a + 1, dtype=U64)
        np.cumsum(_BYTES[buf[a:b]] * up[:b - a], out=s[1:])
        st, en = starts[i:j] - a, ends[i:j] - a
        out[i:j] = mix64((s[en] - s[st]) * down[st] + (en - st).astype(U64))
        i = j
    return out


def window_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of words[i:i+k] for each i (over row limits too; mask those out)."""
    if len(words) < k:
        return np.zeros(0, dtype=U64)
    m = len(words) - k + 1
    h = np.full(m, U64(k * 0x632BE59BD9B4E019 % (1 << 64)), dtype=U64)
    for j in range(k):
        h += words[j:j + m] * _ODD[j % _MULTIPLIERS] + (U64(j // _MULTIPLIERS) if j >= _MULTIPLIERS else U64(0))
    return mix64(h)


def shingles(words: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """k-word shingle hashes of every row, in order, and their row bounds.

    A row with fewer than k words, but not none, has its whole sequence as one.
    """
    n = np.diff(bounds)
    at = np.zeros(len(words), dtype=U64)
    use = np.zeros(len(words), dtype=bool)
    h = window_hashes(words, k)
    row = np.repeat(np.arange(len(n)), n)
    if len(h):
        use[:len(h)] = row[:len(h)] == row[k - 1:]
        at[:len(h)] = h
    for r in np.flatnonzero((n > 0) & (n < k)):
        a, b = int(bounds[r]), int(bounds[r + 1])
        at[a] = window_hashes(words[a:b], b - a)[0]
        use[a] = True
    count = np.where(n >= k, n - k + 1, (n > 0).astype(n.dtype))
    return at[use], np.concatenate([[0], np.cumsum(count)])


def distinct_by_row(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of each row, and their row bounds."""
    parts = [np.unique(values[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    count = np.fromiter((len(p) for p in parts), dtype=np.int64, count=len(parts))
    return (np.concatenate(parts) if parts else values[:0]), np.concatenate([[0], np.cumsum(count)])


def set_keys(values: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """A 128-bit key of each row's set (sums of two mixes of its members)."""
    out = np.zeros((len(bounds) - 1, 2), dtype=U64)
    for c, salt in enumerate((U64(0xA0761D6478BD642F), U64(0xE7037ED1A0B428DB))):
        s = np.concatenate([np.zeros(1, U64), np.cumsum(mix64(values ^ salt), dtype=U64)])
        out[:, c] = mix64(s[bounds[1:]] - s[bounds[:-1]] + np.diff(bounds).astype(U64))
    return [r.tobytes() for r in out]


def long_lists(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """A list<int64> column from flat 64-bit values and row bounds."""
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values.view(np.int64)))
