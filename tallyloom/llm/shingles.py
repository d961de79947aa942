"""Sets of word shingles as sorted 64-bit hashes, made with numpy over whole batches of text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute

WORDS = 5
#: Bytes of text that are hashed at a time; a longer text is hashed whole.
CHUNK = 1 << 20

_BASE = 0x9E3779B97F4A7C15  # odd, so powers have inverses modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOW = np.arange(256, dtype=np.uint8)
_LOW[65:91] += 32
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 ... base**(n-1) modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, CHUNK + (1 << 18))
        have = np.full(size, base, np.uint64)
        have[0] = 1
        _powers[base] = have = np.multiply.accumulate(have)
    return have[:n]


def forget() -> None:
    """Frees the powers; workers outlive their tasks."""
    _powers.clear()


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = x ^ x >> np.uint64(30)
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ x >> np.uint64(27)
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


_FACTORS = mix(np.arange(1, WORDS + 1, dtype=np.uint64) * np.uint64(_BASE)) | np.uint64(1)


def words_of(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of each word. data: the bytes of texts one behind another; ends: where each text ends."""
    if len(data) == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    space = _SPACE[data]
    cut = np.zeros(len(data) + 1, bool)  # a text begins here
    cut[0] = True
    cut[ends] = True
    before = np.empty(len(data), bool)
    before[0], before[1:] = True, space[:-1]
    first = np.flatnonzero(~space & (before | cut[:-1]))
    behind = np.empty(len(data), bool)
    behind[-1], behind[:-1] = True, space[1:]
    last = np.flatnonzero(~space & (behind | cut[1:]))
    weighed = (_LOW[data].astype(np.uint64) + np.uint64(1)) * powers(_BASE, len(data))
    total = np.cumsum(weighed)
    h = (total[last] - total[first] + weighed[first]) * powers(_INVERSE, len(data))[first]
    return mix(h), np.searchsorted(ends, first, "right")


def sets_of(data: np.ndarray, ends: np.ndarray, k: int = WORDS) -> list[np.ndarray]:
    """For each text its distinct k-word shingles, sorted; with fewer words the whole sequence as one; without, empty."""
    h, owner = words_of(data, ends)
    counts = np.bincount(owner, minlength=len(ends))
    starts = np.concatenate([[0], np.cumsum(counts)])
    if len(h) >= k:
        all_ = np.zeros(len(h) - k + 1, np.uint64)
        for i in range(k):
            all_ += h[i : len(h) - k + 1 + i] * _FACTORS[i]
        all_ = mix(all_)
    out = []
    for t, n in enumerate(counts.tolist()):
        a = starts[t]
        if n >= k:
            s = np.sort(all_[a : a + n - k + 1])
            out.append(s[np.concatenate([[True], s[1:] != s[:-1]])])
        elif n:
            out.append(mix((h[a : a + n] * _FACTORS[:n]).sum(keepdims=True) + np.uint64(n)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def chunks(column: pa.Array, most: int = CHUNK) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First text, bytes and ends of runs of texts of about so many bytes. Null counts as empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = pa.compute.fill_null(column, b"")
    n = len(column)
    if n == 0:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64, n + 1 + column.offset)[column.offset :]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield at, data[offsets[at] : offsets[to]], offsets[at + 1 : to + 1] - offsets[at]
        at = to


def text_sets(column: pa.Array) -> Iterator[np.ndarray]:
    for _, data, ends in chunks(column):
        yield from sets_of(data, ends)


def name_of(s: np.ndarray) -> int:
    """A 64-bit name of a set, as a signed number."""
    total = (int(mix(s ^ np.uint64(0xD1B54A32D192ED03)).sum(dtype=np.uint64)) + len(s) * _BASE) % (1 << 64)
    return int(mix(np.array([total], np.uint64)).view(np.int64)[0])
