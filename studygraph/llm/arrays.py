"""Vectorised text primitives over Arrow string columns, for use inside tasks: words, their hashes and rolling windows.

Everything works on the UTF-8 bytes of whole texts, a slice of rows at a time; a slice ends after a bounded number of
bytes, or holds one text that is longer."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute

#: Bytes of text looked at together in a task.
SLICE_BYTES = 512 << 10
#: Values whose sums are taken together.
CHUNK = 1 << 18

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers = (np.zeros(0, np.uint64), np.zeros(0, np.uint64))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers, at least, of the hash base and of its inverse, modulo 2**64. The longest made so far are kept."""
    global _powers
    if len(_powers[0]) < n:
        size = 1 << max(12, int(n - 1).bit_length())
        made = []
        for base in (_BASE, _INVERSE):
            x = np.full(size, base, np.uint64)
            x[0] = 1
            made.append(np.cumprod(x, dtype=np.uint64))
        if size > 4 * CHUNK:  # a single very long span: not worth keeping
            return made[0], made[1]
        _powers = (made[0], made[1])
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of unsigned 64-bit integers that spreads every bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column's texts one after the other, and where each text starts (one more at the end). Null
    is the empty text."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and len(data) else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in slices of at most limit bytes of text, or of one row."""
    sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    at = 0
    while at < len(sizes):
        stop = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + limit, "right"))
        stop = max(stop, at + 1)
        yield batch.slice(at, stop - at)
        at = stop


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_TERM = np.zeros(256, bool)
_TERM[48:58] = _TERM[65:91] = _TERM[97:123] = _TERM[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each maximal run of true values that does not cross a text's bounds."""
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    bounds = offsets[:-1][offsets[:-1] < len(inside)]
    starts[bounds] = inside[bounds]
    last = bounds[bounds > 0] - 1
    ends[last] = inside[last]
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1


def words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words ([^\\x20\\x09-\\x0D]+) of texts, and for each text the index of its first word (one
    more at the end)."""
    starts, ends = runs(~_SPACE[raw], offsets)
    return starts, ends, np.searchsorted(starts, offsets)


def terms(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The same for terms, runs of letters, digits and non-ASCII characters, with ASCII in lower case: lowered bytes,
    starts, ends, first term of each text."""
    starts, ends = runs(_TERM[raw], offsets)
    return _LOWER[raw], starts, ends, np.searchsorted(starts, offsets)


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of spans of bytes, which follow one another; equal bytes, equal hashes. Sums are taken over CHUNK
    bytes at a time, or over one span that is longer, so that they need little memory beside the text."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        origin = int(starts[at])
        stop = max(at + 1, int(np.searchsorted(ends, origin + CHUNK, "right")))
        part = raw[origin : int(ends[stop - 1])].astype(np.uint64)
        part += np.uint64(1)
        up, down = powers(len(part) + 1)
        part *= up[: len(part)]
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part, out=total[1:])
        first, last = starts[at:stop] - origin, ends[at:stop] - origin
        out[at:stop] = mix((total[last] - total[first]) * down[first] + (last - first).astype(np.uint64))
        at = stop
    return out


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of each run of width consecutive values; the i-th is of the run that starts at i."""
    n = len(hashes)
    if n < width:
        return np.zeros(0, np.uint64)
    out = np.empty(n - width + 1, np.uint64)
    for at in range(0, len(out), CHUNK):
        part = hashes[at : at + CHUNK + width - 1]
        up, down = powers(len(part) + 1)
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * up[: len(part)], out=total[1:])
        out[at : at + CHUNK] = mix((total[width:] - total[:-width]) * down[: len(part) - width + 1])
    return out


def window_starts(first: np.ndarray, width: int) -> np.ndarray:
    """Which positions start a run of width values within one text. first: each text's first value, one more at the end."""
    n = int(first[-1])
    left = np.repeat(first[1:], np.diff(first)) - np.arange(n)
    return left >= width


def labelled(hashes: np.ndarray) -> np.ndarray:
    """Hashes that also tell the occurrence: the second occurrence of a value differs from its first, and so on."""
    if not len(hashes):
        return hashes
    order = np.argsort(hashes, kind="stable")
    ranked = hashes[order]
    head = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1])))
    nth = np.arange(len(ranked)) - np.repeat(head, np.diff(np.append(head, len(ranked))))
    out = np.empty_like(hashes)
    out[order] = mix(ranked + nth.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return out
