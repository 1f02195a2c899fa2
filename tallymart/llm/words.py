"""Words of whole batches of texts as numpy arrays, straight from Arrow's UTF-8 bytes.

A word is a maximal run of anything but space and the control characters 9 to 13. Those
are single bytes in UTF-8 that no longer character contains, so words can be cut from
bytes. Every step works on slices of a few megabytes, cut at white space, so the arrays
of a very long text stay in proportion to its words.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

SLICE = 1 << 18  # bytes handled at a time
_U = np.uint64
_PRIME = 0x9E3779B97F4A7C15  # odd, so that powers of it have inverses modulo 2**64
_INVERSE = pow(_PRIME, -1, 1 << 64)


class Words(NamedTuple):
    """Words of a run of texts; ``of`` has, for each text, its first word (and one more)."""

    start: np.ndarray  # byte positions in ``data``
    end: np.ndarray
    hash: np.ndarray
    of: np.ndarray


def is_space(data: np.ndarray) -> np.ndarray:
    return (data == 32) | (data - np.uint8(9) < 5)


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return data | ((data - np.uint8(65) < 26).view(np.uint8) << np.uint8(5))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def powers(base: int, count: int) -> np.ndarray:
    out = np.ones(max(count, 1), _U)
    have = 1
    while have < count:
        more = min(have, count - have)
        out[have : have + more] = out[:more] * _U(pow(base, have, 1 << 64))
        have += more
    return out[:count]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and text offsets of a string column; null is the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]] if len(at) else raw, at - at[0] if len(at) else np.zeros(1, int)


def runs(offsets: np.ndarray, limit: int = 4 * SLICE) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about ``limit`` bytes together, one text at least."""
    first, count = 0, len(offsets) - 1
    while first < count:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), count)
        yield first, last
        first = last


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> Words:
    """Words and their 64-bit hashes; ``lower`` hashes A-Z as a-z."""
    cut = np.zeros(len(data) + 1, bool)  # where a text begins
    cut[offsets] = True
    starts, ends, hashes = [], [], []
    up, down = powers(_PRIME, min(SLICE, len(data))), powers(_INVERSE, min(SLICE, len(data)))
    at = 0
    while at < len(data):
        stop = min(at + SLICE, len(data))
        while stop < len(data) and not (is_space(data[stop - 1 : stop])[0] or cut[stop]):
            near = data[stop : stop + SLICE]
            ahead = np.flatnonzero(is_space(near) | cut[stop : stop + len(near)])
            stop = stop + int(ahead[0]) + 1 if len(ahead) else min(stop + SLICE, len(data))
        part = data[at:stop]
        inside = ~is_space(part)
        begins, finish = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1] | cut[at + 1 : stop]
        finish[:-1] &= ~inside[1:] | cut[at + 1 : stop]
        first, last = np.flatnonzero(begins), np.flatnonzero(finish) + 1
        if len(first):
            if len(part) > len(up):
                up, down = powers(_PRIME, len(part)), powers(_INVERSE, len(part))
            term = (lower_ascii(part) if lower else part).astype(_U)
            term *= up[: len(part)]
            total = np.cumsum(term)
            value = (total[last - 1] - total[first] + term[first]) * down[first]
            starts.append(first + at)
            ends.append(last + at)
            hashes.append(mix(value + (last - first).astype(_U)))
        at = stop
    join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
    start = join(starts, np.int64)
    return Words(start, join(ends, np.int64), join(hashes, _U), np.searchsorted(start, offsets))


def windows(found: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``size``-word windows, and the first window of each text (and one more).

    A text of fewer words has one window, the whole sequence; one without words has none.
    """
    count = np.diff(found.of)
    each = np.where(count >= size, count - size + 1, (count > 0).astype(count.dtype))
    of = np.concatenate([[0], np.cumsum(each)])
    text = np.repeat(np.arange(len(count)), each)
    first = np.arange(of[-1]) - of[:-1][text] + found.of[:-1][text]
    length = np.minimum(count, size)[text]
    scale = powers(_PRIME, size + 1)[1:]
    total = np.zeros(len(first), _U)
    for k in range(size):
        here = length > k
        if here.all():
            total += found.hash[first + k] * scale[k]
        else:
            total[here] += found.hash[first[here] + k] * scale[k]
    return mix(total + length.astype(_U)), of
