"""Words and shingles of Arrow text batches as 64-bit hashes, with NumPy.

Words are runs of bytes other than space and 0x09-0x0D, with A-Z lower-cased. Hashes are deterministic across workers. Distinct words
or shingles may share a 64-bit hash; at 10^12 distinct ones in one comparison set that is still a 10^-7 chance for a given document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOW_BYTES = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [2**64 - 1], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of uint64 values."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts with eight zero bytes behind them, offsets of the texts); null as empty."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if data is not None else np.zeros(0, np.uint8)
    return np.concatenate([data, np.zeros(8, np.uint8)]), bounds - bounds[0]


def parts(batches: Iterator[pa.RecordBatch], text: int, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows with about ``most`` bytes of text, so that memory is bounded by that or one text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.cumsum(pc.binary_length(batch.column(text)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            before = sizes[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(sizes, before + most, "right")))
            yield batch.slice(at, to - at)
            at = to


def lane(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The eight bytes from each position as uint64."""
    view = np.ndarray((len(data) - 7,), "<u8", buffer=data, strides=(1,))
    return view[at]


def word_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash of each word, start and end byte, index of the first word of each text and one past the last)."""
    data = _LOWER[data]
    inside = ~_SPACE[data[:-8]]
    if not len(inside):
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, np.zeros(len(bounds), np.int64)
    edge = np.zeros(len(inside) + 1, bool)
    edge[bounds] = True
    before = np.concatenate([[False], inside[:-1]]) & ~edge[:-1]
    starts = np.flatnonzero(inside & ~before)
    after = np.concatenate([inside[1:], [False]]) & ~edge[1:]
    ends = np.flatnonzero(inside & ~after) + 1
    size = ends - starts
    with np.errstate(over="ignore"):
        h = mix(size.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
        h = mix(h ^ (lane(data, starts) & _LOW_BYTES[np.minimum(size, 8)]))
        live, at = np.flatnonzero(size > 8), 8
        while len(live):
            h[live] = mix(h[live] ^ (lane(data, starts[live] + at) & _LOW_BYTES[np.minimum(size[live] - at, 8)]) ^ np.uint64(at))
            at += 8
            live = live[size[live] > at]
    return h, starts, ends, np.searchsorted(starts, bounds)


def chain(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` items from each position on; as many as there are whole windows."""
    n = max(0, len(hashes) - width + 1)
    with np.errstate(over="ignore"):
        out = np.full(n, width, np.uint64)
        for k in range(width):
            out = mix(out + hashes[k : k + n])
    return out


def shingle_sets(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    """Per text the sorted distinct hashes of its ``width``-word shingles; of the whole word sequence where there are fewer words."""
    data, bounds = text_bytes(texts)
    h, _, _, first = word_hashes(data, bounds)
    windows = chain(h, width)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= width:
            yield np.unique(windows[a : b - width + 1])
        elif b > a:
            yield chain(h[a:b], b - a)
        else:
            yield h[:0]
