"""Array helpers over blocks of equally long traces (one trace per row of a matrix)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Peaks whose rows are gathered at once.
GATHER = 4096
#: Samples of all windows whose medians are taken at once.
WINDOWED = 1 << 19


def by_length(traces) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(positions, matrix) for each length among the traces; NULL and empty ones are left out."""
    sizes = np.array([0 if a is None else len(a) for a in traces])
    for n in np.unique(sizes[sizes > 0]):
        rows = np.flatnonzero(sizes == n)
        yield rows, np.array([traces[i] for i in rows], dtype="float64")


def envelope(block: np.ndarray) -> np.ndarray:
    """Magnitude of the analytic signal: the spectrum with its negative half folded onto the positive one."""
    n = block.shape[-1]
    half = np.fft.rfft(block)
    half[..., 1 : (n + 1) // 2] *= 2
    return np.abs(np.fft.ifft(half, n))


def running_median(block: np.ndarray, width: int) -> np.ndarray:
    """Median over ``width`` samples, zeros beyond both ends; some rows at a time, as the median copies their windows."""
    side = width // 2
    wide = np.pad(block, ((0, 0), (side, side)))
    windows = np.lib.stride_tricks.sliding_window_view(wide, width, axis=1)
    out = np.empty(windows.shape[:2])
    step = max(1, WINDOWED // max(1, block.shape[1] * width))
    for at in range(0, len(block), step):
        out[at : at + step] = np.median(windows[at : at + step], axis=2)
    return out


def detrended(block: np.ndarray) -> np.ndarray:
    """Rows minus their least-squares lines."""
    x = np.arange(block.shape[1]) - (block.shape[1] - 1) / 2
    slope = block @ x / (x @ x)
    return block - block.mean(axis=1, keepdims=True) - slope[:, None] * x


def spread(block: np.ndarray) -> np.ndarray:
    """1.4826 x median absolute deviation of each row."""
    return 1.4826 * np.median(np.abs(block - np.median(block, axis=1, keepdims=True)), axis=1)


def tops(block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the local maxima, by row and column; a plateau counts once, at its middle; ends never do.

    The block is read as runs of equal samples; a run is a top if the runs on both sides lie in its row and are lower.
    """
    rows, n = block.shape
    flat = block.ravel()
    new = np.ones(len(flat), bool)
    new[1:] = flat[1:] != flat[:-1]
    new[::n] = True
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(flat)) - 1
    level, row = flat[first], first // n
    inner = np.zeros(len(first), bool)
    if len(first) > 2:
        same = (row[:-2] == row[1:-1]) & (row[2:] == row[1:-1])
        inner[1:-1] = same & (level[:-2] < level[1:-1]) & (level[2:] < level[1:-1])
    return row[inner], (first[inner] % n + last[inner] % n) // 2


def spaced(row: np.ndarray, at: np.ndarray, height: np.ndarray, distance: int) -> np.ndarray:
    """Which tops stay if none may lie closer than ``distance`` to a higher one that stays; the later of equals counts as higher.

    In each round all tops stay that beat every undecided one within reach, and those in their reach go. Neighbours are compared by shifts, since tops come by
    row and column.
    """
    stays, open_ = np.zeros(len(at), bool), np.ones(len(at), bool)
    shifts = []
    for k in range(1, len(at)):
        near = (row[k:] == row[:-k]) & (at[k:] - at[:-k] < distance)
        if not near.any():
            break
        shifts.append((k, near))
    while open_.any():
        beaten = np.zeros(len(at), bool)
        for k, near in shifts:
            both = near & open_[k:] & open_[:-k]
            later = height[k:] >= height[:-k]
            beaten[:-k] |= both & later
            beaten[k:] |= both & ~later
        won = open_ & ~beaten
        stays |= won
        open_ &= ~won
        for k, near in shifts:
            open_[:-k] &= ~(near & won[k:])
            open_[k:] &= ~(near & won[:-k])
    return stays


def prominences(block: np.ndarray, row: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(prominence, width at half prominence) of tops, each over the stretch around it that holds nothing higher."""
    prom, width = np.zeros(len(at)), np.zeros(len(at))
    column = np.arange(block.shape[1])
    for i in range(0, len(at), GATHER):
        part = slice(i, i + GATHER)
        v, p = block[row[part]], at[part][:, None]
        peak = np.take_along_axis(v, p, 1)
        left, right = column < p, column > p
        lo = np.where(left & (v > peak), column, -1).max(1, keepdims=True) + 1
        hi = np.where(right & (v > peak), column, block.shape[1]).min(1, keepdims=True) - 1
        base = [np.where((column >= a) & (column <= b), v, np.inf).min(1, keepdims=True) for a, b in ((lo, p), (p, hi))]
        prom[part] = (peak - np.maximum(*base))[:, 0]
        level = peak - prom[part][:, None] / 2
        under = v <= level
        a = np.maximum(np.where(under & (column <= p), column, -1).max(1, keepdims=True), lo)
        b = np.minimum(np.where(under & (column >= p), column, block.shape[1]).min(1, keepdims=True), hi)
        width[part] = (_crossing(v, b, -1, level) - _crossing(v, a, 1, level))[:, 0]
    return prom, width


def _crossing(v: np.ndarray, at: np.ndarray, step: int, level: np.ndarray) -> np.ndarray:
    """Where the line from sample ``at`` to the next one (by ``step``) reaches ``level``; ``at`` itself if it is not below."""
    here = np.take_along_axis(v, at, 1)
    there = np.take_along_axis(v, np.clip(at + step, 0, v.shape[1] - 1), 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        part = (level - here) / (there - here)
    return at + step * np.where(here < level, part, 0.0)


def best_of(row: np.ndarray, score: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """(index of each row's first best score or -1, how far the second best lies behind; infinite for a single one)."""
    order = np.lexsort((np.arange(len(row)), -score, row))
    best, gap = np.full(rows, -1), np.full(rows, np.inf)
    if len(order):
        lead = np.flatnonzero(np.append(True, np.diff(row[order]) != 0))
        best[row[order][lead]] = order[lead]
        two = lead[(lead + 1 < len(order)) & (np.append(row[order], -1)[lead + 1] == row[order][lead])]
        gap[row[order][two]] = score[order][two] - score[order][two + 1]
    return best, gap
