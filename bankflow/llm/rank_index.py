"""Learned rank index over UTF-8 bytes: code point rank -> byte offset.

The byte offsets of all code point boundaries (the end included) are a rising sequence. Segments are fitted to it one
after the other: a segment grows as long as some slope through its first boundary stays within ``error`` bytes of every
boundary (the cone of such slopes is narrowed in numpy over windows that double). What the segment's line misses is
stored as one signed byte per boundary, so a look-up is a prediction and one correction, and it is exact.

Bytes are taken in blocks of ``BLOCK``; besides the bytes themselves the index holds one byte per code point and 24 bytes per
segment. A byte that continues no code point (in data that is no UTF-8) counts to the code point before it; a text's first byte always begins one.
"""

from __future__ import annotations

import numpy as np

ERROR = 60          # bytes that a segment may miss a boundary by; a stored residual is one signed byte
BLOCK = 1 << 20     # bytes whose boundaries are held at once
WINDOW = 256        # boundaries first looked at by a growing segment


def fit_segment(at: np.ndarray, first: int, error: int) -> tuple[int, float]:
    """(end, slope) of the longest segment from boundary ``first``, by the cone of slopes within ``error``."""
    low, high, j, window = -np.inf, np.inf, first + 1, WINDOW
    while j < len(at):
        end = min(j + window, len(at))
        run = np.arange(j - first, end - first, dtype=np.float64)
        rise = (at[j:end] - at[first]).astype(np.float64)
        highs = np.minimum(np.minimum.accumulate((rise + error) / run), high)
        lows = np.maximum(np.maximum.accumulate((rise - error) / run), low)
        crossed = lows > highs
        if crossed[-1]:                                   # once crossed, the cone stays so
            stop = int(np.argmax(crossed))
            if stop:
                low, high = lows[stop - 1], highs[stop - 1]
            j += stop
            break
        low, high, j, window = lows[-1], highs[-1], end, window * 2
    return j, (low + high) / 2 if np.isfinite(low) else 1.0


class RankIndex:
    """Offsets of the code points of ``data`` (an array of bytes) by rank; rank ``count`` is the end. ``starts`` are the (rising)
    offsets at which texts begin, if there are several."""

    def __init__(self, data: np.ndarray, starts: np.ndarray | None = None, error: int = ERROR):
        if not 0 < error <= 120:
            raise ValueError("a residual must fit one signed byte")
        ranks, offsets, slopes, residuals, done = [], [], [], [], 0
        for begin in range(0, max(len(data), 1), BLOCK):
            block = data[begin:begin + BLOCK]
            lead = (block & 0xC0) != 0x80
            if starts is not None:
                a, b = np.searchsorted(starts, [begin, begin + len(block)])
                lead[starts[a:b] - begin] = True
            elif begin == 0 and len(block):
                lead[0] = True
            at = np.flatnonzero(lead) + begin
            if begin + BLOCK >= len(data):
                at = np.append(at, len(data))
            missed, i = np.empty(len(at), np.int8), 0
            while i < len(at):
                end, slope = fit_segment(at, i, error)
                line = at[i] + np.rint(slope * np.arange(end - i)).astype(np.int64)
                missed[i:end] = at[i:end] - line
                ranks.append(done + i)
                offsets.append(int(at[i]))
                slopes.append(slope)
                i = end
            residuals.append(missed)
            done += len(at)
        self.count = done - 1
        self.ranks, self.offsets = np.array(ranks, np.int64), np.array(offsets, np.int64)
        self.slopes, self.residuals = np.array(slopes), np.concatenate(residuals)

    def predict(self, rank: np.ndarray) -> np.ndarray:
        """Offsets by the segments alone, at most ``error`` (and half a byte of rounding) off."""
        s = np.searchsorted(self.ranks, rank, side="right") - 1
        return self.offsets[s] + np.rint(self.slopes[s] * (rank - self.ranks[s])).astype(np.int64)

    def offset(self, rank: np.ndarray) -> np.ndarray:
        """Exact byte offset of each rank from 0 to ``count``."""
        rank = np.asarray(rank, np.int64)
        return self.predict(rank) + self.residuals[rank]


def code_points(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Code points of each text of a run, by the rule of the index."""
    per_text = np.empty(len(offsets) - 1, np.int64)
    for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        text = data[a:b]
        per_text[i] = int(np.count_nonzero((text & 0xC0) != 0x80)) + bool(b > a and text[0] & 0xC0 == 0x80)
    return per_text
