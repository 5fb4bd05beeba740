"""Texts as the bytes of their Arrow buffers, and the words in them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are worked on at a time, about.
SLICE = 1 << 20
_GAP = np.zeros(256, bool)
_GAP[[0x20, *range(0x09, 0x0E)]] = True


def slices(texts: pa.Array, size: int = SLICE) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(number of the first text, offsets, bytes) of runs of about `size` bytes; a text is never split. No text may be null."""
    texts = texts.cast(pa.large_string())
    _, places, data = texts.buffers()
    if not len(texts):
        return
    offsets = np.frombuffer(places, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    done = 0
    while done < len(texts):
        stop = max(int(np.searchsorted(offsets, offsets[done] + size, "right")) - 1, done + 1)
        yield done, offsets[done : stop + 1] - offsets[done], raw[offsets[done] : offsets[stop]]
        done = stop


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first byte, end) of each maximal run of bytes other than space and U+0009 to U+000D; none spans two texts."""
    inside = ~_GAP[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edges = offsets[:-1][np.diff(offsets) > 0]
    begins[edges] = inside[edges]
    edges = edges[1:] - 1
    ends[edges] = inside[edges]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def gathered(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers first, first + 1, ... of each run, one run after the other."""
    before = np.cumsum(size) - size
    return np.repeat(first - before, size) + np.arange(int(size.sum()))
